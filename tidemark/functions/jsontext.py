"""SQL expressions over JSON text that must keep its key order and number spelling.

These take and return SQL text: the parsing expressions are long, and one text is handed to Spark
much faster than the same expression one Column at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

# Spark's JSON reader is laxer than the message format allows; these put it back to plain JSON.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
STRICT_SQL = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"


def as_map(text: str, value: str = "string") -> str:
    """Parse a JSON object to a map; null when the text is not an object.

    Nested values come back as compact JSON text, numbers in double form (``1.10`` as ``1.1``).
    Repeated keys stay as repeated entries.
    """
    return f"from_json({text}, 'map<string,{value}>', {STRICT_SQL})"


def last_value(entries: str, key: str) -> str:
    """Value of ``key`` in a parsed object, the last one when the key is repeated."""
    from_end = f"array_position(reverse(map_keys({entries})), '{key}')"
    return f"get(map_values({entries}), cast(size({entries}) - {from_end} as int))"


def has_others(entries: str, allowed: Sequence[str]) -> str:
    """Does a parsed object have a key that is not allowed?"""
    known = ", ".join(f"'{k}'" for k in allowed)
    return f"size(array_except(map_keys({entries}), array({known}))) > 0"


def whole_number(text: str, spark_type: str) -> str:
    """A number's text as a whole number: 5, "5" and 5.7 are all numbers here, the last one cut to 5."""
    cut = f"try_cast(try_cast({text} as decimal(38,18)) as {spark_type})"
    return f"coalesce(try_cast({text} as {spark_type}), {cut})"


def quoted(text: str) -> str:
    """``text`` as a JSON string literal, ``null`` for null."""
    return f"trim(BOTH '[]' FROM to_json(array({text}), map('ignoreNullFields', 'false')))"


def unquoted(literal: str) -> str:
    """Text inside a JSON string literal."""
    parsed = f"get(from_json(concat('[', {literal}, ']'), 'array<string>', {STRICT_SQL}), 0)"
    plain = f"substring({literal}, 2, length({literal}) - 2)"
    return rf"if(contains({literal}, r'\'), {parsed}, {plain})"


def map_text(compact: str) -> str:
    """Compact JSON of any depth as ``{k=v, k2=null}`` text: strings bare, lists in brackets."""
    tokens = rf"""regexp_extract_all({compact}, r'"(?:[^"\\]|\\.)*+"|[^"]+', 0)"""
    punctuation = "replace(replace(t, ':', '='), ',', ', ')"
    token = f"if(startswith(t, '\"'), {unquoted('t')}, {punctuation})"
    return f"array_join(transform({tokens}, t -> {token}), '')"


def flat_map_text(entries: str, compact: str) -> str:
    """``map_text`` for an object without nested values, from its parsed entries.

    Spark prints a map as ``{k -> v, k2 -> null}``, which differs only in the arrow, so the cast
    does the work unless the text itself holds an arrow.
    """
    entry = "concat(e.key, '=', coalesce(e.value, 'null'))"
    by_entry = f"concat('{{', array_join(transform(map_entries({entries}), e -> {entry}), ', '), '}}')"
    printed = f"replace(cast({entries} as string), ' -> ', '=')"
    return f"if(contains({compact}, ' -> '), {by_entry}, {printed})"


def rebuild(keys: str, values: str, kinds: str) -> str:
    """Object text with the given keys in order, each with its last value.

    ``values`` is the object as ``map<string,string>`` and ``kinds`` as ``map<string,variant>``;
    the second only tells strings from numbers.
    """
    at = f"cast(size({values}) - array_position(reverse(map_keys({values})), k) as int)"
    text = f"get(map_values({values}), {at})"
    is_string = f"schema_of_variant(get(map_values({kinds}), {at})) = 'STRING'"
    member = f"concat({quoted('k')}, ':', if({text} is null or {is_string}, {quoted(text)}, {text}))"
    return f"concat('{{', array_join(transform({keys}, k -> {member}), ','), '}}')"
