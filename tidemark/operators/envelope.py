"""Strict reading of change messages, with a reason for everything that is not readable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import model as M
from tidemark.functions import images, jsontext, rows

# Reasons that mean the text could not be read at all; the others name a readable message that
# lacks something a later step needs.
UNREADABLE = ("empty", "bad_json", "unknown_key", "bad_number")

#: All causes, unknown operations only with ``strict_ops``.
REASONS = (
    *UNREADABLE, "missing_payload", "missing_op", "missing_image", "image_not_object", "repeated_inner_key", "unknown_op",
)

FIELDS = ("scn", "tms", "xid", "op", "schema", "row", "rid", "before", "after", "sql")

EXACT = ("before_exact", "after_exact")


def parse_changes(
    messages: DataFrame, *, on_bad: str = "quarantine", strict_ops: bool = False, exact: bool = False
) -> DataFrame:
    """Read change messages from the ``value`` column; other columns are passed through.

    ``on_bad`` decides what happens to a message that cannot be used:

    - ``"flag"``: keep it, with the cause in ``reason`` (null for a good message) and its ``value``
    - ``"quarantine"``: leave it out; :func:`quarantined` returns exactly those
    - ``"dummy"``: an unreadable one becomes a fixed insert for a demo table, others are left out
    - ``"fail"``: stop the job at the first one

    ``strict_ops`` also rejects operation codes other than c, u, d and ddl. Parsing is narrow: no
    shuffle, and the same on batch and streaming frames.

    ``before`` and ``after`` have numbers in double form, as row ids need them. ``exact`` adds the images as
    ``before_exact`` and ``after_exact`` with every digit of numbers of up to 38; the keys there are sorted, and of a
    message that repeats a key both are null.
    """
    read = _read(messages, strict_ops, exact)
    reason = F.col("reason")
    fields = (*FIELDS, *EXACT) if exact else FIELDS
    columns = [F.col(c) for c in (*_passed(messages), *fields)]
    if on_bad == "flag":
        return rows.emit(read, [*columns, reason, F.col("value")])
    if on_bad == "quarantine":
        return rows.emit(read, columns, reason.isNull())
    if on_bad == "fail":
        stop = F.raise_error(F.concat(F.lit("bad change message: "), reason)).cast("boolean")
        return rows.emit(read, columns, F.when(reason.isNull(), True).otherwise(stop))
    if on_bad == "dummy":
        return _with_dummies(read, _passed(messages), fields)
    raise ValueError(f"unknown on_bad: {on_bad}")


def quarantined(messages: DataFrame, *, strict_ops: bool = False) -> DataFrame:
    """Messages that ``on_bad="quarantine"`` leaves out: their text, cause and position."""
    columns = [F.col(c) for c in (*_passed(messages), "value", "reason")]
    return rows.emit(_read(messages, strict_ops), columns, F.col("reason").isNotNull())


def drop_ddl(changes: DataFrame) -> DataFrame:
    """Leave out schema changes. Case matters: ``DDL`` stays."""
    return changes.filter(~F.col("op").eqNullSafe(M.DDL))


def _passed(messages: DataFrame) -> list[str]:
    return [c for c in messages.columns if c not in ("key", "value", "scn", "seq")]


def _read(messages: DataFrame, strict_ops: bool, exact: bool = False) -> DataFrame:
    """All fields as columns, with ``reason``; every level of the text is parsed once."""
    get = jsontext.last_value
    kept = [*_passed(messages), "value"]
    # The variant reader keeps numbers of up to 38 digits as they are, where the text reader goes through a double.
    numbers = f"{get(jsontext.as_map('value', 'variant'), 'payload')} as _exact"
    return (
        messages.selectExpr(*kept, f"{jsontext.as_map('value')} as _top")
        .selectExpr("*", f"{get('_top', 'payload')} as _payload_text")
        .selectExpr("*", f"{jsontext.as_map('_payload_text')} as _payload")
        .selectExpr("*", f"{get('_payload', 'schema')} as _address_text")
        .selectExpr("*", f"{jsontext.as_map('_address_text')} as _address")
        .selectExpr(
            "*",
            f"{get('_top', 'scn')} as _scn",
            f"{get('_top', 'tms')} as tms",
            f"{get('_top', 'xid')} as xid",
            f"{get('_top', 'row')} as _outer_row",
            f"{get('_payload', 'op')} as op",
            f"{get('_payload', 'row')} as _row",
            f"{get('_payload', 'rid')} as rid",
            f"{get('_payload', 'before')} as before",
            f"{get('_payload', 'after')} as after",
            f"{get('_payload', 'sql')} as sql",
            f"{get('_address', 'owner')} as _owner",
            f"{get('_address', 'table')} as _table",
        )
        .selectExpr(
            "*",
            f"{jsontext.whole_number('_scn', 'bigint')} as _scn_number",
            f"{jsontext.whole_number('_row', 'int')} as _row_number",
        )
        .selectExpr(
            *kept,
            "coalesce(_scn_number, 0L) as scn",
            "tms",
            "xid",
            "op",
            "if(_address is null, null, struct(_owner as owner, _table as table)) as schema",
            "coalesce(_row_number, 0) as row",
            "rid",
            "before",
            "after",
            "sql",
            f"{_reason(strict_ops)} as reason",
            *([numbers] if exact else []),
        )
        .selectExpr(
            "*", *([f"to_json(try_variant_get(_exact, '$.{c.removesuffix('_exact')}', 'variant')) as {c}" for c in EXACT] if exact else [])
        )
    )


def _reason(strict_ops: bool) -> str:
    def is_string(parent: str, key: str, opening: str) -> str:
        # A string that holds an object reads like the object itself. The kind is asked of a parse, but
        # only where the message has a quote before such a bracket at all.
        kinds = jsontext.as_map(parent, "variant")
        kind = f"coalesce(schema_of_variant({jsontext.last_value(kinds, key)}) = 'STRING', false)"
        return f"if(contains(value, concat('\"', {opening})), {kind}, false)"

    def not_object(text: str, parent: str, key: str) -> str:
        return f"({text} is not null and (not startswith({text}, '{{') or {is_string(parent, key, chr(39) + '{' + chr(39))}))"

    def nested(text: str, parent: str, key: str) -> str:
        # An object or list where text belongs.
        opens = f"(startswith({text}, '{{') or startswith({text}, '['))"
        return f"coalesce({opens} and not {is_string(parent, key, f'left({text}, 1)')}, false)"

    def not_number(text: str, number: str) -> str:
        return f"(coalesce({text}, '') <> '' and {number} is null)"

    shape = [
        "_top is null",
        "(_payload_text is not null and _payload is null)",
        not_object("_payload_text", "value", "payload"),
        "(_address_text is not null and _address is null)",
        not_object("_address_text", "_payload_text", "schema"),
        *[nested(c, "value", k) for c, k in (("tms", "tms"), ("xid", "xid"), ("_outer_row", "row"))],
        *[nested(c, "_payload_text", c) for c in ("op", "rid", "sql")],
        *[nested(c, "_address_text", k) for c, k in (("_owner", "owner"), ("_table", "table"))],
    ]
    others = [
        jsontext.has_others("_top", M.ENVELOPE_KEYS),
        jsontext.has_others("_payload", M.PAYLOAD_KEYS),
        f"(_address is not null and {jsontext.has_others('_address', M.ADDRESS_KEYS)})",
    ]
    before = f"lower(op) in ('{M.UPDATE}', '{M.DELETE}')"
    after = f"lower(op) in ('{M.INSERT}', '{M.UPDATE}')"

    def needed(test_before: str, test_after: str) -> str:
        return f"({before} and {test_before}) or ({after} and {test_after})"

    unknown_op = f"not op in ('{M.INSERT}', '{M.UPDATE}', '{M.DELETE}', '{M.DDL}')"
    return f"""CASE
      WHEN coalesce(value, '') = '' THEN 'empty'
      WHEN {' or '.join(shape)} THEN 'bad_json'
      WHEN {' or '.join(others)} THEN 'unknown_key'
      WHEN {not_number('_scn', '_scn_number')} or {not_number('_row', '_row_number')} THEN 'bad_number'
      WHEN _payload_text is null THEN 'missing_payload'
      WHEN op is null THEN 'missing_op'
      WHEN {needed("before is null", "after is null")} THEN 'missing_image'
      WHEN {needed(not_object("before", "_payload_text", "before"), not_object("after", "_payload_text", "after"))} THEN 'image_not_object'
      WHEN {needed(images.has_inner_repeats("before"), images.has_inner_repeats("after"))}
        THEN 'repeated_inner_key'
      {f"WHEN {unknown_op} THEN 'unknown_op'" if strict_ops else ""}
    END"""


def _with_dummies(read: DataFrame, passed: list[str], names: Sequence[str]) -> DataFrame:
    is_dummy = F.coalesce(F.col("reason").isin(*UNREADABLE), F.lit(False))
    nothing = F.lit(None).cast("string")
    owner, table = F.lit(M.DUMMY_OWNER), F.lit(M.DUMMY_TABLE)
    stand_in = {
        "scn": F.lit(0).cast("bigint"),
        "tms": nothing,
        "xid": nothing,
        "op": F.lit(M.INSERT),
        "schema": F.struct(owner.alias("owner"), table.alias("table")),
        "row": F.lit(M.DUMMY_ROW),
        "rid": F.lit(M.DUMMY_RID),
        "before": nothing,
        "after": F.lit(M.DUMMY_IMAGE),
        "sql": nothing,
        "before_exact": nothing,
        "after_exact": F.lit(M.DUMMY_IMAGE),
    }
    fields = [F.when(is_dummy, stand_in[c]).otherwise(F.col(c)).alias(c) for c in names]
    # Stand-ins never get a row id: that is how the null-key drop later removes them.
    columns = [*[F.col(c) for c in passed], *fields, is_dummy.alias("is_dummy")]
    return rows.emit(read, columns, F.col("reason").isNull() | is_dummy)
