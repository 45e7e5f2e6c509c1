"""Masking secrets in text by ordered rules."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """``trigger`` is text that must occur for the rule to be worth a try, letter case as the search."""

    trigger: str | None
    search: str
    replace: str
    case_sensitive: bool = False


# The masking rules, applied in this order.
RULES = (
    Rule("password", r'"password"[ ]*:[ ]*"[^"]+"', '"password": "LOG-REDACTED"'),
    Rule("password", r'password[:=][^ "\\]+', "password=LOG-REDACTED"),
    Rule("passwd", r'passwd[:=][^ "\\]+', "passwd=LOG-REDACTED"),
    Rule("pass", r'pass[:=][^ "\\]+', "pass=LOG-REDACTED"),
    Rule("PASSWORD,", r'PASSWORD,[^"\\]+', "PASSWORD, LOG-REDACTED"),
    Rule("secret", r'secret[:=][^ "\\]+', "secret=LOG-REDACTED"),
    Rule(None, r"\d{4}[^\w:]\d{4}[^\w:]\d{4}[^\w:]\d{4}", "XXXX-XXXX-XXXX-XXXX", True),
    Rule(None, r"\d{3}[^\w:]\d{2}[^\w:]\d{4}", "XXX-XX-XXXX", True),
)


def rules_from(spark: SparkSession, path: str) -> tuple[Rule, ...]:
    """Rules out of a JSON file, ``{"rules": [{"trigger", "search", "replace", "caseSensitive"}, ...]}``, in its order.

    ``trigger`` and ``caseSensitive`` (false) may be left out, other keys are comments. A rule without ``search`` or
    ``replace``, and a pattern that Spark cannot read, stop here and not in a job.
    """
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    listed = json.loads(text).get("rules")
    if not isinstance(listed, list):
        raise ValueError(f"{path} has no list of rules")
    rules = []
    for i, r in enumerate(listed):
        if not isinstance(r, dict) or not r.get("search") or "replace" not in r:
            raise ValueError(f"rule {i} of {path} needs search and replace")
        rules.append(Rule(r.get("trigger") or None, r["search"], r["replace"], bool(r.get("caseSensitive", False))))
    # Patterns are Java's: Spark tries them on one row.
    tried = redact(spark.range(1).select(F.lit("").alias("text")), "text", [r._replace(trigger=None) for r in rules])
    tried.collect()
    return tuple(rules)


def redact(df: DataFrame, column: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``df`` with every rule applied in turn to a text column.

    One projection per rule, because a rule needs the text of the rule before it more than once.
    """
    for rule in rules:
        text = F.col(column)
        search = rule.search if rule.case_sensitive else "(?i)" + rule.search
        replacement = rule.replace.replace("\\", "\\\\").replace("$", "\\$")
        masked = F.regexp_replace(text, F.lit(search), F.lit(replacement))
        if rule.trigger is not None:
            # A plain text search is far cheaper than the pattern on the many rows without a match.
            seen = text if rule.case_sensitive else F.lower(text)
            trigger = rule.trigger if rule.case_sensitive else rule.trigger.lower()
            masked = F.when(F.contains(seen, F.lit(trigger)), masked).otherwise(text)
        df = df.withColumn(column, masked)
    return df
