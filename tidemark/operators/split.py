"""Updates as a delete and an insert, and the outgoing message text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import model as M
from tidemark.functions import jsontext
from tidemark.model import ROW_ID


def split_updates(changes: DataFrame, *, order: str = "delete_first") -> DataFrame:
    """One row per change, two for an update (``u`` exactly): its delete and its insert.

    ``seq`` orders the two. ``"delete_first"`` keeps a row whose update changed nothing;
    ``"create_first"`` removes it, because both sides then have the same id. The two sides carry
    neither ``rid`` nor ``sql``. ``AUTO_MD5_ID`` is the id of the image each row carries.
    """
    if order not in ("delete_first", "create_first"):
        raise ValueError(f"unknown order: {order}")
    delete_seq, create_seq = (0, 1) if order == "delete_first" else (1, 0)
    no_text = F.lit(None).cast("string")

    def side(seq: int, op: Column, rid: Column, before: Column, after: Column, sql: Column, row_id: Column) -> Column:
        return F.struct(
            F.lit(seq).alias("seq"),
            op.alias("op"),
            rid.alias("rid"),
            before.alias("before"),
            after.alias("after"),
            sql.alias("sql"),
            row_id.alias(ROW_ID),
        )

    before, after = F.col("before"), F.col("after")
    delete = side(delete_seq, F.lit(M.DELETE), no_text, before, no_text, no_text, F.col("before_id"))
    create = side(create_seq, F.lit(M.INSERT), no_text, no_text, after, no_text, F.col("after_id"))
    # A row that is not split carries the id of the image its operation uses.
    own_id = F.coalesce("after_id", "before_id")
    same = side(0, F.col("op"), F.col("rid"), before, after, F.col("sql"), own_id)

    sides = (delete, create) if delete_seq == 0 else (create, delete)
    rows = F.when(F.col("op").eqNullSafe(M.UPDATE), F.array(*sides)).otherwise(F.array(same))
    replaced = ("op", "rid", "before", "after", "sql", "before_id", "after_id")
    kept = [c for c in changes.columns if c not in replaced]
    return changes.select(*kept, F.inline(rows))


def exact_image(image: str) -> Column:
    """An image whose numbers have all their digits, with the row id that the image in double form has; else that image."""
    exact, plain = F.col(f"{image}_exact"), F.col(image)
    # A hash is cut out of the text; an image is searched for an id of another form only, and parsed for one of its own only if its text names one.
    start = f'{{"{ROW_ID}":"'
    hashed = plain.rlike("^" + re.escape(start) + '[0-9a-f]{32}"')
    found = F.to_json(F.get_json_object(image, f"$.{ROW_ID}").cast("variant"))
    row_id = F.when(hashed, F.substring(plain, len(start), 34)).otherwise(found)
    has_id = F.contains(exact, F.lit(ROW_ID)) & F.array_contains(F.json_object_keys(exact), ROW_ID)
    with_id = F.concat(F.lit(f'{{"{ROW_ID}":'), row_id, F.lit(","), F.substring(exact, F.lit(2), F.length(exact)))
    with_id = F.when(exact == "{}", plain).otherwise(with_id)
    return F.when(exact.isNull(), plain).when(has_id | row_id.isNull(), exact).otherwise(with_id)


def target_value(exact: bool = False) -> Column:
    """Message text with the fields in their fixed order, absent ones as null.

    Images are spliced in as they are, so their key order and number spelling survive; with ``exact``,
    those that have all digits.
    """
    before, after = (exact_image(c) if exact else F.col(c) for c in ("before", "after"))
    keep_nulls = {"ignoreNullFields": "false"}
    head = F.to_json(F.struct("op", "schema", "row", "rid"), keep_nulls)
    return F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1),
        F.lit(',"before":'),
        F.coalesce(F.when(F.col("before").isNotNull(), before), F.lit("null")),
        F.lit(',"after":'),
        F.coalesce(F.when(F.col("after").isNotNull(), after), F.lit("null")),
        F.lit(',"sql":'),
        F.expr(jsontext.quoted("sql")),
        F.lit("}"),
    )


def to_messages(split: DataFrame, topic: Column) -> DataFrame:
    """Split changes as outgoing messages, keyed by row id so that a row stays in one partition.

    Changes that were read with exact images send those.
    """
    columns = set(split.columns)
    pos = F.col("pos") if "pos" in columns else F.lit(0).cast("bigint")
    return split.select(
        topic.alias("topic"),
        F.col(ROW_ID).alias("key"),
        target_value("after_exact" in columns).alias("value"),
        "scn",
        pos.alias("pos"),
        "seq",
    )


def decode_changelog(messages: DataFrame, *, on_bad: str = "fail", exact: bool = False) -> DataFrame:
    """Read outgoing messages back as row changes: ``+I``, ``-U``, ``+U`` or ``-D`` with an image.

    ``c`` and ``r`` insert, ``d`` deletes, ``u`` gives both sides. A message with another operation
    or without the image it needs stops the job; with ``on_bad="skip"`` it is left out, with
    ``on_bad="keep"`` it is a row without kind whose image is the whole text. With ``exact`` the numbers of an
    image keep their digits and its keys are sorted; else numbers have double form.
    """
    if on_bad not in ("fail", "skip", "keep"):
        raise ValueError(f"unknown on_bad: {on_bad}")
    images = ("before", "after")
    kinds = _PAYLOAD.replace("before string, after string", "before variant, after variant") if exact else _PAYLOAD
    payload = F.from_json("value", kinds, jsontext.STRICT)
    kept = [c for c in messages.columns if c not in ("value", "seq")]
    seq = F.col("seq") if "seq" in messages.columns else F.lit(0)
    p = lambda name: F.to_json(_present(f"_p.{name}")) if exact and name in images else F.col(f"_p.{name}")

    def row(kind: str, step: int, image: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), (F.coalesce(seq, F.lit(0)) * 2 + step).alias("seq"), image.alias("image")
        )

    op = p("op")
    complete = (
        (op.isin(M.INSERT, M.SNAPSHOT_READ) & p("after").isNotNull())
        | ((op == M.DELETE) & p("before").isNotNull())
        | ((op == M.UPDATE) & p("before").isNotNull() & p("after").isNotNull())
    )
    rows = (
        F.when(op.isin(M.INSERT, M.SNAPSHOT_READ), F.array(row("+I", 0, p("after"))))
        .when(op == M.DELETE, F.array(row("-D", 0, p("before"))))
        .otherwise(F.array(row("-U", 0, p("before")), row("+U", 1, p("after"))))
    )
    parsed = messages.withColumn("_p", payload)
    if on_bad == "skip":
        parsed = parsed.filter(F.coalesce(complete, F.lit(False)))
    elif on_bad == "keep":
        unread = F.array(F.struct(F.lit(None).cast("string").alias("kind"), seq.cast("int").alias("seq"), F.col("value").alias("image")))
        rows = F.when(F.coalesce(complete, F.lit(False)), rows).otherwise(unread)
    else:
        stop = F.raise_error(F.concat(F.lit("not a row change: "), F.coalesce("value", F.lit("null"))))
        rows = F.when(F.coalesce(complete, F.lit(False)), rows).otherwise(stop)
    return parsed.select(*kept, p("schema").alias("schema"), F.inline(rows))


def _present(image: str) -> Column:
    """A variant column, a variant that holds null as null."""
    return F.when(~F.coalesce(F.is_variant_null(image), F.lit(True)), F.col(image))


_PAYLOAD = (
    "op string, schema struct<owner:string,table:string>, row string, rid string, "
    "before string, after string, sql string"
)
