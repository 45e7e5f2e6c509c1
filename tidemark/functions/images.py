"""Row images: content-hash identity and images that carry it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import jsontext
from tidemark.model import ROW_ID


def is_nested(image: str) -> str:
    """May a value be an object or a list? Never wrongly no: the text is compact."""
    return f"(contains({image}, ':{{') or contains({image}, ':['))"


def has_inner_repeats(image: str) -> str:
    """Does an object inside the image repeat a key? Top-level repeats are resolved, these are not.

    The variant reader refuses such an object, the plain reader does not.
    """
    refused = f"{jsontext.as_map(image)} is not null and {jsontext.as_map(image, 'variant')} is null"
    return f"if({is_nested(image)}, {refused}, false)"


def add_row_id(df: DataFrame, image: str, when: str) -> DataFrame:
    """Give the ``image`` column a row id where the SQL condition ``when`` holds; adds ``<image>_id``.

    The id is the MD5 of the image printed as a map. It becomes the first key of the image; an id
    the image already has wins, even a null one. Repeated keys keep their first place and last value.
    """
    keys = "map_keys(_entries)"
    distinct_keys = f"array_distinct({keys})"
    kinds = jsontext.as_map(image, "variant")
    has_id = f"array_contains({keys}, '{ROW_ID}')"
    id_first = f"concat(array('{ROW_ID}'), array_remove({distinct_keys}, '{ROW_ID}'))"
    # The object with repeats resolved. Rare, so its cost is only paid by the rows that need it.
    single = f"if(_repeats, {jsontext.rebuild(distinct_keys, '_entries', kinds)}, {image})"
    text = f"""CASE
      WHEN _repeats THEN {jsontext.map_text('_single')}
      WHEN {is_nested(image)} THEN {jsontext.map_text(image)}
      ELSE {jsontext.flat_map_text('_entries', image)} END"""
    with_hash = f"""concat('{{"{ROW_ID}":"', _hash, if(_single = '{{}}', '"', '",'), substring(_single, 2))"""
    enriched = f"if({has_id}, {jsontext.rebuild(id_first, '_entries', kinds)}, {with_hash})"
    own_id = jsontext.last_value("_entries", ROW_ID)
    return (
        df.withColumn("_entries", F.expr(f"if({when}, {jsontext.as_map(image)}, null)"))
        .withColumn("_repeats", F.expr(f"size({distinct_keys}) < size({keys})"))
        .withColumn("_single", F.expr(single))
        .withColumn("_hash", F.expr(f"if(_entries is null, null, md5({text}))"))
        .withColumns(
            {
                f"{image}_id": F.expr(f"if({has_id}, {own_id}, _hash)"),
                image: F.expr(f"if(_entries is null, {image}, {enriched})"),
            }
        )
        .drop("_entries", "_repeats", "_single", "_hash")
    )
