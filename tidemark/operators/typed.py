"""Row images as typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import typemap


#: A double holds every number of so many digits.
SURE_DIGITS = 15


def typed_rows(
    df: DataFrame, schema: T.StructType, *, image: str = "image", keep: Sequence[str] = (), exact: str | None = None
) -> DataFrame:
    """The columns of ``schema`` out of each row's image, plus the columns in ``keep``.

    A cell that does not fit its type becomes null and is counted in ``bad_cells``; it never stops
    the job. A column that ``keep`` already brings is not read from the image. The image is parsed
    once for all columns; a single selected column is all that is read of it.

    Numbers in an image's text have gone through a double. ``exact`` names a column with the image whose numbers have all their
    digits; decimal columns are read from there. ``lossy_cells`` counts decimal cells that are not what the source
    sent, or may not be: cut to the column's scale, or of more digits than a double surely holds where no exact
    image has them.
    """
    fields = [f for f in schema.fields if f.name not in keep]
    # Without reader options, so that Spark can narrow the parse. Images were read strictly before.
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    decimals = [f.name for f in fields if isinstance(f.dataType, T.DecimalType)]
    columns = [F.from_json(image, as_text).alias("_cells")]
    if exact and decimals:
        numbers = T.StructType([T.StructField(c, T.VariantType()) for c in decimals])
        columns.append(F.from_json(exact, numbers).alias("_numbers"))
    cells = df.select(*keep, *columns)
    typed, bad, lossy = [], F.lit(0), F.lit(0)
    for field in fields:
        text = F.col("_cells").getField(field.name)
        if field.name in decimals:
            through_double = F.col("_cells").getField(field.name)
            if exact:
                number = F.col("_numbers").getField(field.name)
                text = F.coalesce(F.try_variant_get(number, "$", "string"), through_double)
                through_double = F.when(F.schema_of_variant(number).isin("DOUBLE", "FLOAT") | number.isNull(), text)
            loss = typemap.is_cut(text, field.dataType.scale) | _many_digits(through_double)
            lossy = lossy + F.coalesce(loss & typemap.parse_cell(text, field.dataType).isNotNull(), F.lit(False)).cast("int")
        cell = typemap.parse_cell(text, field.dataType)
        typed.append(cell.alias(field.name))
        if not isinstance(field.dataType, T.StringType):
            bad = bad + (text.isNotNull() & cell.isNull()).cast("int")
    return cells.select(*keep, *typed, bad.alias("bad_cells"), lossy.alias("lossy_cells"))


def typed_variants(df: DataFrame, schema: T.StructType, *, row: str = "row", keep: Sequence[str] = ()) -> DataFrame:
    """The columns of ``schema`` out of each row's variant, plus the columns in ``keep``; the counters as in :func:`typed_rows`.

    Nested values come as compact JSON text.
    """
    typed, bad, lossy = [], F.lit(0), F.lit(0)
    for field in (f for f in schema.fields if f.name not in keep):
        value = F.try_variant_get(row, f'$["{field.name}"]', "variant")
        text = F.try_variant_get(value, "$", "string")
        cell = typemap.parse_cell(text, field.dataType)
        typed.append(cell.alias(field.name))
        if isinstance(field.dataType, T.DecimalType):
            double = F.when(F.schema_of_variant(value).isin("DOUBLE", "FLOAT"), text)
            loss = typemap.is_cut(text, field.dataType.scale) | _many_digits(double)
            lossy = lossy + F.coalesce(loss & cell.isNotNull(), F.lit(False)).cast("int")
        if not isinstance(field.dataType, T.StringType):
            bad = bad + F.coalesce(text.isNotNull() & cell.isNull(), F.lit(False)).cast("int")
    return df.select(*keep, *typed, bad.alias("bad_cells"), lossy.alias("lossy_cells"))


def _many_digits(number: Column) -> Column:
    """Has a number more digits than a double surely holds? Whole numbers without an exponent never were one."""
    digits = F.regexp_replace(F.regexp_replace(number, r"E.*$", ""), r"[-.]|\.0$", "")
    digits = F.regexp_replace(digits, "^0+|0+$", "")
    many = F.coalesce(number.rlike(r"[.E]") & (F.length(digits) > SURE_DIGITS), F.lit(False))
    return F.when(number.isNull() | (F.length(number) <= SURE_DIGITS), False).otherwise(many)
