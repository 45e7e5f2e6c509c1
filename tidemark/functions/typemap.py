"""Source column classes as Spark types."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values: (text in the source class name, whether case matters, target type). The first rule
# that matches decides; text is the default. DECIMAL takes the column's precision and scale.
TYPE_RULES = (
    ("java.lang.String", True, "STRING"),
    ("java.math.BigDecimal", True, "DECIMAL"),
    ("java.sql.Timestamp", True, "DATE"),
    ("oracle.sql.TIMESTAMP", True, "TIMESTAMP_NTZ"),
    ("timestamp", False, "TIMESTAMP_NTZ"),
    ("Float", True, "FLOAT"),
    ("Double", True, "DOUBLE"),
    ("OracleClob", True, "STRING"),
    ("OracleBlob", True, "STRING"),
    ("OracleNClob", True, "STRING"),
    ("INTERVALYM", True, "TIMESTAMP_NTZ"),
    ("INTERVALDS", True, "TIMESTAMP_NTZ"),
    ("[B", True, "BINARY"),
)
DEFAULT_TYPE = "STRING"
# Numbers the source reports without a usable precision or scale.
UNSCALED = "DECIMAL(38,10)"

# Lossless alternatives to the rules above, chosen with ``native=True``.
NATIVE_TYPES = {
    "java.sql.Timestamp": "TIMESTAMP_NTZ",
    "OracleBlob": "BINARY",
    "INTERVALYM": "INTERVAL YEAR TO MONTH",
    "INTERVALDS": "INTERVAL DAY TO SECOND",
}


def spark_type(class_name: Column, precision: Column, scale: Column, *, native: bool = False) -> Column:
    """Spark type text for a source column, as a Column over metadata rows."""
    usable = (precision > 0) & (precision <= 38) & (scale >= 0) & (scale <= precision)
    decimal = F.when(
        usable, F.concat(F.lit("DECIMAL("), precision, F.lit(","), scale, F.lit(")"))
    ).otherwise(UNSCALED)
    result = None
    for text, case_matters, target in TYPE_RULES:
        name = class_name if case_matters else F.lower(class_name)
        target = NATIVE_TYPES.get(text, target) if native else target
        value = decimal if target == "DECIMAL" else F.lit(target)
        test = F.contains(name, F.lit(text))
        result = F.when(test, value) if result is None else result.when(test, value)
    return result.otherwise(DEFAULT_TYPE)


def parse_cell(text: Column, target: T.DataType) -> Column:
    """A cell's text as its column type, null when it does not fit."""
    if isinstance(target, T.StringType):
        return text
    if isinstance(target, T.DateType):
        # Dates arrive with a time of day, which the target type does not hold.
        return F.substring(text, 1, 10).try_cast(target)
    if isinstance(target, T.BinaryType):
        return F.try_to_binary(text, F.lit("base64"))
    return text.try_cast(target)


def is_cut(text: Column, scale: int) -> Column:
    """Has a number's text digits behind those that ``scale`` keeps? Exponents move the point."""
    exponent = F.coalesce(F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int"), F.lit(0))
    fraction = F.regexp_replace(F.regexp_extract(text, r"\.(\d+)", 1), "0+$", "")
    whole = F.regexp_extract(text, r"^-?(\d+)", 1)
    zeros = F.length(F.regexp_extract(whole, "(0*)$", 1))
    # Places behind the point: of a fraction all its digits, of a whole number none or, with an exponent, less.
    places = F.when(F.length(fraction) > 0, F.length(fraction)).when(F.coalesce(whole.rlike("^0*$"), F.lit(True)), -400).otherwise(-zeros) - exponent
    cut = F.coalesce(places > scale, F.lit(False))
    # Most numbers have no exponent and no more characters behind the point than that: no pattern is needed for those.
    point = F.instr(text, ".")
    kept = ~F.contains(text, F.lit("E")) & ((point == 0) | (F.length(text) - point <= scale))
    return F.when(text.isNull() | kept, False).otherwise(cut) if scale >= 0 else cut


def parse_type(text: str) -> T.DataType:
    """The Spark type a type text names."""
    return T.DataType.fromDDL(re.sub(r"\s+", " ", text.strip()))
