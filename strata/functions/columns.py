"""Small column helpers: blank tests, status category, output normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, TimestampType

# The Unicode White_Space code points.  Blank means empty or
# made only of these, so a tab or a no-break space is blank as well as a
# plain space (plain ``trim`` strips spaces only).
WHITE_SPACE = "".join(
    chr(c)
    for c in (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)


def is_blank(col: Column) -> Column:
    """True when null or blank; never null itself.  ``trim`` with a
    character set stays inside generated code (no regex)."""
    return col.isNull() | (F.trim(col, F.lit(WHITE_SPACE)) == "")


def not_blank(col: Column) -> Column:
    return ~is_blank(col)


def status_category(warning: Column, status: Column) -> Column:
    """warning non-blank -> 'warning'; else status non-blank -> 'ok'; else 'unknown'."""
    return (
        F.when(not_blank(warning), F.lit("warning"))
        .when(not_blank(status), F.lit("ok"))
        .otherwise(F.lit("unknown"))
    )


def wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall-clock values without zone, arrays of text joined
    with '; ', bytes as text: the shape used for comparing results with an
    outside SQL engine.  Needs the session zone pinned to UTC."""
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, ArrayType):
            c = F.array_join(c, "; ")
        elif isinstance(field.dataType, BinaryType):
            c = c.cast("string")
        cols.append(c.alias(field.name))
    return df.select(*cols)
