"""Small-number suppression and the display of counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Counts below the threshold are published as the mark.
THRESHOLD = 7
MARK = "*"


def round_count(c: Column | str) -> Column:
    """Nearest whole number, halves away from zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 0)


def display(c: Column | str, digits: int | None = 0) -> Column:
    """Number as text without exponent or needless decimals."""
    c = F.col(c) if isinstance(c, str) else c
    if digits == 0:
        return F.round(c, 0).cast("bigint").cast("string")
    if digits is None:
        return F.regexp_replace(c.cast("decimal(38,12)").cast("string"), r"\.?0+$|(\.\d*?)0+$", "$1")
    return F.round(c, digits).cast(f"decimal(38,{digits})").cast("string")


def suppressed(
    c: Column | str, threshold: float = THRESHOLD, mark: str = MARK, digits: int | None = 0
) -> Column:
    """The mark below the threshold (zero too), else the number as text; NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c < threshold, F.lit(mark)).otherwise(display(c, digits))


def suppress(
    df: DataFrame,
    columns: Sequence[str],
    threshold: float = THRESHOLD,
    mark: str = MARK,
    digits: int | None = 0,
) -> DataFrame:
    return df.withColumns({c: suppressed(c, threshold, mark, digits) for c in columns})
