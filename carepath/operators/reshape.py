"""Long to wide and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_measures(
    df: DataFrame,
    measure: str,
    value: str,
    measures: Sequence[str] | Mapping[str, object],
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key with the maximum of each listed measure in its own column.

    Keys default to all other columns. A key whose measures are all unlisted is
    kept with NULLs. The measures are known beforehand, so conditional maxima need
    one exchange where a pivot needs two.
    """
    keys = list(keys or [c for c in df.columns if c not in (measure, value)])
    named = measures if isinstance(measures, Mapping) else {m: m for m in measures}
    return df.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(measure) == F.lit(m), F.col(value))).alias(out)
            for out, m in named.items()
        ]
    )


def unpivot_groups(
    df: DataFrame,
    keys: Sequence[str],
    groups: Mapping[str, Sequence[str]],
    values: Sequence[str],
    label: str,
) -> DataFrame:
    """One row per key and column group, in the given order; NULLs are kept."""
    rows = F.array(
        *[
            F.struct(
                *[F.col(src).alias(out) for src, out in zip(columns, values, strict=True)],
                F.lit(name).alias(label),
            )
            for name, columns in groups.items()
        ]
    )
    return df.select(*keys, F.inline(rows))
