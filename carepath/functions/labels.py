"""Turning codes and free text into labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key(c: Column | str) -> Column:
    """Join key under a case- and trailing-space-insensitive collation."""
    return F.upper(F.rtrim(_col(c).cast("string")))


def recode(c: Column | str, mapping: Mapping, otherwise: Column | str | None = None) -> Column:
    """Value lookup; unknown values give ``otherwise`` (NULL when None)."""
    c = _col(c)
    out = None
    for old, new in mapping.items():
        out = (F if out is None else out).when(c == F.lit(old), F.lit(new))
    if out is None:
        raise ValueError("recode needs at least one entry")
    if otherwise is None:
        return out
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def recode_or_keep(c: Column | str, mapping: Mapping) -> Column:
    return recode(c, mapping, otherwise=_col(c))


def group_codes(c: Column | str, groups: Mapping[str, Sequence], default: str | None) -> Column:
    """Label of the group whose code list holds the value."""
    c = _col(c)
    out = F
    for label, codes in groups.items():
        out = out.when(c.isin(list(codes)), F.lit(label))
    return out.otherwise(F.lit(default))


def group_text(c: Column | str, patterns: Sequence[tuple[str, str]], default: str | None) -> Column:
    """First pattern contained in the text wins; case-insensitive."""
    text = F.lower(_col(c))
    out = F
    for needle, label in patterns:
        out = out.when(text.contains(needle.lower()), F.lit(label))
    return out.otherwise(F.lit(default))


def code_title(code: Column | str, title: Column | str, separator: str = ": ") -> Column:
    """'code: title', or NULL unless both parts are present."""
    code, title = _col(code), _col(title)
    both = code.isNotNull() & title.isNotNull()
    return F.when(both, F.concat(code.cast("string"), F.lit(separator), title.cast("string")))


def order_label(
    event: Column | str,
    reference: Column | str,
    after: str,
    before: str,
    none: str,
) -> Column:
    """Whether an event came on/after or before a reference date, or not at all."""
    event, reference = _col(event).cast("date"), _col(reference).cast("date")
    return F.when(event >= reference, after).when(event < reference, before).otherwise(none)
