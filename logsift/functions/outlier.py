"""Outlier expressions; bounds are columns (usually from a 1-row stats frame)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iqr_bounds(q1, q3, k: float):
    q1, q3 = _col(q1), _col(q3)
    iqr = q3 - q1
    return q1 - F.lit(k) * iqr, q3 + F.lit(k) * iqr


def iqr_flag(c, q1, q3, k: float = 3.0, guard: bool = True) -> Column:
    """Strictly outside [q1-k*iqr, q3+k*iqr]; with guard, iqr=0 flags nothing."""
    lo, hi = iqr_bounds(q1, q3, k)
    x = _col(c)
    flag = F.coalesce((x < lo) | (x > hi), F.lit(False))
    if guard:
        flag = flag & F.coalesce((_col(q3) - _col(q1)) != 0, F.lit(False))
    return flag


def zscore_flag(c, mean, sd, t: float = 3.0) -> Column:
    """|c-mean|/sd > t; false when sd is 0 or null."""
    z = F.abs(F.try_divide(_col(c) - _col(mean), _col(sd)))
    return F.coalesce((z > t) & (_col(sd) != 0), F.lit(False))


def clip(c, lo, hi) -> Column:
    """Null-preserving clip (greatest/least skip nulls, so guard)."""
    x = _col(c).cast("double")
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(F.least(x, _col(hi)), _col(lo)))
