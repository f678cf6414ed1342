"""Column expressions shared by the operators.

All of them are built-in Spark expressions: they stay inside whole-stage
codegen and never call back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: str | Column) -> Column:
    """Seconds since 1970-01-01 as DOUBLE (the canonical listen time)."""
    return F.unix_timestamp(_col(ts)).cast("double")


def canonical_id(mbid: str | Column, msid: str | Column) -> Column:
    """The song id: the MusicBrainz id when present, else the listen's msid."""
    return F.coalesce(_col(mbid), _col(msid))


def min_max_scale(x: str | Column, lo: Column, hi: Column) -> Column:
    """``(x - lo) / (hi - lo)``; a zero range yields 0.0 instead of an error."""
    return F.coalesce(F.try_divide(_col(x) - lo, hi - lo), F.lit(0.0))


def hash_point(key: str | Column) -> Column:
    """A stable point in ``[0, 1)`` of a key: the first 52 bits of its md5.

    The same in SQL: ``('0x' || substr(md5(text), 1, 13))::BIGINT / 2^52``.
    """
    digits = F.substring(F.md5(_col(key).cast("string").cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(1 << 52))


def dcg_gain(pos: str | Column) -> Column:
    """Binary-relevance gain at 0-based position ``pos``: ``1 / ln(pos + 2)``."""
    return F.lit(1.0) / F.log(_col(pos) + F.lit(2))


def gain_sum(start: str | Column, count: str | Column) -> Column:
    """``sum(1 / ln(start + j + 2) for j in range(count))``; 0.0 when count <= 0.

    Used with ``count <= k`` only, so the summed sequence is bounded by k.
    """
    start, count = _col(start), _col(count)
    return F.when(count <= 0, F.lit(0.0)).otherwise(
        F.aggregate(
            F.sequence(F.lit(0).cast("bigint"), (count - 1).cast("bigint")),
            F.lit(0.0),
            lambda acc, j: acc + F.lit(1.0) / F.log(start + j + F.lit(2)),
        )
    )


def ideal_dcg(n: str | Column) -> Column:
    """Ideal binary DCG of ``n`` relevant items: ``gain_sum(0, n)``."""
    return gain_sum(F.lit(0), n)


# Below this bound 1/i is summed term by term; above it the Euler-Maclaurin
# series of H is used, whose truncation error there is under 1e-17.
_HARMONIC_SERIES_FROM = 64


def _harmonic_series_gap(a: Column, b: Column) -> Column:
    """``H(b) - H(a)`` for ``a >= 64`` by the asymptotic series of H.

    ``H(n) = ln n + gamma + 1/(2n) - 1/(12 n^2) + 1/(120 n^4) - 1/(252 n^6)``;
    the difference is formed term by term so nothing cancels.
    """
    a, b = a.cast("double"), b.cast("double")

    def term(coef: float, power: int) -> Column:
        return F.lit(coef) / F.pow(b, power) - F.lit(coef) / F.pow(a, power)

    return F.log1p((b - a) / a) + term(0.5, 1) - term(1 / 12, 2) + term(1 / 120, 4) - term(1 / 252, 6)


def harmonic_gap(a: str | Column, b: str | Column) -> Column:
    """``H(b) - H(a) = sum(1/i for i in a+1..b)`` for ``0 <= a <= b``.

    At most 64 terms are summed one by one (those below 64); the rest of the
    range, however long, comes from the series, so the cost is constant.
    """
    a, b = _col(a), _col(b)
    mid = F.greatest(a, F.lit(_HARMONIC_SERIES_FROM))
    upto = F.least(b, mid)
    exact = F.when(upto <= a, F.lit(0.0)).otherwise(
        F.aggregate(
            F.sequence((a + 1).cast("bigint"), upto.cast("bigint")),
            F.lit(0.0),
            lambda acc, i: acc + F.lit(1.0) / i,
        )
    )
    return exact + F.when(b > mid, _harmonic_series_gap(mid, b)).otherwise(F.lit(0.0))
