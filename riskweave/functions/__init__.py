"""Column expressions (JVM-side, codegen-friendly; no Python UDFs).

Rounding note.  Spark's ``round`` rounds the *decimal rendering* of a double
half-up, other engines round the binary value, so ``round(631/800, 4)`` is
0.7888 in Spark and 0.7887 elsewhere.  Published numbers use the forms
below, which are built only from IEEE operations every engine evaluates
identically (``floor``, ``*``, ``+``, ``/``) or from exact integer arithmetic,
so any SQL engine reproduces them bit for bit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------- math
def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` with NULL for a zero (or NULL) denominator.

    Spark 4 is ANSI by default (``1/0`` raises); the reference ran on a
    non-ANSI Spark where the quotient was NULL — ``try_divide`` keeps that.
    """
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def round_half_up(x: ColumnOrName, digits: int) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` — engine-independent rounding."""
    scale = float(10 ** digits)
    return F.floor(_c(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def ratio_half_up(num: ColumnOrName, den: ColumnOrName, digits: int) -> Column:
    """Exact HALF_UP rounding of the rational ``num/den`` (integer inputs).

    ``(2*num*10^d + den) div (2*den) / 10^d`` — pure integer arithmetic, so
    it is the true decimal rounding of the fraction, identical in every
    engine.  NULL when ``den`` is 0 or NULL.  Inputs must be non-negative.
    """
    scale = 10 ** digits
    n, d = _c(num).cast("long"), _c(den).cast("long")
    # CASE evaluates the branch only when the guard holds, so ``div`` never
    # sees a zero divisor
    q = F.call_function("div", n * F.lit(2 * scale) + d, d * F.lit(2))
    return F.when(d != 0, q / F.lit(float(scale)))


def clamp(x: ColumnOrName, lo: float, hi: float) -> Column:
    """``max(lo, min(hi, x))``; NULL stays NULL."""
    return F.when(_c(x).isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), _c(x))))


def logistic(score: ColumnOrName, base: float | None = None) -> Column:
    """``1 / (1 + e^-score)``; with ``base``, ``1 / (1 + base^-score)``."""
    decay = F.exp(-_c(score)) if base is None else F.pow(F.lit(float(base)), -_c(score))
    return F.lit(1.0) / (F.lit(1.0) + decay)


def scaled_long(x: ColumnOrName, digits: int) -> Column:
    """A value already rounded to ``digits`` as an exact integer count of units.

    Averages of published (rounded) values are summed in this form so that
    the sum does not depend on row order (float sums do).
    """
    return F.floor(_c(x) * F.lit(float(10 ** digits)) + F.lit(0.5)).cast("long")


# --------------------------------------------------------------- predicates
_OPS = {
    "lt": lambda c, t: c < F.lit(t),
    "le": lambda c, t: c <= F.lit(t),
    "gt": lambda c, t: c > F.lit(t),
    "ge": lambda c, t: c >= F.lit(t),
    "eq": lambda c, t: c == F.lit(t),
    "ne": lambda c, t: c != F.lit(t),
    "eq0": lambda c, t: c == F.lit(0),
}


def flag(col: ColumnOrName, op: str, threshold=None) -> Column:
    """1.0 when ``col <op> threshold`` holds, else 0.0 (NULL compares false)."""
    try:
        cond = _OPS[op](_c(col), threshold)
    except KeyError as exc:
        raise ValueError(f"unknown flag operator {op!r}; one of {sorted(_OPS)}") from exc
    return F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0))


def band(col: ColumnOrName, thresholds: Sequence[float], names: Sequence[str]) -> Column:
    """Ordered CASE banding: first ``col >= thresholds[i]`` wins, else last name.

    ``thresholds`` must be descending and ``len(names) == len(thresholds)+1``.
    """
    if len(names) != len(thresholds) + 1:
        raise ValueError("need exactly one more band name than thresholds")
    if list(thresholds) != sorted(thresholds, reverse=True):
        raise ValueError("thresholds must be in descending order")
    c = _c(col)
    expr = None
    for t, name in zip(thresholds, names):
        expr = (F.when(c >= F.lit(t), F.lit(name)) if expr is None
                else expr.when(c >= F.lit(t), F.lit(name)))
    return expr.otherwise(F.lit(names[-1]))


# --------------------------------------------------------------------- hash
def hash_bucket(key: ColumnOrName, buckets: int = 100) -> Column:
    """Stable bucket in ``[0, buckets)`` from the md5 of the key's text.

    Unlike ``randomSplit`` it does not depend on partitioning, AQE or the
    number of tasks, and any engine with md5 computes the same bucket:
    the first 24 bits of the hex digest, modulo ``buckets``.
    """
    hex6 = F.substring(F.md5(_c(key).cast("string")), 1, 6)
    return (F.conv(hex6, 16, 10).cast("long") % F.lit(buckets)).cast("int")


# --------------------------------------------------------------------- text
def percent_text(x: ColumnOrName, decimals: int = 1) -> Column:
    """``x`` as a percentage with exactly ``decimals`` digits, e.g. ``12.3%``.

    Built from the integer ``floor(x * 10^(2+d) + 0.5)`` so it is exact and
    engine-independent (printf-style formatting rounds ties differently in
    the JVM and in C).  Non-negative inputs.
    """
    units = F.floor(_c(x) * F.lit(float(10 ** (2 + decimals))) + F.lit(0.5)).cast("long")
    if decimals == 0:
        return F.concat(units.cast("string"), F.lit("%"))
    whole = F.floor(units / F.lit(10 ** decimals)).cast("long")
    frac = F.lpad((units % F.lit(10 ** decimals)).cast("string"), decimals, "0")
    return F.concat(whole.cast("string"), F.lit("."), frac, F.lit("%"))


def short_percent_text(x: ColumnOrName) -> Column:
    """``x*100`` rounded to 2 places, shortest decimal form, plus ``%``.

    Mirrors the table display of the original application (``12.5%``,
    ``12.0%``, ``12.05%``): trailing zeros are dropped but one decimal stays.
    """
    units = F.floor(_c(x) * F.lit(10000.0) + F.lit(0.5)).cast("long")
    whole = F.floor(units / F.lit(100)).cast("long").cast("string")
    frac = units % F.lit(100)
    tail = (F.when(frac == 0, F.lit("0"))
            .when(frac % 10 == 0, (frac / 10).cast("long").cast("string"))
            .otherwise(F.lpad(frac.cast("string"), 2, "0")))
    return F.concat(whole, F.lit("."), tail, F.lit("%"))


def thousands_text(x: ColumnOrName, sep: str = ".") -> Column:
    """Integer with a thousands separator (``1.234.567``)."""
    return F.translate(F.format_number(_c(x).cast("long"), 0), ",", sep)


__all__ = [
    "ratio", "round_half_up", "ratio_half_up", "clamp", "logistic", "scaled_long",
    "flag", "band", "hash_bucket", "percent_text", "short_percent_text", "thousands_text",
]
