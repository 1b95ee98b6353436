"""Array and box arithmetic as column expressions; doubles throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(a: Column) -> Column:
    return a.cast("array<double>")


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def rounded(x: Column, digits: int = 4) -> Column:
    """A double of no great size rounded by its exact binary value, exact ties to even (``round`` goes by its shortest decimals, half up)."""
    ten = float(10**digits)
    m = F.floor(x * ten).cast("double")
    # twice x as two halves whose products with a power of ten are exact
    split = x * F.lit(134217729.0)
    high = split - (split - x)
    over = (high * (2 * ten) - (2 * m + 1)) + (x - high) * (2 * ten)
    return (m + F.when((over > 0) | ((over == 0) & (m % 2 == 1)), 1.0).otherwise(0.0)) / ten


def cosine(a: Column, b: Column) -> Column:
    """0 where a norm is 0."""
    n = norm(a) * norm(b)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.try_divide(dot(a, b), n))


def relative_l2(a: Column, b: Column) -> Column:
    """|b - a| / |a|, infinite where ``a`` has norm 0."""
    n = norm(a)
    return F.when(n == 0, F.lit(float("inf"))).otherwise(F.try_divide(norm(F.zip_with(b, a, lambda x, y: x - y)), n))


def feature_change(a: Column, b: Column) -> Column:
    """Relative change of two feature arrays, or of their norms where the lengths differ."""
    return F.when(F.size(a) == F.size(b), relative_l2(a, b)).otherwise(F.coalesce(F.try_divide(F.abs(norm(b) - norm(a)), norm(a)), F.lit(float("inf"))))


def max_difference(a: Column, b: Column) -> Column:
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def mean(a: Column) -> Column:
    return F.try_divide(total(a), F.size(a))


def deviation(a: Column) -> Column:
    """Population standard deviation."""
    m = mean(a)
    return F.sqrt(F.try_divide(total(F.transform(a, lambda x: (x - m) * (x - m))), F.size(a)))


def max_abs(a: Column) -> Column:
    return F.array_max(F.transform(a, lambda x: F.abs(x)))


def standardised(a: Column, centre: Column, spread: Column) -> Column:
    return F.zip_with(F.zip_with(a, centre, lambda x, m: x - m), spread, lambda x, s: F.try_divide(x, s))


def blend(original: Column, edited: Column, strength: float) -> Column:
    return F.zip_with(original, edited, lambda o, e: o + F.lit(strength) * (e - o))


def symmetric_ratio(a: Column, b: Column, otherwise: float = 999.0) -> Column:
    return F.when((a > 0) & (b > 0), F.try_divide(F.greatest(a, b), F.least(a, b))).otherwise(F.lit(otherwise))


def low_high_ratio(a: Column, b: Column) -> Column:
    return F.when(F.greatest(a, b) > 0, F.try_divide(F.least(a, b), F.greatest(a, b))).otherwise(F.lit(1.0))


def box_iou(lo_a, hi_a, lo_b, hi_b) -> Column:
    """Overlap of two boxes given as triples of columns. A box's sides count at least 1, the intersection's do not."""

    def product(columns):
        made = columns[0]
        for c in columns[1:]:
            made = made * c
        return made

    inter = product([F.greatest(F.least(h, k) - F.greatest(x, y), F.lit(0)) for x, h, y, k in zip(lo_a, hi_a, lo_b, hi_b)])
    one, two = (product([F.greatest(h - x, F.lit(1)) for x, h in zip(lo, hi)]) for lo, hi in ((lo_a, hi_a), (lo_b, hi_b)))
    union = one + two - inter
    return F.when(union > 0, F.try_divide(inter.cast("double"), union)).otherwise(F.lit(0.0))


def elevation(x: Column, y: Column, z: Column) -> Column:
    r = F.sqrt(x * x + y * y + z * z)
    return F.degrees(F.asin(F.try_divide(z, r)))


def azimuth(x: Column, y: Column) -> Column:
    return F.degrees(F.atan2(y, x))


def pixel_id(red: Column, green: Column) -> Column:
    return red + 256 * green


def judge_score(executed: Column, region: Column, preserved: Column, quality: Column, clean: Column) -> Column:
    """The weighted verdict of a judge, four decimals."""
    flag = lambda c: c.cast("double")
    return F.round(0.3 * flag(executed) + 0.2 * flag(region) + 0.2 * flag(preserved) + 0.2 * F.greatest(F.lit(0), quality - 1) / 4 + 0.1 * flag(clean), 4)


def judge_tier(executed: Column, region: Column, preserved: Column, quality: Column, clean: Column, rejected: Column) -> Column:
    return (
        F.when(rejected, "rejected")
        .when(~executed | ~region, "negative")
        .when(preserved & clean & (quality >= 4), "high")
        .when(preserved & clean & (quality >= 3), "medium")
        .when(quality >= 2, "low")
        .otherwise("negative")
    )
