"""Scalar expressions: names, flags, segments and bucket labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Day names by order_dow, 0 first.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

# Product segments by (wide reach, high loyalty).
CORE = "core"
MAINSTREAM = "mainstream"
POTENTIAL = "potential"
BOOST = "boost"

# Department segments in report order.
DEPARTMENT_SEGMENTS = ("magnet", "accessible", "sticky", "plain")

# Cart position bucket names, first to last.
POSITION_BUCKETS = ("1. Very Early", "2. Early", "3. Middle", "4. Middle-Late", "5. Late")

# Flagged-pair types.
BOTH_FLAGGED = "Both Organic"
NONE_FLAGGED = "Both Non-Organic"
MIXED_FLAGGED = "Mixed Organic and Non-Organic"


def day_name(dow: Column) -> Column:
    """Name of a day number; null outside 0..6."""
    return F.get(F.array(*[F.lit(day) for day in DAY_NAMES]), dow.cast("int"))


def has_token(name: Column, token: str, case: bool = False) -> Column:
    """Whether a name holds the token; letter case counts only on request."""
    return name.contains(token) if case else F.lower(name).contains(token.lower())


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def quadrant(wide: Column, loyal: Column, names: tuple[str, str, str, str]) -> Column:
    """One of four names by two conditions; unknown (null) conditions give the last."""
    both, wide_only, loyal_only, neither = names
    return (
        F.when(wide & loyal, both)
        .when(wide & ~loyal, wide_only)
        .when(~wide & loyal, loyal_only)
        .otherwise(neither)
    )


def pair_type(flag_a: Column, flag_b: Column) -> Column:
    both = flag_a + flag_b
    return (
        F.when(both == 2, BOTH_FLAGGED).when(both == 0, NONE_FLAGGED).otherwise(MIXED_FLAGGED)
    )


def position_names(cuts: int) -> tuple[str, ...]:
    """Bucket names for a number of cuts: the fixed ones for four, numbered parts otherwise."""
    if cuts < 1:
        raise ValueError("at least one cut is needed")
    if cuts + 1 == len(POSITION_BUCKETS):
        return POSITION_BUCKETS
    return tuple(f"{place}. Part {place} of {cuts + 1}" for place in range(1, cuts + 2))


def position_bucket(position: Column, cuts: list[Column], names: tuple[str, ...]) -> Column:
    """Label of the first cut the position does not exceed, else the open last bucket."""
    if len(names) != len(cuts) + 1:
        raise ValueError(f"{len(cuts)} cuts make {len(cuts) + 1} buckets, not {len(names)}")

    def text(name: str, sign: str, cut: Column) -> Column:
        return F.concat(F.lit(f"{name} ({sign}"), cut.cast("int").cast("string"), F.lit(")"))

    within = [F.when(position <= cut, text(name, "<=", cut)) for name, cut in zip(names, cuts)]
    return F.coalesce(*within, text(names[-1], ">", cuts[-1]))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded percentage as double; null when the whole is zero."""
    return F.round(F.try_divide(part * F.lit(100.0), whole.cast("double")), digits)


def ratio(part: Column, whole: Column) -> Column:
    """Plain ratio as double; null when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
