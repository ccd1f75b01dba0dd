"""Exact grouped median by radix selection: no group, however large or wide, meets in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

EXACT = "decimal(28,10)"
# Digits of a value after its exponent, and how many of them there are.
DIGIT_BITS = 12
DIGITS = 2
BEYOND = 5000  # in place of the exponent of infinities; those of doubles are smaller


def digits(value: Column) -> list[Column]:
    """Numbers that order values as the values do, the coarsest first: exponent, then slices of the mantissa.

    They belong to the value as a double; none decreases while the value grows, and there are a
    few thousand different ones of each for one value of those before.
    """
    number = value.cast("double")
    size, sign = F.abs(number), F.signum(number).cast("long")
    finite = (size > 0) & (size < float("inf"))
    exponent = F.floor(F.log2(F.when(finite, size)))
    fraction = F.when(finite, size) / F.pow(F.lit(2.0), exponent)
    # One more than the least exponent, so that the sign orders the exponents of small values too.
    first = F.when(size == 0, 0).when(finite, sign * (exponent + 1100)).when(F.isnan(number), BEYOND + 1).otherwise(sign * BEYOND)
    rest = [
        F.coalesce(sign * F.floor(fraction * float(1 << DIGIT_BITS * k)), F.lit(0)) for k in range(1, DIGITS + 1)
    ]
    return [first, *rest]


def grouped_median(
    counted: DataFrame, keys: list[str], value: str, weight: str, exact: str | None = EXACT
) -> DataFrame:
    """Median of `value` per group, where each row stands for `weight` rows.

    Callers count equal values first, so a group shrinks to its distinct values before it
    is shuffled. The middle is then found digit by digit: rows are summed per group and digit, a
    few thousand sums at most, which tell the digit that holds the middle (or the two digits that
    hold its two rows); only rows with it go on. What is left after the last digit is sorted by value. The result
    (column `median`) is the mean of the two middle values, in the type `exact`, or as a double
    if that is None; NULL values and rows of weight 0
    do not count. They are weighed out instead of filtered: a filter would sink below the
    callers' count and make a second scan and shuffle of it.
    """
    names = [f"_digit{i}" for i in range(DIGITS + 1)]
    rows = counted.withColumns(
        {
            **{n: F.coalesce(digit, F.lit(0)) for n, digit in zip(names, digits(F.col(value)))},
            "_weight": F.when(F.col(value).isNotNull(), F.col(weight)).otherwise(0),
        }
    )
    here = rows
    for depth, digit in enumerate(names):
        path = names[:depth]
        bounds = ["_before", "_low", "_high"] if depth else []
        sums = here.groupBy(*keys, *path, digit, *bounds).agg(F.sum("_weight").alias("_rows")).filter("_rows > 0")
        group = Win.partitionBy(*keys, *path)
        sums = sums.withColumn("_inside", F.sum("_rows").over(group.orderBy(digit)))
        if not depth:
            total = F.sum("_rows").over(group)
            sums = sums.withColumns(
                {"_before": F.lit(0), "_low": F.floor((total + 1) / 2), "_high": F.floor(total / 2) + 1}
            )
        middle = (
            sums.withColumn("_upto", F.col("_before") + F.col("_inside"))
            .withColumn("_from", F.col("_upto") - F.col("_rows"))
            .filter((F.col("_from") < F.col("_high")) & (F.col("_upto") >= F.col("_low")))
        ).select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(n).alias(f"_at{n}") for n in [*path, digit]],
            F.col("_from").alias("_before"), "_low", "_high",
        )
        plain = here.drop(*bounds)
        same = reduce(
            lambda a, b: a & b,
            [plain[k].eqNullSafe(middle[f"_k{i}"]) for i, k in enumerate(keys)]
            + [plain[n] == middle[f"_at{n}"] for n in [*path, digit]],
        )
        here = plain.join(middle, same).select(*[plain[c] for c in plain.columns], "_before", "_low", "_high")
    in_slice = Win.partitionBy(*keys, *names).orderBy(value)
    ranked = here.withColumn("_last", F.col("_before") + F.sum("_weight").over(in_slice)).withColumn(
        "_first", F.col("_last") - F.col("_weight") + 1
    )

    def value_at(place: str) -> Column:
        found = F.min(F.when(F.col(place).between(F.col("_first"), F.col("_last")), F.col(value)))
        return found.cast(exact) if exact else found.cast("double") / 2

    low, high = value_at("_low"), value_at("_high")
    return ranked.groupBy(*keys).agg(((low + high) / 2 if exact else low + high).alias("median"))
