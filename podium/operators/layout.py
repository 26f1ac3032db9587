"""Rows laid out so that files can be passed over by their statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.functions.names import column

CURVE = "_curve"


def quantile_bounds(df: DataFrame, names: Sequence[str], parts: int, accuracy: int = 10_000) -> list[list]:
    """For each column `parts` - 1 values or fewer, in order, that part its rows evenly.

    One pass, with sketches whose size depends on `accuracy` alone; nulls do not count.
    """
    shares = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    sketches = [F.percentile_approx(column(name), shares, F.lit(accuracy)).alias(f"b{i}") for i, name in enumerate(names)]
    found = df.agg(*sketches).first()
    return [sorted(set(row)) if row is not None else [] for row in found]


def rank_in(name: str, bounds: Sequence) -> Column:
    """How many of `bounds` the value is not below, nulls first: equal steps of rows and not of values.

    The bounds are searched by halves, so a row is compared with few of them.
    """

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(column(name) < F.lit(bounds[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return F.when(column(name).isNull(), F.lit(0)).otherwise(search(0, len(bounds)))


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of several ranks in turn, from the highest: near in all ranks is near on this curve."""
    terms = []
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            one = F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            terms.append(F.shiftleft(one, bit * len(ranks) + len(ranks) - 1 - i))
    return reduce(lambda a, b: a.bitwiseOR(b), terms)


def along_curve(df: DataFrame, names: Sequence[str], files: int, bits: int | None = None) -> DataFrame:
    """`df` in `files` partitions along a space-filling curve through the columns `names`, sorted in each.

    Written as it is, a file holds a small range of every one of the columns, so a filter on any of
    them, and most of all on several, passes over most files by their smallest and largest values. A
    plain sort does that for its first column only. The curve goes by ranks in sampled quantiles, so
    uneven columns are parted evenly too. A column has 2 to the power `bits` ranks; for None, so many
    that there are some dozens of places on the curve for each file. Spark samples the curve for the
    bounds of the partitions; rows of one place on the curve go to one partition.
    """
    if bits is None:
        bits = min(12, -(-(max(1, files).bit_length() + 6) // len(names)))
    bounds = quantile_bounds(df, names, 1 << bits)
    ranks = {f"{CURVE}{i}": rank_in(name, own) for i, (name, own) in enumerate(zip(names, bounds))}
    placed = df.withColumns(ranks).withColumn(CURVE, interleaved([F.col(name) for name in ranks], bits))
    return placed.repartitionByRange(files, CURVE).sortWithinPartitions(CURVE).drop(CURVE, *ranks)
