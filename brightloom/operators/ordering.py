"""Exact ranks, running totals and quantiles without one task per group.

A window over a whole group, and `percentile`/`median`, put a group in a single
task. A group may hold a third of all rows here, so the order is cut into value
ranges, as many as the session has shuffle partitions or more, first: approximate quantiles give the range bounds, totals per range give
where each range starts, and only inside a range is a window used. The results
are exact; the approximate bounds only decide how evenly the work is split.

The bounds are one scalar subquery that Spark runs once and shares between the
branches of a plan.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.session import written

# At least so many ranges, and no fewer than the session has shuffle partitions.
LEAST_RANGES = 256
# One value in so many is looked at to choose the bounds of value ranges.
BOUND_SHARE = 16


def _side(df: DataFrame, ranges: int | None) -> int:
    """Ranges come as side x side, so that a row finds its own with about 2 * side comparisons."""
    wanted = ranges or max(LEAST_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(2, ceil(sqrt(wanted)))


def _with_range(df: DataFrame, order: str, counted: str | None = None, ranges: int | None = None) -> DataFrame:
    """Add `_range`, the index of the value range that `order` falls in.

    The cluster's number of shuffle partitions grows with the data, and the number
    of ranges with it; `ranges` sets another number. `counted` names a positive count column of an aggregated frame. Reading it in
    the bounds keeps the column there, so both branches share the aggregation.
    """
    side = _side(df, ranges)
    shares = F.expr("array(" + ", ".join(f"{k / side / side!r}D" for k in range(1, side * side)) + ")")
    value = F.col(order).cast("double")
    sampled = F.when(F.col(counted) > 0, value) if counted else value
    every_side = F.expr(f"transform(sequence(1, {side - 1}), k -> get(fine, k * {side} - 1))")
    bounds = (
        df.agg(F.percentile_approx(sampled, shares, max(10_000, 40 * side * side)).alias("fine"))
        .select(F.struct("fine", every_side.alias("coarse")))
        .scalar()
    )

    def below(array: Column) -> Column:
        return F.size(F.filter(array, lambda bound: bound < value))

    fine = F.slice(F.col("_bounds.fine"), F.col("_coarse") * side + 1, F.lit(side - 1))
    return (
        df.withColumn("_bounds", bounds)
        .withColumn("_coarse", below(F.col("_bounds.coarse")))
        .withColumn("_range", F.coalesce(F.col("_coarse") * side + below(fine), F.lit(0)))
        .drop("_bounds", "_coarse")
    )


def _range_starts(ranged: DataFrame, by: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Per group and range: the group's totals before it (`_start_x`) and in all (`_total_x`)."""
    sizes = ranged.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_size_{n}") for n, c in sums.items()])
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    columns = {}
    for name in sums:
        columns[f"_start_{name}"] = F.coalesce(F.sum(f"_size_{name}").over(before), F.lit(0))
        columns[f"_total_{name}"] = F.sum(f"_size_{name}").over(whole)
    return sizes.withColumns(columns)


def row_numbers(
    df: DataFrame, order: str, by: Sequence[str] = (), name: str = "row_number", ties: Sequence[str] = (),
    ranges: int | None = None,
) -> DataFrame:
    """Add 1..n per group in the order of a numeric, nearly unique column.

    `ties` settles equal order values. Group keys must not be null.
    """
    ranged = _with_range(df, order, ranges=ranges)
    starts = _range_starts(ranged, by, {"n": F.lit(1).cast("long")})
    inside = Window.partitionBy(*by, "_range").orderBy(order, *ties)
    return (
        ranged.join(starts.select(*by, "_range", "_start_n"), [*by, "_range"])
        .withColumn(name, (F.row_number().over(inside) + F.col("_start_n")).cast("long"))
        .drop("_range", "_start_n")
    )


def composite_row_numbers(
    df: DataFrame, order: Sequence[str | Column], by: Sequence[str] = (), name: str = "row_number",
    total: str | None = None, ranges: int | None = None,
) -> DataFrame:
    """Add 1..n per group in the order of any columns of any type, ascending or descending.

    Rows are placed in ranges of the composite key (group, order) and sorted there,
    so a large group fills many ranges. A row's number is its place in its range
    plus the group's rows in earlier ranges: one small row per range and group.
    Nulls are ordinary keys. Only rows equal in all of `order` must share a range,
    so `order` should end in a nearly unique column. `total` names one more
    column, the size of the group.
    """
    wanted = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*map(F.col, by), *[F.col(c) if isinstance(c, str) else c for c in order]]
    sorted_rows = df.repartitionByRange(wanted, *keys).sortWithinPartitions(*keys)
    # The id is the range in its upper bits and the place inside the range below them.
    placed = written(sorted_rows.withColumn("_place", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("_range", F.shiftright("_place", 33))
    sizes = placed.groupBy(*by, "_range").agg(F.min("_place").alias("first"), F.count(F.lit(1)).alias("n"))
    of_group = sizes.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_range", "first", "n"))).alias("_ranges"))
    # A group has at most as many entries as there are ranges; the running sum is kept in the accumulator.
    sums = F.aggregate(
        "_ranges", F.array(F.lit(0).cast("long")),
        lambda done, r: F.concat(done, F.array(F.element_at(done, -1) + r["n"])),
    )
    starts = of_group.withColumn("_sums", sums).select(
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.element_at("_sums", -1).alias("_total"),
        F.explode(F.arrays_zip("_ranges", F.slice("_sums", F.lit(1), F.size("_ranges")).alias("before"))).alias("_r"),
    ).select(
        *[f"_by{i}" for i in range(len(by))], "_total", F.col("_r._ranges._range").alias("_at"),
        (F.col("_r.before") - F.col("_r._ranges.first")).alias("_shift"),
    )
    same = F.col("_range") == F.col("_at")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    numbered = placed.join(starts, same).withColumn(name, F.col("_place") + F.col("_shift") + 1)
    totals = [F.col("_total").alias(total)] if total else []
    return numbered.select(*[c for c in df.columns if c not in (name, total)], name, *totals)


def running_totals(
    df: DataFrame, order: str, sums: Mapping[str, str], by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Add running totals up to and including each row, and group totals.

    `order` is unique inside a group. `sums` maps an output name to a numeric
    column: output `x` is the running total and `x_total` the total of the group.
    """
    ranged = _with_range(df, order, ranges=ranges)
    starts = _range_starts(ranged, by, {name: F.col(column) for name, column in sums.items()})
    inside = (
        Window.partitionBy(*by, "_range")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    kept = [f"_start_{n}" for n in sums] + [f"_total_{n}" for n in sums]
    joined = ranged.join(starts.select(*by, "_range", *kept), [*by, "_range"])
    return joined.withColumns(
        {name: F.sum(column).over(inside) + F.col(f"_start_{name}") for name, column in sums.items()}
        | {f"{name}_total": F.col(f"_total_{name}") for name in sums}
    ).drop("_range", *kept)


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(group, `column`, `value`) of every number, without nulls, NaN and null groups."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    for key in by:
        df = df.filter(F.col(key).isNotNull())
    return df.select(*by, F.inline(pairs)).filter(F.col("value").isNotNull() & ~F.isnan("value"))


def _column_ranges(long: DataFrame, ranges: int | None) -> DataFrame:
    """Add `_range`: which of the column's value ranges a value falls in.

    The bounds come from one value in BOUND_SHARE, chosen by its hash; they only
    decide how much of a column a range holds.
    """
    side = _side(long, ranges)
    shares = F.expr("array(" + ", ".join(f"{k / side / side!r}D" for k in range(1, side * side)) + ")")
    some = F.pmod(F.xxhash64("value"), F.lit(BOUND_SHARE)) == 0
    every_side = F.expr(f"transform(sequence(1, {side - 1}), k -> get(fine, k * {side} - 1))")
    bounds = (
        long.filter(some).groupBy("column").agg(F.percentile_approx("value", shares, 10_000).alias("fine"))
        .agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("fine", every_side.alias("coarse"))))))
        .scalar()
    )

    def below(array: Column) -> Column:
        return F.coalesce(F.size(F.filter(array, lambda bound: bound < F.col("value"))), F.lit(0))

    fine = F.slice(F.col("_bounds.fine"), F.col("_coarse") * side + 1, F.lit(side - 1))
    # A column with no value among the chosen ones is one range.
    return (
        long.withColumn("_bounds", F.try_element_at(bounds, F.col("column")))
        .withColumn("_coarse", F.greatest(below(F.col("_bounds.coarse")), F.lit(0)))
        .withColumn("_range", F.greatest(F.col("_coarse") * side + F.greatest(below(fine), F.lit(0)), F.lit(0)))
        .drop("_bounds", "_coarse")
    )


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], by: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Linear-interpolated quantiles: one row per group and `column`, array `quantiles`.

    Nulls and NaN are left out. The rows of each value range are counted first, in
    place; only values of ranges that hold a wanted position are shuffled.
    """
    keys = [*by, "column"]
    ranged = _column_ranges(_long(df, columns, by), ranges)
    starts = _range_starts(ranged, keys, {"n": F.lit(1).cast("long")})

    def position(share: float) -> Column:
        return F.lit(float(share)) * (F.col("_total_n") - 1).cast("double")

    wanted = [f(position(s)).cast("long") for s in shares for f in (F.floor, F.ceil)]
    inside_range = F.lit(False)
    for rank in wanted:
        inside_range = inside_range | (
            (rank >= F.col("_start_n")) & (rank < F.col("_start_n") + F.col("_size_n"))
        )
    # A table on disk has a known size: Spark broadcasts it where it is small and joins by key where it is not.
    needed = written(starts.filter(inside_range).select(*keys, "_range", "_start_n", "_total_n"), "needed")
    counts = (
        ranged.join(needed, [*keys, "_range"]).groupBy(*keys, "_range", "value")
        .agg(F.count(F.lit(1)).alias("_n"), F.first("_start_n").alias("_start_n"), F.first("_total_n").alias("_total_n"))
    )
    window = (
        Window.partitionBy(*keys, "_range")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = counts.withColumn("_last", F.sum("_n").over(window) + F.col("_start_n") - 1)
    holds = [
        (rank <= F.col("_last")) & (rank > F.col("_last") - F.col("_n")) for rank in wanted
    ]
    found = ranked.groupBy(*keys).agg(
        F.max("_total_n").alias("_total_n"),
        *[F.max(F.when(h, F.col("value"))).alias(f"_v{i}") for i, h in enumerate(holds)],
    )
    quantiles = []
    for i, share in enumerate(shares):
        low, high = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        part = position(share) - F.floor(position(share))
        quantiles.append(low + (high - low) * part)
    return found.select(*keys, F.array(*quantiles).alias("quantiles"))


def exact_medians(df: DataFrame, columns: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group with a median column per entry of `columns` (source -> output name)."""
    long = exact_quantiles(df, list(columns), [0.5], by)
    return long.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("column") == source, F.get("quantiles", F.lit(0)))).alias(output)
            for source, output in columns.items()
        ]
    )


# Multipliers and sums of Spark's xxhash64.
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(h: np.ndarray, bits: int) -> np.ndarray:
    return (h << np.uint64(bits)) | (h >> np.uint64(64 - bits))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _hash_round(key: str, rounds: int) -> np.ndarray:
    """xxhash64(key, i) for every round i, as Spark hashes a string and an int."""
    i = np.arange(rounds, dtype=np.uint64)
    h = np.full(rounds, xxhash.xxh64_intdigest(key.encode(), 42), np.uint64) + _P5 + np.uint64(4)
    return _mixed(_turned(h ^ (i * _P1), 23) * _P2 + _P3)


def _hash_long(value: np.ndarray, seed: np.uint64) -> np.ndarray:
    """Spark's xxhash64 of longs after what `seed` is the hash of."""
    h = (seed + _P5 + np.uint64(8)) ^ (_turned(value * _P2, 31) * _P1)
    return _mixed(_turned(h, 27) * _P1 + _P4)


def _swapped(x: np.ndarray, size: int, draws: Sequence[int], seeds: np.ndarray) -> np.ndarray:
    """All rounds over a few thousand numbers, so that what they need stays in the processor's cache."""
    inside = bool(((x >= 0) & (x < size)).all())
    for draw, seed in zip(draws, seeds):
        partner = draw - x
        # One size more where it is negative is the remainder, but for numbers outside.
        partner = partner + ((partner >> 63) & size) if inside else np.mod(partner, size)
        chosen = _hash_long(np.maximum(x, partner).view(np.uint64), seed) & np.uint64(1)
        x = x + (partner - x) * chosen.view(np.int64)
    return x


def keyed_permutation(number: Column, size: int, key: str) -> Column:
    """Where a permutation of 0 .. size - 1, fixed by the key, sends `number`.

    Swap-or-not rounds: a round pairs x with k - x (mod size) and swaps a pair or
    not by a hash of its larger member, so every round is a permutation for any
    size and no number is walked back into range. Nothing is shuffled or stored.
    The rounds run over Arrow batches; the hash is that of `xxhash64(key, round, member)`.
    """
    draw = random.Random(f"{key}/{size}")
    rounds = 6 * max(size, 2).bit_length()
    draws = [draw.randrange(max(size, 1)) for _ in range(rounds)]

    @F.arrow_udf("long")
    def sent(numbers: pa.Array) -> pa.Array:
        seeds = _hash_round(key, rounds)
        x = numbers.fill_null(0).to_numpy(zero_copy_only=False)
        out = [_swapped(x[at : at + 8192], size, draws, seeds) for at in range(0, len(x), 8192)]
        missing = numbers.is_null().to_numpy(zero_copy_only=False)
        return pa.array(np.concatenate(out) if out else x, pa.int64(), mask=missing)

    return sent(number.cast("long"))
