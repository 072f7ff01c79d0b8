"""Casts, guards, counts and distributions of any table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, NumericType, TimestampNTZType, TimestampType

from brightloom.operators.ordering import exact_quantiles
from brightloom.session import written

_INFINITY = float("inf")


def lenient_number(column: Column) -> Column:
    """Number or null."""
    return column.try_cast("double")


def lenient_timestamp(df: DataFrame, name: str) -> Column:
    """Timestamp or null; typed columns are only cast."""
    typed = isinstance(df.schema[name].dataType, (TimestampType, TimestampNTZType, DateType))
    return F.col(name).cast("timestamp") if typed else F.try_to_timestamp(F.col(name))


def strict_number(column: Column) -> Column:
    """Number; a bad value ends the job (ANSI cast)."""
    return column.cast("double")


def finite_or_null(column: Column) -> Column:
    """NaN and the infinities become null."""
    number = column.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != F.lit(_INFINITY)), column)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a null or NaN in the columns; one filter each, so they reach the scans."""
    kept = df
    for name in columns:
        kept = kept.filter(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            kept = kept.filter(~F.isnan(name))
    return kept


def column_difference(expected: Iterable[str], actual: Iterable[str]) -> tuple[list[str], list[str]]:
    """(missing, unexpected), both sorted."""
    wanted, present = set(expected), set(actual)
    return sorted(wanted - present), sorted(present - wanted)


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing, _ = column_difference(required, df.columns)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def require_exact_columns(df: DataFrame, expected: Sequence[str], ignore: Iterable[str] = ()) -> DataFrame:
    """Fail on missing or unexpected columns."""
    missing, extra = column_difference(expected, set(df.columns) - set(ignore))
    if missing or extra:
        raise ValueError(f"Missing features: {missing}; unexpected features: {extra}")
    return df


def finite_guard(column: Column) -> Column:
    """The value itself; a null, NaN or infinite value ends the job."""
    number = column.cast("double")
    good = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(_INFINITY))
    return F.when(good, number).otherwise(
        F.raise_error(F.lit("All feature values must be finite numbers.")).cast("double")
    )


def require_rows(df: DataFrame, at_least: int, message: str) -> DataFrame:
    """Fail unless there are `at_least` rows; reads no more rows than that."""
    if df.limit(at_least).count() < at_least:
        raise ValueError(message)
    return df


def code_labels(code: Column, names: Mapping[int, str]) -> Column:
    """Class name of a numeric code; null for an unknown one."""
    label = F.lit(None).cast("string")
    for value, name in names.items():
        label = F.when(code == value, name).otherwise(label)
    return label


def inspect_record(df: DataFrame, order_by: str, limit: int = 10) -> DataFrame:
    """First `limit` columns of the first row as (position, name, value) rows."""
    shown = df.columns[:limit]
    pairs = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
        for i, c in enumerate(shown, start=1)
    ]
    return df.orderBy(order_by).limit(1).select(F.inline(F.array(*pairs)))


def _as_rows(aggregated: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias(value)) for c in columns]
    return aggregated.select(F.inline(F.array(*pairs)))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, in one pass."""
    return _as_rows(
        df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]), df.columns, "nulls"
    )


def infinite_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    found = [F.count_if(F.abs(F.col(c)) == F.lit(_INFINITY)).alias(c) for c in columns]
    return _as_rows(df.agg(*found), columns, "infinite")


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column.

    The exact form counts each (column, value) pair once, so that one value
    spread over many rows is merged before the shuffle.
    """
    if approximate:
        counted = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return _as_rows(counted, columns, "distinct")
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*pairs)))
        .distinct()
        .groupBy("column")
        .agg(F.count("value").alias("distinct"))
    )


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each equal group."""
    grouped = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return grouped.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("long").alias("columns"))


def type_counts(df: DataFrame) -> dict[str, int]:
    """How many columns have each type; known from the schema."""
    counts: dict[str, int] = {}
    for _, kind in df.dtypes:
        counts[kind] = counts.get(kind, 0) + 1
    return counts


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def value_counts(
    df: DataFrame, column: str, share: bool = False, expected: Sequence[str] | None = None
) -> DataFrame:
    """Rows per value, optionally with the percentage and with absent values as 0."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    if expected is not None:
        listed = [F.struct(F.lit(v).alias(column), F.lit(i).alias("position")) for i, v in enumerate(expected)]
        frame = df.sparkSession.range(1).select(F.inline(F.array(*listed)))
        counted = frame.join(counted, column, "left").select(
            column, "position", F.coalesce("count", F.lit(0)).cast("long").alias("count")
        )
    if share:
        total = counted.agg(F.sum("count")).scalar()
        counted = counted.withColumn("share", F.col("count") * F.lit(100.0) / total)
    return counted


def ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: smallest and largest value per column; text that is no number is left out."""
    bounds = []
    for name in columns:
        number = lenient_number(F.col(name))
        bounds += [F.min(number).alias(f"min_{name}"), F.max(number).alias(f"max_{name}")]
    return df.agg(*bounds)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std (sample), min, quartiles (interpolated) and max per column.

    The moments of all columns are one aggregation without a shuffle of values; the
    quartiles ship only the value ranges they lie in.
    """
    numbers = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    totals = df.agg(
        *[F.struct(*[f(v).cast("double").alias(n) for n, f in measures.items()]).alias(c) for c, v in numbers.items()]
    )
    moments = totals.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(c)[n].alias(n) for n in measures]) for c in columns]))
    )
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column",
        *[F.get("quantiles", F.lit(i)).alias(name) for i, name in enumerate(["q25", "q50", "q75"])],
    )
    # A column without numbers keeps its row, with count 0 and nulls.
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows per equal-width bin over min..max; the last bin holds the maximum.

    A constant column is spread over half a unit to each side.
    """
    value = F.col(column).cast("double")
    kept = df.filter(value.isNotNull() & ~F.isnan(value))
    limits = kept.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("limits"))
    low, high = F.col("limits")["low"], F.col("limits")["high"]
    flat = low == high
    edges = limits.select(
        F.when(flat, low - F.lit(0.5)).otherwise(low).cast("double").alias("low"),
        F.when(flat, high + F.lit(0.5)).otherwise(high).cast("double").alias("high"),
    )
    span = edges.select(F.struct("low", "high")).scalar()
    bin_of = F.least(F.width_bucket(value, span["low"], span["high"], F.lit(bins)), F.lit(bins).cast("long"))
    counts = kept.groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    return (
        edges.select("low", "high", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(bins).cast("long"))).alias("bin"))
        .join(counts, "bin", "left")
        .select(
            "bin",
            (F.col("low") + (F.col("bin") - 1) * width).alias("from"),
            (F.col("low") + F.col("bin") * width).alias("to"),
            F.coalesce("count", F.lit(0)).cast("long").alias("count"),
        )
    )


def boxplot(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles, and whiskers at the last values within 1.5 interquartile ranges."""
    quartiles = exact_quantiles(df, [value], [0.25, 0.5, 0.75], [by]).select(
        by, *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(["q1", "median", "q3"])]
    )
    # Written, so that Spark knows its size and broadcasts it only where it is small.
    quartiles = written(quartiles, "quartiles")
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    near = (F.col(value) >= F.col("q1") - reach) & (F.col(value) <= F.col("q3") + reach)
    return (
        df.select(by, F.col(value).cast("double").alias(value))
        .join(quartiles, by)
        .groupBy(by)
        .agg(
            F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
            F.min(F.when(near, F.col(value))).alias("whisker_low"),
            F.max(F.when(near, F.col(value))).alias("whisker_high"),
            F.count_if(~near).alias("outliers"),
        )
    )


def melt(df: DataFrame, id_column: str, columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(id_column, list(columns), name, value)
