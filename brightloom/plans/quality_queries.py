"""Counts, distributions and guards over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.operators import quality
from brightloom.sources import views

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "0-NONE")


def _lines_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines where a zero tax and a zero discount are missing values."""
    return views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("l_discount"),
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("l_returnflag"),
    )


def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(_lines_with_gaps(spark, sf_dir))


def duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated texts, repeated product names and repeated (part, supplier) rows."""
    sources = (
        ("documents.text", views.table(spark, sf_dir, "documents"), ["text"]),
        ("part.p_name", views.table(spark, sf_dir, "part"), ["p_name"]),
        ("lineitem.part_supplier", views.table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"]),
    )
    counted = [
        quality.duplicate_count(df, columns).select(F.lit(name).alias("what"), "duplicates")
        for name, df, columns in sources
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distinct_counts(
        views.table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey", "l_returnflag", "l_quantity"]
    )


def infinite_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Infinite ratios of price to discount and to tax."""
    lines = views.table(spark, sf_dir, "lineitem")

    def ratio(column: str) -> F.Column:
        divided = F.try_divide(F.col("l_extendedprice"), F.col(column))
        return F.coalesce(divided, F.lit(float("inf")))

    return quality.infinite_counts(
        lines.select(ratio("l_discount").alias("per_discount"), ratio("l_tax").alias("per_tax")),
        ["per_discount", "per_tax"],
    )


def value_counts_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = quality.value_counts(views.table(spark, sf_dir, "orders"), "o_orderpriority", True, PRIORITIES)
    return counted.select("o_orderpriority", F.col("position").cast("long"), "count", F.round("share", 4).alias("share"))


def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.shape(views.table(spark, sf_dir, "lineitem"))


def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of each type and their names, beside the number of rows."""
    lines = views.table(spark, sf_dir, "lineitem")
    kinds = F.array(*[
        F.struct(
            F.lit(kind).alias("type"), F.lit(n).cast("long").alias("columns"),
            F.lit(",".join(sorted(c for c, k in lines.dtypes if k == kind))).alias("names"),
        )
        for kind, n in sorted(quality.type_counts(lines).items())
    ])
    return lines.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.inline(kinds))


def boxplot(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = quality.boxplot(views.table(spark, sf_dir, "events"), "value", "event_type")
    return box.select(
        "event_type", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")], "outliers"
    )


def finite_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict casts and the finite guard over prices; one bad value would end the job."""
    lines = views.table(spark, sf_dir, "lineitem")
    checked = lines.select(
        "l_returnflag",
        quality.finite_guard(quality.strict_number(F.col("l_extendedprice").cast("string"))).alias("price"),
    )
    return checked.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("price")
    )


PLANS = {
    "null_counts": (
        null_counts,
        """
        SELECT unnest(['l_orderkey', 'l_tax', 'l_discount', 'l_returnflag']) AS "column",
               unnest([count(*) FILTER (l_orderkey IS NULL), count(*) FILTER (l_tax = 0), count(*) FILTER (l_discount = 0),
                       count(*) FILTER (l_returnflag = 'A')]) AS nulls
        FROM lineitem""",
    ),
    "duplicate_counts": (
        duplicate_counts,
        """
        SELECT 'documents.text' AS what, count(*) - count(DISTINCT text) AS duplicates FROM documents
        UNION ALL SELECT 'part.p_name', count(*) - count(DISTINCT p_name) FROM part
        UNION ALL SELECT 'lineitem.part_supplier', count(*) - count(DISTINCT (l_partkey, l_suppkey)) FROM lineitem""",
    ),
    "distinct_counts": (
        distinct_counts,
        """
        SELECT unnest(['l_partkey', 'l_suppkey', 'l_returnflag', 'l_quantity']) AS "column",
               unnest([count(DISTINCT l_partkey), count(DISTINCT l_suppkey), count(DISTINCT l_returnflag),
                       count(DISTINCT l_quantity)]) AS "distinct"
        FROM lineitem""",
    ),
    "infinite_counts": (
        infinite_counts,
        """
        SELECT unnest(['per_discount', 'per_tax']) AS "column",
               unnest([count(*) FILTER (l_discount = 0), count(*) FILTER (l_tax = 0)]) AS infinite FROM lineitem""",
    ),
    "value_counts_share": (
        value_counts_share,
        f"""
        WITH listed AS (SELECT unnest({list(PRIORITIES)}) AS p, unnest(range(0, {len(PRIORITIES)})) AS position),
        counted AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)
        SELECT p AS o_orderpriority, position, coalesce(n, 0) AS count,
               round(coalesce(n, 0) * 100.0 / (SELECT sum(n) FROM counted), 4)::DOUBLE AS share
        FROM listed LEFT JOIN counted ON o_orderpriority = p""",
    ),
    "type_counts": (
        type_counts,
        """
        WITH kinds AS (
          SELECT CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                   WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS type, column_name
          FROM (SELECT column_type AS data_type, column_name FROM (DESCRIBE lineitem)))
        SELECT (SELECT count(*) FROM lineitem) AS rows, type, count(*) AS columns, string_agg(column_name, ',' ORDER BY column_name) AS names
        FROM kinds GROUP BY type""",
    ),
    "table_shape": (table_shape, "SELECT count(*) AS rows, CAST(11 AS BIGINT) AS columns FROM lineitem"),
    "boxplot": (
        boxplot,
        """
        WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                          quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type)
        SELECT event_type, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median,
               round(any_value(q3), 4) AS q3,
               round(min(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_low,
               round(max(value) FILTER (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 4) AS whisker_high,
               count(*) FILTER (NOT (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS outliers
        FROM events JOIN q USING (event_type) GROUP BY event_type""",
    ),
    "finite_vectors": (
        finite_vectors,
        """
        SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS price
        FROM lineitem GROUP BY l_returnflag""",
    ),
}
