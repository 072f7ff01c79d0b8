"""Transactions to recency-frequency-monetary tables, segments and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.operators import quality
from brightloom.operators.ordering import exact_medians

REQUIRED_COLUMNS = ("CustomerID", "InvoiceDate", "Quantity", "UnitPrice")
FEATURES = ("Recency", "Frequency", "Monetary")

# Actions by the first part of a segment name that matches, in order.
SEGMENT_ACTIONS = (
    (("Champions",), "Reward loyalty; test VIP benefits and retention offers."),
    (("At-Risk",), "Consider a carefully targeted win-back campaign."),
    (("New", "Recent"), "Improve onboarding and encourage a second purchase."),
    (("Dormant",), "Test low-cost re-engagement before investing heavily."),
    (("Regular",), "Test cross-sell or loyalty incentives."),
)
DEFAULT_ACTION = "Test relevant offers and monitor repeat purchases."


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Valid sales only, with `Sales`: lenient casts, no nulls, Quantity > 0, UnitPrice >= 0."""
    quality.require_columns(raw, REQUIRED_COLUMNS)
    cast = raw.withColumns(
        {
            "InvoiceDate": quality.lenient_timestamp(raw, "InvoiceDate"),
            "Quantity": quality.lenient_number(F.col("Quantity")),
            "UnitPrice": quality.lenient_number(F.col("UnitPrice")),
        }
    )
    valid = quality.drop_incomplete(cast, REQUIRED_COLUMNS).filter(
        (F.col("Quantity") > 0) & (F.col("UnitPrice") >= 0)
    )
    return valid.withColumn("Sales", F.col("Quantity") * F.col("UnitPrice"))


def rfm(transactions: DataFrame) -> DataFrame:
    """Recency (days to the day after the last sale of all), Frequency and Monetary per customer."""
    per_customer = (
        transactions.filter(F.col("CustomerID").isNotNull())
        .groupBy("CustomerID")
        .agg(
            F.max(F.to_date("InvoiceDate")).alias("LastDay"),
            F.count(F.lit(1)).alias("Frequency"),
            F.sum("Sales").alias("Monetary"),
        )
    )
    # The maximum is taken over whole structs: all three columns stay in the
    # subquery, which makes its exchange the same as the main one and lets
    # Spark run the join and aggregation below it once.
    newest = per_customer.agg(F.max(F.struct("LastDay", "Frequency", "Monetary"))["LastDay"]).scalar()
    table = per_customer.select(
        "CustomerID",
        F.date_diff(F.date_add(newest, 1), "LastDay").alias("Recency"),
        "Frequency",
        quality.finite_or_null(F.col("Monetary")).alias("Monetary"),
    )
    return table.filter((F.col("Recency") >= 0) & (F.col("Frequency") > 0) & (F.col("Monetary") >= 0))


def segment_name(recent: Column, frequent: Column, high_value: Column) -> Column:
    """Segment by three yes/no marks; the first match counts."""
    return (
        F.when(recent & frequent & high_value, "Champions / High Value")
        .when(~recent & frequent & high_value, "At-Risk High Value")
        .when(recent & ~frequent, "Recent / New Customers")
        .when(frequent, "Regular Customers")
        .when(~recent & ~high_value, "Dormant / Low Engagement")
        .otherwise("Occasional Customers")
    )


def segment_action(segment: Column) -> Column:
    action = F.lit(DEFAULT_ACTION)
    for parts, text in reversed(SEGMENT_ACTIONS):
        matches = F.lit(False)
        for part in parts:
            matches = matches | F.contains(segment, F.lit(part))
        action = F.when(matches, text).otherwise(action)
    return action


def overall_medians(table: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """One row of exact medians, `median_<column>` each."""
    return exact_medians(table, {c: f"median_{c}" for c in columns})


def _against_medians(df: DataFrame, table: DataFrame, r: str, f: str, m: str) -> DataFrame:
    medians = overall_medians(table).select(F.struct("*")).scalar()
    return df.withColumn("_overall", medians).withColumn(
        "Segment",
        segment_name(
            F.col(r) <= F.col("_overall.median_Recency"),
            F.col(f) >= F.col("_overall.median_Frequency"),
            F.col(m) >= F.col("_overall.median_Monetary"),
        ),
    ).drop("_overall")


def segment_customers(table: DataFrame) -> DataFrame:
    """Segment of each customer by its own values against the overall medians."""
    return _against_medians(table, table, *FEATURES)


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Size, means and exact medians per cluster, rounded half-even to two places, and its segment.

    A segment name that two clusters share gets ` (Cluster k)` on each of them.
    """
    means = clustered.groupBy("Cluster").agg(
        F.count("CustomerID").alias("Customers"),
        *[F.bround(F.avg(c), 2).alias(f"Avg{c}") for c in FEATURES],
    )
    medians = exact_medians(clustered, {c: f"Median{c}" for c in FEATURES}, ["Cluster"]).select(
        "Cluster", *[F.bround(f"Median{c}", 2).alias(f"Median{c}") for c in FEATURES]
    )
    named = _against_medians(
        means.join(medians, "Cluster"), clustered, "MedianRecency", "MedianFrequency", "MedianMonetary"
    )
    shared = F.count(F.lit(1)).over(Window.partitionBy("Segment")) > 1
    numbered = F.concat("Segment", F.lit(" (Cluster "), F.col("Cluster").cast("string"), F.lit(")"))
    return named.withColumn("Segment", F.when(shared, numbered).otherwise(F.col("Segment")))


def attach_segments(clustered: DataFrame, profile: DataFrame) -> DataFrame:
    """Segment name per customer, looked up in a map of the few clusters."""
    names = profile.agg(F.map_from_entries(F.collect_list(F.struct("Cluster", "Segment")))).scalar()
    return clustered.withColumn("Segment", F.try_element_at(names, F.col("Cluster")))


def segment_actions(profile: DataFrame) -> DataFrame:
    return profile.select(
        "Cluster", "Segment", "AvgRecency", "AvgFrequency", "AvgMonetary",
        segment_action(F.col("Segment")).alias("Action"),
    )


def segment_heatmap(segmented: DataFrame) -> DataFrame:
    """Segment means standardised across segments; a spread of 0 counts as 1."""
    means = segmented.groupBy("Segment").agg(*[F.avg(c).alias(c) for c in FEATURES])
    spread = means.agg(
        F.struct(*[F.avg(c).alias(f"m{c}") for c in FEATURES],
                 *[F.stddev_pop(c).alias(f"s{c}") for c in FEATURES])
    ).scalar()
    return means.withColumn("_spread", spread).select(
        "Segment",
        *[
            (
                (F.col(c) - F.col(f"_spread.m{c}"))
                / F.when(F.col(f"_spread.s{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_spread.s{c}"))
            ).alias(c)
            for c in FEATURES
        ],
    )


def business_summary(segmented: DataFrame, silhouette: float | None = None) -> DataFrame:
    """One row: customers, revenue, mean revenue, largest segment (lowest cluster on ties), k and, if given, the silhouette.

    Aggregated per cluster first, so the final step sees k rows.
    """
    known = [F.lit(float(silhouette)).alias("silhouette")] if silhouette is not None else []
    per_cluster = segmented.groupBy("Cluster", "Segment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Monetary").alias("revenue")
    )
    return per_cluster.agg(
        F.sum("n").alias("customers"),
        F.sum("revenue").alias("total_revenue"),
        (F.sum("revenue") / F.sum("n")).alias("average_revenue"),
        F.max_by("Segment", F.struct(F.col("n"), -F.col("Cluster"))).alias("largest_segment"),
        F.count(F.lit(1)).alias("clusters"),
        *known,
    )
