"""Transaction cleaning, RFM tables, segments."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.operators import clusters, customers, quality
from brightloom.operators.silhouette import silhouette_euclid
from brightloom.plans.sqltext import CLUSTERED, RFM, segment_case, with_ctes
from brightloom.sources import views


def rfm_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.rfm(customers.clean_transactions(views.transactions(spark, sf_dir)))


def kept_rfm_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in memory and on disk, for queries that read it several times.

    It has one row per customer, while the order lines behind it are read once.
    """
    return rfm_table(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)


def clustered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFM with a fixed cluster per customer, so that profiles can be checked in SQL."""
    return kept_rfm_table(spark, sf_dir).withColumn("Cluster", (F.col("CustomerID") % 4).cast("int"))


def tx_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = customers.clean_transactions(views.raw_transactions(spark, sf_dir))
    return cleaned.select(
        F.col("CustomerID").cast("long").alias("CustomerID"),
        F.date_format("InvoiceDate", "yyyy-MM-dd").alias("InvoiceDay"),
        "Quantity",
        "UnitPrice",
        "Sales",
    )


def rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm_table(spark, sf_dir).select(
        "CustomerID", F.col("Recency").cast("long"), "Frequency", F.round("Monetary", 2).alias("Monetary")
    )


def rfm_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.segment_customers(kept_rfm_table(spark, sf_dir)).select(
        "CustomerID", F.col("Recency").cast("long"), "Frequency", F.round("Monetary", 2).alias("Monetary"), "Segment"
    )


def segment_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = customers.cluster_profile(clustered_table(spark, sf_dir))
    return profile.select(
        F.col("Cluster").cast("long"), "Customers", "AvgRecency", "MedianRecency", "AvgFrequency",
        "MedianFrequency", "AvgMonetary", "MedianMonetary", "Segment",
    ).orderBy(F.desc("Customers"), "Cluster")


def segment_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = customers.cluster_profile(clustered_table(spark, sf_dir))
    return customers.segment_actions(profile).withColumn("Cluster", F.col("Cluster").cast("long"))


def segment_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = clustered_table(spark, sf_dir)
    segmented = customers.attach_segments(table, customers.cluster_profile(table))
    return customers.segment_heatmap(segmented).select(
        "Segment", *[F.round(c, 5).alias(c) for c in customers.FEATURES]
    )


def business_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = clustered_table(spark, sf_dir)
    segmented = customers.attach_segments(table, customers.cluster_profile(table))
    labelled = clusters.scaled_features(table).select("Cluster", _scaled_vector())
    found = silhouette_euclid(labelled, len(customers.FEATURES), error=1e-6).first()["silhouette"]
    return customers.business_summary(segmented, found).select(
        "customers", F.round("total_revenue", 2).alias("total_revenue"),
        F.round("average_revenue", 2).alias("average_revenue"), "largest_segment", "clusters",
        F.round("silhouette", 4).alias("silhouette"),
    )


def _scaled_vector() -> Column:
    return F.array(*[F.col(f"scaled_{c}") for c in customers.FEATURES]).alias("vector")


def silhouettes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Euclidean silhouettes of three labellings of all customers, worked out together."""
    scaled = clusters.scaled_features(rfm_table(spark, sf_dir))
    labels = F.array(*[F.struct(F.lit(k).alias("k"), (F.col("CustomerID") % k).cast("int").alias("Cluster")) for k in (2, 3, 5)])
    found = silhouette_euclid(scaled.select(_scaled_vector(), F.inline(labels)), len(customers.FEATURES), ["k"], error=1e-6)
    return found.select(F.col("k").cast("long"), F.round("silhouette", 4).alias("silhouette"))


def describe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = customers.clean_transactions(views.transactions(spark, sf_dir))
    stats = quality.describe(sales, ["Quantity", "UnitPrice", "Sales"])
    return stats.select("column", *[F.round(c, 7).alias(c) for c in stats.columns[1:]])


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.histogram(rfm_table(spark, sf_dir), "Frequency", 40).select(
        "bin", F.round("from", 4).alias("from"), F.round("to", 4).alias("to"), "count"
    )


def record_inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First five columns of the customer with the lowest number."""
    numbers = rfm_table(spark, sf_dir).select("CustomerID", F.col("Recency").cast("long"), "Frequency")
    return quality.inspect_record(numbers, "CustomerID", 5).withColumn("position", F.col("position").cast("long"))


_DESCRIBE = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS "column", CAST(count({c}) AS DOUBLE) AS count, round(avg({c}), 7) AS mean,
  round(stddev_samp({c}), 7) AS std, round(min({c}), 7) AS min, round(quantile_cont({c}, 0.25), 7) AS q25,
  round(quantile_cont({c}, 0.5), 7) AS q50, round(quantile_cont({c}, 0.75), 7) AS q75, round(max({c}), 7) AS max
FROM sales"""
    for c in ("Quantity", "UnitPrice", "Sales")
)

def _silhouettes_sql(ks: str) -> str:
    """Silhouettes of CustomerID % k over all pairs of customers."""
    logged = {c: f"ln(1 + greatest({c}, 0))" for c in customers.FEATURES}
    vector = ", ".join(f"({v} - avg({v}) OVER ()) / stddev_pop({v}) OVER ()" for v in logged.values())
    return f""",
scaled AS (SELECT CustomerID, [{vector}] AS x FROM rfm),
labelled AS (SELECT k, CustomerID AS id, CustomerID % k AS c, x FROM scaled, (SELECT unnest({ks}) AS k)),
sums AS (
  SELECT a.k, a.id, a.c, b.c AS o, sum(list_distance(a.x, b.x)) AS t, count(*) AS n
  FROM labelled a JOIN labelled b ON a.k = b.k GROUP BY 1, 2, 3, 4),
ab AS (
  SELECT k, id, max(CASE WHEN o = c THEN t / nullif(n - 1, 0) END) AS a, min(CASE WHEN o <> c THEN t / n END) AS b
  FROM sums GROUP BY 1, 2),
silhouettes AS (
  SELECT CAST(k AS BIGINT) AS k, round(avg(coalesce((b - a) / nullif(greatest(a, b), 0), 0)), 4) AS silhouette FROM ab GROUP BY k)"""


PLANS = {
    "tx_clean": (
        tx_clean,
        """
        SELECT o_custkey AS CustomerID, strftime(o_orderdate, '%Y-%m-%d') AS InvoiceDay,
               l_quantity AS Quantity, l_extendedprice / l_quantity AS UnitPrice,
               l_quantity * (l_extendedprice / l_quantity) AS Sales
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag <> 'R' AND o_orderstatus <> 'P' AND l_quantity > 0 AND l_extendedprice >= 0""",
    ),
    "rfm": (
        rfm,
        with_ctes(RFM, "SELECT CustomerID, Recency, Frequency, round(Monetary, 2) AS Monetary FROM rfm"),
    ),
    "rfm_segments": (
        rfm_segments,
        with_ctes(
            RFM,
            f"""SELECT CustomerID, Recency, Frequency, round(Monetary, 2) AS Monetary,
                {segment_case("Recency", "Frequency", "Monetary")} AS Segment
            FROM rfm, (SELECT median(Recency) AS r, median(Frequency) AS f, median(Monetary) AS m FROM rfm)""",
        ),
    ),
    "segment_profile": (segment_profile, with_ctes(CLUSTERED, "SELECT * FROM profile")),
    "segment_actions": (
        segment_actions,
        with_ctes(
            CLUSTERED,
            """SELECT Cluster, Segment, AvgRecency, AvgFrequency, AvgMonetary,
            CASE WHEN contains(Segment, 'Champions') THEN 'Reward loyalty; test VIP benefits and retention offers.'
                 WHEN contains(Segment, 'At-Risk') THEN 'Consider a carefully targeted win-back campaign.'
                 WHEN contains(Segment, 'New') OR contains(Segment, 'Recent')
                   THEN 'Improve onboarding and encourage a second purchase.'
                 WHEN contains(Segment, 'Dormant') THEN 'Test low-cost re-engagement before investing heavily.'
                 WHEN contains(Segment, 'Regular') THEN 'Test cross-sell or loyalty incentives.'
                 ELSE 'Test relevant offers and monitor repeat purchases.' END AS Action
            FROM profile""",
        ),
    ),
    "segment_heatmap": (
        segment_heatmap,
        with_ctes(
            CLUSTERED
            + """,
        seg AS (SELECT Segment, avg(Recency) AS a, avg(Frequency) AS b, avg(Monetary) AS c
                FROM clustered JOIN profile USING (Cluster) GROUP BY Segment)""",
            """SELECT Segment,
              round((a - avg(a) OVER ()) / CASE WHEN stddev_pop(a) OVER () = 0 THEN 1 ELSE stddev_pop(a) OVER () END, 5) AS Recency,
              round((b - avg(b) OVER ()) / CASE WHEN stddev_pop(b) OVER () = 0 THEN 1 ELSE stddev_pop(b) OVER () END, 5) AS Frequency,
              round((c - avg(c) OVER ()) / CASE WHEN stddev_pop(c) OVER () = 0 THEN 1 ELSE stddev_pop(c) OVER () END, 5) AS Monetary
            FROM seg""",
        ),
    ),
    "business_summary": (
        business_summary,
        with_ctes(
            CLUSTERED + _silhouettes_sql("[4]"),
            """SELECT count(*) AS customers, round(sum(Monetary), 2) AS total_revenue,
              round(avg(Monetary), 2) AS average_revenue,
              (SELECT Segment FROM profile ORDER BY Customers DESC, Cluster LIMIT 1) AS largest_segment,
              (SELECT count(*) FROM profile) AS clusters,
              (SELECT silhouette FROM silhouettes WHERE k = 4) AS silhouette
            FROM rfm""",
        ),
    ),
    "silhouettes": (silhouettes, with_ctes(RFM + _silhouettes_sql("[2, 3, 5]"), "SELECT k, silhouette FROM silhouettes")),
    "describe_table": (describe_table, with_ctes(RFM, _DESCRIBE)),
    "histogram": (
        histogram,
        with_ctes(
            RFM
            + """,
        lim AS (SELECT CAST(min(Frequency) AS DOUBLE) AS lo, CAST(max(Frequency) AS DOUBLE) AS hi FROM rfm),
        binned AS (SELECT least(40, 1 + CAST(floor((Frequency - lo) / (hi - lo) * 40) AS BIGINT)) AS bin FROM rfm, lim),
        counted AS (SELECT bin, count(*) AS n FROM binned GROUP BY bin)""",
            """SELECT b.bin AS bin, round(lo + (b.bin - 1) * (hi - lo) / 40, 4) AS "from",
                      round(lo + b.bin * (hi - lo) / 40, 4) AS "to", coalesce(n, 0) AS count
            FROM (SELECT unnest(range(1, 41)) AS bin) b CROSS JOIN lim LEFT JOIN counted ON counted.bin = b.bin""",
        ),
    ),
    "record_inspect": (
        record_inspect,
        with_ctes(
            RFM + ", one AS (SELECT * FROM rfm ORDER BY CustomerID LIMIT 1)",
            """SELECT CAST(1 AS BIGINT) AS position, 'CustomerID' AS name, CAST(CustomerID AS VARCHAR) AS value FROM one
            UNION ALL SELECT 2, 'Recency', CAST(Recency AS VARCHAR) FROM one
            UNION ALL SELECT 3, 'Frequency', CAST(Frequency AS VARCHAR) FROM one""",
        ),
    ),
}
