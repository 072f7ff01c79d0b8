"""Quality, customer and catalogue operators on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from brightloom.operators import catalogue, customers, quality


def test_clean_transactions(spark):
    raw = spark.createDataFrame(
        [("1", "2024-01-01", "2", "3.5"), (None, "2024-01-01", "2", "1"), ("1", "soon", "2", "1"),
         ("1", "2024-01-01", "0", "1"), ("1", "2024-01-02", "1", "0"), ("1", "2024-01-02", "1", "-1"),
         ("1", "2024-01-02", "NaN", "1")],
        "CustomerID string, InvoiceDate string, Quantity string, UnitPrice string",
    )
    assert [r["Sales"] for r in customers.clean_transactions(raw).orderBy("InvoiceDate").collect()] == [7.0, 0.0]
    with pytest.raises(ValueError, match="InvoiceDate.*Quantity"):
        customers.clean_transactions(raw.drop("InvoiceDate", "Quantity"))


def test_rfm(spark):
    sales = spark.createDataFrame(
        [(1, "2024-01-01 23:00:00", 5.0), (1, "2024-01-03 01:00:00", 1.0), (2, "2024-01-10 10:00:00", 2.0), (None, "2024-02-01", 9.0)],
        "CustomerID long, InvoiceDate string, Sales double",
    ).withColumn("InvoiceDate", F.col("InvoiceDate").cast("timestamp"))
    rows = {r["CustomerID"]: r for r in customers.rfm(sales).collect()}
    assert (rows[1]["Recency"], rows[1]["Frequency"], rows[1]["Monetary"]) == (8, 2, 6.0)
    assert rows[2]["Recency"] == 1 and len(rows) == 2


def test_profile_names_duplicates(spark):
    rows = [(i, 10, 5, 100.0, i % 2) for i in range(10)]
    table = spark.createDataFrame(rows, "CustomerID long, Recency int, Frequency long, Monetary double, Cluster int")
    profile = customers.cluster_profile(table)
    assert {r["Segment"] for r in profile.collect()} == {
        "Champions / High Value (Cluster 0)", "Champions / High Value (Cluster 1)"
    }
    summary = customers.business_summary(customers.attach_segments(table, profile)).first()
    assert summary["largest_segment"] == "Champions / High Value (Cluster 0)" and summary["customers"] == 10
    actions = {r["Action"] for r in customers.segment_actions(profile).collect()}
    assert actions == {"Reward loyalty; test VIP benefits and retention offers."}


@pytest.mark.parametrize(
    "marks, name",
    [((True, True, True), "Champions / High Value"), ((False, True, True), "At-Risk High Value"),
     ((True, False, True), "Recent / New Customers"), ((True, True, False), "Regular Customers"),
     ((False, False, False), "Dormant / Low Engagement"), ((False, False, True), "Occasional Customers")],
)
def test_segment_name(one, marks, name):
    assert one(customers.segment_name, *marks, types=["boolean"] * 3) == name


def test_standardize_columns(spark):
    raw = spark.createDataFrame([(2, "b", None, "x"), (1, "a", "y", "z")], "`pos` long, `Movie Title` string, `Plot` string, `Summary` string")
    rows = catalogue.standardize_columns(raw, "pos").orderBy("movie_id").collect()
    assert [r["title"] for r in rows] == ["a", "b"] and [r["movie_id"] for r in rows] == [1, 2]
    assert [r["overview"] for r in rows] == ["y", "x"] and rows[0]["genres"] == "" and rows[0]["rating"] is None
    with pytest.raises(ValueError):
        catalogue.standardize_columns(raw.drop("Movie Title"), "pos")


def test_clean_catalogue(spark):
    rows = [(1, "A", "x"), (2, "a", None), (3, " A ", "y"), (4, "  ", "z"), (5, None, "z")]
    cleaned = catalogue.clean_catalogue(spark.createDataFrame(rows, "movie_id long, title string, genre string")).orderBy("movie_id").collect()
    assert [(r["title"], r["tags"]) for r in cleaned] == [("A", "x"), ("a", "unknown")]


def test_genres_search_close(spark):
    rows = [(1, "Inter Stellar!", "Drama, Sci-Fi|Drama"), (2, "Stellar", " ; "), (3, "other inter", "Drama")]
    table = spark.createDataFrame(rows, "movie_id long, title string, genres string")
    assert {r["genre"]: r["count"] for r in catalogue.genre_counts(table).collect()} == {"Drama": 3, "Sci-Fi": 1}
    assert [r["movie_id"] for r in catalogue.search(table, " INTER ").collect()] == [1, 3]
    assert [r["movie_id"] for r in catalogue.search(table, "  ", 2).collect()] == [1, 2]
    assert [r["title"] for r in catalogue.close_titles(table, "stellar inter").collect()] == ["Inter Stellar!", "other inter", "Stellar"]


def test_title_postings_find_what_a_scan_finds(spark):
    """Queries of every length, repeated letters, overlaps, blanks, letters outside ASCII, null and empty titles."""
    draw = random.Random(3)
    titles = ["".join(draw.choice("ab \u00e9!") for _ in range(draw.randrange(12))) for _ in range(300)]
    titles += [None, "", "a", "ab", "aaaaaaa", "abababab", "Inter Stellar!", "x" * 5000 + "needle"]
    table = spark.createDataFrame(list(enumerate(titles)), "movie_id long, title string").cache()
    postings = catalogue.title_postings(table).cache()
    for query in ("a", "b a", "abab", "aaaa", "!", " AB ", "needle", "inter st", "zz"):
        want = [r["movie_id"] for r in catalogue.search(table, query, 1000).collect()]
        got = [r["movie_id"] for r in catalogue.search_postings(postings, table, query, None).collect()]
        assert got == want, query
    assert [r["movie_id"] for r in catalogue.search_postings(postings, table, "aba", 3).collect()] == [
        r["movie_id"] for r in catalogue.search(table, "aba", 3).collect()
    ]
    assert catalogue.search_postings(postings.limit(0), table.limit(0), "abc").count() == 0


def test_histogram_edges(spark):
    bins = quality.histogram(spark.createDataFrame([(x,) for x in (0.0, 1.0, 4.0, 4.0)], "x double"), "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in bins] == [1, 1, 0, 2]
    flat = quality.histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", 2).orderBy("bin").collect()
    assert [(r["from"], r["count"]) for r in flat] == [(1.5, 0), (2.0, 2)]


def test_guards(spark):
    df = spark.createDataFrame([(1.0, "a")], "x double, y string")
    with pytest.raises(ValueError, match=r"\['z'\].*\['y'\]"):
        quality.require_exact_columns(df, ["x", "z"])
    with pytest.raises(ValueError):
        quality.require_rows(df, 2, "too few")
    bad = spark.createDataFrame([(float("inf"),)], "x double")
    with pytest.raises(Exception, match="finite"):
        bad.select(quality.finite_guard(F.col("x"))).collect()
    assert quality.type_counts(df) == {"double": 1, "string": 1}
    counted = quality.describe(spark.createDataFrame([(None,)], "x double"), ["x"]).first()
    assert counted["count"] == 0 and counted["mean"] is None
