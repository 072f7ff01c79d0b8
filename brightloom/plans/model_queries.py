"""Metrics over fixed predictions, cluster quality, splits, fitted models, round trips."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.operators import clusters, customers, experiments, metrics, models, ordering
from brightloom.plans.customer_queries import rfm_table
from brightloom.plans.sqltext import with_ctes
from brightloom.session import checkpointed, ensure_checkpoint_dir
from brightloom.sources import io, views

# The class names.
CLASS_NAMES = {0: "Malignant", 1: "Benign"}
VECTOR_SIZE = 64
# Folders of chosen models by session and table.
_STORED: dict[tuple[str, str], str] = {}


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = metrics.confusion(views.predictions(spark, sf_dir), [0, 1, 2])
    return matrix.select(F.col("label").cast("long"), F.col("prediction").cast("long"), "count")


def macro_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metrics.macro_metrics(views.predictions(spark, sf_dir), [0, 1])
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.class_report(views.predictions(spark, sf_dir), [0, 1], list(CLASS_NAMES.values()))
    return report.select("name", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], F.col("support").cast("long"))


def _line_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large scored table with very many equal scores: is a line returned, by quantity?"""
    return views.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"), (F.col("l_linestatus") == "F").cast("int").alias("label"),
        (F.col("l_quantity") * F.col("l_linenumber")).alias("score"),
    )


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_score = metrics.roc_auc(views.predictions(spark, sf_dir)).withColumn("flag", F.lit("vectors"))
    by_flag = metrics.roc_auc(_line_scores(spark, sf_dir), ["flag"])
    return by_flag.unionByName(by_score).select("flag", F.round("roc_auc", 6).alias("roc_auc"))


def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = metrics.roc_points(_line_scores(spark, sf_dir), ["flag"])
    return points.select("flag", "threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


def _labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.features(spark, sf_dir).select("id", F.col("group").alias("Cluster"), "vector")
    return clusters.vectors_from_arrays(rows, "vector").select("id", "Cluster", "features")


def cluster_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _labelled_vectors(spark, sf_dir)
    silhouette = F.lit(float(clusters.silhouette_squared(labelled))).alias("silhouette_sq")
    joined = clusters.davies_bouldin(labelled).select(
        silhouette, F.col("davies_bouldin_score").alias("davies_bouldin")
    ).withColumn("inertia", clusters.inertia(labelled).scalar())
    return joined.select(*[F.round(c, 5).alias(c) for c in ("silhouette_sq", "davies_bouldin", "inertia")])


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = clusters.scaled_features(rfm_table(spark, sf_dir))
    return scaled.select("CustomerID", *[F.round(f"scaled_{c}", 5).alias(f"scaled_{c}") for c in customers.FEATURES])


def _shuffle_order() -> F.Column:
    """A fixed order both engines can compute."""
    return (F.col("id") * 7919) % 1000003


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = models.stratified_split(views.features(spark, sf_dir), "id", "label", 0.2, order=_shuffle_order())
    return split.select("id", F.col("label").cast("long"), "is_test")


def split_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of train and test after the check that they are disjoint and complete."""
    whole = views.features(spark, sf_dir)
    split = models.stratified_split(whole, "id", "label", 0.2, order=_shuffle_order())
    models.check_split(whole, split.filter(~F.col("is_test")), split.filter("is_test"), "id")
    return split.groupBy("is_test").agg(F.count(F.lit(1)).alias("rows"))


def labelled_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as feature columns and a label, read with the declared columns only."""
    return io.read_labelled(spark, f"{sf_dir.rstrip('/')}/labels.parquet", ["doc_id", "toxic"], "quality")


def fallback_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder without data gives the caller's frame, and says so; one with data gives its rows."""
    folder = _scratch(spark, "dataset")
    parts = views.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("movie_id"), F.col("p_name").alias("title"))
    missing, is_fallback = io.load_dataset(spark, f"{folder}/none", parts)
    io.write_csv(parts, f"{folder}/csv")
    found, is_other = io.load_dataset(spark, f"{folder}/csv", parts)
    return missing.withColumn("is_fallback", F.lit(is_fallback)).unionByName(found.withColumn("is_fallback", F.lit(is_other)))


def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = models.stratified_folds(views.features(spark, sf_dir), "id", "label", 5, order=_shuffle_order())
    return folds.select("id", F.col("label").cast("long"), F.col("fold").cast("long"))


# --- fitted models (no SQL form) ----------------------------------------------


def kmeans_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, features, rows = clusters.prepare(rfm_table(spark, sf_dir))
    records, _ = clusters.sweep(features, rows)
    features.unpersist()
    return spark.createDataFrame(records).orderBy(F.desc("silhouette_score"), "k")


def kmeans_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of all customers from the model of the best k, saved and loaded again."""
    scaling, features, rows = clusters.prepare(rfm_table(spark, sf_dir))
    records, fitted = clusters.sweep(features, rows)
    k = clusters.best_k(records)
    kmeans = fitted[k]
    model = clusters.segment_pipeline(scaling, kmeans)
    table = features.select("CustomerID", *customers.FEATURES)
    clustered = kmeans.transform(features).select("CustomerID", *customers.FEATURES, "Cluster")
    profile = customers.cluster_profile(clustered).select("Cluster", "Segment").collect()  # one row per cluster
    folder = _scratch(spark, "segments")
    io.save_model(model, folder, best_k=k, features=list(customers.FEATURES))
    loaded, _ = io.load_model(folder)
    return clusters.score_customers(loaded, table, {row["Cluster"]: row["Segment"] for row in profile})


def pca_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, features, _ = clusters.prepare(rfm_table(spark, sf_dir))
    shown, explained = clusters.pca_2d(features)
    return shown.select("CustomerID", "PC1", "PC2", *[F.lit(v).alias(f"share_{i}") for i, v in enumerate(explained, 1)])


def pca_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the components are uncorrelated with variances by their shares, and the shares' symmetric sums.

    The three shares are the eigenvalues of the correlations over their trace, so
    their sums of products are its principal minors and its determinant.
    """
    _, features, _ = clusters.prepare(rfm_table(spark, sf_dir))
    shown, (one, two) = clusters.pca_2d(features)
    three = 1 - one - two
    return shown.agg(
        F.round(F.lit(one * two + one * three + two * three), 5).alias("minors"),
        F.round(F.lit(one * two * three), 5).alias("determinant"),
        (F.abs(F.var_pop("PC1") / 3 - one) < 1e-6).alias("first_variance"),
        (F.abs(F.var_pop("PC2") / 3 - two) < 1e-6).alias("second_variance"),
        (F.abs(F.covar_pop("PC1", "PC2")) < 1e-6).alias("uncorrelated"),
        F.count(F.lit(1)).alias("customers"),
    )


def predict_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows, those whose class has the highest probability, and those whose probabilities add up to 1."""
    found = batch_predict(spark, sf_dir).withColumn("all", F.map_values("probabilities"))
    best = F.try_element_at("probabilities", F.col("predicted_class")) == F.array_max("all")
    total = F.aggregate("all", F.lit(0.0), lambda a, b: a + b)
    return found.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(best).alias("highest"), F.count_if(F.abs(total - 1) < 1e-9).alias("whole")
    )


def _wide(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    return models.wide_features(views.features(spark, sf_dir), "vector", VECTOR_SIZE, ["id", "label"])


def _fitted(spark: SparkSession, sf_dir: str):
    wide, names = _wide(spark, sf_dir)
    split = models.stratified_split(wide, "id", "label")
    train, test = split.filter(~F.col("is_test")).drop("is_test"), split.filter("is_test").drop("is_test")
    return models.logistic_regression(names, train.count()).fit(train), test, names


def _winner(spark: SparkSession, sf_dir: str):
    """The model that cross-validation ranks first, the test rows and the feature names.

    It is chosen and fitted once per session and table, stored, and loaded by every
    query that scores with it.
    """
    wide, names = _wide(spark, sf_dir)
    split = models.stratified_split(wide, "id", "label")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        train = split.filter(~F.col("is_test")).drop("is_test")
        name, model = models.fit_best(train, "id", names)
        _STORED[key] = _scratch(spark, "winner")
        io.save_model(model, _STORED[key], name=name)
    model, facts = io.load_model(_STORED[key])
    return facts["name"], model, split.filter("is_test").drop("is_test"), names


def model_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide, names = _wide(spark, sf_dir)
    split = models.stratified_split(wide, "id", "label")
    train = split.filter(~F.col("is_test")).drop("is_test")
    table = models.comparison_table(models.cross_validate(train, "id", names))
    return models.melted_comparison(table)


def best_model_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test metrics of the model that cross-validation ranks first."""
    name, model, test, _ = _winner(spark, sf_dir)
    return models.test_metrics(models.scored(model, test, ["label"])).withColumn("model", F.lit(name))


def best_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test metrics of the logistic regression."""
    model, test, _ = _fitted(spark, sf_dir)
    return models.test_metrics(models.scored(model, test, ["label"]))


def permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance of every feature for the model that cross-validation chose."""
    _, model, test, names = _winner(spark, sf_dir)
    return models.permutation_importance(model, test, "id", names)


def donor_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten keyed permutations of all order rows: how many numbers they hit and how far these reach."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").cast("double").alias("key"))
    numbered = checkpointed(ordering.row_numbers(orders, "key", name="n"))
    rows = numbered.count()
    donors = [
        numbered.select(F.lit(r).cast("long").alias("repeat"), ordering.keyed_permutation(F.col("n") - 1, rows, f"7/{r}").alias("donor"))
        for r in range(10)
    ]
    return reduce(DataFrame.unionAll, donors).groupBy("repeat").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("donor").alias("donors"),
        F.min("donor").alias("first"), F.max("donor").alias("last"),
    )


def batch_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and probabilities of the test rows by the model that cross-validation chose."""
    _, model, test, names = _winner(spark, sf_dir)
    return models.predict_batch(model, test, names, CLASS_NAMES, keep=["id", "label"])


# --- round trips through files (no SQL form) ------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark)}/brightloom-{name}-{uuid.uuid4().hex}"


def roundtrip_csv_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions through CSV, then the RFM table through JSON."""
    folder = _scratch(spark, "roundtrip")
    io.write_csv(views.raw_transactions(spark, sf_dir), f"{folder}/csv")
    cleaned = customers.clean_transactions(io.read_transactions(spark, f"{folder}/csv"))
    table = customers.rfm(cleaned)
    io.write_json(table, f"{folder}/json")
    back = spark.read.schema(table.schema).json(f"{folder}/json")
    return back.select(F.col("CustomerID").cast("long"), F.col("Recency").cast("long"), "Frequency",
                       F.round("Monetary", 2).alias("Monetary"))


def history_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two saves to a history table; the second replaces the experiments it holds."""
    folder = _scratch(spark, "history")
    rows = views.responses(spark, sf_dir).select("experiment_id", "prompt_id", "seq", "response")
    experiments.save_history(rows, folder)
    again = rows.filter(F.col("experiment_id").isin("exp-1", "exp-2")).withColumn("prompt_id", F.lit("again"))
    experiments.save_history(again, folder)
    stored = experiments.load_history(spark, folder, rows.schema)
    return stored.groupBy("experiment_id", "prompt_id").agg(F.count(F.lit(1)).alias("n"))


def cache_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A response cache in files: put, put again with newer and older entries, get, clear; the rows after each step."""
    events = views.table(spark, sf_dir, "events").select(
        (F.col("user_id") % 1000).cast("string").alias("cache_key"), F.col("event_type").alias("text"),
        F.col("event_id").alias("written_at"),
    )
    cache = experiments.response_cache(spark, f"{_scratch(spark, 'cache')}/table", events.schema)
    cache.put(events.filter("written_at % 3 < 2"), "written_at")
    cache.put(events.filter("written_at % 3 = 2 or written_at % 7 = 0"), "written_at")
    one = cache.get("7").withColumn("step", F.lit("get"))
    early, late = cache.read(1).withColumn("step", F.lit("first")), cache.read(2).withColumn("step", F.lit("second"))
    cache.clear()
    cleared = cache.read().withColumn("step", F.lit("cleared"))
    cache.put(events.filter("user_id = 7"), "written_at")
    again = cache.read().withColumn("step", F.lit("again"))
    return early.unionByName(late).unionByName(one).unionByName(cleared).unionByName(again)


_PRED = """
pred AS (
  SELECT vec_id AS id, CAST(label < 5 AS INT) AS label, CAST(embedding[1] AS DOUBLE) AS score,
         CAST(embedding[1] > 0 AS INT) AS prediction FROM embeddings)"""

_CLASSES = _PRED + """,
classes AS (
  SELECT c, count_if(label = c AND prediction = c) AS hit, count_if(prediction = c) AS predicted, count_if(label = c) AS support
  FROM pred, (SELECT unnest([0, 1]) AS c) GROUP BY c),
rates AS (
  SELECT *, coalesce(hit / nullif(predicted, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r FROM classes),
scores AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM rates)"""

_LINES = """
lines AS (SELECT l_returnflag AS flag, CAST(l_linestatus = 'F' AS INT) AS label, l_quantity * l_linenumber AS score FROM lineitem),
steps AS (SELECT flag, score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM lines GROUP BY 1, 2),
run AS (
  SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER g AS tp, sum(neg) OVER g AS tn FROM steps
  WINDOW w AS (PARTITION BY flag ORDER BY score), g AS (PARTITION BY flag))"""

_VEC = """
v AS (SELECT vec_id AS id, label AS c, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
cent AS (SELECT c, list(m ORDER BY i) AS m FROM (
  SELECT c, i, avg(val) AS m FROM (SELECT c, unnest(x) AS val, unnest(range(1, 65)) AS i FROM v) GROUP BY c, i) GROUP BY c),
sizes AS (SELECT c, count(*) AS n FROM v GROUP BY c),
sums AS (SELECT a.id, a.c, b.c AS o, sum(list_distance(a.x, b.x) ** 2) AS t FROM v a, v b GROUP BY 1, 2, 3),
ab AS (
  SELECT id, sums.c, max(CASE WHEN o = sums.c THEN t / nullif(n - 1, 0) END) AS a, min(CASE WHEN o <> sums.c THEN t / n END) AS b
  FROM sums JOIN sizes ON sizes.c = o GROUP BY 1, 2),
spread AS (SELECT c, avg(list_distance(x, m)) AS s, any_value(m) AS m, sum(list_distance(x, m) ** 2) AS q FROM v JOIN cent USING (c) GROUP BY c),
worst AS (SELECT l.c, max((l.s + r.s) / list_distance(l.m, r.m)) AS ratio FROM spread l JOIN spread r ON l.c <> r.c GROUP BY l.c)"""

_NUMBERED = """
f AS (SELECT vec_id AS id, CAST(label < 5 AS BIGINT) AS label FROM embeddings),
numbered AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY (id * 7919) % 1000003, id) AS n FROM f)"""


def _log_scaled(c: str) -> str:
    logged = f"ln(1 + greatest({c}, 0))"
    return f"round(({logged} - avg({logged}) OVER ()) / stddev_pop({logged}) OVER (), 5) AS scaled_{c}"


def _rfm_sql(body: str) -> str:
    from brightloom.plans.sqltext import RFM

    return with_ctes(RFM, body)


PLANS = {
    "confusion": (
        confusion,
        with_ctes(
            _PRED,
            """SELECT a AS label, p AS prediction, count(id) AS count
            FROM (SELECT unnest(range(0, 3)) AS a) CROSS JOIN (SELECT unnest(range(0, 3)) AS p)
            LEFT JOIN pred ON label = a AND prediction = p GROUP BY 1, 2""",
        ),
    ),
    "macro_metrics": (
        macro_metrics,
        with_ctes(
            _CLASSES,
            """SELECT round(sum(hit) / sum(support), 6) AS accuracy, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall,
              round(avg(f), 6) AS f1 FROM scores""",
        ),
    ),
    "class_report": (
        class_report,
        with_ctes(
            _CLASSES,
            """SELECT CASE c WHEN 0 THEN 'Malignant' ELSE 'Benign' END AS name, round(p, 6) AS precision, round(r, 6) AS recall,
              round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM scores
            UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6),
              round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores
            UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM scores
            UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
              round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores""",
        ),
    ),
    "roc_auc": (
        roc_auc,
        with_ctes(
            _PRED + "," + _LINES,
            """SELECT flag, round(CAST(sum(pos * (cn - neg + neg / 2)) AS DOUBLE) / any_value(tp) / any_value(tn), 6) AS roc_auc
            FROM run GROUP BY flag
            UNION ALL
            SELECT 'vectors', round(avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END), 6)
            FROM pred a JOIN pred b ON a.label = 1 AND b.label = 0""",
        ),
    ),
    "roc_points": (
        roc_points,
        with_ctes(
            _LINES,
            """SELECT flag, score AS threshold, coalesce(round((tn - cn + neg) / nullif(tn, 0), 6), 0) AS fpr,
              coalesce(round((tp - cp + pos) / nullif(tp, 0), 6), 0) AS tpr FROM run
            UNION ALL SELECT DISTINCT flag, CAST('Infinity' AS DOUBLE), 0, 0 FROM lines""",
        ),
    ),
    "cluster_quality": (
        cluster_quality,
        with_ctes(
            _VEC,
            """SELECT (SELECT round(avg(coalesce((b - a) / greatest(a, b), 0)), 5) FROM ab) AS silhouette_sq,
              (SELECT round(avg(ratio), 5) FROM worst) AS davies_bouldin, (SELECT round(sum(q), 5) FROM spread) AS inertia""",
        ),
    ),
    "scaled_features": (
        scaled_features,
        _rfm_sql("SELECT CustomerID, " + ", ".join(_log_scaled(c) for c in customers.FEATURES) + " FROM rfm"),
    ),
    "stratified_split": (
        stratified_split,
        with_ctes(
            _NUMBERED
            + """,
        sizes AS (SELECT label, count(*) AS n FROM f GROUP BY label),
        exact AS (SELECT label, ceil((SELECT count(*) FROM f) * 0.2) * n / (SELECT count(*) FROM f) AS e FROM sizes),
        quotas AS (
          SELECT label, floor(e) + CASE WHEN row_number() OVER (ORDER BY e - floor(e) DESC, label)
            <= ceil((SELECT count(*) FROM f) * 0.2) - sum(floor(e)) OVER () THEN 1 ELSE 0 END AS quota FROM exact)""",
            "SELECT id, label, n <= quota AS is_test FROM numbered JOIN quotas USING (label)",
        ),
    ),
    "stratified_folds": (stratified_folds, with_ctes(
        _NUMBERED,
        "SELECT id, label, (n - 1 + (SELECT count(*) FROM f WHERE f.label < numbered.label)) % 5 AS fold FROM numbered",
    )),
    "split_check": (
        split_check,
        """WITH n AS (SELECT count(*) AS n FROM embeddings)
        SELECT true AS is_test, CAST(ceil(n * 0.2) AS BIGINT) AS rows FROM n
        UNION ALL SELECT false, n - CAST(ceil(n * 0.2) AS BIGINT) FROM n""",
    ),
    "labelled_source": (
        labelled_source,
        "SELECT CAST(doc_id AS DOUBLE) AS doc_id, CAST(toxic AS DOUBLE) AS toxic, CAST(quality AS INT) AS label FROM labels",
    ),
    "fallback_dataset": (
        fallback_dataset,
        """SELECT CAST(p_partkey AS VARCHAR) AS movie_id, p_name AS title, unnest([true, false]) AS is_fallback FROM part""",
    ),
    "kmeans_sweep": (kmeans_sweep, None),
    "kmeans_score": (kmeans_score, None),
    "pca_2d": (pca_2d, None),
    "pca_shares": (
        pca_shares,
        _rfm_sql(
            """SELECT round((3 - ab * ab - ac * ac - bc * bc) / 9, 5) AS minors,
              round((1 + 2 * ab * ac * bc - ab * ab - ac * ac - bc * bc) / 27, 5) AS determinant,
              true AS first_variance, true AS second_variance, true AS uncorrelated, customers
            FROM (SELECT corr(ln(1 + Recency), ln(1 + Frequency)) AS ab, corr(ln(1 + Recency), ln(1 + Monetary)) AS ac,
                    corr(ln(1 + Frequency), ln(1 + Monetary)) AS bc, count(*) AS customers FROM rfm)"""
        ),
    ),
    "predict_check": (
        predict_check,
        """SELECT n AS rows, n AS highest, n AS whole FROM (SELECT CAST(ceil(count(*) * 0.2) AS BIGINT) AS n FROM embeddings)""",
    ),
    "model_compare": (model_compare, None),
    "best_model_choice": (best_model_choice, None),
    "best_model_scores": (best_model_scores, None),
    "permutation_importance": (permutation_importance, None),
    "donor_check": (
        donor_check,
        """SELECT r AS repeat, count(*) AS rows, count(DISTINCT o_orderkey) AS donors, CAST(0 AS BIGINT) AS first, count(*) - 1 AS last
        FROM orders, range(10) AS t(r) GROUP BY r""",
    ),
    "batch_predict": (batch_predict, None),
    "roundtrip_csv_json": (
        roundtrip_csv_json,
        with_ctes(
            """
        ok AS (
          SELECT o_custkey AS CustomerID, CAST(o_orderdate AS DATE) AS d, l_quantity * (l_extendedprice / l_quantity) AS Sales
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey
          WHERE l_returnflag <> 'R' AND o_orderstatus <> 'P' AND l_quantity > 0 AND l_extendedprice >= 0),
        g AS (SELECT CustomerID, max(d) AS d, count(*) AS Frequency, sum(Sales) AS Monetary FROM ok GROUP BY CustomerID)""",
            """SELECT CustomerID, date_diff('day', d, (SELECT max(d) FROM g) + 1) AS Recency, Frequency,
              round(Monetary, 2) AS Monetary FROM g""",
        ),
    ),
    "cache_store": (
        cache_store,
        """
        WITH e AS (SELECT CAST(user_id % 1000 AS VARCHAR) AS cache_key, event_type AS text, event_id AS written_at, user_id FROM events),
        steps AS (
          SELECT 'first' AS step, * FROM e WHERE written_at % 3 < 2 UNION ALL SELECT 'second', * FROM e
          UNION ALL SELECT 'get', * FROM e WHERE cache_key = '7' UNION ALL SELECT 'again', * FROM e WHERE user_id = 7)
        SELECT step, cache_key, arg_max(text, written_at) AS text, max(written_at) AS written_at FROM steps GROUP BY step, cache_key""",
    ),
    "history_upsert": (
        history_upsert,
        """
        WITH r AS (
          SELECT 'exp-' || u.conv_id % 5 AS experiment_id, 'prompt-' || u.conv_id % 3 AS prompt_id
          FROM conversations u LEFT JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
          WHERE u.role = 'user')
        SELECT experiment_id, CASE WHEN experiment_id IN ('exp-1', 'exp-2') THEN 'again' ELSE prompt_id END AS prompt_id, count(*) AS n
        FROM r GROUP BY 1, 2""",
    ),
}
