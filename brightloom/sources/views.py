"""The given tables as inputs of the operators.

Each view is a lazy frame; column pruning and filters reach the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The three test cases of the response queries.
CASE_SCHEMA = (
    "test_case_id string, task_description string, expected_keywords array<string>, "
    "required_phrases array<string>, required_sections array<string>, min_words int, max_words int, "
    "exact_bullet_count int, expected_json_schema struct<required:array<string>,properties:map<string,string>>"
)
CASES = (
    ("case-0", "Summarise the question.", ["und", "the", "le"], [], ["die"], 10, 120, None, None),
    ("case-1", "List the steps.", [], ["en", "der"], [], None, None, 5, None),
    ("case-2", "Answer as JSON.", ["answer"], [], ["json"], None, None, None,
     (["answer", "words"], {"answer": "string", "words": "integer"})),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a scan that has fewer splits than the session has cores.

    A small table is often one Parquet row group and hence one task. Large tables
    have more splits than cores and are returned as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def busy_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table for costly work per row (texts, JSON, hashing)."""
    return spread(table(spark, sf_dir, name))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as sales; a returned line has a negative quantity."""
    lines = busy_table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("CustomerID"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
        .otherwise(F.col("l_quantity"))
        .alias("Quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("UnitPrice"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as text, as a CSV reader gives them; open orders have no date yet."""
    lines = busy_table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("CustomerID"),
        F.when(F.col("o_orderstatus") == "P", "pending").otherwise(day).alias("InvoiceDate"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
        .otherwise(F.col("l_quantity"))
        .cast("string")
        .alias("Quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).cast("string").alias("UnitPrice"),
    )


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as a raw catalogue with headers to be mapped."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ID"),
        F.col("p_name").alias("Movie Title"),
        F.concat("p_type", F.lit("|"), "p_brand").alias("Genre"),
        F.col("p_brand").alias("Production Companies"),
        F.col("p_size").cast("string").alias("Year"),
        (F.col("p_retailprice") / 100).cast("string").alias("Vote Average"),
    )


def raw_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a raw catalogue: the first sentence is the title, the whole text the overview."""
    return busy_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ID"),
        F.regexp_extract("text", r"^[^.!?\n]*", 0).alias("Movie Title"),
        F.concat("lang", F.lit("|"), "source").alias("Genre"),
        F.col("text").alias("Plot"),
        F.col("source").alias("Director"),
        (1950 + F.col("doc_id") % 70).cast("string").alias("Year"),
        ((F.col("doc_id") % 101) / 10).cast("string").alias("Vote Average"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the answers that follow, as rows of five experiments.

    Lines become bullets, every third answer is JSON and some are empty.
    """
    turns = busy_table(spark, sf_dir, "conversations")
    asked = turns.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("prompt_text")
    )
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
    )
    flat = F.regexp_replace(F.col("answer"), '["\\\\\\n]', " ")
    as_json = F.concat(
        F.lit('json: {"answer": "'), flat, F.lit('", "words": '),
        F.when(F.length("answer") % 2 == 0, F.length("answer").cast("string")).otherwise(F.lit("null")),
        F.lit("}"),
    )
    case = F.col("turn") % 3
    response = (
        F.when(F.length("answer") % 11 == 0, F.lit(" "))
        .when(case == 2, as_json)
        .otherwise(F.replace(F.col("answer"), F.lit("\n"), F.lit("\n- ")))
    )
    # A turn without an answer is a failed request: an empty response, no time and no output.
    return asked.join(answered, ["conv_id", "turn"], "left").select(
        F.concat(F.lit("exp-"), (F.col("conv_id") % 5).cast("string")).alias("experiment_id"),
        F.concat(F.lit("prompt-"), (F.col("conv_id") % 3).cast("string")).alias("prompt_id"),
        F.concat(F.lit("case-"), case.cast("string")).alias("test_case_id"),
        F.col("conv_id").alias("run_number"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("seq"),
        "prompt_text",
        F.coalesce(response, F.lit("")).alias("response"),
        F.coalesce((F.length("answer") % 500).cast("double") / 1000, F.lit(0.0)).alias("latency_seconds"),
        F.length("prompt_text").cast("int").alias("input_tokens"),
        F.when(F.length("answer") % 7 != 0, F.length("answer")).cast("int").alias("output_tokens"),
    )


def cases(spark: SparkSession) -> DataFrame:
    """The test cases as a three-row table."""
    return spark.createDataFrame(list(CASES), CASE_SCHEMA)


def response_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with their test case. The broadcast side is the fixed three-row table."""
    from brightloom.operators.experiments import with_success

    return with_success(responses(spark, sf_dir)).join(F.broadcast(cases(spark)), "test_case_id", "left")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with a two-class label."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("label").cast("int").alias("group"),
        (F.col("label") < 5).cast("int").alias("label"),
        F.transform("embedding", lambda x: x.cast("double")).alias("vector"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed score and prediction per vector."""
    scored = features(spark, sf_dir).withColumn("score", F.get("vector", F.lit(0)))
    return scored.select("id", "label", "score", (F.col("score") > 0).cast("int").alias("prediction"))


# Prompt and case templates that every customer's experiment uses.
PROMPT_TEMPLATES = (
    ("baseline", "Explain {segment} accounts to {audience}.", None, None),
    ("detailed", "List the risks for {segment} in nation {nation}, as {{json}}.", "large-model", 0.7),
    ("broken", "Summarise {missing} for {segment}.", "", None),
)
CASE_TEMPLATES = (("analysts", 50), ("children", 20))


def experiment_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One experiment per customer with three prompts."""
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("prompt_seq"), F.lit(name).alias("prompt_id"), F.lit(f"Prompt {name}").alias("name"),
                F.lit(text).alias("text"), F.lit("Be brief.").alias("system_instructions"),
                F.lit(model).cast("string").alias("model"), F.lit(temperature).cast("double").alias("temperature"),
                F.lit(None).cast("int").alias("max_tokens"), F.lit("1.0").alias("version"), F.lit("").alias("notes"),
            )
            for i, (name, text, model, temperature) in enumerate(PROMPT_TEMPLATES)
        ]
    )
    return busy_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("exp-"), F.col("c_custkey").cast("string")).alias("experiment_id"),
        F.col("c_custkey").alias("experiment_seq"),
        F.inline(rows),
    )


def experiment_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two test cases per experiment, with variables from the customer row."""
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("case_seq"), F.lit(f"for-{audience}").alias("test_case_id"),
                F.lit(f"Case {audience}").alias("case_name"), F.lit(audience).alias("audience"),
                F.lit(words).alias("max_words"),
            )
            for i, (audience, words) in enumerate(CASE_TEMPLATES)
        ]
    )
    exploded = busy_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("exp-"), F.col("c_custkey").cast("string")).alias("experiment_id"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("nation"),
        F.when(F.col("c_acctbal") < 0, F.lit(60)).cast("int").alias("min_words"),
        F.inline(rows),
    )
    variables = F.create_map(
        F.lit("segment"), F.col("segment"), F.lit("nation"), F.col("nation"), F.lit("audience"), F.col("audience")
    )
    return exploded.select(
        "experiment_id", "case_seq", "test_case_id", F.col("case_name").alias("name"),
        variables.alias("variables"), "min_words", "max_words",
    )


def supplied_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses handed in from outside: the latest event of a user answers that experiment."""
    latest = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.max(F.struct("event_id", "event_type", "value", "props")).alias("last"))
    )
    failed = F.col("last.event_type") == "error"
    return latest.select(
        F.concat(F.lit("exp-"), F.col("user_id").cast("string")).alias("experiment_id"),
        F.when(~failed, F.col("last.props")).alias("text"),
        F.when(failed, F.lit("ProviderError: request failed")).alias("error_message"),
        F.floor("last.value").cast("int").alias("input_tokens"),
        F.length("last.props").cast("int").alias("output_tokens"),
        (F.col("last.value") / 100).alias("latency_seconds"),
    )
