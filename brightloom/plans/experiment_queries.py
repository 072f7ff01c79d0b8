"""Experiment grids, response collection, requirement checks, scores and their statistics."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.functions import maths, rubric, text
from brightloom.operators import evaluation, experiments
from brightloom.operators.experiments import ModelConfig
from brightloom.plans.sqltext import with_ctes
from brightloom.sources import views

CONFIG = ModelConfig(input_cost_per_1k=0.5, output_cost_per_1k=1.5)
# The eight weights.
WEIGHTS = {
    "relevance": 1.2, "accuracy": 1.2, "clarity": 1.0, "completeness": 1.0,
    "instruction_following": 1.2, "format_compliance": 1.0, "safety": 0.5, "conciseness": 0.8,
}
BY = ["experiment_id"]
PHRASES = ("the", "ment", "und", "zu", "Zx")


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return experiments.request_grid(
        views.experiment_prompts(spark, sf_dir), views.experiment_cases(spark, sf_dir), 2, CONFIG
    )


def experiment_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir).select(
        "experiment_id", "prompt_id", "test_case_id", "prompt_text", "model", "temperature",
        F.col("max_tokens").cast("long"), F.col("run_number").cast("long"), "cache_key",
    )


def _cache(grid: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers kept from before: one per distinct baseline prompt of the richer customers.

    Few keys serve very many requests.
    """
    rich = views.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 9000).select(
        F.concat(F.lit("exp-"), F.col("c_custkey").cast("string")).alias("experiment_id"), "c_acctbal"
    )
    entries = (
        grid.filter((F.col("prompt_id") == "baseline") & (F.col("test_case_id") == "for-analysts") & (F.col("run_number") == 1))
        .join(rich, "experiment_id")
        .select(
            "cache_key", F.concat(F.lit("cached "), "prompt_text").alias("text"), "model",
            F.lit(10).alias("input_tokens"), F.lit(20).alias("output_tokens"), F.col("c_acctbal").alias("written_at"),
        )
    )
    return experiments.cache_put(entries.limit(0), entries)


def cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records from the cache, from earlier requests with the same key and from supplied responses."""
    # The grid feeds the records, the first answers per key and the cache table.
    # Rendering and hashing are done once; lost blocks are rebuilt from the tables.
    grid = _grid(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    records = experiments.collect_responses(
        grid, views.supplied_responses(spark, sf_dir), ["experiment_id"], _cache(grid, spark, sf_dir), CONFIG
    )
    return records.select(
        "experiment_id", "prompt_id", "test_case_id", F.col("run_number").cast("long"), "response", "success",
        "error_message", "cache_hit", F.round("latency_seconds", 4).alias("latency_seconds"),
        F.round("estimated_cost", 6).alias("estimated_cost"), "response_words",
    )


def render_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates with known, missing and doubled braces, filled from maps with odd values."""
    orders = views.busy_table(spark, sf_dir, "orders")
    template = (
        F.when(F.col("o_orderstatus") == "F", "Order {id} is {status}: {priority}")
        .when(F.col("o_orderstatus") == "O", "Order {id} {{keeps}} {unknown}")
        .otherwise("{{{id}}} of {status}, {priority}")
    )
    variables = F.create_map(
        F.lit("id"), F.col("o_orderkey").cast("string"), F.lit("status"), F.lit("{priority}"),
        F.lit("priority"), F.col("o_orderpriority"),
    )
    return orders.select("o_orderkey", text.render(template, variables).alias("rendered"))


def prompt_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = views.experiment_prompts(spark, sf_dir)
    changes = prompts.filter(F.col("prompt_id") == "baseline").select(
        "experiment_id", "prompt_id", F.concat(F.lit("Shortly: "), "text").alias("new_text"), F.lit("1.1").alias("new_version")
    )
    both = prompts.unionByName(experiments.clone_versions(prompts, changes))
    return both.select("experiment_id", "prompt_id", "name", "text", "version", "notes", "model")


def row_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of experiments with broken parts: bad settings by order value, missing cases."""
    orders = views.busy_table(spark, sf_dir, "orders")
    key = F.concat(F.lit("exp-"), F.col("o_custkey").cast("string")).alias("experiment_id")
    prompts = orders.select(
        key, F.col("o_orderkey").cast("string").alias("prompt_id"),
        F.when(F.col("o_totalprice") < 20000, " ").otherwise(F.col("o_orderpriority")).alias("name"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise("Say {x}").alias("text"),
        (F.col("o_totalprice") / 200000).alias("temperature"),
        F.when(F.col("o_orderstatus") == "F", F.lit(-1)).cast("int").alias("max_tokens"),
    )
    cases = views.experiment_cases(spark, sf_dir)
    customers = views.table(spark, sf_dir, "customer")
    definitions = customers.select(
        F.concat(F.lit("exp-"), F.col("c_custkey").cast("string")).alias("experiment_id"),
        F.when(F.col("c_acctbal") < 0, " ").otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("c_mktsegment") == "MACHINERY", 0).otherwise(2).alias("runs_per_case"),
    )
    return experiments.experiment_errors(definitions, prompts, cases)


def _order_prompts(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").cast("string").alias("prompt_id"), F.col("o_orderpriority").alias("name"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise("Say {x}").alias("text"),
        (F.col("o_totalprice") / 200000).alias("temperature"),
        F.when(F.col("o_orderstatus") == "F", F.lit(-1)).cast("int").alias("max_tokens"),
    )


def prompt_library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders added to a library of the even ones: valid ones join or replace; the smallest even one is looked up."""
    orders = views.table(spark, sf_dir, "orders")
    even = orders.filter(F.col("o_orderkey") % 2 == 0)
    library, _ = experiments.add_prompts(_order_prompts(even).withColumn("name", F.lit("old")), _order_prompts(orders))
    first = even.agg(F.min("o_orderkey")).first()[0]
    found = experiments.get_prompt(library, str(first)).select("prompt_id", F.lit(True).alias("found"))
    return library.join(found, "prompt_id", "left").select(
        "prompt_id", "name", "text", F.coalesce("found", F.lit(False)).alias("found")
    )


def experiments_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One experiment per customer with valid prompts and cases; creation fails if any has an error."""
    customers = views.table(spark, sf_dir, "customer")
    key = F.concat(F.lit("exp-"), F.col("c_custkey").cast("string")).alias("experiment_id")
    runs = F.when(F.col("c_nationkey") % 3 > 0, F.col("c_nationkey") % 3).alias("runs_per_case")
    definitions = experiments.assign_experiment_ids(
        customers.select(key, F.col("c_name").alias("name"), runs, F.lit(None).cast("boolean").alias("blind_evaluation"))
    )
    prompts = customers.select(
        key, F.lit("p").alias("prompt_id"), F.col("c_mktsegment").alias("name"), F.lit("Say {x}").alias("text"),
        F.lit(0.5).alias("temperature"), F.lit(100).alias("max_tokens"),
    )
    cases = views.experiment_cases(spark, sf_dir).withColumn("min_words", F.lit(None).cast("int"))
    return experiments.create_experiments(definitions, prompts, cases).withColumn("runs_per_case", F.col("runs_per_case").cast("long"))


def experiment_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as prompts and events as cases of one experiment per customer number."""
    prompts = views.busy_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("experiment_id"))
    cases = views.table(spark, sf_dir, "events").select(F.col("user_id").alias("experiment_id"))
    return experiments.experiment_sizes(prompts, cases, F.lit("2.5"))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses with checks and scores. Statistics read them several times, so they are kept."""
    rows = rubric.rule_score(views.response_rows(spark, sf_dir), WEIGHTS)
    kept = rows.withColumn("response_words", text.word_count(F.col("response"))).select(
        "experiment_id", "prompt_id", "test_case_id", "run_number", "seq", "success", "requirements", "score",
        "latency_seconds", "response_words",
    )
    return kept.persist(StorageLevel.MEMORY_AND_DISK)


def requirements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.response_rows(spark, sf_dir)
    checks = rows.select("seq", rubric.requirement_checks(F.col("response")).alias("checks"))
    return checks.select("seq", F.posexplode("checks").alias("position", "check")).select(
        "seq", (F.col("position") + 1).cast("long").alias("position"), "check.*"
    )


def rubric_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = rubric.rule_score(views.response_rows(spark, sf_dir), WEIGHTS)
    return scored.select(
        "seq", "success", *[F.round(F.col(f"score.{c}"), 9).alias(c) for c in (*rubric.CRITERIA, "overall")]
    )


def judged_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule scores replaced by an evaluator's where one is given: labels stand in for its verdicts."""
    scored = rubric.rule_score(views.response_rows(spark, sf_dir), WEIGHTS)
    judged = views.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("run_number"),
        F.when(
            F.col("quality") == 1,
            F.struct(
                *[F.lit(8.0).alias(c) for c in rubric.CRITERIA], (F.lit(8.0) - F.col("toxic") * 4).alias("overall"),
                F.lit("labelled").alias("reason"), F.lit("model-based").alias("evaluator_mode"),
            ),
        ).alias("judge_score"),
        F.when(F.col("quality") == 0, "no verdict").alias("judge_error"),
    )
    final = experiments.prefer_judge(scored, judged, ["run_number"])
    return final.select(
        "seq", F.round("score.overall", 9).alias("overall"), F.col("score.evaluator_mode").alias("mode"),
        F.right(F.col("score.reason"), F.lit(12)).alias("reason_end"),
    )


def judge_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.response_rows(spark, sf_dir)
    equal = dict.fromkeys(rubric.CRITERIA, 1.0)
    full = rubric.judge_prompt(F.col("task_description"), F.col("prompt_text"), F.col("response"), equal)
    return rows.select("seq", F.md5(full).alias("judge_prompt_md5"))


def response_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = experiments.finish_records(views.responses(spark, sf_dir), CONFIG)
    return records.select(
        "seq", "prompt_id", "success", "error_message", F.round("estimated_cost", 6).alias("estimated_cost"),
        "response_words", "response_lines", "response_characters",
    )


def phrase_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required phrases per document; short documents require none."""
    needed = F.when(F.col("n_chars") > 200, text.literal_strings(PHRASES))
    found = views.busy_table(spark, sf_dir, "documents").select(
        "doc_id", F.inline(F.array(text.phrase_compliance(F.col("text"), needed)))
    )
    return found.withColumn("compliance", F.round("compliance", 4))


def prompt_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = evaluation.ranking(_scored(spark, sf_dir), BY)
    numbers = [
        "average_score", "median_score", "minimum_score", "maximum_score", "score_std_dev", "average_latency",
        "average_response_words",
    ]
    return ranked.select(
        "experiment_id", "prompt_id", *[F.round(c, 9).alias(c) for c in numbers], "successful_runs", F.col("rank").cast("long")
    )


def experiment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = evaluation.overall_summary(_scored(spark, sf_dir), BY)
    numbers = ["average_score", "average_latency", "average_response_words", "score_std_dev"]
    return found.select(
        "experiment_id", "total_requests", "successful_requests", "failed_requests", *[F.round(c, 9).alias(c) for c in numbers]
    )


def score_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [c[0] for c in views.CASES]
    matrix = evaluation.score_matrix(_scored(spark, sf_dir), names, BY)
    return matrix.select("experiment_id", "prompt_id", *[F.round(F.col(f"`{c}`"), 9).alias(c) for c in names])


def ab_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = evaluation.ab_compare(_scored(spark, sf_dir), "prompt-0", "prompt-1", BY)
    numbers = [f"average_{w}_{s}" for w in ("score", "latency") for s in "ab"]
    return compared.select(
        "experiment_id", *[F.round(c, 9).alias(c) for c in numbers], "winner", "statistically_significant"
    )


def group_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of purchases against clicks; an unreadable value counts 0."""
    events = views.table(spark, sf_dir, "events").select(
        "event_type", F.when(F.col("value") < 5, "n/a").otherwise(F.col("value").cast("string")).alias("value")
    )
    found = evaluation.compare_groups(events, "value", F.col("event_type") == "purchase", F.col("event_type") == "click")
    return found.select(*[F.round(c, 9).alias(c) for c in ("left_mean", "right_mean", "difference")], "winner")


def cost_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known for experiments whose successes all have token counts; also over two large groups."""
    records = experiments.finish_records(views.responses(spark, sf_dir), CONFIG)
    costs = evaluation.cost_total(records, ["experiment_id", "test_case_id", "prompt_id"])
    return costs.select(
        "experiment_id", "test_case_id", "prompt_id", F.round("estimated_total_cost", 9).alias("estimated_total_cost"), "available"
    )


def blind_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled responses, judged by length, with the prompt ids restored."""
    labelled = experiments.blind_labels(views.responses(spark, sf_dir), "seq")
    judged = labelled.select("experiment_id", "label", F.length("response").cast("long").alias("verdict"))
    return experiments.restore_labels(judged, labelled)


def words_by_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = experiments.finish_records(views.responses(spark, sf_dir), CONFIG)
    return evaluation.words_by_prompt(records, BY).withColumn("words", F.round("words", 9))


def number_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select(
        "event_type", F.when(F.col("value") < 5, "n/a").otherwise(F.col("value").cast("string")).alias("value")
    )
    stats = evaluation.number_stats(events, "value", ["event_type"])
    numbers = ["mean", "median", "minimum", "maximum", "std_dev", "range"]
    return stats.select("event_type", "count", *[F.round(c, 9).alias(c) for c in numbers])


def score_boxplot(spark: SparkSession, sf_dir: str) -> DataFrame:
    from brightloom.operators.quality import boxplot

    scores = _scored(spark, sf_dir).select("prompt_id", F.col("score.overall").alias("overall")).filter(F.col("overall").isNotNull())
    box = boxplot(scores, "overall", "prompt_id")
    return box.select("prompt_id", *[F.round(c, 9).alias(c) for c in ("q1", "median", "q3")])


def weight_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised weights per customer, where negative balances give no weight."""
    weights = F.create_map(
        F.lit("balance"), F.col("c_acctbal"), F.lit("nation"), F.col("c_nationkey").cast("double"),
        F.lit("none"), -F.col("c_custkey").cast("double"),
    )
    shares = views.table(spark, sf_dir, "customer").select("c_custkey", maths.normalize_weight_map(weights).alias("w"))
    return shares.select("c_custkey", *[F.round(F.col("w")[n], 6).alias(n) for n in ("balance", "nation", "none")])


_RESPONSES = r"""
asked AS (SELECT conv_id, turn, text AS prompt_text FROM conversations WHERE role = 'user'),
answered AS (SELECT conv_id, turn - 1 AS turn, text AS answer FROM conversations WHERE role = 'assistant'),
responses AS (
  SELECT 'exp-' || conv_id % 5 AS experiment_id, 'prompt-' || conv_id % 3 AS prompt_id, 'case-' || turn % 3 AS test_case_id,
    conv_id AS run_number, conv_id * 100 + turn AS seq, prompt_text,
    coalesce(CASE WHEN length(answer) % 11 = 0 THEN ' '
         WHEN turn % 3 = 2 THEN 'json: {"answer": "' || regexp_replace(answer, '["\\\n]', ' ', 'g') || '", "words": '
              || CASE WHEN length(answer) % 2 = 0 THEN CAST(length(answer) AS VARCHAR) ELSE 'null' END || '}'
         ELSE replace(answer, chr(10), chr(10) || '- ') END, '') AS response,
    coalesce(length(answer) % 500 / 1000, 0) AS latency_seconds, length(prompt_text) AS input_tokens,
    CASE WHEN length(answer) % 7 <> 0 THEN length(answer) END AS output_tokens
  FROM asked LEFT JOIN answered USING (conv_id, turn)),
records AS (
  SELECT *, regexp_matches(response, '\S') AS success, len(regexp_extract_all(response, '\S+')) AS words,
    input_tokens / 1000 * 0.5 + output_tokens / 1000 * 1.5 AS cost FROM responses)"""

_CHECKS = _RESPONSES + r""",
facts AS (
  SELECT *, len(list_filter(string_split(response, chr(10)), lambda x: regexp_matches(x, '^\s*(?:[-*+]|\d+[.)])\s+'))) AS bullets,
    CASE WHEN json_valid(nullif(regexp_extract(response, '(?s)\{.*\}'), '')) THEN regexp_extract(response, '(?s)\{.*\}') END AS obj
  FROM records),
checks AS (
  SELECT seq, 1 AS position, 'Contains keyword: und' AS requirement, contains(lower(response), 'und') AS passed, 'k' AS kind FROM facts WHERE test_case_id = 'case-0'
  UNION ALL SELECT seq, 2, 'Contains keyword: the', contains(lower(response), 'the'), 'k' FROM facts WHERE test_case_id = 'case-0'
  UNION ALL SELECT seq, 3, 'Contains keyword: le', contains(lower(response), 'le'), 'k' FROM facts WHERE test_case_id = 'case-0'
  UNION ALL SELECT seq, 4, 'Contains section: die', contains(lower(response), 'die'), 's' FROM facts WHERE test_case_id = 'case-0'
  UNION ALL SELECT seq, 5, 'Minimum words: 10', words >= 10, 'w' FROM facts WHERE test_case_id = 'case-0'
  UNION ALL SELECT seq, 6, 'Maximum words: 120', words <= 120, 'w' FROM facts WHERE test_case_id = 'case-0'
  UNION ALL SELECT seq, 1, 'Contains phrase: en', contains(lower(response), 'en'), 'p' FROM facts WHERE test_case_id = 'case-1'
  UNION ALL SELECT seq, 2, 'Contains phrase: der', contains(lower(response), 'der'), 'p' FROM facts WHERE test_case_id = 'case-1'
  UNION ALL SELECT seq, 3, 'Exactly 5 bullets', bullets = 5, 'b' FROM facts WHERE test_case_id = 'case-1'
  UNION ALL SELECT seq, 1, 'Contains keyword: answer', contains(lower(response), 'answer'), 'k' FROM facts WHERE test_case_id = 'case-2'
  UNION ALL SELECT seq, 2, 'Contains section: json', contains(lower(response), 'json'), 's' FROM facts WHERE test_case_id = 'case-2'
  UNION ALL SELECT seq, 3, 'Matches requested JSON schema',
    coalesce(json_type(CAST(obj AS JSON), '$.answer') = 'VARCHAR' AND json_type(CAST(obj AS JSON), '$.words') IN ('UBIGINT', 'BIGINT'), false), 'j'
    FROM facts WHERE test_case_id = 'case-2'),
shares AS (SELECT seq, count_if(passed) / count(*) AS share,
    count_if(passed AND regexp_matches(lower(requirement), 'section|bullet|json'))
      / nullif(count_if(regexp_matches(lower(requirement), 'section|bullet|json')), 0) * 10 AS format_share
  FROM checks GROUP BY seq),
parts AS (
  SELECT *, list_distinct(list_transform(regexp_extract_all(prompt_text, '[A-Za-z0-9]{4,}'), lambda x: lower(x))) AS asked_words,
    list_distinct(list_transform(regexp_extract_all(response, '[A-Za-z0-9]{4,}'), lambda x: lower(x))) AS answer_words,
    list_filter(string_split_regex(response, '[.!?]+'), lambda x: regexp_matches(x, '\S')) AS sentences,
    CASE test_case_id WHEN 'case-0' THEN (CAST(contains(lower(response), 'und') AS INT) + CAST(contains(lower(response), 'the') AS INT)
           + CAST(contains(lower(response), 'le') AS INT)) / 3 * 4
         WHEN 'case-2' THEN CAST(contains(lower(response), 'answer') AS INT) * 4 ELSE 0 END AS bonus
  FROM facts JOIN shares USING (seq)),
criteria AS (
  SELECT seq, experiment_id, prompt_id, test_case_id, success, latency_seconds, words,
    CASE WHEN len(asked_words) = 0 THEN 5.0 ELSE least(10, len(list_intersect(asked_words, answer_words)) / len(asked_words) * 7 + bonus) END AS relevance,
    7.0 - least(3.0, 0.5 * len(regexp_extract_all(response, '(?i)\b(?:maybe|possibly|not sure|i think)\b'))) AS accuracy,
    CASE WHEN len(sentences) = 0 THEN 5.0 ELSE 9.0
      - CASE WHEN list_avg(list_transform(sentences, lambda s: len(regexp_extract_all(s, '\S+')))) > 35 THEN 2 ELSE 0 END
      - CASE WHEN list_avg(list_transform(sentences, lambda s: len(regexp_extract_all(s, '\S+')))) > 55 THEN 2 ELSE 0 END
      + CASE WHEN contains(response, chr(10)) THEN 0.5 ELSE 0 END END AS clarity,
    share * 10 AS completeness, share * 10 AS instruction_following, format_share AS format_compliance,
    CASE WHEN regexp_matches(response, '(?i)\b(?:steal|bypass security|credential theft|malware)\b') THEN 4.0 ELSE 10.0 END AS safety,
    CASE WHEN test_case_id = 'case-0' THEN CASE WHEN words <= 120 THEN 10.0 ELSE greatest(0, 10 - (words - 120) / 120 * 10) END
         WHEN words <= 250 THEN 9.0 WHEN words <= 500 THEN 8.0 WHEN words <= 1000 THEN 7.0 ELSE 5.0 END AS conciseness
  FROM parts),
scored AS (
  SELECT * REPLACE (CAST(relevance AS DOUBLE) AS relevance, CAST(accuracy AS DOUBLE) AS accuracy, CAST(clarity AS DOUBLE) AS clarity,
                    CAST(safety AS DOUBLE) AS safety, CAST(conciseness AS DOUBLE) AS conciseness),
    least(10.0, greatest(0.0, CAST((relevance * 1.2 + accuracy * 1.2 + clarity * 1.0 + completeness * 1.0 + instruction_following * 1.2
      + format_compliance * 1.0 + safety * 0.5 + conciseness * 0.8) / 7.9 AS DOUBLE))) AS overall
  FROM criteria WHERE success
  UNION ALL BY NAME
  SELECT seq, experiment_id, prompt_id, test_case_id, success, latency_seconds, words FROM criteria WHERE NOT success)"""

_CRITERIA = ("relevance", "accuracy", "clarity", "completeness", "instruction_following",
             "format_compliance", "safety", "conciseness", "overall")

_GRID = r"""
prompts AS (
  SELECT 'exp-' || c_custkey AS experiment_id, c_custkey AS eseq, c_mktsegment AS segment, c_nationkey AS nation, c_acctbal,
    unnest([0, 1, 2]) AS pseq, unnest(['baseline', 'detailed', 'broken']) AS prompt_id FROM customer),
grid AS (
  SELECT experiment_id, eseq, pseq, prompt_id, c_acctbal, cseq, 'for-' || audience AS test_case_id, run_number,
    CASE prompt_id WHEN 'baseline' THEN 'Explain ' || segment || ' accounts to ' || audience || '.'
      WHEN 'detailed' THEN 'List the risks for ' || segment || ' in nation ' || nation || ', as {json}.'
      ELSE 'Summarise {missing} for {segment}.' END AS prompt_text,
    CASE prompt_id WHEN 'detailed' THEN 'large-model' ELSE 'demo-model' END AS model,
    CAST(CASE prompt_id WHEN 'detailed' THEN 0.7 ELSE 0.2 END AS DOUBLE) AS temperature
  FROM prompts, (SELECT unnest([0, 1]) AS cseq, unnest(['analysts', 'children']) AS audience), (SELECT unnest([1, 2]) AS run_number)),
keyed AS (
  SELECT *, sha256('{"max_tokens": 800, "model": ' || CAST(to_json(model) AS VARCHAR) || ', "prompt": ' || CAST(to_json(prompt_text) AS VARCHAR)
    || ', "provider": "demo", "system": "Be brief.", "temperature": ' || temperature || '}') AS cache_key,
    ((eseq * 10 + pseq) * 10 + cseq) * 10 + run_number AS gseq
  FROM grid)"""

PLANS = {
    "prompt_library": (
        prompt_library,
        """
        WITH p AS (
          SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS prompt_id, o_orderpriority AS name,
            CASE WHEN o_orderstatus = 'P' THEN '' ELSE 'Say {x}' END AS text,
            o_orderstatus = 'O' AND o_totalprice / 200000 BETWEEN 0 AND 2 AS valid FROM orders)
        SELECT prompt_id, CASE WHEN valid THEN name ELSE 'old' END AS name, text,
          k = (SELECT min(k) FROM p WHERE k % 2 = 0) AS found
        FROM p WHERE valid OR k % 2 = 0""",
    ),
    "experiments_created": (
        experiments_created,
        """SELECT 'exp-' || c_custkey AS experiment_id, c_name AS name,
          CAST(greatest(1, c_nationkey % 3) AS BIGINT) AS runs_per_case, false AS blind_evaluation FROM customer""",
    ),
    "experiment_grid": (
        experiment_grid,
        with_ctes(
            _GRID,
            """SELECT experiment_id, prompt_id, test_case_id, prompt_text, model, temperature, CAST(800 AS BIGINT) AS max_tokens,
              CAST(run_number AS BIGINT) AS run_number, cache_key FROM keyed""",
        ),
    ),
    "cache_lookup": (
        cache_lookup,
        with_ctes(
            _GRID
            + """,
        stored AS (
          SELECT cache_key, 'cached ' || any_value(prompt_text) AS text FROM keyed
          WHERE prompt_id = 'baseline' AND test_case_id = 'for-analysts' AND run_number = 1 AND c_acctbal > 9000 GROUP BY cache_key),
        latest AS (
          SELECT 'exp-' || user_id AS experiment_id, event_type = 'error' AS failed, value, props FROM events
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
        own AS (
          SELECT k.*, l.failed, l.value, CASE WHEN NOT l.failed THEN l.props END AS own_text, l.props
          FROM keyed k LEFT JOIN latest l USING (experiment_id)),
        first AS (
          SELECT cache_key, min(gseq) AS gseq, arg_min(own_text, gseq) AS text, arg_min(floor(value), gseq) AS tin,
                 arg_min(length(props), gseq) AS tout FROM own WHERE own_text IS NOT NULL GROUP BY cache_key),
        found AS (
          SELECT o.*, s.text AS stored_text, f.text AS first_text, f.tin, f.tout,
            s.text IS NOT NULL AS in_cache, s.text IS NULL AND f.gseq < o.gseq AS repeated
          FROM own o LEFT JOIN stored s USING (cache_key) LEFT JOIN first f USING (cache_key)),
        done AS (
          SELECT *, in_cache OR coalesce(repeated, false) AS hit,
            coalesce(CASE WHEN in_cache THEN stored_text WHEN repeated THEN first_text ELSE own_text END, '') AS response FROM found)""",
            r"""SELECT experiment_id, prompt_id, test_case_id, CAST(run_number AS BIGINT) AS run_number, response,
              regexp_matches(response, '\S') AS success,
              CASE WHEN regexp_matches(response, '\S') THEN '' WHEN failed THEN 'ProviderError: request failed'
                   WHEN failed IS NULL THEN 'No response supplied' ELSE 'Empty response' END AS error_message,
              hit AS cache_hit, CASE WHEN hit THEN 0.0::DOUBLE ELSE coalesce(round(value / 100, 4), 0.0) END AS latency_seconds,
              CASE WHEN in_cache THEN round(10 / 1000 * 0.5 + 20 / 1000 * 1.5, 6)
                   WHEN repeated THEN round(tin / 1000 * 0.5 + tout / 1000 * 1.5, 6)
                   WHEN own_text IS NOT NULL THEN round(floor(value) / 1000 * 0.5 + length(props) / 1000 * 1.5, 6) END::DOUBLE AS estimated_cost,
              len(regexp_extract_all(response, '\S+')) AS response_words
            FROM done""",
        ),
    ),
    "render_prompts": (
        render_prompts,
        """
        SELECT o_orderkey, CASE o_orderstatus
          WHEN 'F' THEN 'Order ' || o_orderkey || ' is {priority}: ' || o_orderpriority
          WHEN 'O' THEN 'Order {id} {{keeps}} {unknown}'
          ELSE '{' || o_orderkey || '} of {priority}, ' || o_orderpriority END AS rendered
        FROM orders""",
    ),
    "prompt_versions": (
        prompt_versions,
        """
        WITH p AS (
          SELECT 'exp-' || c_custkey AS experiment_id, unnest(['baseline', 'detailed', 'broken']) AS prompt_id,
            unnest(['Explain {segment} accounts to {audience}.', 'List the risks for {segment} in nation {nation}, as {{json}}.',
                    'Summarise {missing} for {segment}.']) AS text,
            unnest([NULL, 'large-model', '']) AS model FROM customer)
        SELECT experiment_id, prompt_id, 'Prompt ' || prompt_id AS name, text, '1.0' AS version, '' AS notes, model FROM p
        UNION ALL
        SELECT experiment_id, 'baseline-v1-1', 'Prompt baseline v1.1', 'Shortly: ' || text, '1.1', 'Versioned from baseline', model
        FROM p WHERE prompt_id = 'baseline'""",
    ),
    "row_validation": (
        row_validation,
        """
        WITH p AS (
          SELECT 'exp-' || o_custkey AS experiment_id, CASE WHEN o_totalprice < 20000 THEN ' ' ELSE o_orderpriority END AS name, * FROM orders),
        c AS (SELECT 'exp-' || c_custkey AS experiment_id, CASE WHEN c_acctbal < 0 THEN 60 END AS low, * FROM customer)
        SELECT experiment_id, 'experiment' AS level, 'Experiment name is required.' AS error FROM c WHERE c_acctbal < 0
        UNION ALL SELECT experiment_id, 'experiment', 'At least one prompt is required.' FROM c WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
        UNION ALL SELECT experiment_id, 'experiment', 'runs_per_case must be positive.' FROM c WHERE c_mktsegment = 'MACHINERY'
        UNION ALL SELECT experiment_id, 'prompt', name || ': Prompt name is required.' FROM p WHERE name = ' '
        UNION ALL SELECT experiment_id, 'prompt', name || ': Prompt text is required.' FROM p WHERE o_orderstatus = 'P'
        UNION ALL SELECT experiment_id, 'prompt', name || ': Temperature should normally be between 0 and 2.' FROM p WHERE o_totalprice / 200000 > 2
        UNION ALL SELECT experiment_id, 'prompt', name || ': max_tokens must be positive.' FROM p WHERE o_orderstatus = 'F'
        UNION ALL SELECT experiment_id, 'case', 'Case analysts: min_words cannot exceed max_words.' FROM c WHERE low > 50
        UNION ALL SELECT experiment_id, 'case', 'Case children: min_words cannot exceed max_words.' FROM c WHERE low > 20""",
    ),
    "experiment_sizes": (
        experiment_sizes,
        """
        WITH p AS (SELECT o_custkey AS experiment_id, count(*) AS prompts FROM orders GROUP BY 1),
        c AS (SELECT user_id AS experiment_id, count(*) AS test_cases FROM events GROUP BY 1),
        j AS (SELECT experiment_id, coalesce(prompts, 0) AS prompts, coalesce(test_cases, 0) AS test_cases
              FROM p FULL JOIN c USING (experiment_id))
        SELECT *, CAST(1 AS BIGINT) AS runs, prompts * test_cases AS request_count,
          CASE WHEN prompts * test_cases > 20 THEN 'Review request count before starting large API experiments.' ELSE '' END AS warning
        FROM j""",
    ),
    "requirements": (
        requirements,
        with_ctes(
            _CHECKS,
            """SELECT c.seq, CAST(position AS BIGINT) AS position, requirement, passed, CASE kind
              WHEN 'k' THEN CASE WHEN passed THEN 'Keyword found.' ELSE 'Keyword not found.' END
              WHEN 'p' THEN CASE WHEN passed THEN 'Phrase found.' ELSE 'Phrase not found.' END
              WHEN 's' THEN CASE WHEN passed THEN 'Section text found.' ELSE 'Section text not found.' END
              WHEN 'w' THEN 'Observed ' || words || ' words.'
              WHEN 'b' THEN 'Observed ' || bullets || ' bullets.'
              ELSE CASE WHEN obj IS NULL THEN 'Response is not a valid JSON object.'
                        WHEN passed THEN 'JSON structure satisfies the configured checks.'
                        ELSE 'Field ''words'' has the wrong type.' END END AS detail
            FROM checks c JOIN facts f USING (seq)""",
        ),
    ),
    "rubric_scores": (
        rubric_scores,
        with_ctes(_CHECKS, "SELECT seq, success, " + ", ".join(f"round({c}, 9) AS {c}" for c in _CRITERIA) + " FROM scored"),
    ),
    "judged_scores": (
        judged_scores,
        with_ctes(
            _CHECKS + ", j AS (SELECT seq, run_number, quality, toxic FROM responses LEFT JOIN labels ON doc_id = run_number)",
            """SELECT seq, CASE WHEN success AND quality = 1 THEN CAST(8 - 4 * toxic AS DOUBLE) ELSE round(overall, 9) END AS overall,
              CASE WHEN success THEN CASE WHEN quality = 1 THEN 'model-based' ELSE 'rule-based' END END AS mode,
              CASE WHEN success THEN CASE quality WHEN 1 THEN 'labelled' WHEN 0 THEN right(': no verdict', 12)
                                          ELSE right('This is not a factuality guarantee.', 12) END END AS reason_end
            FROM scored JOIN j USING (seq)""",
        ),
    ),
    "judge_prompts": (
        judge_prompts,
        with_ctes(
            _RESPONSES,
            "SELECT seq, md5('" + rubric.JUDGE_INTRO + "' || chr(10) || chr(10) || 'TASK:' || chr(10)"
            " || CASE test_case_id WHEN 'case-0' THEN 'Summarise the question.' WHEN 'case-1' THEN 'List the steps.' ELSE 'Answer as JSON.' END"
            " || chr(10) || chr(10) || 'PROMPT:' || chr(10) || prompt_text || chr(10) || chr(10) || 'RESPONSE:' || chr(10) || response"
            " || chr(10) || chr(10) || 'WEIGHTS:' || chr(10) || '{' || chr(10) || '  \"relevance\": 0.125,' || chr(10) || '  \"accuracy\": 0.125,'"
            " || chr(10) || '  \"clarity\": 0.125,' || chr(10) || '  \"completeness\": 0.125,' || chr(10) || '  \"instruction_following\": 0.125,'"
            " || chr(10) || '  \"format_compliance\": 0.125,' || chr(10) || '  \"safety\": 0.125,' || chr(10) || '  \"conciseness\": 0.125'"
            " || chr(10) || '}') AS judge_prompt_md5 FROM responses",
        ),
    ),
    "response_records": (
        response_records,
        with_ctes(
            _RESPONSES,
            r"""SELECT seq, prompt_id, success, CASE WHEN success THEN '' ELSE 'Empty response' END AS error_message,
              round(cost, 6)::DOUBLE AS estimated_cost, words AS response_words,
              len(list_filter(string_split(response, chr(10)), lambda x: regexp_matches(x, '\S'))) AS response_lines,
              length(response) AS response_characters FROM records""",
        ),
    ),
    "phrase_compliance": (
        phrase_compliance,
        """
        WITH f AS (SELECT doc_id, CASE WHEN n_chars > 200 THEN 5 ELSE 0 END AS total, CASE WHEN n_chars > 200 THEN
          CAST(contains(lower(text), 'the') AS INT) + CAST(contains(lower(text), 'ment') AS INT) + CAST(contains(lower(text), 'und') AS INT)
          + CAST(contains(lower(text), 'zu') AS INT) + CAST(contains(lower(text), 'zx') AS INT) ELSE 0 END AS passed FROM documents)
        SELECT doc_id, CAST(passed AS BIGINT) AS passed, CAST(total AS BIGINT) AS total,
          CASE WHEN total = 0 THEN 1.0 ELSE round(passed / 5, 4) END::DOUBLE AS compliance, passed = total AS all_passed FROM f""",
    ),
    "prompt_ranking": (
        prompt_ranking,
        with_ctes(
            _CHECKS
            + """,
        g AS (SELECT experiment_id, prompt_id, avg(overall) AS a, median(overall) AS m, min(overall) AS lo, max(overall) AS hi,
                     coalesce(stddev_samp(overall), 0) AS sd, avg(latency_seconds) AS lat, avg(words) AS w, count(*) AS n, min(seq) AS first
              FROM scored WHERE success GROUP BY 1, 2)""",
            """SELECT experiment_id, prompt_id, round(a, 9) AS average_score, round(m, 9) AS median_score, round(lo, 9) AS minimum_score,
              round(hi, 9) AS maximum_score, round(sd, 9) AS score_std_dev, round(lat, 9) AS average_latency,
              round(w, 9) AS average_response_words, n AS successful_runs,
              row_number() OVER (PARTITION BY experiment_id ORDER BY a DESC, sd, first) AS rank FROM g""",
        ),
    ),
    "experiment_summary": (
        experiment_summary,
        with_ctes(
            _CHECKS,
            """SELECT experiment_id, count(*) AS total_requests, count(*) FILTER (success) AS successful_requests,
              count(*) FILTER (NOT success) AS failed_requests, coalesce(round(avg(overall), 9), 0) AS average_score,
              coalesce(round(avg(latency_seconds) FILTER (success), 9), 0) AS average_latency,
              coalesce(round(avg(words) FILTER (success), 9), 0) AS average_response_words,
              coalesce(round(stddev_samp(overall), 9), 0) AS score_std_dev
            FROM scored GROUP BY experiment_id""",
        ),
    ),
    "score_matrix": (
        score_matrix,
        with_ctes(
            _CHECKS + """, cells AS (SELECT experiment_id, prompt_id, test_case_id, arg_max(overall, seq) AS overall
              FROM scored WHERE success GROUP BY 1, 2, 3)""",
            """SELECT experiment_id, prompt_id, round(max(overall) FILTER (test_case_id = 'case-0'), 9) AS "case-0",
              round(max(overall) FILTER (test_case_id = 'case-1'), 9) AS "case-1",
              round(max(overall) FILTER (test_case_id = 'case-2'), 9) AS "case-2"
            FROM cells GROUP BY 1, 2""",
        ),
    ),
    "ab_compare": (
        ab_compare,
        with_ctes(
            _CHECKS
            + """,
        m AS (SELECT experiment_id, coalesce(avg(overall) FILTER (success AND prompt_id = 'prompt-0'), 0) AS sa,
                coalesce(avg(overall) FILTER (success AND prompt_id = 'prompt-1'), 0) AS sb,
                coalesce(avg(latency_seconds) FILTER (success AND prompt_id = 'prompt-0'), 0) AS la,
                coalesce(avg(latency_seconds) FILTER (success AND prompt_id = 'prompt-1'), 0) AS lb FROM scored GROUP BY 1)""",
            """SELECT experiment_id, round(sa, 9) AS average_score_a, round(sb, 9) AS average_score_b, round(la, 9) AS average_latency_a,
              round(lb, 9) AS average_latency_b, CASE WHEN sa > sb THEN 'prompt-0' WHEN sb > sa THEN 'prompt-1' ELSE 'Tie' END AS winner,
              false AS statistically_significant FROM m""",
        ),
    ),
    "group_compare": (
        group_compare,
        """
        WITH m AS (SELECT avg(CASE WHEN value < 5 THEN 0 ELSE value END) FILTER (event_type = 'purchase') AS l,
                          avg(CASE WHEN value < 5 THEN 0 ELSE value END) FILTER (event_type = 'click') AS r FROM events)
        SELECT round(l, 9) AS left_mean, round(r, 9) AS right_mean, round(l - r, 9) AS difference,
          CASE WHEN l > r THEN 'left' WHEN r > l THEN 'right' ELSE 'tie' END AS winner FROM m""",
    ),
    "cost_total": (
        cost_total,
        with_ctes(
            _RESPONSES,
            """SELECT experiment_id, test_case_id, prompt_id,
              CASE WHEN count(cost) = count_if(success) THEN round(coalesce(sum(cost), 0), 9) END::DOUBLE AS estimated_total_cost,
              count(cost) = count_if(success) AS available
            FROM records GROUP BY 1, 2, 3""",
        ),
    ),
    "blind_labels": (
        blind_labels,
        with_ctes(
            _RESPONSES,
            """SELECT experiment_id, 'Response ' || row_number() OVER (PARTITION BY experiment_id ORDER BY seq) AS label,
              length(response) AS verdict, prompt_id FROM responses""",
        ),
    ),
    "words_by_prompt": (
        words_by_prompt,
        with_ctes(_RESPONSES, "SELECT experiment_id, prompt_id, round(avg(words), 9) AS words FROM records WHERE success GROUP BY 1, 2"),
    ),
    "number_stats": (
        number_stats,
        """
        WITH v AS (SELECT event_type, CASE WHEN value < 5 THEN 0 ELSE value END AS x FROM events)
        SELECT event_type, count(*) AS count, round(avg(x), 9) AS mean, round(median(x), 9) AS median, round(min(x), 9) AS minimum,
          round(max(x), 9) AS maximum, round(stddev_samp(x), 9) AS std_dev, round(max(x) - min(x), 9) AS range
        FROM v GROUP BY event_type""",
    ),
    "score_boxplot": (
        score_boxplot,
        with_ctes(
            _CHECKS,
            """SELECT prompt_id, round(quantile_cont(overall, 0.25), 9) AS q1, round(quantile_cont(overall, 0.5), 9) AS median,
              round(quantile_cont(overall, 0.75), 9) AS q3 FROM scored WHERE overall IS NOT NULL GROUP BY prompt_id""",
        ),
    ),
    "weight_shares": (
        weight_shares,
        """
        WITH w AS (SELECT c_custkey, greatest(c_acctbal, 0) AS b, CAST(c_nationkey AS DOUBLE) AS n FROM customer)
        SELECT c_custkey, CASE WHEN b + n <= 0 THEN round(1 / 3, 6) ELSE round(b / (b + n), 6) END AS balance,
          CASE WHEN b + n <= 0 THEN round(1 / 3, 6) ELSE round(n / (b + n), 6) END AS nation,
          CASE WHEN b + n <= 0 THEN round(1 / 3, 6) ELSE CAST(0 AS DOUBLE) END AS none FROM w""",
    ),
}
