"""Requirement checks, scores, response collection, statistics, history and cache."""

import random

import pytest
from pyspark.sql import functions as F

from brightloom.functions import rubric
from brightloom.operators import evaluation, experiments
from brightloom.operators.experiments import ModelConfig

CASE = (
    "expected_keywords array<string>, required_phrases array<string>, required_sections array<string>, min_words int, "
    "max_words int, exact_bullet_count int, expected_json_schema struct<required:array<string>,properties:map<string,string>>"
)


def scored(spark, prompt, response, success=True, keywords=(), phrases=(), sections=(), low=None, high=None, bullets=None, schema=None, weights=None):
    df = spark.createDataFrame(
        [(prompt, response, success, list(keywords), list(phrases), list(sections), low, high, bullets, schema)],
        f"prompt_text string, response string, success boolean, {CASE}",
    )
    return rubric.rule_score(df, weights).first()


def test_requirement_order_and_texts(spark):
    row = scored(spark, "p", "Python is\n- useful", keywords=["python"], phrases=["nope"], sections=["IS"], low=1, high=2, bullets=1,
                 schema=(["a"], {"a": "string"}))
    assert [(r.requirement, r.passed, r.detail) for r in row["requirements"]] == [
        ("Contains keyword: python", True, "Keyword found."),
        ("Contains phrase: nope", False, "Phrase not found."),
        ("Contains section: IS", True, "Section text found."),
        ("Minimum words: 1", True, "Observed 4 words."),
        ("Maximum words: 2", False, "Observed 4 words."),
        ("Exactly 1 bullets", True, "Observed 1 bullets."),
        ("Matches requested JSON schema", False, "Response is not a valid JSON object."),
    ]
    assert row["score"].completeness == pytest.approx(40 / 7)
    assert row["score"].format_compliance == pytest.approx(20 / 3)
    assert row["score"].conciseness == 0.0


def test_scores(spark):
    row = scored(spark, "Explain gravity", "Gravity is an attractive force.", keywords=["gravity"])
    score = row["score"]
    assert (score.relevance, score.accuracy, score.clarity, score.completeness) == (7.5, 7.0, 9.0, 10.0)
    assert (score.format_compliance, score.safety, score.conciseness) == (8.0, 10.0, 9.0)
    assert score.overall == pytest.approx((7.5 + 7 + 9 + 10 + 10 + 8 + 10 + 9) / 8)
    assert scored(spark, "p", "x", success=False)["score"] is None
    hedged = scored(spark, "word", "Maybe it is, i think. " * 9 + "malware")["score"]
    assert (hedged.accuracy, hedged.safety) == (4.0, 4.0)
    long = scored(spark, "a b", ("word " * 60) + "\nend")["score"]
    assert (long.clarity, long.relevance) == (5.5, 5.0)
    over = scored(spark, "p", "a b c", high=2)["score"]
    assert over.conciseness == 5.0


def brute_collect(grid, supplied, cache):
    known, out = dict(cache), {}
    for row in sorted(grid, key=lambda r: r["grid_seq"]):
        answer = supplied.get(row["experiment_id"])
        if row["cache_key"] in known:
            out[row["grid_seq"]] = (known[row["cache_key"]], True, 0.0)
        elif answer is None or answer[0] is None:
            out[row["grid_seq"]] = ("", False, answer[1] if answer else 0.0)
        else:
            known[row["cache_key"]] = answer[0]
            out[row["grid_seq"]] = (answer[0], False, answer[1])
    return out


def test_collect_matches_a_sequential_run(spark):
    """Random keys with one that most requests share."""
    draw = random.Random(3)
    grid_rows = [(f"e{i}", "p", "t", 1, (i, 0, 0, 1), "hot" if draw.random() < 0.6 else f"k{draw.randrange(20)}", "x", "m") for i in range(200)]
    grid = spark.createDataFrame(
        grid_rows, "experiment_id string, prompt_id string, test_case_id string, run_number int, "
        "grid_seq struct<experiment_seq:long,prompt_seq:int,case_seq:int,run_number:int>, cache_key string, prompt_text string, model string",
    )
    answers = {f"e{i}": (None if draw.random() < 0.3 else f"text {i} " if draw.random() < 0.9 else " ", i / 10) for i in range(150)}
    supplied = spark.createDataFrame(
        [(e, t, None if t else "boom", 1, 2, latency) for e, (t, latency) in answers.items()],
        "experiment_id string, text string, error_message string, input_tokens int, output_tokens int, latency_seconds double",
    )
    cache = spark.createDataFrame([("k3", "old", "m", 5, 6)], "cache_key string, text string, model string, input_tokens int, output_tokens int")
    want = brute_collect([r.asDict() | {"grid_seq": tuple(r["grid_seq"])} for r in grid.collect()], answers, {"k3": "old"})
    for config, store in ((ModelConfig(), cache), (ModelConfig(cache_enabled=False), None)):
        got = experiments.collect_responses(grid, supplied, ["experiment_id"], store, config).collect()
        assert len(got) == 200
        for row in got:
            if config.cache_enabled:
                assert (row["response"], row["cache_hit"], row["latency_seconds"]) == want[tuple(row["grid_seq"])]
            assert row["success"] == bool(row["response"].strip())
            if not row["response"]:
                assert row["error_message"] in ("boom", experiments.NO_RESPONSE)


def responses(spark, rows):
    return spark.createDataFrame(
        rows, "prompt_id string, test_case_id string, seq long, success boolean, overall double, latency_seconds double, response_words long"
    ).withColumn("score", F.when(F.col("overall").isNotNull(), F.struct("overall")))


def test_statistics(spark):
    df = responses(spark, [
        ("a", "t", 1, True, 4.0, 1.0, 10), ("a", "t", 2, True, 6.0, 3.0, 20), ("b", "t", 3, True, 5.0, 1.0, 5),
        ("b", "u", 4, False, None, 9.0, 0), ("c", "t", 5, True, None, 2.0, 7),
    ])
    ranked = {r["prompt_id"]: r for r in evaluation.ranking(df).collect()}
    assert [ranked[p]["rank"] for p in "bac"] == [1, 2, 3]
    assert (ranked["a"]["median_score"], ranked["a"]["average_latency"], ranked["c"]["average_score"]) == (5.0, 2.0, 0.0)
    assert (ranked["b"]["score_std_dev"], ranked["b"]["successful_runs"]) == (0.0, 1)
    summary = evaluation.overall_summary(df).first()
    assert (summary["total_requests"], summary["failed_requests"], summary["average_score"]) == (5, 1, 5.0)
    assert {r["prompt_id"]: r["t"] for r in evaluation.score_matrix(df, ["t", "u"]).collect()} == {"a": 6.0, "b": 5.0}
    compared = evaluation.ab_compare(df, "a", "b").first()
    assert (compared["winner"], compared["average_latency_b"]) == ("Tie", 1.0)
    assert evaluation.ab_compare(df, "a", "zz").first()["winner"] == "a"


def test_cost(spark):
    schema = "success boolean, estimated_cost double"
    known = evaluation.cost_total(spark.createDataFrame([(True, 1.5), (True, 2.0), (False, None)], schema)).first()
    assert (known["estimated_total_cost"], known["available"]) == (3.5, True)
    unknown = evaluation.cost_total(spark.createDataFrame([(True, 1.5), (True, None)], schema)).first()
    assert (unknown["estimated_total_cost"], unknown["available"]) == (None, False)


def test_number_stats_of_nothing(spark):
    row = evaluation.number_stats(spark.createDataFrame([], "x string"), "x").first()
    assert (row["count"], row["mean"], row["median"], row["range"]) == (0, 0.0, 0.0, 0.0)


def test_history_cache_and_prompts(spark, tmp_path):
    path = str(tmp_path / "history")
    schema = "experiment_id string, value int"
    assert experiments.load_history(spark, path, schema).count() == 0
    experiments.save_history(spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], schema), path)
    experiments.save_history(spark.createDataFrame([("a", 9)], schema), path)
    stored = experiments.load_history(spark, path, schema)
    assert sorted((r["experiment_id"], r["value"]) for r in stored.collect()) == [("a", 9), ("b", 3)]
    assert experiments.get_history(stored, "zz").isEmpty()
    one = experiments.load_history(spark, path, stored.schema, "a")
    assert one.count() == 1 and one.columns == stored.columns

    entry = "cache_key string, text string, written_at long"
    cache = experiments.cache_put(spark.createDataFrame([("k", "old", 1)], entry), spark.createDataFrame([("k", "new", 2), ("l", "x", 1)], entry))
    assert {r["cache_key"]: r["text"] for r in cache.collect()} == {"k": "new", "l": "x"}
    assert experiments.cache_get(cache, "k").count() == 1 and experiments.cache_clear(cache).isEmpty()

    fields = "prompt_id string, name string, text string, temperature double, max_tokens int"
    prompts, rejected = experiments.add_prompts(
        spark.createDataFrame([("p", "n", "old", None, None)], fields),
        spark.createDataFrame([("p", "n", "new", 0.5, 10), ("q", " ", "", 3.0, 0)], fields),
    )
    assert [r["text"] for r in prompts.collect()] == ["new"]
    assert rejected.first()["errors"] == [
        "Prompt name is required.", "Prompt text is required.", "Temperature should normally be between 0 and 2.", "max_tokens must be positive."
    ]
    assert experiments.get_prompt(prompts, "p").count() == 1
    with pytest.raises(KeyError):
        experiments.get_prompt(prompts, "zz")


def test_create_experiments(spark):
    definitions = spark.createDataFrame([(None, "n", None, None), ("mine", "m", 3, True)],
                                        "experiment_id string, name string, runs_per_case int, blind_evaluation boolean")
    named = experiments.assign_experiment_ids(definitions)
    rows = {r["name"]: r for r in named.collect()}
    assert rows == {r["name"]: r for r in named.collect()}
    assert rows["n"]["experiment_id"].startswith("exp-") and len(rows["n"]["experiment_id"]) == 14
    assert (rows["n"]["runs_per_case"], rows["n"]["blind_evaluation"], rows["m"]["experiment_id"]) == (1, False, "mine")
    prompts = named.selectExpr("experiment_id", "'p' AS prompt_id", "'n' AS name", "'t' AS text", "CAST(NULL AS double) AS temperature", "1 AS max_tokens")
    cases = named.selectExpr("experiment_id", "'c' AS test_case_id", "'n' AS name", "1 AS min_words", "2 AS max_words")
    assert experiments.create_experiments(named, prompts, cases).count() == 2
    with pytest.raises(ValueError, match="At least one prompt"):
        experiments.create_experiments(named, prompts.limit(0), cases)


def test_judge_choice(spark):
    df = spark.createDataFrame(
        [(1, True, (5.0, "rule", "rule-based")), (2, True, (5.0, "rule", "rule-based")), (3, False, None)],
        "id int, success boolean, score struct<overall:double,reason:string,evaluator_mode:string>",
    )
    judged = spark.createDataFrame(
        [(1, (9.0, "judge", "model-based"), None), (2, None, "bad reply"), (3, (9.0, "judge", "model-based"), None)],
        "id int, judge_score struct<overall:double,reason:string,evaluator_mode:string>, judge_error string",
    )
    got = {r["id"]: r["score"] for r in experiments.prefer_judge(df, judged, ["id"]).collect()}
    assert got[1].overall == 9.0 and got[3] is None
    assert got[2].reason == "rule Model evaluator failed: bad reply"
