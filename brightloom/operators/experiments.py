"""Prompt experiments as tables: grid, response collection, cache, history, validation.

Prompts, test cases and results are separate tables keyed by experiment_id. All
joins are equi-joins; no operator gathers an experiment in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brightloom.functions import maths, text
from brightloom.operators.ordering import row_numbers
from brightloom.session import checkpointed
from brightloom.sources.snapshots import SnapshotTable

HISTORY_BUCKETS = 64

# Validation messages and the size warning.
PROMPT_RULES = {
    "id": "Prompt ID is required.",
    "name": "Prompt name is required.",
    "text": "Prompt text is required.",
    "temperature": "Temperature should normally be between 0 and 2.",
    "max_tokens": "max_tokens must be positive.",
}
CASE_RULES = {
    "id": "Test case ID is required.",
    "name": "Test case name is required.",
    "max_words": "max_words must be positive.",
    "min_words": "min_words cannot be negative.",
    "order": "min_words cannot exceed max_words.",
}
EXPERIMENT_RULES = {
    "id": "Experiment ID is required.",
    "name": "Experiment name is required.",
    "prompts": "At least one prompt is required.",
    "cases": "At least one test case is required.",
    "runs": "runs_per_case must be positive.",
}
EMPTY_RESPONSE = "Empty response"
NO_RESPONSE = "No response supplied"
SIZE_WARNING = "Review request count before starting large API experiments."
SIZE_LIMIT = 20


@dataclass(frozen=True)
class ModelConfig:
    """Settings shared by the requests of an experiment."""

    provider_name: str = "demo"
    model_name: str = "demo-model"
    temperature: float = 0.2
    max_tokens: int = 800
    input_cost_per_1k: float | None = None
    output_cost_per_1k: float | None = None
    cache_enabled: bool = True


def _missing(value: Column) -> Column:
    return text.is_blank(value)


def _errors(*rules: tuple[Column, Column | str]) -> Column:
    found = [F.when(F.coalesce(broken, F.lit(False)), m if isinstance(m, Column) else F.lit(m)) for broken, m in rules]
    return F.filter(F.array(*found), lambda e: e.isNotNull())


def prompt_errors() -> Column:
    """array<string> of what is wrong with a prompt row."""
    return _errors(
        (_missing(F.col("prompt_id")), PROMPT_RULES["id"]),
        (_missing(F.col("name")), PROMPT_RULES["name"]),
        (_missing(F.col("text")), PROMPT_RULES["text"]),
        (~F.col("temperature").between(0, 2), PROMPT_RULES["temperature"]),
        (F.col("max_tokens") <= 0, PROMPT_RULES["max_tokens"]),
    )


def case_errors() -> Column:
    """array<string> of what is wrong with a test-case row."""
    return _errors(
        (_missing(F.col("test_case_id")), CASE_RULES["id"]),
        (_missing(F.col("name")), CASE_RULES["name"]),
        (F.col("max_words") <= 0, CASE_RULES["max_words"]),
        (F.col("min_words") < 0, CASE_RULES["min_words"]),
        (F.col("min_words") > F.col("max_words"), CASE_RULES["order"]),
    )


def experiment_errors(experiments: DataFrame, prompts: DataFrame, cases: DataFrame) -> DataFrame:
    """One row per error: (experiment_id, level, error); child errors carry the child's name.

    Errors stay rows instead of one list per experiment, so an experiment with
    very many children is spread over tasks like any other.
    """
    counts = experiments.join(_per_experiment(prompts, "prompts"), "experiment_id", "left").join(
        _per_experiment(cases, "cases"), "experiment_id", "left"
    )
    own = counts.select(
        "experiment_id",
        F.lit("experiment").alias("level"),
        F.explode(
            _errors(
                (_missing(F.col("experiment_id")), EXPERIMENT_RULES["id"]),
                (_missing(F.col("name")), EXPERIMENT_RULES["name"]),
                (F.coalesce("prompts", F.lit(0)) == 0, EXPERIMENT_RULES["prompts"]),
                (F.coalesce("cases", F.lit(0)) == 0, EXPERIMENT_RULES["cases"]),
                (F.col("runs_per_case") <= 0, EXPERIMENT_RULES["runs"]),
            )
        ).alias("error"),
    )

    def children(rows: DataFrame, level: str, errors: Column) -> DataFrame:
        return rows.select("experiment_id", F.lit(level).alias("level"), "name", F.explode(errors).alias("e")).select(
            "experiment_id", "level", F.concat("name", F.lit(": "), "e").alias("error")
        )

    return own.unionByName(children(prompts, "prompt", prompt_errors())).unionByName(
        children(cases, "case", case_errors())
    )


def _per_experiment(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("experiment_id").agg(F.count(F.lit(1)).alias(name))


def assign_experiment_ids(definitions: DataFrame) -> DataFrame:
    """Definitions with defaults; rows without an id get `exp-` and ten hex digits.

    The rows are checkpointed, as a generated id must not change when the frame is
    read again. Join prompts and test cases to the result to give them their id.
    """
    generated = F.concat(F.lit("exp-"), F.left(F.replace(F.uuid(), F.lit("-"), F.lit("")), F.lit(10)))
    return checkpointed(
        definitions.withColumns(
            {
                "experiment_id": F.coalesce("experiment_id", generated),
                "runs_per_case": F.coalesce("runs_per_case", F.lit(1)),
                "blind_evaluation": F.coalesce("blind_evaluation", F.lit(False)),
            }
        )
    )


def create_experiments(definitions: DataFrame, prompts: DataFrame, cases: DataFrame) -> DataFrame:
    """The definitions, if no experiment, prompt or test case has an error; else fails with the first 20 and the number of others."""
    errors = experiment_errors(definitions, prompts, cases)
    broken = errors.limit(20).collect()
    if broken:
        more = errors.count() - len(broken)
        raise ValueError("\n".join([*(row["error"] for row in broken), *([f"and {more} more"] if more else [])]))
    return definitions


def upsert(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming rows replace the existing ones with the same key."""
    return existing.join(incoming.select(key).distinct(), key, "left_anti").unionByName(incoming)


def add_prompts(prompts: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(prompts after the upsert of the valid rows, rejected rows with their errors)."""
    judged = incoming.withColumn("errors", prompt_errors())
    valid = judged.filter(F.size("errors") == 0).drop("errors")
    return upsert(prompts, valid, "prompt_id"), judged.filter(F.size("errors") > 0)


def get_prompt(prompts: DataFrame, prompt_id: str) -> DataFrame:
    """The rows of one prompt; an unknown id fails."""
    found = prompts.filter(F.col("prompt_id") == prompt_id)
    if found.isEmpty():
        raise KeyError(f"Unknown prompt: {prompt_id}")
    return found


def clone_versions(prompts: DataFrame, changes: DataFrame) -> DataFrame:
    """New versions of prompts: `changes` holds the keys of the originals, new_text and new_version."""
    keys = [c for c in changes.columns if c not in ("new_text", "new_version")]
    return prompts.join(changes, keys).select(
        *[c for c in prompts.columns if c not in ("prompt_id", "name", "text", "version", "notes")],
        F.concat("prompt_id", F.lit("-v"), F.replace("new_version", F.lit("."), F.lit("-"))).alias("prompt_id"),
        F.concat("name", F.lit(" v"), "new_version").alias("name"),
        F.col("new_text").alias("text"),
        F.col("new_version").alias("version"),
        F.concat(F.lit("Versioned from "), "prompt_id").alias("notes"),
    )


def experiment_sizes(prompts: DataFrame, cases: DataFrame, runs: Column) -> DataFrame:
    """Requests per experiment and a warning above 20; runs that are no whole number count as 1."""
    sizes = _per_experiment(prompts, "prompts").join(_per_experiment(cases, "test_cases"), "experiment_id", "full")
    counted = sizes.select(
        "experiment_id",
        F.coalesce("prompts", F.lit(0)).cast("long").alias("prompts"),
        F.coalesce("test_cases", F.lit(0)).cast("long").alias("test_cases"),
        F.greatest(F.lit(1).cast("long"), maths.safe_int(runs, 1)).alias("runs"),
    )
    total = F.col("prompts") * F.col("test_cases") * F.col("runs")
    return counted.withColumn("request_count", total).withColumn(
        "warning", F.when(F.col("request_count") > SIZE_LIMIT, SIZE_WARNING).otherwise("")
    )


def request_grid(prompts: DataFrame, cases: DataFrame, runs: int, config: ModelConfig) -> DataFrame:
    """One row per prompt, test case and run of an experiment, with its cache key.

    An empty model name falls back to the configured one, as does a missing
    temperature or token limit. `grid_seq` is the order in which requests run.
    """
    right = cases.select("experiment_id", "case_seq", "test_case_id", "variables")
    pairs = prompts.join(right, "experiment_id")
    rendered = pairs.select(
        "experiment_id", "prompt_id", "test_case_id", "system_instructions",
        "experiment_seq", "prompt_seq", "case_seq",
        text.render(F.col("text"), F.col("variables")).alias("prompt_text"),
        F.when(text.blank_if_null(F.col("model")) == "", config.model_name).otherwise(F.col("model")).alias("model"),
        F.coalesce("temperature", F.lit(config.temperature)).alias("temperature"),
        F.coalesce("max_tokens", F.lit(config.max_tokens)).alias("max_tokens"),
    )
    keyed = rendered.withColumn(
        "cache_key",
        cache_key(F.lit(config.provider_name), F.col("model"), F.col("prompt_text"),
                  F.col("system_instructions"), F.col("temperature"), F.col("max_tokens")),
    )
    return keyed.withColumn("run_number", F.explode(F.sequence(F.lit(1), F.lit(runs)))).withColumn(
        "grid_seq", F.struct("experiment_seq", "prompt_seq", "case_seq", "run_number")
    ).drop("experiment_seq", "prompt_seq", "case_seq")


def cache_key(
    provider: Column, model: Column, prompt: Column, system: Column, temperature: Column, max_tokens: Column
) -> Column:
    return text.stable_hash(
        provider=provider, model=model, prompt=prompt, system=system, temperature=temperature, max_tokens=max_tokens
    )


def cache_put(cache: DataFrame, entries: DataFrame) -> DataFrame:
    """Latest entry per key by written_at; partial maxima are taken before the shuffle."""
    both = cache.unionByName(entries)
    values = [c for c in both.columns if c != "cache_key"]
    return both.groupBy("cache_key").agg(F.max_by(F.struct(*values), "written_at").alias("v")).select(
        "cache_key", "v.*"
    )


def response_cache(spark: SparkSession, path: str, schema: StructType | str) -> SnapshotTable:
    """A cache that outlives the session, by `cache_key`: put (the latest `written_at` of a key stays), get, read, clear."""
    return SnapshotTable(spark, path, spark.createDataFrame([], schema).schema, "cache_key")


def cache_get(cache: DataFrame, key: str) -> DataFrame:
    return cache.filter(F.col("cache_key") == key)


def cache_clear(cache: DataFrame) -> DataFrame:
    return cache.limit(0)


_CACHED = ("model", "input_tokens", "output_tokens", "metadata")
_CACHED_TYPE = "struct<text:string,model:string,input_tokens:int,output_tokens:int,metadata:map<string,string>>"


def _with_metadata(df: DataFrame) -> DataFrame:
    if "metadata" in df.columns:
        return df
    return df.withColumn("metadata", F.create_map().cast("map<string,string>"))


def collect_responses(
    grid: DataFrame, supplied: DataFrame, on: list[str], cache: DataFrame | None, config: ModelConfig
) -> DataFrame:
    """Response records of a grid from a cache table and a table of supplied responses.

    A cached key is a hit with latency 0. Otherwise the first request of a key, in
    grid order, that gets a text fills the cache and later ones are hits of it.
    A request with neither is a failure that carries an error text.

    `supplied` has the join columns and text, error_message, input_tokens,
    output_tokens, latency_seconds and, if wanted, metadata (a map of strings,
    also kept in the cache). One key may be shared by very many
    requests: the first answer per key is found by partial aggregation, and the
    join back has one row per key on its side, so only the request side is skewed
    and adaptive execution splits it.
    """
    supplied = _with_metadata(supplied)
    rows = grid.join(supplied.withColumnRenamed("text", "own_text"), on, "left")
    if config.cache_enabled:
        answered = F.col("own_text").isNotNull()
        value = F.struct("grid_seq", F.col("own_text").alias("text"), *_CACHED)
        first = rows.filter(answered).groupBy("cache_key").agg(F.min_by(value, "grid_seq").alias("_first"))
        rows = rows.join(first, "cache_key", "left")
    else:
        rows = rows.withColumn(
            "_first",
            F.lit(None).cast(_CACHED_TYPE),
        )
    if config.cache_enabled and cache is not None:
        stored = _with_metadata(cache).select("cache_key", F.struct("text", *_CACHED).alias("_stored"))
        rows = rows.join(stored, "cache_key", "left")
    else:
        rows = rows.withColumn("_stored", F.lit(None).cast(_CACHED_TYPE))

    in_cache = F.col("_stored").isNotNull()
    repeated = F.col("grid_seq") > F.col("_first.grid_seq") if config.cache_enabled else F.lit(False)
    repeat = ~in_cache & F.coalesce(repeated, F.lit(False))

    def pick(field: str, own: Column) -> Column:
        return F.when(in_cache, F.col(f"_stored.{field}")).when(repeat, F.col(f"_first.{field}")).otherwise(own)

    failed = ~in_cache & ~repeat & F.col("own_text").isNull()
    records = rows.select(
        "experiment_id", "prompt_id", "test_case_id", "run_number", "grid_seq", "cache_key", "prompt_text",
        pick("model", F.col("model")).alias("model"),
        text.blank_if_null(pick("text", F.col("own_text"))).alias("response"),
        F.when(in_cache | repeat, F.lit(0.0)).otherwise(F.coalesce("latency_seconds", F.lit(0.0))).alias("latency_seconds"),
        (in_cache | repeat).alias("cache_hit"),
        F.when(failed, F.coalesce("error_message", F.lit(NO_RESPONSE))).alias("_failure"),
        F.when(~failed, pick("input_tokens", F.col("input_tokens"))).alias("input_tokens"),
        F.when(~failed, pick("output_tokens", F.col("output_tokens"))).alias("output_tokens"),
        F.coalesce(pick("metadata", F.col("metadata")), F.create_map().cast("map<string,string>")).alias("metadata"),
        F.current_timestamp().alias("timestamp"),
    )
    return finish_records(records, config)


def with_success(df: DataFrame) -> DataFrame:
    """A response is a success unless it is blank or a failure."""
    failure = F.col("_failure") if "_failure" in df.columns else F.lit(None).cast("string")
    success = ~text.is_blank(F.col("response")) & failure.isNull()
    return df.withColumn("success", success).withColumn(
        "error_message", F.coalesce(failure, F.when(success, "").otherwise(EMPTY_RESPONSE))
    ).drop("_failure")


def finish_records(df: DataFrame, config: ModelConfig) -> DataFrame:
    """Add success, error text, cost and the word, line and character counts."""
    price_in = F.lit(config.input_cost_per_1k).cast("double")
    price_out = F.lit(config.output_cost_per_1k).cast("double")
    body = F.col("response")
    mock = F.try_element_at("metadata", F.lit("mock")) == "true" if "metadata" in df.columns else F.lit(False)
    return with_success(df).withColumns(
        {
            "mock_response": F.coalesce(mock, F.lit(False)),
            "estimated_cost": maths.request_cost(F.col("input_tokens"), F.col("output_tokens"), price_in, price_out),
            "response_words": text.word_count(body),
            "response_lines": text.line_count(body),
            "response_characters": text.character_count(body),
        }
    )


def prefer_judge(scored: DataFrame, judged: DataFrame, on: list[str]) -> DataFrame:
    """Use the evaluator's score where it is valid, else the rule score with the failure in `reason`.

    `judged` has the join columns, judge_score (a score struct or null) and judge_error.
    """
    joined = scored.join(judged, on, "left")
    failed = F.col("judge_score").isNull() & F.col("judge_error").isNotNull()
    noted = F.concat(F.col("score.reason"), F.lit(" Model evaluator failed: "), F.col("judge_error"))
    kept = F.when(failed & F.col("score").isNotNull(), F.col("score").withField("reason", noted)).otherwise(F.col("score"))
    return joined.withColumn(
        "score", F.when(F.col("success") & F.col("judge_score").isNotNull(), F.col("judge_score")).otherwise(kept)
    ).drop("judge_score", "judge_error")


def blind_labels(records: DataFrame, order_by: str, by: str = "experiment_id") -> DataFrame:
    """Add `label` "Response 1..n" per experiment."""
    numbered = row_numbers(records, order_by, [by], "_n")
    return numbered.withColumn("label", F.concat(F.lit("Response "), F.col("_n").cast("string"))).drop("_n")


def restore_labels(judged: DataFrame, labelled: DataFrame, by: str = "experiment_id") -> DataFrame:
    """Prompt ids of labelled judgements."""
    return judged.join(labelled.select(by, "label", "prompt_id"), [by, "label"])


def _history(spark: SparkSession, path: str, schema: StructType) -> SnapshotTable:
    return SnapshotTable(spark, path, schema, "experiment_id", HISTORY_BUCKETS)


def save_history(results: DataFrame, path: str) -> None:
    """Replace the stored rows of the incoming experiments, keep all others.

    Readers see the table before the save or after it, and only the buckets that the
    experiments fall in are rewritten.
    """
    _history(results.sparkSession, path, results.schema).put(results)


def load_history(spark: SparkSession, path: str, schema: StructType | str, experiment_id: str | None = None) -> DataFrame:
    """All stored rows, or those of one experiment from its bucket; a path without data gives an empty frame."""
    table = _history(spark, path, spark.createDataFrame([], schema).schema)
    return table.read() if experiment_id is None else table.get(experiment_id)


def get_history(history: DataFrame, experiment_id: str) -> DataFrame:
    """Rows of one experiment."""
    return history.filter(F.col("experiment_id") == experiment_id)
