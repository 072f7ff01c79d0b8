"""Text, JSON, maths, date and banding functions over the given tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.functions import jsonx, maths, text
from brightloom.sources import views

_WORDS = r"regexp_extract_all(text, '[\p{L}\p{M}\p{N}_]+')"
_BREAK = r"'\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e]'"


def text_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("text")
    return views.busy_table(spark, sf_dir, "documents").select(
        "doc_id",
        text.word_count(body).alias("words"),
        text.line_count(body).alias("lines"),
        text.character_count(body).alias("characters"),
        text.approximate_token_count(body).alias("tokens"),
        text.count_bullets(F.replace(body, F.lit("\n"), F.lit("\n- "))).alias("bullets"),
    )


def text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = views.busy_table(spark, sf_dir, "documents").select("doc_id", text.text_stats(F.col("text")).alias("s"))
    return stats.select(
        "doc_id", "s.characters", "s.words", "s.lines", "s.sentences", "s.unique_words",
        F.round("s.average_word_length", 6).alias("average_word_length"),
    )


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns wrapped as prompt templates."""
    wrapped = F.concat(
        F.lit("Explain {segment} and list {two words}: "), F.col("text"), F.lit(" { "), F.col("role"), F.lit(" }? Compare?")
    )
    return views.busy_table(spark, sf_dir, "conversations").select("conv_id", "turn", wrapped.alias("text"))


def prompt_inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    inspected = _prompts(spark, sf_dir).select("conv_id", "turn", text.inspect_prompt(F.col("text")).alias("s"))
    return inspected.select(
        "conv_id", "turn", "s.has_text", "s.characters",
        F.array_join("s.placeholders", "|").alias("placeholders"),
        F.array_join("s.variables", "|").alias("variables"),
        "s.question_marks", "s.instruction_words", "s.estimated_tokens",
    )


def slug_hash_redact(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.col("text")
    key = text.stable_hash(
        provider=F.col("source"), model=F.lit("demo-model"), prompt=body, system=F.lit(""),
        temperature=F.lit(0.2).cast("double"), max_tokens=F.lit(None).cast("int"),
    )
    return views.busy_table(spark, sf_dir, "documents").select(
        "doc_id",
        text.slugify(F.regexp_extract(body, r"^[^.!?\n]*", 0)).alias("slug"),
        key.alias("cache_key"),
        text.redact_secret(body).alias("redacted"),
        F.md5(text.clean_text(body)).alias("clean_md5"),
        text.normalize_title(F.regexp_extract(body, r"^[^\n]*", 0)).alias("title_key"),
        F.size(text.content_words(body)).cast("long").alias("content_words"),
    )


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.busy_table(spark, sf_dir, "documents").select(
        "doc_id", F.inline(F.array(text.secret_scan(F.col("text"))))
    )


def value_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Description of a number, a text with gaps and a list per event."""
    events = views.busy_table(spark, sf_dir, "events").select(
        "event_id", "value",
        F.when(F.col("event_type") != "error", F.col("props")).alias("props"),
        F.split("event_type", "i").alias("pieces"),
    )
    described = events.select(
        "event_id",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), text.describe_value(F.col(c), c == "pieces").alias("d"))
                    for c in ("value", "props", "pieces")
                ]
            )
        ),
    )
    return described.select("event_id", "column", "d.*")


def _json_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties inside other text, as a list, cut short and with text behind them."""
    kind = F.col("event_type")
    body = (
        F.when(kind == "click", F.concat(F.lit("prefix "), F.col("props"), F.lit(" suffix")))
        .when(kind == "view", F.concat(F.lit("["), F.col("props"), F.lit("]")))
        .when(kind == "error", F.rtrim(F.replace(F.col("props"), F.lit("}"), F.lit(" "))))
        .otherwise(F.col("props"))
    )
    return views.busy_table(spark, sf_dir, "events").select("event_id", "event_type", "value", body.alias("text"))


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _json_texts(spark, sf_dir).withColumn("obj", jsonx.parse_json_object(F.col("text")))
    return parsed.select(
        "event_id", F.col("obj").isNotNull().alias("is_object"),
        F.try_variant_get("obj", "$.k", "bigint").alias("k"),
    )


def json_schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    wanted = (
        F.when(kind == "purchase", "integer").when(kind == "signup", "string").when(kind == "click", "number").otherwise("object")
    )
    required = F.when(F.col("value") > 100, F.array(F.lit("k"), F.lit("missing"))).otherwise(F.array(F.lit("k")))
    verdict = jsonx.validate_json_schema(
        jsonx.parse_json_object(F.col("text")), required, F.create_map(F.lit("k"), wanted)
    )
    return _json_texts(spark, sf_dir).select("event_id", F.inline(F.array(verdict)))


def judge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores read from evaluator JSON: out of range, quoted, bad and missing ones."""
    reply = F.concat(
        F.lit('Verdict: {"relevance": '), F.col("value").cast("string"), F.lit(', "accuracy": "7.5", "clarity": "bad", '),
        F.lit('"safety": -3, "overall": '), (F.length("event_type") * 1.25).cast("double").cast("string"),
        F.lit(', "reason": "'), F.col("event_type"), F.lit('"}'),
    )
    scored = views.busy_table(spark, sf_dir, "events").select(
        "event_id", jsonx.score_from_object(jsonx.parse_json_object(reply)).alias("s")
    )
    return scored.select("event_id", "s.*")


def grade_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), F.col("value").cast("string"))).otherwise(
        F.col("value").cast("string")
    )
    return views.busy_table(spark, sf_dir, "events").select("event_id", F.inline(F.array(maths.grade_band(marks))))


def calc_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-operand calculations per order line; the second operand is often zero."""
    a, b = F.col("l_extendedprice"), F.col("l_linenumber") - 4.0
    lines = views.busy_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", a.alias("a"), b.cast("double").alias("b"))
    a, b = F.col("a"), F.col("b")
    answers = {
        "plus": maths.add(a, b), "minus": maths.subtract(a, b), "times": maths.multiply(a, b),
        "ratio": maths.divide(a, b), "rest": maths.modulus(F.col("l_quantity"), b),
        "share": maths.percentage(a, b), "raised": maths.power(b, b),
    }
    return lines.select(
        "l_orderkey", "l_linenumber", "l_quantity",
        *[F.round(v["result"], 4).alias(n) for n, v in answers.items() if n != "raised"],
        F.round(answers["raised"]["result"], 6).alias("raised"),
        answers["ratio"]["error"].alias("ratio_error"), answers["rest"]["error"].alias("rest_error"),
        maths.calculation_text(F.col("l_quantity"), "+", b, F.col("l_quantity") + b).alias("log"),
    )


def calc_unary(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("c_acctbal")
    angle = F.col("c_acctbal") / 100
    answers = {
        "root": maths.square_root(x), "log_ten": maths.log10(x), "log_e": maths.natural_log(x),
        "sine": maths.sine(angle), "cosine": maths.cosine(angle),
    }
    return views.busy_table(spark, sf_dir, "customer").select(
        "c_custkey",
        *[F.round(v["result"], 6).alias(n) for n, v in answers.items()],
        *[answers[n]["error"].alias(f"{n}_error") for n in ("root", "log_ten", "log_e")],
        F.round(maths.tangent(F.col("c_nationkey").cast("double"))["result"], 6).alias("tangent"),
    )


def calc_factorial(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = (
        F.when(F.col("l_returnflag") == "A", F.col("l_linenumber").cast("string"))
        .when(F.col("l_linestatus") == "F", (F.col("l_quantity") - 3).cast("int").cast("string"))
        .otherwise(F.col("l_quantity").cast("string"))
    )
    answer = maths.factorial(written)
    return views.busy_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", written.alias("written"),
        answer["result"].cast("string").alias("result"), answer["error"].alias("error"),
    )


def scalar_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("c_acctbal")
    return views.busy_table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.round(maths.log1p_clipped(x), 6).alias("log1p"),
        maths.clamp(x, 0, 1000).alias("clamped"),
        maths.safe_float(F.col("c_mktsegment"), -1.0).alias("bad_number"),
        maths.safe_int(F.substring("c_name", 10, 9)).alias("number_in_name"),
        maths.safe_int(x.cast("string"), 7).alias("text_with_fraction"),
        maths.safe_int(x, 7, is_text=False).alias("cut"),
        F.bround(F.col("c_custkey") / 8, 2).alias("half_even"),
    )


def order_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.busy_table(spark, sf_dir, "events").select(
        "event_id", maths.utc_iso(F.col("ts")).alias("iso"), F.round(maths.epoch_seconds(F.col("ts")), 3).alias("epoch"),
        F.date_format(F.date_add(F.to_date("ts"), 1), "yyyy-MM-dd").alias("next_day"),
    )


_JSON_TEXTS = """
WITH texts AS (
  SELECT event_id, event_type, value,
    CASE event_type WHEN 'click' THEN 'prefix ' || props || ' suffix'
                    WHEN 'view' THEN '[' || props || ']'
                    WHEN 'error' THEN rtrim(replace(props, '}', ' '))
                    ELSE props END AS text FROM events),
objects AS (
  SELECT *, CASE WHEN json_valid(text) THEN CASE WHEN json_type(CAST(text AS JSON)) = 'OBJECT' THEN text END
                 WHEN json_valid(nullif(regexp_extract(text, '(?s)\\{.*\\}'), ''))
                   THEN regexp_extract(text, '(?s)\\{.*\\}') END AS obj
  FROM texts)"""

PLANS = {
    "text_counts": (
        text_counts,
        rf"""
        SELECT doc_id, len(regexp_extract_all(text, '\S+')) AS words,
          len(list_filter(string_split_regex(text, {_BREAK}), lambda x: regexp_matches(x, '\S'))) AS lines,
          length(text) AS characters, CAST(ceil(length(text) / 4.0) AS BIGINT) AS tokens,
          len(list_filter(string_split_regex(replace(text, chr(10), chr(10) || '- '), {_BREAK}),
              lambda x: regexp_matches(x, '^\s*(?:[-*+]|\d+[.)])\s+'))) AS bullets
        FROM documents""",
    ),
    "text_stats": (
        text_stats,
        rf"""
        WITH w AS (SELECT doc_id, text, {_WORDS} AS words, string_split_regex(text, {_BREAK}) AS pieces FROM documents)
        SELECT doc_id, length(text) AS characters, len(words) AS words,
          len(pieces) - CASE WHEN pieces[-1] = '' THEN 1 ELSE 0 END AS lines,
          len(list_filter(string_split_regex(text, '[.!?]+'), lambda x: regexp_matches(x, '\S'))) AS sentences,
          len(list_distinct(list_transform(words, lambda x: lower(x)))) AS unique_words,
          round(coalesce(CAST(list_sum(list_transform(words, lambda x: length(x))) AS DOUBLE) / nullif(len(words), 0), 0), 6)
            AS average_word_length
        FROM w""",
    ),
    "prompt_inspect": (
        prompt_inspect,
        r"""
        WITH p AS (SELECT conv_id, turn,
          'Explain {segment} and list {two words}: ' || text || ' { ' || role || ' }? Compare?' AS text FROM conversations)
        SELECT conv_id, turn, regexp_matches(text, '\S') AS has_text, length(text) AS characters,
          array_to_string(regexp_extract_all(text, '\{([^\n]*?)\}', 1), '|') AS placeholders,
          array_to_string(regexp_extract_all(text, '\{\s*([A-Za-z_]\w*)\s*\}', 1), '|') AS variables,
          len(regexp_extract_all(text, '\?')) AS question_marks,
          len(regexp_extract_all(text,
            '(?i)\b(explain|summarize|compare|list|analyze|return|create|describe)\b')) AS instruction_words,
          CAST(ceil(length(text) / 4.0) AS BIGINT) AS estimated_tokens
        FROM p""",
    ),
    "slug_hash_redact": (
        slug_hash_redact,
        r"""
        WITH d AS (SELECT *,
          regexp_replace(regexp_replace(trim(regexp_extract(text, '^[^.!?\n]*'), chr(32) || chr(9)), '[^A-Za-z0-9._-]+', '_', 'g'),
            '^[._-]+|[._-]+$', '', 'g') AS slugged,
          trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')) AS cleaned
          FROM documents)
        SELECT doc_id, CASE WHEN slugged = '' THEN 'item' ELSE slugged END AS slug,
          sha256('{"max_tokens": null, "model": "demo-model", "prompt": ' || CAST(to_json(text) AS VARCHAR)
            || ', "provider": ' || CAST(to_json(source) AS VARCHAR) || ', "system": "", "temperature": 0.2}') AS cache_key,
          CASE WHEN text = '' THEN '<not configured>' WHEN length(text) <= 6 THEN '***'
               ELSE left(text, 3) || '...' || right(text, 3) END AS redacted,
          md5(cleaned) AS clean_md5,
          regexp_replace(regexp_replace(trim(lower(regexp_extract(text, '^[^\n]*'))), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g')
            AS title_key,
          len(list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z0-9]{4,}'), lambda x: lower(x)))) AS content_words
        FROM d""",
    ),
    "secret_scan": (
        secret_scan,
        r"""
        WITH s AS (SELECT doc_id, text, regexp_matches(text, '(?i)(api[_-]?key|secret|password|token)\s*[:=]') AS hit FROM documents)
        SELECT doc_id, hit AS contains_secret_label,
          CASE WHEN hit THEN CASE WHEN length(text) <= 6 THEN '***' ELSE left(text, 3) || '...' || right(text, 3) END
               ELSE left(text, 80) END AS redacted_preview, NOT hit AS safe_to_log
        FROM s""",
    ),
    "value_describe": (
        value_describe,
        """
        SELECT event_id, 'value' AS "column", true AS provided, 'double' AS type,
               length(CAST(value AS VARCHAR)) AS string_length, false AS is_container FROM events
        UNION ALL
        SELECT event_id, 'props', event_type <> 'error', 'string',
               CASE WHEN event_type <> 'error' THEN length(props) ELSE 0 END, false FROM events
        UNION ALL
        SELECT event_id, 'pieces', true, 'array<string>',
               length('{"v":' || CAST(to_json(string_split(event_type, 'i')) AS VARCHAR) || '}'), true FROM events""",
    ),
    "json_extract": (
        json_extract,
        _JSON_TEXTS + """
        SELECT event_id, obj IS NOT NULL AS is_object, TRY_CAST(obj ->> '$.k' AS BIGINT) AS k FROM objects""",
    ),
    "json_schema_check": (
        json_schema_check,
        _JSON_TEXTS + """,
        judged AS (
          SELECT event_id, CASE
            WHEN obj IS NULL THEN 'Response is not a valid JSON object.'
            WHEN value > 100 THEN 'Missing required field: missing'
            WHEN event_type IN ('signup', 'view', 'error') THEN 'Field ''k'' has the wrong type.'
            ELSE 'JSON structure satisfies the configured checks.' END AS detail FROM objects)
        SELECT event_id, detail = 'JSON structure satisfies the configured checks.' AS passed, detail FROM judged""",
    ),
    "judge_scores": (
        judge_scores,
        """
        SELECT event_id, least(10.0, greatest(0.0, value))::DOUBLE AS relevance, CAST(7.5 AS DOUBLE) AS accuracy,
          CAST(0 AS DOUBLE) AS clarity, CAST(0 AS DOUBLE) AS completeness, CAST(0 AS DOUBLE) AS instruction_following,
          CAST(0 AS DOUBLE) AS format_compliance, CAST(0 AS DOUBLE) AS safety, CAST(0 AS DOUBLE) AS conciseness,
          least(10.0, length(event_type) * 1.25)::DOUBLE AS overall, event_type AS reason, 'model-based' AS evaluator_mode
        FROM events""",
    ),
    "grade_bands": (
        grade_bands,
        """
        WITH g AS (SELECT event_id, CASE
          WHEN event_type = 'error' THEN 'bad' WHEN value < 0 OR value > 100 THEN 'out'
          WHEN value > 90 THEN 'A1' WHEN value >= 80 THEN 'A2' WHEN value >= 70 THEN 'B1' WHEN value >= 60 THEN 'B2'
          WHEN value >= 50 THEN 'C1' WHEN value >= 40 THEN 'C2' WHEN value >= 30 THEN 'D1' WHEN value >= 20 THEN 'D2'
          WHEN value >= 10 THEN 'E1' ELSE 'lowest' END AS g FROM events)
        SELECT event_id, CASE WHEN g IN ('bad', 'out') THEN 'invalid' ELSE g END AS grade, CASE g
          WHEN 'bad' THEN 'Invalid input! Please enter a valid number.'
          WHEN 'out' THEN 'Please enter a percentage between 0 and 100.'
          WHEN 'A1' THEN 'Hurray! 🎉 You achieved A1!' WHEN 'A2' THEN 'Excellent! You achieved A2!'
          WHEN 'B1' THEN 'Very Good! You achieved B1!' WHEN 'D2' THEN 'D2'
          WHEN 'E1' THEN 'E1 I think now you gonna regret' WHEN 'lowest' THEN 'Good Luck for the next time!'
          ELSE 'Good Job! You achieved ' || g || '!' END AS message
        FROM g""",
    ),
    "calc_binary": (
        calc_binary,
        """
        WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice AS a, CAST(l_linenumber - 4 AS DOUBLE) AS b FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_quantity, round(a + b, 4) AS plus, round(a - b, 4) AS minus, round(a * b, 4) AS times,
          CASE WHEN b <> 0 THEN round(a / b, 4) END AS ratio,
          CASE WHEN b <> 0 THEN round(CASE WHEN l_quantity % b <> 0 AND (l_quantity % b < 0) <> (b < 0)
                                           THEN l_quantity % b + b ELSE l_quantity % b END, 4) END AS rest,
          round(a * b / 100, 4) AS share, round(pow(b, b), 6) AS raised,
          CASE WHEN b = 0 THEN 'Cannot divide by zero.' END AS ratio_error,
          CASE WHEN b = 0 THEN 'Cannot use zero.' END AS rest_error,
          CAST(l_quantity AS VARCHAR) || ' + ' || CAST(b AS VARCHAR) || ' = ' || CAST(l_quantity + b AS VARCHAR) AS log
        FROM l""",
    ),
    "calc_unary": (
        calc_unary,
        """
        SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN round(sqrt(c_acctbal), 6) END AS root,
          CASE WHEN c_acctbal > 0 THEN round(log10(c_acctbal), 6) END AS log_ten,
          CASE WHEN c_acctbal > 0 THEN round(ln(c_acctbal), 6) END AS log_e,
          round(sin(radians(c_acctbal / 100)), 6) AS sine, round(cos(radians(c_acctbal / 100)), 6) AS cosine,
          CASE WHEN c_acctbal < 0 THEN 'Square root of a negative number is not real.' END AS root_error,
          CASE WHEN c_acctbal <= 0 THEN 'Log requires a positive number.' END AS log_ten_error,
          CASE WHEN c_acctbal <= 0 THEN 'Natural log requires a positive number.' END AS log_e_error,
          round(tan(radians(c_nationkey)), 6) AS tangent
        FROM customer""",
    ),
    "calc_factorial": (
        calc_factorial,
        """
        WITH l AS (SELECT l_orderkey, l_linenumber,
          CASE WHEN l_returnflag = 'A' THEN CAST(l_linenumber AS VARCHAR)
               WHEN l_linestatus = 'F' THEN CAST(CAST(l_quantity - 3 AS INT) AS VARCHAR)
               ELSE CAST(l_quantity AS VARCHAR) END AS written FROM lineitem),
        n AS (SELECT *, CASE WHEN regexp_full_match(written, '[+-]?\\d+') THEN CAST(written AS INT) END AS n FROM l)
        SELECT l_orderkey, l_linenumber, written,
          CASE WHEN n >= 0 THEN list_extract([""" + ", ".join(f"'{math.factorial(n)}'" for n in range(101)) + """], n + 1) END AS result,
          CASE WHEN n IS NULL THEN 'Enter a whole number only.' WHEN n < 0 THEN 'Factorial cannot be negative.' END AS error
        FROM n""",
    ),
    "scalar_helpers": (
        scalar_helpers,
        """
        SELECT c_custkey, round(ln(1 + greatest(c_acctbal, 0)), 6) AS log1p,
          CAST(greatest(0, least(c_acctbal, 1000)) AS DOUBLE) AS clamped, CAST(-1 AS DOUBLE) AS bad_number,
          CAST(substr(c_name, 10, 9) AS BIGINT) AS number_in_name, CAST(7 AS BIGINT) AS text_with_fraction,
          CAST(trunc(c_acctbal) AS BIGINT) AS cut, round_even(c_custkey / 8, 2) AS half_even
        FROM customer""",
    ),
    "order_moments": (
        order_moments,
        """
        SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS iso, round(epoch_us(ts) / 1e6, 3) AS epoch,
          strftime(CAST(ts AS DATE) + 1, '%Y-%m-%d') AS next_day
        FROM events""",
    ),
}
