"""Quality rules over documents: text statistics and lines that many documents of a host share.

Everything is DataFrame expressions. Lines are normalised and hashed; documents
are counted per (host, line); lines of more documents than the limit are removed
but for the first document that has them; a document is rejected when too little
of it is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.shared import BLANKS, let, stored, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# A line is above its limit in a host when more documents of it have the line than this number.
LINE_DOCS = 20
# A document is depleted when less than this share of its words is left.
LEFT_SHARE = 0.3


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_window_words(found: Column, window: int = WINDOW) -> Column:
    """Words that stand in a run of `window` words which occurs again in the array.

    Runs are compared by 64-bit hashes. Only where some repeat are they sorted
    with their positions, so that equal ones stand together. Each position that
    starts a repeated run covers `window` words, less what the run before it covers.
    """
    none = F.array().cast("array<bigint>")

    def hashed(found: Column) -> Column:
        last = F.size(found) - window
        return F.when(
            last >= 0,
            F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(window)])),
        ).otherwise(none)

    def beside_equal(placed: Column) -> Column:
        return F.filter(
            placed, lambda s, i: (F.get(placed, i - 1)["h"] == s["h"]) | (F.get(placed, i + 1)["h"] == s["h"])
        )

    def covered(starts: Column) -> Column:
        new = F.transform(
            starts, lambda s, i: F.when(i == 0, F.lit(window)).otherwise(F.least(F.lit(window), s - F.get(starts, i - 1)))
        )
        return F.aggregate(new, F.lit(0), lambda total, x: total + x)

    def counted(runs: Column) -> Column:
        placed = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = F.sort_array(F.transform(let(placed, beside_equal), lambda s: s["i"]))
        return F.when(F.size(F.array_distinct(runs)) < F.size(runs), let(starts, covered)).otherwise(0)

    return let(let(found, hashed), counted).cast("long")


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Null is an empty text. Duplicate lines are those with a word that equal an
    earlier line of the text.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = F.filter(F.split(whole, "\n"), lambda line: F.length(_without(line, BLANKS)) > 0)
    found = F.col("_words")
    return (
        docs.withColumn("_words", words(F.col(text)))
        .withColumn("n_words", F.size(found).cast("long"))
        .withColumn("word_chars", F.length(_without(whole, BLANKS)).cast("long"))
        .withColumn("n_symbols", (F.length(whole) - F.length(_without(whole, SYMBOLS))).cast("long"))
        .withColumn("n_dup_lines", (F.size(bare) - F.size(F.array_distinct(bare))).cast("long"))
        .withColumn("n_repeat_words", repeated_window_words(found))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
        .drop("_words")
    )


def host_lines(text: Column) -> Column:
    """(hash, words, at) of each line with a word; letters in lower case, blanks in ends and runs dropped.

    `at` is the place of the line among all lines of the text, from 0.
    """
    lines = F.transform(
        F.split(F.lower(F.coalesce(text, F.lit(""))), "\n"), lambda line, i: F.struct(words(line).alias("found"), i.alias("at"))
    )
    return F.transform(
        F.filter(lines, lambda line: F.size(line["found"]) > 0),
        lambda line: F.struct(
            F.xxhash64(F.array_join(line["found"], " ")).alias("hash"), F.size(line["found"]).cast("long").alias("words"),
            line["at"].alias("at"),
        ),
    )


def common_lines(rows: DataFrame, line_docs: int = LINE_DOCS) -> DataFrame:
    """(host, hash, first): lines in more than `line_docs` documents of their host, and the first document.

    `rows` has host, doc_id, row and lines. The limit is the same for hosts of
    every size. Counts are merged before the shuffle.
    """
    once = rows.select("host", "doc_id", "row", F.explode(F.array_distinct(F.transform("lines", lambda x: x["hash"]))).alias("hash"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    counted = once.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("docs"), first.alias("first"))
    return counted.filter(F.col("docs") > line_docs).select("host", "hash", F.col("first.row").alias("first"))


def without_lines(text: Column, places: Column) -> Column:
    """The text without the lines at these places, counted from 0."""

    def joined(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    return let(F.split(text, "\n"), joined)


def judged(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
    line_docs: int = LINE_DOCS, left_share: float = LEFT_SHARE, carry: bool = False,
) -> DataFrame:
    """Per row: doc_id, the statistics, base_failed, n_removed_words and kept.

    `kept` is false for base failures and for depleted documents, those of which
    fewer than 10 words or less than `left_share` are left without the common
    lines of their host. A line stays in the first document (smallest doc_id,
    null last) that has it, so the text of a group of copies is kept once. A null
    host is a host of its own, repeated rows count as documents, empty and null
    texts fail. With `carry` the rows also have `doc`, all
    columns of `docs`, and `gone`, the places of the removed lines (null for none).
    """
    columns = [F.struct(*docs.columns).alias("doc")] if carry else []
    read = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"),
        F.when(F.col(host).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(host))).alias("host"), *columns,
    )
    rows = stored(
        statistics(read, "_text").withColumn("lines", host_lines(F.col("_text"))).drop("_text")
        .withColumn("row", F.monotonically_increasing_id()),
        "judged",
    )
    common = common_lines(rows, line_docs)
    found = rows.select("host", "row", F.explode("lines").alias("line")).select("host", "row", "line.hash", "line.words", "line.at")
    places = [F.collect_list("at").alias("gone")] if carry else []
    removed = (
        found.join(common, ["host", "hash"]).filter("row <> first")
        .groupBy("row").agg(F.sum("words").alias("n_removed_words"), *places)
    )
    gone = F.coalesce("n_removed_words", F.lit(0)).cast("long")
    left = F.col("n_words") - F.col("n_removed_words")
    return (
        rows.drop("lines", "host").join(removed, "row", "left").drop("row")
        .withColumn("n_removed_words", gone)
        .withColumn("kept", ~F.col("base_failed") & (left >= MIN_WORDS) & (left >= left_share * F.col("n_words")))
    )


def keep_good(docs: DataFrame, text: str = "text", **options: object) -> DataFrame:
    """The rows of `docs` that are kept, with all columns; `text` without the lines above the limit.

    The first document of a host that has such a line keeps it. Texts without
    such lines are unchanged.
    """
    own = F.when(F.col("gone").isNull(), F.col("doc")[text]).otherwise(without_lines(F.col("doc")[text], F.col("gone")))
    return judged(docs, text=text, carry=True, **options).filter("kept").select(
        *[own.alias(c) if c == text else F.col("doc")[c].alias(c) for c in docs.columns]
    )


_BLANK = r"[\x20\x09-\x0D]"

JUDGED_SQL = rf"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
                      CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS host FROM documents),
worded AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, string_split(text, chr(10)) AS ls FROM texts),
runs AS (
  SELECT row, i, w[i:i + 4] AS run FROM (SELECT row, w, unnest(range(1, len(w) - 3)) AS i FROM worded WHERE len(w) >= 5)),
repeated AS (SELECT row, i FROM runs QUALIFY count(*) OVER (PARTITION BY row, run) > 1),
covered AS (
  SELECT row, CAST(sum(least(5, coalesce(i - prev, 5))) AS BIGINT) AS n_repeat_words
  FROM (SELECT row, i, lag(i) OVER (PARTITION BY row ORDER BY i) AS prev FROM repeated) GROUP BY row),
counted AS (
  SELECT row, doc_id, host, ls, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '{_BLANK}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    list_filter(ls, lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS bare
  FROM worded),
base AS (
  SELECT c.*, CAST(len(bare) - len(list_distinct(bare)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM counted c LEFT JOIN covered USING (row)),
lines AS (
  SELECT row, doc_id, host, array_to_string(regexp_extract_all(lower(l), '[^\x20\x09-\x0D]+'), ' ') AS line,
         len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT row, doc_id, host, unnest(bare) AS l FROM base)),
common AS (
  SELECT host, line, arg_min(row, (doc_id, row)) AS first FROM lines
  GROUP BY host, line HAVING count(DISTINCT row) > {LINE_DOCS}),
removed AS (
  SELECT row, CAST(sum(words) AS BIGINT) AS n FROM lines JOIN common USING (host, line) WHERE row <> first GROUP BY row),
failed AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
         coalesce(n, 0) AS n_removed_words FROM base LEFT JOIN removed USING (row))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words,
  NOT base_failed AND n_words - n_removed_words >= {MIN_WORDS}
    AND n_words - n_removed_words >= CAST({LEFT_SHARE} AS DOUBLE) * n_words AS kept
FROM failed
"""
