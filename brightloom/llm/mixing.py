"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents are put in a shuffled order (by a digest of the id) and
cut into blocks of an equal number of words. Slots 0, 1, 2, ... are mapped by the
van der Corput sequence to points in [0, 1) and through the cumulative targets to
sources, so that each stretch of the schedule holds every source close to its
share. The slots of a source are ranked; the slot of rank r takes the source's
block r, and after its last block the source starts again. The last block of a
source is cut where its target is reached; slots that the sequence gives a source
too many or too few are left out or follow at the end. `mix_blocks` returns the
blocks with their positions in this order, `mix` the documents that they are of.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.llm.shared import let, partitions, stored, word_count, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
BLOCK_WORDS = 256
CELLS = 1024
STRETCH = 4096
SEED = "mix"


def source_key(source: Column) -> Column:
    """Orders by code point with null last, and is never null."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """Add `target` to one row per source (`key`, `source_size`).

    The weights repeat in the order of the keys. All targets sum to `share` times
    all sizes; a target stops at `passes` times its source's size and what is
    above goes to the others by weight. With the sources in the order of
    size / weight those at their stop come first, so one running sum finds the
    level at which no target is above its stop.
    """
    in_order = Window.orderBy("key")
    by_stop = Window.orderBy("ratio", "key")
    before, onwards = by_stop.rowsBetween(Window.unboundedPreceding, -1), by_stop.rowsBetween(0, Window.unboundedFollowing)
    repeated = F.array(*[F.lit(int(w)) for w in weights])
    weighed = (
        sizes.withColumn("weight", F.get(repeated, (F.row_number().over(in_order) - 1) % len(weights)))
        .withColumn("stop", F.col("source_size") * passes)
        .withColumn("ratio", F.col("stop").cast("double") / F.col("weight"))
        .withColumn("all", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
        .withColumn("level", (F.col("all") - F.coalesce(F.sum("stop").over(before), F.lit(0))) / F.sum("weight").over(onwards))
    )
    free = weighed.withColumn("free", F.col("ratio") > F.col("level"))
    # The first free source's level holds for all free ones.
    level = F.min(F.when(F.col("free"), F.struct("ratio", "key", "level"))).over(Window.partitionBy())["level"]
    return free.withColumn(
        "target", F.when(F.col("free"), level * F.col("weight")).otherwise(F.col("stop").cast("double"))
    ).select("key", "source_size", "target")


def offsets(rows: DataFrame) -> DataFrame:
    """Add `start`: the words of the source before each row in its shuffled order.

    Three levels of digest prefixes keep every window small: up to 256 prefixes
    of a source, 256 longer ones of a prefix, and the rows of one longer prefix.
    """
    rows = rows.withColumn("one", F.substring("digest", 1, 2)).withColumn("two", F.substring("digest", 3, 2))
    twos = rows.groupBy("key", "one", "two").agg(F.sum("size").alias("n"))
    ones = twos.groupBy("key", "one").agg(F.sum("n").alias("n"))

    def before(by: Sequence[str], *order: str) -> Window:
        return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    one_starts = ones.select(
        "key", "one", F.coalesce(F.sum("n").over(before(["key"], "one")), F.lit(0)).alias("one_start")
    )
    two_starts = twos.join(one_starts, ["key", "one"]).select(
        "key", "one", "two",
        (F.col("one_start") + F.coalesce(F.sum("n").over(before(["key", "one"], "two")), F.lit(0))).alias("two_start"),
    )
    own = F.coalesce(F.sum("size").over(before(["key", "one", "two"], "digest", "size", "mark", "row")), F.lit(0))
    return (
        rows.join(two_starts, ["key", "one", "two"])
        .withColumn("start", F.col("two_start") + own)
        .drop("one", "two", "two_start")
    )


def _reversed_bits(n: Column) -> Column:
    """A long with its bits in reverse, from swaps of ever larger neighbours."""
    for width, mask in (
        (1, 0x5555555555555555), (2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF),
    ):
        keep = F.lit(mask)
        n = F.shiftleft(n.bitwiseAND(keep), width).bitwiseOR(F.shiftrightunsigned(n, width).bitwiseAND(keep))
    return F.shiftleft(n, 32).bitwiseOR(F.shiftrightunsigned(n, 32))


def van_der_corput(n: Column) -> Column:
    """The n-th point of the sequence in base 2, in [0, 1)."""
    return F.shiftrightunsigned(_reversed_bits(n), 11).cast("double") / F.lit(float(2**53))


def schedule(goals: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(position, key, pass, block, low, high): which words of a source's order each slot takes.

    `goals` has one row per source: key, source_size, target. Blocks count from 0
    in every pass; [low, high) are word offsets in the pass. No two slots have one
    position; those of slots that are left out stay free.
    """
    size, goal = F.col("source_size"), F.col("goal")
    quotas = (
        goals.filter("source_size > 0")
        .withColumn("goal", F.floor("target").cast("long"))
        .withColumn("blocks", F.ceil(size / F.lit(block_words)).cast("long"))
        .withColumn("full", F.floor(goal / size).cast("long"))
        .withColumn("quota", F.col("full") * F.col("blocks") + F.ceil((goal - F.col("full") * size) / F.lit(block_words)).cast("long"))
        .filter("quota > 0")
    )
    running = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    shares = stored(
        quotas.withColumn("nth", F.row_number().over(Window.orderBy("key")) - 1)
        .withColumn("sources", F.count(F.lit(1)).over(Window.partitionBy()))
        .withColumn("slots", F.sum("quota").over(Window.partitionBy()))
        .withColumn("from", F.coalesce(F.sum("quota").over(running), F.lit(0)) / F.col("slots"))
        .withColumn("to", (F.coalesce(F.sum("quota").over(running), F.lit(0)) + F.col("quota")) / F.col("slots")),
        "shares",
    )
    slots = shares.agg(F.max("slots")).first()[0] or 0
    spark = goals.sparkSession
    points = spark.range(0, slots, 1, partitions(spark)).select(
        F.col("id").alias("position"), van_der_corput(F.col("id")).alias("point")
    )
    celled = shares.select(
        "key", "from", "to",
        F.explode(F.sequence(F.floor(F.col("from") * CELLS), F.least(F.ceil(F.col("to") * CELLS), F.lit(CELLS)) - 1)).alias("cell"),
    )
    given = points.withColumn("cell", F.floor(F.col("point") * CELLS)).join(celled, "cell").filter("point >= from and point < to")
    placed = given.select("key", "position", F.floor(F.col("position") / STRETCH).alias("stretch"))
    counts = placed.groupBy("key", "stretch").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("key").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select("key", "stretch", "first")
    inside = Window.partitionBy("key", "stretch").orderBy("position")
    ranked = placed.join(starts, ["key", "stretch"]).select(
        "key", "position", (F.row_number().over(inside) - 1 + F.col("first")).alias("rank")
    )
    # Slots that a source lacks come after all others, one of each source in turn.
    found = counts.groupBy("key").agg(F.sum("n").alias("found"))
    late = (
        shares.join(found, "key", "left").withColumn("found", F.coalesce("found", F.lit(0))).filter("found < quota")
        .select("key", "nth", "sources", "found", F.explode(F.sequence(F.col("found"), F.col("quota") - 1)).alias("rank"))
        .select("key", (F.lit(slots) + (F.col("rank") - F.col("found")) * F.col("sources") + F.col("nth")).alias("position"), "rank")
    )
    low = F.col("block") * block_words
    left = F.col("goal") - F.col("pass") * size
    return (
        ranked.unionByName(late).join(shares.select("key", "source_size", "goal", "blocks", "quota"), "key")
        .filter("rank < quota")
        .withColumn("pass", F.floor(F.col("rank") / F.col("blocks")).cast("long"))
        .withColumn("block", F.col("rank") - F.col("pass") * F.col("blocks"))
        .select("position", "key", "pass", "block", low.alias("low"), F.least(low + block_words, size, left).alias("high"))
        .filter("low < high")
    )


def _sized(docs: DataFrame, doc_id: str, text: str, source: str, row: Column) -> DataFrame:
    """(row, doc_id, mark, key, size): what the plan needs of every document; `mark` is a hash of the text."""
    return docs.select(
        row.alias("row"), F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("mark"),
        source_key(F.col(source)).alias("key"), word_count(F.col(text)).alias("size"),
    )


def _goals(rows: DataFrame, **goal: object) -> DataFrame:
    return stored(targets(rows.groupBy("key").agg(F.sum("size").alias("source_size")), **goal), "goals")


def _spans(rows: DataFrame, goals: DataFrame, block_words: int) -> DataFrame:
    """(row, position, pass, low, high): the words [low, high) of a document that a slot takes."""
    # Null ids are told apart by their texts: else all of them would sort in one place.
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null "), F.col("mark").cast("string")))
    placed = stored(
        offsets(rows.filter("size > 0").withColumn("digest", F.md5(F.concat_ws("|", F.lit(SEED), name)))), "placed"
    )
    start, size = F.col("start"), F.col("size")
    touched = placed.select(
        "row", "key", "start", "size",
        F.explode(F.sequence(F.floor(start / block_words), F.floor((start + size - 1) / block_words))).alias("block"),
    )
    slots = schedule(goals, block_words)
    return (
        touched.join(slots, ["key", "block"])
        .select("row", "position", "pass", (F.greatest("low", "start") - start).alias("low"), (F.least("high", start + size) - start).alias("high"))
        .filter("low < high")
    )


def _plan(rows: DataFrame, block_words: int, **goal: object) -> DataFrame:
    """Per stored row (`row`, `doc_id`, `key`, `size`): source_size, target and the words taken."""
    goals = _goals(rows, **goal)
    taken = _spans(rows, goals, block_words).groupBy("row").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    return (
        rows.join(taken, "row", "left").join(goals, "key")
        .withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    )


def mix_counts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    block_words: int = BLOCK_WORDS, **goal: object,
) -> DataFrame:
    """Per row: doc_id, size, source_size, target and the words that the mix takes of it.

    A null text has no words. Null sources are one source, the last. Documents
    without words are never taken. Repeated rows and null doc_ids count as
    documents of their own. The order follows from the ids, then the sizes and
    texts, so reruns agree, also when the rows are stored in another order. Other
    columns are not read.
    """
    rows = _sized(docs, doc_id, text, source, F.monotonically_increasing_id())
    return _plan(stored(rows, "sizes"), block_words, **goal).select("doc_id", "size", "source_size", "target", "taken")


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    block_words: int = BLOCK_WORDS, **goal: object,
) -> DataFrame:
    """The mixed rows with all columns of `docs`: one row per pass that takes words of a document.

    Where a source's target ends inside a document, that row's text is its first
    words, parted by blanks.
    """
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("doc")), "numbered")
    inner = F.col("doc")
    rows = _sized(numbered, f"doc.{doc_id}", f"doc.{text}", f"doc.{source}", F.col("row"))
    taken = _plan(stored(rows, "sizes"), block_words, **goal).filter("taken > 0").select("row", "size", "taken")
    parts = F.filter(
        F.array(F.least("taken", "size"), F.least(F.col("taken") - F.col("size"), F.col("size"))), lambda n: n > 0
    )
    own = F.when(F.col("part") == F.col("size"), inner[text]).otherwise(
        F.array_join(F.slice(words(inner[text]), F.lit(1), F.col("part").cast("int")), " ")
    )
    return (
        numbered.join(taken.select("row", "size", F.explode(parts).alias("part")), "row")
        .withColumn("own", own)
        .select(*[F.col("own").alias(c) if c == text else inner[c].alias(c) for c in docs.columns])
    )


def mix_blocks(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    block_words: int = BLOCK_WORDS, position: str = "position", **goal: object,
) -> DataFrame:
    """The mix as blocks in the order of the schedule: all columns of `docs`, `position` and `first_word`.

    A block of `block_words` words may hold the end of one document and the start
    of the next: there is one row per block and document, its text the words of
    that document in the block, parted by blanks, and `first_word` the number of
    the document's words before them. Sort by `position` for the mix itself: every
    stretch of positions holds each source close to its share. A null text, or
    one without words, has no rows. Columns of `docs` that are called `position`
    or `first_word` are replaced. An empty table gives no rows.
    """
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("doc")), "numbered")
    rows = stored(_sized(numbered, f"doc.{doc_id}", f"doc.{text}", f"doc.{source}", F.col("row")), "sizes")
    # A document's spans are cut from its words at once, so a long text is split into words one time.
    spans = _spans(rows, _goals(rows, **goal), block_words).groupBy("row").agg(F.collect_list(F.struct("position", "low", "high")).alias("spans"))

    def cut(found: Column) -> Column:
        return F.transform("spans", lambda s: F.struct(
            s["position"].alias("position"), s["low"].alias("low"),
            F.array_join(F.slice(found, (s["low"] + 1).cast("int"), (s["high"] - s["low"]).cast("int")), " ").alias("text"),
        ))

    kept = [c for c in docs.columns if c not in (position, "first_word")]
    blocks = numbered.join(spans, "row").select("doc", F.explode(let(words(F.col(f"doc.{text}")), cut)).alias("block"))
    return blocks.select(
        *[F.col("block.text").alias(c) if c == text else F.col("doc")[c].alias(c) for c in kept],
        F.col("block.position").alias(position), F.col("block.low").alias("first_word"),
    )


COUNTS_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         md5('{SEED}|' || CAST(doc_id AS VARCHAR)) AS digest
  FROM documents),
sources AS (SELECT key, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY key),
weighed AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY key) - 1) % 3] AS weight, source_size * 2 AS stop FROM sources),
levels AS (
  SELECT *, CAST(stop AS DOUBLE) / weight AS ratio,
    ((SELECT sum(source_size) FROM sources) * CAST(1.5 AS DOUBLE) - coalesce(sum(stop) OVER (ORDER BY CAST(stop AS DOUBLE) / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY CAST(stop AS DOUBLE) / weight, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
goals AS (
  SELECT key, source_size, CASE WHEN ratio > level
      THEN (SELECT arg_min(level, (ratio, key)) FROM levels WHERE ratio > level) * weight ELSE CAST(stop AS DOUBLE) END AS target
  FROM levels),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY key ORDER BY digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(size, floor(target) - start)) + greatest(0, least(size, floor(target) - source_size - start)) AS BIGINT) AS taken
FROM placed JOIN goals USING (key)
"""
