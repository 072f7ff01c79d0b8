"""Collocations: phrases that occur often and hold together, counted by pair tiles.

Texts become chunks of word numbers. Words that are frequent in their language get
ids by falling frequency, so frequent pairs have small ids. In a chunk the pairs of
neighbours are dealt to tiles of TILE x TILE ids: a tile that is well filled is
counted by direct address (`numpy.bincount` over all its cells), the pairs of
sparse tiles as sorted coordinates. A chunk sends its counts, packed, to buckets by
a hash of the pair; a bucket adds up what the chunks found.

Frequent pairs are ranked by frequency in their turn and become the symbols of the
next round: a phrase of m + 1 words is the pair of its first m and its last m words,
so every round is the same count of neighbours. A phrase cannot be more frequent
than a part of it, so symbols that are not frequent are left out without loss.

A bucket tells every chunk which of its own pairs are frequent, and their ids; no
vocabulary is broadcast or gathered. Buckets are as many as the session has shuffle
partitions, and a hash spreads the pairs, so a bucket ranks a fair sample of all
frequent pairs: its r-th most frequent gets the id r * buckets + bucket.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.llm.shared import partitions, stored

LEAST = 100
LONGEST = 5
TOP = 2000
CHUNK_WORDS = 1 << 20
TILE = 256
FILLED = 8  # a tile with a pair for every so many cells is dense
PART_WORDS = 1 << 18  # words in one stored row of a chunk
SLICE = 1 << 22  # bytes of a text that are split at once
NO_LANG = "und"
_UPPER, _SEPARATORS, _STOP = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?\n\x0b\x0c\r", b"\xff"
_END = re.compile(rb"[ \t.,;:!?\n-\r]")
_TABLE = bytes.maketrans(_UPPER + _SEPARATORS + b"\t", _UPPER.lower() + _STOP * len(_SEPARATORS) + b" ")

# Rows of a chunk: parts of its places, and packed counts for a bucket.
CHUNK_SCHEMA = "chunk long, context int, part int, places binary, bucket int, lang string, n long, counts binary"
_CHUNK = pa.schema([
    ("chunk", pa.int64()), ("context", pa.int32()), ("part", pa.int32()), ("places", pa.binary()),
    ("bucket", pa.int32()), ("lang", pa.string()), ("n", pa.int64()), ("counts", pa.binary()),
])
# Rows of a bucket: ids for a chunk, and the frequent symbols.
BUCKET_SCHEMA = "chunk long, ids binary, id long, a long, b long, lang string, word string, n long"
_BUCKET = pa.schema([
    ("chunk", pa.int64()), ("ids", pa.binary()), ("id", pa.int64()), ("a", pa.int64()), ("b", pa.int64()),
    ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()),
])


def tokens(data: bytes) -> list[bytes]:
    """Words of a text in order; the end of a piece is a token of its own."""
    return data.translate(_TABLE).replace(_STOP, b" " + _STOP + b" ").split()


def _slices(data: bytes) -> Iterator[bytes]:
    """A text in parts that end behind a blank or separator, so that no word is cut."""
    if len(data) <= SLICE:
        yield data
        return
    start = 0
    while start < len(data):
        end = _END.search(data, start + SLICE)
        stop = end.end() if end else len(data)
        yield data[start:stop]
        start = stop


def packed(*columns: np.ndarray) -> bytes:
    """Columns of integers of one length, bytes of equal weight side by side, compressed."""
    planes = [np.ascontiguousarray(c, "<i8").view("u1").reshape(-1, 8).T.tobytes() for c in columns]
    return struct.pack("<I", len(columns[0])) + zstandard.compress(b"".join(planes), 3)


def _steps(rising: np.ndarray) -> np.ndarray:
    """Differences of a sorted column, which pack better."""
    return np.diff(rising, prepend=0)


def unpacked(data: bytes) -> list[np.ndarray]:
    (size,) = struct.unpack_from("<I", data)
    planes = np.frombuffer(zstandard.decompress(data[4:]), "u1")
    if not size:
        return [np.zeros(0, np.int64)] * 3  # as many as any reader takes
    return [np.ascontiguousarray(c.reshape(8, size).T).view("<i8").ravel() for c in planes.reshape(-1, 8 * size)]


def _batch(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _places(chunk: int, context: int, numbers: np.ndarray) -> list[dict]:
    """The rows that hold which symbol stands at each place of a chunk, -1 for none."""
    cuts = range(0, len(numbers), PART_WORDS)
    return [
        {"chunk": chunk, "context": context, "part": i, "places": packed(numbers[c : c + PART_WORDS])}
        for i, c in enumerate(cuts)
    ]


class _Words:
    """The words of a chunk as they are read, numbered per language."""

    def __init__(self) -> None:
        self.kinds: dict[str, dict[bytes, int]] = {}
        self.parts: list[tuple[str, np.ndarray]] = []
        self.size = self.context = 0

    def add(self, lang: str, found: list[bytes]) -> None:
        kinds = self.kinds.setdefault(lang, {_STOP: 0})
        number = kinds.setdefault
        self.parts.append((lang, np.array([number(w, len(kinds)) for w in found], np.int32)))
        self.size += len(found)

    def rows(self, chunk: int, buckets: int) -> Iterator[list[dict]]:
        """Places, and per bucket and language the words with their counts; words of the context are not counted."""
        offsets, at = {}, 0
        for lang, kinds in self.kinds.items():
            offsets[lang] = at
            at += len(kinds)
        numbers = np.concatenate([part + offsets[lang] for lang, part in self.parts])
        counts = np.bincount(numbers, minlength=at)
        np.subtract.at(counts, numbers[: self.context], 1)
        # Words get new numbers, in a row for every language and bucket, so that a bucket needs only the first.
        renumbered, rows, used = np.full(at, -1, np.int64), [], 0
        for lang, kinds in self.kinds.items():
            words = list(kinds)
            bucket = [xxhash.xxh64_intdigest(w) % buckets for w in words]
            order = sorted(range(1, len(words)), key=lambda i: (bucket[i], words[i]))
            own = np.array(order, np.int64) + offsets[lang]
            renumbered[own] = np.arange(used, used + len(own))
            bounds = np.searchsorted(np.array([bucket[i] for i in order]), np.arange(buckets + 1))
            for b in range(buckets):
                low, high = bounds[b], bounds[b + 1]
                if low < high:
                    n = counts[own[low:high]]
                    text, table = b"\n".join([words[i] for i in order[low:high]]), packed(n)
                    head = struct.pack("<qI", int(used + low), len(table))
                    rows.append({
                        "chunk": chunk, "bucket": b, "lang": lang, "n": int(n.sum()),
                        "counts": head + table + zstandard.compress(text, 3),
                    })
            used += len(own)
        yield _places(chunk, self.context, renumbered[numbers])
        for start in range(0, len(rows), 1000):
            yield rows[start : start + 1000]


def word_chunks(docs: DataFrame, lang: str, text: str, chunk_words: int, buckets: int) -> DataFrame:
    """Chunks of words. A piece that goes on in the next chunk leaves its last
    LONGEST - 1 words there as context, which is counted here only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, words = TaskContext.get().partitionId() << 32, _Words()
        for batch in batches:
            for which, data in zip(batch.column("lang").to_pylist(), batch.column("text")):
                recent: list[bytes] = []
                for part in _slices(data.as_py()):
                    found = tokens(part)
                    while found:
                        room = max(1, chunk_words - words.size)
                        some, found = found[:room], found[room:]
                        words.add(which, some)
                        recent = (recent + some[-LONGEST:])[-LONGEST:]
                        if words.size >= chunk_words:
                            for rows in words.rows(chunk, buckets):
                                yield _batch(_CHUNK, rows)
                            chunk += 1
                            tail = recent[-(LONGEST - 1) :]
                            words = _Words()
                            if _STOP in tail:
                                tail = tail[len(tail) - tail[::-1].index(_STOP) :]
                            words.add(which, tail)
                            words.context = len(tail)
                words.add(which, [_STOP])
        if words.size > words.context:
            for rows in words.rows(chunk, buckets):
                yield _batch(_CHUNK, rows)

    rows = docs.select(
        F.coalesce(F.col(lang), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")
    )
    return stored(rows.mapInArrow(run, CHUNK_SCHEMA), "words")


def count_pairs(symbols: np.ndarray, tile: int = TILE, filled: int = FILLED) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of neighbours that are both symbols (not -1): numbers per place, and a, b and n per number.

    The number of a place without a pair is -1; `numbers` is one shorter than `symbols`.
    """
    left, right = symbols[:-1], symbols[1:]
    numbers = np.full(max(0, len(symbols) - 1), -1, np.int64)
    at = np.flatnonzero((left >= 0) & (right >= 0))
    if not len(at):
        none = np.zeros(0, np.int64)
        return numbers, none, none, none
    a, b = left[at], right[at]
    across, down = a // tile, b // tile
    width = int(down.max()) + 1
    if (int(across.max()) + 1) * width < 1 << 62:
        _, tiles, sizes = np.unique(across * width + down, return_inverse=True, return_counts=True)
    else:
        _, tiles, sizes = np.unique(np.stack([across, down]), axis=1, return_inverse=True, return_counts=True)
    dense = sizes * filled >= tile * tile
    found_a, found_b, found_n, used = [], [], [], 0
    by_tile = np.argsort(tiles, kind="stable")
    ends = np.cumsum(sizes)
    for t in np.flatnonzero(dense):
        own = by_tile[ends[t] - sizes[t] : ends[t]]
        corner_a, corner_b = across[own[0]] * tile, down[own[0]] * tile
        cells = (a[own] - corner_a) * tile + (b[own] - corner_b)
        counts = np.bincount(cells, minlength=tile * tile)
        hit = np.flatnonzero(counts)
        lookup = np.zeros(tile * tile, np.int64)
        lookup[hit] = np.arange(used, used + len(hit))
        numbers[at[own]] = lookup[cells]
        found_a.append(hit // tile + corner_a)
        found_b.append(hit % tile + corner_b)
        found_n.append(counts[hit])
        used += len(hit)
    own = np.flatnonzero(~dense[tiles])
    if len(own):
        order = own[np.lexsort((b[own], a[own]))]
        sorted_a, sorted_b = a[order], b[order]
        new = np.concatenate([[True], (sorted_a[1:] != sorted_a[:-1]) | (sorted_b[1:] != sorted_b[:-1])])
        group = np.cumsum(new) - 1
        numbers[at[order]] = used + group
        found_a.append(sorted_a[new])
        found_b.append(sorted_b[new])
        found_n.append(np.bincount(group))
    return numbers, *[np.concatenate(f) for f in (found_a, found_b, found_n)]


def _answers(chunks: np.ndarray, numbers: np.ndarray, ids: np.ndarray) -> list[dict]:
    """Per chunk one row with the numbers of its frequent symbols and their ids."""
    order = np.lexsort((numbers, chunks))
    cuts = np.flatnonzero(np.diff(chunks[order])) + 1
    return [
        {"chunk": int(chunks[some[0]]), "ids": packed(_steps(numbers[some]), ids[some])}
        for some in np.split(order, cuts) if len(some)
    ]


def _ids(totals: np.ndarray, least: int, bucket: int, buckets: int) -> np.ndarray:
    """Ids by falling frequency of the symbols of a bucket that are frequent, -1 for the others."""
    often = np.flatnonzero(totals >= least)
    ids = np.full(len(totals), -1, np.int64)
    ids[often[np.argsort(-totals[often], kind="stable")]] = np.arange(len(often)) * buckets + bucket
    return ids


def _ranked_words(chunks: DataFrame, least: int, buckets: int) -> DataFrame:
    """Frequent words with their ids, and the answers to the chunks."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, rows = key[0].as_py(), []
        # Orders by what the rows hold, so that a task that runs again gives the same ids.
        table = table.sort_by([("lang", "ascending"), ("chunk", "ascending")])
        words, langs, numbers, counts, owners = [], [], [], [], []
        for chunk, lang, data in zip(*[table.column(c).to_pylist() for c in ("chunk", "lang", "counts")]):
            first, size = struct.unpack_from("<qI", data)
            (n,) = unpacked(data[12 : 12 + size])
            words.append(pa.array(zstandard.decompress(data[12 + size :]).split(b"\n"), pa.binary()))
            langs.append(lang)
            numbers.append(np.arange(first, first + len(n)))
            counts.append(n)
            owners.append(np.full(len(n), chunk))
        start, symbols, found = 0, [], []
        while start < len(langs):
            stop = start
            while stop < len(langs) and langs[stop] == langs[start]:
                stop += 1
            coded = pa.concat_arrays(words[start:stop]).dictionary_encode()
            kinds = coded.dictionary.to_pylist()
            base = len(found)
            symbols.append(coded.indices.to_numpy().astype(np.int64) + base)
            found += [(langs[start], w) for w in kinds]
            start = stop
        symbols, counts = np.concatenate(symbols), np.concatenate(counts)
        totals = np.zeros(len(found), np.int64)
        np.add.at(totals, symbols, counts)
        ids = _ids(totals, least, bucket, buckets)
        for i in np.flatnonzero(ids >= 0).tolist():
            rows.append({"id": int(ids[i]), "lang": found[i][0], "word": found[i][1].decode("utf-8", "replace"), "n": int(totals[i])})
        kept = ids[symbols] >= 0
        rows += _answers(np.concatenate(owners)[kept], np.concatenate(numbers)[kept], ids[symbols][kept])
        return pa.Table.from_pylist(rows, schema=_BUCKET)

    counted = chunks.filter("counts is not null").select("bucket", "chunk", "lang", "counts")
    return stored(counted.groupBy("bucket").applyInArrow(run, BUCKET_SCHEMA), "symbols")


def _ranked_pairs(chunks: DataFrame, least: int, buckets: int) -> DataFrame:
    """Frequent pairs with their ids, and the answers to the chunks."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, rows = key[0].as_py(), []
        table = table.sort_by("chunk")
        firsts, parts = [], []
        for data in table.column("counts").to_pylist():
            firsts.append(struct.unpack_from("<q", data)[0])
            parts.append(unpacked(data[8:]))
        numbers = np.concatenate([np.arange(first, first + len(p[0])) for first, p in zip(firsts, parts)])
        a, b, n = np.concatenate([np.cumsum(p[0]) for p in parts]), *(np.concatenate([p[i] for p in parts]) for i in (1, 2))
        owners = np.repeat(table.column("chunk").to_numpy(), [len(p[0]) for p in parts])
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        firsts = np.flatnonzero(new)
        totals = np.add.reduceat(n[order], firsts)
        ids = _ids(totals, least, bucket, buckets)
        for i in np.flatnonzero(ids >= 0).tolist():
            rows.append({"id": int(ids[i]), "a": int(a[firsts[i]]), "b": int(b[firsts[i]]), "n": int(totals[i])})
        own = ids[np.cumsum(new) - 1]
        kept = own >= 0
        rows += _answers(owners[order][kept], numbers[order][kept], own[kept])
        return pa.Table.from_pylist(rows, schema=_BUCKET)

    counted = chunks.filter("counts is not null").select("bucket", "chunk", "counts")
    return stored(counted.groupBy("bucket").applyInArrow(run, BUCKET_SCHEMA), "symbols")


def _pair_chunks(before: DataFrame, symbols: DataFrame, size: int, tile: int, buckets: int) -> DataFrame:
    """Chunks of phrases of `size` words from those one word shorter and the ids of the frequent ones."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([], _CHUNK)
        chunk, context = key[0].as_py(), left.column("context")[0].as_py()
        parts = sorted(zip(left.column("part").to_pylist(), left.column("places").to_pylist()))
        places = np.concatenate([unpacked(p)[0] for _, p in parts])
        id_of = np.full(int(places.max(initial=-1)) + 2, -1, np.int64)
        for data in right.column("ids").to_pylist():
            steps, ids = unpacked(data)
            id_of[np.cumsum(steps)] = ids
        numbers, a, b, n = count_pairs(id_of[places], tile)
        if not len(a):
            return pa.Table.from_batches([], _CHUNK)
        # A phrase that lies in the context was counted in the chunk before.
        inside = numbers[: max(0, context - size + 1)]
        n = n.copy()
        np.subtract.at(n, inside[inside >= 0], 1)
        mixed = (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        bucket = (mixed % np.uint64(buckets)).astype(np.int64)
        # New numbers, in a row for every bucket, so that a bucket needs only the first.
        order = np.lexsort((b, a, bucket))
        renumbered = np.empty(len(order) + 1, np.int64)
        renumbered[order], renumbered[-1] = np.arange(len(order)), -1
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = _places(chunk, context, renumbered[numbers])
        for at in range(buckets):
            some = order[bounds[at] : bounds[at + 1]]
            if len(some):
                counts = struct.pack("<q", int(bounds[at])) + packed(_steps(a[some]), b[some], n[some])
                rows.append({"chunk": chunk, "bucket": at, "counts": counts})
        return pa.Table.from_pylist(rows, schema=_CHUNK)

    places = before.filter("places is not null").select("chunk", "context", "part", "places")
    # Fresh names: both sides come from the same table.
    own = symbols.filter("ids is not null").select("chunk", "ids").toDF("of", "ids")
    paired = places.groupBy("chunk").cogroup(own.groupBy("of")).applyInArrow(run, CHUNK_SCHEMA)
    return stored(paired, "pairs")


def _score(a: Column, n: Column, l: Column, r: Column) -> Column:
    """floor(1000 * a * n / (l * r)), in whole numbers of up to 38 digits."""
    wide = [c.cast("decimal(19,0)") for c in (a, n, l, r)]
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * wide[0] * wide[1], wide[2] * wide[3])


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, top: int = TOP,
    share: int = 100, chunk_words: int = CHUNK_WORDS, tile: int = TILE,
) -> DataFrame:
    """The best phrases of 2 to `longest` words of each language: lang, rank, phrase, a, l, r, n, score.

    `a` counts the phrase, `l` and `r` the two parts of its weakest cut, `n` all
    words of the language; phrases of `least` occurrences are candidates. One that
    lies in a longer candidate which is at least `share` percent as frequent is
    dropped. Order: score, then a, both falling, then the phrase's bytes.

    Null texts are empty, a null language is `und`; repeated rows count each time.
    An empty table, or one without frequent phrases, gives no rows. Other columns are
    not read. Products are exact up to 38 digits; beyond that Spark raises an error.
    """
    buckets = partitions(docs.sparkSession)
    chunks = word_chunks(docs, lang, text, chunk_words, buckets)
    sizes = chunks.filter("counts is not null").groupBy("lang").agg(F.sum("n").alias("all"))
    symbols = _ranked_words(chunks, least, buckets)
    none = F.array().cast("array<long>")
    below = symbols.filter("id is not null").select(
        "lang", "id", "n", F.col("word").alias("phrase"), F.col("word").alias("last"), none.alias("heads"), none.alias("tails")
    )
    levels = []
    for size in range(2, longest + 1):
        chunks = _pair_chunks(chunks, symbols, size, tile, buckets)
        symbols = _ranked_pairs(chunks, least, buckets)
        pairs = symbols.filter("id is not null").select("id", "a", "b", "n")
        # The first size - 1 words of a phrase are the symbol a, the last ones b.
        first = below.select("lang", F.col("id").alias("a"), "phrase", F.concat("heads", F.array("n")).alias("heads"))
        second = below.select(F.col("id").alias("b"), "last", F.concat("tails", F.array("n")).alias("tails"))
        below = stored(
            pairs.join(first, "a").join(second, "b").select(
                "lang", "id", "n", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "heads", "tails", "a", "b"
            ),
            "phrases",
        )
        levels.append(below)

    candidates = []
    for level, longer in zip(levels, [*levels[1:], None]):
        if longer is not None:
            # Frequency falls with every word, so the next longer phrases decide.
            around = longer.select("lang", F.explode(F.array("a", "b")).alias("id"), F.col("n").alias("around"))
            around = around.groupBy("lang", "id").agg(F.max("around").alias("around"))
            level = level.join(around, ["lang", "id"], "left").filter(
                F.col("around").isNull() | (100 * F.col("around") < share * F.col("n"))
            )
        candidates.append(level.select("lang", "phrase", F.col("n").alias("a"), "heads", "tails"))
    together = candidates[0]
    for more in candidates[1:]:
        together = together.union(more)

    def cut(k: Column) -> Column:
        left = F.element_at("heads", k)
        right = F.element_at("tails", F.size("tails") - k + 1)
        return F.struct(
            _score(F.col("a"), F.col("all"), left, right).alias("score"), k.alias("k"), left.alias("l"), right.alias("r")
        )

    weakest = F.array_min(F.transform(F.sequence(F.lit(1), F.size("heads")), cut))
    scored = together.join(sizes, "lang").withColumn("cut", weakest).select(
        "lang", "phrase", "a", "cut.l", "cut.r", F.col("all").alias("n"), "cut.score"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


COLLOCATIONS_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM worded, (SELECT unnest(range(1, {LONGEST + 1})) AS k))),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM counts WHERE k >= 2 AND f >= {LEAST}),
cuts AS (
  SELECT lang, k, phrase, f, c, array_to_string(w[:c], ' ') AS head, array_to_string(w[c + 1:], ' ') AS tail
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM candidates)),
scored AS (
  SELECT t.lang, t.phrase, t.k, t.f AS a, t.c, l.f AS l, r.f AS r, n,
    CAST(1000::HUGEINT * t.f * n // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts t JOIN counts l ON l.lang = t.lang AND l.k = t.c AND l.phrase = t.head
    JOIN counts r ON r.lang = t.lang AND r.k = t.k - t.c AND r.phrase = t.tail JOIN sizes s ON s.lang = t.lang),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
kept AS (
  SELECT * FROM weakest p WHERE NOT EXISTS (
    SELECT 1 FROM candidates o WHERE o.lang = p.lang AND o.k > p.k AND 100 * o.f >= 100 * p.a
      AND contains(' ' || o.phrase || ' ', ' ' || p.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= {TOP}
"""
