"""Line deduplication by a tree of line templates.

A line is parsed to a fixed depth: by its number of words, then by its leading
words (and the last), where a word with a digit counts as a variable field. The
leaf that is reached holds templates. A line joins the template that agrees with
it in most positions, if these are enough, and turns the other positions into
variable fields; else it starts a template. Templates that recur in several
documents are boilerplate: their lines are dropped everywhere but in the first
document that has one.

Lines that are equal after masking are merged before the shuffle, so a very
common line reaches its leaf as one row per task. A leaf is read in sorted order
and only its templates are held, never its lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.shared import partitions, stored

FIELD = b"<*>"
LEADING = 3
SIMILAR = 0.8
MIN_DOCS = 3
_DIGIT = re.compile(rb"[0-9]")


def masked(line: bytes) -> list[bytes]:
    """The words of a line; those with a digit are variable fields."""
    found = line.split()
    if _DIGIT.search(line):
        return [FIELD if _DIGIT.search(w) else w for w in found]
    return found


def leaf(found: list[bytes], leading: int = LEADING) -> int:
    """The leaf of a line, as a signed 64-bit number."""
    path = b" ".join([b"%d" % len(found), *found[:leading], found[-1]])
    return int(np.uint64(xxhash.xxh64_intdigest(path)).view(np.int64))


def digest(found: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(found))


class Leaf:
    """The templates of one leaf: their words, members and the smallest documents."""

    def __init__(self, similar: float, min_docs: int):
        self.similar, self.min_docs = similar, min_docs
        self.grids: dict[int, np.ndarray] = {}  # number of words -> templates x words, hashes, 0 for a field
        self.used: dict[int, int] = {}
        self.members: dict[tuple[int, int], list[bytes]] = {}
        self.docs: dict[tuple[int, int], list[bytes]] = {}

    def add(self, found: list[bytes], docs: list[bytes]) -> None:
        """Put one masked line, with its smallest documents, to the best template or a new one."""
        n = len(found)
        # Hashes are compared inside one process only.
        row = np.array([0 if w == FIELD else hash(w) | 1 for w in found], np.int64)
        used = self.used.get(n, 0)
        grid = self.grids.setdefault(n, np.zeros((4, n), np.int64))
        same = (grid[:used] == row).sum(axis=1)
        at = int(same.argmax()) if used else 0
        if used and same[at] >= self.similar * n:
            grid[at][grid[at] != row] = 0
        else:
            if used == len(grid):
                grid = self.grids[n] = np.concatenate([grid, np.zeros_like(grid)])
            at, grid[used], self.used[n] = used, row, used + 1
        key = (n, at)
        self.members.setdefault(key, []).append(digest(found))
        self.docs[key] = sorted({*self.docs.get(key, ()), *docs})[: self.min_docs]

    def recurring(self) -> Iterator[tuple[bytes, bytes]]:
        """(line digest, first document) for the lines of templates in enough documents."""
        for key, docs in self.docs.items():
            if len(docs) >= self.min_docs:
                for member in self.members[key]:
                    yield member, docs[0]


def document_key(doc_id: Column, text: Column) -> Column:
    """17 bytes that sort by doc_id, null last, then by a hash of the text."""
    parts = [F.when(doc_id.isNull(), F.lit("01")).otherwise(F.lit("00"))]
    # Flipping the sign bit makes negative ids sort before the others.
    flipped = F.coalesce(doc_id, F.lit(0)).cast("long").bitwiseXOR(F.lit(-(1 << 63)))
    parts += [F.lpad(F.hex(n), 16, "0") for n in (flipped, F.xxhash64(text))]
    return F.unhex(F.concat(*parts))


def _masked_lines(docs: DataFrame, leading: int, min_docs: int, held: int) -> DataFrame:
    """(leaf, line, docs): every masked line once per some ten thousand, with up to `min_docs` smallest documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[bytes, list[bytes]] = {}

        def flush() -> pa.RecordBatch:
            found = list(lines)
            leaves = [leaf(line.split(b" "), leading) for line in found]
            out = pa.RecordBatch.from_arrays(
                [pa.array(leaves, pa.int64()), pa.array(found, pa.binary()), pa.array(list(lines.values()), pa.list_(pa.binary()))],
                names=["leaf", "line", "docs"],
            )
            lines.clear()
            return out

        size = 0
        for batch in batches:
            for key, value in zip(batch.column("key"), batch.column("text")):
                key = key.as_py()
                for line in (value.as_py() or "").encode().split(b"\n"):
                    found = masked(line)
                    if not found:
                        continue
                    joined = b" ".join(found)
                    known = lines.get(joined)
                    if known is None:
                        lines[joined] = [key]
                        size += len(joined)
                    elif key not in known:
                        if len(known) < min_docs:
                            known.append(key)
                        elif key < max(known):
                            known[known.index(max(known))] = key
                if size > held:
                    yield flush()
                    size = 0
        if lines:
            yield flush()

    return docs.select("key", "text").mapInArrow(run, "leaf long, line binary, docs array<binary>")


def _recurring(lines: DataFrame, similar: float, min_docs: int) -> DataFrame:
    """(digest, first) of the masked lines whose template recurs."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, list[bytes]]]:
        """(leaf, line, smallest documents) with equal lines as one."""
        at, line, docs = None, None, []
        for batch in batches:
            for leaf_id, own, own_docs in zip(*(batch.column(c).to_pylist() for c in ("leaf", "line", "docs"))):
                if own == line and leaf_id == at:
                    docs = sorted({*docs, *own_docs})[:min_docs]
                    continue
                if line is not None:
                    yield at, line, docs
                at, line, docs = leaf_id, own, own_docs
        if line is not None:
            yield at, line, docs

    def out(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.binary())], names=["digest", "first"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A leaf with one line is its own template; a tree is grown from the second line on.
        at, single, tree, found = None, None, None, []

        def closed() -> Iterator[tuple[bytes, bytes]]:
            if tree is not None:
                yield from tree.recurring()
            elif single is not None and len(single[1]) >= min_docs:
                yield digest(single[0].split(b" ")), min(single[1])

        for leaf_id, line, docs in members(batches):
            if leaf_id != at:
                found += closed()
                if len(found) > 10_000:
                    yield out(found)
                    found = []
                at, single, tree = leaf_id, (line, docs), None
                continue
            if tree is None:
                tree = Leaf(similar, min_docs)
                tree.add(single[0].split(b" "), single[1])
            tree.add(line.split(b" "), docs)
        found += closed()
        yield out(found)

    placed = lines.repartition(partitions(lines.sparkSession), "leaf").sortWithinPartitions("leaf", "line")
    return placed.mapInArrow(run, "digest binary, first binary")


def _document_lines(docs: DataFrame) -> DataFrame:
    """(key, digest): the different masked lines of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, digests = [], []
            for key, value in zip(batch.column("key"), batch.column("text")):
                found = {digest(m) for m in map(masked, (value.as_py() or "").encode().split(b"\n")) if m}
                keys += [key.as_py()] * len(found)
                digests += found
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.binary())], names=["key", "digest"])

    return docs.select("key", "text").mapInArrow(run, "key binary, digest binary")


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", leading: int = LEADING,
    similar: float = SIMILAR, min_docs: int = MIN_DOCS, held_bytes: int = 32_000_000,
    counts: bool = False,
) -> DataFrame:
    """All rows and columns of `docs`, `text` without the lines of recurring templates.

    A template recurs when `min_docs` documents or more have a line of it. The
    first document (smallest doc_id, null last, then by text) keeps its lines. A
    document is a doc_id with a text: repeated rows are one document and are
    treated alike. Lines without a word stay; a null text stays null. With
    `counts` the result is doc_id, n_lines, n_dropped (long) and the text.
    """
    keyed = docs.select(
        document_key(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("text"),
        F.struct(*[c for c in docs.columns if c != text]).alias("doc"),
    )
    lines = _masked_lines(keyed, leading, min_docs, held_bytes)
    found = stored(_recurring(lines, similar, min_docs), "recurring")
    drops = (
        _document_lines(keyed).join(found, "digest").filter("key <> first")
        .groupBy("key").agg(F.collect_set("digest").alias("drops"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for value, drop in zip(batch.column("text"), batch.column("drops")):
                own, drop = value.as_py(), set(drop.as_py() or ())
                split = own.split("\n") if own is not None else []
                kept = split
                if drop:
                    kept = [line for line in split if not (m := masked(line.encode())) or digest(m) not in drop]
                texts.append(None if own is None else "\n".join(kept))
                n_lines.append(len(split))
                n_dropped.append(len(split) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=["doc", "text", "n_lines", "n_dropped"],
            )

    joined = keyed.join(drops, "key", "left").select("doc", "text", "drops")
    kind = joined.schema["doc"].dataType.simpleString()
    out = joined.mapInArrow(run, f"doc {kind}, text string, n_lines long, n_dropped long")
    if counts:
        return out.select(F.col("doc")[doc_id].alias("doc_id"), "n_lines", "n_dropped", "text")
    return out.select(*[F.col("text").alias(c) if c == text else F.col("doc")[c].alias(c) for c in docs.columns])
