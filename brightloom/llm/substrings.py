"""Removal of repeated byte strings with a logarithmic family of suffix arrays.

Every 50-byte window has an anchor: the place in it whose 24 bytes hash lowest,
the first of several. Equal windows have their anchors at the same offset, so
only strings around equal anchors can match. The windows of one anchor follow
each other; together they are a segment of at most 76 bytes.

1. Documents are packed into chunks. Every chunk sends the hashes of its anchors
   to buckets, and a bucket answers which ones occur in several chunks.
2. Segments whose anchor repeats are dealt to buckets by anchor. In a bucket they
   come in batches of ascending doc_id. A batch gets a suffix array (its strings in
   sorted order with the smallest doc_id of each) and is merge-scanned against the
   sorted arrays of the levels there are; then it becomes a level itself, and
   levels of like size merge. A segment that an earlier document has too is a match
   as a whole. Where segments of one anchor differ, the suffixes at their windows
   go through a family of their own.
3. The matches go back to their chunks, which remove the bytes and digest the rest.

A segment that very many documents share is sent once per chunk, by the document
with the smallest id there; the others of the chunk are settled at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.llm.shared import partitions, rows_at_once, stored

GRAM = 24
_SLICE = 1 << 18
# Texts, and chunks or what they send, that go to Python in a batch. A split of the chunk table has some hundred chunks.
TEXTS_AT_ONCE, CHUNKS_AT_ONCE = 512, 16
# Anchors, and segments with repeated anchors, that a bucket gets on average at most.
BUCKET_KEYS, BUCKET_SEGMENTS = 2_000_000, 400_000
_NO_ID = np.iinfo(np.int64).max


def _hashes(data: np.ndarray) -> np.ndarray:
    """A mixed hash of every GRAM bytes, from those of 1, 2, 4, 8 and 16 bytes."""
    base = 0x9E3779B97F4A7C15

    def beside(a: np.ndarray, b: np.ndarray, a_size: int, b_size: int) -> np.ndarray:
        n = max(0, len(data) - a_size - b_size + 1)
        return a[:n] * np.uint64(pow(base, b_size, 1 << 64)) + b[a_size : a_size + n]

    one, size = data.astype(np.uint64) + np.uint64(1), 1
    eight = one
    while size < 16:
        one = beside(one, one, size, size)
        size *= 2
        if size == 8:
            eight = one
    h = beside(one, eight, 16, 8)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _window_anchors(data: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Per window start: the place of its anchor and the anchor's hash."""
    low = _hashes(data)
    at = np.arange(len(low), dtype=np.int32)
    wanted, have = window - GRAM + 1, 1
    while have < wanted:
        step = min(have, wanted - have)
        later = low[step:] < low[: len(low) - step]
        at = np.where(later, at[step:], at[: len(at) - step])
        low = np.where(later, low[step:], low[: len(low) - step])
        have += step
    return at, low


def segments(data: np.ndarray, lengths: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(anchor hash, first window, last window) of all documents' segments in a chunk.

    `data` holds the documents end to end; windows over a border are left out.
    """
    places, hashes, starts = [], [], []
    ends = np.cumsum(lengths)
    own_end = np.repeat(ends, lengths)
    for begin in range(0, max(0, len(data) - window + 1), _SLICE):
        stop = min(len(data), begin + _SLICE + window - 1)
        at, low = _window_anchors(data[begin:stop], window)
        start = np.arange(begin, begin + len(at))
        inside = start + window <= own_end[begin : begin + len(at)]
        places.append(at[inside].astype(np.int64) + begin)
        hashes.append(low[inside])
        starts.append(start[inside])
    if not places:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, low, start = np.concatenate(places), np.concatenate(hashes), np.concatenate(starts)
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(place)]]) - 1 if len(first) else first
    return low[first], start[first], start[last]


class SuffixFamily:
    """Sorted arrays of fixed-length strings, each with the smallest doc_id, in levels of growing size."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    @staticmethod
    def array(strings: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The different strings in order, each with its smallest doc_id."""
        order = np.argsort(strings, kind="stable")
        ordered = strings[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        return ordered[new], np.minimum.reduceat(docs[order], np.flatnonzero(new))

    def add(self, strings: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Add a batch; the smallest doc_id that has each of its strings, in the levels or the batch."""
        if not len(strings):
            return docs
        own, least = self.array(strings, docs)
        found = least.copy()
        for known, ids in self.levels:
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            found = np.where(known[at] == own, np.minimum(found, ids[at]), found)
        self.levels.append((own, least))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            (a, a_ids), (b, b_ids) = self.levels.pop(), self.levels.pop()
            self.levels.append(self.array(np.concatenate([a, b]), np.concatenate([a_ids, b_ids])))
        return found[np.searchsorted(own, strings)]


def earliest(strings: np.ndarray, docs: np.ndarray, batch: int) -> np.ndarray:
    """For each string the smallest doc_id that has it, by batches of ascending doc_id through a family."""
    order = np.argsort(docs, kind="stable")
    found, family, at = np.empty_like(docs), SuffixFamily(), 0
    while at < len(order):
        stop = min(len(order), at + batch)
        part = order[at:stop]
        found[part] = family.add(strings[part], docs[part])
        at = stop
    return found


def _strings(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Byte strings of up to `width` bytes as one sortable array; a last byte tells their size."""
    grid = np.zeros((len(starts), width + 1), np.uint8)
    offset = np.arange(width)
    for at in range(0, len(starts), 1 << 14):
        some = slice(at, at + (1 << 14))
        index = np.minimum(starts[some, None] + offset, len(data) - 1)
        grid[some, :width] = np.where(offset < sizes[some, None], data[index], 0)
        grid[some, width] = sizes[some]
    # One byte more than zero at the end: S-strings drop trailing zeros, and a size is never zero.
    return grid.reshape(-1).view(f"S{width + 1}")


def _packed(values: np.ndarray) -> bytes:
    """The compressed bytes of an array; most of what a bucket gets is text and small numbers."""
    return zstandard.compress(values.tobytes(), 6)


class _Chunk:
    """The documents of one row of the chunk table."""

    def __init__(self, row: pa.Table, window: int):
        self.id = row.column("chunk")[0].as_py()
        self.docs = np.frombuffer(row.column("docs")[0].as_py(), "<i8")
        self.lengths = np.frombuffer(row.column("lengths")[0].as_py(), "<i8")
        self.data = np.frombuffer(zstandard.decompress(row.column("data")[0].as_py()), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.window = window

    def segments(self) -> None:
        self.anchor, self.low, self.high = segments(self.data, self.lengths, self.window)
        self.own = np.searchsorted(self.starts, self.low, side="right") - 1  # the last of equal starts: those before are empty
        self.short = self.anchor >> np.uint64(16)


def chunk_table(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """(chunk, docs, ids, lengths, data, size): documents packed to about `chunk_bytes`, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0

        def close() -> pa.RecordBatch:
            numbers = np.array([_NO_ID if i is None else i for i in ids], "<i8")
            lengths = np.array([len(t) for t in texts], "<i8")
            data = zstandard.compress(b"".join(texts), 6)
            return pa.RecordBatch.from_pydict(
                {"docs": [numbers.tobytes()], "ids": [ids], "lengths": [lengths.tobytes()], "data": [data], "size": [size]}, schema=schema
            )

        schema = pa.schema(
            [("docs", pa.binary()), ("ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("data", pa.binary()), ("size", pa.int64())]
        )
        for batch in batches:
            for i, value in zip(batch.column("id").to_pylist(), batch.column("text")):
                ids.append(i)
                texts.append((value.as_py() or "").encode())
                size += len(texts[-1])
                if size >= chunk_bytes:
                    yield close()
                    ids, texts, size = [], [], 0
        if ids:
            yield close()

    packed = docs.mapInArrow(run, "docs binary, ids array<bigint>, lengths binary, data binary, size long")
    with rows_at_once(docs.sparkSession, TEXTS_AT_ONCE):
        return stored(packed.withColumn("chunk", F.monotonically_increasing_id()), "chunks")


def _repeated_anchors(chunks: DataFrame, window: int, buckets: int) -> DataFrame:
    """(chunk, bucket, bits, found): which of the chunk's different anchors in a bucket other chunks have.

    `found` is the number of segments that the chunk will send for them, and for those that repeat inside it, at most.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = _Chunk(pa.Table.from_batches([batch.slice(i, 1)]), window)
                chunk.segments()
                keys, often = np.unique(chunk.short, return_counts=True)
                bucket = (keys % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                again = np.bincount(bucket, np.where(often > 1, often, 0), buckets).astype(np.int64)
                # Six bytes of a hash: an accidental match costs a comparison, no wrong result. In order, the bytes
                # of one rank together, the high ones are the same for many keys.
                short = keys[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                rows = [b for b in range(buckets) if cuts[b] < cuts[b + 1]]
                yield pa.RecordBatch.from_pydict(
                    {"bucket": pa.array(rows, pa.int32()), "chunk": pa.array([chunk.id] * len(rows), pa.int64()),
                     "keys": pa.array([_packed(short[cuts[b] : cuts[b + 1]].T) for b in rows], pa.binary()),
                     "again": pa.array(again[rows], pa.int64())}
                )

    def answer(table: pa.Table) -> pa.Table:
        parts = []
        for blob in table.column("keys"):
            short = np.frombuffer(zstandard.decompress(blob.as_py()), np.uint8).reshape(6, -1).T
            parts.append(np.pad(short, ((0, 0), (0, 2))).reshape(-1).view("<u8"))
        every = np.sort(np.concatenate(parts))
        repeated = np.unique(every[1:][every[1:] == every[:-1]])
        flags = [
            repeated[np.minimum(np.searchsorted(repeated, p), len(repeated) - 1)] == p if len(repeated) else np.zeros(len(p), bool)
            for p in parts
        ]
        found = np.array([f.sum() for f in flags]) + table.column("again").to_numpy()
        bits = pa.array([np.packbits(f).tobytes() for f in flags], pa.binary())
        answers = pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "bits": bits, "found": pa.array(found, pa.int64())})
        return answers.filter(pc.greater(answers.column("found"), 0))

    sent = chunks.mapInArrow(send, "bucket int, chunk long, keys binary, again long")
    return sent.groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, bits binary, found long")


_MATCHES = "bucket int, chunk long, anchor binary, doc binary, place binary, string binary"


def _candidates(chunks: DataFrame, flags: DataFrame, window: int, buckets: int, targets: int) -> DataFrame:
    """Segments with repeated anchors by one of `targets` buckets; without anchors the (low, high) that a chunk settles itself."""
    width = 2 * window - GRAM

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _Chunk(left, window)
        chunk.segments()
        keys, inverse = np.unique(chunk.short, return_inverse=True)
        bucket = (keys % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        flagged = np.zeros(len(keys), bool)
        for b, bits in zip(right.column("bucket").to_pylist(), right.column("bits").to_pylist()):
            place = order[cuts[b] : cuts[b + 1]]
            flagged[place] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(place)).astype(bool)
        doc = chunk.docs[chunk.own] if len(chunk.own) else np.zeros(0, np.int64)
        least, most = np.full(len(keys), _NO_ID), np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(least, inverse, doc)
        np.maximum.at(most, inverse, doc)
        chosen = np.flatnonzero((flagged | (least < most))[inverse])
        low, size = chunk.low[chosen], chunk.high[chosen] - chunk.low[chosen] + window
        string, doc = _strings(chunk.data, low, size, width), doc[chosen]
        first = earliest(string, doc, 1 << 20)
        late = first < doc
        rows = [(chunk.id % targets, b"", b"", np.concatenate([low[late], (low + size)[late]]).astype("<i8").tobytes(), b"")]
        kept = np.flatnonzero(~late)
        target = (chunk.short[chosen][kept] % np.uint64(targets)).astype(np.int64)
        by_target = np.argsort(target, kind="stable")
        for k in np.split(kept[by_target], np.flatnonzero(np.diff(target[by_target])) + 1) if len(kept) else []:
            b = chunk.short[chosen[k[0]]] % np.uint64(targets)
            columns = (chunk.short[chosen][k].astype("<u8"), doc[k].astype("<i8"), low[k].astype("<i8"), string[k])
            rows.append((int(b), *map(_packed, columns)))
        columns = list(zip(*rows))
        return pa.table(
            {"bucket": pa.array(columns[0], pa.int32()), "chunk": pa.array([chunk.id] * len(rows), pa.int64())}
            | {n: pa.array(c, pa.binary()) for n, c in zip(("anchor", "doc", "place", "string"), columns[1:])}
        )

    return chunks.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(send, _MATCHES)


def _slices(anchor: np.ndarray, weight: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Places of the rows by ascending anchor, whole anchors together, of about `most` in weight."""
    order = np.argsort(anchor, kind="stable")
    ordered, total = anchor[order], np.cumsum(weight[order])
    at = 0
    while at < len(order):
        done = total[at - 1] if at else 0
        last = min(len(order) - 1, int(np.searchsorted(total, done + most)))
        to = int(np.searchsorted(ordered, ordered[last], "left"))
        to = to if to > at else int(np.searchsorted(ordered, ordered[last], "right"))
        yield order[at:to]
        at = to


def bucket_matches(table: pa.Table, window: int, batch: int) -> pa.Table:
    """(chunk, spans) of a bucket, [low, high) pairs in their chunk.

    Equal strings have equal anchors, so some anchors at a time are matched and only
    their windows are held.
    """
    width = 2 * window - GRAM
    sent = pa.array([len(a) > 0 for a in table.column("anchor").to_pylist()], pa.bool_())
    settled = table.filter(pc.invert(sent)).select(["chunk", "place"]).rename_columns(["chunk", "spans"])
    table = table.filter(sent)
    if not table.num_rows:
        return settled

    def blobs(name: str) -> list[bytes]:
        return [zstandard.decompress(b.as_py()) for b in table.column(name)]

    anchors = blobs("anchor")
    anchor, doc, place = (np.frombuffer(b"".join(b), kind) for b, kind in ((anchors, "<u8"), (blobs("doc"), "<i8"), (blobs("place"), "<i8")))
    strings = b"".join(blobs("string"))
    string = np.frombuffer(strings, f"S{width + 1}")
    grid = np.frombuffer(strings, np.uint8).reshape(-1, width + 1)
    sizes = grid[:, width].astype(np.int64)
    chunk = np.repeat(table.column("chunk").to_numpy(), [len(a) // 8 for a in anchors])
    spans = []
    for own in _slices(anchor, sizes - window + 1, max(batch, 1)):
        whole = earliest(string[own], doc[own], batch) < doc[own]
        spans.append((chunk[own[whole]], place[own[whole]], (place + sizes)[own[whole]]))
        # Anchors with different segments: their windows one by one, but for documents' segments that matched whole.
        order = own[np.lexsort((string[own], anchor[own]))]
        fresh = anchor[order][1:] == anchor[order][:-1]
        differ = fresh & (string[order][1:] != string[order][:-1])
        rows = own[np.isin(anchor[own], np.unique(anchor[order][1:][differ])) & ~whole]
        windows = sizes[rows] - window + 1
        row = np.repeat(rows, windows)
        offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        family, at = SuffixFamily(), 0
        by_doc = np.argsort(doc[row], kind="stable")
        row, offset = row[by_doc], offset[by_doc]
        while at < len(row):
            r, o = row[at : at + batch], offset[at : at + batch]
            suffix = np.empty((len(r), window + 1), np.uint8)
            suffix[:, :window] = grid[r[:, None], o[:, None] + np.arange(window)]
            suffix[:, window] = 1
            hit = family.add(suffix.reshape(-1).view(f"S{window + 1}"), doc[r]) < doc[r]
            spans.append((chunk[r[hit]], place[r[hit]] + o[hit], place[r[hit]] + o[hit] + window))
            at += batch
    chunk, low, high = (np.concatenate(c) for c in zip(*spans))
    by_chunk = np.argsort(chunk, kind="stable")
    cuts = np.flatnonzero(np.diff(chunk[by_chunk])) + 1
    groups = np.split(by_chunk, cuts) if len(chunk) else []
    pieces = [np.concatenate([low[g], high[g]]).astype("<i8").tobytes() for g in groups]
    found = pa.table({"chunk": pa.array([chunk[g[0]] for g in groups], pa.int64()), "spans": pa.array(pieces, pa.binary())})
    return pa.concat_tables([found, settled.cast(found.schema)])


def _matches(candidates: DataFrame, window: int, batch: int) -> DataFrame:
    """(chunk, spans): from the families of every bucket, [low, high) pairs in their chunk."""

    def scan(table: pa.Table) -> pa.Table:
        return bucket_matches(table, window, batch)

    return candidates.groupBy("bucket").applyInArrow(scan, "chunk long, spans binary")


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 50, chunk_bytes: int = 2_000_000,
    batch: int = 100_000,
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes.

    Removed is each byte of a `window`-byte string that also starts in a document
    with a smaller doc_id, in the given texts. Strings never cross documents.
    Texts shorter than `window` and null or empty ones lose nothing. Rows of equal
    doc_id do not remove from one another; rows without a doc_id come after all
    others, and remove nothing. Other columns are not read.
    """
    if not 2 * GRAM <= window <= 127:
        raise ValueError(f"window must be {2 * GRAM} to 127")
    chunks = chunk_table(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")), chunk_bytes)
    # As many buckets as the session has partitions, more where a bucket would outgrow a task. Anchors are half a window's reach apart.
    least = partitions(docs.sparkSession)
    anchors = (chunks.agg(F.sum("size")).first()[0] or 0) * 2 // (window - GRAM + 2)
    buckets = max(least, -(-anchors // BUCKET_KEYS))
    with rows_at_once(docs.sparkSession, CHUNKS_AT_ONCE):
        flags = stored(_repeated_anchors(chunks.drop("ids", "size"), window, buckets), "flags")
    targets = max(least, -(-(flags.agg(F.sum("found")).first()[0] or 0) // BUCKET_SEGMENTS))
    candidates = _candidates(chunks.drop("ids", "size"), flags.drop("found"), window, buckets, targets)
    with rows_at_once(docs.sparkSession, CHUNKS_AT_ONCE):
        matches = stored(_matches(candidates, window, batch), "matches")

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = _Chunk(left, window)
        change = np.zeros(len(chunk.data) + 1, np.int64)
        for blob in right.column("spans").to_pylist():
            low, high = np.frombuffer(blob, "<i8").reshape(2, -1)
            np.add.at(change, low, 1)
            np.add.at(change, high, -1)
        gone = np.cumsum(change)[:-1] > 0
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        border = chunk.starts[chunk.starts < len(gone)]
        opens[border] = gone[border]
        removed, spans, digests, kept = [], [], [], []
        for start, length in zip(chunk.starts.tolist(), chunk.lengths.tolist()):
            own = gone[start : start + length]
            removed.append(int(own.sum()))
            spans.append(int(opens[start : start + length].sum()))
            kept.append(chunk.data[start : start + length][~own].tobytes())
            digests.append(hashlib.sha256(kept[-1]).hexdigest())
        return pa.table(
            {
                "doc_id": left.column("ids").combine_chunks().flatten(), "n_bytes": pa.array(chunk.lengths, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()), "kept": pa.array(kept, pa.binary()),
            }
        )

    return (
        chunks.groupBy("chunk").cogroup(matches.groupBy("chunk"))
        .applyInArrow(apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    )
