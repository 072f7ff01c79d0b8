"""Token ids in binary files of patched frame-of-reference blocks.

A file holds consecutive documents. Their ids are cut into blocks of a fixed
number of ids. A block stores its minimum and, packed at one bit width, what each
id has above it; the width is the one that a given share of the block's values
fits in, and the few larger values are patched from an exception list of
(position, bits above the width). A block index gives where each block starts,
so a reader can take one block, and a document table gives the ids and lengths
of the documents.

Layout, little-endian: header `PFB1`, then u32 block size, u64 documents, u64
ids, u64 blocks, u64 exceptions; document table (u8 has-id flags, i64 doc_ids,
u32 lengths); block index (u64 start of the packed bits from the first block's,
u64 first exception); u32 minima; u8 widths; exceptions (u16 positions, u32 high
bits); packed bits in u64 words, 64 values in as many words as their width, the
first value lowest, the last group of a block filled with zeros.
"""

from __future__ import annotations

import functools
import struct
import zlib
from array import array
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brightloom.llm.shared import partitions, scratch, stored

MAGIC = b"PFB1"
_HEADER = struct.Struct("<4sIQQQQ")
BLOCK_IDS = 1024
SHARE = 0.9
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # after letters they start a new piece; an apostrophe may not


def _packed_bytes(widths: np.ndarray, block_ids: int) -> np.ndarray:
    """Bytes of the packed bits of blocks of the given widths."""
    return widths.astype(np.int64) * (-(-block_ids // 64) * 8)


def _to_words(values: np.ndarray, width: int) -> np.ndarray:
    """The rows of `values` (below 2**width) as rows of bytes: every 64 values fill `width` words of 64 bits."""
    rows, n = values.shape
    lanes = np.zeros((rows, -(-n // 64) * 64), np.uint64)
    lanes[:, :n] = values
    lanes = np.ascontiguousarray(lanes.reshape(-1, 64).T)
    out = np.zeros((width, lanes.shape[1]), "<u8")
    for k in range(64):
        word, shift = divmod(k * width, 64)
        out[word] |= lanes[k] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).view(np.uint8).reshape(rows, -1)


def _from_words(lines: np.ndarray, width: int, n: int) -> np.ndarray:
    """The values that `_to_words` packed."""
    words = np.ascontiguousarray(lines.view("<u8").reshape(-1, width).T)
    out, keep = np.empty((64, words.shape[1]), np.uint32), np.uint64((1 << width) - 1)
    for k in range(64):
        word, shift = divmod(k * width, 64)
        value = words[word] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[word + 1] << np.uint64(64 - shift)
        out[k] = value & keep
    return np.ascontiguousarray(out.T).reshape(len(lines), -1)[:, :n]


def pack_blocks(ids: np.ndarray, block_ids: int, share: float) -> tuple[np.ndarray, ...]:
    """(minima, widths, starts, packed, first exceptions, positions, high bits) of the blocks of `ids`."""
    n = -(-len(ids) // block_ids)
    padded = np.full(n * block_ids, ids[-1] if len(ids) else 0, np.uint32)
    padded[: len(ids)] = ids
    grid = padded.reshape(n, block_ids)
    minima = grid.min(axis=1) if n else np.zeros(0, np.uint32)
    above = grid - minima[:, None]
    at = min(block_ids - 1, int(share * block_ids))
    typical = np.partition(above, at, axis=1)[:, at] if n else np.zeros(0, np.uint32)
    widths = np.ceil(np.log2(typical.astype(np.float64) + 1)).astype(np.uint8)
    high = np.where(widths[:, None] < 32, above >> np.minimum(widths, 31)[:, None], 0).astype(np.uint32)
    rows, columns = np.nonzero(high)
    starts = np.concatenate([[0], np.cumsum(_packed_bytes(widths, block_ids))]).astype(np.uint64)
    packed = np.zeros(int(starts[-1]), np.uint8)
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        for part in np.array_split(chosen, max(1, len(chosen) // 64)) if width else ():
            lines = _to_words(above[part] & np.uint32((1 << int(width)) - 1), int(width))
            packed[starts[part].astype(np.int64)[:, None] + np.arange(lines.shape[1])] = lines
    first = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.uint64)
    return minima, widths, starts, packed, first, columns.astype(np.uint16), high[rows, columns]


def write_file(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, block_ids: int = BLOCK_IDS, share: float = SHARE) -> bytes:
    """The bytes of one file."""
    minima, widths, starts, packed, first, positions, high = pack_blocks(ids, block_ids, share)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    return b"".join(
        [
            _HEADER.pack(MAGIC, block_ids, len(doc_ids), len(ids), len(minima), len(positions)),
            known.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), lengths.astype("<u4").tobytes(),
            starts.astype("<u8").tobytes(), first.astype("<u8").tobytes(), minima.astype("<u4").tobytes(),
            widths.tobytes(), positions.astype("<u2").tobytes(), high.astype("<u4").tobytes(), packed.tobytes(),
        ]
    )


class TokenFile:
    """Reads one file; blocks are unpacked when they are asked for."""

    def __init__(self, data: bytes):
        magic, self.block_ids, docs, self.n_ids, self.blocks, patches = _HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.at, self.data = _HEADER.size, data
        known = self._take("u1", docs)
        self.doc_ids = [int(d) if k else None for k, d in zip(known, self._take("<i8", docs))]
        self.lengths = self._take("<u4", docs)
        self.starts, self.first = self._take("<u8", self.blocks + 1), self._take("<u8", self.blocks + 1)
        self.minima, self.widths = self._take("<u4", self.blocks), self._take("u1", self.blocks)
        self.positions, self.high = self._take("<u2", patches), self._take("<u4", patches)
        self.packed = np.frombuffer(data, np.uint8, offset=self.at)

    def _take(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self.data, kind, n, self.at)
        self.at += out.nbytes
        return out

    def unpack(self, blocks: np.ndarray) -> np.ndarray:
        """The ids of the given blocks, one row each."""
        out = np.zeros((len(blocks), self.block_ids), np.uint32)
        widths = self.widths[blocks]
        for width in np.unique(widths):
            chosen = np.flatnonzero(widths == width)
            for part in np.array_split(chosen, max(1, len(chosen) // 64)) if width else ():
                size = int(_packed_bytes(width, self.block_ids))
                lines = self.packed[self.starts[blocks[part]].astype(np.int64)[:, None] + np.arange(size)]
                out[part] = _from_words(lines, int(width), self.block_ids)
        counts = (self.first[blocks + 1] - self.first[blocks]).astype(np.int64)
        if counts.sum():
            row = np.repeat(np.arange(len(blocks)), counts)
            offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            patch = np.repeat(self.first[blocks].astype(np.int64), counts) + offset
            out[row, self.positions[patch]] |= self.high[patch] << widths[row]
        return out + self.minima[blocks][:, None]

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids [start, stop) of the file, from the blocks that hold them."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        low = start // self.block_ids
        rows = self.unpack(np.arange(low, -(-stop // self.block_ids)))
        return rows.reshape(-1)[start - low * self.block_ids : stop - low * self.block_ids]


class WordTokenizer:
    """Whole texts to ids with a library tokenizer, a remembered word at a time.

    For a vocabulary that drops white space and never merges over it the ids of a
    text are those of its words in order. Texts with characters above U+00FF,
    where normal forms could join characters, go to the library whole.
    """

    def __init__(self, path: str, remembered: int):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # For words that are lower-case letters parted by blanks: the same model without the search for pieces.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.remembered = remembered

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", f.ids).tobytes() for f in found]

    def _letters(self, words: list[bytes]) -> None:
        """Words of letters only, many in one call: each ends in the only token with a word end."""
        for at in range(0, len(words), 500):
            chunk = words[at : at + 500]
            found = self.plain.encode_batch_fast([b" ".join(chunk).decode("latin-1")], add_special_tokens=False)[0]
            raw, start = array("I", found.ids).tobytes(), 0
            stops = (np.flatnonzero(self.ends[np.frombuffer(raw, np.uint32)]) + 1) * 4
            for word, stop in zip(chunk, stops.tolist(), strict=True):
                self.words[word] = raw[start:stop]
                start = stop

    def learn(self, missing: set[bytes]) -> None:
        """Remember the ids of words. Marks after letters are a piece of their own."""
        known, letters, tails, others, joined = self.words, set(), set(), [], []
        for word in missing:
            head = word.rstrip(MARKS)
            if head and head.decode("latin-1").isalpha():
                if head not in known:
                    letters.add(head)
                if len(head) < len(word):
                    tail = word[len(head) :]
                    joined.append((word, head, tail))
                    if tail not in known:
                        tails.add(tail)
            else:
                others.append(word)
        self._letters(list(letters))
        others += tails.difference(others)
        for word, ids in zip(others, self._library([w.decode("latin-1") for w in others])):
            known[word] = ids
        for word, head, tail in joined:
            known[word] = known[head] + known[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian u32."""
        split: list[list[bytes] | None] = []
        for text in texts:
            try:
                split.append(text.lower().encode("latin-1").split())
            except UnicodeEncodeError:
                split.append(None)
        if len(self.words) > self.remembered:
            self.words.clear()
        missing = set().union(*(s for s in split if s is not None)).difference(self.words)
        self.learn(missing)
        whole = iter(self._library([t for t, s in zip(texts, split) if s is None]))
        return [next(whole) if s is None else b"".join(map(self.words.__getitem__, s)) for s in split]


@functools.cache
def word_tokenizer(path: str, remembered: int) -> WordTokenizer:
    """One tokenizer per worker process."""
    return WordTokenizer(path, remembered)


def _open(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


def qualified(df: DataFrame, folder: str) -> str:
    """The folder with its scheme, as every executor must see it."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    conf = df.sparkSession._jsc.hadoopConfiguration()
    return path.getFileSystem(conf).makeQualified(path).toString().replace("file:/", "file:///", 1).replace("file://///", "file:///")


def write_files(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1, doc_id: str = "doc_id", text: str = "text",
    block_ids: int = BLOCK_IDS, share: float = SHARE, file_ids: int = 2_000_000, remembered: int = 600_000,
) -> DataFrame:
    """Write all documents to token files in ascending `doc_id` order; return the list of files.

    One row per file: (part, file, path, n_docs, n_ids), ordered by part, then
    file. A null text is an empty one and gives the end id alone. Null doc_ids
    come first; rows with equal doc_ids follow in the order of their texts. An
    empty table gives no file. A file is closed once it has `file_ids` ids; a task
    holds one file's ids at a time. Names are new for every attempt of a task and
    only those of the attempt that Spark commits are in the list, so a task can
    be lost and run again.
    """
    target = qualified(docs, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_tokenizer(tokenizer, remembered), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        files, root = _open(target)
        files.create_dir(root)
        names, lengths, raw, held, number = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            path = f"{root}/part-{part:06d}-{number:06d}-{uuid4().hex}.pfb"
            ids = np.frombuffer(b"".join(raw), "<u4")
            with files.open_output_stream(path) as out:
                out.write(write_file(names, np.array(lengths), ids, block_ids, share))
            return pa.RecordBatch.from_pydict(
                {"part": [part], "file": [number], "path": [path], "n_docs": [len(names)], "n_ids": [len(ids)]}
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                found = encoder.encode([t or "" for t in piece.column("_text").to_pylist()])
                for name, ids in zip(piece.column("_id").to_pylist(), found):
                    names.append(name)
                    lengths.append(len(ids) // 4 + 1)
                    raw += (ids, end)
                    held += lengths[-1]
                    if held >= file_ids:
                        yield close()
                        names, lengths, raw, held, number = [], [], [], 0, number + 1
        if names:
            yield close()

    rows = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("_text"))
    placed = rows.repartitionByRange(partitions(docs.sparkSession), "_id").sortWithinPartitions("_id", "_text")
    return stored(placed.mapInArrow(run, "part long, file long, path string, n_docs long, n_ids long"), "files")


def read_digests(files: DataFrame, folder: str) -> DataFrame:
    """Per document of the listed files: doc_id, start (ids of all documents before), n_tokens, ids_crc32.

    Each file is read by one task; only the list of files, a row each, is summed in order.
    """
    target = qualified(files, folder)
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    listed = files.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, _ = _open(target)
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                with source.open_input_stream(path) as data:
                    file = TokenFile(data.read())
                ids = file.slice(0, file.n_ids).astype("<u4")
                stops = np.cumsum(file.lengths.astype(np.int64))
                starts = stops - file.lengths
                raw = memoryview(ids.tobytes())
                sums = [zlib.crc32(raw[a * 4 : b * 4]) for a, b in zip(starts.tolist(), stops.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.doc_ids, pa.int64()), pa.array(starts + first), pa.array(file.lengths.astype("i8")), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    spread = listed.select("path", "first").repartition(partitions(files.sparkSession), "path")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write token files to a new shared folder and return the digests read back from them."""
    folder = scratch(docs.sparkSession, "token-files")
    return read_digests(write_files(docs, tokenizer, folder, **options), folder)
