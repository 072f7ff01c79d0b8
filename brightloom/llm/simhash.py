"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint has eight bytes. Two fingerprints that differ in at most three bits
share at least five bytes at the same positions. The index posts a fingerprint
under the bytes at three positions, for every three of the first four positions
and every three of the last four: whichever five positions a pair shares, three
of them lie in one half, so no pair is missed. Fingerprints that meet under a key
are tallied, those with five shared positional bytes or more are kept, and the
kept pairs are verified by their differing bits.

A key that very many different fingerprints share is posted again under five
bytes, two more positions in every way (a pair in reach still shares five), and
what is still large then is cut into blocks that meet in pairs. Only links that
join something new are written, so a group of n near copies gives about n links
and not n * n.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.components import components
from brightloom.llm.shared import partitions, stored

BYTES = 8
THREES = [t for half in ((0, 1, 2, 3), (4, 5, 6, 7)) for t in combinations(half, 3)]
FIVES = [(t, two) for t in THREES for two in combinations([p for p in range(BYTES) if p not in t], 2)]


def shingle_hashes(text: bytes, words: int, seed: int = 42) -> list[int]:
    """64-bit hashes of the word shingles in order, repeats included; a shorter text is one, one without words has none."""
    found = text.lower().split()  # of bytes: A-Z only, parted by the six ASCII blanks
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(joined, seed)]
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate([[0], ends[: -words]]).tolist()
    stops = (ends[words - 1 :] - 1).tolist()
    one = xxhash.xxh64_intdigest
    return [one(joined[a:b], seed) for a, b in zip(starts, stops)]


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """The SimHash of one text by its word shingles, repeats included; without words 0."""
    hashes = shingle_hashes(text, words, seed)
    if not hashes:
        return 0
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = np.array(hashes[at : at + 65_536], "<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 3, name: str = "fingerprint") -> DataFrame:
    """`docs` with the fingerprint of each whole text as a signed long; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint((t.as_py() or "").encode(), words) for t in batch.column("_text")]
            column = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), column], names=["_doc", "_fp"])

    kept = [c for c in docs.columns if c not in (text, name)] or [text]
    packed = docs.select(F.struct(*kept).alias("_doc"), F.col(text).alias("_text"))
    kind = packed.schema["_doc"].dataType.simpleString()
    return packed.mapInArrow(run, f"_doc {kind}, _fp long").select("_doc.*", F.col("_fp").alias(name))


def _bytes_at(value: Column, positions: tuple[int, ...]) -> Column:
    out = F.lit(0).cast("long")
    for p in positions:
        out = F.shiftleft(out, 8).bitwiseOR(F.shiftrightunsigned(value, 8 * p).bitwiseAND(F.lit(255)))
    return out


def _keys(value: Column, sets: list[tuple[int, ...]]) -> Column:
    """One long per set of positions: the number of the set, then the bytes there."""
    size = 8 * len(sets[0])
    return F.array(*[_bytes_at(value, s).bitwiseOR(F.lit(i << size)) for i, s in enumerate(sets)])


def verified_links(values: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that join the fingerprints of one posting list into its linked groups."""
    n, least = len(values), BYTES - bits
    label = np.arange(n)
    links = []
    octets = values.view(np.uint8).reshape(n, BYTES)
    for shift in range(1, n):
        apart = np.flatnonzero(label[shift:] != label[:-shift])
        if not len(apart):
            continue
        tally = (octets[apart] == octets[apart + shift]).sum(axis=1)
        apart = apart[tally >= least]
        close = apart[np.bitwise_count(values[apart] ^ values[apart + shift]) <= bits]
        for i in close.tolist():
            a, b = label[i], label[i + shift]
            if a != b:
                label[label == max(a, b)] = min(a, b)
                links.append((int(values[i]), int(values[i + shift])))
    return links


def _link_runs(posted: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """(src, dst) from rows sorted by key inside their partition; holds one posting list at a time."""

    def out(links: list[tuple[int, int]]) -> pa.RecordBatch:
        pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["src", "dst"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []
        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            values = batch.column("fp").to_numpy().view(np.uint64)
            if not len(values):
                continue
            change = np.zeros(len(values) - 1, bool)
            for c in columns:
                change |= c[1:] != c[:-1]
            starts = np.concatenate([[0], np.flatnonzero(change) + 1])
            stops = np.concatenate([starts[1:], [len(values)]])
            links = []
            # Runs of one, but for the first and last of a batch, meet nobody.
            alone = (stops - starts == 1) & (starts > 0) & (stops < len(values))
            for a, b in zip(starts[~alone].tolist(), stops[~alone].tolist()):
                key = tuple(c[a] for c in columns)
                if key != held_key:
                    if held and sum(map(len, held)) > 1:
                        links += verified_links(np.concatenate(held), bits)
                    held_key, held = key, []
                held.append(values[a:b])
            yield out(links)
        if held and sum(map(len, held)) > 1:
            yield out(verified_links(np.concatenate(held), bits))

    n = partitions(posted.sparkSession)
    placed = posted.repartition(n, *keys).sortWithinPartitions(*keys)
    return placed.select(*keys, "fp").mapInArrow(run, "src long, dst long")


def links(prints: DataFrame, bits: int = 3, most: int = 2048) -> DataFrame:
    """(src, dst): links among the different fingerprints in `fp` that join all linked groups.

    `bits` is at most 3, which the positions of the index are chosen for. `most`
    bounds what one task compares at once; longer posting lists are posted anew
    or cut, and nothing is left out.
    """
    if not 0 <= bits <= 3:
        raise ValueError("bits must be 0 to 3")
    posted = prints.select("fp", F.explode(_keys(F.col("fp"), THREES)).alias("key"))
    crowded = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select("key")
    crowded = stored(crowded, "crowded")
    usual = _link_runs(posted.join(crowded, "key", "left_anti"), ["key"], bits)

    again = posted.join(crowded, "key", "left_semi").select(
        "fp", F.shiftright("key", 24).alias("three"),
    )
    fives = F.array(*[
        F.struct(F.lit(THREES.index(t)).alias("three"), _bytes_at(F.col("fp"), t + two).bitwiseOR(F.lit(i << 40)).alias("key"))
        for i, (t, two) in enumerate(FIVES)
    ])
    wide = stored(
        again.select("fp", F.explode(F.filter(fives, lambda s: s["three"] == F.col("three"))).alias("s")).select("fp", "s.key"),
        "wide",
    )
    sizes = wide.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    blocks = F.ceil(F.col("n") / most).cast("long")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    met = wide.join(sizes.select("key", blocks.alias("blocks")), "key").withColumn("own", own)
    pairs = met.select(
        "fp", "key", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    ).select("fp", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    return usual.union(_link_runs(pairs, ["key", "low", "high"], bits))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 3) -> DataFrame:
    """Per row: doc_id, fingerprint (16 lowercase hex digits) and component_id.

    The component is the smallest doc_id that is reachable over links of at most
    `bits` differing bits, the row's own included. Empty, blank and null texts
    have fingerprint zero and are linked like any other. Repeated rows stay rows
    and share a component; null doc_ids are never the smallest, and a component
    of such rows only has a null id. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    rows = stored(fingerprints(rows, "_text", name="fp"), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    grouped = components(links(prints, bits))
    rooted = prints.join(grouped, prints["fp"] == grouped["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 3) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns: that of the smallest doc_id.

    Of rows with this doc_id one stays; rows without a doc_id stay only where no
    row of the group has one, and then one of them.
    """
    number = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "hash")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("hash"), F.col(text).alias("_text"))
    rows = stored(fingerprints(rows, "_text", name="fp").select(number.alias("row"), "fp"), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("row").alias("least")), "prints")
    grouped = components(links(prints, bits))
    rooted = prints.join(grouped, prints["fp"] == grouped["node"], "left")
    kept = rooted.groupBy(F.coalesce("root", "fp")).agg(F.min("least").alias("row")).select("row.*")
    packed = docs.select(
        F.struct(*docs.columns).alias("_doc"), F.col(doc_id).isNull().alias("none"),
        F.coalesce(F.col(doc_id), F.lit(0)).alias("id"), F.xxhash64(text).alias("hash"),
    )
    keys = ["none", "id", "hash"]
    return packed.join(kept, keys, "left_semi").dropDuplicates(keys).select("_doc.*")
