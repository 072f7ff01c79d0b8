"""Repeated bytes: buckets that grow in number with the input, and anchors matched some at a time."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from brightloom.llm import substrings


def test_more_input_has_more_buckets(spark, monkeypatch):
    """No bucket outgrows its size, inside a chunk and between chunks; the result does not depend on it."""
    rnd = random.Random(8)
    passages = ["".join(rnd.choice("abcdefgh ") for _ in range(200)) for _ in range(8)]
    rows = [(i, rnd.choice(passages) + str(i) * 30 + rnd.choice(passages)[rnd.randint(0, 99) :]) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk_bytes in (3_000, 1_000_000):
        expected = sorted(map(tuple, substrings.remove_repeats(df, chunk_bytes=chunk_bytes).collect()))
        asked, plain = [], substrings._candidates
        with monkeypatch.context() as patch:
            patch.setattr(substrings, "BUCKET_KEYS", 40)
            patch.setattr(substrings, "BUCKET_SEGMENTS", 20)
            patch.setattr(substrings, "_candidates", lambda *a: (asked.append(a[3:]), plain(*a))[1])
            found = substrings.remove_repeats(df, chunk_bytes=chunk_bytes).collect()
        assert sorted(map(tuple, found)) == expected
        assert asked[0][0] > 4 and asked[0][1] > 4 * 4


def test_only_some_windows_of_a_bucket_are_held():
    """Of many anchors with different segments: all windows together would be 14 times the strings."""
    rng, window, n = np.random.default_rng(9), 50, 60_000
    width = 2 * window - substrings.GRAM
    strings = rng.integers(97, 123, (n, width + 1), dtype=np.uint8)
    strings[:, width] = width
    strings[1::2, 60] = 65
    strings[1::2, :60] = strings[::2, :60]  # the first windows of every second segment are those of the one before
    columns = {
        "anchor": np.repeat(np.arange(n // 2), 2).astype("<u8"), "doc": np.arange(n).astype("<i8"),
        "place": (np.arange(n) * width).astype("<i8"), "string": strings,
    }
    packed = {name: pa.array([substrings._packed(np.ascontiguousarray(v))], pa.binary()) for name, v in columns.items()}
    table = pa.table({"bucket": pa.array([0], pa.int32()), "chunk": pa.array([5], pa.int64())} | packed)
    tracemalloc.start()
    found = substrings.bucket_matches(table, window, 10_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    low, high = np.frombuffer(found.column("spans")[0].as_py(), "<i8").reshape(2, -1)
    assert found.column("chunk").to_pylist() == [5]
    assert len(low) == n // 2 * 11 and set((high - low).tolist()) == {window}
    assert set((low // width % 2).tolist()) == {1}
    assert peak < 15 * strings.nbytes
