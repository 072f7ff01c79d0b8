"""Near-duplicates of texts and vectors, and components, against brute force."""

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from brightloom.llm import simhash, vectors
from brightloom.llm.components import components

DOCUMENTS = "/root/testdata/sf0.001/documents.parquet"


def groups(n, links):
    """Smallest index of each index's linked group."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (240, 2))] + [(1000 + i, 1001 + i) for i in range(70)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "src long, dst long")).collect()}
    expected = groups(1100, links)
    assert found == {x: expected[x] for x in range(1100) if expected[x] != x}
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


def shingle_print(text):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_of_documents(spark):
    docs = spark.read.parquet(DOCUMENTS)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    prints = [shingle_print(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    roots = groups(len(rows), links)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert found == {d: (f"{p:016x}", rows[root][0]) for (d, _), p, root in zip(rows, prints, roots)}
    kept = simhash.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in found.values()})
    assert kept.columns == docs.columns


def test_simhash_edges(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, "A b  c"), (2, "a B\tc"), (2, "a B\tc"), (3, None), (4, ""), (5, " \n"), (None, "one two"), (7, "one"), (8, long)]
    df = spark.createDataFrame([(d, t, 1, 2, "x") for d, t in rows], "doc_id long, text string, fp long, row long, key string")
    found = simhash.near_duplicates(df).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["component_id"] == by_id[2]["component_id"] == 1
    assert [by_id[i]["component_id"] for i in (3, 4, 5)] == [3, 3, 3] and by_id[4]["fingerprint"] == "0" * 16
    assert by_id[None]["component_id"] is None
    assert by_id[8]["fingerprint"] == f"{shingle_print(long):016x}"
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "7", "8", "None"]
    assert simhash.near_duplicates(df.limit(0)).count() == 0 == simhash.keep_one(df.limit(0)).count()


def test_crowded_posting_lists_lose_nothing(spark):
    rng = np.random.default_rng(2)
    centre = int(rng.integers(0, 1 << 62))
    values = {centre ^ (1 << i) ^ (1 << j) for i in range(63) for j in range(0, i, 3)} | {int(v) for v in rng.integers(0, 1 << 62, 200)}
    df = spark.createDataFrame([(v,) for v in sorted(values)], "fp long")
    wide, narrow = ({(r["node"], r["root"]) for r in components(simhash.links(df, 3, most)).collect()} for most in (4096, 16))
    assert wide == narrow and len(wide) > 500
    with pytest.raises(ValueError):
        simhash.links(df, 4)


def test_near_dedup_stage_is_the_simhash_operator(spark):
    docs = spark.read.parquet(DOCUMENTS)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    components = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(components)
