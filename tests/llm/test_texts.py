"""Encoding, token files, repeated bytes, line templates, mixing and the pipeline, against brute force."""

import base64
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from compare import compare, connect

import corpus_pipeline
from brightloom.llm import bpe, mixing, substrings, templates, tokenfile
from brightloom.llm.queries import PLANS
from brightloom.llm.shared import stored

SF_DIR = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def encoder():
    return bpe.text_encoder(RANKS, public_tokenizers.PATTERN, 500_000)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_of_odd_texts(encoder, library):
    rnd = random.Random(1)
    letters = "ab  \n\t\r'std.,!0123éñü \x1c\x1f\x85\xa0 漢字かなabв🙂ⅷ²́ ​　﻿"
    for _ in range(10_000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40)))
        ids = encoder.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_bpe_of_batches(library):
    rnd = random.Random(3)
    syllables = ["an", "der", "é", "ция", "漢", "***", "'s", "12", "\n", ".", "🙂", "x" * 70]
    words = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(0, 6))) for _ in range(4_000)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))) for _ in range(2_000)] + ["", " ", "x" * 9_000]
    # A memory that is cleared between batches gives the same ids as one that holds all words.
    for remembered, together in ((500_000, 4_000_000), (50, 300)):
        found = bpe.TextEncoder(RANKS, public_tokenizers.PATTERN, remembered).encode_many(texts, together)
        assert [f.tolist() for f in found] == list(map(library.encode_ordinary, texts))


def test_bpe_shared_slots_and_groups(library, monkeypatch):
    monkeypatch.setattr(bpe, "SLOTS", 4)
    monkeypatch.setattr(bpe, "AT_ONCE", 64)
    rnd = random.Random(4)
    texts = [" ".join("".join(rnd.choice("aeiounrstl") for _ in range(rnd.randint(3, 20))) for _ in range(50)) for _ in range(50)]
    found = bpe.TextEncoder(RANKS, public_tokenizers.PATTERN, 500_000).encode_many(texts)
    assert [f.tolist() for f in found] == list(map(library.encode_ordinary, texts))


def test_bpe_appends_and_edits(encoder):
    rnd, own = random.Random(2), encoder.encoder
    for _ in range(500):
        text = bytes(rnd.choice(b"aabeinrst ") for _ in range(150))
        last = own.prefixes(text)
        more = bytes(rnd.choice(b"abei ") for _ in range(rnd.randint(0, 20)))
        assert own.prefixes(text + more, last) == own.prefixes(text + more)
        start = rnd.randint(0, len(text))
        changed, fresh = own.edited(text, last, start, min(len(text), start + rnd.randint(0, 5)), more)
        assert fresh == own.prefixes(changed)
        assert b"".join(own.bytes_of[i] for i in own.read_back(fresh)) == changed


def test_bpe_of_documents(spark, library):
    long = "word " * 40_000 + "x" * 50_000
    extra = spark.createDataFrame([(None, None), (5, ""), (5, ""), (6, long)], "doc_id long, text string")
    rows = documents(spark).select("doc_id", "text").union(extra).selectExpr("*", "1 as _doc", "'x' as ids")
    found = bpe.encode_digests(rows, RANKS, public_tokenizers.PATTERN).collect()
    expected = []
    for r in rows.collect():
        ids = library.encode_ordinary(r["text"] or "")
        texts = (",".join(map(str, ids)), r["text"] or "")
        expected.append((r["doc_id"], len(ids), *[hashlib.sha256(t.encode()).hexdigest() for t in texts]))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    encoded = bpe.decode(bpe.encode(rows, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert encoded.filter("decoded <> cast(coalesce(text, '') as binary)").count() == 0
    assert bpe.encode_digests(rows.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_blocks():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 64, 65, 1000):
        for high in (1, 2, 300, 50_000, 1 << 32):
            ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
            if n:
                ids[rng.integers(0, n, n // 20)] = 2**32 - 1
            file = tokenfile.TokenFile(tokenfile.write_file([None, 7], np.array([n, 0]), ids, block_ids=64))
            assert (file.slice(0, n) == ids).all() and file.doc_ids == [None, 7]
            assert (file.slice(n // 3, n // 2) == ids[n // 3 : n // 2]).all()
    with pytest.raises(ValueError):
        tokenfile.TokenFile(b"XXXX" + bytes(60))


def test_token_files(spark):
    odd = [(None, None), (3, "Ünï \x85x\xa0y 漢字 it's"), (3, "Ünï \x85x\xa0y 漢字 it's"), (-4, ""), (10**9, "b " * 30_000)]
    extra = spark.createDataFrame(odd, "doc_id long, text string")
    rows = documents(spark).select("doc_id", "text").union(extra).selectExpr("*", "1 as part", "2 as _id")
    found = tokenfile.round_trip(rows, WORDS, file_ids=20_000).collect()
    tokenizer = tokenfile.word_tokenizer(WORDS, 600_000).tokenizer
    start, expected = 0, []
    for doc_id, text in sorted(((r["doc_id"], r["text"] or "") for r in rows.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    assert tokenfile.round_trip(rows.limit(0), WORDS).count() == 0


def without_repeats(rows, window=50):
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - window + 1):
            if doc_id is not None:
                first[data[p : p + window]] = min(doc_id, first.get(data[p : p + window], doc_id))
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - window + 1):
            least = first.get(data[p : p + window])
            if least is not None and (doc_id is None or least < doc_id):
                gone[p : p + window] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        yield doc_id, len(data), int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum()), hashlib.sha256(kept).hexdigest()


def test_repeated_bytes(spark):
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    passages = [" ".join(rnd.choice(words) for _ in range(rnd.randint(5, 60))) for _ in range(12)]
    rows = []
    for i in range(150):
        text = rnd.choice(passages)
        if rnd.random() < 0.6:
            a = rnd.randint(0, len(text))
            text = text[a : rnd.randint(a, len(text))] + rnd.choice(["", "zq", "é", "\0"]) + rnd.choice(passages)[rnd.randint(0, 40) :]
        text = "ab" * rnd.randint(0, 120) if rnd.random() < 0.1 else text
        rows.append((rnd.choice([i, i, i, 7, None]), text if rnd.random() > 0.03 else None))
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, chunk int, bucket int")
    found = substrings.remove_repeats(df, chunk_bytes=3000, batch=64).drop("kept").collect()
    assert sorted(map(tuple, found), key=str) == sorted(without_repeats(rows), key=str)
    assert substrings.remove_repeats(df.limit(0)).count() == 0


def test_repeated_bytes_of_documents(spark):
    docs = documents(spark).repartition(3)
    found = substrings.remove_repeats(docs, chunk_bytes=100_000).drop("kept").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, found)) == sorted(without_repeats(rows))


def test_suffix_family_levels():
    rng = np.random.default_rng(6)
    strings = rng.integers(97, 100, (5000, 6), dtype=np.uint8).view("S6").reshape(-1)
    docs = rng.integers(0, 1000, 5000)
    expected = defaultdict(lambda: 10**9)
    for s, d in zip(strings.tolist(), docs.tolist()):
        expected[s] = min(expected[s], d)
    found = substrings.earliest(strings, docs, 64)
    assert [f < d for f, d in zip(found, docs)] == [expected[s] < d for s, d in zip(strings.tolist(), docs.tolist())]
    family = substrings.SuffixFamily()
    for i in range(0, 5000, 100):
        family.add(np.arange(i, i + 100).astype("S8"), np.arange(100))
    sizes = [len(level[0]) for level in family.levels]
    assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:])) and sum(sizes) == 5000


def dropped_lines(rows):
    """Masked lines of recurring templates with their first document, leaf by leaf in sorted order."""
    lines, leaves, found = defaultdict(set), defaultdict(list), {}
    for doc_id, text in rows:
        for line in (text or "").encode().split(b"\n"):
            if words := templates.masked(line):
                lines[b" ".join(words)].add(doc_id)
    for line in sorted(lines):
        words = line.split(b" ")
        leaves[(len(words), *words[:3], words[-1])].append(words)
    for members in leaves.values():
        trees = []
        for words in members:
            same = [sum(a == b for a, b in zip(t[0], words)) for t in trees]
            if same and max(same) >= 0.8 * len(words):
                tree = trees[same.index(max(same))]
                tree[0] = [a if a == b else b"<*>" for a, b in zip(tree[0], words)]
            else:
                trees.append(tree := [words, [], set()])
            tree[1].append(b" ".join(words))
            tree[2] |= lines[b" ".join(words)]
        found |= {line: min(t[2]) for t in trees if len(t[2]) >= 3 for line in t[1]}
    return found


def test_line_templates(spark):
    rnd = random.Random(7)
    boiler = [["Page", "number", str(i), "of", "the", "report", "by", w, "and", "others"] for i in range(9) for w in ("Ann", "Bo", "Cy")]
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    rows += [(1000 + i, "\n".join(" ".join(rnd.choice(boiler)) for _ in range(3)) + f"\n\n own line {'x' * i} here") for i in range(60)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, key string, drops int")
    drops = dropped_lines(rows)
    expected = {
        d: "\n".join(x for x in t.split("\n") if drops.get(b" ".join(templates.masked(x.encode())), d) == d) for d, t in rows
    }
    got = templates.dedup_lines(df, held_bytes=5000)
    assert got.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == expected
    assert len(drops) > 20


def test_line_template_edges(spark):
    rows = [(1, "a b c d\n\nx 1 y"), (2, "a b c d\nx 2 y"), (3, "x 3 y\nother"), (3, "x 3 y\nother"), (None, "a b c d"), (4, None), (5, "")]
    df = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "doc_id long, text string, doc int, key int, digest string")
    found = templates.dedup_lines(df, counts=True).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(1, 3, 0, "a b c d\n\nx 1 y"), (2, 2, 2, ""), (3, 2, 1, "other"), (3, 2, 1, "other"), (None, 1, 1, ""), (4, 0, 0, None), (5, 1, 0, "")], key=str
    )
    assert templates.dedup_lines(df.limit(0)).count() == 0


def test_mix_edges(spark):
    rows = [(i, "w " * (i % 7), f"s{i % 3}") for i in range(60)] + [(70, "a b c", None), (70, "a b c", None), (None, "x\x0by z", "s0"), (71, None, "s1"), (72, "l " * 50_000, "s9"), (73, "", "e")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, source string, row int, key string")
    found = mixing.mix_counts(df, block_words=7).collect()
    assert len(found) == len(rows)
    total = sum(r["size"] for r in found)
    by_source = {(r["source_size"], r["target"]) for r in found}
    assert total == sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows)
    assert sum(t for _, t in by_source) == pytest.approx(1.5 * total)
    assert all(t <= 2 * s for s, t in by_source) and all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    for goal in by_source:
        assert sum(r["taken"] for r in found if (r["source_size"], r["target"]) == goal) == int(goal[1])
    mixed = mixing.mix(df, block_words=7)
    assert mixed.columns == df.columns
    words = sum(len((r["text"] or "").split()) for r in mixed.collect())
    assert words == sum(r["taken"] for r in found)
    assert mixing.mix_counts(df.limit(0)).count() == 0 == mixing.mix(df.limit(0)).count()


def test_schedule_keeps_shares(spark):
    goals = spark.createDataFrame([("0a", 10_000, 9000.0), ("0b", 5000, 10_000.0), ("0c", 900, 50.0)], "key string, source_size long, target double")
    slots = sorted(map(tuple, mixing.schedule(goals, 10).collect()))
    assert len({s[0] for s in slots}) == len(slots)
    share = [sum(s[1] == "0a" for s in slots[i : i + 100]) for i in range(0, 1800, 100)]
    assert all(abs(n - 900 / 19.05 ) < 5 for n in share)
    assert sum(s[5] - s[4] for s in slots if s[1] == "0b") == 10_000


def test_positions_of_many_equal_sources(spark):
    goals = spark.createDataFrame([(f"0{c}", 1000, 1000.0) for c in "abcdefg"], "key string, source_size long, target double")
    slots = mixing.schedule(goals, 10).collect()
    assert len(slots) == len({r["position"] for r in slots}) == 700


def test_mix_blocks(spark):
    rnd = random.Random(5)
    rows = [(i, " ".join(f"{i}_{n}" for n in range(rnd.randint(0, 60))), "a" if i % 3 else "b", "p") for i in range(300)]
    rows += [(None, " ".join(f"n{i}_{n}" for n in range(9)), "b", "p") for i in range(50)] + [(900, None, "a", "p"), (901, " ".join(f"901_{n}" for n in range(5000)), None, "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, position string")
    blocks = mixing.mix_blocks(df, block_words=16).orderBy("position").collect()
    # Together the blocks hold of each document what the counts say; each block holds words of one source only.
    taken = defaultdict(int)
    for r in blocks:
        own = r["text"].split(" ")
        assert [w.split("_")[1] for w in own] == [str(r["first_word"] + n) for n in range(len(own))]
        taken[own[0].split("_")[0]] += len(own)
    counted = {str(r["doc_id"]): r["taken"] for r in mixing.mix_counts(df, block_words=16).collect() if r["doc_id"] is not None and r["taken"]}
    assert {d: n for d, n in taken.items() if d[0] != "n"} == counted
    words_at, source_at = defaultdict(int), defaultdict(set)
    for r in blocks:
        words_at[r["position"]] += len(r["text"].split(" "))
        source_at[r["position"]].add(r["source"])
    assert max(words_at.values()) == 16 and all(len(s) == 1 for s in source_at.values())
    # Every stretch of the real output holds each source near its share.
    order = [source_at[p].pop() for p in sorted(source_at)]
    for name in ("a", "b", None):
        share = order.count(name) / len(order)
        assert all(abs(order[i : i + 100].count(name) - 100 * share) < 6 for i in range(0, len(order) - 100, 50))
    # Other file splits and row orders give the same blocks.
    again = mixing.mix_blocks(df.repartition(7, "text"), block_words=16).collect()
    assert sorted(map(str, again)) == sorted(map(str, blocks))
    assert mixing.mix_blocks(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", [n for n, (_, sql) in PLANS.items() if sql])
def test_sql(spark, name):
    ok, note = compare(spark, connect(SF_DIR), *PLANS[name], SF_DIR)
    assert ok, note


def test_pipeline_stages(spark, library):
    docs = documents(spark)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "mix_sources", "byte_bpe"]
    columns = docs.columns
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        results.append(stored(stage(spark, results[-1], SF_DIR), name))
    good, lines, single, mixed, encoded = results[1:]
    assert all(r.columns == columns for r in results[1:5])
    before = {r["doc_id"]: r["text"].split("\n") for r in docs.collect()}
    assert all(set(r["text"].split("\n")) <= set(before[r["doc_id"]]) and r["n_chars"] == len(r["text"]) for r in good.collect())
    drops = dropped_lines([(r["doc_id"], r["text"]) for r in good.collect()])
    for r in lines.collect():
        assert r["n_chars"] == len(r["text"])
        assert all(drops.get(b" ".join(templates.masked(x.encode())), r["doc_id"]) == r["doc_id"] for x in r["text"].split("\n"))
    assert single.count() == single.select("doc_id").distinct().count() <= lines.count()
    texts = sorted((r["doc_id"], r["text"]) for r in mixed.collect())
    ids = sorted((r["doc_id"], r["ids"]) for r in encoded.collect())
    assert sorted((d, library.encode_ordinary(t)) for d, t in texts) == ids
    assert encoded.filter("text_sha256 <> decoded_sha256").count() == 0
    assert corpus_pipeline.run(spark, SF_DIR).count() == encoded.count()
