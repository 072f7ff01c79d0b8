"""Collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np

from brightloom.llm import phrases


def brute(rows, least, top, longest=5):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    key = (lang, tuple(words[i : i + k]))
                    counts[key] = counts.get(key, 0) + 1
    candidates = {key: n for key, n in counts.items() if len(key[1]) > 1 and n >= least}
    best = {}
    for (lang, words), a in candidates.items():
        inside = any(
            other[0] == lang and len(other[1]) > len(words) and n >= a
            and any(other[1][i : i + len(words)] == words for i in range(len(other[1]) - len(words) + 1))
            for other, n in candidates.items()
        )
        if inside:
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * sizes[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        best.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, sizes[lang], -score)
        for lang, rows in best.items() for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1)
    )


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "w") for r in rows], "lang string, text string, n long, word string")


def test_collocations_equal_brute_force(spark):
    rnd = random.Random(6)
    vocabulary = ["new", "York", "city", "é", "x" * 50, "the", "of", "NEW", "漢字", "a\x1cb", "a\xa0b"]
    rows = []
    for i in range(400):
        words = rnd.choices(vocabulary, weights=[9, 8, 5, 2, 1, 20, 10, 3, 2, 1, 1], k=rnd.randint(0, 40))
        seps = rnd.choices([" ", "\t ", ". ", ",", "\n", "\r\n", "\x0b", "\x0c?"], weights=[30, 5, 2, 2, 1, 1, 1, 1], k=len(words))
        rows.append((rnd.choice(["en", "en", "en", "fr", None, "und"]), "".join(w + s for w, s in zip(words, seps))))
    rows += [("en", None), ("en", ""), ("en", " .. "), ("de", "to be or not to be " * 900)] * 2
    for options in ({}, {"chunk_words": 37, "tile": 4}):
        found = phrases.collocations(frame(spark, rows).repartition(3), least=20, top=50, **options).collect()
        assert sorted(map(tuple, found)) == brute(rows, 20, 50)
    assert phrases.collocations(frame(spark, rows[:3])).count() == 0
    assert phrases.collocations(frame(spark, rows).limit(0)).count() == 0


def test_a_long_text_is_sliced(spark, monkeypatch):
    rnd = random.Random(7)
    text = " ".join(rnd.choices("ab cd ef gh. ij", k=3000)) + "z" * 5000 + " ab cd" * 200
    monkeypatch.setattr(phrases, "SLICE", 100)
    assert b"".join(phrases._slices(text.encode())) == text.encode()
    whole = phrases.tokens(text.encode())
    assert [w for part in phrases._slices(text.encode()) for w in phrases.tokens(part)] == whole


def test_packed_columns():
    rng = np.random.default_rng(9)
    for size in (0, 1, 1000):
        columns = [rng.integers(-5, 1 << 40, size) for _ in range(3)]
        assert all((x == y).all() for x, y in zip(columns, phrases.unpacked(phrases.packed(*columns))))


def test_tiles_count_pairs():
    rng = np.random.default_rng(8)
    for high, tile in ((6, 4), (500, 16), (1 << 45, 256), (3, 1 << 8)):
        symbols = np.minimum(rng.integers(-1, high, 5000), rng.integers(-1, high, 5000))
        numbers, a, b, n = phrases.count_pairs(symbols, tile)
        expected = Counter((x, y) for x, y in zip(symbols.tolist(), symbols[1:].tolist()) if x >= 0 and y >= 0)
        assert dict(zip(zip(a.tolist(), b.tolist()), n.tolist())) == expected
        for at, number in enumerate(numbers.tolist()):
            pair = (symbols[at], symbols[at + 1])
            assert (number < 0) == (min(pair) < 0) and (number < 0 or (a[number], b[number]) == pair)


def test_products_pass_64_bits(spark):
    from pyspark.sql import functions as F

    big = 4 * 10**12
    row = spark.range(1).select(phrases._score(F.lit(big), F.lit(3 * 10**13), F.lit(big + 1), F.lit(big + 7)).alias("s")).first()
    assert row["s"] == 1000 * big * 3 * 10**13 // ((big + 1) * (big + 7))
