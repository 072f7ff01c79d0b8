"""Weights and recommendations against plain numpy on a small catalogue."""

import math
import re
from collections import Counter

import pytest

from brightloom.functions import text
from brightloom.functions.words import ENGLISH_STOP_WORDS
from brightloom.operators import similarity

STOP = ["the", "of"]
ROWS = [
    (1, "Space One", "Drama", "the space of stars and space travel", 2001.0, 8.0),
    (2, "Space Two", "Drama", "space travel among stars", 2005.0, 7.0),
    (3, "space two", "Comedy", "space travel among stars", 2005.0, 9.0),
    (4, "Kitchen", "Comedy", "cooking pasta", None, 5.0),
    (5, "Garden", "Drama", "roses growing", 1990.0, None),
    (6, "Garden!", "Drama", "planting trees", 1995.0, 6.0),
    (7, "Stars", "Drama", "stars stars stars", 2010.0, 6.5),
]


@pytest.fixture(scope="module")
def catalogue(spark):
    return spark.createDataFrame(
        [(i, t, g, y, r, f"{g} {body}") for i, t, g, body, y, r in ROWS],
        "movie_id long, title string, genres string, release_year double, rating double, tags string",
    )


def brute_weights(docs, max_features=10_000):
    grams = {}
    for key, body in docs.items():
        words = [w for w in re.findall(r"\b\w\w+\b", body.lower()) if w not in STOP]
        grams[key] = Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    total, df = Counter(), Counter()
    for counts in grams.values():
        total.update(counts)
        df.update(counts.keys())
    kept = set(sorted(total, key=lambda t: (-total[t], t))[:max_features])
    weights = {}
    for key, counts in grams.items():
        raw = {t: (1 + math.log(c)) * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, c in counts.items() if t in kept}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        weights[key] = {t: w / norm for t, w in raw.items()}
    return weights


def brute_recommend(weights, source, n, keep=lambda row: True):
    def key(title):
        return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", title.lower().strip()))

    scored = []
    for row in ROWS:
        if row[0] != source and keep(row):
            dot = sum(w * weights[row[0]].get(t, 0.0) for t, w in weights[source].items())
            scored.append((-round(dot, 12), row[0], key(row[1])))
    seen, out = set(), []
    for score, movie, title in sorted(scored):
        if title not in seen and len(out) < n:
            seen.add(title)
            out.append((movie, -score))
    return out


@pytest.mark.parametrize("max_features", [10_000, 9])
def test_weights(spark, catalogue, max_features):
    docs = catalogue.selectExpr("movie_id AS id", "tags")
    got = {(r["id"], r["term"]): r["weight"] for r in similarity.tfidf(docs, STOP, max_features).collect()}
    want = brute_weights({r["id"]: r["tags"] for r in docs.collect()}, max_features)
    flat = {(i, t): w for i, terms in want.items() for t, w in terms.items()}
    assert got.keys() == flat.keys()
    assert all(abs(got[k] - flat[k]) < 1e-9 for k in flat)


@pytest.mark.parametrize("n", [1, 3, 10])
def test_recommend_with_and_without_shared_terms(spark, catalogue, n):
    weights = similarity.tfidf(catalogue.selectExpr("movie_id AS id", "tags"), STOP)
    plain = brute_weights({r["movie_id"]: r["tags"] for r in catalogue.collect()})
    queries = spark.createDataFrame([(i,) for i in (1, 4, 5)], "source_id long")
    got = similarity.recommend(catalogue, weights, queries, n).orderBy("source_id", "rank").collect()
    for source in (1, 4, 5):
        rows = [(r["movie_id"], round(r["similarity"], 9)) for r in got if r["source_id"] == source]
        assert rows == [(m, round(s, 9)) for m, s in brute_recommend(plain, source, n)]


def test_filters_and_details(spark, catalogue):
    weights = similarity.tfidf(catalogue.selectExpr("movie_id AS id", "tags"), STOP)
    plain = brute_weights({r["movie_id"]: r["tags"] for r in catalogue.collect()})
    queries = spark.createDataFrame([(1,)], "source_id long")
    got = similarity.recommend(catalogue, weights, queries, 5, genre="drama", min_year=1995, max_year=2009, min_rating=6).collect()
    keep = lambda row: row[2] == "Drama" and row[4] and 1995 <= row[4] <= 2009 and row[5] and row[5] >= 6
    assert sorted(r["movie_id"] for r in got) == sorted(m for m, _ in brute_recommend(plain, 1, 5, keep))
    two = next(r for r in got if r["movie_id"] == 2)
    assert two["explanation"] == "Shares metadata terms: travel, Drama, space, stars"
    everything = similarity.recommend(catalogue, weights, queries, 9).collect()
    kitchen = next(r for r in everything if r["movie_id"] == 4)
    assert (kitchen["year_text"], kitchen["explanation"]) == ("Unknown", similarity.NO_SHARED_TERMS)
    with pytest.raises(ValueError):
        similarity.recommend(catalogue, weights, queries, 0)


def test_titles(spark, catalogue):
    liked = spark.createDataFrame([("SPACE  two",), ("garden",), ("nothing",)], "title string")
    found = {r["title"]: r["source_id"] for r in similarity.resolve_titles(catalogue, liked).collect()}
    assert found == {"SPACE  two": 3, "garden": 5}
    assert [r["title"] for r in similarity.unknown_titles(catalogue, liked).collect()] == ["nothing"]


def test_shared_terms_order(one):
    types = ["array<string>", "array<string>"]
    got = one(similarity.shared_terms, ["the", "bb", "aa", "long", "story", "Zz", "q"], ["aa", "bb", "Zz", "long", "story", "q", "the"], types=types)
    assert got == ["long", "Zz", "aa", "bb", "q"]


def test_stop_words_are_those_of_spark(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    assert text.header_key(" Vote-Average ") == "vote_average"


def test_terms_are_counted_where_the_text_is(spark):
    """Repeated and null ids are one document each; without them no row of a term is grouped by document."""
    draw = [[1, "ab cd the ab cd"], [2, None], [1, "ab of cd x"], [None, "été ab"], [None, "ab"], [3, ""], [4, "the of"]]
    docs = spark.createDataFrame(draw, "id long, tags string")
    placed = similarity.place_by_id(docs, 3)
    got = {(r["id"], r["term"]): r["tf"] for r in similarity.term_counts(placed, STOP).collect()}
    assert got == {(1, "ab"): 3, (1, "cd"): 3, (1, "ab cd"): 3, (1, "cd ab"): 1, (None, "été"): 1, (None, "ab"): 2, (None, "été ab"): 1}
    assert similarity.term_counts(placed.limit(0), STOP).count() == 0
    many = spark.range(3000).selectExpr("id", "concat_ws(' ', transform(sequence(1, 40), i -> concat('w', id * i % 977))) AS tags")
    counts = similarity.term_counts(similarity.place_by_id(many, 3), STOP)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        assert {(r[0], r[1], r[2]) for r in counts.collect()} == {
            (i, t, c) for i in range(3000)
            for words in [[f"w{i * k % 977}" for k in range(1, 41)]]
            for t, c in Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])]).items()
        }
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "MapInArrow" in counts._jdf.queryExecution().toString()


def test_small_lists_leave_the_catalogue_in_place(spark, catalogue):
    """Neither the weights nor the texts are shuffled for the terms of a few sources or a short list."""
    weights = similarity.tfidf(catalogue.selectExpr("movie_id AS id", "tags"), STOP).localCheckpoint()
    queries = similarity.resolve_titles(catalogue, catalogue.filter("movie_id = 1"))
    found = similarity.recommend(catalogue, weights, queries, 2)
    assert found.count() == 2
    plan = similarity.similarities(queries, weights)._jdf.queryExecution().sparkPlan().toString() + found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" not in plan
