"""Ranks, running totals and quantiles against pandas, with one group holding most rows."""

import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brightloom.operators import ordering


@pytest.fixture(scope="module")
def skewed(spark):
    random = np.random.default_rng(7)
    n = 4000
    frame = pd.DataFrame(
        {
            "id": np.arange(n),
            "g": np.where(random.random(n) < 0.7, "hot", random.choice(list("abc"), n)),
            "x": np.where(random.random(n) < 0.5, 3.0, random.normal(0, 100, n)),
        }
    )
    return frame, spark.createDataFrame(frame)


def test_row_numbers(skewed):
    frame, df = skewed
    got = ordering.row_numbers(df, "id", ["g"]).toPandas().set_index("id")["row_number"].sort_index()
    want = frame.groupby("g").cumcount() + 1
    assert (got.to_numpy() == want.to_numpy()).all()


def test_running_totals(skewed):
    frame, df = skewed
    got = ordering.running_totals(df, "id", {"run": "x"}, ["g"]).toPandas().sort_values("id")
    want = frame.sort_values("id").groupby("g")["x"].cumsum()
    assert np.allclose(got["run"].to_numpy(), want.to_numpy())
    assert np.allclose(got["run_total"].to_numpy(), frame.groupby("g")["x"].transform("sum").to_numpy())


def test_quantiles(skewed):
    frame, df = skewed
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r["g"]: r["quantiles"] for r in ordering.exact_quantiles(df, ["x"], shares, ["g"]).collect()}
    for group, values in frame.groupby("g")["x"]:
        assert np.allclose(got[group], np.quantile(values, shares))
    whole = ordering.exact_quantiles(df, ["x", "id"], [0.5]).collect()
    assert {r["column"]: r["quantiles"][0] for r in whole} == pytest.approx({"x": frame.x.median(), "id": frame.id.median()})


def test_quantiles_leave_out_nulls_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert ordering.exact_quantiles(df, ["x"], [0.5]).first()["quantiles"] == [2.0]


@pytest.mark.parametrize("ranges", [4, 1000])
def test_number_of_ranges_changes_nothing(skewed, ranges):
    frame, df = skewed
    got = {r["g"]: r["quantiles"] for r in ordering.exact_quantiles(df, ["x"], [0.25, 0.5], ["g"], ranges=ranges).collect()}
    for group, values in frame.groupby("g")["x"]:
        assert np.allclose(got[group], np.quantile(values, [0.25, 0.5]))
    numbers = ordering.row_numbers(df, "id", ["g"], ranges=ranges).toPandas().set_index("id")["row_number"].sort_index()
    assert (numbers.to_numpy() == (frame.groupby("g").cumcount() + 1).to_numpy()).all()


def test_composite_numbers_of_a_hot_group(spark):
    rows = [("hot" if i % 3 else None if i % 2 else f"g{i % 7}", i * 7919 % 50, f"n{i * 31 % 1000:04d}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, x long, s string, i long")
    numbered = ordering.composite_row_numbers(df, [F.desc("x"), "s", "i"], ["k"], "n", total="all", ranges=13)
    groups = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    expected = set()
    for members in groups.values():
        members.sort(key=lambda r: (-r[1], r[2], r[3]))
        expected |= {(r[3], at, len(members)) for at, r in enumerate(members, 1)}
    assert {(r["i"], r["n"], r["all"]) for r in numbered.collect()} == expected


def test_composite_numbers_over_all_rows_use_no_window(spark):
    df = spark.range(500).selectExpr("id", "cast(id % 10 as string) as k")
    numbered = ordering.composite_row_numbers(df, [F.desc_nulls_first("k"), "id"], name="k2", ranges=4)
    assert "Window" not in numbered._jdf.queryExecution().toString()
    expected = sorted(((str(i % 10), i) for i in range(500)), key=lambda r: (-int(r[0]), r[1]))
    assert [(r["k"], r["id"]) for r in numbered.orderBy("k2").collect()] == expected
    assert ordering.composite_row_numbers(df.limit(0), ["id"]).count() == 0


@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, 64, 1000, 4097])
def test_keyed_permutation(spark, size):
    """Every key gives a permutation, another one per key, with no drift towards places."""
    keys = [f"k{i}" for i in range(4)]
    rows = spark.range(size).select(*[ordering.keyed_permutation(F.col("id"), size, k).alias(k) for k in keys]).toPandas()
    for k in keys:
        assert sorted(rows[k]) == list(range(size))
    if size >= 1000:
        assert rows.T.drop_duplicates().shape[0] == len(keys)
        for k in keys:
            assert (rows[k] == np.arange(size)).sum() < 10
            assert abs(np.corrcoef(np.arange(size), rows[k])[0, 1]) < 0.12


def test_keyed_permutation_is_the_hash_form_and_faster(spark):
    """The numbers of the plain expression over xxhash64, in less than half its time."""

    def plain(number, size, key):
        draw = random.Random(f"{key}/{size}")
        rounds = [(i, draw.randrange(max(size, 1))) for i in range(6 * max(size, 2).bit_length())]
        keys = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(k).cast("long").alias("k")) for i, k in rounds])

        def swapped(x, own):
            partner = F.pmod(own["k"] - x, F.lit(size).cast("long"))
            chosen = F.xxhash64(F.lit(key), own["i"], F.greatest(x, partner)).bitwiseAND(F.lit(1).cast("long"))
            return F.when(chosen == 1, partner).otherwise(x)

        return F.aggregate(keys, number.cast("long"), swapped)

    odd = spark.createDataFrame([(None,), (-5,), (0,), (998,), (999,), (1_000_000,)], "id long")
    for key, size in (("42/0", 999), ("7/3", 1), ("a longer key than a word, of more than thirty-two bytes: é", 250)):
        for df in (odd, spark.range(size)):
            got = df.select(plain(F.col("id"), size, key).alias("a"), ordering.keyed_permutation(F.col("id"), size, key).alias("b"))
            assert all(r["a"] == r["b"] for r in got.collect())

    def seconds(form, rows):
        started = time.time()
        spark.range(rows).select(F.sum(form(F.col("id"), rows, "k"))).collect()
        return time.time() - started

    seconds(ordering.keyed_permutation, 1000), seconds(plain, 1000)
    assert seconds(ordering.keyed_permutation, 1_000_000) < seconds(plain, 1_000_000) / 2
