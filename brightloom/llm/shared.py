"""Helpers of the operators in this package: written tables, row structs, word counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brightloom.session import ensure_checkpoint_dir

# Code points 32 and 9 to 13 part words.
BLANKS = " \t\n\x0b\f\r"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read from there.

    Cuts the lineage: a lost executor re-reads files, and values made once (row
    numbers, sampled bounds) stay the same for every reader.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def rows_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs meanwhile sends so many rows to Python in a batch: for large rows, whose batches grow with the input."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which the cluster sizes to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, also where the body uses it for every element of an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text, in order; null has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), BLANKS[1:], " " * (len(BLANKS) - 1))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
