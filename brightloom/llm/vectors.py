"""Near-duplicate vectors by PCA-ordered tiles with early stops.

Unit vectors are turned so that their coordinates come in the order of the
variance they carry. A dot product summed from the front is then close to its
end early, and what is missing is at most the product of the lengths of the two
remainders (Cauchy-Schwarz). A tile compares one block of vectors with another:
it sums some leading dimensions for all pairs, keeps the pairs that can still
reach the threshold, sums the next dimensions for these only, and so on. The few
pairs at the end are settled by the cosine of the given vectors in double
precision.

Blocks follow the first coordinate inside a label, so blocks that are further
apart there than the threshold allows never meet; boxes around the leading
coordinates rule out more. Equal vectors are one class. A tile gives a count per
vector and links that join its groups, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.llm.components import components
from brightloom.llm.shared import partitions, stored

BOXED = 8
STEPS = (8, 16, 32)
# Room for rounding in bounds; the final cosine decides alone.
SLACK = 1e-9


def rotation(vectors: DataFrame, size: int) -> np.ndarray:
    """Principal axes of unit vectors in column `unit`, as columns; one matrix of size x size.

    The covariance is summed over all rows in the executors. Any rotation gives
    right results, so fewer than two rows get the identity.
    """
    if size < 2 or len(vectors.head(2)) < 2:
        return np.eye(size)
    model = PCA(k=size, inputCol="v", outputCol="p").fit(vectors.select(array_to_vector("unit").alias("v")))
    axes, _ = np.linalg.qr(model.pc.toArray())  # exactly orthogonal
    return axes


def _pairs_reaching(a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows whose dot product can reach `least`, by leading dimensions first."""
    size = a.shape[1]
    steps = [s for s in STEPS if s < size] + [size]
    rest_a = np.sqrt(np.maximum(0, np.cumsum((a * a)[:, ::-1], axis=1)[:, ::-1]))
    rest_b = np.sqrt(np.maximum(0, np.cumsum((b * b)[:, ::-1], axis=1)[:, ::-1]))
    rest = lambda r, s: r[:, s] if s < size else np.zeros(len(r))
    first = steps[0]
    front = a[:, :first] @ b[:, :first].T
    rows, columns = np.nonzero(front + rest(rest_a, first)[:, None] * rest(rest_b, first)[None, :] >= least - SLACK)
    total = front[rows, columns]
    for low, high in zip(steps, steps[1:]):
        total = total + np.einsum("ij,ij->i", a[rows, low:high], b[columns, low:high])
        alive = total + rest(rest_a, high)[rows] * rest(rest_b, high)[columns] >= least - SLACK
        rows, columns, total = rows[alive], columns[alive], total[alive]
    return rows, columns


def _joined(n: int, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int]]:
    """Some of the links, as many as join the same groups of 0..n-1."""
    label, kept = np.arange(n), []
    while True:
        a, b = label[rows], label[columns]
        apart = np.flatnonzero(a != b)
        if not len(apart):
            return kept
        low, high = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
        order = np.lexsort((low, high))
        one = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]  # each group joins its smallest neighbour
        parent = np.arange(n)
        parent[high[one]] = low[one]
        kept += [(int(rows[i]), int(columns[i])) for i in apart[one]]
        while not np.array_equal(parent[parent], parent):
            parent = parent[parent]
        label = parent[label]


def _blocks(placed: DataFrame, block_rows: int) -> DataFrame:
    """Rows in order of (label, size, first coordinate), packed into blocks of one label and size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(key: tuple, rows: list[tuple]) -> pa.RecordBatch:
            turned = np.array([r[1] for r in rows])
            given = np.array([r[2] for r in rows])
            return pa.RecordBatch.from_pydict(
                {
                    "label": [key[0]], "size": pa.array([key[1]], pa.int32()),
                    "low": [turned[:, :BOXED].min(axis=0).tolist()], "high": [turned[:, :BOXED].max(axis=0).tolist()],
                    "ids": [np.array([r[0] for r in rows], "<i8").tobytes()],
                    "weights": [np.array([r[3] for r in rows], "<i8").tobytes()],
                    "turned": [turned.astype("<f8").tobytes()], "given": [given.astype("<f8").tobytes()],
                }
            )

        key, rows = None, []
        for batch in batches:
            for r in batch.to_pylist():
                own = (r["label"], r["size"])
                if rows and (own != key or len(rows) >= block_rows):
                    yield close(key, rows)
                    rows = []
                key = own
                rows.append((r["class"], r["turned"], r["unit"], r["weight"]))
        if rows:
            yield close(key, rows)

    return placed.mapInArrow(
        run,
        "label string, size int, low array<double>, high array<double>, ids binary, weights binary, turned binary, given binary",
    )


def _compare(pairs: DataFrame, threshold: float) -> DataFrame:
    """(src, dst, n): per tile a count of linked vectors for each class (dst null), and joining links (n null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                def block(side: str) -> list[np.ndarray]:
                    ids = np.frombuffer(r[f"ids_{side}"], "<i8")
                    shape = (len(ids), -1)
                    return [
                        ids, np.frombuffer(r[f"weights_{side}"], "<i8"), np.frombuffer(r[f"turned_{side}"], "<f8").reshape(shape),
                        np.frombuffer(r[f"given_{side}"], "<f8").reshape(shape),
                    ]

                ids_a, weights_a, turned_a, given_a = block("a")
                ids_b, weights_b, turned_b, given_b = block("b")
                rows, columns = _pairs_reaching(turned_a, turned_b, threshold)
                same = r["block_a"] == r["block_b"]
                if same:
                    once = rows < columns
                    rows, columns = rows[once], columns[once]
                cosine = np.einsum("ij,ij->i", given_a[rows], given_b[columns])
                rows, columns = rows[cosine >= threshold], columns[cosine >= threshold]
                if not len(rows):
                    continue
                count_a = np.bincount(rows, weights_b[columns], len(ids_a)).astype(np.int64)
                count_b = np.bincount(columns, weights_a[rows], len(ids_b)).astype(np.int64)
                offset = 0 if same else len(ids_a)
                both = ids_a if same else np.concatenate([ids_a, ids_b])
                joined = np.array(_joined(len(both), rows, columns + offset)).reshape(-1, 2)
                counted = np.concatenate([ids_a[count_a > 0], ids_b[count_b > 0]])
                numbers = np.concatenate([count_a[count_a > 0], count_b[count_b > 0]])
                src = np.concatenate([counted, both[joined[:, 0]]])
                dst = pa.array([None] * len(counted) + both[joined[:, 1]].tolist(), pa.int64())
                n = pa.array(numbers.tolist() + [None] * len(joined), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(src), dst, n], names=["src", "dst", "n"])

    return pairs.mapInArrow(run, "src long, dst long, n long")


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    threshold: float = 0.98, block_rows: int = 512,
) -> DataFrame:
    """Per row: vec_id, n_links (rows linked directly), component_id, kept.

    Rows of equal label and length link when their cosine is `threshold` or more
    (above 0). A row whose label is null, or whose vector is null, empty, zero or
    holds null or non-finite components, links with nothing: its component is its
    own id. Repeated rows are rows of their own and link to each other; null
    vec_ids are never the smallest id. Other columns are not read.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    largest = F.array_max(F.transform(v, F.abs))
    given = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(label).cast("string").alias("label"),
        F.col(embedding).cast("array<double>").alias("vector"),
    )
    usable = F.coalesce(F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & (largest > 0), F.lit(False))
    scaled = F.transform(v, lambda x: x / F.col("largest"))
    length = F.sqrt(F.aggregate(F.col("scaled"), F.lit(0.0), lambda s, x: s + x * x))
    # A zero and a minus zero are one value; the label and the vector name the class.
    name = F.sha2(F.concat(F.col("label"), F.lit("|"), F.to_json(F.transform(v, lambda x: x + F.lit(0.0)))), 256)
    rows = stored(
        given.withColumn("usable", usable)
        .withColumn("largest", F.when(F.col("usable"), largest)).withColumn("scaled", F.when(F.col("usable"), scaled))
        .withColumn("length", length)
        .select("vec_id", "label", F.when(F.col("usable"), name).alias("name"), F.transform("scaled", lambda x: x / F.col("length")).alias("unit")),
        "vectors",
    )
    classes = stored(
        rows.filter("name is not null").groupBy("name")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"), F.first("label").alias("label"), F.first("unit").alias("unit"))
        .select(F.monotonically_increasing_id().alias("class"), "*", F.size("unit").alias("size")),
        "classes",
    )
    widest = classes.agg(F.max("size")).first()[0] or 0
    zeros = F.array_repeat(F.lit(0.0), F.lit(widest) - F.col("size"))
    padded = classes.withColumn("unit", F.concat("unit", zeros))
    axes = rotation(padded, widest)

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = np.stack(batch.column("unit").to_pylist()) if batch.num_rows else np.zeros((0, widest))
            turned = unit @ axes
            columns = [batch.column(c) for c in ("class", "label", "size", "weight", "unit")]
            nested = pa.ListArray.from_arrays(np.arange(0, turned.size + 1, max(1, widest)).astype("i4"), turned.reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [*columns, nested, pa.array(turned[:, 0])], names=["class", "label", "size", "weight", "unit", "turned", "lead"]
            )

    turned = padded.select("class", "label", "size", "weight", "unit").mapInArrow(
        turn, "class long, label string, size int, weight long, unit array<double>, turned array<double>, lead double"
    )
    order = ["label", "size", "lead"]
    placed = turned.repartitionByRange(partitions(vectors.sparkSession), *order).sortWithinPartitions(*order)
    blocks = stored(_blocks(placed, block_rows).withColumn("block", F.monotonically_increasing_id()), "blocks")

    # Within reach: squared distance at most 2 - 2 * threshold. Cells of that width on the first coordinate.
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-6
    outline = blocks.select("block", "label", "size", "low", "high", F.get("low", F.lit(0)).alias("from"), F.get("high", F.lit(0)).alias("to"))
    cell = lambda c: F.floor(c / F.lit(reach))
    a = outline.select(
        F.col("block").alias("block_a"), "label", "size", F.col("low").alias("low_a"), F.col("high").alias("high_a"),
        F.col("from").alias("from_a"), F.col("to").alias("to_a"),
        F.explode(F.sequence(cell(F.col("from")), cell(F.col("to") + F.lit(reach)))).alias("cell"),
    )
    b = outline.select(
        F.col("block").alias("block_b"), "label", "size", F.col("low").alias("low_b"), F.col("high").alias("high_b"),
        F.col("from").alias("from_b"), cell(F.col("from")).alias("cell"),
    )
    gap = F.aggregate(
        F.zip_with(
            F.zip_with("low_a", "high_b", lambda x, y: F.greatest(x - y, F.lit(0.0))),
            F.zip_with("low_b", "high_a", lambda x, y: F.greatest(x - y, F.lit(0.0))),
            lambda x, y: x * x + y * y,
        ),
        F.lit(0.0), lambda s, x: s + x,
    )
    after = (F.col("from_b") > F.col("from_a")) | ((F.col("from_b") == F.col("from_a")) & (F.col("block_b") >= F.col("block_a")))
    meeting = (
        a.join(b, ["label", "size", "cell"])
        .filter(after & (F.col("from_b") <= F.col("to_a") + reach) & (gap <= reach * reach))
        .select("block_a", "block_b")
    )
    sides = {s: blocks.select(*[F.col(c).alias(f"{c}_{s}") for c in ("block", "ids", "weights", "turned", "given")]) for s in "ab"}
    tiles = stored(_compare(meeting.join(sides["a"], "block_a").join(sides["b"], "block_b"), threshold), "tiles")

    counts = tiles.filter("dst is null").groupBy(F.col("src").alias("class")).agg(F.sum("n").alias("others"))
    grouped = components(tiles.filter("dst is not null").select("src", "dst"))
    rooted = classes.select("class", "name", "least", "weight").join(
        grouped.withColumnRenamed("node", "class"), "class", "left"
    ).withColumn("root", F.coalesce("root", "class"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(smallest, "root").join(counts, "class", "left").select(
        "name", "component_id", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    component = F.when(F.col("name").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (
        rows.join(known, "name", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
