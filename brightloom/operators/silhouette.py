"""Mean silhouette with plain Euclidean distances, within a stated error and without all pairs.

Up to three axes (`distance_sums`), a fast multipole scheme. The points lie in nested cells of a
grid. Two cells of a level that are not next to each other are a far pair: between
them the distance is interpolated on both sides from Chebyshev nodes, so the sources
of a cell are brought to its nodes, the nodes of one cell act on those of the other, and
every point reads the values of its cells. Pairs of cells of few points are summed point
by point, and pairs of neighbours with more are opened. So the points of a cell meet
a bounded number of cells on every level. With e the largest
relative error of the interpolation over far pairs, all means are off by no more than e times
themselves, whatever the data; the order of a level may be lower where its far cells
hold so little of the clusters that their error is small against the spread.

More axes, or very many clusters, go by cells of sources only (`silhouette_terms`).
For every cluster a cell has its weight, centre,
second moments and radius. The distances from a block of near points to the points
of a far cell add up to those to its centre plus the second-order term of its
moments; with r the radius, m the mean squared distance to the centre and d the
least distance from the block, the mean is then off by at most 0.1925 r m / d^2
(the third derivative of a distance is at most 1.155 / d^2), and by at most r in any
case. A cell that may be off by more than the tolerance is opened; cells of few points
are summed point by point.

The tolerance is relative to the mean distance to the cluster, of which a lower bound
is known beforehand: the distance to the cluster's centre, or half its spread. A
relative error of e in all means moves a silhouette by at most 2 e.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.operators.ordering import composite_row_numbers
from brightloom.session import written

DEEPEST = 24
BLOCK = 512
LEAF = 256
# Most axes and clusters of all labellings that the scheme with nodes is for.
NODE_AXES = 3
NODE_LABELS = 64
# Consecutive points that are scored together.
CHUNK = 8_192


def _sum(parts: Sequence[Column]) -> Column:
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def _distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return F.sqrt(_sum([(x - y) * (x - y) for x, y in zip(a, b)]))


def _cols(prefix: str, size: int) -> list[Column]:
    return [F.col(f"{prefix}{j}") for j in range(size)]


def _path(xs: Sequence[Column], low: Sequence[float], width: float) -> Column:
    """Two or more characters a level: which half of its cell the point is in, for every axis."""
    digits = -(-len(xs) // 4)
    whole = [F.least(F.floor((x - F.lit(l)) * F.lit(2.0**DEEPEST / width)), F.lit(2**DEEPEST - 1)).cast("long") for x, l in zip(xs, low)]
    levels = []
    for level in range(1, DEEPEST + 1):
        nibbles = []
        for start in range(0, len(xs), 4):
            bits = [F.shiftleft(F.shiftright(w, DEEPEST - level).bitwiseAND(F.lit(1).cast("long")), j) for j, w in enumerate(whole[start : start + 4])]
            nibbles.append(F.hex(_sum(bits)))
        levels.append(F.concat(*nibbles) if digits > 1 else nibbles[0])
    return F.concat(*levels)


def _shape(df: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Per group of weighted points: weight w, points m, centre c, radius r, central second moments q (means)."""
    w, xs = F.col("w"), _cols("x", size)
    sums = df.groupBy(*keys).agg(
        F.sum("w").alias("w"), F.count(F.lit(1)).alias("m"),
        *[(F.sum(w * x) / F.sum(w)).alias(f"c{j}") for j, x in enumerate(xs)],
        *[f(x).alias(f"{n}{j}") for j, x in enumerate(xs) for f, n in ((F.min, "low"), (F.max, "high"))],
        *[(F.sum(w * xs[i] * xs[j]) / F.sum(w)).alias(f"s{i}_{j}") for i in range(size) for j in range(i, size)],
    )
    cs = _cols("c", size)
    far = [F.greatest(F.col(f"high{j}") - cs[j], cs[j] - F.col(f"low{j}")) for j in range(size)]
    return sums.select(
        *keys, "w", "m", *[f"c{j}" for j in range(size)], F.sqrt(_sum([f * f for f in far])).alias("r"),
        F.array(*[F.col(f"s{i}_{j}") - cs[i] * cs[j] for i in range(size) for j in range(i, size)]).alias("q"),
        F.greatest(_sum([F.col(f"s{j}_{j}") - cs[j] * cs[j] for j in range(size)]), F.lit(0.0)).alias("spread2"),
    )


def _block_scores(size: int, by: Sequence[str]):
    """Function of a block's points and the terms they meet: the block's sum of silhouettes and weight."""
    upper = [(i, j) for i in range(size) for j in range(i, size)]

    def numbers(column: pa.ChunkedArray, width: int) -> np.ndarray:
        flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(-1, width) if width else flat

    def score(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        names = [*by, "total", "weight"]
        if not left.num_rows or not right.num_rows:
            types = [*[k.type for k in key[: len(by)]], pa.float64(), pa.float64()]
            return pa.table({n: pa.array([], t) for n, t in zip(names, types)})
        x = np.stack([left.column(f"x{j}").to_numpy() for j in range(size)], axis=1)
        weight, own = left.column("w").to_numpy().astype(float), left.column("Cluster").to_numpy()
        lengths = np.array([len(v) for v in right.column("ws")])
        cluster = np.repeat(right.column("Cluster").to_numpy(), lengths)
        ws, cs = numbers(right.column("ws"), 0), numbers(right.column("cs"), size)
        qs = numbers(right.column("qs"), len(upper))
        clusters, code = np.unique(cluster, return_inverse=True)
        sums = np.zeros((len(x), len(clusters)))
        # Measured from the middle of the block, so that squares lose no digits where distances are short.
        middle = x.mean(axis=0)
        near = x - middle
        for start in range(0, len(cs), 4096):
            part = slice(start, start + 4096)
            centres = cs[part] - middle
            squares = (near * near).sum(axis=1)[:, None] + (centres * centres).sum(axis=1)[None, :] - 2 * (near @ centres.T)
            far = np.sqrt(np.maximum(squares, 0))
            term = far
            curved = np.flatnonzero(np.any(qs[part] != 0, axis=1))
            if len(curved):
                q, d = qs[part][curved], np.maximum(far[:, curved], 1e-300)
                gap = [near[:, j][:, None] - centres[curved, j][None, :] for j in range(size)]
                trace = sum(q[:, n] for n, (i, j) in enumerate(upper) if i == j)
                along = sum((1 if i == j else 2) * q[None, :, n] * gap[i] * gap[j] for n, (i, j) in enumerate(upper))
                term[:, curved] += (trace[None, :] - along / d**2) / (2 * d)
            spread = np.zeros((far.shape[1], len(clusters)))
            spread[np.arange(far.shape[1]), code[part]] = ws[part]
            sums += term @ spread
        sizes = np.bincount(code, weights=ws, minlength=len(clusters))
        at = np.searchsorted(clusters, own)
        rows = np.arange(len(x))
        mates = sizes[at] - 1
        inner = sums[rows, at] / np.maximum(mates, 1)
        means = sums / sizes[None, :]
        means[rows, at] = np.inf
        outer = means.min(axis=1)
        lone = (mates == 0) | ~np.isfinite(outer)
        outer = np.where(lone, inner, outer)
        most = np.maximum(inner, outer)
        value = np.where(lone | (most == 0), 0.0, (outer - inner) / np.where(most == 0, 1, most))
        sums_of = {"total": [float((value * weight).sum())], "weight": [float(weight.sum())]}
        return pa.table({**{n: pa.array([k.as_py()], k.type) for n, k in zip(by, key)}, **sums_of})

    return score


def silhouette_terms(
    labelled: DataFrame, size: int, by: Sequence[str] = (), error: float = 1e-4, block: int = BLOCK, leaf: int = LEAF
) -> tuple[DataFrame, DataFrame] | None:
    """(terms, points): per block of points the cells and single points that its distances are summed over; None without points.

    A term has the weights `ws`, centres `cs` and second moments `qs` of one or more cells of a Cluster.
    """
    keys = list(by)
    points = written(
        labelled.filter(F.col("Cluster").isNotNull() & F.col("vector").isNotNull())
        .select(*keys, "Cluster", *[F.get("vector", F.lit(j)).cast("double").alias(f"x{j}") for j in range(size)])
        .groupBy(*keys, "Cluster", *[f"x{j}" for j in range(size)]).agg(F.count(F.lit(1)).alias("w")),
        "points",
    )
    xs = _cols("x", size)
    box = points.agg(*[F.min(x).alias(f"l{j}") for j, x in enumerate(xs)], *[F.max(x).alias(f"h{j}") for j, x in enumerate(xs)]).first()
    if box is None or box["l0"] is None:
        return None
    low = [box[f"l{j}"] for j in range(size)]
    width = max(max(box[f"h{j}"] - box[f"l{j}"] for j in range(size)), 1e-300) * (1 + 1e-9)
    chars = -(-size // 4)
    step = max(1, 6 // size)  # levels at once, so that a cell has some dozens of parts
    placed = points.withColumn("path", _path(xs, low, width))
    numbered = composite_row_numbers(placed, ["path", *[f"x{j}" for j in range(size)], "Cluster"], keys, "n")
    points = written(numbered.withColumn("block", F.floor((F.col("n") - 1) / block)).drop("n"), "blocks")

    of_block = _shape(points, [*keys, "block"], size).select(
        *keys, "block", *[F.col(f"c{j}").alias(f"b{j}") for j in range(size)], F.col("r").alias("br")
    )
    of_cluster = _shape(points, [*keys, "Cluster"], size)
    own = _distance(xs, _cols("c", size))
    spread = (
        points.join(of_cluster.select(*keys, "Cluster", *[f"c{j}" for j in range(size)]), [*keys, "Cluster"])
        .groupBy(*keys, "Cluster", *[f"c{j}" for j in range(size)])
        .agg((F.sum(F.col("w") * own) / F.sum("w")).alias("spread"))
    )
    starts = of_block.join(spread, keys) if keys else of_block.crossJoin(F.broadcast(spread))
    at_least = F.greatest(_distance(_cols("b", size), _cols("c", size)) - F.col("br"), F.col("spread") / 2)
    frontier = starts.select(
        *keys, "block", *[f"b{j}" for j in range(size)], "br", "Cluster", (at_least * (error / 2)).alias("allowed"), F.lit("").alias("cell")
    )
    terms = []
    for level in range(step, DEEPEST + step, step):
        level = min(level, DEEPEST)
        prefix = F.substring("path", 1, level * chars)
        above = F.substring("path", 1, max(0, level - step) * chars) if level > step else F.lit("")
        here = points.withColumn("part", prefix).withColumn("cell", above)
        nodes = _shape(here, [*keys, "Cluster", "cell", "part"], size)
        met = frontier.join(nodes, [*keys, "Cluster", "cell"])
        gap = _distance(_cols("b", size), _cols("c", size)) - F.col("br") - F.col("r")
        bound = F.when(gap > 0, F.least(0.1925 * F.col("r") * F.col("spread2") / (gap * gap), 2 * F.col("r"))).otherwise(2 * F.col("r"))
        met = written(met.withColumn("far", bound <= F.col("allowed")), "met")
        # Where only the bound r holds, the second-order term is left out: it has no meaning inside the cell.
        flat = F.transform("q", lambda v: F.lit(0.0))
        terms.append(
            met.filter("far").select(
                *keys, "block", "Cluster", F.array(F.col("w").cast("double")).alias("ws"), F.array(*_cols("c", size)).alias("cs"),
                F.when(gap > 0, F.col("q")).otherwise(flat).alias("qs"),
            )
        )
        small = met.filter(~F.col("far") & (F.col("m") <= leaf)).select(*keys, "block", "Cluster", "part")
        listed = (
            here.join(small.select(*keys, "Cluster", "part").distinct(), [*keys, "Cluster", "part"], "left_semi")
            .groupBy(*keys, "Cluster", "part")
            .agg(F.collect_list(F.struct(F.col("w").cast("double").alias("w"), F.array(*xs).alias("x"))).alias("all"))
        )
        zeros = F.array_repeat(F.lit(0.0), size * (size + 1) // 2)
        terms.append(
            small.join(listed, [*keys, "Cluster", "part"]).select(
                *keys, "block", "Cluster", F.col("all.w").alias("ws"), F.flatten("all.x").alias("cs"),
                F.flatten(F.transform("all", lambda p: zeros)).alias("qs"),
            )
        )
        frontier = met.filter(~F.col("far") & (F.col("m") > leaf)).select(
            *keys, "block", *[f"b{j}" for j in range(size)], "br", "Cluster", "allowed", F.col("part").alias("cell")
        )
        if level == DEEPEST or frontier.isEmpty():
            break
    every = terms[0]
    for more in terms[1:]:
        every = every.union(more)
    return every, points


# --- nodes on both sides ------------------------------------------------------------


def _angles(order: int) -> np.ndarray:
    return (2 * np.arange(order) + 1) * np.pi / (2 * order)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0, out=squares), out=squares)


def _interpolation(x: np.ndarray, order: int) -> np.ndarray:
    """Row per point of the cell of side 1 around 0: what each Chebyshev node counts for it."""
    steps = np.arange(order)
    at_nodes = np.cos(steps[None, :] * _angles(order)[:, None])
    out = np.ones((len(x), 1))
    for column in x.T:
        here = np.cos(steps[None, :] * np.arccos(np.clip(2 * column, -1, 1))[:, None])
        one = (2 * here @ at_nodes.T - 1) / order
        out = (out[:, :, None] * one[:, None, :]).reshape(len(x), -1)
    return out


class _Rule:
    """Nodes of the cell of side 1 around 0 that stand for its points in the far cells.

    These are Chebyshev nodes, but for those that the others already make up for: taken one by
    one are the nodes whose distances to places in the far cells the ones before explain worst.
    """

    def __init__(self, size: int, order: int):
        self.order = order
        whole = np.array(list(itertools.product(np.cos(_angles(order)) / 2, repeat=size)))
        draw = np.random.default_rng(1)
        out = draw.uniform(-1, 1, (60 + 8 * order ** (size - 1), size))
        out /= np.abs(out).max(axis=1)[:, None]
        out *= np.where(draw.random(len(out)) < 0.6, 1.5, draw.uniform(1.5, 3.5, len(out)))[:, None]
        acts = _distances(whole, out)
        rest, taken, scale = acts.copy(), [], np.sqrt(len(out))
        for _ in range(len(whole)):
            left = np.sqrt((rest * rest).sum(axis=1))
            at = int(left.argmax())
            if left[at] <= 5 * 6.0**-order * scale:
                break
            taken.append(at)
            unit = rest[at] / left[at]
            rest -= (rest @ unit)[:, None] * unit[None, :]
        self.nodes = whole[taken]
        self.made_of = np.linalg.lstsq(acts[taken].T, acts.T, rcond=1e-13)[0].T

    def to_nodes(self, x: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What points bring to the nodes."""
        parts = [slice(at, at + 2048) for at in range(0, len(x), 2048)]
        return self.made_of.T @ sum(_interpolation(x[p], self.order).T @ weights[p] for p in parts)

    def at_points(self, x: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The values at points, from those at the nodes."""
        whole = self.made_of @ values
        return np.concatenate([_interpolation(x[at : at + 2048], self.order) @ whole for at in range(0, len(x), 2048)])


@functools.lru_cache(maxsize=64)
def _rule(size: int, order: int) -> tuple[_Rule, float, float]:
    """The nodes of an order, and their largest error between far cells of side 1: relative to the distance, and in itself.

    Taken at the corners, edges and many inner points of the nearest far cells, and doubled.
    """
    rule = _Rule(size, order)
    grid = np.array(list(itertools.product((-0.5, -0.25, 0.0, 0.25, 0.5), repeat=size)))
    x = np.vstack([grid, np.random.default_rng(2).uniform(-0.5, 0.5, (200, size))])
    weights = rule.to_nodes(x, np.eye(len(x))).T
    relative = absolute = 0.0
    for rest in itertools.product((-2, -1, 0, 1, 2), repeat=size - 1):
        offset = np.array([2, *rest])
        true = _distances(x, x + offset)
        off = np.abs(weights @ _distances(rule.nodes, rule.nodes + offset) @ weights.T - true)
        relative, absolute = max(relative, float((off / true).max())), max(absolute, float(off.max()))
    return rule, 2 * relative, 2 * absolute


def _chosen(size: int, error: float, small: float) -> _Rule:
    """The lowest order whose error is at most `error` relative to the distance, or `small` in sides of a cell."""
    # Found by trial: the error is about this over six to the order.
    likely = int(np.ceil(np.log(20 * 4.5 ** (size - 1) / max(error, small)) / np.log(6)))
    for order in range(min(max(2, likely), 15), 16):
        rule, relative, absolute = _rule(size, order)
        if relative <= error or absolute <= small:
            break
    return rule


def _bits(size: int) -> int:
    """Levels of the grid: the places of a cell on all axes are one long."""
    return min(30, 62 // size)


def _at_level(key: Column, up: int, size: int) -> Column:
    """The cell `up` levels above."""
    if not up:
        return key
    bits = _bits(size)
    kept = sum(((1 << (bits - up)) - 1) << (bits * j) for j in range(size))
    return F.shiftright(key, up).bitwiseAND(F.lit(kept).cast("long"))


def _places(cells: np.ndarray, size: int) -> np.ndarray:
    """Row per cell: its place on every axis."""
    bits = _bits(size)
    return np.stack([(cells >> (bits * j)) & ((1 << bits) - 1) for j in range(size)], axis=1)


def _at_level_np(keys: np.ndarray, up: int, size: int) -> np.ndarray:
    bits = _bits(size)
    return sum((p >> up) << (bits * j) for j, p in enumerate(_places(keys, size).T))


def _far(a: Column, b: Column, size: int) -> Column:
    bits = _bits(size)
    mask = F.lit((1 << bits) - 1).cast("long")
    gaps = [F.abs(F.shiftright(a, bits * j).bitwiseAND(mask) - F.shiftright(b, bits * j).bitwiseAND(mask)) > 1 for j in range(size)]
    return reduce(lambda one, other: one | other, gaps)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    sizes = np.array([len(v) if v.is_valid else 0 for v in column], dtype=np.int64)
    return np.split(_numbers(column), np.cumsum(sizes)[:-1]) if len(sizes) else []


class _Cells:
    """The points of a chunk, found by cell."""

    def __init__(self, left: pa.Table, low: np.ndarray, width: float, size: int, labels: int):
        self.x = np.stack([left.column(f"x{j}").to_numpy() for j in range(size)], axis=1)
        self.keys, self.size, self.low, self.width = left.column("key").to_numpy(), size, low, width
        sizes = np.array([len(v) for v in left.column("codes")])
        self.row, self.code, self.w = np.repeat(np.arange(len(self.x)), sizes), _numbers(left.column("codes")), _numbers(left.column("ws"))
        self.weights = np.zeros((len(self.x), labels))
        self.weights[self.row, self.code] = self.w
        self.levels = {}

    def members(self, level: int, cell: int) -> np.ndarray:
        if level not in self.levels:
            at = _at_level_np(self.keys, _bits(self.size) - level, self.size)
            order = np.argsort(at, kind="stable")
            self.levels[level] = (order, at[order])
        order, found = self.levels[level]
        return order[np.searchsorted(found, cell) : np.searchsorted(found, cell, "right")]

    def inside(self, level: int, cell: int, rows: np.ndarray) -> np.ndarray:
        """The points in sides of their cell, from its middle."""
        place = _places(np.array([cell]), self.size)[0]
        return (self.x[rows] - self.low) * (2.0**level / self.width) - place - 0.5


def _table(schema: Sequence[tuple[str, pa.DataType]], rows: Sequence[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table({name: pa.array(list(c), kind) for (name, kind), c in zip(schema, columns)})


_FIELD = (("level", pa.int32()), ("cell", pa.int64()), ("flat", pa.list_(pa.float64())))
_FIELD_SQL = "level int, cell long, flat array<double>"


def _to_nodes(low: np.ndarray, width: float, size: int, labels: int, rules: dict[int, _Rule]):
    """Function of a chunk and the cells asked for: the weights that the chunk's points bring to the nodes of the cells."""

    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table(_FIELD, [])
        points, rows = _Cells(left, low, width, size, labels), []
        for level, cell in zip(right.column("level").to_pylist(), right.column("cell").to_pylist()):
            mine = points.members(level, cell)
            brought = rules[level].to_nodes(points.inside(level, cell, mine), points.weights[mine])
            rows.append((level, cell, brought.ravel()))
        return _table(_FIELD, rows)

    return run


def _summed(key: tuple, parts: pa.Table) -> pa.Table:
    whole = _numbers(parts.column("flat")).reshape(parts.num_rows, -1).sum(axis=0)
    return _table(_FIELD, [(key[0].as_py(), key[1].as_py(), whole)])


def _between_nodes(width: float, size: int, labels: int, rules: dict[int, _Rule]):
    """Function of the far pairs of a tile of cells and the node weights of their sources: the distance sums at the nodes."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table(_FIELD, [])
        level = key[0].as_py()
        nodes, side = rules[level].nodes, width / 2.0**level
        sources = right.column("source").to_numpy()
        order = np.argsort(sources)
        brought = _numbers(right.column("flat")).reshape(len(sources), len(nodes), labels)
        a, b = left.column("a").to_numpy(), left.column("b").to_numpy()
        cells, target = np.unique(a, return_inverse=True)
        source = order[np.searchsorted(sources[order], b)]
        offsets, kind = np.unique(_places(b, size) - _places(a, size), axis=0, return_inverse=True)
        out = np.zeros((len(cells), len(nodes), labels))
        kind = kind.ravel()
        for at, offset in enumerate(offsets):
            pairs = np.flatnonzero(kind == at)
            far = _distances(nodes, nodes + offset) * side
            for one in pairs:  # every pair of an offset has its own target
                out[target[one]] += far @ brought[source[one]]
        return _table(_FIELD, [(level, int(c), o.ravel()) for c, o in zip(cells, out)])

    return run


def _chunk_scores(low: np.ndarray, width: float, size: int, sizes: np.ndarray, groups: Sequence[int], rules: dict[int, _Rule]):
    """Function of a chunk and what acts on its cells: per labelling the chunk's sum of silhouettes and weight.

    A row of the right side has values at the nodes of a cell (`flat` alone), the points of a
    source cell (`flat`, `codes`, `ws`, `many`) or the source cells of a cell (`others`).
    """
    labels = len(sizes)
    of_group = {g: np.flatnonzero(np.array(groups) == g) for g in sorted(set(groups))}

    def sums_of(points: _Cells, right: pa.Table) -> np.ndarray:
        sums = np.zeros((len(points.x), labels)) + 0 * points.x.sum(axis=1)[:, None]
        level, cell = right.column("level").to_pylist(), right.column("cell").to_pylist()
        kind, sources = right.column("kind").to_numpy(), {}
        lists = {c: _lists(right.column(c)) for c in ("flat", "codes", "ws", "many", "others")}
        for at in np.flatnonzero(kind == 0):
            mine = points.members(level[at], cell[at])
            values = lists["flat"][at].reshape(-1, labels)
            sums[mine] += rules[level[at]].at_points(points.inside(level[at], cell[at], mine), values)
        for at in np.flatnonzero(kind == 1):
            x, many = lists["flat"][at].reshape(-1, size), lists["many"][at].astype(int)
            weights = np.zeros((len(x), labels))
            weights[np.repeat(np.arange(len(x)), many), lists["codes"][at].astype(int)] = lists["ws"][at]
            sources[level[at], cell[at]] = (x, weights)
        for at in np.flatnonzero(kind == 2):
            mine = points.members(level[at], cell[at])
            near = [sources[level[at], int(b)] for b in lists["others"][at]]
            x, weights = np.concatenate([n[0] for n in near]), np.concatenate([n[1] for n in near])
            # Measured from the middle of the cell, so that squares lose no digits where distances are short.
            for some in np.array_split(mine, -(-len(mine) // 1024)):
                middle = points.x[some].mean(axis=0)
                for start in range(0, len(x), 4096):
                    part = slice(start, start + 4096)
                    sums[some] += _distances(points.x[some] - middle, x[part] - middle) @ weights[part]
        return sums

    def run(_, left: pa.Table, right: pa.Table) -> pa.Table:
        schema = (("labelling", pa.int32()), ("total", pa.float64()), ("weight", pa.float64()))
        if not left.num_rows:
            return _table(schema, [])
        points = _Cells(left, low, width, size, labels)
        sums, rows = sums_of(points, right), []
        for group, members in of_group.items():
            mine = np.flatnonzero(np.isin(points.code, members))
            at, own, weight = points.row[mine], points.code[mine], points.w[mine]
            mates = sizes[own] - 1
            inner = sums[at, own] / np.maximum(mates, 1)
            means = np.full((len(mine), labels), np.inf)
            means[:, members] = sums[at][:, members] / sizes[members]
            means[np.arange(len(mine)), own] = np.inf
            outer = means.min(axis=1)
            lone = (mates == 0) | (np.isinf(outer))
            outer = np.where(lone, inner, outer)
            most = np.maximum(inner, outer)
            value = np.where(lone | (most == 0), 0.0, (outer - inner) / np.where(most == 0, 1, most))
            rows.append((group, float((value * weight).sum()), float(weight.sum())))
        return _table(schema, rows)

    return run


def _pairs(points: DataFrame, size: int, leaf: int) -> list[tuple[int, DataFrame, dict]]:
    """Per level of the grid the (a, b, kind) of cells that act on each other there, and the rows and shares by kind.

    Far pairs act by their nodes and `direct` ones, of cells of few points, by their
    points; `open` ones, neighbours with more points, go on as the pairs of their parts.
    """
    bits, found = _bits(size), []
    near = points.sparkSession.range(1).select(F.lit(0).cast("long").alias("up_a"), F.lit(0).cast("long").alias("up_b"))
    for level in range(1, bits + 1):
        cells = points.groupBy(_at_level(F.col("key"), bits - level, size).alias("cell")).agg(
            F.count(F.lit(1)).alias("m"), F.sum("share").alias("share")
        )
        a = cells.select(F.col("cell").alias("a"), F.col("m").alias("ma"), _at_level(F.col("cell"), 1, size).alias("up_a"))
        b = cells.select(F.col("cell").alias("b"), F.col("m").alias("mb"), "share", _at_level(F.col("cell"), 1, size).alias("up_b"))
        few = (F.col("ma") <= leaf) & (F.col("mb") <= leaf) | F.lit(level == bits)
        kind = F.when(few, "direct").when(_far(F.col("a"), F.col("b"), size), "far").otherwise("open")
        met = written(near.join(a, "up_a").join(b, "up_b").select("a", "b", "share", kind.alias("kind")), "pairs")
        shares = met.groupBy("kind", "a").agg(F.sum("share").alias("share"), F.count(F.lit(1)).alias("n"))
        facts = {r["kind"]: (r["n"], r["share"]) for r in shares.groupBy("kind").agg(F.sum("n").alias("n"), F.max("share").alias("share")).collect()}
        found.append((level, met.select("a", "b", "kind"), facts))
        if "open" not in facts:
            break
        near = met.filter("kind = 'open'").select(F.col("a").alias("up_a"), F.col("b").alias("up_b"))
    return found


def distance_sums(
    points: DataFrame, size: int, low: Sequence[float], width: float, sizes: Sequence[float], groups: Sequence[int],
    spread: float, error: float, leaf: int,
) -> DataFrame:
    """(labelling, total, weight) per chunk of points.

    `points` has chunk, key (its cell on the finest level), x0.., codes and ws (its clusters and its weights
    there) and share (the sum of weight / size of its clusters). `sizes` and `groups`
    are the weight and the labelling of every cluster; `spread` is the least mean distance to a
    cluster's centre.
    """
    bits, labels, low = _bits(size), len(sizes), np.array(low)
    levels = _pairs(points, size, leaf)
    far_levels = [level for level, _, facts in levels if "far" in facts]
    rules = {
        level: _chosen(size, error / 4, error / 4 * spread / 2 / len(far_levels) / (facts["far"][1] * width / 2.0**level))
        for level, _, facts in levels if "far" in facts
    }

    def all_levels(kind: str) -> DataFrame:
        parts = [met.filter(F.col("kind") == kind).select(F.lit(level).alias("level"), "a", "b") for level, met, facts in levels if kind in facts]
        return reduce(DataFrame.unionAll, parts) if parts else levels[0][1].limit(0).select(F.lit(0).alias("level"), "a", "b")

    used = [level for level, _, facts in levels if set(facts) - {"open"}]
    cell_of = F.array(*[F.struct(F.lit(l).alias("level"), _at_level(F.col("key"), bits - l, size).alias("cell")) for l in used])
    homes = written(points.select("chunk", F.inline(cell_of)).distinct(), "homes")
    far, direct = all_levels("far"), all_levels("direct")

    wanted = far.select("level", F.col("b").alias("cell")).distinct().join(homes, ["level", "cell"])
    wanted = wanted.withColumnRenamed("chunk", "chunk_")
    # Little data means much work here: as many tasks as the session deals, not fewer.
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = points.repartition(tasks, "chunk")
    brought = (
        dealt.groupBy("chunk").cogroup(wanted.repartition(tasks, "chunk_").groupBy("chunk_")).applyInArrow(_to_nodes(low, width, size, labels, rules), _FIELD_SQL)
        .groupBy("level", "cell").applyInArrow(_summed, _FIELD_SQL)
    )
    brought = written(brought, "nodes")
    # Cells of one grandparent share their sources.
    tiled = far.withColumn("tile", _at_level(F.col("a"), 2, size))
    sent = tiled.select("level", "tile", "b").distinct().join(brought.withColumnRenamed("cell", "b"), ["level", "b"])
    sent = sent.select(F.col("level").alias("level_"), F.col("tile").alias("tile_"), F.col("b").alias("source"), "flat")
    tiled, sent = tiled.repartition(tasks, "level", "tile"), sent.repartition(tasks, "level_", "tile_")
    fields = tiled.groupBy("level", "tile").cogroup(sent.groupBy("level_", "tile_")).applyInArrow(
        _between_nodes(width, size, labels, rules), _FIELD_SQL
    )

    placed = direct.join(homes.withColumnRenamed("cell", "a"), ["level", "a"])
    sources = direct.select("level", F.col("b").alias("cell")).distinct()
    listed = written(
        points.select(F.array(*_cols("x", size)).alias("x"), "codes", "ws", F.inline(cell_of)).join(sources, ["level", "cell"], "left_semi")
        .groupBy("level", "cell").agg(F.collect_list(F.struct("x", "codes", "ws")).alias("all")), "listed",
    )
    asked = placed.select("chunk", "level", F.col("b").alias("cell")).distinct().join(listed, ["level", "cell"])

    def row(kind: int, **columns: Column) -> list[Column]:
        kinds = {"flat": "array<double>", "codes": "array<int>", "ws": "array<double>", "many": "array<int>", "others": "array<bigint>"}
        given = [columns.get(c, F.array()).cast(t).alias(c) for c, t in kinds.items()]
        return [F.col("chunk").alias("chunk_"), "level", "cell", F.lit(kind).alias("kind"), *given]

    acting = (
        fields.join(homes, ["level", "cell"]).select(*row(0, flat=F.col("flat")))
        .unionAll(asked.select(*row(1, flat=F.flatten("all.x"), codes=F.flatten("all.codes"), ws=F.flatten("all.ws"), many=F.transform("all", lambda p: F.size(p["codes"])))))
        .unionAll(placed.groupBy("chunk", "level", F.col("a").alias("cell")).agg(F.collect_list("b").alias("others")).select(*row(2, others=F.col("others"))))
    )
    return dealt.groupBy("chunk").cogroup(acting.repartition(tasks, "chunk_").groupBy("chunk_")).applyInArrow(
        _chunk_scores(low, width, size, np.array(sizes, dtype=float), groups, rules), "labelling int, total double, weight double"
    )


def _silhouette_by_nodes(labelled: DataFrame, size: int, keys: Sequence[str], error: float, leaf: int, chunk: int) -> DataFrame | None:
    """(by, silhouette), or None where the scheme with nodes is not for this input."""
    xs, spark = _cols("x", size), labelled.sparkSession
    usable = labelled.filter(F.col("Cluster").isNotNull() & F.col("vector").isNotNull())
    for key in keys:
        usable = usable.filter(F.col(key).isNotNull())
    rows = written(
        usable.select(*keys, "Cluster", *[F.get("vector", F.lit(j)).cast("double").alias(f"x{j}") for j in range(size)])
        .groupBy(*keys, "Cluster", *[f"x{j}" for j in range(size)]).agg(F.count(F.lit(1)).cast("double").alias("w")), "points",
    )
    found = rows.groupBy(*keys, "Cluster").agg(
        F.sum("w").alias("size"), *[(F.sum(F.col("w") * x) / F.sum("w")).alias(f"c{j}") for j, x in enumerate(xs)],
        *[f(x).alias(f"{n}{j}") for j, x in enumerate(xs) for f, n in ((F.min, "low"), (F.max, "high"))],
    ).orderBy(*keys, "Cluster").limit(NODE_LABELS + 1).collect()  # one row per cluster
    if not found or len(found) > NODE_LABELS:
        return None
    low = [min((r[f"low{j}"] for r in found if r[f"low{j}"] is not None), default=None) for j in range(size)]
    high = [max((r[f"high{j}"] for r in found if r[f"high{j}"] is not None), default=None) for j in range(size)]
    if any(v is None or not np.isfinite(v) for v in [*low, *high]):
        return None
    width = max(max(h - l for l, h in zip(low, high)), 1e-300) * (1 + 1e-9)
    names = list(dict.fromkeys(tuple(r[k] for k in keys) for r in found))
    groups = [names.index(tuple(r[k] for k in keys)) for r in found]
    fields = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in [*keys, "Cluster"]]
    known = spark.createDataFrame(
        [(*[r[k] for k in keys], r["Cluster"], i, groups[i], r["size"], *[r[f"c{j}"] for j in range(size)]) for i, r in enumerate(found)],
        ", ".join([*fields, "code int, labelling int, size double", *[f"c{j} double" for j in range(size)]]),
    )
    coded = rows.join(F.broadcast(known), [*keys, "Cluster"])
    apart = coded.groupBy("code").agg((F.sum(F.col("w") * _distance(xs, _cols("c", size))) / F.sum("w")).alias("apart"))
    spread = apart.agg(F.min("apart")).first()[0]
    bits = _bits(size)
    places = [
        F.greatest(F.least(F.floor((x - F.lit(l)) * F.lit(2.0**bits / width)), F.lit(2**bits - 1)), F.lit(0)).cast("long") for x, l in zip(xs, low)
    ]
    merged = coded.groupBy(*[f"x{j}" for j in range(size)]).agg(
        F.collect_list(F.struct("code", "w")).alias("all"), F.sum(F.col("w") / F.col("size")).alias("share")
    )
    placed = merged.select(
        *xs, F.col("all.code").alias("codes"), F.col("all.w").alias("ws"), "share", _path(xs, low, width).alias("path"),
        _sum([F.shiftleft(p, bits * j) for j, p in enumerate(places)]).alias("key"),
    )
    numbered = composite_row_numbers(placed, ["path", *[f"x{j}" for j in range(size)]], (), "n")
    points = written(numbered.withColumn("chunk", F.floor((F.col("n") - 1) / chunk)).drop("n", "path"), "chunks")
    scored = distance_sums(points, size, low, width, [r["size"] for r in found], groups, spread or 0.0, error, leaf)
    sums = scored.groupBy("labelling").agg((F.sum("total") / F.sum("weight")).alias("silhouette"))
    if not keys:
        return sums.select("silhouette")
    return sums.join(F.broadcast(known.select("labelling", *keys).distinct()), "labelling").select(*keys, "silhouette")


def silhouette_euclid(
    labelled: DataFrame, size: int, by: Sequence[str] = (), error: float = 1e-4, block: int = BLOCK, leaf: int = LEAF
) -> DataFrame:
    """(by, silhouette): the mean silhouette, off by no more than `error`.

    `labelled` has Cluster (an integer), `vector` (an array of `size` numbers) and the
    columns of `by`, each value of which is a labelling of its own. Equal points
    are one point with a weight. A point alone in its cluster counts 0, and so do
    all points where there is one cluster. Rows with a null cluster or vector are left out.
    """
    keys = list(by)
    by_nodes = _silhouette_by_nodes(labelled, size, keys, error, leaf, max(block, CHUNK)) if size <= NODE_AXES else None
    if by_nodes is not None:
        return by_nodes
    found = silhouette_terms(labelled, size, keys, error, block, leaf)
    if found is None:
        return labelled.limit(0).groupBy(*keys).agg(F.lit(None).cast("double").alias("silhouette"))
    every, points = found
    types = [points.schema[c].dataType.simpleString() for c in keys]
    schema = ", ".join([*[f"{c} {t}" for c, t in zip(keys, types)], "total double", "weight double"])
    near = every.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col("block").alias("_block"), "Cluster", "ws", "cs", "qs")
    mine = points.select(*keys, "block", "Cluster", "w", *[f"x{j}" for j in range(size)])
    scored = mine.groupBy(*keys, "block").cogroup(near.groupBy(*[f"_{c}" for c in keys], "_block")).applyInArrow(
        _block_scores(size, keys), schema
    )
    return scored.groupBy(*keys).agg((F.sum("total") / F.sum("weight")).alias("silhouette"))
