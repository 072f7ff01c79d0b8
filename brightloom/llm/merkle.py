"""Manifest of a dataset: a Merkle tree per source and one over the sources, with proofs.

A leaf is the digest of a row. Nodes in order come in runs of ARITY; the digest of a
run is a node of the next level, until one node is left. Only every KEEP-th level is
written. For the proofs the nodes between are worked out again, one aligned subtree
(ARITY to the KEEP stored descendants of one stored node) at a time: its group gives
the siblings of every descendant and leaves no other trace. Paths come down the
stored levels from the root, and the full proof of a row exists only in the task
that digests it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.shared import stored
from brightloom.operators.ordering import composite_row_numbers

ARITY = 16
KEEP = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def row_digest(fields: Sequence[Column]) -> Column:
    """Digest of values in order: each its number of UTF-8 bytes, a colon and itself; null is a hyphen."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _joined(digests: Column) -> Column:
    return F.array_join(digests, "")


def _next_level(digests: Column, arity: int) -> Column:
    """Digests of the runs of one level of a subtree."""
    runs = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / arity).cast("int"))
    return F.transform(runs, lambda r: F.sha2(_joined(F.slice(digests, r * arity + 1, F.lit(arity))), 256))


def _subtrees(nodes: DataFrame, arity: int, keep: int, level: int, *payload: str) -> DataFrame:
    """Aligned subtrees of a stored level: key, g, height, `members` in order and the digests `l0`, `l1`, ... `l{keep}`.

    A subtree that ends below `keep` levels, at the top of its tree, repeats its last level.
    """
    span = arity**keep
    member = F.struct("idx", "digest", *payload)
    grouped = (
        nodes.groupBy("key", F.floor(F.col("idx") / span).cast("long").alias("g"))
        .agg(F.first("height").alias("height"), F.array_sort(F.collect_list(member)).alias("members"))
        .withColumn("l0", F.col("members.digest"))
    )
    for step in range(1, keep + 1):
        below = F.col(f"l{step - 1}")
        grouped = grouped.withColumn(
            f"l{step}", F.when(F.col("height") - level >= step, _next_level(below, arity)).otherwise(below)
        )
    return grouped


def _climb(nodes: DataFrame, arity: int, keep: int) -> list[DataFrame]:
    """The stored levels: the given one and every `keep`-th above it, up to one node per key."""
    levels = [nodes]
    height = nodes.agg(F.max("height")).first()[0] or 0
    for level in range(0, height, keep):
        top = _subtrees(levels[-1], arity, keep, level).select(
            "key", F.col("g").alias("idx"), F.get(f"l{keep}", F.lit(0)).alias("digest"), "height"
        )
        levels.append(stored(top, "nodes"))
    return levels


def _siblings(place: Column, arity: int, keep: int, level: int) -> Column:
    """The steps from a member at `place` of a subtree to its top: (left, right) siblings, joined, per level."""
    steps = []
    for step in range(keep):
        at = F.floor(place / arity**step).cast("int")
        start = at - at % arity
        digests = F.col(f"l{step}")
        left = _joined(F.slice(digests, start + 1, at - start))
        right = _joined(F.slice(digests, at + 2, start + arity - at - 1))
        steps.append(F.when(F.col("height") - level > step, F.struct(left.alias("left"), right.alias("right"))))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def _descend(levels: list[DataFrame], paths: DataFrame, arity: int, keep: int, *payload: str) -> DataFrame:
    """Paths of the nodes of the first level from those of the last.

    `paths` has key, idx, path (steps up to the root) and columns of its own that
    all nodes below inherit. The first level brings its `payload`.
    """
    inherited = [c for c in paths.columns if c not in ("key", "idx", "path")]
    for number in reversed(range(len(levels) - 1)):
        bottom = number == 0
        own = payload if bottom else ()
        level = number * keep
        trees = _subtrees(levels[number], arity, keep, level, *own)
        met = trees.join(paths.withColumnRenamed("idx", "g"), ["key", "g"])
        paths = met.select(
            "key", "path", *inherited, "height", *[f"l{s}" for s in range(keep)], F.posexplode("members").alias("place", "member")
        ).select(
            "key", F.col("member.idx").alias("idx"), *inherited, *[F.col(f"member.{c}").alias(c) for c in ("digest", *own)],
            F.concat(_siblings(F.col("place"), arity, keep, level), "path").alias("path"),
        )
        if not bottom:
            paths = stored(paths.drop("digest"), "paths")
    if len(levels) == 1:
        return paths.join(levels[0].select("key", "idx", "digest", *payload), ["key", "idx"])
    return paths


def _height(total: Column, arity: int) -> Column:
    """Levels above `total` leaves."""
    powers = [arity**k for k in range(63) if arity**k < 2**63]
    return F.size(F.filter(F.array(*[F.lit(p) for p in powers]), lambda p: p < total))


def _numbered(rows: DataFrame, order: Sequence[str | Column], by: Sequence[str], arity: int) -> DataFrame:
    numbered = composite_row_numbers(rows, order, by, "_n", total="_total")
    return numbered.withColumn("idx", F.col("_n") - 1).withColumn("height", _height(F.col("_total"), arity)).drop("_n", "_total")


def manifest(
    rows: DataFrame, source: str = "source", arity: int = ARITY, keep: int = KEEP
) -> tuple[DataFrame, DataFrame]:
    """Trees over `rows` (doc_id, digest, the source column and any others).

    Returns (leaves, sources). `sources` has one row per source: key, source,
    subroot, root. `leaves` has the columns of `rows`, subroot, root and `path`,
    the array of (left, right) siblings from the leaf to the root. Leaves of a
    source ascend by doc_id (null first), equal ids by digest; sources ascend by
    their bytes, null first.
    """
    keyed = rows.withColumn("key", F.when(F.col(source).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(source))))
    payload = [c for c in rows.columns if c != "digest"]
    ordered = [F.asc_nulls_first("doc_id"), "digest", "_row"]
    leaves = stored(
        _numbered(keyed.withColumn("_row", F.monotonically_increasing_id()), ordered, ["key"], arity).drop("_row"), "leaves"
    )
    levels = _climb(leaves, arity, keep)
    subroots = levels[-1].select("key", F.col("digest").alias("subroot"))
    # The tree over the sources: one key for all of its nodes.
    crowns = _numbered(subroots.withColumnRenamed("key", "source_key"), ["source_key"], [], arity)
    crown_levels = _climb(
        stored(crowns.select(F.lit("").alias("key"), "idx", F.col("subroot").alias("digest"), "height", "source_key"), "crowns"),
        arity, keep,
    )
    no_steps = F.array().cast("array<struct<left:string,right:string>>")
    root = crown_levels[-1].select("key", "idx", F.col("digest").alias("root"), no_steps.alias("path"))
    tops = stored(
        _descend(crown_levels, root, arity, keep, "source_key").select(
            F.col("source_key").alias("key"), F.lit(0).cast("long").alias("idx"), F.col("digest").alias("subroot"), "root", "path"
        ),
        "tops",
    )
    sources = tops.select(
        "key", F.when(F.col("key") != "0", F.substring("key", 2, 2**31 - 1)).alias(source), "subroot", "root"
    )
    return _descend(levels, tops, arity, keep, *payload).drop("key", "idx"), sources


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda done, s: F.sha2(F.concat(s["left"], done, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level from leaf to root, left to right."""
    return F.sha2(_joined(F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256)


def tamper_check(
    docs: DataFrame, fields: Sequence[str] = FIELDS, source: str = "source", text: str = "text", doc_id: str = "doc_id",
    one_in: int = 5, arity: int = ARITY, keep: int = KEEP,
) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    Rows whose id's CRC32 `one_in` divides are tampered with: the text's A-Z become
    lower case, and folded_root is worked out from the changed leaf and the
    original siblings. A null text, or one without A-Z, cannot change and stays
    verified; a null doc_id is never tampered with. Null and empty values differ
    in the leaf. Repeated rows are leaves of their own. A single row is its own
    root, with the proof of the empty string. An empty table gives no rows. Other
    columns are not read.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    changed = [F.translate(F.col(c), upper, lower) if c == text else F.col(c) for c in fields]
    hit = F.coalesce(F.crc32(F.col(doc_id).cast("string")) % one_in == 0, F.lit(False))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        row_digest([F.col(c) for c in fields]).alias("digest"),
        F.when(hit, row_digest(changed)).alias("tampered"),
    )
    leaves, _ = manifest(rows, "source", arity, keep)
    folded = leaves.withColumn("folded_root", fold(F.coalesce("tampered", "digest"), F.col("path")))
    return folded.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _tree_sql(leaves: str, prefix: str, levels: int, arity: int) -> str:
    """Levels {prefix}1 ... of a CTE `leaves` (key, idx, digest, n); full trees of up to arity ** levels leaves."""
    parts, below = [], leaves
    for level in range(1, levels + 1):
        parts.append(f"""{prefix}{level} AS (
  SELECT key, idx // {arity} AS idx, sha256(string_agg(digest, '' ORDER BY idx)) AS digest, count(*) OVER (PARTITION BY key) AS n
  FROM {below} WHERE n > 1 GROUP BY key, idx // {arity})""")
        below = f"{prefix}{level}"
    return ",\n".join(parts)


def _path_sql(leaves: str, prefix: str, levels: int, arity: int) -> str:
    """Per level the siblings {prefix}s{level} (key, idx, lft, rgt) of every node that is in a run."""
    parts = []
    for level in range(levels):
        below = leaves if level == 0 else f"{prefix}{level}"
        run = f"PARTITION BY key, idx // {arity} ORDER BY idx ROWS BETWEEN"
        parts.append(f"""{prefix}s{level} AS (
  SELECT key, idx, coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
         coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
  FROM {below} WHERE n > 1)""")
    return ",\n".join(parts)


def _crc_sql(value: str) -> str:
    """CRC32 of the ASCII text `value`, unsigned: eight shifts for each byte."""
    shifts = "list_reduce(list_concat([xor(a, b)], [CAST(0 AS BIGINT) FOR i IN range(8)]), lambda c, z : xor(c >> 1, 3988292384 * (c & 1)))"
    start = f"list_concat([CAST(4294967295 AS BIGINT)], [CAST(ord(d) AS BIGINT) FOR d IN string_split({value}, '')])"
    return f"xor(list_reduce({start}, lambda a, b : {shifts}), 4294967295)"


def _check_sql(levels: int = 5, crown: int = 3, arity: int = ARITY) -> str:
    """The whole check as SQL, for sources of up to arity ** levels rows and arity ** crown sources."""
    field = "coalesce(CAST(strlen(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
    texts = [field.format(f) for f in FIELDS]
    low = field.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

    def tops(table: str, prefix: str, count: int) -> str:
        return " UNION ALL ".join(
            f"SELECT key, digest FROM {f'{prefix}{k}' if k else table} WHERE n = 1" for k in range(count + 1)
        )

    steps = [(f"as{k}", "l.key", f"l.idx // {arity**k}") for k in range(levels)]
    steps += [(f"cs{k}", "''", f"r.idx // {arity**k}") for k in range(crown)]
    proof, joins, folds, before = "''", "", "", "coalesce(l.tampered, l.digest)"
    for number, (table, key, place) in enumerate(steps):
        joins += f"\nLEFT JOIN {table} ON {table}.key = {key} AND {table}.idx = {place}"
        proof += f" || coalesce({table}.lft || {table}.rgt, '')"
        step = f"CASE WHEN {table}.lft IS NULL THEN {before} ELSE sha256({table}.lft || {before} || {table}.rgt) END"
        folds += f"\nCROSS JOIN LATERAL (SELECT {step} AS v) f{number}"
        before = f"f{number}.v"
    return f"""
WITH digests AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS key,
    sha256({' || '.join(texts)}) AS digest,
    CASE WHEN {_crc_sql('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN sha256({' || '.join([*texts[:-1], low])}) END AS tampered
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx,
    count(*) OVER (PARTITION BY key) AS n FROM digests),
{_tree_sql('leaves', 'a', levels, arity)},
{_path_sql('leaves', 'a', levels, arity)},
subroots AS ({tops('leaves', 'a', levels)}),
crowns AS (
  SELECT '' AS key, key AS source_key, digest, row_number() OVER (ORDER BY key) - 1 AS idx, count(*) OVER () AS n FROM subroots),
{_tree_sql('crowns', 'c', crown, arity)},
{_path_sql('crowns', 'c', crown, arity)},
root AS ({tops('crowns', 'c', crown)})
SELECT l.doc_id, l.digest AS leaf, r.digest AS subroot, root.digest AS root, sha256({proof}) AS proof_sha256,
  {before} AS folded_root, {before} = root.digest AS verified
FROM leaves l JOIN crowns r ON r.source_key = l.key CROSS JOIN root{joins}{folds}
"""


CHECK_SQL = _check_sql()
