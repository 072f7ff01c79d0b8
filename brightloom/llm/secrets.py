"""Secrets in documents, sorted by how their owners share them.

Each document gives candidate spans: the three base kinds, and long mixed tokens
that look like keys. A candidate's value is hashed, and over the whole corpus the
hashes are counted by distinct repositories and distinct owners. A value that
many owners hold, or that stands in many repositories, is an example that was
copied around; a value that few places hold looks live. Key-like tokens that look live add their spans; base spans stay
whatever their verdict.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.shared import stored

KINDS = ("assign", "access", "hex")
TOKEN = "token"
# The base patterns and their shortest matches.
ASSIGN = re.compile(r"""(?ia:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}+")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
# A key-like token: this long, with letters and digits, and this many bits of entropy per character.
MIXED = re.compile(r"[A-Za-z0-9+/_=-]{20,}+")
MIXED_BITS = 3.0
MAX_OWNERS = 2
MAX_REPOSITORIES = 8
_SPAN = "struct<kind:string,start:int,end:int,value:binary>"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base kinds, by start, then kind."""
    found = [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def entropy(value: str) -> float:
    """Bits per character."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def mixed_spans(text: str, taken: list[tuple[str, int, int, str]]) -> list[tuple[str, int, int, str]]:
    """Key-like tokens that no base span overlaps."""
    found, at = [], 0
    taken = sorted((s[1], s[2]) for s in taken)
    for m in MIXED.finditer(text):
        value = m[0]
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if at < len(taken) and taken[at][0] < m.end():
            continue
        if re.search("[0-9]", value) and re.search("[A-Za-z]", value) and entropy(value) >= MIXED_BITS:
            found.append((TOKEN, m.start(), m.end(), value))
    return found


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `found`, an array of (kind, start, end, value); the value as a 128-bit hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.binary())]))
        for batch in batches:
            out = []
            for value in batch.column("text"):
                own = value.as_py() or ""
                base = base_spans(own)
                out.append([(k, a, b, xxhash.xxh3_128_digest(v)) for k, a, b, v in base + mixed_spans(own, base)])
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(out, kind)], names=["doc", "found"])

    packed = docs.select(F.struct(*[c for c in docs.columns if c != text]).alias("doc"), F.col(text).alias("text"))
    rest = packed.schema["doc"].dataType.simpleString()
    return packed.mapInArrow(run, f"doc {rest}, found array<{_SPAN}>").select("doc.*", "found")


def ownership(found: DataFrame) -> DataFrame:
    """(value, repositories, owners): how many distinct ones hold each value.

    `found` has owner, repository and found. Pairs are made distinct before they
    are counted, with partial results per task, so a value that stands in very
    many documents shrinks to its repositories before the shuffle. A null owner or
    repository counts as one.
    """
    held = found.select("owner", "repository", F.explode(F.array_distinct(F.transform("found", lambda s: s["value"]))).alias("value"))
    pairs = held.distinct()
    per_owner = pairs.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    return per_owner.groupBy("value").agg(F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def _named(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: Column | None = None,
    repository: Column | None = None, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """Per row: doc_id, counts and digest of the base spans, all spans, and the verdicts.

    The owner of a document is its `source`, a repository the documents of one
    language in a source, unless columns are given. A value that more than
    `max_owners` owners or `max_repositories` repositories hold is an example, else
    it looks live. Columns n_live and n_example count a row's candidates by verdict;
    `holders` names every candidate with its numbers of repositories and owners;
    `spans` has the base spans and the key-like tokens that look live, by start,
    then kind. Null texts are empty
    and have no span; a null owner is an owner; repeated rows are rows of their own.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.struct("source", "lang") if repository is None else repository
    read = docs.select(F.col(doc_id).alias("doc_id"), owner.alias("owner"), repository.alias("repository"), F.col(text).alias("text"))
    rows = stored(candidates(read).withColumn("row", F.monotonically_increasing_id()), "candidates")
    # The counts come back to every place that holds the value; a row's are put in the order of its candidates.
    counted = (
        rows.select("row", F.posexplode("found").alias("at", "span")).select("row", "at", F.col("span.value").alias("value"))
        .join(ownership(rows), "value").groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("at", "repositories", "owners"))).alias("counts"))
    )
    judged = F.zip_with("found", F.coalesce("counts", F.array().cast("array<struct<at:int,repositories:bigint,owners:bigint>>")), lambda s, n: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        n["repositories"].alias("repositories"), n["owners"].alias("owners"),
        ((n["owners"] > max_owners) | (n["repositories"] > max_repositories)).alias("example"),
    ))
    base = F.filter("found", lambda s: s["kind"] != TOKEN)
    example = F.filter("found", lambda s: s["example"])
    kept = F.filter("found", lambda s: (s["kind"] != TOKEN) | ~s["example"])
    place = F.array(*[F.lit(k) for k in (*KINDS, TOKEN)])
    ordered = F.transform(
        F.sort_array(F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.array_position(place, s["kind"]).alias("p"), s["end"].alias("end"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    holders = F.transform("found", lambda s: F.concat_ws(":", *[s[c].cast("string") for c in ("kind", "start", "end", "repositories", "owners")]))
    return rows.join(counted, "row", "left").withColumn("found", judged).select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(_named(base), 256).alias("base_sha256"), _named(ordered).alias("spans"),
        (F.size("found") - F.size(example)).cast("long").alias("n_live"), F.size(example).cast("long").alias("n_example"),
        F.array_join(holders, ",").alias("holders"),
    )
