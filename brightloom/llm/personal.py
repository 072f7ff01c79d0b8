"""Personal data in documents, with identifiers found by bootstrapped contexts.

The base kinds (mail and network addresses, card and phone numbers) are seeds.
The words around every seed and every other identifier-like token are its
patterns: the two words before it, and the word on either side. Patterns and
instances make a graph, which is scored in rounds: a pattern is as good for a
kind as the share of its instances that are of this kind, an instance as the
patterns it stands in say together. Tokens that good patterns agree on are new
identifiers and add their spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.shared import stored

KINDS = ("email", "ip", "card", "phone")
OTHER = "other"
# The base patterns. Possessive repeats keep long runs of digits linear.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")
_DIGITS = re.compile("[0-9]+")
# An identifier-like token has this many digits; contexts are words within so many characters.
OTHER_DIGITS = 4
CONTEXT_CHARACTERS = 80
ROUNDS = 3
MIN_SUPPORT = 3
PATTERN_SCORE = 0.5
INSTANCE_SCORE = 0.8
_EDGES = ".,;:!?()[]{}<>\"'"


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    numbers = [int(d) for d in reversed(digits)]
    return (sum(numbers[::2]) + sum(sum(divmod(2 * n, 10)) for n in numbers[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ takes the letters before it, back to the last match or @, and the domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = at - (len(before) - len(before.rstrip(_LOCAL)))
        free = at + 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(free, at + 1))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base kinds, by kind, then start."""
    found = [("email", a, b) for a, b in _emails(text)]
    found += [
        ("ip", m.start(), m.end()) for m in _IP.finditer(text)
        if all(len(p) <= 3 and int(p) <= 255 for p in (part.lstrip("0") or "0" for part in m.groups()))
    ]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return found


def other_spans(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Blank-parted tokens with enough digits, without marks at their ends, that overlap no base span."""
    found, free, at = [], 0, 0
    taken = sorted((s[1], s[2]) for s in taken)
    for m in _DIGITS.finditer(text):
        if m.start() < free:
            continue
        start, free_from = m.start(), free
        while start > free_from and not text[start - 1].isspace():
            start -= 1
        end = m.end()
        while end < len(text) and not text[end].isspace():
            end += 1
        free = end
        token = text[start:end]
        start, end = end - len(token.lstrip(_EDGES)), start + len(token.rstrip(_EDGES))
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at < len(taken) and taken[at][0] < end:
            continue
        if len(_NOT_DIGIT.sub("", text[start:end])) >= OTHER_DIGITS:
            found.append((OTHER, start, end))
    return found


def patterns(text: str, start: int, end: int) -> tuple[int, int]:
    """The two contexts of a span, as hashes: two words before it; one before and one after it."""
    before = [w.strip(_EDGES) for w in text[max(0, start - CONTEXT_CHARACTERS) : start].lower().split()[-2:]]
    after = [w.strip(_EDGES) for w in text[end : end + CONTEXT_CHARACTERS].lower().split()[:1]]
    before = ["", "", *before][-2:]
    both = ("\0".join(["before", *before]), "\0".join(["around", before[1], *(after or [""])]))
    return tuple(int(np.uint64(xxhash.xxh64_intdigest(p)).view(np.int64)) for p in both)


def mentions(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `found`: (kind, start, end, instance, patterns) of seeds and identifier-like tokens."""
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("instance", pa.binary()), ("patterns", pa.list_(pa.int64()))])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column("text"):
                own = value.as_py() or ""
                base = base_spans(own)
                out.append(
                    [
                        (k, a, b, xxhash.xxh3_128_digest(own[a:b].lower()), patterns(own, a, b))
                        for k, a, b in base + other_spans(own, base)
                    ]
                )
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(out, kind)], names=["doc", "found"])

    packed = docs.select(F.struct(*[c for c in docs.columns if c != text]).alias("doc"), F.col(text).alias("text"))
    rest = packed.schema["doc"].dataType.simpleString()
    span = "struct<kind:string,start:int,end:int,instance:binary,patterns:array<bigint>>"
    return packed.mapInArrow(run, f"doc {rest}, found array<{span}>").select("doc.*", "found")


def bootstrapped(
    edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT,
    pattern_score: float = PATTERN_SCORE, instance_score: float = INSTANCE_SCORE,
) -> DataFrame:
    """(instance, kind) of the instances that good patterns discover.

    `edges` has distinct (pattern, instance) rows, `seeds` distinct (instance,
    kind) ones. In each round a pattern's score for a kind is the sum of its
    instances' scores over the number of its instances, and it is good with
    `min_support` instances' worth of score and `pattern_score`; an unseen
    instance scores 1 - (1 - s1)(1 - s2)... over its good patterns. Instances at
    `instance_score` count in the next round with their score; of several kinds
    the best one, then the first by name.
    """
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances"))
    known = seeds.select("instance", "kind", F.lit(1.0).alias("score"))
    unseen = stored(edges.join(seeds.select("instance").distinct(), "instance", "left_anti"), "unseen")
    scores = known
    for _ in range(rounds):
        good = (
            edges.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("support"))
            .filter(F.col("support") >= min_support).join(sizes, "pattern")
            .withColumn("score", F.col("support") / F.col("instances")).filter(F.col("score") >= pattern_score)
            .select("pattern", "kind", "score")
        )
        together = F.lit(1.0) - F.exp(F.sum(F.log(F.lit(1.0) - F.least("score", F.lit(1 - 1e-9)))))
        found = (
            unseen.join(good, "pattern").groupBy("instance", "kind").agg(together.alias("score"))
            .filter(F.col("score") >= instance_score)
            .groupBy("instance").agg(F.min(F.struct((-F.col("score")).alias("less"), "kind")).alias("best"))
        )
        found = stored(found.select("instance", F.col("best.kind").alias("kind"), (-F.col("best.less")).alias("score")), "found")
        scores = known.unionByName(found)
    return found.select("instance", "kind")


def _named(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: float) -> DataFrame:
    """Per row: doc_id, counts and digest of the base spans, all spans, and n_discovered.

    Discovered spans have the kind with `_like` behind it and follow the base
    spans. Null texts are empty and have no span; repeated rows are rows of their
    own, and count once in the graph, whose edges are distinct. Other columns are
    not read.
    """
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = stored(mentions(read).withColumn("row", F.monotonically_increasing_id()), "mentions")
    each = rows.select("row", F.explode("found").alias("m")).select("row", "m.*")
    edges = stored(each.select(F.explode("patterns").alias("pattern"), "instance").distinct(), "edges")
    seeds = each.filter(F.col("kind") != OTHER).select("instance", "kind").distinct()
    known = bootstrapped(edges, seeds, **options)
    added = (
        each.filter(F.col("kind") == OTHER).drop("kind").join(known, "instance").groupBy("row")
        .agg(F.collect_list(F.struct(F.concat("kind", F.lit("_like")).alias("kind"), "start", "end")).alias("added"))
    )
    place = F.array(*[F.lit(k) for k in KINDS], *[F.lit(f"{k}_like") for k in KINDS])
    span = "array<struct<kind:string,start:int,end:int>>"

    def ordered(spans: Column) -> Column:
        keyed = F.transform(spans, lambda s: F.struct(F.array_position(place, s["kind"]).alias("p"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        return F.transform(F.sort_array(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    base = F.transform(
        F.filter("found", lambda s: s["kind"] != OTHER),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    more = F.coalesce("added", F.array().cast(span))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.join(added, "row", "left").select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(_named(ordered(base)), 256).alias("base_sha256"),
        _named(ordered(F.concat(base, more))).alias("spans"), F.size(more).cast("long").alias("n_discovered"),
    )
