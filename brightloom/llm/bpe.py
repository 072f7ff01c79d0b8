"""Byte-level BPE by prefix dynamic programming, and decoding.

Merging by lowest rank gives every byte string one encoding, and a row of tokens
is that encoding exactly when each two neighbours stay apart when the bytes of
the two are encoded alone. The encoding of a prefix therefore ends in one token
that is settled by shorter prefixes: the only token ending there whose pair with
the last token of what stands before it holds. Storing that last token for every
prefix makes appends exact (old entries stay) and edits local (entries are made
anew only until as many as the longest token agree with the old ones).

Texts are cut at single blanks first. A cut there never parts a match of the
pattern, so the ids of a blank-delimited word are found once per worker and
reused; the memory of a worker is bounded by the `remembered` parameter. The new
words of many texts are encoded together: their prefixes grow by one byte at a
time, all words at once.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NEVER = 1 << 62
TOGETHER = 256  # bytes of a match up to which it is worked out with others
AT_ONCE = 1 << 20  # bytes of matches worked out at once
SLOTS = 1 << 20  # remembered verdicts on pairs of tokens
MIX = 0x1E3779B97F4A7C15  # spreads keys over slots
# White space as in the Unicode property of that name.
_WHITE = r"\t\n\x0b\f\r \x85\xa0  -     　"


def compiled(pattern: str) -> regex.Pattern:
    """The pattern with its white-space classes spelt out."""
    inside = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{_WHITE}\p{{L}}\p{{N}}]")
    return regex.compile(inside.replace(r"\S", rf"[^{_WHITE}]").replace(r"\s", rf"[{_WHITE}]"))


class PrefixEncoder:
    """Encodes byte strings with a table of tokens and ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.whole_only = set()  # tokens that merging does not reach: they encode only the text that is equal to them
        for token, rank in ranks.items():
            if len(token) == 1:
                self.parts[rank] = None
                continue
            left = self._merged(token)
            if len(left) == 2:
                self.parts[rank] = (ranks[left[0]], ranks[left[1]])
            else:
                self.whole_only.add(rank)
        self.endings = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if rank not in self.whole_only:
                self.endings.add_word(token.decode("latin-1"), (len(token), rank))
        self.endings.make_automaton()
        self.spines: tuple[dict, dict] = ({}, {})
        self.apart: dict[int, bool] = {}  # by first << 32 | second
        self.sizes = np.zeros(max(self.bytes_of) + 1, np.int64)
        self.sizes[list(self.bytes_of)] = list(map(len, self.bytes_of.values()))
        self._grow_trie()
        # The verdicts that were asked for last, one per slot.
        self.slot_keys, self.slot_fits = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, bool)

    def _grow_trie(self) -> None:
        """The tokens as a trie: `steps` has node << 8 | byte in order, `nodes` where each leads, `tokens` what ends there."""
        steps, tokens = {}, [-1]
        for token, rank in self.ranks.items():
            if rank in self.whole_only:
                continue
            node = 0
            for byte in token:
                node = steps.setdefault(node << 8 | byte, len(steps) + 1)
                if node == len(tokens):
                    tokens.append(-1)
            tokens[node] = rank
        found, nodes = np.array(list(steps), np.int64), np.array(list(steps.values()), np.int64)
        order = np.argsort(found)
        self.steps, self.nodes, self.tokens = found[order], nodes[order], np.array(tokens, np.int64)

    def _merged(self, token: bytes) -> list[bytes]:
        """The parts of a token before its last merge."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            ranked = [self.ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            best = min(ranked)
            if best == NEVER:
                break
            at = ranked.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """The tokens on one outer side of a token with the rank at which each is merged away."""
        known = self.spines[side].get(token)
        if known is None:
            known, at, until = [], token, NEVER
            while True:
                known.append((self.bytes_of[at], until))
                if self.parts[at] is None:
                    break
                at, until = self.parts[at][side], at
            self.spines[side][token] = known
        return known

    def holds(self, first: int, second: int) -> bool:
        """Whether two tokens stay apart: no merge over their border comes before the merges inside."""
        rank_of = self.ranks.get
        for a, a_until in self._spine(first, 1):
            for b, b_until in self._spine(second, 0):
                rank = rank_of(a + b)
                # Equal ranks merge from the left: inside the first token before the border.
                if rank is not None and rank < a_until and rank <= b_until:
                    return False
        return True

    def prefixes(self, text: bytes, known: list[int] | None = None) -> list[int]:
        """The last token of the encoding of each prefix; `known` has those of a prefix of `text`."""
        last = list(known or [-1])
        done = len(last) - 1
        last += [None] * (len(text) - done)
        apart, begin = self.apart, max(0, done + 1 - self.longest)
        if len(apart) > 2_000_000:
            apart.clear()
        # All tokens that end at a byte, found in one pass over the bytes.
        for end, (size, token) in self.endings.iter(text.decode("latin-1"), begin):
            end += 1
            if end > done and last[end] is None:
                start = end - size
                if start == 0:
                    last[end] = token
                    continue
                key = last[start] << 32 | token
                fits = apart.get(key)
                if fits is None:
                    fits = apart[key] = self.holds(last[start], token)
                if fits:
                    last[end] = token
        if None in last:
            raise ValueError(f"the vocabulary cannot encode byte {text[last.index(None) - 1]}")
        return last

    def edited(self, text: bytes, last: list[int], start: int, stop: int, new: bytes) -> tuple[bytes, list[int]]:
        """The text with [start, stop) replaced by `new`, and its prefix tokens.

        Entries after the edit are made anew until as many in a row as the
        longest token has bytes are the old ones; the rest is taken over.
        """
        changed = text[:start] + new + text[stop:]
        shift = len(changed) - len(text)
        fresh = self.prefixes(changed[: start + len(new)], last[: start + 1])
        same = 0
        while len(fresh) <= len(changed):
            fresh = self.prefixes(changed[: len(fresh)], fresh)
            at = len(fresh) - 1
            same = same + 1 if fresh[at] == last[at - shift] else 0
            if same >= self.longest:
                return changed, fresh + last[at - shift + 1 :]
        return changed, fresh

    def read_back(self, last: list[int]) -> list[int]:
        """The ids along the stored last tokens."""
        ids, at = [], len(last) - 1
        while at > 0:
            ids.append(last[at])
            at -= len(self.bytes_of[last[at]])
        return ids[::-1]

    def encode(self, text: bytes) -> list[int]:
        """Ids of one match: the token that equals it, else by prefixes."""
        whole = self.ranks.get(text)
        return [whole] if whole is not None else self.read_back(self.prefixes(text)) if text else []


    def _fits(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """`holds` of many pairs; every token holds at the start of a text (first -1)."""
        keys = first << 32 | second
        slots = ((keys ^ keys >> 29) * MIX >> 17) & (SLOTS - 1)
        missing = np.flatnonzero((self.slot_keys[slots] != keys) & (first >= 0))
        fits = self.slot_fits[slots] | (first < 0)
        if len(missing):
            asked, back = np.unique(keys[missing], return_inverse=True)
            if len(self.apart) > 2_000_000:
                self.apart.clear()
            known, answers = self.apart, []
            for key in asked.tolist():
                answer = known.get(key)
                if answer is None:
                    answer = known[key] = self.holds(key >> 32, key & 0xFFFFFFFF)
                answers.append(answer)
            fits[missing] = np.array(answers, bool)[back]
            # Two keys of one slot: both arrays are written in the same order, so the last one stands in both.
            self.slot_keys[slots[missing]], self.slot_fits[slots[missing]] = keys[missing], fits[missing]
        return fits

    def _ending(self, data: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, token) of all tokens in `data`; one that starts at a byte has at most `room` bytes."""
        at, node, starts, tokens = np.arange(len(data)), np.zeros(len(data), np.int64), [], []
        for size in range(1, self.longest + 1):
            inside = room[at] >= size
            at = at[inside]
            if not len(at):
                break
            key = node[inside] << 8 | data[at + size - 1]
            step = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
            hit = self.steps[step] == key
            at, node = at[hit], self.nodes[step[hit]]
            token = self.tokens[node]
            starts.append(at[token >= 0])
            tokens.append(token[token >= 0])
        return np.concatenate(starts), np.concatenate(tokens)

    def prefixes_of_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The last tokens of all prefixes of many texts, and where each text begins in them (its empty prefix)."""
        sizes = np.array(list(map(len, texts)), np.int64)
        stops = np.cumsum(sizes)
        data, owner = np.frombuffer(b"".join(texts), np.uint8), np.repeat(np.arange(len(texts)), sizes)
        begin = stops - sizes
        starts, tokens = self._ending(data, stops[owner] - np.arange(len(data)))
        ends = starts - begin[owner[starts]] + self.sizes[tokens]
        order = np.argsort(ends.astype(np.uint16), kind="stable")
        starts, tokens = starts[order], tokens[order]
        before = starts + owner[starts]
        last = np.full(len(data) + len(texts), -1, np.int64)
        borders = np.searchsorted(ends[order], np.arange(1, int(sizes.max()) + 2))
        for low, high in zip(borders, borders[1:]):
            fits = self._fits(last[before[low:high]], tokens[low:high])
            own = tokens[low:high][fits]
            last[before[low:high][fits] + self.sizes[own]] = own
        firsts = begin + np.arange(len(texts))
        if (last < 0).sum() > len(texts):
            raise ValueError("the vocabulary cannot encode every byte of the texts")
        return last, firsts

    def encode_all(self, texts: list[bytes]) -> tuple[bytes, list[int]]:
        """The ids of many matches, one after the other as little-endian u32, and the byte offsets where each begins and ends.

        Matches of up to `TOGETHER` bytes that are no token are worked out together, longer ones alone.
        """
        whole = list(map(self.ranks.get, texts))
        shared = [i for i, (w, t) in enumerate(zip(whole, texts)) if w is None and len(t) <= TOGETHER]
        alone = {i: self.encode(t) for i, (w, t) in enumerate(zip(whole, texts)) if w is None and len(t) > TOGETHER}
        counts = np.ones(len(texts), np.int64)
        for i, ids in alone.items():
            counts[i] = len(ids)
        rounds = []
        held = np.cumsum([len(texts[i]) for i in shared]) // AT_ONCE
        for group in np.split(np.array(shared, np.int64), np.flatnonzero(np.diff(held)) + 1) if shared else ():
            own = [texts[i] for i in group.tolist()]
            last, firsts = self.prefixes_of_all(own)
            match, at, back = group, firsts + list(map(len, own)), 0
            while len(match):
                ids, back = last[at], back + 1
                rounds.append((back, match, ids))
                counts[match] = back
                at = at - self.sizes[ids]
                left = at > firsts
                match, at, firsts = match[left], at[left], firsts[left]
        stops = np.cumsum(counts)
        out = np.zeros(int(counts.sum()), "<u4")
        plain = [i for i, w in enumerate(whole) if w is not None]
        out[stops[plain] - 1] = [whole[i] for i in plain]
        for back, match, ids in rounds:
            out[stops[match] - back] = ids
        for i, ids in alone.items():
            out[stops[i] - len(ids) : stops[i]] = ids
        return out.tobytes(), [0, *(stops * 4).tolist()]


class TextEncoder:
    """Whole texts to ids: matches of a pattern, each by itself, with remembered words."""

    def __init__(self, ranks_path: str, pattern: str, remembered: int):
        with open(ranks_path, "rb") as file:
            pairs = (line.split() for line in file if line.strip())
            self.encoder = PrefixEncoder({base64.b64decode(token): int(rank) for token, rank in pairs})
        self.pattern = compiled(pattern)
        white = regex.compile(f"[{_WHITE}]")
        self.white = frozenset(c for c in map(chr, range(0x3001)) if white.match(c))
        self.remembered = remembered
        self.words: dict[str, bytes] = {}
        self.parting: set[str] = set()  # words beside which a cut would part a run of white space
        self.table = [self.encoder.bytes_of.get(i, b"") for i in range(max(self.encoder.bytes_of) + 1)]
        self.digits = list(map(str, range(len(self.table))))

    def _parts(self, word: str) -> bool:
        """Whether cuts at the blanks beside a word are no cuts inside white space."""
        return bool(word) and word[0] not in self.white and word[-1] not in self.white

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.words) > self.remembered:
            self.words.clear()
            self.parting.clear()
        split = [text.split(" ") for text in texts]
        firsts = [s.pop(0) for s in split]
        missing = list(set().union(*split).difference(self.words, self.parting))
        self.parting.update(w for w in missing if not self._parts(w))
        missing, passing = [w for w in missing if w not in self.parting], {}
        cut = [not s or self._parts(f) and self.parting.isdisjoint(s) for f, s in zip(firsts, split)]
        # The matches of all new words: exactly the first of each word begins with a blank.
        matches = self.pattern.findall(" " + " ".join(missing)) if missing else []
        heads = [i for i, m in enumerate(matches) if m[0] == " "]
        ends = [len(matches)]
        for text, first, whole in zip(texts, firsts, cut):
            matches += self.pattern.findall(first if whole else text)
            ends.append(len(matches))
        raw, at = self.encoder.encode_all([m.encode() for m in matches])
        for word, start, stop in zip(missing, heads, [*heads, ends[0]][1:], strict=True):
            # A word without blanks that is longer than any usual one would only fill the memory.
            (self.words if len(word) <= 64 else passing)[word] = raw[at[start] : at[stop]]
        found = []
        for start, stop, rest, whole in zip(ends, ends[1:], split, cut):
            own = [raw[at[start] : at[stop]]]
            if whole:
                own += [self.words[w] if w in self.words else passing[w] for w in rest] if passing else map(self.words.__getitem__, rest)
            found.append(np.frombuffer(b"".join(own), "<u4"))
        return found

    def encode(self, text: str) -> np.ndarray:
        return self.encode_batch([text])[0]

    def encode_many(self, texts: list[str], together: int = 4_000_000) -> Iterator[np.ndarray]:
        """The ids of each text; some `together` characters at a time are worked out as one batch."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= together:
                yield from self.encode_batch(held)
                held, size = [], 0
        if held:
            yield from self.encode_batch(held)

    def decimal(self, ids: np.ndarray) -> str:
        """Decimal ids joined by commas."""
        return ",".join(map(self.digits.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.table.__getitem__, ids.tolist()))


@functools.cache
def text_encoder(ranks_path: str, pattern: str, remembered: int) -> TextEncoder:
    """One encoder per worker process."""
    return TextEncoder(ranks_path, pattern, remembered)


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids",
    decoded_sha256: str | None = None, remembered: int = 250_000,
) -> DataFrame:
    """`docs` with a column `ids` array<int>, the ids of each whole text (null text: none).

    `decoded_sha256` names one more column, the digest of the bytes that the ids decode to.
    """
    added = [c for c in (ids, decoded_sha256) if c]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(ranks_path, pattern, remembered)
        for batch in batches:
            found = list(encoder.encode_many([t or "" for t in batch.column("_text").to_pylist()]))
            arrays = [
                pa.ListArray.from_arrays(
                    np.cumsum([0, *map(len, found)]).astype("i4"), np.concatenate([np.zeros(0, "u4"), *found]).astype("i4")
                )
            ]
            if decoded_sha256:
                arrays.append(pa.array([hashlib.sha256(encoder.decode(f)).hexdigest() for f in found], pa.string()))
            names = ["_doc", "_text", "_ids", "_sha"][: 2 + len(arrays)]
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), batch.column("_text"), *arrays], names=names)

    # The text goes to Python once, beside a struct of the other columns.
    kept = [c for c in docs.columns if c not in added]
    rest = F.struct(F.lit(0).alias("_none"), *[c for c in kept if c != text])
    packed = docs.select(rest.alias("_doc"), F.col(text).alias("_text"))
    kind = packed.schema["_doc"].dataType.simpleString()
    out = packed.mapInArrow(run, f"_doc {kind}, _text string, _ids array<int>" + ", _sha string" * bool(decoded_sha256))
    columns = [F.col("_text" if c == text else f"_doc.{c}").alias(c) for c in kept]
    return out.select(*columns, *[F.col(n).alias(c) for n, c in zip(("_ids", "_sha"), added)])


def decode(
    encoded: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded", remembered: int = 250_000
) -> DataFrame:
    """`encoded` with a binary column `decoded`, the bytes of its ids (null ids: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(ranks_path, pattern, remembered)
        for batch in batches:
            found = [encoder.decode(np.array(v.as_py() or [], np.int64)) for v in batch.column("_ids")]
            yield pa.RecordBatch.from_arrays([batch.column("_doc"), pa.array(found, pa.binary())], names=["_doc", "_decoded"])

    kept = [c for c in encoded.columns if c != decoded]
    packed = encoded.select(F.struct(*kept).alias("_doc"), F.col(ids).alias("_ids"))
    kind = packed.schema["_doc"].dataType.simpleString()
    out = packed.mapInArrow(run, f"_doc {kind}, _decoded binary")
    return out.select("_doc.*", F.col("_decoded").alias(decoded))


def encode_digests(
    docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
    remembered: int = 500_000,
) -> DataFrame:
    """Per row: doc_id, n_tokens, and SHA-256 of the ids and of the bytes decoded from them.

    A null or empty text has no ids: both digests are those of the empty string.
    Repeated rows and null doc_ids stay rows of their own; other columns are not
    read. A text of any length is encoded in time in proportion to it. No
    shuffle: every row is encoded where it is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(ranks_path, pattern, remembered)
        for batch in batches:
            counts, hashed, decoded = [], [], []
            for ids in encoder.encode_many([t or "" for t in batch.column("_text").to_pylist()]):
                counts.append(len(ids))
                hashed.append(hashlib.sha256(encoder.decimal(ids).encode()).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(counts, pa.int64()), pa.array(hashed, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
