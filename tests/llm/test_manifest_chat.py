"""Merkle manifests and chat windows against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import public_tokenizers

from brightloom.llm import bpe, chat, merkle

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return digest(*parts)


def levels_of(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def path_of(levels, at, arity):
    steps = []
    for level in levels[:-1]:
        start = at - at % arity
        steps.append(("".join(level[start:at]), "".join(level[at + 1 : start + arity])))
        at //= arity
    return steps


def checked(rows, arity):
    """(doc_id, source, lang, n_chars, text) rows to the rows of the check."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0], leaf_of(row), row))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        groups[source].sort(key=lambda g: (g[0] is not None, g[0] or 0, g[1]))
        trees[source] = levels_of([leaf for _, leaf, _ in groups[source]], arity)
    crown = levels_of([trees[s][-1][0] for s in sources], arity)
    root, out = crown[-1][0], []
    for place, source in enumerate(sources):
        for at, (doc_id, leaf, row) in enumerate(groups[source]):
            path = path_of(trees[source], at, arity) + path_of(crown, place, arity)
            own = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and row[4] is not None:
                own = leaf_of((*row[:4], "".join(c.lower() if c.isascii() else c for c in row[4])))
            for left, right in path:
                own = digest(left, own, right)
            proof = digest(*[left + right for left, right in path])
            out.append((doc_id, leaf, trees[source][-1][0], root, proof, own, own == root))
    return out


def manifest_rows(spark, rows, arity, keep):
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, idx long, key string")
    return df, merkle.tamper_check(df, arity=arity, keep=keep)


def test_manifest_equals_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, "hot" if i % 3 else rnd.choice([None, "", "é", "a", "b"]), rnd.choice(["en", None]), i, rnd.choice([None, "", f"Té {i}", "low"])) for i in range(700)]
    rows += [(None, "hot", None, None, None)] * 2 + [(5, "hot", "en", 1, "Same")] * 20 + [(9999, "alone", "en", None, "X" * 200_000)]
    for arity, keep in ((16, 2), (3, 2), (2, 3)):
        _, found = manifest_rows(spark, rows, arity, keep)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(checked(rows, arity), key=str)


def test_manifest_of_few_rows(spark):
    for rows in ([(1, "a", "en", 1, "A")], [(1, None, None, None, None)] * 2, [(i, f"s{i}", "x", 1, "T") for i in range(40)]):
        _, found = manifest_rows(spark, rows, 16, 2)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(checked(rows, 16), key=str)
    df, _ = manifest_rows(spark, rows, 16, 2)
    assert merkle.tamper_check(df.limit(0)).count() == 0


def test_turns_survive_the_template():
    rnd = random.Random(4)
    bits = ["\\", "<turn>", "</turn>", "\n", "n", "<", "</", "turn>", "a", "é", "### Assistant:"]
    for _ in range(3000):
        said = [("".join(rnd.choices(bits, k=rnd.randint(0, 6))), "".join(rnd.choices(bits, k=rnd.randint(0, 12)))) for _ in range(3)]
        assert chat.read_turns("".join(chat.format_turn(*t) for t in said)) == said


def talk(turns):
    """What the contract asks of one conversation's turns."""
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    lost = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), digest(said), len(lost), digest(lost))


def test_windows_hold_every_turn_once(spark):
    rnd = random.Random(5)
    words = ["hello", "\\</turn>", "<turn>", "Été", "x\ny", "some", "words"]
    rows = []
    for conv in range(30):
        for turn in range(rnd.randint(1, 25) if conv else 300):
            role = "system" if turn == 0 and conv % 2 else rnd.choice(["user", "assistant"])
            rows.append((conv, turn, role, " ".join(rnd.choices(words, k=rnd.randint(0, 30)))))
    rows += [(500, 0, "user", None), (500, 1, None, "x"), (500, None, "assistant", ""), (None, 0, "system", "only"), (501, 0, "assistant", "long " * 40_000)]
    rows += [(502, 1, "assistant", "tie"), (502, 1, "assistant", "tie"), (502, 1, "user", "tie")]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, segment long, piece string")
    wins = chat.windows(df, RANKS, public_tokenizers.PATTERN, budget=120, history_tokens=40, history_turns=3, segment_turns=16)
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    expected = {conv: talk([t[2:] for t in sorted(turns)]) for conv, turns in groups.items()}
    found = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(wins).collect()}
    assert found == expected
    encoder, over, repeats = bpe.text_encoder(RANKS, public_tokenizers.PATTERN, 100_000), 0, 0
    for r in wins.collect():
        turns = chat.read_turns(r["text"])
        tokens = [len(encoder.encode(chat.format_turn(*t))) for t in turns]
        assert len(turns) == r["turns"] and sum(tokens) == r["tokens"]
        system = turns[0][0] == "system"
        new = len(turns) - r["repeated"]
        if sum(tokens) > 120:
            over += 1
            assert new - (system and r["repeated"] == 0) <= 1
        history = tokens[system : r["repeated"]] if r["repeated"] else []
        assert sum(history) <= 40 and len(history) <= 3
        repeats += len(history)
        if r["conv_id"] is not None and r["conv_id"] < 30 and r["conv_id"] % 2:
            assert system
        targets = [t for role, t in turns[r["repeated"] :] if role == "assistant"]
        assert [chat.unescaped(r["text"][s["start"] : s["stop"]]) for s in r["loss"]] == targets
    assert over and repeats > 50
    assert wins.filter("conv_id = 0").count() >= 300 // 16
    empty = chat.windows(df.limit(0), RANKS, public_tokenizers.PATTERN)
    assert empty.count() == 0 == chat.read_back(empty).count()


def test_windows_do_not_follow_partitions(spark):
    rows = [(i % 3, i, "user" if i % 2 else "assistant", f"turn {i} " * (i % 9)) for i in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = [
        sorted(map(str, chat.windows(d, RANKS, public_tokenizers.PATTERN, budget=100, segment_turns=10).collect()))
        for d in (df.repartition(7), df.coalesce(1))
    ]
    assert made[0] == made[1]
