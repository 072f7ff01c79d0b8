"""Secrets, personal data and quality rules, against plain regular expressions and by hand."""

import hashlib
import random
import re

from brightloom.llm import personal, quality, secrets

DOCUMENTS = "/root/testdata/sf0.001/documents.parquet"


def digest(spans):
    return hashlib.sha256(",".join("%s:%d:%d" % s for s in spans).encode()).hexdigest()


def plain_secrets(text):
    names = ["".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token")] + ["[aA][pP][iI]_?[kK][eE][yY]"]
    assign = "(" + "|".join(names) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [("assign", m.start(), m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_secret_base(spark):
    docs = spark.read.parquet(DOCUMENTS)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in secrets.scan(docs).collect():
        spans = plain_secrets(texts[r["doc_id"]])
        assert r["base_sha256"] == digest(spans)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[0] == k for s in spans) for k in secrets.KINDS]


def test_secret_ownership(spark):
    live, shared = "Qw3rTy9uIoP1aSdF5gHj2Kl", "Zx8cVb6nMq4wEr2tYu7iOp0"
    rows = [(i, f"note {shared} end", f"s{i % 4}", "en") for i in range(8)]
    rows += [(20, f"note {live} end", "s0", "en"), (21, f"again {live}", "s0", "de"), (22, None, None, None), (22, "", "s1", "en")]
    rows += [(30 + i, "Api_Key = 'abcdefgh12' ſecret=abcdefgh12", f"s{i}", "en") for i in range(4)] + [(None, "x" * 200_000, "s1", "en")]
    df = spark.createDataFrame([(*r, "b", 1) for r in rows], "doc_id long, text string, source string, lang string, found string, row int")
    found = secrets.scan(df).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[0]["spans"] == "" and by_id[0]["n_example"] == 1
    assert by_id[20]["spans"] == "token:5:28" and by_id[20]["n_live"] == 1
    assert by_id[30]["spans"] == "assign:0:21" and (by_id[30]["n_example"], by_id[30]["n_live"]) == (1, 0)
    assert by_id[22]["base_sha256"] == digest([]) and by_id[None]["spans"] == ""
    assert secrets.scan(df.limit(0)).count() == 0


def test_secret_repositories(spark):
    """One owner: a value of nine repositories is an example, one of eight, or of one in many documents, is not."""
    values = {"wide": "Qw3rTy9uIoP1aSdF5gHj2Kl", "near": "Zx8cVb6nMq4wEr2tYu7iOp0", "deep": "Lk4jHg6fDs8aPo0iUy2tRe4"}
    rows = [(i, f"a {values['wide']}", "s0", f"r{i}") for i in range(9)]
    rows += [(20 + i, f"a {values['near']} b {values['near']}", "s0", f"r{i}") for i in range(8)]
    rows += [(40 + i, f"a {values['deep']}", "s0", "r0") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    by_id = {r["doc_id"]: r for r in secrets.scan(df).collect()}
    assert (by_id[0]["spans"], by_id[0]["n_example"], by_id[0]["holders"]) == ("", 1, "token:2:25:9:1")
    assert (by_id[20]["n_live"], by_id[20]["holders"]) == (2, "token:2:25:8:1,token:28:51:8:1")
    assert (by_id[40]["spans"], by_id[40]["holders"]) == ("token:2:25", "token:2:25:1:1")


def test_line_limit_is_the_same_for_every_host_size(spark):
    """A line of 60 documents goes from 59 of them in a host of 60 and in one of 3,060, and out of the texts."""
    own = "own{0} words{0} of{0} this{0} text{0} number{0} here{0} are{0} twelve{0} in{0} all{0} kinds{0}"
    rows = [(h * 10_000 + i, f"h{h}", f"Shared  banner LINE\n\n{own.format(i)}\n") for h in (1, 2) for i in range(60)]
    rows += [(30_000 + i, "h2", own.format(f"x{i}")) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    good = {r["doc_id"]: r["text"] for r in quality.keep_good(df).collect()}
    for doc_id, _, text in rows:
        first = doc_id in (10_000, 20_000)
        assert good[doc_id] == (text if first else text.replace("Shared  banner LINE\n", "")), doc_id
    few = spark.createDataFrame([(i, "h", "a banner line of the host\nsix words " + f"w{i} " * 4) for i in range(60)], df.select("doc_id", "source", "text").schema)
    assert [r["doc_id"] for r in quality.keep_good(few).collect()] == [0]


def plain_personal(text):
    found = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        if 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0:
            found.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def test_personal_base(spark):
    docs = spark.read.parquet(DOCUMENTS)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in personal.scan(docs).collect():
        spans = plain_personal(texts[r["doc_id"]])
        assert r["base_sha256"] == digest(spans)
        assert [r[f"n_{k}"] for k in personal.KINDS] == [sum(s[0] == k for s in spans) for k in personal.KINDS]


def test_personal_patterns_of_odd_texts():
    rnd = random.Random(4)
    for _ in range(20_000):
        text = "".join(rnd.choice("ab_.@@0123 -+()x,%") for _ in range(rnd.randint(0, 45)))
        assert personal.base_spans(text) == plain_personal(text)
    text = "4111 1111 1111 1111 a@b.c@d.e 999.1.1.1 1.2.3.004"
    assert personal.base_spans(text) == plain_personal(text) != []
    assert personal.base_spans("1" * 100_000 + "@" * 50_000 + "+" * 1000) == []


def test_personal_discovery(spark):
    rows = [(i, f"please call my number +1 555 {1000 + 37 * i} 22 today or write", "s") for i in range(8)]
    rows += [(20 + i, f"please call my number {550_000 + 41 * i} today or write", "s") for i in range(5)]
    rows += [(40 + i, f"the total was {7000 + i} units in year {1900 + i}", "s") for i in range(9)]
    rows += [(60, None, "s"), (60, None, "s"), (None, "", "s")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, found string, kind int")
    found = personal.scan(df).collect()
    by_id = {r["doc_id"]: r["spans"] for r in found}
    assert len(found) == len(rows)
    assert by_id[0] == "phone:22:36" and by_id[20] == "phone_like:22:28" and by_id[40] == "" and by_id[60] == ""
    assert personal.scan(df.limit(0)).count() == 0


def test_quality_windows(spark):
    texts = ["a b c d e a b c d e", "a b c d e f", "x x x x x x x", "a b c d e f a b c d e f g", "", None, "  a \x1c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: (r["n_words"], r["n_repeat_words"]) for r in quality.statistics(df).collect()}
    assert found == {0: (10, 10), 1: (6, 0), 2: (7, 7), 3: (13, 12), 4: (0, 0), 5: (0, 0), 6: (2, 0)}


def test_quality_common_lines(spark):
    clean = " ".join(f"word{i}" for i in range(30))
    common = "common line of the host with eleven words in it all"
    rows = [(i, f"Common  LINE{common[11:]}\nown{i} two three", "h") for i in range(40)]
    rows += [(100 + i, f"{common}\n{clean} {i}", "h") for i in range(5)]
    rows += [(200, clean, None), (None, clean, "g"), (201, None, "g"), (202, "", "g"), (203, "few words", "g"), (204, clean, "g"), (204, clean, "g")]
    df = spark.createDataFrame([(*r, True, 1) for r in rows], "doc_id long, text string, source string, kept boolean, host int")
    found = quality.judged(df).collect()
    assert len(found) == len(rows)
    kept = sorted(str(r["doc_id"]) for r in found if r["kept"])
    # The first document keeps its line; the other short ones are depleted.
    assert kept == sorted(["0", *[str(100 + i) for i in range(5)], "200", "None", "204", "204"])
    good = quality.keep_good(df)
    assert good.columns == df.columns and good.count() == len(kept)
    assert quality.judged(df.limit(0)).count() == 0
