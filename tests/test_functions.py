"""Text, maths and JSON functions on single values, with the edge rows."""

import hashlib
import json
import math

import pytest
from pyspark.sql import functions as F

from brightloom.functions import jsonx, maths, text


@pytest.mark.parametrize(
    "function, value, expected",
    [
        (text.word_count, "one two three", 3),
        (text.word_count, None, 0),
        (text.word_count, "a\x1cb c", 3),
        (text.line_count, "a\n\n b \n", 2),
        (text.line_count, "a\x1cb", 2),
        (text.character_count, "hé\U0001f389", 3),
        (text.approximate_token_count, "", 0),
        (text.approximate_token_count, "a", 1),
        (text.approximate_token_count, "abcde", 2),
        (text.count_bullets, "- a\n- b\n- c", 3),
        (text.count_bullets, "-\nfoo", 0),
        (text.count_bullets, "1. x\n2) y", 2),
        (text.slugify, "Hello World!", "Hello_World"),
        (text.slugify, " ..!! ", "item"),
        (text.redact_secret, None, "<not configured>"),
        (text.redact_secret, "abcdef", "***"),
        (text.redact_secret, "abcdefg", "abc...efg"),
        (text.normalize_title, "Hello!", "hello "),
        (text.normalize_title, "  The  Film ", "the film"),
        (text.clean_text, None, ""),
        (text.clean_text, "É-A", "a"),
        (text.strip, "\t\n x ", "x"),
        (text.content_words, "Word word four to 12345 cafés", ["word", "four", "12345"]),
    ],
)
def test_text(one, function, value, expected):
    assert one(function, value) == expected


def test_text_stats(one):
    stats = one(text.text_stats, "héllo wörld. Hi!\n")
    assert (stats.words, stats.lines, stats.sentences, stats.unique_words) == (3, 1, 2, 3)
    assert stats.average_word_length == 4.0
    assert one(text.text_stats, "").lines == 0


@pytest.mark.parametrize(
    "template, variables, expected",
    [
        ("Hello {name}", {"name": "Ada"}, "Hello Ada"),
        ("{a} {b}", {"a": "1"}, "{a} {b}"),
        ("{a} {b}", {"a": "{b}", "b": "X"}, "{b} X"),
        ("{{x}} {a}", {"a": "1"}, "{x} 1"),
        ("{{{a}}}", {"a": "1"}, "{1}"),
        ("open {", {}, "open {"),
        ("{0}", {"0": "1"}, "{0}"),
        ("{a:>3}", {"a": "1"}, "  1"),
        ("plain", {}, "plain"),
        ("", {}, ""),
    ],
)
def test_render(one, template, variables, expected):
    assert one(text.render, template, variables, types=["string", "map<string,string>"]) == expected


def test_render_formats_like_python(spark):
    specs = ["", ":", ":5", ":<5", ":>5", ":^5", ":^6", ":*^7", ":<<4", ":05", ":>05", ":x<06", ":.2", ":>6.2", ":.0", ":5s", ":s",
             "!s", "!s:>4", ":1", ":é>4", ": >4"]
    other = [":d", ":+5", ":=5", ":,", "!r", "!x", "[0]", ".name", ":>5.", ":5.2f", ":99999999999"]
    values = {"a": "abc", "e": "", "u": "é漢🙂", "n": None}
    rows = [(f"<{{{name}{spec}}}> {{{{x}}}}",) for name in values for spec in specs + other]
    df = spark.createDataFrame([(r[0], values) for r in rows], "t string, v map<string,string>")
    for row in df.select("t", text.render(F.col("t"), F.col("v")).alias("out")).collect():
        plain = not any(f"{o}}}" in row["t"] for o in other)
        try:
            expected = row["t"].format(**values) if plain else row["t"]
        except TypeError:
            expected = row["t"]
        assert row["out"] == expected, row


def test_inspect_and_secrets(one):
    found = one(text.inspect_prompt, "Explain {a} and list { b }? {c d}")
    assert found.placeholders == ["a", " b ", "c d"] and found.variables == ["a", "b"]
    assert (found.question_marks, found.instruction_words) == (1, 2)
    assert one(text.secret_scan, "API_KEY = 123456").redacted_preview == "API...456"
    safe = one(text.secret_scan, "x" * 100)
    assert safe.safe_to_log and len(safe.redacted_preview) == 80


def test_stable_hash_is_sorted_spaced_json(one):
    made = one(lambda p, t: text.stable_hash(prompt=p, temperature=t, none=F.lit(None).cast("string")),
               'say "é"\n', 0.2, types=["string", "double"])
    wanted = json.dumps({"none": None, "prompt": 'say "é"\n', "temperature": 0.2}, sort_keys=True, ensure_ascii=False)
    assert made == hashlib.sha256(wanted.encode()).hexdigest()


def test_phrase_compliance(one):
    types = ["string", "array<string>"]
    half = one(text.phrase_compliance, "One Two", ["one", "three"], types=types)
    assert (half.passed, half.total, half.compliance, half.all_passed) == (1, 2, 0.5, False)
    empty = one(text.phrase_compliance, "x", None, types=types)
    assert (empty.compliance, empty.all_passed) == (1.0, True)


@pytest.mark.parametrize(
    "value, grade",
    [("90", "A2"), ("90.01", "A1"), ("100", "A1"), ("100.01", "invalid"), ("-1", "invalid"), ("9.9", "lowest"),
     ("abc", "invalid"), ("NaN", "lowest"), ("20", "D2"), ("10", "E1"), (None, "invalid")],
)
def test_grade_band(one, value, grade):
    assert one(maths.grade_band, value).grade == grade


@pytest.mark.parametrize(
    "function, values, expected",
    [
        (maths.add, (1.0, 2.0), (3.0, None)),
        (maths.divide, (1.0, 0.0), (None, "Cannot divide by zero.")),
        (maths.modulus, (7.0, -3.0), (-2.0, None)),
        (maths.modulus, (-7.0, 3.0), (2.0, None)),
        (maths.modulus, (1.0, 0.0), (None, "Cannot use zero.")),
        (maths.power, (0.0, -1.0), (None, maths.POWER_UNDEFINED)),
        (maths.power, (-8.0, 0.5), (None, maths.POWER_UNDEFINED)),
        (maths.square_root, (-1.0,), (None, maths.NEGATIVE_ROOT)),
        (maths.log10, (0.0,), (None, maths.LOG_NOT_POSITIVE)),
        (maths.percentage, (50.0, 10.0), (5.0, None)),
        (maths.add, (None, 1.0), (None, "Invalid number.")),
    ],
)
def test_guarded_maths(one, function, values, expected):
    assert tuple(one(function, *values, types=["double"] * len(values))) == expected


@pytest.mark.parametrize("written", ["0", "1", "20", "21", "33", "34", "100", "449", "1000"])
def test_factorial(one, written):
    assert int(one(maths.factorial, written).result) == math.factorial(int(written))


@pytest.mark.parametrize(
    "written, error",
    [("-1", maths.NEGATIVE_FACTORIAL), ("5.0", maths.NOT_WHOLE), ("9" * 30, maths.FACTORIAL_TOO_LARGE), ("x", maths.NOT_WHOLE)],
)
def test_factorial_errors(one, written, error):
    assert one(maths.factorial, written).error == error


def test_small_maths(one):
    assert one(lambda v: maths.clamp(v, 0, 10), float("nan"), types=["double"]) == 10.0
    assert one(lambda v: maths.safe_int(v, 3), "3.5") == 3
    assert one(lambda v: maths.safe_int(v), " 12 ") == 12
    assert one(lambda v: maths.safe_float(v, 1.5), "x") == 1.5
    assert one(lambda v: F.bround(v, 2), 0.125, types=["double"]) == 0.12
    assert maths.normalize_weights({"a": 2, "b": -1, "c": 2}) == {"a": 0.5, "b": 0.0, "c": 0.5}
    assert maths.normalize_weights({"a": 0, "b": -1}) == {"a": 0.5, "b": 0.5}
    cost = one(maths.request_cost, 100, 100, None, 1.0, types=["int", "int", "double", "double"])
    assert cost is None


@pytest.mark.parametrize(
    "value, expected",
    [
        ('prefix {"name": "Ada"} suffix', {"name": "Ada"}),
        ("[1]", None),
        ('{"a":1} {"b":2}', None),
        ('{"a":1} x', {"a": 1}),
        ('{"a":1}]', {"a": 1}),
        ('[{"a":1}]', None),
        ('  {"a":{"b":[1,2]}}  ', {"a": {"b": [1, 2]}}),
        ("", None),
        (None, None),
        ("{", None),
        ('"text {}"', None),
    ],
)
def test_parse_json_object(one, value, expected):
    found = one(lambda t: F.to_json(jsonx.parse_json_object(t)), value)
    assert (json.loads(found) if found else None) == expected


@pytest.mark.parametrize(
    "value, kind, passed",
    [
        ('{"name":"Ada"}', "string", True), ('{"name":true}', "number", False), ('{"name":1.0}', "integer", False),
        ('{"name":1}', "number", True), ('{"name":null}', "string", False), ('{"name":[1]}', "array", True),
        ('{"name":{}}', "object", True), ('{"name":false}', "boolean", True), ('{"name":1}', "other", True),
        ('{"x":1}', "string", False),
        ('{"name":12345678901234567890}', "integer", True),
    ],
)
def test_json_schema(one, value, kind, passed):
    def check(t, k):
        return jsonx.validate_json_schema(jsonx.parse_json_object(t), F.array(F.lit("name")), F.create_map(F.lit("name"), k))

    assert one(check, value, kind).passed is passed


def test_score_from_object(one):
    reply = '{"relevance": 12, "accuracy": "7.5", "clarity": "bad", "safety": true, "reason": "ok"}'
    score = one(lambda t: jsonx.score_from_object(jsonx.parse_json_object(t)), reply)
    assert (score.relevance, score.accuracy, score.clarity, score.safety, score.overall) == (10.0, 7.5, 0.0, 1.0, 0.0)
    assert score.reason == "ok"
