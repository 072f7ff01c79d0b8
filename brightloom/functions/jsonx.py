"""JSON objects inside free text, as VARIANT columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brightloom.functions.binding import let
from brightloom.functions.maths import clamp
from brightloom.functions.text import blank_if_null

# The scores an evaluator reports and the texts of the schema check.
SCORE_FIELDS = (
    "relevance", "accuracy", "clarity", "completeness", "instruction_following",
    "format_compliance", "safety", "conciseness", "overall",
)
NOT_AN_OBJECT = "Response is not a valid JSON object."
SCHEMA_SATISFIED = "JSON structure satisfies the configured checks."

_OBJECT_MAP = "map<string,variant>"


def _is_object(value: Column) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit("OBJECT"))


def _parse_whole(text: Column) -> Column:
    """`struct<ok, value>`: is the whole text one JSON value, and which.

    Spark's parser stops after the first value and ignores what follows. The
    text is therefore parsed inside a list and inside an object: trailing text
    breaks at least one of the two, as no character closes both.
    """
    parsed = F.struct(
        F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).alias("listed"),
        F.try_variant_get(
            F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))), "$.v", "variant"
        ).alias("value"),
    )

    def judged(p: Column) -> Column:
        single = F.try_variant_get(p["listed"], "$[1]", "variant").isNull()
        ok = p["listed"].isNotNull() & p["value"].isNotNull() & single
        return F.struct(ok.alias("ok"), p["value"].alias("value"))

    return let(parsed, judged)


def parse_json_object(text: Column) -> Column:
    """The JSON object a text is or holds, as VARIANT; null if there is none.

    A text that is valid JSON of another kind gives null. Otherwise the span
    from the first `{` to the last `}` is tried. NaN literals and objects with
    a repeated key are not accepted by the parser and give null.
    """

    def object_or_null(found: Column) -> Column:
        return F.when(found["ok"] & _is_object(found["value"]), found["value"])

    def inner_object(value: Column) -> Column:
        inner = F.regexp_extract(value, r"(?s)\{.*\}", 0)
        return let(inner, lambda span: F.when(span != "", let(_parse_whole(span), object_or_null)))

    def outer(value: Column) -> Column:
        # Without a brace there is no object to look for.
        searched = let(
            _parse_whole(value),
            lambda whole: F.when(whole["ok"], object_or_null(whole)).otherwise(inner_object(value)),
        )
        return F.when(F.contains(value, F.lit("{")), searched)

    return let(blank_if_null(text), outer)


def object_entries(obj: Column) -> Column:
    """Top-level keys and values of an object as map<string,variant>."""
    return obj.cast(_OBJECT_MAP)


def has_json_type(value: Column, expected: Column) -> Column:
    """Does a VARIANT have the named type? JSON null has none; unknown names pass.

    Whole numbers read as BIGINT, or DECIMAL(p,0) beyond 18 digits; `1.0` reads
    as a short DECIMAL(p,0) and is no integer.
    """
    kind = F.schema_of_variant(value)
    integer = (kind == "BIGINT") | kind.rlike(r"^DECIMAL\((19|[2-3][0-9]),0\)$")
    number = integer | kind.rlike(r"^(DECIMAL|DOUBLE|FLOAT)")
    return (
        F.when(expected == "string", kind == "STRING")
        .when(expected == "number", number)
        .when(expected == "integer", integer)
        .when(expected == "boolean", kind == "BOOLEAN")
        .when(expected == "array", F.startswith(kind, F.lit("ARRAY")))
        .when(expected == "object", F.startswith(kind, F.lit("OBJECT")))
        .otherwise(F.lit(True))
    )


def validate_json_schema(obj: Column, required: Column, properties: Column) -> Column:
    """`struct<passed, detail>`: first missing required key, then first wrong type."""
    required = F.coalesce(required, F.array().cast("array<string>"))
    rules = F.map_entries(F.coalesce(properties, F.create_map().cast("map<string,string>")))

    def faults(entries: Column) -> Column:
        missing = F.get(F.filter(required, lambda key: ~F.map_contains_key(entries, key)), 0)
        wrong = F.get(
            F.filter(
                rules,
                lambda rule: F.map_contains_key(entries, rule["key"])
                & ~has_json_type(F.try_element_at(entries, rule["key"]), rule["value"]),
            ),
            0,
        )["key"]
        return F.struct(missing.alias("missing"), wrong.alias("wrong"))

    def message(fault: Column) -> Column:
        wrong = fault["wrong"]
        single = F.contains(wrong, F.lit("'")) & ~F.contains(wrong, F.lit('"'))
        quote = F.when(single, '"').otherwise("'")
        return (
            F.when(fault["missing"].isNotNull(), F.concat(F.lit("Missing required field: "), fault["missing"]))
            .when(
                wrong.isNotNull(),
                F.concat(F.lit("Field "), quote, wrong, quote, F.lit(" has the wrong type.")),
            )
            .otherwise(SCHEMA_SATISFIED)
        )

    def verdict(value: Column) -> Column:
        checked = let(let(object_entries(value), faults), message)
        detail = F.when(value.isNull(), NOT_AN_OBJECT).otherwise(checked)
        return let(detail, lambda d: F.struct((d == SCHEMA_SATISFIED).alias("passed"), d.alias("detail")))

    return let(obj, verdict)


def score_from_object(obj: Column) -> Column:
    """Evaluator JSON as a score struct: nine numbers held in 0-10, bad ones 0."""

    def score(value: Column, name: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(value, f"$.{name}", "variant"))
        number = F.try_variant_get(value, f"$.{name}", "double")
        truth = F.try_variant_get(value, f"$.{name}", "boolean").cast("double")
        read = F.when(kind == "BOOLEAN", truth).otherwise(number)
        return clamp(F.coalesce(read, F.lit(0.0)), 0.0, 10.0).alias(name)

    def scores(value: Column) -> Column:
        return F.struct(
            *[score(value, name) for name in SCORE_FIELDS],
            F.coalesce(F.try_variant_get(value, "$.reason", "string"), F.lit("")).alias("reason"),
            F.lit("model-based").alias("evaluator_mode"),
        )

    return let(obj, scores)
