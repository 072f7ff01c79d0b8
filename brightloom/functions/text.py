"""Text functions over string columns.

Every function takes and returns Columns built from Spark SQL functions, so
they stay in the JVM and work on batch and streaming frames alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python counts as white space and as a line break. Java's
# own \s and \R leave out the separators 0x1c-0x1f.
SPACE = r"(?U)[\s\x1c-\x1f\x85]"
NON_SPACE = r"(?U)[^\s\x1c-\x1f\x85]"
LINE_BREAK = r"\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85  ]"

# Secret labels, instruction verbs and ignored explanation words.
SECRET_LABEL = r"(?i)(api[_-]?key|secret|password|token)\s*[:=]"
INSTRUCTION_VERBS = (
    "explain", "summarize", "compare", "list", "analyze", "return", "create", "describe",
)
NOT_CONFIGURED = "<not configured>"
SHORT_SECRET = "***"
DEFAULT_SLUG = "item"

_BULLET = r"(?U)^[\s\x1c-\x1f]*(?:[-*+]|\d+[.)])[\s\x1c-\x1f]+"
_PLACEHOLDER = r"\{\{|\}\}|\{[^{}]*\}|\{|\}"
# name, conversion, fill, alignment, zero, width, precision of a field.
_FIELD = r"(?s)^\{([^{}.:!\[\]]*)(!s)?(?::(?:([^{}])?([<>^]))?(0)?([0-9]*)(?:\.([0-9]+))?s?)?\}$"


def blank_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    """Remove white space of every kind from both ends (`trim` knows only blanks)."""
    return F.regexp_replace(text, rf"(?U)^[\s\x1c-\x1f\x85]+|[\s\x1c-\x1f\x85]+\z", "")


def is_blank(text: Column) -> Column:
    return ~blank_if_null(text).rlike(NON_SPACE)


def clean_text(text: Column) -> Column:
    """Lower case, ASCII letters and digits only, single blanks, no outer blanks."""
    kept = F.regexp_replace(F.lower(blank_if_null(text)), r"(?U)[^a-z0-9\s\x1c-\x1f]", " ")
    return strip(F.regexp_replace(kept, rf"{SPACE}+", " "))


def normalize_title(text: Column) -> Column:
    """Matching key of a title. Stripping comes first, so "Hello!" keeps a final blank."""
    kept = F.regexp_replace(strip(F.lower(text)), r"(?U)[^a-z0-9\s\x1c-\x1f]", " ")
    return F.regexp_replace(kept, rf"{SPACE}+", " ")


def tokens(text: Column) -> Column:
    """White-space separated pieces without empty ones."""
    return F.filter(F.split(blank_if_null(text), rf"{SPACE}+"), lambda piece: piece != "")


def lines(text: Column) -> Column:
    """Lines of a text; a trailing line break does not open another line."""
    pieces = F.split(blank_if_null(text), LINE_BREAK)
    size = F.size(pieces)
    closed = F.element_at(pieces, -1) == ""
    return F.slice(pieces, F.lit(1), F.when(closed, size - 1).otherwise(size))


def word_count(text: Column) -> Column:
    return F.regexp_count(blank_if_null(text), F.lit(rf"{NON_SPACE}+")).cast("long")


def line_count(text: Column) -> Column:
    """Number of lines that hold more than white space."""
    kept = F.filter(F.split(blank_if_null(text), LINE_BREAK), lambda line: line.rlike(NON_SPACE))
    return F.size(kept).cast("long")


def character_count(text: Column) -> Column:
    return F.length(blank_if_null(text)).cast("long")


def approximate_token_count(text: Column) -> Column:
    """One token per started group of four characters."""
    return F.ceil(F.length(blank_if_null(text)) / F.lit(4)).cast("long")


def slugify(text: Column) -> Column:
    joined = F.regexp_replace(strip(text), r"[^A-Za-z0-9._-]+", "_")
    trimmed = F.regexp_replace(joined, r"^[._-]+|[._-]+\z", "")
    return F.when(trimmed == "", DEFAULT_SLUG).otherwise(trimmed)


def stable_hash(**fields: Column) -> Column:
    """SHA-256 of the fields as JSON with sorted keys, `", "` and `": "` between them.

    Nulls are written out, so a null and an absent field give different keys.
    """

    def member(name: str) -> Column:
        alone = F.to_json(F.struct(fields[name].alias("v")), {"ignoreNullFields": "false"})
        value = F.substring(alone, F.lit(6), F.length(alone) - 6)
        return F.concat(F.lit(f'"{name}": '), value)

    members = F.array_join(F.array(*[member(name) for name in sorted(fields)]), ", ")
    return F.sha2(F.concat(F.lit("{"), members, F.lit("}")), 256)


def redact_secret(text: Column) -> Column:
    return (
        F.when(blank_if_null(text) == "", NOT_CONFIGURED)
        .when(F.length(text) <= 6, SHORT_SECRET)
        .otherwise(F.concat(F.left(text, F.lit(3)), F.lit("..."), F.right(text, F.lit(3))))
    )


def contains_case_insensitive(text: Column, phrase: Column) -> Column:
    return F.contains(F.lower(blank_if_null(text)), F.lower(phrase))


def count_bullets(text: Column) -> Column:
    """Lines that open with a dash, star, plus or number mark and then a blank."""
    marked = F.filter(lines(text), lambda line: line.rlike(_BULLET))
    return F.size(marked).cast("long")


def _padded(value: Column, mark: Column) -> Column:
    """A value cut and filled as the field's format says; null where its numbers are out of range."""

    def part(group: int) -> Column:
        return F.regexp_extract(mark, _FIELD, group)

    cut = F.when(part(7) == "", value).otherwise(F.substring(value, F.lit(1), part(7).try_cast("int")))
    fill = F.when(part(3) != "", part(3)).when(part(5) != "", "0").otherwise(" ")
    width = F.when(part(6) == "", 0).otherwise(part(6).try_cast("int"))
    missing = F.when(width.isNotNull(), F.greatest(width - F.length(cut), F.lit(0)))
    before = F.when(part(4) == ">", missing).when(part(4) == "^", F.floor(missing / 2).cast("int")).otherwise(0)
    return F.concat(F.repeat(fill, before), cut, F.repeat(fill, missing - before))


def render(text: Column, variables: Column) -> Column:
    """Fill `{name}`, `{name!s}` and `{name:fill align width .precision}` from a map of strings, all or nothing.

    Doubled braces stand for one brace. If a name is missing, a brace is left
    over, or a field uses attributes, indexes, other conversions, formats that
    strings do not have, or positions, the text comes back unchanged. A null value
    is `None`, which takes a format only after `!s`. Filled values are never scanned
    again, so a value that holds `{b}` stays as it is.
    """
    marks = F.regexp_extract_all(text, F.lit(_PLACEHOLDER), F.lit(0))
    pieces = F.split(text, _PLACEHOLDER)

    def name_of(mark: Column) -> Column:
        return F.regexp_extract(mark, _FIELD, 1)

    def own(mark: Column) -> Column:
        return F.try_element_at(variables, name_of(mark))

    def value_of(mark: Column) -> Column:
        return (
            F.when(mark == "{{", "{")
            .when(mark == "}}", "}")
            .otherwise(F.when(mark.contains(":"), _padded(F.coalesce(own(mark), F.lit("None")), mark)).otherwise(F.coalesce(own(mark), F.lit("None"))))
        )

    def usable(mark: Column) -> Column:
        field = mark.rlike(_FIELD) & ~name_of(mark).rlike("^[0-9]*$") & F.map_contains_key(variables, name_of(mark))
        formatted = own(mark).isNotNull() | ~mark.contains(":") | mark.endswith(":}") | mark.contains("!s")
        return mark.isin("{{", "}}") | (field & formatted & value_of(mark).isNotNull())

    tail = F.slice(pieces, F.lit(2), F.size(marks))
    filled = F.zip_with(marks, tail, lambda mark, piece: F.concat(value_of(mark), piece))
    whole = F.concat(F.element_at(pieces, 1), F.array_join(filled, ""))
    return F.when(F.forall(marks, usable), whole).otherwise(text)


def unicode_words(text: Column) -> Column:
    """Runs of letters, digits and underscores in any script."""
    return F.regexp_extract_all(blank_if_null(text), F.lit(r"(?U)\b\w+\b"), F.lit(0))


def text_stats(text: Column) -> Column:
    """Struct of characters, words, lines, sentences, unique words and mean word length."""
    words = unicode_words(text)
    sentences = F.filter(F.split(blank_if_null(text), r"[.!?]+"), lambda s: s.rlike(NON_SPACE))
    letters = F.aggregate(words, F.lit(0).cast("long"), lambda acc, w: acc + F.length(w))
    return F.struct(
        character_count(text).alias("characters"),
        F.size(words).cast("long").alias("words"),
        F.size(lines(text)).cast("long").alias("lines"),
        F.size(sentences).cast("long").alias("sentences"),
        F.size(F.array_distinct(F.transform(words, F.lower))).cast("long").alias("unique_words"),
        F.coalesce(F.try_divide(letters.cast("double"), F.size(words)), F.lit(0.0)).alias(
            "average_word_length"
        ),
    )


def inspect_prompt(text: Column) -> Column:
    """Struct of what a prompt holds: placeholders, variables, questions, instructions."""
    value = blank_if_null(text)
    verbs = rf"(?i)\b({'|'.join(INSTRUCTION_VERBS)})\b"
    variable = r"(?U)\{\s*([A-Za-z_]\w*)\s*\}"
    return F.struct(
        (~is_blank(text)).alias("has_text"),
        character_count(text).alias("characters"),
        F.regexp_extract_all(value, F.lit(r"\{([^\n]*?)\}"), F.lit(1)).alias("placeholders"),
        F.regexp_extract_all(value, F.lit(variable), F.lit(1)).alias("variables"),
        F.regexp_count(value, F.lit(r"\?")).cast("long").alias("question_marks"),
        F.regexp_count(value, F.lit(verbs)).cast("long").alias("instruction_words"),
        approximate_token_count(text).alias("estimated_tokens"),
    )


def has_secret_label(text: Column) -> Column:
    return blank_if_null(text).rlike(SECRET_LABEL)


def secret_scan(text: Column) -> Column:
    """Struct of the secret finding and a preview that is safe to show."""
    value = blank_if_null(text)
    found = has_secret_label(text)
    return F.struct(
        found.alias("contains_secret_label"),
        F.when(found, redact_secret(value)).otherwise(F.left(value, F.lit(80))).alias(
            "redacted_preview"
        ),
        (~found).alias("safe_to_log"),
    )


def describe_value(value: Column, is_container: bool) -> Column:
    """Struct of presence, type name and text length; containers are known from the schema."""
    written = F.to_json(F.struct(value.alias("v"))) if is_container else value.cast("string")
    return F.struct(
        value.isNotNull().alias("provided"),
        F.typeof(value).alias("type"),
        F.coalesce(F.length(written), F.lit(0)).cast("long").alias("string_length"),
        F.lit(is_container).alias("is_container"),
    )


def content_words(text: Column) -> Column:
    """Distinct lower-case ASCII words of four letters or more."""
    words = F.regexp_extract_all(blank_if_null(text), F.lit(r"[A-Za-z0-9]{4,}"), F.lit(0))
    return F.array_distinct(F.transform(words, F.lower))


def phrase_compliance(text: Column, required: Column) -> Column:
    """Struct of how many required phrases occur in the text."""
    phrases = F.coalesce(required, F.array().cast("array<string>"))
    total = F.size(phrases)
    passed = F.size(F.filter(phrases, lambda p: contains_case_insensitive(text, p)))
    return F.struct(
        passed.cast("long").alias("passed"),
        total.cast("long").alias("total"),
        F.coalesce(F.try_divide(passed.cast("double"), total), F.lit(1.0)).alias("compliance"),
        (passed == total).alias("all_passed"),
    )


def header_key(header: str) -> str:
    """Comparable form of a column header."""
    kept = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in header.strip().lower())
    return "_".join(kept.split())


def literal_strings(values: Iterable[str]) -> Column:
    """An array<string> literal; works for no values too."""
    listed: Sequence[str] = list(values)
    return F.array(*[F.lit(v) for v in listed]).cast("array<string>")
