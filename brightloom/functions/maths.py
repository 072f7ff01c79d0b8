"""Guarded arithmetic, lenient casts, banding and date helpers over columns.

A calculation returns `struct<result double, error string>`: a bad row carries
an error text and the job goes on.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Error texts of the guarded operations.
DIVIDE_BY_ZERO = "Cannot divide by zero."
MODULUS_BY_ZERO = "Cannot use zero."
NEGATIVE_ROOT = "Square root of a negative number is not real."
NEGATIVE_FACTORIAL = "Factorial cannot be negative."
NOT_WHOLE = "Enter a whole number only."
LOG_NOT_POSITIVE = "Log requires a positive number."
LN_NOT_POSITIVE = "Natural log requires a positive number."
INVALID_NUMBER = "Invalid number."
POWER_UNDEFINED = "Power is not a finite real number."
FACTORIAL_TOO_LARGE = "Number has more digits than an integer column holds."

# Grade bands from the highest down. Above 90 is A1; every other
# bound is inclusive; a number below the last bound gets LOWEST_GRADE.
GRADE_ABOVE_90 = ("A1", "Hurray! 🎉 You achieved A1!")
GRADE_BANDS = (
    (80, "A2", "Excellent! You achieved A2!"),
    (70, "B1", "Very Good! You achieved B1!"),
    (60, "B2", "Good Job! You achieved B2!"),
    (50, "C1", "Good Job! You achieved C1!"),
    (40, "C2", "Good Job! You achieved C2!"),
    (30, "D1", "Good Job! You achieved D1!"),
    (20, "D2", "D2"),
    (10, "E1", "E1 I think now you gonna regret"),
)
LOWEST_GRADE = ("lowest", "Good Luck for the next time!")
OUT_OF_RANGE = ("invalid", "Please enter a percentage between 0 and 100.")
NOT_A_NUMBER = ("invalid", "Invalid input! Please enter a valid number.")

_WHOLE = r"^\s*[+-]?\d+\s*$"
_INFINITY = float("inf")
_LIMB = 10**9


def _answer(result: Column, *guards: tuple[Column, str]) -> Column:
    """The result struct; the first guard that holds gives the error text."""
    error = F.lit(None).cast("string")
    for broken, message in reversed(guards):
        error = F.when(broken, F.lit(message)).otherwise(error)
    return F.struct(
        F.when(error.isNull(), result.cast("double")).alias("result"), error.alias("error")
    )


def _bad(*values: Column) -> Column:
    missing = F.lit(False)
    for value in values:
        missing = missing | value.isNull()
    return missing


def add(a: Column, b: Column) -> Column:
    return _answer(a + b, (_bad(a, b), INVALID_NUMBER))


def subtract(a: Column, b: Column) -> Column:
    return _answer(a - b, (_bad(a, b), INVALID_NUMBER))


def multiply(a: Column, b: Column) -> Column:
    return _answer(a * b, (_bad(a, b), INVALID_NUMBER))


def divide(a: Column, b: Column) -> Column:
    return _answer(F.try_divide(a, b), (_bad(a, b), INVALID_NUMBER), (b == 0, DIVIDE_BY_ZERO))


def power(a: Column, b: Column) -> Column:
    raised = F.pow(a, b)
    finite = ~F.isnan(raised) & (F.abs(raised) != F.lit(_INFINITY))
    return _answer(raised, (_bad(a, b), INVALID_NUMBER), (~finite, POWER_UNDEFINED))


def square_root(a: Column) -> Column:
    return _answer(F.sqrt(a), (_bad(a), INVALID_NUMBER), (a < 0, NEGATIVE_ROOT))


def percentage(number: Column, percent: Column) -> Column:
    return _answer(number * percent / F.lit(100.0), (_bad(number, percent), INVALID_NUMBER))


def modulus(a: Column, b: Column) -> Column:
    """Remainder with the sign of the divisor (7 and -3 give -2)."""
    rest = F.try_mod(a, b)
    signed = F.when((rest != 0) & (F.signum(rest) != F.signum(b)), rest + b).otherwise(rest)
    return _answer(signed + F.lit(0.0), (_bad(a, b), INVALID_NUMBER), (b == 0, MODULUS_BY_ZERO))


def _times(limbs: Column, factor: Column) -> Column:
    """A number in base 10^9, lowest digits first, times a factor below 10^9."""
    state = F.struct(F.array().cast("array<bigint>").alias("done"), F.lit(0).cast("bigint").alias("carry"))

    def step(acc: Column, limb: Column) -> Column:
        product = limb * factor + acc["carry"]
        return F.struct(
            F.concat(acc["done"], F.array(product % _LIMB)).alias("done"),
            F.call_function("div", product, F.lit(_LIMB)).alias("carry"),
        )

    return F.aggregate(
        limbs, state, step, lambda acc: F.when(acc["carry"] > 0, F.concat(acc["done"], F.array(acc["carry"]))).otherwise(acc["done"])
    )


def factorial(text: Column) -> Column:
    """`struct<result string, error>` for a whole number written as text, of any size.

    The product of 2..n is built per row in limbs of nine digits; work and length
    grow with the digits of the result.
    """
    whole = text.cast("string").rlike(_WHOLE)
    n = F.trim(text.cast("string")).try_cast("int")
    one = F.array(F.lit(1).cast("bigint"))
    product = F.aggregate(
        F.sequence(F.lit(2), F.when(n >= 2, n)), one, lambda limbs, x: _times(limbs, x.cast("bigint"))
    )
    digits = F.transform(F.reverse(product), lambda limb, i: F.when(i == 0, limb.cast("string")).otherwise(F.lpad(limb.cast("string"), 9, "0")))
    error = (
        F.when(text.isNull() | ~whole, NOT_WHOLE)
        .when(F.trim(text.cast("string")).startswith("-") & F.coalesce(n != 0, F.lit(True)), NEGATIVE_FACTORIAL)
        .when(n.isNull(), FACTORIAL_TOO_LARGE)
    )
    return F.struct(
        F.when(error.isNull(), F.when(n <= 1, F.lit("1")).otherwise(F.array_join(digits, ""))).alias("result"),
        error.alias("error"),
    )


def sine(degrees: Column) -> Column:
    return _answer(F.sin(F.radians(degrees)), (_bad(degrees), INVALID_NUMBER))


def cosine(degrees: Column) -> Column:
    return _answer(F.cos(F.radians(degrees)), (_bad(degrees), INVALID_NUMBER))


def tangent(degrees: Column) -> Column:
    return _answer(F.tan(F.radians(degrees)), (_bad(degrees), INVALID_NUMBER))


def log10(a: Column) -> Column:
    return _answer(F.log10(a), (_bad(a), INVALID_NUMBER), (a <= 0, LOG_NOT_POSITIVE))


def natural_log(a: Column) -> Column:
    return _answer(F.ln(a), (_bad(a), INVALID_NUMBER), (a <= 0, LN_NOT_POSITIVE))


def log1p_clipped(value: Column) -> Column:
    """log(1 + x) with negative x taken as 0."""
    return F.log1p(F.greatest(value.cast("double"), F.lit(0.0)))


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; NaN becomes `high` because Spark sorts it last."""
    return F.greatest(F.lit(float(low)), F.least(value.cast("double"), F.lit(float(high))))


def safe_float(value: Column, default: float = 0.0) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(float(default)))


def safe_int(value: Column, default: int = 0, is_text: bool = True) -> Column:
    """Whole number or the default; text with a fraction counts as bad, a number is cut."""
    if is_text:
        whole = F.when(value.rlike(_WHOLE), F.trim(value).try_cast("long"))
    else:
        whole = value.try_cast("long")
    return F.coalesce(whole, F.lit(default).cast("long"))


def calculation_text(left: Column, sign: str, right: Column, result: Column) -> Column:
    """History line such as `2.0 + 3.0 = 5.0`."""
    return F.concat(
        left.cast("string"), F.lit(f" {sign} "), right.cast("string"), F.lit(" = "), result.cast("string")
    )


def request_cost(
    input_tokens: Column, output_tokens: Column, input_per_1k: Column, output_per_1k: Column
) -> Column:
    """Null as soon as one part is null."""
    thousand = F.lit(1000.0)
    return input_tokens / thousand * input_per_1k + output_tokens / thousand * output_per_1k


def normalize_weights(weights: Mapping[str, float]) -> dict[str, float]:
    """Shares of the non-negative weights; all equal when nothing is positive."""
    kept = {name: max(0.0, float(value)) for name, value in weights.items()}
    total = sum(kept.values())
    if total <= 0:
        return {name: 1.0 / len(kept) for name in kept}
    return {name: value / total for name, value in kept.items()}


def normalize_weight_map(weights: Column) -> Column:
    """The same over a map<string,double> column."""
    floor = F.transform_values(weights, lambda _, w: F.greatest(w, F.lit(0.0)))
    total = F.aggregate(F.map_values(floor), F.lit(0.0), lambda acc, w: acc + w)
    equal = F.lit(1.0) / F.size(weights)
    return F.transform_values(floor, lambda _, w: F.when(total <= 0, equal).otherwise(w / total))


def grade_band(value: Column) -> Column:
    """`struct<grade, message>` of a percentage. 90 itself is A2; NaN is the lowest band."""
    number = value.try_cast("double")

    def pick(part: int) -> Column:
        band = (
            F.when(number.isNull(), NOT_A_NUMBER[part])
            .when(F.isnan(number), LOWEST_GRADE[part])
            .when((number < 0) | (number > 100), OUT_OF_RANGE[part])
            .when(number > 90, GRADE_ABOVE_90[part])
        )
        for bound, grade, message in GRADE_BANDS:
            band = band.when(number >= bound, (grade, message)[part])
        return band.otherwise(LOWEST_GRADE[part])

    return F.struct(pick(0).alias("grade"), pick(1).alias("message"))


def utc_iso(moment: Column) -> Column:
    """ISO-8601 text of a UTC timestamp with microseconds."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def epoch_seconds(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp")) / F.lit(1e6)
