"""Column expressions: codes, labels, numbers, rounding, messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the label of a missing category.
UNKNOWN = "Inconnu"


def pad_code(code: Column, width: int = 5) -> Column:
    """Zero-padded code; a longer one stays whole. Numbers read as doubles lose their exponent and trailing ``.0``."""
    text = code.cast("string")
    whole = text.try_cast("double").try_cast(T.DecimalType(38, 0)).cast("string")
    text = F.when(F.regexp_like(text, F.lit(r"^-?[0-9]\.[0-9]+E[0-9]+$")), F.coalesce(whole, text)).otherwise(text)
    text = F.regexp_replace(text, r"\.0$", "")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def normalise_label(label: Column) -> Column:
    return F.upper(F.trim(label))


def fill_unknown(label: Column, unknown: str = UNKNOWN) -> Column:
    """Null becomes the unknown label; an empty string is a value and stays."""
    return F.coalesce(label, F.lit(unknown))


def number(value: Column) -> Column:
    """Double, or null where the text is no number."""
    return value.try_cast("double")


def fill_number(value: Column, default: float = 0.0) -> Column:
    return F.coalesce(number(value), F.lit(float(default)))


def half_up(value: Column, digits: int) -> Column:
    """Round half away from zero, once, on the digits that the number is written with. NaN and infinities pass.

    Sums and means of doubles carry noise that can flip a tie: ``rounded_mean`` and ``rounded_sum`` sum without any.
    """
    return F.round(value, digits).cast("double")


# Digits behind the point that exact sums keep, and the whole of them as a number.
_PLACES = 18
_UNIT = 10**_PLACES
_WHOLE = T.DecimalType(38, 0)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body for a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _quotient(value: Column, divisor: Column) -> Column:
    return F.call_function("div", value, divisor)


def _exact_total(value: Column) -> Column:
    """Aggregate: the sum of doubles as sign, whole part and 18 further digits, whatever the order of the rows.

    Each number counts as the decimal it is written as; whole numbers and fractions are added apart, in decimals that
    hold every digit, so tasks combine their sums without rounding.
    """
    exact = value.cast("double").try_cast(T.DecimalType(38, _PLACES))
    whole = F.when(exact < 0, F.ceil(exact)).otherwise(F.floor(exact))
    fraction = (exact % F.lit(1).cast(T.DecimalType(1, 0))).cast(T.DecimalType(28, _PLACES))
    parts = F.struct(
        F.sum(whole.cast(T.DecimalType(28, 0))).cast(_WHOLE).alias("whole"),
        F.sum(fraction).alias("fraction"),
        (F.count(exact) == F.count(value)).alias("exact"),
    )

    def carried(p: Column) -> Column:
        over = F.when(p["fraction"] < 0, F.ceil(p["fraction"])).otherwise(F.floor(p["fraction"]))
        rest = (p["fraction"] % F.lit(1).cast(T.DecimalType(1, 0))).cast(T.DecimalType(19, _PLACES))
        half = T.DecimalType(10, 0)
        upper = rest * F.lit(10**9).cast(half)  # nine digits at a time, which keeps every digit
        first = F.when(upper < 0, F.ceil(upper)).otherwise(F.floor(upper)).cast("long")
        last = ((upper % F.lit(1).cast(T.DecimalType(1, 0))).cast(T.DecimalType(19, _PLACES)) * F.lit(10**9).cast(half)).cast("long")
        digits = (first * F.lit(10**9) + last).cast(_WHOLE)
        return F.struct((p["whole"] + over.cast(_WHOLE)).cast(_WHOLE).alias("whole"), digits.alias("digits"), p["exact"].alias("exact"))

    def signed(p: Column) -> Column:
        # Whole part and digits of one sign: a total of 1 and -0.2 is 0 and 0.8.
        sign = F.when(p["whole"] != 0, F.signum(p["whole"])).otherwise(F.signum(p["digits"])).cast("int")
        mixed = (p["whole"] != 0) & (p["digits"] != 0) & (F.signum(p["whole"]) != F.signum(p["digits"]))
        whole = F.abs(p["whole"]) - F.when(mixed, 1).otherwise(0)
        digits = F.when(mixed, F.lit(_UNIT).cast(_WHOLE) - F.abs(p["digits"])).otherwise(F.abs(p["digits"]))
        return F.struct(
            sign.alias("sign"), whole.cast(_WHOLE).alias("whole"), digits.cast(_WHOLE).alias("digits"), p["exact"].alias("exact")
        )

    return _let(_let(parts, carried), signed)


def _times(value: Column, factor: int) -> Column:
    return (value.cast(_WHOLE) * F.lit(factor).cast(_WHOLE)).cast(_WHOLE)


def rounded_sum(value: Column, digits: int) -> Column:
    """Aggregate: the sum, rounded half away from zero once; the same for every order of the rows.

    Null without a value. With a number that is not finite or beyond 20 digits it is the plain sum, rounded.
    """

    def rounded(p: Column) -> Column:
        shifted = _times(p["digits"], 10**digits)
        up = F.when(_times(shifted % F.lit(_UNIT), 2) >= F.lit(_UNIT), 1).otherwise(0)
        whole = _times(p["whole"], 10**digits) + _quotient(shifted, F.lit(_UNIT)) + up
        return F.when(p["exact"], p["sign"] * whole.cast("double") / F.lit(float(10**digits)))

    return F.coalesce(_let(_exact_total(value), rounded), half_up(F.sum(value), digits))


def rounded_mean(value: Column, digits: int) -> Column:
    """Aggregate: the mean, rounded half away from zero once, from the exact sum by long division.

    Null without a value. With a number that is not finite or beyond 20 digits it is the plain mean, rounded.
    """
    n = F.count(value)
    total = F.struct(_exact_total(value).alias("total"), F.greatest(n, F.lit(1)).cast(T.DecimalType(20, 0)).alias("n"))

    def divided(t: Column) -> Column:
        p, n = t["total"], t["n"]
        rest = _times((p["whole"] % n), 10**digits)
        # What is left below the last digit, in units of 10**-18 of it.
        left = (_times(rest % n, _UNIT) + _times(p["digits"], 10**digits)).cast(_WHOLE)
        unit = _times(n, _UNIT)
        up = F.when(_times(left % unit, 2) >= unit, 1).otherwise(0)
        whole = _times(_quotient(p["whole"], n), 10**digits) + _quotient(rest, n) + _quotient(left, unit) + up
        return F.when(p["exact"], p["sign"] * whole.cast("double") / F.lit(float(10**digits)))

    return F.coalesce(_let(total, divided), half_up(F.avg(value), digits))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Null instead of an error when the denominator is zero or missing."""
    return F.try_divide(numerator, denominator)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def step_label(source: Column, target: Column) -> Column:
    return F.concat_ws(" → ", source, target)


def encode_message(*columns: Column | str) -> Column:
    """Row as a JSON message body."""
    return F.to_json(F.struct(*columns))


def decode_message(body: Column, schema: T.StructType, corrupt_column: str | None = None) -> Column:
    """JSON body as a struct. With ``corrupt_column`` in the schema, a malformed body is kept there as text."""
    options = {"mode": "PERMISSIVE"}
    if corrupt_column:
        options["columnNameOfCorruptRecord"] = corrupt_column
    return F.from_json(body.cast("string"), schema, options)


def squared_error(actual: Column, predicted: Column) -> Column:
    return (actual - predicted) * (actual - predicted)
