"""Number parsing and rendering expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .text import norm

_DIGITS = "[0-9]+(?:_[0-9]+)*"

# The texts accepted as numbers.  The sign of a NaN is left out.
NUMBER = (
    rf"^(?:[+-](?=[nN]))?([+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:nan)|[+-]?(?i:inf(?:inity)?))$"
)


def to_number(c: Column | str) -> Column:
    """A double, or null where the text is not a number.

    The shape is checked first because a Spark cast also takes ``1d`` and hex
    floats and rejects ``1_000``.
    """
    digits = F.regexp_extract(norm(c), NUMBER, 1)
    return F.replace(digits, F.lit("_"), F.lit("")).try_cast("double")


def to_int(c: Column | str, signed: bool = False) -> Column:
    """Digits to an integer, anything else to null."""
    text = norm(c)
    return F.when(text.rlike(r"^-?[0-9]+$" if signed else r"^[0-9]+$"), text.try_cast("bigint"))


# The decimal texts a spreadsheet script coerces to a number, and the
# bases of its prefixed whole numbers, which have no sign.
COERCED = r"^[+-]?(?:Infinity|(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)$"
PREFIXED = {16: "^0[xX][0-9a-fA-F]+$", 8: "^0[oO][0-7]+$", 2: "^0[bB][01]+$"}


def lenient_number(c: Column | str) -> Column:
    """Blank counts as 0; text that a script does not coerce to a number gives null."""
    text = norm(c)
    number = F.when(text == "", F.lit(0.0)).when(text.rlike(COERCED), text.try_cast("double"))
    for base, pattern in PREFIXED.items():
        number = number.when(
            text.rlike(pattern), F.conv(F.substr(text, F.lit(3)), base, 10).try_cast("double")
        )
    return number


def scaled_half_even(c: Column, places: int) -> Column:
    """``c * 10**places`` rounded half-even on the exact binary value of ``c``.

    ``bround`` rounds the shortest decimal text instead, so 69/80 (a little above
    0.8625 in binary) would go down.  The error of the product is recovered by
    splitting ``c`` into two short halves, and decides the apparent ties.
    Meant for non-negative values such as rates and scores.
    """
    factor = F.lit(float(10**places))
    product = c * factor
    head = c * 134217729.0 - (c * 134217729.0 - c)
    error = (head * factor - product) + (c - head) * factor
    low = F.floor(product)
    part = product - low
    up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (low % 2 == 1))))
    return F.when(up, low + 1).otherwise(low)


def rate(part: Column, whole: Column) -> Column:
    """Share rounded half-even to four places; 0.0 for an empty table."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(scaled_half_even(part / whole, 4) / 10000)


def fmt3(c: Column) -> Column:
    """A score with three decimals."""
    thousandths = scaled_half_even(c, 3)
    return F.format_string(
        "%d.%03d", F.floor(thousandths / 1000), (thousandths % 1000).cast("bigint")
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fmt_g(c: Column) -> Column:
    """Shortest text with six significant digits, as ``%g`` in C.

    Spark's ``format_string`` keeps trailing zeros, so the text is composed.
    """
    return _let(c, _number_text)


def _number_text(number: Column) -> Column:
    size = F.abs(number)
    body = _let(
        F.floor(F.log10(size)).cast("int"),
        lambda exponent: _let(
            F.bround(size * F.pow(F.lit(10.0), F.lit(5) - exponent), 0),
            lambda scaled: _let(
                # 999999.7 rounds up to seven digits and moves the exponent by one.
                F.when(
                    scaled >= 1_000_000,
                    F.struct((exponent + 1).alias("e"), F.lit("100000").alias("d")),
                ).otherwise(
                    F.struct(exponent.alias("e"), scaled.cast("bigint").cast("string").alias("d"))
                ),
                lambda parts: _place_digits(parts["d"], parts["e"]),
            ),
        ),
    )
    return (
        F.when(F.isnan(number), F.lit("nan"))
        .when(number == float("inf"), F.lit("inf"))
        .when(number == float("-inf"), F.lit("-inf"))
        .when(number == 0, F.lit("0"))
        .otherwise(F.concat(F.when(number < 0, F.lit("-")).otherwise(F.lit("")), body))
    )


def _place_digits(digits: Column, exponent: Column) -> Column:
    def with_fraction(head: Column, tail: Column) -> Column:
        tail = F.rtrim(tail, F.lit("0"))
        return F.when(tail == "", head).otherwise(F.concat(head, F.lit("."), tail))

    scientific = F.concat(
        with_fraction(F.substr(digits, F.lit(1), F.lit(1)), F.substr(digits, F.lit(2))),
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.format_string("%02d", F.abs(exponent)),
    )
    large = with_fraction(
        F.substr(digits, F.lit(1), exponent + 1), F.substr(digits, exponent + 2)
    )
    small = with_fraction(
        F.lit("0"), F.concat(F.repeat(F.lit("0"), -exponent - 1), digits)
    )
    return (
        F.when((exponent < -4) | (exponent >= 6), scientific)
        .when(exponent >= 0, large)
        .otherwise(small)
    )
