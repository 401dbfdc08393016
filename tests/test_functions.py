"""Scalar expressions against plain Python."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rowsmith.functions import dates, numbers, text

LAYOUTS = ["%Y-%m-%d", "%Y/%m/%d", "%d-%m-%Y", "%m/%d/%Y", "%Y-%m-%d %H:%M:%S"]


def evaluate(spark, values, kind, expression):
    rows = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r.x for r in rows.select(expression(F.col("v")).alias("x")).collect()]


def parsed(value, layouts):
    for layout in layouts:
        try:
            return dt.datetime.strptime(value.strip(), layout)
        except ValueError:
            continue
    return None


def test_norm_strips_all_white_space(spark):
    values = [None, "", "  ", "\t a b \n", "\xa0x　", "\x1fy\x85", "z"]
    expected = ["" if v is None else v.strip() for v in values]
    assert evaluate(spark, values, "string", text.norm) == expected
    assert evaluate(spark, [" a\t"], "string", text.sql_trim) == ["a\t"]
    every = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
    assert set(text.WHITESPACE) == set(every)


def test_null_tokens(spark):
    values = ["NULL", " None", "NA", "n/a", "n.a.", "", None, "0"]
    expected = [True, True, True, True, False, True, True, False]
    assert evaluate(spark, values, "string", text.is_null_token) == expected


def test_names(spark):
    assert evaluate(spark, ["  A \t b\xa0C "], "string", lambda c: text.name_key(text.norm(c))) == [
        "a b c"
    ]
    joined = text.join_name([F.lit(" Ada "), F.lit(None).cast("string"), F.lit("Obi")])
    assert spark.range(1).select(joined.alias("n")).first().n == "Ada Obi"


def test_headers(spark):
    names = ["Student ID", " e-mail ", "a__b", "Größe", "(x)"]
    assert [text.normalize_header(n) for n in names] == ["student_id", "e_mail", "a_b", "größe", "x"]
    with pytest.raises(ValueError):
        text.normalize_headers(spark.createDataFrame([(1, 2)], "`A b` int, `a-B` int"))


DATES = [
    "2025-04-08", "2025-4-8", "2025/04/08", "08-04-2025", "04/08/2025", "13/04/2025",
    "2025-04-08 09:05:03", "2025-04-08  9:5:3", "2025-04-08 24:00:00", "2025-02-30", "25-4-8",
    "20250-4-8", "0000-01-01", "not a date", "", " 2024-02-29\t", "31-04-2024", "2/29/2023",
]


def test_norm_date(spark):
    expected = []
    for value in DATES:
        found = parsed(value, LAYOUTS)
        expected.append(found.strftime("%Y-%m-%d") if found else value.strip())
    assert evaluate(spark, DATES, "string", dates.norm_date) == expected


def test_parse_date_has_no_time_layout(spark):
    expected = []
    for value in DATES:
        found = parsed(value, LAYOUTS[:4])
        expected.append(found.date() if found else None)
    assert evaluate(spark, DATES, "string", dates.parse_date) == expected


def test_to_number(spark):
    values = [
        "5", "-4", "1e5", "nan", "-NaN", "inf", "-Infinity", "1d", "1f", "1_000", "1__0", "0x10",
        "n.a.", "", " 7 ", "+.5", "5.", "1e", ".", "1_000.5_0e1_0", "_1",
    ]

    def number(value):
        try:
            return float(value)
        except ValueError:
            return None

    got = evaluate(spark, values, "string", numbers.to_number)
    assert [str(x) for x in got] == [str(number(v)) for v in values]


def test_to_int(spark):
    assert evaluate(spark, ["3", "-3", "x", "", "007"], "string", numbers.to_int) == [
        3, None, None, None, 7,
    ]
    signed = evaluate(spark, ["3", "-3", "--3"], "string", lambda c: numbers.to_int(c, signed=True))
    assert signed == [3, -3, None]


def test_lenient_number(spark):
    texts = ["", None, " 3", "x", "1_0", "0x10", "0b11", "0O17", "-0x1", "5.", ".5", "1e3", "Infinity", "inf"]
    assert evaluate(spark, texts, "string", numbers.lenient_number) == [
        0.0, 0.0, 3.0, None, None, 16.0, 3.0, 15.0, None, 5.0, 0.5, 1000.0, float("inf"), None,
    ]


def test_number_text(spark):
    rng = random.Random(1)
    values = [106.0, -4.0, 0.5, 1234567.0, float("nan"), 0.0, 1e-5, 0.0001234, 999999.7, 100000.5]
    values += [1e300, -123.456, float("inf"), 1e22]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-8, 12) for _ in range(500)]
    got = evaluate(spark, values, "double", numbers.fmt_g)
    assert got == ["%g" % v for v in values]


def test_scores_and_rates_round_on_the_binary_value(spark):
    values = [2 * m / t for t in range(2, 90) for m in range(0, t // 2 + 1)] + [0.0005, 0.0025]
    assert evaluate(spark, values, "double", numbers.fmt3) == [f"{v:.3f}" for v in values]
    pairs = [(a, t) for t in (1, 7, 32, 80, 20000) for a in range(min(t, 60) + 1)]
    rows = spark.createDataFrame(pairs, "a bigint, t bigint")
    got = rows.select("a", "t", numbers.rate(F.col("a"), F.col("t")).alias("r")).collect()
    assert [r.r for r in got] == [round(r.a / r.t, 4) for r in got]
    assert spark.range(1).select(numbers.rate(F.lit(0), F.lit(0)).alias("r")).first().r == 0.0


def test_at_position(spark):
    assert evaluate(spark, ["a@b", "@b", "ab", ""], "string", text.at_pos) == [
        True, False, False, False,
    ]
