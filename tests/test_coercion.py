"""Missing, null and wrongly typed JSON fields."""

import json
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillworks.functions import (
    double_sql,
    int_sql,
    parse_fields_sql,
    read_fields,
    strict_int,
    text_sql,
)

# document, int, text, double of field "f"
GOLDEN = [
    ("{}", 0, "", 0.0),
    ("", 0, "", 0.0),
    ("   ", 0, "", 0.0),
    ("[1]", 0, "", 0.0),
    ("5", 0, "", 0.0),
    ("null", 0, "", 0.0),
    ('{"f":null}', 0, "null", 0.0),
    ('{"f":7}', 7, "7", 7.0),
    ('{"f":-7}', -7, "-7", -7.0),
    ('{"f":3000000000}', -1294967296, "3000000000", 3e9),
    ('{"f":2147483648}', -2147483648, "2147483648", 2147483648.0),
    ('{"f":9223372036854775807}', -1, "9223372036854775807", 9.223372036854775807e18),
    ('{"f":12345678901234567890}', -350287150, "12345678901234567890", 1.2345678901234567e19),
    ('{"f":2.9}', 2, "2.9", 2.9),
    ('{"f":-2.9}', -2, "-2.9", -2.9),
    ('{"f":2.90}', 2, "2.9", 2.9),
    ('{"f":7.0}', 7, "7.0", 7.0),
    ('{"f":3000000000.0}', 2147483647, "3.0E9", 3e9),
    ('{"f":1e20}', 2147483647, "1.0E20", 1e20),
    ('{"f":-1e20}', -2147483648, "-1.0E20", -1e20),
    ('{"f":true}', 1, "true", 1.0),
    ('{"f":false}', 0, "false", 0.0),
    ('{"f":" 42 "}', 42, " 42 ", 42.0),
    ('{"f":"12.7"}', 12, "12.7", 12.7),
    ('{"f":"-12.7"}', -12, "-12.7", -12.7),
    ('{"f":"+5"}', 5, "+5", 5.0),
    ('{"f":"007"}', 7, "007", 7.0),
    ('{"f":"1e3"}', 1000, "1e3", 1000.0),
    ('{"f":"3000000000"}', 0, "3000000000", 3e9),
    ('{"f":"3e9"}', 2147483647, "3e9", 3e9),
    ('{"f":"x"}', 0, "x", 0.0),
    ('{"f":""}', 0, "", 0.0),
    ('{"f":"null"}', 0, "null", 0.0),
    ('{"f":"{1}"}', 0, "{1}", 0.0),
    ('{"f":{"a":1}}', 0, "", 0.0),
    ('{"f":[1,2]}', 0, "", 0.0),
    ('{"f":1} tail', 1, "1", 1.0),
    ('{"f":1,"f":2}', 2, "2", 2.0),
    ('{"f":"a","f":null}', 0, "null", 0.0),
    ('{"F":1}', 0, "", 0.0),
    ('{"g":{"a":1,"a":2},"f":3}', 3, "3", 3.0),
    ('{"f":"\\u00e9\\n"}', 0, "é\n", 0.0),
]
MALFORMED = [None, "bad{", '{"f":1,', "{'f':1}", '{"f":NaN}', '{"f":01}', '{"f":"a" "g":1}', "{f:1}"]


def _coerced(spark, docs):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, v string")
    parsed = df.withColumn("n", F.expr(parse_fields_sql("v", ["f"])))
    typed = [F.expr(sql("n.f")) for sql in (int_sql, text_sql, double_sql)]
    rows = parsed.select("i", *typed).orderBy("i").collect()
    return [tuple(r)[1:] for r in rows]


def _read(spark, docs):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, v string")
    whole = read_fields(df, "v", {"a": "f"}).join(
        read_fields(df, "v", texts={"b": "f"}).withColumnRenamed("malformed", "m2").drop("v"), "i"
    )
    return whole.select("i", "malformed", "m2", "a", "b").orderBy("i").collect()


def test_each_kind_of_value(spark):
    got = _coerced(spark, [g[0] for g in GOLDEN])
    assert got == [g[1:] for g in GOLDEN]


def test_reading_fields_agrees_with_each_kind(spark):
    rows = _read(spark, [g[0] for g in GOLDEN])
    assert [(r.a, r.b) for r in rows] == [(g[1], g[2]) for g in GOLDEN]
    assert not any(r.malformed or r.m2 for r in rows)


def test_malformed_text(spark):
    rows = _read(spark, MALFORMED)
    assert all(r.malformed and r.m2 for r in rows)


def test_missing_can_stay_null(spark):
    docs = ["{}", "", "[1]", '{"f":null}', '{"f":"x"}', '{"f":9}']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, v string")
    rows = read_fields(df, "v", {"a": "f"}, missing="null").orderBy("i").collect()
    assert [r.a for r in rows] == [None, None, None, 0, 0, 9]


@pytest.mark.parametrize(
    "text,value",
    [("7", 7), ("+5", 5), ("007", 7), ("-3", -3), (" 20", None), ("20 ", None), ("", None),
     ("2147483648", None), ("-2147483648", -(2**31)), ("zz", None), ("1.0", None), ("+", None)],
)
def test_strict_int(spark, text, value):
    assert spark.range(1).select(strict_int(F.lit(text))).first()[0] == value


def _expected(value):
    """int and text of a decoded value, by the same rules in plain Python."""
    if value is None:
        return 0, "null"
    if isinstance(value, bool):
        return int(value), "true" if value else "false"
    if isinstance(value, int):
        low = value & 0xFFFFFFFF
        return (low - 2**32 if low >= 2**31 else low), str(value)
    if isinstance(value, str):
        bare = value.strip("".join(map(chr, range(33))))
        if bare.startswith("+"):
            bare = bare[1:]
        digits = bare[1:] if bare.startswith("-") else bare
        if not digits or not digits.isascii() or not digits.isdigit():
            return 0, value  # the strategy below makes no fractions in text
        number = int(bare)
        return (number if -(2**31) <= number < 2**31 else 0), value
    return 0, ""


VALUES = st.one_of(
    st.none(),
    st.booleans(),
    st.integers(-(2**63), 2**63 - 1),
    st.integers(-(10**37), 10**37),
    st.from_regex(r"\A[ \t]?[+-]?[0-9]{1,12}[ \n]?\Z"),
    st.text(alphabet=st.characters(exclude_characters=".eEdDfF", exclude_categories=("Cs", "Nd", "Cc")), max_size=8),
    st.lists(st.integers(0, 5), max_size=3),
    st.dictionaries(st.sampled_from("ab"), st.none(), max_size=2),
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(VALUES, min_size=40, max_size=80))
def test_generated_values(spark, values):
    values = [v for v in values if not (isinstance(v, str) and v.strip() in ("NaN", "Infinity"))]
    rows = _read(spark, [json.dumps({"f": v}, ensure_ascii=False) for v in values])
    assert [(r.a, r.b) for r in rows] == [_expected(v) for v in values]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=40, max_size=80))
def test_generated_fractions(spark, numbers):
    docs = [json.dumps({"f": n}) for n in numbers] + [json.dumps({"f": repr(n)}) for n in numbers]
    for (as_i, _, as_d), n in zip(_coerced(spark, docs), numbers + numbers):
        assert as_d == pytest.approx(n, rel=1e-15, abs=0)
        assert as_i == max(-(2**31), min(2**31 - 1, math.trunc(n)))
