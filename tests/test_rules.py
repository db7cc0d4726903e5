"""Scalar rules against stated cases and against Python's own parsers."""

import json
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery import CleaningConfig, OutlierRule
from smeltery.functions import dates, hashing, numbers, text
from smeltery.operators.clean import (
    before_after,
    clean,
    null_literals_in_map,
    project_allowed,
    project_allowed_map,
)


def run(spark, values, build, dtype="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    rows = frame.select("i", build(F.col("v")).alias("out")).collect()
    return [r.out for r in sorted(rows, key=lambda r: r.i)]


def test_null_literals(spark):
    nulls = [None, "", "  ", "N/A", "null", "None", "--", "—", "nil", "na", "-", " -\t"]
    assert run(spark, nulls, text.is_null) == [True] * len(nulls)
    assert run(spark, ["something", "---", "n a"], text.is_null) == [False] * 3
    assert run(spark, [" x ", " N/A "], text.null_literals_to_null) == [" x ", None]


def test_payload_maps(spark):
    payloads = [{"a": " N/A ", "b": " x "}, {"b": None}]
    kind = "map<string,string>"
    assert run(spark, payloads, null_literals_in_map, kind) == [{"a": None, "b": " x "}, {"b": None}]
    assert run(spark, payloads, lambda c: project_allowed_map(c, {"a"}), kind) == [{"a": " N/A "}, {}]
    assert run(spark, payloads, lambda c: project_allowed_map(c, None), kind) == payloads


def test_text_and_category(spark):
    cases = ["  hello   world ", "   ", None, "a\t\xa0\n b", "\x1cx\x85y　"]
    assert run(spark, cases, text.normalize_text) == ["hello world", None, None, "a b", "x y"]
    mapping = {"ai": "AI", "data science": "Data"}
    assert run(spark, [" Ai ", "Data   Science", "Other", "n/a"],
               lambda c: text.normalize_category(c, mapping)) == ["AI", "Data", "Other", None]


DATES = {
    "2026-01-09": (date(2026, 1, 9),) * 2,
    "01/09/2026": (date(2026, 9, 1), date(2026, 1, 9)),
    "2026-01-09junk": (date(2026, 1, 9),) * 2,
    "20260109": (date(2026, 1, 9),) * 2,
    "2026-W02-1": (date(2026, 1, 5),) * 2,
    "2026W021": (date(2026, 1, 5),) * 2,
    "2026-W02": (date(2026, 1, 5),) * 2,
    "01/13/2026": (None, date(2026, 1, 13)),
    "13/01/2026": (date(2026, 1, 13), None),
    "01-13-2026": (date(2026, 1, 13),) * 2,
    "09-01-2026": (date(2026, 1, 9),) * 2,
    "2026/1/9": (date(2026, 1, 9),) * 2,
    "2026-1-9 12:30:00": (date(2026, 1, 9),) * 2,
    "2026-1-9T25:30:00": (None, None),
    "31-02-2026": (None, None),
    "2026-02-30": (None, None),
    "0000-01-01": (None, None),
    "2026-W60-1": (None, None),
    "2026": (None, None),
    " n/a ": (None, None),
}


@pytest.mark.parametrize("day_first, column", [(True, 0), (False, 1)])
def test_dates(spark, day_first, column):
    got = run(spark, list(DATES), lambda c: dates.normalize_date(c, day_first))
    assert dict(zip(DATES, got)) == {k: v[column] for k, v in DATES.items()}


MONEY = {
    "$1,234.56": "1234.56", "€1.234,56": "1234.56", "  99 ": "99", None: None, "N/A": None,
    "abc": None, "1,5": "15", "1.234.567,89": "1234567.89", "1.234.567": None,
    "1,234.567.8": None, "1e5": "15", "(5)": "5", "5-3": None, "-2.00005": "-2.0001",
    "1234.56785": "1234.5679", "5.": "5", ".5": "0.5", "123456789012345": None, "--5": None,
    "1,234,56": "123456", "1.2,3,4": "1.234", "-": None,
}


def test_currency(spark):
    got = run(spark, list(MONEY), lambda c: numbers.normalize_currency(c, precision=18, scale=4))
    want = [None if v is None else Decimal(v) for v in MONEY.values()]
    assert dict(zip(MONEY, got)) == dict(zip(MONEY, want))


def test_typed_numbers_skip_the_text_path(spark):
    assert run(spark, [1.5, None], lambda c: numbers.normalize_currency(c, T.DoubleType()),
               "double") == [Decimal("1.5"), None]
    assert run(spark, [True], lambda c: numbers.normalize_int(c, T.BooleanType()),
               "boolean") == [None]
    assert run(spark, [-1.9, float("nan")], lambda c: numbers.normalize_int(c, T.DoubleType()),
               "double") == [-1, None]


def test_int_and_float(spark):
    assert run(spark, ["1,234.9", "-1.9", "inf", "nan", "x", "1_000", "1e30", "7d"],
               numbers.normalize_int) == [1234, -1, None, None, None, 1000, None, None]
    assert run(spark, ["1,234.5", "abc", "1d", " 2 ", "1 2"],
               numbers.normalize_float) == [1234.5, None, None, 2.0, None]


def test_outliers(spark):
    def bounded(c):
        return numbers.outlier_bounds(c, T.DoubleType(), 0, 100)

    values = [50.0, -1.0, 101.0, 0.0, 100.0, None]
    assert run(spark, values, bounded, "double") == [50.0, None, None, 0.0, 100.0, None]
    assert str(run(spark, [float("nan")], bounded, "double")[0]) == "nan"
    assert run(spark, ["5"], lambda c: numbers.outlier_bounds(c, T.StringType(), 0, 9)) == [None]


def test_clean_row_end_to_end(spark):
    row = {
        "title": "\tRiver  and   stone ", "category": "geo ", "published_at": "07/03/2021",
        "price": "$ 88,200.75", "views": "-3", "score": "7", "scratch": "x",
    }
    frame = spark.createDataFrame([row], "title string, category string, published_at string, "
                                         "price string, views string, score string, scratch string")
    cfg = CleaningConfig(
        allowed_keys=set(row) - {"scratch"}, category_mapping={"geo": "Geology"},
        outlier_rules={"views": OutlierRule(min_value=0), "score": OutlierRule(0, 5),
                       "missing": OutlierRule(0)},
    )
    out = clean(frame, cfg).first().asDict()
    assert out == {"title": "River and stone", "category": "Geology", "published_at": date(2021, 3, 7),
                   "price": Decimal("88200.7500000000"), "views": None, "score": None}
    audit = {r.field: (r.before, r.after)
             for r in before_after(frame, cfg, "title", ["category", "views", "scratch"]).collect()}
    assert audit == {"category": ("geo ", "Geology"), "views": ("-3", None), "scratch": ("x", None)}
    assert project_allowed(frame, None).columns == frame.columns


ISO = [
    "2026-01-05T06", "2026-01-05T24:00", "2026-01-05x06:00", "20260105T0600", "20260105T060000.5",
    "2026-W02-1T06:00", "2026W021", "2026-W02", "2026-01-05T06:00:00,123",
    "2026-01-05T06:00:00.1234567", "2026-01-05T06:00:00+02", "2026-01-05T06:00:00+0200",
    "2026-01-05T06:00:00+02:00:30", "2026-01-05T06:00:00+23:59", "2026-01-05T0600",
    "20260105T06:00", "2026-01-05T06:00z", "2026-01-05T", "2026-01-05+02:00",
    "2026-01-05T06+02:00", "2026-01-05T06:00:00.", "2026-01-0506:00", "20260105 0600+0130",
    "2026-01-05T06:00:00.12-02:00", "2026-01-05Z", "2026-1-5", "0000-01-01",
    "2026-01-05T06:00-00:00", "2026-01-05--06:00", "2026-01-05T06:00:60", "20260105", "202601",
    "2026-005", "2026", "T06:00", "2024-02-30T00:00:00Z", "2026-W53-1", "2020-W53-7", "", "not",
    "2026-01-05T06:00:00Z", "2026-01-05T06:00:00.000001+05:30", "0001-01-01T00:00:00",
    "9999-12-31T23:59:59.999999", "2026-01-05T06:0000",
]


def test_event_time_matches_iso_parser(spark):
    def parsed(s):
        try:
            moment = datetime.fromisoformat(s)
        except ValueError:
            return None, None
        moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
        return moment.astimezone(timezone.utc).isoformat(), moment.isoformat()

    got = run(spark, ISO, lambda c: dates.iso_utc(dates.parse_event_time(c)))
    assert dict(zip(ISO, got)) == {s: parsed(s)[0] for s in ISO}
    legal = [s for s in ISO if parsed(s)[0]]
    assert run(spark, legal, dates.local_iso) == [parsed(s)[1] for s in legal]


FLOATS = ["1", "1_000", "1__0", "_1", "1_", "1d", "5f", "1e5", "1E-5", ".5", "5.", "+3", "-0",
          "nan", "NaN", "-nan", "inf", "-Infinity", "infinity", "0x10", "1,5", " 7 ",
          " 8 ", "abc", "", "1e400", "--5", "1.5.2", "1_0.0_1e1_0"]


def test_float_reader_matches_python(spark):
    def python(s):
        try:
            return repr(float(s))
        except ValueError:
            return "None"

    assert [repr(v) for v in run(spark, FLOATS, numbers.parse_float)] == list(map(python, FLOATS))


def test_float_text_matches_python(spark):
    values = [12345678.0, 1e16, 1.5e16, 0.00012, -5.0, -0.0, 0.0, 1e-5, -1e-5, 123456789012345.67,
              9999999.5, 1e7, 1234567.891, 1e22, -1.5e300, float("inf"), float("-inf"), 0.001,
              0.0001, -0.00099, 1e15, 2e15 + 0.5]
    assert run(spark, values, numbers.float_text, "double") == list(map(repr, values))


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), min_size=50, max_size=50))
def test_json_text_matches_python(spark, values):
    assert run(spark, values, hashing.json_string) == [json.dumps(v) for v in values]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.,-+eE_ nadif", max_size=8), min_size=60, max_size=60))
def test_float_reader_on_random_text(spark, values):
    def python(s):
        try:
            return repr(float(s))
        except ValueError:
            return "None"

    assert [repr(v) for v in run(spark, values, numbers.parse_float)] == list(map(python, values))


def test_json_special_characters(spark):
    values = ['a"b\\c', "é€😀", "\x1f\x7f\t\n\r\x08\x0c", "\\u00E9é", "/x y", "", "a b"]
    assert run(spark, values, hashing.json_string) == [json.dumps(v) for v in values]
