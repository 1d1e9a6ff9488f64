from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings, strategies as st

from shelfmark.functions import text as x


def one(spark, expression, **values):
    names = list(values)
    ddl = ", ".join(f"{n} {'int' if isinstance(values[n], int) else 'string'}" for n in names) or "z int"
    return spark.createDataFrame([tuple(values[n] for n in names) or (0,)], ddl).select(expression).first()[0]


def test_search_keys(spark):
    assert one(spark, x.title_key("t"), t="Who's \"A.B-C, D/E: F!\" [SAM] [2]") == "whosabcdef2"
    assert one(spark, x.title_key("t"), t="[s a m]x") == "x"
    assert one(spark, x.name_key("t"), t="Smith, J. [SAM]") == "smithjsam"


@pytest.mark.parametrize("title, variants", [
    ("Elite", set()),
    ("Elite II", {"Elite 2"}),
    ("Elite III: Three", {"Elite 3: Three"}),
    ("Elite IV, V", {"Elite 4, V", "Elite IV, 5"}),
    ("A V Vikings", {"A 5 5ikings"}),
    ("A V, Vikings", {"A 5, 5ikings"}),
    ("Part VIII", {"Part 8"}),
    ("Vikings", set()),
    ("X II+", {"X 2+"}),
])
def test_numerals(spark, title, variants):
    got = set(one(spark, x.title_variants(F.col("t")), t=title))
    assert got == variants | {title}


def test_issue_names(spark):
    cases = {
        (1, 2, 1984, 5, 9, "Gold", "Tape"): 'v.1 #2 - 1984/May/9 special "Gold" supplement "Tape"',
        (None, None, 1984, None, 9, None, None): "- 1984",
        (None, 7, None, 5, 9, None, None): "#7",
        (None, None, None, None, None, None, None): "",
        (None, 7, 1984, 13, None, None, None): None,
    }
    ddl = "volume int, number int, date_year int, date_month int, date_day int, special string, supplement string"
    got = spark.createDataFrame(list(cases), ddl).select(x.issue_name()).collect()
    assert [r[0] for r in got] == list(cases.values())


@pytest.mark.parametrize("page, cleaned, supplement", [
    ("12", "12", False), ("12(Supplement)", "12", True), ("12.13", "12", False), (" 7,8", "7", False), ("", None, False),
    ("(Supplement)", None, True), ("(Supplement) 3", "3", False), (None, None, False),
])
def test_pages(spark, page, cleaned, supplement):
    assert one(spark, x.clean_page("p"), p=page) == cleaned
    assert one(spark, x.on_supplement("p"), p=page) is supplement


def test_text_cleaning(spark):
    assert one(spark, x.clean_text("t", "¬"), t="a¬b\r\n") == "a\n\n\n\nb\n"
    assert one(spark, x.clean_text("t"), t="\r") is None
    assert one(spark, x.trim_newlines("t", 2), t="\n\na\n\n\n") == "\na\n"
    assert one(spark, x.trim_newlines("t", 1), t="a\nb") == "a\nb"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet="a\n\r", max_size=8), st.integers(1, 3))
def test_trim_newlines_step_by_step(spark, value, trailing):
    want = value[1:] if value.startswith("\n") else value
    for _ in range(trailing):
        want = want[:-1] if want.endswith("\n") else want
    assert one(spark, x.trim_newlines("t", trailing), t=value) == want


def test_score_labels(spark):
    assert one(spark, x.score_label("a", "b"), a=" 90 ", b="% ") == "90%"
    assert one(spark, x.score_label("a", "b"), a=None, b="") is None


def test_masks(spark):
    ddl = "mask string, n int, v int, y int, m int, d int, p int, s string, u string, e int"
    values = {"i": "n", "v": "v", "y": "y", "m": "m", "M": "m", "d": "d", "p": "p", "s": "s", "u": "u", "e": "e"}
    cases = [
        (("/{y4}/{i3}/{p2}", 7, 1, 1984, 5, 2, 123, None, None, 1), "/1984/007/123"),
        (("{M3}{M9}{m2}-{d1}{v2}", 7, 1, 1984, 9, 2, 1, None, None, 1), "SepSeptember09-201"),
        (("x{s0}{u0}.{e7}", 7, 1, 1984, 9, 2, 1, "Gold", None, 42), "x#Gold.0000042"),
        (("{i3}{q1}", None, 1, 1984, 9, 2, 1, None, None, 42), "{q1}"),
        ((None, 1, 1, 1, 1, 1, 1, None, None, 1), None),
    ]
    got = spark.createDataFrame([c[0] for c in cases], ddl).select(x.link_from_mask("mask", values)).collect()
    assert [r[0] for r in got] == [c[1] for c in cases]


def test_month_names(spark):
    got = spark.createDataFrame([(0,), (1,), (12,), (13,), (None,)], "m int").select(x.month_name("m")).collect()
    assert [r[0] for r in got] == [None, "January", "December", None, None]
