"""OP-01, OP-02, OP-08, OP-35 on golden lines (FIXTURES §3)."""

import pytest
from conftest import lines, rows

from encore.sources.text import (format_click_log, parse_catalog, parse_click_log,
                                 parse_interactions)

LOG = ("2024-01-01 00:00:00,000  INFO --- [x] y(line: 66)  :  "
       "MUSIC_LISTENING_PREFIX:3|4|1700000000")


def test_interactions_rejects_and_extra_fields(spark):
    ok, bad = parse_interactions(lines(spark, "1,2", "a,2,3", "", "1,2,3,9", "7, 8,9", "1,2,"))
    assert rows(ok) == [(1, 2, 3)]
    assert sorted(r.reason for r in bad.collect()) == [
        "not_an_int", "not_an_int", "too_few_fields", "too_few_fields", "too_few_fields"]


def test_interactions_failfast(spark):
    with pytest.raises(ValueError):
        parse_interactions(lines(spark, "1,2,3", "x"), mode="failfast")


def test_catalog_comma_in_name_and_empty_url(spark):
    ok, bad = parse_catalog(lines(spark, "5,Earth, Wind,http://u", "5,Foo,", "6, Bar , /u/6 "))
    assert rows(ok) == [(5, "Earth", "Wind"), (6, "Bar", "/u/6")]
    assert [r.line for r in bad.collect()] == ["5,Foo,"]


def test_click_line_parse(spark):
    twice = "MUSIC_LISTENING_PREFIX:9|9|9 then MUSIC_LISTENING_PREFIX:1|2|3 "
    ok, bad = parse_click_log(lines(spark, LOG, twice, "no prefix here",
                                    "MUSIC_LISTENING_PREFIX:3|x|1"))
    assert rows(ok) == [(1, 2, 3), (3, 4, 1700000000)]
    assert sorted(r.reason for r in bad.collect()) == ["no_prefix", "not_an_int"]


def test_format_then_parse_round_trip(spark):
    clicks = spark.createDataFrame([(1, 3, 4, 1700000000), (2, 5, 6, 7)],
                                   "event_id long, uid int, mid int, ts long")
    out = format_click_log(clicks)
    assert rows(out) == [(1, "MUSIC_LISTENING_PREFIX:3|4|1700000000"),
                         (2, "MUSIC_LISTENING_PREFIX:5|6|7")]
    ok, bad = parse_click_log(out.withColumnRenamed("line", "value"), keep=("event_id",))
    assert rows(ok) == [(1, 3, 4, 1700000000), (2, 5, 6, 7)] and bad.count() == 0


def _jvm_fields(line, sep=","):
    """String.split(sep): trailing empty strings removed (a lone "" stays)."""
    parts = line.split(sep)
    if line == "":
        return [""]
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def _jvm_int(s):
    import re
    if not re.fullmatch(r"[+-]?[0-9]+", s):
        return None
    v = int(s)
    return v if -2**31 <= v < 2**31 else None


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="0123456789,-+ a", max_size=14), min_size=1, max_size=25),
       st.lists(st.integers(-2**32, 2**32), max_size=5))
def test_interaction_parser_matches_jvm_rules(spark, lines, big):
    lines = lines + [f"{a},{a},{a}" for a in big]
    ok, bad = parse_interactions(spark.createDataFrame([(x,) for x in lines], "value string"))
    want = []
    for x in lines:
        f = _jvm_fields(x)
        if len(f) >= 3:
            vals = [_jvm_int(v) for v in f[:3]]
            if None not in vals:
                want.append(tuple(vals))
    assert rows(ok) == sorted(want)
    assert ok.count() + bad.count() == len(lines)


def test_control_characters_are_trimmed_and_line_ends_rejected(spark):
    from pyspark.sql import functions as F

    from encore.functions.columns import strict_int, trim_controls
    r = spark.createDataFrame([(" \t3|4\x00\r\n", "17\r", "+17")], "a string, b string, c string").select(
        trim_controls(F.col("a")).alias("a"), strict_int(F.col("b")).alias("b"), strict_int(F.col("c")).alias("c"))
    assert tuple(r.first()) == ("3|4", None, 17)
