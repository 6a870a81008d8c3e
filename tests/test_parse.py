"""Log line parsing, quarantine and the level-counting path (edge inputs)."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from logwise.functions import split_fields
from logwise.operators import count_by, filter_levels, line_levels, log_records, parse_log_lines, quarantine
from logwise.operators.filters import sql_over_batch


def _lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize(
    "line, fields",
    [
        ("a\tb\tc", ["a", "b", "c"]),
        ("a\tb\t", ["a", "b"]),  # trailing empty field dropped, as in Java
        ("a\t\tc", ["a", "", "c"]),  # interior empty field kept
        ("\ta", ["", "a"]),
        ("a\tb\tc\td", ["a", "b", "c", "d"]),
        ("\t\t", [""]),
        ("", [""]),
    ],
)
def test_split_fields_like_java(spark, line, fields):
    got = _lines(spark, [line]).select(split_fields("value").alias("p")).first()["p"]
    assert got == fields


def test_parse_record_and_time(spark):
    df = parse_log_lines(_lines(spark, ["[error]\tcalculate\tDate:20200606215836\textra"]))
    r = df.first()
    assert (r.log_level, r.method, r.content, r.n_fields) == ("[error]", "calculate", "Date:20200606215836", 4)
    assert r.event_ts.replace(tzinfo=None) == dt.datetime(2020, 6, 6, 21, 58, 36)


def test_bad_time_is_null(spark):
    r = parse_log_lines(_lines(spark, ["[info]\tmain\tDate:2020"])).first()
    assert r.event_ts is None


def test_quarantine_splits_short_lines(spark):
    lines = _lines(spark, ["[info]\tmain\tDate:20200606215836", "[warn]\tmain", "", "\t\t", "[error]\tx\t"])
    good, bad = quarantine(parse_log_lines(lines))
    assert good.count() == 1
    assert sorted(r.value for r in bad.collect()) == sorted(["", "[error]\tx\t", "[warn]\tmain", "\t\t"])


def test_strict_mode_fails_on_short_line(spark):
    lines = _lines(spark, ["[info]\tmain\tDate:20200606215836", "[warn]\tmain"])
    with pytest.raises(PySparkException):
        log_records(lines, mode="strict").collect()
    assert log_records(lines).count() == 1


def test_level_counting_path_counts_every_line(spark):
    lines = _lines(spark, ["[info]\tmain\tDate:1", "[info]", "", "\t\t", "[error]\ta\tb"])
    got = {r.log_level: r.n for r in count_by(line_levels(lines), "log_level").collect()}
    assert got == {"[info]": 2, "": 2, "[error]": 1}


def test_error_filter_and_sql_agree(spark):
    lines = _lines(
        spark,
        ["[error]\ta\tDate:20200606215836", "[warn]\tb\tDate:20200606215836", "[error]\tc\tDate:20200606215837"],
    )
    recs = log_records(lines).select("log_level", "method", "content")
    by_filter = sorted(r.method for r in filter_levels(recs).collect())
    by_sql = sorted(r.method for r in sql_over_batch(recs, "select * from batch_rows where log_level='[error]'").collect())
    assert by_filter == by_sql == ["a", "c"]


def test_filter_pushed_to_parquet_scan(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = filter_levels(ev, ("error",), "event_type").select("event_id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_levels_parameter(spark):
    recs = log_records(_lines(spark, ["[error]\ta\tx", "[warn]\tb\ty", "[info]\tc\tz"]))
    got = sorted(r.log_level for r in filter_levels(recs, ("[error]", "[warn]")).collect())
    assert got == ["[error]", "[warn]"]
    assert recs.where(F.col("log_level") == "[info]").count() == 1


def _model_split(line):
    """Plain-Python model of the split rule: drop trailing empty fields;
    an empty or separator-only line is one empty field."""
    parts = line.split("\t")
    while parts and parts[-1] == "":
        parts.pop()
    return parts or [""]


def test_split_and_parse_match_model_on_random_lines(spark):
    import random

    rnd = random.Random(11)
    alphabet = ["a", "b", "\t", "\t", "中", "[", "]"]
    lines = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 9))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    parsed = {r.i: r for r in parse_log_lines(df.select("i", "value")).collect()}
    fields = {r.i: r.p for r in df.select("i", split_fields("value").alias("p")).collect()}
    good, bad = quarantine(parse_log_lines(df))
    assert good.count() + bad.count() == len(lines)
    for i, line in enumerate(lines):
        want = _model_split(line)
        assert fields[i] == want
        r = parsed[i]
        assert r.n_fields == len(want)
        padded = want + [None, None, None]
        assert (r.log_level, r.method, r.content) == tuple(padded[:3])
    levels = {r.log_level: r.n for r in count_by(line_levels(df), "log_level").collect()}
    model = {}
    for line in lines:
        k = _model_split(line)[0]
        model[k] = model.get(k, 0) + 1
    assert levels == model


def test_log_analysis_batch_outputs_agree(spark):
    from logwise.plans import log_analysis

    lines = _lines(
        spark,
        [
            "[error]\tcalculate\tDate:20200606215836",
            "[error]\tmain\tDate:20200606215839\textra",
            "[warn]\tmain\tDate:20200606215839",
            "[info]\tsaveFile",  # two fields: quarantined, still counted
            "",
        ],
    )
    la = log_analysis(lines)
    assert la.records.count() == 3
    assert sorted(r.method for r in la.errors.collect()) == ["calculate", "main"]
    assert sorted(r.value for r in la.quarantined.collect()) == ["", "[info]\tsaveFile"]
    assert {r.log_level: r.n for r in la.totals.collect()} == {"[error]": 2, "[warn]": 1, "[info]": 1, "": 1}
    # two windows per line, also for lines without three fields or a readable date
    assert la.windows.agg(F.sum("n")).first()[0] == 2 * 5
    bad_date = log_analysis(_lines(spark, ["[error]\tmain\tDate:2020", "[error]\tmain\tDate:20200606215836"]))
    assert bad_date.windows.agg(F.sum("n")).first()[0] == 2 * 2
