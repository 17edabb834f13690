import pytest
from pyspark.sql import functions as F

from twinledger import functions as fn


def values(spark, data, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_epoch_ts_truncates_to_seconds_and_rejects_rubbish(spark):
    data = ["-500", "0", "1999", "abc", None, "", "12.5", "99999999999999999"]
    got = values(spark, data, lambda v: fn.window_text(fn.epoch_ts(v)))
    assert got == ["1970-01-01 00:00:00", "1970-01-01 00:00:00", "1970-01-01 00:00:01", *[None] * 5]


def test_epoch_ts_month_edges(spark):
    # Last millisecond of January 2020 and first of February.
    got = values(spark, ["1580515199999", "1580515200000"], lambda v: fn.year_month(fn.epoch_ts(v)))
    assert got == ["2020-01", "2020-02"]


KEYS = ["2017/07/06/a.gz", "2010/06/x", "2013/01/x", "2017/07", "2017/13/01/a", "x", "", None, "2017/00/a", "2017-07/06/a"]


def test_quadrimester_of_key(spark):
    got = values(spark, KEYS, fn.quadrimester_of_key)
    assert got == ["2017-T2", "2010-T2", "2013-T1", *[None] * 7]


def test_key_month_does_not_check_the_month(spark):
    got = values(spark, KEYS, fn.key_month)
    assert got == ["2017-07", "2010-06", "2013-01", "all", "2017-13", "all", "all", "all", "2017-00", "all"]


def test_first_column(spark):
    data = ['"a,b",c', '"open', "plain", "x,y", ",lead", '""', '"q""r"']
    assert values(spark, data, fn.first_column) == ["a,b", '"open', "plain", "x", ",lead", "", "q"]


def test_java_trim_strips_tabs_but_not_wide_blanks(spark):
    assert values(spark, ["\t a b \x01", " x"], fn.java_trim) == ["a b", " x"]


def test_parse_quadrimester(spark):
    data = ["2025-T3", "2025-T4", "pre-1970", "2025-T3-T1", "", None, "2025-T03"]
    got = values(spark, data, fn.parse_quadrimester)
    assert tuple(got[0]) == (2025, 3)
    assert got[1:] == [None] * 6


def test_months_of_quadrimester_reach_into_the_next_year(spark):
    parsed = fn.parse_quadrimester(F.lit("2025-T3"))
    months = F.explode(fn.months_of_quadrimester(parsed["year"], parsed["n"])).alias("m")
    got = spark.range(1).select(months).select(*[fn.window_text(w) for w in fn.window_of("month", F.col("m"))])
    rows = [tuple(r) for r in got.collect()]
    assert rows[0] == ("2025-09-01 00:00:00", "2025-10-01 00:00:00")
    assert rows[-1] == ("2025-12-01 00:00:00", "2026-01-01 00:00:00")
    assert len(rows) == 4


@pytest.mark.parametrize(
    "level, label, end",
    [
        ("month", "2019-12", "2020-01-01 00:00:00"),
        ("day", "2019-12-31", "2020-01-01 00:00:00"),
        ("hour", "2019-12-31T23", "2020-01-01 00:00:00"),
        ("minute", "2019-12-31T23:58", "2019-12-31 23:59:00"),
        ("second", "2019-12-31T23:58:59", "2019-12-31 23:59:00"),
    ],
)
def test_bucket_labels_and_windows(spark, level, label, end):
    ts = F.lit("2019-12-31 23:58:59.9").cast("timestamp")
    row = spark.range(1).select(fn.bucket_label(level, ts), fn.window_text(fn.window_of(level, ts)[1])).first()
    assert tuple(row) == (label, end)


def test_year_buckets():
    full = fn.year_bucket_values(["2026", "pre-1970", "other"])
    assert full == {"2026": ["2026-T1", "2026-T2", "2026-T3"], "pre-1970": ["pre-1970"], "other": []}
    assert list(fn.year_bucket_values([" 1985", "", "post-2026"])) == ["1985", "post-2026"]
    with pytest.raises(ValueError):
        fn.year_bucket_values(["20x6"])


def test_year_bucket_label(spark):
    data = ["2018-T2", "1970-1999", "junk", None]
    assert values(spark, data, fn.year_bucket_label) == ["2018", "1970-1999", "other", "other"]


def test_extract_marker(spark):
    data = [
        "no marker here",
        "X-SOURCE-ID:abc-1 and X-SOURCE-ID: abc-1 again",
        "X-SOURCE-ID:abc-12\nX-SOURCE-ID:abc-1",
        "x" * 50_000 + " X-SOURCE-ID:late",
        None,
    ]
    got = values(spark, data, fn.extract_marker)
    assert got == [[], ["abc-1"], ["abc-12", "abc-1"], ["late"], None]


def test_marker_names_are_taken_literally(spark):
    assert values(spark, ["XaID:1 X.ID:2"], lambda v: fn.extract_marker(v, "X.ID")) == [["2"]]


def test_safe_error(spark):
    assert values(spark, ['say "no"\nplease', None], fn.safe_error) == ["say 'no' please", ""]


def test_is_submitted(spark):
    rows = [(200, "Keys SUBMITTED"), (299, "submitted"), (300, "submitted"), (200, "queued"), (200, None), (None, "submitted")]
    df = spark.createDataFrame(rows, "s int, b string")
    got = [r[0] for r in df.select(fn.is_submitted(F.col("s"), F.col("b"))).collect()]
    assert got == [True, True, False, False, False, False]


def test_classify(spark):
    assert values(spark, [0, 1, 2], fn.classify, "bigint") == ["zero", "unique", "duplicate"]
