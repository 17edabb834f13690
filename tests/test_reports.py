import pytest
from archive import ENTITY, doc_row, docs, stage, stage_row
from pyspark.errors import AnalysisException

from twinledger import plans, sources
from twinledger.plans.lookup import OUTCOMES


def id_list(spark, tmp_path, names):
    tmp_path.mkdir(exist_ok=True)
    (tmp_path / "ids.csv").write_text("source_id\n" + "\n".join(names) + "\n")
    return sources.read_id_list(spark, str(tmp_path))


def key_list(spark, tmp_path, names):
    tmp_path.mkdir(exist_ok=True)
    (tmp_path / "keys.csv").write_text("keys\n" + "\n".join(names) + "\n")
    return sources.read_key_list(spark, str(tmp_path), sources.KEY_COUNT_HEADERS)


def by_run(outcomes, column):
    """Values of each run, in the order of the runs."""
    found = {}
    for r in outcomes.collect():
        found.setdefault(r.run, set()).add(r[column])
    return [found[run] for run in sorted(found)]


def test_source_multiplicity_resumes(spark, tmp_path):
    ids = id_list(spark, tmp_path / "in", ["a", "b", "b", "c"])
    index = docs(spark, [
        doc_row("k1", "2020-01-01", source="a"),
        doc_row("k2", "2020-01-01", source="b"),
        doc_row("k3", "2020-01-01", source="b"),
        doc_row("k4", "2020-01-01", source="c", archived="2024-12-31 23:59:59.999"),
    ])
    path = str(tmp_path / "out")
    plans.run_source_multiplicity(ids, index, path, limit=2)
    got = plans.run_source_multiplicity(ids, index, path)
    assert sorted((r.source_id, r.n, r.outcome) for r in got.collect()) == [
        ("a", 1, "unique"), ("b", 2, "duplicate"), ("c", 1, "unique"),
    ]
    assert [len(ids) for ids in by_run(got, "source_id")] == [2, 1]
    for bounds, n in (({"archived_from": "2025-01-01"}, 0), ({"archived_before": "2025-01-01"}, 1)):
        part = plans.source_multiplicity(ids, index, **bounds)
        assert part.where("source_id = 'c'").first().n == n


def test_key_multiplicity_resumes(spark, tmp_path):
    keys = key_list(spark, tmp_path / "in", ["k1", "k2", "k2", "k,3"])
    index = docs(spark, [doc_row("k1", "2020-01-01"), doc_row("k1", "2021-01-01"), doc_row("x", "2020-01-01")])
    path = str(tmp_path / "out")
    plans.run_key_multiplicity(keys, index, path, limit=1)
    got = plans.run_key_multiplicity(keys, index, path)
    assert sorted((r.key, r["count"]) for r in got.collect()) == [("k", 0), ("k1", 2), ("k2", 0)]
    assert by_run(got, "key") == [{"k1"}, {"k", "k2"}]
    assert plans.run_key_multiplicity(keys, index, path).count() == 3


def test_year_counts_resume_per_field_and_keep_buckets_apart(spark, tmp_path):
    lake = stage(spark, [
        stage_row("k1", "2020-01-01 00:00:00", source="s1"),
        stage_row("k2", "2020-01-02 00:00:00", source="s1"),
        stage_row("k9", "2020-06-01 00:00:00", source="s1", quadrimester="1970-1999"),
        stage_row("k8", "1985-06-01 00:00:00", source="s1", quadrimester="1970-1999"),
        stage_row("k7", "2027-02-01 00:00:00", source="s2"),
        (ENTITY, None, "s3", "k6", "M", "t", "0"),
        (ENTITY, "junk", "s3", "k5", "M", "t", "n/a"),
    ])
    root = str(tmp_path)

    def run(labels, field="key"):
        got = plans.run_year_counts(lake, ENTITY, root, labels, field)
        return sorted((r.bucket, r.year, r[f"{field}_count"]) for r in got.collect())

    assert run(["2021"]) == []
    assert run(["2020"]) == [("2020", 2020, 2)]
    whole = [("1970-1999", 1985, 1), ("1970-1999", 2020, 1), ("2020", 2020, 2), ("2027", 2027, 1)]
    assert run(["1970-1999", "2027"]) == whole
    got = plans.run_year_counts(lake, ENTITY, root)
    rest = {(r.bucket, r.year, r.key_count) for r in got.collect()} - set(whole)
    assert rest == {("other", 1970, 1), ("other", None, 1)}
    assert plans.run_year_counts(lake, ENTITY, root).count() == 6
    report = plans.year_counts_report(got, "1970-1999")
    assert report.columns == ["year", "key_count"] and [r.year for r in report.collect()] == [1985, 2020]
    assert run(["2020"], "source_id") == [("2020", 2020, 1)]
    done = sources.read_ledger(spark, root, "year_counts", sources.params_hash(entity=ENTITY, field="key"))
    assert {r.unit for r in done.collect()} == {"1970-1999", "2020", "2021", "2027", "other"}


def test_lookup_outcomes(spark, tmp_path):
    ids = id_list(spark, tmp_path / "in", ["s1", "s2", "s3", "s4"])
    index = docs(spark, [
        doc_row("2020/01/a", "2020-01-01", source="s1"),
        doc_row("2020/05/b", "2020-01-01", source="s1", doc_id="b1"),
        doc_row("2020/05/b", "2020-01-01", source="s1", doc_id="b2"),
        doc_row("2017/07", "2020-01-01", source="s2"),
        doc_row("2020/01/c", "2020-01-01", source="s2"),
        doc_row("2020/01/d", "2005-01-01", source="s3"),
        doc_row(None, "2020-01-01", source="s4"),
    ])
    lake = stage(spark, [
        stage_row("2020/01/a", "2020-01-01 00:00:00", source="s1"),
        stage_row("2020/01/z", "2020-01-01 00:00:00", source="s1"),
        stage_row("2020/01/a", "2020-01-01 00:00:00", source="s1", entity="other"),
    ])
    for bound in (0, 100):
        found = plans.lookup_sources(ids, index, lake, ENTITY, max_rows=bound)
        got = sorted(((r.source_id, r.key, r.quadrimester, r.lake_count, r.outcome) for r in found.collect()), key=str)
        assert got == [
            ("s1", "2020/01/a", "2020-T1", 2, "resolved"),
            ("s1", "2020/05/b", "2020-T2", 0, "resolved"),
            ("s1", "2020/05/b", "2020-T2", 0, "resolved"),
            ("s2", "2017/07", None, None, "failed"),
            ("s2", "2020/01/c", "2020-T1", 0, "resolved"),
            ("s3", "2020/01/d", "2020-T1", 0, "resolved"),
            ("s4", None, None, None, "unresolved"),
        ]
    for bounds in ({"start": "2008-01-01"}, {"end_exclusive": "2005-01-01"}):
        part = plans.lookup_sources(ids, index, lake, ENTITY, **bounds)
        assert part.where("source_id = 's3'").first().outcome == "unresolved"
    failed = plans.lookup_sources(ids, index, lake, ENTITY).where("outcome = 'failed'").first()
    assert (failed.stage, failed.error) == ("QUADRIMESTER_DERIVE", "no year and month at the start of the key: 2017/07")
    assert plans.lookup_report(found).columns == ["source_id", "key", "quadrimester", "athena_count"]
    assert plans.lookup_sources(ids, index, lake, ENTITY, keys_per_id=1).where("source_id = 's1'").count() == 1


def test_lookup_repeats_ids_with_a_failed_key(spark, tmp_path):
    ids = id_list(spark, tmp_path / "in", ["s1", "s2", "s3"])
    lake = stage(spark, [stage_row("2020/01/a", "2020-01-01 00:00:00", source="s1")])
    path = str(tmp_path / "out")
    broken = docs(spark, [
        doc_row("2020/01/a", "2020-01-01", source="s1"),
        doc_row("2020/01/b", "2020-01-01", source="s2"),
        doc_row("oops", "2020-01-01", source="s2"),
    ])
    plans.run_source_lookup(ids, broken, lake, ENTITY, path)
    fixed = docs(spark, [doc_row("2020/01/b", "2020-01-01", source="s2")])
    everything = plans.run_source_lookup(ids, fixed, lake, ENTITY, path)
    assert by_run(everything, "source_id") == [{"s1", "s2", "s3"}, {"s2"}]
    now = sources.current_outcomes(everything, "source_id")
    assert sorted((r.source_id, r.outcome) for r in now.collect()) == [("s1", "resolved"), ("s2", "resolved"), ("s3", "unresolved")]
    assert sources.completed_ids(everything, "source_id").count() == 3
    assert OUTCOMES.fieldNames()[0] == "source_id"


def test_unrecorded_lookup_run_is_ignored(spark, tmp_path):
    """What a run left behind when it was lost before it was recorded."""
    ids = id_list(spark, tmp_path / "in", ["s1"])
    lake = stage(spark, [stage_row("2020/01/a", "2020-01-01 00:00:00", source="s1")])
    index = docs(spark, [doc_row("2020/01/a", "2020-01-01", source="s1"), doc_row("oops", "2020-01-01", source="s1")])
    path = str(tmp_path / "out")
    part = plans.lookup_sources(ids, index, lake, ENTITY).where("outcome = 'resolved'")
    lost = sources.append_outcomes(part, path)
    got = plans.run_source_lookup(ids, index, lake, ENTITY, path)
    assert sorted(r.outcome for r in got.collect()) == ["failed", "resolved"]
    assert lost not in {r.run for r in got.collect()}


def test_an_empty_run_leaves_no_number_to_a_lost_one(spark, tmp_path):
    """A recorded run without rows, then one lost part-way: its rows must not count."""
    ids = id_list(spark, tmp_path / "in", ["s1"])
    lake = stage(spark, [stage_row("2020/01/a", "2020-01-01 00:00:00", source="s1")])
    index = docs(spark, [doc_row("2020/01/a", "2020-01-01", source="s1"), doc_row("oops", "2020-01-01", source="s1")])
    path = str(tmp_path / "out")
    plans.run_source_lookup(ids.limit(0), index, lake, ENTITY, path)
    sources.append_outcomes(plans.lookup_sources(ids, index, lake, ENTITY).where("outcome = 'resolved'"), path)
    got = plans.run_source_lookup(ids, index, lake, ENTITY, path)
    assert sorted(r.outcome for r in got.collect()) == ["failed", "resolved"]
    assert [r.stage for r in plans.failed_report(got).collect()] == ["QUADRIMESTER_DERIVE"]


def test_runs_on_one_path_never_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "out")
    first = spark.createDataFrame([("a", 1, "unique"), ("b", 2, "duplicate")], "source_id string, n bigint, outcome string")
    runs = [sources.append_outcomes(first, path) for _ in range(3)]
    assert runs == sorted(set(runs))
    with pytest.raises(AnalysisException):
        sources.append_outcomes(first.where("source_id = 'a'"), path, runs[0])
    assert sources.read_outcomes(spark, path, first.schema).count() == 6


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_long_lists_are_counted_without_a_join(spark):
    index = docs(spark, [doc_row(f"k{i}", "2020-01-01 00:00:00", source=s) for i, s in enumerate(["S1", "S2", "S2", "S9"])])
    ids = spark.createDataFrame([("S1",), ("S2",), ("S2",), ("S3",), (None,)], "source_id string")
    got = plans.source_multiplicity(ids, index, max_rows=0)
    assert {tuple(r) for r in got.collect()} == {
        ("S1", 1, "unique"), ("S2", 2, "duplicate"), ("S3", 0, "zero"), (None, 0, "zero")
    }
    assert got.count() == 4 and "Join" not in plan_of(got)


def test_ids_that_no_document_names_are_found_without_a_join(spark):
    index = docs(spark, [doc_row(f"2020/01/01/k{i}", "2020-01-01 00:00:00", source=s) for i, s in enumerate(["S1", "S2", "S2"])])
    ids = spark.createDataFrame([("S1",), ("S2",), ("S2",), ("S3",), ("S3",), (None,)], "source_id string")
    got = plans.lookup_sources(ids, index, stage(spark, [stage_row("k", "2020-01-01 00:00:00")]), ENTITY, max_rows=0)
    rows = sorted((str(r.source_id), r.outcome) for r in got.collect())
    assert rows == [("None", "unresolved"), ("S1", "resolved"), ("S2", "resolved"), ("S2", "resolved"), ("S3", "unresolved")]
    assert "LeftAnti" not in plan_of(got)
