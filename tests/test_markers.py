"""The stored marker index against searching all texts, and how it grows."""

import random
import re
from pathlib import Path

import archive
import pytest
from pyspark.sql import functions as F

from twinledger import functions as fn
from twinledger import plans, schemas, sources
from twinledger.sources import markers

DAYS = ["2020-01-05", "2020-02-29", "2020-03-31"]


def rows(days, copies=1):
    return [
        archive.doc_row(f"{day.replace('-', '/')}/k{i}", f"{day} 0{i % 10}:00:00", source=f"S{i % 7}", entity=e)
        for day in days
        for i in range(12)
        for e in ("a.b.com", "c.d.com")
        for _ in range(copies)
    ]


def add(spark, path, data):
    archive.docs(spark, data).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "in dex%"), str(tmp_path / "markers")


def found(df):
    return sorted(df.select("marker", "value", "doc_id", "key", "start_ts").collect())


def wanted(spark, path):
    from twinledger.operators import postings

    return found(postings.of_texts(sources.read_index(spark, path), markers.MARKERS))


def test_a_new_file_is_the_only_one_read(spark, paths):
    path, root = paths
    add(spark, path, rows(DAYS[:2]))
    first = sources.grow_markers(spark, path, root)
    assert len(first) == 1 and found(sources.read_markers(spark, root)) == wanted(spark, path)
    add(spark, path, rows(DAYS[2:], copies=2))
    texts, fresh = markers.new_texts(spark, path, root)
    assert texts.inputFiles() == fresh and len(fresh) == 1 and fresh != first
    assert sources.grow_markers(spark, path, root) == fresh
    assert found(sources.read_markers(spark, root, path)) == wanted(spark, path)
    assert sources.grow_markers(spark, path, root) == []


def test_a_run_that_died_before_its_record_counts_for_nothing(spark, paths, monkeypatch):
    path, root = paths
    add(spark, path, rows(DAYS))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(markers, "_record", lost)
        sources.grow_markers(spark, path, root)
    assert len(list(Path(root, "postings").iterdir())) == 1 and not Path(root, "files").exists()
    assert sources.read_markers(spark, root).count() == 0
    sources.grow_markers(spark, path, root)
    assert found(sources.read_markers(spark, root, path)) == wanted(spark, path)


@pytest.mark.parametrize("literal", [0, 1000])
def test_files_indexed_twice_and_files_that_are_gone(spark, paths, monkeypatch, literal):
    path, root = paths
    monkeypatch.setattr(markers, "PRUNE_VALUES", literal)
    add(spark, path, rows(DAYS[:1]))
    add(spark, path, rows(DAYS[1:]))
    listed = markers._recorded
    sources.grow_markers(spark, path, root)
    # A second caller that saw no record yet.
    monkeypatch.setattr(markers, "_recorded", lambda *a: {})
    sources.grow_markers(spark, path, root)
    monkeypatch.setattr(markers, "_recorded", listed)
    assert found(sources.read_markers(spark, root, path)) == wanted(spark, path)
    gone = sorted(Path(path).glob("*.parquet"))[0]
    gone.rename(gone.with_name("_kept-aside"))
    assert found(sources.read_markers(spark, root, path)) == wanted(spark, path)
    assert sources.read_markers(spark, root).count() > sources.read_markers(spark, root, path).count()


def test_jobs_give_the_same_from_postings(spark, paths):
    path, root = paths
    data = rows(DAYS) + [
        archive.doc_row(None, "2020-01-05 00:00:00", doc_id="nokey"),
        ("undated", "2020/01/05/u", "X-SOURCE-ID:S1 X-REPORTING-ENTITY:a.b.com", None, None),
        ("none", "2020/01/05/n", None, None, None),
    ]
    add(spark, path, data)
    sources.grow_markers(spark, path, root)
    docs, found = sources.read_index(spark, path), sources.read_markers(spark, root, path)
    ids = spark.createDataFrame([(f"S{i}",) for i in range(9)], "source_id string")
    stage = archive.stage(spark, [archive.stage_row("2020/01/05/k1", "2020-01-05 01:00:00", source="S1")])

    def same(job):
        a, b = (sorted(map(str, job(x).collect())) for x in (docs, found))
        assert a == b and a

    for bounds in ({}, {"archived_from": "2025-01-01"}, {"archived_before": "2020-01-01"}):
        for bound in (0, 1000):
            same(lambda d, kw=bounds, n=bound: plans.source_multiplicity(ids, d, max_rows=n, **kw))
    for bounds in ({}, {"start": "2020-02-01", "end_exclusive": "2020-03-01"}):
        same(lambda d, kw=bounds: plans.lookup_sources(ids, d, stage, "a.b.com", **kw))
    same(lambda d: plans.lookup_sources(ids, d, stage, "a.b.com", keys_per_id=1).select("source_id", "outcome"))
    same(lambda d: plans.reconcile_exact(d, stage, "a.b.com", [2020]))
    same(lambda d: plans.reconcile(d, stage, "a.b.com", [2020], threshold=2).outstanding)


def test_a_range_of_times_reads_its_months_only(spark, paths, capsys):
    path, root = paths
    add(spark, path, rows(DAYS))
    sources.grow_markers(spark, path, root)
    from twinledger.operators import filters

    plan = filters.in_window_ms(sources.read_markers(spark, root), "2020-02-01", "2020-02-20")
    plan.explain("formatted")
    partition = re.search(r"PartitionFilters: \[([^\]]*)\]", capsys.readouterr().out).group(1)
    assert "month" in partition and "2020-02" in partition
    assert plan.count() == 0
    assert filters.in_start_range(sources.read_markers(spark, root), "2020-02-29").count() == 2 * 48


def test_by_month_layout(spark, paths):
    path, root = paths
    docs = archive.docs(spark, rows(DAYS)).withColumn("key_month", fn.key_month(F.col("key")))
    docs.write.partitionBy("key_month").parquet(path)
    sources.grow_markers(spark, path, root, by_month=True)
    assert found(sources.read_markers(spark, root, path, by_month=True)) == wanted(spark, path)
    assert set(schemas.INDEX_DOCS.fieldNames()) - {"content"} < set(sources.read_markers(spark, root).columns)


def test_the_pattern_finds_what_the_plain_one_finds(spark):
    """Literal first against the name's left border first, on texts made to confuse them."""
    r = random.Random(7)
    pieces = ["X-SOURCE-ID:", "X-SOURCE-ID", "X-", "-", "a", "9", "_", " ", "\t", "\n", "\r\n", ":", "é", ".", "v1", "XX-SOURCE-ID:"]
    texts = ["".join(r.choice(pieces) for _ in range(r.randrange(1, 14))) for _ in range(20_000)]
    plain = re.compile(r"(?:^|[^A-Za-z0-9_-])X-SOURCE-ID:[ \t]*(\S+)", re.ASCII)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [row[0] for row in df.select(fn.extract_marker(F.col("t"))).collect()]
    expected = [list(dict.fromkeys(plain.findall(t))) for t in texts]
    assert sum(map(bool, expected)) > 2_000 and got == expected


def test_values_stand_in_order_in_packed_files(spark, paths):
    path, root = paths
    r = random.Random(3)
    data = rows(DAYS)
    r.shuffle(data)
    add(spark, path, data)
    sources.grow_markers(spark, path, root)
    files = sorted(Path(root, "postings").rglob("*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
    for file in files:
        held = [(row.value, row.doc_id) for row in spark.read.parquet(str(file)).collect()]
        assert held == sorted(held)
    assert found(sources.read_markers(spark, root, path)) == wanted(spark, path)


def test_a_document_is_dealt_out_once_whatever_it_names(spark, paths, monkeypatch):
    from twinledger.operators import postings

    path, root = paths
    add(spark, path, rows(DAYS))
    dealt, spread = [], postings.spread
    monkeypatch.setattr(postings, "spread", lambda df: (dealt.append(df.count()), spread(df))[1])
    sources.grow_markers(spark, path, root)
    assert dealt == [len(rows(DAYS))]
    assert sources.read_markers(spark, root).count() == 2 * len(rows(DAYS))
