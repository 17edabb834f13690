import random
from pathlib import Path
from urllib.parse import unquote, urlparse

import archive
import pytest
from pyspark.sql import functions as F

from twinledger import plans
from twinledger.plans import pyramid

YEARS = [2019, 2020]
OPTIONS = [("docs", "keys", 5), ("docs", "counts", 30), ("distinct", "keys", 1000), ("distinct", "counts", 3)]


def copies(seed, n):
    """Keys in several seconds, days and months, repeated rows, rows filed elsewhere, no keys."""
    r = random.Random(seed)
    docs, lake = [], []
    for i in range(n):
        at = f"{r.choice([2018, 2019, 2020, 2020])}-{r.randrange(1, 5):02d}-{r.choice([1, 1, 2, 28]):02d} 00:0{r.randrange(2)}:0{r.randrange(3)}"
        key = r.choice([None, f"k{i}", f"k{r.randrange(n)}", f"k{r.randrange(6)}"])
        if r.random() < 0.8:
            docs += [archive.doc_row(key, at, doc_id=f"{seed}-{i}-{j}") for j in range(r.choice([1, 1, 2]))]
        if r.random() < 0.8:
            label = r.choice([None, None, None, f"{at[:4]}-T3", "1970-1999", "2020-T1"])
            lake += [archive.stage_row(key, at, quadrimester=label)] * r.choice([1, 1, 2])
    docs.append(archive.doc_row("other", "2020-01-01 00:00:00", entity="x.y.org"))
    lake.append(archive.stage_row("bad", "2020-01-01 00:00:00", start_time="n/a"))
    return docs, lake


def add(spark, places, docs, lake):
    archive.docs(spark, docs).coalesce(1).write.mode("append").parquet(places[0])
    archive.stage(spark, lake).coalesce(1).write.mode("append").partitionBy("reporting_entity", "quadrimester").parquet(places[1])


def found(result):
    return sorted(result.outstanding.collect()), sorted(result.mismatches.collect())


def check(spark, places, options=OPTIONS):
    docs, stage = spark.read.parquet(places[0]), spark.read.parquet(places[1])
    for metric, compare, threshold in options:
        kind = {"threshold": threshold, "left_metric": metric, "compare": compare}
        full = found(plans.reconcile(docs, stage, archive.ENTITY, YEARS, **kind))
        assert found(plans.reconcile_stored(spark, archive.ENTITY, YEARS, places[2], **kind)) == full
    return full


@pytest.fixture
def places(tmp_path):
    return [str(tmp_path / name) for name in ("docs", "lake of é", "stored")]


def grow(spark, places):
    return plans.grow_pyramid(spark, places[0], places[1], archive.ENTITY, places[2])


def test_increments_equal_a_full_run(spark, places):
    for seed in range(3):
        add(spark, places, *copies(seed, 60))
        assert grow(spark, places)[0]
    assert check(spark, places)[1]
    assert grow(spark, places) == ([], [])


def test_only_new_files_are_read_and_their_months_built(spark, places, monkeypatch):
    add(spark, places, *copies(7, 60))
    grow(spark, places)
    read = []
    plain = pyramid._read_again
    monkeypatch.setattr(pyramid, "_read_again", lambda scan, path, files: read.extend(plain(scan, path, files).inputFiles()) or plain(scan, path, files))
    archive.docs(spark, [archive.doc_row("late", "2020-03-05 00:00:00")]).coalesce(1).write.mode("append").parquet(places[0])
    files, months = grow(spark, places)
    assert months == ["2020-03"] and sorted(read) == files and len(files) == 1
    assert "late" in {r.key for r in check(spark, places, OPTIONS[:1])[0]}


def test_files_that_are_gone_no_longer_count(spark, places):
    add(spark, places, *copies(1, 40))
    grow(spark, places)
    archive.docs(spark, [archive.doc_row("gone", "2019-02-05 00:00:00")]).coalesce(1).write.mode("append").parquet(places[0])
    files, _ = grow(spark, places)
    Path(unquote(urlparse(files[0]).path)).unlink()
    assert grow(spark, places) == ([], ["2019-02"])
    assert "gone" not in {r.key for r in check(spark, places, OPTIONS[:1])[0]}


def test_a_run_without_its_log_is_done_again(spark, places, monkeypatch):
    add(spark, places, *copies(2, 40))
    grow(spark, places)
    add(spark, places, *copies(3, 40))
    with monkeypatch.context() as m:
        m.setattr(pyramid, "level_rows", lambda entries: entries.select("file", F.raise_error(F.lit("lost")).cast("string").alias("month")))
        with pytest.raises(Exception, match="lost"):
            grow(spark, places)
    files, months = grow(spark, places)
    assert files and months
    check(spark, places, OPTIONS[:1])


def test_nothing_stored_and_empty_copies(spark, places):
    none = plans.reconcile_stored(spark, archive.ENTITY, YEARS, places[2])
    assert found(none) == ([], [])
    add(spark, places, [archive.doc_row("x", "2020-01-01 00:00:00", entity="x.y.org")], [archive.stage_row("y", "2020-01-01 00:00:00", entity="x.y.org")])
    grow(spark, places)
    assert found(plans.reconcile_stored(spark, archive.ENTITY, YEARS, places[2])) == ([], [])
    with pytest.raises(ValueError, match="left_metric"):
        plans.reconcile_stored(spark, archive.ENTITY, YEARS, places[2], left_metric="rows")
