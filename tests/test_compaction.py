import pytest

from twinledger import sources
from twinledger.plans.replaying import OUTCOMES
from twinledger.sources import ledger


def append(spark, path, run, rows):
    full = [(key, None, None, None, outcome) for key, outcome in rows]
    frame = spark.createDataFrame(full, "key string, batch string, stage string, error string, outcome string")
    sources.append_outcomes(frame.coalesce(1), path, run)


def held(spark, path):
    return sorted(tuple(r) for r in ledger.read_outcomes(spark, path, OUTCOMES).select("key", "feed", "run", "part", "outcome").collect())


def test_many_runs_are_read_as_few_files(spark, tmp_path):
    path = str(tmp_path / "out comes")
    for run in range(30):
        append(spark, path, run + 1, [(f"k{run % 7}", "failed"), (f"k{run}", "submitted")])
    before = held(spark, path)
    assert len(ledger.read_outcomes(spark, path, OUTCOMES).inputFiles()) == 60
    assert sources.compact_outcomes(spark, path, OUTCOMES, "key") == 60
    found = ledger.read_outcomes(spark, path, OUTCOMES)
    assert len(found.inputFiles()) <= 4 and held(spark, path) == before
    # Runs since the snapshot count beside it, and go into the next one.
    append(spark, path, 100, [("late", "submitted")])
    after = held(spark, path)
    assert len(after) == len(before) + 1
    assert sources.compact_outcomes(spark, path, OUTCOMES, "key") == 1 and held(spark, path) == after
    assert sources.compact_outcomes(spark, path, OUTCOMES, "key") == 0
    done = ledger.done_keys(ledger.read_outcomes(spark, path, OUTCOMES), "key", ["submitted"])
    assert {r.key for r in done.collect()} == {f"k{i}" for i in range(30)} | {"late"}


def test_a_snapshot_without_its_list_is_never_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "outcomes")
    append(spark, path, 1, [("a", "failed")])
    append(spark, path, 2, [("a", "submitted")])
    before = held(spark, path)
    with monkeypatch.context() as m:
        m.setattr(type(spark.range(1)), "coalesce", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            sources.compact_outcomes(spark, path, OUTCOMES, "key")
    # The rows were written; the list of files was not.
    assert (tmp_path / "outcomes-compacted" / "rows").exists() and held(spark, path) == before
    assert sources.compact_outcomes(spark, path, OUTCOMES, "key") == 2 and held(spark, path) == before


def test_a_table_without_runs(spark, tmp_path):
    path = str(tmp_path / "none")
    assert sources.compact_outcomes(spark, path, OUTCOMES, "key") == 0 and held(spark, path) == []
