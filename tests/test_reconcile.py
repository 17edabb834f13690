import random
from datetime import datetime, timedelta

import pytest
from archive import ENTITY, doc_row, docs, quad, stage, stage_row
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from twinledger.operators import aggregates
from twinledger.plans import mistagged_rows, reconcile, reconcile_exact, reconciliation, run_reconcile, undated_rows

LEVELS = [("month", 7), ("day", 10), ("hour", 13), ("minute", 16), ("second", 19)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def end_of(level, start):
    at = datetime.fromisoformat(start)
    if level == "month":
        return str((at.replace(day=1) + timedelta(days=32)).replace(day=1))
    return str(at + timedelta(**{level + "s": 1}))


def brute(index, lake, years, threshold, metric="docs", exact=False):
    """Depth-first search over plain lists: (key, 'YYYY-MM-DD HH:MM:SS'[, quadrimester])."""
    out = []
    index = [r for r in index if int(r[1][:4]) in years]
    lake = [r for r in lake if int(r[1][:4]) in years and r[2][:4] == r[1][:4]]
    tagged_right = [r for r in lake if r[2] == quad(r[1])]

    def visit(depth, index, right, exact_right):
        level, width = LEVELS[depth]
        for bucket in sorted({r[1][:width] for r in index + right}):
            left_in = [r for r in index if r[1].startswith(bucket)]
            right_in = [r for r in right if r[1].startswith(bucket)]
            exact_in = [r for r in exact_right if r[1].startswith(bucket)]
            left_keys = {r[0] for r in left_in} - {None}
            left_n = len(left_in) if metric == "docs" else len(left_keys)
            if not exact and left_n == len({r[0] for r in right_in} - {None}):
                continue
            if exact or left_n < threshold or level == "second":
                right_keys = {r[0] for r in exact_in} - {None}
                start = (bucket + "-01 00:00:00"[: 19 - len(bucket)]) if level == "month" else bucket + "2000-01-01 00:00:00"[width:]
                for k in left_keys - right_keys:
                    out.append((level, start, end_of(level, start), "ES_ONLY", k))
                for k in right_keys - left_keys:
                    out.append((level, start, end_of(level, start), "ATHENA_ONLY", k))
            else:
                visit(depth + 1, left_in, exact_in, exact_in)

    visit(0, index, lake, tagged_right)
    return sorted(out)


def random_copies(seed, n=150):
    rng = random.Random(seed)
    start = datetime(2019, 12, 20)
    index, lake = [], []
    for i in range(n):
        # Clustered times, so that deep levels hold several keys.
        at = start + timedelta(days=rng.choice([0, 1, 15, 40, 200, 400]), seconds=rng.choice([0, 1, 59, 3600, 3601, 86399]))
        at, key = str(at), rng.choice([None, *[f"k{j}" for j in range(40)]])
        side = rng.random()
        if side < 0.8:
            index += [(key, at)] * rng.choice([1, 1, 1, 2])
        if side > 0.15:
            tag = quad(at) if rng.random() < 0.9 else rng.choice(["2020-T1", "2020-T3", "2019-T3"])
            lake += [(key, at, tag)] * rng.choice([1, 1, 2])
    return index, lake


def frames(spark, index, lake):
    return (
        docs(spark, [doc_row(k, at, doc_id=str(i)) for i, (k, at) in enumerate(index)]),
        stage(spark, [stage_row(k, at, quadrimester=q) for k, at, q in lake]),
    )


@pytest.mark.parametrize("threshold", [1, 5, 40, 10_000])
@pytest.mark.parametrize("metric", ["docs", "distinct"])
def test_equals_a_recursive_search(spark, threshold, metric):
    index, lake = random_copies(threshold)
    copies = frames(spark, index, lake)
    got = rows(reconcile(*copies, ENTITY, [2019, 2020, 2021], threshold, metric, compare="counts").outstanding)
    assert got == brute(index, lake, {2019, 2020, 2021}, threshold, metric)
    assert got


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(100, 10_000))
def test_exact_form_on_random_copies(spark, seed):
    index, lake = random_copies(seed, 60)
    left, right = frames(spark, index, lake)
    exact = rows(reconcile_exact(left, right, ENTITY, [2020]))
    assert exact == brute(index, lake, {2020}, 0, exact=True)


def test_pruned_form_finds_part_of_the_exact_one(spark):
    """Equally many different keys on both sides cancel out in a count."""
    index = [("only-left", "2020-03-01 00:00:00"), ("extra", "2020-04-01 00:00:00")]
    lake = [("only-right", "2020-03-02 00:00:00", "2020-T1")]
    copies = frames(spark, index, lake)
    pruned = {r[4] for r in rows(reconcile(*copies, ENTITY, [2020], compare="counts").outstanding)}
    exact = {r[4] for r in rows(reconcile_exact(*copies, ENTITY, [2020]))}
    assert pruned == {"extra"}
    assert exact == {"only-left", "only-right", "extra"}


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(100, 10_000))
def test_default_form_equals_the_exact_one_at_month_grain(spark, seed):
    copies = frames(spark, *random_copies(seed, 80))
    assert rows(reconcile(*copies, ENTITY, [2019, 2020]).outstanding) == rows(reconcile_exact(*copies, ENTITY, [2019, 2020]))


def test_equal_counts_do_not_hide_keys(spark):
    """At every level: the bucket is opened down to the second that differs."""
    index = [("left", "2020-03-01 10:00:01"), *((f"k{i}", "2020-03-01 10:00:02") for i in range(5))]
    lake = [("right", "2020-03-01 10:00:01", "2020-T1"), *((f"k{i}", "2020-03-01 10:00:02", "2020-T1") for i in range(5))]
    found = rows(reconcile(*frames(spark, index, lake), ENTITY, [2020], threshold=2).outstanding)
    assert {(r[0], r[4]) for r in found} == {("second", "left"), ("second", "right")}


def test_duplicate_documents_raise_a_mismatch_without_keys(spark):
    index = [("k", "2020-03-01 00:00:00")] * 2
    lake = [("k", "2020-03-01 00:00:00", "2020-T1")]
    result = reconcile(*frames(spark, index, lake), ENTITY, [2020])
    assert rows(result.outstanding) == []
    assert [r.level for r in result.mismatches.collect()] == ["month"]
    assert reconcile(*frames(spark, index, lake), ENTITY, [2020], left_metric="distinct").mismatches.count() == 0


def test_rows_filed_elsewhere(spark):
    """Same year: counted at month level only. Other year: not at all."""
    index = [("k", "2020-03-01 00:00:00"), ("m", "2020-03-01 00:00:00")]
    lake = [("k", "2020-03-01 00:00:00", "2020-T2"), ("m", "2020-03-01 00:00:00", "2021-T1")]
    left, right = frames(spark, index, lake)
    found = rows(reconcile(left, right, ENTITY, [2020, 2021]).outstanding)
    assert [(r[3], r[4]) for r in found] == [("ES_ONLY", "k"), ("ES_ONLY", "m")]
    assert sorted(r.expected_quadrimester for r in mistagged_rows(right).collect()) == ["2020-T1"] * 2


def test_other_entities_and_undated_rows_stay_out(spark):
    left = docs(spark, [doc_row("x", "2020-03-01 00:00:00", entity="a.b.com.au")])
    right = stage(spark, [stage_row("y", "2020-03-01 00:00:00", entity="z"), stage_row("z", "2020-03-01 00:00:00", start_time="n/a")])
    assert reconcile_exact(left, right, ENTITY, [2020]).count() == 0
    assert undated_rows(right).count() == 1


def test_level_statistics(spark):
    index = [(f"k{i}", f"2020-03-01 00:00:0{i}") for i in range(3)]
    result = reconcile(*frames(spark, index, [("q", "2020-05-01 00:00:00", "2020-T2")]), ENTITY, [2020], threshold=2)
    stats = {r.counter: r.n for r in aggregates.level_stats(result.mismatches, result.outstanding).collect()}
    assert stats == {
        "mismatched_month": 2, "mismatched_day": 1, "mismatched_hour": 1, "mismatched_minute": 1,
        "mismatched_second": 3, "keys_ES_ONLY": 3, "keys_ATHENA_ONLY": 1,
    }


def test_unknown_metric_is_refused(spark):
    with pytest.raises(ValueError):
        reconcile(*frames(spark, [("k", "2020-01-01 00:00:00")], [("k", "2020-01-01 00:00:00", "2020-T1")]), ENTITY, [2020], left_metric="rows")


def test_unknown_comparison_is_refused(spark):
    with pytest.raises(ValueError):
        reconcile(*frames(spark, [], []), ENTITY, [2020], compare="rows")


def test_run_stores_years_and_a_failing_one_does_not_stop_the_rest(spark, tmp_path, monkeypatch):
    index, lake = random_copies(7)
    copies, years = frames(spark, index, lake), [2019, 2020, 2021]
    whole = rows(reconcile(*copies, ENTITY, years).outstanding)
    asked, real = [], reconciliation.reconcile

    def once_broken(docs_, stage_, entity, wanted, **options):
        asked.append(wanted[0])
        if wanted == [2020] and asked.count(2020) == 1:
            raise RuntimeError("no disk")
        return real(docs_, stage_, entity, wanted, **options)

    monkeypatch.setattr(reconciliation, "reconcile", once_broken)
    found, outcomes = run_reconcile(*copies, ENTITY, years, str(tmp_path))
    assert {r.year: r.outcome for r in outcomes.collect()} == {2019: "done", 2020: "failed", 2021: "done"}
    assert "no disk" in outcomes.where("year = 2020").first().error
    assert not found.where("year = '2020'").count()
    found, outcomes = run_reconcile(*copies, ENTITY, years, str(tmp_path))
    assert {r.outcome for r in outcomes.collect()} == {"done"} and asked == [2019, 2020, 2021, 2020]
    assert rows(found.drop("year")) == whole
    other, _ = run_reconcile(*copies, ENTITY, [2019], str(tmp_path), left_metric="distinct")
    assert asked[-1] == 2019 and other.count() >= 0
