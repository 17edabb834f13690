import pytest
from archive import doc_row, docs
from pyspark.sql import functions as F

from twinledger import sources
from twinledger.plans import deliver, replay
from twinledger.plans.replaying import OUTCOMES
from twinledger.sources.ledger import read_outcomes
from twinledger.streaming import replay_new_files


def outcomes(df):
    return sorted((r.key, r.outcome) for r in df.collect())


def key_list(spark, tmp_path, names, file="keys.csv"):
    tmp_path.mkdir(exist_ok=True)
    (tmp_path / file).write_text("_col0\n" + "\n".join(names) + "\n")
    return sources.read_key_list(spark, str(tmp_path))


def logging_sender(log, refuse=""):
    """Appends every payload to a file; refuses payloads holding a given text."""

    def send(payload):
        with open(log, "a") as f:
            f.write(payload + "\n")
        if refuse and refuse in payload:
            raise ConnectionError('down\n"now"')
        return 200, '{"status": "SUBMITTED"}'

    return send


def test_failed_keys_are_tried_again_and_done_ones_are_not(spark, tmp_path):
    keys = key_list(spark, tmp_path / "in", ["2020/01/a", "2020/01/b", "2020/02/c", "2020/02/c", "bad"])
    index = docs(spark, [doc_row("2020/01/a", "2020-01-01")])
    path, log = str(tmp_path / "out"), str(tmp_path / "log")
    first = replay(keys, index, path, logging_sender(log, "bad"))
    assert outcomes(first) == [("2020/01/a", "skipped"), ("2020/01/b", "submitted"), ("2020/02/c", "submitted"), ("bad", "failed")]
    sent = sorted(open(log).read().split())
    assert sent == ["2020/01/b", "2020/02/c", "bad"]

    report = sources.failed_batches(first).drop("feed", "run").collect()
    assert [tuple(r) for r in report] == [
        ("SUBMIT", "all/0", 1, "HTTP 0: ConnectionError: down 'now'", "bad")
    ]
    second = replay(keys, index, path, logging_sender(log))
    assert outcomes(second) == [("bad", "submitted")]
    assert replay(keys, index, path, logging_sender(log)).count() == 0
    assert sorted(open(log).read().split()) == sorted([*sent, "bad"])
    assert {r.outcome: r.batches for r in sources.run_summary(first).collect()} == {"skipped": 0, "submitted": 2, "failed": 1}
    summary = {r.outcome: r.n for r in sources.run_summary(read_outcomes(spark, path, OUTCOMES)).collect()}
    assert summary == {"skipped": 1, "submitted": 3, "failed": 1}


def test_using_the_result_never_sends_again(spark, tmp_path):
    keys = key_list(spark, tmp_path / "in", [f"2020/01/{i}" for i in range(20)])
    log = str(tmp_path / "log")
    result = replay(keys, docs(spark, []), str(tmp_path / "out"), logging_sender(log), batch_size=6)
    result.count(), result.collect(), result.groupBy("outcome").count().collect()
    sizes = sorted(len(line.split(",")) for line in open(log))
    assert sizes == [2, 6, 6, 6]


def test_run_split_by_limit_equals_one_run(spark, tmp_path):
    names = [f"2020/0{1 + i % 3}/{i:03d}" for i in range(30)]
    keys = key_list(spark, tmp_path / "in", names)
    index = docs(spark, [doc_row(n, "2020-01-01") for n in names[::4]])
    whole = replay(keys, index, str(tmp_path / "whole"), logging_sender(str(tmp_path / "log1")))
    path = str(tmp_path / "parts")
    for _ in range(3):
        replay(keys, index, path, logging_sender(str(tmp_path / "log2")), limit=12)
    assert outcomes(read_outcomes(spark, path, OUTCOMES)) == outcomes(whole)


def test_success_needs_status_and_word(spark):
    batches = spark.createDataFrame([("b1", "k1", ["k1"]), ("b2", "k2", ["k2"]), ("b3", "k3", ["k3"])], "batch string, payload string, keys array<string>")
    answers = {"k1": (202, "was Submitted ok"), "k2": (200, "queued"), "k3": (500, "submitted")}
    got = deliver(batches, lambda p: answers[p], 2)
    assert outcomes(got) == [("k1", "submitted"), ("k2", "failed"), ("k3", "failed")]
    assert got.where(F.col("stage") == "SUBMIT").count() == 2


def test_stream_takes_only_new_files_and_survives_restart(spark, tmp_path):
    inbox, log = tmp_path / "in", str(tmp_path / "log")
    key_list(spark, inbox, ["2020/01/a", "2020/01/b"], "one.csv")
    index = docs(spark, [doc_row("2020/01/a", "2020-01-01")])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        replay_new_files(spark, str(inbox), index, out, state, logging_sender(log)).awaitTermination()
        return outcomes(read_outcomes(spark, out, OUTCOMES))

    first = run()
    assert first == [("2020/01/a", "skipped"), ("2020/01/b", "submitted")]
    assert run() == first
    key_list(spark, inbox, ["2020/01/b", "2020/01/c"], "two.csv")
    assert run() == [*first, ("2020/01/c", "submitted")]
    assert sorted(open(log).read().split()) == ["2020/01/b", "2020/01/c"]


def test_stream_and_calls_share_a_table_without_overwriting(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    index = docs(spark, [])
    replay(key_list(spark, tmp_path / "list", ["2020/01/a"]), index, out, logging_sender(log))
    for n, name in enumerate(["2020/01/b", "2020/01/c"]):
        inbox = tmp_path / f"in{n}"
        key_list(spark, inbox, ["2020/01/a", name])
        # Two streams, each numbering its batches from 0, as the call above did.
        replay_new_files(spark, str(inbox), index, out, str(tmp_path / f"state{n}"), logging_sender(log)).awaitTermination()
    done = read_outcomes(spark, out, OUTCOMES)
    assert outcomes(done) == [(f"2020/01/{x}", "submitted") for x in "abc"]
    assert done.select("feed").distinct().count() == 3
    assert "stream-None" not in {r.feed for r in done.collect()}
    assert sorted(open(log).read().split()) == ["2020/01/a", "2020/01/b", "2020/01/c"]


def test_a_call_that_dies_loses_one_wave(spark, tmp_path):
    """A task that ends the job in a later wave; the next call sends no batch of an earlier one."""
    names = [f"2020/01/{i:03d}" for i in range(24)]
    keys, index = key_list(spark, tmp_path / "in", names), docs(spark, [doc_row(names[0], "2020-01-01")])
    path, log = str(tmp_path / "out"), str(tmp_path / "log")

    def dying(payload):
        with open(log, "a") as f:
            f.write(payload + "\n")
        if sum(1 for _ in open(log)) > 15:
            raise KeyboardInterrupt
        return 200, "submitted"

    with pytest.raises(Exception):  # noqa: B017 - however Spark reports a dead worker
        replay(keys, index, path, dying, batch_size=1, concurrency=1, wave_batches=6)
    kept = read_outcomes(spark, path, OUTCOMES)
    recorded = {r.key for r in kept.where("outcome = 'submitted'").collect()}
    assert kept.where("outcome = 'skipped'").count() == 1 and recorded
    before = open(log).read().split()
    second = str(tmp_path / "log2")
    replay(keys, index, path, logging_sender(second), batch_size=1)
    assert not recorded & set(open(second).read().split()) and recorded < set(before)
    assert {r.key for r in read_outcomes(spark, path, OUTCOMES).collect()} == set(names)


def test_reports_keep_runs_apart(spark, tmp_path):
    keys = key_list(spark, tmp_path / "in", ["bad1", "bad2", "bad3"])
    path = str(tmp_path / "out")
    for _ in range(2):
        replay(keys, docs(spark, []), path, logging_sender(str(tmp_path / "log"), "bad"), batch_size=2)
    done = read_outcomes(spark, path, OUTCOMES)
    assert sorted(r.batch_size for r in sources.failed_batches(done).collect()) == [1, 1, 2, 2]
    assert [tuple(r) for r in sources.run_summary(done).collect()] == [("failed", 6, 4)]


def test_answers_are_kept_whole(spark, tmp_path):
    keys = key_list(spark, tmp_path / "in", ["k"])
    got = replay(keys, docs(spark, []), str(tmp_path / "out"), lambda payload: (500, "x" * 5000))
    assert len(got.first().error) == len("HTTP 500: ") + 5000


def test_a_long_list_is_checked_without_a_join(spark):
    from twinledger.operators import joins

    index = docs(spark, [doc_row(k, "2020-01-01 00:00:00") for k in ("k1", "k1", "k9", None)])
    listed = spark.createDataFrame([("k1",), ("k2",), ("k2",), (None,)], "key string")
    got = joins.key_presence(listed, index, max_rows=0)
    assert sorted(map(tuple, got.collect())) == [("k1", True), ("k2", False)]
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
