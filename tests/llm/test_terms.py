"""Term counts: rows per task and term, in a number of tasks that does not grow with the texts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from twinledger.llm import pii
from twinledger.llm.textblocks import signed, text_bytes, words


def test_tasks_that_count_terms_are_few(spark):
    said = [("common rare%d rare%d" % (i % 7, i % 3),) for i in range(400)] + [(None,), ("common common",)]
    listed = ["common", "rare2", "rare6", "absent"]
    hashes = signed(words(*text_bytes(pa.array(listed))).hashes).tolist()
    many = 8 * pii.TASKS_A_CORE * spark.sparkContext.defaultParallelism
    docs = spark.createDataFrame(said, "text string").repartition(many)
    terms = spark.createDataFrame([(h,) for h in hashes], "term long")
    counted = pii.term_counts(docs, terms)
    texts = [set((t or "").split()) for t, in said]
    want = {h: sum(w in t for t in texts) for w, h in zip(listed, hashes)}
    assert {r.term: r.n for r in counted.collect()} == {h: n for h, n in want.items() if n}
    # One row per task and term at most reaches the sum.
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    tasks = pii.TASKS_A_CORE * spark.sparkContext.defaultParallelism
    assert f"Repartition {tasks}, false" in plan
