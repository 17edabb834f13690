"""The filter over a long list: what it lets through, and that it loses nothing."""

import pytest
from pyspark.sql import functions as F

from twinledger.operators import blooms, filters, joins, lists

LISTED, ROWS = 20_000, 200_000


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("big") / "table")
    key = F.concat(F.lit("2020/01/01/k"), F.col("id"))
    spark.range(ROWS).select(key.alias("key"), F.col("id").alias("doc_id")).write.parquet(path)
    listed = spark.range(LISTED).select(F.concat(F.lit("2020/01/01/k"), F.col("id") * 20).alias("key"))
    return spark.read.parquet(path), listed


def matches(big, listed):
    return big.join(listed.distinct(), "key", "left_semi").count()


def shuffled_rows(df):
    """Rows written to the shuffles of a plan that has run, by the plan's own metrics."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_few_rows_pass_by_chance(tables):
    big, listed = tables
    wanted = matches(big, listed)
    passed = blooms.reduce_by_list(big, listed, ["key"], LISTED)
    assert wanted <= passed.count() <= wanted + 0.02 * ROWS
    assert matches(passed, listed) == wanted


def test_rows_entering_the_shuffle(spark, tables):
    big, listed = tables
    wanted = matches(big, listed)
    plan = joins.index_keys(listed, big, max_rows=0)
    assert max(shuffled_rows(plan)) <= wanted * 1.02 + 0.01 * ROWS
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert max(shuffled_rows(lists.keep_listed(big, listed, ["key"], max_rows=0))) == ROWS
        reduced = lists.keep_listed(big, listed, ["key"], max_rows=0, reduce=True)
        assert max(shuffled_rows(reduced)) <= max(LISTED, wanted * 1.02 + 0.01 * ROWS)
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("bits", [1, 4, 16, 64])
def test_no_size_changes_the_result(tables, bits):
    big, listed = tables
    passed = blooms.reduce_by_list(big, listed, ["key"], LISTED, bits)
    assert matches(passed, listed) == matches(big, listed)
    tiny = blooms.might_match(big, blooms.bloom(listed, ["key"], 1), ["key"], 1)
    assert matches(tiny, listed) == matches(big, listed)


def test_a_list_nearly_as_long_as_the_table_makes_no_filter(tables, monkeypatch):
    big, _ = tables
    monkeypatch.setattr(blooms, "reduce_by_list", lambda *a, **k: pytest.fail("a filter was made"))
    assert joins.missing_keys(big.select("key"), big, max_rows=0).count() == 0
    assert filters.with_listed_keys(big, big.select("key"), max_rows=0).count() == ROWS


def test_nulls_empty_lists_and_several_columns(spark, tables):
    big, listed = tables
    odd = big.unionByName(spark.createDataFrame([(None, -1)], "key string, doc_id long"))
    asked = listed.unionByName(spark.createDataFrame([(None,)], "key string"))
    assert matches(blooms.reduce_by_list(odd, asked, ["key"], LISTED), listed) == matches(big, listed)
    assert blooms.reduce_by_list(odd, asked, ["key"], LISTED).where("key IS NULL").count() == 0
    assert blooms.reduce_by_list(big, listed.limit(0), ["key"], 0).count() == 0
    both = big.where("doc_id < 100").select("key", "doc_id")
    passed = blooms.reduce_by_list(big, both, ["key", "doc_id"], 100)
    assert 100 <= passed.count() < 100 + 0.02 * ROWS
    assert passed.join(both, ["key", "doc_id"], "left_semi").count() == 100


def test_the_same_answers_with_and_without(tables, monkeypatch):
    big, listed = tables
    asked = listed.unionByName(listed.select(F.concat("key", F.lit("x")).alias("key")))

    def answers():
        return (
            sorted(joins.missing_keys(asked, big, max_rows=0).collect()),
            sorted(joins.count_default_zero(asked, big, max_rows=0).collect()),
            filters.with_listed_keys(big, asked, max_rows=0).count(),
        )

    reduced = answers()
    monkeypatch.setattr(lists, "REDUCE_ROWS", 10**9)
    assert answers() == reduced and len(reduced[0]) == LISTED + LISTED // 2
