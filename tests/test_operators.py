import random

import pytest
from archive import doc_row, docs, stage, stage_row
from pyspark.sql import functions as F

from twinledger import functions as fn
from twinledger.operators import aggregates, filters, joins, lists, sets, windows


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark):
    """A third of 90,000 rows under one key, and thresholds to match."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000))
    yield spark.range(0, 90_000, 1, 6).select(hot.alias("key"), F.col("id").alias("doc_id"))
    for k, v in before.items():
        spark.conf.set(k, v)


def test_hot_key_is_split_when_keeping_listed_rows(spark, skewed):
    listed = skewed.select("key").distinct().where("key = 'hot' or key like 'k1%'")
    kept = lists.keep_listed(skewed, listed, ["key"], max_rows=0)
    plan = final_plan(kept)
    assert "SortMergeJoin(skew=true)" in plan or "skew=true" in plan
    assert kept.count() == skewed.where("key = 'hot' or key like 'k1%'").count()


def test_short_list_is_broadcast_with_the_same_result(spark, skewed):
    listed = spark.createDataFrame([("hot",), ("k7",), ("hot",), ("none",)], "key string")
    short = lists.keep_listed(skewed, listed, ["key"])
    long = lists.keep_listed(skewed, listed, ["key"], max_rows=2)
    assert "BroadcastHashJoin" in final_plan(short)
    assert "BroadcastHashJoin" not in final_plan(long)
    assert rows(short) == rows(long)
    assert rows(lists.narrow(skewed, listed, ["key"])) == rows(short)
    assert lists.narrow(skewed, listed, ["key"], max_rows=3) is skewed


def test_list_of_few_but_long_values_is_not_broadcast(spark, skewed, monkeypatch):
    listed = spark.createDataFrame([("hot",), ("x" * 1000,)], "key string")
    monkeypatch.setattr(lists, "NARROW_BYTES", 500)
    assert lists.narrow(skewed, listed, ["key"]) is skewed
    assert "BroadcastHashJoin" not in final_plan(lists.keep_listed(skewed, listed, ["key"]))


def test_hot_lake_rows_are_split(spark, skewed):
    pairs = skewed.select(F.col("key").alias("source_id"), F.lit("2020-T1").alias("quadrimester"))
    lake = stage(spark, [stage_row("k", "2020-01-01 00:00:00", source=s) for s in ("hot", "hot", "k1")])
    counted = joins.lake_counts(pairs, lake, "a.b.com", max_rows=0)
    assert "skew=true" in final_plan(counted)
    total = {r.source_id: r.lake_count for r in counted.distinct().collect()}
    assert (total["hot"], total["k1"], total["k2"]) == (2, 1, 0)
    assert counted.count() == 90_000


def test_presence(spark):
    keys = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "key string")
    index = docs(spark, [doc_row("a", "2020-01-01"), doc_row("a", "2020-01-02"), doc_row(None, "2020-01-03")])
    for bound in (0, 10):
        assert rows(joins.missing_keys(keys.where("key is not null"), index, bound)) == [("b",)]
        assert rows(joins.present_keys(keys, index, bound)) == [("a",)]
        assert rows(joins.key_presence(keys, index, bound)) == [("a", True), ("b", False)]
        assert rows(joins.count_default_zero(keys.where("key is not null"), index, bound)) == [("a", 2), ("b", 0)]


def test_phrase_pairs_do_not_match_longer_ids(spark):
    index = docs(
        spark,
        [
            doc_row("k1", "2020-01-01", source="abc-1"),
            doc_row("k2", "2020-01-01", source="abc-12"),
            doc_row("k3", "2020-01-01", content="X-SOURCE-ID:abc-1 ... X-SOURCE-ID: abc-1 X-SOURCE-ID:abc-12"),
        ],
    )
    ids = spark.createDataFrame([("abc-1",), ("abc-1",), ("zzz",)], "source_id string")
    for bound in (0, 10):
        found = joins.phrase_pairs(ids, index, max_rows=bound).select("source_id", "key")
        assert rows(found) == [("abc-1", "k1"), ("abc-1", "k3")]
    assert rows(filters.with_source_phrase(index, "abc-1").select("key")) == [("k1",), ("k3",)]


def test_window_bounds_at_millisecond_precision(spark):
    index = docs(spark, [doc_row(str(i), at) for i, at in enumerate(
        ["2020-01-31 23:59:59.999", "2020-01-31 23:59:59.999900", "2020-02-01 00:00:00", "2019-12-31 23:59:59.999"])])
    kept = filters.in_window_ms(index, "2020-01-01", "2020-02-01")
    assert rows(kept.select("key")) == [("0",), ("1",)]


def test_entity_values_are_bound_not_pasted(spark):
    lake = stage(spark, [stage_row("k", "2020-01-01 00:00:00", entity="o'neil.com")])
    assert filters.by_entity(lake, "o'neil.com").count() == 1
    assert filters.by_entity(lake, "x' OR '1'='1").count() == 0


def test_check_quadrimesters():
    assert filters.check_quadrimesters(None, [2020]) == ["2020-T1", "2020-T2", "2020-T3"]
    assert filters.check_quadrimesters([" 2020-T2", ""], [2020]) == ["2020-T2"]
    for wrong in ("2021-T1", "2020-T4", "junk"):
        with pytest.raises(ValueError):
            filters.check_quadrimesters([wrong], [2020])


def test_quad_subset_covers_every_year_of_the_stage(spark):
    from types import SimpleNamespace

    from checks.queries import BUILDERS

    lake = stage(spark, [
        stage_row("k1", "2015-01-01 00:00:00"),
        stage_row("k2", "2019-06-01 00:00:00"),
        stage_row("k3", "2019-06-01 00:00:00", quadrimester="2015-T3"),
        stage_row("k4", "2019-06-01 00:00:00", quadrimester="2027-T1"),
        stage_row("k5", "2019-06-01 00:00:00", quadrimester="2016-T1", start_time="n/a"),
        stage_row("k6", "2019-06-01 00:00:00", quadrimester="1970-1999"),
    ])
    fixtures = SimpleNamespace(spark=spark, stage=lake, dated_stage=lake.withColumn("ts", fn.epoch_ts(F.col("start_time"))))
    assert rows(BUILDERS["flt_quad_subset"](fixtures).select("key")) == [("k1",), ("k2",), ("k3",)]


def test_rank_latest_breaks_ties_and_limits_before_the_shuffle(spark):
    lake = stage(spark, [
        stage_row("k1", "2020-01-01 00:00:00", stamp="t2", message="m1"),
        stage_row("k1", "2020-01-01 00:00:00", stamp="t2", message="m2"),
        stage_row("k0", "2020-01-01 00:00:00", stamp="t2", message="m9"),
        stage_row("k9", "2020-01-01 00:00:00", stamp="t1"),
        stage_row("kN", "2020-01-01 00:00:00", source=None, stamp="t1"),
        stage_row("kM", "2020-01-01 00:00:00", source=None, stamp="t3"),
    ])
    latest = filters.latest_only(windows.rank_latest(lake, ["source_id"]))
    assert rows(latest.select("key", "message_id")) == [("k1", "m2"), ("kM", "M")]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_batches_are_full_and_split(spark):
    keys = spark.createDataFrame([(f"2020/01/{i:04d}",) for i in range(1000)] + [("odd",)], "key string")
    batched = windows.make_batches(keys, n=50, part_rows=300)
    assert batched.count() == 1001
    sizes = batched.groupBy("key_month", "batch_no").count().collect()
    assert sorted((r.batch_no, r["count"]) for r in sizes if r.key_month == "2020-01") == [(i, 50) for i in range(20)]
    payloads = windows.batch_payloads(batched)
    assert payloads.agg(F.sum("batch_size")).first()[0] == 1001
    assert payloads.where("batch = 'all/0'").first().payload == "odd"


@pytest.mark.parametrize("part_rows", [1, 7, 64, 10_000])
def test_batch_numbers_are_plain_division_however_keys_are_dealt(spark, part_rows):
    r = random.Random(part_rows)
    keys = [f"2020/0{r.choice([1, 1, 1, 2, 3])}/{i:04d}" for i in range(400)] + [f"x{i}" for i in range(31)]
    r.shuffle(keys)
    found = windows.make_batches(spark.createDataFrame([(k,) for k in keys], "key string"), 9, part_rows)
    months = {}
    for k in sorted(keys):
        months.setdefault(k[:7].replace("/", "-") if k.startswith("2") else "all", []).append(k)
    wanted = sorted((k, m, i // 9) for m, mine in months.items() for i, k in enumerate(mine))
    assert sorted(tuple(x) for x in found.select("key", "key_month", "batch_no").collect()) == wanted
    assert windows.make_batches(found.select("key").limit(0), 9, part_rows).count() == 0


def test_no_task_numbers_many_keys(spark):
    """One month with all keys: its ranges stay near the size asked for."""
    keys = spark.range(20_000).select(F.format_string("2020/01/%08d", "id").alias("key"))
    placed = windows.make_batches(keys, 500, 1_000)
    stored = placed.inputFiles()
    sizes = [spark.read.parquet(path).count() for path in stored]
    assert len(stored) >= 15 and max(sizes) <= 2_000 and sum(sizes) == 20_000


def test_batches_of_exact_size_without_splitting(spark):
    keys = spark.createDataFrame([(f"2020/01/{i:04d}",) for i in range(120)], "key string")
    sizes = windows.make_batches(keys, n=50).groupBy("batch_no").count().orderBy("batch_no").collect()
    assert [r["count"] for r in sizes] == [50, 50, 20]


def test_limit_per_id(spark):
    pairs = spark.createDataFrame([("s", f"k{i}", f"d{i}") for i in range(9)] + [("t", None, "d")], "source_id string, key string, doc_id string")
    assert rows(windows.limit_per_id(pairs, 2).select("source_id", "doc_id")) == [("s", "d0"), ("s", "d1"), ("t", "d")]


def test_one_sided_keys_drop_null_and_keep_buckets_apart(spark):
    left = spark.createDataFrame([("b1", "x"), ("b1", "x"), ("b2", "y"), ("b1", None)], "bucket string, key string")
    right = spark.createDataFrame([("b1", "x"), ("b1", "y"), ("b1", None)], "bucket string, key string")
    got = rows(joins.one_sided_keys(left, right, ["bucket", "key"], "L", "R"))
    assert got == [("b1", "y", "R"), ("b2", "y", "L")]


def test_null_handling_of_counts_and_sets(spark):
    lake = stage(spark, [
        stage_row(None, "2020-01-01 00:00:00"),
        stage_row("k", "2020-01-01 00:00:00", source=None),
        stage_row("k", "2020-01-01 00:00:00", start_time="abc"),
    ])
    by_year = {r.year: r.key_count for r in aggregates.distinct_by_year(lake).collect()}
    assert by_year == {2020: 1, None: 1}
    check = aggregates.verify_counts(lake).first()
    assert (check.total_rows, check.distinct_sources) == (3, 1)
    assert sets.distinct_keys(lake).count() == 2
    assert sets.lake_only(docs(spark, [doc_row("z", "2020-01-01")]), lake).count() == 1


def test_distinct_counts_are_not_additive(spark):
    lake = stage(spark, [stage_row("k", "2020-01-01 00:00:00"), stage_row("k", "2020-01-01 01:00:00")])
    assert aggregates.distinct_by_unit(lake, "day").agg(F.sum("key_count")).first()[0] == 1
    assert aggregates.distinct_by_unit(lake, "hour").agg(F.sum("key_count")).first()[0] == 2


def test_aligned_histograms_fill_with_zero(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "bucket string, n bigint")
    right = spark.createDataFrame([("b", 2), ("c", 5)], "bucket string, n bigint")
    pair = joins.align_histograms(left, right)
    assert rows(pair.select("bucket", "left_n", "right_n")) == [("a", 1, 0), ("b", 2, 2), ("c", 0, 5)]
    assert rows(filters.mismatched(pair).select("bucket")) == [("a",), ("c",)]


def test_month_folders_of_the_index_are_pruned(spark, tmp_path):
    from twinledger import sources
    from twinledger.functions import key_month

    path = str(tmp_path / "index")
    index = docs(spark, [doc_row(f"2020/{m:02d}/a", "2020-01-01") for m in range(1, 13)] + [doc_row("odd", "2020-01-01")])
    index.withColumn("key_month", key_month(F.col("key"))).write.partitionBy("key_month").parquet(path)
    stored = sources.read_index(spark, path, by_month=True)
    keys = spark.createDataFrame([("2020/03/a",), ("2020/03/b",), ("odd",)], "key string")
    missing = joins.missing_keys(keys, stored)
    assert rows(missing) == [("2020/03/b",)]
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_month" in plan
    assert rows(joins.count_default_zero(keys, stored)) == [("2020/03/a", 1), ("2020/03/b", 0), ("odd", 1)]


def test_prune_beyond_its_bound_gives_the_same_rows(spark):
    big = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "part string, n int")
    values = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "v string")
    assert rows(lists.prune(big, "part", values)) == [("a", 1), ("b", 2)]
    assert rows(lists.prune(big, "part", values, max_values=1).select("part", "n")) == [("a", 1), ("b", 2)]
    assert lists.prune(big, "part", values.where("v = 'none'")).count() == 0
