import pytest
from archive import ENTITY, stage, stage_row
from pyspark.sql import functions as F

from twinledger import plans, schemas
from twinledger.plans import migration
from twinledger.plans.migration import final_path, table_name


@pytest.fixture
def root(spark, tmp_path):
    spark.sql(f"DROP TABLE IF EXISTS {table_name(ENTITY)}")
    return str(tmp_path / "lake")


def outcome(df):
    return {r.quadrimester: r.outcome for r in df.collect()}


def published(spark, root, label):
    return sorted(tuple(r) for r in spark.read.parquet(final_path(root, ENTITY, label)).collect())


GOOD = [
    stage_row("k1", "2020-01-05 00:00:00", source="s1", stamp="1"),
    stage_row("k2", "2020-01-06 00:00:00", source="s1", stamp="2"),
    stage_row("k3", "2020-02-06 00:00:00", source="s1", stamp="3"),
    stage_row("k4", "2020-05-06 00:00:00", source="s2", stamp="1"),
]


def test_publishes_latest_row_per_month(spark, root):
    done = plans.migrate(spark, stage(spark, GOOD), ENTITY, [2020], root)
    assert outcome(done) == {"2020-T1": "published", "2020-T2": "published", "2020-T3": "published"}
    assert published(spark, root, "2020-T1") == [("s1", "2", "k2", "M"), ("s1", "3", "k3", "M")]
    assert published(spark, root, "2020-T3") == []
    table = spark.table(table_name(ENTITY))
    assert [f.dataType.simpleString() for f in table.schema] == ["string"] * 7
    assert {r.month for r in table.select("month").distinct().collect()} == {"01", "02", "05"}


def test_quadrimester_scope_keeps_one_row(spark, root):
    plans.migrate(spark, stage(spark, GOOD), ENTITY, [2020], root, scope="quadrimester")
    assert published(spark, root, "2020-T1") == [("s1", "3", "k3", "M")]


def test_row_under_the_wrong_quadrimester_stops_publication(spark, root):
    lake = [*GOOD, stage_row("kx", "2020-01-05 00:00:00", source="stray", quadrimester="2020-T2")]
    done = plans.migrate(spark, stage(spark, lake), ENTITY, [2020], root, wave=2)
    assert outcome(done) == {"2020-T1": "published", "2020-T2": "mismatch", "2020-T3": "published"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        published(spark, root, "2020-T2")
    report = spark.read.option("header", True).csv(f"{root}/mismatched-quadrimesters").collect()
    assert [(r.quadrimester, r.delta, r.temp_total_rows) for r in report] == [("2020-T2", "-1", "1")]

    # Put right, only the open quadrimester runs again.
    again = plans.migrate(spark, stage(spark, GOOD), ENTITY, [2020], root)
    assert outcome(again) == {"2020-T1": "done", "2020-T2": "published", "2020-T3": "done"}


def test_rerun_replaces_and_leaves_no_stale_month(spark, root):
    stray = stage_row("kx", "2020-08-05 00:00:00", source="stray", quadrimester="2020-T2")
    wrong = stage_row("ky", "2020-01-05 00:00:00", source="other", quadrimester="2020-T2")
    plans.migrate(spark, stage(spark, [*GOOD, stray, wrong]), ENTITY, [2020], root)
    plans.migrate(spark, stage(spark, GOOD), ENTITY, [2020], root)
    assert published(spark, root, "2020-T2") == [("s2", "1", "k4", "M")]
    before = published(spark, root, "2020-T1")
    plans.migrate(spark, stage(spark, GOOD), ENTITY, [2020], root, scope="month", quadrimesters=["2020-T1"])
    assert published(spark, root, "2020-T1") == before


def test_one_failure_does_not_stop_the_others(spark, root, monkeypatch):
    write = migration.write_quadrimester

    def breaks_once(df, path, label):
        if label == "2020-T2":
            raise OSError("disk full")
        write(df, path, label)

    monkeypatch.setattr(migration, "write_quadrimester", breaks_once)
    done = plans.migrate(spark, stage(spark, GOOD), ENTITY, [2020], root)
    assert outcome(done) == {"2020-T1": "published", "2020-T2": "failed", "2020-T3": "published"}
    assert done.where("outcome = 'failed'").first().error == "disk full"
    monkeypatch.undo()
    again = plans.migrate(spark, stage(spark, GOOD), ENTITY, [2020], root)
    assert outcome(again) == {"2020-T1": "done", "2020-T2": "published", "2020-T3": "done"}


def test_ledger_is_kept_per_entity(spark, root):
    other = "other.com"
    spark.sql(f"DROP TABLE IF EXISTS {table_name(other)}")
    lake = stage(spark, [*GOOD, stage_row("k", "2020-01-01 00:00:00", entity=other)])
    plans.migrate(spark, lake, ENTITY, [2020], root)
    assert set(outcome(plans.migrate(spark, lake, other, [2020], root)).values()) == {"published"}


def test_entity_with_a_quote(spark, tmp_path):
    entity, root = "o'neil.com", str(tmp_path / "with blank")
    spark.sql(f"DROP TABLE IF EXISTS {table_name(entity)}")
    lake = stage(spark, [stage_row("k", "2020-01-01 00:00:00", entity=entity)])
    done = plans.migrate(spark, lake, entity, [2020], root, quadrimesters=["2020-T1"])
    assert outcome(done) == {"2020-T1": "published"}
    assert spark.read.parquet(final_path(root, entity, "2020-T1")).count() == 1
    again = plans.migrate(spark, lake, entity, [2020], root)
    assert set(outcome(again).values()) == {"done", "published"}


def test_table_over_another_folder_is_refused(spark, root, tmp_path):
    lake = stage(spark, GOOD)
    plans.migrate(spark, lake, ENTITY, [2020], root, quadrimesters=["2020-T1"])
    with pytest.raises(ValueError, match="exists over"):
        plans.migrate(spark, lake, ENTITY, [2020], str(tmp_path / "elsewhere"))
    # The same folder is fine, also when only part of the work is left.
    again = plans.migrate(spark, lake, ENTITY, [2020], root)
    assert outcome(again)["2020-T1"] == "done"


@pytest.mark.parametrize("harm", ["changed", "lost", "doubled", "null for empty", "swapped columns"])
def test_published_files_are_read_back(spark, root, monkeypatch, harm):
    lake = stage(spark, [*GOOD, stage_row("", "2020-01-07 00:00:00", source="s9")])
    write = migration.write_flat

    def harmful(df, path):
        if path.endswith("2020-T1"):
            df = {
                "changed": lambda: df.withColumn("message_id", F.when(F.col("key") == "k2", "X").otherwise(F.col("message_id"))),
                "lost": lambda: df.where("key <> 'k3'"),
                "doubled": lambda: df.union(df.where("key = 'k3'")),
                "null for empty": lambda: df.withColumn("key", F.nullif("key", F.lit(""))),
                "swapped columns": lambda: df.withColumns({"key": F.col("message_id"), "message_id": F.col("key")}),
            }[harm]()
        write(df, path)

    monkeypatch.setattr(migration, "write_flat", harmful)
    done = plans.migrate(spark, lake, ENTITY, [2020], root)
    assert outcome(done) == {"2020-T1": "mismatch", "2020-T2": "published", "2020-T3": "published"}
    assert "content differs" in done.where("outcome = 'mismatch'").first().error
    report = spark.read.option("header", True).csv(f"{root}/mismatched-content").collect()
    assert [(r.quadrimester, r.kept_rows, r.reporting_entity) for r in report] == [("2020-T1", "3", ENTITY)]
    monkeypatch.undo()
    assert outcome(plans.migrate(spark, lake, ENTITY, [2020], root)) == {"2020-T1": "published", "2020-T2": "done", "2020-T3": "done"}


def test_null_source_id_survives_and_shows_in_the_note(spark):
    lake = stage(spark, [*GOOD, stage_row("kn", "2020-01-05 00:00:00", source=None), stage_row("km", "2020-01-05 00:00:00", source=None, stamp="z")])
    kept = plans.dedup(lake, ENTITY, ["2020-T1"])
    assert [r.key for r in kept.where("source_id is null").collect()] == ["km"]
    check = plans.verify(kept, lake, ENTITY, ["2020-T1"]).first()
    assert (check.temp_total_rows, check.temp_distinct_sources, check.status, check.note) == (3, 1, "pass", True)


def test_bad_arguments(spark, root):
    with pytest.raises(ValueError):
        plans.migrate(spark, stage(spark, GOOD), ENTITY, [2020], root, quadrimesters=["2021-T1"])
    with pytest.raises(ValueError):
        plans.migrate(spark, stage(spark, GOOD), ENTITY, [2020], root, scope="week")


def test_stored_stage_is_pruned_by_entity_and_quadrimester(spark, tmp_path):
    path = str(tmp_path / "stage")
    lake = stage(spark, [*GOOD, stage_row("k", "2020-01-01 00:00:00", entity="other.com")])
    lake.write.partitionBy("reporting_entity", "quadrimester").parquet(path)
    stored = spark.read.schema(schemas.STAGE).parquet(path)
    plan = plans.dedup(stored, ENTITY, ["2020-T1"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reporting_entity" in plan
    assert "quadrimester" in plan.split("PartitionFilters:")[1].split("]")[0]
    counts = plans.year_counts(stored, ENTITY, ["2020"])
    assert counts.agg(F.sum("key_count")).first()[0] == 4
    assert "message_id" not in counts._jdf.queryExecution().executedPlan().toString()


def test_a_wave_reads_the_lake_once(spark, root, monkeypatch):
    asked, plain = [], migration.dedup

    def counted(lake, entity, labels, scope="month"):
        asked.append(labels)
        return plain(lake, entity, labels, scope)

    monkeypatch.setattr(migration, "dedup", counted)
    plans.migrate(spark, stage(spark, GOOD), ENTITY, [2020], root)
    assert asked == [["2020-T1", "2020-T2", "2020-T3"]]
    assert published(spark, root, "2020-T1") == [("s1", "2", "k2", "M"), ("s1", "3", "k3", "M")]


def test_a_wave_that_cannot_be_read_at_once_fails_by_quadrimester(spark, root, monkeypatch):
    plain = migration.dedup

    def unreadable(lake, entity, labels, scope="month"):
        if "2020-T2" in labels:
            raise OSError("unreadable")
        return plain(lake, entity, labels, scope)

    monkeypatch.setattr(migration, "dedup", unreadable)
    done = plans.migrate(spark, stage(spark, GOOD), ENTITY, [2020], root)
    assert outcome(done) == {"2020-T1": "published", "2020-T2": "failed", "2020-T3": "published"}
