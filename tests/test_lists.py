import pytest

from twinledger import sources
from twinledger.operators import ordering


def keys(df, column="key"):
    return sorted(r[column] for r in df.collect())


def test_header_only_in_first_nonblank_line_of_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n \t\n"_col0"\n"k1",x\n\nk2\nkey\n')
    (tmp_path / "b.csv").write_text("S3 Key,other\nk3\r\n_COL0\n")
    (tmp_path / "c.csv").write_text("k4\nkey\n\"\"\n")
    assert keys(sources.read_key_list(spark, str(tmp_path))) == ["_COL0", "k1", "k2", "k3", "k4", "key", "key"]


def test_header_words_differ_by_list(spark, tmp_path):
    (tmp_path / "a.csv").write_text("keys\nk1\n")
    assert keys(sources.read_key_list(spark, str(tmp_path))) == ["k1", "keys"]
    counted = sources.read_key_list(spark, str(tmp_path), sources.KEY_COUNT_HEADERS)
    assert keys(counted) == ["k1"]
    (tmp_path / "a.csv").write_text("SourceId\nkey\n")
    assert keys(sources.read_id_list(spark, str(tmp_path)), "source_id") == ["key"]


def test_file_split_over_many_tasks(spark, tmp_path):
    names = [f"2017/07/{i:05d}" for i in range(3000)]
    (tmp_path / "a.csv").write_text("key\n" + "\n".join(names + ["key"]) + "\n")
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "4096")
    try:
        df = sources.read_key_list(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 3
        assert keys(df) == sorted([*names, "key"])
        first = ordering.limit_inputs(df, None, "key", 1500)
        assert keys(first) == names[:1500]
    finally:
        spark.conf.set(size, before)


def test_limit_counts_after_resume_and_once_per_key(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k1\nk2\nk2\nk3\nk4\n")
    done = spark.createDataFrame([("k1",)], "key string")
    listed = sources.read_key_list(spark, str(tmp_path))
    assert keys(ordering.limit_inputs(listed, done, "key", 2)) == ["k2", "k3"]
    assert keys(ordering.limit_inputs(listed, done, "key", None)) == ["k2", "k3", "k4"]


def test_schema_is_checked(spark):
    from twinledger import schemas

    df = spark.createDataFrame([("a", 1)], "key string, start_time int")
    with pytest.raises(ValueError, match="reporting_entity is missing"):
        schemas.require(df, schemas.STAGE)


def test_a_list_is_read_once_for_first_lines_and_once_for_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text("key\nk1\nkey\n")
    listed = sources.read_key_list(spark, str(tmp_path))
    assert listed._jdf.queryExecution().executedPlan().toString().count("Scan text") == 2
    assert keys(listed) == ["k1", "key"]
