import pytest

from peerbench.session import drop, fresh_path, shared_folder, stored


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert fresh_path(spark, "t").startswith(shared_folder(spark))
    assert fresh_path(spark, "t") != fresh_path(spark, "t")


def test_no_temporary_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError):
        shared_folder(Session())


def test_stored_table_keeps_schema_also_when_empty(spark):
    df = spark.createDataFrame([], "a int, b string")
    back = stored(df, "empty")
    assert back.count() == 0 and back.dtypes == df.dtypes


def test_drop_removes_a_stored_table(spark):
    path = fresh_path(spark, "gone")
    spark.range(3).write.parquet(path)
    drop(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
