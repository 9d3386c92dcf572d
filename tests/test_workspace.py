import datetime as dt

import pytest
from pyspark.sql import functions as F

from lexlake import workspace
from lexlake.operators import partitions
from lexlake.sources import files


class FakeContext:
    def __init__(self, master, checkpoint=None):
        self.master, self._checkpoint = master, checkpoint

    def getCheckpointDir(self):  # noqa: N802
        return self._checkpoint


class FakeSession:
    def __init__(self, master, conf=None, checkpoint=None):
        self.sparkContext = FakeContext(master, checkpoint)
        self.conf = conf or {}


def test_shared_root_follows_the_cluster():
    conf = {"spark.checkpoint.dir": "hdfs://shared/cp/"}
    assert workspace.shared_root(FakeSession("yarn", conf)) == "hdfs://shared/cp"
    assert workspace.shared_root(FakeSession("yarn", checkpoint="s3a://b/x")) == "s3a://b/x"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_root(FakeSession("spark://host:7077"))
    assert workspace.shared_root(FakeSession("local[4]"))


def test_materialize_cuts_the_lineage(spark):
    df = spark.range(10).withColumn("m", F.col("id") % 3)
    stored = workspace.materialize(df, "t")
    assert stored.dtypes == df.dtypes and stored.count() == 10
    assert "Range" not in stored._jdf.queryExecution().executedPlan().toString()


def test_list_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.txt").write_text("abc")
    (tmp_path / "y.csv").write_text("a\n")
    assert {r.bytes for r in files.list_files(spark, str(tmp_path)).collect()} == {3, 2}
    assert files.list_files(spark, str(tmp_path), "*.csv").count() == 1


def test_drop_months(spark, tmp_path):
    rows = [(i, m) for i, m in enumerate(["2024_01", "2024_02", "2024_03"])]
    df = spark.createDataFrame(rows, "id int, month string")
    df.write.partitionBy("month").option("path", str(tmp_path / "t")).saveAsTable("kept_months")
    try:
        assert partitions.drop_months(spark, "kept_months", "month", dt.date(2024, 3, 1)) == ["2024_01", "2024_02"]
        assert [r.id for r in spark.table("kept_months").collect()] == [2]
    finally:
        spark.sql("DROP TABLE kept_months")
