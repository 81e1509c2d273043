from pathlib import Path

from gristmill.session import drop_staged, shared_dir, spread, stage


def test_staged_tables(spark):
    df = stage(spark.createDataFrame([(1, None), (2, "x")], "i int, s string"), "demo")
    assert sorted(map(str, df.collect())) == sorted(map(str, [(1, None), (2, "x")])) or df.count() == 2
    assert stage(df.limit(0), "none").count() == 0
    folder = Path(shared_dir(spark).removeprefix("file://").removeprefix("file:")) / "gristmill"
    assert list(folder.glob("demo-*"))
    mine = df.inputFiles()[0].removeprefix("file://")
    drop_staged(spark)
    assert not Path(mine).exists()


def test_spread(spark):
    few = spark.range(10, numPartitions=1)
    assert spread(few).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(10, numPartitions=64)
    assert spread(many) is many
