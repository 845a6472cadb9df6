import pytest
from pyspark.sql import functions as F

from limnos.plans.staging import bounded_join, drop_staged, let, shared_dir, stage


def test_stages_lie_in_the_shared_folder(spark):
    df = stage(spark.range(10).withColumn("x", F.lit(None).cast("string")), "numbers")
    assert df.count() == 10 and df.dtypes == [("id", "bigint"), ("x", "string")]
    assert all(f.startswith(shared_dir(spark).replace("file://", "file:")) or f.startswith(shared_dir(spark)) for f in df.inputFiles())
    drop_staged(df)
    assert stage(spark.range(0), "empty").count() == 0


def test_joins_are_the_same_below_and_beyond_the_bound(spark):
    left = spark.createDataFrame([(i % 3, i) for i in range(50)], "k int, v int")
    right = spark.createDataFrame([(0, "a"), (1, "b")], "k int, w string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        one, other = (sorted(map(str, bounded_join(left, right, ["k"], how, most=most).collect())) for most in (10, 1))
        assert one == other


def test_let_evaluates_once(spark):
    plan = spark.range(3).select(let(F.xxhash64("id"), lambda h: h + h + h).alias("x"))
    assert plan.count() == 3
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("xxhash64") == 1


def test_no_machine_local_folder_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session)
