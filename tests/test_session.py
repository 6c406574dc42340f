import os

from punctua import session


def test_scratch_is_dropped(spark):
    before = list(session._SCRATCH)
    session._SCRATCH.clear()
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path)
    session.drop_scratch(spark)
    assert not os.path.exists(path) and not session._SCRATCH
    session._SCRATCH.extend(before)
