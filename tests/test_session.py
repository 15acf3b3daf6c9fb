import os

from fathomkit.session import fresh_path, hold, scratch, shared_dir


def test_scratch_goes_with_its_scope(spark):
    outside = hold(spark.range(3))
    with scratch(spark):
        inside = hold(spark.range(5))
        path = fresh_path(spark, "more")
        spark.range(2).write.parquet(path)
        assert inside.count() == 5 and os.path.exists(path)
        held = inside.inputFiles()[0].removeprefix("file:").replace("///", "/")
    assert not os.path.exists(path) and not os.path.exists(held)
    assert outside.count() == 3 and os.path.exists(shared_dir(spark))
