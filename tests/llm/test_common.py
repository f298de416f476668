import os

from corpusmill.llm import common


def test_scratch_is_written_read_and_released(spark):
    df = common.cut(spark.range(5).toDF("n"))
    path = common._made[-1][1]
    assert df.count() == 5 and os.path.isdir(path.removeprefix("file:"))
    own = [m for m in common._made if m[1] == path]
    rest = [m for m in common._made if m[1] != path]
    common._made[:] = own
    assert common.release(spark) == 1 and not os.path.isdir(path.removeprefix("file:"))
    common._made[:] = rest


def test_batches_are_bounded(spark):
    seen = []

    def run(batch):
        assert batch.num_rows <= 3
        return batch

    assert common.map_columns(spark.range(10).toDF("n").coalesce(1), run, "n long", rows=3).count() == 10 and not seen
