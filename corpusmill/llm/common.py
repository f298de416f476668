"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import os
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word as the definitions use it: a run of letters and digits.
WORD = re.compile(r"[^\W_]+")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_made: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share; ``release`` deletes it.

    Where the session names none and runs in one process (tests, notebooks), one is set below the temporary folder; on a
    cluster, ``local-cluster`` included, the setting must exist.
    """
    base = spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = "file:" + os.path.join(os.environ.get("TMPDIR", "/tmp"), "corpusmill-checkpoints")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    _made.append((spark, f"{base}/{uuid.uuid4().hex}"))
    return _made[-1][1]


def release(spark: SparkSession | None = None) -> int:
    """Delete the scratch folders made so far (of one session), when no result that reads them is needed any more; how many there were.
    Runs by itself when the driver's interpreter ends."""
    own = [m for m in _made if spark is None or m[0] is spark]
    for session, path in own:
        _made.remove((session, path))
        _delete(session, path)
    return len(own)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@atexit.register
def _release_at_exit() -> None:
    try:
        release()
    except Exception:  # noqa: BLE001  the JVM may be gone already
        _made.clear()


def cut(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage ends there, losing an executor loses nothing."""
    path = scratch_dir(df.sparkSession)
    out = df if partitions is None else df.coalesce(partitions)
    out.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` wrote, once all that was made of them is written as well."""
    for t in tables:
        _made.remove((t.sparkSession, t._scratch))
        _delete(t.sparkSession, t._scratch)


def map_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, rows: int = 2000) -> DataFrame:
    """``mapInArrow`` of a function from batch to batch; it sees at most ``rows`` rows at once, which bounds the Python objects alive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                out = fn(batch.slice(start, rows))
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def once(df: DataFrame, *keys: str) -> DataFrame:
    """Rows delivered twice count once. Equal keys with different rows keep the smallest row."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
