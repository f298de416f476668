"""Structured Streaming over change logs and events."""

from __future__ import annotations

import functools
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.grouping import top_per_group


def distinct_changes(stream: DataFrame, late: str = "30 days") -> DataFrame:
    """A change log as a stream without its repeated rows; state is dropped once rows are later than ``late``."""
    return stream.withWatermark("received_at", late).dropDuplicatesWithinWatermark(["document_id", "generated_at", "action", "reason"])


def windowed_counts(stream: DataFrame, time: str, key: str, width: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Rows and sums of value by time window and key, late rows included up to the watermark."""
    w = F.window(time, width, slide or width)
    counted = stream.withWatermark(time, late).groupBy(w, key).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "n", "total")


def scratch(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share; below the temporary folder in a session of one process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file:" + os.path.join(tempfile.gettempdir(), "corpusmill-streams")
    return f"{base}/{uuid.uuid4().hex}"


def run_to_files(stream: DataFrame, folder: str, mode: str) -> DataFrame:
    """Run a stream until its input ends, and what it gave. Rows go to files, so none are kept on the driver: appended, or, in
    ``complete`` mode, the whole result once more for each batch, of which the last is read."""
    spark, out = stream.sparkSession, f"{folder}/rows"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").option("path", out).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)
    writer.foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/version={number:012d}")).start().awaitTermination()
    last = read_state(spark, out)
    return spark.createDataFrame([], stream.schema) if last is None else last


def keep_state(stream: DataFrame, path: str, checkpoint: str, key: str = "document_id", version: str = "generated_at", buckets: int = 64) -> StreamingQuery:
    """Keeps the latest row per key of a change stream in a parquet table of ``buckets`` parts by a hash of the key. Each batch rewrites only
    the parts that it touches, as a new version of them; ``read_part_state`` reads the last complete version of each. A batch that comes
    again after a failure writes the same folders."""
    spark = stream.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("bucket", F.pmod(F.hash(key), F.lit(buckets)))
        touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # ``buckets`` numbers at most
        before = read_part_state(spark, path, touched, below=number)
        rows = rows if before is None else before.unionByName(rows)
        order = [F.desc(version), *[F.asc(c) for c in ("action", "reason") if c in batch.columns]]
        top_per_group(rows, [key], order).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/version={number:012d}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _versions(spark: SparkSession, path: str, below: int | None = None) -> list[int]:
    """Numbers of the complete versions, in order."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder)
    numbers = sorted(int(str(x.getPath().getParent().getName()).split("=")[1]) for x in found or [])
    return [n for n in numbers if below is None or n < below]


def read_part_state(spark: SparkSession, path: str, only: list[int] | None = None, below: int | None = None) -> DataFrame | None:
    """The last complete version of each part (of ``only`` these), with its number as ``bucket``; None where there is none."""
    latest: dict[int, str] = {}
    for n in _versions(spark, path, below):
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={n:012d}/bucket=*")
        for x in folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder) or []:
            latest[int(str(x.getPath().getName()).split("=")[1])] = str(x.getPath())
    paths = {b: p for b, p in latest.items() if only is None or b in only}
    if not paths:
        return None
    by_version: dict[str, list[str]] = {}
    for p in paths.values():
        by_version.setdefault(p.rsplit("/", 1)[0], []).append(p)
    parts = [spark.read.option("basePath", base).parquet(*own) for base, own in by_version.items()]
    return functools.reduce(DataFrame.unionByName, parts)


def read_state(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    numbers = _versions(spark, path, below)
    return spark.read.parquet(f"{path}/version={numbers[-1]:012d}") if numbers else None
