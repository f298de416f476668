"""Change data capture, batch and streaming."""

from pyspark.sql import functions as F

from ..operators import changes as C
from ..operators import joins as J
from ..streaming import feeds
from .catalog import query, table

_STATE = """
    SELECT document_id, min(document_content_sha256) AS content_sha256, list(id ORDER BY chunk_index, id) AS chunk_ids, list(sha256(text) ORDER BY chunk_index, id) AS chunk_text_sha256, count(*) AS chunk_count
    FROM (SELECT DISTINCT document_id, id, chunk_index, text, document_content_sha256 FROM chunks) GROUP BY 1"""


@query("state_records", f"SELECT document_id, content_sha256, array_to_string(chunk_ids, ' ') AS chunk_ids, array_to_string(chunk_text_sha256, ' ') AS hashes, chunk_count FROM ({_STATE})")
def state_records(spark, d):
    s = C.state_records(table(spark, d, "chunks"))
    return s.select("document_id", "content_sha256", F.array_join("chunk_ids", " ").alias("chunk_ids"), F.array_join("chunk_text_sha256", " ").alias("hashes"), "chunk_count")


def _snapshots(spark, d):
    """The stored state as the one before, with documents taken away, added and altered by their hash; the chunks' state as the one after."""
    after = C.state_records(table(spark, d, "chunks")).withColumn("metadata_sha256", F.lit("m"))
    s = table(spark, d, "corpus_state")
    digit = F.substring("content_sha256", 1, 1)
    before = s.filter(digit != "0").withColumn("metadata_sha256", F.when(digit == "1", "old").otherwise("m"))
    before = before.withColumn("content_sha256", F.when(digit == "2", F.reverse("content_sha256")).otherwise(F.col("content_sha256")))
    gone = s.filter(digit == "3").withColumn("metadata_sha256", F.lit("m")).withColumn("document_id", F.concat(F.lit("old:"), "document_id"))
    return before.unionByName(gone), after


@query("corpus_changes_between", f"""
    WITH a AS (SELECT document_id, CASE WHEN content_sha256[1] = '2' THEN reverse(content_sha256) ELSE content_sha256 END AS content, CASE WHEN content_sha256[1] = '1' THEN 'old' ELSE 'm' END AS meta, chunk_ids, chunk_text_sha256 FROM corpus_state WHERE content_sha256[1] <> '0'
               UNION ALL SELECT 'old:' || document_id, content_sha256, 'm', chunk_ids, chunk_text_sha256 FROM corpus_state WHERE content_sha256[1] = '3'),
    b AS ({_STATE}),
    j AS (SELECT coalesce(a.document_id, b.document_id) AS document_id, CASE WHEN a.document_id IS NULL THEN 'document_added' WHEN b.document_id IS NULL THEN 'document_removed' WHEN a.content IS DISTINCT FROM b.content_sha256 THEN 'content_changed'
          WHEN a.meta <> 'm' THEN 'metadata_changed' WHEN a.chunk_ids IS DISTINCT FROM b.chunk_ids OR a.chunk_text_sha256 IS DISTINCT FROM b.chunk_text_sha256 THEN 'chunking_changed' ELSE 'unchanged' END AS reason, a.chunk_ids AS x, b.chunk_ids AS y FROM a FULL JOIN b ON a.document_id = b.document_id),
    k AS (SELECT *, CASE reason WHEN 'document_added' THEN 'new' WHEN 'document_removed' THEN 'deleted' WHEN 'unchanged' THEN 'unchanged' ELSE 'changed' END AS action FROM j)
    SELECT document_id, action, reason, CASE WHEN action IN ('changed', 'deleted') THEN len(x) ELSE 0 END AS deletes, CASE WHEN action IN ('changed', 'new') THEN len(y) ELSE 0 END AS upserts FROM k""")
def corpus_changes_between(spark, d):
    diff = C.snapshot_diff(*_snapshots(spark, d))
    return diff.select("document_id", "action", "reason", F.size("delete_chunk_ids").alias("deletes"), F.size("upsert_chunk_ids").alias("upserts"))


_LAST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY generated_at DESC, received_at DESC, action, reason) AS k FROM corpus_changes{w}) WHERE k = 1"


@query("corpus_changes_latest", f"SELECT document_id, action, reason, generated_at FROM ({_LAST.format(w='')})")
def corpus_changes_latest(spark, d):
    return C.latest_changes(table(spark, d, "corpus_changes")).select("document_id", "action", "reason", "generated_at")


@query("replayed_state", f"SELECT document_id, current_content_sha256 AS content_sha256 FROM ({_LAST.format(w=chr(32) + 'WHERE action <> ' + chr(39) + 'unchanged' + chr(39))}) WHERE action <> 'delete'")
def replayed_state(spark, d):
    return C.replay(table(spark, d, "corpus_changes"))


@query("late_changes", "SELECT date_trunc('day', received_at) AS day, count(*) AS n, count(*) FILTER (WHERE received_at > CAST(generated_at AS TIMESTAMP) + INTERVAL 1 DAY) AS late FROM (SELECT DISTINCT document_id, action, reason, generated_at, received_at FROM corpus_changes) GROUP BY 1")
def late_changes(spark, d):
    rows = table(spark, d, "corpus_changes").select("document_id", "action", "reason", "generated_at", "received_at").distinct()
    late = F.col("received_at") > F.col("generated_at").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    return rows.groupBy(F.date_trunc("day", "received_at").cast("timestamp_ntz").alias("day")).agg(F.count("*").alias("n"), F.count_if(late).alias("late"))


_SIDES = {
    "queue": "SELECT DISTINCT document_id FROM chunks WHERE document_kind = 'attachment'", "index_": "SELECT DISTINCT 'attachment:' || content_sha256 AS document_id FROM text_index WHERE content_sha256 IS NOT NULL",
    "state": "SELECT DISTINCT document_id FROM corpus_state WHERE kind = 'attachment'", "changed": "SELECT DISTINCT document_id FROM corpus_changes WHERE kind = 'attachment'",
}
_PAIRS = [
    ("queue", "index_", "missing_index_record"), ("queue", "state", "missing_state_record"), ("index_", "queue", "orphan_index_record"), ("state", "queue", "orphan_state_record"),
    ("changed", "state", "change_without_state"), ("state", "changed", "state_without_change"),
]


@query("reconciliation", " UNION ALL ".join(f"SELECT '{issue}' AS issue_type, document_id FROM ({_SIDES[a]} EXCEPT {_SIDES[b]})" for a, b, issue in _PAIRS))
def reconciliation(spark, d):
    """Attachments in the chunks, the index, the state and the change log, each held against the others."""
    return J.reconcile(_sides(spark, d), "document_id", _PAIRS)


def _sides(spark, d):
    index = table(spark, d, "text_index").filter("content_sha256 is not null").select(F.concat(F.lit("attachment:"), "content_sha256").alias("document_id"))
    own = {name: table(spark, d, t).filter("kind = 'attachment'" if t != "chunks" else "document_kind = 'attachment'").select("document_id") for name, t in (("queue", "chunks"), ("state", "corpus_state"), ("changed", "corpus_changes"))}
    return own | {"index_": index}


@query("stream_windows", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, event_type, count(*) AS n FROM events GROUP BY 1, 2, 3")
def stream_windows(spark, d):
    """Events of a day by type through Structured Streaming; the stream ends with its input."""
    source = table(spark, d, "events")
    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    counted = feeds.windowed_counts(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type", "1 day")
    rows = feeds.run_to_files(counted, f"{feeds.scratch(spark)}/windows", "complete")
    return rows.select(F.col("window_start").cast("timestamp_ntz"), F.col("window_end").cast("timestamp_ntz"), "event_type", "n")


@query("stream_distinct_changes", "SELECT action, reason, count(*) AS n FROM (SELECT DISTINCT document_id, generated_at, action, reason FROM corpus_changes) GROUP BY 1, 2")
def stream_distinct_changes(spark, d):
    """The change log without its repeated rows, as a stream."""
    source = table(spark, d, "corpus_changes")
    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "*.parquet").parquet(f"{d}/corpus_changes.parquet*")
    rows = feeds.distinct_changes(stream.withColumn("received_at", F.col("received_at").cast("timestamp")), "3650 days")
    found = feeds.run_to_files(rows.select("document_id", "action", "reason"), f"{feeds.scratch(spark)}/changes", "append")
    return found.groupBy("action", "reason").agg(F.count("*").alias("n"))
