"""Records in files: JSON lines, gzipped JSON blobs, YAML rules; and their sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or a pattern of paths, has a file."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(jpath)
    return found is not None and len(found) > 0


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Strict: a missing file or a malformed line fails; blank lines and rows that aren't objects are dropped."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return _objects(lines, schema, strict=True)


def read_jsonl_optional(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """As ``read_jsonl``, empty where there is no file."""
    return read_jsonl(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema)


def read_jsonl_typed(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """As ``read_jsonl_optional``, but a line that is no object fails as a malformed one does."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return _objects(lines, schema, strict=True, typed=True)


def _objects(lines: DataFrame, schema, strict: bool, typed: bool = False) -> DataFrame:
    kind = F.schema_of_variant(F.try_parse_json("value"))
    lines = lines.withColumn("_kind", kind)
    if strict:
        lines = lines.withColumn("_kind", F.when(F.col("_kind").isNull(), F.raise_error(F.concat(F.lit("malformed JSON line: "), F.substring("value", 1, 120)))).otherwise(F.col("_kind")))
    if typed:
        wrong = F.raise_error(F.concat(F.lit("JSON line that is no object: "), F.substring("value", 1, 120)))
        lines = lines.withColumn("_kind", F.when(~F.startswith("_kind", F.lit("OBJECT")), wrong).otherwise(F.col("_kind")))
    return lines.filter(F.startswith("_kind", F.lit("OBJECT"))).select(F.from_json("value", schema).alias("r")).select("r.*")


def read_jsonl_audited(spark: SparkSession, path: str, schema: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """``(rows, issues)``: rows with ``_line`` (1-based, blank lines count), issues (line_number, issue_type) for lines that are no
    JSON or no object. Line numbers hold for one file; they come from the order of the file's splits, counted without a sort."""
    lines = spark.read.text(path)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    numbered = lines.rdd.zipWithIndex().map(lambda x: (x[1] + 1, x[0][0])).toDF("_line long, value string").filter(F.trim("value") != "")
    kind = F.schema_of_variant(F.try_parse_json("value"))
    numbered = numbered.withColumn("_kind", kind)
    rows = numbered.filter(F.startswith("_kind", F.lit("OBJECT"))).select("_line", "value", F.from_json("value", schema).alias("r")).select("_line", "value", "r.*")
    bad = numbered.filter(F.col("_kind").isNull() | ~F.startswith("_kind", F.lit("OBJECT")))
    issues = bad.select(F.col("_line").alias("line_number"), F.when(F.col("_kind").isNull(), "invalid_json").otherwise("record_not_object").alias("issue_type"))
    return rows, issues


def read_blobs(spark: SparkSession, folder: str, schema: str | T.StructType) -> DataFrame:
    """Gzipped JSON objects named by content hash: (content_sha256, fields, unreadable)."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.schema(whole).option("mode", "PERMISSIVE").option("multiLine", "true").json(f"{folder}/*.json.gz")
    return rows.select(F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)\.", 1).alias("content_sha256"), *[f.name for f in schema.fields], F.col("_corrupt_record").isNotNull().alias("unreadable"))


def read_rules(spark: SparkSession, path: str, section: str, schema: str, allowed: dict[str, set[str]] | None = None) -> DataFrame:
    """A list of rules from a YAML file as a small table; wrong shapes and values outside ``allowed`` fail."""
    import yaml

    with open(path, encoding="utf-8") as f:
        content = yaml.safe_load(f)
    rows = content.get(section) if isinstance(content, dict) else None
    if not isinstance(rows, list) or not all(isinstance(r, dict) for r in rows):
        raise ValueError(f"{section} of {path} must be a list of maps")
    for r in rows:
        for k, values in (allowed or {}).items():
            if r.get(k) not in values:
                raise ValueError(f"{k} of a rule must be one of {sorted(values)}")
    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def write_jsonl(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Compact JSON lines in column order, nulls kept; one folder per value of ``partition_by``."""
    w = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (w.partitionBy(*partition_by) if partition_by else w).json(path)


def write_blobs(df: DataFrame, key: str, path: str) -> None:
    """Content-addressed store: parquet by the first two characters of the key, one row per key."""
    rows = df.dropDuplicates([key]).withColumn("prefix", F.substring(key, 1, 2))
    rows.repartition("prefix").write.mode("overwrite").partitionBy("prefix").parquet(path)


def markdown(title, text, bullets: dict):
    """A column with a document's report: heading, bullets, text and a rule; null where there is no text."""
    lines = [F.concat(F.lit(f"- {k}: "), F.coalesce(v.cast("string"), F.lit(""))) for k, v in bullets.items()]
    body = F.concat_ws("\n", F.concat(F.lit("## "), title), F.lit(""), *lines, F.lit(""), text, F.lit(""), F.lit("---"))
    return F.when(F.trim(F.coalesce(text, F.lit(""))) != "", body)


def status_json(df: DataFrame) -> DataFrame:
    """One-row tables as pretty JSON, for status files."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false", "pretty": "true"}).alias("value"))
