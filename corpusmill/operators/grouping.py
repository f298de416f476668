"""Ranking, deduplication, counting and ordering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import known

BROADCAST_KEYS = 200_000


def bounded_broadcast(df: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, which is counted; else unchanged, and joins shuffle it."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def delivered_once(df: DataFrame, key: str) -> DataFrame:
    """Distinct rows of a table in which equal rows have equal, non-null keys: only the rows of keys that came more than once are
    shuffled, the others stay where they are."""
    again = bounded_broadcast(df.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(key))
    return df.join(again, key, "left_anti").unionByName(df.join(again, key, "left_semi").distinct())


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of each group. Spark keeps only ``n`` rows a group in the map stage (window group limit)."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_rank") <= n).drop("_rank")


def last_wins(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """One row per key, the one that came last: a keyed table written over and over."""
    return top_per_group(df, keys, [F.desc(position)])


def first_rows(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """One row per key, the one that came first."""
    return top_per_group(df, keys, [F.asc(position)])


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows by keys; null and empty keys are 'unknown'."""
    return df.groupBy(*[known(F.col(k).cast("string")).alias(k) for k in keys]).agg(F.count("*").alias(name))


def counts_of_each(df: DataFrame, columns: list[str]) -> DataFrame:
    """(metric, key, n): rows by each of the columns alone, in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), known(F.col(c).cast("string")).alias("key")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.metric", "p.key").agg(F.count("*").alias("n"))


def duplicate_groups(df: DataFrame, key: str) -> DataFrame:
    """(key, n) of the keys that occur more than once."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")


def extra_copies(df: DataFrame, key: str) -> DataFrame:
    """One row: groups of equal keys and the copies beyond the first of each."""
    return duplicate_groups(df, key).agg(F.count("*").alias("duplicate_groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_copies"))


def collect_in_order(df: DataFrame, keys: list[str], position: str, value: str, name: str) -> DataFrame:
    """Values of each group as an array in order of position, blanks and repetitions left out."""
    rows = df.filter(F.col(value).isNotNull() & (F.trim(value) != "")).groupBy(*keys, F.trim(value).alias("_v")).agg(F.min(position).alias("_p"))
    return rows.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_v"))), lambda x: x["_v"]).alias(name))


def number_rows(df: DataFrame, order: list[str], name: str, pattern: str) -> DataFrame:
    """Ids of rows in total order, without moving all rows to one task: a range sort, the rows of each range counted, and the
    counts before a range added to the place within it. ``order`` must be a key. The number of ranges is fixed, so that adaptive
    execution doesn't merge them differently in the two branches that read them."""
    sorted_df = df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
    parts = sorted_df.withColumn("_part", F.spark_partition_id())
    inner = parts.withColumn("_in", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = inner.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_part", before.alias("_before"))  # one row a partition
    return inner.join(F.broadcast(sizes), "_part").withColumn(name, F.format_string(pattern, F.col("_before") + F.col("_in"))).drop("_part", "_in", "_before")


def number_within(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """chunk_index from 0, chunk_number from 1 and chunk_count of each group."""
    w = Window.partitionBy(*keys)
    n = F.row_number().over(w.orderBy(*order))
    return df.select("*", (n - 1).alias("chunk_index"), n.alias("chunk_number"), F.count("*").over(w).cast("int").alias("chunk_count"))


def sequence_errors(df: DataFrame, key: str, index: str, declared: str) -> DataFrame:
    """Groups whose indexes aren't 0 .. n-1, or whose declared sizes aren't n."""
    g = df.groupBy(key).agg(
        F.count("*").alias("n"), F.min(index).alias("lo"), F.max(index).alias("hi"), F.count_distinct(index).alias("distinct_indexes"),
        F.min(declared).alias("least_declared"), F.max(declared).alias("most_declared"), F.count(declared).alias("n_declared"),
    )
    bad_sequence = ~((F.col("lo") == 0) & (F.col("hi") == F.col("n") - 1) & (F.col("distinct_indexes") == F.col("n")))
    bad_count = ~((F.col("least_declared") == F.col("n")) & (F.col("most_declared") == F.col("n")) & (F.col("n_declared") == F.col("n")))
    g = g.select(key, "n", F.coalesce(bad_sequence, F.lit(True)).alias("sequence_error"), F.coalesce(bad_count, F.lit(True)).alias("count_error"))
    return g.filter("sequence_error or count_error")


def natural_order(c: Column) -> list[Column]:
    """Sort keys under which figures inside names count as numbers."""
    return [F.regexp_replace(c, r"\d+", "#"), F.transform(F.regexp_extract_all(c, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.cast("decimal(38,0)")), c]


def select_queue(df: DataFrame, sources: DataFrame | None = None, extensions: list[str] | None = None, done: DataFrame | None = None, key: str = "effective_url") -> DataFrame:
    """Queue rows of given sources and extensions whose key isn't done yet; what isn't given doesn't select."""
    if sources is not None:
        df = df.join(sources.select("source_id").distinct(), "source_id", "left_semi")
    if extensions is not None:
        df = df.filter(F.lower("extension").isin(*[e.lower() for e in extensions]))
    return df if done is None else df.join(done.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def highest_rank(df: DataFrame, keys: list[str], value: str, ranks: dict[str, int], position: str) -> DataFrame:
    """The row of each group whose value ranks highest, the first of equals."""
    rank = F.coalesce(*[F.when(F.col(value) == v, r) for v, r in ranks.items()], F.lit(0))
    return top_per_group(df, keys, [rank.desc(), F.asc(position)])


def first_match(*cases: tuple[Column, str], otherwise: str | None = None) -> Column:
    """Name of the first case that holds: an ordered decision table."""
    out = None
    for when, name in cases:
        out = F.when(when, name) if out is None else out.when(when, name)
    return out.otherwise(F.lit(otherwise)) if out is not None else F.lit(otherwise)
