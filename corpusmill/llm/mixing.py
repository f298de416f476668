"""Mixing sources to target shares of tokens along a time-varying curriculum (problem 7).

Sizes are tokens of a public tokenizer. A mix takes the largest total for which every source reaches its share
without using a document more than ``max_repeats`` times; where no source is capped, the total at which every
document is used at least once. Over the training each source's weight moves linearly from a start towards its own share of the
data to an end as far on the other side, so that it averages to the target. Integrating that schedule gives the tokens
demanded up to each moment; inverting it at a document's place in its source's stream gives the position at which the
document is trained on. Sorting by position makes the mixed stream.

Scale: documents are read and tokenized once; places in a stream are prefix sums over (source, block), so a source of any
size is spread over many tasks; per-source tables are small (one row per source and mix) and joined as such.
"""

from __future__ import annotations

import base64
import importlib.util
import os

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_columns

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Blocks of a source's stream are told by so many bits of a hash.
BLOCK_BITS = 12
#: Copies of one document that one row is turned into at once.
COPIES = 1000


def tokenizer_dir() -> str:
    """Folder of the public vocabularies: CORPUSMILL_TOKENIZERS, else where the package that holds them is installed."""
    if path := os.environ.get("CORPUSMILL_TOKENIZERS"):
        return path
    spec = importlib.util.find_spec("public_tokenizers")
    return os.path.dirname(spec.origin) if spec else "/opt/tokenizers"


class TokenCounter:
    """Tokens of a text by a byte-level BPE; the counts of pieces that come again are kept."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pieces = regex.compile(public_tokenizers.PATTERN)
        self.encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}

    def count(self, text: str) -> int:
        known = self.known
        pieces = self.pieces.findall(text)
        try:
            return sum([known[p] for p in pieces])
        except KeyError:
            if len(known) > 1_000_000:
                known.clear()
            for p in pieces:
                if p not in known:
                    n = len(self.encode.encode_ordinary(p))
                    if len(p) > 64:
                        return len(self.encode.encode_ordinary(text))
                    known[p] = n
            return sum([known[p] for p in pieces])


def token_counts(df: DataFrame, doc_id: str, text: str, source: str, path: str) -> DataFrame:
    """(doc_id, source, tokens) of every row with an id, a source and a text."""
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text).alias("text")).dropna()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = run.__dict__.get("counter") or run.__dict__.setdefault("counter", TokenCounter(path))
        n = pa.array([counter.count(t) for t in batch.column(2).to_pylist()], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], names=["doc_id", "source", "tokens"])

    return map_columns(rows, run, "doc_id long, source string, tokens long")


def _streams(counts: DataFrame) -> DataFrame:
    """(doc_id, source, tokens, before): tokens of the source's documents that come earlier in its stream. The order is that of a
    hash of the id; blocks of the hash are summed first, so no task sees a whole source."""
    rows = counts.withColumn("h", F.xxhash64("doc_id", F.lit(11))).withColumn("block", F.shiftrightunsigned("h", 64 - BLOCK_BITS).cast("int"))
    blocks = rows.groupBy("source", "block").agg(F.sum("tokens").alias("n"))
    up_to = F.sum("n").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("source", "block", F.coalesce(up_to, F.lit(0)).alias("base"))
    inner = F.sum("tokens").over(Window.partitionBy("source", "block").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("inner", F.coalesce(inner, F.lit(0)))
    return rows.join(blocks, ["source", "block"]).select("doc_id", "source", "tokens", (F.col("base") + F.col("inner")).alias("before"))


def _copies(uses: DataFrame) -> DataFrame:
    """A row for each ``copy`` from 0 below ``n``. Rows of many copies become ranges of copies first, which are spread over the tasks."""
    few = uses.filter(F.col("n") <= COPIES).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    many = uses.filter(F.col("n") > COPIES)
    # about as many ranges as copies in a range where there are more than COPIES squared
    step = F.greatest(F.lit(COPIES), F.ceil(F.sqrt("n"))).cast("long")
    many = many.withColumn("step", step).withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.col("step"))))
    parts = int(uses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = many.repartition(parts, "mix_id", "doc_id", "from").withColumn("copy", F.explode(F.sequence("from", F.least(F.col("from") + F.col("step"), F.col("n")) - 1)))
    return few.unionByName(many.drop("step", "from"))


def mix_sources(
    docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    vocabulary: str | None = None, tilt: float = 1.0,
) -> tuple[DataFrame, DataFrame]:
    """``(shares, positions)``.

    shares has a row per (mix_id, source) of ``targets(mix_id, source, target_weight, max_repeats)``: wanted_share (weights
    scaled to add up to 1 over the sources that can be used), max_repeats, docs, tokens_once, repeats (times the source
    is gone through), most_copies (of one document), tokens_used, actual_share and usable.
    positions has a row per use of a document: (mix_id, doc_id, source, copy, tokens, position), position in tokens from
    the start of the mixed stream; sort by (mix_id, position, doc_id, copy) to train.

    Defined cases: a source without documents or tokens, with a null or non-positive weight, or capped at 0 is not usable, gets
    no share, and the others' weights are scaled up; a null cap is none; a target listed twice counts once (the
    largest weight, then the largest cap); documents with a null id, source or text, and rows delivered twice, don't
    count or count once; empty texts have no tokens; an empty table on either side gives no positions.
    """
    path = vocabulary or os.path.join(tokenizer_dir(), VOCABULARY)
    counts = cut(token_counts(docs, doc_id, text, source, path).groupBy("doc_id").agg(F.min(F.struct("source", "tokens")).alias("r")).select("doc_id", "r.*"))
    own = counts.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens_once"))
    want = targets.select(
        F.col("mix_id").cast("long").alias("mix_id"), F.col("source").cast("string").alias("source"), F.col("target_weight").cast("double").alias("target_weight"), F.col("max_repeats").cast("long").alias("max_repeats")
    ).filter("mix_id is not null and source is not null")
    best = F.max(F.struct(F.coalesce("target_weight", F.lit(0.0)).alias("w"), F.coalesce("max_repeats", F.lit(1 << 60)).alias("c")))
    want = want.groupBy("mix_id", "source").agg(best.alias("b")).select(
        "mix_id", "source", F.col("b.w").alias("target_weight"), F.when(F.col("b.c") < 1 << 60, F.col("b.c")).alias("max_repeats")
    )
    plan = want.join(own, "source", "left").fillna(0, ["docs", "tokens_once"])
    usable = (F.col("tokens_once") > 0) & (F.col("target_weight") > 0) & F.coalesce(F.col("max_repeats") > 0, F.lit(True)) & ~F.isnan("target_weight")
    by_mix = Window.partitionBy("mix_id")
    plan = plan.withColumn("usable", usable).withColumn("w", F.when(F.col("usable"), F.col("target_weight")).otherwise(0.0))
    plan = plan.withColumn("wanted_share", F.coalesce(F.try_divide("w", F.sum("w").over(by_mix)), F.lit(0.0)))
    at_cap = F.when(F.col("usable") & F.col("max_repeats").isNotNull(), F.col("max_repeats") * F.col("tokens_once") / F.col("wanted_share"))
    at_once = F.when(F.col("usable"), F.col("tokens_once") / F.col("wanted_share"))
    plan = plan.withColumn("total", F.coalesce(F.min(at_cap).over(by_mix), F.max(at_once).over(by_mix), F.lit(0.0)))
    plan = plan.withColumn("demand", F.col("total") * F.col("wanted_share"))
    # the schedule: weight(t) = wanted + slope * (t - 1/2), t from 0 to 1; never below 0, always adding up to 1
    natural = F.try_divide(F.when(F.col("usable"), F.col("tokens_once")).otherwise(0), F.sum(F.when(F.col("usable"), F.col("tokens_once"))).over(by_mix))
    plan = plan.withColumn("away", F.coalesce(natural, F.lit(0.0)) - F.col("wanted_share"))
    room = F.when(F.col("away") != 0, 2 * F.col("wanted_share") / F.abs("away"))
    plan = plan.withColumn("slope", -F.col("away") * F.least(F.lit(tilt), F.coalesce(F.min(room).over(by_mix), F.lit(0.0))))
    plan = cut(plan, 1)
    use = plan.filter("usable").select("mix_id", "source", "tokens_once", "demand", "total", "wanted_share", "slope")
    stream = cut(_streams(counts).filter("tokens > 0"))
    # copy c of a document begins at c * tokens_once + before, and is used if its middle lies within the demand
    n = F.floor((F.col("demand") - F.col("before") - F.col("tokens") / 2) / F.col("tokens_once")) + 1
    uses = stream.join(use, "source").withColumn("n", F.greatest(F.lit(0), n).cast("long")).filter("n > 0")
    used = uses.groupBy("mix_id", "source").agg(F.sum(F.col("tokens") * F.col("n")).alias("tokens_used"), F.max("n").alias("most_copies"))
    uses = _copies(uses).withColumn("start", F.col("copy") * F.col("tokens_once") + F.col("before"))
    # tokens demanded by t: total * ((wanted - slope / 2) t + slope t^2 / 2); solved for t
    a, b, c = F.col("slope") / 2, F.col("wanted_share") - F.col("slope") / 2, F.col("start") / F.col("total")
    t = F.when(c <= 0, F.lit(0.0)).otherwise(2 * c / (b + F.sqrt(F.greatest(F.lit(0.0), b * b + 4 * a * c))))
    positions = uses.select("mix_id", "doc_id", "source", (F.col("copy") + 1).alias("copy"), "tokens", F.round(t * F.col("total")).cast("long").alias("position"))
    shares = plan.join(used, ["mix_id", "source"], "left").fillna(0, ["tokens_used", "most_copies"])
    shares = shares.select(
        "mix_id", "source", "target_weight", "wanted_share", "max_repeats", "docs", "tokens_once",
        F.coalesce(F.try_divide("demand", "tokens_once"), F.lit(0.0)).alias("repeats"), "most_copies", "tokens_used",
        F.coalesce(F.try_divide("tokens_used", F.sum("tokens_used").over(by_mix)), F.lit(0.0)).alias("actual_share"), "usable",
    )
    return shares, positions


def curriculum(positions: DataFrame) -> DataFrame:
    """Positions range-sorted into training order: the files of the result follow each other."""
    return positions.repartitionByRange("mix_id", "position").sortWithinPartitions("mix_id", "position", "doc_id", "copy")
