"""Quality by importance resampling over hashed n-grams.

Two generative models are bags of hashed word unigrams and bigrams: one counted over
target texts (labelled good, at most ``max_target`` of them), one over all raw texts.  Their number of buckets grows with
the square root of the number of rows (``bucket_number``).  A text's log importance is the log
ratio of its probability under the two, summed over its n-grams; resampling without
replacement draws the texts with the largest sum of the log importance and a
Gumbel number seeded by the id (Gumbel top-k).  With ``per_gram`` the weight is ``per_gram``
times the mean log importance of an n-gram instead, which keeps long texts comparable with
short ones but is no longer the ratio of the two models.

Both are counted in one pass over the texts: every task sums its own bucket
vectors, so what is moved is two vectors per task.  The top k is cut at a threshold found by
counting: the interval of keys in which the k-th lies is narrowed, 1024 bins at a time, until few rows are
left in it; equal keys are then told apart by their ids in the same way, equal rows by their place.

``k`` is a share of the rows (default: the share of label 1 among the labelled
rows, at least one row).

Defined results: null and empty texts have no n-grams and log importance 0;
repeated rows get equal log importances and keys (of equal keys at the cut as many as k
allows stay); without target rows every log
importance is 0; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.llm.common import id_and_text, map_in_arrow, materialise

BUCKETS = 1 << 16      # for up to ROWS rows
ROWS = 1 << 18
MAX_TARGET = 100_000   # labelled good texts that the target model is counted over (smallest id hashes)
SMOOTHING = 0.5        # added to every bucket's count
SEED = "quality-1"
REMEMBERED = 300_000
BINS = 1024            # bins an interval is cut into
SORTED = 10_000        # rows put in order at last


def bucket_number(rows: int) -> int:
    """Buckets of the models: a power of two that grows with the square root of the rows."""
    return BUCKETS << max(0, math.ceil(math.log2(max(1, rows) / ROWS) / 2))


class Hashes:
    """Bucket numbers of a text's unigrams and bigrams over words and runs of
    signs, in lower case; a word's hash is remembered in a bounded table."""

    _word = re.compile(r"\w+|[^\w\s]+")

    def __init__(self, buckets: int):
        self.buckets = np.uint64(buckets)
        self.known: dict[str, int] = {}

    def _learn(self, word: str) -> int:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        h = self.known[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) + 1
        return h

    def grams(self, text: str) -> np.ndarray:
        known, learn = self.known, self._learn
        words = np.array([known.get(w) or learn(w) for w in self._word.findall(text.lower())], dtype=np.uint64)
        pairs = ((words[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (words[1:] * np.uint64(0xC2B2AE3D27D4EB4F))) >> np.uint64(24)
        return (np.concatenate([words, pairs]) % self.buckets).astype(np.int64)


def bucket_counts(df: DataFrame, good: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences in every bucket over the rows whose id is in ``good`` (distinct ids, column
    ``good_id``, ``max_target`` of ``resample`` at most) and over all rows, in one pass without moving a text;
    each task moves one vector of either."""
    marked = (id_and_text(df, id_col, text_col).join(F.broadcast(good), F.col(id_col) == F.col("good_id"), "left")
              .select(F.col(text_col).alias("text"), F.col("good_id").isNotNull().alias("good")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = Hashes(buckets), np.zeros((2, buckets), dtype=np.int64)
        for b in batches:
            for text, is_good in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n = np.bincount(hashes.grams(text), minlength=buckets)
                total[0] += n
                if is_good:
                    total[1] += n
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[0][at]), pa.array(total[1][at])],
                                         names=["bucket", "n", "good"])

    found = (marked.transform(map_in_arrow, run, "bucket int, n bigint, good bigint").groupBy("bucket")
             .agg(F.sum("n").alias("n"), F.sum("good").alias("good")).toArrow())  # at most ``buckets`` rows
    target, raw = np.zeros(buckets), np.zeros(buckets)
    at = found["bucket"].to_numpy()
    raw[at], target[at] = found["n"].to_numpy(), found["good"].to_numpy()
    return target, raw


def importance(df: DataFrame, target: np.ndarray, raw: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>, text_hash, n_grams, log_importance`` for every row."""
    docs = id_and_text(df, id_col, text_col).withColumn("text_hash", F.xxhash64(text_col))
    schema = T.StructType([docs.schema[id_col], T.StructField("text_hash", T.LongType()),
                           T.StructField("n_grams", T.LongType()), T.StructField("log_importance", T.DoubleType())])
    ratio = (np.log((target + SMOOTHING) / (target + SMOOTHING).sum()) - np.log((raw + SMOOTHING) / (raw + SMOOTHING).sum())
             if target.sum() else np.zeros(len(target)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(len(ratio))
        for b in batches:
            grams = [hashes.grams(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([len(g) for g in grams], pa.int64()),
                                              pa.array([float(ratio[g].sum()) for g in grams], pa.float64())],
                                             names=schema.fieldNames())

    return docs.transform(map_in_arrow, run, schema)


def gumbel(seed: str, *columns: Column) -> Column:
    """A Gumbel number from a hash of the columns."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def top_k(keyed: DataFrame, k: int, key: str, *ties: str) -> DataFrame:
    """The k rows of a written table with the largest finite ``key`` (then the smallest values of the named columns, nulls
    last, and the table's order), without a global sort: each round counts the rows left by bins of
    their interval and goes on in the bin of the k-th row."""
    if k <= 0:
        return keyed.limit(0)
    numeric = [t for t in ties if isinstance(keyed.schema[t].dataType, T.NumericType)]
    ranked = keyed.withColumn("_place", F.monotonically_increasing_id())
    levels = [F.col(key), *[F.coalesce(-F.col(c).cast("double"), F.lit(-1e300)) for c in (*numeric, "_place")]]
    inside, sure, above = F.lit(True), F.lit(False), 0
    for x in levels:
        while True:
            seen = ranked.where(inside).agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("low"), F.max(x).alias("high")).first()
            if above + seen["n"] <= k:
                return ranked.where(sure | inside).select(keyed.columns)
            if seen["n"] <= SORTED or seen["low"] == seen["high"]:
                break
            width = (seen["high"] - seen["low"]) / BINS
            number = F.least(F.lit(BINS - 1), F.floor((x - F.lit(seen["low"])) / F.lit(width)))
            bins = (ranked.where(inside).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(x).alias("low"), F.max(x).alias("high"))
                    .orderBy(F.desc("bin")).collect())  # BINS rows at most
            for cut in bins:
                if above + cut["n"] >= k:
                    break
                above += cut["n"]
            sure = sure | (inside & (x > F.lit(cut["high"])))
            inside = inside & x.between(F.lit(cut["low"]), F.lit(cut["high"]))
    order = [F.desc(key), *[F.asc_nulls_last(t) for t in ties], "_place"]
    last = ranked.where(inside).orderBy(*order).limit(k - above)  # of SORTED rows at most
    return ranked.where(sure).union(last).select(keyed.columns)


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", share: float | None = None, per_gram: float | None = None, seed: str = SEED,
             buckets: int | None = None, max_target: int = MAX_TARGET) -> DataFrame:
    """The rows drawn: ``<id>, n_grams, log_importance, key``.  The target model is counted over at most
    ``max_target`` labelled good ids (those of smallest hashes), the raw model over all rows."""
    good = materialise(
        labels.where((F.col(label_col) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("good_id")).distinct()
        .orderBy(F.xxhash64(F.col("good_id").cast("string"), F.lit(seed)), "good_id").limit(max_target), "quality-target")
    n = docs.count()
    target, raw = bucket_counts(docs, good, id_col, text_col, buckets or bucket_number(n))
    weight = (F.col("log_importance") if per_gram is None
              else F.lit(float(per_gram)) * F.col("log_importance") / F.greatest(F.col("n_grams"), F.lit(1)))
    keyed = materialise(importance(docs, target, raw, id_col, text_col).withColumn(
        "key", weight + gumbel(seed, F.coalesce(F.col(id_col).cast("string"), F.lit("")))), "quality")
    if share is None:
        share = labels.where(F.col(label_col).isNotNull()).agg(F.avg(F.col(label_col).cast("double"))).first()[0]
    k = max(min(n, 1), round(n * (1.0 if share is None else share)))
    return top_k(keyed, k, "key", id_col, "text_hash").drop("text_hash")
