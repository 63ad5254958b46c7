"""Document fingerprints by SpotSigs.

An anchor is an occurrence of a very common word; its signature is the anchor
with the chain of the next ``CHAIN`` words that are no anchors themselves.
The fingerprint of a text is the set of its signatures (64-bit hashes).
Likeness of two fingerprints is the Jaccard index of the sets: exact, pruned by
set length first (the index is at most the smaller over the larger length).

A text whose words give no signature stands for itself: its one signature is
the hash of all its words, so equal texts are alike and others are not.  Case
and signs at the ends of words do not count.

``edited``: each text is compared with an edited copy (its last quarter
replaced by the beginning of the next text) and with the next text itself, in
id order.  That order is found without sorting the texts globally: quantiles
of the ids cut them into ranges, each range goes to one task and is sorted
there, and the first text of a range goes to the range before it as well.
One shuffle of the texts.

``similar`` (for large sets of texts use thresholds near 1): all pairs of fingerprints with likeness of at least a threshold.
Sets are partitioned by length; a set meets only partitions whose lengths can
reach the threshold, and there only sets that share one of its rarest
signatures (a pair above the threshold shares at least one of the first
``n - ceil(threshold * n) + 1`` in any common order).

Defined results: a null text is empty; two texts without words are alike (1);
rows with a null id come first, of equal ids the order is by text; repeated
rows are their own neighbours; a single row is its own next text; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.llm.common import id_and_text, map_in_arrow

CHAIN = 2
# Very common words of English, German, French and Spanish.
ANCHORS = frozenset("""
a an and are as at be by for from has have he in is it its of on or that the this to was were will with
auf aus bei das dem den der des die ein eine einen einer es für im ist mit nicht sich sie und von war wie zu zum
au aux avec ce cette dans de du elle en est et il la le les ne ou par pas pour que qui se sur un une
al como con del el ella esta la las lo los más no para pero por que se si su sus un una y
""".split())
SIGNS = ".,;:!?\"'()[]{}<>%$*&#|-"
RANGE_ROWS = 4000     # texts of one id range, about
MAX_RANGES = 1 << 16  # bounds the list of range limits that goes with the plan
REMEMBERED = 300_000
_ANCHOR, _NOTHING = 1, 2  # low two bits of a remembered word
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class Signer:
    """Signature sets of texts; a word's hash and kind are remembered in a bounded table."""

    def __init__(self, chain: int = CHAIN, anchors: frozenset = ANCHORS):
        self.chain, self.anchors = chain, anchors
        self.known: dict[str, int] = {}

    def _learn(self, word: str) -> int:
        bare = word.lower().strip(SIGNS)
        kind = _NOTHING if not bare else _ANCHOR if bare in self.anchors else 0
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        h = self.known[word] = xxhash.xxh64_intdigest(bare.encode("utf-8", "surrogatepass")) & ~3 | kind
        return h

    def signatures(self, text: str) -> np.ndarray:
        """Sorted distinct 64-bit signatures."""
        known, learn = self.known, self._learn
        words = np.array([known.get(w) or learn(w) for w in text.split()], dtype=np.uint64)
        kind = words & np.uint64(3)
        words = words[kind != _NOTHING]
        kind = kind[kind != _NOTHING]
        content = np.flatnonzero(kind == 0)
        anchor = np.flatnonzero(kind == _ANCHOR)
        first = np.searchsorted(content, anchor)  # number of content words before: the chain's first
        ok = first + self.chain <= len(content)
        anchor, first = anchor[ok], first[ok]
        if not len(anchor):
            return np.array([xxhash.xxh64_intdigest(words.tobytes())], dtype=np.uint64) if len(words) else words
        sig = words[anchor]
        for k in range(self.chain):
            sig = (sig ^ (sig >> np.uint64(29))) * _MIX[k % 3] + words[content[first + k]]
        return np.unique(sig)


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard index of two sorted sets; 0 where their lengths alone keep it below ``at_least``."""
    small, large = sorted((len(a), len(b)))
    if large == 0:
        return 1.0
    if small / large < at_least:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (small + large - both)


def digest(sigs: np.ndarray) -> str:
    """Number of signatures and a 128-bit hash of the set."""
    return f"{len(sigs)}:{xxhash.xxh3_128_hexdigest(sigs.astype('<u8').tobytes())}"


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = CHAIN) -> DataFrame:
    """``<id>, signatures`` (sorted longs by unsigned value) for every row."""
    docs = id_and_text(df, id_col, text_col)
    schema = T.StructType([docs.schema[id_col], T.StructField("signatures", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(chain)
        for b in batches:
            sets = [signer.signatures(t).view(np.int64) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], names=schema.fieldNames())

    return docs.transform(map_in_arrow, run, schema)


# ---------------------------------------------------------------- a text, its edited copy and its neighbour
def _ranges(keyed: DataFrame) -> tuple[list[int], list[int | None], list[int]]:
    """Lower limits of the id ranges, each range's first key, and the range before it that has rows."""
    n = keyed.count()
    parts = max(1, min(MAX_RANGES, n // RANGE_ROWS))
    limits = keyed.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)] or [0.5], 10 * parts + 1000)
                       .alias("q")).first()["q"] or []
    limits = sorted(set(limits)) if parts > 1 else []
    found = keyed.groupBy(_range_of(F.col("key"), limits).alias("range")).agg(F.min("key").alias("first")).collect()
    firsts: list[int | None] = [None] * (len(limits) + 1)
    for r in found:  # at most MAX_RANGES rows
        firsts[r["range"]] = r["first"]
    full = [i for i, f in enumerate(firsts) if f is not None]
    before = {r: full[i - 1] for i, r in enumerate(full)}
    return limits, firsts, [before.get(i, 0) for i in range(len(firsts))]


def _longs(values: list[int | None]) -> Column:
    return F.from_json(F.lit("[" + ",".join("null" if v is None else str(v) for v in values) + "]"), "array<bigint>")


def _range_of(key: Column, limits: list[int]) -> Column:
    """Number of limits at or below the key, by binary search."""
    if not limits:
        return F.lit(0)
    table = _longs(limits)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(limits).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(limits)) & (F.coalesce(F.get(table, at + step - 1), F.lit(0)) <= key), at + step).otherwise(at))


def edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = CHAIN) -> DataFrame:
    """``<id>, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next`` for every row; ``id_col`` holds integers."""
    lowest = F.lit(-(1 << 63)).cast("long")
    key = F.coalesce(F.col(id_col).cast("long"), lowest)
    limits, firsts, before = _ranges(df.select(key.alias("key")))
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), key.alias("key"))
    home = docs.withColumn("range", _range_of(F.col("key"), limits))
    places = F.when(F.col("key") == F.get(_longs(firsts), F.col("range")),
                    F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("copy")),
                            F.struct(F.get(_longs(before), F.col("range")).cast("int").alias("range"), F.lit(True).alias("copy")))
                    ).otherwise(F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("copy"))))
    dealt = (home.withColumn("place", F.explode(places))
             .select("id", "text", "key", F.col("place.range").alias("range"), F.col("place.copy").alias("copy"))
             .repartition(max(len(firsts), 2), "range").sortWithinPartitions("range", "copy", "key", "text")
             .select("id", "text", "range", "copy"))
    schema = T.StructType([T.StructField(id_col, docs.schema["id"].dataType), T.StructField("n_chars", T.LongType()),
                           T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
                           T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
                           T.StructField("near_next", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(chain)
        rows: list[tuple] = []
        last = None  # (range, id, text, signatures) that waits for its next text
        kind = None

        def out():
            cols = list(zip(*rows))
            types = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=schema.fieldNames())
            rows.clear()
            return batch

        for b in batches:
            kind = b.column(0).type
            for doc, text, place, copy in zip(*(c.to_pylist() for c in b.columns)):
                if copy and (last is None or last[0] != place):
                    continue  # only the first copy follows the range's last text
                sigs = signer.signatures(text)
                if last is not None and last[0] == place:
                    _, its_id, its, own = last
                    n = len(its)
                    changed = its[:n - n // 4] + text[:n // 4]
                    new = signer.signatures(changed)
                    rows.append((its_id, n, hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                                 digest(own), digest(new), likeness(own, new), likeness(own, sigs)))
                last = None if copy else (place, doc, text, sigs)
            if rows:
                yield out()

    return dealt.transform(map_in_arrow, run, schema)


# ---------------------------------------------------------------- all similar pairs
def similar(prints: DataFrame, id_col: str = "doc_id", threshold: float = 0.8) -> DataFrame:
    """``a, b, likeness`` of all pairs of distinct fingerprints with likeness of at
    least ``threshold`` and rows in common; ``a`` and ``b`` are the smallest ids
    with that fingerprint.  Fingerprints without signatures have no pairs, and at a
    threshold of 1 none has, as distinct ones are never that alike."""
    if threshold >= 1:
        return prints.select(F.col(id_col).alias("a"), F.col(id_col).alias("b"), F.lit(1.0).alias("likeness")).where(F.lit(False))
    classes = (prints.where(F.size("signatures") > 0).groupBy("signatures").agg(F.min(id_col).alias("id"))
               .where(F.col("id").isNotNull()).withColumn("n", F.size("signatures")))
    counts = classes.select(F.explode("signatures").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    ranked = (classes.select("id", "n", F.explode("signatures").alias("s")).join(counts, "s")
              .groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("order")))
    prefix = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9).cast("int") + 1
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(1 / threshold)) + 1e-9).cast("int")
    index = ranked.select("id", "n", F.explode(F.slice("order", F.lit(1), prefix)).alias("o")).select("id", "n", F.col("o.s").alias("s"))
    left = index.withColumn("band", band)
    right = index.select(F.col("id").alias("id2"), F.col("n").alias("n2"), "s",
                         F.explode(F.array(band - 1, band, band + 1)).alias("band"))
    met = (left.join(right, ["band", "s"]).where((F.col("id") < F.col("id2"))
                                                  & (F.least("n", "n2") >= F.lit(threshold - 1e-9) * F.greatest("n", "n2")))
           .select("id", "id2").distinct())
    sets = classes.select("id", "signatures")
    both = F.size(F.array_intersect("signatures", "s2"))
    like = both / (F.size("signatures") + F.size("s2") - both)
    return (met.join(sets, "id").join(sets.select(F.col("id").alias("id2"), F.col("signatures").alias("s2")), "id2")
            .select(F.col("id").alias("a"), F.col("id2").alias("b"), like.alias("likeness"))
            .where(F.col("likeness") >= F.lit(threshold)))
