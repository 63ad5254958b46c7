"""Near-duplicate documents by SimHash.

``fingerprints``: one pass over the whole texts.  ``link``: all pairs of
distinct fingerprints within the radius, found without comparing everything
with everything: with ``radius + 2`` bands, two fingerprints that differ in at
most ``radius`` bits agree on two whole bands, so each fingerprint goes once
to the block of every pair of its bands.  Blocks with a single fingerprint
are dropped before anything is moved.

A block is compared bit-sliced: the 64 bit planes are stored vertically, 64
fingerprints to a machine word; each plane's differences are added into
carry-save counters for all pairs at once, and the block is abandoned as soon
as every pair has passed the radius.  Neighbouring small blocks are compared
together (a pair they find outside its block is a true link too).  A block of
more than ``BLOCK`` fingerprints is dealt into chunks, and every pair of
chunks is a block of its own: exact, and bounded in memory.  A block gives
the edges of a spanning forest, not its pairs.

Components run over distinct fingerprints, so a group of equal texts, however
large, is one node.

Defined results: a null text is empty; a text without words has fingerprint
zero and links like any other; repeated rows share a component; a null id
gives no component id to others (a group of null ids only has a null one); an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.llm.common import connected_components, id_and_text, in_slices, map_in_arrow, materialise

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
BLOCK = 2048          # fingerprints of one chunk of a block
TOGETHER = 1024       # rows of small blocks compared at once
COUNT_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash; a bit is 1 if set in over half of the shingle hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and x20, x09-x0D only
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
        n = len(words) - shingle_words + 1
    hashes = map(partial(xxhash.xxh64_intdigest, seed=seed), shingles)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, COUNT_AT_ONCE):
        h = np.fromiter(hashes, dtype="<u8", count=min(COUNT_AT_ONCE, n - at))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``<id>, fp`` (the 64 bits as a long), ``text_hash`` for every row."""
    docs = id_and_text(df, id_col, text_col).withColumn("text_hash", F.xxhash64(text_col))
    schema = T.StructType([docs.schema[id_col], T.StructField("fp", T.LongType()),
                           T.StructField("text_hash", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in in_slices(batches):
            fps = np.array([fingerprint(t, shingle_words) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64), pa.int64()), b.column(2)],
                                             names=schema.fieldNames())

    return docs.transform(map_in_arrow, run, schema)


# ---------------------------------------------------------------- one block
def within_radius(fps: np.ndarray, radius: int) -> np.ndarray | None:
    """Packed symmetric bit matrix (n rows, n bits in little order) of the pairs
    of ``fps`` (uint64) within ``radius``, itself excluded; None if there are none."""
    n = len(fps)
    words = -(-n // 64)
    bits = np.unpackbits(fps.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")  # n x 64
    padded = np.zeros((64, words * 64), dtype=np.uint8)
    padded[:, :n] = bits.T
    planes = np.packbits(padded, axis=1, bitorder="little").view("<u8")  # 64 x words
    flip = (-bits.astype(np.int64)).view(np.uint64)  # n x 64: all ones where the row's bit is 1
    gone = np.zeros((n, words), dtype=np.uint64)  # pairs past the radius
    if n % 64:
        gone[:, -1] = ~np.uint64((1 << (n % 64)) - 1)
    rows = np.arange(n)
    gone[rows, rows // 64] |= np.uint64(1) << (rows % 64).astype(np.uint64)
    full = ~np.uint64(0)
    counters = [np.zeros((n, words), dtype=np.uint64) for _ in range((radius + 1).bit_length())]
    limit = radius + 1  # the count at which a pair leaves; the counters pass through it before they wrap
    for j in range(64):
        carry = planes[j] ^ flip[:, j:j + 1]
        for c in counters:
            up = c & carry
            c ^= carry
            carry = up
        if j >= radius:
            hit = np.full((n, words), full)
            for k, c in enumerate(counters):
                hit &= c if limit >> k & 1 else ~c
            gone |= hit
            if j % 8 == 7 and (gone == full).all():
                return None
    near = ~gone
    return near if near.any() else None


def forest(near: np.ndarray, n: int) -> np.ndarray:
    """Smallest row of each row's component, by growing packed frontiers."""
    root = np.arange(n)
    left = np.zeros(near.shape[1] * 64, dtype=bool)
    left[:n] = True
    linked = np.flatnonzero(near.any(axis=1))
    for i in linked:
        if not left[i]:
            continue
        left[i] = False
        frontier = np.array([i])
        while len(frontier):
            reached = np.bitwise_or.reduce(near[frontier], axis=0)
            hit = np.unpackbits(reached.view(np.uint8), bitorder="little").astype(bool) & left
            frontier = np.flatnonzero(hit)
            left[frontier] = False
            root[frontier] = i
    return root


def _edges(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    fps = np.unique(fps)
    near = within_radius(fps, radius) if len(fps) > 1 else None
    if near is None:
        return fps[:0], fps[:0]
    root = forest(near, len(fps))
    other = np.flatnonzero(root != np.arange(len(fps)))
    return fps[root[other]], fps[other]


def link(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints (column ``fp``) whose
    closure is that of all pairs within ``radius`` bits."""
    bands = radius + 2
    cuts = [round(64 * i / bands) for i in range(bands + 1)]
    band = [((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in range(bands)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    masks = [signed(band[i] | band[j]) for i, j in combinations(range(bands), 2)]
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("p", "m"))
    crowded = (keyed.groupBy("p", "m").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
               .withColumn("chunks", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")))
    members = keyed.join(crowded, ["p", "m"])
    own = F.pmod(F.xxhash64("fp", F.lit("chunk")), F.col("chunks")).cast("int")
    dealt = (members.withColumn("c", own)
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select(F.xxhash64("p", "m", F.least("c", "o"), F.greatest("c", "o")).alias("block"), "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key = np.zeros(0, dtype=np.int64)
        held = np.zeros(0, dtype=np.uint64)

        def out(fps):
            a, b = _edges(fps, radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for b in batches:
            held_key = np.concatenate([held_key, b.column(0).to_numpy()])
            held = np.concatenate([held, b.column(1).to_numpy().view(np.uint64)])
            ends = np.flatnonzero(np.diff(held_key)) + 1  # where a block begins; the last may go on
            start, last = 0, int(ends[-1]) if len(ends) else 0
            while start < last:
                k = np.searchsorted(ends, start + TOGETHER, side="right") - 1
                if k < 0 or ends[k] <= start:  # a block larger than TOGETHER: to its own end
                    k = np.searchsorted(ends, start, side="right")
                yield out(held[start:ends[k]])
                start = int(ends[k])
            held_key, held = held_key[start:], held[start:]
        if len(held):
            yield out(held)

    parts = max(1, int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (dealt.repartition(parts, "block").sortWithinPartitions("block").transform(map_in_arrow, run, "a bigint, b bigint")
            .distinct())


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
                    shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``<id>, fp, text_hash, group, component_id`` for every row: ``group`` names
    the component, ``component_id`` is the smallest id in it."""
    fps = materialise(fingerprints(df, id_col, text_col, shingle_words), "simhash")
    classes = fps.groupBy("fp").agg(F.min(id_col).alias("least"))
    nodes = connected_components(link(classes, radius)).withColumnRenamed("node", "fp")
    rooted = (classes.join(nodes, "fp", "left")
              .select("fp", "least", F.coalesce("component", "fp").alias("group")))
    smallest = rooted.groupBy("group").agg(F.min("least").alias("component_id"))
    return (fps.join(rooted.join(smallest, "group").select("fp", "group", "component_id"), "fp")
            .select(id_col, "fp", "text_hash", "group", "component_id"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
             shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each component the row
    with the smallest id stays (a null id after all others; once, if that row
    is repeated)."""
    marked = near_duplicates(df, id_col, text_col, radius, shingle_words)
    best = (marked.groupBy("group")
            .agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "text_hash")).alias("m"))
            .select(F.col("m.id").alias("kept_id"), F.col("m.text_hash").alias("kept_hash")))
    rows = df.select(F.col(id_col).alias("row_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row_hash"),
                     F.struct(*[F.col(c) for c in df.columns]).alias("row"))
    kept = rows.join(best, F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.col("row_hash") == F.col("kept_hash")),
                     "left_semi")
    return kept.dropDuplicates(["row_id", "row_hash"]).select("row.*")


def as_hex(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
