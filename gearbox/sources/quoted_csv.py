"""CSV files whose quoted fields hold line breaks, one file read by many tasks.

Spark's ``multiLine`` reads such a file in one task, as a task that begins in the middle of it does not know whether
it begins inside quotes.  Here files are read as lines, which can be split anywhere:

1. Quotes are counted by block of a file (one aggregation, one row a block).  The parity of the quotes before a block
   tells whether it begins inside quotes: a running sum over the blocks of a file.
2. Lines are read again with their block's entry state (a broadcast join while the block table is small, measured; a
   shuffle by block beyond).  A line at whose end no quote is open ends a record; the lines of a record are put together as they
   stream by, and no row is moved.
3. A record that goes over the end of a block comes out in pieces, at most two a block, and only blocks that begin or end inside
   quotes have any.  These blocks are read once more, and their pieces alone are shuffled.
4. Records become columns by ``from_csv``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.operators.joins import measured_bytes
from gearbox.session import scratch_path
from gearbox.sources.fs import require_path
from gearbox.sources.readers import NO_TOKEN

WHOLE, HEAD, TAIL = 0, 1, 2  # a record; the end of one begun in an earlier block; the beginning of one that goes on
BLOCK_TABLE_BYTES = 64 << 20


def _odd_quotes(line: Column, escape: str) -> Column:
    """1 if the line opens or closes quotes an odd number of times."""
    bare = line if escape == '"' else F.regexp_replace(line, r"\\." if escape == "\\" else f"[{escape}].", "")
    return ((F.length(bare) - F.length(F.replace(bare, F.lit('"')))) % 2).cast("int")


def _record_mapper(fragments: bool):
    """Lines of blocks, in their order, to whole records, or to the pieces of records that cross blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["block", "kind", "header", "record"]
        block, inside, head, header = None, 0, False, False
        held: list[str] = []

        def piece(kind: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([kind], pa.int32()), pa.array([header]),
                 pa.array(["\n".join(held)], pa.string())], names=names)

        for b in batches:
            blocks = b.column(0).to_numpy(zero_copy_only=False)
            odd_all = b.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for a, z in zip(cuts, cuts[1:]):
                if a == z:
                    continue
                if blocks[a] != block:
                    if held and fragments:
                        yield piece(HEAD if head else TAIL)
                    block, inside, header = int(blocks[a]), b.column(1)[a].as_py(), b.column(2)[a].as_py()
                    head, held = inside == 1, []
                lines, odd = b.column(4).slice(a, z - a), odd_all[a:z]
                after = (inside + np.cumsum(odd)) % 2
                inside = int(after[-1])
                ends = np.flatnonzero(after == 0) + 1
                if not len(ends):
                    held += lines.to_pylist()
                    continue
                held += lines.slice(0, int(ends[0])).to_pylist()
                if head == fragments and not (header and not head):
                    yield piece(HEAD if head else WHOLE)
                if not head:
                    header = False
                head = False
                if not fragments and len(ends) > 1:
                    held_lines = lines.slice(int(ends[0]), int(ends[-1] - ends[0]))
                    groups = pa.ListArray.from_arrays(pa.array(ends - ends[0], pa.int32()), held_lines)
                    whole = pc.binary_join(groups, "\n")
                    n = len(whole)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, block), pa.int64()), pa.array(np.full(n, WHOLE), pa.int32()),
                         pa.array(np.zeros(n, dtype=bool)), whole], names=names)
                held = lines.slice(int(ends[-1])).to_pylist()
        if held and fragments:
            yield piece(HEAD if head else TAIL)

    return run


def block_states(spark: SparkSession, lines: DataFrame, escape: str) -> DataFrame:
    """``file, start, length, block, entry, exit, first`` of every block: its number, whether quotes are open (1)
    at its begin and end, whether it is its file's first.  Written once, as later steps read it again."""
    counted = lines.groupBy("file", "start", "length").agg(F.sum(_odd_quotes(F.col("value"), escape)).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    states = counted.select(
        "file", "start", "length",
        F.row_number().over(Window.orderBy("file", "start")).cast("long").alias("block"),  # one row a block
        (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int").alias("entry"), "odd",
        F.lag("start").over(Window.partitionBy("file").orderBy("start")).isNull().alias("first"))
    path = scratch_path(spark, "csv_blocks")
    states.withColumn("exit", ((F.col("entry") + F.col("odd")) % 2).cast("int")).drop("odd").write.parquet(path)
    return spark.read.parquet(path)


def _placed(lines: DataFrame, states: DataFrame, how: str, small: bool) -> DataFrame:
    """Lines with their block's state, every block's lines together and in order."""
    keys = ["file", "start", "length"]
    cols = ["block", "entry", "first", "odd", "value"]
    if small:
        return lines.join(F.broadcast(states), keys, how).select(*cols)
    numbered = lines.withColumn("at", F.monotonically_increasing_id())
    return numbered.join(states, keys, how).repartition("block").sortWithinPartitions("block", "at").select(*cols)


def read_quoted_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, escape: str = "\\",
                    header: bool = True, block_table_bytes: int = BLOCK_TABLE_BYTES) -> DataFrame:
    """CSV whose quoted fields may hold line breaks, typed by ``schema`` (by position), as ``read_csv(multi_line=True)`` reads
    it, but split over tasks like any text file.

    ``escape`` stands before a quote inside quotes: ``\\`` as ``write_csv`` and Spark write, ``"`` for doubled quotes (RFC 4180, pandas).
    Fields that hold a quote must be quoted, as both write them.

    Defined results: blank lines outside quotes are no records; an unquoted empty field is NULL and a quoted one empty text;
    records may end in ``\\r\\n``, and breaks inside quotes stay as they are; a header line in every file; files without rows give
    none; a quote that is never closed runs to the end of its file.  Files must be cut into the same blocks when they are read again:
    keep ``steady_file_blocks`` open until the result is written where the number of cores may change; rows of other blocks raise an error.
    """
    paths = [path] if isinstance(path, str) else list(path)
    for p in paths:
        require_path(spark, p, "CSV input")
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"), "value")
    states = block_states(spark, lines, escape)
    small = measured_bytes(states) <= block_table_bytes
    marked = lines.withColumn("odd", _odd_quotes(F.col("value"), escape))
    shape = "block long, kind int, header boolean, record string"
    placed = _placed(marked, states, "left", small)
    placed = placed.withColumn("block", F.coalesce("block", F.raise_error(F.lit(
        "the files were cut into other blocks than before: read them under steady_file_blocks"))))
    first = F.col("first") & F.lit(header)
    records = placed.withColumn("first", first).mapInArrow(_record_mapper(False), shape).select("record")
    crossing = states.where((F.col("entry") == 1) | (F.col("exit") == 1))
    if not crossing.isEmpty():
        pieces = (_placed(marked, crossing, "inner", small).withColumn("first", first)
                  .mapInArrow(_record_mapper(True), shape).join(states.select("block", "file"), "block"))
        order = Window.partitionBy("file").orderBy("block", "kind")
        joined = (pieces.withColumn("nth", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
                  .groupBy("file", "nth").agg(F.max("header").alias("header"),
                                              F.sort_array(F.collect_list(F.struct("block", "kind", "record"))).alias("p"))
                  .where(~F.col("header")).select(F.array_join(F.col("p.record"), "\n").alias("record")))
        records = records.unionByName(joined)
    text = F.regexp_replace("record", r"\r\z", "")
    options = {"escape": escape, "multiLine": "true", "emptyValue": "", "nullValue": NO_TOKEN,
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return (records.select(text.alias("record")).where(F.length(F.trim("record")) > 0)
            .select(F.from_csv("record", _ddl(schema), options).alias("r")).select("r.*"))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
