"""Sum-of-squares packing of tokenized documents into fixed windows.

Every document becomes its token ids followed by an end id.  Whole windows of
a long document are sequences of their own; what is left of it (shorter than a
window) is one item.  Items are placed online: a task keeps an array with the
number of open sequences at each fill level and puts the item where the sum of
the squared counts becomes smallest (a new sequence is one of the choices; of
equal choices the fullest level wins).  A sequence that is exactly full is
written at once.

Open sequences left at the end of a task, or more than ``max_open`` of them at
any time (their count bounds the task's memory), are emptied into each other:
their pieces are strung together and cut at the window length, so a task leaves at
most one sequence short of a full window.

The work is one pass over the input's own partitions without a shuffle.
Sequence ids are ``partition << 32 | number``; a task that is run again after
a lost executor reads the same rows and gives the same ids.

Defined results: a null or empty text is the end id alone; repeated rows are
packed as often as they occur; a null id is carried along; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.llm.common import id_and_text, in_slices, map_in_arrow, tokenizer_path
from gearbox.llm.tokenizing import ByteBpe

WINDOW = 1024
MAX_OPEN = 4096
BATCH_ROWS = 2000


class SumOfSquares:
    """Places items (id, start, ids, total) into windows; ``place`` and
    ``finish`` yield lists of pieces, each list one finished sequence."""

    def __init__(self, window: int, max_open: int):
        self.window, self.max_open = window, max_open
        self.level = np.zeros(window + 1, dtype=np.int64)  # open sequences by fill; level[window] stays 0
        self.open: dict[int, list[list]] = {}              # fill -> stack of open sequences
        self.n_open = 0

    def choose(self, length: int) -> int:
        """Fill level of the sequence to extend, 0 for a new one."""
        w, n = self.window, self.level
        here = n[1:w - length + 1]
        best, at = 2 * n[length] + 1, 0  # a new sequence
        if len(here):
            change = 2 * (n[1 + length:] - here) + 2
            change[-1] -= 1  # filled to the brim: the sequence leaves the array
            change[here == 0] = np.iinfo(np.int64).max
            k = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[k] <= best:
                at = k + 1
        return at

    def place(self, piece: tuple) -> Iterator[list]:
        length = len(piece[2]) // 4
        if length == self.window:
            yield [piece]
            return
        at = self.choose(length)
        pieces = []
        if at:
            pieces = self.open[at].pop()
            self.level[at] -= 1
            self.n_open -= 1
        pieces.append(piece)
        if at + length == self.window:
            yield pieces
        else:
            self.open.setdefault(at + length, []).append(pieces)
            self.level[at + length] += 1
            self.n_open += 1
            if self.n_open > self.max_open:
                yield from self.finish(keep_last=True)

    def finish(self, keep_last: bool = False) -> Iterator[list]:
        """Empty the open sequences into each other, cutting at the window length."""
        stacks = [pieces for fill in sorted(self.open, reverse=True) for pieces in self.open[fill]]
        self.open, self.n_open = {}, 0
        self.level[:] = 0
        out: list = []
        room = self.window
        for pieces in stacks:
            for doc, start, ids, total in pieces:
                while ids:
                    part, ids = ids[:4 * room], ids[4 * room:]
                    out.append((doc, start, part, total))
                    start += len(part) // 4
                    room -= len(part) // 4
                    if room == 0:
                        yield out
                        out, room = [], self.window
        if out and keep_last:
            self.open[self.window - room] = [out]
            self.level[self.window - room] = 1
            self.n_open = 1
        elif out:
            yield out


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         tokenizer: str | None = None, end_id: int = 0, max_open: int = MAX_OPEN) -> DataFrame:
    """One row per piece: ``<id>, start, length, ids (little-endian unsigned
    32-bit), doc_tokens, sequence_id, offset``."""
    docs = id_and_text(df, id_col, text_col)
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
                           T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.of(path)
        end = np.array([end_id], dtype="<u4").tobytes()
        packer = SumOfSquares(window, max_open)
        next_id = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        kind = None

        def batch() -> pa.RecordBatch:
            cols = list(zip(*rows)) or [[]] * 7
            types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=schema.fieldNames())
            rows.clear()
            return out

        def write(sequences):
            nonlocal next_id
            for pieces in sequences:
                offset = 0
                for doc, start, ids, total in pieces:
                    rows.append((doc, start, len(ids) // 4, ids, total, next_id, offset))
                    offset += len(ids) // 4
                next_id += 1

        for b in in_slices(batches):
            kind = b.column(0).type
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = bpe.ids(text) + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    write(packer.place((doc, start, ids[4 * start:4 * (start + window)], total)))
                if len(rows) >= BATCH_ROWS:
                    yield batch()
        if kind is not None:
            write(packer.finish())
            yield batch()

    return docs.transform(map_in_arrow, run, schema)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of the ids."""
    return pieces.select(*[F.crc32("ids").alias("ids_crc32") if c == "ids" else F.col(c) for c in pieces.columns])
