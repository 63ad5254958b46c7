"""Repair of conversation structure: the cheapest edits that give every
conversation role initials ``(s?(ua)+)?``, and the ASCII-least audit of them.

Rows are read in turn order through four states: empty (E), after a system row
(S), after a user row (U), after an assistant row (A); E and A may end.  A row
is kept (cost 0), gets the role that the state awaits (2) or is deleted (3, the only
choice for blank and duplicate rows); an empty row of the awaited role may be inserted
before any row or at the end (2); an undeleted truncated row adds 1.

*Cost.* A row is a 4 x 4 matrix over (min, +), so rows, chunks of rows and parts
of chunks compose.  A conversation is cut into chunks of at most ``CHUNK_ROWS`` rows or
``CHUNK_CHARS`` characters: rows are dealt by ranges of (conversation, turn), so that
a conversation with any share of the table is spread over tasks, and
costs to the end reach the chunks by a scan over the parts' and the chunks' matrices.

*Path.* Within a chunk the cost DP leaves at each node (row, state) its optimal arcs.
The letters of a node's arcs differ, as each letter leads to one state, so the least
letter is the node's rank of length 1 and fixes its pointer.  Ranks of
audits of twice the length come from pairs of ranks, a node's and that of the node
its pointer leads to, and pointers are doubled along; the least path of a chunk is
read off the doubled pointers for all its places at once.  The states in which the
chunks are entered come from a second scan, over the chunks' maps of states.

Conversations that lie in one chunk, nearly all, need no scan and no further
shuffle; the others take both scans.  The digest of a conversation's repaired text is a hash
of its rows in order, streamed through one task in bounded memory.

Defined results: a null conversation id is one conversation; a null turn comes
first; rows of one turn are ordered by a hash of role and text, equal rows are
adjacent; null roles and texts count as one space; a role's initial is its first
character; a table without rows gives no rows.  Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.llm.common import SPACES, map_in_arrow, materialise

CHUNK_ROWS = 256
CHUNK_CHARS = 1 << 18
BATCH_CHARS = 1 << 22  # characters of the chunks put out at a time

# The edits' costs, states and letters.
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
E, S, U, A = range(4)
AWAITED = np.array([U, U, A, U])  # the state after an inserted or reroled row
KEPT = np.array([[S, U, -1, -1], [-1, U, -1, -1], [-1, -1, A, -1], [-1, U, -1, -1]])  # by state and initial s, u, a, other
LETTERS = np.frombuffer(b" DIKR", dtype=np.uint8)
ENDS = {E: 0, S: 2, U: 1, A: 0}  # rows to insert behind the last one
FINAL = [INSERT * ENDS[s] for s in range(4)]
ROLE = {U: "user", A: "assistant"}
BLANK, DUPLICATE, CUT, FINE = range(4)  # kinds of rows
FAR = 1 << 60
LONG = (1 << 63) - 1


# --- rows -------------------------------------------------------------------

def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The four columns with planted faults, by crc32 of ``conv:turn`` modulo 20 (nulls: one space): 0 drops a row,
    1 empties its text, 2 removes ``. ! ?`` from it, 3 repeats the row, 4 makes its role user."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(text(conv_col), F.lit(":"), text(turn_col)).cast("binary")) % 20
    return (df.select(F.col(conv_col), F.col(turn_col), text(role_col).alias(role_col), text(text_col).alias(text_col), fault.alias("_fault"))
            .where("_fault <> 0")
            .select(conv_col, turn_col, F.when(F.col("_fault") == 4, "user").otherwise(F.col(role_col)).alias(role_col),
                    F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate(text_col, ".!?", "")).otherwise(F.col(text_col)).alias(text_col),
                    F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
            .drop("_copy"))


def _rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text, who, kind, key`` in order within ranges of (conv, turn)."""
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                     F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"),
                     F.monotonically_increasing_id().alias("row"))
    first = F.substring("role", 1, 1)
    who = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    end = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    kind = F.when(end == "", BLANK).when(end.isin(".", "!", "?"), FINE).otherwise(CUT)
    own = F.coalesce(F.col("conv").cast("string"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.col("conv").isNull().cast("string"), F.length(own), own, F.length("role"), "role", "text").cast("binary"))
    order = ["conv", "turn", F.xxhash64("role", "text"), "row"]
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .select("conv", "turn", "role", "text", who.cast("byte").alias("who"), kind.cast("byte").alias("kind"), F.unhex(key).alias("key")))


_CHUNK = ("part int, run int, chunk int, whole boolean, who binary, kind binary, keys array<binary>, places array<int>, "
          "roles array<string>, texts array<string>, turns array<bigint>")


def _chunked(rows: DataFrame) -> DataFrame:
    """One row for each chunk: ``part`` and ``chunk`` name and order it, ``run`` its conversation within the part;
    ``whole`` chunks hold a conversation surely.  ``keys`` and ``places`` are the rows not seen earlier in the chunk."""
    schema = T.StructType([rows.schema["conv"], *T.StructType.fromDDL(_CHUNK).fields])
    conv_type = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal conv_type
        part, names = TaskContext.get().partitionId(), schema.fieldNames()
        at, run_no, chunk_no, split, chars, done_chars = None, -1, -1, False, 0, 0
        held: list[tuple] = []
        done: list[list] = []

        def close(whole: bool) -> None:
            nonlocal held, chunk_no, done_chars, chars
            if held:
                chunk_no += 1
                _, turns, roles, texts, who, kind, keys = zip(*held)
                kind, seen, places = bytearray(kind), set(), []
                for i, key in enumerate(keys):
                    if kind[i] != BLANK:
                        if key in seen:
                            kind[i] = DUPLICATE
                        else:
                            seen.add(key)
                            places.append(i)
                done.append([at, part, run_no, chunk_no, whole, bytes(who), bytes(kind), [keys[i] for i in places], places,
                             roles, texts, turns])
                done_chars, chars, held = done_chars + chars, 0, []

        def out() -> pa.RecordBatch:
            nonlocal done, done_chars
            columns = list(zip(*done))
            types = [conv_type, pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.list_(pa.binary()),
                     pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64())]
            done, done_chars = [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for b in batches:
            conv_type = b.schema.field(0).type
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if run_no < 0 or row[0] != at:
                    close(run_no > 0 and not split)  # the first run may have begun in an earlier part
                    at, run_no, split = row[0], run_no + 1, False
                elif len(held) >= CHUNK_ROWS or chars + len(row[3]) > CHUNK_CHARS:
                    split = True
                    close(False)
                held.append(row)
                chars += len(row[3])
                if done_chars >= BATCH_CHARS or len(done) >= 4096:
                    yield out()
        close(False)  # the last run may go on in a later part
        if done:
            yield out()

    return rows.transform(map_in_arrow, run, schema)


# --- cost and least path within chunks ----------------------------------------

def _arcs(who: np.ndarray, kind: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Costs to the end of the four states before rows, from those behind them, with inserted rows; and the costs by
    deleting, keeping and reroling."""
    n = np.arange(len(who))[:, None]
    states = np.arange(4)[None, :]
    must, extra = (kind <= DUPLICATE)[:, None], TRUNCATED * (kind == CUT)[:, None]
    to = KEPT[states, who[:, None]]
    delete = after + DELETE
    keep = np.where(must | (to < 0), FAR, after[n, to] + extra)
    rerole = np.where(must, FAR, after[:, AWAITED] + REROLE + extra)
    best = np.minimum(np.minimum(delete, keep), rerole)
    for _ in range(2):  # at most two inserted rows in a row are of use
        best = np.minimum(best, best[:, AWAITED] + INSERT)
    return best, delete, keep, rerole


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def matrices(who: list[np.ndarray], kind: list[np.ndarray]) -> np.ndarray:
    """The chunks' matrices: cost from each entered state to each state behind the chunk."""
    lengths = np.array([len(w) for w in who])
    first = _offsets(lengths)
    whos, kinds = np.concatenate(who), np.concatenate(kind)
    out = np.full((len(who), 4, 4), FAR, dtype=np.int64)
    out[:, range(4), range(4)] = 0
    order = np.argsort(-lengths, kind="stable")
    for step in range(1, int(lengths.max()) + 1):
        some = order[:np.searchsorted(-lengths[order], -step, side="right")]
        row = first[some] + lengths[some] - step
        for goal in range(4):
            out[some, :, goal] = _arcs(whos[row], kinds[row], out[some, :, goal])[0]
    return np.minimum(out, FAR)


def least_paths(who: list[np.ndarray], kind: list[np.ndarray], after: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Nodes ``4 * (row place) + state`` of chunks laid side by side, each chunk with one more place behind its
    last row, where ``after`` gives the costs to the end.  Returns the chunks' first places, the nodes' letters, their doubled
    pointers by level, their arcs' costs and their audits' ranks (equal for equal audits, in ASCII order)."""
    lengths = np.array([len(w) for w in who])
    first, rows_at = _offsets(lengths + 1), _offsets(lengths)
    whos, kinds = np.concatenate(who), np.concatenate(kind)
    n = 4 * int(first[-1])
    cost, letter, price, pointer = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.arange(n)
    states = np.arange(4)[None, :]
    cost[4 * (first[:-1] + lengths)[:, None] + states] = after
    order = np.argsort(-lengths, kind="stable")
    for step in range(1, int(lengths.max()) + 1):
        some = order[:np.searchsorted(-lengths[order], -step, side="right")]
        row, here = rows_at[some] + lengths[some] - step, 4 * (first[some] + lengths[some] - step)[:, None]
        w, k = whos[row], kinds[row]
        best, delete, keep, rerole = _arcs(w, k, cost[here + 4 + states])
        choice = np.select([delete == best, best[:, AWAITED] + INSERT == best, keep == best], [1, 2, 3], 4)
        extra = TRUNCATED * (k == CUT)[:, None] + 0 * states
        cost[here + states], letter[here + states] = best, choice
        pointer[here + states] = np.choose(choice - 1, [here + 4 + states, here + AWAITED[None, :], here + 4 + KEPT[states, w[:, None]],
                                                        here + 4 + AWAITED[None, :]])
        price[here + states] = np.choose(choice - 1, [np.full_like(extra, DELETE), np.full_like(extra, INSERT), extra, extra + REROLE])
    pointers, rank = [pointer], letter
    while (letter[pointers[-1]] > 0).any():
        to = pointers[-1]
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[to], return_inverse=True)[1].ravel()
        pointers.append(to[to])
    return first, letter, pointers, price, rank


def walk(start: np.ndarray, letter: np.ndarray, pointers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nodes of the least paths from ``start`` nodes, side by side, where each path begins, and the nodes where they end."""
    length = (letter > 0).astype(np.int64)
    lengths = length.copy()
    for to in pointers[:-1]:
        lengths = lengths + lengths[to]
    n = lengths[start]
    begin = _offsets(n)
    place = np.arange(begin[-1]) - np.repeat(begin[:-1], n)
    node, end = np.repeat(start, n), start.copy()
    for level, to in enumerate(pointers):
        moved = (place >> level) & 1 == 1
        node[moved] = to[node[moved]]
    for to in reversed(pointers):
        end = to[end]
    return node, begin, end


# --- scans over the chunks of conversations that lie in several -----------------

def _min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


class CostScan:
    """Costs to the end, from the last chunk to the first; items are matrices."""
    reverse, start = True, FINAL

    @staticmethod
    def compose(item: np.ndarray, later: np.ndarray) -> np.ndarray:
        return _min_plus(item.reshape(4, 4), later.reshape(4, 4)).ravel()

    @staticmethod
    def step(state: np.ndarray, item: np.ndarray) -> np.ndarray:
        return np.minimum((item.reshape(4, 4) + state[None, :]).min(axis=1), FAR)


class RouteScan:
    """Entered states, from the first chunk to the last; items are maps of states."""
    reverse, start = False, [E]

    @staticmethod
    def compose(item: np.ndarray, later: np.ndarray) -> np.ndarray:
        return later[item]

    @staticmethod
    def step(state: np.ndarray, item: np.ndarray) -> np.ndarray:
        return item[state]


def _scan(items: DataFrame, how: type) -> DataFrame:
    """``part, chunk, state, last`` for ``items (conv, part, run, chunk, item)``: the state that reaches each chunk,
    and whether it is its conversation's last.  Chunks are folded by part, parts scanned by conversation (at most as many as
    the parts of one shuffle), and chunks scanned within their part."""
    conv = items.schema["conv"]
    longs = T.ArrayType(T.LongType())
    folded_type = T.StructType([conv, *T.StructType.fromDDL("part int, run int, item array<bigint>, last_chunk int").fields])
    state_type = T.StructType.fromDDL("part int, run int, state array<bigint>, last boolean")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, value, last, conv_value, conv_type = None, None, None, None, pa.null()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv_value], conv_type), pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()),
                                               pa.array([value.tolist()], pa.list_(pa.int64())), pa.array([last], pa.int32())],
                                              names=folded_type.fieldNames())

        for b in batches:
            conv_type = b.schema.field("conv").type
            for c, p, r, chunk, item in zip(*(b[n].to_pylist() for n in ("conv", "part", "run", "chunk", "item"))):
                item = np.array(item)
                if (p, r) == at:
                    value = how.compose(value, item)
                else:
                    if at is not None:
                        yield out()
                    at, value, conv_value = (p, r), item, c
                last = chunk
        if at is not None:
            yield out()

    def over_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = before = state = None
        for b in batches:
            found = []
            for c, p, r, item in zip(*(b[n].to_pylist() for n in ("conv", "part", "run", "item"))):
                if before is None or c != at:
                    at, state = c, np.array(how.start)
                    first = True
                else:
                    first = False
                before = True
                found.append((p, r, state.tolist(), first))
                state = how.step(state, np.array(item))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found), (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.bool_()))],
                                                 names=["part", "run", "state", "last"])

    def over_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = state = None
        for b in batches:
            found = []
            for p, r, chunk, item, given, ends in zip(*(b[n].to_pylist() for n in ("part", "run", "chunk", "item", "state", "last"))):
                first = (p, r) != at
                if first:
                    at, state = (p, r), np.array(given)
                found.append((p, chunk, state.tolist(), first and ends))
                state = how.step(state, np.array(item))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found), (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.bool_()))],
                                                 names=["part", "chunk", "state", "last"])

    towards = F.desc if how.reverse else F.asc
    folded = (items.repartition("part", "run").sortWithinPartitions("part", "run", "chunk").transform(map_in_arrow, fold, folded_type))
    states = (folded.select("conv", "part", "run", "item").repartition("conv").sortWithinPartitions("conv", towards("part"))
              .transform(map_in_arrow, over_parts, state_type))
    return (items.join(states, ["part", "run"]).repartition("part", "run").sortWithinPartitions("part", "run", towards("chunk"))
            .select("part", "run", "chunk", "item", "state", "last")
            .transform(map_in_arrow, over_chunks, T.StructType([*T.StructType.fromDDL("part int, chunk int").fields, T.StructField("state", longs),
                                                                T.StructField("last", T.BooleanType())])))


def _bytes(values: Iterable[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(v, dtype=np.uint8).astype(np.int64) for v in values]


def _spread(chunks: DataFrame) -> DataFrame:
    """``part, chunk, kind, after, entered, last`` of the chunks of conversations that may lie in several."""
    known = chunks.select("part", "chunk", F.explode(F.arrays_zip("keys", "places")).alias("k")).select("part", "chunk", "k.keys", "k.places")
    seen = (known.groupBy("keys").agg(F.min(F.struct("part", "chunk")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    repeated = (known.join(seen, "keys").where(F.struct("part", "chunk") > F.col("first"))
                .groupBy("part", "chunk").agg(F.collect_list("places").alias("repeated")))  # CHUNK_ROWS at most
    narrow = chunks.select("conv", "part", "run", "chunk", "who", "kind").join(repeated, ["part", "chunk"], "left")
    marked_type = T.StructType([chunks.schema["conv"], *T.StructType.fromDDL(
        "part int, run int, chunk int, who binary, kind binary, item array<bigint>").fields])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                kinds = [bytearray(k) for k in b["kind"].to_pylist()]
                for kind, places in zip(kinds, b["repeated"].to_pylist()):
                    for i in places or ():
                        kind[i] = DUPLICATE
                items = matrices(_bytes(b["who"].to_pylist()), _bytes(kinds)).reshape(-1, 16).tolist()
                yield pa.RecordBatch.from_arrays([b["conv"], b["part"], b["run"], b["chunk"], b["who"], pa.array(list(map(bytes, kinds)), pa.binary()),
                                                  pa.array(items, pa.list_(pa.int64()))], names=marked_type.fieldNames())

    marked = materialise(narrow.transform(map_in_arrow, mark, marked_type), "conversation-chunks")
    costs = _scan(marked.select("conv", "part", "run", "chunk", "item"), CostScan).withColumnsRenamed({"state": "after"})
    costs = materialise(marked.drop("item").join(costs, ["part", "chunk"]), "conversation-costs")
    route_type = T.StructType([chunks.schema["conv"], *T.StructType.fromDDL("part int, run int, chunk int, item array<bigint>").fields])

    def routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                who = _bytes(b["who"].to_pylist())
                first, letter, pointers, _, _ = least_paths(who, _bytes(b["kind"].to_pylist()), np.array(b["after"].to_pylist()))
                node = 4 * first[:-1, None] + np.arange(4)[None, :]
                for to in reversed(pointers):
                    node = to[node]
                yield pa.RecordBatch.from_arrays([b["conv"], b["part"], b["run"], b["chunk"], pa.array((node % 4).tolist(), pa.list_(pa.int64()))],
                                                 names=route_type.fieldNames())

    entered = (_scan(costs.select("conv", "part", "run", "chunk", "who", "kind", "after").transform(map_in_arrow, routes, route_type), RouteScan)
               .select("part", "chunk", F.col("state")[0].alias("entered")))
    return costs.select("part", "chunk", "kind", "after", "last").join(entered, ["part", "chunk"])


# --- pieces and reports -----------------------------------------------------------

_PIECE = ("part int, chunk int, who binary, kind binary, turns array<bigint>, cost bigint, audit string, "
          "roles array<string>, texts array<string>")


def pieces(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The repaired chunks, in two tables of the same columns: those that are a conversation, and those of conversations that
    may lie in several, ordered by (part, chunk).  ``roles`` and ``texts`` are the repaired rows."""
    chunks = materialise(_chunked(_rows(df, conv_col, turn_col, role_col, text_col)), "conversations")
    schema = T.StructType([chunks.schema["conv"], *T.StructType.fromDDL(_PIECE).fields])
    columns = ["conv", "part", "chunk", "who", "kind", "roles", "texts", "turns", "after", "entered", "last"]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            first, letter, pointers, price, _ = least_paths(_bytes(b["who"].to_pylist()), _bytes(b["kind"].to_pylist()),
                                                            np.array(b["after"].to_pylist()))
            node, begin, end = walk(4 * first[:-1] + b["entered"].to_numpy(), letter, pointers)
            paid = _offsets(price[node])
            costs = (np.cumsum(np.concatenate([[0], price[node]]))[begin[1:]] - np.cumsum(np.concatenate([[0], price[node]]))[begin[:-1]]).tolist()
            letters, place, to = letter[node], node // 4, pointers[0][node] % 4
            audits, roles, texts = [], [], []
            for i, (old_roles, old_texts, last) in enumerate(zip(b["roles"].to_pylist(), b["texts"].to_pylist(), b["last"].to_pylist())):
                s, e = begin[i], begin[i + 1]
                audit, new_roles, new_texts = LETTERS[letters[s:e]].tobytes().decode(), [], []
                for c, p, t in zip(audit, (place[s:e] - first[i]).tolist(), to[s:e].tolist()):
                    if c != "D":
                        new_roles.append(old_roles[p] if c == "K" else ROLE[t])
                        new_texts.append("" if c == "I" else old_texts[p])
                state = int(end[i] % 4)
                for _ in range(ENDS[state] if last else 0):
                    state = int(AWAITED[state])
                    audit, costs[i] = audit + "I", costs[i] + INSERT
                    new_roles.append(ROLE[state])
                    new_texts.append("")
                audits.append(audit)
                roles.append(new_roles)
                texts.append(new_texts)
            yield pa.RecordBatch.from_arrays(
                [b["conv"], b["part"], b["chunk"], b["who"], b["kind"], b["turns"], pa.array(costs, pa.int64()), pa.array(audits, pa.string()),
                 pa.array(roles, pa.list_(pa.string())), pa.array(texts, pa.list_(pa.string()))], names=schema.fieldNames())

    whole = (chunks.where("whole").withColumns({"after": F.array(*[F.lit(v).cast("long") for v in FINAL]), "entered": F.lit(E).cast("long"),
                                                "last": F.lit(True)}))
    several = chunks.where("not whole")
    several = several.drop("kind").join(_spread(several), ["part", "chunk"])
    return whole.select(columns).transform(map_in_arrow, solve, schema), several.select(columns).transform(map_in_arrow, solve, schema)


def repaired(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows of the repaired conversations: ``<conv>, part, chunk, place, <role>, <text>``; a conversation's rows are in order of
    (part, chunk, place)."""
    one, several = pieces(df, conv_col, turn_col, role_col, text_col)
    return (one.union(several).select("conv", "part", "chunk", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "r"))
            .select(F.col("conv").alias(conv_col), "part", "chunk", "place", F.col("r.roles").alias(role_col), F.col("r.texts").alias(text_col)))


_REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_LEGAL = {(0, 1), (1, 2), (2, 1)}


class _Report:
    """Figures of one conversation, chunk by chunk."""

    def __init__(self, conv):
        self.conv, self.count, self.illegal, self.cost, self.audit = conv, [0] * 4, 0, 0, []
        self.turns, self.low, self.high, self.turn, self.who = 0, None, None, None, None
        self.hash, self.begun = hashlib.sha256(), False

    def add(self, who: bytes, kind: bytes, turns: list, cost: int, audit: str, roles: list[str], texts: list[str]) -> None:
        for k in range(4):
            self.count[k] += kind.count(k)
        for w in who:
            self.illegal += self.who is not None and (self.who, w) not in _LEGAL
            self.who = w
        for t in turns:
            if t is not None and t != self.turn:  # in order: equal turns are adjacent
                self.turns, self.turn, self.low, self.high = self.turns + 1, t, t if self.low is None else self.low, t
        self.cost += cost
        self.audit.append(audit)
        for role, text in zip(roles, texts):
            self.hash.update(f"{chr(10) if self.begun else ''}{role}:{text}".encode())
            self.begun = True

    def row(self) -> tuple:
        gaps = min(LONG, self.high - self.low + 1 - self.turns) if self.turns else 0
        return (self.conv, gaps, self.count[BLANK], self.count[DUPLICATE], self.count[CUT], self.illegal, self.cost, "".join(self.audit),
                self.hash.hexdigest())


def report(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``<conv>, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` for every conversation with rows."""
    one, several = pieces(df, conv_col, turn_col, role_col, text_col)
    schema = T.StructType([T.StructField(conv_col, one.schema["conv"].dataType), *T.StructType.fromDDL(_REPORT).fields])
    columns = ["conv", "who", "kind", "turns", "cost", "audit", "roles", "texts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, conv_type = None, pa.null()

        def out(rows: list[tuple]) -> pa.RecordBatch:
            types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.fieldNames())

        for b in batches:
            conv_type, done = b.schema.field("conv").type, []
            for conv, *piece in zip(*(b[c].to_pylist() for c in columns)):
                if held is None or held.conv != conv:
                    if held is not None:
                        done.append(held.row())
                    held = _Report(conv)
                held.add(*piece)
            if done:
                yield out(done)
        if held is not None:
            yield out([held.row()])

    several = several.repartition("conv").sortWithinPartitions("conv", "part", "chunk")
    return one.select(columns).transform(map_in_arrow, run, schema).union(several.select(columns).transform(map_in_arrow, run, schema))


def damage_report(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``report`` of the ``damaged`` rows for every conversation of ``df``, those without rows left included."""
    found = report(damaged(df, conv_col, turn_col, role_col, text_col), conv_col, turn_col, role_col, text_col)
    ids = df.select(F.col(conv_col).alias("_conv")).distinct()
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return ids.join(found, F.col("_conv").eqNullSafe(F.col(conv_col)), "left").select(
        F.col("_conv").alias(conv_col), *[F.coalesce(c, F.lit(empty.get(c, 0))).alias(c) for c in found.columns[1:]])
