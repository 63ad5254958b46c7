"""Mixing overlapping sources to target weights as a min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong
to): a pattern can give its words once at cost 1, a second time at cost 2 and
so on (convex costs: repeating is the last resort), and each source has a
quota.  Sizes, targets and quotas are aggregations and joins, for any number of
sources.  A source without documents of several sources needs no flow: it gives
its quota.  Sources connected by documents of several sources are a group; the
flow from the group's patterns over memberships into its quotas is solved in a
task, for any number of patterns: what the task holds is one row for each pattern and
source, not documents.

Within a pattern, the flow beyond whole repetitions is selected by a seeded
hash of the document id: documents in hash order up to that many words.  The
order is not computed globally: words are summed by the first four hex digits
of the hash, running sums over those bins find the bin in which the cut lies,
and only that bin's documents are put in order.  The document at the cut gives
its first words only, so a quota is met to the word.

Defined results: a null text has size 0; a document of size 0 or without a
source takes nothing; sources with a null name are one source, last in order;
repeated rows are separate documents of the same place in the order; an empty
table gives no rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearbox.llm.common import SPACES, connected_components, map_in_arrow, materialise, word_count
from gearbox.operators.ordering import with_global_index

SHARE = 1.5
MAX_REPEATS = 2
WEIGHTS = (5, 2, 1)
SEED = "mix-1"
BROADCAST_PATTERNS = 10_000  # plans up to this are broadcast, larger ones joined by shuffle
_SPACES = SPACES.replace("\\", "\\\\")  # inside a SQL string


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = SHARE,
            max_repeats: int = MAX_REPEATS) -> list[float]:
    """``share`` of all sizes dealt by weight; a source stops at ``max_repeats``
    times its size and the excess is dealt again, until none is above."""
    total = share * sum(sizes)
    capped: set[int] = set()
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        weight = sum(weights[i] for i in free)
        level = (total - sum(max_repeats * sizes[i] for i in capped)) / weight if weight else 0.0
        above = [i for i in free if level * weights[i] > max_repeats * sizes[i]]
        if not above:
            return [float(max_repeats * sizes[i]) if i in capped else level * weights[i] for i in range(len(sizes))]
        # the one that stops first; its excess raises the level for the rest
        capped.add(min(above, key=lambda i: (max_repeats * sizes[i] / weights[i], i)))


def min_cost_flow(capacity: dict[str, int], members: dict[str, list[str | None]], quota: dict[str | None, int],
                  max_repeats: int = MAX_REPEATS) -> dict[str, dict[str | None, int]]:
    """Words each pattern sends to each source: the most the quotas take, at the
    least cost.

    Only a repetition costs, the e-th use of a pattern's words e, so an augmenting path costs as much as the use
    it begins with: all paths of first uses come before any of second uses, and so on.  Each
    use is a maximum flow by blocking flows on top of those before (levels by breadth first, then paths that
    never enter a dead end twice).
    """
    begin, end = 0, 1
    patterns = {p: 2 + i for i, p in enumerate(sorted(capacity))}
    sources = {s: 2 + len(patterns) + i for i, s in enumerate(quota)}
    out: list[list[int]] = [[] for _ in range(2 + len(patterns) + len(sources))]
    head: list[int] = []
    room: list[int] = []  # the arc at ^1 is the reverse

    def add(a: int, b: int, most: int) -> int:
        for x, y, r in ((a, b, most), (b, a, 0)):
            out[x].append(len(head))
            head.append(y)
            room.append(r)
        return len(head) - 2

    fed = {p: add(begin, n, 0) for p, n in patterns.items()}
    route = {p: {s: add(n, sources[s], max_repeats * capacity[p]) for s in members[p]} for p, n in patterns.items()}
    for s, q in quota.items():
        add(sources[s], end, q)

    def levels() -> list[int]:
        level, queue = [-1] * len(out), deque([begin])
        level[begin] = 0
        while queue:
            a = queue.popleft()
            for k in out[a]:
                if room[k] > 0 and level[head[k]] < 0:
                    level[head[k]] = level[a] + 1
                    queue.append(head[k])
        return level

    def block(level: list[int]) -> None:
        tried, path, node = [0] * len(out), [], begin
        while True:
            if node == end:
                push = min(room[k] for k in path)
                for k in path:
                    room[k] -= push
                    room[k ^ 1] += push
                full = next(i for i, k in enumerate(path) if not room[k])
                node = head[path[full] ^ 1]
                del path[full:]
                continue
            while tried[node] < len(out[node]):
                k = out[node][tried[node]]
                if room[k] > 0 and level[head[k]] == level[node] + 1:
                    break
                tried[node] += 1
            else:
                if not path:
                    return
                k = path.pop()
                node = head[k ^ 1]
                tried[node] += 1
                continue
            path.append(k)
            node = head[k]

    for _ in range(max_repeats):
        for p, k in fed.items():
            room[k] += capacity[p]
        while (level := levels())[end] >= 0:
            block(level)
    return {p: {s: room[k ^ 1] for s, k in r.items()} for p, r in route.items()}


def _goals(each: DataFrame, weights: Sequence[float], share: float, max_repeats: int) -> DataFrame:
    """``source, at, size, target, quota`` from ``each (source, words)``: ``targets``
    as aggregations, all sources above the level stopped at once until none is."""
    sizes = each.groupBy("source").agg(F.sum("words").alias("size"))
    ranked, _ = with_global_index(sizes, [F.col("source").asc_nulls_last()], "at", tiebreak=False)
    turn = F.array(*[F.lit(float(w)) for w in weights])
    sources = materialise(ranked.withColumn("weight", F.get(turn, (F.col("at") % len(weights)).cast("int"))), "mix-sources")
    total = share * (sources.agg(F.sum("size")).first()[0] or 0)
    level, n_capped, capped = 0.0, -1, F.lit(False)
    while True:
        found = sources.agg(F.count_if(capped).alias("n"), F.sum(F.when(capped, F.col("size"))).alias("full"),
                            F.sum(F.when(~capped, F.col("weight"))).alias("weight")).first()
        if found["n"] == n_capped:
            break
        n_capped = found["n"]
        if not found["weight"]:  # no source is left to deal to
            break
        level = (total - max_repeats * (found["full"] or 0)) / found["weight"]
        capped = F.lit(level) * F.col("weight") > max_repeats * F.col("size")
    target = F.when(capped, (max_repeats * F.col("size")).cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return materialise(sources.withColumn("target", target)
                       .select("source", "at", "size", "target", F.floor("target").cast("long").alias("quota")), "mix-goals")


def _flows(part_of: DataFrame, max_repeats: int) -> DataFrame:
    """``pattern, given`` for the patterns of connected sources, from ``part_of (pattern, words, at, quota, several)``."""
    several = part_of.where("several")
    low = several.groupBy("pattern").agg(F.min("at").alias("low"))
    groups = connected_components(several.join(low, "pattern").select(F.col("at").alias("a"), F.col("low").alias("b")))
    grouped = materialise(part_of.join(groups, F.col("at") == F.col("node")), "mix-groups")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column(0).to_pylist():
                members: dict = {}
                for r in rows:
                    members.setdefault(r["pattern"], []).append(r["at"])
                flow = min_cost_flow({r["pattern"]: r["words"] for r in rows}, {p: sorted(m) for p, m in members.items()},
                                     {r["at"]: r["quota"] for r in sorted(rows, key=lambda r: r["at"])}, max_repeats)
                yield pa.RecordBatch.from_arrays([pa.array(list(flow), pa.string()),
                                                  pa.array([sum(f.values()) for f in flow.values()], pa.int64())],
                                                 names=["pattern", "given"])

    rows = grouped.groupBy("component").agg(F.collect_list(F.struct("pattern", "words", "at", "quota")).alias("rows"))
    return map_in_arrow(rows.select("rows"), solve, "pattern string, given long")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", members: Column | None = None,
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS,
        seed: str = SEED) -> DataFrame:
    """``<id>, pattern, size, taken, source_size, target``; ``source_size`` and
    ``target`` are arrays in the order of the row's sources.

    ``members``: array of a document's sources (default: the column
    ``source`` alone).  Sources by code point, null last, take ``weights`` in
    turn, repeating.
    """
    members = F.array(F.col("source")) if members is None else members
    sized = materialise(df.select(F.col(id_col), word_count(F.col(text_col)).alias("size"),
                                  F.sort_array(F.array_distinct(members)).alias("members"),
                                  F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
                                  .alias("place")).withColumn("pattern", F.to_json("members")), "mix")
    patterns = materialise(sized.where(F.col("pattern").isNotNull()).groupBy("pattern")
                           .agg(F.sum("size").alias("words"), F.first("members").alias("members")), "mix-patterns")
    each = patterns.select("pattern", "words", (F.size("members") > 1).alias("several"),
                           F.posexplode("members").alias("pos", "own"))
    goals = _goals(each.select(F.col("own").alias("source"), "words"), weights, share, max_repeats)
    part_of = materialise(each.join(goals, F.col("own").eqNullSafe(F.col("source"))).drop("own", "source"), "mix-members")
    alone = F.when(F.col("n") == 1, F.least("quota", max_repeats * F.col("words"))).otherwise(F.lit(0))
    plan = (part_of.groupBy("pattern").agg(
        F.sort_array(F.collect_list(F.struct("pos", "size", "target"))).alias("of"), F.first("quota").alias("quota"),
        F.first("words").alias("words"), F.count(F.lit(1)).alias("n"))  # the sources of one document
        .select("pattern", "words", F.transform("of", lambda x: x["size"]).alias("source_size"),
                F.transform("of", lambda x: x["target"]).alias("target"), alone.alias("given")))
    if not part_of.where("several").isEmpty():
        flows = _flows(part_of, max_repeats).withColumnRenamed("given", "flow")
        plan = plan.join(flows, "pattern", "left").withColumn("given", F.coalesce("flow", "given"))
    none = patterns.where(F.size("members") == 0).select(
        "pattern", "words", F.array().cast("array<bigint>").alias("source_size"), F.array().cast("array<double>").alias("target"),
        F.lit(0).cast("long").alias("given"))
    plan = plan.select("pattern", "words", "source_size", "target", "given").union(none)
    plan = materialise(plan.select(
        "pattern", F.when(F.col("words") > 0, F.expr("given div words")).otherwise(F.lit(0)).alias("whole"),
        F.when(F.col("words") > 0, F.expr("given % words")).otherwise(F.lit(0)).alias("rest"), "source_size", "target"), "mix-plan")
    small = (lambda side: F.broadcast(side)) if plan.count() <= BROADCAST_PATTERNS else (lambda side: side)

    # the bin in which each pattern's cut lies
    binned = sized.withColumn("bin", F.substring("place", 1, 4))
    bins = binned.groupBy("pattern", "bin").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("pattern").orderBy("bin")
    cut = (bins.withColumn("before", F.sum("words").over(running) - F.col("words"))
           .join(small(plan.select("pattern", "rest")), "pattern")  # BROADCAST_PATTERNS rows at most, or no broadcast
           .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
           .select("pattern", F.col("bin").alias("cut"), "before"))
    rows = (binned.join(small(plan), "pattern", "left")
            .join(small(cut), "pattern", "left"))  # a row for each pattern at most
    in_cut = rows.where(F.col("bin") == F.col("cut"))
    order = Window.partitionBy("pattern").orderBy("place", F.col(id_col).asc_nulls_last(), "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    part = F.greatest(F.lit(0), F.least(F.col("size"),
                      F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(order), F.lit(0))))
    columns = [id_col, "pattern", "size", "taken", "source_size", "target"]
    whole = F.coalesce(F.col("whole"), F.lit(0)) * F.col("size")
    cut_rows = in_cut.withColumn("taken", whole + part).select(*columns)
    other = (rows.where(~F.col("bin").eqNullSafe(F.col("cut")))
             .withColumn("taken", whole + F.when(F.col("bin") < F.col("cut"), F.col("size")).otherwise(F.lit(0)))
             .select(*columns))
    return other.union(cut_rows)


def apply(df: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` as often as the mix takes them: whole texts, and for
    the document at a cut its first words.  Rows that take nothing go; equal
    rows are one document that takes what they take together.  ``n_chars``,
    where there is one, follows the text."""
    chosen = (mixed.where(F.col("taken") > 0).groupBy(F.col(id_col).alias("chosen_id"), F.col("size").alias("size"))
              .agg(F.sum("taken").alias("taken")))
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"), F.col(id_col).alias("row_id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("whole_text"), word_count(F.col(text_col)).alias("row_size"),
                     F.xxhash64(text_col).alias("row_hash"))
    first_words = F.expr(f"regexp_extract(whole_text, concat('^(?:[{_SPACES}]*+[^{_SPACES}]++){{', rest, '}}+'), 0)")
    texts = F.concat(F.expr("array_repeat(whole_text, cast(repeats as int))"),
                     F.when(F.col("rest") > 0, F.array(first_words)).otherwise(F.array().cast("array<string>")))
    taken = (rows.join(chosen, F.col("row_id").eqNullSafe(F.col("chosen_id")) & (F.col("row_size") == F.col("size")))
             .dropDuplicates(["row_id", "row_hash"])
             .withColumn("repeats", F.expr("taken div size")).withColumn("rest", F.col("taken") % F.col("size"))
             .select("row", F.explode(texts).alias("new_text")))
    new = {text_col: F.col("new_text")}
    if "n_chars" in df.columns:
        new["n_chars"] = F.length("new_text").cast(df.schema["n_chars"].dataType)
    return taken.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in df.columns])
