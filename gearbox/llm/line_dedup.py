"""Repeated and nearly repeated lines, over all documents.

DataFrame functions only.

A line is what stands between newlines; its words are separated by white
space, and white space around and between them does not count.  A line goes if
an earlier line (by document id, then position) has the same words, or, for
lines of at least ``MIN_WORDS`` words, words within one edit (a word changed,
put in or left out).  The bound is one edit whatever the line's length: a
similarity of 0.8 at 5 words, 0.98 at 50, so long lines with more edits stay
(the README has their share).  The earliest stays.  Blank lines always stay, and
a document whose lines all go stays with an empty text.

Equal lines are grouped by a 128-bit hash.  Near lines come from a
deletion-neighbourhood join: a line emits one hashed variant for every word
left out, besides itself.  Two lines that differ in one word have equal variants
left out at the same place; a line and the one without its word share the
shorter one's hash.  Within such a group everything links to the group's
earliest line, so a group of any size costs a minimum and a join, not its
pairs.  Each link is verified: the words must agree but for one between their
common beginning and end.

Emitting all variants of all lines would multiply the table by the length of
its lines, so lines without any possible partner are put aside first, without
loss: one edit leaves the first or the last words untouched (a number of words
that depends on the length class only, ``_anchors``), so a line whose beginning
and end hash belong to no other line has no near line.

Defined results: a null text is empty; a null id comes after all others; rows
with the same id and text lose the same lines; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearbox.llm.common import materialise

MIN_WORDS = 5
CHUNK = 512


def _spaced(text: Column) -> Column:
    """The text with every white space but newlines as a space."""
    odd = text.contains("\t") | text.contains("\r") | text.contains("\x0b") | text.contains("\x0c")
    return F.when(odd, F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text)


def _words_of(line: Column) -> Column:
    """The words of a spaced line joined by single spaces."""
    untidy = line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    return F.when(untidy, F.btrim(F.regexp_replace(line, " +", " "))).otherwise(line)


def _count(joined: Column) -> Column:
    return F.octet_length(joined) - F.octet_length(F.replace(joined, F.lit(" "))) + 1


def _anchors(joined: Column, n: Column) -> Column:
    """Hashes of the beginning and the end of a line that one edit cannot both
    touch: a quarter to half of its words, 2^j in the length class
    [2 * 2^j, 4 * 2^j).  A line of the smallest length of its class counts in
    the class below too, where its partner that is a word shorter is."""
    size = F.pow(F.lit(2.0), F.floor(F.log2(n.cast("double"))) - 1).cast("int")
    none = F.array().cast("array<bigint>")

    def both(k: Column) -> Column:
        part = lambda words: F.call_function("substring_index", joined, F.lit(" "), words)
        return F.array(F.xxhash64(F.lit("begin"), k, part(k)), F.xxhash64(F.lit("end"), k, part(-k)))

    below = F.when((n == 2 * size) & (size > 2), both((size / 2).cast("int"))).otherwise(none)
    return F.when(n < MIN_WORDS - 1, none).otherwise(F.concat(both(size), below))


def _with_variants(lines: DataFrame) -> DataFrame:
    """Adds ``variants``: the hash of the word sequence (``words``) with word i
    left out for every i, and ``whole``, that of the whole sequence.

    Word j contributes its hash with its place, j before the gap and j - 1
    behind it; contributions are combined by xor.  The running values are
    carried from chunk to chunk, so that a long line stays cheap.
    """
    xor = lambda x, y: x.bitwiseXOR(y)
    both = lambda t, x: F.struct(xor(t["a"], x["a"]).alias("a"), xor(t["b"], x["b"]).alias("b"))
    zero = F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    hashed = lines.withColumn("h", F.transform("words", lambda w, i: F.struct(
        F.xxhash64(w, i).alias("a"), F.xxhash64(w, i - 1).alias("b"))))
    cut = hashed.withColumn("starts", F.sequence(F.lit(1), F.size("h"), F.lit(CHUNK)))
    carried = cut.withColumn("carry", F.aggregate("starts", F.array(zero), lambda acc, at: F.array_append(
        acc, F.aggregate(F.slice("h", at, F.lit(CHUNK)), F.element_at(acc, -1), both))))

    def chunk(z):
        total = F.element_at(F.col("carry"), -1)
        step = lambda t, x: F.struct(
            xor(t["a"], x["a"]).alias("a"), xor(t["b"], x["b"]).alias("b"),
            F.array_append(t["out"], xor(xor(t["a"], total["b"]), xor(t["b"], x["b"]))).alias("out"))
        return F.aggregate(F.slice("h", z["at"], F.lit(CHUNK)),
                           F.struct(z["c"]["a"].alias("a"), z["c"]["b"].alias("b"),
                                    F.array().cast("array<bigint>").alias("out")), step, lambda t: t["out"])

    each = F.arrays_zip(F.col("starts").alias("at"), F.slice("carry", F.lit(1), F.size("starts")).alias("c"))
    return (carried.withColumn("variants", F.flatten(F.transform(each, chunk)))
            .withColumn("whole", F.element_at("carry", -1)["a"]).drop("h", "starts", "carry"))


def _within_one_edit(a: str, b: str) -> Column:
    """Whether two arrays of words agree but for one word between their common beginning and end."""
    def agree(x: Column, y: Column) -> Column:
        first_apart = F.array_position(F.zip_with(x, y, lambda u, v: F.coalesce(u == v, F.lit(False))), False)
        return F.when(first_apart == 0, F.least(F.size(x), F.size(y))).otherwise(first_apart - 1)

    x, y = F.col(a), F.col(b)
    longer = F.greatest(F.size(x), F.size(y))
    return ((F.abs(F.size(x) - F.size(y)) <= 1) & (longer >= MIN_WORDS)
            & (agree(x, y) + agree(F.reverse(x), F.reverse(y)) >= longer - 1))


def near_lines(candidates: DataFrame) -> DataFrame:
    """``first`` of the lines with an earlier near line, from distinct lines
    ``(line, first, words)``; ``first`` is where a line first occurs and orders them."""
    varied = _with_variants(candidates.withColumn("n", F.size("words")))
    left_out = F.transform("variants", lambda v, i: F.struct(v.alias("v"), (F.col("n") - 1).alias("n"), i.alias("gap")))
    every = F.concat(F.when(F.col("n") >= MIN_WORDS, left_out).otherwise(
        F.array().cast("array<struct<v:bigint,n:int,gap:int>>")),
        F.array(F.struct(F.col("whole").alias("v"), F.col("n").alias("n"), F.lit(-1).alias("gap"))))
    emitted = materialise(varied.select("line", "first", F.explode(every).alias("e")).select("line", "first", "e.v", "e.n", "e.gap"),
                          "line-variants")  # read twice: counted, then joined
    shared = emitted.groupBy("v", "n").agg(F.count(F.lit(1)).alias("lines")).where(F.col("lines") > 1).drop("lines")
    met = materialise(emitted.join(shared, ["v", "n"]), "line-variants-met")
    gaps, wholes = met.where(F.col("gap") >= 0), met.where(F.col("gap") < 0)
    earliest = F.min(F.struct("first", "line")).alias("to")
    same_gap = gaps.join(gaps.groupBy("v", "n", "gap").agg(earliest), ["v", "n", "gap"])
    to_whole = gaps.join(wholes.groupBy("v", "n").agg(earliest), ["v", "n"])
    from_whole = wholes.join(gaps.groupBy("v", "n").agg(earliest), ["v", "n"])
    links = None
    for joined in (same_gap, to_whole, from_whole):
        later = joined.where(F.col("to.first") < F.col("first")).select("line", F.col("to.line").alias("earlier"))
        links = later if links is None else links.union(later)
    texts = candidates.select("line", "first", "words")
    return (links.distinct().join(texts, "line")
            .join(texts.select(F.col("line").alias("earlier"), F.col("words").alias("before")), "earlier")
            .where(_within_one_edit("words", "before")).select("first").distinct())


def _with_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .withColumn("row_hash", F.xxhash64("text")))


def mark(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, row_hash, gone``: the positions (from 0) of the lines that go, for
    every document that loses any; ``row_hash`` is the hash of its text."""
    docs = _with_key(df, id_col, text_col)
    lines = (docs.select("id", "row_hash", F.posexplode(F.split(_spaced(F.col("text")), "\n")).alias("pos", "line"))
             .where(F.btrim("line") != "")  # on the line itself: its words are then put together once
             .select("id", "row_hash", "pos", _words_of(F.col("line")).alias("joined")))
    hashed = lines.select("id", "row_hash", "pos", F.xxhash64("joined").alias("h1"),
                          F.xxhash64(F.lit("line"), "joined").alias("h2"),
                          _anchors(F.col("joined"), _count(F.col("joined"))).alias("anchors"))
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row_hash", "pos")
    distinct = materialise(hashed.groupBy("h1", "h2").agg(
        F.min(first).alias("first"), F.first("anchors").alias("anchors"), F.count(F.lit(1)).alias("times")), "line-classes")
    repeated = (hashed.select("h1", "h2", first.alias("own"))
                .join(distinct.where(F.col("times") > 1).select("h1", "h2", "first"), ["h1", "h2"])
                .where(F.col("own") != F.col("first")).select(F.col("own").alias("at")))

    anchored = distinct.select("first", F.explode("anchors").alias("anchor"))
    shared = anchored.groupBy("anchor").agg(F.count(F.lit(1)).alias("lines")).where(F.col("lines") > 1).drop("lines")
    places = (anchored.join(shared, "anchor").select("first.id", "first.row_hash", "first.pos")
              .groupBy("id", "row_hash").agg(F.collect_set("pos").alias("at"))  # places in one text
              .withColumnsRenamed({"id": "its_id", "row_hash": "its_hash"}))
    candidates = materialise(
        docs.join(places, F.col("id").eqNullSafe(F.col("its_id")) & (F.col("row_hash") == F.col("its_hash")))
        .dropDuplicates(["id", "row_hash"]).withColumn("lines", F.split(_spaced(F.col("text")), "\n"))
        .select("id", "row_hash", "lines", F.explode("at").alias("pos"))
        .select(F.monotonically_increasing_id().alias("line"), first.alias("first"),
                F.split(_words_of(F.get("lines", F.col("pos"))), " ").alias("words")), "lines")
    near = near_lines(candidates).select(F.col("first").alias("at"))
    return (repeated.union(near).select("at.id", "at.row_hash", "at.pos").groupBy("id", "row_hash")
            .agg(F.collect_set("pos").alias("gone")))  # lines of one text


def clean(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = False) -> DataFrame:
    """The rows of ``df`` without repeated and nearly repeated lines (``n_chars``,
    where there is one, follows the text); with ``counts`` also ``n_lines`` and
    ``n_removed``."""
    gone = mark(df, id_col, text_col).withColumnsRenamed({"id": "gone_id", "row_hash": "gone_hash"})
    rows = df.select(F.col(id_col).alias("row_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row_hash"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("row_text"),
                     F.struct(*[F.col(c) for c in df.columns if c != text_col]).alias("rest"))
    joined = (rows.join(gone, F.col("row_id").eqNullSafe(F.col("gone_id")) & (F.col("row_hash") == F.col("gone_hash")), "left")
              .withColumn("lines", F.split("row_text", "\n")))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")),
                       lambda i: F.get(F.col("lines"), i))
    out = joined.withColumn("new_text", F.when(F.col("gone").isNull(), F.col("row_text")).otherwise(F.array_join(left, "\n")))
    columns = {text_col: F.col("new_text")}
    if "n_chars" in df.columns:
        columns["n_chars"] = F.length("new_text").cast(df.schema["n_chars"].dataType)
    extra = [F.size("lines").cast("long").alias("n_lines"),
             F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed")] if counts else []
    return out.select(*[columns[c].alias(c) if c in columns else F.col("rest").getField(c).alias(c) for c in df.columns], *extra)
