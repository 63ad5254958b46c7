"""Personal data: fixed patterns, and identifiers found through their context.

DataFrame functions only.

Base spans come from one regular expression a kind (``BASE``).  The
expressions are the plain ones made linear: possessive, and begun only where a
run begins or the last match ended, which finds the same leftmost
non-overlapping matches.  Positions are code points: the pieces between
matches and the matches themselves are measured and summed up in chunks.

Bootstrapping then looks for identifiers the fixed patterns miss.  A pattern
is the two words or signs before or behind a mention (lower case, digits as 0;
one, where the text or another mention begins or ends there).  Its instances for
a kind are the base spans and the candidates of the kind's shape that it stands
beside anywhere in the table.  Candidates stand outside base spans: addresses
with their signs spelt or without a dot, runs of digits in one or several words
(``FINDERS``), each for the kinds whose test it passes (``_shapes``), and other
words with at least ``MIN_DIGITS`` digits, for any kind.  Seeds are the base
spans, score 1 for their kind.  In every round a pattern's confidence in a kind
is the mean score of its distinct instances, and a candidate's score the chance
that at least one of its patterns is right (1 - product of 1 - confidence).
After ``ROUNDS`` rounds, patterns with confidence of at least ``CONFIDENCE`` that
``MIN_SEEDS`` different seeds support are trusted, and candidates beside them
are believed: with their scores they are seeds of the next ``ROUNDS`` rounds,
which start anew, so that a pattern is trusted for what others found and never
for its own candidates.  This goes on until no new pattern is trusted; a trusted
one stays.  Candidates beside a trusted pattern become spans of its kind, the
more confident one's where two disagree.  Patterns and instances are grouped by
partial aggregation, so a common one is no hot key.

Defined results: a null text is empty; repeated rows get the same spans; a null
id is carried along; texts without mentions have empty spans; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearbox.llm.common import id_and_text, materialise

KINDS = ["email", "ip", "card", "phone"]
# The kinds' patterns (see the module's note on their form).
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for the kind's expression to be tried.
HINT = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
MIN_DIGITS = 6
#: Candidates.  Runs begin at a word's beginning only and are possessive, so they are linear as well.
_DOT = r"(?:\.|\x20?[(\[{](?:\.|(?i:dot))[)\]}]\x20?|\x20(?i:dot)\x20)"
_LABEL = "[A-Za-z0-9-]++"
_AT = rf"(?:@|\x20?[(\[{{<](?:@|(?i:at))[)\]}}>]\x20?|\x20(?i:at)\x20(?={_LABEL}\x20(?i:dot)\x20))"
_GAP = r"(?:[\x20./_-]|\x20[./-]\x20|\)[\x20-]?\(?|\x20?\(|\x20?[(\[{](?:\.|(?i:dot))[)\]}]\x20?|\x20(?i:dot)\x20)"
_HEX = "[0-9A-Fa-f]{0,4}+"
FINDERS = {
    "address": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{_AT}{_LABEL}(?:{_DOT}{_LABEL})*+",
    "number": rf"(?<![A-Za-z0-9:])(?:{_HEX}:){{2,7}}+{_HEX}(?![A-Za-z0-9:])|(?<![A-Za-z0-9])\+?+(?:\((?=[0-9]++\)))?+[0-9]++(?![A-Za-z])"
              rf"(?:{_GAP}?(?:[0-9]++(?![A-Za-z])|[xX*]{{4,12}}+(?![A-Za-z])))*+",
    "word": rf"(?<![^\s])(?=[^0-9\s]*+(?:[0-9][^0-9\s]*+){{{MIN_DIGITS}}})[^\s]++",
}
FINDER_HINT = {"address": r"@|[(\[{<](?i:at)|\x20(?i:dot)\x20", "number": "[0-9]|::",
               "word": f"(?:[0-9][^0-9\\s]*+){{{MIN_DIGITS}}}"}
_TOKEN = r"(?:[\p{L}\p{N}]++|[^\s\p{L}\p{N}])"
BEFORE = rf"((?:{_TOKEN}\s*+|^\s*+){_TOKEN})\s*+$"
BEHIND = rf"^\s*+({_TOKEN}(?:\s*+{_TOKEN})?)"
CONTEXT_CHARS = 80
CHUNK = 512
ROUNDS = 3
CONFIDENCE = 0.8
MIN_SEEDS = 5
_SPAN = "struct<start:int,end:int,value:string,contexts:array<string>>"


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        digits = F.translate(value, " -", "")
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(F.translate(value, "+ ().-", "")).between(8, 15)
    return F.lit(True)


def _is_valid(kind: str):
    return lambda span: _valid(kind, span["value"])


def _shapes(value: Column) -> Column:
    """The kinds that a candidate may be, bit i for the kind in place i."""
    digits, signs = F.length(F.regexp_replace(value, "[^0-9]", "")), F.length(F.regexp_replace(value, "[^0-9xX*]", ""))
    shape = {
        "email": value.rlike(rf"^[A-Za-z0-9._%+-]++{_AT}{_LABEL}(?:{_DOT}{_LABEL})*+$"),
        "ip": value.rlike(rf"^[0-9]{{1,3}}(?:(?:{_DOT}|\x20\.\x20)[0-9]{{1,3}}){{3}}$")
        | (value.rlike(rf"^(?:{_HEX}:){{2,7}}+{_HEX}$") & value.rlike("[0-9A-Fa-f]")),
        "card": value.rlike(r"^[0-9xX*\x20./_-]++$") & signs.between(12, 19),
        "phone": value.rlike(r"^[+(]{0,2}[0-9][0-9()\x20./_-]*+$") & digits.between(3, 15),
    }
    return sum((F.when(shape[k], 1 << i).otherwise(0) for i, k in enumerate(KINDS)), F.lit(0)).cast("int")


def _mention(kind: str | None):
    return lambda span: F.struct(span["contexts"].alias("contexts"), span["value"].alias("value"),
                                 F.lit(kind).cast("string").alias("kind"),
                                 (span["shapes"] if kind is None else F.lit(0)).alias("shapes"))


def _with_shapes(span: Column) -> Column:
    return F.struct(*[span[c].alias(c) for c in ("start", "end", "value", "contexts")], _shapes(span["value"]).alias("shapes"))


def _of_any_kind(span: Column) -> Column:
    return F.struct(*[span[c].alias(c) for c in ("start", "end", "value", "contexts")],
                    F.lit((1 << len(KINDS)) - 1).alias("shapes"))


def _named(span: Column, kind: Column) -> Column:
    return F.concat_ws(":", kind, span["start"].cast("string"), span["end"].cast("string"))


def _named_as(kind: str):
    return lambda span: _named(span, F.lit(kind))


def _ordered_as(i: Column, kind: Column | None):
    """Spans as (place of the kind, start, end, kind), which sorts them."""
    return lambda span: F.struct((i if kind is not None else i[span["kind"]]).alias("i"), span["start"].alias("start"),
                                 span["end"].alias("end"), (kind if kind is not None else span["kind"]).alias("kind"))


def _steps(text: str, pattern: str, hint: str) -> Column:
    """(length of the text before, length, value, contexts) of every match in order; a last entry without value."""
    pieces, matches = F.split(text, pattern, -1), F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    plain = lambda side, c: F.when(c != "", F.concat(F.lit(side), F.regexp_replace(
        F.regexp_replace(c, r"\s+", " "), "[0-9]", "0")))
    before = lambda p: plain("<", F.regexp_extract(F.lower(F.right(p, F.lit(CONTEXT_CHARS))), BEFORE, 1))
    behind = lambda p: plain(">", F.regexp_extract(F.lower(F.left(p, F.lit(CONTEXT_CHARS))), BEHIND, 1))
    gaps = F.zip_with(pieces, F.slice(pieces, F.lit(2), F.size(pieces)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    steps = F.zip_with(gaps, matches, lambda g, m: F.struct(
        F.length(g["p"]).alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("length"), m.alias("value"),
        F.when(m.isNotNull(), F.array_compact(F.array(before(g["p"]), behind(g["q"])))).alias("contexts")))
    return F.when(F.col(text).rlike(hint), steps).otherwise(
        F.array().cast("array<struct<gap:int,length:int,value:string,contexts:array<string>>>"))


def _placed(steps: str) -> Column:
    """The matches with their places; running sums in chunks, so that many matches in a text stay cheap."""
    s = F.col(steps)
    none = F.array().cast(f"array<{_SPAN}>")
    starts = F.sequence(F.lit(1), F.size(s), F.lit(CHUNK))
    total = lambda a, x: a + x["gap"] + x["length"]
    offsets = F.aggregate(starts, F.array(F.lit(0)), lambda acc, at: F.array_append(
        acc, F.aggregate(F.slice(s, at, F.lit(CHUNK)), F.element_at(acc, -1), total)))

    def chunk(at, offset):
        step = lambda acc, x: F.struct(
            total(acc["at"], x).alias("at"),
            F.array_append(acc["out"], F.struct((acc["at"] + x["gap"]).alias("start"), total(acc["at"], x).alias("end"),
                                                x["value"].alias("value"), x["contexts"].alias("contexts"))).alias("out"))
        return F.aggregate(F.slice(s, at, F.lit(CHUNK)), F.struct(offset.alias("at"), none.alias("out")), step,
                           lambda acc: acc["out"])

    spans = F.flatten(F.transform(F.arrays_zip(starts.alias("a"), F.slice(offsets, F.lit(1), F.size(starts)).alias("o")),
                                  lambda z: chunk(z["a"], z["o"])))
    return F.when(F.size(s) > 0, F.filter(spans, lambda x: x["value"].isNotNull())).otherwise(none)


def _base(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds an array of base spans for every kind and ``found``: candidates outside them, with the kinds they may be."""
    finders = {**{k: (BASE[k], HINT[k]) for k in KINDS}, **{f: (FINDERS[f], FINDER_HINT[f]) for f in FINDERS}}
    stepped = docs.select("*", *[_steps(text_col, *finders[f]).alias(f"steps_{f}") for f in finders])
    placed = stepped.select(*docs.columns, *[_placed(f"steps_{f}").alias(f"all_{f}") for f in finders])
    shaped = lambda f: F.filter(F.transform(f"all_{f}", _with_shapes), lambda x: x["shapes"] > 0)
    kept = placed.select(*docs.columns, *[F.filter(f"all_{k}", _is_valid(k)).alias(k) for k in KINDS],
                         shaped("address").alias("address"), shaped("number").alias("number"),
                         F.transform("all_word", _of_any_kind).alias("word"))
    places = lambda *names: F.concat(*[F.transform(c, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end")))
                                       for c in names])
    apart = lambda found, taken: F.filter(found, lambda x: ~F.exists(
        taken, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    # an address before a number in it, and a word only where neither is
    kept = kept.withColumn("taken", places(*KINDS)).withColumn("address", apart(F.col("address"), F.col("taken")))
    kept = kept.withColumn("taken", F.concat("taken", places("address"))).withColumn("number", apart(F.col("number"), F.col("taken")))
    kept = kept.withColumn("taken", F.concat("taken", places("number")))
    return kept.select(*docs.columns, *KINDS, F.concat("address", "number", apart(F.col("word"), F.col("taken"))).alias("found"))


def _may_be(shapes: Column, kind: Column) -> Column:
    return F.array_contains(F.array_compact(F.array(*[
        F.when(shapes.bitwiseAND(F.lit(1 << i)) != 0, F.lit(k)) for i, k in enumerate(KINDS)])), kind)


def _trusted(mentions: DataFrame) -> DataFrame:
    """``context, kind, confidence`` of the patterns that the rounds end up trusting,
    from ``mentions (context, instance, kind or null, shapes)``."""
    edges = materialise(mentions.groupBy("context", "instance").agg(
        F.max("kind").alias("kind"), F.bit_or("shapes").alias("shapes")), "pii-edges")
    base = edges.where(F.col("kind").isNotNull()).select("context", "instance", "kind")
    maybe = (edges.where(F.col("kind").isNull())
             .select("context", "instance", "shapes", F.explode(F.array(*[F.lit(k) for k in KINDS])).alias("kind"))
             .where(_may_be(F.col("shapes"), F.col("kind"))).drop("shapes"))
    in_base = base.groupBy("context").agg(F.count(F.lit(1)).alias("in_base"))
    in_shape = maybe.groupBy("context", "kind").agg(F.count(F.lit(1)).alias("in_shape"))
    seeds = base.select("context", "kind", F.lit(1.0).alias("score"), F.lit(1).alias("seed"))
    score = (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("score")
    behind = lambda patterns: (maybe.join(patterns.select("context", "kind", "confidence"), ["context", "kind"])
                               .groupBy("instance", "kind").agg(score))
    trusted = believed = None
    while True:
        patterns = None
        for _ in range(ROUNDS):
            scored = seeds
            scores = believed if patterns is None else behind(patterns).withColumn("seed", F.lit(0))
            if scores is not None:
                if patterns is not None and believed is not None:  # what is believed stays so in these rounds
                    scores = scores.union(believed).groupBy("instance", "kind").agg(
                        F.max("score").alias("score"), F.max("seed").alias("seed"))
                scored = scored.union(maybe.join(scores, ["instance", "kind"]).select("context", "kind", "score", "seed"))
            patterns = materialise(
                scored.groupBy("context", "kind").agg(F.sum("score").alias("sum"), F.sum("seed").alias("seeds"))
                .join(in_base, "context", "left").join(in_shape, ["context", "kind"], "left")
                .select("context", "kind", "seeds", (F.col("sum") / (F.coalesce("in_base", F.lit(0)) + F.coalesce("in_shape", F.lit(0))))
                        .alias("confidence")), "pii-patterns")
        best = patterns.where((F.col("confidence") >= CONFIDENCE) & (F.col("seeds") >= MIN_SEEDS))
        chosen = F.max(F.struct("confidence", "seeds", "kind")).alias("chosen")
        new = best.groupBy("context").agg(chosen).select("context", "chosen.kind", "chosen.confidence")
        if trusted is not None:
            new = new.join(trusted, "context", "left_anti")
        new = materialise(new, "pii-trusted")
        if new.isEmpty():
            return new if trusted is None else trusted
        trusted = new if trusted is None else materialise(trusted.union(new), "pii-trusted")
        believed = materialise(behind(trusted).withColumn("seed", F.lit(1)), "pii-believed")


def extract(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id>``, an array of ``(start, end, value, contexts)`` for every kind (the
    base spans), and ``added``: ``(kind, start, end)`` of the spans found by context."""
    rows = materialise(_base(id_and_text(df, id_col, text_col), text_col)
                       .select(F.monotonically_increasing_id().alias("row"), id_col, *KINDS, "found"), "pii")
    seed = [F.transform(k, _mention(k)) for k in KINDS]
    candidate = F.transform("found", _mention(None))
    mentions = (rows.select(F.explode(F.concat(*seed, candidate)).alias("m"))
                .select(F.explode("m.contexts").alias("context"), F.xxhash64("m.value").alias("instance"), "m.kind", "m.shapes"))
    trusted = _trusted(mentions)
    added = (rows.select("row", F.explode("found").alias("f"))
             .select("row", "f.start", "f.end", "f.shapes", F.explode("f.contexts").alias("context"))
             .join(trusted, "context").where(_may_be(F.col("shapes"), F.col("kind")))
             .groupBy("row", "start", "end").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
             .groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added")))  # the mentions of one text
    return (rows.join(added, "row", "left")
            .select(id_col, *KINDS, F.coalesce("added", F.array().cast("array<struct<kind:string,start:int,end:int>>"))
                    .alias("added")))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and hash of the base spans, and all spans as text."""
    base = F.array_join(F.concat(*[F.transform(k, _named_as(k)) for k in KINDS]), ",")
    places = F.create_map(*[F.lit(v) for i, k in enumerate(KINDS) for v in (k, i)])
    every = F.concat(*[F.transform(k, _ordered_as(F.lit(i), F.lit(k))) for i, k in enumerate(KINDS)],
                     F.transform("added", _ordered_as(places, None)))
    return found.select(id_col, *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(base, 256).alias("base_sha256"),
                        F.array_join(F.transform(F.array_sort(every), lambda x: _named(x, x["kind"])), ",").alias("spans"),
                        F.size("added").cast("long").alias("n_added"))
