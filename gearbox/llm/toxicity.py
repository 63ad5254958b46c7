"""Toxicity by a support vector machine over a gapped string kernel.

Kernel.  A word's features are its subsequences of three letters (a mark
stands before the first) within a window of five, each weighted ``DECAY`` to
the power of the letters skipped: an insult with a letter put in between or
left out still shares most of them, and signs between its letters are dropped
before.  The kernel of two words is the inner product of those features over
that of the landmark with itself.

Landmarks (Nystroem).  The labelled rows give the words and word beginnings
whose document frequency differs most between the two labels (likelihood
ratio, counted by Spark); of nested ones the strongest stays.  A text is seen
through its best match with every landmark, and the features are whitened by
the inverse square root of the landmarks' own kernel matrix.

Training.  A squared-hinge linear SVM over labelled texts and their sentences
(a sentence takes its text's label; one without any match says nothing and is
left out), classes weighted evenly, and a logistic link fitted to held-in scores; on at most
``MAX_TRAIN`` labelled rows (those with the smallest hash of their id).
Nothing but the text of a row is an input of its score.

Scoring reads every whole text: each distinct word of a task is matched once
and remembered in a bounded table.

Defined results: null and empty texts get the score of a text without any
match; repeated rows get equal scores; where the labels teach nothing (none,
only one label, no landmark) every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gearbox.llm.common import id_and_text, in_slices, map_in_arrow, materialise

THRESHOLD = 0.3
MAX_TRAIN = 8_000
LANDMARKS = 96
MIN_RATIO = 10.0       # log-likelihood ratio that a landmark needs, against chance among millions of words
STEM = (4, 9)          # letters of a word beginning that can be a landmark
FLOOR = 0.5            # kernel values below it are as good as none
DECAY = 0.6
SPAN = 5               # letters that a subsequence of three may stretch over
REMEMBERED = 300_000
SENTENCE_END = re.compile(r"[.!?\n]+")
LETTERS = 64           # codes: 1 the mark before a word, 2-27 a-z, others folded into 28-63


def fold(word: str) -> str:
    """A word's letters, lower case; digits and signs between them are dropped."""
    return word.lower() if word.isalpha() else "".join(c for c in word if c.isalpha()).lower()


#: Places of a subsequence's second and third letter after its first.
GAPS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, feature, weight) of every occurrence in ``words`` (folded)."""
    pad = "\0" * (SPAN - 1)
    text = pad.join("\1" + w for w in words) + pad
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    flat = np.where((points >= 97) & (points <= 122), points - 95, np.where(points < 2, points, 28 + points % 36))
    owner = np.cumsum(points == 1) - 1
    who, what, weight = [], [], []
    n = len(flat) - SPAN + 1
    for i, j in GAPS:
        a, b, c = flat[:n], flat[i:n + i], flat[j:n + j]
        ok = np.flatnonzero((a > 0) & (b > 0) & (c > 0))
        who.append(owner[ok])
        what.append((a[ok] * LETTERS + b[ok]) * LETTERS + c[ok])
        weight.append(np.full(len(ok), DECAY ** (j - 2)))
    return np.concatenate(who), np.concatenate(what), np.concatenate(weight)


def _summed(words: list[str]) -> list[dict[int, float]]:
    out: list[dict[int, float]] = [{} for _ in words]
    for w, f, x in zip(*(v.tolist() for v in features(words))):
        out[w][f] = out[w].get(f, 0.0) + x
    return out


class Matcher:
    """Kernel values of words with the landmarks; remembers words."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        vectors = _summed(landmarks)
        self.norm = np.array([sum(x * x for x in v.values()) for v in vectors]) if vectors else np.zeros(0)
        lists: dict[int, list[tuple[int, float]]] = {}
        for k, v in enumerate(vectors):
            for f, x in v.items():
                lists.setdefault(f, []).append((k, x))
        self.starts = np.zeros(LETTERS ** 3 + 1, dtype=np.int32)
        for f, entries in lists.items():
            self.starts[f + 1] = len(entries)
        self.starts = np.cumsum(self.starts, dtype=np.int32)
        order = [e for f in sorted(lists) for e in lists[f]]
        self.who = np.array([k for k, _ in order], dtype=np.int64)
        self.value = np.array([x for _, x in order])
        self.known: dict[str, tuple[bytes, bytes] | None] = {}  # landmarks and values

    def matrix(self, words: list[str]) -> np.ndarray:
        """len(words) x len(landmarks), 1 for a word that holds the landmark whole."""
        m = len(self.landmarks)
        if not words or not m:
            return np.zeros((len(words), m))
        who, what, weight = features(words)
        n = self.starts[what + 1] - self.starts[what]
        hit = n > 0
        who, what, weight, n = who[hit], what[hit], weight[hit], n[hit]
        entry = np.repeat(self.starts[what] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else n
        cell = np.repeat(who, n) * m + self.who[entry]
        total = np.bincount(cell, np.repeat(weight, n) * self.value[entry], minlength=len(words) * m)
        return np.minimum(total.reshape(len(words), m) / self.norm, 1.0)

    def learn(self, new: list[str]) -> None:
        """Remember what these words match; values under FLOOR are left out."""
        for i in range(0, len(new), 4096):
            part = new[i:i + 4096]
            k = self.matrix([fold(w) for w in part])
            some = k.max(axis=1) >= FLOOR if k.shape[1] else np.zeros(len(part), bool)
            for w, row, s in zip(part, k, some):
                if s:
                    at = np.flatnonzero(row >= FLOOR)
                    self.known[w] = (at.tobytes(), row[at].tobytes())  # small arrays would scatter over the heap
                else:
                    self.known[w] = None

    def rows(self, texts: list[str]) -> np.ndarray:
        """Best match of every text with every landmark."""
        out = np.zeros((len(texts), len(self.landmarks)))
        for i, text in enumerate(texts):
            in_order = text.split()
            words = set(in_order)
            words.update(spelled(in_order))
            missing = [w for w in words if w not in self.known]
            if missing:
                if len(self.known) + len(missing) > REMEMBERED:
                    self.known.clear()
                    missing = list(words)
                self.learn(missing)
            found = list(filter(None, map(self.known.__getitem__, words)))
            if found:
                at, value = (b"".join(v) for v in zip(*found))
                np.maximum.at(out[i], np.frombuffer(at, dtype=np.intp), np.frombuffer(value))
        return out


def spelled(words: list[str]) -> list[str]:
    """Runs of three or more single letters ("i d i o t"), joined."""
    out, run = [], []
    for w in words:
        if len(w) == 1 and w.isalpha():
            run.append(w)
        elif run:
            if len(run) > 2:
                out.append("".join(run))
            run = []
    if len(run) > 2:
        out.append("".join(run))
    return out


@dataclass
class Model:
    landmarks: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))  # over best matches, whitening folded in
    bias: float = 0.0


def train_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
               max_rows: int = MAX_TRAIN) -> DataFrame:
    """At most ``max_rows`` labelled texts, those with the smallest id hash."""
    picked = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64(F.col("k").cast("string"), F.lit("toxicity")), "k").limit(max_rows))
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(picked), F.col(id_col) == F.col("k"))  # max_rows rows
    return materialise(rows.select("k", F.col(text_col).alias("text"), "label"), "toxicity")


def pick_landmarks(rows: DataFrame, n_landmarks: int = LANDMARKS) -> list[str]:
    """Words and word beginnings by the likelihood ratio of their document
    frequency under the two labels, label 1 in excess."""
    word = F.regexp_replace(F.lower(F.col("word")), r"[^\p{L}]+", "")
    low, high = STEM
    stems = (rows.select("k", "label", F.explode(F.array_distinct(F.split("text", r"[\x20\x09-\x0D]+"))).alias("word"))
             .select("k", "label", word.alias("w")).where(F.length("w") >= low).groupBy("k", "label")
             .agg(F.collect_set("w").alias("ws"))  # the words of one text
             .select("label", F.explode(F.array_distinct(F.flatten(F.transform("ws", lambda w: F.transform(
                 F.sequence(F.lit(low), F.least(F.length(w), F.lit(high))), lambda n: F.substring(w, F.lit(1), n)))))).alias("s")))
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count_distinct("k").alias("n")).collect()}
    n1, n0 = float(n.get(1, 0)), float(n.get(0, 0))
    if not n1 or not n0:
        return []
    counts = (stems.groupBy("s").agg(F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("b"))
              .where((F.col("a") > 1) & (F.col("a") * F.lit(n0) > F.col("b") * F.lit(n1) * 2)))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    share = (a + b) / (n1 + n0)
    ratio = (a * F.log(a / n1 / share) + F.when(b > 0, b * F.log(b / n0 / share)).otherwise(0.0)
             + F.when(n1 > a, (n1 - a) * F.log((1 - a / n1) / (1 - share))).otherwise(0.0)
             + F.when(n0 > b, (n0 - b) * F.log((1 - b / n0) / (1 - share))).otherwise(0.0))
    best = (counts.withColumn("g", ratio).orderBy(F.desc("g"), F.desc(F.length("s")), "s")
            .limit(8 * n_landmarks).collect())
    chosen: list[str] = []
    for r in best:
        if r["g"] >= MIN_RATIO and not any(r["s"].startswith(c) or c.startswith(r["s"]) for c in chosen):
            chosen.append(r["s"])
            if len(chosen) == n_landmarks:
                break
    return chosen


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Squared-hinge SVM with an intercept (last entry) by Newton steps."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    ridge = np.full(x1.shape[1], penalty)
    ridge[-1] = 1e-8
    loss = lambda v: 0.5 * (ridge * v * v).sum() + 0.5 * (weight * np.maximum(0, 1 - y * (x1 @ v)) ** 2).sum()
    for _ in range(steps):
        active = y * (x1 @ w) < 1
        xa, wa = x1[active], weight[active]
        grad = ridge * w - xa.T @ (wa * (y[active] - xa @ w))
        step = np.linalg.solve((xa * wa[:, None]).T @ xa + np.diag(ridge), grad)
        size, now = 1.0, loss(w)
        while loss(w - size * step) > now and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        n_landmarks: int = LANDMARKS, max_rows: int = MAX_TRAIN) -> Model:
    rows = train_rows(docs, labels, id_col, text_col, label_col, max_rows)
    landmarks = pick_landmarks(rows, n_landmarks)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(landmarks)
        for b in in_slices(batches):
            for text, label in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                seen = matcher.rows([text] + SENTENCE_END.split(text))
                seen = seen.round(4)
                seen = np.vstack([seen[:1], np.unique(seen[1:][seen[1:].any(axis=1)], axis=0)])
                yield pa.RecordBatch.from_arrays([pa.array([label] * len(seen), pa.int32()),
                                                  pa.array(np.arange(len(seen)) == 0),
                                                  pa.array(seen.tolist(), pa.list_(pa.float64()))], names=["label", "whole", "x"])

    # at most max_rows texts; equal rows are counted, of which few differ
    data = (rows.transform(map_in_arrow, run, "label int, whole boolean, x array<double>").groupBy("label", "whole", "x").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("label", "whole", "x").collect()) if landmarks else []
    y = np.array([1.0 if r["label"] == 1 else -1.0 for r in data])
    if len(set(y.tolist())) < 2:
        return Model()
    x = np.array([r["x"] for r in data])
    n = np.array([float(r["n"]) for r in data])
    kernel = Matcher(landmarks).matrix(landmarks)
    value, vector = np.linalg.eigh((kernel + kernel.T) / 2)
    whiten = vector @ np.diag(1 / np.sqrt(np.maximum(value, 1e-2))) @ vector.T
    weight = np.where(y > 0, n / (2 * n[y > 0].sum()), n / (2 * n[y < 0].sum()))
    w = fit_svm(x @ whiten, y, weight)
    weights, bias = whiten @ w[:-1], float(w[-1])
    margin = x @ weights + bias
    whole = np.array([r["whole"] for r in data])
    slope, shift = _link(margin[whole], y[whole], n[whole])
    return Model(landmarks, slope * weights, slope * bias + shift)


def _link(margin: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic link from margins of whole texts to the
    share of label 1 (smoothed targets, so that a clean split stays finite)."""
    one, none = n[y > 0].sum(), n[y < 0].sum()
    goal = np.where(y > 0, (one + 1) / (one + 2), 1 / (none + 2))

    def loss(a, b):
        z = np.clip(a * margin + b, -50, 50)
        return float((n * (np.log1p(np.exp(-z)) + (1 - goal) * z)).sum())

    return min((loss(a, b), a, b) for a in np.linspace(0.5, 8, 16) for b in np.linspace(-10, 10, 81))[1:]


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """``<id>, score, predicted`` for every row; ``keep`` names columns to carry along."""
    extra = keep or []
    # a kept text or id goes to the task once
    sent = [text_col, id_col] + [c for c in extra if c not in (text_col, id_col)]
    docs = df.select(*[F.col(c).alias(f"sent_{i}") for i, c in enumerate(sent)])
    kept = [sent.index(c) for c in extra]
    schema = T.StructType([T.StructField(id_col, docs.schema[1].dataType), T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType()),
                           *[T.StructField(f"kept_{i}", docs.schema[k].dataType) for i, k in enumerate(kept)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.landmarks)
        for b in in_slices(batches):
            if not model.landmarks:
                s = np.zeros(b.num_rows)
            else:
                margin = matcher.rows([text or "" for text in b.column(0).to_pylist()]) @ model.weights + model.bias
                s = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))] + [b.column(i) for i in kept],
                names=schema.fieldNames())

    return docs.transform(map_in_arrow, run, schema)


def held_out(id_col):
    """Ids whose crc32 modulo 4 is 2: their labels are never learnt from."""
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % 4 == 2


def keep_clean(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that the model does not reject."""
    scored = score(df, model, id_col, text_col, threshold, keep=list(df.columns))
    return scored.where(F.col("predicted") == 0).select(*[F.col(f"kept_{i}").alias(c) for i, c in enumerate(df.columns)])
