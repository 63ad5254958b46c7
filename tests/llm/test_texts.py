"""Personal data, scores, token counts, packing and mixing against brute force,
exact round trips and held-out labels."""

import hashlib
import itertools
import json
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gearbox.llm import mixing, packing, pii, quality, token_counts, toxicity
from gearbox.llm.common import table, tokenizer_path
from gearbox.llm.tokenizing import ByteBpe, library
from gearbox.llm.word_transducer import WordTransducer

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- personal data
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": lambda: True, "ip": lambda: all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in value.split(".")),
            "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()


def test_base_spans(spark):
    rng = random.Random(3)
    parts = list("ab.@-_%+0123456789 ().é\U0001f600\n") + ["1.2.3.4", "+1 (23) 456-789", "4111111111111111", "a@b.co",
                                                          "4111 1111 1111 1111", "255.1.1.300", "000255.1.1.1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["1 " * 3000 + "x", "+1" + "(" * 5000, "a." * 4000 + "@" + "b." * 4000 + "c", "1" * 20000, "1.1.1.1 " * 2000, "a" * 200_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.digest(pii.extract(df)).collect():
        spans, counts = [], []
        for kind, pattern in PLAIN.items():
            if len(texts[r["doc_id"]]) == 200_000:
                pattern = "(?!)"  # the plain expression is quadratic here; there is nothing to find
            found = [(m.start(), m.end()) for m in re.finditer(pattern, texts[r["doc_id"]]) if valid(kind, m.group())]
            spans += [f"{kind}:{a}:{b}" for a, b in found]
            counts.append(len(found))
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == counts
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r["spans"].split(",")) | {""} and (r["n_added"] or r["spans"] == ",".join(spans))


def test_contexts_find_unseen_identifiers(spark):
    texts = [f"please call me at +1 (555) 010-{1000 + i} tomorrow" for i in range(20)]
    texts += ["you can call me at 555-010-7777 today", "order total was 555-010-8888 units", "call me at noon"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.extract(df)).collect()}
    at = texts[20].index("555")
    assert got[20] == f"phone:{at}:{at + 12}" and got[21] == "" and got[22] == ""
    assert all(got[i].startswith("phone:18:") for i in range(20))


def test_contexts_find_identifiers_of_other_shapes(spark):
    texts = [f"please call me at +1 (555) 010-{1000 + i} tomorrow" for i in range(20)]
    texts += [f"write to mail:user{i}@corp{i}.example or wait" for i in range(20)]
    texts += [f"the server (10.0.3.{i}) answers" for i in range(20)]
    cases = {"call me at 555 010 7777 today": "phone:555 010 7777", "call me at 4711, please": "phone:4711",
             "write to mail:jane(at)corp.example": "email:jane(at)corp.example",
             "so mail:jane at corp dot example it is": "email:jane at corp dot example",
             "our server (10[.]0[.]0[.]1) too": "ip:10[.]0[.]0[.]1",
             "or 555 010 9999 tomorrow": "phone:555 010 9999",  # by what is behind it
             "it cost 4711 units": "", "call me at noon": "", "mail:555 010 7777": "", "look at home": ""}
    texts += list(cases)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.extract(df)).collect()}
    for i, (text, want) in enumerate(cases.items()):
        spans = [s.split(":") for s in got[60 + i].split(",") if s]
        assert ",".join(f"{k}:{text[int(a):int(b)]}" for k, a, b in spans) == want, text


def test_found_identifiers_seed_further_contexts(spark):
    """Base spans support the first context only; the second is trusted for what was found there, the others lack support."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("bcdfghjk") for _ in range(7))
    texts = [f"call me at +1 (555) 010-{1000 + i} {word()} {word()}" for i in range(40)]
    texts += [f"call me at 555-020-{1000 + i} {word()} {word()}" for i in range(8)]
    texts += [f"fax goes under 555-020-{1000 + i} {word()} {word()}" for i in range(8)]
    texts += [f"fax goes under 555-030-{1000 + i} {word()} {word()}" for i in range(2)]
    texts += [f"my number is 555-030-{1000 + i} {word()} {word()}" for i in range(2)]  # two of five: not enough
    texts += [f"my number is 555-040-{1000 + i} {word()} {word()}" for i in range(3)]
    texts += [f"ring us on 555-020-{1000 + i} {word()} {word()}" for i in range(4)]  # a context of four instances
    texts += [f"parts cost them 555-050-{1000 + i} {word()} {word()}" for i in range(9)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    added = {r["doc_id"] for r in pii.digest(pii.extract(df)).collect() if r["n_added"]}
    assert added == set(range(40, 58))


def test_pii_runs_no_python(spark):
    plan = pii._base(spark.createDataFrame([(1, "x")], "doc_id long, text string"), "text")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---------------------------------------------------------------- toxicity
def test_kernel_by_hand():
    def features(word):
        out = {}
        s = "^" + word
        for i, j, k in itertools.combinations(range(len(s)), 3):
            if k - i < toxicity.SPAN:
                out[s[i] + s[j] + s[k]] = out.get(s[i] + s[j] + s[k], 0) + toxicity.DECAY ** (k - i - 2)
        return out
    marks, words = ["idiot", "worthless"], ["idiot", "idxiot", "idot", "worthles", "river", "", "a", "idiotidiot"]
    got = toxicity.Matcher(marks).matrix(words)
    for i, w in enumerate(words):
        for j, m in enumerate(marks):
            a, b = features(w), features(m)
            want = min(1.0, sum(a.get(f, 0) * x for f, x in b.items()) / sum(x * x for x in b.values()))
            assert got[i, j] == pytest.approx(want)


def test_planted_insults(spark):
    rng = random.Random(5)
    common = [a + b + c for a in ("th", "re", "on") for b in ("a", "ing", "ou") for c in ("er", "st", "li", "nd")]
    bad = ["blockhead", "dimwit", "nincompoop"]

    def text(insult=None):
        words = [rng.choice(common) for _ in range(rng.randint(5, 60))]
        if insult:
            words.insert(rng.randrange(len(words)), insult)
        return " ".join(words) + "."
    rows = [(i, text(rng.choice(bad) if i % 5 == 0 else None)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    tests = [("d1mwit", 0), ("dim.wit", 1), ("blxockhead", 1), ("d i m w i t", 1), ("Nincompoops!", 1), ("blockhead", 1), (None, 0), (None, 0)]
    tests = [t for t in tests if t[0] != "d1mwit"]
    got = toxicity.score(spark.createDataFrame([(k, text(w)) for k, (w, _) in enumerate(tests)], "doc_id long, text string"), model)
    assert {r["doc_id"]: r["predicted"] for r in got.collect()} == {k: y for k, (_, y) in enumerate(tests)}


def test_held_out_labels(spark):
    """English insults repeat in this small table; the score must rank held-out rows well above chance."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out("doc_id")))
    rows = (toxicity.score(docs, model).withColumn("held", toxicity.held_out("doc_id")).where("held")
            .join(docs.select("doc_id", "lang"), "doc_id").where("lang = 'en'").join(labels, "doc_id").collect())
    y, p = np.array([r["toxic"] for r in rows]), np.array([r["predicted"] for r in rows])
    assert (p[y == 0] == 0).mean() > 0.95 and (p[y == 1]).mean() > 0.6
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


# ---------------------------------------------------------------- quality
def test_top_k(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([0.0, rng.gauss(0, 1), rng.gauss(5, 0.0001)])) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, key double").repartition(5)
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for k in (0, 1, 10, 333, 500, 999, 1000, 2000):
        assert {r["doc_id"] for r in quality.top_k(df, k, "key", "doc_id").collect()} == {i for i, _ in order[:k]}


@pytest.mark.parametrize("sorted_rows", [1, 50])
def test_top_k_with_a_hot_key_at_the_cut(spark, tmp_path, monkeypatch, sorted_rows):
    """A third of all rows share one key, some of them null ids and repeated rows; few rows may be put in order."""
    monkeypatch.setattr(quality, "SORTED", sorted_rows)
    rng = random.Random(3)
    rows = [(rng.choice([None, 7, i]), rng.choice([0.5, rng.gauss(0, 1), rng.gauss(0, 1e-9)])) for i in range(900)]
    spark.createDataFrame(rows, "doc_id long, key double").repartition(4).write.parquet(f"{tmp_path}/keys")
    df = spark.read.parquet(f"{tmp_path}/keys")
    order = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    for k in (1, 150, 300, 420, 700, 899, 900, 1000):
        got = [tuple(r) for r in quality.top_k(df, k, "key", "doc_id").collect()]
        assert sorted(got, key=repr) == sorted(order[:k], key=repr)


def test_buckets_grow_with_the_rows():
    assert [quality.bucket_number(n) for n in (0, 1, 1 << 18, 1 << 19, 1 << 20, 1 << 30)] == [1 << b for b in (16, 16, 16, 17, 17, 22)]


def test_resample_equals_brute_force(spark):
    """The whole draw: counts over all labelled good texts and all texts, log ratios, Gumbel keys, the largest k."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = docs.select("doc_id", "text", quality.gumbel(quality.SEED, F.col("doc_id").cast("string")).alias("g")).collect()
    lab = labels.where("quality is not null").collect()
    good, n = {r["doc_id"] for r in lab if r["quality"] == 1}, quality.BUCKETS
    hashes = quality.Hashes(n)
    grams = {r["doc_id"]: hashes.grams(r["text"] or "") for r in rows}
    p, q = (np.bincount(np.concatenate([g for i, g in grams.items() if i in good or part]), minlength=n) + 0.5 for part in (False, True))
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    keys = {r["doc_id"]: ratio[grams[r["doc_id"]]].sum() + r["g"] for r in rows}
    k = round(len(rows) * np.mean([r["quality"] for r in lab]))
    want = sorted(keys, key=lambda i: -keys[i])[:k]
    got = {r["doc_id"]: r["key"] for r in quality.resample(docs, labels).collect()}
    assert set(got) == set(want) and all(got[i] == pytest.approx(keys[i]) for i in want)


def test_bucket_counts_and_importance(spark):
    texts = ["a b, c!! a", "", "x | y | z", "A B"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    hashes = quality.Hashes(64)
    each = [np.bincount(hashes.grams(t), minlength=64) for t in texts]
    target, raw = quality.bucket_counts(df, spark.createDataFrame([(0,), (3,), (77,)], "good_id long"), buckets=64)
    assert (raw == sum(each)).all() and (target == each[0] + each[3]).all()
    target, raw = np.arange(64) + 0.0, np.full(64, 3.0)
    p, q = (target + 0.5) / (target + 0.5).sum(), (raw + 0.5) / (raw + 0.5).sum()
    for r in quality.importance(df, target, raw).collect():
        g = hashes.grams(texts[r["doc_id"]])
        assert r["n_grams"] == len(g) and r["log_importance"] == pytest.approx(np.log(p[g] / q[g]).sum())


def test_gumbel(spark):
    g = np.array([r[0] for r in spark.range(20_000).select(quality.gumbel("s", F.col("id"))).collect()])
    assert abs(g.mean() - 0.5772) < 0.03 and abs(g.var() - np.pi ** 2 / 6) < 0.06


def test_good_rows_are_drawn(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    drawn = {r["doc_id"] for r in quality.resample(docs, labels).collect()}
    rows = labels.collect()
    good = [r["doc_id"] in drawn for r in rows if r["quality"] == 1]
    bad = [r["doc_id"] in drawn for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.3


# ---------------------------------------------------------------- tokens
def odd_texts(seed, n):
    rng = random.Random(seed)
    parts = [chr(c) for c in range(1, 0x180)] + list("'''   \n\n\t'stremvld") + ["漢", "\U0001f600", "́", "İ", "Σ", "<|endoftext|>",
                                                                          "<|startoftext|>", " ", "\x85", "ﬁ", "the", "Hello", "12", "  "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["", " ", "a" * 3000, "don't 'll x's 's't"]


def test_word_counts_equal_the_library():
    texts = odd_texts(1, 6000)
    path = tokenizer_path("word_bpe_49k.json")
    machine = token_counts.transducer(path)
    assert machine.words.fast is not None
    want = [len(e) for e in library(path).encode_batch(texts, add_special_tokens=False)]
    assert [machine.count(t) for t in texts] == want
    for chunk in (1, 2, 5, 17):
        assert [machine.count(t, chunk) for t in texts[:1500]] == want[:1500]


@pytest.mark.parametrize("max_states", [1 << 18, 50])
def test_compiled_transducer_equals_the_library(max_states):
    path = tokenizer_path("word_bpe_49k.json")
    machine = token_counts.Transducer(path, max_states)
    rng = random.Random(5)
    latin = [chr(c) for c in range(33, 127)] + [chr(c) for c in range(0xA1, 0x100)]
    texts = odd_texts(6, 1500) + ["".join(rng.choice(latin) for _ in range(n)) for n in (255, 256, 257, 511, 1024, 9000)]
    texts += ["".join(rng.choice("abcdehinorst") for _ in range(n)) for n in (1, 254, 255, 256, 257, 512, 513, 5000)]
    texts += [" ".join("".join(rng.choice("aehinorstéü") for _ in range(rng.randint(1, 40))) for _ in range(3000)), "x" * 700 + " a", ""]
    want = [len(e) for e in library(path).encode_batch(texts, add_special_tokens=False)]
    assert machine.counts(texts) == want
    assert machine.counts(texts, 64) == want


def test_emissions_of_words_are_found_in_any_lane():
    machine = token_counts.transducer(tokenizer_path("word_bpe_49k.json"))
    words = ["the", "international", "b", "thethethe" * 40, "été", "zzzz" * 200, "1", "...", "q" * 600, "end"]
    alone = [machine.count(w) for w in words]
    for turn in range(len(words)):
        turned = words[turn:] + words[:turn]
        assert machine.count(" ".join(turned)) == sum(alone)


def test_merges_that_give_another_token_first():
    compiled = WordTransducer([(b"a", b"b"), (b"b", b"c"), (b"ab", b"c"), (b"a", b"bc"), (b"c", b"d\0"), (b"ab", b"cd\0")], 8)

    def merged(word):  # the definition: the first merge in order, leftmost, until there is none
        parts = [bytes([c]) for c in word[:-1]] + [word[-1:] + b"\0"]
        order = {m: i for i, m in enumerate([(b"a", b"b"), (b"b", b"c"), (b"ab", b"c"), (b"a", b"bc"), (b"c", b"d\0"), (b"ab", b"cd\0")])}
        while True:
            found = min(((order[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in order), default=None)
            if found is None:
                return len(parts)
            i = found[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(8)
    words = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 12))) for _ in range(2000)]
    assert compiled.counts([w + b"\0" for w in words]) == [merged(w) for w in words]


def test_state_maps_compose_associatively():
    machine = token_counts.transducer(tokenizer_path("word_bpe_49k.json"))
    rng = random.Random(3)
    for t in ["one two three four", "nospaceatall" * 4, " lead and trail \n", "a b", ""]:
        cuts = sorted(rng.randrange(len(t) + 1) for _ in range(2))
        a, b, c = (machine.chunk(x) for x in (t[:cuts[0]], t[cuts[0]:cuts[1]], t[cuts[1]:]))
        left, right = machine.compose(machine.compose(a, b), c), machine.compose(a, machine.compose(b, c))
        assert left == right and machine.finish(left) == machine.count(t)


def test_other_vocabularies():
    texts = odd_texts(2, 300)
    path = tokenizer_path("byte_bpe_50k.json")
    assert [token_counts.transducer(path).count(t) for t in texts] == [len(e) for e in library(path).encode_batch(texts, add_special_tokens=False)]
    path = tokenizer_path("piece_bpe_32k.model")
    assert [token_counts.transducer(path).count(t) for t in texts] == [len(x) for x in library(path).encode(texts)]


def test_byte_ids_equal_the_library():
    texts = odd_texts(4, 6000)
    bpe = ByteBpe.of(tokenizer_path("byte_bpe_50k.json"))
    assert bpe.fast is not None
    want = [e.ids for e in bpe.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(bpe.ids(t), dtype="<u4").tolist() for t in texts] == want


# ---------------------------------------------------------------- packing
def check_packed(pieces, want, window):
    by_doc, by_seq = {}, {}
    for r in pieces:
        assert 0 < r["length"] <= window and len(r["ids"]) == 4 * r["length"]
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for doc, rows in by_doc.items():
        rows.sort(key=lambda r: r["start"])
        ids = b"".join(bytes(r["ids"]) for r in rows)
        assert [r["start"] for r in rows] == list(itertools.accumulate([0] + [r["length"] for r in rows[:-1]]))
        assert np.frombuffer(ids, dtype="<u4").tolist() == want[doc] and all(r["doc_tokens"] == len(want[doc]) for r in rows)
    fills = []
    for rows in by_seq.values():
        rows.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rows] == list(itertools.accumulate([0] + [r["length"] for r in rows[:-1]]))
        fills.append(sum(r["length"] for r in rows))
    assert set(by_doc) == set(want) and max(fills) <= window
    return fills


def test_packing_round_trip(spark):
    docs = table(spark, SF, "documents").limit(300).select("doc_id", "text").repartition(3).cache()
    tok = library(tokenizer_path("byte_bpe_50k.json"))
    want = {r["doc_id"]: tok.encode(r["text"], add_special_tokens=False).ids + [0] for r in docs.collect()}
    fills = check_packed(packing.pack(docs).collect(), want, 1024)
    assert sum(f < 1024 for f in fills) <= 3  # one short sequence a task
    row = packing.digest(packing.pack(docs)).where("start = 0").first()
    first = np.array(want[row["doc_id"]][:row["length"]], dtype="<u4").tobytes()
    assert row["ids_crc32"] == zlib.crc32(first)


@pytest.mark.parametrize("max_open", [4096, 5])
def test_sum_of_squares(max_open):
    rng = random.Random(8)
    packer = packing.SumOfSquares(64, max_open)
    items = [rng.choice([rng.randint(1, 64), 40, 24, 33]) for _ in range(800)]
    out = [s for i, n in enumerate(items) for s in packer.place((i, 0, bytes(4 * n), n))] + list(packer.finish())
    assert sum(len(p[2]) for s in out for p in s) == 4 * sum(items)
    assert sum(sum(len(p[2]) for p in s) < 256 for s in out) <= 1


def test_least_sum_of_squares_is_chosen():
    rng = random.Random(1)
    packer = packing.SumOfSquares(16, 10 ** 9)
    for i in range(400):
        n = rng.randint(1, 16)
        if n < 16:
            counts = packer.level.copy()
            cost = {}
            for h in [0] + [h for h in range(1, 16) if counts[h] and h + n <= 16]:
                after = counts.copy()
                after[h] -= h > 0
                if h + n < 16:
                    after[h + n] += 1
                cost[h] = int((after[1:16] ** 2).sum())
            assert cost[packer.choose(n)] == min(cost.values())
        list(packer.place((i, 0, bytes(4 * n), n)))


# ---------------------------------------------------------------- mixing
def test_targets():
    rng = random.Random(6)
    for _ in range(200):
        sizes = [rng.choice([0, rng.randint(1, 9), rng.randint(1, 10_000)]) for _ in range(rng.randint(1, 9))]
        weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
        got = mixing.targets(sizes, weights)
        assert all(t <= 2 * s + 1e-6 for t, s in zip(got, sizes))
        assert sum(got) == pytest.approx(1.5 * sum(sizes))
        free = [t / w for t, s, w in zip(got, sizes, weights) if t < 2 * s - 1e-6]
        assert not free or max(free) - min(free) < 1e-6 * max(free)
        assert all(2 * s <= max(free, default=0) * w + 1e-6 for t, s, w in zip(got, sizes, weights) if free and t >= 2 * s - 1e-6)


def test_flow_is_cheapest():
    """Small overlapping instances against enumeration."""
    rng = random.Random(12)
    for _ in range(25):
        sources = ["a", "b"]
        patterns = {"A": ["a"], "B": ["b"], "AB": ["a", "b"]}
        cap = {p: rng.randint(0, 4) for p in patterns}
        quota = {s: rng.randint(0, 7) for s in sources}
        flow = mixing.min_cost_flow(cap, patterns, quota)
        cost = lambda used: sum(min(u, cap[p]) + 2 * max(0, u - cap[p]) for p, u in used.items())
        best = None
        for a, b, x, y in itertools.product(*[range(2 * cap["A"] + 1), range(2 * cap["B"] + 1), range(2 * cap["AB"] + 1), range(2 * cap["AB"] + 1)]):
            if a + x <= quota["a"] and b + y <= quota["b"] and x + y <= 2 * cap["AB"]:
                k = (-(a + b + x + y), cost({"A": a, "B": b, "AB": x + y}))
                best = k if best is None else min(best, k)
        used = {p: sum(f.values()) for p, f in flow.items()}
        assert (-sum(used.values()), cost(used)) == best
        assert all(sum(flow[p].get(s, 0) for p in patterns) <= quota[s] for s in sources)


def test_flow_leaves_no_cheaper_way():
    """Larger instances: no residual path takes more words, and no exchange lowers a repetition."""
    rng = random.Random(21)
    for _ in range(20):
        sources = [f"s{i}" for i in range(12)]
        members = {f"p{i}": rng.sample(sources, rng.randint(1, 3)) for i in range(120)}
        cap, quota = {p: rng.randint(0, 30) for p in members}, {s: rng.randint(0, 400) for s in sources}
        flow = mixing.min_cost_flow(cap, members, quota)
        used, taken = {p: sum(f.values()) for p, f in flow.items()}, {s: sum(f.get(s, 0) for f in flow.values()) for s in sources}
        assert all(0 <= used[p] <= 2 * cap[p] for p in cap) and all(taken[s] <= quota[s] for s in sources)

        def reached(start):  # patterns whose words could be given back, and sources, if ``start`` gave one word more
            seen, todo = {start}, [start]
            while todo:
                n = todo.pop()
                new = members[n] if n in members else [p for p in members if flow[p].get(n, 0) > 0]
                for m in new:
                    if m not in seen:
                        seen.add(m)
                        todo.append(m)
            return seen

        for p in members:
            if used[p] < 2 * cap[p]:
                seen = reached(p)
                assert all(taken[s] == quota[s] for s in seen if s in quota)  # maximal
                if used[p] < cap[p]:  # a first use is free: no second use that it could replace
                    assert all(used[o] <= cap[o] for o in seen if o in members)


def test_more_than_ten_thousand_patterns(spark):
    pairs = list(itertools.combinations(range(160), 2))
    rows = [(i, "w " * (1 + i % 7), [f"s{a}", f"s{b}"]) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    got = mixing.mix(df, members=F.col("sources"), share=0.4, weights=(1,)).collect()
    assert len(got) == len(pairs) > 12_000
    goal = mixing.targets([sum(1 + i % 7 for i, p in enumerate(pairs) if s in p) for s in range(160)], [1] * 160, share=0.4)
    assert sum(r["taken"] for r in got) == sum(int(t) for t in goal)
    assert all(0 <= r["taken"] <= r["size"] for r in got)  # nothing need be repeated


def test_overlapping_sources_and_rows(spark):
    rng = random.Random(13)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), rng.choice([["a"], ["b"], ["a", "b"], ["b", "c"]])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>").repartition(4)
    mixed = mixing.mix(df, members=F.col("sources"))
    first, again = ({(r["doc_id"], r["taken"]) for r in m.collect()} for m in (mixed, mixing.mix(df.repartition(2), members=F.col("sources"))))
    assert first == again
    taken = dict(first)
    size = {i: len(t.split()) for i, t, _ in rows}
    assert all(0 <= taken[i] <= 2 * size[i] for i in taken) and len(taken) == 400
    assert sum(taken.values()) == sum(sum(f.values()) for f in mixing.min_cost_flow(
        *_instance(rows, size)).values())
    out = mixing.apply(df, mixed).groupBy("doc_id").agg(F.sum(F.size(F.filter(F.split("text", " "), lambda w: w != ""))).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in out} == {i: n for i, n in taken.items() if n}


def test_more_sources_than_the_flow_takes(spark, monkeypatch):
    """Sources without common documents, and small groups of sources, in a plan too large to broadcast."""
    monkeypatch.setattr(mixing, "BROADCAST_PATTERNS", 20)
    rng = random.Random(14)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), [f"s{i % 90:02}"]) for i in range(300)]
    rows += [(300 + i, "w " * rng.randint(1, 30), [f"s{2 * k:02}", f"s{2 * k + 1:02}"]) for i, k in enumerate([*range(25)] * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>").repartition(4)
    got = {r["doc_id"]: r for r in mixing.mix(df, members=F.col("sources")).collect()}
    size = {i: len(t.split()) for i, t, _ in rows}
    members = {i: s for i, _, s in rows}
    cap, of, quota = _instance(rows, size)
    flow = mixing.min_cost_flow(cap, of, quota)
    total = {p: 0 for p in cap}
    for i, r in got.items():
        assert len(r["target"]) == len(members[i]) and [int(t) for t in r["target"]] == [quota[s] for s in members[i]]
        total[json.dumps(members[i])] += r["taken"]
    assert len(got) == 350 and sum(total.values()) == sum(sum(f.values()) for f in flow.values())
    cost = lambda t: sum(min(n, cap[p]) + 2 * max(0, n - cap[p]) for p, n in t.items())
    assert cost(total) == cost({p: sum(f.values()) for p, f in flow.items()})
    assert all(total[p] == sum(flow[p].values()) for p in cap if len(of[p]) == 1 and int(of[p][0][1:]) >= 50)


def _instance(rows, size):
    import json

    cap, members = {}, {}
    for i, _, s in rows:
        p = json.dumps(s)
        cap[p] = cap.get(p, 0) + size[i]
        members[p] = s
    sources = sorted({s for m in members.values() for s in m})
    sizes = [sum(cap[p] for p in cap if s in members[p]) for s in sources]
    goal = mixing.targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(sources))])
    return cap, members, {s: int(t) for s, t in zip(sources, goal)}
