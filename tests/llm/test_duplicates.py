"""Line dedup, SimHash, embeddings, SpotSigs and components against brute force."""

import random

import numpy as np
import xxhash

from gearbox.llm import embedding_dedup, line_dedup, simhash, spotsigs
from gearbox.llm.common import connected_components, word_count


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(1000 + i, 1001 + i) for i in range(60)] \
        + [(5, 2000 + i) for i in range(100)]
    want = union(edges, {n for e in edges if e[0] != e[1] for n in e})
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want


def test_word_count(spark):
    texts = ["", " ", "a", " a b", "a\tb\x0bc\x0cd\re\nf", "a b   c", "x  y", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["n"] for r in df.select("i", word_count(df["t"]).alias("n")).orderBy("i").collect()]
    import re
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def near(a, b):
    """Word edit distance at most 1, by trying every place."""
    if abs(len(a) - len(b)) > 1 or max(len(a), len(b)) < line_dedup.MIN_WORDS:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_lines(spark):
    rng = random.Random(7)
    base = [[rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(1, 40))] for _ in range(25)]
    docs, lines = [], []
    for d in range(120):
        text = []
        for _ in range(rng.randint(0, 5)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2])):
                i = rng.randrange(len(w) + 1)
                w = rng.choice([w[:i] + w[i + 1:], w[:i] + ["new"] + w[i:], w[:i] + [rng.choice("xyz")] + w[i + 1:]])
            text.append(rng.choice([" ", "  ", "\t"]).join(w) + rng.choice(["", " "]))
        docs.append((d, "\n".join(text)))
        lines += [(d, p, t.split()) for p, t in enumerate(docs[-1][1].split("\n"))]
    gone = {(d, p) for k, (d, p, w) in enumerate(lines) if w and any(v == w or near(v, w) for _, _, v in lines[:k])}
    want = {d: "\n".join(t for p, t in enumerate(text.split("\n")) if (d, p) not in gone) for d, text in docs}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["text"] for r in line_dedup.clean(df).collect()}
    assert gone and got == want


def test_a_variant_shared_by_most_lines(spark):
    """A third of all lines differ in the same word: one group, still whole."""
    df = spark.createDataFrame([(i, f"the number of this line is {i}") for i in range(3000)], "doc_id long, text string")
    out = line_dedup.clean(df).where("text <> ''").collect()
    assert [r["doc_id"] for r in out] == [0]


def test_long_line_variants(spark):
    words = [f"w{i}" for i in range(1500)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:1100] + words[1101:])), (3, " ".join(words[::-1]))],
                               "doc_id long, text string")
    assert {r["doc_id"]: r["text"] == "" for r in line_dedup.clean(df).collect()} == {1: False, 2: True, 3: False}


def plain_fingerprint(text, k=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
             .translate({c: " " for c in range(9, 14)}).split(" ") if w]
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint():
    for t in ["", "A", "É b", "a b c d", "x y\x1cz \x0b q", "one two three two three one two three", "ab " * 50]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def close_prints(n, seed):
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        f = rng.choice(out)
        for _ in range(rng.randint(0, 3)):
            f ^= 1 << rng.randrange(64)
        out.append(f)
    return out


def test_bit_sliced_block():
    fps = np.array(close_prints(150, 3), dtype=np.uint64)
    for radius in (0, 1, 2, 3, 5):
        apart = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
        np.fill_diagonal(apart, False)
        got = simhash.within_radius(fps, radius)
        bits = np.unpackbits(got.view(np.uint8), axis=1, bitorder="little")[:, :len(fps)].astype(bool) if got is not None else np.zeros_like(apart)
        assert (bits == apart).all()


def test_link_closure(spark, monkeypatch):
    fps = sorted(set(close_prints(300, 5)))
    dense = [fps[0] ^ (1 << i) for i in range(40)]  # one crowded block
    fps = sorted(set(fps + dense))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = union([(a, b) for i, a in enumerate(signed) for b in signed[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2], signed)
    for block in (2048, 7):
        monkeypatch.setattr(simhash, "BLOCK", block)
        edges = simhash.link(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
        got = union([(r["a"], r["b"]) for r in edges], signed)
        assert got == want


def test_documents_by_simhash(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += [t + " end" for t in texts[:30]] + texts[:10]
    fp = [plain_fingerprint(t) for t in texts]
    want = union([(a, b) for a in range(len(fp)) for b in range(a) if (fp[a] ^ fp[b]).bit_count() <= 2], range(len(fp)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = simhash.near_duplicates(df).select("doc_id", simhash.as_hex(simhash.F.col("fp")).alias("x"), "component_id").collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["x"] for r in got} == {i: f"{f:016x}" for i, f in enumerate(fp)}
    assert sorted(r["doc_id"] for r in simhash.keep_one(df).collect()) == sorted(set(want.values()))


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(n // 5, 24))
    x = centre[rng.integers(0, len(centre), n)] + rng.normal(size=(n, 24)) * rng.choice([0.01, 0.1, 0.25, 1.0], size=(n, 1))
    x[: n // 10] = x[n // 10: 2 * (n // 10)]
    return x.astype(np.float32)


def test_vectors_by_cover_tree(spark, monkeypatch):
    x = clustered(700, 2)
    u = x.astype(np.float64)
    u /= np.sqrt((u * u).sum(axis=1, keepdims=True))
    cos = u @ u.T
    np.fill_diagonal(cos, 0)
    near_pairs = np.argwhere(cos >= 0.95)
    want = union([tuple(map(int, p)) for p in near_pairs], range(len(x)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    for block, group in ((4096, 32768), (60, 32768), (60, 200)):
        monkeypatch.setattr(embedding_dedup, "BLOCK", block)
        monkeypatch.setattr(embedding_dedup, "GROUP", group)
        got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df).collect()}
        assert [got[i]["n_links"] for i in range(len(x))] == (cos >= 0.95).sum(axis=1).tolist()
        assert {i: r["component_id"] for i, r in got.items()} == want
        assert all(r["kept"] == (i == want[i]) for i, r in got.items())


def test_dual_traversal_drops_nothing():
    a, b = (embedding_dedup.unit(clustered(300, s)) for s in (4, 4))
    b = b[::-1].copy()
    for t in (0.5, 0.8, 0.95, 0.999):
        found = embedding_dedup.dual(embedding_dedup.CoverTree(a), embedding_dedup.CoverTree(b), t)
        assert (found == (a @ b.T >= t)).all()


def test_vectors_without_structure_are_compared_by_the_bound():
    """No level gathers rows there: none is built, and few pairs are compared whole (levels and all pairs before)."""
    rng = np.random.default_rng(6)
    x = embedding_dedup.unit(rng.normal(size=(1500, 64)))
    y = embedding_dedup.unit(np.concatenate([x[:40] + 0.03 * rng.normal(size=(40, 64)), rng.normal(size=(900, 64))]))
    turn = embedding_dedup.turned(x)
    a, b = (embedding_dedup.CoverTree(v, turn) for v in (x, y))
    assert not a.centre and not b.centre
    bound = a.first @ b.first.T
    assert (bound >= x @ y.T - 1e-5).all() and (bound >= 0.95).mean() < 0.001
    found = embedding_dedup.dual(a, b, 0.95)
    assert (found == (x @ y.T >= 0.95)).all() and found.sum() >= 30
    n_a, n_b = rng.integers(1, 9, 1500), rng.integers(1, 9, 940)
    of_a, of_b = embedding_dedup.linked(found, n_a, n_b)
    assert (of_a == found @ n_b).all() and (of_b == n_a @ found).all()


def jaccard(a, b):
    a, b = set(a.tolist()), set(b.tolist())
    return len(a & b) / len(a | b) if a | b else 1.0


def test_spotsigs(spark, monkeypatch):
    import hashlib

    monkeypatch.setattr(spotsigs, "RANGE_ROWS", 7)
    rng = random.Random(4)
    vocabulary = ["the", "of", "is", "a", "der", "und", "le", "que"] + [f"word{i}" for i in range(30)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 80))) for _ in range(60)] + ["", "xyz", "äöü " * 5]
    ids = rng.sample(range(10_000), len(texts))
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in spotsigs.edited(df).collect()}
    order = sorted(zip(ids, texts))
    signer = spotsigs.Signer()
    for (i, t), (_, u) in zip(order, order[1:] + order[:1]):
        changed = t[:len(t) - len(t) // 4] + u[:len(t) // 4]
        a, e, b = map(signer.signatures, (t, changed, u))
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (spotsigs.digest(a), spotsigs.digest(e))
        assert abs(r["near_edited"] - jaccard(a, e)) < 1e-12 and abs(r["near_next"] - jaccard(a, b)) < 1e-12


def test_signatures_are_anchor_chains():
    one, two = spotsigs.Signer(), spotsigs.Signer()
    assert len(one.signatures("the quick brown fox")) == 1
    assert (one.signatures("The, QUICK brown. dog") == two.signatures("the quick brown fox")).all()
    assert len(one.signatures("the of quick brown")) == 2
    assert jaccard(one.signatures("no anchors here"), one.signatures("no anchors there")) == 0


def test_similar_pairs(spark):
    rng = random.Random(11)
    base = [[rng.getrandbits(40) for _ in range(rng.randint(5, 40))] for _ in range(30)]
    sets = base + [s[:-max(1, len(s) // 12)] + [rng.getrandbits(40)] * (i % 2) for i, s in enumerate(base)]
    df = spark.createDataFrame([(i, sorted(set(s))) for i, s in enumerate(sets)], "doc_id long, signatures array<long>")
    got = {(r["a"], r["b"]) for r in spotsigs.similar(df, threshold=0.8).collect()}
    sets = [set(s) for s in sets]
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert got == want and want
    assert spotsigs.similar(df, threshold=1).collect() == spotsigs.similar(df.limit(0)).collect() == []
