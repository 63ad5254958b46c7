"""Conversation repair against brute force, on the given tables and on planted cases."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from gearbox.llm import conversations
from gearbox.llm.conversations import FINAL, damage_report, damaged, least_paths, matrices, repaired, report, walk
from gearbox.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    """Report of one conversation's rows in order: backward recursion over whole audits."""
    seen, kinds = set(), []
    for _, role, text in rows:
        end = text.rstrip(SPACE)[-1:]
        kinds.append("blank" if not end else "duplicate" if (role, text) in seen else "fine" if end in ".!?" else "truncated")
        seen.add((role, text))
    who = [role[:1] for _, role, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]

    @lru_cache(maxsize=None)
    def best(i, done, inserted=0):
        options = []
        if inserted < 3:
            c = "u" if done != "u" else "a"
            cost, audit, out = best(i, c, inserted + 1)
            options.append((cost + 2, "I" + audit, ((None, c),) + out))
        if i == len(rows):
            if done in ("", "a"):
                options.append((0, "", ()))
            return min(options, default=(10 ** 9, "", ()))
        cost, audit, out = best(i + 1, done)
        options.append((3 + cost, "D" + audit, out))
        if kinds[i] in ("fine", "truncated"):
            extra = kinds[i] == "truncated"
            awaited = "a" if done == "u" else "u"
            if who[i] == awaited or (done == "" and who[i] == "s"):
                cost, audit, out = best(i + 1, who[i])
                options.append((cost + extra, "K" + audit, ((i, None),) + out))
            cost, audit, out = best(i + 1, awaited)
            options.append((cost + 2 + extra, "R" + audit, ((i, awaited),) + out))
        return min(options)

    for i in range(len(rows), 0, -20):  # bounds the recursion's depth
        for done in ("", "s", "u", "a"):
            best(i, done)
    cost, audit, out = best(0, "")
    names = {"u": "user", "a": "assistant"}
    lines = [f"{names[c] if c else rows[i][1]}:{rows[i][2] if i is not None else ''}" for i, c in out]
    initials = "".join(line[:1] for line in lines)
    assert re.fullmatch("(s?(ua)+)?", initials)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = [sum(k == x for k in kinds) for x in ("blank", "duplicate", "truncated")]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(who, who[1:]))
    return (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_damage(rows):
    """{conv: rows in order} after damage; rows of one turn must be equal."""
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        kept = out.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            kept += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def as_dict(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {conv: brute(r) for conv, r in brute_damage(rows).items()}
    df = QUERIES["op11_conversation_repair"](spark, f"/root/testdata/{sf}")
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert df.count() == len(want) and as_dict(df) == want


def planted(seed, conversations=60, hot=700):
    draw = random.Random(seed)
    rows = []
    for conv in range(conversations):
        n = hot if conv == 7 else draw.randrange(1, 12)
        for turn in range(n):
            role = draw.choice(["user", "assistant", "assistant", "user", "system", "tool", "", "sam"])
            text = draw.choice(["", " \n", "yes.", "no", f"line {draw.randrange(9)}.", f"line {draw.randrange(9)}", f"own {turn}!"])
            rows.append((conv, None if turn == 0 and conv % 5 == 0 else turn * 2, role, text))
    return rows


@pytest.mark.parametrize("chunk", [4, 256])
def test_conversations_in_many_chunks_and_parts(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversations, "CHUNK_ROWS", chunk)
    rows = planted(chunk)
    want = {conv: brute(r) for conv, r in brute_damage(rows).items()}
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the long conversation lies in several parts
    try:
        got = as_dict(damage_report(df))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got == want


def test_repaired_rows(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK_ROWS", 5)
    df = damaged(spark.createDataFrame(planted(3, 20, 90), SCHEMA)).persist()
    digests = {r["conv_id"]: r["repaired_sha256"] for r in report(df).collect()}
    lines = {}
    for r in repaired(df).orderBy("conv_id", "part", "chunk", "place").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert all(hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() == d for c, d in digests.items())
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in v)) for v in lines.values())


def test_ranks_order_audits_and_matrices_equal_the_dp():
    draw = np.random.default_rng(4)
    who = [draw.integers(0, 4, n) for n in (1, 7, 30, 3)]
    kind = [draw.integers(0, 4, len(w)) for w in who]
    first, letter, pointers, price, rank = least_paths(who, kind, np.array([FINAL] * 4))
    node, begin, end = walk(np.arange(4 * first[-1]), letter, pointers)
    audits = [bytes(conversations.LETTERS[letter[node[s:e]]]) for s, e in zip(begin, begin[1:])]
    order = sorted(set(audits))
    assert [order.index(a) for a in audits] == [sorted(set(rank.tolist())).index(r) for r in rank.tolist()]
    paid = np.array([price[node[s:e]].sum() for s, e in zip(begin, begin[1:])])
    total = (paid + np.array(FINAL)[end % 4]).reshape(-1, 4)[first[:-1]]
    assert (total == (matrices(who, kind) + np.array(FINAL)).min(axis=2)).all()


def test_odd_rows(spark):
    long_text = "word " * 100_000
    rows = [(None, 0, "user", "a."), (None, None, None, None), (1, None, "user", "x"), (1, None, "user", "x"), (2, 5, "assistant", long_text + "."),
            (2, 5, "assistant", long_text + "."), (3, 1, "", ""), (4, -(1 << 62), "user", "q?"), (4, 1 << 62, "assistant", "z!"), (5, 0, None, "t")]
    clashing = ["conv", "part", "run", "chunk", "who", "kind", "key", "keys", "places", "h", "row", "item", "state", "last", "after", "cost", "audit"]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(1).alias(c) for c in clashing])
    want = {conv: brute(r) for conv, r in brute_damage(rows).items()}
    assert as_dict(damage_report(df)) == want
    assert damage_report(df.limit(0)).count() == 0 and repaired(df.limit(0)).count() == 0
    # rows of one turn that differ: any order of them is defined by their content, whatever the input's
    tied = [(1, 0, "user", f"t{i}.") for i in range(9)] + [(1, 0, "assistant", f"t{i}.") for i in range(9)]
    one, other = (as_dict(report(spark.createDataFrame(r, SCHEMA))) for r in (tied, tied[::-1]))
    assert one == other


def test_all_rows_dropped(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = as_dict(damage_report(spark.createDataFrame([(dropped, 0, "user", "x")], SCHEMA)))
    assert got == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
