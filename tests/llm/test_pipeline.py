"""The pipeline over a small table, stage by stage, and its registration."""

import re

import __spark_entry__ as entry
import corpus_pipeline
from gearbox.llm import simhash, toxicity
from gearbox.llm.common import table

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "mixing", "packing"]


def test_stage_by_stage(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    model = toxicity.fit(docs, table(spark, SF, "labels").where(~toxicity.held_out("doc_id")))
    bad = {r["doc_id"] for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    clean = stage["toxicity"](spark, docs, SF).cache()
    assert {r["doc_id"] for r in docs.select("doc_id").collect()} - {r["doc_id"] for r in clean.select("doc_id").collect()} == bad

    lines = stage["line_dedup"](spark, clean, SF).cache()
    kept = [" ".join(t.split()) for r in lines.collect() for t in r["text"].split("\n") if t.strip()]
    assert len(kept) == len(set(kept)) and lines.count() == clean.count()

    single = stage["simhash"](spark, lines, SF).cache()
    prints = [simhash.fingerprint(r["text"]) for r in single.collect()]
    assert all((a ^ b).bit_count() > 2 for i, a in enumerate(prints) for b in prints[:i])

    mixed = stage["mixing"](spark, single, SF).cache()
    words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in rows)
    n_sources = single.select("source").distinct().count()
    assert 0 <= 1.5 * words(single.collect()) - words(mixed.collect()) <= n_sources
    for df in (clean, lines, single, mixed):
        assert df.columns == columns

    packed = stage["packing"](spark, mixed, SF).collect()
    assert sum(r["length"] for r in packed if True) == sum({(r["doc_id"], r["doc_tokens"], k): r["doc_tokens"]
                                                           for k, r in enumerate(x for x in packed if x["start"] == 0)}.values())


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
