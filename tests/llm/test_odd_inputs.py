"""Every operator and stage: nulls, empty and long texts, repeated rows, empty
tables, extra columns with clashing names."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gearbox.llm import (embedding_dedup, line_dedup, mixing, packing, pii, quality, simhash, spotsigs,
                         token_counts, toxicity)
from gearbox.llm.common import SLICE_BYTES, in_slices

PER_ROW = {
    "lines": lambda d, _: line_dedup.clean(d, counts=True),
    "simhash": lambda d, _: simhash.near_duplicates(d),
    "pii": lambda d, _: pii.digest(pii.extract(d)),
    "mixing": lambda d, _: mixing.mix(d),
    "spotsigs": lambda d, _: spotsigs.edited(d),
    "prints": lambda d, _: spotsigs.fingerprints(d),
    "toxicity": lambda d, lab: toxicity.score(d, toxicity.fit(d, lab)),
    "tokens": lambda d, _: token_counts.count_tokens(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_every_row(odd_docs, some_labels, name):
    assert PER_ROW[name](odd_docs, some_labels).count() == odd_docs.count()


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_table(no_docs, some_labels, name):
    assert PER_ROW[name](no_docs, some_labels).count() == 0


def test_packing_and_resampling(odd_docs, no_docs, some_labels):
    assert packing.pack(odd_docs).where("start = 0").count() == odd_docs.count()
    assert packing.pack(no_docs).count() == 0
    assert 0 < quality.resample(odd_docs, some_labels, share=0.5).count() <= odd_docs.count()
    assert quality.resample(odd_docs, some_labels.limit(0)).count() == odd_docs.count()  # no labels: all stay
    assert quality.resample(no_docs, some_labels).count() == 0
    assert toxicity.score(odd_docs, toxicity.fit(odd_docs, some_labels.limit(0))).where("score <> 0").count() == 0


def test_kept_columns_keep_their_values(odd_docs, some_labels):
    model = toxicity.Model()
    for out in (line_dedup.clean(odd_docs), toxicity.keep_clean(odd_docs, model), simhash.keep_one(odd_docs),
                mixing.apply(odd_docs, mixing.mix(odd_docs))):
        assert out.columns == odd_docs.columns
        assert out.where(F.col("row_hash") != "own row_hash").count() == 0
    for out in (line_dedup.clean(odd_docs), mixing.apply(odd_docs, mixing.mix(odd_docs))):
        assert out.where("n_chars is null or n_chars <> length(text)").count() == 0


def test_repeated_rows_and_null_ids(odd_docs):
    kept = simhash.keep_one(odd_docs).select("doc_id", "text").collect()
    ids = [r["doc_id"] for r in kept]
    assert ids.count(6) <= 1 and 2 in ids and 3 not in ids and 4 not in ids  # texts without words: one group
    assert sum(i is None for i in ids) == 1  # the null id with a text of its own
    cleaned = {(r["doc_id"], r["text"]) for r in line_dedup.clean(odd_docs).select("doc_id", "text").collect()}
    assert (6, "") in cleaned and (7, "") in cleaned and (4, "   \n\t \n") in cleaned


@pytest.mark.parametrize("k", range(4))
def test_stages_return_documents(spark, odd_docs, no_docs, tmp_path, some_labels, k):
    some_labels.write.parquet(f"{tmp_path}/labels.parquet")
    name, stage = corpus_pipeline.STAGES[k]
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    assert stage(spark, docs, str(tmp_path)).count() > 0
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [inf, 1.0]),
            (8, [nan, 1.0]), (9, [1.0, 0.0]), (None, [1.0, 0.1]), (10, [1.0, 0.0, 0.0]), (11, [1e300, 1e299]), (12, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select("*", F.lit(1).alias("n"), F.lit(2).alias("v"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got[1] == (4, 1, True) and got[2] == got[9] == got[11] == (4, 1, False) and got[None][:2] == (4, 1)
    for i in (3, 4, 5, 6, 7, 8, 10, 12):
        assert got[i] == (0, i, True)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_a_task_takes_large_batches_in_slices(spark, monkeypatch):
    """A kept text goes to the task once, and what a task makes of a batch is bounded."""
    sent = []
    real = toxicity.map_in_arrow
    monkeypatch.setattr(toxicity, "map_in_arrow", lambda df, fn, schema: sent.append((df.columns, fn)) or real(df, fn, schema))
    docs = spark.createDataFrame([(1, None, "a"), (2, "you idiot", "b"), (3, "", None)], "doc_id long, text string, source string")
    model = toxicity.Model(["idiot"], np.array([8.0]), -4.0)
    kept = toxicity.keep_clean(docs, model)
    assert [tuple(r) for r in kept.orderBy("doc_id").collect()] == [(1, None, "a"), (3, "", None)]
    columns, run = sent[0]
    assert len(columns) == len(docs.columns)
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 2000] * 4000), pa.array(range(4000)), pa.array(["s"] * 4000)], names=columns)
    found = list(run(iter([batch])))
    assert [i for b in found for i in b.column(0).to_pylist()] == list(range(4000))
    assert max(b.nbytes for b in found) < 2 * SLICE_BYTES < batch.nbytes


def test_slices():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 50, None, "", "y" * 500, "z"])], names=["text"])
    for size in (1, 100, 1 << 20):
        parts = list(in_slices(iter([batch, batch.slice(0, 0), batch.slice(3)]), size))
        assert [t for b in parts for t in b.column(0).to_pylist()] == ["x" * 50, None, "", "y" * 500, "z", "y" * 500, "z"]
        assert all(b.num_rows for b in parts)
