"""The pipeline on a small fixture: each stage's decisions, and the whole by its parts."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from playlens.llm import jaccard_join, word_hashes
from playlens.llm.common import arrow_map
from .conftest import SCHEMA, write_sf
from .test_documents import brute_classes


def test_pipeline_catches_planted_rows_and_keeps_the_rest(spark, tmp_path):
    rnd = random.Random(11)
    source = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(
        "doc_id < 400 AND length(text) BETWEEN 1000 AND 4000").collect()
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in source]
    bench = [r for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()][:20]
    clean = rows[0]
    near = clean[1].split(" ")
    near[5] = "changedword"
    rows += [(9001, clean[1], *clean[2:]), (9002, " ".join(near), *clean[2:]),
             (9003, rows[1][1] + "\n" + bench[3]["text"] + "\n" + " ".join(f"tail{i}" for i in range(80)), *rows[1][2:]),
             (9004, "12345 !!!", "en", "s", 9), (9005, None, None, None, None),
             (9006, " ".join(rnd.sample(rows[2][1].split(), 120)) + " mail me.7@mail.example.com or 4465758382889437", *rows[2][2:])]
    sf = write_sf(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "sf"),
                  benchmark=spark.createDataFrame([(b["item_id"], b["text"]) for b in bench], "item_id LONG, text STRING"))
    docs = spark.read.parquet(sf + "/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name.replace(" ", "-")))
        docs = spark.read.parquet(str(tmp_path / name.replace(" ", "-")))
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    language, near_copies, passages, private = kept
    assert {9004, 9005}.isdisjoint(language) and len(language) >= len(rows) - 2 - 3
    want = brute_classes(list(language.items()), 80, 5)
    assert set(near_copies) == {d for d, (_, c) in want.items() if c == d}
    assert {9001, 9002}.isdisjoint(near_copies)
    assert 9003 not in passages and len(passages) >= 0.85 * len(near_copies)
    assert "me.7@" in passages[9006] and "me.7@" not in private[9006] and "4465758382889437" not in private[9006]
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()}
    assert ids == set(private)


def test_one_document_of_each_class_with_repeated_and_missing_ids(spark):
    a, b, c, d = ("\n".join(f"{x}{i} word" for i in range(60)) for x in "abcd")
    near = c.replace("c59 word", "c59 other")
    rows = [(3, a), (5, a), (5, b), (7, c), (7, near), (None, a), *[(None, d)] * 4, (None, None), (None, " "), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    got = [(r["doc_id"], r["text"]) for r in jaccard_join.keep_one(docs, percent=80, width=5).collect()]
    key = lambda r: (str(r[0]), str(r[1]))
    assert sum(r in ((7, c), (7, near)) for r in got) == 1
    assert sorted((r for r in got if r[0] != 7), key=key) == sorted(
        [(3, a), (5, b), (None, d), (None, None), (None, " "), (8, "")], key=key)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    sf = write_sf(spark.createDataFrame([], SCHEMA), str(tmp_path / "sf"),
                  benchmark=spark.createDataFrame([], "item_id LONG, text STRING"))
    assert corpus_pipeline.run(spark, sf).collect() == []


def test_words_are_hashed_in_little_memory(monkeypatch):
    """What a worker takes for a task it keeps for later ones: the arrays of a block are a few MB."""
    texts = pa.array([f"word{i} and some more text of line {i * 7} " * 40 for i in range(2500)] + ["long " * 200_000, None, ""])
    table = word_hashes.blank_table()

    def hashed():
        found = list(word_hashes.hashed_words(texts, table))
        return np.concatenate([h for *_, h, _ in found]), np.concatenate([rows + first for first, _, _, rows in found])

    small = hashed()
    monkeypatch.setattr(word_hashes, "BLOCK", 1 << 22)
    large = hashed()
    assert all(np.array_equal(a, b) for a, b in zip(small, large, strict=True))
    monkeypatch.undo()
    monkeypatch.setattr(word_hashes, "_powers", {"n": 0})
    tracemalloc.start()
    try:
        for _ in word_hashes.hashed_words(texts, table):
            pass
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 25 << 20, peak


def test_workers_get_small_batches(spark):
    corpus_pipeline._small_batches(spark)
    docs = spark.range(0, 3000, numPartitions=1).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("some text "), F.when(F.col("id") % 2 == 0, 10).otherwise(1000)).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    got = arrow_map(docs, sizes, "n long, bytes long").collect()
    assert sum(r.n for r in got) == 3000
    assert max(r.n for r in got) <= 250 and max(r.bytes for r in got) <= 2 << 20
