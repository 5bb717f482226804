"""Hard negatives and token alignment against plain brute force."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from playlens.llm import hard_negatives, queries, token_alignment
from playlens.llm.common import small_batches
from .conftest import LONG


def brute_negatives(rows, anchors, k=5, least=80):
    ok = [(i, y, [math.floor(256.0 * x) for x in v]) for i, y, v in rows
          if None not in (i, y, v) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, label, v in {(i, y, tuple(e)) for i, y, e in ok if i in anchors}:
        scored = sorted((-sum(p * q for p, q in zip(v, e)), i, y) for i, y, e in ok if len(e) == len(v))
        for p, i, _ in [x for x in scored if x[2] == label and x[1] != a][:k]:
            window = [(s, j) for s, j, y in scored if y != label and least * -p <= 100 * -s <= 100 * -p][:k]
            out += [(a, i, r, j, -p, -s) for r, (s, j) in enumerate(window, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed, block, merged", [(1, 8192, 20_000), (2, 17, 0)])
def test_negatives_match_brute_force(spark, monkeypatch, seed, block, merged):
    monkeypatch.setattr(hard_negatives, "ANCHORS", block)
    monkeypatch.setattr(hard_negatives, "MERGED", merged)
    rnd = random.Random(seed)
    few = [[rnd.choice((0.1, 0.25, -0.3, 0.5)) for _ in range(4)] for _ in range(9)]  # many ties
    rows = [(i, rnd.randrange(3), rnd.choice(few) if rnd.random() < .7 else [rnd.gauss(0, 1) for _ in range(4)])
            for i in range(160)]
    rows += [(500, 1, None), (501, None, few[0]), (None, 1, few[0]), (502, 1, [0.1, None, 0.1, 0.1]),
             (503, 1, [float("nan"), 0.0, 0.0, 0.0]), (504, 1, [float("inf"), 0.0, 0.0, 0.0]),
             (505, 1, []), (510, 1, []), (515, 2, []), (520, 0, [0.5, 0.5]), (521, 0, [0.5, 0.5]), (522, 1, [0.5, 0.4]),
             (100, 0, few[1]), (100, 0, few[1]), (100, 2, few[2]), (525, 7, few[3]),
             (530, 1, [-1.0, 0.0, 0.0, 0.0]), (530, 1, [-1.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows],
                               "vec_id LONG, label INT, embedding ARRAY<DOUBLE>, anchor STRING, score INT")
    got = hard_negatives.mine(df, df.where("vec_id % 5 = 0"))
    want = brute_negatives(rows, {i for i, _, _ in rows if i is not None and i % 5 == 0})
    assert sorted(map(tuple, got.collect())) == want and len(want) > 200


def test_large_components_stay_exact(spark):
    big = 2.0 ** 21
    rows = [(0, 1, [big, 1.0, 0.0]), (1, 1, [big, 1.0, 3.0]), (2, 2, [big, 0.99609375, 0.0]), (3, 2, [big - 2, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id LONG, label INT, embedding ARRAY<DOUBLE>")
    got = hard_negatives.mine(df, df.where("vec_id = 0"))
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, {0})


def test_no_rows_no_anchors(spark):
    df = spark.createDataFrame([(1, 1, [0.5])], "vec_id LONG, label INT, embedding ARRAY<FLOAT>")
    assert hard_negatives.mine(df.limit(0), df.limit(0)).count() == 0
    assert hard_negatives.mine(df, df.limit(0)).count() == 0
    assert hard_negatives.mine(df, df).count() == 0


def brute_alignment(texts):
    """Contract columns by walking over the tokens of both libraries, offset by offset."""
    a = Tokenizer.from_file(queries.byte_level_path())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model_path())
    alphabet = token_alignment.byte_level_alphabet()
    out, links, held = [], [], defaultdict(int)
    for t in texts:
        x = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids] if t else []
        y = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
             for i in (b.encode(t) if t else []) for p in [b.id_to_piece(i)]]
        if not t or b"".join(p for _, p in x) != (" " + t).encode() or b"".join(p for _, p in y) != (" " + t).encode():
            x = y = []
        spans = []
        for tokens in (x, y):
            at, own = 0, []
            for i, p in tokens:
                own.append((at, at + len(p), i))
                at += len(p)
            spans.append(own)
        cuts = sorted({s[1] for s in spans[0]} & {s[1] for s in spans[1]})
        groups, places = [], [0, 0]
        for hi in cuts:
            ids = []
            for side in (0, 1):
                at = places[side]
                while places[side] < len(spans[side]) and spans[side][places[side]][1] <= hi:
                    places[side] += 1
                ids.append(",".join(str(i) for _, _, i in spans[side][at:places[side]]))
            groups.append("|".join(ids))
        j, pairs = 0, Counter()
        for p, q, i in spans[0]:
            while j and spans[1][j][0] > p:
                j -= 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < q:
                if spans[1][k][1] > p:
                    pairs[i, spans[1][k][2]] += 1
                    j = k
                k += 1
        for pair in pairs:
            held[pair] += 1
        links.append(pairs)
        out.append([len(x), len(y), len(groups), sum(pairs.values()),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if x else ""])
    top = defaultdict(int)
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    return [(*o[:4], sum(n for p, n in pairs.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in pairs.items()), o[4])
            for o, pairs in zip(out, links)], held


ODD = ["", None, " ", "  two  blanks ", "tab\tand\nlines\n\n", "a▁mark of its own", "naïve déjà vu 日本語 \U0001f600\U0001f468‍", "x" * 300,
       "<|endoftext|> and </s><0x41>", "\x00\x01 control", "été", "İstanbul K", "12345.678,90", "don't we'll   \n  end", "=" * 90]


@pytest.mark.parametrize("block", [2 << 20, 60])
def test_alignment_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(token_alignment, "BLOCK", block)
    rnd = random.Random(4)
    words = "the of Haus maison casa token izations überall 42 http://x.yz/ {json} -- (ok) été".split()
    texts = ODD + [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 40))) for _ in range(50)] + [LONG[:2000]] * 3
    df = spark.createDataFrame([(i // 2, t, "k", 7) for i, t in enumerate(texts)],
                               "doc_id LONG, text STRING, block STRING, pair INT").repartition(3)
    got = token_alignment.align(df, queries.byte_level_path(), queries.piece_model_path())
    want, held = brute_alignment(texts)
    assert sorted(map(tuple, got.collect())) == sorted((i // 2, *w) for i, w in enumerate(want))
    counts = token_alignment.pair_counts(df, queries.byte_level_path(), queries.piece_model_path())
    assert {(r[0], r[1]): r[2] for r in counts.collect()} == held


def test_alignment_of_the_small_documents(spark):
    """The registered query on a whole table against the libraries."""
    sf = "/root/testdata/sf0.001"
    got = queries.op13_token_alignment(spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want, _ = brute_alignment([d["text"] for d in docs])
    assert sorted(map(tuple, got)) == sorted((d["doc_id"], *w) for d, w in zip(docs, want))


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id LONG, text STRING")
    assert token_alignment.align(df, queries.byte_level_path(), queries.piece_model_path()).count() == 0


def test_what_a_task_holds_of_the_blocks_is_bounded(spark):
    """Blocks are small, a row group has few of them (a reader decodes a group's lists at once), and
    a worker gets small batches."""
    keys = list(token_alignment.BATCH)
    had = {key: spark.conf.get(key) for key in keys}
    docs = spark.range(0, 3000, numPartitions=1).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("document of "), F.repeat(F.lit("casa überall 42 "), 100)).alias("text"))
    try:
        spark.conf.set(keys[0], "10000")
        spark.conf.set(keys[1], "256MB")
        blocks, *_ = token_alignment.counted(docs, queries.byte_level_path(), queries.piece_model_path())
        assert [int(spark.conf.get(key)) for key in keys] == [250, 1 << 20]
        spark.conf.set(keys[0], "100")
        small_batches(spark, token_alignment.BATCH)
        assert spark.conf.get(keys[0]) == "100"  # a session's smaller number stays
    finally:
        for key, value in had.items():
            spark.conf.set(key, value)
    got = blocks.select(F.size("doc_id").alias("docs"), F.size("id_a").alias("ids")).collect()
    assert sum(r.docs for r in got) == 3000 and len(got) >= 16
    assert max(r.ids for r in got) < 1 << 18
    groups = [f.row_group(i).num_rows for f in (pq.ParquetFile(x.removeprefix("file:")).metadata for x in blocks.inputFiles())
              for i in range(f.num_row_groups)]
    assert sum(groups) == len(got) and max(groups) <= token_alignment.GROUP, groups
