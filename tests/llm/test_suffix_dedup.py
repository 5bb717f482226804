"""Removal of repeated strings against counting every window."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from playlens.llm import queries, suffix_dedup
from .conftest import LONG


def brute_removal(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(hash(r[i:i + length]) for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r) + 1, dtype=bool)
        for i in range(len(r) - length + 1):
            if seen[hash(r[i:i + length])] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), int(gone[0]) + int((~gone[:-1] & gone[1:]).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return out


def planted(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij é日") for _ in range(rnd.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rnd.randrange(25, 120)) for _ in range(6)]
    out = [text(rnd.randrange(5, 150)) for _ in range(40)]
    for _ in range(60):  # passages cut anywhere, side by side and within other text
        p = rnd.choice(passages)
        i = rnd.randrange(0, max(1, len(p) - 100))
        out.append(text(rnd.randrange(0, 30)) + p[i:i + rnd.randrange(60, 900)] + rnd.choice(("", text(20), rnd.choice(passages))))
    base = text(150)
    for _ in range(15):  # near copies
        c = base.split(" ")
        for _ in range(rnd.randrange(1, 6)):
            c[rnd.randrange(len(c))] = word()
        out.append(" ".join(c))
    out += [out[0]] * 3 + ["x" * 199, "x" * 199, "y" * 200, "y" * 200, "z" * 201, "ab" * 150, "abc" * 200, "q" * 1000, base + base]
    return out + [None, "", None, "short", text(400) + base[50:300] + text(10), "\n" * 250]


@pytest.mark.parametrize("seed, most, block, merged", [(1, 1000, 1 << 20, 1 << 19), (2, 3, 700, 1500), (3, 0, 1 << 20, 1 << 19), (4, 8, 5000, 1)])
def test_removal_matches_counting(spark, monkeypatch, seed, most, block, merged):
    monkeypatch.setattr(suffix_dedup, "GROUP_MOST", most)
    monkeypatch.setattr(suffix_dedup, "SHARD", 4)
    texts = planted(seed)
    df = spark.createDataFrame([(i // 2, t, "k", 3) for i, t in enumerate(texts)],
                               "doc_id LONG, text STRING, key STRING, n INT").repartition(3)
    size = (block, merged)

    def small(fn):  # the workers load the module anew, so sizes go with the function
        def run(batches):
            suffix_dedup.BLOCK, suffix_dedup.MERGED, suffix_dedup.SHARD = *size, 4
            yield from fn(batches)
        return run
    plain = suffix_dedup.arrow_map
    monkeypatch.setattr(suffix_dedup, "arrow_map", lambda d, fn, schema: plain(d, small(fn), schema))
    got = suffix_dedup.remove_repeats(df, with_kept=True).collect()
    want = brute_removal(texts)
    assert sorted((r[0], *r[1:5]) for r in got) == sorted((i // 2, *w) for i, w in enumerate(want))
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)
    assert sum(w[1] > 0 for w in want) > 50


def test_merged_transforms_sort_all_suffixes():
    """The merge of the shards' transforms equals sorting all suffixes, and gives their common prefixes."""
    rnd = random.Random(5)
    parts = ["".join(rnd.choice("ab") for _ in range(suffix_dedup.SYMBOL)) for _ in range(3)]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 7))) + "c" * rnd.randrange(50) for _ in range(30)]
    size = suffix_dedup.SYMBOL
    rows = [(k, i) for k, t in enumerate(texts) for i in range(len(t) + 1)]
    first = {k: rows.index((k, 0)) for k in range(len(texts))}
    strings = [texts[k][i:] for k, i in rows]
    known = {s: i for i, s in enumerate(sorted({s[:size] for s in strings if len(s) >= size}))}
    symbols = np.array([known.get(s[:size], -1) if len(s) >= size else -1 for s in strings])
    starts = np.array([first[k] for k, _ in rows])
    stops = np.array([first[k] + len(texts[k]) for k, _ in rows])
    cuts = [0, first[7], first[19], len(rows)]
    shards = [suffix_dedup.shard_order(symbols, stops, np.arange(a, b)) for a, b in zip(cuts, cuts[1:])]
    order, common = suffix_dedup.merge(symbols, starts, shards, 5)
    keys = [tuple(known[s[j:j + size]] for j in range(0, len(s) - size + 1, size))[:5] for s in strings]
    assert [keys[r] for r in order] == sorted(keys) and sorted(order) == list(range(len(rows)))

    def shared(a, b):
        n = next((i for i, (x, y) in enumerate(zip(keys[a], keys[b])) if x != y), min(len(keys[a]), len(keys[b])))
        return n
    assert common[0] == 0 and all(c == shared(a, b) for a, b, c in zip(order, order[1:], common[1:]))


def test_no_texts_and_long_texts(spark):
    df = spark.createDataFrame([], "doc_id LONG, text STRING")
    assert suffix_dedup.remove_repeats(df).count() == 0
    texts = [LONG, "first words " + LONG[1000:90_000], None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    got = suffix_dedup.remove_repeats(df).collect()
    assert sorted(map(tuple, got)) == [(i, *w) for i, w in enumerate(brute_removal(texts))]


def test_small_documents(spark):
    """The registered query on a whole table."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op11_suffix_dedup(spark, sf).collect()
    want = brute_removal([d["text"] for d in docs])
    assert sorted(map(tuple, got)) == sorted((d["doc_id"], *w) for d, w in zip(docs, want))
