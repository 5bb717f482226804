"""Language, pieces, pseudonyms, string tiling and the Jaccard join against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from playlens.llm import decontamination, jaccard_join, language_id, pii, queries, sentence_pieces
from .conftest import LONG, SCHEMA

LOWER = {i: i + 32 for i in range(65, 91)}


def brute_classes(rows, percent, width):
    """doc id -> (set size, class id) by comparing all pairs."""
    sets = {}
    for d, t in rows:
        w = [x for x in re.split("[\x20\x09-\x0d]+", (t or "").translate(LOWER)) if x]
        sets[d] = frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {d: (len(sets[d]), find(d)) for d in ids}


def near_copies(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for size in (3, 4, 6, 9, 12, 16, 17, 20, 40, 120, 300):
        base = [rnd.choice(words) for _ in range(size)]
        for _ in range(9):
            copy = list(base)
            for _ in range(rnd.choice((0, 0, 1, 1, 2, max(1, size // 60), max(1, size // 25)))):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            if rnd.random() < 0.3:
                copy = copy[:-1] + rnd.choice(([], ["end"], ["x", "y"]))
            rows.append((n, rnd.choice((" ", "\n", " \t"))
                         .join(w.upper() if rnd.random() < 0.1 else w for w in copy)))
            n += 1
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "A"), (n + 4, "a"), (n + 5, LONG), (n + 6, LONG + " more")]


@pytest.mark.parametrize("seed, percent, width", [(1, 85, 4), (2, 85, 4), (3, 80, 5)])
def test_classes_match_all_pairs(spark, seed, percent, width):
    rows = near_copies(seed)
    got = jaccard_join.classes(spark.createDataFrame(rows, "doc_id LONG, text STRING"), percent, width).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_classes(rows, percent, width)


def test_classes_of_heavy_sets_only(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "light_bound", lambda sizes, percent: 0)
    rows = near_copies(4)
    got = jaccard_join.classes(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_classes(rows, 85, 4)


def test_star_of_copies_that_differ_from_each_other(spark):
    """Copies that link with the original alone: one class, through the hub."""
    rnd = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    rows = [(1000, " ".join(base))]
    for i in range(40):
        copy = list(base)
        for k in rnd.sample(range(4), 3):
            copy[50 * k + rnd.randrange(40) + 4] = f"own{i}x{k}"
        rows.append((i, " ".join(copy)))
    got = jaccard_join.classes(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_classes(rows, 85, 4)
    assert {r["component_id"] for r in got} == {0}


def test_subset_bound_and_sizes():
    for percent in (80, 85):
        for n in range(1, 60):
            for m in range(n, 60):
                o = jaccard_join.needed(n, m, percent)
                assert 100 * o >= percent * (n + m - o) and 100 * (o - 1) < percent * (n + m - o + 1)
    light = np.zeros(jaccard_join.LIGHT_MOST + 1, dtype=np.uint32)
    light[3] = 10
    assert jaccard_join.light_bound(light, 85) >= 3


def test_odd_rows_in_every_document_operator(spark, odd_docs):
    n = odd_docs.count()
    assert jaccard_join.classes(odd_docs).count() == n
    assert language_id.op10_language_id(odd_docs).count() == n
    assert sentence_pieces.encode(odd_docs, queries.piece_model_path()).count() == n
    out = pii.replace_in_documents(odd_docs)
    assert out.columns == odd_docs.columns and out.select(
        *[c for c in out.columns if c != "n_chars"]).exceptAll(odd_docs.drop("n_chars")).count() == 0
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "too short"), (4, "the quick brown fox jumps over the lazy dog")],
                                  "item_id LONG, text STRING")
    hit = decontamination.contaminated(odd_docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in hit) == [(4, 4), (5, 4)]
    kept = decontamination.drop_contaminated(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == n - 3
    one = jaccard_join.keep_one(odd_docs)
    assert one.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in one.collect()) == sorted(map(str, [1, 2, 3, None, 4, 6, 6, 7, 8]))
    lang = language_id.drop_rejected(odd_docs)
    assert lang.columns == odd_docs.columns


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id LONG, text STRING")
    some = spark.createDataFrame([(1, "a b c d e f g", "en", "s", 1)], SCHEMA)
    assert jaccard_join.classes(empty).collect() == [] and jaccard_join.keep_one(empty).collect() == []
    assert language_id.op10_language_id(empty).collect() == [] and language_id.drop_rejected(empty).collect() == []
    assert sentence_pieces.encode(empty, queries.piece_model_path()).collect() == []
    assert pii.pseudonymise(empty).collect() == []
    assert decontamination.contaminated(empty, bench).collect() == [] and decontamination.contaminated(some, bench).collect() == []
    assert decontamination.drop_contaminated(some, bench).count() == 1


def brute_tiles(text, item):
    """Coverage by the definition: search the longest unmarked common run again and again."""
    in_text, in_item, tiles = [False] * len(text), [False] * len(item), 0
    while True:
        best, place = decontamination.SEED - 1, None
        for q in range(len(item)):
            for p in range(len(text)):
                n = 0
                while (q + n < len(item) and p + n < len(text) and item[q + n] == text[p + n]
                       and not in_item[q + n] and not in_text[p + n]):
                    n += 1
                if n > best:
                    best, place = n, (q, p)
        if place is None:
            return sum(in_item), tiles
        tiles += 1
        for i in range(best):
            in_item[place[0] + i] = in_text[place[1] + i] = True


def test_tiling_matches_the_definition():
    rnd = random.Random(7)
    for _ in range(150):
        item = [rnd.choice("abcdefgh") for _ in range(rnd.randrange(5, 40))]
        text = [rnd.choice("abcdefgh") for _ in range(rnd.randrange(0, 30))]
        for _ in range(rnd.randrange(4)):
            a = rnd.randrange(len(item))
            text[rnd.randrange(len(text) + 1):0] = item[a:a + rnd.randrange(3, 20)]
        s = decontamination.SEED
        seeds = [(p, q) for p in range(len(text) - s + 1) for q in range(len(item) - s + 1) if text[p:p + s] == item[q:q + s]]
        tiles = decontamination.tile(seeds)
        assert (sum(t[2] for t in tiles), len(tiles)) == brute_tiles(text, item)


def test_reordered_passages_are_caught(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta eta", "one two three four five six seven", "red green blue cyan pink grey black")
    bench = spark.createDataFrame([(9, f"{a}. {b}. {c}.")], "item_id LONG, text STRING")
    filler = " ".join(f"f{i}" for i in range(200))
    docs = spark.createDataFrame([(1, f"{filler} {c.upper()}! {filler} {a}, {b}"), (2, f"{filler} {a} {filler}"), (3, filler)],
                                 "doc_id LONG, text STRING")
    got = decontamination.contaminated(docs, bench).collect()
    assert [(r["doc_id"], r["item_id"], r["covered"], r["coverage"]) for r in got] == [(1, 9, 21, 1.0)] and got[0]["n_tiles"] >= 2
    assert sorted(r["doc_id"] for r in decontamination.drop_contaminated(docs, bench).collect()) == [2, 3]


@pytest.mark.parametrize("seed", [1, 2])
def test_contaminated_pairs_by_definition(spark, seed):
    """End to end: repeated and null ids with different texts, repetitive texts, both sides."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    items = [(i // 2, " ".join(rnd.choice(words) for _ in range(rnd.randrange(3, 30)))) for i in range(24)]
    items += [(20, "a b c d e f g h i j"), (20, "k l m n o p q r s t"), (21, "x x x x x x x x"), (22, None), (23, ""), (None, items[4][1])]
    docs = []
    for i in range(60):
        parts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(0, 20)))]
        for _ in range(rnd.randrange(3)):
            w = (rnd.choice(items)[1] or "").split()
            a = rnd.randrange(len(w) + 1)
            parts.insert(rnd.randrange(len(parts) + 1), " ".join(w[a // 3:] if rnd.random() < 0.6 else w))
        docs.append((i // 2, "; ".join(parts)))
    docs += [(90, "a b c d e f; k l m n o p"), (91, "x " * 30), (92, None), (93, ""), (None, "a b c d e f g h i j")]
    want = {}
    for d, t in set(docs):
        for k, item in set(items):
            tw, iw = re.findall("[a-z0-9]+", t or ""), re.findall("[a-z0-9]+", item or "")
            covered, tiles = brute_tiles(tw, iw)
            if iw and covered / len(iw) >= decontamination.COVERAGE:
                best = (covered / len(iw), covered, len(iw), tiles)
                want[d, k] = max(want.get((d, k), best), best)
    got = decontamination.contaminated(spark.createDataFrame(docs, "doc_id LONG, text STRING"),
                                       spark.createDataFrame(items, "item_id LONG, text STRING")).collect()
    assert {(r["doc_id"], r["item_id"]): (r["coverage"], r["covered"], r["item_words"], r["n_tiles"]) for r in got} == want
    assert (90, 20) not in want and len(want) > 15


def test_pieces_equal_the_library(spark):
    p = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model_path())
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["a b", "  a  b  ", "", None, "\n\nx y", "▁a ▁ b", "a　b é ñ", "<s> a</s>", "a\tb", "\u0000x", "日本 語",
              "ﬁ x", " ", "   ", "😀 😀😀", "a\n \nb", "\n", "x\n▁", "a" * 5000, LONG]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id INT, text STRING")
    for r in sentence_pieces.encode(docs, queries.piece_model_path()).collect():
        ids = p.encode(texts[r["doc_id"]] or "")
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == p.decode(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(p.decode(ids).encode()).hexdigest()


def test_full_chunk_table_stays_right():
    with open(queries.piece_model_path(), "rb") as f:
        small = sentence_pieces.ChunkTable(f.read(), most=3)
    texts = ["one two three four", "three four five", "six"]
    for _ in range(3):
        got = small.look_up([sentence_pieces.marked_chunks(t) for t in texts])
        assert ["".join(r[2] for r in rows)[1:] for rows in got] == texts
    assert len(small.rows) <= 3


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.op10_language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND accepted")
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count() > 100


def test_language_results_by_definition(spark):
    docs = spark.createDataFrame([(i, t, lang, "s", 1) for i, (t, lang) in enumerate(
        [("the cat and the dog", "en"), ("der hund und die katze", "de")] * 20 + [(None, "en"), ("123 !?", "en"), ("", None)])], SCHEMA)
    got = {r["doc_id"]: r for r in language_id.op10_language_id(docs).collect()}
    assert [got[i]["lang_pred"] for i in (40, 41, 42)] == ["und"] * 3 and not got[40]["accepted"]
    assert all(got[i]["lang_pred"] == ("en", "de")[i % 2] for i in range(40))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    import zlib
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())


def test_copies_fill_one_place_of_the_sample(spark):
    """The text with the smallest hash of each language copied hundreds of times."""
    rows = [(i, f"{lang} own text {'xyz'[i % 3] * (1 + i // 3)}", lang, "s", 1) for lang in ("en", "de") for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA).where(~language_id.held_out(F.col("doc_id")))
    least = docs.groupBy("lang").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    copies = least.crossJoin(spark.range(1000, 1400)).select(
        F.col("id").alias("doc_id"), "text", "lang", F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    alone = language_id.learn(docs, sample_docs=15)
    assert [c.count(b"own text") for c in alone.values()] == [15, 15]
    assert language_id.learn(docs.union(copies), sample_docs=15) == alone


def luhn(number):
    d = [int(c) for c in number][::-1]
    return sum(d[::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])


def test_pseudonyms_keep_formats_links_and_can_be_undone(spark):
    text = ("card 4465758382889437, 4465-7583-8288-9437 or 4465758382889438; ip 233.233.171.252 999.1.1.1; "
            "call +1 (663) 555-6869 or 663-555-6869; born 2020-02-29, 31.12.1999, 2020-02-30; ssn 123-45-6789")
    docs = spark.createDataFrame([(1, text), (2, "again 4465758382889437 at 233.233.171.252"), (3, None), (4, ""),
                                  (5, "write hein.19@mail5.example.com! or HEIN.19@mail5.example.com")], "doc_id LONG, text STRING")
    out = pii.pseudonymise(docs)
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    first = re.search(r"card (\d+), ([\d-]+) or 4465758382889438;", got[1])
    assert luhn(first[1]) % 10 == 0 and first[1] != "4465758382889437" and first[2].replace("-", "") == first[1]
    assert first[1] in got[2] and "999.1.1.1" in got[1] and "2020-02-30" in got[1]
    ip = re.search(r"ip ([\d.]+)", got[1])[1]
    assert ip in got[2] and ip != "233.233.171.252" and all(int(x) < 256 for x in ip.split("."))
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[1]) and re.search(r"born \d{4}-\d\d-\d\d, \d\d\.\d\d\.\d{4},", got[1])
    assert (got[3], got[4]) == (None, "") and "hein" not in got[5].lower()
    mails = re.findall(r"\S+@mail5\.example\.com", got[5])
    assert len(mails) == 2 and len(set(mails)) == 1
    back = {r["doc_id"]: r["text"] for r in pii.pseudonymise(out, inverse=True).collect()}
    assert back[1] == text and back[2] == "again 4465758382889437 at 233.233.171.252"
    other = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs, key="another").collect()}
    assert other[2] != got[2]


def test_feistel_is_a_permutation(spark):
    for a, b in ((10, 10), (17, 43), (3, 100)):
        n = F.col("id")
        perm = pii.permute(n, F.lit(a), F.lit(b), "k", F.lit("t"))
        rows = spark.range(a * b).select("id", perm.alias("p")).withColumn(
            "q", pii.permute(F.col("p"), F.lit(a), F.lit(b), "k", F.lit("t"), inverse=True)).collect()
        assert sorted(r["p"] for r in rows) == list(range(a * b)) and all(r["q"] == r["id"] for r in rows)


def test_pseudonyms_are_native(spark):
    plan = pii.pseudonymise(spark.createDataFrame([(1, "x")], "doc_id LONG, text STRING"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
