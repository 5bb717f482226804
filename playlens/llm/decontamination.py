"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits, A-Z lowered, so case and punctuation do not
hide a passage. Every run of ``SEED`` words has a Karp-Rabin hash; texts and benchmark items
are joined on equal hashes, giving seeds (place in the text, place in the item). For each
text and item the seeds are tiled: the longest common run of still unmarked
words becomes a tile and its words are marked, again and again, until no unmarked
run of ``SEED`` words is common. Tiles may lie in any order, so passages with
exchanged sentences are covered too. A text is contaminated by an item when the
tiles cover at least ``COVERAGE`` of the item's words.

Before the join, a bitmap of the benchmark's hashes (its size follows their number, within
``2**28`` bits) drops almost all runs of a text; the join itself is exact.

Defined results: null and empty texts have no seeds; items with fewer than ``SEED``
words, null ones too, contaminate nothing; among equally long runs the one that starts
first in the item, then in the text, is marked first; repeated rows of a text give
one row, as do repeated items; rows of one id with different texts, of documents or of items,
are judged apart and reported with the larger coverage.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm import word_hashes
from playlens.llm.common import arrow_map, build_bitmap, free_name, in_bitmap, materialise

#: Words of a seed, the least length of a tile.
SEED = 5
COVERAGE = 0.8


def _grams(batches: Iterator[pa.RecordBatch], key: str, bitmap: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """``key, copy, at, gram, words`` of each run of SEED words (those in the bitmap)."""
    table = word_hashes.alphanumeric_table()
    for batch in batches:
        ids, copies = batch.column(key), batch.column("copy")
        for first, stop, words, rows in word_hashes.hashed_words(batch.column("text"), table):
            h = word_hashes.shingle_hashes(words, SEED)
            ok = rows[:len(h)] == rows[SEED - 1:] if len(h) else np.zeros(0, bool)
            if bitmap is not None:
                ok &= in_bitmap(bitmap, h)
            at = np.flatnonzero(ok)
            starts = np.searchsorted(rows, np.arange(stop - first + 1))
            row = rows[at]
            take = pa.array(row + first)
            yield pa.RecordBatch.from_arrays(
                [ids.take(take), copies.take(take), pa.array((at - starts[row]).astype(np.int32)),
                 pa.array(h[at].view(np.int64)), pa.array((starts[row + 1] - starts[row]).astype(np.int32))],
                names=[key, "copy", "at", "gram", "words"])


def grams(df: DataFrame, key: str, bitmap: np.ndarray | None = None) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(bitmap)  # at most 2**28 bits
    kind = df.schema[key].dataType.simpleString()
    return arrow_map(
        df.select(key, F.xxhash64("text").alias("copy"), "text"), lambda batches: _grams(batches, key, shared.value), f"{key} {kind}, copy long, at int, gram long, words int")


def tile(seeds: list[tuple[int, int]], seed: int = SEED) -> list[tuple[int, int, int]]:
    """Tiles ``(place in item, place in text, length)`` in the order they are marked."""
    runs: dict[tuple[int, int], int] = {}  # maximal runs of seeds on a diagonal
    ends: dict[tuple[int, int], tuple[int, int]] = {}
    for p, q in sorted(set(seeds)):
        start = ends.pop((p, q), (p, q))
        runs[start] = runs.get(start, seed - 1) + 1
        ends[(p + 1, q + 1)] = start
    queue = [(-n, q, p) for (p, q), n in runs.items()]
    heapq.heapify(queue)
    in_text: set[int] = set()
    in_item: set[int] = set()
    tiles = []
    while queue:
        n, q, p = heapq.heappop(queue)
        free = [q + i not in in_item and p + i not in in_text for i in range(-n)]
        if all(free):
            tiles.append((q, p, -n))
            in_item.update(range(q, q - n))
            in_text.update(range(p, p - n))
            continue
        at = 0  # what is left of the run goes back into the queue
        while at < -n:
            stop = at
            while stop < -n and free[stop]:
                stop += 1
            if stop - at >= seed:
                heapq.heappush(queue, (at - stop, q + at, p + at))
            at = stop + 1
    return tiles


def _tile_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tiles = [tile([(x["p"], x["q"]) for x in seeds.as_py()]) for seeds in batch.column("seeds")]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in ("doc_id", "item_id", "item_words")],
             pa.array([len(t) for t in tiles], pa.int32()),
             pa.array([sum(x[2] for x in t) for t in tiles], pa.int32())],
            names=["doc_id", "item_id", "item_words", "n_tiles", "covered"])


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, item_id, n_tiles, covered, item_words, coverage``: every pair of a
    text and an item it covers."""
    items = materialise(grams(benchmark, "item_id").withColumnRenamed("at", "q").withColumnRenamed("words", "item_words")
                        .withColumnRenamed("copy", "item_copy").distinct(), "benchmark-grams")
    count = items.count()
    log2_bits = min(28, max(16, (64 * count - 1).bit_length()))
    bitmap = build_bitmap(items.select("gram").distinct(), F.col("gram"), log2_bits)
    found = grams(docs, "doc_id", bitmap).drop("words").withColumnRenamed("at", "p")
    # a passage held by very many texts is one hot gram: its rows are spread by the
    # text's hash over as many shares, each with its own copy of the item's rows
    shares = 8
    spread = items.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    seeds = (found.withColumn("share", F.pmod("copy", F.lit(shares)).cast("int")).join(spread, ["gram", "share"])
             .select("doc_id", "copy", "item_id", "item_copy", "item_words", "p", "q").distinct())
    pairs = (seeds.groupBy("doc_id", "copy", "item_id", "item_copy", "item_words")
             .agg(F.collect_list(F.struct("p", "q")).alias("seeds"))
             # each seed covers SEED words at most: with fewer seeds the coverage is out of reach
             .where(F.size("seeds") * SEED >= F.col("item_words") * coverage).drop("copy", "item_copy"))
    kinds = {c: pairs.schema[c].dataType.simpleString() for c in ("doc_id", "item_id")}
    tiled = arrow_map(pairs, _tile_rows, f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, item_words int, "
                                         "n_tiles int, covered int")
    share = F.col("covered") / F.col("item_words")
    return (tiled.withColumn("coverage", share).where(F.col("coverage") >= coverage)
            .groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "covered", "item_words", "n_tiles")).alias("m"))
            .select("doc_id", "item_id", "m.n_tiles", "m.covered", "m.item_words", "m.coverage"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that no benchmark item contaminates (rows without an id are judged by
    their text as well)."""
    key = free_name(docs, "text_hash")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    bad = materialise(contaminated(keyed.select(F.col(key).alias("doc_id"), "text"), benchmark)
                      .select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return keyed.join(bad, key, "left_anti").select(*docs.columns)
