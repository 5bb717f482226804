"""Hard negatives of anchors by slot-decomposed selection.

An anchor's positives are its best scoring rows of the same label; each positive's score P
opens a window of scores ``least/100 * P .. P`` in which the best rows of other labels
are wanted. The windows of one anchor overlap. Their upper limits cut the scores into
disjoint slots, the i-th holding those above the next smaller limit and up to the i-th one:

* every task keeps, for each anchor and slot, only the best ``k`` rows of other labels it
  has seen (a combiner: what it sends is bounded by anchors x slots x k);
* the tasks' lists are merged to the best ``k`` of each slot;
* a window's rows are the first ``k`` of its own slot followed by the lower ones. One merge
  of the slots from the lowest upwards, cut to ``k`` each time, gives the answers of
  all windows. A lower bound only cuts the end of an answer, so it is applied last.

Anchors are scored against all rows in blocks of at most ``ANCHORS`` anchors, each handed to
the tasks as one matrix (bounded by its number of anchors); the rows are read where they lie
and never shuffled. Scores are inner products of the whole numbers ``floor(scale * x)``:
in double precision where the largest possible sum is exact, else in 64-bit integers
(a score has to fit into a long).

Defined results: rows with a null id, label or vector, or with a null or non-finite
component take no part. Vectors of different lengths are not compared; empty ones
score 0. Ties go to the smaller id. Rows repeating an id, label and vector
count as one row as an anchor and as often as they stand as candidates; a row is
never a positive of an anchor with its id. Anchors without a positive and positives
without a row in their window return nothing. A negative positive score has an empty window
(its lower end is above its upper one). Further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import arrow_map, materialise

#: Anchors scored in one pass over the rows, and scores held by a task at a time.
ANCHORS, SCORES = 8192, 1 << 21
#: Rows scored before a task has first bounds that spare it most of the sorting.
FIRST_ROWS = 64
#: Rows that wait to be merged into a task's lists.
MERGED = 20_000


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, label, embedding`` of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       "embedding").where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)


def _matrices(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``row numbers, whole components`` of the vectors of each length."""
    vectors = batch.column("embedding")
    lengths = np.diff(vectors.offsets.to_numpy())
    values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        yield at, values[starts[at][:, None] + np.arange(d)]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held as doubles, as 64-bit integers."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Best:
    """The best ``k`` rows of each slot of a task: higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        #: Least score that can still enter each slot.
        self.bound = np.full(slots, np.iinfo(np.int64).min)
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.n_waiting = 0

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.waiting.append((slot, score, ids))
        self.n_waiting += len(slot)
        if self.n_waiting > max(MERGED, len(self.slot)):
            self.merge()

    def merge(self) -> None:
        slot, score, ids = (np.concatenate(x) for x in zip((self.slot, self.score, self.id), *self.waiting, strict=True))
        self.waiting, self.n_waiting = [], 0
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = place < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]
        last = place == self.k - 1
        self.bound[slot[last]] = score[last]

    def batch(self, first: int, slots: int) -> pa.RecordBatch:
        self.merge()
        return pa.RecordBatch.from_arrays(
            [pa.array(first + self.slot // slots, pa.int64()), pa.array((self.slot % slots + 1).astype(np.int32)),
             pa.array(self.score), pa.array(self.id)], names=["anchor", "slot", "score", "vec_id"])


def _scores(batches: Iterator[pa.RecordBatch], anchors: dict, scale: float) -> Iterator[tuple]:
    """``anchor numbers, their ids and labels, ids and labels of rows, scores`` by blocks of rows."""
    size = FIRST_ROWS
    for batch in batches:
        ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
        for at, matrix in _matrices(batch, scale):
            known = anchors.get(matrix.shape[1])
            if known is None:
                continue
            number, anchor_id, anchor_label, vectors = known
            done = 0
            while done < len(at):
                rows = at[done:done + size]
                yield number, anchor_id, anchor_label, ids[rows], labels[rows], products(vectors, matrix[done:done + size])
                done += len(rows)
                size = max(FIRST_ROWS, SCORES // max(1, len(number)))


def _positives(anchors: dict, first: int, n: int, k: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(n, k)
        for number, a_id, a_label, ids, labels, s in _scores(batches, anchors.value, scale):
            fit = (a_label[:, None] == labels) & (a_id[:, None] != ids) & (s >= best.bound[number][:, None])
            i, j = np.nonzero(fit)
            best.add(number[i], s[i, j], ids[j])
        yield best.batch(first, 1)
    return run


def _negatives(anchors: dict, limits, first: int, least: int, k: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = limits.value  # per anchor the limits, descending; missing ones are -1
        slots = upper.shape[1]
        best = Best(upper.size, k)
        lowest = np.where(upper >= 0, upper, np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        lowest = np.where(upper[:, 0] >= 0, lowest // 100 * least + (lowest % 100 * least + 99) // 100, 0)
        for number, _, a_label, ids, labels, s in _scores(batches, anchors.value, scale):
            fit = (a_label[:, None] != labels) & (s <= upper[number, 0][:, None]) & (s >= lowest[number][:, None])
            i, j = np.nonzero(fit)
            score, i = s[i, j], number[i]
            slot = i * slots + (upper[i] >= score[:, None]).sum(axis=1) - 1
            enter = score >= best.bound[slot]
            best.add(slot[enter], score[enter], ids[j[enter]])
        yield best.batch(first, slots)
    return run


def _top(rows: DataFrame, k: int) -> DataFrame:
    """Merge of the tasks' lists: the best ``k`` of each anchor and slot, numbered."""
    w = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _suffixes(slots: int, k: int) -> list[Column]:
    """Per slot the first ``k`` rows of it and the lower slots, from ``found``, an array
    of ``(down: -score, vec_id, slot)`` in order."""
    def own(slot: int) -> Column:
        return F.filter("found", lambda x: x["slot"] == slot)

    out: list[Column] = []
    for i in range(slots, 0, -1):
        below = F.slice(F.concat(own(i), below), 1, k) if out else own(i)
        out.append(below)
    return out[::-1]


def mine(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5,
         least: int = 80, scale: float = 256.0) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each
    of ``anchors`` and each of its best ``positives`` rows of the same label, the best ``negatives``
    rows of other labels whose score is at most the positive's and at least ``least`` per cent of it.

    Both tables have ``vec_id, label, embedding``."""
    spark = rows.sparkSession
    rows = usable(rows)
    known = materialise(usable(anchors).distinct(), "anchors")
    blocks = -(-known.count() // ANCHORS)  # dealt out in turn, so that each holds ANCHORS at most
    parts = materialise(known.repartition(max(1, blocks)).withColumn("block", F.spark_partition_id()), "anchor-blocks")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out, first = [], 0
    for block in range(blocks):
        piece = parts.where(F.col("block") == block).select("vec_id", "label", "embedding").toArrow().combine_chunks()
        if piece.num_rows:
            found = _mine_block(rows, piece, first, positives, negatives, least, scale)
            out.append(_windows(*found, positives, negatives, least))
        first += piece.num_rows
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], schema)


def _mine_block(rows: DataFrame, piece: pa.Table, first: int, positives: int, negatives: int,
                least: int, scale: float) -> tuple[DataFrame, DataFrame]:
    """Numbered positives and the slots' best rows of one block of anchors."""
    spark = rows.sparkSession
    batch = piece.to_batches()[0]
    ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
    anchors = {m.shape[1]: (at, ids[at], labels[at], m) for at, m in _matrices(batch, scale)}
    shared = spark.sparkContext.broadcast(anchors)  # at most ANCHORS vectors
    schema = "anchor long, slot int, score long, vec_id long"
    top = _top(arrow_map(rows, _positives(shared, first, len(ids), positives, scale), schema), positives)
    names = spark.createDataFrame(list(zip(range(first, first + len(ids)), ids.tolist())), "anchor long, anchor_id long")
    top = materialise(top.join(names, "anchor").select(
        "anchor", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.col("rank").alias("place")), "positives")
    upper = np.full((len(ids), positives), -1, dtype=np.int64)
    got = top.select("anchor", "place", "positive_score").toArrow()  # at most ANCHORS x positives numbers
    upper[got["anchor"].to_numpy() - first, got["place"].to_numpy() - 1] = got["positive_score"].to_numpy()
    limits = spark.sparkContext.broadcast(np.maximum(upper, -1))
    slots = arrow_map(rows, _negatives(shared, limits, first, least, negatives, scale), schema)
    return top, materialise(_top(slots, negatives).drop("rank"), "slots")


def _windows(top: DataFrame, slots: DataFrame, positives: int, negatives: int, least: int) -> DataFrame:
    """Answers of all windows from the slots of their anchors."""
    lists = slots.groupBy("anchor").agg(F.sort_array(F.collect_list(
        F.struct((-F.col("score")).alias("down"), "vec_id", "slot"))).alias("found"))  # slots x negatives at most
    lists = lists.select("anchor", F.array(*_suffixes(positives, negatives)).alias("suffix"))
    score, wide = -F.col("n.down"), "decimal(20,0)"
    # ties among the limits share the last one's slot; lower ones start at its suffix
    return (top.join(lists, "anchor")
            .select("anchor", "anchor_id", "positive_id", "positive_score",
                    F.posexplode(F.element_at("suffix", F.col("place").cast("int"))).alias("at", "n"))
            .where(score.cast(wide) * 100 >= F.col("positive_score").cast(wide) * least)
            .select("anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"),
                    F.col("n.vec_id").alias("negative_id"), "positive_score", score.alias("negative_score")))


def op12_hard_negatives(embeddings: DataFrame) -> DataFrame:
    """The registered query: anchors are the rows whose id is divisible by 100; where
    the id is divisible by 7 the label is moved on by one of ten."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = embeddings.select("vec_id", label.alias("label"), "embedding")
    return mine(rows, rows.where(F.col("vec_id") % 100 == 0))


def oracle_sql() -> str:
    return """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS id, b.label AS label,
         CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r
        FROM s WHERE label = anchor_label) WHERE r <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS r
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.label <> s.anchor_label
    AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE r <= 5
"""
