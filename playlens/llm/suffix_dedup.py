"""Removal of byte strings that repeat anywhere in the corpus, by merged Burrows-Wheeler transforms.

Every byte covered by a string of ``length`` bytes (a window) that also starts at another
place, in the same text or another one, is removed.

1. *Windows are dealt to anchors.* A window's anchor is the place of the least hash among its
   ``GRAM``-byte strings, so equal windows have equal anchors at equal distances. The windows of
   one anchor are neighbours; the bytes under them are the anchor's context. Anchors are grouped
   by the hash of their string: one that stands alone has no repeated window; one whose whole
   context repeats has repeated windows only. Only a group with several different contexts is
   open, and of it one copy of each context. Suffixes that cannot repeat never get further.
2. *Shards.* A task gets the contexts of whole groups. Each shard of them is sorted by itself into
   a transform over symbols of ``SYMBOL`` bytes: for every suffix, in order, the symbol before it.
   (Each text is ``SYMBOL`` interleaved strings of symbols, so suffixes start at every byte.)
3. *Merge.* The shards' transforms are merged by iterative interleave refinement: starting
   from the shards one after another, every round takes the rows in the present order
   and puts the preceding suffixes in the order of their symbols, ties as they come. After i
   rounds the rows are in the order of their first i symbols. No suffix is compared or
   sorted again. A border between two rows appears in the round in which they first differ, which
   gives their common prefix; rows in unbroken runs of ``length / SYMBOL`` rounds are the repeated intervals.
4. *Spans.* The windows found go back to their texts, where the bytes they cover are removed.

A group with more than ``GROUP_MOST`` different contexts (a passage that a large share of all
documents hold) would not fit into a task. Its windows are split further, by their
own hash, which needs no task to see the group: they are counted by an aggregate with a map-side part.

Hashes of anchors and contexts have 64 bits and hold together (128 bits for equal contexts);
texts are known by 128-bit digests.

Defined results: null text counts as empty; a text shorter than ``length`` loses nothing; rows are
texts of their own, also under one id, so every copy of a text of ``length`` bytes is removed whole;
further columns do not matter. Long texts are worked through in pieces of ``BLOCK`` windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import arrow_map, materialise
from playlens.llm.word_hashes import mix

LENGTH, SYMBOL, GRAM = 200, 40, 48
#: Windows worked on at a time, bytes of contexts merged at a time, contexts of a shard.
BLOCK, MERGED, SHARD = 1 << 20, 1 << 19, 512
#: Different contexts of an anchor group that a task takes.
GROUP_MOST = 1000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_AT_BITS = 22  # places within a piece, packed below the upper bits of a hash
_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _tables or len(_tables["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _tables[name] = np.multiply.accumulate(steps)
    return _tables["up"], _tables["down"]


class Sums:
    """Running polynomial sums of some bytes, for hashes of any string in them."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def all(self, size: int) -> np.ndarray:
        """Hashes of the strings of ``size`` bytes at every place."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``text, first window, windows, key, context hash`` of the anchors of the texts
    ``data[starts:ends]``; windows are counted from the start of ``data``."""
    fits = ends - starts >= length
    edge = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(edge, starts[fits], 1)
    np.add.at(edge, ends[fits] - length + 1, -1)
    windows = np.flatnonzero(np.cumsum(edge[:-1]))
    sums = Sums(data)
    grams = sums.all(GRAM)
    low = np.uint64((1 << _AT_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    reach, span = length - GRAM + 1, 1
    while span < reach:  # least of the next ``span`` grams, doubled until a window is covered
        step = min(span, reach - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    at = (least[windows] & low).astype(np.int64)
    new = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(windows, prepend=-2) != 1))
    first, n = windows[new], np.diff(np.append(new, len(windows)))
    at = at[new]
    context = mix(sums.hashes(first, first + n + length - 1) + (at - first).astype(np.uint64) * np.uint64(_BASE))
    return np.searchsorted(starts, first, "right") - 1, first, n, grams[at], context


def _pieces(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``rows, offsets in them, starts, bytes`` of blocks of whole texts, or of pieces of a long one."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        lo, hi = int(offsets[row]), int(offsets[stop])
        if stop > row + 1 or hi - lo <= BLOCK:
            yield np.arange(row, stop), np.zeros(stop - row, np.int64), offsets[row:stop + 1] - lo, data[lo:hi]
        else:
            for at in range(0, hi - lo - length + 1, BLOCK):
                part = data[lo + at:min(hi, lo + at + BLOCK + length - 1)]
                yield np.array([row]), np.array([at]), np.array([0, len(part)]), part
        row = stop


def _anchor_rows(length: int, with_place: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, offsets, cuts, data in _pieces(batch.column("text"), length):
                if len(data) < length:
                    continue
                text, first, n, key, context = anchors(data, cuts[:-1], cuts[1:], length)
                cols = [pa.array(key.view(np.int64)), pa.array(context.view(np.int64))]
                if with_place:
                    cols += [batch.column("t").take(pa.array(rows[text])),
                             pa.array(first - cuts[text] + offsets[text], pa.int64()), pa.array(n, pa.int32())]
                yield pa.RecordBatch.from_arrays(cols, names=["key", "context", "t", "lo", "n"][:len(cols)])
    return run


def _covered(size: int, lo: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """Which bytes of a text the windows from ``lo`` on (``n`` each) cover."""
    edge = np.zeros(size + 1, dtype=np.int32)
    np.add.at(edge, lo, 1)
    np.add.at(edge, lo + n + length - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def _removal(data: bytes, lo: np.ndarray, n: np.ndarray, length: int) -> tuple[int, int, str, bytes]:
    """Removed bytes, maximal removed runs, the digest of the bytes that remain, and these."""
    gone = _covered(len(data), lo, n, length)
    kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
    return int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest(), kept


def _cut_texts(length: int, with_kept: bool):
    """Texts with their anchors: results of those whose windows are all decided, the bytes
    of the contexts to be merged, and the text where windows are still open."""
    kind = pa.list_(pa.struct([("key", pa.int64()), ("single", pa.bool_()), ("hot", pa.bool_()),
                               ("lo", pa.int64()), ("n", pa.int32()), ("bytes", pa.binary())]))
    kinds = {"t": pa.binary(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "kept": pa.binary(),
             "text": pa.binary(), "lo": pa.list_(pa.int64()), "n": pa.list_(pa.int32()), "contexts": kind}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, text, found in zip(*(batch.column(c) for c in ("t", "text", "found"))):
                data, f = text.as_py().encode(), found.values
                lo, n, decided, sent = (f.field(c).to_numpy(zero_copy_only=False) for c in ("lo", "n", "decided", "sent"))
                contexts = [{"key": f.field("key")[i].as_py(), "single": not decided[i], "hot": f.field("hot")[i].as_py(),
                             "lo": lo[i], "n": n[i], "bytes": data[lo[i]:lo[i] + n[i] + length - 1]} for i in np.flatnonzero(sent)]
                if decided.all():
                    removed = _removal(data, lo, n, length)
                    out.append((t.as_py(), *removed[:3], removed[3] if with_kept else None, None, [], [], contexts))
                else:
                    out.append((t.as_py(), None, None, None, None, data, lo[decided], n[decided], contexts))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds.values())],
                                             names=list(kinds))
    return run


def shard_order(symbols: np.ndarray, stops: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The rows of a shard in the order of their suffixes of symbols (equal ones by place),
    by doubling the compared length. ``symbols`` is -1 where less than a symbol is left."""
    rank = np.unique(symbols[rows], return_inverse=True)[1].astype(np.int64)
    most, covered = int((stops[rows] - rows).max()) // SYMBOL, 1
    while covered < most:
        follows = rows + covered * SYMBOL
        after = np.where(follows <= stops[rows], rank[np.minimum(follows, rows[-1]) - rows[0]] + 1, 0)
        rank = np.unique(rank * (len(rows) + 2) + after, return_inverse=True)[1].astype(np.int64)
        covered *= 2
    return rows[np.argsort(rank, kind="stable")]


def merge(symbols: np.ndarray, starts: np.ndarray, shards: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Merged order of the shards' rows by their first ``rounds`` symbols, and the common
    prefix (in symbols, at most ``rounds``) of each row with the one before.

    ``symbols[r]`` is the symbol of row ``r`` (-1: less than a symbol is left); the transform's
    entry of a row is the symbol ``SYMBOL`` bytes before it, if its text, which starts at
    ``starts[r]``, reaches that far back."""
    order = np.concatenate(shards)
    last = order[symbols[order] < 0]  # suffixes without a symbol come first and differ from all others
    border = np.zeros(len(order), dtype=bool)
    border[:1] = True
    common = np.zeros(len(order), dtype=np.int64)
    for _ in range(rounds):
        block = np.cumsum(border)
        has = order - SYMBOL >= starts[order]
        before = order[has] - SYMBOL
        transform = symbols[before]
        place = np.argsort(transform, kind="stable")
        symbol, block = transform[place], block[has][place]
        order = np.concatenate([last, before[place]])
        differs = np.ones(len(place), dtype=bool)
        differs[1:] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        border = np.concatenate([np.ones(len(last), dtype=bool), differs])
        common += ~border
    return order, common


def repeated_windows(contexts: list[bytes], single: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``context, window`` of the windows of single contexts that occur again in a context (or
    in one that stands for several copies), in order."""
    sizes = np.array([len(c) + 1 for c in contexts])  # a place after each for its empty suffix
    data = np.frombuffer(b"\0".join([*contexts, b""]), dtype=np.uint8)
    which = np.repeat(np.arange(len(contexts)), sizes)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    rows, start, stop = np.arange(len(data)), bounds[which], bounds[which + 1] - 1
    full = np.flatnonzero(rows + SYMBOL <= stop)
    symbols = np.full(len(data), -1, dtype=np.int64)
    symbols[full] = np.unique(Sums(data).all(SYMBOL)[full], return_inverse=True)[1]
    cuts = bounds[[*range(0, len(contexts), SHARD), len(contexts)]]
    shards = [shard_order(symbols, stop, rows[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    order, common = merge(symbols, start, shards, length // SYMBOL)
    interval = np.cumsum(common < length // SYMBOL) - 1
    is_window = order - start[order] < n[which[order]]
    alone = single[which[order]]
    weight = np.bincount(interval, np.where(is_window, np.where(alone, 1, 2), 0))
    found = np.sort(order[is_window & alone & (weight[interval] >= 2)])
    return which[found], found - start[found]


def _merge_groups(length: int):
    """Open windows that repeat, from contexts sorted by their key: blocks of whole groups are merged."""
    def spans(rows: pa.Table) -> pa.RecordBatch:
        single = rows["single"].to_numpy()
        context, window = repeated_windows(rows["bytes"].to_pylist(), single, rows["n"].to_numpy(), length)
        first = np.flatnonzero((np.diff(context, prepend=-1) != 0) | (np.diff(window, prepend=-2) != 1))
        n = np.diff(np.append(first, len(window))).astype(np.int32)
        lo = rows["lo"].to_numpy()[context[first]] + window[first]
        return pa.RecordBatch.from_arrays([rows["t"].combine_chunks().take(pa.array(context[first])),
                                           pa.array(lo, pa.int64()), pa.array(n)], names=["t", "lo", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            key = batch.column("key").to_numpy()
            before = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("bytes")).to_numpy())])
            borders = np.flatnonzero(np.append(last != key[0], key[1:] != key[:-1])) if len(key) else key
            at = 0
            while len(cut := borders[(borders >= at) & (size + before[borders] - before[at] >= MERGED)]):
                held.append(batch.slice(at, cut[0] - at))
                yield spans(pa.Table.from_batches(held))
                held, size, at = [], 0, cut[0]
            held.append(batch.slice(at))
            size += before[-1] - before[at]
            last = key[-1] if len(key) else last
        if size:
            yield spans(pa.Table.from_batches(held))
    return run


def _window_hashes(length: int):
    """``key, window, t, lo, weight`` of every window of the contexts of large groups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column("n").to_numpy()
            hashes = [Sums(np.frombuffer(c.as_py(), dtype=np.uint8)).all(length).view(np.int64) for c in batch.column("bytes")]
            which = pa.array(np.repeat(np.arange(len(n)), n))
            within = np.concatenate([np.arange(m) for m in n] or [n])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(which), pa.array(np.concatenate(hashes or [n])), batch.column("t").take(which),
                 pa.array(batch.column("lo").to_numpy()[which.to_numpy()] + within, pa.int64()),
                 pa.array(np.where(batch.column("single").to_numpy(zero_copy_only=False)[which.to_numpy()], 1, 2), pa.int32())],
                names=["key", "window", "t", "lo", "weight"])
    return run


def _finish(length: int, with_kept: bool):
    """Texts that had open windows, with all spans known."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, lo, n, more in zip(*(batch.column(c) for c in ("text", "lo", "n", "more"))):
                parts = [(lo.values, n.values)] + ([(more.values.field("lo"), more.values.field("n"))] if more.is_valid else [])
                both = [np.concatenate([np.asarray(p[i], dtype=np.int64) for p in parts]) for i in (0, 1)]
                out.append(_removal(text.as_py(), *both, length))
            yield _removed(batch.column("t"), out, with_kept)
    return run


def _removed(t: pa.Array, out: list[tuple], with_kept: bool) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary())[:3 + with_kept]
    return pa.RecordBatch.from_arrays([t, *[pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)]],
                                      names=["t", "n_removed", "n_spans", "kept_sha256", "kept"][:4 + with_kept])


def repeats(docs: DataFrame, length: int = LENGTH, with_kept: bool = False) -> DataFrame:
    """``t, n_removed, n_spans, kept_sha256[, kept]`` of each distinct text that loses bytes or
    shares an anchor group; ``t`` is the text's 128-bit digest."""
    texts = docs.where(F.octet_length("text") >= length).select(F.unhex(F.md5("text")).alias("t"), "text")
    # written, so that the join below reads both sides from shuffles of their own and splits a frequent key
    keys = materialise(arrow_map(texts.select("text"), _anchor_rows(length, False), "key long, context long")
                       .groupBy("key").agg(F.count("*").alias("c"), (F.min("context") == F.max("context")).alias("same"))
                       .where(F.col("c") > 1).select("key", "same"), "repeated-keys")
    found = materialise(arrow_map(texts, _anchor_rows(length, True), "key long, context long, t binary, lo long, n int")
                        .join(keys, "key"), "repeated-anchors")

    opened = found.where(~F.col("same")).drop("same")
    owners = opened.groupBy("key", "context").agg(F.count("*").alias("copies"), F.min(F.struct("t", "lo")).alias("owner"))
    large = owners.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > GROUP_MOST).select("key", F.lit(True).alias("hot"))
    contexts = materialise(owners.join(large, "key", "left").select(
        "key", "context", (F.col("copies") > 1).alias("decided"), F.coalesce("hot", F.lit(False)).alias("hot"), "owner"), "contexts")
    sent = F.struct("t", "lo") == F.col("owner")
    parts = found.where("same").select("t", "lo", "n", F.lit(True).alias("decided"), F.lit(False).alias("sent"),
                                       F.lit(None).cast("long").alias("key"), F.lit(False).alias("hot")).unionByName(
        opened.join(contexts, ["key", "context"]).select(
            "t", "lo", "n", "decided", sent.alias("sent"), F.when(sent, F.col("key")).alias("key"), "hot"))
    per_text = parts.groupBy("t").agg(F.collect_set(F.struct("lo", "n", "decided", "sent", "key", "hot")).alias("found"))
    each = "key long, single boolean, hot boolean, lo long, n int, bytes binary"
    cut = materialise(arrow_map(
        texts.dropDuplicates(["t"]).join(per_text, "t"), _cut_texts(length, with_kept),
        "t binary, n_removed long, n_spans long, kept_sha256 string, kept binary, text binary, lo array<long>, n array<int>, "
        f"contexts array<struct<{each.replace(' ', ':').replace(',:', ',')}>>"), "cut-texts")

    strings = cut.select("t", F.explode("contexts").alias("c")).select("t", "c.*")
    merged = arrow_map(strings.where("not hot").repartition("key").sortWithinPartitions("key"), _merge_groups(length),
                       "t binary, lo long, n int")
    windows = arrow_map(strings.where("hot"), _window_hashes(length), "key long, window long, t binary, lo long, weight int")
    again = materialise(windows.groupBy("key", "window").agg(F.sum("weight").alias("w")).where(F.col("w") > 1).drop("w"),
                        "repeated-windows")
    split = windows.where("weight = 1").join(again, ["key", "window"]).select("t", "lo", F.lit(1).alias("n"))
    more = merged.unionByName(split).groupBy("t").agg(F.collect_list(F.struct("lo", "n")).alias("more"))
    columns = ["t", "n_removed", "n_spans", "kept_sha256", "kept"][:4 + with_kept]
    rest = arrow_map(cut.where(F.col("text").isNotNull()).select("t", "text", "lo", "n").join(more, "t", "left"),
                     _finish(length, with_kept),
                     "t binary, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept)
    return cut.where(F.col("text").isNull()).select(*columns).unionByName(rest)


def remove_repeats(docs: DataFrame, length: int = LENGTH, with_kept: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]`` per row of ``docs``; ``kept`` holds
    the remaining bytes (a cut may fall inside a character)."""
    if length % SYMBOL or length < 2 * GRAM:
        raise ValueError(f"length must be a multiple of {SYMBOL} and at least {2 * GRAM}")
    text = F.coalesce("text", F.lit(""))
    own = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.unhex(F.md5("text")).alias("t"),
                      F.sha2(text.cast("binary"), 256).alias("whole"), *([text.cast("binary").alias("all")] if with_kept else []))
    none = F.lit(0).cast("long")
    return own.join(repeats(docs, length, with_kept), "t", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        *([F.coalesce("kept", "all").alias("kept")] if with_kept else []))
