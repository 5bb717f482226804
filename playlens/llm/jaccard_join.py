"""Jaccard join of word shingle sets, and its classes: a size-aware heavy-light join.

Two texts link when ``100 * intersection >= percent * union`` of their sets of
distinct shingles. For sizes n and m that means an overlap of ``o(n, m)`` shingles or more.

* Texts with equal sets become one node (by a 128-bit digest of the set), so groups
  of copies, however large, cost one row each.
* Light sets (at most ``x`` shingles) list all their subsets of the sizes
  ``o(n, m)``. Two light sets link exactly when they share a subset large enough; in
  each subset's group all sets that link with any link with the smallest.
* Heavy sets are found by scanning inverted lists of their rarest shingles: of n, the
  first ``n - ceil(percent n / 100) + 1`` in order of frequency must hold a common one.
  The order needs no exact counts, only to be the same everywhere: a table of
  ``2**20`` counters over all texts gives it.
* ``x`` is chosen by cost over the corpus's size histogram: the subsets to list
  against the postings to scan and verify.

No list is turned into all its pairs. First each node is verified against one hub,
the member of its lists that shares most (the original among copies that differ
from each other). Lists whose members are then all connected are done. In the rest,
pairs of different components that can still reach the overlap from their positions in the
list are verified. The classes are those of the complete join: a link
inside a component changes nothing, and no other candidate is left out.

Candidates are first compared by a parity bitmap of their sets (``BITS`` bits, each
the parity of the shingles falling on it): the bits that differ are at most the shingles
that differ, so a pair with more of them than linked sets may have is dropped for
certain. Verification recomputes the sets of the other nodes from their texts.

Defined results: null text, empty text and text without words have the empty set,
which links with nothing; fewer words than a shingle form one shingle of their own
kind; repeated rows are copies; a null id belongs to the class of its text but is
never the class id; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm import word_hashes
from playlens.llm.common import arrow_map, build_bitmap, free_name, in_bitmap, materialise
from playlens.llm.components import components

PERCENT, WIDTH = 85, 4
#: Counters of the frequency order, and of those sent in one row.
COUNTERS, SLICE = 1 << 20, 1 << 14
#: Bits of a set's parity bitmap.
BITS = 2048
#: Largest size whose subsets are ever listed.
LIGHT_MOST = 24


def needed(n: int, m: int, percent: int) -> int:
    """Least overlap of linked sets of sizes n and m."""
    return -(-percent * (n + m) // (100 + percent))


def subset_sizes(n: int, percent: int) -> list[int]:
    """Subset sizes that link a set of n with any size of partner."""
    partners = range(-(-percent * n // 100), 100 * n // percent + 1)
    return sorted({o for m in partners if (o := needed(n, m, percent)) <= min(n, m)})


def prefix_length(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def light_bound(sizes: np.ndarray, percent: int) -> int:
    """The bound x with the least cost: subsets listed for sizes up to x, postings
    scanned and sets of n verified for the sizes above. ``sizes[n]`` texts have n."""
    light = [int(sizes[n]) * sum(comb(n, o) for o in subset_sizes(n, percent)) for n in range(1, LIGHT_MOST + 1)]
    heavy = [int(sizes[n]) * prefix_length(n, percent) * n for n in range(1, LIGHT_MOST + 1)]
    cost = [sum(light[:x]) + sum(heavy[x:]) for x in range(LIGHT_MOST + 1)]
    return int(np.argmin(cost))


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for first, stop, words, rows in word_hashes.hashed_words(texts, word_hashes.blank_table()):
        cut = np.searchsorted(rows, np.arange(stop - first + 1))
        for i in range(stop - first):
            own = words[cut[i]:cut[i + 1]]
            yield np.unique(word_hashes.shingle_hashes(own, min(width, max(1, len(own)))))


def _count(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.uint32)
        sizes = np.zeros(LIGHT_MOST + 1, dtype=np.uint32)
        for batch in batches:
            for s in shingle_sets(batch.column("text"), width):
                np.add.at(counts, (s & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
                if len(s) <= LIGHT_MOST:
                    sizes[len(s)] += 1
        parts = [*counts.reshape(-1, SLICE), sizes]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()),
                                          pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "counts"])
    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the counters of equal parts, batch by batch."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts")):
            c = np.frombuffer(counts.as_buffer(), dtype=np.uint32)
            total[part] = total[part] + c if part in total else c.astype(np.uint64)
    out = [(k, np.minimum(v, 0xFFFFFFFF).astype(np.uint32).tobytes()) for k, v in total.items()]
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int32()),
                                      pa.array([v for _, v in out], pa.binary())], names=["part", "counts"])


def frequency_order(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Counters of shingles by hash, and how many texts have 0 .. LIGHT_MOST shingles."""
    schema = "part int, counts binary"
    parts = arrow_map(texts, _count(width), schema).repartition("part")
    rows = arrow_map(parts, _add, schema).collect()
    parts = {r["part"]: np.frombuffer(bytes(r["counts"]), dtype=np.uint32) for r in rows}
    empty = np.zeros(SLICE, dtype=np.uint32)
    counts = np.concatenate([parts.get(i, empty) for i in range(COUNTERS // SLICE)])
    return counts, parts.get(COUNTERS // SLICE, np.zeros(LIGHT_MOST + 1, dtype=np.uint32))


def subsets(s: np.ndarray, percent: int) -> tuple[list[int], list[int]]:
    """Hash and size of each listed subset of a light set."""
    each = word_hashes.mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).tolist()
    total, hashes, sizes = sum(each), [], []
    for o in subset_sizes(len(s), percent):
        for gone in combinations(range(len(s)), len(s) - o):
            hashes.append((total - sum(each[i] for i in gone) + o) % (1 << 64))
            sizes.append(o)
    return word_hashes.mix(np.array(hashes, dtype=np.uint64)).view(np.int64).tolist(), sizes


def parity(s: np.ndarray) -> np.ndarray:
    """Parity bitmap of a set as 64-bit words."""
    at = (s >> np.uint64(64 - (BITS.bit_length() - 1))).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=BITS) & 1).astype(np.uint8)).view(np.int64)


def signatures(texts: DataFrame, counts: np.ndarray, bound: int, width: int, percent: int) -> DataFrame:
    """Per row: ``doc_id, copy, n, digest, parity``, the light subsets, and the rarest shingles in order."""
    shared = texts.sparkSession.sparkContext.broadcast(counts)  # COUNTERS numbers, however large the corpus
    least_heavy = -(-percent * (bound + 1) // 100)  # smaller sets meet no heavy one

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for whole in batches:
            for batch in (whole.slice(i, 1024) for i in range(0, whole.num_rows, 1024)):
                n, digest, hashes, sizes, prefix, bits = [], [], [], [], [], []
                for s in shingle_sets(batch.column("text"), width):
                    n.append(len(s))
                    digest.append(xxhash.xxh3_128_digest(s.tobytes()))
                    bits.append(parity(s))
                    h, o = subsets(s, percent) if len(s) <= bound else ([], [])
                    hashes.append(h)
                    sizes.append(o)
                    rare: np.ndarray = s[:0]
                    if len(s) >= least_heavy and len(s):
                        order = np.lexsort((s, table[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]))
                        rare = s[order[:prefix_length(len(s), percent)]]
                    prefix.append(rare.view(np.int64))
                ends = np.cumsum([0, *map(len, prefix)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("copy"), pa.array(n, pa.int32()), pa.array(digest, pa.binary()),
                     pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32())),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*prefix, s[:0].view(np.int64)]))),
                     pa.array(bits, pa.list_(pa.int64()))],
                    names=["doc_id", "copy", "n", "digest", "subsets", "subset_sizes", "rare", "parity"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return arrow_map(texts, run, f"doc_id {kind}, copy long, n int, digest binary, subsets array<long>, "
                                 "subset_sizes array<int>, rare array<long>, parity array<long>")


def light_links(nodes: DataFrame, percent: int) -> DataFrame:
    """``a, b``: of each subset's group, the smallest set and those that link with it."""
    listed = nodes.select("node", "n", F.explode(F.arrays_zip("subsets", "subset_sizes")).alias("s")).select(
        "node", "n", F.col("s.subsets").alias("h"), F.col("s.subset_sizes").alias("o"))
    least = (listed.groupBy("h", "o").agg(F.min(F.struct("n", "node")).alias("m"), F.count("*").alias("c"))
             .where(F.col("c") > 1).select("h", "o", F.col("m.n").alias("m_n"), F.col("m.node").alias("m_node")))
    return (listed.join(least, ["h", "o"])
            .where((F.col("node") != F.col("m_node")) & (_needed(F.col("n"), F.col("m_n"), percent) <= F.col("o")))
            .select(F.col("node").alias("a"), F.col("m_node").alias("b")).distinct())


def _needed(n: Column, m: Column, percent: int) -> Column:
    return F.call_function("div", (n + m) * percent + F.lit(99 + percent), F.lit(100 + percent))


def verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of nodes that link, from the sets of their texts.

    Texts are read again instead of keeping all sets. A bitmap of the ids concerned
    (size fixed by their number within ``2**27`` bits) spares the others; what it
    passes too much is dropped by the join on the set's digest."""
    bits_a = nodes.select(F.col("node").alias("a"), F.col("n").alias("n"), F.col("parity").alias("x"))
    bits_b = nodes.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("parity").alias("y"))
    differ = F.aggregate(F.zip_with("x", "y", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, v: s + v)
    may_link = differ <= F.col("n") + F.col("m") - 2 * _needed(F.col("n"), F.col("m"), percent)
    pairs = materialise(pairs.join(bits_a, "a").join(bits_b, "b").where(may_link).select("a", "b"), "pairs")
    ids = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = materialise(ids.join(nodes.select("node", "digest", "rep"), "node"), "wanted")
    count = wanted.count()
    if count == 0:
        return pairs
    log2_bits = min(27, max(16, (16 * count - 1).bit_length()))
    bitmap = build_bitmap(wanted, F.xxhash64("rep"), log2_bits, 2)
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = in_bitmap(shared.value, batch.column("h").to_numpy(zero_copy_only=False).astype(np.int64), 2)
            some = batch.filter(pa.array(keep))
            for part in (some.slice(i, 512) for i in range(0, some.num_rows, 512)):
                sets = [s.view(np.int64) for s in shingle_sets(part.column("text"), width)]
                ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))], names=["digest", "tokens"])

    found = arrow_map(texts.select(F.xxhash64("doc_id").alias("h"), "text"), run, "digest binary, tokens array<long>")
    sets = materialise(found.join(wanted, "digest").dropDuplicates(["digest"]).select("node", "tokens"), "sets")
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    links = 100 * both >= percent * (F.size("x") + F.size("y") - both)
    return pairs.join(left, "a").join(right, "b").where(links).select("a", "b")


def heavy_links(nodes: DataFrame, texts: DataFrame, light: DataFrame, width: int, percent: int) -> DataFrame:
    """``id, root`` of all linked nodes, light links included."""
    postings = nodes.select("node", "n", F.posexplode("rare").alias("at", "token"))
    lists = postings.groupBy("token").agg(F.count("*").alias("c"), F.min("n").alias("least")).where(F.col("c") > 1)
    # A posting helps only where the rest of the set can still reach the overlap with
    # the smallest possible partner of its list.
    partner = F.greatest("least", F.call_function("div", F.col("n") * percent + 99, F.lit(100)))
    live = materialise(postings.join(lists, "token").where(
        F.col("n") - F.col("at") >= _needed(F.col("n"), partner, percent)).drop("least"), "postings")

    share = live.groupBy("node", "n").agg(F.sum("c").alias("shared")).select(
        "node", (F.col("shared") / prefix_length_column(F.col("n"), percent)).alias("share"))
    member = materialise(live.join(share, "node").select("token", "node", "n", "share"), "members")
    hub = member.groupBy("token").agg(F.max(F.struct("share", "node", "n")).alias("hub"))
    near = (member.join(hub, "token")
            .where((F.col("hub.node") != F.col("node")) & _sizes_fit(F.col("n"), F.col("hub.n"), percent))
            .groupBy("node").agg(F.max("hub").alias("hub"))
            .select(F.col("node").alias("a"), F.col("hub.node").alias("b")))
    links = verified(near, nodes, texts, width, percent)
    roots = components(links.union(light))

    rooted = live.join(roots, live["node"] == roots["id"], "left").select(
        "token", "node", "n", "at", F.coalesce("root", "node").alias("root"))
    open_lists = rooted.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    rest = materialise(rooted.join(open_lists.select("token"), "token"), "open-postings")
    other = rest.select("token", *[F.col(c).alias(f"{c}2") for c in ("node", "n", "at", "root")])
    reach = F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2")) >= _needed(F.col("n"), F.col("n2"), percent)
    pairs = (rest.join(other, (rest["token"] == other["token"]) & (F.col("root") < F.col("root2")) & reach
                       & _sizes_fit(F.col("n"), F.col("n2"), percent))
             .select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct())
    more = verified(pairs, nodes, texts, width, percent)
    # components of components: the ends of the further links are replaced by their roots
    root_a, root_b = roots.toDF("a", "ra"), roots.toDF("b", "rb")
    joined = components(more.join(root_a, "a", "left").join(root_b, "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))).toDF("root", "last")
    moved = roots.join(joined, "root", "left").select("id", F.coalesce("last", "root").alias("root"))
    return moved.union(joined.select(F.col("root").alias("id"), F.col("last").alias("root")))


def prefix_length_column(n: Column, percent: int) -> Column:
    return n - F.call_function("div", n * percent + 99, F.lit(100)) + 1


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def classes(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs`` (``doc_id, text``)."""
    return members(docs, percent, width).select("doc_id", "n_shingles", "component_id")


def members(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """``classes`` with ``copy``, the hash of the row's text, and ``class``, the class's own
    number (null for the empty set): class ids are document ids, which may repeat."""
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("copy"))
    counts, sizes = frequency_order(texts.select("text"), width)
    bound = light_bound(sizes, percent)
    rows = materialise(signatures(texts, counts, bound, width, percent), "sets")
    nodes = materialise(
        rows.where(F.col("n") > 0).groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("subsets").alias("subsets"),
            F.first("subset_sizes").alias("subset_sizes"), F.first("rare").alias("rare"),
            F.first("parity").alias("parity"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    roots = heavy_links(nodes, texts, light_links(nodes, percent), width, percent)

    member = roots.join(nodes.select(F.col("node").alias("id"), "rep"), "id").union(
        roots.select(F.col("root").alias("id"), "root").distinct().join(
            nodes.select(F.col("node").alias("id"), "rep"), "id").select("id", "root", "rep")).distinct()
    smallest = member.groupBy("root").agg(F.min("rep").alias("component"))
    class_of = member.join(smallest, "root").select(F.col("id").alias("node"), "component", "root").distinct()
    named = (nodes.select("node", "digest", "rep").join(class_of, "node", "left")
             .select("digest", F.coalesce("component", "rep").alias("component"), F.coalesce("root", "node").alias("class")))
    return (rows.select("doc_id", "copy", "n", "digest").join(named, "digest", "left")
            .select("doc_id", "copy", "class", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id")))


def keep_one(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """One document of each class, the one with the smallest id (of texts under the same
    id, the one with the smallest hash); rows repeating an id and text are one
    document; a row without an id stays where its class has no id, one for the class.
    Rows without an id and without words are in no class and stay."""
    got = materialise(members(docs, percent, width).where(F.col("class").isNotNull())
                      .select("doc_id", "copy", "class"), "classes")
    stays = got.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "copy")).alias("stays"))
    gone = got.join(stays, "class").where(
        ~F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) | (F.col("copy") != F.col("stays.copy"))).select("doc_id", "copy")
    copy, blank = free_name(docs, "copy"), ~F.coalesce("text", F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    gone, rows = gone.distinct().withColumnRenamed("copy", copy), docs.withColumn(copy, F.xxhash64("text"))
    with_id = (rows.where(F.col("doc_id").isNotNull())
               .join(gone.where(F.col("doc_id").isNotNull()), ["doc_id", copy], "left_anti")
               .dropDuplicates(["doc_id", copy]).select(*docs.columns))
    without = (rows.where(F.col("doc_id").isNull() & ~blank).dropDuplicates([copy])
               .join(gone.where(F.col("doc_id").isNull()).select(copy), copy, "left_anti").select(*docs.columns))
    return with_id.unionByName(without).unionByName(docs.where(F.col("doc_id").isNull() & blank))
