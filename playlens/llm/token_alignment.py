"""Alignment of two tokenizers over a corpus, with an identity map as the fast path.

A text is encoded by a byte-level BPE vocabulary (A) and by a piece vocabulary (B). Byte
offsets at which tokens of both end cut the tokens into groups; tokens of A and B whose byte
ranges overlap are linked, and a pair of ids counts in how many documents it is linked.

* Once per worker an array gives for each A id the B id of the same bytes. Pairs of this
  identity map, which the exact one-to-one groups consist of, are counted in one vector of
  the length of A's vocabulary per task; the vectors are added up. No pair is shuffled.
* All other pairs come from irregular groups (and from equal bytes under another B id).
  They alone enter the pair shuffle: counted per pair by an aggregate with a map-side part.
* What a document needs back is looked up by blocks of documents: the distinct irregular
  pairs of a block are joined with the pair counts, so a pair that a third of all documents
  hold costs one row per block, not one per document, and the join splits it when it is skewed.
  The identity counts and each A id's highest count are vectors of the vocabulary's length.

Links need no search: between two neighbouring ends of any token lies exactly one
overlap of an A and a B token, so the links of a text are its distinct token ends.

Defined results: the contract of the query defines null and empty texts and texts that either
tokenizer does not give back byte by byte: zeros and an empty digest, and they count
nowhere. Rows are documents of their own, also when they repeat an id or a text.
Strings of special tokens are plain text. Further columns do not matter.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from playlens.llm.common import arrow_map, materialise, small_batches

#: Characters of text in a block (a longer text is a block of its own). A worker takes some 100 bytes for each,
#: the JVM several copies of the block's row of about 4 bytes for each.
BLOCK = 1 << 18
#: Blocks in a row group: Spark reads a row group's lists as a whole, up to 4,096 rows.
GROUP = 8
#: Rows and bytes at most handed to a Python worker at a time (Spark's 10,000 and 256 MB are held by the JVM and by the
#: worker). A session's smaller numbers stay.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 250, "spark.sql.execution.arrow.maxBytesPerBatch": 1 << 20}
#: Pre-tokenization that the byte-level format names (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARK = "▁"


def byte_level_alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level format: printable Latin-1 characters stand for
    themselves, the other bytes for the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the identity map."""

    def __init__(self, bpe_file: str, piece_file: str):
        with open(bpe_file, encoding="utf-8") as f:
            spec = json.load(f)
        kind, model = spec["pre_tokenizer"], spec["model"]
        if spec["normalizer"] or kind["type"] != "ByteLevel" or not kind["use_regex"] or kind["add_prefix_space"]:
            raise ValueError("expected a plain byte-level vocabulary")
        alphabet = byte_level_alphabet()
        special = {t["content"] for t in spec["added_tokens"]}
        ids = {bytes(map(alphabet.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}
        merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if merged != sorted(merged):  # ids in the order of the merges can serve as their ranks
            raise ValueError("ids do not follow the merges")
        self.bpe = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={})
        self.pieces = p = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        n_a, n_b = 1 + max(ids.values()), p.get_piece_size()
        bytes_a = [b""] * n_a
        for token, i in ids.items():
            bytes_a[i] = token
        bytes_b = [bytes([int(p.id_to_piece(i)[1:-1], 16)]) if p.is_byte(i)
                   else p.id_to_piece(i).replace(MARK, " ").encode() for i in range(n_b)]
        self.bytes_a, self.bytes_b = bytes_a, bytes_b
        self.len_a = np.array([len(t) for t in bytes_a])
        self.len_b = np.array([len(t) for t in bytes_b])
        same = {t: i for i, t in reversed(list(enumerate(bytes_b))) if not (p.is_control(i) or p.is_unknown(i))}
        #: A id -> the smallest B id with the same bytes, or -1.
        self.identity = np.array([same.get(t, -1) if t else -1 for t in bytes_a])
        # each id's numeral and what follows it: another of its group, or the group's next part
        self.inner_a, self.last_a = (np.array([f"{i}{c}" for i in range(n_a)], dtype=object) for c in ",|")
        self.inner_b, self.last_b = (np.array([f"{i}{c}" for i in range(n_b)], dtype=object) for c in ",;")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``usable, A ids, A tokens per text, B ids, B tokens per text`` (of the usable texts)."""
        a = [self.bpe.encode_ordinary(" " + t) if t else [] for t in texts]
        b = self.pieces.encode(texts, num_threads=1)
        raw = [(" " + t).encode() for t in texts]
        ok = np.array([bool(t) and b"".join(map(self.bytes_a.__getitem__, x)) == r
                       and b"".join(map(self.bytes_b.__getitem__, y)) == r
                       for t, x, y, r in zip(texts, a, b, raw, strict=True)], dtype=bool)
        a, b = ([x for x, keep in zip(ids, ok) if keep] for ids in (a, b))
        n_a, n_b = (np.array([len(x) for x in ids], dtype=np.int64) for ids in (a, b))
        flat = (np.fromiter(chain.from_iterable(ids), np.int64, n.sum()) for ids, n in ((a, n_a), (b, n_b)))
        return ok, next(flat), n_a, next(flat), n_b


class Aligned:
    """Groups and links of the usable texts of a batch, put one after another."""

    def __init__(self, v: Vocabularies, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray):
        self.v, self.a, self.b, self.n_a, self.n_b = v, a, b, n_a, n_b
        self.end_a, self.end_b = np.cumsum(v.len_a[a]), np.cumsum(v.len_b[b])
        over_a = np.searchsorted(self.end_b, self.end_a)  # B token that holds the end of each A token
        over_b = np.searchsorted(self.end_a, self.end_b)
        cut_a, cut_b = self.end_b[over_a] == self.end_a, self.end_a[over_b] == self.end_b
        self.group_a, self.group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b  # group of each token
        self.doc_a, doc_b = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
        more = np.flatnonzero(~cut_b)
        self.link_doc = np.concatenate([self.doc_a, doc_b[more]])
        self.link_a = np.concatenate([a, a[over_b[more]]])
        self.link_b = np.concatenate([b[over_a], b[more]])

    def groups(self) -> tuple[np.ndarray, list[str]]:
        """Number of groups and digest of the groups of each text."""
        v, n = self.v, len(self.n_a)
        if not n:
            return np.zeros(0, np.int64), []
        last_a = np.diff(self.group_a, append=-1) != 0
        last_b = np.diff(self.group_b, append=-1) != 0
        n_groups = np.bincount(self.doc_a[last_a], minlength=n)
        before_a = np.cumsum(np.bincount(self.group_b))  # tokens of B up to each group's end
        before_b = np.cumsum(np.bincount(self.group_a))
        parts = np.empty(len(self.a) + len(self.b), dtype=object)
        place_a = np.arange(len(self.a)) + np.concatenate([[0], before_a])[self.group_a]
        place_b = np.arange(len(self.b)) + before_b[self.group_b]
        parts[place_a] = np.where(last_a, v.last_a[self.a], v.inner_a[self.a])
        parts[place_b] = np.where(last_b, v.last_b[self.b], v.inner_b[self.b])
        cuts = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).tolist()
        parts = parts.tolist()
        return n_groups, [hashlib.sha256("".join(parts[i:j])[:-1].encode()).hexdigest()
                          for i, j in zip(cuts[:-1], cuts[1:], strict=True)]

    def pairs(self) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Identity and other pairs: ``text, A id or pair, links`` for each distinct one of a text."""
        same = self.v.identity[self.link_a] == self.link_b
        out = []
        for which, key in ((same, self.link_a), (~same, self.link_a * len(self.v.len_b) + self.link_b)):
            span = len(self.v.len_a) * len(self.v.len_b)
            both, n = np.unique(self.link_doc[which] * span + key[which], return_counts=True)
            out.append((both // span, both % span, n))
        return out[0], out[1]


_LOADED: dict[tuple[str, str], Vocabularies] = {}


def vocabularies(bpe_name: str, piece_name: str) -> Vocabularies:
    """The worker's tokenizers from shipped files, kept while the worker lives."""
    key = (bpe_name, piece_name)
    if key not in _LOADED:
        _LOADED[key] = Vocabularies(*map(SparkFiles.get, key))
    return _LOADED[key]


FIGURES = ("n_a", "n_b", "n_groups", "n_links")
#: Columns of a block: its documents' figures; ``text, A id, links`` of identity pairs; ``text,
#: place in pairs, links`` of the others; the block's distinct other pairs and their documents.
_ARRAYS = ("id_doc", "id_a", "id_n", "odd_doc", "odd_at", "odd_n", "pairs", "pair_docs")


def _text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of consecutive documents of at most ``BLOCK`` characters, or one longer text."""
    ids, texts, size = [], [], 0
    for doc, text in ((d, t) for batch in batches for d, t in zip(*(batch.column(c) for c in ("doc_id", "text")))):
        value = text.as_py() or ""
        if texts and size + len(value) > BLOCK:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(doc.as_py())
        texts.append(value)
        size += len(value)
    if texts:
        yield ids, texts


def _encode(bpe_name: str, piece_name: str, id_kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(bpe_name, piece_name)
        task = TaskContext.get().partitionId() << 32
        for number, (ids, texts) in enumerate(_text_blocks(batches)):
            ok, a, n_a, b, n_b = v.encode(texts)
            aligned = Aligned(v, a, n_a, b, n_b)
            n_groups, digests = aligned.groups()
            (id_doc, id_a, id_n), (odd_doc, odd, odd_n) = aligned.pairs()
            pairs, odd_at = np.unique(odd, return_inverse=True)
            docs = np.flatnonzero(ok)
            n_links = np.bincount(aligned.link_doc, minlength=len(docs))
            figures = np.zeros((4, len(texts)), dtype=np.int64)
            figures[:, docs] = n_a, n_b, n_groups, n_links
            digest = np.full(len(texts), "", dtype=object)
            digest[docs] = digests
            values = [docs[id_doc], id_a, id_n, docs[odd_doc], odd_at, odd_n, pairs, np.bincount(odd_at, minlength=len(pairs))]
            kinds = [pa.int32()] * 6 + [pa.int64(), pa.int32()]
            one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind))
            yield pa.RecordBatch.from_arrays(
                [pa.array([task + number]), one(ids, id_kind), one(digest, pa.string()),
                 *[one(f, pa.int64()) for f in figures], *[one(x, k) for x, k in zip(values, kinds, strict=True)]],
                names=["block", "doc_id", "groups_sha256", *FIGURES, *_ARRAYS])
    return run


def _identity_counts(n_a: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_a, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(batch.column("id_a").flatten().to_numpy(), minlength=n_a)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["a", "n"])
    return run


def _vector(rows: DataFrame, size: int) -> np.ndarray:
    """``a, n`` with distinct ``a`` below ``size`` as an array."""
    got, out = rows.toArrow(), np.zeros(size, dtype=np.int64)
    out[got["a"].to_numpy()] = got["n"].to_numpy()
    return out


def _score(identity, best, n_b: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, most = identity.value, best.value
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i].values for c in batch.schema.names if c != "block"}
                get = lambda c: row[c].to_numpy(zero_copy_only=False).astype(np.int64)
                docs = len(row["doc_id"])
                total, n_best = np.zeros(docs, dtype=np.int64), np.zeros(docs, dtype=np.int64)
                pairs = get("pairs")
                counts = np.zeros(len(pairs), dtype=np.int64)
                if row["found"] is not None and len(row["found"]):
                    counts[np.searchsorted(pairs, row["found"].field("pair").to_numpy())] = row["found"].field("n").to_numpy()
                odd = get("odd_at")
                for doc, a, n, count in ((get("id_doc"), get("id_a"), get("id_n"), own[get("id_a")]),
                                         (get("odd_doc"), pairs[odd] // n_b, get("odd_n"), counts[odd])):
                    np.add.at(total, doc, n * count)
                    np.add.at(n_best, doc, np.where(count == most[a], n, 0))
                yield pa.RecordBatch.from_arrays(
                    [row["doc_id"], *[row[c] for c in FIGURES], pa.array(n_best), pa.array(total), row["groups_sha256"]],
                    names=["doc_id", *FIGURES, "n_best", "count_sum", "groups_sha256"])
    return run


def align(docs: DataFrame, bpe_path: str, piece_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row of ``docs``."""
    blocks, identity, counts, n_a, n_b = counted(docs, bpe_path, piece_path)
    spark = docs.sparkSession
    odd_best = counts.groupBy(F.expr(f"pair div {n_b}").alias("a")).agg(F.max("n").alias("n"))
    best = np.maximum(identity, _vector(odd_best, n_a))  # a number for each A id
    found = (blocks.select("block", F.explode("pairs").alias("pair")).join(counts, "pair")
             .groupBy("block").agg(F.collect_list(F.struct("pair", "n")).alias("found")))  # a block's distinct pairs
    rows = blocks.join(found, "block", "left").drop("pair_docs")
    shared = [spark.sparkContext.broadcast(x) for x in (identity, best)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows, _score(*shared, n_b), f"doc_id {kind}, " + ", ".join(f"{c} long" for c in FIGURES)
                     + ", n_best long, count_sum long, groups_sha256 string")


def counted(docs: DataFrame, bpe_path: str, piece_path: str) -> tuple[DataFrame, np.ndarray, DataFrame, int, int]:
    """Encoded blocks, documents of each A id's identity pair, and ``pair, n`` of the other
    pairs, where ``pair`` is ``A id * (B's number of ids) + B id``; both numbers of ids."""
    sc = docs.sparkSession.sparkContext
    for path in (bpe_path, piece_path):
        sc.addFile(path)
    v = Vocabularies(bpe_path, piece_path)
    n_a, n_b = len(v.len_a), len(v.len_b)
    kind = docs.schema["doc_id"].dataType
    schema = (f"block long, doc_id array<{kind.simpleString()}>, groups_sha256 array<string>, "
              + ", ".join(f"{c} array<long>" for c in FIGURES) + ", "
              + ", ".join(f"{c} array<{'long' if c == 'pairs' else 'int'}>" for c in _ARRAYS))
    run = _encode(bpe_path.rsplit("/", 1)[-1], piece_path.rsplit("/", 1)[-1], to_arrow_type(kind))
    small_batches(docs.sparkSession, BATCH)
    blocks = materialise(arrow_map(docs.select("doc_id", "text"), run, schema), "aligned", rows_in_group=GROUP)
    identity = _vector(arrow_map(blocks.select("id_a"), _identity_counts(n_a), "a long, n long")
                       .groupBy("a").agg(F.sum("n").alias("n")), n_a)
    counts = materialise(blocks.select(F.explode(F.arrays_zip("pairs", "pair_docs")).alias("p"))
                         .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pair_docs").alias("n")), "pair-counts")
    return blocks, identity, counts, n_a, n_b


def pair_counts(docs: DataFrame, bpe_path: str, piece_path: str) -> DataFrame:
    """``a_id, b_id, n_docs``: in how many documents the two ids are linked, for all linked pairs."""
    _, identity, counts, _, n_b = counted(docs, bpe_path, piece_path)
    same = Vocabularies(bpe_path, piece_path).identity
    held = np.flatnonzero(identity)
    rows = docs.sparkSession.createDataFrame(list(zip(held.tolist(), same[held].tolist(), identity[held].tolist())),
                                             "a_id long, b_id long, n_docs long")
    return rows.unionByName(counts.select(F.expr(f"pair div {n_b}").alias("a_id"), (F.col("pair") % n_b).alias("b_id"),
                                          F.col("n").alias("n_docs")))
