"""SentencePiece encoding through a table of distinct marked words.

No piece of the vocabulary has a whitespace marker after another character, so
a merge never crosses the start of a marker run; nor has any piece a newline, which
is encoded as a byte. A text (spaces turned into markers, one marker put before it)
is therefore cut into chunks, each a run of markers or newlines and the characters
up to the next run. Each distinct chunk is
segmented once by the library, kept with its ids and its decoded text in a table, and the
table's entries are joined back by the chunks' positions in the text.

Every worker keeps its own table. When it holds ``TABLE_CHUNKS`` entries no more
are added, so its memory is bounded however many distinct words there are, and
further words are segmented once per batch of texts. Nothing is shuffled. See README for why the table is not shared by all tasks.

Defined results: null text counts as empty; empty text has no ids and decodes to
the empty text. A text without any space is one chunk. Rows are encoded one by
one, so repeated rows get equal results; further columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from playlens.llm.common import arrow_map

MARK = "▁"
TABLE_CHUNKS = 100_000
#: Longer chunks are segmented where they stand and not kept in the table.
TABLE_CHARS = 64
_CHUNK = re.compile(f"(?:{MARK}+|\n+)[^{MARK}\n]*")
_EMPTY = re.compile(f"{MARK}+|\n+")


def marked_chunks(text: str) -> list[str]:
    """Chunks of the text, in order; each starts with a run of markers or of newlines."""
    return _CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []


def crossing_pieces(processor: sentencepiece.SentencePieceProcessor) -> list[str]:
    """Pieces with a marker after another character or a newline beside another
    character (none: chunks are independent)."""
    pieces = map(processor.id_to_piece, range(processor.get_piece_size()))
    return [p for p in pieces if re.search(f"[^{MARK}]{MARK}|\n", p)]


class ChunkTable:
    """Distinct chunk -> (number of ids, ids as text, decoded text with its leading blank)."""

    def __init__(self, model: bytes, most: int = TABLE_CHUNKS):
        self.processor = p = sentencepiece.SentencePieceProcessor(model_proto=model)
        if found := crossing_pieces(p):
            raise ValueError(f"pieces cross whitespace markers: {found[:3]}")
        pieces = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        self.starts = np.array([x.startswith(MARK) for x in pieces])
        self.ends = np.array([x.endswith(MARK) for x in pieces])
        # pieces whose text is not themselves: bytes, unknown, control
        self.special = np.array([p.is_byte(i) or p.is_unknown(i) or p.is_control(i) for i in range(len(pieces))])
        self.texts = [x.replace(MARK, " ") for x in pieces]
        self.newline = p.piece_to_id("<0x0A>")
        self.numerals = [str(i) for i in range(len(pieces))]
        self.most, self.rows = most, {}

    def segment(self, chunks: list[str]) -> dict[str, tuple[int, str, str]]:
        """Table rows of distinct chunks. The chunks are put one after another,
        segmented in one call and cut where a marker or a newline follows another
        character. Chunks of markers or newlines alone would run into the next one
        and are segmented by themselves."""
        p = self.processor
        blank = [c for c in chunks if _EMPTY.fullmatch(c)]
        # encode() puts one marker before a text; it goes to a first word that is dropped
        rest = ["a", *(c for c in chunks if not _EMPTY.fullmatch(c))]
        ids = p.encode("".join(rest).replace(MARK, " "))
        a = np.array(ids, dtype=np.int64)
        line = a == self.newline
        cuts = np.flatnonzero((self.starts[a[1:]] & ~self.ends[a[:-1]]) | (line[1:] & ~line[:-1])) + 1
        first = [0, *cuts.tolist(), len(ids)]
        special = np.concatenate([[0], np.cumsum(self.special[a])])[first]
        plain = (special[1:] == special[:-1]).tolist()
        numerals, texts = [self.numerals[i] for i in ids], [self.texts[i] for i in ids]
        rows = {}
        for c, i, j, ok in zip(rest, first[:-1], first[1:], plain, strict=True):
            if not ok:  # decode() takes one blank away from the start
                text = p.decode(ids[i:j])
                text = text if ids[i] == self.newline else " " + text
            else:
                text = "".join(texts[i:j])
            rows[c] = (j - i, ",".join(numerals[i:j]), text)
        for c in blank:
            own = ([self.newline] * len(c) if c[0] == "\n" else
                   p.encode(c[1:].replace(MARK, " ")) if len(c) > 1 else [p.piece_to_id(MARK)])
            rows[c] = (len(own), ",".join(map(str, own)), c.replace(MARK, " "))
        rows.pop("a")
        return rows

    def look_up(self, texts: list[list[str]]) -> list[list[tuple[int, str, str]]]:
        """Rows of the chunks of each text, in order. Chunks missing in the table
        are segmented together, each once, and added while there is room."""
        rows = self.rows
        new = list({c for chunks in texts for c in chunks if c not in rows})
        own = self.segment(new) if new else {}
        if len(rows) + len(own) <= self.most:
            rows.update((c, v) for c, v in own.items() if len(c) <= TABLE_CHARS)
        return [[rows[c] if c in rows else own[c] for c in chunks] for chunks in texts]


_TABLES: dict[str, ChunkTable] = {}


def table_of(name: str) -> ChunkTable:
    """The worker's table for a shipped model file, kept while the worker lives."""
    if name not in _TABLES:
        with open(SparkFiles.get(name), "rb") as f:
            _TABLES[name] = ChunkTable(f.read())
    return _TABLES[name]


def encode(docs: DataFrame, model_path: str, with_ids: bool = True, with_decoded: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]`` per document.

    The model file is shipped to the executors by Spark."""
    docs.sparkSession.sparkContext.addFile(model_path)
    name = model_path.rsplit("/", 1)[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of(name)
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                texts = [marked_chunks(t.as_py() or "") for t in part.column("text")]
                out: dict[str, list] = {k: [] for k in ("n", "ids_sha", "dec_sha", "ids", "decoded")}
                for rows in table.look_up(texts):
                    ids, decoded = ",".join([r[1] for r in rows]), "".join([r[2] for r in rows])[1:]
                    out["n"].append(sum(r[0] for r in rows))
                    out["ids_sha"].append(hashlib.sha256(ids.encode()).hexdigest())
                    out["dec_sha"].append(hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
                    if with_ids:
                        out["ids"].append(np.fromstring(ids, dtype=np.int32, sep=",") if ids else [])
                    if with_decoded:
                        out["decoded"].append(decoded)
                cols = [part.column("doc_id"), pa.array(out["n"], pa.int64()),
                        pa.array(out["ids_sha"], pa.string()), pa.array(out["dec_sha"], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols.append(pa.array(out["ids"], pa.list_(pa.int32())))
                    names.append("ids")
                if with_decoded:
                    cols.append(pa.array(out["decoded"], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_map(
        docs.select("doc_id", "text"), run, schema + ", ids array<int>" * with_ids + ", decoded string" * with_decoded)
