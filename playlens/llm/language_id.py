"""Language identification by compression.

For each language a zstandard raw-content dictionary is filled with labelled
text. A document is cut into blocks of its letters, each block is compressed
with every language's dictionary, and the language with the smallest total wins:
a dictionary that holds the text's own syllables leaves the fewest literals.
``score`` is the margin ``(second - best) / second``; a narrow margin is
rejected (``accepted`` false).

Defined results: null text, empty text and text without a letter give ``und``
with score 0 and are rejected; a tie goes to the language that sorts first (score 0);
with a single learned language the margin is 1; without any labelled row every
document is ``und``. Rows are judged one by one, so repeated rows
get equal results, and further columns of the input do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playlens.llm.common import arrow_map, free_name

#: Bounds of the labelled sample: documents per language, characters taken of each.
SAMPLE_DOCS, SAMPLE_CHARS = 64, 4000
#: Bytes of normalised letters compressed at a time. The margin then does not
#: shrink with the length of a text.
BLOCK_BYTES = 4096
LEVEL = 6
#: Margin below which the decision is rejected.
MIN_MARGIN = 0.01
UNDETERMINED = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id's text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def letters(text: str) -> bytes:
    """Lower-case letters with single blanks between words, as UTF-8."""
    out = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return out.encode("utf-8", "replace") if any(map(str.isalpha, out)) else b""


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """Dictionary content per language from a bounded sample of labelled rows:
    the ``sample_docs`` distinct texts per language with the smallest hash,
    ``sample_chars`` characters of each. Held-out documents are not read.

    Only hashes are de-duplicated and ranked; the texts of the chosen ones are looked
    up after. The distinct step has a map-side part, and the ranking keeps at most
    ``sample_docs`` rows per language and task before the shuffle, so neither a group of
    copies nor a language holding most rows reaches one task whole.
    """
    labelled = (docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
                           & (F.length("text") > 0))
                .select("lang", F.substring("text", 1, sample_chars).alias("text"))
                .withColumn("h", F.xxhash64("text")))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = (labelled.select("lang", "h").distinct().withColumn("r", first)
              .where(F.col("r") <= sample_docs).select("lang", "h"))
    rows = (labelled.join(F.broadcast(chosen), ["lang", "h"])  # bounded by the sample's bounds
            .dropDuplicates(["lang", "h"]).orderBy("lang", "h").collect())
    content: dict[str, bytes] = {}
    for r in rows:
        content[r["lang"]] = content.get(r["lang"], b"") + letters(r["text"]) + b" "
    return {lang: c for lang, c in content.items() if c.strip()}


class Classifier:
    """Compressors of all languages, built once per worker."""

    def __init__(self, content: dict[str, bytes]):
        self.compressors = []
        for lang in sorted(content):
            d = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.compressors.append((lang, zstandard.ZstdCompressor(
                dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)))

    def __call__(self, text: str | None) -> tuple[str, float]:
        data = letters(text) if text else b""
        if not data or not self.compressors:
            return UNDETERMINED, 0.0
        blocks = [data[i:i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in self.compressors)
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0]


def identify(docs: DataFrame, content: dict[str, bytes], min_margin: float = MIN_MARGIN,
             names: tuple[str, str, str] = ("lang_pred", "score", "accepted")) -> DataFrame:
    """``docs`` with the language, the score and whether it is accepted, under ``names``,
    in place of any columns of those names. Only ``text`` is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(content)  # bounded by the sample's bounds

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(shared.value)
        for batch in batches:
            found = [classify(t.as_py()) for t in batch.column("text")]
            lang, score = [x[0] for x in found], [x[1] for x in found]
            ok = [x != UNDETERMINED and s >= min_margin for x, s in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(ok, pa.bool_())],
                names=[*batch.schema.names, *names])

    docs = docs.drop(*names)
    schema = StructType(list(docs.schema.fields))
    for name, kind in zip(names, ("string", "double", "boolean")):
        schema = schema.add(name, kind)
    return arrow_map(docs, judge, schema)


def op10_language_id(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted`` of every document."""
    content = learn(docs)
    return identify(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), content).drop("text")


def drop_rejected(docs: DataFrame) -> DataFrame:
    """Documents whose language is determined with a sufficient margin."""
    content = learn(docs)
    names = tuple(free_name(docs, n) for n in ("lang_pred", "score", "accepted"))
    return identify(docs, content, names=names).where(F.col(names[2])).select(*docs.columns)
