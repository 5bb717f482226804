"""Quality rules with the frequency of lines across documents.

Lines are normalised (letters and digits only, lower case, digits as 0) and hashed;
per host, the distinct documents holding a line are counted. Exact copies of a
text count as one document, so copying a text does not turn its lines into
boilerplate. A line held by more than ``LINE_DOCS`` documents of a host, whatever the
host's size, counts as removed, and a document left with less than ``MIN_LEFT`` of its words is rejected.
The base rules reject before that. Built from DataFrame expressions only.

Defined results: null text has no words and fails the base rule; lines without a
word are no lines; a null host is a host of its own; a host with no text has no
frequent line; rows are numbered internally, so repeated rows and repeated or
null ids are each judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import free_name, materialise

#: A line is frequent in a host when more documents than this hold it.
LINE_DOCS = 10
#: Share of words that must be left.
MIN_LEFT = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
BLANKS = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS, -1), "")


def sorted_windows(words: str) -> Column:
    """Hashes and positions of the 3-word windows, in the hashes' order."""
    w, n = F.col(words), F.size(words)
    three = F.arrays_zip(F.slice(w, 1, F.greatest(n - 2, F.lit(0))).alias("a"),
                         F.slice(w, 2, F.greatest(n - 2, F.lit(0))).alias("b"),
                         F.slice(w, 3, F.greatest(n - 2, F.lit(0))).alias("c"))
    return F.sort_array(F.transform(three, lambda x, i: F.struct(F.xxhash64(x).alias("h"), i.alias("i"))))


def repeated_words(windows: str) -> Column:
    """Number of words inside windows that occur twice or more: equal neighbours
    among the sorted windows (a column, so that each look-up is one array access)
    are repeated; each covers three words."""
    s = F.col(windows)
    again = lambda x, k: F.coalesce((F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]),
                                    F.get(s, k - 1)["h"] == x["h"], F.get(s, k + 1)["h"] == x["h"], F.lit(False))
    at = F.transform(F.filter(s, again), lambda x: x["i"])
    return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2))))).cast("long")


def normalised(line: Column) -> Column:
    """Letters and digits in lower case, every digit as 0, one blank between words."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), "[^\\p{L}\\p{N}]+", " "), "\\p{N}", "0"))


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per input row: base figures, and the hash and words of its lines."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select("doc_id", F.col(host).alias("host"), "text", words_of(text).alias("w"),
                        F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("l"))
    split = split.withColumn("s", sorted_windows("w"))
    line = lambda x: F.struct(F.xxhash64(normalised(x)).alias("line"),
                              F.size(words_of(x)).alias("words"))
    return split.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "host", F.xxhash64("text").alias("copy"),
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        repeated_words("s").alias("n_repeat_words"),
        F.transform("l", line).alias("lines"))


def frequent_lines(rows: DataFrame, line_docs: int = LINE_DOCS) -> DataFrame:
    """``host, line, docs``: lines above the limit. The count is over distinct
    texts; the distinct step has a map-side part and is keyed by text as well, so
    neither a common line nor a large host gathers in one task."""
    held = rows.select("host", "copy", F.explode("lines.line").alias("line")).distinct()
    return held.groupBy("host", "line").agg(F.count("*").alias("docs")).where(F.col("docs") > line_docs)


def remove_frequent_lines(docs: DataFrame, host: str = "source", line_docs: int = LINE_DOCS) -> DataFrame:
    """``docs`` whose texts are without the lines that are frequent in their host (all of their
    places), in order and otherwise as they stand. Lines without a word stay; null stays null."""
    row, frequent = free_name(docs, "row_"), free_name(docs, "frequent_")
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    lines = rows.select(F.col(row).alias("row"), F.col(host).alias("host"), F.xxhash64("text").alias("copy"),
                        F.explode(F.split("text", "\n", -1)).alias("raw")).where(F.col("raw").rlike("[^\\x20\\x09-\\x0D]"))
    held = materialise(lines.select("row", "host", "copy", F.xxhash64(normalised(F.col("raw"))).alias("line")).distinct(), "lines")
    common = (held.select("host", "copy", "line").distinct().groupBy("host", "line").agg(F.count("*").alias("docs"))
              .where(F.col("docs") > line_docs).select(F.col("host").alias("h"), F.col("line").alias("f")))
    gone = (held.join(common, (F.col("line") == F.col("f")) & F.col("host").eqNullSafe(F.col("h")))
            .groupBy("row").agg(F.collect_set("line").alias(frequent)).withColumnRenamed("row", row))  # a text's own lines
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda x: ~F.array_contains(
        frequent, F.xxhash64(normalised(x))) | ~x.rlike("[^\\x20\\x09-\\x0D]")), "\n")
    text = F.when(F.col(frequent).isNull(), F.col("text")).otherwise(kept)
    return rows.join(gone, row, "left").select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """``doc_id``, the base figures, ``n_words_left``, ``base_failed`` and ``kept`` per row."""
    rows = materialise(measure(docs, host), "quality")
    frequent = frequent_lines(rows).select(F.col("host").alias("h"), F.col("line").alias("f"))
    own = (rows.select("row", "host", F.inline("lines"))
           .groupBy("row", "host", "line").agg(F.sum("words").alias("words")))
    removed = (own.join(frequent, (F.col("line") == F.col("f")) & F.col("host").eqNullSafe(F.col("h")))
               .groupBy("row").agg(F.sum("words").alias("removed")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    return rows.drop("lines", "copy", "host").join(removed, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        left.alias("n_words_left"), failed.alias("base_failed"),
        (~failed & (left >= F.col("n_words") * MIN_LEFT)).alias("kept"))


def oracle_sql() -> str:
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source AS host, text, coalesce(text, '') AS t FROM documents),
m AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
wd AS (SELECT r, unnest(range(len(w))) AS i, unnest(w) AS v FROM m),
win AS (SELECT r, i, v || ' ' || lead(v) OVER p || ' ' || lead(v, 2) OVER p AS three FROM wd WINDOW p AS (PARTITION BY r ORDER BY i)),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, three) AS c FROM win WHERE three IS NOT NULL),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i+1, i+2]) AS p FROM g WHERE c > 1) GROUP BY r),
li AS (SELECT r, host, text, unnest(l) AS raw FROM m),
ln AS (SELECT r, host, text, trim(regexp_replace(regexp_replace(lower(raw), '[^\p{{L}}\p{{N}}]+', ' ', 'g'),
              '\p{{N}}', '0', 'g')) AS line,
              len(list_filter(regexp_split_to_array(raw, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n FROM li),
freq AS (SELECT host, line FROM ln GROUP BY host, line HAVING count(DISTINCT text) > {LINE_DOCS}),
rem AS (SELECT ln.r, sum(n) AS removed FROM ln JOIN freq
        ON ln.line = freq.line AND ln.host IS NOT DISTINCT FROM freq.host GROUP BY ln.r),
f AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
       len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
       (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
       (len(w) - coalesce(removed, 0))::BIGINT AS n_words_left,
       len(w) < {MIN_WORDS} OR 100 * coalesce(rep.n, 0) > {MAX_REPEAT_PERCENT} * len(w) AS base_failed
FROM m LEFT JOIN rep USING (r) LEFT JOIN rem USING (r))
SELECT *, NOT base_failed AND n_words_left >= n_words * {MIN_LEFT} AS kept FROM f"""
