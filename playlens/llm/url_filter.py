"""URL verdicts from rules and from a cascade of Bloom filters.

Rules (host, path) come first; the longest that fits wins. Other URLs are judged by
a list of keys, a key being a host or any parent domain of it. Membership in the
list is exact and needs no join: level 0 encodes the listed keys; level 1 the keys of
the corpus that are not listed but pass level 0; level 2 the listed keys that pass level 1;
and so on until a level lets nothing pass wrongly. As every key of the corpus was
tested while building, the first level that a key fails tells on which side it is.

The cascade goes to every task, so its size is checked: with more listed keys than
``MOST_LISTED`` (about 16 bits each) the keys are joined instead.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no
rule, has no key and is allowed; with an empty list every URL without a rule is
allowed; repeated rows are judged alike; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import arrow_map, build_bitmap, in_bitmap, materialise

# fixed values: rules as (verdict, host, start of the path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Words of a host label that put it on the list of the registered query.
LISTED_WORDS = ("ads", "casino", "malware", "phish", "porn", "spam", "track", "tracker")
MOST_LISTED = 1 << 24
HASHES = 5
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, else null."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def keys_of(host: Column) -> Column:
    """The host and its parent domains."""
    labels = F.split(host, "\\.", -1)
    n = F.size(labels)
    return F.when(host != "", F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(
        F.slice(labels, i, n), "."))).otherwise(F.array().cast("array<string>"))


def listed_by_words(key: Column, words=LISTED_WORDS) -> Column:
    """Whether the key's first label has one of the words between hyphens."""
    return F.arrays_overlap(F.split(F.substring_index(key, ".", 1), "-"), F.lit(list(words)))


def level_hash(level: int, key: Column) -> Column:
    return F.xxhash64(F.lit(level), key)


def build_cascade(keys: DataFrame) -> list[np.ndarray]:
    """Levels of the cascade over the corpus's distinct keys (``key, listed``).

    Each level is one pass over the keys that the two levels before left; both sets
    shrink by the false-positive rate with every second level."""
    inside = materialise(keys.where("listed").select("key"), "listed")
    outside = materialise(keys.where("not listed").select("key"), "unlisted")
    levels: list[np.ndarray] = []
    encoded, tested = inside, outside
    count = encoded.count()
    while count:
        level = len(levels)
        bits = max(6, (count * 10 - 1).bit_length())
        bitmap = build_bitmap(encoded, level_hash(level, F.col("key")), bits, HASHES)
        levels.append(bitmap)
        shared = keys.sparkSession.sparkContext.broadcast(bitmap)

        def passing(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h = batch.column("h").to_numpy(zero_copy_only=False).astype(np.int64)
                yield batch.filter(pa.array(in_bitmap(shared.value, h, HASHES))).select(["key"])

        hashed = tested.select("key", level_hash(level, F.col("key")).alias("h"))
        wrong = materialise(arrow_map(hashed, passing, "key string"), "passing")
        encoded, tested = wrong, encoded
        count = encoded.count()
    return levels


def member(levels: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Exact membership of corpus keys; ``hashes[i, level]`` is key i's hash of the level."""
    first = np.full(len(hashes), len(levels))  # first level that the key fails
    for level in range(len(levels))[::-1]:
        first[~in_bitmap(levels[level], np.ascontiguousarray(hashes[:, level]), HASHES)] = level
    return first % 2 == 1


def probe(pages: DataFrame, levels: list[np.ndarray]) -> DataFrame:
    """``pages`` (with a column ``keys``) plus ``listed``: whether any key is listed."""
    n = len(levels)
    if n == 0:
        return pages.withColumn("listed", F.lit(False))
    shared = pages.sparkSession.sparkContext.broadcast(levels)
    hashed = pages.withColumn("__h", F.flatten(F.transform("keys", lambda k: F.array(
        *[level_hash(i, k) for i in range(n)]))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column("__h")
            rows = np.repeat(np.arange(batch.num_rows), np.asarray(h.value_lengths()) // n)
            found = member(shared.value, h.flatten().to_numpy(zero_copy_only=False).reshape(-1, n))
            listed = np.bincount(rows[found], minlength=batch.num_rows) > 0
            rest = batch.drop_columns(["__h"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(listed)], names=[*rest.schema.names, "listed"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema.fields)
    return arrow_map(hashed, run, columns + ", listed boolean")


def probe_by_join(pages: DataFrame, keys: DataFrame) -> DataFrame:
    """The same for lists too large to send: a semi-join of the exploded keys."""
    rows = pages.withColumn("__row", F.monotonically_increasing_id())
    rows = materialise(rows, "pages")
    hit = (rows.select("__row", F.explode("keys").alias("key"))
           .join(keys.where("listed").select("key"), "key", "left_semi").select("__row").distinct()
           .withColumn("__hit", F.lit(True)))
    return rows.join(hit, "__row", "left").withColumn("listed", F.coalesce("__hit", F.lit(False))).drop("__row", "__hit")


def judge(pages: DataFrame, listed=listed_by_words, rules=RULES, most_listed: int = MOST_LISTED) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` of every page. ``listed`` maps a
    key column to a condition, or is a DataFrame of listed ``key``s."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parsed = parsed.withColumn("keys", keys_of(F.col("host")))
    keys = parsed.select(F.explode("keys").alias("key")).distinct()
    if isinstance(listed, DataFrame):
        names = listed.select("key").distinct().withColumn("listed", F.lit(True))
        keys = keys.join(names, "key", "left").select("key", F.coalesce("listed", F.lit(False)).alias("listed"))
    else:
        keys = keys.withColumn("listed", F.coalesce(listed(F.col("key")), F.lit(False)))
    keys = materialise(keys, "keys")
    few = keys.where("listed").count() <= most_listed
    judged = probe(parsed, build_cascade(keys)) if few else probe_by_join(parsed, keys)
    rule = best_rule(F.col("host"), F.col("path"), rules)
    return judged.withColumn("r", rule).select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


def oracle_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    return f"""
WITH u AS (SELECT row_number() OVER () AS r, page_id,
       translate(regexp_extract(coalesce(url, ''), '{_URL}', 1), '{upper}', '{lower}') AS host,
       regexp_extract(coalesce(url, ''), '{_URL}', 2) AS path FROM pages),
rules(verdict, h, p) AS (VALUES {rules}),
best AS (SELECT r, arg_max(verdict, length(h || p)) AS verdict, arg_max(h || p, length(h || p)) AS rule
         FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r),
l AS (SELECT *, regexp_matches(host, '(^|[.-])({"|".join(LISTED_WORDS)})([.-]|$)') AS listed FROM u)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM l LEFT JOIN best USING (r)"""
