"""Merkle fixity audit of WARC files and their replicas.

Pages become WARC records, laid out in order of (page id, record digest) in files of
``RECORDS`` records; the layout gives every record its file, number, offset and length.
The leaves of a file's tree are the records' SHA-256 digests with their offset ranges; an inner
node hashes the digests and ranges of ``FANOUT`` neighbouring children, the root those of the
top nodes. So a record with right bytes at another offset changes the root too. Each replica has a tree
of its own over the records found in it. Replicas are compared root by root; only the children of
nodes that differ, or that one side lacks, are compared further, down to the records: changed, lost,
moved or extra ones.

Every grouping of nodes is by (file, range), at most ``FANOUT`` rows each, so no file, page id
or group of copies gathers in one task. The order over all records comes from a
range partitioning that also splits equal records.

Defined results: null html counts as empty, a null url as empty, a null page id sorts
first; line ends in a url are percent-encoded; equal records are laid out one after another; an empty
table has no file; a file that only the replica has is listed with no records; further columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlens.llm.common import arrow_map, materialise

RECORDS, FANOUT, LEVELS = 1024, 16, 3  # FANOUT ** LEVELS >= RECORDS
#: Date given to records (the pages have none).
DATE = "1970-01-01T00:00:00Z"
#: End of a record; the text sink writes it as its line separator.
END = "\r\n\r\n"


def record(url: Column, page_id: Column, html: Column, date: str = DATE) -> Column:
    """Header and block of a resource record, without the end of the record."""
    block = F.coalesce(html, F.lit(""))
    address = F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), address,
                    F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Record-ID: <urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("")),
                    F.lit(">\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(block).cast("string"), F.lit(END), block)


def digest(text: Column) -> Column:
    return F.sha2(F.concat(text, F.lit(END)), 256)


def layout(records: DataFrame) -> DataFrame:
    """Adds ``file_no, record_no, offset`` to records with ``page_id, digest, length``
    (and any further columns)."""
    rows = materialise(records.withColumn("__row", F.monotonically_increasing_id()), "records")
    order = ["page_id", "digest", "__row"]
    parts = materialise(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ordered")
    before, base = 0, {}
    for p, n in sorted((r["__part"], r["count"]) for r in parts.groupBy("__part").count().collect()):
        base[p], before = before, before + n  # one number a partition
    starts = parts.sparkSession.createDataFrame(list(base.items()) or [(0, 0)], "__part int, __base long")
    in_part = Window.partitionBy("__part").orderBy(*order)
    at = F.col("__base") + F.row_number().over(in_part) - 1
    placed = parts.join(F.broadcast(starts), "__part").withColumn("__at", at)
    placed = (placed.withColumn("file_no", F.call_function("div", F.col("__at"), F.lit(RECORDS)))
              .withColumn("record_no", F.pmod("__at", F.lit(RECORDS)).cast("int")))
    in_file = Window.partitionBy("file_no").orderBy("record_no")
    return (placed.withColumn("offset", F.sum("length").over(in_file) - F.col("length"))
            .drop("__row", "__part", "__base", "__at"))


def _hashed(rows: DataFrame, *keys: Column | str) -> DataFrame:
    """Nodes over the rows of each group: the hash of their digests and ranges in order, and their range."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct("node", "digest", "start", "stop"))),
                        lambda c: F.concat_ws("", c["digest"], F.lit(":"), c["start"].cast("string"), F.lit("-"), c["stop"].cast("string")))
    return rows.groupBy(*keys).agg(F.sha2(F.array_join(parts, ","), 256).alias("digest"),
                                   F.min("start").alias("start"), F.max("stop").alias("stop"))


def tree(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Levels ``file_no, node, digest, start, stop`` from the records (level 0) up, and the roots
    ``file_no, digest``. ``leaves``: ``file_no, record_no, digest, offset, length`` of the records found."""
    level = leaves.select("file_no", F.col("record_no").cast("long").alias("node"), "digest", F.col("offset").alias("start"),
                          (F.col("offset") + F.col("length")).alias("stop"))
    levels = [level]
    for i in range(LEVELS):
        up = F.call_function("div", F.col("node"), F.lit(FANOUT)).alias("up")
        level = _hashed(level, "file_no", up).withColumnRenamed("up", "node")
        # the records are hashed once; what is above them is a sixteenth and is read at every step down
        level = materialise(level, "tree") if i == 0 else level
        levels.append(level)
    return levels, _hashed(level, "file_no").select("file_no", "digest")


def differing(copy: list[DataFrame], replica: list[DataFrame]) -> DataFrame:
    """``file_no, record_no, kind, start`` of the records that differ, found by descending
    into differing nodes only. ``kind``: ``lost``, ``extra``, ``changed`` or ``moved`` (same bytes,
    other place); ``start`` is the offset in the copy (of extra records, in the replica)."""
    bad = None
    for level in range(LEVELS, -1, -1):
        a, b = copy[level], replica[level]
        if bad is not None:
            up = F.call_function("div", F.col("node"), F.lit(FANOUT))
            a, b = (x.withColumn("up", up).join(bad, ["file_no", "up"], "left_semi").drop("up") for x in (a, b))
        b = b.select("file_no", "node", *[F.col(c).alias(f"{c}2") for c in ("digest", "start", "stop")])
        found = a.join(b, ["file_no", "node"], "full").where(
            ~(F.col("digest").eqNullSafe(F.col("digest2")) & F.col("start").eqNullSafe(F.col("start2"))
              & F.col("stop").eqNullSafe(F.col("stop2"))))
        bad = found.select("file_no", F.col("node").alias("up"))
    kind = (F.when(F.col("digest2").isNull(), "lost").when(F.col("digest").isNull(), "extra")
            .when(F.col("digest") == F.col("digest2"), "moved").otherwise("changed"))
    return found.select("file_no", F.col("node").alias("record_no"), kind.alias("kind"), F.coalesce("start", "start2").alias("start"))


def audit(manifest: DataFrame, replica: DataFrame) -> DataFrame:
    """One row per file: ``file_no, n_records, n_bytes, root, replica_root, intact, n_differing, n_lost,
    n_extra, n_moved, first_offset, differing`` (page ids, comma-joined in order).

    ``manifest``: the layout of the copy held to be good; ``replica``: ``file_no, record_no, page_id,
    digest, offset, length`` of the records found in the other one."""
    (copy, roots), (other, other_roots) = tree(manifest), tree(replica)
    ids = manifest.select("file_no", "record_no", F.col("page_id").alias("id1"), F.lit(1).alias("in1"))
    ids2 = replica.select("file_no", "record_no", F.col("page_id").alias("id2"))
    bad = (differing(copy, other).join(ids, ["file_no", "record_no"], "left").join(ids2, ["file_no", "record_no"], "left")
           .withColumn("page_id", F.when(F.col("in1").isNull(), F.col("id2")).otherwise(F.col("id1"))))
    places = bad.groupBy("file_no").agg(
        F.count("*").alias("n_differing"), *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("lost", "extra", "moved")],
        F.min("start").alias("first_offset"),
        F.sort_array(F.collect_list(F.struct("record_no", "page_id"))).alias("at"))  # a file's own records
    size = manifest.groupBy("file_no").agg(F.count("*").alias("n_records"), F.sum("length").alias("n_bytes"))
    both = roots.withColumnRenamed("digest", "root").join(other_roots.withColumnRenamed("digest", "replica_root"), "file_no", "full")
    names = F.array_join(F.transform("at", lambda x: F.coalesce(x["page_id"].cast("string"), F.lit(""))), ",")
    zero = F.lit(0).cast("long")
    return both.join(size, "file_no", "left").join(places, "file_no", "left").select(
        "file_no", F.coalesce("n_records", zero).alias("n_records"), F.coalesce("n_bytes", zero).alias("n_bytes"), "root",
        "replica_root", F.col("root").eqNullSafe(F.col("replica_root")).alias("intact"),
        *[F.coalesce(c, zero).alias(c) for c in ("n_differing", "n_lost", "n_extra", "n_moved")], "first_offset",
        F.coalesce(names, F.lit("")).alias("differing"))


def write_warc(pages: DataFrame, path: str) -> None:
    """Write the pages as WARC files, one per folder ``file_no=...`` below ``path``."""
    text = record(F.col("url"), F.col("page_id"), F.col("html"))
    rows = pages.select("page_id", text.alias("value"))
    rows = rows.withColumn("digest", digest(F.col("value"))).withColumn(
        "length", F.octet_length("value").cast("long") + len(END))
    placed = layout(rows).repartition("file_no").sortWithinPartitions("file_no", "record_no")
    placed.select("file_no", "value").write.partitionBy("file_no").option("lineSep", END).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``file_no, record_no, page_id, url, html, digest, offset, length`` of the records in the files
    below ``path`` (folders ``file_no=...``, as ``write_warc`` leaves them), split by their Content-Length.

    A file is read by one task (``RECORDS`` records). What is no record ends a file's reading: the
    rest is one record of its own with null url and html, so that nothing passes unseen."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(
        F.col("path").rlike(r"/file_no=\d+/part-")).select(
        F.regexp_extract("path", r"/file_no=(\d+)/", 1).cast("long").alias("file_no"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = END.encode()
        for batch in batches:
            for file_no, content in zip(batch.column("file_no"), batch.column("content")):
                data, at, rows = content.as_py(), 0, []
                while at < len(data):
                    head = data.find(end, at)
                    fields = dict(x.split(b": ", 1) for x in data[at:max(at, head)].split(b"\r\n") if b": " in x)
                    size = fields.get(b"Content-Length", b"")
                    stop = head + 2 * len(end) + int(size) if size.isdigit() else 0
                    whole = data.startswith(b"WARC/", at) and head > 0 and 0 < stop <= len(data) and data[stop - len(end):stop] == end
                    stop = stop if whole else len(data)
                    name = fields.get(b"WARC-Record-ID", b"").decode("utf-8", "replace").removeprefix("<urn:x-page:").removesuffix(">")
                    rows.append((file_no.as_py(), len(rows), int(name) if whole and name.lstrip("-").isdigit() else None,
                                 fields.get(b"WARC-Target-URI", b"").decode("utf-8", "replace") if whole else None,
                                 data[head + len(end):stop - len(end)].decode("utf-8", "replace") if whole else None,
                                 hashlib.sha256(data[at:stop]).hexdigest(), at, stop - at))
                    at = stop
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                                 names=["file_no", "record_no", "page_id", "url", "html", "digest", "offset", "length"])

    return arrow_map(files, run, "file_no long, record_no int, page_id long, url string, html string, digest string, "
                                 "offset long, length long")


#: The registered query's replica, by the first byte of the MD5 digest of a page's id: records whose
#: first character is overwritten, that are lost, moved by seven bytes, or there twice (again at the end).
CHANGED, LOST, MOVED, TWICE, MOVED_BY = ("00", "01"), ("02", "03"), ("04",), ("05",), 7


def op5_audit(pages: DataFrame) -> DataFrame:
    url, page_id, html = F.col("url"), F.col("page_id"), F.col("html")
    kind = F.substring(F.md5(F.coalesce(page_id.cast("string"), F.lit("")).cast("binary")), 1, 2)
    block = F.coalesce(html, F.lit(""))
    bad = F.when(kind.isin(*CHANGED), F.concat(F.lit("#"), F.substring(block, F.lit(2), F.length(block)))).otherwise(block)
    good, other = record(url, page_id, html), record(url, page_id, bad)
    size = lambda text: (F.octet_length(text) + len(END)).cast("long")
    rows = pages.select("page_id", digest(good).alias("digest"), size(good).alias("length"), kind.alias("kind"),
                        digest(other).alias("digest2"), size(other).alias("length2"))
    placed = materialise(layout(rows), "layout")
    moved = F.col("offset") + F.when(F.col("kind").isin(*MOVED), MOVED_BY).otherwise(0)
    columns = ["file_no", "record_no", "page_id", "digest", "offset", "length"]
    found = placed.where(~F.col("kind").isin(*LOST)).select(
        "file_no", "record_no", "page_id", F.col("digest2").alias("digest"), moved.alias("offset"), F.col("length2").alias("length"))
    ends = placed.groupBy("file_no").agg(F.count("*").alias("n"), F.sum("length").alias("end"))
    in_file = Window.partitionBy("file_no").orderBy("record_no")
    twice = (placed.where(F.col("kind").isin(*TWICE)).withColumn("k", F.row_number().over(in_file))
             .withColumn("before", F.sum("length").over(in_file) - F.col("length")).join(ends, "file_no")
             .select("file_no", (F.col("n") + F.col("k") - 1).cast("int").alias("record_no"), "page_id", "digest",
                     (F.col("end") + F.col("before")).alias("offset"), "length"))
    return audit(placed.select(*columns), found.unionByName(twice))


def oracle_sql() -> str:
    """The trees written out level by level, and the differing records directly."""
    crlf = "chr(13) || chr(10)"
    end = f"{crlf} || {crlf}"

    def rec(block: str) -> str:
        return (f"'WARC/1.0' || {crlf} || 'WARC-Type: resource' || {crlf} || 'WARC-Target-URI: ' || "
                f"replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') || {crlf} || 'WARC-Date: {DATE}' || "
                f"{crlf} || 'WARC-Record-ID: <urn:x-page:' || coalesce(page_id::VARCHAR, '') || '>' || {crlf} || "
                f"'Content-Type: text/html; charset=utf-8' || {crlf} || 'Content-Length: ' || "
                f"strlen({block})::VARCHAR || {end} || {block} || {end}")

    def any_of(kinds: tuple[str, ...]) -> str:
        return "k IN (" + ", ".join(f"'{k}'" for k in kinds) + ")"

    node = "sha256(string_agg(a || ':' || s::VARCHAR || '-' || e::VARCHAR, ',' ORDER BY n)) AS a"
    levels = "".join(f""",
{t}{i} AS (SELECT f, n // {FANOUT} AS n, {node}, min(s) AS s, max(e) AS e FROM {t}{i - 1} GROUP BY f, n // {FANOUT})"""
                     for t in "cr" for i in range(1, LEVELS + 1))
    roots = "".join(f""",
{t}r AS (SELECT f, {node} FROM {t}{LEVELS} GROUP BY f)""" for t in "cr")
    return f"""
WITH h AS (SELECT page_id, url, coalesce(html, '') AS h, substring(md5(coalesce(page_id::VARCHAR, '')), 1, 2) AS k FROM pages),
d AS (SELECT *, CASE WHEN {any_of(CHANGED)} THEN '#' || substring(h, 2) ELSE h END AS g FROM h),
r AS (SELECT page_id, k, strlen({rec('h')}) AS length, sha256({rec('h')}) AS a,
             strlen({rec('g')}) AS length2, sha256({rec('g')}) AS b FROM d),
o AS (SELECT *, row_number() OVER (ORDER BY page_id NULLS FIRST, a) - 1 AS i FROM r),
p AS (SELECT *, i // {RECORDS} AS f, i % {RECORDS} AS n,
             sum(length) OVER (PARTITION BY i // {RECORDS} ORDER BY i) - length AS s FROM o),
t AS (SELECT f, count(*) AS n, sum(length) AS e FROM p GROUP BY f),
c0 AS (SELECT f, n, page_id, a, s, s + length AS e FROM p),
r0 AS (SELECT f, n, page_id, b AS a, s + m AS s, s + m + length2 AS e
       FROM (SELECT *, CASE WHEN {any_of(MOVED)} THEN {MOVED_BY} ELSE 0 END AS m FROM p WHERE NOT {any_of(LOST)})
       UNION ALL SELECT x.f, t.n + x.i - 1, x.page_id, x.a, t.e + x.z - x.length, t.e + x.z
       FROM (SELECT *, row_number() OVER w AS i, sum(length) OVER w AS z FROM (SELECT f, n, page_id, a, length FROM p
             WHERE {any_of(TWICE)}) WINDOW w AS (PARTITION BY f ORDER BY n)) x JOIN t ON x.f = t.f){levels}{roots},
q AS (SELECT coalesce(c0.f, r0.f) AS f, coalesce(c0.n, r0.n) AS n, coalesce(c0.s, r0.s) AS s,
             CASE WHEN c0.f IS NULL THEN r0.page_id ELSE c0.page_id END AS page_id,
             r0.f IS NULL AS lost, c0.f IS NULL AS extra, coalesce(c0.a = r0.a, FALSE) AS moved
      FROM c0 FULL JOIN r0 ON c0.f = r0.f AND c0.n = r0.n
      WHERE c0.a IS DISTINCT FROM r0.a OR c0.s IS DISTINCT FROM r0.s OR c0.e IS DISTINCT FROM r0.e),
b AS (SELECT f, count(*) AS n_differing, count(*) FILTER (lost) AS n_lost, count(*) FILTER (extra) AS n_extra,
             count(*) FILTER (moved) AS n_moved, min(s)::BIGINT AS first_offset,
             string_agg(coalesce(page_id::VARCHAR, ''), ',' ORDER BY n) AS differing FROM q GROUP BY f)
SELECT cr.f AS file_no, t.n AS n_records, t.e::BIGINT AS n_bytes, cr.a AS root, rr.a AS replica_root,
       cr.a IS NOT DISTINCT FROM rr.a AS intact, coalesce(n_differing, 0) AS n_differing, coalesce(n_lost, 0) AS n_lost,
       coalesce(n_extra, 0) AS n_extra, coalesce(n_moved, 0) AS n_moved, first_offset, coalesce(differing, '') AS differing
FROM cr JOIN t ON cr.f = t.f LEFT JOIN rr ON cr.f = rr.f LEFT JOIN b ON cr.f = b.f"""
