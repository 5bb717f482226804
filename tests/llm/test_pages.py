"""URL verdicts and the fixity audit, against DuckDB and against written files."""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from playlens.llm import url_filter, warc_fixity
from .test_scans import same

PAGES = "page_id LONG, url STRING, html STRING"


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    urls = [None, "", "no scheme", "http://", "https://EXAMPLE.org", "http://a.example.org/es/x?y#z", "http://org/", "x://y://z/p",
            "http://example.org/en/123", "http://notexample.org/es/", "http://b.com/fr/", "http://b.com/de/?q", "http://com/de/1",
            "http://www.spam-farm.net/a", "http://spamfarm.net/a", "http://x.ads.y.net", "http://ads-track.example.org/es/1",
            "http://a..b/", "http://h\n.net/\np", "http://track.com/fr/", "http://example.org/en/1", "ftp://casino/#x"]
    rows = [(i, u, f"<p>page {i}</p>\r\n\r\nmore" if i % 5 else None) for i, u in enumerate(urls)]
    rows += [(None, "http://same.net/", "x"), (None, "http://same.net/", "x"), (3, "http://again.org/", "\u00e9")]
    rows += [(i, f"http://h{i % 40}.spam.net/p{i}", "body " * (i % 50)) for i in range(1000, 3400)]
    rows += [rows[-1]] * 500
    folder = str(tmp_path_factory.mktemp("pages") / "sf")
    spark.createDataFrame(rows, PAGES).withColumn("keys", F.lit("clash")).withColumn("digest", F.lit(1)).write.parquet(
        folder + "/pages.parquet")
    return folder


@pytest.mark.parametrize("name", ["op3_bloom_cascade", "op5_merkle_audit"])
def test_odd_rows_match_sql(spark, odd, name):
    same(spark, name, odd)


def test_join_form_agrees_with_the_cascade(spark, odd):
    pages = spark.read.parquet(odd + "/pages.parquet")
    key = lambda df: sorted(map(str, df.collect()))
    assert key(url_filter.judge(pages)) == key(url_filter.judge(pages, most_listed=0))


def test_cascade_is_exact_and_alternates(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "HASHES", 1)  # many false positives: several levels
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 3 == 0).alias("listed"))
    levels = url_filter.build_cascade(keys)
    assert len(levels) >= 3
    n = len(levels)
    rows = keys.select("listed", F.array(*[url_filter.level_hash(i, F.col("key")) for i in range(n)]).alias("h")).collect()
    found = url_filter.member(levels, np.array([r["h"] for r in rows]))
    assert found.tolist() == [r["listed"] for r in rows]


def test_a_given_list_and_an_empty_one(spark, odd):
    pages = spark.read.parquet(odd + "/pages.parquet")
    only = spark.createDataFrame([("b.com",), ("unseen.net",)], "key STRING")
    got = {r["page_id"]: r for r in url_filter.judge(pages, listed=only).collect() if r["page_id"]}
    assert got[10]["verdict"] == "allow" and got[10]["listed"] and got[13]["verdict"] == "allow"
    none = url_filter.judge(pages, listed=only.where("false"))
    assert none.where("listed").count() == 0


def test_written_files_have_the_layout(spark, odd, tmp_path):
    pages = spark.read.parquet(odd + "/pages.parquet").select("page_id", "url", "html")
    warc_fixity.write_warc(pages, str(tmp_path / "warc"))
    rec = warc_fixity.record(F.col("url"), F.col("page_id"), F.col("html"))
    rows = pages.select("page_id", warc_fixity.digest(rec).alias("digest"),
                        (F.octet_length(rec) + 4).cast("long").alias("length"))
    files = {}
    for d, _, names in os.walk(tmp_path / "warc"):
        for n in names:
            if n.startswith("part-"):
                assert d not in files
                files[d] = open(os.path.join(d, n), "rb").read()
    places = warc_fixity.layout(rows).collect()
    assert len(places) == pages.count()
    for r in places:
        data = files[str(tmp_path / "warc" / f"file_no={r['file_no']}")]
        assert hashlib.sha256(data[r["offset"]:r["offset"] + r["length"]]).hexdigest() == r["digest"]


def test_intact_replica_and_lost_file(spark, odd):
    pages = spark.read.parquet(odd + "/pages.parquet")
    rec = warc_fixity.record(F.col("url"), F.col("page_id"), F.col("html"))
    placed = warc_fixity.layout(pages.select("page_id", warc_fixity.digest(rec).alias("digest"),
                                             (F.octet_length(rec) + 4).cast("long").alias("length")))
    assert warc_fixity.audit(placed, placed).where("NOT intact OR n_differing > 0").count() == 0
    lost = warc_fixity.audit(placed, placed.where("file_no <> 1")).collect()
    assert [(r["file_no"], r["intact"], r["n_differing"] == r["n_records"]) for r in sorted(lost, key=lambda r: r["file_no"])][1] \
        == (1, False, True)


def laid_out(spark, odd):
    pages = spark.read.parquet(odd + "/pages.parquet").select("page_id", "url", "html")
    rec = warc_fixity.record(F.col("url"), F.col("page_id"), F.col("html"))
    return pages, warc_fixity.layout(pages.select("page_id", warc_fixity.digest(rec).alias("digest"),
                                                  (F.octet_length(rec) + 4).cast("long").alias("length")))


def test_shifted_and_extra_records_are_located(spark, odd):
    _, placed = laid_out(spark, odd)
    placed = warc_fixity.materialise(placed, "placed")
    shifted = warc_fixity.audit(placed, placed.withColumn("offset", F.col("offset") + F.when(F.col("file_no") == 1, 7).otherwise(0)))
    got = {r["file_no"]: r for r in shifted.collect()}
    assert got[0]["intact"] and got[2]["intact"] and not got[1]["intact"]
    assert got[1]["n_moved"] == got[1]["n_differing"] == got[1]["n_records"]
    # one record more in file 0, a file more, one record changed and one lost in file 2
    extra = placed.limit(0).unionByName(spark.createDataFrame(
        [(77, "ab", 5, 0, 1024, 10 ** 6), (78, "cd", 5, 9, 0, 0)], "page_id LONG, digest STRING, length LONG, file_no LONG, record_no INT, offset LONG"))
    other = placed.where("NOT (file_no = 2 AND record_no = 17)").withColumn(
        "digest", F.when(F.expr("file_no = 2 AND record_no = 100"), "x").otherwise(F.col("digest"))).unionByName(extra)
    got = {r["file_no"]: r for r in warc_fixity.audit(placed, other).collect()}
    assert (got[0]["n_extra"], got[0]["n_differing"], got[0]["differing"], got[0]["first_offset"]) == (1, 1, "77", 10 ** 6)
    assert got[1]["intact"] and got[1]["n_differing"] == 0
    assert (got[2]["n_lost"], got[2]["n_differing"], got[2]["intact"]) == (1, 2, False)
    assert (got[9]["n_records"], got[9]["n_extra"], got[9]["root"], got[9]["differing"]) == (0, 1, None, "78")


def test_written_files_are_read_back_and_audited(spark, odd, tmp_path):
    pages, placed = laid_out(spark, odd)
    placed = warc_fixity.materialise(placed, "placed")
    for name in ("good", "bad"):
        warc_fixity.write_warc(pages, str(tmp_path / name))
    found = warc_fixity.read_warc(spark, str(tmp_path / "good"))
    assert warc_fixity.audit(placed, found).where("NOT intact").count() == 0
    text = lambda r: (r["page_id"], (r["url"] or "").replace("\r", "%0D").replace("\n", "%0A"), r["html"] or "")
    assert sorted(map(str, map(text, found.collect()))) == sorted(map(str, map(text, pages.collect())))
    d = tmp_path / "bad" / "file_no=1"
    part = next(d / n for n in os.listdir(d) if n.startswith("part-"))
    data = part.read_bytes()
    assert b"WARC-Date: " in data
    row = placed.where("file_no = 1 AND record_no = 300").first()
    at = row["offset"] + row["length"] - 5  # the last byte of a block
    part.write_bytes(data[:at] + b"?" + data[at + 1:] + b"trailing bytes")
    os.remove(part.parent / f".{part.name}.crc") if (part.parent / f".{part.name}.crc").exists() else None
    got = {r["file_no"]: r for r in warc_fixity.audit(placed, warc_fixity.read_warc(spark, str(tmp_path / "bad"))).collect()}
    assert got[0]["intact"] and (got[1]["n_differing"], got[1]["n_extra"], got[1]["first_offset"]) == (2, 1, row["offset"])
    assert got[1]["differing"] == f"{row['page_id']},"


def test_empty_tables(spark):
    empty = spark.createDataFrame([], PAGES)
    assert url_filter.judge(empty).collect() == [] and warc_fixity.op5_audit(empty).collect() == []
