"""The tolerant payload reader: its definition, and that it computes payload and JSON once per row."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from conftest import rows
from playlens.functions.payload import payload_fields, tolerant_fields


def spelled_out(p):
    """The definition of the tolerant reader: JSON's name, or the first of three forms in the text."""
    def loose(key):
        before, sep = r"""(?:^|[{,;\s"'])""", r"""["']?\s*[:=]\s*"""
        return F.coalesce(*[F.nullif(F.trim(F.regexp_extract(p, before + key + sep + value, 1)), F.lit(""))
                            for value in (r'"([^"]*)', "'([^']*)", r"""([^,;}"'\s][^,;}]*)""")])
    strict = payload_fields(p)
    name = F.coalesce(strict["item_name"], loose("item_name"))
    flag = F.when(strict["item_name"].isNotNull(), strict["did_reach_end_of_stream"]).otherwise(loose("did_reach_end_of_stream"))
    return F.struct(name.alias("item_name"), flag.alias("did_reach_end_of_stream"), F.when(name.isNull(), p).alias("not_json"))


def odd_payloads():
    rnd = random.Random(4)
    parts = ["{", "}", "[", "]", ",", ";", " ", ":", "=", '"', "'", "\\", "item_name", "did_reach_end_of_stream", "my_item_name",
             "A.mp3", "true", "false", "null", "1", '"item_name":"B.mp3"', "'item_name':'C'", "item_name = D", "did_reach_end_of_stream:true",
             '"did_reach_end_of_stream":false', '"item_name":null', '"item_name":""', '"item_name":{"x":1}', '"ITEM_NAME":"x"', "é"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(1, 9))) for _ in range(3000)]
    texts += ["{" + ",".join(rnd.sample(parts[-9:], rnd.randint(1, 4))) + rnd.choice(["}", "} ", "},", ""]) for _ in range(1000)]
    texts += ['{"\\u0069tem_name":"E"}', '{"item\\u005fname":"F","did_reach_end_of_stream":true}', '{"item_name":"a\\"b"}', "", " ",
              "item_name=", "item_name=' '", "item_name='' ; item_name=G", '{"item_name":"H"} }', '{"item_name":"A","item_name":"B"}', None]
    return list(enumerate(texts))


def test_tolerant_reader_equals_its_definition(spark):
    df = spark.createDataFrame(odd_payloads(), "i INT, payload STRING")
    got = rows(df.select("i", F.inline(F.array(tolerant_fields("payload")))).select("i", F.struct("*").cast("string").alias("f")))
    want = rows(df.select("i", F.inline(F.array(spelled_out(F.col("payload"))))).select("i", F.struct("*").cast("string").alias("f")))
    assert got == want
    assert len({f for _, f in got}) > 100


def test_tolerant_reader_computes_payload_and_json_once(spark):
    df = spark.createDataFrame([("x",)], "payload STRING")
    fields = tolerant_fields(F.regexp_replace("payload", "x", "y"))
    text = df.select(F.inline(F.array(fields)))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1, text
    assert text.count("regexp_replace(") == 1, text
    assert text.count("regexp_extract(") == 6, text  # three forms for each of two keys
