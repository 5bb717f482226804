"""Licence notices found by a positional index of rare words.

1. Every licence word's inverse document frequency is counted over all texts.
2. Of each template's mandatory key phrases, the words of highest IDF become its
   index words. A text is looked up by those only, so common words of a notice
   ("the", "under") are never searched for.
3. Each occurrence of an index word at text position ``p`` that stands at template
   position ``q`` votes for the alignment ``p - q`` of that template. An alignment for
   which every index word votes is verified: each word of each mandatory phrase
   must stand at its aligned place.

A place of a phrase always holds its rarest word, so the look-up loses none.
``score`` is the largest share of a template's words standing at their aligned
places, over the text's verified alignments (0 without any).

Defined results: null and empty texts have no words and no label; ties in IDF go
to the word that sorts first (any choice gives the same result); rows are numbered
internally, so repeated rows and repeated or null ids each get their own result.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.llm.common import lower_for_ascii, materialise

#: Base phrases: places of these are counted (``n_base``). label, notice, mandatory phrases.
BASE = (
    ("mit", "released under the mit license", ("under the mit license",)),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
)
#: Further notices of public licences.
MORE = (
    ("agpl-3", "this work is licensed under the gnu affero general public license version 3",
     ("gnu affero general public license", "version 3")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"
            " provided that the following conditions are met",
     ("redistribution and use in source and binary forms", "following conditions are met")),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc0", "dedicated to the public domain under cc0 1 0", ("cc0 1 0",)),
    ("epl-2", "made available under the terms of the eclipse public license v 2 0", ("eclipse public license", "2 0")),
    ("gpl-2", "this work is licensed under the gnu general public license version 2",
     ("gnu general public license", "version 2")),
    ("gpl-3", "this work is licensed under the gnu general public license version 3",
     ("gnu general public license", "version 3")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without"
            " fee is hereby granted", ("permission to use copy modify and or distribute this software",
                                       "fee is hereby granted")),
    ("lgpl-3", "this work is licensed under the gnu lesser general public license version 3",
     ("gnu lesser general public license", "version 3")),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and"
            " associated documentation files",
     ("permission is hereby granted free of charge", "associated documentation files")),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license", "2 0")),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software", "public domain")),
)
#: Index words taken of each template's mandatory phrases.
INDEX_WORDS = 2
#: Everything but digits, a-z and characters outside ASCII separates words.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def templates() -> list[dict]:
    """Template number, base flag, label, words, and whether each word is mandatory."""
    out = []
    for n, (label, notice, phrases) in enumerate([*BASE, *MORE]):
        words = notice.split()
        must = [False] * len(words)
        for phrase in phrases:
            p = phrase.split()
            at = next(i for i in range(len(words)) if words[i:i + len(p)] == p)
            must[at:at + len(p)] = [True] * len(p)
        out.append({"template": n, "base": n < len(BASE), "label": label, "words": words, "must": must})
    return out


def split_words(text: Column) -> Column:
    return F.array_remove(F.split(lower_for_ascii(F.coalesce(text, F.lit(""))), SEPARATORS, -1), "")


def word_idf(words: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """IDF of each licence word over all rows of ``words`` (column ``words``).
    One counter a word reaches the driver: the vocabulary is that of the templates."""
    present = F.array_intersect("words", F.lit(vocabulary))
    rows = words.select(F.explode(present).alias("w")).groupBy("w").count().collect()
    found = {r["w"]: r["count"] for r in rows}
    total = words.count()
    return {w: log((1 + total) / (1 + found.get(w, 0))) for w in vocabulary}


def index_words(template: dict, idf: dict[str, float], most: int = INDEX_WORDS) -> set[str]:
    """The mandatory words of highest IDF."""
    must = {w for w, m in zip(template["words"], template["must"]) if m}
    return set(sorted(must, key=lambda w: (-idf[w], w))[:most])


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` per row."""
    spark, known = docs.sparkSession, templates()
    vocabulary = sorted({w for t in known for w in t["words"]})
    words = docs.select("doc_id", split_words(F.col("text")).alias("words"))
    idf = word_idf(words, vocabulary)
    rare = {t["template"]: index_words(t, idf) for t in known}
    looked_up = sorted({w for ws in rare.values() for w in ws})

    # Texts with an index word keep the places of all licence words; others keep none.
    at = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("w"))),
                  lambda x: x["w"].isin(vocabulary))
    hit = F.arrays_overlap("words", F.lit(looked_up))
    none = F.array().cast("array<struct<at:int,w:string>>")
    rows = materialise(words.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                                    F.size("words").cast("long").alias("n_words"),
                                    F.when(hit, at).otherwise(none).alias("at")), "licence-words")

    postings = spark.createDataFrame(
        [(t["template"], q, w, w in rare[t["template"]], t["must"][q])
         for t in known for q, w in enumerate(t["words"])],
        "template int, q int, w string, rare boolean, must boolean")  # fixed size: the templates' words
    about = spark.createDataFrame(
        [(t["template"], t["base"], t["label"], len(t["words"]), sum(t["must"]),
          sum(m and w in rare[t["template"]] for w, m in zip(t["words"], t["must"]))) for t in known],
        "template int, base boolean, label string, length int, n_must int, n_rare int")

    votes = (rows.select("row", F.inline("at")).join(F.broadcast(postings), "w")
             .groupBy("row", "template", (F.col("at") - F.col("q")).alias("start"))
             .agg(F.count_if("must").alias("must"), F.count_if(F.col("rare") & F.col("must")).alias("rare"),
                  F.count("*").alias("agree"), F.min(F.when(F.col("must"), F.col("at"))).alias("first")))
    places = (votes.join(F.broadcast(about), "template")
              .where((F.col("rare") == F.col("n_rare")) & (F.col("must") == F.col("n_must"))))
    found = places.groupBy("row").agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max(F.col("agree") / F.col("length")).alias("score"))
    return rows.select("row", "doc_id", "n_words").join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def oracle_sql() -> str:
    """The same from the definition: every template laid on every alignment that
    any of its mandatory words suggests, without an index."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    t = ", ".join(f"({x['template']}, {x['base']}, '{x['label']}', {q}, '{w}', {x['must'][q]}, "
                  f"{len(x['words'])}, {sum(x['must'])})" for x in templates() for q, w in enumerate(x["words"]))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
       regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
t(template, base, label, q, w, must, length, n_must) AS (VALUES {t}),
w AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS p FROM d),
votes AS (SELECT r, template, base, label, length, n_must, p - q AS start, count(*) AS agree,
                 count(*) FILTER (must) AS n, min(p) FILTER (must) AS first
          FROM w JOIN t USING (w) GROUP BY ALL),
f AS (SELECT r, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word,
             max(first) FILTER (base) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label)
             FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
             max(agree / length) AS score
      FROM votes WHERE n = n_must GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN f USING (r)"""
