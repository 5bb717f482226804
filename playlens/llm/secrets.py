"""Secrets in texts, told from copied examples by who owns them.

Patterns find candidates with their places. Each candidate's value is hashed, and
over the whole corpus the distinct repositories and owners holding it are counted:
a value in many hands is a published example, a value of few owners that looks
random is a live credential. Candidates of the added kinds become spans only when
they are live; spans of the base kinds stay whatever their verdict.
Built from DataFrame expressions only.

Defined results: null and empty texts have no span; a null repository or owner
counts as one of its own; rows are numbered internally, so repeated rows and
repeated or null ids each get their spans. Values, not rows, are counted: copies of
a text within one repository change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import materialise

#: A value is an example when it is found with at least this many distinct owners
#: or repositories.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 5


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# fixed values: the base patterns
_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api")).replace(
    _either_case("api"), _either_case("api") + "_?" + _either_case("key"))
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the runs of [0-9a-f]+ that are long enough
#: kind, pattern, group holding the value, least length of the value. Base kinds first.
KINDS = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24),
         ("key", r"(ghp_|gho_|github_pat_|glpat-|sk_live_|sk-|xox[abprs]-|AIza|eyJ)[A-Za-z0-9_-]{16,}", 0, 20),
         ("random", r"[A-Za-z0-9+/_-]{32,}", 0, 32))
BASE = ("assign", "access", "hex")
ORDER = {k: i for i, (k, *_) in enumerate(KINDS)}


def _candidates(text: Column, number: int) -> Column:
    """Matches of a kind: running number, characters since the match before, length, value."""
    _, pattern, group, _ = KINDS[number]
    some = text.rlike(pattern)
    whole = F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    value = F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(group)))
    gaps = F.when(some, F.transform(F.split(text, pattern, -1), F.length))
    return F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), F.transform(whole, F.length).alias("length"),
                        value.alias("value"))


def candidates(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """One row per document with all matches of all kinds."""
    text = F.coalesce("text", F.lit(""))
    kinds = [F.struct(F.lit(i).alias("kind"), _candidates(text, i).alias("m")) for i in range(len(KINDS))]
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", repository.alias("repository"),
                       owner.alias("owner"), F.filter(F.array(*kinds), lambda k: k["m"].isNotNull()).alias("kinds"))


def placed(rows: DataFrame) -> DataFrame:
    """``row, repository, owner, kind, start, end, value`` of the matches that hold.
    Starts add up the gaps and lengths of the earlier matches of a row and kind."""
    m = (rows.select("row", "repository", "owner", F.inline("kinds"))
         .select("row", "repository", "owner", "kind", F.posexplode("m").alias("i", "m")))
    before = Window.partitionBy("row", "kind").orderBy("i")
    end = F.sum(F.col("m.gap") + F.col("m.length")).over(before)
    least = F.lit([x[3] for x in KINDS])
    return (m.select("row", "repository", "owner", "kind", (end - F.col("m.length")).alias("start"), end.alias("end"),
                     F.col("m.value").alias("value"))
            .where(F.length("value") >= F.get(least, F.col("kind"))))


def ownership(found: DataFrame) -> DataFrame:
    """``h, owners, repositories`` per value. Equal (value, owner, repository) rows
    meet first, with a map-side part, so a value copied everywhere reaches the
    counting step once per repository."""
    held = found.select("h", "owner", "repository").distinct()
    owners = held.select("h", "owner").distinct().groupBy("h").agg(F.count("*").alias("owners"))
    return held.groupBy("h").agg(F.count("*").alias("repositories")).join(owners, "h")


def looks_random(value: Column) -> Column:
    """Digits and letters, and at least ten different characters."""
    return (value.rlike("[0-9]") & value.rlike("[A-Za-z]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= 10))


def scan(docs: DataFrame, repository: Column | None = None, owner: Column | None = None) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_examples`` per row.

    ``repository`` and ``owner`` name who holds a text; for the documents table the
    source is the owner and its texts of a language are a repository."""
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    rows = materialise(candidates(docs, repository, owner), "secrets")
    found = placed(rows).withColumn("h", F.xxhash64("value"))
    held = ownership(found)
    example = (F.col("owners") >= EXAMPLE_OWNERS) | (F.col("repositories") >= EXAMPLE_REPOSITORIES)
    judged = found.join(held, "h").select("row", "kind", "start", "end", example.alias("example"),
                                          (~example & looks_random(F.col("value"))).alias("live"))
    base = F.col("kind") < len(BASE)
    span = F.struct("start", "kind", "end")
    names = F.lit([k for k, *_ in KINDS])
    text = lambda c: F.array_join(F.transform(
        F.array_sort(c), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    per_row = judged.groupBy("row").agg(
        *[F.count_if(F.col("kind") == ORDER[k]).alias(f"n_{k}") for k in BASE],
        F.collect_list(F.when(base, span)).alias("base"), F.collect_list(F.when(base | F.col("live"), span)).alias("all"),
        F.count_if("live").alias("n_live"), F.count_if("example").alias("n_examples"))
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select("row", "doc_id").join(per_row, "row", "left").select(
        "doc_id", *[n(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce(text(F.col("base")), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(text(F.col("all")), F.lit("")).alias("spans"), n("n_live"), n("n_examples"))


def oracle_sql() -> str:
    q = lambda p: "'" + p.replace("'", "''") + "'"
    kinds = "\nUNION ALL ".join(
        f"SELECT r, {i} AS kind, '{k}' AS name, {least} AS least, owner, repository, regexp_extract_all(t, {q(p)}, 0) AS m,"
        f" regexp_extract_all(t, {q(p)}, {g}) AS v, regexp_split_to_array(t, {q(p)}) AS p FROM d"
        for i, (k, p, g, least) in enumerate(KINDS))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, source AS owner,
                  concat_ws('/', source, lang) AS repository FROM documents),
k AS ({kinds}),
x AS (SELECT r, kind, name, least, owner, repository, unnest(range(len(m))) AS i, unnest(m) AS m, unnest(v) AS v,
             unnest(p[1:len(m)]) AS gap FROM k WHERE len(m) > 0),
s AS (SELECT *, (sum(length(gap) + length(m)) OVER (PARTITION BY r, kind ORDER BY i))::BIGINT AS e FROM x),
f AS (SELECT r, kind, name, e - length(m) AS b, e, v, owner, repository FROM s WHERE length(v) >= least),
o AS (SELECT v, count(DISTINCT coalesce(owner, '')) AS owners,
             count(DISTINCT (coalesce(owner, ''), repository)) AS repositories FROM f GROUP BY v),
j AS (SELECT f.*, owners >= {EXAMPLE_OWNERS} OR repositories >= {EXAMPLE_REPOSITORIES} AS example,
             NOT (owners >= {EXAMPLE_OWNERS} OR repositories >= {EXAMPLE_REPOSITORIES})
             AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
             AND len(list_distinct(string_split(v, ''))) >= 10 AS live FROM f JOIN o USING (v)),
g AS (SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
             count(*) FILTER (kind = 2) AS n_hex,
             string_agg(name || ':' || b || ':' || e, ',' ORDER BY b, kind) FILTER (kind < {len(BASE)}) AS base,
             string_agg(name || ':' || b || ':' || e, ',' ORDER BY b, kind) FILTER (kind < {len(BASE)} OR live) AS spans,
             count(*) FILTER (live) AS n_live, count(*) FILTER (example) AS n_examples FROM j GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_examples, 0)::BIGINT AS n_examples
FROM d LEFT JOIN g USING (r)"""
