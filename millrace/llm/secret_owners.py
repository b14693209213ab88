"""Secrets in texts, told apart by who owns them: a value that many owners hold is an example that went around, a value of
one owner only looks live.

Fixed patterns find the base kinds. A further kind, ``live``, is any long mixed token that is no base match and that few
owners and repositories hold in the whole corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import query, table, text_or_empty
from millrace.operators.split import join_on
from millrace.session import settle

#: Kind, pattern, group that is the value, and its least length. A match that is too short is dropped.
KEYWORD = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
KINDS = (
    ("assign", KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
)
#: Candidates of the further kind: long tokens with a digit, a lower-case and an upper-case letter.
TOKEN, TOKEN_LENGTH = "[A-Za-z0-9+/_=-]+", 20
#: What a text must hold for a kind to be searched at all; every match that counts contains it.
HINTS = {"assign": KEYWORD, "access": "AKIA[A-Z0-9]{16}", "hex": "[0-9a-f]{24}", "token": "[A-Za-z0-9+/_=-]{20}"}
#: A value is an example if more owners, or more repositories, than this hold it.
OWNERS, REPOSITORIES = 1, 3


def _found(text: Column, pattern: str, group: int, hint: str) -> Column:
    """Per match: length of the text before it (since the last match), of the match, and its value."""
    row = "array<struct<gap:int,size:int,value:string>>"
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    matches = F.transform(F.arrays_zip(gaps.alias("gap"), whole.alias("whole"), value.alias("value")), lambda m: F.struct(
        m["gap"].alias("gap"), F.length(m["whole"]).alias("size"), m["value"].alias("value")))
    return F.when(text.rlike(hint), F.filter(matches, lambda m: m["value"].isNotNull())).otherwise(
        F.array().cast(row)).cast(row)


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source",
               repository: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Stored documents (row, doc_id) and their candidates (row, doc_id, owner, repository, kind, start, end, digest).

    Positions are code points, end exclusive. A null text is empty; null owners are one owner; each row counts by itself, rows
    of equal id included. A repository is named within its owner. Places are running sums over the matches of a
    text, so many matches cost no more than linear work.
    """
    body = text_or_empty(text)
    kinds = [*KINDS, ("token", TOKEN, 0, TOKEN_LENGTH)]
    scanned = settle(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(owner).alias("owner"),
        F.struct(F.col(owner).alias("owner"), F.col(repository).alias("name")).alias("repository"),
        *[_found(body, pattern, group, HINTS[kind]).alias(kind) for kind, pattern, group, _ in kinds]), "matches")
    order = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    parts = []
    for kind, _, _, least in kinds:
        one = scanned.filter(F.size(kind) > 0).select(
            "row", "doc_id", "owner", "repository", F.lit(kind).alias("kind"), F.lit(least).alias("least"),
            F.posexplode(kind).alias("at", "m"))
        parts.append(one)
    every = parts[0]
    for one in parts[1:]:
        every = every.unionByName(one)
    end = F.sum(F.col("m.gap") + F.col("m.size")).over(order)
    placed = every.withColumn("end", end).filter(F.length("m.value") >= F.col("least")).select(
        "row", "doc_id", "owner", "repository", "kind", (F.col("end") - F.col("m.size")).alias("start"), "end",
        F.when(F.col("kind") != "token", True).otherwise(
            F.col("m.value").rlike("[0-9]") & F.col("m.value").rlike("[a-z]") & F.col("m.value").rlike("[A-Z]")).alias("ok"),
        F.sha2(F.col("m.value").cast("binary"), 256).alias("digest"))
    return scanned, settle(placed.filter("ok").drop("ok"), "candidates")


def holders(found: DataFrame) -> DataFrame:
    """Owners and repositories of each candidate value: digest, n_owners, n_repositories.

    A value is first reduced to one row per repository, then per owner, so a value that is everywhere stays small.
    """
    repositories = found.select("digest", "owner", "repository").distinct()
    owners = repositories.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("n"))
    return owners.groupBy("digest").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))


def judge(found: DataFrame, owners: int = OWNERS, repositories: int = REPOSITORIES) -> DataFrame:
    """Add ``live``: the value's holders in the corpus are at most so many owners and repositories."""
    live = (F.col("n_owners") <= owners) & (F.col("n_repositories") <= repositories)
    return join_on(found, holders(found), ["digest"]).withColumn("live", live)


def scan(docs: DataFrame, **columns: str) -> DataFrame:
    """One row per document: doc_id and ``spans``, an array of (start, rank, kind, end, live) in order of place and kind.

    Base kinds are always there, with ``live`` as the verdict on the value; a ``token`` is there if it is live.
    """
    scanned, found = candidates(docs, **columns)
    rank = F.array_position(F.array(*[F.lit(k) for k in ("assign", "access", "hex", "token")]), F.col("kind"))
    judged = judge(found).filter((F.col("kind") != "token") | F.col("live")).select(
        "row", "doc_id", F.struct("start", rank.alias("rank"), "kind", "end", "live").alias("span"))
    empty = scanned.select("row", "doc_id", F.lit(None).cast(judged.schema["span"].dataType).alias("span"))
    return judged.unionByName(empty).groupBy("row", "doc_id").agg(F.sort_array(F.collect_list("span")).alias("spans"))


OP2 = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, source AS owner, lang AS repo, row_number() OVER () AS k FROM documents
), p(kind, r, pattern, grp, least) AS (
  VALUES ('assign', 1, $assign$%(assign)s$assign$, 1, 6), ('access', 2, '%(access)s', 0, 20), ('hex', 3, '%(hex)s', 0, 24)
), x AS (
  SELECT k, doc_id, owner, repo, 'assign' AS kind, 1 AS r, 6 AS least, string_split_regex(text, $q$%(assign)s$q$) AS gaps,
    regexp_extract_all(text, $q$%(assign)s$q$, 0) AS whole, regexp_extract_all(text, $q$%(assign)s$q$, 1) AS value FROM d
  UNION ALL
  SELECT k, doc_id, owner, repo, 'access', 2, 20, string_split_regex(text, '%(access)s'),
    regexp_extract_all(text, '%(access)s', 0), regexp_extract_all(text, '%(access)s', 0) FROM d WHERE text LIKE '%%AKIA%%'
  UNION ALL
  SELECT k, doc_id, owner, repo, 'hex', 3, 24, string_split_regex(text, '%(hex)s'),
    regexp_extract_all(text, '%(hex)s', 0), regexp_extract_all(text, '%(hex)s', 0) FROM d WHERE regexp_matches(text, '[0-9a-f]{24}')
  UNION ALL
  SELECT k, doc_id, owner, repo, 'token', 4, 20, string_split_regex(text, '%(token)s'),
    regexp_extract_all(text, '%(token)s', 0), regexp_extract_all(text, '%(token)s', 0) FROM d WHERE regexp_matches(text, '[A-Za-z0-9+/_=-]{20}')
), m AS (
  SELECT k, doc_id, owner, repo, kind, r, least, unnest(gaps[1:len(whole)]) AS gap, unnest(whole) AS whole, unnest(value) AS value,
    generate_subscripts(whole, 1) AS i FROM x WHERE len(whole) > 0
), s AS (
  SELECT *, sum(length(gap) + length(whole)) OVER (PARTITION BY k, kind ORDER BY i ROWS UNBOUNDED PRECEDING) AS stop FROM m
), c AS (
  SELECT k, doc_id, owner, repo, kind, r, stop - length(whole) AS start, stop, value FROM s
  WHERE length(value) >= least AND (kind <> 'token' OR
    (regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')))
), h AS (
  SELECT value, count(DISTINCT coalesce(owner, '\\0')) AS n_owners, count(DISTINCT (owner, repo)) AS n_repos FROM c GROUP BY value
), l AS (
  SELECT c.*, n_owners <= 1 AND n_repos <= 3 AS live FROM c JOIN h USING (value)
), a AS (
  SELECT k, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, r) FILTER (kind <> 'token') AS base,
    string_agg(CASE kind WHEN 'token' THEN 'live' ELSE kind END || ':' || start || ':' || stop, ',' ORDER BY start, r)
      FILTER (kind <> 'token' OR live) AS spans,
    count(*) FILTER (live) AS n_live
  FROM l GROUP BY k
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN a USING (k)
""" % {k: p for k, p in [*((k, p) for k, p, _, _ in KINDS), ("token", TOKEN)]}


@query("op2_secret_owners", OP2)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = scan(table(spark, folder, "documents").select("doc_id", "text", "source", "lang"))
    base = F.filter("spans", lambda s: s["kind"] != "token")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    name = lambda s: F.when(s["kind"] == "token", "live").otherwise(s["kind"])
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"))
