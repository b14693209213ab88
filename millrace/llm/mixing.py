"""Mixing sources to target weights: repetition rates per source, whole copies plus one seeded coin per document."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import coin, look_up, numbered, query, table, text_or_empty, word_count
from millrace.session import settle

#: Weights of the sources in code point order (null last), repeating.
CYCLE = (3, 1, 2)
#: Size of the mix as a share of all words, and the most that a source may give as a multiple of its words.
SHARE, MOST = Fraction(3, 2), 2


def source_targets(
    sizes: DataFrame, source: str = "source", cycle: Sequence[int] = CYCLE, share: Fraction = SHARE, most: int = MOST
) -> DataFrame:
    """One row per source: source, source_size, target.

    ``sizes`` has a source and a ``size`` per document. Targets follow the weights, stop at ``most`` times the source's
    words, and what is over goes to the other sources by weight until none is above. Each round of that is one aggregate
    over the sources; sums are exact integers. A source without words has target 0.
    """
    per_source = sizes.groupBy(source).agg(F.sum("size").cast("long").alias("source_size"))
    ranked = numbered(per_source, [], [F.col(source).asc_nulls_last()], "__rank")
    weights = F.array(*[F.lit(w) for w in cycle])
    exact = "decimal(38,0)"
    stored = settle(
        ranked.withColumn("__w", F.get(weights, (F.col("__rank") % len(cycle)).cast("int")).cast(exact))
        .withColumn("__cap", (F.lit(most) * F.col("source_size")).cast(exact)).drop("__rank"), "targets")
    whole = stored.agg(F.sum("source_size").alias("n"), F.sum("__w").alias("w")).first()
    goal, weight = share.numerator * int(whole["n"] or 0), int(whole["w"] or 0)
    num, den = goal, share.denominator * weight
    while True:
        full = F.col("__cap") * F.lit(den).cast(exact) <= F.lit(num).cast(exact) * F.col("__w")
        row = stored.filter(full).agg(F.sum("__cap").alias("c"), F.sum("__w").alias("w")).first()
        rest = goal - share.denominator * int(row["c"] or 0), share.denominator * (weight - int(row["w"] or 0))
        if rest == (num, den) or rest[1] == 0:
            break
        num, den = rest
    even = (F.lit(num).cast(exact) * F.col("__w")).cast("double") / F.lit(float(max(den, 1)))
    return stored.withColumn("target", F.when(full, F.col("__cap").cast("double")).otherwise(even)).drop("__w", "__cap")


def plan_mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             seed: str = "mix", **targets) -> DataFrame:
    """The documents with size, source_size, target and copies (long: how often the mix takes the document).

    copies is floor(rate) plus one with probability rate - floor(rate), by a coin on seed and id, so that reruns agree;
    rate is the source's target / source_size. A null text counts no words. A null source is a source of its own, last
    in order. A null id tosses by the text; rows with equal ids share a coin. Documents without words keep the rate
    of their source. Columns of the same names as the added ones are replaced; others are kept.
    """
    sized = docs.withColumn("size", word_count(text_or_empty(text)))
    targets_of = settle(source_targets(sized.select(source, "size"), source, **targets), "mix")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    toss = coin(seed, F.coalesce(F.col(doc_id).cast("string"), F.md5(text_or_empty(text).cast("binary"))))
    joined = look_up(sized.drop("source_size", "target", "copies"), targets_of, [source])
    return joined.withColumn("copies", F.floor(rate) + F.when(toss < rate - F.floor(rate), 1).otherwise(0))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents, each as often as the mix takes it, in the columns of the input. Options as in plan_mix."""
    planned = plan_mix(docs.select(F.struct("*").alias("__doc"), *[
        F.col(options.get(k, k)).alias(k) for k in ("doc_id", "text", "source")]), **{
        k: v for k, v in options.items() if k not in ("doc_id", "text", "source")})
    copied = planned.filter("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return copied.select("__doc.*")


OP10 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS n,
         CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS HUGEINT) AS w
  FROM d GROUP BY source
), o AS (
  SELECT *, row_number() OVER f AS k, sum(2 * n) OVER f - 2 * n AS caps, sum(w) OVER f - w AS ws,
         sum(n) OVER () AS total, sum(w) OVER () AS weight
  FROM s WINDOW f AS (ORDER BY 2 * n / CAST(w AS DOUBLE), source NULLS LAST ROWS UNBOUNDED PRECEDING)
), first_open AS (
  SELECT 3 * total - 2 * caps AS num, 2 * (weight - ws) AS den, k FROM o
  WHERE 2 * n * 2 * (weight - ws) > (3 * total - 2 * caps) * w ORDER BY k LIMIT 1
), t AS (
  SELECT o.source, CAST(o.n AS BIGINT) AS source_size,
         CASE WHEN f.k IS NULL OR o.k < f.k THEN CAST(2 * o.n AS DOUBLE)
              ELSE CAST(f.num * o.w AS DOUBLE) / CAST(f.den AS DOUBLE) END AS target
  FROM o LEFT JOIN first_open f ON true
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         CAST(('0x' || substr(md5('mix:' || CAST(d.doc_id AS VARCHAR)), 1, 13)) AS BIGINT) / 4503599627370496.0 AS toss
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       size * (CAST(floor(rate) AS BIGINT) + CASE WHEN toss < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM r
"""


@query("op10_mix_sources", OP10)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    planned = plan_mix(docs)
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
