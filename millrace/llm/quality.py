"""Quality rules as a short-circuit cascade: measured on a sample, ordered by rejections per cost, tried until one rejects."""

from __future__ import annotations

import math
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import let, query, table, text_or_empty
from millrace.session import settle

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Documents on which costs and rejections are measured (about so many, chosen by hash).
SAMPLE_DOCS = 2000
#: How often a job works a rule out per sampled document, and jobs per rule.
PASSES, TRIALS = 4, 3


@dataclass(frozen=True)
class Rule:
    """A name and the condition under which a document is rejected (null counts as not rejected)."""

    name: str
    rejects: Column


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def repeated_words(words: Column, span: int = 5) -> Column:
    """Number of words inside windows of ``span`` words that are found twice or more, the first finding included.

    Windows are compared by a 64-bit hash; sorting brings equal ones together, so the cost is n log n. The many texts
    without any repeated window stop at the distinct count.
    """
    def covered(places: Column) -> Column:
        return F.aggregate(F.transform(places, lambda p, i: F.least(
            F.lit(span), F.coalesce(F.get(places, i + 1), p + span) - p)), F.lit(0), lambda a, x: a + x)

    def places(grams: Column) -> Column:
        ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        return let(ordered, lambda s: F.sort_array(F.transform(F.filter(F.transform(s, lambda x, i: F.struct(
            x["i"].alias("i"), (F.coalesce(F.get(s, i - 1)["g"] == x["g"], F.lit(False))
                              | F.coalesce(F.get(s, i + 1)["g"] == x["g"], F.lit(False))).alias("twice"))),
            lambda x: x["twice"]), lambda x: x["i"])))

    grams = F.when(F.size(words) >= span, F.transform(
        F.sequence(F.lit(1), F.size(words) - (span - 1)), lambda i: F.xxhash64(F.slice(words, i, span)))).otherwise(
        F.array().cast("array<bigint>"))
    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(
        let(places(g), covered)))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def measures(text: str = "text") -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) of the raw text; a null text has no words."""
    body = text_or_empty(text)
    return {
        "n_words": F.size(words_of(body)).cast("long"),
        "word_chars": F.length(F.regexp_replace(body, SPACE, "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")).cast("long"),
        "n_dup_lines": repeated_lines(body).cast("long"),
        "n_repeat_words": let(words_of(body), lambda w: repeated_words(w)).cast("long"),
    }


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures as columns; columns of the same names are replaced."""
    return docs.withColumns(measures(text))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def standard_rules(text: str = "text", found: Mapping[str, Column] | None = None) -> list[Rule]:
    """Rules on the measures and on the text itself.

    ``found`` holds the measures; without it they are columns of the table. With ``measures(text)`` every rule reads the raw
    text, so that a cascade works out only what it needs until a rule rejects.
    """
    body = text_or_empty(text)
    m = found or {name: F.col(name) for name in measures(text)}
    letters = F.length(F.regexp_replace(body, r"[^\p{L}]+", ""))
    capitals = F.length(F.regexp_replace(body, r"[^\p{Lu}]+", ""))
    return [
        Rule("too_short", m["n_words"] < 10),
        Rule("repeated_windows", 100 * m["n_repeat_words"] > 20 * m["n_words"]),
        Rule("symbols", 10 * m["n_symbols"] > m["n_words"]),
        Rule("repeated_lines", 2 * m["n_dup_lines"] > F.regexp_count(body, F.lit(r"[^\n]+"))),
        Rule("word_length", (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"])),
        Rule("few_letters", 2 * letters < m["word_chars"]),
        Rule("capitals", 2 * capitals > letters),
        Rule("shouting", 2 * F.regexp_count(body, F.lit(r"!")) > m["n_words"]),
    ]


def rate_rules(docs: DataFrame, rules: Sequence[Rule], sample_docs: int = SAMPLE_DOCS, text: str = "text") -> list[tuple[str, int, float]]:
    """Name, rejected documents and cost (seconds) of each rule on a random sample of about ``sample_docs`` documents.

    Measures that a rule names are worked out from the raw text in its own jobs, and no others, so that a cost is that of
    the rule by itself. Each is worked out ``PASSES`` times per
    document, in ``TRIALS`` jobs; its cost is the fastest of them less the fastest job that only reads the texts, at least a
    millisecond, rounded to a power of two so that small differences of time do not count.
    """
    sample = settle(docs.sample(min(1.0, sample_docs / max(docs.count(), 1)), seed=7), "sample")
    often = with_measures(sample.withColumn("__pass", F.explode(F.sequence(F.lit(1), F.lit(PASSES)))), text)

    def measured(rejects: Column) -> tuple[int, float]:
        spent, hit = [], 0
        for _ in range(TRIALS):
            began = time.perf_counter()
            hit = often.agg(F.count_if(F.coalesce(rejects, F.lit(False)))).first()[0] // PASSES
            spent.append(time.perf_counter() - began)
        return hit, min(spent)

    _, read = measured(F.length(F.col(text)) < 0)
    rated = []
    for rule in rules:
        hit, spent = measured(rule.rejects)
        rated.append((rule.name, hit, 2.0 ** round(math.log2(max(spent - read, 1e-3)))))
    return rated


def order_rules(docs: DataFrame, rules: Sequence[Rule], sample_docs: int = SAMPLE_DOCS, text: str = "text") -> list[Rule]:
    """The rules by rejections per cost, best first; equally good ones, and all on an empty table, in the given order.

    Only the work depends on the order; the set of rejected documents does not.
    """
    rated = [(-hit / cost, at) for at, (_, hit, cost) in enumerate(rate_rules(docs, rules, sample_docs, text))]
    return [rules[at] for _, at in sorted(rated)]


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that no standard rule rejects, in the columns of the input; a null text is empty and thus too short."""
    rules = order_rules(docs, standard_rules(text, measures(text)), text=text)
    return cascade(docs, rules, "__rejected_by").filter(F.col("__rejected_by").isNull()).drop("__rejected_by")


def cascade(docs: DataFrame, rules: Sequence[Rule], out: str = "rejected_by") -> DataFrame:
    """Add the name of the first rule, in the given order, that rejects the document; null: kept.

    A CASE tries its branches in turn, so a rejected document pays for no later rule.
    """
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name)).otherwise(verdict)
    return docs.withColumn(out, verdict)


OP4 = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         row_number() OVER () AS k
  FROM documents
), g AS (
  SELECT k, i, list_slice(w, i, i + 4) AS gram FROM w, unnest(range(1, greatest(len(w) - 3, 1))) AS u(i)
), twice AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, gram) AS n FROM g) WHERE n > 1
), covered AS (
  SELECT k, sum(least(5, coalesce(nxt, i + 5) - i)) AS n
  FROM (SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) AS nxt FROM twice) GROUP BY k
), m AS (
  SELECT doc_id, text, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered c USING (k)
), b AS (
  SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         length(regexp_replace(text, '[^\pL]+', '', 'g')) AS letters,
         length(regexp_replace(text, '[^\p{Lu}]+', '', 'g')) AS capitals
  FROM m
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > len(regexp_extract_all(text, '[^\n]+'))
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * letters < word_chars OR 2 * capitals > letters
    OR 2 * len(regexp_extract_all(text, '!')) > n_words) AS kept
FROM b
"""


@query("op4_quality_cascade", OP4)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    # The result holds the measures of every document, so here the rules take them from its columns.
    judged = cascade(with_measures(docs), order_rules(docs, standard_rules()))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), F.col("rejected_by").isNull().alias("kept"))
