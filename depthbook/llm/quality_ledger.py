"""Quality rules as a ledger of failure bits.

Every rule is looked at once per document: the ledger holds the measurements and one bit per failed rule. A policy is a
version and a mask of the rules it applies, so verdicts of any policy, and what each rule does alone, come from the
ledger by bit arithmetic without reading a text again.

Words are runs of characters other than the six ASCII white-space characters. All of it is column expressions; repeated
windows are found by sorting the hashes of a text's windows, in time n log n for any text.

Cases: null and empty texts have no words and fail; repeated rows have equal results; null ids are carried along; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depthbook.llm.common import let, table, text_of

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
#: Bit number is the place in this list. Conditions are over the measurements; all are whole numbers.
RULES = [
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "n_symbols > n_words"),
    ("long_words", "word_chars > 25 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("repeated_lines", "n_lines >= 4 and 2 * n_dup_lines > n_lines"),
]
BASE = ["few_words", "repeated_words"]
#: Versions of the policy and the rules they apply.
POLICIES = {
    "2024-base": BASE,
    "2024-symbols": [*BASE, "symbols"],
    "2025-all": [name for name, _ in RULES],
}
CURRENT = "2025-all"


def mask(names: list[str]) -> int:
    at = {name: i for i, (name, _) in enumerate(RULES)}
    return sum(1 << at[name] for name in names)


def _repeat_words(words: Column) -> Column:
    """Words that stand in a window of three which the text holds more than once."""
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )

    def covered(places: Column) -> Column:
        # Window starts in order: each adds its words up to the next start, three at most.
        adds = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(adds, F.lit(0), lambda a, x: a + x)

    def repeated(found: Column) -> Column:
        ordered = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

        def places(s: Column) -> Column:
            beside = lambda x, i: F.get(s, i)["h"].eqNullSafe(x["h"])
            marked = F.filter(s, lambda x, i: beside(x, i - 1) | beside(x, i + 1))
            return F.sort_array(F.transform(marked, lambda x: x["at"]))

        sure = let(let(ordered, places), covered)
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(sure)

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(hashes, repeated))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements (long) and `failed`, one bit per rule."""
    text = text_of("text")
    words = F.array_remove(F.split(text, SPACE), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    by_words = let(words, lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("repeated")))
    by_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")))
    rows = docs.select(
        "doc_id",
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        by_words.alias("w"),
        by_lines.alias("l"),
    )
    rows = rows.select(
        "doc_id",
        F.col("w.n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("l.n").cast("long").alias("n_lines"),
        (F.col("l.n") - F.col("l.distinct")).cast("long").alias("n_dup_lines"),
        F.col("w.repeated").cast("long").alias("n_repeat_words"),
    )
    failed = F.lit(0).cast("long")
    for i, (_, condition) in enumerate(RULES):
        failed = failed + F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    return rows.withColumn("failed", failed)


def passes(policy: str) -> Column:
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def ablations(rows: DataFrame) -> DataFrame:
    """Per policy and rule of it: documents, kept, failed by the rule, and failed by no other rule of the policy."""
    sums = [F.count("*").alias("n_docs")]
    for policy, names in POLICIES.items():
        seen = F.col("failed").bitwiseAND(F.lit(mask(names)))
        sums.append(F.count_if(seen == 0).alias(f"{policy} kept"))
        for name in names:
            sums.append(F.count_if(seen.bitwiseAND(F.lit(mask([name]))) != 0).alias(f"{policy} {name} failed"))
            sums.append(F.count_if(seen == mask([name])).alias(f"{policy} {name} alone"))
    lines = [
        F.struct(
            F.lit(policy).alias("policy"),
            F.lit(name).alias("rule"),
            F.col("n_docs"),
            F.col(f"`{policy} kept`").alias("n_kept"),
            F.col(f"`{policy} {name} failed`").alias("n_failed"),
            F.col(f"`{policy} {name} alone`").alias("n_alone"),
        )
        for policy, names in POLICIES.items()
        for name in names
    ]
    return rows.agg(*sums).select(F.inline(F.array(*lines)))


def op3_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ledger(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", *MEASURES, "failed", (~passes("2024-base")).alias("base_failed"), passes(CURRENT).alias("kept"))


_BITS = " + ".join(f"(CASE WHEN {condition} THEN {1 << i} ELSE 0 END)" for i, (_, condition) in enumerate(RULES))
ORACLE_OP3 = f"""
WITH texts AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
lists AS (
  SELECT k, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM texts),
windows AS (
  SELECT k, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS x
  FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS p FROM lists)),
repeats AS (
  SELECT DISTINCT k, p + d AS p
  FROM (SELECT k, p, count(*) OVER (PARTITION BY k, x) AS n FROM windows), (VALUES (0), (1), (2)) AS s(d) WHERE n > 1),
counted AS (SELECT k, count(*) AS n_repeat_words FROM repeats GROUP BY k),
measured AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM lists LEFT JOIN counted USING (k)),
marked AS (SELECT *, CAST({_BITS} AS BIGINT) AS failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, failed,
       failed & {mask(BASE)} <> 0 AS base_failed, failed & {mask(POLICIES[CURRENT])} = 0 AS kept
FROM marked
"""
