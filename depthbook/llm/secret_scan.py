"""Secrets in texts: fixed patterns, and random-looking strings by two character Markov models.

Base findings come from three patterns. The method adds strings of 20 and more characters that a model of random
strings explains better than a model of ordinary identifiers: both are tables of how often a character follows another,
and a string's score is the mean logarithm of the ratio of the two, in thousandths.

The models are trained from labelled samples. Ordinary: words of the corpus of 6 to 19 characters that no base
pattern marks, so none that is to be judged. Random: what the base patterns mark, and for every sampled document the hash of its id written in
three alphabets. Sampled are all documents up to `fit_rows`, beyond that an even share by the hash of the id. The
tables are at most 67 x 67 whole numbers, so they are held in the plan as one literal.

All of it is column expressions: matches are found by splitting at the pattern, positions are sums of lengths.

Cases: null and empty texts have no findings; repeated rows have equal findings; null ids are carried along; an empty
table gives no rows, and a model trained on nothing finds nothing; other columns are ignored, or kept by `redacted`.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depthbook.llm.common import let, table, text_of
from depthbook.llm.spans import spans

# The base patterns. Letters of names stand for either case of ASCII only.
NAMES = ["password", "passwd", "secret", "token", "api_?key"]
_EITHER = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name) for name in NAMES)
ASSIGN = rf"""({_EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # runs are maximal, so asking for 24 finds the same as dropping shorter ones
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_-="
LEAST_RANDOM = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST_RANDOM},}}"
ORDINARY = r"[A-Za-z0-9+/_=-]{6,}"
KINDS = ["assign", "access", "hex", "random"]

#: The bound of the training sample. Everything else covers all documents.
FIT_ROWS = 4_000
#: Added to each pair's count: little for ordinary words, whose pairs are few, and more for random strings, which
#: have all pairs about equally often. Then the least mean log ratio (thousandths of a nat) of a finding.
SMOOTH = 0.5
SMOOTH_RANDOM = 10
LEAST_SCORE = 1_000


def base_findings(text: Column) -> dict[str, Column]:
    """By kind: array of (start, end, value)."""
    return {
        "assign": F.filter(spans(text, ASSIGN, 2), lambda s: F.length(s["value"]) >= LEAST_ASSIGN),
        "access": F.filter(spans(text, ACCESS), lambda s: s["end"] - s["start"] >= LEAST_ACCESS),
        "hex": spans(text, HEX),
    }


def _pairs(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(word) - 1), lambda i: F.substring(word, i, F.lit(2)))


def _value_texts(text: Column) -> Column:
    """What the base patterns mark, without positions."""
    found = F.concat(
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
    )
    return F.filter(found, lambda v: F.length(v) >= LEAST_ASSIGN)


def fit_models(docs: DataFrame, fit_rows: int = FIT_ROWS) -> list[int]:
    """Log ratios (thousandths) of all pairs of ALPHABET, random against ordinary."""
    n = docs.count()
    rows = docs.select("doc_id", text_of("text").alias("text"))
    if n > fit_rows:
        rows = rows.where(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 8) < f"{fit_rows * 2**32 // n:08x}")
    key = F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 256)
    base64 = F.base64(F.unhex(key))
    drawn = F.array(base64, key, F.upper(F.translate(base64, "+/=", "")))
    marked = rows.select(_value_texts(F.col("text")).alias("marked"), drawn.alias("drawn"), "text")
    short = F.filter(F.regexp_extract_all("text", F.lit(ORDINARY), F.lit(0)), lambda w: F.length(w) < LEAST_RANDOM)
    ordinary = F.array_except(short, F.col("marked"))
    labelled = marked.select(
        F.explode(
            F.concat(
                F.transform(F.concat("marked", "drawn"), lambda w: F.struct(F.lit(1).alias("random"), w.alias("word"))),
                F.transform(ordinary, lambda w: F.struct(F.lit(0).alias("random"), w.alias("word"))),
            )
        ).alias("of")
    )
    pairs = labelled.select("of.random", F.explode(_pairs(F.col("of.word"))).alias("pair"))
    # At most one row per label and pair of ASCII characters.
    counted = pairs.where(F.col("pair").rlike("^[A-Za-z0-9+/_=-]{2}$")).groupBy("random", "pair").count().collect()
    counts = {(r["random"], r["pair"]): r["count"] for r in counted}
    size = len(ALPHABET) ** 2
    added = {0: SMOOTH, 1: SMOOTH_RANDOM}
    total = {k: sum(v for (kind, _), v in counts.items() if kind == k) + added[k] * size for k in (0, 1)}
    if total[0] == SMOOTH * size:
        return [0] * size
    ratio = lambda p: math.log((counts.get((1, p), 0) + SMOOTH_RANDOM) / total[1] / ((counts.get((0, p), 0) + SMOOTH) / total[0]))
    return [math.floor(1000 * ratio(a + b) + 0.5) for a in ALPHABET for b in ALPHABET]


def score(word: Column, ratios: list[int]) -> Column:
    """Mean log ratio of a word's pairs, in thousandths."""
    literal = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<int>")  # folded to one literal
    place = lambda i: F.instr(F.lit(ALPHABET), F.substring(word, i, F.lit(1))) - 1
    sums = F.aggregate(
        F.sequence(F.lit(1), F.length(word) - 1),
        F.lit(0).cast("long"),
        lambda a, i: a + F.get(literal, place(i) * len(ALPHABET) + place(i + 1)),
    )
    return sums / (F.length(word) - 1)


def findings(docs: DataFrame, ratios: list[int]) -> DataFrame:
    """The documents' columns and `found`: by kind an array of (start, end, value), in characters, end exclusive."""
    text = text_of("text")

    def random(base: dict[str, Column]) -> Column:
        inside = lambda s, of: F.exists(of, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))
        found = F.filter(spans(text, CANDIDATE), lambda s: score(s["value"], ratios) >= LEAST_SCORE)
        return F.filter(found, lambda s: ~(inside(s, base["assign"]) | inside(s, base["access"]) | inside(s, base["hex"])))

    base = base_findings(text)
    named = F.struct(*[base[k].alias(k) for k in base])
    full = lambda b: F.struct(*[b[k].alias(k) for k in base], random(b).alias("random"))
    return docs.withColumn("found", let(named, full))


def _listing(found: Column, kinds: list[str]) -> Column:
    """kind:start:end by start, then by kind as listed, joined by commas."""

    def of_kind(number: int) -> Column:
        place = lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"))
        return F.transform(found[kinds[number]], place)

    rows = F.concat(*map(of_kind, range(len(kinds))))
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(F.array_sort(rows), lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ","
    )


def secret_report(docs: DataFrame, ratios: list[int]) -> DataFrame:
    """doc_id, the counts per kind, the digest of the base findings and the list of all."""
    rows = findings(docs.select("doc_id", "text"), ratios)
    found = F.col("found")
    return rows.select(
        "doc_id",
        *[F.size(found[k]).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_listing(found, KINDS[:3]), 256).alias("base_sha256"),
        _listing(found, KINDS).alias("spans"),
    )


def redacted(docs: DataFrame, ratios: list[int]) -> DataFrame:
    """The documents with every secret's text replaced by `<secret>`; a name before it stays. Columns as they are.

    Kinds are replaced one after the other, which equals replacing them at once: access keys and hexadecimal runs lie
    wholly inside an assigned value or apart from it, since all their characters may stand in one.
    """
    mask = "<secret>"

    def replace(text: Column, pattern: str, keep, masked) -> Column:
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        of = F.struct(text.alias("t"), hits.alias("hits"))

        def rebuilt(s: Column) -> Column:
            ends = F.transform(s["hits"], lambda h: F.when(keep(h), h).otherwise(masked(h)))
            # One gap more than matches, so the last gap is followed by nothing.
            return F.array_join(
                F.zip_with(F.split(s["t"], pattern, -1), ends, lambda g, e: F.concat(g, F.coalesce(e, F.lit("")))), ""
            )

        return let(of, lambda s: F.when(F.size(s["hits"]) == 0, s["t"]).otherwise(rebuilt(s)))

    value = lambda h: F.regexp_extract(h, ASSIGN, 2)
    hidden = lambda h: F.lit(mask)
    text = text_of("text")
    text = replace(text, ASSIGN, lambda h: F.length(value(h)) < LEAST_ASSIGN, lambda h: F.concat(F.substring(h, F.lit(1), F.length(h) - F.length(value(h))), F.lit(mask)))
    text = replace(text, ACCESS, lambda h: F.length(h) < LEAST_ACCESS, hidden)
    text = replace(text, HEX, lambda h: F.lit(False), hidden)
    text = replace(text, CANDIDATE, lambda h: score(h, ratios) < LEAST_SCORE, hidden)
    return docs.withColumn("text", F.when(F.col("text").isNotNull(), text))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_report(docs, fit_models(docs))


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _sql_spans(kind: int, pattern: str, group: int, condition: str) -> str:
    """SQL for rows (k, kind, s, e, v) of a pattern's matches."""
    pattern = _sql_text(pattern)
    return f"""
  SELECT k, {kind} AS kind, s, s + length(h) AS e, v FROM (
    SELECT k, hits[i] AS h, vals[i] AS v,
           list_sum(list_transform(gaps[1:i], lambda g: length(g)))
             + coalesce(list_sum(list_transform(hits[1:i - 1], lambda g: length(g))), 0) AS s
    FROM (
      SELECT k, hits, vals, gaps, unnest(range(1, len(hits) + 1)) AS i FROM (
        SELECT k, regexp_extract_all(t, {pattern}) AS hits, regexp_extract_all(t, {pattern}, {group}) AS vals,
               regexp_split_to_array(t, {pattern}) AS gaps
        FROM texts)))
  WHERE {condition}"""


_MARKED = " || ".join(f"regexp_extract_all(t, {_sql_text(p)}, {g})" for p, g in ((ASSIGN, 2), (ACCESS, 0), (HEX, 0)))
_BASE64 = "to_base64(unhex(sha256(id)))"
#: For tables of at most FIT_ROWS documents, all of which the models are fitted on.
ORACLE_OP2 = f"""
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, coalesce(CAST(doc_id AS VARCHAR), '') AS id FROM documents),
marks AS (SELECT *, list_filter({_MARKED}, lambda v: length(v) >= {LEAST_ASSIGN}) AS marked FROM texts),
samples AS (
  SELECT 1 AS random, unnest(marked || [{_BASE64}, sha256(id), upper(translate({_BASE64}, '+/=', ''))]) AS word FROM marks
  UNION ALL
  SELECT 0, unnest(list_distinct(list_filter(regexp_extract_all(t, {_sql_text(ORDINARY)}),
                                             lambda w: length(w) < {LEAST_RANDOM} AND NOT list_contains(marked, w)))) FROM marks),
pairs AS (
  SELECT random, substr(word, i, 2) AS pair FROM (SELECT random, word, unnest(range(1, length(word))) AS i FROM samples)
  WHERE regexp_full_match(substr(word, i, 2), '[A-Za-z0-9+/_=-]{{2}}')),
counts AS (
  SELECT pair, count(*) FILTER (random = 1) AS r, count(*) FILTER (random = 0) AS o FROM pairs GROUP BY pair),
totals AS (
  SELECT coalesce(sum(r), 0) + {SMOOTH_RANDOM * len(ALPHABET) ** 2} AS tr, coalesce(sum(o), 0) + {SMOOTH * len(ALPHABET) ** 2} AS t_o,
         coalesce(sum(o), 0) > 0 AS any_o FROM counts),
base AS ({_sql_spans(0, ASSIGN, 2, f"length(v) >= {LEAST_ASSIGN}")}
  UNION ALL {_sql_spans(1, ACCESS, 0, f"length(h) >= {LEAST_ACCESS}")}
  UNION ALL {_sql_spans(2, HEX, 0, "true")}),
tokens AS ({_sql_spans(3, CANDIDATE, 0, "true")}),
scored AS (
  SELECT k, s, e, sum(CASE WHEN any_o THEN floor(1000 * ln((coalesce(r, 0) + {SMOOTH_RANDOM}) / tr
                        / ((coalesce(o, 0) + {SMOOTH}) / t_o)) + 0.5) ELSE 0 END) / (e - s - 1) AS score
  FROM (SELECT *, unnest(range(1, length(v))) AS i FROM tokens)
  LEFT JOIN counts ON pair = substr(v, i, 2) CROSS JOIN totals GROUP BY k, s, e),
every AS (
  SELECT k, kind, s, e FROM base
  UNION ALL
  SELECT k, 3, s, e FROM scored c WHERE score >= {LEAST_SCORE}
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.k = c.k AND b.s <= c.s AND c.e <= b.e)),
listed AS (
  SELECT k, {", ".join(f"count(*) FILTER (kind = {i}) AS n_{name}" for i, name in enumerate(KINDS))},
         string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER (kind < 3) AS first,
         string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind) AS spans
  FROM (SELECT *, ['assign', 'access', 'hex', 'random'][kind + 1] AS name FROM every) GROUP BY k)
SELECT doc_id, {", ".join(f"coalesce(n_{name}, 0) AS n_{name}" for name in KINDS)},
       sha256(coalesce(first, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (k)
"""
