"""URL rules by a Bloom filter cascade.

A rule is a host and a path prefix that starts and ends with a slash. It fits its host and all subdomains, for paths
that start with its own; of several fitting rules the longest decides. The keys a URL may match are the last labels of
its host with the first directories of its path, in no more shapes than the rules have.

Which keys are listed is answered by cascades, one per verdict. Level 1 is a Bloom filter of the listed keys; level 2 one
of the keys of the corpus that level 1 takes for listed though they are not; level 3 one of the listed keys that level 2
takes for false ones; and so on until no key is taken wrongly. As the levels know every key of the corpus, membership is
exact, and no join with the list is needed. Levels are sized by the list and stand in the plan as literals; a list that
needs more than `MOST_BITS` is refused.

Cases: a null URL, or one without `://`, has an empty host and path and fits no rule; a path that does not start with a
slash fits none either; a URL that fits none is allowed; repeated rows are judged alike; null ids are carried along;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from depthbook.llm.common import let, stored, table

# The production rules.
RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}

#: The largest level: 2**25 bits are 4 MB.
MOST_BITS = 2**25
MOST_LEVELS = 40


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, "^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, "^[^/?#]*(/[^?#]*)?", 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def candidate_keys(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The keys of a URL in the shapes of the rules, longest first."""
    shapes = sorted({(r.partition("/")[0].count(".") + 1, r.count("/") - 1) for r in rules})

    def keys(labels: Column) -> Column:
        made = []
        for labels_wanted, directories in shapes:
            tail = F.array_join(F.slice(labels, -labels_wanted, labels_wanted), ".")
            head = F.regexp_extract(path, "^(?:/[^/]*){%d}/" % directories, 0)
            fits = (F.size(labels) >= labels_wanted) & (head != "") & (host != "")
            made.append(F.when(fits, F.concat(tail, head)))
        by_length = F.transform(F.array_compact(F.array(*made)), lambda k: F.struct(F.length(k).alias("n"), k.alias("key")))
        return F.transform(F.sort_array(by_length, asc=False), lambda s: s["key"])

    return let(F.split(host, r"\."), keys)


@dataclass
class Level:
    seed: int
    size: int
    hashes: int
    words: list[int]

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.seed), F.lit(j)), F.lit(self.size)) for j in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")  # folded to one literal
        tests = [F.getbit(F.get(words, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1 for p in self.positions(key)]
        result = tests[0]
        for test in tests[1:]:
            result = result & test
        return result


def _level(keys: DataFrame, count: int, rate: float, seed: int) -> Level:
    hashes = max(1, round(-math.log2(rate)))
    size = max(64, math.ceil(count * hashes / math.log(2) / 64) * 64)
    if size > MOST_BITS:
        raise ValueError(f"{count} keys need {size} bits; at most {MOST_BITS} are put into a plan")
    level = Level(seed, size, hashes, [0] * (size // 64))
    places = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("p"))
    # One row per 64 bits, and the number of bits is bounded.
    words = places.groupBy(F.floor(F.col("p") / 64).alias("at")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("word")
    )
    for row in words.collect():
        level.words[row["at"]] = row["word"]
    return level


class Cascade:
    """Exact membership of the keys of a known universe in a list."""

    def __init__(self, listed: DataFrame, universe: DataFrame):
        """Both have one column `key`; the universe may hold listed keys."""
        self.levels: list[Level] = []
        inside, outside = listed.distinct(), universe.join(listed, "key", "left_anti")
        n_in, n_out = inside.count(), outside.count()
        while n_in and len(self.levels) < MOST_LEVELS:
            # The first level lets about as many others through as there are listed keys; each next one halves its own.
            rate = 0.5 if self.levels else min(0.5, math.sqrt(0.5) * n_in / max(n_out, 1))
            level = _level(inside, n_in, rate, len(self.levels) + 1)
            self.levels.append(level)
            outside = outside.where(level.holds(F.col("key")))
            n_out = outside.count()
            inside, outside, n_in, n_out = outside, inside, n_out, n_in
        if n_in:
            raise RuntimeError(f"{n_in} keys are still taken wrongly after {MOST_LEVELS} levels")

    def holds(self, key: Column) -> Column:
        result = F.lit(len(self.levels) % 2 == 1)  # a key in all levels belongs to what the last one encodes
        for i, level in reversed(list(enumerate(self.levels))):
            result = F.when(~level.holds(key), F.lit(i % 2 == 1)).otherwise(result)
        return result


def judge(pages: DataFrame, rules: dict[str, str]) -> DataFrame:
    """page_id, host, path, rule (null: none fits), verdict."""
    spark = pages.sparkSession
    for rule in rules:
        host, slash, path = rule.partition("/")
        if not host or not slash or path and not path.endswith("/"):
            raise ValueError(f"a rule is a host and a path between slashes, not {rule!r}")
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", F.struct(host.alias("host"), path.alias("path")).alias("of"))
    rows = rows.select("page_id", "of.host", "of.path")
    keys = candidate_keys(F.col("host"), F.col("path"), rules)
    universe = stored(rows.select(F.explode(keys).alias("key")).distinct(), "url-keys")
    cascades = {}
    for verdict in sorted(set(rules.values())):
        listed = spark.createDataFrame([(k,) for k, v in rules.items() if v == verdict], "key string")
        cascades[verdict] = Cascade(listed, universe)

    def verdicts(key: Column) -> Column:
        found = F.lit(None).cast("string")
        for verdict, cascade in cascades.items():
            found = F.when(cascade.holds(key), F.lit(verdict)).otherwise(found)
        return F.struct(key.alias("rule"), found.alias("verdict"))

    hits = F.filter(F.transform(keys, verdicts), lambda s: s["verdict"].isNotNull())
    rows = rows.select("page_id", "host", "path", let(hits, lambda h: F.get(h, 0)).alias("hit"))
    return rows.select("page_id", "host", "path", "hit.rule", F.coalesce("hit.verdict", F.lit("allow")).alias("verdict"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), RULES)


_VALUES = ", ".join(f"('{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{v}')" for r, v in RULES.items())
ORACLE_OP1 = f"""
WITH rules(rule, rule_host, rule_path, verdict) AS (VALUES {_VALUES}),
rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS r FROM pages),
parts AS (
  SELECT page_id, row_number() OVER () AS n,
         translate(coalesce(regexp_extract(r, '^[^/?#]*'), ''),
                   '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         coalesce(regexp_extract(r, '^[^/?#]*(/[^?#]*)?', 1), '') AS path
  FROM rest),
best AS (
  SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (n)
"""
