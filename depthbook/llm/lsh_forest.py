"""Near-duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets.

1. A document's set is its distinct five-word shingles (64-bit hashes; the 128-bit digest of the sorted set names it).
   Documents with equal sets form a class; everything after works on classes.
2. A signature has 32 numbers of four 16-bit minima each. Tree t of the forest sorts classes by numbers t, t+1, ...
   A region is what agrees on number t, that is four minima; a pair at similarity 0.75 shares a region in some tree
   with probability 1 - 5e-6.
3. Candidates are the next `NEIGHBOURS` of a class in a tree's order that lie in its region: the longest common
   prefixes come first, so the depth adapts to how dense a region is. Regions of more than `MOST_IN_REGION` classes
   are split at the following numbers, and past those by a salt, so that none is sorted in one task.
4. Candidates are confirmed on full sets, in two steps: for every class its most frequent partner; then, of the other
   candidates, those whose classes are not connected yet.
5. Where a region held more classes than the neighbours cover, links between components could still be missing. These
   classes take an exact pass: linked sets share one of the smallest hashes of each (prefix filter). Only hashes found
   in several components matter; for their classes the filter is repeated in the order of rarity, with a bound from
   the hashes' places, and gives pairs of components. A set whose own hashes, that no one else has, are too many is
   out; the distances between the components' pivots and of members to their pivot leave, by the triangle
   inequality, few pairs of members to confirm. So the limit costs no link.

Cases: null or empty texts have an empty set and stay alone; texts of fewer than five words have one shingle; rows that
repeat an id are all kept as rows, and equal rows are in one class; a null id never is the smallest unless the whole
component has null ids; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from depthbook.llm.common import checkpointed, forget, python_path, stored, table, text_key, text_of
from depthbook.llm.components import components

SHINGLE = 5
#: Links have 100 * intersection >= 75 * union.
PERCENT = 75
TREES = 32
DEPTH = 4
NEIGHBOURS = 4
MOST_IN_REGION = 400
#: Members of a component that the exact pass holds together.
BLOCK = 32
#: Distinct words whose hashes a Python worker remembers before it starts anew.
MOST_WORDS = 300_000

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(0, 2**63, SHINGLE * 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLY = _random.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _random.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_hashes = _WordHashes()


def _forgetting(run: Callable) -> Callable:
    """What a task remembers of words goes when it ends: its Python worker lives on."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _hashes.clear()

    return wrapped


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole number (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a text, A-Z taken as a-z."""
    words = text.lower().split()  # on bytes: ASCII letters, and exactly the six ASCII white-space characters
    n = len(words)
    if not n:
        return np.empty(0, dtype=np.uint64)
    if len(_hashes) > MOST_WORDS:
        _hashes.clear()
    hashed = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=n)
    if n < SHINGLE:
        return _mixed(np.array([np.sum(hashed * _FACTORS[SHINGLE : SHINGLE + n]) + np.uint64(n)], dtype=np.uint64))
    total = np.zeros(n - SHINGLE + 1, dtype=np.uint64)
    for k in range(SHINGLE):
        total += hashed[k : n - SHINGLE + 1 + k] * _FACTORS[k]
    return np.unique(_mixed(total))


def signature(found: np.ndarray) -> np.ndarray:
    """The trees' numbers: TREES 64-bit integers of DEPTH minima each."""
    least = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 512):
        part = found[at : at + 512]
        np.minimum(least, (part[:, None] * _MULTIPLY + _ADD).min(axis=0), out=least)
    minima = (_mixed(least) >> np.uint64(48)).reshape(TREES, DEPTH)
    numbers = np.zeros(TREES, dtype=np.uint64)
    for k in range(DEPTH):
        numbers = (numbers << np.uint64(16)) | minima[:, k]
    return numbers.view(np.int64)


@_forgetting
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, numbers = [], [], []
        for text in batch.column(2):
            found = shingles(text.as_py() or b"")
            sizes.append(len(found))
            digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            numbers.append(signature(found) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(numbers, pa.list_(pa.int64())),
            ],
            ["doc_id", "text_key", "n_shingles", "digest", "numbers"],
        )


@_forgetting
def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, text_a, text_b) with the sizes of the sets' intersection and union."""
    last, known = None, None
    for batch in batches:
        a = batch.column(0).to_pylist()
        shared, union = [], []
        for i, (text_a, text_b) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            if known is None or a[i] != last:
                last, known = a[i], shingles(text_a.as_py())
            both = np.concatenate([known, shingles(text_b.as_py())])
            both.sort()
            shared.append(int(np.count_nonzero(both[1:] == both[:-1])))
            union.append(len(both) - shared[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(union, pa.int64())],
            ["a", "b", "shared", "of_all"],
        )


@_forgetting
def _linked_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the members of one list and those of another that the bounds do not rule out."""
    for batch in batches:
        links = []
        for at in range(len(batch)):
            row = batch.slice(at, 1).to_pylist()[0]  # a row holds up to two blocks of whole texts
            own, sets = row["members"], {}
            for q in row["partners"]:
                for p in own:
                    if p["away"] + q["away"] < q["far"] or p["size"] > q["reach"] or q["size"] > p["reach"]:
                        continue
                    for x in (p, q):
                        if x["node"] not in sets:
                            sets[x["node"]] = shingles(x["text"])
                    both = np.concatenate([sets[p["node"]], sets[q["node"]]])
                    both.sort()
                    shared = int(np.count_nonzero(both[1:] == both[:-1]))
                    if 100 * shared >= PERCENT * (len(both) - shared):
                        links.append(sorted((p["node"], q["node"])))
        a, b = ([link[i] for link in links] for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


@_forgetting
def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(text.as_py()).view(np.int64) for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "tokens"]
        )


def _prefix(size):
    """How many of a set's first elements hold one that any linked set has among its own first ones."""
    return size - F.ceil(size * PERCENT / 100) + 1


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.select("a", "b").join(left, "a").join(right, "b")
    return rows.select("a", "b", "text_a", "text_b").mapInArrow(_measured, "a long, b long, shared long, of_all long")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    return _compared(pairs, texts).where(f"100 * shared >= {PERCENT} * of_all").select("a", "b")


def _between(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components; a node without a link is its own component."""
    for end in ("a", "b"):
        own = roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        pairs = pairs.join(own, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    return pairs.where("root_a <> root_b")


def _candidates(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a < b, times) from the trees' orders, and the nodes of regions that the neighbours do not cover."""
    at = lambda k: F.get("numbers", (F.col("tree") + k) % TREES)
    rows = classes.select("node", "numbers", F.posexplode("numbers").alias("tree", "region"))
    rows = rows.select("node", F.col("tree").cast("byte").alias("tree"), "region", at(1).alias("n1"), at(2).alias("n2"))
    crowded = lambda keys: (
        rows.groupBy("tree", *keys).count().where(F.col("count") > MOST_IN_REGION).withColumnRenamed("count", f"of_{len(keys)}")
    )
    for keys in (["region"], ["region", "n1"], ["region", "n1", "n2"]):
        rows = rows.join(checkpointed(crowded(keys)), ["tree", *keys], "left")
    salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("of_3") / MOST_IN_REGION))
    deep = rows.select(
        "node",
        "tree",
        "region",
        F.when(F.col("of_1").isNotNull(), F.col("n1")).alias("d1"),
        F.when(F.col("of_2").isNotNull(), F.col("n2")).alias("d2"),
        F.when(F.col("of_3").isNotNull(), salt).alias("d3"),
        "n1",
        "n2",
        F.col("of_1").isNotNull().alias("split"),
    )
    region = Window.partitionBy("tree", "region", "d1", "d2", "d3")
    order = region.orderBy("n1", "n2", "node")
    near = deep.select(
        "node",
        (F.col("split") | (F.count("*").over(region) > NEIGHBOURS + 1)).alias("open"),
        F.array_compact(F.array(*[F.lead("node", k).over(order) for k in range(1, NEIGHBOURS + 1)])).alias("next"),
    )
    near = stored(near.where(F.col("open") | (F.size("next") > 0)), "neighbours")
    pairs = near.select("node", F.explode("next").alias("other"))
    pairs = pairs.groupBy(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).agg(
        F.count("*").alias("times")
    )
    found = stored(pairs, "candidates"), checkpointed(near.where("open").select("node").distinct())
    forget(near)
    return found


def _exact_pass(open_nodes: DataFrame, texts: DataFrame, roots: DataFrame) -> DataFrame:
    """Links between components among `open_nodes`, by prefix filters."""
    found = texts.join(open_nodes, "node", "left_semi").select("node", "text")
    found = found.mapInArrow(_tokens, "node long, tokens array<long>").join(roots, "node", "left")
    found = found.withColumn("root", F.coalesce("root", "node"))
    first = found.select("node", "root", F.explode(F.slice("tokens", 1, _prefix(F.size("tokens")).cast("int"))).alias("token"))
    first = stored(first, "first-tokens")
    mixed = first.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    suspects = checkpointed(first.join(mixed, "token", "left_semi").select("node", "root").distinct())
    forget(first)
    if suspects.isEmpty():
        return suspects.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> a")
    tokens = texts.join(suspects, "node").select("node", "text").mapInArrow(_tokens, "node long, tokens array<long>")
    tokens = stored(tokens.select("node", F.size("tokens").alias("size"), F.explode("tokens").alias("token")), "tokens")
    # Elements that no one else has come first in the order of rarity; only their number matters.
    rarity = tokens.groupBy("token").agg(F.count("*").alias("times")).where("times > 1")
    ordered = tokens.join(rarity, "token").groupBy("node", "size").agg(
        F.array_sort(F.collect_list(F.struct("times", "token"))).alias("tokens")
    )
    # A set of which so many elements are left can be linked to sets of at most that size. What is left are the
    # elements that anyone else has at all, and for a common element of two sets those from its place on.
    reach = lambda left: F.floor((left * (100 + PERCENT) - F.col("size") * PERCENT) / PERCENT)
    ordered = ordered.withColumns({"reach": reach(F.size("tokens")), "alone": F.col("size") - F.size("tokens")})
    ordered = stored(ordered.where(f"100 * reach >= {PERCENT} * size").join(suspects, "node"), "ordered")
    forget(tokens)
    shared = F.greatest(_prefix(F.col("size")) - F.col("alone"), F.lit(0)).cast("int")
    postings = ordered.select(
        "node", "root", "size", "alone", F.posexplode(F.slice("tokens", 1, shared)).alias("place", "t")
    )
    most = reach(F.col("size") - F.col("alone") - F.col("place")).alias("most")
    postings = stored(postings.select("node", "root", "size", F.col("t.token").alias("token"), most), "postings")
    suspects = stored(ordered.select("node", "root", "size", "reach"), "suspects")
    forget(ordered)
    held = postings.groupBy("token", "root").agg(F.min("size").alias("low"), F.max("most").alias("most"))
    sides = held.alias("x").join(held.alias("y"), "token")
    sides = sides.where("x.root < y.root and x.low <= y.most and y.low <= x.most")
    sides = stored(sides.select(F.col("x.root").alias("a"), F.col("y.root").alias("b")).distinct(), "sides")
    forget(postings)

    # Distances of pivots and of members to their own pivot (a component's smallest node) bound those of members.
    distance = F.col("of_all") - F.col("shared")
    far = (distance / F.col("of_all") - (1 - PERCENT / 100) - 1e-9).alias("far")
    pairs = sides
    sides = stored(_compared(pairs, texts).select(F.col("a").alias("root_a"), F.col("b").alias("root_b"), far), "distances")
    forget(pairs)
    ends = sides.select(F.explode(F.array("root_a", "root_b")).alias("root")).distinct()
    members = suspects.join(ends, "root", "left_semi").select(F.col("root").alias("a"), F.col("node").alias("b"))
    away = _compared(members, texts).select(F.col("b").alias("node"), (distance / F.col("of_all")).alias("away"))
    away = stored(away.join(suspects, "node"), "members")
    sized = away.groupBy("root").agg(F.max("away").alias("widest"), F.count("*").alias("members"))
    sized = checkpointed(sized)
    for end in ("a", "b"):
        sides = sides.join(sized.select(*[F.col(c).alias(f"{c}_{end}") for c in sized.columns]), f"root_{end}")
    # The larger component of a pair is held in blocks; the members of its partners meet it in blocks too.
    larger = F.col("members_a") >= F.col("members_b")
    sides = sides.where("widest_a + widest_b >= far").select(
        F.when(larger, F.col("root_a")).otherwise(F.col("root_b")).alias("root"),
        F.when(larger, F.col("root_b")).otherwise(F.col("root_a")).alias("partner"),
        F.when(larger, F.col("widest_a")).otherwise(F.col("widest_b")).alias("widest"),
        "far",
    )
    of_partner = away.withColumnRenamed("root", "partner")
    partners = sides.join(of_partner, "partner").where("away + widest >= far").drop("widest", "partner")
    wanted = away.join(sides.select("root").distinct(), "root", "left_semi").withColumn("far", F.lit(0.0))
    blocks = _blocks(wanted, texts, "members").join(_blocks(partners, texts, "partners"), "root")
    return blocks.select("members", "partners").mapInArrow(_linked_in_blocks, "a long, b long")


def _blocks(rows: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """Rows per root in lists of about BLOCK, with texts."""
    counts = rows.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).alias("n"))
    fields = ["node", "away", "size", "reach", "far", "text"]
    rows = rows.join(counts, "root").join(texts.select("node", "text"), "node")
    block = F.pmod(F.xxhash64("node"), F.col("n")).alias("block")
    return rows.groupBy("root", block).agg(F.collect_list(F.struct(*fields)).alias(name)).drop("block")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, text_key (tells rows of one id apart), n_shingles, component_id, kept."""
    spark = docs.sparkSession
    python_path(spark)
    docs = docs.select(F.col("doc_id").cast("long"), text_key("text").alias("text_key"), text_of("text").alias("text"))
    signed = docs.select("doc_id", "text_key", F.col("text").cast("binary").alias("text")).mapInArrow(
        _sign, "doc_id long, text_key long, n_shingles long, digest binary, numbers array<long>"
    )
    signed = stored(signed, "signed")
    classes = (
        signed.where("n_shingles > 0")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.min(F.struct("doc_id", "text_key")).alias("of"),
            F.any_value("numbers").alias("numbers"),
        )
    )
    # Numbered once, in the table that all later steps read.
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    candidates, open_nodes = _candidates(classes)
    wanted = candidates.select(F.explode(F.array("a", "b")).alias("node")).union(open_nodes).distinct()
    wanted = wanted.join(classes, "node").select("node", F.col("of.doc_id").alias("own_id"), F.col("of.text_key").alias("own_key"))
    texts = docs.join(wanted, (F.col("text_key") == F.col("own_key")) & F.col("doc_id").eqNullSafe(F.col("own_id")))
    texts = texts.groupBy("node").agg(F.any_value(F.col("text").cast("binary")).alias("text"))
    texts = stored(texts, "texts")

    best = candidates.groupBy("b").agg(F.max_by("a", F.struct("times", "a")).alias("a"))
    links = stored(_confirmed(best, texts), "links")
    roots = checkpointed(components(links))
    rest = _between(candidates, roots)
    links = links.union(stored(_confirmed(rest, texts), "links"))
    forget(candidates)
    roots = checkpointed(components(links))
    more = stored(_exact_pass(open_nodes, texts, roots), "links")
    if not more.isEmpty():
        roots = components(links.union(more))

    ids = classes.select("node", "digest", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = ids.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = ids.join(named, "root").select("digest", "component_id")
    out = signed.drop("numbers").join(named, "digest", "left")
    out = out.withColumn("component_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    out = stored(out.select("doc_id", "text_key", "n_shingles", "component_id", kept.alias("kept")), "near-duplicates")
    forget(signed, classes, texts)
    return out


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that `near_duplicates` keeps; columns as they are."""
    kept = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("__kept"), F.col("text_key").alias("__of")).distinct()
    keyed = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__key": text_key("text")})
    found = keyed.join(kept, (F.col("__key") == F.col("__of")) & F.col("__id").eqNullSafe(F.col("__kept")), "left_semi")
    return found.drop("__id", "__key")


def op5_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


ORACLE_OP5 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY x, y),
links AS (
  SELECT x, y FROM pairs JOIN sizes s ON x = s.doc_id JOIN sizes t ON y = t.doc_id
  WHERE 100 * shared >= {PERCENT} * (s.n + t.n - shared)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x, y FROM edges UNION SELECT r.x, b.y FROM reach r JOIN edges b ON r.y = b.x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, y) AS component_id,
       d.doc_id = least(d.doc_id, y) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON d.doc_id = x
"""
