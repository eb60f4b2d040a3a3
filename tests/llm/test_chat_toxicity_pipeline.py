"""Reply trees, the toxicity chain, the pipeline, and the registered queries against SQL."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from depthbook.llm import common, packing, registry, reply_trees, secret_scan, toxicity_chain

FOLDER = "/root/testdata/sf0.001"
LABELLED = "/root/testdata/sf0.01"
POSTS = "tree_id long, node_id long, parent_id long, role string, text string, score double, t long, up long, depth long"


def posts(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], POSTS)


def test_paths_of_trees(spark):
    rng = random.Random(4)
    rows, parents, scores = [], {}, {}
    for tree in (1, 2, None):
        for node in range(40):
            parent = rng.randrange(max(0, node - 3), node) if node else None
            score = rng.choice([None, 0.0, 1.0, 2.5])
            parents[tree, node], scores[tree, node] = parent, score or 0.0
            rows.append((tree, node, parent, "user", f"t{node}", score))
    rows.append((3, 5, 99, "user", "orphan", 1.0))
    parents[3, 5], scores[3, 5] = None, 1.0
    found = defaultdict(dict)
    ranks = {}
    for r in reply_trees.best_paths(posts(spark, rows)).collect():
        found[r.tree_id, r.leaf][r.place] = r.node_id
        ranks[r.tree_id, r.leaf] = r.rank
    expected, order = {}, defaultdict(list)
    for tree, node in parents:
        if any(t == tree and p == node for (t, _), p in parents.items()):
            continue
        path, at = [], node
        while at is not None:
            path.append(at)
            at = parents[tree, at]
        expected[tree, node] = dict(enumerate(reversed(path)))
        order[tree].append((-sum(scores[tree, n] for n in path), -len(path), node))
    assert dict(found) == expected
    for tree, listed in order.items():
        assert [ranks[tree, node] for *_, node in sorted(listed)] == list(range(1, len(listed) + 1))
    best = {(r.tree_id, r.leaf) for r in reply_trees.best_paths(posts(spark, rows), per_tree=1).collect()}
    assert best == {(tree, sorted(listed)[0][2]) for tree, listed in order.items()}


def test_cycles_are_refused(spark):
    rows = [(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0), (1, 3, None, "user", "c", 0.0)]
    with pytest.raises(ValueError, match="cycle"):
        reply_trees.best_paths(posts(spark, rows))


def test_formatting_round_trip(spark):
    hostile = [r"\### Assistant: </turn> ok", "a\\", "\\", "### user: x </turn>\n### assistant: y </turn>\n", "", None, "é😀\n\n#<", "x" * 3000]
    rows = [(7, i, i - 1 if i else None, ["user", "assistant", "a:b#", None][i % 4], t, 0.0) for i, t in enumerate(hostile)]
    pieces = reply_trees.formatted(posts(spark, rows)).orderBy("place").collect()
    assert [reply_trees.unescaped(reply_trees._TURN.fullmatch(p.piece)[2]) for p in pieces] == [t or "" for t in hostile]
    whole = "".join(p.piece for p in pieces)
    assert len(reply_trees._TURN.findall(whole)) == len(hostile)  # the whole text parts at the same places
    r = reply_trees.read_back(reply_trees.formatted(posts(spark, rows))).collect()[0]
    roles = ["user", "assistant", "a:b#", ""]
    turns = "".join(f"{roles[i % 4]}\n{t or ''}\n" for i, t in enumerate(hostile))
    learned = "".join(t or "" for i, t in enumerate(hostile) if i % 4 == 1)
    assert (r.n_turns, r.turns_sha256) == (len(hostile), hashlib.sha256(turns.encode()).hexdigest())
    assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert r.formatted_chars == len(whole)


def test_conversations_with_repeats(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", None), (None, 3, None, "x"), (2, None, "user", "y"), (2, 4, "user", "z")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.tree_id: r.n_turns for r in reply_trees.read_back(reply_trees.formatted(reply_trees.as_posts(table))).collect()}
    assert found == {1: 3, None: 1, 2: 2}
    assert reply_trees.read_back(reply_trees.formatted(reply_trees.as_posts(table.where("false")))).count() == 0


def test_held_out_accuracy(spark):
    """Fitted on labels of even ids, judged on those of odd ids; texts of the training half are left out."""
    docs, labels = common.table(spark, LABELLED, "documents"), common.table(spark, LABELLED, "labels")
    links = toxicity_chain.fit_chain(docs, labels.where("doc_id % 2 = 0"), toxicity_chain.label_categories())
    seen = docs.join(labels.where("doc_id % 2 = 0"), "doc_id").select("text").distinct()
    unseen = docs.join(labels.where("doc_id % 2 = 1"), "doc_id").join(seen, "text", "left_anti")
    scores = toxicity_chain.score_chain(unseen, links).join(labels, "doc_id")
    counts = Counter((r.toxic == 1, r.p_toxic >= toxicity_chain.THRESHOLD) for r in scores.collect())
    assert counts[False, True] <= 0.02 * (counts[False, True] + counts[False, False])
    assert counts[True, True] >= 0.4 * (counts[True, True] + counts[True, False])  # some labels have no toxic word


def test_chain_uses_out_of_fold_predictions(spark):
    """A second category that equals the first one minus a word: the earlier probability is used."""
    rng = random.Random(8)
    rows = []
    for i in range(400):
        bad, second = rng.random() < 0.4, rng.random() < 0.5
        words = [f"w{rng.randrange(300)}" for _ in range(20)] + ["vile"] * bad + ["twice"] * second
        rows.append((i, " ".join(words), int(bad), int(bad and second)))
    table = spark.createDataFrame(rows, "doc_id long, text string, first int, second int")
    links = toxicity_chain.fit_chain(table, table.select("doc_id", "first", "second"), {"first": F.col("first"), "second": F.col("second")})
    assert links[1].earlier[0] > 0 and b"vile" in links[0].weights
    wrong = [r for r in toxicity_chain.score_chain(table, links).join(table.select("doc_id", "first", "second"), "doc_id").collect()
             if (r.p_first > 0.5) != (r["first"] == 1) or (r.p_second > 0.5) != (r["second"] == 1)]
    assert len(wrong) <= 4


def test_toxicity_of_odd_texts(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one_kind = spark.createDataFrame([(5, 1, 0), (5, None, None), (6, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, one_kind):
        assert not any(r.toxic for r in toxicity_chain.toxicity(odd_docs, labels).collect())
        kept = toxicity_chain.without_toxic(odd_docs, labels)
        assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
        assert toxicity_chain.toxicity(no_docs, labels).count() == 0


def test_pipeline(spark):
    """Stage by stage against plain Python, then packed tokens against the texts that are left."""
    from tokenizers import Tokenizer

    from test_duplicates import brute_components

    docs = common.table(spark, FOLDER, "documents")
    by_stage = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, FOLDER), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        by_stage[name] = {r.doc_id: r.text for r in docs.collect()}
    every = {r.doc_id: r.text for r in common.table(spark, FOLDER, "documents").collect()}
    scores = toxicity_chain.toxicity(common.table(spark, FOLDER, "documents"), common.table(spark, FOLDER, "labels"))
    clean = {d: every[d] for d in every if d not in {r.doc_id for r in scores.where("toxic").collect()}}
    assert by_stage["toxicity"] == clean and len(clean) < len(every)
    last = {}
    for d in sorted(clean):
        last[clean[d]] = d
    assert by_stage["exact_dedup"] == {d: t for t, d in last.items()}
    near = brute_components(list(by_stage["exact_dedup"].items()))
    assert set(by_stage["near_dedup"]) == {d for d, _, _, kept in near if kept}
    assert set(by_stage["secrets"]) == set(by_stage["near_dedup"])
    for d, text in by_stage["secrets"].items():
        assert not any(len(m) for m in __import__("re").findall(secret_scan.HEX, text))
        if "<secret>" not in text:
            assert text == by_stage["near_dedup"][d]
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    by_doc = defaultdict(dict)
    for p in pieces:
        by_doc[p.doc_id][p.start] = (p.length, p.ids_crc32, p.doc_tokens)
    assert set(by_doc) == set(by_stage["secrets"])
    import zlib

    for d, parts in by_doc.items():
        ids = np.asarray([*tokenizer.encode(by_stage["secrets"][d], add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for start in sorted(parts):
            length, crc, total = parts[start]
            assert start == at and total == len(ids) and crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)


def test_stages_accept_nothing(spark):
    docs = common.table(spark, FOLDER, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    frame = registry.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    found = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
    result = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert found == sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=repr)
