"""Near-duplicates, exact duplicates, repeated units; each against brute force."""

import hashlib
import os
import random
import tempfile
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from text_support import prose
from pyspark.sql import functions as F

from depthbook.llm import common, components, lsh_forest, stream_dedup, unit_dedup


def grams(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        root = find(i)
        if doc is not None:
            least[root] = min(doc, least.get(root, doc))
    alone = [least.get(find(i)) if sets[i] else rows[i][0] for i in range(len(rows))]
    return Counter((rows[i][0], len(sets[i]), alone[i], rows[i][0] == alone[i]) for i in range(len(rows)))


def found_components(docs):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in lsh_forest.near_duplicates(docs).collect())


def test_near_duplicates_of_odd_texts(odd_docs, odd_rows, no_docs):
    assert found_components(odd_docs) == brute_components([(r[0], r[1]) for r in odd_rows])
    assert lsh_forest.near_duplicates(no_docs).count() == 0
    kept = lsh_forest.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(r.doc_id for r in kept.collect())[5] == 1 and 6 not in {r.doc_id for r in kept.collect()}


def crowd(rng, n, edits):
    """A text and n copies of it with so many words replaced, and texts that share half of it."""
    base = prose(rng, 150).split(" ")
    rows = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.randint(0, edits)):
            words[at] = "".join(rng.choices("xyzq", k=7))
        rows.append(" ".join(words))
    rows += [" ".join(base[:100]) + " " + prose(rng, rng.randint(20, 50), 5000) for _ in range(n)]
    return rows


@pytest.mark.parametrize("tight", [False, True])
def test_crowded_regions(spark, monkeypatch, tight):
    """Hundreds of close texts, many near the limit. `tight`: regions are split and hardly any neighbour is
    looked at, so that the exact pass must find what the trees leave out."""
    rng = random.Random(11)
    texts = crowd(rng, 60, 9) + crowd(rng, 25, 14) + [prose(rng, 80) for _ in range(30)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    if tight:
        monkeypatch.setattr(lsh_forest, "NEIGHBOURS", 1)
        monkeypatch.setattr(lsh_forest, "MOST_IN_REGION", 6)
        monkeypatch.setattr(lsh_forest, "BLOCK", 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_components(docs) == brute_components(rows)


def test_components_of_long_chains(spark):
    chain = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    star = spark.range(1001, 1300).select(F.lit(1300).cast("long").alias("a"), F.col("id").alias("b"))
    found = {(r.node, r.root) for r in components.components(chain.union(star)).collect()}
    assert found == {(i, 0) for i in range(300)} | {(i, 1001) for i in range(1001, 1301)}


def test_what_a_job_leaves_behind(spark, odd_docs, monkeypatch):
    """Every round of components drops the one before, and only the result's table is left of near-duplicates."""
    dropped = []
    monkeypatch.setattr(components, "let_go", dropped.append)
    chain = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert components.components(chain).count() == 300 and len(dropped) >= 3
    before = list(common._made)
    found = lsh_forest.near_duplicates(odd_docs)
    left = {path.rpartition("/")[2].rpartition("-")[0] for path in common._made if path not in before}
    assert "near-duplicates" in left and not left & {"signed", "classes", "texts", "candidates"}
    assert found.count() == odd_docs.count()


def brute_groups(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[text or ""].append(doc)
    out = Counter()
    for doc, text in rows:
        ids = [i for i in groups[text or ""] if i is not None]
        keep = max(ids, default=None)
        out[doc, keep, len(groups[text or ""]), doc == keep] += 1
    return out


def found_groups(frame):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in frame.collect())


@pytest.mark.parametrize("collide", [False, True])
def test_exact_duplicates(odd_docs, odd_rows, no_docs, monkeypatch, collide):
    """`collide`: all digests are one of two, so only the bytes tell texts apart."""
    if collide:
        digest = stream_dedup._digest
        monkeypatch.setattr(stream_dedup, "_digest", lambda c="text": F.to_binary(F.substring(F.hex(digest(c)), 1, 1), F.lit("utf-8")))
    rows = [(r[0], r[1]) for r in odd_rows]
    assert found_groups(stream_dedup.exact_duplicates(odd_docs)) == brute_groups(rows)
    assert stream_dedup.exact_duplicates(no_docs).count() == 0
    kept = stream_dedup.without_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    left = Counter((r.doc_id, r.text or "") for r in kept.collect())
    assert left == Counter((d, t or "") for d, t in {(d, t or "") for d, t in rows} if d == max((i for i, u in rows if (u or "") == t and i is not None), default=None))


def test_state_goes_on(spark, odd_docs, odd_rows, tmp_path):
    """New rows meet the digests of an earlier call in the kept state."""
    state = str(tmp_path / "state")
    rows = [(r[0], r[1]) for r in odd_rows]
    stream_dedup.exact_duplicates(odd_docs.where("doc_id < 8"), state).count()
    again = stream_dedup.exact_duplicates(odd_docs.where("doc_id is null or doc_id >= 8"), state)
    assert Counter(r.doc_id for r in again.collect()) == Counter(d for d, _ in rows)
    sizes = {(r.doc_id, r.group_size) for r in again.collect()}
    assert {(5, 3), (6, 3), (7, 3)} <= sizes


def test_kept_state_compares_bytes(spark, odd_docs, odd_rows, tmp_path, monkeypatch):
    """All digests are one of two, so new rows must be told from those of an earlier call by their bytes."""
    digest = stream_dedup._digest
    monkeypatch.setattr(stream_dedup, "_digest", lambda c="text": F.to_binary(F.substring(F.hex(digest(c)), 1, 1), F.lit("utf-8")))
    state = str(tmp_path / "state")
    stream_dedup.exact_duplicates(odd_docs.where("doc_id < 8"), state).count()
    again = stream_dedup.exact_duplicates(odd_docs.where("doc_id is null or doc_id >= 8"), state)
    assert found_groups(again) == brute_groups([(r[0], r[1]) for r in odd_rows])


def test_state_without_texts(spark, odd_docs, tmp_path):
    docs = odd_docs.where("doc_id = 5").withColumn("locator", F.lit(""))
    docs.select("doc_id", stream_dedup._digest().alias("digest"), "locator").write.parquet(str(tmp_path / "arrivals"))
    with pytest.raises(ValueError, match="without their texts"):
        stream_dedup.exact_duplicates(odd_docs.where("doc_id = 6"), str(tmp_path))


def brute_units(rows):
    first = {}
    for doc, text in sorted(rows, key=lambda r: unit_dedup.LAST_ID if r[0] is None else r[0]):
        rank = unit_dedup.LAST_ID if doc is None else doc
        for _, _, unit in unit_dedup.units(text or ""):
            first.setdefault(unit, rank)
    out = Counter()
    for doc, text in rows:
        text, rank, seen = text or "", unit_dedup.LAST_ID if doc is None else doc, set()
        gone = [False] * len(text)
        for start, end, unit in unit_dedup.units(text):
            if first[unit] < rank or unit in seen:
                gone[start:end] = [True] * (end - start)
            seen.add(unit)
        out[doc, "".join(c for c, g in zip(text, gone, strict=True) if not g), sum(gone)] += 1
    return out


def test_repeated_units(spark, odd_docs, odd_rows, no_docs):
    rng = random.Random(2)
    passage = prose(rng, 70)
    mid = [f"{prose(rng, 25)} {passage} {prose(rng, 30)}" for _ in range(4)]  # pasted into a line
    more = list(enumerate(mid, 50))
    docs = odd_docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    rows = [(r[0], r[1]) for r in odd_rows] + more
    found = unit_dedup.without_repeats(docs).collect()
    spans = Counter((r.doc_id, r.text, sum(s.end - s.start for s in r.removed)) for r in found)
    assert spans == brute_units(rows)
    by_id = {r.doc_id: r for r in found}
    assert not by_id[50].removed
    for doc in (51, 52, 53):
        assert sum(s.end - s.start for s in by_id[doc].removed) > 0.7 * len(passage)
    assert unit_dedup.without_repeats(no_docs).count() == 0


def test_passages_within_sentences(spark, no_docs):
    """50 to 60 words without a stop, pasted between the words of a sentence, across lines, and twice into one text."""
    rng = random.Random(4)

    def plain(n):
        return " ".join(prose(rng, n).replace(".", "").split())

    rows, first = [], {}
    for i, n in enumerate([50, 51, 53, 57, 60] * 4):
        passage = plain(n)
        first[100 + i] = passage
        rows.append((i, f"{plain(9)} {passage} {plain(5)}.\n{prose(rng, 80)}"))
        pasted = passage.upper().replace(" ", ", " if i % 2 else "\n", 1)
        rows.append((100 + i, f"{plain(i % 7)} {pasted} {plain(i % 5)}. {prose(rng, 60)}"))
    twice = plain(55)
    rows += [(300, f"{plain(8)} {twice} {plain(9)} {twice} {plain(4)}"), (301, "one " * 120), (302, "a b c " * 60)]
    rows += [(303, "one " * 70), (None, f"{plain(3)} {twice} {plain(3)}"), (304, plain(49)), (305, rows[0][1])]
    rows.append((306, f"x {rows[-2][1]} y"))
    found = unit_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text, sum(s.end - s.start for s in r.removed)) for r in found) == brute_units(rows)
    by_id, texts = {r.doc_id: r for r in found}, dict(rows)
    for doc, passage in first.items():
        assert not by_id[doc - 100].removed
        words = " ".join(texts[doc][s.start : s.end] for s in by_id[doc].removed).lower().replace(",", "").split()
        assert " ".join(passage.split()) in " ".join(words)
        assert len(words) <= len(passage.split()) + 2  # a neighbour may be the same word by chance
    assert len(by_id[301].text.split()) == 50 and len(by_id[302].text.split()) == 50
    assert by_id[303].text == "" and by_id[305].text == "" and not by_id[306].removed
    assert by_id[300].text.count(twice) == 1 and twice not in by_id[None].text


def test_scripts_without_spaces(spark):
    rng = random.Random(5)
    signs = [chr(c) for c in [*range(0x4E00, 0x4F00), *range(0x3042, 0x3090), *range(0xE01, 0xE2F), 0x20001, 0x20002]]

    def plain(n):
        return "".join(rng.choices(signs, k=n))

    line, sentence, passage = plain(30), plain(14) + "。", plain(55)
    rows = [(1, line), (2, f"abc\n{line}\n{plain(3)}"), (3, f"{plain(20)}。{sentence}{plain(9)}"), (4, f"{plain(15)}！{sentence}{plain(8)}")]
    rows += [(5, f"{plain(9)} ok{passage}{plain(7)}"), (6, f"{plain(6)}{passage} and {plain(5)}"), (7, plain(20) + "。"), (8, "漢字"), (9, "漢字")]
    rows += [(10, "six words that end in spaces here.  "), (11, "... six words that follow signs here")]
    found = unit_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text, sum(s.end - s.start for s in r.removed)) for r in found) == brute_units(rows)
    by_id = {r.doc_id: r.text for r in found}
    assert line not in by_id[2] and sentence not in by_id[4] and passage not in by_id[6]
    assert all(by_id[doc] == text for doc, text in rows if doc not in (2, 4, 6))
    assert by_id[6] == rows[5][1].replace(passage + " ", "")


def test_digests_are_made_once(spark, tmp_path, monkeypatch):
    """Each text is taken apart once, and what was made for one round is gone after it."""
    rng = random.Random(6)
    passage = prose(rng, 70)
    rows = [(i, f"{prose(rng, 30)} {passage} {prose(rng, 20)}") for i in range(20)]
    taken = tmp_path / "taken"
    emit = unit_dedup._emit

    def noted(batches):
        for batch in batches:
            with taken.open("a") as file:
                file.write("x" * batch.num_rows)
            yield from emit(iter([batch]))

    monkeypatch.setattr(unit_dedup, "_emit", noted)
    before = list(common._made)
    found = unit_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert Counter((r.doc_id, r.text, sum(s.end - s.start for s in r.removed)) for r in found) == brute_units(rows)
    assert taken.read_text() == "x" * len(rows)
    left = {path.rpartition("/")[2].rpartition("-")[0] for path in common._made if path not in before}
    assert left == {"repeated", "repeated-passages"}


def test_repeats_across_and_within_texts(spark):
    """Lines held before in part, passages across their ends, equal stretches that overlap themselves."""
    rng = random.Random(7)
    line, other = (" ".join(prose(rng, 60).replace(".", "").split()) for _ in range(2))
    period = " ".join(prose(rng, 7).replace(".", "").split())
    rows = [(1, f"{line}\n{other}"), (2, f"{other}\n{line}"), (3, f"{line}\n{line} {other}\n{line}"), (4, " ".join([period] * 30))]
    rows += [(5, f"x {line} {other}\n{line}"), (6, f"{' '.join([period] * 20)}\n{' '.join([period] * 9)}"), (6, rows[2][1]), (None, rows[0][1])]
    found = unit_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text, sum(s.end - s.start for s in r.removed)) for r in found) == brute_units(rows)


def test_digest_of_a_text(odd_docs):
    for r in stream_dedup.exact_duplicates(odd_docs.where("doc_id in (1, 10)")).collect():
        text = {1: "", 10: "Ünï cödé 漢字 😀 ok\x00\x1c é"}[r.doc_id]
        assert bytes(r.digest) == hashlib.sha256(text.encode()).digest()


def test_stored_tables_leave_no_shuffles(spark, tmp_path):
    """What a stored table shuffled goes when it is written, without the driver's garbage collector, and settings stay."""
    def shuffles():
        return {f for top in tops for f in Path(top).glob("blockmgr-*/*/shuffle_*.data")}

    tops = {spark.conf.get("spark.local.dir", None) or tempfile.gettempdir(), os.environ.get("SPARK_LOCAL_DIRS") or "/tmp"}
    settings = spark.sparkContext.getConf().getAll(), spark.conf.get(common._SHUFFLES_GO, None)
    before = shuffles()
    spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count().write.parquet(str(tmp_path / "plain"))
    assert shuffles() - before, "shuffle files are looked for in the wrong place"
    before = shuffles()
    common.stored(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count(), "counts")
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert settings == (spark.sparkContext.getConf().getAll(), spark.conf.get(common._SHUFFLES_GO, None))


def test_a_round_goes_slice_by_slice(spark, monkeypatch):
    """A round's digests are exchanged in slices, and every slice is there."""
    rng = random.Random(8)
    passage = prose(rng, 90)
    rows = [(i, f"{prose(rng, 40)}\n{passage if i % 3 else ''} {prose(rng, 20)}") for i in range(40)]
    write, written = unit_dedup.stored, []

    def noted(frame, name):
        written.append((name, frame))
        return write(frame, name)

    monkeypatch.setattr(unit_dedup, "stored", noted)
    found = unit_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text, sum(s.end - s.start for s in r.removed)) for r in found) == brute_units(rows)
    for name in ("repeated", "repeated-passages"):
        assert sum(n == name for n, _ in written) == 1 + unit_dedup.SLICES


@pytest.mark.parametrize("length", [unit_dedup.PASSAGE - 1, unit_dedup.PASSAGE, 51, 90, 300])
def test_anchors_are_the_least_of_a_passage(length):
    """Against every window by itself; of equal ones the first; words that repeat too."""
    rng = random.Random(length)
    n = unit_dedup.PASSAGE - unit_dedup.ANCHOR + 1
    for words in (7, 400):
        found = unit_dedup._Passages(" ".join(f"w{rng.randrange(words)}" for _ in range(length)))
        if not found.n:
            assert not len(found.anchors) and found.anchor_digests[1] == [] and not found.again()
            continue
        runs = unit_dedup._runs(found.words, unit_dedup.ANCHOR)
        mixed = (runs ^ (runs >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        mixed = (mixed ^ (mixed >> np.uint64(33))).tolist()
        assert found.anchors.tolist() == [min(range(i, i + n), key=lambda j: (mixed[j], j)) for i in range(found.n)]
        assert found.anchor_digests[0].tolist() == sorted(set(found.anchors.tolist()))
        units = [found.unit(i) for i in range(found.n)]
        assert found.again() == {i: units.index(u) for i, u in enumerate(units) if units.index(u) < i}
