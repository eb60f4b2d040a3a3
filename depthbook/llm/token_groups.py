"""Alignment of two tokenizers by pointer jumping, and how often their tokens meet over a corpus.

A text with a space before it is tokenised by A (byte-level BPE) and by B (SentencePiece), so both spell the same bytes.
Tokens that overlap belong together; where tokens of both end, a group ends. To find the groups every token points to
the farthest-right token that overlaps it (of two that end together B's is the farther; a token that nothing passes
points to itself). Replacing every pointer by its successor's, for all tokens of many documents at once, doubles what is
jumped over, until all point to the last token of their group, which labels it. Groups may be as long as a text: rounds
grow with the logarithm of that.

Counts over the corpus: a task takes documents in blocks of `BLOCK_BYTES` of text and notes, per document, which id pairs
(a, b) are linked and how often, and per block in how many documents each pair is. Within a group ids are taken with
their multiplicities, so a group of one word a thousand times over is one pair. Blocks are written to the shared folder.
Blocks' pairs add up by (a, b); an A id has at most as many pairs as B has ids, which bounds the window that finds the
highest count. The counts go back to the blocks they are needed in, at most one row a pair and block, and a block's
documents meet them in one group of that bounded size.

Cases: texts that are null or empty, or that a tokenizer does not spell byte by byte (U+2581 is read as a space by B), have
no tokens and zeros everywhere; special strings are plain text; repeated rows are documents of their own, each counted;
null ids are carried along; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from depthbook.llm.common import python_path, stored, table, text_of

TOKENIZER_A = public_tokenizers.path("byte_bpe_50k.json")
MODEL_B = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
#: Bytes of text of a block (a longer document is a block of its own), and of what is aligned at a time.
BLOCK_BYTES = 16_000_000
CHUNK_BYTES = 500_000
#: Pairs of ids made at a time; a single group may hold more.
PAIRS_AT_ONCE = 2_000_000
#: Words whose A ids a task remembers before it starts anew.
REMEMBERED = 400_000


class Vocabulary(NamedTuple):
    """By id: the bytes of a token in number, and its decimal with the sign after it, within and at the end of a list."""

    sizes: np.ndarray
    within: np.ndarray
    last: np.ndarray


def _vocabulary(sizes: np.ndarray, sign: str) -> Vocabulary:
    within, last = (np.asarray([f"{i}{s}" for i in range(len(sizes))], object) for s in (",", sign))
    return Vocabulary(sizes, within, last)


#: What public_tokenizers.PATTERN matches in ASCII texts, without tables of Unicode.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"


def _characters() -> list[str]:
    """The characters of byte-level vocabularies: printable ones stand for themselves, the others follow from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class ByteLevel(dict):
    """A's ids of words, which its model encodes one by one: what its pattern matches, with characters for bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # In byte-level vocabularies every character stands for a byte.
        sizes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, number in self.tokenizer.get_vocab().items():
            sizes[number] = len(token)
        self.vocabulary = _vocabulary(sizes, "|")
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.find_ascii = re.compile(ASCII_PATTERN).findall
        self.pieces = self.tokenizer.model.tokenize
        self.characters = _characters()

    def __missing__(self, word: str) -> bytes:
        spelled = "".join([self.characters[b] for b in word.encode()])
        self[word] = found = array("I", [token.id for token in self.pieces(spelled)]).tobytes()
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self) > REMEMBERED:
            self.clear()
        words = (self.find_ascii(t) if t.isascii() else self.find(t) for t in texts)
        return [np.frombuffer(b"".join([self[w] for w in found]), np.uintc).astype(np.int64) for found in words]


class PieceLevel:
    """B's ids of texts, to which it adds a space."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        sizes = [1 if sp.is_byte(i) else len(sp.id_to_piece(i).replace(SPACE, " ").encode()) for i in range(n)]
        self.vocabulary = _vocabulary(np.asarray(sizes, np.int64), ";")
        self.unknown = sp.unk_id()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(ids, np.int64) for ids in self.processor.encode(texts, num_threads=1)]


@functools.lru_cache(maxsize=1)
def _piece_level(path: str) -> PieceLevel:
    return PieceLevel(path)


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token, numbered from left to right; given where the tokens of both sides end."""
    n = len(ends_a)
    # Over a token's last byte lies one token of the other side; no other overlaps it farther to the right.
    over_a = np.searchsorted(ends_b, ends_a)
    over_b = np.searchsorted(ends_a, ends_b)
    itself = np.arange(len(ends_b)) + n
    goes_on = ends_a[over_b] > ends_b if len(ends_b) else np.zeros(0, bool)
    to = np.concatenate([over_a + n, np.where(goes_on, over_b, itself)])
    while True:
        farther = to[to]
        if np.array_equal(farther, to):
            break
        to = farther
    last = np.cumsum(to[n:] == itself) - 1  # the number of the group by its last token
    return last[to[:n] - n], last[to[n:] - n]


def _starts(sorted_keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.zeros(0, np.int64)


def _with_counts(groups: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids within groups, in order of the groups, and how often each is there."""
    keys = (groups << 32) | ids
    keys.sort()
    at = _starts(keys)
    return keys[at] >> 32, keys[at] & 0xFFFFFFFF, np.diff(np.r_[at, len(keys)])


def linked(group_a, ids_a, group_b, ids_b, doc_of_group) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, a << 32 | b, number of links); a document's pair may come several times."""
    in_a, a, times_a = _with_counts(group_a, ids_a)
    in_b, b, times_b = _with_counts(group_b, ids_b)
    n_groups = len(doc_of_group)
    from_a, from_b = (np.searchsorted(x, np.arange(n_groups + 1)) for x in (in_a, in_b))
    made = np.cumsum(np.diff(from_a) * np.diff(from_b))
    part = 0
    while part < n_groups:
        done = made[part - 1] if part else 0
        end = max(part + 1, int(np.searchsorted(made, done + PAIRS_AT_ONCE, side="right")))
        rows = np.arange(from_a[part], from_a[end])
        width = np.diff(from_b)[in_a[rows]]
        left = np.repeat(rows, width)
        right = np.arange(len(left)) - np.repeat(np.cumsum(width) - width, width) + np.repeat(from_b[in_a[rows]], width)
        yield doc_of_group[in_a[left]], (a[left] << 32) | b[right], times_a[left] * times_b[right]
        part = end


def _summed(docs: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((pairs, docs))
    docs, pairs, times = docs[order], pairs[order], times[order]
    if not len(docs):
        return docs, pairs, times
    at = np.flatnonzero(np.r_[True, (docs[1:] != docs[:-1]) | (pairs[1:] != pairs[:-1])])
    return docs[at], pairs[at], np.add.reduceat(times, at)


class Aligned(NamedTuple):
    """Of a document: tokens, groups and links in number, the groups spelled out, its pairs and how often each is linked."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    groups: str
    pairs: np.ndarray
    times: np.ndarray


def align(texts: list[str], side_a: ByteLevel, side_b: PieceLevel) -> list[Aligned]:
    """The alignment of each text."""
    raw = [" " + t for t in texts]
    # What B does not spell as it stands has no tokens.
    plain = [i for i, t in enumerate(texts) if t and SPACE not in t]
    found_a, found_b = side_a.encode([raw[i] for i in plain]), side_b.encode([texts[i] for i in plain])
    sizes_a, sizes_b = side_a.vocabulary.sizes, side_b.vocabulary.sizes
    lengths = [len(raw[i].encode()) for i in plain]
    spelled = [
        j
        for j, (a, b, n) in enumerate(zip(found_a, found_b, lengths, strict=True))
        if sizes_a[a].sum() == n and sizes_b[b].sum() == n and side_b.unknown not in b
    ]
    out = [Aligned(0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(texts)
    if not spelled:
        return out
    # All documents in a row: where one ends, tokens of both sides end.
    ids_a, ids_b = (np.concatenate([found[j] for j in spelled]) for found in (found_a, found_b))
    n_a, n_b = (np.asarray([len(found[j]) for j in spelled]) for found in (found_a, found_b))
    group_a, group_b = groups_of(np.cumsum(sizes_a[ids_a]), np.cumsum(sizes_b[ids_b]))
    n = len(spelled)
    last_group = group_a[np.cumsum(n_a) - 1]
    n_groups = np.diff(last_group, prepend=-1)
    doc_of_group = np.repeat(np.arange(n), n_groups)
    in_group_a, in_group_b = (np.bincount(g, minlength=len(doc_of_group)) for g in (group_a, group_b))
    n_links = np.add.reduceat(in_group_a * in_group_b, np.cumsum(n_groups) - n_groups)

    parts = [_summed(*part) for part in linked(group_a, ids_a, group_b, ids_b, doc_of_group)]
    docs, pairs, times = parts[0] if len(parts) == 1 else _summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    bounds = np.searchsorted(docs, np.arange(n + 1))
    spelled_out = _spelled(ids_a, ids_b, group_a, group_b, in_group_a, in_group_b, side_a.vocabulary, side_b.vocabulary)
    ends = np.cumsum(n_a + n_b)
    for k, j in enumerate(spelled):
        own = slice(bounds[k], bounds[k + 1])
        # Each token is followed by its sign; the last one's is none of the document's.
        groups = "".join(spelled_out[ends[k] - n_a[k] - n_b[k] : ends[k]])[:-1]
        out[plain[j]] = Aligned(*(int(x[k]) for x in (n_a, n_b, n_groups, n_links)), groups, pairs[own], times[own])
    return out


def _spelled(ids_a, ids_b, group_a, group_b, in_group_a, in_group_b, a: Vocabulary, b: Vocabulary) -> list[str]:
    """All tokens as decimals in order of their groups, A's before B's, each with the sign that follows it."""
    place_a = np.arange(len(ids_a)) + (np.cumsum(in_group_b) - in_group_b)[group_a]
    place_b = np.arange(len(ids_b)) + np.cumsum(in_group_a)[group_b]
    last_a = np.r_[group_a[1:] != group_a[:-1], True]
    last_b = np.r_[group_b[1:] != group_b[:-1], True]
    tokens = np.empty(len(ids_a) + len(ids_b), object)
    tokens[place_a] = np.where(last_a, a.last[ids_a], a.within[ids_a])
    tokens[place_b] = np.where(last_b, b.last[ids_b], b.within[ids_b])
    return tokens.tolist()


#: kind 0: a pair (a, b) and how many documents of the block hold it. kind 1: a document, its pairs as places among the
#: block's sorted pairs, and how often each is linked (both as unsigned 32-bit integers, little end first).
_ROWS = (
    "block long, kind byte, a int, b int, docs long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, places binary, times binary"
)
_TYPES = pa.schema(
    [
        ("block", pa.int64()), ("kind", pa.int8()), ("a", pa.int32()), ("b", pa.int32()), ("docs", pa.int64()),
        ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
        ("groups_sha256", pa.string()), ("places", pa.binary()), ("times", pa.binary()),
    ]
)


def _filled(n: int, **columns) -> pa.RecordBatch:
    """A batch of n rows; columns that are not given are null."""
    made = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _TYPES]
    return pa.RecordBatch.from_arrays(made, schema=_TYPES)


def _block(block: int, docs: list, found: list[Aligned]) -> Iterator[pa.RecordBatch]:
    pairs, places, n_docs = np.unique(np.concatenate([f.pairs for f in found]), return_inverse=True, return_counts=True)
    for at in range(0, len(pairs), 100_000):
        part = slice(at, at + 100_000)
        n = len(pairs[part])
        yield _filled(
            n, block=np.full(n, block), kind=np.zeros(n, np.int8), a=(pairs[part] >> 32).astype(np.int32),
            b=(pairs[part] & 0xFFFFFFFF).astype(np.int32), docs=n_docs[part],
        )
    ends = np.cumsum([len(f.pairs) for f in found])
    for at in range(0, len(found), 500):
        part = found[at : at + 500]
        own = [places[end - len(f.pairs) : end] for f, end in zip(part, ends[at : at + 500], strict=True)]
        yield _filled(
            len(part), block=[block] * len(part), kind=[1] * len(part), doc_id=docs[at : at + 500],
            n_a=[f.n_a for f in part], n_b=[f.n_b for f in part], n_groups=[f.n_groups for f in part],
            n_links=[f.n_links for f in part], groups_sha256=[f.groups for f in part],
            places=[p.astype("<u4").tobytes() for p in own], times=[f.times.astype("<u4").tobytes() for f in part],
        )


def _digested(found: list[Aligned]) -> list[Aligned]:
    return [f._replace(groups=hashlib.sha256(f.groups.encode()).hexdigest() if f.n_a else "") for f in found]


def _align(path_a: str, path_b: str, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side_a, side_b = ByteLevel(path_a), _piece_level(path_b)
        block, docs, found, texts, size, waiting = -1, [], [], [], 0, 0

        def aligned() -> None:
            nonlocal texts, waiting
            found.extend(_digested(align(texts, side_a, side_b)))
            texts, waiting = [], 0

        for batch in batches:
            if block < 0 and len(batch):
                block = batch.column(2)[0].as_py() << 36
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                if docs and size + len(text) > block_bytes:
                    aligned()
                    yield from _block(block, docs, found)
                    block, docs, found, size = block + 1, [], [], 0
                docs.append(doc.as_py())
                texts.append(text)
                size += len(text)
                waiting += len(text)
                if waiting > CHUNK_BYTES:
                    aligned()
        if docs:
            aligned()
            yield from _block(block, docs, found)

    return run


_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _counted(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """A block's documents with the counts of their pairs."""
    key = (counts["a"].to_numpy().astype(np.int64) << 32) | counts["b"].to_numpy()
    order = np.argsort(key)
    count = counts["count"].to_numpy()[order]
    best = counts["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64)
    n_best, count_sum = [], []
    for places, times in zip(docs["places"], docs["times"], strict=True):
        at = np.frombuffer(places.as_py(), "<u4")
        times = np.frombuffer(times.as_py(), "<u4").astype(np.int64)
        n_best.append(int((times * best[at]).sum()))
        count_sum.append(int((times * count[at]).sum()))
    kept = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    kept = kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))
    return kept.append_column("groups_sha256", docs["groups_sha256"])


def alignments(
    docs: DataFrame, tokenizer_a: str = TOKENIZER_A, model_b: str = MODEL_B, block_bytes: int = BLOCK_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; id pairs: a, b, count, best).

    The pairs are a dictionary between the two vocabularies: `best` marks those whose count no other pair of the A id
    exceeds.
    """
    python_path(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), text_of("text").alias("text"), F.spark_partition_id().alias("part"))
    rows = stored(texts.mapInArrow(_align(tokenizer_a, model_b, block_bytes), _ROWS), "aligned")
    pairs = rows.where("kind = 0").select("block", "a", "b", "docs")
    counts = pairs.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    # An A id has at most as many rows here as B has ids.
    counts = counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))
    counts = stored(counts, "pair-counts")
    own = pairs.drop("docs").join(counts, ["a", "b"])
    of_docs = rows.where("kind = 1").drop("kind", "a", "b", "docs").withColumnRenamed("block", "of_block")
    out = of_docs.groupBy("of_block").cogroup(own.groupBy("block")).applyInArrow(_counted, _OUT)
    return out, counts


def op12_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignments(table(spark, sf_dir, "documents"))[0]
