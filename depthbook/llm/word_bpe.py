"""Byte-level BPE by a global shuffle of distinct words.

A text is split into pre-tokens, which BPE encodes one by one. Documents are taken in blocks of a few megabytes. A block
sends each of its distinct pre-tokens once, gathered by hash buckets; the pre-tokens of all blocks meet by bucket, where
each distinct word is encoded once, and its ids go back to the blocks. There they meet the block's documents, given as the
numbers of their pre-tokens by position, and are put together in that order. Numbers travel instead of words and ids,
packed, so what is shuffled stays near the size of the input. A frequent word is sent once per block, not per occurrence.

Both passes over the documents have to see the same blocks. They do for a table of files; anything else is to be
`common.stored` first. A checksum of a block's words guards this: where the passes differ, the job fails.

Decoding joins ids with the table of token bytes, which has as many rows as the vocabulary and is held by every task.

Cases: null and empty texts have no ids; repeated rows are encoded again; null ids of documents are carried along; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthbook.llm.common import python_path, table, text_of

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Bytes of text of a block; a longer document is a block of its own.
BLOCK_BYTES = 8_000_000
#: Buckets of words. A block sends one row per bucket; more of them suit more than a few hundred tasks.
BUCKETS = 512
#: Words of a block with the lowest numbers, and words a task remembers within a bucket before it starts anew.
FREQUENT = 16_384
MOST_WORDS = 300_000
#: Bytes of what a task hands on at a time.
BATCH_BYTES = 2_000_000


@functools.lru_cache(maxsize=2)
def token_bytes(ranks: str) -> dict[int, bytes]:
    with open(ranks, "rb") as lines:
        return {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def _encoding(ranks: str):
    import tiktoken

    tokens = {token: rank for rank, token in token_bytes(ranks).items()}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=tokens, special_tokens={})


#: Characters for whose classes the standard library's `re` needs ranges beside its table.
_BEYOND = re.compile("[\U00010000-\U0010ffff]")


def _faster(below: int) -> re.Pattern:
    """PATTERN for texts of the characters below that number; their classes are listed, as `re` does not know them."""
    every = "".join(chr(c) for c in range(below) if not 0xD800 <= c < 0xE000)
    spans = lambda of: "".join(f"{re.escape(x[0])}-{re.escape(x[-1])}" for x in regex.findall(f"{of}+", every))
    s, p_l, p_n = spans(r"\s"), spans(r"\p{L}"), spans(r"\p{N}")
    classes = {r"[^\s\p{L}\p{N}]": f"[^{s}{p_l}{p_n}]", r"\p{L}": f"[{p_l}]", r"\p{N}": f"[{p_n}]", r"\s": f"[{s}]", r"\S": f"[^{s}]"}
    return re.compile(re.sub("|".join(map(re.escape, classes)), lambda m: classes[m[0]], PATTERN))


@functools.lru_cache(maxsize=1)
def _splitter() -> Callable[[str], list[str]]:
    find, find_ascii, find_most = regex.compile(PATTERN).findall, _faster(0x80).findall, _faster(0x10000).findall
    return lambda text: (find_ascii if text.isascii() else find if _BEYOND.search(text) else find_most)(text)


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _packed(numbers: np.ndarray) -> bytes:
    """Four-byte numbers with all lowest bytes first, so that the higher ones, mostly equal, shrink."""
    return np.asarray(numbers, dtype="<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype=np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _pack_parts(parts: list[bytes], unit: int = 1) -> bytes:
    """Byte strings as one, with their lengths in units."""
    body = b"".join(parts)
    lengths = _packed(np.fromiter((len(p) // unit for p in parts), dtype="<u4", count=len(parts)))
    if unit == 4:
        body = _packed(np.frombuffer(body, "<u4"))
    return _compress(len(parts).to_bytes(4, "little") + lengths + body)


def _unpack_parts(packed: bytes, unit: int = 1) -> list[bytes]:
    packed = _expand(packed)
    n = int.from_bytes(packed[:4], "little")
    ends = np.cumsum(_numbers(packed[4 : 4 + 4 * n]).astype(np.int64)) * unit
    body = packed[4 + 4 * n :]
    if unit == 4:
        body = _numbers(body).tobytes()
    at, parts = 0, []
    for end in ends.tolist():
        parts.append(body[at:end])
        at = end
    return parts


def _compress(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


#: kind 0: words of the block that fall into one bucket, in the order of the buckets (n: how many words lie before;
#: body: the words, later their ids). kind 1: which words, by that order, are the block's most frequent ones. kind 2: a
#: document (n: its place in the block; body: its words as numbers, the frequent ones first, then all by that order).
#: mark is the checksum of the block's words.
_ROWS = "bucket long, block long, kind byte, n long, doc_id long, body binary, mark long"
_NAMES = ["bucket", "block", "kind", "n", "doc_id", "body", "mark"]
_TYPES = [pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)


def _in_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    part, size = [], 0
    for row in rows:
        part.append(row)
        size += 60 + len(row[5])
        if size > BATCH_BYTES:
            yield _batch(part)
            part, size = [], 0
    yield _batch(part)


def _finished(block: int, numbers: _Numbers, docs: list | None, buckets: int) -> Iterator[tuple]:
    """The rows of a block: of its words, or of its documents if given."""
    words = [w.encode() for w in numbers]
    mark = xxhash.xxh3_64_intdigest(b"\x00".join(words)) >> 1
    bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words), dtype=np.int64, count=len(words))
    order = np.argsort(bucket, kind="stable")
    if docs is None:
        starts = [0, *(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(words)] if words else []
        for start, end in itertools.pairwise(starts):
            part = order[start:end].tolist()
            yield int(bucket[part[0]]), block, 0, start, None, _pack_parts([words[i] for i in part]), mark
        return
    place = np.empty(len(words), dtype=np.int64)
    place[order] = np.arange(len(words))
    counts = np.bincount(np.concatenate([found for _, found in docs]), minlength=len(words))
    top = np.argsort(-counts, kind="stable")[:FREQUENT]
    code = place + len(top)
    code[top] = np.arange(len(top))
    yield 0, block, 1, 0, None, _compress(_packed(place[top])), mark
    for n, (doc, found) in enumerate(docs):
        yield 0, block, 2, n, doc, _compress(_packed(code[found])), mark


def _split(documents: bool, block_bytes: int, buckets: int) -> Callable:
    """Blocks of documents as rows of their words, or of the documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        find = _splitter()
        block = -1
        numbers, docs, size, count = _Numbers(), [], 0, 0
        for batch in batches:
            if block < 0 and len(batch):
                block = batch.column(2)[0].as_py() << 36
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                if count and size + len(text) > block_bytes:
                    yield from _finished(block, numbers, docs if documents else None, buckets)
                    block += 1
                    numbers, docs, size, count = _Numbers(), [], 0, 0
                found = list(map(numbers.__getitem__, find(text)))
                if documents:
                    docs.append((doc.as_py(), np.asarray(found, dtype=np.uint32)))
                size += len(text)
                count += 1
        if count:
            yield from _finished(block, numbers, docs if documents else None, buckets)

    return lambda batches: _in_batches(rows(batches))


def _encode(ranks: str) -> Callable:
    """Rows of words come by bucket; what a bucket's rows share is encoded once."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        encode = _encoding(ranks).encode_ordinary
        bucket, known = None, {}
        for batch in batches:
            for of, block, _, n, _, body, mark in zip(*batch.columns, strict=True):
                if of.as_py() != bucket or len(known) > MOST_WORDS:
                    bucket, known = of.as_py(), {}
                ids = []
                for word in _unpack_parts(body.as_py()):
                    if word not in known:
                        known[word] = np.asarray(encode(word.decode()), dtype="<u4").tobytes()
                    ids.append(known[word])
                yield 0, block.as_py(), 0, n.as_py(), None, _pack_parts(ids, 4), mark.as_py()

    return lambda batches: _in_batches(rows(batches))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, words, mark = None, [], None
    docs, found, size = [], [], 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(found, pa.binary())], ["doc_id", "ids"])

    for batch in batches:
        for _, of, kind, n, doc, body, check in zip(*batch.columns, strict=True):
            if of.as_py() != block:
                block, words, mark = of.as_py(), [], check.as_py()
            kind = kind.as_py()
            if check.as_py() != mark or kind == 0 and n.as_py() != len(words):
                raise RuntimeError("the documents came in other blocks the second time; store them first")
            if kind == 0:
                words += _unpack_parts(body.as_py(), 4)
                continue
            numbers = _numbers(_expand(body.as_py())).tolist()
            if kind == 1:
                words = [words[i] for i in numbers] + words
                continue
            docs.append(doc.as_py())
            found.append(b"".join([words[i] for i in numbers]))
            size += len(found[-1])
            if size > BATCH_BYTES:
                yield made()
                docs, found, size = [], [], 0
    yield made()


def encoded(docs: DataFrame, ranks: str = RANKS, block_bytes: int = BLOCK_BYTES, buckets: int = BUCKETS) -> DataFrame:
    """doc_id and ids (unsigned 32-bit integers, little end first) of every document."""
    spark = docs.sparkSession
    python_path(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long"), text_of("text").alias("text"), F.spark_partition_id().alias("part"))
    words = texts.mapInArrow(_split(False, block_bytes, buckets), _ROWS)
    words = words.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_encode(ranks), _ROWS)
    places = texts.mapInArrow(_split(True, block_bytes, buckets), _ROWS)
    both = words.union(places).repartition(parts, "block").sortWithinPartitions("block", "kind", "n")
    return both.mapInArrow(_assemble, "doc_id long, ids binary")


@functools.lru_cache(maxsize=2)
def _spelled(ranks: str) -> tuple[list[bytes], list[bytes]]:
    """By id: the bytes of a token, and its decimal with a space before it."""
    of = token_bytes(ranks)
    ids = range(max(of) + 1)
    return [of.get(i) for i in ids], [b" %d" % i for i in ids]


def _bytes_of(ids: bytes, ranks: str) -> bytes:
    return b"".join(map(_spelled(ranks)[0].__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _decode(ranks: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                texts = [_bytes_of(ids.as_py(), ranks) for ids in part.column(1)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], ["doc_id", "ids", "bytes"])

    return run


def decoded(rows: DataFrame, ranks: str = RANKS) -> DataFrame:
    """Adds `bytes`, what the ids stand for."""
    python_path(rows.sparkSession)
    return rows.select("doc_id", "ids").mapInArrow(_decode(ranks), "doc_id long, ids binary, bytes binary")


def _digests(ranks: str) -> Callable:
    """Per document its number of ids, and digests of their decimal list and of what they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, decimal = (of.__getitem__ for of in _spelled(ranks))
        for batch in batches:
            count, listed, text = [], [], []
            for ids in batch.column(1):
                ids = ids.as_py()
                numbers = np.frombuffer(ids, "<u4").tolist()
                count.append(len(numbers))
                listed.append(hashlib.sha256(b"".join(map(decimal, numbers))[1:]).hexdigest())
                text.append(hashlib.sha256(b"".join(map(token, numbers))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(listed, pa.string()), pa.array(text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def op4_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encoded(table(spark, sf_dir, "documents"))
    # Decoded text is digested where it is made, so that it need not pass through another worker.
    return rows.mapInArrow(_digests(RANKS), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
