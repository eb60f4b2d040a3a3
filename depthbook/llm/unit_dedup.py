"""Substring de-duplication by hashing lines, sentences and passages.

A text's units are its lines, and the sentences of lines that hold several, as passages are often pasted into a line. A
unit is normalised: runs of letters and digits in lower case (ASCII), other ASCII signs and white space apart. Lines of
`LINE_WORDS` words and sentences of `SENTENCE_WORDS` words and more take part; shorter ones repeat by chance.
Every `PASSAGE` words in a row, wherever they start, are a unit too, so a pasted passage goes to its last word.
In scripts without spaces `WORD_CHARS` characters count as a word of a line or sentence, and one as a word of a passage.

One digest a word would be too much to send. Of each passage the `ANCHOR` words with the smallest hash are its anchor; equal
passages have equal anchors, and neighbours mostly share theirs. Anchors are grouped with the lines and sentences, and
only passages whose anchor is in several documents are digested and grouped in a second round. Passages within a line or
sentence that is removed anyway are left out there: an earlier document holds them with it.

Digests (127 bits and a bit for the kind) are grouped over all documents. The occurrence in the document with the smallest id stays, in a
document the first one; all others are removed. Spans are kept in characters of the original text. A task sends each of
a document's digests once, the group of a digest is its smallest id and a count, combined before the shuffle, so a unit
that every document holds is one row per task; its join back is a plain join that splits a skewed key. Digests travel with
their span, so texts are taken apart once, and only those with shared anchors once more. Each round's digests are written to
the shared folder, grouped and joined slice by slice, and deleted before the next round's are made.

Cases: null and empty texts have no units; null ids count as the largest, and rows that share an id (null ids too)
remove nothing from each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthbook.llm.common import forget, python_path, stored, table, text_key, text_of

LINE_WORDS = 4
SENTENCE_WORDS = 6
WORD_CHARS = 2
PASSAGE = 50
ANCHOR = 10
LAST_ID = 2**63 - 1
#: A round's digests are exchanged in so many slices, which bounds the disk that their exchanges take at a time.
SLICES = 2

_SENTENCE_END = re.compile(r"(?<=[.!?…。！？])\s+|(?<=[。！？])(?=[^\s。！？」』”’）])")
#: The same in ASCII lines, with the stop in the match.
_ASCII_SENTENCE_END = re.compile(r"[.!?]\s+")
#: Thai, Lao, Myanmar, Khmer, kana, Han: first and last character.
_SCRIPTS = [(0xE00, 0xEFF), (0x1000, 0x107F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4D7F), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]
_SPACELESS = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _SCRIPTS) + "]")
_SPACES = bytes.maketrans(
    bytes(c for c in range(128) if not chr(c).isalnum()), b" " * sum(not chr(c).isalnum() for c in range(128))
)

#: Hashes that choose anchors and tell equal passages of one text; digests are made of the words themselves.
_BYTE = np.random.default_rng(8).integers(1, 2**63, 256, dtype=np.uint64)
_PLACE = np.random.default_rng(9).integers(1, 2**63, 4096, dtype=np.uint64) | np.uint64(1)
_STEPS = {2**i: np.uint64(pow(0x9E3779B97F4A7C15, 2**i, 2**64)) for i in range(PASSAGE.bit_length())}


_digest = xxhash.xxh3_128_digest


def _runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """The hash of every `length` neighbours, put together from runs of powers of two."""
    found, done, power, size = None, 0, hashes, 1
    while True:
        if length & size:
            if found is None:
                found = power
            else:
                n = len(hashes) - done - size + 1
                found = found[:n] * _STEPS[size] + power[done : done + n]
            done += size
        if done == length:
            return found ^ (found >> np.uint64(31))
        power = power[:-size] * _STEPS[size] + power[size:]
        size *= 2


def _spaceless_starts() -> np.ndarray:
    """By the first two bytes of a character, whether its script has no spaces; the ranges are whole in these."""
    known = np.zeros(65536, bool)
    for first, last in _SCRIPTS:
        low, high = (int.from_bytes(chr(c).encode()[:2], "big") for c in (first, last))
        known[[c for c in range(low, high + 1) if 0x80 <= c & 0xFF < 0xC0]] = True
    return known


_STARTS = _spaceless_starts()


class _Passages:
    """The passages of a text by the number of their first word."""

    def __init__(self, text: str):
        self.raw = text.encode("utf-8", "surrogatepass")
        self.ascii = len(self.raw) == len(text)
        self.plain = self.raw.translate(_SPACES).lower()
        at = np.frombuffer(b" " + self.plain + b" ", np.uint8)
        sign = at != 32
        edges = np.flatnonzero(sign[1:] != sign[:-1])
        at = at[1:]
        single = () if self.ascii else np.flatnonzero(_STARTS[at[:-1].astype(np.uint16) << 8 | at[1:]])
        if len(single):
            after = single + np.where(at[single] >= 0xF0, 4, 3)
            starts = np.union1d(np.r_[edges[::2], single], np.setdiff1d(after, edges[1::2]))
            edges = np.c_[starts, np.r_[starts[1:], len(at)]]
            edges[:, 1] = np.minimum(edges[:, 1], np.flatnonzero(at == 32)[np.searchsorted(np.flatnonzero(at == 32), starts)])
            edges = edges.ravel()
        self.starts, self.ends = edges[::2], edges[1::2]
        self.n = max(0, len(self.starts) - PASSAGE + 1)
        if not self.n:
            return
        steps = np.diff(self.starts, append=len(at))
        place = np.arange(self.starts[0], len(at)) - np.repeat(self.starts, steps)
        hashes = _BYTE[at[self.starts[0] :]] * _PLACE[place & 4095]
        words = np.add.reduceat(hashes, edges - self.starts[0])[::2]
        words = (words ^ (words >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        self.words = words ^ (words >> np.uint64(32))
        sizes = self.ends - self.starts + 1
        self.stops = np.cumsum(sizes)  # of each word, with the space before it
        self.first = self.stops - sizes
        if not len(single):
            self.joined = b" " + b" ".join(self.plain.split())
            return
        joined = np.full(sizes.sum(), 32, np.uint8)
        kept = np.flatnonzero(at != 32)
        joined[kept + np.repeat(self.first + 1 - self.starts, sizes - 1)] = at[kept]
        self.joined = joined.tobytes()

    def unit(self, word: int, length: int = PASSAGE) -> bytes:
        """Unlike a line or a sentence it starts with a space."""
        return self.joined[self.first[word] : self.stops[word + length - 1]]

    def digests(self, words: np.ndarray, length: int = PASSAGE) -> list[bytes]:
        """Those of the units that start at the given words."""
        if not len(words):
            return []
        joined, stops = self.joined, self.stops[words + length - 1]
        return [_digest(joined[a:b]) for a, b in zip(self.first[words].tolist(), stops.tolist(), strict=True)]

    @functools.cached_property
    def anchors(self) -> np.ndarray:
        """The first word of every passage's anchor; of equal hashes the first."""
        if not self.n:
            return np.zeros(0, np.int64)
        runs = _runs(self.words, ANCHOR)
        mixed = (runs ^ (runs >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        # The least of ever longer stretches, each put together from two that may overlap.
        least = mixed ^ (mixed >> np.uint64(33))
        where, size = np.arange(len(least)), 1
        while size < PASSAGE - ANCHOR + 1:
            step = min(size, PASSAGE - ANCHOR + 1 - size)
            later = least[step:] < least[:-step]
            least, where = np.where(later, least[step:], least[:-step]), np.where(later, where[step:], where[:-step])
            size += step
        return where

    @functools.cached_property
    def anchor_digests(self) -> tuple[np.ndarray, list[bytes]]:
        """The first words of all anchors, which never go back along a text, and their digests."""
        words = self.anchors[np.flatnonzero(np.diff(self.anchors, prepend=-1))]
        return words, self.digests(words, ANCHOR)

    def again(self) -> dict[int, int]:
        """Passages that the text holds before: where it does first."""
        # Equal passages have equal anchors, at other words.
        digests = self.anchor_digests[1]
        if len(set(digests)) == len(digests):
            return {}
        _, first, back = np.unique(_runs(self.words, PASSAGE), return_index=True, return_inverse=True)
        first = first[back]
        late = np.flatnonzero(first < np.arange(self.n))
        if not len(late):
            return {}
        # Neighbours that are as far from their first ones are compared in one piece.
        before = first[late]
        cuts = np.flatnonzero((np.diff(late) != 1) | (np.diff(before) != 1)) + 1
        stretches = [(p[0], b[0], len(p) + PASSAGE - 1) for p, b in zip(np.split(late, cuts), np.split(before, cuts), strict=True)]
        if all(self.unit(i, n) == self.unit(j, n) for i, j, n in stretches):
            return dict(zip(late.tolist(), before.tolist(), strict=True))
        # Equal hashes of different words are told apart here.
        late = late.tolist()
        known: dict[bytes, int] = {}
        for i in sorted({*late, *first[late].tolist()}):
            known.setdefault(self.unit(i), i)
        return {i: known[self.unit(i)] for i in late if known[self.unit(i)] < i}

    def spans(self, passages: np.ndarray, again: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends in characters, with the signs that follow up to the next word or line. Where a passage overlaps
        the first equal one of its text, it starts after it."""
        starts = passages
        if again:
            starts = np.asarray([max(i, again[i] + PASSAGE) if i in again else i for i in passages.tolist()], np.int64)
        raw = np.frombuffer(self.raw, np.uint8)
        ends = self.ends[passages + PASSAGE - 1]
        stops = np.append(self.starts, len(raw))[passages + PASSAGE]
        lines = np.append(np.flatnonzero(raw == 10), len(raw))
        starts, stops = self.starts[starts], np.minimum(stops, lines[np.searchsorted(lines, ends)])
        if self.ascii:
            return starts, stops
        chars = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
        return chars[starts], chars[stops]


def _lines(text: str) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, normalised) of lines and sentences that take part; a line goes before its sentences."""
    ascii_only = text.isascii()
    spaceless = not ascii_only and _SPACELESS.search(text) is not None
    at = 0
    for line in text.split("\n"):
        start, at = at, at + len(line) + 1
        # Where all characters are one byte, bytes are cut where the line is.
        single = ascii_only or line.isascii()
        plain = line.encode("utf-8", "surrogatepass").translate(_SPACES).lower()
        whole = plain.split()
        size = max(len(whole), len(_SPACELESS.findall(line)) // WORD_CHARS) if spaceless else len(whole)
        if size < LINE_WORDS:
            continue
        yield start, min(at, len(text)), b" ".join(whole)
        if size <= SENTENCE_WORDS:
            continue
        cuts = [m.end() for m in (_ASCII_SENTENCE_END if single else _SENTENCE_END).finditer(line)]
        if not cuts:
            continue
        a = 0
        for b in (*cuts, len(line)):
            words = (plain[a:b] if single else line[a:b].encode("utf-8", "surrogatepass").translate(_SPACES).lower()).split()
            size = max(len(words), len(_SPACELESS.findall(line, a, b)) // WORD_CHARS) if spaceless else len(words)
            # One that holds all words of the line would repeat it.
            if size >= SENTENCE_WORDS and words != whole:
                yield start + a, start + b, b" ".join(words)
            a = b


def units(text: str) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, normalised) of every unit that takes part: lines and sentences, then all passages."""
    yield from _lines(text)
    found = _Passages(text)
    if found.n:
        starts, ends = found.spans(np.arange(found.n), found.again())
        yield from ((a, b, found.unit(i)) for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)))


def _joined(spans: Iterable[tuple[int, int]]) -> list[list[int]]:
    """Overlapping and touching spans as one."""
    joined: list[list[int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    return joined


#: What a task sends of a document: digests with the span to remove if the digest goes (of an anchor the number of its
#: first word); without a digest, spans that go anyway.
_DIGESTS = "doc_id long, key long, h1 long, h2 long, span long"


#: Rows that a task hands on at a time.
ROWS = 100_000


def _batch(docs: list[tuple[int, int, int, int]], digests: list[bytes], spans: list[int]) -> pa.RecordBatch:
    """docs: (doc_id, key, kind, count), for so many digests and spans each; kinds: 0 units, 1 anchors, 2 without a digest."""
    doc, key, kind, count = np.asarray(docs, np.int64).reshape(-1, 4).T
    kind = np.repeat(kind, count)
    halves = np.frombuffer(b"".join(digests), ">i8").reshape(-1, 2).astype(np.int64)
    none = kind == 2
    arrays = [
        pa.array(np.repeat(doc, count)),
        pa.array(np.repeat(key, count)),
        pa.array(halves[:, 0], mask=none),
        pa.array(halves[:, 1] & ~1 | kind & 1, mask=none),
        pa.array(spans, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "key", "h1", "h2", "span"])


def _rows(batches: Iterator[pa.RecordBatch], found_in) -> Iterator[pa.RecordBatch]:
    """found_in: (kind, digests, spans) of a row's text, any number of times."""
    docs, digests, spans = [], [], []
    for batch in batches:
        for row in range(batch.num_rows):
            doc, key = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
            for kind, of, at in found_in(batch, row):
                docs.append((doc, key, kind, len(at)))
                digests += of
                spans += at
                if len(spans) >= ROWS:
                    yield _batch(docs, digests, spans)
                    docs, digests, spans = [], [], []
    yield _batch(docs, digests, spans)


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines, sentences and anchors of every text, and what the text itself holds before."""

    def found_in(batch, row):
        text = batch.column(2)[row].as_py()
        first: dict[bytes, int] = {}
        own = []
        for start, end, unit in _lines(text):
            digest = _digest(unit)
            if digest in first:
                own.append((start, end))
            else:
                first[digest] = start << 32 | end
        yield 0, list(first), list(first.values())
        found = _Passages(text)
        words, digests = found.anchor_digests
        yield 1, digests, words.tolist()
        again = found.again()
        if again:
            own += zip(*(x.tolist() for x in found.spans(np.asarray(sorted(again)), again)), strict=True)
        own = [start << 32 | end for start, end in _joined(own)]
        yield 2, [bytes(16)] * len(own), own

    return _rows(batches, found_in)


def _emit_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The passages of the given anchors that no single one of the given spans holds; each digest where it is first."""

    def found_in(batch, row):
        found = _Passages(batch.column(2)[row].as_py())
        passages = np.flatnonzero(np.isin(found.anchors, batch.column(3)[row].values.to_numpy()))
        starts, ends = found.spans(passages, {})
        gone = np.sort(batch.column(4)[row].values.to_numpy())
        if len(gone):
            held = np.searchsorted(gone >> 32, starts, side="right") - 1
            reach = np.maximum.accumulate(gone & 0xFFFFFFFF)
            kept = (held < 0) | (ends > reach[held])
            passages, starts, ends = passages[kept], starts[kept], ends[kept]
        digests = found.digests(passages)
        if len(set(digests)) < len(digests):
            first: dict[bytes, int] = {}
            for i, digest in enumerate(digests):
                first.setdefault(digest, i)
            digests, passages = list(first), passages[[*first.values()]]
            starts, ends = found.spans(passages, {})
        again = found.again()
        if again:
            starts, ends = found.spans(passages, again)
        yield 0, digests, (starts << 32 | ends).tolist()

    return _rows(batches, found_in)


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, removed = [], []
        for row in range(batch.num_rows):
            text = batch.column(2)[row].as_py()
            spans = _joined((s >> 32, s & 0xFFFFFFFF) for s in batch.column(3)[row].as_py() or ())
            kept, at = [], 0
            for start, end in spans:
                kept.append(text[at:start])
                at = end
            texts.append("".join([*kept, text[at:]]))
            removed.append([{"start": a, "end": b} for a, b in spans])
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(removed, pa.list_(span))],
            ["doc_id", "text_key", "text", "removed"],
        )


def _repeated(found: DataFrame, name: str) -> DataFrame:
    """The digests that an earlier document holds, by document; of anchors all that several documents hold. Stored, and the
    given table is deleted. Each slice of the digests is exchanged once that of the one before is gone."""
    parts = [stored(found.where("h1 is null").select("doc_id", "key", "h2", "span"), name)]
    for i in range(SLICES):
        part = found.where(F.pmod("h1", F.lit(SLICES)) == i)
        groups = part.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        groups = groups.where("first < last").drop("last")
        later = part.join(groups, ["h1", "h2"]).where("doc_id > first or h2 & 1 = 1")
        parts.append(stored(later.select("doc_id", "key", "h2", "span"), name))
    forget(found)
    return functools.reduce(DataFrame.unionByName, parts)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (tells rows of one id apart), the text that is left, and the spans removed from the original."""
    python_path(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), text_key("text").alias("text_key"), text_of("text").alias("text"))
    rank = F.coalesce("doc_id", F.lit(LAST_ID))
    # Digests are made once: they are grouped, and meet their groups again.
    found = stored(rows.select(rank.alias("doc_id"), "text_key", "text").mapInArrow(_emit, _DIGESTS), "digests")
    repeated = _repeated(found, "repeated")
    # Bounded by a document's own units.
    anchors, lines = (F.collect_list(F.when(F.col("h2").bitwiseAND(1) == bit, F.col("span"))) for bit in (1, 0))
    known = repeated.groupBy(F.col("doc_id").alias("rank"), "key").agg(anchors.alias("anchors"), lines.alias("lines"))
    known = rows.join(known.where(F.size("anchors") > 0), (rank == F.col("rank")) & (F.col("text_key") == F.col("key")))
    found = known.select("rank", "text_key", "text", "anchors", "lines").mapInArrow(_emit_passages, _DIGESTS)
    passages = _repeated(stored(found, "passages"), "repeated-passages")
    spans = repeated.where("h2 is null or h2 & 1 = 0").unionByName(passages)
    spans = spans.groupBy(F.col("doc_id").alias("rank"), "key").agg(F.collect_list("span").alias("spans"))
    rows = rows.join(spans, (rank == F.col("rank")) & (F.col("text_key") == F.col("key")), "left")
    span = "array<struct<start:long,end:long>>"
    return rows.select("doc_id", "text_key", "text", "spans").mapInArrow(
        _clean, f"doc_id long, text_key long, text string, removed {span}"
    )


def op8_unit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = without_repeats(table(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    chars = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return rows.select(
        "doc_id",
        F.size("removed").cast("long").alias("n_removed"),
        chars.alias("removed_chars"),
        spans.alias("spans"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
    )
