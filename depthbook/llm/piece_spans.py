"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised from left to right: at every place the longest key of the model's compiled character map that
starts there is replaced, anything else is copied character by character, and for every character of the result the
byte of the text it comes from is noted. Pieces are found on the normalised text, so that a piece's span there is a
span of bytes of the original through that record. As the library does, a character spelled in bytes gives its span to
the last of them; the others are empty, and so is the mark put before a text.

No merge can join two neighbouring characters that no piece holds side by side. The normalised text is cut at such places
(before spaces, between letters and signs, around characters that stand alone); a task merges each part once and remembers
its ids and lengths (`REMEMBERED` entries, then anew: a matter of speed, not of results).

Every document is worked on where it is read: nothing is shuffled, a repeated task gives the same rows.

Cases: null and empty texts have the end id alone; repeated rows are encoded again; a null id is carried along; an empty
table gives no rows; other columns are ignored. Models are of the BPE kind without pieces of the user's own; others are
refused when the model is read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import math
import re
import struct
from array import array
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthbook.llm.common import python_path, table, text_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
REMEMBERED = 400_000
#: Characters of a part beyond which its neighbours wait in a heap; a matter of speed too.
LONG = 400
NEVER = math.inf
#: Bytes of what a task hands on at a time.
BATCH_BYTES = 2_000_000

#: Fixed values of the model format: numbers of fields, and the kinds of pieces.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
REPLACEMENT = "�"


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message in the wire format of protocol buffers; numbers as int, all else as bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        found = shift = 0
        while True:
            byte = message[at]
            at += 1
            found |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return found

    while at < len(message):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, message[at : at + size]
        at += size


def character_map(compiled: bytes) -> dict[str, str]:
    """The replacements in a compiled map: the size of a double array, the array, and texts that end with a zero.

    A unit of the array holds a label, whether a key ends there, and how far its children are; where a key ends, the
    unit at that place holds the start of its text.
    """
    if not compiled:
        return {}
    size = int.from_bytes(compiled[:4], "little")
    units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
    texts = compiled[4 + size :]
    children = lambda place, unit: place ^ ((unit >> 10) << ((unit >> 6) & 8))
    found: dict[str, str] = {}
    open_ends = [(children(0, units[0]), b"")]
    while open_ends:
        base, key = open_ends.pop()
        for label in range(1, 256):
            place = base ^ label
            if place >= len(units) or units[place] & 0x800000FF != label:
                continue
            below = children(place, units[place])
            if units[place] >> 8 & 1:
                start = units[below] & 0x7FFFFFFF
                found[(key + bytes([label])).decode()] = texts[start : texts.index(0, start)].decode()
            open_ends.append((below, key + bytes([label])))
    return found


class Pieces(NamedTuple):
    """Ids of a text, and the spans of its pieces in bytes of the text."""

    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


class Model:
    """A SentencePiece model of the BPE kind."""

    def __init__(self, serialized: bytes):
        parts: dict[int, list] = {}
        for field, value in _fields(serialized):
            parts.setdefault(field, []).append(value)
        trainer = dict(_fields(parts[TRAINER][0]))
        if trainer.get(3, 1) != BPE:
            raise ValueError("not a model of the BPE kind")
        rule = dict(_fields(parts[NORMALIZER][0])) if NORMALIZER in parts else {}
        self._set_rule(rule.get(2, b""), rule.get(3, 1), rule.get(4, 1), rule.get(5, 1))
        if trainer.get(24, 0):
            raise ValueError("models that put the space after a word are not supported")
        self.names: list[str] = []
        self.kinds: list[int] = []
        self.ranks: dict[str, float] = {}  # low is good
        self.number: dict[str, int] = {}
        self.byte_ids: dict[int, int] = {}
        for i, piece in enumerate(parts[PIECE]):
            piece = dict(_fields(piece))
            name, kind = piece[1].decode(), piece.get(3, NORMAL)
            self.names.append(name)
            self.kinds.append(kind)
            if kind == NORMAL:
                self.number[name] = i
                self.ranks[name] = -struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]
            elif kind == BYTE:
                self.byte_ids[int(name[3:5], 16)] = i
            elif kind not in (UNKNOWN, CONTROL):
                raise ValueError(f"pieces of the kind of {name!r} are not supported")
        self.unknown = self.kinds.index(UNKNOWN)
        self.controls = frozenset(i for i, kind in enumerate(self.kinds) if kind == CONTROL)
        self.end = self.names.index(trainer.get(47, b"</s>").decode())
        self.unknown_text = trainer.get(44, b" \xe2\x81\x87 ").decode()
        if len(self.byte_ids) < 256:
            self.byte_ids = {}
        self.cuts = re.compile(self._parts(), re.DOTALL)
        self.sizes = [len(name.encode()) for name in self.names]
        self.shown = [self._shown(i) for i in range(len(self.names))]

    def _parts(self) -> str:
        """A pattern for the parts of a text that merge by themselves.

        A cut is safe between neighbours that no piece holds side by side. Characters that stand alone in all pieces are parts;
        spaces start one, where no piece has them within; and letters are cut from signs, in the directions in which no piece
        has both.
        """
        several = [name for name in self.number if len(name) > 1]
        pairs = {name[i : i + 2] for name in several for i in range(len(name) - 1)}
        known = sorted(set("".join(several)) - {SPACE})
        letters, signs = ("".join(re.escape(c) for c in known if c.isalpha() == kind) for kind in (True, False))
        if any(pair[1] == SPACE != pair[0] for pair in pairs):
            return f"[{letters}{signs}{SPACE}]+|."
        if not letters or not signs:
            return f"{SPACE}*[{letters}{signs}]+|{SPACE}+|." if known else f"{SPACE}+|."
        crossed = {(x.isalpha(), y.isalpha()) for x, y in pairs if x != SPACE}
        if (True, False) in crossed:
            body = f"[{letters}{signs}]+"
        else:
            body = f"[{signs}]*[{letters}]+|[{signs}]+" if (False, True) in crossed else f"[{letters}]+|[{signs}]+"
        return f"{SPACE}*(?:{body})|{SPACE}+|."

    def _set_rule(self, compiled: bytes, prefix: int, squeeze: int, escape: int) -> None:
        self.map = character_map(compiled)
        self.prefix, self.squeeze, self.space = bool(prefix), bool(squeeze), SPACE if escape else " "
        lengths: dict[str, set[int]] = {}
        for key in self.map:
            lengths.setdefault(key[0], set()).add(len(key))
        self.lengths = {first: sorted(found, reverse=True) for first, found in lengths.items()}

    # ------------------------------------------------------------ normalising

    def _prefixes(self, text: str) -> Iterator[tuple[str, str]]:
        """(what is there, what it becomes), the longest known prefix at each place."""
        at = 0
        while at < len(text):
            for size in self.lengths.get(text[at], ()):
                if (key := text[at : at + size]) in self.map:
                    break
            else:
                key = text[at]
            yield key, self.map.get(key, key)
            at += len(key)

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes, and its end, the byte of the text it comes from."""
        if not text:
            return "", np.zeros(1, np.int64)
        if not self.map and not self.squeeze and self.space == SPACE:
            # Every character stands for itself, a space for the mark.
            raw = np.frombuffer(text.encode(), np.uint8)
            starts = np.flatnonzero((raw & 0xC0) != 0x80)
            sizes = np.diff(starts, append=len(raw))
            sizes[raw[starts] == 32] = 3
            before = np.zeros(3 if self.prefix else 0, np.int64)
            origin = np.concatenate([before, np.repeat(starts, sizes), [len(raw)]])
            return (SPACE if self.prefix else "") + text.replace(" ", SPACE), origin
        found = list(self._prefixes(text))
        first = at = 0
        while self.squeeze and first < len(found) and found[first][1] == " ":
            at += len(found[first][0].encode())
            first += 1
        if first == len(found):
            return "", np.zeros(1, np.int64)
        parts = [self.space] if self.prefix else []
        origin = [at] * (len(self.space.encode()) * len(parts))
        after_space = self.squeeze
        for key, result in found[first:]:
            if after_space:
                result = result.lstrip(" ")
            if result:
                after_space = self.squeeze and result.endswith(" ")
                parts.append(result.replace(" ", self.space))
                origin += [at] * len(parts[-1].encode())
            at += len(key.encode())
        out = "".join(parts)
        if self.squeeze:
            out = out.rstrip(self.space)
            size = len(out.encode())
            at = origin[size] if size < len(origin) else at
            del origin[size:]
        return out, np.asarray([*origin, at], np.int64)

    # --------------------------------------------------------------- encoding

    def merged(self, part: str) -> list[str]:
        """The part's pieces: of all neighbours that make a piece, those of the best score are joined, the left first."""
        texts = list(part)
        if len(texts) > LONG:
            return self._merged_long(texts)
        rank = self.ranks.get
        ranks = [rank(left + right, NEVER) for left, right in itertools.pairwise(texts)]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            i = ranks.index(best)
            texts[i] = whole = texts[i] + texts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = rank(texts[i - 1] + whole, NEVER)
            if i < len(ranks):
                ranks[i] = rank(whole + texts[i + 1], NEVER)
        return texts

    def _merged_long(self, texts: list[str]) -> list[str]:
        """The same by a heap, whose steps do not grow with the part."""
        n = len(texts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        waiting: list[tuple] = []

        def consider(left: int, right: int) -> None:
            if left >= 0 and right < n and (rank := self.ranks.get(whole := texts[left] + texts[right])) is not None:
                heapq.heappush(waiting, (rank, left, right, whole))

        for i in range(n - 1):
            consider(i, i + 1)
        while waiting:
            _, left, right, whole = heapq.heappop(waiting)
            # Stale if either has been joined with something since.
            if not texts[left] or after[left] != right or texts[left] + texts[right] != whole:
                continue
            texts[left], texts[right] = whole, ""
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            consider(before[left], left)
            consider(left, after[left])
        return [t for t in texts if t]

    def coded(self, part: str) -> list[int]:
        """Ids of a part, each followed by its length in bytes; of a character spelled in bytes the last has all."""
        out: list[int] = []
        for piece in self.merged(part):
            number = self.number.get(piece)
            if number is not None:
                out += (number, self.sizes[number])
            elif self.byte_ids:
                raw = piece.encode()
                for byte in raw[:-1]:
                    out += (self.byte_ids[byte], 0)
                out += (self.byte_ids[raw[-1]], len(raw))
            else:
                out += (self.unknown, len(piece.encode()))
        return out

    # --------------------------------------------------------------- decoding

    def _shown(self, number: int) -> bytes:
        kind, name = self.kinds[number], self.names[number]
        if kind == BYTE:
            return bytes([int(name[3:5], 16)])
        if kind == CONTROL:
            return b""
        return self.unknown_text.encode() if kind == UNKNOWN else name.replace(SPACE, " ").encode()

    def decoded(self, ids: list[int]) -> str:
        """The text that ids stand for: the mark of the first piece goes, bytes that make no character become U+FFFD."""
        while ids and ids[-1] in self.controls:
            ids = ids[:-1]
        if not self.controls.isdisjoint(ids):
            # They show nothing, and bytes on both sides of one make no character together.
            parts = [list(run) for shown, run in itertools.groupby(ids, lambda i: i not in self.controls) if shown]
            first = self.decoded(parts[0]) if parts else ""
            return first + "".join([self._text(part) for part in parts[1:]])
        if not ids:
            return ""
        marks = 0
        if self.prefix or self.squeeze:
            for name in map(self.names.__getitem__, ids):
                marks += name.startswith(SPACE)
                # Where spaces are squeezed, pieces that are nothing but the mark go until something is shown.
                if name != SPACE or not self.squeeze:
                    break
        return self._text(ids)[marks:]

    def _text(self, ids: list[int]) -> str:
        raw = b"".join([self.shown[i] for i in ids])
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return _with_replacements(raw)


def _with_replacements(raw: bytes) -> str:
    """Decoded, with every byte that belongs to no character replaced by itself."""
    parts, at = [], 0
    while at < len(raw):
        try:
            parts.append(raw[at:].decode())
            break
        except UnicodeDecodeError as wrong:
            parts.append(raw[at : at + wrong.start].decode() + REPLACEMENT)
            at += wrong.start + 1
    return "".join(parts)


class Encoder(dict):
    """Encodes texts; remembers the parts it has met as (id, length), (id, length), ... in four bytes each."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, part: str) -> bytes:
        self[part] = found = array("I", self.model.coded(part)).tobytes()
        return found

    def pieces(self, normalised: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and their lengths in bytes of the normalised text."""
        if len(self) > REMEMBERED:
            self.clear()
        found = b"".join(map(self.__getitem__, self.model.cuts.findall(normalised)))
        ids, sizes = np.frombuffer(found, np.uint32).reshape(-1, 2).T
        if not self.model.byte_ids and len(ids) > 1:
            # Unknown pieces in a row are one.
            fresh = np.flatnonzero((ids != self.model.unknown) | (np.r_[-1, ids[:-1]] != self.model.unknown))
            ids, sizes = ids[fresh], np.add.reduceat(sizes, fresh)
        return ids, sizes

    def encode(self, text: str) -> Pieces:
        normalised, origin = self.model.normalised(text)
        ids, sizes = self.pieces(normalised)
        ends = np.cumsum(sizes, dtype=np.int64)
        return Pieces(ids, origin[ends - sizes], origin[ends])


@functools.lru_cache(maxsize=2)
def model_of(path: str) -> Model:
    with open(path, "rb") as file:
        return Model(file.read())


_SCHEMA = "doc_id long, ids binary, starts binary, ends binary"


def _rows(batches: Iterator[pa.RecordBatch], schema: list[tuple], made: Callable) -> Iterator[pa.RecordBatch]:
    """Batches of the rows that `made` gives for (id, value of the second column on), each of a few megabytes."""
    names, types = [n for n, _ in schema], [t for _, t in schema]
    columns: list[list] = [[] for _ in names]
    size = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for found in batches:
        for row in zip(*found.columns, strict=True):
            for column, value in zip(columns, made(*[v.as_py() for v in row]), strict=True):
                column.append(value)
                size += len(value) if isinstance(value, bytes) else 8
            if size > BATCH_BYTES:
                yield batch()
                columns, size = [[] for _ in names], 0
    yield batch()


def _encode(path: str, end: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        encode = Encoder(model).encode
        last = np.asarray([model.end] if end else [], "<u4").tobytes()

        def made(doc, text):
            ids, starts, ends = encode(text)
            # The end id stands behind the text.
            stop = np.full(len(last) // 4, len(text.encode()), "<u8").tobytes()
            return doc, ids.astype("<u4").tobytes() + last, starts.astype("<u8").tobytes() + stop, ends.astype("<u8").tobytes() + stop

        binary = pa.binary()
        return _rows(batches, [("doc_id", pa.int64()), ("ids", binary), ("starts", binary), ("ends", binary)], made)

    return run


def encoded(docs: DataFrame, model: str = MODEL, end: bool = True) -> DataFrame:
    """doc_id, ids (unsigned 32-bit, little end first), starts and ends (unsigned 64-bit: bytes of the original text that
    each id covers), of every document; with the end id if asked for."""
    python_path(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), text_of("text").alias("text"))
    return texts.mapInArrow(_encode(model, end), _SCHEMA)


def _decode(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        kinds = [("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())]
        return _rows(batches, kinds, lambda doc, ids: (doc, ids, model.decoded(np.frombuffer(ids, "<u4").tolist())))

    return run


def decoded(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """Adds `text`, what the ids stand for."""
    python_path(rows.sparkSession)
    return rows.select("doc_id", "ids").mapInArrow(_decode(model), "doc_id long, ids binary, text string")


def _digest(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        decimal = list(map(str, range(len(model.names))))

        def made(doc, packed):
            ids = np.frombuffer(packed, "<u4").tolist()
            listed = " ".join([decimal[i] for i in ids])
            return doc, len(ids), *(hashlib.sha256(t.encode()).hexdigest() for t in (listed, model.decoded(ids)))

        kinds = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
        return _rows(batches, kinds, made)

    return run


def op13_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encoded(table(spark, sf_dir, "documents"))
    # Decoded text is digested where it is made, so that it need not pass through another worker.
    columns = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.select("doc_id", "ids").mapInArrow(_digest(MODEL), columns)
