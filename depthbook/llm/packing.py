"""Sum-of-squares packing of tokenised documents into windows.

Every task tokenises its documents and packs them online: a window's fill is its level, an array counts the open
windows of each level, and a piece goes to the level that makes the sum of the squared counts smallest. Levels that
need no padding (a full window, a power of two) do not count. Whole windows are cut from long documents first; the
rest of a document, always shorter than a window, is what gets placed.

A task holds the token ids of its open windows only, at most `most_open` of them. When there are more, and at the end
of the task, the windows that would need padding are closed: their pieces are laid end to end, cut into full windows,
and what is left is cut into windows whose lengths are powers of two. So no padding remains, and no document is lost.

Nothing is shuffled. A repeated task reads the same split and so gives the same windows.

Cases: null and empty texts hold the end id alone; repeated rows are packed again; a null id is carried along; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthbook.llm.common import python_path, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
WINDOW = 2048
#: Open windows a task may hold: 4,096 windows of 2,048 ids of four bytes are 32 MB.
MOST_OPEN = 4096
#: Distinct words whose ids a Python worker remembers before it starts anew.
MOST_WORDS = 600_000

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


#: Signs that are one piece when they follow a word; the apostrophe is not among them, as it may join.
_SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
#: The characters that stand for bytes in byte-level vocabularies: printable Latin-1 for themselves, then from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: b for b in _PRINTED} | {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTED)))}


class _Words(dict):
    """Ids of a word as bytes. The tokenizer never joins what white space parts, so words may be encoded alone.

    Special strings hold no white space and are their ids, as by the library.
    A plain Latin word is looked up in lower case and without the signs after it; the tokenizer takes these apart too.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def __missing__(self, word: str) -> bytes:
        bare = word.rstrip(_SIGNS)
        if bare.isalpha() and max(bare) < "\u0130":  # composed, and lower case is one character for one
            plain = bare.lower()
            if plain == word:
                ids = [t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(_BYTES))]
                found = np.asarray(ids, dtype="<u4").tobytes()
            else:
                found = self[plain] + (self[word[len(bare) :]] if len(bare) < len(word) else b"")
        else:
            found = np.asarray(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        self[word] = found
        return found

    def encode(self, text: str) -> bytes:
        found = b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))
        if len(self) > MOST_WORDS:
            self.clear()
        return found


@functools.lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    return _Words(path)


class Packer:
    """Online packing of one stream of pieces. `emit` gets (doc, start, ids, doc_tokens, window, offset)."""

    def __init__(self, emit: Callable, window: int = WINDOW, most_open: int = MOST_OPEN):
        self.emit, self.window, self.most_open = emit, window, most_open
        self.windows = 0
        self.n_open = 0
        self.open: list[list[list]] = [[] for _ in range(window + 1)]  # level -> windows, each a list of pieces
        self.counts = np.zeros(window + 1, dtype=np.int64)
        level = np.arange(window + 1)
        self.counted = ((level & (level - 1)) != 0) & (level < window)  # levels that would need padding

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.emit(doc, start, ids, total, self.windows, offset)
            offset += len(ids) // 4
        self.windows += 1

    def add(self, doc, ids: bytes) -> None:
        total = len(ids) // 4
        whole = total // self.window * self.window
        for start in range(0, whole, self.window):
            self._close([(doc, start, ids[4 * start : 4 * (start + self.window)], total)])
        if total > whole:
            self.place((doc, whole, ids[4 * whole :], total))

    def place(self, piece: tuple) -> None:
        size = len(piece[2]) // 4
        n, counted = self.counts, self.counted
        before = slice(0, self.window - size + 1)
        after = slice(size, self.window + 1)
        change = np.where(counted[after], 2 * n[after] + 1, 0) - np.where(counted[before], 2 * n[before] - 1, 0)
        usable = n[before] > 0
        usable[0] = True  # a new window
        change = np.where(usable, change, np.iinfo(np.int64).max)
        level = len(change) - 1 - int(np.argmin(change[::-1]))  # of equal ones the fullest
        if level:
            pieces = self.open[level].pop()
            n[level] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            self._close(pieces)
            return
        self.open[level + size].append(pieces)
        n[level + size] += 1
        self.n_open += 1
        if self.n_open > self.most_open:
            self.finish()

    def finish(self) -> None:
        """Close every open window without padding."""
        loose = []
        for level in range(1, self.window):
            for pieces in self.open[level]:
                if self.counted[level]:
                    loose += pieces
                else:
                    self._close(pieces)
            self.open[level] = []
        self.counts[:] = 0
        self.n_open = 0
        left = sum(len(p[2]) // 4 for p in loose)
        loose.reverse()
        while left:
            size = self.window if left >= self.window else 1 << (left.bit_length() - 1)
            left -= size
            pieces = []
            while size:
                doc, start, ids, total = loose.pop()
                n = len(ids) // 4
                if n > size:
                    loose.append((doc, start + size, ids[4 * size :], total))
                    ids, n = ids[: 4 * size], size
                pieces.append((doc, start, ids, total))
                size -= n
            self._close(pieces)


def _pack(tokenizer: str, window: int, most_open: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer)
        first = TaskContext.get().partitionId() << 36
        end = np.asarray([END_ID], dtype="<u4").tobytes()
        rows: list[tuple] = []
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        types = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
        held = 0

        def emit(doc, start, ids, total, number, offset):
            nonlocal held
            rows.append((doc, start, len(ids) // 4, ids, total, first + number, offset))
            held += len(ids)

        def batch():
            nonlocal held
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
            rows.clear()
            held = 0
            return made

        packer = Packer(emit, window, most_open)
        for found in batches:
            for doc, text in zip(found.column(0).to_pylist(), found.column(1), strict=True):
                packer.add(doc, words.encode(text.as_py() or "") + end)
                if held > 4_000_000:
                    yield batch()
        packer.finish()
        words.clear()  # the Python worker lives on
        yield batch()

    return run


def pack_documents(
    docs: DataFrame, tokenizer: str = TOKENIZER, window: int = WINDOW, most_open: int = MOST_OPEN
) -> DataFrame:
    """One row per piece: document, its first id and length there, the ids themselves (unsigned 32-bit integers, little
    end first), the document's ids in all, the window and the place in it."""
    python_path(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pack(tokenizer, window, most_open), SCHEMA)


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(pack_documents(table(spark, sf_dir, "documents")))
