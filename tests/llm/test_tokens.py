"""Word BPE and packing."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex

from depthbook.llm import packing, word_bpe


def ids_of(data):
    return np.frombuffer(bytes(data), "<u4").tolist()


@pytest.mark.parametrize("block_bytes", [1, 5_000, word_bpe.BLOCK_BYTES])
def test_bpe_equals_the_library_and_round_trips(odd_docs, odd_rows, block_bytes):
    rows = word_bpe.decoded(word_bpe.encoded(odd_docs, block_bytes=block_bytes)).collect()
    encode = word_bpe._encoding(word_bpe.RANKS).encode_ordinary
    expected = Counter((r[0], tuple(encode(r[1] or "")), (r[1] or "").encode()) for r in odd_rows)
    assert Counter((r.doc_id, tuple(ids_of(r.ids)), bytes(r.bytes)) for r in rows) == expected


def test_bpe_of_odd_splits(spark):
    rng = random.Random(5)
    signs = [*"abAB'1٣ \n\t!?’漢é", "'s", "  ", "\r\n", "\u00a0", "\u2028", "<|endoftext|>", "ß", "😀"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encode = word_bpe._encoding(word_bpe.RANKS).encode_ordinary
    for r in word_bpe.encoded(docs, block_bytes=2_000).collect():
        assert ids_of(r.ids) == encode(texts[r.doc_id])


def test_words_are_cut_without_the_slow_library(monkeypatch):
    """As the pattern cuts them, with its library left for texts of characters beyond 16 bits."""
    cut, taken = regex.compile(word_bpe.PATTERN).findall, []

    class Noted:
        def findall(self, text):
            taken.append(text)
            return cut(text)

    slow = regex.compile
    monkeypatch.setattr(regex, "compile", lambda p, *a: Noted() if p == word_bpe.PATTERN else slow(p, *a))
    word_bpe._splitter.cache_clear()
    split = word_bpe._splitter()
    rng = random.Random(6)
    every = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    signs = [*[c for c in every if c.isspace()], *"ab'strevmdl1²٣漢ßé?!_-"]
    texts = [f"{c}{c}a {c}1{c}'{c}\n" for c in every]
    texts += ["".join(rng.choices(every if i % 4 == 0 else signs, k=rng.randint(0, 40))) for i in range(20_000)]
    assert [split(t) for t in texts] == [cut(t) for t in texts]
    assert not taken
    assert split("a 😀é b") == cut("a 😀é b") and taken == ["a 😀é b"]
    word_bpe._splitter.cache_clear()


def test_bpe_of_nothing(no_docs):
    assert word_bpe.encoded(no_docs).count() == 0


def check_packing(pieces, tokens, window):
    """Every id in exactly one piece, windows gapless, no padding but at powers of two."""
    by_doc, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        windows[p.sequence_id].append((p.offset, p.length))
        assert p.length > 0
    assert set(by_doc) == set(tokens)
    for doc, parts in by_doc.items():
        at, left = 0, list(tokens[doc])
        for p in sorted(parts, key=lambda p: p.start):
            if p.start == 0 and at and at == p.doc_tokens:  # another row of this id
                at = 0
            data = np.asarray(left[p.start : p.start + p.length], dtype="<u4").tobytes()
            assert bytes(p.ids) == data and zlib.crc32(data) == zlib.crc32(bytes(p.ids)) and p.doc_tokens == len(left)
        assert sum(p.length for p in parts) % len(left) == 0
    for parts in windows.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window and (end == window or end & (end - 1) == 0)


@pytest.mark.parametrize(("window", "most_open"), [(2048, 4096), (64, 3), (16, 1)])
def test_packing(odd_docs, odd_rows, window, most_open):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    rows = [r for r in odd_rows if r[0] not in (None, 7)]  # ids of several texts are counted below
    tokens = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows}
    docs = odd_docs.where("doc_id is not null and doc_id <> 7")
    pieces = packing.pack_documents(docs, window=window, most_open=most_open).collect()
    check_packing(pieces, tokens, window)
    every = packing.pack_documents(odd_docs, window=window).groupBy().sum("length").first()[0]
    assert every == sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in odd_rows)


def test_words_alone_equal_whole_texts():
    from tokenizers import Tokenizer

    rng = random.Random(9)
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    signs = [*map(chr, range(0x180)), "'s", "İ", "Σσς", "ſ", "K", "e\u0301", "漢", "😀", "<|endoftext|>", " ", "\n", "don't"]
    words = packing._words(packing.TOKENIZER)
    for _ in range(1500):
        text = "".join(rng.choices(signs, k=30))
        assert ids_of(words.encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_of_nothing(no_docs):
    assert packing.pack_documents(no_docs).count() == 0
