"""Cross-tokenizer groups and SentencePiece with offsets, against the libraries and brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from depthbook.llm import piece_spans, token_groups

HOSTILE = "ab eE.\n\t\x00\x1c é漢字😀▁ ﬁ①ﾊﾞ́ 　​<|endoftext|></s><0x41>　's 12"


def texts(seed, n):
    rng = random.Random(seed)
    pools = [lambda: rng.choice(HOSTILE), lambda: chr(rng.randrange(32, 127)), lambda: chr(rng.randrange(0x20, 0xD7FF)), lambda: " "]
    return ["".join(rng.choice(pools)() for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_spans.MODEL)


def library_spans(processor, text):
    return [(p.id, p.begin, p.end) for p in processor.encode(text, return_type="proto").pieces]


def test_pieces_and_spans_are_the_librarys(library):
    model = piece_spans.model_of(piece_spans.MODEL)
    encoder = piece_spans.Encoder(model)
    for text in [*texts(1, 3000), "", " ", "a" * 3000, "ab" * 500 + " " * 300]:
        found = encoder.encode(text)
        assert list(zip(*(x.tolist() for x in found), strict=True)) == library_spans(library, text)
        assert model.decoded(found.ids.tolist()) == library.decode(found.ids.tolist())


def test_any_ids_decode_as_in_the_library(library):
    model, rng = piece_spans.model_of(piece_spans.MODEL), random.Random(4)
    for _ in range(3000):
        ids = [rng.randrange(300) if rng.random() < 0.7 else rng.randrange(32_000) for _ in range(rng.randrange(12))]
        assert model.decoded(ids) == library.decode(ids), ids


def _message(*fields):
    """Fields in the wire format: numbers, or bytes."""

    def number(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    parts = [number(k << 3 | 2) + number(len(v)) + v if isinstance(v, bytes) else number(k << 3) + number(v) for k, v in fields]
    return b"".join(parts)


@pytest.mark.parametrize("prefix", [0, 1])
@pytest.mark.parametrize("squeeze", [0, 1])
@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc_cf", "identity"])
def test_longest_prefixes_of_a_compiled_map(rule, squeeze, prefix):
    """The library's own maps, put into the public model: same normalised texts, pieces and spans."""
    compiled = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    compiled = dict(piece_spans._fields(dict(piece_spans._fields(compiled))[3])).get(2, b"")
    with open(piece_spans.MODEL, "rb") as file:
        # Of a message that comes twice, the later fields hold.
        changed = file.read() + _message((3, _message((2, compiled), (3, prefix), (4, squeeze), (5, 1))))
    library = sentencepiece.SentencePieceProcessor(model_proto=changed)
    parts = defaultdict(list)
    for field, value in piece_spans._fields(changed):
        parts[field].append(value)
    merged = _message(*((f, v) for f in parts if f != 3 for v in parts[f]), (3, b"".join(parts[3])))
    model = piece_spans.Model(merged)
    encoder = piece_spans.Encoder(model)
    assert bool(model.map) == (rule != "identity")
    for text in [*texts(2, 800), "   ", "  a  b  ", "①② ﬁ"]:
        found = encoder.encode(text)
        assert list(zip(*(x.tolist() for x in found), strict=True)) == library_spans(library, text), text
        assert model.decoded(found.ids.tolist()) == library.decode(found.ids.tolist())


def test_long_parts_merge_as_short_ones_do():
    model, rng = piece_spans.model_of(piece_spans.MODEL), random.Random(5)
    for _ in range(300):
        part = "".join(rng.choice("aeinrst") for _ in range(rng.randrange(1, 80)))
        assert model.merged(part) == model._merged_long(list(part))


def test_piece_spans_of_odd_rows(spark, odd_docs, odd_rows, no_docs, library):
    rows = piece_spans.encoded(odd_docs)
    found = Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in rows.collect())
    assert found == Counter((i, tuple(library.encode(t or "", add_eos=True))) for i, t, *_ in odd_rows)
    back = Counter((r["doc_id"], r["text"]) for r in piece_spans.decoded(rows).collect())
    assert back == Counter((i, library.decode(library.encode(t or ""))) for i, t, *_ in odd_rows)
    for r in rows.where("doc_id = 10").collect():
        starts, ends = (np.frombuffer(r[c], "<u8").tolist() for c in ("starts", "ends"))
        text = next(t for i, t, *_ in odd_rows if i == 10).encode()
        assert (starts[-1], ends[-1]) == (len(text), len(text))
        assert b"".join(text[a:b] for a, b in zip(starts, ends, strict=True)) == text
    assert piece_spans.encoded(no_docs).count() == 0 == piece_spans.decoded(piece_spans.encoded(no_docs)).count()


def test_query_op13(spark, library):
    from depthbook.llm.common import table

    docs = table(spark, "/root/testdata/sf0.001", "documents").collect()
    want = []
    for d in docs:
        ids = library.encode(d["text"] or "", add_eos=True)
        digests = (hashlib.sha256(t.encode()).hexdigest() for t in (" ".join(map(str, ids)), library.decode(ids)))
        want.append((d["doc_id"], len(ids), *digests))
    got = [tuple(r) for r in piece_spans.op13_piece_spans(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got) == sorted(want)


# ------------------------------------------------------------------------------------------------ alignment


def brute_tokens(rows):
    """Per row the (id, start, end) of both sides, by the libraries on whole texts."""
    tokenizer = Tokenizer.from_file(token_groups.TOKENIZER_A)
    tokenizer.encode_special_tokens = True
    processor = sentencepiece.SentencePieceProcessor(model_file=token_groups.MODEL_B)
    table = bytes_of_characters()
    out = []
    for text in rows:
        if not text:
            out.append(([], []))
            continue
        a = [(i, bytes(table[c] for c in tokenizer.id_to_token(i))) for i in tokenizer.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in processor.encode(text):
            name = processor.id_to_piece(i)
            b.append((i, bytes([int(name[3:5], 16)]) if processor.is_byte(i) else name.replace("▁", " ").encode()))
        sides = []
        for side in (a, b):
            at, placed = 0, []
            for i, raw in side:
                placed.append((i, at, at + len(raw)))
                at += len(raw)
            sides.append(placed if b"".join(raw for _, raw in side) == (" " + text).encode() else None)
        out.append(([], []) if None in sides else tuple(sides))
    return out


def bytes_of_characters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def brute_groups(rows):
    tokens = brute_tokens(rows)
    links = []
    shape = []
    for a, b in tokens:
        cuts = sorted({end for *_, end in a} & {end for *_, end in b})
        group = lambda end, cuts=cuts: next(i for i, c in enumerate(cuts) if end <= c)
        of_a, of_b = defaultdict(list), defaultdict(list)
        for i, _, end in a:
            of_a[group(end)].append(i)
        for i, _, end in b:
            of_b[group(end)].append(i)
        links.append([(x, y) for g in of_a for x in of_a[g] for y in of_b[g]])
        spelled = ";".join(",".join(map(str, of_a[g])) + "|" + ",".join(map(str, of_b[g])) for g in range(len(cuts)))
        shape.append((len(a), len(b), len(cuts), hashlib.sha256(spelled.encode()).hexdigest() if a else ""))
    counts = Counter(pair for found in links for pair in set(found))
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    return [
        (n_a, n_b, n_groups, len(found), sum(counts[p] == most[p[0]] for p in found), sum(counts[p] for p in found), digest)
        for (n_a, n_b, n_groups, digest), found in zip(shape, links, strict=True)
    ], counts, most


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("block", [token_groups.BLOCK_BYTES, 700])
def test_groups_equal_brute_force(spark, odd_rows, block):
    rows = [t for _, t, *_ in odd_rows if len(t or "") < 6000] + texts(6, 60) + ["long ▁", "x" * 700, " " * 90 + "a", "a <|endoftext|> b"]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(rows)], "doc_id long, text string, block long, a int")
    out, pairs = token_groups.alignments(docs, block_bytes=block)
    want, counts, most = brute_groups(rows)
    assert {r["doc_id"]: tuple(r[n] for n in NAMES) for r in out.collect()} == dict(enumerate(want))
    assert {(r["a"], r["b"]): (r["count"], r["best"]) for r in pairs.collect()} == {
        (a, b): (n, n == most[a]) for (a, b), n in counts.items()
    }


def test_pointers_reach_across_a_long_group():
    """Ends that never meet before the last: as many jumps as tokens, by doubling."""
    a, b = np.arange(2, 200_002, 2), np.arange(1, 200_002, 2)
    a = np.r_[a, 200_001]
    b[-1] = 200_001
    for found in token_groups.groups_of(a, b):
        assert not found.any()
    group_a, group_b = token_groups.groups_of(np.array([1, 3, 4, 9]), np.array([3, 4, 5, 9]))
    assert (group_a.tolist(), group_b.tolist()) == ([0, 0, 1, 2], [0, 1, 2, 2])


def test_words_of_the_byte_level_side():
    """The ASCII form of the pattern cuts as the pattern does, and the model alone gives the tokenizer's ids."""
    side, rng = token_groups.ByteLevel(token_groups.TOKENIZER_A), random.Random(8)
    ascii_texts = [chr(i) + chr(j) for i in range(128) for j in range(128)]
    ascii_texts += ["".join(rng.choices("a'slrevmtd1 \t\n\x1c\x0b.<|>", k=rng.randrange(1, 9))) for _ in range(5000)]
    assert all(side.find_ascii(t) == side.find(t) for t in ascii_texts)
    rows = [*ascii_texts[::7], *texts(9, 3000), "".join(map(chr, range(0x250))), "<|endoftext|> x"]
    library = Tokenizer.from_file(token_groups.TOKENIZER_A)
    library.encode_special_tokens = True
    assert [ids.tolist() for ids in side.encode(rows)] == [library.encode(t, add_special_tokens=False).ids for t in rows]


def test_pairs_made_in_parts(monkeypatch):
    side_a, side_b = token_groups.ByteLevel(token_groups.TOKENIZER_A), token_groups.PieceLevel(token_groups.MODEL_B)
    rows = texts(7, 40)
    whole = token_groups.align(rows, side_a, side_b)
    monkeypatch.setattr(token_groups, "PAIRS_AT_ONCE", 3)
    for x, y in zip(whole, token_groups.align(rows, side_a, side_b), strict=True):
        assert x[:5] == y[:5] and np.array_equal(x.pairs, y.pairs) and np.array_equal(x.times, y.times)


def test_no_documents_no_groups(spark, no_docs):
    out, pairs = token_groups.alignments(no_docs)
    assert out.count() == 0 == pairs.count()
    empty = spark.createDataFrame([(1, None), (None, ""), (1, "")], "doc_id long, text string")
    assert [tuple(r)[1:] for r in token_groups.alignments(empty)[0].collect()] == [(0, 0, 0, 0, 0, 0, "")] * 3
