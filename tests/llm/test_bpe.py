"""BPE encoding and decoding against the library, and the lookahead against whole-word merging."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import bpe
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return packed(ids), library.decode(ids, skip_special_tokens=False)


ODD = [
    "", " ", "  ", "   x", "x  ", "\n\n x", "\r\n\r\n", "it's they'll I'd we've 'tis ''s 'S x're 'r e", "don'", "'l", "12 345² Ⅷ x1y2",
    "a　　b   c\u0085d", "\x1c\x1d a\x1fb", "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|", "  <|endoftext|>  x",
    "ünï çödé ☃ 中文字 👩‍👩‍👧 ́x", "ᲉꟚ\U000105c0 x\U0001e5f8", "a" * 5000, " " * 5000 + "x", "\n" * 4000, "-" * 3000 + "=", "ab" * 3000,
    "1" * 3000, "中" * 3000, "x\x00y\x7f�﻿",
]


def test_odd_texts_as_the_library(library):
    v = bpe.vocabulary(PATH)
    for text in [None] + ODD:
        ids, decoded = expected(library, text)
        assert bpe.encode_text(v, text) == ids, text
        assert bpe.decode_tokens(v, ids) == decoded, text


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 50, 1024])
def test_small_chunks_change_nothing(library, monkeypatch, chunk):
    """Every cut of a text, also inside blanks, contractions, added strings and splits far longer than a chunk."""
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    v = bpe.vocabulary(PATH)
    rnd = random.Random(chunk)
    for text in ODD + ["".join(rnd.choice(["a", "the", " ", "  ", "\n", "'", "'s", "'re", "1", ".", "é", "中", "<|endoftext|>", "<|"])
                               for _ in range(400)) for _ in range(30)]:
        ids, decoded = expected(library, text)
        assert bpe.encode_text(v, text) == ids, text
        assert bpe.decode_tokens(v, ids) == decoded


@settings(max_examples=300)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(text):
    library, v = Tokenizer.from_file(PATH) if not hasattr(test_any_text, "lib") else test_any_text.lib, bpe.vocabulary(PATH)
    test_any_text.lib = library
    assert bpe.encode_text(v, text) == expected(library, text)[0]


def test_characters_have_the_librarys_classes():
    """All characters at once: each is joined with a letter, a digit or a sign as the library joins it."""
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    pattern = bpe.vocabulary(PATH).splits
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 4096):
        text = "".join(f"x{c}9{c}!{c}\n" for c in points[start:start + 4096])
        assert [m.span() for m in pattern.finditer(text)] == [span for _, span in split(text)], start


def _random_merges(rnd, letters):
    parts, made, spelled = [], [], {i: bytes([97 + i]) for i in range(letters)}
    words = set(spelled.values())
    while len(parts) < 25:
        a, b = rnd.choice(list(spelled)), rnd.choice(list(spelled))
        if spelled[a] + spelled[b] in words or len(spelled[a] + spelled[b]) > 12:
            continue
        words.add(spelled[a] + spelled[b])
        parts.append((a, b))
        made.append(len(spelled))
        spelled[made[-1]] = spelled[a] + spelled[b]
    return bpe.Merges(parts, made, spelled)


def _plain_merge(m, symbols):
    """One merge at a time: the lowest rank, the leftmost place."""
    symbols = list(symbols)
    while True:
        ranks = [(m.ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in m.ranks]
        if not ranks:
            return symbols
        r, i = min(ranks)
        symbols[i:i + 2] = [m.made[r]]


@pytest.mark.parametrize("seed", range(40))
def test_lookahead_is_sufficient(seed):
    """No continuation changes a token that ends the lookahead or more before the end of the known text."""
    rnd = random.Random(seed)
    m = _random_merges(rnd, rnd.choice([2, 3]))
    letters = 2 if 2 not in m.spelled or m.spelled[2] != b"c" else 3
    for _ in range(60):
        known = [rnd.randrange(letters) for _ in range(rnd.randrange(1, 3 * m.lookahead + 5))]
        limit = len(known) - m.lookahead
        stable = set()
        for _ in range(6):
            whole = _plain_merge(m, known + [rnd.randrange(letters) for _ in range(rnd.randrange(12))])
            assert m.merge(known) == _plain_merge(m, known) == m._heap(list(known))
            ends, end = [], 0
            for t in whole:
                end += len(m.spelled[t])
                if end <= limit:
                    ends.append((end, t))
            stable.add(tuple(ends))
        assert len(stable) == 1
        stream = bpe.MergeStream(m)
        text = [rnd.randrange(letters) for _ in range(8 * m.lookahead + 700)]
        out, at = [], 0
        while at < len(text):
            step = rnd.randrange(1, 90)
            out += stream.feed(text[at:at + step])
            assert len(stream.window) <= 4 * m.lookahead + 256 + step
            at += step
        if _ == 0:
            assert out + stream.finish() == m._heap(list(text))


def test_a_merge_list_must_be_in_order():
    with pytest.raises(ValueError, match="used before it is made"):
        bpe.Merges([(3, 0), (0, 1)], [4, 3], {0: b"a", 1: b"b", 3: b"ab", 4: b"aba"})


def test_numbers_that_are_no_tokens_and_broken_characters():
    v = bpe.vocabulary(PATH)
    first = v.byte_ids["é".encode()[0]]
    assert bpe.decode_tokens(v, packed([first])) == "�"
    assert bpe.decode_tokens(v, packed([first, 4_000_000_000, v.byte_ids["é".encode()[1]]])) == "é"
    assert bpe.decode_tokens(v, None) == ""


def test_query_is_the_librarys(result, library, spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    found = result("op13_bpe")
    assert len(found.rows) == len(texts)
    for r in found.rows:
        ids, decoded = expected(library, texts[r.doc_id])
        assert r.n_tokens == len(ids) // 4 and r.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_operator_on_odd_rows(odd_docs, no_docs, library):
    clash = odd_docs.withColumnRenamed("rank", "IDS").withColumnRenamed("slot", "decoded")
    found = bpe.tokenize(clash, PATH)
    assert [c for c in found.columns if c.lower() in ("ids", "decoded")] == ["ids", "decoded"]
    rows = found.select("text", "ids", "decoded").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (bytes(r.ids), r.decoded) == expected(library, r.text)
    assert bpe.tokenize(no_docs, PATH).count() == 0
