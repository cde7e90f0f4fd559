"""BPE against the tokenizers library, and the ORC stream read back."""

from __future__ import annotations

import hashlib
import random
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetlake.llm import bpe, orc_tokens
from fleetlake.session import scratch_path

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def byte_library():
    return Tokenizer.from_file(BYTE)


def test_ids_equal_the_library_for_every_character(byte_library):
    chars = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000] + [chr(c) for c in range(0x10000, 0x11000)]
    texts = [f"a{c}b {c}{c} 1{c} x \n{c}'s" for c in chars]
    expected = [e.ids for e in byte_library.encode_batch(texts, add_special_tokens=False)]
    assert list(bpe.load(BYTE).encode_all(texts)) == expected


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet=" \n\tab'stLL12.é<|endof>", max_size=120))
def test_any_text_round_trips_as_in_the_library(text):
    library, own = Tokenizer.from_file(BYTE) if not hasattr(bpe, "_t") else bpe._t, bpe.load(BYTE)
    bpe._t = library
    expected = library.encode(text, add_special_tokens=False).ids
    ids = next(own.encode_all([text]))
    assert ids == expected
    assert own.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_long_words_equal_the_library(byte_library):
    draw = random.Random(1)
    texts = ["a" * 500, "ab" * 400, "".join(draw.choice("theanin") for _ in range(900)), "é" * 200, " " * 300 + "x"]
    assert list(bpe.load(BYTE).encode_all(texts)) == [
        e.ids for e in byte_library.encode_batch(texts, add_special_tokens=False)
    ]


def test_digests(odd_docs, byte_library):
    expected = Counter()
    for row in odd_docs.collect():
        ids = byte_library.encode(row.text or "", add_special_tokens=False).ids
        joined = ",".join(map(str, ids)).encode()
        back = byte_library.decode(ids, skip_special_tokens=False).encode()
        expected[row.doc_id, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(back).hexdigest()] += 1
    assert Counter(map(tuple, bpe.digests(odd_docs, BYTE).collect())) == expected


def test_encode_keeps_other_columns_and_decode_inverts(odd_docs, no_docs):
    coded = bpe.encode(odd_docs, BYTE)
    assert set(coded.columns) == set(odd_docs.columns)
    assert dict(coded.dtypes)["ids"] == "array<int>"
    texts = Counter(r.text or "" for r in odd_docs.collect())
    assert Counter(r.text for r in bpe.decode(coded, BYTE).collect()) == texts
    assert bpe.encode(no_docs, BYTE).count() == 0


def test_orc_stream(spark, odd_docs, no_docs):
    library = Tokenizer.from_file(WORD)
    rows = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    expected, start = [], 0
    for row in rows:
        ids = [*library.encode(row.text or "", add_special_tokens=False).ids, 2]
        expected.append((row.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = [tuple(r) for r in orc_tokens.stored_tokens(odd_docs, WORD).collect()]
    assert sorted(found, key=lambda r: r[1]) == expected
    assert orc_tokens.stored_tokens(no_docs, WORD).count() == 0


def test_words_between_odd_spaces_equal_the_library():
    library, own = Tokenizer.from_file(WORD), orc_tokens.load(WORD)
    texts = [f"A{chr(c)}b {chr(c)}C{chr(c)} d" for c in [*range(0x300), *range(0x2000, 0x2070), 0x3000, 0xFEFF, 0x301, 0x3A3]]
    texts += ["ΑΣ ΣΑΣ", "é ́x", "<|startoftext|> a<|endoftext|>", "a  b\n\nc\td\r\ne"]
    texts += [f"x{chr(c)}Y {chr(c)}" for c in range(0x20, 0x250)] + ["don't I'LL 12 a1b2", "a\u0308 E\u0301x"]
    expected = [orc_tokens.packed(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert own.encode_all(texts) == expected


def test_known_words_cost_no_python_call_each():
    own, calls = orc_tokens.WordEncoder(WORD), 0
    text = pa.array([" ".join(f"w{k}x" for k in range(2000))])
    first = own.encode_column(text)[0]

    def count(*_):
        nonlocal calls
        calls += 1

    sys.setprofile(count)
    try:
        again = own.encode_column(text)[0]
    finally:
        sys.setprofile(None)
    assert calls < 1000
    assert first.tolist() == again.tolist() == Tokenizer.from_file(WORD).encode(text[0].as_py(), add_special_tokens=False).ids


def test_words_that_leave_the_memory_equal_the_library(monkeypatch):
    monkeypatch.setattr(orc_tokens, "WORDS", 3)
    monkeypatch.setattr(orc_tokens, "PIECES", 3)
    library, own = Tokenizer.from_file(WORD), orc_tokens.WordEncoder(WORD)
    texts = ["one two Three", "four, five six", "one two seven", "", "ein Wörtchen éé " + "x" * 80, "Three one 8", "one " + "x" * 80] * 2
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode_column(pa.array([text, None]))[0].tolist() == ids


def test_orc_files_carry_bloom_filters_and_are_in_order(spark, make_docs):
    docs = make_docs(*[(k, f"word{k} text") for k in range(500)])
    folder = scratch_path(spark, "tokens")
    orc_tokens.write_tokens(docs, WORD, folder, 2, files=4)
    spans = (
        spark.read.schema(orc_tokens.SCHEMA).orc(folder).groupBy("file").agg({"doc_id": "min", "*": "count"}).orderBy("file").collect()
    )
    assert [r["min(doc_id)"] for r in spans] == sorted(r["min(doc_id)"] for r in spans)
    assert sum(r["count(1)"] for r in spans) == 500
    one = spark.read.schema(orc_tokens.SCHEMA).orc(folder).where("doc_id = 123")
    assert "EqualTo(doc_id,123)" in one._jdf.queryExecution().toString()
    assert one.count() == 1
