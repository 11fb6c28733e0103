import hashlib

import numpy as np
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from repflow.llm import piece
from repflow.llm.encode import vocabulary
from repflow.llm.piece import Pieces, encode_texts, pieces, round_trip
from repflow.llm.queries import QUERIES
from repflow.llm.textkernel import utf8

MODEL = vocabulary("piece_bpe_32k.model")
ODD = ["", None, " ", "  a  b \n c\t d\n\n e", "it's 'S don't", "▁▁ x▁y", "▁", "<s> </s> <unk> <0x41>", "日本語テキスト 中文 字", "x" * 5000, "   " * 50,
       " " * 37 + "t", "aaaa" * 300, "\x00a\x00", "é́ é ﬁ", "😀😀 a😀b", "\r\n\x85 z", "1234567890 12,345.67"]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def _batch(texts):
    buf, off = utf8(pa.array(texts, pa.string()))
    return pieces(MODEL).batch(buf, off)


def _same(library, texts):
    for text, (ids, n, decoded) in zip(texts, _batch(texts)):
        want = library.encode(text or "")
        assert ids.decode() == ",".join(map(str, want)) and n == len(want) and decoded.decode() == library.decode(want), repr(text)


def test_odd_texts_equal_the_library(library):
    _same(library, ODD)
    _same(library, ODD[::-1])                # from the table of known stretches


def test_random_texts_equal_the_library(library):
    rng = np.random.default_rng(5)
    letters = list("abcdetionrs   ,.'▁\n\té中😀1")
    _same(library, ["".join(rng.choice(letters, rng.integers(1, 80))) for _ in range(2000)])
    names = pieces(MODEL).name
    some = [names[i] for i in rng.integers(259, len(names), 12_000)]
    _same(library, ["".join(some[i:i + 6]).replace("▁", " ") for i in range(0, len(some), 6)])
    _same(library, ["".join(some[i:i + 6]).replace("▁", "") for i in range(0, len(some), 6)])


def test_table_of_stretches_may_overflow(library, monkeypatch):
    monkeypatch.setattr(piece, "MAX_CACHED", 5)
    small = Pieces(MODEL)
    texts = [f"some words {i} and {i * 7} others, {i % 3}" for i in range(200)]
    buf, off = utf8(pa.array(texts))
    assert [x[0].decode() for x in small.batch(buf, off)] == [",".join(map(str, library.encode(t))) for t in texts]


def test_a_long_text_without_a_cut(library):
    rng = np.random.default_rng(6)
    text = "".join(rng.choice(list("abcde"), 300_000))
    _same(library, [text])


def test_query_equals_the_library(spark, library, odd_docs, no_docs):
    rows = odd_docs.collect()
    want = sorted((repr(r.doc_id), len(i := library.encode(r.text or "")), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
                   hashlib.sha256(library.decode(i).encode()).hexdigest()) for r in rows)
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip(odd_docs).collect()) == want
    back = {repr(r.doc_id): (list(r.ids), r.decoded) for r in encode_texts(odd_docs.dropDuplicates(["doc_id"])).collect()}
    for r in rows:
        if r.doc_id is not None:
            assert back[repr(r.doc_id)] == (library.encode(r.text or ""), r.text or "")
    assert round_trip(no_docs).collect() == [] and encode_texts(no_docs).collect() == []
    table = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op13_sentencepiece"](spark, table).collect()}
    docs = spark.read.parquet(f"{table}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids = library.encode(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids) and got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
