import hashlib
import random
from array import array

import public_tokenizers
import pytest
import tiktoken

from cases import ROWS, documents, empty
from conftest import SF0001
from stockpilot.llm import byte_bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = byte_bpe.read_file(PATH)
ODD = [
    "", " ", "  ", " a  b ", "a\n  b", "a  \nb\n\n c", "\x1cb \x85 c ᠎ d\xa0 e", "don't we'LL 12345 ½ x²",
    "日本語 テキスト 🙂🙂", "\t\ttab \r\n x", " " * 50 + "y", "a   b", "<|endoftext|> q", "​ z 　 k",
    "ſ 's 'S", "a" * 5000, "ab" * 3000 + " end", "=-" * 700, "́́ é",
]


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.Encoder(byte_bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(VOCABULARY), special_tokens={}
    )


def ids_of(data):
    ids = array("I")
    ids.frombytes(data)
    return ids.tolist()


def test_odd_texts_as_the_library(coder, library):
    for text in ODD:
        assert ids_of(coder.encode(text)) == library.encode_ordinary(text), text[:40]


def test_long_pieces_are_emitted_in_windows(coder, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "WINDOW", 16)
    rng, tokens = random.Random(1), list(coder.transducer.tokens.values())
    for _ in range(2000):
        piece = b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 12)))
        assert coder.transducer.encode(piece) == library._core_bpe.encode_single_piece(piece)


def test_states_may_be_forgotten(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MAX_STATES", 50)
    monkeypatch.setattr(byte_bpe, "MAX_UNITS", 3)
    coder = byte_bpe.Encoder(byte_bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN)
    text = "unbelievable tokenisation of internationalised words again and again and again"
    assert ids_of(coder.encode(text)) == library.encode_ordinary(text)


def test_decoding_in_any_steps(coder):
    rng = random.Random(2)
    decoder = byte_bpe.Decoder(coder.transducer.tokens)
    for text in ODD:
        ids, out = ids_of(coder.encode(text)), []
        while ids:
            n = rng.randint(1, 3)
            out.append(decoder.feed(ids[:n]))
            ids = ids[n:]
        assert "".join(out) + decoder.end() == text


def test_bytes_that_are_no_text():
    decoder = byte_bpe.Decoder({0: b"\xe3\x81", 1: b"a", 2: b"\xff", 3: b"\x82"})
    assert decoder.feed([0, 3, 0, 1, 2]) + decoder.end() == "あ�a�"
    assert decoder.feed([0]) + decoder.end() == "�"


def test_cases(spark, library):
    got = byte_bpe.byte_bpe(documents(spark), PATH, public_tokenizers.PATTERN).collect()
    want = []
    for r in ROWS:
        ids = library.encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert byte_bpe.byte_bpe(empty(spark), PATH, public_tokenizers.PATTERN).count() == 0


def test_query(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    for r in queries.op2_byte_bpe(spark, SF0001).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["ids_sha256"] == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
