"""Byte-level BPE against tiktoken; token files by round trip and against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from quillrank.llm import byte_bpe, token_files
from quillrank.llm.byte_bpe import EditableText, Encoder

LETTERS = "ab eé\n\t\x1c\x85 '’st日本кот12🙂́​ zzzΣσς<|endoftext|>!ﬁİ..,,"
TEXTS = [None, "", " ", "a b\n\n c", "it's the IT'S", "日本 кот", "x" * 5000, "the. the, The", "don't\x1cstop\x85now"]


SPECIAL = [
    "foo <|endoftext|> bar", "foo<|endoftext|>bar", "<|startoftext|><|endoftext|>", " <|ENDOFTEXT|>. x",
    "<|endoftext|>", "a\n<|endoftext|>\t<|endoftext|>!", "the <|endoftext| >", "İ<|endoftext|>ﬁ",
]


def random_texts(n, seed, longest=40):
    draw = random.Random(seed)
    return ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def encoder():
    return Encoder(byte_bpe.load_ranks(byte_bpe.default_vocabulary()), byte_bpe.default_pattern())


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = byte_bpe.load_ranks(byte_bpe.default_vocabulary())
    return tiktoken.Encoding("own", pat_str=byte_bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_library(encoder, library):
    for text in [t or "" for t in TEXTS] + random_texts(3000, 1):
        ids = encoder.encode(text)
        assert ids == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_edits_equal_encoding_anew(encoder, library):
    draw = random.Random(2)
    for text in random_texts(300, 3, 60):
        edited = EditableText(encoder, text)
        for _ in range(3):
            start = draw.randint(0, len(text))
            end = draw.randint(start, min(len(text), start + 5))
            new = random_texts(1, draw.random(), 5)[0]
            edited.edit(start, end, new)
            text = text[:start] + new + text[end:]
            assert edited.text == text and list(edited.ids()) == library.encode_ordinary(text)
        edited.append(" ends")
        assert list(edited.ids()) == library.encode_ordinary(text + " ends")


def test_edit_encodes_near_the_change_only(encoder):
    edited = EditableText(encoder, "some words go here " * 500)
    before = edited.encoded_bytes
    edited.edit(5000, 5001, "x")
    assert edited.encoded_bytes - before < 60


def test_prefixes_append_and_cut(encoder):
    table = byte_bpe.Prefixes(encoder.vocabulary, b"hel")
    table.append(b"lothere")
    assert table.ids() == byte_bpe.Prefixes(encoder.vocabulary, b"hellothere").ids()
    table.cut(5)
    assert table.ids() == byte_bpe.Prefixes(encoder.vocabulary, b"hello").ids()


def test_missing_byte_is_refused():
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary({b"a": 0})


def test_bpe_query_rows(spark, library):
    rows = [(None if i == 3 else i // 2, text, "extra") for i, text in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, n_tokens STRING")
    got = byte_bpe.token_digests(df, "doc_id", "text").collect()
    assert len(got) == len(rows)
    expected = []
    for key, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected.append((key, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    full = byte_bpe.encode(df, "doc_id", "text").collect()
    assert all(bytes(r["decoded"]).decode() in [t or "" for t in TEXTS] for r in full)
    assert byte_bpe.token_digests(df.limit(0), "doc_id", "text").count() == 0


def test_simple8b_round_trip():
    draw = random.Random(4)
    edges = [0, 0, 0, (1 << 30) - 2, (1 << 30) - 1, 1 << 30, 1 << 62]
    for _ in range(500):
        n, top = draw.randint(0, 700), draw.choice([1, 2, 5, 100, 5000, 60000, 2**31, 2**50])
        ids = np.array([draw.choice(edges) if draw.random() < 0.1 else draw.randint(0, top) for _ in range(n)], np.uint64)
        if draw.random() < 0.2:
            ids[:] = 0
        words, escapes = token_files.pack(ids)
        assert (token_files.unpack(words, escapes, n) == ids).all()
    words, _ = token_files.pack(np.zeros(480, np.uint64))
    assert len(words) == 2  # runs of 240 zeros


def test_word_ids_equal_library():
    words = token_files._Words(token_files.default_tokenizer())
    fresh = Tokenizer.from_file(token_files.default_tokenizer())
    texts = TEXTS + SPECIAL + random_texts(5000, 5)
    for at in range(0, len(texts), 64):
        part = texts[at : at + 64]
        for text, ids in zip(part, token_files.token_ids(part, words, 1)):
            expected = fresh.encode(text or "", add_special_tokens=False).ids + [1]
            assert np.frombuffer(ids, "<u4").tolist() == expected, text


@pytest.mark.parametrize("block_ids", [5, 65536])
def test_token_files_read_back(spark, tmp_path, block_ids):
    rows = [(None if i == 3 else i // 2, text, "x") for i, text in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, words STRING").repartition(3)
    path = str(tmp_path / "tokens")
    token_files.write_tokens(df, path, block_ids=block_ids)
    got = token_files.read_documents(spark, path).orderBy("start").collect()
    words = token_files._Words(token_files.default_tokenizer())
    assert [r["key"] for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k))
    start = 0
    for r in got:
        assert r["start"] == start and len(r["ids"]) == r["n_tokens"] and r["ids"][-1] == 1
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        start += r["n_tokens"]
    expected = sorted(np.frombuffer(ids, "<u4").tolist() for ids in token_files.token_ids([r[1] for r in rows], words, 1))
    assert sorted(r["ids"] for r in got) == expected


def test_token_files_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_tokens(spark.createDataFrame([], "doc_id LONG, text STRING"), path)
    assert token_files.read_documents(spark, path, digest_only=True).count() == 0
