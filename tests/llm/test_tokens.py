import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tallyhawk.llm import tokens
from tallyhawk.llm.common import new_folder
from tallyhawk.llm.tokens import Encoder, ShardReader, read_shards, tokens_digest, train_dictionary, write_shards
from tests.llm.helpers import documents, morse_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", None, " ", "\n\n", "a", " a", "a ", "a  b", "a\n\nb", "tab\tand\r\nline\x0b\x0cend \t", "it's we'll don't", "x\xa0 y", "x\xa0  y z",
    "　 wide", "a   b", "…dots “quoted” – dash", "\x1c\x1d odd", "\x85 next", "漢字 かな", "emoji 😀 👩‍👩‍👧 x", "<|endoftext|>", "a <|endoftext|> b",
    "1234567 3.14", "%%% &&& $$$", "word" * 3000, "é" * 2000 + " é", "trailing   ", "\n leading", "﻿bom",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pieces_give_what_the_library_gives(library, monkeypatch):
    rnd = random.Random(1)
    alphabet = [*"abc ABC 123 .,'!\n\t\r", "\xa0", " ", "é", "漢", "<|endoftext|>", "'s", "  ", "\x1c"]
    texts = ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60))) for _ in range(1500)]
    code = Encoder(PATH)
    for size in (2_000_000, 50):
        monkeypatch.setattr("tallyhawk.llm.shingles.CHUNK_BYTES", size)
        got = [ids.tolist() for ids in code.encode(pa.array(texts))]
        assert got == [library(t) for t in texts]
    monkeypatch.setattr(tokens, "PIECES", 10)  # forgets again and again
    assert [ids.tolist() for ids in code.encode(pa.array(texts))] == got


def test_clashing_pieces_are_encoded_whole(library, monkeypatch):
    real = tokens.span_hashes
    monkeypatch.setattr(tokens, "span_hashes", lambda *spans: (real(*spans)[0] % np.uint64(7), real(*spans)[1]))
    texts = ["some words here", "other words there", "some words"]
    assert [ids.tolist() for ids in Encoder(PATH).encode(pa.array(texts))] == [library(t) for t in texts]


def test_pieces_made_to_collide(library):
    texts = morse_texts()
    for pair in (texts, [f"some {t} more" for t in texts], ["x" * 25 + "a", "x" * 25 + "b", "x" * 24, "x" * 23 + "\0"]):
        assert [ids.tolist() for ids in Encoder(PATH).encode(pa.array(pair))] == [library(t) for t in pair]


def test_the_dictionary_sees_all_parts_of_documents():
    ids = np.arange(40_000, dtype="<u2")
    starts = {int(tokens._slice(ids, key * 7919)[0]) for key in range(50)}
    assert max(starts) > 20_000 and min(starts) < 10_000
    assert all(tokens._slice(ids, key).nbytes == tokens.SAMPLE_BYTES for key in (0, 5, -3))
    assert tokens._slice(ids[:10], 3).tolist() == list(range(10))


def test_shards_are_read_back_as_written(spark, library):
    rnd = random.Random(2)
    rows = [(i * 2, " ".join(rnd.choice(["alpha", "beta", "gamma"]) for _ in range(rnd.randrange(80))), "s") for i in range(300)]
    rows += [(1000 + i, t, None) for i, t in enumerate(ODD)] + [(7, "same", "s"), (7, "same", "s"), (9, "b", "s"), (9, "a", "s")]
    docs = documents(spark, rows, "")
    folder = new_folder(spark, "tokens-test")
    shards = write_shards(docs, PATH, folder, shard_rows=60)
    got = read_shards(spark, folder, shards).collect()
    assert len(got) == len(rows) and len({r["start"] for r in got}) == len(rows)
    got.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted(r[0] for r in rows)
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    want = sorted((i, zlib.crc32(np.array([*library(t), 0], "<u4").tobytes()), len(library(t)) + 1) for i, t, _ in rows)
    assert sorted((r["doc_id"], r["ids_crc32"], r["n_tokens"]) for r in got) == want
    # One document alone, by id.
    dictionary = tokens._read_file(f"{folder}/{tokens.DICTIONARY}")
    readers = [ShardReader(r["path"], dictionary) for r in shards.collect()]
    found = [ids.tolist() for reader in readers for ids in reader.find(7)]
    assert found == [[*library("same"), 0]] * 2
    assert not [ids for reader in readers for ids in reader.find(11)]
    with pytest.raises(ValueError, match="no shard"):
        ShardReader(shards.first()["path"], b"another dictionary")


def test_null_ids_clashes_and_empty_tables(spark):
    docs = documents(spark, [(None, "x y", "s", 1), (None, None, "s", 2), (5, "z", None, 3)], ", start int")
    got = sorted(tokens_digest(docs).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, None, 5] and got[0]["start"] == 0
    assert tokens_digest(docs.limit(0)).collect() == []
    assert train_dictionary([]) == b"" and train_dictionary([b"", b"ab"]) == b"ab"
    assert len(train_dictionary([bytes(np.random.default_rng(k).integers(0, 9, 400, np.uint8)) for k in range(500)], 4096)) <= 4096


def test_new_pieces_are_encoded_together():
    class Counted:
        def __init__(self, inner):
            self.inner, self.texts = inner, 0

        def encode_batch_fast(self, texts, **how):
            self.texts += len(texts)
            return self.inner.encode_batch_fast(texts, **how)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    code = Encoder(str(public_tokenizers.path("byte_bpe_50k.json")))
    code.tokenizer = Counted(code.tokenizer)
    words = [f"{a}{b}{c}'s" for a in "bdfgk" for b in ("ou", "é", "ä3", "x_y") for c in ("n", "rt", "日", "<P>", "　", "é")]
    texts = [" ".join(words), "\n\t ".join(words), " ", "", f"  {words[0]} \n", "a　 b", None] * 2
    got = [ids.tolist() for ids in code.encode(pa.array(texts))]
    alone = Encoder(str(public_tokenizers.path("byte_bpe_50k.json"))).tokenizer
    assert got == [alone.encode(t or "", add_special_tokens=False).ids for t in texts]
    code._forget()
    code.tokenizer.texts = 0
    plain = " ".join(f"w{k}" for k in range(3_000))
    assert [i.tolist() for i in code.encode(pa.array([plain]))] == [alone.encode(plain, add_special_tokens=False).ids]
    assert code.tokenizer.texts < 30
    # Where bytes of ids and of the text differ, pieces are encoded alone.
    code._forget()
    code._bytes = code._bytes + 1
    assert [i.tolist() for i in code.encode(pa.array([plain]))] == [alone.encode(plain, add_special_tokens=False).ids]
