import hashlib
import random

import numpy as np
import pytest

from tallyhawk.llm import repeats
from tallyhawk.llm.bitmaps import marked, set_slots
from tallyhawk.llm.repeats import remove_repeats, repeats_digest, without_repeats
from tests.llm.helpers import documents


def brute(rows, length=100):
    """Bytes left, bytes removed and runs by (doc_id, text); a null doc_id comes last."""
    seen, out = set(), {}
    for key in sorted({(r[0] if r[0] is not None else 1 << 62, r[1] or "") for r in rows}):
        text = key[1].encode()
        cover = bytearray(len(text))
        for p in range(len(text) - length + 1):
            if text[p : p + length] in seen:
                cover[p : p + length] = b"\1" * length
            seen.add(text[p : p + length])
        kept = bytes(b for b, gone in zip(text, cover, strict=True) if not gone)
        runs = sum(1 for p, gone in enumerate(cover) if gone and (p == 0 or not cover[p - 1]))
        out[key] = (len(text), len(text) - len(kept), runs, kept)
    return out


def passages(seed, n):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["alpha", "beta", "élan", "漢字", "x"]) + str(rnd.randrange(80))
    words = lambda k: " ".join(word() for _ in range(k))
    shared = [words(25) for _ in range(5)]
    return [
        (i, " ".join(
            rnd.choice([words(rnd.randrange(1, 12)), rnd.choice(shared), rnd.choice(shared)[: rnd.randrange(200)]])
            for _ in range(rnd.randrange(1, 7))
        ), "s")
        for i in range(n)
    ]


def compare(spark, rows, length=100):
    want = brute(rows, length)
    got = remove_repeats(documents(spark, rows), length).collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r["doc_id"] if r["doc_id"] is not None else 1 << 62, r["text"] or ""]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == w, r["doc_id"]


@pytest.mark.parametrize("length", [100, 60])
def test_every_byte_matches_brute_force(spark, length):
    compare(spark, passages(length, 250), length)


def test_nulls_periods_repeats_and_edges(spark):
    base = passages(3, 8)
    rows = base + [
        (301, "a" * 500, "s"), (302, "ab" * 150, "s"), (303, None, "s"), (304, "", None), (305, "a" * 99, "s"),
        (306, "a" * 100, "s"), (307, base[5][1], "s"), (307, base[5][1], "s"), (308, "é" * 120, "s"),
        (308, "é" * 120, "s"), (None, base[2][1], "s"), (310, "unique text that is long enough " * 5, "s"),
        (311, "".join(map(chr, range(300, 3300))), "s"),
    ]
    compare(spark, rows)


@pytest.mark.parametrize("busy", [1, 30])
def test_windows_of_frequent_names_are_compared_one_by_one(spark, monkeypatch, busy):
    rnd = random.Random(busy)
    letters = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    phrase = "a phrase of forty bytes, in all the texts"
    # The phrase in other surroundings each time, in a longer passage, and in repeated rows.
    rows = [(i, letters(rnd.randrange(90, 200)) + phrase + letters(rnd.randrange(90, 200)), "s") for i in range(120)]
    longer = letters(150) + phrase + letters(80)
    rows += [(200 + i, letters(rnd.randrange(60)) + longer + letters(20) + longer[40:], "s") for i in range(40)]
    rows += passages(busy, 60) + rows[:5] + [(None, rows[130][1] + "!", "s"), (907, rows[7][1] + longer, "s"), (900, "a" * 700, "s")]
    monkeypatch.setattr(repeats, "BUSY", busy)
    compare(spark, rows)


def test_windows_of_a_piece_are_combined_before_they_travel():
    rnd = random.Random(6)
    letters = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    shared = letters(260)
    texts = [(letters(50) + shared + letters(50)).encode() for _ in range(30)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    anchors = repeats._anchors(data, bounds, 100)
    total, down = repeats._sums(data)
    text = anchors[4]
    place = (text, np.zeros(len(text), np.int64), anchors[2] - bounds[text])
    window, span, start, later, s, e = repeats._windows(anchors, total, down, place, 100)
    assert len(set(window.tolist())) == len(window)  # one row for equal windows
    assert (e >= s).all() and len(window) + (e - s + 1).sum() == sum(len(t) - 99 for t in texts)
    assert len(window) == len({t[p : p + 100] for t in texts for p in range(len(t) - 99)})
    assert set(text[later].tolist()) == set(range(1, 30))  # the first text has each first


def test_frequent_names_are_listed_by_their_bits():
    rnd = np.random.default_rng(2)
    hashes = rnd.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2)
    bitmap = np.zeros(1 << 9, np.uint8)
    slots = hashes[:40] >> np.uint64(64 - 12)
    np.bitwise_or.at(bitmap, (slots >> np.uint64(3)).astype(np.int64), np.uint8(128) >> (slots & np.uint64(7)).astype(np.uint8))
    found = set_slots(bitmap.tobytes())
    assert found.tolist() == sorted(set(slots.tolist()))
    assert (np.isin(hashes >> np.uint64(64 - 12), found) == marked(bitmap, hashes)).all()


def test_only_the_first_place_of_a_key_is_kept_over_batches():
    key = np.array([[1, 0, 0, 5], [1, 0, 0, 5], [1, 0, 0, 9], [2, 1, 0, 0], [2, 3, 0, 0], [2, 3, 0, 0], [4, 0, 0, 0]])
    want = [False, False, True, False, True, True, False]
    for size in range(1, 8):
        got, least = [], None
        for at in range(0, len(key), size):
            later, least = repeats._not_first(key[at : at + size], least)
            got += later.tolist()
        assert got == want


def test_long_documents_are_scanned_in_pieces(spark, monkeypatch):
    rnd = random.Random(4)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(3000))
    rows = [(1, text, "s"), (2, text[700:2500] + "!" + text[:300], "s"), (3, "q" + text, "s")]
    monkeypatch.setattr(repeats, "PIECE", 256)
    monkeypatch.setattr("tallyhawk.llm.shingles.CHUNK_BYTES", 256)
    compare(spark, rows)


def test_documents_keep_their_columns(spark):
    twice = "passage that repeats in two documents, word for word, and goes on for more than a hundred bytes, as here. "
    rows = [(1, twice + "first", "a", 111), (2, "é" + twice + "ü second", "a", 112), (3, None, "b", 0), (4, twice, "b", 5), (5, "", "c", 0)]
    docs = documents(spark, rows, ", n_chars long")
    out = without_repeats(docs)
    assert out.schema == docs.schema
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert got == {1: (twice + "first", 111), 2: ("éü second", 9), 3: (None, 0), 5: ("", 0)}
    digest = {r["doc_id"]: r for r in repeats_digest(docs.withColumnRenamed("n_chars", "n_removed")).collect()}
    assert digest[4]["n_spans"] == 1 and digest[4]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert repeats_digest(docs.limit(0)).collect() == [] and without_repeats(docs.limit(0)).collect() == []


def test_copies_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", 0)
    compare(spark, passages(8, 40) * 2)
