import random

import numpy as np
import pyarrow as pa
import pytest

from tallyhawk.llm import jaccard
from tallyhawk.llm.graph import components
from tallyhawk.llm.jaccard import jaccard_components, jaccard_digest, keep_one
from tallyhawk.llm.shingles import shingle_sets
from tests.llm.helpers import LOWER, WORD, documents, morse_texts


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) >= size:
        return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return frozenset([tuple(words)] if words else [])


def brute(rows, size, num, den):
    sets = [shingles(t, size) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            linked = both and den * both >= num * (len(sets[i]) + len(sets[j]) - both)
            if linked or rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]:
                root[find(i)] = find(j)
    low = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            low[find(i)] = min(low.get(find(i), row[0]), row[0])
    return [(row[0], len(sets[i]), low.get(find(i)) if sets[i] else row[0]) for i, row in enumerate(rows)]


def near_copies(seed, n):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("alpha beta gamma Delta éta the of and to in".split()) + str(rnd.randrange(400))
    bases = [[word() for _ in range(rnd.choice([2, 4, 30, 60, 120]))] for _ in range(n // 12)]
    big = [word() for _ in range(90)]
    passage = [word() for _ in range(25)]
    rows = []
    for i in range(n):
        text = list(big if rnd.random() < 0.4 else rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
            text[rnd.randrange(len(text))] = word()
        if rnd.random() < 0.2:
            text += passage
        rows.append((i * 3, rnd.choice([" ", "\n", "\t "]).join(text), "s"))
    return rows


@pytest.mark.parametrize(("size", "num", "den"), [(3, 90, 100), (5, 80, 100), (1, 60, 100)])
def test_components_match_brute_force(spark, size, num, den):
    rows = near_copies(size, 260)
    got = jaccard_components(documents(spark, rows), size, num, den, block=16)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(rows, size, num, den))


def test_no_order_of_columns_changes_the_result(spark, monkeypatch):
    rows = near_copies(9, 200)
    want = sorted(brute(rows, 3, 80, 100))
    monkeypatch.setattr(jaccard, "FEW", 4)  # nearly every shared column goes by clusters
    got = jaccard_components(documents(spark, rows), 3, 80, 100, block=8)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_nulls_ties_repeats_and_clashes(spark):
    text = "one two three four five six"
    rows = [
        (5, None, "a"), (6, "", "a"), (7, " \n\t", "b"), (8, "Single", None), (9, "single", "b"),
        (10, text, "a"), (10, text, "a"), (4, text.upper(), "c"), (None, text, "c"), (None, "lonely words here", "c"),
        (20, "two words", "a"), (21, "two words!", "a"), (22, "zero " * 30_000, "z"), (3, "zero " * 29_999, "z"),
        (30, "some other text", "q"), (30, "a thing apart", "q"), (31, "A thing apart", "q"),
    ]
    docs = documents(spark, [(*r, i) for i, r in enumerate(rows)], ", n int")
    want = sorted(brute(rows, 3, 90, 100), key=str)
    assert sorted((tuple(r) for r in jaccard_digest(docs).collect()), key=str) == want
    kept = keep_one(docs, 3, 90, 100)
    assert kept.columns == docs.columns
    found = sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"] is not None and len(r["text"] or "") < 100)
    # Both texts of doc_id 30 stay, one of the texts without doc_id: the other is a copy of 4.
    assert [i for i, _ in found] == [4, 5, 6, 7, 8, 20, 21, 30, 30] and found[-1][1] != found[-2][1]
    assert [r["text"] for r in kept.where("doc_id is null").collect()] == ["lonely words here"]
    assert kept.where("doc_id in (3, 22)").collect()[0]["doc_id"] == 3 and kept.where("doc_id = 22").isEmpty()
    assert jaccard_digest(docs.limit(0)).collect() == []
    assert keep_one(docs.limit(0)).collect() == []


def test_the_row_that_stays_depends_on_values_alone(spark):
    text = "these five words come again " * 3
    rows = [(None, text, "b"), (None, text + "x", "a"), (None, "alone", "c"), (None, "alone", "c"), (3, "unrelated text one", "s"), (3, text, "s"),
            (3, text, "t"), (9, text, "u"), (5, "", "v"), (5, None, "w")]
    runs = [
        sorted((tuple(r) for r in keep_one(documents(spark, sorted(rows, key=lambda r: hash((r, k)))), 2, 80, 100).collect()), key=str)
        for k in range(3)
    ]
    assert runs[0] == runs[1] == runs[2]
    assert [r[:2] for r in runs[0]] == sorted([(3, text), (3, "unrelated text one"), (5, ""), (5, None), (None, "alone")], key=str)


def test_words_made_to_collide_do_not_link(spark):
    one, two = morse_texts()
    rows = [(k + 1, f"one two {word}", "s") for k, word in enumerate([one, two, "x" * 25 + "a", "x" * 25 + "b", "x" * 24, "x" * 23])]
    assert sorted(tuple(r) for r in jaccard_digest(documents(spark, rows)).collect()) == [(k, 1, k) for k in range(1, 7)]


def test_hashing_in_chunks(monkeypatch):
    texts = ["", "a", "a b", "A b c", "x  y\tz\nw", "é à ü é à ü", None, "word " * 300]
    whole = [s.tolist() for s in shingle_sets(pa.array(texts), 2)]
    assert [len(s) for s in whole] == [len(shingles(t, 2)) for t in texts]
    monkeypatch.setattr("tallyhawk.llm.shingles.CHUNK_BYTES", 5)
    assert [s.tolist() for s in shingle_sets(pa.array(["skip", *texts]).slice(1), 2)] == whole
    assert not np.intersect1d(whole[2], whole[5]).size


def test_chains_and_stars_become_components(spark):
    rnd = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(1, 1), (260, 259)]
    rnd.shuffle(links)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 261)]}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
