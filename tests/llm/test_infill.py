import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tallyhawk.llm import infill
from tallyhawk.llm.infill import INFILL_SQL, Sentinels, count_units, cut_pieces, fill_in_middle, infill_digest, read_forms, restored, write_forms
from tests.llm.helpers import documents

ODD = ["", None, "a", "é漢😀" * 5, "<P>x", "x<S>", "<<P", "<M", "a\nb\n\n", " \t ", "é" * 9, "w " * 20_000]


def cut(doc_id, text):
    """The contract, one document at a time."""
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted([h[0] % (n + 1), h[1] % (n + 1)])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


@pytest.mark.parametrize("part", [1_000_000, 1, 7, 40])
def test_pieces_in_parts_of_any_size(monkeypatch, part):
    monkeypatch.setattr(infill, "PART_BYTES", part)
    monkeypatch.setattr("tallyhawk.llm.shingles.CHUNK_BYTES", 1000)
    rnd = random.Random(part)
    texts = ODD[:-1] + ["".join(rnd.choice("ab é漢😀\n<>PSM") for _ in range(rnd.randrange(50))) for _ in range(300)]
    n = count_units(pa.array(texts))
    assert n.tolist() == [len(t or "") for t in texts]
    low = np.array([rnd.randrange(k + 1) for k in n])
    high = np.array([rnd.randrange(a, k + 1) for a, k in zip(low, n)])
    got = [p.to_pylist() for p in cut_pieces(pa.array(texts), low, high)]
    assert list(zip(*got)) == [((t or "")[:a], (t or "")[a:b], (t or "")[b:]) for t, a, b in zip(texts, low, high)]


def test_words_and_lines_are_units_too():
    texts = pa.array(["one two  three\n", " lead", "a\n\nb", "", None, "x\ny\n"])
    assert count_units(texts, "word").tolist() == [3, 2, 2, 0, 0, 2]
    assert count_units(texts, "line").tolist() == [1, 1, 3, 0, 0, 2]
    ones = np.array([1, 1, 1, 0, 0, 1])
    twos = np.array([2, 1, 2, 0, 0, 2])
    assert [p.to_pylist() for p in cut_pieces(texts, ones, twos, "word")] == [
        ["one ", " ", "a\n\n", "", "", "x\n"], ["two  ", "", "b", "", "", "y\n"], ["three\n", "lead", "", "", "", ""],
    ]
    with pytest.raises(ValueError, match="unit"):
        count_units(texts, "page")


def test_outputs_are_taken_apart_exactly():
    rnd = random.Random(3)
    marks = Sentinels("<|p|", "<|s|", "<|m|").checked()
    texts = ["".join(rnd.choice("<|psm") for _ in range(rnd.randrange(12))) for _ in range(2000)]
    texts = [t for t in texts if not any(m in t for m in marks)]
    n = count_units(pa.array(texts))
    low = np.array([rnd.randrange(k + 1) for k in n])
    high = np.array([rnd.randrange(a, k + 1) for a, k in zip(low, n)])
    form = pa.array([rnd.choice(["plain", "psm", "spm"]) for _ in texts])
    output = write_forms(pa.array(texts), form, cut_pieces(pa.array(texts), low, high), marks)
    assert read_forms(output, form, marks).to_pylist() == texts
    for bad in (("", "<S>", "<M>"), ("<P>", "<P>", "<M>"), ("<P<", "<S>", "<M>"), ("aa", "b", "c")):
        with pytest.raises(ValueError, match="sentinels"):
            Sentinels(*bad).checked()


def test_forms_match_brute_force(spark):
    rnd = random.Random(4)
    rows = [(i * 3 - 100, "".join(rnd.choice("ab é漢😀\n") for _ in range(rnd.randrange(90))), "s") for i in range(400)]
    rows += [(5000 + i, t, None) for i, t in enumerate(ODD)]
    forms = fill_in_middle(documents(spark, rows))
    got = {r["doc_id"]: tuple(r)[1:] for r in forms.collect()}
    assert got == {i: cut(i, t) for i, t, _ in rows} and {v[1] for v in got.values()} == {"plain", "psm", "spm"}
    assert {r["doc_id"]: r["text"] for r in restored(forms).collect()} == {i: t or "" for i, t, _ in rows}
    assert {r["form"] for r in fill_in_middle(documents(spark, rows), plain_share=0, spm_share=100).where("n > 0").collect()} >= {"spm"}


def test_digest_matches_sql(spark, sf_dir):
    got = infill_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    found = con.execute(INFILL_SQL)
    assert [c[0] for c in found.description] == got.columns
    assert sorted(tuple(r) for r in got.collect()) == sorted(found.fetchall())


def test_nulls_repeats_clashes_and_empty_tables(spark):
    rows = [(None, "abc", "s", 1), (None, None, "s", 2), (7, "same text", "s", 3), (7, "same text", "s", 3), (7, "other", None, 4)]
    docs = documents(spark, rows, ", h0 int").withColumnRenamed("source", "output")
    got = fill_in_middle(docs)
    assert got.columns == ["doc_id", "n", "form", "prefix_units", "middle_units", "output"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(((r[0], *cut(*r[:2])) for r in rows), key=str)
    assert infill_digest(docs.limit(0)).collect() == []
