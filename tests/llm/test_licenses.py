import textwrap

import pytest

from tallyhawk.llm.license_texts import OTHER, TEMPLATES
from tallyhawk.llm.licenses import NONE, UNKNOWN, classify, fit_licenses, license_digest, license_paragraphs
from tests.llm.helpers import documents


@pytest.fixture(scope="module")
def model(spark):
    return fit_licenses(spark)


def families(spark, model, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string").distinct()
    return {r["text"]: r["family"] for r in classify(df, model).collect()}


def test_notices_and_other_uses_of_their_words(spark, model):
    texts = {n: family for family, notices in TEMPLATES.items() for n in notices}
    got = families(spark, model, [*texts, *OTHER])
    assert {t: got[t] for t in texts} == texts
    assert all(got[t] in (NONE, UNKNOWN) for t in OTHER) and sum(got[t] == NONE for t in OTHER) >= len(OTHER) - 6


def test_other_wordings(spark, model):
    got = families(spark, model, [
        "All code here is released under the MIT License, see below.",
        "Copyright 2024 Someone. Licensed under the Apache License, Version 2.0.",
        "NOTE THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 3",
        "Licensed under CC BY-NC 4.0 (photos only).", "Nothing of the kind.", "",
        "This work is licensed under the Frobnicate Reciprocal License, version 9.",
    ])
    assert list(got.values()).count(NONE) == 2
    assert got["All code here is released under the MIT License, see below."] == "MIT"
    assert got["Copyright 2024 Someone. Licensed under the Apache License, Version 2.0."] == "Apache"
    assert got["NOTE THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 3"] == "GPL"
    assert got["Licensed under CC BY-NC 4.0 (photos only)."] == "CC-BY-NC"
    assert got["This work is licensed under the Frobnicate Reciprocal License, version 9."] in (UNKNOWN, NONE)


def test_documents_nulls_repeats_clashes_and_empty_tables(spark, model):
    rows = [
        (1, "Intro\nReleased under the MIT License.\nmore\nLicensed under CC BY 4.0.", "a", 1), (2, None, "a", 2), (3, "", "b", 3),
        (4, "Released under the MIT License.", None, 4), (4, "Released under the MIT License.", None, 4),
        (None, "x\nReleased under the ISC License.", "c", 5), (5, "line without it\n" * 20_000 + "SPDX-License-Identifier: EPL-2.0", "c", 6),
    ]
    docs = documents(spark, rows, ", family int")
    got = sorted(tuple(r) for r in license_digest(docs).collect() if r["doc_id"] is not None)
    assert got == [
        (1, 4, 2, 0, "CC-BY,MIT"), (2, 0, 0, 0, ""), (3, 1, 0, 0, ""), (4, 1, 1, 0, "MIT"), (4, 1, 1, 0, "MIT"), (5, 20_001, 1, 0, "EPL"),
    ]
    listed = license_paragraphs(docs, model).collect()
    assert sorted((r["doc_id"] or 0, r["paragraph"], r["family"]) for r in listed) == [
        (0, 1, "ISC"), (1, 1, "MIT"), (1, 3, "CC-BY"), (4, 0, "MIT"), (5, 20_000, "EPL"),
    ]
    assert all(0 <= r["chance"] <= 1 and 0 <= r["likeness"] <= 1 for r in listed)
    assert license_digest(docs.limit(0)).collect() == []


def test_wrapped_notices(spark, model):
    """A notice of each family, cut at 38 columns, in its own paragraph, a comment, or among text."""
    rows, want = [], {}
    for family, notices in TEMPLATES.items():
        notice = max(notices, key=len)
        cut = textwrap.wrap(notice, 38, break_on_hyphens=False)
        assert len(cut) > 1 or len(notice) <= 38
        for text in (
            "\n".join(["Title of the thing", "", *cut, "", "And more."]),
            "\n".join(["/*", *(f" * {line}" for line in cut), " */"]),
            "\n".join(["It begins with a sentence.", *cut, "Then the river moved on."]),
        ):
            rows.append((len(rows), text, "s"))
            want[len(rows) - 1] = family
    got = {r["doc_id"]: r for r in license_digest(documents(spark, rows)).collect()}
    assert {k: got[k]["families"] for k in want} == want
    assert all(got[k]["n_notices"] == 1 for k in want)


def test_wrapped_notices_side_by_side(spark, model):
    mit = TEMPLATES["MIT"][-1].replace("person obtaining", "person\n# obtaining").replace("files, to", "files\n# (the Software), to")
    gpl = "This program is free software: you can redistribute it and/or\n# modify it under the terms of the GNU General Public License as\n# published by the Free Software Foundation."
    rows = [
        (1, f"# SPDX-License-Identifier: ISC\n# {mit}\n# {gpl}\nimport os", "s"),
        (2, "Terms:\nThis Source Code Form is subject to the terms of the Mozilla Public License, v.\n2.0. The end", "s"),
        (None, f"{'words go by. ' * 400}\n{'x y z\n' * 500}{mit}\n{'x y z\n' * 500}", "s"),
        (4, "She asked permission\nto leave the room\nwith her license.", "s"),
    ]
    listed = license_paragraphs(documents(spark, rows), model).collect()
    known = sorted((r["doc_id"] or 0, r["family"]) for r in listed if r["family"] != UNKNOWN)
    assert known == [(0, "MIT"), (1, "GPL"), (1, "ISC"), (1, "MIT"), (2, "MPL")]
    assert sorted(r["paragraph"] for r in listed if r["doc_id"] == 1) == [0, 1, 4]
