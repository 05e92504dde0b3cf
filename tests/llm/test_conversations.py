import hashlib
import random
import zlib
from itertools import product

import numpy as np
import pytest

from tallyhawk.llm.conversations import (
    START, TAIL, damaged, kind_code, meet, piece_of, repair_digest, repair_edits, solve,
)

SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    """The contract's damage: (conv_id, turn, role, text) rows, and all conversations."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        said = [" " if v is None else str(v) for v in (conv, turn)]
        draw = zlib.crc32(":".join(said).encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else text.translate({ord(c): None for c in ".!?"}) if draw == 2 else text
        out += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    return out


def first_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        words = text.strip(SPACE)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else None if words[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Cost and audit by whole strings for every state, one row after the other."""
    legal = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "")}

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                after = "a" if state == "u" else "u"
                best[after] = min(best.get(after, (10**9, "")), (cost + 2, audit + "I"))
        return best

    for letter, fault in rows:
        following = {}
        for state, (cost, audit) in inserted(dict(best)).items():
            options = [(state, 3, "D")]
            if fault not in ("blank", "duplicate"):
                extra = 1 if fault == "truncated" else 0
                options += [(legal[state, letter], extra, "K")] if (state, letter) in legal else []
                options += [(legal[state, c], 2 + extra, "R") for c in "ua" if (state, c) in legal]
            for after, more, edit in options:
                following[after] = min(following.get(after, (10**9, "")), (cost + more, audit + edit))
        best = following
    ends = inserted(dict(best))
    return min(v for k, v in ends.items() if k in ("", "a"))


def tried(rows):
    """The same by trying every string of edits with at most two inserts in a row."""
    found = []
    edits = [["D"] if f in ("blank", "duplicate") else ["D", "K", "R"] for _, f in rows]
    for chosen in product(*edits):
        for inserts in product(range(3), repeat=len(rows) + 1):
            audit, turns, cost = "", "", 2 * sum(inserts)
            for (letter, fault), edit, n in zip(rows, chosen, inserts):
                audit += "I" * n + edit
                turns += "?" * n + {"D": "", "K": letter or "x", "R": "?"}[edit]
                cost += {"D": 3, "K": 0, "R": 2}[edit] + (fault == "truncated" and edit != "D")
            audit += "I" * inserts[-1]
            turns += "?" * inserts[-1]
            want = ("" if len(turns) % 2 == 0 else "s") + "ua" * (len(turns) // 2)
            if turns == "s" or any(t not in ("?", w) or (t == "?" and w == "s") for t, w in zip(turns, want)):
                continue
            found.append((cost, audit))
    return min(found)


def solved(rows):
    codes = np.array([kind_code(letter, fault) for letter, fault in rows], dtype=np.uint8)
    cost, end, letters = solve(codes, START, tuple(c for c, _ in TAIL))
    return cost, "".join(letters) + TAIL[end][1]


KINDS = [(c, f) for c in "suax" for f in (None, "blank", "duplicate", "truncated")]


def test_paths_match_every_string_of_edits():
    rnd = random.Random(0)
    some = [[]] + [[k] for k in KINDS] + [[rnd.choice(KINDS) for _ in range(rnd.randrange(2, 5))] for _ in range(150)]
    for rows in some:
        assert solved(rows) == cheapest(rows) == tried(rows), rows


def test_long_paths_match_whole_strings():
    rnd = random.Random(1)
    for k in range(300):
        mix = rnd.choice([KINDS, [("u", None), ("a", None)], [("s", None), ("u", "blank")], [("x", "truncated"), ("s", "truncated"), ("a", None)]])
        rows = [rnd.choice(mix) for _ in range(rnd.randrange(300))]
        assert solved(rows) == cheapest(rows)
    for rows in ([("u", "blank")] * 500, [("s", None)] * 400, [("u", "blank")] * 200 + [("s", None)] + [("u", "blank")] * 200):
        assert solved(rows) == cheapest(rows)


def test_pieces_meet_where_the_whole_path_passes():
    rnd = random.Random(2)
    for _ in range(200):
        rows = [rnd.choice(KINDS) for _ in range(rnd.randrange(1, 60))]
        cuts = sorted({0, len(rows), *(rnd.randrange(len(rows) + 1) for _ in range(5))})
        codes = np.array([kind_code(*r) for r in rows], dtype=np.uint8)
        pieces = [codes[a:b] for a, b in zip(cuts, cuts[1:])]
        audit, cost = "", 0
        for piece, (before, after) in zip(pieces, meet([piece_of(p) for p in pieces])):
            more, end, letters = solve(piece, before, tuple(0 if s == after else 1 << 40 for s in range(4)))
            assert end == after
            audit, cost = audit + "".join(letters), cost + more
        assert (cost + TAIL[end][0], audit + TAIL[end][1]) == cheapest(rows)


def digest(rows):
    """The contract's result of every conversation."""
    out = {}
    after = damage(rows)
    key = lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv), key=key)
        found = first_faults([r[2:] for r in mine])
        initials = [r[2][:1] for r in mine]
        cost, audit = cheapest(list(zip(initials, found)))
        turns, left, parity = [], list(mine), len(audit) - audit.count("D")
        place = 0 if parity % 2 == 0 else -1
        for edit in audit:
            row = None if edit == "I" else left.pop(0)
            if edit == "D":
                continue
            role = row[2] if edit == "K" else ["user", "assistant"][place % 2]
            turns.append(f"{role}:{'' if edit == 'I' else row[3]}")
            place += 1
        known = [r[1] for r in mine if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv] = (conv, gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit,
                     hashlib.sha256("\n".join(turns).encode()).hexdigest())
    return sorted(out.values(), key=str)


def table(spark, rows, extra=""):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string" + extra).repartition(4)


def invented(seed, n):
    rnd = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "why?", "and then", " ", None, "", "é…", "Done. \n", "line\nbreak."]
    return [(rnd.randrange(-5, n // 8), rnd.choice([None, *range(12)]), rnd.choice(roles), rnd.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("long", [10_000, 4, 0])
def test_digest_matches_brute_force(spark, long):
    rows = invented(long, 400)
    got = repair_digest(table(spark, rows), long)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == digest(rows)


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in repair_digest(table).collect()), key=str) == digest(rows)


def test_one_very_long_conversation(spark):
    rnd = random.Random(7)
    rows = [(1, k, ["user", "assistant"][k % 2], rnd.choice([f"Text {k}.", "the same again and again.", ""])) for k in range(6000)]
    rows += [(1, 77, "user", "once more.")] * 3000 + [(2, k, "user", "hi.") for k in range(3)]
    assert sorted((tuple(r) for r in repair_digest(table(spark, rows), 500).collect()), key=str) == digest(rows)


def test_edits_are_whole_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Hello"), (1, 1, "assistant", "Hello"), (2, 0, "user", "?"), (3, 0, "user", " ")]
    got = repair_edits(table(spark, rows)).collect()
    by = {c: [tuple(r)[1:] for r in sorted(got, key=lambda r: r["step"]) if r["conv_id"] == c] for c in (1, 2, 3)}
    assert by[1] == [
        (0, "K", 0, "system", None, "system", "Be kind.", 0), (1, "I", None, None, None, "user", "", 2),
        (2, "K", 1, "assistant", "truncated", "assistant", "Hello", 1), (3, "D", 1, "assistant", "duplicate", "assistant", "Hello", 3),
    ]
    assert [r[1] for r in by[2]] == ["K", "I"] and [r[1] for r in by[3]] == ["D"]


def test_nulls_repeats_clashes_and_empty_tables(spark):
    rows = [(None, None, None, None), (None, 3, "user", "A."), (4, 1, "user", "x " * 50_000), (4, 2, "assistant", "B."), (4, 2, "assistant", "B."),
            (5, None, "user", None), (9, 9, "", "!")]
    rows += [(c, 0, "user", "gone?") for c in range(100, 140)]
    odd = table(spark, [(*r, i) for i, r in enumerate(rows)], ", step int")
    for long in (10_000, 0):
        assert sorted((tuple(r) for r in repair_digest(odd, long).collect()), key=str) == digest(rows)
    empty = hashlib.sha256(b"").hexdigest()
    assert any(r[1:] == (0, 0, 0, 0, 0, 0, "", empty) for r in digest(rows))
    assert repair_digest(odd.limit(0)).collect() == [] and damaged(odd.limit(0)).collect() == []
