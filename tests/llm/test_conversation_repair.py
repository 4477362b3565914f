"""Conversation repair: the search against a plain programme, and hostile rows."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import defaultdict

import pytest

from churnlens.llm import conversation_repair as cr
from churnlens.llm.queries import damaged_turns

SPACE = " \t\n\x0b\x0c\r"


def plain_edits(codes):
    """Least (cost, audit) of each state, row by row, with every audit written out."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    def with_inserts(best):
        for _ in range(2):  # more inserts than two only lead round in a circle
            for state, (cost, audit) in list(best.items()):
                due = "a" if state == "u" else "u"
                best[due] = min(best.get(due, (10**9, "")), (cost + 3, audit + "I"))
        return best

    best = with_inserts({"": (0, "")})
    for code in codes:
        after = {}
        initial = "sua?"[code & 3]
        for state, (cost, audit) in best.items():
            options = [(state, cost + 4, audit + "D")]
            if not code & cr.MUST_GO:
                more = 3 if code & cr.CUT_OFF else 0
                options.append(("a" if state == "u" else "u", cost + 3 + more, audit + "R"))
                if initial in follow[state]:
                    options.append((initial, cost + more, audit + "K"))
            for to, c, a in options:
                after[to] = min(after.get(to, (10**9, "")), (c, a))
        best = with_inserts(after)
    return min(best[s] for s in ("", "a") if s in best)


CODES = [0, 1, 2, 3, cr.MUST_GO | 1, cr.CUT_OFF | 0, cr.CUT_OFF | 1, cr.CUT_OFF | 2]


def test_search_on_all_short_conversations():
    for n in range(4):
        for codes in itertools.product(CODES, repeat=n):
            assert cr.cheapest_edits(bytes(codes)) == plain_edits(codes), codes


def test_search_on_random_conversations():
    rng = random.Random(5)
    for n in [5, 8, 13, 40] * 150:
        codes = bytes(rng.choices(CODES, weights=[1, 6, 6, 1, 1, 1, 2, 2], k=n))
        assert cr.cheapest_edits(codes) == plain_edits(codes), codes


def test_long_conversation():
    rng = random.Random(6)
    codes = bytes(rng.choices(CODES, weights=[1, 20, 20, 1, 1, 1, 1, 1], k=3000))
    assert cr.cheapest_edits(codes) == plain_edits(codes)
    assert cr.cheapest_edits(bytes([1, 2] * 20_000)) == (0, "K" * 40_000)
    assert cr.cheapest_edits(bytes([cr.MUST_GO] * 5000)) == (20_000, "D" * 5000)


def brute(rows, ids):
    """The report of rows (conv, turn, role, text), computed plainly."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = (turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest())
        convs[conv].append((key, turn, role, text))
    out = []
    for conv in ids:
        own = sorted(convs[conv], key=lambda r: r[0])
        seen, codes, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, _, role, text in own:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            initial = "sua".find(role[0]) if role and role[0] in "sua" else 3
            codes.append(initial | (cr.CUT_OFF if fault == "truncated" else cr.MUST_GO if fault else 0))
        turns = {t for _, t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        letters = [role[:1] for _, _, role, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(letters))
        cost, audit = plain_edits(codes)
        left, state, lines = iter(own), "", []
        for edit in audit:
            _, _, role, text = (None, None, "", "") if edit == "I" else next(left)
            if edit != "D":
                due = "assistant" if state == "u" else "user"
                role = role if edit == "K" else due
                state = role[0]
                lines.append((edit, role, text))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in lines).encode()).hexdigest()
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, digest, lines))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, kind int, audit string, mark int, plan int, conv int"
HOSTILE = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes"), (1, 1, "assistant", "Yes"), (1, 5, "user", "More?"),
    (2, None, "system", "Be kind."), (2, None, None, None), (2, 3, "", "x."), (2, 3, "", "x."), (2, 4, "tool", "y."),
    (3, 0, "assistant", "A."), (3, 1, "assistant", "B."), (3, 2, "user", "C" * 300_000), (3, -4, "user", "\t \n"),
    (None, 0, "user", "who."), (None, None, "assistant", "naïve 日本語 😀!"), (None, 0, "user", "who."),
    (4, None, "user", ""), (4, None, "assistant", None), (5, 2, "Ünder", "z."), (5, 1, "user", "q? \r\n"),
    (6, 7, "user", "same."), (6, 7, "assistant", "same."), (6, 7, "user", "other."), (6, 9, "user", "same."),
]


@pytest.fixture(scope="module")
def conversations(spark):
    def make(rows):
        return spark.createDataFrame([(*r, 1, "a", 2, 3, 4) for r in rows], SCHEMA)

    return make


def report(df):
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_hostile_rows(conversations):
    df = conversations(HOSTILE).repartition(4)
    ids = [None, *range(1, 8)]
    want = brute(HOSTILE, ids)
    every = conversations([(i, 0, "", "") for i in ids])
    assert report(cr.repair_report(df, ids=every)) == [w[:-1] for w in want]
    turns = defaultdict(dict)
    for r in cr.repaired_turns(df).collect():
        turns[r["conv_id"]][r["position"]] = (r["edit"], r["role"], r["text"])
    assert {w[0]: w[-1] for w in want if w[-1]} == {k: [v[i] for i in range(len(v))] for k, v in turns.items()}


def test_random_conversations(conversations):
    rng = random.Random(8)
    texts = ["One.", "Two!", "Three", "Four?", " ", "One.", None]
    rows = [
        (c, rng.choice([None, *range(8)]), rng.choice(["user", "assistant", "user", "assistant", "system", None]), rng.choice(texts))
        for c in range(120)
        for _ in range(rng.randint(1, 9))
    ]
    want = [w[:-1] for w in brute(rows, range(120))]
    assert report(cr.repair_report(conversations(rows).repartition(5))) == want


def test_one_conversation_holds_most_rows(conversations):
    rng = random.Random(9)
    rows = [(1, t, ["user", "assistant"][t % 2], f"Text {t if rng.random() < 0.9 else 0}.") for t in range(4000)]
    rows += [(2, 0, "user", "Lone")]
    assert report(cr.repair_report(conversations(rows))) == [w[:-1] for w in brute(rows, [1, 2])]


def test_empty(conversations):
    assert cr.repair_report(conversations([])).collect() == []
    assert cr.repaired_turns(conversations([])).collect() == []
    nothing = hashlib.sha256().hexdigest()
    only = cr.repair_report(conversations([]), ids=conversations([(7, 0, "", "")]))
    assert report(only) == [(7, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_damage(conversations):
    from zlib import crc32

    rows = [(c, t, ["user", None, "assistant"][t % 3] if t else "user", f"No. {c} of {t}!") for c in range(9) for t in range(9)]
    rows += [(None, 3, "user", None), (4, None, "user", "x.")]
    want = []
    for c, t, role, text in rows:
        role, text = role or " ", text or " "
        fate = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if fate == 1 else text.translate(str.maketrans("", "", ".!?")) if fate == 2 else text
        want += [(c, t, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    got = [tuple(r) for r in damaged_turns(conversations(rows)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(want) != len(rows)
