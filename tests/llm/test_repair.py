from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from airlake.llm import repair as module
from airlake.llm.queries import op13
from airlake.llm.repair import Audits, damage, digests, repair, solve

WHOLE = re.compile("(s?(ua)+)?")
TURNS = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def fault_of(turn, earlier):
    role, text = turn
    text = text.rstrip(" \t\n\v\f\r")
    if not text:
        return "blank"
    return "duplicate" if turn in earlier else "" if text[-1] in ".!?" else "truncated"


def cost_of(audit, faults, initials):
    """The cost of edits, or None where they do not repair the turns; and the roles they give."""
    cost, at, roles = 0, 0, ""
    for letter in audit:
        given = "a" if roles.endswith("u") else "u"
        if letter == "I":
            cost, roles = cost + 5, roles + given
            continue
        if letter == "D":
            cost += 2
        elif faults[at] in ("blank", "duplicate"):
            return None, roles
        else:
            cost += (letter == "R") + 5 * (faults[at] == "truncated")
            roles += given if letter == "R" else initials[at]
        at += 1
    return (cost if WHOLE.fullmatch(roles) else None), roles


def exhaustive(faults, initials):
    audits = ("".join(p) for p in product(*(["".join(x) for x in product(["", "I", "II"], "DKR")] for _ in faults)))
    found = [(cost_of(a + end, faults, initials)[0], a + end) for a in audits for end in ("", "I", "II")]
    return min(f for f in found if f[0] is not None)


def plain(faults, initials):
    """States by roles so far, with whole strings."""
    best = {"": (0, "")}

    def settle(cells):
        out = {}
        for roles, (cost, audit) in cells:
            for n in range(4):
                made = roles
                for _ in range(n):
                    made += "a" if made.endswith("u") else "u"
                key = made if made in ("", "s") else made[-1]
                new = (cost + 5 * n, audit + "I" * n)
                if key not in out or new < out[key]:
                    out[key] = new
        return out

    best = settle(best.items())
    for fault, initial in zip(faults, initials):
        cells = [(r, (c + 2, a + "D")) for r, (c, a) in best.items()]
        if fault not in ("blank", "duplicate"):
            for r, (c, a) in best.items():
                c += 5 * (fault == "truncated")
                given = "a" if r == "u" else "u"
                cells.append((given, (c + 1, a + "R")))
                if initial == "" or initial == given or initial == "s" and r == "":
                    cells.append((r if initial == "" else initial, (c, a + "K")))
        best = settle(cells)
    return min(best[r] for r in ("", "a") if r in best)


def brute_force(rows):
    """(conv_id, turn, role, text) rows to the query's."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            key = ":".join(" " if x is None else str(x) for x in (conv, turn))
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(key.encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            turns += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.sha256(t[2].encode()).hexdigest()))
        numbers = {t[0] for t in turns if t[0] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        faults = [fault_of(t[1:], [u[1:] for u in turns[:i]]) for i, t in enumerate(turns)]
        initials = [t[1][:1] for t in turns]
        cost, audit = plain(faults, initials)
        assert cost_of(audit, faults, initials)[0] == cost
        lines, at, roles = [], 0, ""
        for letter in audit:
            given = "assistant" if roles.endswith("u") else "user"
            role, text = ("", "") if letter == "I" else turns[at][1:]
            at += letter != "I"
            if letter != "D":
                role = given if letter in "IR" else role
                roles += role[:1]
                lines.append(f"{role}:{text}")
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def random_rows(conversations, longest, seed=1):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", " ", "", "Hm?\n", "a b. ", None, "other.", "unlike!", "many?", "texts."]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "uncle", "tool"]
    rows = []
    for conv in range(conversations):
        for turn in range(draw.randint(1, longest)):
            rows.append((conv, draw.choice([turn, turn, turn, turn + 1, None]), draw.choice(roles), draw.choice(texts)))
    return rows + [(None, None, "user", "No id."), (None, 1, None, None), (None, 2, "assistant", "Ok.")]


@pytest.mark.parametrize("modulus", [module.MODULUS, 1, 3])
def test_cheapest_and_first_audit_whatever_the_hashes(modulus):
    draw = random.Random(2)
    for n in [1, 2, 3, 3, 3, 12, 40] * 8:
        faults = [draw.choice(["", "", "blank", "duplicate", "truncated"]) for _ in range(n)]
        initials = [draw.choice("uuaas x") if draw.random() > 0.05 else "" for _ in range(n)]
        turns = [(i, f in ("blank", "duplicate"), f == "truncated") for f, i in zip(faults, initials)]
        found = solve(turns, 0, modulus)
        best = min(f for f in (found[0], found[3]) if f)
        assert best == plain(faults, initials)
        if n <= 3:
            assert best == exhaustive(faults, initials)


@pytest.mark.parametrize("modulus", [module.MODULUS, 1, 5])
def test_audits_compare_like_strings(modulus):
    draw = random.Random(3)
    audits = Audits(modulus)
    nodes = [0]
    for _ in range(400):
        nodes.append(audits.extend(draw.choice(nodes[-30:]), draw.choice("DK")))
    for _ in range(2000):
        a, b = draw.choice(nodes), draw.choice(nodes)
        assert audits.before(a, b) == (audits.text(a) < audits.text(b))


def query_rows(spark, rows_of, data, monkeypatch, segment, tmp_path):
    path = tmp_path / f"in{segment}"
    rows_of([(*r, "extra", 1) for r in data], TURNS + ", fault STRING, position INT").write.parquet(str(path / "conversations.parquet"))
    return {r.conv_id: tuple(r)[1:] for r in op13(spark, str(path)).collect()}


def test_query_equals_brute_force(spark, rows, monkeypatch, tmp_path):
    data = random_rows(60, 9)
    data += data[:5]
    assert query_rows(spark, rows, data, monkeypatch, 0, tmp_path) == brute_force(data)


@pytest.mark.parametrize("segment", [1, 3])
def test_segments_join_to_the_same(spark, rows, segment):
    data = random_rows(12, 14, seed=4) + [r[:1] + (i,) + r[2:] for i, r in enumerate(random_rows(1, 60, seed=5)[:-3])]
    found = repair(damage(rows(data, TURNS)), segment=segment)
    want = brute_force(data)
    got = {r.conversation: (r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for r in found.conversations.collect()}
    assert got == {c: want[c][1:7] for c in got} and len(got) > 10
    hashes = {r.conversation: r.sha256 for r in digests(found.edits).collect()}
    assert hashes == {c: want[c][7] for c in hashes}
    audits = {}
    for e in sorted(found.edits.collect(), key=lambda e: (e.conversation is not None, e.conversation, e.position, e.part)):
        audits[e.conversation] = audits.get(e.conversation, "") + e.edit
    assert audits == {c: g[5] for c, g in got.items()}


def test_a_very_long_text_and_no_rows(spark, rows):
    data = [(1, 0, "user", "word " * 200_000 + "end."), (1, 1, "assistant", "Fine.")]
    found = repair(rows(data, TURNS))
    assert [r.audit for r in found.conversations.collect()] == ["KK"]
    empty = repair(rows([], TURNS))
    assert empty.edits.count() == 0 and empty.conversations.count() == 0 and digests(empty.edits).count() == 0
