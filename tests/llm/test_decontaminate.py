from __future__ import annotations

import random
import re

from airlake.llm.decontaminate import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in windows[key] if x is not None}
        spans = [[p, p] for p in sorted(hit) if p - 1 not in hit]
        for s in spans:
            while s[1] + 1 in hit:
                s[1] += 1
        out.append((len(w), len(hit), [tuple(s) for s in spans], sorted(found)))
    return out


def shout(text):
    return "".join(c.upper() if "a" <= c <= "z" else c for c in text)


def check(spark, rows, docs, items):
    frame = rows([(i, t, "x") for i, t in enumerate(docs)], "doc_id BIGINT, text STRING, items STRING")
    bench = rows(items, "item_id BIGINT, text STRING")
    got = decontaminate(frame, bench)
    found = {r.row.doc_id: (r.n_words, r.n_hit, [tuple(s) for s in r.spans], list(r["items"]), r.contaminated) for r in got.collect()}
    want = [(*w, w[1] > 0) for w in brute_force(docs, items)]
    assert [found[i] for i in range(len(docs))] == want
    return want


def test_equals_brute_force(spark, rows):
    draw = random.Random(11)
    prose = lambda n: " ".join(draw.choice("aa bb cc dd ee ff gg hh ii jj".split()) + draw.choice(["", "x", "É", "é"]) for _ in range(n))
    items = [(i, prose(draw.randint(11, 40))) for i in range(12)]
    items += [(20, "Lone Word"), (21, "q1"), (22, "five words make this item"), (23, items[0][1]), (24, None), (25, "?!"), (None, prose(15)), (26, "ab " * 30)]
    docs = []
    for _ in range(30):
        item = words(draw.choice(items[:12])[1])
        n = draw.randint(8, len(item))
        at = draw.randint(0, len(item) - n)
        docs.append(prose(draw.randint(0, 20)) + " " + shout(", ".join(item[at : at + n])) + ". " + prose(20))
    docs += [items[0][1], items[0][1], "", None, "...", "LONE word", "lone  q1 Q1", "five words\nmake this item", "ab " * 500, prose(3000)]
    docs.append(" ".join(i[1] or "" for i in items))
    docs += [" ".join(words(items[1][1])[:9]), " ".join(words(items[1][1])[:10])]
    want = check(spark, rows, docs, items)
    assert sum(w[-1] for w in want) > 25 and not want[-2][-1] and want[-1][1] == 10


def test_empty_tables(spark, rows):
    docs = rows([(1, "some text")], "doc_id BIGINT, text STRING")
    none = rows([], "item_id BIGINT, text STRING")
    assert [(r.n_words, r.n_hit, r.contaminated) for r in decontaminate(docs, none).collect()] == [(2, 0, False)]
    assert decontaminate(docs.where("doc_id > 1"), rows([(1, "some text")], "item_id BIGINT, text STRING")).count() == 0


def test_no_python_in_the_plan(spark, rows, plan):
    frame = decontaminate(rows([(1, "a b")], "doc_id BIGINT, text STRING"), rows([(1, "a b")], "item_id BIGINT, text STRING"))
    shown = plan(frame)
    assert not any(node in shown for node in ("EvalPython", "InArrow", "InPandas", "PythonUDF"))
