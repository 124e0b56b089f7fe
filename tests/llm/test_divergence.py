from __future__ import annotations

import random
import re
from collections import Counter
from itertools import groupby

import numpy as np
import pytest

from airlake.llm import divergence as module
from airlake.llm.divergence import divergence, share_values

TERM = re.compile(module.TERM)


def brute_force(rows, min_docs, listed):
    """(lang, source, text) rows to (lang, source, part, item, value, rank)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, in_lang, docs = {}, {}, {}
    for lang, source, text in rows:
        words = TERM.findall(re.sub('[A-Z]', lambda m: m[0].lower(), text))
        counts.setdefault((lang, source), Counter()).update(words)
        in_lang.setdefault(lang, Counter()).update(words)
        docs.setdefault(lang, Counter()).update(set(words))
    out = []
    for (lang, source), own in counts.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def p(c, kept=kept):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // total for t in kept}

        mine, q = p(own), p(in_lang[lang])
        found = {"pair": [], "term": [(q[t] - mine[t], t) for t in kept if own[t] and mine[t] > q[t]]}
        for (other_lang, other), theirs in counts.items():
            if other_lang == lang and other != source:
                theirs = p(theirs)
                found["pair"].append((-sum(abs(mine[t] - theirs[t]) for t in kept), other))
        for part, items in found.items():
            items.sort(key=lambda x: (x[0], x[1].encode()))
            out += [(lang, source, part, i, -v, r) for r, (v, i) in enumerate(items, 1) if part == "pair" or r <= listed]
    return sorted(out)


def random_rows(n_sources, n):
    draw = random.Random(3)
    vocabulary = [f"W{i}ö".replace(str(i), chr(97 + i % 26) * (1 + i // 26)) for i in range(150)]
    rows = []
    for _ in range(n):
        source = min(int(draw.expovariate(0.3)), n_sources - 1)
        words = [vocabulary[min(int(draw.expovariate(0.03)), 149)] for _ in range(draw.randint(0, 80))]
        rows.append((draw.choice(["en", "en", "en", "de", None]), f"s{source}", " ".join(words)))
    return rows + [("en", None, None), ("en", "quiet", ""), ("xx", "alone", "too few"), ("yy", "a", None), ("yy", "b", "w")]


@pytest.mark.parametrize("tile, block", [(32, 16_384), (2, 64)])
def test_equals_brute_force(rows, monkeypatch, tile, block):
    monkeypatch.setattr(module, "TILE", tile)
    monkeypatch.setattr(module, "BLOCK", block)
    data = random_rows(7, 300)
    # Repeated rows, one very long text, and a source that holds a third of all rows.
    data += data[:20] + [("en", "s0", "wa " * 50_000 + "wb")] + [("en", "hot", "wa wb wa\nwc")] * 150
    docs = rows([(*r, 1, "x") for r in data], "lang STRING, source STRING, text STRING, n INT, term STRING")
    assert pytest.tuples(divergence(docs, min_docs=5, listed=4)) == brute_force(data, 5, 4)


def test_shares_are_exact_beyond_64_bits():
    counts = np.array([0, 3, 9 * 10**11])
    assert share_values(counts, 10**12, 7).tolist() == [1 + 10**9 * (int(c) + 5) // (10**12 + 35) for c in counts]


def test_no_kept_term_and_no_rows(rows):
    few = rows([("en", "a", "one"), ("en", "b", "two"), (None, None, None)], "lang STRING, source STRING, text STRING")
    assert pytest.tuples(divergence(few)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    assert divergence(few.limit(0)).count() == 0


def test_ties_go_by_item(rows):
    data = [("en", s, "aa bb cc") for s in "pqrs"] * 2
    found = pytest.tuples(divergence(rows(data, "lang STRING, source STRING, text STRING"), min_docs=1))
    for source, own in groupby(found, lambda r: r[1]):
        assert [r[3] for r in sorted(own, key=lambda r: r[5])] == sorted(set("pqrs") - {source})
