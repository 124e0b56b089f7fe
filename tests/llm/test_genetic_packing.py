from __future__ import annotations

import random
from array import array

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from test_packing import ODD_TEXTS, reference  # noqa: E402

from airlake.llm.genetic_packing import Bins, Island, pack_best_fit  # noqa: E402
from airlake.llm.queries import byte_bpe  # noqa: E402

SCHEMA = "doc_id BIGINT, text STRING, piece STRING, ids INT"


def island(lengths, longest=100, seed=0):
    return Island(np.sort(np.array(lengths))[::-1], longest, np.random.default_rng(seed))


def is_packing(home, packing):
    fills = home.fills(packing)
    return len(packing) == len(home.lengths) and (fills > 0).all() and (fills <= home.longest).all()


def test_best_fit_takes_the_fullest_bin_with_room():
    bins = Bins(10, [3, 5, 4])
    assert [bins.place(4), bins.place(3), bins.place(5), bins.place(6)] == [2, 0, 1, 3]
    assert bins.place(10) == 4 and bins.mask == 1 << 4


def test_children_are_packings_with_the_injected_bins():
    draw = random.Random(1)
    home = island([draw.randint(1, 99) for _ in range(500)])
    a, b = home.first_packings(2)
    assert is_packing(home, a) and is_packing(home, b)
    for _ in range(20):
        items = np.flatnonzero(b == draw.randrange(int(b.max()) + 1))
        child = home.inject(a, items, b[items])
        assert is_packing(home, child)
        assert len({child[i] for i in items}) == 1
        a, b = home.crossover(a, child), child
        assert is_packing(home, a)


def test_migrants_settle_with_own_documents():
    home, other = island([60, 40, 30, 30, 20, 20]), island([60, 40, 30, 30, 20, 20, 99])
    elite = other.elite(other.best_fit(np.arange(7)))
    settled = home.settle(home.best_fit(np.arange(6)), elite)
    assert is_packing(home, settled) and settled[0] == settled[1]
    assert (home.settle(settled, [np.array([99], "<i4").tobytes()]) == settled).all()


def test_evolution_finds_what_best_fit_misses():
    # Thirds and sixths that only fit exactly: best fit decreasing needs more bins.
    draw = random.Random(7)
    lengths = []
    for _ in range(60):
        a, b = draw.randint(20, 45), draw.randint(20, 45)
        lengths += [a, b, 100 - a - b]
    home = island(lengths, seed=3)
    first = home.first_packings(6)
    best = home.evolve(first, [], 600)[0]
    assert is_packing(home, best) and home.bound == 60
    assert best.max() + 1 < first[0].max() + 1


def check(pieces, data, encode, longest):
    by_doc, sequences = {}, {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length and 1 <= p.length <= longest
        by_doc.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= longest
    for doc_id, text, *_ in data:
        own = sorted(by_doc[doc_id], key=lambda p: p.piece)
        ids = encode(text or "") + [2]
        copies = sum(d[0] == doc_id for d in data)
        first = (len(ids) - 1) % longest + 1
        lengths = [first] + [longest] * (len(ids) // longest - (first == longest) if len(ids) > longest else 0)
        assert sorted(p.length for p in own) == sorted(lengths * copies)
        if copies == 1:
            assert [p.piece for p in own] == list(range(len(own)))
            assert [p.start for p in own] == [sum(lengths[:i]) for i in range(len(own))]
            assert array("I", b"".join(bytes(p.ids) for p in own)).tolist() == ids
    return sequences


@pytest.mark.parametrize("size", [8192, 40])
def test_documents_come_back_and_sequences_are_few(spark, rows, size):
    draw = random.Random(9)
    data = [(i, " ".join(draw.choice(["word", "naïve", "tokens", "x1"]) for _ in range(draw.choice([3, 20, 30, 60]))), "p", 1) for i in range(300)]
    data += [(1000 + i, t, None, 0) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id", "p", 0), (2000, None, "p", 0), (3, data[3][1], "p", 2)]
    encode = reference()
    pieces = pack_best_fit(rows(data, SCHEMA), byte_bpe(), longest=64, island=size, children=20)
    sequences = check(pieces.collect(), data, encode, 64)
    total = sum(n for own in sequences.values() for _, n in own)
    islands = -(-len(data) // size)
    assert len(sequences) <= 1.04 * total / 64 + 2 * islands


def test_a_multiple_of_the_length_has_no_short_piece(spark, rows):
    encode = reference()
    text = "word " * 62 + "word"
    assert len(encode(text)) == 63
    pieces = pack_best_fit(rows([(1, text, "", 0), (2, text + " word" * 64, "", 0)], SCHEMA), byte_bpe(), longest=64).collect()
    assert sorted((p.doc_id, p.piece, p.start, p.length, p.offset) for p in pieces) == [(1, 0, 0, 64, 0), (2, 0, 0, 64, 0), (2, 1, 64, 64, 0)]
    assert len({p.sequence_id for p in pieces}) == 3


def test_empty_table(spark, rows):
    assert pack_best_fit(rows([], SCHEMA), byte_bpe()).count() == 0
