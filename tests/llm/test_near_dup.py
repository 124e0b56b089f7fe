from __future__ import annotations

import random
from itertools import combinations

import numpy as np

from airlake.llm.near_dup import THRESHOLD, band_hashes, near_duplicates, prob_minhash, set_bands
from airlake.llm.words import mix, shingle_hashes, word_hashes


def shingles(text, size=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in words).split(" ")
    words = [w for w in words if w]
    if not words:
        return {("no word", text)}
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def brute_force(data, threshold=THRESHOLD):
    """The smallest id of each row's class by comparing all pairs of texts."""
    sets = {i: shingles(t) for i, t in data if i is not None and t is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared >= threshold * (len(sets[a]) + len(sets[b]) - shared) - 1e-9:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in sets}


def prose(draw, n):
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def edited(draw, text, share):
    words = text.split(" ")
    for i in draw.sample(range(len(words)), max(1, int(len(words) * share))):
        words[i] = prose(draw, 1)
    return " ".join(words)


def test_word_hashes_follow_words():
    texts = ["Ab ab,AB", "", "éa É 9-x", "ab"]
    hashes, bounds = word_hashes([t.encode() for t in texts])
    assert bounds.tolist() == [0, 3, 3, 7, 8]
    assert len(set(hashes[:3].tolist())) == 1 and hashes[7] == hashes[0]
    assert len(set(hashes[3:7].tolist())) == 4
    long = ["x" * 3_000_000, "ab " + "y" * 2_000_000 + " ab"]
    hashes, bounds = word_hashes([t.encode() for t in long])
    assert hashes[1] == hashes[3]
    shifted, _ = word_hashes([b"ab " + long[0].encode()])
    assert shifted[1] == hashes[0]


def test_signature_estimates_probability_jaccard():
    draw = np.random.default_rng(0)
    ids = mix(np.arange(1, 61, dtype=np.uint64))
    a, b = draw.uniform(0.2, 3, 60), draw.uniform(0.2, 3, 60)
    a[:20], b[40:] = 0, 0
    shared = [i for i in range(60) if a[i] and b[i]]
    exact = sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in range(60)) for i in shared)
    slots = 4096
    one, two = (prob_minhash(ids[w > 0], w[w > 0], slots) for w in (a, b))
    assert abs((one == two).mean() - exact) < 0.03
    assert (prob_minhash(ids[:1], np.ones(1), 80) == ids[0]).all()
    again = prob_minhash(ids[w_order := np.argsort(ids)][a[w_order] > 0], a[w_order][a[w_order] > 0], slots)
    assert (again == one).all()
    assert len(set(band_hashes(one[:80]).tolist())) == 20


def test_short_texts_are_one_shingle():
    words = np.arange(1, 4, dtype=np.uint64)
    assert len(shingle_hashes(words, 5)) == 1 and len(shingle_hashes(words, 3)) == 1 and len(shingle_hashes(words, 2)) == 2


def test_classes_equal_brute_force(spark, rows):
    draw = random.Random(7)
    data = []
    for _ in range(12):  # exact copies and edited copies, close ones and some beyond the threshold
        text = prose(draw, draw.randint(40, 120))
        copies = [text, text.upper(), text + " "] + [edited(draw, text, draw.choice([0.005, 0.01, 0.02, 0.04])) for _ in range(6)]
        data += copies
    passage = prose(draw, 60)  # shared by many that are otherwise different
    data += [passage + " " + prose(draw, 25) for _ in range(40)]
    data += [prose(draw, 30) for _ in range(40)]
    data += ["", "", "?!", "?!", "!?", "one two", "One, two", "one two three", "one two three four five"]
    draw.shuffle(data)
    data = [*enumerate(data, 100), (None, data[0]), (5, None), (6, None), (100, data[0])]
    docs = rows([(i, t, "x") for i, t in data], "doc_id BIGINT, text STRING, component STRING")
    got = near_duplicates(docs).collect()
    want = brute_force(data)
    assert len(got) == len(data)
    for r in got:
        assert r.class_id == want.get(r.doc_id, r.doc_id)


def test_classes_of_a_shared_passage_are_completed_by_rare_shingles(spark, rows):
    """Two classes meet in a band whose leader is like neither; the link between other members is found."""
    draw = random.Random(3)
    passage = prose(draw, 70)
    data = []
    for _ in range(30):
        tail = prose(draw, 24)
        text = passage + " " + tail
        data += [text, edited(draw, text, 0.01)]
    docs = rows(list(enumerate(data)), "doc_id BIGINT, text STRING")
    want = brute_force(list(enumerate(data)))
    assert len(set(want.values())) > 20
    assert {r.doc_id: r.class_id for r in near_duplicates(docs).collect()} == want


def test_repeated_lines_leave_links_whole(spark, rows):
    """Near copies are linked by their distinct shingles, however often each repeats lines of its own."""
    draw = random.Random(11)
    data = []
    for _ in range(12):
        body, lines = prose(draw, 200), [prose(draw, 15) for _ in range(2)]
        data += [" ".join([body, *[line] * draw.choice([300, 1000])]) for line in lines]
        data.append(" ".join([body, *[lines[0]] * 2]))  # the first one's shingles with other weights
    data = list(enumerate(data))
    want = brute_force(data)
    assert len(set(want.values())) == 12
    got = near_duplicates(rows(data, "doc_id BIGINT, text STRING")).collect()
    assert {r.doc_id: r.class_id for r in got} == want


def test_unit_weights_give_bands_of_the_set():
    draw = np.random.default_rng(1)
    misses = 0
    for _ in range(300):
        ids = mix(draw.integers(0, 2**63, 110).astype(np.uint64))
        a, b = np.unique(ids[:101]), np.unique(np.concatenate([ids[:90], ids[99:]]))
        heavy = lambda x: np.where(np.isin(x, ids[:90]), 1.0, 1 + np.log(1000))
        misses += not set(set_bands(a, heavy(a))[0].tolist()) & set(set_bands(b, heavy(b))[0].tolist())
        assert set_bands(a, np.ones(len(a)))[1].size == 0
    assert misses <= 1


def test_empty_table(spark, rows):
    assert near_duplicates(rows([], "doc_id BIGINT, text STRING")).count() == 0
