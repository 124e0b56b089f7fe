"""Language, quality and personal data: learned operators."""

from __future__ import annotations

import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest

from airlake.llm import language, pii, quality

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


def longest_matches(text, learned):
    """Phrases of one block by plain substring search."""
    count = 0
    for at in range(0, len(text), language.BLOCK):
        block, i = text[at : at + language.BLOCK], 0
        while i < len(block):
            n = 0
            while i + n < len(block) and block[i : i + n + 1] in learned:
                n += 1
            count += 1
            i += max(n, 1)
    return count


def test_phrases_are_longest_matches():
    draw = random.Random(1)
    learned = {"x": "".join(draw.choice("abc ") for _ in range(400)), "y": "".join(draw.choice("bcd ") for _ in range(300))}
    model = language.fit(learned)
    texts = ["".join(draw.choice("abcd z") for _ in range(n)) for n in (1, 5, 511, 512, 513, 2000)] + ["", "zzz"]
    found = model.phrases([model.symbols(t) for t in texts])
    for text, row in zip(texts, found.tolist()):
        assert row == [longest_matches(text, learned[k]) for k in ("x", "y")]


def test_every_learned_character_counts():
    """Many scripts, code points beyond 65,535 among them, beside a source that fills the list of frequent characters."""
    draw = random.Random(2)
    alphabets = {"x": range(0x61, 0x61 + 140), "y": range(0x4E00, 0x4E00 + 900), "z": range(0x20000, 0x20000 + 300)}
    write = lambda k, n: "".join(chr(draw.choice(alphabets[k])) for _ in range(n))
    learned = {"x": write("x", 9000), "y": write("y", 1500) + "ab", "z": write("z", 700)}
    model = language.fit(learned)
    texts = [learned["y"][100:900], learned["z"][50:600] + "ab", write("y", 300) + write("z", 20), write("x", 700), "\U0002f000\U0010ffff"]
    found = model.phrases([model.symbols(t) for t in texts])
    for text, row in zip(texts, found.tolist()):
        assert row == [longest_matches(text, learned[k]) for k in "xyz"]
    assert [k for k, _ in model.predict([learned[k][40:300] for k in "xyz"])] == ["x", "y", "z"]


def test_learns_whole_bound_from_distinct_texts_and_places(spark, rows):
    """A common header is one passage among others, short and repeated texts leave the bound filled."""
    draw = random.Random(6)
    words = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    header = words(500)
    data = [(i, header + words(4000), "headed") for i in range(60)]
    data += [(i, words(59) + "x", "short") for i in range(900)]
    data += [(i, "the same text again and again", "hot") for i in range(900)] + [(i, words(300), "hot") for i in range(100)]
    data += [(i, words(5000), "few") for i in range(6)] + [(9, "tiny", "few"), (1, "all there is", "little")]
    seen = {}
    fit, language.fit = language.fit, lambda texts: seen.update(texts) or fit(texts)
    try:
        model = language.train(rows(data, "doc_id BIGINT, text STRING, lang STRING"))
    finally:
        language.fit = fit
    learned = {k: sum(map(len, t.split("\n"))) for k, t in seen.items()}
    assert learned == {"headed": 24_000, "short": 24_000, "hot": 24_000, "few": 24_000, "little": 12}
    assert seen["headed"].count(header[100:200]) < 12
    assert seen["hot"].count("the same text") <= 1
    assert model.languages == sorted(learned)


def test_automaton_knows_all_substrings_only():
    codes = np.array([1, 2, 1, 1, 2, 3, 1, 2], np.uint8)
    table = language.suffix_automaton(codes, 4)
    text = "".join(map(str, codes))
    for n in range(1, 6):
        for value in range(4**n):
            word = [value // 4**i % 4 for i in range(n)]
            state = 1
            for c in word:
                state = int(table[state, c])
            assert (state != 0) == ("".join(map(str, word)) in text)


def test_undetermined_and_ties(spark, rows):
    model = language.fit({"b": "same text", "a": "same text", "c": ""})
    docs = rows([(1, "same", 0), (2, None, 0), (3, "", 0), (4, "12 .?", 0), (5, "é", 0), (1, "same", 0)], "doc_id BIGINT, text STRING, score INT")
    got = sorted((r.row.doc_id, r.lang_pred) for r in language.identify(docs, model).collect())
    assert got == [(1, "a"), (1, "a"), (2, "und"), (3, "und"), (4, "und"), (5, "a")]
    nothing = language.train(rows([(1, None, "en"), (2, "x", None)], "doc_id BIGINT, text STRING, lang STRING"))
    assert [r.lang_pred for r in language.identify(docs, nothing).collect()] == ["und"] * 6
    assert language.identify(docs.where("doc_id > 9"), model).count() == 0


@given
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    fold = lambda i: zlib.crc32(str(i).encode()) % 4
    kept = [r.doc_id for r in docs.select("doc_id").collect() if fold(r.doc_id) != 2]
    model = language.train(docs.where(docs.doc_id.isin(kept)))
    out = [r for r in language.identify(docs, model).collect() if fold(r.row.doc_id) == 2 and r.row.lang]
    assert np.mean([r.row.lang == r.lang_pred for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in out)

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = quality.score_quality(docs, quality.train(docs, labels.where(labels.doc_id.isin(kept))))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [r for r in scored.collect() if fold(r.row.doc_id) == 2 and r.row.doc_id in truth]
    assert np.mean([(r.score >= quality.THRESHOLD) == truth[r.row.doc_id] for r in held]) > 0.85


def test_votes_equal_all_pairs():
    draw = np.random.default_rng(2)
    texts = [" ".join(draw.choice(["aa", "bb", "cc!!", "DD", "ee|", "12"], draw.integers(0, 30))).encode() for _ in range(150)]
    found = list(quality.bags(texts))
    model = quality.fit(found[:100], (draw.random(100) < 0.6).astype(int).tolist(), dimensions=8)
    model.neighbours = 7
    vectors = np.stack([model.vector(*b) for b in found])
    got = model.scores(vectors)
    for v, score in zip(vectors, got):
        cosines = [float(v @ w / max(np.linalg.norm(v), 1e-12)) for w in model.vectors]
        least = sorted(cosines)[-7]
        votes = [(max(c, 0) ** 4, y) for c, y in zip(cosines, model.labels) if c >= least - 1e-6]
        assert abs(score - sum(w * y for w, y in votes) / sum(w for w, _ in votes)) < 1e-3


def test_scoring_holds_little(rows, plan):
    """Small blocks of products; texts are sent once; what a worker's other stages remembered is given back."""
    import tracemalloc

    from airlake.llm.batches import remembered

    draw = np.random.default_rng(5)
    model = quality.QualityModel(
        np.zeros((quality.FEATURES, 64), np.float32), draw.standard_normal((4096, 64), np.float32), draw.integers(0, 2, 4096) * 1.0, 0.5
    )
    vectors = draw.standard_normal((2000, 64), np.float32)
    tracemalloc.start()
    whole = model.scores(vectors)
    assert tracemalloc.get_traced_memory()[1] < 30e6
    tracemalloc.stop()
    assert np.allclose(whole, np.concatenate([model.scores(vectors[i : i + 7]) for i in range(0, 2000, 7)]), atol=1e-5)

    docs = rows([(1, "a b"), (2, None), (None, "")], "doc_id BIGINT, text STRING")
    scored = quality.score_quality(docs, model)
    assert [line for line in plan(scored).splitlines() if line.startswith("Input [1]: [row#")]
    assert {(r.row.doc_id, r.row.text) for r in scored.collect()} == {(1, "a b"), (2, None), (None, "")}
    numbered = quality.score_quality(docs.withColumn("text", docs.doc_id), model)  # a text that is not a string yet
    assert [r.row.text for r in numbered.collect()] == [1, 2, None]

    made = remembered(1)(lambda x: object())
    before = made(1)
    assert made(1) is before
    list(quality._bag_rows(iter([])))
    assert made(1) is not before


def test_bags_are_learned_in_one_order():
    import pyarrow as pa

    draw = random.Random(3)
    bags = [([draw.randrange(4) * 300 for _ in range(draw.randrange(4))], [], draw.randrange(2)) for _ in range(200)]
    bags = [(ids, [draw.choice((0.0, 0.5, 1.25)) for _ in ids], label) for ids, _, label in bags]
    columns = [pa.array(c, t) for c, t in zip(zip(*bags), (pa.list_(pa.int32()), pa.list_(pa.float64()), pa.int32()))]
    table = pa.table(columns, ["ids", "weights", "label"])
    for chosen in (table, pa.concat_tables([table.slice(150), table.slice(0, 150)])):
        assert [(i.tolist(), w.tolist(), label) for i, w, label in quality._in_order(chosen)] == sorted(bags)


def test_quality_of_odd_rows(spark, rows):
    docs = rows([(1, None, 0.0), (2, "", 0.0), (3, "word", 0.0), (3, "word", 0.0), (None, "x " * 50_000, 0.0)], "doc_id BIGINT, text STRING, score DOUBLE")
    labels = rows([(1, 1), (3, 0), (3, 1), (None, 1), (7, None)], "doc_id BIGINT, quality INT")
    model = quality.train(docs, labels)
    assert model.labels.tolist() == [1]  # of several rows of one id one is learned from
    assert [0 <= r.score <= 1 for r in quality.score_quality(docs, model).collect()] == [True] * 5
    nothing = quality.train(docs, labels.where("quality > 9"))
    assert {r.score for r in quality.score_quality(docs, nothing).collect()} == {1.0}
    assert quality.score_quality(docs.where("doc_id > 9"), model).count() == 0


PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def by_patterns(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    draw = random.Random(4)
    pieces = ["a", "b.c", "@", "@x.y", "x@y.z", ".", "-", "+", " ", "+1 (555) 123-4567", "4532015112830366", "4532 0151-1283 0366",
              "1.2.3.4", "256.1.1.1", "001.02.3.4", "1.2.3.4.5", "12", "9", "é", "\n", "a%b+c@d-e.f.g", "(", ")"]
    for _ in range(4000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 12)))
        assert pii.base_spans(text) == by_patterns(text), text
    for long in ("a" * 200_000, "1" * 200_000, "+1" * 50_000, "a@" * 50_000, "1." * 50_000, "x1" * 50_000):
        pii.base_spans(long)
        pii.tokens_of(long)


CARDS = ["4532015112830366", "4556737586899855", "5105105105105100", "4111111111111111"]


def sentences(draw):
    for _ in range(300):
        kind = draw.randint(0, 4)
        word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
        value = [f"{word()}.{draw.randint(1, 9)}@mail.example.com", ".".join(str(draw.randint(1, 255)) for _ in range(4)),
                 draw.choice(CARDS), f"+1 ({draw.randint(100, 999)}) 555-{draw.randint(1000, 9999)}",
                 f"version {draw.randint(1, 9)}.{draw.randint(0, 9)} of {draw.randint(10**15, 10**16 - 1)}x"][kind]
        yield f"{word()} {word()} {value} {word()}."


def test_field_finds_what_patterns_drop(spark, rows):
    draw = random.Random(9)
    field = pii.fit(list(sentences(draw)))
    side_by_side = f"pay {CARDS[0]} {CARDS[1]} now"
    together = f"call +1 (212) 555-7788 {CARDS[2]} soon"
    clean = "version 4.0 and 12 of 99 in 2024 a1b2c3"
    data = [(1, side_by_side, "x"), (2, together, "x"), (3, clean, "x"), (4, None, "x"), (None, "", "x"), (1, side_by_side, "x")]
    docs = rows(data, "doc_id BIGINT, text STRING, base STRING")
    got = [(r.row.doc_id, r.base_text, r.spans) for r in pii.find_pii(docs, field).collect()]
    one = f"card:4:20,card:21:37"
    assert got[0] == got[5] == (1, "", one)
    assert got[1][2] == "phone:5:22,card:23:39"
    assert [g[2] for g in got[2:5]] == ["", "", ""]
    assert pii.find_pii(docs.where("doc_id > 9"), field).count() == 0


def test_cards_in_groups_side_by_side():
    text = "pay 4111 1111 1111 1111 5500 0000 0000 0004 now, 1234 5678"
    scores = np.zeros((1, pii.LABELS))
    scores[0, 2] = 5.0
    nothing = np.zeros((pii.LABELS, pii.LABELS))
    field = pii.Field({"bias": 0, **{t.features[1]: 0 for t in pii.tokens_of(text)}}, scores, nothing, nothing)
    assert pii.base_spans(text) == []
    assert pii.further_spans(text, [], field) == [(4, 2, 23), (24, 2, 43)]


def test_skip_edges_make_labels_agree():
    text = "first 5551234567 and later 5551234567 or 5551234567"
    tokens = pii.tokens_of(text)
    chain, skip = pii.edges_of(text, tokens)
    assert not chain and skip == [(3, 0), (3, 1), (3, 2)]  # one node of the key that all repeat
    field = pii.Field({}, np.zeros((0, pii.LABELS)), np.zeros((pii.LABELS, pii.LABELS)), 2.0 * np.eye(pii.LABELS))
    scores = np.zeros((3, pii.LABELS))
    scores[0, 3], scores[1:, pii.OUTSIDE] = 4.0, 0.3
    assert field.marginals(scores, chain, skip).argmax(axis=1).tolist() == [3, 3, 3]
    assert field.marginals(scores, chain, []).argmax(axis=1).tolist() == [3, 4, 4]


def test_messages_are_exact_on_a_chain():
    draw = np.random.default_rng(3)
    field = pii.Field({}, np.zeros((0, pii.LABELS)), draw.normal(size=(pii.LABELS, pii.LABELS)), np.zeros((pii.LABELS, pii.LABELS)))
    scores = draw.normal(size=(4, pii.LABELS))
    chain = [(0, 1), (1, 2), (2, 3)]
    joint = np.zeros((pii.LABELS,) * 4)
    for i in range(4):
        joint += scores[i].reshape([-1 if d == i else 1 for d in range(4)])
    for a, b in chain:
        joint += field.chain.reshape([pii.LABELS if d in (a, b) else 1 for d in range(4)])
    p = np.exp(joint - joint.max())
    p /= p.sum()
    exact = np.stack([p.sum(axis=tuple(d for d in range(4) if d != i)) for i in range(4)])
    assert np.abs(field.marginals(scores, chain, []) - exact).max() < 1e-6


def test_messages_settle_on_loops():
    """Strong disagreeing potentials on loops keep plain messages from settling; damping ends them."""
    draw = np.random.default_rng(4)
    field = pii.Field({}, np.zeros((0, pii.LABELS)), draw.normal(scale=6, size=(pii.LABELS, pii.LABELS)), draw.normal(scale=6, size=(pii.LABELS, pii.LABELS)))
    chain = [(i, i + 1) for i in range(29)]
    skip = [(30 + i % 4, i) for i in range(30)]
    found = field.marginals(draw.normal(size=(30, pii.LABELS)), chain, skip)
    assert found.shape == (30, pii.LABELS) and np.abs(found.sum(1) - 1).max() < 1e-9


def test_evidence_reaches_every_repetition():
    text = " and ".join(["first 15551234567"] + ["15551234567"] * 400)
    tokens = pii.tokens_of(text)
    chain, skip = pii.edges_of(text, tokens)
    field = pii.Field({}, np.zeros((0, pii.LABELS)), np.zeros((pii.LABELS, pii.LABELS)), 3.0 * np.eye(pii.LABELS))
    scores = np.zeros((len(tokens), pii.LABELS))
    scores[:200, 3] = 1.0
    assert (field.marginals(scores, chain, skip).argmax(axis=1) == 3).all()


def documents_with_copies(draw, n):
    """Phone numbers, repeated with their plus or without, which the patterns do not know; and numbers of no kind."""
    for _ in range(n):
        number = f"1{draw.randint(10**9, 10**10 - 1)}"
        words = [" ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(6)) for _ in range(4)]
        other = f"{draw.randint(10**10, 10**11 - 1)}"
        again = draw.choice(["", "+"])
        text = f"{words[0]} +{number} {words[1]} {again}{number} {words[2]} item {other} {words[3]} {other}."
        at = text.index(f" {again}{number} ", text.index(number) + 1) + 1
        yield text, (at, 3, at + len(again + number)), again


def test_field_finds_copies_that_lost_what_gave_them_away():
    draw = random.Random(12)
    field = pii.fit([text for text, _, _ in documents_with_copies(draw, 300)])
    found = wrong = all_hidden = 0
    for text, hidden, known in documents_with_copies(draw, 400):
        base = pii.base_spans(text)
        assert (hidden in base) == bool(known)
        if known:
            continue
        all_hidden += 1
        further = pii.further_spans(text, base, field)
        found += hidden in further
        wrong += len([s for s in further if s != hidden])
    assert found >= 0.9 * all_hidden and wrong <= 0.05 * all_hidden


def test_long_documents_are_learned_from(spark, rows, monkeypatch):
    monkeypatch.setattr(pii, "SAMPLE_CHARS", 200)
    long = "word " * 2000 + " ".join(f"+1 212 555 {1000 + i}" for i in range(2000))
    learned = []
    monkeypatch.setattr(pii, "fit", lambda texts: learned.extend(texts))
    pii.train(rows([(1, long), (2, "short 1"), (3, None), (None, "x@y")], "doc_id BIGINT, text STRING"))
    assert len(learned) == 3 and {"short 1", "x@y"} < set(learned)
    piece = max(learned, key=len)
    assert 150 < len(piece) <= 200 and piece.strip() in long and all(w in long.split() for w in piece.split())


def test_pii_query_equals_brute_force(spark):
    """Counts and digests of the whole query, from patterns written plainly; the field may only add spans."""
    import hashlib

    from airlake.llm.queries import op6

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    got = op6(spark, folder).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        base = by_patterns(texts[r.doc_id])
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in base) for kind in range(4)]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        spans = [(int(s), pii.KINDS.index(k), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        assert spans == sorted(spans) and set(base) <= set(spans)


def test_number_signs_are_no_letters(spark, rows):
    model = language.fit({"aa": "abc abd " * 50, "bb": "xyz xyw " * 50})
    data = [(1, "½"), (2, "²³ 12"), (3, "１２"), (4, "abc"), (5, None), (6, ""), (7, "Ⅷ"), (8, "_"), (9, "中")]
    found = {r.row.doc_id: r.lang_pred for r in language.identify(rows(data, "doc_id INT, text STRING"), model).collect()}
    assert {i for i, lang in found.items() if lang == "und"} == {1, 2, 3, 5, 6, 7, 8} and found[4] == "aa"


def test_one_text_of_a_repeated_labelled_id(spark, rows, monkeypatch):
    docs = [(1, f"text {i}") for i in range(50)] + [(2, "two"), (3, "three"), (4, None)]
    labels = rows([(1, 1), (1, 0), (2, 0), (3, 1), (4, 1), (None, 1)], "doc_id INT, quality INT")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda found, labels: seen.append(([i.tolist() for i, _ in found], labels)))
    for order in (docs, docs[::-1]):
        quality.train(rows(order, "doc_id INT, text STRING").repartition(5), labels)
    assert seen[0] == seen[1] and len(seen[0][1]) == 3 and sorted(seen[0][1]) == [0, 1, 1]
