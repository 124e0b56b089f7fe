from __future__ import annotations

import random
import zlib
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from airlake.llm.packing import Merges, WordTokenizer, pack, pieces_of, write_buckets  # noqa: E402
from airlake.llm.queries import byte_bpe, packing_digest  # noqa: E402


def reference():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(byte_bpe())
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


ODD_TEXTS = [
    "", " ", "  \n\t x  y", "don't we'll I'VE", "a b c\x1cd\x85e", "naïve Ünï ½ ² 12٣", "中文 текст 🎉🎉  end ",
    "<|endoftext|> is a token", "hello <|endoftext|> world<|endoftext|><|endoftext|>", "<|endoftext|", " <|endoftext|> ",
    "one  two", "one \n two", "one\n two", "one \ntwo", " one two ", "end \n", " \u3000 wide", "a\u2028 b", "zero \x00 byte\x00s", "tab\tsep  \n\n\n new", "x" * 5000, "a b " * 3000, "\x00\x01", "é é", " '", "' s's",
]


def random_texts():
    draw = random.Random(5)
    return ODD_TEXTS + ["".join(draw.choice("ab é.'s1²\n\t 中") for _ in range(200)) for _ in range(100)]


@pytest.mark.parametrize("remembered", [0, 50, 100_000])
def test_ids_are_those_of_whole_texts(remembered):
    encode, words = reference(), WordTokenizer(byte_bpe(), remembered)
    texts = random_texts()
    expected = [encode(text) for text in texts]
    for _ in range(2):
        ids, bounds = words.encode_batch(pa.array([*texts, None]))
        assert [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:])] == [*expected, []]
        ids, bounds = words.encode_batch(pa.array(texts), end=(7).to_bytes(4, "little"))
        assert [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:])] == [own + [7] for own in expected]
        assert [array("I", words.encode(text)).tolist() for text in texts] == expected
        assert max(len(words.known), len(words.after_space)) <= remembered


def test_merges_of_one_call_are_those_of_the_file():
    merges = Merges(byte_bpe())
    assert merges.together is not None
    draw = random.Random(6)
    words = ["".join(draw.choice("eationsrédl ùñ,.\x00中") for _ in range(draw.randint(1, 30))) for _ in range(5000)]
    words += ["x" * 5000, "\x00"]
    assert merges.merge_all(words) == [merges.merge(word) for word in words]
    merges.together = None
    assert merges.merge_all(words[:50]) == [merges.merge(word) for word in words[:50]]
    assert merges.merge_all([]) == []


def new_parts(n):
    draw = random.Random(11)
    return ["".join(draw.choice("abcdeé1,.'-\n") for _ in range(9)) + "x" for _ in range(n)]


def test_parts_not_met_before_take_few_calls():
    """Splitting and merging them takes no Python work word by word, and none for each text."""
    import cProfile
    import pstats

    words, parts = WordTokenizer(byte_bpe()), new_parts(20_000)
    texts = pa.array([" ".join(parts[i : i + 10]) for i in range(0, len(parts), 10)])
    profile = cProfile.Profile()
    profile.runcall(words.encode_batch, texts)
    assert pstats.Stats(profile).total_calls < 2 * len(parts)
    profile = cProfile.Profile()
    profile.runcall(words.encode_batch, texts)
    assert pstats.Stats(profile).total_calls < 1000


@pytest.mark.parametrize("split_by_file", [True, False])
def test_parts_of_all_kinds_in_one_batch(split_by_file):
    encode, words = reference(), WordTokenizer(byte_bpe(), 3000)
    assert words.merges.splitting is not None
    if not split_by_file:
        words.merges.together = words.merges.splitting = None
    parts = [*new_parts(2000), "中文", "'s", "y" * 300, "naïve", "\n\nabc", "x\x00y", "12²½", "a\u00a0b", "it's\t\tme"]
    draw = random.Random(12)
    texts = [" ".join(draw.choice(parts) for _ in range(40)) + draw.choice(["", "\n", " ", "\n\n"]) for _ in range(200)]
    texts += [part + end for part in parts[-9:] for end in ["", "\n", " "]] + [" " + part for part in parts[-9:]]
    for _ in range(2):
        ids, bounds = words.encode_batch(pa.array(texts))
        assert [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:])] == [encode(text) for text in texts]
    assert len(words.stored) == len(words.after_space) and "y" * 300 not in words.after_space


def test_files_of_other_kinds_are_refused():
    with pytest.raises(ValueError):
        Merges(public_tokenizers.path("word_bpe_49k.json"))


def test_little_memory_for_each_byte_of_text():
    """A batch's working arrays take a few times its text, and batches are small."""
    import tracemalloc

    from airlake.llm.packing import TOGETHER

    draw, words = random.Random(1), WordTokenizer(byte_bpe())
    texts = pa.array([" ".join(f"word{draw.randrange(500)}" for _ in range(2000)) for _ in range(50)])
    words.encode_batch(texts, b"\0\0\0\0")
    tracemalloc.start()
    try:
        words.encode_batch(texts, b"\0\0\0\0")
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 6 * texts.nbytes and TOGETHER <= 4 << 20


def test_pieces():
    for total, lengths in [(1, [1]), (2048 + 7, [1024, 1024, 4, 2, 1]), (1024, [1024]), (1023, [512, 256, 128, 64, 32, 16, 8, 4, 2, 1])]:
        row, found = pieces_of(np.array([3, total]))
        assert found[row == 1].tolist() == lengths and found[row == 0].tolist() == [2, 1]
    row, lengths = pieces_of(np.arange(5000))
    assert np.bincount(row, lengths, 5000).tolist() == list(range(5000))


def test_documents_come_back_from_their_pieces(spark, rows):
    encode = reference()
    data = [(i, t, i) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id", 0), (100, None, 0), (3, ODD_TEXTS[3], 3)]
    docs = rows(data, "doc_id BIGINT, text STRING, ids INT")
    pieces = pack(docs, byte_bpe()).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    assert all(p.length & (p.length - 1) == 0 and 1 <= p.length <= 1024 and p.offset == 0 for p in pieces)
    for doc_id, text, _ in data:
        own = sorted({(p.start, p.length, bytes(p.ids), p.doc_tokens) for p in pieces if p.doc_id == doc_id})
        ids = array("I", b"".join(x[2] for x in own)).tolist()
        assert ids == encode(text or "") + [0]
        assert {x[3] for x in own} == {len(ids)}
        assert [x[0] for x in own] == [sum(y[1] for y in own[:i]) for i in range(len(own))]
    assert sum(p.doc_id == 3 for p in pieces) == 2 * len(pieces_of(np.array([len(encode(ODD_TEXTS[3])) + 1]))[0])


def test_digest_and_buckets(spark, rows, tmp_path):
    docs = rows([(1, "one two three", "x")], "doc_id BIGINT, text STRING, bucket STRING")
    pieces = pack(docs, byte_bpe())
    for p, d in zip(pieces.collect(), packing_digest(pieces).collect()):
        assert d.ids_crc32 == zlib.crc32(bytes(p.ids)) and len(p.ids) == 4 * p.length
    write_buckets(pieces, str(tmp_path / "out"))
    assert {f.name for f in Path(tmp_path / "out").iterdir() if f.is_dir()} == {"bucket=2"}


def test_empty_table(spark, rows):
    assert pack(rows([], "doc_id BIGINT, text STRING"), byte_bpe()).count() == 0
