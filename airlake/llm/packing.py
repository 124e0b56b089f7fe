"""Training sequences by power-of-two decomposition.

A document's tokens are cut into pieces whose lengths are powers of two: as many of
the full length as fit, then the binary digits of the rest, largest first. A piece is a
sequence by itself, so no sequence crosses documents and none is padded; sequences of
one ``bucket`` have one length and can be batched together.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.llm.batches import chunks, remembered

MAX_LENGTH = 1024
END_ID = 0
#: Parts of texts, and words of parts, that a worker remembers with their ids; others are tokenized each time.
REMEMBERED_WORDS = 200_000
#: What parts words that are merged in one call; words with it, and longer ones, are merged by themselves.
SEPARATOR, LONG_WORD = "\x00", 200
#: Bytes of text that are encoded together.
TOGETHER = 3 << 20

SCHEMA = "id {id_type}, start BIGINT, length BIGINT, ids BINARY, doc_tokens BIGINT, bucket INT"


def _byte_alphabet() -> dict[int, str]:
    """The character byte-level vocabularies write each byte as: printable ones stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(byte) for byte in printable} | {byte: chr(256 + i) for i, byte in enumerate(others)}


class WordTokenizer:
    """Byte-level BPE of whole texts, part by part.

    Such a tokenizer first splits a text by a fixed pattern and then encodes each word by
    itself, so the ids of a text are those of its words. A space that follows anything but
    white space always begins a word; hence texts are cut there first, and the parts, which
    recur, are remembered with their ids. Parts not met before are split by the pattern and
    their words merged, all in one call. The ids are those of a plain
    ``encode(text, add_special_tokens=False)``: the added tokens of the file, where a text
    spells one out, get their ids as well.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_WORDS):
        import regex

        self.merges = Merges(path)
        added = self.merges.added
        longest_first = sorted(added, key=len, reverse=True)
        self.added_split = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        self.remembered = remembered
        #: Ids of words; of parts that follow a space, with that space, their places in ``stored``.
        self.known: dict[str, bytes] = {}
        self.after_space: dict[str, int] = {}
        self.stored = pa.array([], pa.binary())
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s{l}{n}]+|\s+(?!\S)|\s+"
        self.any_split = regex.compile(
            pattern.replace("{L}", r"\p{L}").replace("{N}", r"\p{N}").replace("{l}", r"\p{L}").replace("{n}", r"\p{N}")
        )
        # The same classes spelled out for Latin text, where the standard module is faster.
        letters, digits = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
        latin = pattern.replace("{L}", f"[{letters}]").replace("{N}", f"[{digits}]").replace("{l}", letters)
        self.latin_split = re.compile(latin.replace("{n}", digits))
        self.beyond_latin = re.compile("[^\t\n\r -~¡-ɏ]")
        self.merges.split_by(latin.replace("{n}", digits + SEPARATOR))

    def words(self, text: str) -> list[str]:
        split = self.any_split if self.beyond_latin.search(text) else self.latin_split
        return split.findall(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if not self.added_split or not any(token in text for token in self.merges.added):
            return self._encode_words([text])[0]
        pieces = self.added_split.split(text)
        return b"".join(
            self.merges.added[piece].to_bytes(4, "little") if i % 2 else self._encode_words([piece])[0]
            for i, piece in enumerate(pieces)
        )

    def _encode_words(self, texts: list[str]) -> list[bytes]:
        words = [self.words(text) for text in texts]
        new = list({word for own in words for word in own if word not in self.known})
        self.known.update(zip(new, self.merges.merge_all(new)))
        ids = [b"".join(map(self.known.__getitem__, own)) for own in words]
        _forget(self.known, new, self.remembered)
        return ids

    def encode_batch(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, ``end`` after each, and where each text's ids begin (and the last end)."""
        texts = pc.fill_null(texts, "")
        parts = pc.split_pattern(texts, " ")
        offsets = parts.offsets.to_numpy()
        firsts, lasts = offsets[:-1], offsets[1:] - 1
        coded = parts.values.dictionary_encode()
        entry_of, distinct = coded.indices.to_numpy(), coded.dictionary

        # A space after white space need not begin a word: such texts, and those with added tokens, are encoded whole.
        empty = pc.equal(pc.binary_length(distinct), 0).to_numpy(zero_copy_only=False)
        blank_end = empty | pc.not_equal(pc.utf8_rtrim_whitespace(distinct), distinct).to_numpy(zero_copy_only=False)
        unsure = blank_end[entry_of]
        unsure[lasts] = False
        unsure[firsts[empty[entry_of[firsts]]]] = False
        whole = np.logical_or.reduceat(unsure, firsts)
        for token in self.merges.added:
            whole |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)

        # Entries: remembered parts, other parts after a space, texts' beginnings, whole texts, then nothing and the end.
        after = np.repeat(~whole, np.diff(offsets))
        after[firsts] = False
        used = np.zeros(len(distinct), bool)
        used[entry_of[after]] = True
        wanted = distinct.filter(pa.array(used)).to_numpy(zero_copy_only=False).tolist()
        places = np.fromiter(map(self.after_space.get, wanted, repeat(-1)), np.int32, len(wanted))
        new = np.flatnonzero(places < 0)
        new_parts = list(map(wanted.__getitem__, new.tolist()))
        beginnings = pc.if_else(pa.array(whole), "", parts.values.take(pa.array(firsts))).to_numpy(zero_copy_only=False).tolist()
        blank = np.concatenate([blank_end[np.flatnonzero(used)[new]], blank_end[entry_of[firsts]] & ~whole])
        learned = self._encode_parts([*(" " + part for part in new_parts), *beginnings], blank)
        others = [*map(self.encode, texts.filter(pa.array(whole)).to_pylist()), b"", end]
        entries = pa.concat_arrays([self.stored, learned, pa.array(others, pa.binary())])
        del unsure, blank_end, coded, wanted
        places[new] = len(self.stored) + np.arange(len(new))
        place_of = np.zeros(len(distinct), np.int32)
        place_of[used] = places
        entry_of = np.where(after, place_of[entry_of], np.int32(len(entries) - 2))
        entry_of[firsts] = len(self.stored) + len(new) + np.arange(len(texts))
        entry_of[firsts[whole]] = len(entries) - len(others) + np.arange(len(others) - 2)
        entry_of = np.insert(entry_of, offsets[1:], len(entries) - 1)
        self._remember(new_parts, learned)

        found = entries.take(pa.array(entry_of))
        stops = np.frombuffer(found.buffers()[1], np.int32)
        bounds = stops[np.concatenate([[0], offsets[1:] + np.arange(1, len(texts) + 1)])].astype(np.int64) // 4
        return np.frombuffer(found.buffers()[2] or b"", "<u4")[: bounds[-1]], bounds

    def _encode_parts(self, parts: list[str], blank: np.ndarray) -> pa.BinaryArray:
        """Ids of each; ``blank`` ones may end in white space."""
        odd = blank.copy()
        if not self.merges.splitting:
            odd[:] = True
        elif self.beyond_latin.search("".join(parts)) or max(map(len, parts), default=0) > LONG_WORD:
            odd |= [len(part) > LONG_WORD or self.beyond_latin.search(part) is not None for part in parts]
        merged = self.merges.merge_parts(list(compress(parts, (~odd).tolist())) if odd.any() else parts)
        if not odd.any():
            return merged
        order = np.where(odd, len(merged) + np.cumsum(odd), np.cumsum(~odd)) - 1
        return pa.concat_arrays([merged, pa.array(self._encode_words(list(compress(parts, odd.tolist()))), pa.binary())]).take(pa.array(order))

    def _remember(self, parts: list[str], ids: pa.BinaryArray) -> None:
        room = self.remembered - len(self.after_space)
        kept = [i for i, part in enumerate(parts) if len(part) <= LONG_WORD][:room] if room > 0 else []
        if kept:
            self.after_space.update(zip(map(parts.__getitem__, kept), range(len(self.stored), len(self.stored) + len(kept))))
            self.stored = pa.concat_arrays([self.stored, ids.take(pa.array(kept))])


def _forget(memory: dict[str, bytes], new: list[str], most: int) -> None:
    """Keep the ``most`` entries that came first."""
    for key in new[len(new) - min(len(new), max(0, len(memory) - most)) :]:
        memory.pop(key, None)


class Merges:
    """A byte-level BPE file's merges, applied to words that are split already.

    The file's own model makes a list of objects per word. A faster implementation that merges
    whatever pair has the lowest id as a whole gives the same ids if merges are listed in the
    order of their ids and every entry, merged by the file's model, comes out as itself: the first
    pair it joined that the file doesn't list would leave that entry in two pieces. Both are
    looked at for each file; without them, the file's model is used.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        settings = json.loads(tokenizer.to_str())
        self.added = _added_tokens(settings)
        self.model = tokenizer.model
        self.alphabet = _byte_alphabet()
        self.ranks: dict[bytes, int] = {}
        self.together = self._in_order_of_ids(settings["model"])
        self.splitting = None

    def _in_order_of_ids(self, model: dict):
        import tiktoken

        vocabulary = model["vocab"]
        byte_of = {character: byte for byte, character in self.alphabet.items()}
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        made = [vocabulary[a + b] for a, b in pairs]
        single = [vocabulary.get(character) for character in byte_of]
        whole = all(len(tokens := self.model.tokenize(entry)) == 1 and tokens[0].id == number for entry, number in vocabulary.items())
        ordered = all(a < b for a, b in zip(made, made[1:])) and None not in single and max(single) < min(made, default=1 << 32)
        if not (whole and ordered and len(made) + 256 == len(vocabulary)):
            return None
        self.ranks = {bytes(byte_of[c] for c in entry): number for entry, number in vocabulary.items()}
        self.separator = self.ranks[SEPARATOR.encode()]
        return tiktoken.Encoding("merges", pat_str=rf"[^{SEPARATOR}]+|{SEPARATOR}", mergeable_ranks=self.ranks, special_tokens={})

    def split_by(self, pattern: str) -> None:
        """How ``merge_parts`` splits; no word of ``pattern`` has the separator."""
        import tiktoken

        if self.together:
            self.splitting = tiktoken.Encoding("parts", pat_str=f"{SEPARATOR}|{pattern}", mergeable_ranks=self.ranks, special_tokens={})

    def merge_parts(self, parts: list[str]) -> pa.BinaryArray:
        """The ids of the words of each part; parts have no separator and end in no white space."""
        if not parts:
            return pa.array([], pa.binary())
        ids = self.splitting.encode_to_numpy(SEPARATOR.join(parts) + SEPARATOR).astype("<u4", copy=False)
        is_end = ids == self.separator
        stops = np.flatnonzero(is_end) - np.arange(len(parts))
        edges = np.concatenate([[0], 4 * stops]).astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(edges), pa.py_buffer(ids[~is_end])])

    def merge(self, word: str) -> bytes:
        mapped = word.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [token.id for token in self.model.tokenize(mapped)]).tobytes()

    def merge_all(self, words: list[str]) -> list[bytes]:
        """The ids of each word."""
        if not self.together:
            return [self.merge(word) for word in words]
        short = [word for word in words if len(word) <= LONG_WORD and SEPARATOR not in word]
        if len(short) < len(words):
            found = dict(zip(short, self.merge_all(short)))
            return [found[word] if word in found else self.merge(word) for word in words]
        if not words:
            return []
        ids = np.array(self.together.encode_ordinary(SEPARATOR.join(words) + SEPARATOR), "<u4")
        ends = np.flatnonzero(ids == self.separator)
        data, stops = ids.tobytes(), (4 * ends).tolist()
        return [data[i:j] for i, j in zip([0, *(stop + 4 for stop in stops)], stops)]


def _byte_alphabet() -> dict[int, str]:
    """The character byte-level vocabularies write each byte as: printable ones stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(byte) for byte in printable} | {byte: chr(256 + i) for i, byte in enumerate(others)}


def _added_tokens(settings: dict) -> dict[str, int]:
    """A file's added tokens; files whose texts aren't simply byte-level words are refused."""
    split = settings["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    if not plain or settings["normalizer"] or settings["model"]["type"] != "BPE" or settings["model"].get("dropout"):
        raise ValueError("byte-level BPE without normalizer or leading space expected")
    added = settings["added_tokens"]
    if any(token[flag] for token in added for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that take in their surroundings are not supported")
    return {token["content"]: token["id"] for token in added}


@remembered(2)
def word_tokenizer(path: str) -> WordTokenizer:
    """A worker's tokenizer, with what it remembers from task to task."""
    return WordTokenizer(path)


def pieces_of(totals: np.ndarray, longest: int = MAX_LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of documents of so many tokens, longest first: document's place and length of each."""
    powers = 1 << np.arange(longest.bit_length() - 1, -1, -1, dtype=np.int64)
    times = totals[:, None] // powers % 2
    times[:, 0] = totals // longest
    row = np.repeat(np.arange(len(totals)), times.sum(1))
    return row, np.repeat(np.tile(powers, len(totals)), times.ravel())


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    longest: int = MAX_LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece, that is per sequence.

    ``ids`` holds the piece's tokens as little-endian unsigned 32-bit numbers, ``start``
    the document's tokens before it, ``bucket`` the binary logarithm of its length,
    ``sequence_id`` a number no other piece has, ``offset`` its place in the sequence (0).

    Null and empty texts are a single ``end_id``. Repeated rows are packed each by itself;
    ids may be null. Other columns of ``docs`` are not read. No rows give no rows. Whole
    texts are tokenized; a text's pieces follow each other, nothing is shuffled.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    id_type = dict(docs.dtypes)[id_column]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer)
        end = end_id.to_bytes(4, "little")
        for whole in batches:
            for batch in chunks(whole, "text", TOGETHER):
                ids, bounds = words.encode_batch(batch.column("text"), end)
                totals = np.diff(bounds)
                row, lengths = pieces_of(totals, longest)
                stops = np.cumsum(lengths)
                starts = stops - lengths - bounds[row]
                edges = np.concatenate([[0], 4 * stops]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(row)),
                        pa.array(starts),
                        pa.array(lengths),
                        pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(edges), pa.py_buffer(ids)]),
                        pa.array(totals[row]),
                        pa.array(np.frexp(lengths)[1] - 1, pa.int32()),
                    ],
                    names=["id", "start", "length", "ids", "doc_tokens", "bucket"],
                )

    pieces = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(
        cut, SCHEMA.format(id_type=id_type)
    )
    return pieces.select(
        F.col("id").alias(id_column), "start", "length", "ids", "doc_tokens", "bucket",
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """A folder per length, as batches of one length are read together."""
    pieces.write.partitionBy("bucket").parquet(path)
