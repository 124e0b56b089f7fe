"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns give the base spans. They miss what runs together, such as two card numbers
side by side, and forms that only their context or a repetition gives away. The field
labels the tokens that hold a digit or an @: neighbours that nearly touch share a
potential along the chain, and all distant tokens that repeat each other, or end in the same
digits, share a node of their key across the document. Loopy message passing, until the messages
settle, makes their labels agree; labelled tokens beside the base spans become further spans.
All other words are known to be outside. The field is learned from the base spans of a bounded
sample of documents; some spans are learned without what gave them away to the patterns, so that
neighbours and repetitions count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.llm.batches import chunks
from airlake.llm.prefilter import among_the_lowest, hash_order

KINDS = ["email", "ip", "card", "phone"]
OUTSIDE = len(KINDS)
LABELS = len(KINDS) + 1

#: Documents that are learned from, at most, and the characters of each, at a place chosen by a hash where it has more.
SAMPLE_DOCUMENTS, SAMPLE_CHARS = 2048, 20_000
#: Messages have settled when none changes by more; after so many rounds they are damped twice as much.
SETTLED, PATIENCE, DAMPING = 1e-7, 50, 0.3
#: Features by which the patterns know a span.
TELLING = ("shape ", "plus", "address", "at", "four parts", "luhn", "no luhn")
#: What speaks for a token of a shape that was not learned being outside.
UNSEEN = 2.0
#: Equal digits at the end that make two tokens similar.
SIMILAR_DIGITS = 7

Span = tuple[int, int, int]  # start, kind, end; sorts by start, then kind

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No digit before: a match that began inside a run of digits would have begun with it.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
SENSITIVE = re.compile("[0-9@]")
EDGES = "!\"#$%&'*,./:;<=>?[\\]^_`{|}~"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_byte(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, @ and domain, found from each @ so that long runs cost little."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """What the fixed patterns find, sorted; matches that fail their test are dropped."""
    found = [(start, 0, end) for start, end in _emails(text)]
    for m in IP.finditer(text):
        if all(map(_is_byte, m.group().split("."))):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


@dataclass
class Token:
    start: int
    end: int
    features: list[str]
    digits: str
    key: str


def _shape(text: str) -> str:
    shape = re.sub("[A-Za-z\x80-\U0010ffff]+", "a", re.sub("[0-9]+", lambda m: f"<{min(len(m.group()), 20)}>", text))
    return shape[:40]


def tokens_of(text: str) -> list[Token]:
    """Tokens with a digit or an @, without marks around them, and their features."""
    out = []
    for m in TOKEN.finditer(text) if SENSITIVE.search(text) else ():
        raw = m.group()
        left = len(raw) - len(raw.lstrip(EDGES))
        word = raw.strip(EDGES)
        if not word:
            continue
        digits = _digits(word)
        features = ["bias", "shape " + _shape(word), f"digits {min(len(digits), 20)}"]
        if word.startswith("+"):
            features.append("plus")
        if "@" in word:
            features.append("address" if any(True for _ in _emails(word)) else "at")
        parts = word.split(".")
        if len(parts) == 4 and all(p.isascii() and p.isdigit() and _is_byte(p) for p in parts):
            features.append("four parts")
        if 12 <= len(digits) <= 19 and re.fullmatch("[0-9 -]+", word):
            features.append("luhn" if luhn(digits) else "no luhn")
        key = digits[-SIMILAR_DIGITS:] if len(digits) >= SIMILAR_DIGITS else word.lower()
        out.append(Token(m.start() + left, m.start() + left + len(word), features, digits, key))
    for a, b in zip(out, out[1:]):
        if _touch(text, a, b):
            a.features.append("before " + b.features[1])
            b.features.append("after " + a.features[1])
    return out


def _touch(text: str, a: Token, b: Token) -> bool:
    return b.start - a.end <= 3 and not text[a.end : b.start].strip(" \t-.")


def edges_of(text: str, tokens: list[Token]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges between tokens that nearly touch, skip edges from a key's node to each of its tokens.

    Keys of several tokens are nodes, numbered after the tokens.
    """
    chain = [(i, i + 1) for i in range(len(tokens) - 1) if _touch(text, tokens[i], tokens[i + 1])]
    of_key: dict[str, list[int]] = {}
    for i, t in enumerate(tokens):
        of_key.setdefault(t.key, []).append(i)
    repeated = [own for own in of_key.values() if len(own) > 1]
    return chain, [(len(tokens) + n, i) for n, own in enumerate(repeated) for i in own]


def _gold(tokens: list[Token], spans: list[Span]) -> list[int]:
    """Labels of the base spans: the first that covers a token whole."""
    return [next((k for s, k, e in spans if s <= t.start and t.end <= e), OUTSIDE) for t in tokens]


@dataclass
class Field:
    """Weights of features and of label pairs along the two kinds of edges."""

    features: dict[str, int]
    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def scores(self, tokens: list[Token]) -> np.ndarray:
        out = np.zeros((len(tokens), LABELS))
        for i, t in enumerate(tokens):
            known = [self.features[f] for f in t.features if f in self.features]
            out[i] = self.unary[known].sum(axis=0)
            if t.features[1] not in self.features:
                out[i, OUTSIDE] += UNSEEN
        return out

    def marginals(self, scores: np.ndarray, chain: list, skip: list) -> np.ndarray:
        """Loopy sum-product messages over the edges until they settle; the labels' probabilities per token.

        Nodes beyond the tokens have no scores of their own. Damping grows with the rounds, so all messages settle.
        """
        tokens = len(scores)
        scores = np.concatenate([scores, np.zeros((max([a for a, _ in skip], default=-1) + 1 - tokens, LABELS))]) if skip else scores
        pairs = np.array([*chain, *skip], np.int64).reshape(-1, 2)
        if len(pairs):
            potential = np.concatenate([np.repeat(self.chain[None], len(chain), 0), np.repeat(self.skip[None], len(skip), 0)])
            sender, receiver = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
            # From the first token of an edge to the second, and back.
            weight = np.concatenate([potential, potential.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
            messages = np.zeros((len(sender), LABELS))
            rounds, damping, change = 0, DAMPING, np.inf
            while change > SETTLED:
                belief = scores.copy()
                np.add.at(belief, receiver, messages)
                sent = _log_sum((belief[sender] - messages[back])[:, :, None] + weight, 1)
                sent -= _log_sum(sent, 1)[:, None]
                sent = damping * messages + (1 - damping) * sent
                change, messages, rounds = np.abs(sent - messages).max(), sent, rounds + 1
                if rounds % PATIENCE == 0:
                    damping = (1 + damping) / 2
            scores = scores.copy()
            np.add.at(scores, receiver, messages)
        scores = scores[:tokens]
        return np.exp(scores - _log_sum(scores, 1)[:, None])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - most).sum(axis=axis, keepdims=True)) + most).squeeze(axis)


def fit(texts: list[str], steps: int = 300, rate: float = 0.1, strength: float = 1e-3) -> Field:
    """Maximise the pseudo-likelihood of the base spans' labels.

    Weights are drawn to zero, those of skip edges to a prior that favours equal labels. A key's node has, for each of its
    tokens, the most frequent label of the others. Half of the spans' tokens, chosen by their digits, lack the telling features. Tokens outside the
    spans that share the key of one inside teach nothing: the patterns may have missed them.
    """
    prior = 1.5 * np.eye(LABELS)
    number: dict[str, int] = {}
    rows, columns, gold, known, chains, skips = [], [], [], [], [], []
    for text in texts:
        tokens, first = tokens_of(text), len(gold)
        chain, skip = edges_of(text, tokens)
        chains += [(a + first, b + first) for a, b in chain]
        labels = _gold(tokens, base_spans(text))
        inside = {t.key for t, label in zip(tokens, labels) if label != OUTSIDE}
        taught = [label != OUTSIDE or t.key not in inside for t, label in zip(tokens, labels)]
        skips += [(label, i + first) for i, label in _said_by_others(skip, labels, taught)]
        known += taught
        gold += labels
        for i, t in enumerate(tokens):
            hidden = labels[i] != OUTSIDE and crc32(t.key.encode()) % 2
            for f in t.features:
                if hidden and f.startswith(TELLING):
                    number.setdefault(f, len(number))
                    continue
                rows.append(first + i)
                columns.append(number.setdefault(f, len(number)))
    field = Field(number, np.zeros((len(number), LABELS)), np.zeros((LABELS, LABELS)), prior.copy())
    chains = [(a, b) for a, b in chains if known[a] and known[b]]
    if not any(known):
        return field
    y, rows, columns = np.array(gold), np.array(rows), np.array(columns)
    c, s = np.array(chains, np.int64).reshape(-1, 2), np.array(skips, np.int64).reshape(-1, 2)
    truth, taught_rows = np.eye(LABELS)[y], np.array(known)[:, None]
    weights = [field.unary, field.chain, field.skip]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for step in range(1, steps + 1):
        logits = np.zeros((len(y), LABELS))
        np.add.at(logits, rows, field.unary[columns])
        np.add.at(logits, c[:, 0], field.chain.T[y[c[:, 1]]])
        np.add.at(logits, c[:, 1], field.chain[y[c[:, 0]]])
        np.add.at(logits, s[:, 1], field.skip[s[:, 0]])
        miss = (truth - np.exp(logits - _log_sum(logits, 1)[:, None])) * taught_rows
        up = [np.zeros_like(w) for w in weights]
        np.add.at(up[0], columns, miss[rows])
        np.add.at(up[1].T, y[c[:, 1]], miss[c[:, 0]])
        np.add.at(up[1], y[c[:, 0]], miss[c[:, 1]])
        np.add.at(up[2], s[:, 0], miss[s[:, 1]])
        for w, g, (mean, square), centre in zip(weights, up, moments, (0, 0, prior)):
            g = g / len(y) - strength * (w - centre)
            mean += 0.1 * (g - mean)
            square += 0.001 * (g * g - square)
            w += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return field


def _said_by_others(skip: list[tuple[int, int]], labels: list[int], taught: list[bool]) -> Iterator[tuple[int, int]]:
    """Tokens of a key with the most frequent label of the key's other tokens, the smallest on ties."""
    counts: dict[int, np.ndarray] = {}
    skip = [(node, i) for node, i in skip if taught[i]]
    for node, i in skip:
        counts.setdefault(node, np.zeros(LABELS, np.int64))[labels[i]] += 1
    for node, i in skip:
        others = counts[node].copy()
        others[labels[i]] -= 1
        if others.any():
            yield i, int(others.argmax())


#: What a further span must look like as a whole, by kind.
FORMS = [
    re.compile(r"[^\s@]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(?:\.[0-9]+){3}"),
    re.compile(r"[0-9][0-9 -]*[0-9]"), re.compile(r"[+(]?[0-9][0-9 ().-]*[0-9]"),
]
DIGITS = [(0, 10**9), (4, 12), (12, 19), (7, 15)]


def _plausible(kind: int, text: str) -> bool:
    least, most = DIGITS[kind]
    return bool(FORMS[kind].fullmatch(text)) and least <= len(_digits(text)) <= most


def _cards(text: str, tokens: list[Token]) -> list[tuple[int, int]]:
    """A run of card tokens, cut so that most of them are in pieces of 12 to 19 digits that pass Luhn.

    Of equal cuts the one with the fewest pieces; tokens in no such piece stay single.
    """
    n = len(tokens)
    best: list[tuple[int, int, int]] = [(0, 0, n)] * (n + 1)  # tokens in no piece, pieces, where the next begins
    for i in range(n - 1, -1, -1):
        best[i] = (best[i + 1][0] + 1, best[i + 1][1] + 1, i + 1)
        digits = ""
        for j in range(i, n):
            digits += tokens[j].digits
            if len(digits) > 19 or not tokens[j].digits:
                break
            if len(digits) >= 12 and luhn(digits) and _plausible(2, text[tokens[i].start : tokens[j].end]):
                best[i] = min(best[i], (best[j + 1][0], best[j + 1][1] + 1, j + 1))
    out, i = [], 0
    while i < n:
        out.append((tokens[i].start, tokens[best[i][2] - 1].end))
        i = best[i][2]
    return out


def further_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """Spans of labelled tokens that no base span touches; neighbours are one phone, or cards by their digits."""
    tokens = tokens_of(text)
    if not tokens:
        return []
    chain, skip = edges_of(text, tokens)
    labels = field.marginals(field.scores(tokens), chain, skip).argmax(axis=1)
    touched = set(chain)
    runs: list[list[int]] = []  # kind, first token, last token
    at = 0
    taken = sorted((s, e) for s, _, e in base)
    reach = 0  # the furthest end of base spans that begin before the token's end
    for i, (t, label) in enumerate(zip(tokens, labels.tolist())):
        while at < len(taken) and taken[at][0] < t.end:
            reach = max(reach, taken[at][1])
            at += 1
        if label == OUTSIDE or reach > t.start:
            continue
        if runs and runs[-1][0] == label and label in (2, 3) and runs[-1][2] == i - 1 and (i - 1, i) in touched:
            runs[-1][2] = i
        else:
            runs.append([label, i, i])
    found = []
    for k, a, b in runs:
        cut = _cards(text, tokens[a : b + 1]) if k == 2 else [(tokens[a].start, tokens[b].end)]
        found += [(s, k, e) for s, e in cut if _plausible(k, text[s:e])]
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", documents: int = SAMPLE_DOCUMENTS) -> Field:
    """Fit on at most ``documents`` of the documents with a digit or an @, those whose ids hash lowest.

    Of a text of more than ``SAMPLE_CHARS`` characters as many are learned from, at a place chosen by its hash.
    """
    key, text = F.col(f"`{id_column}`"), F.col(f"`{text_column}`").cast("string")
    share = min(1.0, 4 * documents / max(1, docs.where(text.rlike("[0-9@]")).count()))
    place = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1).cast("int") + 1
    sample = (
        docs.where(among_the_lowest(key, share))  # before the texts are looked at
        .where(text.rlike("[0-9@]"))
        .select(text.alias("text"), hash_order(key).alias("order"))
        .select("order", place.alias("place"), F.length("text").alias("chars"), F.substring("text", place, F.lit(SAMPLE_CHARS)).alias("text"))
        .orderBy("order", "text")
        .limit(documents)
        .collect()
    )
    return fit([_whole_words(r.text, r.place > 1, r.place - 1 + len(r.text) < r.chars) for r in sample])


def _whole_words(text: str, cut_before: bool, cut_after: bool) -> str:
    """A piece without the words it was cut in."""
    if cut_before:
        text = re.sub(r"^\S+", "", text)
    return re.sub(r"\S+$", "", text) if cut_after else text


def find_pii(docs: DataFrame, field: Field, text_column: str = "text") -> DataFrame:
    """Every document with the personal data in its whole text.

    Columns: ``row``, a struct of all columns of ``docs``; ``base`` and ``further``, arrays
    of structs (kind, first, last) with code point offsets, ``last`` exclusive, in order;
    ``base_text`` and ``spans``, base and all spans as text. A null text is empty and has
    none. Repeated rows and equal texts have one result each, no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # bounded by the sample
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for whole in batches:
            for batch in chunks(whole, "text"):
                base, further = [], []
                for text in batch.column("text").to_pylist():
                    base.append(base_spans(text) if text else [])
                    further.append(further_spans(text, base[-1], field) if text else [])
                structs = [
                    pa.array([[{"kind": KINDS[k], "first": s, "last": e} for s, k, e in x] for x in found], span_type)
                    for found in (base, further)
                ]
                texts = [pa.array([joined(x) for x in found], pa.string()) for found in (base, map(list.__add__, base, further))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), *structs, *texts], names=["row", "base", "further", "base_text", "spans"]
                )

    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    spans = "ARRAY<STRUCT<kind: STRING, first: INT, last: INT>>"
    return rows.mapInArrow(
        find, f"row {rows.schema['row'].dataType.simpleString()}, base {spans}, further {spans}, base_text STRING, spans STRING"
    )
