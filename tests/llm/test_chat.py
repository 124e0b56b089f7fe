from __future__ import annotations

import hashlib

from airlake.llm.chat import as_examples, perspectives

TURNS = (
    [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob b", "yes"), (1, 3, "ann", None), (1, 3, "ann", "x")]
    + [(2, i, ("u", "v")[i % 2], "t" * (i % 7)) for i in range(3000)]
    + [(3, 0, "system", "alone"), (4, None, None, "late"), (4, 1, "a", "b"), (4, 1, "a", "b"), (None, 0, "a", "gone")]
)


def brute_force(turns):
    out = {}
    for conv in {t[0] for t in turns if t[0] is not None}:
        own = [(n, r or "unknown", (x or "").replace("<|", "< |")) for c, n, r, x in turns if c == conv]
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.md5(t[2].encode()).hexdigest()))
        for person in {r for _, r, _ in own} - {"system"}:
            text, masks = "", []
            for _, r, x in own:
                head = {"system": "system", person: "assistant"}.get(r, "user name=" + r.replace(" ", "_"))
                text += f"<|im_start|>{head}\n"
                if r == person:
                    masks.append((len(text), len(text) + len(x) + len("<|im_end|>")))
                text += x + "<|im_end|>\n"
            out[conv, person] = text, masks
    return out


def test_every_perspective(spark, rows):
    frame = rows([(*t, "z") for t in TURNS], "conv_id BIGINT, turn INT, role STRING, text STRING, start STRING")
    rendered = perspectives(frame)
    got = {(r.conversation, r.perspective): (r.text, [tuple(m) for m in r.masks]) for r in as_examples(rendered).collect()}
    want = brute_force(TURNS)
    assert got == want
    for r in rendered.collect():
        text = want[r.conversation, r.perspective][0]
        assert text[r.start : r.end] == r.rendered
        assert (r.mask_start is not None) == (r.speaker == r.perspective)


def test_empty_table(spark, rows):
    assert perspectives(rows([], "conv_id BIGINT, turn INT, role STRING, text STRING")).count() == 0
