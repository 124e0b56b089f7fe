from __future__ import annotations

from collections import Counter

from airlake.llm.line_dedup import LineRuns, line_dedup, line_key


def brute_force(texts, min_docs=10, min_chars=1):
    count = Counter()
    for text in texts:
        count.update({line_key(x) for x in (text or "").split("\n")})
    out = []
    for text in texts:
        lines = (text or "").split("\n")
        keys = [line_key(x) for x in lines]
        gone = [len(k.decode()) >= min_chars and count[k] >= min_docs for k in keys]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g) if any(gone) else text
        out.append((kept, len(lines), sum(gone)))
    return out


TEXTS = (
    [f"own line {i}\n  Common LINE \x0b\nÉcole {i % 9}\n\n{'é' * (i % 3)}\nend" for i in range(12)]
    + ["common line", "common line\ncommon line", "école 0\nÉCOLE 0", None, "", "\n\n", " \t", "x\r\nend\r\n", "end "]
    + ["\n".join(f"long {i}" for i in range(20_000)) + "\nend"]
    + ["same\ntext end"] * 11
)


def test_equals_brute_force(spark, rows):
    for least in (1, 2):
        docs = rows([(i if i % 5 else None, t, i) for i, t in enumerate(TEXTS)], "doc_id BIGINT, text STRING, kept INT")
        got = {r.row.kept: (r.kept, r.n_lines, r.n_dropped) for r in line_dedup(docs, min_chars=least).collect()}
        want = brute_force(TEXTS, min_chars=least)
        assert [got[i] for i in range(len(TEXTS))] == want
        assert any(w[2] and w[0] == "" for w in want)


def test_empty_table(spark, rows):
    assert line_dedup(rows([], "doc_id BIGINT, text STRING")).count() == 0


def test_runs_are_levelled_and_settle(spark, rows):
    runs = LineRuns(spark, min_docs=3)
    batch = lambda *keys: rows([(k, 0, 1) for k in keys], "h1 BIGINT, h2 BIGINT, docs BIGINT")
    for keys in ((1, 2), (1, 3), (1, 2), (4, 2), (1, 5), (6, 3), (3, 7)):
        runs.add(batch(*keys))
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    # 1 was settled by the second merge, so the fifth batch's run has 5 only.
    assert {r.h1 for r in runs.frequent().collect()} == {1, 2}
    assert {r.h1 for r in runs.close().collect()} == {1, 2, 3}
    assert not [t for t in spark.catalog.listTables() if t.name in runs.tables]


def test_anti_join_of_runs_shuffles_nothing(spark, rows, plan):
    runs = LineRuns(spark, min_docs=1)
    for i in range(2):
        runs.add(rows([(i, 0, 1), (9, 0, 1)], "h1 BIGINT, h2 BIGINT, docs BIGINT"))
    merged = spark.table(runs.settled[0]).join(spark.table(runs.levels[1][0]).hint("merge"), ["h1", "h2"], "left_anti")
    assert "Exchange" not in plan(merged)
    runs.close()
