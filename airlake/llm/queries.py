"""The operators' queries over the given tables, next to their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airlake.llm import chat, language, mtree, pii, quality, repair
from airlake.llm.decontaminate import decontaminate
from airlake.llm.divergence import divergence
from airlake.llm.genetic_packing import pack_best_fit
from airlake.llm.line_dedup import line_dedup
from airlake.llm.near_dup import near_duplicates
from airlake.llm.packing import pack
from airlake.llm.warc import assemble, field, read_records, write_captures
from airlake.plans.registry import query
from airlake.scratch import new_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def byte_bpe() -> str:
    """The public byte-level vocabulary's file, found on each machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def packing_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op5_packing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return packing_digest(pack(table(spark, folder, "documents"), byte_bpe()))


OP2 = r"""
WITH lines AS (
  SELECT doc_id, row_number() OVER () AS doc, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), keyed AS (
  SELECT doc, generate_subscripts(parts, 1) AS place, unnest(parts) AS line FROM lines
), keys AS (
  SELECT doc, place, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM keyed
), frequent AS (
  SELECT key FROM keys WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc) >= 10
), kept AS (
  SELECT doc, count(*) AS n_lines, count(f.key) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE f.key IS NULL), '') AS text
  FROM keys LEFT JOIN frequent f ON f.key = keys.key GROUP BY doc
)
SELECT doc_id, n_lines, n_dropped, sha256(kept.text) AS kept_sha256 FROM kept JOIN lines USING (doc)
"""


@query("op2_line_dedup", OP2)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that ten documents hold leave all of them; the digest is taken of what is left."""
    kept = line_dedup(table(spark, folder, "documents"))
    digest = F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256)
    return kept.select("row.doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


OP9 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, text, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN ['no word: ' || text]
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE shared.n >= 0.8 * (a.n + b.n - shared.n) - 1e-9
), reached AS (
  SELECT doc_id, doc_id AS low FROM sizes
  UNION
  SELECT links.y, reached.low FROM reached JOIN links ON links.x = reached.doc_id WHERE links.y > reached.low
)
SELECT documents.doc_id, coalesce(min(reached.low), documents.doc_id) AS class_id
FROM documents LEFT JOIN reached USING (doc_id) GROUP BY documents.doc_id
"""


@query("op9_near_duplicates", OP9)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Each document with the smallest id among its near duplicates."""
    return near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id")


OP10 = r"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM firsts
"""


@query("op10_warc", OP10)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Write the pages as archives, read these and assemble the captures."""
    path = new_path(spark, "warc")
    write_captures(table(spark, folder, "pages"), path)
    captures = assemble(read_records(spark, path))
    kind = F.col("response.type")
    return captures.select(
        field("metadata", "page").cast("long").alias("page_id"),
        F.when(kind == "response", F.col("response.payload_length")).otherwise(field("metadata", "payload-length").cast("long")).alias("payload_bytes"),
        F.replace("response.payload_digest", F.lit("sha256:"), F.lit("")).alias("payload_digest"),
        kind.alias("record_type"),
        field("metadata", "refers-to-page").cast("long").alias("refers_to"),
    )


OP8 = r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS doc, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), item_words AS (
  SELECT item_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
    unnest(list_transform(generate_series(1, len(w) - least(len(w), 10) + 1),
      lambda i: array_to_string(w[i:i + least(len(w), 10) - 1], ' '))) AS words
  FROM item_words WHERE len(w) > 0
), lengths AS (
  SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc, w, n, unnest(generate_series(1, len(w) - n + 1)) AS place FROM doc_words, lengths WHERE len(w) >= n
), hits AS (
  SELECT doc, place, windows.n, item_id
  FROM places JOIN windows ON windows.n = places.n AND windows.words = array_to_string(w[place:place + places.n - 1], ' ')
), hit_words AS (
  SELECT doc, count(DISTINCT p) AS n_hit
  FROM (SELECT doc, unnest(generate_series(place, place + n - 1)) AS p FROM hits) GROUP BY doc
), hit_items AS (
  SELECT doc, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc) LEFT JOIN hit_items USING (doc)
"""


@query("op8_decontaminate", OP8)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """What every document shares with the benchmark."""
    found = decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def fold(id_column: str = "doc_id"):
    """The held-out fold is 2 of 0 to 3."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 4


def held_out(id_column: str = "doc_id"):
    return F.coalesce(fold(id_column) == 2, F.lit(False)).alias("held_out")


@query("op3_language")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Languages learned from the documents outside the held-out fold."""
    docs = table(spark, folder, "documents")
    model = language.train(docs.where(fold() != 2))
    return language.identify(docs, model).select("row.doc_id", held_out("row.doc_id"), "lang_pred", "score")


@query("op4_quality")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Scores learned from the labels outside the held-out fold."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.train(docs, labels.where(fold() != 2))
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    return quality.score_quality(docs, model).select("row.doc_id", held_out("row.doc_id"), "score", predicted)


OP1 = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""


@query("op1_mtree_top_k", OP1)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """The five largest inner products for every fiftieth vector."""

    def whole(x):
        value = x.cast("double")
        finite = ~F.isnan(value) & (F.abs(value) < float("inf"))
        return F.when(finite, F.floor(256 * value).cast("double"))

    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.transform("embedding", whole).alias("vector")
    )
    found = mtree.top_k(mtree.build_index(vectors), vectors.where("id % 50 = 0"), k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query("op6_pii")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Base and further spans of personal data in every document."""
    docs = table(spark, folder, "documents")
    found = pii.find_pii(docs, pii.train(docs))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "row.doc_id", *map(count, pii.KINDS), F.sha2(F.col("base_text").cast("binary"), 256).alias("base_sha256"), "spans"
    )


OP7 = r"""
WITH turns AS (
  SELECT row_number() OVER () AS n, conv_id, turn, coalesce(role, 'unknown') AS speaker,
    replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), people AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'
), heads AS (
  SELECT *, speaker = perspective AS own, CASE
      WHEN speaker = 'system' THEN '<|im_start|>system' || chr(10)
      WHEN speaker = perspective THEN '<|im_start|>assistant' || chr(10)
      ELSE '<|im_start|>user name=' || regexp_replace(speaker, '[^A-Za-z0-9_.-]', '_', 'g') || chr(10) END AS head
  FROM turns JOIN people USING (conv_id)
), rendered AS (
  SELECT *, head || text || '<|im_end|>' || chr(10) AS rendered FROM heads
), placed AS (
  SELECT *, sum(length(rendered)) OVER (
    PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, md5(text), n
    ROWS UNBOUNDED PRECEDING) AS stop
  FROM rendered
)
SELECT conv_id, perspective, turn, speaker, rendered, CAST(stop - length(rendered) AS BIGINT) AS start,
  CAST(stop AS BIGINT) AS "end",
  CASE WHEN own THEN CAST(stop - length(rendered) + length(head) AS BIGINT) END AS mask_start,
  CASE WHEN own THEN CAST(stop - 1 AS BIGINT) END AS mask_end
FROM placed
"""


@query("op7_perspectives", OP7)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation from the view of each of its speakers."""
    return chat.perspectives(table(spark, folder, "conversations")).withColumnRenamed("conversation", "conv_id")


@query("op11_best_fit")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 1,024 tokens, uncut where they fit."""
    pieces = pack_best_fit(table(spark, folder, "documents"), byte_bpe())
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


OP12 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), words AS (
  SELECT doc, lang, source, unnest(w) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
), langs AS (
  SELECT lang, count(kept.term) AS v, coalesce(sum(kept.c), 0) AS n
  FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang
), counts AS (
  SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT g.lang, g.source, coalesce(sum(counts.c), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counts USING (lang, source) GROUP BY ALL
), shares AS (
  SELECT g.lang, g.source, kept.term, coalesce(counts.c, 0) AS c,
    1 + (CAST(1000000000 AS HUGEINT) * CAST(coalesce(counts.c, 0) + 5 AS HUGEINT)) // CAST(g.n + 5 * langs.v AS HUGEINT) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * CAST(kept.c + 5 AS HUGEINT)) // CAST(langs.n + 5 * langs.v AS HUGEINT) AS q
  FROM groups g JOIN langs USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(d.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
  ) d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, p - q, row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term)
  FROM shares WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query("op12_divergence", OP12)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """How far each language's sources are apart, and the words each has too much of."""
    return divergence(table(spark, folder, "documents")).select("lang", "source", "part", "item", "value", "rank")


OP13 = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), keys AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda x: CAST(ascii(x) AS BIGINT)) AS bytes
  FROM conversations
), kinds AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([4294967295], bytes),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS kind
  FROM keys, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
    left(role, 1) AS initial, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending
  FROM damaged
), rows AS (
  SELECT conv_id, turn, role, text, pos, initial, lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before, CASE
      WHEN ending = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM numbered
), states AS (
  SELECT unnest([0, 1, 2, 3]) AS s
), inserts AS (
  SELECT * FROM (VALUES (0, 0, ''), (0, 2, 'I'), (0, 3, 'II'), (1, 1, ''), (1, 2, 'I'), (1, 3, 'II'),
    (2, 2, ''), (2, 3, 'I'), (3, 3, ''), (3, 2, 'I')) i(m, t, letters)
), edits AS (
  SELECT s, s AS m, 'D' AS letter, NULL AS initial FROM states
  UNION ALL SELECT s, CASE WHEN s = 2 THEN 3 ELSE 2 END, 'R', NULL FROM states
  UNION ALL SELECT * FROM (VALUES (0, 1, 'K', 's'), (0, 2, 'K', 'u'), (1, 2, 'K', 'u'), (3, 2, 'K', 'u'), (2, 3, 'K', 'a'))
  UNION ALL SELECT s, s, 'K', '' FROM states
), moves AS (
  SELECT s, t, initial, letter, letter || letters AS letters,
    CASE letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + 5 * length(letters) AS cost
  FROM edits JOIN inserts USING (m)
), dp AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, t AS s, {'c': CAST(5 * length(letters) AS BIGINT), 'a': letters} AS best
  FROM (SELECT DISTINCT conv_id FROM rows), inserts WHERE m = 0
  UNION ALL
  SELECT dp.conv_id, dp.pos + 1, moves.t, min({
    'c': dp.best.c + moves.cost + CASE WHEN rows.fault = 'truncated' AND letter <> 'D' THEN 5 ELSE 0 END,
    'a': dp.best.a || moves.letters})
  FROM dp JOIN rows ON rows.conv_id IS NOT DISTINCT FROM dp.conv_id AND rows.pos = dp.pos + 1
  JOIN moves ON moves.s = dp.s AND coalesce(moves.initial = rows.initial, true)
    AND (letter = 'D' OR rows.fault NOT IN ('blank', 'duplicate'))
  GROUP BY dp.conv_id, dp.pos, moves.t
), sizes AS (
  SELECT conv_id, max(pos) AS n, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id
), best AS (
  SELECT dp.conv_id, min(best) AS b FROM dp JOIN sizes ON sizes.conv_id IS NOT DISTINCT FROM dp.conv_id AND sizes.n = dp.pos
  WHERE s IN (0, 3) GROUP BY dp.conv_id
), letters AS (
  SELECT conv_id, b.a AS audit, unnest(string_split(b.a, '')) AS letter, unnest(range(1, 1 + length(b.a))) AS place
  FROM best WHERE b.a <> ''
), placed AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY place) AS pos,
    count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY place) AS nth
  FROM letters
), kept AS (
  SELECT placed.conv_id, place, nth, letter, rows.role, rows.text, rows.initial FROM placed
  LEFT JOIN rows ON rows.conv_id IS NOT DISTINCT FROM placed.conv_id AND rows.pos = placed.pos AND letter <> 'I'
  WHERE letter <> 'D' AND NOT (letter = 'K' AND rows.initial = '')
), turns AS (
  SELECT conv_id, place, letter, text, role,
    row_number() OVER (PARTITION BY conv_id ORDER BY place) - max(CASE WHEN initial = 's' AND letter = 'K' THEN 1 ELSE 0 END)
      OVER (PARTITION BY conv_id) AS number
  FROM kept
), lines AS (
  SELECT conv_id, place, CASE WHEN letter = 'K' THEN role WHEN number % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END AS line FROM turns
  UNION ALL
  SELECT placed.conv_id, place, ':' || rows.text FROM placed
  JOIN rows ON rows.conv_id IS NOT DISTINCT FROM placed.conv_id AND rows.pos = placed.pos
  WHERE letter = 'K' AND rows.initial = ''
), repaired AS (
  SELECT conv_id, string_agg(line, chr(10) ORDER BY place) AS whole FROM lines GROUP BY conv_id
)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN sizes ON sizes.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


@query("op13_repair", OP13)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations are damaged and repaired; what was found and done in each."""
    given = table(spark, folder, "conversations")
    damaged = repair.damage(given)
    found = repair.repair(damaged)
    gaps = damaged.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).cast("long").alias("gaps")
    )
    out = given.select("conv_id").distinct()
    out = repair.joined(out, gaps, ["conv_id"], "left")
    out = repair.joined(out, found.conversations.withColumnRenamed("conversation", "conv_id"), ["conv_id"], "left")
    out = repair.joined(out, repair.digests(found.edits).withColumnRenamed("conversation", "conv_id"), ["conv_id"], "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return out.select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", nothing).alias("repaired_sha256"),
    )
