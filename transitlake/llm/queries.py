"""The operators applied to the shared tables, with production parameters.

``QUERIES`` and ``ORACLES`` have what ``__spark_entry__`` registers. A query without
SQL is held against a brute-force version, or held-out labels, in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake.llm import (
    best_fit, budget_mix, conversation_repair, hard_negatives, line_windows, link_graph, merkle, order_minhash,
    quality_classifier, quality_rules, shard_table, toxicity, warc,
)
from transitlake.llm.tables import fold, prepare
from transitlake.session import scratch_dir

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = fold(F.col("doc_id"), 5) == 0
    model = quality_classifier.train(docs, labels.where(~held), "quality")
    return quality_classifier.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op2_order_minhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicate_classes(table(spark, sf_dir, "documents"))


@query("op3_toxicity_grammar")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = fold(F.col("doc_id"), 3) == 1
    model = toxicity.train(docs, labels.where(~held), "toxic")
    return toxicity.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "weight")


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query("op4_link_graph")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_graph.judge(table(spark, sf_dir, "pages"), URL_RULES)


LINE_WINDOWS_SQL = r"""
WITH lined AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
windows AS (
  SELECT doc_id, i AS pos, array_to_string(lines[i:i + 2], chr(10)) AS w
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM lined WHERE len(lines) >= 3)),
worded AS (SELECT * FROM windows WHERE regexp_matches(w, '[^\x20\x09-\x0D]')),
numbered AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) AS nth FROM worded),
covered AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM numbered, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text, count(*) AS n_kept
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM lined) l
  LEFT JOIN covered c ON c.doc_id = l.doc_id AND c.pos = l.pos WHERE c.pos IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, CAST(len(d.lines) AS BIGINT) AS n_lines,
       CAST(len(d.lines) - coalesce(k.n_kept, 0) AS BIGINT) AS n_removed, md5(coalesce(k.text, '')) AS clean_md5
FROM lined d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


@query("op5_line_windows", LINE_WINDOWS_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_windows.deduplicate_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("n_lines_").alias("n_lines"), F.col("n_removed_").alias("n_removed"), F.md5("text").alias("clean_md5"))


def _shard_sql() -> str:
    owners = ",".join(map(str, shard_table.fill(shard_table.shard_names())))
    return f"""
WITH filled AS (SELECT unnest(range({shard_table.SLOTS})) AS slot, unnest([{owners}]) AS shard),
placed AS (SELECT doc_id, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT % {shard_table.SLOTS} AS slot FROM documents)
SELECT p.doc_id, CAST(p.slot AS INTEGER) AS slot, CAST(f.shard AS INTEGER) AS shard
FROM placed p JOIN filled f ON f.slot = p.slot
"""


@query("op6_shard_table", _shard_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_table.place(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("slot_").alias("slot"), F.col("shard_").alias("shard"))


@query("op7_budget_mix")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget_mix.mix_sources(table(spark, sf_dir, "documents"))


@query("op8_quality_rules")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_best_fit")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack_documents(table(spark, sf_dir, "documents"))


@query("op10_merkle_tree")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.followed(table(spark, sf_dir, "documents"))


WARC_SQL = """
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
least AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM sized)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM least
"""


@query("op11_warc_salvage", WARC_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    return warc.read_archives(archives, payload=False).where("record_type IN ('response', 'revisit')").select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


HARD_NEGATIVES_SQL = """
WITH part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT) AS score
  FROM part a JOIN part b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, vec_id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) <= 10
"""


@query("op12_hard_negatives", HARD_NEGATIVES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    id, label = F.col("vec_id"), F.col("label")
    shifted = F.when(id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(hard_negatives.taking_part(table(spark, sf_dir, "embeddings"), id, shifted, F.col("embedding"), id % 100 == 0))


CONVERSATION_SQL = r"""
WITH RECURSIVE
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(k, ''),
           lambda c: [CAST(ord(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
         lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384)), 4294967295) % 20 AS w
  FROM keyed),
after_damage AS (
  SELECT conv_id, turn, CASE WHEN w = 4 THEN 'user' ELSE role END AS role,
         CASE w WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE w WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) FROM hashed)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last
  FROM after_damage),
faults AS (
  SELECT *, CASE WHEN last = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
         substr(role, 1, 1) AS c, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS c0
  FROM placed),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (c0 IS NOT NULL AND c0 || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
edits AS (
  SELECT conv_id, i, role, text, fault IN ('b', 'd') AS must, CASE fault WHEN 't' THEN 5 ELSE 0 END AS pen, c FROM faults),
back AS (
  SELECT conv_id, n + 1 AS i, 0 AS v0, 10 AS v1, 5 AS v2, 0 AS v3 FROM counted
  UNION ALL
  SELECT conv_id, i, least(o0, 5 + o2, 10 + o3), least(o1, 5 + o2, 10 + o3), least(o2, 5 + o3), least(o3, 5 + o2)
  FROM (SELECT e.conv_id, e.i,
               least(2 + v0, CASE WHEN must THEN 99999999 ELSE pen + least(1 + v2, CASE c WHEN 's' THEN v1 WHEN 'u' THEN v2 ELSE 99999999 END) END) AS o0,
               least(2 + v1, CASE WHEN must THEN 99999999 ELSE pen + least(1 + v2, CASE c WHEN 'u' THEN v2 ELSE 99999999 END) END) AS o1,
               least(2 + v2, CASE WHEN must THEN 99999999 ELSE pen + least(1 + v3, CASE c WHEN 'a' THEN v3 ELSE 99999999 END) END) AS o2,
               least(2 + v3, CASE WHEN must THEN 99999999 ELSE pen + least(1 + v2, CASE c WHEN 'u' THEN v2 ELSE 99999999 END) END) AS o3
        FROM back b JOIN edits e ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND e.i = b.i - 1)),
costs AS (SELECT conv_id, i, [v0, v1, v2, v3] AS v FROM back),
steps AS (
  SELECT h.conv_id, h.i, h.v, t.v AS v_next, e.role, e.text, e.must, e.pen, e.c
  FROM costs h LEFT JOIN costs t ON t.conv_id IS NOT DISTINCT FROM h.conv_id AND t.i = h.i + 1
  LEFT JOIN edits e ON e.conv_id IS NOT DISTINCT FROM h.conv_id AND e.i = h.i),
forward AS (
  SELECT conv_id, CAST(1 AS BIGINT) AS i, 0 AS s, '' AS audit, CAST([] AS VARCHAR[]) AS made, false AS done FROM counted
  UNION ALL
  SELECT conv_id, CASE WHEN letter IN ('', 'I') THEN i ELSE i + 1 END,
         CASE letter WHEN 'I' THEN filled WHEN 'R' THEN filled WHEN 'K' THEN kept ELSE s END, audit || letter,
         CASE letter WHEN 'I' THEN list_append(made, filled_role || ':') WHEN 'R' THEN list_append(made, filled_role || ':' || text)
                     WHEN 'K' THEN list_append(made, role || ':' || text) ELSE made END, letter = ''
  FROM (
    SELECT *, CASE WHEN role IS NULL THEN CASE WHEN v[s + 1] > 0 THEN 'I' ELSE '' END
                   WHEN v[s + 1] = 2 + v_next[s + 1] THEN 'D'
                   WHEN v[s + 1] = 5 + v[filled + 1] THEN 'I'
                   WHEN NOT must AND kept IS NOT NULL AND v[s + 1] = pen + v_next[kept + 1] THEN 'K' ELSE 'R' END AS letter
    FROM (SELECT f.*, p.* EXCLUDE (conv_id, i), CASE f.s WHEN 2 THEN 3 ELSE 2 END AS filled,
                 CASE f.s WHEN 2 THEN 'assistant' ELSE 'user' END AS filled_role,
                 CASE WHEN p.c = 's' AND f.s = 0 THEN 1 WHEN p.c = 'u' AND f.s <> 2 THEN 2 WHEN p.c = 'a' AND f.s = 2 THEN 3 END AS kept
          FROM forward f JOIN steps p ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND p.i = f.i WHERE NOT f.done))),
ends AS (SELECT conv_id, audit, sha256(array_to_string(made, chr(10))) AS hash FROM forward WHERE done)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.v0, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN back b ON b.conv_id IS NOT DISTINCT FROM o.conv_id AND b.i = 1
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query("op13_conversation_repair", CONVERSATION_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.audited(conversation_repair.damaged(rows), every=rows)
