"""The ``opN_<name>`` queries over the given tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegraph.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query("op6_line_dedup", r"""
WITH l AS (
  SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ln,
         trim(unnest(string_split(text, chr(10))), ' ') AS line FROM documents WHERE text IS NOT NULL),
s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ln) AS s FROM l WHERE line <> ''),
r AS (SELECT a.doc_id, a.s, a.ln AS at1, b.ln AS at2, a.line AS l1, b.line AS l2
      FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.s = a.s + 1
      UNION ALL  -- a line of 50 words or more is a run of its own
      SELECT doc_id, s, ln, ln, line, '' FROM s WHERE len(regexp_extract_all(line, '[^ \t\n\x0B\f\r]+')) >= 50),
p AS (SELECT *, row_number() OVER (PARTITION BY l1, l2 ORDER BY doc_id, s) AS nth FROM r),
del AS (SELECT doc_id, at1 AS ln FROM p WHERE nth > 1 UNION SELECT doc_id, at2 FROM p WHERE nth > 1),
kept AS (
  SELECT d.doc_id, string_agg(d.line, chr(10) ORDER BY d.ln) AS text, count(*) AS n
  FROM (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ln,
               unnest(string_split(text, chr(10))) AS line FROM documents) d
  ANTI JOIN del ON del.doc_id = d.doc_id AND del.ln = d.ln GROUP BY d.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END::BIGINT AS n_lines,
       coalesce((SELECT count(*) FROM del WHERE del.doc_id = d.doc_id), 0)::BIGINT AS n_dropped,
       sha256(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END) AS text_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id""")
def op6_line_dedup(spark, sf):
    from sitegraph.llm.line_dedup import line_dedup
    out = line_dedup(table(spark, sf, "documents"), window=2, long_words=50)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@_query("op8_decontamination", f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, s, s + 9) AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS s FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, s, n, list_slice(w, s, s + n - 1) AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
             FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
m AS (SELECT DISTINCT dw.doc_id, dw.s, dw.n, bw.item_id FROM dw JOIN bw ON bw.n = dw.n AND bw.g = dw.g),
hit AS (SELECT doc_id, count(DISTINCT wp) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS wp FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
       FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id""")
def op8_decontamination(spark, sf):
    from sitegraph.llm.decontaminate import decontaminate
    out = decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"), n=10)
    return out.select("doc_id", "n_words", F.col("hits").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@_query("op3_packing")
def op3_packing(spark, sf):
    from sitegraph.llm.packing import pack
    return pack(table(spark, sf, "documents"), end_id=1, capacity=4096)


@_query("op4_token_files")
def op4_token_files(spark, sf):
    from sitegraph.llm.token_files import token_round_trip
    return token_round_trip(table(spark, sf, "documents"), end_id=0)


@_query("op2_simhash")
def op2_simhash(spark, sf):
    from sitegraph.llm.simhash import simhash
    out = simhash(table(spark, sf, "documents"), shingle=3, radius=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query("op7_toxicity")
def op7_toxicity(spark, sf):
    from sitegraph.llm.toxicity import toxicity
    out = toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"), threshold=0.7)
    return out.select("doc_id", "held_out", "score", "predicted")


@_query("op9_fingerprints")
def op9_fingerprints(spark, sf):
    from sitegraph.llm.winnowing import edited_likeness
    return edited_likeness(table(spark, sf, "documents"))


@_query("op10_main_text")
def op10_main_text(spark, sf):
    from sitegraph.llm.html_text import main_text
    out = main_text(table(spark, sf, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@_query("op1_lm_score")
def op1_lm_score(spark, sf):
    from sitegraph.llm.lm_score import lm_score
    return lm_score(table(spark, sf, "documents")).select("doc_id", "n_tokens", "log_prob", "mean_log_prob")


@_query("op5_substring_dedup")
def op5_substring_dedup(spark, sf):
    from sitegraph.llm.substring_dedup import substring_dedup
    out = substring_dedup(table(spark, sf, "documents"), length=200)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op12_conversation_repair")
def op12_conversation_repair(spark, sf):
    from sitegraph.llm.conversation import damage, repair_summary
    rows = table(spark, sf, "conversations")
    return repair_summary(damage(rows), rows)


@_query("op13_whitening")
def op13_whitening(spark, sf):
    from sitegraph.llm.whitening import whitened
    return whitened(table(spark, sf, "embeddings"), components=16)


@_query("op11_superminhash")
def op11_superminhash(spark, sf):
    from sitegraph.llm.superminhash import superminhash
    out = superminhash(table(spark, sf, "documents"), shingle=3, percent=85)
    return out.select("doc_id", "n_shingles", "component_id", "kept")
