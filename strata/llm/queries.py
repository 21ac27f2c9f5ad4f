"""The queries of the driver: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import (
    divergence,
    fill_middle,
    fingerprints,
    license_scan,
    line_dedup,
    packing,
    quality_rules,
    secret_scan,
    segmentation,
    sharding,
    simhash,
    token_counts,
    tool_calls,
)
from strata.llm.registry import oracles, query, runners

__all__ = ["oracles", "runners"]

QUALITY_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
      FROM (SELECT k, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM docs)),
n AS (SELECT k, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY k),
g AS (SELECT k, pos, word || chr(10) || lead(word) OVER o || chr(10) || lead(word, 2) OVER o AS tri
      FROM w WINDOW o AS (PARTITION BY k ORDER BY pos)),
again AS (SELECT k, pos FROM (SELECT k, pos, count(*) OVER (PARTITION BY k, tri) AS c FROM g WHERE tri IS NOT NULL) WHERE c > 1),
rep AS (SELECT k, count(DISTINCT pos + d) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) v(d) GROUP BY k),
l AS (SELECT k, unnest(ls) AS line FROM (SELECT k, string_split(t, chr(10)) AS ls FROM docs)),
lw AS (SELECT k, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS c FROM l),
dup AS (SELECT k, count(*) - count(DISTINCT line) AS n_dup_lines FROM lw WHERE c > 0 GROUP BY k),
norm AS (SELECT k, c, regexp_replace(trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')), '[0-9]', '0', 'g') AS line
         FROM lw WHERE c > 0),
held AS (SELECT source, line, count(DISTINCT t) AS n_docs FROM norm JOIN docs USING (k) GROUP BY source, line),
hosts AS (SELECT source, count(DISTINCT t) AS n_host FROM docs GROUP BY source),
freq AS (SELECT held.source, line FROM held JOIN hosts ON held.source IS NOT DISTINCT FROM hosts.source
         WHERE n_docs >= 10 AND n_docs >= 0.02 * n_host),
gone AS (SELECT k, count(*) AS lines_removed, sum(c) AS words_removed
         FROM norm JOIN docs USING (k) JOIN freq ON freq.source IS NOT DISTINCT FROM docs.source AND freq.line = norm.line
         GROUP BY k),
s AS (SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(words_removed, 0)::BIGINT AS words_removed, coalesce(lines_removed, 0) AS lines_removed
      FROM docs LEFT JOIN n USING (k) LEFT JOIN rep USING (k) LEFT JOIN dup USING (k) LEFT JOIN gone USING (k)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        words_removed > 0 AND n_words - words_removed < 0.3 * n_words AS depleted FROM s)
SELECT *, NOT base_failed AND NOT depleted AS kept FROM v
"""


@query("op1_quality_rules", QUALITY_SQL)
def _quality(spark, table):
    """Rules on one text and frequent lines of a host, over all documents."""
    return quality_rules.verdicts(table("documents"))


LINE_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT k, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM docs),
kl AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM l),
many AS (SELECT line_key, max(doc_id) AS top FROM kl WHERE length(line_key) >= 40
         GROUP BY line_key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT kl.*, many.top IS NOT NULL AND many.top <> doc_id AS gone FROM kl LEFT JOIN many USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY k, doc_id
"""


@query("op6_line_dedup", LINE_SQL)
def _line_dedup(spark, table):
    """Lines that several documents share, over all documents."""
    docs = table("documents").select("doc_id", "text")
    return line_dedup.applied(docs).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op8_simhash_near_dedup")
def _simhash(spark, table):
    """Near duplicates among all documents."""
    return simhash.near_duplicates(table("documents")).select(
        "doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id"
    )


@query("op5_token_counts")
def _token_counts(spark, table):
    """Tokens of all documents."""
    return token_counts.token_counts(table("documents"))


@query("op10_packing")
def _packing(spark, table):
    """All documents packed into sequences."""
    return packing.pack(table("documents")).drop("ids")


@query("op2_document_fingerprints")
def _fingerprints(spark, table):
    """Sketches of all documents and of their edited texts."""
    return fingerprints.edited_fingerprints(table("documents"))


@query("op7_sharding")
def _sharding(spark, table):
    """All documents in forty shards of about equal bytes."""
    return sharding.sharded(table("documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op3_license_scans")
def _licenses(spark, table):
    """License phrases and notices in all documents."""
    return license_scan.scan(table("documents"))


# Tools that the turns of a conversation are read as calls of, with their schemas.
TOOLS = {
    "configure": {
        "type": "object",
        "properties": {"text": {"type": "string", "maxLength": 200}, "words": {"type": "integer"}, "turn": {"type": "integer", "maximum": 0}},
        "required": ["text", "words"],
        "additionalProperties": False,
    },
    "lookup": {
        "type": "object",
        "properties": {"text": {"type": "string", "minLength": 1, "maxLength": 60}, "words": {"type": "integer", "minimum": 2}},
        "required": ["text", "words"],
    },
    "answer": {
        "type": "object",
        "properties": {"text": {"type": "string", "maxLength": 400}, "words": {"type": "integer", "maximum": 60}, "turn": {"type": "integer"}},
        "required": ["text", "words", "turn"],
        "additionalProperties": False,
    },
}


def chat_calls(turns):
    """Turns as calls and results: what a user, the system or nobody named says is a call, which
    refers to an earlier turn half way back; the assistant's next turn is its result."""
    ident = lambda turn: F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))
    n = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), r"\s+"), ""))
    turn = F.col("turn").cast("long")
    back = turn - 2 * F.floor((turn + 3) / 4)
    calls = turns.where(~F.col("role").eqNullSafe("assistant")).select(
        "conv_id",
        F.when(turn.isNotNull(), ident(turn)).alias("call_id"),
        turn.alias("pos"),
        F.when(F.col("role") == "system", "configure").when(n <= 8, "lookup").otherwise("answer").alias("tool"),
        F.to_json(F.struct("text", n.alias("words"), turn.alias("turn"))).alias("arguments"),
        F.when((back >= 0) & (back < turn), F.array(ident(back))).otherwise(F.array().cast("array<string>")).alias("refs"),
    )
    results = turns.where(F.col("role") == "assistant").select(
        "conv_id",
        F.when(turn.isNotNull(), ident(turn - 1)).alias("call_id"),
        turn.alias("pos"),
        F.col("text").alias("content"),
    )
    return calls, results


@query("op4_tool_call_linking")
def _tool_calls(spark, table):
    """Calls and results of all conversations, linked, ordered and validated."""
    calls, results = chat_calls(table("conversations"))
    return tool_calls.link(calls, results, TOOLS)


@query("op9_sampled_segmentations")
def _segmentations(spark, table):
    """Sampled segmentations of all documents and of all turns of all conversations."""
    documents = segmentation.sampled_segmentations(table("documents"), ["doc_id"])
    return documents.unionByName(segmentation.sampled_segmentations(table("conversations"), ["conv_id", "turn"]))


DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
dense AS (SELECT g.lang, g.source, k.term, k.lang_n, coalesce(c.n, 0) AS n
          FROM grp g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
tot AS (SELECT lang, source, sum(n) AS total FROM dense GROUP BY ALL),
p AS (SELECT dense.*, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS p,
        1 + (1000000000::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v) AS q
      FROM dense JOIN tot USING (lang, source) JOIN langs USING (lang)),
apart AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source),
over AS (SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value,
             (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER AS rank FROM pairs
           UNION ALL
           SELECT lang, source, 'term', item, value,
             (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INTEGER FROM over)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query("op11_source_divergence", DIVERGENCE_SQL)
def _divergence(spark, table):
    """Word use of every two sources of a language, and the words a source prefers."""
    return divergence.audit(table("documents"))


@query("op12_secret_scans")
def _secrets(spark, table):
    """Parts of credentials in all documents."""
    count = secret_scan.count_of
    return secret_scan.scan(table("documents")).select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secret_scan.written(secret_scan.base_spans()), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
        F.size("credentials").cast("long").alias("n_credentials"),
    )


MIDDLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t,
             sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT k, doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS ls, ('0x' || h[1:8])::BIGINT AS h1,
        ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(ls) AS n, least(h1 % (len(ls) + 1), h2 % (len(ls) + 1)) AS a, greatest(h1 % (len(ls) + 1), h2 % (len(ls) + 1)) AS b FROM u),
p AS (SELECT doc_id, t, n, h3, h4, array_to_string(ls[1:a], '') AS pre, array_to_string(ls[a + 1:b], '') AS mid,
        array_to_string(ls[b + 1:], '') AS suf FROM c),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
        WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
         ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM f
"""


@query("op13_fill_in_middle", MIDDLE_SQL)
def _fill_in_middle(spark, table):
    """All documents with their middle put last."""
    return fill_middle.transform(table("documents")).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(), 256).alias("restored_sha256"),
    )


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def _pipeline(spark, table):
    """All documents through every stage of the corpus pipeline."""
    return corpus_pipeline.run(spark, table.folder)
