"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm import ann, htmltext, jaccard, langid, license, lmscore, mixing, packing, spelling, tokencount, toolcalls, topk, \
    turntrie
from ledgerline.llm.util import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn=None, *, sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return register if fn is None else register(fn)


@query(sql=r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) || md5(coalesce(text, '')) AS key
  FROM documents),
per_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS s_rank FROM per_source),
weighted AS (SELECT *, [5, 2, 1][((s_rank - 1) % 3) + 1] AS weight, 3 * source_size AS cap FROM ranked),
reach AS (SELECT *, cap::DOUBLE / weight AS reach FROM weighted),
levels AS (
  SELECT *, row_number() OVER w AS turn,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY reach, s_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(weight) OVER (ORDER BY reach, s_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM reach WINDOW w AS (ORDER BY reach, s_rank)),
final AS (SELECT arg_min(level, turn) AS final FROM levels WHERE level <= reach),
targets AS (SELECT source, s_rank, source_size, least(cap::DOUBLE, weight * final) AS target FROM levels, final),
queued AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM sized WHERE size > 0),
copies AS (
  SELECT q.source, t.s_rank, e.epoch, q.key, q.size, (q.upto + e.epoch * t.source_size)::DOUBLE / t.target AS finish
  FROM queued q JOIN targets t ON q.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1), (2)) e(epoch)
  WHERE q.upto + e.epoch * t.source_size - q.size < t.target),
running AS (
  SELECT *, sum(size) OVER (ORDER BY finish, s_rank, epoch, key ROWS UNBOUNDED PRECEDING) AS upto FROM copies),
cuts AS (
  SELECT source, epoch, max(key) AS last FROM running
  WHERE upto <= (SELECT sum(size) FROM sized) GROUP BY source, epoch)
SELECT d.doc_id, d.size, t.source_size, t.target,
       (CASE WHEN d.size > 0 THEN d.size * (SELECT count(*) FROM cuts c
          WHERE c.source IS NOT DISTINCT FROM d.source AND c.last >= d.key) ELSE 0 END)::BIGINT AS taken
FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
""")
def op5_mix_sources(spark, sf_dir):
    """Documents with the words a 5:2:1 mix of their sources takes of each."""
    mix = mixing.plan(table(spark, sf_dir, "documents"))
    return mixing.decided(mix).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


_USABLE = """
vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)"""


@query(sql=f"""
WITH {_USABLE},
whole AS (SELECT vec_id, [floor(256 * x) FOR x IN v] AS v FROM vectors),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
""")
def op7_exact_top_k(spark, sf_dir):
    """The 5 highest whole-number inner products of every 50th vector with all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


@query
def op9_nearest_neighbours(spark, sf_dir):
    """The 10 nearest found of every 100th vector among all others."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query
def op10_best_fit_packing(spark, sf_dir):
    """All documents as token pieces in sequences of at most 4096."""
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op1_language_id(spark, sf_dir):
    """The language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(langid.labelled_rows(docs))
    rows = docs.select("doc_id", "text", langid.held_out(F.col("doc_id")).alias("held_out"))
    return langid.identify(rows, model).drop("text")


@query
def op6_jaccard_classes(spark, sf_dir):
    """The connected class of every document under Jaccard 0.9 of its word 3-grams."""
    return jaccard.linked_classes(table(spark, sf_dir, "documents"), 3, 90, 100).select(
        "doc_id", "n_shingles", "component_id")


@query
def op2_license_scan(spark, sf_dir):
    """Licence notices found in the documents."""
    return license.scan(table(spark, sf_dir, "documents"))


_CHAT_TOOLS = ("system", "user")


@query(sql="""
WITH RECURSIVE turns AS (
  SELECT conv_id, turn, role, text, role IN ('system', 'user') AS is_call FROM conversations),
calls AS (SELECT conv_id, turn, role, text FROM turns WHERE is_call),
levels AS (
  SELECT conv_id, turn, 0 AS level FROM calls c
  WHERE turn < 2 OR NOT EXISTS (SELECT 1 FROM calls d WHERE d.conv_id = c.conv_id AND d.turn = c.turn - 2)
  UNION ALL
  SELECT c.conv_id, c.turn, l.level + 1 FROM levels l JOIN calls c ON c.conv_id = l.conv_id AND c.turn = l.turn + 2),
results AS (SELECT conv_id, turn, text FROM turns WHERE role = 'assistant'),
linked AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn) AS turn, l.level,
         'c' || coalesce(c.turn, r.turn - 1) AS call_id, c.role AS name, c.text AS asked, r.text AS content,
         c.turn IS NULL AS no_call, r.turn IS NULL AS no_result, c.turn >= 2 AND l.level = 0 AS unmet
  FROM calls c JOIN levels l USING (conv_id, turn)
  FULL JOIN results r ON r.conv_id = c.conv_id AND r.turn = c.turn + 1),
stated AS (
  SELECT *, CASE WHEN no_call THEN 'result without call' WHEN no_result THEN 'call without result'
                 WHEN unmet OR asked IS NULL THEN 'invalid' ELSE 'ok' END AS status FROM linked)
SELECT conv_id, turn, level, call_id, 'call' AS kind, status,
       '{"arguments":' || CASE WHEN no_call THEN 'null' WHEN asked IS NULL THEN '{"turn":' || turn || '}' ELSE
         '{"text":' || to_json(asked)::VARCHAR || ',"turn":' || turn || '}' END
       || ',"content":' || coalesce(to_json(content)::VARCHAR, 'null') || ',"id":"' || call_id || '","name":'
       || coalesce('"' || name || '"', 'null') || ',"status":"' || status || '","trouble":['
       || CASE WHEN NOT no_call AND asked IS NULL THEN '"missing text"' ELSE '' END
       || CASE WHEN NOT no_call AND asked IS NULL AND unmet THEN ',' ELSE '' END
       || CASE WHEN unmet THEN '"unknown dependency c' || (turn - 2) || '"' ELSE '' END || ']}' AS line
FROM stated
UNION ALL
SELECT conv_id, turn, 0, NULL, 'message', 'ok',
       '{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"role":' || coalesce(to_json(role)::VARCHAR, 'null') || '}'
FROM turns WHERE role IS NULL OR role NOT IN ('system', 'user', 'assistant')
""")
def op3_link_tool_calls(spark, sf_dir):
    """All conversations as linked, ordered, validated canonical JSON lines.

    Tool calls written in the messages are linked as such.  Of the other
    messages, a system or user message is a call of the tool of that name (its
    text and turn the arguments, depending on the call two turns before) and
    an assistant message is the result of the call one turn before.
    """
    plain, calls, results = toolcalls.messages_of(table(spark, sf_dir, "conversations"))
    asked, answer = F.col("role").isin(*_CHAT_TOOLS), F.col("role") == "assistant"
    calls = calls.union(plain.where(asked).select(
        "conv", "turn", F.concat(F.lit("c"), "turn"), "role", F.to_json(F.struct("text", "turn")),
        F.when(F.col("turn") >= 2, F.array(F.concat(F.lit("c"), F.col("turn") - 2)))))
    results = results.union(plain.where(answer).select("conv", "turn", F.concat(F.lit("c"), F.col("turn") - 1), "text"))
    kind = F.create_map(F.lit("text"), F.struct(F.lit("string").alias("type"), F.lit(True).alias("required")),
                        F.lit("turn"), F.struct(F.lit("integer").alias("type"), F.lit(True).alias("required")))
    schemas = spark.range(len(_CHAT_TOOLS)).select(
        F.element_at(F.array(*map(F.lit, _CHAT_TOOLS)), (F.col("id") + 1).cast("int")).alias("name"), kind.alias("parameters"))
    rest = plain.where(~F.coalesce(asked | answer, F.lit(False)))
    return toolcalls.lines(rest, toolcalls.linked(calls, results, schemas)) \
        .withColumnRenamed("conv", "conv_id").orderBy("conv_id", "turn", "level", "kind", "call_id")


@query
def op4_main_text(spark, sf_dir):
    """The article text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltext.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op8_token_counts(spark, sf_dir):
    """Tokens of every document, counted between the separators of flat token files."""
    return tokencount.count_documents(table(spark, sf_dir, "documents"))


#: crc32 of a list of bytes as unsigned number, in SQL: a table of 256 steps, then one step a byte.
_CRC_TABLE = """
crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z:
    CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS steps
  FROM (SELECT unnest(range(256))::BIGINT AS i))"""
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], {bytes}), lambda a, b:
    xor(a >> 8, steps[(xor(a, b) & 255) + 1])), 4294967295)"""


@query(sql=rf"""
WITH {_CRC_TABLE},
turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
named AS (
  SELECT conv_id, turn, sha256(strlen(role)::VARCHAR || ':' || role || text)[1:32] AS id,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM turns),
words AS (SELECT id, any_value(words) AS words FROM named GROUP BY id),
own AS (SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids FROM named GROUP BY conv_id),
dealt AS (
  SELECT o.conv_id, o.ids, b.ids AS base,
         {_CRC.format(bytes="[ord(x)::BIGINT FOR x IN string_split(o.conv_id::VARCHAR, '')]")} % 4 AS h
  FROM crc_table, own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
rebuilt AS (SELECT conv_id, list_concat(coalesce(base[1:h], []), ids[h + 1:]) AS ids FROM dealt),
steps AS (SELECT conv_id, ids, unnest(range(len(ids) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT array_to_string(ids[1:depth], '') AS p, any_value(ids[1:depth]) AS ids, depth, min(conv_id) AS conv_id,
         count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len(ids)), '')) AS ends
  FROM steps GROUP BY p, depth),
kids AS (SELECT array_to_string(ids[1:depth - 1], '') AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
worth AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * w.words END AS saved
  FROM nodes n LEFT JOIN kids k USING (p) LEFT JOIN words w ON w.id = n.ids[n.depth]),
above AS (SELECT *, unnest(range(depth + 1)) AS top FROM worth),
sums AS (
  SELECT array_to_string(ids[1:top], '') AS p, sum(saved)::BIGINT AS saved_tokens,
         count(*) FILTER (n_children = 0)::BIGINT AS n_leaves
  FROM above GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens,
       n.ends AS ends_sha256
FROM worth n JOIN sums s USING (p)
LEFT JOIN nodes u ON n.depth > 0 AND u.p = array_to_string(n.ids[1:n.depth - 1], '')
""")
def op11_turn_trie(spark, sf_dir):
    """Every node of the prefix trie of all rebuilt conversations."""
    return turntrie.trie(table(spark, sf_dir, "conversations"))


@query
def op12_spelling_variants(spark, sf_dir):
    """Words of all documents with the far more frequent word one edit away."""
    return spelling.group_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op13_lm_scores(spark, sf_dir):
    """Language-model scores of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = lmscore.held_out(F.col("doc_id"))
    return lmscore.score(docs, ~fold).withColumn("held_out", fold).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
