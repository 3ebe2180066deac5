"""The registered queries ``opN_<name>``: each applies its operator with its
production parameters to its whole table, and shapes the rows it is asked for.
``ORACLE_SQL`` has the DuckDB twin of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import chat, classify, decontam, exact, mixing, mixture, repeats, simhash, trie, variants, warc
from .common import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ------------------------------------------------------------------ mixing

@query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = mixing.mix_copies(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2.0)
    return d.select("doc_id", "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken"))


def mix_sql(documents: str, extra: str = "") -> str:
    """The draw over the table expression ``documents``: rows with ``copies``."""
    dig = lambda v, a: f"CAST('0x' || substr(md5({v}), {a}, 8) AS BIGINT)"
    return f"""
WITH RECURSIVE docs AS (SELECT * FROM {documents}),
rows AS (
  SELECT doc_id, source{extra}, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         coalesce(CAST(doc_id AS VARCHAR), 'null') AS idt FROM docs),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3.0, 1.0, 2.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1]::DOUBLE AS w
  FROM rows GROUP BY source),
need AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, sum(source_size) OVER () * 1.5::DOUBLE
           - coalesce(sum(2.0::DOUBLE * source_size) OVER b, 0) AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS w_rest
  FROM src WINDOW b AS (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lvl AS (SELECT min_by(rest / w_rest, cap / w) AS v FROM need WHERE cap > rest / w_rest * w),
tgt AS (SELECT source, source_size, CASE WHEN v IS NULL THEN cap ELSE least(cap, v * w) END AS target
        FROM need CROSS JOIN lvl),
ranked AS (
  SELECT r.*, t.source_size, t.target, CAST(row_number() OVER (
           PARTITION BY r.source ORDER BY
             length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)),
             {dig('idt', 1)} % 32, size, md5(idt), doc_id) AS DOUBLE) AS rk,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS r_,
         {dig("'mix/' || coalesce(r.source, 'null')", 1)} / 4294967296.0::DOUBLE AS u
  FROM rows r JOIN tgt t ON r.source IS NOT DISTINCT FROM t.source)
SELECT *, CAST(floor(r_ * rk + u) - floor(r_ * (rk - 1.0::DOUBLE) + u) AS BIGINT) AS copies FROM ranked"""


ORACLE_SQL["op5_mix_sources"] = f"""
SELECT doc_id, size, source_size, target, copies * size AS taken FROM ({mix_sql('documents')}) m"""


# ------------------------------------------------------------------ web archive

@query
def op6_web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archive = warc.write_archive(pages, scratch_path(spark, "warc"), min_revisit_bytes=100)
    return warc.read_pages(spark, archive).select(
        "page_id", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", "refers_to")


ORACLE_SQL["op6_web_archive"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
             min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM q"""


# ------------------------------------------------------------------ exact dedup

@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    verdict = exact.exact_groups(docs)
    # the digest of rows whose whole text the operator had no need to read
    t = F.coalesce("text", F.lit(""))
    digests = docs.select(F.col("doc_id").alias("_id"), F.octet_length(t).alias("_len"),
                          exact.prefix_hash("text").alias("_pre"), F.sha2(t, 256).alias("text_sha256")).distinct()
    several = verdict.filter("full_hash IS NOT NULL").withColumn("text_sha256", F.col("full_hash"))
    alone = verdict.filter("full_hash IS NULL").join(
        digests, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_len") == F.col("_len"))
        & (F.col("prefix_hash") == F.col("_pre")))
    out = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return several.select(*out).unionByName(alone.select(*out))


ORACLE_SQL["op8_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))"""


# ------------------------------------------------------------------ chat

@query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(hard).alias("text"))
    back = chat.read_chat(chat.format_chat(chat.to_turns(rows.unionByName(extra))))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                       F.sha2(told, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("bigint").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("bigint").alias("formatted_chars"))


def _escape_sql(x: str) -> str:
    out = f"replace({x}, '\\', '\\\\')"
    for c in chat.CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


ORACLE_SQL["op10_chat_format"] = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(length({_escape_sql('role')}) + length({_escape_sql('text')}) + {len(chat.BEGIN + chat.MIDDLE + chat.END)}) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""


# ------------------------------------------------------------------ near dedup

@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, radius=2, seed=42)
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# ------------------------------------------------------------------ decontamination

@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# ------------------------------------------------------------------ classifiers

def _verdicts(scored: DataFrame, parts: int, held: int, cut: float) -> DataFrame:
    held_out = F.coalesce(classify.remainder("doc_id", parts) == held, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= cut).cast("int").alias("predicted"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    train = classify.training_labels(table(spark, sf_dir, "labels"), "toxic", 4, 2)
    return _verdicts(classify.score_toxic(docs, classify.fit_toxic(docs, train)), 4, 2, 0.3)


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    train = classify.training_labels(table(spark, sf_dir, "labels"), "quality", 3, 1)
    return _verdicts(classify.score_quality(docs, classify.fit_ranking(docs, train)), 3, 1, 0.5)


# ------------------------------------------------------------------ languages

@query
def op12_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(classify.remainder("doc_id", 3) == 1, F.lit(False))
    model = mixture.fit_languages(docs.filter(classify.remainder("doc_id", 3) != 1))
    return mixture.score_languages(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages")


# ------------------------------------------------------------------ substrings

@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = repeats.remove_repeated_words(table(spark, sf_dir, "documents"))
    return r.select("doc_id", F.col("n").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = repeats.remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return r.select("doc_id", F.col("n").alias("n_bytes"), "n_removed",
                    F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


# spans of hits ``i`` (windows of ``n`` symbols) per document: hits that overlap or touch
_SPANS = """
isl AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (
  SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {n} THEN 1 ELSE 0 END AS new FROM hit) h),
span AS (SELECT doc_id, min(i) AS a, max(i) + {n} AS z FROM isl GROUP BY doc_id, g),
gap AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span)"""

ORACLE_SQL["op2_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, t.i, array_to_string(w[t.i + 1:t.i + 35], ' ') AS k FROM d, unnest(range(0, len(w) - 34)) t(i)),
rep AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM win WHERE k IN (SELECT k FROM rep)), {_SPANS.format(n=35)},
cut AS (SELECT g.doc_id, sum(z - a) AS gone, max(z) AS last, flatten(list(w[before + 1:a] ORDER BY a)) AS head
        FROM gap g JOIN d ON g.doc_id = d.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_concat(coalesce(head, []), w[coalesce(last, 0) + 1:]), ' ')) AS kept_sha256
FROM d LEFT JOIN cut c ON d.doc_id = c.doc_id"""

ORACLE_SQL["op9_byte_dedup"] = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, t.i, substr(h, 2 * t.i + 1, 100) AS k FROM d, unnest(range(0, length(h) // 2 - 49)) t(i)),
low AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
hit AS (SELECT doc_id, i FROM win JOIN low ON win.k = low.k AND m < doc_id), {_SPANS.format(n=50)},
cut AS (SELECT g.doc_id, sum(z - a) AS gone, count(*) AS n, max(z) AS last,
               string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
        FROM gap g JOIN d ON g.doc_id = d.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
       coalesce(n, 0) AS n_spans, sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut c ON d.doc_id = c.doc_id"""


# ------------------------------------------------------------------ conversation trie

@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation c takes its first h turns, h = crc32(c) % 9, from conversation
    c - c % 5. Those five are dealt together, so the rebuilding needs no second exchange."""
    rows = table(spark, sf_dir, "conversations")
    own = F.col("conv_id")
    convs = trie.conversation_turns(rows, by=own - own % 5)
    first = F.max(F.when(F.col("conv_id") == F.col("near"), F.slice("turns", 1, 8))).over(Window.partitionBy("near"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    built = convs.withColumn("first", F.coalesce(first, F.array().cast("array<string>"))).withColumn("h", h).select(
        "conv_id", trie.path(F.concat(F.expr("slice(first, 1, h)"), F.expr("slice(turns, h + 1, size(turns))"))).alias("path"))
    return trie.prefix_trie(built)


#: CRC-32 of an ASCII string expression, bit by bit.
CRC_SQL = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({x}, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT)"""

ORACLE_SQL["op13_conversation_trie"] = f"""
WITH r AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, turn, role, CAST(strlen(text) AS BIGINT) AS bytes,
             substr(sha256(strlen(role) || ':' || role || text), 1, 32) || lower(lpad(printf('%x', strlen(text)), 16, '0')) AS token FROM r),
t AS (SELECT c, token, bytes, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, token) AS pos FROM k),
ids AS (SELECT c, c - c % 5 AS base, {CRC_SQL.format(x="CAST(c AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT c FROM r) x),
built AS (SELECT i.c, pos, token, bytes FROM ids i JOIN t ON t.c = i.base AND pos <= h
          UNION ALL SELECT i.c, pos, token, bytes FROM ids i JOIN t ON t.c = i.c AND pos > h),
seq AS (SELECT i.c, coalesce(list(token ORDER BY pos) FILTER (token IS NOT NULL), []) AS s,
               coalesce(list(bytes ORDER BY pos) FILTER (token IS NOT NULL), []) AS z
        FROM ids i LEFT JOIN built b ON i.c = b.c GROUP BY i.c),
pre AS (SELECT c, d.d AS depth, len(s) AS n, sha256(array_to_string(s[1:d.d], '')) AS key,
               sha256(array_to_string(s[1:greatest(d.d - 1, 0)], '')) AS up,
               CASE WHEN d.d = 0 THEN 0 ELSE z[d.d] END AS bytes FROM seq, unnest(range(0, len(s) + 1)) d(d)),
node AS (SELECT key, depth, any_value(up) AS up, any_value(bytes) AS bytes, min(c) AS conv_id, count(*) AS n_convs,
                sha256(coalesce(string_agg(CASE WHEN n = depth THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends_sha256
         FROM pre GROUP BY key, depth),
kids AS (SELECT up AS key, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY up),
below AS (SELECT DISTINCT a.key AS top, b.key FROM pre a JOIN pre b ON a.c = b.c AND a.depth <= b.depth),
sub AS (SELECT top, CAST(sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
               CAST(sum((n_convs - 1) * bytes) AS BIGINT) AS saved_tokens
        FROM below JOIN node ON below.key = node.key LEFT JOIN kids ON kids.key = node.key GROUP BY top)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, CASE WHEN node.depth > 0 THEN p.conv_id END AS parent_conv_id, node.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, node.ends_sha256
FROM node LEFT JOIN node p ON node.up = p.key LEFT JOIN kids ON kids.key = node.key JOIN sub ON sub.top = node.key"""


# ------------------------------------------------------------------ spelling variants

@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = variants.count_runs(table(spark, sf_dir, "documents"), least=5, every=97)
    return variants.variant_forms(runs.filter("n >= 3"), factor=2, least=5)


ORACLE_SQL["op11_spelling_variants"] = """
WITH RECURSIVE tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                 lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
run AS (SELECT doc_id, w, count(*) AS k FROM (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-z\\x{00C0}-\\x{00FF}]+')) AS w FROM documents) x
  WHERE length(w) >= 5 GROUP BY ALL),
crc AS (SELECT w, k, CASE WHEN doc_id IS NULL THEN 1 ELSE xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(regexp_replace(hex(encode(doc_id || ':' || w)), '(..)', '\\1 ', 'g'), ' ')[:-2],
                lambda c: CAST('0x' || c AS BIGINT))),
    lambda a, b: xor(t[CAST(xor(a, b) & 255 AS INT) + 1], a >> 8)), 4294967295::BIGINT) END AS h FROM run, tab),
word AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
  SELECT k, CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS INT)) || substr(w, CAST(h % length(w) AS INT) + 2) ELSE w END AS word
  FROM crc) y WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
hole AS (SELECT word, n, p.i, substr(word, 1, p.i - 1) AS a, substr(word, p.i + 1) AS b FROM word, unnest(range(1, length(word) + 1)) p(i)),
pair AS (SELECT x.word, y.word AS other FROM hole x JOIN hole y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
         UNION SELECT h.word, w.word FROM hole h JOIN word w ON h.a || h.b = w.word
         UNION SELECT w.word, h.word FROM hole h JOIN word w ON h.a || h.b = w.word),
best AS (SELECT pair.word, CAST(count(*) AS BIGINT) AS n_near, max(o.n) AS top_n,
                arg_min(o.word, (-o.n, o.word)) AS top FROM pair JOIN word o ON pair.other = o.word GROUP BY pair.word),
form AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 2 * w.n THEN top END AS form,
                CASE WHEN top_n >= 2 * w.n THEN top_n END AS form_n FROM word w LEFT JOIN best b ON w.word = b.word),
chain AS (SELECT word, word AS at FROM word
          UNION ALL SELECT c.word, f.form FROM chain c JOIN form f ON c.at = f.word WHERE f.form IS NOT NULL),
root AS (SELECT c.word, c.at AS root FROM chain c JOIN form f ON c.at = f.word WHERE f.form IS NULL)
SELECT f.word, form, root, n, n_near, form_n FROM form f JOIN root r ON f.word = r.word"""
