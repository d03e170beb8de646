"""The operators over the benchmark's tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import (
    curriculum, embedding_dedup, hard_negatives, html_extract, hyperminhash, line_dedup, packing, pii, quality_rules, sharding, spelling,
    suffix_dedup, toxicity,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql.strip()
        return function
    return add


@query("op6_quality_rules", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS win
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
            FROM (SELECT *, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
             length(regexp_replace(text, '[^!]+', '', 'g')) AS n_bang, len(lines) AS n_lines
      FROM w LEFT JOIN covered c ON w.doc_id = c.doc_id),
f AS (SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT
                     + 4 * (10 * n_symbols > n_words)::INT + 8 * (5 * n_bang > n_words)::INT
                     + 16 * (word_chars > 40 * n_words)::INT + 32 * (2 * n_dup_lines > n_lines)::INT AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & 3 <> 0 AS base_failed, failed & 31 = 0 AS kept, failed FROM f
""")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes("v1")).alias("base_failed"), quality_rules.passes("v2").alias("kept"), "failed")


@query("op4_curriculum_mix", r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS w, 3 * source_size AS most FROM s),
o AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS weights,
             coalesce(sum(most) OVER (ORDER BY most / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS given,
             coalesce(sum(w) OVER (ORDER BY most / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM n),
c AS (SELECT *, (total - given) * w > most * (weights - used) AS stops FROM o),
l AS (SELECT *, sum(CASE WHEN stops THEN most ELSE 0 END) OVER () AS full_size,
             sum(CASE WHEN stops THEN 0 ELSE w END) OVER () AS open_weight FROM c),
t AS (SELECT source, source_size, w, CASE WHEN stops THEN CAST(most AS DOUBLE) WHEN open_weight > 0
             THEN CAST(total - full_size AS DOUBLE) / CAST(open_weight AS DOUBLE) * w ELSE 0 END AS target FROM l),
r AS (SELECT doc_id, source, size, CAST(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS ahead FROM d),
p AS (SELECT r.doc_id, r.size, t.source_size, t.target, t.w, r.ahead,
             CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS passes
      FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, greatest(0, least(size, CAST(floor(target) AS BIGINT) - passes * source_size - ahead)) AS part FROM p),
y AS (SELECT *, CAST(passes * size + part AS BIGINT) AS taken, CASE WHEN passes * size + part > 0
             THEN least(1.0, (ahead + (CASE WHEN passes > 0 THEN size ELSE part END) / 2) / target) END AS share FROM x)
SELECT doc_id, size, source_size, target, taken, CASE WHEN share IS NOT NULL THEN round(CASE w
         WHEN 1 THEN least(1.0, 2 * share / (1.5 + sqrt(greatest(2.25 - 2 * share, 0))))
         WHEN 2 THEN least(1.0, share)
         WHEN 3 THEN CASE WHEN share < 0.375 THEN least(0.5, 2 * share / (0.5 + sqrt(0.25 + 2 * share)))
                          ELSE least(1.0, 0.5 + 2 * (share - 0.375) / (1 + sqrt(1 + 2 * (share - 0.375)))) END END, 9) END AS position
FROM y
""")
def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in training order, by the moment it is first trained on; those not taken come last."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows = curriculum.taken(curriculum.placed(docs, carry=False))
    return curriculum.in_order(rows, F.col("position").asc_nulls_last(), "doc.doc_id").select(
        "doc.doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


@query("op4_curriculum_order")
def op4_curriculum_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every time that op4_curriculum_mix takes a document, in training order: pass, words taken and moment in [0, 1]."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows = curriculum.drawn(curriculum.taken(curriculum.placed(docs, carry=False)))
    return curriculum.in_order(rows, "_moment", "doc.doc_id", "_pass").select(
        "doc.doc_id", "source", F.col("_pass").cast("long").alias("pass"), F.col("_words").alias("words"), F.col("_moment").alias("position"))


@query("op1_line_dedup", r"""
WITH l AS (SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i,
                  unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
b AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(b.key) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN b.key IS NULL THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM k LEFT JOIN b ON k.key = b.key GROUP BY k.doc_id
""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs, min_docs=10).select(
        "doc.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query("op10_hyperminhash", r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT r.x AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.y) AS component_id, r.x = min(r.y) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.x GROUP BY r.x
""")
def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hyperminhash.near_duplicates(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


@query("op3_suffix_array_dedup")
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs, length=200).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_embedding_near_dedup", r"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, e, len(e) AS n FROM v WHERE len(list_filter(e, lambda x: isfinite(x))) = len(e) AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.n = b.n AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT r.x AS vec_id, CAST(coalesce(any_value(c.n), 0) AS BIGINT) AS n_links, min(r.y) AS component_id, r.x = min(r.y) AS kept
FROM r LEFT JOIN c ON c.x = r.x GROUP BY r.x
""")
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).withColumnRenamed("id", "vec_id")


@query("op8_html_extract")
def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extracted(pages).select(
        "page.page_id", "page.url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op2_pii_spans")
def op2_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col("id").alias("doc_id"), *[count(k) for k in pii.BASE],
                        F.sha2(named(F.col("base")), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))


SHARDS = [f"shard-{i:03d}" for i in range(64)]


@query("op9_lookup_sharding")
def op9_lookup_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.placed(docs, SHARDS, carry=False).select("doc.doc_id", "slot", "shard")


def one_letter_lost(doc_id: Column, run: Column) -> Column:
    """The run, without one of its characters where 31 divides the checksum of the document and the run."""
    h = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % 31 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


@query("op12_spelling_variants", r"""
WITH RECURSIVE t AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all(
                     translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
r AS (SELECT d, run, count(*) AS n, hex(encode(d || ':' || run)) AS x FROM t WHERE length(run) >= 7 GROUP BY d, run),
h AS (SELECT run, n, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(range(1, length(x), 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, list_reduce([xor(c, b) & 255, 0, 0, 0, 0, 0, 0, 0, 0],
                                             lambda e, z: xor(e >> 1, 3988292384 * (e & 1)))))) AS h FROM r),
w AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
g AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
p AS (SELECT a.word AS x, b.word AS y, b.n FROM g a JOIN g b ON a.i = b.i AND length(a.word) = length(b.word) AND a.word <> b.word
             AND substr(a.word, 1, a.i - 1) = substr(b.word, 1, b.i - 1) AND substr(a.word, a.i + 1) = substr(b.word, b.i + 1)
      UNION SELECT g.word, v.word, v.n FROM g JOIN v ON v.word = substr(g.word, 1, g.i - 1) || substr(g.word, g.i + 1)
      UNION SELECT v.word, g.word, g.n FROM g JOIN v ON v.word = substr(g.word, 1, g.i - 1) || substr(g.word, g.i + 1)),
b AS (SELECT x, count(*) AS n_near, min(struct_pack(n := -n, y := y)) AS best FROM p GROUP BY x),
f AS (SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN -best.n >= 10 * v.n THEN best.y END AS form,
             CASE WHEN -best.n >= 10 * v.n THEN -best.n END AS form_n FROM v LEFT JOIN b ON b.x = v.word),
c AS (SELECT word, word AS root, form AS nxt FROM f UNION ALL SELECT c.word, f.word, f.form FROM c JOIN f ON f.word = c.nxt)
SELECT f.word, f.form, c.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM f JOIN c ON c.word = f.word AND c.nxt IS NULL
""")
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = spelling.words(table(spark, sf_dir, "documents").select("doc_id", "text"), least=7, altered=one_letter_lost)
    return spelling.variants(counted.where("n >= 2"), least=7)


@query("op13_hard_negatives", r"""
WITH d AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, CAST(embedding AS DOUBLE[]) AS e
           FROM embeddings WHERE vec_id IS NOT NULL),
v AS (SELECT DISTINCT vec_id, label, list_transform(e, lambda x: CAST(floor(256 * x) AS BIGINT)) AS e FROM d
      WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: isfinite(x))) = len(e)),
a AS (SELECT row_number() OVER () AS a, * FROM v WHERE vec_id % 100 = 0),
s AS (SELECT a.a, a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
             CAST(list_sum(list_transform(range(1, len(v.e) + 1), lambda i: a.e[i] * v.e[i])) AS BIGINT) AS score
      FROM a JOIN v ON len(a.e) = len(v.e) AND NOT (a.vec_id = v.vec_id AND a.label = v.label AND a.e = v.e)),
p AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS place FROM s WHERE same QUALIFY place <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.place ORDER BY n.score DESC, n.vec_id) AS INT) AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives.mine(rows, F.col("id") % 100 == 0, positives=5, negatives=5, low=80, scale=256)


@query("op11_toxicity")
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.language_model(docs)
    classifier = toxicity.fit(docs, table(spark, sf_dir, "labels"), model, ~toxicity.held_out(F.col("id")))
    return toxicity.scored(docs, classifier, model, carry=["doc_id"]).select(
        "doc.doc_id", toxicity.held_out(F.col("doc.doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.array_join("traits", ",").alias("traits"))
