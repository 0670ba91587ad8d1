"""Registered queries of this package and their SQL counterparts."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from eventmart.llm import bpe, codebooks, decontam, hilbert, language, licenses, lines, packing, pii, prefixes, sharding, simhash, topk
from eventmart.llm.common import table

SHARDS = 16


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = language.fit(docs.where(rest != 2))
    held_out = F.coalesce(rest == 2, F.lit(False)).alias("held_out")
    guessed = docs.select("doc_id", held_out, language.predict(docs, model).alias("guess"))
    return guessed.select("doc_id", "held_out", "guess.lang_pred", "guess.score")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op3_hilbert_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


def op4_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit("")).cast("binary")
    narrow = docs.select("doc_id", (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    dealt = sharding.shuffle_into_shards(narrow, SHARDS, seed=20)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = bpe.with_round_trip(docs, "text", public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "made")
    return made.select("doc_id", "made.*")


def op6_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op7_simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "text")


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64)
    return topk.exact_top_k(vectors, F.col("id") % 20 == 0, 20)


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.drop("spans").withColumnRenamed("spans_text", "spans")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", items, "contaminated")


def op13_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebooks.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_license_scan,
        op3_hilbert_nearest,
        op4_uniform_shards,
        op5_bpe_round_trip,
        op6_best_two_fit,
        op7_simhash_classes,
        op8_line_runs,
        op9_exact_top_k,
        op10_personal_data,
        op11_prefix_trie,
        op12_decontamination,
        op13_codebooks,
    )
} | {"pipeline": corpus_pipeline.run}

_OP8 = """
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS spot
  FROM documents
),
numbered AS (
  SELECT doc_id, spot, line, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS body,
         sum(CASE WHEN trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> '' THEN 1 ELSE 0 END)
           OVER (PARTITION BY doc_id ORDER BY spot) AS seq
  FROM split
),
lined AS (
  SELECT doc_id, seq, body, len(string_split_regex(body, '[ \\t\\x0B\\x0C\\r]+')) AS words FROM numbered WHERE body <> ''
),
summed AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY seq) AS upto FROM lined),
ranges AS (
  SELECT a.doc_id, a.seq AS first, min(b.seq) AS last FROM summed a JOIN summed b
    ON a.doc_id = b.doc_id AND b.seq >= a.seq AND b.upto - a.upto + a.words >= 50 GROUP BY a.doc_id, a.seq
  UNION
  SELECT b.doc_id, max(a.seq), b.seq FROM summed a JOIN summed b
    ON a.doc_id = b.doc_id AND b.seq >= a.seq AND b.upto - a.upto + a.words >= 50 GROUP BY b.doc_id, b.seq
),
told AS (
  SELECT r.doc_id, r.first, r.last, string_agg(l.body, chr(10) ORDER BY l.seq) AS body
  FROM ranges r JOIN lined l ON l.doc_id = r.doc_id AND l.seq BETWEEN r.first AND r.last
  GROUP BY r.doc_id, r.first, r.last
),
copies AS (
  SELECT doc_id, first, last FROM (
    SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, first) AS nth FROM told
  ) WHERE nth > 1
),
gone AS (
  SELECT DISTINCT l.doc_id, l.seq FROM lined l JOIN copies c ON c.doc_id = l.doc_id AND l.seq BETWEEN c.first AND c.last
),
cut AS (
  SELECT n.doc_id, string_agg(n.line, chr(10) ORDER BY n.spot) AS text
  FROM numbered n LEFT JOIN gone g ON g.doc_id = n.doc_id AND g.seq = n.seq WHERE g.seq IS NULL GROUP BY n.doc_id
)
SELECT d.doc_id, coalesce((SELECT count(*) FROM lined l WHERE l.doc_id = d.doc_id), 0)::BIGINT AS n_lines,
       coalesce((SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id), 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(c.text, '') END AS text
FROM documents d LEFT JOIN cut c ON c.doc_id = d.doc_id
"""

_OP9 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT query_id, "rank", vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.v, c.v)::BIGINT AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id)::INT AS "rank"
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
) WHERE "rank" <= 20
"""

# crc32 of a decimal id, bit by bit
_CRC = """
xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)),
      lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)::BIGINT)), 4294967295)
"""

_OP11 = f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS place,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC.format("conv_id")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM own)
),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS d, text,
         sha256(role || '|' || sha256(text)) AS told
  FROM (
    SELECT c.conv_id, 0 AS part, o.place, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.place < c.h
    UNION ALL
    SELECT c.conv_id, 1, o.place, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.place >= c.h
  )
),
paths AS (
  SELECT conv_id, 0 AS depth, '' AS node, NULL AS parent, 0 AS bytes FROM convs
  UNION ALL
  SELECT conv_id, d, sha256(path), CASE WHEN d = 1 THEN '' ELSE sha256(left(path, length(path) - 64)) END, strlen(text) FROM (
    SELECT *, string_agg(told, '') OVER (PARTITION BY conv_id ORDER BY d) AS path FROM turns
  )
),
nodes AS (
  SELECT node, min(depth) AS depth, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes
  FROM paths GROUP BY node
),
children AS (SELECT parent, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT a.node, sum((m.n_convs - 1) * m.bytes)::BIGINT AS saved, count(*) FILTER (WHERE m.node NOT IN (SELECT parent FROM children)) AS leaves
  FROM nodes m JOIN paths a ON a.conv_id = m.conv_id AND a.depth <= m.depth GROUP BY a.node
),
ends AS (
  SELECT p.node, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids
  FROM paths p JOIN (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id) l ON l.conv_id = p.conv_id AND l.depth = p.depth
  GROUP BY p.node
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
       b.leaves AS n_leaves, b.saved AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN below b ON b.node = n.node LEFT JOIN nodes p ON p.node = n.parent
LEFT JOIN children c ON c.parent = n.node LEFT JOIN ends e ON e.node = n.node
"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

_OP12 = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS words FROM documents),
items AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS told
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, least(len(words), 1)) + 1)) AS i FROM items)
),
grams AS (
  SELECT row, n, i, array_to_string(words[i:i + n - 1], ' ') AS told FROM (
    SELECT row, n, words, unnest(range(1, len(words) - n + 2)) AS i
    FROM docs JOIN (SELECT DISTINCT n FROM windows) ON len(words) >= n
  )
),
hits AS (SELECT g.row, g.i, g.n, w.item_id FROM grams g JOIN windows w ON w.n = g.n AND w.told = g.told),
covered AS (
  SELECT row, count(DISTINCT spot) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS spot FROM (SELECT DISTINCT row, i, n FROM hits)) GROUP BY row
),
found AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (row) LEFT JOIN found USING (row)
"""


def _op13() -> str:
    """Four rounds and the last assignment, one after the other."""
    steps = [
        """
whole AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS row, vec_id, label, v FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  )
),
parts AS MATERIALIZED (
  SELECT row, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS x FROM whole, (SELECT unnest(range(4)) AS p)
),
book0 AS MATERIALIZED (SELECT p, row - 1 AS e, x AS c FROM parts WHERE row <= 256)"""
    ]
    for r in range(5):
        steps.append(f"""
told{r} AS MATERIALIZED (
  SELECT row, p, x, min({{'d': d, 'e': e}}) AS best FROM (
    SELECT row, parts.p, x, e, (list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c))::BIGINT AS d
    FROM parts JOIN book{r} ON book{r}.p = parts.p
  ) GROUP BY row, p, x
)""")
        if r < 4:
            steps.append(f"""
book{r + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN (
    SELECT p, e, list(floor((s - ((s % n) + n) % n) / n) ORDER BY i) AS c FROM (
      SELECT p, best.e AS e, i, sum(x[i]::BIGINT)::BIGINT AS s, count(*) AS n
      FROM told{r}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS i) GROUP BY ALL
    ) GROUP BY p, e
  ) m ON m.p = b.p AND m.e = b.e
)""")
    return f"""
WITH {",".join(steps)},
coded AS (
  SELECT w.vec_id, w.label, string_agg(lpad(to_hex(best.e), 2, '0'), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
  FROM told4 t JOIN whole w ON w.row = t.row GROUP BY w.row, w.vec_id, w.label
)
SELECT vec_id, lower(code) AS code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY p, e)) FROM book4) AS codebooks_sha256
FROM coded
"""


ORACLE = {
    "op8_line_runs": _OP8,
    "op9_exact_top_k": _OP9,
    "op11_prefix_trie": _OP11,
    "op12_decontamination": _OP12,
    "op13_codebooks": _op13(),
}
