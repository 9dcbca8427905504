"""Registered queries of the training-data operators, and their DuckDB SQL.

Each query applies its operator to its whole table with production parameters
and derives the digest columns of its contract from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm import decontaminate, divergence, langid, lines, packing, pii, prefix_trie, secrets, simhash, superminhash, toxicity, vectors, warc
from curbline.llm.common import table


TOXIC_FROM = 0.7        # score from which a document counts as toxic


def joined(spans) -> Column:
    """kind:start:end of an array of spans, comma-joined in its order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back through the capture index."""
    directory = warc.write_archive(table(spark, sf_dir, "pages"))
    records = warc.read_records(warc.index_lines(directory))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, base and added spans; ``scores`` stand in the order of ``spans``."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return found.select(
        "doc_id", *[count_kind("spans", k).alias(f"n_{k}") for k in pii.BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"),
        F.col("spans.score").alias("scores"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components: 4-word shingles, at most 4 differing bits."""
    found = simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def id_remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in bins of 512 to 4096 words."""
    return packing.pack_documents(table(spark, sf_dir, "documents")).drop("row_key")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: base spans, and weak parts that are linked."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    return found.select(
        "doc_id", *[count_kind("spans", k).alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, and the numbers of those that repeat a line elsewhere, exactly or nearly."""
    found = lines.duplicate_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
                        F.array_join("removed", ",").alias("removed_lines"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of held-out documents (and null ids) teach nothing."""
    labels = table(spark, sf_dir, "labels").where(id_remainder(3) != 1)
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), labels)
    return scored.select(
        "doc_id", F.coalesce(id_remainder(3) == 1, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
        F.col("evidence.doc_id").alias("evidence"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the share found."""
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.col("item").alias("item_id"), "share", "first_word", "end_word")


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    index = vectors.build_index(table(spark, sf_dir, "embeddings"))
    return vectors.nearest(index, index.where("vec_id % 100 = 0").select("vec_id", "v"), k=10)


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; labels of held-out documents (and null ids) teach nothing."""
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(id_remainder(4) != 2))
    return langid.identify(docs, model).select(
        "doc_id", F.coalesce(id_remainder(4) == 2, F.lit(True)).alias("held_out"), "lang_pred", "score")


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components: 5-word shingles, 85 % of the union in common."""
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85, shingle=5)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every (language, source) is from the language's other sources, and its own words."""
    return divergence.source_divergence(table(spark, sf_dir, "documents"), min_docs=10, top_terms=10)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations' prefixes."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_pii": op2_pii,
    "op3_simhash": op3_simhash,
    "op4_packing": op4_packing,
    "op5_secrets": op5_secrets,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_decontaminate": op8_decontaminate,
    "op9_vectors": op9_vectors,
    "op10_langid": op10_langid,
    "op11_minhash": op11_minhash,
    "op12_divergence": op12_divergence,
    "op13_prefix_trie": op13_prefix_trie,
}

#: An exact search: the codes' bounds lose a true neighbour about once in 10,000 rows.
OP9_SQL = """
WITH fine AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
near AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM fine q JOIN fine c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS "rank", vec_id, score
  FROM near)
SELECT * FROM ranked WHERE "rank" <= 10
"""

#: Exact sets and all pairs that share a shingle; components by closure.
OP11_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS d, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ 	-
]+'), lambda w: w <> '') AS words
  FROM documents),
sets AS (
  SELECT d, doc_id, list_distinct(list_transform(range(1, greatest(len(words) - 3, CAST(len(words) > 0 AS INTEGER) + 1)),
    lambda i: array_to_string(words[i:i + 4], ' '))) AS own FROM docs),
grams AS (SELECT d, len(own) AS n, unnest(own) AS g FROM sets),
links AS (
  SELECT a.d AS x, b.d AS y FROM grams a JOIN grams b ON a.g = b.g
  GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
near AS (SELECT x AS d, x AS y FROM links UNION SELECT near.d, links.y FROM near JOIN links ON near.y = links.x),
low AS (SELECT near.d, min(s.doc_id) AS component_id FROM near JOIN sets s ON s.d = near.y GROUP BY ALL)
SELECT s.doc_id, CAST(len(s.own) AS BIGINT) AS n_shingles, coalesce(low.component_id, s.doc_id) AS component_id,
       coalesce(low.component_id, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN low USING (d)
"""

#: Every group against every kept word, zero counts included, where the query sums sparsely.
OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
found AS (SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM found GROUP BY ALL HAVING count(DISTINCT d) >= 10),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY ALL),
counted AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
own AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n,
         CAST(1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS HUGEINT) AS p
  FROM own JOIN vocabulary USING (lang)),
whole AS (
  SELECT lang, term, CAST(1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS HUGEINT) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM counted GROUP BY ALL) JOIN vocabulary USING (lang)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
bare AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, 0 AS value
  FROM (SELECT DISTINCT lang, source FROM docs) a JOIN (SELECT DISTINCT lang, source FROM docs) b ON a.lang = b.lang AND a.source <> b.source
  WHERE a.lang NOT IN (SELECT lang FROM vocabulary)),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
         CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS "rank"
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM bare UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR "rank" <= 10
"""

#: Every prefix of every rebuilt conversation as a node; subtrees by comparing prefixes.
OP13_SQL = r"""
WITH RECURSIVE turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UBIGINT)) AS bytes FROM turns),
crc AS (
  SELECT c, bytes, 0 AS i, 4294967295::UBIGINT AS v FROM ids
  UNION ALL
  SELECT c, bytes, i + 1, list_reduce(range(8)::UBIGINT[], lambda a, x: xor(a >> 1, 3988292384::UBIGINT * (a & 1)), xor(v, bytes[i + 1]))
  FROM crc WHERE i < len(bytes)),
taken AS (SELECT c, xor(v, 4294967295::UBIGINT) % 6 AS h FROM crc WHERE i = len(bytes)),
both_parts AS (
  SELECT k.c, 0 AS part, t.pos, t.role, t.text FROM taken k JOIN turns t ON t.c = k.c - k.c % 100 AND t.pos <= k.h
  UNION ALL
  SELECT k.c, 1, t.pos, t.role, t.text FROM taken k JOIN turns t ON t.c = k.c AND t.pos > k.h),
rebuilt AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, role, text FROM both_parts),
paths AS (
  SELECT c, CAST(0 AS BIGINT) AS depth, CAST('root' AS VARCHAR) AS node, CAST(NULL AS VARCHAR) AS parent, CAST(0 AS BIGINT) AS chars FROM ids
  UNION ALL
  SELECT p.c, p.depth + 1, md5(concat(p.node, '/', length(r.role), '/', r.role, r.text)), p.node, length(r.text)
  FROM paths p JOIN rebuilt r ON r.c = p.c AND r.d = p.depth + 1),
lengths AS (SELECT c, max(depth) AS last FROM paths GROUP BY c),
nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(p.c) AS conv_id, count(*) AS n, any_value(chars) AS chars,
         sha256(coalesce(string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (depth = last), '')) AS ends
  FROM paths p JOIN lengths USING (c) GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY ALL),
above AS (
  SELECT node AS low, node AS top, parent AS up FROM nodes
  UNION ALL
  SELECT a.low, n.node, n.parent FROM above a JOIN nodes n ON n.node = a.up),
sums AS (
  SELECT a.top AS node, sum((n.n - 1) * n.chars) AS saved, count(*) FILTER (k.n_children IS NULL) AS leaves
  FROM above a JOIN nodes n ON n.node = a.low LEFT JOIN kids k ON k.node = a.low GROUP BY ALL)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(k.n_children, 0) AS n_children,
       s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN sums s USING (node) LEFT JOIN kids k USING (node) LEFT JOIN nodes u ON u.node = n.parent
"""

ORACLE: dict[str, str] = {"op9_vectors": OP9_SQL, "op11_minhash": OP11_SQL, "op12_divergence": OP12_SQL,
                          "op13_prefix_trie": OP13_SQL}
