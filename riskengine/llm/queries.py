"""Named queries of the operators and the SQL some of them are compared with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.llm import alignment, bpe, embeddings, html, langid, linedup, merkle, minhash, mixing, ordermin, toxicity, warc, winnowing


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.fingerprints(table(spark, sf_dir, "documents"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs))


def op6_linedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linedup.delete_repeated_runs(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "n_lines", "n_deleted", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents")).drop("ids")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"))
    found = warc.records(warc.read_archives(spark, manifest, with_payload=False))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.prove(merkle.build(table(spark, sf_dir, "documents")))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_mixing": op2_mixing,
    "op3_order_minhash": op3_order_minhash,
    "op4_embeddings": op4_embeddings,
    "op5_language": op5_language,
    "op6_linedup": op6_linedup,
    "op7_bpe": op7_bpe,
    "op8_warc": op8_warc,
    "op9_html": op9_html,
    "op10_toxicity": op10_toxicity,
    "op11_winnowing": op11_winnowing,
    "op12_merkle": op12_merkle,
    "op13_alignment": op13_alignment,
}

SHINGLE_LINKS = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
 s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
   ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS sh FROM w),
 x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
 links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
   GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
 reach AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT r.d, l.b FROM reach r JOIN links l ON l.a = r.c),
 comp AS (SELECT d AS doc_id, min(c) AS component_id FROM reach GROUP BY d)
 SELECT s.doc_id, len(s.sh)::BIGINT AS n_shingles, comp.component_id, comp.component_id = s.doc_id AS kept FROM s JOIN comp USING (doc_id)"""

MIXED = r"""WITH d AS (SELECT doc_id, source, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS id, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size FROM documents),
 s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM d GROUP BY source),
 w AS (SELECT *, [3.0, 1.0, 2.0][k % 3 + 1]::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM s),
 o AS (SELECT *, cap / w AS ratio, 1.5::DOUBLE * sum(source_size) OVER () AS total, sum(w) OVER () AS weight FROM w),
 l AS (SELECT *, (total - coalesce(sum(cap) OVER before, 0)) / (weight - coalesce(sum(w) OVER before, 0)) AS level FROM o
   WINDOW before AS (ORDER BY ratio, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 t AS (SELECT source, source_size, least(cap, coalesce(arg_min(level, ratio) FILTER (level <= ratio) OVER () * w, cap)) AS target FROM l),
 e AS (SELECT d.*, source_size, target, least(2.0::DOUBLE, CASE WHEN source_size > 0 THEN target * 1.0::DOUBLE / source_size ELSE 0 END) AS e,
   (('0x' || substr(md5('7:' || id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
   FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
 p AS (SELECT *, floor(e) AS c, e - floor(e) AS p FROM e),
 r AS (SELECT *, CASE WHEN p > 0 AND size > 0 THEN u * (1 - p) / ((1 - u) * p) END AS ratio, target - sum(c * size) OVER (PARTITION BY source) AS left_ FROM p),
 q AS (SELECT *, sum(CASE WHEN ratio IS NULL THEN 0 ELSE size END) OVER (PARTITION BY source ORDER BY ratio NULLS FIRST, id, size ROWS UNBOUNDED PRECEDING) AS upto FROM r)
 SELECT doc_id, size::BIGINT AS size, source_size, target,
  ((c + CASE WHEN ratio IS NOT NULL AND left_ > 0 AND upto - size / 2 <= left_ THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM q"""

LINE_RUNS = r"""WITH l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS raw, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL),
 c AS (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM l),
 f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY raw) AS i, sum(w) OVER (PARTITION BY doc_id ORDER BY raw) AS upto FROM c WHERE w > 0),
 runs AS (
   SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.w >= 50 GROUP BY a.doc_id, a.i
   UNION
   SELECT b.doc_id, max(a.i) AS s, b.i AS e FROM f a JOIN f b ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.w >= 50 GROUP BY b.doc_id, b.i),
 t AS (SELECT doc_id, list(line ORDER BY i) AS ls FROM f GROUP BY doc_id),
 k AS (SELECT r.doc_id, s, e, array_to_string(ls[s:e], chr(10)) AS run FROM runs r JOIN t USING (doc_id)),
 first AS (SELECT run, e - s AS n, min({'d': doc_id, 's': s}) AS f FROM k GROUP BY run, e - s HAVING count(*) > 1),
 later AS (SELECT k.doc_id, k.s, k.e FROM k JOIN first USING (run) WHERE k.doc_id <> f.d OR k.s > f.s + n),
 gone AS (SELECT DISTINCT f.doc_id, f.raw FROM f JOIN later USING (doc_id) WHERE f.i BETWEEN later.s AND later.e),
 kept AS (SELECT c.doc_id, coalesce(string_agg(line, chr(10) ORDER BY c.raw) FILTER (g.raw IS NULL), '') AS text, count(*) FILTER (w > 0) AS n_lines, count(g.raw) AS n_deleted
   FROM c LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.raw = c.raw GROUP BY c.doc_id)
 SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_deleted, 0)::BIGINT AS n_deleted, sha256(coalesce(kept.text, '')) AS text_sha256 FROM documents d LEFT JOIN kept USING (doc_id)"""

VECTOR_LINKS = """WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
 ok AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
 links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.95),
 reach AS (SELECT vec_id AS d, vec_id AS c FROM v UNION SELECT r.d, l.b FROM reach r JOIN links l ON l.a = r.c),
 comp AS (SELECT d AS vec_id, min(c) AS component_id FROM reach GROUP BY d),
 deg AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
 SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, component_id = vec_id AS kept FROM comp LEFT JOIN deg USING (vec_id)"""

WARC_RECORDS = """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
 t AS (SELECT d, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY d)
 SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest, CASE WHEN page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to FROM p LEFT JOIN t ON p.d = t.d AND n >= 1000"""

ITEM_WINDOWS = r"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
 i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
 v AS (SELECT DISTINCT item, least(len(ws), 10) AS n, unnest(list_transform(range(1, len(ws) - least(len(ws), 10) + 2), lambda s: array_to_string(ws[s : s + least(len(ws), 10) - 1], ' '))) AS win FROM i WHERE len(ws) > 0),
 o AS (SELECT r, n, unnest(range(1, len(ws) - n + 2)) AS s, unnest(list_transform(range(1, len(ws) - n + 2), lambda s: array_to_string(ws[s : s + n - 1], ' '))) AS win
  FROM d, (SELECT DISTINCT n FROM v) WHERE len(ws) >= n),
 h AS (SELECT o.r, o.n, s, item FROM o JOIN v ON o.win = v.win AND o.n = v.n),
 w AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT r, n, s FROM h)) GROUP BY r),
 m AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
 SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
  FROM d LEFT JOIN w USING (r) LEFT JOIN m USING (r)"""

_LEAF = "sha256(concat(" + ", ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR)) || ':' || {c} END" for c in ("doc_id", "source", "lang", "{n_chars}", "text")) + "))"
# the checksum bit by bit: DuckDB has no crc32 of its own
_CRC = """(SELECT doc_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda k: ascii(substr(doc_id::VARCHAR, k::INT, 1))::BIGINT)),
  lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::BIGINT) ELSE c // 2 END)) AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL))"""
MERKLE = f"""WITH RECURSIVE l AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_LEAF.format(n_chars='n_chars')} AS leaf, {_LEAF.format(n_chars='(n_chars + 1)')} AS changed FROM documents),
 c AS {_CRC},
 p AS (SELECT l.*, row_number() OVER (PARTITION BY tree ORDER BY l.doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n, coalesce(xor(c.c, 4294967295::BIGINT) % 7 = 0, false) AS hit
  FROM l LEFT JOIN c ON l.doc_id = c.doc_id),
 nodes AS (SELECT tree, 0 AS level, idx, n, leaf AS h FROM p
  UNION ALL SELECT tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 2, n),
 subs AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
 top AS (SELECT 0 AS level, idx, n, h FROM subs UNION ALL SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY level, idx // 2, n),
 steps AS (
  SELECT p.tree, p.idx AS leaf_idx, a.level, CASE WHEN s.h IS NULL THEN '=' WHEN a.idx % 2 = 1 THEN '<' ELSE '>' END || coalesce(s.h, '') AS step
   FROM p JOIN nodes a ON a.tree = p.tree AND a.n > 1 AND a.idx = p.idx >> a.level LEFT JOIN nodes s ON s.tree = a.tree AND s.level = a.level AND s.idx = xor(a.idx, 1)
  UNION ALL SELECT p.tree, p.idx, 100 + a.level, CASE WHEN s.h IS NULL THEN '=' WHEN a.idx % 2 = 1 THEN '<' ELSE '>' END || coalesce(s.h, '')
   FROM p JOIN subs ON subs.tree = p.tree JOIN top a ON a.n > 1 AND a.idx = subs.idx >> a.level LEFT JOIN top s ON s.level = a.level AND s.idx = xor(a.idx, 1)),
 ways AS (SELECT tree, leaf_idx AS idx, list(step ORDER BY level) AS way FROM steps GROUP BY tree, leaf_idx),
 f AS (SELECT doc_id, leaf, subs.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root, coalesce(way, []) AS way, CASE WHEN hit AND changed IS NOT NULL THEN changed ELSE leaf END AS start
  FROM p JOIN subs ON subs.tree = p.tree LEFT JOIN ways ON ways.tree = p.tree AND ways.idx = p.idx),
 g AS (SELECT *, list_reduce(list_prepend(start, way), lambda a, x: CASE left(x, 1) WHEN '<' THEN sha256(substr(x, 2) || a) WHEN '>' THEN sha256(a || substr(x, 2)) ELSE sha256(a) END) AS folded_root FROM f)
 SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(way, lambda x: substr(x, 2)), '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM g"""

ORACLES = {
    "op1_minhash": SHINGLE_LINKS,
    "op2_mixing": MIXED,
    "op4_embeddings": VECTOR_LINKS,
    "op6_linedup": LINE_RUNS,
    "op8_warc": WARC_RECORDS,
    "op11_winnowing": ITEM_WINDOWS,
    "op12_merkle": MERKLE,
}
