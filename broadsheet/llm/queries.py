"""One query per operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from broadsheet.llm import centroids, embedding_dedup, language_id, licenses, manifest, mixing, near_dedup, packing, pii, suffix_tree, token_counts, topk_search, toxicity
from broadsheet.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language_id.held_out(F.col("doc_id"), 4, 2)
    net = language_id.fit(docs.filter(~F.coalesce(held, F.lit(False))))
    out = language_id.identify(docs, net, F.coalesce(held, F.lit(False)).alias("held_out"))
    return out.select("doc_id", "held_out", "lang_pred", "score")


@query
def op2_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(table(spark, sf_dir, "documents"), 85)


ORACLES["op2_minhash_near_dup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM words WHERE len(w) > 0),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (SELECT a, b FROM common WHERE 100 * c >= 85 * (na + nb - c)),
reach(node, seen) AS (SELECT DISTINCT a, a FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a),
low AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(len(s.s), 0)::BIGINT AS n_shingles, coalesce(low.component, d.doc_id) AS component_id,
  d.doc_id = coalesce(low.component, d.doc_id) AS kept
FROM documents d LEFT JOIN sets s USING (doc_id) LEFT JOIN low ON d.doc_id = low.node
"""


@query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in licenses.SENTENCES.items())
    steps = ["""t0 AS (SELECT doc_id, sentence_ids AS raw, sentence_ids AS rest, '' AS found FROM ids)"""]
    for k, (sequence, name) in enumerate(licenses.RULES, 1):
        piece = quoted("|" + "|".join(sequence) + "|")
        steps.append(f"""t{k} AS (SELECT doc_id, raw,
  replace(rest, {piece}, '|-|') AS rest,
  CASE WHEN contains(rest, {piece}) AND NOT contains(found, {quoted(name + ",")}) THEN found || {quoted(name + ",")} ELSE found END AS found
  FROM t{k - 1})""")
    return f"""
WITH cut AS (
  SELECT doc_id, text, list_filter(string_split_regex(regexp_replace(text, {quoted(licenses.END)}, E'\\\\1\\n', 'g'), '\\n+'), lambda x: length(x) > 0) AS parts
  FROM documents),
ids AS (
  SELECT doc_id, CASE WHEN regexp_matches(text, {quoted(licenses.ANCHORS)}) THEN
    regexp_replace('|' || array_to_string(list_transform(parts, lambda s:
      CASE WHEN length(s) <= {licenses.LONGEST} AND regexp_matches(s, {quoted(licenses.ANCHORS)})
        THEN coalesce((MAP {{{known}}})[trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))], '-') ELSE '-' END), '|') || '|', '(\\|-)+\\|', '|-|', 'g')
    ELSE '|' END AS sentence_ids
  FROM cut),
{", ".join(steps)}
SELECT doc_id, regexp_replace(regexp_replace(raw, '(\\|-)+\\|', '|', 'g'), '^\\||\\|$', '', 'g') AS sentence_ids, rtrim(found, ',') AS licenses
FROM t{len(licenses.RULES)}
"""


ORACLES["op3_license_scan"] = _license_sql()


@query
def op4_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.deduplicate(table(spark, sf_dir, "embeddings"), 0.93)


ORACLES["op4_embedding_near_dup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(node, seen) AS (
  SELECT DISTINCT a, a FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a),
low AS (SELECT node, min(seen) AS component FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(low.component, e.vec_id) AS component_id,
  coalesce(e.vec_id = coalesce(low.component, e.vec_id), true) AS kept
FROM embeddings e LEFT JOIN n ON e.vec_id = n.a LEFT JOIN low ON e.vec_id = low.node
"""


@query
def op5_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(language_id.held_out(F.col("doc_id"), 3, 1), F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held)
    out = toxicity.score(docs, model, 0.7, held.alias("held_out"))
    return out.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


@query
def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk_search.quantised(table(spark, sf_dir, "embeddings"))
    return topk_search.search(vectors, vectors.filter(F.col("id") % 100 == 0), 10)


ORACLES["op6_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query
def op8_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("position_again").orderBy("position", "doc_id")


ORACLES["op8_curriculum_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 15))::BIGINT AS digest
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, ([3, 1, 2])[(source_no % 3 + 1)::INT] AS w, ([-0.5::DOUBLE, 0.0, 0.5])[(source_no % 3 + 1)::INT] AS tilt,
    source_size * 2 AS cap, (sum(source_size) OVER ())::BIGINT AS total
  FROM per),
filled AS (
  SELECT *, w * (total * 3 - coalesce(sum(cap) OVER (ORDER BY cap / w, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2)::DOUBLE
    > cap::DOUBLE * (sum(w) OVER (ORDER BY cap / w, source_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) * 2 AS is_full
  FROM weighed),
opened AS (
  SELECT *, (sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())::BIGINT AS taken_caps,
    (sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ())::BIGINT AS open_weights
  FROM filled),
targets AS (
  SELECT source, source_size, source_no, tilt,
    CASE WHEN is_full THEN cap::DOUBLE ELSE (w * (total * 3 - taken_caps * 2))::DOUBLE / (open_weights * 2)::DOUBLE END AS target
  FROM opened),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.tilt, floor(t.target)::BIGINT AS lim,
    (sum(s.size) OVER (PARTITION BY t.source_no ORDER BY s.digest, s.doc_id, s.size ROWS UNBOUNDED PRECEDING))::BIGINT - s.size AS start_at
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  greatest(0, least(size, lim - start_at)) + greatest(0, least(size, lim - source_size - start_at)) AS taken,
  CASE WHEN least(size, lim - start_at) > 0 THEN
    2.0::DOUBLE * (start_at::DOUBLE / target) / ((1.0 - tilt) + sqrt((1.0 - tilt) * (1.0 - tilt) + 4.0::DOUBLE * tilt * (start_at::DOUBLE / target))) END AS position
FROM placed
"""


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


@query
def op11_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.evaluate(table(spark, sf_dir, "documents"))


@query
def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(table(spark, sf_dir, "embeddings"))


def _cluster_sql(rounds: int = centroids.ROUNDS) -> str:
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT rid, c, d FROM (
    SELECT rid, c, list_sum(list_transform(list_zip(v.q, m.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d,
      row_number() OVER (PARTITION BY rid ORDER BY d, c) AS near
    FROM v CROSS JOIN c{k} m) WHERE near = 1)""")
        if k < rounds:
            steps.append(f"""c{k + 1} AS MATERIALIZED (
  SELECT m.c, coalesce(n.q, m.q) AS q FROM c{k} m LEFT JOIN (
    SELECT c, list(floor(s::DOUBLE / n)::BIGINT ORDER BY i) AS q FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n FROM (
        SELECT a.c, unnest(v.q) AS x, generate_subscripts(v.q, 1) AS i FROM a{k} a JOIN v USING (rid)) GROUP BY c, i) GROUP BY c) n USING (c))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {centroids.SCALE})::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {centroids.DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT c, q FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, q) - 1 AS c, q FROM v) WHERE c < {centroids.CLUSTERS}),
{", ".join(steps)},
per AS (SELECT c, sum(d)::BIGINT AS s FROM a{rounds} GROUP BY c)
SELECT v.vec_id, a.c::INT AS cluster, a.d AS distance, per.s AS cluster_inertia, (SELECT sum(s)::BIGINT FROM per) AS inertia,
  sha256(array_to_string(m.q, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (rid) JOIN c{rounds} m ON a.c = m.c JOIN per ON a.c = per.c
"""


ORACLES["op12_centroid_clusters"] = _cluster_sql()


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audit(table(spark, sf_dir, "documents"))


def _merkle_sql(levels: int = 7) -> str:
    """Trees of up to 16 ** levels leaves, level by level; a tree that has come to one node passes through."""
    part = lambda x: f"coalesce(strlen({x}) || ':' || {x}, '-')"
    leaf = lambda text: f"sha256({' || '.join(part(x) for x in ('doc_id::VARCHAR', 'source', 'lang', 'n_chars::VARCHAR', text))})"

    def grown(name: str) -> list[str]:
        out = []
        for k in range(levels):
            out.append(f"""{name}r{k} AS MATERIALIZED (
  SELECT tree, n // 16 AS block, any_value(total) AS total, list(node ORDER BY n) AS run FROM {name}n{k} GROUP BY tree, n // 16),
{name}n{k + 1} AS (
  SELECT tree, block AS n, (total + 15) // 16 AS total, CASE WHEN total > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS node FROM {name}r{k})""")
        return out

    def climbed(name: str, rows: str) -> list[str]:
        out = []
        for k in range(levels):
            left, right = "array_to_string(run[1:n % 16], '')", "array_to_string(run[n % 16 + 2:], '')"
            out.append(f"""{rows}{k + 1} AS (
  SELECT a.* REPLACE (n // 16 AS n, CASE WHEN total > 1 THEN sha256({left} || node || {right}) ELSE node END AS node,
    proof || CASE WHEN total > 1 THEN {left} || {right} ELSE '' END AS proof)
  FROM {rows}{k} a JOIN {name}r{k} b ON a.tree = b.tree AND a.n // 16 = b.block)""")
        return out

    return f"""
WITH bits AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT] || list_transform(range(8), lambda x: 0::BIGINT),
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c FROM range(256) r(i))),
chosen AS (
  SELECT *, coalesce(xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 5 = 0, false) AS changed FROM documents CROSS JOIN bits),
leaves AS (
  SELECT doc_id, source, {part('source')} AS tree, {leaf('text')} AS leaf,
    CASE WHEN changed THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS other FROM chosen),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS n, count(*) OVER (PARTITION BY tree) AS total FROM leaves),
sn0 AS (SELECT tree, n, total, leaf AS node FROM placed),
{", ".join(grown("s"))},
tops AS MATERIALIZED (
  SELECT '' AS tree, f.tree AS of, f.node, row_number() OVER (ORDER BY l.source NULLS FIRST) - 1 AS n, count(*) OVER () AS total
  FROM sn{levels} f JOIN (SELECT DISTINCT tree, source FROM leaves) l USING (tree)),
tn0 AS (SELECT tree, n, total, node FROM tops),
{", ".join(grown("t"))},
low0 AS (SELECT doc_id, leaf, tree, n, coalesce(other, leaf) AS node, '' AS proof FROM placed),
{", ".join(climbed("s", "low"))},
high0 AS (SELECT low.doc_id, low.leaf, tops.node AS subroot, tops.tree, tops.n, low.node, low.proof FROM low{levels} low JOIN tops ON low.tree = tops.of),
{", ".join(climbed("t", "high"))}
SELECT doc_id, leaf, subroot, (SELECT node FROM tn{levels}) AS root, sha256(proof) AS proof_sha256, node AS folded_root,
  node = (SELECT node FROM tn{levels}) AS verified
FROM high{levels}
"""


ORACLES["op13_merkle_manifest"] = _merkle_sql()
