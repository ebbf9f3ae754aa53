"""DuckDB oracle SQL for the named queries (independent re-statements of
each operator's semantics over the same parquet views)."""

from __future__ import annotations

from .. import config
from ..sources.testdata import FIXTURE_QUERIES, TYPE_MAP

# Fixed values, stated here apart from the code under test.
CHAIN_T, PLANT_T = 0.40, 0.92
NAME_PROBES = (("q1", "ring"), ("q2", " Red "), ("q3", "small widget"), ("q4", "zzz"))
BONUS_SAME_MASTER_CATEGORY = 0.02
BONUS_SAME_USAGE = 0.01
CHART_TOP_TYPES = 15
DISPLAY_SEED = 0
HASH_DIM = 64
HASH_HEX_CHARS = 7
MIN_CLUSTER_SIZE = 2
NAME_DISPLAY_CHARS = 35
NAME_LABEL_CHARS = 30
QUERY_LABEL_CHARS = 20
SAMPLE_DISPLAY = 12
SAMPLE_SEED = 42
SCORE_BAND_GREEN = 0.85
SCORE_BAND_YELLOW = 0.70
TOP_ARTICLE_TYPES = 20
TOP_COLOURS = 15


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows, cols) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return _q(v)
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


TYPES = _values(TYPE_MAP, ["label", "articleType", "masterCategory", "subCategory"])

CATALOG = f"""catalog AS (
  SELECT p.p_partkey AS id, p.p_name AS productDisplayName, t.articleType, t.masterCategory, t.subCategory,
         split_part(p.p_name, ' ', 1) AS baseColour, p.p_type AS usage, p.p_brand AS brand,
         CASE p.p_size % 4 WHEN 0 THEN 'Summer' WHEN 1 THEN 'Fall' WHEN 2 THEN 'Winter' ELSE 'Spring' END AS season,
         CAST(2010 + p.p_size % 10 AS INTEGER) AS year,
         CAST(round(p.p_retailprice * 100) AS BIGINT) AS image_bytes,
         concat('images/', CAST(p.p_partkey AS VARCHAR), '.jpg') AS image_path,
         e.embedding
  FROM part p LEFT JOIN embeddings e ON e.vec_id = p.p_partkey
  JOIN {TYPES} ON t.label = coalesce(e.label, p.p_partkey % 10))"""


def bucket(t: str) -> str:
    return f"((('0x' || substr(md5({t}), 1, {HASH_HEX_CHARS}))::BIGINT) % {HASH_DIM})"


def hvec(text: str) -> str:
    """Hashed bag-of-words unit vector of a text expression."""
    toks = f"list_filter(string_split(lower({text}), ' '), lambda t: t <> '')"
    bks = f"list_transform({toks}, lambda t: {bucket('t')})"
    counts = f"list_transform(range({HASH_DIM}), lambda b: len(list_filter({bks}, lambda x: x = b))::DOUBLE)"
    return counts


def norm_list(v: str) -> str:
    n = f"sqrt(list_sum(list_transform({v}, lambda x: x * x)))"
    return f"list_transform({v}, lambda x: x / (CASE WHEN {n} = 0 THEN 1.0 ELSE {n} END))"


TRIM = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"


def trim(x: str) -> str:
    return TRIM.format(x)


def title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '([A-Za-z]+|[^A-Za-z]+)'), "
            f"lambda w: upper(w[1]) || lower(w[2:])), '')")


def clip(x: str) -> str:
    return f"least(greatest({x}, 0.0), 1.0)"


RULES = _values([(i, k, "|".join(ts)) for i, (k, ts) in enumerate(config.COMPLEMENTARY_RULES)],
                ["rule_pos", "rule_key", "targets"])
DEFAULT_TARGETS = "|".join(config.DEFAULT_COMPLEMENTARY)

RESOLVE = f"""types AS (SELECT DISTINCT lower({trim('articleType')}) AS tl FROM catalog),
  rules AS (SELECT * FROM {RULES}),
  m AS (SELECT tl, rule_key, targets, row_number() OVER (PARTITION BY tl ORDER BY CASE WHEN rule_key = tl THEN 0 ELSE 1 END, rule_pos) AS rn
        FROM types JOIN rules ON rule_key = tl OR contains(tl, rule_key) OR contains(rule_key, tl)),
  res AS (SELECT types.tl, m.rule_key, coalesce(m.targets, '{DEFAULT_TARGETS}') AS targets,
                 CASE WHEN m.rule_key IS NULL THEN 'default' WHEN m.rule_key = types.tl THEN 'exact' ELSE 'partial' END AS branch
          FROM types LEFT JOIN (SELECT * FROM m WHERE rn = 1) m ON m.tl = types.tl)"""

REASON_HEAD, _rest = config.REASON_RULE.split("{target}")
REASON_MID, REASON_TAIL = _rest.split("{source}")
FB_HEAD, FB_TAIL = config.REASON_FALLBACK.split("{source}")


def rule_reason(src: str, tgt: str) -> str:
    return f"concat({_q(REASON_HEAD)}, {title(tgt)}, {_q(REASON_MID)}, {title(src)}, {_q(REASON_TAIL)})"


def fb_reason(src: str) -> str:
    return f"concat({_q(FB_HEAD)}, {src}, {_q(FB_TAIL)})"


BM = BONUS_SAME_MASTER_CATEGORY
BU = BONUS_SAME_USAGE

RECS = f"""{RESOLVE},
  meta AS (SELECT *, lower({trim('articleType')}) AS tl FROM catalog),
  edges AS (SELECT DISTINCT tl AS lg, unnest(string_split(targets, '|')) AS rg FROM res),
  live AS (SELECT * FROM edges WHERE rg IN (SELECT tl FROM types)),
  hasc AS (SELECT DISTINCT lg FROM live),
  v AS (SELECT id, tl, masterCategory AS mc, usage AS us, embedding::DOUBLE[] AS e FROM meta WHERE embedding IS NOT NULL),
  scored AS (
    SELECT s.id AS source_id, c.id AS product_id, s.tl AS s_tl, c.tl AS c_tl, 'rule' AS path,
           least({clip('list_dot_product(s.e, c.e)')} + ((CASE WHEN s.mc = c.mc THEN {BM}::DOUBLE ELSE 0.0::DOUBLE END)
                 + (CASE WHEN s.us = c.us THEN {BU}::DOUBLE ELSE 0.0::DOUBLE END)), 1.0) AS score
    FROM v s JOIN live l ON l.lg = s.tl JOIN v c ON c.tl = l.rg
    UNION ALL
    SELECT s.id, c.id, s.tl, c.tl, 'fallback',
           least({clip('list_dot_product(s.e, c.e)')} + ((CASE WHEN s.mc = c.mc THEN {BM}::DOUBLE ELSE 0.0::DOUBLE END)
                 + (CASE WHEN s.us = c.us THEN {BU}::DOUBLE ELSE 0.0::DOUBLE END)), 1.0)
    FROM v s JOIN v c ON c.mc <> s.mc AND c.id <> s.id WHERE s.tl NOT IN (SELECT lg FROM hasc)),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY score DESC, product_id) AS rank FROM scored),
  recs AS (SELECT r.source_id, CAST(r.rank AS BIGINT) AS rank, r.product_id, r.score,
                  CASE WHEN r.path = 'rule' THEN {rule_reason('r.s_tl', 'r.c_tl')} ELSE {fb_reason('r.s_tl')} END AS reason,
                  r.path, c.productDisplayName AS product_name, c.articleType AS article_type
           FROM ranked r JOIN catalog c ON c.id = r.product_id WHERE r.rank <= 5)"""

REC_COLS = "source_id, rank, product_id, round(score, 6) AS score, reason, path, product_name, article_type"

KNN = f"""v AS (SELECT id, embedding::DOUBLE[] AS e FROM catalog WHERE embedding IS NOT NULL),
  s AS (SELECT a.id AS source_id, b.id AS product_id, list_dot_product(a.e, b.e) AS raw FROM v a JOIN v b ON a.id <> b.id),
  r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY raw DESC, product_id) AS rank FROM s)"""

NAMEQ = f"""idx AS (SELECT id, {norm_list(hvec('productDisplayName'))} AS e FROM catalog),
  q AS (SELECT DISTINCT p_name AS query, split_part(p_name, ' ', 1) AS relevant FROM part WHERE p_name IS NOT NULL),
  qv AS (SELECT query, relevant, {norm_list(hvec(trim('query')))} AS e FROM q WHERE {trim('query')} <> ''),
  s AS (SELECT qv.query, idx.id AS product_id, list_dot_product(qv.e, idx.e) AS raw FROM qv, idx),
  r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY raw DESC, product_id) AS rank FROM s),
  res AS (SELECT r.query, CAST(r.rank AS BIGINT) AS rank, r.product_id, {clip('r.raw')} AS similarity,
                 c.productDisplayName AS product_name, c.baseColour AS base_colour
          FROM r JOIN catalog c ON c.id = r.product_id WHERE r.rank <= 5)"""


def fixture_search(mode: str) -> str:
    fq = _values(FIXTURE_QUERIES, ["qid", "query", "relevant"])
    if mode == "post":
        body = f"""s AS (SELECT qv.qid, qv.query, idx.id AS product_id, list_dot_product(qv.e, idx.e) AS raw FROM qv, idx),
  r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY raw DESC, product_id) AS r0 FROM s),
  f AS (SELECT r.*, c.masterCategory FROM r JOIN catalog c ON c.id = r.product_id
        WHERE r.r0 <= 15 AND lower(c.masterCategory) = 'apparel'),"""
    else:
        body = f"""s AS (SELECT qv.qid, qv.query, idx.id AS product_id, list_dot_product(qv.e, idx.e) AS raw
        FROM qv, idx JOIN catalog c ON c.id = idx.id WHERE lower(c.masterCategory) = 'apparel'),
  r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY raw DESC, product_id) AS r0 FROM s),
  f AS (SELECT r.*, c.masterCategory FROM r JOIN catalog c ON c.id = r.product_id WHERE r.r0 <= 5),"""
    return f"""WITH {CATALOG},
  idx AS (SELECT id, {norm_list(hvec('productDisplayName'))} AS e FROM catalog),
  fq AS (SELECT * FROM {fq}),
  qv AS (SELECT qid, {trim('query')} AS query, {norm_list(hvec(trim('query')))} AS e FROM fq WHERE {trim('query')} <> ''),
  {body}
  g AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY r0) AS rank FROM f)
SELECT CAST(qid AS BIGINT) AS qid, query, CAST(rank AS BIGINT) AS rank, product_id, round({clip('raw')}, 6) AS similarity,
       masterCategory AS master_category FROM g WHERE rank <= 5"""


PLANTED = f"""pv0 AS (SELECT vec_id AS base_id, embedding::DOUBLE[] AS e FROM embeddings),
  pv AS (SELECT base_id * 4 AS id, base_id, 0 AS copy_no, e FROM pv0
         UNION ALL SELECT base_id * 4 + 1, base_id, 1, list_transform(e, lambda x, i: CASE WHEN i = 1 THEN x + 0.1 ELSE x END) FROM pv0 WHERE base_id % 10 = 0
         UNION ALL SELECT base_id * 4 + 2, base_id, 2, list_transform(e, lambda x, i: CASE WHEN i = 2 THEN x + 0.3 ELSE x END) FROM pv0 WHERE base_id % 20 = 0
         UNION ALL SELECT base_id * 4 + 3, base_id, 3, list_transform(e, lambda x: 0.0::DOUBLE) FROM pv0 WHERE base_id % 100 = 0),
  planted AS (SELECT id, base_id, copy_no, {norm_list('e')} AS embedding FROM pv),
  pcat AS (SELECT p.id, c.productDisplayName, c.articleType, c.masterCategory,
                  CASE p.copy_no WHEN 1 THEN c.image_bytes - 1 WHEN 2 THEN c.image_bytes + 1 ELSE c.image_bytes END AS image_bytes,
                  concat('images/', CAST(p.id AS VARCHAR), '.jpg') AS image_path, p.embedding
           FROM planted p JOIN catalog c ON c.id = p.base_id)"""


def pairs_sql(src: str, t: float) -> str:
    return f"""pairs AS (SELECT a.id AS id_a, b.id AS id_b, list_dot_product(a.e, b.e) AS sim
           FROM {src} a JOIN {src} b ON a.id < b.id WHERE list_dot_product(a.e, b.e) >= {t})"""


CHAIN_SRC = "cv AS (SELECT id, embedding::DOUBLE[] AS e FROM catalog WHERE embedding IS NOT NULL)"
PLANT_SRC = "cv AS (SELECT id, embedding AS e FROM pcat)"

COMPONENTS = """ue AS (SELECT id_a AS s, id_b AS d FROM pairs UNION ALL SELECT id_b, id_a FROM pairs),
  walk(node, comp) AS (SELECT s, s FROM ue UNION SELECT ue.d, walk.comp FROM walk JOIN ue ON ue.s = walk.node),
  comps AS (SELECT node AS id, min(comp) AS component FROM walk GROUP BY node)"""


def clusters_sql(cat: str) -> str:
    return f"""members AS (SELECT c.component, k.id, k.id AS pos, coalesce(k.productDisplayName, 'Unknown') AS name,
                      k.image_bytes, count(*) OVER (PARTITION BY c.component) AS size
               FROM comps c JOIN {cat} k ON k.id = c.id),
  mem2 AS (SELECT * FROM members WHERE size >= {MIN_CLUSTER_SIZE}),
  rep AS (SELECT component, id AS representative_id, name AS representative_name, size, first_pos FROM (
            SELECT *, min(pos) OVER (PARTITION BY component) AS first_pos,
                   row_number() OVER (PARTITION BY component ORDER BY coalesce(image_bytes, -1) DESC, pos) AS rn FROM mem2) WHERE rn = 1),
  dims AS (SELECT m.component, unnest(generate_series(1, len(k.e))) AS d, unnest(k.e) AS x FROM mem2 m JOIN cv k ON k.id = m.id),
  avgs AS (SELECT component, sum(mu * mu) AS avg_similarity FROM (SELECT component, d, avg(x) AS mu FROM dims GROUP BY component, d) GROUP BY component),
  clus AS (SELECT CAST(row_number() OVER (ORDER BY first_pos) - 1 AS BIGINT) AS cluster_id, rep.component, representative_id,
                  representative_name, CAST(size AS BIGINT) AS size, avgs.avg_similarity
           FROM rep LEFT JOIN avgs ON avgs.component = rep.component)"""


RAW = f"""raw AS (
  SELECT id * 2 AS src_pos,
         CASE WHEN id % 17 = 0 THEN concat('x', CAST(id AS VARCHAR)) WHEN id % 19 = 0 THEN concat(CAST(id AS VARCHAR), '.7')
              ELSE CAST(id AS VARCHAR) END AS id,
         CASE WHEN id % 13 = 0 THEN NULL ELSE concat(' ', articleType, ' ') END AS articleType,
         masterCategory, subCategory, baseColour, season, CAST(year AS VARCHAR) AS year,
         CASE WHEN id % 23 = 0 THEN 'NA' ELSE usage END AS usage,
         CASE WHEN id % 29 = 0 THEN '   ' ELSE productDisplayName END AS productDisplayName,
         CASE WHEN id % 11 = 0 THEN NULL ELSE brand END AS brand
  FROM catalog
  UNION ALL
  SELECT id * 2 + 1, CAST(id AS VARCHAR), articleType, masterCategory, subCategory, 'DUP', season,
         CAST(year AS VARCHAR), usage, productDisplayName, brand FROM catalog WHERE id % 10 = 0)"""

STR_COLS = ("id", "articleType", "masterCategory", "subCategory", "baseColour", "season", "year", "usage",
            "productDisplayName", "brand")
TOKENS = ", ".join(_q(t) for t in config.NULL_TOKENS)
REQ = [c for c in config.REQUIRED_COLUMNS]


def _nt(c: str) -> str:
    return f"CASE WHEN {c} IN ({TOKENS}) THEN NULL ELSE {c} END AS {c}"


# Integers parse exactly; anything else goes through double and is truncated
# (DuckDB's string->BIGINT cast would round '19.7' to 20).
NUMID = ("coalesce(CASE WHEN regexp_full_match(trim(id), '[+-]?[0-9]+') THEN TRY_CAST(id AS BIGINT) END, "
         "TRY_CAST(trunc(TRY_CAST(id AS DOUBLE)) AS BIGINT))")

CLEAN = f"""{RAW},
  tok AS (SELECT src_pos, {', '.join(_nt(c) for c in STR_COLS)} FROM raw),
  nn AS (SELECT * FROM tok WHERE {' AND '.join(c + ' IS NOT NULL' for c in REQ)}),
  ids AS (SELECT * REPLACE ({NUMID} AS id) FROM nn WHERE {NUMID} IS NOT NULL),
  firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY src_pos) AS rn FROM ids) WHERE rn = 1),
  clean AS (SELECT id, src_pos, {trim('articleType')} AS articleType, {trim('masterCategory')} AS masterCategory,
                   {trim('subCategory')} AS subCategory, coalesce({trim('baseColour')}, 'Unknown') AS baseColour,
                   {trim('season')} AS season, CAST(TRY_CAST({trim('year')} AS DOUBLE) AS INTEGER) AS year,
                   coalesce({trim('usage')}, 'Unknown') AS usage, {trim('productDisplayName')} AS productDisplayName,
                   coalesce({trim('brand')}, 'Unknown') AS brand FROM firsts)"""

EXTS = config.IMAGE_EXTENSIONS
IMAGES = f"""inv AS (
  SELECT id, '.jpg' AS ext, image_bytes FROM catalog WHERE id % 7 <> 0 AND id % 5 <> 0
  UNION ALL SELECT id, '.png', image_bytes + 1 FROM catalog WHERE id % 7 <> 0 AND id % 5 = 0
  UNION ALL SELECT id, '.webp', image_bytes + 2 FROM catalog WHERE id % 3 = 0
  UNION ALL SELECT id, '.JPG', image_bytes FROM catalog WHERE id % 49 = 0),
  imgs AS (SELECT id, concat('images/', CAST(id AS VARCHAR), ext) AS image_path, CAST(image_bytes AS BIGINT) AS image_bytes FROM (
             SELECT *, row_number() OVER (PARTITION BY id ORDER BY list_position([{', '.join(_q(e) for e in EXTS)}], ext)) AS rn
             FROM inv WHERE list_position([{', '.join(_q(e) for e in EXTS)}], ext) IS NOT NULL) WHERE rn = 1)"""

WITHIMG = f"""{CLEAN},
  {IMAGES},
  wi AS (SELECT clean.*, imgs.image_path, imgs.image_bytes FROM clean JOIN imgs ON imgs.id = clean.id),
  final AS (SELECT * FROM wi)"""


def freq(col: str, top: int | None) -> str:
    lim = f" LIMIT {top}" if top else ""
    return (f"WITH {CATALOG}, {WITHIMG} SELECT {col} AS value, count(*) AS n FROM final WHERE {col} IS NOT NULL "
            f"GROUP BY {col} ORDER BY n DESC, value{lim}")


def tall(src: str, keep_zeros: bool = False) -> str:
    w = "" if keep_zeros else " WHERE value <> 0"
    return (f"SELECT id, dim, round(value, 6) AS value FROM (SELECT id, CAST(unnest(generate_series(0, len(e) - 1)) AS BIGINT) AS dim, "
            f"unnest(e) AS value FROM {src}){w}")


ORACLE: dict[str, str] = {}

ORACLE["knn_by_product"] = f"""WITH {CATALOG}, {KNN}
SELECT r.source_id, CAST(r.rank AS BIGINT) AS rank, r.product_id, round({clip('r.raw')}, 6) AS similarity,
       c.productDisplayName AS product_name, c.articleType AS article_type
FROM r JOIN catalog c ON c.id = r.product_id WHERE r.rank <= 5"""

ORACLE["knn_exclude"] = f"""WITH {CATALOG},
  v AS (SELECT id, embedding::DOUBLE[] AS e FROM catalog WHERE embedding IS NOT NULL),
  s AS (SELECT a.id AS source_id, b.id AS product_id, list_dot_product(a.e, b.e) AS raw FROM v a JOIN v b ON a.id <> b.id
        WHERE b.id NOT IN (SELECT id FROM catalog WHERE articleType = 'Watches')),
  r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY raw DESC, product_id) AS rank FROM s)
SELECT source_id, CAST(rank AS BIGINT) AS rank, product_id, round({clip('raw')}, 6) AS similarity FROM r WHERE rank <= 5"""

ORACLE["text_search"] = f"""WITH {CATALOG}, {NAMEQ}
SELECT query, rank, product_id, round(similarity, 6) AS similarity, printf('%.1f%%', similarity * 100) AS similarity_pct,
       product_name FROM res"""

ORACLE["text_search_post_filter"] = fixture_search("post")
ORACLE["text_search_pre_filter"] = fixture_search("pre")

ORACLE["search_metrics"] = f"""WITH {CATALOG}, {NAMEQ},
  agg AS (SELECT query, count(*) AS n, max(similarity) AS mx, min(similarity) AS mn, avg(similarity) AS av FROM res GROUP BY query)
SELECT qv.query, CAST(5 AS BIGINT) AS top_k, coalesce(n, 0) AS n_results, coalesce(round(mx, 4), 0.0) AS max_similarity,
       coalesce(round(mn, 4), 0.0) AS min_similarity, coalesce(round(av, 4), 0.0) AS avg_similarity
FROM qv LEFT JOIN agg ON agg.query = qv.query"""

ORACLE["precision_at_k"] = f"""WITH {CATALOG}, {NAMEQ},
  hits AS (SELECT res.query, count(*) AS hits FROM res JOIN qv ON qv.query = res.query
           WHERE lower(res.base_colour) = lower(qv.relevant) GROUP BY res.query)
SELECT qv.query, coalesce(hits, 0) AS hits, round(coalesce(hits, 0) / 5.0, 6) AS precision
FROM qv LEFT JOIN hits ON hits.query = qv.query WHERE qv.relevant IS NOT NULL"""

ORACLE["history_summary"] = """SELECT count(*) AS total_queries, round(avg(value), 2) AS avg_latency_ms,
       round(max(value), 2) AS max_latency_ms FROM events"""

ORACLE["history_by_query"] = """SELECT event_type AS query, count(*) AS total_queries, round(avg(value), 2) AS avg_latency_ms,
       round(max(value), 2) AS max_latency_ms FROM events GROUP BY event_type"""

ORACLE["text_embed"] = f"""WITH {CATALOG}, idx AS (SELECT id, {norm_list(hvec('productDisplayName'))} AS e FROM catalog)
{tall('idx')}"""

ORACLE["embed_incremental"] = f"""WITH {CATALOG},
  todo AS (SELECT id, {norm_list(hvec('productDisplayName'))} AS e FROM catalog WHERE id NOT IN (SELECT vec_id FROM embeddings))
{tall('todo')}"""

ORACLE["l2_normalize"] = f"""WITH {CATALOG}, {PLANTED}, pe AS (SELECT id, embedding AS e FROM planted)
{tall('pe', keep_zeros=True)}"""

ORACLE["vector_validate"] = """SELECT count(*) AS n_vectors, count(DISTINCT len(embedding)) AS n_dims,
       CAST(min(len(embedding)) AS BIGINT) AS dim, count(*) FILTER (WHERE embedding IS NULL) AS n_null,
       count(*) - count(DISTINCT vec_id) AS n_dup_ids, count(*) FILTER (WHERE p.p_partkey IS NULL) AS n_orphans
FROM embeddings LEFT JOIN (SELECT DISTINCT p_partkey FROM part) p ON p.p_partkey = embeddings.vec_id"""

ORACLE["zero_fill"] = f"""WITH {CATALOG}
SELECT id, coalesce(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)), 0) > 0 AS has_vector,
       round(coalesce(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))), 0.0), 6) AS norm FROM catalog"""

ORACLE["rule_resolution"] = f"""WITH {CATALOG}, {RESOLVE}
SELECT tl AS type_lower, rule_key, branch, targets FROM res"""

ORACLE["recommend_all"] = f"WITH {CATALOG}, {RECS} SELECT {REC_COLS} FROM recs"
ORACLE["recommend_fallback"] = f"WITH {CATALOG}, {RECS} SELECT {REC_COLS} FROM recs WHERE path = 'fallback'"
ORACLE["recommend_by_name"] = f"""WITH {CATALOG}, {RECS}
SELECT {REC_COLS} FROM recs WHERE source_id = (SELECT min(id) FROM catalog WHERE contains(lower(productDisplayName), 'ring'))"""
ORACLE["recommend_confidence"] = f"""WITH {CATALOG}, {RECS}
SELECT source_id, count(*) AS n, round(avg(score), 6) AS avg_confidence FROM recs GROUP BY source_id"""

ORACLE["reason_text"] = f"""WITH {CATALOG}, {RESOLVE},
  e AS (SELECT DISTINCT tl, unnest(string_split(targets, '|')) AS target FROM res)
SELECT tl AS type_lower, target, {rule_reason('tl', 'target')} AS reason, {fb_reason('tl')} AS fallback_reason FROM e"""

ORACLE["score_band"] = f"""WITH {CATALOG}, {RECS}
SELECT source_id, rank, CASE WHEN score >= {SCORE_BAND_GREEN} THEN 'green' WHEN score >= {SCORE_BAND_YELLOW} THEN 'yellow'
       ELSE 'red' END AS band, printf('%.1f%%', score * 100) AS score_pct FROM recs"""

ORACLE["dup_pairs_planted"] = f"""WITH {CATALOG}, {PLANTED}, {PLANT_SRC}, {pairs_sql('cv', PLANT_T)}
SELECT id_a, id_b, round(sim, 6) AS sim FROM pairs"""

ORACLE["dup_pairs_chain"] = f"""WITH {CATALOG}, {CHAIN_SRC}, {pairs_sql('cv', CHAIN_T)}
SELECT id_a, id_b, round(sim, 6) AS sim FROM pairs"""

ORACLE["dup_pairs_pivots"] = ORACLE["lsh_pairs"] = ORACLE["dup_pairs_planted"]

ORACLE["knn_pivots"] = ORACLE["knn_by_product"]

# (similar planted vectors come in cliques: an accepted listing has no similar predecessor at all)
ORACLE["stream_duplicates"] = f"""WITH {CATALOG}, {PLANTED}, cv AS (SELECT id, embedding AS e FROM planted), {pairs_sql('cv', PLANT_T)},
  arriving AS (SELECT id FROM planted WHERE NOT (copy_no = 0 AND base_id % 20 <> 0)),
  earlier AS (SELECT CASE WHEN id_b IN (SELECT id FROM arriving) AND (id_a < id_b OR id_a NOT IN (SELECT id FROM arriving)) THEN id_b ELSE id_a END AS new_id,
                     id_a, id_b, sim FROM pairs WHERE id_a IN (SELECT id FROM arriving) OR id_b IN (SELECT id FROM arriving)),
  hit AS (SELECT new_id, id_a + id_b - new_id AS existing_id, sim FROM earlier),
  kept AS (SELECT * FROM hit WHERE existing_id NOT IN (SELECT new_id FROM hit))
SELECT new_id, arg_min(existing_id, (-sim, existing_id)) AS existing_id, round(max(sim), 6) AS similarity FROM kept GROUP BY new_id"""

ORACLE["lsh_recall"] = f"""WITH {CATALOG}, {PLANTED}, {PLANT_SRC}, {pairs_sql('cv', PLANT_T)}
SELECT count(*) AS exact_pairs, true AS recall_reached FROM pairs"""

ORACLE["dup_components"] = f"""WITH RECURSIVE {CATALOG}, {CHAIN_SRC}, {pairs_sql('cv', CHAIN_T)}, {COMPONENTS}
SELECT id, component FROM comps"""

_CHAIN_CL = f"WITH RECURSIVE {CATALOG}, {CHAIN_SRC}, {pairs_sql('cv', CHAIN_T)}, {COMPONENTS}, {clusters_sql('catalog')}"
_PLANT_CL = f"WITH RECURSIVE {CATALOG}, {PLANTED}, {PLANT_SRC}, {pairs_sql('cv', PLANT_T)}, {COMPONENTS}, {clusters_sql('pcat')}"
_CL_COLS = "cluster_id, representative_id, representative_name, size, round(avg_similarity, 4) AS avg_similarity"

ORACLE["dup_clusters"] = f"{_CHAIN_CL} SELECT {_CL_COLS} FROM clus"
ORACLE["dup_clusters_planted"] = f"{_PLANT_CL} SELECT {_CL_COLS} FROM clus"

ORACLE["duplicate_report"] = f"""{_PLANT_CL}
SELECT clus.cluster_id, m.id AS product_id, m.name AS product_name, m.id = clus.representative_id AS is_representative,
       clus.representative_id, clus.representative_name, round(clus.avg_similarity, 4) AS avg_similarity,
       clus.size AS cluster_size
FROM mem2 m JOIN clus ON clus.component = m.component"""

_EXPORT = ", ".join(c for c in config.EXPORT_COLUMNS)
ORACLE["unique_catalog"] = f"""{_CHAIN_CL},
  removed AS (SELECT m.id FROM mem2 m JOIN clus ON clus.component = m.component WHERE m.id <> clus.representative_id)
SELECT {_EXPORT} FROM catalog WHERE id NOT IN (SELECT id FROM removed)"""

_SUMMARY = """SELECT total_products, duplicate_clusters, products_in_clusters,
       total_products - (products_in_clusters - duplicate_clusters) AS unique_products,
       CASE WHEN total_products > 0 THEN round(100 * (1 - (total_products - (products_in_clusters - duplicate_clusters)) / total_products), 2)
            ELSE 0.0 END AS reduction_percent,
       CAST({t} AS DOUBLE) AS threshold,
       CASE WHEN duplicate_clusters > 0 THEN round(products_in_clusters / duplicate_clusters, 2) ELSE 0.0 END AS avg_cluster_size
FROM (SELECT (SELECT count(*) FROM {cat}) AS total_products, (SELECT count(*) FROM clus) AS duplicate_clusters,
             (SELECT CAST(coalesce(sum(size), 0) AS BIGINT) FROM clus) AS products_in_clusters)"""

ORACLE["dedup_summary"] = f"{_CHAIN_CL} {_SUMMARY.format(t=CHAIN_T, cat='catalog')}"
ORACLE["dedup_series"] = f"""{_PLANT_CL}, summ AS ({_SUMMARY.format(t=PLANT_T, cat='pcat')})
SELECT 'Total Products' AS label, total_products AS value FROM summ
UNION ALL SELECT 'In Duplicate Clusters', products_in_clusters FROM summ
UNION ALL SELECT 'Unique Products', unique_products FROM summ"""

ORACLE["cluster_preview"] = f"""{_CHAIN_CL},
  pm AS (SELECT clus.cluster_id, m.id, m.name, clus.representative_id,
                row_number() OVER (PARTITION BY clus.cluster_id ORDER BY m.pos) AS member_rank
         FROM mem2 m JOIN clus ON clus.component = m.component WHERE clus.cluster_id < 4)
SELECT cluster_id, CAST(member_rank AS BIGINT) AS member_rank, id AS product_id, name AS product_name,
       id = representative_id AS is_representative FROM pm WHERE member_rank <= 4"""

ORACLE["clean_catalog"] = f"""WITH {CATALOG}, {CLEAN}
SELECT id, src_pos, articleType, masterCategory, subCategory, baseColour, season, year, usage, productDisplayName, brand FROM clean"""

ORACLE["image_resolve"] = f"WITH {CATALOG}, {IMAGES} SELECT id, image_path, image_bytes FROM imgs"

ORACLE["catalog_with_images"] = f"""WITH {CATALOG}, {WITHIMG}
SELECT id, productDisplayName, articleType, image_path, image_bytes FROM wi"""

ORACLE["cap_sample"] = f"""WITH {CATALOG}, {WITHIMG}
SELECT id, productDisplayName FROM wi ORDER BY md5(concat('{SAMPLE_SEED}:', CAST(id AS VARCHAR))), id LIMIT 500"""

ORACLE["display_sample"] = f"""WITH {CATALOG}, {WITHIMG}
SELECT id, image_path, CASE WHEN length(productDisplayName) > {NAME_LABEL_CHARS}
       THEN concat(substr(productDisplayName, 1, {NAME_LABEL_CHARS - 1}), '…') ELSE productDisplayName END AS label
FROM wi WHERE image_path IS NOT NULL AND coalesce(image_bytes, 0) > 0
ORDER BY md5(concat('{DISPLAY_SEED}:', CAST(id AS VARCHAR))), id LIMIT {SAMPLE_DISPLAY}"""

ORACLE["dq_counters"] = f"""WITH {CATALOG}, {CLEAN}, {IMAGES},
  a AS (SELECT (SELECT count(*) FROM raw) AS raw_n, (SELECT count(*) FROM nn) AS nn_n, (SELECT count(*) FROM ids) AS id_n,
               (SELECT count(DISTINCT id) FROM ids) AS uniq_n,
               (SELECT count(DISTINCT ids.id) FROM ids JOIN imgs ON imgs.id = ids.id) AS img_n)
SELECT 'drop_null_required' AS stage, raw_n AS rows_in, nn_n AS rows_out, raw_n - nn_n AS dropped FROM a
UNION ALL SELECT 'coerce_id', nn_n, id_n, nn_n - id_n FROM a
UNION ALL SELECT 'first_per_id', id_n, uniq_n, id_n - uniq_n FROM a
UNION ALL SELECT 'keep_with_image', uniq_n, img_n, uniq_n - img_n FROM a"""

ORACLE["products_by_type"] = f"""WITH {CATALOG}
SELECT id, productDisplayName, articleType FROM catalog WHERE lower(articleType) = 'shirts'"""

ORACLE["product_names"] = f"""WITH {CATALOG}
SELECT DISTINCT productDisplayName AS name FROM catalog WHERE productDisplayName IS NOT NULL ORDER BY name"""

ORACLE["category_choices"] = f"""WITH {CATALOG}
SELECT 'All' AS choice, CAST(0 AS BIGINT) AS ord
UNION ALL SELECT DISTINCT masterCategory, CAST(1 AS BIGINT) FROM catalog WHERE masterCategory IS NOT NULL"""

ORACLE["name_match"] = f"""WITH {CATALOG}, probes AS (SELECT * FROM {_values(NAME_PROBES, ['pid', 'query'])}),
  m AS (SELECT p.query, c.id, c.productDisplayName,
               row_number() OVER (PARTITION BY p.query ORDER BY c.id) AS rn
        FROM probes p JOIN catalog c ON contains(lower(c.productDisplayName), lower({trim('p.query')})))
SELECT query, id, productDisplayName FROM m WHERE rn = 1"""

ORACLE["truncate_name"] = f"""WITH {CATALOG}
SELECT id, CASE WHEN length(productDisplayName) > 10 THEN concat(substr(productDisplayName, 1, 9), '…')
                ELSE productDisplayName END AS short_name,
       left(productDisplayName, {NAME_DISPLAY_CHARS}) AS display_name,
       {title('productDisplayName')} AS title_name FROM catalog"""

_PAL = ", ".join(_q(c) for c in config.COLOR_PALETTE)
ORACLE["label_colour"] = f"""WITH {CATALOG},
  l AS (SELECT DISTINCT articleType AS label FROM catalog WHERE articleType IS NOT NULL),
  r AS (SELECT label, CAST((dense_rank() OVER (ORDER BY label) - 1) % {len(config.COLOR_PALETTE)} AS BIGINT) AS palette_index FROM l)
SELECT label, palette_index, [{_PAL}][palette_index + 1] AS colour FROM r"""

ORACLE["profile_scalars"] = f"""WITH {CATALOG}, {WITHIMG}
SELECT (SELECT count(*) FROM final) AS total_products, (SELECT count(*) FROM raw) AS raw_rows,
       (SELECT count(*) FROM clean) AS clean_rows,
       (SELECT count(*) FROM raw) - (SELECT count(*) FROM clean) AS removed_by_clean,
       (SELECT count(*) FROM clean) - (SELECT count(*) FROM final) AS removed_after_clean,
       (SELECT count(*) FROM raw) - (SELECT count(*) FROM final) AS missing_before,
       (SELECT count(DISTINCT masterCategory) FROM final) AS master_categories,
       (SELECT count(DISTINCT articleType) FROM final) AS article_types,
       (SELECT count(DISTINCT season) FROM final) AS seasons"""

ORACLE["freq_master_category"] = freq("masterCategory", None)
ORACLE["freq_article_type_top20"] = freq("articleType", TOP_ARTICLE_TYPES)
ORACLE["freq_usage"] = freq("usage", None)
ORACLE["freq_colour_top15"] = freq("baseColour", TOP_COLOURS)
ORACLE["chart_article_types"] = f"SELECT * FROM ({freq('articleType', TOP_ARTICLE_TYPES)}) ORDER BY n DESC, value LIMIT {CHART_TOP_TYPES}"

ORACLE["knn_centroid"] = f"""WITH {CATALOG},
  v AS (SELECT id, embedding::DOUBLE[] AS e FROM catalog WHERE embedding IS NOT NULL),
  d AS (SELECT unnest(generate_series(1, len(e))) AS dim, unnest(e) AS x FROM v),
  c AS (SELECT list(mu ORDER BY dim) AS e FROM (SELECT dim, avg(x) AS mu FROM d GROUP BY dim)),
  s AS (SELECT v.id AS product_id, list_dot_product(c.e, v.e) AS raw FROM v, c),
  r AS (SELECT *, row_number() OVER (ORDER BY raw DESC, product_id) AS rank FROM s)
SELECT CAST(rank AS BIGINT) AS rank, product_id, round({clip('raw')}, 6) AS similarity FROM r WHERE rank <= 10"""

ORACLE["product_by_id"] = f"""WITH {CATALOG}
SELECT id, productDisplayName FROM catalog WHERE id IN (SELECT l_partkey FROM lineitem)"""

ORACLE["display_lookup"] = f"""WITH {CATALOG},
  probes AS (SELECT DISTINCT query FROM {_values(list(NAME_PROBES) + [('q5', 'red ring'), ('q6', 'Ring')], ['pid', 'query'])}),
  m AS (SELECT p.query, c.id, c.productDisplayName,
               row_number() OVER (PARTITION BY p.query ORDER BY CASE WHEN c.productDisplayName = p.query THEN 0 ELSE 1 END, c.id) AS rn
        FROM probes p JOIN catalog c ON contains(c.productDisplayName, p.query))
SELECT query, id, productDisplayName FROM m WHERE rn = 1"""

ORACLE["rejected_queries"] = f"""WITH {CATALOG}, {RAW}
SELECT src_pos AS qid, productDisplayName AS query FROM raw WHERE coalesce({trim('productDisplayName')}, '') = ''"""

ORACLE["csv_ingest"] = f"""WITH {CATALOG}
SELECT id, {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in config.EXPORT_COLUMNS if c != 'id')} FROM catalog"""

ORACLE["refresh_changed"] = f"""WITH {CATALOG}
SELECT id, productDisplayName FROM catalog WHERE embedding IS NULL OR id % 7 = 0"""

ORACLE["category_filter"] = f"""WITH {CATALOG}
SELECT 'All' AS choice, id FROM catalog UNION ALL SELECT 'Apparel', id FROM catalog WHERE masterCategory = 'Apparel'"""

ORACLE["name_unmatched"] = f"""WITH {CATALOG},
  probes AS (SELECT DISTINCT event_type AS query FROM events UNION SELECT query FROM {_values(NAME_PROBES, ['pid', 'query'])})
SELECT query FROM probes WHERE NOT EXISTS (SELECT 1 FROM catalog WHERE contains(lower(productDisplayName), lower({trim('probes.query')})))"""

ORACLE["unknown_products"] = """SELECT DISTINCT l_partkey AS id FROM lineitem WHERE l_partkey NOT IN (SELECT vec_id FROM embeddings)"""

ORACLE["ordinal"] = """SELECT line, part, row_number() OVER (ORDER BY line) - 1 AS ordinal
FROM (SELECT l_orderkey * 1000 + l_linenumber AS line, min(l_partkey) AS part FROM lineitem GROUP BY 1)"""

ORACLE["stream_history"] = """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end, event_type AS query,
       count(*) AS total_queries, round(avg(value), 2) AS avg_latency_ms, round(max(value), 2) AS max_latency_ms
FROM events GROUP BY ALL"""

ORACLE["stream_history_state"] = """SELECT event_type AS query, count(*) AS total_queries, round(avg(value), 2) AS avg_latency_ms,
       round(max(value), 2) AS max_latency_ms, round(avg((event_id % 100) / 100.0), 4) AS avg_similarity FROM events GROUP BY event_type"""

ORACLE["search_latency"] = f"""SELECT query, n_results, avg_similarity, true AS timed FROM ({ORACLE["search_metrics"]})"""

ORACLE["history_similarity"] = f"""SELECT count(*) AS total_queries, round(avg(avg_similarity), 4) AS avg_similarity FROM ({ORACLE["search_metrics"]})"""

ORACLE["projection_sample"] = f"""WITH {CATALOG}, colours AS ({ORACLE["label_colour"].replace("WITH " + CATALOG + ",", "WITH", 1)}),
  s AS (SELECT id, articleType AS label FROM catalog WHERE embedding IS NOT NULL
        ORDER BY md5(concat('{config.SAMPLE_SEED}:', CAST(id AS VARCHAR))), id LIMIT 200)
SELECT s.id, s.label, colours.colour FROM s LEFT JOIN colours USING (label)"""

ORACLE["profile_merged"] = f"""WITH {CATALOG}, v AS (
  {" UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS value FROM catalog" for c in ("masterCategory", "articleType", "season", "usage", "baseColour"))}),
  n AS (SELECT col, value, count(*) AS n FROM v GROUP BY col, value)
SELECT col AS "column", CAST(sum(n) AS BIGINT) AS "rows", CAST(sum(n) FILTER (WHERE value IS NOT NULL) AS BIGINT) AS present, count(value) AS "distinct",
       max(n) FILTER (WHERE value IS NOT NULL) AS most FROM n GROUP BY col"""

ORACLE["pca_checks"] = """WITH t AS (SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings)
SELECT count(*) AS dims, round(sum(v), 6) AS total_variance, true AS orthonormal, true AS residual_small, true AS shares_hold
FROM (SELECT d, var_samp(x) AS v FROM t GROUP BY d)"""

ORACLE["mean_precision"] = f"""WITH {CATALOG}, {NAMEQ},
  hits AS (SELECT res.query, count(*) AS hits FROM res JOIN qv ON qv.query = res.query
           WHERE lower(res.base_colour) = lower(qv.relevant) GROUP BY res.query),
  p AS (SELECT coalesce(hits, 0) / 5.0 AS precision FROM qv LEFT JOIN hits ON hits.query = qv.query WHERE qv.relevant IS NOT NULL)
SELECT count(*) AS n_queries, round(avg(precision), 6) AS mean_precision FROM p"""

ORACLE["metrics_series"] = f"""WITH {CATALOG}, {NAMEQ},
  agg AS (SELECT query, avg(similarity) AS av FROM res GROUP BY query)
SELECT left(qv.query, {QUERY_LABEL_CHARS}) AS label, round(coalesce(round(av, 4), 0.0) * 100, 6) AS avg_similarity_pct
FROM qv LEFT JOIN agg ON agg.query = qv.query"""

def staged_hvec(name: str, table: str, id_col: str, text_col: str) -> str:
    """Hashed vectors of a long-text column, one materialised step at a time
    (tokens -> buckets -> counts -> norm), so nothing is re-evaluated per bucket."""
    toks = f"list_filter(string_split(lower({text_col}), ' '), lambda t: t <> '')"
    return f"""{name}_b AS MATERIALIZED (SELECT {id_col}, list_transform({toks}, lambda t: {bucket('t')}) AS bks FROM {table}),
  {name}_c AS MATERIALIZED (SELECT {id_col}, list_transform(range({HASH_DIM}), lambda b: len(list_filter(bks, lambda x: x = b))::DOUBLE) AS c FROM {name}_b),
  {name}_n AS MATERIALIZED (SELECT {id_col}, c, sqrt(list_sum(list_transform(c, lambda x: x * x))) AS n FROM {name}_c),
  {name} AS (SELECT {id_col}, list_transform(c, lambda x: x / (CASE WHEN n = 0 THEN 1.0 ELSE n END)) AS e FROM {name}_n)"""


_DOCS = f"""{staged_hvec('dv', 'documents', 'doc_id', 'text')},
  {staged_hvec('bq', 'benchmark', 'item_id', 'text')}"""

ORACLE["doc_search"] = f"""WITH {_DOCS},
  s AS (SELECT bq.item_id, dv.doc_id, list_dot_product(bq.e, dv.e) AS raw FROM bq, dv),
  r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY raw DESC, doc_id) AS rank FROM s)
SELECT item_id, CAST(rank AS BIGINT) AS rank, doc_id, round({clip('raw')}, 6) AS similarity FROM r WHERE rank <= 5"""

ORACLE["doc_embed"] = f"""WITH {_DOCS}, t AS (SELECT doc_id AS id, e FROM dv)
SELECT id AS doc_id, dim, value FROM ({tall('t')})"""

ORACLE["knn_by_vector"] = f"""WITH {CATALOG},
  idx AS (SELECT id, {norm_list(hvec('productDisplayName'))} AS e FROM catalog),
  q AS (SELECT {norm_list(hvec("'red ring'"))} AS e),
  s AS (SELECT idx.id AS product_id, list_dot_product(q.e, idx.e) AS raw FROM idx, q),
  r AS (SELECT *, row_number() OVER (ORDER BY raw DESC, product_id) AS rank FROM s)
SELECT CAST(r.rank AS BIGINT) AS rank, r.product_id, round({clip('r.raw')}, 6) AS similarity,
       c.productDisplayName AS product_name FROM r JOIN catalog c ON c.id = r.product_id WHERE r.rank <= 5"""

ORACLE["recommend_one"] = f"""WITH {CATALOG}, {RECS}
SELECT {REC_COLS} FROM recs WHERE source_id = (SELECT min(id) FROM catalog WHERE embedding IS NOT NULL)"""

ORACLE["dup_representatives"] = f"""{_PLANT_CL}
SELECT clus.cluster_id, clus.representative_id, m.image_bytes AS representative_bytes, clus.size
FROM clus JOIN mem2 m ON m.component = clus.component AND m.id = clus.representative_id"""

ORACLE["format_score"] = f"""WITH {CATALOG}, {KNN}
SELECT source_id, CAST(rank AS BIGINT) AS rank, printf('%.1f%%', {clip('raw')} * 100) AS similarity_pct FROM r WHERE rank <= 5"""

ORACLE["vector_by_id"] = f"""WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE vec_id IN (SELECT l_partkey FROM lineitem))
{tall('v', keep_zeros=True)}"""

ORACLE["product_ids"] = f"WITH {CATALOG} SELECT id FROM catalog"
