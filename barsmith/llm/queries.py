"""The registered queries opN_<name>, each with its SQL where SQL can express it."""

import public_tokenizers
from pyspark.sql import functions as F

from barsmith.llm import bpe, chat, decontaminate, html_text, kneser_ney, lexical, merkle, mixing, ngram_join, suffix_dedup, topk, toxicity, url_rules
from barsmith.llm.arrays import tuned
from barsmith.session import configure, ship

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark, sf_dir):
            return build(tuned(ship(configure(spark))), lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build
    return register


_CURATED = " UNION ALL ".join(f"SELECT '{h}' rh, '{p}' rp, '{v}' rv" for h, p, v in url_rules.CURATED)
URL_SQL = rf"""
WITH parts AS (
  SELECT row_number() OVER () AS rid, page_id, url,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
split AS (
  SELECT rid, page_id, url, coalesce(rest, '') AS rest,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{url_rules.UPPER}', '{url_rules.LOWER}'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM parts),
curated AS ({_CURATED}),
hits AS (
  SELECT rid, max_by(rh || rp, length(rh || rp)) AS rule, max_by(rv, length(rh || rp)) AS rv
  FROM split JOIN curated ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY rid),
judged AS (
  SELECT s.*, rule, rv, string_split(host, '.') AS l FROM split s LEFT JOIN hits USING (rid)),
raw AS (
  SELECT rid, page_id, host, path, rule, rv, CASE WHEN host = '' THEN [] ELSE list_distinct(list_filter(list_concat(
    ['scheme=' || regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1), 'tld=' || l[-1],
     'last=' || regexp_replace(regexp_extract(path, '([^/]*/?)$', 1), '[0-9]+', '0', 'g'),
     'query=' || regexp_replace(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '=[^&]*', '', 'g'),
     'frag=' || regexp_extract(rest, '(?s)#(.+)$', 1)],
    list_transform(l[1:len(l) - 1], lambda x: 'label=' || x),
    list_transform(string_split(regexp_extract(path, '(?s)^(.*)/', 1), '/'), lambda x: 'seg=' || x)),
    lambda t: t NOT IN ('scheme=', 'tld=', 'last=', 'query=', 'frag=', 'label=', 'seg='))) END AS t FROM judged),
need AS (SELECT ceil({url_rules.MIN_SUPPORT} * count(*)) AS c, count(*) AS n FROM raw WHERE rv IS NOT NULL),
cover AS (SELECT token, list(rid ORDER BY rid) AS seen FROM (SELECT rid, unnest(t) AS token FROM raw WHERE rv IS NOT NULL) GROUP BY token),
class AS (SELECT token, min(token) OVER (PARTITION BY seen) AS item FROM cover, need WHERE len(seen) >= need.c),
classed AS (
  SELECT rid, list_sort(list(DISTINCT item)) AS t FROM (SELECT rid, unnest(t) AS token FROM raw) JOIN class USING (token) GROUP BY rid),
tok AS (
  SELECT raw.* EXCLUDE (t), coalesce(classed.t, []) AS t FROM raw LEFT JOIN classed USING (rid)),
bits AS (SELECT unnest(range(1, 1 << (SELECT max(len(t)) FROM tok))) AS m),
sets AS (
  SELECT list_sort(list_filter(t, lambda x, i: (m >> (i - 1)) & 1 = 1)) AS a, rv, m
  FROM tok, bits WHERE rv IS NOT NULL AND m < (1 << len(t))),
ante AS (SELECT a, count(*) AS n FROM sets GROUP BY a),
both_ AS (SELECT a, rv, count(*) AS n FROM sets GROUP BY a, rv),
rules AS (
  SELECT b.a, b.rv, b.n::DOUBLE / ante.n::DOUBLE AS conf, b.n::DOUBLE / need.n AS sup
  FROM both_ b JOIN ante USING (a), need WHERE b.n >= need.c AND b.n::DOUBLE / ante.n::DOUBLE >= {url_rules.MIN_CONFIDENCE}),
pruned AS (
  SELECT * FROM rules r WHERE NOT EXISTS (SELECT 1 FROM rules g WHERE g.rv = r.rv AND g.conf >= r.conf
    AND len(g.a) < len(r.a) AND len(list_intersect(g.a, r.a)) = len(g.a))),
fired AS (
  SELECT rid, min(row(-conf, -sup, len(a), array_to_string(a, ' '), p.rv)) AS b
  FROM tok JOIN pruned p ON len(list_intersect(p.a, t)) = len(p.a) WHERE tok.rv IS NULL GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(rv, b[5], '{url_rules.DEFAULT}') AS verdict, b[4] AS because
FROM tok LEFT JOIN fired USING (rid)"""


@query("op1_url_filter", URL_SQL)
def op1(spark, table):
    return url_rules.filter_urls(table("pages"))


@query("op2_toxicity")
def op2(spark, table):
    return toxicity.score_documents(table("documents"), table("labels"))


@query("op3_decontaminate")
def op3(spark, table):
    return decontaminate.contaminated(table("documents"), table("benchmark"))


@query("op4_kneser_ney")
def op4(spark, table):
    return kneser_ney.score_documents(table("documents"))


@query("op5_suffix_dedup")
def op5(spark, table):
    return suffix_dedup.dedup(table("documents"), keep_text=False).drop("kept", "kept_text")


@query("op6_byte_bpe")
def op6(spark, table):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(table("documents"), path, public_tokenizers.PATTERN, keep_ids=False).drop("ids")


CHAT_SQL = rf"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
c AS (
  SELECT conv_id, list(row(role, text) ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS l,
    list(CAST(floor(coalesce(turn, 0) / {chat.SPAN}) AS BIGINT) ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS s,
    count(*) AS n FROM t GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, l, any_value(s) AS s, any_value(n) AS n, count(*) AS copies FROM c GROUP BY l),
kept AS (
  SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM u o WHERE o.n > u.n AND o.l[1] = u.l[1] AND o.l[1:u.n] = u.l)),
x AS (SELECT conv_id, n, copies, unnest(l) AS r, unnest(s) AS part, unnest(range(1, n + 1)) AS pos FROM kept)
SELECT conv_id, part, n AS n_turns, copies,
  string_agg('<|im_start|>' || replace(coalesce(r[1], 'user'), '<|', '< |') || chr(10)
    || replace(coalesce(r[2], ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM x GROUP BY conv_id, part, n, copies"""


@query("op7_chat_format", CHAT_SQL)
def op7(spark, table):
    return chat.format_chats(table("conversations"))


@query("op8_ngram_join")
def op8(spark, table):
    return ngram_join.join_documents(table("documents"))


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 20 = 0) q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""


@query("op9_exact_top_k", TOPK_SQL)
def op9(spark, table):
    vectors = table("embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0)


@query("op10_html_text")
def op10(spark, table):
    return html_text.extract(table("pages"))


MIX_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{mixing.WORD}')), 0) AS size,
    CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n, {list(map(float, mixing.CYCLE))}[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
r AS (SELECT *, 2.0 * n AS cap, row_number() OVER (ORDER BY 2.0 * n / w, source) AS k FROM s WHERE n > 0),
-- with the first k sources clamped: words placed, weight free, level of the others
lv AS (
  SELECT 0 AS k, 0.0 AS placed, sum(w) AS free FROM r
  UNION ALL SELECT k, sum(cap) OVER (ORDER BY k), sum(w) OVER () - sum(w) OVER (ORDER BY k) FROM r),
b AS (SELECT {mixing.SHARE} * sum(n) AS budget FROM s),
level AS (
  SELECT placed, free, CASE WHEN free > 0 THEN (budget - placed) / free END AS level FROM lv, b
  WHERE free = 0 OR NOT EXISTS (SELECT 1 FROM r WHERE r.k > lv.k AND r.cap < r.w * (budget - placed) / free)
  ORDER BY lv.k LIMIT 1),
t AS (
  SELECT source, n, CASE WHEN n = 0 THEN 0.0 WHEN free = 0 OR cap < w * level THEN cap
    ELSE least(cap, w * (budget - placed) / free) END AS target FROM (SELECT *, 2.0 * n AS cap FROM s), level, b),
x AS (SELECT *, CASE WHEN n > 0 THEN CAST(floor(target / n) AS BIGINT) ELSE 0 END AS whole, CAST(floor(target) AS BIGINT) AS goal FROM t),
e AS (
  SELECT source, h, sum(size) AS here, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) - sum(size) AS before FROM d GROUP BY source, h)
SELECT doc_id, size, n AS source_size, target, d.source,
  CAST(whole * size + CASE WHEN here = 0 THEN 0
    ELSE greatest(0, least(here, goal - whole * n - before)) * size // here END AS BIGINT) AS taken
FROM d JOIN x ON x.source IS NOT DISTINCT FROM d.source
JOIN e ON e.source IS NOT DISTINCT FROM d.source AND e.h = d.h"""


@query("op12_mix_sources", MIX_SQL)
def op12(spark, table):
    return mixing.mix(table("documents"))


RANK_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS l
  FROM documents),
c AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(l)) AS BIGINT) AS n_terms FROM d WHERE len(l) > 0),
q AS (
  SELECT DISTINCT item_id, unnest(
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL),
f AS (
  SELECT rid, doc_id, term, CAST(count(*) AS BIGINT) AS tf, any_value(n) AS n
  FROM (SELECT rid, doc_id, CAST(len(l) AS BIGINT) AS n, unnest(l) AS term FROM d) GROUP BY rid, doc_id, term),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM f, c WHERE term IN (SELECT term FROM q) GROUP BY term, n_docs),
s AS (
  SELECT item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN w USING (term), c GROUP BY item_id, rid, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= 10"""


@query("op13_ranked_search", RANK_SQL)
def op13(spark, table):
    return lexical.search_documents(table("documents"), table("benchmark"))


MERKLE_SQL = rf"""
WITH RECURSIVE
crc AS (
  SELECT list(list_reduce([n] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)),
f AS (
  SELECT row_number() OVER () AS rid, *, {" || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in merkle.FIELDS[:-1])} AS head FROM documents),
d AS (
  SELECT rid, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(text) || ':' || translate(text, '{merkle.UPPER}', '{merkle.LOWER}'), '-')) AS new_leaf,
    xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 5 = 0 AS hit
  FROM f, crc),
p AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s
  FROM d),
-- a level per step; a node list per tree
up AS (
  SELECT s, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM p GROUP BY s
  UNION ALL SELECT s, level + 1, list_transform(range(0, len(nodes), {merkle.FAN}),
    lambda i: sha256(array_to_string(list_slice(nodes, i + 1, i + {merkle.FAN}), ''))) FROM up WHERE len(nodes) > 1),
sub AS (SELECT s, nodes[1] AS subroot FROM up WHERE len(nodes) = 1),
top AS (
  SELECT 0 AS level, list(subroot ORDER BY s) AS nodes FROM sub
  UNION ALL SELECT level + 1, list_transform(range(0, len(nodes), {merkle.FAN}),
    lambda i: sha256(array_to_string(list_slice(nodes, i + 1, i + {merkle.FAN}), ''))) FROM top WHERE len(nodes) > 1),
way AS (
  SELECT s, level, 0 AS high, nodes FROM up WHERE len(nodes) > 1
  UNION ALL SELECT sub.s, level, 1, nodes FROM sub, top WHERE len(nodes) > 1),
step AS (
  SELECT rid, row_number() OVER (PARTITION BY rid ORDER BY high, level) AS step,
    CAST((CASE high WHEN 0 THEN pos ELSE p.s END) // CAST(power({merkle.FAN}, level) AS BIGINT) AS BIGINT) AS place, nodes FROM p JOIN way USING (s)),
runs AS (
  SELECT rid, step, array_to_string(list_slice(nodes, place // {merkle.FAN} * {merkle.FAN} + 1, place), '') AS before,
    array_to_string(list_slice(nodes, place + 2, place // {merkle.FAN} * {merkle.FAN} + {merkle.FAN}), '') AS behind FROM step),
proof AS (SELECT rid, sha256(string_agg(before || behind, '' ORDER BY step)) AS proof_sha256, max(step) AS n FROM runs GROUP BY rid),
fold AS (
  SELECT rid, 0 AS step, CASE WHEN hit THEN new_leaf ELSE leaf END AS node FROM p
  UNION ALL SELECT rid, runs.step, sha256(before || node || behind) FROM fold JOIN runs USING (rid) WHERE runs.step = fold.step + 1)
SELECT doc_id, leaf, subroot, root.nodes[1] AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, fold.node AS folded_root,
  fold.node = root.nodes[1] AS verified
FROM p JOIN sub USING (s) JOIN top root ON len(root.nodes) = 1 LEFT JOIN proof USING (rid) JOIN fold ON fold.rid = p.rid AND fold.step = coalesce(n, 0)"""


@query("op11_merkle_manifest", MERKLE_SQL)
def op11(spark, table):
    docs = table("documents")
    return merkle.manifest(docs, merkle.tampered(docs))
