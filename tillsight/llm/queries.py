"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm import chat
from tillsight.llm.base import table
from tillsight.llm.decontaminate import leaks
from tillsight.llm.html_extract import extract
from tillsight.llm.line_runs import drop_frequent_lines
from tillsight.llm.merkle import manifest
from tillsight.llm.mixing import mix
from tillsight.llm.ngram_join import near_duplicates
from tillsight.llm.quality import select_quality
from tillsight.llm.ranked_search import ranked_search
from tillsight.llm.token_files import read_tokens, write_tokens
from tillsight.llm.topk_search import top_k
from tillsight.llm.toxicity import HELD_OUT, fit_toxicity
from tillsight.llm.url_rules import judge
from tillsight.session import new_path

URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    found = extract(table(spark, folder, "pages", "page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), width=3, num=9, den=10).select(
        "doc_id", "n_shingles", "component_id")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    slim = drop_frequent_lines(table(spark, folder, "documents", "doc_id", "text"), min_docs=10)
    return slim.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "lang", "text")
    model = fit_toxicity(docs, table(spark, folder, "labels"))
    limit = model.threshold(F.col("lang"))
    return model.score(docs).select(
        "doc_id", F.expr(f"coalesce({HELD_OUT}, false)").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), limit.alias("lang_threshold"),
        (F.col("score") >= limit).alias("toxic_in_lang"))


def op7_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], turns.schema)
    back = chat.read_back(chat.examples(turns.unionByName(control)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("replies", "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length(learnt).cast("bigint").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"), "formatted_chars")


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return select_quality(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "labels"))


def op9_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), k=5, every=50, scale=256)


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    found = judge(table(spark, folder, "pages", "page_id", "url"), rules)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "tokens")
    docs = table(spark, folder, "documents", "doc_id", "text")
    write_tokens(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return manifest(docs, shown={"text": tampered})


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark"), k=10)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontaminate, op2_html_extract, op3_ngram_join, op4_line_dedup, op5_mix_sources, op6_toxicity,
        op7_chat_format, op8_quality, op9_topk_search, op10_url_filter, op11_token_files,
        op12_merkle_manifest, op13_ranked_search, pipeline)
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

def _encoded(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column} END"


_FIELDS = " || ".join(_encoded(c) for c in ("doc_id", "source", "lang", "n_chars"))

ORACLE: dict[str, str] = {
    "op3_ngram_join": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS g FROM w),
n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY w.doc_id),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (
  SELECT doc_id AS root, doc_id FROM w
  UNION SELECT r.root, d.b FROM reach r JOIN both_ways d ON d.a = r.doc_id)
SELECT n.doc_id, n.n AS n_shingles, min(r.root) AS component_id
FROM n JOIN reach r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n""",
    "op4_line_dedup": f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (f.key IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY doc_id""",
    "op5_mix_sources": rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS spin FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
p AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM t),
w AS (SELECT *, [3, 1, 2][place % 3 + 1] AS weight FROM p),
r AS (
  SELECT *, coalesce(sum(2 * source_size) OVER before, 0) AS full_words,
    (SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER before, 0) AS open_weight
  FROM w WINDOW before AS (ORDER BY 2 * source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (
  SELECT arg_min((1.5::DOUBLE * (SELECT sum(source_size) FROM w) - full_words) / open_weight,
    (2 * source_size / weight, place)) AS level FROM r
  WHERE (1.5::DOUBLE * (SELECT sum(source_size) FROM w) - full_words) / open_weight * weight <= 2 * source_size),
g AS (
  SELECT source, place, source_size, least(level * weight, CAST(2 * source_size AS DOUBLE)) AS target FROM w, v),
u AS (
  SELECT doc_id, size, spin, g.place, g.source_size, g.target,
    sum(size) OVER (PARTITION BY g.place ORDER BY spin, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
c AS (
  SELECT *, CASE WHEN target > 0 THEN CAST(upto + e * source_size AS DOUBLE) / target ELSE 0 END AS finish
  FROM u, (SELECT unnest([0, 1]) AS e)),
q AS (
  SELECT *, sum(size) OVER (ORDER BY finish, place, upto, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS total
  FROM c)
SELECT doc_id, size, source_size, target,
  CAST(sum(CASE WHEN total <= 1.5::DOUBLE * (SELECT sum(source_size) FROM w) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM q GROUP BY doc_id, size, source_size, target, place""",
    "op7_chat_format": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '{CONTROL_TEXT}'), (-7, 1, 'assistant', '{CONTROL_TEXT}'))),
f AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n,
    count(*) OVER (PARTITION BY conv_id) AS n_turns,
    12 + length(replace(replace(replace(replace(role, '\\', '\\s'), '<', '\\l'), '[', '\\b'), chr(10), '\\n')) + 1
    + length(replace(replace(replace(text, '\\', '\\s'), '<', '\\l'), '[', '\\b')) + 11 AS chars FROM t),
g AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS upto FROM f)
SELECT conv_id, n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (role = 'assistant' OR n = n_turns) AS BIGINT) AS formatted_chars
FROM g GROUP BY conv_id, n_turns""",
    "op9_topk_search": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM p)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5""",
    "op10_url_filter": f"""
WITH rules(rule_host, rule_path, judged) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, regexp_extract(coalesce(rest, ''), '^([^/?#]*)([^?#]*)', 1) AS raw,
    regexp_extract(coalesce(rest, ''), '^([^/?#]*)([^?#]*)', 2) AS path FROM u),
k AS (SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host, path FROM h),
m AS (
  SELECT page_id, rule_host || rule_path AS rule, judged FROM k JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, rule_host) = 1)
SELECT k.page_id, k.host, k.path, m.rule, coalesce(m.judged, 'allow') AS verdict
FROM k LEFT JOIN m ON m.page_id = k.page_id""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
d AS (
  SELECT *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 2 = 0 AS even FROM documents, crc),
h AS (
  SELECT doc_id, coalesce('=' || source, '') AS grp, sha256({_FIELDS} || {_encoded("text")}) AS leaf,
    CASE WHEN even THEN sha256({_FIELDS} || {_encoded("replace(text, chr(10), '')")}) END AS other FROM d),
p AS (
  SELECT doc_id, grp, leaf, coalesce(other, leaf) AS shown, row_number() OVER () AS r,
    row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, shown) - 1 AS idx,
    count(*) OVER (PARTITION BY grp) AS n FROM h),
nodes AS (
  SELECT 0 AS level, grp, idx, leaf AS digest, n FROM p
  UNION ALL SELECT level + 1, grp, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY level, grp, idx // 3, n),
subroots AS (
  SELECT grp, level AS height, digest AS subroot, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS groups
  FROM nodes WHERE n = 1),
upper AS (
  SELECT 0 AS level, place AS idx, subroot AS digest, groups AS n FROM subroots
  UNION ALL SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
  FROM upper WHERE n > 1 GROUP BY level, idx // 3, n),
steps AS (
  SELECT r, m.level AS step, m.idx < p.idx // (3 ** m.level)::BIGINT AS is_left, m.idx, m.digest
  FROM p JOIN nodes m ON m.grp = p.grp AND m.n > 1 AND m.idx // 3 = p.idx // (3 ** (m.level + 1))::BIGINT
    AND m.idx <> p.idx // (3 ** m.level)::BIGINT
  UNION ALL
  SELECT r, height + m.level, m.idx < place // (3 ** m.level)::BIGINT, m.idx, m.digest
  FROM p JOIN subroots USING (grp) JOIN upper m ON m.n > 1 AND m.idx // 3 = place // (3 ** (m.level + 1))::BIGINT
    AND m.idx <> place // (3 ** m.level)::BIGINT),
sides AS (
  SELECT r, step, coalesce(string_agg(digest, '' ORDER BY idx) FILTER (is_left), '') AS l,
    coalesce(string_agg(digest, '' ORDER BY idx) FILTER (NOT is_left), '') AS f FROM steps GROUP BY r, step),
proofs AS (SELECT r, sha256(string_agg(digest, '' ORDER BY step, idx)) AS proof_sha256 FROM steps GROUP BY r),
top AS (SELECT digest AS root, level AS top_height FROM upper WHERE n = 1),
folds AS (
  SELECT r, 0 AS step, shown AS x, height + top_height AS last FROM p JOIN subroots USING (grp), top
  UNION ALL SELECT folds.r, folds.step + 1, sha256(coalesce(l, '') || x || coalesce(f, '')), last
  FROM folds LEFT JOIN sides ON sides.r = folds.r AND sides.step = folds.step WHERE folds.step < last)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, x AS folded_root,
  x = root AS verified
FROM p JOIN subroots USING (grp) JOIN folds ON folds.r = p.r AND step = last LEFT JOIN proofs ON proofs.r = p.r, top""",
    "op13_ranked_search": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}') AS ts FROM documents),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d WHERE len(ts) > 0),
o AS (SELECT r, doc_id, 10 + (90 * len(ts) * n_docs) // n_terms AS m, unnest(ts) AS t FROM d, s),
tf AS (SELECT r, doc_id, m, t, count(*) AS tf FROM o GROUP BY ALL),
w AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), s),
i AS (SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (
  SELECT DISTINCT i, item_id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS t FROM i),
x AS (
  SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN w USING (t) JOIN tf USING (t) GROUP BY ALL),
k AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS n FROM x WHERE score > 0)
SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, score FROM k WHERE n <= 10""",
}
