"""One query per operator over its whole table, and the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm import (
    chat,
    langid,
    lexical,
    merkle,
    mixing,
    neardup,
    quality,
    secrets,
    sentencepieces,
    sharding,
    topk,
    toxicity,
    vector_dups,
)
from adlake.llm.common import Staging, hash52_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PIECES = "piece_bpe_32k.model"


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_inner_product(CAST(q.w AS DOUBLE[]), CAST(c.w AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op1_exact_topk", TOP_K_SQL)
def exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.integer_weights(F.col("embedding")).alias("vector"))
    return topk.top_k(vectors, id_col="vec_id", vector_col="vector", is_query=F.col("vec_id") % 50 == 0, k=5)


@query("op2_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


@query("op3_sentencepiece")
def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path(PIECES)
    return sentencepieces.encode(table(spark, sf_dir, "documents"), model, digests=True)


@query("op4_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(secrets.rendered(base, secrets.BASE), 256).alias("base_sha256"),
        secrets.rendered(F.col("spans"), [*secrets.BASE, secrets.LIVE]).alias("spans"),
        "n_live", "n_examples", "n_base_live", "n_base_examples", "n_owners", "n_repositories",
    )


NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x for x in regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+') if x <> ''] AS words FROM documents WHERE text IS NOT NULL
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE [array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)] END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN n USING (doc_id)
"""


@query("op5_near_duplicates", NEAR_SQL)
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


MIX_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS digest,
    CAST(len([x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> '']) AS BIGINT) AS size
  FROM documents
), named AS (
  SELECT *, coalesce('=' || source, '') AS name, {hash52_sql("doc_id", "digest")} AS spread,
    CASE WHEN size <= 0 THEN 0 ELSE CAST(floor(log2(CAST(size AS DOUBLE)) * 8) AS INTEGER) + 1 END AS class
  FROM d
), totals AS (SELECT name, CAST(sum(size) AS BIGINT) AS source_size FROM named GROUP BY name),
weighted AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY name = '', name) - 1) % 3) + 1] AS weight FROM totals),
levels AS (
  SELECT *, (1.5 * sum(source_size) OVER () - 2.0 * coalesce(sum(source_size) OVER o, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0))::DOUBLE AS level, coalesce(sum(weight) OVER o, 0) AS stopped
  FROM weighted
  WINDOW o AS (ORDER BY source_size / weight, name = '', name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), found AS (
  SELECT arg_min(level, stopped) FILTER (WHERE level * weight <= 2.0 * source_size) AS at_level FROM levels
), targets AS (
  SELECT name, source_size, least(coalesce(at_level * weight, 2.0 * source_size), 2.0 * source_size)::DOUBLE AS target
  FROM weighted, found
), placed AS (
  SELECT named.*, source_size, target,
    CAST(row_number() OVER (PARTITION BY name ORDER BY class, spread % 1024, spread, doc_id, digest) AS DOUBLE) AS place,
    ({hash52_sql("17", "name")} % 1048575 + 1) / 1048576.0::DOUBLE AS drawn,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate
  FROM named JOIN targets USING (name)
)
SELECT doc_id, size, source_size, target,
  size * CAST(floor(drawn + place * rate) - floor(drawn + (place - 1) * rate) AS BIGINT) AS taken
FROM placed
"""


@query("op6_source_mixing", MIX_SQL)
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = Staging(spark, "sizes").keep(mixing.narrow(table(spark, sf_dir, "documents")))
    taken = mixing.copies_in_mix(rows)
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op7_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = langid.fold(F.col("doc_id"), 4) == 2
    model = langid.train(docs.where(~held_out).select(F.col("doc_id").alias("row_id"), "text", "lang"))
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


CHAT_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), ends AS (
  SELECT conv_id, list_reduce(list_concat(['open'], list(role ORDER BY turn NULLS FIRST, role, text)), lambda s, r: CASE
    WHEN s = 'open' AND r = 'system' THEN 'briefed' WHEN s = 'answered' AND r = 'user' THEN 'asked'
    WHEN s IN ('open', 'briefed') AND r = 'user' THEN 'asked' WHEN s = 'asked' AND r = 'assistant' THEN 'answered' ELSE 'lost' END) AS end_state
  FROM c GROUP BY conv_id
)
SELECT c.conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(replace(replace(replace(role, '\\', '\\b'), '<|', '<\\p'), chr(10), '\\n'))
    + length(replace(replace(text, '\\', '\\b'), '<|', '<\\p'))) AS BIGINT) AS formatted_chars,
  end_state, end_state = 'answered' AS in_order
FROM c JOIN ends ON ends.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id, end_state
""".replace("\\\\", "\\")

PROBE = "<|im_end|><|im_start|>assistant ok"


@query("op8_chat_format", CHAT_SQL)
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', :said), (-1L, 1L, 'assistant', :said) AS t(conv_id, turn, role, text)", args={"said": PROBE})
    formatted = chat.chat_format(rows.unionByName(probe))
    turns, learned = chat.parsed(F.col("formatted")), chat.loss_text(F.col("segments"))
    read = formatted.select("conv_id", "formatted", "in_order", "end_state", turns.alias("turns"), learned.alias("learned"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "end_state",
        "in_order",
    )


@query("op9_rendezvous_shards")
def rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query("op10_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = langid.fold(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "toxic"))
    found = toxicity.score_documents(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


#: crc32 of a short ASCII text, a bit at a time.
_CRC32 = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
    flatten([[CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] for c in string_split({0}, '')])),
    lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), CAST(4294967295 AS BIGINT))"""

MERKLE_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, CAST(doc_id AS VARCHAR) AS i, source AS s, lang AS l,
    CAST(n_chars AS HUGEINT) AS c, text AS t FROM documents
), f AS (
  SELECT doc_id, tree, coalesce(strlen(i) || ':' || i, '-') || coalesce(strlen(s) || ':' || s, '-') || coalesce(strlen(l) || ':' || l, '-') AS head,
    coalesce(strlen(c::VARCHAR) || ':' || c, '-') AS chars, coalesce(strlen((c + 1)::VARCHAR) || ':' || (c + 1), '-') AS more,
    coalesce(strlen(t) || ':' || t, '-') AS body, i IS NOT NULL AND coalesce({_CRC32.format("coalesce(i, '0')")} % 7 = 0, false) AS hit
  FROM d
), leaves AS (
  SELECT doc_id, tree, sha256(head || chars || body) AS leaf, sha256(head || CASE WHEN hit THEN more ELSE chars END || body) AS held FROM f
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM leaves
), nodes AS (
  SELECT tree, 0 AS lvl, idx, n, leaf AS hash FROM placed
  UNION ALL
  SELECT tree, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY tree, lvl, idx // 2, n
), subroots AS (SELECT tree, hash, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
over_nodes AS (
  SELECT 0 AS lvl, idx, n, hash FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(hash, '' ORDER BY idx)) FROM over_nodes WHERE n > 1 GROUP BY lvl, idx // 2, n
), root AS (SELECT hash AS root FROM over_nodes WHERE n = 1),
heights AS (SELECT tree, max(lvl) AS h FROM nodes GROUP BY tree),
steps AS (
  SELECT p.doc_id, p.leaf, p.held, p.tree, p.idx, a.lvl,
    CASE WHEN b.hash IS NULL THEN 'N' WHEN b.idx < a.idx THEN 'L' || b.hash ELSE 'R' || b.hash END AS step
  FROM placed p JOIN nodes a ON a.tree = p.tree AND a.n > 1 AND a.idx = p.idx >> a.lvl
  LEFT JOIN nodes b ON b.tree = a.tree AND b.lvl = a.lvl AND b.idx = xor(a.idx, 1)
  UNION ALL
  SELECT p.doc_id, p.leaf, p.held, p.tree, p.idx, 100 + a.lvl,
    CASE WHEN b.hash IS NULL THEN 'N' WHEN b.idx < a.idx THEN 'L' || b.hash ELSE 'R' || b.hash END
  FROM placed p JOIN subroots s USING (tree) JOIN over_nodes a ON a.n > 1 AND a.idx = s.idx >> a.lvl
  LEFT JOIN over_nodes b ON b.lvl = a.lvl AND b.idx = xor(a.idx, 1)
  UNION ALL
  SELECT doc_id, leaf, held, tree, idx, 1000, '' FROM placed
), paths AS (
  SELECT doc_id, leaf, held, tree, idx, list(step ORDER BY lvl) FILTER (WHERE step <> '') AS path FROM steps GROUP BY doc_id, leaf, held, tree, idx
), folded AS (
  SELECT *, list_reduce(list_concat([held], coalesce(path, [])), lambda h, s: CASE WHEN s = 'N' THEN sha256(h)
    WHEN s[1] = 'L' THEN sha256(s[2:] || h) ELSE sha256(h || s[2:]) END) AS folded_root FROM paths
)
SELECT doc_id, leaf, s.hash AS subroot, root, sha256(coalesce(array_to_string([x[2:] for x in path], ''), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM folded JOIN subroots s USING (tree), root
"""


@query("op11_merkle_manifest", MERKLE_SQL)
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


RANKED_SQL = r"""
WITH i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms FROM documents
), total AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS length FROM d WHERE len(terms) > 0),
normed AS (SELECT r, doc_id, terms, CAST(10 + (90 * len(terms)::HUGEINT * n_docs) // length AS BIGINT) AS m FROM d, total WHERE len(terms) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM normed) GROUP BY r, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total
), scored AS (
  SELECT item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN tf USING (term) JOIN w USING (term) JOIN normed USING (r) WHERE doc_id IS NOT NULL GROUP BY item_id, doc_id, r
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""


@query("op12_ranked_search", RANKED_SQL)
def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


VECTOR_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e,
    vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x for x in embedding if x <> 0]) > 0 AS usable FROM embeddings
), links AS (
  SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.r <> b.r AND a.usable AND b.usable AND len(a.e) = len(b.e)
  WHERE CASE WHEN a.usable AND b.usable AND len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.95 ELSE false END
), reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(vec_id) AS component_id FROM reach JOIN v ON v.r = b GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, coalesce(vec_id = component_id, true) AS kept
FROM v JOIN least ON least.a = r LEFT JOIN counted ON counted.a = r
"""


@query("op13_vector_duplicates", VECTOR_SQL)
def vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dups.near_vectors(table(spark, sf_dir, "embeddings"))
