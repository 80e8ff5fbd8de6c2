"""Registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import boilerplate, chat, decontam, lm, merkle, outliers, packing, pii, quality, sharding, simhash, tokens, whitening
from gridloom.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_hidden_markov_scores")
def hidden_markov_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(documents(spark, sf_dir))


@query("op2_disclosure_spans")
def disclosure_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.PATTERNS))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in pii.PATTERNS],
        F.sha2(pii.span_text(base), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
    )


@query("op3_rule_ensemble")
def rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op4_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


@query("op5_robust_outliers")
def robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.judge(documents(spark, sf_dir))


@query("op7_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


@query("op8_simhash_near_copies")
def simhash_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query("op9_shard_tree")
def shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = sharding.tree(regions=3, racks=4, shards=2)
    placed = sharding.shard_documents(documents(spark, sf_dir), root, sharding.grown(root, 24))
    return placed.withColumn("law", F.lit("key"))


@query("op10_latent_decontamination")
def latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


CHAT_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM given),
e AS (SELECT *, replace(replace(replace(role, '\', '\b'), '<', '\l'), '>', '\g') AS r,
  replace(replace(replace(text, '\', '\b'), '<', '\l'), '>', '\g') AS x FROM t),
g AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
  sum(length(r) + length(x) + 15) AS formatted FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  formatted::BIGINT AS formatted_chars FROM g
"""


@query("op6_reply_trees", CHAT_SQL)
def reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    both = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", both), (-7, 1, "assistant", both)], told.schema)
    done = chat.format_conversations(told.unionAll(extra))
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


MANIFEST_SQL = r"""
WITH RECURSIVE given AS (
  SELECT doc_id, source, lang, n_chars, text,
    coalesce(list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
      lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384)), 0) AS crc FROM documents),
leaves AS (
  SELECT doc_id, lang, xor(crc, 4294967295) % 7 = 0 AND doc_id IS NOT NULL AND n_chars IS NOT NULL AS touched,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS chars, coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS more,
    coalesce(strlen(text) || ':' || text, '-') AS body FROM given),
hashed AS (
  SELECT doc_id, coalesce(':' || lang, '-') AS tree, sha256(head || chars || body) AS leaf,
    sha256(head || CASE WHEN touched THEN more ELSE chars END || body) AS fresh FROM leaves),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
lower_nodes AS (
  SELECT tree, 0 AS level, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM lower_nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n),
subroots AS (SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM lower_nodes WHERE n = 1),
upper_nodes AS (
  SELECT 0 AS level, pos, n, h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM upper_nodes WHERE n > 1 GROUP BY level, pos // 2, n),
heights AS (SELECT tree, max(level) AS height FROM lower_nodes GROUP BY tree),
-- one tree: the nodes of a language below, those above its root on top of them
siblings AS (
  SELECT tree, level, pos, h FROM lower_nodes WHERE n > 1
  UNION ALL
  SELECT s.tree, height + level, u.pos, u.h FROM upper_nodes u JOIN subroots s ON (s.pos >> level) = (u.pos - u.pos % 2) OR (s.pos >> level) = (u.pos - u.pos % 2) + 1
    JOIN heights USING (tree) WHERE u.n > 1),
climb AS (
  SELECT p.tree, p.doc_id, p.pos AS leaf_pos, 0 AS level, p.pos, p.fresh AS h, '' AS proof FROM placed p
  UNION ALL
  SELECT c.tree, c.doc_id, c.leaf_pos, c.level + 1, (CASE WHEN c.level + 1 = t.height THEN s.pos ELSE c.pos // 2 END),
    sha256(CASE WHEN c.pos % 2 = 0 THEN c.h || coalesce(o.h, '') ELSE o.h || c.h END), c.proof || coalesce(o.h, '')
  FROM climb c JOIN heights t USING (tree) JOIN subroots s USING (tree)
    LEFT JOIN siblings o ON o.tree = c.tree AND o.level = c.level AND o.pos = xor(c.pos, 1)
  WHERE c.level < t.height + (SELECT max(level) FROM upper_nodes)),
done AS (
  SELECT c.tree, c.leaf_pos AS pos, c.h, c.proof FROM climb c JOIN heights t USING (tree)
  WHERE c.level = t.height + (SELECT max(level) FROM upper_nodes))
SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, sha256(d.proof) AS proof_sha256, d.h AS folded_root, d.h = r.h AS verified
FROM placed p JOIN done d USING (tree, pos) JOIN subroots s USING (tree) CROSS JOIN (SELECT h FROM upper_nodes WHERE n = 1) r
"""


@query("op11_merkle_manifest", MANIFEST_SQL)
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.prove(documents(spark, sf_dir))


@query("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op13_host_boilerplate")
def host_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
