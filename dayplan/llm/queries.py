"""One query per operator over its whole table, and DuckDB SQL where that can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dayplan.llm import (
    chosen_path, deobfuscate, disclosure, factorisation, fair_mix, hard_negatives, labels, neighbours, prefix_trie, secret_scan,
    separators, simple8b, suffix, warc,
)
from dayplan.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return wrap


@query("op1_warc_revisits", """
WITH h AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM k
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives with repeated payloads as revisits, read back and resolved."""
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


_MIX_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5(coalesce(text, '')) AS body FROM {docs}
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS stream
  FROM d GROUP BY source
), lv(step, level) AS (
  SELECT 0, (SELECT sum(source_size)::DOUBLE / sum(w)::DOUBLE FROM s)
  UNION ALL
  SELECT step + 1, ((SELECT sum(source_size) FROM s) - (SELECT coalesce(sum(3.0::DOUBLE * source_size), 0) FROM s
                     WHERE 3.0::DOUBLE * source_size <= w * level))
                   / (SELECT sum(w) FROM s WHERE 3.0::DOUBLE * source_size > w * level)
  FROM lv WHERE step < (SELECT count(*) FROM s)
    AND (SELECT count(*) FROM s WHERE 3.0::DOUBLE * source_size > w * level) > 0
), t AS (
  SELECT source, source_size, stream,
         least(3.0::DOUBLE * source_size, w * (SELECT max(level) FROM lv)) AS target FROM s
), c AS (
  SELECT d.doc_id, d.size, t.stream, t.target, p AS pass, md5('mix:' || p || ':' || coalesce(d.doc_id::VARCHAR, '') || ':' || d.body) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source,
       unnest(range(0, ceil(t.target / greatest(t.source_size, 1))::BIGINT)) AS u(p)
  WHERE d.size > 0
), f AS (
  SELECT *, sum(size) OVER (PARTITION BY stream ORDER BY pass, k, size ROWS UNBOUNDED PRECEDING)::BIGINT / target AS finish
  FROM c
), q AS (
  SELECT *, sum(size) OVER (ORDER BY finish, stream, pass, k, size ROWS UNBOUNDED PRECEDING)::BIGINT AS total FROM f
), b AS (SELECT sum(size)::BIGINT AS budget FROM d), g AS (
  SELECT doc_id, sum(least(size, budget - total + size))::BIGINT AS taken FROM q, b WHERE total - size < budget GROUP BY doc_id
)
SELECT d.doc_id, d.source, d.size, t.source_size, t.target, coalesce(g.taken, 0)::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN g ON d.doc_id = g.doc_id
"""


@query("op4_fair_mix", _MIX_SQL.format(docs="documents"))
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that weighted fair queueing takes of every document."""
    return fair_mix.fair_mix(table(spark, sf_dir, "documents")).drop("key")


@query("op2_separator_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents found by their end ids in flat token files of all texts."""
    return separators.token_counts(table(spark, sf_dir, "documents"))


_WORDS = "regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query("op5_suffix_decontamination", f"""
WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
i AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS win
  FROM i, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS u(p) WHERE len(w) > 0
), dw AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS win
  FROM d, (SELECT DISTINCT k FROM iw) ks, unnest(range(1, len(w) - k + 2)) AS u(p) WHERE len(w) >= k
), h AS (SELECT dw.doc_id, dw.p, dw.k, iw.item_id FROM dw JOIN iw USING (k, win)),
n AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM h, unnest(range(p, p + k)) AS u(q) GROUP BY doc_id),
s AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n.n_hit, 0)::BIGINT AS n_hit, coalesce(s.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s.ids, '')) AS items_sha256, coalesce(n.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark windows, by suffix arrays."""
    found = suffix.find_contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"), (F.col("found.n_hit") > 0).alias("contaminated"),
    )


@query("op9_simple8b_tokens")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all texts in order of doc_id, read back per document."""
    return simple8b.token_round_trip(table(spark, sf_dir, "documents"))


@query("op10_chosen_path_join", f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + least(5, len(w)) - 1], ' ') AS g
  FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS u(p) WHERE len(w) > 0
), n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE i::DOUBLE / (nx.c + ny.c - i)::DOUBLE >= 0.8
), e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, label) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT e.y, r.label FROM r JOIN e ON e.x = r.doc_id
), c AS (SELECT doc_id, min(label) AS class_id FROM r GROUP BY doc_id),
k AS (SELECT x AS doc_id, count(*) AS n FROM e GROUP BY x)
SELECT c.doc_id, c.class_id, coalesce(k.n, 0)::BIGINT AS n_links FROM c LEFT JOIN k USING (doc_id)
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-equal texts and number of links of every document."""
    return chosen_path.similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


@query("op3_multiprobe_neighbours")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest rows of every fiftieth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def _judged(scores: DataFrame, held_out) -> DataFrame:
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op6_factorisation_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a factorisation machine."""
    docs, held_out = table(spark, sf_dir, "documents"), labels.fold("doc_id", 3) == 1
    model = factorisation.fit_quality(docs, table(spark, sf_dir, "labels"), learn=~held_out, metadata=["n_chars"])
    return _judged(factorisation.score_quality(docs, model, metadata=["n_chars"]), held_out)


@query("op8_noisy_channel_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document after its disguised words are restored."""
    docs, held_out = table(spark, sf_dir, "documents"), labels.fold("doc_id", 5) == 0
    model = deobfuscate.fit_toxicity(docs, table(spark, sf_dir, "labels"), learn=~held_out)
    return _judged(deobfuscate.score_toxicity(docs, model), held_out)


def _spans(spans, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of each of ``spans``, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def _number(spans, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


@query("op7_disclosure_sanitisation")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document and the terms that give it away."""
    found = disclosure.find_disclosures(table(spark, sf_dir, "documents"))
    kinds = (*disclosure.KINDS, "term")

    def ordered(spans: str, kind: Column | None = None) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), (s["kind"] if kind is None else kind).alias("kind"), s["end"].alias("end")))

    every = F.array_sort(F.concat(ordered("found"), ordered("terms", F.lit(len(disclosure.KINDS)))))
    return found.select(
        "doc_id", *[_number("found", k).alias(f"n_{name}") for k, name in enumerate(disclosure.KINDS)],
        F.sha2(_spans("found", kinds), 256).alias("base_sha256"), _spans(every, kinds).alias("spans"))


@query("op13_secret_worklist")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, in its text and in the layers wrapped in it."""
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["path"] == "")
    return found.select(
        "doc_id", *[_number(base, k).alias(f"n_{name}") for k, name in enumerate(secret_scan.KINDS)],
        F.sha2(_spans(base, secret_scan.KINDS), 256).alias("base_sha256"), _spans("found", secret_scan.KINDS).alias("spans"))


@query("op12_prefix_trie", r"""
WITH o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
           PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS p
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(
           [[ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0] FOR x IN string_split(conv_id::VARCHAR, '')])),
           lambda r, x: xor(xor(r, x) >> 1, 3988292384 * (xor(r, x) & 1))), 4294967295::BIGINT) % 4 AS h
  FROM o
), t AS (
  SELECT c.conv_id, 0 AS part, o.p, o.role, o.text FROM c JOIN o ON o.conv_id = c.base AND o.p < c.h
  UNION ALL
  SELECT c.conv_id, 1 AS part, o.p, o.role, o.text FROM c JOIN o ON o.conv_id = c.conv_id AND o.p >= c.h
), s AS (
  SELECT conv_id, row_number() OVER w AS depth, role, text,
         string_agg(length(role)::VARCHAR || ':' || length(text)::VARCHAR || ':' || role || text, '') OVER w AS path
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY part, p)
), f AS (
  SELECT conv_id, depth, sha256(path) AS name, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS words,
         max(depth) OVER (PARTITION BY conv_id) AS size FROM s
  UNION ALL
  SELECT conv_id, 0, '', 0, coalesce((SELECT max(depth) FROM s WHERE s.conv_id = c.conv_id), 0) FROM c
), n AS (
  SELECT depth, name, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved,
         string_agg(CASE WHEN size = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends,
         max(size) = depth AS leaf
  FROM f GROUP BY depth, name
), up AS (
  SELECT n.depth, n.name, a.depth AS above, a.name AS above_name, n.saved, n.leaf
  FROM n JOIN f AS a ON a.conv_id = n.conv_id AND a.depth <= n.depth
), g AS (
  SELECT above AS depth, above_name AS name, sum(saved)::BIGINT AS saved_tokens, sum(leaf::INT)::BIGINT AS n_leaves,
         count(*) FILTER (WHERE depth = above + 1) AS n_children
  FROM up GROUP BY above, above_name
)
SELECT n.conv_id, n.depth::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs, g.n_children, g.n_leaves, g.saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n JOIN g USING (depth, name)
LEFT JOIN up ON up.depth = n.depth AND up.name = n.name AND up.above = n.depth - 1
LEFT JOIN n AS q ON q.depth = up.above AND q.name = up.above_name
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared beginnings of rebuilt conversations, one row per node of their trie."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op11_threshold_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near rows of other labels for every hundredth vector and its nearest rows of the same label."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_negatives(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)
