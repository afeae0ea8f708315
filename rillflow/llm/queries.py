"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm import (
    additive,
    bpe,
    centroids,
    fixity,
    hidden_markov,
    jaccard,
    languages,
    lines,
    mixing,
    quality,
    token_counts,
    tries,
    vectors,
)
from rillflow.llm.common import crc_remainder, documents

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle:
            ORACLES[name] = oracle
        return query

    return add


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SQL_SEPARATORS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

QUALITY_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM d),
g AS (SELECT *, CASE WHEN len(ws) < 3 THEN [] ELSE list_transform(range(1, len(ws) - 1),
        lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END AS grams FROM w),
u AS (SELECT doc_id, t, generate_subscripts(grams, 1) AS pos, unnest(grams) AS gram FROM g),
r AS (SELECT doc_id, t, gram, list(pos) AS places FROM u GROUP BY ALL HAVING count(*) > 1),
p AS (SELECT doc_id, t, unnest(places) AS pos FROM r),
cov AS (SELECT doc_id, t, count(DISTINCT x) AS n_repeat_words
        FROM (SELECT doc_id, t, unnest([pos, pos + 1, pos + 2]) AS x FROM p) GROUP BY ALL),
l AS (SELECT doc_id, t, unnest(string_split(t, chr(10))) AS line FROM d),
b AS (SELECT *, trim(line, {SQL_SEPARATORS}) AS bare FROM l),
f AS (SELECT *, bare <> '' AS solid, len(regexp_split_to_array(bare, '[\\x20\\x09-\\x0D]+')) AS n,
        regexp_matches(bare, {quoted(quality.ENDED)}) AS ended FROM b),
v AS (SELECT *, solid AND (
        (n < 4 AND NOT ended)
        OR length(bare) - length(regexp_replace(bare, {quoted(quality.MARK)}, '', 'g'))
           > greatest({quality.FEW_MARKS}, 0.2::DOUBLE * length(bare))
        OR length(bare) - length(regexp_replace(bare, {quoted(quality.MENU_MARK)}, '', 'g')) >= 3
        OR (n < 8 AND NOT ended AND regexp_matches(lower(bare), {quoted(quality.OPENS)}))
        OR regexp_matches(lower(bare), {quoted(quality._any_of(quality.BOILERPLATE))})
        ) AS fails FROM f),
s AS (SELECT doc_id, t, count(*) FILTER (solid) - count(DISTINCT line) FILTER (solid) AS n_dup_lines,
        count(*) FILTER (fails) AS n_failed_lines, sum(length(line)) AS line_chars,
        coalesce(sum(length(line)) FILTER (fails), 0) AS lost_chars FROM v GROUP BY ALL),
e AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
        length(w.t) - length(regexp_replace(w.t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_failed_lines,
        CAST(line_chars AS BIGINT) AS line_chars, CAST(lost_chars AS BIGINT) AS lost_chars
      FROM w JOIN s ON w.doc_id = s.doc_id AND w.t = s.t
      LEFT JOIN cov ON w.doc_id = cov.doc_id AND w.t = cov.t)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND lost_chars <= 0.5 * line_chars AS kept
FROM e"""


@register("op9_quality_rules", QUALITY_SQL)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning of all documents: the counts and the verdict of each."""
    return quality.line_quality(documents(spark, sf_dir)).drop("clean_text")


@register("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again: counts and digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN, with_decoded=True).select(
        "doc_id", "n_tokens",
        F.sha2("tokens", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts.count_tokens(
        documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model")
    )


@register("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of lines removed from all documents: what is left of each."""
    clean = lines.dedup_passages(documents(spark, sf_dir).select("doc_id", "text"))
    return clean.select(
        "doc_id", "n_lines", "n_removed_lines", F.length("clean_text").cast("long").alias("n_chars_left"),
        F.sha2("clean_text", 256).alias("clean_sha256"),
    )


MIX_LEVELS = ["domain", "lang", "source"]
MIX_WEIGHTS = {
    ("web",): 4.0, ("books",): 3.0, ("code",): 2.0, ("talk",): 1.0,
    ("web", "en"): 2.0, ("books", "en"): 3.0, ("talk", "es"): 0.0,
}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.6, 3, 7

_WEIGHT_ROWS = ", ".join(
    f"({quoted(chr(31).join(names))}, {weight}::DOUBLE)" for names, weight in MIX_WEIGHTS.items()
)


def _shared_sql(name: str, above: str, parent: str, path: str) -> str:
    """One step of the budgets down the tree, as in mixing.shared."""
    return f"""
{name}_n AS (SELECT {parent} AS parent, {path} AS path, sum(capacity)::DOUBLE AS capacity
  FROM leaves GROUP BY ALL),
{name}_w AS (SELECT n.*, coalesce(w.weight, 1) AS weight, a.budget AS parent_budget
  FROM {name}_n n JOIN {above} a ON a.path = n.parent LEFT JOIN weights w ON w.path = n.path),
{name}_f AS (SELECT *, coalesce(capacity / nullif(weight, 0), 'infinity'::DOUBLE) AS fill
  FROM {name}_w),
{name}_c AS (SELECT *, sum(capacity) OVER o AS cap_so_far,
    sum(weight) OVER (PARTITION BY parent) - sum(weight) OVER o AS weight_left FROM {name}_f
  WINDOW o AS (PARTITION BY parent ORDER BY fill, path ROWS UNBOUNDED PRECEDING)),
{name}_u AS (SELECT *, weight > 0 AND cap_so_far + fill * greatest(weight_left, 0)
    <= parent_budget + 1e-6 AS is_full FROM {name}_c),
{name}_t AS (SELECT *, coalesce(sum(capacity) FILTER (is_full) OVER p, 0) AS taken,
    sum(weight) FILTER (NOT is_full) OVER p AS open_weight FROM {name}_u
  WINDOW p AS (PARTITION BY parent)),
{name} AS (SELECT path, CASE WHEN is_full THEN capacity ELSE least(capacity, coalesce(
    (parent_budget - taken) * weight / nullif(open_weight, 0), 0)) END AS budget FROM {name}_t)"""


MIX_SQL = f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t,
    ['web', 'books', 'code', 'talk'][CAST(regexp_extract(source, '[0-9]+') AS INT) % 4 + 1] AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM documents),
k AS (SELECT *, domain AS p1, concat_ws(chr(31), domain, lang) AS p2,
    concat_ws(chr(31), domain, lang, source) AS p3 FROM d),
leaves AS (SELECT p1, p2, p3, sum(tokens) AS available, sum(tokens) * {MIX_EPOCHS} AS capacity
  FROM k GROUP BY ALL),
weights(path, weight) AS (VALUES {_WEIGHT_ROWS}),
root AS (SELECT '' AS path, least(floor(sum(available) * {MIX_SHARE}::DOUBLE), sum(capacity))
  AS budget FROM leaves),{_shared_sql("l1", "root", "''", "p1")},{_shared_sql("l2", "l1", "p1", "p2")},
{_shared_sql("l3", "l2", "p2", "p3")},
plan AS (SELECT p3, available, CAST(floor(l3.budget + 1e-6) AS BIGINT) AS b,
    coalesce(CAST(floor(l3.budget + 1e-6) AS BIGINT) // nullif(available, 0), 0) AS epochs
  FROM leaves JOIN l3 ON l3.path = p3),
o AS (SELECT k.*, epochs, b - epochs * available AS rest,
    md5({quoted(str(MIX_SEED))} || ':' || epochs || ':' || doc_id || ':' || md5(t)) AS key
  FROM k JOIN plan USING (p3)),
s AS (SELECT *, sum(tokens) OVER (PARTITION BY p3 ORDER BY key) AS so_far FROM o)
SELECT doc_id, p3 AS path, tokens AS n_tokens,
  CAST(epochs + CAST(so_far <= rest AS INT) AS BIGINT) AS copies FROM s"""


def with_domain(docs: DataFrame) -> DataFrame:
    """Documents with a domain, which stands for the kind of site behind the source."""
    kinds = F.array(*map(F.lit, ["web", "books", "code", "talk"]))
    return docs.withColumn("domain", F.get(kinds, F.expr(
        "CAST(nullif(regexp_extract(source, '[0-9]+', 0), '') AS INT) % 4"
    )))


@register("op2_source_mixing", MIX_SQL)
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document under target weights of domains, languages and sources."""
    mixed = mixing.mix(
        with_domain(documents(spark, sf_dir)), MIX_LEVELS, MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED
    )
    return mixed.select(
        "doc_id", F.col("mix_path").alias("path"), F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_copies").alias("copies"),
    )


FIXITY_SQL = """
WITH p AS (SELECT *, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' AS head,
    coalesce(html, '') AS body FROM pages),
r AS (SELECT page_id, strlen(head) + strlen(strlen(body)::VARCHAR) + strlen(body) + 8 AS bytes,
    CASE WHEN page_id % 101 = 7 THEN body || '!' WHEN page_id % 89 = 3 THEN '' ELSE body END AS b2,
    strlen(head) AS h, page_id % 211 = 5 AS is_missing, page_id % 101 = 7 OR (page_id % 89 = 3
    AND body <> '') AS is_changed FROM p)
SELECT page_id, bytes, CASE WHEN NOT is_missing THEN h + strlen(strlen(b2)::VARCHAR) + strlen(b2) + 8 END
  AS other_bytes, CASE WHEN is_missing THEN 'missing' ELSE 'changed' END AS problem
FROM r WHERE is_missing OR is_changed"""


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC records: a volume per file, in the order of its rows."""
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id", "url", "html", F.col("_metadata.file_path").alias("volume"),
        F.col("_metadata.row_index").alias("ordinal"),
    )


@register("op3_warc_fixity", FIXITY_SQL)
def op3_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of pages that a damaged replica has changed or lost.

    The replica is derived from all pages: some get a byte more, some lose their payload,
    some are gone.
    """
    pages = page_records(spark, sf_dir)
    damaged = pages.filter("page_id % 211 <> 5 OR page_id IS NULL").withColumn("html", F.expr(
        "CASE WHEN page_id % 101 = 7 THEN coalesce(html, '') || '!' WHEN page_id % 89 = 3 THEN '' "
        "ELSE html END"
    ))
    trees = [
        fixity.tree(replica.withColumn("record", fixity.warc_record(F.col("url"), F.col("html"))))
        for replica in (pages, damaged)
    ]
    found = fixity.audit(*trees).withColumnRenamed("at", "ordinal").withColumnRenamed("volume_", "volume")
    return pages.select("page_id", "volume", "ordinal").join(found, ["volume", "ordinal"]).select(
        "page_id", "bytes", "other_bytes", "problem"
    )


@register("op4_ngram_jaccard_join")
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of all documents linked by 4-word shingles at a similarity of 0.85."""
    return jaccard.jaccard_components(documents(spark, sf_dir), words=4, num=85, den=100)


VECTORS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding,
    lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.label = y.label
  AND x.vec_id <> y.vec_id AND list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.98),
r AS (SELECT vec_id AS id, vec_id AS reached FROM embeddings
  UNION SELECT r.id, l.b FROM r JOIN l ON l.a = r.reached),
c AS (SELECT id, min(reached) AS component_id FROM r GROUP BY id),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
FROM c LEFT JOIN n ON n.a = c.id"""


@register("op6_embedding_near_dedup", VECTORS_SQL)
def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of all vectors with a cosine of 0.98 or more under equal labels."""
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@register("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of all documents, learned from three quarters of them."""
    docs = documents(spark, sf_dir)
    held_out = crc_remainder("doc_id", 4) == 2
    machines = languages.train(docs, ~held_out, "doc_id", "text", "lang")
    return languages.identify(docs, machines).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


@register("op10_lm_scoring")
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by word counts and a hidden Markov model of four fifths of them."""
    docs = documents(spark, sf_dir)
    return hidden_markov.score_texts(docs, crc_remainder("doc_id", 5) == 1)


#: The CRC-32 of the decimal conversation, bit by bit, modulo 6.
TRIE_SQL = """
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT c, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, r, x) AS l FROM t GROUP BY c),
h AS (SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT],
    list_transform(string_split(c::VARCHAR, ''), lambda y: ascii(y)::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda p, q: xor(p >> 1, 3988292384 * (p & 1)))), 4294967295) % 6 AS h FROM l),
s AS (SELECT h.c, list_concat(coalesce(d.l[1:h], []), o.l[h + 1:]) AS s
  FROM h JOIN l o ON o.c = h.c LEFT JOIN l d ON d.c = h.c - h.c % 100),
k AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM s),
n AS (SELECT d, s[1:d] AS p, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(s) = d), '') AS ends
  FROM k GROUP BY ALL),
ch AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch ON ch.d = n.d AND ch.p = n.p),
a AS (SELECT ad AS d, p[1:ad] AS p, count(*) FILTER (n_children = 0) AS n_leaves,
    sum((n_convs - 1) * CASE WHEN d > 0 THEN length(p[d].x) ELSE 0 END) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS ad FROM m) GROUP BY ALL)
SELECT m.conv_id, m.d AS depth, q.conv_id AS parent_conv_id, m.n_convs, m.n_children, a.n_leaves,
  CAST(a.saved_tokens AS BIGINT) AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN a ON a.d = m.d AND a.p = m.p LEFT JOIN n q ON q.d = m.d - 1 AND q.p = m.p[1:m.d - 1]"""


@register("op11_prefix_trie", TRIE_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of all conversations, after they took the first turns of others."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return tries.prefix_trie(*tries.with_lent_heads(tries.turn_marks(turns, "conv_id", "turn", "role", "text")))


@register("op12_quality_classifier")
def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of all documents, learned from labels of four fifths of them."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = crc_remainder("doc_id", 5) == 0
    return additive.score(docs, additive.train(docs, labels, ~held_out)).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def _round_sql(number: int) -> str:
    """Vectors assigned to centroids c{number}, and the next centroids."""
    return f"""
b{number} AS (SELECT v.i, min([CAST(list_dot_product(v.e, v.e) - 2 * list_dot_product(v.e, c.e)
    + list_dot_product(c.e, c.e) AS BIGINT), c.cluster]) AS b FROM v, c{number} c GROUP BY v.i),
t{number} AS (SELECT b.b[2] AS cluster, j, CAST(sum(v.e[j]) AS BIGINT) AS s, count(*) AS n
  FROM b{number} b JOIN v ON v.i = b.i, range(1, 65) r(j) GROUP BY ALL),
m{number} AS (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY j) AS e FROM t{number} GROUP BY ALL),
c{number + 1} AS (SELECT c.cluster, coalesce(m.e, c.e) AS e FROM c{number} c LEFT JOIN m{number} m
  ON m.cluster = c.cluster)"""


CENTROIDS_SQL = f"""
WITH v AS (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
  FROM embeddings WHERE len(embedding) = 64
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), e) - 1 AS cluster, e FROM v
  QUALIFY cluster < 16),{_round_sql(0)},{_round_sql(1)},{_round_sql(2)},{_round_sql(3)},
d AS (SELECT v.vec_id, b.b[2] AS cluster, b.b[1] AS distance FROM b3 b JOIN v ON v.i = b.i)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  (SELECT sha256(array_to_string(list_transform(c3.e, lambda x: x::BIGINT), ',')) FROM c3
    WHERE c3.cluster = d.cluster) AS centroid_sha256 FROM d"""


@register("op13_centroid_clustering", CENTROIDS_SQL)
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors after three rounds from sixteen drawn ones."""
    return centroids.centroid_clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
