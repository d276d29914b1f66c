"""The queries of this subpackage's operators over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, clustering, decontam, langid, lm, ngram_join, packing, pii, quality, ranked, simhash, token_counts, topk


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The public tokenizer that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after three edits: a word put in the place of five characters at a
    third, seven characters taken out at the middle, and a sentence put at the end."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.coalesce(F.length("text"), F.lit(0))
    third, middle = (n / 3).cast("int"), (n / 2).cast("int")
    made = [(third, third + 5, "Edit-aware"), (middle, middle + 7, ""), (n + 10, n + 10, " The end.")]
    edits = F.array(*[F.struct(a.alias("start"), b.alias("end"), F.lit(t).alias("text")) for a, b, t in made])
    return token_counts.recount(docs.withColumn("edits", edits), tokenizer_path())


def _remainder(of: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(of))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and secrets in every document: counts by base kind, digest of the base spans, all spans, how many they are, how
    many are secrets, and the highest score of any."""
    found = F.col("spans")
    base = F.filter(found, lambda s: s["kind"].isin(*pii.BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return pii.spans(_read(spark, sf_dir, "documents")).select(
        "doc_id", *[count(k) for k in pii.BASE_KINDS], F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(found).alias("spans"),
        F.size(found).cast("long").alias("n_spans"), count("secret"), F.coalesce(F.array_max(F.transform(found, lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages: doc_id, item_id, start, n_words, distance, similarity."""
    return decontam.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each piece of every document lies, and the checksum of its ids."""
    out = packing.pack(_read(spark, sf_dir, "documents"), tokenizer_path())
    return out.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best vectors of every query vector: query_id, rank, vec_id, score."""
    vectors = _read(spark, sf_dir, "embeddings").select("vec_id", topk.whole(F.col("embedding"), 1024).alias("terms"))
    return topk.search(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document, and the latter for a token, learnt from those whose checksum modulo 7 is not 2."""
    out = lm.score(_read(spark, sf_dir, "documents"), _remainder(7) != 2, whole=True)
    return out.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", (F.col("score") / F.col("n_tokens")).alias("token_score"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return ngram_join.near_duplicates(_read(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document: doc_id, held_out, score, predicted."""
    labels = _read(spark, sf_dir, "labels").where(_remainder(3) != 1).select("doc_id", F.col("quality").alias("label"))
    out = quality.classify(_read(spark, sf_dir, "documents"), labels)
    return out.select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", "predicted")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of what is read back from each formatted conversation."""
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id bigint, turn bigint, role string, text string")
    out = chat.format_trees(chat.chain(rows.unionByName(probe)))
    turns = chat.read_turns(F.col("formatted"))
    loss = chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    return (
        out.select(F.col("tree").alias("conv_id"), "formatted", turns.alias("turns"), loss.alias("loss"))
        .select(
            "conv_id", F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document: doc_id, held_out, lang_pred, score, ambiguous."""
    docs = _read(spark, sf_dir, "documents")
    out = langid.identify(docs, langid.fit(docs.where(_remainder(4) != 2).select("text", "lang")))
    return out.select("doc_id", (_remainder(4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector, squared distances and their sums, digest of the final centroid."""
    out = clustering.cluster(_read(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"))


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document."""
    out = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item: item_id, rank, doc_id, score."""
    return ranked.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_pii": op2_pii,
    "op3_decontamination": op3_decontamination,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_topk_search": op5_topk_search,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_ngram_join": op7_ngram_join,
    "op8_quality": op8_quality,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_language_id": op10_language_id,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_simhash_dedup": op12_simhash_dedup,
    "op13_ranked_search": op13_ranked_search,
}

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLE_SQL: dict[str, str] = {
    "op5_topk_search": """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS own, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS t FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.t AS DOUBLE[]), CAST(c.t AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.own <> c.own WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10""",
    "op7_ngram_join": rf"""
WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM docs),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM members a JOIN members b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(any_value(s.s)) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM sets s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id""",
    "op9_chat_formatting": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
parts AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\2\\\3', 'g') AS body,
    regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\2\\\3', 'g') AS head FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(head) + length(body) + 24) AS BIGINT) AS formatted_chars
FROM parts GROUP BY conv_id""",
}


def _clustering_sql(k: int, rounds: int) -> str:
    """Every distance of every round, long form; a round is three steps."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT own, j, d FROM (
    SELECT v.own, c.j, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d,
      row_number() OVER (PARTITION BY v.own ORDER BY d, c.j) AS nth
    FROM v CROSS JOIN c{r} c) WHERE nth = 1)""")
        if r < rounds:
            steps.append(f"""
s{r} AS (SELECT j, dim, sum(e) AS s, count(*) AS n FROM (SELECT n.j, unnest(v.x) AS e, generate_subscripts(v.x, 1) AS dim FROM near{r} n JOIN v USING (own)) GROUP BY j, dim),
m{r} AS (SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY dim) AS x FROM s{r} GROUP BY j),
c{r + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (j))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS own, list_transform(embedding, lambda x: CAST(floor({clustering.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {clustering.DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{clustering.SEED}:' || vec_id), x) - 1 AS j, x FROM v ORDER BY sha256('{clustering.SEED}:' || vec_id), x LIMIT {k}),{",".join(steps)}
SELECT v.vec_id, CAST(n.j AS INTEGER) AS cluster, CAST(n.d AS BIGINT) AS distance, CAST(sum(n.d) OVER (PARTITION BY n.j) AS BIGINT) AS cluster_inertia,
  CAST(sum(n.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM near{rounds} n JOIN v USING (own) JOIN c{rounds} c USING (j)"""


ORACLE_SQL["op11_centroid_clustering"] = _clustering_sql(clustering.K, clustering.ROUNDS)
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE_SQL["op13_ranked_search"] = f"""
WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS own, {_TERMS} AS t FROM documents),
sizes AS (SELECT own, doc_id, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0),
facts AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
q AS (SELECT own, item_id, term, count(*) AS many FROM (SELECT row_number() OVER () AS own, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY own, item_id, term),
tf AS (SELECT own, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT own, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY own, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), facts),
part AS MATERIALIZED (
  SELECT own, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // total))) AS part FROM tf JOIN sizes USING (own) JOIN w USING (term), facts),
scored AS (SELECT q.own AS query, q.item_id, p.own, CAST(sum(q.many * p.part) AS BIGINT) AS score FROM q JOIN part p USING (term) GROUP BY q.own, q.item_id, p.own HAVING score > 0),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS rank FROM scored JOIN sizes USING (own) WHERE doc_id IS NOT NULL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {ranked.K}"""
