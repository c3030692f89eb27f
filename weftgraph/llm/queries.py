"""The registered queries of the operators, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import centroids, fingerprints, hnsw, languages, lexicon, licenses, minhash, packing, rans, slack, suffixes, toxicity, tries
from .common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.token_file(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon.encode(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), digests=True)


def op7_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op11_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slack.pack_fullest(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("n_exact")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.divergences(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_output, op2_packing, op3_suffixes, op4_toxicity, op5_hnsw, op6_lexicon, op7_bagminhash,
        op8_fingerprints, op9_language, op10_licenses, op11_bin_slack, op12_centroids, op13_divergence,
    )
}


def _count(phrase: str) -> str:
    """Places of a phrase in ``line``, where each word stands between two blanks of its own."""
    padded = f"' {'  '.join(phrase.split())} '"
    return f"((length(line) - length(replace(line, {padded}, ''))) // length({padded}))"


def _labels(phrases: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {_count(p)} > 0 THEN '{label}' END" for p, label in phrases.items())
    return f"array_to_string(list_sort(list_distinct(list_filter([{cases}], lambda x: x IS NOT NULL))), ',')"


_STARTS = " OR ".join("(" + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(p.split())) + ")" for p in licenses.BASE)


def _clusters(k: int, rounds: int, dim: int = centroids.DIM) -> str:
    """The whole clustering, three relations for each round."""
    apart = f"list_sum(list_transform(range(1, {dim + 1}), lambda m: (v.q[m] - c.q[m]) * (v.q[m] - c.q[m])))"
    near = "SELECT i, vec_id, any_value(q) AS q, min(d) AS d, arg_min(j, (d, j)) AS j FROM (SELECT v.i, v.vec_id, v.q, c.j, {apart} AS d FROM v CROSS JOIN c{r} c) GROUP BY i, vec_id"
    parts = [
        f"""v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{centroids.SALT}:' || vec_id), vec_id) - 1 AS i, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
      FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"c0 AS MATERIALIZED (SELECT i AS j, q FROM v WHERE i < {k})",
    ]
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({near.format(r=r, apart=apart)})")
        parts.append(f"m{r} AS MATERIALIZED (SELECT j, m, sum(x) AS s, count(*) AS n FROM (SELECT j, unnest(q) AS x, unnest(range(1, {dim + 1})) AS m FROM a{r}) GROUP BY j, m)")
        parts.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.j, coalesce(n.q, c.q) AS q FROM c{r} c LEFT JOIN
      (SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY m) AS q FROM m{r} GROUP BY j) n USING (j))""")
    parts.append(f"f AS MATERIALIZED ({near.format(r=rounds, apart=apart)})")
    return f"""WITH {", ".join(parts)}
    SELECT f.vec_id, CAST(f.j AS INTEGER) AS cluster, CAST(f.d AS BIGINT) AS distance, CAST(sum(f.d) OVER (PARTITION BY f.j) AS BIGINT) AS cluster_inertia, CAST(sum(f.d) OVER () AS BIGINT) AS inertia,
      sha256(array_to_string(c.q, ',')) AS centroid_sha256 FROM f JOIN c{rounds} c USING (j)"""


_DIVERGENCE = rf"""
    WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
    g AS (SELECT DISTINCT lang, source FROM d),
    k AS (SELECT lang, t FROM (SELECT lang, unnest(list_distinct(w)) AS t FROM d) GROUP BY lang, t HAVING count(*) >= {tries.LEAST_DOCUMENTS}),
    c AS (SELECT lang, source, t, count(*) AS n FROM (SELECT lang, source, unnest(w) AS t FROM d) SEMI JOIN k USING (lang, t) GROUP BY lang, source, t),
    v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
    s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
    l AS (SELECT lang, sum(n) AS n FROM c GROUP BY lang),
    p AS MATERIALIZED (SELECT lang, source, t, coalesce(c.n, 0) AS n, CAST(1 + CAST({tries.SCALE} AS HUGEINT) * (coalesce(c.n, 0) + 1) // (coalesce(s.n, 0) + v.v) AS HUGEINT) AS p
      FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, t) LEFT JOIN s USING (lang, source)),
    w AS (SELECT lang, t, CAST(1 + CAST({tries.SCALE} AS HUGEINT) * (sum(c.n) + 1) // (any_value(l.n) + any_value(v.v)) AS HUGEINT) AS q FROM c JOIN l USING (lang) JOIN v USING (lang) GROUP BY lang, t),
    f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
    pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
    term AS (SELECT lang, source, t AS item, (p - q) * (p - q) // q AS value FROM p JOIN w USING (lang, t) WHERE n > 0 AND p > q),
    r AS (SELECT 'pair' AS part, * FROM pair UNION ALL SELECT 'term' AS part, * FROM term)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY part, lang, source ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM r
    QUALIFY part = 'pair' OR rank <= {tries.RANKS}"""

#: Texts with an identifier tag are beyond this SQL (the tables have none; tests hold expressions).
ORACLE_SQL: dict[str, str] = {
    "op10_licenses": rf"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
    p AS (SELECT doc_id, len(w) AS n_words, ' ' || array_to_string(w, '  ') || ' ' AS line, list_filter(range(1, len(w) + 1), lambda i: coalesce({_STARTS}, false)) AS places FROM d)
    SELECT doc_id, n_words, len(places) AS n_base, places[1] - 1 AS first_word, places[-1] - 1 AS last_word, {_labels(licenses.BASE)} AS base_labels, {_labels(licenses.BASE | licenses.NOTICES)} AS labels,
      1 - power(0.5, {" + ".join(map(_count, licenses.BASE | licenses.NOTICES))}) AS score FROM p""",
    "op12_centroids": _clusters(centroids.K, centroids.ROUNDS),
    "op13_divergence": _DIVERGENCE,
}
