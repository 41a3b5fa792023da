"""Registered queries of the text operators: one ``opN_`` query each, over whole tables, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm import decontam_wand, exact_dedup, mixing, near_dedup, packing_kk, phrase_automata, pii_crf, quality_cnn, ranked_search, repair, secret_links, token_counts, toxicity_nb
from marketlens.llm.common import documents


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op2_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cnn.quality(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_toxicity_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_nb.toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op4_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.personal_data(documents(spark, sf_dir))


def op5_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_links.secrets(documents(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_kk.pack_documents(documents(spark, sf_dir))


def op7_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_automata.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op8_decontam_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam_wand.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op10_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audit(spark.read.parquet(f"{sf_dir}/conversations.parquet"), damage=True)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(documents(spark, sf_dir)).drop("source", "copies")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_counts, op2_quality_cnn, op3_toxicity_nb, op4_pii_crf, op5_secret_links, op6_packing, op7_phrase_automata,
        op8_decontam_wand, op9_exact_dedup, op10_bagminhash, op11_conversation_repair, op12_ranked_search, op13_mixing)}

#: Windows as text, the least document of each, the words that later documents' windows cover.
PASSAGES_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
h AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(w[i:i + 49], ' ')))) AS k,
  unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
f AS (SELECT k, min(doc_id) AS first_id FROM h GROUP BY k),
g AS (SELECT DISTINCT h.doc_id, unnest(range(h.i, h.i + 50)) AS p FROM h JOIN f ON h.k = f.k WHERE f.first_id < h.doc_id),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
r AS (SELECT x.doc_id, count(g.p) AS n_removed, string_agg(x.word, ' ' ORDER BY x.p) FILTER (g.p IS NULL) AS kept
  FROM x LEFT JOIN g ON g.doc_id = x.doc_id AND g.p = x.p GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(r.n_removed, 0) AS n_removed,
  sha256(coalesce(r.kept, '')) AS kept_sha256
FROM d LEFT JOIN r ON r.doc_id = d.doc_id
"""

#: All pairs that share a shingle, weighted Jaccard on counts, classes by spreading least ids along links.
CLASSES_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
c AS (SELECT doc_id, g, count(*) AS n FROM s GROUP BY doc_id, g),
z AS (SELECT doc_id, sum(n) AS n FROM c GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS x FROM c a JOIN c b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN z y ON y.doc_id = p.a JOIN z ON z.doc_id = p.b WHERE p.x >= 0.8 * (y.n + z.n - p.x)
  UNION SELECT min(doc_id) OVER (PARTITION BY t), doc_id FROM d),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS m FROM d UNION SELECT u.b, r.m FROM r JOIN u ON u.a = r.doc_id WHERE r.m < u.b),
k AS (SELECT doc_id, min(m) AS class_id FROM r GROUP BY doc_id)
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size FROM k
"""

ORACLE: dict[str, str] = {"op7_phrase_automata": PASSAGES_SQL, "op9_exact_dedup": exact_dedup.GROUPS_SQL, "op10_bagminhash": CLASSES_SQL,
                          "op12_ranked_search": ranked_search.RANKED_SQL, "op13_mixing": mixing.MIX_SQL}
