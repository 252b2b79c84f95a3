"""Registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import language_id, quality, toxicity
from sluice.llm.alignment import cross_alignment
from sluice.llm.bpe import round_trip
from sluice.llm.common import table
from sluice.llm.embedding_dedup import embedding_dedup
from sluice.llm.exact_dedup import exact_dedup
from sluice.llm.online_packing import online_packing
from sluice.llm.packing import best_fit_packing
from sluice.llm.ranked_search import ranked_search
from sluice.llm.simhash import simhash_dedup
from sluice.llm.substring_dedup import substring_dedup
from sluice.llm.warc import warc_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str):
    def register(f):
        QUERIES[name] = f
        return f
    return register


@_query("op5_exact_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("n_rows")


ORACLES["op5_exact_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""


@_query("op9_simhash_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"), shingle=4, max_distance=4)


@_query("op3_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


@_query("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), capacity=2048)


@_query("op6_substring_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), window=50, with_text=False)


ORACLES["op6_substring_dedup"] = r"""
WITH n AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS b FROM n WHERE len(w) >= 50),
k AS (SELECT doc_id, b, sha256(array_to_string(w[b:b + 49], ' ')) AS h FROM s),
m AS (SELECT doc_id, b, min(doc_id) OVER (PARTITION BY h) AS least FROM k),
c AS (SELECT DISTINCT doc_id, unnest(range(b, b + 50)) AS place FROM m WHERE least < doc_id),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM n),
y AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n_kept
      FROM x ANTI JOIN c USING (doc_id, place) GROUP BY doc_id)
SELECT n.doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM n LEFT JOIN y USING (doc_id)
"""


def _held_out(divisor: int, remainder: int) -> Column:
    """Whether a row is in the fold; a row without an id isn't."""
    return F.coalesce(_remainder(divisor) == remainder, F.lit(False)).alias("held_out")


def _remainder(divisor: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % divisor


@_query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language_id.fit(docs.where(~F.coalesce(_remainder(4) == 2, F.lit(False))))
    return language_id.predict(docs, profiles).select(
        "doc_id", _held_out(4, 2), "lang_pred", "score")


@_query("op10_embedding_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"), threshold=0.98)


@_query("op2_quality_classifier")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs))


@_query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    grammar = toxicity.learn(docs, table(spark, sf_dir, "labels").where(_remainder(5) != 0))
    return toxicity.score(docs, grammar).select(
        "doc_id", _held_out(5, 0), "score", "predicted")


@_query("op7_warc")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"), least=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op11_cross_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_alignment(table(spark, sf_dir, "documents"))


@_query("op12_online_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return online_packing(table(spark, sf_dir, "documents"), capacity=1024)


@_query("op13_ranked_search")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=10)


ORACLES["op13_ranked_search"] = r"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
c AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
x AS (SELECT doc, doc_id, len(w) AS n, unnest(w) AS term FROM d),
f AS (SELECT doc, doc_id, n, term, count(*) AS tf FROM x SEMI JOIN q USING (term) GROUP BY ALL),
t AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM f, c GROUP BY term),
s AS (SELECT item_id, doc, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM f JOIN t USING (term) JOIN q USING (term), c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
"""
