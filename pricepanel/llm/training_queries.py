"""Registered queries of the operators that prepare training: quality scores, token alignment, hard negatives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.llm import hard_negatives, quality_model, token_alignment
from pricepanel.llm.registry import query, table

#: Rows whose crc32(doc_id as text) leaves no remainder are held out of learning.
HELD_OUT = 5


@query("op11_quality_model")
def op11_quality_model(spark: SparkSession, root: str) -> DataFrame:
    rest = F.crc32(F.col("doc_id").cast("string")) % HELD_OUT
    labels = table(spark, root, "labels").select("doc_id", "quality")
    rated = quality_model.rate(table(spark, root, "documents"), labels, rest != 0)
    return rated.select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, root: str) -> DataFrame:
    return token_alignment.digest(table(spark, root, "documents"))


_SQL_NEGATIVES = f"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, e.vec_id AS other_id, a.label = e.label AS same,
             list_dot_product(a.v, e.v)::BIGINT AS score
      FROM e AS a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {hard_negatives.POSITIVES})
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= {hard_negatives.NEGATIVES}
"""


@query("op13_hard_negatives", _SQL_NEGATIVES)
def op13_hard_negatives(spark: SparkSession, root: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, root, "embeddings").withColumn("label", moved), F.col("id") % 100 == 0)
