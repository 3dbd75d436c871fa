"""Registered queries of the operators that judge single documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.llm import credentials, language
from pricepanel.llm import line_rules as R
from pricepanel.llm.registry import query, table

_SQL_LINES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{R.SPACE}'), lambda x: x <> '') AS ws FROM d),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
again AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS r
        FROM again, (SELECT unnest(range(0, 8)) AS o) GROUP BY doc_id),
l AS (SELECT doc_id, line, length(line) AS size, length(line) - length(replace(line, ' ', '')) AS spaces,
             len(regexp_extract_all(line, '{R.SEPARATOR}')) AS seps,
             len(regexp_extract_all(line, '{R.PUNCTUATION}')) AS punct
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '{R.VISIBLE}')),
j AS (SELECT *, punct > {R.MAX_PUNCTUATION} * (size - spaces)
          OR (seps >= {R.MIN_SEPARATORS} AND spaces + 1 - seps <= {R.WORDS_PER_SEPARATOR} * (seps + 1))
          OR (spaces <= 2 AND regexp_matches(lower(trim(line)), '{R.NAVIGATION}'))
          OR (spaces + 1 <= {R.BOILERPLATE_WORDS} AND regexp_matches(lower(line), '{R.BOILERPLATE}'))
          OR (spaces + 1 > {R.TITLE_WORDS} AND NOT regexp_matches(line, '{R.SENTENCE_END}')) AS bad
      FROM l),
a AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
             count(*) FILTER (bad) AS n_lines_removed,
             coalesce(sum(size - spaces) FILTER (bad), 0)::BIGINT AS lost_chars FROM j GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '{R.SYMBOLS}'))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(r, 0) AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_lines_removed, 0) AS n_lines_removed,
             coalesce(lost_chars, 0) AS lost_chars
      FROM w LEFT JOIN a USING (doc_id) LEFT JOIN rep USING (doc_id)),
v AS (SELECT *, n_words < {R.MIN_WORDS} OR 100 * n_repeat_words > {R.MAX_REPEAT_PERCENT} * n_words AS base_failed
      FROM m)
SELECT *, NOT base_failed AND lost_chars <= {R.MAX_LOST} * word_chars AS kept FROM v
"""


@query("op1_line_rules", _SQL_LINES)
def op1_line_rules(spark: SparkSession, root: str) -> DataFrame:
    return R.measure(table(spark, root, "documents")).drop("clean_text")


@query("op8_language")
def op8_language(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    found = language.predict(docs, language.train(docs))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


@query("op7_credentials")
def op7_credentials(spark: SparkSession, root: str) -> DataFrame:
    return credentials.scan(table(spark, root, "documents"))
