"""Registered queries of the operators that look across documents or write the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricepanel.lineage import scratch_path
from pricepanel.llm import decontaminate, line_dedup, packing, passages, simhash, templates, token_store
from pricepanel.llm.registry import query, table


@query("op10_packing")
def op10_packing(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(table(spark, root, "documents"))


@query("op9_token_store")
def op9_token_store(spark: SparkSession, root: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    token_store.write(table(spark, root, "documents"), folder)
    return token_store.read(spark, folder, with_ids=False)


_WORDS = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), {u}, {l}), {p}), lambda x: x <> '')".format(
    u="'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", l="'abcdefghijklmnopqrstuvwxyz'", p=r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
)
_SQL_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS ws FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(ws), 10) AS m,
             array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS w
      FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
g AS (SELECT doc_id, m, i, array_to_string(ws[i:i + m - 1], ' ') AS w
      FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
            FROM d, (SELECT DISTINCT m FROM p) WHERE len(ws) >= m)),
h AS (SELECT doc_id, i, m, item_id FROM g JOIN p USING (m, w)),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM h) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""


@query("op4_decontamination", _SQL_DECONTAMINATION)
def op4_decontamination(spark: SparkSession, root: str) -> DataFrame:
    found = decontaminate.find(table(spark, root, "documents"), table(spark, root, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op6_simhash")
def op6_simhash(spark: SparkSession, root: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, root, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


_SQL_LINE_DEDUP = f"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, unnest(parts) AS s, unnest(range(0, len(parts))) AS line FROM d),
w AS (SELECT *, doc_id * 10000000 + line AS place,
             list_filter(regexp_split_to_array(s, '[\\x09-\\x0D ]+'), lambda x: x <> '') AS ws FROM l),
k AS (SELECT *, len(ws) AS n, array_to_string(ws, ' ') AS k FROM w),
f AS (SELECT k, any_value(ws) AS ws, any_value(n) AS n, min(place) AS o FROM k WHERE n > 0 GROUP BY k),
v AS (SELECT k, o, p, array_to_string(list_concat(ws[1:p - 1], ws[p + 1:]), ' ') AS d
      FROM (SELECT *, unnest(range(1, n + 1)) AS p FROM f WHERE n >= {line_dedup.MIN_WORDS})),
j AS (SELECT v.k AS longer, v.o AS lo, f.k AS shorter, f.o AS so
      FROM v JOIN f ON f.k = v.d AND f.n >= {line_dedup.MIN_WORDS}),
near AS (SELECT k FROM (SELECT k, o, min(o) OVER (PARTITION BY d, p) AS m FROM v) WHERE m < o
         UNION SELECT longer FROM j WHERE so < lo UNION SELECT shorter FROM j WHERE lo < so),
g AS (SELECT k.doc_id, k.line, k.s, k.n, k.n > 0 AND (k.place > f.o OR k.k IN (SELECT k FROM near)) AS gone
      FROM k LEFT JOIN f ON f.k = k.k AND k.n > 0),
a AS (SELECT doc_id, count(*) FILTER (n > 0) AS n_lines, count(*) FILTER (gone) AS n_removed,
             string_agg(s, chr(10) ORDER BY line) FILTER (gone IS NOT TRUE) AS kept FROM g GROUP BY doc_id)
SELECT doc_id, n_lines, n_removed, CASE WHEN d.text IS NOT NULL THEN coalesce(kept, '') END AS text
FROM d JOIN a USING (doc_id)
"""


@query("op3_line_dedup", _SQL_LINE_DEDUP)
def op3_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    found = line_dedup.deduplicate(table(spark, root, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", "text")


@query("op5_site_templates")
def op5_site_templates(spark: SparkSession, root: str) -> DataFrame:
    return templates.extract(table(spark, root, "pages"))


@query("op2_shared_passages")
def op2_shared_passages(spark: SparkSession, root: str) -> DataFrame:
    return passages.shared_passages(table(spark, root, "documents"))
