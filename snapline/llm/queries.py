"""The registered queries op1 to op13: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapline.llm.decontaminate import decontaminate
from snapline.llm.language import languages
from snapline.llm.middle import fill_in_middle, restored
from snapline.llm.pack import pack
from snapline.llm.pii import personal_data
from snapline.llm.quality import resample
from snapline.llm.registry import query, table
from snapline.llm.repeats import remove_repeats
from snapline.llm.simhash import near_duplicates
from snapline.llm.simplex import centroid_sha256, clusters
from snapline.llm.sketch import edited_fingerprints
from snapline.llm.toxicity import toxicity
from snapline.llm.urls import filter_urls
from snapline.llm.warc import read_warc, write_warc
from snapline.session import scratch

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP1_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, unnest(CASE WHEN len(w) < 10 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' ')) END) AS win
    FROM b WHERE len(w) > 0
),
spot AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
hit AS (SELECT rid, i, spot.n, item FROM spot JOIN bw ON spot.n = bw.n AND array_to_string(w[i:i + spot.n - 1], ' ') = win),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""


@query("op1_decontaminate", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_language")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


@query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_repeats")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query("op7_personal_data")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


# Fixed values.
URL_RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)


@query("op8_url_filter")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op9_pack")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query("op10_near_duplicates")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def _rounds(n: int) -> str:
    """The assignments and means of ``n`` rounds, as common table expressions."""
    made = []
    for i in range(n + 1):
        distance = f"list_sum(list_transform(range(1, 65), lambda i: (v.q[i] - c{i}.q[i]) * (v.q[i] - c{i}.q[i])))"
        made.append(
            f"a{i} AS (SELECT rid, arg_min(struct_pack(j := j, d := d), d * 64 + j) AS best FROM "
            f"(SELECT rid, c{i}.j, {distance} AS d FROM v, c{i}) GROUP BY rid)"
        )
        if i < n:
            made.append(
                f"s{i} AS (SELECT best.j AS j, pos, sum(x)::BIGINT AS s, count(*) AS n FROM "
                f"(SELECT best, unnest(q) AS x, unnest(range(1, 65)) AS pos FROM a{i} JOIN v USING (rid)) GROUP BY ALL)"
            )
            floor = "(s - ((s % n) + n) % n) // n"
            made.append(
                f"c{i + 1} AS (SELECT j, coalesce(m, q) AS q FROM c{i} LEFT JOIN (SELECT j, list({floor} ORDER BY pos) AS m FROM s{i} GROUP BY j) USING (j))"
            )
    return ",\n".join(made)


OP11_SQL = f"""
WITH v AS (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))::BIGINT) AS q FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS j, q FROM v QUALIFY j < 40),
{_rounds(5)},
f AS (SELECT vec_id, best.j AS j, best.d AS d FROM a5 JOIN v USING (rid))
SELECT vec_id, j::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia,
    (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c5.q, ',')) AS centroid_sha256
FROM f JOIN c5 USING (j)
"""


@query("op11_clusters", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = clusters(table(spark, sf_dir, "embeddings"))
    return made.withColumn("centroid_sha256", centroid_sha256()).drop("centroid")


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_HEX = "list_sum(list_transform(range(1, {n} + 1), lambda k: (strpos('0123456789abcdef', {h}[k:k]) - 1) * CAST(power(16, {n} - k) AS BIGINT)))"

OP12_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha1(coalesce(html, '')) AS h, coalesce(html, '') AS body FROM pages),
parts AS (SELECT *, list_transform(range(0, 8), lambda i: h[i * 5 + 1:i * 5 + 5]) AS hs FROM p),
nums AS (SELECT *, list_transform(hs, lambda x: {_HEX.format(n=5, h='x')}) AS ns FROM parts),
d AS (
    SELECT *, array_to_string(list_transform(ns, lambda v: array_to_string(list_transform([15, 10, 5, 0],
        lambda b: '{_ALPHABET}'[CAST((v >> b) & 31 AS BIGINT) + 1:CAST((v >> b) & 31 AS BIGINT) + 1]), '')), '') AS digest FROM nums
),
m AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS top FROM d)
SELECT page_id, bytes::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> top THEN top END AS refers_to
FROM m
"""


@query("op12_warc", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, path = table(spark, sf_dir, "pages"), scratch(spark, "warc")
    write_warc(pages, path)
    found = read_warc(spark, path, pages.schema["page_id"].dataType.simpleString(), payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP13_SQL = rf"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
        regexp_extract_all(coalesce(text, ''), '[ 	-
]*[^ 	-
]+|[ 	-
]+') AS w
    FROM documents
),
x AS (SELECT *, len(w) AS n, h[1:8] AS g1, h[9:16] AS g2, h[17:24] AS g3, h[25:32] AS g4 FROM t),
u AS (SELECT *, {_HEX.format(n=8, h='g1')} % (n + 1) AS k1, {_HEX.format(n=8, h='g2')} % (n + 1) AS k2, {_HEX.format(n=8, h='g3')} AS h3, {_HEX.format(n=8, h='g4')} AS h4 FROM x),
s AS (
    SELECT *, array_to_string(w[1:least(k1, k2)], '') AS p, array_to_string(w[least(k1, k2) + 1:greatest(k1, k2)], '') AS m,
        array_to_string(w[greatest(k1, k2) + 1:n], '') AS s,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
            WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM u
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM s
"""


@query("op13_fill_in_middle", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    sha256 = {"output_sha256": F.col("output"), "restored_sha256": restored()}
    return made.withColumns({name: F.sha2(text.cast("binary"), 256) for name, text in sha256.items()}).drop("output")
