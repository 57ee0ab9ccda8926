"""The registered query of each corpus operator, beside its SQL counterpart where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import held_out, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


@query(
    "op6_exact_dedup",
    r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents
), r AS (
  SELECT doc_id, h, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY h) AS c
  FROM t
)
SELECT doc_id, keep_id, c AS group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM r
""",
)
def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from tablesync.llm.exact_dedup import exact_groups

    return exact_groups(table(spark, sf, "documents"))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file; it is the same on all machines of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op10_binary_ids")
def op10_binary_ids(spark: SparkSession, sf: str) -> DataFrame:
    from tablesync.llm.binary_ids import id_digests, write_ids
    from tablesync.llm.common import Scratch

    files = Scratch(spark, "binary-ids").path("files")
    write_ids(table(spark, sf, "documents"), files, vocabulary(), 2)
    return id_digests(spark, files)


@query("op4_packing")
def op4_packing(spark: SparkSession, sf: str) -> DataFrame:
    from tablesync.llm.packing import Limits, pack

    return pack(table(spark, sf, "documents"), vocabulary(), 2, Limits(tokens=4096, segments=256, loss=4096))


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    from tablesync.llm.toxicity import fit, score

    docs = table(spark, sf, "documents")
    model = fit(docs, table(spark, sf, "labels").where(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    from tablesync.llm.langid import fit, predict

    docs = table(spark, sf, "documents")
    model = fit(docs.select("doc_id", "text", "lang").where(~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query(
    "op2_line_dedup",
    r"""
WITH d AS (SELECT doc_id, text, md5(coalesce(text, '')) AS version, string_split(text, chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, version, unnest(lines) AS line, generate_subscripts(lines, 1) AS k, len(lines) AS n FROM d WHERE text IS NOT NULL),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h, length(line) - length(replace(line, ' ', '')) + 1 >= 50 AS lng FROM l),
e AS (
  SELECT *, k = n OR lng OR lead(lng, 1, false) OVER w OR (coalesce(lag(h) OVER w, 0) * 31 + h) % 4 = 0 AS ends
  FROM h WINDOW w AS (PARTITION BY doc_id, version ORDER BY k)
),
c AS (SELECT *, sum(ends::INT) OVER (PARTITION BY doc_id, version ORDER BY k) - ends::INT AS pos FROM e),
g AS (
  SELECT doc_id, version, pos, string_agg(line, chr(10) ORDER BY k) AS body, count(*) AS lines, bool_or(lng) AS lng
  FROM c GROUP BY doc_id, version, pos
),
m AS (
  SELECT *, (lines > 1 OR lng) AND translate(body, ' ' || chr(10) || chr(9) || chr(13), '') <> '' AS counts,
         row_number() OVER (PARTITION BY body, (lines > 1 OR lng) AND translate(body, ' ' || chr(10) || chr(9) || chr(13), '') <> '' ORDER BY doc_id, version, pos) AS r
  FROM g
),
s AS (
  SELECT doc_id, version, string_agg(body, chr(10) ORDER BY pos) FILTER (WHERE NOT (counts AND r > 1)) AS clean,
         count(*) AS n_chunks, count(*) FILTER (WHERE counts AND r > 1) AS n_removed
  FROM m GROUP BY doc_id, version
)
SELECT d.doc_id, CASE WHEN n_removed > 0 THEN coalesce(clean, '') ELSE text END AS text, coalesce(n_chunks, 0)::BIGINT AS n_chunks,
       coalesce(n_removed, 0)::BIGINT AS n_removed,
       (length(coalesce(text, '')) - length(CASE WHEN n_removed > 0 THEN coalesce(clean, '') ELSE coalesce(text, '') END))::BIGINT AS removed_chars
FROM d LEFT JOIN s ON d.doc_id = s.doc_id AND d.version = s.version
""",
)
def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from tablesync.llm.line_dedup import without_repeats

    return without_repeats(table(spark, sf, "documents"))


#: Copies of each document at seed 17; {docs} is the table, and {columns} what is returned.
MIXED_SQL = r"""
WITH RECURSIVE z AS (SELECT source, sum(length(coalesce(text, '')))::BIGINT AS chars FROM {docs} GROUP BY source),
t AS (SELECT sum(CASE WHEN chars > 0 THEN sqrt(chars::DOUBLE) ELSE 0 END) AS weights, sum(chars)::DOUBLE AS total FROM z),
r AS (SELECT source, CASE WHEN chars > 0 THEN sqrt(chars::DOUBLE) / weights * total / chars::DOUBLE ELSE 1.0 END AS rate FROM z, t),
p AS (SELECT source, greatest(ceil(rate / 16), 1)::INT AS parts, rate / greatest(ceil(rate / 16), 1) AS mean FROM r),
f AS (
  SELECT source, parts, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS s FROM p
  UNION ALL
  SELECT source, parts, mean, k + 1, p * mean / (k + 1), s + p * mean / (k + 1) FROM f WHERE k < 96
),
i AS (SELECT DISTINCT doc_id, source FROM {docs}),
j AS (SELECT doc_id, i.source, unnest(generate_series(1, parts)) AS j FROM i JOIN p ON i.source IS NOT DISTINCT FROM p.source),
u AS (SELECT doc_id, source, j, ('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, 'null') || '|' || j), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u FROM j),
n AS (SELECT doc_id, u.source, count(*) AS n FROM u JOIN f ON u.source IS NOT DISTINCT FROM f.source AND f.s <= u.u GROUP BY doc_id, u.source)
SELECT {columns} FROM {docs} d JOIN n ON d.doc_id IS NOT DISTINCT FROM n.doc_id AND d.source IS NOT DISTINCT FROM n.source,
  unnest(generate_series(1, n.n)) AS c(copy)
"""


@query("op3_mixing", MIXED_SQL.format(docs="documents", columns="d.*, c.copy::INT AS copy"))
def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    from tablesync.llm.mixing import mixed

    return mixed(table(spark, sf, "documents"))


@query("op8_fingerprints")
def op8_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    from tablesync.llm.fingerprints import fingerprinted

    return fingerprinted(table(spark, sf, "documents"))


@query("op9_near_dedup")
def op9_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from tablesync.llm.near_dedup import near_classes

    return near_classes(table(spark, sf, "documents"))


@query("op7_html_text")
def op7_html_text(spark: SparkSession, sf: str) -> DataFrame:
    from tablesync.llm.html_text import main_text

    return main_text(table(spark, sf, "pages"))


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    from tablesync.llm.conversations import conversations_repaired

    return conversations_repaired(table(spark, sf, "conversations"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    from tablesync.llm.periodic_runs import periodic_runs

    return periodic_runs(table(spark, sf, "documents"))


@query(
    "op11_warc",
    r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS n, sha1(body) AS h, min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, n AS payload_bytes,
       array_to_string([translate(upper(to_base(('0x' || substr(h, 5 * i + 1, 5))::BIGINT, 32, 4)),
                        '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') FOR i IN range(8)], '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d
""",
)
def op11_warc(spark: SparkSession, sf: str) -> DataFrame:
    from tablesync.llm.common import Scratch
    from tablesync.llm.warc import capture_index, write_archives

    archives = Scratch(spark, "warc-files").path("archives")
    write_archives(table(spark, sf, "pages"), archives)
    return capture_index(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
