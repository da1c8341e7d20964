"""Index, sampling, event and text queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import evidence, ids, text
from factloom.operators import events, index, recurrence, spans
from factloom.plans.catalog import query, table

# text made from order rows: a decoy run, an invalid date, and the true log number
_LOG_TEXT = "concat('SN 80050608 / 991332001 log ', date_format(o_orderdate, 'yyMMdd'), lpad(cast(o_orderkey % 1000 as string), 3, '0'), ' unit ', cast(o_orderkey as string))"
_LOG_SQL = "concat('SN 80050608 / 991332001 log ', strftime(o_orderdate, '%y%m%d'), lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0'), ' unit ', CAST(o_orderkey AS VARCHAR))"


@query(
    "log_number_detect",
    f"""
WITH t AS (SELECT o_orderkey, {_LOG_SQL} AS t FROM orders),
d AS (SELECT o_orderkey, unnest(regexp_extract_all(concat(' ', t, ' '), '[0-9]+')) AS d, generate_subscripts(regexp_extract_all(concat(' ', t, ' '), '[0-9]+'), 1) AS i FROM t)
SELECT o.o_orderkey, (SELECT arg_min(d, i) FROM d WHERE d.o_orderkey = o.o_orderkey AND length(d) = 9 AND try_strptime('20' || d[1:6], '%Y%m%d') IS NOT NULL AND d[7:9] <> '000') AS log_number FROM orders o
""",
)
def log_number_detect(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", ids.detect_log(F.expr(_LOG_TEXT)).alias("log_number"))


@query(
    "log_decode",
    """
WITH t AS (SELECT o_orderkey, concat(strftime(o_orderdate, '%y%m%d'), lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')) AS g FROM orders)
SELECT o_orderkey, strftime(strptime('20' || g[1:6], '%Y%m%d'), '%Y-%m-%d') AS log_date, CAST(g[7:9] AS INTEGER) AS sequence,
  CASE WHEN CAST(g[1:2] AS INT) <= 69 THEN '20' ELSE '19' END || g[1:2] || '-' || g[3:4] || '-' || g[5:6] AS pivot_date FROM t
""",
)
def log_decode(spark: SparkSession, d: str) -> DataFrame:
    g = F.expr("concat(date_format(o_orderdate, 'yyMMdd'), lpad(cast(o_orderkey % 1000 as string), 3, '0'))")
    return table(spark, d, "orders").select("o_orderkey", ids.log_date(g).cast("string").alias("log_date"), ids.log_sequence(g).alias("sequence"), ids.pivot_log_date(g).alias("pivot_date"))


@query(
    "form_date_plausibility",
    """
WITH t AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 7 = 0 THEN '' WHEN l_linenumber % 5 = 0 THEN 'no date' ELSE strftime(l_shipdate, '%-m/%-d/%y') END AS raw, CAST(l_shipdate AS DATE) AS s, CAST(strptime('20' || strftime(o_orderdate, '%y%m%d'), '%Y%m%d') AS DATE) AS g,
  CASE WHEN CAST(strftime(l_shipdate, '%y') AS INT) >= 70 THEN '19' ELSE '20' END || strftime(l_shipdate, '%y-%m-%d') AS dd FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, l_linenumber, CASE WHEN raw = '' THEN 'blank' WHEN raw = 'no date' THEN 'no_date' WHEN date_diff('day', g, CAST(dd AS DATE)) BETWEEN -31 AND 370 THEN 'plausible' ELSE 'implausible' END AS status,
  CASE WHEN raw NOT IN ('', 'no date') THEN CAST(date_diff('day', g, CAST(dd AS DATE)) AS INTEGER) END AS days_from_log FROM t
""",
)
def form_date_plausibility(spark: SparkSession, d: str) -> DataFrame:
    raw = F.expr("case when l_linenumber % 7 = 0 then '' when l_linenumber % 5 = 0 then 'no date' else date_format(l_shipdate, 'M/d/yy') end")
    log = F.expr("concat(date_format(o_orderdate, 'yyMMdd'), '001')")
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    f = rows.select("l_orderkey", "l_linenumber", ids.form_date(raw, log).alias("f"))
    return f.select("l_orderkey", "l_linenumber", "f.status", "f.days_from_log")


@query("index_search_and_tokens", "SELECT page_id, url FROM pages WHERE contains(lower(url), 'example') AND contains(lower(url), '/en')")
def index_search_and_tokens(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "pages").select("page_id", "url", text.path_form("url").alias("search_text"))
    return files.where(index.matches('example "/en"')).select("page_id", "url")


@query(
    "index_statistics",
    r"""
WITH f AS (SELECT url, length(html) AS size, lower(regexp_extract(regexp_extract(lower(url), '([^/]*)$', 1), '[^.]\.([^./]+)$', 1)) AS extension FROM pages),
k AS (SELECT *, CASE WHEN extension IN ('jpg','jpeg','png','bmp','gif','tif','tiff','webp') THEN 'image' WHEN extension = 'pdf' THEN 'pdf' WHEN extension IN ('doc','docx','xls','xlsx','ppt','pptx','txt','rtf','csv','md') THEN 'document' WHEN extension IN ('zip','7z','rar','tar','gz','tgz') THEN 'archive' ELSE 'other' END AS file_kind FROM f)
SELECT 'total' AS metric, 'files' AS name, count(*) AS n FROM k UNION ALL SELECT 'total', 'bytes', CAST(sum(size) AS BIGINT) FROM k UNION ALL SELECT 'total', 'with_log', CAST(0 AS BIGINT)
UNION ALL SELECT 'extension', extension, count(*) FROM k GROUP BY extension UNION ALL SELECT 'file_kind', file_kind, count(*) FROM k GROUP BY file_kind
""",
)
def index_statistics(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    rows = pages.select(F.length("html").cast("long").alias("size"), evidence.extension("url").alias("extension"), evidence.file_kind("url").alias("file_kind"), ids.detect_log(F.lit("")).alias("detected_log"))
    return index.statistics(rows)


@query(
    "index_refresh_diff",
    """
WITH o AS (SELECT o_orderkey, o_totalprice AS p FROM orders WHERE o_orderkey % 11 <> 0),
n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS p FROM orders WHERE o_orderkey % 13 <> 0)
SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'added' WHEN n.o_orderkey IS NULL THEN 'deleted' WHEN o.p IS NOT DISTINCT FROM n.p THEN 'unchanged' ELSE 'changed' END AS state
FROM o FULL OUTER JOIN n ON o.o_orderkey = n.o_orderkey
""",
)
def index_refresh_diff(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("p"))
    new = orders.where(F.col("o_orderkey") % 13 != 0).withColumn("p", F.when(F.col("o_orderkey") % 7 == 0, F.col("p") + 1).otherwise(F.col("p")))
    return index.refresh(orders.where(F.col("o_orderkey") % 11 != 0), new, "o_orderkey", ["p"])


@query(
    "index_missing_paths",
    "SELECT o_orderkey FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 = 0",
)
def index_missing_paths(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey")
    return index.missing(orders.where(F.col("o_orderkey") % 11 != 0), orders.where(F.col("o_orderkey") % 13 != 0), "o_orderkey")


@query(
    "deterministic_sample",
    """
WITH s AS (SELECT doc_id, sha256(encode('seed-1') || '\\x00'::BLOB || encode(CAST(doc_id AS VARCHAR))) AS sample_hash FROM documents),
r AS (SELECT *, CAST(row_number() OVER (ORDER BY sample_hash, doc_id) AS INTEGER) AS sample_rank, count(*) OVER () AS n FROM s)
SELECT doc_id, sample_hash, sample_rank FROM r WHERE sample_rank <= ceil(n * 10 / 100.0)
""",
)
def deterministic_sample(spark: SparkSession, d: str) -> DataFrame:
    return events.deterministic_sample(table(spark, d, "documents"), "doc_id", 10, "seed-1")


@query(
    "event_grouping",
    """
SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS documents, count(*) FILTER (event_type = 'purchase') AS primary_documents, count(*) FILTER (event_type <> 'purchase' OR event_type IS NULL) AS supporting_documents, min(event_id) AS first_value, max(event_id) AS last_value
FROM events GROUP BY user_id, CAST(ts AS DATE)
""",
)
def event_grouping(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("day", F.to_date("ts").cast("string"))
    return events.group_events(rows, ["user_id", "day"], ["event_id"], F.col("event_type") == "purchase")


_ROLES = ["click", "view", "purchase", "signup"]


@query("evidence_rollup", "SELECT user_id, count(*) AS total, " + ", ".join(f"count(*) FILTER (event_type = '{r}') AS n_{r}" for r in _ROLES) + " FROM events GROUP BY user_id")
def evidence_rollup(spark: SparkSession, d: str) -> DataFrame:
    return events.rollup(table(spark, d, "events"), "user_id", "event_type", _ROLES)


@query(
    "completeness",
    "WITH c AS (SELECT user_id, count(*) AS total, " + ", ".join(f"count(*) FILTER (event_type = '{r}') AS n_{r}" for r in _ROLES) + " FROM events GROUP BY user_id) "
    "SELECT user_id, CAST(" + " + ".join(f"CASE WHEN n_{r} > 0 THEN {w} ELSE 0 END" for r, w in zip(_ROLES, (20, 10, 50, 20), strict=True)) + " AS BIGINT) AS completeness, "
    "concat_ws(',', " + ", ".join(f"CASE WHEN n_{r} = 0 THEN '{r}' END" for r in _ROLES) + ") AS gaps FROM c",
)
def completeness(spark: SparkSession, d: str) -> DataFrame:
    c = events.rollup(table(spark, d, "events"), "user_id", "event_type", _ROLES)
    return events.completeness(c, dict(zip(_ROLES, (20, 10, 50, 20), strict=True))).select("user_id", "completeness", "gaps")


@query(
    "exclusion_reasons",
    "SELECT CASE WHEN contains(url, '?') THEN 'has_query' WHEN contains(url, '#') THEN 'has_anchor' WHEN url LIKE 'http://%' THEN 'not_secure' ELSE 'kept' END AS exclusion_reason, count(*) AS n FROM pages GROUP BY 1",
)
def exclusion_reasons(spark: SparkSession, d: str) -> DataFrame:
    rules = [("has_query", F.contains("url", F.lit("?"))), ("has_anchor", F.contains("url", F.lit("#"))), ("not_secure", F.col("url").startswith("http://"))]
    return events.reason_counts(events.with_reason(table(spark, d, "pages"), rules))


@query(
    "quote_binding",
    r"""
SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(lower(trim(regexp_replace(d.text, '\s+', ' ', 'g'))), lower(trim(regexp_replace(b.text, '\s+', ' ', 'g'))))
  OR contains(lower(regexp_replace(d.text, '[^A-Za-z0-9]+', '', 'g')), lower(regexp_replace(b.text, '[^A-Za-z0-9]+', '', 'g')))
""",
)
def quote_binding(spark: SparkSession, d: str) -> DataFrame:
    """Quotes are a stated query set; every document is searched for all of them."""
    return spans.bound_pairs(table(spark, d, "benchmark"), table(spark, d, "documents"), "item_id", "text", "doc_id", "text")


_LINES_SQL = r"WITH l AS (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ') AS l FROM documents)"


@query(
    "repeated_lines",
    _LINES_SQL + r" SELECT lower(trim(regexp_replace(l, '\s+', ' ', 'g'))) AS line, count(DISTINCT doc_id) AS documents, count(*) AS occurrences FROM l WHERE length(l) >= 18 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2",
)
def repeated_lines(spark: SparkSession, d: str) -> DataFrame:
    return recurrence.repeated_lines(table(spark, d, "documents"), "doc_id", "text")


@query(
    "transcription_audit",
    """
WITH l AS (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ') AS l FROM documents),
c AS (SELECT doc_id, l, count(*) AS n FROM l WHERE l <> '' GROUP BY doc_id, l),
t AS (SELECT doc_id, arg_min(l, (-n, l)) AS top_line, max(n) AS top_count, sum(n) AS filled FROM c GROUP BY doc_id)
SELECT d.doc_id, CAST(len(string_split(d.text, chr(10))) AS INTEGER) AS lines, CAST(coalesce(filled, 0) AS INTEGER) AS filled, md5(top_line) AS top_line_md5, CAST(coalesce(top_count, 0) AS INTEGER) AS top_count, coalesce(top_count, 0) >= 12 AS runaway
FROM documents d LEFT JOIN t ON d.doc_id = t.doc_id
""",
)
def transcription_audit(spark: SparkSession, d: str) -> DataFrame:
    """Line counts by an aggregation, so that a text of many lines costs no more than its lines."""
    docs = table(spark, d, "documents")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("l")).select("doc_id", F.trim("l").alias("l")).where(F.col("l") != "")
    counted = lines.groupBy("doc_id", "l").agg(F.count("*").alias("n"))
    top = counted.groupBy("doc_id").agg(F.min(F.struct((-F.col("n")).alias("m"), "l")).alias("t"), F.sum("n").alias("filled"))
    out = docs.select("doc_id", F.size(F.split("text", "\n")).alias("lines")).join(top, "doc_id", "left")
    n = F.coalesce(-F.col("t.m"), F.lit(0)).cast("int")
    return out.select("doc_id", "lines", F.coalesce("filled", F.lit(0)).cast("int").alias("filled"), F.md5("t.l").alias("top_line_md5"), n.alias("top_count"), (n >= 12).alias("runaway"))


@query(
    "sanitised_view",
    r"""
WITH l AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: CASE WHEN regexp_full_match(trim(regexp_replace(x, '\s+', ' ', 'g')), '[A-Z0-9 !,.''-]+') THEN '' ELSE x END) AS v, string_split(text, chr(10)) AS o FROM documents)
SELECT doc_id, md5(array_to_string(v, chr(10))) AS view_md5, CAST(len(list_filter(o, lambda x: trim(x, ' ') <> '' AND regexp_full_match(trim(regexp_replace(x, '\s+', ' ', 'g')), '[A-Z0-9 !,.''-]+'))) AS BIGINT) AS dropped FROM l
""",
)
def sanitised_view(spark: SparkSession, d: str) -> DataFrame:
    out = recurrence.sanitised(table(spark, d, "documents"), "doc_id", "text", [("shouting", "[A-Z0-9 !,.'-]+")])
    return out.select("doc_id", F.md5("view").alias("view_md5"), "dropped")


@query("exact_duplicates", "SELECT sha256(text) AS h, count(*) AS copies, min(doc_id) AS representative FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy(F.sha2("text", 256).alias("h")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("representative")).where(F.col("copies") > 1)


@query(
    "text_forms",
    r"""
SELECT p_partkey, lower(regexp_replace(p_name, '[^A-Za-z0-9]+', '', 'g')) AS alnum_lower, upper(regexp_replace(p_name, '[^A-Za-z0-9]+', '', 'g')) AS alnum_upper, trim(regexp_replace(lower(p_type), '[^a-z0-9]+', ' ', 'g')) AS compare_form,
  'c_' || sha256(p_name || chr(10) || p_brand)[1:16] AS content_id, CASE WHEN length(p_name) <= 12 THEN p_name ELSE p_name[1:11] || '…' END AS short_name,
  CASE WHEN CAST(p_retailprice * 1000 AS BIGINT) < 1024 THEN CAST(CAST(p_retailprice * 1000 AS BIGINT) AS VARCHAR) || ' B' WHEN CAST(p_retailprice * 1000 AS BIGINT) < 1048576 THEN printf('%.1f KB', CAST(p_retailprice * 1000 AS BIGINT) / 1024.0) ELSE printf('%.1f MB', CAST(p_retailprice * 1000 AS BIGINT) / 1048576.0) END AS size_text
FROM part
""",
)
def text_forms(spark: SparkSession, d: str) -> DataFrame:
    size = F.round(F.col("p_retailprice") * 1000).cast("long")
    return table(spark, d, "part").select(
        "p_partkey", text.alnum_lower("p_name").alias("alnum_lower"), text.alnum_upper("p_name").alias("alnum_upper"), text.compare_form("p_type").alias("compare_form"), ids.content_id("c", "p_name", "p_brand").alias("content_id"), text.shorten("p_name", 12).alias("short_name"), text.human_bytes(size).alias("size_text")
    )
