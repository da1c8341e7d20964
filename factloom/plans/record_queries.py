"""Record, tracking, decision and layout queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import evidence, ids, text
from factloom.operators import events, index, intervals, packing, parts, records, recurrence, routing, search, similar, terms, vectors
from factloom.plans.catalog import query, table
from factloom.providers import signature, uncached, valid_clusters
from factloom.sources import files
from factloom.streaming import refresh


@query(
    "rma_lookup",
    "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE upper(regexp_replace(concat('RMA', lpad(CAST(o_orderkey AS VARCHAR), 5, '0')), '^RMA', '')) = '00042'",
)
def rma_lookup(spark: SparkSession, d: str) -> DataFrame:
    """References ⋈ events, filtered by the normalised reference."""
    refs = table(spark, d, "orders").withColumn("rma", evidence.rma_number(F.concat(F.lit("RMA# "), F.lpad(F.col("o_orderkey").cast("string"), 5, "0"))))
    return refs.where(F.col("rma") == "00042").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@query(
    "tracking_enrichment",
    """
WITH r AS (SELECT l_orderkey, l_suppkey, min(l_partkey) AS pn FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY ALL)
SELECT l.l_orderkey, l.l_linenumber, coalesce(r.pn, l.l_partkey) AS part_number, r.pn IS NOT NULL AS reclassified FROM lineitem l LEFT JOIN r ON l.l_orderkey = r.l_orderkey AND l.l_suppkey = r.l_suppkey
""",
)
def tracking_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """Mentions ⟕ order references of the same event, first match by part number."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey")
    refs = events.first_by_key(lines.where(F.col("l_linenumber") % 2 == 0), ["l_orderkey", "l_suppkey"], ["l_partkey", "l_linenumber"]).select("l_orderkey", "l_suppkey", F.col("l_partkey").alias("pn"))
    return lines.join(refs, ["l_orderkey", "l_suppkey"], "left").select("l_orderkey", "l_linenumber", F.coalesce("pn", "l_partkey").alias("part_number"), F.col("pn").isNotNull().alias("reclassified"))


@query(
    "first_seen_mode",
    "WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) AS k FROM c) SELECT user_id, event_type, n FROM r WHERE k = 1",
)
def first_seen_mode(spark: SparkSession, d: str) -> DataFrame:
    return events.mode(table(spark, d, "events"), ["user_id"], "event_type", "event_id").select("user_id", "event_type", "n")


@query(
    "evidence_examples",
    "WITH d AS (SELECT DISTINCT p_brand, l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY l_orderkey) AS INTEGER) AS rank FROM d) SELECT * FROM r WHERE rank <= 20",
)
def evidence_examples(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return parts.examples(m, "p_brand", "l_orderkey")


@query(
    "source_agreement",
    "WITH p AS (SELECT a.conv_id, lower(a.text) = lower(b.text) AS s FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn < b.turn) SELECT conv_id, count(*) AS pairs, count(*) FILTER (s) AS agreeing FROM p GROUP BY conv_id",
)
def source_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of turns of a conversation, and those that say the same."""
    return similar.agreement(table(spark, d, "conversations").withColumn("v", F.lower("text")), ["conv_id"], "turn", "v")


@query(
    "identity_match",
    "SELECT o_orderkey, CAST(2 AS INTEGER) AS compared, o_orderstatus = 'O' AND o_orderkey % 5 <> 0 AS matches FROM orders WHERE o_orderkey % 3 = 0",
)
def identity_match(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    b = a.where(F.col("o_orderkey") % 3 == 0).select("o_orderkey", F.lit("O").alias("status"), F.when(F.col("o_orderkey") % 5 == 0, F.concat("priority", F.lit("x"))).otherwise(F.col("priority")).alias("priority"))
    return records.identity_matches(a, b, "o_orderkey", ["status", "priority"])


@query(
    "decision_merge",
    "SELECT event_id AS decision_id, CASE WHEN event_id % 2 = 0 THEN 'prior' ELSE 'local' END AS origin FROM events WHERE event_id % 2 = 0 OR event_id % 3 = 0",
)
def decision_merge(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.col("event_id").alias("decision_id"))
    return records.merge_decisions(e.where(F.col("decision_id") % 2 == 0).withColumn("origin", F.lit("prior")), e.where(F.col("decision_id") % 3 == 0).withColumn("origin", F.lit("local")))


@query(
    "stale_sources",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'missing' ELSE 'changed' END AS reason FROM orders WHERE o_orderkey % 10 = 0 OR o_orderkey % 7 = 0",
)
def stale_sources(spark: SparkSession, d: str) -> DataFrame:
    stored = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("modified"))
    now = stored.where(F.col("o_orderkey") % 10 != 0).withColumn("modified", F.when(F.col("o_orderkey") % 7 == 0, F.expr("modified + interval 1 day")).otherwise(F.col("modified")))
    return index.stale(stored, now, "o_orderkey", "modified")


@query(
    "best_field_value",
    "WITH r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size > 25 DESC, p_type = 'PROMO' DESC, length(p_name) DESC, p_name) AS k FROM part) SELECT p_brand, p_name FROM r WHERE k = 1",
)
def best_field_value(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").withColumns({"anchor": F.col("p_size") > 25, "vision": F.col("p_type") == "PROMO"})
    return records.best_value(p, ["p_brand"], "anchor", "vision", "p_name").select("p_brand", "p_name")


@query(
    "field_states",
    "WITH c AS (SELECT c_custkey, count(o_orderkey) FILTER (o_orderstatus = 'F') AS a, count(o_orderkey) FILTER (o_orderstatus <> 'F') AS p, c_acctbal > 0 AS s FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_acctbal) "
    "SELECT CASE WHEN NOT s THEN 'not_available' WHEN a > 0 THEN 'approved' WHEN p > 0 THEN 'pending_review' ELSE 'not_established' END AS state, count(*) AS n FROM c GROUP BY 1",
)
def field_states(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("a"), F.count_if(F.col("o_orderstatus") != "F").alias("p"))
    c = table(spark, d, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left")
    state = records.field_state(F.coalesce("a", F.lit(0)), F.coalesce("p", F.lit(0)), F.col("c_acctbal") > 0)
    return c.groupBy(state.alias("state")).agg(F.count("*").alias("n"))


@query(
    "cluster_validation",
    "WITH p AS (SELECT l_suppkey AS s, CASE WHEN l_linenumber % 2 = 1 THEN l_partkey ELSE l_partkey + 1000000 END AS k FROM lineitem), o AS (SELECT k, lpad(CAST(min(lpad(CAST(s AS VARCHAR), 12, '0')) AS VARCHAR), 12, '0') AS s FROM p WHERE k IN (SELECT p_partkey FROM part) GROUP BY k), "
    "z AS (SELECT s FROM o GROUP BY s HAVING count(*) >= 2) SELECT p_partkey AS candidate_id, coalesce(z.s, 'single:' || p_partkey) AS cluster_id FROM part LEFT JOIN o ON o.k = p_partkey LEFT JOIN z ON z.s = o.s",
)
def cluster_validation(spark: SparkSession, d: str) -> DataFrame:
    """Proposed clusters with unknown and repeated members; members left over become singletons."""
    lines = table(spark, d, "lineitem")
    cid = F.lpad(F.col("l_suppkey").cast("string"), 12, "0").alias("cluster_id")
    p = lines.select(cid, F.when(F.col("l_linenumber") % 2 == 1, F.col("l_partkey")).otherwise(F.col("l_partkey") + 1000000).alias("candidate_id"))
    return valid_clusters(p, table(spark, d, "part").select(F.col("p_partkey").alias("candidate_id"))).select("candidate_id", "cluster_id")


@query("cache_misses", "SELECT doc_id FROM documents WHERE text NOT IN (SELECT text FROM benchmark)")
def cache_misses(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose content signature has no cached result."""
    signed = lambda name: table(spark, d, name).withColumn("signature", signature("text"))
    return uncached(signed("documents"), signed("benchmark")).select("doc_id")


@query("union_coverage", "SELECT count(DISTINCT l_orderkey) AS covered FROM lineitem")
def union_coverage(spark: SparkSession, d: str) -> DataFrame:
    return recurrence.union_coverage(table(spark, d, "lineitem").select("l_partkey", "l_orderkey"), "l_orderkey")


@query(
    "template_repetition",
    "WITH c AS (SELECT lang AS term, source, count(*) AS n FROM documents GROUP BY ALL) SELECT term, round(max(n) / sum(n)::DOUBLE, 6) AS template_share, CAST(sum(n) AS BIGINT) AS occurrences FROM c GROUP BY term",
)
def template_repetition(spark: SparkSession, d: str) -> DataFrame:
    out = terms.template_share(table(spark, d, "documents").select(F.col("lang").alias("term"), "source"), "source")
    return out.select("term", F.round("template_share", 6).alias("template_share"), "occurrences")


@query(
    "effective_glossary",
    "WITH l AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders WHERE o_orderpriority <> '5-LOW'), m AS (SELECT o_orderpriority AS raw_term, CAST(o_orderkey AS VARCHAR) AS normalized_meaning, 'decision' AS origin FROM l WHERE k = 1 AND o_orderstatus = 'F') "
    "SELECT * FROM m UNION ALL SELECT DISTINCT o_orderpriority, 'base', 'base' FROM orders WHERE o_orderpriority NOT IN (SELECT raw_term FROM m)",
)
def effective_glossary(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    base = o.select(F.col("o_orderpriority").alias("raw_term")).distinct().withColumn("normalized_meaning", F.lit("base"))
    dec = o.where(F.col("o_orderpriority") != "5-LOW").select(F.col("o_orderkey").alias("decision_id"), F.col("o_orderpriority").alias("raw_term"), F.col("o_orderkey").cast("string").alias("meaning"), F.when(F.col("o_orderstatus") == "F", "approve").otherwise("hold").alias("decision"), F.col("o_orderdate").alias("reviewed_at"))
    return terms.effective_glossary(base, dec)


@query(
    "grid_pitch",
    "WITH g AS (SELECT l_suppkey, l_orderkey - lag(l_orderkey) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) AS gap FROM (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem)), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY gap) AS k, count(*) OVER (PARTITION BY l_suppkey) AS n FROM g WHERE gap IS NOT NULL) "
    "SELECT l_suppkey, CAST(quantile_cont(gap, 0.5) AS DOUBLE) AS pitch FROM r WHERE k <= greatest(1, ceil(n * 0.6)) GROUP BY l_suppkey",
)
def grid_pitch(spark: SparkSession, d: str) -> DataFrame:
    return intervals.pitch(table(spark, d, "lineitem").select("l_suppkey", "l_orderkey").distinct(), ["l_suppkey"], "l_orderkey")


@query(
    "smoothed_profile",
    "SELECT event_id, avg(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING) AS smooth FROM events",
)
def smoothed_profile(spark: SparkSession, d: str) -> DataFrame:
    return intervals.moving_average(table(spark, d, "events").withColumn("cents", F.round(F.col("value") * 100).cast("long")), ["user_id"], "event_id", "cents").select("event_id", "smooth")


@query(
    "component_packing",
    "SELECT p_brand, p_partkey, CAST(floor((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) / 25) AS INTEGER) AS part FROM part",
)
def component_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.component_batches(table(spark, d, "part"), "p_brand", "p_partkey", 25)


@query("overlap_packing")
def overlap_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.overlapping_batches(table(spark, d, "part").withColumn("n", F.length("p_name")), "p_brand", "p_partkey", "n", 120, 2)


@query("fuzzy_names")
def fuzzy_names(spark: SparkSession, d: str) -> DataFrame:
    """Similar spellings among the distinct part names."""
    names = table(spark, d, "part").groupBy("p_name").agg(F.min("p_partkey").alias("k"))
    return similar.fuzzy_pairs(names, "k", "p_name", 0.72).withColumn("similarity", F.round("similarity", 6))


@query(
    "identifier_search",
    "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE lpad(CAST(o_orderkey AS VARCHAR), 9, '0') = '000000033')",
)
def identifier_search(spark: SparkSession, d: str) -> DataFrame:
    """An identifier query: the order itself and the orders linked by its customer."""
    num = F.lpad(F.col("o_orderkey").cast("string"), 9, "0")
    none = F.lit(None).cast("string")
    items = table(spark, d, "orders").select(F.col("o_orderkey"), num.alias("primary_value"), num.alias("title"), none.alias("log_number"), F.col("o_custkey").cast("string").alias("event"), num.alias("search_text"))
    hits = search.candidates(search.postings(items, "o_orderkey", "search_text"), items, "o_orderkey", "search_text", "000000033")
    direct = hits.where(search.directly_matches("000000033", "primary_value", "title", "search_text"))
    return search.linked(items, direct, "o_orderkey", "event", "log_number").select("o_orderkey")


@query(
    "outcome_gates",
    "SELECT CASE WHEN l_quantity < 5 THEN 'rejected:too_few' WHEN l_discount > 0.08 THEN 'rejected:discounted' ELSE 'accepted' END AS outcome, count(*) AS n FROM lineitem GROUP BY 1",
)
def outcome_gates(spark: SparkSession, d: str) -> DataFrame:
    gate = records.outcome([("too_few", F.col("l_quantity") < 5), ("discounted", F.col("l_discount") > 0.08)])
    return table(spark, d, "lineitem").groupBy(gate.alias("outcome")).agg(F.count("*").alias("n"))


@query(
    "record_digests",
    "SELECT n_nationkey, 'record_' || sha256(n_name || chr(10) || CAST(n_regionkey AS VARCHAR))[1:16] AS record_id, sha256('{\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '}') AS digest FROM nation",
)
def record_digests(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    return n.select("n_nationkey", records.record_id("n_name", "n_regionkey").alias("record_id"), records.record_digest(["n_regionkey", "n_name"]).alias("digest"))


@query(
    "upsert_latest",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN -1.0 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 5 = 0",
)
def upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return files.upsert(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 5 = 0").withColumn("o_totalprice", F.lit(-1.0)), "o_orderkey")


@query(
    "event_sessions",
    "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS n FROM events), s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS session_start, count(*) AS n FROM s GROUP BY user_id, k",
)
def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    return refresh.sessions(table(spark, d, "events"), "ts", "user_id").select("user_id", "session_start", "n")


@query(
    "vector_threshold",
    "WITH q AS (SELECT embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id = 1) SELECT vec_id, round(list_cosine_similarity(q.e, embedding::DOUBLE[]), 4) AS similarity FROM embeddings, q WHERE list_cosine_similarity(q.e, embedding::DOUBLE[]) >= 0.3",
)
def vector_threshold(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings")
    q = [float(x) for x in v.where(F.col("vec_id") == 1).first()["embedding"]]
    s = v.select("vec_id", vectors.cosine("embedding", F.array(*[F.lit(x) for x in q])).alias("similarity"))
    return s.where(F.col("similarity") >= 0.3).select("vec_id", F.round("similarity", 4).alias("similarity"))


@query(
    "hash_distance",
    "SELECT doc_id, CAST(list_sum([bit_count(xor(('0x' || sha256(text)[8*k+1:8*k+8])::BIGINT, ('0x' || sha256(lang)[8*k+1:8*k+8])::BIGINT)) FOR k IN range(8)]) AS INTEGER) AS distance FROM documents",
)
def hash_distance(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", ids.hamming(ids.hash_pieces(F.sha2("text", 256)), ids.hash_pieces(F.sha2("lang", 256))).alias("distance"))


@query(
    "rating_and_part_tokens",
    "SELECT p_partkey, [CAST(p_size AS VARCHAR) || 'A', '600V'] AS ratings, true AS part_like FROM part WHERE CAST(p_size AS VARCHAR) || 'A' < '600V' UNION ALL SELECT p_partkey, ['600V', CAST(p_size AS VARCHAR) || 'A'], true FROM part WHERE CAST(p_size AS VARCHAR) || 'A' >= '600V'",
)
def rating_and_part_tokens(spark: SparkSession, d: str) -> DataFrame:
    s = F.concat(F.lit("fuse "), F.col("p_size"), F.lit(" A 600V QX-"), F.col("p_partkey"))
    return table(spark, d, "part").select("p_partkey", text.rating_tokens(s).alias("ratings"), text.part_like(s).alias("part_like"))


_LANE = "CASE role WHEN 'user' THEN 'repair_or_service' WHEN 'assistant' THEN 'diagnostic_or_failure' WHEN 'system' THEN 'unclear_ocr' ELSE 'other' END"


@query(
    "lane_routing",
    rf"""
WITH c AS (SELECT conv_id, turn, {_LANE} AS kind, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS s FROM conversations),
r AS (SELECT *, CASE WHEN kind = 'unclear_ocr' THEN 'unclear_ocr_preserved_for_human_or_secondary_vision_review'
  WHEN regexp_matches(s, '^\s*(?:part\s*#|Serial\s*#|Frame\s+Serial\s*#|Board\s+Serial\s*#)(?:\s|:|$)', 'i') THEN 'generic_identity_or_admin_pattern_1'
  WHEN regexp_matches(s, '^\s*(?:RMA\s+Number|Cust(?:omer)?\s*RMA|Customer\s+PO|Cust\s+PO|POC\s+Phone|Point\s+of\s+Contact|Rep|Sales\s+Rep)\b', 'i') THEN 'generic_identity_or_admin_pattern_2'
  WHEN regexp_matches(s, '^\s*(?:pricing approved|needs quote)\b', 'i') THEN 'generic_identity_or_admin_pattern_5' END AS reason FROM c)
SELECT CASE WHEN reason IS NULL THEN CASE kind WHEN 'repair_or_service' THEN 'repairs' WHEN 'diagnostic_or_failure' THEN 'diagnostics' ELSE 'other' END END AS reasoning_lane, reason AS reasoning_exclusion_reason, count(*) AS n FROM r GROUP BY ALL
""",
)
def lane_routing(spark: SparkSession, d: str) -> DataFrame:
    """Turns as candidates: their lanes, or why they are left out."""
    kind = F.when(F.col("role") == "user", "repair_or_service").when(F.col("role") == "assistant", "diagnostic_or_failure").when(F.col("role") == "system", "unclear_ocr").otherwise("other")
    out = routing.prepare(table(spark, d, "conversations").withColumn("kind", kind), "kind", "text")
    return out.groupBy("reasoning_lane", "reasoning_exclusion_reason").agg(F.count("*").alias("n"))


@query(
    "replacement_fill",
    """SELECT l_orderkey, l_linenumber, coalesce(nullif(trim(nullif(l_returnflag, 'N')), ''), nullif(trim(o_orderstatus), '')) AS status, coalesce(nullif(trim(o_orderpriority), ''), '[unknown]') AS priority
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderkey % 7 <> 0""",
)
def replacement_fill(spark: SparkSession, d: str) -> DataFrame:
    """Lines that lack a value take that of their order, if there is one."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("N")).alias("status"), F.lit(None).cast("string").alias("priority"))
    events = table(spark, d, "orders").where("o_orderkey % 7 <> 0").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return records.fill_from_event(lines, events, "l_orderkey", ["status", "priority"], {"priority": "[unknown]"})


@query(
    "merge_tracking",
    "SELECT o_orderkey, list_sort(list(DISTINCT nullif(trim(l_returnflag), '')) FILTER (nullif(trim(l_returnflag), '') IS NOT NULL)) AS l_returnflag FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey HAVING count(l_orderkey) > 0",
)
def merge_tracking(spark: SparkSession, d: str) -> DataFrame:
    """Distinct flags of each order's lines."""
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag")
    return records.merge_tracking(table(spark, d, "orders").select("o_orderkey"), lines, "o_orderkey", ["l_returnflag"]).where(F.size("l_returnflag") > 0)
