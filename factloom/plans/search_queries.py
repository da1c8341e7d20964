"""Search, similarity, vector, terminology and record queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.functions import ids, text
from factloom.operators import events, hamming, intervals, packing, records, search, similar, terms, vectors
from factloom.plans.catalog import query, table
from factloom.storage import parts_for
from factloom.streaming import refresh


def _items(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select(F.concat(F.lit("part:"), "p_partkey").alias("item_key"), F.lit("product_part").alias("item_type"), F.col("p_name").alias("primary_value"), F.concat_ws(" ", "p_name", "p_type").alias("title"), F.col("p_brand").alias("equipment_family"))
    supplier = table(spark, d, "supplier").select(F.concat(F.lit("supplier:"), "s_suppkey").alias("item_key"), F.lit("order").alias("item_type"), F.col("s_name").alias("primary_value"), F.col("s_name").alias("title"), F.lit("").alias("equipment_family"))
    customer = table(spark, d, "customer").select(F.concat(F.lit("customer:"), "c_custkey").alias("item_key"), F.lit("event").alias("item_type"), F.col("c_name").alias("primary_value"), F.col("c_name").alias("title"), F.lit("").alias("equipment_family"))
    return part.unionByName(supplier).unionByName(customer).withColumn("search_text", text.search_form(F.concat_ws(" ", "primary_value", "title", "equipment_family")))


_ITEMS_SQL = """
i AS (SELECT 'part:' || p_partkey AS item_key, 'product_part' AS item_type, p_name AS primary_value, p_name || ' ' || p_type AS title, p_brand AS family FROM part
  UNION ALL SELECT 'supplier:' || s_suppkey, 'order', s_name, s_name, '' FROM supplier UNION ALL SELECT 'customer:' || c_custkey, 'event', c_name, c_name, '' FROM customer),
s AS (SELECT *, lower(trim(regexp_replace(primary_value || ' ' || title || ' ' || family, '\\s+', ' ', 'g'))) AS t FROM i)
"""


@query("trigram_search", f"WITH {_ITEMS_SQL} SELECT item_key FROM s WHERE contains(t, 'red') AND contains(t, 'ring')")
def trigram_search(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d)
    return search.candidates(search.postings(items, "item_key", "search_text"), items, "item_key", "search_text", "Red ring").select("item_key")


@query(
    "ranked_search",
    f"""
WITH {_ITEMS_SQL}, h AS (SELECT *, lower(regexp_replace(primary_value, '[^A-Za-z0-9]+', '', 'g')) AS pa FROM s WHERE contains(t, '000000001')),
r AS (SELECT item_key, item_type, lower(title) AS lt, (CASE WHEN pa = '000000001' THEN 1000.0 WHEN starts_with(pa, '000000001') THEN 800.0 WHEN contains(pa, '000000001') THEN 700.0 ELSE 0.0 END + CASE WHEN starts_with(lower(title), '000000001') THEN 500.0 WHEN contains(lower(title), '000000001') THEN 420.0 ELSE 0.0 END
  + CASE WHEN starts_with(lower(family), '000000001') THEN 390.0 WHEN contains(lower(family), '000000001') THEN 330.0 ELSE 0.0 END + CASE item_type WHEN 'order' THEN 145.0 WHEN 'product_part' THEN 130.0 WHEN 'event' THEN 95.0 ELSE 0.0 END)::DOUBLE AS score FROM h)
SELECT item_key, score FROM r ORDER BY score DESC, item_type, lt, item_key LIMIT 20
""",
)
def ranked_search(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d).withColumns({"log_number": F.lit(None).cast("string"), "source_path": F.lit(None).cast("string"), "rank_hint": F.lit(0.0)})
    hits = search.candidates(search.postings(items, "item_key", "search_text"), items, "item_key", "search_text", "000000001")
    scored = hits.withColumn("score", search.rank_score("000000001", "item_type", "primary_value", "title", "equipment_family", "log_number", "source_path", "rank_hint"))
    return scored.orderBy(F.desc("score"), "item_type", text.search_form("title"), "item_key").limit(20).select("item_key", "score")


@query(
    "linked_context",
    """
WITH hit AS (SELECT o_orderkey, o_custkey, o_clerk FROM orders WHERE o_orderkey = 7)
SELECT o.o_orderkey, o.o_orderkey = 7 AS direct FROM orders o WHERE o.o_custkey IN (SELECT o_custkey FROM hit) OR o.o_orderpriority = 'none'
""".replace(", o_clerk", "").replace(" OR o.o_orderpriority = 'none'", ""),
)
def linked_context(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("customer"), F.lit(None).cast("string").alias("log_number"))
    return search.linked(orders, orders.where(F.col("o_orderkey") == 7), "o_orderkey", "customer", "log_number").select("o_orderkey", "direct")


@query(
    "pattern_search",
    r"""
WITH g AS (SELECT p_partkey, p_name, p_type, count(DISTINCT l_orderkey) AS logs, count(DISTINCT l_suppkey) AS serials FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY ALL),
n AS (SELECT *, trim(regexp_replace(replace(lower(p_name), '_', ' '), '[^a-z0-9+./-]+', ' ', 'g')) AS lab, trim(regexp_replace(replace(lower(p_type), '_', ' '), '[^a-z0-9+./-]+', ' ', 'g')) AS ev FROM g),
k AS (SELECT *, list_distinct(regexp_extract_all(lab, '[a-z0-9]+')) AS lt, list_distinct(regexp_extract_all(ev, '[a-z0-9]+')) AS et FROM n),
s AS (SELECT *, CASE WHEN contains(lab, 'red ring') THEN 28.0 WHEN contains(ev, 'red ring') THEN 12.0 ELSE 0.0 END + 7.5 * len(list_intersect(['red', 'ring'], lt)) + least(10.0, 1.6 * len(list_filter(list_intersect(['red', 'ring'], et), lambda x: NOT list_contains(lt, x))))
  + CASE WHEN len(list_filter(['red', 'ring'], lambda x: NOT list_contains(lt, x) AND NOT list_contains(et, x))) = 0 THEN 5.0 ELSE 0.0 END AS signal FROM k)
SELECT p_partkey, round((signal + least(5.0, log2(1.0 + serials) * 0.8 + log2(1.0 + logs) * 0.35))::DOUBLE, 6) AS score FROM s WHERE signal > 0.2
""",
)
def pattern_search(spark: SparkSession, d: str) -> DataFrame:
    use = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.countDistinct("l_orderkey").alias("logs"), F.countDistinct("l_suppkey").alias("serials"))
    groups = table(spark, d, "part").join(use, F.col("p_partkey") == F.col("l_partkey")).withColumn("areas", F.lit(""))
    s = groups.withColumn("s", search.pattern_score("red ring", "p_name", "p_type", "areas", "serials", "logs")).where(F.col("s.signal") > 0.2)
    return s.select("p_partkey", F.round("s.score", 6).alias("score"))


_DUP = r"trim(regexp_replace(regexp_replace(regexp_replace(lower(text), '\[unclear\]', ' ', 'g'), '\bpage\s+\d+\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"
_PAIRS_SQL = rf"""
d AS (SELECT doc_id, string_split({_DUP}, ' ') AS w FROM documents WHERE {_DUP} <> ''),
s AS (SELECT doc_id, CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])) END AS g, md5(array_to_string(w, ' ')) AS h FROM d),
n AS (SELECT min(doc_id) AS id, any_value(g) AS g, h FROM s GROUP BY h), u AS (SELECT id, len(g) AS n, unnest(g) AS x FROM n),
p AS (SELECT a.id AS a, b.id AS b, count(*) / (a.n + b.n - count(*))::DOUBLE AS similarity FROM u a JOIN u b ON a.x = b.x AND a.id < b.id GROUP BY a.id, b.id, a.n, b.n HAVING count(*) >= 0.55 * (a.n + b.n - count(*))
  UNION ALL SELECT n.id, s.doc_id, 1.0 FROM n JOIN s ON n.h = s.h WHERE s.doc_id <> n.id)
"""
_COMPONENTS_SQL = _PAIRS_SQL + ", e AS (SELECT a, b FROM p UNION SELECT b, a FROM p), r(v, m) AS (SELECT DISTINCT a, a FROM e UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.v), c AS (SELECT v AS vertex, min(m) AS component FROM r GROUP BY v)"


@query("near_duplicates", f"WITH {_PAIRS_SQL} SELECT a, b, round(similarity, 6) AS similarity FROM p")
def near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return similar.similar_pairs(table(spark, d, "documents"), "doc_id", "text", 0.55).select("a", "b", F.round("similarity", 6).alias("similarity"))


@query("duplicate_components", f"WITH RECURSIVE {_COMPONENTS_SQL} SELECT vertex, component FROM c")
def duplicate_components(spark: SparkSession, d: str) -> DataFrame:
    return similar.components(similar.similar_pairs(table(spark, d, "documents"), "doc_id", "text", 0.55))


@query("duplicate_representatives", f"WITH RECURSIVE {_COMPONENTS_SQL} SELECT doc_id, coalesce(component, doc_id) AS representative, doc_id = coalesce(component, doc_id) AS kept FROM documents LEFT JOIN c ON vertex = doc_id")
def duplicate_representatives(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return similar.representatives(docs, "doc_id", similar.components(similar.similar_pairs(docs, "doc_id", "text", 0.55)))


@query(
    "hamming_pairs",
    """
WITH h AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS s FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b, CAST(list_sum(list_transform(list_zip(a.s, b.s), lambda z: abs(z[1] - z[2]))) AS INTEGER) AS differing FROM h a JOIN h b ON a.vec_id < b.vec_id)
SELECT a, b, differing FROM p WHERE differing <= 18
""",
)
def hamming_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Vectors whose signs differ in at most 18 places of those that both have (64 in most tables), copies too."""
    e = table(spark, d, "embeddings").select("vec_id", "embedding", F.size("embedding").alias("places")).where(F.col("places") > 0)
    bits = e.agg(F.max("places")).first()[0] or 64
    padded = F.concat("embedding", F.array_repeat(F.lit(0.0), bits - F.col("places")))
    return hamming.row_pairs(e.select("vec_id", "places", hamming.sign_pieces(padded, bits).alias("signs")), "vec_id", "signs", "places", 18)


# records from documents: one image for copies of a text's beginning, and the hash of an image from the signs of a vector
_IMAGES_SQL = rf"""
v AS (SELECT vec_id, lpad(array_to_string(list_transform(range(0, 16), lambda k: substr('0123456789abcdef', CAST(list_sum(list_transform(range(1, 5), lambda j: CASE WHEN embedding[4*k+j] > 0 THEN 2 ** (4 - j) ELSE 0 END)) AS INTEGER) + 1, 1)), ''), 64, '0') AS x FROM embeddings),
m AS (SELECT count(*) AS m FROM embeddings),
f AS (SELECT doc_id, sha256(left(text, 40)) AS i, x, {_DUP} AS t FROM documents JOIN m ON true LEFT JOIN v ON vec_id = (n_chars % m)),
w AS (SELECT doc_id, i, x, t, length(t) AS n, string_split(t, ' ') AS w FROM f),
s AS (SELECT doc_id, i, x, n, t, CASE WHEN t = '' THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda j: w[j] || ' ' || w[j+1] || ' ' || w[j+2])) END AS g FROM w),
u AS (SELECT doc_id, len(g) AS c, unnest(g) AS y FROM s),
k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) / (a.c + b.c - count(*))::DOUBLE AS j FROM u a JOIN u b ON a.y = b.y AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.c, b.c),
e AS (SELECT a.doc_id AS a, b.doc_id AS b, CASE WHEN least(a.n, b.n) > 0 AND least(a.n, b.n) >= 0.35 * greatest(a.n, b.n) THEN coalesce(j, 0) ELSE 0 END AS j, bit_count(xor(CAST('0x' || a.x[49:56] AS BIGINT), CAST('0x' || b.x[49:56] AS BIGINT))) + bit_count(xor(CAST('0x' || a.x[57:64] AS BIGINT), CAST('0x' || b.x[57:64] AS BIGINT))) AS h, coalesce(a.i = b.i, false) AS x
  FROM s a JOIN s b ON a.doc_id < b.doc_id LEFT JOIN k ON k.a = a.doc_id AND k.b = b.doc_id),
r AS (SELECT a, b FROM e WHERE x OR j >= 0.55 OR h <= 22 AND j >= 0.18)
"""


@query(
    "record_duplicates",
    f"WITH RECURSIVE {_IMAGES_SQL}, o AS (SELECT a, b FROM r UNION SELECT b, a FROM r), c(v, m) AS (SELECT doc_id, doc_id FROM documents UNION SELECT o.b, c.m FROM c JOIN o ON o.a = c.v) SELECT v AS doc_id, min(m) AS component FROM c GROUP BY v",
)
def record_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """The smallest record that each is tied to by the same image, similar text, or alike images of somewhat similar texts."""
    docs, v = table(spark, d, "documents"), table(spark, d, "embeddings")
    pieces = v.select("vec_id", hamming.sign_pieces("embedding", 64).alias("s")).select("vec_id", F.lpad(F.lower(F.concat(*[F.lpad(F.hex(F.get("s", F.lit(k))), 8, "0") for k in range(2)])), 64, "0").alias("hash"))
    image = docs.join(F.broadcast(v.agg(F.count("*").alias("m")))).withColumn("vec_id", F.col("n_chars") % F.col("m"))  # one row
    records = image.join(pieces, "vec_id", "left").select("doc_id", F.sha2(F.substring("text", 1, 40), 256).alias("image"), "hash", "text")
    pairs = hamming.record_duplicates(records, "doc_id", "image", "hash", "text", distance=22)
    return similar.representatives(docs, "doc_id", similar.components(pairs)).select("doc_id", F.col("representative").alias("component"))


@query(
    "vector_top_k",
    """
WITH q AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id % 100 = 0),
s AS (SELECT q.vec_id AS query_id, e.vec_id, list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS similarity FROM q JOIN embeddings e ON e.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS INTEGER) AS rank FROM s) SELECT query_id, vec_id, rank, round(similarity, 4) AS similarity FROM r WHERE rank <= 10
""",
)
def vector_top_k(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings")
    q = v.where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("qv"))
    return vectors.nearest_of(q, v, "query_id", "vec_id", "embedding", 10).select("query_id", "vec_id", "rank", F.round("similarity", 4).alias("similarity"))


@query(
    "rrf_fusion",
    """
WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 0), s AS (SELECT vec_id, label, round(list_cosine_similarity(q.e::DOUBLE[], embedding::DOUBLE[]), 6) AS c FROM embeddings, q WHERE vec_id <> 0),
l AS (SELECT vec_id, row_number() OVER (ORDER BY c DESC, vec_id) AS k FROM (SELECT * FROM s ORDER BY c DESC, vec_id LIMIT 20)),
r AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS k FROM (SELECT * FROM s WHERE label = 3 ORDER BY vec_id LIMIT 20))
SELECT s.vec_id, round(coalesce(1.0::DOUBLE / (60 + l.k), 0) + coalesce(1.0::DOUBLE / (60 + r.k), 0) + 0.0003::DOUBLE * least(1.0, (log2(1.0 + label) + 0.5 * log2(1.0 + s.vec_id % 9)) / 10), 8) AS score, CASE WHEN l.k IS NULL THEN 'deterministic' WHEN r.k IS NULL THEN 'vector' ELSE 'both' END AS retrieval
FROM s LEFT JOIN l USING (vec_id) LEFT JOIN r USING (vec_id) WHERE l.k IS NOT NULL OR r.k IS NOT NULL
""",
)
def rrf_fusion(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings")
    q = [float(x) for x in v.where(F.col("vec_id") == 0).first()["embedding"]]
    rest = v.where(F.col("vec_id") != 0)
    scored = rest.select("vec_id", F.round(vectors.cosine("embedding", F.array(*[F.lit(x) for x in q])), 6).alias("similarity"))
    left = vectors.ranked(scored.orderBy(F.desc("similarity"), "vec_id").limit(20), "vec_id", "similarity", "left_rank")
    right = vectors.ranked(rest.where(F.col("label") == 3).select("vec_id", (-F.col("vec_id")).alias("s")).orderBy("vec_id").limit(20), "vec_id", "s", "right_rank")
    known = rest.select("vec_id", F.col("label").alias("serials"), (F.col("vec_id") % 9).alias("logs"))
    return vectors.fuse(left, right, known, "vec_id", "serials", "logs").select("vec_id", F.round("score", 8).alias("score"), "retrieval")


_RULES = terms.TermRules(field_weights={})
_COMMON = "', '".join(_RULES.common)
_TERM_SQL = f"""
f AS (SELECT doc_id, lang, source, unnest(list_filter(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}\\p{{M}}_]+'), lambda x: regexp_full_match(x, '[A-Z][A-Z0-9]*'))) AS term FROM documents),
o AS (SELECT *, CASE WHEN length(term) < 2 THEN 'too_short' WHEN regexp_full_match(term, '[A-Z]+') AND length(term) > 5 THEN 'alpha_token_too_long_for_acronym' WHEN NOT regexp_full_match(term, '[A-Z]+') AND length(term) > 10 THEN 'mixed_token_too_long' WHEN term IN ('{_COMMON}') THEN 'common_english_word' WHEN regexp_full_match(term, '[0-9]+') THEN 'ignore_pattern' END AS reason FROM f)
"""


def _occurrences(spark: SparkSession, d: str) -> DataFrame:
    return terms.occurrences(table(spark, d, "documents").select("doc_id", "lang", "source", "text"), "doc_id", "text", _RULES)


@query("term_suppression", f"WITH {_TERM_SQL} SELECT reason, count(*) AS occurrences, count(DISTINCT term) AS terms FROM o WHERE reason IS NOT NULL GROUP BY reason")
def term_suppression(spark: SparkSession, d: str) -> DataFrame:
    return terms.suppression(_occurrences(spark, d))


@query(
    "term_queue",
    f"""
WITH {_TERM_SQL}, t AS (SELECT term, count(*) AS occurrences, count(DISTINCT doc_id) AS events, count(DISTINCT source) AS serials, count(DISTINCT lang) AS models FROM o WHERE reason IS NULL GROUP BY term),
s AS (SELECT *, CAST(events * 11 + serials * 7 + models * 3 + least(occurrences, events * 2) + events AS BIGINT) AS score FROM t)
SELECT *, CASE WHEN events >= 12 OR score >= 125 THEN 'HIGH' WHEN events >= 3 OR score >= 45 THEN 'MEDIUM' ELSE 'LOW' END AS priority FROM s
""",
)
def term_queue(spark: SparkSession, d: str) -> DataFrame:
    return terms.queue(_occurrences(spark, d), "doc_id", "source", "lang", _RULES).select("term", "occurrences", "events", "serials", "models", "score", "priority")


@query(
    "scope_suggestion",
    f"""
WITH {_TERM_SQL}, e AS (SELECT DISTINCT term, doc_id, source AS oem, lang AS model FROM o WHERE reason IS NULL),
n AS (SELECT term, count(*) AS events FROM e GROUP BY term),
a AS (SELECT term, oem, count(*) AS k FROM e WHERE oem <> '' GROUP BY term, oem), ao AS (SELECT term, arg_min(oem, (-k, oem)) AS top_oem, max(k) / sum(k)::DOUBLE AS s, count(*) AS v FROM a GROUP BY term),
b AS (SELECT term, model, count(*) AS k FROM e WHERE model <> '' GROUP BY term, model), bo AS (SELECT term, arg_min(model, (-k, model)) AS top_model, max(k) / sum(k)::DOUBLE AS s FROM b GROUP BY term),
r AS (SELECT n.term, events, top_oem, top_model, CASE WHEN events < 3 THEN 'fewer_than_3_unique_repair_events' WHEN top_oem IS NOT NULL AND bo.s >= 0.85 THEN 'model_concentration' WHEN ao.s >= 0.85 THEN 'oem_concentration' WHEN v >= 2 AND ao.s < 0.65 THEN 'cross_oem_usage' ELSE 'scope_not_concentrated_enough' END AS reason
  FROM n LEFT JOIN ao USING (term) LEFT JOIN bo USING (term))
SELECT term, events, reason, CASE reason WHEN 'model_concentration' THEN 'OEM=' || top_oem || ';model=' || top_model WHEN 'oem_concentration' THEN 'OEM=' || top_oem WHEN 'cross_oem_usage' THEN 'shop' END AS suggested_scope FROM r
""",
)
def scope_suggestion(spark: SparkSession, d: str) -> DataFrame:
    return terms.scope(_occurrences(spark, d), "doc_id", "source", "lang")


@query(
    "authority_shadow",
    "SELECT d.source, count(*) FILTER (l.doc_id IS NULL) AS kept, count(*) FILTER (l.doc_id IS NOT NULL) AS shadowed FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id GROUP BY d.source",
)
def authority_shadow(spark: SparkSession, d: str) -> DataFrame:
    kept, gone = terms.shadowed(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), ["doc_id"])
    both = kept.withColumn("k", F.lit(1)).unionByName(gone.withColumn("k", F.lit(0)))
    return both.groupBy("source").agg(F.sum("k").alias("kept"), F.sum(1 - F.col("k")).alias("shadowed"))


@query(
    "latest_decision",
    "WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) SELECT user_id, event_id, event_type AS decision FROM r WHERE r = 1",
)
def latest_decision(spark: SparkSession, d: str) -> DataFrame:
    return records.latest(table(spark, d, "events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", F.col("event_type").alias("decision"))


_GLOSSARY = {"idiot": ("moron",), "the": (), "worthless": ("pathetic",)}


@query(
    "glossary_match",
    r"""
WITH t AS (SELECT doc_id, regexp_replace(concat(' ', lower(text), ' '), '[^a-z0-9]', '  ', 'g') AS t FROM documents),
h AS (SELECT doc_id, unnest(['idiot', 'the', 'worthless']) AS term, unnest([len(regexp_extract_all(t, ' (idiot|moron) ')), len(regexp_extract_all(t, ' the ')), len(regexp_extract_all(t, ' (worthless|pathetic) '))]) AS hits FROM t)
SELECT term, count(DISTINCT doc_id) AS documents, CAST(sum(hits) AS BIGINT) AS hits FROM h WHERE hits > 0 GROUP BY term
""",
)
def glossary_match(spark: SparkSession, d: str) -> DataFrame:
    return terms.known_counts(terms.known_terms(table(spark, d, "documents"), "doc_id", "text", _GLOSSARY), "doc_id")


@query(
    "mutually_exclusive_groups",
    "SELECT conv_id, count(*) AS options, count(*) FILTER (role = 'assistant') AS selected, count(*) FILTER (role NOT IN ('assistant', 'user')) AS ambiguous, count(*) FILTER (role = 'assistant') = 1 AND count(*) FILTER (role NOT IN ('assistant', 'user')) = 0 AS resolved FROM conversations GROUP BY conv_id",
)
def mutually_exclusive_groups(spark: SparkSession, d: str) -> DataFrame:
    return records.exclusive_choice(table(spark, d, "conversations"), ["conv_id"], F.col("role") == "assistant", ~F.col("role").isin("assistant", "user"))


@query(
    "consistency_checks",
    """
WITH s AS (SELECT o_orderkey, o_totalprice, count(l_orderkey) AS lines, coalesce(sum(l_quantity), 0) AS q FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT 'orders_have_lines' AS check_id, 'error' AS severity, count(*) FILTER (lines = 0) = 0 AS passed, count(*) AS compared, count(*) FILTER (NOT lines > 0) AS failed FROM s
UNION ALL SELECT 'totals_positive', 'warning', count(*) FILTER (NOT o_totalprice > 0) = 0, count(*), count(*) FILTER (NOT o_totalprice > 0) FROM s
UNION ALL SELECT 'quantity_at_least_lines', 'warning', count(*) FILTER (NOT q >= lines) = 0, count(*), count(*) FILTER (NOT q >= lines) FROM s
""",
)
def consistency_checks(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q0"))
    s = table(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_totalprice", F.coalesce("n", F.lit(0)).alias("lines"), F.coalesce("q0", F.lit(0.0)).alias("q"))
    return (
        records.check(s, "orders_have_lines", "error", F.col("lines") > 0, "lines")
        .unionByName(records.check(s, "totals_positive", "warning", F.col("o_totalprice") > 0, "o_totalprice"))
        .unionByName(records.check(s, "quantity_at_least_lines", "warning", F.col("q") >= F.col("lines"), "q"))
    )


@query(
    "positions_islands",
    """
WITH g AS (SELECT l_suppkey, l_orderkey, CASE WHEN l_orderkey - lag(l_orderkey) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) <= 40 THEN 0 ELSE 1 END AS n FROM (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem)),
i AS (SELECT *, sum(n) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) AS island FROM g)
SELECT l_suppkey, CAST(island AS BIGINT) AS island, min(l_orderkey) AS "first", max(l_orderkey) AS "last", count(*) AS members FROM i GROUP BY l_suppkey, island
""",
)
def positions_islands(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey")
    return intervals.islands(rows, ["l_suppkey"], "l_orderkey", 40, parts_for(rows), distinct=True)


@query(
    "event_windows",
    "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
)
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    return refresh.windowed_counts(table(spark, d, "events"), "ts", "event_type", "value").withColumn("total", F.round("total", 4))


@query("greedy_cluster")
def greedy_cluster(spark: SparkSession, d: str) -> DataFrame:
    """All names of a brand, clustered in key order."""
    return similar.greedy_clusters(table(spark, d, "part"), ["p_brand"], "p_partkey", "p_name")


@query("difflib_similarity")
def difflib_similarity(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    return part.select("p_partkey", F.round(similar.ratio("p_name", "p_type"), 6).alias("similarity"))


@query("budget_packing")
def budget_packing(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("lane", F.concat_ws("/", "lang", "source"))
    return packing.budget_batches(docs, "lane", "doc_id", "n_chars", 22_000)


@query(
    "point_ids",
    "SELECT doc_id, sha1('\\x6b\\xa7\\xb8\\x11\\x9d\\xad\\x11\\xd1\\x80\\xb4\\x00\\xc0\\x4f\\xd4\\x30\\xc8'::BLOB || encode(CAST(doc_id AS VARCHAR)))[1:8] AS head FROM documents",
)
def point_ids(spark: SparkSession, d: str) -> DataFrame:
    import uuid

    return table(spark, d, "documents").select("doc_id", F.substring(ids.uuid5(uuid.NAMESPACE_URL, F.col("doc_id").cast("string")), 1, 8).alias("head"))


@query(
    "rank_clusters",
    """
WITH p AS (SELECT conv_id, md5(lower(text)) AS k, role, max(CASE role WHEN 'assistant' THEN 100 ELSE 10 END) AS w, count(*) AS n FROM conversations GROUP BY ALL), p2 AS (SELECT conv_id, k, role, max(w) AS w, sum(n) AS n FROM p GROUP BY ALL),
c AS (SELECT conv_id, k, count(*) AS sources, CAST(sum(w) AS BIGINT) AS authority_sum, CAST(sum(n) AS BIGINT) AS size FROM p2 GROUP BY conv_id, k)
SELECT *, CASE WHEN sources >= 3 THEN 'confirmed' WHEN sources = 2 THEN 'corroborated' ELSE 'single_source' END AS confidence, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY sources DESC, authority_sum DESC, size DESC, k) AS INTEGER) AS rank FROM c
""",
)
def rank_clusters(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").withColumns({"k": F.md5(F.lower("text")), "authority": F.when(F.col("role") == "assistant", "primary_repair_anchor").otherwise("none")})
    return records.rank_clusters(rows, ["conv_id"], "k", "role", "authority")


@query(
    "latest_per_source_share",
    "SELECT source, lang, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY source)::DOUBLE, 6) AS share FROM documents GROUP BY source, lang",
)
def latest_per_source_share(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    return n.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("source")), 6))

