"""Part, recurrence and rollup queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import evidence
from factloom.operators import events, parts, recurrence
from factloom.plans.catalog import query, table
from factloom.storage import parts_for

# lineitem as part mentions: an order is a repair event, every fifth line states no quantity
_MENTIONS_SQL = "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_linenumber % 5 <> 0 THEN CAST(l_quantity AS INTEGER) END AS q, p_type, p_brand, p_name, p_size FROM lineitem JOIN part ON l_partkey = p_partkey"


def _mentions(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").select("p_partkey", "p_type", "p_brand", "p_name", "p_size")
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return rows.join(part, F.col("l_partkey") == F.col("p_partkey")).withColumn("q", F.when(F.col("l_linenumber") % 5 != 0, F.col("l_quantity").cast("int")))


@query(
    "part_family_frequency",
    f"""
WITH m AS ({_MENTIONS_SQL})
SELECT p_type, count(DISTINCT l_orderkey) AS repairs, CAST(coalesce(sum(q), 0) AS BIGINT) AS pieces, count(*) FILTER (q IS NULL) AS unstated, count(*) FILTER (l_linenumber = 7) AS uncertain, count(*) AS mentions FROM m GROUP BY p_type
""",
)
def part_family_frequency(spark: SparkSession, d: str) -> DataFrame:
    return parts.frequency(_mentions(spark, d), "p_type", "l_orderkey", "q", F.col("l_linenumber") == 7)


@query(
    "part_usage_top_n",
    f"""
WITH m AS ({_MENTIONS_SQL}), u AS (SELECT p_brand, l_partkey, count(DISTINCT l_orderkey) AS repairs, CAST(coalesce(sum(q), 0) AS BIGINT) AS pieces, count(*) FILTER (q IS NULL) AS unstated FROM m GROUP BY p_brand, l_partkey),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY repairs DESC, pieces DESC, l_partkey) AS INTEGER) AS rank FROM u)
SELECT * FROM r WHERE rank <= 15
""",
)
def part_usage_top_n(spark: SparkSession, d: str) -> DataFrame:
    m = _mentions(spark, d).withColumn("k", F.struct("p_brand", "l_partkey"))
    use = parts.frequency(m, "k", "l_orderkey", "q").select("k.p_brand", "k.l_partkey", "repairs", "pieces", "unstated")
    return events.top_per_group(use, ["p_brand"], [F.desc("repairs"), F.desc("pieces"), "l_partkey"], 15)


@query(
    "product_parts",
    f"""
WITH m AS (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN 'PN-' || l_partkey ELSE '' END AS pn FROM ({_MENTIONS_SQL})),
k AS (SELECT *, CASE WHEN pn <> '' THEN 'pn:' || upper(regexp_replace(pn, '[^A-Za-z0-9]+', '', 'g')) ELSE 'text:' || regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g')[1:96] END AS component_key FROM m)
SELECT p_brand, component_key, count(DISTINCT l_orderkey) AS repairs, CAST(coalesce(sum(q), 0) AS BIGINT) AS pieces, count(*) FILTER (q IS NULL) AS unstated,
  coalesce(max(nullif(pn, '')), (arg_min(p_name, (-n, f)))) AS display_name
FROM (SELECT k.*, c.n, c.f FROM k JOIN (SELECT p_brand, component_key, p_name, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS f FROM k GROUP BY ALL) c USING (p_brand, component_key, p_name))
GROUP BY p_brand, component_key
""",
)
def product_parts(spark: SparkSession, d: str) -> DataFrame:
    m = _mentions(spark, d).withColumns({"pn": F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("PN-"), "l_partkey")).otherwise(""), "seen": F.col("l_orderkey") * 10 + F.col("l_linenumber")})
    return parts.product_parts(m, "p_brand", "l_orderkey", "pn", "p_name", "q", "seen").select("p_brand", "component_key", "repairs", "pieces", "unstated", "display_name")


@query(
    "product_families",
    f"""
WITH m AS ({_MENTIONS_SQL}), u AS (SELECT p_brand, p_name AS display_name, CAST(l_partkey AS VARCHAR) AS component_key, count(DISTINCT l_orderkey) AS repairs, CAST(coalesce(sum(q), 0) AS BIGINT) AS pieces FROM m GROUP BY p_brand, p_name, l_partkey),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY repairs DESC, pieces DESC, lower(display_name), component_key) AS rank FROM u)
SELECT p_brand, count(*) AS components, CAST(sum(pieces) AS BIGINT) AS pieces, string_agg(display_name, ' | ' ORDER BY rank) FILTER (rank <= 15) AS top_parts FROM r GROUP BY p_brand
""",
)
def product_families(spark: SparkSession, d: str) -> DataFrame:
    m = _mentions(spark, d).withColumn("k", F.struct("p_brand", F.col("p_name").alias("display_name"), F.col("l_partkey").cast("string").alias("component_key")))
    return parts.product_families(parts.frequency(m, "k", "l_orderkey", "q").select("k.*", "repairs", "pieces"), "p_brand")


@query(
    "descriptors",
    r"""
WITH m AS (SELECT l_orderkey, l_orderkey * 10 + l_linenumber AS mention_id, CASE WHEN l_linenumber % 3 = 0 THEN concat('qx ', l_partkey) WHEN l_linenumber % 3 = 1 THEN concat('QX-', l_partkey) ELSE '' END AS pn, p_name FROM lineitem JOIN part ON l_partkey = p_partkey),
k AS (SELECT *, CASE WHEN pn <> '' THEN 'PN:' || upper(regexp_replace(pn, '[^A-Za-z0-9]+', '', 'g')) ELSE 'DESC:' || trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) END AS canonical_key FROM m)
SELECT canonical_key, 'd_' || sha256(canonical_key)[1:16] AS descriptor_id, count(*) AS mentions, count(DISTINCT l_orderkey) AS events FROM k GROUP BY canonical_key
""",
)
def descriptors(spark: SparkSession, d: str) -> DataFrame:
    m = _mentions(spark, d)
    pn = F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("qx "), "l_partkey")).when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("QX-"), "l_partkey")).otherwise("")
    out = parts.descriptors(m.withColumns({"pn": pn, "mention_id": F.col("l_orderkey") * 10 + F.col("l_linenumber")}), "mention_id", "l_orderkey", "pn", "p_name", "p_name")
    return out.select("canonical_key", "descriptor_id", "mentions", "events")


@query(
    "family_membership_usage",
    f"""
WITH m AS ({_MENTIONS_SQL}) SELECT concat('size-', p_size % 7) AS family, count(DISTINCT l_orderkey) AS repairs, CAST(coalesce(sum(q), 0) AS BIGINT) AS pieces, count(*) FILTER (q IS NULL) AS unstated, CAST(0 AS BIGINT) AS uncertain, count(*) AS mentions FROM m GROUP BY 1
""",
)
def family_membership_usage(spark: SparkSession, d: str) -> DataFrame:
    """Mentions to descriptors (parts) to families, through the families' membership rows."""
    members = table(spark, d, "part").select(F.concat(F.lit("size-"), F.col("p_size") % 7).alias("family"), F.col("p_partkey").alias("l_partkey"))
    m = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", F.when(F.col("l_linenumber") % 5 != 0, F.col("l_quantity").cast("int")).alias("q"))
    return parts.usage_by_group(m, members, "l_partkey", "family", "l_orderkey", "q")


@query(
    "recurring_groups",
    """
SELECT p_type, count(*) AS candidates, count(DISTINCT l_orderkey) AS distinct_logs, count(DISTINCT l_suppkey) AS distinct_sources, count(DISTINCT o_custkey) AS distinct_serials
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY p_type HAVING count(DISTINCT l_orderkey) >= 2 AND count(DISTINCT l_suppkey) >= 2
""",
)
def recurring_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = _mentions(spark, d).join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return recurrence.recurring(rows, ["p_type"], "l_orderkey", "l_suppkey", "o_custkey", parts=parts_for(table(spark, d, "lineitem")))


_AREAS = {"Rings": ("ring",), "Widgets": ("widget", "gadget"), "Fasteners": ("bolt", "screw", "gear"), "Colours": ("red", "blue", "green")}
_AREA_SQL = "list_filter([" + ", ".join("CASE WHEN " + " OR ".join(f"contains(lower(p_name), '{w}')" for w in words) + f" THEN '{a}' END" for a, words in _AREAS.items()) + "], lambda x: x IS NOT NULL)"


@query(
    "service_area_rollup",
    f"""
WITH g AS (SELECT p_partkey, p_brand, p_type, CASE WHEN len({_AREA_SQL}) = 0 THEN ['Other technician signal'] ELSE {_AREA_SQL} END AS areas FROM part),
t AS (SELECT p_partkey, unnest(areas) AS service_area FROM g),
l AS (SELECT p_partkey, service_area, l_orderkey, l_suppkey FROM t JOIN lineitem ON l_partkey = p_partkey),
n AS (SELECT l_partkey, count(*) AS c FROM lineitem GROUP BY l_partkey)
SELECT t.service_area, count(DISTINCT t.p_partkey) AS groups, CAST(sum(c) AS BIGINT) AS candidate_sum,
  (SELECT count(DISTINCT l_orderkey) FROM l WHERE l.service_area = t.service_area) AS logs, (SELECT count(DISTINCT l_suppkey) FROM l WHERE l.service_area = t.service_area) AS serials
FROM t JOIN n ON n.l_partkey = t.p_partkey GROUP BY t.service_area
""",
)
def service_area_rollup(spark: SparkSession, d: str) -> DataFrame:
    return recurrence.area_rollup(_mentions(spark, d), F.lower("p_name"), "l_partkey", "l_orderkey", "l_suppkey", _AREAS)


@query(
    "service_area_patterns",
    f"""
WITH g AS (SELECT p_partkey, p_retailprice, CASE WHEN len({_AREA_SQL}) = 0 THEN ['Other technician signal'] ELSE {_AREA_SQL} END AS areas FROM part),
t AS (SELECT unnest(areas) AS service_area, p_partkey, p_retailprice FROM g), r AS (SELECT service_area, p_partkey, CAST(row_number() OVER (PARTITION BY service_area ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS rank FROM t)
SELECT * FROM r WHERE rank <= 8
""",
)
def service_area_patterns(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    return recurrence.area_patterns(part, F.lower("p_name"), [F.desc("p_retailprice"), "p_partkey"], 8, _AREAS).select("service_area", "p_partkey", "rank")


_STOCK = {"Rings": (("ring",), "wear item"), "Widgets": (("widget",), "rebuild item"), "Bolts": (("bolt",), "hardware")}
_CUES = ("promo", "economy", "standard")


@query(
    "stocking_attention",
    """
WITH i(item, kind, word) AS (VALUES ('Rings', 'wear item', 'ring'), ('Widgets', 'rebuild item', 'widget'), ('Bolts', 'hardware', 'bolt')),
v AS (SELECT p_brand AS g, l_orderkey AS log, l_suppkey AS serial, lower(p_name || ' ' || p_type) AS t FROM lineitem JOIN part ON l_partkey = p_partkey),
b AS (SELECT DISTINCT p_brand AS g, lower(p_mfgr) AS label FROM part),
h AS (SELECT item, kind, g, log, serial FROM i JOIN v ON contains(t, word) AND (contains(t, 'promo') OR contains(t, 'economy') OR contains(t, 'standard'))),
ok AS (SELECT item, g FROM h GROUP BY item, g HAVING count(DISTINCT log) >= 2)
SELECT item, kind, count(DISTINCT h.g) AS groups, count(DISTINCT log) AS logs, count(DISTINCT serial) AS serials, CAST(0 AS BIGINT) AS by_label FROM h JOIN ok USING (item, g) GROUP BY item, kind
""",
)
def stocking_attention(spark: SparkSession, d: str) -> DataFrame:
    """Brands as groups of the lane of repairs, lines as their evidence rows."""
    rows = _mentions(spark, d).withColumns({"lane": F.lit("repairs"), "t": F.concat_ws(" ", "p_name", "p_type")})
    return recurrence.stocking(rows, "p_brand", "lane", F.lit(""), "l_orderkey", "l_suppkey", "t", _STOCK, _CUES)


_NOTE_SQL = "CASE l_linenumber % 4 WHEN 0 THEN concat('Replaced ', CAST(l_quantity AS INT), ' belts for A1') WHEN 1 THEN concat('Installed belts x', CAST(l_quantity AS INT), ' on Y') WHEN 2 THEN concat('Cleaned belts, may be due to wear (', CAST(l_quantity AS INT), ' total)') ELSE 'belts slipping caused by wear' END"
_NOTE = "case l_linenumber % 4 when 0 then concat('Replaced ', cast(l_quantity as int), ' belts for A1') when 1 then concat('Installed belts x', cast(l_quantity as int), ' on Y') when 2 then concat('Cleaned belts, may be due to wear (', cast(l_quantity as int), ' total)') else 'belts slipping caused by wear' end"


@query(
    "quantity_parse",
    """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 4 < 3 THEN CAST(l_quantity AS INTEGER) END AS quantity, CASE l_linenumber % 4 WHEN 0 THEN 'numeric_prefix' WHEN 1 THEN 'explicit_x_quantity' WHEN 2 THEN 'explicit_total' ELSE 'not_established' END AS source FROM lineitem
""",
)
def quantity_parse(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.split(F.expr(_NOTE), "belts", 2).alias("s"))
    return rows.select("l_orderkey", "l_linenumber", evidence.quantity_near(F.get("s", F.lit(0)), F.get("s", F.lit(1))).alias("x")).select("l_orderkey", "l_linenumber", "x.quantity", "x.source")


@query(
    "note_classify",
    f"""
WITH n AS (SELECT l_orderkey, l_linenumber, {_NOTE_SQL} AS n FROM lineitem)
SELECT CASE WHEN contains(n, ' may ') THEN 'diagnostic_hypothesis' WHEN contains(n, 'caused by') THEN 'root_cause_candidate' ELSE 'diagnostic_observation' END AS note_class, CASE WHEN contains(n, ' may ') THEN 'not_confirmed' WHEN contains(n, 'caused by') THEN 'pending_human_confirmation' ELSE 'not_established' END AS status, count(*) AS n FROM n GROUP BY ALL
""",
)
def note_classify(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "lineitem").select(F.expr(_NOTE).alias("note"))
    return n.groupBy(evidence.note_class("note").alias("note_class"), evidence.root_cause_status("note").alias("status")).agg(F.count("*").alias("n"))


@query(
    "part_mention_classify",
    "SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 'installed' WHEN 1 THEN 'installed' WHEN 2 THEN 'serviced' ELSE 'referenced' END AS mention_class FROM lineitem",
)
def part_mention_classify(spark: SparkSession, d: str) -> DataFrame:
    note = F.regexp_replace(F.expr(_NOTE), "slipping", "slipping".replace("slipping", "squealing"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", evidence.mention_class(note).alias("mention_class"))


@query(
    "procurement_references",
    r"""
WITH r AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN concat('Parts ordered DigiKey ', 50000 + s_suppkey) WHEN 1 THEN concat('MSR ', 50000 + s_suppkey) WHEN 2 THEN concat('RMA # ', s_suppkey) ELSE 'ordered parts from stock' END AS e FROM supplier)
SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN CAST(50000 + s_suppkey AS VARCHAR) WHEN 1 THEN concat('MSR', 50000 + s_suppkey) END AS ref, CASE s_suppkey % 4 WHEN 0 THEN 'Digi-Key' WHEN 1 THEN 'Mouser' END AS supplier,
  CASE s_suppkey % 4 WHEN 2 THEN CAST(s_suppkey AS VARCHAR) ELSE upper(regexp_replace(e, '[^A-Za-z0-9]+', '', 'g')) END AS rma, s_suppkey % 4 = 1 AS procurement_only FROM r
""",
)
def procurement_references(spark: SparkSession, d: str) -> DataFrame:
    e = F.expr("case s_suppkey % 4 when 0 then concat('Parts ordered DigiKey ', 50000 + s_suppkey) when 1 then concat('MSR ', 50000 + s_suppkey) when 2 then concat('RMA # ', s_suppkey) else 'ordered parts from stock' end")
    rows = table(spark, d, "supplier").select("s_suppkey", e.alias("e")).withColumn("v", evidence.visible_order("e"))
    only = evidence.procurement_only(F.concat(F.lit(""), F.col("s_suppkey") + 50000), F.lit(""), "e", "e")
    return rows.select("s_suppkey", "v.ref", "v.supplier", evidence.rma_number("e").alias("rma"), only.alias("procurement_only"))
