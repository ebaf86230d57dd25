"""The questions that users ask of the entity tables, over their stand-ins, and pages about one entity.

Firms are suppliers, projects orders (their place the customer's nation, their typology the priority), roles
line items, articles documents, quotes turns of conversations, sources and probe runs events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import graph
from tessera.plans.registry import Tables, query


def _placed(t: Tables) -> DataFrame:
    """Projects with their place."""
    home = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("city"), "n_regionkey")
    return t.orders.join(home, F.col("o_custkey") == F.col("c_custkey"))


def _firm_roles(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag", "l_linestatus").join(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))


@query("SELECT o_orderkey, n_name AS city FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey ORDER BY o_orderkey LIMIT 50")
def projects_by_city(t: Tables) -> DataFrame:
    return _placed(t).select("o_orderkey", "city").orderBy("o_orderkey").limit(50)


@query("SELECT o_orderkey, n_name AS city, o_orderpriority AS typology, round(o_totalprice)::BIGINT AS cost FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")
def projects_with_cost(t: Tables) -> DataFrame:
    return _placed(t).select("o_orderkey", "city", F.col("o_orderpriority").alias("typology"), F.round("o_totalprice").cast("long").alias("cost"))


@query("SELECT DISTINCT o_orderkey, s_name FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey WHERE 'project ' || o_orderkey ILIKE '%77' AND l_linestatus = 'O' AND (l_returnflag = 'A' OR s_name ILIKE '%9')")
def architects_of_projects(t: Tables) -> DataFrame:
    """Firms of a project named by a part of its name, by their role or kind."""
    named = t.orders.where(F.concat(F.lit("project "), "o_orderkey").ilike("%77")).select("o_orderkey")
    rows = _firm_roles(t).where("l_linestatus = 'O'").where((F.col("l_returnflag") == "A") | F.col("s_name").ilike("%9"))
    return rows.join(named, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", "s_name").distinct()


@query("SELECT d.doc_id, d.source AS project, l.quality FROM documents d LEFT JOIN labels l USING (doc_id) WHERE regexp_matches(coalesce(d.text, ''), '[0-9]')")
def stat_claims_with_project(t: Tables) -> DataFrame:
    """Claims with a figure, and their project where there is one."""
    return t.documents.where(F.coalesce("text", F.lit("")).rlike("[0-9]")).join(t.labels, "doc_id", "left").select("doc_id", F.col("source").alias("project"), "quality")


@query("SELECT conv_id, turn, role FROM conversations WHERE role ILIKE 'assist%' AND text IS NOT NULL")
def quotes_by_firm(t: Tables) -> DataFrame:
    return t.conversations.where(F.col("role").ilike("assist%") & F.col("text").isNotNull()).select("conv_id", "turn", "role")


@query("SELECT o_orderkey, e.event_type AS source_type, count(e.event_id) AS n_seen FROM orders LEFT JOIN events e ON e.user_id = o_orderkey GROUP BY ALL")
def projects_with_source(t: Tables) -> DataFrame:
    """Every project with its sources; events are counted before the join."""
    seen = t.events.groupBy(F.col("user_id").alias("o_orderkey"), F.col("event_type").alias("source_type")).agg(F.count("event_id").alias("n"))
    return t.orders.select("o_orderkey").join(seen, "o_orderkey", "left").select("o_orderkey", "source_type", F.coalesce("n", F.lit(0)).alias("n_seen"))


@query("SELECT user_id AS article_id, event_type AS probe, count(*) AS n_runs, max(ts) AS last_ran FROM events GROUP BY ALL")
def probe_runs_per_article(t: Tables) -> DataFrame:
    return t.events.groupBy(F.col("user_id").alias("article_id"), F.col("event_type").alias("probe")).agg(F.count("*").alias("n_runs"), F.max("ts").alias("last_ran"))


@query("SELECT l_orderkey AS article_id FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_name ILIKE '%00001' UNION SELECT doc_id FROM documents WHERE text ILIKE '%00001%'")
def articles_mentioning_firm(t: Tables) -> DataFrame:
    """By their text, or by a role of their project."""
    by_role = _firm_roles(t).where(F.col("s_name").ilike("%00001")).select(F.col("l_orderkey").alias("article_id"))
    return by_role.unionByName(t.documents.where(F.col("text").ilike("%00001%")).select(F.col("doc_id").alias("article_id"))).distinct()


@query("SELECT s_suppkey, bool_or(o_orderpriority = '1-URGENT') AS involved, count(DISTINCT o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS n_projects FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL")
def firm_in_typology(t: Tables) -> DataFrame:
    rows = _firm_roles(t).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return rows.groupBy("s_suppkey").agg(F.max(urgent).alias("involved"), F.countDistinct(F.when(urgent, F.col("o_orderkey"))).alias("n_projects"))


@query("WITH w AS (SELECT DISTINCT l_suppkey AS firm, o_orderkey AS k, o_orderpriority AS kind, o_orderdate AS tm FROM lineitem JOIN orders ON o_orderkey = l_orderkey), r AS (SELECT firm, first(kind ORDER BY tm, k) AS first_kind, last(kind ORDER BY tm, k) AS last_kind FROM w GROUP BY firm) SELECT * FROM r WHERE first_kind <> last_kind")
def firm_migration(t: Tables) -> DataFrame:
    """Firms whose last project is of another typology than their first."""
    work = t.lineitem.select(F.col("l_suppkey").alias("firm"), "l_orderkey").join(t.orders.select("o_orderkey", F.col("o_orderpriority").alias("kind"), F.col("o_orderdate").alias("at")), F.col("l_orderkey") == F.col("o_orderkey"))
    return graph.migrations(work, "firm", "kind", "at", "o_orderkey")


_KINDS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("SELECT l_suppkey AS firm, " + ", ".join(f"count(DISTINCT o_orderkey) FILTER (o_orderpriority = '{k}') AS \"{k[2:].lower().replace(' ', '_')}\"" for k in _KINDS) + ", count(DISTINCT n_name) AS n_places, round(median(o_totalprice), 4) AS typical_cost FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def firm_page(t: Tables) -> DataFrame:
    """A firm's mix of typologies, footprint and typical cost (each role counts once in the median)."""
    rows = t.lineitem.select(F.col("l_suppkey").alias("firm"), "l_orderkey").join(_placed(t).select("o_orderkey", "o_orderpriority", "o_totalprice", "city"), F.col("l_orderkey") == F.col("o_orderkey"))
    mix = [F.countDistinct(F.when(F.col("o_orderpriority") == k, F.col("o_orderkey"))).alias(k[2:].lower().replace(" ", "_")) for k in _KINDS]
    return rows.groupBy("firm").agg(*mix, F.countDistinct("city").alias("n_places"), F.round(F.median("o_totalprice"), 4).alias("typical_cost"))


@query("SELECT event_type, date_trunc('quarter', ts)::TIMESTAMP AS quarter, count(*) AS n, count(*) - lag(count(*)) OVER (PARTITION BY event_type ORDER BY date_trunc('quarter', ts)) AS change FROM events GROUP BY event_type, date_trunc('quarter', ts)")
def market_brief(t: Tables) -> DataFrame:
    """Mentions by quarter and their change."""
    counts = t.events.groupBy("event_type", F.date_trunc("quarter", "ts").alias("quarter")).agg(F.count("*").alias("n"))
    return counts.withColumn("change", F.col("n") - F.lag("n").over(Window.partitionBy("event_type").orderBy("quarter")))


@query("WITH p AS (SELECT a.l_suppkey AS firm, b.l_suppkey AS partner, count(DISTINCT a.l_orderkey) AS n FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey <> b.l_suppkey WHERE a.l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH') GROUP BY ALL) SELECT firm, partner, n, k::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY firm ORDER BY n DESC, partner) AS k FROM p) WHERE k <= 3")
def pursuit_dossier(t: Tables) -> DataFrame:
    """Whom to team with: each firm's three most frequent partners in one typology."""
    parts = graph.spread(t.lineitem)  # the semi-join, the pairs and the ranks are dealt out alike
    high = t.orders.where("o_orderpriority = '2-HIGH'").select(F.col("o_orderkey").alias("l_orderkey")).repartition(parts, "l_orderkey")
    some = t.lineitem.select("l_orderkey", "l_suppkey").repartition(parts, "l_orderkey").join(high, "l_orderkey", "left_semi")
    pairs = graph.teaming(some, "l_orderkey", "l_suppkey", parts)
    way = lambda x, y: F.struct(F.col(x).alias("firm"), F.col(y).alias("partner"), F.col("n_projects").alias("n"))
    both = pairs.select(F.inline(F.array(way("a", "b"), way("b", "a")))).repartition(parts, "firm")
    return both.withColumn("rank", F.row_number().over(Window.partitionBy("firm").orderBy(F.desc("n"), "partner"))).where("rank <= 3")
