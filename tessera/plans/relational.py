"""Joins, aggregates, windows, keyed writes and checks over the entity tables' stand-ins.

Firms are suppliers, people customers, projects orders, roles line items, articles documents, quotes
turns of conversations, probe runs events, and web pages pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import graph, upsert
from tessera.plans.registry import Tables, query


def _roles(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("project_id"), F.col("l_suppkey").alias("firm_id"), F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("role"), F.col("l_linestatus").alias("team"))


@query("SELECT s_suppkey, s_name, count(*) AS n_roles FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL ORDER BY n_roles DESC, s_suppkey LIMIT 50")
def firm_leaderboard(t: Tables) -> DataFrame:
    """Firms by roles: aggregated before the join."""
    counts = t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n_roles"))
    return counts.join(t.supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey")).select("s_suppkey", "s_name", "n_roles").orderBy(F.desc("n_roles"), "s_suppkey").limit(50)


@query("SELECT l_suppkey AS firm_id, s_name, count(DISTINCT l_orderkey) AS n_projects FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL")
def firm_project_count(t: Tables) -> DataFrame:
    counts = _roles(t).groupBy("firm_id").agg(F.countDistinct("project_id").alias("n_projects"))
    return counts.join(t.supplier, F.col("firm_id") == F.col("s_suppkey")).select("firm_id", "s_name", "n_projects")


@query("SELECT l_orderkey AS project_id, l_linestatus AS team, string_agg(DISTINCT s_name, ', ' ORDER BY s_name) AS firms FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL")
def team_roster(t: Tables) -> DataFrame:
    """Names are joined to the distinct firms of a team, not to its roles."""
    one = _roles(t).select("project_id", "team", "firm_id").distinct()
    named = one.join(t.supplier.select(F.col("s_suppkey").alias("firm_id"), "s_name"), "firm_id")
    return named.groupBy("project_id", "team").agg(F.array_join(F.sort_array(F.collect_set("s_name")), ", ").alias("firms"))


@query("SELECT l_orderkey AS project_id, l_linestatus AS team, count(*) AS n_roles FROM lineitem GROUP BY ALL")
def roles_per_project_team(t: Tables) -> DataFrame:
    return _roles(t).groupBy("project_id", "team").agg(F.count("*").alias("n_roles"))


@query("SELECT l_orderkey AS project_id, count(DISTINCT l_suppkey) AS n_firms, string_agg(DISTINCT l_suppkey::VARCHAR, ',' ORDER BY l_suppkey::VARCHAR) AS firms FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_suppkey) > 1")
def multi_firm_projects(t: Tables) -> DataFrame:
    firms = F.sort_array(F.collect_set(F.col("firm_id").cast("string")))
    return _roles(t).groupBy("project_id").agg(firms.alias("f")).where("size(f) > 1").select("project_id", F.size("f").cast("long").alias("n_firms"), F.array_join("f", ",").alias("firms"))


@query("SELECT project_id, firm_id, role, team, line FROM (SELECT l_orderkey AS project_id, l_suppkey AS firm_id, l_returnflag AS role, l_linestatus AS team, l_linenumber AS line, row_number() OVER (PARTITION BY l_orderkey, l_suppkey, l_returnflag, l_linestatus ORDER BY l_linenumber) AS k FROM lineitem) WHERE k = 1")
def role_natural_key_dedup(t: Tables) -> DataFrame:
    return upsert.first_by_key(_roles(t), ["project_id", "firm_id", "role", "team"], ["line"]).select("project_id", "firm_id", "role", "team", "line")


_KEYED = "SELECT l_orderkey AS project_id, l_suppkey AS firm_id, l_returnflag AS role, l_linestatus AS team, l_linenumber AS line, row_number() OVER (PARTITION BY l_orderkey, l_suppkey, l_returnflag, l_linestatus ORDER BY l_linenumber) AS k FROM lineitem WHERE year(l_shipdate) {}"


@query(f"WITH old AS ({_KEYED.format('< 1996')}), new AS ({_KEYED.format('>= 1996')}) SELECT project_id, firm_id, role, team, line FROM old WHERE k = 1 UNION ALL SELECT project_id, firm_id, role, team, line FROM new n WHERE k = 1 AND NOT EXISTS (SELECT 1 FROM old o WHERE o.project_id = n.project_id AND o.firm_id = n.firm_id AND o.role = n.role AND o.team = n.team)")
def role_insert_if_absent(t: Tables) -> DataFrame:
    """Line items of later years inserted where their key is new."""
    rows = t.lineitem.select(F.col("l_orderkey").alias("project_id"), F.col("l_suppkey").alias("firm_id"), F.col("l_returnflag").alias("role"), F.col("l_linestatus").alias("team"), F.col("l_linenumber").alias("line"), F.year("l_shipdate").alias("y"))
    keys = ["project_id", "firm_id", "role", "team"]
    old = upsert.first_by_key(rows.where("y < 1996").drop("y"), keys, ["line"])
    return upsert.insert_if_absent(old, rows.where("y >= 1996").drop("y"), keys, ["line"])


@query("SELECT user_id, event_type, min(ts) AS first_seen, max(ts) AS last_seen, max(value) AS confidence FROM events WHERE user_id IS NOT NULL AND event_type <> '' GROUP BY ALL")
def source_upsert_greatest(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_type", F.col("ts").alias("first_seen"), F.col("ts").alias("last_seen"), F.col("value").alias("confidence"), F.pmod("event_id", F.lit(2)).alias("half"))
    keys = ["user_id", "event_type"]
    start = upsert.upsert_sightings(rows.where("half = 0").limit(0), rows.where("half = 0"), keys)
    return upsert.upsert_sightings(start, rows.where("half = 1"), keys)


@query("WITH a AS (SELECT DISTINCT l_orderkey AS article_id, l_suppkey AS project_id FROM lineitem WHERE l_linenumber <= 2), b AS (SELECT DISTINCT l_orderkey AS article_id, l_suppkey AS project_id FROM lineitem WHERE l_linenumber = 2 OR l_linenumber = 3) SELECT coalesce(a.article_id, b.article_id) AS article_id, coalesce(a.project_id, b.project_id) AS project_id, b.article_id IS NOT NULL AS is_primary FROM a FULL JOIN b ON a.article_id = b.article_id AND a.project_id = b.project_id")
def bridge_upsert_primary(t: Tables) -> DataFrame:
    pairs = t.lineitem.select(F.col("l_orderkey").alias("article_id"), F.col("l_suppkey").alias("project_id"), "l_linenumber")
    old = pairs.where("l_linenumber <= 2").select("article_id", "project_id").distinct().withColumn("is_primary", F.lit(False))
    return upsert.upsert_flag(old, pairs.where("l_linenumber in (2, 3)"), ["article_id", "project_id"], "is_primary")


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderpriority END, c_mktsegment) AS kept, coalesce(c_mktsegment, o_orderpriority) AS replaced FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def fill_null_metadata(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority")).alias("kept"), F.col("o_orderpriority").alias("replaced"))
    new = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("kept"), F.col("c_mktsegment").alias("replaced"))
    return upsert.fill_nulls(rows, new, "o_custkey", keep=["kept"], replace=["replaced"]).select("o_orderkey", "kept", "replaced")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') UNION ALL SELECT l_orderkey, l_linenumber, 0.0 FROM lineitem WHERE l_returnflag = 'R'")
def replace_scope_children(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    new = rows.where("l_returnflag = 'R'").withColumn("l_quantity", F.lit(0.0))
    return upsert.replace_scope(rows, new, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_name, c_custkey) AS id FROM customer")
def insert_with_ids(t: Tables) -> DataFrame:
    return upsert.with_ids(t.customer.select("c_custkey", "c_name"), ["c_name", "c_custkey"])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def projects_without_roles(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE (o_orderkey) IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def collision_semi_join(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem.where("l_returnflag = 'R'"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey", "o_custkey")


@query("SELECT a.c_custkey, count(*) AS n_same FROM customer a JOIN customer b ON a.c_mktsegment IS NOT DISTINCT FROM b.c_mktsegment AND a.c_nationkey IS NOT DISTINCT FROM b.c_nationkey GROUP BY ALL")
def null_safe_peers(t: Tables) -> DataFrame:
    """Peers by null-safe keys: counted, not paired."""
    sizes = t.customer.groupBy(F.col("c_mktsegment").alias("s"), F.col("c_nationkey").alias("n")).agg(F.count("*").alias("n_same"))
    on = F.col("c_mktsegment").eqNullSafe(F.col("s")) & F.col("c_nationkey").eqNullSafe(F.col("n"))
    return t.customer.join(sizes, on).select("c_custkey", "n_same")


@query("SELECT 'region' AS table_name, count(*) AS n FROM region UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'conversations', count(*) FROM conversations")
def row_counts(t: Tables) -> DataFrame:
    out = None
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations"):
        one = getattr(t, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT (SELECT count(*) FROM lineitem)::DOUBLE / (SELECT count(*) FROM orders) AS roles_per_project, (SELECT count(*) FROM orders)::DOUBLE / (SELECT count(*) FROM customer) AS projects_per_person")
def ratio_checks(t: Tables) -> DataFrame:
    count = lambda name: getattr(t, name).agg(F.count("*").cast("double").alias(name))  # noqa: E731  a row each
    return count("lineitem").crossJoin(count("orders")).crossJoin(count("customer")).select((F.col("lineitem") / F.col("orders")).alias("roles_per_project"), (F.col("orders") / F.col("customer")).alias("projects_per_person"))


@query("SELECT a.l_suppkey AS a, b.l_suppkey AS b, count(*) AS n_projects FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) a JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey GROUP BY ALL")
def teaming_pairs(t: Tables) -> DataFrame:
    return graph.teaming(t.lineitem, "l_orderkey", "l_suppkey")


@query("WITH d AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem), m AS (SELECT DISTINCT a.l_suppkey AS a, b.l_suppkey AS b FROM d a JOIN d b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey <> b.l_suppkey) SELECT s.s_suppkey, count(DISTINCT o.s_suppkey) AS n_never FROM supplier s LEFT JOIN supplier o ON o.s_nationkey = s.s_nationkey AND o.s_suppkey <> s.s_suppkey AND NOT EXISTS (SELECT 1 FROM m WHERE m.a = s.s_suppkey AND m.b = o.s_suppkey) GROUP BY ALL")
def never_teamed(t: Tables) -> DataFrame:
    """With how many firms of its nation a firm never shared a project: counted as a difference, without the pairs.  Only firms of one nation are paired."""
    home = t.supplier.select("s_suppkey", "s_nationkey")
    placed = t.lineitem.select("l_orderkey", "l_suppkey").join(home.hint("shuffle_hash"), F.col("l_suppkey") == F.col("s_suppkey"))  # roles are not sorted
    met = graph.teaming(placed, "l_orderkey", "l_suppkey", graph.spread(t.lineitem), ["s_nationkey"])
    near = met.select(F.explode(F.array("a", "b")).alias("s_suppkey")).groupBy("s_suppkey").agg(F.count("*").alias("met"))
    sizes = home.groupBy("s_nationkey").agg(F.count("*").alias("n"))
    return home.join(sizes, "s_nationkey").join(near, "s_suppkey", "left").select("s_suppkey", (F.col("n") - 1 - F.coalesce("met", F.lit(0))).alias("n_never"))


@query("SELECT o_orderpriority, year(o_orderdate)::INTEGER AS year, count(*) AS n, round(quantile_cont(o_totalprice, 0.25), 4) AS p25, round(quantile_cont(o_totalprice, 0.5), 4) AS p50, round(quantile_cont(o_totalprice, 0.75), 4) AS p75 FROM orders GROUP BY ALL")
def cost_distribution(t: Tables) -> DataFrame:
    at = lambda p, name: F.round(F.percentile("o_totalprice", F.lit(p)), 4).alias(name)
    return t.orders.groupBy("o_orderpriority", F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"), at(0.25, "p25"), at(0.5, "p50"), at(0.75, "p75"))


@query("SELECT event_type, date_trunc('month', ts)::TIMESTAMP AS month, count(*) AS n, count(*) - lag(count(*)) OVER (PARTITION BY event_type ORDER BY date_trunc('month', ts)) AS change FROM events GROUP BY event_type, date_trunc('month', ts)")
def mention_trend(t: Tables) -> DataFrame:
    counts = t.events.groupBy("event_type", F.date_trunc("month", "ts").alias("month")).agg(F.count("*").alias("n"))
    return counts.withColumn("change", F.col("n") - F.lag("n").over(Window.partitionBy("event_type").orderBy("month")))


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)")
def spend_rollup(t: Tables) -> DataFrame:
    return t.orders.rollup("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


#: table, column, parent, parent's column
FOREIGN_KEYS = (("nation", "n_regionkey", "region", "r_regionkey"), ("customer", "c_nationkey", "nation", "n_nationkey"), ("supplier", "s_nationkey", "nation", "n_nationkey"), ("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("labels", "doc_id", "documents", "doc_id"))


@query(" UNION ALL ".join(f"SELECT '{a}.{b}' AS key_name, count(*) AS n_orphans FROM {a} WHERE {b} NOT IN (SELECT {d} FROM {c})" for a, b, c, d in FOREIGN_KEYS))
def fk_orphan_check(t: Tables) -> DataFrame:
    out = None
    for a, b, c, d in FOREIGN_KEYS:
        lost = getattr(t, a).select(b).where(F.col(b).isNotNull()).join(getattr(t, c).select(F.col(d).alias("_d")), F.col(b) == F.col("_d"), "left_anti")
        one = lost.agg(F.count("*").alias("n_orphans")).select(F.lit(f"{a}.{b}").alias("key_name"), "n_orphans")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT s.s_name AS firm, n.n_name AS nation, count(DISTINCT l.l_orderkey) AS n_projects, round(sum(o.o_totalprice), 2) AS total FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE n.n_regionkey = 1 GROUP BY ALL")
def firm_involvement(t: Tables) -> DataFrame:
    """Firms to roles to projects, within one region: dimensions are small and joined by broadcast when their size allows."""
    firms = t.supplier.join(t.nation.where("n_regionkey = 1"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("s_name").alias("firm"), F.col("n_name").alias("nation"))
    rows = t.lineitem.select("l_suppkey", "l_orderkey").join(firms, F.col("l_suppkey") == F.col("s_suppkey")).join(t.orders.select("o_orderkey", "o_totalprice"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy("firm", "nation").agg(F.countDistinct("l_orderkey").alias("n_projects"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT o_orderkey, o_totalprice, year(o_orderdate)::INTEGER AS year FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment ILIKE 'build%' AND (o_orderstatus IS NULL OR o_orderstatus NOT IN ('P', 'F'))")
def filtered_projects(t: Tables) -> DataFrame:
    kept = t.orders.where(F.col("o_orderstatus").isNull() | ~F.col("o_orderstatus").isin("P", "F"))
    return kept.join(t.customer.where(F.col("c_mktsegment").ilike("build%")), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))


@query("WITH m AS (SELECT l_orderkey AS p, CASE WHEN l_suppkey % 7 = 0 AND l_suppkey > 7 THEN l_suppkey - 7 ELSE l_suppkey END AS firm_id, l_returnflag AS role, l_linestatus AS team, l_linenumber AS line, (l_suppkey % 7 = 0 AND l_suppkey > 7)::INT AS moved FROM lineitem) SELECT p AS project_id, firm_id, role, team, line FROM (SELECT *, row_number() OVER (PARTITION BY p, firm_id, role, team ORDER BY moved, line) AS k FROM m) WHERE k = 1")
def bulk_merge_roles(t: Tables) -> DataFrame:
    """Every seventh firm merged into the one seven before it; colliding roles go."""
    from tessera.operators.consolidate import merge_children

    mapping = t.supplier.where("s_suppkey % 7 = 0 and s_suppkey > 7").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") - 7).alias("root"))
    return merge_children(_roles(t), mapping, "firm_id", ["project_id", "firm_id", "role", "team"], ["line"]).select("project_id", "firm_id", "role", "team", "line")


@query("WITH m AS (SELECT c_custkey AS id, 'P' || c_custkey % 30 AS name, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey % 20 END AS f FROM customer), l AS (SELECT id, name, f - f % 4 AS firm_id, f % 4 <> 0 AS moved FROM m), w AS (SELECT *, first(id) OVER (PARTITION BY name, firm_id ORDER BY moved, id) AS stay FROM l) SELECT id, name, firm_id FROM w WHERE NOT coalesce(moved, false) OR id = stay")
def merge_people(t: Tables) -> DataFrame:
    """People after every four firms became one: of those that then are one, one stays."""
    return _merged(t)["people"].select("id", "name", "firm_id")


@query("WITH m AS (SELECT c_custkey AS id, 'P' || c_custkey % 30 AS name, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey % 20 END AS f FROM customer), l AS (SELECT id, name, f - f % 4 AS firm_id, f % 4 <> 0 AS moved FROM m), w AS (SELECT *, first(id) OVER (PARTITION BY name, firm_id ORDER BY moved, id) AS stay FROM l) SELECT o_orderkey AS id, CASE WHEN moved THEN stay ELSE w.id END AS speaker_person_id FROM orders JOIN w ON o_custkey = w.id")
def merge_repoints_speakers(t: Tables) -> DataFrame:
    return _merged(t)["quotes"].select("id", "speaker_person_id")


def _merged(t: Tables) -> dict[str, DataFrame]:
    from tessera.operators.consolidate import merge_firms

    firm = F.when(F.col("c_custkey") % 11 != 0, F.col("c_custkey") % 20)
    firms = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.array().cast("array<string>").alias("aliases"))
    mapping = t.supplier.sparkSession.range(20).where("id % 4 <> 0").selectExpr("id", "id - id % 4 AS root")
    people = t.customer.select(F.col("c_custkey").alias("id"), F.concat(F.lit("P"), F.col("c_custkey") % 30).alias("name"), firm.alias("firm_id"))
    quotes = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("speaker_person_id"))
    return merge_firms({"firms": firms, "people": people, "quotes": quotes}, mapping)


@query("WITH m AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey - l_orderkey % 2 AS project_id, l_suppkey % 3 AS article_id, CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_returnflag END AS text, l_orderkey % 2 AS moved FROM lineitem) SELECT id, project_id, article_id, text FROM (SELECT *, row_number() OVER (PARTITION BY project_id, article_id, text ORDER BY moved, id) AS k FROM m) WHERE k = 1 OR text IS NULL")
def merge_project_claims(t: Tables) -> DataFrame:
    """Claims after every odd project became the one before it; claims without a text are never the same."""
    from tessera.operators.consolidate import merge_children

    claims = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("project_id"), (F.col("l_suppkey") % 3).alias("article_id"), F.when(F.col("l_linenumber") % 4 != 0, F.col("l_returnflag")).alias("text"))
    mapping = t.orders.where("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") - 1).alias("root"))
    return merge_children(claims, mapping, "project_id", ["project_id", "article_id", "text"], ["id"], nulls_distinct=True)


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def delete_by_ids(t: Tables) -> DataFrame:
    return upsert.delete_keys(t.customer.select("c_custkey", "c_name"), t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT project_id, source_type, source_ref FROM (SELECT o_orderkey AS project_id, 'article' AS source_type, o_custkey::VARCHAR AS source_ref FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_orderkey, 'article', o_custkey::VARCHAR FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' AND o_custkey % 3 <> 0)")
def backfill_sources(t: Tables) -> DataFrame:
    """Rows from another table's column where it is not null, cast, if their key is new."""
    rows = t.orders.select(F.col("o_orderkey").alias("project_id"), F.lit("article").alias("source_type"), F.col("o_custkey").cast("string").alias("source_ref"), "o_orderstatus", "o_orderdate", "o_custkey")
    keys = ["project_id", "source_type", "source_ref"]
    old = rows.where("o_orderstatus = 'F'").select(*keys).distinct()
    new = rows.where("o_orderdate < timestamp'1998-01-01'").withColumn("source_ref", F.when(F.col("o_custkey") % 3 != 0, F.col("source_ref"))).where("source_ref is not null")
    return upsert.insert_if_absent(old, new.select(*keys), keys, ["source_ref"])


@query("SELECT o_orderkey FROM orders WHERE (o_orderkey % 4 = 0 OR o_orderkey % 6 = 0 OR o_orderkey % 10 / 10.0 < 0.80) AND o_orderkey % 5 <> 0")
def open_mentions(t: Tables) -> DataFrame:
    """Mentions that a sweep looks at: without an entity or confidence, or of a low one, and not corrected by hand."""
    from tessera.operators.resolve import unresolved

    k = F.col("o_orderkey")
    rows = t.orders.select("o_orderkey", F.when(k % 4 != 0, k).alias("canonical_id"), F.when(k % 6 != 0, k % 10 / 10).alias("confidence"), (k % 5 == 0).alias("corrected"))
    return rows.where(unresolved()).select("o_orderkey")
