"""Names, parsers, similarity, resolution and consolidation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import classify, consolidate, graph, mentions, projects, resolve, similarity
from tessera.plans.registry import Tables, query
from tessera.sources import tables


def _words(names: tuple[str, ...]) -> str:
    return "|".join(names)


_PLAIN = r"trim(regexp_replace(regexp_replace(lower({0}), '[^\w\s&]', ' ', 'g'), '\s+', ' ', 'g'))"


@query(f"SELECT p_partkey, trim(regexp_replace({_PLAIN.format('p_name || k.suffix')}, '(?:(?:^| )(?:{_words(text.FIRM_SUFFIXES)}))+$', '')) AS firm, {_PLAIN.format('p_name || k.suffix')} AS project FROM part, (VALUES (', Inc.'), (' & Group LLC'), ('')) k(suffix)")
def normalize_names(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.explode(F.array(*map(F.lit, (", Inc.", " & Group LLC", "")))).alias("s"), "p_name").withColumn("n", F.concat("p_name", "s"))
    return rows.select("p_partkey", text.normalize_firm("n").alias("firm"), text.normalize_project("n").alias("project"))


@query(f"SELECT c_custkey, trim(regexp_replace(regexp_replace({_PLAIN.format('k.prefix || c_name || k.suffix')}, '^(?:(?:{_words(text.HONORIFICS)})(?: |$))+', ''), '(?:(?:^| )(?:{_words(text.NAME_SUFFIXES)}))+$', '')) AS person FROM customer, (VALUES ('Dr. ', ', Jr.'), ('', ' P.E.'), ('Mr Dr ', ', PhD, AIA')) k(prefix, suffix)")
def normalize_people(t: Tables) -> DataFrame:
    forms = F.array(*(F.struct(F.lit(a).alias("p"), F.lit(b).alias("s")) for a, b in (("Dr. ", ", Jr."), ("", " P.E."), ("Mr Dr ", ", PhD, AIA"))))
    return t.customer.select("c_custkey", "c_name", F.explode(forms).alias("k")).select("c_custkey", text.normalize_person(F.concat("k.p", "c_name", "k.s")).alias("person"))


@query("SELECT o_orderkey, round_even(o_totalprice, 0)::BIGINT AS plain, round_even((round(o_totalprice / 1000) / 10) * 1e6, 0)::BIGINT AS millions FROM orders")
def parse_money_values(t: Tables) -> DataFrame:
    """Amounts written out with separators and with magnitude words, read back."""
    rows = t.orders.select("o_orderkey", F.concat(F.lit("$"), F.format_number(F.bround("o_totalprice", 0), 0)).alias("a"), F.concat(F.lit("about $"), F.format_string("%.1f", F.round(F.col("o_totalprice") / 1000) / 10), F.lit(" million over 3 buildings")).alias("b"))
    return rows.select("o_orderkey", text.parse_amount("a").alias("plain"), text.parse_amount("b").alias("millions"))


@query("SELECT o_orderkey, year(o_orderdate)::INTEGER AS year, strftime(o_orderdate, '%B') AS month FROM orders")
def parse_issue_filenames(t: Tables) -> DataFrame:
    names = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "'Spreads_'yyyy'_'MMMM'20'")).otherwise(F.date_format("o_orderdate", "MMM'Issue-'yyyy")).alias("f"))
    return names.select("o_orderkey", text.issue_year("f").alias("year"), text.issue_month("f").alias("month"))


@query("SELECT c_custkey, c_name AS byline, c_mktsegment AS clean, c_name || '; x' AS scope FROM customer")
def byline_and_scope(t: Tables) -> DataFrame:
    clean, scope = text.extract_scope(F.concat("c_mktsegment", F.lit(" ("), "c_name", F.lit(") ( ) (x)")))
    return t.customer.select("c_custkey", text.clean_byline(F.concat(F.lit("By "), "c_name", F.lit(", "))).alias("byline"), clean.alias("clean"), scope.alias("scope"))


@query("SELECT conv_id, turn, upper(left(role, 2)) AS state, CASE WHEN turn BETWEEN 1 AND 3 THEN turn::INTEGER END AS page, greatest(CASE WHEN turn BETWEEN 1 AND 5 THEN turn ELSE 1 END, CASE WHEN turn + 1 BETWEEN 1 AND 5 THEN turn + 1 WHEN turn BETWEEN 1 AND 5 THEN turn ELSE 1 END)::INTEGER AS page_end FROM conversations WHERE turn IS NOT NULL AND role IS NOT NULL")
def coerce_state_page(t: Tables) -> DataFrame:
    rows = t.conversations.where("turn is not null and role is not null")
    _, end = text.page_range(F.col("turn").cast("string"), (F.col("turn") + 1).cast("string"), F.lit(5))
    return rows.select("conv_id", "turn", text.state_code(F.substring("role", 1, 2)).alias("state"), text.safe_int(F.col("turn").cast("string"), 1, 3).alias("page"), end.alias("page_end"))


_GRAMS = r"list_distinct(flatten(list_transform(regexp_extract_all(lower({0}), '([\p{{L}}\p{{N}}]+)', 1), lambda w: list_transform(generate_series(1, length(w) + 1), lambda i: substring('  ' || w || ' ', i, 3)))))"
_NAMES = f"n AS (SELECT row_number() OVER (ORDER BY p_name) AS id, p_name AS name, {_GRAMS.format('p_name')} AS g FROM (SELECT DISTINCT p_name FROM part))"
_PAIRS = f"{_NAMES}, p AS (SELECT a.id AS left_id, b.id AS right_id, len(list_intersect(a.g, b.g))::DOUBLE / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) AS sim FROM n a JOIN n b ON a.id < b.id)"


def _names(t: Tables) -> DataFrame:
    """Distinct part names with ids by order: a small dimension, numbered by rank over its distinct values."""
    from tessera.operators.upsert import with_ids

    return with_ids(t.part.select(F.col("p_name").alias("name")).distinct(), ["name"])


@query(f"WITH {_PAIRS} SELECT left_id, right_id, round(sim, 8) AS sim FROM p WHERE sim >= 0.45")
def trigram_pairs_band(t: Tables) -> DataFrame:
    n = _names(t)
    return similarity.similar_names(n, n, 0.45, same=True).select("left_id", "right_id", F.round("sim", 8).alias("sim"))


@query(f"WITH {_NAMES}, p AS (SELECT a.id AS left_id, b.id AS right_id, len(list_intersect(a.g, b.g))::DOUBLE / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) AS sim FROM n a, n b) SELECT left_id, right_id, round(sim, 8) AS sim, k::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY sim DESC, right_id) AS k FROM p WHERE sim >= 0.3) WHERE k <= 5")
def trigram_topk(t: Tables) -> DataFrame:
    n = _names(t)
    return similarity.top_similar(n, n, 5).select("left_id", "right_id", F.round("sim", 8).alias("sim"), "rank")


@query(f"WITH RECURSIVE {_PAIRS}, e AS (SELECT left_id AS a, right_id AS b FROM p WHERE sim >= 0.45 UNION SELECT right_id, left_id FROM p WHERE sim >= 0.45), r(id, place) AS (SELECT DISTINCT a, a FROM e UNION SELECT r.id, e.b FROM r JOIN e ON r.place = e.a) SELECT id, min(place) AS root FROM r GROUP BY id")
def name_components(t: Tables) -> DataFrame:
    return consolidate.similar_roots(_names(t), 0.45)


def _norm(c: str, words: tuple[str, ...], heads: tuple[str, ...] = ()) -> str:
    """A name's normal form in DuckDB."""
    bare = _PLAIN.format(c)
    if heads:
        bare = f"regexp_replace({bare}, '^(?:(?:{_words(heads)})(?: |$))+', '')"
    return f"trim(regexp_replace({bare}, '(?:(?:^| )(?:{_words(words)}))+$', ''))"


_HOUSE, _LAND = " manufacturing and distribution house of the north", " of the northern territories and islands"


def _cascade_sql(entities: str, mentions: str, norm: str, usable: str) -> str:
    """entities: fid, f, alias, scope; mentions: id, name, scope.  All pairs of names, then the stages."""
    return (
        f"WITH e AS ({entities}), m AS ({mentions}), d AS (SELECT DISTINCT name, scope FROM m), eg AS (SELECT *, {_GRAMS.format('f')} AS g FROM e), dg AS (SELECT *, {_GRAMS.format('name')} AS g FROM d), "
        "p AS (SELECT d.name, d.scope, fid, lower(name) = lower(f) AS is_exact, " + norm.format("name") + " = " + norm.format("f") + " AND " + norm.format("f") + " <> '' AS is_norm, lower(name) = lower(alias) AS is_alias, "
        "len(list_intersect(d.g, eg.g))::DOUBLE / (len(d.g) + len(eg.g) - len(list_intersect(d.g, eg.g))) AS sim FROM dg d JOIN eg ON d.scope IS NOT DISTINCT FROM eg.scope WHERE " + usable + "), "
        "r AS (SELECT *, row_number() OVER (PARTITION BY name, scope ORDER BY sim DESC, fid) AS k FROM p), "
        "s AS (SELECT name, scope, min(fid) FILTER (is_exact) AS x, min(fid) FILTER (is_norm) AS n, min(fid) FILTER (is_alias) AS a, max(sim) AS top, min(fid) FILTER (k = 1) AS best, string_agg(fid::VARCHAR, ',' ORDER BY k) FILTER (k <= 5 AND sim >= 0.55) AS c FROM r GROUP BY name, scope) "
        "SELECT id, coalesce(x, n, a, CASE WHEN top >= 0.92 THEN best END) AS match_id, round(CASE WHEN coalesce(x, n, a) IS NOT NULL THEN 1.0 WHEN top >= 0.92 THEN top END, 6) AS confidence, "
        "CASE WHEN x IS NOT NULL THEN 'exact' WHEN n IS NOT NULL THEN 'normalized' WHEN a IS NOT NULL THEN 'alias' WHEN top >= 0.92 THEN 'trigram' WHEN top >= 0.55 THEN 'candidates' ELSE 'none' END AS stage, "
        "CASE WHEN coalesce(x, n, a) IS NULL AND top < 0.92 THEN c END AS candidates FROM m LEFT JOIN s ON s.name = m.name AND s.scope IS NOT DISTINCT FROM m.scope"
    )


def _cascade_shown(found: DataFrame) -> DataFrame:
    return found.select("id", "match_id", F.round("confidence", 6).alias("confidence"), "stage", F.array_join("candidates", ",").alias("candidates"))


@query(
    _cascade_sql(
        f"SELECT min(p_partkey) AS fid, p_name || '{_HOUSE}' AS f, 'alias ' || p_name AS alias, NULL AS scope FROM part GROUP BY p_name",
        f"SELECT p_partkey AS id, NULL AS scope, CASE p_partkey % 6 WHEN 0 THEN upper(p_name || '{_HOUSE}') WHEN 1 THEN p_name || '{_HOUSE}, Inc.' WHEN 2 THEN 'ALIAS ' || p_name WHEN 3 THEN p_name || '{_HOUSE}s' WHEN 4 THEN 'quux{_HOUSE}' ELSE 'zzz' || p_partkey END AS name FROM part",
        _norm("{0}", text.FIRM_SUFFIXES), "true",
    )
)
def match_cascade_firm(t: Tables) -> DataFrame:
    """Mentions that each stage of the cascade matches, some that only have candidates, and some that nothing is like."""
    firms = t.part.groupBy("p_name").agg(F.min("p_partkey").alias("id")).select("id", F.concat("p_name", F.lit(_HOUSE)).alias("name"), F.array(F.concat(F.lit("alias "), "p_name")).alias("aliases"))
    k, name = F.col("p_partkey") % 6, F.concat("p_name", F.lit(_HOUSE))
    said = F.when(k == 0, F.upper(name)).when(k == 1, F.concat(name, F.lit(", Inc."))).when(k == 2, F.concat(F.lit("ALIAS "), "p_name")).when(k == 3, F.concat(name, F.lit("s"))).when(k == 4, "quux" + _HOUSE).otherwise(F.concat(F.lit("zzz"), "p_partkey"))
    return _cascade_shown(resolve.match_firms(t.part.select(F.col("p_partkey").alias("id"), said.alias("name")), firms, text.normalize_firm))


@query(
    _cascade_sql(
        f"SELECT min(p_partkey) AS fid, p_name || '{_LAND}' AS f, 'alias ' || p_name AS alias, nullif(p_size % 3, 0) AS scope FROM part GROUP BY p_name, nullif(p_size % 3, 0)",
        f"SELECT p_partkey AS id, CASE WHEN p_partkey % 35 = 0 THEN 7 ELSE nullif(p_size % 3, 0) END AS scope, CASE p_partkey % 5 WHEN 0 THEN upper(p_name || '{_LAND}') WHEN 1 THEN 'Dr. ' || p_name || '{_LAND}, PhD' WHEN 2 THEN p_name || '{_LAND}s' WHEN 3 THEN 'Mr' ELSE 'quux{_LAND}' END AS name FROM part",
        _norm("{0}", text.NAME_SUFFIXES, text.HONORIFICS), _norm("name", text.NAME_SUFFIXES, text.HONORIFICS) + " <> ''",
    )
)
def match_cascade_person(t: Tables) -> DataFrame:
    """As for firms, within a firm; a name that normalises to nothing and a firm without people match nothing."""
    scope, name = F.nullif(F.col("p_size") % 3, F.lit(0)), F.concat("p_name", F.lit(_LAND))
    people = t.part.groupBy("p_name", scope.alias("firm_id")).agg(F.min("p_partkey").alias("id")).select("id", "firm_id", name.alias("name"), F.array(F.concat(F.lit("alias "), "p_name")).alias("aliases"))
    k = F.col("p_partkey") % 5
    said = F.when(k == 0, F.upper(name)).when(k == 1, F.concat(F.lit("Dr. "), name, F.lit(", PhD"))).when(k == 2, F.concat(name, F.lit("s"))).when(k == 3, "Mr").otherwise("quux" + _LAND)
    mentions_ = t.part.select(F.col("p_partkey").alias("id"), said.alias("name"), F.when(F.col("p_partkey") % 35 == 0, 7).otherwise(scope).alias("firm_id"))
    return _cascade_shown(resolve.match_people(mentions_, people, text.normalize_person))


@query(f"WITH m AS (SELECT p_partkey AS id, p_name || CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN ', LLC' ELSE ' Group' END AS name, p_name AS form FROM part), f AS (SELECT form, min(id) AS first FROM m GROUP BY form), n AS (SELECT form, first, row_number() OVER (ORDER BY first) AS entity FROM f) SELECT id, name, entity AS canonical_id, CASE WHEN id = first THEN NULL ELSE 1.0 END AS confidence FROM m JOIN n USING (form)")
def mention_log(t: Tables) -> DataFrame:
    """Mentions of firms of which none is known: the first of each normal form makes a placeholder, the others match it."""
    k = F.col("p_partkey") % 3
    said = t.part.select(F.col("p_partkey").alias("id"), F.concat("p_name", F.when(k == 0, "").when(k == 1, ", LLC").otherwise(" Group")).alias("name"))
    known = t.part.sparkSession.createDataFrame([], "id long, name string, aliases array<string>")
    return mentions.ingest(said, known)[1].select("id", "name", "canonical_id", "confidence")


_SCORE = "greatest(0.0, least(1.0, 0.7 * sim + CASE WHEN place THEN 0.15 WHEN NOT place THEN -0.20 ELSE 0 END + CASE WHEN cost THEN 0.05 WHEN NOT cost THEN -0.10 ELSE 0 END + CASE WHEN yr THEN 0.05 WHEN NOT yr THEN -0.10 ELSE 0 END))"
_PROJECTS = "SELECT min(p_partkey) AS id, p_name || ' tower' AS name, CASE WHEN min(p_partkey) % 3 <> 0 THEN min(p_type) END AS city, min(p_brand) AS county, 'UT' AS state, max(p_retailprice)::BIGINT AS cost, CASE WHEN min(p_partkey) % 5 <> 0 THEN 1990 + min(p_size) END AS yr FROM part GROUP BY p_name"
_ASKED = "SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN p_name || ' tower' WHEN 1 THEN upper(p_name) || ' TOWER' WHEN 2 THEN p_name || ' towers' ELSE 'north ' || p_name END AS name, CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS city, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS county, CASE WHEN p_partkey % 11 = 0 THEN 'NV' ELSE 'UT' END AS state, CASE WHEN p_partkey % 13 <> 0 THEN (p_retailprice * (1 + p_partkey % 2))::BIGINT ELSE 0 END AS cost, CASE WHEN p_partkey % 6 <> 0 THEN 1990 + p_size END AS yr FROM part"
_SCORED = (
    f"e AS ({_PROJECTS}), q AS ({_ASKED}), d AS (SELECT DISTINCT name FROM q), eg AS (SELECT id, {_GRAMS.format('name')} AS g FROM e), dg AS (SELECT name, {_GRAMS.format('name')} AS g FROM d), "
    "p AS (SELECT dg.name, eg.id AS candidate, len(list_intersect(dg.g, eg.g))::DOUBLE / (len(dg.g) + len(eg.g) - len(list_intersect(dg.g, eg.g))) AS sim FROM dg, eg), "
    "n AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY sim DESC, candidate) AS k FROM p WHERE sim >= 0.45), "
    "x AS (SELECT q.id AS key, candidate, sim, CASE WHEN q.city <> '' AND e.city <> '' THEN lower(q.city) = lower(e.city) WHEN q.county <> '' AND e.county <> '' THEN lower(q.county) = lower(e.county) ELSE q.state = e.state END AS place, "
    "CASE WHEN q.cost <> 0 AND e.cost <> 0 THEN (greatest(q.cost, e.cost) - least(q.cost, e.cost)) / greatest(q.cost, e.cost) <= 0.30 END AS cost, abs(q.yr - e.yr) <= 2 AS yr FROM q JOIN n ON n.name = q.name AND n.k <= 8 JOIN e ON e.id = candidate), "
    f"s AS (SELECT key, candidate, sim, {_SCORE} AS score FROM x), "
    "r AS (SELECT *, row_number() OVER w AS rn, lead(score) OVER w AS second FROM s WINDOW w AS (PARTITION BY key ORDER BY score DESC, candidate)), "
    "b AS (SELECT *, CASE WHEN score >= 0.92 AND sim >= 0.92 AND (second IS NULL OR second < score - 0.15) THEN 'auto' WHEN score >= 0.55 THEN 'tiebreak' ELSE 'create' END AS decision FROM r WHERE rn = 1)"
)


def _projects(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Known projects, and candidates whose names, places, costs and years agree more or less."""
    k = F.col("p_partkey")
    least = F.min("p_partkey")
    known = t.part.groupBy("p_name").agg(least.alias("id"), F.when(least % 3 != 0, F.min("p_type")).alias("city"), F.min("p_brand").alias("county"), F.bround(F.max("p_retailprice")).cast("long").alias("cost_usd"), F.when(least % 5 != 0, 1990 + F.min("p_size")).cast("int").alias("year_completed"))
    known = known.withColumn("name", F.concat("p_name", F.lit(" tower"))).withColumn("state", F.lit("UT"))
    name = F.when(k % 4 == 0, F.concat("p_name", F.lit(" tower"))).when(k % 4 == 1, F.concat(F.upper("p_name"), F.lit(" TOWER"))).when(k % 4 == 2, F.concat("p_name", F.lit(" towers"))).otherwise(F.concat(F.lit("north "), "p_name"))
    cost = F.bround(F.col("p_retailprice") * (1 + k % 2)).cast("long")
    asked = t.part.select(k.alias("id"), name.alias("name"), F.when(k % 7 != 0, F.col("p_type")).alias("city"), F.when(k % 2 == 0, F.col("p_brand")).alias("county"), F.when(k % 11 == 0, "NV").otherwise("UT").alias("state"), F.when(k % 13 != 0, cost).otherwise(0).alias("cost_usd"), F.when(k % 6 != 0, 1990 + F.col("p_size")).cast("int").alias("year_completed"))
    return tables.conform(known, "projects"), tables.conform(asked, "projects")


@query(f"WITH {_SCORED} SELECT key, candidate, round(sim, 6) AS sim, round(score, 6) AS score, decision FROM b")
def project_score(t: Tables) -> DataFrame:
    """The best of the eight likeliest projects of each candidate, and what follows from its score."""
    known, asked = _projects(t)
    scored = projects.score_candidates(projects.find_candidates(asked, known), asked, known)
    return projects.decide(scored).select("key", "candidate", F.round("sim", 6).alias("sim"), F.round("score", 6).alias("score"), "decision")


@query(f"WITH {_SCORED}, u AS (SELECT q.id, b.decision, b.candidate, b.score FROM q LEFT JOIN b ON b.key = q.id), m AS (SELECT max(id) AS top FROM e), a AS (SELECT id, CASE WHEN id % 9 = 0 THEN 'known' WHEN decision = 'auto' THEN 'auto' ELSE 'create' END AS decision, candidate, score FROM u), c AS (SELECT *, row_number() OVER (PARTITION BY decision ORDER BY id) AS k FROM a) SELECT id, CASE decision WHEN 'known' THEN (SELECT min(p_partkey) FROM part) WHEN 'auto' THEN candidate ELSE top + k END AS project_id, decision = 'create' AS created, decision, round(CASE decision WHEN 'known' THEN 0.5 WHEN 'auto' THEN score ELSE 1.0 END, 6) AS confidence FROM c, m")
def project_resolution(t: Tables) -> DataFrame:
    """Each candidate matched by its source, matched for sure, or made a project."""
    known, asked = _projects(t)
    asked = asked.withColumn("source_type", F.lit("article")).withColumn("source_ref", F.col("id").cast("string"))
    first = t.part.agg(F.min("p_partkey").alias("project_id"))
    at = F.lit("2024-01-01").cast("timestamp")
    seen = t.part.where("p_partkey % 9 = 0").select(F.lit("article").alias("source_type"), F.col("p_partkey").cast("string").alias("source_ref")).crossJoin(first)  # one row
    sources = seen.select("project_id", "source_type", "source_ref", F.lit(0.5).cast("float").alias("confidence"), at.alias("first_seen"), at.alias("last_seen"))
    found = projects.resolve_projects(asked, known, sources, at=at)["decisions"]
    return found.select("id", "project_id", "created", "decision", F.round("confidence", 6).alias("confidence"))


@query(f"WITH RECURSIVE {_PAIRS}, e AS (SELECT left_id AS a, right_id AS b FROM p WHERE sim >= 0.3 AND sim < 0.45 AND (left_id + right_id) % 2 = 0 UNION SELECT right_id, left_id FROM p WHERE sim >= 0.3 AND sim < 0.45 AND (left_id + right_id) % 2 = 0), r(id, place) AS (SELECT DISTINCT a, a FROM e UNION SELECT r.id, e.b FROM r JOIN e ON r.place = e.a) SELECT id, min(place) AS root FROM r GROUP BY id")
def fuzzy_roots(t: Tables) -> DataFrame:
    """Names of a band of similarity that a tiebreaker takes for one."""
    return consolidate.similar_roots(_names(t), 0.3, 0.45, lambda pairs: pairs.where("(left_id + right_id) % 2 = 0"))


_BUCKET = "CASE l_linestatus WHEN 'O' THEN CASE l_returnflag WHEN 'A' THEN 'architect' WHEN 'R' THEN 'engineer' ELSE 'consultant' END ELSE CASE l_returnflag WHEN 'A' THEN 'subcontractor' WHEN 'R' THEN 'consultant' ELSE 'contractor' END END"


@query(f"WITH c AS (SELECT l_suppkey AS firm_id, {_BUCKET} AS bucket, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS first FROM lineitem GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY firm_id ORDER BY n DESC, first, bucket) AS k FROM c) SELECT firm_id, max(bucket) FILTER (k = 1) AS firm_type, coalesce(string_agg(bucket, ',' ORDER BY bucket) FILTER (k > 1), '') AS firm_type_aux FROM r GROUP BY firm_id")
def firm_type_classification(t: Tables) -> DataFrame:
    role = F.when(F.col("l_linestatus") == "O", F.element_at(F.create_map(*map(F.lit, ("A", "Lead Architect", "R", "Structural Engineer", "N", "Lighting"))), F.col("l_returnflag"))).otherwise(F.element_at(F.create_map(*map(F.lit, ("A", "Subcontractor", "R", "Code Consultant", "N", "CM/GC"))), F.col("l_returnflag")))
    roles = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_suppkey").alias("firm_id"), role.alias("role"), F.when(F.col("l_linestatus") == "O", "design").otherwise("construction").alias("team"))
    return classify.firm_types(roles).select("firm_id", "firm_type", F.array_join("firm_type_aux", ",").alias("firm_type_aux"))


@query("SELECT id, CASE WHEN id % 5 = 0 THEN id ELSE id - id % 5 END AS root FROM (SELECT s_suppkey - 1 AS id, (s_suppkey - 1) - (s_suppkey - 1) % 5 AS g FROM supplier) x WHERE g IN (SELECT (s_suppkey - 1) - (s_suppkey - 1) % 5 FROM supplier GROUP BY 1 HAVING count(*) > 1)")
def paren_firm_clusters(t: Tables) -> DataFrame:
    """Five variants of each firm: one bare, four with a qualifier."""
    n = F.col("s_suppkey") - 1
    name = F.concat(F.lit("Firm "), (n - n % 5).cast("string"), F.when(n % 5 == 0, "").otherwise(F.concat(F.lit(" (unit "), (n % 5).cast("string"), F.lit(")"))))
    return consolidate.paren_clusters(t.supplier.select(n.alias("id"), name.alias("name")))


@query("WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey, l_suppkey, l_linestatus, l_returnflag, l_linenumber % 2 = 0 AS bare FROM lineitem), w AS (SELECT *, count(*) OVER p AS n, bool_or(bare) OVER p AS has, row_number() OVER (PARTITION BY l_orderkey, l_suppkey, l_linestatus, l_returnflag ORDER BY bare DESC, id) AS k FROM r WINDOW p AS (PARTITION BY l_orderkey, l_suppkey, l_linestatus, l_returnflag)) SELECT id, CASE WHEN has THEN 'delete' ELSE 'skip' END AS action FROM w WHERE n > 1 AND k > 1")
def paren_role_dedup(t: Tables) -> DataFrame:
    role = F.concat("l_returnflag", F.when(F.col("l_linenumber") % 2 == 0, "").otherwise(" (phase 1)"))
    roles = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("project_id"), F.col("l_suppkey").alias("firm_id"), F.col("l_linestatus").alias("team"), role.alias("role"))
    return consolidate.redundant_roles(roles)


@query("SELECT s_suppkey, array_to_string(list_sort(list_filter(list_distinct(['b', s_name, 'a', n_name]), lambda x: x <> s_name)), ',') AS aliases FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def alias_union(t: Tables) -> DataFrame:
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", F.array(F.lit("b"), F.col("s_name")).alias("x"), F.array(F.lit("a"), F.lit("b"), F.col("n_name")).alias("y"))
    return rows.select("s_suppkey", F.array_join(consolidate.all_names("x", "y", "s_name"), ",").alias("aliases"))


@query("WITH e AS (SELECT s_suppkey AS id, s_suppkey - s_suppkey % 4 AS root FROM supplier WHERE s_suppkey >= 4) SELECT id, root FROM e WHERE root IN (SELECT root FROM e GROUP BY root HAVING count(*) > 1)")
def merge_chain_closure(t: Tables) -> DataFrame:
    """Chains of pairs close to their least id."""
    k = F.col("s_suppkey")
    return graph.merged_roots(t.supplier.where("s_suppkey > 4 and s_suppkey % 4 <> 0").select(k.alias("a"), (k - 1).alias("b")))
