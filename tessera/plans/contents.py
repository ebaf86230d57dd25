"""Articles, quotes, probe runs, pages and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import documents, geocode, probes, vectors
from tessera.plans.registry import Tables, query
from tessera.sources import links, signals


@query("SELECT user_id, event_type, ts, (props->>'$.k')::INTEGER AS k FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, props DESC) AS r FROM events) WHERE r = 1")
def latest_probe_output(t: Tables) -> DataFrame:
    runs = probes.latest(t.events.withColumnsRenamed({"props": "output", "ts": "ran_at"}), ["user_id", "event_type"])
    return runs.select("user_id", "event_type", F.col("ran_at").alias("ts"), probes.parsed("output", "struct<k: int>")["k"].alias("k"))


@query("SELECT u.user_id, e.event_type FROM (SELECT DISTINCT user_id FROM events) u, (SELECT DISTINCT event_type FROM events) e WHERE NOT EXISTS (SELECT 1 FROM events x WHERE x.user_id = u.user_id AND x.event_type = e.event_type AND x.value > 60)")
def probe_cache_miss(t: Tables) -> DataFrame:
    """Every (article, probe) without a run; runs are the events of a high value."""
    types = t.events.select(F.col("event_type").alias("probe_id")).distinct().withColumn("version", F.lit(1))
    users = t.events.select(F.col("user_id").alias("article_id")).distinct().withColumn("content_hash", F.lit(None).cast("string"))
    runs = t.events.where("value > 60").select(F.col("event_type").alias("probe_id"), F.col("user_id").alias("article_id"), F.lit(1).alias("probe_version"), F.lit("").alias("content_hash"))
    return probes.due(types, users, runs).select(F.col("article_id").alias("user_id"), F.col("probe_id").alias("event_type"))


@query("SELECT conv_id, sha256(string_agg(coalesce(text, '') || chr(0), '' ORDER BY turn, text)) AS content_hash, count(*) AS n_pages FROM conversations GROUP BY conv_id")
def content_hash_conversation(t: Tables) -> DataFrame:
    pages = t.conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))).alias("p"), F.count("*").alias("n_pages"))
    return pages.select("conv_id", text.content_hash(F.transform("p", lambda x: x["text"])).alias("content_hash"), "n_pages")


@query("SELECT conv_id, string_agg(text, ' | ' ORDER BY k) AS context FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn, text) AS k FROM conversations WHERE text IS NOT NULL) WHERE k <= 4 GROUP BY conv_id")
def article_context_topn(t: Tables) -> DataFrame:
    """The four longest turns of each conversation, longest first."""
    rows = t.conversations.where("text is not null").withColumn("key", F.struct("turn", "text"))
    return documents.joined_longest(rows, "conv_id", "text", "key", 4)


@query("SELECT item_id, CASE WHEN length(v) > 600 THEN regexp_replace(left(v, 600), ' [^ ]*$', '') || '…' ELSE v END AS text FROM (SELECT item_id, '[Item ' || item_id || ', stat] ' || trim(text) AS v FROM benchmark)")
def claim_context_text(t: Tables) -> DataFrame:
    rows = t.benchmark.select("item_id", F.trim("text").alias("text"), F.concat(F.lit("Item "), F.col("item_id").cast("string")).alias("project_name"), F.lit("stat").alias("type"))
    return rows.select("item_id", documents.claim_text().alias("text"))


@query("SELECT a.conv_id, a.first, count(b.turn) AS n_pages, sum(length(b.text)) AS n_chars FROM (SELECT conv_id, min(turn) AS first FROM conversations GROUP BY conv_id) a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn BETWEEN a.first AND a.first + 2 GROUP BY ALL")
def page_range_slice(t: Tables) -> DataFrame:
    """A range join inside an equi-join: pages of an article by its first and last."""
    a = t.conversations.groupBy("conv_id").agg(F.min("turn").alias("first"))
    rows = t.conversations.join(a, "conv_id").where("turn between first and first + 2")
    return rows.groupBy("conv_id", "first").agg(F.count("turn").alias("n_pages"), F.sum(F.length("text")).alias("n_chars"))


@query("SELECT conv_id, turn, role, CAST(floor((row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1) / 5) AS BIGINT) AS batch FROM conversations")
def page_batching(t: Tables) -> DataFrame:
    k = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return t.conversations.select("conv_id", "turn", "role", F.floor((k - 1) / 5).alias("batch"))


_PHRASES = ("LOCATION :", "Owner:", "architect  :", "General contractor:", "Square Footage:", "the design team", "Construction Team", "PROJECT TEAM", "Structural Engineer :", "mechanical engineer:", "Electrical Engineer:", "civil engineer:", "Cost :", "developer:")
_BITS = "(p_partkey * 7919 % 16384)"


@query(f"SELECT p_partkey, bit_count({_BITS})::INTEGER AS score FROM part WHERE bit_count({_BITS}) >= 3")
def info_signal_score(t: Tables) -> DataFrame:
    """Pages that hold any of the 14 signals, one for each bit of a number."""
    bits = F.pmod(F.col("p_partkey") * 7919, F.lit(16384))
    pages = t.part.select("p_partkey", F.concat_ws(" x\n", *(F.when(F.getbit(bits, F.lit(k)) == 1, p) for k, p in enumerate(_PHRASES))).alias("text"))
    return signals.score_pages(pages).select("p_partkey", "score")


@query("SELECT o_orderkey FROM orders WHERE (o_orderkey % 4 = 0 OR o_orderkey % 4 = 1) AND o_orderkey % 5 NOT IN (1, 2)")
def noise_filter(t: Tables) -> DataFrame:
    """Articles of a kind, or none, that carry information."""
    k = F.col("o_orderkey")
    kind = F.when(k % 4 == 1, "project_feature").when(k % 4 == 2, "column").when(k % 4 == 3, "advertisement")
    said = F.when(k % 5 == 1, "These PAGES do not contain it").when(k % 5 == 2, "No Information About it").when(k % 5 == 3, "A tower")
    return t.orders.select("o_orderkey", kind.alias("article_type"), said.alias("summary")).where(~documents.is_noise("article_type", "summary")).select("o_orderkey")


@query("SELECT filename, n::BIGINT AS n_articles, CASE WHEN id IS NULL THEN 'fresh' WHEN n = 0 THEN 'resume' ELSE 'skip' END AS state FROM (SELECT 'issue_' || o_orderkey AS filename, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS id, CASE WHEN o_orderkey % 3 <> 0 THEN (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') ELSE 0 END AS n FROM orders)")
def issue_three_state(t: Tables) -> DataFrame:
    """What to do with each file: two of three are known issues, some of these without articles."""
    name = F.concat(F.lit("issue_"), "o_orderkey")
    issues = t.orders.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("id"), name.alias("filename"))
    articles = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("issue_id"))
    return probes.issue_state(issues, articles, t.orders.select(name.alias("filename"))).select("filename", "n_articles", "state")


@query("WITH h AS (SELECT page_id, unnest(list_transform(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1), lambda x: 'https://cdn.example.com' || x)) AS u, generate_subscripts(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1), 1) AS pos FROM pages) SELECT u AS url, min(page_id) AS first_page FROM h GROUP BY u")
def link_harvest(t: Tables) -> DataFrame:
    """Links of all pages, each with the first page that has it."""
    return links.harvest(t.pages, base="https://cdn.example.com", suffix="").select("url", F.col("page_id").alias("first_page"))


@query("SELECT doc_id, source FROM documents WHERE list_contains(list_distinct(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+')), 'that') AND list_contains(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), 'from')")
def fts_token_match(t: Tables) -> DataFrame:
    found = text.tokens("text")
    return t.documents.where(F.array_contains(found, "that") & F.array_contains(found, "from")).select("doc_id", "source")


_COS = "list_inner_product(a.embedding::DOUBLE[], q.embedding::DOUBLE[]) / (sqrt(list_inner_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * sqrt(list_inner_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])))"


@query(f"SELECT a.vec_id, round({_COS}, 6) AS similarity FROM embeddings a, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) q ORDER BY round({_COS}, 6) DESC, a.vec_id LIMIT 10")
def vector_topk(t: Tables) -> DataFrame:
    """The ten rows nearest to the first one's vector."""
    q = t.embeddings.orderBy("vec_id").select("embedding").first()[0]
    near = t.embeddings.withColumn("similarity", F.round(vectors.cosine(F.col("embedding"), F.array(*(F.lit(float(x)) for x in q))), 6))
    return near.orderBy(F.desc("similarity"), "vec_id").limit(10).select("vec_id", "similarity")


@query(f"WITH s AS (SELECT q.vec_id AS query_id, a.vec_id, round({_COS}, 6) AS similarity FROM embeddings a, embeddings q WHERE q.vec_id % 20 = 0) SELECT query_id, vec_id, similarity, k::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS k FROM s) WHERE k <= 5")
def vector_topk_each(t: Tables) -> DataFrame:
    """The five rows nearest to each of a stated query set."""
    queries = t.embeddings.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return vectors.nearest_each(t.embeddings, queries, 5, id_col="vec_id", digits=6).select("query_id", "vec_id", "similarity", "rank")


@query("SELECT o_orderkey AS article_id, 'Owner' AS role, c_name AS firm, 'owner' AS team, CAST(NULL AS VARCHAR) AS scope FROM orders JOIN customer ON o_custkey = c_custkey UNION ALL SELECT o_orderkey, 'Architect', c_mktsegment, 'design', 'core' FROM orders JOIN customer ON o_custkey = c_custkey")
def roles_from_panel_json(t: Tables) -> DataFrame:
    """Panels written as JSON, read back and unpivoted; the entry without a firm is left out."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    entry = lambda role, firm: F.struct(role.alias("role"), firm.alias("firm"))
    panel = F.to_json(F.struct(F.col("c_name").alias("owner"), F.array(entry(F.lit("Architect (core)"), F.col("c_mktsegment")), entry(F.lit("Engineer"), F.lit(None).cast("string"))).alias("design_team")))
    outputs = rows.select(F.col("o_orderkey").alias("article_id"), F.lit("project_panel").alias("probe"), F.concat(F.lit("```json\n"), panel, F.lit("\n```")).alias("output"))
    return probes.materialize(outputs)["roles"].select("article_id", "role", "firm", "team", "scope")


@query("SELECT c_custkey, unnest([{'team': 'Design', 'role': 'Architect', 'firm': c_name}, {'team': 'Design', 'role': 'Architect', 'firm': c_mktsegment}, {'team': 'Design', 'role': 'Signs', 'firm': c_mktsegment}, {'team': 'Construction', 'role': 'HVAC', 'firm': c_name}, {'team': 'Construction', 'role': 'Other', 'firm': 'crew'}], recursive := true) FROM customer")
def team_unpivot(t: Tables) -> DataFrame:
    """Teams by field, and their other entries, as rows."""
    none = F.lit(None).cast("string")
    fields = lambda **f: F.create_map(*(x for k, v in f.items() for x in (F.lit(k), v)))
    design = F.struct(fields(architect=F.concat("c_name", F.lit(" / "), "c_mktsegment", F.lit(" /")), furniture=none, unknown=F.col("c_name")).alias("fields"), F.array(F.concat(F.lit("Signs : "), "c_mktsegment")).alias("other"))
    construction = F.struct(fields(hvac=F.col("c_name"), roofing=F.lit(" ")).alias("fields"), F.array(F.lit("crew"), F.lit("/")).alias("other"))
    return t.customer.select("c_custkey", F.explode(text.team_rows(design, construction)).alias("x")).select("c_custkey", "x.*")


@query("SELECT conv_id AS article_id, turn::INTEGER AS pos, text, role AS type, CASE WHEN turn BETWEEN 1 AND 10000 THEN turn::INTEGER END AS page FROM conversations WHERE trim(coalesce(text, ''), ' ') <> '' AND turn IS NOT NULL")
def claims_from_json(t: Tables) -> DataFrame:
    """Turns written as claims in a JSON that is cut off before its end, read back."""
    rows = t.conversations.where("turn is not null").select("conv_id", "turn", F.struct("text", F.col("role").alias("type"), F.col("turn").alias("page")).alias("c"))
    claims = F.to_json(F.struct(F.array("c").alias("claims")), {"ignoreNullFields": "false"})
    cut = F.substring(claims, 1, F.length(claims) - 2)
    outputs = rows.select((F.col("conv_id") * 100_000 + F.col("turn")).alias("article_id"), F.lit("claims").alias("probe"), cut.alias("output"))
    found = probes.materialize(outputs)["claims"]
    return found.select(F.floor(F.col("article_id") / 100_000).alias("article_id"), (F.col("article_id") % 100_000).cast("int").alias("pos"), "text", "type", "page")


@query("SELECT o_orderkey AS article_id, 'Project ' || o_orderkey AS name, 'UT' AS state, round_even(o_totalprice, 0)::BIGINT AS cost_usd, CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate)::INTEGER END AS year_completed, CASE WHEN o_orderkey % 3 = 0 THEN 12000 END::INTEGER AS sq_ft FROM orders WHERE o_orderkey % 7 <> 0")
def projects_from_panel_json(t: Tables) -> DataFrame:
    """Panels' projects, parsed; a panel without a project's name makes none."""
    k = F.col("o_orderkey")
    project = F.struct(
        F.when(k % 7 != 0, F.concat(F.lit("Project "), "o_orderkey")).alias("name"), F.lit(" ut ").alias("state"), F.concat(F.lit("$"), F.format_number(F.bround("o_totalprice", 0), 0)).alias("cost"),
        F.when(k % 2 == 0, F.year("o_orderdate").cast("string")).otherwise("about 1999").alias("year_completed"), F.when(k % 3 == 0, "12,000 sf").alias("square_footage"),
    )
    outputs = t.orders.select(k.alias("article_id"), F.lit("project_panel").alias("probe"), F.to_json(F.struct(project.alias("project"))).alias("output"))
    return probes.materialize(outputs)["projects"].select("article_id", "name", "state", "cost_usd", "year_completed", "sq_ft")


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'no_query' WHEN c_mktsegment = 'MACHINERY' THEN 'no_match' ELSE 'geocoded' END AS outcome FROM customer")
def geocode_outcomes(t: Tables) -> DataFrame:
    """Places asked of a geocoder that knows all but one kind."""
    import json

    def backend(place: str) -> str:
        if "MACHINERY" in place:
            return json.dumps({"status": "ZERO_RESULTS", "results": []})
        return json.dumps({"status": "OK", "results": [{"geometry": {"location": {"lat": 1.5, "lng": 2.5}}, "address_components": []}]})

    rows = t.customer.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("location"), F.lit(" ").alias("city"), F.lit(None).cast("string").alias("state"), *(F.lit(None).cast(k).alias(c) for c, k in (("county", "string"), ("lat", "double"), ("lng", "double"))))
    out, _ = geocode.sweep(rows, backend)
    return out.select(F.col("id").alias("c_custkey"), F.when(F.col("location").isNull(), "no_query").when(F.col("lat").isNull(), "no_match").otherwise("geocoded").alias("outcome"))


@query("SELECT doc_id, len(list_filter(list_distinct(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+')), lambda w: w <> '' AND NOT list_contains([" + ", ".join(f"'{w}'" for w in text.STOP_WORDS) + "], w)))::INTEGER AS n_tokens FROM documents")
def search_index_size(t: Tables) -> DataFrame:
    """How many words of each text a search index holds."""
    return t.documents.select("doc_id", F.size(text.search_tokens("text")).alias("n_tokens"))
