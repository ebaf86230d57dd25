"""Mixing sources to target weights by temperature.

A source's share of all tokens is raised to an exponent and normalised.  The exponent is the largest in
[0, 1] that meets the target entropy (given as a part of the greatest, log of the number of sources),
found by bisection, and is raised, again by bisection, where some source would be repeated more often
than the limit.  Exponent 1 leaves the corpus as it is, 0 makes all sources equal.

The weights are realised in blocks.  The whole budget of tokens is by default the least that uses every
document at least once; a source then passes over its documents ``budget * weight / tokens`` times, each
pass in another keyed permutation, the last one cut where the budget ends.  A document's block follows
from the source's running token count: every block takes the same part of each source's budget.  Within
a block rows follow a keyed permutation.

Edge cases: a null text has no tokens, a null source is a source of its own; sources without tokens keep
weight 0 and each of their documents is used once; an empty table gives an empty result; repeated rows
count as rows of their own; documents of one key are ordered by id, equal ids by tokens; a very long text is
one document of many tokens, never cut; extra columns are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import running_totals, text_of, written

#: The part of the greatest entropy asked for, passes over a source at most, tokens of a block, the permutations' key, and parts of an interval in a round of the bisection.
TARGET_ENTROPY, MAX_REPEATS, BLOCK_TOKENS, SEED, SECTIONS = 0.93, 3.0, 1 << 22, 17, 24


def _least(good, low: float = 0.0, high: float = 1.0) -> float:
    """The end of [low, high] up to which ``good`` holds, by bisection."""
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if good(mid) else (low, mid)
    return low


def _powers(sources: DataFrame, total: int, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent the sum of the raised shares, and the entropy of the weights; summed as decimals, so that every run gives the same."""
    share = F.col("tokens") / F.lit(float(total))
    exact = lambda c: F.sum(c.cast("decimal(28,18)"))
    sums = sources.where("tokens > 0").agg(*(f.alias(f"{name}{k}") for k, a in enumerate(exponents) for name, f in (("z", exact(F.pow(share, F.lit(a)))), ("l", exact(F.pow(share, F.lit(a)) * F.log(share)))))).first()
    out = []
    for k, a in enumerate(exponents):
        z, weighted = float(sums[f"z{k}"]), float(sums[f"l{k}"])
        out.append((z, math.log(z) - a * weighted / z))
    return out


def fit_exponent(sources: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS) -> float:
    """sources: tokens, a row a source.  The largest exponent that reaches the entropy, or the smallest that keeps the repetition limit if that is larger.

    Each round of the bisection tries SECTIONS - 1 exponents in one aggregation, so no source is collected.
    """
    ends = sources.where("tokens > 0").agg(F.sum("tokens").alias("total"), F.count("*").alias("live"), F.min("tokens").alias("least"), F.max("tokens").alias("most")).first()
    if ends["live"] < 2 or ends["least"] == ends["most"]:
        return 1.0
    wanted, low, high = target_entropy * math.log(ends["live"]), 0.0, 1.0
    if _powers(sources, ends["total"], [1.0])[0][1] >= wanted:
        low = 1.0
    while high - low > 1e-12:
        tried = [low + (high - low) * k / SECTIONS for k in range(1, SECTIONS)]
        good = [a for a, (_, entropy) in zip(tried, _powers(sources, ends["total"], tried), strict=True) if entropy >= wanted]
        low, high = (good or [low])[-1], tried[len(good)] if len(good) < len(tried) else high
    # passes over the smallest source while the largest is used once
    repeats = lambda a: (ends["most"] / ends["least"]) ** (1 - a)
    return min(1.0, max(low, 0.0 if repeats(0.0) <= max_repeats else _least(lambda a: repeats(a) > max_repeats)))


def mixing_plan(docs: DataFrame, source: str = "source", tokens: str = "_tokens", target_entropy: float = TARGET_ENTROPY, max_repeats: float = MAX_REPEATS, budget_tokens: int | None = None) -> DataFrame:
    """A row a source: source, tokens, docs, exponent, weight and budget (in tokens).  It stays a table, however many sources there are."""
    found = written(docs.groupBy(F.col(source).alias("source")).agg(F.sum(tokens).alias("tokens"), F.count("*").alias("docs")))
    exponent = fit_exponent(found, target_entropy, max_repeats)
    ends = found.agg(F.sum("tokens").alias("total"), F.max("tokens").alias("most")).first()
    total = ends["total"] or 0
    if not total:
        return found.select("*", F.lit(exponent).alias("exponent"), F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("budget"))
    (raised, _), = _powers(found, total, [exponent])
    # the least budget under which every source's is its tokens or more: the largest source decides, as no exponent is above 1
    budget = raised * total * (ends["most"] / total) ** (1 - exponent) if budget_tokens is None else float(budget_tokens)
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total)), F.lit(exponent)) / F.lit(raised)).otherwise(0.0)
    return found.select("*", F.lit(exponent).alias("exponent"), weight.alias("weight"), F.bround(weight * F.lit(budget)).cast("long").alias("budget"))


def temperature_mix(docs: DataFrame, text: str = "text", id_col: str = "doc_id", source: str = "source", block_tokens: int = BLOCK_TOKENS, slim: bool = False, **targets) -> DataFrame:
    """The documents as often as their source's budget asks, with a column ``mix``: tokens, weight, use (0 for the first), block, order_key (the order within a block).

    slim: only the id and the source beside it.  A column already named ``mix`` is replaced.
    """
    docs = docs.drop("mix")
    kept = [F.col(id_col), F.col(source)] if slim else [F.col(c) for c in docs.columns]
    tokens = F.regexp_count(text_of(text), F.lit(r"[^ \t-\r]+")).cast("long")
    # packed, so that no column of the documents can clash with those used here
    rows = docs.select(F.struct(*kept).alias("_row"), F.col(id_col).alias("_id"), F.col(source).cast("string").alias("_source"), tokens.alias("_tokens"))
    rows = written(rows) if slim else rows
    whole = targets.get("budget_tokens") is None
    plan = mixing_plan(rows.select("_source", "_tokens"), "_source", **targets)
    ends = plan.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("budget"), F.lit(0)).alias("budget")).first()
    n_rows, blocks = ends["docs"], max(1, math.ceil(ends["budget"] / block_tokens))
    table = plan.select(F.col("source").alias("_name"), F.col("tokens").alias("_all"), (F.greatest("budget", "tokens") if whole else F.col("budget")).alias("_budget"), F.col("weight").alias("_weight"))
    # a row a source: broadcast while the written table is small, else shuffled, where AQE splits a hot source
    rows = rows.join(table, F.col("_source").eqNullSafe(F.col("_name")))
    passes = F.when(F.col("_all") > 0, F.ceil(F.col("_budget") / F.col("_all"))).otherwise(1).cast("int")
    rows = rows.withColumn("_use", F.explode(F.sequence(F.lit(0), F.greatest(passes, F.lit(1)) - 1)))
    rows = rows.withColumn("_key", F.xxhash64(F.lit(SEED), "_use", "_id"))
    rows = rows.withColumn("_part", F.coalesce(F.concat(F.lit("s"), "_source"), F.lit("n")))
    rows = running_totals(rows, ["_part", "_use"], "_key", ["_id", "_tokens"], "_tokens", "_run", max(1, n_rows))
    at = F.col("_run") + F.col("_all") * F.col("_use")
    rows = rows.where(((F.col("_use") == 0) if whole else (F.col("_all") == 0)) | (at < F.col("_budget")))
    block = F.when(F.col("_budget") > 0, F.least(F.floor(at * blocks / F.col("_budget")), F.lit(blocks - 1))).otherwise(0)
    mix = F.struct(F.col("_tokens").alias("tokens"), F.col("_weight").alias("weight"), F.col("_use").alias("use"), block.cast("int").alias("block"), F.col("_key").alias("order_key"))
    return rows.select("_row.*", mix.alias("mix"))


def op3_temperature_mixing(spark, sf_dir: str) -> DataFrame:
    """The whole schedule: a row for every use of a document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    out = temperature_mix(docs, slim=True)
    return out.select("doc_id", "source", F.col("mix.tokens").alias("n_tokens"), F.round("mix.weight", 9).alias("weight"), "mix.use", "mix.block", "mix.order_key")
