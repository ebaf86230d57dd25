"""Trigram similarity and its joins.

Words are the runs of letters and digits of the lower-cased string, padded with two spaces before and one
after; the similarity of two strings is the Jaccard index of their sets of trigrams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import _col

#: Names of one trigram that a task of the join gets on average at most, on one side.
SALT_ROWS = 5_000


def trigrams(text: Column | str) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(_col(text), F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), 1)
    grams = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def similarity(a: Column, b: Column) -> Column:
    """Of two arrays of trigrams; 0 if both are empty."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(both / F.nullif(F.size(a) + F.size(b) - both, F.lit(0)), F.lit(0.0))


def _in_scope(df: DataFrame, scope: list[str]) -> Column:
    """The scope's values as one string, null apart from every value."""
    return F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("v"), F.col(s).cast("string")), F.lit("n")) for s in scope)) if scope else F.lit("")


def _pairs(left: DataFrame, right: DataFrame, floor: float, same: bool, scope: list[str]) -> DataFrame:
    """s, left_name, right_name, sim: the pairs of names whose similarity is at least ``floor``.

    Distinct names are compared, not rows.  A name's trigrams are put in one order for all, rarest first;
    two sets at the floor share one of the n - ceil(floor n) + 1 first of each, so only these are joined
    on.  A pair is made at the first trigram that its prefixes share, if sizes and places still allow the
    floor, so each comes once; its overlap is taken there, from the arrays that the rows carry.  Trigrams
    of many names are dealt over several tasks.
    """
    names = lambda df: df.where("name is not null").select(_in_scope(df, scope).alias("s"), "name").distinct().withColumn("grams", trigrams("name")).where(F.size("grams") > 0)
    a, b = names(left), names(right)
    every = a if same else a.unionByName(b).distinct()
    rank = every.select("s", F.explode("grams").alias("g")).groupBy("s", "g").agg(F.count("*").alias("df"))

    def prefixes(df: DataFrame) -> DataFrame:
        ranked = df.select("s", "name", F.explode("grams").alias("g")).join(rank, ["s", "g"])
        ordered = ranked.groupBy("s", "name").agg(F.sort_array(F.collect_list(F.struct("df", "g"))).alias("o"))
        ordered = ordered.select("s", "name", F.size("o").alias("n"), F.transform("o", lambda x: x["g"]).alias("grams"), "o")
        ordered = ordered.withColumn("prefix", F.slice("grams", 1, (F.col("n") - F.ceil(F.col("n") * floor) + 1).cast("int")))
        out = ordered.select("s", "name", "n", "grams", "prefix", F.posexplode(F.slice("o", 1, F.size("prefix"))).alias("at", "x"))
        return out.select("s", "name", "n", "grams", "prefix", "at", F.col("x.g").alias("g"), F.ceil(F.col("x.df") / SALT_ROWS).cast("int").alias("salts"))

    x = prefixes(a).withColumn("salt", F.pmod(F.xxhash64("name"), F.col("salts")).cast("int")).alias("x")
    y = prefixes(b).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).alias("y")
    sizes = (F.col("x.n") >= F.col("y.n") * floor) & (F.col("y.n") >= F.col("x.n") * floor)
    most = 1 + F.least(F.col("x.n") - F.col("x.at") - 1, F.col("y.n") - F.col("y.at") - 1)  # what can be shared from this place on
    first = F.element_at(F.array_intersect("x.prefix", "y.prefix"), 1) == F.col("x.g")
    on = (F.col("x.s") == F.col("y.s")) & (F.col("x.g") == F.col("y.g")) & (F.col("x.salt") == F.col("y.salt"))
    pairs = x.join(y, on & sizes & ((F.col("x.n") + F.col("y.n") - most) * floor <= most + 1e-9) & first)
    pairs = pairs.select(F.col("x.s").alias("s"), F.col("x.name").alias("left_name"), F.col("y.name").alias("right_name"), similarity(F.col("x.grams"), F.col("y.grams")).alias("sim")).where(F.col("sim") >= floor)
    return pairs


def _ids(df: DataFrame, side: str, scope: list[str]) -> DataFrame:
    return df.select(_in_scope(df, scope).alias("s"), F.col("id").alias(f"{side}_id"), F.col("name").alias(f"{side}_name"))


def similar_names(left: DataFrame, right: DataFrame, floor: float, same: bool = False, scope: list[str] = ()) -> DataFrame:
    """Pairs of names whose similarity is at least ``floor``, within an equal scope (null equals null).

    left: id, name; right: id, name, and the scope's columns in both.  Returns left_id, right_id, sim;
    with ``same`` the tables are one and left_id < right_id.
    """
    out = _pairs(left, right, floor, same, scope).join(_ids(left, "left", scope), ["s", "left_name"]).join(_ids(right, "right", scope), ["s", "right_name"])
    out = out.where("left_id < right_id") if same else out
    return out.select("left_id", "right_id", "sim")


def top_similar(probes: DataFrame, names: DataFrame, k: int, floor: float = 0.3, scope: list[str] = ()) -> DataFrame:
    """The k names most similar to each probe: left_id, right_id, sim, rank.  Ties go to the smaller id.

    Probes of one name have the same rank list, so it is made once a name.
    """
    order = Window.partitionBy("s", "left_name").orderBy(F.desc("sim"), "right_id")
    near = _pairs(probes, names, floor, False, scope).join(_ids(names, "right", scope), ["s", "right_name"])
    best = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    best = best.hint("shuffle_hash")  # a name's few rows are held, its many probes pass by unsorted
    return best.join(_ids(probes, "left", scope), ["s", "left_name"]).select("left_id", "right_id", "sim", "rank")
