"""What kind of firm a firm's roles make it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import role_bucket


def firm_types(roles: DataFrame) -> DataFrame:
    """roles: id, firm_id, role, team.  firm_id, firm_type (most frequent; ties by earliest role, then name), firm_type_aux (the others, sorted)."""
    counts = roles.where("firm_id is not null").withColumn("bucket", role_bucket("role", "team")).groupBy("firm_id", "bucket").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    ranked = counts.withColumn("k", F.row_number().over(Window.partitionBy("firm_id").orderBy(F.desc("n"), "first", "bucket")))
    return ranked.groupBy("firm_id").agg(F.max(F.when(F.col("k") == 1, F.col("bucket"))).alias("firm_type"), F.sort_array(F.collect_list(F.when(F.col("k") > 1, F.col("bucket")))).alias("firm_type_aux"))


def planned_types(firms: DataFrame, roles: DataFrame, only_unknown: bool = False) -> DataFrame:
    """The firms whose type or auxiliaries change."""
    firms = firms.where("firm_type = 'unknown'") if only_unknown else firms
    new = firm_types(roles).select("firm_id", F.col("firm_type").alias("new_type"), F.col("firm_type_aux").alias("new_aux"))
    same = F.col("firm_type").eqNullSafe(F.col("new_type")) & F.coalesce("firm_type_aux", F.array().cast("array<string>")).eqNullSafe(F.col("new_aux"))
    return firms.join(new, firms.id == new.firm_id).where(~same).select("id", "firm_type", "new_type", "firm_type_aux", "new_aux")


def apply_types(firms: DataFrame, planned: DataFrame) -> DataFrame:
    """Firms with the planned types."""
    new = planned.select("id", F.col("new_type").alias("_type"), F.col("new_aux").alias("_aux"))
    out = firms.join(new, "id", "left")
    return out.withColumn("firm_type_aux", F.when(F.col("_type").isNotNull(), F.col("_aux")).otherwise(F.col("firm_type_aux"))).withColumn("firm_type", F.coalesce("_type", "firm_type")).select(*firms.columns)
