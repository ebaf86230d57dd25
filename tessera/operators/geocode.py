"""Places of projects from an external geocoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import county_name, place_query
from tessera.operators.probes import retrying
from tessera.operators.upsert import fill_nulls
from tessera.storage import written

_ANSWER = "struct<status: string, results: array<struct<geometry: struct<location: struct<lat: double, lng: double>>>>>"


def sweep(projects: DataFrame, backend: Callable[[str], str], redo: bool = False, limit: int | None = None, dry_run: bool = False, throttle: float = 0.0, wait: Callable[[float], None] | None = None) -> tuple[DataFrame, DataFrame]:
    """Projects without a position (all with redo) asked for by location, city and state.  The next version of projects, and stats: outcome, n.

    backend: from a query to the geocoder's answer as JSON (status, results).  Failures that may pass are
    repeated 5 times; a status beside OK and ZERO_RESULTS raises.  A query is asked once however many projects have it.
    New positions replace old ones; a county is only filled.  dry_run leaves the table as it is.
    """
    todo = projects.where(F.lit(True) if redo else F.col("lat").isNull() | F.col("lng").isNull())
    todo = todo.orderBy("id").limit(limit) if limit else todo
    asked = written(todo.select("id", place_query("location", "city", "state").alias("query")))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json
        import time

        ask = retrying(backend, attempts=5, first=2.0, most=30.0, wait=wait)
        for rows in parts:
            out = []
            for q in rows["query"]:
                answer = ask(q)
                if (status := json.loads(answer).get("status")) not in ("OK", "ZERO_RESULTS"):
                    raise RuntimeError(f"geocoder: {status} for {q!r}")
                out.append(answer)
                if throttle:
                    time.sleep(throttle)
            yield rows.assign(answer=out)

    found = written(asked.where("query is not null").select("query").distinct().mapInPandas(run, "query string, answer string"))
    parts = F.get_json_object("answer", "$.results[0].address_components")
    at = F.get(F.from_json("answer", _ANSWER)["results"], F.lit(0))["geometry"]["location"]
    found = found.select("query", at["lat"].alias("lat"), at["lng"].alias("lng"), county_name(parts).alias("county"))
    new = asked.join(found, "query", "left")
    outcome = F.when(F.col("query").isNull(), "no_query").when(F.col("lat").isNull(), "no_match").otherwise("geocoded")
    stats = new.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))
    return (projects if dry_run else fill_nulls(projects, new.where("lat is not null"), "id", keep=["county"], replace=["lat", "lng"])), stats
