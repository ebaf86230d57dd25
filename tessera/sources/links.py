"""Links harvested from pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def harvest(pages: DataFrame, base: str = "", suffix: str = ".pdf", host: str | None = None, html: str = "html", id_col: str = "page_id") -> DataFrame:
    """url, id of the first page that has it, file_name.  Relative links are put after ``base``; the suffix is compared in any case."""
    found = pages.select(id_col, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r'href="([^"]+)"'), 1)).alias("pos", "href"))
    rows = found.withColumn("url", F.when(F.col("href").startswith("/"), F.concat(F.lit(base), "href")).otherwise(F.concat(F.lit(base), "href") if base else F.col("href")))
    rows = rows.where(F.lower("url").endswith(suffix.lower())) if suffix else rows
    rows = rows.where(F.col("url").contains(host)) if host else rows
    first = rows.groupBy("url").agg(F.min(id_col).alias(id_col))  # combined in each task, so a link of every page is one row a task
    return first.select("url", id_col, F.try_url_decode(F.element_at(F.split(F.regexp_replace("url", r"[?#].*$", ""), "/"), -1)).alias("file_name"))


def missing(links: DataFrame, have: DataFrame) -> DataFrame:
    """Links whose file is not there yet."""
    return links.join(have.select("file_name"), "file_name", "left_anti")


def fetched(links: DataFrame, fetch: Callable[[str], bytes], have: DataFrame | None = None, delay: float = 0.0) -> DataFrame:
    """file_name, url, content, error of each link, but for files that are there already (``have``); a task waits ``delay`` seconds after each."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        for rows in parts:
            out = []
            for name, url in zip(rows["file_name"], rows["url"], strict=True):
                try:
                    out.append((name, url, fetch(url), None))
                except Exception as e:  # noqa: BLE001  one link's failure stops no other
                    out.append((name, url, None, str(e)))
                if delay:
                    time.sleep(delay)
            yield pd.DataFrame(out, columns=["file_name", "url", "content", "error"])

    todo = links if have is None else missing(links, have)
    return todo.select("file_name", "url").mapInPandas(run, "file_name string, url string, content binary, error string")
