"""Pages scored by how many signals of project information they have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The signals, compared in any case.
SIGNALS = (
    r"Location\s*:", r"Owner\s*:", r"Architect\s*:", r"General Contractor\s*:", r"Square F(?:eet|ootage)\s*:", r"Design Team", r"Construction Team",
    r"Project Team", r"Structural Engineer\s*:", r"Mechanical Engineer\s*:", r"Electrical Engineer\s*:", r"Civil Engineer\s*:", r"Cost\s*:", r"Developer\s*:",
)
THRESHOLD = 3


def score_pages(pages: DataFrame, threshold: int = THRESHOLD, signals: tuple[str, ...] = tuple(f"(?i){s}" for s in SIGNALS), text: str = "text") -> DataFrame:
    """The pages of at least ``threshold`` signals, with their score."""
    c = F.coalesce(F.col(text), F.lit(""))
    return pages.withColumn("score", sum((c.rlike(s).cast("int") for s in signals), F.lit(0))).where(F.col("score") >= threshold)
