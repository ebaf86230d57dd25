"""Sharding by minimax contiguous partition of ordered atomic groups.

Equal texts form one atomic group.  Groups are ordered by a 64-bit hash of the text, so that a run of
groups is a range of hashes and a row's shard follows from its own hash alone.  The smallest feasible
shard capacity is found by binary search, each capacity checked greedily.

The greedy check needs running totals of an ordered table that no single machine may hold.  The driver
therefore keeps totals of *segments* (ranges of hashes), 65,536 at first whatever the input.  A
capacity is surely feasible if greedy cuts at segment borders alone suffice, and surely infeasible if
greedy cuts that may fall anywhere but inside a known atomic group do not.  While the two answers
leave a gap, segments near possible cuts are split 64-fold, at most REFINED in a round, until the
smallest capacity is known exactly.  The cuts then chosen keep every shard within that capacity and
lie as near as they can to equal sizes.

Edge cases: a null text counts as empty (size 16 with the default overhead); an empty table gives an
empty result; repeated rows share a shard and take slots of their own; with fewer groups than shards
some shards stay empty; equal texts are never parted, of equally good cuts the one nearer to equal sizes is taken; a very
long text is one row of its size, never cut; extra columns are kept, and a column already named ``shard``, ``slot`` or
``size`` is replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import text_of, written

SHARDS, OVERHEAD = 40, 16
#: Segments at first are 2**16 ranges; each split makes 64; so many are split in a round at most.
FIRST_SHIFT, STEP, REFINED = 48, 6, 4096
#: Each shard is numbered in so many cells.
CELLS = 1024


class Segments:
    """Ranges of hashes in order: first hash, size, whether all rows have one hash, width in bits."""

    def __init__(self, start, size, single, shift) -> None:
        order = np.argsort(start, kind="stable")
        self.start, self.size, self.single, self.shift = (np.asarray(x)[order] for x in (start, size, single, shift))
        self.ends = np.concatenate(([0], np.cumsum(self.size, dtype=np.int64)))

    @property
    def total(self) -> int:
        return int(self.ends[-1])

    def coarse(self, capacity: int, shards: int) -> list[int] | None:
        """Greedy cuts at segment borders, as indices; None if they do not suffice."""
        cuts, at = [0], 0
        while at < len(self.size):
            to = int(np.searchsorted(self.ends, self.ends[at] + capacity, "right")) - 1
            if to <= at or len(cuts) > shards:
                return None
            cuts.append(at := to)
        return cuts if len(cuts) <= shards + 1 else None

    def ideal(self, capacity: int, shards: int) -> list[int] | None:
        """Greedy cuts anywhere but in an atomic group, as positions; None if even these do not suffice."""
        at, cuts = 0, [0]
        for _ in range(shards):
            to = min(at + capacity, self.total)
            k = int(np.searchsorted(self.ends, to, "right")) - 1
            if k < len(self.size) and self.single[k]:
                to = int(self.ends[k])
            if to <= at < self.total:
                return None
            cuts.append(at := to)
        return cuts if at >= self.total else None

    def bracket(self, shards: int) -> tuple[int, int]:
        """The smallest capacity that may be feasible and the smallest that surely is."""
        least = max(-(-self.total // shards), int(self.size[self.single].max(initial=0)), 1)
        return (self._least(self.ideal, shards, least), self._least(self.coarse, shards, least))

    def _least(self, feasible, shards: int, low: int) -> int:
        high = max(low, self.total)
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if feasible(mid, shards) is not None else (mid + 1, high)
        return low

    def near_cuts(self, low: int, high: int, shards: int) -> np.ndarray:
        """Segments that can hold a cut for a capacity from low to high."""
        late = self.ideal(high, shards) or []
        early, at = [0], 0
        for _ in range(shards):
            to = int(np.searchsorted(self.ends, min(at + low, self.total), "right")) - 1
            early.append(at := int(self.ends[to]))
        hit = np.zeros(len(self.size), bool)
        for a, b in zip(early, late, strict=False):
            hit[max(0, np.searchsorted(self.ends, a, "right") - 1) : np.searchsorted(self.ends, max(a, b), "left") + 1] = True
        hit &= ~self.single
        return hit if hit.any() else ~self.single

    def balanced(self, capacity: int, shards: int) -> list[int]:
        """Indices of cuts within the capacity, each as near to an equal share of the rest as the capacity allows."""
        m = len(self.size)
        last = [m]
        for _ in range(shards - 1):  # from the end: the first border from which so many shards suffice
            last.append(int(np.searchsorted(self.ends, self.ends[last[-1]] - capacity, "left")))
        cuts = [0]
        for k in range(1, shards):
            at, left = cuts[-1], shards - k
            most = int(np.searchsorted(self.ends, self.ends[at] + capacity, "right")) - 1
            want = self.ends[at] + (self.total - self.ends[at]) / (left + 1)
            near = int(np.searchsorted(self.ends, want, "left"))
            if near > 0 and want - self.ends[near - 1] <= self.ends[min(near, m)] - want:
                near -= 1
            cuts.append(min(max(near, last[left], at), most))
        return [*cuts, m]


def _segments(rows: DataFrame, shift: int, parents: list[int] | None) -> tuple:
    """The totals of ranges of 2**shift hashes; parents: only in these ranges, 64 times as wide."""
    if parents is not None:
        wide = rows.sparkSession.createDataFrame([(p,) for p in parents], "_wide long")  # REFINED rows at most
        rows = rows.join(F.broadcast(wide), F.shiftright("_hash", shift + STEP) == F.col("_wide"), "left_semi")
    found = rows.groupBy(F.shiftright("_hash", shift).alias("at")).agg(F.sum("size").alias("size"), (F.min("_hash") == F.max("_hash")).alias("single")).collect()
    return [r["at"] << shift for r in found], [r["size"] for r in found], [r["single"] for r in found], [shift] * len(found)


def plan_cuts(rows: DataFrame, shards: int) -> tuple[list[int], int]:
    """rows: _hash, size.  The first hash of each shard after the first, and the capacity."""
    s = Segments(*_segments(rows, FIRST_SHIFT, None))
    if not len(s.size):
        return [], 0
    while True:
        low, high = s.bracket(shards)
        if low >= high:
            break
        near = np.flatnonzero(s.near_cuts(low, high, shards))
        near = near[np.argsort(-s.size[near], kind="stable")][:REFINED]
        parts = [tuple(np.delete(x, near) for x in (s.start, s.size, s.single, s.shift))]
        for shift in sorted(set(s.shift[near].tolist())):
            parts.append(_segments(rows, shift - STEP, [int(x) >> shift for x in s.start[near[s.shift[near] == shift]]]))
        s = Segments(*(np.concatenate([np.asarray(p[k]) for p in parts]) for k in range(4)))
    top = np.iinfo(np.int64).max
    return [int(s.start[k]) if k < len(s.start) else int(top) for k in s.balanced(high, shards)[1:-1]], high


def number_rows(df: DataFrame, group: str, order: list[str], out: str) -> DataFrame:
    """Numbers the rows of each group without gaps from 0.  Groups are few; each is numbered in CELLS cells, dealt by the hash of ``order``'s columns."""
    df = df.withColumn("_cell", F.pmod(F.xxhash64(*order), F.lit(CELLS)))
    counts = df.groupBy(group, "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = df.withColumn("_k", F.row_number().over(Window.partitionBy(group, "_cell").orderBy(*order)))
    # groups * CELLS rows at most, whatever the input
    return numbered.join(F.broadcast(counts), [group, "_cell"]).withColumn(out, (F.col("_k") - 1 + F.col("_before")).cast("long")).drop("_k", "_before", "_cell")


def minimax_shards(docs: DataFrame, shards: int = SHARDS, text: str = "text", id_col: str = "doc_id", overhead: int = OVERHEAD, slim: bool = False) -> DataFrame:
    """Adds size, shard (0 to shards - 1) and slot (gapless from 0 within the shard).  slim: the text's crc32 in place of the text and all other columns."""
    t = text_of(text)
    kept = [F.col(id_col), F.crc32(t).alias("text_crc32")] if slim else [F.col(c) for c in docs.columns if c.lower() not in ("size", "shard", "slot")]
    # packed, so that no column of the documents can clash with those used here
    rows = docs.select(F.struct(*kept).alias("_row"), F.col(id_col).alias("_id"), (F.octet_length(t) + overhead).cast("long").alias("size"), F.xxhash64(t).alias("_hash"))
    if slim:
        rows = written(rows)
    cuts, _ = plan_cuts(rows if slim else written(rows.select("_hash", "size")), shards)
    shard = sum(((F.col("_hash") >= c).cast("int") for c in cuts), F.lit(0))
    return number_rows(rows.withColumn("shard", shard), "shard", ["_hash", "_id"], "slot").select("_row.*", "size", "shard", "slot")


def op1_minimax_shards(spark, sf_dir: str) -> DataFrame:
    out = minimax_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), slim=True)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
