"""Exact dedup by a tree merge of sorted digest runs.

Every partition makes a sorted run of (digest, id that stays, copies).  Runs are cut into slices of the
digest space, so that no task ever holds more than a slice, and are merged in rounds: in each round the
node numbers lose their last FAN_BITS bits, and a multiway merge (Spark's external sort of the shuffled
runs, then one streaming pass that folds equal digests) leaves one run a node and slice, until one node
is left.  A group of copies shrinks to one entry a run before it is ever sent.

Digests are SHA-256; each entry also carries the byte length and a second hash of the text, and a merge
that meets one digest with two of these raises rather than drop a document.

Edge cases: a null text counts as empty; an empty table gives an empty result; repeated rows (equal id
and text) are copies of each other and all carry the id that stays; a null id stays only if no copy has
an id; ties cannot occur, as the id that stays is the largest; a very long text is read whole and only its digest is sent;
columns beside id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import attach
from .runtime import text_of, written

#: Nodes at first, and bits that each round takes off their numbers (fan-in 16).
NODE_BITS, FAN_BITS = 8, 4
#: Digests that one slice holds on average at most.
SLICE_ROWS = 200_000
_RUN = "slice int, node int, digest string, keep_id long, group_size long, n_bytes long, second long"

_FIELDS = pa.schema([("slice", pa.int32()), ("node", pa.int32()), ("digest", pa.string()), *((c, pa.int64()) for c in ("keep_id", "group_size", "n_bytes", "second"))])


def _fold(largest: bool):
    """One streaming pass over rows sorted by slice, node and digest: rows of one digest become one."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]).cast(_FIELDS)  # Spark marks columns that are never null, and says so differently from run to run
            table = table if held is None else pa.concat_tables([held, table])
            if not table.num_rows:
                continue
            keys = table.select(["slice", "node", "digest"]).to_pandas()
            new = np.ones(len(keys), bool)
            new[1:] = (keys != keys.shift()).any(axis=1).to_numpy()[1:]
            first = np.flatnonzero(new)
            ids = table["keep_id"].to_pandas().astype("Int64")
            group = np.cumsum(new) - 1
            chosen = ids.groupby(group).max() if largest else ids.groupby(group).min()
            for c in ("n_bytes", "second"):
                check = table[c].to_numpy()
                if (check != check[first][group]).any():
                    raise ValueError("two texts share a SHA-256 digest")
            folded = table.take(pa.array(first))
            folded = folded.set_column(3, "keep_id", pa.array(chosen, pa.int64(), from_pandas=True))
            folded = folded.set_column(4, "group_size", pa.array(np.add.reduceat(table["group_size"].to_numpy(), first), pa.int64()))
            yield from folded.slice(0, folded.num_rows - 1).to_batches()
            held = folded.slice(folded.num_rows - 1)
        if held is not None:
            yield from held.to_batches()

    return fold


def digest_groups(rows: DataFrame, n_rows: int, largest: bool) -> DataFrame:
    """rows: digest, id, n_bytes, second.  One row a digest: keep_id, group_size."""
    slices = max(1, -(-n_rows // SLICE_ROWS))
    place = F.floor(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * slices / 2**32).cast("int")
    runs = rows.select(place.alias("slice"), (F.spark_partition_id() % (1 << NODE_BITS)).alias("node"), "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "n_bytes", "second")
    runs = runs.sortWithinPartitions("slice", "node", "digest").mapInArrow(_fold(largest), _RUN)
    for _ in range(0, NODE_BITS, FAN_BITS):
        runs = runs.withColumn("node", F.shiftright("node", FAN_BITS))
        runs = runs.repartition("slice", "node").sortWithinPartitions("slice", "node", "digest").mapInArrow(_fold(largest), _RUN)
    return runs.select("digest", "keep_id", "group_size")


def exact_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", keep: str = "largest") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.  keep: which id of equal texts stays, ``largest`` or ``smallest``."""
    t = text_of(text)
    rows = written(docs.select(F.col(id_col).cast("long").alias("id"), F.sha2(t, 256).alias("digest"), F.octet_length(t).cast("long").alias("n_bytes"), F.xxhash64(t).alias("second")))
    n_rows = rows.count()
    groups = written(digest_groups(rows, n_rows, keep == "largest").where("group_size > 1"))
    joined = attach(rows.select("id", "digest"), groups, "digest", "group_size", n_rows)
    keep_id, size = F.coalesce("keep_id", "id"), F.coalesce("group_size", F.lit(1).cast("long"))
    return joined.select(F.col("id").alias(id_col), keep_id.alias("keep_id"), size.alias("group_size"), F.col("id").eqNullSafe(keep_id).alias("kept"), F.col("digest").alias("text_sha256"))


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
