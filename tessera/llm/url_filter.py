"""URL filter: fixed rules first, then the likelihood ratio of two character language models.

Both models are variable-order Markov chains over the bytes of host and path: each order's estimate is
smoothed by the next lower one (Dirichlet), down to a uniform guess, so a context that was never seen
counts for nothing.  Counts are exact: a byte with the ORDER bytes before it is one number, counted in a
table that grows with the URLs; lower orders are sums over it.  They come from all URLs of the training
folds.  Accepted URLs are those that no blocking rule fits and whose host has no seed word; rejected ones
are those whose host has one.  (A blocking rule is a policy, not a sign of how a URL looks, so what only a
rule blocks trains neither model.)  The score is the difference of the log-likelihoods per byte; the
threshold is the one with the fewest errors on the fold kept out.

Edge cases: a null URL, or one without ``://``, has an empty host and path, scores 0 and is allowed by the
model; where there are no accepted or no rejected URLs the model allows all; the smaller of equally good
thresholds is taken; a very long URL is scored by all its bytes; repeated rows are judged alike; an empty table gives an empty result; columns beside
id and url are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import written

#: Fixed rules: pattern (host and path) and verdict.
RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))
#: Fixed seed words: a host with one of them as a part (between dots, hyphens or digits) is a rejected example.
SEEDS = ("casino", "casinos", "bet", "bets", "betting", "poker", "slots", "jackpot", "pills", "pharmacy", "viagra", "cialis", "spam", "adult", "porn", "xxx", "sex", "escort", "ads", "track", "tracker", "clickbait", "malware", "phishing", "warez", "torrent", "loan", "loans")
#: Bytes of the longest context; rows scored at once; weight of the lower order; of FOLDS folds, one calibrates.
ORDER, BLOCK_ROWS, LOWER, FOLDS, BINS = 5, 20_000, 0.6, 5, 4000


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.col(url).substr(at + 3, F.length(url))).otherwise("")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = lambda n: F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", n), F.lit(""))
    return F.translate(found(1), upper, lower), found(2)


def rule_of(host: str, path: str, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: len(r[0])):
        site, _, rest = rule.partition("/")
        fits = ((F.col(host) == site) | F.col(host).endswith(f".{site}")) & F.col(path).startswith(f"/{rest}")
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def grams(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of each byte of some strings: the string's place, and the byte with the ORDER bytes before it as one number, the nearest in the lower bits."""
    joined = (b"\0" * ORDER).join([b"", *strings, b""])
    data = np.frombuffer(joined, np.uint8).astype(np.int64)
    lengths = np.array([len(x) for x in strings], np.int64)
    starts = np.cumsum(np.concatenate(([ORDER], lengths + ORDER)))[:-1]
    owner = np.repeat(np.arange(len(strings)), lengths)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts, lengths)
    return owner, sum((data[at - k] << (8 * k) for k in range(ORDER + 1)), np.zeros(len(at), np.int64))


def _bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        owner, gram = grams(_bytes(batch.column(0)))
        wanted = batch.column(1).to_numpy(zero_copy_only=False)[owner] if len(owner) else np.zeros(0)
        found, place = np.unique(gram, return_inverse=True)
        counts = [np.bincount(place[wanted == k], minlength=len(found)).astype(np.int64) for k in (1, 0)]
        yield pa.RecordBatch.from_arrays([pa.array(found), *map(pa.array, counts)], ["gram", "accepted", "rejected"])


def count_grams(rows: DataFrame) -> DataFrame:
    """rows: string, label (1 accepted, 0 rejected, else not counted).  Every gram of the strings: gram, accepted, rejected."""
    found = rows.mapInArrow(_count, "gram long, accepted long, rejected long")
    return found.groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


def likelihoods(counts: DataFrame) -> DataFrame:
    """counts: as count_grams returns.  gram, ratio: the difference of the log-likelihoods of its last byte after the others."""
    names, lower = ("accepted", "rejected"), None
    for k in range(ORDER + 1):
        weight = LOWER * 2**k if k else 1.0
        sums = [F.sum(n).alias(n) for n in names]
        whole = counts.groupBy(F.col("gram").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("gram")).agg(*sums)
        before = whole.groupBy(F.shiftright("gram", 8).alias("_before")).agg(*(F.sum(n).alias(f"_{n}") for n in names))
        out = whole.withColumn("_before", F.shiftright("gram", 8)).join(before, "_before")
        if lower is not None:
            out = out.withColumn("_low", F.col("gram").bitwiseAND((1 << 8 * k) - 1)).join(lower, "_low")
        guess = lambda n: F.col(f"_p_{n}") if lower is not None else F.lit(1 / 256)  # noqa: B023, E731
        share = [((F.col(n) + weight * guess(n)) / (F.col(f"_{n}") + weight)).alias(f"_p_{n}") for n in names]
        out = out.select(F.col("gram").alias("_low"), *share)
        lower = out
    return lower.select(F.col("_low").alias("gram"), (F.log("_p_accepted") - F.log("_p_rejected")).alias("ratio"))


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        owner, gram = grams(_bytes(batch.column(1)))
        block = batch.column(0).to_numpy(zero_copy_only=False)[owner] if len(owner) else np.zeros(0, np.int64)
        pairs = np.unique(np.stack([block.astype(np.int64), gram]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["_block", "gram"])


def _score(rows: pa.Table, known: pa.Table) -> pa.Table:
    strings = _bytes(rows["_string"])
    owner, gram = grams(strings)
    keys, values = known["gram"].to_numpy(), known["ratio"].to_numpy()
    order = np.argsort(keys)
    ratio = values[order][np.searchsorted(keys[order], gram)] if len(gram) else np.zeros(0)
    lengths = np.array([len(x) for x in strings])
    return rows.append_column("score", pa.array(np.bincount(owner, ratio, len(strings)) / np.maximum(lengths, 1), pa.float64()))


def score(rows: DataFrame, ratios: DataFrame) -> DataFrame:
    """rows with _string and _block, and the ratio of every gram.  Adds score: the mean ratio of a string's bytes, higher for URLs like accepted ones.

    Each block of rows is dealt the ratios of its own grams.
    """
    needed = rows.select("_block", "_string").mapInArrow(_needed, "_block long, gram long").distinct()
    known = needed.join(ratios, "gram").select("_block", "gram", "ratio")
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(_score, f"{kind}, score double")


def calibrate(scored: DataFrame) -> float:
    """The score below which to reject: the fewest errors over a histogram of BINS bins."""
    place = F.least(F.greatest(F.floor((F.col("score") + 10) * BINS / 20), F.lit(0)), F.lit(BINS - 1)).cast("int")
    counts = np.zeros((2, BINS))
    for r in scored.groupBy("_label", place.alias("bin")).count().collect():
        counts[r["_label"], r["bin"]] = r["count"]
    errors = np.concatenate(([0], np.cumsum(counts[1]))) + counts[0].sum() - np.concatenate(([0], np.cumsum(counts[0])))
    best = np.flatnonzero(errors == errors.min())
    return float((best[0] + best[-1]) / 2 * 20 / BINS - 10) if best[-1] - best[0] < BINS // 2 else float(best[0] * 20 / BINS - 10)


def judge(pages: DataFrame, url: str = "url", id_col: str = "page_id", rules=RULES, seeds=SEEDS) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, score."""
    host, path = parts(url)
    rows = pages.select(F.col(id_col), host.alias("host"), path.alias("path"), (F.crc32(F.coalesce(F.col(url), F.lit("")).cast("binary")) % FOLDS).alias("_fold"))
    rule, says = rule_of("host", "path", rules)
    rows = rows.withColumn("rule", rule).withColumn("_says", says).withColumn("_string", F.concat("host", "path"))
    seeded = F.col("host").rlike(rf"(?:^|[.\-0-9])(?:{'|'.join(seeds)})(?:$|[.\-0-9])")
    label = F.when(seeded, 0).when(F.col("_says").eqNullSafe("block") | (F.col("host") == ""), None).otherwise(1)
    rows = rows.withColumn("_label", label.cast("int"))
    rows = written(rows.withColumn("_at", F.monotonically_increasing_id()))
    blocks = rows.count() // BLOCK_ROWS + 1
    rows = rows.withColumn("_block", F.pmod(F.shiftright("_at", 33) + F.col("_at"), F.lit(blocks)).cast("long")).drop("_at")
    counts = written(count_grams(rows.select("_string", F.when(F.col("_fold") != 0, F.col("_label")).alias("_label"))))
    model = counts.agg(F.sum("accepted"), F.sum("rejected")).first()
    if not (model[0] and model[1]):
        return rows.select(id_col, "host", "path", "rule", F.coalesce("_says", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("score"))
    scored = written(score(rows, likelihoods(counts)))
    threshold = calibrate(scored.where("_label is not null and _fold = 0"))
    return scored.select(id_col, "host", "path", "rule", F.coalesce("_says", F.when((F.col("score") < threshold) & (F.col("host") != ""), "block").otherwise("allow")).alias("verdict"), "score")


def op7_character_ratio_urls(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))
