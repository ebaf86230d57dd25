"""Secret scans: fixed patterns, and password guess cost for values in credential contexts.

The fixed patterns are those of BASE.  Beside them, the value that follows a credential word is priced by
how many guesses it would take: dynamic programming finds the cheapest way to split it into dictionary
words, dates, repeats, keyboard walks and brute-force characters, where each piece costs the logarithm of
its guesses.  A value that costs at least GUESSES is a span of kind ``guess``; one made of words or walks
is not.  The dictionary is the corpus itself: a word costs the logarithm of its rank by frequency over
all distinct texts, where the values of credential contexts count for nothing.  It is a table, as long as
the corpus makes it: only the parts of the values are joined to it.

Edge cases: null or empty texts have no span; ties in the dictionary's order are broken by the word; a
repeated row is scanned like any other; very long texts are scanned whole, and a very long value has its price like any other; an empty table gives an empty result; columns beside id and text
are ignored.  Offsets are in code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import HASHED_BITS, hashed_bits, marked, slices, text_of, written

#: Fixed patterns of the base kinds, in the order of ties.
BASE = {
    "assign": re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{16,}"),
}
#: Fixed least lengths: of group 1 of assign, of the match of access.
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
#: Fixed words of a credential context, and the signs that lead to its value.
CONTEXT = re.compile(
    r"""(?ai:\b(?:pass(?:word|wd|phrase|code|wort)?|pwd|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|credentials?|auth|bearer|login|kennwort|mot de passe|contrase\u00f1a|clave|geheim(?:nis)?|jeton))"""
    r"""["']?[ \t]{0,4}(?:[:=]{1,2}>?|\b(?:is|ist|est|es)\b)[ \t]{0,4}["'`]?([^\s"'`<>,;]{6,})"""
)
#: Base-10 logarithm of the guesses from which a value counts; shortest and longest word and value part looked at by it.
GUESSES, SHORTEST_WORD, LONGEST_WORD = 10.0, 3, 24
#: How often a word must occur in distinct texts, so that a secret is no word of the dictionary.
LEAST_COUNT = 5
#: Fixed rows of keys that walks follow.
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
_PLACE = {c: (r, k) for r, row in enumerate(KEY_ROWS) for k, c in enumerate(row)}
_NEAR = {a: {b for dr in (-1, 0, 1) for dc in (-1, 0, 1) if (dr or dc) and 0 <= r + dr < 4 and 0 <= c + dc < len(KEY_ROWS[r + dr]) for b in KEY_ROWS[r + dr][c + dc]} for r, row in enumerate(KEY_ROWS) for c, a in enumerate(row)}
_DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)")
#: Parts into which the rows of one value are dealt.
DEALT = 16
#: One of these is in every match of CONTEXT and of assign.
_LEADS = re.compile(r"[:=]|\b(?:is|ist|est|es)\b")
_LETTERS = re.compile(r"[^\W\d_]+")
_LOG = [0.0, *(math.log10(k) for k in range(1, 200))]
_DATE_COST, _YEAR_COST, _WALK_START = math.log10(365 * 120), math.log10(120), math.log10(47)


def _char_cost(c: str) -> float:
    return 1.0 if c.isdigit() else 1.415 if c.isascii() and c.isalpha() else 1.505 if c.isascii() else 2.0


class _Pieces:
    """The cheapest piece that ends at a place and starts at one of many: what led to its start, and the logarithm of its length and ``more``.

    A start that an earlier one once matches never wins again, nor does one that a later start of no greater cost follows.
    """

    def __init__(self, more: int) -> None:
        self.more, self.starts = more, []

    def add(self, start: int, cost: float) -> None:
        while self.starts and self.starts[-1][1] >= cost:
            self.starts.pop()
        self.starts.append((start, cost))

    def least(self, end: int) -> float:
        out, kept = math.inf, []
        for start, cost in self.starts:
            if (now := cost + math.log10(end - start + self.more)) < out:
                out = now
                kept.append((start, cost))
        self.starts = kept
        return out


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """Base-10 logarithm of the guesses for the cheapest split of the value."""
    n = len(value)
    ends: dict[int, list[tuple[int, float]]] = {}
    for m in _DATE.finditer(value):
        ends.setdefault(m.end(), []).append((m.start(), _YEAR_COST if m.end() - m.start() == 4 else _DATE_COST))
    lower = value.lower()
    best = [0.0] * (n + 1)
    repeats = {period: _Pieces(period) for period in (1, 2, 3, 4)}  # any part of a repeat or walk is a piece
    repeated, walk, first, turns = dict.fromkeys(repeats, 0), _Pieces(0), 0, [0] * (n + 1)
    for end in range(1, n + 1):
        last = end - 1
        least = best[last] + _char_cost(value[last])
        for period, pieces in repeats.items():
            if last >= period and value[last] != value[last - period]:
                repeated[period] = end - period
                pieces.starts.clear()
            if (start := end - max(3, 2 * period)) >= repeated[period]:
                pieces.add(start, best[start])
                least = min(least, pieces.least(end) - math.log10(period) + sum(map(_char_cost, value[last - period + 1 : end])) + 0.3)
        turns[last] = turns[last - 1]
        if last and lower[last] not in _NEAR.get(lower[last - 1], ()):
            first = last
            walk.starts.clear()
        elif last - first >= 2:
            (r0, c0), (r1, c1), (r2, c2) = (_PLACE[lower[k]] for k in (last - 2, last - 1, last))
            turns[last] += (r2 - r1, c2 - c1) != (r1 - r0, c1 - c0)
        if (start := end - 4) >= first:
            walk.add(start, best[start] - 0.6 * turns[start + 1])
            least = min(least, walk.least(end) + _WALK_START + 0.6 * turns[last] + 0.3)
        for start in range(max(0, end - LONGEST_WORD), end - SHORTEST_WORD + 1):
            if best[start] < least and (rank := ranks.get(lower[start:end])):
                part = value[start:end]
                cost = math.log10(rank + 1) + (0.0 if part == lower[start:end] else 0.3 if part.istitle() or part.isupper() else 0.5 * _LOG[len(part)] + 0.5)
                least = min(least, best[start] + cost + 0.3)
        for start, cost in ends.get(end, ()):
            least = min(least, best[start] + cost + 0.3)
        best[end] = least
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of the base kinds' matches, by start, then kind as listed."""
    found = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text):
            if kind == "assign" and m.end(1) - m.start(1) < LEAST_ASSIGN or kind == "access" and m.end() - m.start() < LEAST_ACCESS:
                continue
            found.append((m.start(), order, m.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(found)]


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Values in credential contexts that meet no base span and are hard to guess without a dictionary: start, end, value."""
    if not _LEADS.search(text):
        return []
    out = []
    for m in CONTEXT.finditer(text):
        a, b = m.span(1)
        if not any(a < e and s < b for s, e, _ in base) and guess_cost(m.group(1), {}) >= GUESSES:
            out.append((a, b, m.group(1)))
    return out


def words_in(value: str) -> set[str]:
    """The parts of a value that can be words of the dictionary."""
    lower, found = value.lower(), set()
    for m in _LETTERS.finditer(lower):
        for a in range(m.start(), m.end() - SHORTEST_WORD + 1):
            found.update(lower[a:b] for b in range(a + SHORTEST_WORD, min(m.end(), a + LONGEST_WORD) + 1))
    return found


def _without_values(text: str) -> str:
    """The text with blanks for what stands as a value in a credential context, or after an assignment."""
    if _LEADS.search(text):
        cuts = sorted([m.span(1) for p in (CONTEXT, BASE["assign"]) for m in p.finditer(text)], reverse=True)
        for a, b in cuts:
            text = text[:a] + " " * (b - a) + text[b:]
    return text


def _count(texts: Iterator[pa.Array]) -> Iterator[pa.RecordBatch]:
    """The words of some texts and how often they occur, in parts that Spark sums."""
    total: Counter[str] = Counter()
    for some in texts:
        for text in some.to_pylist():
            total.update(_without_values(text).lower().split())
            if len(total) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])
                total.clear()
    yield pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])


def _some(copied: np.ndarray, wanted: bool):
    """The texts whose bit says that they have copies, or those whose bit says that they have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
        for batch in slices(batches):
            yield batch.column(0).filter(pa.array(marked(batch.column(1).to_numpy(), copied) == wanted))

    return run


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, n: parts of the counts over all distinct texts.

    A filter of a fixed size marks the hashes of more than one row.  Texts that it leaves out have no copy
    and are counted where they are read; the others, and those that it marks by chance, are shuffled to
    find the distinct ones.
    """
    rows = docs.select(text_of(text).alias("text")).withColumn("hash", F.xxhash64("text")).withColumn("bit", F.pmod("hash", F.lit(HASHED_BITS)))
    copied = hashed_bits(rows.groupBy("hash").agg(F.count("*").alias("n"), F.first("bit").alias("bit")).where("n > 1").select("bit"))
    single, several = _some(copied, False), _some(copied, True)
    alone = rows.select("text", "bit").mapInArrow(lambda batches: _count(single(batches)), "word string, n long")
    more = rows.select("text", "bit").mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([some], ["text"]) for some in several(batches)), "text string").distinct()
    return alone.unionByName(more.mapInArrow(lambda batches: _count(b.column(0) for b in batches), "word string, n long"))


def word_ranks(docs: DataFrame, text: str = "text") -> DataFrame:
    """word, rank: all words of SHORTEST_WORD to LONGEST_WORD letters, and no other characters, by frequency over all distinct texts."""
    words = count_words(docs, text).groupBy("word").agg(F.sum("n").alias("n"))
    plain = F.regexp_replace("word", r"^\P{L}+|\P{L}+$", "")
    words = words.groupBy(plain.alias("word")).agg(F.sum("n").alias("n")).where(f"length(word) between {SHORTEST_WORD} and {LONGEST_WORD} and n >= {LEAST_COUNT}")
    words = words.where(F.col("word").rlike(r"^\p{L}+$")).orderBy(F.desc("n"), "word").select("word", F.monotonically_increasing_id().alias("_at"))
    words = written(words)  # the upper bits are the sorted partition, the lower 33 the place in it
    part = F.shiftright("_at", 33)
    sizes = sorted((r["part"], r["count"]) for r in words.groupBy(part.alias("part")).count().collect())
    before, held = [], 0
    for at, n in sizes:
        before.append((at, held))
        held += n
    before = docs.sparkSession.createDataFrame(before, "_part long, _before long")
    words = words.withColumn("_part", part).join(F.broadcast(before), "_part")
    return words.select("word", (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).alias("rank"))


_KIND = "array<struct<start int, end int, kind string>>"
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
_VALUE = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        base, values = [], []
        for text in batch.column(1).to_pylist():
            own = base_spans(text)
            base.append([dict(zip(("start", "end", "kind"), s, strict=True)) for s in own])
            values.append([dict(zip(("start", "end", "value"), s, strict=True)) for s in candidates(text, own)])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, _SPAN), pa.array(values, _VALUE)], ["_id", "base", "values"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = sorted(words_in(value))
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(words), pa.int64()), pa.array(words, pa.string())], ["_key", "word"])


def _price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hard = [v for v, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if guess_cost(v, {w["word"]: w["rank"] for w in words or ()}) >= GUESSES]
        yield pa.RecordBatch.from_arrays([pa.array(hard, pa.string())], ["value"])


def hard_values(values: DataFrame, ranks: DataFrame) -> DataFrame:
    """values: value, distinct.  Those that stay hard to guess when their parts that are words cost their ranks."""
    values = written(values.withColumn("_key", F.monotonically_increasing_id()))
    parts = written(values.select("_key", "value").mapInArrow(_parts, "_key long, word string"))
    used = parts.select("word").distinct().join(ranks.hint("merge"), "word")  # a word that many values have is one row here
    words = parts.join(used, "word").groupBy("_key").agg(F.collect_list(F.struct("word", "rank")).alias("words"))
    return values.join(words, "_key", "left").select("value", "words").mapInArrow(_price, "value string")


def scan_secrets(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, base spans and all spans (start, end, kind)."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), text_of(text)).mapInArrow(_scan, f"_id {kind}, base {_KIND}, values array<struct<start int, end int, value string>>")
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()))
    some = rows.where(F.size("values") > 0).select("_id", "base", "_row", F.explode("values").alias("_v"))
    hard = hard_values(some.select(F.col("_v.value").alias("value")).distinct(), word_ranks(docs, text))
    hard = hard.select(F.col("value").alias("_value"), F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))).alias("_deal"))
    some = some.withColumn("_deal", F.pmod("_row", F.lit(DEALT)).cast("int"))  # a value that many rows have goes to many tasks
    found = some.join(hard, (F.col("_v.value") == F.col("_value")) & (some["_deal"] == hard["_deal"]), "left")
    guess = F.when(F.col("_value").isNotNull(), F.struct(F.col("_v.start").alias("start"), F.col("_v.end").alias("end"), F.lit("guess").alias("kind")))
    found = found.groupBy("_row").agg(F.first("_id").alias("_id"), F.first("base").alias("base"), F.collect_list(guess).alias("_guess"))
    rank = F.create_map(*(F.lit(x) for k, name in enumerate([*BASE, "guess"]) for x in (name, k)))
    keyed = F.transform(F.concat("base", "_guess"), lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("order"), s["end"].alias("end"), s["kind"].alias("kind")))
    spans = F.transform(F.sort_array(keyed), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    found = found.select(F.col("_id").alias(id_col), "base", spans.alias("spans"))
    return rows.where(F.size("values") == 0).select(F.col("_id").alias(id_col), "base", F.col("base").alias("spans")).unionByName(found)


def op9_guess_cost_secrets(spark, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k))
    counts = [of_kind(k).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(shown("base"), 256).alias("base_sha256"), shown("spans").alias("spans"))
