"""Personal data by weak supervision, in DataFrame and SQL functions alone.

Candidates are the matches of fixed base patterns and of looser ones: numbers without a country code or
led by a word for one, spelled-out addresses, version 6 addresses, card-like groups, and the well-formed
parts of what a base pattern took in one failing match (two cards in a row, a phone number before an
address).  Labelers vote on each: one for the strict form, a gazetteer for its parts, keywords before it,
counter-keywords before it, and its surroundings.  Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is, per kind, without labels; the class to which the labelers
say yes more often is the one of personal data.  The posteriors then train the final classifier, a logistic regression over the
span's features, which decides which looser spans are added.  Base spans always stay.

A kind has at most 3**5 vote patterns and 2**7 feature patterns, whatever the input, so both fits fold
over one small array inside a SQL expression; the counts themselves come from all documents.

Edge cases: null or empty texts have no span; a kind without candidates has no model and adds nothing; a
looser span that meets a base span is dropped; equal spans of two kinds are both given; very long texts are
scanned whole; an empty table gives an empty result; repeated rows are scanned alike; columns beside id and
text are ignored.  Offsets are in code points, ends exclusive.

The patterns give the matches of the plain forms, leftmost and non-overlapping, but never retry inside a
run that has failed: quantifiers are possessive and a match starts where its run of characters starts,
or where the last match ended.  So a long run takes linear time and no stack.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import text_of, written

KINDS = ("email", "ip", "card", "phone")
#: Fixed base patterns.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Fixed looser patterns.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]{1,63}+){1,4}+",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){5,7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Fa-f:])",
    "card": r"(?<![\p{L}0-9-])(?:[0-9]{12,19}+(?![\p{L}0-9-])|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{3,7}+(?![0-9-]))",
    "phone": r"(?=[0-9(+])(?:(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9.-])"
    r"|\+[1-9][0-9]{0,2}[ .-]?\([0-9]{1,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9-])"
    r"|(?<=(?i:phone|tel|mobile|fax|telefon|téléphone|teléfono)[.:]{0,2} {1,2})[0-9(][0-9 ()/.-]{5,16}[0-9](?![0-9]))",
}
#: Fixed gazetteers: forms whose parts are known ones.
KNOWN = {
    "email": r"(?i)(?:\.|dot[)\]]) ?(?:com|org|net|edu|gov|mil|int|info|biz|io|co|ai|app|dev|de|fr|es|it|nl|be|ch|at|uk|ie|pt|pl|se|no|dk|fi|cz|eu|us|ca|mx|br|ar|cl|au|nz|jp|cn|in|kr|ru|tr|za)$",
    "ip": r"^(?!0|10\.|127\.|22[4-9]\.|2[3-5][0-9]\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6)",
    "phone": r"^(?:\+[1-9]|\(?[2-9][0-9]{2})",
}
#: Fixed keywords of contexts.
NEARBY = {
    "email": r"(?i)(?:e-?mail|mail|contact|write to|courriel|correo|kontakt)[^\n]{0,24}$",
    "ip": r"(?i)(?:\bip\b|address|host|server|client|from|adresse)[^\n]{0,24}$",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)[^\n]{0,24}$",
    "phone": r"(?i)(?:phone|\btel|call|mobile|cell|fax|contact|telefon|téléphone|teléfono)[^\n]{0,24}$",
}
AGAINST = r"(?i)(?:version|\bver\b|build|release|isbn|issn|\bdoi\b|invoice|order|ticket|\bsku\b|\bref\b|serial|\bid\b|\bno\.|№|#)[ :#.]{0,4}$"
#: Code points before a span that the context labelers read; labelers; features and the constant.
BEFORE, LABELERS, FEATURES = 48, 5, 8
ROUNDS, STEPS, RATE = 25, 150, 2.0
_SPANS = "array<struct<start: int, end: int, value: string>>"


def _found(text: Column, pattern: str) -> Column:
    """All matches as (start, end, value): the text is marked, split at the marks, and lengths are added up.

    The marks are two control characters; where a text has them, they are first replaced by a third, which no pattern matches.
    """
    parts = F.split(F.regexp_replace(text, f"({pattern})", "\x01$1\x02"), "\x01", -1)
    empty = F.struct(F.length(parts[0]).alias("at"), F.array().cast(_SPANS).alias("found"))

    def step(state: Column, part: Column) -> Column:
        value = F.substring_index(part, "\x02", 1)
        span = F.struct(state["at"].alias("start"), (state["at"] + F.length(value)).alias("end"), value.alias("value"))
        return F.struct((state["at"] + F.length(part) - 1).alias("at"), F.concat(state["found"], F.array(span)).alias("found"))

    return F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), empty, step)["found"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    d = _digits(value)

    def add(total: Column, k: Column) -> Column:
        x = d.substr(F.length(d) - k + 1, F.lit(1)).cast("int") * F.when(k % 2 == 0, 2).otherwise(1)
        return total + x - F.when(x > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def _valid(kind: str) -> Callable[[Column], Column]:
    """What a base match must satisfy beside its pattern."""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
        return lambda s: s["value"].rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return lambda s: F.length(_digits(s["value"])).between(12, 19) & _luhn(s["value"])
    if kind == "phone":
        return lambda s: F.length(_digits(s["value"])).between(9, 15)
    return lambda s: F.lit(True)


def _looser(kind: str, apart: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """What a looser match must satisfy: a card has its check digit, a number enough digits."""
    if kind == "card":
        return lambda s: apart(s) & _luhn(s["value"])
    if kind == "phone":
        return lambda s: apart(s) & F.length(_digits(s["value"])).between(7, 15)
    return apart


def _candidates(spans: str, kind: str, order: int, text: Column, base: bool) -> Column:
    """The spans with their votes (1, 0, -1) and features (bits)."""
    return F.transform(spans, lambda s: _candidate(kind, order, text, s, base))


def _candidate(kind: str, order: int, text: Column, span: Column, base: bool) -> Column:
    value, start, end = span["value"], span["start"], span["end"]
    before = text.substr(F.greatest(start - BEFORE + 1, F.lit(1)), F.least(start, F.lit(BEFORE)))
    around = F.concat(text.substr(start, F.when(start > 0, 1).otherwise(0)), text.substr(end + 1, F.lit(1)))
    known, near, against, open_ = value.rlike(KNOWN[kind]), before.rlike(NEARBY[kind]), before.rlike(AGAINST), ~around.rlike(r"[\p{L}\p{N}_]")
    vote = lambda yes, no: F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))
    never = F.lit(False)
    votes = F.array(vote(F.lit(base), never), vote(known, ~known), vote(near, never), vote(never, against), vote(open_, ~open_))
    bits = [F.lit(base), known, near, against, open_, value.rlike(r"[ ().\[-]"), F.length(value) >= 14]
    return F.struct(F.lit(order).alias("kind"), start.alias("start"), end.alias("end"), F.lit(base).alias("base"), votes.alias("votes"), sum((b.cast("int") * (1 << k) for k, b in enumerate(bits)), F.lit(0)).alias("bits"))


def candidates(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, and found: array of kind (number), start, end, base, votes, bits."""
    rows = docs.select(F.col(id_col), F.translate(text_of(text), "\x01\x02", "\x03\x03").alias("_text"))
    t = F.col("_text")
    # a needle that every match has keeps the pattern off most texts
    needle = {"email": t.contains("@"), "ip": t.contains("."), "card": F.lit(True), "phone": t.contains("+")}
    none = F.array().cast(_SPANS)
    rows = rows.select("*", *(F.when(needle[k], F.filter(_found(t, BASE[k]), _valid(k))).otherwise(none).alias(f"_{k}") for k in KINDS))
    rows = rows.withColumn("_base", F.concat(*(f"_{k}" for k in KINDS)))
    apart = lambda s: ~F.exists("_base", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"]))
    loose_needle = {"email": t.contains("(at)") | t.contains("[at]"), "ip": t.contains(":"), "card": F.lit(True), "phone": F.lit(True)}
    rows = rows.select("*", *(F.when(loose_needle[k], F.filter(_found(t, LOOSE[k]), _looser(k, apart))).otherwise(none).alias(f"_loose_{k}") for k in KINDS))
    made = [_candidates(f"{prefix}{k}", k, n, t, base) for n, k in enumerate(KINDS) for prefix, base in (("_", True), ("_loose_", False))]
    return rows.select(id_col, F.concat(*made).alias("found"))


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` standing for ``value``, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def fit_votes(found: DataFrame) -> DataFrame:
    """One row a kind: theta, the prior and then, for no and yes, for votes -1, 0, 1, each labeler's probability."""
    n = LABELERS
    counts = found.groupBy("kind", "votes").agg(F.count("*").cast("double").alias("n")).groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("pats"))
    # at first: yes is likelier where a labeler says so
    first = [0.5, *([0.4] * n), *([0.4] * n), *([0.2] * n), *([0.2] * n), *([0.4] * n), *([0.4] * n)]
    start = "array(" + ",".join(f"{x}D" for x in first) + ")"
    odds = f"ln(th[0] / (1 - th[0])) + aggregate(sequence(0, {n - 1}), 0D, (s, j) -> s + ln(th[1 + (p.votes[j] + 4) * {n} + j]) - ln(th[1 + (p.votes[j] + 1) * {n} + j]))"
    soft = f"transform(pats, p -> {_let(f'1 / (1 + exp(-({odds})))', 'q', 'named_struct("v", p.votes, "a", p.n * (1 - q), "b", p.n * q)')})"
    total = lambda c: f"aggregate(r, 0D, (s, x) -> s + x.{c})"
    share = lambda c: f"(aggregate(r, 1D, (s, x) -> s + if(x.v[k % {n}] = (k div {n}) % 3 - 1, x.{c}, 0D)) / ({total(c)} + 3))"
    update = f"concat(array(({total('b')} + 1) / ({total('a')} + {total('b')} + 2)), transform(sequence(0, {6 * n - 1}), k -> if(k < {3 * n}, {share('a')}, {share('b')})))"
    fold = f"aggregate(sequence(1, {ROUNDS}), {start}, (th, i) -> {_let(soft, 'r', update)})"
    # of two classes the one that labelers say yes to more often is yes, wherever the rounds have led
    sure = lambda at: f"aggregate(sequence(0, {n - 1}), 0D, (s, j) -> s + th[{1 + at + 2 * n} + j] - th[{1 + at} + j])"
    turned = f"concat(array(1 - th[0]), slice(th, {3 * n + 2}, {3 * n}), slice(th, 2, {3 * n}))"
    return counts.select("kind", F.expr(_let(fold, "th", f"if({sure(3 * n)} >= {sure(0)}, th, {turned})")).alias("theta"))


def fit_spans(found: DataFrame, theta: DataFrame) -> DataFrame:
    """One row a kind: weights of the features and the constant, trained on the posteriors."""
    n = LABELERS
    odds = f"ln(theta[0] / (1 - theta[0])) + aggregate(sequence(0, {n - 1}), 0D, (s, j) -> s + ln(theta[1 + (votes[j] + 4) * {n} + j]) - ln(theta[1 + (votes[j] + 1) * {n} + j]))"
    counts = found.groupBy("kind", "votes", "bits").agg(F.count("*").cast("double").alias("n")).join(F.broadcast(theta), "kind")  # a row a kind
    counts = counts.withColumn("y", F.expr(f"1 / (1 + exp(-({odds})))")).groupBy("kind", "bits").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("yes"))
    row = f"named_struct('f', transform(sequence(0, {FEATURES - 1}), k -> if(k = {FEATURES - 1}, 1D, cast((bits div cast(pow(2, k) as int)) % 2 as double))), 'n', n, 'yes', yes)"
    rows = counts.select("kind", F.expr(row).alias("row")).groupBy("kind").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    start = "array(" + ",".join(["0D"] * FEATURES) + ")"
    gap = f"transform(rows, x -> named_struct('f', x.f, 'g', x.n / (1 + exp(-aggregate(sequence(0, {FEATURES - 1}), 0D, (s, k) -> s + w[k] * x.f[k]))) - x.yes, 'n', x.n))"
    step = f"transform(w, (v, k) -> v - {RATE}D * (aggregate(g, 0D, (s, x) -> s + x.g * x.f[k]) / aggregate(g, 0D, (s, x) -> s + x.n) + 0.001D * v))"
    return rows.select("kind", F.expr(f"aggregate(sequence(1, {STEPS}), {start}, (w, i) -> {_let(gap, 'g', step)})").alias("weights"))


def find_pii(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, and spans: array of start, kind (number), end, base, in order."""
    rows = written(candidates(docs, text, id_col))
    found = rows.select(F.explode("found").alias("c")).select("c.kind", "c.votes", "c.bits")
    weights = {r["kind"]: r["weights"] for r in fit_spans(found, fit_votes(found)).collect()}  # a row a kind

    def accepted(c: Column) -> Column:
        score = F.lit(False)
        for kind, w in weights.items():
            logit = sum((F.lit(float(w[k])) * F.getbit(c["bits"].cast("long"), F.lit(k)).cast("double") for k in range(FEATURES - 1)), F.lit(float(w[-1])))
            score = F.when(c["kind"] == kind, logit >= 0.0).otherwise(score)
        return c["base"] | score

    chosen = F.transform(F.filter("found", accepted), lambda c: F.struct(c["start"], c["kind"], c["end"], c["base"]))
    return rows.select(id_col, F.array_sort(chosen).alias("spans"))


def op4_weak_supervision_pii(spark, sf_dir: str) -> DataFrame:
    rows = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    names = F.array(*map(F.lit, KINDS))
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])
    of_kind = lambda n: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == n)))
    counts = [of_kind(n).cast("long").alias(f"n_{k}") for n, k in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(shown(base), 256).alias("base_sha256"), shown("spans").alias("spans"))
