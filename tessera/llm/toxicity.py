"""Toxicity by multiple-instance learning: documents are bags of sentences, labels belong to the bags.

A sentence's probability is a logistic function of its hashed words and word beginnings; a document's
is the noisy-or of its sentences', one minus the product of their complements.  The weights are fitted
to document labels alone by mini-batch Adagrad on that likelihood, so the sentences that explain a
toxic label are found on the way and can be located afterwards.

The model is fitted on at most TOXIC_ROWS toxic and CLEAN_ROWS other labelled documents, those with the
least hash of their id; whole texts, and never rows with ``crc32(id as text) mod 5 = 0``.  Every document
is scored, over its whole text.  Language, source and id are no inputs.

Edge cases: null or empty texts, and texts without a word, have no sentence and score 0; with no labels
or only one kind the score is the prior's; labels that are null or of unknown documents are passed over;
a very long text is scored by all its sentences; sentences of equal score are all located; repeated rows are scored alike; an empty table gives an empty result; columns beside id and text are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import slices, text_of, trim
from .shingles import batches, mix

#: The labelled documents that the fit uses at most.
TOXIC_ROWS, CLEAN_ROWS = 3000, 5000
#: Hashed features; bytes of a word's beginnings that are features beside the word; passes, documents of a step, rate.
WIDTH, BEGINNINGS, EPOCHS, STEP_DOCS, RATE = 1 << 18, (3, 4, 5, 6), 25, 200, 0.6
#: A feature counts if so many texts of the sample have it; pull of all weights to 0.
LEAST_TEXTS, DECAY = 5, 1e-5
#: Bytes that separate words (ASCII punctuation and white space), and those that end a sentence.
_BREAKS = b" \t\n\r\x0b\x0c!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_ENDS = b".!?\n"
_PLAIN = bytes(32 if b in _BREAKS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_STOP = bytes(1 if b in _ENDS else 0 for b in range(256))
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
#: A sentence's log-odds without evidence: low enough that thousands of plain sentences do not add up.
PRIOR = -11.0


class Bags:
    """The sentences of some texts: features, row by row a word; each word's sentence; each sentence's text and place."""

    def __init__(self, texts: list[bytes]) -> None:
        joined = b"\n".join(texts) + b"\n"
        plain = joined.translate(_PLAIN) + b" " * 8
        inside = np.concatenate(([False], np.frombuffer(plain, np.uint8) != 32))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        eights = np.ndarray(len(plain) - 7, "<u8", plain, strides=(1,))
        lengths = ends - starts
        head = eights[starts]
        columns = []
        for k in BEGINNINGS:
            columns.append(mix((head & _MASKS[k]) ^ np.uint64(k << 56)))
        whole = mix(lengths.astype(np.uint64))
        live, at = np.arange(len(starts)), 0
        while len(live):
            whole[live] = mix(whole[live] ^ (eights[starts[live] + at] & _MASKS[np.minimum(lengths[live] - at, 8)]))
            at += 8
            live = live[lengths[live] > at]
        columns.append(whole)
        # a beginning that is no shorter than its word is the word: the weight of slot 0 is held at 0
        self.features = np.stack([np.where(lengths > k, c % np.uint64(WIDTH - 1) + np.uint64(1), np.uint64(0)) for k, c in zip((*BEGINNINGS, 0), columns, strict=True)], axis=1).astype(np.int32)
        stops = np.flatnonzero(np.frombuffer(joined.translate(_STOP), np.uint8))
        place = np.searchsorted(stops, starts)
        _, first = np.unique(place.astype(np.int64) * WIDTH + self.features[:, -1], return_index=True)  # a word counts once a sentence
        self.features, place = self.features[first], place[first]
        kept, self.sentence = np.unique(place, return_inverse=True)
        bounds = np.cumsum([len(t) + 1 for t in texts])
        begin = np.concatenate(([0], stops[:-1] + 1)) if len(stops) else stops
        self.begin, self.end = begin[kept] if len(kept) else kept, stops[kept] if len(kept) else kept
        self.text = np.searchsorted(bounds, self.end, "right") if len(kept) else kept
        self.text = np.minimum(self.text, len(texts) - 1)
        self.offset, self.n, self.joined = np.concatenate(([0], bounds[:-1])), len(texts), joined

    def logits(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.sentence, weights[self.features].sum(axis=1), len(self.end)) + bias


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))


def scores(bags: Bags, z: np.ndarray) -> np.ndarray:
    """Noisy-or of each text's sentences; 0 without any."""
    return -np.expm1(-np.bincount(bags.text, _softplus(z), bags.n))


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias that explain the labels."""
    weights, bias = np.zeros(WIDTH, np.float32), PRIOR
    if len(set(labels)) < 2:
        return weights, bias
    seen, seen_bias = np.full(WIDTH, 1e-6), 1.0
    y = np.asarray(labels)
    turns = np.random.default_rng(5).permutation(len(y))
    parts = [turns[k : k + STEP_DOCS] for k in range(0, len(y), STEP_DOCS)]
    made = [(Bags([texts[k] for k in p]), y[p]) for p in parts]
    spread_over = np.zeros(WIDTH, np.int32)  # texts that have a feature
    for bags, _ in made:
        pairs = np.unique(bags.text[bags.sentence].astype(np.int64)[:, None] * WIDTH + bags.features)
        spread_over += np.bincount(pairs % WIDTH, minlength=WIDTH).astype(np.int32)
    common = spread_over >= LEAST_TEXTS
    common[0] = False
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(made)):
            bags, want = made[k]
            z = bags.logits(weights, bias)
            spread = np.bincount(bags.text, _softplus(z), bags.n)
            pull = np.where(want == 1, -1 / np.maximum(np.expm1(np.minimum(spread, 50)), 1e-9), 1.0)
            slope = np.clip(pull[bags.text] / (1 + np.exp(-np.maximum(z, -50))), -1, 1)
            per_word = np.repeat(slope[bags.sentence], bags.features.shape[1])
            grad = np.bincount(bags.features.ravel(), per_word, WIDTH) / len(want) + DECAY * weights
            grad *= common
            seen += grad * grad
            weights -= (RATE * grad / np.sqrt(seen)).astype(np.float32)
            step = slope.sum() / len(want)
            seen_bias += step * step
            bias -= 0.05 * step / np.sqrt(seen_bias)
    return weights, float(bias)


def _train(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts, labels = [], []
    for b in batches_in:
        texts += [x or b"" for x in b.column(0).cast(pa.binary()).to_pylist()]
        labels += b.column(1).to_pylist()
    weights, bias = fit(texts, labels)
    del texts
    trim()
    yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([bias])], ["weights", "bias"])


def _apply(packed: bytes, bias: float):
    def run(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.frombuffer(packed, np.float32)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in slices(batches_in):
            texts = [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]
            found, marks = [np.zeros(0)], []
            for _, some in batches(texts):
                bags = Bags(some)
                z = bags.logits(weights, bias)
                own = scores(bags, z)
                found.append(own)
                marks += [[] for _ in some]
                p = 1 / (1 + np.exp(-z))
                for k in np.flatnonzero((own[bags.text] >= 0.5) & (p >= 0.1)):
                    t, o = bags.text[k], bags.offset[bags.text[k]]
                    a = len(bags.joined[o : bags.begin[k]].decode("utf8", "replace"))
                    marks[len(marks) - len(some) + t].append({"start": a, "end": a + len(bags.joined[bags.begin[k] : bags.end[k]].decode("utf8", "replace")), "score": float(p[k])})
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(found)), pa.array(marks, kind), *batch.columns[2:]], ["_id", "score", "sentences", *batch.schema.names[2:]])

    return run


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_model(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "toxic") -> tuple[bytes, float]:
    """The model from a bounded sample of labelled documents, fitted by one task: (weights, bias)."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label).cast("int").alias("_label"))
    some = lambda y, n: known.where(F.col("_label") == y).orderBy(F.xxhash64(id_col), id_col).limit(n)
    sample = some(1, TOXIC_ROWS).unionByName(some(0, CLEAN_ROWS))
    # TOXIC_ROWS + CLEAN_ROWS rows at most
    rows = docs.select(id_col, text_of(text).alias("_text")).join(F.broadcast(sample), id_col).dropDuplicates([id_col])
    rows = rows.repartition(1).sortWithinPartitions(F.xxhash64(id_col), id_col).select("_text", "_label")
    out = rows.mapInArrow(_train, "weights binary, bias double").first()
    return (bytes(out["weights"]), out["bias"]) if out else (np.zeros(WIDTH, np.float32).tobytes(), PRIOR)


def score_documents(docs: DataFrame, model: tuple[bytes, float], text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, score, and the offending sentences (start, end in code points; score) of those at 0.5 or more."""
    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col), text_of(text).alias("_text")).mapInArrow(_apply(*model), f"_id {kind}, score double, sentences array<struct<start int, end int, score double>>")
    return out.withColumnRenamed("_id", id_col)


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    model = fit_model(docs, labels, text, id_col)
    names, weights = docs.columns, model

    def keep(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.frombuffer(weights[0], np.float32)
        for batch in slices(batches_in):
            texts = [x or b"" for x in batch.column(names.index(text)).cast(pa.binary()).to_pylist()]
            found = [np.zeros(0)]
            for _, some in batches(texts):
                bags = Bags(some)
                found.append(scores(bags, bags.logits(w, weights[1])))
            yield batch.filter(pa.array(np.concatenate(found) < threshold))

    return docs.mapInArrow(keep, docs.schema)


def op10_multiple_instance_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score_documents(docs, fit_model(docs, labels))
    spans = F.array_join(F.transform("sentences", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), spans.alias("sentences"))
