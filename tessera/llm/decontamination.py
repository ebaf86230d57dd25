"""Benchmark decontamination by latent semantic retrieval.

Words are hashed to WIDTH dimensions and weighted by inverse document frequency over all documents.
Benchmark items are cut to passages; a randomised SVD of their TF-IDF matrix gives the latent space: each
partition of the benchmark adds its share of A'(A Q), the shares are summed by slices, and the driver
orthonormalises a matrix whose size depends on WIDTH and the rank, not on the rows.  Every passage of
every document is then projected, and its cosine taken in that space with every passage of every item, and
with every item as a whole, in blocks.
A passage near an item is checked: the longest common subsequence of words, against the stretch of the
document around the passage, must cover nearly all of the item, or enough of it and of its answer, its
last sentence.  In the latent space each passage of an item is looked for by its KEPT_WORDS rarest words,
whatever their frequency; other words weigh nothing.  What its words, its rank or the least cosine leave out
is found by an exact way (``Rest``): a stretch that passes holds COVER of an item's words, so one at least of
its rarest; texts that have one are compared by their counts of the item's words, and those with enough are
checked around every passage.  So the pairs found are those that a check around every passage of every
document against every item finds, whatever the size of the corpus.

A document is contaminated by an item that passes.  Words are runs of characters other than ASCII white
space, A-Z lower-cased, so that rewrapped lines and case do not matter, nor do inserted, dropped or
replaced words as long as the common subsequence holds.

Edge cases: null or empty texts are never contaminated; null or empty items match nothing; an empty
benchmark or table gives an empty result (a filter then keeps all); an item of a word or two is found wherever its words are; items with equal texts are each
reported, and of equal cosines the earlier passage is checked first; a very long text is searched whole, TAKEN passages at a time;
repeated rows are judged alike; columns beside id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import slices, text_of, written
from .shingles import batches, words_of

#: Dimensions of hashed words; words of a passage and its step; rank of the latent space, and columns beyond it.
WIDTH, PASSAGE, STEP, RANK, EXTRA = 1 << 18, 32, 16, 256, 16
#: So many of an item passage's rarest words have weight; a passage needs so many words with weight.
KEPT_WORDS, LEAST_HITS = 10, 3
#: Least cosine of a candidate; least part of an item that the common subsequence covers, alone or with so much of the answer.
COSINE, ALONE, COVER, ANSWER = 0.5, 0.85, 0.7, 0.5
#: Items' passages compared at once, and passages of a text compared with them at once; slices in which sums are made.
ITEM_BLOCK, TAKEN, SLICES = 2048, 4096, 64
#: Entries of lists of texts, items and words that are held at once.
ENTRIES = 1 << 20


class Words:
    """The words of some texts, with each text's first and end."""

    def __init__(self, texts: list[bytes]) -> None:
        joined = b"\n".join(texts) + b"\n"
        self.starts, self.ends, self.prints = words_of(joined)
        self.dims = (self.prints >> np.uint64(20)).astype(np.int64) & (WIDTH - 1)
        bounds = np.cumsum([len(t) + 1 for t in texts])
        self.cuts = np.concatenate(([0], np.searchsorted(self.starts, bounds)))
        self.joined = joined

    def passages(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, end and text of each passage: every STEP words, the last of a text ends with it."""
        n = np.diff(self.cuts)
        count = np.where(n > 0, 1 + np.maximum(0, -(-(n - PASSAGE) // STEP)), 0)
        text = np.repeat(np.arange(len(n)), count)
        k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        first = np.minimum(self.cuts[text] + k * STEP, np.maximum(self.cuts[text + 1] - PASSAGE, self.cuts[text]))
        return first, np.minimum(first + PASSAGE, self.cuts[text + 1]), text


def _plain(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _add_up(parts: DataFrame, size: int) -> np.ndarray:
    """parts: slice, data (float64).  The sum of the arrays by slice, joined: ``size`` numbers whatever the rows."""

    def total(table: pa.Table) -> pa.Table:
        out = sum(np.frombuffer(x, np.float64) for x in table["data"].to_pylist())
        return pa.table({"slice": table["slice"][:1], "data": pa.array([out.tobytes()], pa.binary())})

    rows = parts.groupBy("slice").applyInArrow(total, "slice int, data binary").collect()
    out = np.zeros((SLICES, size // SLICES))
    for r in rows:
        out[r["slice"]] = np.frombuffer(r["data"], np.float64)
    return out.ravel()


def _emit(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k, part in enumerate(np.split(total.ravel(), SLICES)):
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["slice", "data"])


def document_frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """In how many documents each dimension's words occur; the last number but SLICES - 1 is that of documents with words."""

    def count(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(WIDTH + SLICES)
        for batch in slices(batches_in):
            for _, some in batches(_plain(batch.column(0))):
                w = Words(some)
                owner = np.repeat(np.arange(len(some)), np.diff(w.cuts))
                keys = np.sort(owner * WIDTH + w.dims)
                keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
                total[:WIDTH] += np.bincount(keys & (WIDTH - 1), minlength=WIDTH)
                total[WIDTH] += (np.diff(w.cuts) > 0).sum()
        yield from _emit(total)

    return _add_up(docs.select(text_of(text)).mapInArrow(count, "slice int, data binary"), WIDTH + SLICES)


def inverse_frequencies(found: np.ndarray) -> np.ndarray:
    return np.log((1 + found[WIDTH]) / (1 + found[:WIDTH])).astype(np.float32) + np.float32(0.05)


def only(idf: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """The weights with 0 for all but the kept words."""
    out = np.zeros_like(idf)
    out[kept] = idf[kept]
    return out


def _sparse(texts: list[bytes], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The passages' TF-IDF rows: row, dimension, weight (rows of unit length)."""
    w = Words(texts)
    first, end, _ = w.passages()
    row = np.repeat(np.arange(len(first)), end - first)
    at = np.arange(len(row)) - np.repeat(np.cumsum(end - first) - (end - first), end - first) + np.repeat(first, end - first)
    dims = w.dims[at]
    weight = idf[dims].astype(np.float64)
    norm = np.sqrt(np.bincount(row, weight**2, len(first)))
    return row, dims, weight / np.maximum(norm[row], 1e-30)


def kept_words(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    """The dimensions of the rarest words of each text's passages."""
    w = Words(texts)
    first, end, _ = w.passages()
    owner = np.repeat(np.arange(len(first)), end - first)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(end - first) - (end - first), end - first) + np.repeat(first, end - first)
    keys = np.unique(owner * WIDTH + w.dims[at])
    order = np.lexsort((-idf[keys % WIDTH], keys // WIDTH))
    keys = keys[order]
    rank = np.arange(len(keys)) - np.searchsorted(keys // WIDTH, keys // WIDTH)
    return np.unique(keys[rank < KEPT_WORDS] % WIDTH)


def latent_space(items: DataFrame, idf: np.ndarray, text: str = "text", rank: int = RANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The weights of all dimensions, those with weight that occur in items, and an orthonormal basis (a row for each) of the leading latent space."""

    def used(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(WIDTH)
        for batch in batches_in:
            texts = _plain(batch.column(0))
            dims = Words(texts).dims
            total += np.bincount(dims, minlength=WIDTH)
            total[kept_words(texts, idf)] += 1 << 40
        yield from _emit(total)

    texts = items.select(text_of(text))
    seen = _add_up(texts.mapInArrow(used, "slice int, data binary"), WIDTH)
    idf = only(idf, np.flatnonzero(seen >= 1 << 40))
    dims = np.flatnonzero((seen > 0) & (idf > 0))
    k = min(rank + EXTRA, len(dims))
    if not k:
        return idf, dims, np.zeros((0, 0), np.float32)
    place = np.zeros(WIDTH, np.int64)
    place[dims] = np.arange(len(dims))

    def gram(basis: np.ndarray, outer: bool) -> np.ndarray:
        """A'(A Q), or (A Q)'(A Q) with outer."""
        shape = (basis.shape[1] if outer else len(dims), basis.shape[1])
        padded = -(-shape[0] * shape[1] // SLICES) * SLICES

        def share(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches_in:
                row, dim, weight = _sparse(_plain(batch.column(0)), idf)
                row, dim, weight = row[weight > 0], place[dim[weight > 0]], weight[weight > 0]
                z = np.zeros((int(row[-1]) + 1 if len(row) else 0, basis.shape[1]))
                np.add.at(z, row, weight[:, None] * basis[dim])
                if outer:
                    total += z.T @ z
                else:
                    np.add.at(total, dim, weight[:, None] * z[row])
            yield from _emit(np.pad(total.ravel(), (0, padded - total.size)))

        return _add_up(texts.mapInArrow(share, "slice int, data binary"), padded)[: shape[0] * shape[1]].reshape(shape)

    basis = np.random.default_rng(11).standard_normal((len(dims), k))
    for _ in range(2):  # a random start and one power step
        basis = np.linalg.qr(gram(basis, False))[0]
    values, turn = np.linalg.eigh(gram(basis, True))
    lead = np.argsort(-values)[: min(rank, k)]
    lead = lead[values[lead] > 1e-9 * max(values.max(), 1e-30)]
    return idf, dims, (basis @ turn[:, lead]).astype(np.float32)


class Item:
    """A benchmark item ready for the longest common subsequence by bits."""

    def __init__(self, item_id, text: bytes) -> None:
        w = Words([text])
        self.id, self.words = item_id, w.prints.tolist()
        stops = [k for k, e in enumerate(w.ends[:-1]) if w.joined[e - 1 : e] in (b".", b"!", b"?")]
        self.answer = self.words[stops[-1] + 1 :] if stops else self.words

    @staticmethod
    def passes(cover: float, answer: float) -> bool:
        return cover >= ALONE or cover >= COVER and answer >= ANSWER

    @staticmethod
    def common(pattern: list[int], words: list[int]) -> int:
        masks: dict[int, int] = {}
        for k, w in enumerate(pattern):
            masks[w] = masks.get(w, 0) | 1 << k
        full = row = (1 << len(pattern)) - 1
        for w in words:
            if m := masks.get(w):
                u = row & m
                row = ((row + u) | (row - u)) & full
        return len(pattern) - row.bit_count()

    def check(self, words: list[int]) -> tuple[float, float]:
        """Covered parts of the item and of its answer."""
        cover = self.common(self.words, words) / len(self.words)
        return cover, self.common(self.answer, words) / len(self.answer) if cover >= COVER else 0.0


def _runs(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of neighbours whose sizes come to about ENTRIES."""
    ends, first = np.cumsum(sizes), 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + ENTRIES, "right")))
        yield slice(first, last)
        first = last


def _spread(cuts: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the keys' lists, and for each the number of its key in ``keys``."""
    n = cuts[keys + 1] - cuts[keys]
    owner = np.repeat(np.arange(len(keys)), n)
    return np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + cuts[keys][owner], owner


class Rest:
    """Which items may be in which texts, by words alone: no pair that passes the check is left out.

    A stretch that passes holds at least ``need`` of an item's n words, so one at least of any n - need + 1 of
    them: each item is listed under its rarest.
    """

    def __init__(self, items: list[Item], idf: np.ndarray) -> None:
        sizes = np.array([len(i.words) for i in items], np.int64)
        item = np.repeat(np.arange(len(items)), sizes)
        self.words, word = np.unique(np.array([x for i in items for x in i.words], np.uint64), return_inverse=True)
        dims = (self.words >> np.uint64(20)).astype(np.int64) & (WIDTH - 1)
        self.dims = np.zeros(WIDTH, bool)
        self.dims[dims] = True
        self.need = np.ceil(COVER * sizes - 1e-6).astype(np.int64)
        order = np.lexsort((word, -idf[dims[word]], item))
        rank = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        taken = rank < (sizes - self.need + 1)[item]
        listed = np.unique(word[order[taken]] * len(items) + item[taken])
        self.listed, self.list_cuts = listed % len(items), np.searchsorted(listed, np.arange(len(self.words) + 1) * len(items))
        own, self.times = np.unique(item * len(self.words) + word, return_counts=True)
        self.own, self.own_cuts = own % len(self.words), np.searchsorted(own, np.arange(len(items) + 1) * len(self.words))
        self.rare = np.isin(own, listed % len(items) * len(self.words) + listed // len(items))

    def known(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """The words of the texts that items have: place and number."""
        at = np.flatnonzero(self.dims[w.dims])
        word = np.minimum(np.searchsorted(self.words, w.prints[at]), len(self.words) - 1)
        same = self.words[word] == w.prints[at]
        return at[same], word[same]

    def pairs(self, w: Words, at: np.ndarray, word: np.ndarray) -> Iterator[tuple[int, int]]:
        """The texts and items that share a listed word and words enough, each as often as both have it."""
        size, items = len(self.words), len(self.need)
        keys, times = np.unique((np.searchsorted(w.cuts, at, "right") - 1) * size + word, return_counts=True)
        listing = np.flatnonzero(np.diff(self.list_cuts)[keys % size])
        text = keys[listing] // size
        edges = np.flatnonzero(np.diff(text, prepend=-1))
        lists = np.diff(self.list_cuts)[keys[listing] % size]
        for run in _runs(np.add.reduceat(lists, edges) if len(edges) else edges):  # whole texts
            some = slice(edges[run.start], edges[run.stop] if run.stop < len(edges) else len(text))
            place, owner = _spread(self.list_cuts, keys[listing[some]] % size)
            pair = np.unique(text[some][owner] * items + self.listed[place])
            pair = pair[np.diff(w.cuts)[pair // items] >= self.need[pair % items]]
            for part in _runs(np.diff(self.own_cuts)[pair % items]):
                t, i = np.divmod(pair[part], items)
                place, owner = _spread(self.own_cuts, i)
                want = t[owner] * size + self.own[place]
                found = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
                shared = np.where(keys[found] == want, np.minimum(times[found], self.times[place]), 0)
                enough = np.bincount(owner, shared, len(t)) >= self.need[i]
                yield from zip(t[enough].tolist(), i[enough].tolist(), strict=True)

    def stretches(self, i: int, at: np.ndarray, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Of the stretches of a text, both ends ascending, those with words enough and a listed one that no other holds: number, and places of the item's words."""
        own = slice(self.own_cuts[i], self.own_cuts[i + 1])
        k = np.minimum(np.searchsorted(self.own[own], word), own.stop - own.start - 1)
        mine = self.own[own][k] == word
        at, rare = at[mine], np.concatenate(([0], np.cumsum(self.rare[own][k[mine]])))
        first, last = np.searchsorted(at, low), np.searchsorted(at, high)
        live = np.flatnonzero((last - first >= self.need[i]) & (rare[last] > rare[first]))
        live = live[np.concatenate(([True], (np.diff(first[live]) > 0) | (np.diff(last[live]) > 0)))[: len(live)]]
        first, last = first[live], last[live]
        inner = np.zeros(len(live), bool)
        inner[:-1] |= first[:-1] == first[1:]
        inner[1:] |= last[1:] == last[:-1]
        for n, a, b in zip(live[~inner], first[~inner], last[~inner], strict=True):
            yield int(n), at[a:b]


def _search(items: list[tuple], weights: np.ndarray, idf: np.ndarray, dims: np.ndarray, basis: np.ndarray, cosine: float):
    """weights: of all words; idf: in the latent space."""
    known = [Item(i, t) for i, t in items]
    rest = Rest(known, weights)
    place = np.full(WIDTH, -1, np.int32)
    place[dims] = np.arange(len(dims))

    def project(w: Words, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The stretches with LEAST_HITS words in the space, or with all their words there, and their directions."""
        if not len(first):
            return np.zeros(0, np.int64), np.zeros((0, basis.shape[1]), np.float32)
        low = int(first.min())
        first, end, used = first - low, end - low, w.dims[low : int(end.max())]
        at = place[used]
        hit = np.flatnonzero(at >= 0)
        seen = np.concatenate(([0], np.cumsum(at >= 0)))
        hits = seen[end] - seen[first]
        live = np.flatnonzero((hits > 0) & (hits >= np.minimum(LEAST_HITS, end - first)))
        sums = np.zeros((len(hit) + 1, basis.shape[1]), np.float32)
        np.cumsum(idf[used[hit], None] * basis[at[hit]], axis=0, out=sums[1:])
        rows = sums[seen[end[live]]] - sums[seen[first[live]]]
        return live, rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)

    whole = Words([t for _, t in items])
    first_of, end_of, item_of = whole.passages()
    long = np.flatnonzero(np.diff(whole.cuts) > PASSAGE)  # other items are one passage
    first_of, end_of, item_of = np.concatenate((first_of, whole.cuts[long])), np.concatenate((end_of, whole.cuts[long + 1])), np.concatenate((item_of, long))
    live_items, rows = project(whole, first_of, end_of)
    item_of, targets = item_of[live_items], np.ascontiguousarray(rows.T)

    def left(w: Words, first: np.ndarray, end: np.ndarray, text: np.ndarray, met: set[tuple[int, int]]) -> Iterator[tuple]:
        """Text, item, cosine and covers of the pairs that pass and are not among those met."""
        at, word = rest.known(w)
        for t, i in rest.pairs(w, at, word):
            if (t, i) in met:
                continue
            item, found = known[i], None
            reach = len(item.words) + len(item.words) // 4
            own, some = slice(*np.searchsorted(text, (t, t + 1))), slice(*np.searchsorted(at, w.cuts[t : t + 2]))
            low, high = np.maximum(w.cuts[t], first[own] - reach), np.minimum(w.cuts[t + 1], end[own] + reach)
            for n, places in rest.stretches(i, at[some], word[some], low, high):
                cover, answer = item.check(w.prints[places].tolist())  # other words change nothing
                if item.passes(cover, answer) and (not found or (cover, answer) > found[:2]):
                    found = (cover, answer, low[n], high[n])
            if found:
                inside = (first >= found[2]) & (end <= found[3])
                near = project(w, first[inside], end[inside])[1] @ targets[:, item_of == i]
                yield t, i, float(near.max()) if near.size else 0.0, *found[:2]

    def run(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches_in):
            ids = batch.column(0)
            out: list[tuple] = []
            for base, some in batches(_plain(batch.column(1))):
                w = Words(some)
                first, end, text = w.passages()
                if not len(first):
                    continue
                best: dict[tuple[int, int], list] = {}
                met: set[tuple[int, int]] = set()
                for p0 in range(0, len(first), TAKEN):
                    live, rows = project(w, first[p0 : p0 + TAKEN], end[p0 : p0 + TAKEN])
                    live += p0
                    for block in range(0, targets.shape[1], ITEM_BLOCK):
                        near = rows @ targets[:, block : block + ITEM_BLOCK]
                        for p, i in np.argwhere(near >= cosine):
                            k = live[p]
                            best.setdefault((int(text[k]), int(item_of[block + i])), []).append((-float(near[p, i]), int(first[k]), int(end[k])))
                for (t, i), places in best.items():
                    item, found = known[i], None
                    for score, a, b in sorted(places):
                        if found and a < found[4] and b > found[3]:
                            continue  # inside the stretch that was checked
                        reach = len(item.words) + len(item.words) // 4  # any place of the item that meets the passage
                        lo, hi = max(int(w.cuts[t]), a - reach), min(int(w.cuts[t + 1]), b + reach)
                        cover, answer = item.check(w.prints[lo:hi].tolist())
                        if not found or cover > found[1]:
                            found = (-score, cover, answer, lo, hi)
                        if item.passes(cover, answer):
                            break
                    if item.passes(*found[1:3]):
                        met.add((t, i))
                        out.append((base + t, item.id, *found[:3]))
                out += [(base + t, known[i].id, *values) for t, i, *values in left(w, first, end, text, met)]
            yield pa.RecordBatch.from_arrays(
                [ids.take(at := pa.array([o[0] for o in out], pa.int64())), batch.column(2).take(at), pa.array([o[1] for o in out], pa.int64()), *(pa.array([o[k] for o in out], pa.float64()) for k in (2, 3, 4))],
                ["doc_id", "hash", "item_id", "cosine", "cover", "answer_cover"],
            )

    return run


def _found(docs: DataFrame, items: DataFrame, text: str, id_col: str, item_id: str, cosine: float) -> DataFrame:
    """A row for each document and item found in it: doc_id, hash (of the text), item_id, cosine (0 without a direction), cover and answer_cover."""
    items = items.select(F.col(item_id).cast("long").alias("item_id"), text_of(text).alias("text"))
    weights = inverse_frequencies(document_frequencies(docs, text))
    idf, dims, basis = latent_space(items, weights)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text).alias("text"), F.xxhash64(text_of(text)).alias("hash"))
    kind = "doc_id long, hash long, item_id long, cosine double, cover double, answer_cover double"
    out, block, held = None, [], 0
    # the stated queries: blocks of items against all documents
    for r in items.orderBy("item_id").toLocalIterator():
        if r["text"].strip(" \t\n\r\x0b\x0c"):
            block.append((r["item_id"], r["text"].encode()))
            held += 2 + len(r["text"].split()) // STEP  # its passages, and the whole
        if held >= 8 * ITEM_BLOCK:
            part = slim.mapInArrow(_search(block, weights, idf, dims, basis, cosine), kind)
            out, block, held = part if out is None else out.unionByName(part), [], 0
    if block or out is None:
        part = slim.mapInArrow(_search(block, weights, idf, dims, basis, cosine), kind) if block else slim.sparkSession.createDataFrame([], kind)
        out = part if out is None else out.unionByName(part)
    return out


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", item_id: str = "item_id", cosine: float = COSINE) -> DataFrame:
    """A row for each document and item found in it: its id, item_id, cosine, cover and answer_cover."""
    return _found(docs, items, text, id_col, item_id, cosine).drop("hash").withColumnRenamed("doc_id", id_col)


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", item_id: str = "item_id", cosine: float = COSINE) -> DataFrame:
    """The documents that no item was found in, with all their columns.  Rows of one id are judged each by its own text; rows without an id too."""
    found = written(_found(docs, items, text, id_col, item_id, cosine).select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).distinct())
    # packed, so that no column of the documents can clash with those used here
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text_of(text)).alias("hash"))
    return packed.join(found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")), "left_anti").select("row.*")


def op6_latent_decontamination(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(docs, items)
