"""Near-duplicate classes: the Jaccard join of word-shingle sets, by signature trees.

1. A first pass over the texts counts the shingles that many sets have; a second makes each set's hash,
   size, bitmap and prefix.  Two sets that reach the threshold share one of their (1 - threshold) n + 1
   first shingles in any one order, so only these are indexed.  The order is by hash, but the frequent
   shingles come last: a passage that many documents share is in the prefix of those only that have little
   else.  Which shingles count as frequent changes what is compared, never what is found.
2. Equal sets are one class from here on, so copies cost nothing more.
3. The index groups sets by shared prefix shingle.  Small groups give pairs, which their bitmaps
   filter; in large groups signature trees are traversed (see signature_tree), in blocks of BLOCK sets
   so that no task gets more than two.  What neither can exclude joins two sets to one cluster: a
   spanning forest of such pairs is enough, since no link between two clusters is possible.
4. Each cluster's whole sets meet, again in blocks, where a traversal of their trees with the exact
   test joins them to components.

No pair is sampled or capped: a pair is passed over only if a bound excludes it or a path of exact
links joins its sets already.

Words are runs of characters other than ASCII white space, A-Z lower-cased.  Edge cases: a text with
fewer words than a shingle has its whole sequence as its only shingle; without words, or null, it has
none and is linked with nothing; a very long text has all its shingles in one set, in the memory of one task; an empty table
gives an empty result; repeated rows count as documents of one id; rows with a null id are classed, and a
class takes the least id that is not null; of equal similarities none is preferred, as all links count;
columns beside id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import attach, components
from .runtime import HASHED_BITS, discard, hashed_bits, marked, slices, text_of, trim, written
from .shingles import mix, shingle_set, word_prints
from .signature_tree import Forest, Tree, linked_pairs, signature

WORDS, PERCENT = 5, 80
#: Index entries of a bucket on average at most; groups up to PAIRED sets give pairs; sets of a block of the candidates' step, and of the exact one.
BUCKET_ENTRIES, PAIRED, BLOCK, WHOLE = 600_000, 32, 1024, 2048
#: Frequent shingles: sets of a task that must have one to be counted, of all; how many at most; shingles counted at once.
SEEN, HOT, FREQUENT, CHUNK = 2, 12, 1 << 20, 1 << 20
#: The bits of a shingle that its group's entries keep.
LOW = (1 << 40) - 1
#: Rows and bytes of sets that are traversed in one call on average, and such calls at least.
SLOT_ROWS, SLOT_BYTES, SLOTS = 500, 4 << 20, 64


def _bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def set_hash(tokens: np.ndarray) -> int:
    """A hash of a set (its order does not matter); 0 for the empty set."""
    if not len(tokens):
        return 0
    with np.errstate(over="ignore"):
        total = mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(tokens))
        return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


def _common(words: int):
    """The shingles that SEEN sets or more of some CHUNK shingles have, and how many; equal sets of a task count once."""

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
        many = n >= SEEN
        return pa.RecordBatch.from_arrays([pa.array(found[many].view(np.int64)), pa.array(n[many])], ["token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held, size = set(), [], 0
        for batch in slices(batches):
            for prints in word_prints(_bytes(batch.column(0))):
                s = shingle_set(prints, words)
                if (h := set_hash(s)) not in seen:
                    seen.add(h)
                    held.append(s)
                    size += len(s)
                if size > CHUNK:
                    yield counted(held)
                    held, size = [], 0
        yield counted(held)

    return run


def frequent(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles (in order) that HOT sets or more have, and their counts: FREQUENT at most, the most frequent ones."""
    found = written(texts.mapInArrow(_common(words), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= HOT))
    sizes = {r["k"]: r["count"] for r in found.groupBy(F.floor(F.log2("n")).alias("k")).count().collect()}  # a row a power of two
    least, held = 63, 0
    while least and held + sizes.get(least - 1, 0) <= FREQUENT:
        least -= 1
        held += sizes.get(least, 0)
    some = found.where(F.col("n") >= 1 << least).toArrow()
    discard(found)
    token = some["token"].to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], some["n"].to_numpy()[order]


def prefix(s: np.ndarray, k: int, hot: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """The k first shingles of a set (in order of hashes): those that are not hot, then the hot ones, rarest first.  And the head: the first hot one among them, else the first, as its low 40 bits."""
    head = s[0]
    if len(hot):
        at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
        is_hot = hot[at] == s
        if is_hot.any():
            last = s[is_hot]
            last, s = last[np.argsort(counts[at[is_hot]], kind="stable")], s[~is_hot]
            head = last[0] if len(s) < k else s[0]
            s = np.concatenate((s, last))
    return s[:k], int(head) & LOW


def _signatures(words: int, percent: int, hot: np.ndarray, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, sizes, bitmaps, prefixes, heads = [], [], [], [], []
            for prints in word_prints(_bytes(batch.column(1))):
                s = shingle_set(prints, words)
                hashes.append(set_hash(s))
                sizes.append(len(s))
                bitmaps.append(signature(s) if len(s) else b"")
                first, head = prefix(s, len(s) + (-percent * len(s)) // 100 + 1, hot, counts) if len(s) else (s, 0)
                prefixes.append(first.tobytes())
                heads.append(head)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(hashes, pa.int64()), pa.array(sizes, pa.int32()), pa.array(bitmaps, pa.binary()), pa.array(prefixes, pa.binary()), pa.array(heads, pa.int64())], ["id", "hash", "sid", "n", "bits", "prefix", "head"])

    return run


_CELLS = ["bucket", "low", "high", "place", "sids", "sizes", "head_low", "head_high"]


def _index(buckets: int):
    """Batches of (sid, n, prefix, head) to one row a bucket of the shingles' hashes, with the entries as bytes.

    An entry is the low 40 bits of a shingle and the place of its set among those of the row.  Shingles that agree in these bits and the
    bucket only make candidates of sets that the bitmaps then exclude.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trim()
            sids, first = np.unique(batch.column(0).to_numpy(), return_index=True)
            if not len(sids):
                continue
            n = batch.column(1).to_numpy()[first]
            blobs = batch.column(2)
            runs = [np.frombuffer(blobs[int(k)].as_py(), np.uint64) for k in first]
            tokens = np.concatenate(runs)
            heads = batch.column(3).to_numpy()[first].view(np.uint64)
            owner = np.repeat(np.arange(len(sids), dtype=np.int32), [len(r) for r in runs])
            place = (tokens >> np.uint64(40)).astype(np.int64) * buckets >> 24
            order = np.argsort(place, kind="stable")
            found, start = np.unique(place[order], return_index=True)
            parts = np.split(order, start[1:])
            cells = []
            for p in parts if len(found) else []:
                named, local = np.unique(owner[p], return_inverse=True)
                low = tokens[p]
                cells.append((low.astype(np.uint32).tobytes(), (low >> np.uint64(32)).astype(np.uint8).tobytes(), local.astype(np.int32 if len(named) > 65535 else np.uint16).tobytes(), sids[named].tobytes(), n[named].tobytes(), heads[named].astype(np.uint32).tobytes(), (heads[named] >> np.uint64(32)).astype(np.uint8).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), *(pa.array([c[k] for c in cells], pa.binary()) for k in range(7))], _CELLS)

    return run


def _joined40(low: bytes, high: bytes) -> np.ndarray:
    return np.frombuffer(low, np.uint32) | np.frombuffer(high, np.uint8).astype(np.uint64) << np.uint64(32)


def _entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A bucket's entries: shingle, set, its size and its head."""
    out = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint64))]
    for low, high, place, sids, sizes, head_low, head_high in zip(*(table[c].to_pylist() for c in _CELLS[1:]), strict=True):
        tokens = _joined40(low, high)
        at = np.frombuffer(place, np.uint16 if len(place) == 2 * len(tokens) else np.int32)
        out.append((tokens, np.frombuffer(sids, np.int64)[at], np.frombuffer(sizes, np.int32)[at], _joined40(head_low, head_high)[at]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _groups(percent: int):
    """A bucket of the index to pairs of sets (a, b; small groups) and to blocks of sets to traverse (block, side, a; large ones).

    Two sets with one head are both in the head's group and meet there, so in all other groups only sets with
    different heads meet.  So the near copies of one text, which share nearly all of their prefixes, do not
    meet once for every shingle.  (Heads are compared by 40 bits.)
    """
    fields = [("block", pa.int64()), ("side", pa.int32()), ("a", pa.int64()), ("b", pa.int64())]

    def cut(at: np.ndarray) -> list[np.ndarray]:
        return [at[k : k + BLOCK] for k in range(0, len(at), BLOCK)]

    def run(table: pa.Table) -> pa.Table:
        trim()
        tokens, sids, sizes, heads = _entries(table)
        bucket = int(table["bucket"][0].as_py())
        order = np.lexsort((sids, sizes, tokens))
        tokens, sids, sizes, heads = tokens[order], sids[order], sizes[order], heads[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (sids[1:] != sids[:-1])  # a set in several batches counts once
        tokens, sids, sizes, heads = tokens[new], sids[new], sizes[new], heads[new]
        starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1]))) if len(tokens) else np.zeros(0, np.int64)
        counts = np.diff(np.concatenate((starts, [len(tokens)])))
        pairs = [np.zeros((0, 2), np.int64)]
        for m in range(2, PAIRED + 1):
            at = starts[counts == m]
            for i in range(m):
                for j in range(i + 1, m):
                    near = (100 * sizes[at + i].astype(np.int64) >= percent * sizes[at + j]) & ((heads[at + i] != heads[at + j]) | (heads[at + i] == tokens[at]))
                    x, y = sids[at[near] + i], sids[at[near] + j]
                    pairs.append(np.stack((np.minimum(x, y), np.maximum(x, y)), axis=1))
        pairs = np.unique(np.concatenate(pairs), axis=0)
        blocks, sides, members = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]

        def meet(token: int, key: int, parts: list[np.ndarray]) -> None:
            name = int(np.bitwise_xor(*mix(np.array([bucket << 40 | token, ~key & (1 << 64) - 1], np.uint64))).view(np.int64))
            for side, part in enumerate(parts):
                blocks.append(np.full(len(part), name))
                sides.append(np.full(len(part), side, np.int32))
                members.append(sids[part])

        for s, m in zip(starts[counts > PAIRED], counts[counts > PAIRED], strict=True):
            at, token = np.arange(s, s + m), int(tokens[s])
            own, often = np.unique(heads[s : s + m], return_counts=True)
            often[own == tokens[s]] = 0
            met = (heads[s : s + m] == own[often.argmax()]) & (often.max() > 1)
            rest, old = cut(at[~met]), cut(at[met])
            for i, x in enumerate(rest):
                for j, y in enumerate(rest[i:], i):
                    if 100 * int(sizes[x[-1]]) < percent * int(sizes[y[0]]):
                        break
                    meet(token, i << 31 | j, [x] if i == j else [x, y])
                for j, y in enumerate(old):
                    if 100 * int(sizes[x[-1]]) >= percent * int(sizes[y[0]]) and 100 * int(sizes[y[-1]]) >= percent * int(sizes[x[0]]):
                        meet(token, 1 << 62 | i << 31 | j, [x, y])
        blocks, sides, members = (np.concatenate(x) for x in (blocks, sides, members))
        k = len(pairs)
        columns = [
            pa.array(np.concatenate((np.zeros(k, np.int64), blocks)), mask=np.arange(k + len(blocks)) < k),
            pa.array(np.concatenate((np.zeros(k, np.int32), sides))),
            pa.array(np.concatenate((pairs[:, 0], members))),
            pa.array(np.concatenate((pairs[:, 1], np.zeros(len(blocks), np.int64)))),
        ]
        return pa.table(dict(zip((f[0] for f in fields), columns, strict=True)), schema=pa.schema(fields))

    return run


def _passing(percent: int):
    """Pairs (a, b, n_a, bits_a, n_b, bits_b) that the bitmaps cannot exclude."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(c).to_pylist() for c in (2, 4))
            bits_a, bits_b = (batch.column(c).to_pylist() for c in (3, 5))
            keep = []
            for n, x, m, y in zip(n_a, bits_a, n_b, bits_b, strict=True):
                p, q = int.from_bytes(x, "little"), int.from_bytes(y, "little")
                while len(x) != len(y):
                    half = max(len(x), len(y)) // 2
                    if len(x) > len(y):
                        p, x = (p >> (8 * half)) | (p & ((1 << (8 * half)) - 1)), x[:half]
                    else:
                        q, y = (q >> (8 * half)) | (q & ((1 << (8 * half)) - 1)), y[:half]
                keep.append((100 + percent) * (p ^ q).bit_count() <= (100 - percent) * (n + m))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _joined(percent: int, whole: bool):
    """A task's blocks of sets to pairs that join them; whole: the sets' tokens are there for the exact test."""

    def run(table: pa.Table) -> pa.Table:
        block, side, sid = (table[c].to_numpy() for c in ("block", "side", "sid"))
        data = table["data"].to_pylist()
        sizes = np.array([len(d) // 8 for d in data], np.int64) if whole else table["n"].to_numpy().astype(np.int64)
        order = np.lexsort((sid, side, block))
        edges = np.flatnonzero(np.concatenate(([True], block[order][1:] != block[order][:-1], [True]))) if len(order) else []
        out = []
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            own = order[s:e]
            names, first = np.unique(sid[own], return_index=True)
            row, part = own[first], side[own][first]
            sets = {}

            def tokens(k: int, row=row, sets=sets) -> np.ndarray:
                if k not in sets:
                    sets[k] = np.frombuffer(data[row[k]], np.uint64)
                return sets[k]

            def link(p: int, q: int, tokens=tokens) -> bool:
                x, y = tokens(p), tokens(q)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                return 100 * both >= percent * (len(x) + len(y) - both)

            forest = Forest(len(names))
            make = lambda ks, row=row: Tree(sizes[row[ks]], [signature(np.frombuffer(data[r], np.uint64)) if whole else data[r] for r in row[ks]])
            halves = [np.flatnonzero(part == k) for k in (0, 1)]
            if len(halves[1]):
                left, right = make(halves[0]), make(halves[1])
                found = linked_pairs(left, right, halves[0], halves[1], forest, link if whole else None, percent)
            else:
                tree = make(halves[0])
                found = linked_pairs(tree, tree, halves[0], halves[0], forest, link if whole else None, percent)
            out += [(int(names[p]), int(names[q])) for p, q in found]
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _sets(words: int, members: np.ndarray):
    """The whole sets of documents whose bit (of the last column) is set in ``members``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bit = batch.column(2).to_numpy()
            batch = batch.filter(pa.array(marked(bit, members)))
            found = [shingle_set(w, words) for w in word_prints(_bytes(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([set_hash(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], ["id", "sid", "data"])

    return run


def _classed(docs: DataFrame, text: str, id_col: str, words: int, percent: int) -> DataFrame:
    """A row for each document: id, hash of its text, n (shingles), class (a set's hash; of one component all have the same) and component (its least id)."""
    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text).alias("text"))
    hashed = slim.withColumn("hash", F.xxhash64("text"))
    rows = written(hashed.mapInArrow(_signatures(words, percent, *frequent(slim.select("text"), words)), "id long, hash long, sid long, n int, bits binary, prefix binary, head long"))
    total = rows.agg(F.count("*").alias("rows"), F.sum(F.octet_length("prefix")).alias("bytes")).first()
    buckets = max(1, math.ceil((total["bytes"] or 0) / 8 / BUCKET_ENTRIES))
    full = rows.where("n > 0")
    classes = written(full.groupBy("sid").agg(F.first("n").alias("n"), F.first("bits").alias("bits"), F.min("id").alias("least"), F.count("*").alias("copies")))

    index = full.select("sid", "n", "prefix", "head").mapInArrow(_index(buckets), "bucket int, low binary, high binary, place binary, sids binary, sizes binary, head_low binary, head_high binary")
    found = written(index.groupBy("bucket").applyInArrow(_groups(percent), "block long, side int, a long, b long"))
    bits = classes.select("sid", "n", "bits")
    one, two = (bits.select(F.col("sid").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}")) for x in "ab")
    pairs = found.where("block is null").select("a", "b").distinct().join(one, "a").join(two, "b").select("a", "b", "n_a", "bits_a", "n_b", "bits_b")
    near = pairs.mapInArrow(_passing(percent), "a long, b long")
    large = found.where("block is not null").select("block", "side", F.col("a").alias("sid"))
    members = large.join(bits.withColumnRenamed("bits", "data"), "sid")
    slots = max(SLOTS, math.ceil(total["rows"] / SLOT_ROWS))
    members = members.withColumn("slot", F.pmod("block", F.lit(slots)).cast("int"))
    near = near.unionByName(members.groupBy("slot").applyInArrow(_joined(percent, False), "a long, b long"))
    clusters = written(components(near))

    # whole sets of the classes in clusters, by blocks of each cluster
    sizes = clusters.groupBy("root").agg(F.ceil(F.count("*") / WHOLE).cast("int").alias("blocks"))
    take = clusters.join(sizes, "root").withColumnRenamed("node", "sid").join(classes.select("sid", "n", F.col("least").alias("id")), "sid")
    take = written(take.withColumn("bit", F.pmod(F.xxhash64("id"), F.lit(HASHED_BITS))))
    wanted = hashed_bits(take.select("bit"))
    weight = take.agg(F.sum(F.col("n").cast("long") * 8 * F.col("blocks"))).first()[0] or 0
    sets = slim.withColumn("bit", F.pmod(F.xxhash64("id"), F.lit(HASHED_BITS))).mapInArrow(_sets(words, wanted), "id long, sid long, data binary")
    sets = sets.join(take.select(F.col("id").alias("_id"), "sid", "root", "blocks"), "sid").where(F.col("id").eqNullSafe(F.col("_id")))
    mine = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    sets = sets.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    sets = sets.select("sid", "data", F.xxhash64("root", low, high).alias("block"), (F.col("mine") > F.col("other")).cast("int").alias("side"))
    sets = sets.withColumn("slot", F.pmod("block", F.lit(max(SLOTS, math.ceil(weight / SLOT_BYTES)))).cast("int"))
    links = sets.groupBy("slot").applyInArrow(_joined(percent, True), "a long, b long")
    linked = components(links)

    best = linked.join(classes.select(F.col("sid").alias("node"), "least"), "node").groupBy("root").agg(F.min("least").alias("component"))
    named = linked.join(best, "root").select(F.col("node").alias("sid"), F.col("root").alias("class"), "component")
    table = classes.select("sid", "least", "copies").join(named, "sid", "left").where("copies > 1 or component is not null")
    table = written(table.select("sid", F.coalesce("class", "sid").alias("class"), F.coalesce("component", "least").alias("component"), "copies"))
    out = attach(rows.select("id", "hash", "sid", "n"), table, "sid", "copies", total["rows"])
    return out.select("id", "hash", "n", F.coalesce("class", "sid").alias("class"), F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.col("id")).alias("component"))


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: id, n_shingles, component_id (the least id that links lead to)."""
    out = _classed(docs, text, id_col, words, percent)
    return out.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, text: str = "text", id_col: str = "doc_id", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents with one of each class: that of the least id, of several texts under it the one of the least hash.

    Rows of one id and text are one document, of one id and several texts several.  Rows without an id
    stay, as do texts without a word.
    """
    rows = _classed(docs, text, id_col, words, percent).where("id is not null")
    one = rows.where("n > 0").groupBy("class").agg(F.min(F.struct("id", "hash")).alias("d")).select("d.id", "d.hash")
    stay = one.unionByName(rows.where("n = 0").select("id", "hash").distinct())
    # packed, so that no column of the documents can clash with those used here
    packed = docs.where(F.col(id_col).isNotNull()).select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("id"), F.xxhash64(text_of(text)).alias("hash"))
    kept = packed.join(stay, ["id", "hash"], "left_semi").dropDuplicates(["id", "hash"]).select("row.*")
    return kept.unionByName(docs.where(F.col(id_col).isNull()))


#: The same rows by an inverted index of all shingles, for small tables.
OP5_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
d AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(id, place) AS (SELECT DISTINCT a, a FROM d UNION SELECT r.id, d.b FROM r JOIN d ON r.place = d.a),
c AS (SELECT id, min(place) AS component FROM r GROUP BY id)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, coalesce(c.component, n.doc_id) AS component_id FROM n LEFT JOIN c ON c.id = n.doc_id
"""


def op5_signature_tree_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
