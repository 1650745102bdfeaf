"""Problem 7: evaluation texts leaking into training text, by latent semantic retrieval.

The evaluation items are the query side; they run in one block unless their vocabulary outgrows a broadcast.
Documents are encoded once as ids of the block's vocabulary (a word no item holds can be in no leaked run;
it only ends runs) and written to a checkpoint.  Over all documents a randomised SVD of TF-IDF passages is
computed: every partition sums its share of A'(A X) for a narrow matrix X, so only vocabulary-by-rank tables
travel.  Windows of documents find windows of items in the latent space.  For exact leaks an index of random
hyperplanes gives the windows of equal sign keys, of which those of a high cosine are candidates; for
paraphrases, whose texts share their domain and so most keys, the item windows (the stated query set) meet
all document windows in blocks of one matrix product.  Candidates are then checked on the words, by the
longest common run (exact leaks) or the longest common subsequence plus the item's rare words (paraphrases).

Why no exact leak is lost: a run of 13 words holds one whole window of 7 that starts at a multiple of 7
in the item; the document's windows of 7 start at every word of its vocabulary runs of 13 or more; equal
windows have equal vectors, so their keys are equal and their cosine is 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions.runs import mix64
from tracewright.llm.textkit import plain_words
from tracewright.session import bounded_collect, durable, ensure_small, table

RUN = 13
RANK, OVERSAMPLE = 48, 8
#: A block of items ends at so many items or vocabulary words: the latent table is broadcast (some 40 MB at most).
ITEMS_PER_BLOCK, BLOCK_WORDS = 200_000, 100_000
MAX_ITEMS, MAX_ITEM_BYTES = 1_000_000, 256 << 20
#: Sign keys of the index: (tables, bits).  Equal vectors agree in every table.
EXACT_KEYS = (4, 16)


@dataclass
class ItemBlock:
    """Items of one block with their words as vocabulary ids."""

    ids: list[int]
    words: list[np.ndarray]
    vocabulary: dict[str, int]


def _item_blocks(items: DataFrame) -> Iterator[ItemBlock]:
    some = items.select("item_id", "text").where("item_id is not null and text is not null")
    ensure_small(some.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0], "evaluation items", MAX_ITEM_BYTES)
    vocabulary: dict[str, int] = {}
    ids: list[int] = []
    words: list[np.ndarray] = []
    for r in bounded_collect(some, MAX_ITEMS, "evaluation items"):
        ids.append(r.item_id)
        words.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in plain_words(r.text)], dtype=np.int32))
        if len(ids) >= ITEMS_PER_BLOCK or len(vocabulary) >= BLOCK_WORDS:
            yield ItemBlock(ids, words, vocabulary)
            ids, words, vocabulary = [], [], {}
    if ids:
        yield ItemBlock(ids, words, vocabulary)


def encode(documents: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """doc_id and the document's words as vocabulary ids; a stretch of other words is one -1.

    Documents with fewer than two words of the vocabulary are left out: no passage of theirs can match."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in batches:
            ids, terms = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                t = np.array([get(w, -1) for w in plain_words(text)], dtype=np.int32)
                if (t >= 0).sum() < 2:
                    continue
                ids.append(doc)
                terms.append(t[(t >= 0) | np.concatenate(([True], t[:-1] >= 0))])
            ends = np.cumsum([0, *map(len, terms)]).astype(np.int32)
            values = np.concatenate(terms) if terms else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))], names=["doc_id", "terms"])

    return documents.where("doc_id is not null and text is not null").select("doc_id", "text").mapInArrow(run, "doc_id bigint, terms array<int>")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Terms of all rows of a batch with a -1 after each row, and the row of each place."""
    lists = batch.column(batch.schema.get_field_index("terms"))
    values, offsets = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    size = np.diff(offsets)
    out = np.full(len(values) + len(size), -1, dtype=np.int32)
    row = np.repeat(np.arange(len(size)), size + 1)
    last = np.cumsum(size + 1) - 1
    mask = np.ones(len(out), dtype=bool)
    mask[last] = False
    out[mask] = values
    return out, row


def document_frequency(encoded: DataFrame, size: int) -> np.ndarray:
    """In how many documents each vocabulary word stands; counted over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            flat, row = _flat(batch)
            keep = flat >= 0
            pair = np.unique(row[keep].astype(np.int64) * size + flat[keep])
            total += np.bincount(pair % size, minlength=size)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(total[hit])], names=["term", "n"])

    df = np.zeros(size, dtype=np.int64)
    for r in bounded_collect(encoded.mapInArrow(run, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")), size, "vocabulary counts"):
        df[r.term] = r.n
    return df


def _passages(flat: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Non-overlapping passages of up to ``width`` vocabulary words of each row: (passage, term) pairs."""
    keep = np.flatnonzero(flat >= 0)
    r = row[keep]
    first = np.concatenate(([True], r[1:] != r[:-1])) if len(r) else np.empty(0, bool)
    begin = np.maximum.accumulate(np.where(first, np.arange(len(r)), 0))
    number = (np.arange(len(r)) - begin) // width
    new = np.concatenate(([True], (r[1:] != r[:-1]) | (number[1:] != number[:-1]))) if len(r) else np.empty(0, bool)
    return np.cumsum(new) - 1, flat[keep]


def latent_space(encoded: DataFrame, block: ItemBlock, idf: np.ndarray, rank: int = RANK, width: int = RUN, seed: int = 5) -> np.ndarray:
    """Right singular vectors (vocabulary by rank) of the TF-IDF passages of all documents and items.

    Randomised subspace iteration: X random, X <- orth(A'A X), then the small problem X'A'A X.  Each
    product is one pass; a partition returns one row for each word it met."""
    size, wide = len(idf), min(rank + OVERSAMPLE, len(idf))
    sc = encoded.sparkSession.sparkContext
    own = np.concatenate([w for w in block.words if len(w)]) if any(map(len, block.words)) else np.empty(0, np.int32)
    own_row = np.repeat(np.arange(len(block.words)), [len(w) for w in block.words])

    def share(flat: np.ndarray, row: np.ndarray, x: np.ndarray, out: np.ndarray) -> None:
        passage, term = _passages(flat, row, width)
        if not len(term):
            return
        start = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
        y = np.add.reduceat(x[term], start, axis=0)  # rows of x already carry the idf
        norm = np.maximum(np.add.reduceat(idf[term] ** 2, start), 1e-12)
        y /= norm[:, None]
        order = np.argsort(term, kind="stable")
        ordered = term[order]
        at = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        out[ordered[at]] += np.add.reduceat(y[passage[order]], at, axis=0)

    def product(x: np.ndarray) -> np.ndarray:
        weighted = sc.broadcast((idf[:, None] * x).astype(np.float64))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((size, wide))
            for batch in batches:
                share(*_flat(batch), weighted.value, total)
            hit = np.flatnonzero(np.abs(total).sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.FixedSizeListArray.from_arrays(pa.array(total[hit].ravel()), wide).cast(pa.list_(pa.float64()))], names=["term", "y"])

        sums = encoded.mapInArrow(run, "term int, y array<double>").groupBy("term").agg(F.array(*[F.sum(F.col("y")[k]) for k in range(wide)]).alias("y"))
        out = np.zeros((size, wide))
        for r in bounded_collect(sums, size, "singular vectors"):
            out[r.term] = r.y
        share(own, own_row, weighted.value, out)
        return idf[:, None] * out

    x, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, wide)))
    x, _ = np.linalg.qr(product(x))
    small = x.T @ product(x)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return x @ vectors[:, np.argsort(-values)[:rank]]


def _unit(v: np.ndarray) -> np.ndarray:
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)).astype(np.float32)


def _pairs_above(left: np.ndarray, right: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs of unit rows with a cosine of ``least`` or more, a bounded part of the product at a time."""
    found = []
    for at in range(0, len(left), 1024):
        cosine = left[at : at + 1024] @ right.T
        i, j = np.divmod(np.flatnonzero(cosine >= least), max(1, len(right)))
        found.append((i + at, j, cosine[i, j]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, int), np.empty(0, int), np.empty(0))


class PlaneIndex:
    """Unit vectors by the signs of their products with random planes, some tables of keys."""

    def __init__(self, vectors: np.ndarray, tables: int, bits: int, seed: int = 17):
        self.vectors, self.tables, self.bits = vectors, tables, bits
        self.planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], tables * bits)).astype(np.float32)
        key = self._keys(vectors)
        self.order = np.argsort(key, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(key, self.order, axis=0)

    def _keys(self, v: np.ndarray) -> np.ndarray:
        signs = (v @ self.planes > 0).reshape(len(v), self.tables, self.bits)
        return signs @ (1 << np.arange(self.bits, dtype=np.int32))

    def above(self, left: np.ndarray, least: float, part: int = 8192) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(i, j, cosine) of the rows of ``left`` and indexed vectors of a common key and a cosine of ``least`` or more."""
        found = []
        for at in range(0, len(left), part):
            some = left[at : at + part]
            key = self._keys(some)
            pairs = []
            for t in range(self.tables):
                low = np.searchsorted(self.sorted[:, t], key[:, t])
                n = np.searchsorted(self.sorted[:, t], key[:, t], side="right") - low
                i = np.repeat(np.arange(len(some)), n)
                place = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
                pairs.append(i * len(self.vectors) + self.order[place, t])
            pair = np.concatenate(pairs)
            kept, cosines = [], []
            for k in range(0, len(pair), 1 << 18):
                i, j = np.divmod(pair[k : k + (1 << 18)], max(1, len(self.vectors)))
                cosine = np.einsum("ij,ij->i", some[i], self.vectors[j])
                keep = cosine >= least
                kept.append(pair[k : k + (1 << 18)][keep])
                cosines.append(cosine[keep])
            if kept:
                one, first = np.unique(np.concatenate(kept), return_index=True)  # of several tables
                i, j = np.divmod(one, max(1, len(self.vectors)))
                found.append((i + at, j, np.concatenate(cosines)[first]))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, int), np.empty(0, int), np.empty(0))


def _item_windows(block: ItemBlock, width: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, terms) of the items' windows."""
    owner, start, terms = [], [], []
    for k, w in enumerate(block.words):
        for at in range(0, len(w) - width + 1, step):
            owner.append(k), start.append(at), terms.append(w[at : at + width])
    return np.array(owner, int), np.array(start, int), np.array(terms, np.int32).reshape(-1, width)


def exact_leaks(encoded: DataFrame, block: ItemBlock, idf: np.ndarray, space: np.ndarray, run_words: int = RUN, least: float = 0.98) -> DataFrame:
    """doc_id, item_id, words: documents that hold ``run_words`` or more consecutive words of the item."""
    width = (run_words + 1) // 2
    latent = idf[:, None] * space
    owner, start, terms = _item_windows(block, width, width)
    vectors = _unit(latent[terms].sum(axis=1)) if len(terms) else np.empty((0, latent.shape[1]), np.float32)
    shared = encoded.sparkSession.sparkContext.broadcast((latent, owner, start, PlaneIndex(vectors, *EXACT_KEYS), block.words, np.array(block.ids, dtype=np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        latent, owner, start, index, words, ids = shared.value
        for batch in batches:
            flat, row = _flat(batch)
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            found: dict[tuple[int, int], int] = {}
            inside = flat >= 0
            edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
            begin, end = edge[::2], edge[1::2]
            long = end - begin >= run_words
            begin, end = begin[long], end[long]
            if len(begin) and len(owner):
                count = end - begin - width + 1
                place = np.repeat(begin, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                window = flat[place[:, None] + np.arange(width)]
                name = np.zeros(len(place), dtype=np.uint64)
                for k in range(width):
                    name = mix64(name * np.uint64(31) + window[:, k].astype(np.uint64) + np.uint64(1))
                _, one, every = np.unique(name, return_index=True, return_inverse=True)
                a, b, _ = index.above(_unit(latent[window[one]].sum(axis=1)), least)
                equal = (window[one][a] == np.stack([words[owner[w]][start[w] : start[w] + width] for w in b])).all(axis=1) if len(a) else np.empty(0, bool)
                order = np.argsort(every, kind="stable")
                bound = np.searchsorted(every[order], np.arange(len(one) + 1))
                for u, w in zip(a[equal], b[equal]):
                    item, s = words[owner[w]], start[w]
                    for p in place[order[bound[u] : bound[u + 1]]]:
                        lo = 0
                        while s - lo > 0 and p - lo > 0 and flat[p - lo - 1] == item[s - lo - 1]:
                            lo += 1
                        hi = width
                        while s + hi < len(item) and flat[p + hi] == item[s + hi]:
                            hi += 1
                        if lo + hi >= run_words:
                            key = (int(docs[row[p]]), int(ids[owner[w]]))
                            found[key] = max(found.get(key, 0), lo + hi)
            keys = list(found)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([found[k] for k in keys], pa.int32())], names=["doc_id", "item_id", "words"])

    return encoded.mapInArrow(run, "doc_id bigint, item_id bigint, words int")


def _common_subsequences(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The length of the longest common subsequence of each row of ``x`` and the same row of ``y``."""
    row = np.zeros((len(x), y.shape[1] + 1), dtype=np.int16)
    for i in range(x.shape[1]):
        equal = y == x[:, i : i + 1]
        grown = np.maximum(row[:, 1:], np.where(equal, row[:, :-1] + 1, 0))
        row[:, 1:] = np.maximum.accumulate(grown, axis=1)
    return row[:, -1]


def paraphrases(encoded: DataFrame, block: ItemBlock, idf: np.ndarray, space: np.ndarray, width: int = RUN, least: float = 0.8, common: float = 0.6, rare_share: float = 0.5) -> DataFrame:
    """doc_id, item_id, cosine, common_words: passages of ``width`` vocabulary words alike in meaning.

    Windows begin at every word of documents and items; an item of fewer words is one window of its
    length; items of one word are not searched, one word has no paraphrase.
    Kept is a pair whose longest common subsequence covers ``common`` of the passage and whose document
    passage holds ``rare_share`` of the item passage's answer words (those of above-median idf)."""
    latent = idf[:, None] * space
    groups = []
    for wide in sorted({min(width, len(w)) for w in block.words if len(w) > 1}):
        some = ItemBlock(block.ids, [w if min(width, len(w)) == wide else w[:0] for w in block.words], block.vocabulary)
        owner, _, terms = _item_windows(some, wide, 1)
        groups.append((wide, owner, terms, _unit(latent[terms].sum(axis=1))))
    middle = float(np.median(idf)) if len(idf) else 0.0
    shared = encoded.sparkSession.sparkContext.broadcast((latent, groups, np.array(block.ids, dtype=np.int64), idf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        latent, groups, ids, idf = shared.value
        for batch in batches:
            flat, row = _flat(batch)
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            best: dict[tuple[int, int], tuple[float, int]] = {}
            keep = flat >= 0
            t, r = flat[keep], row[keep]
            summed = np.concatenate([np.zeros((1, latent.shape[1])), np.cumsum(latent[t], axis=0)])
            for wide, owner, terms, vectors in groups:
                at = np.arange(0, max(0, len(t) - wide + 1))
                at = at[r[at] == r[at + wide - 1]] if len(at) else at
                a, b, c = _pairs_above(_unit(summed[at + wide] - summed[at]), vectors, least)
                for k in range(0, len(a), 1 << 15):
                    place, w, cosine = at[a[k : k + (1 << 15)]], b[k : k + (1 << 15)], c[k : k + (1 << 15)]
                    window, wanted = t[place[:, None] + np.arange(wide)], terms[w]
                    there = (wanted[:, :, None] == window[:, None, :]).any(axis=2)
                    rare = idf[wanted] >= middle
                    likely = ((there & rare).sum(axis=1) >= rare_share * rare.sum(axis=1)) & (there.sum(axis=1) >= common * wide)  # of each word one place counts twice, so this bounds the subsequence from above
                    place, w, cosine = place[likely], w[likely], cosine[likely]
                    n = _common_subsequences(window[likely], wanted[likely])
                    for i in np.flatnonzero(n >= common * wide):
                        key = (int(docs[r[place[i]]]), int(ids[owner[w[i]]]))
                        best[key] = max(best.get(key, (0.0, 0)), (float(cosine[i]), int(n[i])))
            keys = list(best)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([best[k][0] for k in keys], pa.float64()), pa.array([best[k][1] for k in keys], pa.int32())], names=["doc_id", "item_id", "cosine", "common_words"])

    return encoded.mapInArrow(run, "doc_id bigint, item_id bigint, cosine double, common_words int")


def _searched(documents: DataFrame, items: DataFrame, search, schema: str) -> DataFrame:
    n_docs: int | None = None
    out: DataFrame | None = None
    for block in _item_blocks(items):
        if not block.vocabulary:
            continue
        encoded = durable(encode(documents, block.vocabulary))
        n_docs = n_docs if n_docs is not None else documents.count()
        idf = np.log((1 + n_docs) / (1 + document_frequency(encoded, len(block.vocabulary)))) + 1
        part = search(encoded, block, idf, latent_space(encoded, block, idf))
        out = part if out is None else out.unionByName(part)
    return out if out is not None else documents.sparkSession.createDataFrame([], schema)


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, words: every document with 13 or more consecutive words of an item, and the longest run.

    Case, punctuation, spacing, invisible characters and Unicode form do not matter.  Null and short
    texts match nothing; repeated items and documents each give their rows; empty tables give none."""
    return _searched(documents, items, exact_leaks, "doc_id bigint, item_id bigint, words int").groupBy("doc_id", "item_id").agg(F.max("words").alias("words"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p7_leaked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items that leaked, into how many documents, and the longest run."""
    items = table(spark, sf_dir, "eval_items").select("item_id", "suite")
    hits = leaks(table(spark, sf_dir, "documents"), items.sparkSession.read.parquet(f"{sf_dir}/eval_items.parquet"))
    return hits.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"), F.max("words").alias("longest_run")).join(items, "item_id").select("item_id", "suite", "n_documents", "longest_run")


def p7_paraphrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")
    found = _searched(documents, items, paraphrases, "doc_id bigint, item_id bigint, cosine double, common_words int")
    return found.groupBy("doc_id", "item_id").agg(F.max("common_words").alias("common_words"))


QUERIES = {"p7_found": p7_found, "p7_leaked_items": p7_leaked_items, "p7_paraphrases": p7_paraphrases}
