"""Ranked lexical search with hashed max-sketches.

Index: one row per document holds its length, its terms (64-bit hashes, sorted) with their frequencies, and a sketch of WIDTH bytes.
A term belongs to one coordinate, and each coordinate keeps the largest impact folded into it. At a given length the impact grows with the
frequency alone, so the sketch stores the largest frequency (255: that many or more) and turns into impacts when the corpus
statistics are known. An index therefore stays right when documents are added.

Search: a block of at most BLOCK_ITEMS items is broadcast with its terms' weights and searched against all index rows. For a batch of
documents, one lookup of every item's terms in the sketches gives upper bounds of all scores. Each item visits the documents by falling
bound, in waves, scores them exactly from their frequencies, and stops below its k-th score so far (an equal bound counts, as ties go to
the smaller id). A task emits k rows per item. Blocks run one after the other: each one's result is written and its broadcast destroyed.

Terms are maximal runs of digits, letters and all characters from U+0080 on, A-Z lower-cased. Weights are floor(1000 ln((2N+2)/(2df+1))),
impacts (10^9 tf) div (1000 tf + 8 m) with m = 10 + (90 n N) div L; a score sums weight * impact over the item's distinct terms.

Defined cases: null and empty texts, and those without terms, are in no count; rows that share a doc_id are documents of their own; a
null doc_id ranks after the others of its score; the terms of rows that share an item_id are one item's; items without an id or terms
give nothing; documents of score 0 are no results; ties at the same doc_id have any order; empty tables give an empty result; extra
columns are ignored. A worker holds one batch of documents and a block's terms: BLOCK_ITEMS times the terms of an item.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barsmith.llm.arrays import LOWER, release, span_hashes, text_slices, word_spans
from barsmith.llm.mixing import numbered
from barsmith.session import scratch, stage

WIDTH, BLOCK_ITEMS, WAVE, PIECE = 4096, 1024, 16, 1 << 20
INDEX = "doc_id long, n long, terms binary, counts binary, sketch binary"
FOUND = "item int, doc_id long, score long"
RESULT = "item_id long, rank int, doc_id long, score long"
MOST = 1_000_000  # no impact reaches 10^9 tf / 1000 tf
_FOLD = LOWER.copy()
_FOLD[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 32


def slice_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every term and the first term of each row (one more at the end)."""
    folded = _FOLD[data]
    starts, ends, first = word_spans(folded, offsets)
    return span_hashes(folded, starts, ends), first


def distinct_terms(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, hash, frequency) of each row's distinct terms, by row and hash."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return row[at], hashes[at], np.diff(at, append=len(row))


def coordinate(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) % WIDTH


def _index(batches):
    for b in batches:
        ids = b.column(0)
        for lo, hi, data, offsets in text_slices(b.column(1)):
            hashes, first = slice_terms(data, offsets)
            row, terms, counts = distinct_terms(hashes, first)
            n = np.diff(first)
            sketch = np.zeros((hi - lo, WIDTH), np.uint8)
            np.maximum.at(sketch, (row, coordinate(terms)), np.minimum(counts, 255).astype(np.uint8))
            full = np.flatnonzero(n)
            cuts = np.searchsorted(row, np.arange(hi - lo + 1))

            def cells(values, scale, full=full, cuts=cuts):
                raw = values.tobytes()
                return pa.array([raw[cuts[r] * scale:cuts[r + 1] * scale] for r in full], pa.binary())

            yield pa.RecordBatch.from_arrays(
                [ids.slice(lo, hi - lo).take(pa.array(full)), pa.array(n[full], pa.int64()), cells(terms, 8),
                 cells(counts.astype(np.uint32), 4), pa.array([s.tobytes() for s in sketch[full]], pa.binary())],
                names=["doc_id", "n", "terms", "counts", "sketch"])
    release()


def index(docs: DataFrame) -> DataFrame:
    """doc_id, n, terms, counts, sketch of each document with a term; not yet written."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_index, INDEX)


def _item_terms(batches):
    for b in batches:
        for lo, hi, data, offsets in text_slices(b.column(1)):
            row, terms, _ = distinct_terms(*slice_terms(data, offsets))
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo).take(pa.array(row)), pa.array(terms.view(np.int64))],
                                             names=["item_id", "term"])


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, block: each item's distinct terms, items in blocks of BLOCK_ITEMS by id."""
    usable = items.select(F.col("item_id").cast("long"), "text").where("item_id IS NOT NULL")
    pairs = stage(usable.mapInArrow(_item_terms, "item_id long, term long").distinct(), "item_terms")
    listed = numbered(pairs.select("item_id").distinct(), F.col("item_id"))
    return pairs.join(listed, "item_id").select("item_id", "term", F.floor(F.col("position") / BLOCK_ITEMS).alias("block"))


def _flat(column, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column, end to end, and where each row begins (one more at the end)."""
    column = column.cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, dtype), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0]:bounds[-1]]
    return np.ascontiguousarray(raw).view(dtype), (bounds - bounds[0]) // np.dtype(dtype).itemsize


class Vocabulary:
    """A block's sorted term hashes; a table of marked hash bits spares most other terms the search."""

    def __init__(self, terms: np.ndarray):
        self.terms, self.marked = terms, np.zeros(1 << 20, bool)
        self.marked[(terms >> np.uint64(44)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in `hashes`, term number) of the hashes that are terms of the block."""
        place = np.flatnonzero(self.marked[(hashes >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, hashes[place]), len(self.terms) - 1)
        hit = self.terms[at] == hashes[place] if len(self.terms) else np.zeros(0, bool)
        return place[hit], at[hit]


def _count_documents(sent, batches):
    vocabulary = Vocabulary(sent.value)
    total = np.zeros(len(sent.value), np.int64)
    for b in batches:
        total += np.bincount(vocabulary.find(_flat(b.column(0), np.uint64)[0])[1], minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "df"])


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists of these lengths, end to end: the list of each entry, and its place within the list."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Block:
    """A block's items: the terms of each, their weights, and per sketch coordinate the items that look it up."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, item: np.ndarray, term: np.ndarray, n_items: int):
        self.vocabulary, self.weights, self.n_items = Vocabulary(terms), weights, n_items
        order = np.lexsort((term, item))
        item, self.term = item[order], term[order]
        self.first = np.searchsorted(item, np.arange(n_items + 1))
        at = coordinate(terms)[self.term]
        folded, inverse = np.unique(at * n_items + item, return_inverse=True)
        self.look_weight = np.bincount(inverse, weights=weights[self.term]).astype(np.float64)
        self.look_item = folded % n_items
        self.columns, self.look_first = np.unique(folded // n_items, return_index=True)
        self.look_first = np.append(self.look_first, len(folded))

    def bounds(self, sketch: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores of all documents for all items; sums of integers below 2^53, so exact."""
        tf = sketch[:, self.columns].astype(np.int64)
        row, col = np.nonzero(tf)
        tf = tf[row, col]
        high = np.where(tf == 255, MOST, impact(tf, m[row]))
        out = np.zeros(len(sketch) * self.n_items)
        counts = np.diff(self.look_first)[col]
        cuts = np.searchsorted(np.cumsum(counts), np.arange(PIECE, counts.sum() + PIECE, PIECE), "left") + 1
        lo = 0
        for hi in np.unique(np.minimum(cuts, len(row))):
            owner, at = spread(counts[lo:hi])
            look = self.look_first[col[lo:hi]][owner] + at
            cell = row[lo:hi][owner] * self.n_items + self.look_item[look]
            first, last = int(row[lo]) * self.n_items, (int(row[hi - 1]) + 1) * self.n_items
            out[first:last] += np.bincount(cell - first, high[lo:hi][owner] * self.look_weight[look], last - first)
            lo = hi
        return out.reshape(len(sketch), self.n_items)

    def score(self, docs: np.ndarray, items: np.ndarray, keys: np.ndarray, tfs: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Exact scores of (document, item) pairs; keys: document * terms + term, sorted, with frequencies."""
        out, sizes = np.zeros(len(docs), np.int64), np.diff(self.first)[items]
        if not len(keys):
            return out
        cuts = np.searchsorted(np.cumsum(sizes), np.arange(PIECE, sizes.sum() + PIECE, PIECE), "left") + 1
        lo = 0
        for hi in np.unique(np.minimum(cuts, len(docs))):
            owner, at = spread(sizes[lo:hi])
            term = self.term[self.first[items[lo:hi]][owner] + at]
            wanted = docs[lo:hi][owner] * len(self.weights) + term
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = np.flatnonzero(keys[place] == wanted)
            owner, tf, term = owner[hit], tfs[place[hit]], term[hit]
            np.add.at(out, lo + owner, self.weights[term] * impact(tf, m[docs[lo:hi][owner]]))
            lo = hi
        return out


class Best:
    """The k best (score, id) of each item, a null id after others of its score."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.score = np.zeros((n_items, k), np.int64)
        self.ids = np.zeros((n_items, k), np.int64)
        self.void = np.zeros((n_items, k), bool)
        self.scored = 0

    def merge(self, items: np.ndarray, score: np.ndarray, ids: np.ndarray, void: np.ndarray) -> None:
        touched = np.unique(items)
        old = np.repeat(touched, self.k)
        items = np.concatenate([old, items])
        score = np.concatenate([self.score[touched].ravel(), score])
        ids = np.concatenate([self.ids[touched].ravel(), ids])
        void = np.concatenate([self.void[touched].ravel(), void])
        order = np.lexsort((ids, void, -score, items))
        items, score, ids, void = items[order], score[order], ids[order], void[order]
        rank = np.arange(len(items)) - np.searchsorted(items, items)
        top = rank < self.k
        at = (items[top], rank[top])
        self.score[at], self.ids[at], self.void[at] = score[top], ids[top], void[top]

    def feed(self, block: Block, b: pa.RecordBatch, m: np.ndarray) -> None:
        sketch = _flat(b.column(4), np.uint8)[0].reshape(-1, WIDTH)
        bound = block.bounds(sketch, m)
        doc, item = np.nonzero(bound >= np.maximum(self.score[:, -1], 1))
        if not len(doc):
            return
        bound = bound[doc, item]
        order = np.lexsort((-bound, item))
        doc, item, bound = doc[order], item[order], bound[order]
        wave = (np.arange(len(item)) - np.searchsorted(item, item)) // WAVE
        keys, tfs = self._frequencies(block, b, np.unique(doc))
        ids, void = b.column(0).fill_null(0).to_numpy(), b.column(0).is_null().to_numpy(zero_copy_only=False)
        turns = np.argsort(wave, kind="stable")
        ends = np.searchsorted(wave[turns], np.arange(wave.max() + 2))
        for lo, hi in zip(ends, ends[1:]):
            live = turns[lo:hi]
            live = live[bound[live] >= np.maximum(self.score[item[live], -1], 1)]
            if not len(live):
                break  # bounds only fall from here
            self.scored += len(live)
            score = block.score(doc[live], item[live], keys, tfs, m)
            live, score = live[score > 0], score[score > 0]
            self.merge(item[live], score, ids[doc[live]], void[doc[live]])

    @staticmethod
    def _frequencies(block: Block, b: pa.RecordBatch, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document * terms + term, frequency) of the block's terms in these documents, sorted."""
        hashes, first = _flat(b.column(2), np.uint64)
        counts, _ = _flat(b.column(3), np.uint32)
        if len(docs) < len(b):
            owner, at = spread(np.diff(first)[docs])
            at += first[docs][owner]
            hashes, counts, owner = hashes[at], counts[at], docs[owner]
        else:
            owner = np.repeat(docs, np.diff(first))
        place, term = block.vocabulary.find(hashes)
        return owner[place] * len(block.weights) + term, counts[place].astype(np.int64)

    def rows(self) -> pa.RecordBatch:
        item, at = np.nonzero(self.score > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(self.ids[item, at], mask=self.void[item, at]), pa.array(self.score[item, at])],
            names=["item", "doc_id", "score"])


def _search(sent, k, batches):
    documents, length, arrays = sent.value
    block = Block(*arrays)
    best = Best(block.n_items, k)
    for b in batches:
        m = 10 + (90 * b.column(1).to_numpy() * documents) // length
        best.feed(block, b, m)
    yield best.rows()
    release()


def weight(documents: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)


def search(indexed: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of a written index for each item."""
    spark = indexed.sparkSession
    send = spark.sparkContext.broadcast
    documents, length = indexed.agg(F.count("*"), F.sum("n")).first()
    asked, path = stage(item_terms(items), "items"), scratch(spark, "hits")
    written = False
    for number in range((asked.agg(F.max("block")).first()[0] or 0) + 1 if documents else 0):
        pairs = asked.where(F.col("block") == number).select("item_id", "term").toArrow()  # bounded by the block
        names, item = np.unique(pairs.column("item_id").to_numpy(), return_inverse=True)
        terms, term = np.unique(pairs.column("term").to_numpy().view(np.uint64), return_inverse=True)
        if not len(terms):
            continue
        vocabulary = send(terms)
        seen = indexed.select("terms").mapInArrow(partial(_count_documents, vocabulary), "term int, df long")
        df = np.zeros(len(terms), np.int64)
        for r in seen.groupBy("term").agg(F.sum("df").alias("df")).collect():
            df[r.term] = r.df
        vocabulary.destroy()
        sent = send((documents, length, (terms, weight(documents, df), item, term, len(names))))
        hits = indexed.mapInArrow(partial(_search, sent, k), FOUND)
        ids = spark.createDataFrame(list(enumerate(names.tolist())), "item int, item_id long")
        hits.join(ids, "item").select("item_id", "doc_id", "score").write.parquet(f"{path}/block={number}")
        sent.destroy()
        written = True
    if not written:
        return spark.createDataFrame([], RESULT)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    hits = spark.read.schema("item_id long, doc_id long, score long, block int").parquet(path)
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Index all documents, write the index, and search it."""
    return search(stage(index(docs), "index"), items, k)
