"""Interpolated modified Kneser-Ney n-gram model: counted in Spark, stored as sorted hash arrays, memory-mapped to score.

Words are 64-bit hashes where they are counted alone (known words, vocabulary, base score), and 40-bit ones within n-grams. A task counts the n-grams of a few million tokens with numpy and sends one packed, sorted block per
shard (shards are ranges of the context's hash), so a frequent n-gram costs one entry per task. A shard's task merges its
blocks, writes the order's sorted arrays to the shared folder - n-gram hash and count; context hash, total and the numbers
of followers seen once, twice and more - and passes on, per distinct n-gram, one count for the n-gram without its first
word: the continuation counts of the next lower order. A shard holds at most the distinct followers of its
contexts, however often a word occurs. Discounts come from the counts of counts of each order.

Workers map the arrays read-only from the shared folder, or from a temporary copy where that folder is no file system path,
and look up the sorted distinct n-grams of many texts at a time. The model grows with the distinct n-grams of the corpus.

Defined cases: a null or empty text is one token, the end; without training texts every probability is 1 / (V + 1) with
V = 0; a count of counts that is zero falls back to fixed discounts; a null doc_id counts as the text ''; repeated rows are
texts of their own; extra columns are ignored.
"""

import os
import shutil
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.arrays import from_planes, mix, planes, release, text_slices, words
from barsmith.session import scratch

ORDER = 2
START, END, ID_BITS = 0, 1, 40
COUNT_BYTES = 5
FLUSH_TOKENS = 1_000_000
SHARD_BYTES, MAX_SHARDS = 16 << 20, 4096
BLOCKS = "level int, shard int, block binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
RAW, STATS = 0, -1
_STEP = np.uint64(0xD1342543DE82EF95)


def word_bytes(level: int) -> int:
    """Bytes of a word's hash: all eight where words alone are counted, five within n-grams."""
    return 8 if level == RAW else ID_BITS // 8


def sequences(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Word ids of the rows, each padded by order-1 starts and closed by an end; and where each row's words begin."""
    seq, begin, _ = with_words(data, offsets, order)
    return seq, begin


def with_words(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`sequences`, and the 64-bit hashes of all words and ends, without the starts."""
    hashed, first = words(data, offsets)
    pad = order - 1
    rows = np.arange(len(first) - 1)
    begin = first[:-1] + rows * (pad + 1) + pad
    whole = np.full(len(hashed) + len(rows) * (pad + 1), START, np.uint64)
    whole[np.arange(len(hashed)) + np.repeat(rows, np.diff(first)) * (pad + 1) + pad] = np.maximum(hashed, np.uint64(END + 1))
    seq = np.maximum(whole >> np.uint64(64 - ID_BITS), np.uint64(END + 1))
    seq[whole == START] = START
    seq[begin + np.diff(first)] = whole[begin + np.diff(first)] = END
    return seq, begin, whole[whole != START]


def grams(seq: np.ndarray, begin: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The columns of all n-grams that end in a word or an end, and the number of tokens of each row."""
    at = np.ones(len(seq), bool)
    at[(begin[:, None] - np.arange(1, order)[None, :]).ravel()] = False
    at = np.flatnonzero(at)
    counts = np.diff(np.append(np.searchsorted(at, begin), len(at)))
    return [seq[at - back] for back in range(order - 1, -1, -1)], counts


def context_hash(columns: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(columns[0]) if columns else 1, np.uint64)
    for c in columns:
        out = mix((out + c + np.uint64(1)) * _STEP)
    return out


def gram_keys(context: np.ndarray, word: np.ndarray, bits: int) -> np.ndarray:
    """A key per n-gram; its top bits are those of the context, which name the shard."""
    low = mix(context * _STEP + mix(word + np.uint64(1))) >> np.uint64(bits)
    return low if bits == 0 else (context >> np.uint64(64 - bits) << np.uint64(64 - bits)) | low


def shard_of(columns: list[np.ndarray], bits: int, level: int) -> np.ndarray:
    """The top bits of the context's hash, or of a single word's id, so that sorted keys are sorted by shard too."""
    if len(columns) == 1:
        return (columns[0] >> np.uint64(8 * word_bytes(level) - bits)).astype(np.int64)
    return top_bits(context_hash(columns[:-1]), bits)


def top_bits(context: np.ndarray, bits: int) -> np.ndarray:
    return (context >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(context), np.int64)


def summed(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns, sorted, with the sums of their counts."""
    if not len(counts):
        return columns, counts
    order = np.lexsort(columns[::-1])
    columns, counts = [c[order] for c in columns], counts[order]
    new = np.ones(len(counts), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.add.reduceat(counts, at)


def blocks(level: int, columns: list[np.ndarray], counts: np.ndarray, bits: int):
    """One packed block per shard: the words' byte planes, then the counts'."""
    columns, counts = summed(columns, counts)
    shard = shard_of(columns, bits, level)
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange((1 << bits) + 1))
    found = np.flatnonzero(np.diff(cuts))
    packed = []
    for s in found:
        at = order[cuts[s]:cuts[s + 1]]
        packed.append(b"".join([*(planes(c[at], word_bytes(level)) for c in columns), planes(counts[at], COUNT_BYTES)]))
    yield pa.RecordBatch.from_arrays([pa.array([level] * len(found), pa.int32()), pa.array(found, pa.int32()),
                                      pa.array(packed, pa.binary())], names=["level", "shard", "block"])


def unpack(block: bytes, level: int) -> tuple[list[np.ndarray], np.ndarray]:
    wide = word_bytes(level)
    n = len(block) // (wide * max(level, 1) + COUNT_BYTES)
    cuts = [i * wide * n for i in range(max(level, 1) + 1)]
    return [from_planes(block[lo:hi], wide) for lo, hi in zip(cuts, cuts[1:])], from_planes(block[cuts[-1]:], COUNT_BYTES)


def count_batches(batches, order: int, bits: int):
    held, alone, size = [], [], 0

    def flush():
        columns = [np.concatenate([h[i] for h in held]) for i in range(order)]
        ones = np.ones(len(columns[0]), np.uint64)
        yield from blocks(order, columns, ones, bits)
        yield from blocks(RAW, [np.concatenate(alone)], ones, bits)

    for b in batches:
        for _, _, data, offsets in text_slices(b.column(0)):
            seq, begin, single = with_words(data, offsets, order)
            held.append(grams(seq, begin, order)[0])
            alone.append(single)
            size += len(held[-1][0])
            if size >= FLUSH_TOKENS:
                yield from flush()
                held, alone, size = [], [], 0
    if held:
        yield from flush()
    del held, alone
    release()


class Store:
    """Arrays below one folder: written whole under their final name, opened as read-only maps."""

    def __init__(self, uri: str):
        self.fs, self.root = fs.FileSystem.from_uri(uri)

    def put(self, name: str, array: np.ndarray) -> None:
        """Tasks may run twice: the name appears by a rename, and either run writes the same bytes."""
        self.fs.create_dir(self.root, recursive=True)
        part = f"{self.root}/.{name}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(part) as out:
            np.lib.format.write_array(out, array, allow_pickle=False)
        self.fs.move(part, f"{self.root}/{name}.npy")

    def get(self, name: str, copies: str | None) -> np.ndarray:
        path = f"{self.root}/{name}.npy"
        if copies:
            local = f"{copies}/{name}.npy"
            if not os.path.exists(local):
                fs.copy_files(path, local, source_filesystem=self.fs, destination_filesystem=fs.LocalFileSystem())
            path = local
        return np.load(path, mmap_mode="r")


def reduce_shard(key, table: pa.Table, order: int, bits: int, uri: str) -> pa.Table:
    """Merge one shard of one level, write its arrays; out: the next lower level's blocks and one row of statistics."""
    level, shard = key[0].as_py(), key[1].as_py()
    if level == STATS:
        return table
    width = max(level, 1)
    parts = [unpack(b.as_py(), level) for b in table.column("block")]
    columns, counts = summed([np.concatenate([p[0][i] for p in parts]) for i in range(width)],
                             np.concatenate([p[1] for p in parts]))
    store, out = Store(uri), []
    if level > 1:
        context = context_hash(columns[:-1])
        by = np.argsort(context, kind="stable")
        new = np.flatnonzero(np.diff(context[by], prepend=context[by][:1] ^ np.uint64(1)))
        store.put(f"contexts-{level}-{shard}", context[by][new])
        store.put(f"totals-{level}-{shard}", np.stack([
            np.add.reduceat(x[by], new) for x in (counts, *((counts == k).astype(np.uint64) for k in (1, 2)),
                                                  (counts > 2).astype(np.uint64))]).astype(np.uint32))
        keys = gram_keys(context, columns[-1], bits)
        out += list(blocks(level - 1, columns[1:], np.ones(len(counts), np.uint64), bits))
    else:
        keys = columns[0]
    by = np.argsort(keys, kind="stable")
    store.put(f"grams-{level}-{shard}", keys[by])
    store.put(f"counts-{level}-{shard}", counts[by].astype(np.uint32))
    stats = np.array([level, shard, len(counts), counts.sum(), *((counts == k).sum() for k in (1, 2, 3, 4))], np.uint64)
    out.append(pa.RecordBatch.from_arrays([pa.array([STATS], pa.int32()), pa.array([shard], pa.int32()),
                                           pa.array([stats.tobytes()], pa.binary())], names=["level", "shard", "block"]))
    return pa.Table.from_batches(out)


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more."""
    if not (n1 and n2 and n3 and n4):
        return [0.0, 0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    return [0.0, *(min(max(k - (k + 1) * y * more / n, 0.0), float(k)) for k, n, more in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))]


def train(texts: DataFrame, order: int = ORDER) -> dict:
    """Count `texts` (one column) and write the arrays; returns the model's description: folder, shards, discounts."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length(F.col(texts.columns[0])))).first()[0] or 0
    bits = min(MAX_SHARDS, max(1, size // SHARD_BYTES)).bit_length()
    uri = scratch(spark, "kneser-ney")
    level = texts.mapInArrow(lambda it: count_batches(it, order, bits), BLOCKS)
    for _ in range(order):
        level = level.groupBy("level", "shard").applyInArrow(
            lambda key, t: reduce_shard(key, t, order, bits, uri), BLOCKS)
    rows = [np.frombuffer(r.block, np.uint64) for r in level.filter(f"level = {STATS}").collect()]
    model = {"uri": uri, "order": order, "bits": bits, "levels": {}}
    for n in range(order + 1):
        of = [r for r in rows if r[0] == n]
        total = [int(sum(int(r[i]) for r in of)) for i in range(8)]
        model["levels"][n] = {"shards": sorted(int(r[1]) for r in of), "distinct": total[2], "total": total[3],
                              "discounts": discounts(*total[4:]),
                              "followers": [total[4], total[5], total[2] - total[4] - total[5]]}
    return model


class Model:
    """The arrays of a trained model, mapped on first use."""

    def __init__(self, meta: dict):
        self.meta, self.store = meta, Store(meta["uri"])
        self.copies = None if isinstance(self.store.fs, fs.LocalFileSystem) else tempfile.mkdtemp()
        self.open = lru_cache(maxsize=None)(lambda name: self.store.get(name, self.copies))

    def close(self) -> None:
        if self.copies:
            shutil.rmtree(self.copies, ignore_errors=True)

    def _found(self, kind: str, level: int, wanted: np.ndarray, shard: np.ndarray):
        """For sorted wanted keys and their shards: (positions in wanted, shard, positions in its arrays)."""
        for s in self.meta["levels"][level]["shards"]:
            lo, hi = np.searchsorted(shard, [s, s + 1])
            if lo < hi:
                keys = self.open(f"{kind}-{level}-{s}")
                pos = np.searchsorted(keys, wanted[lo:hi])
                ok = np.flatnonzero(pos < len(keys))
                ok = ok[keys[pos[ok]] == wanted[lo:hi][ok]]
                yield lo + ok, s, pos[ok]

    def counts(self, level: int, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.float64)
        for at, s, pos in self._found("grams", level, keys, shard):
            out[at] = self.open(f"counts-{level}-{s}")[pos]
        return out

    def totals(self, level: int, contexts: np.ndarray, shard: np.ndarray) -> np.ndarray:
        out = np.zeros((4, len(contexts)), np.float64)
        for at, s, pos in self._found("contexts", level, contexts, shard):
            out[:, at] = self.open(f"totals-{level}-{s}")[:, pos]
        return out

    def word_counts(self, level: int, ids: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(ids, return_inverse=True)
        return self.counts(level, distinct, shard_of([distinct], self.meta["bits"], level))[back]

    def probabilities(self, columns: list[np.ndarray]) -> np.ndarray:
        """p(last column | the columns before it), interpolated over all orders."""
        bits, levels = self.meta["bits"], self.meta["levels"]
        word, vocabulary = columns[-1], levels[RAW]["distinct"]
        seen, low = self.word_counts(1, word), levels[1]
        p = np.full(len(word), 1.0 / (vocabulary + 1))
        if low["total"]:
            d = np.array(low["discounts"])
            spare = d[1:] @ np.array(low["followers"], np.float64) / low["total"]
            p = np.maximum(seen - d[np.minimum(seen, 3).astype(int)], 0) / low["total"] + spare * p
        for level in range(2, self.meta["order"] + 1):
            d = np.array(levels[level]["discounts"])
            context = context_hash(columns[len(columns) - level:-1])
            shard = top_bits(context, bits)
            heads, first, back = np.unique(context, return_index=True, return_inverse=True)
            totals = self.totals(level, heads, shard[first])[:, back]
            keys, first, back = np.unique(gram_keys(context, word, bits), return_index=True, return_inverse=True)
            c = self.counts(level, keys, shard[first])[back]
            total = np.maximum(totals[0], 1)
            mixed = np.maximum(c - d[np.minimum(c, 3).astype(int)], 0) / total + (d[1:] @ totals[1:]) / total * p
            p = np.where(totals[0] > 0, mixed, p)
        return p


def score_batches(batches, meta: dict):
    model, raw = Model(meta), meta["levels"][RAW]
    norm = raw["total"] + 0.1 * (raw["distinct"] + 1)
    try:
        for b in batches:
            for lo, hi, data, offsets in text_slices(b.column(2), 2 << 20):
                seq, begin, single = with_words(data, offsets, meta["order"])
                columns, n = grams(seq, begin, meta["order"])
                c = model.word_counts(RAW, single)
                row = np.append(0, np.cumsum(n))[:-1]
                sums = lambda x, row=row: np.add.reduceat(x, row)  # noqa: E731  every row has a token
                yield pa.RecordBatch.from_arrays([
                    b.column(0)[lo:hi], b.column(1)[lo:hi], pa.array(n, pa.int64()),
                    pa.array(sums((c > 0).astype(np.int64)), pa.int64()), pa.array(np.full(hi - lo, raw["total"], np.int64)),
                    pa.array(sums(np.log10((c + 0.1) / norm))), pa.array(sums(np.log10(model.probabilities(columns))))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    finally:
        model.close()


def held_out(fold: int):
    """crc32 of doc_id as text, modulo fold, is 0."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % fold == 0


def score_documents(docs: DataFrame, fold: int = 10, order: int = ORDER) -> DataFrame:
    """SCORED plus perplexity: learn from the rows that are not held out, score all."""
    rows = docs.select(F.col("doc_id").cast("long"), held_out(fold).alias("held_out"), F.col("text").cast("string"))
    meta = train(rows.filter(~F.col("held_out")).select("text"), order)
    scored = rows.mapInArrow(lambda it: score_batches(it, meta), SCORED)
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
