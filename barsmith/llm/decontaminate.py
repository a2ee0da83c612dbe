"""Benchmark decontamination: CGK embedding, bit-sampling LSH over item-sized windows, exact edit verification.

The CGK random walk reads a string with a pointer that, at every step, stays or advances by a random bit drawn for (step, byte).
Strings at a small edit distance fall into step after an edit, so their embeddings have a small Hamming distance. The walk of a
window is a prefix of the walk of any longer window with the same start: the steps sampled are the first STEPS,
so one walk per start serves windows of every item's size. Each of TABLES tables hashes K sampled steps. All starts of the
items are indexed and all starts of the texts looked up: word starts, every character of three bytes or more (scripts that put
no spaces between words), and every character of an unbroken run of RUN bytes.

Items of up to SHORT bytes have few starts and are found without chance: cut into one piece more than they may have edits, one
piece of an occurrence is untouched, and the first PIECE bytes of every piece are looked up at every byte of the texts.

A hit names an item and a place. Places with VOTES hits or more within the allowed shift stay; the item's whole window there
must share enough 4-grams with the item (each edit destroys four at most), and is then verified by bit-parallel edit distance
(Myers) against floor(MAX_RATE * item length). Tests measure the recall on edited passages against brute force.

Texts are compared after normalising: A-Z lower-cased, runs of other ASCII than letters and digits as one space. The items are
broadcast in blocks of about BLOCK_BYTES, one after the other, however large the benchmark is.

Defined cases: null and empty texts hold no item; items shorter than MIN_ITEM normalised bytes occur by chance and are not
sought; items of equal text are each reported; repeated documents are reported per row; a null doc_id is reported as null;
empty tables give an empty result; extra columns are ignored.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.arrays import claim, mix, release, text_slices
from barsmith.session import scratch

STEPS, K, TABLES, VOTES = 40, 12, 10, 2
MAX_RATE, MIN_ITEM, BLOCK_BYTES = 0.1, 24, 2 << 20
RUN, SHORT, PIECE = 24, 80, 7
FOUND = "doc_id long, item_id long, distance int, start long, stop long"
_SPACE = 32
_MAP = np.full(256, _SPACE, np.uint8)
for _lo, _hi in ((48, 58), (97, 123), (128, 256)):
    _MAP[_lo:_hi] = np.arange(_lo, _hi)
_MAP[65:91] = np.arange(97, 123)


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalised bytes of rows and their offsets; every row ends in a space."""
    mapped = _MAP[data]
    space = mapped == _SPACE
    keep = np.ones(len(mapped), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    starts = offsets[:-1][offsets[:-1] < len(mapped)]
    keep[starts] = ~space[starts]
    kept = np.append(0, np.cumsum(keep))[offsets]
    out = np.insert(mapped[keep], kept[1:], _SPACE)
    return out, kept + np.arange(len(kept))


class Walk:
    """The random bits and the sampled steps, the same everywhere for a seed."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.bits = rng.integers(0, 2, (STEPS, 256), dtype=np.int32)
        self.sampled = [np.sort(rng.choice(STEPS, K, replace=False)) for _ in range(TABLES)]
        self.tables_at = [[t for t in range(TABLES) if j in self.sampled[t]] for j in range(STEPS)]

    def signatures(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """TABLES x len(starts) hashes; data must reach STEPS bytes beyond the last start."""
        at = starts.astype(np.int32)
        out = np.zeros((TABLES, len(starts)), np.uint64)
        for j in range(STEPS):
            byte = data[at]
            for t in self.tables_at[j]:
                out[t] = out[t] * np.uint64(0x100000001B3) + byte
            at += self.bits[j][byte]
        return mix(out + np.arange(1, TABLES + 1, dtype=np.uint64)[:, None])


def starts_of(data: np.ndarray) -> np.ndarray:
    """Where windows begin: a word, a character of three bytes or more, any character of a run of RUN bytes without a space."""
    letter = data != _SPACE
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    last = letter.copy()
    last[:-1] &= ~letter[1:]
    begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    first |= data >= 0xE0
    long = ends - begins >= RUN
    for lo, hi in zip(begins[long].tolist(), ends[long].tolist()):
        first[lo:hi] |= (data[lo:hi] & 0xC0) != 0x80
    return np.flatnonzero(first)


def four_grams(text: np.ndarray) -> np.ndarray:
    wide = text.astype(np.uint32)
    return wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16 | wide[3:] << 24


def buckets(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)


def piece_values(text: np.ndarray) -> np.ndarray:
    """The PIECE bytes at every place as an integer."""
    n = max(len(text) - PIECE + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(PIECE):
        out |= text[j:j + n].astype(np.uint64) << np.uint64(8 * j)
    return out


class Index:
    """Signatures of every start of the items, and pieces of the short ones."""

    BITS = 23

    def __init__(self, items: list[tuple[int, str]]):
        by_text: dict[bytes, list[int]] = {}
        for item_id, text in items:
            raw = np.frombuffer((text or "").encode(), np.uint8)
            data, _ = normalise(raw, np.array([0, len(raw)]))
            by_text.setdefault(data.tobytes().strip(), []).append(item_id)
        self.texts = [t for t in by_text if len(t) >= MIN_ITEM]
        self.ids = [by_text[t] for t in self.texts]
        self.limits = [int(MAX_RATE * len(t)) for t in self.texts]
        self.limit_of, self.size_of = np.array(self.limits, np.int64), np.array([len(t) for t in self.texts], np.int64)
        self.grams = [four_grams(np.frombuffer(t, np.uint8)) for t in self.texts]
        self.walk = Walk()
        signs, items_of, offsets = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        pieces, held = [np.zeros(0, np.uint64)], [np.zeros((2, 0), np.int32)]
        self.marks = np.zeros((sum(len(t) <= SHORT for t in self.texts), 32), np.uint8)
        self.mark_of = np.zeros(len(self.texts), np.int32)
        n_short = 0
        for i, text in enumerate(self.texts):
            if len(text) <= SHORT:
                at = np.arange(self.limits[i] + 1) * len(text) // (self.limits[i] + 1)
                pieces.append(piece_values(np.frombuffer(text, np.uint8))[at])
                held.append(np.stack([np.full(len(at), i, np.int32), at.astype(np.int32)]))
                mark = buckets(self.grams[i])
                np.bitwise_or.at(self.marks[n_short], mark >> 3, np.uint8(1) << (mark & 7))
                self.mark_of[i] = n_short
                n_short += 1
                continue
            data = np.frombuffer(text + b" " * (STEPS + 1), np.uint8)
            at = starts_of(data[:len(text)])
            at = at[(at == 0) | (at <= len(text) - STEPS // 2)]
            for sign in self.walk.signatures(data, at):
                signs.append(sign)
                items_of.append(np.full(len(at), i, np.int32))
                offsets.append(at.astype(np.int32))
        sign = np.concatenate(signs)
        order = np.argsort(sign, kind="stable")
        self.sign, self.item, self.offset = sign[order], np.concatenate(items_of)[order], np.concatenate(offsets)[order]
        self.seen = np.zeros(1 << self.BITS, bool)
        self.seen[self.sign >> np.uint64(64 - self.BITS)] = True
        piece = np.concatenate(pieces)
        order = np.argsort(piece, kind="stable")
        self.piece, (self.piece_item, self.piece_at) = piece[order], np.concatenate(held, axis=1)[:, order]
        self.piece_seen = np.zeros(1 << self.BITS if len(piece) else 0, bool)
        self.piece_seen[mix(self.piece) >> np.uint64(64 - self.BITS)] = True

    def candidates(self, data: np.ndarray, starts: np.ndarray, step: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
        """(item, place at which the item would begin) of items over SHORT, the most hit first, one per item and run of as many
        bytes as it may have edits; data as for Walk.signatures."""
        found = [np.zeros((2, 0), np.int64)]
        for lo in range(0, len(starts), step):
            part = starts[lo:lo + step]
            sign = self.walk.signatures(data, part)
            hits = np.nonzero(self.seen[sign >> np.uint64(64 - self.BITS)])
            wanted, w = sign[hits], hits[1]
            first, last = np.searchsorted(self.sign, wanted), np.searchsorted(self.sign, wanted, "right")
            n = last - first
            at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found.append(np.stack([self.item[at].astype(np.int64), np.repeat(part[w], n) - self.offset[at]]))
        item, place = np.concatenate(found, axis=1)
        key = (item << 40) + place
        line, slack = np.sort(key), np.array(self.limits, np.int64)[item]
        votes = np.searchsorted(line, key + slack, "right") - np.searchsorted(line, key - slack)
        keep = np.flatnonzero(votes >= VOTES)
        keep = keep[np.argsort(-votes[keep], kind="stable")]
        _, one = np.unique((item[keep] << 40) + place[keep] // (slack[keep] + 1), return_index=True)
        keep = keep[np.sort(one)]
        return item[keep], place[keep]

    def short_candidates(self, data: np.ndarray, step: int = 1 << 18, most: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
        """(item, place) of items up to SHORT: a piece lies there, and the window holds as many places of the item's 4-grams as
        the allowed edits must leave."""
        found = [np.zeros((2, 0), np.int64)]
        reach = SHORT + 2 * int(MAX_RATE * SHORT) + 4
        for lo in range(0, len(data) if len(self.piece) else 0, step):
            value = piece_values(data[lo:lo + step + PIECE - 1])
            where = np.flatnonzero(self.piece_seen[mix(value) >> np.uint64(64 - self.BITS)])
            first, last = np.searchsorted(self.piece, value[where]), np.searchsorted(self.piece, value[where], "right")
            some = last > first
            where, first, n = where[some] + lo, first[some], (last - first)[some]
            if not len(where):
                continue
            base = max(lo - reach, 0)
            near = np.zeros(step + 4 * reach, np.uint8)
            marks = buckets(four_grams(data[base:base + step + 3 * reach]))
            near[:len(marks)] = marks
            done = np.append(0, np.cumsum(n))
            for part in range(0, int(done[-1]), most):
                k = np.arange(part, min(part + most, int(done[-1])))
                hit = np.searchsorted(done, k, "right") - 1
                at = first[hit] + k - done[hit]
                item = self.piece_item[at].astype(np.int64)
                place = where[hit] - self.piece_at[at]
                slack, size = self.limit_of[item], self.size_of[item]
                held = np.zeros(len(item), np.int64)
                row = self.marks[self.mark_of[item]]
                each = np.arange(len(item))
                for j in range(int((size + 2 * slack).max()) - 3):
                    mark = near[np.clip(place - slack + j - base, 0, len(near) - 1)]
                    held += (row[each, mark >> 3] >> (mark & 7) & 1) * (j < size + 2 * slack - 3)
                keep = held >= size - 3 - 4 * slack
                found.append(np.stack([item[keep], place[keep]]))
        item, place = np.unique(np.concatenate(found, axis=1), axis=1)
        return item, place

    def plausible(self, i: int, text: np.ndarray) -> bool:
        """Whether the text holds as many of the item's 4-grams as the allowed edits must leave."""
        return np.isin(self.grams[i], four_grams(text)).sum() >= len(self.texts[i]) - 3 - 4 * self.limits[i]


def best_match(item: bytes, text: bytes) -> tuple[int, int]:
    """Least edit distance of the item to any substring of the text, and the first place where such a substring ends."""
    masks: dict[int, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top, score = (1 << len(item)) - 1, 1 << (len(item) - 1), len(item)
    up, down, best = full, 0, (len(item), 0)
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        plus, minus = down | (full & ~(xh | up)), up & xh
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = minus | (full & ~(xv | plus)), plus & xv
        if score < best[0]:
            best = score, j + 1
    return best


def search(batches, index: Index):
    """FOUND rows: per document and item the best verified place, in normalised bytes."""
    claim("decontaminate")
    for b in batches:
        for lo, hi, raw, offsets in text_slices(b.column(1), 2 << 20):
            data, begin = normalise(raw, offsets)
            padded = np.append(data, np.full(STEPS + 1, _SPACE, np.uint8))
            items, places = (np.concatenate(x) for x in zip(index.candidates(padded, starts_of(data)), index.short_candidates(data)))
            ends = np.array([len(t) for t in index.texts])[items] + places if len(items) else places
            rows = np.searchsorted(begin, np.maximum(places + (ends - places) // 2, 0), "right") - 1
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            for item, place, row in zip(items.tolist(), places.tolist(), np.clip(rows, 0, hi - lo - 1).tolist()):
                known = best.get((row, item))
                if known and (known[0] == 0 or known[1] <= place + index.limits[item] and place <= known[1] + index.limits[item]):
                    continue  # the same place, shifted by edits
                text, limit = index.texts[item], index.limits[item]
                left = max(place - limit - 1, int(begin[row]))
                right = min(place + len(text) + limit + 1, int(begin[row + 1]))
                if right - left < len(text) - limit or not index.plausible(item, data[left:right]):
                    continue
                distance, stop = best_match(text, data[left:right].tobytes())
                if distance <= limit and (not known or distance < known[0]):
                    best[row, item] = distance, left + stop - len(text), left + stop
            keys = [(row, item, i) for row, item in best for i in index.ids[item]]
            hits = [best[row, item] for row, item, _ in keys]
            row = np.array([k[0] for k in keys], np.int64)
            base = begin[row] if len(row) else row
            yield pa.RecordBatch.from_arrays([
                b.column(0)[lo:hi].take(pa.array(row)), pa.array([k[2] for k in keys], pa.int64()),
                pa.array([h[0] for h in hits], pa.int32()),
                pa.array(np.maximum(np.array([h[1] for h in hits], np.int64) - base, 0)),
                pa.array(np.array([h[2] for h in hits], np.int64) - base)],
                names=["doc_id", "item_id", "distance", "start", "stop"])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A FOUND row for each document and benchmark item found in it."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // BLOCK_BYTES + 1
    rows, path = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), scratch(spark, "found")
    for block in range(n):  # one block's index at a time: built, sent, searched and given up
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).collect()
        sent = spark.sparkContext.broadcast(Index([(r.item_id, r.text) for r in part]))
        rows.mapInArrow(partial(_search_block, sent), FOUND).write.parquet(f"{path}/block={block}")
        sent.destroy()
        release()
    return spark.read.schema(FOUND + ", block int").parquet(path).drop("block")


def _search_block(sent, batches):
    return search(batches, sent.value)
