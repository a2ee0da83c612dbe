"""Exact removal of long repeated strings: bounded interval expansion on a Burrows-Wheeler transform.

Every string of LENGTH bytes that starts in more than one place of the corpus goes, wherever it starts. The transform is
not built over the corpus at once but over shards that hold all places of the strings they judge. A string's shard
follows from its anchor, the least hash among its substrings of GRAM bytes: equal strings have equal anchors. The strings of a
document that follow each other with one anchor form a segment. Anchors seen once are done. Equal segments collapse to one with
its number of copies, in each task before anything is shuffled, so a text copied a million times is indexed once.

An anchor within a very common passage gathers one segment per document. Such hot anchors are dealt anew: the
substrings that two of their segments have in common rank last, so each string follows its rarer part.

In a shard, suffixes are sorted by their first 256 bytes, giving the transform. From the intervals of the sort's first
key, breadth-first backward extension finds the interval boundaries by increasing common prefix, and stops
at LENGTH. What no boundary parts shares LENGTH bytes; an interval with two or more copies is a repeat.

Defined cases: a null text is empty; texts shorter than LENGTH keep all bytes; repeated rows are copies of each other, so all
strings of LENGTH in them go; rows may share a doc_id or have none; an empty table gives an empty result; extra columns are ignored.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.arrays import claim, delta_planes, from_delta_planes, from_planes, mix, planes, release, span_hashes, text_slices
from barsmith.session import stage

LENGTH, GRAM = 200, 32
SLICE, FLUSH, SHARD_BYTES, INDEX_BYTES, MAX_SHARDS = 1 << 20, 200_000, 16 << 20, 2 << 20, 4096
HOT_SEGMENTS, HOT_ANCHORS = 2000, 5000  # an anchor is hot above this many segments and this share of all
BROADCAST_ROWS = 1_000_000  # of document keys: 16 MB
DONE = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, kept_text string"
_U = np.uint64
_TABLE = mix(np.arange(1, 257, dtype=np.uint64))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each place (fewer places than bytes by GRAM - 1)."""
    h, width, base = _TABLE[data], 1, 0x9E3779B97F4A7C15
    while width < GRAM:
        h = h[:-width] * _U(pow(base, width, 1 << 64)) + h[width:]
        width *= 2
    return mix(h)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n, span = len(x) - width + 1, 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span:width - span + n])


def segments(data: np.ndarray, offsets: np.ndarray, common: np.ndarray | None = None):
    """Runs of strings with one anchor, within rows: (anchor, row, first byte, bytes, whether the anchor occurs in it more than
    once, so that it may repeat itself). Hashes in `common` rank last."""
    room = np.maximum(np.diff(offsets) - LENGTH + 1, 0)
    if not room.any():
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none.astype(bool)
    order = gram_hashes(data) >> _U(1)
    if common is not None and len(common):
        order |= np.isin(order, common).astype(np.uint64) << _U(63)
    least = sliding_min(order, LENGTH - GRAM + 1)
    row = np.repeat(np.arange(len(room)), room)
    at = np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room) + offsets[:-1][row]
    anchor = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    anchor, row, last = anchor[first], row[first], at[np.append(first[1:], len(at)) - 1]
    first = at[first]
    views = np.lib.stride_tricks.sliding_window_view(order, LENGTH - GRAM + 1)
    begins, ends = views[first] == anchor[:, None], views[last] == anchor[:, None]
    again = (begins.sum(axis=1) > 1) | (begins.argmax(axis=1) + first != ends.argmax(axis=1) + last) | (ends.sum(axis=1) > 1)
    return anchor, row, first, last - first + LENGTH, again


def keyed(docs: DataFrame, carry=()) -> DataFrame:
    """k1, k2: what names a row's text in the joins: the doc_id and a 64-bit hash of the text, without a doc_id two such hashes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit(1), text)).alias("k1"), F.xxhash64(text).alias("k2"),
                       F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *(F.col(c).alias(f"_{c}") for c in carry))


_FIELDS = ("anchor", "seg", "k1", "k2", "start", "size", "copies")
OCCURRENCES = "anchor long, seg long, k1 long, k2 long, start long, size int, copies int"


def _occurrence_blocks(docs: DataFrame, bits: int) -> DataFrame:
    """shard, block: per task one entry for each distinct segment, with its copies there (2 for more; 4 more if its anchor
    occurs in it again). The task's other places of
    it go to a shard from 2**bits on, which has nothing to judge."""
    def blocks(held):
        cols = [np.concatenate(x) for x in zip(*held)]
        order = np.lexsort((cols[2], cols[1], cols[0]))
        anchor, seg, k1, k2, start, size, again = (c[order] for c in cols)
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (seg[1:] != seg[:-1])
        copies = np.minimum(np.diff(np.append(np.flatnonzero(new), len(new))), 2)
        whole = np.zeros(len(anchor), np.int64)
        whole[new] = copies | again[new].astype(np.int64) << 2
        shard = np.where(new, (mix(anchor) >> _U(64 - bits)).astype(np.int64),  # anchors are small: minima
                         (1 << bits) + (mix(k1.astype(np.uint64) ^ start.astype(np.uint64)) & _U(63)).astype(np.int64))
        by = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[by], np.arange((1 << bits) + 65))
        found = np.flatnonzero(np.diff(cuts))
        packed = []
        for s in found:
            at = by[cuts[s]:cuts[s + 1]]
            packed.append(delta_planes(anchor[at]) + b"".join(planes(c[at].astype(np.int64).view(np.uint64)) for c in (
                seg.view(np.int64), k1, k2, start, size, whole)))
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(packed, pa.binary())], names=["shard", "block"])

    def run(batches):
        claim("suffix_dedup")
        held, count = [], 0
        for b in batches:
            for lo, hi, data, offsets in text_slices(b.column(2), SLICE):
                anchor, row, first, size, again = segments(data, offsets)
                if not len(anchor):
                    continue
                held.append((anchor, span_hashes(data, first, first + size), np.asarray(b.column(0)[lo:hi])[row],
                             np.asarray(b.column(1)[lo:hi])[row], first - offsets[row], size, again))
                count += len(anchor)
                if count >= FLUSH:
                    yield from blocks(held)
                    held, count = [], 0
        if count:
            yield from blocks(held)
        del held
        release()
    return docs.select("k1", "k2", "text").mapInArrow(run, "shard int, block binary")


def repeated_occurrences(docs: DataFrame, bits: int) -> DataFrame:
    """OCCURRENCES of the segments whose anchor occurs in two or more places; copies is set at one place of each segment (the least
    k1): 1, or 2 for more, plus ALONE if no other segment has its anchor."""
    def merge(key, table):
        parts = []
        for block in table.column("block"):
            raw = block.as_py()
            n = len(raw) // len(_FIELDS)
            parts.append([from_delta_planes(raw[:n]), *(from_planes(raw[i * n:(i + 1) * n]) for i in range(1, len(_FIELDS)))])
        cols = [np.concatenate(x) for x in zip(*parts)]
        if key[0].as_py() < 1 << bits:
            order = np.lexsort((cols[2], cols[1], cols[0]))
            cols = [c[order] for c in cols]
            anchor, seg, copies = cols[0], cols[1], cols[6]
            heads = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
            spread = np.diff(np.append(heads, len(anchor)))
            places = (copies & _U(3)) + (copies >> _U(2))
            keep = np.repeat(np.add.reduceat(places, heads) >= 2, spread)
            first = np.append(True, (anchor[1:] != anchor[:-1]) | (seg[1:] != seg[:-1]))
            total = np.add.reduceat(copies & _U(3), np.flatnonzero(first))
            alone = np.repeat(np.add.reduceat(first.astype(np.int64), heads) == 1, spread)
            cols[6] = np.zeros(len(anchor), np.uint64)
            cols[6][first] = np.minimum(total, 2) | alone[first].astype(np.uint64) << _U(2)
            cols = [c[keep] for c in cols]
        cols = [c.view(np.int64) for c in cols]
        del parts
        release()
        return pa.table({n: pa.array(c, t, mask=c == 0 if n == "copies" else None) for n, c, t in zip(_FIELDS, cols, (
            pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()))})
    return _occurrence_blocks(docs, bits).groupBy("shard").applyInArrow(merge, OCCURRENCES)


def _with_keys(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of docs with (left_semi) or without (left_anti) a key: the keys are broadcast up to BROADCAST_ROWS of them."""
    few = keys.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(keys) if few else keys, ["k1", "k2"], how)


ALONE = 4
PARTS = "array<struct<anchor: long, seg: long, at: long, size: long>>"
TEXTS = "anchor long, seg long, copies int, text binary, parts " + PARTS
_PARTS = pa.list_(pa.struct([(n, pa.int64()) for n in ("anchor", "seg", "at", "size")]))


def _stretches(rows: list[dict]):
    """(first row, end, copies, parts) of a text's segments. Neighbours that are alone with their anchors meet no other segment in
    any shard; with equal copies they go as one stretch instead of as segments that overlap by nearly LENGTH."""
    out = []
    for r in sorted(rows, key=lambda r: r["start"]):
        copies, end = r["copies"] & 3, r["start"] + r["size"]
        part = {"anchor": r["anchor"], "seg": r["seg"], "at": 0, "size": r["size"]}
        if out and r["copies"] & ALONE and out[-1][3] and out[-1][2] == copies and out[-1][1] == r["start"] + LENGTH - 1:
            part["at"] = r["start"] - out[-1][0]["start"]
            out[-1][1] = end
            out[-1][3].append(part)
        else:
            out.append([r, end, copies, [part] if r["copies"] & ALONE else None])
    return out


def segment_texts(docs: DataFrame, occurrences: DataFrame) -> DataFrame:
    """TEXTS: one row per distinct segment, or per stretch of segments (parts) alone with their anchors."""
    def cut(batches):
        def packed(out):
            anchor, seg, copies, text, parts = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array(seg, pa.int64()), pa.array(copies, pa.int32()),
                                               pa.array(text, pa.binary()), pa.array(parts, _PARTS)],
                                              names=["anchor", "seg", "copies", "text", "parts"])
        for b in batches:
            out = []
            for raw, rows in zip(b.column(0).cast(pa.large_binary()), b.column(1)):
                raw = raw.as_py()
                out += [(r["anchor"], r["seg"], copies, raw[r["start"]:end], parts) for r, end, copies, parts in _stretches(rows.as_py())]
                if len(out) >= 20_000:
                    yield packed(out)
                    out = []
            if out:
                yield packed(out)
    held = occurrences.filter("copies IS NOT NULL")
    wanted = held.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "seg", "start", "size", "copies")).alias("rows"))
    texts = _with_keys(docs.select("k1", "k2", "text"), held.select("k1", "k2").distinct(), "left_semi")
    return texts.join(wanted, ["k1", "k2"]).select("text", "rows").mapInArrow(cut, TEXTS).dropDuplicates(["anchor", "seg"])


PACKED, START = 7, 28  # symbols of nine bits in one sort key; the depth from which intervals are extended


def sorted_suffixes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text of symbols below 512, its last the only 0, sorted by at least LENGTH symbols; and the boundaries by the
    first START ones alone."""
    n = len(text)
    padded = np.append(text, np.zeros(PACKED, np.uint16)).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(PACKED):
        key = key << _U(9) | padded[i:i + n]
    sa = np.argsort(key)
    new = np.append(True, key[sa][1:] != key[sa][:-1])
    first, width = None, PACKED
    rank = np.zeros(n + 1, np.int64)  # the place after the end ranks 0, all others more
    while width < LENGTH:
        if width == START:
            first = new.copy()
        rank[sa] = np.flatnonzero(new)[np.cumsum(new) - 1] + 1
        loose = np.flatnonzero(~(new & np.append(new[1:], True)))  # not yet alone
        if not len(loose):
            break
        key = rank[sa[loose]] * (n + 1) + rank[np.minimum(sa[loose] + width, n)]
        order = np.argsort(key)
        sa[loose], key = sa[loose][order], key[order]
        new[loose] = np.append(True, key[1:] != key[:-1])
        width *= 2
    return sa, new if first is None else first


def bounded_boundaries(text: np.ndarray, sa: np.ndarray, boundary: np.ndarray, depth: int = START, length: int = LENGTH) -> np.ndarray:
    """Where neighbours in suffix order share fewer than `length` symbols: extends the boundaries known at `depth`."""
    n = len(text)
    bwt = text[sa - 1].astype(np.int64)  # the symbol before; the whole text has the closing 0 before it
    by_symbol = np.argsort(bwt * n + np.arange(n))
    ranks = bwt[by_symbol] * (n + 1) + by_symbol  # sorted: rank of (symbol, place)
    step = np.empty(n, np.int64)
    step[by_symbol] = np.arange(n)
    found = np.append(boundary, True)
    low = np.flatnonzero(boundary)
    high = np.append(low[1:], n)  # exclusive
    for _ in range(depth, length):
        size = high - low
        one = size == 1
        lo, hi = step[low[one]], step[low[one]] + 1
        low, high, size = low[~one], high[~one], size[~one]
        if len(low):
            which = np.repeat(np.arange(len(low)), size)
            at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[which]
            pair = np.unique(which << 9 | bwt[at])
            which, symbol = pair >> 9, (pair & 511) * (n + 1)
            lo = np.append(lo, np.searchsorted(ranks, symbol + low[which]))
            hi = np.append(hi, np.searchsorted(ranks, symbol + high[which]))
        fresh = ~found[hi]
        low, high = lo[fresh], hi[fresh]
        if not len(low):
            break
        found[high] = True
    return found[:n]


def repeated_places(texts: list[bytes], copies: np.ndarray) -> list[np.ndarray]:
    """For each segment the places from which LENGTH bytes occur in two or more places of all segments' copies."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begin, last = np.cumsum(sizes + 1) - sizes - 1, np.cumsum(sizes + 1) - 1
    text = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.uint16) + np.uint16(2)
    text[last], text[-1] = 1, 0  # segments end in a symbol of its own, the text in another
    sa, first = sorted_suffixes(text)
    boundary = bounded_boundaries(text, sa, first)
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    place = np.arange(len(text)) - begin[owner]
    weight = np.where(place <= (sizes - LENGTH)[owner], copies[owner], 0)[sa]
    heads = np.flatnonzero(boundary)
    total = np.add.reduceat(weight, heads)
    hit = (np.repeat(total, np.diff(np.append(heads, len(sa)))) >= 2) & (weight > 0)
    at = np.sort(sa[hit])
    return [at[a:b] - s for a, b, s in zip(np.searchsorted(at, begin), np.searchsorted(at, begin + sizes + 1), begin)]


def covered(places: np.ndarray) -> list[tuple[int, int]]:
    """Byte ranges covered by LENGTH bytes from each of the sorted places."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > LENGTH)
    return list(zip(places[np.append(0, cut + 1)].tolist(), (places[np.append(cut, len(places) - 1)] + LENGTH).tolist()))


SPANS = "anchor long, seg long, spans array<struct<lo: long, hi: long>>"


def expand(texts: DataFrame) -> DataFrame:
    """SPANS of the segments that hold repeats."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = total // INDEX_BYTES + 1

    def index(key, table):
        found = repeated_places(table.column("text").to_pylist(), table.column("copies").to_numpy().astype(np.int64))
        release()
        rows = []
        for anchor, seg, parts, places in zip(*(table.column(n).to_pylist() for n in ("anchor", "seg", "parts")), found):
            for p in parts or [{"anchor": anchor, "seg": seg, "at": 0, "size": 1 << 62}] if len(places) else []:
                lo, hi = np.searchsorted(places, [p["at"], p["at"] + p["size"] - LENGTH + 1])
                if lo < hi:
                    rows.append((p["anchor"], p["seg"], [{"lo": x, "hi": y} for x, y in covered(places[lo:hi] - p["at"])]))
        return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate((
            ("anchor", pa.int64()), ("seg", pa.int64()), ("spans", pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))))})
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards))
    return texts.withColumn("shard", shard).groupBy("shard").applyInArrow(index, SPANS)


def deal_hot(texts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(TEXTS without hot anchors' segments but with what they fall into, and how the latter map to the former or None)."""
    bound = max(HOT_SEGMENTS, texts.count() // HOT_ANCHORS)  # at most HOT_ANCHORS anchors exceed it
    hot = texts.groupBy("anchor").agg(F.count("*").alias("n"), F.min(F.struct("seg", "text")).alias("a"),
                                      F.max(F.struct("seg", "text")).alias("b")).filter(F.col("n") > bound)
    rows = hot.select("anchor", "a.text", F.col("b.text").alias("other")).collect()
    if not rows:
        return texts, None
    common = [np.intersect1d(*(gram_hashes(np.frombuffer(t, np.uint8)) >> _U(1) for t in (r.text, r.other))) for r in rows]
    common = np.unique(np.concatenate(common))
    hot = F.broadcast(hot.select("anchor"))

    def deal(batches):
        for b in batches:
            raw = b.column(3).cast(pa.large_binary())
            sizes = np.array([len(x.as_py()) for x in raw], np.int64)
            data, offsets = np.frombuffer(b"".join(raw.to_pylist()), np.uint8), np.append(0, np.cumsum(sizes))
            anchor, row, first, size, _ = segments(data, offsets, common)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([
                pa.array(anchor.view(np.int64)), pa.array(span_hashes(data, first, first + size).view(np.int64)),
                b.column(2).take(take), pa.array([data[f:f + s].tobytes() for f, s in zip(first.tolist(), size.tolist())], pa.binary()),
                b.column(0).take(take), b.column(1).take(take), pa.array(first - offsets[row], pa.int64())],
                names=["anchor", "seg", "copies", "text", "of_anchor", "of_seg", "at"])
    parts = stage(texts.join(hot, "anchor", "left_semi").mapInArrow(
        deal, "anchor long, seg long, copies int, text binary, of_anchor long, of_seg long, at long"), "segments")
    distinct = parts.groupBy("anchor", "seg").agg(F.least(F.sum("copies"), F.lit(2)).cast("int").alias("copies"),
                                                  F.first("text").alias("text"), F.lit(None).cast(PARTS).alias("parts"))
    return texts.join(hot, "anchor", "left_anti").unionByName(distinct), parts.drop("text", "copies")


def dedup(docs: DataFrame, keep_text: bool = True, carry=()) -> DataFrame:
    """DONE per document; kept: the bytes that stay, kept_text: them without characters cut in two (both null without keep_text); then
    the columns `carry` of docs, renamed _name."""
    carried = [f"_{c}" for c in carry]
    full, rows = keyed(docs, carry), keyed(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MAX_SHARDS, max(2, size // 2 // SHARD_BYTES)).bit_length()
    seen = stage(repeated_occurrences(rows, bits), "occurrences")
    texts = stage(segment_texts(rows, seen), "segments")
    judged, dealt = deal_hot(texts)
    spans = stage(expand(judged), "spans")
    if dealt is not None:
        moved = F.transform("spans", lambda s: F.struct((s["lo"] + F.col("at")).alias("lo"), (s["hi"] + F.col("at")).alias("hi")))
        back = dealt.join(spans, ["anchor", "seg"]).select(
            F.col("of_anchor").alias("anchor"), F.col("of_seg").alias("seg"), moved.alias("spans"))
        spans = stage(spans.unionAll(back.groupBy("anchor", "seg").agg(F.flatten(F.collect_list("spans")).alias("spans"))), "spans")
    found = stage(seen.select("anchor", "seg", "k1", "k2", "start").join(spans, ["anchor", "seg"]).select("k1", "k2", "start", "spans"), "found")
    cuts = found.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "spans")).alias("cuts"))

    def remove(batches):
        for b in batches:
            out = {n: [] for n in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text")}
            for text, cut in zip(b.column(1).cast(pa.large_binary()), b.column(2)):
                raw, kept, end, removed, n = text.as_py(), [], 0, 0, 0
                for lo, hi in sorted((c["start"] + s["lo"], c["start"] + s["hi"]) for c in cut.as_py() or () for s in c["spans"]):
                    if lo > end or not n:
                        kept.append(raw[end:lo])
                        n += 1
                    removed += max(hi - max(lo, end), 0)
                    end = max(end, hi)
                kept.append(raw[end:])
                rest = b"".join(kept)
                text = "".join(p.decode("utf-8", "ignore") for p in kept) if keep_text else None
                for name, value in zip(out, (len(raw), removed, n, hashlib.sha256(rest).hexdigest(), rest if keep_text else None, text)):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, t) for v, t in zip(
                out.values(), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()))), *b.columns[3:]],
                names=["doc_id", *out, *carried])

    keys = stage(found.select("k1", "k2").distinct(), "keys")
    touched = _with_keys(full, keys, "left_semi").join(cuts, ["k1", "k2"]).select("doc_id", "text", "cuts", *carried)
    clean = _with_keys(full, keys, "left_anti").select(
        "doc_id", "text", F.lit(None).cast(cuts.schema["cuts"].dataType).alias("cuts"), *carried)
    schema = ", ".join([DONE, *(f"`{c}` {full.schema[c].dataType.simpleString()}" for c in carried)])
    return touched.unionAll(clean).mapInArrow(remove, schema)
