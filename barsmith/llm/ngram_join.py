"""Exact n-gram Jaccard self-join of texts with PartEnum signatures.

Sets of five-word shingles link when 100 * |r & s| >= 75 * |r | s|. Sizes fall into bands; such a pair lies in one band or in
two neighbours, so each band is one instance that takes its own and the next band's sets, with k, the largest symmetric
difference of a linked pair of it. The shingle domain is hashed into partitions and subsets of them are enumerated:
up to k = 3 all triples of k + 3 partitions, beyond it each of k + 1 + m partitions alone. Whatever the k differing
shingles hit, one enumerated subset is hit by none and both sets share its signature.

A projection that is empty, or holds only very common shingles, would match unrelated texts. It is weak and not sent, as
long as at most m of a set's are: then some strong one still agrees. A set with more weak ones also takes part in a further
instance with another hash seed, which every other such set joins too, and after SEEDS of them it sends all.

Equal sets join as one class. Signatures go to shards in packed blocks. Per shard, those of two or more sets remain. A linked
pair agrees in all the subsets that its differing shingles leave, so of each instance a set must share as many signatures as it
sent less those; sets that share fewer go. Every class joins the family of the leader it shares most signatures with (a signature's
leader is the class that meets most others), then moves to the family with most members at most of its signatures. A family is compared within, in blocks of bounded size, by products of
incidence matrices that emit only links enough to connect it; then all pairs of different families that share a
signature and are not yet in one component are compared one by one. So large groups of near copies, and of texts not quite near
enough, emit no pairs, and no link between components is missed.

Within the join a row goes by its doc_id, if all rows with it have equal sets, and else by its set's hash.

Defined cases: null and empty texts have no shingles and link with nothing; fewer than five words are one shingle; repeated
rows are equal sets; rows without a doc_id or sharing one each link by their own text; a null doc_id takes part but never
names a component, and is one's component_id only where no linked row has a doc_id; an empty table gives an empty result; extra
columns are ignored.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm.arrays import claim, delta_planes, from_delta_planes, from_planes, mix, planes, release, text_slices, words
from barsmith.llm.graph import components
from barsmith.session import stage_freed

WIDTH, NUM, DEN = 5, 3, 4  # five words; similarity 3/4
SEEDS, COMMON = 6, 0.002
BLOCK_SETS, MOVES, DENSE = 512, 1, 500
SLICE, FLUSH, SHARD_BYTES, MAX_SHARDS = 1 << 20, 700_000, 16 << 20, 4096
BROADCAST_ROWS = 1_000_000  # of doc_ids: 8 MB
SETS = "doc_id long, text_hash long, n long, h1 long, h2 long, common long"
_U = np.uint64


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, one after the other, and where each row's begin (one more at the end)."""
    hashed, first = words(data, offsets)
    counts = np.diff(first)
    n = np.where(counts >= WIDTH, counts - WIDTH + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[:-1][row]
    used = np.minimum(counts, WIDTH)[row]
    h = used.astype(np.uint64)
    for t in range(WIDTH):
        on = used > t
        h[on] = mix(h[on] * _U(0xD1342543DE82EF95) + hashed[at[on] + t])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(n) + 1))


def _sums(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h, out=total[1:])
    return total[begin[1:]] - total[begin[:-1]]


def set_hashes(h: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return _sums(mix(h), begin).view(np.int64), _sums(mix(h ^ _U(0x5851F42D4C957F2D)), begin).view(np.int64)


def describe_sets(docs: DataFrame, common: float = COMMON) -> DataFrame:
    """SETS: a row per document with its text's hash and its set's size and 128-bit hash; and a row per shingle that a run of documents holds
    often (doc_id null, common the shingle, n in how many): whatever `common` of all rows hold, some run holds as often."""
    def run(batches):
        claim("ngram_join")
        for b in batches:
            for lo, hi, data, offsets in text_slices(b.column(1), SLICE):
                h, begin = shingles(data, offsets)
                h1, h2 = set_hashes(h, begin)
                often, held = np.unique(h, return_counts=True)
                top = held >= max(3, common * (hi - lo))
                none = pa.nulls(int(top.sum()), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    *(pa.concat_arrays([b.column(i)[lo:hi].cast(pa.int64()), none]) for i in (0, 2)),
                    pa.array(np.concatenate([np.diff(begin), held[top]]).astype(np.int64)),
                    pa.concat_arrays([pa.array(h1), none]), pa.concat_arrays([pa.array(h2), none]),
                    pa.concat_arrays([pa.nulls(hi - lo, pa.int64()), pa.array(often[top].view(np.int64))])],
                    names=["doc_id", "text_hash", "n", "h1", "h2", "common"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), text_hash()).mapInArrow(run, SETS)


def text_hash():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash")


def named(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """rows with `name`: the doc_id, or null where it is null or in `shared`, so that the set's hash names the row."""
    n = shared.count()
    if not n:
        return rows.withColumn("name", F.col("doc_id"))
    held = shared.withColumn("held", F.lit(True))
    return rows.join(F.broadcast(held) if n <= BROADCAST_ROWS else held, "doc_id", "left").withColumn(
        "name", F.when(F.col("held").isNull(), F.col("doc_id"))).drop("held")


def names_of(ids: pa.Array, h1: np.ndarray) -> np.ndarray:
    return np.where(np.asarray(ids.is_null()), h1, np.asarray(ids.fill_null(0)))


def bands(largest: int) -> list[int]:
    """Lower ends of the size bands, up to one that lies above `largest`: a linked set at most reaches the next band."""
    ends = [1]
    while ends[-1] <= largest:
        below = (ends[-1] - 1) if len(ends) > 1 else 0
        ends.append(max(ends[-1] + 1, below * DEN // NUM + 1))
    return ends


class Instance:
    """Partitions and subsets for sets of band `b` and the next one."""

    def __init__(self, b: int, ends: list[int]):
        self.r = r = ends[b + 1] - 1
        self.b, self.k = b, (r + r * DEN // NUM) // (NUM + DEN)
        if self.k <= 3:
            self.parts, self.spare = self.k + 3, 0
            self.subsets = np.array(list(combinations(range(self.parts), 3)))
        else:
            self.spare = self.k // 4 + 2
            self.parts = self.k + 1 + self.spare
            self.subsets = None

    def need(self, n: np.ndarray, sent: np.ndarray) -> np.ndarray:
        """How many of the signatures it sent a set of n shingles at least shares with any set linked to it."""
        r = self.r
        differ = np.where(n <= r, n + n * DEN // NUM, n + r) // (NUM + DEN)
        if self.subsets is not None:
            free = np.maximum(self.parts - differ, 0)
            differ = len(self.subsets) - free * (free - 1) * (free - 2) // 6
        return np.maximum(sent - differ, 1)

    def signatures(self, h: np.ndarray, begin: np.ndarray, strong: np.ndarray):
        """For the sets h[begin[i]:begin[i+1]], per seed: (set number, signature) arrays; and the slot, the numbers of the sets
        that took part and how many signatures each sent. strong marks shingles that are not common. The low bits
        of a signature are its slot: the seed and whether the band is odd."""
        sizes = np.diff(begin)
        sets, own = np.arange(len(sizes)), np.repeat(np.arange(len(sizes)), sizes)
        for seed in range(SEEDS):
            salt = mix(np.array([self.b * 1000 + seed + 7], np.uint64))[0]
            part = ((mix(h ^ salt) >> _U(32)) * _U(self.parts) >> _U(32)).astype(np.int64)
            cell = own * self.parts + part
            sums = np.zeros(len(sets) * self.parts, np.uint64)
            np.add.at(sums, cell, mix(h + salt))
            live = np.zeros(len(sums), bool)
            live[cell[strong]] = True
            sums, live = sums.reshape(-1, self.parts), live.reshape(-1, self.parts)
            if self.subsets is not None:
                sums = sums[:, self.subsets].sum(axis=2, dtype=np.uint64)
                live = live[:, self.subsets].any(axis=2)
            signs = mix(sums + mix(salt + np.arange(sums.shape[1], dtype=np.uint64)))
            again = (~live).sum(axis=1) > self.spare
            if seed == SEEDS - 1:
                live[again] = True
            i, j = np.nonzero(live)
            slot = (self.b & 1) << 3 | seed
            yield sets[i], signs[i, j] & ~_U(15) | _U(slot), slot, sets, live.sum(axis=1)
            if not again.any():
                return
            keep = again[own]
            h, strong = h[keep], strong[keep]
            own = (np.cumsum(again) - 1)[own[keep]]
            sets = sets[again]


def signature_blocks(docs: DataFrame, ends: list[int], often: np.ndarray, bits: int) -> DataFrame:
    """shard, block: sorted signatures and the names (doc_id) they come from, of texts without one their set's hash; a run's equal sets send theirs once. Shards from
    2**bits on hold what each document needs (Instance.need) by slot."""
    def needs(held):
        slot, doc, need = (np.concatenate(x).astype(np.uint64) for x in zip(*held))
        shard = (mix(doc) & _U(15)).astype(np.int64)
        for s in np.unique(shard):
            at = shard == s
            yield pa.RecordBatch.from_arrays([pa.array([int(s) + (1 << bits)], pa.int32()), pa.array(
                [planes(slot[at]) + planes(doc[at]) + planes(need[at])], pa.binary())], names=["shard", "block"])

    def blocks(held):
        sign, doc = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(sign)
        sign, doc = sign[order], doc[order]
        cuts = np.searchsorted(sign >> _U(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        found = np.flatnonzero(np.diff(cuts))
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([
            delta_planes(sign[cuts[s]:cuts[s + 1]]) + planes(doc[cuts[s]:cuts[s + 1]].view(np.uint64)) for s in found], pa.binary())],
            names=["shard", "block"])

    def run(batches):
        instances = [Instance(b, ends) for b in range(len(ends) - 1)]
        held, size, owed = [], 0, []
        for b in batches:
            for lo, hi, data, offsets in text_slices(b.column(1), SLICE):
                h, begin = shingles(data, offsets)
                h1, _ = set_hashes(h, begin)
                ids = names_of(b.column(0)[lo:hi], h1)
                sizes = np.diff(begin)
                once = np.unique(h1, return_index=True)[1]
                once = once[sizes[once] > 0]
                band = np.searchsorted(ends, sizes[once], "right") - 1
                common = np.isin(h, often) if len(often) else np.zeros(len(h), bool)
                for k in np.unique(band):
                    own = once[band == k]
                    at = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in own])
                    starts = np.append(0, np.cumsum(sizes[own]))
                    for inst in instances[max(k - 1, 0):k + 1]:
                        for i, sign, slot, took, sent in inst.signatures(h[at], starts, ~common[at]):
                            held.append((sign, ids[own[i]]))
                            owed.append((np.full(len(took), slot), ids[own[took]], inst.need(sizes[own[took]], sent)))
                            size += len(sign)
                if size >= FLUSH:
                    yield from blocks(held)
                    yield from needs(owed)
                    held, size, owed = [], 0, []
        if size:
            yield from blocks(held)
            yield from needs(owed)
        del held, owed
        release()
    return docs.select("doc_id", "text").mapInArrow(run, "shard int, block binary")


def shared_signatures(blocks: DataFrame, bits: int) -> DataFrame:
    """sign, doc_id: the signatures that two or more documents share, by their number among the shard's (the low bits are still the slot):
    numbers shrink in the shuffles to come, hashes do not. Where need is not null, sign is a slot of which the document shares that
    many with any linked one."""
    def merge(key, table):
        if key[0].as_py() >= 1 << bits:
            blocks_ = [b.as_py() for b in table.column("block")]
            slot, doc, need = (np.concatenate([from_planes(x[i * len(x) // 3:(i + 1) * len(x) // 3]) for x in blocks_]).view(
                np.int64) for i in range(3))
            return pa.table({"sign": slot, "doc_id": doc, "need": need})
        signs, docs = [], []
        for block in table.column("block"):
            raw = block.as_py()
            signs.append(from_delta_planes(raw[:len(raw) // 2]))
            docs.append(from_planes(raw[len(raw) // 2:]))
        sign, doc = np.concatenate(signs), np.concatenate(docs)
        order = np.argsort(sign)
        sign, doc = sign[order], doc[order]
        new = np.ones(len(sign) + 1, bool)
        new[1:-1] = sign[1:] != sign[:-1]
        several = ~(new[1:] & new[:-1])
        number = np.cumsum(new[:-1][several]) | key[0].as_py() << 40
        return pa.table({"sign": number << 4 | (sign[several] & _U(15)).view(np.int64), "doc_id": doc[several].view(np.int64),
                         "need": pa.nulls(int(several.sum()), pa.int64())})
    return blocks.groupBy("shard").applyInArrow(merge, "sign long, doc_id long, need long")


def shingle_arrays(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, shingles array<long> of the names in `wanted` (doc_id). The wanted ids are broadcast up to
    BROADCAST_ROWS of them; beyond, the texts are shuffled to them."""
    def run(batches):
        for b in batches:
            for lo, hi, data, offsets in text_slices(b.column(1), SLICE):
                h, begin = shingles(data, offsets)
                names = names_of(b.column(0)[lo:hi], set_hashes(h, begin)[0])
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.ListArray.from_arrays(
                    pa.array(begin, pa.int32()), pa.array(h.view(np.int64)))], names=["doc_id", "shingles"])
    few = wanted.count() <= BROADCAST_ROWS
    schema, rows, wanted = "doc_id long, shingles array<long>", docs.select("doc_id", "text"), F.broadcast(wanted) if few else wanted
    found = rows.join(wanted, "doc_id", "left_semi").mapInArrow(run, schema)
    unnamed = rows.filter("doc_id IS NULL")
    if not unnamed.isEmpty():
        found = found.unionAll(unnamed.mapInArrow(run, schema).join(wanted, "doc_id", "left_semi"))
    return found.dropDuplicates(["doc_id"])


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, exactly counted."""
    one, other = (sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(one, "a").join(other, "b").filter(
        both * DEN >= NUM * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections: shingles that many sets hold by a matrix product, the others place by place."""
    g = len(sets)
    own = np.repeat(np.arange(g), [len(x) for x in sets])
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = df > max(1, g // 100)
    name = np.cumsum(often) - 1
    dense = np.zeros((g, int(often.sum())), np.float32)
    at = often[column]
    dense[own[at], name[column[at]]] = 1
    out = (dense @ dense.T).astype(np.int32)
    rest = np.flatnonzero(~at & (df[column] > 1))
    rest = rest[np.argsort(column[rest], kind="stable")]
    size = df[column[rest]]
    first = np.flatnonzero(np.append(True, np.diff(column[rest]) != 0)) if len(rest) else rest
    head = np.repeat(first, size[first])
    i = np.repeat(np.arange(len(rest)), size)
    j = np.repeat(head, size) + np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size)
    np.add.at(out, (own[rest[i]], own[rest[j]]), 1)
    np.fill_diagonal(out, [len(x) for x in sets])
    return out


def _connect(key, table):
    """a, b: links that connect what links connect among the sets of a table (class, shingles)."""
    classes = table.column("class").to_numpy()
    sets = [x.values.to_numpy() for x in table.column("shingles")]
    size = np.array([len(x) for x in sets])
    both = overlaps(sets)
    link = both * DEN >= NUM * (size[:, None] + size[None, :] - both)
    left, edges = np.ones(len(sets), bool), []
    for start in range(len(sets)):
        reach = [start] if left[start] else []
        left[start] = False
        while reach:
            x = reach.pop()
            new = np.flatnonzero(link[x] & left)
            left[new] = False
            reach += new.tolist()
            edges += [(classes[x], classes[y]) for y in new]
    return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})


def link_classes(busy: DataFrame, arrays: DataFrame) -> DataFrame:
    """a, b: links enough to connect all classes of `busy` (sign, class, n) that links connect."""
    meets = busy.join(busy.groupBy("sign").agg(F.count("*").alias("size")), "sign").groupBy("class").agg(F.sum("size").alias("meets"))
    leads = busy.join(meets, "class").groupBy("sign").agg(F.max_by("class", F.struct("meets", F.bitwise_not("class"))).alias("lead"))
    votes = busy.join(leads, "sign").groupBy("class", "lead").agg(F.count("*").alias("votes"))
    homes = stage_freed(votes.groupBy("class").agg(F.max_by("lead", F.struct("votes", F.bitwise_not("lead"))).alias("home")), "homes")
    for _ in range(MOVES):  # then moves to the family that leads most of its signatures
        held = busy.select("sign", "class").join(homes, "class")
        ruling = held.groupBy("sign", "home").agg(F.count("*").alias("k")).groupBy("sign").agg(
            F.max_by("home", F.struct("k", F.bitwise_not("home"))).alias("ruler"), F.max("k").alias("k"))
        counted = held.join(ruling, "sign").groupBy("class", "ruler").agg(F.count("*").alias("votes"), F.max("k").alias("k"))
        homes = stage_freed(counted.groupBy("class").agg(F.max_by("ruler", F.struct("votes", "k", F.bitwise_not("ruler"))).alias("home")), "homes")
    links = _products(homes, arrays)

    def still_apart(links, homes):
        """Rows of the signatures that classes of different components and families share."""
        label = busy.join(homes, "class").join(components(links).withColumnRenamed("node", "class"), "class", "left").select(
            "sign", "class", "n", "home", F.coalesce("component", "class").alias("component"))
        mixed = label.groupBy("sign").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("home").alias("h1"),
                                          F.max("home").alias("h2")).filter("lo < hi AND h1 < h2")
        return stage_freed(label.join(mixed, "sign", "left_semi"), "open")

    # Families that share very many signatures are compared as one.
    open_ = still_apart(links, homes)
    at = open_.groupBy("sign", "home").agg(F.count("*").alias("k"))
    dense = at.alias("x").join(at.alias("y"), F.expr("x.sign = y.sign AND x.home < y.home")).groupBy(
        F.col("x.home").alias("a"), F.col("y.home").alias("b")).agg(F.sum(F.expr("x.k * y.k")).alias("rows")).filter(F.col("rows") >= DENSE)
    groups = components(dense.select("a", "b"))
    merged = open_.select("class", "home").distinct().join(
        groups.select(F.col("node").alias("home"), F.col("component").alias("group")), "home").select("class", F.col("group").alias("home"))
    links = links.unionAll(_products(merged, arrays))
    homes = stage_freed(homes.join(groups.select(F.col("node").alias("home"), F.col("component").alias("group")), "home", "left").select(
        "class", F.coalesce("group", "home").alias("home")), "homes")
    open_ = still_apart(links, homes)
    apart = open_.alias("x").join(open_.alias("y"), F.expr(
        f"x.sign = y.sign AND x.home < y.home AND x.component != y.component AND x.n * {DEN} >= y.n * {NUM} "
        f"AND y.n * {DEN} >= x.n * {NUM}")).select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()
    return links.unionAll(stage_freed(linked(apart, arrays), "links"))


def _products(homes: DataFrame, arrays: DataFrame) -> DataFrame:
    """a, b: links enough to connect each family of homes (class, home). A family falls into blocks of about BLOCK_SETS, and each
    pair of blocks is one task's: a set goes to as many as there are blocks."""
    members = homes.unionAll(homes.select(F.col("home").alias("class"), "home")).distinct()
    spread = members.groupBy("home").agg(F.count("*").alias("g")).filter("g > 1").select("home", F.ceil(F.col("g") / BLOCK_SETS).alias("blocks"))
    own = F.pmod(F.xxhash64("class"), F.col("blocks"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda i: F.struct(
        F.least(i, F.col("own")).alias("i"), F.greatest(i, F.col("own")).alias("j")))
    dealt = members.join(spread, "home").withColumn("own", own).select("class", "home", F.explode(pairs).alias("part"))
    held = dealt.join(arrays.withColumnRenamed("doc_id", "class"), "class")
    return stage_freed(held.groupBy("home", "part").applyInArrow(_connect, "a long, b long"), "links")


def row_components(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n, component, component_id per row: component names the linked texts, null where n is 0; component_id is the
    least doc_id among their rows, null where they have none."""
    described = stage_freed(describe_sets(docs), "sets")
    sets = described.filter("common IS NULL")
    facts = sets.agg(F.count("*"), F.max("n"), F.sum("n")).first()
    rows, largest, total = facts[0], facts[1] or 0, facts[2] or 0
    # At most total / (COMMON * rows) shingles can be as common as this: some 1/COMMON times the mean set size.
    often = described.filter("common IS NOT NULL").groupBy("common").agg(F.sum("n").alias("n")).filter(
        F.col("n") >= max(3, COMMON * rows)).select("common").collect()
    often = np.sort(np.array([r[0] for r in often], np.int64).view(np.uint64))
    bits = min(MAX_SHARDS, max(2, total * 16 // SHARD_BYTES)).bit_length()
    ends = bands(largest)
    key = ["n", "h1", "h2"]
    same = F.struct(*key)
    several = stage_freed(sets.filter("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(same).alias("lo"), F.max(same).alias("hi")).filter("lo != hi").select("doc_id"), "several")
    texts = named(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), several).select(
        F.col("name").alias("doc_id"), "text")
    sets = named(sets, several).withColumn("name", F.coalesce("name", "h1"))
    shared = stage_freed(shared_signatures(signature_blocks(texts, ends, often, bits), bits), "signatures")

    classes = sets.filter("n > 0").groupBy(*key).agg(F.min("name").alias("class"), F.min("doc_id").alias("least"))
    members = sets.filter("n > 0").select(F.col("name").alias("doc_id"), *key).distinct().join(classes, key).select("doc_id", "class", "n")
    known = shared.join(members, "doc_id").select("sign", "class", "n", "need")
    held = stage_freed(known.distinct(), "held")
    owed = held.filter("need IS NOT NULL").groupBy("class", F.col("sign").alias("slot")).agg(F.max("need").alias("need"))
    held = held.filter("need IS NULL").select("sign", "class", "n", F.col("sign").bitwiseAND(15).alias("slot"))
    several = held.groupBy("sign").agg(F.min("class").alias("lead"), F.max("class").alias("last")).filter("lead < last")
    shares = held.join(several, "sign", "left_semi")
    enough = shares.groupBy("class", "slot").agg(F.count("*").alias("has")).join(owed, ["class", "slot"]).filter("has >= need")
    busy = stage_freed(shares.join(enough, ["class", "slot"], "left_semi").select("sign", "class", "n"), "busy")
    arrays = stage_freed(shingle_arrays(texts, busy.select(F.col("class").alias("doc_id")).distinct()), "shingles")
    links = link_classes(busy, arrays)
    found = components(links)
    labels = stage_freed(classes.join(found.withColumnRenamed("node", "class"), "class", "left").select(
        *key, "class", "least", F.coalesce("component", "class").alias("component")), "labels")
    # A class is its least doc_id, and a component its least class, unless a hash names one.
    odd = labels.filter("least IS NULL OR least != class").select("component").distinct()
    tops = stage_freed(labels.join(odd, "component", "left_semi").groupBy("component").agg(F.min("least").alias("top")), "tops")
    if tops.isEmpty():
        labels = labels.withColumn("component_id", F.col("component"))
    else:
        labels = labels.join(tops.withColumn("odd", F.lit(True)), "component", "left").withColumn(
            "component_id", F.when(F.col("odd"), F.col("top")).otherwise(F.col("component")))
    return sets.join(labels.select(*key, "component", "component_id"), key, "left").select(
        "doc_id", "text_hash", "n", "component", "component_id")


def join_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id per document."""
    return row_components(docs).select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
