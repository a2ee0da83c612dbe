"""Merkle manifest of a dataset, with hash states kept per parent.

Leaves are SHA-256 digests of rows; per source, every FAN consecutive nodes become their parent until one is left, the subroot; the
subroots, ordered by source, form the last tree. A parent keeps a copy of its hash state before each child slot. Folding a changed child
up resumes the state kept at its slot and hashes the replacement and the siblings to its right only; what lies to its left is in the state.

Distribution: leaves are sorted once by (source, doc_id, digest) over range partitions, and numbered by the partitions' counts, so a
source may span any number of tasks. `depth` levels of a tree are built in one group of at most FAN ** depth nodes; the next pass works
on those groups' tops, at DEPTH a 4096th of the rows. Each top then gets its way to the root: the runs it and its ancestors lie in. Groups of
leaves and their ways meet in one co-group, which folds and proves every leaf. Hash states live in the worker that folds: a parent's are
copied once, from its children's digests, and serve all leaves below it.

Fields enter a leaf as `-` if null, else UTF-8 byte count, `:` and value; digests are hashed as lower-case hex. A proof is the hash of all
siblings of a leaf and its ancestors, from the leaf's run up to the root's, left to right.

Defined cases: a null doc_id comes first in its source, rows of one doc_id go by digest, equal rows are leaves of their own, in any
order; a null source is the first, an empty one the next; a tree of one leaf is that leaf, and a table of one row has the proof of no sibling (the
hash of nothing); an empty table gives an empty result and no root; very long texts are hashed in Spark's own expressions, never sent to Python; extra columns are ignored.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barsmith.session import stage

FAN, DEPTH = 16, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    """The digest of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


# ---- positions

def placed(rows: DataFrame, within: list[str], order: list[Column]) -> DataFrame:
    """The rows staged with `tree` (a number of the group, rising with it), `pos` in it from 0 on and its size `n`.

    One range-partitioned sort; a row's place in its partition is its id's low half, and partitions add up by their counts.
    """
    by = [F.col(c).asc_nulls_first() for c in within] + order
    at = F.monotonically_increasing_id()
    rows = stage(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", at), "sorted")
    keys = [F.col(c).alias(f"_{c}") for c in within]
    parts = rows.groupBy(F.shiftright("_at", 33).alias("_part"), *keys).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    parts = stage(parts, "parts")
    group = Window.partitionBy(*[f"_{c}" for c in within])
    before = F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("*", F.min("_first").over(group).alias("tree"), F.sum("_n").over(group).alias("n"),
                         (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    same = F.shiftright("_at", 33) == F.col("_part")
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    gone = ["_at", "_part", "_first", "_n", "_shift", *[f"_{c}" for c in within]]
    return rows.join(parts, same).withColumn("pos", F.col("_at") + F.col("_shift")).drop(*gone)


# ---- trees

def parent(run: bytes) -> bytes:
    """The digest of a run of 32-byte digests, hashed as hex."""
    return hashlib.sha256(run.hex().encode()).digest()


def levels_of(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    levels = 0
    while FAN ** levels < n:
        levels += 1
    return levels


def climb(nodes: bytes, levels: int) -> list[bytes]:
    """Digests of a group's levels, end to end each: its nodes, their parents, ... `levels` up."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append(b"".join(parent(below[i:i + 32 * FAN]) for i in range(0, len(below), 32 * FAN)))
    return out


def run_of(level: bytes, at: int) -> bytes:
    """The run that node `at` of a level lies in."""
    first = at // FAN * FAN * 32
    return level[first:first + 32 * FAN]


class Parent:
    """A parent with the hash state before each child slot."""

    def __init__(self, run: bytes):
        self.text = run.hex().encode()
        state = hashlib.sha256()
        self.before = []
        for at in range(0, len(self.text), 64):
            self.before.append(state.copy())
            state.update(self.text[at:at + 64])
        self.digest = state.digest()

    def replaced(self, slot: int, digest: bytes) -> bytes:
        """The parent's digest with another child at `slot`: from the kept state, the replacement and what lies to its right."""
        state = self.before[slot].copy()
        state.update(digest.hex().encode())
        state.update(self.text[64 * (slot + 1):])
        return state.digest()

    def siblings(self, slot: int) -> bytes:
        return self.text[:64 * slot] + self.text[64 * (slot + 1):]


class Group:
    """The parents of a group's levels, and of the way from its top to the root: (run, slot) per level."""

    def __init__(self, nodes: bytes, levels: int, way: list[tuple[bytes, int]]):
        self.levels = [[Parent(run_of(level, at)) for at in range(0, len(level) // 32, FAN)] for level in climb(nodes, levels)[:-1]]
        self.way = [(Parent(run), slot) for run, slot in way]
        self.above = b"".join(p.siblings(slot) for p, slot in self.way)  # the same for all leaves
        self.nodes = nodes

    def fold(self, at: int, digest: bytes) -> bytes:
        """The root with `digest` as node `at`."""
        for level in self.levels:
            digest, at = level[at // FAN].replaced(at % FAN, digest), at // FAN
        for p, slot in self.way:
            digest = p.replaced(slot, digest)
        return digest

    def proof(self, at: int) -> bytes:
        """Hash of all siblings from node `at` up to the root."""
        state = hashlib.sha256()
        for level in self.levels:
            state.update(level[at // FAN].siblings(at % FAN))
            at //= FAN
        state.update(self.above)
        return state.digest()


def _nodes(table: pa.Table) -> bytes:
    """The digests of a group's rows in order of `pos`."""
    return b"".join(table.sort_by("pos").column("node").to_pylist())


def _levels_left(table: pa.Table, below: int, depth: int) -> int:
    return min(depth, max(0, levels_of(table.column("n")[0].as_py()) - below))


def pass_up(nodes: DataFrame, below: int, depth: int) -> DataFrame:
    """(tree, pos, n, node) of one level -> (tree, pos, n, node) of the groups' tops, `below` levels over the leaves already."""
    def build(table: pa.Table) -> pa.Table:
        top = climb(_nodes(table), _levels_left(table, below, depth))[-1]
        return pa.table({"tree": table.column("tree")[:1], "pos": pa.array([table.column("pos")[0].as_py() // FAN ** depth], pa.int64()),
                         "n": table.column("n")[:1], "node": pa.array([top[:32]], pa.binary())})

    return _grouped(nodes, depth).applyInArrow(build, "tree long, pos long, n long, node binary")


def _part(depth: int) -> Column:
    """The group of FAN ** depth nodes that one at `pos` lies in."""
    return F.floor(F.col("pos") / FAN ** depth).alias("part")


def _grouped(nodes: DataFrame, depth: int):
    return nodes.select("tree", "pos", "n", "node", _part(depth)).groupBy("tree", "part")


def way_up(nodes: DataFrame, below: int, depth: int) -> DataFrame:
    """(tree, pos, runs, slots): the runs that each node and its ancestors lie in, up to its group's top."""
    def runs(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        levels = climb(_nodes(table), _levels_left(table, below, depth))[:-1]
        found = [[(run_of(level, at // FAN ** i), at // FAN ** i % FAN) for i, level in enumerate(levels)] for at in range(len(table))]
        return pa.table({"tree": table.column("tree"), "pos": table.column("pos"),
                         "runs": pa.array([[run for run, _ in f] for f in found], pa.list_(pa.binary())),
                         "slots": pa.array([[slot for _, slot in f] for f in found], pa.list_(pa.int32()))})

    return _grouped(nodes, depth).applyInArrow(runs, "tree long, pos long, runs array<binary>, slots array<int>")


def trees(leaves: DataFrame, most: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """For placed (tree, pos, n, node): the root of each tree (tree, root), and the way from each group of FAN ** depth
    leaves (tree, part, runs, slots) to it. `most` is the size of the largest tree: it gives the number of passes."""
    tops, below = stage(pass_up(leaves, 0, depth), "tops"), depth
    groups = tops.select("tree", F.col("pos").alias("part"))
    groups = groups.select("*", F.array().cast("array<binary>").alias("runs"), F.array().cast("array<int>").alias("slots"))
    while FAN ** below < most:
        up = way_up(tops, below, depth).select(F.col("tree").alias("_tree"), F.col("pos").alias("_pos"), F.col("runs").alias("_runs"), F.col("slots").alias("_slots"))
        at = F.floor(F.col("part") / F.lit(FAN ** (below - depth)))
        groups = groups.join(up, (F.col("tree") == F.col("_tree")) & (at == F.col("_pos"))).select(
            "tree", "part", F.concat("runs", "_runs").alias("runs"), F.concat("slots", "_slots").alias("slots"))
        groups = stage(groups, "ways")
        tops, below = stage(pass_up(tops, below, depth), "tops"), below + depth
    return tops.select("tree", F.col("node").alias("root")), groups


OUT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, changed: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified per row.

    `changed` replaces the text where it is not null (where null, the row is as it was): the root folded from the row's new leaf and the kept
    states, and whether it is the manifest's.
    """
    new = F.lit(None).cast("binary") if changed is None else leaf(*[F.col(c) for c in FIELDS[:-1]], changed)
    rows = docs.select("source", F.col("doc_id").cast("long"), leaf(*[F.col(c) for c in FIELDS]).alias("node"),
                       (F.when(changed.isNotNull(), new) if changed is not None else new).alias("new"),
                       F.xxhash64(F.monotonically_increasing_id()).alias("tie"))  # equal rows may be many: deal them over partitions too
    rows = placed(rows, ["source"], [F.col("doc_id").asc_nulls_first(), F.col("node"), F.col("tie")])
    sources = stage(rows.groupBy("tree").agg(F.max("n").alias("n")), "trees")
    subroots, ways = trees(rows, sources.agg(F.max("n")).first()[0] or 0, depth)
    # the last tree: subroots in order of source, which `tree` follows
    tops = placed(subroots.withColumnsRenamed({"tree": "of", "root": "node"}), [], [F.col("of")])
    tops = stage(tops, "subroots")
    root, top_ways = trees(tops, sources.count(), depth)
    upper = _last_ways(tops, top_ways, root, depth)
    ways = ways.join(upper, ways["tree"] == upper["of"]).select(
        "tree", "part", F.concat("runs", "up_runs").alias("runs"), F.concat("slots", "up_slots").alias("slots"), "subroot", "root")

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("pos")
        way = right.to_pylist()[0]
        nodes = left.column("node").to_pylist()
        group = Group(b"".join(nodes), _levels_left(left, 0, depth), list(zip(way["runs"], way["slots"])))
        folded = [group.fold(at, new or node) for at, (node, new) in enumerate(zip(nodes, left.column("new").to_pylist()))]
        root, n = way["root"], len(left)
        return pa.table({"doc_id": left.column("doc_id"), "leaf": [x.hex() for x in nodes], "subroot": [way["subroot"].hex()] * n,
                         "root": [root.hex()] * n, "proof_sha256": [group.proof(at).hex() for at in range(n)],
                         "folded_root": [x.hex() for x in folded], "verified": [x == root for x in folded]})

    leaves = rows.select("tree", _part(depth), "pos", "n", "doc_id", "node", "new")
    return leaves.groupBy("tree", "part").cogroup(ways.groupBy("tree", "part")).applyInArrow(judge, OUT)


def _last_ways(tops: DataFrame, ways: DataFrame, root: DataFrame, depth: int) -> DataFrame:
    """(of, subroot, up_runs, up_slots, root): from each subroot through the tree of subroots to the root."""
    inside = way_up(tops, 0, depth)
    ways = ways.withColumnsRenamed({"runs": "far", "slots": "far_slots"}).join(root, "tree")
    inside = inside.withColumn("part", _part(depth)).join(ways, ["tree", "part"])
    inside = inside.select("pos", F.concat("runs", "far").alias("up_runs"), F.concat("slots", "far_slots").alias("up_slots"), "root")
    return tops.select("of", F.col("node").alias("subroot"), "pos").join(inside, "pos").drop("pos")


def tampered(docs: DataFrame) -> Column:
    """The text with A-Z lower-cased, where 5 divides the crc32 of the decimal doc_id; else null."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(hit, F.translate(F.col("text"), UPPER, LOWER))
