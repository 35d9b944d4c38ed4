"""Conversation prefix trie, in balanced parentheses per shard, with shared spines merged.

A node is a distinct sequence of first turns; a conversation is a member of every node on
its way.  Conversations become paths of 128-bit turn hashes and are sorted by path and id
over the cluster, so a subtree is a run of them.  A task cuts its sorted rows into shards
of about SHARD_NODES turns and encodes the trie of a shard as balanced parentheses: a node
opens, its children follow, it closes.  The excess of open over closed parentheses has a
tree of block minima, by which ``find_close`` ends each node's subtree; the rank of "()"
pairs counts its leaves, and cumulative arrays over the openings give its sums.

Only nodes on the path of a shard's first or last conversation, its spine, can lie in other
shards as well.  They alone are shuffled: a node belongs to the first shard that has it, what
later shards counted for it again is taken off along their spines, and the parts are added
up.  Other nodes are final where they are, but for the id of a parent on the spine.

The ids that end at a node are hashed as they stream by in order; those of a spine node
travel as strings of PIECE_IDS ids and are hashed in shard order, so a conversation of
which there are many copies is never held as one list.

Defined results: turns are ordered by ``turn``, null first, equal ones by the hash of role
and text; repeated rows are repeated turns; null role or text is empty; rows without conv_id
are in no conversation and are left out; an empty table has no node, not even the root;
only the four columns are read.  One conversation's own turns are held together, as its
rebuilt path is one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, shared_dir, written

#: Turns of a shard, about; a longer conversation is a shard of its own.
SHARD_NODES = 200_000
PIECE_IDS = 5_000
#: Parentheses of a block of the minima tree.
BLOCK = 64
#: Hexadecimal digits of a turn in a path.
WIDTH = 32
ROOT = "root"
GROUP, SHARED = 100, 6

NODE = (
    "shard long, side string, depth int, node string, parent string, parent_side string, parent_depth int, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, childless boolean, chars long, total_chars long, node_chars long, ends_sha256 string, piece int, ends string"
)


def paths(conversations: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """(conv_id, path, chars): the rebuilt conversations, as turn hashes and code points a turn.

    The first h = crc32(id) % ``shared`` turns are those of the first conversation of the id's ``group``.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct("turn", F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("h"), F.length(text).cast("long").alias("n"))
    own = conversations.filter(F.col("conv_id").isNotNull()).groupBy(F.col("conv_id").cast("long").alias("conv_id"))
    own = own.agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    first = own.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, max(1, shared - 1)).alias("heads"))
    rows = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(first, "base", "left")
    rows = rows.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int"))
    none = F.slice("turns", 1, 0)
    heads = F.slice(F.coalesce("heads", none), F.lit(1), F.col("h"))
    tail = F.slice(F.col("turns"), F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    rows = rows.select("conv_id", F.concat(heads, tail).alias("turns"))
    return rows.select("conv_id", F.array_join(F.transform("turns", lambda t: t["h"]), "").alias("path"), F.transform("turns", lambda t: t["n"]).alias("chars"))


class Parentheses:
    """A trie as parentheses: ``bits`` are 1 where a node opens, ``opens`` where each one does, in order."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.opens = bits, np.flatnonzero(bits)
        self.excess = np.cumsum(bits.astype(np.int32) * 2 - 1)
        blocks = -(-len(bits) // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int32).max, np.int32)
        padded[: len(bits)] = self.excess
        self.rows = padded.reshape(blocks, BLOCK)
        self.leaf = 1 << max(0, (blocks - 1).bit_length())
        self.least = np.full(2 * self.leaf, np.iinfo(np.int32).max, np.int32)
        self.least[self.leaf : self.leaf + blocks] = self.rows.min(1)
        for i in range(self.leaf.bit_length() - 2, -1, -1):
            a = 1 << i
            self.least[a : 2 * a] = self.least[2 * a : 4 * a].reshape(-1, 2).min(1)

    def _within(self, block: np.ndarray, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place in each block, past ``after``, with an excess of ``target`` at most; -1: none."""
        out = np.empty(len(block), np.int64)
        for i in range(0, len(block), 1 << 14):
            s = slice(i, i + (1 << 14))
            met = (self.rows[block[s]] <= target[s, None]) & (np.arange(BLOCK) > after[s, None])
            at = met.argmax(1)
            out[s] = np.where(met[np.arange(len(at)), at], block[s] * BLOCK + at, -1)
        return out

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """Where the nodes that open at ``at`` close: the next place with one less of excess."""
        target = self.excess[at] - 1
        close = self._within(at // BLOCK, at % BLOCK, target)
        left = np.flatnonzero(close < 0)
        node, want = at[left] // BLOCK + self.leaf, target[left]
        up = np.ones(len(left), bool)
        while up.any():  # to the first subtree on the right that goes low enough
            u = np.flatnonzero(up)
            right = node[u] & 1 == 1
            beside = np.where(right, 0, node[u] + 1)
            found = ~right & (self.least[beside] <= want[u])
            node[u] = np.where(found, beside, node[u] >> 1)
            up[u[found]] = False
        while (node < self.leaf).any():  # all are as deep as another only after the last step
            d = np.flatnonzero(node < self.leaf)
            child = node[d] * 2
            node[d] = child + (self.least[child] > want[d])
        close[left] = self._within(node - self.leaf, np.full(len(left), -1), want)
        return close

    def leaf_pairs(self, close: np.ndarray) -> np.ndarray:
        """Leaves below each node: "()" pairs from its opening to its ``close``."""
        pair = np.zeros(len(self.bits) + 1, np.int64)
        pair[1:-1] = np.cumsum((self.bits[:-1] == 1) & (self.bits[1:] == 0))
        return pair[close] - pair[self.opens]


def shared_turns(a: str, b: str) -> int:
    """Turns at the beginning that two paths share."""
    n = min(len(a), len(b)) // WIDTH
    if a[: n * WIDTH] == b[: n * WIDTH]:
        return n
    low, high = 0, n
    while low < high - 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low * WIDTH : mid * WIDTH] == b[low * WIDTH : mid * WIDTH] else (low, mid)
    return low


def node_keys(path: str) -> list[str]:
    """A 128-bit name for each prefix of a path, the empty one first."""
    h, out = hashlib.md5(usedforsecurity=False), [ROOT]
    for i in range(0, len(path), WIDTH):
        h.update(path[i : i + WIDTH].encode())
        out.append(h.hexdigest())
    return out


def encode(path: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parentheses, the last node that each path opens, depths) of distinct paths in order."""
    depth = np.array([len(p) // WIDTH for p in path])
    common = np.array([0] + [shared_turns(a, b) for a, b in zip(path, path[1:], strict=False)])
    # before path i close those of path i - 1 that it doesn't share, then its own open; the root is around all
    runs = np.stack([np.append(0, depth[:-1] - common[1:]), depth - common], 1).ravel()
    bits = np.repeat(np.tile(np.array([0, 1], np.uint8), len(path)), runs)
    return np.concatenate([[1], bits, np.zeros(depth[-1] + 1)]).astype(np.uint8), np.cumsum(depth - common), depth


def shard_nodes(shard: int, ids: np.ndarray, paths: list[str], chars_at: np.ndarray, chars: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Nodes of one shard of whole conversations, by path and id; turn j of conversation i has ``chars[chars_at[i] + j]`` code points."""
    begins = [0] + [i for i in range(1, len(paths)) if paths[i] != paths[i - 1]]
    path, run = [paths[i] for i in begins], np.append(begins, len(paths))
    bits, ends_at, depth = encode(path)
    trie = Parentheses(bits)
    n, close = len(trie.opens), trie.find_close(trie.opens)
    node, level, behind = np.arange(n), trie.excess[trie.opens] - 1, np.arange(n) + (close - trie.opens + 1) // 2
    # paths that end within a subtree, and so its conversations, are a run
    first, last = run[np.searchsorted(ends_at, node)], run[np.searchsorted(ends_at, behind)]
    opener = run[np.searchsorted(ends_at, node)]
    own = np.append(0, chars[chars_at[opener[1:]] + level[1:] - 1])
    least = np.minimum.reduceat(np.append(ids, ids[-1:]), np.stack([first, last], 1).ravel())[::2]
    below = lambda x: (c := np.append(0, np.cumsum(x)))[behind] - c[node]
    parent, latest = np.full(n, -1), np.zeros(level.max() + 1, np.int64)
    for i, d in enumerate(level.tolist()):
        latest[d] = i
        if d:
            parent[i] = latest[d - 1]
    children = np.bincount(parent[1:], minlength=n)

    side, key = np.full(n, "", object), np.full(n, None, object)
    shared = shared_turns(path[0], path[-1])
    for name, which in (("L", 0), ("R", -1)):
        at, keys = int(ends_at[which]), node_keys(path[which])
        for d in range(depth[which], -1, -1):
            side[at], key[at] = "C" if d <= shared else name, keys[d]
            at = parent[at]
    spine = side != ""
    hashes = np.full(n, hashlib.sha256(b"").hexdigest(), object)
    pieces = []
    for i, at in enumerate(ends_at.tolist()):
        a, z = int(run[i]), int(run[i + 1])
        if spine[at]:
            pieces += [(key[at], k, ",".join(map(str, ids[j : min(z, j + PIECE_IDS)].tolist()))) for k, j in enumerate(range(a, z, PIECE_IDS))]
        else:
            h = hashlib.sha256()
            for j in range(a, z, PIECE_IDS):
                h.update(b"," * (j > a) + ",".join(map(str, ids[j : min(z, j + PIECE_IDS)].tolist())).encode())
            hashes[at] = h.hexdigest()
    on_spine = spine[parent] & (parent >= 0)
    above = np.where(parent >= 0, parent, 0)
    long = lambda x: pa.array(x, pa.int64())
    string = lambda x: pa.array(x, pa.string())
    columns = [
        long(np.full(n, shard)), string(side), pa.array(level, pa.int32()), string(key), string(np.where(on_spine, key[above], None)),
        string(np.where(on_spine, side[above], None)), pa.array(level - 1, pa.int32()), long(least), pa.array(least[above], pa.int64(), mask=on_spine | (parent < 0)),
        long(last - first), long(children), long(trie.leaf_pairs(close)), pa.array(children == 0), long(own), long(below(own * (last - first))), long(below(own)),
        string(np.where(spine, None, hashes)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()),
    ]
    names = [x.split()[0] for x in NODE.split(", ")]
    yield pa.RecordBatch.from_arrays(columns, names)
    for i in range(0, len(pieces), 100):
        some = pieces[i : i + 100]
        given = {"shard": long([shard] * len(some)), "side": string(["E"] * len(some)), "node": string([x[0] for x in some]), "piece": pa.array([x[1] for x in some], pa.int32()), "ends": string([x[2] for x in some])}
        yield pa.RecordBatch.from_arrays([given.get(c, pa.nulls(len(some), k.type)) for c, k in zip(names, columns, strict=True)], names)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut sorted conversations into shards of about SHARD_NODES turns and give the nodes of each."""
    shard = TaskContext.get().partitionId() << 32
    held, turns = [], 0

    def nodes():
        table = pa.Table.from_batches(held).combine_chunks()
        chars = table.column("chars").combine_chunks()
        at = np.append(0, np.cumsum(chars.value_lengths().to_numpy(zero_copy_only=False)))
        return shard_nodes(shard, table.column("conv_id").to_numpy(), table.column("path").to_pylist(), at[:-1], chars.flatten().to_numpy(zero_copy_only=False))

    for batch in batches:
        size = np.cumsum(batch.column("chars").value_lengths().to_numpy(zero_copy_only=False) + 1)
        a = 0
        while a < len(size):
            before = size[a - 1] if a else 0
            z = max(a + 1, int(np.searchsorted(size, before + SHARD_NODES - turns, "right")))
            held.append(batch.slice(a, z - a))
            turns += int(size[z - 1] - before)
            if turns >= SHARD_NODES or z < len(size):
                yield from nodes()
                held, turns, shard = [], 0, shard + 1
            a = z
    if held:
        yield from nodes()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends_sha256) of pieces in order, as they stream by."""
    node, h = None, None
    for batch in batches:
        done = []
        for key, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if key != node:
                if h is not None:
                    done.append((node, h.hexdigest()))
                node, h = key, hashlib.sha256()
            else:
                h.update(b",")
            h.update(ends.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done])], ["node", "ends_sha256"])
    if h is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([h.hexdigest()])], ["node", "ends_sha256"])


def _merged(spine: DataFrame) -> DataFrame:
    """The nodes of spines, each of which may lie in many shards, added up."""
    facts = spine.groupBy("node").agg(F.min("shard").alias("owner"), F.max(~F.col("childless")).alias("has_child"))
    rows = spine.join(facts, "node")
    again = F.col("shard") != F.col("owner")
    rows = rows.withColumn("off_chars", F.when(again, F.col("chars")).otherwise(0)).withColumn("off_leaves", (F.col("childless") & (F.col("has_child") | again)).cast("long"))
    # what later shards counted again is below a spine's node if it is deeper on its side, or beyond the shared part
    deeper = Window.partitionBy("shard", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    beyond = Window.partitionBy("shard")

    def off(name: str) -> Column:
        return F.sum(name).over(deeper) + F.when(F.col("side") == "C", F.sum(F.when(F.col("side") != "C", F.col(name)).otherwise(0)).over(beyond)).otherwise(0)

    parts = rows.withColumn("n_leaves", F.col("n_leaves") - off("off_leaves")).withColumn("node_chars", F.col("node_chars") - off("off_chars"))
    sums = parts.groupBy("node").agg(
        F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), (F.sum("total_chars") - F.sum("node_chars")).alias("saved_tokens"),
    )
    twice = rows.filter(again & F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("twice"))
    return sums.join(twice, "node", "left").withColumn("n_children", F.col("n_children") - F.coalesce("twice", F.lit(0))).drop("twice")


OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(rebuilt: DataFrame) -> DataFrame:
    """One row for each node of the conversations that ``paths`` gives.

    conv_id (smallest member), depth, parent_conv_id (null: root), n_convs, n_children,
    n_leaves, saved_tokens (code points that a shared prefix is stored once for), ends_sha256.
    """
    spark = rebuilt.sparkSession
    folder = shared_dir(spark)
    rebuilt = written(rebuilt, f"{folder}/paths")
    rows = rebuilt.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    nodes = written(rows.mapInArrow(_shards, NODE), f"{folder}/nodes")
    drop(spark, f"{folder}/paths")
    spine = written(nodes.filter("side in ('C', 'L', 'R')").select("shard", "side", "depth", "node", "parent", "conv_id", "n_convs", "n_children", "n_leaves", "childless", "chars", "total_chars", "node_chars"), f"{folder}/spine")
    merged = written(_merged(spine), f"{folder}/merged")
    pieces = nodes.filter("side = 'E'").select("node", "shard", "piece", "ends")
    ends = pieces.repartition("node").sortWithinPartitions("node", "shard", "piece").mapInArrow(_hashed, "node string, ends_sha256 string")
    parents = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    shared = merged.join(parents, "parent", "left").join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
    inner = nodes.filter("side = ''").withColumn("saved_tokens", F.col("total_chars") - F.col("node_chars"))
    places = spine.select("shard", F.col("side").alias("parent_side"), F.col("depth").alias("parent_depth"), F.col("node").alias("parent")).join(parents, "parent").drop("parent")
    hung = inner.filter("parent_side is not null").drop("parent_conv_id").join(places, ["shard", "parent_side", "parent_depth"])
    out = [part.select(*[F.col(c).cast("string" if c == "ends_sha256" else "long").alias(c) for c in OUT]) for part in (inner.filter("parent_side is null"), hung, shared)]
    return out[0].unionByName(out[1]).unionByName(out[2])
