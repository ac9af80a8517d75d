"""Trie of conversation prefixes as minimal-perfect-hash node tables.

A prefix is named by 128 bits: the exclusive or of one hash for each turn and its place, so that prefixes of a
conversation are running values, computed by blocks of turns. Blocks of conversations are dealt out to shards. A
shard lists its distinct prefixes, gives them slots by a minimal perfect hash (each slot keeps its digest, so a
strange digest is found out), scatters counts into flat arrays and adds up subtrees through an array of parent
slots, deepest first. Nodes of several shards meet in sums by digest. Neither a common prefix, nor a
subtree below it, nor a long conversation comes together in one task.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from bazaarlens import session
from bazaarlens.llm.rows import WORD

#: Turns ranked in one window, turns of a conversation in one shard, rows of a shard on average, ids joined at once.
TURN_BLOCK, SEGMENT, SHARD_ROWS, ID_BLOCK = 1024, 4096, 16384, 65536


class NodeSlots:
    """Slots 0 to n - 1 for n distinct digests (a, b) of two 64-bit words.

    On each level the digests left over are hashed to twice as many places; one alone on its place takes the next
    slot, the others go on to the next level.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        slot, left, used = np.empty(len(a), np.int64), np.arange(len(a)), 0
        while len(left):
            place = self._places(a[left], b[left], len(self.levels), 2 * len(left))
            alone = np.bincount(place, minlength=2 * len(left)) == 1
            rank = used + np.cumsum(alone) - 1
            self.levels.append((alone, rank))
            hit = alone[place]
            slot[left[hit]] = rank[place[hit]]
            used += int(hit.sum())
            left = left[~hit]
        self.slot = slot
        self.a, self.b = np.empty_like(a), np.empty_like(b)
        self.a[slot], self.b[slot] = a, b

    @staticmethod
    def _places(a: np.ndarray, b: np.ndarray, level: int, n: int) -> np.ndarray:
        x = (a.astype(np.uint64) ^ np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9) + b.astype(np.uint64)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(n)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for one that is not in the table."""
        out, left = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, (alone, rank) in enumerate(self.levels):
            place = self._places(a[left], b[left], level, len(alone))
            hit = alone[place]
            at, which = rank[place[hit]], left[hit]
            same = (self.a[at] == a[which]) & (self.b[at] == b[which])
            out[which[same]] = at[same]
            left = left[~hit]
        return out


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [pc.fill_null(table.column(n), 0).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64) for n in names]


def _distinct(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the first row of each distinct digest."""
    order = np.lexsort((b, a))
    new = np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])]) if len(a) else np.empty(0, bool)
    return order[new]


def _count_nodes(rows: pa.Table) -> pa.Table:
    """Distinct prefixes of a shard: how many conversations have each, and the smallest of them."""
    p1, p2, conv, depth = _numbers(rows, "p1", "p2", "conv_id", "depth")
    firsts = _distinct(p1, p2)
    slots = NodeSlots(p1[firsts], p2[firsts])
    slot, n = slots.find(p1, p2), len(firsts)
    first = np.empty(n, np.int64)
    first[slots.slot] = firsts
    same = pc.equal(rows.column("t"), rows.column("t").take(pa.array(first[slot])))
    if n and not (pc.all(same).as_py() and (depth == depth[first[slot]]).all()):
        raise ValueError("two different prefixes have one digest")
    count, least = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    np.add.at(count, slot, 1)
    np.minimum.at(least, slot, conv)
    kept = rows.select(["p1", "p2", "q1", "q2", "depth", "t", "words"]).take(pa.array(first))
    return kept.append_column("n", pa.array(count)).append_column("rep", pa.array(least))


def _add_subtrees(rows: pa.Table, weights: pa.Table, segment: int) -> pa.Table:
    """Weights of a shard's nodes, added up from the leaves: each node's sum over its subtree in this shard.

    Sums end at the first node of a segment; what crosses it comes with the weights.
    """
    p1, p2, q1, q2, depth = _numbers(rows, "p1", "p2", "q1", "q2", "depth")
    firsts = _distinct(p1, p2)
    slots = NodeSlots(p1[firsts], p2[firsts])
    n = len(firsts)
    parent, level = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    parent[slots.slot] = np.where(depth[firsts] % segment > 0, slots.find(q1[firsts], q2[firsts]), -1)
    level[slots.slot] = depth[firsts]
    w1, w2, leaves, saved = _numbers(weights, "p1", "p2", "leaves", "saved")
    at = slots.find(w1, w2)
    if (at < 0).any():
        raise ValueError("a weight belongs to no node of its shard")
    total = np.zeros((n, 2), np.int64)
    np.add.at(total, at, np.stack([leaves, saved], axis=1))
    order = np.argsort(-level, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], level[order][1:] != level[order][:-1], [True]])) if n else np.empty(0, int)
    for start, stop in zip(edges[:-1], edges[1:]):
        now = order[start:stop]
        now = now[parent[now] >= 0]
        np.add.at(total, parent[now], total[now])
    some = total.any(axis=1)
    return pa.table({"p1": slots.a[some], "p2": slots.b[some], "leaves": total[some, 0], "saved": total[some, 1]})


def ordered_turns(conversations: DataFrame, block: int = TURN_BLOCK) -> DataFrame:
    """``(conv_id, pos, t, words)``: turns numbered from 1 by turn (NULL first, ties by ``t``), their digest and words.

    NULL roles and texts are empty; rows without a conv_id are in no conversation. Turns are ranked in
    blocks of ``block`` turn numbers, so a long conversation is many windows; turns of one number share a block.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = ["conv_id", "known", "part"]
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("turn").isNotNull().alias("known"), F.coalesce(F.expr(f"CAST(turn AS long) div {block}"), F.lit(0)).alias("part"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("t"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    ahead = W.Window.partitionBy("conv_id").orderBy("known", "part").rowsBetween(W.Window.unboundedPreceding, -1)
    before = rows.groupBy(*key).agg(F.count("*").alias("n")).select(*key, F.sum("n").over(ahead).alias("before")).filter("before > 0")
    inside = W.Window.partitionBy(*key).orderBy("turn", "t")
    ranked = rows.withColumn("place", F.row_number().over(inside)).join(before, key, "left")
    return ranked.select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "t", "words")


def with_shared_heads(turns: DataFrame, donor: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``heads`` turns are those of the conversation ``donor`` (all it has, if fewer).

    ``donor`` and ``heads`` (up to ``most``) are expressions of conv_id. Returns ``(conv_id, n)`` for every
    conversation, those left without a turn too, and ``(conv_id, pos, n, t, words)`` for every turn.
    """
    owned = turns.groupBy("conv_id").agg(F.count("*").alias("own")).select("conv_id", "own", donor.alias("donor"), heads.alias("h"))
    given = owned.select(F.col("conv_id").alias("donor"), F.least("own", F.lit(most)).alias("gives"))
    convs = owned.join(given, "donor", "left").withColumn("k", F.least("h", F.coalesce("gives", F.lit(0)))).select(
        "conv_id", "donor", "h", "k", (F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    convs = session.cut(convs)
    head = convs.select("conv_id", "donor", "h", "n").join(
        turns.filter(F.col("pos") <= most).withColumnRenamed("conv_id", "donor"), "donor").filter("pos <= h")
    tail = turns.join(convs.select("conv_id", "h", "k", "n"), "conv_id").filter("pos > h").withColumn("pos", F.expr("pos - h + k"))
    names = ["conv_id", "pos", "n", "t", "words"]
    return convs.select("conv_id", "n"), head.select(*names).unionByName(tail.select(*names))


def _prefixes(convs: DataFrame, turns: DataFrame, segment: int) -> DataFrame:
    """A row for each conversation and depth: digests of the prefix (p1, p2) and of its parent (q1, q2)."""
    hashed = turns.select("conv_id", F.col("pos").cast("long").alias("depth"), "n", "t", "words", F.expr(f"pos div {segment}").alias("seg")).select(
        "*", F.xxhash64(F.lit(1), "t", "depth").alias("h1"), F.xxhash64(F.lit(2), "t", "depth").alias("h2"))
    upto = W.Window.partitionBy("conv_id", "seg").orderBy("depth").rowsBetween(W.Window.unboundedPreceding, 0)
    ahead = W.Window.partitionBy("conv_id").orderBy("seg").rowsBetween(W.Window.unboundedPreceding, -1)
    carried = hashed.groupBy("conv_id", "seg").agg(F.bit_xor("h1").alias("c1"), F.bit_xor("h2").alias("c2")).select(
        "conv_id", "seg", F.bit_xor("c1").over(ahead).alias("c1"), F.bit_xor("c2").over(ahead).alias("c2")).filter("seg > 0")
    running = hashed.select("*", F.bit_xor("h1").over(upto).alias("r1"), F.bit_xor("h2").over(upto).alias("r2")).join(
        carried, ["conv_id", "seg"], "left")
    p = [F.coalesce(f"c{k}", F.lit(0).cast("long")).bitwiseXOR(F.col(f"r{k}")) for k in (1, 2)]
    below = running.select("conv_id", "depth", p[0].alias("p1"), p[1].alias("p2"), p[0].bitwiseXOR(F.col("h1")).alias("q1"),
                           p[1].bitwiseXOR(F.col("h2")).alias("q2"), "t", "words", (F.col("depth") == F.col("n")).alias("is_end"))
    nothing = F.lit(None).cast("long")
    roots = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("p1"), F.lit(0).cast("long").alias("p2"),
                         nothing.alias("q1"), nothing.alias("q2"), F.lit("").alias("t"), F.lit(0).cast("long").alias("words"),
                         (F.col("n") == 0).alias("is_end"))
    return roots.unionByName(below)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids, fed block by block; the rows of a node stand together, in order."""
    node, sha = None, None
    done: list[tuple[int, int, str]] = []
    flush = lambda: pa.RecordBatch.from_arrays(
        [pa.array([d[k] for d in done], kind) for k, kind in ((0, pa.int64()), (1, pa.int64()), (2, pa.string()))], ["p1", "p2", "ends_sha256"])
    for batch in batches:
        for a, b, ids in zip(*(batch.column(n).to_pylist() for n in ("p1", "p2", "ids"))):
            if (a, b) != node:
                if node is not None:
                    done.append((*node, sha.hexdigest()))
                node, sha = (a, b), hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if done:
            yield flush()
            done.clear()
    if node is not None:
        done.append((*node, sha.hexdigest()))
        yield flush()


def _later_segments(nodes: DataFrame, rows: DataFrame, shards: int, segment: int) -> DataFrame:
    """For conversations of several segments: what later segments own, put on the last node of each earlier one."""
    total = nodes.filter(F.col("depth") >= segment).groupBy("rep", F.expr(f"depth div {segment}").alias("seg")).agg(
        F.sum("leaf").alias("leaves"), F.sum("saves").alias("saved"))
    spine = total.groupBy("rep").agg(F.max("seg").alias("last")).select("rep", F.explode(F.sequence(F.lit(1).cast("long"), "last")).alias("seg"))
    after = W.Window.partitionBy("rep").orderBy(F.desc("seg")).rowsBetween(W.Window.unboundedPreceding, 0)
    sums = spine.join(total, ["rep", "seg"], "left").select(
        F.col("rep").alias("conv_id"), (F.col("seg") * segment - 1).alias("depth"),
        *[F.sum(F.coalesce(c, F.lit(0).cast("long"))).over(after).alias(c) for c in ("leaves", "saved")])
    ends = rows.filter(F.col("depth") % segment == segment - 1).select("conv_id", "depth", "p1", "p2")
    return sums.join(ends, ["conv_id", "depth"]).select(_shard(F.col("conv_id"), F.col("depth"), shards, segment), "p1", "p2", "leaves", "saved")


def _shard(conv_id: Column, depth: Column, shards: int, segment: int) -> Column:
    return F.pmod(F.xxhash64(conv_id, F.floor(depth / segment)), F.lit(shards)).alias("shard")


def prefix_trie(convs: DataFrame, turns: DataFrame, segment: int = SEGMENT, shard_rows: int = SHARD_ROWS, id_block: int = ID_BLOCK) -> DataFrame:
    """One row for each distinct sequence of first turns, the empty one (the root) included.

    ``convs`` has ``(conv_id, n)``, every conversation with its number of turns; ``turns`` has ``(conv_id, pos, n, t, words)``,
    pos from 1 without gaps, t a digest of the turn. Returns conv_id (smallest conversation with the prefix), depth,
    parent_conv_id (NULL for the root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256. No conversation, no rows.
    Ids of conversations that end at one node are hashed in one stream, as SHA-256 has it, in blocks of ids joined before.
    """
    spark = convs.sparkSession
    rows = session.cut(_prefixes(convs, turns, segment))
    shards = rows.count() // shard_rows + 1
    dealt = rows.withColumn("shard", _shard(F.col("conv_id"), F.col("depth"), shards, segment))
    local = dealt.groupBy("shard").applyInArrow(
        _count_nodes, "p1 long, p2 long, q1 long, q2 long, depth long, t string, words long, n long, rep long")
    same = F.lit(True)
    for name in ("q1", "q2", "depth", "t", "words"):
        same = same & F.min(name).eqNullSafe(F.max(name))
    merged = session.cut(local.groupBy("p1", "p2").agg(
        F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.min("depth").alias("depth"), F.sum("n").alias("n"), F.min("rep").alias("rep"),
        F.when(same, F.min("words")).otherwise(F.raise_error(F.lit("two different prefixes have one digest")).cast("long")).alias("words")))
    children = merged.filter("depth > 0").groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(F.count("*").alias("n_children"))
    nodes = session.cut(merged.join(children, ["p1", "p2"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
                        .withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "saves": (F.col("n") - 1) * F.col("words")}))
    weights = nodes.filter("leaf > 0 OR saves > 0").select(
        _shard(F.col("rep"), F.col("depth"), shards, segment), "p1", "p2", F.col("leaf").alias("leaves"), F.col("saves").alias("saved"))
    weights = weights.unionByName(_later_segments(nodes, rows, shards, segment))
    sums = dealt.select("shard", "p1", "p2", "q1", "q2", "depth").groupBy("shard").cogroup(weights.groupBy("shard")).applyInArrow(
        lambda own, weight: _add_subtrees(own, weight, segment), "p1 long, p2 long, leaves long, saved long").groupBy("p1", "p2").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    joined_ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    blocks = rows.filter("is_end").groupBy("p1", "p2", F.floor(F.col("conv_id") / id_block).alias("block")).agg(joined_ids.alias("ids"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ends = blocks.repartition(parts, "p1", "p2").sortWithinPartitions("p1", "p2", "block").select("p1", "p2", "ids").mapInArrow(
        _hash_ends, "p1 long, p2 long, ends_sha256 string")
    above = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("rep").alias("parent_conv_id"))
    return (nodes.join(sums, ["p1", "p2"], "left").join(ends, ["p1", "p2"], "left").join(above, ["q1", "q2"], "left").select(
        F.col("rep").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        F.coalesce("n_leaves", F.lit(0).cast("long")).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
