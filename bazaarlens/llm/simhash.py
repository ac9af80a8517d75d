"""SimHash near-duplicates: fingerprints of word shingles, linked by a binary trie self-join.

Two fingerprints within ``budget`` differing bits agree in one of ``budget + 1`` blocks of bits. For each
block the fingerprints are rotated so that the block comes first: in the trie of these keys, pairs of
nodes are equal down to the block's end, which is what the rows are dealt out by. Below, node pairs are
traversed together, differing bits add up, and a pair beyond the budget is pruned with all below it.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from bazaarlens import session
from bazaarlens.llm.components import roots
from bazaarlens.llm.rows import bounded, free_name, row_key, text_bytes

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))  # A-Z to a-z


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """A bit is 1 where over half of the shingles' XXH64 have it; 0 for a text without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1])
    k = min(shingle, len(words))
    first, last = starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, len(first), 1 << 15):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(first[i:i + (1 << 15)], last[i:i + (1 << 15)])], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(first)).tobytes(), "big")


def fingerprints(docs: DataFrame, text_column: str = "text", shingle: int = 4) -> DataFrame:
    """``docs`` without its text, with a 64-bit ``fp`` (signed). NULL, empty and wordless texts have 0."""
    others = [f for f in docs.schema.fields if f.name != text_column]
    names = [f.name for f in others] + ["fp"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, text_column):
            data, offsets = text_bytes(batch.column(text_column))
            raw = data.tobytes()
            fps = [fingerprint(raw[a:b], shingle) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names[:-1]), pa.array(np.array(fps, np.uint64).view(np.int64))], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return docs.mapInArrow(hashed, f"{schema}, fp long" if schema else "fp long")


def _blocks(budget: int) -> list[tuple[int, int]]:
    """First bit and width of ``budget + 1`` blocks that make up the 64 bits."""
    edges = [64 * i // (budget + 1) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:])]


def trie_links(key: np.ndarray, starts: list[tuple[int, int, int, int]], depth: int, budget: int, leaf: int = 64) -> np.ndarray:
    """For sorted runs of 64-bit keys: a label per key, equal for keys that links connect.

    ``starts`` has pairs of trie nodes, as runs [a, b) and [c, d) of ``key`` that agree in the first ``depth``
    bits; a node may be paired with itself. Node pairs are expanded a bit at a time; pairs of at most
    ``leaf`` keys' product are compared outright.
    """
    label = np.arange(len(key))
    pairs = np.array(starts, np.int64).reshape(-1, 4)
    a, b, c, d = pairs.T
    spent = np.zeros(len(pairs), np.int64)

    def join(i: np.ndarray, j: np.ndarray) -> None:
        near = np.bitwise_count(key[i] ^ key[j]) <= budget
        i, j = i[near], j[near]
        while len(i):
            x, y = label[i], label[j]
            apart = x != y
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            low = np.minimum(x, y)
            np.minimum.at(label, x, low)
            np.minimum.at(label, y, low)
            while (label[label] != label).any():
                label[:] = label[label]

    while len(a):
        same = (a == c) & (b == d)
        alive = ~(same & (b - a < 2)) & (b > a) & (d > c) & (spent <= budget)
        a, b, c, d, spent, same = a[alive], b[alive], c[alive], d[alive], spent[alive], same[alive]
        n = (b - a) * (d - c)
        small = (n <= leaf) | (depth >= 64)
        for part in np.array_split(np.flatnonzero(small), max(1, int(n[small].sum()) >> 20)):
            m = n[part]
            total = int(m.sum())
            place = np.arange(total) - np.repeat(np.cumsum(m) - m, m)
            width = np.repeat(d[part] - c[part], m)
            join(np.repeat(a[part], m) + place // width, np.repeat(c[part], m) + place % width)
        a, b, c, d, spent, same = (x[~small] for x in (a, b, c, d, spent, same))
        if not len(a):
            break
        ones = np.concatenate([np.zeros(1, np.int64), np.cumsum((key >> np.uint64(63 - depth)) & np.uint64(1)).astype(np.int64)])
        p, q = b - (ones[b] - ones[a]), d - (ones[d] - ones[c])  # where the bit turns to 1
        other = ~same  # of a node with itself, the two crossed children are one pair
        a, b, c, d, spent = (np.concatenate(x) for x in zip(
            (a, p, c, q, spent), (p, b, q, d, spent), (a, p, q, d, spent + 1), (p[other], b[other], c[other], q[other], spent[other] + 1)))
        depth += 1
    return label


def _rotated(fp: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each fingerprint with its block of bits in front."""
    left, right = first.astype(np.uint64), ((64 - first) % 64).astype(np.uint64)
    return np.where(first == 0, fp, (fp << left) | (fp >> right))


def _links_of(bucket: np.ndarray, crossed: np.ndarray, side: np.ndarray, first: np.ndarray, fp: np.ndarray,
              depth: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (fp, fp) that span the components of each bucket of a batch; equal buckets stand together."""
    key = _rotated(fp, first)
    group = np.cumsum(np.concatenate([[0], (bucket[1:] != bucket[:-1]).any(axis=1)]))
    order = np.lexsort((key, side, group))
    key, group, side, crossed, fp = key[order], group[order], side[order], crossed[order], fp[order]
    edge = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (side[1:] != side[:-1])]))
    stop = np.append(edge[1:], len(key))
    own = np.flatnonzero(~crossed[edge] & (stop - edge > 1))
    after = np.flatnonzero((side[edge] == 1) & np.concatenate([[False], group[edge[1:]] == group[edge[:-1]]]))
    starts = np.concatenate([np.stack([edge[own], stop[own], edge[own], stop[own]], axis=1),
                             np.stack([edge[after - 1], stop[after - 1], edge[after], stop[after]], axis=1)])
    label = trie_links(key, starts, depth, budget)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return fp[moved].view(np.int64), fp[label[moved]].view(np.int64)


def link_fingerprints(nodes: DataFrame, budget: int = 4, bucket_rows: int = 4096) -> DataFrame:
    """``(u, v)``: pairs of distinct fingerprints (``nodes.fp``) within ``budget`` bits that span all components.

    A bucket with more than ``bucket_rows`` rows is cut into chunks, and every pair of chunks is a task's
    work of its own: no row is left out and no task holds a whole bucket.
    """
    blocks = _blocks(budget)
    depth = min(w for _, w in blocks)
    rows = nodes.select("fp", F.explode(F.array(*(F.struct(
        F.lit(first).alias("first"), F.shiftrightunsigned("fp", 64 - first - width).bitwiseAND((1 << width) - 1).alias("value"))
        for first, width in blocks))).alias("x")).select("fp", "x.first", "x.value")
    # At most one row for each value of a block, whatever the input: (budget + 1) * 2 ** width rows.
    crowded = (rows.groupBy("first", "value").count().filter(F.col("count") > bucket_rows)
               .select("first", "value", F.ceil(F.col("count") / bucket_rows).cast("int").alias("m")))
    chunk = F.pmod(F.xxhash64("fp", F.lit(1)), F.coalesce("m", F.lit(1))).cast("int")
    dealt = (rows.join(F.broadcast(crowded), ["first", "value"], "left").withColumn("c", chunk)
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.coalesce("m", F.lit(1)) - 1)))
             .select("first", "value", F.least("c", "o").alias("i"), F.greatest("c", "o").alias("j"),
                     (F.col("c") > F.col("o")).cast("int").alias("side"), "fp"))
    bucket = ["first", "value", "i", "j"]
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def done(table: np.ndarray) -> pa.RecordBatch:
            u, v = _links_of(table[:, :4], table[:, 2] < table[:, 3], table[:, 4], table[:, 0],
                             np.ascontiguousarray(table[:, 5]).view(np.uint64), depth, budget)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            held.append(np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1))
            if sum(map(len, held)) < 1 << 16:
                continue
            table = np.concatenate(held)
            last = np.flatnonzero((table[1:, :4] != table[:-1, :4]).any(axis=1))
            if not len(last):
                held = [table]
                continue
            yield done(table[:last[-1] + 1])
            held = [table[last[-1] + 1:]]
        if held and len(table := np.concatenate(held)):
            yield done(table)

    return dealt.repartition(parts, *bucket).sortWithinPartitions(*bucket).select(*bucket, "side", "fp").mapInArrow(link, "u long, v long")


def simhash_components(docs: DataFrame, budget: int = 4, shingle: int = 4) -> DataFrame:
    """Each row's doc_id, ``fp`` (64 bits, signed), and component_id: the smallest doc_id that links reach.

    Texts that are NULL or have no word share fingerprint 0 and so a component. Repeated ids are separate
    rows. A NULL doc_id is linked like any other, but names a component only where nothing else is in it (NULL).
    """
    return _components(session.cut(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shingle=shingle)), budget)


def _components(marked: DataFrame, budget: int) -> DataFrame:
    """``marked`` (doc_id, fp, ...) with component_id."""
    nodes = session.cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    root = roots(link_fingerprints(nodes, budget)).withColumnRenamed("u", "fp")
    rooted = nodes.join(root, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked.join(rooted.select("fp", "root").join(least, "root").select("fp", "component_id"), "fp")


def drop_near_copies(docs: DataFrame, budget: int = 4, shingle: int = 4) -> DataFrame:
    """The row with the smallest doc_id of each component, all columns unchanged; of rows equal in id and text, one.

    Of a component in which every doc_id is NULL, one row stays.
    """
    marked = session.cut(fingerprints(docs.select(*row_key(F.col("doc_id"), F.col("text")), "text"), shingle=shingle))
    return first_rows(docs, _components(marked, budget))


def first_rows(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """The rows of ``docs`` that name the components of ``grouped`` (doc_id, text_md5, fp, component_id)."""
    key = [free_name(docs, "_id"), free_name(docs, "_md5")]
    best = grouped.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = best.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("f")).agg(
        F.min("text_md5").alias(key[1])).select(F.col("component_id").alias(key[0]), key[1])
    doc = row_key(F.col("doc_id"), F.col("text"))
    wide = docs.withColumns({f"{k}w": c for k, c in zip(key, doc)})
    joined = wide.join(kept, F.col(f"{key[0]}w").eqNullSafe(F.col(key[0])) & (F.col(f"{key[1]}w") == F.col(key[1])), "left_semi")
    place = free_name(docs, "_place")
    once = W.Window.partitionBy(f"{key[0]}w", f"{key[1]}w").orderBy(f"{key[1]}w")
    return joined.withColumn(place, F.row_number().over(once)).filter(F.col(place) == 1).select(*docs.columns)
