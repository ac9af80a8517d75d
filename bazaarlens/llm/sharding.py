"""Sharding by histogram sort: exact byte counts below candidate key boundaries, refined until the splitters hold.

Rows are ordered by (doc_id, row number). Each round counts the exact bytes and rows between the
probes in every partition; probes close in around the byte targets until each splitter is within
tolerance, or no row lies between the two nearest candidates. Only then rows move, once, to their cells.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from bazaarlens import session

Key = tuple[int, int]
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def _pack(key: Key) -> int:
    """A pair of signed 64-bit numbers as one number of the same order."""
    return ((key[0] - _LOW) << 64) | (key[1] - _LOW)


def _unpack(n: int) -> Key:
    return (n >> 64) + _LOW, (n & ((1 << 64) - 1)) + _LOW


def _bytes(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Keys as 16 big-endian bytes, which compare as the keys do."""
    flip = np.uint64(1 << 63)
    pair = np.stack([high.astype(np.int64).view(np.uint64) ^ flip, low.astype(np.int64).view(np.uint64) ^ flip], axis=1)
    return np.ascontiguousarray(pair.astype(">u8")).view("S16").ravel()


def _cells(probes: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The number of probes at or below each key."""
    keys = _bytes(high, low)
    cells = np.searchsorted(probes, keys, "right")
    return cells


def histogram(rows: DataFrame, probes: list[Key]) -> tuple[np.ndarray, np.ndarray]:
    """Exact rows and bytes in each of the ``len(probes) + 1`` cells between sorted probes."""
    bounds = _bytes(np.array([p[0] for p in probes], np.int64), np.array([p[1] for p in probes], np.int64)) if probes else np.empty(0, "S16")
    n = len(probes) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows_in, bytes_in = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for batch in batches:
            cell = _cells(bounds, batch.column(0).to_numpy(), batch.column(1).to_numpy())
            rows_in += np.bincount(cell, minlength=n)
            np.add.at(bytes_in, cell, batch.column(2).to_numpy())
        full = np.flatnonzero(rows_in)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(rows_in[full]), pa.array(bytes_in[full])], ["cell", "n", "b"])

    counted = (rows.select("k", "row", "size").mapInArrow(count, "cell long, n long, b long")
               .groupBy("cell").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).collect())  # a row for each cell
    rows_in, bytes_in = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for r in counted:
        rows_in[r["cell"]], bytes_in[r["cell"]] = r["n"], r["b"]
    return rows_in, bytes_in


def find_splitters(rows: DataFrame, parts: int, tolerance: float, probes_each: int = 8, exact: int = 1) -> list[Key]:
    """``parts - 1`` keys that cut the rows (k, row, size) into runs of nearly equal bytes.

    Every ``exact``-th splitter is refined until its bytes are within ``tolerance`` of a part or no row is
    left between candidates, whichever is closer; the others take the nearest candidate seen.
    """
    found = rows.agg(F.min("k"), F.max("k"), F.sum("size"), F.min("row"), F.max("row")).first()
    if found[2] is None:
        return [(_HIGH, _HIGH)] * (parts - 1)
    total = found[2]
    targets = [total * i / parts for i in range(1, parts)]
    lowest, highest = _pack((found[0], found[3])), _pack((found[1], found[4])) + 1
    # For each target: the nearest candidates below and above, with the bytes below each.
    span = [[(lowest, 0), (highest, total)] for _ in targets]
    empty = [False] * len(targets)  # no key lies between the two
    best = lambda i: min(span[i], key=lambda x: abs(x[1] - targets[i]))
    off = lambda i: abs(best(i)[1] - targets[i])
    open_ = lambda i: not empty[i] and span[i][1][0] - span[i][0][0] > 1 and (
        off(i) > tolerance * total / parts if (i + 1) % exact == 0 else off(i) > 0.25 * total / parts)
    while any(map(open_, range(len(targets)))):
        probes: set[int] = set()
        for i in filter(open_, range(len(targets))):
            (a, below_a), (b, below_b) = span[i]
            probes.update(a + (b - a) * j // (probes_each + 1) for j in range(1, probes_each + 1))
            if below_b > below_a:  # where the target lies if bytes are even between the two
                probes.add(a + int((b - a) * ((targets[i] - below_a) / (below_b - below_a))))
        ordered = sorted(p for p in probes if p > lowest)
        n, size = histogram(rows, [_unpack(p) for p in ordered])
        below = np.cumsum(size)
        rows_below = np.cumsum(n)
        seen = [(p, int(below[j]), int(rows_below[j])) for j, p in enumerate(ordered)]
        for i in filter(open_, range(len(targets))):
            (a, below_a), (b, below_b) = span[i]
            inside = [x for x in seen if a < x[0] < b]
            under = [x for x in inside if x[1] <= targets[i]]
            over = [x for x in inside if x[1] > targets[i]]
            new = [under[-1][:2] if under else (a, below_a), over[0][:2] if over else (b, below_b)]
            if under and over and over[0][2] - under[-1][2] <= 1:  # a single row between: nothing finer exists
                empty[i] = True
            span[i] = new
    return [_unpack(best(i)[0]) for i in range(len(targets))]


def assign_shards(docs: DataFrame, shards: int, id_column: str = "doc_id", text_column: str = "text",
                  tolerance: float = 0.0005, cells: int = 8) -> DataFrame:
    """Each row's doc_id, size, text_crc32, shard and slot, shards of nearly equal bytes in key order.

    Size is the text's UTF-8 bytes plus 8; a NULL text is empty. A NULL id sorts first. Rows equal in id and
    text are told apart by a row number fixed once, so even one id that holds most rows is split. An empty
    table gives no rows. ``cells`` runs of rows a shard are dealt to as many tasks.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    rows = session.cut(docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(id_column).cast("long"), F.lit(_LOW)).alias("k"),
        F.monotonically_increasing_id().alias("row"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32")))
    splitters = find_splitters(rows, shards * cells, tolerance / cells, exact=cells)
    in_cell, _ = histogram(rows, splitters)
    first = [int(in_cell[i - i % cells:i].sum()) for i in range(len(in_cell))]  # rows of the shard before each cell
    bounds = _bytes(np.array([s[0] for s in splitters], np.int64), np.array([s[1] for s in splitters], np.int64))
    fields = ["doc_id", "k", "row", "size", "text_crc32"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = _cells(bounds, batch.column(1).to_numpy(), batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int64))], [*fields, "cell"])

    dealt = rows.select(*fields).mapInArrow(deal, "doc_id long, k long, row long, size long, text_crc32 long, cell long")
    place = F.row_number().over(W.Window.partitionBy("cell").orderBy("k", "row")).cast("long") - 1
    starts = F.get(F.array(*(F.lit(x).cast("long") for x in first)), F.col("cell").cast("int"))
    return dealt.select("doc_id", "size", "text_crc32", (F.col("cell") / cells).cast("int").alias("shard"), (starts + place).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Write all columns of ``docs`` into ``path``, one folder a shard, by the shards of each row's id.

    For tables with distinct ids; the assignment is joined back by id.
    """
    placed = assign_shards(docs, shards, id_column, text_column).select(F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"))
    docs.join(placed, F.col(id_column).eqNullSafe(F.col("_id"))).drop("_id").write.partitionBy("_shard").parquet(path)
