"""Best-fit packing of tokenized documents into sequences, by a grouping genetic algorithm on islands.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt into lots of bounded size; a lot
is packed by several islands, each a task that evolves a population of packings. Crossover injects whole
well-filled sequences of one packing into another, drops the sequences that now hold something twice, and
best-fits the displaced pieces. Between epochs the best packings of an island migrate to the next one.
"""
from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens import session
from bazaarlens.llm.rows import bounded, text_bytes

#: Bytes beyond printable ASCII, ASCII white space and U+00C0 to U+00FF, and the mark that the vocabulary has of its own.
_OTHER = re.compile(rb"[\x00-\x08\x0e-\x1f\x7f\xc2\xc4-\xff]|<\|")
_TOKENIZERS: dict[tuple[str, str | None], "Tokenizer"] = {}


class Tokenizer:
    """Ids of a byte-level BPE tokenizer file.

    ``ranks_path`` may name the same vocabulary as ranks with the pattern ``pattern``; a faster library then
    takes the texts of plain Latin letters, digits, signs and white space, on which the two can't differ. All
    other texts, and those with a mark such as the end of a text, are the tokenizer file's.
    """

    def __init__(self, path: str, ranks_path: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer as FromFile
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.exact = FromFile.from_file(path)
        self.fast = None
        if ranks_path:
            import tiktoken
            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: bytes) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        whole = text.decode("utf-8", "replace")
        if self.fast is not None and not _OTHER.search(text):
            return np.array(self.fast.encode_ordinary(whole), "<u4").tobytes()
        return np.array(self.exact.encode(whole, add_special_tokens=False).ids, "<u4").tobytes()


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, ranks: tuple[str, str] | None = None, end_id: int = 0,
                 with_ids: bool = False, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``row`` (a number per row of ``docs``), doc_id, piece, start, length, ids_crc32, and ids if asked for.

    A document is its ids and ``end_id``; only one longer than ``capacity`` is cut, its first piece being
    the shorter one. A NULL text is an empty one; ids may be NULL or repeat. ``ranks``: path and pattern of
    the same vocabulary, see ``Tokenizer``.
    """
    names = ["row", "doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    end = np.array([end_id], "<u4").tobytes()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tokenizer_path, ranks[0] if ranks else None)
        tokenizer = _TOKENIZERS.get(key) or _TOKENIZERS.setdefault(key, Tokenizer(tokenizer_path, *(ranks or ())))
        for batch in bounded(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            raw = data.tobytes()
            out: list[tuple] = []
            for row, doc_id, x, y in zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                ids = tokenizer.ids(raw[x:y]) + end
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    part = ids[4 * a:4 * b]
                    out.append((row, doc_id, piece, a, b - a, zlib.crc32(part), *([np.frombuffer(part, "<u4").astype(np.int32)] if with_ids else [])))
            columns = list(zip(*out))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    schema = "row long, doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
            .mapInArrow(read, schema))


def best_fit(sizes: list[int], capacity: int, room: list[int], bins: list[int], order: list[int]) -> None:
    """Put the pieces of ``order`` each into the fullest bin with room, or into a new one.

    ``room`` is what is left of each bin and ``bins`` the bin of each piece; both change.
    """
    by_room: dict[int, list[int]] = {}
    mask = 0
    for b, r in enumerate(room):
        by_room.setdefault(r, []).append(b)
        mask |= 1 << r
    for i in order:
        size = sizes[i]
        fits = mask >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                mask ^= 1 << r
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        r -= size
        room[b] = r
        bins[i] = b
        by_room.setdefault(r, []).append(b)
        mask |= 1 << r


class Packing:
    """One individual: the bin of each piece and the fill of each bin."""

    def __init__(self, sizes: np.ndarray, bins: np.ndarray, capacity: int):
        _, self.bins = np.unique(bins, return_inverse=True)
        self.fill = np.bincount(self.bins, sizes).astype(np.int64)
        self.fitness = (-len(self.fill), float(((self.fill / capacity) ** 2).mean()) if len(self.fill) else 0.0)


def _repacked(sizes: np.ndarray, bins: np.ndarray, loose: np.ndarray, capacity: int, draw: np.random.Generator, noise: float) -> Packing:
    """The packing with the ``loose`` pieces taken out and best-fitted again, the larger first."""
    bins = bins.copy()
    held = np.ones(len(sizes), bool)
    held[loose] = False
    _, packed = np.unique(bins[held], return_inverse=True)
    room = (capacity - np.bincount(packed, sizes[held])).astype(int).tolist() if held.any() else []
    bins[held] = packed
    order = loose[np.argsort(-sizes[loose] * (1 + noise * draw.random(len(loose))), kind="stable")]
    out = bins.tolist()
    best_fit(sizes.tolist(), capacity, room, out, order.tolist())
    return Packing(sizes, np.array(out, np.int64), capacity)


def crossover(sizes: np.ndarray, a: Packing, b: Packing, capacity: int, draw: np.random.Generator) -> Packing:
    """A child of ``a`` with about half of the well-filled bins of ``b`` injected whole."""
    good = np.flatnonzero((b.fill >= np.median(b.fill)) & (draw.random(len(b.fill)) < 0.5))
    injected = np.isin(b.bins, good)
    hit = np.isin(a.bins, np.unique(a.bins[injected]))  # bins of a that hold an injected piece go
    bins = np.where(injected, len(a.fill) + b.bins, a.bins)
    return _repacked(sizes, bins, np.flatnonzero(hit & ~injected), capacity, draw, 0.05)


def mutation(sizes: np.ndarray, a: Packing, capacity: int, draw: np.random.Generator) -> Packing:
    """The emptiest bins and some others are dissolved and their pieces best-fitted again."""
    emptiest = np.argsort(a.fill + draw.random(len(a.fill)), kind="stable")[:max(2, len(a.fill) // 20)]
    other = draw.choice(len(a.fill), min(len(a.fill), max(1, len(a.fill) // 20)), replace=False)
    return _repacked(sizes, a.bins, np.flatnonzero(np.isin(a.bins, np.concatenate([emptiest, other]))), capacity, draw, 0.3)


def evolve(sizes: np.ndarray, capacity: int, start: list[np.ndarray], population: int, generations: int, seed: int) -> list[Packing]:
    """A population, best first, from the packings of ``start`` and new ones; ends early at the least possible number of bins."""
    draw = np.random.default_rng(seed)
    everything = np.arange(len(sizes))
    group = [Packing(sizes, bins, capacity) for bins in start]
    while len(group) < population:
        group.append(_repacked(sizes, np.zeros(len(sizes), np.int64), everything, capacity, draw, 0.02 * len(group)))
    least = -(-int(sizes.sum()) // capacity)
    for step in range(generations):
        group.sort(key=lambda p: p.fitness, reverse=True)
        if -group[0].fitness[0] <= least:
            break
        a, b = draw.choice(max(2, population // 2), 2, replace=False) if step % 2 else draw.choice(population, 2, replace=False)
        child = crossover(sizes, group[a], group[b], capacity, draw)
        if step % 3 == 2:
            child = mutation(sizes, child, capacity, draw)
        if child.fitness > group[-1].fitness and all(child.fitness != p.fitness for p in group):
            group[-1] = child
    return sorted(group, key=lambda p: p.fitness, reverse=True)


def pack(pieces: DataFrame, capacity: int, lot_rows: int = 4096, islands: int = 3, epochs: int = 2, population: int = 6,
         generations: int = 18, elites: int = 2) -> DataFrame:
    """``pieces`` (row, piece, length and more) with sequence_id and offset; lengths are 1 to ``capacity``.

    Every piece is placed once, without gaps. A lot holds about ``lot_rows`` pieces at any input size. An
    empty table gives no rows. ``pieces`` must be a stored table: its rows are read several times.
    """
    lots = max(1, -(-pieces.count() // lot_rows))
    dealt = pieces.withColumn("lot", F.pmod(F.xxhash64("row", "piece"), F.lit(lots)))
    islanded = dealt.select("lot", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "row", "piece", "length")
    state = "lot long, island int, bins int, fitness double, packing array<int>"

    def epoch(number: int):
        def run(items: pd.DataFrame, arrived: pd.DataFrame | None = None) -> pd.DataFrame:
            if not len(items):
                return pd.DataFrame(columns=["lot", "island", "bins", "fitness", "packing"])
            items = items.sort_values(["row", "piece"])
            lot, island = int(items["lot"].iloc[0]), int(items["island"].iloc[0])
            start = [] if arrived is None else [np.asarray(p, np.int64) for p in
                                                arrived.sort_values(["bins", "fitness", "source"])["packing"]][:population]
            group = evolve(items["length"].to_numpy(np.int64), capacity, start, population, generations, (lot * islands + island) * epochs + number)
            return pd.DataFrame([{"lot": lot, "island": island, "bins": -p.fitness[0], "fitness": p.fitness[1],
                                  "packing": p.bins.astype(np.int32)} for p in group[:elites]])
        return run

    first = epoch(0)
    best = session.cut(islanded.groupBy("lot", "island").applyInPandas(lambda items: first(items), state))
    for number in range(1, epochs):
        # The elite stays at home and migrates to the next island.
        arrivals = best.select("lot", F.explode(F.array(F.col("island"), (F.col("island") + 1) % islands)).alias("to"),
                               "bins", "fitness", "packing", F.col("island").alias("source")).withColumnRenamed("to", "island")
        run = epoch(number)
        best = session.cut(islanded.groupBy("lot", "island").cogroup(arrivals.groupBy("lot", "island"))
                           .applyInPandas(lambda items, arrived: run(items, arrived), state))
    winner = best.groupBy("lot").agg(F.max_by("packing", F.struct(-F.col("bins"), "fitness", "island")).alias("packing"))
    fields = pieces.columns

    def place(items: pd.DataFrame, won: pd.DataFrame) -> pd.DataFrame:
        if not len(items):
            return pd.DataFrame(columns=[*fields, "sequence_id", "offset"])
        items = items.sort_values(["row", "piece"])
        bins = np.asarray(won["packing"].iloc[0], np.int64)
        items["sequence_id"] = (int(items["lot"].iloc[0]) << 24) + bins
        items["offset"] = items.groupby("sequence_id")["length"].cumsum() - items["length"]
        return items[[*fields, "sequence_id", "offset"]]

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id long, offset long"
    return dealt.groupBy("lot").cogroup(winner.groupBy("lot")).applyInPandas(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, ranks: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of ``docs`` (doc_id, text)."""
    pieces = session.cut(token_pieces(docs, tokenizer_path, capacity, ranks))
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, ranks: tuple[str, str] | None = None) -> DataFrame:
    """sequence_id and its ids (at most ``capacity``): the packed token sequences themselves."""
    pieces = session.cut(token_pieces(docs, tokenizer_path, capacity, ranks, with_ids=True))
    placed = pack(pieces.drop("ids"), capacity).select("row", "piece", "sequence_id", "offset")
    return (placed.join(pieces.select("row", "piece", "ids"), ["row", "piece"]).groupBy("sequence_id")
            .agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids")))
