"""SentencePiece encoding and decoding, giant documents by a max-plus parallel scan over chunks.

The given model is a BPE model: a segmentation is the model's own exactly where every two neighbours stay
as they are when encoded alone. So a path over the pieces of a text weighs 0 if all neighbours agree and
minus infinity otherwise, and one path has weight 0. A chunk's boundary states are the pieces that may hold
the last character before the boundary; its transfer matrix (0 or minus infinity, kept as the pairs of
weight 0) says which states at its start lead to which at its end. Matrices combine associatively: a tree
of products of FAN neighbours is built level by level, then the states at the boundaries are fixed from the
top of the tree down, and each chunk is traced back on its own.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens import session
from bazaarlens.llm.rows import bounded, text_bytes

_SPACE = "▁"
_UNIT = re.compile(rb"\n| *[^ \n]+| +")
_MODELS: dict[str, "Pieces"] = {}
START = ""  # the state before a document
FAN = 8     # matrices in one product


class Pieces:
    """A model's pieces, ids of units and agreement of neighbours. Units and pairs are kept up to ``most`` of each."""

    def __init__(self, path: str, most: int = 250_000):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        self.most = most
        self.units: dict[bytes, bytes] = {b" ": self._raw([m.piece_to_id(_SPACE)])}
        normal = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        self.vocabulary = {m.id_to_piece(i): i for i in normal}
        self.longest = max(map(len, self.vocabulary))
        self.starts = {p[:n] for p in self.vocabulary for n in range(1, len(p) + 1)}
        self.agreed: dict[tuple[str, str], bool] = {}
        self.own: dict[str, list[int] | None] = {}

    @staticmethod
    def _raw(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def inner(self, text: str) -> list[int]:
        """Ids of a stretch inside a text: no piece holds a line feed, so nothing merges across one."""
        return self.model.encode("\n" + text)[2:]

    def unit(self, unit: bytes) -> bytes:
        """Ids of a unit; one that begins with spaces gives the first of them to the model's own prefix."""
        text = unit.decode("utf-8", "replace")
        ids = self.model.encode(text[1:]) if text[0] == " " else self.inner(text) if text != "\n" else self.model.encode("\n")[1:]
        return self._raw(ids)

    def encode(self, text: bytes) -> bytes:
        """Ids of a text by its units: no piece goes on over a space or a line feed after another character."""
        if not text:
            return b""
        units = _UNIT.findall(b" " + text.replace(_SPACE.encode(), b" "))
        known = self.units
        for u in units:
            if u not in known:
                if len(known) >= self.most:
                    known.clear()
                    known[b" "] = self._raw([self.model.piece_to_id(_SPACE)])
                    return self.encode(text) if len(set(units)) < self.most else self._raw(self.model.encode(text.decode("utf-8", "replace")))
                known[u] = self.unit(u)
        return b"".join(map(known.__getitem__, units))

    def ids(self, piece: str) -> list[int] | None:
        """The ids of a possible piece, or None if the model would not leave it whole."""
        if piece not in self.own:
            i = self.vocabulary.get(piece)
            ids = self.inner(piece)
            self.own[piece] = ids if i is not None and ids == [i] or i is None and len(piece) == 1 else None
        return self.own[piece]

    def agree(self, left: str, right: str) -> bool:
        key = (left, right)
        if key not in self.agreed:
            if len(self.agreed) >= 4 * self.most:
                self.agreed.clear()
            self.agreed[key] = self.inner(left + right) == self.ids(left) + self.ids(right)
        return self.agreed[key]

    def at(self, text: str, start: int) -> list[str]:
        """The pieces that may begin at a place; a character without a piece stands alone."""
        out = []
        for end in range(start + 1, min(len(text), start + self.longest) + 1):
            part = text[start:end]
            if part in self.starts or end == start + 1:
                if (part in self.vocabulary or end == start + 1) and self.ids(part) is not None:
                    out.append(part)
            else:
                break
        return out


def normalised(text: str) -> str:
    return _SPACE + text.replace(" ", _SPACE)


def states(pieces: Pieces, text: str, boundary: int) -> list[tuple[str, int]]:
    """The states at a boundary: pieces that hold the character before it, each with its start."""
    return [(p, s) for s in range(max(0, boundary - pieces.longest), boundary) for p in pieces.at(text, s) if s + len(p) >= boundary]


def _name(piece: str, start: int, boundary: int) -> str:
    return f"{start + len(piece) - boundary}:{piece}"


def scan(pieces: Pieces, text: str, a: int, b: int, entries: list[tuple[str, int]] | None):
    """Pieces that begin in [a, b) and are reached from entries, as (piece, start) -> mask of entries and one predecessor."""
    ends: dict[int, list[tuple[str, int]]] = {}
    reach: dict[tuple[str, int], tuple[int, tuple[str, int] | None]] = {}
    if entries is None:
        entries = [(START, a)]
    for n, state in enumerate(entries):
        reach[state] = (1 << n, None)
        ends.setdefault(state[1] + len(state[0]), []).append(state)
    for s in range(a, b):
        before = ends.get(s)
        if not before:
            continue
        for piece in pieces.at(text, s):
            mask, first = 0, None
            for state in before:
                if state[0] == START or pieces.agree(state[0], piece):
                    mask |= reach[state][0]
                    first = first or state
            if mask:
                reach[(piece, s)] = (mask, first)
                ends.setdefault(s + len(piece), []).append((piece, s))
    return reach


def transfer(pieces: Pieces, text: str, a: int, b: int, first: bool, last: bool) -> list[tuple[str, str]]:
    """The pairs (state at a, state at b) of weight 0. At the document's end only pieces that end there count."""
    entries = None if first else states(pieces, text, a)
    reach = scan(pieces, text, a, b, entries)
    names = [START] if first else [_name(p, s, a) for p, s in entries]
    out = []
    for (piece, s), (mask, _) in reach.items():
        end = s + len(piece)
        if piece and (end == b if last else s < b <= end):
            out += [(name, _name(piece, s, b)) for n, name in enumerate(names) if mask >> n & 1]
    return out


def traced(pieces: Pieces, text: str, a: int, b: int, entry: str, leave: str) -> list[int]:
    """Ids of the pieces that begin in [a, b), from one state at a to one at b."""
    if entry == START:
        entries = None
    else:
        over, piece = entry.split(":", 1)
        entries = [(piece, a + int(over) - len(piece))]
    over, piece = leave.split(":", 1)
    reach = scan(pieces, text, a, b, entries)
    state, path = (piece, b + int(over) - len(piece)), []
    while state is not None and state[0] != START and state[1] >= a:
        path.append(state[0])
        state = reach[state][1]
    return [i for p in reversed(path) for i in pieces.ids(p)]


def combine(left: set[tuple[str, str]], right: set[tuple[str, str]]) -> set[tuple[str, str]]:
    """The max-plus product of two transfer matrices of weights 0 and minus infinity."""
    by: dict[str, list[str]] = {}
    for i, j in right:
        by.setdefault(i, []).append(j)
    return {(i, k) for i, j in left for k in by.get(j, ())}


def product(matrices: list[set[tuple[str, str]]]) -> set[tuple[str, str]]:
    """The product of neighbouring matrices, by halves."""
    while len(matrices) > 1:
        matrices = [combine(*matrices[i:i + 2]) if i + 1 < len(matrices) else matrices[i] for i in range(0, len(matrices), 2)]
    return matrices[0]


def _boundaries(matrices: list[set[tuple[str, str]]], entry: str = START, leave: str | None = None) -> list[str] | None:
    """The states before, between and behind matrices: reached from ``entry`` and leading to ``leave`` (a document's end
    where it is None); None unless each is single."""
    forward = [{entry}]
    for m in matrices:
        forward.append({j for i, j in m if i in forward[-1]})
    state, out = forward[-1] if leave is None else forward[-1] & {leave}, []
    for m, before in zip(reversed(matrices), reversed(forward[:-1])):
        if len(state) != 1:
            return None
        out.append(next(iter(state)))
        state = {i for i, j in m if j in state and i in before}
    return [entry, *reversed(out)] if state == {entry} else None


def _pieces(path: str) -> Pieces:
    return _MODELS.get(path) or _MODELS.setdefault(path, Pieces(path))


def encode(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text", giant_bytes: int = 1 << 16,
           chunk: int = 8192) -> DataFrame:
    """doc_id, text, n_chunks and ids (little-endian unsigned 32-bit numbers) of every row, as the model encodes it whole.

    A NULL or empty text has no ids. A text of over ``giant_bytes`` is cut into chunks of ``chunk`` characters,
    which are spread over the cluster. Ids may be NULL or repeat.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    giant = F.coalesce(F.octet_length("text") > giant_bytes, F.lit(False))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model_path)
        for batch in bounded(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            raw = data.tobytes()
            ids = [pieces.encode(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([1] * len(ids), pa.int32()), pa.array(ids, pa.binary())],
                                             ["doc_id", "text", "n_chunks", "ids"])

    small = rows.filter(~giant).mapInArrow(whole, "doc_id long, text string, n_chunks int, ids binary")
    large = session.cut(rows.filter(giant).withColumn("row", F.monotonically_increasing_id()))
    return small.unionByName(_scanned(large, model_path, chunk))


_MATRIX = "row long, n int, enter array<string>, leave array<string>"


def _sets(of: pd.DataFrame) -> list[set[tuple[str, str]]]:
    return [set(zip(i, j)) for i, j in zip(of["enter"], of["leave"])]


def _fixed(matrices: DataFrame) -> DataFrame:
    """row, n, entry and exit of every chunk from the stored matrices; the states are NULL where one is not single.

    Up the tree, FAN neighbours give one product, until a document has FAN matrices at most. Down the tree,
    the states around a product fix those between its factors. No task holds more than FAN matrices of a document.
    """
    def up(of: pd.DataFrame) -> pd.DataFrame:
        of = of.sort_values("n")
        pairs = sorted(product(_sets(of)))
        return pd.DataFrame({"row": [of["row"].iloc[0]], "n": [of["n"].iloc[0] // FAN], "enter": [[i for i, _ in pairs]], "leave": [[j for _, j in pairs]]})

    def down(of: pd.DataFrame) -> pd.DataFrame:
        of = of.sort_values("n")
        entry, leave, top = of["entry"].iloc[0], of["exit"].iloc[0], bool(of["top"].iloc[0])
        found = _boundaries(_sets(of), entry, leave) if top or leave is not None else None
        at = found or [None] * (len(of) + 1)
        return pd.DataFrame({"row": of["row"], "n": of["n"], "entry": at[:-1], "exit": at[1:]})

    block = F.floor(F.col("n") / FAN).cast("int")
    levels, most = [matrices], matrices.agg(F.max("n")).first()[0] or 0
    while most >= FAN:
        levels.append(session.cut(levels[-1].withColumn("block", block).groupBy("row", "block").applyInPandas(up, _MATRIX)))
        most //= FAN
    fixed = None
    for level in reversed(levels):
        if fixed is None:
            asked = level.withColumns({"block": F.lit(0), "entry": F.lit(START), "exit": F.lit(None).cast("string"), "top": F.lit(True)})
        else:
            above = fixed.select("row", F.col("n").alias("block"), "entry", "exit")
            asked = level.withColumn("block", block).join(above, ["row", "block"]).withColumn("top", F.lit(False))
        fixed = asked.groupBy("row", "block").applyInPandas(down, "row long, n int, entry string, exit string")
    return fixed


def _scanned(large: DataFrame, model_path: str, chunk: int) -> DataFrame:
    """The same columns for the stored rows ``large`` (row, doc_id, text), by the scan."""
    around = 32  # more than any piece on either side of a chunk

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches, "text"):
            out = []
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                text = normalised(text)
                for n, a in enumerate(range(0, len(text), chunk)):
                    b, low = min(a + chunk, len(text)), max(0, a - around)
                    out.append((row, n, text[low:b + around], a - low, b - low, b == len(text)))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.bool_()))],
                                             ["row", "n", "part", "a", "b", "last"])

    parts = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = session.cut(large.select("row", "text").mapInArrow(split, "row long, n int, part string, a int, b int, last boolean")
                         .repartition(parts, "row", "n"))

    def matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model_path)
        for batch in batches:
            out = [transfer(pieces, r["part"], r["a"], r["b"], r["n"] == 0, r["last"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("n"), pa.array([[i for i, _ in m] for m in out], pa.list_(pa.string())),
                                              pa.array([[j for _, j in m] for m in out], pa.list_(pa.string()))], ["row", "n", "enter", "leave"])

    matrices = session.cut(chunks.mapInArrow(matrix, _MATRIX))
    fixed = _fixed(matrices)

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(model_path)
        for batch in batches:
            ids = [None if r["exit"] is None else Pieces._raw(traced(pieces, r["part"], r["a"], r["b"], r["entry"], r["exit"])) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("n"), pa.array(ids, pa.binary())], ["row", "n", "ids"])

    # small chunks are much work each: the stated number of partitions keeps them from being packed into a few tasks.
    # It goes by another key than the join's, as an exchange by the same one is planned away
    located = chunks.join(fixed, ["row", "n"]).select("row", "n", "part", "a", "b", "entry", "exit").repartition(parts, F.xxhash64("row", "n"))
    done = (located.mapInArrow(trace, "row long, n int, ids binary").groupBy("row")
            .agg(F.sort_array(F.collect_list(F.struct("n", "ids"))).alias("all"))
            .select("row", F.size("all").alias("n_chunks"), F.exists("all", lambda x: x["ids"].isNull()).alias("open"),
                    F.aggregate("all", F.lit(b""), lambda ids, x: F.concat(ids, F.coalesce(x["ids"], F.lit(b"")))).alias("ids")))

    def direct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Where the states at a boundary were not single, the model encodes the text whole."""
        for batch in batches:
            pieces = _pieces(model_path)
            ids = [pieces.encode(r["text"].encode()) if r["open"] else r["ids"] for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), batch.column("n_chunks"), pa.array(ids, pa.binary())],
                                             ["doc_id", "text", "n_chunks", "ids"])

    return (large.join(done, "row").select("doc_id", "text", "n_chunks", "open", "ids")
            .mapInArrow(direct, "doc_id long, text string, n_chunks int, ids binary"))


def decode(encoded: DataFrame, model_path: str, ids_column: str = "ids") -> DataFrame:
    """``encoded`` with the column decoded: the text of the ids, as the model decodes them; NULL ids are an empty text."""
    names = [*encoded.columns, "decoded"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _pieces(model_path).model
        for whole in batches:
            for start in range(0, whole.num_rows, 256):  # no worker holds the texts of a whole batch
                batch = whole.slice(start, 256)
                texts = [model.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in batch.column(ids_column).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(read, f"{schema}, decoded string")
