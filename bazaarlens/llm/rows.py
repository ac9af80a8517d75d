"""Small helpers that the operators share."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points between words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores, whichever no column of ``df`` has (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_crc32(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Key of a row where ids may repeat: the id and 128 bits of the text. Rows equal in both get equal results."""
    return [doc_id.cast("long").alias("doc_id"), F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("text_md5")]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a batch as one array of UTF-8 bytes and the offsets of each text; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def bounded(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose texts take up to ``most_bytes``; one longer text is a slice of its own."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + most_bytes, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
