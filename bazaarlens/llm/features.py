"""Text features for the trained classifiers, from whole texts as bytes."""
from __future__ import annotations

import numpy as np

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MIX = np.uint32(2654435761)  # Knuth's multiplicative hash


def gram_counts(text: np.ndarray, bits: int, sizes: tuple[int, ...], lower: bool = True) -> np.ndarray:
    """Counts of the byte n-grams of a text in ``2 ** bits`` hashed places, each size divided by its number of grams."""
    out = np.zeros(1 << bits, np.float32)
    data = _LOWER[text] if lower else text
    for start in range(0, len(data), 1 << 20):  # a long text in pieces that overlap by a gram
        piece = data[start:start + (1 << 20) + max(sizes) - 1].astype(np.uint32)
        own = min(len(piece), 1 << 20)
        for size in sizes:
            n = min(own, len(piece) - size + 1)
            if n < 1:
                continue
            code = np.full(n, size, np.uint32)
            for k in range(size):
                code = code * np.uint32(257) + piece[k:k + n]
            place = (code * _MIX) >> np.uint32(32 - bits)
            out += np.bincount(place, minlength=1 << bits) / np.float32(max(len(data) - size + 1, 1))
    return out


STYLE = 16


def style(text: np.ndarray) -> np.ndarray:
    """STYLE numbers of how a text is written: shares of kinds of characters, word lengths, repeats, size."""
    n = len(text)
    out = np.zeros(STYLE, np.float32)
    if not n:
        return out
    counts = np.bincount(text, minlength=256)
    share = lambda *r: counts[np.r_[r]].sum() / n
    white = _WHITE[text]
    first = ~white
    first[1:] &= white[:-1]
    words = int(first.sum())
    raw = text.tobytes()
    tokens = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    out[:] = (share(*range(65, 91)), share(*range(97, 123)), share(*range(48, 58)), share(*range(128, 256)), share(33, 63),
              share(35, 36, 37, 38, 42), share(60, 62, 124, 123, 125, 91, 93, 95, 47, 92, 64, 126, 94), share(44, 46, 59, 58), share(10) * 10,
              share(32), n / max(words, 1) / 10, 1 - len(set(tokens)) / max(words, 1), 1 - len(set(lines)) / max(len(lines), 1),
              np.log1p(words) / 10, np.log1p(len(lines)) / 10, min(1.0, 20 / max(words, 1)))
    return out
