"""Words of Arrow text batches as numpy arrays: positions and 64-bit hashes, many documents at a time.

Words are hashed eight bytes a step through two mixers that are not linear, so no pair of words collides by its structure
(sums of letters times powers modulo 2**64 do, whatever the base). Two different words have one hash by chance only, about
once in 2**64 pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_rng = np.random.default_rng(20240607)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)
BASE = U(0x9E3779B97F4A7C15)
GRAM_BASE = U(0xD6E8FEB86659FD93)
#: Bytes of a long range that are hashed as one piece; the hashes of the pieces are hashed in turn.
PIECE = 64
_FIRST = np.asarray([(1 << 8 * k) - 1 for k in range(9)], U)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of plain words: everything in ASCII but letters and digits.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:128] = [not chr(i).isalnum() for i in range(128)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche, bijective on 64 bits."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


def _mix_other(x: np.ndarray) -> np.ndarray:
    """Another finaliser, as ``mix``."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def hashed(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges. Ranges of more than ``PIECE`` bytes are hashed by pieces, and the pieces' hashes likewise."""
    size = lengths.astype(U)
    if len(lengths) and int(lengths.max()) > PIECE:
        out = np.zeros(len(lengths), U)
        short = lengths <= PIECE
        out[short] = hashed(raw, starts[short], lengths[short])
        starts, lengths = starts[~short], lengths[~short]
        pieces = -(-lengths // PIECE)
        first = np.cumsum(pieces) - pieces
        inside = PIECE * (np.arange(int(pieces.sum())) - np.repeat(first, pieces))
        parts = hashed(raw, np.repeat(starts, pieces) + inside, np.minimum(PIECE, np.repeat(lengths, pieces) - inside))
        out[~short] = mix(hashed(parts.view(np.uint8), 8 * first, 8 * pieces) ^ (lengths.astype(U) * BASE))
        return out
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    x, y = mix(size + BASE), _mix_other(size + GRAM_BASE)
    own, at, rest = None, starts, lengths  # ``own``: ranges that go on, all of them at first
    while len(at):
        part = eight[at] & _FIRST[np.minimum(rest, 8)]
        if own is None:
            x, y = mix(x ^ part), _mix_other(y + part)
        else:
            x[own], y[own] = mix(x[own] ^ part), _mix_other(y[own] + part)
        more = np.flatnonzero(rest > 8)
        own, at, rest = more if own is None else own[more], at[more] + 8, rest[more] - 8
    return mix(x + (y << U(23) | y >> U(41)))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and n + 1 offsets; nulls are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) of runs of rows with about ``limit`` bytes; a longer text is a run of its own."""
    raw, at = flat(column)
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, last - first, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def words(raw: np.ndarray, at: np.ndarray, separator: np.ndarray = SPACE, fold: np.ndarray | None = LOWER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, start and end bytes of all words, and for each text the number of the first word (n + 1 entries)."""
    inside = ~separator[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = at[:-1][at[:-1] < len(raw)]
    begins[cut] = inside[cut]
    starts = np.flatnonzero(begins)
    if not len(starts):
        empty = np.zeros(0, np.int64)
        return np.zeros(0, U), empty, empty, np.zeros(len(at), np.int64)
    ends = np.zeros(len(raw) + 1, bool)
    ends[1:] = inside
    ends[1:-1] &= ~inside[1:]
    cut = at[1:-1]
    ends[cut[cut > 0]] = inside[cut[cut > 0] - 1]
    lengths = np.flatnonzero(ends) - starts
    return hashed(raw if fold is None else fold[raw], starts, lengths), starts, starts + lengths, np.searchsorted(starts, at)


def grams(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words inside one text, and n + 1 offsets; texts with fewer words have none."""
    n = len(hashes) - k + 1
    counts = np.maximum(np.diff(first) - k + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    if n <= 0 or not offsets[-1]:
        return np.zeros(0, U), np.zeros(len(first), np.int64)
    total = np.zeros(n, U)
    for j in range(k):
        total = total * GRAM_BASE + hashes[j : j + n]
    pick = np.repeat(first[:-1] - offsets[:-1], counts) + np.arange(offsets[-1])
    return mix(total[pick] + U(k)), offsets
