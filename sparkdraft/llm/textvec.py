"""Array views of text columns inside Arrow tasks: chunks, words, hashes, groups.

Texts stay in Arrow's own UTF-8 buffer; words and shingles become 64-bit hashes by array
arithmetic, with no Python object per word. Chunks bound the memory: a chunk holds whole
documents up to ``CHUNK`` bytes, and one longer document is hashed piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
#: Odd multipliers of the hashes: the 64-bit golden ratio and two powers of it.
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_POWERS: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * GOLDEN
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse, at least ``n`` of each."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        base = int(GOLDEN) * 4 + 1 & (1 << 64) - 1
        for name, b in (("up", base), ("down", pow(base, -1, 1 << 64))):
            steps = np.full(size, np.uint64(b))
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span ``values[start:end]``; equal spans have equal hashes.

    ``values`` are small unsigned integers (bytes or code points).
    """
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = powers(len(values) + 1)
    total = np.empty(len(values) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_mixed(values) * up[: len(values)], out=total[1:])
    raw = (total[ends] - total[starts]) * down[starts]
    return mix64(raw + (ends - starts).astype(np.uint64) * GOLDEN)


BYTE_MIX = mix64(np.arange(1, 257, dtype=np.uint64))
#: The same for the code points of the first plane.
PLANE_MIX = mix64(np.arange(1, (1 << 16) + 1, dtype=np.uint64))


def _mixed(values: np.ndarray) -> np.ndarray:
    if values.dtype == np.uint8:
        return BYTE_MIX[values]
    if values.max() < 1 << 16:
        return PLANE_MIX[values]
    return mix64(values.astype(np.uint64) + np.uint64(1))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[32, 9, 10, 11, 12, 13]] = True

NOT_WORD = np.ones(256, bool)
NOT_WORD[128:] = NOT_WORD[48:58] = NOT_WORD[65:91] = NOT_WORD[97:123] = False


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, its offsets (one more than rows), and its null mask."""
    column = column.cast(pa.large_string())
    if column.null_count:
        nulls = column.is_null().to_numpy(zero_copy_only=False)
        column = column.fill_null("")
    else:
        nulls = np.zeros(len(column), bool)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    buf = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return buf, offs, nulls


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of groups of whole documents."""
    buf, offs, _ = text_bytes(column)
    row, rows = 0, len(offs) - 1
    while row < rows:
        end = int(np.searchsorted(offs, offs[row] + limit, "right")) - 1
        end = min(rows, max(row + 1, end))
        yield row, end, buf[offs[row]:offs[end]], offs[row:end + 1] - offs[row]
        row = end


def cuts(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """(first row, end row) of groups of rows of ``limit`` together; a larger row is alone."""
    done = np.concatenate([[0], np.cumsum(sizes)])
    row = 0
    while row < len(sizes):
        end = max(row + 1, int(np.searchsorted(done, done[row] + limit, "right")) - 1)
        yield row, end
        row = end


def parts(column: pa.Array, limit: int) -> Iterator[pa.Array]:
    """Views of the rows of a text or list column, some ``limit`` bytes or entries each.

    What a task derives from a column is then bounded, however large the Arrow batch.
    """
    import pyarrow.compute as pc

    lists = pa.types.is_list(column.type) or pa.types.is_large_list(column.type)
    length = pc.list_value_length if lists else pc.binary_length
    for row, end in cuts(length(column).fill_null(0).to_numpy(zero_copy_only=False), limit):
        yield column.slice(row, end - row)


def word_spans(blank: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs that are not blank; a run ends with its document."""
    word = ~blank
    first = word.copy()
    first[1:] &= blank[:-1]
    heads = offs[:-1][offs[:-1] < offs[1:]]
    first[heads] = word[heads]
    last = word.copy()
    last[:-1] &= blank[1:]
    last[heads[1:] - 1] = word[heads[1:] - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(buf: np.ndarray, offs: np.ndarray, piece: int = 2 * CHUNK,
                between: np.ndarray = IS_BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of documents, and the number of words of each.

    A-Z count as a-z. ``between`` marks the bytes that part words: blank, tab and the line
    breaks, or with ``NOT_WORD`` every ASCII character but letters and digits.
    """
    starts, ends = word_spans(between[buf], offs)
    counts = np.diff(np.searchsorted(starts, offs))
    out, k = [], 0
    while k < len(starts):
        to = max(k + 1, int(np.searchsorted(ends, starts[k] + piece, "right")))
        a, b = starts[k], ends[to - 1]
        out.append(span_hashes(LOWER[buf[a:b]], starts[k:to] - a, ends[k:to] - a))
        k = to
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), counts


def shingles(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and how many each document has.

    A document of fewer words, but not none, has its whole sequence as the only run.
    """
    mult = mix64(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    total = len(words)
    acc = np.zeros(max(0, total - size + 1), np.uint64)
    for j in range(size):
        acc += words[j:j + len(acc)] * mult[j]
    acc = mix64(acc)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    keep = np.zeros(total + 1, np.int64)
    full = np.flatnonzero(counts >= size)
    np.add.at(keep, bounds[full], 1)
    np.add.at(keep, bounds[full] + n[full], -1)
    inside = np.flatnonzero(np.cumsum(keep)[:total] > 0)
    out = np.empty(int(n.sum()), np.uint64)
    places = np.concatenate([[0], np.cumsum(n)])
    short = np.flatnonzero((counts < size) & (counts > 0))
    mask = np.ones(len(out), bool)
    mask[places[short]] = False
    out[mask] = acc[inside]
    for d in short:
        w = words[bounds[d]:bounds[d + 1]]
        h = (w * mult[: len(w)]).sum(dtype=np.uint64, keepdims=True)
        out[places[d]] = mix64(h + np.array([len(w)], np.uint64) * GOLDEN)[0]
    return out, n


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of ``start .. start + length - 1`` of each pair, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def list_array(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    """An Arrow list column of consecutive runs of ``values``."""
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), values)


class SpanIds:
    """Ids of spans met before, by 64-bit hash, in arrays: some 30 bytes a span.

    Sorted runs of hashes, each at least twice as long as the next: what is new becomes a short
    run, and runs are merged as they come near in size, not all with every chunk.
    """

    def __init__(self) -> None:
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ids, self.used = np.empty(1 << 12, np.int32), 0

    def full(self, spans: int) -> bool:
        """Whether more than ``spans`` are held, or more than eight times as many ids."""
        return sum(len(keys) for keys, _, _ in self.runs) > spans or self.used > 8 * spans

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``ids`` and number of the ids of each key; place -1 for a key not met."""
        at, n = np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        left = np.arange(len(keys))
        for held, starts, sizes in self.runs:
            place = np.minimum(np.searchsorted(held, keys[left]), len(held) - 1)
            same = held[place] == keys[left]
            at[left[same]], n[left[same]] = starts[place[same]], sizes[place[same]]
            left = left[~same]
        return at, n

    def add(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Keep the ids of sorted keys that are not held, and return their places."""
        if self.used + len(ids) > len(self.ids):
            grown = np.empty(max(2 * len(self.ids), self.used + len(ids)), np.int32)
            grown[:self.used] = self.ids[:self.used]
            self.ids = grown
        at = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        if len(keys):
            self.runs.append((keys, at, sizes))
        while len(self.runs) > 1 and len(self.runs[-2][0]) < 2 * len(self.runs[-1][0]):
            both = [np.concatenate(x) for x in zip(*self.runs[-2:])]
            order = np.argsort(both[0], kind="stable")
            self.runs[-2:] = [tuple(x[order] for x in both)]
        return at
