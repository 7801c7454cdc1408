"""Unigram encoding and decoding with the pieces of a SentencePiece file.

Method. Pieces lie in a double-array trie over UTF-8 bytes. A text, with blanks written as
the marker U+2581 and one marker in front, falls into units wherever no piece can reach across:
in front of a run of markers, since no piece holds a marker after another character, and
between two bytes that follow each other in no piece. So units are segmented on their own. The distinct units of an Arrow batch that the
worker has not met before are segmented together by Viterbi: the best path of every unit, one
position at a time. What no piece covers becomes byte pieces (or the unknown piece). Decoding
joins pieces, turns byte pieces into bytes and markers into blanks.

The log scores are estimated by ``fit``, as the files at hand hold merge ranks: Spark counts
the distinct units of all documents, and expectation maximisation over that table gives each
piece its expected share among all segmentations, weighted by their probability. Every step
is a job that sums expected counts by piece; only sums by piece reach the driver.

Ties go to the path whose last piece is longer, at each position. Defined cases: a null
text has no pieces (null ids); an empty text has no pieces; decoding of null is null. Repeated
rows get the same ids, each row of its own, and count each in the fit. An empty table has no
rows, and its fit is the starting scores. A text of any length is taken whole. U+2581 in a text
is a blank after the round trip, as the library has it. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdraft.llm import textvec
from sparkdraft.llm.common import broadcast_value, stored

MARKER = "▁"
#: Units up to this many bytes are segmented together, longer ones one by one.
SHORT = 48
#: Below the lowest score, for a character that no piece covers.
UNKNOWN_PENALTY = 10.0
#: About what a byte of text costs in log score.
SCALE = 2.5
#: Bytes of text, or four times as many as piece ids, that are encoded or decoded at once: a task
#: holds copies of so much, not of a whole Arrow batch, and hands out as small ones.
PART = 1 << 21
#: Bytes of an Arrow batch where texts are only counted.
BATCH = 4 << 20
#: Units that a worker keeps with their ids, by hash; beyond that it starts anew.
KEPT_UNITS = 500_000


@dataclass(frozen=True)
class Parameters:
    """EM ends when a step gains less than ``gain`` of the log likelihood, or after ``steps``.

    ``smoothing`` is added to the expected count of each piece, so that none is lost.
    """

    steps: int = 12
    gain: float = 1e-3
    smoothing: float = 0.1


@dataclass(frozen=True)
class Pieces:
    """Piece bytes by id, log scores, byte piece ids and the unknown id."""

    pieces: tuple[bytes, ...]
    scores: np.ndarray
    bytes_: np.ndarray
    unknown: int
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @cached_property
    def adjacent(self) -> np.ndarray:
        """Whether a byte follows another inside of some piece, at 256 * first + second."""
        out = np.zeros(1 << 16, bool)
        for i in np.unique(self.value[self.value >= 0]):
            b = np.frombuffer(self.pieces[i], np.uint8).astype(np.int64)
            out[b[:-1] * 256 + b[1:]] = True
        return out

    @cached_property
    def met(self) -> list[textvec.SpanIds]:
        """The ids of units met before, in a list of one; a worker keeps them with the pieces."""
        return [textvec.SpanIds()]

    @cached_property
    def shown(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes that pieces decode to, one after the other, their starts and lengths."""
        table = [piece.replace(MARKER.encode(), b" ") for piece in self.pieces]
        for b, i in enumerate(self.bytes_):
            if i >= 0:
                table[i] = bytes([b])
        lengths = np.array([len(t) for t in table], np.int64)
        return np.frombuffer(b"".join(table), np.uint8), np.cumsum(lengths) - lengths, lengths

    @cached_property
    def lowest(self) -> float:
        """The score of a character that no piece covers."""
        return float(self.scores[self.value[self.value >= 0]].min() - UNKNOWN_PENALTY)


def double_array(words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value): child of state s by byte b is base[s] + b + 1 if check says s."""
    children: dict[bytes, list[int]] = {b"": []}
    for w in words:
        for i in range(len(w)):
            if w[: i + 1] not in children:
                children[w[: i + 1]] = []
                children[w[:i]].append(w[i])
    # States with one child fill the gaps that the spans of the others leave.
    spans = sum(max(kids) - min(kids) + 1 for kids in children.values() if len(kids) > 1)
    size = spans + len(children) + 600
    base, check, value = (np.zeros(size, np.int32), np.full(size, -1, np.int32),
                          np.full(size, -1, np.int32))
    used = bytearray(size)
    used[: 257] = b"\1" * 257
    low = top = 257
    queue = [(b"", 0)]
    for prefix, state in queue:
        value[state] = words.get(prefix, -1)
        kids = children[prefix]
        if not kids:
            continue
        if len(kids) == 1:
            while used[low]:
                low += 1
            b = low - kids[0] - 1
        else:
            b = top - min(kids) - 1
            while any(used[b + k + 1] for k in kids):
                b += 1
            top = b + max(kids) + 2
        base[state] = b
        for k in kids:
            used[b + k + 1] = 1
            check[b + k + 1] = state
            queue.append((prefix + bytes([k]), b + k + 1))
    return base, check, value


def load(path: str) -> Pieces:
    """The pieces of a SentencePiece model file with byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    byte_ids = np.full(256, -1, np.int32)
    for i, name in enumerate(names):
        if sp.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
    plain = {n.encode(): i for i, n in enumerate(names)
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    bad = [n for n in plain if MARKER in n.decode().lstrip(MARKER)]
    if bad:
        raise ValueError(f"a marker stands inside of {len(bad)} pieces")
    scores = np.array([sp.get_score(i) for i in range(len(names))])
    return Pieces(tuple(n.encode() for n in names), scores, byte_ids, sp.unk_id(),
                  *double_array(plain))


def _edges(rows: np.ndarray, lengths: np.ndarray, p: Pieces) -> Iterator[tuple]:
    """(first byte, end, rows, piece ids) of what the trie finds in byte strings, by first byte.

    The strings are a zero-padded matrix. Id -2 stands for a character that no piece covers.
    A row stands in one group of a (first, end) at most once.
    """
    n, width = rows.shape
    head = (rows & 0xC0) != 0x80
    for s in range(width):
        live = np.flatnonzero((lengths > s) & head[:, s])
        state, at, single = np.zeros(len(live), np.int64), live, np.zeros(n, bool)
        char = np.ones(n, np.int64)
        for k in range(1, 4):
            if s + k < width:
                char += (lengths > s + k) & ~head[:, s + k] & (char == k)
        e = s
        while len(at) and e < width:
            ok = lengths[at] > e
            at, state = at[ok], state[ok]
            nxt = p.base[state].astype(np.int64) + rows[at, e] + 1
            ok = (nxt < len(p.check))
            ok[ok] = p.check[nxt[ok]] == state[ok]
            at, state = at[ok], nxt[ok]
            e += 1
            got = p.value[state] >= 0
            if got.any():
                u = at[got]
                single[u[char[u] == e - s]] = True
                yield s, e, u, p.value[state[got]]
        bare = live[~single[live]]
        for size in np.unique(char[bare]):
            u = bare[char[bare] == size]
            yield s, s + int(size), u, np.full(len(u), -2, np.int32)


def _segment(rows: np.ndarray, lengths: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of byte strings one after the other, and the number of each string's."""
    n, width = rows.shape
    scores = np.append(p.scores, [p.lowest, 0.0])
    best = np.full((width + 1, n), -np.inf)
    best[0] = 0
    back = np.zeros((width + 1, n), np.int32)
    piece = np.full((width + 1, n), -1, np.int32)
    for s, e, u, ids in _edges(rows, lengths, p):
        # Index -2 is the score of a bare character.
        score = best[s][u] + scores[ids]
        win = score > best[e][u]
        u = u[win]
        best[e][u], back[e][u], piece[e][u] = score[win], s, ids[win]
    steps, at, end = [], np.arange(n), lengths.astype(np.int64)
    while len(at):
        s, k = back[end, at].astype(np.int64), piece[end, at]
        steps.append((at, s, end, k))
        at, end = at[s > 0], s[s > 0]
    at, s, end, k = (np.concatenate(x) for x in zip(*steps))
    order = np.lexsort((s, at))
    at, s, end, k = at[order], s[order], end[order], k[order]
    # What no piece covers: its bytes, if all of them have a piece.
    bare = np.flatnonzero(k == -2)
    sizes = np.ones(len(k), np.int64)
    known = np.zeros(0, bool)
    if len(bare):
        spans = end[bare] - s[bare]
        ids = p.bytes_[rows[np.repeat(at[bare], spans), textvec.ranges(s[bare], spans)]]
        first = np.cumsum(spans) - spans
        known = np.minimum.reduceat(ids, first) >= 0
        sizes[bare[known]] = spans[known]
        k[bare[~known]] = p.unknown
    out = np.repeat(k, sizes)
    if known.any():
        places = textvec.ranges((np.cumsum(sizes) - sizes)[bare[known]], spans[known])
        out[places] = ids[np.repeat(known, spans)]
    return out.astype(np.int32), np.bincount(at, sizes, n).astype(np.int64)


def _matrices(units: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(their places, byte rows, lengths) of units of 1 to ``SHORT`` bytes, of near length."""
    sizes = np.array([len(u) for u in units])
    edges = [0, 4, 6, 8, 10, 12, 16, 24, SHORT]
    for lo, hi in zip(edges, edges[1:]):
        index = np.flatnonzero((sizes > lo) & (sizes <= hi))
        for part in np.array_split(index, max(1, len(index) // 5_000)):
            if len(part):
                rows = np.zeros((len(part), hi), np.uint8)
                flat = np.frombuffer(b"".join([units[i] for i in part]), np.uint8)
                rows[np.repeat(np.arange(len(part)), sizes[part]),
                     textvec.ranges(np.zeros(len(part), np.int64), sizes[part])] = flat
                yield part, rows, sizes[part]


def encode_units(units: list[bytes], p: Pieces) -> list[np.ndarray]:
    """Piece ids of each unit; units of near length share one pass."""
    out: list[np.ndarray] = [np.empty(0, np.int32)] * len(units)
    for part, rows, sizes in _matrices(units):
        flat, counts = _segment(rows, sizes, p)
        ends = np.cumsum(counts)
        for i, a, b in zip(part.tolist(), (ends - counts).tolist(), ends.tolist()):
            out[i] = flat[a:b]
    for i, unit in enumerate(units):
        if len(unit) > SHORT:
            out[i] = _long_unit(unit, p)
    return out


def expected(units: list[bytes], weights: np.ndarray, p: Pieces) -> tuple[np.ndarray, float]:
    """Expected counts of each piece over all segmentations of weighted units, and their
    log likelihood. Units over ``SHORT`` bytes, and those whose probability is too small for a
    double, count with their best path.
    """
    counts, total = np.zeros(len(p.scores) + 1), 0.0
    single = [i for i, u in enumerate(units) if len(u) > SHORT]
    # Probabilities are scaled by exp(SCALE) for each byte, so that products stay in range.
    odds = np.exp(np.append(p.scores, [p.lowest, 0.0]))
    scale = np.exp(SCALE * np.arange(SHORT + 1))
    for part, rows, sizes in _matrices(units):
        n, width = rows.shape
        every = np.arange(n)
        ahead, behind = np.zeros((2, width + 1, n))
        ahead[0], behind[sizes, every] = 1, 1
        edges = [(s, e, u, ids, odds[ids] * scale[e - s]) for s, e, u, ids in _edges(rows, sizes, p)]
        for s, e, u, _, q in edges:
            ahead[e][u] += ahead[s][u] * q
        whole = ahead[sizes, every]
        lost = whole < 1e-290
        single += part[lost].tolist()
        w = np.where(lost, 0.0, weights[part])
        share = w / np.where(lost, 1.0, whole)
        used, uses = [], []
        for s, e, u, ids, q in reversed(edges):
            rest = q * behind[e][u]
            behind[s][u] += rest
            used.append(ids)
            uses.append(ahead[s][u] * rest * share[u])
        ids = np.concatenate(used)
        counts += np.bincount(np.where(ids < 0, len(p.scores), ids), np.concatenate(uses),
                              len(counts))
        total += float(((np.log(np.where(lost, 1.0, whole)) - SCALE * sizes) * w).sum())
    for i in single:
        ids = _long_unit(units[i], p)
        plain = ids[~np.isin(ids, p.bytes_) & (ids != p.unknown)]
        counts += np.bincount(plain, minlength=len(counts)) * weights[i]
        total += float(p.scores[plain].sum()) * weights[i]
    return counts[:-1], total


def _long_unit(unit: bytes, p: Pieces) -> np.ndarray:
    """Viterbi of one long unit, in time and memory proportional to it."""
    n = len(unit)
    low = p.lowest
    best, back, piece = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
    best[0] = 0.0
    for s in range(n):
        if unit[s] & 0xC0 == 0x80 or best[s] == -np.inf:
            continue
        size = 1
        while s + size < n and unit[s + size] & 0xC0 == 0x80:
            size += 1
        state, single, e = 0, False, s
        while e < n:
            nxt = int(p.base[state]) + unit[e] + 1
            if nxt >= len(p.check) or p.check[nxt] != state:
                break
            state, e = nxt, e + 1
            k = int(p.value[state])
            if k >= 0:
                single = single or e - s == size
                score = best[s] + float(p.scores[k])
                if score > best[e]:
                    best[e], back[e], piece[e] = score, s, k
        if not single and best[s] + low > best[s + size]:
            best[s + size], back[s + size], piece[s + size] = best[s] + low, s, -2
    path, e = [], n
    while e > 0:
        s, k = back[e], piece[e]
        if k == -2:
            known = p.bytes_[list(unit[s:e])]
            path.extend(known[::-1] if (known >= 0).all() else [p.unknown])
        else:
            path.append(k)
        e = s
    return np.array(path[::-1], np.int32)


def _marked(column: pa.Array) -> pa.Array:
    import pyarrow.compute as pc

    text = pc.replace_substring(column, " ", MARKER)
    return pc.if_else(pc.equal(pc.binary_length(column), 0), "",
                      pc.binary_join_element_wise(MARKER, text, ""))


def _unit_spans(buf: np.ndarray, offs: np.ndarray, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the units of marked texts."""
    mark = np.frombuffer(MARKER.encode(), np.uint8)
    is_mark = np.zeros(len(buf), bool)
    is_mark[:-2] = (buf[:-2] == mark[0]) & (buf[1:-1] == mark[1]) & (buf[2:] == mark[2])
    start = is_mark.copy()
    start[3:] &= ~is_mark[:-3]
    pairs = buf[:-1].astype(np.int32) * 256 + buf[1:]
    start[1:] |= ~p.adjacent[pairs] & ((buf[1:] & 0xC0) != 0x80)
    start[offs[:-1][offs[:-1] < offs[1:]]] = True
    begins = np.flatnonzero(start)
    return begins, np.append(begins[1:], len(buf)) if len(begins) else begins


def _distinct(buf: np.ndarray, begins: np.ndarray, ends: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted 64-bit hashes of the distinct units of a chunk, a span of each, and the number
    of each span's."""
    hashes = textvec.span_hashes(buf, begins, ends)
    return np.unique(hashes, return_index=True, return_inverse=True)


def _units(buf: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw = buf.tobytes()
    return [raw[a:b] for a, b in zip(begins.tolist(), ends.tolist())]


def encode_column(texts: pa.Array, p: Pieces) -> pa.Array:
    """A list of piece ids for each text; null for null."""
    flat, sizes = [], np.zeros(len(texts), np.int64)
    for row, end, buf, offs in textvec.chunks(_marked(texts)):
        begins, ends = _unit_spans(buf, offs, p)
        keys, first, inverse = _distinct(buf, begins, ends)
        if p.met[0].full(KEPT_UNITS):
            p.met[0] = textvec.SpanIds()
        met = p.met[0]
        where, n = met.find(keys)
        new = np.flatnonzero(where < 0)
        coded = encode_units(_units(buf, begins[first[new]], ends[first[new]]), p)
        n[new] = [len(c) for c in coded]
        where[new] = met.add(keys[new], np.concatenate([np.empty(0, np.int32), *coded]), n[new])
        flat.append(met.ids[textvec.ranges(where[inverse], n[inverse])])
        heads = np.searchsorted(begins, offs)
        done = np.concatenate([[0], np.cumsum(n[inverse])])
        sizes[row:end] = done[heads[1:]] - done[heads[:-1]]
    out = textvec.list_array(pa.array(np.concatenate([np.empty(0, np.int32), *flat])), sizes)
    if not texts.null_count:
        return out
    return pa.ListArray.from_arrays(out.offsets, out.values, mask=texts.is_null())


def decode_column(ids: pa.Array, p: Pieces) -> pa.Array:
    """The text of each list of piece ids; invalid byte sequences become U+FFFD."""
    held, starts, lengths = p.shown
    nulls = ids.is_null().to_numpy(zero_copy_only=False)
    out, counts = [], ids.value_lengths().fill_null(0).to_numpy()
    values = ids.flatten().to_numpy()
    bounds = np.concatenate([[0], np.cumsum(counts)])
    for row, end in textvec.cuts(counts, textvec.CHUNK // 4):
        part = values[bounds[row]:bounds[end]]
        raw = held[textvec.ranges(starts[part], lengths[part])].tobytes()
        done = np.concatenate([[0], np.cumsum(lengths[part])])[bounds[row:end + 1] - bounds[row]]
        for a, b, null in zip(done[:-1].tolist(), done[1:].tolist(), nulls[row:end].tolist()):
            # The blank in front stands for the marker that encoding puts there.
            a += raw[a:a + 1] == b" " and a < b
            out.append(None if null else raw[a:b].decode("utf-8", "replace"))
    return pa.array(out, pa.string())


def unit_counts(docs: DataFrame, held: Broadcast, text: str = "text") -> DataFrame:
    """(unit, n): the distinct units of all texts and how often each occurs, by broadcast pieces."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (part for batch in batches for part in textvec.parts(batch.column(0), PART))
        for part in texts:
            for _, _, buf, offs in textvec.chunks(_marked(part.fill_null(""))):
                begins, ends = _unit_spans(buf, offs, held.value)
                _, first, inverse = _distinct(buf, begins, ends)
                units = _units(buf, begins[first], ends[first])
                n = np.bincount(inverse, minlength=len(units))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(units, pa.binary()), pa.array(n, pa.int64())], ["unit", "n"])

    return docs.select(F.col(text).cast("string")).mapInArrow(count, "unit binary, n long").groupBy(
        "unit").agg(F.sum("n").alias("n"))


def start(p: Pieces) -> Pieces:
    """The pieces with scores by their rank: the share of rank r falls as 1 / (r + 1)."""
    plain = np.unique(p.value[p.value >= 0])
    rank = np.empty(len(plain))
    rank[np.lexsort((plain, -p.scores[plain]))] = np.arange(1, len(plain) + 1)
    scores = p.scores.astype(float).copy()
    scores[plain] = -np.log(rank) - np.log((1 / rank).sum())
    return replace(p, scores=scores)


def maximised(counts: np.ndarray, p: Pieces, smoothing: float) -> Pieces:
    """The pieces with the log of their smoothed shares of expected counts."""
    plain = np.unique(p.value[p.value >= 0])
    share = counts[plain] + smoothing
    scores = p.scores.copy()
    scores[plain] = np.log(share) - np.log(share.sum())
    return replace(p, scores=scores)


def fit(docs: DataFrame, path: str, p: Parameters = Parameters(), text: str = "text") -> Pieces:
    """The pieces of a file with log scores estimated by EM over all texts of ``docs``."""
    spark, model, before = docs.sparkSession, start(load(path)), None
    held = broadcast_value(spark, model)
    units = stored(unit_counts(docs, held, text), "units", None, BATCH)
    for _ in range(p.steps):
        # Workers keep what was broadcast: only the scores are sent anew.
        scores = model.scores

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, total = np.zeros(len(scores)), 0.0
            pieces = replace(held.value, scores=scores)
            for b in batches:
                c, t = expected(b.column(0).to_pylist(), b.column(1).to_numpy().astype(float),
                                pieces)
                counts, total = counts + c, total + t
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(used, -1), pa.int32()),
                 pa.array(np.append(counts[used], total))], ["piece", "count"])

        sums = units.mapInArrow(step, "piece int, count double").groupBy("piece").agg(
            F.sum("count").alias("count")).collect()
        counts, total = np.zeros(len(model.scores)), 0.0
        for r in sums:
            if r.piece >= 0:
                counts[r.piece] = r["count"]
            else:
                total = r["count"]
        if not counts.any():
            return model
        model = maximised(counts, model, p.smoothing)
        if before is not None and total - before < p.gain * abs(before):
            break
        before = total
    return model


def encoded(batches: Iterator[pa.Array], p: Pieces) -> Iterator[pa.Array]:
    """The piece ids of batches of texts, in smaller batches."""
    for batch in batches:
        for part in textvec.parts(batch, PART):
            yield encode_column(part, p)


def decoded(batches: Iterator[pa.Array], p: Pieces) -> Iterator[pa.Array]:
    """The texts of batches of lists of piece ids, in smaller batches."""
    for batch in batches:
        for part in textvec.parts(batch, PART // 4):
            yield decode_column(part, p)


def encode(text: Column, model: Pieces, df: DataFrame) -> Column:
    """Piece ids of a text column of ``df``."""
    held = broadcast_value(df.sparkSession, model)

    @F.arrow_udf("array<int>")
    def piece_ids(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return encoded(texts, held.value)

    return piece_ids(text)


def decode(ids: Column, model: Pieces, df: DataFrame) -> Column:
    """The text of a column of piece ids."""
    held = broadcast_value(df.sparkSession, model)

    @F.arrow_udf("string")
    def piece_text(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return decoded(lists, held.value)

    return piece_text(ids)
