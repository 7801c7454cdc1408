"""A token file: canonical length-limited Huffman codes in independent blocks.

Tokens come from the tokenizers library. Each batch is split into the pre-tokens of the
byte-level pattern by array operations; the library encodes every distinct one once (a
bounded cache per worker), since it never merges across pre-tokens. Texts with an
apostrophe or a special token's string go through the library whole.

The file is a folder of Parquet tables, so any store that Spark writes will do: ``code`` (code
lengths by id) and ``blocks``. A block holds about ``BLOCK`` tokens of consecutive documents
in ascending doc_id order, with a bit offset every ``EVERY`` tokens; it is decoded alone, all
its offsets in step, through one lookup table. Longer documents span several blocks.

Defined cases. A null text is encoded like an empty one: the end id alone. Rows with a null
id come first. Repeated rows are all written, in order of their tokens. An empty table
gives a file without blocks.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkdraft.llm import textvec
from sparkdraft.llm.common import broadcast_value
from sparkdraft.session import work_dir

LONGEST = 20
BLOCK, EVERY = 1 << 16, 128
CACHED = 2_000_000
_STATE: dict = {}


def _classes() -> np.ndarray:
    """0 other, 1 letter, 2 number, 3 white space, by code point."""
    if "classes" not in _STATE:
        names = "".join(map(unicodedata.category, map(chr, range(0x110000))))
        first = np.frombuffer(names.encode(), np.uint8)[::2]
        table = (first == ord("L")) + 2 * (first == ord("N")).astype(np.uint8)
        spaces = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                  0x202F, 0x205F, 0x3000]
        table[spaces] = 3
        _STATE["classes"] = table
    return _STATE["classes"]


def pretokens(text: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Start positions of the byte-level pattern's matches, for texts without apostrophes.

    A run of letters, numbers or others takes one blank before it; of a white-space run
    before something else, the last character stands apart; at the end all are one.
    """
    if not len(text):
        return np.empty(0, np.int64)
    kind = _classes()[np.minimum(text, 0x10FFFF)]
    heads = offs[:-1][offs[:-1] < offs[1:]]
    new = np.ones(len(text), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[heads] = True
    space = kind == 3
    last = np.zeros(len(text), bool)
    last[:-1] = space[:-1] & ~space[1:]
    last[heads[1:] - 1] = False
    last[-1] = False
    new |= last
    joined = np.flatnonzero(last & (text == 32)) + 1
    new[joined] = False
    return np.flatnonzero(new)


class _Words:
    """Ids of pre-tokens that the library has encoded, by hash; grows to ``CACHED``."""

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_str(spec)
        self.single = Tokenizer.from_str(spec)
        self.single.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False,
                                                             use_regex=False)
        self.clear()

    def clear(self) -> None:
        self.met = textvec.SpanIds()

    def lookup(self, keys: np.ndarray, texts) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of the ids of sorted distinct ``keys``; ``texts(i)`` gives theirs."""
        if self.met.full(CACHED):
            self.clear()
        at, n = self.met.find(keys)
        fresh = np.flatnonzero(at < 0)
        new, sizes = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for k in range(0, len(fresh), 200):
            words = texts(fresh[k:k + 200])
            e = self.single.encode(words, is_pretokenized=True, add_special_tokens=False)
            new.append(np.array(e.ids, np.int32))
            sizes.append(np.bincount(np.array(e.word_ids, np.int64), minlength=len(words)))
        n[fresh] = np.concatenate(sizes)
        at[fresh] = self.met.add(keys[fresh], np.concatenate(new), n[fresh])
        return at, n


def encode_batch(texts: pa.Array, spec: str) -> tuple[np.ndarray, np.ndarray]:
    """All token ids of the texts one after the other, and how many each has."""
    if _STATE.get("spec") != spec:
        _STATE["spec"], _STATE["words"] = spec, _Words(spec)
    words: _Words = _STATE["words"]
    special = [t.content for t in words.whole.get_added_tokens_decoder().values()]
    flat, sizes = [np.empty(0, np.int32)], np.zeros(len(texts), np.int64)
    for row, end, buf, _ in textvec.chunks(texts):
        part = texts.slice(row, end - row).fill_null("")
        text = buf.tobytes().decode("utf-8", "surrogatepass")
        lengths = pc.utf8_length(part).to_numpy().astype(np.int64)
        if "'" in text or any(s in text for s in special):
            encoded = [e.ids for e in words.whole.encode_batch_fast(
                part.to_pylist(), add_special_tokens=False)]
            sizes[row:end] = [len(x) for x in encoded]
            flat += [np.array(x, np.int32) for x in encoded]
            continue
        offs = np.concatenate([[0], np.cumsum(lengths)])
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        begins = pretokens(points, offs)
        ends = np.append(begins[1:], len(points)) if len(begins) else begins
        hashes = textvec.span_hashes(points, begins, ends)
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at, n = words.lookup(keys, lambda i: [text[a:b] for a, b in zip(
            begins[first[i]].tolist(), ends[first[i]].tolist())])
        flat.append(words.met.ids[textvec.ranges(at[inverse], n[inverse])])
        done = np.concatenate([[0], np.cumsum(n[inverse])])
        edge = np.searchsorted(begins, offs)
        sizes[row:end] = done[edge[1:]] - done[edge[:-1]]
    return np.concatenate(flat), sizes


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal prefix code lengths of at most ``longest`` bits (package-merge); 0: no code."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    used = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[used].astype(np.float64)
    level, masks = leaf, [np.ones(len(leaf), bool)]
    for _ in range(longest - 1):
        even = len(level) // 2 * 2
        both = np.concatenate([leaf, level[0:even:2] + level[1:even:2]])
        order = np.argsort(both, kind="stable")
        masks.append(order < len(leaf))
        level = both[order]
    take = 2 * len(leaf) - 2
    for mask in reversed(masks):
        leaves = int(mask[:take].sum())
        out[used[:leaves]] += 1
        take = 2 * (take - leaves)
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The codes that the lengths imply: ascending by length, then by id."""
    codes, code, before = np.zeros(len(lengths), np.uint64), 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for i in order[np.searchsorted(lengths[order], 1):]:
        code <<= int(lengths[i]) - before
        before = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of the ids' codes, and the bit offset of every ``EVERY``-th id."""
    n = lengths[ids].astype(np.int64)
    at = np.cumsum(n) - n
    word, bit = at >> 6, at & 63
    spill = np.maximum(0, bit + n - 64)
    code = codes[ids]
    here = np.where(spill > 0, code >> spill.astype(np.uint64),
                    code << np.maximum(0, 64 - bit - n).astype(np.uint64))
    firsts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out = np.zeros(int(word[-1]) + 2, np.uint64)
    out[word[firsts]] = np.bitwise_or.reduceat(here, firsts)
    over = np.flatnonzero(spill)
    out[word[over] + 1] |= code[over] << (64 - spill[over]).astype(np.uint64)
    size = (int(at[-1] + n[-1]) + 7) // 8
    return out.astype(">u8").tobytes()[:size], at[::EVERY].astype(np.uint32)


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each bit pattern of ``LONGEST`` bits, the id whose code it starts with, its length."""
    ids = np.zeros(1 << LONGEST, np.int32)
    sizes = np.ones(1 << LONGEST, np.uint8)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    span = np.int64(1) << (LONGEST - lengths[order].astype(np.int64))
    total = int(span.sum())
    ids[:total] = np.repeat(order, span)
    sizes[:total] = np.repeat(lengths[order], span)
    return ids, sizes


def unpack(payloads: list[bytes], marks: list[np.ndarray], counts: list[int],
           table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The ids of several blocks, one after the other; all bit offsets advance in step."""
    data = np.frombuffer(b"".join([p + b"\0" * 8 for p in payloads]), np.uint8)
    window = np.zeros(len(data), np.uint32)
    for k in range(4):
        window[: len(data) - 3] |= data[k:len(data) - 3 + k].astype(np.uint32) << np.uint32(24 - 8 * k)
    start = np.cumsum([0] + [len(p) + 8 for p in payloads[:-1]]) * 8
    bit = np.concatenate([m.astype(np.int64) + s for m, s in zip(marks, start)])
    left = np.concatenate([np.minimum(EVERY, n - np.arange(0, n, EVERY)) for n in counts])
    where = np.cumsum(left) - left
    out = np.empty(int(left.sum()), np.int32)
    ids, sizes = table
    for step in range(EVERY):
        if step and step >= left.min():
            keep = left > step
            bit, where, left = bit[keep], where[keep], left[keep]
            if not len(bit):
                break
        peek = (window[bit >> 3] << (bit & 7).astype(np.uint32)) >> np.uint32(32 - LONGEST)
        out[where + step] = ids[peek]
        bit = bit + sizes[peek]
    return out


def id_type(spec: str, end_id: int) -> str:
    """Two bytes an id where the vocabulary allows it, else four."""
    model = json.loads(spec)
    ids = [*model["model"]["vocab"].values(), *(t["id"] for t in model["added_tokens"]), end_id]
    return "<u2" if max(ids) < 1 << 16 else "<u4"


def tokens(docs: DataFrame, spec: str, end_id: int) -> DataFrame:
    """(doc_id, ids): little-endian ids of each text, ``id_type`` wide, the end id behind them."""
    width = np.dtype(id_type(spec, end_id))
    held = broadcast_value(docs.sparkSession, spec)

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, n = encode_batch(batch.column("text"), held.value)
            at = np.cumsum(n)
            flat = np.insert(flat, at, end_id).astype(width)
            edges = np.concatenate([[0], np.cumsum(n + 1)]) * width.itemsize
            packed = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(n), [None, pa.py_buffer(edges.astype(np.int64)),
                                            pa.py_buffer(flat)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), packed], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, ids binary")


def _counts(batches, width: str) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for x in batch.column("ids").to_pylist():
            got = np.bincount(np.frombuffer(x, width))
            if len(got) > len(total):
                got[: len(total)] += total
                total = got
            else:
                total[: len(got)] += got
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])],
                                     ["id", "n"])


def _block(seg: int, number: int, first: int, docs: list, flat: np.ndarray, codes, lengths):
    payload, marks = pack(flat, codes, lengths)
    return {"seg": seg, "block": number, "first": first, "n": len(flat), "payload": payload,
            "marks": marks.tobytes(), "doc_ids": [d[0] for d in docs],
            "starts": [d[1] for d in docs], "sizes": [d[2] for d in docs]}


def write(docs: DataFrame, path: str, spec: str, end_id: int = 2) -> None:
    """The documents' tokens as a token file at ``path``; ``spec`` is the tokenizer's JSON."""
    spark = docs.sparkSession
    staged = f"{work_dir(spark, 'tokens')}"
    tokens(docs, spec, end_id).write.option("compression", "zstd").parquet(staged)
    ids = spark.read.parquet(staged)
    width = id_type(spec, end_id)
    seen = ids.mapInArrow(lambda batches: _counts(batches, width), "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counted = seen.toArrow()  # a row for each id of the vocabulary
    most = max(counted.column("id").to_pylist(), default=0)
    counts = np.zeros(most + 1, np.int64)
    counts[counted.column("id").to_numpy()] = counted.column("n").to_numpy()
    lengths = code_lengths(counts)
    spark.createDataFrame([(lengths.tobytes(),)], "lengths binary").coalesce(1).write.parquet(
        f"{path}/code")
    held = broadcast_value(spark, lengths)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"seg int, block int, first long, n int, payload binary, marks binary, "
              f"doc_ids array<{kind}>, starts array<long>, sizes array<int>")

    def blocks(batches) -> Iterator[pa.RecordBatch]:
        lengths, seg = held.value, TaskContext.get().partitionId()
        codes = canonical(lengths)
        docs_, parts, n, done, number = [], [], 0, 0, 0
        arrow = None

        def flush() -> pa.RecordBatch:
            nonlocal docs_, parts, n, done, number
            row = _block(seg, number, done, docs_, np.concatenate(parts), codes, lengths)
            done, number, docs_, parts, n = done + n, number + 1, [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            arrow = arrow or pa.schema([
                ("seg", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n", pa.int32()),
                ("payload", pa.binary()), ("marks", pa.binary()),
                ("doc_ids", pa.list_(batch.column("doc_id").type)),
                ("starts", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))])
            for doc, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                rest, start = np.frombuffer(raw, width), done + n
                while len(rest):
                    part, rest = rest[: BLOCK - n], rest[BLOCK - n:]
                    docs_.append((doc, start, len(part)))
                    parts.append(part)
                    n += len(part)
                    if n == BLOCK:
                        yield flush()
        if n:
            yield flush()

    parts = max(1, ids.rdd.getNumPartitions())
    ordered = ids.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(blocks, schema).write.option("compression", "none").parquet(f"{path}/blocks")


def _crc_join(parts: list[tuple[int, int]]) -> int:
    """crc32 of a concatenation, from the crc32 and length of each part."""
    def times(mat: list[int], vec: int) -> int:
        out = 0
        for row in mat:
            if vec & 1:
                out ^= row
            vec >>= 1
        return out

    crc = parts[0][0]
    for more, size in parts[1:]:
        mat = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
        bits = size * 8
        while bits:
            if bits & 1:
                crc = times(mat, crc)
            bits >>= 1
            if bits:
                mat = [times(mat, row) for row in mat]
        crc ^= more
    return crc


def read(spark, path: str) -> DataFrame:
    """(seg, doc_id, start, part, ids) of each document part in a file, decoded."""
    lengths = np.frombuffer(spark.read.parquet(f"{path}/code").first().lengths, np.uint8)
    return _decoded(spark, path, lengths, digest=False)


def digests(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document of a file."""
    lengths = np.frombuffer(spark.read.parquet(f"{path}/code").first().lengths, np.uint8)
    blocks = spark.read.parquet(f"{path}/blocks")
    sizes = blocks.groupBy("seg").agg(F.sum("n").alias("size"))
    before = Window.orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("seg", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    parts = _decoded(spark, path, lengths, digest=True)
    docs = parts.groupBy("seg", "start").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"), F.sum("n").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("part", "crc", "n"))).alias("parts"))

    @F.arrow_udf("long")
    def joined(column: pa.Array) -> pa.Array:
        return pa.array([_crc_join([(x["crc"], 4 * x["n"]) for x in row])
                         for row in column.to_pylist()], pa.int64())

    crc = F.when(F.size("parts") == 1, F.get("parts", 0)["crc"]).otherwise(joined("parts"))
    return docs.withColumn("ids_crc32", crc).join(sizes, "seg").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def _decoded(spark, path: str, lengths: np.ndarray, digest: bool) -> DataFrame:
    held = broadcast_value(spark, lengths)
    blocks = spark.read.parquet(f"{path}/blocks")

    def rows(batches) -> Iterator[pa.RecordBatch]:
        table = decoding_table(held.value)
        for batch in batches:
            for k in range(0, len(batch), 16):
                some = batch.slice(k, 16)
                counts = some.column("n").to_pylist()
                ids = unpack(some.column("payload").to_pylist(),
                             [np.frombuffer(m, np.uint32) for m in some.column("marks").to_pylist()],
                             counts, table).astype("<i4")
                per = [len(x) for x in some.column("sizes").to_pylist()]
                sizes = some.column("sizes").flatten().to_numpy()
                ends = np.cumsum(sizes)
                raw = memoryview(ids.tobytes())
                pieces = [raw[4 * (e - s):4 * e] for s, e in zip(sizes, ends)]
                out = pa.array([zlib.crc32(x) for x in pieces], pa.int64()) if digest else \
                    pa.array([bytes(x) for x in pieces], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(some.column("seg").to_numpy(), per)),
                     some.column("doc_ids").flatten(), some.column("starts").flatten(),
                     pa.array(np.repeat(some.column("block").to_numpy(), per)),
                     pa.array(sizes.astype(np.int64)), out],
                    ["seg", "doc_id", "start", "part", "n", "crc" if digest else "ids"])

    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return blocks.mapInArrow(rows, f"seg int, doc_id {kind}, start long, part int, n long, "
                                   + ("crc long" if digest else "ids binary"))
