"""N-gram Jaccard self-join: documents whose shingle sets overlap by 4/5 or more.

Method, on sets of distinct five-word shingles ("tokens", as 64-bit hashes):

1. *Classes.* One pass counts all tokens in a sketch of ``2**SKETCH_BITS`` cells; tokens of
   cells far above the mean are *frequent*, the others *rare*. The class decides which
   signatures are indexed, never which links are found.
2. *Prefixes.* A document's tokens are ordered rare first, then by hash. If it has more rare
   tokens than a partner may lack, that many rare tokens, singly, are its signatures.
   Otherwise the prefix is extended: all its rare tokens singly, and for its frequent
   tokens the 2-token combinations of neighbours in that order (see ``_extended``).
3. *Contraction.* Documents of one set are one node. The first signatures of each node link
   it to the smallest node that shares them, then the nodes of crowded signatures to hubs,
   which share the most; verified links join nodes into groups, so copies are not compared
   with each other again. This decides what is compared first, never which links count.
4. *Candidates and verification.* Signatures are joined between different groups; pairs that
   share too few rare signatures to reach 4/5 go, the others are compared by their whole
   sets. Components of all verified links give the result.
5. *Crowded signatures.* The nodes of a signature are not joined with each other where that
   leaves many pairs to verify: many texts that are alike in part and yet not linked would make
   all pairs. They are indexed anew by how they differ from the signature's hub (see
   ``_crowded`` and ``_differences``).

Defined cases. A text that is null or has no word has an empty set and no links. A text of
fewer than five words has its whole sequence as the only shingle. Rows with a null id are
returned with a null component. Repeated rows are linked by their id and each returned; rows
of one id but different texts are linked as well, since they are one document.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkdraft.llm import textvec
from sparkdraft.llm.common import broadcast_value, stored, unused
from sparkdraft.llm.graph import components
from sparkdraft.session import work_dir
from sparkdraft.sources import files

#: Bytes of an Arrow batch of texts or sets: some are held at a time, by Spark and by Python.
BATCH = 4 << 20
SHINGLE = 5
SKETCH_BITS, BLOCK_BITS = 22, 15
#: Signatures of each kind that the contraction uses.
FIRST = 4
#: Nodes of a signature from which its hub is tried, and from which it may be indexed anew.
CROWD, CROWDED = 8, 48
#: Wanted ids that are broadcast; of more, the bits of a filter, for each id and at most.
FEW_IDS = 200_000
ID_BITS, MOST_BITS = 16, 1 << 27


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens * textvec.GOLDEN) >> np.uint64(64 - SKETCH_BITS)


def _token_sets(column: pa.Array):
    """(row, sorted distinct tokens) of each document."""
    for row, end, buf, offs in textvec.chunks(column):
        words, counts = textvec.word_hashes(buf, offs)
        tokens, n = textvec.shingles(words, counts, SHINGLE)
        bounds = np.concatenate([[0], np.cumsum(n)])
        for i in range(end - row):
            t = np.sort(tokens[bounds[i]:bounds[i + 1]])
            if len(t) > 1:
                t = t[np.concatenate([[True], t[1:] != t[:-1]])]
            yield row + i, t


def _sketch_rows(batches):
    total = np.zeros(1 << SKETCH_BITS, np.uint32)
    for batch in batches:
        for _, _, buf, offs in textvec.chunks(batch.column(0)):
            words, counts = textvec.word_hashes(buf, offs)
            tokens, _ = textvec.shingles(words, counts, SHINGLE)
            np.add.at(total, _cells(tokens), np.uint32(1))
    blocks = total.reshape(-1, 1 << BLOCK_BITS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(blocks), dtype=np.int32)),
         pa.array([zlib.compress(b.tobytes(), 1) for b in blocks], pa.binary())],
        ["block", "counts"])


def _add_blocks(batches):
    """Sums of the blocks of one partition; at most all blocks are held."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = np.frombuffer(zlib.decompress(packed), np.uint32)
            sums[block] = sums[block] + counts if block in sums else counts
    for block, counts in sums.items():
        mean = counts.mean()
        bits = np.packbits(counts > mean + 6 * np.sqrt(mean) + 20)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int32()), pa.array([bits.tobytes()], pa.binary())],
            ["block", "bits"])


def frequent_cells(docs: DataFrame) -> np.ndarray:
    """One bit per sketch cell, packed: whether its tokens are of the frequent class."""
    parts = docs.select("text").mapInArrow(_sketch_rows, "block int, counts binary")
    n_blocks = 1 << (SKETCH_BITS - BLOCK_BITS)
    rows = parts.repartition(n_blocks, "block").mapInArrow(_add_blocks, "block int, bits binary")
    bits = np.zeros((n_blocks, (1 << BLOCK_BITS) // 8), np.uint8)
    for r in rows.collect():
        bits[r.block] = np.frombuffer(r.bits, np.uint8)
    return bits.ravel()


def _extended(n: int, rare: int) -> int:
    """Frequent tokens of the prefix of a set of ``n`` with ``rare`` rare tokens, all missed.

    Let d be the tokens of x that y lacks. At 4/5 the tokens of y that x lacks are at most
    n/4 - 5d/4. A lacking frequent token breaks two neighbour pairs of x, one of y's own
    breaks one. If no rare token is shared, at most d - rare frequent ones lack, and
    2 (d - rare) + n/4 - 5d/4 is largest at d = n/5: 2n/5 - 2 rare. One pair more survives.
    """
    return max(0, (2 * n - 10 * rare) // 5) + 2


def signatures(t: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Single tokens, token pairs, and whether the single ones are enough, of a set."""
    n = len(t)
    need = n - (4 * n + 4) // 5 + 1
    cell = _cells(t)
    often = (frequent[cell >> np.uint64(3)] >> (7 - (cell & np.uint64(7))).astype(np.uint8)) & 1
    rare = t[often == 0]
    if len(rare) >= need:
        return rare[:need], t[:0], True
    rest = t[often == 1][:_extended(n, len(rare))]
    return rare, textvec.mix64(rest[:-1] + textvec.mix64(rest[1:])), False


def _fingerprint(t: np.ndarray) -> int:
    h = textvec.mix64(t ^ textvec.GOLDEN).sum(dtype=np.uint64)
    return int(textvec.mix64(np.array([h + len(t)], np.uint64)).view(np.int64)[0])


def _index(docs: DataFrame, held) -> DataFrame:
    """(doc_id, n, fp, singles, pairs, plain); signatures once for each set and partition."""
    def rows(batches):
        frequent, seen = held.value, set()
        for batch in batches:
            n, fps, plain, one, two = [], [], [], [], []
            known = batch.column("doc_id").is_valid().to_pylist()
            for row, t in _token_sets(batch.column("text")):
                fp = _fingerprint(t)
                a = b = t[:0]
                flag = True
                # Rows of a null id have no links, so they must not stand for their set.
                if len(t) >= 4 and known[row] and (fp, len(t)) not in seen:
                    seen.add((fp, len(t)))
                    a, b, flag = signatures(t, frequent)
                n.append(len(t))
                fps.append(fp)
                plain.append(flag)
                one.append(a)
                two.append(b)
            lists = [textvec.list_array(pa.array(np.concatenate([t[:0], *x]).view(np.int64)),
                                        np.array([len(y) for y in x], np.int64))
                     if x else pa.array([], pa.list_(pa.int64())) for x in (one, two)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(fps, pa.int64()),
                 *lists, pa.array(plain, pa.bool_())],
                ["doc_id", "n", "fp", "singles", "pairs", "plain"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        rows, f"doc_id {kind}, n long, fp long, singles array<long>, pairs array<long>, plain boolean")


def _among(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """``docs`` without most of those whose id is not one of ``n`` wanted; none of the others goes.

    One bit for each hash of a wanted id: texts that the join would drop are not shuffled.
    """
    bits = min(MOST_BITS, 1 << max(15, (ID_BITS * n).bit_length()))

    def at(kind: str):
        return F.expr(f"bitmap_{kind}(pmod(xxhash64(doc_id), {bits}))")

    maps = wanted.groupBy(at("bucket_number").alias("llm_bucket")).agg(
        F.bitmap_construct_agg(at("bit_position")).alias("llm_bits"))
    byte = F.conv(F.hex(F.substring("llm_bits", F.floor(F.col("llm_at") / 8).cast("int") + 1, 1)), 16, 10)
    rows = docs.withColumns({"llm_bucket": at("bucket_number"), "llm_at": at("bit_position")})
    rows = rows.join(F.broadcast(maps), "llm_bucket").where(
        byte.cast("int").bitwiseAND(F.expr("shiftleft(1, cast(llm_at % 8 as int))")) != 0)
    return rows.select(docs.columns)


def _sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, folder: str) -> DataFrame:
    """(fp, tokens): the whole sets of nodes ``fp``, as binary, written to ``folder``."""
    wanted = stored(nodes.select("fp", "doc_id").join(wanted.distinct(), "fp"), "wanted", folder)

    def set_rows(batches):
        for batch in batches:
            sets = [t.tobytes() for _, t in _token_sets(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array(sets, pa.binary())],
                                             ["fp", "tokens"])

    # A repeated row is the same document; its texts of other sets are dropped by the set's id.
    docs, n = docs.select("doc_id", "text"), wanted.count()
    if n <= FEW_IDS:
        texts = docs.join(F.broadcast(wanted), "doc_id").select("fp", "text")
    else:
        texts = _among(docs, wanted, n).join(wanted, "doc_id").select("fp", "text")
    return stored(texts.mapInArrow(set_rows, "fp long, tokens binary"), "sets", folder, BATCH)


def _tokens(cell: pa.Scalar) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), np.uint64)


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of node ids whose whole sets overlap by 4/5 or more."""
    folder = work_dir(docs.sparkSession, "verify")
    pairs = stored(pairs.select("a", "b").distinct(), "pairs", folder)
    sets = _sets(pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))),
                 nodes, docs, folder)

    def compare(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                s, t = _tokens(x), _tokens(y)
                if len(t) < len(s):
                    s, t = t, s
                at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                both = int((t[at] == s).sum())
                keep.append(100 * both >= 80 * (len(s) + len(t) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask),
                                              batch.column("b").filter(mask)], ["a", "b"])

    left = sets.select(F.col("fp").alias("b"), F.col("tokens").alias("y"))
    right = sets.select(F.col("fp").alias("a"), F.col("tokens").alias("x"))
    rows = pairs.join(left, "b").join(right, "a")
    links = stored(rows.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")
                   .distinct(), "links", None, BATCH)
    files.remove(docs.sparkSession, folder)
    return links


def _stars(index: DataFrame) -> DataFrame:
    """Pairs of a node and the smallest node that shares one of its first signatures."""
    first = F.concat(F.slice("singles", 1, FIRST), F.slice("pairs", 1, FIRST))
    rows = index.select("fp", F.explode(first).alias("sig"))
    least = rows.groupBy("sig").agg(F.min("fp").alias("a"), F.max("fp").alias("top"))
    least = least.where("a <> top").select("sig", "a")
    return rows.join(least, "sig").where("a <> fp").select("a", F.col("fp").alias("b"))


def _grouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the group ``g`` of their node ``fp``."""
    return rows.join(groups.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn(
        "g", F.coalesce("root", "fp")).drop("root")


def _met(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """(sig, g, fp, n, plain): the signatures that nodes of different groups share."""
    alike = Window.partitionBy("sig")
    rows = rows.select("sig", "g", "fp", "n", "plain",
                       F.min("g").over(alike).alias("lo"), F.max("g").over(alike).alias("hi"))
    return stored(rows.where("lo <> hi").drop("lo", "hi").distinct(), "shared", folder)


def _hubs(met: DataFrame) -> DataFrame:
    """Pairs of a node and the hub of one of its crowded signatures, if of another group.

    A hub is the node of a signature that shares the most: near copies differ more from each
    other than from the text that they were made of, which holds most of their signatures.
    """
    crowded = met.groupBy("sig").agg(F.count("*").alias("c")).where(F.col("c") >= CROWD)
    rows = met.join(crowded, "sig")
    rows = rows.join(rows.groupBy("fp").agg(F.sum("c").alias("w")), "fp")
    hub = rows.groupBy("sig").agg(F.max(F.struct("w", "fp", "g", "n")).alias("hub"))
    pairs = rows.join(hub, "sig").where(
        "g <> hub.g and 5 * n >= 4 * hub.n and 5 * hub.n >= 4 * n")
    return pairs.select(F.col("hub.fp").alias("a"), F.col("fp").alias("b"))


def _crowded(met: DataFrame) -> DataFrame:
    """(sig, hub): the signatures of many nodes, with the node that shares the most.

    Two nodes whose signatures are all single are verified only if they share many of them. So a
    signature is crowded if the other pairs of its nodes are many for each node, or if all
    its pairs outnumber the tokens that ``_differences`` takes of its nodes.
    """
    counts = met.groupBy("sig").agg(F.count("*").alias("c"), F.sum("n").alias("tokens"),
                                    F.count(F.when(~F.col("plain"), 1)).alias("o"))
    counts = counts.where((F.col("c") >= CROWDED) & (
        (F.col("o") * (2 * F.col("c") - F.col("o") - 1) >= (CROWDED - 1) * F.col("c"))
        | (4 * F.col("c") * (F.col("c") - 1) > 3 * F.col("tokens")))).select("sig", "c")
    rows = met.join(counts, "sig")
    rows = rows.join(rows.groupBy("fp").agg(F.sum("c").alias("w")), "fp")
    return rows.groupBy("sig").agg(F.max(F.struct("w", "fp")).alias("hub")).select(
        "sig", F.col("hub.fp").alias("hub"))


def _differences(met: DataFrame, crowded: DataFrame, nodes: DataFrame, docs: DataFrame,
                 folder: str) -> DataFrame:
    """Pairs of nodes of crowded signatures that may reach 4/5, by their differences from the hub.

    Let D(x) be the tokens in which x and the hub differ: x and y differ in as many tokens as
    D(x) and D(y) do, which at 4/5 are at most t = (|x| + |y|) / 9. So of D(x) at most
    (|D(x)| - |D(y)| + t) / 2 tokens are not in D(y). Of the two the one of the smaller D may
    thus lack at most t/2, the other, whose D is larger by at most t, no more than t: among the
    first tokens of both, in one order, one more than they may lack, is a common one. The partner
    has at most 5/4 of a node's tokens and no more than the largest node, its D no fewer
    than the smallest D of the hub's nodes. What stands before the first common token, at i of
    D(x) and j of D(y), is not common, and the rests differ by their lengths at least: a pair
    is taken only if i + j + ||D(x)| - i - |D(y)| + j| is at most t.
    The order puts tokens last that an eighth of the differences from this hub hold or more, and
    before these the tokens that the hub has. If the differences
    need not meet at all, |D(x)| + |D(y)| <= t, both reach 4/5 with the hub, whose pairs with
    all nodes are candidates too, and so are of one component. ``folder`` must stay until the
    pairs are read.
    """
    near = stored(met.join(crowded, "sig").select("hub", "fp", "g", "n").distinct(), "near", folder)
    texts = work_dir(docs.sparkSession, "near-sets")
    sets = _sets(near.select("fp").unionByName(near.select(F.col("hub").alias("fp"))), nodes, docs, texts)
    both = near.join(sets, "fp").join(
        sets.select(F.col("fp").alias("hub"), F.col("tokens").alias("center")), "hub")

    def differ(batches):
        for batch in batches:
            found = []
            for x, h in zip(batch.column("tokens"), batch.column("center")):
                t, c = _tokens(x), _tokens(h)
                found.append(np.concatenate([np.setdiff1d(t, c, assume_unique=True),
                                             np.setdiff1d(c, t, assume_unique=True)]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("hub", "fp", "g", "n")],
                 pa.array([len(d) for d in found], pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                ["hub", "fp", "g", "n", "d", "tokens"])

    index = stored(both.select("hub", "fp", "g", "n", "tokens", "center").mapInArrow(
        differ, "hub long, fp long, g long, n long, d long, tokens array<long>"), "differences", folder, BATCH)
    files.remove(docs.sparkSession, texts)
    # At most eight times the mean difference's tokens are in an eighth of a hub's differences.
    counts = index.select("hub", F.explode("tokens").alias("token")).groupBy("hub", "token").agg(
        F.count("*").alias("c"))
    sizes = stored(index.groupBy("hub").agg(F.count("*").alias("nodes"), F.max("n").alias("widest"),
                                            F.min("d").alias("least")), "sizes", folder)
    often = counts.join(sizes, "hub").where("8 * c >= nodes").groupBy("hub").agg(
        F.collect_list("token").alias("often"))
    order = F.when(F.col("often").isNull(), F.col("tokens")).otherwise(F.concat(
        F.array_except("tokens", "often"), F.array_intersect("tokens", "often")))
    t = (F.col("n") + F.least("widest", F.col("n") * 5 / 4)) / 9
    lacking = {"a": t / 2, "b": F.least(t, (F.col("d") - F.col("least") + t) / 2)}

    def role(side: str) -> DataFrame:
        tokens = F.slice(order, F.lit(1), (F.floor(lacking[side] + 1e-6) + 1).cast("int"))
        return index.join(often, "hub", "left").join(sizes, "hub").select(
            "hub", F.posexplode(tokens).alias("at" + side, "token"),
            *[F.col(c).alias(c + side) for c in ("fp", "g", "n", "d")])

    pairs = role("a").join(role("b"), ["hub", "token"]).where(
        "ga <> gb and da <= db and 5 * na >= 4 * nb and 5 * nb >= 4 * na "
        "and 9 * (ata + atb + abs(da - ata - db + atb)) <= na + nb")
    pairs = pairs.select("fpa", "fpb").unionByName(
        near.where("hub <> fp").select(F.col("hub").alias("fpa"), F.col("fp").alias("fpb")))
    return pairs.select(F.least("fpa", "fpb").alias("a"), F.greatest("fpa", "fpb").alias("b"))


def _candidates(hot: DataFrame) -> DataFrame:
    """Pairs of nodes of different groups that the signatures cannot rule out."""
    a, b = (hot.select("sig", *[F.col(c).alias(c + s) for c in ("g", "fp", "n", "plain")])
            for s in ("a", "b"))
    met = a.join(b, "sig").where("ga < gb and 5 * na >= 4 * nb and 5 * nb >= 4 * na")
    each = met.groupBy("fpa", "fpb").agg(
        F.count("*").alias("c"), F.first("na").alias("na"), F.first("nb").alias("nb"),
        F.first(F.col("plaina") & F.col("plainb")).alias("plain"))
    # Both prefixes of single tokens: of the shorter-reaching one, all tokens but those that
    # the partner may lack must be shared.
    overlap = F.floor((4 * (F.col("na") + F.col("nb")) + 8) / 9)

    def least(n: str):
        return F.col(n) - F.floor((4 * F.col(n) + 4) / 5) + 1 - (F.col(n) - overlap)

    enough = F.col("c") >= F.least(least("na"), least("nb"))
    return each.where(~F.col("plain") | enough).select(F.col("fpa").alias("a"),
                                                       F.col("fpb").alias("b"))


def joined(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text)."""
    spark: SparkSession = docs.sparkSession
    held = broadcast_value(spark, frequent_cells(docs))
    folder = work_dir(spark, "index")
    every = stored(_index(docs, held), "index", folder, BATCH)
    rows = stored(every.select("doc_id", "n", "fp"), "rows")
    # A node is a set; the text of the smallest id stands for it.
    nodes = stored(rows.where("n >= 4 and doc_id is not null").groupBy("fp")
                   .agg(F.min("doc_id").alias("doc_id")), "nodes")
    index = every.where("size(singles) + size(pairs) > 0 and doc_id is not null").select(
        "fp", "n", "singles", "pairs", "plain")
    first = _verified(_stars(index), nodes, docs)
    groups = stored(components(first), "groups")
    met = _met(_grouped(index, groups).select(
        "fp", "n", "plain", "g", F.explode(F.concat("singles", "pairs")).alias("sig")),
        spent := work_dir(spark, "met"))
    files.remove(spark, folder)  # the signatures that meet are in ``met``
    first = first.unionByName(_verified(_hubs(met), nodes, docs))
    met = _met(_grouped(met.drop("g"), stored(components(first), "groups")))
    files.remove(spark, spent)
    crowded = stored(_crowded(met), "crowded")
    few = met.join(crowded, "sig", "left_anti")
    folder = work_dir(spark, "crowded")
    rest = _verified(_candidates(few).unionByName(_differences(met, crowded, nodes, docs, folder)),
                     nodes, docs)
    files.remove(spark, folder)
    # Ids and sets in one graph: a set and its ids are linked, so are linked sets.
    sets = stored(components(first.unionByName(rest)), "sets")
    ids = rows.where("n > 0 and doc_id is not null").select("doc_id", "fp")
    ids = ids.join(sets, ids["fp"] == sets["node"], "left").select(
        "doc_id", F.coalesce("root", "fp").alias("root"))
    least = ids.groupBy("root").agg(F.min("doc_id").alias("least"))
    by_id = ids.join(least, "root").select(F.col("doc_id").alias("a"), F.col("least").alias("b"))
    several = by_id.groupBy("a").agg(F.min("b").alias("root"), F.max("b").alias("other"))
    if several.where("root <> other").isEmpty():
        final = several.select(F.col("a").alias("llm_id"), "root")
    else:
        final = components(by_id).select(F.col("node").alias("llm_id"), "root")
    return rows.join(final, rows["doc_id"] == F.col("llm_id"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with the document of the smallest id of each component; its rows all stay."""
    out = joined(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("llm_id"))
    name = unused("llm_id", docs)
    return docs.join(out.distinct().toDF(name), docs["doc_id"] == F.col(name), "left_anti")
