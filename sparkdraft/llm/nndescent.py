"""Near-duplicate vectors by NN-descent, in double precision, within equal labels.

Method. Equal vectors of a label are one node. A forest of random hyperplane codes, each sorted
and compared in overlapping windows, gives every node its first neighbours. Code length and
number of trees grow with the label, so that all but a share ``miss`` of pairs at the threshold
agree in the code of some tree; a label of one window is compared whole. Each round gathers the
neighbours of a node, both ways, in bounded groups, and compares them with each other. Links
found by the forest or a round are never dropped: they join components at once. Lists keep
the ``k`` nearest inside and the ``k`` nearest outside of a node's component, so links cannot
crowd out what would join another component. Rounds go on until one joins nothing.

An audit then compares a random sample of queries with all rows of their labels. Labels of one
code length are judged together, once enough queries with links have been seen; until then
the sample grows. If too many links are missing it grows to the whole label, which makes the
comparison exact. Links that the audit finds count as well. The components are then compared
completely, in pairs of blocks, so that lists need not hold their links.

Defined cases. Vectors that are null, empty, zero or hold a null or non-finite component,
and rows with a null label or id, link with nothing. Vectors of different length are never
compared. A repeated row counts as another vector.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkdraft.llm.common import broadcast_value, stored
from sparkdraft.llm.graph import components
from sparkdraft.operators.joins import size_checked


@dataclass(frozen=True)
class Parameters:
    """``audited`` is the number of the first audit's queries, ``held`` of the most at once;
    a verdict needs ``linked`` queries with links, or all."""

    threshold: float = 0.93
    neighbours: int = 8
    block: int = 96
    miss: float = 1e-3
    audited: int = 1024
    held: int = 16384
    linked: int = 256
    recall: float = 0.999
    seed: int = 11


def trees(bits: int, p: Parameters) -> int:
    """How many codes of ``bits`` hyperplanes a pair at the threshold needs to agree in one."""
    agree = (1 - math.acos(p.threshold) / math.pi) ** bits
    return 1 if bits == 0 else math.ceil(math.log(p.miss) / math.log(1 - agree))


def _coded(nodes: DataFrame, p: Parameters) -> DataFrame:
    """``nodes`` with the code length ``bits`` of their label; 0 if it fits a window."""
    n = stored(nodes.groupBy("g").agg(F.count("*").alias("n")), "labels")
    length = F.when(F.col("n") <= p.block, 0).otherwise(F.ceil(F.log2(F.col("n") * 4 / p.block)))
    return stored(nodes.join(size_checked(n), "g").select(
        *nodes.columns, length.cast("int").alias("bits")), "nodes")


def _valid(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return v.isNotNull() & F.coalesce(~bad, F.lit(False)) & F.coalesce(some, F.lit(False))


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)
    top = np.abs(flat).max(1, keepdims=True)
    flat = flat / top
    return flat / np.sqrt((flat * flat).sum(1, keepdims=True))


def _runs(batches, keys: tuple[str, ...], most: int):
    """Consecutive rows of equal ``keys``, at most ``most`` at once, across batches."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        same = np.ones(len(held), bool)
        for k in keys:
            _, code = np.unique(held.column(k).to_numpy(zero_copy_only=False), return_inverse=True)
            same[1:] &= code[1:] == code[:-1]
        cuts = np.flatnonzero(~same[1:]) + 1
        cuts = np.concatenate([[0], cuts, [len(held)]])
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            for c in range(a, b, most):
                yield held.slice(c, min(most, b - c))
        held = held.slice(cuts[-2])
        while len(held) > most:
            yield held.slice(0, most)
            held = held.slice(most)
    if held is not None and len(held):
        yield held


def _spanning(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges (i, j) that connect what the links ``hit`` of a block connect, and its components."""
    group = np.arange(len(hit))
    i, j = [], []
    left = hit.any(1)
    while left.any():
        edge = np.array([left.argmax()])
        root = edge[0]
        left[root] = False
        while len(edge):
            new = np.flatnonzero(hit[edge].any(0) & left)
            i.append(edge[hit[np.ix_(edge, new)].argmax(0)])
            j.append(new)
            left[new] = False
            group[new] = root
            edge = new
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *i]), np.concatenate([none, *j]), group


def _edges(ids: np.ndarray, sims: np.ndarray, take: int, threshold: float,
           roots: np.ndarray | None = None) -> pa.RecordBatch:
    """Edges (a, b, sim) of a block: all its links and the nearest others of each member.

    Of the links only as many are given as connect the same members. The ``take`` nearest are
    those of all members, and those that no link found so far connects with the member.
    """
    np.fill_diagonal(sims, -2)
    hit = sims >= threshold
    i, j, group = _spanning(hit | hit.T)
    a, b = [i, j], [j, i]
    same = group[:, None] == group
    if roots is not None:
        same |= roots[:, None] == roots
    take = min(take, len(ids) - 1)
    for s in (sims, np.where(same, -2.0, sims)) if same.sum() > len(ids) else (sims,):
        best = np.argpartition(-s, take - 1, axis=1)[:, :take]
        x, y = np.repeat(np.arange(len(ids)), take), best.ravel()
        some = s[x, y] > -2
        a.append(x[some])
        b.append(y[some])
    a, b = np.concatenate(a), np.concatenate(b)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[a]), pa.array(ids[b]), pa.array(np.maximum(sims[a, b], sims[b, a]))],
        ["a", "b", "sim"])


def _rooted(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """``edges`` with the component of each end, ``ra`` and ``rb``."""
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    return edges.join(a, "a", "left").join(b, "b", "left").withColumns(
        {"ra": F.coalesce("ra", "a"), "rb": F.coalesce("rb", "b")})


def _joining(links: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) of components that ``links`` connect."""
    both = _rooted(links.select("a", "b"), roots).where("ra <> rb")
    return stored(both.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                  .distinct(), "joining")


def _merged(roots: DataFrame, pairs: DataFrame) -> DataFrame:
    """``roots`` after the components of ``pairs`` have become one each."""
    top = components(pairs).select(F.col("node").alias("root"), F.col("root").alias("top"))
    ends = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct()
    every = roots.unionByName(ends.select(F.col("a").alias("node"), F.col("a").alias("root")))
    return stored(every.distinct().join(top, "root", "left").select(
        "node", F.coalesce("top", "root").alias("root")), "roots")


def _best(edges: DataFrame, roots: DataFrame, k: int) -> DataFrame:
    """(a, b, sim): the nearest ``k`` of each node inside and ``k`` outside of its component."""
    each = edges.where("a <> b").groupBy("a", "b").agg(F.max("sim").alias("sim"))
    each = _rooted(each, roots).withColumn("inside", F.col("ra") == F.col("rb"))
    rank = Window.partitionBy("a", "inside").orderBy(F.col("sim").desc(), "b")
    ranked = each.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    return ranked.select("a", "b", "sim")


def _forest(nodes: DataFrame, p: Parameters) -> DataFrame:
    """First edges: windows of nodes with like hyperplane codes, for every tree."""
    def coded(batches):
        planes = {}
        for batch in batches:
            for g in _runs([batch], ("g",), 1 << 30):
                x, bits = _unit(g.column("v").combine_chunks()), g.column("bits")[0].as_py()
                for tree in range(trees(bits, p)):
                    key = (p.seed, tree, x.shape[1], bits)
                    if bits and key not in planes:
                        planes[key] = np.random.default_rng(key).normal(
                            size=(x.shape[1], bits + 1))
                    y = x @ planes[key] if bits else np.zeros((len(x), 1))
                    code = (y[:, :-1] > 0) @ (1 << np.arange(bits))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), tree, np.int32)), g.column("g").combine_chunks(),
                         pa.array(code.astype(np.int64)), pa.array(y[:, -1]),
                         g.column("id").combine_chunks(), g.column("v").combine_chunks()],
                        ["tree", "g", "code", "place", "id", "v"])

    kind = nodes.schema["v"].dataType.simpleString()
    rows = nodes.select("g", "id", "v", "bits").sortWithinPartitions("g").mapInArrow(
        coded, f"tree int, g long, code long, place double, id long, v {kind}")

    def windows(batches):
        last = None
        for run in _runs(batches, ("tree", "g"), p.block // 2):
            near = last is not None and all(last.column(c)[0] == run.column(c)[0]
                                            for c in ("tree", "g"))
            both = pa.concat_tables([last, run]) if near else run
            last = run
            if len(both) > 1:
                x = _unit(both.column("v").combine_chunks())
                yield _edges(both.column("id").to_numpy(), x @ x.T, p.neighbours // 2,
                             p.threshold)

    # Labels of one window have one place and stay together.
    order = ["tree", "g", "code", "place"]
    parts = max(2, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "id")
    return rows.mapInArrow(windows, "a long, b long, sim double")


def _round(lists: DataFrame, nodes: DataFrame, roots: DataFrame, turn: int, p: Parameters
           ) -> DataFrame:
    """Edges between neighbours of the same node; they go in groups, others in each ``turn``."""
    both = lists.select(F.col("a").alias("u"), F.col("b").alias("id")).unionByName(
        lists.select(F.col("b").alias("u"), F.col("a").alias("id"))).distinct()
    own = lists.select(F.col("a").alias("u"), F.col("a").alias("id")).distinct()
    degree = both.groupBy("u").agg(F.ceil(F.count("*") / (p.block // 2)).alias("groups"))
    dealt = both.join(degree, "u").select(
        "u", F.pmod(F.xxhash64("u", "id", F.lit(turn)), "groups").alias("part"), "id")
    centre = degree.join(own, "u").select(
        "u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("part"), "id")
    members = dealt.unionByName(centre).join(nodes.select("id", "v"), "id")
    members = members.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "root", F.coalesce("root", "id"))

    def met(batches):
        for run in _runs(batches, ("u", "part"), p.block):
            if len(run) > 1:
                x = _unit(run.column("v").combine_chunks())
                yield _edges(run.column("id").to_numpy(), x @ x.T, p.neighbours // 2,
                             p.threshold, run.column("root").to_numpy())

    spread = members.repartition("u", "part").sortWithinPartitions("u", "part", "id")
    return spread.select("u", "part", "id", "v", "root").mapInArrow(met, "a long, b long, sim double")


def _sample_links(nodes: DataFrame, roots: DataFrame, chosen: Column, threshold: float
                  ) -> DataFrame:
    """(bits, a, b) by brute force over all rows of the labels of the ``chosen`` nodes a.

    ``b`` is of another component than ``a``, one of each that rows at hand hold, or is ``a``
    itself where links stay inside. Nodes without links do not appear.
    """
    known = nodes.join(roots, nodes["id"] == roots["node"], "left").select(
        "g", "id", "v", "bits", F.coalesce("root", "id").alias("root"))
    known = stored(known, "known")
    some = known.where(chosen).orderBy("g").toArrow()
    held = broadcast_value(nodes.sparkSession, some)

    def found(batches):
        queries = held.value
        label = queries.column("g").to_numpy()
        for batch in batches:
            for run in _runs([batch], ("g",), 4096):
                lo, hi = (np.searchsorted(label, run.column("g")[0].as_py(), s)
                          for s in ("left", "right"))
                y = _unit(run.column("v").combine_chunks()) if lo < hi else None
                ids, root = run.column("id").to_numpy(), run.column("root").to_numpy()
                for at in range(lo, hi, 1024):
                    mine = queries.slice(at, min(1024, hi - at)).combine_chunks()
                    own, base = mine.column("id").to_numpy(), mine.column("root").to_numpy()
                    hit = _unit(mine.column("v").combine_chunks()) @ y.T >= threshold
                    hit &= own[:, None] != ids
                    i, j = np.nonzero(hit)
                    other = base[i] != root[j]
                    inside = np.unique(i[~other])
                    i, j = i[other], j[other]
                    _, code = np.unique(root[j], return_inverse=True)
                    _, once = np.unique(i * (len(ids) + 1) + code, return_index=True)
                    i, j = i[once], j[once]
                    bits = mine.column("bits").to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([bits[inside], bits[i]])),
                         pa.array(np.concatenate([own[inside], own[i]])),
                         pa.array(np.concatenate([own[inside], ids[j]]))], ["bits", "a", "b"])

    rows = known.select("g", "id", "v", "root").sortWithinPartitions("g")
    return stored(rows.mapInArrow(found, "bits int, a long, b long"), "audit")


def _audited(nodes: DataFrame, roots: DataFrame, p: Parameters) -> tuple[DataFrame, dict]:
    """The components after the audit, and (queries with links, those with lost ones, share of
    nodes that were queries) by code length."""
    count = nodes.where("bits > 0").groupBy("bits").count().collect()
    sizes = {r["bits"]: r["count"] for r in count}
    seen, open_, step = {k: (0, 0, 0.0) for k in sizes}, set(sizes), p.audited
    place = F.pmod(F.xxhash64("id", F.lit(p.seed)), F.lit(1 << 40)) / float(1 << 40)
    while open_:
        chosen = F.lit(False)
        for k in open_:
            low = seen[k][2]
            high = min(1.0, low + step / len(open_) / sizes[k])
            chosen |= (F.col("bits") == k) & (place >= low) & (place < high)
            seen[k] = (*seen[k][:2], high)
        links = _sample_links(nodes.where(F.col("bits").isin(*open_)), roots, chosen, p.threshold)
        each = links.groupBy("bits", "a").agg(F.max(F.col("a") != F.col("b")).alias("lost"))
        each = each.groupBy("bits").agg(F.count("*").alias("n"), F.count_if("lost").alias("lost"))
        for r in each.collect():
            n, lost, share = seen[r.bits]
            seen[r.bits] = (n + r.n, lost + r.lost, share)
        pairs = _joining(links, roots)
        if not pairs.isEmpty():
            roots = _merged(roots, pairs)
        open_ = {k for k in open_ if seen[k][2] < 1 and not (
            seen[k][0] >= p.linked and seen[k][1] <= (1 - p.recall) * seen[k][0])}
        step = min(step * 4, p.held)
    return roots, seen


def descend(nodes: DataFrame, p: Parameters = Parameters()) -> tuple[DataFrame, int]:
    """The components (node, root) of ``nodes`` (g, id, v, bits), and rounds."""
    edges = stored(_forest(nodes, p), "found")
    near = F.col("sim") >= p.threshold
    roots = stored(components(edges.where(near)), "roots")
    lists, done = stored(_best(edges, roots, p.neighbours), "lists"), 0
    while True:
        done += 1
        edges = stored(_round(lists, nodes, roots, done, p), "found")
        pairs = _joining(edges.where(near), roots)
        if pairs.isEmpty():
            return roots, done
        roots = _merged(roots, pairs)
        lists = stored(_best(lists.unionByName(edges), roots, p.neighbours), "lists")


def _complete(nodes: DataFrame, roots: DataFrame, p: Parameters) -> DataFrame:
    """(id, n_links): all links inside each component, by pairs of blocks."""
    size = p.block * 2
    inside = nodes.join(roots, nodes["id"] == roots["node"])
    count = inside.groupBy("root").agg(F.ceil(F.count("*") / size).alias("blocks"))
    rows = inside.join(count, "root").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = rows.select("root", "block", "id", "v", "times", other.alias("other"))
    pairs = pairs.select("root", F.least("block", "other").alias("i"),
                         F.greatest("block", "other").alias("j"), "block", "id", "v", "times")

    def counted(batches):
        for run in _runs(batches, ("root", "i", "j"), 1 << 30):
            x = _unit(run.column("v").combine_chunks())
            ids = run.column("id").to_numpy()
            times = run.column("times").to_numpy()
            left = run.column("block").to_numpy() == run.column("i").to_numpy()[0]
            right = ~left if (~left).any() or run.column("i")[0] != run.column("j")[0] else left
            hit = x[left] @ x[right].T >= p.threshold
            if right is left:
                np.fill_diagonal(hit, False)
                n = hit @ times
                out = [(ids, n)]
            else:
                out = [(ids[left], hit @ times[right]), (ids[right], hit.T @ times[left])]
            for who, n in out:
                yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(n.astype(np.int64))],
                                                 ["id", "n"])

    spread = pairs.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "id")
    found = spread.mapInArrow(counted, "id long, n long")
    return found.groupBy("id").agg(F.sum("n").alias("n"))


def near_duplicates(vectors: DataFrame, p: Parameters = Parameters()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of (vec_id, embedding, label)."""
    usable = _valid(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select("vec_id", "embedding", "label", F.when(
        usable, F.xxhash64(F.col("label").cast("string"), "embedding")).alias("fp"))
    nodes = rows.where("fp is not null").groupBy("fp").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("times"),
        F.first("embedding").alias("v"), F.first(F.xxhash64(
            F.col("label").cast("string"), F.size("embedding"))).alias("g"))
    nodes = stored(nodes.select("g", F.col("fp").alias("id"), "v", "times", "least"), "nodes")
    nodes = _coded(nodes, p)
    roots, _ = _audited(nodes, descend(nodes, p)[0], p)
    n_links = _complete(nodes, roots, p).withColumnRenamed("id", "fp")
    least = nodes.join(roots, nodes["id"] == roots["node"], "left").select(
        F.col("id").alias("fp"), F.coalesce("root", "id").alias("root"), "least", "times")
    least = least.join(least.groupBy("root").agg(F.min("least").alias("component")), "root")
    known = stored(least.join(n_links, "fp", "left").select(
        "fp", "component", (F.col("times") - 1 + F.coalesce("n", F.lit(0))).alias("n")), "known")
    return rows.join(known, "fp", "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id") == F.col("component_id"))
