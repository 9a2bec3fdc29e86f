"""Near-duplicate embeddings by a forest of random-projection trees.

Each tree halves the space again and again by a random direction and a threshold. Vectors near a
threshold go to both sides (spill), so that close pairs seldom part. Vectors that share a leaf of
any tree are compared, in double precision; links are united to components.

The trees are fitted on a bounded sample; every vector is routed through all of them. A threshold
is put where few sampled vectors are near it, and a node whose vectors are all close together is
not split, so a large group of near copies isn't doubled at each level. A leaf with many vectors is
compared in blocks, so no task holds it whole. Pairs are never written out: a pair is counted in
the first leaf that both its vectors have, and each block gives counts by vector and the edges of a
spanning forest. Equal vectors are one node with a weight, so copies don't multiply. Vectors are
compared with those of their own length: each length that the sample holds has trees of its own,
and all vectors of a rarer length share one leaf.

Defined cases: vectors that are null, zero, or hold null or non-finite components link with
nothing; vectors of different lengths don't link with each other; rows with a null id are counted
but never name a component; rows that repeat an id are vectors of their own; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetsight.llm.common import staged
from fleetsight.llm.components import components

SAMPLE = 20_000  # vectors that trees are fitted on: about so many, never more than twice
TREES = 10
LEAF = 1_000
BLOCK = 1_024
COSINE = 0.95
TRIES = 12
MAX_SPILL = 0.35  # a node is a leaf if every tried threshold has a larger share of its vectors near it


@dataclasses.dataclass
class Tree:
    directions: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray  # (nodes, 2); a leaf is -1 - its number
    leaves: int


def margin(dimension: int, cosine: float) -> float:
    """Half of what the projections of a pair at the least cosine typically differ by."""
    return 0.5 * float(np.sqrt((2 - 2 * cosine) / dimension))


def grow(units: np.ndarray, leaf: float, spill: float, rng: np.random.Generator) -> Tree:
    """A tree over sampled unit vectors; nodes of up to ``leaf`` vectors aren't split."""
    directions, thresholds, children = [], [], []
    leaves = 0
    waiting = [(np.arange(len(units)), None, 0, 0)]
    while waiting:
        at, parent, side, depth = waiting.pop()
        best = None
        if len(at) > leaf and depth < 40:
            tries = rng.normal(size=(TRIES, units.shape[1]))
            tries /= np.linalg.norm(tries, axis=1, keepdims=True)
            projected = units[at] @ tries.T
            for q in (0.5, 0.4, 0.6, 0.3, 0.7):
                cuts = np.quantile(projected, q, axis=0)
                near = (np.abs(projected - cuts) < spill).mean(axis=0)
                cost = near + 0.5 * abs(q - 0.5)
                i = int(cost.argmin())
                if best is None or cost[i] < best[0]:
                    best = (cost[i], near[i], tries[i], cuts[i], projected[:, i])
        if best is None or best[1] > MAX_SPILL:
            number = -1 - leaves
            leaves += 1
        else:
            number = len(directions)
            directions.append(best[2])
            thresholds.append(best[3])
            children.append([0, 0])
            waiting.append((at[best[4] < best[3] + spill], number, 0, depth + 1))
            waiting.append((at[best[4] > best[3] - spill], number, 1, depth + 1))
        if parent is not None:
            children[parent][side] = number
    d = units.shape[1]
    return Tree(np.array(directions).reshape(-1, d), np.array(thresholds), np.array(children, np.int64).reshape(-1, 2), leaves)


def route(tree: Tree, units: np.ndarray, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for every leaf that a row goes to."""
    rows, nodes = np.arange(len(units)), np.full(len(units), 0 if len(tree.thresholds) else -1)
    done_rows, done_leaves = [], []
    while len(rows):
        ended = nodes < 0
        done_rows.append(rows[ended])
        done_leaves.append(-1 - nodes[ended])
        rows, nodes = rows[~ended], nodes[~ended]
        if not len(rows):
            break
        gap = np.einsum("ij,ij->i", units[rows], tree.directions[nodes]) - tree.thresholds[nodes]
        left, right = gap < spill, gap > -spill
        rows, nodes = (
            np.concatenate([rows[left], rows[right]]),
            np.concatenate([tree.children[nodes[left], 0], tree.children[nodes[right], 1]]),
        )
    return np.concatenate(done_rows), np.concatenate(done_leaves)


def _rows(df: DataFrame, vector_col: str, id_col: str) -> DataFrame:
    """vec_id, node (null if the vector can't link), vector (doubles as bytes), dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, vectors, sizes = [], [], []
            for v in batch.column("v").to_pylist():
                x = np.array(v, np.float64) if v and None not in v else np.zeros(0)
                fit = len(x) > 0 and np.isfinite(x).all() and x.any()
                raw = (x + 0.0).tobytes() if fit else None  # -0.0 is 0.0
                nodes.append(int.from_bytes(hashlib.md5(raw).digest()[:8], "little", signed=True) if fit else None)
                vectors.append(raw)
                sizes.append(len(x) if fit else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(nodes, pa.int64()), pa.array(vectors, pa.binary()), pa.array(sizes, pa.int64())],
                ["vec_id", "node", "vector", "dimension"],
            )

    source = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return source.mapInArrow(run, "vec_id long, node long, vector binary, dimension long")


def _units(vectors) -> np.ndarray:
    x = np.frombuffer(b"".join(bytes(v) for v in vectors), np.float64).reshape(len(vectors), -1)
    largest = np.abs(x).max(axis=1, keepdims=True)  # first, so that squares neither overflow nor vanish
    x = x / largest
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _routed(nodes: DataFrame, forests: dict[int, list[Tree]], cosine: float) -> DataFrame:
    """A row for each vector: node, weight, vector (unit, as bytes), leaves (sorted).

    Leaves are numbered over all trees of a length, from length * 2^32 on; a length without trees
    has one leaf.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(forests)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("dimension").to_numpy()
            for length in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == length))
                units = _units(part.column("vector").to_pylist())
                trees, first = shared.value.get(length, []), length << 32
                found = [] if trees else [np.stack([np.arange(len(units)), np.full(len(units), first)])]
                for tree in trees:
                    row, leaf = route(tree, units, margin(length, cosine))
                    found.append(np.stack([row, leaf + first]))
                    first += tree.leaves
                row, leaf = np.concatenate(found, axis=1)
                order = np.lexsort((leaf, row))
                edges = np.searchsorted(row[order], np.arange(len(units) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("node"),
                        part.column("weight"),
                        pa.array([u.tobytes() for u in units], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array(leaf[order].astype(np.int64))),
                    ],
                    ["node", "weight", "vector", "leaves"],
                )

    source = nodes.select("node", "weight", "vector", "dimension")
    return source.mapInArrow(run, "node long, weight long, vector binary, leaves array<long>")


def grown_forests(nodes: DataFrame, cosine: float, trees: int, leaf: int, seed: int) -> dict[int, list[Tree]]:
    """Trees for each length of vectors in one sample of about SAMPLE of all nodes."""
    rate = min(1.0, SAMPLE / max(1, nodes.count()))
    # by a hash, so that nothing is ranked in one task
    share = F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(1 << 30)) < int(rate * (1 << 30))
    by_length: dict[int, list[bytes]] = {}
    for r in nodes.filter(share).select("dimension", "vector").limit(2 * SAMPLE).collect():
        by_length.setdefault(r.dimension, []).append(bytes(r.vector))
    forests = {}
    for length, vectors in by_length.items():
        units, rng = _units(sorted(vectors)), np.random.default_rng(seed)
        forests[length] = [grow(units, max(leaf * rate, 8), margin(length, cosine), rng) for _ in range(trees)]
    return forests


def _owned(leaves: np.ndarray, i: np.ndarray, j: np.ndarray, leaf: int) -> np.ndarray:
    """Which pairs (i, j) have no common leaf before ``leaf``; leaves: (rows, most) sorted, padded by -1."""
    keep = np.ones(len(i), bool)
    for a in range(leaves.shape[1]):
        at = np.flatnonzero(keep)
        mine = leaves[i[at], a]
        before = (mine >= 0) & (mine < leaf)
        at, mine = at[before], mine[before]
        if len(at):
            keep[at] = ~(leaves[j[at]] == mine[:, None]).any(axis=1)
    return keep


def _spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index in each one's component under links i-j."""
    label = np.arange(n)
    while True:
        old = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == old).all():
            return label


def _compare(cosine: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        leaf, lo, hi = (int(frame[c].iloc[0]) for c in ("leaf", "lo", "hi"))
        units = np.frombuffer(b"".join(frame["vector"]), np.float64).reshape(len(frame), -1)
        node, weight, block = (frame[c].to_numpy() for c in ("node", "weight", "block"))
        most = max(map(len, frame["leaves"]))
        leaves = np.full((len(frame), most), -1, np.int64)
        for r, x in enumerate(frame["leaves"]):
            leaves[r, : len(x)] = x
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        links = np.zeros(len(frame), np.int64)
        pairs = []
        for at in range(0, len(left), 256):
            some = left[at : at + 256]
            i, j = np.nonzero(units[some] @ units[right].T >= cosine)
            i, j = some[i], right[j]
            if lo == hi:
                i, j = i[i < j], j[i < j]
            own = _owned(leaves, i, j, leaf)
            i, j = i[own], j[own]
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            if len(i):  # only a spanning forest of the links so far is held
                pairs.append(np.stack([i, j]))
                label = _spanning(len(frame), *np.concatenate(pairs, axis=1))
                joined = np.flatnonzero(label != np.arange(len(frame)))
                pairs = [np.stack([joined, label[joined]])]
        i, j = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
        some = np.flatnonzero(links)
        return pd.DataFrame(
            {
                "a": np.concatenate([node[i], node[some]]),
                "b": pd.array([*node[j], *[None] * len(some)], dtype="Int64"),
                "links": np.concatenate([np.zeros(len(i), np.int64), links[some]]),
            }
        )

    return run


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, seed: int = 0
) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable), kept."""
    rows = staged(_rows(df, vector_col, id_col), "forest-rows")
    members = rows.select("vec_id", "node")
    nodes = rows.filter("node is not null").groupBy("node").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("vec_id"), F.first("vector").alias("vector"), F.first("dimension").alias("dimension")
    )
    nodes = staged(nodes, "forest-nodes")
    placed = staged(_routed(nodes, grown_forests(nodes, cosine, trees, leaf, seed), cosine), "forest-routed")
    sizes = placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count()
    blocks = sizes.filter("count > 1").select("leaf", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    spread = placed.withColumn("leaf", F.explode("leaves")).join(blocks, "leaf")
    spread = spread.withColumn("block", F.pmod(F.xxhash64("node", "leaf"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.withColumn("lo", F.least("block", "with")).withColumn("hi", F.greatest("block", "with"))
    compared = spread.groupBy("leaf", "lo", "hi").applyInPandas(_compare(cosine), "a long, b long, links long")
    compared = staged(compared, "forest-compared")
    roots = components(compared.filter("b is not null"), "forest")
    counts = compared.filter("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    merged = nodes.select("node", "weight", "vec_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = merged.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    classes = merged.join(least, "root").join(counts.withColumnRenamed("a", "node"), "node", "left")
    classes = classes.select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = members.join(classes, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept")
    )
