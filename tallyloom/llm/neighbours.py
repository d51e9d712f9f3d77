"""Nearest neighbours by a hierarchical k-means tree with best-bin-first traversal."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import map_batches, written

#: Vectors that the tree is fitted on (expected number, chosen by a hash of the id), children of a node, and vectors of the
#: sample below which a node is a leaf.
SAMPLE, BRANCHES, LEAF = 20_000, 8, 400
#: Sample queries for the number of leaves to visit, and the recall that they must reach.
TRIALS, RECALL = 200, 0.96
#: Candidates and queries of one leaf that meet in one group at most, about.
GROUP_ROWS = 4_000


@dataclass(frozen=True)
class Tree:
    """children[i]: node numbers below node i (empty: a leaf); centres: one row for each node; root is 0."""

    centres: np.ndarray
    children: tuple[tuple[int, ...], ...]
    visits: int = 1

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """The leaf that each row falls into by the nearest centre at every level."""
        out = np.zeros(len(rows), np.int64)
        waiting = [(0, np.arange(len(rows)))]
        while waiting:
            node, members = waiting.pop()
            below = self.children[node]
            if not below or not len(members):
                out[members] = node
                continue
            nearest = np.argmin(_squares(rows[members], self.centres[list(below)]), axis=1)
            waiting += [(child, members[nearest == k]) for k, child in enumerate(below)]
        return out

    def leaves_for(self, row: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves, best bin first: a queue holds the branches passed by, by distance of their centre."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < visits:
            _, node = heapq.heappop(queue)
            while self.children[node]:
                below = self.children[node]
                distances = ((self.centres[list(below)] - row) ** 2).sum(axis=1)
                best = int(np.argmin(distances))
                for k, child in enumerate(below):
                    if k != best:
                        heapq.heappush(queue, (float(distances[k]), child))
                node = below[best]
            out.append(node)
        return out


def _squares(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows**2).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(axis=1)


def _means(rows: np.ndarray, count: int, random: np.random.Generator) -> np.ndarray:
    """Assignment of rows to ``count`` clusters after some k-means rounds."""
    centres = rows[random.choice(len(rows), count, replace=False)]
    for _ in range(10):
        near = np.argmin(_squares(rows, centres), axis=1)
        centres = np.array([rows[near == k].mean(axis=0) if (near == k).any() else centres[k] for k in range(count)])
    return np.argmin(_squares(rows, centres), axis=1)


def grown(rows: np.ndarray, seed: int = 5) -> Tree:
    """A tree over the distinct ones of ``rows``."""
    rows = np.unique(rows, axis=0)
    random = np.random.default_rng(seed)
    centres, children, waiting = [rows.mean(axis=0) if len(rows) else np.zeros(rows.shape[1])], [()], [(0, np.arange(len(rows)))]
    while waiting:
        node, members = waiting.pop()
        if len(members) <= LEAF:
            continue
        part = _means(rows[members], BRANCHES, random)
        groups = [members[part == k] for k in range(BRANCHES) if (part == k).any()]
        if len(groups) < 2:
            continue
        numbers = range(len(centres), len(centres) + len(groups))
        children[node] = tuple(numbers)
        for number, group in zip(numbers, groups, strict=True):
            centres.append(rows[group].mean(axis=0))
            children.append(())
            waiting.append((number, group))
    return Tree(np.array(centres), tuple(children))


def calibrated(tree: Tree, rows: np.ndarray, k: int) -> Tree:
    """``tree`` with the smallest number of leaves that finds ``RECALL`` of the sample's true neighbours, doubled from 1."""
    leaves, total = tree.leaf_of(rows), sum(not c for c in tree.children)
    queries = rows[:: max(1, len(rows) // TRIALS)]
    orders = [tree.leaves_for(q, total) for q in queries]
    truth = [np.argsort(((rows - q) ** 2).sum(axis=1), kind="stable")[1 : k + 1] for q in queries]
    visits = 1
    while visits < total:
        hits = sum(np.isin(leaves[t], o[:visits]).sum() for t, o in zip(truth, orders, strict=True))
        if hits >= RECALL * sum(map(len, truth)):
            break
        visits = min(total, max(visits + 1, visits * 5 // 4))
    return Tree(tree.centres, tree.children, visits)


def _usable(vectors: DataFrame) -> DataFrame:
    sound = "forall(vector, x -> x is not null and not isnan(x) and abs(x) <> double('infinity')) and exists(vector, x -> x <> 0)"
    typed = vectors.selectExpr("cast(vec_id as bigint) as vec_id", "cast(embedding as array<double>) as vector")
    return typed.where(f"vec_id is not null and vector is not null and {sound}")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _leaf_batch(batch: pa.RecordBatch, tree: Tree) -> Iterator[dict]:
    rows = _matrix(batch.column(1), tree.centres.shape[1])
    yield {"vec_id": batch.column(0), "vector": batch.column(1), "leaf": tree.leaf_of(rows)}


def _visit_batch(batch: pa.RecordBatch, tree: Tree) -> Iterator[dict]:
    rows = _matrix(batch.column(1), tree.centres.shape[1])
    visited = [tree.leaves_for(row, tree.visits) for row in rows]
    owner = np.repeat(np.arange(len(rows)), [len(v) for v in visited])
    yield {
        "query_id": batch.column(0).take(pa.array(owner)),
        "query": batch.column(1).take(pa.array(owner)),
        "leaf": np.concatenate([*visited, []]).astype(np.int64),
    }


def _nearest(candidates: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    out = []
    if len(candidates) and len(queries):
        ids, rows = candidates["vec_id"].to_numpy(), np.array(candidates["vector"].tolist())
        for query_id, query in zip(queries["query_id"], queries["query"], strict=True):
            distance = np.sqrt(((rows - np.asarray(query)) ** 2).sum(axis=1))
            others = np.flatnonzero(ids != query_id)
            best = others[np.lexsort((ids[others], distance[others]))[:k]]
            out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[best], "score": distance[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def neighbours(vectors: DataFrame, queries: str, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``vectors`` (vec_id, embedding) where ``queries`` (SQL text) holds, the
    ``k`` nearest found among all other ids by Euclidean distance, ties to the smaller vec_id.

    Null, zero or non-finite vectors and null ids take no part, nor do vectors of another length than most have; a repeated id
    counts once for each query, with its nearest vector. Fewer candidates give fewer rows, none give none.

    Every vector is put into a leaf. Of equal vectors only the k + 1 smallest ids can be among the nearest, so the others
    leave before the join, by a rank limit that also runs before the shuffle. Leaves and their queries are dealt into groups of
    bounded size, so a crowded leaf is no single task.
    """
    usable = written(_usable(vectors).withColumn("size", F.size("vector")))
    common = usable.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return vectors.sparkSession.createDataFrame([], schema)
    usable = usable.where(f"size = {common['size']}").select("vec_id", "vector")
    share = min(1.0, SAMPLE / common["count"])
    chosen = usable.where(f"pmod(xxhash64(vec_id), 1048576) < {share * 1048576}").orderBy("vec_id").select("vector").toArrow()
    sample = _matrix(chosen.column(0).combine_chunks(), common["size"]) if chosen.num_rows else np.zeros((0, common["size"]))
    tree = calibrated(grown(sample), np.unique(sample, axis=0), k)

    once = usable.dropDuplicates(["vec_id", "vector"])  # the rank counts ids, not rows
    ranked = once.withColumn("place", F.expr("row_number() over (partition by vector order by vec_id)")).where(f"place <= {k + 1}")
    candidates = written(map_batches(ranked.select("vec_id", "vector"), partial(_leaf_batch, tree=tree), "vec_id long, vector array<double>, leaf long"))
    asked = usable.where(queries).dropDuplicates(["vec_id", "vector"])
    visits = written(map_batches(asked, partial(_visit_batch, tree=tree), "query_id long, query array<double>, leaf long"))

    # a row for each leaf, of which a tree over a bounded sample has a bounded number
    sizes = candidates.groupBy("leaf").agg(F.count("*").alias("c")).join(visits.groupBy("leaf").agg(F.count("*").alias("q")), "leaf")
    grid = written(sizes.selectExpr("leaf", f"cast(ceil(c / {GROUP_ROWS}) as int) as cs", f"cast(ceil(q / {GROUP_ROWS}) as int) as qs"))
    key = ["leaf", "c", "q"]
    left = candidates.join(F.broadcast(grid), "leaf").selectExpr(
        "leaf", "cast(pmod(xxhash64(vec_id), cs) as int) as c", "explode(sequence(0, qs - 1)) as q", "vec_id", "vector"
    )
    right = visits.join(F.broadcast(grid), "leaf").selectExpr(
        "leaf", "cast(pmod(xxhash64(query_id), qs) as int) as q", "explode(sequence(0, cs - 1)) as c", "query_id", "query"
    )
    near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(partial(_nearest, k=k), "query_id long, vec_id long, score double")
    best = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = "row_number() over (partition by query_id order by score, vec_id)"
    return best.withColumn("rank", F.expr(order)).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
