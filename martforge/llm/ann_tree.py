"""Nearest neighbours by inner product over a hierarchical k-means tree.

The tree is fitted on a bounded sample (``max_fit`` vectors, smallest hashes of the
id first): every node is split by k-means into ``branches`` children until a node holds no more
than ``leaf_fit`` sample vectors. Every row of the table is then sent down to a leaf.

A query walks the tree best bin first: a priority queue holds unopened nodes by
the inner product of the query with their centre, and leaves come out in the
order in which they are to be searched. How many leaves to visit is calibrated: for a
fixed number of calibration queries the exact neighbours among all rows are found by a
full pass, and visits are widened until ``target_recall`` of them lie in visited leaves.

Leaves that are neighbours in the tree are searched together, in groups of at most ``block_rows``
vectors, against blocks of at most ``block_queries`` queries; a leaf of more vectors is
spread over several blocks. A query is sent to a group once, with the leaves it visits there, and a block returns
its exact ``k`` best over all of them, so what is sent on grows with the groups that a query meets and not
with its leaves. The best of all blocks remain.

Defined results: vectors that are null, zero, of another than the commonest length, or hold
a null or non-finite component take no part, nor do rows of a null id; rows
that repeat an id count once (equal vectors) or with their best score; an empty
table gives an empty result; ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import cut


def valid(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): usable vectors as arrays of doubles, equal rows once."""
    v = F.col("v")
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    limit = F.lit(float("inf"))
    good = base.filter(
        F.col("vec_id").isNotNull()
        & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
        & F.exists(v, lambda x: x != 0)
    )
    common = good.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return good.filter(F.size(v) == (common["n"] if common else 0)).distinct()


@dataclass
class Tree:
    """Nodes as arrays; children of node i are ``first[i] .. first[i] + count[i]``; leaves have none."""

    centres: np.ndarray
    first: list[int] = field(default_factory=list)
    count: list[int] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)  # leaf number, -1 for inner nodes

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1

    def leaf_order(self) -> list[int]:
        """Leaf numbers depth first, so that leaves of one branch are neighbours."""
        out, stack = [], [0]
        while stack:
            at = stack.pop()
            if not self.count[at]:
                out.append(self.leaf[at])
            stack.extend(range(self.first[at] + self.count[at] - 1, self.first[at] - 1, -1) if self.count[at] else ())
        return out

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of each row: at each level the nearest centre."""
        out = np.zeros(len(x), dtype=np.int32)
        work = [(0, np.arange(len(x)))]
        while work:
            at, rows = work.pop()
            if not len(rows):
                continue
            if not self.count[at]:
                out[rows] = self.leaf[at]
                continue
            kids = np.arange(self.first[at], self.first[at] + self.count[at])
            c = self.centres[kids]
            near = np.argmax(x[rows] @ c.T - 0.5 * (c * c).sum(1), axis=1)
            work += [(int(kid), rows[near == j]) for j, kid in enumerate(kids)]
        return out

    def visits(self, q: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves for one query, best bin first."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < most:
            _, at = heapq.heappop(queue)
            if not self.count[at]:
                out.append(self.leaf[at])
                continue
            kids = range(self.first[at], self.first[at] + self.count[at])
            for kid, s in zip(kids, (self.centres[kids.start : kids.stop] @ q).tolist()):
                heapq.heappush(queue, (-s, kid))
        return out


def fit_tree(x: np.ndarray, branches: int = 8, leaf_fit: int = 48, rounds: int = 8, seed: int = 42) -> Tree:
    """Split nodes by k-means, breadth first."""
    rng = np.random.default_rng(seed)
    centres, tree = [x.mean(0)], Tree(np.zeros((0, x.shape[1])), [0], [0], [-1])
    level = [(0, np.arange(len(x)))]
    while level:
        below = []
        for at, rows in level:
            mine = x[rows]
            distinct = np.unique(mine, axis=0) if len(rows) > leaf_fit else mine[:1]
            k = min(branches, len(distinct))
            if k < 2:
                continue
            c = distinct[rng.choice(len(distinct), k, replace=False)]
            for _ in range(rounds):
                near = np.argmax(mine @ c.T - 0.5 * (c * c).sum(1), axis=1)
                c = np.stack([mine[near == j].mean(0) if (near == j).any() else c[j] for j in range(k)])
            near = np.argmax(mine @ c.T - 0.5 * (c * c).sum(1), axis=1)
            used = [j for j in range(k) if (near == j).any()]
            if len(used) < 2:
                continue
            tree.first[at], tree.count[at] = len(centres), len(used)
            for j in used:
                below.append((len(centres), rows[near == j]))
                centres.append(c[j])
                for column, v in ((tree.first, 0), (tree.count, 0), (tree.leaf, -1)):
                    column.append(v)
        level = below
    n = 0
    for at in range(len(centres)):
        if not tree.count[at]:
            tree.leaf[at] = n
            n += 1
    tree.centres = np.array(centres)
    return tree


def leaf_groups(order: list[int], sizes: dict[int, int], block_rows: int) -> list[tuple[int, int, int]]:
    """(leaf, group, parts): neighbouring leaves of at most ``block_rows`` rows together, a larger leaf alone in parts."""
    out, group, held = [], 0, 0
    for leaf in order:
        n = sizes.get(leaf, 0)
        if held and held + n > block_rows:
            group, held = group + 1, 0
        out.append((leaf, group, max(1, -(-n // block_rows))))
        held += n
    return out


def best_of(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, allowed: np.ndarray | None = None):
    """(query row, id row, score) of each query's exact k best ids, ties to the smaller id.

    An id in several rows counts once, with its best score. ``allowed`` (queries by rows) says which rows a query sees.
    A matrix product finds the candidates within a rounding margin of the k-th
    best; their scores are then summed component by component in one fixed order,
    so equal vectors score equally wherever they stand.
    """
    fast = q @ x.T
    fast[q_ids[:, None] == ids[None, :]] = -np.inf
    if allowed is not None:
        fast[~allowed] = -np.inf
    by_id = np.argsort(ids, kind="stable")
    firsts = np.flatnonzero(np.concatenate(([True], np.diff(ids[by_id]) != 0)))
    # the best of each id, so that rows of one id take one of the k places
    each = fast if len(firsts) == len(ids) else np.maximum.reduceat(fast[:, by_id], firsts, axis=1)
    n = min(k, each.shape[1])
    last = -np.partition(-each, n - 1, axis=1)[:, n - 1]
    margin = 1e-9 * (np.abs(q).sum(1) * np.abs(x).max(initial=0) + 1e-300)
    a, b = np.nonzero((fast >= (last - margin)[:, None]) & (fast > -np.inf))
    score = np.zeros(len(a))
    for d in range(x.shape[1]):
        score += q[a, d] * x[b, d]
    order = np.lexsort((ids[b], -score, a))
    a, b, score = a[order], b[order], score[order]
    # a repeated id counts once
    once = np.ones(len(a), dtype=bool)
    pairs = np.lexsort((-score, ids[b], a))
    pa_, pb = a[pairs], ids[b][pairs]
    again = np.concatenate(([False], (pa_[1:] == pa_[:-1]) & (pb[1:] == pb[:-1])))
    once[pairs[again]] = False
    a, b, score = a[once], b[once], score[once]
    starts = np.searchsorted(a, np.arange(len(q)))
    keep = np.arange(len(a)) - starts[a] < k
    return a[keep], b[keep], score[keep]


def _matrix(column, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, width)


def _calibrate(rows: DataFrame, tree: Tree, width: int, k: int, target: float, queries: int) -> int:
    """Leaves to visit so that ``target`` of the exact neighbours of sample queries are found."""
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(queries).collect()  # a fixed number
    q_ids = np.array([r["vec_id"] for r in sample], dtype=np.int64)
    q = np.array([r["v"] for r in sample], dtype=np.float64).reshape(-1, width)

    def nearest(it):
        for batch in it:
            ids, leaf = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            a, b, s = best_of(q_ids, q, ids, _matrix(batch.column(1), width), k)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(ids[b]), pa.array(leaf[b]), pa.array(s)], ["q", "vec_id", "leaf", "score"])

    found = rows.select("vec_id", "v", "leaf").mapInArrow(nearest, "q long, vec_id long, leaf int, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    found = found.groupBy("q", "vec_id").agg(F.max_by("leaf", F.struct("score", "leaf")).alias("leaf"), F.max("score").alias("score"))
    truth = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).groupBy("q", "leaf").count().collect()
    if not truth:
        return 1
    order = [{leaf: n for n, leaf in enumerate(tree.visits(v, tree.leaves))} for v in q]
    need = np.zeros(tree.leaves + 1)
    for r in truth:
        need[order[r["q"]][r["leaf"]] + 1] += r["count"]
    return int(np.searchsorted(np.cumsum(need) / need.sum(), target - 1e-12))


def search(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    target_recall: float = 0.97,
    max_fit: int = 16_384,
    leaf_fit: int = 48,
    calibration_queries: int = 128,
    block_rows: int = 4096,
    block_queries: int = 512,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best rows.

    ``is_query`` is a condition over ``vec_id``; a query's own id is no candidate.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = valid(vectors)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max_fit).select("v").toPandas()  # bounded by max_fit
    if not len(sample):
        return empty
    x = np.array(sample["v"].tolist(), dtype=np.float64)
    width = x.shape[1]
    tree = fit_tree(x, leaf_fit=leaf_fit)
    shared = spark.sparkContext.broadcast(tree)  # at most max_fit centres

    def down(it):
        for batch in it:
            leaf = shared.value.assign(_matrix(batch.column(1), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], ["vec_id", "v", "leaf"])

    placed = cut(rows.mapInArrow(down, "vec_id long, v array<double>, leaf int"))
    visits = max(1, _calibrate(placed, tree, width, k, target_recall, calibration_queries))

    counts = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}  # a row for each leaf
    groups = leaf_groups(tree.leaf_order(), counts, block_rows)
    group_of = np.zeros(tree.leaves, dtype=np.int32)
    for leaf, group, _ in groups:
        group_of[leaf] = group

    def walk(it):
        for batch in it:
            own, at, leaves = [], [], []
            for i, v in enumerate(_matrix(batch.column(1), width)):
                seen = np.array(shared.value.visits(v, visits), dtype=np.int32)
                seen = seen[np.argsort(group_of[seen], kind="stable")]
                met, starts = np.unique(group_of[seen], return_index=True)
                own.extend([i] * len(met))
                at.extend(met.tolist())
                leaves.extend(x.tolist() for x in np.split(seen, starts[1:]))
            rows_ = pa.array(own, pa.int64())
            columns = [batch.column(0).take(rows_), batch.column(1).take(rows_), pa.array(at, pa.int32()), pa.array(leaves, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "q", "grp", "leaves"])

    queries = placed.filter(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    asked = cut(queries.mapInArrow(walk, "query_id long, q array<double>, grp int, leaves array<int>"))
    blocks = asked.groupBy("grp").agg(F.ceil(F.count("*") / block_queries).cast("int").alias("q_parts"))
    # a row for each leaf, and no more leaves than fitted vectors
    sizes = F.broadcast(spark.createDataFrame(groups, "leaf int, grp int, parts int").join(blocks, "grp"))
    # a block of a group meets every block of the group's queries
    left = placed.join(sizes, "leaf").select(
        "grp",
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)).alias("q_part"),
        "leaf",
        "vec_id",
        "v",
    )
    per_group = F.broadcast(sizes.groupBy("grp").agg(F.max("parts").alias("parts"), F.max("q_parts").alias("q_parts")))
    right = asked.join(per_group, "grp").select(
        "grp",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("query_id", F.lit(1)), F.col("q_parts")).cast("int").alias("q_part"),
        "query_id",
        "q",
        "leaves",
    )

    def block(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, q_ids = rows["vec_id"].to_numpy(), queries["query_id"].to_numpy()
        there, which = np.unique(rows["leaf"].to_numpy(), return_inverse=True)
        sees = np.stack([np.isin(there, leaves) for leaves in queries["leaves"]])
        a, b, s = best_of(q_ids, np.stack(queries["q"]), ids, np.stack(rows["v"]), k, sees[:, which])
        return pd.DataFrame({"query_id": q_ids[a], "vec_id": ids[b], "score": s})

    keys = ["grp", "part", "q_part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(block, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
