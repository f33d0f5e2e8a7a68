"""Merkle manifest of a dataset: leaf digests, language subroots, a root and a proof for each row.

Every row is a leaf: the SHA-256 of its fields with their byte counts. Per language the leaves,
in order of the id, are the lowest level of a tree of fan-out 8; subroots, in order of the
language, are the leaves of one more tree whose top is the root. A digest of several
inputs is the SHA-256 of their hex texts end to end; a run of one is hashed as well.

Time-forward processing. A node's label is (level, index), so children come before their
parent. A forward sweep takes nodes in order of their label; each digest is put into
a priority queue under its parent's label and comes out when the sweep gets there. A second sweep in
reversed order sends to each child what its proof needs above it, down to the leaves.
A block is the subtree over 512 neighbouring nodes (three levels): its sweeps run
inside one task with a queue in memory. The part of the queue that is external is Spark's:
messages between blocks are rows keyed by tree and block, and a shuffle brings them, sorted, to the
block that is due. So there are ceil(log512 n) rounds up and as many down, a block holds at
most 512 digests, and texts never move: leaves are taken where a row is read.

Defined results: a null field is ``-`` in the leaf; null languages form a tree of their own that sorts
first; null ids sort first, equal ids by their leaf; rows that are equal in everything have equal
leaves but places of their own, so they come out repeated, each with its own proof; a null id is never
tampered with; a null or empty text and a text without A-Z stays as it is when tampered with (and
verifies); one row alone is leaf, subroot and root at once, its proof is the digest of
nothing; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import cut
from martforge.operators.ranking import positions

FAN = 8
#: Levels that one task sweeps, and the nodes below them.
LEVELS = 3
BLOCK = FAN**LEVELS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<before:string,after:string>>"


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(text: Column) -> Column:
    """Hex digest of a row with this text."""
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    return F.sha2(F.concat(*map(_field, fields)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, digest, tampered (null: as it was) and a number that tells equal rows apart."""
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0) & F.col("text").isNotNull()
    lowered = F.translate(F.col("text"), UPPER, LOWER)
    return docs.select(
        F.coalesce(F.concat(F.lit("+"), F.col("lang")), F.lit("")).alias("tree"),
        "doc_id",
        F.unhex(leaf_of(F.col("text"))).alias("digest"),
        F.when(hit & (lowered != F.col("text")), F.unhex(leaf_of(lowered))).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    )


def _digest(hex_texts) -> str:
    return hashlib.sha256("".join(hex_texts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one remains."""
    k = 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
    return k


def forward(digests: list[str], top: int) -> list[list[str]]:
    """Digests of all levels 0 .. ``top`` over ``digests``: each node is hashed when the queue reaches its label."""
    levels = [list(digests)] + [[] for _ in range(top)]
    queue = [(1, i // FAN, i % FAN, d) for i, d in enumerate(digests)] if top else []
    while queue:
        level, node = queue[0][:2]
        run = []
        while queue and queue[0][:2] == (level, node):
            run.append(heapq.heappop(queue)[3])
        own = _digest(run)
        levels[level].append(own)
        if level < top:
            heapq.heappush(queue, (level + 1, node // FAN, node % FAN, own))
    return levels


def backward(levels: list[list[str]], above: list) -> list[list]:
    """For each digest of level 0 its (before, after) siblings level by level, ``above`` last.

    Nodes are taken in reversed order of their labels; each passes its own suffix on to its children.
    """
    out: list = [None] * len(levels[0])
    queue = [(-(len(levels) - 1), 0, None)]
    while queue:
        level, node, suffix = heapq.heappop(queue)
        if level == 0:
            path = []
            while suffix is not None:
                pair, suffix = suffix
                path.append(pair)
            out[node] = path + above
            continue
        first = node * FAN
        run = levels[-level - 1][first : first + FAN]
        for k in range(len(run)):
            heapq.heappush(queue, (level + 1, first + k, (("".join(run[:k]), "".join(run[k + 1 :])), suffix)))
    return out


def folded(digest: str, path: list) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in path:
        digest = _digest((before, digest, after))
    return digest


def _block() -> Column:
    return F.floor(F.col("at") / BLOCK).cast("long")


def _hexes(column) -> list[str]:
    return [d.hex() for d in column.to_pylist()]


def _up(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """A block's digest three levels up, and the one where a tree of this block alone ends."""
    table = table.sort_by("at")
    levels = forward(_hexes(table["digest"]), max(LEVELS, height(table.num_rows)))
    return pa.table(
        {
            "tree": [key[0].as_py()],
            "at": pa.array([key[1].as_py()], pa.int64()),
            "digest": [bytes.fromhex(levels[LEVELS][0])],
            "whole": [bytes.fromhex(levels[height(table.num_rows)][0])],
        }
    )


def sweep_up(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Nodes (tree, at, digest) of every round, and (tree, round, digest) of the trees' tops (None: no node)."""
    sizes = cut(nodes.groupBy("tree").agg((F.max("at") + 1).alias("n")))
    most = sizes.agg(F.max("n")).first()[0]
    if most is None:
        return [nodes], None
    rounds, tops, span = [nodes], None, 1
    while True:
        span *= BLOCK
        level = rounds[-1].select("tree", "at", "digest", _block().alias("block")).groupBy("tree", "block")
        level = level.applyInArrow(_up, "tree string, at long, digest binary, whole binary")
        level = cut(level.join(sizes, "tree"))
        ended = level.filter(F.col("n") <= span).select("tree", F.lit(len(rounds) - 1).alias("round"), F.col("whole").alias("digest"))
        tops = ended if tops is None else tops.unionByName(ended)
        if most <= span:
            return rounds, tops
        rounds.append(level.filter(F.col("n") > span).select("tree", "at", "digest"))


def _paths(left: pa.Table, right: pa.Table) -> tuple[pa.Table, list[list]]:
    """The block's rows in order and the path of each, from the message about the block."""
    left = left.sort_by("at")
    message = right.to_pylist()[0]
    above = [(p["before"], p["after"]) for p in message["path"]]
    top = height(left.num_rows) if message["whole"] else LEVELS
    return left, backward(forward(_hexes(left["digest"]), top), above)


def _down(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """Messages about the blocks that the nodes of this one stand for."""
    rows, paths = _paths(left, right)
    n = rows.num_rows
    return pa.table(
        {
            "tree": [key[0].as_py()] * n,
            "block": rows["at"],
            "whole": [False] * n,
            "path": pa.array([[{"before": a, "after": b} for a, b in p] for p in paths], MESSAGE_PATH),
            "subroot": right["subroot"].to_pylist() * n,
            "root": right["root"].to_pylist() * n,
        }
    )


MESSAGE_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
MESSAGE = f"tree string, block long, whole boolean, path {PATH}, subroot string, root string"


def sweep_down(rounds: list[DataFrame], tops: DataFrame, last, schema: str) -> DataFrame:
    """``last(key, rows, message)`` over the blocks of the first round, after the messages came down.

    ``tops``: (tree, round, path, subroot, root) of every tree.
    """
    messages = None
    for k in reversed(range(len(rounds))):
        own = tops.filter(F.col("round") == k).select("tree", F.lit(0).cast("long").alias("block"), F.lit(True).alias("whole"), "path", "subroot", "root")
        messages = own if messages is None else own.unionByName(messages)
        pair = rounds[k].select("*", _block().alias("block")).groupBy("tree", "block").cogroup(messages.groupBy("tree", "block"))
        if k == 0:
            return pair.applyInArrow(last, schema)
        messages = cut(pair.applyInArrow(_down, MESSAGE))


def _no_path() -> Column:
    return F.array().cast(PATH)


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row; lang last."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, lang string"
    nodes = positions(cut(leaves(docs)), ["doc_id", "digest", "row"], group="tree").drop("row")
    rounds, tops = sweep_up(nodes)
    if tops is None:
        return docs.sparkSession.createDataFrame([], schema)
    # the tree of the subroots: its nodes are the tops of the language trees
    tops = cut(tops)
    upper = positions(tops.select(F.col("tree").alias("name"), "round", "digest"), ["name"]).select(
        F.lit("").alias("tree"), "at", "digest", "name", F.col("round").alias("below")
    )
    upper = cut(upper)
    upper_rounds, upper_tops = sweep_up(upper)
    root = upper_tops.select("tree", "round", _no_path().alias("path"), F.lit("").alias("subroot"), F.lower(F.hex("digest")).alias("root"))

    def subroots(key, left, right):
        rows, paths = _paths(left, right)
        return pa.table(
            {
                "tree": rows["name"],
                "round": rows["below"],
                "path": pa.array([[{"before": a, "after": b} for a, b in p] for p in paths], MESSAGE_PATH),
                "subroot": _hexes(rows["digest"]),
                "root": right["root"].to_pylist() * rows.num_rows,
            }
        )

    above = cut(sweep_down(upper_rounds, root, subroots, f"tree string, round int, path {PATH}, subroot string, root string"))

    def proofs(key, left, right):
        rows, paths = _paths(left, right)
        tree, message = key[0].as_py(), right.select(["subroot", "root"]).to_pylist()[0]
        own, changed, n = _hexes(rows["digest"]), rows["tampered"].to_pylist(), rows.num_rows
        ends = [folded(d if t is None else t.hex(), p) for d, t, p in zip(own, changed, paths)]
        return pa.table(
            {
                "doc_id": rows["doc_id"],
                "leaf": own,
                "subroot": [message["subroot"]] * n,
                "root": [message["root"]] * n,
                "proof_sha256": [_digest(x for pair in p for x in pair) for p in paths],
                "folded_root": ends,
                "verified": [e == message["root"] for e in ends],
                "lang": pa.array([tree[1:] if tree else None] * n, pa.string()),
            }
        )

    return sweep_down(rounds, above, proofs, schema)
