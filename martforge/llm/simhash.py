"""SimHash near-duplicate groups by multi-index hashing.

A document's fingerprint is the bitwise majority of the XXH64 values of its word
shingles. Documents of equal fingerprint are one class; classes link where their
fingerprints differ in few bits, and linked classes form a component.

Candidate search: the 64 bits are split into segments. Two fingerprints within
``max_bits`` of each other agree, in at least one segment, up to
``max_bits // segments`` bits. Every fingerprint is stored once per segment and
looked up with the small Hamming ball round its own segment value. Complete
distances are then verified.

Defined results: null or empty texts have fingerprint zero and link like any
other; fewer words than the shingle length make one shingle of all words; rows
of a null id keep a null id and get the smallest id of their component; repeated
rows come out repeated; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import cut, texts
from martforge.llm.components import connected_components

SEED = 42


def fingerprint(text: str, shingle: int = 4, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of one text (ASCII lower case, ASCII white space)."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    k = min(shingle, len(words))
    n = len(words) - k + 1
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(joined[a : b - 1], seed) for a, b in zip(starts[:n].tolist(), ends[k - 1 :].tolist())),
        dtype="<u8",
        count=n,
    )
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view("<u8")[0])


def _text_key() -> list:
    """Two 64-bit hashes of the text (null: empty): which of the rows of one id a row is."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2")]


def fingerprints(docs: DataFrame, shingle: int = 4, keyed: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long; ``keyed`` adds the hashes of ``_text_key``."""
    base = texts(docs)
    base = base.select("doc_id", "text", *_text_key()) if keyed else base
    more = base.columns[2:]

    def batches(it):
        for batch in it:
            out = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            fp = pa.array(np.array(out, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp, *batch.columns[2:]], ["doc_id", "fp", *more])

    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(batches, f"doc_id {kind}, fp long" + "".join(f", {c} long" for c in more))


def _segments(n: int) -> list[tuple[int, int]]:
    """(shift, width) of ``n`` segments that cover 64 bits."""
    widths = [64 // n + (i < 64 % n) for i in range(n)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def _part(col, shift: int, bits: int):
    return F.shiftrightunsigned(col, shift).bitwiseAND(F.lit((1 << bits) - 1))


def _ball(segment: int, value, bits: int, radius: int):
    """Array of (s, key, same): the segment's own value and its upward flips."""
    masks = [sum(1 << b for b in flip) for r in range(1, radius + 1) for flip in itertools.combinations(range(bits), r)]
    flips = F.filter(F.array(*[F.lit(m).cast("bigint") for m in masks]).cast("array<bigint>"), lambda m: value.bitwiseXOR(m) > value)
    return F.transform(
        F.concat(F.array(F.lit(0).cast("bigint")), flips),
        lambda m: F.struct(F.lit(segment).alias("s"), value.bitwiseXOR(m).alias("key"), (m == 0).alias("same")),
    )


def near_pairs(classes: DataFrame, max_bits: int = 4, segments: int = 3) -> DataFrame:
    """(u, v) pairs of distinct fingerprints ``fp`` at ``max_bits`` or fewer, each once.

    A mask of the ball is added only to a segment value in which its top bit is
    clear, so of the two directions of a differing pair one is generated. A
    pair that several segments find is kept in the first of them.
    """
    radius = max_bits // segments
    parts = _segments(segments)
    fp = F.col("fp")
    tables = [F.struct(F.lit(s).alias("s"), _part(fp, *part).alias("key")) for s, part in enumerate(parts)]
    probes = [_ball(s, _part(fp, *part), part[1], radius) for s, part in enumerate(parts)]
    table = classes.select(fp.alias("v"), F.explode(F.array(*tables)).alias("t")).select("v", "t.s", "t.key")
    probe = classes.select(fp.alias("u"), F.explode(F.concat(*probes)).alias("t")).select("u", "t.s", "t.key", "t.same")
    differ = F.col("u").bitwiseXOR(F.col("v"))
    first = F.coalesce(
        *[F.when(F.bit_count(_part(differ, shift, bits)) <= radius, F.lit(s)) for s, (shift, bits) in enumerate(parts)]
    )
    return (
        probe.join(
            table,
            (probe["s"] == table["s"])
            & (probe["key"] == table["key"])
            & (~F.col("same") | (F.col("u") < F.col("v")))
            & (F.bit_count(differ) <= max_bits)
            & (first == probe["s"]),
        )
        .select("u", "v")
    )


def _rooted(classes: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """``classes`` (fp, least) with ``root``, the smallest fingerprint of the component."""
    roots = connected_components(near_pairs(classes, max_bits, segments))
    return classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def simhash_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, segments: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest doc_id reachable over links, its own included.
    """
    marked = cut(fingerprints(docs, shingle))
    rooted = _rooted(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), max_bits, segments)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    member = rooted.join(least, "root").select("fp", "component_id")
    return marked.join(member, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each_group(docs: DataFrame, shingle: int = 4, max_bits: int = 4, segments: int = 3) -> DataFrame:
    """One document (all its columns) of every group: the one with the smallest id, null ids last.

    Rows are told apart by id and text, so texts that share an id, or have none, stay
    in the groups of their own. Of rows of that id in the group, the one of the
    smallest text hash stays; of rows equal in id and text, any one.
    """
    marked = cut(fingerprints(docs, shingle, keyed=True))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_h1", "_h2")
    rooted = _rooted(marked.groupBy("fp").agg(F.min(row).alias("least")), max_bits, segments)
    first = rooted.groupBy("root").agg(F.min("least").alias("least")).select(
        F.col("least.doc_id").alias("_first_id"), F.col("least._h1").alias("_f1"), F.col("least._h2").alias("_f2")
    )
    keyed = docs.select("*", *_text_key())
    kept = keyed.join(
        first,
        F.col("doc_id").eqNullSafe(F.col("_first_id")) & (F.col("_h1") == F.col("_f1")) & (F.col("_h2") == F.col("_f2")),
        "left_semi",
    )
    # an aggregate, so that rows repeated very often shrink before the shuffle
    return kept.dropDuplicates(["doc_id", "_h1", "_h2"]).select(docs.columns)
