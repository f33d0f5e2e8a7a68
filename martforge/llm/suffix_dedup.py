"""Exact repeated passages by bucket-pointer refinement of sampled suffixes.

A byte is removed if it lies in a string of ``length`` bytes (100) that also starts
earlier: in a document of smaller id, or further left in the same one. Strings
never cross documents and are judged on the input.

Refinement, as in a suffix sort by bucket pointers:

1. q-gram buckets. Sorting every suffix of a corpus would shuffle many times
   its size. Instead each string of 100 bytes names one of its q-grams, the one of least
   hash (the leftmost of equals). Equal strings name equal q-grams at equal offsets, so
   only the suffixes at named q-grams ("anchors", about one in 39 bytes) go into buckets.
   An anchor stands for the run of neighbouring strings that name it.
2. A bucket is refined by an identifier of what surrounds the anchor: the whole run.
   Within a refined bucket the earliest run stays and all strings of the others are
   repeats. A bucket with one refined bucket is settled with that.
3. Earliest runs of buckets that fell apart can still share some strings. Their runs are
   cut into blocks by distance from the anchor, whose bucket is an identifier of the bytes
   that all strings of the block hold, and step 2 is applied to the blocks.
4. Blocks that are still open go by single strings, and the earliest of each stays.

What one step has settled is reused by the next and not compared again.

Identifiers are polynomial hashes modulo 2**64 (two of them for a string). Anchors that repeat
within one batch of documents are settled there, before the shuffle, so a passage with very
many copies sends one row per batch. Texts are shuffled once, by document.

Defined results: null and empty texts have no bytes; texts of under 100 bytes lose none;
a null id sorts first and stays null; rows of equal id and text count as one
document and come out repeated; texts that share an id count as documents ordered by a
128-bit hash of the text, and so do texts without an id; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import KEY, blocks, cut, keyed, width

#: Odd multipliers of the two polynomial hashes and of the bit mixer (fixed values).
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MIXERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
#: Bytes hashed at once; longer texts are hashed in overlapping parts.
BLOCK = 1 << 20
# a position is packed as: start of the first string, 7 bits distance to the anchor, 7 bits
# number of strings after the first
OFF_BITS, RUN_BITS = 7, 7
#: Strings in a block of step 3.
STRINGS = 16


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, modulo 2**64."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Hashes:
    """Hashes of any range of a byte array by prefix sums."""

    def __init__(self, data: np.ndarray, base: int):
        n = len(data) + 1
        size = max(BLOCK + 1024, n)
        up, self.down = (p[:n] for p in _powers(base, size))
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def of(self, start, stop):
        """Hashes of data[start:stop]; arrays or slices of equal length."""
        return (self.sums[stop] - self.sums[start]) * self.down[start]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIXERS[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIXERS[1])
    return h ^ (h >> np.uint64(31))


def _least_places(v: np.ndarray, span: int) -> np.ndarray:
    """For each j the leftmost place of the least value in v[j : j + span], by doubling."""
    place, s = np.arange(len(v), dtype=np.int32), 1
    while s < span:
        step = min(s, span - s)
        a, b = v[:-step], v[step:]
        less = b < a
        v = np.where(less, b, a)
        place = np.where(less, place[step:], place[:-step])
        s += step
    return place


def anchors(data: np.ndarray, ends: np.ndarray, length: int, q: int):
    """Runs of strings that name one q-gram, over documents laid end to end.

    Returns (bucket, refined bucket, first string, distance to the anchor, strings after it) arrays.
    """
    n = len(data) - length + 1
    none = tuple(np.zeros(0, dtype=k) for k in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    if n <= 0:
        return none
    one, two = (Hashes(data, b) for b in BASES)
    grams = _mixed(one.of(slice(0, len(data) - q + 1), slice(q, None)))
    place = _least_places((grams >> np.uint64(32)).astype(np.uint32), length - q + 1)
    # strings that would cross the end of a document are not there
    there = np.ones(n, dtype=bool)
    for e in ends.tolist():
        there[max(0, e - length + 1) : e] = False
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = (place[1:] != place[:-1]) | ~there[:-1]
    first = np.flatnonzero(fresh & there)
    if not len(first):
        return none
    stop = np.ones(n, dtype=bool)
    stop[:-1] = fresh[1:] | ~there[1:]
    after = np.flatnonzero(stop & there) - first
    at = place[first].astype(np.int64)
    refined = two.of(first, first + after + length) + ((at - first) * 128 + after).astype(np.uint64) * np.uint64(MIXERS[0])
    return grams[at], _mixed(refined) | np.uint64(1), first, at - first, after


def _parts(raw: bytes, length: int):
    """(offset, bytes) parts that together hold every string once."""
    step = BLOCK - length + 1
    for at in range(0, max(1, len(raw) - length + 1), step):
        yield at, raw[at : at + BLOCK]


def _packed(start, off, after):
    return ((start << OFF_BITS | off) << RUN_BITS) | after


def _unpacked(p):
    """(start, distance to the anchor, strings after the first) of packed positions."""
    return p >> (OFF_BITS + RUN_BITS), (p >> RUN_BITS) & ((1 << OFF_BITS) - 1), p & ((1 << RUN_BITS) - 1)


def _ranks(batch: pa.RecordBatch) -> np.ndarray:
    """Ranks of the documents of a batch by key (its first columns)."""
    keys = list(zip(*(batch.column(k).to_pylist() for k in range(len(KEY)))))
    at = {key: n for n, key in enumerate(sorted(set(keys)))}
    return np.array([at[key] for key in keys], dtype=np.int64)


def _sent(rows: list[tuple], batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """SENT of rows (h, c, row of the batch, p); of equal h and c only the earliest goes on as it is.

    The others are settled: they get ``c = 0`` and an ``h`` that spreads them.
    """
    if not rows:
        return None
    h, c, row, p = (np.concatenate(x) for x in zip(*rows))
    rank = _ranks(batch)[row]
    order = np.lexsort((p, rank, c, h))
    h, c, row, rank, p = (x[order] for x in (h, c, row, rank, p))
    same = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
    head = np.maximum.accumulate(np.where(np.concatenate(([True], ~same))[: len(h)], np.arange(len(h)), 0))
    later = (rank != rank[head]) | (p != p[head])
    own = batch.column(0).to_numpy()[row]
    h = np.where(later, _mixed(own.view(np.uint64) ^ _mixed(p.view(np.uint64))), h)
    c = np.where(later, np.uint64(0), c)
    at = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), *(batch.column(k).take(at) for k in range(len(KEY))), pa.array(p)], ["h", "c", *KEY, "p"]
    )


SENT = "h long, c long, id long, t binary, p long"


def bucketed(docs: DataFrame, length: int = 100, q: int = 24) -> DataFrame:
    """Anchors (h: bucket, c: refined bucket, key, p: packed position), as ``_sent``. ``docs``: as ``keyed``."""

    def batches(it):
        for batch in it:
            rows = []
            pieces = [(i, at, part) for i, t in enumerate(batch.column(2)) for at, part in _parts(t.as_py().encode("utf-8", "surrogatepass"), length) if len(part) >= length]
            for a, b in blocks([len(x[2]) for x in pieces], BLOCK):
                group = pieces[a:b]
                sizes = np.array([len(x[2]) for x in group], dtype=np.int64)
                ends = np.cumsum(sizes)
                h, c, first, off, after = anchors(np.frombuffer(b"".join(x[2] for x in group), dtype=np.uint8), ends, length, q)
                which = np.searchsorted(ends, first, side="right")
                row, at = (np.array([x[k] for x in group], dtype=np.int64)[which] for k in range(2))
                rows.append((h, c, row, _packed(first - (ends - sizes)[which] + at, off, after)))
            sent = _sent(rows, batch)
            if sent is not None:
                yield sent

    return docs.select(*KEY, "text").mapInArrow(batches, SENT)


def refined(found: DataFrame) -> DataFrame:
    """(key, p, settled): rows whose strings all repeat, and rows of buckets that fell apart."""
    bucket = Window.partitionBy("h")
    earliest = Window.partitionBy("h", "c").orderBy(*KEY, "p")
    marked = found.select(
        *KEY, "p", "c", F.rank().over(earliest).alias("r"), F.min("c").over(bucket).alias("a"), F.max("c").over(bucket).alias("b")
    )
    settled = (F.col("c") == 0) | (F.col("r") > 1)
    return marked.filter(settled | (F.col("a") != F.col("b"))).select(*KEY, "p", settled.alias("settled"))


def _of_open(by_key: DataFrame, level: DataFrame, rows_of) -> DataFrame:
    """``_sent`` rows that ``rows_of(data, starts, offs, afters)`` makes of the open rows' texts."""
    asked = level.filter("NOT settled").groupBy(*KEY).agg(F.collect_list("p").alias("ps"))  # of one text at most

    def batches(it):
        for batch in it:
            rows = []
            for row, (text, ps) in enumerate(zip(batch.column(2), batch.column(3))):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                starts, offs, afters = _unpacked(np.unique(ps.values.to_numpy()))
                data = np.frombuffer(raw, dtype=np.uint8)
                # hash the text in parts; a run starts at most 128 strings before its end
                step = BLOCK - 1024
                for at in range(0, len(raw), step):
                    here = (starts >= at) & (starts < at + step)
                    if here.any():
                        for h, c, p in rows_of(data[at : at + BLOCK], starts[here] - at, offs[here], afters[here]):
                            rows.append((h, c, np.full(len(h), row, dtype=np.int64), p + _packed(at, 0, 0)))
            sent = _sent(rows, batch)
            if sent is not None:
                yield sent

    # all columns go along, so that every reader of the documents reads one and the same shuffle
    return by_key.join(asked, KEY).select(*KEY, "text", "ps", "doc_id").mapInArrow(batches, SENT)


def _spread(lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the run, value) for every value lo .. lo + n - 1 of every run."""
    which = np.repeat(np.arange(len(lo)), n)
    return which, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[which]


def block_rows(length: int):
    """Step 3: the blocks of open runs."""

    def rows_of(data, starts, offs, afters):
        # offsets from the anchor fall from offs to offs - afters along a run; block k holds
        # the offsets k * STRINGS .. k * STRINGS + STRINGS - 1
        low = (offs - afters) // STRINGS
        which, k = _spread(low, offs // STRINGS - low + 1)
        anchor, first, last = (starts + offs)[which], starts[which], (starts + afters)[which]
        lo = np.maximum(first, anchor - k * STRINGS - STRINGS + 1)
        hi = np.minimum(last, anchor - k * STRINGS)
        one, two = (Hashes(data, b) for b in BASES)
        common = anchor - k * STRINGS
        h = _mixed(one.of(common, common + length - STRINGS + 1))
        place = (anchor - lo) * 128 + (hi - lo)
        c = _mixed(two.of(lo, hi + length) + place.astype(np.uint64) * np.uint64(MIXERS[0])) | np.uint64(1)
        yield h, c, _packed(lo, 0, hi - lo)

    return rows_of


def string_rows(length: int):
    """Step 4: the single strings of open blocks."""

    def rows_of(data, starts, offs, afters):
        j = np.unique(_spread(starts, afters + 1)[1])
        one, two = (Hashes(data, b) for b in BASES)
        yield _mixed(one.of(j, j + length)), _mixed(two.of(j, j + length)) | np.uint64(1), _packed(j, 0, 0)

    return rows_of


def repeated_runs(base: DataFrame, by_key: DataFrame, length: int = 100, q: int = 24) -> DataFrame:
    """(key, p) packed runs of strings that start earlier somewhere else.

    ``base``: the documents as ``keyed``; ``by_key``: the same dealt by key, so that all steps read one shuffle of texts.
    """
    if not STRINGS < length - q:
        raise ValueError(f"length must exceed q by more than {STRINGS}")
    runs = cut(refined(bucketed(base, length, q)))
    parts = refined(_of_open(by_key, runs, block_rows(length)))
    single = refined(_of_open(by_key, parts, string_rows(length)))
    out = runs.filter("settled")
    for level in (parts, single):
        out = out.unionByName(level.filter("settled"))
    return out.select(*KEY, "p")


def removed_spans(docs: DataFrame, length: int = 100, q: int = 24) -> DataFrame:
    """Every document (key, doc_id, text) with its repeated runs ps (null: none)."""
    base = keyed(docs).drop("rest")
    by_key = base.repartition(width(docs), *KEY)  # keys are of one text each, so no key is hot
    runs = repeated_runs(base, by_key, length, q).groupBy(*KEY).agg(F.collect_list("p").alias("ps"))
    return by_key.join(runs, KEY, "left")


def merged(ps: np.ndarray | None, size: int, length: int) -> list[tuple[int, int]]:
    """Maximal removed (start, stop) ranges of one text."""
    if ps is None or not len(ps):
        return []
    starts, _, after = _unpacked(np.asarray(ps))
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(np.minimum((starts + after + length)[order], size))
    gap = np.flatnonzero(starts[1:] > stops[:-1])
    return list(zip(starts[np.concatenate(([0], gap + 1))].tolist(), stops[np.concatenate((gap, [len(stops) - 1]))].tolist()))


def dedup(docs: DataFrame, length: int = 100, q: int = 24) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (the removed byte ranges)."""

    def batches(it):
        for batch in it:
            out = []
            for text, ps in zip(batch.column(1), batch.column(2)):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                spans = merged(None if not ps.is_valid else ps.values.to_numpy(), len(raw), length)
                digest, at = hashlib.sha256(), 0
                for a, b in [*spans, (len(raw), len(raw))]:
                    digest.update(raw[at:a])
                    at = b
                out.append((len(raw), sum(b - a for a, b in spans), len(spans), digest.hexdigest(), [{"start": a, "stop": b} for a, b in spans]))
            n, removed, count, sha, spans = zip(*out) if out else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(sha, pa.string()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    return removed_spans(docs, length, q).select("doc_id", "text", "ps").mapInArrow(
        batches, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:bigint,stop:bigint>>"
    )
