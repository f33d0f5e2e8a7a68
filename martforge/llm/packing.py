"""Packing of tokenised documents into sequences by swap-based local search.

Tokenising: byte-level BPE with the ids of a ``tokenizers`` JSON file, then one
end id. The pair ranks are read out of that file, and tiktoken applies them (equal
ids, a quarter of the time; the tests compare both). Documents longer than a
sequence are cut into full pieces, the first piece being the shorter one.

Packing: full pieces are sequences of their own. The rest are dealt by a hash into
groups of bounded size, and each group is packed in one task: best-fit decreasing (and, from
a second start, best single or pair) first, then local search over the underfull bins. A step
moves one document, or exchanges one for one or two for one between two bins, or moves all of a
bin, and is taken only if it increases the sum of squared fills; bins so run empty and go. The search ends
where no such step is left. The bins that are
still underfull are dissolved and packed again over fewer, mixed groups, until they fit one group
or packing them again saves no sequence.

Defined results: null texts are empty ones; an empty text is its end id alone; rows
are packed as they come, so repeated rows are packed repeatedly; an empty table
gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import cut, texts

END_ID = 2
#: Splitting pattern of the byte-level BPE (a fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of_char() -> dict[str, int]:
    """Byte-level BPE writes each byte as one printable character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """tiktoken encoding with the ids of a byte-level BPE ``tokenizers`` file."""
    import tiktoken

    with open(path, encoding="utf-8") as f:  # a vocabulary file installed on every machine
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    back = _byte_of_char()
    ranks = {bytes(back[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("llm", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


#: What \s matches in the pattern (Unicode white space, a fixed set).
WHITE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Longer runs of white space are cut out before the pattern is applied: its look-ahead needs a stack as deep as a run is long.
LONG_RUN = 10_000
_LONG = re.compile(f"{WHITE}{{{LONG_RUN},}}")


def token_ids(encoding, text: str) -> list[int]:
    """Ids of a text without an end id, for runs of white space of any length.

    The pattern makes one token group of a run but for its last character, which belongs to what
    follows, and of all of it at the end of the text. So a text may be cut before a
    run and before its last character without a change of ids.
    """
    encode = encoding.encode
    if len(text) < LONG_RUN:
        return encode(text, allowed_special="all")
    out, at = [], 0
    for run in _LONG.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        out.extend(encode(text[at : run.start()], allowed_special="all"))
        out.extend(encoding._core_bpe.encode_single_piece(text[run.start() : stop].encode()))
        at = stop
    out.extend(encode(text[at:], allowed_special="all"))
    return out


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece."""
    base = texts(docs)
    kind = base.schema["doc_id"].dataType.simpleString()

    def batches(it):
        encoding = encoder(tokenizer)
        for batch in it:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.array([*token_ids(encoding, text.as_py()), end_id], dtype="<u4")
                first = len(ids) % capacity or capacity
                at = 0
                for k, to in enumerate(range(first, len(ids) + 1, capacity)):
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(to - at)
                    crc.append(zlib.crc32(ids[at:to].tobytes()))
                    at = to
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return base.mapInArrow(batches, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: bins as lists of item numbers."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)  # room left -> bins
    rooms = 0  # bit r is set if some bin has room r
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[item]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(item)
        if room > size:
            by_room[room - size].append(b)
            rooms |= 1 << (room - size)
    return bins


class Cheapest:
    """For each total of tokens, the two emptiest bins that can give that total away."""

    def __init__(self, capacity: int, bins: list[dict], fill: list[int], totals):
        self.bins, self.fill, self.totals = bins, fill, totals
        self.heaps: list[list] = [[] for _ in range(capacity + 1)]
        self.first, self.second = (np.full(capacity + 1, 1 << 40, dtype=np.int64) for _ in range(2))
        self.bin = np.full(capacity + 1, -1, dtype=np.int64)
        self.stale: set[int] = set()

    def changed(self, b: int) -> None:
        """Bin ``b`` has new contents; entries of its old ones are dropped when they come up."""
        for total in self.totals(self.bins[b]):
            heapq.heappush(self.heaps[total], (self.fill[b], b))
            self.stale.add(total)

    def lost(self, totals) -> None:
        self.stale.update(totals)

    def refresh(self) -> None:
        for total in self.stale:
            heap, found = self.heaps[total], []
            while heap and len(found) < 2:
                entry = heapq.heappop(heap)
                if entry[0] == self.fill[entry[1]] and entry not in found and total in self.totals(self.bins[entry[1]]):
                    found.append(entry)
            for entry in found:
                heapq.heappush(heap, entry)
            self.first[total], self.bin[total] = found[0] if found else (1 << 40, -1)
            self.second[total] = found[1][0] if len(found) > 1 else 1 << 40
        self.stale.clear()

    def without(self, b: int) -> np.ndarray:
        """Fill of the emptiest bin other than ``b`` for each total."""
        return np.where(self.bin == b, self.second, self.first)

    def giver(self, total: int, b: int) -> int:
        """The emptiest bin other than ``b`` that can give ``total``."""
        if self.bin[total] != b:
            return int(self.bin[total])
        top = heapq.heappop(self.heaps[total])
        while self.heaps[total]:
            entry = self.heaps[total][0]
            if entry[1] != b and entry[0] == self.fill[entry[1]] and total in self.totals(self.bins[entry[1]]):
                break
            heapq.heappop(self.heaps[total])
        out = self.heaps[total][0][1]
        heapq.heappush(self.heaps[total], top)
        return out


def _singles(held: dict) -> set[int]:
    return set(held)


def _pairs(held: dict) -> set[int]:
    """Totals of two documents of a bin; ``held`` maps sizes to documents."""
    sizes = sorted(held)
    out = {2 * s for s in sizes if len(held[s]) > 1}
    out.update(sizes[x] + sizes[y] for x in range(len(sizes)) for y in range(x))
    return out


def _two(held: dict, total: int) -> tuple[int, int]:
    """Sizes of two documents of a bin with this total."""
    return next((s, total - s) for s in held if total - s in held and (s != total - s or len(held[s]) > 1))


def _largest_gain(base: np.ndarray, room: int, fill: int, cheapest: np.ndarray) -> tuple[int, int]:
    """(d, base) of the largest d <= room so that a bin gives base + d and squared fills rise; (0, 0) if none.

    With d more tokens here and d fewer there the sum of squares rises if d exceeds what the other bin holds more.
    """
    d = np.arange(1, room + 1)
    total = base[:, None] + d[None, :]
    inside = total < len(cheapest)
    good = inside & (cheapest[np.where(inside, total, 0)] < fill + d[None, :])
    columns = np.flatnonzero(good.any(0))
    if not len(columns):
        return 0, 0
    k = int(columns[-1])
    return k + 1, int(base[int(np.flatnonzero(good[:, k])[0])])


def local_search(sizes: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Moves and exchanges between underfull bins until none increases the sum of squared fills.

    A bin B of room r gains d <= r tokens if a document of another bin A that is larger by d than nothing,
    one or two documents of B takes their place (a move, one for one, one for two), or two documents
    of A that of one document of B. Looked up by total, largest d first. Full bins can take no part:
    they have no room, and what they could give never exceeds the room it fills.
    Bins without documents are dropped.
    """
    held: list[dict] = []
    for b in bins:
        held.append(own := {})
        for i in sorted(b):
            own.setdefault(sizes[i], []).append(i)
    fill = [sum(sizes[i] for i in b) for b in bins]
    ones, twos = (Cheapest(capacity, held, fill, totals) for totals in (_singles, _pairs))
    open_bins = [b for b in range(len(bins)) if 0 < fill[b] < capacity]
    for b in open_bins:
        ones.changed(b)
        twos.changed(b)

    def swap(a: int, b: int, give: tuple, take: tuple) -> None:
        """Documents of sizes ``give`` go from A to B, those of ``take`` from B to A."""
        for table in (ones, twos):
            for x in (a, b):
                table.lost(table.totals(held[x]))
        moved = [(s, held[a][s].pop(), b) for s in give] + [(s, held[b][s].pop(), a) for s in take]
        for s, i, to in moved:
            held[to].setdefault(s, []).append(i)
        for x in (a, b):
            for s in [s for s, items in held[x].items() if not items]:
                del held[x][s]
        d = sum(give) - sum(take)
        fill[a], fill[b] = fill[a] - d, fill[b] + d
        for x in (a, b):
            if 0 < fill[x] < capacity:
                ones.changed(x)
                twos.changed(x)

    def improved(b: int) -> bool:
        room = capacity - fill[b]
        ones.refresh()
        one, two = np.array(sorted(held[b]), dtype=np.int64), np.array(sorted(_pairs(held[b])), dtype=np.int64)
        best = _largest_gain(np.concatenate(([0], one, two)), room, fill[b], ones.without(b))
        if best[0] < room:
            twos.refresh()
            other = _largest_gain(one, room, fill[b], twos.without(b))
            if other[0] > best[0]:
                d, base = other
                a = twos.giver(base + d, b)
                swap(a, b, _two(held[a], base + d), (base,))
                return True
        d, base = best
        if not d:
            return False
        take = () if not base else (base,) if base in held[b] else _two(held[b], base)
        swap(ones.giver(base + d, b), b, (base + d,), take)
        return True

    again = True
    while again:
        again = False
        for b in sorted(open_bins, key=lambda b: (-fill[b], b)):
            while 0 < fill[b] < capacity and improved(b):
                again = True
    return [[i for items in own.values() for i in items] for own in held if own]


def exact_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins filled one by one: the largest document left, then one or two that fill best.

    Of the totals that leave least room, a single document is preferred to a pair, and a
    pair with the larger first.
    """
    left: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in range(len(sizes) - 1, -1, -1):
        left[sizes[i]].append(i)
    present = sum(1 << s for s in range(capacity + 1) if left[s])
    mirrored = sum(1 << (capacity - s) for s in range(capacity + 1) if left[s])
    bins = []

    def take(s: int) -> int:
        nonlocal present, mirrored
        item = left[s].pop()
        if not left[s]:
            present &= ~(1 << s)
            mirrored &= ~(1 << (capacity - s))
        return item

    def filling(room: int) -> tuple[int, ...]:
        fits = present & ((2 << room) - 1)
        if not fits:
            return ()
        for total in range(room, 0, -1):
            if fits >> total & 1:
                return (total,)
            pairs = present & (mirrored >> (capacity - total)) & ((1 << total) - 1)  # a and total - a are there
            while pairs:
                a = pairs.bit_length() - 1
                if a != total - a or len(left[a]) > 1:
                    return a, total - a
                pairs &= ~(1 << a)
        return ()

    while present:
        s = present.bit_length() - 1
        bins.append([take(s)])
        room = capacity - s
        while room and (chosen := filling(room)):
            for s in chosen:
                bins[-1].append(take(s))
                room -= s
    return bins


def dissolve(sizes: list[int], bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Bins of small documents are emptied wherever the room of underfull bins takes all of them.

    Of the bins whose largest document fits the largest room, those of the smallest
    largest document are tried first; every success increases the squared fill by a whole bin.
    """
    fill = [sum(sizes[i] for i in b) for b in bins]
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = 0
    for b, f in enumerate(fill):
        if 0 < f < capacity:
            by_room[capacity - f].append(b)
            rooms |= 1 << (capacity - f)
    for victim in sorted((b for b in range(len(bins)) if bins[b]), key=lambda b: (max(sizes[i] for i in bins[b]), b)):
        if max(sizes[i] for i in bins[victim]) >= rooms.bit_length():
            break
        taken, own = [], capacity - fill[victim]
        for i in sorted(bins[victim], key=lambda i: (-sizes[i], i)):
            fits = rooms >> sizes[i]
            target, room = None, sizes[i]
            while fits and target is None:
                room += (fits & -fits).bit_length() - 1
                target = next((b for b in reversed(by_room[room]) if b != victim), None)
                fits = (rooms >> (room + 1)) if target is None else 0
                room += target is None
            if target is None:
                break
            by_room[room].remove(target)
            if not by_room[room]:
                rooms &= ~(1 << room)
            if room > sizes[i]:
                by_room[room - sizes[i]].append(target)
                rooms |= 1 << (room - sizes[i])
            taken.append((i, target, room))
        if len(taken) < len(bins[victim]):  # not all of them: undo
            for i, target, room in reversed(taken):
                if room > sizes[i]:
                    by_room[room - sizes[i]].remove(target)
                    if not by_room[room - sizes[i]]:
                        rooms &= ~(1 << (room - sizes[i]))
                by_room[room].append(target)
                rooms |= 1 << room
            continue
        for i, target, _ in taken:
            bins[target].append(i)
            fill[target] += sizes[i]
        if own:
            by_room[own].remove(victim)
            if not by_room[own]:
                rooms &= ~(1 << own)
        bins[victim], fill[victim] = [], 0
    return [b for b in bins if b]


def pack_group(sizes: list[int], capacity: int) -> list[list[int]]:
    """Local search from two first packings; the one that ends with fewer bins."""
    best = None
    for start in (best_fit, exact_fit):
        bins = start(sizes, capacity)
        while True:
            before = len(bins)
            bins = dissolve(sizes, local_search(sizes, bins, capacity), capacity)
            if len(bins) == before:
                break
        if best is None or len(bins) < len(best):
            best = bins
    return best


def _pack_level(items: DataFrame, level: int, groups: int, capacity: int) -> DataFrame:
    """Items with seq (unique within the level), place in it and the sequence's fill."""
    key = F.pmod(F.xxhash64(F.col("row"), F.lit(level)), F.lit(groups))
    schema = "row long, length long, seq long, offset long, fill long"

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame["g"].iloc[0])
        frame = frame.sort_values("row", kind="stable").reset_index(drop=True)
        sizes = frame["length"].tolist()
        seq, offset, fill = np.zeros(len(sizes), "i8"), np.zeros(len(sizes), "i8"), np.zeros(len(sizes), "i8")
        for n, members in enumerate(pack_group(sizes, capacity)):
            at = 0
            for i in members:
                seq[i], offset[i] = (group << 32) + n, at
                at += sizes[i]
            fill[members] = at
        return pd.DataFrame({"row": frame["row"], "length": frame["length"], "seq": seq, "offset": offset, "fill": fill})

    return items.select("row", "length", key.alias("g")).groupBy("g").applyInPandas(pack, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, group_rows: int = 32_768, end_id: int = END_ID) -> DataFrame:
    """Pieces with sequence_id and offset."""
    cutting = cut(pieces(docs, tokenizer, capacity, end_id).withColumn("row", F.monotonically_increasing_id()))
    whole = cutting.filter(F.col("length") == capacity).select(
        "row", F.col("row").alias("seq"), F.lit(0).cast("long").alias("offset"), F.lit(-1).alias("level")
    )
    rest = cutting.filter(F.col("length") < capacity).select("row", "length")
    placed = [whole]
    level, left, bins = 0, rest.count(), None
    while left:
        groups = -(-left // group_rows)
        now = cut(_pack_level(rest, level, groups, capacity))
        last = groups == 1
        done = now if last else now.filter(F.col("fill") == capacity)
        placed.append(done.select("row", "seq", "offset", F.lit(level).alias("level")))
        if last:
            break
        rest = now.filter(F.col("fill") < capacity).select("row", "length")
        made = now.filter("offset = 0").agg(F.count("*").alias("all"), F.count(F.when(F.col("fill") < capacity, 1)).alias("open")).first()
        if bins is not None and made["all"] >= bins:  # packing them again saved nothing: they stay as they are
            placed.append(now.filter(F.col("fill") < capacity).select("row", "seq", "offset", F.lit(level).alias("level")))
            break
        bins, left = made["open"], rest.count()
        level += 1
    at = placed[0]
    for more in placed[1:]:
        at = at.unionByName(more)
    # levels share sequence numbers, so the level goes into the top digits
    at = at.select("row", "offset", ((F.col("level") + 1).cast("long") * F.lit(1 << 56) + F.col("seq")).alias("sequence_id"))
    return cutting.join(at, "row").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
