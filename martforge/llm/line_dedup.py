"""Line dedup by a deletion-neighbourhood join.

Lines (split at newlines) are compared as sequences of lower-cased words. A line goes
if a line that comes earlier (smaller doc_id, or further up in the same document) has the
same words, or, for lines of ``min_words`` words or more, differs by one word inserted, deleted or
replaced. The earliest of equal lines stands for them in the comparison.

1. Equal lines meet by a 128-bit hash; the earliest stays.
2. A pair one edit apart agrees in all words of its front half or of its back half. Lines
   whose halves no other line has cannot have a partner and need no neighbourhood.
3. The others emit their deletion neighbourhood: the hash of the line without each of its words,
   and of the whole line. Lines meet at equal variants: both without the word at the
   same place (a replaced word), or one whole (an inserted word). A line keeps only
   its earliest partner per variant, never all pairs.
4. The edit distance of each line and partner is verified on their words.

Lines that repeat within one batch are settled there, before the shuffle, so a line with
very many copies or variants sends one row per batch. Texts are shuffled once, by document,
and that shuffle is read by each step that needs them.

Defined results: null texts are empty ones; blank lines always stay and are not compared;
a null id sorts first and stays null; rows of equal id and text count as one
document and come out repeated; texts that share an id count as documents ordered by a
128-bit hash of the text, and so do texts without an id; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import KEY, cut, keyed, sliced, width

#: A line: its document's key and its number there.
LINE = [*KEY, "p"]
LINE_KIND = "id long, t binary, p long"
LINE_ARROW = [pa.int64(), pa.binary(), pa.int64()]


def words_of(line: str) -> list[str]:
    return line.lower().split()


def _hash(data: str, seed: int = 0) -> int:
    """A signed long."""
    h = xxhash.xxh3_64_intdigest(data.encode("utf-8", "surrogatepass"), seed)
    return h - (1 << 64) if h >> 63 else h


def _columns(rows: list[tuple], kinds) -> list[pa.Array]:
    """Arrow columns of rows; none without rows."""
    return [pa.array(c, k) for c, k in zip(zip(*rows) if rows else ((),) * len(kinds), kinds)]


def _spread(at: tuple) -> int:
    """A key for a line that nothing is compared with."""
    return _hash(repr(at), 1)


def half_keys(words: list[str]) -> list[int]:
    """Keys of which two lines one edit apart share at least one.

    Halves of k words from either end, k being half the length; even lengths
    also give halves one word shorter, for partners of one word less.
    """
    n = len(words)
    out = []
    for k in {n // 2, (n - 1) // 2}:
        out.append(_hash(" ".join(words[:k]), 2 * k + 1))
        out.append(_hash(" ".join(words[n - k :]), 2 * k + 2))
    return out


def variants(words: list[str]) -> list[tuple[int, int]]:
    """(key, place): the line without the word at each place, and whole (place -1)."""
    out = [(_hash(" ".join(words)), -1)]
    parts = [w + " " for w in words]
    joined = "".join(parts)
    at = 0
    for i, part in enumerate(parts):
        rest = joined[:at] + joined[at + len(part) :]
        out.append((_hash(rest[:-1]), i))
        at += len(part)
    return out


def within_one_edit(a: list[str], b: list[str]) -> bool:
    """True if one inserted, deleted or replaced word, or none, makes the lines equal."""
    if abs(len(a) - len(b)) > 1:
        return False
    front = 0
    while front < min(len(a), len(b)) and a[front] == b[front]:
        front += 1
    back = 0
    while back < min(len(a), len(b)) - front and a[-1 - back] == b[-1 - back]:
        back += 1
    return max(len(a), len(b)) - front - back <= 1


def hashed_lines(docs: DataFrame, min_words: int = 8) -> DataFrame:
    """(a, b: hash of the words, line, keys: half keys). ``b = 0``: repeats an earlier line of its batch."""
    kinds = [pa.int64()] * 2 + LINE_ARROW + [pa.list_(pa.int64())]

    def batches(it):
        for batch in it:
            first: dict[bytes, tuple] = {}  # hash of the words: line, half keys
            out = []
            for *own, value in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2)):
                for n, line in enumerate(value.as_py().split("\n")):
                    words = words_of(line)
                    if not words:
                        continue
                    key = xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))
                    at = (*own, n)
                    before = first.get(key)
                    if before is None:
                        first[key] = (at, half_keys(words) if len(words) >= min_words else None)
                    elif at < before[0]:
                        out.append(before[0])
                        first[key] = (at, before[1])
                    elif at > before[0]:
                        out.append(at)
            rows = []
            for key, (at, half) in first.items():
                x, y = np.frombuffer(key, dtype="<i8").tolist()
                rows.append((x, y | 1, *at, half))
            rows.extend((_spread(at), 0, *at, None) for at in out)
            yield pa.RecordBatch.from_arrays(_columns(rows, kinds), ["a", "b", *LINE, "keys"])

    return docs.select(*KEY, "text").mapInArrow(batches, f"a long, b long, {LINE_KIND}, keys array<long>")


def candidates(firsts: DataFrame) -> DataFrame:
    """The first lines that share a half key with another one."""
    halves = firsts.filter("keys IS NOT NULL").select("a", *LINE, F.explode("keys").alias("k"))
    shared = halves.groupBy("k").agg(F.min("a").alias("x"), F.max("a").alias("y")).filter("x != y").select("k")
    return halves.join(shared, "k").select(*LINE).distinct()


def line_words(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted lines with their words joined."""
    asked = wanted.groupBy(*KEY).agg(F.collect_list("p").alias("ps"))  # of one text at most
    kinds = [*LINE_ARROW, pa.string()]

    def batches(it):
        for batch in sliced(it, 1000):
            rows = []
            for *own, value, places in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2), batch.column(3).to_pylist()):
                split = value.as_py().split("\n")
                rows.extend((*own, p, " ".join(words_of(split[p]))) for p in places)
            yield pa.RecordBatch.from_arrays(_columns(rows, kinds), [*LINE, "line"])

    # all columns go along, so that every reader of the documents reads one and the same shuffle;
    # dealt by line, so that the readers of the lines share one shuffle too
    found = docs.join(asked, KEY).select(*KEY, "text", "ps", "doc_id", "rest").mapInArrow(batches, f"{LINE_KIND}, line string")
    return found.repartition(width(docs), *LINE)


def neighbourhoods(lines: DataFrame) -> DataFrame:
    """(v: variant key, place, line) of every line.

    Place -2 marks a line already known to be one edit from an earlier line of its
    batch; of the lines of a batch with one variant, only the earliest is compared further.
    """
    kinds = [pa.int64(), pa.int32(), *LINE_ARROW]

    def batches(it):
        for batch in sliced(it, 4000):
            first: dict[tuple[int, int], tuple] = {}
            out = []
            for *at, line in sorted(set(zip(*(c.to_pylist() for c in batch.columns)))):  # in order, so what is there is earlier
                words, at = line.split(" "), tuple(at)
                settled = False
                for key, place in variants(words):
                    before = first.setdefault((key, place), (at, words))
                    if before[0] == at:
                        out.append((key, place, *at))
                    elif not settled and within_one_edit(words, before[1]):
                        settled = True
                if settled:
                    out.append((_spread(at), -2, *at))
            yield pa.RecordBatch.from_arrays(_columns(out, kinds), ["v", "place", *LINE])

    return lines.mapInArrow(batches, f"v long, place int, {LINE_KIND}")


def near_repeats(by_key: DataFrame, firsts: DataFrame) -> DataFrame:
    """First lines one edit from an earlier line."""
    wanted = cut(candidates(firsts))
    lines = line_words(by_key, wanted)
    met = neighbourhoods(lines)
    variant, same = Window.partitionBy("v"), Window.partitionBy("v", "place")
    at = F.struct(*LINE)
    partners = met.select(
        "place",
        at.alias("x"),
        F.min(at).over(same).alias("alike"),
        F.min(F.when(F.col("place") == -1, at)).over(variant).alias("whole"),
        F.min(F.when(F.col("place") >= 0, at)).over(variant).alias("shorter"),
    )
    settled = partners.filter("place = -2").select("x.*")
    other = [f"{c}_y" for c in LINE]
    pairs = (
        partners.filter("place != -2")
        .select("x", F.explode(F.array(F.when(F.col("place") >= 0, F.col("alike")), F.when(F.col("place") >= 0, F.col("whole")).otherwise(F.col("shorter")))).alias("y"))
        .filter("y < x")
        .distinct()
        .select("x.*", *[F.col("y")[c].alias(n) for c, n in zip(LINE, other)])
    )

    @F.pandas_udf("boolean")
    def verified(a, b):
        return a.combine(b, lambda x, y: within_one_edit(x.split(" "), y.split(" ")))

    partner = lines.select(*[F.col(c).alias(n) for c, n in zip(LINE, other)], F.col("line").alias("line_y"))
    good = pairs.join(lines, LINE).join(partner, other).filter(verified("line", "line_y"))
    return settled.unionByName(good.select(*LINE)).distinct()


def repeated_lines(base: DataFrame, by_key: DataFrame, min_words: int = 8) -> DataFrame:
    """Lines to remove; ``near`` if no earlier line is equal. ``base``: as ``keyed``; ``by_key``: the same, dealt by key."""
    earliest = Window.partitionBy("a", "b").orderBy(*LINE)
    ranked = cut(hashed_lines(base, min_words).withColumn("again", (F.col("b") == 0) | (F.rank().over(earliest) > 1)))
    firsts = ranked.filter("NOT again")
    equal = ranked.filter("again").select(*LINE, F.lit(False).alias("near"))
    return equal.unionByName(near_repeats(by_key, firsts).withColumn("near", F.lit(True)))


def dedup(docs: DataFrame, min_words: int = 8, carried: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text (without the removed lines), n_lines (not blank), n_equal and n_near (removed).

    ``carried`` names further columns of the documents to return.
    """
    base = keyed(docs, carried)
    by_key = base.repartition(width(docs), *KEY)  # keys are of one text each, so no key is hot
    gone = (
        repeated_lines(base, by_key, min_words)
        .groupBy(*KEY)
        .agg(F.collect_list(F.when(~F.col("near"), F.col("p"))).alias("equal"), F.collect_list(F.when(F.col("near"), F.col("p"))).alias("near"))
    )
    names = ["doc_id", "text", "n_lines", "n_equal", "n_near", "rest"]

    def batches(it):
        for batch in sliced(it, 1000):
            texts, counts, equals, nears = [], [], [], []
            for text, equal, near in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                lines, mine = text.split("\n"), (set(equal or ()), set(near or ()))
                drop = mine[0] | mine[1]
                counts.append(sum(1 for s in lines if s and not s.isspace()))
                texts.append("\n".join(s for n, s in enumerate(lines) if n not in drop) if drop else text)
                equals.append(len(mine[0]))
                nears.append(len(mine[1]))
            made = [pa.array(texts, pa.string()), *(pa.array(x, pa.int64()) for x in (counts, equals, nears))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made, batch.column(4)], names)

    kind = base.schema["rest"].dataType.simpleString()
    out = by_key.join(gone, KEY, "left").select("doc_id", "text", "equal", "near", "rest").mapInArrow(
        batches, f"doc_id long, text string, n_lines long, n_equal long, n_near long, rest {kind}"
    )
    return out.select(*names[:-1], *[F.col("rest")[c].alias(c) for c in carried])


def without_repeats(docs: DataFrame, min_words: int = 8) -> DataFrame:
    """The documents, in their own columns, without repeated lines.

    A document of which every line that is not blank is a repeat goes altogether.
    ``n_chars``, if there, counts the text that is left.
    """
    carried = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    inner = tuple(f"_carried_{c}" for c in carried)
    clean = dedup(docs.select("doc_id", "text", *[F.col(c).alias(n) for c, n in zip(carried, inner)]), min_words, inner)
    out = clean.filter("n_lines = 0 OR n_equal + n_near < n_lines")
    back = {c: F.col(n) for c, n in zip(carried, inner)} | {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("text")}
    if "n_chars" in carried:
        back["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*[back[c].alias(c) for c in docs.columns])
