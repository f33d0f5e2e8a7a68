"""Phrase collocations: best-first branch-and-bound growth of frequent word sequences.

Texts are split into pieces and words; everything is counted per language. Candidates are phrases of
two to four words with ``least`` occurrences or more. A cut of a candidate scores
``floor(2000000 a / (l + r))``, its worst cut counts; a candidate goes if a longer one that contains it
has 80% of its occurrences. Each language's best ``top`` that stay are returned.

Growth. Pairs of frequent words are counted first. Let p be any prefix of a phrase q with first
word w: f(q) <= f(p), and the right part of q's first cut occurs f(q) times or more, so

    score(q) <= floor(2000000 f(p) / (f(w) + f(p))) = bound(p),

and bound(q) <= bound(p). Phrases whose neighbours have not been counted yet are the frontier. A round
takes the frontier's ``per_round`` best bounds and counts, in one pass over the texts, each of their
extensions by a word on either side: those on the right are the next phrases, and both decide
whether the phrase stays. (If a longer candidate has 80% of a phrase's occurrences, so has one
with a single further word, since it occurs at least as often.) Then each language's
``top``-th best score that stays is a threshold that can only rise; a frontier phrase with a bound below it
can never matter, one that equals it still can. A four-word phrase may need the count of its last three
words, which no frontier phrase has led to; the next round counts it. The loop ends when nothing at or above the
thresholds is open, so the result does not depend on ``per_round``.

What tasks are sent is bounded: a bitmap of fixed size of the hashes of frequent words
(a rare word cannot be part of a candidate; a wrong hit costs time only) and ``per_round`` phrases.
Counts are summed inside a task before the shuffle, in tables of bounded size; long
texts are taken in chunks that overlap by three words.

Defined results: a null text is empty; a null language counts as ``und``; an empty text has no words;
repeated rows count again; ties go by occurrences, then by the phrase's bytes; languages
without candidates have no row; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import cut

#: Bytes that end a piece become ".", a tab becomes a blank, A-Z become lower case.
TABLE = bytes(46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Text bytes counted at once.
CHUNK = 2 << 20
#: Distinct words and codes that a task holds, over all languages, before it sends the counts of the largest.
WORDS_HELD = 400_000
CODES_HELD = 1_200_000
#: Rows of one batch that is sent.
SENT = 100_000
#: Bits of the bitmap of frequent words.
BITS = 1 << 23
LONGEST = 4
END = 0  # number of whatever stands between pieces

COUNTED = "lang string, kind int, phrase binary, f long"


def _chunks(texts, size: int = CHUNK):
    """Text of about ``size`` bytes at once, as words between blanks; "." stands between pieces and texts."""
    held, n = [], 0
    for raw in texts:
        data = raw.translate(TABLE)
        at = 0
        while len(data) - at > size:
            stop = data.find(b" ", at + size)
            if stop < 0:
                break
            held.append(data[at:stop])
            yield b"".join(held).replace(b".", b" . ").strip()
            held, n, at = [], 0, stop
        held.append(data[at:] + b".")
        n += len(data) - at
        if n > size:
            yield b"".join(held).replace(b".", b" . ").strip()
            held, n = [], 0
    if held:
        yield b"".join(held).replace(b".", b" . ").strip()


def hashes(words: pa.Array, seed: int) -> np.ndarray:
    """A 64-bit hash of each word, byte by byte over all words at once."""
    n = len(words)
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int64, count=n + 1, offset=8 * words.offset) if n else np.zeros(1, np.int64)
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8) if n and words.buffers()[2] is not None else np.zeros(0, np.uint8)
    start, size = offsets[:-1], np.diff(offsets)
    h = np.full(n, (seed ^ 0xCBF29CE484222325) & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    order = np.argsort(-size, kind="stable")  # the words still longer than i come first
    longer = np.searchsorted(-size[order], -np.arange(size.max(initial=0)), side="left")
    for i, m in enumerate(longer.tolist()):
        live = order[:m]
        h[live] = (h[live] ^ data[start[live] + i]) * np.uint64(0x100000001B3)
    h ^= h >> np.uint64(32)
    return (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(1)


def lang_seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 42)


class Tally:
    """Sorted codes with counts, merged as they come."""

    def __init__(self):
        self.codes, self.counts, self.waiting, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add(self, codes: np.ndarray) -> None:
        if len(codes):
            self.waiting.append(np.unique(codes, return_counts=True))
            self.size += len(self.waiting[-1][0])
            if self.size > CODES_HELD // 2:
                self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        codes = np.concatenate([self.codes, *(c for c, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(n for _, n in self.waiting)])
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
        self.codes, self.counts = codes[first], np.add.reduceat(counts, first)
        self.waiting, self.size = [], 0


class Words:
    """Numbers of words, from 1; words that ``known`` (a bitmap of hashes) does not hold are END."""

    def __init__(self, lang: str, known: np.ndarray | None = None):
        self.seed, self.known, self.number, self.words = lang_seed(lang), known, {b".": END}, [b"."]

    def of(self, word: bytes) -> int:
        n = self.number.get(word)
        if n is None:
            n = self.number[word] = len(self.words)
            self.words.append(word)
        return n

    def numbers(self, text: bytes) -> np.ndarray:
        """Numbers of the words of a chunk, in order."""
        if not text:
            return np.zeros(0, np.int64)
        words = pc.ascii_split_whitespace(pa.array([text], pa.large_binary()).view(pa.large_string())).flatten()
        coded = words.dictionary_encode()
        distinct, table = coded.dictionary.view(pa.large_binary()), np.zeros(len(coded.dictionary), dtype=np.int64)
        kept = np.arange(len(table))
        if self.known is not None:
            bit = hashes(distinct, self.seed) & np.uint64(BITS - 1)
            kept = np.flatnonzero(self.known[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
        get, new = self.number.get, self.of
        table[kept] = [n if (n := get(w)) is not None else new(w) for w in distinct.take(pa.array(kept)).to_pylist()]
        return table[coded.indices.to_numpy()]


class Trie:
    """Phrases (a tuple of words, expand or not) as sorted (node, word) codes of each length."""

    def __init__(self, words: Words, phrases: list[tuple[bytes, bool]]):
        self.phrases = [p for p, _ in phrases]
        steps: list[dict] = [{} for _ in range(LONGEST)]
        whole: dict[int, tuple[int, bool]] = {}
        nodes = 0
        for i, (phrase, expand) in enumerate(phrases):
            node = 0
            for k, w in enumerate(phrase.split(b" ")):
                key = (node, words.of(w))
                node = steps[k].get(key)
                if node is None:
                    nodes += 1
                    node = steps[k][key] = nodes
            whole[node] = (i, expand)
        self.steps = []
        for step in steps:
            codes = np.array([a << 32 | b for a, b in step], dtype=np.int64)
            order = np.argsort(codes)
            self.steps.append((codes[order], np.array(list(step.values()), dtype=np.int64)[order]))
        # a word's node at the start of a phrase, and whether it stands second in one
        self.first, self.second = (np.zeros(len(words.words), dtype=k) for k in (np.int64, bool))
        for (_, word), node in steps[0].items():
            self.first[word] = node
        for _, word in steps[1]:
            self.second[word] = True
        self.which = np.full(nodes + 1, -1, dtype=np.int64)
        self.expand = np.zeros(nodes + 1, dtype=bool)
        for node, (i, expand) in whole.items():
            self.which[node], self.expand[node] = i, expand
        self.singles = any(b" " not in p for p in self.phrases)

    def found(self, ids: np.ndarray):
        """(length, start, phrase, expand) arrays of all places where a phrase stands."""
        low = np.where(ids < len(self.first), ids, END)  # later words are in no phrase
        node, follows = self.first[low], self.second[low]
        if self.singles:
            at = np.flatnonzero(self.which[node] >= 0)
            yield 1, at, self.which[node[at]], self.expand[node[at]]
        at = np.flatnonzero((node[:-1] > 0) & follows[1:])
        node = node[at]
        for k, (codes, nodes) in enumerate(self.steps[1:], 1):
            inside = at + k < len(ids)
            at, node = at[inside], node[inside]
            if not len(at) or not len(codes):
                return
            own = node << 32 | ids[at + k]
            place = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
            hit = codes[place] == own
            at, node = at[hit], nodes[place[hit]]
            here = self.which[node] >= 0
            yield k + 1, at[here], self.which[node[here]], self.expand[node[here]]


def _rows(lang: str, kind: int, counts: np.ndarray, phrases):
    """Batches of COUNTED; ``phrases(a, b)`` are those of the counts a .. b."""
    for a in range(0, len(counts), SENT):
        part = counts[a : a + SENT]
        columns = [pa.repeat(pa.scalar(lang), len(part)), pa.repeat(pa.scalar(kind, pa.int32()), len(part)), phrases(a, a + len(part)), pa.array(part, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "kind", "phrase", "f"])


def _joined(left: pa.Array, right: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(left, right, pa.scalar(b" ", pa.binary()))


class Singles:
    """Counts of words (kind 1) and of all of them together (kind 0)."""

    given = 1  # words that are there from the start
    last = ()  # numbers of the words that the next chunk follows

    def __init__(self, lang: str):
        self.lang, self.words, self.total, self.counts = lang, Words(lang), 0, np.zeros(0, np.int64)

    def add(self, text: bytes) -> None:
        ids = self.words.numbers(text)
        more = np.bincount(ids, minlength=len(self.words.words))
        more[: len(self.counts)] += self.counts
        self.counts = more
        self.total += int((ids != END).sum())

    def codes(self) -> int:
        return 0

    def rows(self):
        yield from _rows(self.lang, 0, np.array([self.total]), lambda a, b: pa.array([None], pa.binary()))
        words = pa.array(self.words.words[1:], pa.binary())
        yield from _rows(self.lang, 1, self.counts[1:], lambda a, b: words[a:b])


class Pairs:
    """Counts of pairs of frequent words (kind 2)."""

    given = 1

    def __init__(self, lang: str, known: np.ndarray):
        self.lang, self.words, self.tally, self.last = lang, Words(lang, known), Tally(), np.zeros(0, np.int64)

    def add(self, text: bytes) -> None:
        ids = np.concatenate((self.last, self.words.numbers(text)))
        a, b = ids[:-1], ids[1:]
        inside = (a != END) & (b != END)
        self.tally.add(a[inside] << 32 | b[inside])
        self.last = ids[-1:]

    def codes(self) -> int:
        return len(self.tally.codes) + self.tally.size

    def rows(self):
        self.tally.merge()
        words, codes = pa.array(self.words.words, pa.binary()), self.tally.codes
        phrases = lambda a, b: _joined(words.take(pa.array(codes[a:b] >> 32)), words.take(pa.array(codes[a:b] & 0xFFFFFFFF)))
        yield from _rows(self.lang, 2, self.tally.counts, phrases)


class Extensions:
    """Counts of phrases asked for (kind 3) and of extensions by a word on the right (4) or left (5)."""

    def __init__(self, lang: str, known: np.ndarray, phrases: list):
        self.lang, self.known, self.asked, self.last = lang, known, phrases, np.zeros(0, np.int64)
        self.words = Words(lang, known)
        self.trie = Trie(self.words, phrases)
        self.given = len(self.words.words)
        self.right, self.left, self.exact = Tally(), Tally(), np.zeros(len(phrases), np.int64)

    def add(self, text: bytes) -> None:
        if not self.asked:
            return
        old = len(self.last)  # what ends before this place was counted with the last chunk
        ids = np.concatenate((self.last, self.words.numbers(text)))
        for k, start, phrase, expand in self.trie.found(ids):
            new = start + k - 1 >= old
            self.exact += np.bincount(phrase[new], minlength=len(self.asked))
            ok = expand & new & (start > 0)
            before = ids[start[ok] - 1]
            self.left.add((phrase[ok] << 32 | before)[before != END])
            ok = expand & (start + k >= old) & (start + k < len(ids))
            after = ids[start[ok] + k]
            self.right.add((phrase[ok] << 32 | after)[after != END])
        self.last = ids[-(LONGEST - 1) :]

    def codes(self) -> int:
        return len(self.right.codes) + self.right.size + len(self.left.codes) + self.left.size

    def rows(self):
        if not self.asked:
            return
        words, phrases = pa.array(self.words.words, pa.binary()), pa.array(self.trie.phrases, pa.binary())
        only = np.flatnonzero([not e for _, e in self.asked])
        yield from _rows(self.lang, 3, self.exact[only], lambda a, b: phrases.take(pa.array(only[a:b])))
        for kind, tally in ((4, self.right), (5, self.left)):
            tally.merge()

            def extended(a, b, codes=tally.codes, kind=kind):
                base, word = phrases.take(pa.array(codes[a:b] >> 32)), words.take(pa.array(codes[a:b] & 0xFFFFFFFF))
                return _joined(base, word) if kind == 4 else _joined(word, base)

            yield from _rows(self.lang, kind, tally.counts, extended)


def counted(docs: DataFrame, start, least: int) -> DataFrame:
    """(lang, kind, phrase, f) over all documents, by the counters that ``start(lang)`` makes."""

    def batches(it):
        counters: dict = {}
        held = {}  # language: codes and words
        for batch in it:
            langs = batch.column(0).dictionary_encode()
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                texts = (t.as_py() for t in batch.column(1).filter(pc.equal(langs.indices, i)))
                for chunk in _chunks(texts):
                    counter = counters.get(lang)
                    if counter is None:
                        counter = counters[lang] = start(lang)
                    counter.add(chunk)
                    held[lang] = counter.codes(), len(counter.words.words) - counter.given
                    while sum(c for c, _ in held.values()) > CODES_HELD or sum(w for _, w in held.values()) > WORDS_HELD:
                        which = max(held, key=lambda x: held[x][0] / CODES_HELD + held[x][1] / WORDS_HELD)
                        old, fresh = counters.pop(which), start(which)
                        del held[which]
                        yield from old.rows()
                        # a chunk may end inside a text: the last words stay
                        fresh.last = np.array([fresh.words.of(old.words.words[k]) for k in old.last], dtype=np.int64)
                        if which == lang:
                            counters[which] = fresh
        for counter in counters.values():
            yield from counter.rows()

    base = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    sums = base.mapInArrow(batches, COUNTED).groupBy("lang", "kind", "phrase").agg(F.sum("f").alias("f"))
    return sums.filter((F.col("f") >= least) | (F.col("kind") == 0)).withColumn("phrase", F.col("phrase").cast("string"))


def bitmap(words: DataFrame) -> np.ndarray:
    """Bits of the hashes of the words (lang, phrase), BITS in all whatever their number."""

    def batches(it):
        for batch in it:
            langs, own = batch.column(0).dictionary_encode(), batch.column(1).cast(pa.large_binary())
            bits = np.zeros(len(own), dtype=np.int64)
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                mine = np.flatnonzero(langs.indices.to_numpy() == i)
                bits[mine] = (hashes(own.take(pa.array(mine)), lang_seed(lang)) & np.uint64(BITS - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bits >> 15), pa.array(bits & 32767)], ["b", "p"])

    hashed = words.select("lang", F.col("phrase").cast("binary").alias("phrase")).mapInArrow(batches, "b long, p long")
    # a bucket holds 4096 bytes, so there are BITS / 32768 rows at most
    rows = hashed.groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect()
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for r in rows:
        out[r["b"] * 4096 : r["b"] * 4096 + 4096] = np.frombuffer(bytes(r["m"]), dtype=np.uint8)
    return out


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def _ratio(a: Column, total: Column) -> Column:
    """floor(2000000 a / total); exact beyond 64 bits."""
    return F.expr(f"(CAST(2000000 AS DECIMAL(10,0)) * CAST({a} AS DECIMAL(20,0))) DIV ({total})")


def scored(grams: DataFrame, parts: DataFrame) -> DataFrame:
    """lang, phrase, m, a, l, r, score (of the worst cut), bound, and missing: a part not counted yet.

    While a part is missing, the score is an upper bound: the part counts as often as the phrase.
    """
    words = F.split("phrase", " ")
    split = grams.select("lang", "phrase", F.col("f").alias("a"), words.alias("w")).select("*", F.size("w").alias("m"))
    cuts = split.select("*", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")).select(
        "lang", "phrase", "a", "m", "k", _part(F.col("w"), F.lit(1), F.col("k")).alias("x"), _part(F.col("w"), F.col("k") + 1, F.col("m") - F.col("k")).alias("y")
    )
    side = lambda c, n: parts.select("lang", F.col("phrase").alias(c), F.col("f").alias(n))
    cuts = cuts.join(side("x", "l"), ["lang", "x"], "left").join(side("y", "r"), ["lang", "y"], "left")
    cuts = cuts.withColumn("missing", F.when(F.col("l").isNull(), F.col("x")).when(F.col("r").isNull(), F.col("y")))
    total = "CAST(coalesce(l, a) AS DECIMAL(20,0)) + CAST(coalesce(r, a) AS DECIMAL(20,0))"
    cuts = cuts.withColumn("score", _ratio("a", total))
    first = F.expr("CASE WHEN k = 1 THEN (CAST(2000000 AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0))) DIV (CAST(l AS DECIMAL(20,0)) + CAST(a AS DECIMAL(20,0))) END")
    return cuts.groupBy("lang", "phrase", "m", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("worst"), F.max(first).alias("bound"), F.max("missing").alias("missing")
    ).select("lang", "phrase", "m", "a", "worst.l", "worst.r", "worst.score", "bound", "missing")


def _best(df: DataFrame, n: int) -> DataFrame:
    """Each language's first ``n`` rows by score, occurrences and phrase, with their rank.

    Ranked within shares of a language first, so that no task sees all rows of one.
    """
    by = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    few = df.withColumn("share", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*by)))
    few = few.filter(F.col("rank") <= n).drop("share", "rank")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).filter(F.col("rank") <= n)


def _staying(known: DataFrame, grams: DataFrame, done: DataFrame) -> DataFrame:
    """``known`` with ``settled`` (all that decides on the phrase is counted) and ``gone``."""
    words = F.split("phrase", " ")
    m = F.size(words)
    longer = grams.select("lang", F.col("f"), words.alias("w"), m.alias("n")).filter("n > 2")
    inner = longer.select("lang", "f", F.explode(F.array(_part(F.col("w"), F.lit(1), F.col("n") - 1), _part(F.col("w"), F.lit(2), F.col("n") - 1))).alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    out = known.join(most, ["lang", "phrase"], "left").join(done.withColumn("done", F.lit(True)), ["lang", "phrase"], "left")
    gone = F.coalesce(F.expr("CAST(100 AS DECIMAL(10,0)) * CAST(most AS DECIMAL(20,0)) >= CAST(80 AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0))"), F.lit(False))
    expanded = F.coalesce("done", F.lit(False))
    return out.select(*known.columns, gone.alias("gone"), expanded.alias("expanded"), ((expanded | (F.col("m") == LONGEST)) & F.col("missing").isNull()).alias("settled"))


RESULT = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, top: int = 2000, least: int = 30, per_round: int = 50_000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best ``top`` phrases."""
    spark = docs.sparkSession
    singles = cut(counted(docs, Singles, least))
    words = singles.filter("kind = 1").select("lang", "phrase", "f")
    known_words = spark.sparkContext.broadcast(bitmap(words))
    grams = cut(counted(docs, lambda lang: Pairs(lang, known_words.value), least).select("lang", "phrase", "f"))
    scores = cut(scored(grams, words))
    done = spark.createDataFrame([], "lang string, phrase string")
    while True:
        state = cut(_staying(scores, grams, done))
        good = _best(state.filter("settled AND NOT gone"), top)
        levels = good.filter(F.col("rank") == top).select("lang", F.col("score").alias("level"))
        open_ = state.join(levels, "lang", "left").withColumn("level", F.coalesce("level", F.lit(0)))
        grow = open_.filter((F.col("m") < LONGEST) & ~F.col("expanded") & (F.col("bound") >= F.col("level")))
        ask = open_.filter(F.col("missing").isNotNull() & (F.col("score") >= F.col("level")))
        wanted = grow.select("lang", "phrase", "bound", F.lit(True).alias("expand")).unionByName(
            ask.groupBy("lang", F.col("missing").alias("phrase")).agg(F.max("score").alias("bound")).withColumn("expand", F.lit(False))
        )
        # the best of the frontier: per_round rows at most reach the driver and the tasks
        best = wanted.orderBy(F.desc("bound"), "lang", "phrase", "expand").limit(per_round).collect()
        if not best:
            break
        phrases: dict = {}
        for r in best:
            mine = phrases.setdefault(r["lang"], {})
            mine[r["phrase"].encode()] = mine.get(r["phrase"].encode(), False) or r["expand"]
        sent = spark.sparkContext.broadcast({lang: sorted(p.items()) for lang, p in phrases.items()})
        fresh = cut(counted(docs, lambda lang, sent=sent: Extensions(lang, known_words.value, sent.value.get(lang, [])), least))
        done = cut(done.unionByName(spark.createDataFrame([(r["lang"], r["phrase"]) for r in best if r["expand"]], "lang string, phrase string")))
        # an extension counted from both sides has the same count twice; part of a candidate, a phrase
        # asked for is a candidate as well
        found = fresh.filter(F.col("kind") >= 3).groupBy("lang", "phrase").agg(F.max("f").alias("f"))
        grams = cut(grams.unionByName(found.join(grams, ["lang", "phrase"], "left_anti")))
        parts = words.unionByName(grams)
        again = grams.join(scores.filter("missing IS NULL"), ["lang", "phrase"], "left_anti")
        scores = cut(scores.filter("missing IS NULL").unionByName(scored(again, parts)))
    totals = singles.filter("kind = 0").select("lang", F.col("f").alias("n"))
    return good.join(totals, "lang").select(*(F.col(c) if c in ("lang", "phrase", "rank") else F.col(c).cast("long").alias(c) for c in RESULT))
