"""Quality rules as a short-circuit cascade, ordered by rejection per cost.

Counts that several rules need are DataFrame expressions over the whole text. The
rules are conjunctive, so their order never changes a verdict. Their order is chosen from
a sample: each rule is run alone over the sampled documents, its time is its
cost and its share of rejected documents its selectivity, and rules are sorted by
rejections per second. The cascade is one nested condition, so a document stops at the
first rule that it fails.

Repeated words: a word counts if it lies in a window of eight words that occurs at least twice in
the text. Windows are compared by a hash that is built by doubling (pairs, fours,
eights), all inside one row. DataFrame functions only; no shuffle of texts.

Defined results: null and empty texts have zero counts and fail the base rule; fewer
than eight words have no window; repeated rows come out repeated; an empty table
gives an empty result, with the rules in their given order.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import cut

SPACE = " \t\n\x0b\f\r"
#: The same class as a pattern for split; texts are trimmed of it first.
SPACES = r"[ \t\n\x0B\f\r]+"
SYMBOLS = "#*$%&|<>"


def _count(text: Column, characters: str) -> Column:
    """Characters of a text that belong to a set."""
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _shifted(a: Column, by: int) -> Column:
    """Each value combined with the one ``by`` places later."""
    keep = F.greatest(F.size(a) - by, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), keep), F.slice(a, F.lit(by + 1), keep), lambda x, y: F.xxhash64(x, y))


def with_counts(docs: DataFrame) -> DataFrame:
    """doc_id, text and the counts that rules use.

    Arrays that several expressions read are columns of a stage of their own, so that
    each is computed once per row.
    """
    text = F.col("text")
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^ \t\n\x0B\f\r]"))
    staged = docs.select("doc_id", F.coalesce(text, F.lit("")).alias("text")).select(
        "doc_id", "text", words.alias("w"), lines.alias("lines")
    )
    counts = staged.select(
        "doc_id",
        "text",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.transform("w", lambda w: F.xxhash64(w)).alias("windows"),
    )
    kept = [c for c in counts.columns if c != "windows"]
    for by in (1, 2, 4):  # words, then pairs, then fours become eights
        counts = counts.select(*kept, _shifted(F.col("windows"), by).alias("windows"))
    pairs = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    places = counts.select(*kept, pairs.alias("pairs")).select(
        *kept, F.when(F.col("pairs").isNotNull(), _repeated_places(F.col("pairs"))).alias("places")
    )
    return places.select(
        *kept, F.coalesce(F.when(F.col("places").isNotNull(), _cover(F.col("places"))), F.lit(0)).cast("long").alias("n_repeat_words")
    )


def _repeated_places(pairs: Column) -> Column:
    """Places, in order, of the windows with an equal neighbour in the sorted pairs."""
    n = F.size(pairs)
    none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    near = F.arrays_zip(
        pairs.alias("p"), F.concat(none, F.slice(pairs, F.lit(1), n - 1)).alias("a"), F.concat(F.slice(pairs, F.lit(2), n - 1), none).alias("b")
    )
    twice = F.filter(near, lambda z: (z["p"]["h"] == z["a"]["h"]) | (z["p"]["h"] == z["b"]["h"]))
    return F.array_sort(F.transform(twice, lambda z: z["p"]["i"]))


def _cover(places: Column) -> Column:
    """Words in the union of eight-word windows that start at these places."""
    following = F.concat(F.slice(places, F.lit(2), F.size(places) - 1), F.array(F.lit(2**30)))
    return F.aggregate(F.zip_with(places, following, lambda x, y: F.least(y - x, F.lit(8))), F.lit(0), lambda s, x: s + x)


@dataclass(frozen=True)
class Rule:
    """A condition that a good document meets, over the counts and the text."""

    name: str
    passes: Column


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def default_rules() -> list[Rule]:
    text, words, chars, lines = F.col("text"), F.col("n_words"), F.col("word_chars"), F.col("n_lines")
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return [
        Rule("word_length", chars.between(words * 2, words * 14)),
        Rule("symbols", F.col("n_symbols") * 10 <= words),
        Rule("repeated_lines", F.col("n_dup_lines") * 100 <= lines * 50),
        Rule("capitals", _count(text, capitals) * 100 <= chars * 40),
        Rule("exclamations", _count(text, "!") * 10 <= words),
        Rule("digits", _count(text, "0123456789") * 100 <= chars * 50),
        Rule("ellipses", F.size(F.filter(F.split(text, "\n"), lambda s: s.rlike(r"(\.\.\.|\u2026)[ \t\r]*$"))) * 100 <= lines * 30),
        Rule("bullets", F.size(F.filter(F.split(text, "\n"), lambda s: s.rlike(r"^[ \t]*[-*\u2022]"))) * 100 <= lines * 90),
    ]


def order_rules(counts: DataFrame, rules: list[Rule], sample_rows: int = 2000) -> list[Rule]:
    """The rules by rejections per second of evaluation over about ``sample_rows`` documents.

    The sample takes documents by a hash of the id. A rule's cost is the time of a job
    that evaluates it alone, less that of a job that evaluates nothing.
    """
    total = counts.select("doc_id").count()
    if not total:
        return list(rules)
    share = min(1_000_000, max(1, sample_rows * 1_000_000 // total))
    part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < share
    sample = cut(counts.filter(part).repartition(4))

    def run(condition: Column) -> tuple[float, int]:
        began = time.perf_counter()
        failed = sample.agg(F.count(F.when(~F.coalesce(condition, F.lit(False)), 1))).first()[0]
        return time.perf_counter() - began, failed

    run(F.lit(True))  # compiles the common part
    floor = min(run(F.col("n_words") >= 0)[0] for _ in range(2))
    rated = []
    for i, rule in enumerate(rules):
        run(rule.passes)  # compiles the rule
        seconds, failed = run(rule.passes)
        rated.append((-failed / max(seconds - floor, 1e-4), i, rule))
    return [rule for _, _, rule in sorted(rated, key=lambda x: x[:2])]


def cascade(rules: list[Rule]) -> Column:
    """True if every rule passes; a later rule is evaluated only where the earlier ones passed."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(~F.coalesce(rule.passes, F.lit(False)), F.lit(False)).otherwise(verdict)
    return verdict


def apply_rules(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = 2000) -> DataFrame:
    """doc_id, the counts, base_failed and kept."""
    counts = with_counts(docs)
    ordered = order_rules(counts, rules or default_rules(), sample_rows)
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        F.when(base_failed(), F.lit(False)).otherwise(cascade(ordered)).alias("kept"),
    )
