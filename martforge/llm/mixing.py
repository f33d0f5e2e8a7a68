"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed over the cells (source, language, topic). Raking then finds one
factor per source, language and topic so that the weighted tokens meet the target
share of every source, every language and every topic at once. A document's weight
is the product of its three factors. A document is drawn where a hash of its id and its text falls
below its probability.

The size of the draw is a parameter: ``expected``, a share of all tokens (``EXPECTED``, one half, where neither it nor targets
are given). Probabilities are the products of factors, stopped at 1, and the factors are fitted so that
the expected tokens are that size and every value has its target share of it; a value whose share is more
than all its tokens is drawn whole, the others share the rest in proportion to their
targets. So a rare value of a large weight cannot make the draw small. With targets and without
``expected`` the targets are met exactly at the largest size that scaling allows: probabilities are the weights
over the largest weight of any cell with tokens.

``residual`` says how far the fitting is off: the largest difference of a value's expected tokens from its
target tokens, over the size. Targets that zero cells or full values rule out cannot all be met.

Only the cells reach the driver, never documents; more than ``max_cells`` of them are
refused with an error, not cut. Their factors are therefore small enough to broadcast.

Defined results: null source, language or topic is a category of its own; null
and empty texts have no tokens and take their cell's probability; repeated rows get
equal decisions, different texts of one id or of none decisions of their own; an empty table gives an empty result; targets for values that
do not occur are left out and the rest scaled to 1.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martforge.llm.common import cut
from martforge.llm.packing import encoder, token_ids

DIMENSIONS = ("source", "lang", "topic")
#: Share of all tokens that is drawn in expectation unless stated otherwise.
EXPECTED = 0.5


def topic_of(text: str, topics: int, known: dict | None = None) -> int:
    """Topic of a whole text: the word class with most of its longer words.

    Words of five or more letters are dealt into ``topics`` classes by crc32; ties go
    to the smaller class, a text without such words to class 0.
    """
    known = {} if known is None else known
    votes = [0] * topics
    for word, n in Counter(text.lower().split()).items():
        at = known.get(word)
        if at is None:
            at = zlib.crc32(word.encode("utf-8", "surrogatepass")) % topics if len(word) >= 5 else -1
            if len(known) < 500_000:
                known[word] = at
        if at >= 0:
            votes[at] += n
    return votes.index(max(votes))


def measured(docs: DataFrame, tokenizer: str, topics: int = 8) -> DataFrame:
    """doc_id, source, lang and a hash ``mark`` of the text, with ``topic`` and ``n_tokens`` of their texts."""
    base = docs.select("text", "doc_id", "source", "lang", text_mark(F.col("text")).alias("mark"))
    names = ["doc_id", "source", "lang", "mark", "topic", "n_tokens"]

    def batches(it):
        encoding, known = encoder(tokenizer), {}
        for batch in it:
            topic, tokens = [], []
            for value in batch.column(0):
                text = value.as_py() or ""
                topic.append(topic_of(text, topics, known))
                tokens.append(len(token_ids(encoding, text)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(topic, pa.int32()), pa.array(tokens, pa.int64())], names)

    schema = StructType(base.schema.fields[1:]).add("topic", "integer").add("n_tokens", "long")
    return base.mapInArrow(batches, schema)


def tempered(sums: dict, alpha: float) -> dict:
    """Target shares proportional to the token share to the power ``alpha``."""
    raised = {k: float(v) ** alpha if v > 0 else 0.0 for k, v in sums.items()}
    total = sum(raised.values())
    return {k: v / total for k, v in raised.items()} if total else raised


def residual(cells: list[tuple], expected: np.ndarray, wanted: list[dict]) -> float:
    """Largest difference of a value's expected tokens from the wanted ones, over the sum of the wanted."""
    worst, size = 0.0, max((sum(w.values()) for w in wanted), default=0.0)
    for d, want in enumerate(wanted):
        have: dict = {}
        for c, n in zip(cells, expected.tolist()):
            have[c[d]] = have.get(c[d], 0.0) + n
        worst = max(worst, *(abs(have.get(v, 0.0) - n) for v, n in want.items())) if want else worst
    return worst / size if size else 0.0


def rake(cells: list[tuple], tokens: np.ndarray, targets: list[dict], rounds: int = 200, tolerance: float = 1e-10) -> list[dict]:
    """Factors per dimension so that weighted tokens meet all target shares.

    ``cells`` holds one value per dimension; values without tokens keep factor 1.
    Ends when no marginal is off by more than ``tolerance`` (relative), or after
    ``rounds`` (``residual`` tells how far it is then).
    """
    total = float(tokens.sum())
    codes, wanted, factors, names = [], [], [], []
    for d, target in enumerate(targets):
        values = sorted({c[d] for c in cells}, key=lambda v: (v is None, str(v)))
        at = {v: i for i, v in enumerate(values)}
        code = np.array([at[c[d]] for c in cells], dtype=np.int64)
        has = np.bincount(code, weights=tokens, minlength=len(values)) > 0
        share = np.array([float(target.get(v, 0.0)) for v in values]) * has
        if has.any() and share.sum() <= 0:
            raise ValueError("the targets name no value that occurs")
        codes.append(code)
        wanted.append(share / share.sum() * total if has.any() else share)
        factors.append(np.ones(len(values)))
        names.append(values)
    for _ in range(rounds if total else 0):
        worst = 0.0
        for d in range(len(targets)):
            weight = np.prod([f[c] for f, c in zip(factors, codes)], axis=0)
            have = np.bincount(codes[d], weights=weight * tokens, minlength=len(names[d]))
            ratio = np.divide(wanted[d], have, out=np.ones_like(have), where=have > 0)
            worst = max(worst, float(np.abs(ratio[wanted[d] > 0] - 1).max(initial=0)))
            factors[d] *= ratio
        if worst < tolerance:
            break
    return [dict(zip(n, f.tolist())) for n, f in zip(names, factors)]


def attainable(share: np.ndarray, have: np.ndarray, size: float) -> np.ndarray:
    """Tokens per value, ``size`` in all: in proportion to ``share``, none above what it has."""
    out, free = np.zeros_like(have), (share > 0) & (have > 0)
    left = min(size, float(have[free].sum()))
    while free.any():
        part = np.where(free, share, 0.0)
        part *= left / part.sum()
        over = free & (part >= have)
        if not over.any():
            return np.where(free, part, out)
        out[over] = have[over]
        left, free = max(0.0, left - float(have[over].sum())), free & ~over
    return out


def attainable_targets(cells: list[tuple], tokens: np.ndarray, targets: list[dict], size: float) -> list[dict]:
    """Tokens that each value is to have of a draw of ``size``."""
    out = []
    for d, target in enumerate(targets):
        values = sorted({c[d] for c in cells}, key=lambda v: (v is None, str(v)))
        at = {v: i for i, v in enumerate(values)}
        have = np.bincount([at[c[d]] for c in cells], weights=tokens, minlength=len(values)) if cells else np.zeros(0)
        out.append(dict(zip(values, attainable(np.array([float(target.get(v, 0.0)) for v in values]), have, size).tolist())))
    return out


def capped_rake(cells: list[tuple], tokens: np.ndarray, targets: list[dict], size: float, rounds: int = 500, tolerance: float = 1e-9) -> np.ndarray:
    """Probability per cell, the product of its factors or 1 if that is less, so that ``size`` tokens are expected.

    Like ``rake``, but each factor is the one with which the probabilities, after
    they are stopped at 1, meet the attainable tokens of its value.
    """
    codes, wanted, factors = [], [], []
    for d, target in enumerate(targets):
        values = sorted({c[d] for c in cells}, key=lambda v: (v is None, str(v)))
        at = {v: i for i, v in enumerate(values)}
        codes.append(np.array([at[c[d]] for c in cells], dtype=np.int64))
        have = np.bincount(codes[d], weights=tokens, minlength=len(values))
        wanted.append(attainable(np.array([float(target.get(v, 0.0)) for v in values]), have, size))
        factors.append(np.ones(len(values)))
    for _ in range(rounds):
        worst = 0.0
        for d, want in enumerate(wanted):
            code, n = codes[d], len(want)
            rest = np.prod([f[c] for e, (f, c) in enumerate(zip(factors, codes)) if e != d], axis=0)
            live = (tokens > 0) & (rest > 0)
            have = np.bincount(code, weights=np.minimum(1, rest * factors[d][code]) * tokens, minlength=n)
            worst = max(worst, float(np.abs(have - want)[want > 0].max(initial=0)) / size)
            # the factor at which all cells of a value reach 1
            most = np.zeros(n)
            np.maximum.at(most, code[live], 1 / rest[live])
            free = live.copy()
            while True:
                open_ = np.bincount(code, weights=np.where(free, rest * tokens, 0.0), minlength=n)
                full = np.bincount(code, weights=np.where(live & ~free, tokens, 0.0), minlength=n)
                factor = np.divide(np.maximum(want - full, 0.0), open_, out=most.copy(), where=open_ > 0)
                over = free & (factor[code] * rest >= 1)
                if not over.any():
                    break
                free &= ~over
            some = np.bincount(code, weights=tokens, minlength=n) > 0
            factors[d] = np.where(some, np.minimum(factor, np.where(most > 0, most, factor)), 1.0)
        if worst < tolerance:
            break
    return np.minimum(1.0, np.prod([f[c] for f, c in zip(factors, codes)], axis=0))


def text_mark(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def uniform(id_col: Column, mark: Column, seed: int) -> Column:
    """A number in [0, 1) from a hash of the id, the text's mark and a seed."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(id_col.cast("string"), F.lit("")), mark, F.lit(seed)), 11) / F.lit(float(1 << 53))


def cell_weights(
    known: DataFrame,
    targets: dict[str, dict] | None = None,
    alpha: float = 0.7,
    max_cells: int = 200_000,
    expected: float | None = None,
) -> DataFrame:
    """(c_source, c_lang, c_topic, weight, probability, residual): one row per cell of measured documents.

    ``targets`` maps a dimension to {value: share}; a dimension without targets
    takes its own token shares tempered by ``alpha``. ``expected`` is the share of all tokens
    to draw; None: ``EXPECTED`` without targets, with them what meets them exactly.
    """
    if expected is None and not targets:
        expected = EXPECTED
    if expected is not None and not 0 < expected <= 1:
        raise ValueError("expected is a share of all tokens")
    table = known.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")).limit(max_cells + 1).collect()
    if len(table) > max_cells:
        raise ValueError(f"more than {max_cells} cells of source, language and topic; raise max_cells or merge values")
    table.sort(key=lambda r: tuple((r[d] is None, str(r[d])) for d in DIMENSIONS))
    cells = [tuple(r[d] for d in DIMENSIONS) for r in table]
    tokens = np.array([r["tokens"] for r in table], dtype=np.float64)
    wanted = []
    for i, d in enumerate(DIMENSIONS):
        sums: dict = {}
        for c, n in zip(cells, tokens):
            sums[c[i]] = sums.get(c[i], 0.0) + float(n)
        wanted.append((targets or {}).get(d) or tempered(sums, alpha))
    factors = rake(cells, tokens, wanted)
    weights = np.array([float(np.prod([f[v] for f, v in zip(factors, c)])) for c in cells])
    if expected is None:
        top = max((w for w, n in zip(weights, tokens) if n > 0), default=1.0) or 1.0
        probabilities, size = np.minimum(1.0, weights / top), float((weights * tokens).sum()) / top
    else:
        size = expected * float(tokens.sum())
        probabilities = capped_rake(cells, tokens, wanted, size) if size else np.minimum(1.0, weights)
    off = residual(cells, probabilities * tokens, attainable_targets(cells, tokens, wanted, size))
    rows = [(*c, w, p, off) for c, w, p in zip(cells, weights.tolist(), probabilities.tolist())]
    kinds = {f.name: f.dataType.simpleString() for f in known.schema}
    schema = ", ".join(f"c_{d} {kinds[d]}" for d in DIMENSIONS) + ", weight double, probability double, residual double"
    return known.sparkSession.createDataFrame(rows, schema)


def mix(docs: DataFrame, tokenizer: str, topics: int = 8, seed: int = 42, **options) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, weight, probability, selected and residual of every document."""
    known = cut(measured(docs, tokenizer, topics))
    per_cell = F.broadcast(cell_weights(known, **options))  # at most max_cells rows
    same = [known[d].eqNullSafe(per_cell[f"c_{d}"]) for d in DIMENSIONS]
    return known.join(per_cell, same).select(
        "doc_id", *DIMENSIONS, "n_tokens", "weight", "probability",
        (uniform(F.col("doc_id"), F.col("mark"), seed) < F.col("probability")).alias("selected"), "residual",
    )


def sample(docs: DataFrame, tokenizer: str, topics: int = 8, seed: int = 42, **options) -> DataFrame:
    """The documents (all their columns) that the mix draws; texts are read twice and never shuffled."""
    per_cell = cell_weights(cut(measured(docs, tokenizer, topics)), **options)
    per_cell = F.broadcast(per_cell.select(*[F.col(f"c_{d}").alias(f"_cell_{d}") for d in DIMENSIONS], F.col("probability").alias("_cell_p")))

    @F.pandas_udf("int")
    def topic(text: pd.Series) -> pd.Series:
        known: dict = {}
        return text.map(lambda t: topic_of(t or "", topics, known)).astype("int32")

    drawn = docs.join(
        per_cell,
        F.col("source").eqNullSafe(F.col("_cell_source")) & F.col("lang").eqNullSafe(F.col("_cell_lang")) & (topic(F.col("text")) == F.col("_cell_topic")),
    )
    return drawn.filter(uniform(F.col("doc_id"), text_mark(F.col("text")), seed) < F.col("_cell_p")).select(docs.columns)
