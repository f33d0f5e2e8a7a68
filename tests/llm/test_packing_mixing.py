"""Packing against the tokenizers library; raking against its marginals."""

import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_paths import SF, SF2
from pyspark.sql import functions as F

from martforge.llm import mixing as M
from martforge.llm import packing as P
from martforge.llm.common import read_table
from martforge.llm.queries import QUERIES, TOKENIZER


def by_library(text):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*tok.encode(text, add_special_tokens=False).ids, 2]


@pytest.mark.parametrize(
    "text", ["", "plain words", "a<|endoftext|>b", "  two  spaces\n\n\ttab", "naïve — ½ \U0001f600", "don't we'll", "x" * 3000, "   12 3456"]
)
def test_ids_equal_the_library(text):
    assert [*P.encoder(TOKENIZER).encode(text, allowed_special="all"), 2] == by_library(text)


@pytest.mark.parametrize("white", [" ", "\t", "\n", " \t\n", "\xa0", "\u2003 "])
def test_ids_of_long_white_space(white):
    run = (white * 2_000_000)[: 2_000_000 if white in " \t\n" else 30_000]
    for text in (run, run + "end", "a" + run, "Start." + run + " end", run[:15_000] + "x" + run[:15_000] + "1" + run[:9_999]):
        assert P.token_ids(P.encoder(TOKENIZER), text) == by_library(text)[:-1]


def test_ids_of_long_runs_of_anything_else():
    for text in ("x" * 1_000_000, "7" * 300_000, "!" * 300_000, "\x1c" * 30_000 + "a"):
        assert P.token_ids(P.encoder(TOKENIZER), text) == P.encoder(TOKENIZER).encode(text, allowed_special="all")


def test_long_white_space_is_packed_and_mixed(spark):
    rows = [(1, " " * 2_000_000, "en", "a"), (2, "\n" * 1_200_000 + "x", "en", "a"), (3, "word " * 10, "de", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = P.pack(docs, TOKENIZER).collect()
    checked(got)
    want = {i: len(by_library(t)) for i, t, *_ in rows}
    assert {i: sum(r["length"] for r in got if r["doc_id"] == i) for i in want} == want
    assert {r["doc_id"]: r["n_tokens"] + 1 for r in M.mix(docs, TOKENIZER).collect()} == want


def test_texts_without_an_id_are_drawn_one_by_one(spark):
    docs = spark.range(3000).selectExpr("if(id < 2500, null, 7) AS doc_id", "'text number ' || id AS text", "'en' AS lang", "'a' AS source")
    rows = M.mix(docs, TOKENIZER).collect()
    for own in (None, 7):
        mine = [r for r in rows if r["doc_id"] == own]
        share, p = sum(r["selected"] for r in mine) / len(mine), sum(r["probability"] for r in mine) / len(mine)
        assert abs(share - p) <= 0.05
    assert M.sample(docs, TOKENIZER).count() == sum(r["selected"] for r in rows)


@pytest.mark.parametrize("expected", [None, 0.2, 0.5, 0.8])
def test_the_stated_size_is_drawn(spark, expected):
    rows = M.mix(read_table(spark, SF2, "documents"), TOKENIZER, expected=expected).collect()
    drawn, total = sum(r["n_tokens"] * r["probability"] for r in rows), sum(r["n_tokens"] for r in rows)
    assert drawn / total == pytest.approx(expected or M.EXPECTED, rel=1e-4)
    assert len({r["residual"] for r in rows}) == 1 and rows[0]["residual"] < 1e-3


def test_residual_of_targets_that_cannot_be_met():
    cells, tokens = [("a", "en"), ("b", "de")], np.array([100.0, 100.0])
    targets = [{"a": 0.9, "b": 0.1}, {"en": 0.1, "de": 0.9}]
    factors = M.rake(cells, tokens, targets)
    got = np.array([factors[0][a] * factors[1][b] for a, b in cells]) * tokens
    assert M.residual(cells, got, [{"a": 180.0, "b": 20.0}, {"en": 20.0, "de": 180.0}]) > 0.5


def checked(rows, capacity=1024):
    """Every sequence gapless from 0 and within the capacity; returns their number."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert 0 < at <= capacity
    return len(sequences)


def test_pieces_and_sequences(spark):
    docs = {r["doc_id"]: r["text"] for r in read_table(spark, SF, "documents").collect()}
    rows = QUERIES["op3_packing"](spark, SF).collect()
    per_doc = defaultdict(list)
    for r in rows:
        per_doc[r["doc_id"]].append(r)
    assert set(per_doc) == set(docs)
    for i, text in docs.items():
        ids, at = np.array(by_library(text or ""), dtype="<u4"), 0
        parts = sorted(per_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        for k, r in enumerate(parts):
            assert r["start"] == at and (k == 0 or r["length"] == 1024)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    total = sum(r["length"] for r in rows)
    assert checked(rows) <= -(-total // 1024) + 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_groups_hold_every_document_once(sizes):
    for pack in (P.best_fit, P.exact_fit, P.pack_group):
        bins = pack(sizes, 64)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(0 < sum(sizes[i] for i in b) <= 64 for b in bins)
    assert len(P.pack_group(sizes, 64)) <= len(P.best_fit(sizes, 64))


def gains(sizes, bins, capacity):
    """Whether a move, one for one, two for one or one for two of two bins increases the sum of squared fills."""
    fill = [sum(sizes[i] for i in b) for b in bins]
    some = lambda b, k: {sum(c) for c in combinations([sizes[i] for i in b], k)}
    for a in range(len(bins)):
        for b in range(len(bins)):
            if a != b:
                for give, take in ((1, 0), (1, 1), (1, 2), (2, 1)):
                    for x in some(bins[a], give):
                        for y in some(bins[b], take):
                            d = x - y
                            if 0 < d <= capacity - fill[b] and (fill[b] + d) ** 2 + (fill[a] - d) ** 2 > fill[a] ** 2 + fill[b] ** 2:
                                return True
    return False


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.randoms())
def test_the_search_ends_where_nothing_improves(sizes, rng):
    bins, order = [], list(range(len(sizes)))
    rng.shuffle(order)
    for i in order:  # any first packing
        b = next((b for b in bins if sum(sizes[j] for j in b) + sizes[i] <= 40 and rng.random() < 0.5), None)
        if b is None:
            bins.append(b := [])
        b.append(i)
    out = P.local_search(sizes, bins, 40)
    assert sorted(i for b in out for i in b) == sorted(order) and all(sum(sizes[i] for i in b) <= 40 for b in out)
    assert not gains(sizes, out, 40) and len(out) <= len(bins)


def fewest(sizes, capacity):
    """The smallest number of bins, by trying everything."""
    best = len(sizes)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(sizes):
            best = len(rooms)
            return
        for r in {r for r in rooms if r >= sizes[k]}:
            left = list(rooms)
            left.remove(r)
            place(k + 1, [*left, r - sizes[k]])
        place(k + 1, [*rooms, capacity - sizes[k]])

    sizes = sorted(sizes, reverse=True)
    place(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=9))
def test_small_sets_take_few_bins(sizes):
    assert len(P.pack_group(sizes, 30)) <= fewest(sizes, 30) + 1


def test_small_sets_by_brute_force():
    rng = np.random.default_rng(4)
    sets = [rng.integers(1, 31, rng.integers(3, 10)).tolist() for _ in range(150)]
    more = sum(len(P.pack_group(s, 30)) - fewest(s, 30) for s in sets)
    assert more <= 2


@pytest.mark.parametrize("words", ["600", "1 + id % 97", "if(id % 3 = 0, 1, 700)"])
def test_packing_again_ends(spark, words):
    docs = spark.range(700).select(F.col("id").alias("doc_id"), F.expr(f"repeat('ab ', cast({words} as int))").alias("text"))
    rows = P.pack(docs, TOKENIZER, group_rows=50).collect()
    assert len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows)
    checked(rows)


def test_local_search_empties_bins():
    sizes = [6, 6, 3, 3, 2, 2, 2, 4, 4]
    bad = [[0, 4], [1, 5], [2, 3], [6], [7, 8]]
    assert len(P.local_search(sizes, [b[:] for b in bad], 10)) <= len(bad)
    assert len(P.dissolve([7, 7, 3, 3], [[0], [1], [2, 3]], 10)) == 2


def test_packing_over_several_groups(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('ab cd ', cast(1 + id % 97 as int))").alias("text"))
    rows = P.pack(docs, TOKENIZER, capacity=256, group_rows=200).collect()
    total = sum(r["length"] for r in rows)
    assert len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows)
    assert checked(rows, 256) <= 1.02 * total / 256 + 2


def test_packing_edges(edge_docs, no_docs):
    rows = P.pack(edge_docs, TOKENIZER).collect()
    checked(rows)
    assert sum(1 for r in rows if r["piece"] == 0) == edge_docs.count()
    assert [r["length"] for r in rows if r["doc_id"] in (1, 2)] == [1, 1]
    assert P.pack(no_docs, TOKENIZER).count() == 0


def test_rake_meets_all_marginals():
    rng = np.random.default_rng(5)
    cells = [(s, lang, t) for s in "abc" for lang in ("en", "de", None) for t in range(4)]
    tokens = rng.integers(1, 1000, len(cells)).astype(float)
    targets = [{"a": 0.2, "b": 0.3, "c": 0.5}, {"en": 0.5, "de": 0.25, None: 0.25}, {t: 0.25 for t in range(4)}]
    factors = M.rake(cells, tokens, targets)
    w = np.array([np.prod([f[v] for f, v in zip(factors, c)]) for c in cells]) * tokens
    for d, target in enumerate(targets):
        for v, share in target.items():
            assert sum(x for x, c in zip(w, cells) if c[d] == v) / w.sum() == pytest.approx(share, rel=1e-6)


def test_mix_by_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    rows = M.mix(docs, TOKENIZER, targets={"lang": {"en": 0.25, "de": 0.25, "fr": 0.25, "es": 0.25}}).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == len(texts)
    assert all(r["n_tokens"] == len(by_library(texts[r["doc_id"]])) - 1 for r in rows)
    assert all(r["topic"] == M.topic_of(texts[r["doc_id"]], 8) for r in rows)
    expected = defaultdict(float)
    for r in rows:
        expected[r["lang"]] += r["n_tokens"] * r["probability"]
    total = sum(expected.values())
    assert all(x / total == pytest.approx(0.25, rel=1e-3) for x in expected.values())
    assert max(r["probability"] for r in rows) == pytest.approx(1.0)
    u = {r["doc_id"]: r["u"] for r in docs.select("doc_id", M.uniform(F.col("doc_id"), M.text_mark(F.col("text")), 42).alias("u")).collect()}
    assert all(r["selected"] == (u[r["doc_id"]] < r["probability"]) for r in rows)


def test_sample_draws_what_mix_selects(spark):
    docs = read_table(spark, SF, "documents")
    want = {r["doc_id"] for r in M.mix(docs, TOKENIZER).filter("selected").collect()}
    drawn = M.sample(docs, TOKENIZER)
    assert drawn.columns == docs.columns
    assert {r["doc_id"] for r in drawn.collect()} == want


def test_mix_edges(edge_docs, no_docs):
    rows = M.mix(edge_docs, TOKENIZER).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["probability"] <= 1 for r in rows)
    assert M.mix(no_docs, TOKENIZER).count() == 0
    assert M.sample(no_docs, TOKENIZER).count() == 0
    assert M.sample(edge_docs, TOKENIZER).columns == edge_docs.columns
    with pytest.raises(ValueError, match="cells"):
        M.mix(edge_docs, TOKENIZER, max_cells=2)


def test_one_rare_document_does_not_set_the_scale(spark):
    docs = read_table(spark, SF2, "documents").select("doc_id", "text", "lang", "source")
    rare = spark.createDataFrame([(-1, "saluton mondo kaj bonan tagon", "eo", "src0")], docs.schema)
    rows = M.mix(docs.unionByName(rare), TOKENIZER).collect()
    total = sum(r["n_tokens"] for r in rows)
    assert sum(r["n_tokens"] * r["probability"] for r in rows) >= 0.449 * total
    by_id = {r["doc_id"]: r["probability"] for r in rows}
    assert by_id[-1] == pytest.approx(1.0) and max(by_id.values()) <= 1 and min(by_id.values()) > 0
    # the other languages keep the proportions of their targets
    tokens, drawn = defaultdict(float), defaultdict(float)
    for r in rows:
        tokens[r["lang"]] += r["n_tokens"]
        drawn[r["lang"]] += r["n_tokens"] * r["probability"]
    target = M.tempered(tokens, 0.7)
    whole = {v for v in tokens if drawn[v] >= 0.999 * tokens[v]}
    ratios = [drawn[v] / target[v] for v in tokens if v not in whole]
    assert "eo" in whole and max(ratios) == pytest.approx(min(ratios), rel=1e-3)


def test_capped_rake_meets_the_stated_size():
    rng = np.random.default_rng(9)
    cells = [(s, lang, t) for s in "abc" for lang in ("en", "de", None) for t in range(4)] + [("a", "eo", 0)]
    tokens = np.append(rng.integers(1000, 100_000, len(cells) - 1), 5).astype(float)
    targets = []
    for d in range(3):
        sums = defaultdict(float)
        for c, n in zip(cells, tokens):
            sums[c[d]] += n
        targets.append(M.tempered(sums, 0.7))
    for share in (0.1, 0.45, 0.9, 1.0):
        p = M.capped_rake(cells, tokens, targets, share * tokens.sum())
        assert (p > 0).all() and (p <= 1).all() and p[-1] == pytest.approx(1.0)
        assert (p * tokens).sum() == pytest.approx(share * tokens.sum(), rel=1e-4)
