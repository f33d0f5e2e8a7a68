"""Suffix dedup, SimHash groups and line dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_paths import SF, SF2

from martforge.llm import line_dedup as D
from martforge.llm import simhash as H
from martforge.llm import suffix_dedup as S
from martforge.llm.common import keyed, read_table
from martforge.llm.components import connected_components


def suffix_brute(rows, length=100):
    seen, out = set(), {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for j in range(len(raw) - length + 1):
            w = raw[j : j + length]
            if w in seen:
                gone[j : j + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for j in range(len(raw)) if gone[j] and (j == 0 or not gone[j - 1]))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def suffix_got(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.dedup(df).collect()}


def test_suffixes_on_documents(spark):
    docs = read_table(spark, SF, "documents")
    assert suffix_got(docs) == suffix_brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_suffixes_on_hard_cases(spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    base, passage = word(900), word(260)
    texts = [
        "a" * 700, "a" * 350, "ab" * 300, base, base, base[:450] + "X" + base[450:], base[30:-31], passage + word(80) + passage,
        word(40) + passage + word(40), passage[:99], passage[:100], passage[1:101] + passage[:100], "ü" * 120, "xü" + "ü" * 80, word(99), word(100), "",
    ]
    for _ in range(60):  # windows of shared stuff with random edges
        a = rng.randrange(0, 800)
        texts.append(word(rng.randrange(0, 60)) + base[a : a + rng.randrange(60, 240)] + word(rng.randrange(0, 60)))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    for parts in (1, 5):  # all in one batch, and over several
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        assert suffix_got(df) == suffix_brute(rows)


def test_suffixes_across_hashed_parts(spark, monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdef") for _ in range(3_000_000))
    rows = [(1, text), (2, text[1_048_000:1_049_500]), (3, "x" + text[1_048_476 - 50 : 1_048_476 + 200])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_got(df)
    assert got[1][1] == 0 and got[2][:3] == (1500, 1500, 1) and got[3][:3] == (251, 250, 1)


@pytest.mark.parametrize("which", ["edge_docs", "no_docs"])
def test_suffix_edges(request, which):
    docs = request.getfixturevalue(which)
    rows = S.dedup(docs).collect()
    assert len(rows) == docs.count()
    by = {(r["doc_id"], r["n_bytes"]): r for r in rows}
    if rows:
        assert by[(1, 0)]["n_removed"] == by[(2, 0)]["n_removed"] == 0
        # the null id sorts first, so its text is the one that stays
        assert [r["n_removed"] for r in rows if r["doc_id"] is None] == [0] or by[(4, 252)]["n_removed"] > 0


def fingerprint_brute(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    k = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_brute(marks):
    """marks: [(doc_id, fingerprint)] -> {doc_id: smallest id reachable}."""
    root = {i: i for i, _ in marks}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(marks):
        for j, b in marks[:n]:
            if (a ^ b).bit_count() <= 4:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in marks}


@pytest.mark.parametrize("sf", [SF, SF2])
def test_simhash_by_brute_force(spark, sf):
    docs = read_table(spark, sf, "documents")
    marks = [(r["doc_id"], fingerprint_brute(r["text"])) for r in docs.collect()]
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in H.simhash_groups(docs).collect()}
    want = components_brute(marks)
    assert got == {i: (f"{f:016x}", want[i]) for i, f in marks}


def test_multi_index_finds_every_pair(spark):
    rng = random.Random(2)
    fps = {0, (1 << 64) - 1}
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(6):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 6))))
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = [tuple(sorted(r)) for r in H.near_pairs(df).collect()]
    want = {tuple(sorted((a, b))) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4}
    assert len(got) == len(set(got)) and set(got) == want


@settings(max_examples=5, deadline=None)
@given(edges=st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    group = {n: {n} for e in edges for n in e}
    for u, v in edges:
        if group[u] is not group[v]:
            group[u] |= group[v]
            for n in group[v]:
                group[n] = group[u]
    assert got == {n: min(g) for n, g in group.items() if len(g) > 1}


def test_chain_of_components(spark):
    df = spark.range(1, 400).selectExpr("id AS u", "id - 1 AS v")
    assert {r["root"] for r in connected_components(df).collect()} == {0}


def test_simhash_edges(edge_docs, no_docs):
    rows = H.simhash_groups(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    zero = {r["doc_id"] for r in rows if r["fingerprint"] == "0" * 16}
    assert zero == {1, 2, 7} and {r["component_id"] for r in rows if r["doc_id"] in zero} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] in (4, 5, None)} == {4}
    kept = H.one_of_each_group(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 3, 4, 8, 9, 10} == set(ids)
    assert H.simhash_groups(no_docs).count() == H.one_of_each_group(no_docs).count() == 0


def lines_brute(rows, min_words=8):
    seen, long_lines, out = set(), [], {}
    for i, text in sorted(rows):
        keep, equal, near = [], 0, 0
        for line in (text or "").split("\n"):
            words = tuple(line.lower().split())
            if not words:
                keep.append(line)
                continue
            if words in seen:
                equal += 1
                continue
            close = len(words) >= min_words and any(edits(words, x) <= 1 for x in long_lines if abs(len(words) - len(x)) <= 1)
            seen.add(words)
            if len(words) >= min_words:
                long_lines.append(words)
            near += close
            if not close:
                keep.append(line)
        out[i] = ("\n".join(keep), equal, near)
    return out


def edits(a, b):
    """Plain Levenshtein distance over words."""
    if len(set(a) ^ set(b)) > 2:
        return 2
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def lines_got(df):
    return {r["doc_id"]: (r["text"], r["n_equal"], r["n_near"]) for r in D.dedup(df).collect()}


def test_lines_on_documents(spark):
    docs = read_table(spark, SF, "documents")
    assert lines_got(docs) == lines_brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_lines_on_hard_cases(spark):
    rng = random.Random(11)
    rows = []
    base = [f"w{rng.randrange(5)}" for _ in range(12)]
    for i in range(60):
        lines = []
        for _ in range(4):
            words = base[: rng.randrange(6, 13)]
            for _ in range(rng.randrange(0, 3)):
                at, kind = rng.randrange(len(words)), rng.randrange(3)
                words = words[:at] + ([f"w{rng.randrange(5)}"] if kind else []) + words[at + (kind != 1) :]
            lines.append(rng.choice(["", "  "]).join([" ", " ".join(words).upper() if rng.random() < 0.2 else " ".join(words)]))
        rows.append((i, "\n".join([*lines, ""])))
    rng.shuffle(rows)
    for parts in (1, 6):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        assert lines_got(df) == lines_brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=7), st.lists(st.sampled_from("abc"), max_size=7))
def test_one_edit(a, b):
    assert D.within_one_edit(a, b) == (edits(tuple(a), tuple(b)) <= 1)


def test_half_keys_meet():
    rng = random.Random(5)
    for _ in range(500):
        a = [f"w{rng.randrange(9)}" for _ in range(rng.randrange(8, 20))]
        at = rng.randrange(len(a))
        b = rng.choice([a[:at] + a[at + 1 :], a[:at] + ["new"] + a[at:], a[:at] + ["new"] + a[at + 1 :]])
        assert set(D.half_keys(a)) & set(D.half_keys(b))


def test_line_edges(edge_docs, no_docs):
    rows = D.dedup(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(r["text"] == "   \n\t \n" and r["n_lines"] == 0 for r in rows if r["doc_id"] == 7)
    kept = D.without_repeats(edge_docs)
    assert kept.columns == edge_docs.columns and [f.dataType for f in kept.schema] == [f.dataType for f in edge_docs.schema]
    # the null id comes first; 4 and both rows of 5 only repeat its line
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 7, 8, 9, 10]
    assert D.dedup(no_docs).count() == D.without_repeats(no_docs).count() == 0


def test_long_runs_of_one_byte():
    data = np.frombuffer(b"a" * 5000, dtype=np.uint8)
    h, c, first, off, after = S.anchors(data, np.array([5000]), 100, 24)
    assert len(first) == 4901 and len(set(h.tolist())) == 1


def test_one_document_of_every_group_whatever_its_id(spark):
    def text(seed):
        return " ".join(f"w{random.Random(seed * 1000 + j).randrange(10**6)}" for j in range(60))

    # four texts without an id, one of them in the group of id 1; two texts of id 5, one of them of id 2's group
    rows = [(None, text(0)), (None, text(1)), (None, text(2)), (None, text(2)), (None, text(3)), (1, text(3)),
            (5, text(4)), (5, text(5)), (5, text(5)), (2, text(4)), (7, text(6)), (7, text(7))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r["doc_id"] or 0, r["text"]) for r in H.one_of_each_group(df).collect())
    assert got == sorted([(0, text(0)), (0, text(1)), (0, text(2)), (1, text(3)), (2, text(4)), (5, text(5)), (7, text(6)), (7, text(7))])


def text_hash(text):
    """The bytes by which texts of one id are ordered."""
    return hashlib.md5(text.encode()).digest()


def many_texts_of_an_id(own, lines):
    """2,000 texts of one id; the first 1,001 repeat nothing, the others one of these with other ends."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    fresh = [" ".join(word() for _ in range(30)) for _ in range(1001)]
    again = [f"{word()}\n{x}\n{word()}" if lines else f"{word()} {x} {word()}" for x in fresh[:999]]
    texts = fresh + again
    rng.shuffle(texts)
    return [(own, t) for t in texts] + [(7, "seven " * 40), (8, "seven " * 40)]


@pytest.mark.parametrize("own", [None, 5])
def test_suffixes_of_many_texts_with_one_id(spark, own):
    rows = many_texts_of_an_id(own, False)
    order = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], text_hash(r[1])))
    want = suffix_brute([(i, t) for i, (_, t) in enumerate(order)])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.dedup(df).collect())
    assert got == sorted((str(order[i][0]), *v) for i, v in want.items())


@pytest.mark.parametrize("own", [None, 5])
def test_lines_of_many_texts_with_one_id(spark, own):
    rows = many_texts_of_an_id(own, True)
    order = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], text_hash(r[1])))
    want = lines_brute([(i, t) for i, (_, t) in enumerate(order)])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted((str(r["doc_id"]), r["text"], r["n_equal"], r["n_near"]) for r in D.dedup(df).collect())
    assert got == sorted((str(order[i][0]), *v) for i, v in want.items())
    assert sum(n for *_, n, _ in got) >= 999


def test_keys_of_documents(spark):
    rows = [(1, "a"), (1, "b"), (1, "b"), (None, "x"), (None, None), (2, "q"), (-(1 << 63), "least")]
    got = {(r["doc_id"], r["text"]): (r["id"], bytes(r["t"])) for r in keyed(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(set(got.values())) == 6
    assert got[(2, "q")] == (2, b"") and got[(1, "a")] == (1, text_hash("a")) and got[(None, "")][1] == text_hash("")
