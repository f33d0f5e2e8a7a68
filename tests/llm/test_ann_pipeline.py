"""Nearest neighbours against brute force; the pipeline against its stages' brute-force versions."""

import numpy as np
from llm_paths import SF, SF2
from pyspark.sql import functions as F
from test_dedup import components_brute, fingerprint_brute, lines_brute
from test_packing_mixing import by_library, checked

import corpus_pipeline
from martforge.llm import ann_tree as A
from martforge.llm import mixing, quality_gbt
from martforge.llm.common import crc_mod, read_table


def brute(rows, k=20):
    """rows: [(id, vector)], usable ones -> {query: [(id, score), ...]}, summed left to right."""
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            scores = []
            for i, x in rows:
                if i != q:
                    s = 0.0
                    for a, b in zip(v, x):
                        s += a * b
                    scores.append((-s, i))
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def test_recall_and_scores(spark):
    table = read_table(spark, SF2, "embeddings")
    got: dict = {}
    for r in A.search(table, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    want = brute([(r["vec_id"], [float(x) for x in r["embedding"]]) for r in table.collect()])
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        assert [x[2] for x in found] == list(range(1, 21))
        assert [x[:2] for x in found] == sorted((x[:2] for x in found), key=lambda x: (-x[1], x[0]))
        exact = dict(brute_all for brute_all in want[q])
        hits += sum(i in exact for i, _, _ in found)
        assert all(exact[i] == s for i, s, _ in found if i in exact)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_ties_and_hot_vectors(spark):
    hot = [1.0, 2.0, 0.5]
    rows = [(i, hot) for i in range(1, 3001)] + [(4000, [0.1, 0.1, 0.1]), (4020, hot)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = A.search(df, F.col("vec_id") % 2000 == 0, k=5, block_rows=256, block_queries=4).orderBy("query_id", "rank").collect()
    assert [r["vec_id"] for r in got if r["query_id"] == 2000] == [1, 2, 3, 4, 5]
    assert [r["vec_id"] for r in got if r["query_id"] == 4000] == [1, 2, 3, 4, 5]


def test_repeated_ids_take_one_place(spark):
    rng = np.random.default_rng(3)
    ids, x = np.arange(60), rng.normal(size=(60, 4))
    more = np.concatenate([x] + [x * f for f in (0.99, 0.98, 0.5)])  # four vectors of each id
    a, b, score = A.best_of(np.array([-1]), x[:1], np.tile(ids, 4), more, 20)
    best = (np.tile(ids, 4)[b]).tolist()
    exact = {int(i): max(float(x[0] @ v) for v in more[i::60]) for i in ids}
    assert best == sorted(exact, key=lambda i: (-exact[i], i))[:20]
    assert np.allclose(score, [exact[i] for i in best])
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x)] * 10  # each row ten times
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert A.valid(df).count() == 60
    got = A.search(df, F.col("vec_id") % 20 == 0, target_recall=1.0).collect()
    want = brute([(int(i), v.tolist()) for i, v in zip(ids, x)])
    assert {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in want} == {
        q: [i for i, _ in best] for q, best in want.items()
    }


def test_invalid_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], "x"), (1, [0.5, 0.5], "x"), (2, None, "x"), (3, [0.0, 0.0], "x"), (4, [nan, 1.0], "x"), (5, [inf, 1.0], "x"),
        (6, [None, 1.0], "x"), (7, [1.0, 0.0, 0.0], "x"), (None, [1.0, 1.0], "x"), (8, [-1.0, 0.0], "x"), (8, [-1.0, 0.0], "x"), (20, [0.0, 0.0], "x"), (40, [2.0, 1.0], "x"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string")
    got = A.search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got] == [
        (0, 40, 2.0), (0, 1, 0.5), (0, 8, -1.0), (40, 0, 2.0), (40, 1, 1.5), (40, 8, -2.0),
    ]
    assert A.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert A.search(df.filter("vec_id = 3"), F.col("vec_id") % 20 == 0).count() == 0


def test_every_leaf_is_visited_in_the_end():
    x = np.random.default_rng(0).normal(size=(900, 8))
    tree = A.fit_tree(x, leaf_fit=20)
    assert sorted(tree.visits(x[0], tree.leaves)) == list(range(tree.leaves))
    assert set(tree.assign(x)) <= set(range(tree.leaves))
    assert A.fit_tree(np.ones((50, 4)), leaf_fit=8).leaves == 1


def bisected(f, want, high):
    """x with f(x) = want for a rising f."""
    low = 0.0
    for _ in range(200):
        x = (low + high) / 2
        low, high = (x, high) if f(x) < want else (low, x)
    return high


def capped_fitting(keys, tokens, shares, size):
    """Probabilities, stopped at 1, whose expected tokens meet the shares of the size, by bisection value by value."""
    factors = [{v: 1.0 for v in s} for s in shares]
    wanted = []
    for d, share in enumerate(shares):
        have = {v: tokens[[c[d] == v for c in keys]].sum() for v in share}
        t = bisected(lambda t: sum(min(have[v], t * share[v]) for v in share), size, 1e12)
        wanted.append({v: min(have[v], t * share[v]) for v in share})
    for _ in range(300):
        for d, want in enumerate(wanted):
            for v, n in want.items():
                at = np.array([c[d] == v for c in keys])
                rest = np.array([np.prod([factors[e][c[e]] for e in range(3) if e != d]) for c in keys])[at]
                most = 1 / rest[(tokens[at] > 0) & (rest > 0)].min() if n and (rest > 0).any() else 1.0
                factors[d][v] = bisected(lambda f: (np.minimum(1, f * rest) * tokens[at]).sum(), n, most) if n else 0.0
    return [min(1.0, float(np.prod([factors[d][c[d]] for d in range(3)]))) for c in keys]


def test_pipeline_by_brute_force(spark):
    """Each stage of run() by a plain version of it, over the same documents."""
    docs = read_table(spark, SF, "documents")
    labels = read_table(spark, SF, "labels")
    rows = {r["doc_id"]: r for r in docs.collect()}
    forest = quality_gbt.fit(docs.filter(crc_mod(F.col("doc_id"), 4) != 2), labels)
    scores = forest.probability(np.array([quality_gbt.statistics(r["text"]) for r in rows.values()]))
    good = [i for i, s in zip(rows, scores) if s >= 0.7]
    clean = {}
    for i, (text, equal, near) in lines_brute([(i, rows[i]["text"]) for i in good]).items():
        lines = sum(1 for s in rows[i]["text"].split("\n") if s.strip())
        if lines == 0 or equal + near < lines:
            clean[i] = text
    group = components_brute([(i, fingerprint_brute(t)) for i, t in clean.items()])
    single = {i: t for i, t in clean.items() if group[i] == i}
    cells: dict = {}
    for i, t in single.items():
        c = (rows[i]["source"], rows[i]["lang"], mixing.topic_of(t, 8))
        cells[c] = cells.get(c, 0) + len(by_library(t)) - 1
    keys, tokens = list(cells), np.array(list(cells.values()), dtype=float)
    shares = []
    for d in range(3):
        sums: dict = {}
        for c, n in cells.items():
            sums[c[d]] = sums.get(c[d], 0.0) + n
        shares.append(mixing.tempered(sums, 0.7))
    p = dict(zip(keys, capped_fitting(keys, tokens, shares, mixing.EXPECTED * tokens.sum())))
    left = spark.createDataFrame(list(single.items()), "doc_id long, text string")  # the draw is by id and the text that is left
    u = {r["doc_id"]: r["u"] for r in left.select("doc_id", mixing.uniform(F.col("doc_id"), mixing.text_mark(F.col("text")), 42).alias("u")).collect()}
    drawn = {i for i, t in single.items() if u[i] < p[(rows[i]["source"], rows[i]["lang"], mixing.topic_of(t, 8))]}

    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == drawn
    assert {i: sum(r["length"] for r in got if r["doc_id"] == i) for i in drawn} == {i: len(by_library(single[i])) for i in drawn}
    assert checked(got) <= -(-sum(r["length"] for r in got) // 1024) + 2


def test_stages_on_edges(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            rows = out.count()
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns and rows <= docs.count()
            if docs is no_docs:
                assert rows == 0


def test_groups_of_neighbouring_leaves():
    x = np.random.default_rng(2).normal(size=(900, 8))
    tree = A.fit_tree(x, leaf_fit=20)
    order = tree.leaf_order()
    assert sorted(order) == list(range(tree.leaves))
    sizes = dict(zip(*(a.tolist() for a in np.unique(tree.assign(x), return_counts=True))))
    groups = A.leaf_groups(order, sizes, 100)
    held: dict = {}
    for leaf, group, parts in groups:
        held.setdefault(group, []).append((leaf, parts))
    assert [leaf for leaf, *_ in groups] == order and all(parts == 1 for _, _, parts in groups)
    assert all(sum(sizes.get(leaf, 0) for leaf, _ in g) <= 100 for g in held.values())
    assert len(held) <= 2 * 900 / 100 + 1
    assert A.leaf_groups([0, 1, 2], {0: 5, 1: 250, 2: 5}, 100) == [(0, 0, 1), (1, 1, 3), (2, 2, 1)]


def test_a_query_sees_the_rows_of_its_leaves_only():
    rng = np.random.default_rng(3)
    x, ids = rng.normal(size=(40, 6)), np.arange(40)
    allowed = rng.random((3, 40)) < 0.4
    a, b, score = A.best_of(np.array([-1, -2, -3]), x[:3], ids, x, 5, allowed)
    for i in range(3):
        want = sorted(np.flatnonzero(allowed[i]), key=lambda j: (-float(x[i] @ x[j]), j))[:5]
        assert b[a == i].tolist() == want
