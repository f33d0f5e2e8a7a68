"""Toxicity (exact nearest neighbours) and quality (boosted trees)."""

import numpy as np
import pytest
from llm_paths import SF2
from pyspark.sql import functions as F

from martforge.llm import quality_gbt as Q
from martforge.llm import toxicity as X
from martforge.llm.common import crc_mod, read_table
from martforge.llm.queries import QUERIES


def test_block_max_search_is_exact():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghij"), 7)) for _ in range(60)]
    examples = []
    for i in range(300):
        y = int(i % 3 == 0)
        own = rng.choice(words[:20] if y else words[20:], 12)
        examples.append((i, " ".join([*own, *rng.choice(words, 4)]), y))
    index = X.build_index(examples, block=16)
    assert index.vocabulary
    for text in (" ".join(rng.choice(words, n)) for n in (1, 3, 9, 40)):
        at, w = index.vector({index.vocabulary[t]: n for t, n in X.term_counts(text).items() if t in index.vocabulary})
        rows, cos = index.nearest(at, w, 7)
        dense = np.zeros(len(index.vocabulary))
        dense[at] = w
        full = index.vectors @ dense
        want = [r for r in np.lexsort((np.arange(len(full)), -full))[:7] if full[r] > 0]
        assert np.allclose(full[want], cos)
        assert rows.tolist() == want or np.allclose(full[rows], full[want])


def test_document_counts_cover_the_corpus(spark):
    docs = read_table(spark, SF2, "documents")
    terms = ["the", "^thio", "no such term"]
    total, counts = X.document_counts(docs, terms)
    found = [set(X.term_counts(r["text"] or "")) for r in docs.collect()]
    assert total == len(found) and counts == {t: sum(t in f for f in found) for t in terms}
    assert X.document_counts(docs.limit(0), terms) == (0, dict.fromkeys(terms, 0))


def test_ids_may_be_texts(spark, edge_docs, edge_labels):
    docs, labels = (df.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string"))) for df in (edge_docs, edge_labels))
    model = X.fit(docs, labels)
    rows = X.score(docs, model).collect()
    assert len(rows) == edge_docs.count() and {r["doc_id"] for r in rows} >= {"d1", "d4", None}


def test_texts_of_one_id_count_once_in_the_fit(spark):
    rows = [(i % 40, f"word{i} " * (1 + i)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    one, two = (Q.fit(df, labels, trees=3) for df in (docs, spark.createDataFrame(rows[::-1], docs.schema).repartition(5)))
    assert np.array_equal(one.threshold, two.threshold) and np.array_equal(one.value, two.value)


def test_toxicity_held_out(spark):
    got = QUERIES["op1_toxicity"](spark, SF2)
    rows = got.join(read_table(spark, SF2, "labels"), "doc_id").filter("held_out").collect()
    assert got.count() == read_table(spark, SF2, "documents").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) >= 0.9
    hit = [r for r in rows if r["toxic"]]
    clean = [r for r in rows if not r["toxic"]]
    above = np.mean([(a["score"] > b["score"]) + 0.5 * (a["score"] == b["score"]) for a in hit for b in clean])
    assert above >= 0.8
    assert any(r["evidence"] for r in hit)


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = read_table(spark, SF2, "documents"), read_table(spark, SF2, "labels")
    held = crc_mod(F.col("doc_id"), 5) == 0
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (X.fit(docs.filter(~held), x) for x in (labels, flipped))
    assert one.vocabulary == two.vocabulary and (one.slope, one.offset) == (two.slope, two.offset)


def test_flattened_trees_match_a_plain_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < -0.5)).astype(float)
    forest = Q.train(x, y, trees=12, depth=3)
    for row, margin in zip(x[:50], forest.margin(x[:50])):
        total = forest.base
        for at in forest.roots:
            while forest.left[at] != at:
                at = forest.left[at] if row[forest.statistic[at]] <= forest.threshold[at] else forest.right[at]
            total += forest.value[at]
        assert total == pytest.approx(margin)
    assert ((forest.probability(x) >= 0.5) == y).mean() > 0.95


def test_quality_held_out(spark):
    got = QUERIES["op2_quality"](spark, SF2)
    rows = got.join(read_table(spark, SF2, "labels"), "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.93
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)


@pytest.mark.parametrize("module, label", [(X, "toxic"), (Q, "quality")])
def test_edges(edge_docs, no_docs, edge_labels, module, label):
    model = module.fit(edge_docs, edge_labels, label)
    rows = module.score(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert module.score(no_docs, model).count() == 0
    for labels in (edge_labels.limit(0), edge_labels.filter(f"{label} = 1")):
        alone = module.fit(edge_docs, labels, label)
        want = 1.0 if labels.count() else 0.0
        assert all(abs(r["score"] - want) < 1e-6 for r in module.score(edge_docs, alone).collect())
    assert module.score(edge_docs, module.fit(no_docs, edge_labels, label)).count() == edge_docs.count()


def test_keep_good_returns_the_documents_columns(edge_docs, no_docs, edge_labels):
    forest = Q.fit(edge_docs, edge_labels)
    kept = Q.keep_good(edge_docs, forest)
    assert kept.columns == edge_docs.columns
    scores = Q.score(edge_docs, forest, 0.7)
    assert kept.count() == scores.filter("predicted = 1").count()
    assert Q.keep_good(no_docs, forest).count() == 0
