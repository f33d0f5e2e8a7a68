"""Merkle manifest, phrase mining and URL filter against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_paths import SF, SF2
from pyspark.sql import functions as F

from martforge.llm import merkle as M
from martforge.llm import phrases as P
from martforge.llm import url_filter as U
from martforge.llm.common import read_table
from martforge.operators.ranking import positions


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest_brute(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: digest(*map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))

    def tree(level):
        paths, below = [[] for _ in level], [[i] for i in range(len(level))]
        while len(level) > 1:
            up, under = [], []
            for a in range(0, len(level), 8):
                run = level[a : a + 8]
                for k in range(len(run)):
                    for i in below[a + k]:
                        paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
                up.append(digest(*run))
                under.append(sum(below[a : a + 8], []))
            level, below = up, under
        return level[0], paths

    by = {}
    for r in rows:
        own = changed = leaf(r, r["text"])
        if r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
            changed = leaf(r, r["text"].translate({c: c + 32 for c in range(65, 91)}))
        by.setdefault(r["lang"], []).append(((r["doc_id"] is not None, r["doc_id"] or 0, own), r["doc_id"], own, changed))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    below = {}
    for lang in langs:
        by[lang].sort(key=lambda x: x[0])
        below[lang] = tree([x[2] for x in by[lang]])
    root, above = tree([below[lang][0] for lang in langs])
    out = []
    for lang, up in zip(langs, above):
        for (_, doc, own, fold), path in zip(by[lang], below[lang][1]):
            for a, b in path + up:
                fold = digest(a, fold, b)
            out.append((doc, own, below[lang][0], root, digest(*(x for p in path + up for x in p)), fold, fold == root))
    return sorted(out, key=repr)


def manifest_got(df):
    return sorted((tuple(r) for r in M.manifest(df).drop("lang").collect()), key=repr)


def test_manifest_on_documents(spark):
    docs = read_table(spark, SF2, "documents")
    got = manifest_got(docs)
    assert got == manifest_brute(docs.collect())
    assert 0 < sum(not r[-1] for r in got) < len(got)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513, 4097])
def test_manifest_sizes(spark, n):
    docs = spark.range(n).selectExpr("id AS doc_id", "'Text ' || id AS text", "if(id < 3, null, 'en') AS lang", "'s' AS source", "id AS n_chars")
    assert manifest_got(docs) == manifest_brute(docs.collect())


def test_manifest_many_languages_and_equal_rows(spark):
    docs = spark.range(700).selectExpr(
        "if(id % 3 = 0, null, id div 7) AS doc_id", "if(id % 5 = 0, null, 'A b') AS text", "'l' || (id % 77) AS lang", "null AS source", "1L AS n_chars"
    )
    assert manifest_got(docs) == manifest_brute(docs.collect())


def test_manifest_edges(edge_docs, no_docs):
    assert manifest_got(edge_docs) == manifest_brute(edge_docs.collect())
    assert M.manifest(no_docs).collect() == []


def test_sweeps_alone():
    leaves = [digest(str(i)) for i in range(75)]
    levels = M.forward(leaves, M.height(75))
    assert [len(x) for x in levels] == [75, 10, 2, 1]
    assert levels[1][9] == digest(*leaves[72:]) and levels[3][0] == digest(*levels[2])
    for leaf, path in zip(leaves, M.backward(levels, [])):
        assert M.folded(leaf, path) == levels[3][0]


def test_positions(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "cast(id % 3 AS string) AS g", "id")
    for group in ("g", None):
        rows = positions(df, ["k", "id"], group).collect()
        by = {}
        for r in rows:
            by.setdefault(r["g"] if group else "", []).append((r["k"], r["id"], r["at"]))
        for v in by.values():
            assert [x[2] for x in sorted(v)] == list(range(len(v)))
    assert positions(df.limit(0), ["id"]).collect() == []


def sequences(rows):
    for lang, text in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            yield lang or "und", [w for w in re.split("[ \t]+", piece) if w]


def phrases_brute(rows, top, least):
    f, n = Counter(), Counter()
    for lang, w in sequences(rows):
        n[lang] += len(w)
        for m in range(1, 5):
            f.update((lang, *w[i : i + m]) for i in range(len(w) - m + 1))
    cand = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    gone = set()
    for k, a in cand.items():
        w = k[1:]
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                inner = (k[0], *w[i : i + m])
                if 100 * a >= 80 * f[inner]:
                    gone.add(inner)
    out = {}
    for k, a in cand.items():
        if k in gone:
            continue
        lang, w = k[0], k[1:]
        cuts = []
        for c in range(1, len(w)):
            left, right = f[(lang, *w[:c])], f[(lang, *w[c:])]
            cuts.append((2000000 * a // (left + right), c, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
        for lang, v in out.items()
        for i, (s, a, p, left, right) in enumerate(sorted(v)[:top])
    )


def phrases_got(df, **options):
    return sorted(tuple(r[c] for c in P.RESULT) for r in P.collocations(df, **options).collect())


@pytest.mark.parametrize("per_round", [50_000, 300])
def test_phrases_on_documents(spark, per_round):
    docs = read_table(spark, SF2, "documents")
    want = phrases_brute([(r["lang"], r["text"]) for r in docs.collect()], 25, 8)
    assert phrases_got(docs, top=25, least=8, per_round=per_round) == want


@pytest.mark.parametrize("seed", range(3))
def test_phrases_of_few_words(spark, seed):
    rng = random.Random(seed)
    words = "a b c D e é".split()
    rows = [
        (rng.choice(["en", None, "fr"]), "".join(rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ". ", "\n", " a b c "]) for _ in range(40)))
        for _ in range(40)
    ]
    df = spark.createDataFrame(rows, "lang string, text string")
    for top, per_round in ((5, 7), (1000, 50_000)):
        assert phrases_got(df, top=top, least=3, per_round=per_round) == phrases_brute(rows, top, 3)


def test_phrase_edges(edge_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in edge_docs.collect()]
    assert phrases_got(edge_docs, top=40, least=2) == phrases_brute(rows, 40, 2)
    assert P.collocations(no_docs).collect() == []


def test_chunks_lose_no_sequence():
    rng = random.Random(1)
    texts = ["".join(rng.choice(["ab ", "c\t", "d. ", "e ", "F "]) for _ in range(rng.randrange(200))) for _ in range(30)]
    rows = [("x", t) for t in texts]
    known = np.full(P.BITS // 8, 255, dtype=np.uint8)
    asked = [(b"ab c", True), (b"e", True), (b"c e f", True), (b"e ab c", False)]
    f = Counter(" ".join(w[i : i + m]) for _, w in sequences(rows) for m in range(1, 5) for i in range(len(w) - m + 1))
    for size in (5, 64, 10_000):
        single, pair, more = P.Singles("x"), P.Pairs("x", known), P.Extensions("x", known, asked)
        for tokens in P._chunks([t.encode() for t in texts], size):
            for counter in (single, pair, more):
                counter.add(tokens)
        got = {(k, p): n for c in (single, pair, more) for b in c.rows() for k, p, n in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))) if n}
        want = {(0, None): sum(n for p, n in f.items() if " " not in p)}
        for p, n in f.items():
            b, w = p.encode(), p.encode().split(b" ")
            if len(w) < 3:
                want[(len(w), b)] = n
            if b == b"e ab c":
                want[(3, b)] = n
            if (b" ".join(w[:-1]), True) in asked:
                want[(4, b)] = n
            if (b" ".join(w[1:]), True) in asked:
                want[(5, b)] = n
        assert got == want


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    grams = spark.createDataFrame([("x", "p q", big - 1)], "lang string, phrase string, f long")
    parts = spark.createDataFrame([("x", "p", big), ("x", "q", big - 1)], "lang string, phrase string, f long")
    r = P.scored(grams, parts).first()
    assert r["score"] == 2_000_000 * (big - 1) // (2 * big - 1)
    assert r["bound"] == r["score"]


def url_brute(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = host.translate({c: c + 32 for c in range(65, 91)})
    best = None
    for _, rule in U.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best)):
            best = rule
    return host, path, best


URLS = [
    None, "", "no scheme", "http://", "://x.com/", "http://a.com", "http://A.Com/", "http://xcom/", "https://example.com/en/1", "http://www.EXAMPLE.com/en/",
    "http://m.www.example.com/en/a?b=c&d", "http://www.example.com/EN/1", "http://a.net/es/x#y", "http://net/fr/", "http://net/fr", "ftp://u@x.net:80/es/",
    "http://x.org/a-b/c.tar.gz?x=1&&y=2#z?w", "http://x.org?u=http://a.com/", "a?b=http://y.com/c", "http://é\U0001f600.com/ü", "http://x.com/" + "a/" * 50_000,
    "http://x.com/a\nb",
]


def test_urls_parse_and_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://a.com/"), (3, "http://")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS rule", "2 AS _n", "'y' AS suffix", "0 AS y")
    got = U.judge(pages, U.fit(pages)).collect()
    assert sorted(((r["page_id"], r["host"], r["path"], r["rule"]) for r in got), key=repr) == sorted(((i, *url_brute(u)) for i, u in rows), key=repr)
    said = dict((rule, verdict) for verdict, rule in U.RULES)
    assert all(r["verdict"] == said[r["rule"]] for r in got if r["rule"])
    assert all(r["verdict"] in ("allow", "block") for r in got)


def test_urls_without_labels(spark):
    pages = spark.createDataFrame([(1, "http://x.org/a"), (2, None)], "page_id long, url string")
    assert {r["verdict"] for r in U.judge(pages, U.fit(pages)).collect()} == {"allow"}
    assert U.judge(pages.limit(0), U.fit(pages.limit(0))).collect() == []
    bad = pages.unionByName(spark.createDataFrame([(3, "http://a.net/es/")], pages.schema))
    assert {r["verdict"] for r in U.judge(bad, U.fit(bad)).collect()} == {"block"}
    with pytest.raises(ValueError):
        U.rule_of([("block", "com")])


def test_url_trees_are_walked_as_grown(spark):
    pages = read_table(spark, SF2, "pages")
    model = U.fit(pages)
    urls = U.with_suffix_statistics(U.lexical(U.parsed(pages)), model.suffixes).select("page_id", "url", *U.FEATURES).collect()
    margins = {r["page_id"]: r["margin"] for r in U.judge(pages, model).collect()}
    forest = model.forest
    assert len(forest.roots) and len(margins) == len(urls)
    for r in urls:
        total = forest.base
        for node in forest.roots.tolist():
            while forest.left[node] != node:
                node = int((forest.left if r[U.FEATURES[forest.statistic[node]]] <= forest.threshold[node] else forest.right)[node])
            total += forest.value[node]
        assert math.isclose(total, margins[r["page_id"]], abs_tol=1e-9)
        url, host = r["url"], url_brute(r["url"])[0]
        part = [n / len(url) for n in Counter(url).values()]
        assert math.isclose(r["entropy"], -sum(p * math.log2(p) for p in part), abs_tol=1e-9)
        assert r["digit_ratio"] == sum(c.isdigit() for c in url) / len(url) and r["host_labels"] == host.count(".")


def test_url_trees_on_held_out_urls(spark):
    """URLs of example.com whose spelling tells the verdict: other rules, so that the trees have something to learn."""
    rules = [("allow", "com/good/"), ("block", "com/bad/"), ("allow", "org/"), ("block", "info/")]
    rows = []
    rng = random.Random(5)
    for i in range(1200):
        if i % 2:
            rows.append((i, f"http://cheap-{rng.randrange(10**6)}-pills{i}.{rng.choice(['com', 'info'])}/bad/{rng.randrange(10**9)}?id={i}&s={i}&t=1"))
        else:
            rows.append((i, f"http://www.{rng.choice(['news', 'garden', 'museum'])}.{rng.choice(['com', 'org'])}/good/{rng.choice(['a', 'bird', 'rose'])}"))
    rows = [(i, u) for i, u in rows if not (u.split("/")[2].endswith("info") and "bad" not in u)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    held = F.col("page_id") % 5 == 0
    model = U.fit(pages.filter(~held), rules)
    scored = U.judge(pages.filter(held), model).collect()
    right = sum((r["margin"] > 0) == (r["page_id"] % 2 == 1) for r in scored)
    assert right >= 0.95 * len(scored)


def test_url_verdicts_on_pages(spark):
    pages = read_table(spark, SF, "pages")
    got = U.judge(pages, U.fit(pages)).collect()
    want = {r["page_id"]: url_brute(r["url"]) for r in pages.collect()}
    assert {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in got} == want


def test_native_plan_of_urls(spark):
    pages = read_table(spark, SF, "pages")
    plan = U.judge(pages, U.fit(pages))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
