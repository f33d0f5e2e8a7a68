"""License scan and quality rules against plain Python."""

import re
import textwrap

from llm_paths import SF
from pyspark.sql import functions as F

from martforge.llm import licenses as L
from martforge.llm import quality_rules as R
from martforge.llm.common import read_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    places, covered = {}, set()
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in places.values():
        if len(at) > 1:
            covered.update(j for i in at for j in range(i, i + 8))
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n)


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b))


def licenses_of(text):
    def grams(s):
        words = re.sub(r"[\W_]+", " ", s.lower()).split()
        return set(zip(words, words[1:]))

    lines = text.split("\n")
    units = list(enumerate(lines)) + ([(-1, text)] if len(lines) > 1 else [])
    out = []
    for i, s in units:
        own = grams(s)
        if own:
            best = min(((-dice(own, grams(t)), k) for k, t in L.TEMPLATES.items()))
            if -best[0] >= 0.8:
                out.append((i, best[1], round(-best[0], 9)))
    return out


def test_counts_by_brute_force(spark):
    docs = read_table(spark, SF, "documents").unionByName(
        spark.createDataFrame(
            [
                (10_001, "a b c d e f g h " * 30, "en", "s", 1),
                (10_002, "\x1fodd\x0bspaces\x0c here\r\n\n x y   z " + "q " * 40, "en", "s", 1),
                (10_003, "x " * 9, "en", "s", 1),
                (10_004, "l1 a\nl1 a\n\n\nl1 a\n# $ |", "en", "s", 1),
            ],
            read_table(spark, SF, "documents").schema,
        )
    )
    want = {r["doc_id"]: counts(r["text"]) for r in docs.collect()}
    got = R.apply_rules(docs, sample_rows=50).collect()
    assert {r["doc_id"]: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in got} == want
    assert all(not (r["base_failed"] and r["kept"]) for r in got)


def test_order_changes_no_verdict(spark):
    docs = read_table(spark, SF, "documents")
    rules = R.default_rules()
    one = R.with_counts(docs).select("doc_id", R.cascade(rules).alias("k"))
    two = R.with_counts(docs).select("doc_id", R.cascade(rules[::-1]).alias("k"))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert {r.name for r in R.order_rules(R.with_counts(docs), rules)} == {r.name for r in rules}


def test_good_documents_stay(spark):
    labels = read_table(spark, SF, "labels")
    rows = R.apply_rules(read_table(spark, SF, "documents")).join(labels, "doc_id").collect()
    good = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    assert all(r["kept"] for r in good)
    bad = [r for r in rows if r["quality"] == 0]
    assert sum(not r["kept"] for r in bad) >= 0.8 * len(bad)


def test_licenses_by_brute_force(spark):
    mit = L.TEMPLATES["MIT-permission"]
    extra = [
        (10_001, mit, "en", "s", 1),
        (10_002, "intro\n" + mit.replace("free of charge", "without charge") + "\nReleased under the MIT License!", "en", "s", 1),
        (10_003, "\n".join(mit.split(", ")), "en", "s", 1),
        (10_004, "licensed under cc by 4.0", "en", "s", 1),
    ]
    docs = read_table(spark, SF, "documents")
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    want = {r["doc_id"]: sorted(licenses_of(r["text"])) for r in docs.collect()}
    got = {r["doc_id"]: sorted((m["line"], m["license"], round(m["dice"], 9)) for m in r["matches"]) for r in L.scan(docs).collect()}
    assert got == want
    assert any(k == "MIT-permission" for _, k, _ in got[10_001]) and got[10_002] and got[10_003]


def test_size_bounds_lose_nothing():
    for size in range(1, 60):
        low, high = L.size_bounds(size, 0.8)
        for n in range(1, 200):
            if not low <= n <= high:
                assert 2 * min(n, size) / (n + size) < 0.8


def test_native_edges(edge_docs, no_docs):
    for run in (L.scan, R.apply_rules):
        assert run(edge_docs).count() == edge_docs.count()
        assert run(no_docs).count() == 0
    rows = {r["doc_id"]: r for r in R.apply_rules(edge_docs).collect()}
    assert rows[2]["n_words"] == rows[1]["n_words"] == 0 and rows[1]["base_failed"] and not rows[1]["kept"]
    plan = L.scan(edge_docs)._jdf.queryExecution().toString() + R.with_counts(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert L.scan(edge_docs).filter(F.col("n_matches") > 0).count() == 0


def test_notices_over_lines_and_inside_lines(spark):
    mit, apache = L.TEMPLATES["MIT-permission"], L.TEMPLATES["Apache-2.0-notice"]
    tail = (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
        ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF'
        " MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE"
        " FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION"
        " WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    )
    header = "\n".join("# " + x for x in textwrap.wrap(apache, 70))
    code = "\n".join(f"y{i} = {i}" for i in range(200))
    rows = [
        (1, "MIT License\n\nCopyright (c) 2024 A\n\n" + textwrap.fill(mit, 78) + "\n\n" + textwrap.fill(tail, 78)),
        (2, "x = 1\n" + header + "\n\nimport os\n" + code),
        (3, "This project is released under the MIT License; see the LICENSE file."),
        (4, "Sources are\nreleased under the\nMIT License, the data is licensed under\nCC BY 4.0 since 2020."),
        (5, textwrap.fill(mit.replace("restriction,", "restriction of any sort,"), 40)),
        (6, "the license of the software\nis under the terms of this\n" * 30),
        (7, "of the " * 5000),
        (8, "Released under the MIT License.\n" + "\n".join(["more text here"] * 20) + "\n" + textwrap.fill(mit, 60) + "\n" + code),
    ]
    got = {r["doc_id"]: [(m["line"], m["license"]) for m in r["matches"]] for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == [(4, "MIT-permission")]
    assert got[2] == [(1, "Apache-2.0"), (1, "Apache-2.0-notice")]  # the first line alone is like the short notice
    assert got[3] == [(0, "MIT")]
    assert sorted(got[4]) == [(1, "MIT"), (2, "CC-BY-4.0")]
    assert got[5] == [(-1, "MIT-permission")]
    assert got[6] == got[7] == []
    assert got[8] == [(0, "MIT"), (21, "MIT-permission")]
