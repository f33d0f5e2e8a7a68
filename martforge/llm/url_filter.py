"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

A rule is a verdict with a host and a path (``net/es/``). It fits its host and all subdomains
where the path starts with the rule's; of several that fit the longest wins. URLs that a
rule fits are the labelled ones: the trees are trained on them and judge every other URL
from its spelling alone (length, depth, digit ratio, entropy, parameter counts, and the
blocked share and count of labelled URLs with the same host suffix).

Features and verdicts are DataFrame functions throughout. Suffix statistics cover all
labelled URLs; a labelled URL's host ends in the suffix of one of the rules, so there are at most
as many suffixes as rules. The trees are grown on the driver from the features of a
bounded sample (``max_rows`` distinct labelled URLs, half of either verdict where there are as many,
smallest hashes first) and then written out as nested conditions, so judging is one pass
without a shuffle. The rules are written into the plan as well: meant for lists of hundreds.

Defined results: a null url, an empty one or one without ``://`` has an empty host and path, fits no
rule and is judged by the trees; a path of rule or url starts with ``/``, so a bare host
fits no rule; repeated rows and ids come out repeated; without labelled URLs everything else is
allowed, with labels of one kind only it gets that verdict; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.quality_gbt import Forest, train

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Verdict and rule (host, then path) of the standard list.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

FEATURES = (
    "length", "host_length", "path_length", "depth", "host_labels", "longest_segment", "digit_ratio", "host_digits",
    "hyphens", "entropy", "host_entropy", "n_params", "param_length", "has_fragment", "closed", "extension",
    "suffix_length", "suffix_count", "suffix_blocked",
)


#: Folds of the suffix statistics in training.
FOLDS = 5


@dataclass(frozen=True)
class UrlModel:
    """Rules, trees, and (labelled URLs, blocked ones) of each host suffix and fold."""

    rules: tuple
    forest: Forest
    suffixes: dict = field(default_factory=dict)


def _split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    if not slash or not host:
        raise ValueError(f"a rule is a host and a path that starts with '/': {rule!r}")
    return host, slash + path


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path and the query string."""
    rest = F.when(F.col("url").contains("://"), F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    out = pages.select("page_id", "url", rest.alias("rest"))
    return out.select(
        "page_id",
        "url",
        F.translate(F.regexp_extract("rest", r"^[^/?#]*", 0), UPPER, LOWER).alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
        F.regexp_extract("rest", r"^[^?#]*\?([^#]*)", 1).alias("params"),
    )


def rule_of(rules) -> Column:
    """The longest rule that fits host and path, else null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):  # the longest is tested first
        host, path = _split_rule(rule)
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def verdict_of(rules, rule: Column) -> Column:
    """A rule's verdict, null without one."""
    out = F.lit(None).cast("string")
    for verdict, text in rules:
        out = F.when(rule == text, F.lit(verdict)).otherwise(out)
    return out


def _characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1))


def _entropy(text: Column) -> Column:
    """Bits a character; 0 for an empty text."""
    n = F.length(text).cast("double")
    part = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.when(
        n > 0, F.aggregate(F.array_distinct(_characters(text)), F.lit(0.0), lambda s, c: s - part(c) * F.log2(part(c)))
    ).otherwise(0.0)


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("double")


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (with url, host, path, params) and the lexical features; suffix is the host's last label."""
    url, host, path = F.coalesce(F.col("url"), F.lit("")), F.col("host"), F.col("path")
    n = F.length(url).cast("double")
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    last = F.element_at(F.split(path, "/"), -1)
    ratio = lambda part, whole: F.when(whole > 0, part / whole).otherwise(0.0)
    suffix = F.regexp_extract(host, r"([^.]*)$", 1)
    digits = "0123456789"
    return urls.select(
        *urls.columns,
        suffix.alias("suffix"),
        n.alias("length"),
        F.length(host).cast("double").alias("host_length"),
        F.length(path).cast("double").alias("path_length"),
        F.size(segments).cast("double").alias("depth"),
        _count_of(host, ".").alias("host_labels"),
        F.coalesce(F.array_max(F.transform(segments, F.length)), F.lit(0)).cast("double").alias("longest_segment"),
        ratio(_count_of(url, digits), n).alias("digit_ratio"),
        ratio(_count_of(host, digits), F.length(host).cast("double")).alias("host_digits"),
        _count_of(url, "-").alias("hyphens"),
        _entropy(url).alias("entropy"),
        _entropy(host).alias("host_entropy"),
        F.size(F.filter(F.split("params", "&"), lambda s: s != "")).cast("double").alias("n_params"),
        F.length("params").cast("double").alias("param_length"),
        url.contains("#").cast("double").alias("has_fragment"),
        path.endswith("/").cast("double").alias("closed"),
        F.length(F.regexp_extract(last, r"\.([^.]*)$", 1)).cast("double").alias("extension"),
        F.length(suffix).cast("double").alias("suffix_length"),
    )


def with_suffix_statistics(df: DataFrame, counts: dict) -> DataFrame:
    """Adds the count and smoothed blocked share of labelled URLs of the suffix.

    ``counts`` maps (suffix, fold) to (URLs, blocked ones). A row of a labelled sample has its own fold in a
    column ``fold`` and sees the other folds' figures only, so that its label is not among them.
    """
    folds = "fold" in df.columns

    def total(k: int) -> Column:
        out = F.lit(0.0)
        for name in sorted({suffix for suffix, _ in counts}):
            value = F.lit(float(sum(v[k] for (suffix, _), v in counts.items() if suffix == name)))
            for (suffix, fold), v in counts.items():
                if folds and suffix == name:
                    value = value - F.when(F.col("fold") == fold, F.lit(float(v[k]))).otherwise(0.0)
            out = F.when(F.col("suffix") == name, value).otherwise(out)
        return out

    n, bad = (sum(v[k] for v in counts.values()) for k in (0, 1))
    prior = bad / n if n else 0.5
    return df.select(*df.columns, total(0).alias("_n"), total(1).alias("_b")).select(
        *df.columns, F.log1p("_n").alias("suffix_count"), ((F.col("_b") + 4.0 * prior) / (F.col("_n") + 4.0)).alias("suffix_blocked")
    )


def labelled(pages: DataFrame, rules) -> DataFrame:
    """The URLs (host, path, params too) that a rule fits, once each, with y (1: blocked)."""
    known = parsed(pages).select("url", "host", "path", "params", rule_of(rules).alias("rule")).filter("rule IS NOT NULL")
    y = F.when(verdict_of(rules, F.col("rule")) == "block", 1.0).otherwise(0.0)
    fold = F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(FOLDS))
    return known.select("url", "host", "path", "params", y.alias("y"), fold.alias("fold")).distinct()


def fit(pages: DataFrame, rules=RULES, max_rows: int = 20_000, trees: int = 30, depth: int = 3) -> UrlModel:
    """Trees from the URLs that the rules label, at most ``max_rows`` of them."""
    rules = tuple(rules)
    known = labelled(pages, rules)
    suffix = F.regexp_extract("host", r"([^.]*)$", 1)
    # a suffix is the last label of a rule's host: no more rows than rules times folds
    counts = known.groupBy(suffix.alias("suffix"), "fold").agg(F.count("*").alias("n"), F.sum("y").alias("b"))
    suffixes = {(r["suffix"], r["fold"]): (r["n"], r["b"]) for r in counts.orderBy("suffix", "fold").collect()}
    total, bad = sum(n for n, _ in suffixes.values()), int(sum(b for _, b in suffixes.values()))
    half = max_rows // 2
    sizes = {1.0: min(bad, max(half, max_rows - (total - bad))), 0.0: min(total - bad, max(half, max_rows - bad))}
    marked = known.select("*", F.xxhash64("url").alias("h"))
    chosen = [marked.filter(F.col("y") == y).orderBy("h", "url").limit(n) for y, n in sizes.items() if n]
    x, labels = np.zeros((0, len(FEATURES))), np.zeros(0)
    if chosen:
        sample = chosen[0] if len(chosen) == 1 else chosen[0].unionByName(chosen[1])
        rows = with_suffix_statistics(lexical(sample), suffixes).select("h", "url", "y", *FEATURES).collect()  # bounded by max_rows
        rows.sort(key=lambda r: (r["h"], r["url"]))
        x = np.array([[r[f] for f in FEATURES] for r in rows], dtype=np.float64)
        labels = np.array([r["y"] for r in rows], dtype=np.float64)
    return UrlModel(rules, train(x, labels, trees=trees, depth=depth), suffixes)


def margin(forest: Forest) -> Column:
    """Sum of the trees' leaf values as nested conditions."""

    def walk(node: int) -> Column:
        if forest.left[node] == node:
            return F.lit(float(forest.value[node]))
        at = F.col(FEATURES[int(forest.statistic[node])]) <= float(forest.threshold[node])
        return F.when(at, walk(int(forest.left[node]))).otherwise(walk(int(forest.right[node])))

    out = F.lit(float(forest.base))
    for root in forest.roots.tolist():
        out = out + walk(root)
    return out


def judge(pages: DataFrame, model: UrlModel) -> DataFrame:
    """page_id, host, path, rule, verdict and margin (above 0: the trees would block)."""
    urls = parsed(pages)
    urls = urls.select(*urls.columns, rule_of(model.rules).alias("rule"))
    scored = with_suffix_statistics(lexical(urls), model.suffixes).select(
        "page_id", "host", "path", "rule", margin(model.forest).alias("margin")
    )
    by_trees = F.when(F.col("margin") > 0, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", "rule",
        F.coalesce(verdict_of(model.rules, F.col("rule")), by_trees).alias("verdict"),
        "margin",
    )
