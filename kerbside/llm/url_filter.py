"""URL filters: allow and block rules, and gradient-boosted trees on lexical features for the rest.

URLs that a rule fits are the labelled ones. Trees learn from them on length, depth, digit ratio,
entropy, parameter counts and statistics of the host's suffix, all computed by SQL expressions; the
trees are grown by numpy on a bounded sample of feature rows and applied as SQL expressions again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import ascii_lower

FEATURES = (
    "url_length", "host_length", "path_length", "path_depth", "host_labels", "digit_ratio", "hyphens", "entropy",
    "parameters", "fragment", "secure", "first_segment_length", "suffix_share", "suffix_hosts", "suffix_length",
)


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a host (fits it and its subdomains) followed by the beginning of a path, if any."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.pattern[len(self.host) :]


def url_host(url: Column) -> Column:
    """What stands between the first :// and the next / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule], value: str = "pattern") -> Column:
    """``value`` (pattern or verdict) of the longest rule that fits, else NULL. Of equally long ones the first counts."""
    out = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.pattern)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, value))).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text).cast("double")

    def part(c: Column) -> Column:
        share = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return -share * F.log2(share)

    chars = F.filter(F.array_distinct(F.split(text, "")), lambda c: F.length(c) > 0)
    return F.when(n > 0, F.aggregate(F.transform(chars, part), F.lit(0.0), lambda a, b: a + b)).otherwise(F.lit(0.0))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def url_features(pages: DataFrame, total: int) -> DataFrame:
    """``pages`` with host and path and the columns FEATURES, doubles without NULLs.

    Suffix statistics are counted over all ``total`` rows: the share of rows whose host ends in the same
    last label, and how many hosts do.
    """
    url = F.coalesce(F.col("url"), F.lit(""))
    base = pages.select(
        "*",
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
        F.length(url).cast("double").alias("url_length"),
        _entropy(url).alias("entropy"),
        F.when(F.length(url) > 0, _count(url, "[0-9]") / F.length(url)).otherwise(0.0).alias("digit_ratio"),
        F.when(url.contains("?"), _count(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "[^&]+")).otherwise(0.0).alias("parameters"),
        url.contains("#").cast("double").alias("fragment"),
        ascii_lower(url).startswith("https").cast("double").alias("secure"),
    ).withColumn("suffix", F.substring_index("host", ".", -1))
    hosts = base.groupBy("suffix", "host").agg(F.count("*").alias("n"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("suffix_n"), F.count("*").alias("suffix_hosts"))
    shares = suffixes.select(
        "suffix",
        (F.col("suffix_n") / F.lit(float(max(total, 1)))).alias("suffix_share"),
        F.col("suffix_hosts").cast("double").alias("suffix_hosts"),
    )
    return base.join(shares, "suffix").select(
        *[base[c] for c in (*pages.columns, "host", "path", "url_length", "entropy", "digit_ratio", "parameters", "fragment", "secure")],
        F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        _count(F.col("path"), "/").alias("path_depth"),
        F.when(F.col("host") == "", 0.0).otherwise(_count(F.col("host"), r"\.") + 1).alias("host_labels"),
        _count(F.col("host"), "-").alias("hyphens"),
        F.length(F.regexp_extract("path", "^/([^/]*)", 1)).cast("double").alias("first_segment_length"),
        "suffix_share",
        F.log1p("suffix_hosts").alias("suffix_hosts"),
        F.length("suffix").cast("double").alias("suffix_length"),
    )


@dataclass
class Boosted:
    """Base score and trees; a tree is (feature, cut, left, right) or a leaf's value."""

    base: float
    trees: list

    def margin(self) -> Column:
        def tree(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, cut, left, right = node
            return F.when(F.col(FEATURES[feature]) <= F.lit(cut), tree(left)).otherwise(tree(right))

        return sum((tree(t) for t in self.trees), F.lit(self.base))

    def margins(self, x: np.ndarray) -> np.ndarray:
        def tree(node, rows: np.ndarray) -> np.ndarray:
            if isinstance(node, float):
                return np.full(len(rows), node)
            feature, cut, left, right = node
            return np.where(rows[:, feature] <= cut, tree(left, rows), tree(right, rows))

        return self.base + sum((tree(t, x) for t in self.trees), np.zeros(len(x)))


def fit_boosted(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 24, depth: int = 4, rate: float = 0.3, bins: int = 32
) -> Boosted:
    """Log-loss boosting with second-order leaf values on quantile cuts; ``weight`` counts a row's copies."""
    if not len(x) or y.min() == y.max():
        return Boosted(-3.0 if len(x) and y.max() == 0 else 3.0, [])
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    mean = float(np.average(y, weights=weight))
    base = float(np.log((mean + 1e-3) / (1 - mean + 1e-3)))
    model, z = Boosted(base, []), np.full(len(x), base)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, left: int):
        sum_g, sum_h = g[rows].sum(), h[rows].sum()
        best = (1e-6, None)
        if left:
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                gs = np.bincount(binned[rows, f], g[rows], len(c) + 1).cumsum()[:-1]
                hs = np.bincount(binned[rows, f], h[rows], len(c) + 1).cumsum()[:-1]
                gain = gs**2 / (hs + 1) + (sum_g - gs) ** 2 / (sum_h - hs + 1) - sum_g**2 / (sum_h + 1)
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (gain[at], (f, at))
        if best[1] is None:
            return float(-rate * sum_g / (sum_h + 1))
        f, at = best[1]
        low = binned[rows, f] <= at
        return (f, float(cuts[f][at]), grow(rows[low], g, h, left - 1), grow(rows[~low], g, h, left - 1))

    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        model.trees.append(grow(np.arange(len(x)), weight * (p - y), weight * p * (1 - p), depth))
        z = Boosted(0.0, model.trees[-1:]).margins(x) + z
    return model


def judge_urls(pages: DataFrame, rules: Sequence[Rule], sample_rows: int = 8000) -> DataFrame:
    """``pages`` columns page_id and url, host, path, rule (NULL where none fits), score and verdict (allow or block).

    Where a rule fits, its verdict holds; elsewhere the trees allow at a score of one half or more. The
    trees learn from about ``sample_rows`` rule-labelled URLs, drawn by the hash of the URL. Without
    labels all is allowed. NULL URLs have an empty host and path; repeated rows give repeated results.
    """
    pages = pages.select("page_id", "url")
    total = pages.count()
    host, path = F.col("host"), F.col("path")
    judged = (
        url_features(pages, total)
        .withColumn("rule", matching_rule(host, path, rules))
        .withColumn("rule_verdict", matching_rule(host, path, rules, "verdict"))
    )
    share = min(1.0, sample_rows / max(total, 1))
    drawn = judged.where(F.col("rule").isNotNull()).where(
        F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    )
    # Copies of one URL come as one row with a count.
    found = drawn.groupBy(*FEATURES, (F.col("rule_verdict") == "allow").cast("int").alias("y")).agg(F.count("*").alias("n"))
    data = np.array(sorted(tuple(r) for r in found.collect()), dtype=float).reshape(-1, len(FEATURES) + 2)
    model = fit_boosted(data[:, :-2], data[:, -2], data[:, -1])
    score = 1 / (1 + F.exp(-model.margin()))
    return judged.withColumn("score", score).select(
        "page_id",
        "url",
        "host",
        "path",
        "rule",
        "score",
        F.coalesce("rule_verdict", F.when(F.col("score") >= 0.5, F.lit("allow")).otherwise(F.lit("block"))).alias("verdict"),
    )
