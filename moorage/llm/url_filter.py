"""URL filter: rules by host and path, and gradient-boosted trees on lexical features for all other urls.

Everything on the main path is DataFrame expressions and aggregates. Trees are grown from histograms: one
``groupBy(node, feature, bin)`` a level over the labelled rows; only the bounded histograms (nodes x features x bins)
reach the driver, and a fitted model is scored as a nested CASE expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.functions.storage import cut, drop
from moorage.llm.text import spare, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


PRODUCTION_RULES = (
    Rule("com/", "allow"),
    Rule("example.com/en/", "block"),
    Rule("www.example.com/en/", "allow"),
    Rule("net/es/", "block"),
    Rule("net/fr/", "block"),
)


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> Column:
    """Text of the longest rule that fits, null if none. A rule fits its host and all subdomains of it."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        out = F.when(fits, F.lit(rule.text)).otherwise(out)
    return out


def lexical_features(url: str, host: str, path: str) -> dict[str, Column]:
    """Lexical features of an url; a null url counts as empty."""
    u, h, p = F.coalesce(F.col(url), F.lit("")), F.col(host), F.col(path)
    n = F.char_length(u)
    digits = F.regexp_count(u, F.lit("[0-9]"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    hl = F.char_length(h)
    entropy = F.lit(0.0)
    for c in LOWER + "0123456789-.":
        share = ratio((hl - F.char_length(F.replace(h, F.lit(c), F.lit("")))).cast("double"), hl)
        entropy = entropy - F.when(share > 0, share * F.log2(share)).otherwise(F.lit(0.0))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    return {
        "length": n.cast("double"),
        "host_length": hl.cast("double"),
        "depth": F.regexp_count(p, F.lit("/[^/]+")).cast("double"),
        "host_labels": F.when(hl > 0, F.size(F.split(h, r"\."))).otherwise(F.lit(0)).cast("double"),
        "digit_ratio": ratio(digits.cast("double"), n),
        "host_digits": F.regexp_count(h, F.lit("[0-9]")).cast("double"),
        "host_hyphens": F.regexp_count(h, F.lit("-")).cast("double"),
        "host_entropy": entropy,
        "parameters": F.when(query != "", F.regexp_count(query, F.lit("&")) + 1).otherwise(F.lit(0)).cast("double"),
        "secure": u.startswith("https://").cast("double"),
        "fragment": u.contains("#").cast("double"),
    }


@dataclass
class Booster:
    """Trees as nested tuples (feature, cut, left, right) or leaf values; ``suffixes`` holds statistics of host suffixes by
    hash: smoothed log odds of the labelled rows against those of all of them."""

    base: float = 0.0
    trees: list = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    suffixes: list[float] = field(default_factory=list)

    def margin(self, value) -> Column:
        """``value``: gives the column of a feature by name."""

        def walk(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            name, at, low, high = tree
            return F.when(value(name) <= F.lit(float(at)), walk(low)).otherwise(walk(high))

        out = F.lit(float(self.base))
        for tree in self.trees:
            out = out + walk(tree)
        return out


@dataclass(frozen=True)
class UrlModel:
    """``sample``: most labelled urls that are fitted, chosen by hash; ``suffixes``: hashes that host suffixes have
    statistics by; ``folds``: parts of the sample, of which a row's own is left out of its suffix's statistics."""

    sample: int = 50_000
    suffixes: int = 1024
    folds: int = 4
    rounds: int = 8
    depth: int = 3
    bins: int = 16
    rate: float = 0.3
    l2: float = 1.0

    def fit(self, labelled: DataFrame, url: str = "url", label: str = "label") -> Booster:
        """``labelled``: url and a 0/1 label (null labels are ignored). Without both classes the model is the prior."""
        rows = labelled.where(F.col(label).isNotNull()).select(F.col(url).alias("url"), F.col(label).cast("double").alias("y"))
        rows = rows.withColumn("u", F.xxhash64("url"))
        total = rows.agg(F.approx_count_distinct("u")).first()[0]
        # about twice the number, of which the order takes as many as are wanted; an url counts once for each label
        near = rows.where(F.pmod("u", F.lit(1 << 30)) < int((1 << 30) * min(1.0, 2 * self.sample / max(1, total))))
        rows = cut(near.dropDuplicates(["u", "y"]).orderBy("u", "y").limit(self.sample))
        total, positives = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0.0))).first()
        base = math.log((positives + 1) / (total - positives + 1))
        weight = {1.0: total / (2 * max(positives, 1.0)), 0.0: total / (2 * max(total - positives, 1.0))}
        if not total or positives in (0.0, float(total)):
            drop(rows)
            return Booster(base=base)
        parts = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
        parts = parts.withColumns({"suffix": self.hashed("host"), "fold": F.pmod(F.xxhash64("u"), F.lit(self.folds)).cast("int")})
        held = cut(parts.select("y", "suffix", "fold", *(c.alias(n) for n, c in lexical_features("url", "host", "path").items())))
        names = [c for c in held.columns if c not in ("y", "suffix", "fold")]
        n, p = ([[0.0] * self.suffixes for _ in range(self.folds)] for _ in range(2))
        for r in held.groupBy("suffix", "fold").agg(F.count("*").alias("n"), F.sum("y").alias("p")).collect():
            n[r.fold][r.suffix], p[r.fold][r.suffix] = r.n, r.p
        odds = lambda k, out: math.log((sum(c[k] for i, c in enumerate(p) if i != out) + 1) / (sum(c[k] for i, c in enumerate(n) if i != out) - sum(c[k] for i, c in enumerate(p) if i != out) + 1)) - base
        seen = [any(c[k] for c in n) for k in range(self.suffixes)]
        of = lambda out: [odds(k, out) if seen[k] else 0.0 for k in range(self.suffixes)]
        apart = F.element_at(F.array(*(F.lit(of(i)) for i in range(self.folds))), F.col("fold") + 1)
        with_stats = cut(held.withColumn("suffix_odds", F.get(apart, F.col("suffix"))).drop("suffix", "fold"))
        names.append("suffix_odds")
        grid = [i / self.bins for i in range(self.bins + 1)]
        between = lambda q: [(a + b) / 2 for a, b in zip(q, q[1:], strict=False)]
        cuts = dict(zip(names, (between(sorted(set(q))) for q in with_stats.agg(*(F.percentile_approx(n, grid, 10_000).alias(n) for n in names)).first()), strict=True))
        binned = cut(with_stats.select("y", *(sum(((F.col(n) > F.lit(float(v))).cast("int") for v in cuts[n]), F.lit(0)).alias(n) for n in names)).groupBy("y", *names).agg((F.count("*") * F.when(F.col("y") > 0, weight[1.0]).otherwise(weight[0.0])).alias("w")))
        drop(rows, held, with_stats)
        model = Booster(names=names, suffixes=of(None))
        bin_trees: list = []
        for _ in range(self.rounds):
            bin_trees.append(self._tree(binned, names, Booster(trees=bin_trees)))
            if not isinstance(bin_trees[-1], tuple):
                break
        drop(binned)
        unbin = lambda t: (t[0], cuts[t[0]][t[1]], unbin(t[2]), unbin(t[3])) if isinstance(t, tuple) else t
        model.trees = [unbin(t) for t in bin_trees]
        return model

    def hashed(self, host: str) -> Column:
        return F.pmod(F.xxhash64(suffix_of(host)), F.lit(self.suffixes)).cast("int")

    def _tree(self, binned: DataFrame, names: list[str], so_far: Booster):
        """Grown level by level, with one aggregation a level; a split's sums give its leaves their values."""
        p = 1 / (1 + F.exp(-so_far.margin(F.col)))
        rows = binned.withColumns({"g": (F.col("y") - p) * F.col("w"), "h": p * (1 - p) * F.col("w")})
        splits: dict[int, tuple] = {}
        values: dict[int, float] = {}
        open_nodes = {1}
        for _ in range(self.depth):
            node = F.lit(1)
            for at in sorted(splits):
                name, b = splits[at][:2]
                node = F.when(node == at, F.when(F.col(name) <= b, at * 2).otherwise(at * 2 + 1)).otherwise(node)
            cells = rows.withColumn("node", node).where(F.col("node").isin(sorted(open_nodes))).select("node", "g", "h", F.posexplode(F.array(*names)).alias("f", "bin"))
            found: dict[int, dict[int, list]] = {}
            for r in cells.groupBy("node", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
                found.setdefault(r.node, {}).setdefault(r.f, []).append((r.bin, r.g, r.h))
            opened = set()
            for at, by in found.items():
                G, H = (sum(x[i] for x in by[0]) for i in (1, 2))
                values.setdefault(at, self.rate * G / (H + self.l2))
                best = (1e-6, None, None, 0.0, 0.0)
                for f in sorted(by):
                    g = h = 0.0
                    for b, x, y in sorted(by[f])[:-1]:
                        g, h = g + x, h + y
                        gain = g * g / (h + self.l2) + (G - g) ** 2 / (H - h + self.l2) - G * G / (H + self.l2)
                        if gain > best[0] + 1e-9:
                            best = (gain, names[f], b, g, h)
                if best[1]:
                    splits[at] = best[1:3]
                    g, h = best[3:]
                    values |= {2 * at: self.rate * g / (h + self.l2), 2 * at + 1: self.rate * (G - g) / (H - h + self.l2)}
                    opened |= {2 * at, 2 * at + 1}
            open_nodes = opened
            if not opened:
                break
        grow = lambda at: (*splits[at], grow(2 * at), grow(2 * at + 1)) if at in splits else values.get(at, 0.0)
        return grow(1)


def suffix_of(host: str) -> Column:
    """The last two labels of a host."""
    return F.substring_index(F.col(host), ".", -2)


def filter_urls(pages: DataFrame, rules=PRODUCTION_RULES, labelled: DataFrame | None = None, model: UrlModel = UrlModel(), url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, score (probability that the url is to be blocked) and verdict.

    ``labelled``: url and label (1: block). Without it, the urls that a rule decides are the labelled ones. A null or
    malformed url has empty host and path, fits no rule and is scored on its (empty) features. Urls of any length are read
    whole, equal urls are judged alike, and repeated rows come back repeated. Input columns named like an output are
    replaced, all others stay. Tables without rows give no rows.
    """
    judged = pages.drop("host", "path", "rule", "score", "verdict")
    judged = judged.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = lookup_verdict(F.col("rule"), rules)
    if labelled is None:
        labelled = judged.select(F.col(url).alias("url"), (by_rule == "block").cast("int").alias("label"))
    booster = model.fit(labelled)
    features = lexical_features(url, "host", "path")
    if booster.suffixes:
        features["suffix_odds"] = F.get(F.lit(booster.suffixes), model.hashed("host"))
    names = {n: spare(f"f_{n}", judged.columns) for n in features if n in booster.names}
    scored = judged.withColumns({names[n]: c for n, c in features.items() if n in names})
    margin = booster.margin(lambda n: F.col(names[n]))
    scored = scored.withColumn("score", 1 / (1 + F.exp(-margin))).drop(*names.values())
    return scored.withColumn("verdict", F.coalesce(by_rule, F.when(F.col("score") >= 0.5, "block").otherwise("allow")))


def lookup_verdict(rule: Column, rules) -> Column:
    out = F.lit(None).cast("string")
    for r in rules:
        out = F.when(rule == r.text, F.lit(r.verdict)).otherwise(out)
    return out


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a page; nulls, long urls, ties and repeated rows as in ``filter_urls``."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "score")
