"""URL filter: host and path rules, and boosted trees on lexical features for the rest.

Only DataFrame expressions are used. The trees are grown level by level from gradient
histograms: one aggregation per level over a bounded sample of labelled URLs, of which
the driver receives the best split of each open node. Scoring is one expression.

The rates of blocked URLs by suffix and by first path segment are counted over all distinct
labelled URLs and joined back, however many there are. URLs fall into FOLDS parts by a hash:
one learned from is given the rates of the other parts, so that a rate never holds its own
label; one that is scored is given the rates of all.

Host and path of a null URL, or one without `://`, are empty; such a URL fits no rule and
is judged by the trees, as is an empty one. Repeated rows are judged alike. Without
labelled URLs the trees are empty and their verdict is allow.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradeloom.llm.tables import bounded_sample, table, written
from tradeloom.operators.lookups import lookup_join

#: (host, path, verdict); a rule fits its host and all subdomains.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Labelled URLs learned from, bins per feature.
SAMPLE_ROWS, BINS = 20_000, 24
TREES, DEPTH, RATE, PENALTY = 12, 3, 0.4, 1.0
#: Files of the binned sample, read once per level of each tree.
BIN_FILES = 8
#: Parts of which one learned from is given the rates of the others.
FOLDS = 8
#: Weight of the overall rate in a suffix's rate.
PRIOR_WEIGHT = 20.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without `://`."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWERED)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, prefix, said in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        rule = F.when(fits, name + prefix).otherwise(rule)
        verdict = F.when(fits, said).otherwise(verdict)
    return rule, verdict


def with_lexical(pages: DataFrame) -> DataFrame:
    """The columns needed here and the lexical features f0, f1, ... of url, host and path."""
    url = F.coalesce("url", F.lit(""))
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    repeats = F.aggregate(
        F.array_distinct(F.split(url, "")),
        F.lit(0.0),
        lambda total, sign: total + _repeat_cost(F.length(url) - F.length(F.replace(url, sign, F.lit("")))),
    )
    listed = [
        F.length(url),
        F.length("host"),
        F.length("path"),
        F.size(F.split("path", "/")),
        F.size(F.split("host", r"\.")),
        F.regexp_count(url, F.lit("[0-9]")) / size,
        F.regexp_count(url, F.lit("[^A-Za-z0-9]")) / size,
        F.log2(size) - repeats / size,
        F.when(query == "", 0).otherwise(F.regexp_count(query, F.lit("&")) + 1),
        F.length(F.regexp_extract("path", r"^/([^/]*)", 1)),
        F.length(F.regexp_extract("path", r"([^/]*)/?$", 1)),
        F.length(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)),
        F.regexp_count("host", F.lit("-")),
    ]
    return pages.withColumns(
        {f"f{i}": value.cast("double") for i, value in enumerate(listed)}
        | {"suffix": F.substring_index("host", ".", -1), "segment": F.regexp_extract("path", r"^/([^/]*)", 1)}
    )


def _repeat_cost(count: Column) -> Column:
    n = F.greatest(count, F.lit(1)).cast("double")
    return n * F.log2(n)


#: Features of the text alone, and the keys whose rates of blocked URLs are further ones.
LEXICAL, RATED = 13, ("suffix", "segment")


@dataclass
class Node:
    """A split (feature at most the edge goes left) or, without feature, a leaf."""

    value: float = 0.0
    feature: int | None = None
    edge: int = 0
    left: "Node | None" = None
    right: "Node | None" = None


@dataclass
class UrlModel:
    counts: DataFrame | None = None
    prior: float = 0.0
    edges: list[list[float]] = field(default_factory=list)
    base: float = -4.0
    trees: list[Node] = field(default_factory=list)

    def margin(self) -> Column:
        """Sum of all trees over raw features."""
        return self._sum(lambda node: F.col(f"f{node.feature}") <= self.edges[node.feature][node.edge])

    def binned_margin(self) -> Column:
        """The same over the bins of features."""
        return self._sum(goes_left)

    def _sum(self, left: Callable[[Node], Column]) -> Column:
        return functools.reduce(lambda a, b: a + b, (_value(tree, left) for tree in self.trees), F.lit(self.base))


def goes_left(node: Node) -> Column:
    return F.col(f"b{node.feature}") <= node.edge


def _value(node: Node, left: Callable[[Node], Column]) -> Column:
    if node.feature is None:
        return F.lit(node.value)
    return F.when(left(node), _value(node.left, left)).otherwise(_value(node.right, left))


def _part() -> Column:
    return F.pmod(F.xxhash64("url", F.lit(9)), F.lit(FOLDS)).cast("int")


def rate_counts(known: DataFrame) -> DataFrame:
    """kind (a key of RATED), value, and `parts`: n URLs and k blocked ones of every part."""
    urls = known.groupBy("url").agg(*[F.max(c).alias(c) for c in ("blocked", *RATED)])
    pairs = F.explode(F.array([F.struct(F.lit(key).alias("kind"), F.col(key).alias("value")) for key in RATED]))
    rows = urls.select(_part().alias("part"), "blocked", pairs.alias("at"))
    parts = [
        F.struct(F.count_if(F.col("part") == i).alias("n"), F.count_if((F.col("part") == i) & (F.col("blocked") == 1)).alias("k"))
        for i in range(FOLDS)
    ]
    return rows.groupBy("at.kind", "at.value").agg(F.array(*parts).alias("parts"))


def with_rates(rows: DataFrame, model: UrlModel, apart: bool) -> DataFrame:
    """The rate features; `apart` leaves out the part that a URL is in."""
    for i, key in enumerate(RATED):
        rate = F.lit(model.prior)
        if model.counts is not None:
            counted = model.counts.where(F.col("kind") == key).select(F.col("value").alias(key), F.col("parts").alias(f"_{key}"))
            rows = lookup_join(rows, counted, key, "left")
            parts = F.col(f"_{key}")
            n, k = (sum((parts[j][c] for j in range(FOLDS)), F.lit(0)) for c in ("n", "k"))
            if apart:
                n, k = n - parts[_part()]["n"], k - parts[_part()]["k"]
            smoothed = (k + PRIOR_WEIGHT * model.prior) / (n + PRIOR_WEIGHT)
            rate = F.coalesce(F.round(smoothed, 6), rate)
        rows = rows.withColumn(f"f{LEXICAL + i}", rate).drop(f"_{key}")
    return rows


def _leaf_number(node: Node, leaves: list[Node]) -> Column:
    if node.feature is None:
        leaves.append(node)
        return F.lit(len(leaves) - 1)
    left = _leaf_number(node.left, leaves)
    right = _leaf_number(node.right, leaves)
    return F.when(goes_left(node), left).otherwise(right)


def best_splits(rows: DataFrame, leaf: Column, margin: Column, features: int) -> list:
    """For each open leaf the split of the largest gain, from gradient histograms."""
    chance = 1 / (1 + F.exp(-margin))
    bins = F.array([F.col(f"b{i}") for i in range(features)])
    slopes = rows.select(
        leaf.alias("leaf"), (F.col("blocked") - chance).alias("g"), (chance * (1 - chance)).alias("h"), bins.alias("bins")
    )
    cells = (
        slopes.select("leaf", "g", "h", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("leaf", "feature", "bin")
        .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        .coalesce(1)  # leaves x features x bins, whatever the number of URLs
    )
    upto = Window.partitionBy("leaf", "feature").orderBy("bin")
    whole = Window.partitionBy("leaf", "feature")
    sums = cells.select(
        "leaf", "feature", "bin",
        F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
        F.sum("g").over(whole).alias("g"), F.sum("h").over(whole).alias("h"),
    )
    score = lambda g, h: g * g / (h + PENALTY)
    gain = score(F.col("gl"), F.col("hl")) + score(F.col("g") - F.col("gl"), F.col("h") - F.col("hl")) - score(F.col("g"), F.col("h"))
    ranked = sums.withColumn("gain", F.round(gain, 6))
    return (
        ranked.groupBy("leaf")
        .agg(F.max_by(F.struct("feature", "bin", "gl", "hl", "g", "h", "gain"), F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("best"))
        .select("leaf", "best.*")
        .collect()
    )


def learn_urls(labelled: DataFrame) -> UrlModel:
    """Trees learned from lexical features and `blocked` (0 or 1) of distinct URLs; null
    labels are left out."""
    known = labelled.where(F.col("blocked").isNotNull())
    columns = ["url", "blocked", *RATED, *(f"f{i}" for i in range(LEXICAL))]
    urls = known.select("url").distinct().count()
    some = bounded_sample(known, "url", SAMPLE_ROWS, salt=3, count=urls).dropDuplicates(["url"])
    sample = written(some.select(*columns), "urls")
    total, positive = sample.agg(F.count("*"), F.coalesce(F.sum("blocked"), F.lit(0))).first()
    if not total:
        return UrlModel()
    model = UrlModel(written(rate_counts(known), "url_rates"), prior=positive / total)
    sample = with_rates(sample, model, apart=True)
    features = LEXICAL + len(RATED)
    steps = [i / BINS for i in range(1, BINS)]
    cuts = sample.agg(*[F.percentile_approx(f"f{i}", steps, 10_000) for i in range(features)]).first()
    model.edges = [sorted(set(x)) for x in cuts]
    binned = [
        functools.reduce(lambda a, b: a + b, [(F.col(f"f{i}") > edge).cast("int") for edge in edges]).alias(f"b{i}")
        for i, edges in enumerate(model.edges)
    ]
    rows = written(sample.select("blocked", *binned).coalesce(BIN_FILES), "url_bins")
    odds = (positive + 1) / (total - positive + 1)
    model.base = round(math.log(odds), 6)
    for _ in range(TREES):
        root = Node()
        margin = model.binned_margin()
        for _ in range(DEPTH):
            leaves: list[Node] = []
            number = _leaf_number(root, leaves)
            for found in best_splits(rows, number, margin, features):
                node = leaves[found["leaf"]]
                if found["gain"] > 0 and found["bin"] < len(model.edges[found["feature"]]):
                    step = lambda g, h: round(RATE * g / (h + PENALTY), 6)
                    node.feature, node.edge = found["feature"], found["bin"]
                    node.left = Node(step(found["gl"], found["hl"]))
                    node.right = Node(step(found["g"] - found["gl"], found["h"] - found["hl"]))
        if root.feature is None:
            break
        model.trees.append(root)
    return model


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule and verdict; labels are the verdicts of the rules."""
    host, path = url_parts(F.col("url"))
    parts = pages.select(F.col("page_id"), F.col("url"), host.alias("host"), path.alias("path"))
    rule, said = longest_rule(F.col("host"), F.col("path"), rules)
    ruled = with_lexical(parts).withColumns({"rule": rule, "said": said})
    ruled = ruled.withColumn("blocked", F.when(F.col("said") == "block", 1).when(F.col("said") == "allow", 0))
    model = learn_urls(ruled)
    scored = with_rates(ruled, model, apart=False).withColumn("margin", model.margin())
    learned = F.when(F.col("margin") > 0, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("said", learned).alias("verdict"), F.round(1 / (1 + F.exp(-F.col("margin"))), 6).alias("block_score")
    )


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))
