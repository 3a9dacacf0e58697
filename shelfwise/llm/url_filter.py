"""URL filter: listed rules first, gradient-boosted trees for the rest.

The trees see lexical features only: lengths, depth, digits, hyphens, entropy
of the host, parameters, and how many hosts of the table share the host's last
two labels.  No feature names a host or counts labels of a host, so a host
cannot be learnt by heart.  They are trained on a bounded sample of labelled
URLs: hosts with a marked part are to be blocked, URLs that a rule allows are
not; all others have no label and are left out.  Rules that block say where a
page lies, not how its host is spelt, so they teach nothing here.  Parsing,
features, statistics and scores are DataFrame functions and Spark ML; no Python
runs on the executors.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import Scratch, packed, read, unpacked
from shelfwise.llm.registry import query

# Verdict and rule (host, then path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
# Parts of host names, between dots and hyphens, that mark a URL as one to block in training.
MARKED = ("ad", "ads", "advert", "bet", "bets", "casino", "malware", "phish", "poker", "porn", "spam", "track", "xxx")

#: Labelled URLs the trees are fit on, about, at most.
TRAIN_ROWS = 20_000
ROUNDS, DEPTH, SEED = 20, 4, 7
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first :// and the next / ? # or the end, in lower case; empty without ://."""
    part = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(part, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none does.

    ``rules`` is a short list.  A rule fits its host and all subdomains if the
    path starts with the rule's path.
    """
    name = verdict = F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, rest = rule[: rule.index("/")], rule[rule.index("/") :]
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def entropy(text: Column) -> Column:
    """Shannon entropy of a text's characters, in bits; 0 for empty."""
    parts = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: F.char_length(text) - F.char_length(F.replace(text, c, F.lit(""))),
    )
    n = F.greatest(F.char_length(text), F.lit(1))
    bits = F.aggregate(
        F.filter(parts, lambda k: k > 0), F.lit(0.0), lambda acc, k: acc - (k / n) * F.log2(k / n)
    )
    return F.when(F.char_length(text) > 0, bits).otherwise(F.lit(0.0))


LEXICAL = (
    "url_chars", "host_chars", "path_chars", "depth", "labels", "hyphens", "host_digits", "digits", "entropy",
    "parameters", "fragment", "secure", "vowels", "longest_label", "suffix_hosts",
)


def features(rows: DataFrame, scratch: Scratch, url_col: str = "url") -> DataFrame:
    """``rows`` with host, path and the features; a null url has the features of an empty one.

    ``rows`` should come from :func:`packed`, as the names of the new columns
    are common words.  ``suffix_hosts`` is the binary logarithm, rounded down,
    of one more than the hosts that share the last two labels, over all rows.
    """
    url = F.coalesce(F.col(url_col), F.lit(""))
    host, path = F.col("host"), F.col("path")
    count = lambda text, pattern: F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("double")
    share = lambda text, pattern: count(text, pattern) / F.greatest(F.char_length(text), F.lit(1))
    parts = F.split(host, r"\.")
    own = (
        rows.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
        .withColumns(
            {
                "url_chars": F.char_length(url).cast("double"),
                "host_chars": F.char_length(host).cast("double"),
                "path_chars": F.char_length(path).cast("double"),
                "depth": count(path, "/[^/]"),
                "labels": F.size(parts).cast("double"),
                "hyphens": count(host, "-"),
                "host_digits": share(host, "[0-9]"),
                "digits": share(url, "[0-9]"),
                "entropy": entropy(host),
                "parameters": count(F.regexp_extract(url, r"\?([^#]*)", 1), "[^&]+"),
                "fragment": url.contains("#").cast("double"),
                "secure": F.lower(url).startswith("https:").cast("double"),
                "vowels": share(host, "[aeiou]"),
                "longest_label": F.array_max(F.transform(parts, lambda x: F.char_length(x))).cast("double"),
                "suffix": F.concat_ws(".", F.slice(parts, -F.least(F.size(parts), F.lit(2)), 2)),
            }
        )
    )
    hosts = own.select("suffix", "host").distinct().groupBy("suffix").agg(F.count(F.lit(1)).alias("_hosts"))
    hosts = scratch.table(hosts.select("suffix", F.floor(F.log2(F.col("_hosts") + 1)).cast("double").alias("suffix_hosts")), "hosts")
    return own.join(hosts, "suffix")


def weak_label(host: Column, verdict: Column, marked=MARKED) -> Column:
    """1 for hosts with a marked part, 0 for other URLs that a rule allows, else null."""
    is_marked = F.exists(F.split(host, "[.-]"), lambda part: part.isin(*marked))
    return F.when(is_marked, 1.0).when(verdict == "allow", 0.0)


class UrlModel:
    """Boosted trees over ``LEXICAL``; without both classes in training, a score of 0 for every URL."""

    def __init__(self, trees=None):
        self.trees = trees

    @staticmethod
    def fit(labelled: DataFrame, scratch: Scratch, label: str = "label", most: int = TRAIN_ROWS) -> UrlModel:
        """Fit on the rows of ``features`` with a label, or on a share of either class by hash of host and path.

        Each class keeps about half of ``most`` rows; its rows weigh as much
        together as those of the other.
        """
        rows = labelled.where(F.col(label).isNotNull())
        sizes = {r["label"]: r["n"] for r in rows.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
        if len(sizes) < 2:
            return UrlModel()
        spot = (F.hash(F.lit(SEED), "host", "path").cast("double") + 2147483648.0) / 4294967296.0
        limits = [(value, min(1.0, most / 2 / n), 0.5 / min(n, most / 2)) for value, n in sizes.items()]
        share = F.coalesce(*[F.when(F.col(label) == value, F.lit(part)) for value, part, _ in limits])
        weight = F.coalesce(*[F.when(F.col(label) == value, F.lit(w)) for value, _, w in limits])
        sample = rows.where(spot < share).select(*LEXICAL, F.col(label).alias("label"), weight.alias("weight"))
        trees = GBTClassifier(
            featuresCol="_features", labelCol="label", weightCol="weight", maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, seed=SEED
        )
        return UrlModel(trees.fit(_vector(scratch.table(sample, "trained"))))

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """``df`` (rows of ``features``) with the probability that the URL is to be blocked."""
        if self.trees is None:
            return df.withColumn(out, F.lit(0.0))
        scored = self.trees.transform(_vector(df))
        return scored.withColumn(out, vector_to_array("probability")[1]).select(*df.columns, out)


def _vector(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(LEXICAL), outputCol="_features").transform(df)


def judge(df: DataFrame, scratch: Scratch, url_col: str = "url", rules=RULES, marked=MARKED, model: UrlModel | None = None) -> DataFrame:
    """``df`` with host, path, rule, score and verdict: the longest rule's, else block from a score of 0.5 on.

    They take the place of input columns of the same names.  The trees are
    trained on the table's own labelled URLs unless a model is given.  Null and
    odd URLs have an empty host and path; repeats repeat their result, an empty
    table gives none.
    """
    rows = features(packed(df, url=F.col(f"`{url_col}`")), scratch)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict})
    if model is None:
        model = UrlModel.fit(rows.withColumn("label", weak_label(F.col("host"), F.col("ruled"), marked)), scratch)
    trees = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    names = ("host", "path", "rule", "score")
    return model.score(rows).select(
        *unpacked(df.columns, **{n: F.col(n) for n in names}, verdict=F.coalesce(F.col("ruled"), trees))
    )


@query("op9_url_filter")
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    found = judge(read(spark, sf_dir, "pages").select("page_id", "url"), Scratch(spark, "urls"))
    return found.select("page_id", "host", "path", "rule", "verdict", "score")
