"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

Urls that a rule decides are the labelled urls. The trees learn from them and
judge the urls that no rule fits. Features: lengths, depth, digit ratio,
entropy of the characters, parameter counts, marks, and suffix statistics (how
often the labelled urls under the last one and last two labels are blocked,
smoothed, more so where one rule made all their labels; a url the trees learn
from does not count its own label). Everything is DataFrame functions and MLlib's tree learner; rows of
pages are not shuffled unless the suffix table outgrows a broadcast, in which
case adaptive execution splits hot suffixes.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from countlake.session import write_through

#: Fixed values: (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Distinct labelled urls the trees learn from, about, half of them of each label where there
#: are as many; chosen by a hash, and weighed by the rows they stand for.
TRAIN_ROWS = 20_000
TREES, DEPTH = 15, 4
#: Labelled urls that a suffix counts as having besides its own, at the overall rate.
PRIOR = 20.0
#: The same where one rule made all labels of the suffix: they say little about others.
ONE_RULE_PRIOR = 500.0
SEED = 11

_PARTS = r"://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """What follows the first ``://``, in lower case; empty if there is none."""
    found = F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit(""))
    return F.translate(found, _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of its text and verdict; else null.

    A rule fits its host and all subdomains, for paths that start with its own.
    """
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, where, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == where) | host.endswith(f".{where}")) & path.startswith(start)
        named = F.struct(F.lit(where + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text)

    def term(c: Column) -> Column:
        share = (size - F.length(F.replace(text, c, F.lit("")))) / size
        return -share * F.log2(share)

    terms = F.transform(F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")), term)
    return F.coalesce(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), F.lit(0.0))


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Lexical features of a url, all of them numbers."""
    text = F.coalesce(url, F.lit(""))
    size = F.length(text)

    def marks(of: Column, pattern: str) -> Column:
        return F.regexp_count(of, F.lit(pattern))

    return {
        "f_length": size,
        "f_host_length": F.length(host),
        "f_path_length": F.length(path),
        "f_depth": marks(path, "/[^/]"),
        "f_labels": marks(host, r"[^.]+"),
        "f_digits": _share(marks(text, "[0-9]"), size),
        "f_host_digits": _share(marks(host, "[0-9]"), F.length(host)),
        "f_hyphens": marks(host, "-"),
        "f_entropy": _entropy(text),
        "f_host_entropy": _entropy(host),
        "f_parameters": marks(text, r"[?&][^=&#]+="),
        "f_fragment": F.contains(text, F.lit("#")).cast("int"),
        "f_secure": F.startswith(text, F.lit("https:")).cast("int"),
        "f_slash_end": F.endswith(path, F.lit("/")).cast("int"),
    }


def judge(
    pages: DataFrame,
    *,
    url: str = "url",
    key: str = "page_id",
    rules=RULES,
    train_rows: int = TRAIN_ROWS,
    trees: int = TREES,
    depth: int = DEPTH,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``pages``: key, host, path, rule, verdict, block_score.

    ``rule`` is null where none fits; ``block_score`` (probability of block) is
    null where one does. Null urls and urls without ``://`` have empty host and
    path and are judged by the trees like others. Repeated rows are judged
    alike. If the rules label urls in one way only, or none, the others get
    that label, or allow. Other columns are left out. An empty table gives an
    empty result.
    """
    parts = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), host(F.col(url)).alias("host"),
        path(F.col(url)).alias("path"),
    )
    labels = F.split("host", r"\.")
    found = features(F.col("url"), F.col("host"), F.col("path"))
    rows = write_through(
        parts.select(
            "key",
            "host",
            "path",
            F.xxhash64(F.lit(seed), "url").alias("url_hash"),
            F.element_at(labels, -1).alias("last"),
            F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), ".").alias("last_two"),
            rule_of(F.col("host"), F.col("path"), rules).alias("ruled"),
            *[c.cast("double").alias(n) for n, c in found.items()],
        ),
        "url-features",
    )
    blocked = (F.col("ruled.verdict") == "block").cast("double")
    known = rows.where("ruled is not null")
    seen = known.agg(F.count(F.lit(1)).alias("n"), F.sum(blocked).alias("b")).first()
    if not seen.n or seen.b in (0, seen.n):
        other = F.lit("block" if seen.n and seen.b else "allow")
        return rows.select(
            "key",
            "host",
            "path",
            F.col("ruled.rule").alias("rule"),
            F.coalesce("ruled.verdict", other).alias("verdict"),
            F.lit(None).cast("double").alias("block_score"),
        ).withColumnRenamed("key", key)
    rate = seen.b / seen.n
    full = rows
    for name in ("last", "last_two"):
        few = F.min("ruled.rule") == F.max("ruled.rule")
        stats = known.groupBy(name).agg(
            F.sum(blocked).alias(f"b_{name}"),
            F.count(F.lit(1)).cast("double").alias(f"n_{name}"),
            F.when(few, ONE_RULE_PRIOR).otherwise(PRIOR).alias(f"p_{name}"),
        )
        full = full.join(stats, name, "left").fillna(
            {f"b_{name}": 0.0, f"n_{name}": 0.0, f"p_{name}": PRIOR}
        )
    full = write_through(full, "url-suffixes")

    def suffix_rates(own: Column) -> list[Column]:
        """Rates of both suffixes, less ``own`` rows of the url itself."""
        return [
            (
                (F.col(f"b_{x}") - own * F.coalesce(blocked, F.lit(0.0)) + F.col(f"p_{x}") * rate)
                / (F.col(f"n_{x}") - own + F.col(f"p_{x}"))
            ).alias(f"f_{x}")
            for x in ("last", "last_two")
        ]

    names = [*found, "f_last", "f_last_two"]
    urls = write_through(
        full.where("ruled is not null").groupBy("url_hash", blocked.alias("label")).agg(
            F.count(F.lit(1)).cast("double").alias("own"),
            F.first(F.struct(*[c for c in full.columns if c != "url_hash"])).alias("row"),
        ),
        "url-labelled",
    )
    counts = {r.label: r["count"] for r in urls.groupBy("label").count().collect()}
    share = F.lit(0.0)
    for label, n in counts.items():
        share = F.when(F.col("label") == label, min(1.0, train_rows / len(counts) / n)).otherwise(share)
    spread = F.pmod(F.col("url_hash"), F.lit(1 << 40))
    sample = (
        urls.withColumn("share", share)
        .where(spread < F.col("share") * F.lit(float(1 << 40)))
        .select("label", "own", (F.col("own") / F.col("share")).alias("weight"), "row.*")
        .select("label", "weight", *found, *suffix_rates(F.col("own")))
    )
    full = full.select("*", *suffix_rates(F.lit(0.0)))
    pack = VectorAssembler(inputCols=names, outputCol="features")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed, weightCol="weight").fit(
        pack.transform(sample).select("features", "label", "weight")
    )
    score = vector_to_array(F.col("probability"))[1]
    return (
        model.transform(pack.transform(full))
        .withColumn("block_score", F.when(F.col("ruled").isNull(), score))
        .select(
            "key",
            "host",
            "path",
            F.col("ruled.rule").alias("rule"),
            F.coalesce(
                "ruled.verdict",
                F.when(F.col("block_score") >= 0.5, F.lit("block")).otherwise(F.lit("allow")),
            ).alias("verdict"),
            "block_score",
        )
        .withColumnRenamed("key", key)
    )
