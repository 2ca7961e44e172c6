"""URL filters: rules first, then gradient-boosted trees on lexical features."""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from .common import join_groups, stored

#: Rules (host, path, verdict).
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
FEATURES = ["length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digit_ratio", "hyphens", "entropy", "parameters", "fragment", "suffix_rate", "suffix_magnitude", "token_rate", "token_magnitude"]
#: Hosts are dealt out to so many folds; those of fold 0 are held out of training.
FOLDS = 5
#: Labelled rows that the mean of all counts for in a suffix's share of blocked ones.
PRIOR = 10
#: What statistics are taken of: the host's last label, and the first step of the path.
KEYS = ("suffix", "token")


def with_parts(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host (A-Z lower-cased) and path; both empty where the url is null or has no ``://``."""
    has = F.coalesce(F.instr(F.col(url_col), "://") > 0, F.lit(False))
    rest = F.when(has, F.expr(f"substring(`{url_col}`, length(substring_index(`{url_col}`, '://', 1)) + 4)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return urls.withColumn("host", host).withColumn("path", F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1))


def fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    return ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])


def by_rules(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Adds rule (host and path of the longest one that fits, else null) and rule_verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the last condition added is tried first
        ok = fits(F.col("host"), F.col("path"), r)
        rule, verdict = F.when(ok, r[0] + r[1]).otherwise(rule), F.when(ok, r[2]).otherwise(verdict)
    return urls.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def with_features(urls: DataFrame) -> DataFrame:
    """Adds the lexical features of url, host and path, all but the suffix statistics."""
    url = F.coalesce("url", F.lit(""))
    n = F.length(url)
    digits = lambda c: F.length(F.regexp_replace(c, "[^0-9]", ""))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0)).cast("double")
    tallies = F.aggregate(F.split(url, ""), F.create_map().cast("map<string,int>"), lambda m, c: F.map_concat(F.map_filter(m, lambda k, _: k != c), F.create_map(c, F.coalesce(F.element_at(m, c), F.lit(0)) + 1)))
    entropy = F.aggregate(F.map_values(tallies), F.lit(0.0), lambda s, k: s - k / F.greatest(n, F.lit(1)) * F.log2(k / F.greatest(n, F.lit(1))))
    return urls.withColumns(
        {
            "length": n, "host_length": F.length("host"), "path_length": F.length("path"), "depth": F.regexp_count("path", F.lit("/")), "labels": F.regexp_count("host", F.lit(r"\.")) + 1,
            "digit_ratio": share(digits(url), n), "host_digit_ratio": share(digits(F.col("host")), F.length("host")), "hyphens": F.regexp_count(url, F.lit("-")),
            "entropy": F.when(n == 0, 0.0).otherwise(entropy), "parameters": F.regexp_count(url, F.lit("[?&][^?&#]+")), "fragment": F.contains(url, F.lit("#")).cast("int"),
            "suffix": F.regexp_extract("host", r"([^.]*)$", 1), "token": F.lower(F.regexp_extract("path", r"^/([^/]*)", 1)), "fold": (F.crc32(F.col("host").cast("binary")) % FOLDS).cast("int"),
        }
    )


def statistics(rows: DataFrame, key: str = "suffix") -> DataFrame:
    """(key, fold, <key>_count, labelled, bad, n) of all rows: by suffix (or token) its rows; and for each fold, of n rows, its labelled and blocked rows of the other folds but 0."""
    learn = F.when(F.col("fold") != 0, F.col("label"))
    per = rows.groupBy(key, "fold").agg(F.count("*").alias("n"), F.count(learn).alias("own"), F.coalesce(F.sum(learn), F.lit(0.0)).alias("own_bad"))
    total = per.groupBy(key).agg(F.sum("n").alias(f"{key}_count"), F.sum("own").alias("all"), F.sum("own_bad").alias("all_bad"))
    return per.join(total, key).select(key, "fold", f"{key}_count", (F.col("all") - F.col("own")).alias("labelled"), (F.col("all_bad") - F.col("own_bad")).alias("bad"), "n")


def judge_urls(
    urls: DataFrame, rules: list[tuple[str, str, str]] = RULES, labels: DataFrame | None = None, max_train: int = 20_000, trees: int = 10, depth: int = 4, id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per input row: (page_id, host, path, rule, verdict, block_score, held_out).

    The longest fitting rule decides; elsewhere boosted trees over lexical features do.  They
    learn from labelled urls, at most ``max_train`` of them, first by a hash of the url:
    ``labels`` (url, label: 1 to block, 0 to allow), else the verdicts of the rules.  Hosts of
    fold 0 (held_out) are never learned from, so that block_score can be measured on them.

    Statistics by the host's last label, and by the first step of the path, cover the whole
    table: the magnitude of its number of rows, and the share of blocked ones among the labelled
    rows of other folds of hosts, so a row's own label is no part of it, drawn towards the share
    of all.  Each sampled row is learned from twice, once as if its suffix and step had no
    labels, so that urls without them are judged by the other features.  A url is blocked if its
    score is above a half and above the share of blocked ones in the sample, so that what the
    features say decides, not that share.  If the sample has labels of one kind,
    that kind is the verdict; without labels it is allow.

    Null urls and those without ``://`` have an empty host and path, fit no rule and are
    judged by the trees.  Rows that repeat are judged each; a url with several labels counts
    with the greatest.  An empty table gives an empty result.  Other columns are ignored,
    whatever their names.
    """
    src = urls.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = with_features(by_rules(with_parts(src), rules))
    if labels is None:
        rows = rows.withColumn("label", (F.col("rule_verdict") == "block").cast("double"))
    else:
        rows = rows.join(labels.groupBy("url").agg(F.max("label").cast("double").alias("label")), "url", "left")
    sample = rows.filter("label is not null and fold != 0").orderBy(F.xxhash64("url"), "page_id").limit(max_train).cache()
    try:
        kinds = {r["label"] for r in sample.select("label").distinct().collect()}
        prior = 0.0
        if len(kinds) < 2:
            score = F.lit(1.0 if 1.0 in kinds else 0.0)
            judged = rows.withColumn("block_score", score)
        else:
            total = rows.count()
            n_labelled, n_bad = sample.agg(F.count("label"), F.sum("label")).first()
            prior = n_bad / n_labelled
            rate = (F.col("bad") + PRIOR * prior) / (F.col("labelled") + PRIOR)
            tables = {key: stored(statistics(rows, key).select(key, "fold", "n", F.floor(F.log10(f"{key}_count")).cast("double").alias(f"{key}_magnitude"), rate.alias(f"{key}_rate")), f"{key}-rates") for key in KEYS}

            def complete(df: DataFrame) -> DataFrame:
                for key, table in tables.items():  # a suffix of very many rows is broadcast, however many there are
                    df = join_groups(df, table, [key, "fold"], "n", total).drop("n")
                return df

            assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
            known = complete(sample)
            training = known.unionByName(known.withColumns({f"{key}_rate": F.lit(prior) for key in KEYS}))
            model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, maxBins=64).fit(assembler.transform(training).select("features", "label"))
            judged = model.transform(assembler.transform(complete(rows))).withColumn("block_score", vector_to_array("probability")[1])
    finally:
        sample.unpersist()
    verdict = F.coalesce("rule_verdict", F.when(F.col("block_score") > max(0.5, prior), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.col("block_score").cast("double").alias("block_score"), (F.col("fold") == 0).alias("held_out"))
