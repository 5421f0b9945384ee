"""URL filters: rules, and smoothed variable-order Markov models of accepted and rejected URLs for the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Rules as (verdict, host, path). Fixed values.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Longest context of the models, in characters.
ORDER = 4
#: Mark before a URL's first character; one fits every context length.
START = "\u0002"
#: Size of the alphabet that the shortest context falls back to.
SYMBOLS = 256
#: One of so many labelled URLs, by hash, is kept from the counts while the threshold is sought.
HELD = 4
#: Parts that a hot window's rows are dealt to, and the share of all rows (one in so many) from which a window is hot:
#: all URLs share their first windows.
SALT, HOT = 32, 1000
#: Steps of score, per character, at which the threshold is sought.
STEP = 0.01
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null without one; of equally long rules the last listed."""
    fit_rule, fit_verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        fit_rule = F.when(fits, rule_host + rule_path).otherwise(fit_rule)
        fit_verdict = F.when(fits, verdict).otherwise(fit_verdict)
    return fit_rule, fit_verdict


# ---------------------------------------------------------------------- models
def windows(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """Each URL's windows of ``order`` characters of context and one more, one row per character; other columns stay."""
    marked = F.concat(F.lit(START * order), F.col("url"))
    at = F.explode(F.sequence(F.lit(1), F.char_length("url")))
    return urls.where(F.char_length("url") > 0).withColumn("at", at).select(
        *[c for c in urls.columns if c != "url"], F.substring(marked, F.col("at"), F.lit(order + 1)).alias("window")
    )


def gram_counts(counted: DataFrame, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """(gram, context, allow, block) of all orders, and (context, all_, kinds_ of allow and block).

    ``counted`` has windows with their counts per class. A gram is a context
    and a character; ``all_`` and ``kinds_`` are a context's occurrences and
    distinct characters. All orders come from the counted windows, so the
    texts are read once.
    """
    tails = F.explode(F.array(*[F.substring("window", -k, k) for k in range(1, order + 2)]))
    grams = counted.select(tails.alias("gram"), "allow", "block").groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
    grams = materialise(grams.withColumn("context", F.expr("left(gram, char_length(gram) - 1)")), "url-grams")
    contexts = grams.groupBy("context").agg(
        F.sum("allow").alias("all_allow"),
        F.sum("block").alias("all_block"),
        F.count_if(F.col("allow") > 0).alias("kinds_allow"),
        F.count_if(F.col("block") > 0).alias("kinds_block"),
    )
    return grams, materialise(contexts, "url-contexts")


def window_scores(wanted: DataFrame, grams: DataFrame, contexts: DataFrame, order: int = ORDER) -> DataFrame:
    """(window, gain): log of the accepted model's probability of the last character over the rejected model's.

    Each order's estimate is smoothed towards the shorter context's by the
    number of characters seen after the context (Witten-Bell), so a context
    that a class has never had passes the shorter one's estimate on.
    """
    ks = F.explode(F.sequence(F.lit(1), F.lit(order + 1))).alias("k")
    rows = wanted.select("window", ks).withColumn("gram", F.expr("right(window, k)")).withColumn("context", F.expr("left(gram, k - 1)"))
    rows = rows.join(grams.select("gram", "allow", "block"), "gram", "left").join(contexts, "context", "left")
    numbers = ["allow", "block", "all_allow", "all_block", "kinds_allow", "kinds_block"]
    rows = rows.groupBy("window").agg(
        F.array_sort(F.collect_list(F.struct("k", *[F.coalesce(n, F.lit(0)).cast("double").alias(n) for n in numbers]))).alias("orders")
    )

    def chance(name: str) -> Column:
        def step(p: Column, o: Column) -> Column:
            seen, kinds = o[f"all_{name}"], o[f"kinds_{name}"]
            return F.when(seen + kinds > 0, (o[name] + kinds * p) / (seen + kinds)).otherwise(p)

        return F.aggregate("orders", F.lit(1.0 / SYMBOLS), step)

    return rows.select("window", (F.log(chance("allow")) - F.log(chance("block"))).alias("gain"))


@dataclass
class UrlModel:
    grams: DataFrame
    contexts: DataFrame
    threshold: float
    order: int = ORDER

    def score(self, urls: DataFrame) -> DataFrame:
        """(page_key, score): log-likelihood difference per character; empty URLs have no row."""
        spread = materialise(windows(urls.select("page_key", "url"), self.order), "url-windows")
        counted = materialise(spread.groupBy("window").agg(F.count("*").alias("n")), "url-window-counts")
        rows = counted.agg(F.sum("n")).scalar()
        # at most HOT windows hold so large a share each
        hot = counted.where(F.col("n") * HOT > rows).select("window", F.lit(True).alias("hot"))
        gains = window_scores(counted.select("window"), self.grams, self.contexts, self.order).join(F.broadcast(hot), "window", "left")
        parts = F.when(F.col("hot"), SALT - 1).otherwise(0)
        gains = gains.withColumn("salt", F.explode(F.sequence(F.lit(0), parts))).drop("hot")
        salt = F.when(F.col("hot"), F.pmod(F.xxhash64("page_key"), F.lit(SALT)).cast("int")).otherwise(0)
        spread = spread.join(F.broadcast(hot), "window", "left").withColumn("salt", salt)
        return spread.join(gains, ["window", "salt"]).groupBy("page_key").agg(F.avg("gain").alias("score"))


def fit(labelled: DataFrame, order: int = ORDER) -> UrlModel:
    """Models of the accepted and rejected URLs, and the threshold between them.

    ``labelled`` has page_key, url, verdict. Models of three of four URLs, by
    hash, score the others; these scores give the threshold with the fewest
    errors weighted by class (the smallest of equal ones nearest zero), from
    counts per step of score. The models returned count all labelled URLs. One
    pass over the URLs counts both.
    """
    held = F.pmod(F.xxhash64("url"), F.lit(HELD)) == 0
    spread = windows(labelled.select("url", "verdict", held.alias("held")), order)
    allow, block, own = F.col("verdict") == "allow", F.col("verdict") == "block", ~F.col("held")
    counted = spread.groupBy("window").agg(
        F.count_if(allow).alias("allow"),
        F.count_if(block).alias("block"),
        F.count_if(allow & own).alias("own_allow"),
        F.count_if(block & own).alias("own_block"),
    )
    counted = materialise(counted, "url-counts")
    part = counted.where("own_allow + own_block > 0").select("window", F.col("own_allow").alias("allow"), F.col("own_block").alias("block"))
    trial = UrlModel(*gram_counts(part, order), 0.0, order)
    apart = labelled.where(held).select("page_key", "url", "verdict")
    bins = trial.score(apart).join(apart.select("page_key", "verdict"), "page_key").groupBy(F.floor(F.col("score") / STEP).alias("bin"))
    rows = bins.agg(F.count_if(F.col("verdict") == "allow").alias("allow"), F.count_if(F.col("verdict") == "block").alias("block")).orderBy("bin").collect()
    threshold = best_threshold([(r["bin"], r["allow"], r["block"]) for r in rows])
    return UrlModel(*gram_counts(counted.select("window", "allow", "block"), order), threshold, order)


def best_threshold(bins: list[tuple[int, int, int]]) -> float:
    """Score from which URLs are accepted; 0 unless both classes were seen."""
    allow, block = sum(a for _, a, _ in bins), sum(b for _, _, b in bins)
    if not allow or not block:
        return 0.0
    lost, kept = 0.0, 1.0  # shares of accepted URLs below and rejected URLs above the candidate
    best = [(lost + kept, abs(bins[0][0] * STEP), bins[0][0] * STEP)]
    for n, a, b in bins:
        lost, kept = lost + a / allow, kept - b / block
        at = (n + 1) * STEP
        best.append((round(lost + kept, 12), abs(at), at))
    return min(best)[2]


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, order: int = ORDER) -> DataFrame:
    """(page_id, host, path, rule, verdict, score), a row per row of ``pages``.

    URLs that a rule fits get its verdict and teach the models. The others get
    the method's: allow if their log-likelihood difference per character
    (``score``, null where a rule fits) reaches the threshold. Null and empty
    URLs, and those without ``://``, have empty host and path; where there is
    no character to score the score is 0. Without both verdicts among the
    rules' URLs all scores are 0 and the verdict is allow.
    """
    urls = pages.select(pages["page_id"].cast("long").alias("page_id"), F.coalesce(pages["url"].cast("string"), F.lit("")).alias("url"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    urls = urls.withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = urls.withColumns({"rule": rule, "fixed": verdict})
    # equal URLs have equal scores: the method works on distinct ones, named by digest
    keyed = materialise(urls.withColumn("page_key", F.sha2("url", 256)), "urls")
    distinct = keyed.groupBy("page_key").agg(F.first("url").alias("url"), F.first("fixed").alias("verdict"))
    distinct = materialise(distinct, "distinct-urls")
    seen = {r["verdict"] for r in distinct.where("verdict is not null").select("verdict").distinct().collect()}
    if seen >= {"allow", "block"}:
        model = fit(distinct.where("verdict is not null"), order)
        scored = model.score(distinct.where("verdict is null"))
        threshold = model.threshold
    else:
        scored, threshold = distinct.select("page_key", F.lit(0.0).alias("score")).where("verdict is null"), 0.0
    score = F.when(F.col("rule").isNull(), F.coalesce("score", F.lit(0.0)))
    return keyed.join(scored, "page_key", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("fixed", F.when(score >= threshold, "allow").otherwise("block")).alias("verdict"),
        score.alias("score"),
    )
