"""URL filters: fixed host and path rules, and association rules mined from labelled URLs.

A URL is a set of tokens: its host's labels, its path's segments (digits as one token, file
endings apart) and the names of its query's fields. Spark's FP-growth mines the token
combinations of the labelled URLs together with their label; the combinations that imply a bad
label with enough support and confidence are the rules, unless all but one of their tokens are a
rule of at least that confidence. Tokens that lie on the same pages are mined as one, so that a
template of many fixed tokens does not make a combination for each subset of them. Each rule is
filed under its rarest tokens, so a URL is compared only with rules that could match it.

All work is in DataFrame functions. Defined cases: a null URL or one without ``://`` has an
empty host and path, fits no rule and is allowed; repeated rows give a row each; a page with
several labels counts once per label; without labels of the bad kind there are no mined rules;
extra columns are kept by :func:`judged` unless they have one of its column names, which are
replaced.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import ascii_lower, dropped, kept

MIN_SUPPORT = 0.001
MIN_CONFIDENCE = 0.8
MIN_PAGES = 5
# Mined rules up to this number are broadcast; more are joined by shuffle.
MAX_BROADCAST = 100_000
BAD = "label=bad"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, from after the first ``://``, in lower case, and path."""
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.regexp_extract(F.coalesce(url, F.lit("")), pattern, k)
    return ascii_lower(part(1)), part(2)


def url_tokens(url: Column) -> Column:
    """Distinct tokens: ``h:label``, ``p:segment``, ``q:field``."""
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)\??([^#]*)"
    part = lambda k: F.regexp_extract(ascii_lower(F.coalesce(url, F.lit(""))), pattern, k)
    named = lambda kind, items: F.transform(
        F.filter(items, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x)
    )
    segments = F.transform(
        F.split(part(2), r"[/.]"), lambda s: F.when(F.rlike(s, F.lit(r"\A\d+\z")), "0").otherwise(s)
    )
    fields = F.transform(F.split(part(3), "&"), lambda f: F.regexp_extract(f, r"\A[^=]*", 0))
    return F.array_distinct(
        F.concat(
            named("h:", F.split(part(1), r"[.:@]")), named("p:", segments), named("q:", fields)
        )
    )


def _token_classes(each: DataFrame, least: float) -> DataFrame:
    """``(token, name, members)`` of tokens on ``least`` pages: those that always occur together.

    Tokens of one class lie on the same pages. Mined one by one they would make a combination
    for each subset of the class, all with the same pages.
    """
    same = ["n", "total", "mixed"]
    counted = each.groupBy("token").agg(
        F.count("*").alias("n"),
        F.sum(F.col("page").cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64("page", F.lit("pages"))).alias("mixed"),
    )
    classes = counted.filter(F.col("n") >= least).groupBy(*same).agg(
        F.sort_array(F.collect_set("token")).alias("members")
    )
    return classes.select(F.explode("members").alias("token"), F.get("members", F.lit(0)).alias("name"), "members", "n")


def mine_rules(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``(anchors, tokens, classes, confidence)`` from ``labelled``: ``url`` and the boolean ``bad``.

    A rule needs a share of ``min_support`` of the labelled pages and ``min_pages`` of them. Its
    ``tokens`` each stand for a class of tokens that always occur together; a URL fits if it has
    a token of each of the ``classes``. ``anchors`` is the class on the fewest pages.
    """
    rows, path = kept(
        labelled.filter(F.col("bad").isNotNull()).select(
            F.monotonically_increasing_id().alias("row"),
            "bad",
            url_tokens(F.col("url")).alias("tokens"),
            F.xxhash64("url").alias("page"),
        ).filter("bad or size(tokens) > 0"),
        "labelled-urls",
    )
    n = rows.count()
    support = min(1.0, max(min_support, min_pages / max(n, 1)))
    each = rows.select("row", "page", F.explode("tokens").alias("token"))
    # A token of a class lies on a share of ``support`` of the pages, so there are at most as many
    # as the mean number of tokens divided by that share.
    classes, classes_path = kept(_token_classes(each, support * n), "url-classes")
    named = each.join(F.broadcast(classes.select("token", "name")), "token")
    named = named.groupBy("row").agg(F.collect_set("name").alias("names"))
    names = F.coalesce("names", F.array().cast("array<string>"))
    baskets = rows.join(named, "row", "left").select(
        F.when(F.col("bad"), F.concat(names, F.array(F.lit(BAD)))).otherwise(names).alias("items")
    )
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    rules = (
        model.associationRules.filter(F.col("consequent") == F.array(F.lit(BAD)))
        .select(F.sort_array("antecedent").alias("tokens"), "confidence")
    )
    # A rule goes if it is one of at least its confidence without one of its tokens.
    parts = rules.select(
        "tokens",
        "confidence",
        F.explode(F.transform("tokens", lambda t: F.array_remove(F.col("tokens"), t))).alias("part"),
    )
    general = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("part_confidence"))
    needless = (
        parts.join(general, "part").filter("part_confidence >= confidence").select("tokens").distinct()
    )
    left = rules.join(needless, "tokens", "left_anti")
    own = classes.filter("token = name").select("name", "members", "n")
    found = (
        left.select("tokens", "confidence", F.explode("tokens").alias("name"))
        .join(own, "name")
        .groupBy("tokens", "confidence")
        .agg(
            F.min(F.struct("n", "name", "members"))["members"].alias("anchors"),
            F.collect_list("members").alias("classes"),
        )
    )
    found, _ = kept(found.select("anchors", "tokens", "classes", "confidence"), "url-rules")
    dropped(labelled, path)
    dropped(labelled, classes_path)
    return found


def bad_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``url`` values that have a token of each class of a mined rule."""
    urls = pages.select("url").filter("url is not null").distinct()
    own = urls.select("url", url_tokens(F.col("url")).alias("own")).select(
        "url", "own", F.explode("own").alias("anchor")
    )
    n = rules.count()
    filed = rules.select("classes", F.explode("anchors").alias("anchor"))
    filed = F.broadcast(filed) if n <= MAX_BROADCAST else filed
    fits = F.forall("classes", lambda c: F.arrays_overlap(c, F.col("own")))
    return own.join(filed, "anchor").filter(fits).select("url").distinct()


def fixed_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest of ``(host, path, verdict)`` that fits, as ``(rule, verdict)``, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        rule = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, rule).otherwise(found)
    return found


def judged(
    pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]], **limits
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to the pages.

    A page that no fixed rule fits is blocked if its URL matches a mined rule.
    """
    host, path = url_parts(F.col("url"))
    bad = bad_urls(pages, mine_rules(labelled, **limits)).select("url", F.lit(True).alias("_mined"))
    own = pages.drop("host", "path", "rule", "verdict", "_mined")
    fixed = fixed_rule(host, path, rules)
    return (
        own.join(bad, "url", "left")
        .withColumns({"host": host, "path": path, "rule": fixed["rule"]})
        .withColumn(
            "verdict",
            F.coalesce(
                fixed["verdict"], F.when(F.col("_mined"), "block").otherwise("allow")
            ),
        )
        .select(*own.columns, "host", "path", "rule", "verdict")
    )
