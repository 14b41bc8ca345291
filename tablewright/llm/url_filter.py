"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

A rule blocks or allows a host with its subdomains below a path; the longest that fits decides.
The urls that rules decide are the labelled ones: from them each suffix gets its share of blocked
urls, and the trees learn to judge urls that no rule knows.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.base import Work

# Verdict, host, path: fixed values of the registered query.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SAMPLE = 20_000                # labelled urls the trees learn from, about
TREES, DEPTH = 12, 4
PRIOR = 10.0                   # labelled urls that a suffix's share is drawn to the mean by

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(df: DataFrame, url: str) -> DataFrame:
    """Add `host` and `path`. Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z
    lower-cased; path: from there up to `?`, `#` or the end. Both are empty for a null url or one
    without `://`."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return df.withColumn("host", F.translate(F.regexp_extract(rest, "(?s)^[^/?#]*", 0),
                                             UPPER, LOWER)) \
        .withColumn("path", F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1))


def rule_name(host: str, path: str) -> str:
    return host + path


def with_rule(df: DataFrame, rules) -> DataFrame:
    """Add `rule` and `ruled`: the longest fitting rule's name and verdict, or nulls. Of rules
    equally long the first given."""
    name = verdict = F.lit(None).cast("string")
    shortest_first = sorted(reversed(rules), key=lambda r: len(rule_name(r[1], r[2])))
    for decision, host, path in shortest_first:           # the last that fits is the longest
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) \
            & F.col("path").startswith(path)
        name = F.when(fits, F.lit(rule_name(host, path))).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return df.withColumn("rule", name).withColumn("ruled", verdict)


def _count_of(text: str, pattern: str) -> F.Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def lexical(df: DataFrame, url: str) -> tuple[DataFrame, list[str]]:
    """Add the lexical features of a url: lengths, depth, shares, entropy and counts."""
    u = F.coalesce(F.col(url), F.lit(""))
    df = df.withColumn("f_text", u)
    length = F.greatest(F.length("f_text"), F.lit(1)).cast("double")
    characters = F.array_distinct(F.filter(F.split("f_text", ""), lambda c: c != ""))
    share = F.transform(characters, lambda c: (
        F.length("f_text") - F.length(F.replace(F.col("f_text"), c, F.lit("")))) / length)
    entropy = F.aggregate(share, F.lit(0.0), lambda total, p: total - p * F.log2(p))
    query = F.regexp_extract("f_text", "(?s)\\?([^#]*)", 1)
    df = df.withColumn("f_query", query)
    features = {
        "f_length": F.length("f_text"),
        "f_host_length": F.length("host"),
        "f_path_length": F.length("path"),
        "f_depth": F.length("path") - F.length(F.replace(F.col("path"), F.lit("/"), F.lit(""))),
        "f_labels": F.length("host") - F.length(F.replace(F.col("host"), F.lit("."), F.lit(""))),
        "f_digits": _count_of("f_text", "[0-9]") / length,
        "f_host_digits": _count_of("host", "[0-9]"),
        "f_hyphens": _count_of("host", "-"),
        "f_entropy": entropy,
        "f_parameters": F.when(F.length("f_query") > 0, _count_of("f_query", "&") + 1)
        .otherwise(0),
        "f_fragment": F.instr(F.col("f_text"), "#") > 0,
        "f_secure": F.col("f_text").startswith("https://"),
        "f_escapes": _count_of("f_text", "%"),
        "f_extension": F.length(F.regexp_extract("path", "\\.([A-Za-z0-9]{1,5})$", 1)),
    }
    for name, column in features.items():
        df = df.withColumn(name, column.cast("double"))
    return df.drop("f_text", "f_query"), list(features)


# Suffixes of the host with their last one, two and three labels.
SUFFIXES = {f"s{n}": f"([^.]*)(\\.[^.]*){{0,{n - 1}}}$" for n in (1, 2, 3)}


def judged(pages: DataFrame, *, rules=RULES, sample: int = SAMPLE, id_col: str = "page_id",
           url_col: str = "url") -> DataFrame:
    """One row per url: `page_id`, `host`, `path`, `rule`, `verdict` (allow or block).

    Null urls and ones without `://` have an empty host and path, which no rule fits; the trees
    judge them by what features are left. If no url is labelled, all unruled ones are allowed; if
    all labels agree, they get that label. Repeated rows are judged alike, ids (null too) are
    carried along, extra columns are ignored, no rows give no rows.

    Suffix shares are counted over all labelled urls. The trees learn from about `sample` of
    them, chosen by a hash of the url.
    """
    work = Work(pages.sparkSession, "urls")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = with_rule(parts(rows, "url"), rules)
    rows, features = lexical(rows, "url")
    for name, pattern in SUFFIXES.items():
        rows = rows.withColumn(name, F.regexp_extract("host", pattern, 0))
    rows = work.stored(rows, "features")

    labelled = rows.where("ruled is not null").withColumn(
        "label", (F.col("ruled") == "block").cast("double"))
    count, blocked = labelled.agg(F.count("*"), F.sum("label")).first()
    if not count or blocked in (0.0, float(count)):
        only = "block" if count and blocked else "allow"
        return rows.select("page_id", "host", "path", "rule",
                           F.coalesce("ruled", F.lit(only)).alias("verdict"))

    mean = blocked / count
    for name in SUFFIXES:
        # Stored, so that a join with a frequent suffix has plain exchanges, which can be split.
        shares = work.stored(labelled.groupBy(name).agg(
            ((F.sum("label") + PRIOR * mean) / (F.count("*") + PRIOR)).alias(f"f_{name}")), name)
        rows = rows.join(shares, name, "left").withColumn(
            f"f_{name}", F.coalesce(f"f_{name}", F.lit(mean)))
    features = features + [f"f_{name}" for name in SUFFIXES]
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    vectors = assembler.transform(rows).select(
        "page_id", "url", "host", "path", "rule", "ruled", "features")

    fine = 1 << 30
    chosen = work.stored(
        vectors.where(F.col("ruled").isNotNull()
                      & (F.pmod(F.xxhash64("url"), F.lit(fine)) < int(fine * min(1, sample / count))))
        .select((F.col("ruled") == "block").cast("double").alias("label"), "features")
        .coalesce(4), "learning")
    classes = chosen.select("label").distinct().count()
    if classes < 2:
        judge = F.lit("block" if mean >= 0.5 else "allow")
        return vectors.select("page_id", "host", "path", "rule",
                              F.coalesce("ruled", judge).alias("verdict"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7,
                          maxBins=64).fit(chosen)
    scored = model.transform(vectors)
    judge = F.when(vector_to_array("probability")[1] >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule",
                         F.coalesce("ruled", judge).alias("verdict"))
