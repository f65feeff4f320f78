"""URL filter: rules first, then host reputation by empirical Bayes.

Labelled page outcomes (good or bad) are counted by host, registered domain and
suffix. Each level's rate is a beta posterior whose prior is centred on the
level above: suffix on the whole, domain on its suffix, host on its domain. The
prior's weight at each level is estimated by moments from the spread of the
rates between that level's groups. A URL is blocked if the upper bound of its
host's posterior rate of good pages is under a threshold. Hosts without labels
take their domain's, suffix's or the overall rate, and so the URL's verdict is
always defined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import compact, small_join

#: Fixed values: (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
#: Suffixes of two labels that count as one: a sample of public ones. public_suffixes() reads a whole list.
SUFFIXES = ["co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = "://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does. Equally long rules: the first given."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def public_suffixes(path: str) -> list[str]:
    """The entries of a file in the format of the public suffix list: one a line, // comments, *.x for all labels under x, !y.x for an exception."""
    with open(path, encoding="utf-8") as f:
        words = (line.split()[0] for line in f if line.strip() and not line.lstrip().startswith("//"))
        return [w.lower() if w.isascii() else (w[:1] + w[1:].encode("idna").decode() if w[0] == "!" else "*." + w[2:].encode("idna").decode() if w.startswith("*.") else w.encode("idna").decode()) for w in words]


def levels(df: DataFrame, suffixes) -> DataFrame:
    """df with suffix and domain of its host: the longest suffix that fits, else the last label; the domain has one label more."""
    wild, but = [x[2:] for x in suffixes if x.startswith("*.")], [x[1:] for x in suffixes if x.startswith("!")]
    plain = [x for x in suffixes if not x.startswith(("*.", "!"))]
    end = lambda n: F.substring_index("host", ".", -n) if n else F.lit("")
    suffix = end(1)
    most = max([x.count(".") + 1 for x in plain] + [x.count(".") + 2 for x in wild], default=1)
    for n in range(2, most + 1):
        fits = end(n).isin(plain) | (end(n - 1).isin(wild) & (end(n) != end(n - 1)))
        suffix = F.when(fits, end(n)).otherwise(suffix)
    for n in sorted({x.count(".") + 1 for x in but}):
        suffix = F.when(end(n).isin([x for x in but if x.count(".") + 1 == n]), end(n - 1)).otherwise(suffix)
    df = df.withColumn("suffix", suffix)
    return df.withColumn("domain", F.call_function("substring_index", F.col("host"), F.lit("."), -(F.size(F.split("suffix", r"\.")) + 1)))


def weight(groups: DataFrame) -> float:
    """A level's prior weight by moments: m (1 - m) / (spread of the group rates - expected sampling spread) - 1, within 1 and 1000."""
    r = groups.agg(F.sum("good").alias("good"), F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("good") * F.col("good") / F.col("n")).alias("q")).first()
    if not r.n or r.k < 2 or not 0 < r.good < r.n:
        return 10.0
    m = r.good / r.n
    spread = (r.q - r.n * m * m) / r.n  # between groups, each by its rows
    noise = m * (1 - m) * r.k / r.n
    return float(min(1000.0, max(1.0, m * (1 - m) / (spread - noise) - 1))) if spread > noise else 1000.0


def reputation(pages: DataFrame, outcomes: DataFrame, suffixes=SUFFIXES) -> tuple[DataFrame, DataFrame, DataFrame, float]:
    """(hosts, domains, suffixes, overall rate): hosts have a and b of their posterior, domains and suffixes their rates with a and b.

    pages: page_id, host. outcomes: page_id, good (0 or 1). Only labelled hosts have rows; all are sums of counts, computed map-side first.
    """
    counted = compact(levels(pages.join(outcomes, "page_id").groupBy("host").agg(F.sum("good").alias("good"), F.count("*").alias("n")), suffixes), "hosts")
    by = {k: counted.groupBy(*c).agg(F.sum("good").alias("good"), F.sum("n").alias("n")) for k, c in (("suffix", ["suffix"]), ("domain", ["domain", "suffix"]), ("host", ["host", "domain", "suffix"]))}
    total = counted.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    overall = ((total.good or 0) + 1) / ((total.n or 0) + 2)
    w = {k: weight(g) for k, g in by.items()}

    def posterior(df: DataFrame, level: str, prior: Column) -> DataFrame:
        a = F.col("good") + F.lit(w[level]) * prior
        return df.withColumn("a", a).withColumn("b", F.col("n") + F.lit(w[level]) - a)

    s = posterior(by["suffix"], "suffix", F.lit(overall)).select("suffix", "a", "b", (F.col("a") / (F.col("a") + F.col("b"))).alias("suffix_rate"))
    d = posterior(by["domain"].join(s.select("suffix", "suffix_rate"), "suffix"), "domain", F.col("suffix_rate")).select("domain", "a", "b", (F.col("a") / (F.col("a") + F.col("b"))).alias("domain_rate"))
    h = posterior(by["host"].join(d.select("domain", "domain_rate"), "domain"), "host", F.col("domain_rate")).select("host", "a", "b")
    return h, d.select("domain", "a", "b"), s.select("suffix", "a", "b"), overall


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, threshold: float = 0.5, z: float = 1.645, suffixes=SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict, rate (posterior mean of good pages) and bound (its upper bound) of each row of pages.

    pages: page_id, url. Null urls and urls without :// have an empty host and path, fit no rule, and
    take the overall rate. Pages without an outcome are judged like others;
    repeated rows are judged each; ports belong to the host. Urls of any length are read whole; other columns of
    pages are not read; empty tables give no rows, or rows at the overall rate. The hosts' table is broadcast if it
    is measured to be small, else joined by an exchange whose skew Spark splits.
    """
    judged = levels(pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), suffixes)
    h, d, s, overall = reputation(judged.select("page_id", "host"), outcomes, suffixes)
    for part, key in ((h, "host"), (d, "domain"), (s, "suffix")):
        judged = small_join(judged, part.withColumnsRenamed({"a": f"{key}_a", "b": f"{key}_b"}), key, "left")
    a = F.coalesce("host_a", "domain_a", "suffix_a", F.lit(overall * 2))
    b = F.coalesce("host_b", "domain_b", "suffix_b", F.lit((1 - overall) * 2))
    rate = a / (a + b)
    bound = rate + F.lit(z) * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(bound < threshold, "block").otherwise("allow")).alias("verdict"), F.round(rate, 6).alias("rate"), F.round(bound, 6).alias("bound"))
