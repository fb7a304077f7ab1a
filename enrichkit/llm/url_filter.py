"""Operator 13: URL filter by rules and empirical-Bayes host reputation.

Allow and block rules settle what they fit. Every other page is judged by its
host: labelled page outcomes (those that rules settle, or a table of them) are
counted a host, and a host's rate of blocked pages is shrunk through
beta-binomial priors: the registered domain's rate is the prior of its hosts,
the suffix's that of its domains, the overall rate that of the suffixes. How
strong each prior is comes from how much the rates below one parent differ
(method of moments). A host is blocked when the lower posterior bound of its
rate is above the limit, so a host is never blocked for want of evidence.

Everything is DataFrame work: hosts are counted with partial aggregates, the
page rows meet one row a host in two joins, and neither ``html`` nor any other
column is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from enrichkit.llm.common import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: Suffixes of two labels under which domains are registered; a parameter.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp",
                      "or.jp", "com.br", "com.cn", "com.tw", "com.mx", "com.tr", "co.in", "co.kr", "co.za")

#: Fixed values of the registered query: (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the host after the first ``://`` with A-Z lower-cased, the
    path after it up to ``?`` or ``#``; both empty without ``://`` or for null."""
    part = lambda i: F.coalesce(F.regexp_extract(url, URL, i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def rules_frame(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def registered_domain(host: Column, two_label: Sequence[str] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host, user and port left aside. A host of
    one label and an IPv4 address are their own domain and suffix."""
    name = F.regexp_replace(host, r"^.*@|:[0-9]*$", "")
    short, two = F.substring_index(name, ".", -1), F.substring_index(name, ".", -2)
    long_ = two.isin(*two_label) & (name != two) if two_label else F.lit(False)
    address = name.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    return (F.when(address, name).when(long_, F.substring_index(name, ".", -3)).otherwise(two),
            F.when(address, name).when(long_, two).otherwise(short))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, fits``: of every host that a rule's host covers, those rules,
    as (length, block first, rule, path, verdict). A host is cut to as many last
    labels as the rules have, so a hostile host of a million dots is no matter."""
    labels = rules.select(F.max(F.size(F.split("host", r"\."))).alias("m")).first()["m"] or 0
    if not labels:
        return hosts.select("host", F.lit(None).cast(
            "array<struct<size:int,blocks:int,rule:string,path:string,verdict:string>>").alias("fits")).limit(0)
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -j) for j in range(1, labels + 1)]))
    rule = rules.select(F.col("host").alias("of"), F.struct(
        F.length(F.concat("host", "path")).alias("size"), F.when(F.col("verdict") == "block", 1).otherwise(0).alias("blocks"),
        F.concat("host", "path").alias("rule"), "path", "verdict").alias("fit"))
    return (hosts.select("host", F.explode(suffixes).alias("of")).join(rule, "of")
            .groupBy("host").agg(F.collect_set("fit").alias("fits")))


def apply_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (with ``host, path``) plus ``rule`` and ``ruled``, its verdict."""
    hosts = materialize(urls.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "url-hosts")
    fits = materialize(host_rules(hosts, rules), "url-rules")
    best = F.array_max(F.filter("fits", lambda r: F.col("path").startswith(r["path"])))
    # a host has one row on the right: a hot host's pages can be split
    return (urls.join(fits, "host", "left").withColumn("_best", best).drop("fits")
            .withColumn("rule", F.col("_best.rule")).withColumn("ruled", F.col("_best.verdict")).drop("_best"))


def concentration(children: DataFrame, parents: DataFrame, parent: str, least: float, most: float,
                  default: float) -> Column:
    """One-row frame ``s``: prior strength of a level. With p = k/n of a child
    and m of its parent, E sum n (p - m)^2 = sum m(1 - m) (1 + (n - 1) rho), and
    the strength is 1/rho - 1, within bounds; ``default`` where no parent varies."""
    c = children.filter("n > 0").join(parents.select(parent, F.try_divide("k", "n").alias("m")), parent)
    p, m, n = F.try_divide("k", "n"), F.col("m"), F.col("n")
    sums = c.agg(F.sum(n * (p - m) * (p - m)).alias("a"), F.sum(m * (1 - m)).alias("b"),
                 F.sum((n - 1) * m * (1 - m)).alias("c"))
    rho = F.least(F.greatest(F.try_divide(F.col("a") - F.col("b"), F.col("c")), F.lit(1 / (most + 1))), F.lit(1 / (least + 1)))
    return sums.select(F.when(F.col("c") > 0, 1 / rho - 1).otherwise(F.lit(default)).alias("s"))


def reputation(hosts: DataFrame, z: float = 1.645, least: float = 0.5, most: float = 1000.0,
               default: float = 2.0, two_label: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """``host, bad_rate, lower, upper``: posterior mean and bounds of the rate of
    blocked pages, from ``host, k, n`` (blocked and labelled pages).

    A host without labelled pages has its domain's rate; without any labels at
    all the overall rate is one half."""
    domain, suffix = registered_domain(F.col("host"), two_label)
    h = hosts.select("host", "k", "n", domain.alias("domain"), suffix.alias("suffix"))
    d = materialize(h.groupBy("domain", "suffix").agg(F.sum("k").alias("k"), F.sum("n").alias("n")), "url-domains")
    s = d.groupBy("suffix").agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
    s = materialize(s.withColumn("all", F.lit(0)), "url-suffixes")
    g = s.groupBy("all").agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
    one = lambda frame: (frame.first() or {"s": default})["s"]
    s0 = one(concentration(s, g, "all", least, most, default))
    s1 = one(concentration(d, s, "suffix", least, most, default))
    s2 = one(concentration(h, d, "domain", least, most, default))
    total = g.first()
    k, n = (total["k"], total["n"]) if total else (0, 0)
    rate = (k + 0.5) / (n + 1)
    of_s = s.select("suffix", ((F.col("k") + s0 * rate) / (F.col("n") + s0)).alias("of_suffix"))
    of_d = d.join(of_s, "suffix").select("domain", ((F.col("k") + s1 * F.col("of_suffix"))
                                                    / (F.col("n") + s1)).alias("of_domain"))
    a = F.col("k") + s2 * F.col("of_domain")
    b = F.col("n") - F.col("k") + s2 * (1 - F.col("of_domain"))
    post = h.join(of_d, "domain").select("host", a.alias("a"), b.alias("b"))
    mean = F.col("a") / (F.col("a") + F.col("b"))
    sd = F.sqrt(F.col("a") * F.col("b") / (F.col("a") + F.col("b") + 1)) / (F.col("a") + F.col("b"))
    return post.select("host", mean.alias("bad_rate"), (mean - z * sd).alias("lower"), (mean + z * sd).alias("upper"))


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               outcomes: DataFrame | None = None, limit: float = 0.5, z: float = 1.645) -> DataFrame:
    """Verdict of every page: ``page_id, host, path, rule, verdict, bad_rate, lower``.

    ``rules`` has ``host, path, verdict``: a rule fits its host and all of its
    subdomains where the path starts with its path; the longest (host and path
    together) wins, of equally long ones a blocking one, then the last in code-
    point order. ``outcomes`` may hold labelled pages (``url, blocked``); without
    it the pages that rules settle are the labelled ones. Pages without a rule are
    blocked when the lower posterior bound of their host's rate is above ``limit``.

    Defined cases: a null url and one without ``://`` have empty host and path,
    and all of them are one host. Null ids and repeated rows give a row each,
    repeated labelled pages count each time. An empty table gives no rows; with
    no rules and no outcomes every page is allowed. Extra columns are ignored;
    urls of any length are read whole.
    """
    host, path = split_url(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    ruled = materialize(apply_rules(urls, rules), "url-ruled")
    seen = ruled.select("host", F.col("ruled").isNotNull().alias("labelled"), (F.col("ruled") == "block").alias("bad"))
    if outcomes is not None:
        given = outcomes.select(split_url(F.col("url"))[0].alias("host"), F.col("blocked").alias("bad"))
        seen = seen.select("host", F.lit(False).alias("labelled"), "bad").unionByName(
            given.select("host", F.col("bad").isNotNull().alias("labelled"), "bad"))
    hosts = materialize(seen.groupBy("host").agg(F.count_if(F.col("labelled") & F.col("bad")).alias("k"),
                                                 F.count_if("labelled").alias("n")), "url-outcomes")
    known = materialize(reputation(hosts, z), "url-reputation")
    judged = F.when(F.col("lower") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.join(known, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", judged).alias("verdict"), "bad_rate", "lower")


def oracle_sql(rules: Sequence[tuple[str, str, str]] = RULES, z: float = 1.645, limit: float = 0.5, least: float = 0.5,
               most: float = 1000.0, default: float = 2.0) -> str:
    """The same result in DuckDB SQL: rules as a table, priors as nested
    aggregates over hosts, domains and suffixes."""
    rows = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    two = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    strength = f"""coalesce((SELECT CASE WHEN sum((c.n - 1) * m * (1 - m)) > 0 THEN 1 / least(greatest(
        (sum(c.n * (c.k / c.n - m) * (c.k / c.n - m)) - sum(m * (1 - m))) / sum((c.n - 1) * m * (1 - m)),
        {1 / (most + 1)!r}), {1 / (least + 1)!r}) - 1 ELSE {default} END
        FROM %s c JOIN (SELECT %s AS p, k / n AS m FROM %s) q ON c.%s = q.p WHERE c.n > 0), {default})"""
    return f"""
WITH rule AS (SELECT col0 AS h, col1 AS p, col2 AS v FROM (VALUES {rows})),
u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '{URL}', 1), ''), '{UPPER}', '{LOWER}') AS host,
             coalesce(regexp_extract(url, '{URL}', 2), '') AS path FROM pages),
pairs AS (SELECT DISTINCT host, path FROM u),
best AS (SELECT host, path, h || p AS rule, v FROM pairs JOIN rule
         ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
         QUALIFY row_number() OVER (PARTITION BY host, path
                                    ORDER BY length(h || p) DESC, v = 'block' DESC, h || p DESC) = 1),
ruled AS (SELECT u.*, best.rule, best.v FROM u LEFT JOIN best USING (host, path)),
host0 AS (SELECT host, count(*) FILTER (v = 'block') AS k, count(v) AS n,
                 regexp_replace(host, '^.*@|:[0-9]*$', '', 'g') AS name FROM ruled GROUP BY host),
host1 AS (SELECT host, k, n, name, string_split(name, '.') AS l FROM host0),
host2 AS (SELECT *, array_to_string(l[-2:], '.') AS two, regexp_full_match(name, '[0-9]+([.][0-9]+){{3}}') AS ip FROM host1),
hosts AS (SELECT host, k::DOUBLE AS k, n::DOUBLE AS n,
                 CASE WHEN ip THEN name WHEN two IN ({two}) AND name <> two THEN array_to_string(l[-3:], '.')
                      ELSE two END AS domain,
                 CASE WHEN ip THEN name WHEN two IN ({two}) AND name <> two THEN two ELSE l[-1] END AS suffix FROM host2),
domains AS (SELECT domain, suffix, sum(k) AS k, sum(n) AS n FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, 0 AS everything, sum(k) AS k, sum(n) AS n FROM domains GROUP BY suffix),
world AS (SELECT 0 AS everything, sum(k) AS k, sum(n) AS n FROM suffixes),
strength AS (SELECT {strength % ('suffixes', 'everything', 'world', 'everything')} AS s0,
                    {strength % ('domains', 'suffix', 'suffixes', 'suffix')} AS s1,
                    {strength % ('hosts', 'domain', 'domains', 'domain')} AS s2),
rate AS (SELECT (k + 0.5) / (n + 1) AS r FROM world),
s AS (SELECT suffix, (k + s0 * r) / (n + s0) AS m FROM suffixes, strength, rate),
d AS (SELECT domain, (k + s1 * m) / (n + s1) AS m FROM domains JOIN s USING (suffix), strength),
ab AS (SELECT host, k + s2 * m AS a, n - k + s2 * (1 - m) AS b FROM hosts JOIN d USING (domain), strength),
low AS (SELECT host, a / (a + b) - {z} * sqrt(a * b / (a + b + 1)) / (a + b) AS lower FROM ab)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN lower > {limit} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN low USING (host)"""
