"""URL filters: explicit rules, then host reputation by empirical Bayes. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framesift.llm.common import table, written

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
Z = 1.645  # of the one-sided 95 % bound
WORST = 0.4  # hosts whose share of bad pages is surely above are blocked
# Second labels under which two-letter top-level domains register names, as in co.uk.
SECOND = "ac co com edu gov go ne net or org"
HEAVY = 1000  # hosts with at least a thousandth of all pages are handled apart: at most a thousand


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty where it is null or has no ://."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def registered(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host: its last two labels and its last, or three and two under a SECOND label.

    A port does not belong to either. An address of numbers is its own domain, with the suffix ip.
    """
    name = F.regexp_replace(host, ":[0-9]*$", "")
    last = lambda n: F.substring_index(name, ".", -n)
    number, second = name.rlike(r"^[0-9.]+$|^\["), name.rlike(rf"(^|\.)({'|'.join(SECOND.split())})\.[a-z][a-z]$")
    return F.when(number, name).when(second, last(3)).otherwise(last(2)), F.when(number, "ip").when(second, last(2)).otherwise(last(1))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, p = text.split("/", 1)
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(f"/{p}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _moments(stats: DataFrame, level: str) -> DataFrame:
    """One row: the strength of the beta prior at a level, by the moments of the beta-binomial, between 1 and 999."""
    g = stats.groupBy(level).agg(F.sum("n").alias("n"), F.sum("k").alias("k")).where("n > 0")
    g = g.agg(F.count("*").alias("g"), F.sum("n").alias("tn"), F.sum("k").alias("tk"), F.sum(F.col("k") * F.col("k") / F.col("n")).alias("q"), F.sum(F.col("n") * F.col("n")).alias("nn"))
    mu = F.expr("try_divide(tk, tn)")
    rho = F.expr("try_divide(try_divide(q - tk * try_divide(tk, tn), try_divide(tk, tn) * (1 - try_divide(tk, tn))) - (g - 1), tn - try_divide(nn, tn) - (g - 1))")
    return g.select(F.coalesce((1 / F.least(F.greatest(rho, F.lit(0.001)), F.lit(0.5))) - 1, F.lit(999.0)).alias(f"s_{level}"), mu.alias(f"mu_{level}"))


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """pages(page_id, host), outcomes(page_id, bad 0/1) to (host, pages, n, k, mean, lower).

    mean and lower: of the share of a host's pages that are bad, after shrinking its labelled outcomes to its
    registered domain's, those to its suffix's, those to all, as registered() has them. Hosts without labelled pages have their domain's prior. A page with several outcomes
    counts as bad if one of them is.
    """
    bad = outcomes.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    x = pages.join(bad, "page_id", "left").groupBy("host").agg(F.count("*").alias("pages"), F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("k"))
    domain, suffix = registered(F.col("host"))
    x = x.withColumn("domain", domain).withColumn("suffix", suffix)
    x = written(x, "hosts")
    total = x.agg(F.sum("n").alias("tn"), F.sum("k").alias("tk"))
    one = total.select(F.expr("(tk + 1) / (tn + 2)").alias("mu")).select(F.coalesce("mu", F.lit(0.5)).alias("mu"))
    for level in ("suffix", "domain", "host"):
        one = one.crossJoin(_moments(x, level).select(f"s_{level}"))  # one row each
    s = one.first()
    suffix = x.groupBy("suffix").agg(((F.sum("k") + s["s_suffix"] * s["mu"]) / (F.sum("n") + s["s_suffix"])).alias("mu_suffix"))
    domain = x.groupBy("domain", "suffix").agg(F.sum("n").alias("dn"), F.sum("k").alias("dk")).join(suffix, "suffix")
    domain = domain.select("domain", ((F.col("dk") + s["s_domain"] * F.col("mu_suffix")) / (F.col("dn") + s["s_domain"])).alias("mu_domain"))
    x = x.join(domain, "domain")
    a = F.col("k") + s["s_host"] * F.col("mu_domain")
    b = F.col("n") - F.col("k") + s["s_host"] * (1 - F.col("mu_domain"))
    mean = a / (a + b)
    return x.select("host", "pages", "n", "k", mean.alias("mean"), (mean - Z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))).alias("lower"))


def judged(pages: DataFrame, outcomes: DataFrame, rules=RULES) -> DataFrame:
    """pages(page_id, url) to (page_id, host, path, rule, verdict), a row for each row.

    The longest rule that fits decides; else the host is blocked if the lower bound of its share of bad pages is above
    WORST. Null urls and urls without :// have an empty host and path, and a reputation like any host. Null page_ids
    stay; repeated rows are judged alike; no rows give no rows; other columns are ignored.
    """
    host, path = parts(F.col("url"))
    x = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    bad = written(host_reputation(x.select("page_id", "host"), outcomes), "reputation")
    pages_in_all = bad.agg(F.sum("pages")).first()[0] or 0
    judged_hosts = bad.select("host", (F.col("lower") > WORST).alias("bad"), (F.col("pages") * HEAVY >= pages_in_all).alias("large"))
    heavy = F.broadcast(judged_hosts.where("large").select("host", F.col("bad").alias("heavy")))
    light = judged_hosts.where("bad and not large").select("host", F.col("bad").alias("light"))
    out = x.withColumn("rule", rule).withColumn("fixed", verdict).join(heavy, "host", "left")
    open_ = out["fixed"].isNull() & out["heavy"].isNull()
    # heavy hosts of either verdict are known here; a light one has too few pages to be a hot key of the join
    later = out.where(open_).join(light, "host", "left")
    done = out.where(~open_).withColumn("light", F.lit(None).cast("boolean"))
    out = done.unionByName(later)
    return out.select("page_id", "host", "path", "rule", F.coalesce("fixed", F.when(F.col("heavy") | F.col("light"), F.lit("block")), F.lit("allow")).alias("verdict"))


def page_outcomes(labels: DataFrame) -> DataFrame:
    """Outcomes of pages from labels of the same number: bad if of low quality or toxic."""
    return labels.select(F.col("doc_id").alias("page_id"), F.expr("case when quality = 0 or toxic = 1 then 1 when quality is null and toxic is null then null else 0 end").alias("bad"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on the url of all pages: see judged()."""
    return judged(table(spark, sf_dir, "pages"), page_outcomes(table(spark, sf_dir, "labels")))


def _rule_sql() -> str:
    rules = sorted(RULES, key=lambda r: (-len(r[1]), r[1]))
    case = lambda k: "case " + " ".join(f"when (host = '{t.split('/', 1)[0]}' or ends_with(host, '.{t.split('/', 1)[0]}')) and starts_with(path, '/{t.split('/', 1)[1]}') then '{(w, t)[k]}'" for w, t in rules) + " end"
    return f"{case(1)} as rule, {case(0)} as fixed"


def _strength_sql(level: str) -> str:
    return f"""(select coalesce(1 / least(greatest((((q - tk * (tk / tn)) / nullif((tk / tn) * (1 - tk / tn), 0)) - (g - 1)) / nullif(tn - nn / tn - (g - 1), 0), 0.001), 0.5) - 1, 999.0)
  from (select count(*) g, sum(n) tn, sum(k) tk, sum(k * k / n) q, sum(n * n) nn from (select {level}, sum(n)::double n, sum(k)::double k from hosts group by 1) where n > 0))"""


_SECOND_SQL = f"regexp_matches(name, '(^|\\.)({'|'.join(SECOND.split())})\\.[a-z][a-z]$')"


def _last_sql(n: int) -> str:
    return f"array_to_string(list_slice(string_split(name, '.'), -{n}, -1), '.')"


OP5_SQL = f"""
with cut as (select page_id, case when url is not null and position('://' in url) > 0 then substring(url, position('://' in url) + 3) else '' end as rest from pages),
x as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
ruled as (select *, {_rule_sql()} from x),
bad as (select doc_id as page_id, max(case when quality = 0 or toxic = 1 then 1 when quality is null and toxic is null then null else 0 end) as bad from labels where doc_id is not null group by 1),
counted as (select host, count(bad) as n, coalesce(sum(bad), 0)::bigint as k, regexp_replace(host, ':[0-9]*$', '') as name from x left join bad using (page_id) group by 1),
hosts as (select *, case when regexp_matches(name, '^[0-9.]+$|^\\[') then name when {_SECOND_SQL} then {_last_sql(3)} else {_last_sql(2)} end as domain, case when regexp_matches(name, '^[0-9.]+$|^\\[') then 'ip' when {_SECOND_SQL} then {_last_sql(2)} else {_last_sql(1)} end as suffix from counted),
prior as (select (select coalesce((sum(k) + 1) / (sum(n) + 2), 0.5) from hosts) as mu, {_strength_sql("suffix")} as s_suffix, {_strength_sql("domain")} as s_domain, {_strength_sql("host")} as s_host),
suffixes as (select suffix, (sum(k) + any_value(s_suffix) * any_value(mu)) / (sum(n) + any_value(s_suffix)) as mu_suffix from hosts, prior group by 1),
domains as (select domain, (sum(k) + any_value(s_domain) * any_value(mu_suffix)) / (sum(n) + any_value(s_domain)) as mu_domain from hosts join suffixes using (suffix), prior group by domain),
ab as (select host, k + s_host * mu_domain as a, n - k + s_host * (1 - mu_domain) as b from hosts join domains using (domain), prior),
rep as (select host, a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as lower from ab)
select page_id, ruled.host as host, path, rule, coalesce(fixed, case when lower > {WORST} then 'block' else 'allow' end) as verdict from ruled join rep on ruled.host = rep.host
"""
