"""URL rules looked up by their rarest literal token.

A rule is a regular expression together with the literal tokens that any URL it fits must hold.
Of these, the token in the fewest URLs is the rule's key. Rules are a table, hashed by key into slots; a
URL's own tokens fetch the rules filed under them, and only those rules run.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of these are tokens.
TOKEN = "[a-z0-9]+"
#: What the index holds of a rule.
ENTRY = "rank int, name string, verdict string, pattern string, token string"


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    literals: tuple[str, ...]
    verdict: str
    rank: int


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits the host and its subdomains below the path; the longer rule ranks higher."""
    # The host is compared in lower case, the path as it stands.
    pattern = rf"(?s)^(?:(?!://).)*://(?:[^/?#]*\.)?(?i:{re.escape(host)}){re.escape(path)}"
    tokens = re.findall(TOKEN, host.lower()) + re.findall(TOKEN, path.rpartition("/")[0].lower())
    return Rule(host + path, pattern, tuple(dict.fromkeys(tokens)), verdict, len(host) + len(path))


SITE_RULES = (
    site_rule("allow", "org", "/"),
    site_rule("block", "example.org", "/es/"),
    site_rule("block", "example.org", "/en/1"),
    site_rule("allow", "com", "/fr/"),
    site_rule("block", "com", "/de/"),
)
#: Patterns for URLs that no site rule fits; the first that fits decides, else the URL is allowed.
PATTERN_RULES = (
    Rule("tracking", r"(?s)[?&]utm_[a-z]+=", ("utm",), "block", 3),
    Rule("paging", r"(?s)[?&]page=[0-9]+(&|#|$)", ("page",), "block", 2),
    Rule("mobile", r"(?s)://m\.", ("m",), "block", 1),
)


def tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(url, F.lit(""))), F.lit(TOKEN), 0))


def table_of(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of what the driver holds, made without Python workers."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def filed(urls: DataFrame, column: str, rules: tuple[Rule, ...]) -> DataFrame:
    """Rows (token, rank, name, verdict, pattern): each rule under its literal that the fewest URLs hold (ties: the smallest).

    Counts cover every URL; only tokens that rules ask for are counted. The list of these, to be held by
    every task, is no longer than the rules.
    """
    spark = urls.sparkSession
    literals = [{"rule": i, "token": t} for i, r in enumerate(rules) for t in r.literals]
    wanted = table_of(spark, literals, "rule int, token string")
    seen = urls.select(F.explode(tokens(named(column))).alias("token"))
    counts = seen.join(F.broadcast(wanted.select("token").distinct()), "token").groupBy("token").count()
    rarest = F.min(F.struct(F.coalesce("count", F.lit(0)).alias("often"), "token")).alias("least")
    keys = wanted.join(counts, "token", "left").groupBy("rule").agg(rarest).select("rule", "least.token")
    known = [{"rule": i, "rank": r.rank, "name": r.name, "verdict": r.verdict, "pattern": r.pattern} for i, r in enumerate(rules)]
    known = table_of(spark, known, "rule int, rank int, name string, verdict string, pattern string")
    return keys.join(known, "rule").drop("rule")


def slot(token: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(slots)).cast("int")


def rule_index(rules: DataFrame, slots: int) -> Column:
    """The rules as one value: an array of slots, each with the rules whose token's hash leads there.

    A token is looked up in one step, however many rules there are. The value passes through the driver, which
    has the rules anyway, and is a constant of the plan.
    """
    spark = rules.sparkSession
    entry = F.struct(*(part.split()[0] for part in ENTRY.split(", ")))
    held = rules.select(slot(F.col("token"), slots).alias("slot"), entry.alias("rule"))
    every = spark.range(slots).select(F.col("id").cast("int").alias("slot")).join(held, "slot", "left")
    lists = every.groupBy("slot").agg(F.collect_list("rule").alias("rules"))
    ordered = F.array_sort(F.collect_list(F.struct("slot", "rules")))
    held = lists.agg(F.to_json(F.transform(ordered, lambda s: s["rules"]))).first()[0]
    return F.from_json(F.lit(held), f"array<array<struct<{ENTRY}>>>")


def best_rule(url: Column, index: Column, slots: int) -> Column:
    """Struct (rank, name, verdict) of the highest rule that fits, or null. Only rules that a token of the URL fetches run."""
    fetched = F.transform(tokens(url), lambda t: F.filter(F.get(index, slot(t, slots)), lambda r: r["token"] == t))
    fitting = F.filter(F.flatten(fetched), lambda r: F.rlike(url, r["pattern"]))
    return F.array_max(F.transform(fitting, lambda r: F.struct(r["rank"], r["name"], r["verdict"])))


def named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def unused(name: str, columns: list[str]) -> str:
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def judged(
    pages: DataFrame,
    column: str = "url",
    site_rules: tuple[Rule, ...] = SITE_RULES,
    pattern_rules: tuple[Rule, ...] = PATTERN_RULES,
    default: str = "allow",
) -> DataFrame:
    """``pages`` with columns host, path, rule, verdict; one row out for each row in, no shuffle of rows.

    Columns of these names are replaced. A null URL and one without ``://`` have an empty host
    and path, no rule, and get the default verdict. Of rules with one rank the greater name wins. Repeated
    rows are judged alike; an empty table gives no rows. Each rule needs at least one literal token. Rules
    may number some 100,000: every task holds all of them.
    """
    if bare := [r.name for r in site_rules + pattern_rules if not r.literals]:
        raise ValueError(f"rules without a literal token: {bare[:3]}")
    url = F.coalesce(named(column), F.lit(""))
    at = F.instr(url, "://")
    real = at > 0
    rest = F.when(real, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def best(rules: tuple[Rule, ...]) -> Column:
        slots = max(1, len(rules))
        return best_rule(url, rule_index(filed(pages, column, rules), slots), slots)

    site, other = (unused(n, pages.columns) for n in ("_site", "_other"))
    out = pages.withColumn(site, F.when(real, best(site_rules)))
    out = out.withColumn(other, F.when(real & F.col(site).isNull(), best(pattern_rules)))
    verdict = F.coalesce(F.col(site)["verdict"], F.col(other)["verdict"], F.lit(default))
    return out.withColumns({"host": lower, "path": path, "rule": F.col(site)["name"], "verdict": verdict}).drop(site, other)
