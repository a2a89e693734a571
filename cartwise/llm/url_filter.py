"""URL filter: pattern rules indexed by their rarest literal token.

A rule names a host (which also covers its subdomains), a path prefix, an
optional regular expression over the whole URL, and a verdict. Its *literal
tokens* are runs of letters and digits that any URL it fits must contain as whole
tokens. The rule is stored under the one of them that the fewest URLs contain.
Each distinct URL is cut into its tokens; the tokens fetch candidate rules by an
equality join, and regular expressions run on those candidates only. Rules without
a usable literal token are candidates of every URL; they are joined on a constant
(their number is checked to be small).

Longest fit wins: host and path length together, then host, then path in
string order, then block before allow. Only the given table is judged; repeated rows
are judged alike. NULL, empty and malformed URLs (no ``://``) have an empty host
and path; no host rule fits them.

Scale: the URLs are made distinct before any join, so a page that is listed a
million times costs one evaluation. Token frequencies are counted over all URLs
with a partial aggregate and only for tokens of rules. A hot token (``com``) in
the index cannot blow up a join: one URL holds it once, and the rule side has
unique (token, rule) rows that are broadcast when they are few.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm.common import ascii_lower, column, packed, small, stored

MAX_BROADCAST_RULES = 200_000
MAX_UNINDEXED_RULES = 100
TOKEN = "[0-9a-z]+"

# A table of rules; see Rule.
RULE_SCHEMA = "verdict string, host string, path string, pattern string, literals array<string>"
_MARKS = r"([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])"  # ASCII characters that a pattern may give a meaning


@dataclass(frozen=True)
class Rule:
    """``host``/``path`` rule (``pattern`` empty), or a regular expression over the lower-cased URL
    with the literal tokens that each match contains (``literals``)."""

    verdict: str
    host: str = ""
    path: str = ""
    pattern: str = ""
    literals: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}" if self.host else self.pattern


# The contract's rules, and the method's own verdicts for pages that no rule fits: patterns of
# link farms and shops for pills, which the given tables hold beside ordinary sites.
CONTRACT_RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
)
METHOD_RULES = (
    Rule("block", pattern=r"://([^/?#]*[.-])?spam([.-][^/?#]*)?([/?#]|$)", literals=("spam",)),
    Rule("block", pattern=r"://([^/?#]*[.-])?pills([.-][^/?#]*)?([/?#]|$)", literals=("pills",)),
    Rule("block", pattern=r"://([^/?#]*[.-])?casino([.-][^/?#]*)?([/?#]|$)", literals=("casino",)),
    # one rule for each spelling: a literal is a whole token of every match
    Rule("block", pattern=r"://([^/?#]*[.-])?(free|cheap)-porn([.-][^/?#]*)?([/?#]|$)", literals=("porn",)),
    Rule("block", pattern=r"://([^/?#]*[.-])?freeporn([.-][^/?#]*)?([/?#]|$)", literals=("freeporn",)),
    Rule("block", pattern=r"://([^/?#]*[.-])?cheapporn([.-][^/?#]*)?([/?#]|$)", literals=("cheapporn",)),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rules_table(spark: SparkSession, rules: Sequence[Rule] | DataFrame, method_rules: Sequence[Rule] | DataFrame = ()) -> DataFrame:
    """Both kinds of rules, compiled, as one stored table with a ``rule_id``."""
    def given(r: Sequence[Rule] | DataFrame) -> DataFrame:
        if isinstance(r, DataFrame):
            return r
        return spark.createDataFrame([(x.verdict, x.host, x.path, x.pattern, list(x.literals)) for x in r], RULE_SCHEMA)

    both = compiled(given(rules), False).unionByName(compiled(given(method_rules), True))
    return stored(both.withColumn("rule_id", F.monotonically_increasing_id()), "url-rules")


def compiled(rules: DataFrame, own: bool) -> DataFrame:
    """(rule, pattern, verdict, length, literals, own) of a table of rules; ``own`` marks the method's."""
    host, path, given = (F.coalesce(c, F.lit("")) for c in ("host", "path", "pattern"))
    low = F.lower(host)
    # over host and path: the host or a subdomain of it (hosts hold no slash), then the path prefix
    quoted = [F.regexp_replace(x, _MARKS, r"\\$1") for x in (low, path)]
    fits = F.concat(F.lit(r"(?s)^([^/]*\.)?"), quoted[0], F.when(path == "", F.lit(r"(/|\z)")).otherwise(quoted[1]))
    # path tokens count as literals where they cannot go on: before a separator. Tokens are taken from the
    # lower-cased URL, so those of the path are lower-cased here as well.
    tokens = F.concat(F.regexp_extract_all(low, F.lit(f"({TOKEN})"), F.lit(1)),
                      F.regexp_extract_all(F.lower(path), F.lit("([0-9a-z]+)(?=[^0-9a-z])"), F.lit(1)))
    free = given != ""
    return rules.select(
        F.when(host != "", F.concat(host, path)).otherwise(given).alias("rule"), F.when(free, F.concat(F.lit("(?s)"), given)).otherwise(fits).alias("pattern"),
        "verdict", F.when(free, 0).otherwise(F.char_length(host) + F.char_length(path)).alias("length"),
        F.array_sort(F.array_distinct(F.when(free, F.coalesce("literals", F.array().cast("array<string>"))).otherwise(tokens))).alias("literals"), F.lit(own).alias("own"))


def _tokens(url: Column) -> Column:
    return F.array_distinct(F.filter(F.split(ascii_lower(url), "[^0-9a-z]+"), lambda w: w != ""))


def index_rules(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """``rules`` with the literal token ``token`` that the fewest distinct URLs contain (NULL: none).

    ``urls`` holds distinct URLs in ``url``. Ties go to the smaller token in string order.
    """
    wanted = rules.select(F.explode("literals").alias("token")).distinct()
    seen = (urls.select(F.explode(_tokens(F.col("url"))).alias("token"))
            .join(small(wanted, MAX_BROADCAST_RULES), "token").groupBy("token").agg(F.count("*").alias("n")))
    best = (rules.select("rule_id", F.explode("literals").alias("token")).join(seen, "token", "left")
            .groupBy("rule_id")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token")))
    return rules.join(best, "rule_id", "left")


def candidates(urls: DataFrame, indexed: DataFrame) -> DataFrame:
    """(url, host, path, rule columns) for each distinct URL and each rule that its tokens fetch."""
    without = indexed.where(F.col("token").isNull())
    if without.limit(MAX_UNINDEXED_RULES + 1).count() > MAX_UNINDEXED_RULES:
        raise ValueError(f"more than {MAX_UNINDEXED_RULES} rules have no literal token; give them literals")
    cols = ["rule", "pattern", "verdict", "length", "own"]
    anyway = [r["rule_id"] for r in without.select("rule_id").collect()]  # at most MAX_UNINDEXED_RULES
    keys = F.array_union(F.transform(_tokens(F.col("url")), lambda t: F.concat(F.lit("t:"), t)),
                         F.array(*[F.lit(f"r:{i}") for i in anyway]).cast("array<string>"))
    rule_keys = indexed.select(F.coalesce(F.concat(F.lit("t:"), "token"),
                                          F.concat(F.lit("r:"), F.col("rule_id").cast("string"))).alias("key"), *cols)
    return (urls.select("url", F.explode(keys).alias("key"))
            .join(small(rule_keys, MAX_BROADCAST_RULES), "key").drop("key"))


def judge(pages: DataFrame, rules: Sequence[Rule] | DataFrame, method_rules: Sequence[Rule] | DataFrame = METHOD_RULES, *,
          url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (NULL if none fits) and verdict columns appended.

    Fitting ``rules`` go first (longest wins); else any fitting method rule's verdict (block
    first), else ``default``. Both may be tables (``RULE_SCHEMA``) of any size. Columns of ``pages`` with these names are replaced.
    """
    spark = pages.sparkSession
    out = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    urls = pages.select(column(url).alias("url")).where("url is not null").distinct()
    table = rules_table(spark, rules, method_rules)
    found = candidates(urls, index_rules(table, urls))
    over = F.when(~F.col("own"), F.concat(host_of(F.col("url")), path_of(F.col("url")))).otherwise(
        ascii_lower(F.col("url")))
    fits = found.where(F.rlike(over, F.col("pattern")))
    # contract rules before the method's, longer before shorter, then the smallest text
    best = fits.groupBy("url").agg(F.min(F.struct(
        "own", (-F.col("length")).alias("shorter"), F.col("rule"),
        (F.col("verdict") != "block").alias("allow"), F.col("verdict"))).alias("best"))
    judged = best.select(F.col("url").alias("_url"), F.when(~F.col("best.own"), F.col("best.rule")).alias("_rule"),
                         F.col("best.verdict").alias("_verdict"))
    return (pages.select(packed(pages, ("host", "path", "rule", "verdict")), column(url).alias("_given")).join(judged, F.col("_given") == F.col("_url"), "left")
            .select(*[F.col("_row").getField(c).alias(c) for c in out], host_of(F.col("_given")).alias("host"), path_of(F.col("_given")).alias("path"),
                    F.col("_rule").alias("rule"), F.coalesce("_verdict", F.lit(default)).alias("verdict")))
