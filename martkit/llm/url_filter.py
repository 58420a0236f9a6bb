"""Judge URLs by host and path rules, and by a list of canonical URLs, with DataFrame functions alone.

The list becomes a blocked Bloom filter: a table of blocks of four 64-bit words, in one of which a URL sets one bit a word.
The filter has a fixed number of blocks whatever the list's length, so it is broadcast safely; what passes it meets
the list in an exact hash join.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from martkit.operators.joins import spread_join

# Blocks of the filter, at most so many rows of 40 bytes; a longer list lets more false hits pass to the join.
BLOCKS = 1 << 17
WORDS = 4
# Rules are configuration, tried one by one on every row.
MOST_RULES = 1_000

# Query parameters that do not change what a URL names.
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid|page=1)(=|$)"
# Words that name unwanted hosts, between dots and hyphens.
UNWANTED = ["ads", "adult", "bets", "casino", "pills", "spam"]


class Rule(NamedTuple):
    allow: bool
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = [
    Rule(True, "org", "/"),
    Rule(False, "example.org", "/es/"),
    Rule(False, "example.org", "/en/1"),
    Rule(True, "com", "/fr/"),
    Rule(False, "com", "/de/"),
]


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))


def _small(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """Host with its port, A-Z in lower case; empty without one."""
    return F.coalesce(_small(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a default port, path without a closing slash, parameters that matter in order; null without ``://``.

    Scheme, fragment and tracking parameters do not count.
    """
    rest = _after_scheme(url)
    query = F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)
    told = F.array_sort(F.filter(F.split(query, "&", -1), lambda p: (p != "") & ~p.rlike(TRACKING)))
    host = F.regexp_replace(host_of(url), ":(80|443)$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    whole = F.concat(host, path, F.when(F.size(told) > 0, F.concat(F.lit("?"), F.array_join(told, "&"))).otherwise(""))
    return F.when(rest.isNotNull(), whole)


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name of the longest rule that fits, and whether it allows; nulls if none does.  Of equal ones the blocking one wins."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules: make them a list of URLs")
    name, allow = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    # The last one put around the others is tried first.
    for r in sorted(rules, key=lambda r: (len(r.name), not r.allow, r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name, allow = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.allow)).otherwise(allow)
    return name, allow


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def _bits(url: Column) -> list[Column]:
    """One bit for each word of the block, by a hash of its own."""
    mark = F.xxhash64(F.lit("bit"), url)
    places = [F.shiftrightunsigned(mark, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places]


def bloom_filter(listed: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``(block, w0 ... w3)`` of a table with a column ``canonical``: ``blocks`` rows at most, combined before they travel."""
    marked = listed.dropna().select(_block(F.col("canonical"), blocks).alias("block"), *[b.alias(f"w{k}") for k, b in enumerate(_bits(F.col("canonical")))])
    return marked.groupBy("block").agg(*[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS)])


def listed_urls(pages: DataFrame, url: str = "url", words: Sequence[str] = UNWANTED) -> DataFrame:
    """``(canonical)``: a list made from pages, of those whose host has an unwanted word between dots or hyphens."""
    frame = pages.select(F.col(f"`{url}`").cast("string").alias("url"))
    named = host_of(F.col("url")).rlike(rf"(^|[.-])({'|'.join(words)})([.-]|$)")
    return frame.filter(named).select(canonical(F.col("url")).alias("canonical")).distinct()


def judge_urls(
    pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = RULES, key: str = "page_id", url: str = "url", blocks: int = BLOCKS
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, listed)`` of every row of ``pages``.

    ``listed`` has canonical URLs in a column ``canonical``, repeated or null ones do no harm.  The longest rule that fits decides; else a
    URL is blocked if its canonical form is listed.  A null URL, an empty one and one without ``://`` have an empty host and path,
    fit no rule, are listed nowhere and so are allowed.  Repeated rows and null keys are judged each for itself; an empty list
    blocks nothing, an empty table gives no row.  Other columns do not matter, whatever their names.

    The list and rows that pass the filter meet in a salted join, so that a URL that very many rows share is no burden.
    """
    value = F.col("url")
    frame = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"))
    rows = frame.select("page_id", host_of(value).alias("host"), path_of(value).alias("path"), canonical(value).alias("canonical"))
    name, allow = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "allowed": allow, "block": F.coalesce(_block(F.col("canonical"), blocks), F.lit(-1))})
    listed = listed.select(F.col("canonical").cast("string").alias("canonical")).dropna().distinct()
    # ``blocks`` rows at most.
    probed = rows.join(F.broadcast(bloom_filter(listed, blocks)), "block", "left")
    held = F.lit(True)
    for k, bit in enumerate(_bits(F.col("canonical"))):
        held = held & (F.col(f"w{k}").bitwiseAND(bit) != 0)
    probed = probed.withColumn("maybe", F.coalesce(held, F.lit(False))).select("page_id", "host", "path", "rule", "allowed", "canonical", "maybe")
    passed = spread_join(probed.filter("maybe").drop("maybe"), listed.withColumn("listed", F.lit(True)), ["canonical"], "left")
    others = probed.filter("NOT maybe").drop("maybe").withColumn("listed", F.lit(False))
    both = passed.withColumn("listed", F.coalesce("listed", F.lit(False))).unionByName(others)
    verdict = F.when(F.coalesce("allowed", ~F.col("listed")), "allow").otherwise("block")
    return both.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed")


def drop_blocked(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", blocks: int = BLOCKS) -> DataFrame:
    """The rows of ``pages`` that are allowed, unchanged; cases as in ``judge_urls``.

    Only distinct URLs that pass the filter are joined exactly; what they leave is the blocked URLs, spread over salts.
    """
    verdicts = judge_urls(pages.select(F.col(f"`{url}`").alias("url")).distinct().select(F.col("url").alias("page_id"), "url"), listed, rules, blocks=blocks)
    blocked = verdicts.filter("verdict = 'block'").select(F.col("page_id").alias("_blocked_url"))
    return pages.join(blocked, F.col(f"`{url}`") == F.col("_blocked_url"), "left_anti")


def url_report(pages: DataFrame) -> DataFrame:
    """The registered query: the fixed rules, and the list that the pages' own hosts give."""
    return judge_urls(pages, listed_urls(pages))


def url_sql() -> str:
    """The same answers in SQL: exact membership in place of filter and join."""
    rest = "substr(url, strpos(url, '://') + 3)"
    small = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    host = small.format("regexp_extract(rest, '^[^/?#]*')")
    fits = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'"
        for r in sorted(RULES, key=lambda r: (-len(r.name), r.allow, r.name))
    )
    allow = ", ".join(f"'{r.name}'" for r in RULES if r.allow)
    told = f"list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '{TRACKING}')))"
    return f"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN {rest} END AS rest FROM pages),
named AS (
  SELECT page_id, rest, coalesce({host}, '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, {told} AS told FROM cut
),
whole AS (
  SELECT page_id, host, path,
         CASE WHEN rest IS NOT NULL THEN regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/+$', '')
              || CASE WHEN len(told) > 0 THEN '?' || array_to_string(told, '&') ELSE '' END END AS canonical
  FROM named
),
listed AS (SELECT DISTINCT canonical FROM whole WHERE regexp_matches(host, '(^|[.-])({'|'.join(UNWANTED)})([.-]|$)')),
judged AS (SELECT page_id, host, path, CASE {fits} END AS rule, canonical IN (SELECT canonical FROM listed) AS inside FROM whole)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ({allow}) THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN inside THEN 'block' ELSE 'allow' END AS verdict,
       coalesce(inside, false) AS listed
FROM judged
"""
