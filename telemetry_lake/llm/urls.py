"""URL verdicts: rules by host and path first, then a list of canonical URLs.

Listed URLs go into a blocked Bloom filter of bounded size. What it lets through is a
small part of the rows; only that part is shuffled to an exact hash join with the list,
which removes false positives.

Defined cases: a null url, or one without `://`, has an empty host and path, fits no
rule, is never listed and is allowed; repeated rows are judged row by row; an empty list
blocks nothing; longest rule wins, a tie goes to the one that stands first; only id and
url are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm import bloom

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Parameters that tell where a reader came from, not which page it is.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains, where the url's path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"^(?s).*?://", "")), F.lit(""))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without `www.` and default port, path without end slash, other parameters in order.

    Null where there is no host, so that such urls are never listed.
    """
    site = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), r":(80|443)$", "")
    place = F.regexp_replace(path(url), r"/+$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.sort_array(F.filter(F.split(query, "&"), lambda one: (one != "") & ~one.rlike(TRACKING)))
    text = F.concat(site, place, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))
    return F.when(host(url) != "", text)


def fitting(rules: list[Rule], on_host: Column, on_path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null. For some hundred rules at most."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ordered = sorted(rules, key=lambda rule: -len(rule.name))
    for rule in reversed(ordered):
        fits = ((on_host == rule.host) | on_host.endswith(f".{rule.host}")) & on_path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def judge(
    pages: DataFrame, listed: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
    max_bytes: int = bloom.MAX_BYTES,
) -> DataFrame:
    """page_id, host, path, rule, verdict and listed of every url; `listed` has a column `canonical`."""
    url = F.col(url_col)
    parts = pages.select(F.col(id_col).alias("page_id"), host(url).alias("host"), path(url).alias("path"), canonical(url).alias("canonical"))
    name, verdict = fitting(rules, F.col("host"), F.col("path"))
    rows = parts.select("page_id", "host", "path", name.alias("rule"), verdict.alias("ruled"), "canonical")
    listed = listed.select("canonical").where("canonical IS NOT NULL").distinct()
    key = F.xxhash64("canonical")
    bits = pages.sparkSession.sparkContext.broadcast(bloom.build(listed.select(key.alias("key")), "key", max_bytes))

    @F.pandas_udf("boolean")
    def possible(keys: pd.Series) -> pd.Series:
        return pd.Series(bloom.might_contain(bits.value, keys.to_numpy()))

    rows = rows.withColumn("possible", F.col("canonical").isNotNull() & possible(key))
    hits = rows.where("possible").join(listed.withColumn("listed", F.lit(True)), "canonical", "left")
    columns = ["page_id", "host", "path", "rule", "ruled", F.coalesce("listed", F.lit(False)).alias("listed")]
    both = hits.select(*columns).union(rows.where("NOT possible").withColumn("listed", F.lit(False)).select(*columns))
    method = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return both.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "listed")
