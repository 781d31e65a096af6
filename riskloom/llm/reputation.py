"""URL filters: explicit rules first, then the reputation of the host by shrunken page outcomes.

Outcomes of labelled pages are counted per host, registered domain and public suffix. From the
suffix down, each level's bad share is shrunk towards the level above by a beta-binomial prior
whose strength is fitted to the data. A host is blocked where even the lower bound of its posterior
lies above the limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import stored

#: Lower end of the posterior's 95 % interval (normal), and the bad share above which a host is blocked.
Z, LIMIT = 1.645, 0.5
WEAKEST, STRONGEST = 2.0, 200.0


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Struct ``(rule, verdict)`` of the longest rule that fits, else null.

    A rule fits its host and all subdomains, where the path starts with the rule's path. Rules are
    a short list kept in the expression; of equally long ones the first in code point order counts.
    """
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``(page, bad)`` per labelled page: the document number that ends the url's path names its label.

    A page is bad where its document is of low quality or toxic; several labels of a document
    count as the worst, and labels without either mark or id are left out.
    """
    bad = F.max((F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")).alias("bad")
    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy("doc_id").agg(bad)
    number = F.regexp_extract("path", r"/([0-9]{1,18})(?:\.html|/)?\z", 1).try_cast("long")
    return pages.withColumn("doc_id", number).where("doc_id is not null").join(known, "doc_id").select("host", "bad")


def _levels(host: Column) -> dict[str, Column]:
    last = F.substring_index(host, ".", -1)
    return {"suffix": last, "domain": F.substring_index(host, ".", -2)}


def _shrink(rows: DataFrame, parent: str) -> DataFrame:
    """``rate`` of rows ``(n, bad, <parent>)``: shrunk to the parent's, with a strength from the moments of all rows."""
    n, p = F.col("n").cast("double"), F.col(parent)
    moments = rows.where("n > 0").agg(
        F.sum((F.col("bad") - n * p) ** 2 - n * p * (1 - p)).alias("over"), F.sum(n * (n - 1) * p * (1 - p)).alias("base"))
    rho = F.when(F.col("base") > 0, F.col("over") / F.col("base")).otherwise(0.0)
    strength = F.when(rho > 0, F.least(F.lit(STRONGEST), F.greatest(F.lit(WEAKEST), 1 / rho - 1))).otherwise(STRONGEST)
    fitted = moments.select(strength).scalar()
    return rows.withColumn("weight", n + fitted).withColumn("rate", (F.col("bad") + p * fitted) / F.col("weight"))


def reputations(hosts: DataFrame, seen: DataFrame) -> DataFrame:
    """``host, n, bad, rate, lower, host_verdict`` for every row of ``hosts (host)``, from outcomes ``seen (host, bad)``.

    The tables here have one row per host or fewer; the priors are scalar subqueries.
    A host without outcomes inherits its domain's rate with the prior's own spread; without any
    outcomes at all every host is allowed.
    """
    counted = seen.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    all_hosts = hosts.join(counted, "host", "left").na.fill(0, ["n", "bad"])
    all_hosts = stored(all_hosts.withColumns(_levels(F.col("host"))), "reputation-hosts")
    suffixes = all_hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = all_hosts.agg((F.sum("bad") + 1.0) / (F.sum("n") + 2.0)).scalar()
    suffixes = _shrink(suffixes.withColumn("overall", total), "overall").select("suffix", F.col("rate").alias("suffix_rate"))
    domains = all_hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = _shrink(domains.join(suffixes, "suffix"), "suffix_rate").select("domain", F.col("rate").alias("domain_rate"))
    shrunk = _shrink(all_hosts.join(domains, "domain"), "domain_rate")
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("weight") + 1))
    lower = F.col("rate") - Z * spread
    verdict = F.when((F.col("host") != "") & (lower > LIMIT), "block").otherwise("allow")
    return shrunk.select("host", "n", "bad", "rate", lower.alias("lower"), verdict.alias("host_verdict"))


def judged(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    A null url, or one without ``://``, has empty host and path, fits no rule and is allowed.
    Repeated pages and repeated rows count each. Rows that a rule decides are judged where they are
    read; all rows then join the hosts' verdicts by host (a hot host is left to skew splitting or a
    measured broadcast). Html is never read.
    """
    url = F.col("url").cast("string")
    read = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    known = reputations(read.select("host").distinct(), outcomes(read, labels)).select("host", "host_verdict")
    match = matching_rule(F.col("host"), F.col("path"), rules)
    return read.join(known, "host", "left").select(
        "page_id", "host", "path", match["rule"].alias("rule"), F.coalesce(match["verdict"], F.col("host_verdict"), F.lit("allow")).alias("verdict"))
