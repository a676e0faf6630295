"""URL filter: a sort-merge range join of urls with nested host and path rules. DataFrame operations only.

A host is written label by label from the right, each label in hex, joined by ``!``, so that a rule's
host and all its subdomains are one interval of keys. A sorted sweep over urls and interval ends carries
the stack of rule hosts that are open at each url. A second sweep does the same for the paths of each
open host, where the top of the stack is the longest rule path that starts the url's path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldspring.llm import ordered
from coldspring.workspace import Workspace

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
AFTER_HOST = '"'   # sorts after "!" and before every hex digit
AFTER_PATH = "G"   # sorts after every hex digit


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^/?#]*)", 1), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    labels = F.reverse(F.split(host, r"\."))
    return F.array_join(F.transform(labels, lambda label: F.hex(F.encode(label, "UTF-8"))), "!")


def path_key(host: Column, path: Column) -> Column:
    return F.concat(F.hex(F.encode(host, "UTF-8")), F.lit("!"), F.hex(F.encode(path, "UTF-8")))


def _host_marks(rules: DataFrame) -> DataFrame:
    """(key, open_hosts): the rule hosts that are open after each interval end, outermost first."""
    hosts = rules.select(F.col("_rule_host").alias("_h")).distinct()
    labels = F.split("_h", r"\.")
    suffixes = hosts.select("_h", F.explode(F.sequence(F.lit(1), F.size(labels))).alias("_n"), labels.alias("_labels"))
    suffixes = suffixes.select("_h", "_n", F.array_join(F.slice("_labels", -F.col("_n"), F.col("_n")), ".").alias("_outer"))
    # At most one entry per label of the host.
    chains = (suffixes.join(hosts.select(F.col("_h").alias("_outer")), "_outer")
              .groupBy("_h").agg(F.transform(F.sort_array(F.collect_list(F.struct("_n", "_outer"))), lambda s: s["_outer"]).alias("_chain")))
    key = host_key(F.col("_h"))
    start = chains.select(key.alias("_key"), F.col("_chain").alias("_open"))
    end = chains.select(F.concat(key, F.lit(AFTER_HOST)).alias("_key"), F.slice("_chain", 1, F.size("_chain") - 1).alias("_open"))
    return start.unionByName(end)


def _path_marks(rules: DataFrame) -> DataFrame:
    """(key, top): after each interval end, the innermost open path rule of that host, as an array of 0 or 1."""
    rule = F.struct("_rule_host", "_rule_path", "_rule_verdict")
    own = rules.select("_rule_host", "_rule_path", F.array(rule).alias("_top"))
    prefixes = rules.filter(F.length("_rule_path") > 0).select(
        F.col("_rule_host"), F.col("_rule_path").alias("_inner"),
        F.explode(F.sequence(F.lit(0), F.length("_rule_path") - 1)).alias("_n"))
    prefixes = prefixes.withColumn("_rule_path", F.expr("substring(_inner, 1, _n)"))
    outer = (prefixes.join(own, ["_rule_host", "_rule_path"])
             .groupBy("_rule_host", "_inner").agg(F.max_by("_top", "_n").alias("_outer")))
    here = own.join(outer.withColumnRenamed("_inner", "_rule_path"), ["_rule_host", "_rule_path"], "left")
    key = path_key(F.col("_rule_host"), F.col("_rule_path"))
    none = F.slice("_top", 1, 0)
    return (here.select(key.alias("_key"), "_top")
            .unionByName(here.select(F.concat(key, F.lit(AFTER_PATH)).alias("_key"), F.coalesce("_outer", none).alias("_top"))))


def judge_urls(urls: DataFrame, rules: DataFrame, workspace: Workspace, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """One row (id, host, path, rule, verdict) per row of ``urls``.

    ``rules``: (host, path, verdict) with verdict ``allow`` or ``block``. A rule fits its host and all
    subdomains if the url's path starts with the rule's path (a null path fits all). Of the rules that fit,
    the longest host + path wins, at equal length the one with the longer host. ``rule`` is that text, or null if
    no rule fits; the verdict is then ``default``.

    Null urls and urls without ``://`` have empty host and path and fit no rule. Rules without a host are
    ignored. If a rule is given as allow and as block, it blocks. Repeated ids and urls keep their rows, only the id
    and url columns are read, and an empty table on either side is fine.
    """
    pages = urls.select(F.col(id_col).alias("_id"), url_host(F.col(url_col)).alias("_host"), url_path(F.col(url_col)).alias("_path"))
    clean = (rules.filter(F.col("host").isNotNull() & (F.col("host") != ""))
             .groupBy(F.translate("host", UPPER, UPPER.lower()).alias("_rule_host"), F.coalesce("path", F.lit("")).alias("_rule_path"))
             .agg(F.max("verdict").alias("_rule_verdict")))
    places = pages.filter(F.col("_host") != "").select("_host", "_path").distinct().withColumn("_key", host_key(F.col("_host")))
    hosts_open = ordered.sweep(places, _host_marks(clean), workspace, "_key", "_open", F.xxhash64("_path"), "url-hosts")
    inside = (hosts_open.select("_host", "_path", F.explode("_open").alias("_node"))
              .withColumn("_key", path_key(F.col("_node"), F.col("_path"))))
    fits = ordered.sweep(inside, _path_marks(clean), workspace, "_key", "_top", F.xxhash64("_host"), "url-paths")
    rule = F.col("_top")[0]
    text = F.concat(rule["_rule_host"], rule["_rule_path"])
    best = (fits.filter(F.size("_top") > 0)
            .groupBy("_host", "_path")
            .agg(F.max(F.struct(F.length(text).alias("_long"), F.length(rule["_rule_host"]).alias("_wide"),
                                text.alias("_rule"), rule["_rule_verdict"].alias("_verdict"))).alias("_best")))
    return (pages.join(best, ["_host", "_path"], "left")
            .select(F.col("_id").alias(id_col), F.col("_host").alias("host"), F.col("_path").alias("path"),
                    F.col("_best")["_rule"].alias("rule"),
                    F.coalesce(F.col("_best")["_verdict"], F.lit(default)).alias("verdict")))
