"""URL filters: host suffixes and path prefixes of each URL, equi-joined with rules on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, free_name, named

#: Hex digits of a digest on which the join is made; the rest is confirmed afterwards.
PREFIX_DIGITS = 8
#: Rules are broadcast up to this count (each is a few hundred bytes); beyond it Spark shuffles the join.
BROADCAST_RULES = 50_000
#: Rules with longer paths are refused: every distinct rule length is a prefix length to look up.
MAX_RULE_PATH = 2048


def _split(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or a URL without ://."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return ascii_lower(host), path


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit(" "), path).cast("binary"), 256)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, action) with their string, digest and join key. Rules whose host is null or empty fit nothing and go; of
    rules with equal host and path block wins over allow."""
    path = F.coalesce(F.col("path"), F.lit(""))
    host = ascii_lower(F.col("host"))
    clean = rules.where(F.length("host") > 0).select(host.alias("host"), path.alias("path"), "action")
    return (
        clean.groupBy("host", "path")
        .agg(F.max("action").alias("action"))
        .select(
            F.concat("host", "path").alias("r_rule"),
            F.col("action").alias("r_action"),
            _digest(F.col("host"), F.col("path")).alias("r_digest"),
            F.length("host").alias("r_host_len"),
            F.length("path").alias("r_path_len"),
            F.size(F.split("host", "\\.")).alias("r_labels"),
        )
        .withColumn("r_key", F.substring("r_digest", 1, PREFIX_DIGITS))
    )


def judge_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict to each row of df.

    A rule (host, path, action) fits its host and all subdomains if the URL's path starts with the rule's path; of several that fit,
    the longest (host and path together, then host) decides. Where none fits, rule is null and the verdict is `default`. Null URLs
    and URLs without :// have an empty host and path, and no rule fits them. Repeated rows stay; other columns stay whatever their
    names, except that host, path, rule and verdict of the input are replaced (a URL column with such a name is read first). URLs of any
    length are taken whole: how many expressions a URL has depends on the rules. Empty tables give empty results, and without rules all
    get `default`.

    Each distinct URL is expanded into host suffixes (no more labels than a rule has) times path prefixes (lengths that rules have),
    the expressions are joined with the rules on the first digits of their SHA-256, and then the whole digest is confirmed.
    """
    ready = prepare_rules(rules)
    stats = ready.agg(F.count("*"), F.max("r_labels"), F.max("r_path_len"), F.collect_set("r_path_len")).first()
    n_rules, labels, longest, lengths = stats[0], stats[1] or 0, stats[2] or 0, sorted(stats[3])
    if longest > MAX_RULE_PATH:
        raise ValueError(f"a rule's path has {longest} characters; {MAX_RULE_PATH} are allowed")
    u_url, u_best = (free_name(x, [*df.columns, "host", "path", "rule", "verdict"]) for x in ("u_url", "u_best"))
    host, path = _split(named(url_col))
    base = df.withColumn(u_url, named(url_col)).withColumns({"host": host, "path": path})
    if not n_rules:
        return base.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)}).drop(u_url)

    parts = F.split("u_host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))), lambda k: F.array_join(F.slice(parts, -k, k), "."))
    fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("u_path"))
    prefixes = F.transform(fitting, lambda n: F.substring(F.col("u_path"), F.lit(1), n))
    u_host, u_path = _split(F.col("u_url"))
    expressions = (
        df.where(named(url_col).contains("://"))
        .select(named(url_col).alias("u_url"))
        .distinct()
        .select("u_url", u_host.alias("u_host"), u_path.alias("u_path"))
        .select("u_url", F.explode(suffixes).alias("e_host"), prefixes.alias("e_paths"))
        .select("u_url", "e_host", F.explode("e_paths").alias("e_path"))
        .select("u_url", _digest(F.col("e_host"), F.col("e_path")).alias("e_digest"))
    )
    lookup = F.broadcast(ready) if n_rules <= BROADCAST_RULES else ready
    best = F.max_by(F.struct("r_rule", "r_action"), F.struct(F.length("r_rule"), F.col("r_host_len")))
    verdicts = (
        expressions.join(lookup, F.substring("e_digest", 1, PREFIX_DIGITS) == F.col("r_key"))
        .where(F.col("e_digest") == F.col("r_digest"))
        .groupBy("u_url")
        .agg(best.alias(u_best))
        .withColumnRenamed("u_url", u_url)
    )
    judged = base.join(verdicts, u_url, "left").withColumns({"rule": F.col(u_best)["r_rule"], "verdict": F.coalesce(F.col(u_best)["r_action"], F.lit(default))})
    return judged.drop(u_url, u_best)
