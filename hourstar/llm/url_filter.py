"""Allow and block rules for URLs, found through their rarest token.

A rule is a host followed by a path prefix, such as ``example.com/en/``. It fits the host and all its
subdomains if the URL's path starts with the rule's. The longest fitting rule gives the verdict; of equally
long ones a block wins, then the first by name. URLs that no rule fits are allowed.

Every rule is indexed under one token, the one that the fewest rules hold. The tokens of a URL fetch the
rules under them, and only those run their regular expression. A rule without a complete token (its
characters could be part of a longer run in a URL) is indexed under the empty token, which every URL has.

Defined results. Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
there up to ``?``, ``#`` or the end. Null URL or no ``://``: both empty, allowed. Repeated rows are judged each.
An empty rule table allows all. Other columns are ignored, unless named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_VERDICT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1), F.lit(""))
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def tokens(text: Column) -> Column:
    """Distinct runs of ASCII letters and digits."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"([A-Za-z0-9]+)"), 1))


def index_rules(rules: DataFrame) -> DataFrame:
    """``token, rule, verdict, regex, length`` for rules given as ``rule, verdict``; one row per rule."""
    given = rules.select("rule", "verdict").where("rule IS NOT NULL AND verdict IS NOT NULL").distinct()
    # A last token at the rule's end may go on in the URL; with a character behind it, it is complete.
    complete = tokens(F.regexp_replace("rule", r"[A-Za-z0-9]+$", ""))
    spread = given.select("rule", F.explode(F.when(F.size(complete) > 0, complete).otherwise(F.array(F.lit("")))).alias("token"))
    counted = spread.groupBy("token").agg(F.countDistinct("rule").alias("held"))
    rarest = (
        spread.join(counted, "token").groupBy("rule").agg(F.min(F.struct("held", "token")).alias("least"))
        .select("rule", F.col("least.token").alias("token"))
    )
    regex = F.concat(F.lit(r"^(?:[^/]*\.)?\Q"), F.col("rule"), F.lit(r"\E"))
    return given.join(rarest, "rule").select("token", "rule", "verdict", regex.alias("regex"), F.length("rule").alias("length"))


def judge(urls: DataFrame, rules: DataFrame, *, url_col: str = "url", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, ``host, path, rule, verdict`` of every row of ``urls``.

    One exchange: the tokens of a row meet again after a partial aggregate, so it moves one row per URL.
    Whether the index is broadcast is left to its size.
    """
    kept = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    host, path = host_and_path(F.col(url_col))
    rows = urls.select(F.monotonically_increasing_id().alias("row"), host.alias("host"), path.alias("path"), *kept)
    probes = rows.withColumn("token", F.explode(F.array_append(tokens(F.concat("host", "path")), F.lit(""))))
    found = probes.join(index_rules(rules), "token", "left")
    fits = F.expr("concat(host, path) RLIKE regex")
    # Order of preference: the longest, then block, then the name.
    choice = F.when(fits, F.struct((-F.col("length")).alias("l"), (F.col("verdict") != "block").alias("a"), "rule", "verdict"))
    best = found.groupBy("row").agg(
        F.min(choice).alias("best"), *[F.first(c).alias(c) for c in ("host", "path", *[f"kept_{i}" for i in range(len(keep))])]
    )
    return best.select(
        *[F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)], "host", "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(DEFAULT_VERDICT)).alias("verdict"),
    )
