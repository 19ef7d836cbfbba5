"""URL filters by hashed host-suffix and path-prefix expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemart.llm.common import lower_ascii, own_names

RULE_SCHEMA = StructType([StructField(n, StringType()) for n in ("host", "path", "verdict")])

# Hexadecimal digits of the digest that the equi-join uses (4 bytes); the rest is confirmed after it.
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """Lower-cased host: from after the first ``://`` to ``/``, ``?``, ``#`` or the end; empty without one."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


@own_names
def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` appended (columns of those names are replaced).

    A rule fits its host and all subdomains when the path starts with the rule's path; the longest rule (code points of host
    and path) wins, then the longer host, then ``block``.  Only expressions of a shape some rule has (labels in the host, length
    of the path) can fit, so a URL yields as many expressions as there are shapes, not as many as it has prefixes.  Expressions
    meet rules on the first 4 bytes of their SHA-256; the full digest is then confirmed.  Each distinct (host, path prefix) is
    judged once, so a host with a third of the pages costs no more than another.

    Null URLs and URLs without ``://``: empty host and path, no rule, the default verdict.  Rules with a null or empty host or
    an unknown verdict are ignored, a null path counts as empty, repeated rules count once.  Empty tables give empty results.
    """
    known = (rules.select(lower_ascii(F.col("host")).alias("_h"), F.coalesce("path", F.lit("")).alias("_p"), F.col("verdict").alias("_v"))
             .where("_h <> '' AND _v IN ('allow', 'block')"))
    known = (known.groupBy("_h", "_p").agg(F.max("_v").alias("_v"))
             .withColumn("_labels", F.size(F.split("_h", r"\."))).withColumn("_chars", F.length("_p"))
             .withColumn("_digest", F.sha2(F.concat("_h", "_p"), 256)))
    # Distinct shapes: bounded by label counts times path lengths, whatever the number of rules.
    shapes = [(r[0], r[1]) for r in known.select("_labels", "_chars").distinct().collect()]
    longest = max((chars for _, chars in shapes), default=0)

    judged = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    judged = judged.withColumn("_start", F.substring("path", 1, longest))
    targets = judged.select(F.col("host").alias("_host"), F.col("_start").alias("_from")).where("_host <> ''").distinct()
    labels = F.split("_host", r"\.")
    expressions = [
        F.when((F.size(labels) >= n) & (F.length("_from") >= chars),
               F.struct(F.substring_index("_host", ".", -n).alias("h"), F.substring("_from", 1, chars).alias("p")))
        for n, chars in shapes]
    if not expressions:
        return judged.drop("_start").withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    expanded = (targets.select("_host", "_from", F.explode(F.array_compact(F.array(*expressions))).alias("_e"))
                .withColumn("_full", F.sha2(F.concat("_e.h", "_e.p"), 256)))
    rule = F.struct(F.length(F.concat("_h", "_p")).alias("n"), F.length("_h").alias("host_n"), "_v", F.concat("_h", "_p").alias("rule"))
    won = (expanded.join(known, F.substring("_full", 1, PREFIX_DIGITS) == F.substring("_digest", 1, PREFIX_DIGITS))
           .where("_full = _digest AND _e.h = _h AND _e.p = _p")
           .groupBy("_host", "_from").agg(F.max(rule).alias("_won")))
    return (judged.join(won, (F.col("host") == F.col("_host")) & (F.col("_start") == F.col("_from")), "left")
            .withColumns({"rule": F.col("_won.rule"), "verdict": F.coalesce("_won._v", F.lit(default))})
            .drop("_start", "_host", "_from", "_won"))
