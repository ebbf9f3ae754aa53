"""Complementary-type rule resolution.

Lookup order for a lower-cased, stripped article type: exact key, else the
first key in declaration order with ``key in type or type in key``, else
the default target list.  Resolution runs on the *distinct* types only, so
its cost is independent of the catalog size; a rule table is broadcast
only up to a counted size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.text import strip
from .catalog import containing

BROADCAST_RULES = 10_000


def rule_table(spark: SparkSession, rules=config.COMPLEMENTARY_RULES) -> DataFrame:
    """``(rule_pos, rule_key, targets)`` with targets lower-cased."""
    rows = [(i, k.lower(), [t.lower() for t in ts]) for i, (k, ts) in enumerate(rules)]
    return spark.createDataFrame(rows, "rule_pos INT, rule_key STRING, targets ARRAY<STRING>")


def type_key(col="articleType"):
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(strip(c))


def _meeting(types: DataFrame, rules: DataFrame, type_col: str) -> DataFrame:
    """Types with the rules whose key contains them or is contained in them.  Up to ``BROADCAST_RULES`` rules (counted) are
    broadcast; more meet the types by substrings."""
    if rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        return types.join(F.broadcast(rules), F.contains(F.col(type_col), F.col("rule_key")) | F.contains(F.col("rule_key"), F.col(type_col)))
    both = containing(rules, "rule_key", types, type_col).unionByName(containing(types, type_col, rules, "rule_key"))
    return both.select(type_col, *rules.columns)


def resolve_types(types: DataFrame, rules: DataFrame, type_col: str = "type_lower",
                  default=config.DEFAULT_COMPLEMENTARY) -> DataFrame:
    """``(type_col, targets, rule_key, branch)`` for each distinct type.

    ``branch`` is 'exact', 'partial' or 'default'.
    """
    t = types.select(type_col).distinct()
    matched = _meeting(t, rules, type_col).groupBy(type_col).agg(
        F.min_by(F.struct("rule_key", "targets"),
                 F.struct(F.when(F.col("rule_key") == F.col(type_col), 0).otherwise(1), F.col("rule_pos"))).alias("m"))
    out = t.join(matched, type_col, "left")
    dflt = F.array(*[F.lit(x.lower()) for x in default])
    return out.select(
        type_col,
        F.coalesce(F.col("m.targets"), dflt).alias("targets"),
        F.col("m.rule_key").alias("rule_key"),
        F.when(F.col("m").isNull(), "default").when(F.col("m.rule_key") == F.col(type_col), "exact")
         .otherwise("partial").alias("branch"))
