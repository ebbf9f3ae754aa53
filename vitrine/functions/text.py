"""String / formatting functions (F1-F9) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(s) -> Column:
    """Unicode-whitespace trim (Python ``str.strip``); ``F.trim`` only drops spaces."""
    return F.regexp_replace(_c(s), r"(?U)^\s+|\s+$", "")


def format_score(x) -> Column:
    """``0.873 -> '87.3%'``."""
    return F.format_string("%.1f%%", _c(x) * F.lit(100.0))


def truncate(s, max_len: int = 40) -> Column:
    """Cut to ``max_len`` characters, the last replaced by an ellipsis."""
    s = _c(s)
    return F.when(F.length(s) > max_len, F.concat(F.substring(s, 1, max_len - 1), F.lit("…"))).otherwise(s)


def prefix(s, n: int) -> Column:
    return F.left(_c(s), F.lit(n))


def title_case(s) -> Column:
    """Python ``str.title``: upper-case the first letter of every letter run,
    lower-case the rest (``t-shirts -> T-Shirts``; ``initcap`` alone gives ``T-shirts``)."""
    runs = F.regexp_extract_all(_c(s), F.lit("([A-Za-z]+|[^A-Za-z]+)"), 1)
    return F.array_join(F.transform(runs, lambda w: F.initcap(w)), "")


def rule_reason(source_type, target_type) -> Column:
    """Reason sentence of a rule-based recommendation."""
    head, rest = config.REASON_RULE.split("{target}")
    mid, tail = rest.split("{source}")
    return F.concat(F.lit(head), title_case(target_type), F.lit(mid), title_case(source_type), F.lit(tail))


def fallback_reason(source_type) -> Column:
    head, tail = config.REASON_FALLBACK.split("{source}")
    return F.concat(F.lit(head), _c(source_type), F.lit(tail))


def score_band(x) -> Column:
    x = _c(x)
    return (F.when(x >= config.SCORE_BAND_GREEN, "green")
             .when(x >= config.SCORE_BAND_YELLOW, "yellow").otherwise("red"))


def or_unknown(col, default: str = "Unknown") -> Column:
    return F.coalesce(_c(col).cast("string"), F.lit(default))
