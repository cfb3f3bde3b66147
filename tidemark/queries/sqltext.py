"""Small builders for the SQL counterparts."""

from __future__ import annotations

from collections.abc import Iterable


def r(x: str, digits: int = 6) -> str:
    """Rounded double; the addition turns a negative zero into zero."""
    return f"(round(CAST({x} AS DOUBLE), {digits}) + 0e0)"


def d(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def rounded(columns: Iterable[str], digits: int = 6) -> str:
    return ", ".join(f"{r(c, digits)} AS {c}" for c in columns)


def unit_bin(x: str, bins: int = 10) -> str:
    """Bin on the even grid over [0, 1]: how many edges i * step lie at or below x."""
    step = repr(1 / bins) + "e0" if "e" not in repr(1 / bins) else repr(1 / bins)
    below = " + ".join(f"CAST({x} >= {i} * {step} AS INTEGER)" for i in range(1, bins))
    return f"CASE WHEN {x} >= 0 AND {x} <= 1 THEN {below} END"


def confusion(label: str = "label", predicted: str = "predicted_default") -> str:
    return f"""count(*) AS n,
         count(*) FILTER (WHERE {label} = 1 AND {predicted} = 1) AS tp,
         count(*) FILTER (WHERE {label} = 0 AND {predicted} = 1) AS fp,
         count(*) FILTER (WHERE {label} = 0 AND {predicted} = 0) AS tn,
         count(*) FILTER (WHERE {label} = 1 AND {predicted} = 0) AS fn"""


def rate(part: str, whole: str) -> str:
    return f"coalesce(CAST({part} AS DOUBLE) / nullif({whole}, 0), 0)"


RATES = {
    "accuracy": rate("(tp + tn)", "n"),
    "precision": rate("tp", "tp + fp"),
    "recall": rate("tp", "tp + fn"),
    "f1_score": rate("2 * tp", "2 * tp + fp + fn"),
    "actual_default_rate": rate("(tp + fn)", "n"),
    "predicted_default_rate": rate("(tp + fp)", "n"),
    "false_negative_rate": rate("fn", "fn + tp"),
    "false_positive_rate": rate("fp", "fp + tn"),
}


def auc(source: str, keys: str, label: str, score: str) -> str:
    """AUC from average ranks over all rows of a key."""
    return f"""
  SELECT {keys}, (sum(CASE WHEN {label} = 1 THEN rk END) - npos * (npos + 1) / 2e0) / (CAST(npos AS DOUBLE) * nneg) AS auc
  FROM (SELECT {keys}, {label},
               rank() OVER (PARTITION BY {keys} ORDER BY {score})
                 + (count(*) OVER (PARTITION BY {keys}, {score}) - 1) / 2e0 AS rk,
               count(*) FILTER (WHERE {label} = 1) OVER (PARTITION BY {keys}) AS npos,
               count(*) FILTER (WHERE {label} = 0) OVER (PARTITION BY {keys}) AS nneg
        FROM {source})
  WHERE npos > 0 AND nneg > 0
  GROUP BY {keys}, npos, nneg"""
