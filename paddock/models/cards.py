"""Which model the card describes, and the card's text."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F

# Models a card may describe, and its standing remarks.
CARD_MODELS = ("ridge", "auto_ridge", "median")


def card_model_pick(metrics: DataFrame) -> DataFrame:
    """Row of the card model with the least MAE (name decides ties)."""
    return (
        metrics.where(F.col("model_name").isin(*CARD_MODELS)).orderBy("mae_eur", "model_name").limit(1)
    )


def model_card(metrics: dict, limitations: list[str] = (), usage: list[str] = ()) -> str:
    """Markdown card of one model."""
    name = metrics.get("model_name", "unknown_model")
    numbers = {k: v for k, v in metrics.items() if k != "model_name"}
    lines = [f"# Model Card: {name}", "", "## Purpose", ""]
    lines += ["Estimate listing prices from cleaned Gold listings.", "", "## Target", "", "`price_in_eur`", ""]
    lines += ["## Metrics", "", "```json", json.dumps(numbers, indent=2, sort_keys=True), "```", ""]
    for title, items in (("Limitations", limitations), ("Usage Notes", usage)):
        lines += [f"## {title}", "", *([f"- {item}" for item in items] or ["- Not specified"]), ""]
    return "\n".join(lines)
