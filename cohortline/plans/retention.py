"""Retention from assets to classified months."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame

from cohortline.operators import retention as ret


def retention(assets: DataFrame, start: date | str, as_of: datetime | str) -> dict[str, DataFrame]:
    """Every step of the chain, lazily; write the ones that are read more than once."""
    log = ret.create_destroy_log(assets, start, as_of)
    history = ret.cumulative_history(log)
    months = ret.active_months(history)
    forward = ret.retention_forward(months)
    return {
        "log": log,
        "history": history,
        "months": months,
        "backward": ret.retention_backward(months),
        "forward": forward,
        "churn": ret.churn_month(forward),
    }
