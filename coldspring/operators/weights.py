"""Trust weights as column expressions, for tables of (user, item) counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldspring.config import BlendConfig

SIGNALS = ("cf", "content", "popularity")


def confidence(n: Column, k: float) -> Column:
    return n / (n + F.lit(float(k)))


def pair_weights(n_user: Column, n_item: Column, cfg: BlendConfig, mode: str, cold_below: int) -> dict[str, Column]:
    """Weight of each signal for one (user, item); they sum to 1."""
    if mode == "fixed":
        return {"cf": F.lit(0.5), "content": F.lit(0.5), "popularity": F.lit(0.0)}
    if mode == "switch":
        warm = (n_user >= cold_below) & (n_item >= cold_below)
        return {"cf": F.when(warm, 1.0).otherwise(0.0),
                "content": F.when(~warm & (n_user > 0), 1.0).otherwise(0.0),
                "popularity": F.when(~warm & (n_user == 0), 1.0).otherwise(0.0)}
    cf = confidence(n_user, cfg.k_user) * confidence(n_item, cfg.k_item)
    t = confidence(n_user, cfg.k_content)
    return {"cf": cf, "content": (1 - cf) * t, "popularity": (1 - cf) * (1 - t)}


def watched_shares(item_stats: DataFrame, cfg: BlendConfig, cold_below: int) -> dict[str, float]:
    """Two facts about the catalog, averaged over items by how often they are rated: the
    mean item trust, and the share of items that are warm. As every weight is a function of
    the user times one of these, mean weights need no user x item work."""
    total = F.greatest(F.sum("n_item"), F.lit(1)).cast("double")
    row = item_stats.agg(
        (F.sum(confidence(F.col("n_item"), cfg.k_item) * F.col("n_item")) / total).alias("item_trust"),
        (F.sum(F.when(F.col("n_item") >= cold_below, F.col("n_item")).otherwise(0)) / total).alias("warm_share"),
        (F.sum("n_item") / total).alias("all_share")).first()
    return row.asDict()


def mean_weights(n_user: Column, shares: dict[str, float], cfg: BlendConfig, mode: str,
                 cold_below: int) -> dict[str, Column]:
    """Mean weight of each signal for a user, items averaged by how often they are rated."""
    whole = F.lit(shares["all_share"])
    if mode == "fixed":
        return {"cf": 0.5 * whole, "content": 0.5 * whole, "popularity": 0.0 * whole}
    if mode == "switch":
        cf = F.when(n_user >= cold_below, F.lit(shares["warm_share"])).otherwise(F.lit(0.0))
        return {"cf": cf, "content": F.when(n_user > 0, whole - cf).otherwise(F.lit(0.0)),
                "popularity": F.when(n_user > 0, F.lit(0.0)).otherwise(whole)}
    cf = confidence(n_user, cfg.k_user) * F.lit(shares["item_trust"])
    t = confidence(n_user, cfg.k_content)
    return {"cf": cf, "content": (whole - cf) * t, "popularity": (whole - cf) * (1 - t)}
