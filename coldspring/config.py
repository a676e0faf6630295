"""Every setting that changes a result or a physical plan."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field


@dataclass(frozen=True)
class SplitConfig:
    seed: int = 42
    cold_user_share: float = 0.10
    cold_item_share: float = 0.05
    cold_below: int = 5
    test_share: float = 0.20
    relevant_from: float = 4.0
    min_user_ratings: int = 10
    min_item_ratings: int = 20


@dataclass(frozen=True)
class AlsConfig:
    factors: int = 128
    regularization: float = 100.0
    alpha: float = 1.0
    iterations: int = 12
    seed: int = 7


@dataclass(frozen=True)
class ContentConfig:
    genre_weight: float = 1.0
    year_weight: float = 0.5
    text_weight: float = 0.7
    text_dims: int = 64
    min_df: int = 2
    # Text embedding: the basis grows until the residual of every kept direction is below this share of its
    # weight; more than ``svd_passes`` passes are an error. Each pass adds the kept number of directions and as many
    # again, at least ``svd_oversample``; a basis of more than ``svd_basis`` such blocks is cut down.
    svd_tolerance: float = 1e-7
    svd_passes: int = 60
    svd_oversample: int = 10
    svd_basis: int = 12
    seed: int = 0
    # None means the English list that ships with Spark ML.
    stop_words: tuple | None = None


@dataclass(frozen=True)
class BlendConfig:
    k_user: float = 30.0
    k_item: float = 300.0
    k_content: float = 30.0


@dataclass(frozen=True)
class RerankConfig:
    mmr_lambda: float = 0.7
    popularity_penalty: float = 0.1
    candidates: int = 100


@dataclass(frozen=True)
class ScaleConfig:
    """Physical limits. They never change a result, only how the work is cut."""

    # An ordered or joined group above this many rows is split over tasks.
    rows_per_task: int = 1_000_000
    # Splitters and hot-key lists that get broadcast stay below this many rows (some tens of bytes each), so
    # that the limit above holds up to 2 * 10^12 rows.
    max_hot_rows: int = 2_000_000
    # Ratings gathered by one vectorised call (factor solve, profile sum): when the vectors
    # are broadcast, and when they are shuffled to the blocks (fewer, larger blocks ask for
    # fewer copies of each vector).
    edges_per_block: int = 20_000
    shipped_edges_per_block: int = 500_000
    # A user list of up to this many ids may be broadcast.
    broadcast_ids: int = 1_000_000
    # Up to this size the catalog is broadcast; above it, it is cut into shards.
    broadcast_bytes: int = 256 * 1024 * 1024
    # Factors are renewed in each half-step: up to this size they are collected and broadcast, above it they are shuffled.
    renewed_bytes: int = 32 * 1024 * 1024
    # Size of one catalog shard and one block of users in the sharded plan.
    shard_bytes: int = 128 * 1024 * 1024
    # Scores held at once by one scoring call.
    cells_per_batch: int = 400_000


@dataclass(frozen=True)
class EngineConfig:
    dataset: str = "tables"
    k: int = 10
    extra_ks: tuple = (5, 20)
    # Scores that agree to this many decimals count as tied (then lowest id first).
    score_digits: int = 12
    popularity_smoothing: float = 1000.0
    max_eval_users: int | None = None
    split: SplitConfig = field(default_factory=SplitConfig)
    als: AlsConfig = field(default_factory=AlsConfig)
    content: ContentConfig = field(default_factory=ContentConfig)
    blend: BlendConfig = field(default_factory=BlendConfig)
    rerank: RerankConfig = field(default_factory=RerankConfig)
    scale: ScaleConfig = field(default_factory=ScaleConfig)

    @property
    def ks(self) -> list[int]:
        return sorted({self.k, *self.extra_ks})

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> "EngineConfig":
        raw = json.loads(text)
        parts = {"split": SplitConfig, "als": AlsConfig, "content": ContentConfig,
                 "blend": BlendConfig, "rerank": RerankConfig, "scale": ScaleConfig}
        for name, kind in parts.items():
            raw[name] = kind(**{key: tuple(value) if isinstance(value, list) else value
                                for key, value in raw[name].items()})
        raw["extra_ks"] = tuple(raw["extra_ks"])
        return EngineConfig(**raw)
