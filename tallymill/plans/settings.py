"""Knobs of a pipeline run, with their bounds; TALLYMILL_<NAME> in the environment overrides a default."""

from __future__ import annotations

import os
from dataclasses import asdict, dataclass, fields


@dataclass(frozen=True)
class Settings:
    seed: int = 1750
    near_dup_threshold: float = 0.92
    embedding_dim: int = 512
    min_cluster_size: int = 5
    sample_size: int = 50
    max_labels: int = 500
    min_human_labels: int = 30
    bootstrap_resamples: int = 10_000
    min_class_support: int = 5
    min_export_kappa: float = 0.6
    few_shot_path: str = ""
    human_label_path: str = ""

    def __post_init__(self) -> None:
        for name, low, high in (
            ("near_dup_threshold", 0.0, 1.0), ("min_export_kappa", -1.0, 1.0), ("embedding_dim", 2, 1 << 16), ("min_cluster_size", 2, 1 << 20), ("sample_size", 1, 1 << 40),
            ("max_labels", 1, 1 << 40), ("min_human_labels", 1, 1 << 40), ("bootstrap_resamples", 1, 1 << 30), ("min_class_support", 1, 1 << 30),
        ):
            if not low <= getattr(self, name) <= high:
                raise ValueError(f"{name} must lie in [{low}, {high}]")

    @staticmethod
    def from_env(**given: object) -> Settings:
        found = {f.name: type(f.default)(os.environ["TALLYMILL_" + f.name.upper()]) for f in fields(Settings) if "TALLYMILL_" + f.name.upper() in os.environ}
        return Settings(**(found | given))

    def snapshot(self) -> tuple[tuple[str, object], ...]:
        return tuple(sorted(asdict(self).items()))
