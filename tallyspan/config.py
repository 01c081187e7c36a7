"""Settings of a deployment from a TOML file; paths also from the environment."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, field
from typing import Any

#: Fixed value: the judge's published least seconds between two requests.
LEAST_INTERVAL = 2.0
#: Environment variables that stand before the file's paths.
DATA_ROOT, WAREHOUSE = "TALLYSPAN_DATA_ROOT", "TALLYSPAN_WAREHOUSE"


@dataclass(frozen=True)
class Settings:
    base_url: str
    interval: float
    page_size: int
    timeout: float
    tries: int
    data_root: str
    seed: int = 0
    targets: dict[str, int] = field(default_factory=dict)
    keep_problem_name: bool = True

    def path(self, *names: str) -> str:
        return os.path.join(self.data_root, *names)

    @property
    def landing(self) -> str:
        return self.path("user_status")

    @property
    def journal(self) -> str:
        return self.path("progress.jsonl")

    @property
    def warehouse(self) -> str:
        return os.environ.get(WAREHOUSE) or self.path("warehouse")


def load(path: str) -> Settings:
    """Settings of a file; an error if it asks more often than the judge allows."""
    with open(path, "rb") as f:
        raw: dict[str, Any] = tomllib.load(f)
    api, cohort = raw["api"], raw.get("cohort", {})
    if float(api["min_interval_seconds"]) < LEAST_INTERVAL:
        raise ValueError(f"an interval of {api['min_interval_seconds']} seconds is below the judge's {LEAST_INTERVAL}")
    root = os.environ.get(DATA_ROOT) or raw["paths"]["data_root"]
    return Settings(
        str(api["base_url"]).rstrip("/"), float(api["min_interval_seconds"]), int(api["page_size"]), float(api["timeout_seconds"]), int(api["max_attempts"]),
        os.path.expanduser(root), int(cohort.get("seed", 0)), {str(k): int(v) for k, v in cohort.get("targets", {}).items()}, bool(raw.get("collection", {}).get("keep_problem_name", True)),
    )
