"""Settings of the engine, as one value passed around."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from datetime import date
from pathlib import Path

# The sources of the data and the names of settings, which existing environments use.
BODIES = {1: "Equality Tribunal", 2: "Employment Appeals Tribunal", 3: "Labour Court", 15376: "Workplace Relations Commission"}
ENVIRONMENT = {
    "partition_size": "SCRAPER_PARTITION_SIZE", "min_content_bytes": "TRANSFORM_MIN_CONTENT_BYTES", "bodies": "SCRAPER_BODIES", "log_level": "SCRAPER_LOG_LEVEL", "retry_times": "SCRAPER_RETRY_TIMES",
    "landing_table": "MONGO_LANDING_COLLECTION", "processed_table": "MONGO_PROCESSED_COLLECTION", "quarantine_table": "MONGO_QUARANTINE_COLLECTION", "landing_bucket": "MINIO_LANDING_BUCKET", "processed_bucket": "MINIO_PROCESSED_BUCKET",
    "first_partition": "DAGSTER_PARTITION_START_DATE", "landing_retries": "DAGSTER_LANDING_MAX_RETRIES", "landing_retry_seconds": "DAGSTER_LANDING_RETRY_DELAY_SEC", "processed_retries": "DAGSTER_PROCESSED_MAX_RETRIES", "processed_retry_seconds": "DAGSTER_PROCESSED_RETRY_DELAY_SEC",
}


def body_pairs(value: str) -> dict[int, str]:
    """'3:Labour Court|15376:Another' as a mapping."""
    return {int(k): v.strip() for k, v in (x.split(":", 1) for x in value.split("|") if x.strip())}


def id_list(value: str | None) -> list[int] | None:
    """'3,15376' as ids; nothing means all."""
    return [int(x) for x in value.split(",") if x.strip()] if value else None


def env_file(path: str) -> dict[str, str]:
    """NAME=value lines of a file, quotes and comments left out; a missing file is empty."""
    if not Path(path).exists():
        return {}
    lines = (x.strip() for x in Path(path).read_text().splitlines())
    pairs = (x.removeprefix("export ").split("=", 1) for x in lines if "=" in x and not x.startswith("#"))
    return {k.strip(): v.strip().strip("\"'") for k, v in pairs}


@dataclass(frozen=True)
class EngineConfig:
    partition_size: str = "monthly"
    min_content_bytes: int = 1024
    transform_version: int = 2
    bodies: dict[int, str] = field(default_factory=lambda: dict(BODIES))
    selectors: tuple[str, ...] = ("div.col-sm-9", "div.content")
    log_level: str = "INFO"
    retry_times: int = 5
    landing_table: str = "landing_metadata"
    processed_table: str = "processed_metadata"
    quarantine_table: str = "quarantine_metadata"
    landing_bucket: str = "landing-zone"
    processed_bucket: str = "processed"
    first_partition: date = date(2020, 1, 1)
    landing_retries: int = 2
    landing_retry_seconds: int = 30
    processed_retries: int = 2
    processed_retry_seconds: int = 15

    def __post_init__(self):
        if self.partition_size not in ("monthly", "weekly", "daily"):
            raise ValueError(f"unknown partition size {self.partition_size!r}")

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None, path: str | None = None) -> "EngineConfig":
        """Settings by their environment names; an empty value counts as unset, the environment goes before the file."""
        env = (env_file(path) if path else {}) | dict(os.environ if env is None else env)
        readers = {int: int, date: date.fromisoformat, dict: body_pairs, str: str}
        given = {}
        for name, variable in ENVIRONMENT.items():
            if value := env.get(variable, "").strip():
                default = cls().bodies if name == "bodies" else getattr(cls, name)
                given[name] = readers[type(default)](value)
        return cls(**given)

    def body_names(self, ids: list[int] | None) -> list[str] | None:
        """Names of body ids; an unknown id is an error before anything is read."""
        if ids is None:
            return None
        if unknown := [i for i in ids if i not in self.bodies]:
            raise ValueError(f"unknown body ids {unknown}")
        return [self.bodies[i] for i in ids]
