"""Settings: a TOML file with overrides from the environment."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """What jobs read; each field may be overridden by QUAVER_<NAME>."""

    root: str = "."
    partitions: int = 200
    shards: int = 7
    reserve_bytes: int = 0
    headroom: float = 3.0

    @classmethod
    def read(cls, path: str | None = None, environment: dict[str, str] | None = None) -> Settings:
        values: dict = {}
        if path:
            with open(path, "rb") as f:
                values = tomllib.load(f)
        environment = os.environ if environment is None else environment
        known = {f.name: type(f.default) for f in fields(cls)}
        unknown = values.keys() - known.keys()
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        values |= {name: environment[f"QUAVER_{name.upper()}"] for name in known if f"QUAVER_{name.upper()}" in environment}
        return cls(**{name: known[name](v) for name, v in values.items()})
