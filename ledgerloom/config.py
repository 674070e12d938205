"""Settings from the environment and a .env file (SRC-18)."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path

PREFIX = "LEDGERLOOM_"


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Settings:
    store: str = "data/store"
    artifacts: str = "data"
    archive: str = "https://www.sec.gov/Archives"
    user_agent: str = ""
    requests_per_second: float = 5.0
    http_timeout: float = 30.0
    embeddings_enabled: bool = False
    embedding_url: str = ""
    embedding_key: str = ""
    embedding_model: str = "text-embedding-3-small"
    embedding_dimension: int = 1536
    embedding_batch: int = 64
    embedding_timeout: float = 60.0
    log_level: str = "INFO"


def read_env_file(path: str | Path) -> dict[str, str]:
    """KEY=value lines; comments and blank lines are skipped, quotes around a value dropped."""
    found = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines() if Path(path).is_file() else ():
        key, sep, value = line.strip().removeprefix("export ").partition("=")
        if sep and not key.startswith("#"):
            value = value.strip()
            found[key.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value
    return found


def _typed(name: str, text: str, kind: type):
    if kind is bool:
        value = {"1": True, "true": True, "yes": True, "on": True, "0": False, "false": False, "no": False, "off": False, "": False}.get(text.strip().lower())
        if value is None:
            raise ConfigError(f"{name} is not a boolean: {text!r}")
        return value
    try:
        value = kind(text)
    except ValueError as error:
        raise ConfigError(f"{name} is not {kind.__name__}: {text!r}") from error
    if kind in (int, float) and not value > 0:
        raise ConfigError(f"{name} has to be positive: {text!r}")
    return value


def load_settings(env: Mapping[str, str] | None = None, env_file: str | Path = ".env") -> Settings:
    """Environment variables win over the file; both are named LEDGERLOOM_ and the setting in capitals."""
    given = read_env_file(env_file) | dict(os.environ if env is None else env)
    kinds = {"str": str, "float": float, "int": int, "bool": bool}
    return Settings(**{f.name: _typed(PREFIX + f.name.upper(), given[PREFIX + f.name.upper()], kinds[str(f.type)]) for f in fields(Settings) if PREFIX + f.name.upper() in given})
