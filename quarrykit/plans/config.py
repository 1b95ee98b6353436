"""Configuration: defaults under overrides, the environment on top, and where each value came from."""

from __future__ import annotations

import os
from pathlib import Path
from typing import Any


class ConfigError(ValueError):
    def __init__(self, key: str, value: Any, source: str, reason: str):
        super().__init__(f"[CONFIG_ERROR] key={key} value={value!r} source={source} reason={reason}")


def merged(defaults: dict, override: dict) -> dict:
    """Override over defaults, dict by dict."""
    out = dict(defaults)
    for k, v in override.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def _flat(d: dict, at: str = ""):
    for k, v in d.items():
        if isinstance(v, dict):
            yield from _flat(v, f"{at}{k}.")
        else:
            yield f"{at}{k}", v


class Config:
    """Values by dotted key, with the source of each."""

    def __init__(self, defaults: dict, override: dict | None = None, env: dict[str, str] | None = None, required: tuple[str, ...] = (), paths: tuple[str, ...] = (), base: str = "."):
        self.values = dict(_flat(merged(defaults, override or {})))
        given = dict(_flat(override or {}))
        self.sources = {k: "file" if k in given else "default" for k in self.values}
        for key, name in (env or {}).items():
            if os.environ.get(name):
                self.values[key], self.sources[key] = os.environ[name], f"env:{name}"
        for key in required:
            if self.values.get(key) in (None, ""):
                raise ConfigError(key, self.values.get(key), self.sources.get(key, "none"), "is required")
        for key in paths:
            if self.values.get(key):
                p = Path(os.path.expanduser(str(self.values[key])))
                self.values[key] = str(p if p.is_absolute() else (Path(base) / p).resolve())

    def __getitem__(self, key: str):
        return self.values[key]


def pair_dir(root: str, tag: str | None = None) -> str:
    """The folder of pairs: the tagged one, the parent if it holds pairs itself, or the only tagged one there is."""
    at = Path(root)
    if tag and (at / f"pairs_{tag}").is_dir():
        return str(at / f"pairs_{tag}")
    if any(at.glob("*/before.*")):
        return str(at)
    found = sorted(p for p in at.glob("pairs_*") if p.is_dir())
    if len(found) > 1:
        raise ValueError(f"more than one folder of pairs: {[p.name for p in found]}")
    if not found:
        raise FileNotFoundError(root)
    return str(found[0])
