"""Configuration of an inventory: source roots and settings, checked on reading."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field
from pathlib import Path

import yaml

# fixed values: words that a configuration key may not contain
SECRET_WORDS = ("password", "secret", "token", "api_key", "credential", "private_key")


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Root:
    source_root_id: str
    path: str
    enabled: bool = True
    access_policy: str = "read_only"


@dataclass(frozen=True)
class Config:
    roots: tuple[Root, ...]
    output_root: str
    threshold: int = 50
    batch_size: int = 500
    evidence_pages: tuple[int, ...] = (0, 1, 2)
    evidence_cap: int = 12000
    main_target: int = 600
    main_base: int = 15
    audit_targets: dict = field(default_factory=lambda: {"text_absent": 60, "mixed_text": 40, "filename_unmatched": 60})

    def enabled(self) -> dict[str, str]:
        return {r.source_root_id: r.path for r in self.roots if r.enabled}

    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()


def reject_secrets(value: object, at: str = "") -> None:
    if isinstance(value, dict):
        for k, v in value.items():
            if any(w in str(k).lower() for w in SECRET_WORDS):
                raise ConfigError(f"{at}{k} looks like a secret")
            reject_secrets(v, f"{at}{k}.")
    elif isinstance(value, list):
        for v in value:
            reject_secrets(v, at)


def _number(value: object, name: str) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value < 1:
        raise ConfigError(f"{name} must be a positive whole number")
    return value


def _absolute(value: object, name: str) -> str:
    if not isinstance(value, str) or not Path(value).is_absolute():
        raise ConfigError(f"{name} must be an absolute path")
    return value


def load(path: str | Path) -> Config:
    try:
        raw = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    except (OSError, yaml.YAMLError) as e:
        raise ConfigError(f"cannot read {path}: {e}") from e
    if not isinstance(raw, dict):
        raise ConfigError("the configuration must be a mapping")
    reject_secrets(raw)
    roots = []
    for i, r in enumerate(raw.get("source_roots") or ()):
        if not isinstance(r, dict) or not str(r.get("source_root_id") or "").strip():
            raise ConfigError(f"source_roots[{i}] needs a source_root_id")
        if r.get("access_policy", "read_only") != "read_only" or not isinstance(r.get("enabled", True), bool):
            raise ConfigError(f"{r['source_root_id']}: access_policy must be read_only, enabled a truth value")
        roots.append(Root(r["source_root_id"], _absolute(r.get("path"), f"source_roots[{i}].path"), r.get("enabled", True)))
    if not roots or len({r.source_root_id for r in roots}) < len(roots):
        raise ConfigError("source_roots must be there, with different ids")
    own = {k: _number(raw[k], k) for k in ("threshold", "batch_size", "evidence_cap", "main_target", "main_base") if k in raw}
    return Config(tuple(roots), _absolute(raw.get("output_root"), "output_root"), **own)
