"""Configuration files."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path


def flatten(config: Mapping, prefix: str = "") -> dict[str, str]:
    """Nested maps as UPPER_SNAKE names; lists are left out, booleans in lower case."""
    out: dict[str, str] = {}
    for key, value in config.items():
        name = f"{prefix}_{key}" if prefix else str(key)
        if isinstance(value, Mapping):
            out |= flatten(value, name)
        elif not isinstance(value, list):
            out[name.upper()] = str(value).lower() if isinstance(value, bool) else str(value)
    return out


def load(path: str) -> dict:
    """A YAML or JSON file on the driver."""
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        import json

        return json.loads(text)
    return yaml.safe_load(text) or {}


def resolve(path: str, base: str) -> str:
    p = Path(path).expanduser()
    return str(p if p.is_absolute() else (Path(base).parent / p).resolve())


def prompt(path: str) -> str:
    """A prompt file; placeholders that were never filled are refused."""
    if path.endswith(".placeholder"):
        raise ValueError(f"{path} is a placeholder, not a prompt")
    text = Path(path).read_text(encoding="utf-8")
    if not text.strip():
        raise ValueError(f"{path} is empty")
    return text
