"""Pipeline and storage configuration: strict models, file lookup, overrides, path guards."""

from __future__ import annotations

import os
from pathlib import Path
from typing import Any, Literal

import yaml
from pydantic import BaseModel, ConfigDict, Field, ValidationError

from webloom.errors import ConfigError


class Strict(BaseModel):
    """Unknown keys are errors, so that a misspelt setting can't pass silently."""

    model_config = ConfigDict(extra="forbid")


class ScopeParams(Strict):
    min_language_share: float = Field(0.25, ge=0, le=1)
    min_crawls_language: int = Field(2, ge=1)
    subdomain_handling: Literal["root_only", "include", "aggregate"] = "root_only"


class CrawlWindow(Strict):
    recent_count: int = Field(6, ge=1)
    historical_anchors: bool = True


class Languages(Strict):
    targets: list[str] = Field(default_factory=list)


class Authority(Strict):
    damping: float = Field(0.85, gt=0, lt=1)
    tol: float = Field(0.001, gt=0)
    max_iter: int = Field(30, ge=1)


class Seed(Strict):
    size: int = Field(10_000, ge=1)
    weight: Literal["log_rank", "sqrt_rank", "uniform", "score"] = "log_rank"


class PipelineConfig(Strict):
    scope: dict[str, Any]
    scope_params: ScopeParams = Field(default_factory=ScopeParams)
    crawl_window: CrawlWindow = Field(default_factory=CrawlWindow)
    languages: Languages = Field(default_factory=Languages)
    authority: Authority = Field(default_factory=Authority)
    seed: Seed = Field(default_factory=Seed)


class StorageBlock(Strict):
    raw: str
    marts: str


def find_config(name: str) -> Path:
    """A config file in the working directory (where a cluster puts shipped files), else beside the package."""
    for folder in (Path.cwd(), Path.cwd() / "config", Path(__file__).resolve().parent.parent / "config"):
        if (folder / name).is_file():
            return folder / name
    raise ConfigError(f"config file not found: {name}")


def read_mapping(path: str | Path) -> dict[str, Any]:
    path = Path(path)
    if not path.is_file():
        raise ConfigError(f"config file not found: {path}")
    try:
        data = yaml.safe_load(path.read_text())
    except yaml.YAMLError as error:
        raise ConfigError(f"{path} is not YAML: {error}") from error
    if not isinstance(data, dict):
        raise ConfigError(f"{path} must hold a mapping, not {type(data).__name__}")
    return data


def _validated(model, data: dict[str, Any], what: str):
    try:
        return model.model_validate(data)
    except ValidationError as error:
        raise ConfigError(f"{what}: {error}") from error


def load_pipeline(path: str | Path) -> PipelineConfig:
    return _validated(PipelineConfig, read_mapping(path), str(path))


def load_storage(path: str | Path, environment: str | None = None) -> StorageBlock:
    """The block of an environment; RAW_PATH and MARTS_PATH in the process environment win."""
    environment = environment or os.environ.get("WEBLOOM_ENV", "local")
    blocks = read_mapping(path)
    if environment not in blocks:
        raise ConfigError(f"{path} has no environment {environment!r}; it has {sorted(blocks)}")
    block = dict(blocks[environment] or {})
    for key, variable in (("raw", "RAW_PATH"), ("marts", "MARTS_PATH")):
        if os.environ.get(variable):
            block[key] = os.environ[variable]
    return _validated(StorageBlock, block, f"{path}: {environment}")


def with_overrides(model: BaseModel, **overrides: Any):
    """A section with the given non-None values, validated as a whole: a bad pair is one error."""
    given = {k: v for k, v in overrides.items() if v is not None}
    return _validated(type(model), model.model_dump() | given, "overrides")


def guard_output(path: str, forbidden: str = "tests/fixtures") -> str:
    """Refuse to write into checked-in fixtures."""
    if forbidden in path.replace("\\", "/"):
        raise ConfigError(f"refusing to write below {forbidden}: {path}")
    return path
