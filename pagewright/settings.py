"""Settings of a run, from environment variables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

STORAGE_TYPES = ("local", "s3")


@dataclass(frozen=True)
class Side:
    """Where a run reads or writes, and with which credentials."""

    kind: str
    path: str
    key_id: str = ""
    secret: str = ""
    region: str = ""


@dataclass(frozen=True)
class RotationService:
    """Where a document service tells how an image is turned; for a rotator that asks it."""

    endpoint: str
    key: str


@dataclass(frozen=True)
class Settings:
    source: Side
    target: Side
    parallelism: int = 4
    max_submissions: int | None = None
    force_reprocess: bool = False
    metadata_only: bool = False
    backfill: bool = False
    text_threshold: float | None = None
    blank_threshold: float | None = None
    salt: str = ""
    temp_dir: str | None = None
    stall_warning: int | None = 90
    stall_timeout: int | None = 900
    max_dimension: int = 1024
    redetect_rotation: bool = False
    rotation_service: RotationService | None = None
    model_cache: str | None = None
    #: Names of the tables that keep the manifests' rows begin so (see sources/state.py); none are kept without it.
    state: str | None = None


def _text(env: Mapping[str, str], name: str) -> str:
    return env.get(name, "").strip()


def _required(env: Mapping[str, str], name: str) -> str:
    if not (value := _text(env, name)):
        raise ValueError(f"{name} must be set")
    return value


def _positive(env: Mapping[str, str], name: str, default: int | None) -> int | None:
    text = _text(env, name)
    if not text:
        return default
    try:
        value = int(text)
    except ValueError:
        raise ValueError(f"{name} must be a whole number, not {text!r}") from None
    if value < 1:
        raise ValueError(f"{name} must be at least 1")
    return value


def _seconds(env: Mapping[str, str], name: str, default: int) -> int | None:
    """0 and less switch a limit off."""
    text = _text(env, name)
    try:
        value = int(text) if text else default
    except ValueError:
        raise ValueError(f"{name} must be a whole number, not {text!r}") from None
    return value if value > 0 else None


def _number(env: Mapping[str, str], name: str) -> float | None:
    text = _text(env, name)
    try:
        return float(text) if text else None
    except ValueError:
        raise ValueError(f"{name} must be a number, not {text!r}") from None


def _flag(env: Mapping[str, str], name: str) -> bool:
    return _text(env, name).lower() in ("1", "true", "yes")


def _side(env: Mapping[str, str], name: str) -> Side:
    kind = _required(env, f"{name}_STORAGE_TYPE").lower()
    if kind not in STORAGE_TYPES:
        raise ValueError(f"{name}_STORAGE_TYPE must be one of {', '.join(STORAGE_TYPES)}, not {kind!r}")
    keys = (_text(env, f"{name}_AWS_{k}") for k in ("ACCESS_KEY_ID", "SECRET_ACCESS_KEY", "REGION"))
    return Side(kind, _required(env, f"{name}_STORAGE_PATH"), *keys)


def _rotation_service(env: Mapping[str, str]) -> RotationService | None:
    """Only where it is switched on and both its address and its key are there."""
    endpoint, key = _text(env, "AZURE_AI_ENDPOINT"), _text(env, "AZURE_AI_API_KEY")
    return RotationService(endpoint, key) if _text(env, "USE_IMAGE_TRANSFORM_AZURE_AI").lower() == "true" and endpoint and key else None


def whole_or(value: object, default: int) -> int | None:
    """A limit as it was given: whole numbers and None (no limit) pass, anything else is the default."""
    return value if value is None or isinstance(value, int) else default


def read_settings(env: Mapping[str, str] | None = None) -> Settings:
    """Settings from ``env`` (the process's by default); ValueError names the variable that is missing or bad."""
    env = os.environ if env is None else env
    return Settings(
        source=_side(env, "SOURCE"),
        target=_side(env, "TARGET"),
        parallelism=_positive(env, "WORKER_PARALLELISM", 4),
        max_submissions=_positive(env, "MAX_SUBMISSIONS", None),
        force_reprocess=_flag(env, "FORCE_REPROCESS"),
        metadata_only=_flag(env, "FORCE_REPROCESS_METADATA"),
        backfill=_flag(env, "BACKFILL_RAW_IMAGES"),
        text_threshold=_number(env, "DETECTOR_TEXT_THRESHOLD"),
        blank_threshold=_number(env, "DETECTOR_BLANK_THRESHOLD"),
        salt=env.get("SUBMITTER_FINGERPRINT_SALT", ""),
        temp_dir=_text(env, "TEMP_DIR") or None,
        stall_warning=_seconds(env, "WORKER_RESULT_STALL_LOG", 90),
        stall_timeout=_seconds(env, "WORKER_RESULT_TIMEOUT", 900),
        max_dimension=_positive(env, "IMAGE_TRANSFORM_MAX_DIMENSION", 1024),
        redetect_rotation=_flag(env, "FORCE_ROTATION_REDETECTION"),
        rotation_service=_rotation_service(env),
        model_cache=_text(env, "MODEL_CACHE_DIR") or None,
        state=_text(env, "PAGEWRIGHT_STATE") or None,
    )
