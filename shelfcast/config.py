"""Job settings as plain records (C2/C3); defaults are the model's."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from types import NoneType
from typing import TypeVar, get_args, get_type_hints

Settings = TypeVar("Settings")
TRUE_WORDS = ("1", "true", "yes", "on")


@dataclass(frozen=True)
class LandingSettings:
    """Bounded drain of the change stream into bronze.

    ``batch_size`` caps each micro-batch of a Kafka source (maxOffsetsPerTrigger).
    The drain stops once nothing has arrived for ``idle_timeout_seconds`` (None: as
    soon as it has caught up), or once at least ``max_messages`` rows were written
    (no cap by default; the summary says whether it was reached).
    """

    bronze_path: str
    checkpoint: str
    source: str = "kafka"
    batch_size: int = 5_000
    max_messages: int | None = None
    idle_timeout_seconds: float | None = 10.0
    mode: str = "append"


@dataclass(frozen=True)
class SilverSettings:
    bronze_path: str
    silver_path: str
    mode: str = "overwrite"


@dataclass(frozen=True)
class GoldSettings:
    silver_path: str
    gold_path: str
    mode: str = "overwrite"


@dataclass(frozen=True)
class ForecastSettings:
    """Baseline evaluation; the outputs go to ``output_dir`` unless ``write_outputs`` is off."""

    gold_path: str
    holdout_days: int = 28
    season_length_days: int = 7
    output_dir: str = "artifacts/forecasting/baseline"
    write_outputs: bool = True


def settings_from(record: type[Settings], values: Mapping[str, str], prefix: str = "", **given) -> Settings:
    """A settings record from texts named ``PREFIX`` + upper-case field (such as ``os.environ``).

    ``given`` wins over ``values``, both over the defaults; empty texts count as absent.
    """
    hints = get_type_hints(record)
    found = {}
    for field in fields(record):
        text = values.get(prefix + field.name.upper())
        if text:
            kind = next(k for k in (get_args(hints[field.name]) or (hints[field.name],)) if k is not NoneType)
            found[field.name] = text.strip().lower() in TRUE_WORDS if kind is bool else kind(text)
    return record(**{**found, **given})
