"""Pipeline settings: plain dataclasses, read from YAML on the driver and passed explicitly.

Names and defaults are those that existing settings files use (fixed values). Models get their section whole: what a
model makes of ``vad``, ``asr`` and ``filter`` is its own affair. Spark's executors take the place of worker processes,
queues between stages and the memory gate: those settings are read, so that files stay valid, and change nothing
(``NO_EFFECT``).
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Sources:
    channels: list[str] = field(default_factory=list)
    video_urls: list[str] = field(default_factory=list)
    local_dir: str | None = None


@dataclass(frozen=True)
class Paths:
    work_dir: str = "work"
    output_dir: str = "output"
    db_path: str = "work/jobs"


@dataclass(frozen=True)
class Discover:
    max_concurrency: int = 3
    request_delay_s: float = 5.0


@dataclass(frozen=True)
class Download:
    max_concurrency: int = 5
    audio_format: str = "m4a"
    rate_limit: str | None = None
    timeout_s: float = 900


@dataclass(frozen=True)
class Standardize:
    sample_rate: int = 16000
    workers: int = 4


@dataclass(frozen=True)
class Vad:
    threshold: float = 0.5
    min_silence_duration_ms: int = 400
    min_speech_duration_ms: int = 250
    speech_pad_ms: int = 100
    max_superchunk_s: float = 90.0
    overlap_s: float = 2.5
    workers: int = 4


@dataclass(frozen=True)
class Asr:
    model_size: str = "large-v3"
    device: str = "auto"
    compute_type: str = "auto"
    num_workers: int = 1
    language: str | None = None
    align: bool = True
    diarize: bool = False
    diarize_fill_nearest: bool = False
    hf_token: str | None = None


@dataclass(frozen=True)
class Rechunk:
    min_segment_s: float = 2.0
    max_segment_s: float = 20.0
    boundary_edge_guard_s: float = 1.5
    silence_fallback_ms: int = 250
    split_on_speaker_change: bool = True


@dataclass(frozen=True)
class Filter:
    enabled: bool = True
    min_dnsmos_ovr: float | None = 2.5
    min_duration_s: float | None = None
    allowed_languages: list[str] | None = None
    dnsmos_model_path: str | None = None
    reject_overlapping_speech: bool = True
    workers: int = 4


@dataclass(frozen=True)
class Package:
    audio_format: str = "flac"
    sample_rate: int | None = None
    channels: int | None = None


@dataclass(frozen=True)
class Resources:
    ram_floor_mb: int = 1536
    vram_floor_mb: int = 1024
    ram_budget_mb: int | None = None
    vram_budget_mb: int | None = None
    poll_interval_s: float = 1.0
    cost_per_audio_second: dict[str, float] = field(
        default_factory=lambda: {"standardize": 2e6, "vad": 3e6, "asr": 6e7, "diarize_video": 8e9, "filter": 1e6}
    )


@dataclass(frozen=True)
class Queues:
    maxsize_per_stage: int = 32


@dataclass(frozen=True)
class Config:
    sources: Sources = field(default_factory=Sources)
    paths: Paths = field(default_factory=Paths)
    discover: Discover = field(default_factory=Discover)
    download: Download = field(default_factory=Download)
    standardize: Standardize = field(default_factory=Standardize)
    vad: Vad = field(default_factory=Vad)
    asr: Asr = field(default_factory=Asr)
    rechunk: Rechunk = field(default_factory=Rechunk)
    filter: Filter = field(default_factory=Filter)
    package: Package = field(default_factory=Package)
    resources: Resources = field(default_factory=Resources)
    queues: Queues = field(default_factory=Queues)


#: Settings that are read and change nothing here.
NO_EFFECT = (
    "standardize.workers", "vad.workers", "filter.workers", "asr.num_workers", "rechunk.boundary_edge_guard_s",
    "resources", "queues",
)


def _build(kind: type, given: dict[str, Any], at: str = "") -> Any:
    made = kind()
    if unknown := sorted(set(given) - {f.name for f in fields(kind)}):
        raise ValueError(f"unknown settings: {', '.join(at + name for name in unknown)}")
    values = {}
    for f in fields(kind):
        if f.name in given:
            default = getattr(made, f.name)
            values[f.name] = _build(type(default), given[f.name] or {}, f"{at}{f.name}.") if is_dataclass(default) else given[f.name]
    return kind(**values)


def load_config(path: str | Path) -> Config:
    """Missing keys keep their defaults; unknown ones are an error, which names them."""
    import yaml

    return _build(Config, yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {})


def cost_of(stage: Column, duration_s: Column, costs: dict[str, float]) -> Column:
    """Bytes that a stage is thought to need for so much audio; none for unknown stages and negative durations."""
    each = F.create_map(*[F.lit(x) for pair in costs.items() for x in pair]) if costs else F.create_map().cast("map<string,double>")
    per_second = F.coalesce(F.try_element_at(each, stage), F.lit(0.0))
    return (per_second * F.greatest(duration_s, F.lit(0))).cast("long")


def estimate_cost(costs: dict[str, float], stage: str, duration_s: float) -> int:
    return int(costs.get(stage, 0.0) * max(duration_s, 0.0))


def compute_type(asr: Asr, device: str) -> str:
    """The number format of a model: as set, else by device."""
    return {"cuda": "float16"}.get(device, "int8") if asr.compute_type == "auto" else asr.compute_type


def worker_specs(asr: Asr, gpu_ids: list[int] | None = None) -> list[tuple[str, int]]:
    """(device, index) of each model worker: at least one on the CPU; on GPUs one each, all listed if none is asked for."""
    if not gpu_ids or asr.device not in ("auto", "cuda"):
        return [("cpu", i) for i in range(max(1, asr.num_workers))]
    return [("cuda", i) for i in (gpu_ids[: asr.num_workers] if asr.num_workers else gpu_ids)]
