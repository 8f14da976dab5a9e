"""Settings, as frozen values passed to operators (never read from a session)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Limits, thresholds, weights and grade bands that decide results.
SHORT_TEXT_CHARS = 50
PARSE_QUALITY_MIN = 0.7
PARSE_TEXT_CHARS = 100
HIGH_SOAP_QUALITY = 0.8
GRADES = (("excellent", 0.90), ("good", 0.75), ("fair", 0.60))
WEIGHTS = {"accuracy": 0.5, "coherence": 0.3, "completeness": 0.2}


@dataclass(frozen=True)
class QualityFloors:
    """Lowest accepted score per stage."""

    extraction_confidence: float = 0.6
    entity_validation: float = 0.75
    coherence_score: float = 0.70
    overall_quality: float = 0.75
    soap_quality: float = 0.80


@dataclass(frozen=True)
class ModelSettings:
    """One model stage: what to call, and how long and how often to try."""

    name: str = "offline"
    max_tokens: int = 2000
    temperature: float = 0.1
    top_p: float = 0.95
    timeout_seconds: float = 30.0


@dataclass(frozen=True)
class RetrySettings:
    max_attempts: int = 3
    backoff_factor: float = 2.0
    initial_wait_seconds: float = 1.0
    timeout_seconds: float = 60.0


@dataclass(frozen=True)
class StreamSettings:
    max_files_per_trigger: int | None = None
    processing_time: str = "10 seconds"
    continuous: bool = False


@dataclass(frozen=True)
class PipelineSettings:
    """Everything a whole run needs in one value."""

    floors: QualityFloors = field(default_factory=QualityFloors)
    retry: RetrySettings = field(default_factory=RetrySettings)
    stream: StreamSettings = field(default_factory=StreamSettings)
    extraction: ModelSettings = field(default_factory=ModelSettings)
    validation: ModelSettings = field(
        default_factory=lambda: ModelSettings(
            max_tokens=1000, temperature=0.0, top_p=1.0, timeout_seconds=20.0
        )
    )
    coherence: ModelSettings = field(
        default_factory=lambda: ModelSettings(max_tokens=1000, timeout_seconds=20.0)
    )
    scoring: ModelSettings = field(
        default_factory=lambda: ModelSettings(
            max_tokens=800, temperature=0.0, top_p=1.0, timeout_seconds=15.0
        )
    )
    summary: ModelSettings = field(
        default_factory=lambda: ModelSettings(
            max_tokens=2500, temperature=0.3, timeout_seconds=40.0
        )
    )
    enable_human_review: bool = True
    max_questions: int | None = None
    cache_ttl_seconds: int = 3600
