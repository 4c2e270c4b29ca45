"""Thresholds and weights.  One frozen record per concern, passed as a parameter."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class QualityConfig:
    min_chars: int = 10
    min_views: int = 500
    min_engagement_rate: float = 0.001
    min_followers: int = 100
    min_save_ratio: float = 0.0001


@dataclass(frozen=True)
class ClusterConfig:
    min_cluster_size: int = 15
    min_samples: int = 15
    share_divisor: int = 60
    max_rescue_distance: float = 0.5
    rows_per_block: int = 2048


@dataclass(frozen=True)
class MatchConfig:
    threshold: float = 0.5
    window_hours: int = 24
    decay_hours: float = 24.0
    expire_days: int = 3
    w_topic: float = 0.6
    w_keywords: float = 0.2
    w_time: float = 0.1
    w_source: float = 0.1
    # 'linear' is the stated rule, 'constant' gives 0.5 whatever the times are
    time_decay: str = "linear"
    rows_per_block: int = 2048


@dataclass(frozen=True)
class Settings:
    quality: QualityConfig = field(default_factory=QualityConfig)
    cluster: ClusterConfig = field(default_factory=ClusterConfig)
    match: MatchConfig = field(default_factory=MatchConfig)
    min_batch: int = 40
    annotate_top: int = 10
    sample_top: int = 5
    request_titles: int = 1000  # titles in one remote request
    keyword_count: int = 30


# Names used on the wire, in display order.
SOURCES = ("tiktok", "vnexpress", "youtube", "google_trends")
SENTIMENTS = ("positive", "negative", "neutral")
CONTENT_TYPES = ("entertainment", "drama", "dangerous", "social_issue", "commercial")
RISK_LEVELS = ("safe", "cautious", "high_risk", "dangerous")
