"""Quality-of-service rules as column expressions (no frame, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The quality ladder; a label's rank is its position, from 1.
QUALITY_LADDER = ["270p", "360p", "480p", "720p", "1080p", "1440p", "4K"]

# A viewer-day is poor above either limit (strictly).
POOR_BUFFERING_MS = 5000
POOR_BUFFERING_PCT = 5.0

# Upper bound of `totalBufferings` for each category, beyond: High.
CATEGORY_LOW_MAX = 2
CATEGORY_MEDIUM_MAX = 4

# Fixed value: peer-to-peer dominates strictly above half of the bytes.
P2P_DOMINANCE = 0.5


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; 0.0 where there is no positive whole."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def session_seconds(start_ms: Column, end_ms: Column) -> Column:
    """Span of a viewer-day; 0.0 for a single report or missing timestamps."""
    return F.when(end_ms > start_ms, (end_ms - start_ms) / 1000).otherwise(F.lit(0.0))


def buffering_percent(buffering_ms: Column, seconds: Column) -> Column:
    """Share of the session spent buffering; this order of operations fixes the last bit."""
    return F.when(seconds > 0, buffering_ms.cast("double") / 1000 / seconds * 100).otherwise(F.lit(0.0))


def is_poor(buffering_ms: Column, percent: Column) -> Column:
    return (buffering_ms > POOR_BUFFERING_MS) | (percent > POOR_BUFFERING_PCT)


def buffering_category(count: Column) -> Column:
    """Anything outside the listed ranges, negative counts included, is High."""
    return (
        F.when(count == 0, "No Buffering")
        .when((count >= 1) & (count <= CATEGORY_LOW_MAX), "Low")
        .when((count > CATEGORY_LOW_MAX) & (count <= CATEGORY_MEDIUM_MAX), "Medium")
        .otherwise("High")
    )


def dominant_delivery(p2p_ratio: Column) -> Column:
    return F.when(p2p_ratio > P2P_DOMINANCE, "P2P").otherwise("Source")


def quality_rank(label: Column) -> Column:
    """Position on the ladder, 0 for labels that are not on it."""
    ladder = F.array(*[F.lit(step) for step in QUALITY_LADDER])
    return F.coalesce(F.array_position(ladder, label), F.lit(0)).cast("int")


def ladder_label(label: Column) -> Column:
    """Optional clean-up: players name the top step by its height."""
    return F.when(label == "2160p", "4K").otherwise(label)
