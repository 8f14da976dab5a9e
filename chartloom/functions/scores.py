"""Score expressions, all in double and in a fixed order of additions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartloom.config import GRADES, PARSE_TEXT_CHARS, WEIGHTS, QualityFloors


def _points(condition: Column, value: float) -> Column:
    return F.when(condition, F.lit(float(value))).otherwise(F.lit(0.0))


def parse_quality(
    text: Column, num_sections: Column, num_tables: Column, num_pages: Column
) -> Column:
    """0.4 for text, 0.3 for sections, 0.2 for tables, 0.1 for pages, at most 1."""
    score = (
        F.lit(0.0)
        + _points(F.length(text) > PARSE_TEXT_CHARS, 0.4)
        + _points(num_sections > 0, 0.3)
        + _points(num_tables > 0, 0.2)
        + _points(num_pages > 0, 0.1)
    )
    return F.least(score, F.lit(1.0))


def weighted_quality(accuracy: Column, coherence: Column, completeness: Column) -> Column:
    return (
        F.lit(WEIGHTS["accuracy"]) * accuracy
        + F.lit(WEIGHTS["coherence"]) * coherence
        + F.lit(WEIGHTS["completeness"]) * completeness
    )


def grade(score: Column) -> Column:
    ladder = F.when(score >= GRADES[0][1], GRADES[0][0])
    for name, floor in GRADES[1:]:
        ladder = ladder.when(score >= floor, name)
    return ladder.otherwise("poor")


def recommendation(score: Column, floors: QualityFloors = QualityFloors()) -> Column:
    return (
        F.when(score >= floors.overall_quality, "approve")
        .when(score >= GRADES[-1][1], "review")
        .otherwise("reject")
    )


def confidence_value(label: Column) -> Column:
    """Confidence as a number, whether it came as a number or as a word."""
    words = (
        F.when(F.lower(label) == "high", F.lit(0.9))
        .when(F.lower(label) == "medium", F.lit(0.7))
        .when(F.lower(label) == "low", F.lit(0.4))
        .otherwise(F.lit(0.0))
    )
    return F.coalesce(label.try_cast("double"), words)


def reject_reasons(scores: dict[str, Column], floors: dict[str, float]) -> Column:
    """Names of the scores that are missing or under their floor."""
    checks = [
        F.when(F.coalesce(score < floors[name], F.lit(True)), F.lit(name))
        for name, score in scores.items()
    ]
    return F.array_compact(F.array(*checks))
