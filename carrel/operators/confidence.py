"""Final confidences and the review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Item groups and thresholds of the review policy.
KEY_ITEMS = [90, 220, 230, 400, 522]
REQUIRED_ITEMS = [90, 220, 230, 390, 400, 410, 490, 522, 523, 764, 880, 890, 900, 910, 940, 950, 960, 970, 1290, 1360, 1390, 1750, 1760]
KEY_BELOW, REQUIRED_BELOW, LOW_BELOW = 0.9, 0.7, 0.5
ERROR_PENALTY, WARNING_PENALTY, REWORDED = 0.3, 0.15, 0.8
RANKS = {"CRITICAL": 0, "HIGH": 1, "MEDIUM": 2, "LOW": 3}


def worst_severities(violations: DataFrame, keys: list[str]) -> DataFrame:
    """keys, item, severity: 2 if any rule with an error names the item, else 1."""
    level = F.when(F.col("severity") == "error", 2).otherwise(1)
    return violations.select(*keys, F.explode("item_numbers").alias("item"), level.alias("severity")).groupBy(*keys, "item").agg(F.max("severity").alias("severity"))


def scored(results: DataFrame, violations: DataFrame, keys: list[str]) -> DataFrame:
    """Add final_confidence (4 digits) and severity to results (item, extracted, resolved, confidence).

    The violations of a record become one map, so results are joined by record, never by item.
    """
    worst = worst_severities(violations, keys).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("item", "severity"))).alias("severities"))
    joined = results.join(worst, keys, "left").withColumn("severity", F.try_element_at("severities", F.col("item"))).drop("severities")
    return with_final(joined)


def severity_of(item: Column, errors: Column, warnings: Column) -> Column:
    """As in worst_severities(), from the items that a record's broken rules name (rules.named)."""
    return F.when(F.array_contains(errors, item), 2).when(F.array_contains(warnings, item), 1)


def with_final(joined: DataFrame) -> DataFrame:
    """Add final_confidence to results that have their severity."""
    base = F.coalesce(F.col("confidence"), F.lit(0.0))
    score = base - F.when(F.col("severity") == 2, ERROR_PENALTY).when(F.col("severity") == 1, WARNING_PENALTY).otherwise(0.0)
    extracted, resolved = F.coalesce("extracted", F.lit("")), F.coalesce("resolved", F.lit(""))
    reworded = (extracted != "") & (resolved != "") & (resolved != extracted) & (base < 1.0)
    score = F.when(reworded, score * REWORDED).otherwise(score)
    return joined.withColumn("final_confidence", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 4))


def _priority(conf: Column, by_violation: Column | None) -> Column:
    item = F.col("item")
    found = F.when(item.isin(KEY_ITEMS) & (conf < KEY_BELOW), "CRITICAL").when(item.isin(REQUIRED_ITEMS) & (conf < REQUIRED_BELOW), "HIGH")
    if by_violation is not None:
        return found.when(by_violation, "MEDIUM").when(conf < LOW_BELOW, "LOW")
    base = F.coalesce(F.col("confidence"), F.lit(0.0))
    dropped = (base > 0) & ((base - conf) >= (WARNING_PENALTY - 0.01))
    return found.when(conf < LOW_BELOW, "LOW").when(dropped, "MEDIUM")


def review_queue(scores: DataFrame, keys: list[str], mode: str = "drop") -> DataFrame:
    """Items to review. mode 'drop': MEDIUM where the confidence fell; 'violations': MEDIUM where a rule names the item."""
    by_violation = F.col("severity").isNotNull() if mode == "violations" else None
    # the confidence is bound once: pushed into a filter, its expression would be there for every comparison
    bound = F.transform(F.array("final_confidence"), lambda conf: _priority(conf, by_violation))[0]
    flagged = scores.withColumn("priority", bound).where("priority is not null")
    reason = (
        F.when(F.col("priority") == "CRITICAL", F.format_string("Key variable with confidence %.2f < 0.9", "final_confidence"))
        .when(F.col("priority") == "HIGH", F.format_string("Required item with confidence %.2f < 0.7", "final_confidence"))
        .when(F.col("priority") == "LOW", F.format_string("Low confidence %.2f < 0.5", "final_confidence"))
        .otherwise(F.format_string("Validation violation: confidence from %.2f to %.2f", F.coalesce("confidence", F.lit(0.0)), "final_confidence"))
    )
    rank = F.element_at(F.create_map(*(F.lit(x) for kv in RANKS.items() for x in kv)), F.col("priority"))
    return flagged.select(*keys, "item", "extracted", "resolved", "final_confidence", "priority", rank.alias("priority_rank"), reason.alias("reason"))
