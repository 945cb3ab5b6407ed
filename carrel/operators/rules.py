"""Edit rules: a declarative list evaluated over one wide row for each record.

Rules are data: (edit, severity, items, predicate, message, fix). All predicates are Column
expressions over the columns of prepared(), so the whole list is one projection without any UDF.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.functions.dates import coded_number
from carrel.functions.scalars import UNKNOWN_CODES, either, integer, rule_histology, rule_site, starts, text

# The names, severities, item numbers and code groups of all rules below.
# Site groups that the rules refer to (topography codes without dots).
MALE_SITES = ["C619", "C620", "C621", "C629", "C630", "C631", "C632", "C637", "C638", "C639"]
MALE_PREFIXES = ["C62", "C63"]
FEMALE_PREFIXES = ["C53", "C54", "C55", "C56", "C57", "C58"]
PAIRED_SITES = ["C300", "C384", "C413", "C414", "C471", "C472", "C491", "C492", "C570", "C630", "C754", "C755"]
PAIRED_PREFIXES = ["C07", "C08", "C09", "C34", "C40", "C44", "C50", "C56", "C62", "C64", "C65", "C66", "C69", "C74"]
INTERNAL_PREFIXES = ["C15", "C16", "C17", "C18", "C19", "C20", "C21", "C22", "C23", "C24", "C25", "C26", "C30", "C31", "C32", "C33", "C34", "C37", "C38", "C48", "C61", "C64", "C65", "C66", "C67", "C68"]
METASTASIS_ITEMS = [1112, 1113, 1114, 1115, 1116, 1117]


@dataclass(frozen=True)
class Rule:
    edit: str
    severity: str
    items: list[int]
    when: Column
    message: Column
    fix: dict[int, str] = field(default_factory=dict)


def v(item: int) -> Column:
    """An item's stripped value, as prepared() has it."""
    return F.col(f"t{item}")


def known(item: int) -> Column:
    return F.col(f"k{item}")


def unknown(item: int) -> Column:
    return ~known(item)


def _precedes(a: int, b: int) -> Column:
    return (F.when(known(a) & known(b), coded_number(v(a)) - coded_number(v(b)))) < 0


def prepared(records: DataFrame, keys: list[str]) -> DataFrame:
    """Stripped values and known flags of all items, and what several rules derive from them, computed once."""
    items = referenced_items()
    clean = records.select(*keys, *(text(F.col(f"v{i}")).alias(f"t{i}") for i in items))
    flagged = clean.select("*", *((~F.col(f"t{i}").isin("", *UNKNOWN_CODES)).alias(f"k{i}") for i in items))
    derived = flagged.select("*", rule_site(F.col("t400")).alias("site"), rule_histology(F.col("t522")).alias("hist"), integer(F.col("t230")).alias("age"), either(F.col("t1290"), F.col("t1291")).alias("surgery"), F.when(F.col("k490"), integer(F.col("t490"))).alias("confirmed"))
    return derived.select("*", (~F.col("surgery").isin("", "00", "0000", "0", "98", "99", *UNKNOWN_CODES)).alias("operated"), (~F.col("t1360").isin("", "0", "7", "8", "9", *UNKNOWN_CODES)).alias("irradiated"))


def _say(pattern: str, *parts: Column) -> Column:
    return F.format_string(pattern, *parts) if parts else F.lit(pattern)


def cross_field_rules() -> list[Rule]:
    site, hist, age = F.col("site"), F.col("hist"), F.col("age")
    sex, lat, behavior = v(220), v(410), v(523)
    out: list[Rule] = []

    def rule(edit, severity, items, when, message, fix=None):
        out.append(Rule(edit, severity, items, when, message, fix or {}))

    coded_sex = sex.isin("1", "2", "3", "4", "5", "6") & (site != "")
    rule("IF39_Site_Sex", "error", [400, 220], coded_sex & (site.isin(MALE_SITES) | starts(site, MALE_PREFIXES)) & (sex != "1"), _say("Site %s occurs in males only, but sex is %s.", site, sex))
    rule("IF39_Site_Sex", "error", [400, 220], coded_sex & starts(site, FEMALE_PREFIXES) & (sex != "2"), _say("Site %s occurs in females only, but sex is %s.", site, sex))

    placed = (site != "") & hist.isNotNull()
    for low, high, severity, good, name in ((8170, 8175, "error", starts(site, ["C22"]), "Liver cell carcinoma"), (8312, 8312, "warning", starts(site, ["C64"]), "Renal cell carcinoma"), (8720, 8790, "error", ~starts(site, INTERNAL_PREFIXES), "Melanoma"), (9050, 9055, "error", starts(site, ["C384", "C48"]), "Mesothelioma"), (9800, 9989, "warning", starts(site, ["C42"]), "Leukemia")):
        rule("IF25_Site_Histology", severity, [400, 522], placed & hist.between(low, high) & ~good, _say(f"{name} (histology %s) is not expected at site %s.", hist.cast("string"), site))

    paired = (site != "") & (site.isin(PAIRED_SITES) | starts(site, PAIRED_PREFIXES))
    rule("Laterality_PairedSite", "error", [400, 410], paired & lat.isin("", "0"), _say("Paired site %s needs a laterality.", site))
    # never true: 9 is itself an unknown code; kept as the rule set has it
    rule("Laterality_PairedSite", "warning", [400, 410], paired & (lat == "9") & known(410), _say("Paired site %s has an unknown laterality.", site))

    rule("Behavior_Histology", "error", [522, 523], (behavior == "2") & (hist >= 9800), _say("Leukemia histology %s cannot be in situ.", hist.cast("string")))
    rule("Behavior_Histology", "error", [522, 523], (behavior == "2") & hist.between(9590, 9729), _say("Lymphoma histology %s cannot be in situ.", hist.cast("string")))
    rule("Behavior_Histology", "warning", [522, 523], (behavior == "0") & hist.between(8010, 8576), _say("Benign behavior is unusual for carcinoma histology %s.", hist.cast("string")))

    aged = (site != "") & age.isNotNull() & (age != 999)
    rule("Age_Site_Plausibility", "warning", [400, 230], aged & starts(site, ["C61"]) & (age < 20), _say("Prostate cancer at age %s is very rare.", age.cast("string")))
    rule("Age_Site_Plausibility", "warning", [400, 230], aged & starts(site, ["C50"]) & (age < 15), _say("Breast cancer at age %s is very rare.", age.cast("string")))
    for low, high, most, name in ((9510, 9514, 10, "Retinoblastoma"), (9500, 9500, 20, "Neuroblastoma"), (8960, 8960, 15, "Nephroblastoma")):
        rule("Age_Histology_Plausibility", "warning", [522, 230], aged & hist.between(low, high) & (age > most), _say(f"{name} at age %s is rare.", age.cast("string")))

    any_known = lambda items: reduce(lambda a, b: a | b, (known(i) for i in items))
    clinical, pathological = (940, 950, 960, 970), (880, 890, 900, 910)
    for name, items in (("Clinical", clinical), ("Pathological", pathological)):
        rule(f"TNM_{name}_Consistency", "warning", list(items), any_known(items[:3]) & unknown(items[3]), _say(f"{name} T, N or M is given, but the stage group is missing."))
    squeezed = lambda item: F.replace(F.upper(v(item)), F.lit(" "), F.lit(""))
    for name, items in (("Clinical", clinical), ("Pathological", pathological)):
        n = squeezed(items[1])
        rule(f"TNM_{name}_T0_Npositive", "warning", list(items[:2]), squeezed(items[0]).isin("T0", "0", "C0", "P0") & ~n.isin("N0", "0", "NX", "X", "") & known(items[1]), _say(f"{name} T0 with positive nodes (%s) is unusual.", v(items[1])))
    for name, items in (("Clinical", clinical), ("Pathological", pathological)):
        rule(f"TNM_{name}_Tis_Behavior", "error", [items[0], 523], squeezed(items[0]).isin("TIS", "IS") & (behavior == "3"), _say(f"{name} Tis needs behavior 2."), {523: "2"})

    for item, name in ((1200, "Surgery"), (1210, "Radiation"), (1220, "Chemotherapy"), (1230, "Hormone therapy"), (1240, "Immunotherapy")):
        rule("Treatment_Date_Before_Diagnosis", "error", [item, 390], _precedes(item, 390), _say(f"{name} (%s) precedes the diagnosis (%s).", v(item), v(390)))

    confirmed = F.col("confirmed")
    rule("DiagConfirm_Histology", "warning", [490, 522], confirmed.between(1, 5) & unknown(522), _say("Confirmed by microscope (%s), but histology is missing.", confirmed.cast("string")))
    rule("DiagConfirm_PathStaging", "warning", [490, *pathological], confirmed.between(6, 9) & any_known(pathological), _say("Clinical confirmation only (%s), but pathological staging is given.", confirmed.cast("string")))

    surgery, done = F.col("surgery"), F.col("operated")
    rule("Surgery_Date_Missing", "warning", [1290, 1200], done & unknown(1200), _say("Surgery %s has no date.", surgery))
    rule("Surgery_Margins_Missing", "warning", [1290, 1320], done & unknown(1320), _say("Surgery %s has no margin status.", surgery))
    rule("Reason_No_Surgery_Missing", "warning", [1290, 1340], surgery.isin("00", "0000", "0") & unknown(1340), _say("No surgery, but no reason is given."))

    radiation = v(1360)
    rule("Radiation_Date_Missing", "warning", [1360, 1210], F.col("irradiated") & unknown(1210), _say("Radiation %s has no date.", radiation))
    rule("Reason_No_Radiation_Missing", "warning", [1360, 1430], (radiation == "0") & unknown(1430), _say("No radiation, but no reason is given."))

    rule("DLC_Before_Diagnosis", "error", [1750, 390], _precedes(1750, 390), _say("Last contact (%s) precedes the diagnosis (%s).", v(1750), v(390)))
    rule("Dead_No_CauseOfDeath", "warning", [1760, 1910], (v(1760) == "0") & unknown(1910), _say("Dead, but the cause of death is missing."))
    return out


def consistency_rules() -> list[Rule]:
    surgery, done = F.col("surgery"), F.col("operated")
    coded = surgery != ""
    radiation, chemo, scope = v(1360), v(1390), v(1292)
    staged = reduce(lambda a, b: a | b, (known(i) for i in (880, 890, 900, 910)))
    metastases = reduce(lambda a, b: a | b, (v(i) == "1" for i in METASTASIS_ITEMS))
    sentinel = known(834) & (integer(v(834)) > 0)
    return [
        Rule("Surgery_TumorSizePath_Missing", "warning", [1290, 754], done & unknown(754), _say("Surgery %s, but no pathologic tumor size.", surgery)),
        Rule("Radiation_Modality_Missing", "warning", [1360, 1570], F.col("irradiated") & unknown(1570), _say("Radiation %s has no modality.", radiation)),
        Rule("Chemo_Text_Missing", "warning", [1390, 2640], ~chemo.isin("00", "0", "82", "85", "86", "87", "88", "99", "") & known(1390) & unknown(2640), _say("Chemotherapy %s has no agents.", chemo)),
        Rule("DistantStage_No_Mets_Site", "warning", [764, *METASTASIS_ITEMS], (v(764) == "7") & ~metastases, _say("Distant stage, but no metastatic site is positive.")),
        Rule("PathStaging_No_Surgery", "warning", [880, 890, 900, 910, 1290], staged & coded & ~done, _say("Pathological staging, but no surgery.")),
        Rule("SentinelLN_Scope_Missing", "warning", [834, 1292], sentinel & unknown(1292), _say("%s sentinel nodes examined, but the scope is missing.", v(834))),
        Rule("SentinelLN_Scope_Mismatch", "warning", [834, 1292], sentinel & (scope == "0"), _say("%s sentinel nodes examined, but the scope says none.", v(834))),
        Rule("GradePath_No_Surgery", "warning", [441, 1290], known(441) & coded & ~done, _say("Pathological grade, but no surgery.")),
    ]


def referenced_items() -> list[int]:
    """Every item that a rule reads, in order."""
    return [220, 230, 390, 400, 410, 441, 490, 522, 523, 754, 764, 834, 880, 890, 900, 910, 940, 950, 960, 970, 1112, 1113, 1114, 1115, 1116, 1117, 1200, 1210, 1220, 1230, 1240, 1290, 1291, 1292, 1320, 1340, 1360, 1390, 1430, 1570, 1750, 1760, 1910, 2640]


#: records of one task: the wide columns and long rows made of a record take hundreds of times its key
RECORDS = 100_000


def spread(records: DataFrame, keys: list[str]) -> DataFrame:
    """Deal narrow records by key over tasks of about RECORDS each, over all cores at least.

    Meant for keys, ahead of the wide columns that rules and scores make of them: what groups by the
    keys afterwards finds them together and needs no exchange.
    """
    cores = records.sparkSession.sparkContext.defaultParallelism
    return records.repartition(max(cores, -(-records.count() // RECORDS)), *keys)


def wide(results: DataFrame, keys: list[str], items: list[int] | None = None) -> DataFrame:
    """One row for each record with columns v<item>; ``results`` is long: keys, item, extracted, resolved."""
    items = items or referenced_items()
    value = either(F.coalesce("resolved", F.lit("")), F.coalesce("extracted", F.lit("")))
    pivoted = results.select(*keys, "item", value.alias("value")).groupBy(*keys).pivot("item", items).agg(F.first("value"))
    return pivoted.select(*keys, *(F.col(str(i)).alias(f"v{i}") for i in items))


def violations(records: DataFrame, keys: list[str], rules: list[Rule] | None = None) -> DataFrame:
    """keys, seq, edit_name, severity, item_numbers, message, fix of every rule that a record breaks.

    The numbers of broken rules are exploded alone; all else follows from the number, messages are
    written for broken rules only, and what nobody asks for is never made. No key is named like a prepared column.
    """
    rules = rules or [*cross_field_rules(), *consistency_rules()]
    known_of = lambda values: F.get(F.array(*values), F.col("seq"))
    no_fix = F.lit(None).cast("map<int,string>")
    fixes = F.array(*(F.create_map(*(F.lit(x) for kv in r.fix.items() for x in kv)) if r.fix else no_fix for r in rules))
    message = reduce(lambda c, kr: c.when(F.col("seq") == kr[0], kr[1].message), list(enumerate(rules))[1:], F.when(F.col("seq") == 0, rules[0].message))
    # a column of its own: within a higher-order function or a generator no code would be generated for the rules;
    # outer, as otherwise filters that the planner infers from the array would hold all rules once more
    broken = prepared(records, keys).withColumn("hits", F.array(*(F.when(r.when, F.lit(k)) for k, r in enumerate(rules))))
    hit = broken.withColumn("seq", F.explode_outer("hits")).where("seq is not null")
    return hit.select(
        *keys,
        "seq",
        known_of(F.lit(r.edit) for r in rules).alias("edit_name"),
        known_of(F.lit(r.severity) for r in rules).alias("severity"),
        known_of(F.array(*(F.lit(i) for i in r.items)) for r in rules).alias("item_numbers"),
        message.alias("message"),
        F.get(fixes, F.col("seq")).alias("fix"),
    )


def named(records: DataFrame, keys: list[str], rules: list[Rule] | None = None) -> DataFrame:
    """keys, errors, warnings: the items that broken rules name, by severity; one row for each record, no shuffle.

    ``keys`` may hold any columns that go along.
    """
    rules = rules or [*cross_field_rules(), *consistency_rules()]
    none = F.array().cast("array<int>")
    items = lambda severity: F.flatten(F.array(*(F.when(r.when, F.array(*(F.lit(i) for i in r.items))).otherwise(none) for r in rules if r.severity == severity)))
    return prepared(records, keys).select(*keys, items("error").alias("errors"), items("warning").alias("warnings"))


def fixed(results: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Resolved codes replaced by the fixes of broken rules (the last rule's, where several fix an item)."""
    fixes = found.where("fix is not null").select(*keys, "seq", F.explode("fix").alias("item", "code")).groupBy(*keys, "item").agg(F.max_by("code", "seq").alias("code"))
    return results.join(fixes, [*keys, "item"], "left").withColumn("resolved", F.coalesce("code", "resolved")).drop("code")
