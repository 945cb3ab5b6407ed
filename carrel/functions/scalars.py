"""Code and text normalisers as Column expressions. Missing is '' inside the engine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinels that mean "unknown" in coded items.
UNKNOWN_CODES = ["9", "99", "999", "9999", "99999999", "88", "888", "8888", "88888888", "00000000"]
# Unknown markers of the T, N and M axes and of stages, as the scorer reads them.
UNKNOWN_TNM = ["", "x", "88", "99", "unknown", "nan"]
UNKNOWN_STAGE = ["", "9", "88", "99", "unknown", "nan"]
# Laterality words of a detected tumor.
LATERALITIES = ["left", "right", "bilateral", "not_applicable", "unknown"]
CHARS_PER_TOKEN = 3.5


def strip(x: Column) -> Column:
    """Without white space of any kind at both ends (plain trim takes spaces only; this stays off regular expressions)."""
    return F.btrim(x, F.lit(" \t\n\r\x0b\x0c"))


def text(x: Column) -> Column:
    """Null becomes '', ends are stripped."""
    return strip(F.coalesce(x.cast("string"), F.lit("")))


def digits(x: Column) -> Column:
    return F.regexp_replace(text(x), "[^0-9]", "")


def either(*values: Column) -> Column:
    """The first value that isn't empty, else ''."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values), F.lit(""))


def unknown(x: Column) -> Column:
    """Blank or one of the unknown codes."""
    s = text(x)
    return (s == "") | s.isin(UNKNOWN_CODES)


def known(x: Column) -> Column:
    return ~unknown(x)


def starts(x: Column, prefixes: list[str]) -> Column:
    return x.rlike("^(" + "|".join(prefixes) + ")")


def integer(x: Column) -> Column:
    """A whole number, or null."""
    s = text(x)
    return F.when(s.rlike("^[+-]?[0-9]+$"), s.try_cast("int"))


def estimated_tokens(x: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(x) / F.lit(CHARS_PER_TOKEN)).cast("int"))


# --- site, histology, staging -------------------------------------------------------------


def site(x: Column) -> Column:
    return F.translate(F.upper(text(x)), ". ", "")


def site3(x: Column) -> Column:
    s = site(x)
    return F.when(s.startswith("C"), F.substring(s, 1, 3)).otherwise(s)


def histology4(x: Column) -> Column:
    return F.substring(digits(x), 1, 4)


def histology3(x: Column) -> Column:
    return F.substring(digits(x), 1, 3)


def behavior_digit(x: Column) -> Column:
    return F.substring(digits(x), 5, 1)


def tnm(x: Column, axis: str) -> Column:
    s = F.replace(F.upper(text(x)), F.lit(" "), F.lit(""))
    return F.regexp_replace(F.regexp_replace(s, "^[CPYRA]+", ""), f"^{axis}", "")


def tnm_main(normal: Column) -> Column:
    return either(F.regexp_extract(normal, "^(IS|X|[0-9]+)", 1), normal)


def stage_group(x: Column) -> Column:
    return F.replace(F.replace(F.upper(text(x)), F.lit("STAGE"), F.lit("")), F.lit(" "), F.lit(""))


def stage_group_main(x: Column) -> Column:
    s = stage_group(x)
    # Codes without a stage, and the digits of Roman stages.
    found = F.when(s.isin("", "88", "99", "NA", "UNK", "UNKNOWN"), "unknown")
    for roman, digit in (("IV", "4"), ("III", "3"), ("II", "2"), ("I", "1"), ("0", "0")):
        found = found.when(s.startswith(roman), digit)
    return found.when(s.rlike("^[0-9]"), F.substring(s, 1, 1)).otherwise("unknown")


def _crosswalk(key: Column, table: dict[str, str]) -> Column:
    return reduce(lambda c, kv: c.when(key == kv[0], kv[1]), list(table.items())[1:], F.when(key == next(iter(table)), table[next(iter(table))])).otherwise("unknown")


def summary_stage_extent(x: Column) -> Column:
    # Extent by summary stage.
    return _crosswalk(F.substring(digits(x), 1, 1), {"0": "insitu", "1": "localized", "2": "regional", "3": "regional", "4": "regional", "5": "regional", "7": "distant"})


def stage_group_extent(x: Column) -> Column:
    # Extent by stage group.
    return _crosswalk(stage_group_main(x), {"0": "insitu", "1": "localized", "2": "regional", "3": "regional", "4": "distant"})


def biomarker(x: Column) -> Column:
    s = F.lower(text(x))
    first = F.regexp_extract(s, r"^\s*([0-9])", 1)
    return F.when(s.contains("pos"), "positive").when(s.contains("neg"), "negative").when(first == "1", "positive").when(first == "0", "negative").otherwise("unknown")


def topography(x: Column) -> Column:
    """C509 or C50.9 to C50.9; anything else to ''."""
    s = F.upper(text(x))
    return F.when(s.rlike(r"^C[0-9]{2}\.?[0-9]$"), F.concat(F.substring(s, 1, 3), F.lit("."), F.substring(s, -1, 1))).otherwise("")


def morphology(x: Column) -> Column:
    return F.regexp_extract(text(x), "^([0-9]{4})(?:/[0-9])?$", 1)


def laterality(x: Column) -> Column:
    s = F.lower(text(x))
    return F.when(s.isin(LATERALITIES), s).otherwise("unknown")


def sided_site(hint: Column, side: Column) -> Column:
    """A site hint with its side in front, unless it starts with it; a blank hint is unknown."""
    s, own = laterality(side), either(text(hint), F.lit("unknown"))
    return F.when(s.isin("left", "right", "bilateral") & ~F.lower(own).startswith(s), F.concat(s, F.lit(" "), own)).otherwise(own)


def rule_site(x: Column) -> Column:
    """As the edit rules read it: no dot, a leading C."""
    s = F.replace(F.upper(text(x)), F.lit("."), F.lit(""))
    return F.when((s != "") & ~s.startswith("C"), F.concat(F.lit("C"), s)).otherwise(s)


def rule_histology(x: Column) -> Column:
    s = text(x)
    return F.when(s.rlike("[^0]"), F.nullif(F.regexp_extract(s, "^([0-9]{4})", 1), F.lit("")).cast("int"))


def site_code(x: Column) -> Column:
    """The first topography code found anywhere in a text."""
    found = F.regexp_extract(F.upper(text(x)), r"C([0-9]{2})\.?([0-9]?)", 0)
    bare = F.replace(found, F.lit("."), F.lit(""))
    return F.when(F.length(bare) == 4, F.concat(F.substring(bare, 1, 3), F.lit("."), F.substring(bare, 4, 1))).otherwise(bare)


def histology_code(x: Column) -> Column:
    return F.regexp_extract(text(x), "([0-9]{4})", 1)


# --- text clean-up ------------------------------------------------------------------------


def one_line(x: Column) -> Column:
    """White space collapsed; blanks and stars off both ends."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", " "), r"^[ *]+|[ *]+$", "")


def manual_text(x: Column) -> Column:
    """Blanks collapsed, three or more line breaks to two."""
    return strip(F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), r"[ \t]+", " "), "\n{3,}", "\n\n"))


def unfenced(x: Column) -> Column:
    """The inside of a text that is one fenced block (plain or json); others only lose outer blanks."""
    s = text(x)
    block = r"(?s)^```(?:json)?\s*\n?(.*?)\n?\s*```$"
    return F.when(s.rlike(block), strip(F.regexp_extract(s, block, 1))).otherwise(s)


def summary_text(x: Column) -> Column:
    """A model's summary without its first fence line, a last line that is a fence, and one heading."""
    s = text(x)
    inner = F.regexp_replace(F.regexp_replace(s, r"^[^\n]*(\n|$)", ""), r"(^|\n)[ \t]*```[ \t]*$", "")
    s = F.when(s.startswith("```"), strip(inner)).otherwise(s)
    return strip(F.regexp_replace(s, r"(?i)^(clinical )?summary:\s*", ""))


def stage_display(x: Column) -> Column:
    """A stage value without its clinical or pathological letter."""
    return F.regexp_replace(text(x), "(?i)^[cp](?=[TNM0IVX])", "")


def model_size(name: Column) -> Column:
    """small (< 15 billion), medium (< 40, or no number) or large, by the first number before a B in a model's name."""
    n = F.regexp_extract(name, "([0-9]+)[bB]", 1).try_cast("int")
    return F.when(n < 15, "small").when((n < 40) | n.isNull(), "medium").otherwise("large")
