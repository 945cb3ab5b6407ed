"""Code resolution against a dictionary, and schema selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.functions.scalars import text

#: rows and bytes (as JSON) up to which a dictionary side is broadcast; larger ones are left to the planner
SMALL, SMALL_BYTES = 200_000, 16 << 20


def small(dimension: DataFrame) -> DataFrame:
    """Broadcast a dimension whose rows and bytes have been counted."""
    size = F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in dimension.columns))))
    rows, n = dimension.limit(SMALL + 1).agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(dimension) if rows <= SMALL and n <= SMALL_BYTES else dimension


def numeric_ranges(items: DataFrame) -> DataFrame:
    """item, low, high, width for every range like 001-100 in allowable_values."""
    part = items.select("item", F.explode(F.split("allowable_values", r"[,;]\s*|\s+")).alias("token"))
    low, high = (F.regexp_extract("token", r"^([0-9]+)\s*[-–]\s*([0-9]+)$", k) for k in (1, 2))
    found = part.select("item", low.alias("a"), high.alias("b")).where("a <> ''")
    return found.select("item", F.col("a").cast("bigint").alias("low"), F.col("b").cast("bigint").alias("high"), F.greatest(F.length("a"), F.length("b")).alias("width"))


#: least likeness of a fuzzy match in hundredths: 100 * (1 - edits / longer length); grams of an index
LEAST, GRAM = 85, 2


def _allowed(length: Column) -> Column:
    """Edits that two texts may differ by if the longer one has this length."""
    return F.floor(length * (100 - LEAST) / 100).cast("int")


def _signature(k: Column) -> Column:
    """Of a text's grams (a shorter text is its own; the nth of equal ones is a gram of its own), sorted, the first GRAM * edits + 1.

    An edit spoils at most GRAM grams, so of two texts within the edits that the longest partner allows,
    these first ones share at least one.
    """
    n = F.length(k)
    grams = F.when(n >= GRAM, F.transform(F.sequence(F.lit(1), n - GRAM + 1), lambda i: F.substring(k, i, F.lit(GRAM)))).otherwise(F.array(k))
    numbered = F.transform(grams, lambda g, i: F.concat(g, F.lit("#"), F.size(F.filter(F.slice(grams, F.lit(1), i), lambda x: x == g)).cast("string")))
    hashed = F.array_sort(F.transform(numbered, lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("g"))))
    most = F.floor(n * (100 - LEAST) / LEAST).cast("int")
    return F.transform(F.slice(hashed, F.lit(1), GRAM * most + 1), lambda x: x["g"])


def fuzzy_matches(values: DataFrame, names: DataFrame) -> DataFrame:
    """item, k, code, likeness: the likest name of each value with LEAST or more; the first by pos of equals.

    ``values``: item, k; ``names``: item, name, code, pos. Values and names meet by a gram of their
    signatures, an equi-join; lengths and then edit distances decide among those that meet.
    """
    distinct = values.where("k <> ''").distinct()
    asked = distinct.select("item", "k", F.explode(_signature(F.col("k"))).alias("g"))
    offered = names.where("name <> ''").groupBy("item", "name").agg(F.min(F.struct("pos", "code")).alias("first")).select("item", "name", "first", F.explode(_signature(F.col("name"))).alias("g"))
    longer = F.greatest(F.length("k"), F.length("name"))
    met = asked.join(small(offered), ["item", "g"]).where(F.abs(F.length("k") - F.length("name")) <= _allowed(longer)).select("item", "k", "name", "first").distinct()
    edits = F.levenshtein(F.col("k"), F.col("name"))
    near = met.withColumn("edits", edits).where(F.col("edits") <= _allowed(longer)).withColumn("likeness", 100.0 * (longer - F.col("edits")) / longer)
    best = near.groupBy("item", "k").agg(F.max_by(F.struct("first.code", "likeness"), F.struct("likeness", -F.col("first.pos"))).alias("best"))
    return best.select("item", "k", "best.code", "best.likeness")


def resolved(values: DataFrame, codes: DataFrame, ranges: DataFrame, fuzzy: bool = True) -> DataFrame:
    """Add code and resolution (0 to 1) to values (item, value).

    Tiers: exact code 1.0; code in other case 0.95; exact description 0.9; a description that is
    LEAST or more alike, 0.9 times the likeness; digits within a range, padded, 0.85; else the text itself
    at 0. ``codes``: item, code, description, pos. Without ``fuzzy`` the fourth tier is left out.
    """
    key = text(F.col("value"))
    upper = codes.groupBy("item", F.lower("code").alias("k")).agg(F.max_by("code", "pos").alias("any_case"), F.collect_set("code").alias("spellings"))
    described = codes.where("coalesce(description, '') <> ''").select("item", F.lower(text(F.col("description"))).alias("k"), "code", "pos")
    named = described.groupBy("item", "k").agg(F.max_by("code", "pos").alias("by_name"))
    keyed = values.withColumn("given", key).withColumn("k", F.lower("given"))
    found = keyed.join(small(upper), ["item", "k"], "left").join(small(named), ["item", "k"], "left")
    if fuzzy:
        asked = found.where("any_case is null and by_name is null").select("item", "k")
        alike = fuzzy_matches(asked, described.select("item", F.col("k").alias("name"), "code", "pos")).select("item", "k", F.col("code").alias("alike"), "likeness")
        found = found.join(alike, ["item", "k"], "left")
    else:
        found = found.withColumn("alike", F.lit(None).cast("string")).withColumn("likeness", F.lit(None).cast("double"))
    number = F.when(F.col("given").rlike("^[0-9]{1,18}$"), F.col("given").cast("bigint"))
    bounds = ranges.groupBy("item").agg(F.collect_list(F.struct("low", "high", "width")).alias("bounds"))
    found = found.join(small(bounds), "item", "left").withColumn("number", number)
    inside = F.try_element_at(F.filter(F.coalesce("bounds", F.array().cast("array<struct<low:bigint,high:bigint,width:int>>")), lambda r: F.col("number").between(r["low"], r["high"])), F.lit(1))
    padded = F.when(inside.isNotNull(), F.lpad(F.col("number").cast("string"), F.greatest(inside["width"], F.length(F.col("number").cast("string"))), F.lit("0")))
    exact = F.array_contains("spellings", F.col("given"))
    named_ = F.col("any_case").isNull() & F.col("by_name").isNull()
    close = F.when(named_, F.col("alike"))
    code = F.when(exact, F.col("given")).otherwise(F.coalesce("any_case", "by_name", close, padded, "given"))
    level = F.when(exact, 1.0).when(F.col("any_case").isNotNull(), 0.95).when(F.col("by_name").isNotNull(), 0.9).when(close.isNotNull(), F.round(0.9 * F.col("likeness") / 100, 4)).when(padded.isNotNull(), 0.85).otherwise(0.0)
    return found.select(*values.columns, code.alias("code"), level.alias("resolution"))


# Cancer schemas by topography prefix, and their site-specific items after the core ones.
SITE_SCHEMAS = {
    "breast": ["C50"], "prostate": ["C61"], "colon_rectum": ["C18", "C19", "C20", "C21"], "lung": ["C34"], "melanoma_skin": ["C44"], "kidney_renal_pelvis": ["C64", "C65"],
    "bladder": ["C67"], "thyroid": ["C73"], "cervix": ["C53"], "ovary": ["C56"], "testis": ["C62"], "liver": ["C22"], "pancreas": ["C25"],
    "head_neck": ["C00", "C01", "C02", "C03", "C04", "C05", "C06", "C07", "C08", "C09", "C10", "C11", "C12", "C13", "C14", "C30", "C31", "C32"], "brain_cns": ["C70", "C71", "C72"],
}
CORE_STAGING_ITEMS = [752, 754, 756, 764, 772, 774, 776, 820, 830, 832, 834, 835, 880, 890, 900, 910, 940, 950, 960, 970, 1001, 1002, 1003, 1004, 1011, 1012, 1013, 1014, 1060, 1112, 1113, 1114, 1115, 1116, 1117, 1182, 3843, 3844]
SCHEMA_ITEMS = {
    "breast": [3827, 3826, 3828, 3915, 3914, 3916, 3850, 3851, 3852, 3853, 3854, 3855, 3863, 3894, 3895, 3903, 3904, 3905, 3906, 3882, 3922],
    "prostate": [3838, 3839, 3840, 3841, 3842, 3920, 3897, 3898, 3919],
    "colon_rectum": [3823, 3819, 3820, 3909, 3890, 3866, 3934, 3929],
    "lung": [3938, 3939, 3866, 3940, 1174, 1176, 3937, 3929],
    "melanoma_skin": [3817, 3893, 3936],
    "kidney_renal_pelvis": [3925],
    "bladder": [3922],
    "thyroid": [3830, 3833],
    "cervix": [3836, 3956],
    "ovary": [3818, 3836, 3921, 3911],
    "testis": [3807, 3808, 3805, 3806, 3848, 3849, 3846, 3847, 3868, 3867, 3923, 3924],
    "liver": [3809, 3810, 3835],
    "pancreas": [3942],
    "head_neck": [3831, 3832, 3956],
    "brain_cns": [3816],
}
# Items by extraction phase.
DOMAIN_ITEMS = {
    "demographics": [380, 390, 400, 410, 440, 441, 442, 449, 450, 470, 490, 500, 522, 523, 150, 160, 161, 190, 220, 230, 240, 252, 254],
    "surgery": [1200, 1290, 1291, 1292, 1294, 1296, 1310, 1320, 1330, 1340, 1350, 1640, 3170, 3180, 3190],
    "radiation": [1210, 1360, 1370, 1380, 1430, 1501, 1502, 1503, 1504, 1505, 1506, 1507, 1511, 1512, 1513, 1514, 1515, 1516, 1517, 1521, 1522, 1523, 1524, 1525, 1526, 1527, 1531, 1532, 1533, 1550, 1570, 3220],
    "systemic": [1220, 1230, 1240, 1250, 1285, 1390, 1400, 1410, 1420, 1632, 1633, 1634, 1639, 3230, 3250, 3270],
    "followup": [1750, 1760, 1770, 1772, 1790, 1910],
    "text": [2520, 2530, 2540, 2550, 2560, 2570, 2580, 2590, 2600, 2610, 2620, 2630, 2640, 2650, 2660, 2670, 2680],
}


def schema_of(site: Column, histology: Column) -> Column:
    """The schema of a topography code; skin counts as melanoma only with a melanoma histology."""
    prefix = F.regexp_extract(F.replace(F.upper(text(site)), F.lit("."), F.lit("")), "^C?([0-9]{2})", 1)
    number = F.regexp_extract(text(histology), "^([0-9]{4})", 1).try_cast("int")
    lookup = F.create_map(*(F.lit(x) for name, prefixes in SITE_SCHEMAS.items() for p in prefixes for x in (p[1:], name)))
    found = F.try_element_at(lookup, prefix)
    return F.when((found == "melanoma_skin") & ~F.coalesce(number.between(8720, 8790), F.lit(False)), "generic").otherwise(F.coalesce(found, F.lit("generic")))


def staging_items(schema: Column) -> Column:
    """Core items, then the schema's own, each once and in order."""
    own = F.create_map(*(x for name, items in SCHEMA_ITEMS.items() for x in (F.lit(name), F.array(*(F.lit(i) for i in items)))))
    return F.array_distinct(F.concat(F.array(*(F.lit(i) for i in CORE_STAGING_ITEMS)), F.coalesce(F.try_element_at(own, schema), F.array().cast("array<int>"))))


def extractable(items: DataFrame) -> DataFrame:
    """Not retired, not derived for one programme, and required by any of the three."""
    required = F.col("npcr_collect").startswith("R") | F.col("coc_collect").startswith("R") | F.col("seer_collect").startswith("R")
    return active(items).where((F.coalesce("npcr_collect", F.lit("")) != "D") & F.coalesce(required, F.lit(False)))


def active(items: DataFrame) -> DataFrame:
    return items.where("coalesce(trim(year_retired), '') = '' and coalesce(trim(version_retired), '') = ''")


def valid_codes_text(codes: DataFrame, most: int = 60) -> DataFrame:
    """item, codes_text: code=description in file order, at most ``most`` of them."""
    pairs = F.array_sort(F.collect_list(F.struct("pos", F.concat("code", F.lit("="), "description").alias("t"))))
    return codes.groupBy("item").agg(F.array_join(F.transform(F.slice(pairs, 1, most), lambda x: x["t"]), "; ").alias("codes_text"))
