"""SQL that the registered queries are held against (run by DuckDB over the same tables)."""

from __future__ import annotations

from carrel.operators.resolution import CORE_STAGING_ITEMS, DOMAIN_ITEMS, SCHEMA_ITEMS
from carrel.synthetic import VALUES, WIDE, long_expressions, pick

SITE_PROBES = ["C50.4", " c504 ", "504", "", "C61.9", "8500/3", "85003", "C5", "8140", "x"]
TNM_PROBES = ["cT1mi", "pT2", "C2", "CX", "T1", "N1a", "c n0", "Tis", "is", "88", "", " 99 ", "R2B"]
STAGE_PROBES = ["Stage IV", "IIIA", "IIB", "I", "0", "0IS", "2A", "99", "unk", "", "IS", "7", "5", "stage 4", "x"]
MARKER_PROBES = ["1: ER positive", "negative", "0", "1", "2", "", "Left", "RIGHT", "unknown", "POS"]

#: coded items, and the stage items of the summary that they stand for
STAGE_PROBE_ITEMS = {940: 1001, 950: 1002, 960: 1003, 970: 1004, 880: 1011, 890: 1012, 900: 1013, 910: 1014}
MODEL_PROBES = ["openai/gpt-oss-120b", "Qwen/Qwen3.5-72B-Instruct", "google/gemma-4-27b", "Meta-Llama-3.1-8B", "gpt-oss", "big"]
SETTING_PROBES = ["auto", " Auto ", "none", "OFF", "qwen-3", "gpt oss", "other.parser", ""]
REFERENCES = ["/x/y", "../x", "./y", "a/../b", "?k=1", "#top", "//other.org/p", "https://third.net/q?r", "mailto:a@b.c", "z"]
PARSER_PROBES = ["GPT-OSS", "openai gpt_oss", " qwen-3 ", "Qwen3", "gemma.4", "__x__", "", "auto"]

SEP = "\\s"


def strip(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '^\\s+|\\s+$', '', 'g')"


def unknown(x: str) -> str:
    return f"({strip(x)} IN ('', '9', '99', '999', '9999', '99999999', '88', '888', '8888', '88888888', '00000000'))"


def digits(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '[^0-9]', '', 'g')"


def either(a: str, b: str) -> str:
    return f"coalesce(nullif({a}, ''), nullif({b}, ''), '')"


def site3(x: str) -> str:
    s = f"replace(replace(upper({strip(x)}), '.', ''), ' ', '')"
    return f"CASE WHEN {s} LIKE 'C%' THEN left({s}, 3) ELSE {s} END"


def tnm(x: str, axis: str) -> str:
    return f"regexp_replace(regexp_replace(replace(upper({strip(x)}), ' ', ''), '^[CPYRA]+', ''), '^{axis}', '')"


def tnm_main(x: str) -> str:
    return either(f"regexp_extract({x}, '^(IS|X|[0-9]+)', 1)", x)


def stage(x: str) -> str:
    return f"replace(replace(upper({strip(x)}), 'STAGE', ''), ' ', '')"


def stage_main(x: str) -> str:
    s = stage(x)
    return f"CASE WHEN {s} IN ('', '88', '99', 'NA', 'UNK', 'UNKNOWN') THEN 'unknown' WHEN {s} LIKE 'IV%' THEN '4' WHEN {s} LIKE 'III%' THEN '3' WHEN {s} LIKE 'II%' THEN '2' WHEN {s} LIKE 'I%' THEN '1' WHEN regexp_matches({s}, '^[0-9]') THEN left({s}, 1) ELSE 'unknown' END"


def extent(x: str) -> str:
    return f"CASE {stage_main(x)} WHEN '0' THEN 'insitu' WHEN '1' THEN 'localized' WHEN '2' THEN 'regional' WHEN '3' THEN 'regional' WHEN '4' THEN 'distant' ELSE 'unknown' END"


def summary_extent(x: str) -> str:
    return f"CASE left({digits(x)}, 1) WHEN '0' THEN 'insitu' WHEN '1' THEN 'localized' WHEN '2' THEN 'regional' WHEN '3' THEN 'regional' WHEN '4' THEN 'regional' WHEN '5' THEN 'regional' WHEN '7' THEN 'distant' ELSE 'unknown' END"


def marker(x: str) -> str:
    s = f"lower({strip(x)})"
    return f"CASE WHEN contains({s}, 'pos') THEN 'positive' WHEN contains({s}, 'neg') THEN 'negative' WHEN {s} LIKE '1%' THEN 'positive' WHEN {s} LIKE '0%' THEN 'negative' ELSE 'unknown' END"


_BLOCKS = """
blocks AS (
  SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN NULL ELSE '2024-01-' || lpad(CAST(turn % 28 + 1 AS VARCHAR), 2, '0') END AS date, coalesce(text, '') AS text FROM conversations
), texts AS (
  SELECT conv_id, string_agg('=== Clinical Note dated ' || coalesce(date, 'unknown') || ' ===' || chr(10) || text || chr(10), chr(10) ORDER BY turn) AS full_text, coalesce(arg_min(coalesce(date, ''), turn), '') AS first_doc_date FROM blocks GROUP BY conv_id
)"""
_CHUNKS = f"""
WITH {_BLOCKS}, counted AS (
  SELECT *, CASE WHEN greatest(1, floor(length(full_text) / 3.5)) <= 40 THEN 1 ELSE 1 + CAST(ceil(greatest(0, length(full_text) - 140) / 123.0) AS BIGINT) END AS n FROM texts
), chunks AS (
  SELECT conv_id, first_doc_date, CAST(k AS INT) AS chunk_index, CASE WHEN n = 1 THEN full_text ELSE substr(full_text, k * 123 + 1, 140) END AS chunk_text FROM counted, unnest(range(n)) AS u(k)
)"""
_PARTIAL = """
WITH partials AS (
  SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y%m') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y') || '1399' END AS value,
         CASE o_orderkey % 4 WHEN 0 THEN date_trunc('year', o_orderdate) WHEN 1 THEN date_trunc('month', o_orderdate) WHEN 2 THEN o_orderdate END AS lo0, o_orderkey % 4 AS kind FROM orders
), spans AS (
  SELECT o_orderkey, value, CAST(lo0 AS DATE) AS lo, CASE kind WHEN 0 THEN CAST(lo0 + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) WHEN 1 THEN CAST(lo0 + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) WHEN 2 THEN CAST(lo0 AS DATE) END AS hi FROM partials
)"""

# --- the rules, said once more in SQL: (edit, severity, items, condition) -------------------

_S = f"CASE WHEN replace(upper({strip('v400')}), '.', '') = '' THEN '' WHEN replace(upper({strip('v400')}), '.', '') LIKE 'C%' THEN replace(upper({strip('v400')}), '.', '') ELSE 'C' || replace(upper({strip('v400')}), '.', '') END"
_H = f"CASE WHEN regexp_matches({strip('v522')}, '[^0]') THEN TRY_CAST(nullif(regexp_extract({strip('v522')}, '^([0-9]{{4}})', 1), '') AS INT) END"
_BASE = f"""
base AS (SELECT *, {_S} AS s, {_H} AS h, TRY_CAST({strip('v230')} AS INT) AS age, {strip('v523')} AS b, {either('v1290', 'v1291')} AS surg,
  CASE WHEN {unknown('v490')} THEN NULL ELSE TRY_CAST(v490 AS INT) END AS dc FROM rec)"""
_DONE = f"(surg NOT IN ('00', '0000', '0', '98', '99', '') AND NOT {unknown('surg')})"
_RAD = f"(v1360 NOT IN ('0', '7', '8', '9', '') AND NOT {unknown('v1360')})"
_NUM = lambda x: f"TRY_CAST(left(rpad({x}, 8, '0'), 8) AS INT)"


def _before(a: str, b: str) -> str:
    return f"(NOT {unknown(a)} AND NOT {unknown(b)} AND {_NUM(a)} < {_NUM(b)})"


def _any_known(*items: int) -> str:
    return "(" + " OR ".join(f"NOT {unknown(f'v{i}')}" for i in items) + ")"


_PAIRED = "(s IN ('C300','C384','C413','C414','C471','C472','C491','C492','C570','C630','C754','C755') OR left(s, 3) IN ('C07','C08','C09','C34','C40','C44','C50','C56','C62','C64','C65','C66','C69','C74'))"
_INNER = "left(s, 3) IN ('C15','C16','C17','C18','C19','C20','C21','C22','C23','C24','C25','C26','C30','C31','C32','C33','C34','C37','C38','C48','C61','C64','C65','C66','C67','C68')"
_SEX = "v220 IN ('1','2','3','4','5','6') AND s <> ''"
RULES = [
    ("IF39_Site_Sex", "error", "400,220", f"{_SEX} AND (left(s, 3) IN ('C62','C63') OR s = 'C619') AND v220 <> '1'"),
    ("IF39_Site_Sex", "error", "400,220", f"{_SEX} AND left(s, 3) IN ('C53','C54','C55','C56','C57','C58') AND v220 <> '2'"),
    ("IF25_Site_Histology", "error", "400,522", "s <> '' AND h BETWEEN 8170 AND 8175 AND left(s, 3) <> 'C22'"),
    ("IF25_Site_Histology", "warning", "400,522", "s <> '' AND h = 8312 AND left(s, 3) <> 'C64'"),
    ("IF25_Site_Histology", "error", "400,522", f"s <> '' AND h BETWEEN 8720 AND 8790 AND {_INNER}"),
    ("IF25_Site_Histology", "error", "400,522", "s <> '' AND h BETWEEN 9050 AND 9055 AND left(s, 4) <> 'C384' AND left(s, 3) <> 'C48'"),
    ("IF25_Site_Histology", "warning", "400,522", "s <> '' AND h BETWEEN 9800 AND 9989 AND left(s, 3) <> 'C42'"),
    ("Laterality_PairedSite", "error", "400,410", f"{_PAIRED} AND v410 IN ('', '0')"),
    ("Laterality_PairedSite", "warning", "400,410", "false"),
    ("Behavior_Histology", "error", "522,523", "b = '2' AND h >= 9800"),
    ("Behavior_Histology", "error", "522,523", "b = '2' AND h BETWEEN 9590 AND 9729"),
    ("Behavior_Histology", "warning", "522,523", "b = '0' AND h BETWEEN 8010 AND 8576"),
    ("Age_Site_Plausibility", "warning", "400,230", "left(s, 3) = 'C61' AND age < 20 AND age <> 999"),
    ("Age_Site_Plausibility", "warning", "400,230", "left(s, 3) = 'C50' AND age < 15 AND age <> 999"),
    ("Age_Histology_Plausibility", "warning", "522,230", "s <> '' AND h BETWEEN 9510 AND 9514 AND age > 10 AND age <> 999"),
    ("Age_Histology_Plausibility", "warning", "522,230", "s <> '' AND h = 9500 AND age > 20 AND age <> 999"),
    ("Age_Histology_Plausibility", "warning", "522,230", "s <> '' AND h = 8960 AND age > 15 AND age <> 999"),
    ("TNM_Clinical_Consistency", "warning", "940,950,960,970", f"{_any_known(940, 950, 960)} AND {unknown('v970')}"),
    ("TNM_Pathological_Consistency", "warning", "880,890,900,910", f"{_any_known(880, 890, 900)} AND {unknown('v910')}"),
    ("TNM_Clinical_T0_Npositive", "warning", "940,950", f"replace(upper(v940), ' ', '') IN ('T0','0','C0','P0') AND replace(upper(v950), ' ', '') NOT IN ('N0','0','NX','X','') AND NOT {unknown('v950')}"),
    ("TNM_Pathological_T0_Npositive", "warning", "880,890", f"replace(upper(v880), ' ', '') IN ('T0','0','C0','P0') AND replace(upper(v890), ' ', '') NOT IN ('N0','0','NX','X','') AND NOT {unknown('v890')}"),
    ("TNM_Clinical_Tis_Behavior", "error", "940,523", "upper(v940) IN ('TIS','IS') AND b = '3'"),
    ("TNM_Pathological_Tis_Behavior", "error", "880,523", "upper(v880) IN ('TIS','IS') AND b = '3'"),
    *(("Treatment_Date_Before_Diagnosis", "error", f"{i},390", _before(f"v{i}", "v390")) for i in (1200, 1210, 1220, 1230, 1240)),
    ("DiagConfirm_Histology", "warning", "490,522", f"dc BETWEEN 1 AND 5 AND {unknown('v522')}"),
    ("DiagConfirm_PathStaging", "warning", "490,880,890,900,910", f"dc BETWEEN 6 AND 9 AND {_any_known(880, 890, 900, 910)}"),
    ("Surgery_Date_Missing", "warning", "1290,1200", f"{_DONE} AND {unknown('v1200')}"),
    ("Surgery_Margins_Missing", "warning", "1290,1320", f"{_DONE} AND {unknown('v1320')}"),
    ("Reason_No_Surgery_Missing", "warning", "1290,1340", f"surg IN ('00','0000','0') AND {unknown('v1340')}"),
    ("Radiation_Date_Missing", "warning", "1360,1210", f"{_RAD} AND {unknown('v1210')}"),
    ("Reason_No_Radiation_Missing", "warning", "1360,1430", f"v1360 = '0' AND {unknown('v1430')}"),
    ("DLC_Before_Diagnosis", "error", "1750,390", _before("v1750", "v390")),
    ("Dead_No_CauseOfDeath", "warning", "1760,1910", f"v1760 = '0' AND {unknown('v1910')}"),
    ("Surgery_TumorSizePath_Missing", "warning", "1290,754", f"{_DONE} AND {unknown('v754')}"),
    ("Radiation_Modality_Missing", "warning", "1360,1570", f"{_RAD} AND {unknown('v1570')}"),
    ("Chemo_Text_Missing", "warning", "1390,2640", f"v1390 NOT IN ('00','0','82','85','86','87','88','99','') AND NOT {unknown('v1390')} AND {unknown('v2640')}"),
    ("DistantStage_No_Mets_Site", "warning", "764,1112,1113,1114,1115,1116,1117", "v764 = '7' AND NOT (" + " OR ".join(f"v{i} = '1'" for i in range(1112, 1118)) + ")"),
    ("PathStaging_No_Surgery", "warning", "880,890,900,910,1290", f"{_any_known(880, 890, 900, 910)} AND surg <> '' AND NOT {_DONE}"),
    ("SentinelLN_Scope_Missing", "warning", "834,1292", f"NOT {unknown('v834')} AND TRY_CAST(v834 AS INT) > 0 AND {unknown('v1292')}"),
    ("SentinelLN_Scope_Mismatch", "warning", "834,1292", f"NOT {unknown('v834')} AND TRY_CAST(v834 AS INT) > 0 AND v1292 = '0'"),
    ("GradePath_No_Surgery", "warning", "441,1290", f"NOT {unknown('v441')} AND surg <> '' AND NOT {_DONE}"),
]
_HITS = " UNION ALL ".join(f"SELECT rec, {k} AS seq, '{e}' AS edit_name, '{s}' AS severity, '{i}' AS items FROM base WHERE {c}" for k, (e, s, i, c) in enumerate(RULES))
_VIOLATIONS = f"WITH rec AS ({WIDE}), {_BASE}, hits AS ({_HITS})"
_X, _R, _C = long_expressions()
_LONG = f"""long AS (
  SELECT rec, item, {_X} AS extracted, {_R} AS resolved, CAST({_C} AS DOUBLE) AS confidence
  FROM (SELECT rec, CAST(substr(name, 2) AS INT) AS item, value FROM (UNPIVOT rec ON {', '.join(f'v{i}' for i in VALUES)} INTO NAME name VALUE value))
)"""
_SCORES = f"""{_VIOLATIONS}, {_LONG}, worst AS (
  SELECT rec, CAST(i AS INT) AS item, max(CASE severity WHEN 'error' THEN 2 ELSE 1 END) AS severity FROM hits, unnest(string_split(items, ',')) AS u(i) GROUP BY ALL
), scores AS (
  SELECT l.*, w.severity, round(greatest(0.0, least(1.0, (confidence - CASE w.severity WHEN 2 THEN CAST(0.3 AS DOUBLE) WHEN 1 THEN CAST(0.15 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) * CASE WHEN extracted <> '' AND resolved <> '' AND extracted <> resolved AND confidence < 1 THEN CAST(0.8 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END)), 4) AS final_confidence
  FROM long l LEFT JOIN worst w USING (rec, item)
)"""
_KEY, _NEED = "item IN (90, 220, 230, 400, 522)", "item IN (90, 220, 230, 390, 400, 410, 490, 522, 523, 764, 880, 890, 900, 910, 940, 950, 960, 970, 1290, 1360, 1390, 1750, 1760)"
_C2 = "final_confidence"

_TABLES = f"""
WITH rec AS ({WIDE}), shaped AS (
  SELECT o_custkey AS mrn, rec, CAST(o_orderdate AS DATE) AS day, v400 AS site, v522 AS hist, v523 AS beh, v410 AS lat, v441 AS grade, v764 AS ss, v910 AS ajcc, v940 AS t, v950 AS n, v960 AS m, v1112 AS er, v1113 AS pr, v1114 AS her2
  FROM rec JOIN orders ON rec = o_orderkey
), truth AS (SELECT *, row_number() OVER (PARTITION BY mrn ORDER BY rec) - 1 AS ti FROM shaped WHERE rec % 2 = 0),
predicted AS (SELECT *, row_number() OVER (PARTITION BY mrn ORDER BY rec) - 1 AS pi FROM shaped WHERE rec % 2 = 1),
pairs AS (
  SELECT t.mrn, ti, pi, ({site3('t.site')}) <> '' AND ({site3('t.site')}) = ({site3('p.site')}) AS site_match, abs(date_diff('day', p.day, t.day)) AS days FROM truth t JOIN predicted p ON t.mrn = p.mrn
), ranked AS (SELECT *, row_number() OVER (PARTITION BY mrn ORDER BY NOT site_match, days, ti, pi) AS k FROM pairs)"""
_GREEDY = (
    _TABLES.replace("WITH rec", "WITH RECURSIVE rec", 1)
    + """, walk AS (
  SELECT mrn, k, [ti] AS ts, [pi] AS ps, true AS took, ti, pi, site_match, days FROM ranked WHERE k = 1
  UNION ALL
  SELECT r.mrn, r.k, CASE WHEN list_contains(w.ts, r.ti) OR list_contains(w.ps, r.pi) THEN w.ts ELSE list_append(w.ts, r.ti) END,
         CASE WHEN list_contains(w.ts, r.ti) OR list_contains(w.ps, r.pi) THEN w.ps ELSE list_append(w.ps, r.pi) END,
         NOT (list_contains(w.ts, r.ti) OR list_contains(w.ps, r.pi)), r.ti, r.pi, r.site_match, r.days
  FROM walk w JOIN ranked r ON r.mrn = w.mrn AND r.k = w.k + 1
), taken AS (SELECT mrn, ti, pi, site_match, days FROM walk WHERE took),
joined AS (
  SELECT t.*, g.pi, coalesce(g.site_match OR g.days <= 365, false) AS matched, g.site_match, g.days AS gap FROM truth t LEFT JOIN taken g ON t.mrn = g.mrn AND t.ti = g.ti
)"""
)


def _flag(name: str, condition: str, needs_match: bool = True) -> str:
    return f"CAST(coalesce({'matched AND ' if needs_match else ''}({condition}), false) AS INT) AS {name}"


def _equal(f, a: str) -> str:
    return f"({f('j.' + a)}) <> '' AND ({f('j.' + a)}) = ({f('p.' + a)})"


def _present(x: str, unknowns: str) -> str:
    return f"{x} NOT IN ({unknowns})"


_TU, _SU = "'', 'x', '88', '99', 'unknown', 'nan'", "'', '9', '88', '99', 'unknown', 'nan'"
_site = lambda x: f"replace(replace(upper({strip(x)}), '.', ''), ' ', '')"
_hist = lambda n: lambda x: f"left({digits(x)}, {n})"
_FLAGS = [
    _flag("present_site", f"{_site('j.site')} <> ''", False), _flag("present_hist", f"{_hist(4)('j.hist')} <> ''", False), _flag("present_beh", _present(strip("j.beh"), "'', 'nan'"), False),
    _flag("present_lat", _present(strip("j.lat"), "'', '9', 'nan'"), False), _flag("present_grade", _present(strip("j.grade"), "'', '9', 'nan'"), False), _flag("present_ss", _present(strip("j.ss"), "'', '9', 'nan'"), False),
    _flag("present_ajcc", f"({stage_main('j.ajcc')}) <> 'unknown'", False), _flag("present_stage_axis", f"({extent('j.ajcc')}) <> 'unknown'", False), _flag("present_date_gt", "j.day IS NOT NULL", False),
    _flag("pp_site", f"{_site('p.site')} <> ''"), _flag("pp_hist", f"{_hist(4)('p.hist')} <> ''"), _flag("pp_beh", _present(strip("p.beh"), "'', '9', 'nan'")), _flag("pp_lat", _present(f"lower({strip('p.lat')})", "'', '9', 'unknown', 'nan'")),
    _flag("pp_grade", _present(f"lower({strip('p.grade')})", _SU)), _flag("pp_ss", _present(f"lower({strip('p.ss')})", _SU)), _flag("pp_ajcc", f"({stage_main('p.ajcc')}) <> 'unknown'"), _flag("pp_stage_axis", f"({summary_extent('p.ss')}) <> 'unknown'"), _flag("present_date_pred", "p.day IS NOT NULL"),
    _flag("ok_site_exact", _equal(_site, "site")), _flag("ok_site3", _equal(site3, "site")), _flag("ok_hist4", _equal(_hist(4), "hist")), _flag("ok_hist3", _equal(_hist(3), "hist")),
    *(_flag(f"ok_{f}", _equal(strip, f)) for f in ("beh", "lat", "grade")),
    _flag("ok_ss_exact", f"{strip('j.ss')} <> '' AND left({digits('j.ss')}, 1) = left({digits('p.ss')}, 1)"), _flag("ok_ss_collapse", f"({summary_extent('j.ss')}) <> 'unknown' AND ({summary_extent('j.ss')}) = ({summary_extent('p.ss')})"),
    _flag("ok_stage_axis", f"({extent('j.ajcc')}) <> 'unknown' AND ({extent('j.ajcc')}) = ({summary_extent('p.ss')})"),
    _flag("ok_ajcc_exact", f"{strip('j.ajcc')} <> '' AND {stage('j.ajcc')} = {stage('p.ajcc')}"), _flag("ok_ajcc_main", f"({stage_main('j.ajcc')}) <> 'unknown' AND ({stage_main('j.ajcc')}) = ({stage_main('p.ajcc')})"),
    *(x for a in "tnm" for x in (_flag(f"present_{a}", f"lower({tnm('j.' + a, a.upper())}) NOT IN ({_TU})", False), _flag(f"pp_{a}", f"lower({tnm('p.' + a, a.upper())}) NOT IN ({_TU})"), _flag(f"ok_{a}_exact", f"{tnm('j.' + a, a.upper())} <> '' AND {tnm('j.' + a, a.upper())} = {tnm('p.' + a, a.upper())}"))),
    *(_flag(f"ok_{a}_main", f"{tnm_main(tnm('j.' + a, a.upper()))} <> '' AND {tnm_main(tnm('j.' + a, a.upper()))} = {tnm_main(tnm('p.' + a, a.upper()))}") for a in "tn"),
    *(x for a in ("er", "pr", "her2") for x in (_flag(f"present_{a}", f"({site3('j.site')}) = 'C50' AND ({marker('j.' + a)}) <> 'unknown'", False), _flag(f"pp_{a}", f"({marker('p.' + a)}) <> 'unknown'"), _flag(f"ok_{a}", f"({marker('j.' + a)}) <> 'unknown' AND ({marker('j.' + a)}) = ({marker('p.' + a)})"))),
    _flag("ok_date_exact", "j.day = p.day"), *(_flag(f"ok_date{n}", f"abs(date_diff('day', p.day, j.day)) <= {n}") for n in (30, 90, 365)), _flag("ok_year", "year(j.day) = year(p.day)"),
]
_SCORED = f"{_GREEDY}, scored AS (SELECT j.mrn, j.ti, matched, {', '.join(_FLAGS)} FROM joined j LEFT JOIN predicted p ON j.matched AND p.mrn = j.mrn AND p.pi = j.pi)"
_METRICS = [("primary_site_exact", "site", "site", "site_exact"), ("primary_site_3char", "site", "site", "site3"), ("histology_4digit", "hist", "hist", "hist4"), ("histology_3digit", "hist", "hist", "hist3"), ("behavior", "beh", "beh", "beh"), ("laterality", "lat", "lat", "lat"), ("grade", "grade", "grade", "grade"), ("summary_stage_exact", "ss", "ss", "ss_exact"), ("summary_stage_collapsed", "ss", "ss", "ss_collapse"), ("stage_extent_crosswalk", "stage_axis", "stage_axis", "stage_axis"), ("ajcc_stage_group_exact", "ajcc", "ajcc", "ajcc_exact"), ("ajcc_stage_group_main", "ajcc", "ajcc", "ajcc_main"), ("ajcc_clin_T_exact", "t", "t", "t_exact"), ("ajcc_clin_T_main", "t", "t", "t_main"), ("ajcc_clin_N_exact", "n", "n", "n_exact"), ("ajcc_clin_N_main", "n", "n", "n_main"), ("ajcc_clin_M_exact", "m", "m", "m_exact"), ("dx_date_exact", "date_gt", None, "date_exact"), ("dx_date_within30d", "date_gt", None, "date30"), ("dx_date_within90d", "date_gt", None, "date90"), ("dx_date_within365d", "date_gt", None, "date365"), ("dx_year_match", "date_gt", None, "year"), ("ER_breast", "er", "er", "er"), ("PR_breast", "pr", "pr", "pr"), ("HER2_breast", "her2", "her2", "her2")]


def _metric(name: str, there: str, answered: str | None, right: str) -> str:
    a = f"pp_{answered}" if answered else "present_date_pred"
    base = f"matched AND present_{there} = 1"
    return (
        f"SELECT '{name}' AS metric, count(*) FILTER ({base}) AS n_gt, round(count(*) FILTER ({base} AND ok_{right} = 1) / nullif(count(*) FILTER ({base}), 0), 4) AS accuracy, round(count(*) FILTER ({base} AND {a} = 1) / nullif(count(*) FILTER ({base}), 0), 4) AS coverage, "
        f"count(*) FILTER ({base} AND {a} = 1) AS n_attempted, round(count(*) FILTER ({base} AND {a} = 1 AND ok_{right} = 1) / nullif(count(*) FILTER ({base} AND {a} = 1), 0), 4) AS accuracy_attempted FROM scored"
    )


_CODED = f"SELECT o_orderkey, {pick('o_orderkey', 400, VALUES[400])} AS site, {pick('o_orderkey', 522, VALUES[522])} AS hist FROM orders"
_SCHEMA = f"""CASE WHEN p = '50' THEN 'breast' WHEN p = '61' THEN 'prostate' WHEN p IN ('18', '19', '20', '21') THEN 'colon_rectum' WHEN p = '34' THEN 'lung'
  WHEN p = '44' AND TRY_CAST(regexp_extract({strip('hist')}, '^([0-9]{{4}})', 1) AS INT) BETWEEN 8720 AND 8790 THEN 'melanoma_skin' WHEN p IN ('64', '65') THEN 'kidney_renal_pelvis' WHEN p = '67' THEN 'bladder' WHEN p = '73' THEN 'thyroid'
  WHEN p = '53' THEN 'cervix' WHEN p = '56' THEN 'ovary' WHEN p = '62' THEN 'testis' WHEN p = '22' THEN 'liver' WHEN p = '25' THEN 'pancreas' WHEN p IN ('70', '71', '72') THEN 'brain_cns' ELSE 'generic' END"""
_PREFIX = f"regexp_extract(replace(upper({strip('site')}), '.', ''), '^C?([0-9]{{2}})', 1)"
_LABEL = "CASE WHEN code = 'C50.4' THEN 'Upper-outer quadrant of breast' WHEN left(code, 3) = 'C50' THEN 'Breast' WHEN left(code, 3) = 'C18' THEN 'Colon' WHEN left(code, 3) = 'C61' THEN 'Prostate' ELSE '' END"


def site_code(x: str) -> str:
    f = f"replace(regexp_extract(upper({strip(x)}), 'C([0-9]{{2}})\\.?([0-9]?)', 0), '.', '')"
    return f"CASE WHEN length({f}) = 4 THEN left({f}, 3) || '.' || right({f}, 1) ELSE {f} END"


def probe(salt: int, values: list[str], columns: str) -> str:
    return f"SELECT o_orderkey, {columns} FROM (SELECT o_orderkey, {pick('o_orderkey', salt, values)} AS x FROM orders)"


_SCHEMA_OF = f"SELECT o_orderkey, {_SCHEMA} AS schema FROM (SELECT *, {_PREFIX} AS p FROM ({_CODED}))"
_STAGING = {name: [*dict.fromkeys([*CORE_STAGING_ITEMS, *own])] for name, own in ({"generic": []} | SCHEMA_ITEMS).items()}


TOKENS = r"""(?is)<!--.*?-->|<[!?][^>]*>|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|</?[a-z][^>]*>|[^<]+|<"""


def _unescaped(x: str) -> str:
    for code, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{code}', '{sign}')"
    return x


def _html_text(x: str) -> str:
    """Every token of a page gives a line, a line break or nothing."""
    line = lambda t: f"nullif(trim(regexp_replace({t}, '\\s+', ' ', 'g')), '')"
    inner = r"regexp_replace(t, '(?is)^<[^>]*>|</[a-z]+\s*>$', '', 'g')"
    parts = f"""list_transform(regexp_extract_all({x}, '{TOKENS}'), lambda t: CASE WHEN regexp_matches(t, '(?i)^<(br|p|li|tr|h[1-4])[\\s/>]') THEN chr(10) WHEN regexp_matches(t, '(?is)^<(script|style)\\b') THEN {line(inner)} WHEN t LIKE '<_%' THEN NULL ELSE {line(_unescaped('t'))} END)"""
    return f"regexp_replace(regexp_replace(array_to_string(list_filter({parts}, lambda p: p IS NOT NULL), chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')"



def _stage_columns() -> str:
    """Code and text of every stage item: a description where the dictionary has one, else the code without its prefix."""
    described = {1011: "CASE WHEN lower(r1011) = 't1' THEN 'Described T1' END", 1014: "CASE WHEN r1014 = '99' THEN 'Stage unknown' END"}
    names = {1001: "clinical_t", 1002: "clinical_n", 1003: "clinical_m", 1004: "clinical_stage", 1011: "pathologic_t", 1012: "pathologic_n", 1013: "pathologic_m", 1014: "pathologic_stage"}
    return ", ".join(f"r{i} AS {name}_code, coalesce({described.get(i, 'NULL')}, regexp_replace(r{i}, '(?i)^[cp]([TNM0IVX])', '\\1')) AS {name}_text" for i, name in names.items())


def _stage_values() -> str:
    best = lambda i: f"coalesce(nullif(max(resolved) FILTER (item = {i}), ''), max(extracted) FILTER (item = {i}), '')"
    return ", ".join(f"{strip(best(i))} AS r{to}" for i, to in STAGE_PROBE_ITEMS.items())


ORACLES: dict[str, str] = {
    "scan_notes_nonblank": "SELECT doc_id, source, CAST(length(text) AS INT) AS n_chars FROM documents WHERE text IS NOT NULL AND regexp_matches(text, '\\S')",
    "structured_projection": """WITH first AS (SELECT * FROM customer JOIN orders ON c_custkey = o_custkey QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderdate, o_orderkey) = 1)
SELECT CAST(c_custkey AS VARCHAR) AS patient_id, item, value FROM (SELECT c_custkey, 2230 AS item, c_name AS value FROM first UNION ALL SELECT c_custkey, 220, coalesce(nullif(o_orderstatus, ''), c_mktsegment) FROM first UNION ALL SELECT c_custkey, 100, CAST(c_nationkey AS VARCHAR) FROM first) WHERE value <> ''""",
    "doc_index": "SELECT o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) - 1 AS INT) AS doc_index FROM orders",
    "notes_concat": f"WITH {_BLOCKS} SELECT * FROM texts",
    "token_estimate": "SELECT doc_id, CAST(greatest(1, floor(length(text) / 3.5)) AS INT) AS tokens FROM documents",
    "chunk_notes": f"{_CHUNKS} SELECT conv_id, chunk_index, chunk_text, CAST(greatest(1, floor(length(chunk_text) / 3.5)) AS INT) AS token_estimate FROM chunks",
    "chunk_dates": f"""{_CHUNKS}, found AS (SELECT *, regexp_extract_all(chunk_text, '=== Clinical Note dated (.+?) ===', 1) AS h FROM chunks)
SELECT conv_id, chunk_index, coalesce(h[1], carried) AS first_date, coalesce(h[-1], carried) AS last_date FROM (
  SELECT *, coalesce(last_value(h[-1] IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY chunk_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), first_doc_date) AS carried FROM found)""",
    "tumor_fold": f"""{_CHUNKS}, said AS (SELECT conv_id, chunk_index, CASE WHEN contains(chunk_text, 'the') THEN 'breast' ELSE 'colon' END AS kind FROM chunks),
last AS (SELECT conv_id, arg_max(kind, chunk_index) AS kind FROM said GROUP BY 1)
SELECT CAST(l.conv_id AS VARCHAR) AS patient_id, CAST(0 AS INT) AS tumor_index, l.kind AS cancer_type, 'site' AS primary_site_hint, 'left' AS laterality, CAST(count(*) FILTER (s.kind = l.kind) AS INT) AS n_chunks FROM last l JOIN said s ON s.conv_id = l.conv_id GROUP BY ALL""",
    "tumor_codes": f"""{_CHUNKS} SELECT CAST(conv_id AS VARCHAR) AS patient_id, CAST(0 AS INT) AS tumor_index, CASE WHEN breast THEN 'breast' ELSE 'colon' END AS cancer_type, 'left site' AS primary_site_hint, CASE WHEN breast THEN 'C50.9' ELSE 'C18.2' END AS primary_site_code, CASE WHEN breast THEN '8500' ELSE '' END AS histology_code
FROM (SELECT conv_id, arg_max(contains(chunk_text, 'the'), chunk_index) AS breast FROM chunks GROUP BY 1)""",
    "staging_phase_items": f"WITH schemas AS ({_SCHEMA_OF}), items AS (" + " UNION ALL ".join(f"SELECT '{name}' AS schema, unnest({items}) AS item" for name, items in _STAGING.items()) + ") SELECT CAST(o_orderkey AS VARCHAR) AS patient_id, CAST(item AS INT) AS item FROM schemas JOIN items USING (schema)",
    "first_open_round": "WITH w AS (SELECT DISTINCT conv_id, turn FROM conversations), o AS (SELECT min(turn) AS first FROM w WHERE NOT (turn < 2 OR conv_id % 3 = 0)) SELECT CAST(max(turn) + 1 AS INT) AS n_rounds, CAST(coalesce(any_value(first), max(turn) + 1) AS INT) AS first_open FROM w, o",
    "parser_names": f"SELECT o_orderkey, CASE WHEN k IN ('gptoss', 'gpt_oss', 'openai_gpt_oss') THEN 'openai_gptoss' WHEN k = 'qwen_3' THEN 'qwen3' WHEN k = 'gemma_4' THEN 'gemma4' ELSE k END AS parser FROM (SELECT o_orderkey, trim(regexp_replace(lower({pick('o_orderkey', 11, PARSER_PROBES)}), '[^a-z0-9]+', '_', 'g'), '_') AS k FROM orders)",
    "usage_numbers": "SELECT event_id, CAST(CASE WHEN event_id % 4 = 3 THEN NULL WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS INT) AS n, CAST(CASE WHEN event_id % 4 <> 3 THEN event_id END AS BIGINT) AS prompt_tokens, CAST(CASE WHEN event_id % 4 <> 3 AND event_id % 3 <> 0 THEN 7 END AS BIGINT) AS cached FROM events",
    "envelope_text": "SELECT conv_id, turn, text || CASE turn % 7 WHEN 1 THEN '!' WHEN 4 THEN 'no' ELSE '' END AS answer FROM conversations WHERE text IS NOT NULL",
    "parser_choice": f"""SELECT o_orderkey, CASE WHEN s IN ('', 'none', 'off') THEN NULL WHEN s = 'auto' THEN CASE WHEN m LIKE '%gpt-oss%' THEN 'openai_gptoss' WHEN m LIKE '%gemma-4%' THEN 'gemma4' WHEN m LIKE '%Qwen3%' THEN 'qwen3' END WHEN s = 'qwen-3' THEN 'qwen3' WHEN s = 'gpt oss' THEN 'openai_gptoss' ELSE replace(s, '.', '_') END AS parser,
CASE WHEN m LIKE '%120b' OR m LIKE '%72B%' THEN 'large' WHEN m LIKE '%-8B' THEN 'small' ELSE 'medium' END AS size FROM (SELECT o_orderkey, {pick('o_orderkey', 12, MODEL_PROBES)} AS m, lower(trim({pick('o_orderkey', 13, SETTING_PROBES)})) AS s FROM orders)""",
    "reasoning_split": r"""SELECT conv_id, turn, CASE turn % 7 WHEN 0 THEN regexp_replace('why ' || t, '\s+$', '') WHEN 5 THEN '' WHEN 6 THEN 'said by the server' ELSE 'why' END AS reasoning, CASE WHEN turn % 7 = 4 THEN '<tool_call>' ELSE '' END || t AS final
FROM (SELECT *, regexp_replace(regexp_replace(text, '[<>|]', ' ', 'g'), '^\s+|\s+$', '', 'g') AS t FROM conversations WHERE text IS NOT NULL)""",
    "text_cleanup": r"""SELECT conv_id, turn, CASE turn % 5 WHEN 1 THEN 'note ```x``` ' || t WHEN 2 THEN '```' || chr(10) || t WHEN 3 THEN 'Clinical Summary: ' || t ELSE t END AS unfenced, CASE turn % 5 WHEN 1 THEN 'note ```x``` ' || t ELSE t END AS summary,
CASE turn % 5 WHEN 0 THEN 'left outer quadrant of left breast' WHEN 1 THEN 'Right lung' WHEN 2 THEN 'unknown' ELSE 'colon' END AS site
FROM (SELECT *, regexp_replace(replace(text, '`', ''), '^\s+|\s+$', '', 'g') AS t FROM conversations WHERE text IS NOT NULL) WHERE t <> ''""",
    "answered_calls": """SELECT sha256('s' || chr(31) || text) AS request_id, '{"n": ' || n || '}' AS response, CAST(NULL AS VARCHAR) AS error, CAST(CASE WHEN n % 3 = 0 THEN 2 ELSE 1 END AS INT) AS attempts, CASE WHEN n % 5 = 0 THEN 'thought' ELSE 'hm' END AS reasoning, CASE WHEN n % 5 = 0 THEN n END AS tokens
FROM (SELECT DISTINCT text, length(text) AS n FROM conversations WHERE text IS NOT NULL)""",
    "durable_answers": """SELECT sha256('s' || chr(31) || text) AS request_id, '{"n": ' || length(text) || '}' AS response, (SELECT CAST(count(DISTINCT text) AS INT) FROM conversations WHERE turn % 2 = 0) AS n_first FROM (SELECT DISTINCT text FROM conversations WHERE text IS NOT NULL)""",
    "checkpoint_keys": "SELECT c_custkey, left(sha256(CAST(c_custkey AS VARCHAR)), 20) AS name FROM customer",
    "notes_loaded": "SELECT CAST(conv_id AS VARCHAR) AS patient_id, lpad(CAST(turn AS VARCHAR), 6, '0') AS date, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INT) AS doc_index, sha256(text) AS text_sha256 FROM conversations WHERE regexp_matches(coalesce(text, ''), '[^ \\t\\n\\r\\f\\v]')",
    "xml_scan": f"""WITH rec AS ({WIDE}), {_LONG}, v AS (SELECT rec // 10 AS patient, rec % 10 AS tumor, item, resolved AS value FROM long), t AS (SELECT patient, tumor, CAST(row_number() OVER (PARTITION BY patient ORDER BY tumor) - 1 AS INT) AS tumor_no, max(value) FILTER (item = 220) AS own_sex, coalesce(max(value) FILTER (item = 400), '') AS site, coalesce(max(value) FILTER (item = 522), '') AS hist FROM v GROUP BY patient, tumor)
SELECT patient, tumor_no, coalesce(first_value(own_sex) OVER (PARTITION BY patient ORDER BY tumor), '') AS sex, site, hist FROM t""",
    "export_scan": f"SELECT o_custkey AS mrn, count(*) AS n, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day, nullif(max({pick('o_orderkey', 400, VALUES[400])}), '') AS site, CAST(0 AS BIGINT) AS n_hist FROM orders WHERE o_orderkey % 50 <> 0 GROUP BY 1",
    "predictions_scan": f"WITH rec AS ({WIDE}) SELECT rec AS mrn, v400 AS site, v522 AS hist FROM rec",
    "audit_scan": f"WITH rec AS ({WIDE}), {_LONG} SELECT rec, item, coalesce(extracted, '') AS extracted, coalesce(resolved, '') AS resolved, CAST(confidence AS DOUBLE) AS confidence, sha256(left(repeat(' \"e\", ', 100), 500)) AS evidence_sha256 FROM long WHERE item = 400",
    "json_scan": f"WITH rec AS ({WIDE}) SELECT rec, nullif(v400, '') AS primarySite, nullif(v522, '') AS hist, CAST(NULL AS VARCHAR) AS site FROM rec",
    "checkpoint_scan": "SELECT user_id, length(event_type) * 100 AS item, arg_max(event_type, event_id) AS value FROM events GROUP BY ALL",
    "html_to_text": f"SELECT page_id, {_html_text('html')} AS text FROM pages",
    "rounds_by_chunk": f"{_CHUNKS} SELECT chunk_index AS round, count(*) AS units FROM chunks GROUP BY 1",
    "batching": "SELECT p_partkey, p_brand, CAST((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) // 50 AS INT) AS batch FROM part",
    "partial_date_interval": f"{_PARTIAL} SELECT * FROM spans",
    "diagnosis_window": f"{_PARTIAL} SELECT o_orderkey, CAST(lo - INTERVAL 6 MONTH AS DATE) AS lo, CAST(hi + INTERVAL 6 MONTH AS DATE) AS hi FROM spans",
    "window_overlap_join": f"{_PARTIAL} SELECT o_orderkey AS patient_id, count(*) AS n_docs, min(CAST(l_shipdate AS DATE)) AS first_doc FROM spans JOIN lineitem ON l_orderkey = o_orderkey WHERE lo IS NULL OR (CAST(l_shipdate AS DATE) <= hi + INTERVAL 1 MONTH AND CAST(l_shipdate AS DATE) >= lo - INTERVAL 1 MONTH) GROUP BY 1",
    "predicted_dates": f"{_PARTIAL} SELECT o_orderkey, coalesce(lo, CAST(left(value, 4) || '-01-01' AS DATE)) AS day FROM spans",
    "merge_highest_confidence": "SELECT user_id, event_type AS item, arg_max(props, (value, -event_id)) AS extracted, max(value) AS confidence, arg_max(event_id, (value, -event_id)) AS seq FROM events GROUP BY 1, 2",
    "high_confidence_skip": "SELECT user_id, event_type AS item FROM events GROUP BY 1, 2 HAVING max(value / 100) < 0.9",
    "item_number_leak": "WITH rows AS (SELECT p_partkey, CAST(CASE WHEN p_partkey % 2 = 0 THEN 880 ELSE 400 END AS INT) AS item, CASE WHEN p_partkey % 7 = 0 THEN '88' ELSE CAST(p_size AS VARCHAR) END AS code FROM part) SELECT * FROM rows WHERE NOT (item = 880 AND code NOT IN ('88', '99') AND CAST(code AS INT) >= 5)",
    "llm_payload_parse": "SELECT event_id, event_type AS field, json_extract_string(props, '$.k') AS value, CASE WHEN event_id % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE round(CAST((event_id % 100) / 100.0 AS DOUBLE), 4) END AS model_confidence, 'note' AS evidence FROM events",
    "resolved_confidence": "SELECT event_id, round(CASE WHEN event_id % 2 = 0 THEN least(value / 131, CAST(0.75 AS DOUBLE)) ELSE value / 131 * 0.5 END, 4) AS confidence FROM events",
    "seed_codes": f"SELECT o_orderkey, 400 AS item, site AS extracted, site AS resolved FROM ({_CODED}) WHERE site <> '' UNION ALL SELECT o_orderkey, 522, hist, hist FROM ({_CODED}) WHERE hist <> ''",
    "default_fill": "WITH rows AS (SELECT DISTINCT user_id, CAST(CASE event_type WHEN 'click' THEN 10 WHEN 'view' THEN 50 ELSE 400 END AS INT) AS item, event_type AS value FROM events), wanted AS (SELECT DISTINCT user_id, d.item, d.value FROM rows, (VALUES (10, 'A'), (50, '260')) AS d(item, value)) SELECT * FROM rows UNION ALL SELECT * FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM rows r WHERE r.user_id = w.user_id AND r.item = w.item)",
    "dict_lookup_join": "SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey",
    "alt_name_lookup": "SELECT p_partkey, item FROM part JOIN (SELECT lower(p_name) AS k, max(p_partkey) AS item FROM part GROUP BY 1) ON k = lower(p_name)",
    "fuzzy_descriptions": """WITH parts AS (SELECT p_partkey, CAST(substr(p_brand, 7, 1) AS INT) AS item, lower(p_name || ' ' || p_type) AS name FROM part),
vals AS (SELECT DISTINCT item, CASE p_partkey % 5 WHEN 0 THEN name WHEN 1 THEN 'x' || name WHEN 2 THEN left(name, 3) || substr(name, 5) WHEN 3 THEN left(name, length(name) - 2) || 'zz' ELSE reverse(name) END AS k FROM parts),
names AS (SELECT item, name, min(p_partkey) AS pos FROM parts GROUP BY ALL),
pairs AS (SELECT v.item, k, pos, greatest(length(k), length(name)) AS m, levenshtein(k, name) AS e FROM vals v JOIN names n ON n.item = v.item WHERE k <> '')
SELECT item, k, CAST(pos AS VARCHAR) AS code, round(100.0 * (m - e) / m, 4) AS likeness FROM pairs WHERE 100 * e <= 15 * m QUALIFY row_number() OVER (PARTITION BY item, k ORDER BY 100.0 * (m - e) / m DESC, pos) = 1""",
    "code_resolution_tiers": f"""WITH vals AS (SELECT o_orderkey, CAST({pick('o_orderkey', 1, ['400', '410', '522', '764', '410'])} AS INT) AS item, {pick('o_orderkey', 2, ['C504', 'c504', 'left', 'Right ', '8140', 'ADENOCARCINOMA', '7', '12', 'x', '', '8140A', 'adenocarcinom', 'Upper-outr quadrant', 'Lefd'])} AS value FROM orders),
codes(item, code, description, pos) AS (VALUES (400, 'C504', 'Upper-outer quadrant', 0), (410, '1', 'Right', 1), (410, '2', 'Left', 2), (522, '8140', 'Adenocarcinoma', 3), (522, '8140a', 'adenocarcinoma', 4)),
ranges(item, lo, hi, width) AS (VALUES (764, 0, 7, 1), (522, 8000, 9999, 4), (410, 1, 10, 3)), near AS (
  SELECT * FROM (SELECT v.item, k, code, pos, greatest(length(k), length(description)) AS m, levenshtein(k, lower(description)) AS e FROM (SELECT DISTINCT item, lower(trim(value)) AS k FROM vals) v JOIN codes c ON c.item = v.item) WHERE k <> '' AND 100 * e <= 15 * m
), tiers AS (
  SELECT v.*, trim(value) AS g, (SELECT max(code) FROM codes c WHERE c.item = v.item AND c.code = trim(value)) AS exact, (SELECT arg_max(code, pos) FROM codes c WHERE c.item = v.item AND lower(c.code) = lower(trim(value))) AS any_case,
    (SELECT arg_max(code, pos) FROM codes c WHERE c.item = v.item AND lower(c.description) = lower(trim(value))) AS named, (SELECT max(lpad(CAST(CAST(trim(value) AS INT) AS VARCHAR), width, '0')) FROM ranges r WHERE r.item = v.item AND regexp_matches(trim(value), '^[0-9]+$') AND TRY_CAST(trim(value) AS INT) BETWEEN lo AND hi) AS padded,
    (SELECT arg_max(code, (100.0 * (m - e) / m, -pos)) FROM near c WHERE c.item = v.item AND c.k = lower(trim(value))) AS alike, (SELECT max(100.0 * (m - e) / m) FROM near c WHERE c.item = v.item AND c.k = lower(trim(value))) AS likeness FROM vals v)
SELECT o_orderkey, item, value, coalesce(exact, any_case, named, alike, padded, g) AS code, CAST(CASE WHEN exact IS NOT NULL THEN 1 WHEN any_case IS NOT NULL THEN 0.95 WHEN named IS NOT NULL THEN 0.9 WHEN alike IS NOT NULL THEN round(0.9 * likeness / 100, 4) WHEN padded IS NOT NULL THEN 0.85 ELSE 0 END AS DOUBLE) AS resolution FROM tiers""",
    "schema_selection": f"SELECT o_orderkey, {_SCHEMA} AS schema FROM (SELECT *, {_PREFIX} AS p FROM ({_CODED}))",
    "staging_items": f"""WITH s AS (SELECT DISTINCT {_SCHEMA} AS schema FROM (SELECT *, {_PREFIX} AS p FROM ({_CODED}))), own(schema, items) AS (VALUES {", ".join(f"('{k}', {v})" for k, v in SCHEMA_ITEMS.items())}), both_ AS (SELECT s.schema, list_concat({CORE_STAGING_ITEMS}, coalesce(items, [])) AS l FROM s LEFT JOIN own USING (schema)), once AS (SELECT schema, list_filter(l, lambda x, i: list_position(l, x) = i) AS l FROM both_)
SELECT schema, CAST(pos - 1 AS INT) AS pos, CAST(l[pos] AS INT) AS item FROM (SELECT schema, l, unnest(range(1, len(l) + 1)) AS pos FROM once)""",
    "domain_items": "WITH i(phase, items) AS (VALUES " + ", ".join(f"('{k}', {v})" for k, v in DOMAIN_ITEMS.items()) + ") SELECT CAST(c_custkey AS VARCHAR) AS patient_id, phase, CAST(unnest(items) AS INT) AS item FROM customer, i",
    "diagnosis_summary": f"""WITH rec AS ({WIDE}), {_LONG}, w AS (SELECT rec, {", ".join(f"coalesce(nullif(max(resolved) FILTER (item = {i}), ''), max(extracted) FILTER (item = {i}), '') AS r{i}, coalesce(max(extracted) FILTER (item = {i}), '') AS e{i}" for i in (400, 522, 940))} FROM long GROUP BY rec),
k AS (SELECT *, {site_code('r400')} AS code, regexp_extract({strip('r522')}, '([0-9]{{4}})', 1) AS hc FROM w)
SELECT rec, {strip('r400')} AS site_code, coalesce(CASE WHEN lower({strip('r400')}) = 'c504' THEN 'Upper-outer quadrant' END, nullif({_LABEL}, ''), CASE WHEN regexp_matches({strip('e400')}, '(?i)^C?[0-9]{{2,4}}[./]?[0-9]?$') THEN NULL ELSE nullif(e400, '') END, 'site hint') AS site_text,
  {strip('r522')} AS histology_code, coalesce(CASE WHEN r522 = '8140' THEN 'Adenocarcinoma' END, CASE hc WHEN '8140' THEN 'Adenocarcinoma' WHEN '8720' THEN 'Melanoma' END, CASE WHEN regexp_matches({strip('e522')}, '(?i)^C?[0-9]{{2,4}}[./]?[0-9]?$') THEN NULL ELSE nullif(e522, '') END, 'cancer') AS histology_text,
  {strip('r940')} AS clinical_t_code, regexp_replace({strip('r940')}, '(?i)^[cp]([TNM0IVX])', '\\1') AS clinical_t_text FROM k""",
    "diagnosis_summary_stages": f"WITH rec AS ({WIDE}), {_LONG}, w AS (SELECT rec, {_stage_values()} FROM long GROUP BY rec) SELECT rec, {_stage_columns()} FROM w",
    "icd_text_lookup": f"SELECT o_orderkey, {_LABEL} AS label FROM (SELECT o_orderkey, {site_code('site')} AS code FROM ({_CODED}))",
    "valid_codes_prompt": "SELECT n_regionkey AS item, string_agg(n_nationkey || '=' || n_name, '; ' ORDER BY n_nationkey) AS codes_text FROM (SELECT * FROM nation QUALIFY row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) <= 4) GROUP BY 1",
    "prior_state_block": f"""WITH rec AS ({WIDE}), {_LONG}, shown AS (SELECT rec, item, coalesce(nullif(resolved, ''), nullif(extracted, ''), '') AS value, confidence FROM long WHERE confidence > 0)
SELECT r.rec, coalesce('Known so far (change only on better evidence):' || chr(10) || string_agg('- n' || item || ' (item ' || item || '): ' || value || ' (confidence ' || printf('%.2f', confidence) || ')', chr(10) ORDER BY item) FILTER (value <> ''), 'Nothing is known yet: these are the first notes.') AS prior FROM rec r LEFT JOIN shown s USING (rec) GROUP BY 1""",
    "field_instructions": """SELECT n_regionkey, string_agg('"item_' || n_nationkey || '": ' || n_name || ' (item ' || n_nationkey || '). ' || CASE WHEN r_name IS NOT NULL THEN 'Valid codes: ' || r_name WHEN n_nationkey % 2 = 0 THEN 'YYYYMMDD, 99 for an unknown day or month' ELSE 'at most ' || (n_regionkey + 1) || ' characters' END, chr(10) ORDER BY n_nationkey) AS instructions FROM nation LEFT JOIN region ON r_regionkey = n_nationkey GROUP BY 1""",
    "site_normalise": probe(3, SITE_PROBES, f"{_site('x')} AS site, {site3('x')} AS site3, CASE WHEN regexp_matches(upper({strip('x')}), '^C[0-9]{{2}}\\.?[0-9]$') THEN left(upper({strip('x')}), 3) || '.' || right({strip('x')}, 1) ELSE '' END AS topography, CASE WHEN replace(upper({strip('x')}), '.', '') = '' THEN '' WHEN upper({strip('x')}) LIKE 'C%' THEN replace(upper({strip('x')}), '.', '') ELSE 'C' || replace(upper({strip('x')}), '.', '') END AS rule_site, left({digits('x')}, 4) AS histology4, substr({digits('x')}, 5, 1) AS behavior, regexp_extract({strip('x')}, '^([0-9]{{4}})(?:/[0-9])?$', 1) AS morphology"),
    "tnm_normalise": probe(4, TNM_PROBES, f"{tnm('x', 'T')} AS t, {tnm_main(tnm('x', 'T'))} AS t_main, {tnm('x', 'N')} AS n, {unknown('x')} AS unknown"),
    "stage_crosswalk": probe(5, STAGE_PROBES, f"{stage('x')} AS stage, {stage_main('x')} AS main, {extent('x')} AS extent, {summary_extent('x')} AS summary"),
    "biomarker_collapse": probe(6, MARKER_PROBES, f"{marker('x')} AS marker, CASE WHEN lower(x) IN ('left', 'right', 'bilateral', 'not_applicable') THEN lower(x) ELSE 'unknown' END AS laterality"),
    "normalize_summary": f"SELECT conv_id, turn, {strip('text')} AS summary FROM conversations",
    "coded_date_order": f"WITH rec AS ({WIDE}) SELECT rec, CASE WHEN NOT {unknown('v390')} AND NOT {unknown('v1750')} THEN {_NUM('v1750')} - {_NUM('v390')} END AS difference FROM rec",
    "edit_rules_violations": f"{_VIOLATIONS} SELECT * FROM hits",
    "rule_counts": f"{_VIOLATIONS} SELECT edit_name, severity, count(*) AS n, count(DISTINCT rec) AS records FROM hits GROUP BY 1, 2",
    "auto_fix": f"{_VIOLATIONS}, {_LONG} SELECT rec, extracted, CASE WHEN EXISTS (SELECT 1 FROM hits h WHERE h.rec = l.rec AND h.edit_name LIKE '%Tis_Behavior') THEN '2' ELSE resolved END AS resolved FROM long l WHERE item = 523",
    "confidence_score": f"{_SCORES} SELECT rec, item, coalesce(severity, 0) AS severity, final_confidence FROM scores",
    "confidence_of_long_results": f"{_SCORES} SELECT rec, item, coalesce(severity, 0) AS severity, final_confidence FROM scores",
    "review_queue": f"""{_SCORES}, flagged AS (SELECT *, CASE WHEN {_KEY} AND {_C2} < 0.9 THEN 'CRITICAL' WHEN {_NEED} AND {_C2} < 0.7 THEN 'HIGH' WHEN {_C2} < 0.5 THEN 'LOW' WHEN confidence > 0 AND confidence - {_C2} >= (CAST(0.15 AS DOUBLE) - CAST(0.01 AS DOUBLE)) THEN 'MEDIUM' END AS priority FROM scores)
SELECT rec, item, priority, CASE priority WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END AS priority_rank, final_confidence FROM flagged WHERE priority IS NOT NULL""",
    "review_queue_violation_mode": f"{_SCORES} SELECT rec, item, priority FROM (SELECT rec, item, CASE WHEN {_KEY} AND {_C2} < 0.9 THEN 'CRITICAL' WHEN {_NEED} AND {_C2} < 0.7 THEN 'HIGH' WHEN severity IS NOT NULL THEN 'MEDIUM' WHEN {_C2} < 0.5 THEN 'LOW' END AS priority FROM scores) WHERE priority IS NOT NULL",
    "worst_severity": f"{_SCORES} SELECT rec, item, severity FROM worst",
    "eav_pivot_wide": "WITH v AS (SELECT user_id, length(event_type) * 100 AS item, arg_max(event_type, event_id) AS value FROM events GROUP BY ALL) SELECT user_id, " + ", ".join(f"coalesce(max(value) FILTER (item = {i}), '') AS \"{n} [{i}]\"" for i, n in ((400, "Four"), (500, "Five"), (600, "Item 600"), (800, "Item 800"))) + " FROM v GROUP BY 1",
    "flat_fixed_width": "WITH v AS (SELECT user_id, length(event_type) * 100 AS item, arg_max(event_type, event_id) AS value FROM events GROUP BY ALL) SELECT user_id, " + " || ".join(f"rpad(left(coalesce(max(value) FILTER (item = {i}), ''), {n}), {n}, ' ')" for i, n in ((400, 3), (500, 7), (600, 2), (800, 1))) + " AS line FROM v GROUP BY 1",
    "keyword_score_topk": f"""WITH q AS (SELECT conv_id * 1000 + turn AS query_id, list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda w: NOT list_contains(['a','an','and','at','by','cancer','carcinoma','for','from','histology','in','malignant','neoplasm','of','primary','schema','site','the','to','tumor','tumour','unknown','with'], w) AND (length(w) >= 3 OR w LIKE 'c%')) AS ws FROM conversations),
k AS (SELECT query_id, list_filter(ws, lambda w, i: list_position(ws, w) = i) AS words FROM q),
m AS (SELECT {pick('item_id', 9, ['appendix_c', 'staging', 'solid_tumor_rules', 'hematopoietic', 'other'])} AS category, 't' || lpad(CAST(item_id AS VARCHAR), 9, '0') AS title, 'manual' AS source, lower(text) AS body FROM benchmark),
s AS (SELECT query_id, title, category, list_sum(list_transform(words, lambda w: 8 * CAST(contains(lower(title || ' ' || source || ' ' || category), w) AS INT) + CAST(contains(body, w) AS INT))) AS base FROM k, m WHERE len(words) > 0),
t AS (SELECT *, CAST(base + CASE WHEN category = 'appendix_c' THEN 6 WHEN category = 'staging' THEN 3 WHEN category = 'solid_tumor_rules' AND base > 0 THEN 2 ELSE 0 END AS INT) AS score FROM s)
SELECT query_id, title, score, CAST(place AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, CASE category WHEN 'appendix_c' THEN 0 WHEN 'solid_tumor_rules' THEN 1 WHEN 'hematopoietic' THEN 1 WHEN 'staging' THEN 2 ELSE 9 END, lower(title)) AS place FROM t WHERE score > 0) WHERE place <= 8""",
    "greedy_match": f"{_GREEDY} SELECT mrn, CAST(ti AS INT) AS ti, CAST(pi AS INT) AS pi, site_match, CAST(days AS INT) AS days FROM taken",
    "match_acceptance": f"{_GREEDY} SELECT mrn, CAST(ti AS INT) AS ti, matched, CAST(gap AS INT) AS days FROM joined",
    "diagnosis_flags": f"{_SCORED} SELECT mrn, CAST(ti AS INT) AS ti, present_site, ok_site3, ok_hist4, ok_ajcc_main, ok_t_main, ok_date365, ok_year, present_er, ok_er, ok_stage_axis FROM scored",
    "field_metrics": f"{_SCORED} " + " UNION ALL ".join(_metric(*m) for m in _METRICS),
    "match_recall": f"{_GREEDY} SELECT count(*) AS n_truth_diagnoses, count(DISTINCT mrn) AS n_patients, round(avg(CAST(matched AS DOUBLE)), 4) AS diagnosis_match_recall, count(*) FILTER (matched) AS n_matched, (SELECT count(*) FROM predicted p WHERE EXISTS (SELECT 1 FROM truth t WHERE t.mrn = p.mrn) AND NOT EXISTS (SELECT 1 FROM taken g WHERE g.mrn = p.mrn AND g.pi = p.pi)) AS n_extra_predicted_tumors FROM joined",
    "registry_filter": f"SELECT o_orderkey FROM (SELECT *, {pick('o_orderkey', 8, ['Y', 'n ', 'N', '', 'y'])} AS best FROM orders) WHERE year(o_orderdate) BETWEEN 1996 AND 1999 AND o_orderstatus IN ('F', 'O') AND upper(trim(best)) <> 'N'",
    "semi_anti_patients": "SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 'with' ELSE 'without' END AS kind FROM customer",
    "docs_per_patient_stats": "SELECT count(*) AS n_keys, min(n) AS least, median(n) AS middle, max(n) AS most, round(avg(n), 4) AS mean FROM (SELECT count(*) AS n FROM documents GROUP BY source)",
    "value_counts_top10": "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10",
    "union_sources": "SELECT source, count(*) AS rows, CAST(sum(n) AS BIGINT) AS chars FROM (SELECT 'documents' AS source, length(text) AS n FROM documents UNION ALL SELECT 'pages', length(html) FROM pages UNION ALL SELECT 'conversations', length(text) FROM conversations) GROUP BY 1",
    "manifest_upsert": """WITH e AS (SELECT page_id AS pos, regexp_extract(url, '://([^/?#]*)', 1) AS url, regexp_extract(html, '<html lang="([a-z]*)"', 1) AS category, CASE WHEN page_id % 2 = 0 THEN 'p' || page_id ELSE '' END AS title, 's' || (page_id % 5) AS source_page FROM pages), p AS (SELECT url, source_page, min(pos) AS pos FROM e GROUP BY 1, 2)
SELECT e.url, arg_min(category, pos) AS category, coalesce(nullif(arg_min(title, pos), ''), e.url) AS title, (SELECT string_agg(source_page, ',' ORDER BY p.pos) FROM p WHERE p.url = e.url) AS source_pages FROM e GROUP BY e.url""",
    "run_summary": "SELECT count(*) AS records, count(DISTINCT o_custkey) AS patients, round(count(*) / count(DISTINCT o_custkey), 4) AS per_patient FROM orders",
    "link_harvest": r"""SELECT page_id, CAST(k - 1 AS INT) AS place, CASE WHEN target LIKE '/%' THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || target ELSE target END AS url, text FROM (
SELECT page_id, url, unnest(generate_series(1, len(t))) AS k, unnest(t) AS target, trim(regexp_replace(unnest(x), '\\s+', ' ', 'g')) AS text FROM (
SELECT page_id, url, regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 1) AS t, regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>', 2) AS x FROM pages))""",
    "reference_resolution": f"""SELECT page_id, CASE WHEN r = '/x/y' THEN root || r WHEN r = '../x' THEN root || CASE WHEN regexp_matches(path, '^/[^/]*/[^/]+/') THEN regexp_extract(path, '^(/.*/)[^/]*/[^/]*$', 1) ELSE '/' END || 'x' WHEN r = './y' THEN root || dir || 'y' WHEN r = 'a/../b' THEN root || dir || 'b' WHEN r = 'z' THEN root || dir || 'z'
WHEN r LIKE '?%' THEN root || path || r WHEN r LIKE '#%' THEN regexp_replace(url, '#.*$', '') || r WHEN r LIKE '//%' THEN regexp_extract(url, '^[a-z]+:') || r ELSE r END AS resolved FROM (
SELECT *, regexp_extract(path, '^(.*/)[^/]*$', 1) AS dir FROM (SELECT page_id, url, {pick('page_id', 17, REFERENCES)} AS r, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS root, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages))""",
    "url_normalise": r"""SELECT page_id, root || replace(replace(replace(url_encode(url_decode(replace(path, '+', '%2B'))), '%2F', '/'), '%3A', ':'), '%40', '@') || rest AS url, CASE WHEN path LIKE '%.PDF' THEN '.pdf' ELSE coalesce(nullif(lower(regexp_extract(path, '/[^/.][^/]*(\\.[^./]+)$', 1)), ''), '.html') END AS extension,
CASE WHEN name = '' THEN 'manual.html' ELSE regexp_replace(name, '[^A-Za-z0-9._-]+', '_', 'g') END AS file_name FROM (
SELECT *, regexp_extract(u, '^[a-z]+://[^/?#]*', 0) AS root, regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(u, '^[^?#]*(.*)$', 1) AS rest, regexp_extract(regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)/*$', 1) AS name FROM (
SELECT page_id, replace(url, '.example.', '.Example.') || CASE WHEN regexp_matches(url, '[?#]') THEN '' ELSE '/a é%20%7E+(' || page_id || ').PDF' END AS u FROM pages))""",
    "pending_rows": "SELECT conv_id * 1000 + turn AS row_index FROM conversations WHERE NOT ((conv_id * 1000 + turn) % 3 = 0 AND (conv_id * 1000 + turn) % 2 = 0)",
    "compress_fingerprint": """SELECT conv_id * 1000 + turn AS row_index, sha256('{"row":' || (conv_id * 1000 + turn) || ',"patient":"' || conv_id || '","date":"' || turn || '","document":"","text":"' || sha256(coalesce(text, '')) || '"}') AS fingerprint FROM conversations""",
    "compress_with_fallback": f"""SELECT conv_id * 1000 + turn AS row_index, CASE WHEN length(coalesce(text, '')) % 7 = 0 THEN text ELSE {strip("left(text, 40)")} END AS output_text, length(coalesce(text, '')) % 7 = 0 AS used_fallback, CASE WHEN length(coalesce(text, '')) % 7 = 0 THEN 'RuntimeError: endpoint unavailable' END AS error FROM conversations""",
    "audit_rows": f"WITH rec AS ({WIDE}), {_LONG} SELECT rec, item, extracted, resolved, sha256(left(rec || repeat('e', 600), 500)) AS evidence FROM long",
    "xml_roundtrip": f"""WITH rec AS ({WIDE}), {_LONG}, v AS (SELECT rec // 10 AS patient, rec % 10 AS tumor, item, resolved AS value FROM long WHERE item IN (220, 400, 522) AND resolved <> ''), firsts AS (SELECT o_orderkey // 10 AS patient, min(o_orderkey % 10) AS tumor FROM orders GROUP BY 1)
SELECT patient, item, value, count(*) AS n FROM v WHERE item <> 220 OR EXISTS (SELECT 1 FROM firsts f WHERE f.patient = v.patient AND f.tumor = v.tumor) GROUP BY 1, 2, 3""",
    "eav_pivot_rules": f"WITH src AS ({WIDE}), rec0 AS (SELECT * FROM src), {_LONG.replace('UNPIVOT rec ON', 'UNPIVOT rec0 ON')}, rec AS (SELECT rec, " + ", ".join(f"max(coalesce(nullif(resolved, ''), nullif(extracted, ''), '')) FILTER (item = {i}) AS v{i}" for i in VALUES) + f" FROM long GROUP BY rec), {_BASE}, hits AS ({_HITS}) SELECT rec, seq, edit_name FROM hits",
}
ORACLES["window_overlap_bins"] = ORACLES["window_overlap_join"]
ORACLES["tumor_stream"] = ORACLES["tumor_fold"]
ORACLES["text_normalisers"] = rf"""SELECT conv_id, turn, regexp_replace(regexp_replace(x, '\s+', ' ', 'g'), '^[ *]+|[ *]+$', '', 'g') AS one_line,
regexp_replace(regexp_replace(regexp_replace(x, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS manual,
CASE WHEN s[1] IN ('c', 'p', 'P') AND upper(s[2]) IN ('T', 'N', 'M', '0', 'I', 'V', 'X') THEN s[2:] ELSE s END AS stage
FROM (SELECT *, ' *  ' || text || chr(9) || ' ' || repeat(chr(10), 4) || ' x * ' AS x, {pick('turn', 21, ['c', 'p', 'P', '', 'yp'])} || {pick('conv_id', 22, ['T1', 'N0', 'IIA', 'M1', 'X', 'other'])} AS s FROM conversations WHERE text IS NOT NULL)"""
ORACLES["compression_prompts"] = """SELECT conv_id, turn, CASE WHEN turn % 2 = 0 AND trim(coalesce(role, '')) <> '' THEN 'Document Type: ' || trim(role) || chr(10) ELSE '' END || 'Note Date: 2024-' || turn || chr(10) || chr(10) || 'Note:' || chr(10) || coalesce(text, '') AS prompt FROM conversations"""
ORACLES["compression_outcome"] = f"""SELECT count(*) AS rows, count(error) AS errors, count(*) FILTER (used_fallback) AS fallbacks FROM ({ORACLES["compress_with_fallback"]})"""
ORACLES["prior_state_blocks"] = f"""WITH rec AS ({WIDE}), {_LONG}, shown AS (SELECT rec, item, coalesce(nullif(resolved, ''), nullif(extracted, ''), '') AS v, confidence FROM long WHERE item IN (220, 400, 522, 880, 1290) AND confidence > 0),
known AS (SELECT rec, 'Known so far (change only on better evidence):' || chr(10) || string_agg(printf('- n%d (item %d): %s (confidence %.2f)', item, item, v, confidence), chr(10) ORDER BY item) AS prior FROM shown WHERE v <> '' GROUP BY rec)
SELECT o_orderkey AS rec, coalesce(prior, 'Nothing is known yet: these are the first notes.') AS prior FROM orders LEFT JOIN known ON rec = o_orderkey"""
