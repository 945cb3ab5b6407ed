"""Coded records made from the order table, so that every rule meets hits and misses.

Spark and the SQL it is held against share these expressions; they only make data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Invented values for each item: plausible, blank, unknown and contradictory ones.
VALUES = {
    220: ["1", "2", "9", "", "3", "F", "2"],
    230: ["5", "12", "14", "17", "19", "25", "63", "999", "", "x", "071"],
    390: ["20200115", "2021", "202106", "99999999", "", "20190704"],
    400: ["C504", "C61.9", "C539", "c349", "C220", "C649", "C421", "619", "", "C445", "C384", "C18.0", "C700"],
    410: ["0", "1", "2", "", "9", "4"],
    441: ["1", "9", "", "2", "3"],
    490: ["1", "2", "6", "7", "9", "", "5", "x"],
    522: ["8170", "8312/3", "8720", "9050", "9800", "9590", "8140", "9510", "9500", "8960", "", "9999", "85003"],
    523: ["0", "1", "2", "3", "", "9"],
    754: ["025", "999", "", "011"],
    764: ["0", "1", "7", "7", "9", ""],
    834: ["00", "02", "99", "", "5", "x"],
    880: ["T1", "TIS", "", "88", "0", "is"],
    890: ["N0", "N1", "", "88", "X", "1"],
    900: ["M0", "", "99", "1"],
    910: ["1", "2A", "", "99", "88"],
    940: ["cT0", "T0", "Tis", "", "2", "c0"],
    950: ["N1", "0", "NX", "", "88", "2"],
    960: ["M0", "", "88", "1"],
    970: ["1", "", "99", "3"],
    1112: ["0", "1", "9", ""], 1113: ["0", "9", "0"], 1114: ["0", "1", "0", "0", "0"], 1115: ["0", "9", "", "0", "0"], 1116: ["0", "1", "0", "0", "9", "0", "0"], 1117: ["0", "9"],
    1200: ["20200101", "20210301", "", "99999999"],
    1210: ["2019", "20220101", ""], 1220: ["20180101", "", "20211231"], 1230: ["", "2020"], 1240: ["201912", "", "20240101"],
    1290: ["00", "20", "30", "99", "", "0", "98"], 1291: ["", "A200", "0000"],
    1292: ["0", "2", "", "9"], 1320: ["0", "9", "", "1"], 1340: ["1", "", "9"],
    1360: ["0", "1", "2", "7", "", "9"], 1390: ["00", "01", "03", "82", "88", "", "99"],
    1430: ["0", "", "9"], 1570: ["20", "99", "", "31"],
    1750: ["20180101", "20230101", "", "99999999"], 1760: ["0", "1", ""], 1910: ["C509", "", "9999"], 2640: ["CISPLATIN", "", "9"],
}


def pick(key: str, salt: int, values: list[str]) -> str:
    cases = " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(values))
    return f"CASE mod(mod({key} * {7 * salt + 31}, 9973), {len(values)}) {cases} END"


def picked(key: str, salt: int, values: list[str]) -> Column:
    """pick() as a look-up in a literal array: its code stays small where a row has dozens of them."""
    return F.get(F.array(*(F.lit(x) for x in values)), F.expr(f"cast(mod(mod({key} * {7 * salt + 31}, 9973), {len(values)}) AS int)"))


def record_columns(key: str = "o_orderkey") -> str:
    return ", ".join(f"{pick(key, item, values)} AS v{item}" for item, values in VALUES.items())


WIDE = f"SELECT o_orderkey AS rec, {record_columns()} FROM orders"


def long_expressions() -> tuple[str, str, str]:
    """extracted, resolved and confidence of a result, from rec, item and value."""
    extracted = "CASE WHEN mod(rec + item, 11) = 0 THEN concat('x', value) ELSE value END"
    resolved = "CASE WHEN mod(rec + item, 13) = 0 THEN '' ELSE value END"
    return extracted, resolved, "mod(rec * 7 + item, 101) / 100.0"
