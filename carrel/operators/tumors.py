"""Tumor detection: a running list folded over a patient's chunks in order."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrel.functions.scalars import morphology, sided_site, text, topography
from carrel.operators.models import Client, answered, called_object, in_flight, request_id

FIELDS = ["cancer_type", "primary_site_hint", "approximate_date", "evidence", "histology", "laterality"]
SCHEMA = "patient_id string, tumor_index int, cancer_type string, primary_site_hint string, approximate_date string, evidence string, histology string, laterality string, contributing_chunks string"
SYSTEM = "Keep a running list of the distinct primary tumors in the notes. Answer with a JSON object: {\"diagnoses\": [...]}."


def _clean(found: list) -> list[dict]:
    rows = [{f: str(x.get(f) or "").strip() for f in FIELDS} for x in found if isinstance(x, dict)]
    for row in rows:
        row["evidence"] = row["evidence"][:300]
    return rows


@dataclass
class Listing:
    """A patient's running list, and the chunks that contributed to each entry."""

    running: list[dict] = field(default_factory=list)
    origin: dict[str, list[str]] = field(default_factory=dict)

    def take(self, chunk_id: str, body: str, client: Client, attempts: int) -> None:
        """The list after one more chunk; an answer that can't be read leaves it as it was."""
        prompt = f"Current list: {self.running}\n\nNotes:\n{body}"
        try:
            found = called_object(client, SYSTEM, prompt, attempts).get("diagnoses")
        except Exception:  # noqa: BLE001
            return
        self.running = _clean(found) if isinstance(found, list) else self.running
        for row in self.running:
            own = self.origin.setdefault(self.name(row), [])
            if chunk_id not in own:
                own.append(chunk_id)

    @staticmethod
    def name(row: dict) -> str:
        return f"{row['cancer_type']}|{row['primary_site_hint']}"

    def rows(self, patient: str) -> list[tuple]:
        """Rows of SCHEMA; one unknown tumor for an empty list."""
        shown = self.running or [dict.fromkeys(FIELDS, "") | {"cancer_type": "unknown", "laterality": "unknown"}]
        return [(patient, k, *(r[f] for f in FIELDS), ",".join(self.origin.get(self.name(r), []))) for k, r in enumerate(shown)]


COLUMNS = ["patient_id", "tumor_index", *FIELDS, "contributing_chunks"]
#: patients whose chunks a task folds side by side
PATIENTS_IN_FLIGHT = 16


def by_patient(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """Each patient's (chunk_id, text) in order, from frames sorted by patient; a patient may span frames."""
    patient, held = None, []
    for frame in frames:
        for who, chunk_id, body in zip(frame["patient_id"], frame["chunk_id"], frame["chunk_text"], strict=True):
            if held and who != patient:
                yield patient, held
                held = []
            patient = who
            held.append((chunk_id, body))
    if held:
        yield patient, held


def detected(chunks: DataFrame, client: Client, attempts: int = 1, width: int = PATIENTS_IN_FLIGHT) -> DataFrame:
    """One row for each tumor of each patient; a patient without any gets one unknown tumor.

    State N depends on state N-1, so the chunks of one patient are folded in order; several patients of a
    task are in flight at a time. A chunk whose answer can't be read leaves the list as it was.
    """

    def fold(patient: tuple[str, list[tuple[str, str]]]) -> list[tuple]:
        listing = Listing()
        for chunk_id, body in patient[1]:
            listing.take(chunk_id, body, client, attempts)
        return listing.rows(patient[0])

    def folded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in in_flight(by_patient(frames), fold, width):
            yield pd.DataFrame(rows, columns=COLUMNS)

    sorted_ = chunks.select("patient_id", "chunk_id", "chunk_index", "chunk_text").repartition("patient_id").sortWithinPartitions("patient_id", "chunk_index")
    return sorted_.mapInPandas(folded, SCHEMA)


CODING_SYSTEM = "Give each numbered diagnosis its topography and morphology code. Answer with a JSON object: {\"coded\": [{\"primary_site_code\": ..., \"histology_code\": ...}]}, one entry for each diagnosis, in order."
_CODED = "struct<coded:array<struct<primary_site_code:string,histology_code:string>>>"


def coded(found: DataFrame, client: Client, attempts: int = 1, ask: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``found`` (the rows of detected()) with primary_site_code and histology_code, from one call a patient, and sides in site hints.

    The answers' entries belong to the diagnoses by their place. A missing or unreadable entry, a
    code of no valid shape and a failed call leave '' there. Patients whose only row is the unknown
    tumor are not asked. ``ask`` turns requests into answers in another way (stored ones, say).
    """
    line = F.format_string("%d. %s; site %s; histology %s; laterality %s", F.col("tumor_index") + 1, "cancer_type", "primary_site_hint", "histology", "laterality")
    known = found.where("not (cancer_type = 'unknown' and primary_site_hint = '' and contributing_chunks = '')")
    lists = known.groupBy("patient_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tumor_index", line.alias("line")))), lambda x: x["line"]), "\n").alias("prompt"))
    asked = lists.select("patient_id", F.lit(CODING_SYSTEM).alias("system"), F.concat(F.lit("Diagnoses:\n"), "prompt").alias("prompt"))
    asked = asked.withColumn("request_id", request_id())
    requests = asked.select("system", "prompt")
    answers = (ask(requests) if ask else answered(requests, client, attempts=attempts, objects=True)).where("error is null").select("request_id", F.from_json("response", _CODED)["coded"].alias("coded"))
    entries = asked.select("patient_id", "request_id").join(answers, "request_id").select("patient_id", F.posexplode("coded").alias("tumor_index", "entry"))
    entries = entries.select("patient_id", "tumor_index", topography(text(F.col("entry.primary_site_code"))).alias("primary_site_code"), morphology(text(F.col("entry.histology_code"))).alias("histology_code"))
    sided = found.withColumn("primary_site_hint", sided_site(F.col("primary_site_hint"), F.col("laterality")))
    return sided.join(entries, ["patient_id", "tumor_index"], "left").na.fill("", ["primary_site_code", "histology_code"])
