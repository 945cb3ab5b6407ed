"""Durable answers: a Python data source whose writer asks a model and stores every answer as it comes.

The writer's task calls the model for its rows and stores finished answers in small segment files, every
``flush_rows`` answers or ``flush_seconds`` seconds, each put in place by one move. A segment is named by a hash of its requests,
so the same answers have one name. Nothing is taken back when a task or the job fails: a segment holds
finished answers, whoever asks next. A repeated task looks at the segments its earlier attempts left
and asks for the rest; a resumed run leaves out all finished requests before it starts.

The folder is shared by all executors: a path or an address that pyarrow's file systems know.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from hashlib import sha256

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from carrel.operators import models

FORMAT = "carrel_answers"
FLUSH_ROWS, FLUSH_SECONDS = 20, 30.0
STORED = f"{models.ANSWER}, asked_at double"


def store_of(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder:
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), folder.removeprefix("file:")


class Segments:
    """Answers of one task, stored in files of a folder."""

    def __init__(self, folder: str, flush_rows: int = FLUSH_ROWS, flush_seconds: float = FLUSH_SECONDS):
        self.store, self.path = store_of(folder)
        self.store.create_dir(self.path, recursive=True)
        self.flush_rows, self.flush_seconds = flush_rows, flush_seconds
        self.held: list[dict] = []
        self.since = time.monotonic()

    def add(self, row: tuple) -> None:
        key, response, error, log = row
        self.held.append({"request_id": key, "response": response, "error": error, "log": dict(zip(("attempts", "seconds", "raw_output", "reasoning", "usage"), log, strict=True)), "asked_at": time.time()})
        if len(self.held) >= self.flush_rows or time.monotonic() - self.since >= self.flush_seconds:
            self.flush()

    def flush(self) -> None:
        if self.held:
            name = sha256("".join(sorted(r["request_id"] for r in self.held)).encode()).hexdigest()[:32]
            hidden = f"{self.path}/_{name}-{uuid.uuid4().hex}"
            with self.store.open_output_stream(hidden) as out:
                out.write("".join(json.dumps(r, ensure_ascii=False) + "\n" for r in self.held).encode())
            self.store.move(hidden, f"{self.path}/answers-{name}.json")
        self.held, self.since = [], time.monotonic()

    def finished(self) -> set[str]:
        """The requests with an answer without error in the folder."""
        done = set()
        for file in self.store.get_file_info(fs.FileSelector(self.path)):
            if file.base_name.startswith("answers-"):
                with self.store.open_input_stream(file.path) as rows:
                    done |= {r["request_id"] for r in map(json.loads, rows.read().decode().splitlines()) if r["error"] is None}
        return done


def answer_source(client: models.Client, attempts: int = models.ATTEMPTS, objects: bool = False, width: int = models.IN_FLIGHT, per_second: float | None = None, parser: str | None = None, flush_rows: int = FLUSH_ROWS, flush_seconds: float = FLUSH_SECONDS) -> type[DataSource]:
    """A data source for one client; rows written to it (request_id, system, prompt) are asked and stored."""

    class Writer(DataSourceWriter):
        def __init__(self, folder: str):
            self.folder = folder

        def write(self, iterator: Iterator) -> WriterCommitMessage:
            from pyspark import TaskContext

            context = TaskContext.get()
            part = f"{self.folder}/part={context.partitionId() if context else 0}"
            segments = Segments(part, flush_rows, flush_seconds)
            done = segments.finished()
            limiter = models.Limiter(per_second)

            def one(row) -> tuple:
                return models.answer_row(row["request_id"], models.converse(client, row["system"], row["prompt"], attempts, models.as_object if objects else None, parser, limiter), objects)

            try:
                for answer in models.in_flight((r for r in iterator if r["request_id"] not in done), one, width, ordered=False):
                    segments.add(answer)
            finally:
                segments.flush()
            return WriterCommitMessage()

        def commit(self, messages: list) -> None:
            pass

        def abort(self, messages: list) -> None:
            pass

    class Answers(DataSource):
        @classmethod
        def name(cls) -> str:
            return FORMAT

        def schema(self) -> str:
            return "request_id string, system string, prompt string"

        def writer(self, schema, overwrite: bool) -> DataSourceWriter:
            return Writer(self.options["folder"])

    return Answers


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """The best answer to each request so far: one without error before one with, the latest of equals."""
    try:
        rows = spark.read.schema(STORED).option("recursiveFileLookup", "true").json(folder)
    except Exception as e:  # noqa: BLE001  no run has stored anything yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], STORED)
    best = F.max_by(F.struct("response", "error", "log", "asked_at"), F.struct(F.col("error").isNull(), "asked_at"))
    return rows.groupBy("request_id").agg(best.alias("best")).select("request_id", "best.*")


def answered_durably(requests: DataFrame, client: models.Client, folder: str, **options) -> DataFrame:
    """request_id, response, error, log, asked_at of every distinct (system, prompt), asked where no run has an answer."""
    spark = requests.sparkSession
    open_ = models.requested(requests).join(stored(spark, folder).where("error is null").select("request_id"), "request_id", "left_anti")
    spark.dataSource.register(answer_source(client, **options))
    open_.write.format(FORMAT).mode("append").option("folder", folder).save()
    return stored(spark, folder).join(models.requested(requests).select("request_id"), "request_id", "left_semi")
