"""Model calls: order and speed of concurrent ones, rate limits, retries, reasoning, the log, and answers that outlive a killed run."""

import json
import os
import threading
import time
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from carrel.functions import reasoning
from carrel.operators import models
from carrel.plans import pipeline
from carrel.sources import answers


def test_results_come_in_order_and_a_bounded_number_is_held():
    running, most, pulled, lock = 0, 0, 0, threading.Lock()

    def items():
        nonlocal pulled
        for k in range(60):
            pulled += 1
            yield k

    def work(k):
        nonlocal running, most
        with lock:
            running += 1
            most = max(most, running)
        time.sleep(0.03 if k % 7 == 0 else 0.005)
        with lock:
            running -= 1
        return k * k

    out = []
    for value in models.in_flight(items(), work, 8):
        out.append(value)
        assert pulled - len(out) <= 16
    assert out == [k * k for k in range(60)] and 4 <= most <= 8
    assert sorted(models.in_flight(iter(range(60)), work, 8, ordered=False)) == out
    with pytest.raises(ZeroDivisionError):
        list(models.in_flight(iter([1, 0, 2]), lambda k: 1 // k, 2))
    assert list(models.in_flight(iter([]), work, 3)) == []


def test_slow_calls_overlap(spark):
    def slow(_, prompt):
        time.sleep(0.2)
        return prompt[::-1]

    asked = spark.range(48).select(F.lit("s").alias("system"), F.col("id").cast("string").alias("prompt")).coalesce(1)

    def timed(width):
        began = time.time()
        rows = {r["request_id"]: r["response"] for r in models.answered(asked, models.EchoClient(slow), width=width).coalesce(1).collect()}
        return time.time() - began, rows

    timed(16)
    one, rows_of_one = timed(2)
    many, rows_of_many = timed(16)
    assert rows_of_one == rows_of_many and len(rows_of_many) == 48
    assert many < one / 2


def test_one_limit_for_all_calls_and_a_pause_for_everyone():
    now, lock = [0.0], threading.Lock()

    def sleep(seconds):
        with lock:
            now[0] += seconds

    limiter = models.Limiter(per_second=2, clock=lambda: now[0], sleep=sleep)
    starts = []
    for _ in range(5):
        limiter.enter()
        starts.append(now[0])
    assert starts == [0, 0.5, 1.0, 1.5, 2.0]
    limiter.pause(30)
    limiter.enter()
    assert now[0] >= 32


def test_retry_after_in_seconds_and_as_a_date():
    at = datetime(2030, 1, 1, 12, 0, 0, tzinfo=UTC)
    assert models.retry_after("7") == 7 and models.retry_after(3.5) == 3.5 and models.retry_after("-2") == 0
    assert models.retry_after("Tue, 01 Jan 2030 12:00:45 GMT", at) == 45
    assert models.retry_after("Tue, 01 Jan 2030 11:00:00 GMT", at) == 0
    assert [models.retry_after(x) for x in ("soon", "", None)] == [None] * 3
    assert models.Retryable("busy", "9").after == 9


def test_rejected_credentials_are_refreshed_once():
    class Guarded:
        fresh = refreshes = 0

        def generate(self, system, prompt):
            if self.refreshes < self.fresh:
                raise models.Unauthorized("401")
            return "ok"

        def refresh(self):
            self.refreshes += 1
            return True

    one, two = Guarded(), Guarded()
    one.fresh, two.fresh = 1, 2
    assert models.called(one, "s", "p") == "ok" and one.refreshes == 1
    with pytest.raises(models.Unauthorized):
        models.called(two, "s", "p")
    with pytest.raises(models.Unauthorized):
        models.called(models.EchoClient(lambda s, p: (_ for _ in ()).throw(models.Unauthorized("403"))), "s", "p")


CASES = [
    ("qwen3", " <think>a b</think> c ", ("a b", "c")),
    ("qwen3", "a</think>c", ("a", "c")),
    ("qwen3", "plain", ("", "plain")),
    ("qwen3", "<think>x<tool_call>{}", ("x", "<tool_call>{}")),
    ("qwen3", "<think>open", ("open", "")),
    ("gemma4", "<|channel>thought\nabc<channel|>done", ("abc", "done")),
    ("openai_gptoss", "<|channel|>analysis<|message|>why<|end|><|start|>assistant<|channel|>final<|message|>so<|return|>", ("why", "so")),
    ("openai_gptoss", "<|channel|>final<|message|>so", ("", "so")),
    (None, "<think>a</think>b", ("", "<think>a</think>b")),
    ("other", " t ", ("", "t")),
    ("qwen3", None, ("", "")),
]


def test_reasoning_by_column_and_by_worker(spark):
    got = spark.createDataFrame([(k, p, t) for k, (p, t, _) in enumerate(CASES)], "k int, p string, t string").select("k", reasoning.split_text(F.col("t"), F.col("p")).alias("s")).orderBy("k").collect()
    for row, (parser, text, want) in zip(got, CASES, strict=True):
        assert tuple(row["s"]) == want == reasoning.split_reply(text or "", parser)


def test_parser_of_a_model():
    assert [reasoning.parser_of(m) for m in ("openai/gpt-oss-120b", "Qwen/Qwen3.6-72B", "gemma-4-27b", "llama", "")] == ["openai_gptoss", "qwen3", "gemma4", None, None]
    assert [reasoning.parser_of("qwen3", c) for c in ("none", " OFF ", None, "", "GPT-OSS", "qwen-3", "other parser", "Auto")] == [None, None, None, None, "openai_gptoss", "qwen3", "other_parser", "qwen3"]


def test_objects_in_fences():
    assert models.as_object('```\n{"a": 1}```') == {"a": 1} == models.as_object(' ```json {"a": 1} ``` ')
    for bad in ('```json\n{"a": 1}', 'x ```{"a": 1}```'):
        with pytest.raises(ValueError):
            models.as_object(bad)


def test_the_log_comes_with_the_answers(spark, tmp_path):
    def answer(system, prompt):
        (tmp_path / f"{time.time_ns()}").write_text(prompt)
        if prompt.startswith("bad") and "The last answer" not in prompt:
            return models.Reply("none", usage={"tokens": 3})
        return models.Reply('{"a": "é"}', "because", {"tokens": 3})

    asked = spark.createDataFrame([("s", "bad", 1), ("s", "good", 2)], "system string, prompt string, chunk int")
    found = models.answered(asked.select("system", "prompt"), models.EchoClient(answer), objects=True)
    found.write.parquet(f"{tmp_path}/answers")
    calls = len([f for f in tmp_path.iterdir() if f.is_file()])
    stored = spark.read.parquet(f"{tmp_path}/answers")
    log = {r["prompt"]: r for r in models.call_log(stored, asked).collect()}
    assert calls == 3 == len([f for f in tmp_path.iterdir() if f.is_file()])
    assert (log["bad"]["attempts"], log["bad"]["usage"], log["good"]["attempts"], log["good"]["usage"]) == (2, {"tokens": 6}, 1, {"tokens": 3})
    assert log["good"]["reasoning"] == "because" and json.loads(log["good"]["final_output"]) == {"a": "é"} and log["good"]["raw_output"] == '{"a": "é"}' and log["bad"]["chunk"] == 1


def dying(at, dies):
    """A client that kills its worker at the given call; every call leaves a file. (The class goes along by value.)"""

    class Dying:
        def generate(self, system, prompt):
            os.makedirs(at, exist_ok=True)
            before = len(os.listdir(at))
            with open(f"{at}/{time.time_ns()}-{prompt}", "w"):
                pass
            if dies is not None and before >= dies:
                time.sleep(0.5)
                os._exit(1)
            return f"answer to {prompt}"

    return Dying()


def test_a_killed_run_asks_for_open_requests_only(spark, tmp_path):
    asked = spark.range(60).select(F.lit("s").alias("system"), F.col("id").cast("string").alias("prompt")).coalesce(1)
    run = lambda name, dies: answers.answered_durably(asked, dying(f"{tmp_path}/{name}", dies), f"{tmp_path}/store", width=2, flush_rows=3)
    with pytest.raises(Exception, match="(?i)worker|exit|crash"):
        run("first", 20).count()
    kept = answers.stored(spark, f"{tmp_path}/store").count()
    assert 12 <= kept <= 21
    rows = run("second", None).collect()
    assert sorted(int(r["response"].removeprefix("answer to ")) for r in rows) == list(range(60))
    assert len(os.listdir(tmp_path / "second")) == 60 - kept
    assert run("third", None).count() == 60 and not (tmp_path / "third").exists()
    assert not [f for f in (tmp_path / "store").rglob("*") if f.name.startswith("_")]


def test_a_repeated_task_skips_what_it_stored(tmp_path):
    segments = answers.Segments(f"{tmp_path}/part=0", flush_rows=2)
    for k in range(5):
        segments.add((f"r{k}", "x", None if k != 1 else "Error", (1, 0.1, "x", "", {})))
    assert segments.finished() == {"r0", "r2", "r3"}
    segments.flush()
    assert answers.Segments(f"{tmp_path}/part=0").finished() == {"r0", "r2", "r3", "r4"}
    again = answers.Segments(f"{tmp_path}/part=0", flush_rows=2)
    again.add(("r0", "x", None, (1, 0.1, "x", "", {})))
    again.add(("r1", "y", None, (1, 0.1, "y", "", {})))
    assert len(list((tmp_path / "part=0").iterdir())) == 3  # the same requests have the same name


def test_an_error_gives_way_to_a_later_answer(spark, tmp_path):
    asked = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "b")], "system string, prompt string")

    def half(system, prompt):
        if prompt == "b":
            raise RuntimeError("down")
        return "fine"

    first = {r["response"]: r["error"] for r in answers.answered_durably(asked, models.EchoClient(half), f"{tmp_path}/s").collect()}
    assert first == {"fine": None, None: "RuntimeError: down"}
    assert sorted(r["response"] for r in answers.answered_durably(asked, models.EchoClient(lambda s, p: p), f"{tmp_path}/s").collect()) == ["b", "fine"]
    assert answers.stored(spark, f"{tmp_path}/nothing").count() == 0


def test_the_plan_keeps_the_log_of_its_calls(spark, tmp_path):
    run = pipeline.Run(items=None, codes=None, detector=None, extractor=models.EchoClient(lambda s, p: models.Reply("{}", "r", {"t": 1})), folder=f"{tmp_path}/w", attempts=1)
    asked = spark.createDataFrame([("s", "a")], "system string, prompt string")
    assert pipeline.asked(asked, run.extractor, run).count() == 1
    row = pipeline.calls(spark, run).first()
    assert (row["final_output"], row["reasoning"], row["usage"], row["attempts"], row["error"]) == ("{}", "r", {"t": 1}, 1, None)
