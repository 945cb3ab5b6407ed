"""Language-model calls as an injectable, partition-wise table function.

A client is any object with generate(system, prompt) -> str or Reply; it is sent to the workers, so it
must pickle. A task keeps a bounded number of calls in flight; all calls of a task share one rate limit,
which a server's wish to wait (Retry-After, in seconds or as a date) holds up for every one of them.
Each answer carries a log of its call from the same pass: attempts, seconds, raw text, reasoning, usage.

Requests are keyed by a hash of their prompts. ``answered`` asks within a plan: what is not yet written
when an executor is lost is asked again. ``carrel.sources.answers`` stores answers as they come, so that a
repeated task or a resumed run asks for the open requests only.
"""

from __future__ import annotations

import json
import re
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrel.functions.reasoning import split_reply

LONGEST_WAIT = 120.0
ATTEMPTS = 10
#: calls that a task keeps in flight
IN_FLIGHT = 16
#: characters of an unreadable answer that are shown to the model again
SHOWN_AGAIN = 2000

LOG = "log struct<attempts:int,seconds:double,raw_output:string,reasoning:string,usage:map<string,bigint>>"
ANSWER = f"request_id string, response string, error string, {LOG}"


@dataclass(frozen=True)
class Reply:
    """What a server said; ``reasoning`` is None where it has no field for it, then markers in the text count."""

    text: str
    reasoning: str | None = None
    usage: dict[str, int] = field(default_factory=dict)


class Client(Protocol):
    def generate(self, system: str, prompt: str) -> str | Reply: ...


class EchoClient:
    """A deterministic offline client: answers by a rule, fails where the rule raises."""

    def __init__(self, answer: Callable[[str, str], str | Reply]):
        self.answer = answer

    def generate(self, system: str, prompt: str) -> str | Reply:
        return self.answer(system, prompt)


def retry_after(value: str | float | None, now: datetime | None = None) -> float | None:
    """Seconds from a Retry-After header, which holds seconds or an HTTP date; None if it is neither."""
    if value is None or not str(value).strip():
        return None
    said = str(value).strip()
    try:
        return max(0.0, float(said))
    except ValueError:
        pass
    try:
        at = parsedate_to_datetime(said)
    except (TypeError, ValueError):
        return None
    at = at if at.tzinfo else at.replace(tzinfo=UTC)
    return max(0.0, (at - (now or datetime.now(UTC))).total_seconds())


class Retryable(Exception):
    """A failure worth another attempt; ``after`` is the server's wish: seconds or a Retry-After header."""

    def __init__(self, message: str, after: str | float | None = None):
        super().__init__(message)
        self.after = retry_after(after)


class Unauthorized(Exception):
    """The server rejected the credentials; a client with refresh() -> bool gets one chance a call."""


def wait_before(attempt: int, after: float | None = None) -> float:
    """2, 4, 8 ... seconds, at most LONGEST_WAIT, at least what the server asked for."""
    return max(min(2.0 * 2 ** (attempt - 1), LONGEST_WAIT), after or 0.0)


class Limiter:
    """One for all calls of a task: so many starts a second at most, none while the server asked for a pause."""

    def __init__(self, per_second: float | None = None, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap, self.clock, self.sleep = (1.0 / per_second if per_second else 0.0), clock, sleep
        self.lock, self.free, self.paused = threading.Lock(), 0.0, 0.0

    def enter(self) -> None:
        with self.lock:
            start = max(self.clock(), self.free)
            self.free = start + self.gap
        while (left := max(start, self.paused) - self.clock()) > 0:
            self.sleep(left)

    def pause(self, seconds: float) -> None:
        with self.lock:
            self.paused = max(self.paused, self.clock() + seconds)


def in_flight[T, R](items: Iterator[T], work: Callable[[T], R], width: int = IN_FLIGHT, ordered: bool = True) -> Iterator[R]:
    """work(item) of all items with ``width`` of them running; at most twice as many are held.

    Results come in the items' order, or as they are done. The first error ends it: what runs is awaited, nothing new starts.
    """
    with ThreadPoolExecutor(max(1, width)) as pool:
        held: deque = deque()
        try:
            for item in items:
                held.append(pool.submit(work, item))
                if len(held) >= 2 * max(1, width):
                    yield _next(held, ordered)
            while held:
                yield _next(held, ordered)
        finally:
            for f in held:
                f.cancel()


def _next(held: deque, ordered: bool):
    if ordered:
        return held.popleft().result()
    done = next(iter(wait(held, return_when=FIRST_COMPLETED).done))
    held.remove(done)
    return done.result()


def as_object(answer: str) -> dict:
    """The JSON object in an answer: a fence around all of it off, a one-element array unwrapped; else ValueError."""
    body = answer.strip()
    block = re.fullmatch(r"```(?:json)?\s*(.*?)\s*```", body, re.DOTALL)
    found = json.loads(block[1] if block else body)
    if isinstance(found, list) and len(found) == 1:
        found = found[0]
    if not isinstance(found, dict):
        raise ValueError("the answer is no JSON object")
    return found


@dataclass
class Call:
    """A call's outcome: ``value`` or ``error``, and what the log keeps."""

    value: object = None
    error: Exception | None = None
    attempts: int = 0
    seconds: float = 0.0
    raw: str = ""
    reasoning: str = ""
    usage: dict[str, int] = field(default_factory=dict)

    def log(self) -> tuple:
        return (self.attempts, round(self.seconds, 3), self.raw, self.reasoning, self.usage)


def converse(client: Client, system: str, prompt: str, attempts: int = ATTEMPTS, read: Callable[[str], object] | None = None, parser: str | None = None, limiter: Limiter | None = None, sleep: Callable[[float], None] = time.sleep) -> Call:
    """One call with its further attempts; ``read`` turns the final text into a value or raises ValueError.

    Failed calls and unreadable answers use up the same attempts. An unreadable answer goes back with what
    is wrong about it. Usage adds up over the attempts. Rejected credentials are refreshed once.
    """
    limiter, call, asked, refreshed, began = limiter or Limiter(), Call(), prompt, False, time.monotonic()
    while True:
        call.attempts += 1
        limiter.enter()
        try:
            reply = client.generate(system, asked)
            reply = reply if isinstance(reply, Reply) else Reply(reply)
            for name, n in reply.usage.items():
                call.usage[name] = call.usage.get(name, 0) + n
            call.raw = reply.text
            call.reasoning, final = (reply.reasoning, reply.text.strip()) if reply.reasoning is not None else split_reply(reply.text, parser) if parser else ("", reply.text)
            call.value, call.error = (read(final) if read else final), None
        except Retryable as e:
            call.error = e
            if call.attempts < attempts:
                pause = wait_before(call.attempts, e.after)
                if e.after:
                    limiter.pause(e.after)
                sleep(pause)
                continue
        except Unauthorized as e:
            call.error = e
            refresh = getattr(client, "refresh", None)
            if refresh and not refreshed and call.attempts < attempts:
                refreshed = True
                if refresh():
                    continue
        except ValueError as e:
            call.error = e
            if read and call.attempts < attempts:
                asked = f"{prompt}\n\nThe last answer could not be read as a JSON object ({e}). It was:\n{call.raw[:SHOWN_AGAIN]}\n\nAnswer with one JSON object and nothing else."
                continue
        except Exception as e:  # noqa: BLE001  one failed call is one failed row
            call.error = e
        call.seconds = time.monotonic() - began
        return call


def called(client: Client, system: str, prompt: str, attempts: int = ATTEMPTS, sleep: Callable[[float], None] = time.sleep, limiter: Limiter | None = None) -> str:
    """The text of an answer; the last attempt's error is raised."""
    call = converse(client, system, prompt, attempts, limiter=limiter, sleep=sleep)
    if call.error:
        raise call.error
    return call.value


def called_object(client: Client, system: str, prompt: str, attempts: int = ATTEMPTS, sleep: Callable[[float], None] = time.sleep, limiter: Limiter | None = None) -> dict:
    """The JSON object a model answers with; the last attempt's error is raised."""
    call = converse(client, system, prompt, attempts, as_object, limiter=limiter, sleep=sleep)
    if call.error:
        raise call.error
    return call.value


def request_id(system: str = "system", prompt: str = "prompt"):
    return F.sha2(F.concat_ws("\x1f", system, prompt), 256)


def requested(requests: DataFrame) -> DataFrame:
    """request_id, system, prompt of every distinct request."""
    return requests.select(request_id().alias("request_id"), "system", "prompt").dropDuplicates(["request_id"])


def answer_row(key: str, call: Call, objects: bool) -> tuple:
    response = None if call.error else json.dumps(call.value, ensure_ascii=False) if objects else call.value
    return key, response, f"{type(call.error).__name__}: {call.error}" if call.error else None, call.log()


def answered(requests: DataFrame, client: Client, done: DataFrame | None = None, attempts: int = ATTEMPTS, objects: bool = False, width: int = IN_FLIGHT, per_second: float | None = None, parser: str | None = None) -> DataFrame:
    """request_id, response, error, log for every distinct (system, prompt); ``done`` has earlier answers.

    With ``objects``, an answer must be a JSON object: others are asked for again with feedback. ``width``
    and ``per_second`` hold for a task; ``parser`` names the markers of reasoning in a text.
    """
    wanted = requested(requests)
    if done is not None:
        wanted = wanted.join(done.where("error is null").select("request_id"), "request_id", "left_anti")

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = Limiter(per_second)

        def one(row: tuple) -> tuple:
            key, system, prompt = row
            return answer_row(key, converse(client, system, prompt, attempts, as_object if objects else None, parser, limiter), objects)

        rows = (row for frame in frames for row in zip(frame["request_id"], frame["system"], frame["prompt"], strict=True))
        yield from answer_frames(in_flight(rows, one, width))

    fresh = wanted.mapInPandas(ask, ANSWER)
    if done is None:
        return fresh
    earlier = done.where("error is null").join(requests.select(request_id().alias("request_id")).distinct(), "request_id", "left_semi")
    return fresh.unionByName(earlier, allowMissingColumns=True)


def answer_frames(rows: Iterator[tuple], most: int = 256) -> Iterator[pd.DataFrame]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield _frame(held)
            held = []
    if held:
        yield _frame(held)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame([r[:3] for r in rows], columns=["request_id", "response", "error"])
    frame["log"] = [dict(zip(("attempts", "seconds", "raw_output", "reasoning", "usage"), r[3], strict=True)) for r in rows]
    return frame


def call_log(answers: DataFrame, requests: DataFrame) -> DataFrame:
    """One row for each call, from the same rows as the answers: request, prompts, outcome and log."""
    asked = requests.select(request_id().alias("request_id"), *requests.columns).dropDuplicates(["request_id"])
    return asked.join(answers.select("request_id", F.col("response").alias("final_output"), "error", "log.*"), "request_id")
