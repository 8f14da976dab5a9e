"""Calling a model over a column of prompts.

The model itself is outside: ``backend`` is a factory, run once per task, that
returns a callable from one prompt to one reply; a factory with a parameter is given the
stage's ``ModelSettings``.  Spark partitions the prompts; the number of calls in flight is the
number of running tasks times ``threads``.

With settings every call has a deadline.  It runs in a thread of its own, and a call that is late
counts as an attempt that timed out: the task goes on, whatever the call does.  With a budget of
calls per second each task has its share of it, and waits for its turn before each attempt.
"""

from __future__ import annotations

import inspect
import json
import re
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.config import ModelSettings, PipelineSettings, RetrySettings
from chartloom.functions.jsonval import clean_reply
from chartloom.schemas import INFERENCE
from chartloom.sources.tables import materialise, small_batches

Model = Callable[[str], str]
Backend = Callable[[], Model] | Callable[[ModelSettings], Model]


def _error_kind(error: Exception) -> str:
    if isinstance(error, TimeoutError):
        return "timeout"
    if isinstance(error, (ConnectionError, OSError)):
        return "api"
    if isinstance(error, json.JSONDecodeError):
        return "json"
    return "other"


class Budget:
    """Calls per second of one task: a bucket that fills at ``rate`` and holds ``burst``."""

    def __init__(self, rate: float, burst: float = 1.0):
        if rate <= 0 or burst < 1:
            raise ValueError("a budget has a positive rate and holds a call at least")
        self.rate, self.burst = rate, burst
        self.held, self.at = burst, time.monotonic()
        self.lock = threading.Lock()

    def take(self) -> float:
        """Wait for a call's turn; the seconds waited."""
        with self.lock:
            now = time.monotonic()
            self.held = min(self.burst, self.held + (now - self.at) * self.rate)
            self.at = now
            self.held -= 1
            wait = max(0.0, -self.held / self.rate)
        time.sleep(wait)
        return wait


def _within(model: Model, prompt: str, seconds: float) -> str:
    """The reply, or ``TimeoutError`` after ``seconds``; a late call is left to itself."""
    done, outcome = threading.Event(), []

    def run() -> None:
        try:
            outcome.append((model(prompt), None))
        except BaseException as error:  # handed over to the caller, below
            outcome.append((None, error))
        done.set()

    threading.Thread(target=run, daemon=True).start()
    if not done.wait(max(0.0, seconds)):
        raise TimeoutError(f"no reply in {seconds:g} s")
    reply, error = outcome[0]
    if error is not None:
        raise error
    return reply


def _call(
    model: Model, prompt: str, name: str, retry: RetrySettings,
    deadline: float | None = None, budget: Budget | None = None,
) -> tuple:
    """Reply of one prompt after at most ``max_attempts`` tries, never an exception.

    An attempt may take ``deadline`` seconds, and no longer than what is left of the retry
    settings' total.  Waiting for the budget takes time, but is no attempt.
    """
    wait, started = retry.initial_wait_seconds, time.monotonic()

    def left() -> float:
        return retry.timeout_seconds - (time.monotonic() - started)

    for attempt in range(1, retry.max_attempts + 1):
        if budget is not None:
            budget.take()
        try:
            if deadline is None:
                reply = model(prompt)
            else:  # the first attempt is made even if its turn came late
                reply = _within(model, prompt, min(deadline, left()) if attempt > 1 else deadline)
            return reply, None, None, attempt, name
        except Exception as error:
            failure = (None, str(error), _error_kind(error), attempt, name)
        if attempt == retry.max_attempts or left() <= wait:
            break
        time.sleep(wait)
        wait *= retry.backoff_factor
    return failure


def _started(backend: Backend, settings: ModelSettings | None) -> Model:
    if settings is not None and inspect.signature(backend).parameters:
        return backend(settings)
    return backend()


def stage_options(stage: str, settings: PipelineSettings = PipelineSettings()) -> dict:
    """What :func:`infer` takes for a stage of the pipeline: its model settings and retries."""
    return {"settings": getattr(settings, stage), "retry": settings.retry}


def infer_udf(
    backend: Backend,
    name: str = "primary",
    fallback: Backend | None = None,
    fallback_name: str = "fallback",
    retry: RetrySettings = RetrySettings(),
    threads: int = 1,
    settings: ModelSettings | None = None,
    calls_per_second: float | None = None,
    burst: float = 1.0,
):
    """Column function from prompt to ``struct(reply, error, error_kind, attempts, model)``.

    A null prompt is not sent and gives a null reply.  Prompts that fail on the
    primary go to the fallback, no others.  ``settings`` bring each call's deadline,
    ``calls_per_second`` is what one task may use, retries and fallback included.
    """
    deadline = None if settings is None else settings.timeout_seconds

    @F.pandas_udf(INFERENCE)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        primary = _started(backend, settings)
        second = _started(fallback, settings) if fallback is not None else None
        budget = None if calls_per_second is None else Budget(calls_per_second, burst)

        def one(prompt: str | None) -> tuple:
            if prompt is None:
                return None, None, None, 0, None
            result = _call(primary, prompt, name, retry, deadline, budget)
            if result[2] is not None and second is not None:
                result = _call(second, prompt, fallback_name, retry, deadline, budget)
            return result

        with ThreadPoolExecutor(max_workers=threads) as pool:
            for prompts in batches:
                rows = list(pool.map(one, prompts))
                yield pd.DataFrame(rows, columns=INFERENCE.fieldNames())

    # A call to a service: never repeated or moved by the optimiser.
    return run.asNondeterministic()


def infer(
    df: DataFrame,
    prompt: str,
    backend: Backend,
    output: str = "inference",
    max_concurrency: int | None = None,
    calls_per_second: float | None = None,
    **options,
) -> DataFrame:
    """Add the model's answer to every row; rows and keys stay as they are.

    ``max_concurrency`` spreads the rows evenly over that many tasks, for services
    with a limit; ``calls_per_second`` is a limit for all of them, of which each task gets an
    equal share (a task that runs twice, as a speculative copy does, uses its share twice).
    """
    share = None
    if calls_per_second is not None:
        if max_concurrency is None:
            raise ValueError("calls_per_second needs max_concurrency, which it is shared by")
        share = calls_per_second / max_concurrency
    spread = df if max_concurrency is None else df.repartition(max_concurrency)
    small_batches(df.sparkSession)  # prompts hold whole texts
    answer = infer_udf(backend, calls_per_second=share, **options)
    return spread.withColumn(output, answer(F.col(prompt)))


def _prompt_hash(prompt: Column) -> Column:
    """Hash of a prompt; a number of its own where there is none, which no prompt has."""
    own = F.concat(F.lit("none-"), F.monotonically_increasing_id().cast("string"))
    return F.coalesce(F.sha2(prompt, 256), own)


def infer_distinct(
    df: DataFrame, prompt: str, backend: Backend, output: str = "inference", **options
) -> DataFrame:
    """Like :func:`infer`, but equal prompts are sent once.

    Equal prompts collapse before the shuffle; the answers, unique per prompt hash,
    are joined back, and adaptive execution splits a hash that many rows share.  Rows
    without a prompt get a hash of their own each, so they do not gather anywhere.
    """
    keyed = df.withColumn("_hash", _prompt_hash(F.col(prompt)))
    unique = (
        keyed.filter(F.col(prompt).isNotNull())
        .groupBy("_hash")
        .agg(F.first(prompt).alias(prompt))
    )
    answered = infer(unique, prompt, backend, output, **options).select("_hash", output)
    return keyed.join(answered, "_hash", "left").drop("_hash")


def infer_cached(
    df: DataFrame,
    prompt: str,
    backend: Backend,
    cache: DataFrame,
    now: Column,
    ttl_seconds: int = 3600,
    output: str = "inference",
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Answer from fresh rows of ``cache`` first, call the model for the rest.

    Returns the answered rows and the rows to append to the cache
    (``prompt_hash, reply, cached_at``).  New answers are written down at once, so that
    each open prompt is sent once, whichever of the two results are used.
    """
    fresh = (
        cache.withColumn("_age", F.unix_timestamp(now) - F.unix_timestamp(F.col("cached_at")))
        .filter((F.col("_age") >= 0) & (F.col("_age") < ttl_seconds))
        .groupBy("prompt_hash")
        .agg(F.max_by("reply", F.struct("cached_at", "reply")).alias("_cached"))
    )
    keyed = df.withColumn("prompt_hash", _prompt_hash(F.col(prompt))).join(
        fresh, "prompt_hash", "left"
    )
    open_prompts = keyed.filter(F.col("_cached").isNull() & F.col(prompt).isNotNull())
    answers = materialise(
        infer(
            open_prompts.groupBy("prompt_hash").agg(F.first(prompt).alias(prompt)),
            prompt, backend, "_answer", **options,
        ),
        "answers",
    )
    hit = F.struct(
        F.col("_cached").alias("reply"),
        F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("string").alias("error_kind"),
        F.lit(0).alias("attempts"),
        F.lit("cache").alias("model"),
    ).cast(INFERENCE)
    result = (
        keyed.join(answers.select("prompt_hash", "_answer"), "prompt_hash", "left")
        .withColumn(
            output, F.when(F.col("_cached").isNotNull(), hit).otherwise(F.col("_answer"))
        )
        .select(*df.columns, output)
    )
    new_rows = answers.filter(F.col("_answer.error_kind").isNull()).select(
        "prompt_hash", F.col("_answer.reply").alias("reply"), now.alias("cached_at")
    )
    return result, new_rows


def reply_document(inference: Column) -> Column:
    """Inference result to the JSON document that is stored.

    A failed call or an unreadable reply becomes an error document with
    ``extraction_confidence`` ``failed``; nothing is dropped.
    """
    # Wording of the error documents.
    kind, message = inference["error_kind"], inference["error"]
    body = clean_reply(inference["reply"])
    failed = F.lit("failed").alias("extraction_confidence")

    def error(text: Column) -> Column:
        return F.to_json(F.struct(text.alias("error"), failed))

    unreadable = F.to_json(
        F.struct(
            F.lit("JSON parse error: reply is not valid JSON").alias("error"),
            inference["reply"].alias("raw_response"),
            failed,
        )
    )
    return (
        F.when(kind == "timeout", error(F.lit("API timeout")))
        .when(kind == "api", error(F.concat(F.lit("API error: "), message)))
        .when(kind == "json", error(F.concat(F.lit("JSON parse error: "), message)))
        .when(kind.isNotNull(), error(F.concat(F.lit("Unexpected error: "), message)))
        .when(F.try_parse_json(body).isNotNull(), body)
        .otherwise(unreadable)
    )


def change_summary(changes: Column) -> Column:
    """Reviewed changes as one line each, for a prompt."""
    def shown(value: Column) -> Column:
        return F.coalesce(value, F.lit("None"))

    return F.array_join(
        F.transform(
            changes,
            lambda c: F.concat(
                F.lit("- "), c["field"], F.lit(": "), shown(c["old_value"]),
                F.lit(" → "), shown(c["new_value"]),
            ),
        ),
        "\n",
    )


def render_prompt(template: str, **values: Column) -> Column:
    """Fill ``{name}`` slots of a template with columns; null becomes empty text."""
    def piece(part: str, is_slot: bool) -> Column:
        if not is_slot:
            return F.lit(part)
        return F.coalesce(values[part].cast("string"), F.lit(""))

    parts = re.split(r"\{(" + "|".join(map(re.escape, values)) + r")\}", template)
    return F.concat(*[piece(p, i % 2 == 1) for i, p in enumerate(parts)])


__all__ = [
    "Backend", "Budget", "Model", "change_summary", "infer", "infer_cached", "infer_distinct",
    "infer_udf", "render_prompt", "reply_document", "stage_options",
]
