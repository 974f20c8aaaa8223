"""Look up each distinct key in an outside service from the executors.

Two things make a lookup fit for a whole table. One rate holds for the whole job: its tasks share it,
each with its own turns on a common clock, so however many run at once they never exceed it. And
answers can be stored: a later run asks only for keys without a fresh answer.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildmill.operators.dedup import first_per_key
from gildmill.sources.readers import read_optional
from gildmill.sources.writers import materialize

ERROR_COLUMN = "lookup_error"
ASKED_COLUMN = "asked_at"
JOB_TASKS = 8


def enrich_external(
    df: DataFrame,
    key: str,
    connect: Callable[[], Callable[[object], dict | None]],
    fields: T.StructType,
    calls_per_second: float | None = None,
    parallel: int | None = None,
    retries: int = 2,
    backoff_seconds: float = 0.0,
    job_calls_per_second: float | None = None,
    answers: str | None = None,
    expires_after_seconds: float | None = None,
) -> DataFrame:
    """Left-join the answers of a service, one call per distinct key.

    ``connect`` runs once per task and returns the lookup function. A call that
    keeps failing leaves null fields and its message in ``lookup_error``.
    ``calls_per_second`` paces each task and ``parallel`` bounds the tasks, so their
    product bounds the load on the service. ``job_calls_per_second`` is one rate for the whole
    job: ``parallel`` tasks (8 by default) take turns, retries of a call included. Speculative
    copies of tasks would take the same turns: leave speculation off. Answers are written before
    the join, so a lost executor or a re-planned join does not call the service again.

    ``answers`` names a folder that keeps all answers with the time they were asked for. Keys with
    an answer that is free of errors and not older than ``expires_after_seconds`` (None: at any age)
    are not asked for again; of several answers the latest counts.
    """
    key_type = df.schema[key].dataType
    out = T.StructType(
        [T.StructField(key, key_type), *fields.fields, T.StructField(ERROR_COLUMN, T.StringType())]
    )
    names = fields.fieldNames()
    pause = 1.0 / calls_per_second if calls_per_second else 0.0
    if job_calls_per_second:
        parallel = parallel or JOB_TASKS
    turn = 1.0 / job_calls_per_second if job_calls_per_second else 0.0
    tasks = parallel or 1

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetch = connect()
        wait = Turns(TaskContext.get().partitionId() % tasks, tasks, turn) if turn else lambda: None

        def ask(value) -> list:
            error = None
            for attempt in range(retries + 1):
                if pause or (attempt and backoff_seconds):
                    time.sleep(pause + (backoff_seconds * 2 ** (attempt - 1) if attempt else 0.0))
                wait()
                try:
                    answer = fetch(value) or {}
                    return [*[answer.get(n) for n in names], None]
                except Exception as e:  # noqa: BLE001  any service failure is reported per key
                    error = f"{type(e).__name__}: {e}"
            return [*[None] * len(names), error]

        for batch in batches:
            rows = [[v, *ask(v)] for v in batch[key]]
            yield pd.DataFrame(rows, columns=[key, *names, ERROR_COLUMN], dtype=object)

    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    stored = None if answers is None else _stored(df, answers, out)
    if stored is not None:
        keys = keys.join(_fresh(stored, expires_after_seconds).select(key), key, "left_anti")
    if parallel is not None:
        keys = keys.repartition(parallel, key)
    asked = keys.mapInPandas(look_up, out)
    if answers is None:
        return df.join(materialize(asked, "lookup"), key, "left")
    asked.withColumn(ASKED_COLUMN, F.current_timestamp()).write.mode("append").parquet(answers)
    latest = first_per_key(_stored(df, answers, out), [key], [F.desc(ASKED_COLUMN), F.col(ERROR_COLUMN).asc_nulls_first()])
    return df.join(latest.drop(ASKED_COLUMN), key, "left")


def _stored(df: DataFrame, path: str, out: T.StructType) -> DataFrame | None:
    """The stored answers, if there are any."""
    shape = T.StructType([*out.fields, T.StructField(ASKED_COLUMN, T.TimestampType())])
    return read_optional(df.sparkSession, lambda s: s.read.schema(shape).parquet(path))


def _fresh(stored: DataFrame, expires_after_seconds: float | None) -> DataFrame:
    good = stored.where(F.col(ERROR_COLUMN).isNull())
    if expires_after_seconds is None:
        return good
    age = F.unix_micros(F.current_timestamp()) - F.unix_micros(ASKED_COLUMN)
    return good.where(age <= F.lit(int(expires_after_seconds * 1_000_000)))


class Turns:
    """Turn ``mine`` of ``tasks`` on a common clock that has one turn every ``seconds``.

    A task may call in every ``tasks``-th turn, once, and only in the turn's first half: one that wakes up
    later waits for its next turn. No two tasks share a turn, so no more calls are made in any time
    than turns begin in it, but one, as far as the executors' clocks agree.
    """

    def __init__(self, mine: int, tasks: int, seconds: float, clock=time.time, sleep=time.sleep):
        self.mine, self.tasks, self.seconds = mine, tasks, seconds
        self.clock, self.sleep, self.last = clock, sleep, None

    def __call__(self) -> None:
        while True:
            now = int(self.clock() / self.seconds)
            turn = now + (self.mine - now) % self.tasks
            if self.last is not None:
                turn = max(turn, self.last + self.tasks)
            self.last = turn
            pause = turn * self.seconds - self.clock()
            if pause > 0:
                self.sleep(pause)
            if self.clock() < (turn + 0.5) * self.seconds:
                return
