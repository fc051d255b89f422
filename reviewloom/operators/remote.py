"""Scorer that asks a remote client, one call per text."""

import random
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import functions as F

from ..functions.labels import normalise_label
from ..functions.records import field
from ..functions.text import PROMPT
from ..schema import LABELS, UNKNOWN
from .throttle import CircuitOpen, Throttle

_REPLY = "__reply"

#: HTTP states that a repeated call would meet again: bad request, refused key, no such model.
LASTING = frozenset({400, 401, 403, 404, 405, 422})

#: States of a service that has too much to do.
REFUSED = frozenset({429, 503, 529})


def is_lasting(error):
    """Whether asking again is of no use."""
    return getattr(error, "status_code", None) in LASTING


def is_refused(error):
    """Whether the service had too much to do."""
    return getattr(error, "status_code", None) in REFUSED


@dataclass(frozen=True)
class RemoteScorer:
    """``client_factory()`` runs once per partition, on the executor, and returns
    ``ask(prompt, timeout) -> reply``; read secrets from the environment there.

    Only text that is neither null nor empty reaches the client. A task has up to ``concurrency``
    calls under way, so ``ask`` must be thread-safe above 1. ``max_in_flight`` bounds the calls of the
    whole job: it is shared out over the cluster's slots, and where there are more slots than
    calls, the rows go to as many partitions as calls. With ``adaptive`` that number is the most: a task starts with one
    call at a time, adds one after each round without a refusal, and halves them when the service refuses; after many refusals in a row it
    pauses, and fails when pauses do not help (see ``Throttle``). A call that is refused for its load, as ``refused(error)`` tells, is
    repeated until then, whatever ``retries``. Any other call that raises is tried
    ``retries`` more times inside the task, after a wait that doubles and varies at random, since a
    failed task would repeat every call of its partition; an error that ``lasting(error)`` calls lasting
    (a refused key) is not tried again. After that the task fails, or with ``on_failure="unknown"``
    the row is labelled UNKNOWN. ``partitions`` spreads a narrow source over more tasks
    before the calls.

    Write the labels out before sorting by a global order or using them twice:
    Spark would run the calls again for each pass over the plan.
    """

    client_factory: Callable
    template: str = PROMPT
    labels: tuple = LABELS
    timeout_s: float = 30.0
    retries: int = 2
    backoff_s: float = 1.0
    concurrency: int = 8
    max_in_flight: int | None = None
    lasting: Callable = is_lasting
    on_failure: str = "raise"
    adaptive: bool = False
    refused: Callable = is_refused
    partitions: int | None = None

    def __post_init__(self):
        if self.on_failure not in ("raise", "unknown"):
            raise ValueError(f"on_failure must be raise or unknown, not {self.on_failure!r}")

    def score(self, df, text_col, out_col):
        slots = df.sparkSession.sparkContext.defaultParallelism
        if self.max_in_flight and self.max_in_flight < slots:
            df = df.repartition(min(self.max_in_flight, self.partitions or slots))
        elif self.partitions:
            df = df.repartition(self.partitions)
        asked = df.withColumn(_REPLY, self._udf(self.calls_per_task(slots))(field(text_col)))
        return asked.withColumn(
            out_col, normalise_label(F.col(_REPLY), self.labels)).drop(_REPLY)

    def calls_per_task(self, slots):
        """Calls under way in one task when ``slots`` tasks run at once."""
        share = self.concurrency if self.max_in_flight is None else self.max_in_flight // slots
        return max(1, min(self.concurrency, share))

    def _udf(self, concurrency):
        # Plain values only, so the function travels to the executors by itself.
        factory, template, timeout_s = self.client_factory, self.template, self.timeout_s
        retries, backoff_s = self.retries, self.backoff_s
        lasting = _by_value(self.lasting, is_lasting, LASTING)
        refused = _by_value(self.refused, is_refused, REFUSED)
        # Named only where they are needed: the plain function travels without the package.
        given_up = (CircuitOpen,) if self.adaptive else ()
        throttle_of = (lambda: Throttle(concurrency, first=1, pause_s=backoff_s)) if self.adaptive else lambda: None
        fallback = UNKNOWN if self.on_failure == "unknown" else None

        def reply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            client, throttle = factory(), throttle_of()

            def ask(prompt):
                if throttle is None:
                    return client(prompt, timeout_s)
                while True:
                    number = throttle.acquire()
                    try:
                        reply = client(prompt, timeout_s)
                    except Exception as error:
                        if not refused(error):
                            throttle.drop(number)
                            raise
                        throttle.refuse(number)
                    else:
                        throttle.succeed(number)
                        return reply

            def one(text):
                if not text:
                    return None
                for attempt in range(retries + 1):
                    try:
                        # An empty reply is a reply: it ends up as UNKNOWN, not as null.
                        return ask(template % text) or ""
                    except Exception as error:
                        if attempt == retries or isinstance(error, given_up) or lasting(error):
                            if fallback is None:
                                raise
                            return fallback
                        time.sleep(backoff_s * 2 ** attempt * random.uniform(0.5, 1.5))

            def drain(todo, replies):
                while todo:
                    try:
                        at, text = todo.popleft()
                    except IndexError:  # another thread took the last one
                        return
                    try:
                        replies[at] = one(text)
                    except Exception:
                        todo.clear()  # the task fails: make no further calls
                        raise

            with ThreadPoolExecutor(concurrency) as pool:
                for texts in batches:
                    todo, replies = deque(enumerate(texts)), [None] * len(texts)
                    for run in [pool.submit(drain, todo, replies) for _ in range(concurrency)]:
                        run.result()
                    yield pd.Series(replies, dtype=object)

        # Not deterministic: otherwise a filter on the label would ask twice per row.
        return F.pandas_udf(reply, "string").asNondeterministic()


def _by_value(test, own, states):
    """The module's own test as a function that needs no package on the executors."""
    if test is not own:
        return test
    return lambda error: getattr(error, "status_code", None) in states


def chat_client(model, api_key_env="OPENAI_API_KEY", base_url=None):
    """Client factory for a chat-completion service; needs the ``openai`` package
    and the key in the executors' environment. The scorer retries, so the library does not."""
    def factory():
        import os

        from openai import OpenAI

        client = OpenAI(api_key=os.environ[api_key_env], base_url=base_url, max_retries=0)

        def ask(prompt, timeout):
            done = client.chat.completions.create(
                model=model, timeout=timeout, messages=[{"role": "system", "content": prompt}])
            return done.choices[0].message.content

        return ask

    return factory
