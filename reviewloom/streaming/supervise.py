"""Keep a query running across failures."""

import logging
import re
import time
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException

log = logging.getLogger(__name__)


class GaveUp(RuntimeError):
    """The query kept failing; the last failure is the cause."""


@dataclass(frozen=True)
class Outcome:
    query: object
    restarts: int


#: What errors of an outage name: such a failure says nothing about the batch.
OUTAGES = re.compile(
    r"ConnectException|Connection (?:refused|reset|timed out)|UnknownHost|TimeoutException|timed out|"
    r"BrokerNotAvailable|LeaderNotAvailable|DisconnectException|NoRouteToHost|NetworkException|"
    r"Service(?:Unavailable| Unavailable)|Too Many Requests", re.IGNORECASE)


def is_outage(failure):
    return bool(OUTAGES.search(str(failure)))


def supervise(start, backoff_s=10, max_restarts=None, max_stuck=3, max_backoff_s=300,
              retryable=(StreamingQueryException,), outage=is_outage, on_start=None, sleep=time.sleep):
    """Start, wait, and start again after a failure.

    ``start()`` builds the plan and returns the running query; it must use the
    same checkpoint each time, so that a new run goes on after the last finished
    batch. A query that ends or is stopped without an error is not restarted;
    ``on_start(query)`` hands out the handle to stop it.

    Gives up after ``max_restarts`` restarts, or when the same batch failed ``max_stuck`` times in a row
    with the same error, as when one record can never be read. What ``outage(failure)`` calls an
    outage, a broker that restarts for example, counts as neither poison nor progress: the wait doubles
    with each failure in a row, up to ``max_backoff_s``, and the query goes on when the outage ends.
    """
    restarts = stuck = in_a_row = 0
    last = None
    while True:
        query = None
        try:
            query = start()
            if on_start:
                on_start(query)
            query.awaitTermination()
            return Outcome(query, restarts)
        except retryable as failure:
            in_a_row += 1
            if _finished_a_batch(query):
                stuck, in_a_row, last = 0, 1, None
            elif not outage(failure):
                sign = _signature(query, failure)
                stuck = stuck + 1 if sign == last else 1
                last = sign
                if stuck >= max_stuck:
                    raise GaveUp(f"the same batch failed in {stuck} runs") from failure
            if max_restarts is not None and restarts >= max_restarts:
                raise GaveUp(f"failed after {restarts} restarts") from failure
            restarts += 1
            wait = min(backoff_s * 2 ** min(in_a_row - 1, 20), max(backoff_s, max_backoff_s))
            log.warning("query failed, restart %d in %s s: %s", restarts, wait, failure)
            sleep(wait)


def _finished_a_batch(query):
    return query is not None and any(p.numInputRows > 0 for p in query.recentProgress)


def _signature(query, failure):
    """The batch under way, as far as it is known, and the error without run ids and numbers."""
    seen = query.recentProgress if query is not None else []
    return (seen[-1].batchId if seen else None, re.sub(r"[0-9a-f]{8}-[0-9a-f-]{27}|\d+", "#", str(failure))[:500])
