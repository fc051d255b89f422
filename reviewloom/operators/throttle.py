"""How many calls a task may have under way, learnt from how they end."""

import sys
import threading
import time

from pyspark import cloudpickle

# The classes travel by value, so neither the driver's planner nor the executors need a copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class CircuitOpen(RuntimeError):
    """The service has refused so many calls in a row that asking on is of no use."""


class Throttle:
    """Additive increase, multiplicative decrease of the calls under way, with a breaker.

    A round of calls that all succeed, as many as the limit, raises the limit by one; a refusal cuts it to
    ``cut`` of itself, once for all calls that were under way when the service began to refuse. After ``trip``
    refusals in a row the circuit opens: no call starts for ``pause_s``, then a single one tries whether
    the service is back. Each pause is twice as long as the one before, and after ``pauses`` of them the next
    caller gets ``CircuitOpen``. A success closes the circuit.

    One throttle serves the threads of a task; it holds no lock while a call runs.
    """

    def __init__(self, most, first=None, cut=0.5, trip=8, pause_s=1.0, pauses=6, clock=time.monotonic):
        if most < 1 or not 0 < cut < 1:
            raise ValueError("at least one call must be allowed, and a cut is between 0 and 1")
        self.most, self.limit, self.cut = most, float(min(first or most, most)), cut
        self.trip, self.pause_s, self.pauses, self.clock = trip, pause_s, pauses, clock
        self.under_way = self.succeeded = self.refusals = self.opened = 0
        self.cut_at = 0           # calls that started before do not cut again
        self.started = 0
        self.closed_until = None  # when an open circuit lets one call through
        self.trying = False
        self.free = threading.Condition()

    def _may_start(self):
        if self.closed_until is None:
            return self.under_way < int(self.limit)
        return not self.trying and not self.under_way and self.clock() >= self.closed_until

    def acquire(self):
        """Wait until a call may start; gives its number."""
        with self.free:
            while not self._may_start():
                if self.opened > self.pauses:
                    raise CircuitOpen(f"refused {self.refusals} times in a row, through {self.pauses} pauses")
                wait = None if self.closed_until is None else max(0.001, self.closed_until - self.clock())
                self.free.wait(wait)
            if self.opened > self.pauses:
                raise CircuitOpen(f"refused {self.refusals} times in a row, through {self.pauses} pauses")
            self.trying = self.closed_until is not None
            self.under_way += 1
            self.started += 1
            return self.started

    def succeed(self, number):
        with self.free:
            self._end()
            self.refusals = self.opened = 0
            self.closed_until = None
            self.succeeded += 1
            if self.succeeded >= self.limit:
                self.limit, self.succeeded = min(self.most, self.limit + 1), 0
            self.free.notify_all()

    def refuse(self, number):
        with self.free:
            tried = self.trying
            self._end()
            self.refusals += 1
            self.succeeded = 0
            if number > self.cut_at:
                self.limit, self.cut_at = max(1.0, self.limit * self.cut), self.started
            if tried or (self.closed_until is None and self.refusals >= self.trip):
                self.closed_until = self.clock() + self.pause_s * 2 ** self.opened
                self.opened += 1
            self.free.notify_all()

    def drop(self, number):
        """A call ended in a way that says nothing about the load."""
        with self.free:
            self._end()
            self.free.notify_all()

    def _end(self):
        self.under_way -= 1
        self.trying = False
