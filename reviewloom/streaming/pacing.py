"""How much the next batch of a stream should admit."""

import sys
from dataclasses import dataclass

from pyspark import cloudpickle

# The classes travel by value, so neither the driver's planner nor the executors need a copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_GROWTH, MAX_CUT = 2.0, 0.25   # of the next batch against the last
SMOOTHING = 0.5                   # weight of the last batch in the rate


@dataclass
class Pacer:
    """Sizes batches so that each takes about ``target_s``.

    The rate of the last batches, smoothed, times the target is the next size, within ``least`` and ``most``
    and no more than ``MAX_GROWTH`` or less than ``MAX_CUT`` times the last one; so a single odd batch, such as the first with its
    cold start, cannot throw the size off. Without a target every batch has the first size.
    """

    first: int
    target_s: float | None = None
    least: int = 1
    most: int | None = None
    size: int = 0
    rate: float | None = None

    def __post_init__(self):
        if self.first < 1 or self.least < 1 or (self.target_s is not None and self.target_s <= 0):
            raise ValueError("sizes and the target time must be above 0")
        self.size = self._bounded(self.size or self.first)

    def _bounded(self, size):
        return max(self.least, min(int(size), self.most or int(size)))

    def finished(self, amount, seconds):
        """Take note of a batch of ``amount`` that took ``seconds``."""
        if self.target_s is None or amount <= 0:
            return
        rate = amount / max(seconds, 1e-3)
        # What slows down counts at once, what speeds up by and by.
        self.rate = rate if self.rate is None or rate < self.rate else SMOOTHING * rate + (1 - SMOOTHING) * self.rate
        wanted = self.rate * self.target_s
        # A batch below its size, at the end of the input, does not tell that less should be admitted.
        self.size = self._bounded(min(max(wanted, MAX_CUT * self.size), MAX_GROWTH * self.size))
