"""Calls under way that follow the load of the service."""

import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from reviewloom.operators.classify import classify
from reviewloom.operators.remote import RemoteScorer
from reviewloom.operators.throttle import CircuitOpen, Throttle


class Service:
    """Refuses calls beyond ``most`` at once."""

    def __init__(self, most, seconds=0.002):
        self.most, self.seconds, self.lock = most, seconds, threading.Lock()
        self.under_way = self.calls = self.refused = self.highest = 0

    def ask(self):
        with self.lock:
            self.calls += 1
            if self.under_way >= self.most:
                self.refused += 1
                return False
            self.under_way += 1
            self.highest = max(self.highest, self.under_way)
        time.sleep(self.seconds)
        with self.lock:
            self.under_way -= 1
        return True


def work_off(service, throttle, n, threads):
    def one(_):
        while True:
            number = throttle.acquire()
            if service.ask():
                return throttle.succeed(number)
            throttle.refuse(number)
    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(one, range(n)))


def test_finds_the_limit_of_the_service():
    service, throttle = Service(6), Throttle(32, first=1, pause_s=0.01, trip=100)
    work_off(service, throttle, 1500, 32)
    assert service.highest == 6
    assert service.calls - service.refused == 1500 and service.refused < 300
    assert 2 <= throttle.limit <= 8


def test_grows_to_the_most_without_refusals():
    throttle = Throttle(16, first=1)
    work_off(Service(100, 0.0005), throttle, 1000, 16)
    assert throttle.limit == 16


def test_calls_that_were_under_way_cut_once():
    throttle = Throttle(16, first=16, trip=100)
    numbers = [throttle.acquire() for _ in range(16)]
    for number in numbers:
        throttle.refuse(number)
    assert throttle.limit == 8
    throttle.refuse(throttle.acquire())
    assert throttle.limit == 4


def test_the_breaker_opens_tries_one_call_and_closes():
    now = [0.0]
    throttle = Throttle(4, first=4, trip=3, pause_s=10, clock=lambda: now[0])
    for _ in range(3):
        throttle.refuse(throttle.acquire())
    assert throttle.closed_until == 10 and not throttle._may_start()
    now[0] = 10
    number = throttle.acquire()
    assert not throttle._may_start()      # one call tries
    throttle.refuse(number)
    assert throttle.closed_until == 30    # twice as long
    now[0] = 30
    throttle.succeed(throttle.acquire())
    assert throttle.closed_until is None and throttle._may_start()


def test_gives_up_after_the_pauses():
    throttle = Throttle(4, trip=2, pause_s=0.001, pauses=3)
    with pytest.raises(CircuitOpen):
        for _ in range(100):
            throttle.refuse(throttle.acquire())
    assert throttle.refusals == 2 + 3


def test_other_errors_free_the_place():
    throttle = Throttle(1)
    throttle.drop(throttle.acquire())
    throttle.succeed(throttle.acquire())
    assert throttle.under_way == 0 and throttle.limit == 1


def limited_client(folder, most):
    """A client whose service refuses calls beyond ``most`` at once, and leaves a file per call."""
    def factory():
        import os
        import threading
        import time
        import uuid
        lock, under_way = threading.Lock(), [0]

        class Refused(Exception):
            status_code = 429

        def ask(prompt, timeout):
            with lock:
                full = under_way[0] >= most
                under_way[0] += not full
            with open(os.path.join(folder, ("refused-" if full else "done-") + uuid.uuid4().hex), "w"):
                pass
            if full:
                raise Refused("too many")
            time.sleep(0.002)
            with lock:
                under_way[0] -= 1
            return ["Positive", "negative", "neutral"][len(prompt) % 3]
        return ask
    return factory


def test_scorer_labels_all_texts_through_a_service_with_a_limit(spark, tmp_path):
    rows = spark.createDataFrame([(i, "x" * (i % 7)) for i in range(600)], "id int, text string").coalesce(1)
    scorer = RemoteScorer(limited_client(str(tmp_path), 4), template="%s", concurrency=16, adaptive=True, backoff_s=0.01, retries=0)
    got = {r.id: r.feedback for r in classify(rows, scorer).collect()}
    labels = ["POSITIVE", "NEGATIVE", "NEUTRAL"]
    assert got == {i: labels[i % 7 % 3] if i % 7 else "Empty" for i in range(600)}
    names = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert names.count("done") == sum(i % 7 > 0 for i in range(600))
    assert names.count("refused") < names.count("done") / 3


def test_a_service_that_refuses_all_fails_or_falls_back(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string").coalesce(1)
    refusing = lambda **o: RemoteScorer(limited_client(str(tmp_path), 0), template="%s", adaptive=True, backoff_s=0.0001, **o)
    with pytest.raises(Exception, match="CircuitOpen"):
        classify(rows, refusing()).collect()
    assert {r.feedback for r in classify(rows, refusing(on_failure="unknown")).collect()} == {"UNKNOWN"}
