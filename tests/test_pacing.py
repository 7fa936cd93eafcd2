import time

import pytest

from graphloom.sources import pacing, providers


def test_slots_of_all_lanes():
    """Lanes that begin at different moments never begin more than rate requests in any second."""
    begun = []
    for lane, start in enumerate((100.0, 100.03, 107.9, 100.5)):
        clock = [start]
        slots = pacing.Slots(8.0, 4, lane, now=lambda c=clock: c[0], sleep=lambda s, c=clock: c.__setitem__(0, c[0] + s))
        for k in range(30):
            slots()
            begun.append(clock[0])
            clock[0] += 0.9 if k == 7 else 0.01  # a slow answer
    begun.sort()
    assert len(begun) == 120
    assert all(sum(t <= x < t + 1 - 1e-9 for x in begun) <= 8 for t in begun)


def test_no_rate_is_no_wait():
    pacing.Slots(0.0, 4, 1, now=None, sleep=None)()


def test_requests_of_a_job_keep_the_rate(spark):
    pages = spark.createDataFrame([(f"d{k}", k, 1, "x") for k in range(24)], "title string, page_ord int, page_number int, text string").repartition(6)

    def make():
        return lambda number, text: [{"text": str(time.time()), "entities": [], "start": 0, "end": 1}]

    rows = providers.chunk_with(pages, make, rate=12.0, lanes=4).collect()
    times = sorted(float(r.chunks[0].text) for r in rows)
    assert len(times) == 24
    assert all(sum(t <= x < t + 0.9 for x in times) <= 13 for t in times)


def test_only_errors_that_may_pass_are_tried_again():
    for error, calls in ((pacing.ServiceError(429), 3), (pacing.ServiceError(503), 3), (ConnectionError("reset"), 3), (pacing.ServiceError(404, "x" * 999), 1), (ValueError("malformed"), 1)):
        made = []

        def call(error=error, made=made):
            made.append(1)
            raise error

        with pytest.raises(type(error)):
            providers.with_retry(call, 3, 0.0, pacing.may_pass, sleep=lambda s: None)()
        assert len(made) == calls
    assert len(str(pacing.ServiceError(404, "x" * 999))) == 312
