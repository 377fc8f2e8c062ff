import pytest

from tidewatch.streaming.retry import RetriesExhausted, with_retry


def failing(times):
    calls = []

    def action():
        calls.append(1)
        if len(calls) <= times:
            raise OSError("down")

    return action, calls


def test_always_failing_tries_four_times_with_growing_waits():
    action, calls = failing(99)
    waits = []
    with pytest.raises(RetriesExhausted) as caught:
        with_retry(action, sleep=waits.append)
    assert (len(calls), waits) == (4, [0.1, 0.5, 2.0])
    assert isinstance(caught.value.__cause__, OSError)


def test_fails_twice_then_succeeds():
    action, calls = failing(2)
    waits, retries = [], []
    assert with_retry(action, sleep=waits.append, on_retry=retries.append) == 3
    assert (len(calls), waits, len(retries)) == (3, [0.1, 0.5], 2)


def test_success_at_once_does_not_wait():
    action, calls = failing(0)
    assert with_retry(action, sleep=pytest.fail) == 1


def test_a_stop_is_passed_on_at_once():
    def stopped():
        raise OSError("java.lang.InterruptedException: stopped")

    with pytest.raises(OSError):
        with_retry(stopped, sleep=pytest.fail, on_retry=pytest.fail)
