"""Retrying a batch's writes."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from tidewatch.schemas import RETRY_DELAYS


class RetriesExhausted(RuntimeError):
    """The action failed at every attempt; the last failure is the cause."""


# A stopped query interrupts its batch; that is no failed write.
STOPS = ("InterruptedException", "InterruptedIOException", "ClosedByInterruptException", "cancelled", "canceled")


def is_stop(failure: BaseException) -> bool:
    text = f"{type(failure).__name__}: {failure}"
    return any(name in text for name in STOPS)


def with_retry(
    action: Callable[[], None],
    delays: Sequence[float] = RETRY_DELAYS,
    sleep: Callable[[float], None] = time.sleep,
    on_retry: Callable[[Exception], None] = lambda failure: None,
) -> int:
    """Run `action` until it succeeds, waiting `delays` between attempts; returns the attempts made.

    A stop of the query is passed on at once: it is neither retried nor a failure of the action.
    """
    attempts = len(delays) + 1
    for attempt in range(1, attempts + 1):
        try:
            action()
            return attempt
        except Exception as failure:
            if is_stop(failure):
                raise
            if attempt == attempts:
                raise RetriesExhausted(f"failed after {attempt} attempts") from failure
            on_retry(failure)
            sleep(delays[attempt - 1])
    raise AssertionError("unreachable")
