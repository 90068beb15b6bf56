"""Which failures to try again, which are fatal, and how to try again."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column

R = TypeVar("R")
#: Words of passing failures, and status names of fatal ones.
RETRYABLE = ("unavailable", "deadline", "resource_exhausted", "aborted", "internal", "timeout", "temporarily")
FATAL = ("NOT_FOUND", "PERMISSION_DENIED", "UNAUTHENTICATED", "INVALID_ARGUMENT")


class NotFoundError(Exception):
    pass


class PermissionDeniedError(Exception):
    pass


class UnauthenticatedError(Exception):
    pass


class InvalidArgumentError(Exception):
    pass


FATAL_TYPES = (NotFoundError, PermissionDeniedError, UnauthenticatedError, InvalidArgumentError)


def chain(error: BaseException) -> list[BaseException]:
    out: list[BaseException] = []
    while error is not None and error not in out:
        out.append(error)
        error = error.__cause__ or error.__context__
    return out


def retryable(error: BaseException) -> bool:
    return any(word in str(e).lower() for e in chain(error) for word in RETRYABLE)


def fatal(error: BaseException) -> bool:
    return any(isinstance(e, FATAL_TYPES) or any(name in str(e) for name in FATAL) for e in chain(error))


def retryable_message(message: Column) -> Column:
    return message.rlike("(?i)" + "|".join(RETRYABLE))


def fatal_status(status: Column) -> Column:
    return status.isin(*FATAL)


class RetryPolicy:
    """Repeats a call on passing failures: waits 100 ms doubled up to 10 s with up to a quarter more, within a budget of time
    and at most 1000 attempts. Warns at the first failure and then every 15 s, telling how many it kept to itself."""

    FIRST_MS, MOST_MS, ATTEMPTS, QUIET_MS = 100, 10_000, 1000, 15_000

    def __init__(self, budget_ms: int, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep, warn: Callable[[str], None] = lambda _: None, rng: Callable[[], float] = random.random):
        self.budget_ms, self.clock, self.sleep, self.warn, self.rng = budget_ms, clock, sleep, warn, rng
        self.attempts = self.silent = 0
        self.warned_at: float | None = None

    def wait_ms(self, failures: int) -> float:
        base = min(self.FIRST_MS * 2 ** min(failures - 1, 20), self.MOST_MS)
        return base + base / 4 * self.rng()

    def _tell(self, error: BaseException) -> None:
        now = self.clock() * 1000
        if self.warned_at is None or now - self.warned_at >= self.QUIET_MS:
            self.warn(f"will try again after: {error}" + (f" ({self.silent} more not shown)" if self.silent else ""))
            self.warned_at, self.silent = now, 0
        else:
            self.silent += 1

    def run(self, call: Callable[[], R]) -> R:
        began, failures = self.clock() * 1000, 0
        while True:
            try:
                return call()
            except Exception as e:
                failures += 1
                wait = self.wait_ms(failures)
                if fatal(e) or not retryable(e) or failures >= self.ATTEMPTS or self.clock() * 1000 - began + wait > self.budget_ms:
                    raise
                self.attempts += 1
                self._tell(e)
                self.sleep(wait / 1000)
