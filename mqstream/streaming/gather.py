"""Which messages form a micro-batch: three ways of gathering over an injected poll.

A gather that fails or is stopped gives back what it has taken."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from ..operators.admission import UNLIMITED, Limits
from .store import Message, newest, weight

#: Polls: an idle check, the wait of an immediate gather, and a drain's poll.
DEBOUNCE_MS = IMMEDIATE_MS = DRAIN_MS = 1000
IDLE_POLLS = 3


@dataclass
class Gathered:
    """Messages are kept as they were polled, so those of a queue are not looked up here."""

    polls: list[Sequence[Message]] = field(default_factory=list)
    given_back: list[Message] = field(default_factory=list)
    count: int = 0
    size: int = 0
    limit_reached: bool = False
    ran_dry: bool = False

    @property
    def messages(self) -> list[Message]:
        return [m for polled in self.polls for m in polled]

    def add(self, polled: Sequence[Message]) -> None:
        if polled:
            self.polls.append(polled)
            self.count += len(polled)
            self.size += weight(polled)


class Gather:
    """``poll(wait_ms, count)`` gives up to count messages, waiting for the first; ``give_back`` returns messages unread;
    ``hot`` says whether memory is at its ceiling; ``stop`` whether to abandon the gather."""

    def __init__(self, poll: Callable[[int, int], Sequence[Message]], give_back: Callable[[Sequence[Message]], None], clock_ms: Callable[[], int], hot: Callable[[], bool] = lambda: False, stop: Callable[[], bool] = lambda: False, keep: Callable[[Sequence[Message]], None] = lambda _: None):
        self.poll, self.give_back, self.clock_ms, self.hot, self.stop, self.keep = poll, give_back, clock_ms, hot, stop, keep

    def _take(self, out: Gathered, polled: Sequence[Message], limits: Limits) -> bool:
        """Add messages up to the caps; the rest goes back in order. True if a cap is reached."""
        if limits.reached(out.count + len(polled) - 1, out.size + weight(polled)):  # maybe before the last of them
            polled, size = list(polled), out.size
            for k, m in enumerate(polled):
                if limits.reached(out.count + k, size):
                    out.given_back += polled[k:]
                    self.give_back(polled[k:])
                    polled = polled[:k]
                    break
                size += m.size()
        out.add(polled)
        self.keep(polled)
        return limits.reached(out.count, out.size)

    def _room(self, out: Gathered, limits: Limits) -> int:
        return limits.max_rows - out.count if limits.max_rows != UNLIMITED else UNLIMITED

    def _return(self, out: Gathered) -> None:
        for polled in out.polls:
            self.give_back(polled)
        out.polls, out.count, out.size = [], 0, 0

    def _abandoned(self, out: Gathered) -> bool:
        if not self.stop():
            return False
        self._return(out)
        return True

    def run(self, limits: Limits, window_ms: int, mode: str = "batch", limit_ms: int | None = None) -> Gathered:
        if limit_ms is not None and not limits.drain:
            raise RuntimeError("limitTime is for draining reads only")
        out = Gathered()
        try:
            if limits.drain:
                self.until_idle(out, limits, limit_ms)
            elif mode == "immediate" and limits.min_rows <= 0:
                self._take(out, self.poll(min(window_ms, IMMEDIATE_MS), self._room(out, limits)), limits)
            else:
                self.until_deadline(out, limits, window_ms, limits.min_rows if mode == "immediate" else 0)
        except BaseException:
            self._return(out)
            raise
        return out

    def until_deadline(self, out: Gathered, limits: Limits, window_ms: int, min_rows: int = 0) -> None:
        """Until the window ends, a cap is reached, or the queue has run dry; an immediate gather also ends with min_rows."""
        deadline = self.clock_ms() + window_ms
        while not self._abandoned(out):
            left = deadline - self.clock_ms()
            if left <= 0 or limits.reached(out.count, out.size) or (min_rows and out.count >= min_rows):
                break
            if self.hot():
                if out.count:
                    break
                polled = self.poll(1, self._room(out, limits))
            else:
                polled = self.poll(left, self._room(out, limits))
            if not polled and not out.count:
                polled = self.poll(max(1, min(DEBOUNCE_MS, deadline - self.clock_ms())), self._room(out, limits))
                if not polled:
                    break
            if not polled and not min_rows:
                break
            self._take(out, polled, limits)

    def until_idle(self, out: Gathered, limits: Limits, limit_ms: int | None = None) -> None:
        """A drain: until three polls in a row are empty, a cap is reached, or a message at or past the limit shows up."""
        empty = 0
        while not self._abandoned(out):
            if limits.reached(out.count, out.size) or (self.hot() and out.count):
                break
            polled = self.poll(DRAIN_MS, self._room(out, limits))
            empty = 0 if polled else empty + 1
            if empty == IDLE_POLLS:
                out.ran_dry = True
                break
            if limit_ms is not None and polled and newest(polled) >= limit_ms:
                past = [m for m in polled if m.publish_ms >= limit_ms]
                self.give_back(past)
                out.given_back += past
                out.limit_reached = True
                polled = [m for m in polled if m.publish_ms < limit_ms]
            self._take(out, polled, limits)
            if out.limit_reached:
                break
