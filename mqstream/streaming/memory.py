"""The memory budget of a gather, and the pauses when memory runs short."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from pathlib import Path
from typing import NamedTuple

MIB = 1 << 20
CEILING, HOST_RESERVE, HOUR_MS = 60, 512 * MIB, 3_600_000
SHRINK_AT, SHRINK_AFTER = 50, 2
GROW_BELOW, GROW_AFTER, GROW_FREE = 40, 8, 1024 * MIB
NEAR_AT, NEAR_AFTER = 35, 2
RESTORE_BELOW, RESTORE_FREE = 30, 1536 * MIB
FLOOR, LEAST_MOVE = 4 * MIB, MIB


def capped(batch_size: int, memory: int, part: int) -> int:
    """A fraction of memory, and not above a batch size that is set."""
    share = memory // part if memory > 0 else 0
    return min(x for x in (share, batch_size) if x > 0) if max(share, batch_size) > 0 else 0


def seed(batch_size: int, memory: int) -> int:
    return capped(batch_size, memory, 64)


def top(batch_size: int, memory: int) -> int:
    """The most a budget may climb to: within what the seed lets be outstanding."""
    start = seed(batch_size, memory)
    return max(start, min(capped(batch_size, memory, 32), 2 * start))


def opening_move(start: int) -> int:
    return max(start // 8, LEAST_MOVE)


@dataclass(frozen=True)
class Reading:
    """One gather: percent of memory used (-1 unknown), free host bytes, bytes gathered."""

    used_percent: int
    free: int
    gathered: int

    @property
    def hot(self) -> bool:
        return self.used_percent >= SHRINK_AT

    @property
    def cool(self) -> bool:
        return 0 <= self.used_percent < GROW_BELOW and self.free >= GROW_FREE

    @property
    def ample(self) -> bool:
        return 0 <= self.used_percent < RESTORE_BELOW and self.free >= RESTORE_FREE


class Streaks(NamedTuple):
    """How many gathers in a row were hot; were cool; and, of the cool ones, came near to not being so."""

    hot: int = 0
    calm: int = 0
    near: int = 0

    def after(self, r: Reading) -> Streaks:
        """A gather that got nothing is neither hot nor the end of a hot run."""
        calm = self.calm + 1 if r.cool else 0
        if r.gathered <= 0:
            return self._replace(calm=calm)
        if r.hot:
            return Streaks(hot=self.hot + 1)
        return Streaks(0, calm, self.near + (r.used_percent >= NEAR_AT) if r.cool else 0)


@dataclass(frozen=True)
class Budget:
    """The byte budget as it walks between FLOOR and ``ceiling``, by moves that halve as it turns or comes to the ceiling."""

    size: int
    ceiling: int
    move: int
    opening: int
    shrank: bool = False
    streaks: Streaks = Streaks()

    @staticmethod
    def start(batch_size: int, memory: int) -> Budget:
        first = seed(batch_size, memory)
        return Budget(first, top(batch_size, memory), opening_move(first), opening_move(first))

    def to(self, size: int) -> Budget:
        """A run of streaks ends here; a size that is another is remembered as a move."""
        if size == self.size:
            return replace(self, streaks=Streaks())
        return replace(self, size=size, move=max(abs(size - self.size), LEAST_MOVE), shrank=size < self.size, streaks=Streaks())

    def rise(self, ample: bool, near: int) -> int:
        """The remembered move. After a shrink, with the ceiling at hand or memory near its bound half of it; where memory is
        ample up to double, within the opening move."""
        if self.shrank or near >= NEAR_AFTER or self.ceiling - self.size <= 2 * self.move:
            return max(self.move // 2, LEAST_MOVE)
        return max(self.move, min(max(2 * self.move, LEAST_MOVE), self.opening)) if ample else self.move

    def after(self, r: Reading) -> Budget:
        streaks = self.streaks.after(r)
        if r.gathered > 0 and streaks.hot >= SHRINK_AFTER:
            return self.to(min(self.size, max(self.size - max(self.move // 2, LEAST_MOVE), FLOOR)))
        filled = 0 < 9 * self.size <= 10 * r.gathered
        if filled and not r.hot and streaks.calm >= GROW_AFTER and self.size < self.ceiling:
            return self.to(min(self.size + self.rise(r.ample, streaks.near), self.ceiling))
        return replace(self, streaks=streaks)


def paused(used: int, memory: int, free: int) -> str | None:
    """Why intake pauses, or None: process memory at its ceiling, or the host's reserve touched (-1 is unknown)."""
    full = memory > 0 and used > 0 and 100 * used >= CEILING * memory
    low = 0 <= free < HOST_RESERVE
    return {(True, True): "heap and host", (True, False): "heap", (False, True): "host"}.get((full, low))


def warning_due(last_ms: int | None, now_ms: int) -> bool:
    return last_ms is None or now_ms - last_ms >= HOUR_MS


def kib_of(text: str, field: str) -> int:
    """Bytes of a /proc field given in KiB; -1 if absent."""
    m = re.search(rf"^{field}:\s+(\d+)\s+kB", text, re.M)
    return int(m[1]) * 1024 if m else -1


def read_proc(path: str, field: str) -> int:
    try:
        return kib_of(Path(path).read_text(), field)
    except OSError:
        return -1


def resident() -> int:
    return read_proc("/proc/self/status", "VmRSS")


def available() -> int:
    return read_proc("/proc/meminfo", "MemAvailable")


def total() -> int:
    return read_proc("/proc/meminfo", "MemTotal")
