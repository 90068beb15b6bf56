"""Control algorithms with a clock in hand."""

import random
from dataclasses import replace

import pytest

from mqstream.operators.admission import UNLIMITED, Limits, ReadLimit, fits, min_positive
from mqstream.streaming import memory
from mqstream.streaming.broker import Message
from mqstream.streaming.errors import NotFoundError, RetryPolicy, fatal, retryable
from mqstream.streaming.gather import Gather
from mqstream.streaming.pacing import RESERVE_RULES, SECOND, Cycle, Pace, Phase, ReceiveTuner, agreed_gap, finished, named_second, observed, probed, rate, tail_reserve, whole_second


MINUTE = 60 * SECOND


def learned(*gaps, hint=None):
    """The pace after empty cycles with these gaps."""
    pace = Pace.start(None, "batch")
    for g in gaps:
        pace = probed(pace, g, hint)
    return pace


def after(pace, *cycles):
    for c in cycles:
        pace = finished(pace, c)
    return pace


def ended(pace, work, commit=None, length=None, messages=10):
    """A cycle that receives for its window and then works."""
    commit = work if commit is None else commit
    return Cycle(max(pace.interval, pace.receive + work) if length is None else length, pace.receive, commit, messages)


@pytest.mark.parametrize("gaps, hint, want", [
    ((MINUTE, MINUTE), None, (Phase.WARMUP, MINUTE, 30 * SECOND, 29 * SECOND)),
    ((20 * SECOND, MINUTE), None, (Phase.WARMUP, MINUTE, 30 * SECOND, 29 * SECOND)),  # a partial first gap
    ((50 * SECOND, MINUTE), None, (Phase.PROBE, 0, 0, 0)),
    ((50 * SECOND, MINUTE, 59 * SECOND), None, (Phase.WARMUP, 59 * SECOND, 59 * SECOND // 2, 59 * SECOND - 59 * SECOND // 2 - SECOND)),
    ((5 * SECOND, 9 * SECOND), None, (Phase.PROBE, 0, 0, 0)),
    ((42 * SECOND,), 30 * SECOND, (Phase.WARMUP, 30 * SECOND, 15 * SECOND, 14 * SECOND)),
    ((SECOND // 10,) * 2, None, (Phase.PROBE, 0, 0, 0)),
    ((SECOND // 10,) * 3, None, (Phase.ZERO, 0, SECOND, 0)),
])
def test_gaps_tell_the_interval(gaps, hint, want):
    p = learned(*gaps, hint=hint)
    assert (p.phase, p.interval, p.receive, p.reserve) == want


def test_windows():
    assert ReceiveTuner(receive_ms=5000).window() == 5 * SECOND
    assert ReceiveTuner(gather_mode="immediate").window() == SECOND
    assert ReceiveTuner(receive_ms=5000).window(2 * SECOND) == 2 * SECOND
    assert Pace.start(None, "batch").window() == SECOND
    assert [p.lease_ms() for p in (Pace.start(None, "batch"), learned(MINUTE, MINUTE), learned(15 * SECOND, 15 * SECOND))] == [180_000, 180_000, 60_000]


def test_unused_time_lets_the_window_climb():
    p = learned(MINUTE, MINUTE)
    q = after(p, ended(p, SECOND // 2))
    assert q.phase is Phase.CRUISE and p.receive < q.receive <= MINUTE - q.reserve
    # A quarter of what was unused, down to the top quarter; then three hundredths of the interval.
    assert q.receive - p.receive == (MINUTE - p.receive - SECOND // 2) // 4 == p.reserve - q.reserve
    high = after(q, *[ended(q, SECOND // 2)] * 20)
    assert high.receive >= 45 * SECOND and after(high, ended(high, SECOND // 2)).receive - high.receive <= MINUTE * 3 // 100


def test_a_late_cycle_sets_more_aside():
    p = learned(MINUTE, MINUTE)
    q = after(p, ended(p, 45 * SECOND, 35 * SECOND))
    assert q.reserve == p.reserve + 15 * SECOND and q.receive == MINUTE - q.reserve and q.tails == ()


def test_tails_are_remembered_once_receiving_is_high():
    p = replace(learned(MINUTE, MINUTE), receive=50 * SECOND, reserve=9 * SECOND)
    q = after(p, ended(p, 20 * SECOND, SECOND))
    assert q.tails == (20 * SECOND,) and q.reserve == p.reserve + MINUTE * 3 // 100 and q.receive == MINUTE - q.reserve
    for _ in range(12):
        q = after(q, ended(replace(q, receive=50 * SECOND), 20 * SECOND, SECOND))
    assert len(q.tails) == 8 and q.receive >= 15 * SECOND


def test_a_doubtful_interval_is_probed_again_once():
    p = learned(20 * SECOND, 20 * SECOND)
    q = after(p, Cycle(MINUTE, 10 * SECOND, SECOND, 5))
    assert q.phase is Phase.PROBE and q.interval == 0
    p = probed(probed(q, 20 * SECOND), 20 * SECOND)
    assert after(p, Cycle(MINUTE, 10 * SECOND, SECOND, 5)).phase is Phase.CRUISE
    p = learned(MINUTE, MINUTE)
    assert after(p, Cycle(3 * MINUTE, 10 * SECOND, SECOND, 5)).phase is Phase.CRUISE  # long enough not to be doubted


def test_lengths_teach_the_interval():
    p = learned(20 * SECOND, 20 * SECOND)
    q = after(p, Cycle(45 * SECOND))
    assert (q.interval, q.stretched) == (45 * SECOND, True) and after(q, Cycle(90 * SECOND)).interval == 45 * SECOND
    p = learned(MINUTE, MINUTE)
    steady = [Cycle(62 * SECOND + k * SECOND // 20) for k in (-2, -1, 0, 1, 2, 1, 0, -1)]
    once = after(p, *steady)
    assert (once.interval, once.candidate) == (MINUTE, 62 * SECOND)
    twice = after(once, *steady)
    assert twice.interval == 62 * SECOND and twice.certain and after(twice, *[Cycle(70 * SECOND)] * 16).interval == 62 * SECOND
    assert after(once, *steady[:7], Cycle(63 * SECOND), *steady).certain is False


def test_every_cycle_keeps_the_bounds():
    draw = random.Random(2)
    for _ in range(300):
        p = learned(*[draw.choice([12, 30, 60, 300]) * SECOND] * 2)
        for _ in range(30):
            cycle = ended(p, draw.randrange(2 * p.interval), messages=draw.choice([0, 9])) if draw.random() < 0.8 else Cycle(draw.randrange(1, 3 * p.interval))
            p = finished(p, cycle)
            if p.phase is Phase.PROBE:
                break
            assert 0 <= p.receive <= p.interval and len(p.tails) <= 8 and len(p.lengths) < 8
            assert cycle.commit is None or cycle.receive <= 0 or p.receive >= p.interval // 4
    assert RESERVE_RULES[-1][0](None)


def test_the_tuner_keeps_the_time():
    now = [SECOND]
    t = ReceiveTuner(clock=lambda: now[0])
    asked = []
    for _ in range(3):
        asked.append(t.probing())
        now[0] += MINUTE
    assert asked == [True, True, False] and t.pace == learned(MINUTE, MINUTE)
    want, begun = t.pace, None
    for work in (0, 3, 40, 2):
        if begun is not None:
            want = finished(want, Cycle(now[0] - begun, *last))
        assert t.probing() is False and t.pace == want
        begun = now[0]
        now[0] += t.window()
        t.gathered(t.window(), 7)
        now[0] += SECOND
        t.committed()
        last = (now[0] - SECOND - begun, SECOND, 7)
        now[0] = max(begun + MINUTE, now[0] + work * SECOND)


def test_whole_and_named_seconds():
    assert [whole_second(x * SECOND // 1000) for x in (59_999, 60_600, 59_899, 0)] == [60 * SECOND, 60 * SECOND, 59 * SECOND, 0]
    assert named_second(60 * SECOND + SECOND // 20) == 60 * SECOND
    assert named_second(60 * SECOND + SECOND // 2) is None


def test_gap_agreement_rates_and_tails():
    assert agreed_gap((60, 58)) == 58 and agreed_gap((30, 60)) == 60 and agreed_gap((50, 60)) is None and agreed_gap((60,)) is None
    assert rate(10, 2 * SECOND) == 5 and rate(0, SECOND) == 0 and rate(5, 0) == 0
    assert tail_reserve((SECOND,)) == SECOND and tail_reserve((SECOND, 3 * SECOND)) == 3 * SECOND and tail_reserve((0, 60 * SECOND, 2 * SECOND)) == 4 * SECOND


def test_intake_is_judged_by_the_hour():
    def told(*seen):
        hour, said = None, []
        for at, age, interval in seen:
            hour, warning = observed(hour, at, age, interval)
            said.append(warning and warning.split(":")[0])
        return said

    hour = 3_600_000
    assert told((0, 1000, 500), (1000, 9000, 500), (hour, 2000, 500), (2 * hour, 1500, 500), (3 * hour, 400, 500)) == [None, None, "falling behind", "lagging", None]
    assert told((0, 1000, 500), (1000, 500, 500), (hour, 900, 500)) == [None] * 3  # once it kept up
    assert told((0, 1000, 0), (hour, 1000, 0)) == [None, None]  # no interval is known


def test_budget_walk():
    b = memory.Budget.start(0, 64 << 30)
    assert (b.size, b.ceiling, b.move) == (1 << 30, 2 << 30, 1 << 27)
    hot = b.after(memory.Reading(55, 2 << 30, 1)).after(memory.Reading(55, 2 << 30, 1))
    assert hot.size == b.size - b.move // 2 and hot.shrank
    grown = b
    for _ in range(8):
        grown = grown.after(memory.Reading(38, 2 << 30, b.size))
    assert grown.size > b.size
    idle = hot.after(memory.Reading(10, 2 << 30, 0))
    assert idle.size == hot.size


def test_pauses_and_proc():
    assert memory.paused(60, 100, 1 << 40) == "heap" and memory.paused(1, 100, 1) == "host" and memory.paused(70, 100, 1) == "heap and host"
    assert memory.paused(10, 100, -1) is None
    assert memory.kib_of("MemTotal:  12 kB\nMemAvailable:   7 kB\n", "MemAvailable") == 7168
    assert memory.kib_of("", "VmRSS") == -1
    assert memory.resident() > 0


def test_retry_and_classes():
    calls = []

    def fails():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("UNAVAILABLE: later")
        return "done"

    now = [0.0]
    policy = RetryPolicy(60_000, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s), rng=lambda: 0.0)
    assert policy.run(fails) == "done" and policy.attempts == 2 and now[0] == pytest.approx(0.3)
    with pytest.raises(NotFoundError):
        policy.run(lambda: (_ for _ in ()).throw(NotFoundError("NOT_FOUND: x")))
    assert retryable(RuntimeError("Deadline exceeded")) and not retryable(RuntimeError("bad"))
    try:
        raise RuntimeError("wrapped") from NotFoundError("gone")
    except RuntimeError as e:
        assert fatal(e)


def test_retry_stops_at_its_budget():
    now = [0.0]
    policy = RetryPolicy(1000, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s), rng=lambda: 0.0)
    with pytest.raises(RuntimeError):
        policy.run(lambda: (_ for _ in ()).throw(RuntimeError("timeout")))
    assert now[0] <= 1.0


def test_limits():
    assert min_positive(0, None, -1) == UNLIMITED and min_positive(5, 3, 0) == 3
    x = Limits.of(10, 0, ReadLimit(parts=(ReadLimit(max_rows=4, min_rows=2), ReadLimit(min_rows=3, max_delay_ms=250))), 500)
    assert (x.max_rows, x.max_bytes, x.min_rows, x.wait_ms) == (4, UNLIMITED, 3, 250)
    assert x.with_budget(9).max_bytes == 9 and x.with_budget(0).max_bytes == UNLIMITED
    assert fits(0, 100, 1) and not fits(1, 100, 50) and fits(40, 10, 50) and not fits(50, 0, 50) and not fits(-1, 1, 5)


class Queue:
    def __init__(self, polls):
        self.polls, self.now, self.back = list(polls), 0, []

    def poll(self, wait, count):
        found = self.polls.pop(0) if self.polls else []
        self.now += 10 if found else wait
        if len(found) > count:
            self.polls.insert(0, found[count:])
        return found[:count]

    def gather(self):
        return Gather(self.poll, self.back.extend, lambda: self.now)


def some(n, size=1, ms=0):
    return [Message(f"m{k}", b"x" * size, publish_ms=ms + k) for k in range(n)]


def test_batch_gather_runs_until_dry_or_capped():
    q = Queue([some(3), some(2)])
    assert len(q.gather().run(Limits(), 5000).messages) == 5
    q = Queue([some(3), some(2)])
    assert len(q.gather().run(Limits(max_rows=4), 5000).messages) == 4
    q = Queue([some(5, 10)])
    out = q.gather().run(Limits(max_bytes=25), 5000)
    assert len(out.messages) == 3 and len(q.back) == 2  # the message that crosses the cap is in
    q = Queue([])
    assert q.gather().run(Limits(), 5000).messages == []


def test_immediate_gather():
    q = Queue([some(3), some(2)])
    assert len(q.gather().run(Limits(), 5000, "immediate").messages) == 3
    q = Queue([some(3), some(2), some(4)])
    assert len(q.gather().run(Limits(min_rows=5), 60_000, "immediate").messages) == 5


def test_drain_needs_three_empty_polls_in_a_row():
    q = Queue([some(1), [], [], some(1), [], [], [], some(9)])
    assert len(q.gather().run(Limits(drain=True), 1).messages) == 2


def test_drain_ends_at_the_limit():
    q = Queue([[Message("a", publish_ms=1000), Message("b", publish_ms=1500), Message("c", publish_ms=2000)]])
    out = q.gather().run(Limits(drain=True), 1, limit_ms=2000)
    assert [m.messageid for m in out.messages] == ["a", "b"] and [m.messageid for m in q.back] == ["c"] and out.limit_reached
    with pytest.raises(RuntimeError):
        q.gather().run(Limits(), 1, limit_ms=2000)


def test_a_failed_gather_gives_everything_back():
    q = Queue([some(3)])
    polls = iter([lambda: q.polls.pop(0), lambda: 1 // 0])
    g = Gather(lambda wait, count: next(polls)(), q.back.extend, lambda: q.now)
    with pytest.raises(ZeroDivisionError):
        g.run(Limits(), 5000)
    assert len(q.back) == 3


def test_an_abandoned_gather_gives_everything_back():
    q = Queue([some(3), some(2)])
    stops = iter([False, True])
    g = Gather(q.poll, q.back.extend, lambda: q.now, stop=lambda: next(stops))
    assert g.run(Limits(), 5000).messages == [] and len(q.back) == 3
