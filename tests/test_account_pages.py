"""Typed state of a group of accounts: few accesses to the state, bounded ones for a large one, and results of the document state."""

import random

import numpy as np
import pandas as pd

from ledgerline.streaming import fraud_stream as fs
from ledgerline.streaming.account_state import PAGE_ACCOUNTS, PAGE_MERCHANTS, PAGE_ROWS, AccountProcessor, Pages

DAY, MINUTE = 86_400_000_000, 60_000_000
FLAGS = ["transaction_id", "recent_count", "is_new_merchant", "is_late", "is_duplicate"]


class Variable:
    """A map, or a single value, that counts its accesses and notes the longest list it was given."""

    def __init__(self):
        self.data, self.calls, self.most = {}, 0, 0

    def _call(self, value=()):
        self.calls += 1
        self.most = max([self.most, *(len(v) for v in value if isinstance(v, list))])

    def get(self):
        return self.getValue(())

    def update(self, value):
        self.updateValue((), value)

    def getValue(self, key):
        self._call()
        return self.data.get(key)

    def updateValue(self, key, value):
        self._call(value)
        self.data[key] = value

    def removeKey(self, key):
        self._call()
        del self.data[key]


class Handle:
    def __init__(self):
        self.variables, self.timers = {}, []

    def getValueState(self, name, schema, ttlDurationMs=None):
        return self.variables.setdefault(name, Variable())

    def getMapState(self, name, key, value, ttlDurationMs=None):
        return self.variables.setdefault(name, Variable())

    def listTimers(self):
        return iter(self.timers)

    def registerTimer(self, at):
        self.timers.append(at)

    def calls(self):
        return sum(v.calls for v in self.variables.values())


class Clock:
    def __init__(self, mark=0, now=0):
        self.mark, self.now = mark, now

    def getCurrentWatermarkInMs(self):
        return self.mark

    def getCurrentProcessingTimeInMs(self):
        return self.now


class Document:
    """The state of ``applyInPandasWithState`` for a group."""

    hasTimedOut = False

    def __init__(self):
        self.value, self.mark, self.now = None, 0, 0

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        pass

    def getCurrentWatermarkMs(self):
        return self.mark

    def getCurrentProcessingTimeMs(self):
        return self.now


def frame(rows):
    """Rows of (id, account, minute, merchant)."""
    df = pd.DataFrame({c: [None] * len(rows) for c in fs.STATEFUL_FIELDS})
    df["transaction_id"], df["account_id"], df["merchant_id"] = ([r[i] for r in rows] for i in (0, 1, 3))
    df["created_at"] = pd.to_datetime(np.array([int(DAY * 100 + r[2] * MINUTE) for r in rows]), unit="us")
    return df


def processor(handle, **kw):
    one = AccountProcessor(fs.STATEFUL_FIELDS, **kw)
    one.init(handle)
    return one


def run(one, rows, clock=None):
    (out,) = one.handleInputRows((0,), iter([frame(rows)]), clock or Clock())
    return sorted(map(tuple, out[FLAGS].values.tolist()))


def test_a_group_of_accounts_is_read_and_written_in_pages():
    handle = Handle()
    rows = [(f"t{i}", f"a{i % 200}", i / 10, f"M{i % 30}") for i in range(4000)]
    got = run(processor(handle), rows)
    assert len(got) == 4000 and handle.calls() < 400  # it was some accesses for each row
    before = handle.calls()
    run(processor(handle), [(f"u{i}", f"a{i % 200}", 500 + i / 10, f"M{i % 30}") for i in range(4000)])
    assert handle.calls() - before < 400


def test_equals_the_document_state_over_many_batches():
    for seed in range(4):
        rng = random.Random(seed)
        horizon = {"dedupe_horizon_s": 12 * 3600, "watermark_s": 1800}
        handle, doc = Handle(), Document()
        typed, other = processor(handle, **horizon), fs.make_state_fn(grouped=True, **horizon)
        accounts = [None, "", *(f"a{i}" for i in range(120))]
        rows, sent, high = 0, [], 0
        for batch in range(12):
            now = [
                (f"t{rows + i}", rng.choice(accounts[1:3] if rng.random() < 0.6 else accounts), batch * 200 + rng.randint(-300, 300),
                 rng.choice([None, *(f"M{m}" for m in range(60))]))
                for i in range(rng.choice([1, 40, 900, 1500]))
            ]
            rows += len(now)
            now += rng.sample(sent, min(len(sent), 60)) + now[:5]
            sent += now
            doc.mark = high
            (want,) = other((0,), iter([frame(now)]), doc)
            got = run(typed, now, Clock(mark=high))
            assert got == sorted(map(tuple, want[FLAGS].values.tolist()))
            high = max(high, int(DAY * 100 + (max(r[2] for r in now) - 30) * MINUTE) // 1000)
        assert handle.variables["large"].calls  # the frequent accounts


def test_a_batch_of_a_row_costs_the_same_in_a_large_state():
    handle = Handle()
    first = processor(handle, dedupe_horizon_s=1)
    run(first, [(f"t{i}", "a", i / 1000, f"M{i}") for i in range(10_000)])  # an account with many merchants
    for k in range(5):
        run(first, [(f"u{k}-{i}", f"b{i % 300}", 60 + 60 * k + i / 1000, f"N{k}-{i}") for i in range(6000)])
    pages = [len(v[0]) for v in handle.variables["merchants"].data.values()]
    assert sum(pages) == 40_000 and max(pages) <= 2 * PAGE_MERCHANTS
    assert max(len(v[0]) for v in handle.variables["accounts"].data.values()) <= 2 * PAGE_ACCOUNTS
    before, merchants = handle.calls(), handle.variables["merchants"]
    merchants.most = 0
    got = run(processor(handle), [("x", "a", 999, "M17"), ("y", "a", 999, "new")])
    assert [r[2] for r in got] == [False, True]
    assert handle.calls() - before < 15 and merchants.most <= 2 * PAGE_MERCHANTS


def test_an_account_with_many_recent_rows_is_not_in_a_page():
    handle = Handle()
    one = processor(handle)
    run(one, [(f"t{i}", "busy", i / 1000, "M") for i in range(3000)] + [("q", "quiet", 1, "M")])
    lists = [x for v in handle.variables["accounts"].data.values() for x in v[4]]
    assert max(map(len, lists)) <= PAGE_ROWS and list(handle.variables["large"].data) == [("busy",)]
    again = run(one, [("t7", "busy", 0.007, "M"), ("z", "busy", 3, "M"), ("q", "quiet", 1, "M")])
    assert [(r[0], r[1], r[4]) for r in again] == [("q", 0, True), ("t7", 0, True), ("z", 3000, False)]
    run(one, [("later", "busy", 9000, "M")])
    assert not handle.variables["large"].data


def test_every_key_stays_in_its_page_as_the_pages_grow():
    keys = [(f"a{i % 50}", f"m{i}") for i in range(3000)]
    for n in range(1, 70):
        old = n - (1 << n.bit_length() - 1)
        for key in keys:
            before, after = Pages.place(key, n), Pages.place(key, n + 1)
            assert 0 <= before < n and (after == before or (after == n and before == old))


def test_a_merchant_is_forgotten_after_its_time_to_live():
    handle = Handle()
    one = processor(handle, merchant_ttl_s=20)
    run(one, [("0", "a", 0, "M1"), ("1", "a", 0, "M2")], Clock(now=1000))
    assert [r[2] for r in run(one, [("2", "a", 1, "M1")], Clock(now=20_999))] == [False]
    assert [r[2] for r in run(one, [("3", "a", 2, "M1"), ("4", "a", 2, "M2")], Clock(now=21_000))] == [False, True]


def test_a_timer_prunes_accounts_by_the_watermark():
    handle = Handle()
    one = processor(handle, sweep_ms=100)
    run(one, [(f"t{i}", f"a{i}", 0, "M") for i in range(100)], Clock(now=0))
    run(one, [("n", "young", 0, "M")], Clock(now=90))
    assert handle.timers == [100]
    two_days = (DAY * 102) // 1000
    list(one.handleExpiredTimer((0,), Clock(two_days, 100), None))
    left = [a for v in handle.variables["accounts"].data.values() for a in v[0]]
    assert left == ["young"] and handle.timers == [100, 200]
    list(one.handleExpiredTimer((0,), Clock(two_days, 200), None))
    assert not any(v[0] for v in handle.variables["accounts"].data.values()) and handle.timers == [100, 200]
    assert [r[2] for r in run(one, [("t0", "a0", 5000, "M")], Clock(two_days, 300))] == [False]  # merchants stay
