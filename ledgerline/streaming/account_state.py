"""Per-account stream state in typed variables (STR3, STR4, STR7): the alternative to one JSON document a group of accounts.

A key is a group of accounts, as a call for a key and each access to a variable
cost some tenths of a millisecond, whatever they move.  ``accounts`` has the
recent past of each account: the event times that can still count towards a
velocity, and recent transaction ids with their event times.  ``merchants`` has
every merchant of an account with its last event time.  Both are maps of pages
(``Pages``), of which a batch reads and writes those that its rows' keys fall
in: an account with 100,000 merchants costs a batch what the batch's own rows
cost.  An account with many recent rows has an entry of its own in ``large``.

Merchants have a time to live, after which an entry that no row renewed is
forgotten, and a page without any by the state store itself; ids older than
their horizon in event time go by a timer.

Results equal those of ``fraud_stream.make_state_fn``, with which it shares the
definition of a late row, a duplicate, a new merchant and a velocity.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .. import config as C


class Pages:
    """A key's entries in a map state, some hundred to a page; a hash of an entry's first ``keys`` fields says which.

    When a page has more than ``most`` entries, there is one page more, that
    takes its part of one other page's entries (linear hashing): no page is far
    larger than ``most`` however many entries there are, and growing costs a
    batch no more than its own rows.
    """

    def __init__(self, handle: StatefulProcessorHandle, name: str, fields: dict[str, str], keys: int, most: int, ttl_ms: int | None = None):
        self.count = handle.getValueState(f"{name}_pages", "n int")
        columns = ", ".join(f"{k} array<{v}>" for k, v in fields.items())
        self.pages = handle.getMapState(name, "page int", columns, ttlDurationMs=ttl_ms)
        self.width, self.keys, self.most = len(fields), keys, most

    @staticmethod
    def place(key: tuple, n: int) -> int:
        """The page, of ``n``, of a key."""
        size = 1 << (n - 1).bit_length()
        page = crc32("\0".join(x or "" for x in key).encode()) & (size - 1)
        return page if page < n else page - size // 2

    def load(self, page: int) -> dict[tuple, tuple]:
        saved = self.pages.getValue((page,))  # none: all its entries have outlived their time
        return {row[: self.keys]: row[self.keys :] for row in zip(*saved)} if saved is not None else {}

    def save(self, page: int, entries: dict[tuple, tuple]) -> None:
        columns = [list(c) for c in zip(*(k + v for k, v in entries.items()))]
        self.pages.updateValue((page,), tuple(columns or [[] for _ in range(self.width)]))

    def size(self) -> int:
        n = self.count.get()
        return n[0] if n else 0

    def visit(self, keys: Iterable[tuple]) -> Iterator[tuple[list[tuple], dict[tuple, tuple]]]:
        """The pages of ``keys``, one at a time: those keys, and all entries, written as the caller leaves them."""
        keys = list(keys)
        had = self.size()
        n = had or max(1, 3 * len(keys) // (2 * self.most))
        found: dict[int, list[tuple]] = {} if had else {page: [] for page in range(n)}
        for key in keys:
            found.setdefault(self.place(key, n), []).append(key)
        more = 0
        for page, own in found.items():
            entries = self.load(page) if had else {}
            yield own, entries
            self.save(page, entries)
            more += max(0, len(entries) - 1) // self.most
        for new in range(n, n + more):
            old = new - (1 << new.bit_length() - 1)
            entries = self.load(old)
            moved = {k: v for k, v in entries.items() if self.place(k, new + 1) == new}
            self.save(old, {k: v for k, v in entries.items() if k not in moved})
            self.save(new, moved)
        if n + more != had:
            self.count.update((n + more,))


#: Accounts and merchants to a page, and recent rows of an account in a page of several.
PAGE_ACCOUNTS, PAGE_MERCHANTS, PAGE_ROWS = 32, 512, 512
#: An account's recent past: when a timer may prune it, whether it is in ``large``, event times, ids, and theirs.
ACCOUNT = {"account": "string", "due": "bigint", "large": "boolean", "times": "array<bigint>", "ids": "array<string>", "at": "array<bigint>"}


class AccountProcessor(StatefulProcessor):
    def __init__(
        self,
        fields: list[str],
        window_s: int = C.VELOCITY_WINDOW_SECONDS,
        dedupe_horizon_s: int = 86400,
        watermark_s: int = 600,
        merchant_ttl_s: int | None = None,
        sweep_ms: int = 3_600_000,
    ):
        self.fields, self.sweep_ms, self.merchant_ttl_s = fields, sweep_ms, merchant_ttl_s
        self.window, self.horizon, self.delay = window_s * 1_000_000, dedupe_horizon_s * 1_000_000, watermark_s * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ttl = self.merchant_ttl_s * 1000 if self.merchant_ttl_s else None
        self.accounts = Pages(handle, "accounts", ACCOUNT, 1, PAGE_ACCOUNTS)
        self.large = handle.getMapState("large", "account string", "times array<bigint>, ids array<string>, at array<bigint>")
        seen = {"account": "string", "merchant": "string", "us": "bigint"}
        self.merchants = Pages(handle, "merchants", {**seen, "written": "bigint"} if self.ttl else seen, 2, PAGE_MERCHANTS, self.ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        pdf = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        accounts = [a if isinstance(a, str) else None for a in pdf["account_id"].tolist()]
        us = pdf["created_at"].to_numpy().astype("datetime64[us]").astype("int64")
        ids, at = pdf["transaction_id"].tolist(), us.tolist()
        order = sorted(range(len(pdf)), key=lambda i: (accounts[i] is not None, accounts[i] or "", at[i], ids[i]))
        pdf, us = pdf.take(order), us[order]
        accounts, ids = ([x[i] for i in order] for x in (accounts, ids))
        mark, now = max(0, int(timer_values.getCurrentWatermarkInMs())) * 1000, timer_values.getCurrentProcessingTimeInMs()
        cuts = [0, *(i for i in range(1, len(ids)) if accounts[i] != accounts[i - 1]), len(ids)]
        spans = {(accounts[lo],): (lo, hi) for lo, hi in zip(cuts, cuts[1:])}
        live, recent = np.zeros(len(ids), bool), np.zeros(len(ids), "int32")
        for own, entries in self.accounts.visit(spans):
            for account in own:
                lo, hi = spans[account]
                due, was_large, times, seen = self._past(account, entries.get(account, (now + self.sweep_ms, False, [], [], [])))
                for i in range(lo, hi):
                    if ids[i] not in seen:
                        seen[ids[i]], live[i] = int(us[i]), True
                current = us[lo:hi][live[lo:hi]]
                times = np.sort(np.concatenate([np.array(times, "int64"), current]))
                recent[lo:hi][live[lo:hi]] = np.searchsorted(times, current, side="left") - np.searchsorted(
                    times, current - self.window, side="right"
                )
                top = int(times[-1]) if len(times) else 0
                since = max(mark, top - self.delay)
                self._keep(entries, account, due, was_large, times[times > since - self.window].tolist(), seen, top)
        late = live & (us < mark) & (mark > 0)
        is_new = self._meet(accounts, pdf["merchant_id"].tolist(), us, live, now)
        if not any(True for _ in self.handle.listTimers()):
            self.handle.registerTimer(now + self.sweep_ms)
        yield pdf[self.fields].assign(recent_count=recent, is_new_merchant=is_new, is_late=late, is_duplicate=~live)

    def _past(self, account: tuple, entry: tuple) -> tuple[int, bool, list[int], dict[str, int]]:
        due, large, *rest = entry
        times, ids, at = self.large.getValue(account) if large else rest
        return due, large, times, dict(zip(ids, at))

    def _keep(self, entries: dict, account: tuple, due: int, was_large: bool, times: list[int], seen: dict[str, int], top: int) -> None:
        """An account's times, and its ids within the horizon before ``top``; an account without any has no entry."""
        seen = {one: at for one, at in seen.items() if at > top - self.horizon}
        rest = times, list(seen), list(seen.values())
        large = len(times) + len(seen) > PAGE_ROWS
        if large:
            self.large.updateValue(account, rest)
        elif was_large:
            self.large.removeKey(account)
        if times or seen:
            entries[account] = (due, large, *(([], [], []) if large else rest))
        else:
            entries.pop(account, None)

    def _meet(self, accounts: list, merchant_ids: list, us: np.ndarray, live: np.ndarray, now: int) -> np.ndarray:
        """Which rows are their account's first at their merchant."""
        is_new = np.zeros(len(accounts), bool)
        met: dict[tuple, tuple[int, int]] = {}  # the batch's own ones: first row, and last time, as rows are in order of time
        for i in np.flatnonzero(live).tolist():
            if isinstance(merchant_ids[i], str):
                pair = (accounts[i], merchant_ids[i])
                met[pair] = met[pair][0] if pair in met else i, int(us[i])
        for own, entries in self.merchants.visit(met):
            if self.ttl:
                for pair in [p for p, (_, written) in entries.items() if written + self.ttl <= now]:
                    del entries[pair]
            for pair in own:
                first, last = met[pair]
                is_new[first] = pair not in entries
                if pair in entries:
                    last = max(last, entries[pair][0])
                entries[pair] = (last, now) if self.ttl else (last,)
        return is_new

    def handleExpiredTimer(self, key, timer_values, expired) -> Iterator[pd.DataFrame]:
        """Accounts whose last pruning is a while ago: their ids and times go by the watermark."""
        mark, now = max(0, int(timer_values.getCurrentWatermarkInMs())) * 1000, timer_values.getCurrentProcessingTimeInMs()
        left = False
        for page in range(self.accounts.size()):
            entries = self.accounts.load(page)
            old = [account for account, (due, *_) in entries.items() if due <= now]
            for account in old:
                _, was_large, times, seen = self._past(account, entries[account])
                kept = [t for t in times if t > mark - self.window]
                self._keep(entries, account, now + self.sweep_ms, was_large, kept, seen, mark)
            if old:
                self.accounts.save(page, entries)
            left = left or bool(entries)
        if left:
            self.handle.registerTimer(now + self.sweep_ms)
        return iter(())

    def close(self) -> None:
        pass
