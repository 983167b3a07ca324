"""Stateful processors for the jobs the built-in streaming operators cannot express.

* ``CountWindowProcessor`` — per-key count windows (fire on every n-th row).
* ``LateSplitProcessor`` — tumbling windows that fire at their end and again
  for each late row, and route rows beyond the lateness to a side output.
* ``FirstVisitProcessor`` — flags a user's first visit of a day (stage 1 of
  the cumulative UV job), keyed by (app, uid bucket) to spread hot apps.
* ``DayTotalProcessor`` — per app, a running per-day total of the flags
  (stage 3 of the cumulative UV job).
* ``RunningMedianProcessor``, ``RunningCountProcessor`` — one row per input row.
* ``ClosingWindowProcessor``, ``BufferProcessor`` — processing-time windows and
  a write buffer, let go by timers.

State is bounded: windows are dropped when emitted, per-day state is cleared
by an event-time timer once the day can no longer receive rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle



def sorted_rows(rows: Iterator[pd.DataFrame], columns: list[str], by: str) -> Iterator[tuple]:
    """A key's rows of the micro-batch in order of ``by``: of each pandas block
    only ``columns`` are kept, as arrays, until the last block is read."""
    kept = [[b[c].to_numpy() for c in columns] for b in rows]
    arrays = [np.concatenate(c) for c in zip(*kept)]
    order = np.argsort(arrays[columns.index(by)], kind="stable")
    for i in order:
        yield tuple(a[i] for a in arrays)


class CountWindowProcessor(StatefulProcessor):
    """Emit ``(key, window_no, total)`` after every ``n`` rows of a key.

    Rows are ordered by ``seq`` inside a micro-batch. An incomplete tail is
    kept in state and never emitted.
    """

    def __init__(self, n: int = 5, key_col: str = "word", seq_col: str = "seq", value_col: str = "num"):
        self.n, self.key_col, self.seq_col, self.value_col = n, key_col, seq_col, value_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("acc", "cnt long, total long, windows long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        cnt, total, wins = self.state.get() if self.state.exists() else (0, 0, 0)
        out = []
        for _, v in sorted_rows(rows, [self.seq_col, self.value_col], self.seq_col):
            cnt, total = cnt + 1, total + int(v)
            if cnt == self.n:
                out.append((key[0], wins, total))
                cnt, total, wins = 0, 0, wins + 1
        self.state.update((int(cnt), int(total), int(wins)))
        if out:
            yield pd.DataFrame(out, columns=[self.key_col, "window_no", "total"])

    def close(self) -> None:
        pass


class LateSplitProcessor(StatefulProcessor):
    """Tumbling event-time windows with allowed lateness and a late side output, keyed by user.

    Input rows carry epoch-ms ``pay_time`` (the watermarked timestamp column
    must be dropped before this operator, otherwise Spark filters rows of
    still-open windows). A window fires when the watermark reaches its end
    (version 1), by a timer; each row that comes after that and before
    ``window_end + lateness`` fires it again with its new contents (versions
    2, 3, ...); at ``window_end + lateness`` its state goes, and later rows are
    late. A window's rows are single entries of its state (window, position),
    so a row is written once, however many come after it.
    Output: ``kind, user_id, window_start, window_end, n_orders, money, rows, version``.
    """

    COLS = ["kind", "user_id", "window_start", "window_end", "n_orders", "money", "rows", "version"]
    FIELDS = ["seq", "order_id", "user_id", "money", "pay_time"]

    def __init__(self, size_ms: int = 5000, lateness_ms: int = 0):
        self.size_ms, self.lateness_ms = size_ms, lateness_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "start long", "n long, money long, version long")
        self.rows = handle.getMapState("rows", "start long, at long", "row string")

    def fired(self, user: int, start: int, n: int, money: int, version: int) -> tuple:
        texts = (self.rows.getValue((start, at))[0] for at in range(n))
        return ("window", user, start, start + self.size_ms, n, money, "".join(f"{t}:" for t in texts), version)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        user, out, changed = int(key[0]), [], {}
        for _, order_id, user_id, money, pay_time in sorted_rows(rows, self.FIELDS, "seq"):
            t = int(pay_time)
            start = t - t % self.size_ms
            end = start + self.size_ms
            text = f"Order(orderId={order_id}, userId={int(user_id)}, money={int(money)}, payTime={t})"
            if end + self.lateness_ms <= wm:
                out.append(("late", user, start, end, 1, int(money), text, 0))
                continue
            if start not in changed:
                known = self.windows.containsKey((start,))
                changed[start] = tuple(map(int, self.windows.getValue((start,)))) if known else (0, 0, 0)
                if not known:
                    self.handle.registerTimer(end + self.lateness_ms)
                    if end > wm and self.lateness_ms:
                        self.handle.registerTimer(end)
            n, total, version = changed[start]
            if end <= wm and n and not version:  # its end has passed, its timer runs after these rows
                version = 1
                out.append(self.fired(user, start, n, total, version))
            self.rows.updateValue((start, n), (text,))
            n, total = n + 1, total + int(money)
            if end <= wm:
                version += 1
                out.append(self.fired(user, start, n, total, version))
            changed[start] = (n, total, version)
        for start, held in changed.items():
            self.windows.updateValue((start,), held)
        if out:
            yield pd.DataFrame(out, columns=self.COLS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, out = int(expiredTimerInfo.getExpiryTimeInMs()), []
        ended, over = at - self.size_ms, at - self.lateness_ms - self.size_ms
        for start in sorted({ended, over}):
            if self.windows.containsKey((start,)):
                n, money, version = map(int, self.windows.getValue((start,)))
                if not version:
                    version = 1
                    out.append(self.fired(int(key[0]), start, n, money, version))
                    self.windows.updateValue((start,), (n, money, version))
                if start == over:
                    self.windows.removeKey((start,))
                    for k in range(n):
                        self.rows.removeKey((start, k))
        if out:
            yield pd.DataFrame(out, columns=self.COLS)

    def close(self) -> None:
        pass


class TopNProcessor(StatefulProcessor):
    """The best ``n`` of a closed window's counts: pv desc, item id asc.

    The counts of a window leave the aggregation in the one micro-batch that
    closes it, so nothing is kept between batches; within one, a heap of
    ``n`` rows is. Output: ``window_end, rank, item_id, pv`` (and ``et``, the
    last instant of the window, for a stage that follows).
    """

    def __init__(self, n: int = 5, with_time: bool = True):
        self.n, self.with_time = n, with_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best: list[tuple[int, int]] = []
        for block in rows:
            best = heapq.nlargest(self.n, [*best, *zip(block["pv"].tolist(), (-block["item_id"]).tolist())])
        end = int(key[0])
        out = pd.DataFrame([(end, i + 1, -neg, pv) for i, (pv, neg) in enumerate(best)],
                           columns=["window_end", "rank", "item_id", "pv"])
        if self.with_time:
            out["et"] = pd.Timestamp(end - 1, unit="ms", tz="UTC")
        yield out

    def close(self) -> None:
        pass


class FirstVisitProcessor(StatefulProcessor):
    """Stage 1 of cumulative UV, keyed by ``(app_id, part_id, day_start, day_end)``.

    Emits every visit with ``flag`` 1 when it is the user's first that day,
    else 0. Spark's watermark is ``max - lag``, one more than the rule's (which
    drops a visit at or before its watermark less 1 ms): a visit is late when
    ``visit + 2 <= watermark``. One whose second has closed cannot be counted
    any more; it is dropped too, and does not make its user seen. Seen users
    of the day are cleared, all at once, by a timer at its end.
    Output: ``app_id, day_start, uid, visit_time, flag, et`` (``et`` = event time).
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "uid long", "flag int")
        self.open = handle.getValueState("open", "flag int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        out = []
        for t, uid in sorted_rows(rows, ["visit_time", "uid"], "visit_time"):
            t, uid = int(t), int(uid)
            last = t - t % 1000 + 999
            if t + 2 <= wm or last <= wm:
                continue
            if not self.open.exists():
                self.open.update((1,))
                self.handle.registerTimer(int(key[3]))
            flag = 0
            if not self.seen.containsKey((uid,)):
                self.seen.updateValue((uid,), (1,))
                flag = 1
            out.append((key[0], int(key[2]), uid, t, flag, pd.Timestamp(last, unit="ms", tz="UTC")))
        if out:
            yield pd.DataFrame(out, columns=["app_id", "day_start", "uid", "visit_time", "flag", "et"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        self.open.clear()
        return iter([])

    def close(self) -> None:
        pass


class DayTotalProcessor(StatefulProcessor):
    """Stage 3 of cumulative UV, keyed by ``app_id``: running total per day
    over the per-second flag sums. A day's total is cleared once its longest
    possible length (25 hours) has passed."""

    KEPT_MS = 25 * 3600 * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getMapState("totals", "day_start long", "total long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out = []
        for start, day, new_users in sorted_rows(rows, ["window_start", "day_start", "new_users"], "window_start"):
            k = (int(day),)
            total = int(self.totals.getValue(k)[0]) if self.totals.containsKey(k) else 0
            if total == 0 and not self.totals.containsKey(k):
                self.handle.registerTimer(int(day) + self.KEPT_MS + 1000)
            total += int(new_users)
            self.totals.updateValue(k, (total,))
            out.append((key[0], int(day), int(start), total))
        if out:
            yield pd.DataFrame(out, columns=["app_id", "day_start", "window_start", "day_uv"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        day = expiredTimerInfo.getExpiryTimeInMs() - self.KEPT_MS - 1000
        if self.totals.containsKey((int(day),)):
            self.totals.removeKey((int(day),))
        return iter([])

    def close(self) -> None:
        pass


class StateMap(dict):
    """A map state read entry by entry, as a store of a tree's nodes."""

    def __init__(self, state):
        self.state = state

    def __missing__(self, number: int) -> bytes:
        return bytes(self.state.getValue((number,))[0])

    def __setitem__(self, number: int, raw: bytes) -> None:
        self.state.updateValue((number,), (raw,))


class RunningMedianProcessor(StatefulProcessor):
    """Running median per key on a stream, one output row per input row.

    State is a search tree of values with counts, a map entry per node: a row
    reads and writes one node per level, so a micro-batch's work follows its
    rows, not the values seen before (``CountTree``; a key with a billion
    distinct values has five levels). Null and NaN values are ignored.
    Output: ``key, seq, value, median``.
    """

    def __init__(self, key_col: str = "user_id", seq_col: str = "seq", value_col: str = "value", width: int = 128):
        self.key_col, self.seq_col, self.value_col, self.width = key_col, seq_col, value_col, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tree = handle.getValueState("tree", "root long, made long")
        self.nodes = handle.getMapState("nodes", "number long", "node binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        from tidepool.operators.order_stats import CountTree

        root, made = map(int, self.tree.get()) if self.tree.exists() else (0, 0)
        tree = CountTree(StateMap(self.nodes), root, made, self.width)
        out = []
        for seq, x in sorted_rows(rows, [self.seq_col, self.value_col], self.seq_col):
            x = float("nan") if x is None else float(x)
            if x == x:
                tree.add(x)
            out.append((key[0], int(seq), x, tree.median()))
        tree.save()
        self.tree.update((tree.root, tree.made))
        yield pd.DataFrame(out, columns=[self.key_col, self.seq_col, self.value_col, "median"])

    def close(self) -> None:
        pass


class RunningCountProcessor(StatefulProcessor):
    """The changelog of a keyed count: one output row per input row, ``key, seq, cnt``, in order of ``seq``."""

    def __init__(self, key_col: str = "word", seq_col: str = "seq", out: str = "cnt"):
        self.key_col, self.seq_col, self.out = key_col, seq_col, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n = int(self.count.get()[0]) if self.count.exists() else 0
        seqs = np.sort(np.concatenate([b[self.seq_col].to_numpy() for b in rows]), kind="stable")
        self.count.update((n + len(seqs),))
        yield pd.DataFrame({self.key_col: [key[0]] * len(seqs), self.seq_col: seqs, self.out: np.arange(n + 1, n + len(seqs) + 1)})

    def close(self) -> None:
        pass


class ClosingWindowProcessor(StatefulProcessor):
    """Sums over sliding windows of processing time, each emitted once, by a timer at its end, with or without new input.

    A row belongs to the windows that hold the moment it is handled. Output:
    ``key, window_start, window_end, total``.
    """

    def __init__(self, key_col: str = "word", value_col: str = "num", size_ms: int = 5000, slide_ms: int = 1000, out: str = "total"):
        self.key_col, self.value_col, self.size_ms, self.slide_ms, self.out = key_col, value_col, size_ms, slide_ms, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.totals = handle.getMapState("totals", "start long", "total long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        total = sum(int(b[self.value_col].sum()) for b in rows)
        start = now - now % self.slide_ms
        while start > now - self.size_ms:
            before = 0
            if self.totals.containsKey((start,)):
                before = int(self.totals.getValue((start,))[0])
            else:
                self.handle.registerTimer(start + self.size_ms)
            self.totals.updateValue((start,), (before + total,))
            start -= self.slide_ms
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = int(expiredTimerInfo.getExpiryTimeInMs())
        start = end - self.size_ms
        if self.totals.containsKey((start,)):
            total = int(self.totals.getValue((start,))[0])
            self.totals.removeKey((start,))
            yield pd.DataFrame([(key[0], start, end, total)], columns=[self.key_col, "window_start", "window_end", self.out])

    def close(self) -> None:
        pass


class BufferProcessor(StatefulProcessor):
    """A write buffer that survives a restart: rows are held in state and let go together, once there are ``rows`` of
    them or ``wait_ms`` after the first came, by a timer that needs no new input. Output: ``k, v``."""

    def __init__(self, rows: int = 1000, wait_ms: int = 10_000):
        self.rows, self.wait_ms = rows, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "k string, v string")
        self.meta = handle.getValueState("meta", "n long, due long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, due = map(int, self.meta.get()) if self.meta.exists() else (0, 0)
        fresh = pd.concat([b[["k", "v"]] for b in rows])
        if n + len(fresh) >= self.rows:  # whole buffers go, the rest waits
            held = pd.DataFrame([tuple(r) for r in self.held.get()] if n else [], columns=["k", "v"])
            every = pd.concat([held, fresh])
            go = len(every) - len(every) % self.rows
            yield every[:go]
            if due:
                self.handle.deleteTimer(due)
            self.held.clear()
            fresh, n, due = every[go:], 0, 0
        if len(fresh):
            if not due:
                due = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
                self.handle.registerTimer(due)
            self.held.appendList([(k, v) for k, v in fresh.itertuples(index=False, name=None)])
            self.meta.update((n + len(fresh), due))
        else:
            self.meta.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.meta.exists() and int(self.meta.get()[1]) == int(expiredTimerInfo.getExpiryTimeInMs()):
            held = pd.DataFrame([tuple(r) for r in self.held.get()], columns=["k", "v"])
            self.held.clear()
            self.meta.clear()
            yield held

    def close(self) -> None:
        pass


class DayCountProcessor(StatefulProcessor):
    """Calendar-day counts per key for any zone, DST included.

    Input rows carry ``day_start, day_end`` (epoch ms, computed from the
    zone's rules upstream). Each open day keeps a count; a timer at the day's
    end emits ``(key, window_start, window_end, cnt)`` and clears it. Rows of
    a day that already closed are dropped, as a window drops late data.
    """

    def __init__(self, key_col: str = "key"):
        self.key_col = key_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day_start long", "day_end long, cnt long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        counts: dict[tuple[int, int], int] = {}
        for block in rows:
            for day, n in block.groupby(["day_start", "day_end"]).size().items():
                counts[day] = counts.get(day, 0) + n
        for (start, end), n in counts.items():
            start, end = int(start), int(end)
            if end <= wm:
                continue  # the day has closed
            k = (start,)
            if self.days.containsKey(k):
                _, cnt = self.days.getValue(k)
            else:
                cnt = 0
                self.handle.registerTimer(end)
            self.days.updateValue(k, (end, int(cnt) + int(n)))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        out = []
        for k in list(self.days.keys()):
            d_end, cnt = self.days.getValue(k)
            if int(d_end) == end:
                out.append((key[0], int(k[0]), end, int(cnt)))
                self.days.removeKey((int(k[0]),))
        if out:
            yield pd.DataFrame(out, columns=[self.key_col, "window_start", "window_end", "cnt"])

    def close(self) -> None:
        pass
