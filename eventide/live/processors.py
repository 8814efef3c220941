"""Keyed stateful detectors on unbounded DataFrames (``transformWithStateInPandas``).

A micro-batch hands a key all its new rows at once, and event-time timers
only fire after the batch's rows were handled. The reference's processors
instead interleave each event with the timers that fall before it. To get
the same answers as the batch operators, every processor here is an
*event-time replay*: rows are buffered in list state until the watermark
passes them, then fed to a small per-key state machine in (event time,
tie-break) order, firing the machine's own timers between them. The replay
runs up to the current watermark, so it only ever consumes rows that can no
longer be preceded by a new one; one wake-up timer per key (rounded up to
the millisecond) triggers it.

Machines keep their state as one typed struct in value state. Buffered rows
are typed too: a map state keyed by (time slice, part) holds arrays of rows,
so a wake-up reads and removes the slices that are due and leaves the others
alone. State that can no longer matter (``Machine.expires``) is dropped by the
watermark, which is the time to live that event time allows.

Late rows (behind the watermark) are dropped by Spark before they reach the
processor, as the reference drops rows behind a closed window.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from ..functions.time import duration_us
from ..functions.udfs import Top2


def _ceil_ms(us: int) -> int:
    return -(-int(us) // 1000)


# ------------------------------------------------------------------ machines

class Machine:
    """Per-key state machine over rows (dicts with ``t_us``, ``t_tb`` and the carried columns).

    ``fields`` is the DDL of the state ``s``, with ``{tb}`` for the tie-break's
    type; structs inside arrays are tuples.
    """

    fields = ""

    def __init__(self, state: dict | None = None):
        self.s = state or self.initial()

    def initial(self) -> dict:
        return {}

    def on_event(self, row: dict) -> list[dict]:
        return []

    def on_timer(self, due: int) -> list[dict]:
        return []

    def pending(self) -> list[int]:
        return []

    def expires(self) -> int | None:
        """Time from which on no later row can need the state."""
        return None


class BurstMachine(Machine):
    """Fails counted from the first one; every event arms a timer at ts + within; a timer drains
    the count and reports the first fail when there was more than one."""

    fields = "first_us BIGINT, first_tb {tb}, n BIGINT, timers ARRAY<BIGINT>"

    def __init__(self, within_us: int, fail_col: str, state=None):
        self.w, self.fail_col = within_us, fail_col
        super().__init__(state)

    def initial(self):
        return {"first_us": None, "first_tb": None, "n": 0, "timers": []}

    def on_event(self, row):
        if row[self.fail_col]:
            if not self.s["n"]:
                self.s.update(first_us=row["t_us"], first_tb=row["t_tb"])
            self.s["n"] += 1
        if row["t_us"] + self.w not in self.s["timers"][-1:]:  # rows come in order, so timers do
            self.s["timers"].append(row["t_us"] + self.w)
        return []

    def pending(self):
        return self.s["timers"]

    def on_timer(self, due):
        first, tb, n = self.s["first_us"], self.s["first_tb"], self.s["n"]
        self.s = dict(self.initial(), timers=[t for t in self.s["timers"] if t != due])
        return [{"t_tb": tb, "t_us": first, "fails_in_burst": n}] if n > 1 else []


class ConsecutiveFailMachine(Machine):
    """Newest fail kept; a success clears it; a fail less than ``within`` after it warns."""

    fields = "last_us BIGINT, last_tb {tb}"

    def __init__(self, within_us: int, fail_col: str, state=None):
        self.w, self.fail_col = within_us, fail_col
        super().__init__(state)

    def initial(self):
        return {"last_us": None, "last_tb": None}

    def on_event(self, row):
        last, tb = self.s["last_us"], self.s["last_tb"]
        if not row[self.fail_col]:
            self.s = self.initial()
            return []
        self.s = {"last_us": row["t_us"], "last_tb": row["t_tb"]}
        if last is None or row["t_us"] >= last + self.w:
            return []
        return [{"first_tb": tb, "second_tb": row["t_tb"], "first_us": last, "second_us": row["t_us"]}]

    def expires(self):
        return None if self.s["last_us"] is None else self.s["last_us"] + self.w


class FollowedByMachine(Machine):
    """Open starts wait for the next end; a start expires ``within`` after it (strict)."""

    fields = "open ARRAY<STRUCT<us: BIGINT, tb: {tb}>>"

    def __init__(self, within_us: int, start_col: str, end_col: str, state=None):
        self.w, self.start_col, self.end_col = within_us, start_col, end_col
        super().__init__(state)

    def initial(self):
        return {"open": []}

    def _result(self, start, end, outcome):
        return {"start_tb": start[1], "start_us": start[0],
                "end_tb": end["t_tb"] if end else None, "end_us": end["t_us"] if end else None, "outcome": outcome}

    def on_event(self, row):
        out = []
        if row[self.end_col]:
            for s in self.s["open"]:
                ok = row["t_us"] - s[0] < self.w
                out.append(self._result(s, row if ok else None, "success" if ok else "timeout"))
            self.s["open"] = []
        elif row[self.start_col]:
            self.s["open"].append((row["t_us"], row["t_tb"]))
        return out

    def pending(self):
        return sorted({us + self.w for us, _ in self.s["open"]})

    def on_timer(self, due):
        late = [s for s in self.s["open"] if s[0] + self.w <= due]
        self.s["open"] = [s for s in self.s["open"] if s[0] + self.w > due]
        return [self._result(s, None, "timeout") for s in late]


class DeadlineMachine(Machine):
    """Paid flag; a start while unpaid arms a timer at start + within; a firing
    timer clears the flag if paid, else alerts."""

    fields = "paid BOOLEAN, starts ARRAY<STRUCT<us: BIGINT, tb: {tb}>>"

    def __init__(self, within_us: int, start_col: str, end_col: str, state=None):
        self.w, self.start_col, self.end_col = within_us, start_col, end_col
        super().__init__(state)

    def initial(self):
        return {"paid": False, "starts": []}

    def on_event(self, row):
        if row[self.start_col] and not self.s["paid"]:
            if all(us != row["t_us"] for us, _ in self.s["starts"][-1:]):  # one timer per time
                self.s["starts"].append((row["t_us"], row["t_tb"]))
        elif row[self.end_col]:
            self.s["paid"] = True
        return []

    def pending(self):
        return [us + self.w for us, _ in self.s["starts"]]

    def on_timer(self, due):
        fired = [x for x in self.s["starts"] if x[0] + self.w == due]
        self.s["starts"] = [x for x in self.s["starts"] if x[0] + self.w != due]
        if not fired:
            return []
        if self.s["paid"]:
            self.s["paid"] = False
            return []
        return [{"start_tb": fired[0][1], "start_us": fired[0][0], "msg": "order timeout"}]


DAY_US = 86_400_000_000


class QuotaMachine(Machine):
    """Daily per-key counter: max_count + 1 rows pass, the next one alerts once."""

    fields = "day BIGINT, count BIGINT, alerted BOOLEAN"

    def __init__(self, max_count: int, state=None, carry: list[str] | None = None):
        self.max = max_count
        self.carry = carry or []
        super().__init__(state)

    def initial(self):
        return {"day": None, "count": 0, "alerted": False}

    def _out(self, row, outcome):
        return {"t_tb": row["t_tb"], "t_us": row["t_us"], "outcome": outcome, **{c: row[c] for c in self.carry}}

    def on_event(self, row):
        day = row["t_us"] // DAY_US
        if day != self.s["day"]:
            self.s.update(day=day, count=0, alerted=False)
        if self.s["count"] > self.max:
            if not self.s["alerted"]:
                self.s["alerted"] = True
                return [self._out(row, "blocked_first")]
            return []
        self.s["count"] += 1
        return [self._out(row, "pass")]

    def expires(self):
        return None if self.s["day"] is None else (self.s["day"] + 1) * DAY_US


class ChangelogMachine(Machine):
    """Running count with retractions: (False, c-1) then (True, c) per row."""

    fields = "c BIGINT"

    def initial(self):
        return {"c": 0}

    def on_event(self, row):
        self.s["c"] += 1
        c = self.s["c"]
        out = [{"t_tb": row["t_tb"], "is_add": False, "cnt": c - 1}] if c > 1 else []
        return out + [{"t_tb": row["t_tb"], "is_add": True, "cnt": c}]


class MatchMachine(Machine):
    """Two feeds on one key: each row pairs with the oldest waiting row of the
    other side, else waits ``wait`` after its own time and is reported unmatched."""

    fields = "L ARRAY<STRUCT<us: BIGINT, tb: {tb}>>, R ARRAY<STRUCT<us: BIGINT, tb: {tb}>>"

    def __init__(self, wait_us: int, side_col: str, state=None):
        self.wait, self.side_col = wait_us, side_col
        super().__init__(state)

    def initial(self):
        return {"L": [], "R": []}

    def on_event(self, row):
        side = row[self.side_col]
        other = "R" if side == "L" else "L"
        if self.s[other]:
            own, met = row["t_tb"], self.s[other].pop(0)[1]
            return [{"l_tb": own if side == "L" else met, "r_tb": met if side == "L" else own, "outcome": "matched"}]
        self.s[side].append((row["t_us"], row["t_tb"]))
        return []

    def pending(self):
        return sorted({us + self.wait for us, _ in self.s["L"] + self.s["R"]})

    def on_timer(self, due):
        out = []
        for side, col, tag in (("L", "l_tb", "left_only"), ("R", "r_tb", "right_only")):
            out += [{"l_tb": None, "r_tb": None, col: tb, "outcome": tag} for us, tb in self.s[side] if us + self.wait <= due]
            self.s[side] = [x for x in self.s[side] if x[0] + self.wait > due]
        return out


class OverMachine(Machine):
    """Over-window aggregates per row, emitted in event-time order (N4-N8 on streams).

    ``frame``: 'range_unbounded', 'rows_unbounded', ('range', preceding_us)
    or ('rows', n). Bounded frames keep only the rows they can still need.
    Rows tied on time under a RANGE frame see each other: they are released
    together once the next, later row (or the watermark) passes.
    """

    fields = ("cnt BIGINT, sum DOUBLE, recent ARRAY<STRUCT<us: BIGINT, v: DOUBLE>>, "
              "tied ARRAY<STRUCT<us: BIGINT, tb: {tb}>>")

    def __init__(self, frame, value_col: str, state=None):
        self.kind, self.size = frame if isinstance(frame, (tuple, list)) else (frame, None)
        self.value_col = value_col
        super().__init__(state)

    def initial(self):
        return {"cnt": 0, "sum": 0.0, "recent": [], "tied": []}

    def on_event(self, row):
        v = float(row[self.value_col] or 0.0)
        if self.kind == "rows_unbounded":
            self.s["cnt"] += 1
            self.s["sum"] += v
            return [self._row(row["t_us"], row["t_tb"])]
        if self.kind == "rows":
            self.s["recent"] = (self.s["recent"] + [(row["t_us"], v)])[-(self.size + 1):]
            self._sum_recent()
            return [self._row(row["t_us"], row["t_tb"])]
        out = self._release() if self.s["tied"] and self.s["tied"][0][0] != row["t_us"] else []
        if self.kind == "range":
            self.s["recent"].append((row["t_us"], v))
        else:
            self.s["cnt"] += 1
            self.s["sum"] += v
        self.s["tied"].append((row["t_us"], row["t_tb"]))
        return out

    def _row(self, us, tb):
        return {"t_tb": tb, "t_us": us, "cnt": self.s["cnt"], "total": self.s["sum"]}

    def _sum_recent(self):
        self.s["cnt"], self.s["sum"] = len(self.s["recent"]), float(sum(v for _, v in self.s["recent"]))

    def _release(self):
        tied, self.s["tied"] = self.s["tied"], []
        if tied and self.kind == "range":
            self.s["recent"] = [r for r in self.s["recent"] if r[0] >= tied[0][0] - self.size]
            self._sum_recent()
        return [self._row(us, tb) for us, tb in tied]

    def pending(self):
        return [us for us, _ in self.s["tied"][:1]]

    def on_timer(self, due):
        return self._release()

    def expires(self):
        return self.s["recent"][-1][0] + self.size if self.kind == "range" and self.s["recent"] else None


class RowWindowMachine(Machine):
    """Count windows of n rows every ``step`` rows (step == n: tumbling, only full groups)."""

    fields = "rn BIGINT, recent ARRAY<BIGINT>"

    def __init__(self, n: int, step: int, state=None):
        self.n, self.step = n, step
        super().__init__(state)

    def initial(self):
        return {"rn": 0, "recent": []}

    def on_event(self, row):
        self.s["rn"] += 1
        rn, rec = self.s["rn"], (self.s["recent"] + [row["t_us"]])[-self.n:]
        self.s["recent"] = [] if self.step == self.n and rn % self.n == 0 else rec
        if rn % self.step:
            return []
        return [{"end_row": rn, "first_us": rec[0], "last_us": rec[-1], "cnt": len(rec)}]


class Top2Machine(Machine):
    """Table aggregate on a stream: after each row, the current (value, rank) pairs
    as a changelog (retract the old pair, add the new one when it changed)."""

    fields = "top ARRAY<DOUBLE>, seen BOOLEAN"

    def __init__(self, value_col: str, state=None):
        self.value_col, self.best = value_col, Top2()
        super().__init__(state)

    def initial(self):
        return {"top": self.best.create(), "seen": False}

    def on_event(self, row):
        x = row[self.value_col]
        if x is None:
            return []
        new, out = self.best.merge(self.s["top"], [float(x)]), []
        for rank, (old_v, new_v) in enumerate(zip(self.s["top"], new), start=1):
            if old_v != new_v or not self.s["seen"]:
                if self.s["seen"]:
                    out.append({"t_tb": row["t_tb"], "is_add": False, "temp": old_v, "rank": rank})
                out.append({"t_tb": row["t_tb"], "is_add": True, "temp": new_v, "rank": rank})
        self.s.update(top=new, seen=True)
        return out


# ------------------------------------------------------------------ processor

#: Width of a slice of buffered rows: what a wake-up reads beyond the rows that are due.
SLICE_US = 60_000_000


class EventTimeReplay(StatefulProcessor):
    """Buffers a key's rows until the watermark passes them, then replays them
    through ``machine_factory(state)`` in (``t_us``, ``t_tb``) order.

    Each input call writes one map entry per time slice of its rows, without
    reading any; a replay reads the slices that have begun, removes them and
    writes back what is not due of the last one. A single wake-up timer per
    call (earliest buffered row, machine timer or expiry) triggers it, and a
    call with nothing due reads the machine's state only.
    """

    def __init__(self, machine_factory, key_cols: list[str], out_cols: list[str], row_schema: T.StructType,
                 state_schema: T.StructType, time_out: str | None = None):
        self.machine_factory = machine_factory
        self.key_cols = key_cols
        self.out_cols = out_cols
        self.row_schema = row_schema
        self.state_schema = state_schema
        self.time_out = time_out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        rows = T.StructType([T.StructField("rows", T.ArrayType(self.row_schema))])
        self.buffer = handle.getMapState("buffer", "slice BIGINT, part BIGINT", rows)
        self.clock = handle.getValueState("clock", "first_us BIGINT, parts BIGINT")  # earliest buffered row
        self.state = handle.getValueState("machine", self.state_schema)

    def _put(self, rows: list[tuple], parts: int) -> int:
        slices: dict[int, list[tuple]] = {}
        for r in rows:
            slices.setdefault(r[0] // SLICE_US, []).append(r)
        for n, (at, part) in enumerate(sorted(slices.items())):
            self.buffer.updateValue((at, parts + n), (part,))
        return parts + len(slices)

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        first, parts = self.clock.get() if self.clock.exists() else (None, 0)
        due = None
        for pdf in rows:
            columns = [_values(pdf[f.name], f.dataType) for f in self.row_schema.fields]
            new = list(zip(*columns))
            if new:
                due = min(r[0] for r in new) if due is None else min(due, min(r[0] for r in new))
                parts = self._put(new, parts)
        if due is not None:
            self.clock.update((due if first is None else min(first, due), parts))
            self.handle.registerTimer(_ceil_ms(due))
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        # Every row at or before the watermark is final, so the replay runs up
        # to the watermark (not just to this timer) and fires the machine's
        # timers that fall before it in the same pass.
        horizon = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000
        first, parts = self.clock.get() if self.clock.exists() else (None, 0)
        st = self.state.get() if self.state.exists() else None
        names = self.state_schema.names
        m = self.machine_factory({n: _plain(v) for n, v in zip(names, st)} if st else None)
        due_rows = first is not None and first <= horizon
        ready = []
        if due_rows:
            ready, first, parts = self._take(horizon, parts)
        out = []
        for r in ready:
            row = dict(zip(self.row_schema.names, r))
            for due in [t for t in m.pending() if t < row["t_us"]]:
                out += m.on_timer(due)
            out += m.on_event(row)
        for due in [t for t in m.pending() if t <= horizon]:
            out += m.on_timer(due)
        expiry = m.expires()
        if expiry is not None and expiry <= horizon:
            m.s, expiry = m.initial(), None
        if m.s == m.initial():
            self.state.clear()          # nothing to remember for this key
        else:
            self.state.update(tuple(m.s[n] for n in names))
        if due_rows:
            self.clock.clear() if first is None else self.clock.update((first, parts))
        wake = [t for t in (first, expiry, *m.pending()[:1]) if t is not None]
        if wake:
            self.handle.registerTimer(_ceil_ms(min(wake)))
        if not out:
            return iter([])
        kv = dict(zip(self.key_cols, key if isinstance(key, tuple) else (key,)))
        rows = [{**kv, **o} for o in out]
        # objects, as a column of integers with a null among them would pass through floating point
        pdf = pd.DataFrame([[r.get(c) for c in self.out_cols] for r in rows], columns=self.out_cols, dtype=object)
        if self.time_out:
            pdf[self.time_out] = pd.to_datetime(pdf["t_us"].astype("int64"), unit="us", utc=True)
        return iter([pdf])

    def _take(self, horizon: int, parts: int) -> tuple[list[tuple], int | None, int]:
        """Due rows in order, the earliest time that stays, and the next part number."""
        ready, later, first = [], [], None
        for at, part in [tuple(k) for k in self.buffer.keys()]:
            if at * SLICE_US > horizon:
                first = at * SLICE_US if first is None else min(first, at * SLICE_US)
                continue
            for r in self.buffer.getValue((at, part))[0]:
                (ready if r[0] <= horizon else later).append(tuple(r))
            self.buffer.removeKey((at, part))
        if later:
            parts = self._put(later, parts)
            first = min(r[0] for r in later)
        ready.sort(key=lambda r: (r[0], r[1] is not None, 0 if r[1] is None else r[1]))
        return ready, first, parts

    def close(self) -> None:
        pass


def _plain(value):
    return [tuple(x) if isinstance(x, tuple) else x for x in value] if isinstance(value, list) else value


def _values(column: pd.Series, kind: T.DataType) -> list:
    """Python values; NULL is None, whatever pandas makes of it, and integers travel as text (see ``replay``)."""
    if isinstance(kind, T.IntegralType) and column.dtype == object:
        return [None if x is None else int(x) for x in column]
    return [None if x is None or x != x else x for x in column.tolist()]


def replay(stream: DataFrame, keys, ts: str, tiebreak: str, machine_factory, out_schema: T.StructType,
           carry: list[str], time_out: str | None = None) -> DataFrame:
    """Run ``machine_factory`` per key over a watermarked stream (append output).

    ``carry`` lists the input columns the machine reads (besides time and
    tie-break). Output columns: ``out_schema`` (key columns first). With
    ``time_out`` the output also gets that TIMESTAMP column (from the
    machine's ``t_us``) declared as its event time, so a further windowed
    aggregation can follow under the same watermark.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    tb = stream.schema[tiebreak].dataType
    row_schema = T.StructType([T.StructField("t_us", T.LongType()), T.StructField("t_tb", tb)]
                              + [T.StructField(c, stream.schema[c].dataType) for c in carry])

    def text(c):  # pandas would turn integers with a NULL among them into floating point
        whole = isinstance(stream.schema[c].dataType, T.IntegralType)
        return F.col(c).cast("string") if whole else F.col(c)

    inp = stream.where(F.col(ts).isNotNull()).select(
        *keys, F.unix_micros(F.col(ts)).alias("t_us"), text(tiebreak).alias("t_tb"),
        *[text(c).alias(c) for c in carry if c not in keys], F.col(ts))
    state_schema = T._parse_datatype_string(machine_factory(None).fields.format(tb=tb.simpleString()))
    proc = EventTimeReplay(machine_factory, keys, [f.name for f in out_schema.fields], row_schema, state_schema, time_out)
    if time_out:
        out_schema = T.StructType(list(out_schema.fields) + [T.StructField(time_out, T.TimestampType())])
    return (inp.groupBy(*keys)
               .transformWithStateInPandas(statefulProcessor=proc, outputStructType=out_schema,
                                           outputMode="Append", timeMode="EventTime",
                                           eventTimeColumnName=time_out or ""))


def _schema(keys_schema: list[T.StructField], extra: str) -> T.StructType:
    return T.StructType(keys_schema + list(T._parse_datatype_string(extra).fields))


def _key_fields(df: DataFrame, keys) -> list[T.StructField]:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return [df.schema[k] for k in keys]


# ------------------------------------------------------------------ detectors

def burst_stream(df, key, ts, is_fail: str, within, tiebreak):
    """D1 on a stream: first fail of each drained group of two or more."""
    w = duration_us(within)
    tb_type = df.schema[tiebreak].dataType.simpleString()
    sch = _schema(_key_fields(df, key), f"t_tb {tb_type}, t_us BIGINT, fails_in_burst BIGINT")
    d = df.withColumn("is_fail", F.expr(is_fail) if isinstance(is_fail, str) else is_fail)
    return replay(d, key, ts, tiebreak, lambda s: BurstMachine(w, "is_fail", s), sch, ["is_fail"])


def consecutive_fail_stream(df, key, ts, is_fail, within, tiebreak):
    """D2/D3 on a stream."""
    w = duration_us(within)
    tb_type = df.schema[tiebreak].dataType.simpleString()
    sch = _schema(_key_fields(df, key), f"first_tb {tb_type}, second_tb {tb_type}, first_us BIGINT, second_us BIGINT")
    d = df.withColumn("is_fail", F.expr(is_fail) if isinstance(is_fail, str) else is_fail)
    return replay(d, key, ts, tiebreak, lambda s: ConsecutiveFailMachine(w, "is_fail", s), sch, ["is_fail"])


def followed_by_stream(df, key, ts, start, end, within, tiebreak):
    """D4 on a stream: success / timeout per start."""
    w = duration_us(within)
    tb_type = df.schema[tiebreak].dataType.simpleString()
    sch = _schema(_key_fields(df, key),
                  f"start_tb {tb_type}, start_us BIGINT, end_tb {tb_type}, end_us BIGINT, outcome STRING")
    d = (df.withColumn("is_start", F.expr(start) if isinstance(start, str) else start)
           .withColumn("is_end", F.expr(end) if isinstance(end, str) else end))
    return replay(d, key, ts, tiebreak, lambda s: FollowedByMachine(w, "is_start", "is_end", s), sch, ["is_start", "is_end"])


def deadline_stream(df, key, ts, start, end, within, tiebreak):
    """D5 on a stream: 'order timeout' per fired, unpaid timer."""
    w = duration_us(within)
    tb_type = df.schema[tiebreak].dataType.simpleString()
    sch = _schema(_key_fields(df, key), f"start_tb {tb_type}, start_us BIGINT, msg STRING")
    d = (df.withColumn("is_start", F.expr(start) if isinstance(start, str) else start)
           .withColumn("is_end", F.expr(end) if isinstance(end, str) else end))
    return replay(d, key, ts, tiebreak, lambda s: DeadlineMachine(w, "is_start", "is_end", s), sch, ["is_start", "is_end"])


def quota_stream(df, keys, ts, max_count, tiebreak, time_out: str | None = None, carry: list[str] | None = None):
    """D6/D7 on a stream: rows tagged 'pass' or 'blocked_first'.

    ``carry`` input columns are passed through to the output rows; with
    ``time_out`` the rows carry their event time under that name, so the
    passing rows can feed a windowed count (D8, ``quota_then_sliding_count``).
    """
    carry = list(carry or [])
    tb_type = df.schema[tiebreak].dataType.simpleString()
    extra = "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in carry)
    sch = _schema(_key_fields(df, keys), f"t_tb {tb_type}, t_us BIGINT, outcome STRING{extra}")
    return replay(df, keys, ts, tiebreak, lambda s: QuotaMachine(max_count, s, carry), sch, carry, time_out)


def quota_then_sliding_count(df, keys, ts, max_count, tiebreak, count_keys, size, slide):
    """D8 on a stream: quota filter per key, then a sliding count of the passing
    rows by ``count_keys`` (chained stateful operators under one watermark)."""
    from . import windows as SW
    keys = [keys] if isinstance(keys, str) else list(keys)
    count_keys = [count_keys] if isinstance(count_keys, str) else list(count_keys)
    carry = [c for c in count_keys if c not in keys]
    tagged = quota_stream(df, keys, ts, max_count, tiebreak, time_out="event_time", carry=carry)
    passed = tagged.where(F.col("outcome") == "pass")
    return SW.sliding_count(passed, "event_time", count_keys, size, slide)


def changelog_stream(df, key, ts, tiebreak):
    """K11 on a stream: retract/add rows of a running count per key."""
    tb_type = df.schema[tiebreak].dataType.simpleString()
    sch = _schema(_key_fields(df, key), f"t_tb {tb_type}, is_add BOOLEAN, cnt BIGINT")
    return replay(df, key, ts, tiebreak, lambda s: ChangelogMachine(s), sch, [])


def match_stream(left, right, key, ts, tiebreak, wait):
    """J1/J2 on streams: union with a side tag, pair per key in event order,
    report rows unmatched ``wait`` after their own time."""
    w = duration_us(wait)
    cols = [key, ts, tiebreak] if isinstance(key, str) else [*key, ts, tiebreak]
    u = left.select(*cols, F.lit("L").alias("side")).unionByName(right.select(*cols, F.lit("R").alias("side")))
    tb_type = left.schema[tiebreak].dataType.simpleString()
    sch = _schema(_key_fields(left, key), f"l_tb {tb_type}, r_tb {tb_type}, outcome STRING")
    return replay(u, key, ts, tiebreak, lambda s: MatchMachine(w, "side", s), sch, ["side"])


def over_stream(df, key, ts, value: str, tiebreak, frame):
    """Over-window count and sum per row on a stream, released in event-time order.

    ``frame`` as in ``OverMachine``; durations for ('range', d) are parsed.
    """
    if isinstance(frame, tuple) and frame[0] == "range":
        frame = ("range", duration_us(frame[1]))
    tb_type = df.schema[tiebreak].dataType.simpleString()
    sch = _schema(_key_fields(df, key), f"t_tb {tb_type}, t_us BIGINT, cnt BIGINT, total DOUBLE")
    return replay(df, key, ts, tiebreak, lambda s: OverMachine(frame, value, s), sch, [value])


def row_windows_stream(df, key, ts, tiebreak, n: int, step: int | None = None):
    """A10 / A12 on a stream: count windows of n rows (every ``step`` rows)."""
    step = step or n
    sch = _schema(_key_fields(df, key), "end_row BIGINT, first_us BIGINT, last_us BIGINT, cnt BIGINT")
    return replay(df, key, ts, tiebreak, lambda s: RowWindowMachine(n, step, s), sch, [])


def top2_stream(df, key, ts, value: str, tiebreak):
    """G4 on a stream: changelog of the (value, rank) rows of the top-2 table aggregate."""
    tb_type = df.schema[tiebreak].dataType.simpleString()
    sch = _schema(_key_fields(df, key), f"t_tb {tb_type}, is_add BOOLEAN, temp DOUBLE, rank INT")
    return replay(df, key, ts, tiebreak, lambda s: Top2Machine(value, s), sch, [value])
