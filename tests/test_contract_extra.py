"""Registered queries without an SQL oracle, checked against brute force on the driver tables."""

import os
from collections import defaultdict

import duckdb
import pytest

from eventide.plans import contract as C

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_order_deadline_all_matches_state_machine(spark):
    rows = duckdb.sql(f"""
        SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, epoch_us(ts) AS us, event_type
        FROM '{SF}/events.parquet' WHERE event_type IN ('signup', 'purchase')""").fetchall()
    w = 86_400_000_000
    by_key = defaultdict(list)
    for r in rows:
        by_key[(r[1], r[2])].append(r)
    exp = []
    for key, evs in by_key.items():
        evs.sort(key=lambda r: (r[3], r[0]))
        paid, timers = False, {}

        def fire_before(t):
            nonlocal paid
            for due in sorted(x for x in timers if x < t):
                s = timers.pop(due)
                if paid:
                    paid = False
                else:
                    exp.append(s)
        for event_id, _u, _k, us, kind in evs:
            fire_before(us)
            if kind == "signup" and not paid:
                timers.setdefault(us + w, event_id)
            elif kind == "purchase":
                paid = True
        fire_before(float("inf"))
    got = sorted(r.event_id for r in C.order_deadline_all(spark, SF).collect())
    assert got == sorted(exp)
    assert len(got) > 1000
