"""Streams whose files arrive shuffled, late, twice and corrected."""

import datetime as dt
import os
import random

import pandas as pd
import pytest

from tideline.operators import upsert
from tideline.streaming import feeds

START = dt.datetime(2025, 3, 1)


def land(place, frames):
    """A file for each frame; their times of change are a second apart, as streams read them in that order."""
    os.makedirs(place, exist_ok=True)
    for k, frame in enumerate(frames):
        path = f"{place}/part-{k:03d}.parquet"
        frame.to_parquet(path, index=False, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))


def half_hour_rows(seed):
    """(key, slot): keys with holes; key 3 stops early, key 4 has one row, key 5 every slot many times."""
    rng = random.Random(seed)
    slots = {1: [s for s in range(400) if s % 37 > 3], 2: [s for s in range(400) if rng.random() < 0.8], 3: [s for s in range(120) if s % 50], 4: [200], 5: [s for s in range(400) for _ in range(5)]}
    return [(k, s) for k, some in slots.items() for s in some]


def batch_twin(rows, now, silence):
    """Final holes and silences of whole tables. now and silence in slots; a hole is final when it ends by now."""
    out = set()
    for k in {k for k, _ in rows}:
        slots = sorted({s for j, s in rows if j == k})
        out |= {(k, "hole", a + 1, b) for a, b in zip(slots, slots[1:]) if b > a + 1 and b <= now}
        if slots[-1] + 1 + silence <= now:
            out.add((k, "silent", slots[-1] + 1, None))
    return out


@pytest.mark.parametrize("seed,files", [(1, 1), (2, 7), (3, 12)])
def test_final_outages_do_not_depend_on_arrival(spark, tmp_path, seed, files):
    """Rows shuffled within the lateness, over several files: late ones shrink, split and close holes that were open."""
    rows = half_hour_rows(seed)
    rng = random.Random(seed)
    arrived = sorted(rows, key=lambda r: r[1] + rng.uniform(0, 90))  # less than two days of slots
    arrived.sort(key=lambda r: r[1] == 399)  # the newest last, so that the watermark ends where the twin's does
    size = -(-len(arrived) // files)
    frames = [pd.DataFrame({"key": [k for k, _ in part], "ts": [START + dt.timedelta(minutes=30 * s, seconds=7) for _, s in part]}) for part in (arrived[i : i + size] for i in range(0, len(arrived), size))]
    land(str(tmp_path / "in"), frames)
    own = feeds.state_session(spark)
    stream = feeds.file_stream(own, str(tmp_path / "in"), "part", "key long, ts timestamp_ntz", 1)
    found = feeds.collect_append(feeds.final_outages(stream, "key", "ts", "2 days", 3 * 86_400), "key long, kind string, start_ts timestamp_ntz, end_ts timestamp_ntz").collect()
    slot = lambda t: None if t is None else int((t - START) / dt.timedelta(minutes=30))
    got = [(r.key, r.kind, slot(r.start_ts), slot(r.end_ts)) for r in found]
    assert len(got) == len(set(got)) and set(got) == batch_twin(rows, 399 - 96, 144)


def test_a_keys_state_grows_with_its_holes_only():
    """Half-hours in any order, many times over, are held as runs."""
    import numpy as np

    rng = np.random.default_rng(1)
    begins = ends = np.array([], np.int64)
    for _ in range(20):
        times = rng.permutation(np.repeat(np.arange(1000) * 1800, 3))
        begins, ends = feeds._merged(np.concatenate([begins, times]), np.concatenate([ends, times + 1800]))
    assert begins.tolist() == [0] and ends.tolist() == [1_800_000]
    begins, ends = feeds._merged(np.array([3600, 0, 9000]), np.array([5400, 1800, 9100]))
    assert list(zip(begins.tolist(), ends.tolist())) == [(0, 1800), (3600, 5400), (9000, 9100)]


class Held:
    """State and timers of one group, with the calls that they get."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def registerTimer(self, t):
        self.calls += 1
        self.timers.add(t)

    def deleteTimer(self, t):
        self.calls += 1
        self.timers.remove(t)


def test_a_bucket_costs_few_calls():
    """Keys of a bucket are settled together, whatever their number and runs; holes and silences are told once (F2)."""
    from types import SimpleNamespace

    rng = random.Random(4)
    rows = [(k, s) for k in range(300) for s in range(200) if rng.random() < 0.6]
    rows += [(k, 0) for k in range(300)]
    arrived = sorted(rows, key=lambda r: (r[1] + rng.uniform(0, 40), r[0]))
    held, told, size = Held(), [], -(-len(arrived) // 5)
    outages = feeds.Outages(20 * 1800)
    outages.init(held)
    now = 0
    run = lambda frames: told.extend(r for f in frames for r in f.itertuples(index=False, name=None))
    for part in (arrived[i : i + size] for i in range(0, len(arrived), size)):
        clock = SimpleNamespace(getCurrentWatermarkInMs=lambda now=now: now * 1800 * 1000)
        frame = pd.DataFrame({"key": [k for k, _ in part], "epoch": [s * 1800 for _, s in part]})
        run(outages.handleInputRows((0,), iter([frame[:700], frame[700:]]), clock))
        now = max(now, max(s for _, s in part) - 40)
        for t in [t for t in held.timers if t <= now * 1800 * 1000]:
            clock = SimpleNamespace(getCurrentWatermarkInMs=lambda now=now: now * 1800 * 1000)
            run(outages.handleExpiredTimer((0,), clock, None))
            held.timers.remove(t)
    assert held.calls <= 5 * 8
    got = [(k, kind, a // 1800, None if z == feeds.NO_END else z // 1800) for k, kind, a, z in told]
    holes = [r for r in got if r[1] == "hole"]
    assert len(got) == len(set(got)) and set(holes) == {r for r in batch_twin(rows, now, 20) if r[1] == "hole"}
    assert {r for r in batch_twin(rows, now, 20) if r[1] == "silent"} <= set(got)


def test_late_rows_go_aside(spark, tmp_path):
    """Late rows once each, corrections within the bound, duplicates, and a replayed micro-batch that is routed as before."""
    day = lambda d: START + dt.timedelta(days=d)
    frame = lambda rows: pd.DataFrame({"k": [r[0] for r in rows], "ts": [day(r[1]) for r in rows], "v": [r[2] for r in rows], "n": [r[3] for r in rows]})
    files = [
        [(1, 0, 10, 0), (2, 5, 20, 0), (3, 20, 30, 0)],  # nothing is late yet
        [(4, 1, 40, 1), (2, 5, 21, 1), (5, 19, 50, 1)],  # bound: day 20 - 7
        [(4, 1, 40, 2), (4, 1, 41, 2), (5, 19, 51, 2), (6, 30, 60, 2)],  # a duplicate, another late value, a correction
        [(7, 22, 70, 3), (8, 23, 80, 3)],  # bound: day 30 - 7
    ]
    land(str(tmp_path / "in"), [frame(f) for f in files])
    path = str(tmp_path / "out")
    stream = lambda: feeds.file_stream(spark, str(tmp_path / "in"), "part", "k long, ts timestamp_ntz, v long, n long", 1)
    run = lambda: feeds.bounded_upsert_stream(stream(), path, ["k"], "ts", 7, (), "n")
    run()
    shown = lambda name: sorted((r.k, (r.ts - START).days, r.v) for r in upsert.rows_of(spark, f"{path}/{name}").collect())
    table, late = [(1, 0, 10), (2, 5, 20), (3, 20, 30), (5, 19, 51), (6, 30, 60), (8, 23, 80)], [(2, 5, 21), (4, 1, 40), (4, 1, 41), (7, 22, 70)]
    assert shown("table") == table and shown("late") == late
    os.remove(f"{path}/checkpoint/commits/3")  # the last batch counts as not done, and runs again
    crc = f"{path}/checkpoint/commits/.3.crc"
    if os.path.exists(crc):
        os.remove(crc)
    run()
    assert shown("table") == table and shown("late") == late
    land(str(tmp_path / "more"), [frame([(9, 24, 90, 4)])])
    os.rename(f"{tmp_path}/more/part-000.parquet", f"{tmp_path}/in/part-900.parquet")
    os.utime(f"{tmp_path}/in/part-900.parquet")
    run()
    assert shown("table") == sorted([*table, (9, 24, 90)]) and shown("late") == late
