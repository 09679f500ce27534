"""The state of the streamed minute folders: what is released, and how often the state is called."""

import datetime as dt
import random

import pandas as pd

from acctlens.streaming.minutes import EPOCH, MINUTE, ReplayReach

START = dt.datetime(2024, 1, 1)
FIRST = (START - EPOCH) // MINUTE


class Store:
    """Value or map state in memory; counts its calls."""

    def __init__(self):
        self.kept, self.calls = {}, 0

    def _call(self):
        self.calls += 1
        return self.kept

    def exists(self):
        return () in self._call()

    def get(self):
        return self._call()[()]

    def update(self, value):
        self._call()[()] = value

    def containsKey(self, key):
        return key in self._call()

    def getValue(self, key):
        return self._call()[key]

    def updateValue(self, key, value):
        self._call()[key] = value

    def removeKey(self, key):
        del self._call()[key]


class Handle:
    def __init__(self):
        self.stores = {}

    def getValueState(self, name, *schema):
        return self.stores.setdefault(name, Store())

    getMapState = getValueState


def feed(replay, arrivals, chunks=1):
    rows = pd.DataFrame({"at": [m for m, _ in arrivals], "path": [p for _, p in arrivals]}).astype({"at": "int64", "path": object})
    out = list(replay.handleInputRows(("a",), iter([rows[k::chunks] for k in range(chunks)]), None))
    return [r for f in out for r in zip(f["leaf"], f["at"].tolist(), f["path"])]


def released(arrivals, max_missing):
    """Plain replay over all that has arrived, a row at a time."""
    reach, out = FIRST - 1, []
    for at, path in sorted(x for x in arrivals if x[0] >= FIRST):
        if at - reach > max_missing + 1:
            break
        reach = max(reach, at)
        out.append(("a", at, path))
    return out


def test_released_minutes_in_any_order_equal_a_plain_replay():
    for seed in range(60):
        pick = random.Random(seed)
        gap = pick.choice([0, 3, 20, 240, 900])
        arrivals = [(FIRST + pick.randrange(-50, 4000) // pick.choice([1, 2, 9]), f"p{pick.randrange(4)}") for _ in range(pick.choice([5, 60, 900]))]
        handle, got = Handle(), []
        replay = ReplayReach(START, gap)
        replay.init(handle)
        seen = 0
        while seen < len(arrivals):
            n = pick.randrange(1, 200)
            got += feed(replay, arrivals[seen: seen + n], pick.choice([1, 3]))
            seen += n
            assert sorted(got) == released(arrivals[:seen], gap)
        waiting = handle.stores["waiting"].kept
        assert sum(len(m) for m, _ in waiting.values()) == sum(a >= FIRST for a, _ in arrivals) - len(got)
        assert handle.stores["reach"].kept[()][1] == len(waiting)


def test_missing_path_and_repeated_minutes_are_kept():
    replay = ReplayReach(START, 5)
    replay.init(Handle())
    late = [(FIRST + 20, None), (FIRST + 20, None), (FIRST + 21, "x")]
    assert feed(replay, late) == []
    assert feed(replay, [(FIRST + k, None) for k in (0, 5, 10, 15)])[-3:] == [("a", FIRST + 20, ""), ("a", FIRST + 20, ""), ("a", FIRST + 21, "x")]


def test_state_is_called_by_blocks_not_by_minutes():
    """Twenty days that wait for the one before them: some calls for each quarter of a day."""
    days, handle = 20, Handle()
    replay = ReplayReach(START, 240)
    replay.init(handle)
    assert feed(replay, [(FIRST + m, None) for m in range(1440, 1440 * (days + 1))]) == []
    assert len(feed(replay, [(FIRST + m, None) for m in range(1440)])) == 1440 * (days + 1)
    assert sum(s.calls for s in handle.stores.values()) < 1440 * days / 40
    assert not handle.stores["waiting"].kept
