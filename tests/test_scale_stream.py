"""Rows that follow on at once never go to the state store; waiting rows go there in blocks."""

from collections import Counter

import pandas as pd

from twingraph.streaming import replay_stream as RS


class _Store(dict):
    def __init__(self, calls):
        self.calls = calls

    def getValue(self, key):
        self.calls["get"] += 1
        return self.get_(key)

    def get_(self, key):
        return dict.get(self, key)

    def containsKey(self, key):
        self.calls["contains"] += 1
        return key in self

    def updateValue(self, key, value):
        self.calls["put"] += 1
        self[key] = value

    def removeKey(self, key):
        self.calls["remove"] += 1
        self.pop(key)

    def iterator(self):
        return iter(list(self.items()))


class _Value:
    held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


class _Handle:
    def __init__(self):
        self.calls = Counter()

    def getValueState(self, *_):
        return _Value()

    def getMapState(self, *_):
        return _Store(self.calls)

    def registerTimer(self, at):
        self.timer = at

    def deleteTimer(self, at):
        self.timer = None


class _Times:
    def getCurrentWatermarkInMs(self):
        return 0


def _rows(seqs):
    ts = pd.Timestamp("2024-01-01")
    return pd.DataFrame([(s, ts + pd.Timedelta(minutes=s), "thief", s) for s in seqs], columns=["seq", "ts", "user", "target"])


def test_waiting_rows_in_blocks():
    order, handle = RS._Order(1000), _Handle()
    order.init(handle)
    run = lambda seqs: [s for f in order.handleInputRows((1,), iter([_rows(seqs)]), _Times()) for s in f["seq"]]
    assert run(range(1, 901)) == list(range(1, 901)) and not handle.calls
    assert run(range(1001, 2001)) == [] and handle.calls["put"] <= 5 and handle.timer
    assert run([1500, 5]) == [1500, 5]  # both are there already
    assert run(range(901, 1001)) == list(range(901, 2001))
    assert sum(handle.calls.values()) < 30 and not order.waiting and handle.timer is None
