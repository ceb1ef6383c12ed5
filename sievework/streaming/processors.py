"""Stateful processors of the streaming jobs: each keeps a small state by key and drops it by timers in event time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Milliseconds after a day's, or a key's, last event when its state goes.
KEEP_MS = 3 * 86_400_000


def _rows(batches: Iterator[pd.DataFrame], *order: str) -> pd.DataFrame:
    """What a batch has of a group, in order."""
    return pd.concat(list(batches)).sort_values(list(order), kind="stable")


def _millis(at) -> int:
    return int(pd.Timestamp(at).timestamp() * 1000)


class Forgetful(StatefulProcessor):
    """A processor with one value state that goes ``KEEP_MS`` after the last event of its group."""

    schema = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.state = handle, handle.getValueState("state", self.schema)

    def keep_until(self, millis: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        self.handle.registerTimer(millis)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


class FirstUse(Forgetful):
    """Passes a group's first row on and no other."""

    schema = "seen boolean"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows = _rows(rows, "at", "id")
        if not self.state.exists():
            self.state.update((True,))
            yield rows.head(1)[["day", "key", "at", "id"]]
        self.keep_until(_millis(rows["at"].iloc[-1]) + KEEP_MS)


class FirstOnes(Forgetful):
    """Passes a group's first ``limit`` rows on, marked as ok, and those beyond not at all; counts alone are kept."""

    schema = "used long"

    def __init__(self, limit: int, last: bool):
        self.limit, self.last = limit, last

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows = _rows(rows, "at", "id")
        used = self.state.get()[0] if self.state.exists() else 0
        some = rows.head(max(0, self.limit - used))
        self.state.update((used + len(some),))
        self.keep_until(_millis(rows["at"].iloc[-1]) + KEEP_MS)
        if len(some):
            yield some[["day", "key", "at", "id"]].assign(ok=True)


class Ledger(Forgetful):
    """A key's entry in a ledger of known failures; its timer is the end of the entry's life."""

    schema = "open boolean, nature string, hits long, skip_runs long, last_skip string, run string, until long, skipped long, fetched long"

    def __init__(self, skip_runs: int, structural: int, transient: int):
        self.most_runs, self.life = skip_runs, {"structural": structural, "transient": transient}

    @staticmethod
    def _closed(s: dict) -> dict:
        return s | {"open": False, "nature": "", "hits": 0, "skip_runs": 0, "last_skip": None}

    def _load(self) -> dict:
        names = [c.strip().split(" ")[0] for c in self.schema.split(",")]
        if self.state.exists():
            return dict(zip(names, self.state.get(), strict=True))
        return dict(zip(names, (False, "", 0, 0, None, "", 0, 0, 0), strict=True))

    def _seen(self, key, s: dict, at: int) -> pd.DataFrame:
        self.state.update(tuple(s.values()))
        return pd.DataFrame([{"key": key[0], "at": at} | {c: s[c] for c in ("open", "nature", "hits", "skip_runs", "skipped", "fetched")}])

    def _failed(self, s: dict, at: int, run: str, nature: str) -> dict:
        alive = s["open"] and at < s["until"]
        same = alive and s["nature"] == nature
        return s | {"open": True, "nature": nature, "hits": s["hits"] + 1 if alive else 1, "skip_runs": s["skip_runs"] if same else 0, "last_skip": s["last_skip"] if same else None, "run": run, "until": at + self.life.get(nature, self.life["transient"])}

    def _probed(self, s: dict, at: int, run: str) -> dict:
        alive = s["open"] and at < s["until"]
        structural = s["nature"] == "structural"
        if alive and (s["skip_runs"] < self.most_runs if structural else s["run"] == run):
            return s | {"skip_runs": s["skip_runs"] + (s["last_skip"] != run), "last_skip": run, "skipped": s["skipped"] + 1}
        s = s | {"fetched": s["fetched"] + 1}
        return self._closed(s) if s["open"] and (structural or not alive) else s

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows, s, at = _rows(rows, "at", "kind", "run", "nature"), self._load(), 0
        for r in rows.itertuples(index=False):
            at = _millis(r.at) // 1000
            s = self._failed(s, at, r.run, r.nature) if r.kind == "failure" else self._probed(s, at, r.run)
        self.keep_until(max(s["until"], at) * 1000)
        yield self._seen(key, s, at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        s = self._load()
        if s["open"]:
            yield self._seen(key, self._closed(s), s["until"])


class Runs(Forgetful):
    """A day's windows, and how many in a row exceed a share."""

    schema = "length long"

    def __init__(self, share: float, run: int):
        self.share, self.run = share, run

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows = _rows(rows, "start")
        length, alarm = self.state.get()[0] if self.state.exists() else 0, []
        for rate in rows["rate"]:
            length = length + 1 if rate > self.share else 0
            alarm.append(length >= self.run)
        self.state.update((length,))
        self.keep_until(_millis(rows["start"].iloc[-1]) + KEEP_MS)
        yield rows[["start", "total", "failed", "rate"]].assign(alarm=alarm)


class Recent(Forgetful):
    """A key's events, each with how many stand within the seconds before it; peers of one instant count each other."""

    schema = "times array<long>"

    def __init__(self, seconds: int, limit: int):
        self.span, self.limit = seconds * 1_000_000, limit

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows = _rows(rows, "at", "id")
        micros = pd.to_datetime(rows["at"]).to_numpy("datetime64[us]").astype("int64")
        times = pd.Index(sorted([*(self.state.get()[0] if self.state.exists() else []), *micros.tolist()]))
        recent = times.searchsorted(micros, side="right") - times.searchsorted(micros - self.span, side="left")
        self.state.update((times[times >= micros[-1] - self.span].tolist(),))
        self.keep_until(int(micros[-1] // 1000) + KEEP_MS)
        yield pd.DataFrame({"key": key[0], "at": rows["at"], "id": rows["id"], "recent": recent, "blocked": recent >= self.limit})


class NewKey(StatefulProcessor):
    """A key's first row if the key is new, and how many rows of it a batch has."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        rows = _rows(rows, "order", "row")
        new = not self.state.exists()
        if new:
            self.state.update((True,))
        yield pd.DataFrame({"row": [rows["row"].iloc[0] if new else None], "rows": [len(rows)]})

    def close(self) -> None:
        pass
