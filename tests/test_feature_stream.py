"""Incremental feature state and scoring through the registry, in micro-batches."""

import datetime as dt
import json
import random

import pandas as pd

from moorline.operators import boosting as B
from moorline.streaming import feature_state as FS
from moorline.streaming import scoring as SCR
from moorline import constants as K

SNAP = dt.date(2024, 1, 16)
START = SNAP - dt.timedelta(days=200)


def _batches(seed=11):
    """Rows (customer, day, logins, transfers) in arrival order, some up to 20 days late."""
    rng = random.Random(seed)
    rows = []
    for _ in range(400):
        day = rng.randrange(201)
        rows.append((day + (rng.randrange(20) if rng.random() < 0.3 else 0), rng.randrange(12), day, rng.randrange(2), rng.randrange(3)))
    rows.sort()
    return [rows[i:i + 100] for i in range(0, len(rows), 100)]


def _expected(rows):
    out = {}
    for c in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == c]

        def total(i, back, own=own):
            return sum(r[i] for r in own if 200 - back <= r[2] <= 200)
        out[c] = (total(3, 30), total(3, 90), total(4, 90))
    return out


def test_micro_batches_with_late_rows_equal_the_batch_features(spark, tmp_path):
    batches = _batches()
    base = str(tmp_path)
    for n, batch in enumerate(batches):
        rows = [(c, dt.datetime.combine(START + dt.timedelta(days=day), dt.time(13)), a, b) for _, c, day, a, b in batch]
        frame = spark.createDataFrame(rows, FS.ACTIVITY)
        if n == len(batches) - 1:
            frame = frame.unionByName(FS.heartbeat(spark, SNAP, 30))
        frame.coalesce(1).write.mode("append").parquet(f"{base}/in")
        q = FS.run(spark, f"{base}/in", f"{base}/log", f"{base}/checkpoint", late_days=30)
        held = max(p["stateOperators"][0]["numRowsTotal"] for p in map(lambda p: json.loads(p.json), q.recentProgress))
        # Days of the 90-day window and one value per customer and timer, not the whole history.
        assert held <= 13 * (91 + 1 + 2)
    rows = [r for b in batches for r in b]
    got = {r.customer_id: (r.app_logins_last_30d, r.app_logins_last_90d, r.competitor_transfer_count)
           for r in FS.latest(spark, f"{base}/log").collect() if r.customer_id >= 0}
    assert got == _expected(rows)


def test_a_group_of_customers_is_one_state_entry(spark, tmp_path):
    """Two groups hold all customers: one value and one timer each, beside the rows without a customer."""
    base, rows = str(tmp_path), _batches(5)[-1]
    frame = spark.createDataFrame([(c if c else None, dt.datetime.combine(START + dt.timedelta(days=day), dt.time(13)), a, b)
                                   for _, c, day, a, b in rows], FS.ACTIVITY).unionByName(FS.heartbeat(spark, SNAP, 30))
    frame.coalesce(1).write.parquet(f"{base}/in")
    q = FS.run(spark, f"{base}/in", f"{base}/log", f"{base}/checkpoint", late_days=30, groups=2)
    assert max(json.loads(p.json)["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= 3 * 4
    got = {r.customer_id: (r.app_logins_last_30d, r.app_logins_last_90d, r.competitor_transfer_count)
           for r in FS.latest(spark, f"{base}/log").collect() if r.customer_id is None or r.customer_id >= 0}
    assert {c or 0: v for c, v in got.items()} == _expected(rows) and None in got


def test_a_timer_emits_only_the_customers_it_concerns():
    """Days 10 and 50 of two customers: at day 45 the first one's login has left the 30-day window, at day 101 all windows."""
    class Handle:
        held, timers = None, []

        def getValueState(self, name, schema):
            return self

        def get(self):
            return self.held

        def update(self, value):
            self.held = value

        def clear(self):
            self.held = None

        def listTimers(self):
            return iter(self.timers)

        def deleteTimer(self, timer):
            self.timers = [t for t in self.timers if t != timer]

        def registerTimer(self, timer):
            self.timers = self.timers + [timer]

        def getCurrentWatermarkInMs(self):
            return self.watermark

    handle, processor = Handle(), FS.WindowedFeatures(groups=1)
    processor.init(handle)
    pdf = pd.DataFrame({"customer_id": [7, 8, 7], "ts": pd.to_datetime([10 * FS.DAY_MS, 50 * FS.DAY_MS, 10 * FS.DAY_MS], unit="ms", utc=True),
                        "logins": [1, 1, 2], "transfers": [0, 4, 1]})
    first = pd.concat(processor.handleInputRows((0,), iter([pdf]), handle))
    assert first.iloc[:, [0, 2, 3, 4]].to_numpy().tolist() == [[7, 3, 3, 1], [8, 1, 1, 4]] and handle.timers == [41 * FS.DAY_MS]
    handle.watermark = 45 * FS.DAY_MS
    second = pd.concat(processor.handleExpiredTimer((0,), handle, None))
    assert second.to_numpy().tolist() == [[7, dt.date(1970, 2, 15), 0, 3, 1]] and handle.timers == [81 * FS.DAY_MS]
    handle.watermark = 200 * FS.DAY_MS
    third = pd.concat(processor.handleExpiredTimer((0,), handle, None))
    assert third.iloc[:, [0, 2, 3, 4]].to_numpy().tolist() == [[7, 0, 0, 0], [8, 0, 0, 0]] and handle.held is None and not handle.timers


def _booster(value):
    tree = B.Tree()
    tree.add(value, 1)
    return B.Booster(list(K.FEATURE_COLUMNS), [[] for _ in K.FEATURE_COLUMNS], 0.0, [tree])


def test_a_promotion_takes_effect_with_the_next_batch(spark, tmp_path):
    base = str(tmp_path)
    for version, value in (("1", -2.0), ("2", 3.0)):
        _booster(value).save(spark, f"{base}/models/{version}")
    rows = [("1", "production"), ("2", "staging")]
    model = SCR.RegistryModel(lambda: spark.createDataFrame(rows, "version string, status string"), f"{base}/models")

    def send(name, ids):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join(json.dumps({"customer_id": i}) for i in ids))
        return SCR.run_model_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", model)
    assert {r.model_version for r in send("a.txt", [1, 2]).collect()} == {"1"}
    rows[:] = [("1", "retired"), ("2", "production")]
    out = {r.customer_id: (r.model_version, r.churn_score, r.high_risk) for r in send("b.txt", [3]).collect()}
    assert out == {1: ("1", 0.1192, False), 2: ("1", 0.1192, False), 3: ("2", 0.9526, True)}
