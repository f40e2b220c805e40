"""Alerts of the stream against the same rule over all rows at once."""

import json
import os
import random
import subprocess
import sys
from datetime import date, datetime, timedelta
from pathlib import Path

import pyspark
from pyspark import cloudpickle

from shelfsight.streaming.crossings import _rate_crossings, negative_crossings, write_alerts

SCHEMA = "id bigint, asin string, sentiment string, scraped_at timestamp"
START = datetime(2024, 3, 1)


def expected(rows, last_day, span=7, threshold=0.2):
    """Judge every product on every day up to ``last_day``."""
    seen, counts = set(), {}
    for r in rows:
        if r["id"] in seen or r["asin"] is None:
            continue
        seen.add(r["id"])
        day = datetime.fromisoformat(r["scraped_at"]).date()
        n = counts.setdefault(r["asin"], {}).setdefault(day, [0, 0])
        n[0] += 1
        n[1] += r["sentiment"] == "Negative"
    alerts = []
    for asin, days in counts.items():
        above, day = False, min(days)
        while day <= last_day:
            window = [days[d] for d in days if day - timedelta(days=span) < d <= day]
            total, bad = (sum(w[i] for w in window) for i in (0, 1))
            now = total > 0 and bad > threshold * total
            if now and not above:
                alerts.append((asin, day, round(bad / total, 9), total, bad))
            above, day = now, day + timedelta(days=1)
    return sorted(alerts)


def run(spark, folder, files_at_once=1):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_at_once).json(str(folder / "in"))
    write_alerts(negative_crossings(stream, review_id="id"), str(folder / "out"), str(folder / "cp")).awaitTermination()
    found = spark.read.schema("asin string, day date, negative_rate double, reviews bigint, negative bigint").parquet(
        *[str(p) for p in (folder / "out").iterdir()])
    return sorted((r["asin"], r["day"], round(r["negative_rate"], 9), r["reviews"], r["negative"]) for r in found.collect())


def drop(folder, name, rows):
    (folder / "in").mkdir(parents=True, exist_ok=True)
    (folder / "in" / name).write_text("\n".join(map(json.dumps, rows)))


def reviews(rng, first, days, per_day, ids):
    rows = []
    for d in range(first, first + days):
        for _ in range(per_day):
            asin = rng.choice(["hot"] * 5 + [f"p{i}" for i in range(8)] + [None])
            if asin != "hot" and rng.random() < 0.6:
                continue
            bad = rng.random() < (0.35 if (d // 6 + len(asin or "")) % 2 else 0.05)
            rows.append({
                "id": next(ids), "asin": asin, "sentiment": "Negative" if bad else "Positive",
                "scraped_at": (START + timedelta(days=d, minutes=rng.randrange(1, 1439))).isoformat(),
            })
    return rows + rng.sample(rows, min(5, len(rows)))


def test_alerts_equal_a_batch_over_restarts(spark, tmp_path):
    rng, ids, everything = random.Random(4), iter(range(10_000)), []
    # Three starts of the query from one checkpoint, several micro-batches each.
    for start in range(3):
        for part in range(2):
            rows = reviews(rng, 12 * start + 6 * part, 6, 12, ids)
            everything += rows
            drop(tmp_path, f"{start}-{part}.json", rows)
        found = run(spark, tmp_path)
    # The watermark is a day behind the newest review, so the last day that is over is two days before its day.
    newest = max(datetime.fromisoformat(r["scraped_at"]) for r in everything)
    last = (newest - timedelta(days=1)).date() - timedelta(days=1)
    wanted = expected(everything, last)
    assert found == wanted and len(wanted) > 5


def test_one_alert_while_the_rate_stays_and_one_when_old_days_drop_out(spark, tmp_path):
    def row(i, day, bad, asin="a"):
        return {"id": i, "asin": asin, "sentiment": "Negative" if bad else "Positive",
                "scraped_at": (START + timedelta(days=day, hours=12)).isoformat()}

    rows = [row(i, 0, False) for i in range(10)] + [row(20, 1, True), row(21, 1, True)]
    rows += [row(30 + d, d, True, "b") for d in range(6)]
    drop(tmp_path, "1.json", rows)
    drop(tmp_path, "2.json", [row(90, 40, False, "later")])
    found = run(spark, tmp_path)
    # "a" crosses without a new review, when its ten good ones are older than a week; "b" stays above and alerts once.
    assert [(r[0], r[1]) for r in found] == [("a", date(2024, 3, 8)), ("b", date(2024, 3, 1))]
    assert run(spark, tmp_path) == found


def test_a_session_with_sparks_own_state_store(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    before, plain = spark.conf.get(name), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    rows = [{"id": i, "asin": "a", "sentiment": "Negative", "scraped_at": (START + timedelta(days=i)).isoformat()} for i in range(5)]
    drop(tmp_path, "1.json", rows)
    spark.conf.set(name, plain)
    try:
        found = run(spark, tmp_path)
        assert [(r[0], r[1]) for r in found] == [("a", date(2024, 3, 1))]
        assert spark.conf.get(name) == plain
    finally:
        spark.conf.set(name, before)


def test_workers_need_not_have_this_package(tmp_path):
    sent = cloudpickle.dumps(_rate_crossings("asin", 7, 0.2))
    load = "import pickle, sys; pickle.load(sys.stdin.buffer).close()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": str(Path(pyspark.__file__).parents[1])}
    subprocess.run([sys.executable, "-c", load], input=sent, cwd=tmp_path, env=env, check=True, timeout=60)
