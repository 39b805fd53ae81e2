import datetime as dt
import json
import random
import time

import pytest

from marginalia.sources.versions import Versions
from marginalia.streaming import progress, stateful

BASE = dt.datetime(2024, 1, 1)


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"ts": (BASE + dt.timedelta(seconds=s)).isoformat(), "host": h, "status": st, "entry_key": k, "file_path": "f", "message": "m"}) + "\n" for s, h, st, k in rows))


def replay(rows, limit, cooldown, until):
    """The transitions of each host, from all rows in the order of their time."""
    out = []
    for host in sorted({h for _, h, _, _ in rows}):
        streak, end = 0, 0.0
        for s, _, status, _ in sorted((r for r in rows if r[1] == host), key=lambda r: (r[0], r[2])):
            if end and s >= end:
                out.append((host, end, "closed", end, streak))
                end = 0.0
            streak = 0 if status == "success" else streak + (status == "failed")
            if status == "failed" and streak >= limit and s + cooldown > end:
                end = s + cooldown
                out.append((host, s, "open", end, streak))
        if end and until >= end:
            out.append((host, end, "closed", end, streak))
    return sorted(out)


def test_breakers_close_again_and_follow_event_time(spark, tmp_path):
    r = random.Random(2)
    rows = [(t * 7, r.choice("ab"), r.choice(["failed", "failed", "success", "skipped"]), "k") for t in range(60)]
    late = rows[:]
    for k in range(0, 60, 5):  # out of order within and across files
        late[k : k + 5] = r.sample(late[k : k + 5], 5)
    late[8], late[14], late[30], late[36] = late[14], late[8], late[36], late[30]
    for n in range(6):
        put(tmp_path / "in", f"{n}.json", late[n * 10 : n * 10 + 10])
    q = stateful.cooling_breakers(progress.events(spark, str(tmp_path / "in"), per_trigger=1), limit=2, cooldown=40, late="2 minutes")
    run = lambda: q.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start().awaitTermination(240)
    run()
    put(tmp_path / "in", "7.json", [(10_000, "end", "success", "k")])  # moves the watermark past all
    run()
    put(tmp_path / "in", "8.json", [(10_001, "end", "success", "k")])
    run()
    seconds = lambda t: (t - BASE).total_seconds()
    got = sorted((x.host, seconds(x.at), x.state, seconds(x.until), x.streak) for x in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == replay(rows, 2, 40, 9_000) and any(x[2] == "closed" for x in got)


def test_breaker_rules():
    b = stateful.Breaker(2, 10)
    assert b.meets(1, "failed") == [] and b.meets(2, "failed") == [(2, "open", 12, 2)] and b.meets(3, "failed") == [(3, "open", 13, 3)]
    assert b.passes(12) == [] and b.passes(20) == [(13, "closed", 13, 3)] and b.passes(30) == []
    assert b.meets(31, "success") == [] and b.streak == 0 and b.meets(32, "failed") == []


def test_rows_are_given_out_by_number_or_by_timer(spark, tmp_path):
    put(tmp_path / "in", "0.json", [(n, "h", "ok", f"k{n}") for n in range(7)])
    q = stateful.gathered(progress.events(spark, str(tmp_path / "in"), per_trigger=1), shards=1, most=5, seconds=3)
    run = q.writeStream.format("memory").queryName("gathered").outputMode("append").trigger(processingTime="500 milliseconds").start()
    seen = lambda: [(x.entry_key, x.why) for x in spark.sql("SELECT * FROM gathered").collect()]

    def wait(n):
        for _ in range(120):
            if len(seen()) >= n:
                return
            time.sleep(0.5)

    try:
        wait(7)
        assert {w for _, w in seen()} == {"rows"} and len(seen()) == 7
        put(tmp_path / "in", "1.json", [(9, "h", "ok", "late one"), (9, "h", "ok", "late two")])
        wait(9)
        assert sorted(seen()[7:]) == [("late one", "timer"), ("late two", "timer")]
    finally:
        run.stop()


def test_kept_state_is_compacted_and_batches_count_once(spark, tmp_path):
    r = random.Random(1)
    want, folder = {}, tmp_path / "in"
    for n in range(7):
        rows = [(r.randint(0, 10_000), "h", r.choice(["ok", "failed"]), f"k{r.randint(0, 12)}") for _ in range(10)]
        rows = list({(s, k): (s, h, st, k) for s, h, st, k in rows}.values())
        put(folder, f"{n}.json", rows)
        for s, _, st, k in rows:
            want[k] = max(want.get(k, (-1, "")), (s, st))
    state = str(tmp_path / "state")
    keep = lambda cp: progress.keep_latest(progress.events(spark, str(folder), per_trigger=1), state, str(tmp_path / cp), ["entry_key"], "ts", fanout=3).awaitTermination(240)
    keep("cp")
    read = lambda: {x.entry_key: ((x.ts - BASE).total_seconds(), x.status) for x in progress.latest_state(spark, state).collect()}
    assert {k: v[0] for k, v in read().items()} == {k: v[0] for k, v in want.items()}
    table = Versions(spark, state)
    number, at = table.read()
    assert at["batch"] == 6 and number == 7 and [len(x) for x in at["levels"]] == [1, 2]
    folders = [p for p in (tmp_path / "state").iterdir() if p.name.startswith("run-")]
    assert len(folders) <= 2 * 4
    keep("another checkpoint")  # the same batches come again
    assert table.read() == (number, at)


@pytest.fixture(autouse=True, scope="module")
def _store(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    yield
    spark.conf.set(name, before)
