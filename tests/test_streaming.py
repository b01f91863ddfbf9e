import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from barframe.operators import commands as cm
from barframe.sources.bars import build_bars
from barframe.streaming.bars import AT_END, bars_to_end, read_bars_to_end, run_to_end, run_to_table, stream_bars
from barframe.streaming.progress import Progress
from barframe.streaming.pull import SPAN, PullsReader, UpdateLogReader, land_updates, pulled_updates
from barframe.streaming.updates import Registry, UpdateJob, new_updates, read_outbox, read_processed, read_updates, updates_stream, with_previous_id
from suite import tables as t
from suite.queries import QUERIES

IDS = [1, 2]


def update(uid, chat=1, text="/ping", **chat_fields):
    return {"update_id": uid, "message": {"chat": {"id": chat, **chat_fields}, "text": text}}


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))


@pytest.fixture
def job(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def make(registry=None):
        return UpdateJob(updates_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), IDS, registry)

    return make


def replies(spark, tmp_path):
    rows = read_outbox(spark, str(tmp_path / "out")).collect()
    return sorted((r["update_id"], r["chat_id"], r["text"]) for r in rows)


def test_updates_in_steps(spark, tmp_path, job):
    land(tmp_path / "in", "1.json", [
        update(5, text="/PING"), update(7, 2, "//ping@bot a b"), update(8, 3, "/ping", first_name="Eve"), update(9, text="hi /ping"),
        {"update_id": 10}, update(11, text="/"), update(11, text="/"), update(12, text="/nope x"),
        {"update_id": 13, "message": {"text": "/ping"}}, "not json", {"update_id": 14, "message": {"chat": {"id": 1}}},
    ])
    job().run()
    first = [(5, 1, cm.PING_TEXT), (7, 2, cm.PING_TEXT), (11, 1, cm.UNKNOWN_TEXT), (12, 1, cm.UNKNOWN_TEXT + "nope")]
    assert replies(spark, tmp_path) == first
    # A second start from the checkpoint: an old id again, and a status that shows the id before it.
    land(tmp_path / "in", "2.json", [update(12, text="/ping"), update(20, text="/status"), update(21, text="/status")])
    job().run()
    got = replies(spark, tmp_path)
    assert got[:4] == first and len(got) == 6
    assert "Last Update ID: 14" in got[4][2] and "Last Update ID: 20" in got[5][2]
    assert "Authorized Users: 2" in got[4][2] and "Commands: 4" in got[4][2]
    state = spark.read.parquet(str(tmp_path / "out/state")).orderBy("last_update_id").collect()
    assert [(r["last_update_id"], r["processed"]) for r in state] == [(14, 10), (21, 2)]
    warned = spark.read.parquet(str(tmp_path / "out/unauthorized")).collect()
    assert [(r["update_id"], r["user"]) for r in warned] == [(8, "Eve")]
    dead = spark.read.parquet(str(tmp_path / "out/dead_letters")).collect()
    assert sorted(r["error"] for r in dead) == ["message without chat id", "unreadable update"]


def test_batch_again_writes_the_same(spark, tmp_path, job):
    land(tmp_path / "in", "1.json", [update(1), update(2, text="/help")])
    this = job()
    batch = read_updates(spark, str(tmp_path / "in"))
    this.handle(batch, 0)
    once = replies(spark, tmp_path)
    this.handle(batch, 0)
    assert replies(spark, tmp_path) == once and len(once) == 2
    assert "/help\n/info\n/ping\n/status" in once[1][2]


def test_own_handlers(spark, tmp_path, job):
    registry = Registry()

    def echo(commands):
        return commands.select("update_id", "chat_id", F.array_join("args", "-").alias("reply"))

    def broken(commands):
        raise RuntimeError("no data")

    registry.register_command("/Echo", broken)
    registry.register_command("echo", echo)
    registry.register_command("bad", broken)
    registry.register_command("ping", echo)
    assert registry.names == ["status", "help", "ping", "info", "echo", "bad"]
    land(tmp_path / "in", "1.json", [update(1, text="/echo a b"), update(2, text="/bad"), update(3, text="/ping c"), update(4, text="/info")])
    job(registry).run()
    assert replies(spark, tmp_path) == [(1, 1, "a-b"), (2, 1, "❌ Error: no data"), (3, 1, "c"), (4, 1, cm.INFO_FALLBACK_TEXT)]


def test_previous_id_across_spans(spark):
    ids = spark.createDataFrame([(i,) for i in (3, 4, 5000, 5001, 90000, 1 << 30, (1 << 30) + 1, 1 << 40)], "update_id bigint")
    got = {r["update_id"]: r["last_update_id"] for r in with_previous_id(ids, 2).collect()}
    assert got == {3: 2, 4: 3, 5000: 4, 5001: 5000, 90000: 5001, 1 << 30: 90000, (1 << 30) + 1: 1 << 30, 1 << 40: (1 << 30) + 1}


def test_next_batch(spark):
    log = spark.createDataFrame([(i,) for i in range(100, 70, -3)] + [(i,) for i in range(12)], "update_id bigint")
    assert [r[0] for r in cm.next_batch(log, 0).collect()] == list(range(1, 11))
    assert [r[0] for r in cm.next_batch(log, 90).collect()] == [91, 94, 97, 100]


def test_log_status(spark):
    empty = spark.createDataFrame([], cm.UPDATE_SCHEMA)
    row = cm.log_status(empty, IDS).first()
    assert (row["authorized"], row["commands"], row["last_update_id"], row["processed"]) == (2, 4, 0, 0)


def test_lost_state_starts_from_zero(spark, tmp_path):
    batch = spark.createDataFrame([(5, (( 1, "n", None), "/status"))], cm.UPDATE_SCHEMA)
    this = UpdateJob(batch, str(tmp_path / "out"), IDS, now="2024-01-01")
    this.handle(batch, 7)
    assert "Last Update ID: 0" in replies(spark, tmp_path)[0][2]
    assert spark.read.parquet(str(tmp_path / "out/state")).first()["last_save"] == "2024-01-01"


def test_new_checkpoint_goes_on_from_the_state(spark, tmp_path):
    make = lambda uid: spark.createDataFrame([(uid, ((1, "n", None), "/status"))], cm.UPDATE_SCHEMA)
    UpdateJob(make(5), str(tmp_path / "out"), IDS).handle(make(5), 0)
    again = UpdateJob(make(6), str(tmp_path / "out"), IDS, run="1")
    again.handle(make(5).union(make(6)), 0)
    got = replies(spark, tmp_path)
    assert [r[0] for r in got] == [5, 6] and "Last Update ID: 5" in got[1][2]


def test_repeated_ids_are_picked_by_a_stated_order(spark):
    rows = [(5, ((2, "b", None), "/ping")), (5, ((1, "a", None), "/help")), (6, None), (None, None)]
    df = spark.createDataFrame(rows, cm.UPDATE_SCHEMA)
    for shuffled in (df, df.repartition(3), df.orderBy(F.desc("update_id"))):
        got = new_updates(shuffled, 4).orderBy("update_id").collect()
        assert [(r["update_id"], r["message"] and r["message"]["chat"]["id"]) for r in got] == [(None, None), (5, 1), (6, None)]


def test_a_handler_that_fails_on_some_commands(spark, tmp_path, job):
    registry = Registry()

    def half(commands):
        reply = F.when(F.element_at("args", 1) == "bad", F.raise_error(F.lit("cannot do that"))).otherwise(F.lit("done"))
        return commands.select("update_id", "chat_id", reply.alias("reply"))

    registry.register_command("half", half)
    land(tmp_path / "in", "1.json", [update(i, text=f"/half {'bad' if i in (3, 8) else 'good'}") for i in range(1, 11)])
    job(registry).run()
    got = {i: text for i, _, text in replies(spark, tmp_path)}
    assert {i for i, text in got.items() if text == "done"} == {1, 2, 4, 5, 6, 7, 9, 10}
    assert all(got[i].startswith("❌ Error: ") and "cannot do that" in got[i] and "\tat " not in got[i] for i in (3, 8))


def test_functions_answer_with_a_reply_or_an_error(spark, tmp_path, job):
    registry = Registry()

    calls = spark.sparkContext.accumulator(0)

    def half(chat, args):
        calls.add(1)
        if args == ["none"]:
            return None
        return f"{chat} {10 // int(args[0])}"

    registry.register_command("half", lambda commands: commands)
    registry.register_function("/Half", half)
    assert registry.custom == {} and registry.names[-1] == "half"
    texts = ["5", "0", "x", "none", ""]
    land(tmp_path / "in", "1.json", [update(i, text=f"/half {texts[i % 5]}") for i in range(1, 301)] + [update(400, text="/ping")])
    job(registry).run()
    got = {i: text for i, _, text in replies(spark, tmp_path)}
    assert len(got) == 60 * 4 + 1 and got[400] == cm.PING_TEXT
    assert got[5] == "1 2" and got[1] == "❌ Error: integer division or modulo by zero" and "invalid literal" in got[2] and got[4] == "❌ Error: list index out of range"
    handled = spark.read.parquet(str(tmp_path / "out/handled"))
    assert handled.where("error is not null").count() == 180 and handled.count() == 300
    assert calls.value == 300  # each command once, whatever fails


def test_progress_survives_damage(spark, tmp_path):
    path = str(tmp_path / "state")
    progress = Progress(spark, path, "0")
    assert progress.before(0) == (0, 0, 0)
    for batch, mark in enumerate((10, 20, 30)):
        _, total, slot = progress.before(batch)
        progress.note(batch, mark, 10, total + 10, slot, "now")
    assert progress.before() == (30, 30, 1) and progress.notes().count() == 2  # older notes are gone
    assert progress.before(2) == (20, 20, 0)  # the micro-batch again: its own note does not count
    Progress(spark, path, "other").note(0, 25, 1, 1, 0, "now")
    assert Progress(spark, path, "other").before() == (30, 1, 1)
    for file in (tmp_path / "state/run=0/slot=0").glob("*.parquet"):
        file.write_bytes(b"damaged")
    assert progress.before()[:2] == (25, 20)
    for file in (tmp_path / "state").rglob("*.parquet"):
        file.write_bytes(file.read_bytes()[:-9])
    assert progress.before() == (0, 0, 0)
    wrong = progress.spark.createDataFrame([(99, "now", 1, 1, "0", 9, 0, "no digest")], "last_update_id bigint, last_save string, processed bigint, total bigint, run string, batch_id bigint, slot int, digest string")
    wrong.write.mode("overwrite").parquet(f"{path}/run=0/slot=1")
    assert progress.before() == (0, 0, 0)


def log_rows(spark, ids, text="/status"):
    return spark.createDataFrame([(i, ((1, "n", None), text)) for i in ids], cm.UPDATE_SCHEMA)


def test_pulls_take_the_lowest_ids(spark, tmp_path):
    log = str(tmp_path / "log")
    ids = [1, 2, 5, SPAN - 1, SPAN, SPAN + 1, 3 * SPAN, 3 * SPAN + 7, 10 * SPAN, 10 * SPAN + 1, 10 * SPAN + 2]
    for part in (ids[::2], ids[1::2], ids[:3]):  # files overlap, some ids are there twice
        land_updates(log_rows(spark, part), log)
    stream, seen = pulled_updates(spark, log), []
    query = stream.writeStream.foreachBatch(lambda batch, n: seen.append((n, sorted({r["update_id"] for r in batch.collect()})))).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    assert seen == [(0, ids[:10]), (1, ids[10:])]
    land_updates(log_rows(spark, [20 * SPAN, 4]), log)  # 4 is below what was pulled
    query.processAllAvailable()
    query.stop()
    assert seen[2:] == [(2, [20 * SPAN])]
    reader = UpdateLogReader(log, after=SPAN, limit=2)
    assert reader.initialOffset() == {"update_id": SPAN} and reader.latestOffset() == reader.latestOffset() == {"update_id": 3 * SPAN}
    assert len(reader.partitions({"update_id": SPAN}, {"update_id": 3 * SPAN})) == 2


def numbered(ids, limit, above=0, pull=0):
    """``(update_id, pull, after)`` of sorted ids in pulls of ``limit``."""
    return [(i, pull + n // limit, ids[n // limit * limit - 1] if n >= limit else above) for n, i in enumerate(ids)]


def test_a_micro_batch_holds_many_pulls(spark, tmp_path):
    log = str(tmp_path / "log")
    ids = [1, 2, 5, SPAN - 1, SPAN, SPAN + 1, 3 * SPAN, 3 * SPAN + 7, *range(10 * SPAN - 9, 10 * SPAN + 12, 2), 40 * SPAN]
    for part in (ids[::2], ids[1::2], ids[:3]):  # some ids are there twice
        land_updates(log_rows(spark, part), log)
    stream, seen = pulled_updates(spark, log, limit=3, pulls=4), []
    take = lambda batch, n: seen.append((n, sorted({(r["update_id"], r["pull"], r["after"]) for r in batch.collect()}), batch.count()))
    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    want = numbered(ids, 3)  # 20 ids: the last pull has two
    assert [(n, rows) for n, rows, _ in seen] == [(0, want[:12]), (1, want[12:])] and [n for *_, n in seen] == [15, 8]
    later = [40 * SPAN + 1, 40 * SPAN + 2, 41 * SPAN, 41 * SPAN + 1]
    land_updates(log_rows(spark, [4, *later]), log)  # 4 is below what was pulled
    query.processAllAvailable()
    query.stop()
    assert seen[2][:2] == (2, numbered(later, 3, 40 * SPAN, 7)) and len(seen) == 3


def test_ids_that_come_between_do_not_add_pulls(spark, tmp_path):
    log = str(tmp_path / "log")
    land_updates(log_rows(spark, [10, 20, 30, 40, SPAN + 50, SPAN + 60, SPAN + 70]), log)
    reader = PullsReader(log, limit=2, pulls=3)
    start, end = reader.initialOffset(), reader.latestOffset()
    assert (start, end) == ({"update_id": 0, "pulls": 0}, {"update_id": SPAN + 60, "pulls": 3})
    land_updates(log_rows(spark, [31, 32, 33]), log)
    plan = reader.partitions(start, end)
    land_updates(log_rows(spark, [5, SPAN + 1]), log)
    rows = [tuple(r[c] for c in ("update_id", "pull", "after")) for p in plan for b in reader.read(p) for r in b.to_pylist()]
    assert rows == [(5, 0, 0), (10, 0, 0), (20, 0, 0), (30, 1, 20), (31, 1, 20), *[(i, 2, 31) for i in (32, 33, 40, SPAN + 1, SPAN + 50, SPAN + 60)]]
    assert reader.latestOffset() == {"update_id": SPAN + 70, "pulls": 4}


def suppliers(spark, tmp_path, n):
    keys = [i * 7 % 1009 for i in range(n)]  # in no order, with gaps
    rows = spark.createDataFrame([(k, f"S{k}", k % 25) for k in keys], "s_suppkey bigint, s_name string, s_nationkey int")
    rows.write.parquet(str(tmp_path / "sf/supplier.parquet"))
    return str(tmp_path / "sf"), [k * 3 + 3 for k in sorted(keys)]


def test_pulls_by_ten_share_micro_batches(spark, tmp_path, monkeypatch):
    sf, ids = suppliers(spark, tmp_path, 95)
    monkeypatch.setattr("suite.queries.shared_path", lambda _, name: str(tmp_path / name))
    got = sorted(tuple(r) for r in QUERIES["pulled_updates_by_ten"](spark, sf).collect())
    assert got == [(i, n // 10) for n, i in enumerate(ids)]
    assert len(list((tmp_path / "pulled/t").glob("n=*"))) == 1  # ten pulls


def test_pull_goes_on_from_its_progress(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    land_updates(log_rows(spark, range(3, 60, 3)), log)
    make = lambda: UpdateJob(None, out, IDS, now="2024-01-01")
    make().pull(spark, log, limit=8)
    land_updates(log_rows(spark, [57, 60]), log)
    make().pull(spark, log, limit=8)
    got = {i: text for i, _, text in replies(spark, tmp_path)}
    assert list(got) == list(range(3, 61, 3)) and "Last Update ID: 0" in got[3] and "Last Update ID: 57" in got[60]
    taken = sorted((r["batch_id"], r["processed"], r["last_update_id"]) for r in read_processed(spark, out).collect())
    assert taken == [(0, 8, 24), (24, 8, 48), (48, 3, 57), (57, 1, 60)]
    failing = make()
    failing.registry.register_command("status", lambda commands: 1 / 0)
    land_updates(log_rows(spark, [63]), log)
    real, Progress.note = Progress.note, lambda *a: 1 / 0  # the attempt fails after its output is written
    try:
        with pytest.raises(Exception):  # noqa: B017
            make().pull(spark, log)
    finally:
        Progress.note = real
    make().pull(spark, log)
    assert [i for i, _, _ in replies(spark, tmp_path)].count(63) == 1


def test_pulls_are_handled_together(spark, tmp_path):
    log, out, ids = str(tmp_path / "log"), str(tmp_path / "out"), [n * 911 + 4 for n in range(50)]
    for part in (ids, ids[::7]):  # some ids are there twice
        land_updates(log_rows(spark, part), log)
    UpdateJob(None, out, IDS, now="2024-01-01").pull(spark, log, limit=4, pulls=5)
    starts = [0, *ids[3::4]]
    want = [(start, len(took), took[-1]) for start, took in zip(starts, [ids[n : n + 4] for n in range(0, 50, 4)], strict=True)]
    taken = read_processed(spark, out)
    assert sorted((r["batch_id"], r["processed"], r["last_update_id"]) for r in taken.collect()) == want
    assert taken.dtypes == [("run", "string"), ("batch_id", "bigint"), ("processed", "bigint"), ("last_update_id", "bigint"), ("last_save", "string")]
    folders = {int(f.name.removeprefix("batch_id=")) for f in (tmp_path / "out/processed/run=0").glob("batch_id=*")}
    assert folders == {0, ids[19], ids[39]}  # 13 pulls
    assert Progress(spark, f"{out}/state", "0").before()[:2] == (ids[-1], 50)
    got = replies(spark, tmp_path)
    assert [i for i, *_ in got] == ids and all(f"Last Update ID: {before}\n" in text for (*_, text), before in zip(got, [0, *ids], strict=False))


def test_a_message_counts_before_none_whatever_pull(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    for message in (None, ((1, "n", None), "/ping")):
        land_updates(spark.createDataFrame([(7, message)], cm.UPDATE_SCHEMA), log)
    UpdateJob(None, out, IDS, now="2024-01-01").pull(spark, log)
    assert replies(spark, tmp_path) == [(7, 1, cm.PING_TEXT)]


def test_handlers_of_tables_get_one_pull(spark, tmp_path):
    log, out, sizes = str(tmp_path / "log"), str(tmp_path / "out"), []
    land_updates(log_rows(spark, range(5, 75, 5)), log)

    def count(commands):
        sizes.append(commands.count())
        return commands.select("update_id", "chat_id", F.lit(f"one of {sizes[-1]}").alias("reply"))

    registry = Registry()
    registry.register_command("status", count)
    UpdateJob(None, out, IDS, registry, now="2024-01-01").pull(spark, log, limit=6)
    assert sizes == [6, 6, 2] and [text for *_, text in replies(spark, tmp_path)] == ["one of 6"] * 12 + ["one of 2"] * 2


def test_the_rows_of_processed_updates_share_a_micro_batch(spark, tmp_path, monkeypatch):
    sf, ids = suppliers(spark, tmp_path, 95)
    monkeypatch.setattr("suite.queries.shared_path", lambda _, name: str(tmp_path / name))
    got = sorted(tuple(r) for r in QUERIES["processed_updates"](spark, sf).collect())
    assert got == [(0, 40, ids[39], "2024-01-31"), (ids[39], 40, ids[79], "2024-01-31"), (ids[79], 15, ids[94], "2024-01-31")]
    assert [f.name for f in (tmp_path / "updates/processed/run=0").glob("batch_id=*")] == ["batch_id=0"]


def test_replies_are_replaced_where_progress_was_lost(spark, tmp_path):
    """In steps, then from 0 again with all ids there: no micro-batch goes over the start of an earlier one."""
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    steps = [range(3, 60, 3), range(60, 90, 3), [90]]
    for step in steps:
        land_updates(log_rows(spark, step), log)
        UpdateJob(None, out, IDS, now="2024-01-01").pull(spark, log, limit=8)
    took = lambda: sorted((r["batch_id"], r["processed"], r["last_update_id"]) for r in read_processed(spark, out).collect())
    first, answered = took(), replies(spark, tmp_path)
    assert first == [(0, 8, 24), (24, 8, 48), (48, 3, 57), (57, 8, 81), (81, 2, 87), (87, 1, 90)]
    assert [i for i, *_ in answered] == list(range(3, 93, 3))
    for file in (tmp_path / "out/state").rglob("*.parquet"):
        file.write_bytes(b"damaged")
    land_updates(log_rows(spark, [93]), log)
    UpdateJob(None, out, IDS, now="2024-01-01").pull(spark, log, limit=8)
    assert took() == [*first[:-1], (87, 2, 93)]
    assert replies(spark, tmp_path)[:-1] == answered and len(replies(spark, tmp_path)) == 31


def test_a_failed_micro_batch_of_many_pulls_is_replaced(spark, tmp_path):
    log, out, calls = str(tmp_path / "log"), str(tmp_path / "out"), spark.sparkContext.accumulator(0)
    land_updates(log_rows(spark, range(5, 205, 5), "/again"), log)

    def again(chat, args):
        calls.add(1)
        return f"chat {chat}"

    registry = Registry()
    registry.register_function("again", again)
    real, Progress.note = Progress.note, lambda *a: 1 / 0
    try:
        with pytest.raises(Exception):  # noqa: B017
            UpdateJob(None, out, IDS, registry, now="2024-01-01").pull(spark, log, limit=4)
    finally:
        Progress.note = real
    land_updates(log_rows(spark, [205], "/again"), log)
    UpdateJob(None, out, IDS, registry, now="2024-01-01").pull(spark, log, limit=4)
    assert replies(spark, tmp_path) == [(i, 1, "chat 1") for i in range(5, 210, 5)]
    assert sum(r["processed"] for r in read_processed(spark, out).collect()) == 41 and calls.value == 81


def test_the_replies_of_pulls_share_a_micro_batch(spark, tmp_path, monkeypatch):
    sf, ids = suppliers(spark, tmp_path, 95)
    monkeypatch.setattr("suite.queries.shared_path", lambda _, name: str(tmp_path / name))
    got = sorted(tuple(r) for r in QUERIES["pulled_replies"](spark, sf).collect())
    asked = [i for i in ids if (i // 3 - 1) % 25 in t.CHAT_IDS]
    assert [(i, part) for i, _, part, _ in got] == [(i, 0) for i in asked]
    for i, chat, _, text in got:
        key = i // 3 - 1
        assert chat == key % 25
        before = max((j for j in ids if j < i), default=0)
        assert (f"Last Update ID: {before}\n" in text, text == cm.PING_TEXT, text == f"{cm.UNKNOWN_TEXT}foo") == (key % 3 == 0, key % 3 == 1, key % 3 == 2)
    assert [f.name for f in (tmp_path / "updates/outbox/run=0").glob("batch_id=*")] == ["batch_id=0"]


TICKS = "symbol string, event_id bigint, ts timestamp, price double"


def test_bars_in_steps_with_a_late_tick(spark, tmp_path):
    def at(second):
        return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)

    steps = [
        [("a", 1, at(0), 1.0), ("a", 2, at(50), 3.0), ("a", 3, at(70), 2.0)],
        [("a", 4, at(30), 9.0), ("b", 5, at(200), 5.0), ("a", 6, at(400), 6.0)],  # 30 s is late but within the delay
        [("a", 7, at(10), 99.0), ("a", 8, at(1000), 7.0)],  # 10 s is behind the watermark
    ]
    for i, rows in enumerate(steps):
        spark.createDataFrame(rows, TICKS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = stream_bars(spark.readStream.schema(TICKS).parquet(str(tmp_path / "in")), "1 minute", "2 minutes")
        run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    ticks = spark.createDataFrame([r for rows in steps for r in rows if r[1] != 7], TICKS)
    expected = {tuple(r) for r in build_bars(ticks).where("ts < '2024-01-01 00:10:00'").collect()}
    assert got == expected


def test_bars_to_the_end_of_the_input(spark, tmp_path):
    rows = [("a", i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=37 * i % 900), float(i)) for i in range(60)]
    ticks = spark.createDataFrame(rows, TICKS)
    ticks.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    assert {tuple(r) for r in bars_to_end(spark, stream).collect()} == {tuple(r) for r in build_bars(ticks).collect()}


def test_open_windows_are_closed_once(spark, tmp_path):
    at = lambda second: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)
    rows = [("a" if i % 3 else "b", i, at(20 * i), float(i * 7 % 50)) for i in range(200)]
    ticks = spark.createDataFrame(rows, TICKS)
    for i in range(4):
        ticks.where(f"event_id div 50 = {i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for _ in range(2):  # the end written again replaces itself
        run_to_end(stream, str(tmp_path / "out"), str(tmp_path / "cp"), delay="2 minutes")
        got = [tuple(r) for r in read_bars_to_end(spark, str(tmp_path / "out")).collect()]
        assert len(got) == len(set(got)) and set(got) == {tuple(r) for r in build_bars(ticks).collect()}
    parts = {r["batch_id"]: r["count"] for r in spark.read.parquet(str(tmp_path / "out")).groupBy("batch_id").count().collect()}
    assert parts.pop(AT_END) < 20 and len(parts) >= 3 and sum(parts.values()) > 100


def test_end_of_an_empty_input(spark, tmp_path):
    spark.createDataFrame([], TICKS).write.parquet(str(tmp_path / "in"))
    assert bars_to_end(spark, spark.readStream.schema(TICKS).parquet(str(tmp_path / "in"))).collect() == []
