import gzip
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from barframe.sources import record_files as rf
from barframe.sources.sinks import read_runs, write_run

GOOD = '{"data": [1, {"a": "x]\\""}, "é🙂", [1, 2], null, 12.5e3, -7], "more": {"data": [[]]}}'


def pieces(text, n):
    raw = text.encode() if isinstance(text, str) else text
    return (raw[i : i + n] for i in range(0, len(raw), n))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 1000])
def test_records_at_any_piece_size(n):
    want = [("$.data", i, r) for i, r in enumerate(["1", '{"a": "x]\\""}', '"é🙂"', "[1, 2]", "null", "12.5e3", "-7"])]
    assert list(rf.array_records(pieces(GOOD, n), ["$.data"])) == want
    nested = '﻿{"x": {"data": [0]}, "allSec": {"z": 1, "data": [{"k": 1}, 2 ]}, "t": [{}]}'
    assert list(rf.array_records(pieces(nested, n), ["$.allSec.data"])) == [("$.allSec.data", 0, '{"k": 1}'), ("$.allSec.data", 1, "2")]
    split = '{"B": [], "A": [1, 2], "C": 5}'
    assert list(rf.array_records(pieces(split, n), ["$.A", "$.B"])) == [("$.A", 0, "1"), ("$.A", 1, "2")]


@pytest.mark.parametrize("bad", ["", '{"data":[1,2', '{"data":1}', "[]", '{"data":[1]} x', '{"data":[1,]}', "nope", '{"data" [1]}', '{1: 2}', b'{"data": ["\xff"]}'])
def test_broken_documents(bad):
    with pytest.raises(rf.DocumentError):
        list(rf.array_records(pieces(bad, 3), ["$.data"]))


def test_a_large_document_in_bounded_memory(monkeypatch):
    held = []
    more = rf.Pieces.more
    monkeypatch.setattr(rf.Pieces, "more", lambda self: (more(self), held.append(len(self.text)))[0])

    def document():
        yield b'{"skipped": ['
        for i in range(40):
            yield (", ".join(f'{{"n": {i}}}' for _ in range(20_000)) + (", " if i < 39 else "")).encode()
        yield b'], "data": ['
        for i in range(40):
            yield (", ".join(f'{{"n": {i}}}' for _ in range(20_000)) + (", " if i < 39 else "")).encode()
        yield b"]}"

    records = rf.array_records(document(), ["$.data"])
    assert sum(1 for _ in records) == 800_000
    assert max(held) < 2 * 240_000  # a piece and what was left of the one before, of 18 MB in all


def test_landed_files(spark, tmp_path):
    for name, text in (("index_name=A B", GOOD), ("index_name=x%3Ay+z", '{"data": []}'), ("index_name=cut", GOOD[:40]), ("index_name=other", '{"data": [5]}')):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "part-0.json").write_text(text)
        (tmp_path / "in" / name / "_SUCCESS").write_text("")
    path = str(tmp_path / "in")
    got = rf.read_membership_records(spark, path, ["A B", "x:y+z", "cut", "none"], strict=False).collect()
    assert sorted((r["index_name"], r["pos"]) for r in got) == [("A B", i) for i in range(7)]
    with pytest.raises(PySparkException, match="cut"):
        rf.read_membership_records(spark, path, ["cut"]).collect()
    with pytest.raises(PySparkException, match="FileNotFound|missing"):
        rf.read_records(spark, str(tmp_path / "missing"), ["$.data"]).collect()
    one = rf.read_records(spark, f"{path}/index_name=other/part-0.json", ["$.data"])
    assert [tuple(r) for r in one.collect()] == [("", "$.data", 0, "5")]


def test_snapshots_of_a_catalog(spark, tmp_path):
    docs = {"Volume Gainers": '{"data": [{"a": 1}]}', "Top Losers": '{"allSec": {"data": [2, 3]}}', "Large Deals": '{"BULK_DEALS_DATA": [4], "SHORT_DEALS_DATA": [5], "BLOCK_DEALS_DATA": []}', "Unknown": "{}"}
    catalog = {}
    for name, text in docs.items():
        catalog[name] = str(tmp_path / f"{name}.json")
        (tmp_path / f"{name}.json").write_text(text)
    got = rf.read_snapshot_records(spark, catalog)
    assert sorted(map(tuple, got.collect())) == [("Bulk Deals Data", 0, "4"), ("Short Deals Data", 0, "5"), ("Top Losers", 0, "2"), ("Top Losers", 1, "3"), ("Volume Gainers", 0, '{"a": 1}')]
    (tmp_path / "Large Deals.json").write_text(json.dumps({"BULK_DEALS_DATA": [4]}))
    with pytest.raises(PySparkException, match="BLOCK_DEALS_DATA"):
        rf.read_snapshot_records(spark, catalog).collect()


def test_tasks_land_slices_of_a_document(spark, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    from suite import queries as q

    orders = spark.range(2000).select(F.lit(7).cast("long").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit(1.5).alias("o_totalprice"), F.lit("1-URGENT").alias("o_orderpriority"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    folders, text = [], DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, path, *more: (folders.append(path), text(self, path, *more))[1])
    monkeypatch.setattr(q, "SLICE", 100_000, raising=False)
    rows = q.landed_snapshots(spark, str(tmp_path)).collect()
    lines = [r["count"] for f in set(folders) for r in spark.read.text(f"{f}/key=VolumeGainers").groupBy(F.input_file_name()).count().collect()]
    assert sum(lines) == 4002 and max(lines) < 1000  # all places are equal but for the row
    gained = [r["raw"] for r in sorted(rows, key=lambda r: r["pos"]) if r["category"] == "Volume Gainers"]
    assert [r["pos"] for r in rows if r["category"] == "Volume Gainers"] == list(range(4001)) and gained[0] == "null"
    assert sorted(gained[1:2001]) == sorted(f'{{"symbol":"C{i}","price":1.5}}' for i in range(2000))
    assert sorted(gained[2001:]) == sorted(f'{{"symbol":"O7","qty":{i},"meta":{{"name":"1-URGENT"}}}}' for i in range(2000))
    assert sorted(tuple(r) for r in rows if r["category"] != "Volume Gainers") == [("Bulk Deals Data", 0, "null"), ("Short Deals Data", 0, "7"), ("Top Losers", 0, "null")]


def test_parts_are_joined_in_order_of_their_numbers(spark, tmp_path):
    parts, path = tmp_path / "parts", tmp_path / "t"
    for folder, files in {"index_name=A B": {"part-00002-x.txt": '{"data": [1', "part-100000-x.txt": ", 4]}", "part-99999-x.txt.gz": ", 3", "part-00010-x.txt": ", 2", ".part-00010-x.txt.crc": "crc"}, "index_name=x%3Ay+z": {"part-00000-x.txt": '{"data": []}'}, "_temporary": {"part-00000-x.txt": "{"}}.items():
        (parts / folder).mkdir(parents=True)
        for name, text in files.items():
            (parts / folder / name).write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
    (parts / "_SUCCESS").write_text("")
    for _ in range(2):  # a repeated run leaves one document
        rf.join_parts(spark, str(parts), str(path))
    assert sorted(str(f.relative_to(path)) for f in path.rglob("*") if f.is_file()) == ["index_name=A B/document.json", "index_name=x%3Ay+z/document.json"]
    got = rf.read_membership_records(spark, str(path), ["A B", "x:y+z"]).collect()
    assert sorted(tuple(r) for r in got) == [("A B", i, str(i + 1)) for i in range(4)]
    (tmp_path / "none").mkdir()
    rf.join_parts(spark, str(tmp_path / "none"), f"file:{tmp_path}/nothing")
    assert list((tmp_path / "nothing").iterdir()) == []


def test_runs_are_written_once(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.range(4)
    for run in ("007", "2024-01-01 00:00:00", "a/b=c%2F", "007"):
        write_run(rows.withColumn("of", F.lit(run)), path, run)
    assert not write_run(rows, path, "007")
    rows.withColumn("of", F.lit("x")).write.parquet(f"{path}/run=_failed")
    got = read_runs(spark, path)
    assert {(r["run"], r["of"]) for r in got.collect()} == {(r, r) for r in ("007", "2024-01-01 00:00:00", "a/b=c%2F")} and got.count() == 12
    assert write_run(rows.withColumn("of", F.lit("failed")), path, "failed")
    assert read_runs(spark, path).where("run = 'failed'").count() == 4
