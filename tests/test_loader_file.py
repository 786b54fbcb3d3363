import os
import random

import pytest
from pyspark.sql import functions as F

from shiplog.sources import loader_file, records
from shiplog.sources.catalog import column_catalog

END = "<eor>\n"


def _brute(body: bytes, first: int = 0):
    """(start, record) of every record, by splitting the whole file."""
    out, at = [], first
    parts = body[first:].split(END.encode())
    for i, part in enumerate(parts):
        if i < len(parts) - 1 or part:
            out.append((at, part.decode()))
        at += len(part) + len(END)
    return out


@pytest.mark.parametrize("split_bytes", [1, 5, 64])
def test_ranges_read_every_record_once(spark, tmp_path, split_bytes):
    rng = random.Random(split_bytes)
    body = "".join(rng.choice(["a", "é\t", "<eor>", "\n", END, "<eo", "r>\n", "", "begindata\n"]) for _ in range(60)) + "tail"
    path = tmp_path / "data"
    path.write_bytes(body.encode())
    got = records.numbered(records.read_records(spark, str(path), split_bytes=split_bytes))
    got = sorted((r["record_no"], r["start"], r["record"]) for r in got.collect())
    assert [r[1:] for r in got] == _brute(body.encode()) and [r[0] for r in got] == list(range(1, len(got) + 1))


def test_small_reads(spark, tmp_path, monkeypatch):
    """Ends that fall between two reads of a task."""
    monkeypatch.setattr(records, "READ_BYTES", 3)
    body = f"one{END}two<eor>three{END}{END}four{END}".encode()
    (tmp_path / "data").write_bytes(body)
    got = records.read_records(spark, str(tmp_path / "data"), split_bytes=4).collect()
    assert sorted((r["start"], r["record"]) for r in got) == _brute(body)


def test_folder_in_part_order_and_empty(spark, tmp_path):
    for n in (99999, 100000, 3):
        (tmp_path / f"part-{n:05d}-x.txt").write_text(f"r{n}{END}")
    (tmp_path / "part-00004-x.txt").write_text("")
    (tmp_path / "_SUCCESS").write_text("")
    got = records.numbered(records.read_records(spark, str(tmp_path)))
    assert [r["record"] for r in got.orderBy("record_no").collect()] == ["r3", "r99999", "r100000"]
    (tmp_path / "none").mkdir()
    assert records.read_records(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="absent"):
        records.read_records(spark, str(tmp_path / "absent")).count()


def test_self_contained_needs_its_data_line(spark, tmp_path):
    (tmp_path / "f").write_text(f"x begindata\nbegindata y\nr{END}")
    with pytest.raises(Exception, match="begindata"):
        records.read_records(spark, str(tmp_path / "f"), self_contained=True).count()


def _table(spark, n=300):
    texts = F.element_at(F.array(F.lit("plain"), F.lit("tab\there"), F.lit("line\nbegindata\n"), F.lit(None)), (F.col("id") % 4 + 1).cast("int"))
    return spark.range(n).select("id", texts.alias("note"), (F.col("id") * 7 % 100).alias("k"))


@pytest.mark.parametrize("slice_bytes", [loader_file.SLICE_BYTES, 37])
def test_written_file_is_control_lines_and_ordered_records(spark, tmp_path, monkeypatch, slice_bytes):
    monkeypatch.setattr(loader_file, "SLICE_BYTES", slice_bytes)
    df = _table(spark, 120)
    path = tmp_path / "deep" / "t.ctl"
    rejects = loader_file.write_loader_file(df, [F.col("k").desc(), "id"], str(path), "T")
    assert rejects.count() == 0 and os.listdir(path.parent) == ["t.ctl"]
    body = path.read_bytes()
    head, _, data = body.partition(b"\nbegindata\n")
    assert head.startswith(b"options (") and b"infile *" in head and head.endswith(b")")
    want = sorted(((r["id"], r["note"], r["k"]) for r in df.collect()), key=lambda r: (-r[2], r[0]))
    assert data == "".join(f"@..{i}..@\t@..{t or ''}..@\t@..{k}..@\t{END}" for i, t, k in want).encode()
    got = loader_file.read_loader_file(spark, str(path), split_bytes=50)
    assert sorted((r["start"], r["record"]) for r in got.collect()) == _brute(body, len(body) - len(data))


def test_load_back(spark, tmp_path):
    df = _table(spark)
    path = str(tmp_path / "t.ctl")
    loader_file.write_loader_file(df, ["id"], path, "T")
    good, bad, blank = loader_file.load_loader_file(spark, path, df.schema, "T", column_catalog(spark, {"T": df}), skip=10)
    assert sorted(map(tuple, good.collect())) == sorted(map(tuple, df.where("id >= 10").collect()))
    assert bad.count() == blank.count() == 0


def test_ambiguous_rows_are_returned(spark, tmp_path):
    df = spark.createDataFrame([(1, "ok"), (2, "bad..@\tx"), (3, END)], "id long, t string")
    rejects = loader_file.write_loader_file(df, ["id"], str(tmp_path / "t.ctl"), "T")
    assert sorted(r["id"] for r in rejects.collect()) == [2, 3]
    assert loader_file.read_loader_file(spark, str(tmp_path / "t.ctl")).count() == 1


def test_empty_table_is_control_lines_alone(spark, tmp_path):
    df = _table(spark).where("id < 0")
    loader_file.write_loader_file(df, ["id"], str(tmp_path / "t.ctl"), "T")
    assert (tmp_path / "t.ctl").read_text().endswith(")\nbegindata\n")
    assert loader_file.read_loader_file(spark, str(tmp_path / "t.ctl")).count() == 0


def test_sides_and_reasons(spark, tmp_path):
    lines = ["@..1..@\t@..x..@\t@..2..@\t", "3\t\t", "\t\t\t", "@..x..@\t@....@\t@..y..@\t", "@..4..@\tz\t5\textra\t"]
    (tmp_path / "d").write_text("".join(x + END for x in lines))
    schema = spark.createDataFrame([], "a long, b string, c int").schema
    out = loader_file.load_records(records.read_records(spark, str(tmp_path / "d")), schema).orderBy("record_no")
    got = [(r["record_no"], r["side"], r["reason"], r["a"], r["b"], r["c"]) for r in out.collect()]
    assert got == [
        (1, "good", None, 1, "x", 2),
        (2, "good", None, 3, None, None),
        (3, "discard", "no field is filled", None, None, None),
        (4, "bad", "a: not bigint", None, None, None),
        (5, "good", None, 4, "z", 5),
    ]
    assert [r["record_no"] for r in loader_file.load_records(records.read_records(spark, str(tmp_path / "d")), schema, skip=3).collect()] == [4, 5]
