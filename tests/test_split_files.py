import csv
import io
import json
import random

import numpy as np
import pytest

from tests.conftest import RUN_AT, track
from tunelake.sources import raw_files, split_files
from tunelake.sources.split_files import CSV, JSON_ARRAY, Walk, quote_marks

TRICKY = ['plain', 'a } b', '{"', 'x\\', '\\"}', 'é}', '}}{{', 'two\nlines', '", "', '日本"', '\\\\"{', '[,]', '']


@pytest.fixture
def small_parts(spark):
    """Files are cut into parts of few bytes."""
    for name, value in (("spark.sql.files.maxPartitionBytes", "400b"), ("spark.sql.files.openCostInBytes", "0")):
        spark.conf.set(name, value)
    yield
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(name)


def tricky_objects(seed, count):
    rng = random.Random(seed)
    for i in range(count):
        yield {
            "track_id": f"t{i}", "title": rng.choice(TRICKY) * rng.choice([1, 1, 1, 40]), "artist_id": rng.choice(TRICKY),
            "duration_ms": i, "extra": {"deep": [{"x": rng.choice(TRICKY)}, {}], "y": rng.choice(TRICKY)},
        }


def test_quotes_behind_backslashes():
    for text in ['a"b', r'\"', r'\\"', r'"\\\""', r'\\\\"x\"', '\\']:
        plain, escaped = [], False
        for c in text:
            plain.append(c == '"' and not escaped)
            escaped = c == "\\" and not escaped
        assert quote_marks(np.frombuffer(text.encode(), np.uint8), True).tolist() == plain


@pytest.mark.parametrize("indent", [None, 1])
def test_walk_finds_the_objects_of_any_number_of_pieces(indent):
    objects = list(tricky_objects(3, 40))
    data = json.dumps(objects, indent=indent, ensure_ascii=False).encode()
    pieces = [piece + b"}" for piece in data.split(b"}")]
    pieces[-1] = pieces[-1][:-1]
    for size in (1, 3, 50, 10_000):
        walk, found = Walk(JSON_ARRAY), []
        for begin in range(0, len(pieces), size):
            found += walk.records(b"".join(pieces[begin:begin + size]))
        assert [json.loads(text.lstrip(b" \n[,")) for _, text in found] == objects
        assert walk.rest() is None and walk.depth == 0 and not walk.inside


@pytest.mark.parametrize("indent", [None, 2])
def test_one_array_is_read_by_many_tasks(spark, tmp_path, small_parts, indent):
    objects = list(tricky_objects(5, 60))
    path = str(tmp_path / "tracks.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(objects, file, indent=indent, ensure_ascii=False)
    found = split_files.records(spark, path, JSON_ARRAY)
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 15
    texts = [row.record.lstrip(" \n[,") for row in found.collect()]
    assert sorted(map(json.loads, texts), key=lambda o: o["duration_ms"]) == objects
    assert [row.is_first for row in found.collect()].count(True) == 1
    one_task = spark.read.schema("track_id string, title string, artist_id string").options(
        multiLine=True, mode="FAILFAST").json(path)
    rows = raw_files.read_json(spark, path, "tracks", RUN_AT)
    assert sorted(map(tuple, rows.select("track_id", "title", "artist_id").collect())) == sorted(map(tuple, one_task.collect()))
    assert {row["_source_file"] for row in rows.collect()} == {"tracks.json"}


def test_more_parts_than_are_broadcast(spark, tmp_path, small_parts, monkeypatch):
    monkeypatch.setattr(split_files, "BROADCAST_PARTS", 0)
    objects = list(tricky_objects(6, 30))
    path = str(tmp_path / "tracks.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(objects, file, ensure_ascii=False)
    texts = [row.record.lstrip(" \n[,") for row in split_files.records(spark, path, JSON_ARRAY).collect()]
    assert sorted(map(json.loads, texts), key=lambda o: o["duration_ms"]) == objects


def csv_rows(seed, count):
    rng = random.Random(seed)
    cells = ["plain", "a,b", 'say "x"', "two\nlines", "\n\n", '"', "", "x" * 200 + "\n" + "y" * 300, "é\r\nz"]
    return [[f"s{i}", rng.choice(cells), rng.choice(cells)] for i in range(count)]


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_one_csv_with_line_breaks_is_read_by_many_tasks(spark, tmp_path, small_parts, line_end):
    rows = csv_rows(2, 60)
    text = io.StringIO(newline="")
    writer = csv.writer(text, lineterminator=line_end)
    writer.writerows([["stream_id", "track_id", "device_type"], *rows])
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_bytes(text.getvalue().replace("s1", "s1" + name[0]).encode())
    found = raw_files.read_csv(spark, str(tmp_path), "streams", RUN_AT, multi_line=True)
    assert split_files.records(spark, str(tmp_path), CSV).count() == 122
    wanted = [
        (i.replace("s1", "s1" + name), t.replace("\r\n", "\n") or None, d.replace("\r\n", "\n") or None, f"{name}.csv")
        for i, t, d in rows for name in "ab"
    ]
    got = found.select("stream_id", "track_id", "device_type", "_source_file").collect()
    clean = lambda x: x and x.replace("\r\n", "\n")
    assert sorted(map(str, ((i, clean(t), clean(d), f) for i, t, d, f in got))) == sorted(map(str, wanted))


def test_rows_that_do_not_fit_and_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('stream_id,track_id\ns1,"two\nlines"\ns2\n\ns3,x,"surplus\ncell"\ns4,y')
    path = str(tmp_path / "a.csv")
    rows = raw_files.read_csv(spark, path, "streams", RUN_AT, multi_line=True).collect()
    assert sorted((r.stream_id, r.track_id) for r in rows) == [("s1", "two\nlines"), ("s4", "y")]
    refused = raw_files.unreadable_csv(spark, path, "streams", multi_line=True).collect()
    assert sorted(r.rejection_reason for r in refused) == [
        "Row that does not fit the header in a.csv: s2", 'Row that does not fit the header in a.csv: s3,x,"surplus\ncell"'
    ]
    (tmp_path / "b.csv").write_text("stream_id,other\ns9,z\n")
    with pytest.raises(Exception, match="Another header in (a|b).csv"):
        raw_files.read_csv(spark, str(tmp_path), "streams", RUN_AT, multi_line=True).collect()


@pytest.mark.parametrize("change", [
    lambda t: t[:-1], lambda t: t[:-40], lambda t: t + "]", lambda t: t.replace('"t3"', '"t3', 1),
    lambda t: t.replace("}, {", "} {", 1), lambda t: t[1:], lambda t: t.replace('"title": ', '"title" ', 1),
    lambda t: t + ' "', lambda t: "[" + t, lambda t: t.replace("}, {", "}, 5, {", 1),
])
def test_malformed_arrays_end_the_load_with_the_file(spark, tmp_path, change):
    text = json.dumps([track(n) | {"track_id": f"t{n}"} for n in range(6)])
    (tmp_path / "broken.json").write_text(change(text))
    with pytest.raises(Exception, match="broken.json"):
        raw_files.read_json(spark, str(tmp_path / "broken.json"), "tracks", RUN_AT).collect()


def test_empty_inputs(spark, tmp_path):
    (tmp_path / "tracks.json").write_text(" [ ]\n")
    assert raw_files.read_json(spark, str(tmp_path / "tracks.json"), "tracks", RUN_AT).collect() == []
    (tmp_path / "s.csv").write_text("stream_id,track_id\n")
    assert raw_files.read_csv(spark, str(tmp_path / "s.csv"), "streams", RUN_AT, multi_line=True).collect() == []
    (tmp_path / "open.csv").write_text('stream_id,track_id\ns1,"open\n')
    with pytest.raises(ValueError, match="open.csv"):
        raw_files.read_csv(spark, str(tmp_path / "open.csv"), "streams", RUN_AT, multi_line=True)
