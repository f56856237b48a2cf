import hashlib
import json

import pytest

from tests.conftest import RUN_AT, listener
from tunelake import schemas
from tunelake.operators.dedup import drop_copies
from tunelake.plans import bronze as bronze_plan
from tunelake.sources import raw_files


def digest(record):
    return hashlib.md5(json.dumps(record, sort_keys=True).encode()).hexdigest()


def as_text(value):
    return None if value is None else str(value)


def test_json_arrays_are_loaded_as_text_with_audit_columns(spark, raw_dir, raw_records):
    bronze = bronze_plan.load(spark, raw_dir, RUN_AT)
    for entity, key in (("listeners", "listener_id"), ("artists", "artist_id"), ("tracks", "track_id")):
        rows = {(r[key], r["_row_hash"]): r.asDict() for r in getattr(bronze, entity).collect()}
        assert len(rows) == len(raw_records[entity])
        for record in raw_records[entity]:
            row = rows[(record[key], digest(record))]
            assert {f: row[f] for f in record} == {f: as_text(v) for f, v in record.items()}
            assert row["_source_file"] == f"{entity}.json" and row["_loaded_at"] == RUN_AT
        assert set(dict(getattr(bronze, entity).dtypes).values()) == {"string"}


def test_csv_is_loaded_as_text(spark, raw_dir, raw_records):
    rows = bronze_plan.load(spark, raw_dir, RUN_AT).streams.collect()
    assert len(rows) == len(raw_records["streams"])
    assert sorted(r["_row_hash"] for r in rows) == sorted(digest(r) for r in raw_records["streams"])
    assert {r["_source_file"] for r in rows} == {"streams.csv"}
    empty = [r for r in rows if r.stream_id == "str_000067"]
    assert empty[0].duration_played_ms is None


def test_json_lines_give_the_same_rows_as_an_array(spark, tmp_path):
    records = [listener(1), listener(2, city=None), {k: v for k, v in listener(3).items() if k != "city"}]
    records[0]["unknown_field"] = "dropped"
    (tmp_path / "array.json").write_text(json.dumps(records))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in records))
    array = raw_files.read_json(spark, str(tmp_path / "array.json"), "listeners", RUN_AT)
    lines = raw_files.read_json(spark, str(tmp_path / "lines.json"), "listeners", RUN_AT, json_lines=True)
    assert array.columns == schemas.RAW_FIELDS["listeners"] + schemas.AUDIT_FIELDS
    assert sorted(array.drop("_source_file").collect()) == sorted(lines.drop("_source_file").collect())
    hashes = {r.listener_id: r["_row_hash"] for r in array.collect()}
    assert hashes["l2"] == digest(records[1]) and hashes["l3"] == digest(records[2])


def test_the_hash_tells_numbers_from_text(spark, tmp_path):
    records = [{"artist_id": "a", "formed_year": 1}, {"artist_id": "a", "formed_year": "1"}]
    (tmp_path / "artists.json").write_text(json.dumps(records))
    rows = raw_files.read_json(spark, str(tmp_path / "artists.json"), "artists", RUN_AT).collect()
    assert len({r["_row_hash"] for r in rows}) == 2 and {r.formed_year for r in rows} == {"1"}


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        'extra,track_id,stream_id,device_type\n1,"t ""x"", y",s1,  web \n2,t2,s2,\n', encoding="utf-8"
    )
    rows = raw_files.read_csv(spark, str(tmp_path / "s.csv"), "streams", RUN_AT).orderBy("stream_id").collect()
    assert [(r.stream_id, r.track_id, r.device_type, r.listener_id) for r in rows] == [
        ("s1", 't "x", y', "  web ", None), ("s2", "t2", None, None)]


def test_csv_cells_may_hold_line_breaks_when_asked_for(spark, tmp_path):
    (tmp_path / "s.csv").write_text('stream_id,track_id\ns1,"two\nlines"\n', encoding="utf-8")
    rows = raw_files.read_csv(spark, str(tmp_path / "s.csv"), "streams", RUN_AT, multi_line=True).collect()
    assert [(r.stream_id, r.track_id) for r in rows] == [("s1", "two\nlines")]


def test_copies_are_dropped_whatever_their_number_and_place(spark):
    rows = [("a", "h1")] * 500 + [("b", "h2"), ("c", "h3"), ("c", "h3")]
    df = spark.createDataFrame(rows, "v string, _row_hash string").repartition(7)
    assert sorted(r.v for r in drop_copies(df, ["v"]).collect()) == ["a", "b", "c"]


def test_a_malformed_array_ends_the_load(spark, tmp_path):
    text = json.dumps([listener(n) for n in range(5)])
    for name, broken in (("cut", text[:-40]), ("slip", text.replace('"l2"', '"l2', 1))):
        (tmp_path / f"{name}.json").write_text(broken)
        with pytest.raises(Exception, match=f"(?s){name}.json|MALFORMED"):
            raw_files.read_json(spark, str(tmp_path / f"{name}.json"), "listeners", RUN_AT).collect()


def test_unreadable_lines_and_rows_are_rejections(spark, tmp_path):
    lines = [json.dumps(listener(1)), '{"listener_id": "l2', json.dumps(listener(3))]
    (tmp_path / "listeners.json").write_text("\n".join(lines))
    path = str(tmp_path / "listeners.json")
    kept = raw_files.read_json(spark, path, "listeners", RUN_AT, json_lines=True).collect()
    refused = raw_files.unreadable_json(spark, path, "listeners").collect()
    assert sorted(r.listener_id for r in kept) == ["l1", "l3"]
    assert [tuple(r) for r in refused] == [("listeners", None, f"Unreadable line in listeners.json: {lines[1]}")]
    header = ",".join(schemas.RAW_FIELDS["streams"])
    cells = ["1"] * len(schemas.RAW_FIELDS["streams"])
    rows = [",".join(cells), ",".join([*cells, "surplus"]), ",".join(cells[:-2])]
    (tmp_path / "streams.csv").write_text("\n".join([header, *rows]) + "\n")
    path = str(tmp_path / "streams.csv")
    assert raw_files.read_csv(spark, path, "streams", RUN_AT).count() == 1
    refused = raw_files.unreadable_csv(spark, path, "streams").collect()
    assert sorted(r.rejection_reason for r in refused) == sorted(
        f"Row that does not fit the header in streams.csv: {row}" for row in rows[1:]
    )
