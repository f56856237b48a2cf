import csv
import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tunelake.plans import pipeline  # noqa: E402
from tunelake.session import local_session  # noqa: E402
from tunelake.sources.layers import LayerStore  # noqa: E402
from tunelake.plans import bronze as bronze_plan  # noqa: E402
from tunelake.plans.gold import Calendar  # noqa: E402

RUN_AT = "2026-01-02T03:04:05"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="4", shuffle_partitions=4)
    # The fixtures are tiny: compiling their plans would take longer than running them.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield session
    session.stop()


def listener(number, **changes):
    record = {
        "listener_id": f"l{number}", "email": f"L{number}@Mail.com", "username": f" user{number} ",
        "first_name": "Ann", "last_name": f"No{number}", "birth_date": "1990-05-06", "city": "Oslo",
        "country": "Norway", "subscription_type": "premium", "created_at": "2024-01-01T10:00:00",
    }
    return record | changes


def artist(number, **changes):
    record = {
        "artist_id": f"art_{number:03d}", "name": f"Band {number}", "genre": "HIP HOP", "country": "Peru",
        "formed_year": 2000, "monthly_listeners": 5000,
    }
    return record | changes


def track(number, **changes):
    record = {
        "track_id": f"trk_{number:04d}", "title": f"Song {number}", "artist_id": f"art_{number % 3 + 1:03d}",
        "album": None, "duration_ms": 200_000, "genre": " rock", "release_date": "2020-01-31", "explicit": False,
    }
    return record | changes


def stream(number, **changes):
    record = {
        "stream_id": f"str_{number:06d}", "listener_id": f"l{number % 3 + 1}", "track_id": f"trk_{number % 7 + 1:04d}",
        "streamed_at": f"2025-{number % 12 + 1:02d}-{number % 28 + 1:02d}T{number % 24:02d}:15:00",
        "duration_played_ms": str(20_000 * (number % 11)), "device_type": ["mobile", "web", "tablet"][number % 3],
        "shuffle_mode": str(number % 2 == 0), "offline_mode": "False",
    }
    return record | changes


def write_raw(folder, listeners, artists, tracks, streams):
    for name, records in (("listeners", listeners), ("artists", artists), ("tracks", tracks)):
        (folder / f"{name}.json").write_text(json.dumps(records, indent=1), encoding="utf-8")
    with open(folder / "streams.csv", "w", newline="", encoding="utf-8") as file:
        writer = csv.DictWriter(file, fieldnames=list(stream(0)))
        writer.writeheader()
        writer.writerows(streams)


@pytest.fixture(scope="session")
def raw_records():
    """Small raw inputs with one defect of every kind."""
    return {
        "listeners": [
            listener(1), listener(2, birth_date=None, city=None, subscription_type=" Free"),
            listener(3, birth_date="not a date", city="  "),
            listener(4, city="None"),  # never plays
            listener(5, subscription_type="trial"),
            listener(6), listener(6, first_name="Other"),
        ],
        "artists": [
            artist(1), artist(2, genre="r&b", formed_year=None, monthly_listeners=10_000),
            artist(3, genre=" Pop ", monthly_listeners=1_000_000),
        ],
        "tracks": [
            *(track(n) for n in range(1, 6)),
            track(6, release_date="03/04/2021", album=" Best ", explicit=True),
            track(7, duration_ms=0),
            track(8, artist_id="art_999"),
            track(9, release_date="soon"),
        ],
        "streams": [
            *(stream(n) for n in range(60)),
            stream(0), stream(1),                               # copies
            stream(60, track_id="trk_0008"), stream(61, track_id="trk_7777"), stream(61, track_id="trk_7777"),
            stream(62, listener_id="l5"), stream(63, listener_id="nobody", track_id="nothing"),
            stream(64, device_type="toaster"), stream(65, streamed_at="2024-12-31T23:59:59"),
            stream(66), stream(66, duration_played_ms="1"),     # one id, two contents
            stream(67, duration_played_ms=""), stream(68, track_id=" trk_0001 ", device_type=" web "),
        ],
    }


@pytest.fixture(scope="session")
def raw_dir(tmp_path_factory, raw_records):
    folder = tmp_path_factory.mktemp("raw")
    write_raw(folder, **raw_records)
    return str(folder)


@pytest.fixture(scope="session")
def layers(spark, raw_dir, tmp_path_factory):
    store = LayerStore(spark, str(tmp_path_factory.mktemp("layers")))
    return pipeline.write_layers(store, bronze_plan.load(spark, raw_dir, RUN_AT), RUN_AT, Calendar())


@pytest.fixture(scope="session")
def gold(layers):
    return layers[2]
