"""Bronze layer: raw records kept as text, with audit columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tunelake import schemas
from tunelake.sources import raw_files
from tunelake.sources.layers import LayerStore

LAYER = "bronze"
RAW_FILES = {
    "listeners": "listeners.json", "artists": "artists.json", "tracks": "tracks.json", "streams": "streams.csv",
}


class Bronze:
    """The four staging tables; each is obtained on first use.

    ``unreadable`` holds the records that could not be read, as rejections, a frame for each input that has any kind.
    """

    def __init__(self, obtain: Callable[[str], DataFrame], unreadable: Sequence[DataFrame] = ()):
        self._obtain = obtain
        self.unreadable = unreadable

    @cached_property
    def listeners(self) -> DataFrame:
        return self._obtain("listeners")

    @cached_property
    def artists(self) -> DataFrame:
        return self._obtain("artists")

    @cached_property
    def tracks(self) -> DataFrame:
        return self._obtain("tracks")

    @cached_property
    def streams(self) -> DataFrame:
        return self._obtain("streams")

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in schemas.BRONZE}


def load(spark: SparkSession, raw_dir: str, loaded_at: str, json_lines: bool = False) -> Bronze:
    """Read the four raw inputs. ``loaded_at`` is one timestamp for the whole batch."""
    def path(entity: str) -> str:
        return f"{raw_dir.rstrip('/')}/{RAW_FILES[entity]}"

    def obtain(entity: str) -> DataFrame:
        if entity == "streams":
            return raw_files.read_csv(spark, path(entity), entity, loaded_at)
        return raw_files.read_json(spark, path(entity), entity, loaded_at, json_lines)

    unreadable = [raw_files.unreadable_csv(spark, path("streams"), "streams")]
    if json_lines:
        unreadable += [raw_files.unreadable_json(spark, path(e), e) for e in RAW_FILES if e != "streams"]
    return Bronze(obtain, unreadable)


def writing(store: LayerStore, bronze: Bronze) -> Bronze:
    """The same records, each table written on first use."""
    return Bronze(
        lambda name: store.replace(LAYER, name, getattr(bronze, name), schemas.BRONZE[name]), bronze.unreadable
    )


def read(store: LayerStore) -> Bronze:
    return Bronze(lambda name: store.read(LAYER, name, schemas.BRONZE[name]))
