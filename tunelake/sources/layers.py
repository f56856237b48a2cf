"""Layers as Parquet tables below one root folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class LayerStore:
    """Writes and reads the tables of each layer. A written table is also the barrier between layers:
    later jobs start from files, not from the lineage that produced them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def write(self, layer: str, table: str, df: DataFrame, folder_by: str | None = None) -> None:
        """Replace the table, in one folder per value of ``folder_by`` if given (see ``gathered``)."""
        writer = df.write.mode("overwrite")
        if folder_by is not None:
            writer = writer.partitionBy(folder_by)
        writer.parquet(self.path(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        try:
            self.spark.read.schema("_any int").parquet(self.path(layer, table))
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return False
        return True

    def replace_folders(
        self, layer: str, table: str, df: DataFrame, ddl: str, folder_by: str, folders: Sequence[int],
    ) -> DataFrame:
        """Replace the folders of some values of ``folder_by``, whose rows ``df`` holds; the others are not touched.

        Spark puts the new files of a folder in its place when all are written. A folder that has lost all rows
        keeps an empty file. Which ones have rows is seen as they are written, so that ``df`` is derived once.
        """
        path = self.path(layer, table)
        seen = Observation()
        rows = (F.count_if(F.col(folder_by) == folder).alias(str(folder)) for folder in folders)
        observed = df.observe(seen, F.count("*").alias("all"), *rows)
        observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(folder_by).parquet(path)
        for folder in sorted(folder for folder in set(folders) if not seen.get[str(folder)]):
            none = df.where(F.lit(False)).drop(folder_by).coalesce(1)
            none.write.mode("overwrite").parquet(f"{path}/{folder_by}={folder}")
        return self.read(layer, table, ddl)

    def read(self, layer: str, table: str, ddl: str | StructType) -> DataFrame:
        return self.spark.read.schema(ddl).parquet(self.path(layer, table))

    def replace(self, layer: str, table: str, df: DataFrame, ddl: str | StructType, folder_by: str | None = None) -> DataFrame:
        """Write the table and return it as read back."""
        self.write(layer, table, df, folder_by)
        return self.read(layer, table, ddl)


def gathered(df: DataFrame, column: str) -> DataFrame:
    """Bring equal values together before a write by folders, so that a folder gets few files.

    Spark sizes the tasks from the shuffled data: small values share one, a large value is split.
    """
    return df.hint("rebalance", F.col(column))
