"""Raw JSON and CSV files as all-text bronze frames with audit columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelake import schemas
from tunelake.functions.row_hash import json_text, record_text, row_hash
from tunelake.sources import split_files


#: Holds the text of a record that cannot be read.
UNREADABLE = "_unreadable"


def _audited(
    df: DataFrame, texts: Mapping[str, str], json_texts: Mapping[str, str], source_file: str, loaded_at: str,
) -> DataFrame:
    """Project the declared fields as text and add where, when and what was loaded."""
    projected = df.selectExpr(
        *(f"{text} AS {name}" for name, text in texts.items()),
        f"{source_file} AS _source_file",
        f"{record_text(json_texts)} AS _record",
    )
    return projected.select(
        *texts, "_source_file", F.lit(loaded_at).alias("_loaded_at"), F.expr(row_hash("_record")).alias("_row_hash")
    )


def read_json(
    spark: SparkSession, path: str, entity: str, loaded_at: str, json_lines: bool = False,
) -> DataFrame:
    """Records of flat objects; fields beyond the declared ones are dropped.

    ``json_lines=False`` reads files holding one array each, of any size: each is read by many tasks. A malformed
    array ends the load; a malformed line is left to ``unreadable_json``. Fields are read with their JSON types, so
    that the hash tells ``1`` from ``"1"``, and then turned into text.
    """
    fields = schemas.RAW_FIELDS[entity]
    schema = ", ".join(f"{field} variant" for field in fields)
    if json_lines:
        records, file_name = _json_lines(spark, path, schema).where(F.col(UNREADABLE).isNull()), "_metadata.file_name"
    else:
        records, file_name = _array_objects(spark, path, schema), "_file_name"

    def as_text(field: str) -> str:
        text = f"try_variant_get({field}, '$', 'string')"
        return f"CASE WHEN schema_of_variant({field}) = 'BOOLEAN' THEN initcap({text}) ELSE {text} END"

    return _audited(
        records,
        {field: as_text(field) for field in fields},
        {field: f"to_json({field})" for field in fields},
        file_name,
        loaded_at,
    )


def _or_fail(sound: Column, reason: str) -> Column:
    """True, or the end of the load."""
    return F.when(sound, True).otherwise(F.raise_error(F.concat(F.lit(f"{reason} in "), "_file_name")).cast("boolean"))


def _array_objects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The objects of array files; an array cannot be read beyond a slip, so one ends the load and names the file."""
    given = split_files.records(spark, path, split_files.JSON_ARRAY).withColumnRenamed("file_name", "_file_name")
    parted = F.when(F.col("is_first"), F.col("record").rlike(r"^\ufeff?\s*\[\s*\{")).otherwise(
        F.col("record").rlike(r"^\s*,\s*\{")
    )
    body = F.regexp_replace("record", r"^\ufeff?\s*[\[,]\s*", "")
    parsed = F.from_json(body, f"{schema}, {UNREADABLE} string", {"columnNameOfCorruptRecord": UNREADABLE})
    objects = given.select("_file_name", parted.alias("_parted"), parsed.alias("_object"))
    sound = F.col("_parted") & F.col(f"_object.{UNREADABLE}").isNull()
    return objects.where(_or_fail(sound, "Malformed array")).select("_file_name", "_object.*")


def _any(text: str) -> str:
    """True for every record. Spark refuses to read the text of unreadable records alone, so this reads a field too."""
    return f"coalesce(length({text}), 0) >= 0"


def _json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    records = spark.read.schema(f"{schema}, {UNREADABLE} string").option("columnNameOfCorruptRecord", UNREADABLE)
    first = schema.split()[0]
    return records.json(path).where(_any(f"try_variant_get({first}, '$', 'string')"))


def _refused(records: DataFrame, entity: str, reason: str, file_name: str = "_metadata.file_name") -> DataFrame:
    """Unreadable records as rejections, each with its file and text."""
    return records.where(F.col(UNREADABLE).isNotNull()).select(
        F.lit(entity).alias("source_table"), F.lit(None).cast("string").alias("source_id"),
        F.concat(F.lit(f"{reason} in "), F.col(file_name), F.lit(": "), F.col(UNREADABLE)).alias("rejection_reason"),
    )


def unreadable_json(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """The lines of JSON-lines files that are no objects: ``source_table, source_id, rejection_reason``."""
    schema = ", ".join(f"{field} variant" for field in schemas.RAW_FIELDS[entity])
    return _refused(_json_lines(spark, path, schema), entity, "Unreadable line")


_CSV = {"quote": '"', "escape": '"'}


def _csv_schema(header: list[str]) -> str:
    return ", ".join(f"`{column}` string" for column in [*header, UNREADABLE])


def _csv_rows(spark: SparkSession, path: str, multi_line: bool) -> tuple[list[str], DataFrame]:
    """The first file's header, and all rows with ``_file_name``."""
    options = {**_CSV, "header": True, "multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    if multi_line:
        return header, _quoted_rows(spark, path, header)
    # All columns are parsed, as a row of which only some are read would seem to fit.
    rows = spark.read.schema(_csv_schema(header)).options(
        **options, enforceSchema=False, columnNameOfCorruptRecord=UNREADABLE, columnPruning=False
    ).csv(path)
    return header, rows.where(_any(f"`{header[0]}`")).withColumn("_file_name", F.col("_metadata.file_name"))


def _quoted_rows(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """Rows whose cells may hold line breaks; each file's own header is checked against ``header``."""
    given = split_files.records(spark, path, split_files.CSV).select(
        F.col("file_name").alias("_file_name"), "is_first", F.regexp_replace("record", r"\r?\n$", "").alias("_record")
    ).where(F.trim("_record") != "")
    options = {**_CSV, "multiLine": "true", "columnNameOfCorruptRecord": UNREADABLE}
    record = F.regexp_replace("_record", "^\ufeff", "")
    rows = given.select("_file_name", "is_first", F.from_csv(record, _csv_schema(header), options).alias("_row"))
    cells = F.array(*(F.col(f"_row.`{column}`") for column in header))
    same = (cells == F.array(*map(F.lit, header))) & F.col(f"_row.{UNREADABLE}").isNull()
    checked = rows.where(_or_fail(~F.col("is_first") | F.coalesce(same, F.lit(False)), "Another header"))
    return checked.where(~F.col("is_first")).select("_file_name", "_row.*")


def unreadable_csv(spark: SparkSession, path: str, entity: str, multi_line: bool = False) -> DataFrame:
    """The rows with more or fewer cells than the header: ``source_table, source_id, rejection_reason``."""
    return _refused(_csv_rows(spark, path, multi_line)[1], entity, "Row that does not fit the header", "_file_name")


def read_csv(spark: SparkSession, path: str, entity: str, loaded_at: str, multi_line: bool = False) -> DataFrame:
    """Rows of CSV files with a header; columns are found by name, an empty cell is missing.

    The header is the only thing read ahead; each file's own header is checked against it. Quotes
    inside quotes are doubled. ``multi_line`` allows line breaks inside quotes, at the price of reading the
    files twice; a file that ends inside quotes ends the load. Rows that do not fit the header are left to
    ``unreadable_csv``.
    """
    header, rows = _csv_rows(spark, path, multi_line)
    rows = rows.where(F.col(UNREADABLE).isNull())
    fields = schemas.RAW_FIELDS[entity]
    return _audited(
        rows,
        {field: f"nullif({field}, '')" if field in header else "CAST(NULL AS STRING)" for field in fields},
        {field: json_text(f"coalesce({field}, '')") for field in fields if field in header},
        "_file_name",
        loaded_at,
    )


def from_frame(df: DataFrame, entity: str, source_file: str, loaded_at: str) -> DataFrame:
    """Stage a frame of text columns as if it had been read from a file of JSON strings."""
    fields = schemas.RAW_FIELDS[entity]
    return _audited(
        df, {field: field for field in fields}, {field: json_text(field) for field in fields}, f"'{source_file}'",
        loaded_at,
    )
