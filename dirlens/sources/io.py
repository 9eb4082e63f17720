"""Sources (S1-S7) and sinks (K1-K7).

Readers always take an explicit schema and add a stable ``seq`` =
struct(file path, position in file). It is orderable and independent of
partitioning (monotonically_increasing_id would not be).
"""

from __future__ import annotations

import json
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Dictionary
from ..functions.clean import strip_ws
from ..schemas import ENVELOPE_METADATA
from ..session import ship_package


def read_envelope(spark: SparkSession, path: str, field: str, record: T.StructType,
                  with_metadata: bool = False, with_quarantine: bool = False):
    """Multi-line JSON envelope files ``{metadata, <field>: [records]}`` -> one row per record.

    ``with_metadata`` adds the envelope's ``metadata`` to its records. ``with_quarantine`` also
    returns the files that are no envelope (file, _corrupt_record) instead of losing them."""
    schema = T.StructType([T.StructField("metadata", ENVELOPE_METADATA), T.StructField(field, T.ArrayType(record)),
                           T.StructField("_corrupt_record", T.StringType())])
    df = (spark.read.option("multiLine", True).option("recursiveFileLookup", True).schema(schema).json(path)
          .select(F.col("_metadata.file_path").alias("__file"), "*"))
    rows = df.select("__file", "metadata", F.posexplode(F.col(field)).alias("__pos", "__rec"))
    good = rows.select("__rec.*", *(["metadata"] if with_metadata else []),
                       F.struct(F.col("__file").alias("file"), F.col("__pos").alias("pos")).alias("seq"))
    if not with_quarantine:
        return good
    bad = df.where(F.col(field).isNull()).select(F.col("__file").alias("file"), "_corrupt_record")
    return good, bad


def _whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file (path, text); a file is parsed whole, as a multi-line JSON reader would."""
    return (spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("value")))


def read_mixed(spark: SparkSession, path: str, field: str, record: T.StructType,
               with_quarantine: bool = False):
    """Files that are either an envelope ``{..., field: [records]}`` or a bare
    list of records; concatenated with seq = (file, position). Unreadable files
    land in a quarantine frame (file, text) instead of failing the job.

    The JSON shape is decided per file by its first non-blank character, then the
    text is parsed with ``from_json`` against the explicit schema.
    """
    files = _whole_files(spark, path)
    first = F.substring(F.ltrim(F.col("value")), 1, 1)
    as_list = F.from_json(F.col("value"), T.ArrayType(record))
    as_env = F.from_json(F.col("value"), T.StructType([T.StructField(field, T.ArrayType(record))]))[field]
    recs = F.when(first == "[", as_list).when(first == "{", as_env)
    parsed = files.select("file", "value", recs.alias("recs"))
    good = (parsed.where(F.col("recs").isNotNull())
            .select("file", F.posexplode("recs").alias("pos", "rec"))
            .select("rec.*", F.struct("file", "pos").alias("seq")))
    if not with_quarantine:
        return good
    bad = parsed.where(F.col("recs").isNull()).select("file", F.col("value").alias("_corrupt_record"))
    return good, bad


def read_lists(spark: SparkSession, path: str, record: T.StructType):
    """S3: bare-list JSON files only; files holding anything else (objects, broken
    text) are returned in a rejected frame with a reason."""
    files = _whole_files(spark, path)
    first = F.substring(F.ltrim(F.col("value")), 1, 1)
    recs = F.when(first == "[", F.from_json(F.col("value"), T.ArrayType(record)))
    parsed = files.select("file", "value", recs.alias("recs"))
    good = (parsed.where(F.col("recs").isNotNull())
            .select("file", F.posexplode("recs").alias("pos", "rec"))
            .select("rec.*", F.struct("file", "pos").alias("seq")))
    rejected = parsed.where(F.col("recs").isNull()).select(
        "file", F.when(first == "[", F.lit("unreadable")).otherwise(F.lit("not a list")).alias("reason"))
    return good, rejected


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, quoted multi-line fields, explicit schema."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').csv(path))


def newest_paths(spark: SparkSession, path: str, by: str = "file") -> list[str]:
    """The most recently modified file below ``path``, or (``by="folder"``) the folder of the run that was written
    last; several only where they are of one time. Decided from the listing alone, no file is opened."""
    if by not in ("file", "folder"):
        raise ValueError(f"by is 'file' or 'folder', not {by!r}")
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
              .select("path", F.col("modificationTime").alias("at")))
    unit = F.col("path") if by == "file" else F.regexp_replace("path", "/[^/]*$", "")
    units = listed.groupBy(unit.alias("unit")).agg(F.max("at").alias("at"))
    newest = units.agg(F.max("at")).scalar()
    return sorted(r["unit"] for r in units.where(F.col("at") == newest).select("unit").collect())


def read_newest(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", by: str = "file",
                **options) -> DataFrame:
    """The rows of the newest file or folder below ``path``; the others are never read."""
    found = newest_paths(spark, path, by)
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).options(**options).load(found)


def dictionary_frames(spark: SparkSession, d: Dictionary | None = None) -> dict[str, DataFrame]:
    """The normalization dictionary as small lookup tables (config-sized, broadcastable)."""
    d = d or Dictionary()
    countries = spark.createDataFrame(
        [(code, i.get("name"), i.get("full_name"), i.get("region")) for code, i in d.countries.items()],
        "code string, name string, full_name string, region string")
    keys = spark.createDataFrame([(k, v) for k, v in d.country_lookup().items()], "key string, code string")
    terms = {kind: (spark.createDataFrame([(n,) for n in names], "name string"),
                    spark.createDataFrame(list(lookup.items()), "key string, name string"))
             for kind, names, lookup in (("industry", d.industry_taxonomy, d.industry_lookup()),
                                         ("module", d.core_modules, d.module_lookup()))}
    return {"countries": countries, "country_keys": keys,
            "industries": terms["industry"][0], "industry_keys": terms["industry"][1],
            "modules": terms["module"][0], "module_keys": terms["module"][1]}


def normalize_term_join(df: DataFrame, col: str, keys: DataFrame) -> DataFrame:
    """Industry or module names by a lookup table (key, name): the standard name of a known term, whatever its case
    and outer blanks, and NULL for any other. The table is broadcast only when AQE measures it small."""
    k = keys.select(F.col("key").alias("__key"), F.col("name").alias("__name"))
    joined = df.join(k, F.lower(strip_ws(F.col(col))) == F.col("__key"), "left")
    return joined.withColumn(col, F.col("__name")).drop("__key", "__name")


def normalize_country_join(df: DataFrame, col: str, keys: DataFrame) -> DataFrame:
    """J2 as a join: the country rule with a (possibly large) lookup table.
    The table is broadcast only when AQE measures it small."""
    k = keys.select(F.col("key").alias("__key"), F.col("code").alias("__code"))
    c = F.col(col)
    joined = df.join(k, F.lower(c) == F.col("__key"), "left")
    out = (F.when(c.isNull() | (c == ""), F.lit("")).when(F.length(c) == 2, F.upper(c))
           .otherwise(F.coalesce(F.col("__code"), c)))
    return joined.withColumn(col, out).drop("__key", "__code")


# ---------------------------------------------------------------- sinks
FILE_BYTES = 64 << 20


def _documents(df: DataFrame, head: str, tail: str, rows_per_file: int, bytes_per_file: int) -> DataFrame:
    """(part, chunk, value): each task's records as JSON, joined into documents ``head record, record, ... tail``. A
    document is closed before it would pass ``rows_per_file`` records or ``bytes_per_file`` bytes; a longer record
    is a document of its own. No shuffle, and one document's records at a time are held."""
    def run(batches):
        held, size, chunk = [], 0, 0

        def closed():
            value = head.encode() + b",".join(held) + tail.encode()
            return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([value.decode()], pa.string())],
                                              names=["chunk", "value"])
        for batch in batches:
            for record in batch.column(0):
                record = record.as_py().encode()
                if held and (len(held) >= rows_per_file or size + len(record) > bytes_per_file):
                    yield closed()
                    held, size, chunk = [], 0, chunk + 1
                held.append(record)
                size += len(record) + 1
        if held:
            yield closed()
    ship_package(df.sparkSession)
    docs = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value")).mapInArrow(
        run, "chunk long, value string")
    return docs.select(F.spark_partition_id().alias("__part"), F.col("chunk").alias("__chunk"), "value")


def write_envelope(df: DataFrame, path: str, field: str = "providers", metadata: Mapping[str, str] | None = None,
                   rows_per_file: int = 100_000, bytes_per_file: int = FILE_BYTES) -> None:
    """Write envelope files ``{metadata, field: [...]}``; each file holds at most ``rows_per_file`` records and
    ``bytes_per_file`` bytes of them (no group grows with the data)."""
    text = lambda x: json.dumps(x, ensure_ascii=False, separators=(",", ":"))
    docs = _documents(df, f'{{"metadata":{text(dict(metadata or {}))},{text(field)}:[', "]}", rows_per_file, bytes_per_file)
    # one JSON document per file: a multi-line JSON file holds exactly one value
    docs.write.mode("overwrite").partitionBy("__part", "__chunk").text(path)


def write_lists(df: DataFrame, path: str, rows_per_file: int = 100_000, mode: str = "overwrite",
                bytes_per_file: int = FILE_BYTES) -> None:
    """Write bare-list JSON files ``[{...}, ...]`` of bounded size."""
    docs = _documents(df, "[", "]", rows_per_file, bytes_per_file)
    docs.write.mode(mode).partitionBy("__part", "__chunk").text(path)


def flatten_lists(df: DataFrame, sep: str = "; ") -> DataFrame:
    """K1 projection: every ARRAY<STRING> column joined with ``sep``."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            out.append(F.array_join(F.col(f.name).cast("array<string>"), sep).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(out)


def to_flat_csv(df: DataFrame, path: str, sep: str = "; ", source: DataFrame | None = None,
                compression: str = "none") -> bool:
    """K1: CSV with header, list columns joined; empty input writes nothing (returns False). Whether ``df`` is empty is
    asked of ``source`` where given, a frame that has rows exactly when ``df`` has: asking a frame behind shuffles
    runs all of them once more."""
    if (df if source is None else source).isEmpty():
        return False
    (flatten_lists(df, sep).write.mode("overwrite").option("header", True).option("escape", '"')
     .option("compression", compression).csv(path))
    return True


def write_json(df: DataFrame, path: str) -> None:
    """K2: JSON lines."""
    df.write.mode("overwrite").json(path)


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """K6: one folder per key (e.g. country, run timestamp)."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_report(tables: Mapping[str, DataFrame], base: str) -> None:
    """K7: each report table to its own parquet folder."""
    for name, t in tables.items():
        t.write.mode("overwrite").parquet(f"{base.rstrip('/')}/{name}")


def export_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """K4/K5: fixed output columns in declared order; missing -> '' (explicit select)."""
    return df.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns
                      else F.lit("").alias(c) for c in columns])


def stamp(df: DataFrame, name: str = "generated_at") -> DataFrame:
    """Output timestamp, added at the sink only (never inside a compared query)."""
    return df.withColumn(name, F.current_timestamp())
