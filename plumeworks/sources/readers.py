"""Readers: columns found by name, declared types, no inference scans, filters left to Catalyst."""

import csv
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumeworks import constants as C
from plumeworks.functions.filters import predicate
from plumeworks.session import settle


def headers(spark, path):
    """``{file: column names}`` of the CSV files at a path; files without any line are left out.

    One short job per file, which reads its first line only. A delivery is a few large files.
    """
    files = [re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(f)) for f in spark.read.text(path).inputFiles()]
    with ThreadPoolExecutor(8) as pool:
        lines = list(pool.map(lambda f: spark.read.text(f).first(), files))
    found = {f: next(csv.reader([line[0].lstrip("\ufeff")]), []) for f, line in zip(files, lines) if line}
    return {f: [name.strip() for name in names] for f, names in found.items()}


def _typed(name, kind):
    """Text as the declared type; integers may be written as ``47.0``. What can't be read is null."""
    text = F.col(f"`{name}`")
    if not isinstance(kind, T.IntegralType):
        return text.try_cast(kind).alias(name)
    number = text.try_cast("double")
    return F.coalesce(text.try_cast(kind), F.when(number == F.floor(number), number).try_cast(kind)).alias(name)


REJECTS = "_rejects"


def _unreadable(fields):
    """Array of ``(column, text, reason)``: texts of a row that are there but cannot be read as the declared type."""
    checks = [
        F.when(F.col(f"`{f}`").isNotNull() & _typed(f, kind).isNull(), F.struct(
            F.lit(f).alias("column"), F.col(f"`{f}`").alias("text"), F.lit(f"not {kind.simpleString()}").alias("reason")))
        for f, kind in fields.items()
    ]
    return F.array_compact(F.array(*checks)).alias(REJECTS) if checks else F.array().cast(_REJECT_TYPE).alias(REJECTS)


_REJECT_TYPE = "array<struct<column:string,text:string,reason:string>>"


def with_rejects(parsed, label):
    """``(rows, rejects)`` of a read with rejects on, both from one pass over the files.

    The pass is written to the shared folder. ``rejects`` has a row per unreadable value: the file, column, text and
    reason; the rows have null there, and are complete otherwise.
    """
    stored = settle(parsed, label)
    rejects = stored.where(F.size(REJECTS) > 0).select("_file", F.inline(REJECTS)).withColumnRenamed("_file", "file")
    return stored.drop(REJECTS, "_file"), rejects


def csv_by_name(spark, path, schema, others=False, fill=True, tags=(), rejects=False):
    """CSV files with headers, columns in any order, differing from file to file.

    Columns of the schema get their type, and null where a file lacks them. With ``fill`` off, those that no file has are left
    out. ``others`` keeps the remaining columns as text. A name that comes twice in a file stands for its first column. ``tags``
    are further expressions over a file's rows. Files of one header are read together, so there is one scan per header.
    ``rejects`` adds what could not be read, for :func:`with_rejects`.
    """
    if rejects:
        tags = [*tags, _file_name().alias("_file")]
    kinds = {f.name: f.dataType for f in schema.fields}
    folded = {n.lower() for n in kinds}
    layouts = {}
    for file, names in headers(spark, path).items():
        layouts.setdefault(tuple(names), []).append(file)
    parts = []
    for names, files in layouts.items():
        fields = []
        for i, name in enumerate(names):
            wanted = name in kinds or (others and name and name.lower() not in folded)
            twice = name.lower() in {f.lower() for f in fields}
            fields.append(name if wanted and not twice else f"_unused_{i}")
        text = T.StructType([T.StructField(f, T.StringType()) for f in fields])
        kept = [_typed(f, kinds.get(f, T.StringType())) for f, name in zip(fields, names) if f == name]
        bad = [_unreadable({f: kinds[f] for f in fields if f in kinds})] if rejects else []
        parts.append(spark.read.schema(text).option("header", True).csv(files).select(*kept, *tags, *bad))
    if not parts:
        return spark.createDataFrame([], schema)
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    rest = [c for c in df.columns if c not in kinds]
    declared = [F.col(n) if n in df.columns else F.lit(None).cast(k).alias(n) for n, k in kinds.items() if fill or n in df.columns]
    return df.select(*declared, *[F.col(f"`{c}`") for c in rest])


def _file_name():
    """The file a row comes from; a delivery written as a folder of parts goes by the folder's name."""
    path = F.col("_metadata.file_path")
    delivery = F.regexp_extract(path, r"([^/]+_AllCounties_[^/]+)", 1)
    return F.url_decode(F.when(delivery != "", delivery).otherwise(F.element_at(F.split(path, "/"), -1)))


def measurement_csv(spark, path):
    """Typed measurement CSV: a file, a folder or a path pattern."""
    return csv_by_name(spark, path, C.MEASUREMENT_SCHEMA)


def measurements_and_rejects(spark, path):
    """Typed measurement CSV and the values of it that could not be read."""
    return with_rejects(csv_by_name(spark, path, C.MEASUREMENT_SCHEMA, rejects=True), "measurements")


def measurement_folder(spark, path):
    """All measurement files of a folder, tagged with their file name."""
    return csv_by_name(spark, f"{path}/{C.MEASUREMENT_FILE_GLOB}", C.MEASUREMENT_SCHEMA, tags=[_file_name().alias("source_file")])


def weather_csv(spark, path, schema=C.WEATHER_SCHEMA):
    """Weather master CSV in any of its layouts: absent columns stay absent, further ones are kept."""
    known = {f.name for f in schema.fields}
    more = [f for f in C.WEATHER_OTHER_COLUMNS.fields if f.name not in known]
    return csv_by_name(spark, path, T.StructType([*schema.fields, *more]), others=True, fill=False)


def parquet_dataset(spark, path, columns=None, filters=()):
    """Hive-partitioned parquet scan. Stray sidecar files are ignored by the glob."""
    df = spark.read.option("pathGlobFilter", C.PARQUET_GLOB).parquet(path).where(predicate(filters))
    return df.select(*columns) if columns else df


def site_reference(spark, path):
    """Site coordinates CSV as ``(aqsid, lat, lon)`` with the id kept as text."""
    raw = csv_by_name(spark, path, T.StructType.fromDDL(C.SITE_REFERENCE_SCHEMA), fill=False)
    return coordinates(raw, "aqsid", "latitude", "longitude")


def coordinates(df, id_col, lat_col, lon_col):
    """Any table with an id and two coordinates as ``(aqsid, lat, lon)``."""
    return df.select(
        F.col(id_col).cast("string").alias("aqsid"),
        F.col(lat_col).cast("double").alias("lat"),
        F.col(lon_col).cast("double").alias("lon"),
    )


def transactions(spark, path):
    """Pipe-delimited transaction file: raw-data rows only, header and broken lines dropped.

    Header lines carry another record type, so the type test replaces line skipping
    and lets Spark split the file anywhere. A line with more than the declared fields
    is malformed and is dropped; one cut short keeps nulls at its end.
    """
    rows = _transaction_rows(spark, path)
    return rows.where((F.col("ttype") == "RD") & F.col(_SURPLUS).isNull()).select(*C.TRANSACTION_FIELDS)


_SURPLUS = "_surplus"


def _transaction_rows(spark, path):
    schema = ", ".join(f"`{n}` string" for n in [*C.TRANSACTION_FIELDS, _SURPLUS])
    return spark.read.schema(schema).option("sep", "|").option("quote", '"').csv(path)


#: Fields of a transaction that have to be readable, and how they are tried.
TRANSACTION_NUMBERS = {"state": "int", "county": "int", "site": "int", "param": "int", "poc": "int", "meth": "int", "value": "double"}


def transactions_and_rejects(spark, path):
    """Transaction rows, and what of the raw-data lines could not be read: surplus fields (the line is
    dropped), numbers and dates (they become null later on)."""
    rows = _transaction_rows(spark, path).where(F.col("ttype") == "RD")
    whole = F.col(_SURPLUS).isNull()
    bad = [F.when(~whole, F.struct(F.lit(_SURPLUS).alias("column"), F.col(_SURPLUS).alias("text"), F.lit("too many fields").alias("reason")))]
    for name, kind in TRANSACTION_NUMBERS.items():
        lost = whole & (F.trim(name) != "") & F.col(name).try_cast("double").try_cast(kind).isNull()
        bad.append(F.when(lost, F.struct(F.lit(name).alias("column"), F.col(name).alias("text"), F.lit(f"not {kind}").alias("reason"))))
    lost = whole & (F.trim("date") != "") & F.try_to_date("date", "yyyyMMdd").isNull()
    bad.append(F.when(lost, F.struct(F.lit("date").alias("column"), F.col("date").alias("text"), F.lit("not yyyyMMdd").alias("reason"))))
    parsed = rows.select(*C.TRANSACTION_FIELDS, whole.alias("_whole"), F.array_compact(F.array(*bad)).alias(REJECTS), _file_name().alias("_file"))
    kept, rejects = with_rejects(parsed, "transactions")
    return kept.where("_whole").drop("_whole"), rejects


def api_records(spark, path, whole_documents=False):
    """API responses in JSON, all fields read as text; absent ones come out null.

    Records one per line can be split between tasks. ``whole_documents`` reads files that each
    hold one response as a JSON array, which a single task must parse in one go.
    """
    names = [
        "state_code", "county_code", "site_number", "parameter_code", "poc",
        "date_local", "time_local", "sample_measurement", "method_code",
    ]
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.read.schema(schema).option("multiLine", whole_documents).json(path)


def load(spark, path, source, schema=None):
    """Dispatch by source kind: ``csv``, ``parquet`` or ``parquet_dir``. CSV columns outside the schema are text."""
    if source == "csv":
        return csv_by_name(spark, path, schema or T.StructType(), others=True, fill=False)
    if source in ("parquet", "parquet_dir"):
        return parquet_dataset(spark, path)
    raise ValueError(f"unknown source kind: {source!r}")
