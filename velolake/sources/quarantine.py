"""Files and rows that can't be read are set aside.

Spark's permissive readers turn what they can't parse into nulls, and a file
that can't be read at all either ends the job or, skipped, leaves no trace.
Here every record comes with its file.  A record is kept, or it is set aside
with the reason and its text; a file that gave no record (it can't be read,
its header is another, it has a header only) is set aside as a whole.  For
each file: records read = kept + set aside.  Empty files hold none and are not
listed.  A compressed file that breaks off gives the records before the break;
what was behind it can't be counted.

The parsed records are written once to the shared scratch folder (Spark can't
ask raw text for its corrupt column alone, and kept and set-aside records then
come from one read).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velolake.session import scratch_path
from velolake.sources import csv as CSV

RECORD, FILE = "_corrupt_record", "_file"


@dataclass(frozen=True)
class Quarantined:
    """``kept``: the rows, with ``_file``.  ``aside``: ``file, reason,
    record``.  ``files``: ``file, bytes, kept, aside`` of every landed file."""

    kept: DataFrame
    aside: DataFrame
    files: DataFrame


def _split(spark: SparkSession, path: str, parsed: DataFrame, schema: T.StructType, reason) -> Quarantined:
    folder = scratch_path(spark, "quarantine")
    named = parsed.withColumn(FILE, F.col("_metadata.file_path")).withColumn("_reason", reason)
    named.write.parquet(folder)
    rows = spark.read.schema(named.schema).parquet(folder)
    kept = rows.where("_reason IS NULL").select(*schema.names, FILE)
    bad = rows.where("_reason IS NOT NULL").select(F.col(FILE).alias("file"), F.col("_reason").alias("reason"), F.col(RECORD).alias("record"))
    # names and sizes of all files; their content is not read for that
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))
    counts = rows.groupBy(F.col(FILE).alias("file")).agg(F.count_if(F.col("_reason").isNull()).alias("kept"), F.count_if(F.col("_reason").isNotNull()).alias("aside"))
    files = listed.join(counts, "file", "left").fillna(0, ["kept", "aside"])
    silent = files.where("kept + aside = 0")
    aside = bad.unionByName(silent.select("file", F.lit("no records").alias("reason"), F.lit(None).cast("string").alias("record")))
    return Quarantined(kept, aside, files)


def read_json_quarantined(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True, required: Sequence[str] = ()) -> Quarantined:
    """JSON files; with ``multi_line`` each holds one value or one list.  A
    record none of whose ``required`` fields is there is set aside, too."""
    asked = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    reader = spark.read.schema(asked).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD)
    parsed = reader.option("multiLine", str(multi_line).lower()).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").json(path)
    reason = F.when(F.col(RECORD).isNotNull(), "malformed")
    if required:
        reason = reason.when(F.coalesce(*[F.col(c).cast("string") for c in required]).isNull(), "no record")
    return _split(spark, path, parsed, schema, reason)


def read_csv_quarantined(spark: SparkSession, path: str, schema: T.StructType, na_tokens: list[str] | None = None, multi_line: bool = False) -> Quarantined:
    """CSV files whose header has the names of ``schema`` in its order; a file
    with another header is set aside whole, as a column would be taken for
    another.  Set aside are rows of another number of fields (``malformed``) and rows with a
    text that does not fit its column (``bad <column>``); an NA token is null
    and fits."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(RECORD, T.StringType())])
    options = {**CSV.CSV_OPTIONS, "enforceSchema": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD, "multiLine": str(multi_line).lower()}
    raw = spark.read.schema(text).options(**options).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").csv(path)
    tokens = CSV.S.NA_TOKENS if na_tokens is None else na_tokens
    clean = {f.name: F.when(~F.col(f.name).isin(tokens), F.col(f.name)) for f in schema}
    typed = {f.name: clean[f.name] if isinstance(f.dataType, T.StringType) else CSV.typed(clean[f.name], f.dataType) for f in schema}
    reason = F.when(F.col(RECORD).isNotNull(), "malformed")
    for name in schema.names:
        reason = reason.when(clean[name].isNotNull() & typed[name].isNull(), f"bad {name}")
    whole = F.coalesce(F.col(RECORD), F.to_csv(F.struct(*schema.names)))
    parsed = raw.select(*[typed[n].alias(n) for n in schema.names], whole.alias(RECORD), reason.alias("_why"), "_metadata")
    return _split(spark, path, parsed, schema, F.col("_why"))
