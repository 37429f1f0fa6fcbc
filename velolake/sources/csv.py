"""S3 / K2 / K3 / K4: CSV read and write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velolake import schemas as S

# RFC-4180 quoting: a quote inside a field is doubled, not backslash-escaped.
# Timestamps keep all six fraction digits (the default writes three).
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    # spaces at the edges of a field are part of it
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def normalise_na(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """Text columns: any of the NA ``tokens`` -> null (Spark's CSV reader
    knows one ``nullValue`` only)."""
    tokens = S.NA_TOKENS if tokens is None else tokens
    out = []
    for name, dtype in df.dtypes:
        c = F.col(name)
        if dtype == "string":
            c = F.when(c.isin(tokens), F.lit(None)).otherwise(c)
        out.append(c.alias(name))
    return df.select(*out)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    infer: bool = False,
    na_tokens: list[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read CSV with a header.

    With ``schema`` columns are found by their names in the header, in any
    order; a name that the header lacks is an error, as is a file whose
    header differs from the first one's.  Every column is read as text first,
    NA tokens are turned into nulls and the text is then cast with
    ``try_cast`` (unparsable -> null).  ``infer=True`` keeps Spark's
    inference (one extra pass).  ``multi_line=True`` reads fields that hold
    line breaks; such files are not split, so write them in pieces
    (``write_csv(..., max_records=...)``).
    """
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", str(multi_line).lower())
    if schema is None:
        df = reader.option("inferSchema", str(infer).lower()).csv(path)
        return normalise_na(df, na_tokens)
    header = reader.csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"Columns missing in {path}: {missing}")
    text_schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    df = normalise_na(reader.schema(text_schema).option("enforceSchema", "false").csv(path), na_tokens)
    return df.select(
        *[
            (F.col(f.name) if isinstance(f.dataType, T.StringType) else _typed(f)).alias(f.name)
            for f in schema.fields
        ]
    )


def _typed(field: T.StructField):
    return typed(F.col(field.name), field.dataType)


def typed(text: Column, kind: T.DataType) -> Column:
    """A text column as ``kind``; what does not fit is null."""
    if isinstance(kind, T.BooleanType):
        low = F.lower(text)
        return F.when(low == "true", True).when(low == "false", False)
    return text.try_cast(kind)


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """F8: raise when ``df`` has no rows (a one-row probe, not a count)."""
    if df.isEmpty():
        raise ValueError(f"No data found in {what}")
    return df


def select_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """K3: keep ``columns`` in the given order; unknown names are an error."""
    if columns is None:
        return df
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Unknown columns: {missing}")
    return df.select(*columns)


def object_path(base: str, kind: str, date_range: str, filename: str | None = None) -> str:
    """K2 path layout ``{base}/{kind}/{range}[/{filename}]``."""
    parts = [base.rstrip("/"), kind, date_range] + ([filename] if filename is not None else [])
    # an empty part would name the parent folder, which a write then replaces
    if any(not p or not p.strip("/. ") for p in parts):
        raise ValueError(f"empty part in object path: {parts}")
    return "/".join(parts)


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "overwrite", max_records: int = 0):
    """K2/K3: CSV with header; quotes doubled inside fields.  ``max_records``
    bounds the rows of a file (0: no bound)."""
    writer = select_columns(df, columns).write.mode(mode).options(**CSV_OPTIONS)
    writer.option("maxRecordsPerFile", max_records).csv(path)
    return path


def dated_name(prefix: str, day: str, ext: str = "csv") -> str:
    """K4: dated object names such as ``weather-data-2024-01-20.csv``."""
    return f"{prefix}{day}.{ext}"
