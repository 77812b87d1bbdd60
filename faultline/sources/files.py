"""File sources and sinks: ticket export CSV (S1), tolerant read (S2), SLA sheet (S3),
weather store (S4 lives in operators.weather), writers (S6), stored panel (S7)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from faultline import config as C


def sniff_csv(spark: SparkSession, path: str) -> dict:
    """Decide separator and encoding from the header line only (one tiny job):
    comma unless it yields fewer than 3 columns, then ';'; undecodable bytes in the
    header switch the encoding to latin-1."""
    first = spark.read.text(path).limit(1).collect()
    head = first[0][0] if first else ""
    enc = "ISO-8859-1" if "�" in head else "UTF-8"
    sep = "," if len(head.split(",")) >= 3 else ";"
    return {"sep": sep, "encoding": enc, "header": head}


def header_names(header: str, sep: str) -> list:
    """Header fields, unquoted; repeated names get a numeric suffix (pandas style: X, X.1)."""
    import csv
    names = next(csv.reader([header], delimiter=sep, quotechar='"'))
    seen: dict = {}
    out = []
    for n in names:
        if n in seen:
            seen[n] += 1
            out.append(f"{n}.{seen[n]}")
        else:
            seen[n] = 0
            out.append(n)
    return out


def read_tickets(spark: SparkSession, path: str, columns=None, all_columns: bool = False) -> DataFrame:
    """The raw export as all-string columns (no inference), multi-line quoted
    fields allowed; only the mapped columns are kept (pruned at the scan)."""
    opt = sniff_csv(spark, path)
    names = header_names(opt["header"], opt["sep"])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = (spark.read.schema(schema)
          .options(header=True, sep=opt["sep"], encoding=opt["encoding"], multiLine=True,
                   quote='"', escape='"', mode="PERMISSIVE", enforceSchema=True)
          .csv(path))
    if all_columns:
        return df
    want = list(columns or C.JIRA_COLUMNS_MAP)
    return df.select(*[F.col(f"`{c}`") for c in want if c in names])


def tolerant_parts(spark: SparkSession, path: str, columns=None) -> tuple:
    """The tickets and the rejected records (their raw text, ``_corrupt``). Records with
    *more* fields than the header are rejected; short ones are kept with NULLs. Quoted
    separators and line breaks are part of their field."""
    opt = sniff_csv(spark, path)
    names = header_names(opt["header"], opt["sep"])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names]
                          + [T.StructField("_corrupt", T.StringType())])
    df = (spark.read.schema(schema)
          .options(header=True, sep=opt["sep"], encoding=opt["encoding"], multiLine=True, quote='"', escape='"',
                   mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", enforceSchema=True,
                   columnPruning=False)  # with pruning a record's length is not looked at
          .csv(path))
    bare = F.regexp_replace("_corrupt", '"(?:[^"]|"")*"', "")
    long = F.length(bare) - F.length(F.replace(bare, F.lit(opt["sep"]))) >= len(names)
    # the check also reads a data column: a query of the corrupt column alone is refused
    read = F.length(F.concat_ws("", F.col(f"`{names[0]}`"))) >= 0
    rejected = F.col("_corrupt").isNotNull() & long & read
    want = list(columns or C.JIRA_COLUMNS_MAP)
    good = df.filter(~F.coalesce(rejected, F.lit(False))).select(*[F.col(f"`{c}`") for c in want if c in names])
    return good, df.filter(rejected).select("_corrupt")


def read_tickets_tolerant(spark: SparkSession, path: str, columns=None) -> DataFrame:
    """The tickets of ``tolerant_parts``."""
    return tolerant_parts(spark, path, columns)[0]


def read_sla(spark: SparkSession, path: str) -> DataFrame:
    """S3: the SLA table from Parquet or CSV (no spreadsheet decoding)."""
    if path.endswith(".parquet") or not path.endswith(".csv"):
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            pass
    opt = sniff_csv(spark, path)
    return spark.read.options(header=True, sep=opt["sep"], encoding=opt["encoding"]).csv(path)


def save(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, sort_by=None,
         mode: str = "overwrite") -> None:
    """Write a result; Parquet partitioned by zone by default for panels, CSV on
    request. ``sort_by`` sorts within partitions only (no global sort)."""
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def load_or_build(spark: SparkSession, path: str, build, partition_by=("Zona",)) -> DataFrame:
    """Read the stored table if present, else build it with ``build()`` and store it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        df = build()
        save(df, path, partition_by=list(partition_by) if partition_by else None)
        return spark.read.parquet(path)
