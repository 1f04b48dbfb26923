"""Files: manifests, whole-file reads, hour folders, CSV folders.

Hour folders.  The reference's object sink writes one object per message
into ``YYYY-MM-DD/HH/`` folders.  Two layouts are supported:

* ``hive`` (default): ``landing_date=YYYY-MM-DD/landing_hour=HH/batch=.../``, written by
  one distributed ``partitionBy`` write; Spark discovers the partitions and
  prunes them from filters on date and hour;
* ``dated``: the literal ``YYYY-MM-DD/HH/`` layout, written per landing hour
  (a micro-batch touches one or two hours), read through an explicit list of
  hour folders (``hour_paths``), since no partition discovery applies.

One file per message (``maxRecordsPerFile=1``) reproduces the reference
contract; ``records_per_file`` > 1 is the better default for large volumes
(small files dominate listing and open costs at scale).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HIVE, DATED = "hive", "dated"


def landing_columns(ts: str | Column) -> list[Column]:
    """(landing_date 'yyyy-MM-dd', landing_hour 'HH') of a timestamp."""
    t = F.col(ts) if isinstance(ts, str) else ts
    told = t.cast("string")  # a zone-free time as text does not follow the session zone
    return [F.substring(told, 1, 10).alias("landing_date"),
            F.substring(told, 12, 2).alias("landing_hour")]


def write_hour_folders(messages: DataFrame, root: str, landing_ts: str = "timestamp",
                       layout: str = HIVE, records_per_file: int = 1,
                       batch_name: str | None = None) -> None:
    """Message bytes into hour folders.

    The text writer ends every record with ``\n``, so exactly one trailing
    ``\n`` is removed first: a message ending in a newline is stored byte for
    byte (a message without one gains a final ``\n``)."""
    body = F.regexp_replace(F.col("value").cast("string"), r"\n\z", "").alias("value")
    out = messages.select(body, *landing_columns(landing_ts))
    writer_opts = {"maxRecordsPerFile": str(records_per_file), "lineSep": "\n"}
    if layout == HIVE:
        # one file per message already fixes the file count: no rebalance; a
        # folder per batch is overwritten when the batch is repeated
        out = out.withColumn("batch", F.lit(batch_name or "unnamed"))
        (out.write.mode("overwrite" if batch_name else "append").option("partitionOverwriteMode", "dynamic").options(**writer_opts)
         .partitionBy("landing_date", "landing_hour", "batch").text(root))
        return
    # dated layout: one write per landing hour present in this batch (one or
    # two); with a batch name each batch owns its sub-folder, which a retried
    # batch overwrites instead of adding its files twice
    hours = [(r[0], r[1]) for r in out.select("landing_date", "landing_hour").distinct().collect()]
    for day, hour in sorted(hours):
        target = f"{root.rstrip('/')}/{day}/{hour}"
        mode = "append"
        if batch_name:
            target, mode = f"{target}/{batch_name}", "overwrite"
        (out.where((F.col("landing_date") == day) & (F.col("landing_hour") == hour))
         .select("value").write.mode(mode).options(**writer_opts).text(target))


def hours_between(start: dt.datetime, end: dt.datetime) -> list[tuple[str, str]]:
    """(date, hour) of the hours in [start, end)."""
    out = []
    t = start.replace(minute=0, second=0, microsecond=0)
    while t < end:
        out.append((f"{t:%Y-%m-%d}", f"{t:%H}"))
        t += dt.timedelta(hours=1)
    return out


def hour_paths(root: str, hours: list[tuple[str, str]], layout: str = HIVE) -> list[str]:
    """The folders of landing hours in either layout."""
    name = "landing_date={}/landing_hour={}" if layout == HIVE else "{}/{}"
    return [f"{root.rstrip('/')}/{name.format(*h)}" for h in hours]


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of ``paths`` that are there, asked of their own file system; no
    folder is listed."""
    from tidewater.operators.lake import path_exists
    return [p for p in paths if path_exists(spark, p)]


CORRUPT = "_corrupt"


def read_csv_folder(spark: SparkSession, fields: list[str], root: str | None = None,
                    paths: list[str] | None = None, layout: str = HIVE, corrupt: bool = False) -> DataFrame:
    """All-text CSV rows with a header line per file, plus path columns.

    With ``paths`` (``hour_paths``) only these folders are listed and read, in
    both layouts; otherwise everything below ``root``.  ``path`` is the file;
    ``landing_date``/``landing_hour`` come from the partition folders (hive) or
    from the path text (dated).  Lines may end in ``\\r\\n``; trailing carriage
    returns are not part of the last value.  ``corrupt`` adds the text of lines
    with another number of fields.
    """
    told = [*fields, *([CORRUPT] if corrupt else [])]
    text_schema = T.StructType([T.StructField(f, T.StringType()) for f in told])
    landing = ["landing_date", "landing_hour"]
    if paths is not None and not paths:
        return spark.createDataFrame([], T.StructType([T.StructField(f, T.StringType()) for f in [*told, *landing, "path"]]))
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    path = F.col("_metadata.file_path")
    if layout == HIVE:
        schema = T.StructType(text_schema.fields + [T.StructField(c, T.StringType()) for c in landing])
        if root is not None:
            reader = reader.option("basePath", root)
        df = reader.schema(schema).csv(paths if paths is not None else root)
        return df.select(*told, *landing, path.alias("path"))
    df = reader.schema(text_schema).option("recursiveFileLookup", True).csv(paths if paths is not None else root)
    hour = r"/(\d{4}-\d{2}-\d{2})/(\d{2})/"
    return df.select(*told, *(F.regexp_extract(path, hour, k + 1).alias(c) for k, c in enumerate(landing)), path.alias("path"))


def path_segments(path: str | Column, root: str, n: int = 5) -> list[Column]:
    """``$var1..$varN``: the path segments below ``root``."""
    p = F.col(path) if isinstance(path, str) else path
    rel = F.regexp_replace(p, "^.*?" + root.rstrip("/").replace(".", r"\.") + "/", "")
    parts = F.split(rel, "/")
    return [F.get(parts, i).alias(f"var{i + 1}") for i in range(n)]


def list_objects(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Object listing: key and size, without reading file contents."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(root).select("path", "length"))


def read_manifest(spark: SparkSession, manifest: str, sep: str = "|") -> DataFrame:
    """``id|path`` lines → (stage_id, path)."""
    return (spark.read.schema("stage_id int, path string").option("sep", sep).csv(manifest))


def normal_path(path: str | Column, spark: SparkSession, root: str | None = None) -> Column:
    """One spelling of a path: the scheme of Hadoop's default file system where
    it has none, ``file:/`` for ``file:///``, no doubled slashes; a relative path
    is below ``root``."""
    p = F.col(path) if isinstance(path, str) else path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    default = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getDefaultUri(conf).toString().rstrip("/")
    default = "file:" if default.startswith("file:") else default
    if root is not None:
        p = F.when(p.rlike(r"^(/|[A-Za-z][A-Za-z0-9+.-]*:)"), p).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), p))
    p = F.when(p.startswith("/"), F.concat(F.lit(default), p)).otherwise(p)
    p = F.regexp_replace(p, "^file:/+", "file:/")
    return F.regexp_replace(p, "(?<!:)(?<!:/)/{2,}", "/")


def load_manifest_files(spark: SparkSession, manifest: str, sep: str = "|", root: str | None = None, glob: str = "*") -> DataFrame:
    """(stage_id, path, container, error) for every line of a manifest — the
    staging table with one binary value per file (S9).

    Spark reads the bytes (``binaryFile``, on any Hadoop file system) and the
    manifest joins on the normalised path.  Files are looked for below ``root``;
    without it in the folders that the manifest names (one row per folder is
    collected, as Spark's file listing does).  ``glob`` leaves other files
    unread.  A file that is not there, or is empty (Spark's listing leaves these
    out), gives a NULL container and the reason in ``error``.  Each file is one value (< 2 GB); for large container files use
    ``sources.avro.read_container_files``, which splits them by block."""
    listed = read_manifest(spark, manifest, sep).withColumn("_at", normal_path("path", spark, root))
    if root is None:
        folders = [r[0] for r in listed.select(F.regexp_replace("_at", "/[^/]*$", "")).distinct().collect() if r[0]]
        folders = existing(spark, folders)
    else:
        folders = [root]
    if folders:
        reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
        if root is not None:
            reader = reader.option("recursiveFileLookup", True)
        found = reader.load(folders).select(normal_path("path", spark).alias("_at"), F.col("content").alias("container"))
        there = found.join(listed, "_at").withColumn("error", F.lit(None).cast("string"))
        gone = listed.join(found.select("_at"), "_at", "left_anti")
    else:
        there = listed.limit(0).select("*", F.lit(None).cast("binary").alias("container"), F.lit(None).cast("string").alias("error"))
        gone = listed
    gone = gone.select("*", F.lit(None).cast("binary").alias("container"),
                       F.concat(F.lit("cannot read "), F.coalesce("path", F.lit("(no path)")), F.lit(": no such file, or an empty one")).alias("error"))
    told = ["stage_id", "path", "container", "error"]
    return there.select(*told).unionByName(gone.select(*told))
