"""The raw landing zone: ``<root>/<dataset>/load_date=YYYY-MM-DD/<files>``.

Two file layouts are read:

* ``lines`` (what we land): JSON lines.  Splittable, so a large landing file
  is read by many tasks; compressed files have a bounded number of records.
* ``document``: one JSON object or array per file, as the API client used to
  land responses.  A document cannot be split; each file is one task.

Records are parsed against an explicit schema: unknown fields are ignored,
missing ones are NULL, a wrongly typed field becomes NULL, and a truncated
document becomes one all-NULL row (later dropped by the Silver key filters).
"""
from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from clipstar.schemas import (
    AUDIT_DDL, EVENT_DATASET, MEDIA_DATASET, MEDIA_SNAPSHOT_DDL, PARTITION_COLUMN, VISITOR_EVENT_DDL,
)
from clipstar.sources.commits import NO_VALUE, create_once, file_system, names_in, path_exists


def landing_number(spark: SparkSession, root: str, dataset: str) -> int:
    """A number that no landing of the dataset had before, greater than all of them, and about the time in
    microseconds, which is what files that were landed without a number are taken to have."""
    folder = f"{root.rstrip('/')}/{dataset}/_landings"
    while True:
        taken = [int(n) for n in names_in(spark, folder) if n.isdigit()]
        number = max([time.time_ns() // 1000, *[n + 1 for n in taken]])
        if create_once(spark, f"{folder}/{number}", ""):
            return number


def _numbered(df: DataFrame, root: str, dataset: str) -> DataFrame:
    """Media snapshots, stamped with the number of their landing."""
    if dataset != MEDIA_DATASET:
        return df
    return df.withColumn("landing", F.lit(landing_number(df.sparkSession, root, dataset)).cast("bigint"))


#: A compressed file can't be split, so one task parses it; it has so many records at most.
RECORDS_PER_FILE = 200_000


def by_day(df: DataFrame) -> DataFrame:
    """Rebalanced on the folder column: each load_date goes to few tasks (AQE splits a large day, merges small ones), so a
    folder gets a few right-sized files instead of one small file per task.  Sorted on it here, while the rows are narrow:
    a write into folders sorts what comes unsorted, as whole records."""
    return df.hint("rebalance", PARTITION_COLUMN).sortWithinPartitions(PARTITION_COLUMN)


def land_json(df: DataFrame, root: str, dataset: str, mode: str = "append", compression: str | None = None,
              placed: bool = False) -> str:
    """Write records as JSON lines, one folder per load_date.  ``append``
    adds a run's files next to earlier runs' files, as landing does.  With
    ``compression``, files are a fraction of their text and have
    RECORDS_PER_FILE records at most.  ``placed``: the rows are ``by_day``
    already, which a plan can do while they are still narrow."""
    path = f"{root.rstrip('/')}/{dataset}"
    writer = _numbered(df if placed else by_day(df), root, dataset).write.mode(mode).partitionBy(PARTITION_COLUMN)
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", RECORDS_PER_FILE)
    writer.json(path)
    return path


def stamp_by_day(spark: SparkSession, root: str, dataset: str) -> None:
    """Give landed files times in the order of their days, as files have that were landed day after day.  A stream takes
    files by their times, and of an event that was landed on two days keeps what it met first."""
    path, now = f"{root.rstrip('/')}/{dataset}", time.time_ns() // 1_000_000
    days = [n for n in names_in(spark, path) if n.startswith(f"{PARTITION_COLUMN}=")]
    for i, day in enumerate(days):
        for name in names_in(spark, f"{path}/{day}"):
            fs, file = file_system(spark, f"{path}/{day}/{name}")
            fs.setTimes(file, now - len(days) + i, -1)  # milliseconds: a stream leaves out files much older than others


#: Creating a file takes far longer than writing a record, so a task gets few.
FILES_PER_TASK = 1000


def _put_documents(uri: str, landing: str):
    """For tasks: a file for each (day, value) below the folder ``uri``.  Workers may not have this package, so nothing
    else of it is used."""
    default, column = NO_VALUE, PARTITION_COLUMN

    def run(batches):
        import pyarrow as pa
        import pyarrow.fs
        from pyspark import TaskContext

        system, root = pyarrow.fs.FileSystem.from_uri(uri)
        task, made, n = TaskContext.get().partitionId(), set(), 0
        for batch in batches:
            for day, value in zip(batch.column("day").to_pylist(), batch.column("value").to_pylist()):
                folder = f"{root}/{column}={default if day is None else day}"
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                name = f"part-{task:05d}-{landing}.c{n:06d}.json"
                # No reader sees a file that is not whole.
                with system.open_output_stream(f"{folder}/.{name}", compression=None) as out:
                    out.write(value.encode("utf-8", "surrogatepass") + b"\n")
                system.move(f"{folder}/.{name}", f"{folder}/{name}")
                n += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([n], pa.int64())})
    return run


def land_documents(df: DataFrame, root: str, dataset: str) -> str:
    """One JSON object per file, as the API client lands a response.  However few bytes the records have, many tasks
    write them.

    Tasks put the files themselves: through Spark's writer a small file takes 12 ms on a local disk, where Hadoop starts
    a process for each change of a file's permissions, and the driver then renames one file after the other.  As with the
    client, a landing that fails has landed some documents; a task that is run again writes the same files again."""
    spark, path = df.sparkSession, f"{root.rstrip('/')}/{dataset}"
    numbered = _numbered(df.repartition(max(1, -(-df.count() // FILES_PER_TASK))), root, dataset)
    record = F.struct(*[c for c in numbered.columns if c != PARTITION_COLUMN])
    texts = numbered.select(F.col(PARTITION_COLUMN).cast("string").alias("day"), F.to_json(record).alias("value")) \
        .sortWithinPartitions("day", "value")
    fs, folder = file_system(spark, path)
    fs.mkdirs(folder)
    put = _put_documents(fs.makeQualified(folder).toString(), uuid.uuid4().hex)
    texts.mapInArrow(put, "files BIGINT").agg(F.sum("files")).collect()
    return path


def land_arrays(df: DataFrame, root: str, dataset: str, per_file: list[str]) -> str:
    """One JSON array of records per file: those of equal ``per_file`` columns
    (which are not landed) and load_date.  An array is one row, so
    ``per_file`` must bound it, as a response's page size does."""
    path = f"{root.rstrip('/')}/{dataset}"
    df = _numbered(df, root, dataset)
    record = F.struct(*[c for c in df.columns if c not in (PARTITION_COLUMN, *per_file)])
    df.groupBy(PARTITION_COLUMN, *per_file).agg(F.to_json(F.collect_list(record)).alias("value")) \
        .select("value", PARTITION_COLUMN).write.mode("append").option("maxRecordsPerFile", 1) \
        .partitionBy(PARTITION_COLUMN).text(path)
    return path


#: Tasks per core that read documents.
DOCUMENT_TASKS = 16
#: Documents are read by so many, or so many bytes, at once, and so many times that before they are handed on.
PER_READ, BYTES_PER_READ, READS = 32, 1 << 20, 16


def _list_documents(uri: str):
    """For tasks: the files below the folders ``uri``/folder, in groups that are read at once; hidden ones are left out."""
    most, most_bytes = PER_READ, BYTES_PER_READ

    def run(batches):
        import os
        import re
        from urllib.parse import quote

        import pyarrow as pa
        import pyarrow.fs

        system, root = pyarrow.fs.FileSystem.from_uri(uri)

        def named(path):  # as Spark names a file
            return f"{uri}/" + re.sub(r"[\x00-\x7f]+", lambda m: quote(m[0], safe="/_-!.~'()*,;:$&+=@"), path)

        def below(path):  # a local folder is listed bit by bit
            if isinstance(system, pyarrow.fs.LocalFileSystem):
                found = ((e.path, e.name, e.is_dir(), e.stat().st_mtime_ns // 1000, e.stat().st_size) for e in os.scandir(path))
            else:
                found = ((i.path, i.base_name, i.type == pyarrow.fs.FileType.Directory, (i.mtime_ns or 0) // 1000, i.size)
                         for i in system.get_file_info(pyarrow.fs.FileSelector(path)))
            for at, name, is_folder, modified, size in found:
                if name.startswith((".", "_")):
                    continue
                if is_folder:
                    yield from below(at)
                else:
                    yield at[len(root) + 1:], modified, size

        def rows(groups):
            kind = pa.list_(pa.struct([("path", pa.string()), ("file", pa.string()), ("modified", pa.int64())]))
            return pa.RecordBatch.from_pydict({"folder": pa.array([f for f, _ in groups], pa.string()),
                                               "files": pa.array([g for _, g in groups], kind)})

        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                groups, group, total = [], [], 0
                for path, modified, size in below(f"{root}/{folder}"):
                    group.append({"path": path, "file": named(path), "modified": modified})
                    total += size
                    if len(group) >= most or total >= most_bytes:
                        groups.append((folder, group))
                        group, total = [], 0
                    if len(groups) >= 100:
                        yield rows(groups)
                        groups = []
                yield rows(groups + ([(folder, group)] if group else []))
    return run


def _texts_of(uri: str):
    """For tasks: the texts of documents, NULL for those of nothing but white space."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("array<string>")
    def texts(files):
        import json

        import pyarrow as pa
        import pyarrow.fs

        system, root = pyarrow.fs.FileSystem.from_uri(uri)

        def text(path):
            with system.open_input_stream(f"{root}/{path}", compression=None) as source:
                data = source.read()
            try:
                return data.decode(json.detect_encoding(data)) if data.strip(b" \t\r\n") else None
            except UnicodeDecodeError:  # no JSON begins like this
                return "\0" + data.decode("utf-8", "replace")
        return pa.array([[text(f["path"]) for f in group] for group in files.to_pylist()], pa.list_(pa.string()))
    return texts


def read_documents(spark: SparkSession, path: str, ddl: str, audit: bool) -> DataFrame:
    """Parsed as Spark's reader of JSON does: an object is a row, an array a row per element, a text that can't be read
    one NULL row.  That reader has the driver list all files and keep about 1 KB for each; here tasks list, and read, them.
    Only of text that follows an array it says nothing, and here the array is malformed."""
    fs, folder = file_system(spark, path)
    uri = fs.makeQualified(folder).toString()
    names = [(n,) for n in names_in(spark, path) if n.startswith(f"{PARTITION_COLUMN}=")]
    # A session of its own, for how many groups are read before they are handed on.
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(READS))
    day = F.substring("folder", len(PARTITION_COLUMN) + 2, 100).try_cast("date")
    groups = own.createDataFrame(names, "folder STRING") \
        .mapInArrow(_list_documents(uri), "folder STRING, files ARRAY<STRUCT<path: STRING, file: STRING, modified: BIGINT>>") \
        .withColumn(PARTITION_COLUMN, day)
    read = groups.repartition(DOCUMENT_TASKS * spark.sparkContext.defaultParallelism) \
        .withColumn("texts", _texts_of(uri)("files")) \
        .select(PARTITION_COLUMN, F.inline(F.arrays_zip("files", "texts"))).where(F.col("texts").isNotNull())

    text, listed = F.col("texts"), F.col("texts").rlike(r"^\s*\[")
    kept = {"columnNameOfCorruptRecord": "malformed"}
    record = StructType.fromDDL(f"{ddl}, malformed STRING" if audit else ddl)
    nothing = F.from_json(F.lit("{}"), record)
    elements = F.from_json(text, ArrayType(record))
    several = F.coalesce(F.transform(elements, lambda e: F.coalesce(e, nothing)), F.array(nothing))
    rows = read.withColumn("_records", F.when(listed, several).otherwise(F.array(F.from_json(text, record, kept if audit else None))))
    fields = [c for c in record.names if c != "malformed"]
    columns = [F.coalesce(f"_record.{c}", "files.modified").alias(c) if c == "landing" else F.col(f"_record.{c}") for c in fields]
    last = []
    if audit:
        # An array's elements don't say that one of them is malformed; a record that has the array as a field does.
        within = F.from_json(F.concat(F.lit('{"elements":'), text, F.lit("}")), StructType(
            [StructField("elements", ArrayType(record)), StructField("malformed", StringType())]), kept)
        odd = within["malformed"].isNotNull() | elements.isNull() | F.exists(elements, lambda e: e.isNull())
        rows = rows.withColumn("_odd", F.when(listed, odd))
        columns.append(F.when(F.coalesce("_odd", F.col("_record.malformed").isNotNull()), F.regexp_replace(text, "^\\x00", ""))
                       .alias("malformed"))
        last = ["files.file"]
    # With ``explode``, Spark would parse once more, to leave out arrays without elements before.
    return rows.withColumn("_record", F.explode_outer("_records")).where(F.col("_record").isNotNull()) \
        .select(*columns, PARTITION_COLUMN, *last)


def read_landed(spark: SparkSession, root: str, dataset: str, ddl: str,
                layout: str = "lines", allow_missing: bool = False, audit: bool = False) -> DataFrame:
    """Parse a landed dataset; ``load_date`` comes from the folder names (as
    DATE) and filters on it prune folders before any file is opened.  With
    ``allow_missing``, a batch that landed nothing for the dataset reads as
    an empty DataFrame.  With ``audit``, each record also has its file and,
    if it could not be read as declared, its text (``malformed``)."""
    path = f"{root.rstrip('/')}/{dataset}"
    if allow_missing and not path_exists(spark, path):
        return spark.createDataFrame([], f"{ddl}, {PARTITION_COLUMN} DATE" + f", {AUDIT_DDL}" * audit)
    if layout == "document":
        return read_documents(spark, path, ddl, audit)
    return parse_landed(spark.read, ddl, layout, audit).json(path).transform(lambda df: with_file(df, audit))


def parse_landed(reader, ddl: str, layout: str, audit: bool):
    """A batch or stream reader of landed JSON.  The folder column is declared, so that it is there, and a date, in a
    folder without files as well."""
    if layout not in ("lines", "document"):
        raise ValueError(f"unknown layout {layout!r}")
    if layout == "document":
        reader = reader.option("multiLine", True)
    if audit:
        ddl, reader = f"{ddl}, malformed STRING", reader.option("columnNameOfCorruptRecord", "malformed")
    return reader.schema(f"{ddl}, {PARTITION_COLUMN} DATE")


def with_file(df: DataFrame, audit: bool) -> DataFrame:
    """Snapshots without a landing number take the time of their file; with ``audit``, records have their file."""
    extra = {"landing": F.coalesce("landing", F.unix_micros("_metadata.file_modification_time"))} \
        if "landing" in df.columns else {}
    if audit:
        extra["file"] = F.col("_metadata.file_path")
    return df.withColumns(extra) if extra else df


def read_media_snapshots(spark: SparkSession, root: str, layout: str = "lines",
                         allow_missing: bool = False, audit: bool = False) -> DataFrame:
    return read_landed(spark, root, MEDIA_DATASET, MEDIA_SNAPSHOT_DDL, layout, allow_missing, audit)


def read_visitor_events(spark: SparkSession, root: str, layout: str = "lines",
                        allow_missing: bool = False, audit: bool = False) -> DataFrame:
    return read_landed(spark, root, EVENT_DATASET, VISITOR_EVENT_DDL, layout, allow_missing, audit)


def file_audit(spark: SparkSession, root: str, dataset: str, ddl: str, layout: str = "lines") -> DataFrame:
    """Per landed file: its path, bytes, records read from it, and how many of these could not be read as declared.
    A file without any record is listed too."""
    landed = read_landed(spark, root, dataset, ddl, layout, audit=True)
    # All declared fields are asked for, or Spark would parse, and find malformed, only those that are.
    whole = F.to_json(F.struct(*[c for c in landed.columns if c not in ("file", "malformed")]))
    records = landed.groupBy("file").agg(F.count(whole).alias("records"), F.count("malformed").alias("malformed"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*") \
        .load(f"{root.rstrip('/')}/{dataset}").select(F.col("path").alias("listed"), F.col("length").alias("bytes"))
    # One names a file file:/x, the other file:///x.
    plain = lambda c: F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")
    return files.join(records, plain("listed") == plain("file"), "left").select(
        F.col("listed").alias("file"), "bytes", F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("malformed", F.lit(0)).alias("malformed"))


def compose_snapshots(metadata: DataFrame, stats: DataFrame) -> DataFrame:
    """Pair each stats response with its media's metadata into the landed
    snapshot record ``{media, stats}`` + load_date.

    ``metadata``: (media_id, media struct), one row per media;
    ``stats``: (media_id, load_date, stats struct, ingest_seq).  Stats of a media with no
    metadata are kept with a NULL ``media`` (and later dropped by Silver)."""
    return stats.join(metadata, "media_id", "left").select("media", "stats", "load_date", "ingest_seq")
