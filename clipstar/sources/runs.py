"""Tables that grow by small batches: levelled runs with compaction, and an index of keys with a Bloom filter per run.

A batch adds one run at level 0.  ``FAN`` runs of a level become one run of the next, so after N batches there are at most
FAN runs on each of log(N) levels, and a row is rewritten once per level.  Which runs there are is part of the commit
(``sources.commits``); readers combine all runs of their manifest.

The key index has a Bloom filter beside each run: rows of ``FILTER_BITS`` bits by a hash of the key, as many as the run's
keys need, made by Spark's bitmap aggregate.  Keys are probed against the filters of all runs first, and only runs
in which some key may be are opened.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clipstar.sources.commits import Commits, Manifest, observed

FAN = 8
ROWS_PER_FILE = 5_000_000
FILTER_BITS = 1 << 15
KEYS_PER_ROW = FILTER_BITS // 16
PROBES = 8
#: A task makes the filter of so many keys, which it sorts by bit, eight rows a key.
KEYS_PER_TASK = 200_000
#: So many hashes are handed to the scan as a list, which prunes row groups of the sorted runs; more are joined.
LISTED = 1000


class Runs:
    """The runs of ``table`` in a manifest.  ``combine`` makes of the rows of several runs those of one."""

    def __init__(self, commits: Commits, manifest: Manifest, table: str, ddl: str,
                 combine: Callable[[DataFrame], DataFrame]):
        self.spark, self.commits, self.manifest, self.table = commits.spark, commits, manifest, table
        self.ddl, self.combine = ddl, combine

    def folders(self) -> list[str]:
        """Newest first."""
        levels = sorted(self.manifest.parts(self.table).items(), key=lambda x: int(x[0]))
        return [f for _, folders in levels for f in reversed(folders)]

    def _open(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.ddl)
        return self.spark.read.schema(self.ddl).parquet(*[f"{self.commits.root}/{f}" for f in folders])

    def rows(self) -> DataFrame:
        return self._open(self.folders())

    def read(self) -> DataFrame:
        return self.combine(self.rows())

    def _write(self, df: DataFrame) -> tuple[str, int]:
        folder, seen = self.commits.new_folder(self.table), Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.commits.root}/{folder}")
        return folder, observed(seen, "rows")

    def add(self, rows: DataFrame) -> None:
        """A run of the batch's rows; full levels are merged into the next one."""
        folder, count = self._write(self.combine(rows))
        if not count:
            return
        parts = self.manifest.parts(self.table)
        parts.setdefault("0", []).append(folder)
        level = 0
        while len(parts.get(str(level), [])) >= FAN:
            merged, _ = self._write(self.combine(self._open(parts.pop(str(level)))))
            level += 1
            parts.setdefault(str(level), []).append(merged)

    def replace(self, rows: DataFrame) -> None:
        """One run instead of all."""
        self.manifest.tables[self.table] = {}
        folder, count = self._write(self.combine(rows))
        if count:
            self.manifest.parts(self.table)["0"] = [folder]


def _probe(i: int, key: str) -> Column:
    """The bit that probe ``i`` of a key sets in its filter row."""
    return F.pmod(F.xxhash64(key, F.lit(i + 1)), F.lit(FILTER_BITS))


KEY_DDL = "h BIGINT, key STRING"
FILTER_DDL = "run STRING, rows BIGINT, row BIGINT, bits BINARY"


class KeyIndex(Runs):
    """A set of keys.  A run's folder has its keys, sorted by hash, and its filter."""

    def __init__(self, commits: Commits, manifest: Manifest, table: str):
        # Shuffled before keys are looked for twice: a scan's task can have very many keys, as they compress well.
        super().__init__(commits, manifest, table, KEY_DDL, lambda rows: rows.repartition("key").distinct())

    def _open(self, folders: list[str]) -> DataFrame:
        return super()._open([f"{f}/keys" for f in folders])

    def _write(self, df: DataFrame) -> tuple[str, int]:
        folder, seen = self.commits.new_folder(self.table), Observation()
        at = f"{self.commits.root}/{folder}"
        # Sorted over all files, so that a hash is in one row group of one file.
        df.orderBy("h").observe(seen, F.count(F.lit(1)).alias("rows")).write.option(
            "maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{at}/keys")
        count = observed(seen, "rows")
        rows = max(1, -(-count // KEYS_PER_ROW))
        keys = self.spark.read.schema(KEY_DDL).parquet(f"{at}/keys")
        places = F.array(*[_probe(i, "key") for i in range(PROBES)])
        keys.select(F.pmod("h", F.lit(rows)).alias("row"), "key") \
            .repartition(max(1, -(-count // KEYS_PER_TASK)), "row").select("row", F.explode(places).alias("place")) \
            .groupBy("row").agg(F.bitmap_construct_agg("place").alias("bits")) \
            .select(F.lit(folder).alias("run"), F.lit(rows).cast("bigint").alias("rows"), "row", "bits") \
            .write.parquet(f"{at}/filter")
        return folder, count

    @staticmethod
    def keyed(df: DataFrame, column: str) -> DataFrame:
        return df.select(F.xxhash64(F.col(column)).alias("h"), F.col(column).alias("key"))

    def add_keys(self, df: DataFrame, column: str) -> None:
        self.add(self.keyed(df, column))

    def probe(self, keys: DataFrame) -> DataFrame:
        """(run, h, key): which run may have which of ``keys(h, key)``, by the filters alone."""
        folders = self.folders()
        if not folders:
            return self.spark.createDataFrame([], f"run STRING, {KEY_DDL}")
        filters = self.spark.read.schema(FILTER_DDL).parquet(*[f"{self.commits.root}/{f}/filter" for f in folders])
        sizes = filters.select("run", "rows").distinct().collect()  # FAN runs a level at most
        runs = F.array(*[F.struct(F.lit(r["run"]).alias("run"), F.lit(r["rows"]).alias("rows")) for r in sizes])
        asked = keys.withColumn("places", F.array(*[_probe(i, "key") for i in range(PROBES)])) \
            .select("*", F.inline(runs)).withColumn("row", F.pmod("h", "rows"))
        byte = F.expr("transform(places, p -> conv(hex(substring(bits, cast(p div 8 as int) + 1, 1)), 16, 10))")
        found = asked.join(filters.select("run", "row", "bits"), ["run", "row"]).withColumn("bytes", byte)
        every = F.expr("forall(zip_with(places, bytes, (p, b) -> (shiftright(cast(b as int), cast(p % 8 as int)) & 1) = 1),"
                       " x -> x)")
        return found.where(every).select("run", "h", "key")

    def known(self, keys: DataFrame) -> tuple[DataFrame, list[str]]:
        """Which of ``keys(h, key)`` the index has, and the runs that were opened for it."""
        maybe = self.probe(keys).checkpoint()
        opened = sorted(r[0] for r in maybe.select("run").distinct().collect())  # names of runs
        if not opened:
            return self.spark.createDataFrame([], "key STRING"), []
        wanted = maybe.select("h", "key").distinct()
        stored = self._open(opened)
        few = wanted.select("h").distinct().limit(LISTED + 1).collect()
        if len(few) <= LISTED:
            stored = stored.where(F.col("h").isin([r[0] for r in few]))
        return wanted.join(stored, ["h", "key"], "left_semi").select("key"), opened
