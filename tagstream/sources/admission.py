"""Event-time-safe admission of files to streams (SRC7, file branch).

A file stream hands out files in the order of their modification times. When
event time does not follow that order, the watermark runs ahead of files that
have not been read, and Spark drops their rows as late. ``Admission`` keeps the
watermark behind every file that was there: the files found together form a
set; their rows are dealt into slices of event time of about ``slice_bytes``
each; the slices are published one after the other, and each one is read to its
end before the next appears. Rows of a later slice are never older than those
of an earlier one, so nothing of a set is late, whatever the file order, and a
micro-batch and the state a stream holds stay bounded by a slice. Rows that
arrive in a later set, older than the watermark by then, are late in the usual
sense.

Everything is written below ``root``, on the cluster's shared file system:

    sets/<n>/files    the files of a set (path, size, modification time)
    sets/<n>/grains   event-time grain -> slice
    sets/<n>/staged   the rows, one folder per slice
    sets/<n>/_ready   present once ``staged`` is whole
    admitted/<n>-<i>  published slices: the streams read this folder

Publishing renames one folder, so a slice appears whole or not at all. A run
that was stopped anywhere goes on where it stopped: an unfinished set is staged
again, published slices stay, and each query's own checkpoint knows what it has
read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tagstream.functions.timefn import bucket_of, duration_micros

SLICE_BYTES = 64 << 30       # input bytes of a slice: one micro-batch of a cluster
FILE_BYTES = 256 << 20       # input bytes of a staged file
FILE_ROWS = 1 << 18          # and its rows: a task sorts a file's rows, whatever their size in the input
FILES = "path string, modificationTime timestamp, length long"


class Admission:
    """Admits the files of ``path`` (a folder or one file) in event-time order."""

    def __init__(self, spark: SparkSession, path: str, root: str, schema: T.StructType | str, ts: str = "ts",
                 fmt: str = "parquet", slice_bytes: int = SLICE_BYTES, grain: str = "1 hour") -> None:
        self.spark, self.path, self.root = spark, path, root.rstrip("/")
        self.schema, self.ts, self.fmt = schema, ts, fmt
        self.slice_bytes, self.grain = slice_bytes, duration_micros(grain)
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        source = self._path(path)
        if not source.getFileSystem(spark._jsc.hadoopConfiguration()).exists(source):
            raise FileNotFoundError(path)
        self._fs.mkdirs(self._path(f"{self.root}/admitted"))

    # ------------------------------------------------------------- folders
    def _names(self, folder: str) -> list[str]:
        p = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def _exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.root}/{name}"))

    def published(self) -> list[str]:
        return self._names("admitted")

    def pending(self, number: str) -> list[int]:
        """Slices of a staged set that are not published yet, in event-time order."""
        return sorted(int(n.split("=")[1]) for n in self._names(f"sets/{number}/staged") if n.startswith("slice="))

    # ------------------------------------------------------------- staging
    def stage(self) -> str | None:
        """The set to publish next: one with slices left, or else all files that no set holds."""
        sets = self._names("sets")
        for n in sets:
            if not self._exists(f"sets/{n}/_ready"):
                self._deal(n)
            if self.pending(n):
                return n
        listed = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.path)
                  .select("path", "modificationTime", "length"))
        if sets:
            held = self.spark.read.schema(FILES).parquet(*[f"{self.root}/sets/{n}/files" for n in sets])
            listed = listed.join(held, ["path", "modificationTime", "length"], "left_anti")
        number = f"{len(sets):06d}"
        if listed.isEmpty():
            return None
        listed.write.mode("overwrite").parquet(f"{self.root}/sets/{number}/files.new")
        self._fs.rename(self._path(f"{self.root}/sets/{number}/files.new"), self._path(f"{self.root}/sets/{number}/files"))
        self._deal(number)
        return number if self.pending(number) else self.stage()

    def _deal(self, number: str) -> None:
        """Writes the rows of a set by slice; run again, it replaces what an interrupted run left."""
        base = f"{self.root}/sets/{number}"
        files = self.spark.read.schema(FILES).parquet(f"{base}/files")
        # the driver holds the paths of a set, as the file stream's own log would
        rows = (self.spark.read.schema(self.schema).format(self.fmt)
                .load([r[0] for r in files.select("path").orderBy("path").toLocalIterator()]))
        grain = F.coalesce(bucket_of(F.col(self.ts).cast("timestamp"), self.grain), F.lit(0).cast("long"))
        size = files.agg(F.sum("length")).first()[0]
        counts = rows.groupBy(grain.alias("grain")).agg(F.count("*").alias("n"))
        # one row per grain of the set's time span
        before = F.sum("n").over(Window.orderBy("grain").rowsBetween(Window.unboundedPreceding, -1))
        share = F.lit(float(size)) / F.sum("n").over(Window.partitionBy())
        rows_before = F.coalesce(before, F.lit(0))
        per_file = F.least(F.lit(FILE_BYTES) / share, F.lit(float(FILE_ROWS)))       # rows of a file
        grains = counts.select("grain", F.floor(rows_before * share / self.slice_bytes).cast("int").alias("slice"),
                               F.floor(rows_before / per_file).alias("first"), F.ceil(F.col("n") / per_file).cast("int").alias("files"))
        grains.write.mode("overwrite").parquet(f"{base}/grains")
        grains = self.spark.read.schema("grain long, slice int, first long, files int").parquet(f"{base}/grains")
        # small grains share a file, a grain's rows go to as many tasks as their number needs
        plain = [f.name for f in rows.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        dealt = (rows.withColumn("_grain", grain).join(grains, F.col("_grain") == F.col("grain"))
                 .withColumn("_part", F.col("first") + F.pmod(F.xxhash64(*plain), F.greatest("files", F.lit(1))))
                 .repartition("slice", "_part").select(*rows.columns, "slice"))
        dealt.write.mode("overwrite").partitionBy("slice").parquet(f"{base}/staged")
        self._fs.create(self._path(f"{base}/_ready"), True).close()

    def publish(self, number: str, piece: int) -> None:
        """Makes one slice visible to the streams."""
        if not self._fs.rename(self._path(f"{self.root}/sets/{number}/staged/slice={piece}"),
                               self._path(f"{self.root}/admitted/{number}-{piece:06d}")):
            raise OSError(f"could not publish slice {piece} of set {number} below {self.root}")

    # ------------------------------------------------------------- streams
    def stream(self) -> DataFrame:
        """The published slices as a stream; a query needs a checkpoint of its own."""
        return (self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true")
                .parquet(f"{self.root}/admitted"))

    def run(self, start: Callable[[DataFrame], StreamingQuery]) -> None:
        """Runs a query over every file, slice by slice, until none is left.

        ``start`` takes the stream and starts the query with
        ``trigger(availableNow=True)`` and always the same checkpoint.
        """
        if self.published() or self.stage() is None:
            start(self.stream()).awaitTermination()     # what a stopped run had published; or an empty sink
        while (number := self.stage()) is not None:
            for piece in self.pending(number):
                self.publish(number, piece)
                start(self.stream()).awaitTermination()

