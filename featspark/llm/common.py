"""Pieces that several corpus operators share.

Text rules used throughout: a *word* is a maximal run of characters other than
the six ASCII blanks (space, tab, LF, VT, FF, CR); a null text counts as empty.
"""

from __future__ import annotations

import gc
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featspark.session import drop_at_end, ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_of(col: str | Column = "text") -> Column:
    """The text, null as empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))


def word_count(col: str | Column = "text") -> Column:
    """Number of words as bigint (null text: 0)."""
    return F.regexp_count(text_of(col), F.lit(WORD)).cast("bigint")


def lower_ascii(text: str) -> str:
    """A-Z to a-z, every other character as it is."""
    # bytes.lower() changes A-Z only, and no byte of a longer UTF-8 character is one of these
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def lower_ascii_col(col: str | Column = "text") -> Column:
    return F.translate(text_of(col), _UPPER, _UPPER.lower())


def hash63(*cols: Column) -> Column:
    """Non-negative 60-bit integer from the md5 of the ':'-joined values (a
    formula any SQL engine reproduces); null values count as ''."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("bigint")


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 5 is 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


class Scratch:
    """Written tables of one operator call, in the session's shared folder.

    The folder is ``spark.checkpoint.dir`` (a temporary one only in local mode where
    none is set, as in tests; on a cluster it must be set).  A written table cuts the lineage and
    survives lost executors.  ``drop`` removes a table that no later step reads; the rest goes
    when the driver ends, as results that read it are lazy.
    """

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.root = spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
        self.kept = False

    def write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{self.root}/{name}")
        if not self.kept:
            drop_at_end(self.spark, self.root)
            self.kept = True
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.root}/{name}")

    def release(self) -> None:
        """Let Spark delete the shuffle files of finished steps now: its cleaner
        acts once the driver's garbage collector has seen them unused, which a
        driver with memory to spare may put off until the disks are full."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for n in names:
            p = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}")
            p.getFileSystem(conf).delete(p, True)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of long texts stay small: where the session has Spark's
    default of 10,000 rows a batch, it is set to 500."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "500")


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def map_rows(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]],
             schema: str) -> DataFrame:
    """Arrow batches through ``fn`` (columns as lists in, columns as lists out)."""
    arrow = _arrow_schema(schema)
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # a batch of long texts never sits decoded at once
            for lo in range(0, b.num_rows, 100):
                out = fn(b.slice(lo, 100).to_pydict())
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(run, schema)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
          "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
          "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()),
          "array<binary>": pa.list_(pa.binary())}


def _arrow_schema(schema: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (f.split() for f in schema.split(", "))])


def labelled_sample(docs: DataFrame, labels: DataFrame, columns: list[str], bound: int) -> DataFrame:
    """Labelled training rows: at most ``bound`` of them, those of least key hash.

    Held-out rows (see ``held_out``), rows without a label and repeated labels
    are left out.  The label rows taken are at most ``bound``, so they may be
    broadcast.
    """
    lab = labels.select(F.col("doc_id").alias("_id"), *columns).dropna()
    lab = lab.filter(~held_out("_id")).groupBy("_id").agg(*[F.max(c).alias(c) for c in columns])
    lab = lab.orderBy(F.xxhash64("_id"), "_id").limit(bound)
    d = docs.select(F.col("doc_id").alias("_id"), text_of().alias("text"))
    return d.join(F.broadcast(lab), "_id").select("_id", "text", *columns)


class Hasher:
    """Feature string -> slot of a weight vector, remembered up to a bound."""

    def __init__(self, bits: int, remember: int = 200_000):
        self.mask, self.remember, self.seen = (1 << bits) - 1, remember, {}

    def __call__(self, s: str) -> int:
        v = self.seen.get(s)
        if v is None:
            if len(self.seen) >= self.remember:
                self.seen.clear()
            v = self.seen[s] = zlib.crc32(s.encode("utf-8", "surrogatepass")) & self.mask
        return v


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * np.asarray(x, dtype=np.float64)))


def stack(rows: list[tuple[list[int], list[float]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows -> (row number, slot, value) arrays."""
    n = np.fromiter((len(i) for i, _ in rows), np.int64, len(rows))
    at = np.repeat(np.arange(len(rows), dtype=np.int32), n)
    slot = np.concatenate([np.asarray(i, np.int32) for i, _ in rows] or [np.zeros(0, np.int32)])
    val = np.concatenate([np.asarray(v, np.float32) for _, v in rows] or [np.zeros(0, np.float32)])
    return at, slot, val


def word_counts(text: str) -> Counter:
    return Counter(WORD_RE.findall(text))
