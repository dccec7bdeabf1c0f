"""Helpers shared by the operators: tables written to the shared folder, word splitting, column names."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: One word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Where tables go if a session on one machine (master local) names no shared folder, as in tests.
LOCAL_CHECKPOINTS = "file:///tmp/checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a session whose driver does all the
    work may go without; on a cluster a missing setting is an error, as a machine's own folder would lose data."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = LOCAL_CHECKPOINTS
    return at.rstrip("/")


#: Folders written and not yet deleted, oldest first.
_written: list[str] = []


def fresh_path(spark: SparkSession, what: str) -> str:
    path = f"{shared_dir(spark)}/siftstone/{what}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, survives lost executors, and
    gives the planner a true size, so that it broadcasts only what its own threshold allows."""
    spark = df.sparkSession
    path = fresh_path(spark, what)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._siftstone_path = path
    return out


def drop_table(df: DataFrame) -> None:
    """Delete what materialize() wrote for df; for tables that a later one replaces."""
    path = getattr(df, "_siftstone_path", None)
    if path:
        delete_path(df.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    if path in _written:
        _written.remove(path)


class Scratch:
    """`with Scratch(spark) as s`: what operators have written to the shared folder within is deleted at the end,
    but for the tables passed through s.keep(). Results must have been written or collected by then."""

    def __init__(self, spark: SparkSession):
        self.spark, self.before, self.kept = spark, set(), set()

    def __enter__(self) -> Scratch:
        self.before = set(_written)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept.add(df._siftstone_path)
        return df

    def __exit__(self, *_) -> None:
        for path in [p for p in _written if p not in self.before and p not in self.kept]:
            delete_path(self.spark, path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that df does not have, whatever its letter case."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        k = f"__{name}"
        while k.lower() in have:
            k += "_"
        have.add(k.lower())
        out.append(k)
    return out


def append(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with the given columns; an input column of the same name (any letter case) gives way."""
    new = {c.lower() for c in columns}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in new], *[v.alias(k) for k, v in columns.items()])


#: Words of 64 bits in which keys are marked: what is broadcast is bounded by them.
MARKS = 1 << 19


def may_be_among(df: DataFrame, key: Column, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of df whose key, a hash as a long, may be among keys (a table of one such column): all whose key is, and of the
    others a share that is small up to millions of keys (a twentieth at 1.7 million). how left_anti: the rest, none of which is.

    Rows do not move for it; an exact join of what it gives is to follow, and moves little if few rows are among keys."""
    word, bits = fresh(df, "word", "bits")
    of = lambda k: (F.pmod(k, F.lit(MARKS)), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(k, 32), F.lit(64)).cast("int")))
    at, bit = of(F.col(f"`{keys.columns[0]}`"))
    marks = keys.groupBy(at.alias(word)).agg(F.bit_or(bit).alias(bits))
    at, bit = of(key)
    return df.join(F.broadcast(marks), (at == F.col(word)) & (bit.bitwiseAND(F.col(bits)) != 0), how)


def without(df: DataFrame, key: Column, gone: DataFrame, hashed: str, same: Column) -> DataFrame:
    """df without the rows that have one in gone by `same`. key: a hash of a row of df, equal to the column hashed of gone then.
    Only rows whose key may be there meet gone, so that the others, wide as they are, need no shuffle."""
    keys = gone.select(hashed)
    return may_be_among(df, key, keys, "left_anti").unionByName(may_be_among(df, key, keys).join(gone, (key == gone[hashed]) & same, "left_anti"))


def fold(id_col: str) -> Column:
    """crc32 of the id as text, mod 4; 2 marks held-out rows. Null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4))


def held_out(id_col: str) -> Column:
    return fold(id_col) == 2


def word_blocks(data: bytes, block: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, in lists of about block bytes each, cut at white space only."""
    if len(data) <= block:
        yield data.split()
        return
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + block)
        tail = b""
        while end < n:  # go on to the next white space
            piece = data[end : end + 4096]
            cut = next((i for i, c in enumerate(piece) if c == 32 or 9 <= c <= 13), -1)
            if cut >= 0:
                end += cut
                break
            end += len(piece)
        yield (data[at:end] + tail).split()
        at = end


def bounded_sample(df: DataFrame, mark: Column, label: str, rows: int) -> DataFrame:
    """About `rows` rows of df, no more, dealt evenly over the values of label: up to rows / (number of values) of each, and one
    of each if there are more values than rows, so that every value is met. Which ones is decided by the hash `mark`:
    deterministic, without a shuffle of other rows."""
    counts = materialize(df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("__of")).count(), "labels")
    each = max(1, rows // max(1, counts.count()))
    # of each value several times the wanted number are read, so that none is missed by chance (about 1 in 10**10)
    rates = materialize(counts.select("__of", (F.lit(4.0 * each + 20) / F.col("count")).alias("__rate")), "rates")
    some = df.withColumn("__mark", mark).join(rates, F.col(label) == F.col("__of")).filter(F.pmod("__mark", F.lit(1 << 40)) < F.col("__rate") * (1 << 40))
    rank = F.row_number().over(Window.partitionBy("__of").orderBy("__mark"))
    return some.withColumn("__rank", rank).filter(F.col("__rank") <= each).orderBy("__mark").drop("__of", "__rate", "__mark", "__rank")


_state: dict[str, object] = {}


def worker_state(key: str, make: Callable[[], object]):
    """What a Python worker remembers between batches and tasks: one operator's state at a time, so that the stages
    of a pipeline, which share workers, do not add up their memories. What Arrow holds unused goes back as well."""
    if key not in _state:
        _state.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # other C libraries keep what is free
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        _state[key] = make()
    return _state[key]
