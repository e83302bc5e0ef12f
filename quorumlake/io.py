"""Reading tables, bounded results and the shared checkpoint folder."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Rows of a reference table of at most ``limit`` rows; a larger one is an error, never cut short.

    The one extra row asked for proves the bound without a second pass.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what} has more than {limit} rows, which is the bound for sending it to every executor")
    return rows


def shared_checkpoints(spark: SparkSession) -> None:
    """Use the folder the session names in spark.checkpoint.dir; set one of our own only where none is named.

    A folder of our own is on this machine, so it serves a local master only; on a cluster a name is asked for.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="quorumlake-checkpoints-"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared checkpoint folder."""
    shared_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}"


def state_of(spark: SparkSession, path: str) -> str:
    """What tells that the files of a table have changed: names, lengths and times of all of them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    files, out = where.getFileSystem(conf).listFiles(where, True), []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(repr(sorted(out)).encode()).hexdigest()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, so later stages neither repeat it nor lose it with an executor."""
    shared_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` over enough partitions for every core, before work that costs far more than its rows are large.

    Adaptive execution joins small partitions by their bytes, which would leave costly Python work on few cores; a
    number that is asked for is kept.  Rows of equal columns stay together.
    """
    session = df.sparkSession
    # one more than the usual number: an exchange equal to the one below it would be taken out of the plan
    n = max(int(session.conf.get("spark.sql.shuffle.partitions")), 2 * session.sparkContext.defaultParallelism) + 1
    return df.repartition(n, *columns)


def send(spark: SparkSession, value):
    """Broadcasts a value of proven size under a name of its own, for ``built``."""
    return spark.sparkContext.broadcast((uuid.uuid4().hex, value))


_made: dict[str, object] = {}


def built(sent, make):
    """What ``make`` makes of a sent value, once in each Python worker; a worker keeps that of the last value only."""
    name, value = sent.value
    if name not in _made:
        _made.clear()
        _made[name] = make(value)
    return _made[name]
