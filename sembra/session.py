"""Session settings, the shared scratch folder, and size-checked small tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_SCRATCH: dict[str, str] = {}
_SHIPPED: set[str] = set()

# Largest lookup table that is broadcast, in rows and in bytes of its rows as JSON; larger ones take
# a salted shuffle join.
MAX_BROADCAST_ROWS = 10_000
MAX_BROADCAST_BYTES = 32 << 20
#: Rows with one key from which a shuffled lookup spreads them.
HOT_ROWS = 5_000


def build_session(app_name: str = "sembra", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; every setting can be overridden by keyword."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the session's Python workers (once per application).

    Not needed where the package is installed on the cluster or sent with ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="sembra-ship-")) / "sembra.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for local sessions."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="sembra-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage for good.

    Unlike a cached block, the files outlive lost executors, and values that depend on task
    layout (partition ids) are fixed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores when the scan has fewer splits than cores.

    For work that costs far more than moving the rows (regular expressions, encoders) on few
    or unsplittable files; with enough splits ``df`` is returned as it is.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def small_table(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame | None:
    """``df``, written once, when rows and bytes pass the check, else ``None``; nothing is collected."""
    head = materialize(df.limit(max_rows + 1), "lookup")
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    rows, total = head.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    return head if rows <= max_rows and total <= MAX_BROADCAST_BYTES else None


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    spread_by: str,
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
    salts: int = 64,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``big`` to a table with one row per key, safe when one key holds much of ``big``.

    The lookup side is broadcast if its rows and bytes pass the check. Otherwise both sides are
    shuffled once. Only the rows of a hot key, one with over ``hot_rows`` rows of ``big``, are spread over
    ``salts`` tasks by a hash of ``spread_by``, and its one row of the lookup side is repeated for them.
    """
    local = small_table(small, max_rows)
    if local is not None:
        return big.join(F.broadcast(local), on, how)
    named = F.lit(True)
    for key in on:
        named = named & F.col(key).isNotNull()
    counts = big.where(named).groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    # One key in so many rows at most: small whatever the table.
    hot = materialize(counts.where(F.col("_rows") > hot_rows).select(*on, F.lit(salts).cast("long").alias("_salts")), "hot")
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts))
    # Rows without a key meet nothing and are spread as well.
    salted_big = big.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.when(F.col("_salts").isNotNull() | ~named, salt).otherwise(F.lit(0).cast("long"))
    )
    salted_small = small.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1).cast("long")) - 1))
    )
    return salted_big.drop("_salts").join(salted_small.drop("_salts"), [*on, "_salt"], how).drop("_salt")
