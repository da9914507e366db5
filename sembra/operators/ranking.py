"""Ranks and quantiles by radix selection: histograms of digits instead of sorted groups.

Values are mapped to 64-bit whole numbers in the same order. A round counts one digit of 16 bits per
group, so a group is never more than 65,536 counts, however many rows it has; the wanted ranks fall
into one digit each, and the next round counts only rows that share the digits found so far.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sembra.session import materialize

DIGIT_BITS, IMAGE_BITS = 16, 64
TARGET_FIELDS = [T.StructField("prefix", T.LongType()), T.StructField("rank", T.LongType())]


def group_key(group: list[str]):
    """One column for any number of group columns; nulls are a group like any other."""
    return F.struct(*group) if group else F.lit(0)


def located(digits: np.ndarray, counts: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per rank (from 0): its place among ``ranks``, its digit, and its rank inside the digit."""
    order = np.argsort(digits, kind="stable")
    until = np.cumsum(counts[order])
    inside = np.flatnonzero((ranks >= 0) & (ranks < (until[-1] if len(until) else 0)))
    at = np.searchsorted(until, ranks[inside], "right")
    return inside, digits[order][at], ranks[inside] - (until[at] - counts[order][at])


def radix_select(
    values: DataFrame, targets: DataFrame | Callable[[int], dict], fields: list[T.StructField], rounds: int = IMAGE_BITS // DIGIT_BITS
) -> DataFrame:
    """The digits of the values at given ranks: ``_g, prefix, rank`` and the other ``fields``.

    ``values(_g, image)``; ``targets(_g, rank, fields)``, or a function from the size of a group to
    columns ``rank`` and ``fields`` of its targets. After all rounds ``prefix`` is the image and ``rank``
    the place among its copies; after fewer, the image's first digits and the place among all values
    that begin with them. Ranks beyond a group are left out.
    """
    kind = values.schema["_g"]
    names = [f.name for f in fields]
    schema = T.StructType([kind, *TARGET_FIELDS, *fields])
    types = to_arrow_schema(schema)

    def pick(hist: pa.Table, ranks: np.ndarray, prefix: np.ndarray, key, columns: dict) -> pa.Table:
        inside, digits, left = located(hist["digit"].to_numpy(), hist["n"].to_numpy(), ranks)
        out = [pa.chunked_array([pa.repeat(key, len(inside))]), pa.array(prefix[inside] | digits), pa.array(left)]
        rows = pa.array(inside)
        return pa.table([c.cast(f.type) for c, f in zip([*out, *(columns[c].take(rows) for c in names)], types)], schema=types)

    def first(hist: pa.Table) -> pa.Table:
        made = targets(int(hist["n"].to_numpy().sum()))
        columns = {c: pa.array(made[c]) for c in names}
        ranks = np.asarray(made["rank"], np.int64)
        return pick(hist, ranks, np.zeros(len(ranks), np.int64), hist["_g"][0], columns)

    def later(hist: pa.Table, wanted: pa.Table) -> pa.Table:
        if not hist.num_rows or not wanted.num_rows:
            return types.empty_table()
        prefix = wanted["prefix"].to_numpy() << DIGIT_BITS
        return pick(hist, wanted["rank"].to_numpy(), prefix, wanted["_g"][0], {c: wanted[c] for c in names})

    if callable(targets):
        shift = IMAGE_BITS - DIGIT_BITS
        hist = values.groupBy("_g", F.shiftright("image", shift).alias("digit")).agg(F.count(F.lit(1)).alias("n"))
        found, done = materialize(hist.groupBy("_g").applyInArrow(first, schema), "digits"), 1
    else:
        found, done = targets.withColumn("prefix", F.lit(0).cast("long")).select(schema.names), 0
    for turn in range(done, rounds):
        shift = IMAGE_BITS - DIGIT_BITS * (turn + 1)
        # Found digits were written, so the planner knows their size and sends them if they are few.
        begun = F.shiftright("image", shift + DIGIT_BITS) if turn else F.lit(0).cast("long")
        digit = F.shiftright("image", shift) if turn == 0 else F.shiftright("image", shift).bitwiseAND((1 << DIGIT_BITS) - 1)
        open_ = values.select("_g", begun.alias("prefix"), digit.alias("digit"))
        if turn:
            open_ = open_.join(found.select("_g", "prefix").distinct(), ["_g", "prefix"], "left_semi")
        hist = open_.groupBy("_g", "prefix", "digit").agg(F.count(F.lit(1)).alias("n"))
        met = hist.groupBy("_g", "prefix").cogroup(found.groupBy("_g", "prefix")).applyInArrow(later, schema)
        found = materialize(met, "digits")
    return found


# --- percentiles ---


def images(values: DataFrame) -> DataFrame:
    """(_g, image): doubles as whole numbers in the same order (NaN is the greatest, -0 equals 0)."""
    schema = T.StructType([values.schema["_g"], T.StructField("image", T.LongType())])

    def run(batches):
        types = to_arrow_schema(schema)
        for batch in batches:
            v = np.asarray(batch.column(1), np.float64) + 0.0
            bits = np.where(np.isnan(v), np.nan, v).view(np.int64)
            image = np.where(bits < 0, bits ^ np.int64((1 << 63) - 1), bits)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(image)], schema=types)

    return values.mapInArrow(run, schema)


def exact_percentiles(df: DataFrame, group: list[str], value: str, probs: list[float]) -> DataFrame:
    """Linearly interpolated percentiles per group: ``group..., prob, value``; nulls are left out.

    The values are written once as whole numbers and counted four times, digit by digit.
    """
    known = df.where(F.col(value).isNotNull()).select(group_key(group).alias("_g"), F.col(value).cast("double").alias("v"))
    values = materialize(images(known), "images")
    fields = [T.StructField("prob", T.DoubleType()), T.StructField("upper", T.BooleanType()), T.StructField("fraction", T.DoubleType())]

    def ranks(n: int) -> dict:
        at = np.array(probs) * (n - 1)
        low, high = np.floor(at).astype(np.int64), np.ceil(at).astype(np.int64)
        both = np.r_[np.zeros(len(at), bool), np.ones(len(at), bool)]
        return {"rank": np.r_[low, high], "prob": np.tile(probs, 2), "upper": both, "fraction": np.tile(at - low, 2)}

    found = radix_select(values, ranks, fields)
    schema = T.StructType([*found.schema.fields, T.StructField("v", T.DoubleType())])

    def run(batches):
        types = to_arrow_schema(schema)
        for batch in batches:
            image = np.asarray(batch.column("prefix"), np.int64)
            v = np.where(image < 0, image ^ np.int64((1 << 63) - 1), image).view(np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(v)], schema=types)

    ends = found.mapInArrow(run, schema).groupBy("_g", "prob").agg(
        F.max(F.when(~F.col("upper"), F.col("v"))).alias("low"), F.max(F.when(F.col("upper"), F.col("v"))).alias("high"), F.first("fraction").alias("f")
    )
    names = [F.col(f"_g.{c}").alias(c) for c in group]
    return ends.select(*names, "prob", (F.col("low") + (F.col("high") - F.col("low")) * F.col("f")).alias("value"))


# --- positions ---


def at_positions(df: DataFrame, group: list[str], id_col: str, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` by their place (from 0) in the order of a hash of ``id_col``, per group.

    ``wanted(group..., position, key)``; returns ``key`` with the columns of ``df``. Places are located by
    counts of the hash's first 28 bits, so only rows that share them with a wanted one are moved and
    ranked; nothing else is sorted or exchanged.
    """
    digest = F.md5(F.col(id_col).cast("string"))
    # Fifteen hex digits fill a positive long, its first 16-bit digit has 12 bits.
    image = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    hashed = df.withColumns({"_g": group_key(group), "image": image, "_hash": digest})
    rounds = 2
    fields = [T.StructField("wanted", wanted.schema[key].dataType)]
    targets = wanted.select(group_key(group).alias("_g"), F.col("position").cast("long").alias("rank"), F.col(key).alias("wanted"))
    # Positions are drawn for sizes that are counted on the way: written once.
    found = radix_select(hashed.select("_g", "image"), materialize(targets, "positions"), fields, rounds)
    begun = F.shiftright("image", IMAGE_BITS - DIGIT_BITS * rounds)
    near = hashed.withColumn("prefix", begun).join(found.select("_g", "prefix").distinct(), ["_g", "prefix"], "left_semi")
    inside = Window.partitionBy("_g", "prefix").orderBy("_hash", id_col)
    ranked = near.withColumn("rank", F.row_number().over(inside).cast("long") - 1)
    rows = ranked.join(found, ["_g", "prefix", "rank"])
    return rows.select(F.col("wanted").alias(key), *df.columns)
