"""The k most frequent values of every column, by bounded counters and an exact second pass.

Each task keeps at most ``counters`` values a column (Misra-Gries: when more are held,
the count of the first one too many is taken off all of them, and that loss is added to
the task's error). Counters add up over tasks, so a value's true count lies between its
counters' sum and that plus the column's error E, and a value that no task holds has at
most E. With L the k-th largest sum, only values whose sum plus E reaches L can be among
the k most frequent, and values nobody holds cannot if E < L: the proof. The candidates
are then counted exactly. Columns without a proof (nearly unique ones) or with more than
MAX_CANDIDATES candidates take the wider pass: exact counts of all their values.

Values travel as their first PREFIX characters and, if longer, a digest; whole texts are
read again only for the values finally reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewise.sources.tables import quote

COUNTERS = 4096
MAX_CANDIDATES = 10_000
PREFIX = 64


def _keyed(df: DataFrame, cols) -> DataFrame:
    """(pos, prefix, digest, value) of every non-null value."""
    pairs = F.array(*[F.struct(F.lit(i).alias("pos"), F.col(quote(c)).cast("string").alias("value")) for i, c in enumerate(cols)])
    rows = df.select(F.inline(pairs)).where("value IS NOT NULL")
    long = F.char_length("value") > PREFIX
    return rows.select("pos", F.when(long, F.substring("value", 1, PREFIX)).otherwise(F.col("value")).alias("prefix"),
                       F.when(long, F.sha2(F.col("value").cast("binary"), 256)).otherwise("").alias("digest"), "value")


def reduce_counters(held: dict, counters: int) -> int:
    """Misra-Gries: cut ``held`` (value -> count) to at most ``counters``; returns what was
    taken off every count."""
    if len(held) <= counters:
        return 0
    loss = sorted(held.values(), reverse=True)[counters]
    for key in [k for k, n in held.items() if n <= loss]:
        del held[key]
    for key in held:
        held[key] -= loss
    return loss


def summary(keyed: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(pos, prefix, digest, n) of every task's counters; a row without prefix holds a task's error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict] = {}
        error: dict[int, int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            counted = pa.Table.from_batches([batch]).group_by(["pos", "prefix", "digest"]).aggregate([([], "count_all")])
            for pos, prefix, digest, n in zip(*(counted.column(c).to_pylist() for c in ("pos", "prefix", "digest", "count_all"))):
                own = held.setdefault(pos, {})
                own[prefix, digest] = own.get((prefix, digest), 0) + n
            for pos, own in held.items():
                if len(own) > 4 * counters:
                    error[pos] = error.get(pos, 0) + reduce_counters(own, counters)
        for pos, own in held.items():
            lost = error.get(pos, 0) + reduce_counters(own, counters)
            keys = [(None, None, lost), *((p, d, n) for (p, d), n in own.items())]
            yield pa.RecordBatch.from_arrays([pa.array([pos] * len(keys), pa.int32()), *(pa.array(c, t) for c, t in zip(zip(*keys), (pa.string(), pa.string(), pa.int64())))],
                                             names=["pos", "prefix", "digest", "n"])

    return keyed.select("pos", "prefix", "digest").mapInArrow(run, "pos int, prefix string, digest string, n long")


def top_k(df: DataFrame, cols=None, k: int = 15, counters: int = COUNTERS) -> DataFrame:
    """(column, value, count, rank): ranks by count, ties by value ascending; exact."""
    cols = list(cols or df.columns)
    spark = df.sparkSession
    keyed = _keyed(df, cols)
    found = summary(keyed, counters).groupBy("pos", "prefix", "digest").agg(F.sum("n").alias("n")).persist()
    errors = {r.pos: r.n for r in found.where("prefix IS NULL").collect()}  # one row per column
    sums = found.where("prefix IS NOT NULL")
    kth = {r.pos: (r.held, r.least) for r in sums.withColumn("__r", F.row_number().over(Window.partitionBy("pos").orderBy(F.col("n").desc())))
           .where(F.col("__r") <= k).groupBy("pos").agg(F.count(F.lit(1)).alias("held"), F.min("n").alias("least")).collect()}
    limits = []
    wide = []
    for pos, error in errors.items():
        held, least = kth.get(pos, (0, 0))
        if error == 0:
            limits.append((pos, least if held >= k else 0, 0))  # every value is held and counted exactly
        elif held >= k and error < least:
            limits.append((pos, least - error, error))
        else:
            wide.append(pos)
    bounds = spark.createDataFrame(limits, "pos int, at_least long, error long")
    candidates = sums.join(F.broadcast(bounds), "pos").where(F.col("n") >= F.col("at_least"))
    sized = {r.pos: r.c for r in candidates.where("error > 0").groupBy("pos").agg(F.count(F.lit(1)).alias("c")).collect()}
    wide += [pos for pos, c in sized.items() if c > MAX_CANDIDATES]
    second = [pos for pos, c in sized.items() if c <= MAX_CANDIDATES]
    counts = candidates.where("error = 0").select("pos", "prefix", "digest", "n")
    if second:  # at most MAX_CANDIDATES rows a column
        few = candidates.where(F.col("pos").isin(second)).select("pos", "prefix", "digest")
        counts = counts.unionByName(keyed.join(F.broadcast(few), ["pos", "prefix", "digest"]).groupBy("pos", "prefix", "digest").agg(F.count(F.lit(1)).alias("n")))
    if wide:
        counts = counts.unionByName(keyed.where(F.col("pos").isin(wide)).groupBy("pos", "prefix", "digest").agg(F.count(F.lit(1)).alias("n")))
    # ties by value: equal prefixes of long values stay together until the whole texts decide
    order = Window.partitionBy("pos").orderBy(F.col("n").desc(), "prefix")
    last = counts.withColumn("__r", F.rank().over(order)).where(F.col("__r") <= k).drop("__r")
    texts = (keyed.where("digest <> ''").join(last.where("digest <> ''").select("pos", "prefix", "digest"), ["pos", "prefix", "digest"], "left_semi")
             .groupBy("pos", "prefix", "digest").agg(F.first("value").alias("whole")))
    names = spark.createDataFrame(list(enumerate(cols)), "pos int, column string")
    out = last.join(texts, ["pos", "prefix", "digest"], "left").withColumn("value", F.coalesce("whole", "prefix")).join(F.broadcast(names), "pos")
    final = Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("value").asc())
    return out.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("column", "value", F.col("n").alias("count"), "rank")
