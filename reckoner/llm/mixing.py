"""Mixing sources to target weights by pivotal dependent rounding.

A document's expected copies are its source's target over its source's size.
The whole part is certain; the fractional parts are rounded dependently. Two
documents of a source trade words: at random, one gives what the other can take
until one of the two is 0 or 1, with odds that keep both expectations. The words
of the pair, and so of the source, do not change. What is left of a pair trades
with the next document.

The trades form a reduction tree: documents are hashed to leaves of about
``FAN`` documents, each leaf leaves at most one fraction, and ``FAN`` leaves
meet in the node above, up to one fraction per source, which goes to the nearer
whole number. So a source misses its target by at most half a document, its
expected copies apart, and no task holds more than a node. Large documents
trade first, so what is left tends to be small.

Weights follow the sources in code point order, numbered by ranges, not in one
task. The shares are found by sums over the sources: targets at their limit are
fixed and the rest is shared anew until no more reach it.

Everything is hashes and aggregates of built-in functions, so reruns agree.

Cases: NULL and blank texts have size 0 and are never taken. NULL is a source
of its own, the last. Rows equal in id, source and size are rounded as one
document of so many rows, and their copies are dealt to the rows evenly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reckoner.llm.shared import written

FAN = 64
LIMIT = 3
WEIGHTS = (1, 2, 3)
SEED = 20240607

# An item whose extra copy has a probability: row hash, item, words and probability.
ITEM = "struct<h:bigint,item:bigint,w:double,p:double>"
STATE = f"struct<rest:{ITEM},out:array<struct<item:bigint,extra:int>>>"


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """Distinct (source, doc_id, size) with their number of rows."""
    rows = docs.select(F.col("source").cast("string").alias("source"), "doc_id", size_of(F.col("text")).alias("size"))
    grouped = rows.groupBy("source", "doc_id", "size").agg(F.count("*").alias("rows"))
    return written(grouped.withColumn("item", F.monotonically_increasing_id()), "sizes")


def numbered(sources: DataFrame) -> DataFrame:
    """Sources with ``place`` from 0 in code point order, NULL last."""
    order = [F.asc_nulls_last("source")]
    ranges = written(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    own = Window.partitionBy("part").orderBy(*order)
    return ranges.join(offsets, "part").withColumn("place", F.col("offset") + F.row_number().over(own) - 1).drop("part", "offset")


def targets(items: DataFrame) -> DataFrame:
    """Per source: source_size and target."""
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    sources = items.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    weighted = numbered(sources).withColumn("weight", F.get(weights, (F.col("place") % len(WEIGHTS)).cast("int")))
    weighted = written(weighted, "weights")
    limit = F.col("source_size") * LIMIT
    share, fixed_before = 0.0, None
    while True:
        at_limit = F.lit(False) if fixed_before is None else limit <= F.col("weight") * share
        total, fixed, free, n = weighted.agg(
            F.sum("source_size"), F.sum(F.when(at_limit, limit)), F.sum(F.when(~at_limit, F.col("weight"))), F.count_if(at_limit)
        ).first()
        if not free or n == fixed_before:
            break
        share, fixed_before = (total - (fixed or 0)) / free, n
    return weighted.select(
        "source", "source_size", F.least(limit.cast("double"), F.col("weight") * F.lit(share)).alias("target")
    )


def uniform(*columns: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *columns), 11) / F.lit(float(1 << 53))


def trade(state: Column, new: Column, level: int) -> Column:
    """Move words between the fraction left so far and the next item until one is whole."""
    old = state["rest"]
    has_old, has_new = old["w"] * old["p"], new["w"] * new["p"]
    room_old, room_new = old["w"] * (1 - old["p"]), new["w"] * (1 - new["p"])
    to_old, to_new = F.least(room_old, has_new), F.least(room_new, has_old)
    old_gains = uniform(F.lit(level), old["h"], new["h"]) * (to_old + to_new) < to_new

    p_old = F.when(
        old_gains, F.when(room_old <= has_new, F.lit(1.0)).otherwise(old["p"] + has_new / old["w"])
    ).otherwise(F.when(has_old <= room_new, F.lit(0.0)).otherwise(old["p"] - room_new / old["w"]))
    p_new = F.when(
        old_gains, F.when(has_new <= room_old, F.lit(0.0)).otherwise(new["p"] - room_old / new["w"])
    ).otherwise(F.when(room_new <= has_old, F.lit(1.0)).otherwise(new["p"] + has_old / new["w"]))

    traded = F.array(old.withField("p", p_old), new.withField("p", p_new))
    whole = lambda i: (i["p"] <= 0) | (i["p"] >= 1)
    split = F.transform(F.array(traded), lambda pair: F.struct(
        F.get(F.filter(pair, lambda i: ~whole(i)), F.lit(0)).alias("rest"),
        F.concat(state["out"], F.transform(F.filter(pair, whole), decided)).alias("out"),
    ))
    first = F.struct(new.alias("rest"), state["out"].alias("out"))
    return F.when(old.isNull(), first).otherwise(F.get(split, F.lit(0))).cast(STATE)


def decided(item: Column) -> Column:
    return F.struct(item["item"].alias("item"), (item["p"] >= 0.5).cast("int").alias("extra"))


def rounded(fractions: DataFrame, widest: int) -> DataFrame:
    """Item and its extra copy, 0 or 1. ``fractions``: source, bucket, h, item, w, p."""
    levels = max(1, math.ceil(math.log(max(2, widest), FAN)))
    out = None
    for level in range(levels + 1):
        nodes = fractions.groupBy("source", "bucket").agg(F.collect_list(F.struct("h", "item", "w", "p")).alias("items"))
        largest_first = F.transform(
            F.sort_array(F.transform("items", lambda i: F.struct(-i["w"], i["h"], i["item"], i.alias("i")))), lambda s: s["i"]
        )
        start = F.struct(F.lit(None).cast(ITEM).alias("rest"), F.array().alias("out")).cast(STATE)
        folded = F.aggregate(largest_first, start, lambda s, i: trade(s, i, level))  # noqa: B023
        nodes = written(nodes.select("source", "bucket", folded.alias("state")), "trades")
        done = nodes.select(F.explode("state.out").alias("d")).select("d.*")
        out = done if out is None else out.unionAll(done)
        fractions = nodes.filter(F.col("state.rest").isNotNull()).select(
            "source", F.expr(f"bucket div {FAN}").alias("bucket"), "state.rest.*"
        )
    last = fractions.select(decided(F.struct("item", "p")).alias("d")).select("d.*")
    return out.unionAll(last)


def dealt(docs: DataFrame) -> DataFrame:
    """Per item (source, doc_id, size): its rows, certain copies, and how many rows get one more."""
    items = sizes(docs)
    shares = written(targets(items), "targets")
    joined = items.join(shares.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = joined.withColumn("rate", rate).withColumn("base", F.when(F.col("size") > 0, F.floor("rate")).otherwise(0).cast("int"))
    spread = F.when(F.col("size") > 0, F.col("rows") * (F.col("rate") - F.col("base"))).otherwise(0.0)
    joined = joined.withColumn("spread", spread).withColumn("more", F.floor("spread"))
    joined = written(joined.withColumn("p", F.col("spread") - F.col("more")).drop("spread", "rate"), "rates")

    open_items = joined.filter(F.col("p") > 0)
    counts = written(open_items.groupBy("source").agg(F.count("*").alias("n")), "counts")
    widest = counts.agg(F.max("n")).first()[0] or 0
    h = F.xxhash64(F.lit(SEED), "doc_id", "size")
    leaf = F.pmod(h, F.ceil(F.col("n") / F.lit(FAN)))
    fractions = open_items.join(counts.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "source", leaf.alias("bucket"), h.alias("h"), "item", F.col("size").cast("double").alias("w"), "p"
    )
    extra = rounded(fractions, widest)
    out = joined.join(extra, "item", "left").withColumn("more", F.col("more") + F.coalesce("extra", F.lit(0)))
    return out.select("item", "source", "doc_id", "size", "source_size", "target", "rows", "base", "more")


def mix(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, copies, taken."""
    rows = dealt(docs).withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    copies = F.col("base") + (F.col("nth") <= F.col("more")).cast("int")
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies")).withColumn(
        "taken", F.col("copies") * F.col("size")
    )


def copies_of_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with ``copies``."""
    items = written(dealt(docs).select("source", "doc_id", "size", "rows", "base", "more"), "dealt")
    items = items.filter((F.col("base") > 0) | (F.col("more") > 0)).select(*[F.col(c).alias(f"_{c}") for c in items.columns])
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("source").cast("string").eqNullSafe(F.col("_source"))
    joined = docs.withColumn("_words", size_of(F.col("text"))).join(items, same & (F.col("_words") == F.col("_size")))
    single = joined.filter("_rows = 1").withColumn("copies", (F.col("_base") + F.col("_more")).cast("int"))
    out = single.select(*docs.columns, "copies")
    if not items.filter("_rows > 1").isEmpty():
        nth = F.row_number().over(Window.partitionBy("_doc_id", "_source", "_size").orderBy(F.xxhash64("text")))
        several = joined.filter("_rows > 1").withColumn("copies", (F.col("_base") + (nth <= F.col("_more")).cast("int")).cast("int"))
        out = out.unionByName(several.select(*docs.columns, "copies"))
    return out.filter("copies > 0")
