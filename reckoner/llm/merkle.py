"""Merkle manifest of a table: a digest for every row, a root for all, a proof for each.

A row's leaf is the digest of its fields, each as its length and value. The
leaves of a language stand in the order of their ids. While there are several
nodes, every ``FAN`` consecutive ones become the digest of their digests; what
remains is the language's subroot. Subroots, in the order of languages, become
the root in the same way.

* **Ranks.** Rows are dealt by ranges of language, id and leaf. A row's rank is
  its place in its range plus the rows of its language in earlier ranges, so a
  language of any size is ranked by many tasks.
* **Nested-struct rollup.** A rank is a block number and ``LEVELS`` digits of
  base ``FAN``. The digit columns are grouped away one after the other, from the
  last on: each grouping nests the structs of a run in the struct of its parent.
  All groupings of a block follow one exchange. A block holds at most
  ``FAN ** LEVELS`` nodes whatever the table's size; only its digest goes on, as a
  node of the next round, until one block is left.
* **Proofs.** From the top round down, a nested transform walks a block and
  gives each of its nodes the siblings left and right of it on every level, and
  an explode emits the nodes. What is known above a block meets it by one more
  grouping of its key. There are no joins but that of a range's earlier rows.

Cases: NULL fields are ``-``; languages that are NULL are one language, the
first; NULL ids come last; rows of one id stand in the order of their leaves, and
repeated rows are leaves of their own. Ids that are NULL are not tampered with. An
only leaf is its subroot, and an only subroot the root, with an empty proof. An
empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reckoner.llm.shared import written

FAN = 8
LEVELS = 3
BLOCK = FAN**LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(**fields: Column) -> Column:
    return digest(F.concat(*[field(fields.get(name, F.col(name))) for name in FIELDS]))


def lower_ascii(text: Column) -> Column:
    return F.translate(text.cast("string"), string.ascii_uppercase, string.ascii_lowercase)


def key_of(lang: Column) -> Column:
    """A key that is never NULL and sorts as the languages, NULL first."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with their ``rank`` from 0 on in their ``key``, and its ``size``. ``order`` must not leave ties of unlike rows."""
    dealt = rows.repartitionByRange("key", *order).withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    parts = dealt.groupBy("key", "part").agg(F.count("*").alias("n"))
    of_key = Window.partitionBy("key")
    earlier = of_key.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "key", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"), F.sum("n").over(of_key).alias("size")
    )
    placed = dealt.withColumn("place", F.row_number().over(Window.partitionBy("key", "part").orderBy(*order)) - 1)
    return placed.join(parts, ["key", "part"]).withColumn("rank", F.col("place") + F.col("earlier")).drop("part", "place", "earlier")


def rolled_up(nodes: DataFrame) -> DataFrame:
    """``key``, ``size``, ``block`` and its nested ``node``. ``nodes``: key, rank, size, hash, payload."""
    digits = [f"digit_{level}" for level in range(LEVELS)]
    table = nodes.select(
        "key", "size", F.expr(f"rank div {BLOCK}").alias("block"),
        *[F.expr(f"cast(rank div {FAN**level} % {FAN} as int)").alias(name) for level, name in enumerate(digits)],
        F.struct("hash", "payload").alias("node"),
    ).repartition("key", "block")
    for level, name in enumerate(digits):
        rest = ["key", "size", "block", *digits[level + 1 :]]
        runs = table.groupBy(rest).agg(F.sort_array(F.collect_list(F.struct(F.col(name).alias("digit"), "node"))).alias("run"))
        together = hashes_of(F.col("run"))
        # A key of fewer levels ends below: its only node is passed on.
        hashed = F.when(F.col("size") > FAN**level, digest(together)).otherwise(together)
        table = runs.select(*rest, F.struct(hashed.alias("hash"), F.col("run").alias("run")).alias("node"))
    return table


def hashes_of(run: Column) -> Column:
    return F.concat_ws("", F.transform(run, lambda c: c["node"]["hash"]))


def walked(node: Column, size: Column, level: int) -> Column:
    """All lowest nodes below ``node``: payload, place in the block, and the siblings level by level."""
    siblings = "array<struct<left:string,right:string>>"
    if level == 0:
        return F.array(F.struct(node["payload"].alias("payload"), F.lit(0).alias("place"), F.array().cast(siblings).alias("path")))

    def child(c: Column, i: Column) -> Column:
        left, right = F.slice(node["run"], F.lit(1), i), F.slice(node["run"], i + 2, F.lit(FAN))
        own = F.array(F.struct(hashes_of(left).alias("left"), hashes_of(right).alias("right")))
        step = F.when(size > FAN ** (level - 1), own).otherwise(F.array().cast(siblings))
        return F.transform(
            walked(c["node"], size, level - 1),
            lambda p: F.struct(
                p["payload"].alias("payload"),
                (p["place"] + i * F.lit(FAN ** (level - 1))).alias("place"),
                F.concat(p["path"], step).alias("path"),
            ),
        )

    return F.flatten(F.transform(node["run"], child))


def rounds_of(nodes: DataFrame, name: str) -> list[DataFrame]:
    """The blocks of each round, lowest first; the last has one block a key."""
    rounds = []
    while True:
        blocks = written(rolled_up(nodes), name)
        rounds.append(blocks)
        if (blocks.agg(F.max("size")).first()[0] or 0) <= BLOCK:
            return rounds
        nodes = blocks.select(
            "key", F.col("block").alias("rank"), F.expr(f"(size + {BLOCK - 1}) div {BLOCK}").alias("size"),
            F.col("node.hash").alias("hash"), F.lit(None).cast("int").alias("payload"),
        )


def emitted(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Every lowest node: key, payload, subroot, root, path. ``above``: key, block, subroot, root, path of the top blocks."""
    for blocks in reversed(rounds):
        kind = blocks.schema["node"].dataType
        both = blocks.select("key", "block", "size", "node", *[F.lit(None).cast(above.schema[c].dataType).alias(c) for c in ("subroot", "root", "path")])
        known = above.select("key", "block", F.lit(None).cast("long").alias("size"), F.lit(None).cast(kind).alias("node"), "subroot", "root", "path")
        met = both.unionAll(known).groupBy("key", "block").agg(
            *[F.first(c, ignorenulls=True).alias(c) for c in ("size", "node", "subroot", "root", "path")]
        )
        node = met.select(
            "key", "block", "subroot", "root", "path", F.explode(walked(F.col("node"), F.col("size"), LEVELS)).alias("leaf")
        )
        above = node.select(
            "key", (F.col("block") * BLOCK + F.col("leaf.place")).alias("block"), "subroot", "root",
            F.concat("leaf.path", "path").alias("path"), F.col("leaf.payload").alias("payload"),
        )
    return above


def proofs(leaves: DataFrame) -> DataFrame:
    """Per row of ``leaves`` (key, doc_id, leaf, other columns): all of them with subroot, root and path."""
    payload = F.struct(*[c for c in leaves.columns if c != "key"])
    order = F.col("doc_id").asc_nulls_last(), F.col("leaf").asc()
    nodes = ranked(leaves, *order).select("key", "rank", "size", F.col("leaf").alias("hash"), payload.alias("payload"))
    rounds = rounds_of(nodes, "blocks")

    of_keys = rounds[-1].select(F.lit("").alias("key"), F.col("key").alias("of"), F.col("node.hash").alias("hash"))
    of_keys = ranked(of_keys, F.col("of").asc()).select("key", "rank", "size", "hash", F.struct("of", "hash").alias("payload"))
    upper = rounds_of(of_keys, "subroots")
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    top = upper[-1].select("key", "block", F.lit(None).cast("string").alias("subroot"), F.col("node.hash").alias("root"), no_path.alias("path"))
    of_keys = emitted(upper, top)
    above = of_keys.select(F.col("payload.of").alias("key"), F.lit(0).cast("long").alias("block"), F.col("payload.hash").alias("subroot"), "root", "path")
    return emitted(rounds, above).select("payload.*", "subroot", "root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda below, s: digest(F.concat(s["left"], below, s["right"])))


def proof_digest(path: Column) -> Column:
    return digest(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))))


def manifest(docs: DataFrame, *more: Column) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, subroot, root, path, and the columns ``more`` of the row."""
    leaves = docs.select(key_of(F.col("lang")).alias("key"), "doc_id", leaf_of().alias("leaf"), *more)
    return proofs(written(leaves, "leaves"))


def tampered_leaf(chosen: Column) -> Column:
    """The leaf of a row whose text was lower-cased where ``chosen``."""
    return F.when(chosen, leaf_of(text=lower_ascii(F.col("text")))).otherwise(leaf_of())


def verify(docs: DataFrame) -> DataFrame:
    """The manifest with a fold of every proof, of a changed leaf where 3 divides the id's crc32."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    proved = manifest(docs, tampered_leaf(chosen).alias("tampered"))
    found = proved.withColumn("folded_root", folded(F.col("tampered"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
