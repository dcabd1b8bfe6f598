"""Spark helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.session import written_once

#: Bits of the id filter of ``only_ids``: one bigint holds 64 of them, so at most 1 MB.
FILTER_BITS = 1 << 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def third(doc_id: Column) -> Column:
    """The fold of a document: crc32 of its id as text, modulo 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(third(doc_id) == 1, F.lit(False))


def sampled(df: DataFrame, key: Column, rows: int, seed: int = 7) -> DataFrame:
    """The ``rows`` rows with the smallest hashes of their key: a fixed sample of bounded size."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(rows)


def only_ids(df: DataFrame, key: Column, ids: DataFrame, id_name: str) -> DataFrame:
    """Rows of ``df`` whose key may be among ``ids``, found without a shuffle of ``df``. A null key has none.

    A bitmap of fixed size (at most ``FILTER_BITS`` bits, so it can be broadcast whatever
    the size of ``ids``) lets all rows with these ids pass, and some others. It only saves
    moving rows: the join that follows decides.
    """
    return split_by_ids(df, key, ids, id_name)[0]


def split_by_ids(df: DataFrame, key: Column, ids: DataFrame, id_name: str) -> tuple[DataFrame, DataFrame]:
    """The rows that may have one of the ids (see ``only_ids``), and those that surely have none."""
    bit = F.pmod(F.xxhash64(F.col(id_name)), F.lit(FILTER_BITS))
    bits = (
        ids.select(bit.alias("_bit"))
        .groupBy(F.expr("_bit div 64").alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(_bit % 64 as int))")).alias("_bits"))
    )
    names = df.columns
    own = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)).alias("_at"))
    met = own.join(F.broadcast(bits), F.expr("_at div 64 = _word"), "left")
    hit = F.coalesce(F.expr("(shiftright(_bits, cast(_at % 64 as int)) & 1L) = 1L"), F.lit(False))
    rows = lambda which: met.where(which).select(*[F.col("_row").getField(c).alias(c) for c in names])
    return rows(hit), rows(~hit)


def components(links: DataFrame) -> DataFrame:
    """Connected components of links ``(a, b)`` between bigint nodes: ``(node, root)``.

    The root is the smallest node of the component. Each round lets every node point to its
    smallest neighbour, follows the pointers to their ends, and contracts the links; it ends
    when no link between different nodes is left, after a number of rounds of about the
    logarithm of the longest chain. Every round is written to the shared folder. Only
    minima are grouped, and all joins meet two written tables, so a node with very many
    links is combined before the shuffle and split by adaptive execution.
    """
    edges = written_once(links.select("a", "b").where("a <> b"), "links")
    labels = None
    while True:
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        point = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root"))
        point = written_once(point, "pointers")
        while True:
            upper = point.select(F.col("node").alias("root"), F.col("root").alias("top"))
            point = written_once(point.join(upper, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")), "pointers")
            done = point.where("moved").isEmpty()
            point = point.select("node", "root")
            if done:
                break
        if labels is None:
            labels = point
        else:
            upper = point.select(F.col("node").alias("root"), F.col("root").alias("top"))
            labels = written_once(labels.join(upper, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "labels")
        a = point.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = point.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = edges.join(a, "a").join(b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct()
        edges = written_once(edges, "links")
        if edges.isEmpty():
            return labels
