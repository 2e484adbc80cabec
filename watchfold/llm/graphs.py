"""Connected components of a link table, and tables kept in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchfold.session import scratch_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the cluster's shared folder and read from there.

    Lost executors then cost no more than the work since the last such table.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (a, b): the smallest node it reaches.

    Labels go to the neighbours and then jump to the label of their label until nothing
    changes, so that chains take a logarithmic number of rounds. A star's centre is one
    key of the joins and takes part in map-side minima; no group is ever gathered.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        better = labels.join(near.agg(F.min("component").alias("near")), "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        # the label of the label: a root's label is itself
        root = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        jumped = better.join(root, "component", "left").select(
            "node", "old", F.least("component", F.coalesce("up", "component")).alias("component")
        )
        jumped = stored(jumped, "labels")
        changed = not jumped.filter("old <> component").isEmpty()
        labels = jumped.select("node", "component")
        if not changed:
            return labels


def fresh(columns: list[str], name: str) -> str:
    """A column name that is not among ``columns``, in any case of letters."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def marked(bits: Column, at: Column) -> Column:
    """Whether bit ``at`` of a bitmap of ``bitmap_construct_agg`` is set; not, where there is none."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2.0), F.pmod(at, F.lit(8)))), F.lit(2)) == 1, F.lit(False))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of ``counts`` (n) with the largest n, at most ``most`` of them.

    Rows are let in by levels of n that are four percent apart, so that nothing is sorted.
    """
    level = F.floor(F.log2("n") * 16)
    sizes = sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True)
    least, rows = None, 0
    for number, size in sizes:
        rows += size
        if rows > most:
            break
        least = number
    return counts.filter(F.lit(False) if least is None else level >= least)
