"""Addresses and the networks of a list that hold them, IPv4 and IPv6.

A network is a prefix of an address. A list has few prefix lengths (33 and 129 are all there
are), so that an address meets it by equality of its prefixes of just these lengths, and
no range is ever searched. Addresses are made distinct before that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from watchfold.functions.net import address_digits, masked_digits


def _family(digits: Column) -> Column:
    return F.when(F.length(digits) == 8, 4).when(F.length(digits) == 32, 6)


def parse_networks(networks: DataFrame, column: str = "network") -> DataFrame:
    """``networks`` with ``family`` (4, 6), ``bits`` and ``prefix`` of each.

    A single address is a network of its own. Bits behind the prefix do not count. Texts that
    are no network, and lengths that an address does not have, get NULL.
    """
    address, length = F.split_part(column, F.lit("/"), F.lit(1)), F.split_part(column, F.lit("/"), F.lit(2))
    digits = address_digits(address)
    most = F.length(digits) * 4
    whole = ~F.contains(F.col(column), F.lit("/"))
    bits = F.when(whole, most).when(length.rlike("^[0-9]{1,3}$"), length.cast("int"))
    known = digits.isNotNull() & (bits <= most)
    parts = F.struct(digits.alias("digits"), F.when(known, _family(digits)).alias("family"), F.when(known, bits).alias("bits"))
    staged = networks.select("*", F.inline(F.array(parts)))
    prefix = F.when(F.col("family").isNotNull(), masked_digits(F.col("digits"), F.col("bits")))
    return staged.withColumn("prefix", prefix).drop("digits")


def match_networks(ips: DataFrame, networks: DataFrame, column: str = "ip_address") -> DataFrame:
    """The most specific network of each address: ``column``, ``network`` and the other
    columns of ``networks``; addresses that lie in none are left out.

    Of networks that are equal the one with the smallest text and columns counts.
    """
    others = [c for c in networks.columns if c != "network"]
    known = parse_networks(networks.select("network", F.struct("network", *others).alias("_row")))
    known = known.filter("family is not null").groupBy("family", "bits", "prefix").agg(F.min("_row").alias("_row"))
    lengths = known.select("family", "bits").distinct().collect()  # 162 rows at most
    by_family = {f: sorted(r["bits"] for r in lengths if r["family"] == f) for f in (4, 6)}
    tried = [F.array(*[F.lit(b) for b in by_family[f]]).cast("array<int>") for f in (4, 6)]
    digits = F.col("_digits")
    seen = ips.select(column).distinct().withColumn("_digits", address_digits(F.col(column))).filter(digits.isNotNull())
    seen = seen.withColumn("family", _family(digits))
    seen = seen.withColumn("bits", F.explode(F.when(F.col("family") == 4, tried[0]).otherwise(tried[1])))
    seen = seen.withColumn("prefix", masked_digits(digits, F.col("bits")))
    met = seen.join(known, ["family", "bits", "prefix"])
    best = met.groupBy(column).agg(F.max_by("_row", "bits").alias("_row"))
    return best.select(column, "_row.*")


def deny_networks(df: DataFrame, networks: DataFrame, column: str = "ip_address") -> DataFrame:
    """Rows whose address lies in a network of the list."""
    return df.join(match_networks(df, networks.select("network"), column).select(column), column, "left_semi")


def allow_networks(df: DataFrame, networks: DataFrame, column: str = "ip_address") -> DataFrame:
    """Rows whose address lies in no network of the list."""
    return df.join(match_networks(df, networks.select("network"), column).select(column), column, "left_anti")


def with_network(df: DataFrame, networks: DataFrame, column: str = "ip_address") -> DataFrame:
    """Rows with the most specific network of their address and its columns, NULL if none."""
    return df.join(match_networks(df, networks, column), column, "left")
