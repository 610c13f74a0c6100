"""One report computed from three warehouse models (DV-07): the normalised
OLTP tables, a star schema and a data vault built from the same tables.
The three results must be equal row for row."""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.functions.hashing import hash_key
from oreflow.functions.numeric import round_half_up as rh
from oreflow.operators import vault
from oreflow.operators import warehouse as wh
from oreflow.sources.tables import read

REV = F.col("l_extendedprice") * (1 - F.col("l_discount"))


def revenue_by_nation_three_models(spark, d):
    li, o = read(spark, d, "lineitem"), read(spark, d, "orders")
    c, n = read(spark, d, "customer"), read(spark, d, "nation")

    # 1) OLTP: four joins over the normalised tables
    oltp = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
            .join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .groupBy(F.col("n_name").alias("nation")).agg(rh(F.sum(REV), 2).alias("revenue")))

    # 2) star: denormalised customer dimension (nation folded in) with
    #    surrogate keys; the fact carries the surrogate key only
    dim_c = wh.add_surrogate_keys(
        c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name"),
        None, ["c_custkey"], "customer_sk")
    fact = (li.join(o, li.l_orderkey == o.o_orderkey)
            .join(dim_c.select("c_custkey", "customer_sk"), F.col("o_custkey") == F.col("c_custkey"))
            .select("customer_sk", "l_extendedprice", "l_discount"))
    star = (fact.join(dim_c.select("customer_sk", "n_name"), "customer_sk")
            .groupBy(F.col("n_name").alias("nation")).agg(rh(F.sum(REV), 2).alias("revenue")))

    # 3) vault: link(order line) -> hub customer -> satellite with nation
    ld = F.lit("2024-01-01 00:00:00")
    p = li.join(o, li.l_orderkey == o.o_orderkey)
    link = p.select(hash_key("o_custkey").alias("customer_hk"), "l_extendedprice", "l_discount")
    cn = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")
    sat = vault.current_satellite(vault.satellite_load(
        None, vault.satellite_rows(cn, "c_custkey", "customer_hk", ["n_name"], ld, "crm").drop("c_custkey"),
        "customer_hk"))
    dv = (link.join(sat.select("customer_hk", "n_name"), "customer_hk")
          .groupBy(F.col("n_name").alias("nation")).agg(rh(F.sum(REV), 2).alias("revenue")))

    return (oltp.select(F.lit("oltp").alias("model"), "nation", "revenue")
            .unionByName(star.select(F.lit("star").alias("model"), "nation", "revenue"))
            .unionByName(dv.select(F.lit("vault").alias("model"), "nation", "revenue")))
