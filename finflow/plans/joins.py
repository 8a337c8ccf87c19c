"""Joins of tables (JON)."""

from __future__ import annotations

from pyspark.sql import functions as F

from finflow.operators.joins import (
    band_join, broadcast_join, cogroup, cross_join, outer_join, pair_join,
)
from finflow.operators.skew import Heat
from finflow.plans.explain import join_strategies
from finflow.plans.registry import query
from finflow.sources.readers import local_table

# All customers and all orders; the orders of every third customer go to keys that
# no customer has, so that both sides have rows without a partner.
_BUYER = "case when o_custkey % 3 = 0 then -o_custkey else o_custkey end"


def _people(t):
    return t.customer.select("c_custkey", "c_name")


def _bought(t):
    return t.orders.select(F.expr(_BUYER).alias("c_custkey"), "o_orderkey", "o_totalprice")


_SIDES = f"""
    with people as (select c_custkey, c_name from customer),
         bought as (select {_BUYER} as c_custkey, o_orderkey, o_totalprice from orders)
"""


@query(
    "jon_01_inner_by_expression",
    "select c_custkey, o_custkey, c_name, o_orderkey from customer join orders on c_custkey = o_custkey",
)
def _(t):
    customer, orders = t.customer, t.orders
    return customer.join(orders, customer["c_custkey"] == orders["o_custkey"], "inner").select(
        "c_custkey", "o_custkey", "c_name", "o_orderkey"
    )


@query("jon_02_inner_using_column", _SIDES + "select * from people join bought using (c_custkey)")
def _(t):
    return _people(t).join(_bought(t), "c_custkey")


@query("jon_03_left_outer", _SIDES + "select * from people left join bought using (c_custkey)")
def _(t):
    return outer_join(_people(t), _bought(t), ["c_custkey"], "left")


@query("jon_04_right_outer", _SIDES + "select * from people right join bought using (c_custkey)")
def _(t):
    return outer_join(_people(t), _bought(t), ["c_custkey"], "right")


@query("jon_05_full_outer", _SIDES + "select * from people full join bought using (c_custkey)")
def _(t):
    return outer_join(_people(t), _bought(t), ["c_custkey"], "full")


@query("jon_05_full_outer_hot_keys", _SIDES + "select * from people full join bought using (c_custkey)")
def _(t):
    """The same with a threshold that sends most keys through the path for hot keys."""
    return outer_join(_people(t), _bought(t), ["c_custkey"], "full", Heat(hot_rows=1))


@query("jon_06_left_semi", _SIDES + "select * from people semi join bought using (c_custkey)")
def _(t):
    return _people(t).join(_bought(t), "c_custkey", "left_semi")


@query("jon_07_left_anti", _SIDES + "select * from people anti join bought using (c_custkey)")
def _(t):
    return _people(t).join(_bought(t), "c_custkey", "left_anti")


@query(
    "jon_08_cross_join",
    """select r_name, segment, coalesce(customers, 0) as customers
       from region cross join (select distinct c_mktsegment as segment from customer)
       left join (select n_regionkey as k, c_mktsegment as s, count(*) as customers
                  from customer join nation on c_nationkey = n_nationkey group by 1, 2)
         on k = r_regionkey and s = segment""",
)
def _(t):
    """Customers in every region and segment, empty combinations included."""
    grid = cross_join(t.region, t.customer.select(F.col("c_mktsegment").alias("segment")).distinct())
    counted = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_regionkey").alias("r_regionkey"), F.col("c_mktsegment").alias("segment"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return grid.join(counted, ["r_regionkey", "segment"], "left").select(
        "r_name", "segment", F.coalesce("n", F.lit(0)).alias("customers")
    )


@query(
    "jon_09_theta_join",
    """select o_orderkey, band from orders
       join (values ('low', 0.0, 100000.0), ('mid', 75000.0, 300000.0), ('high', 300000.0, 600000.0))
            v(band, low, high)
         on o_totalprice >= low and o_totalprice < high""",
)
def _(t):
    """Orders with the price bands they fall in; bands overlap."""
    bands = local_table(
        t.spark,
        [("low", 0.0, 100000.0), ("mid", 75000.0, 300000.0), ("high", 300000.0, 600000.0)],
        "band string, low double, high double",
    )
    return band_join(t.orders, bands, "o_totalprice", "low", "high", width=25000.0).select(
        "o_orderkey", "band"
    )


@query(
    "jon_08_cross_join_in_blocks",
    """select p_brand, s_nationkey, count(*) as pairs, sum(p_size * s_suppkey)::bigint as weight
       from part cross join supplier group by p_brand, s_nationkey""",
)
def _(t):
    """Every part with every supplier, both sides cut into blocks as if neither could be broadcast.

    Parts of one brand and size are one row with their number, so the pairs grow with the suppliers alone.
    """
    suppliers = t.supplier.select("s_suppkey", "s_nationkey")
    parts = t.part.groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("parts"))
    pairs = cross_join(parts, suppliers, max_bytes=1000)
    return pairs.groupBy("p_brand", "s_nationkey").agg(
        F.sum("parts").alias("pairs"),
        F.sum(F.col("parts") * F.col("p_size") * F.col("s_suppkey")).alias("weight"),
    )


@query(
    "jon_09_wide_and_open_bands",
    """select nation, count(*) as orders, min(o_totalprice) as least, max(o_totalprice) as most
       from orders join (select c_nationkey as nation, min(c_acctbal) * 50 as low,
                                case c_nationkey % 3 when 0 then 'infinity'::double when 1 then 1e10
                                                     else max(c_acctbal) * 50 end as high
                         from customer group by c_nationkey)
         on o_totalprice >= low and o_totalprice < high
       group by nation""",
)
def _(t):
    """Orders within a price band of each nation: bands of every width, some without an upper end."""
    kind = F.col("nation") % 3
    high = F.when(kind == 0, F.lit(float("inf"))).when(kind == 1, F.lit(1e10)).otherwise(F.col("most") * 50)
    bands = t.customer.groupBy(F.col("c_nationkey").alias("nation")).agg(
        (F.min("c_acctbal") * 50).alias("low"), F.max("c_acctbal").alias("most")
    )
    bands = bands.select("nation", "low", high.alias("high"))
    return band_join(t.orders.select("o_totalprice"), bands, "o_totalprice", "low", "high").groupBy("nation").agg(
        F.count(F.lit(1)).alias("orders"), F.min("o_totalprice").alias("least"), F.max("o_totalprice").alias("most")
    )


@query(
    "jon_10_pair_join",
    "select c_custkey as person_id, c_name as person_name, o_orderkey as role_id, o_orderstatus as role"
    " from customer join orders on c_custkey = o_custkey",
)
def _(t):
    pairs = pair_join(t.customer, t.orders, [("c_custkey", "o_custkey")])
    return pairs.select(
        F.col("_1.c_custkey").alias("person_id"),
        F.col("_1.c_name").alias("person_name"),
        F.col("_2.o_orderkey").alias("role_id"),
        F.col("_2.o_orderstatus").alias("role"),
    )


@query(
    "jon_11_outer_pair_join",
    _SIDES + """select l.c_custkey as left_id, c_name, r.c_custkey as right_id, o_orderkey,
                       r.c_custkey is null as no_partner
                from people l left join bought r on l.c_custkey = r.c_custkey""",
)
def _(t):
    pairs = pair_join(_people(t), _bought(t), [("c_custkey", "c_custkey")], "left")
    return pairs.select(
        F.col("_1.c_custkey").alias("left_id"),
        F.col("_1.c_name").alias("c_name"),
        F.col("_2.c_custkey").alias("right_id"),
        F.col("_2.o_orderkey").alias("o_orderkey"),
        F.col("_2").isNull().alias("no_partner"),
    )


@query(
    "jon_12_broadcast_join",
    """select n_name, r_name, count(*) as orders, round(sum(o_totalprice), 2) as total
       from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
       join region on n_regionkey = r_regionkey group by n_name, r_name""",
)
def _(t):
    """Order totals by nation and region: large facts, shipped dimensions."""
    dimension = broadcast_join(
        t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), t.region, ["r_regionkey"]
    ).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    facts = t.orders.select("o_custkey", "o_totalprice")
    located = broadcast_join(facts, customers, ["o_custkey"])
    return (
        broadcast_join(located, dimension, ["c_nationkey"])
        .groupBy("n_name", "r_name")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.round(F.sum("o_totalprice"), 2).alias("total"),
        )
    )


@query(
    "pln_01_join_strategy",
    "select 'BroadcastHashJoin' as strategy, count(*) as n from customer join nation on c_nationkey = n_nationkey",
)
def _(t):
    """What the plan of a broadcast join says it does, beside its number of rows."""
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    joined = broadcast_join(t.customer, nations, ["c_nationkey"])
    return joined.agg(
        F.lit(",".join(join_strategies(joined))).alias("strategy"), F.count(F.lit(1)).alias("n")
    )


@query(
    "jon_13_cogroup",
    """with f as (select o_custkey, count(*) as n, round(sum(o_totalprice), 2) as s,
                         string_agg(distinct o_orderpriority, '|' order by o_orderpriority) as p
                  from orders where o_orderstatus = 'F' group by 1),
            o as (select o_custkey, count(*) as n, round(sum(o_totalprice), 2) as s
                  from orders where o_orderstatus = 'O' group by 1)
       select o_custkey, coalesce(f.n, 0) as finished, coalesce(o.n, 0) as open_orders,
              coalesce(f.s, 0.0) + coalesce(o.s, 0.0) as both_total, p as priorities
       from f full join o using (o_custkey)""",
)
def _(t):
    finished = t.orders.where("o_orderstatus = 'F'")
    open_ = t.orders.where("o_orderstatus = 'O'")
    return cogroup(
        finished,
        open_,
        ["o_custkey"],
        {
            "_n1": F.count(F.lit(1)),
            "_s1": F.round(F.sum("o_totalprice"), 2),
            "_p1": F.array_join(F.sort_array(F.collect_set("o_orderpriority")), "|"),
        },
        {"_n2": F.count(F.lit(1)), "_s2": F.round(F.sum("o_totalprice"), 2)},
        {
            "finished": F.coalesce("_n1", F.lit(0)),
            "open_orders": F.coalesce("_n2", F.lit(0)),
            "both_total": F.coalesce("_s1", F.lit(0.0)) + F.coalesce("_s2", F.lit(0.0)),
            "priorities": F.col("_p1"),
        },
    )
