"""Aggregations (AGG)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from finflow.operators.aggregates import (
    collect_lists, drop_duplicates_by, first_and_last, flat_map_groups, group_count, group_keys,
    map_groups, reduce_groups,
)
from finflow.plans.inputs import GAPPY, TRANSACTIONS, gappy, steady, transactions
from finflow.plans.registry import query


@query(
    "agg_01_group_multi",
    """select o_orderstatus, o_orderpriority, count(*) as n, round(sum(o_totalprice), 2) as total,
              min(o_orderdate) as first_date, max(o_orderdate) as last_date
       from orders group by o_orderstatus, o_orderpriority""",
)
def _(t):
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.min("o_orderdate").alias("first_date"),
        F.max("o_orderdate").alias("last_date"),
    )


@query(
    "agg_02_avg_min_max_sum",
    """select account, round(avg(amount) + 1e-6, 4) as average, min(amount) as least, max(amount) as most,
              round(sum(amount), 2) as total from (""" + GAPPY + ") group by account",
)
def _(t):
    return gappy(t).groupBy("account").agg(
        steady(F.avg("amount")).alias("average"),
        F.min("amount").alias("least"),
        F.max("amount").alias("most"),
        F.round(F.sum("amount"), 2).alias("total"),
    )


@query(
    "agg_03_sum_distinct",
    "select l_returnflag, sum(distinct l_quantity) as quantities, sum(distinct l_linenumber)::bigint as numbers"
    " from lineitem group by l_returnflag",
)
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.sum_distinct("l_quantity").alias("quantities"),
        F.sum_distinct("l_linenumber").alias("numbers"),
    )


@query(
    "agg_04_count_and_count_distinct",
    "select status, count(amount) as amounts, count(distinct account) as accounts from (" + GAPPY + ") group by status",
)
def _(t):
    return gappy(t).groupBy("status").agg(
        F.count("amount").alias("amounts"), F.count_distinct("account").alias("accounts")
    )


@query(
    "agg_05_stddev",
    """select l_returnflag, round(stddev_samp(l_quantity), 6) as sample, round(stddev_pop(l_quantity), 6) as population
       from lineitem group by l_returnflag""",
)
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.stddev_samp("l_quantity"), 6).alias("sample"),
        F.round(F.stddev_pop("l_quantity"), 6).alias("population"),
    )


@query(
    "agg_06_collect_set",
    """select o_custkey, string_agg(distinct o_orderpriority, '|' order by o_orderpriority) as priorities
       from orders group by o_custkey""",
)
def _(t):
    """The set is bounded by the number of priorities, however many orders a customer has."""
    return t.orders.groupBy("o_custkey").agg(
        F.array_join(F.sort_array(F.collect_set("o_orderpriority")), "|").alias("priorities")
    )


_LISTS = """
    select o_custkey, chunk, string_agg(o_orderkey::varchar, ',' order by o_orderdate, o_orderkey) as order_keys
    from (select *, ((row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1)
                     // {rows})::integer as chunk from orders)
    group by o_custkey, chunk"""


def _order_lists(t, **limits):
    lists = collect_lists(
        t.orders.select("o_custkey", "o_orderdate", "o_orderkey"),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        "o_orderkey",
        "keys",
        **limits,
    )
    return lists.select(
        "o_custkey", "chunk", F.array_join(F.col("keys").cast("array<string>"), ",").alias("order_keys")
    )


@query("agg_06_collect_list", _LISTS.format(rows=100000))
def _(t):
    """Whole lists; one longer than a hundred thousand values would continue in a further row."""
    return _order_lists(t, chunk_rows=100_000)


@query("agg_06_collect_list_chunked", _LISTS.format(rows=4))
def _(t):
    """Lists longer than four values continue in further rows, so most keys go in ranges."""
    return _order_lists(t, chunk_rows=4, range_rows=1000)


@query(
    "agg_07_first_last",
    """select account, arg_min(description, id) as first_known, arg_max(description, id) as last_known
       from (""" + GAPPY + """) group by account""",
)
def _(t):
    """First and last description that is not null, in order of id."""
    return first_and_last(gappy(t), ["account"], F.col("id"), known=F.col("description"))


@query("agg_08_distinct", "select distinct o_custkey, o_orderstatus from orders")
def _(t):
    return t.orders.select("o_custkey", "o_orderstatus").distinct()


@query("agg_09_drop_duplicates", "select distinct o_orderstatus, o_orderpriority from orders")
def _(t):
    return t.orders.select("o_orderstatus", "o_orderpriority").dropDuplicates()


@query(
    "agg_09_drop_duplicates_by_key",
    """select o_custkey, o_orderstatus, o_orderkey, o_totalprice from orders
       qualify row_number() over (partition by o_custkey, o_orderstatus order by o_orderdate, o_orderkey) = 1""",
)
def _(t):
    rows = t.orders.select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderkey", "o_totalprice")
    return drop_duplicates_by(
        rows, ["o_custkey", "o_orderstatus"], F.struct("o_orderdate", "o_orderkey")
    ).drop("o_orderdate")


@query(
    "agg_10_profile_by_key",
    """select account_number, round(avg(amount) + 1e-6, 4) as average_transaction,
              round(sum(amount), 2) as total_transaction, sum(id)::bigint as sum_of_ids,
              count(amount) as num_transactions, max(amount) as max_transaction
       from (""" + TRANSACTIONS + ") group by account_number",
)
def _(t):
    return transactions(t).groupBy("account_number").agg(
        steady(F.avg("amount")).alias("average_transaction"),
        F.round(F.sum("amount"), 2).alias("total_transaction"),
        F.sum("id").alias("sum_of_ids"),
        F.count("amount").alias("num_transactions"),
        F.max("amount").alias("max_transaction"),
    )


@query(
    "agg_11_max_cast",
    "select o_custkey, max(o_totalprice)::double as max_transaction, max(o_orderkey)::double as max_key"
    " from orders group by o_custkey",
)
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        F.max("o_totalprice").cast("double").alias("max_transaction"),
        F.max("o_orderkey").cast("double").alias("max_key"),
    )


@query("agg_12_group_keys", "select distinct o_custkey from orders")
def _(t):
    return group_keys(t.orders, "o_custkey")


@query("agg_12_group_count", "select o_custkey, count(*) as count from orders group by o_custkey")
def _(t):
    return group_count(t.orders, "o_custkey")


@query(
    "agg_13_key_retyped",
    "select o_custkey::varchar as key, count(*) as n from orders group by o_custkey",
)
def _(t):
    return t.orders.groupBy(F.col("o_custkey").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "agg_14_map_groups",
    """select o_custkey, round(sum(o_totalprice), 2) as total,
              round(max(o_totalprice) - min(o_totalprice), 2) as spread
       from orders group by o_custkey""",
)
def _(t):
    return map_groups(
        t.orders,
        ["o_custkey"],
        total=F.round(F.sum("o_totalprice"), 2),
        spread=F.round(F.max("o_totalprice") - F.min("o_totalprice"), 2),
    )


@query(
    "agg_15_flat_map_groups",
    """select o_custkey, o_orderkey from orders
       join (select o_custkey, max(o_totalprice) as m, count(*) as n from orders group by 1) using (o_custkey)
       where o_totalprice > 0.8 * m and n > 5""",
)
def _(t):
    """Orders close to the dearest one of their customer; customers of few orders give none."""
    close = (F.col("o_totalprice") > 0.8 * F.col("_max")) & (F.col("_n") > 5)
    return flat_map_groups(
        t.orders.select("o_custkey", "o_orderkey", "o_totalprice"),
        ["o_custkey"],
        {"_max": F.max("o_totalprice"), "_n": F.count(F.lit(1))},
        F.when(close, F.array("o_orderkey")),
        "o_orderkey",
    )


def _keep_dearest(rows: pd.DataFrame) -> pd.DataFrame:
    ordered = rows.sort_values(["o_totalprice", "o_orderkey"], ascending=[False, True])
    return ordered.drop_duplicates("o_custkey")


@query(
    "agg_16_reduce_groups",
    """select o_custkey, o_orderkey, o_totalprice from orders
       qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) = 1""",
)
def _(t):
    """The dearest order of each customer, by a Python function of two-way choice."""
    return reduce_groups(
        t.orders.select("o_custkey", "o_orderkey", "o_totalprice"),
        ["o_custkey"],
        _keep_dearest,
        "o_custkey bigint, o_orderkey bigint, o_totalprice double",
    )


@query(
    "agg_17_map_values",
    "select o_custkey, round(sum(round(o_totalprice / 1000, 0)), 0) as thousands from orders group by o_custkey",
)
def _(t):
    return (
        t.orders.withColumn("o_totalprice", F.round(F.col("o_totalprice") / 1000, 0))
        .groupBy("o_custkey")
        .agg(F.round(F.sum("o_totalprice"), 0).alias("thousands"))
    )


@query("agg_18_count", "select count(*) as n from lineitem")
def _(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"))


@query("agg_18_count_by_value", "select event_type as value, count(*) as count from events group by event_type")
def _(t):
    return group_count(t.events.select(F.col("event_type").alias("value")), "value")


@query(
    "agg_19_whole_table_reduce",
    "select round(sum(value), 2) as total, max(value) as greatest, min(ts) as earliest from events",
)
def _(t):
    return t.events.agg(
        F.round(F.sum("value"), 2).alias("total"),
        F.max("value").alias("greatest"),
        F.min("ts").alias("earliest"),
    )
