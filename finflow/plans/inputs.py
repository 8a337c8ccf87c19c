"""Transaction views over the given tables, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finflow.plans.registry import Tables


def steady(value: str | Column) -> Column:
    """``round(value + 1e-6, 4)``: the average of 8 amounts in cents can end in a 5
    at the fifth decimal, and the nudge keeps the last bit from deciding which way it goes."""
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value + F.lit(1e-6), 4)


def transactions(t: Tables) -> DataFrame:
    """Orders as bank transactions: a customer is an account."""
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").cast("string").alias("account_number"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("description"),
    )


TRANSACTIONS = """
    select o_orderkey as id, o_custkey::varchar as account_number, o_orderdate::date as date,
           o_totalprice as amount, o_orderpriority as description
    from orders"""


def gappy(t: Tables) -> DataFrame:
    """Transactions with gaps: some amounts, descriptions and accounts are null, some amounts 0."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(status != "P", F.col("o_custkey")).alias("account"),
        F.when(priority == "1-URGENT", F.lit(0.0))
        .when(priority != "2-HIGH", F.col("o_totalprice"))
        .alias("amount"),
        F.when(priority != "5-LOW", priority).alias("description"),
        F.when(status != "P", status).alias("status"),
    )


GAPPY = """
    select o_orderkey as id,
           case when o_orderstatus <> 'P' then o_custkey end as account,
           case when o_orderpriority = '1-URGENT' then 0.0::double
                when o_orderpriority <> '2-HIGH' then o_totalprice end as amount,
           nullif(o_orderpriority, '5-LOW') as description,
           nullif(o_orderstatus, 'P') as status
    from orders"""


def raw_finances(t: Tables) -> DataFrame:
    """Transactions with a nested account and a US date, some parts missing."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    keep = ~((status == "P") & (priority == "3-MEDIUM"))
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.when(keep, F.col("o_orderkey")).alias("id"),
        F.struct(
            F.when(keep, F.col("c_custkey").cast("string")).alias("number"),
            F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"),
        ).alias("account"),
        F.when(keep & (priority == "1-URGENT"), F.lit(0.0))
        .when(keep & (priority != "2-HIGH"), F.col("o_totalprice"))
        .alias("amount"),
        F.when(keep & (priority != "5-LOW") & (status != "O"), priority).alias("description"),
        F.when(keep, F.date_format("o_orderdate", "MM/dd/yyyy")).alias("date"),
    )


RAW_FINANCES = """
    select case when keep then o_orderkey end as id,
           case when keep then c_custkey::varchar end as account_number,
           case when keep and o_orderpriority = '1-URGENT' then 0.0::double
                when keep and o_orderpriority <> '2-HIGH' then o_totalprice end as amount,
           case when keep and o_orderpriority <> '5-LOW' and o_orderstatus <> 'O'
                then o_orderpriority end as description,
           case when keep then strftime(o_orderdate, '%m/%d/%Y') end as date
    from (select *, not (o_orderstatus = 'P' and o_orderpriority = '3-MEDIUM') as keep
          from orders join customer on o_custkey = c_custkey)"""


def transaction_lines(t: Tables) -> DataFrame:
    """Transactions as text lines; four priorities by status carry a defect each."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    number = F.col("o_orderkey").cast("string")
    day = F.date_format("o_orderdate", "MM/dd/yyyy")
    account = F.col("o_custkey").cast("string")
    amount = F.format_string("%.2f", "o_totalprice")
    broken = status == "P"
    return t.orders.select(
        F.when(broken & (priority == "1-URGENT"), F.concat_ws(",", number, day, account, amount))
        .when(
            broken & (priority == "2-HIGH"),
            F.concat_ws(",", F.concat(F.lit(" "), number), day, account, amount, priority),
        )
        .when(
            broken & (priority == "3-MEDIUM"),
            F.concat_ws(",", number, F.lit("someday"), account, amount, priority),
        )
        .when(
            broken & (priority == "4-NOT SPECIFIED"),
            F.concat_ws(",", number, day, account, F.lit("much"), priority),
        )
        .when(
            broken & (priority == "5-LOW"),
            F.concat_ws(",", number, day, account, amount, priority, F.lit("more")),
        )
        .otherwise(F.concat_ws(",", number, day, account, amount, priority))
        .alias("value")
    )


LINES = """
    select *, case
        when o_orderstatus = 'P' and o_orderpriority = '1-URGENT' then n||','||d||','||a||','||m
        when o_orderstatus = 'P' and o_orderpriority = '2-HIGH'
            then ' '||n||','||d||','||a||','||m||','||o_orderpriority
        when o_orderstatus = 'P' and o_orderpriority = '3-MEDIUM'
            then n||',someday,'||a||','||m||','||o_orderpriority
        when o_orderstatus = 'P' and o_orderpriority = '4-NOT SPECIFIED'
            then n||','||d||','||a||',much,'||o_orderpriority
        when o_orderstatus = 'P' and o_orderpriority = '5-LOW'
            then n||','||d||','||a||','||m||','||o_orderpriority||',more'
        else n||','||d||','||a||','||m||','||o_orderpriority end as line
    from (select *, o_orderkey::varchar as n, strftime(o_orderdate, '%m/%d/%Y') as d,
                 o_custkey::varchar as a, printf('%.2f', o_totalprice) as m
          from orders)"""
