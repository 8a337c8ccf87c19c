"""Transaction parsing, profiles and fraud marks on tables (TXN)."""

from __future__ import annotations

from pyspark.sql import functions as F

from finflow.operators.clean import clean_finances
from finflow.operators.transactions import (
    account_profile, is_red_flag, malformed, mark_possible_fraud, merge_state, parse_lines,
    safe_average, valid,
)
from finflow.plans.inputs import (
    LINES, RAW_FINANCES, TRANSACTIONS, raw_finances, steady, transaction_lines, transactions,
)
from finflow.plans.registry import query

_VALID = """
    select o_orderkey as id, a as account_number, o_orderdate::date::varchar as date, o_totalprice as amount,
           o_orderpriority as description
    from (""" + LINES + ") where o_orderstatus <> 'P'"

_ERRORS = """
    select line, case o_orderpriority when '2-HIGH' then 'bad_id' when '3-MEDIUM' then 'bad_date'
                      when '4-NOT SPECIFIED' then 'bad_amount' else 'field_count' end as error
    from (""" + LINES + ") where o_orderstatus = 'P'"


@query(
    "txn_01_parse_lines",
    "select line, null::varchar as error, id, account_number, date, amount, description from ("
    + _VALID.replace("select o_orderkey", "select line, o_orderkey") + ") union all select line, error,"
    " null, null, null, null, null from (" + _ERRORS + ")",
)
def _(t):
    return parse_lines(transaction_lines(t)).withColumn("date", F.col("date").cast("string"))


@query("txn_02_valid_rows", _VALID)
def _(t):
    rows = valid(parse_lines(transaction_lines(t), strict=True))
    return rows.withColumn("date", F.col("date").cast("string"))


@query("txn_03_malformed_rows", _ERRORS)
def _(t):
    return malformed(parse_lines(transaction_lines(t)))


@query(
    "txn_04_clean_finances",
    "select id, account_number, amount, coalesce(description, 'Unknown') as description, date from ("
    + RAW_FINANCES + ") where (id is not null or account_number is not null or amount is not null"
    " or description is not null or date is not null) and (amount <> 0 or coalesce(description, 'Unknown') = 'Unknown')",
)
def _(t):
    cleaned = clean_finances(raw_finances(t))
    return cleaned.select(
        "id", F.col("account.number").alias("account_number"), "amount", "description", "date"
    )


_PROFILE = """
    select account_number, round(avg(amount) + 1e-6, 4) as average_transaction,
           round(sum(amount), 2) as total_transaction, count(amount) as num_transactions,
           max(amount) as max_transaction
    from (""" + TRANSACTIONS + ") group by account_number"


@query("txn_05_account_profile", _PROFILE)
def _(t):
    return account_profile(transactions(t)).select(
        "account_number",
        steady("average_transaction").alias("average_transaction"),
        F.round("total_transaction", 2).alias("total_transaction"),
        "num_transactions",
        "max_transaction",
    )


@query(
    "txn_06_key_by_account",
    "select account_number, count(*) as n, min(id) as first_id from (" + TRANSACTIONS + ") group by account_number",
)
def _(t):
    keyed = transactions(t).select("account_number", F.struct("id", "date", "amount").alias("tx"))
    return keyed.groupBy("account_number").agg(
        F.count("tx").alias("n"), F.min("tx.id").alias("first_id")
    )


def _window_totals(t, condition):
    return (
        transactions(t).where(condition)
        .groupBy("account_number")
        .agg(F.round(F.sum("amount"), 2).alias("total_spending"), F.count("amount").alias("num_tx"))
    )


_MERGED = f"""
    with o as (select account_number, round(sum(amount), 2) as s, count(*) as n from ({TRANSACTIONS})
               where date < '2001-03-01' group by 1),
         w as (select account_number, round(sum(amount), 2) as s, count(*) as n from ({TRANSACTIONS})
               where date >= '2001-03-01' group by 1)
    select account_number, coalesce(o.s, 0) + coalesce(w.s, 0) as total_spending,
           coalesce(o.n, 0) + coalesce(w.n, 0) as num_tx,
           case when w.n > 0 then w.s / w.n else 0.0::double end as window_avg
    from o full join w using (account_number)"""


def _merged(t):
    return merge_state(
        _window_totals(t, "date < '2001-03-01'"), _window_totals(t, "date >= '2001-03-01'")
    )


@query("txn_07_merge_state", _MERGED)
def _(t):
    return _merged(t)


@query(
    "txn_08_guarded_average",
    f"""select c_custkey, case when n > 0 then s / n else 0.0::double end as average_tx
        from (select c_custkey, count(o_orderkey) as n, round(coalesce(sum(o_totalprice), 0), 2) as s
              from customer left join (select * from orders where o_totalprice > 450000) on c_custkey = o_custkey
              group by c_custkey)""",
)
def _(t):
    """Average of the dear orders, 0 for customers without any."""
    dear = t.orders.where("o_totalprice > 450000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("total"), F.count(F.lit(1)).alias("n")
    )
    joined = t.customer.select("c_custkey").join(dear, "c_custkey", "left").na.fill(0)
    return joined.select("c_custkey", safe_average("total", "n").alias("average_tx"))


@query(
    "txn_09_red_flags",
    f"""with h as (select account_number, round(sum(amount), 2) / count(*) as hist from ({TRANSACTIONS})
                   where date < '2000-01-01' group by 1)
        select account_number, total_spending, num_tx, window_avg, hist from ({_MERGED}) join h using (account_number)
        where (case when num_tx > 0 then total_spending / num_tx else 0 end) - hist > 2000 or window_avg - hist > 2000""",
)
def _(t):
    history = _window_totals(t, "date < '2000-01-01'").select(
        "account_number", safe_average("total_spending", "num_tx").alias("hist")
    )
    flag = is_red_flag(
        safe_average("total_spending", "num_tx"), F.col("window_avg"), F.col("hist")
    )
    return _merged(t).join(history, "account_number").where(flag)


@query(
    "txn_10_possible_fraud",
    "select id, account_number, amount, amount > 4000 as is_possible_fraud from (" + TRANSACTIONS + ")",
)
def _(t):
    return mark_possible_fraud(transactions(t).select("id", "account_number", "amount"))
