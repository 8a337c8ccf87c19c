"""Projections, filters, null handling and predicates (PRJ, FLT, PRD)."""

from __future__ import annotations

from pyspark.sql import functions as F

from finflow.operators.clean import drop_if_all_null
from finflow.plans.inputs import GAPPY, RAW_FINANCES, gappy, raw_finances
from finflow.plans.registry import query


@query("prj_01_select", "select o_orderkey, o_totalprice from orders")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice")


@query("prj_02_alias", "select o_orderkey as id, o_totalprice as amount from orders")
def _(t):
    return t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))


@query(
    "prj_03_struct_field",
    "select id, account_number, c_name as first_name from (select o_orderkey as id,"
    " c_custkey::varchar as account_number, c_name from orders join customer on o_custkey = c_custkey)",
)
def _(t):
    nested = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.col("c_custkey").cast("string").alias("number"), F.col("c_name").alias("firstName")
        ).alias("account"),
    )
    return nested.select(
        "id",
        F.col("account.number").alias("account_number"),
        F.expr("account.firstName as first_name"),
    )


@query("prj_04_star_plus", "select *, o_totalprice * 2 as doubled from orders")
def _(t):
    return t.orders.select("*", (F.col("o_totalprice") * 2).alias("doubled"))


@query(
    "prj_05_with_column",
    "select o_orderkey, o_totalprice / 100 as o_totalprice, year(o_orderdate)::int as year from orders",
)
def _(t):
    return (
        t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
        .withColumn("o_totalprice", F.col("o_totalprice") / 100)
        .withColumn("year", F.year("o_orderdate"))
        .drop("o_orderdate")
    )


@query(
    "prj_06_select_expr",
    "select o_orderkey, upper(o_orderstatus) || '-' || o_orderpriority as tag from orders",
)
def _(t):
    return t.orders.selectExpr("o_orderkey", "upper(o_orderstatus) || '-' || o_orderpriority as tag")


@query(
    "prj_07_case_when",
    """select o_orderkey, case when o_orderstatus = 'F' then 'Premium'
              when o_orderstatus = 'O' then 'Legacy' else 'Standard' end as tier from orders""",
)
def _(t):
    status = F.col("o_orderstatus")
    tier = F.when(status == "F", "Premium").when(status == "O", "Legacy").otherwise("Standard")
    return t.orders.select("o_orderkey", tier.alias("tier"))


@query(
    "prj_08_cast",
    """select o_orderkey::varchar as key_text, o_totalprice::integer as whole,
              try_cast(left(o_orderpriority, 2) as integer) as not_a_number,
              try_cast(left(o_orderpriority, 1) as integer) as level,
              cast(strftime(o_orderdate, '%Y-%m-%d') as timestamp) as at
       from (select o_orderkey, trunc(o_totalprice) as o_totalprice, o_orderpriority, o_orderdate from orders)""",
)
def _(t):
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_totalprice").cast("int").alias("whole"),
        F.substring("o_orderpriority", 1, 2).try_cast("int").alias("not_a_number"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("level"),
        F.date_format("o_orderdate", "yyyy-MM-dd").cast("timestamp_ntz").alias("at"),
    )


@query(
    "prj_09_transform",
    """select o_orderkey, o_totalprice * 1.1::double as gross from orders where o_orderstatus = 'F'""",
)
def _(t):
    def finished(df):
        return df.where(F.col("o_orderstatus") == "F")

    def with_tax(df, rate):
        return df.select("o_orderkey", (F.col("o_totalprice") * F.lit(1 + rate)).alias("gross"))

    return t.orders.transform(finished).transform(with_tax, rate=0.1)


@query(
    "prj_10_literal",
    "select c_custkey, c_name || ' ' || c_mktsegment as label, 7 as seven from customer",
)
def _(t):
    return t.customer.select(
        "c_custkey",
        F.concat("c_name", F.lit(" "), "c_mktsegment").alias("label"),
        F.lit(7).alias("seven"),
    )


@query(
    "flt_01_three_valued_filter",
    "select * from (" + GAPPY + ") where amount <> 0 or description = '1-URGENT'",
)
def _(t):
    return gappy(t).where((F.col("amount") != 0) | (F.col("description") == "1-URGENT"))


@query("flt_02_predicate_filter", "select o_orderkey from orders where o_totalprice > 100000 and o_custkey >= 10")
def _(t):
    return (
        t.orders.filter((F.col("o_totalprice") > 100000) & (F.col("o_custkey") >= 10))
        .select("o_orderkey")
    )


@query(
    "flt_03_drop_all_null",
    "select account, amount, description, status from (" + GAPPY + ") where account is not null or amount is not null"
    " or description is not null or status is not null",
)
def _(t):
    return drop_if_all_null(gappy(t).drop("id"))


@query(
    "flt_04_drop_listed_null",
    "select id, account_number, amount, description, date from (" + RAW_FINANCES + ")"
    " where id is not null or account_number is not null or amount is not null"
    " or description is not null or date is not null",
)
def _(t):
    rows = drop_if_all_null(
        raw_finances(t), ["id", "account.number", "amount", "description", "date"]
    )
    return rows.select(
        "id", F.col("account.number").alias("account_number"), "amount", "description", "date"
    )


@query(
    "flt_05_drop_any_null",
    "select * from (" + GAPPY + ") where account is not null and amount is not null"
    " and description is not null and status is not null",
)
def _(t):
    return gappy(t).na.drop("any")


@query(
    "flt_06_fill_columns",
    "select id, account, amount, coalesce(description, 'Unknown') as description, status from (" + GAPPY + ")",
)
def _(t):
    return gappy(t).na.fill("Unknown", ["description"])


@query(
    "flt_07_fill_map",
    "select id, account, coalesce(amount, -1.0::double) as amount,"
    " coalesce(description, 'Unknown') as description, status from (" + GAPPY + ")",
)
def _(t):
    return gappy(t).na.fill({"description": "Unknown", "amount": -1.0})


@query(
    "flt_08_fill_type",
    "select id, coalesce(account, 0) as account, coalesce(amount, 0.0::double) as amount,"
    " coalesce(description, 'none') as description, coalesce(status, 'none') as status,"
    " coalesce(flag, true) as flag from (select *, case when status = 'F' then false end as flag from (" + GAPPY + "))",
)
def _(t):
    rows = gappy(t).withColumn("flag", F.when(F.col("status") == "F", F.lit(False)))
    return rows.na.fill("none").na.fill(0).na.fill(True)


@query(
    "flt_09_replace_map",
    "select id, case description when '1-URGENT' then 'now' when '2-HIGH' then 'soon' else description end"
    " as description, status from (" + GAPPY + ")",
)
def _(t):
    return (
        gappy(t).select("id", "description", "status")
        .na.replace({"1-URGENT": "now", "2-HIGH": "soon"}, subset=["description"])
    )


@query(
    "prd_01_comparison",
    """select id, amount > 0 as gt, amount >= 0 as gte, amount < 100000 as lt, amount <= 100000 as lte,
              account = 7 as eq, account <> 7 as ne from (""" + GAPPY + ")",
)
def _(t):
    amount, account = F.col("amount"), F.col("account")
    return gappy(t).select(
        "id",
        (amount > 0).alias("gt"), (amount >= 0).alias("gte"),
        (amount < 100000).alias("lt"), (amount <= 100000).alias("lte"),
        (account == 7).alias("eq"), (account != 7).alias("ne"),
    )


@query(
    "prd_02_null_safe_equal",
    "select id, description is not distinct from null as is_missing,"
    " status is not distinct from 'F' as is_f from (" + GAPPY + ")",
)
def _(t):
    return gappy(t).select(
        "id",
        F.col("description").eqNullSafe(F.lit(None)).alias("is_missing"),
        F.col("status").eqNullSafe("F").alias("is_f"),
    )


@query(
    "prd_03_and_or",
    "select id, (amount > 0 and status = 'F') as both_hold, (amount > 0 or status = 'F') as either_holds"
    " from (" + GAPPY + ")",
)
def _(t):
    one, two = F.col("amount") > 0, F.col("status") == "F"
    return gappy(t).select("id", (one & two).alias("both_hold"), (one | two).alias("either_holds"))


@query(
    "prd_04_in_list",
    "select id, description in ('1-URGENT', '2-HIGH') as pressing from (" + GAPPY + ")",
)
def _(t):
    return gappy(t).select("id", F.col("description").isin("1-URGENT", "2-HIGH").alias("pressing"))


@query(
    "prd_05_null_and_nan",
    """select id, amount is null as no_amount, status is not null as has_status,
              coalesce(isnan(case when status = 'F' then 'NaN'::double else amount end), false) as odd
       from (""" + GAPPY + ")",
)
def _(t):
    doubtful = F.when(F.col("status") == "F", F.lit(float("nan"))).otherwise(F.col("amount"))
    return gappy(t).select(
        "id",
        F.col("amount").isNull().alias("no_amount"),
        F.col("status").isNotNull().alias("has_status"),
        F.isnan(doubtful).alias("odd"),
    )


@query("prd_06_like", "select p_partkey, p_name from part where p_name like '%ri_g%'")
def _(t):
    return t.part.where(F.col("p_name").like("%ri_g%")).select("p_partkey", "p_name")


@query("prd_07_regex_match", "select p_partkey from part where regexp_matches(p_name, '^(red|blue) .*t$')")
def _(t):
    return t.part.where(F.col("p_name").rlike("^(red|blue) .*t$")).select("p_partkey")


@query(
    "prd_08_starts_ends",
    "select p_partkey from part where starts_with(p_name, 'red') or ends_with(p_name, 'bolt')",
)
def _(t):
    name = F.col("p_name")
    return t.part.where(name.startswith("red") | name.endswith("bolt")).select("p_partkey")


@query("prd_09_contains", "select p_partkey from part where contains(p_name, 'idg')")
def _(t):
    return t.part.where(F.col("p_name").contains("idg")).select("p_partkey")
