"""Sources and sinks on tables (SRC, SNK)."""

from __future__ import annotations

from pyspark.sql import functions as F

from finflow.operators.clean import corrupted, has_column
from finflow.operators.layout import partitions_for
from finflow.operators.transactions import account_profile
from finflow.plans.inputs import GAPPY, TRANSACTIONS, gappy, steady, transactions
from finflow.plans.registry import Tables, query
from finflow.schemas import ACCOUNT_AGGREGATES
from finflow.session import work_folder
from finflow.sources.keyed import read_upserted, upsert_batch
from finflow.sources.readers import (
    local_table, query_file, query_view, read_json, read_parquet, read_table,
)
from finflow.sources.writers import to_json_rows, write_parquet, write_table

_JSON_ROWS = "select id, account, amount, description, status from (" + GAPPY + ")"

_JSON_SCHEMA = "id bigint, account bigint, amount double, description string, status string"


def _json_file(t: Tables, cut_rows: bool) -> str:
    """The transactions as JSON lines in a fresh folder; with ``cut_rows`` those
    without a status are cut short, so that they do not parse."""
    rows = gappy(t)
    text = F.to_json(F.struct("*"))
    if cut_rows:
        text = F.when(F.col("status").isNull(), F.substring(text, 1, 7)).otherwise(text)
    path = work_folder(t.spark, "json")
    rows.select(text.alias("value")).write.text(path)
    return path


@query("src_01_json_drop_malformed", _JSON_ROWS + " where status is not null")
def _(t):
    return read_json(t.spark, _json_file(t, True), "DROPMALFORMED", _JSON_SCHEMA)


@query("src_02_json_fail_fast", _JSON_ROWS)
def _(t):
    return read_json(t.spark, _json_file(t, False), "FAILFAST", _JSON_SCHEMA)


@query(
    "src_03_json_permissive",
    """select (status is null) as is_corrupt, count(*) as n, count(id) as ids,
              round(sum(amount), 2) as amount
       from (select status, case when status is not null then id end as id,
                    case when status is not null then amount end as amount
             from (""" + _JSON_ROWS + """)) group by 1""",
)
def _(t):
    rows = read_json(t.spark, _json_file(t, True), "PERMISSIVE", _JSON_SCHEMA)
    return (
        rows.groupBy(F.col("_corrupt_record").isNotNull().alias("is_corrupt"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("id").alias("ids"),
            F.round(F.sum("amount"), 2).alias("amount"),
        )
    )


@query(
    "ssn_01_corrupted_rows",
    """select '{"id":' || left(o_orderkey::varchar, 1) as text, count(*) as n
       from orders where o_orderstatus = 'P' group by 1""",
)
def _(t):
    """Texts of the rows that do not parse; these were cut after the first digit of the id."""
    bad = corrupted(read_json(t.spark, _json_file(t, True), "PERMISSIVE", _JSON_SCHEMA))
    return bad.groupBy(F.col("_corrupt_record").alias("text")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "ssn_02_column_probe",
    "select o_orderstatus, count(*) as n, true as has_nested, false as has_missing from orders group by 1",
)
def _(t):
    nested = t.orders.withColumn("account", F.struct(F.col("o_custkey").alias("number")))
    return nested.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(has_column(nested, "Account.Number")).alias("has_nested"),
        F.lit(has_column(nested, "account.street")).alias("has_missing"),
    )


@query(
    "src_04_json_whole_file",
    "select c_custkey as id, c_name as name, c_mktsegment as segment from customer",
)
def _(t):
    """Customers as pretty-printed JSON documents, many lines each."""
    path = work_folder(t.spark, "json")
    document = F.to_json(
        F.struct(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
        ),
        {"pretty": "true"},
    )
    # One JSON array per task: several documents per file stay readable as a whole.
    t.customer.select(document.alias("value")).mapInArrow(_as_json_array, "value string").write.text(path)
    return read_json(
        t.spark, path, "FAILFAST", "id bigint, name string, segment string", whole_file=True
    )


def _as_json_array(batches):
    """Lines that make the documents of one partition a JSON array."""
    import pyarrow as pa

    before = "["
    for batch in batches:
        texts = batch.column(0).to_pylist()
        lines = [("," if before == "," or i else "[") + text for i, text in enumerate(texts)]
        if texts:
            before = ","
            yield pa.RecordBatch.from_arrays([pa.array(lines)], names=["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["]" if before == "," else "[]"])], names=["value"])


@query("src_05_json_sampled_inference", _JSON_ROWS)
def _(t):
    rows = read_json(t.spark, _json_file(t, False), "DROPMALFORMED", sampling_ratio=0.5)
    return rows.select("id", "account", "amount", "description", "status")


@query(
    "src_06_parquet_scan",
    "select o_orderkey, o_totalprice from orders where o_totalprice > 250000",
)
def _(t):
    return (
        read_parquet(t.spark, t.path("orders"))
        .where(F.col("o_totalprice") > 250000)
        .select("o_orderkey", "o_totalprice")
    )


@query("src_07_sql_on_file", "select c_custkey, c_name, c_acctbal from customer where c_acctbal < 0")
def _(t):
    return query_file(t.spark, t.path("customer"), "c_custkey, c_name, c_acctbal").where("c_acctbal < 0")


@query(
    "src_08_local_literals",
    """select o_orderkey, weight from orders
       join (values ('1-URGENT', 5), ('2-HIGH', 4), ('3-MEDIUM', 3)) v(priority, weight)
         on o_orderpriority = priority""",
)
def _(t):
    weights = local_table(
        t.spark, [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3)], "priority string, weight int"
    )
    return (
        t.orders.join(weights, F.col("o_orderpriority") == F.col("priority"))
        .select("o_orderkey", "weight")
    )


@query(
    "src_09_rename_by_position",
    "select c_name as user_name, c_acctbal as score from customer",
)
def _(t):
    return t.customer.select("c_name", "c_acctbal").toDF("user_name", "score")


@query(
    "src_10_temp_view",
    "select c_mktsegment, count(*) as customers from customer group by c_mktsegment",
)
def _(t):
    return query_view(
        t.customer, "finflow_customer",
        "select c_mktsegment, count(*) as customers from finflow_customer group by c_mktsegment",
    )


_HISTORY = """
    select o_custkey::varchar as account_number,
           round(avg(o_totalprice) + 1e-6, 4) as average_transaction
    from orders group by o_custkey"""


@query("src_11_external_table_columns", _HISTORY)
def _(t):
    path = f"{work_folder(t.spark, 'tables')}/{ACCOUNT_AGGREGATES}"
    write_table(account_profile(transactions(t)), path)
    stored = read_table(t.spark, path, ["account_number", "average_transaction"])
    return stored.withColumn("average_transaction", steady("average_transaction"))


@query("snk_01_parquet_overwrite", "select c_custkey, c_name, c_mktsegment from customer")
def _(t):
    path = work_folder(t.spark, "parquet")
    write_parquet(t.customer.select("c_custkey", "c_name"), path)
    customers = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    write_parquet(customers, path, files=partitions_for(customers))
    return t.spark.read.parquet(path)


@query(
    "snk_02_save_aggregates",
    """select o_custkey::varchar as account_number, round(avg(o_totalprice) + 1e-6, 4) as average_transaction,
              round(sum(o_totalprice), 2) as total_transaction, count(*) as num_transactions,
              max(o_totalprice) as max_transaction
       from orders group by o_custkey""",
)
def _(t):
    path = f"{work_folder(t.spark, 'tables')}/{ACCOUNT_AGGREGATES}"
    write_table(account_profile(transactions(t)), path)
    return t.spark.read.parquet(path).select(
        "account_number",
        steady("average_transaction").alias("average_transaction"),
        F.round("total_transaction", 2).alias("total_transaction"),
        "num_transactions",
        "max_transaction",
    )


@query(
    "snk_03_generic_format_options",
    "select c_mktsegment as segment, count(*) as customers from customer group by 1",
)
def _(t):
    path = work_folder(t.spark, "csv")
    counts = t.customer.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    write_table(counts, path, kind="csv", header="true", sep="|")
    return read_table(
        t.spark, path, ["segment", F.col("customers").cast("bigint").alias("customers")],
        kind="csv", header="true", sep="|",
    )


@query(
    "snk_04_json_rows",
    """select '{"o_orderkey":' || o_orderkey || coalesce(',"priority":"' ||
              nullif(o_orderpriority, '5-LOW') || '"', '') || '}' as value
       from orders""",
)
def _(t):
    return to_json_rows(
        t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    )


@query(
    "snk_06_keyed_table_upsert",
    """select id, account_number, amount, strftime(date, '%Y-%m-%d') as date, description
       from (select id, account_number, case when amount > 400000 then 400000.0 else amount end as amount,
                    date, description from (""" + TRANSACTIONS + """))""",
)
def _(t):
    """All transactions, then the large ones again with a corrected amount, one batch twice."""
    path = work_folder(t.spark, "keyed")
    everything = transactions(t)
    corrected = everything.where("amount > 400000").withColumn("amount", F.lit(400000.0))
    upsert_batch(everything.unionAll(everything), 0, path, ["id"])
    upsert_batch(corrected, 1, path, ["id"])
    upsert_batch(corrected, 1, path, ["id"])
    return read_upserted(t.spark, path, ["id"]).withColumn("date", F.col("date").cast("string"))
