"""Sorting, set operations, sampling, partition-level operators and arrays (SRT, SET, SMP, PAR, ARR)."""

from __future__ import annotations

from pyspark.sql import functions as F

from finflow.operators.aggregates import collect_lists
from finflow.operators.layout import glom, in_order, partitions_for, positioned, stable_sample, stable_split
from finflow.plans.inputs import GAPPY, gappy
from finflow.plans.registry import query
from finflow.session import cut_lineage
from finflow.sources.writers import for_each_partition


@query(
    "srt_01_global_sort",
    """select o_orderkey, o_totalprice, o_custkey,
              row_number() over (order by o_totalprice desc, o_custkey, o_orderkey) as position from orders""",
)
def _(t):
    """Dearest first; the unique key last lets a range of equal prices be split over tasks."""
    dearest = t.orders.select("o_orderkey", "o_totalprice", "o_custkey").orderBy(
        F.col("o_totalprice").desc(), F.col("o_custkey").asc(), F.col("o_orderkey")
    )
    return positioned(dearest)


_TOP = """
    select id, amount, description, 'nulls last' as placed,
           row_number() over (order by description asc nulls last, amount desc nulls last, id) as position from ({g})
    union all
    select id, amount, description, 'nulls first',
           row_number() over (order by description asc nulls first, amount asc nulls first, id) from ({g})
    union all
    select id, amount, description, 'desc nulls first',
           row_number() over (order by amount desc nulls first, id) from ({g})
    union all
    select id, amount, description, 'desc nulls last',
           row_number() over (order by amount desc nulls last, id) from ({g})""".format(g=GAPPY)


@query("srt_02_null_placement", _TOP)
def _(t):
    """All rows under four null placements."""
    rows = gappy(t).select("id", "amount", "description")
    amount, description, by_id = F.col("amount"), F.col("description"), F.col("id")
    orders = {
        "nulls last": [description.asc_nulls_last(), amount.desc_nulls_last(), by_id],
        "nulls first": [description.asc_nulls_first(), amount.asc_nulls_first(), by_id],
        "desc nulls first": [amount.desc_nulls_first(), by_id],
        "desc nulls last": [amount.desc_nulls_last(), by_id],
    }
    parts = [
        positioned(rows.orderBy(*order)).withColumn("placed", F.lit(name))
        for name, order in orders.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


@query("srt_03_sort_within_partitions", "select l_orderkey, l_linenumber, l_quantity, true as in_order from lineitem")
def _(t):
    """Line items clustered by order and sorted inside each partition; no global order is paid for."""
    sorted_ = (
        t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
        .repartition("l_orderkey", "l_linenumber")
        .sortWithinPartitions("l_orderkey", "l_linenumber")
    )
    return in_order(sorted_, ["l_orderkey", "l_linenumber"])


@query(
    "srt_04_top_k",
    "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25",
)
def _(t):
    return (
        t.orders.select("o_orderkey", "o_totalprice")
        .orderBy(F.col("o_totalprice").desc(), "o_orderkey")
        .limit(25)
    )


def _buyers(t, status):
    return t.orders.where(F.col("o_orderstatus") == status).select("o_custkey", "o_orderpriority")


_BUYERS = "select o_custkey, o_orderpriority from orders where o_orderstatus = "


@query("set_01_except", f"{_BUYERS} 'F' except {_BUYERS} 'O'")
def _(t):
    return _buyers(t, "F").subtract(_buyers(t, "O"))


@query("set_01_except_all", f"{_BUYERS} 'F' except all {_BUYERS} 'O'")
def _(t):
    return _buyers(t, "F").exceptAll(_buyers(t, "O"))


@query("set_02_intersect", f"{_BUYERS} 'F' intersect {_BUYERS} 'O'")
def _(t):
    return _buyers(t, "F").intersect(_buyers(t, "O"))


@query(
    "set_03_union_all",
    "select c_custkey as key, c_name as name from customer union all select s_suppkey, s_name from supplier",
)
def _(t):
    customers = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return customers.union(t.supplier.select("s_suppkey", "s_name"))


@query(
    "set_03_union_by_name",
    "select c_custkey as key, c_name as name, null::varchar as note from customer"
    " union all select s_suppkey, s_name, 'supplier' from supplier",
)
def _(t):
    customers = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    suppliers = t.supplier.select(
        F.lit("supplier").alias("note"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)


_DRAW = "('0x' || substr(md5('{seed}|' || o_orderkey), 1, 12))::bigint::double / 281474976710656.0"


@query(
    "smp_01_sample",
    f"select o_orderkey, o_totalprice from orders where {_DRAW.format(seed=7)} < 0.2",
)
def _(t):
    return stable_sample(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 0.2, seed=7)


@query("smp_01_random_sample", "select true as same_again, true as from_the_table, true as about_a_fifth, true as no_repeats")
def _(t):
    """The built-in sampler draws other rows for another layout, so what it promises is checked."""
    orders = t.orders.select("o_orderkey")
    draw, again = (orders.sample(fraction=0.2, seed=7).withColumn(n, F.lit(1)) for n in ("first", "second"))
    both = orders.withColumn("all", F.lit(1)).join(draw, "o_orderkey", "full").join(again, "o_orderkey", "full")
    drawn, share = F.count("first"), F.count("first") / F.count("all")
    spread = 5 * F.sqrt(0.16 / F.count("all"))
    return both.agg(
        (F.count(F.when(F.col("first").isNull() != F.col("second").isNull(), 1)) == 0).alias("same_again"),
        (F.count(F.when(F.col("all").isNull(), 1)) == 0).alias("from_the_table"),
        ((drawn > 0) & (F.abs(share - 0.2) < spread)).alias("about_a_fifth"),
        (F.count_distinct(F.when(F.col("first").isNotNull(), F.col("o_orderkey"))) == drawn).alias("no_repeats"),
    )


@query(
    "smp_02_random_split",
    f"""select part, count(*) as n, sum(o_orderkey)::bigint as keys from
        (select o_orderkey, case when r < 0.7 then 0 when r < 0.9 then 1 else 2 end as part
         from (select o_orderkey, {_DRAW.format(seed=3)} as r from orders)) group by part""",
)
def _(t):
    parts = stable_split(t.orders.select("o_orderkey"), ["o_orderkey"], [7, 2, 1], seed=3)
    return parts.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")
    )


@query(
    "smp_02_builtin_split",
    "select count(*) as n, sum(o_orderkey)::bigint as keys, count(distinct o_orderkey) as different from orders",
)
def _(t):
    """Together the parts of the built-in split are the table."""
    one, two, three = t.orders.select("o_orderkey").randomSplit([7.0, 2.0, 1.0], seed=3)
    return one.union(two).union(three).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("o_orderkey").alias("keys"),
        F.count_distinct("o_orderkey").alias("different"),
    )


@query(
    "par_01_partition_count",
    """select 'changed' as step, true as as_asked, count(*) as n, sum(c_custkey)::bigint as keys from customer
       union all select 'lowered', true, count(*), sum(c_custkey)::bigint from customer""",
)
def _(t):
    """Partitions by the size of the table, then half as many: as many hold rows, and no row is lost."""
    customers = t.customer.select("c_custkey", "c_name")
    # A few rows to a partition would leave some empty, so small tables are asked for two.
    asked = max(2, partitions_for(customers))
    changed = customers.repartition(asked, "c_custkey")
    steps = {"changed": (changed, asked), "lowered": (changed.coalesce(asked // 2), asked // 2)}
    held = [
        df.withColumn("_part", F.spark_partition_id()).agg(
            F.lit(step).alias("step"),
            (F.count_distinct("_part") == parts).alias("as_asked"),
            F.count(F.lit(1)).alias("n"),
            F.sum("c_custkey").alias("keys"),
        )
        for step, (df, parts) in steps.items()
    ]
    return held[0].unionByName(held[1])


@query("par_02_row_map", "select p_partkey, upper(p_name) as name, p_size * 2 as double_size from part")
def _(t):
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("name"), (F.col("p_size") * 2).alias("double_size")
    )


@query(
    "par_02_flat_map",
    "select p_partkey, unnest(string_split(p_name, ' ')) as word from part",
)
def _(t):
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query(
    "par_03_map_partitions",
    "select event_id, floor(value)::bigint as whole from events",
)
def _(t):
    """Arrow batches in and out of Python, a partition at a time."""
    import pyarrow.compute as pc

    def whole_values(batches):
        for batch in batches:
            whole = pc.cast(pc.floor(batch.column("value")), "int64")
            yield batch.set_column(1, "whole", whole)

    return t.events.select("event_id", "value").mapInArrow(whole_values, "event_id bigint, whole bigint")


@query(
    "par_04_foreach_partition",
    "select count(*) as n, count(*) as seen, round(sum(value), 2) as total from events",
)
def _(t):
    """Rows handled on the executors for their side effect, here a counter, beside a plain count."""
    seen = t.spark.sparkContext.accumulator(0)

    def handle(rows):
        seen.add(sum(1 for _ in rows))

    for_each_partition(t.events.select("event_id"), handle)
    return t.events.agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(seen.value).cast("bigint").alias("seen"),
        F.round(F.sum("value"), 2).alias("total"),
    )


@query(
    "par_05_glom",
    "select count(*) as items, round(sum(value), 2) as total, 1 as fewest_in_a_list from events",
)
def _(t):
    """All values, packed into one array per batch of each partition, and counted again."""
    packed = glom(t.events, "value")
    return packed.agg(
        F.sum(F.size("items").cast("bigint")).alias("items"),
        F.round(F.sum(F.aggregate("items", F.lit(0.0), lambda a, b: a + b)), 2).alias("total"),
        F.least(F.min(F.size("items")), F.lit(1)).alias("fewest_in_a_list"),
    )


@query(
    "par_06_checkpoint_and_persist",
    "select o_custkey, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by o_custkey",
)
def _(t):
    """The customer totals are saved once and used twice."""
    totals = cut_lineage(
        t.orders.groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
        )
    )
    busy, quiet = totals.where("n >= 10"), totals.where("n < 10")
    return busy.unionAll(quiet)


def _line_arrays(t):
    """Suppliers of each order line-up; parts of brand 5 get an empty and of brand 6 a null array."""
    words = F.split("p_name", " ")
    return t.part.select(
        "p_partkey",
        F.when(F.col("p_brand") == "Brand#5", F.array().cast("array<string>"))
        .when(F.col("p_brand") == "Brand#6", F.lit(None))
        .otherwise(words)
        .alias("words"),
    )


_ARRAYS = """(select p_partkey, case when p_brand = 'Brand#5' then []::varchar[]
                when p_brand = 'Brand#6' then null else string_split(p_name, ' ') end as words from part)"""


@query("arr_01_explode", f"select p_partkey, unnest(words) as word from {_ARRAYS}")
def _(t):
    return _line_arrays(t).select("p_partkey", F.explode("words").alias("word"))


@query(
    "arr_01_explode_structs",
    "select l_orderkey, l_linenumber, l_quantity from lineitem where l_quantity > 0",
)
def _(t):
    """Line items gathered per order, a thousand at most to an array, then flattened to their fields."""
    items = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_shipdate", F.struct("l_linenumber", "l_quantity").alias("item")
    )
    orders = collect_lists(items, ["l_orderkey"], ["l_shipdate", "l_linenumber"], "item", "items", chunk_rows=1000)
    flat = orders.select("l_orderkey", F.explode("items").alias("item"))
    return flat.select("l_orderkey", "item.l_linenumber", F.expr("item.l_quantity as l_quantity"))


@query(
    "arr_02_explode_outer",
    f"""select p_partkey, unnest(case when len(words) > 0 then words else [null]::varchar[] end) as word
        from {_ARRAYS}""",
)
def _(t):
    return _line_arrays(t).select("p_partkey", F.explode_outer("words").alias("word"))


@query(
    "arr_03_posexplode",
    "select vec_id, (unnest(range(len(embedding))))::integer as pos, unnest(embedding)::double as x from embeddings",
)
def _(t):
    flat = t.embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "x"))
    return flat.withColumn("x", F.col("x").cast("double"))
