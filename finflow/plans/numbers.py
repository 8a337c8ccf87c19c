"""Math (MTH), hashes (HSH), generated columns (GEN) and complex columns (CPX)."""

from __future__ import annotations

from pyspark.sql import functions as F

from finflow.plans.registry import query


@query(
    "mth_01_trigonometry",
    """select l_orderkey, l_linenumber, l_extendedprice, round(cos(d), 9) as cos, round(acos(d), 9) as acos,
              round(sin(d), 9) as sin, round(asin(d), 9) as asin, round(tan(d), 9) as tan,
              round(atan(d), 9) as atan, round(degrees(d), 9) as degrees, round(radians(l_quantity), 9) as radians
       from (select *, l_discount * 5 as d from lineitem)""",
)
def _(t):
    d = F.col("l_discount") * 5
    names = {
        "cos": F.cos(d), "acos": F.acos(d), "sin": F.sin(d), "asin": F.asin(d), "tan": F.tan(d),
        "atan": F.atan(d), "degrees": F.degrees(d), "radians": F.radians("l_quantity"),
    }
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        *[F.round(c, 9).alias(n) for n, c in names.items()],
    )


@query(
    "mth_02_bases",
    """select o_orderkey, bin(o_orderkey) as binary, hex(o_orderkey) as hexadecimal,
              o_orderpriority as back from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.bin("o_orderkey").alias("binary"),
        F.hex("o_orderkey").alias("hexadecimal"),
        F.decode(F.unhex(F.hex("o_orderpriority")), "UTF-8").alias("back"),
    )


@query(
    "mth_03_rounding_and_shifts",
    """select c_custkey, abs(c_acctbal) as abs, round(c_acctbal, 1) as round, ceil(c_acctbal)::bigint as ceil,
              floor(c_acctbal)::bigint as floor, c_custkey << 3 as left3, c_custkey >> 2 as right2
       from customer""",
)
def _(t):
    balance, key = F.col("c_acctbal"), F.col("c_custkey")
    return t.customer.select(
        "c_custkey",
        F.abs(balance).alias("abs"),
        F.round(balance, 1).alias("round"),
        F.ceil(balance).alias("ceil"),
        F.floor(balance).alias("floor"),
        F.shiftleft(key, 3).alias("left3"),
        F.shiftright(key, 2).alias("right2"),
    )


@query(
    "mth_04_powers",
    """select p_partkey, round(cbrt(p_size), 9) as cbrt, round(exp(p_size / 10.0), 6) as exp,
              case when p_size <= 20 then factorial(p_size)::bigint end as factorial,
              round(pow(p_size, 1.5), 6) as pow, round(sqrt(p_size * p_size + p_retailprice * p_retailprice), 6) as hypot
       from part""",
)
def _(t):
    size = F.col("p_size")
    return t.part.select(
        "p_partkey",
        F.round(F.cbrt(size), 9).alias("cbrt"),
        F.round(F.exp(size / 10.0), 6).alias("exp"),
        F.factorial(size).alias("factorial"),
        F.round(F.pow(size, 1.5), 6).alias("pow"),
        F.round(F.hypot(size, F.col("p_retailprice")), 6).alias("hypot"),
    )


@query(
    "mth_05_logarithms",
    """select o_orderkey, round(ln(o_totalprice), 9) as natural, round(log10(o_totalprice), 9) as tens,
              round(log2(o_totalprice), 9) as twos, round(ln(o_totalprice) / ln(3), 9) as threes,
              null::double as of_negative
       from orders""",
)
def _(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        F.round(F.log(price), 9).alias("natural"),
        F.round(F.log10(price), 9).alias("tens"),
        F.round(F.log2(price), 9).alias("twos"),
        F.round(F.log(3.0, price), 9).alias("threes"),
        F.log(-price).alias("of_negative"),
    )


@query(
    "mth_06_arithmetic",
    """select l_orderkey, l_linenumber, l_extendedprice, l_quantity + l_linenumber as plus,
              l_quantity - l_linenumber as minus, l_quantity * l_linenumber as times,
              l_quantity / l_linenumber as divided, l_orderkey % l_linenumber as modulo,
              l_quantity / nullif(l_linenumber - 1, 0) as guarded_divide,
              l_orderkey % nullif(l_linenumber - 1, 0) as guarded_modulo
       from lineitem""",
)
def _(t):
    quantity, number, key = F.col("l_quantity"), F.col("l_linenumber"), F.col("l_orderkey")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        (quantity + number).alias("plus"),
        (quantity - number).alias("minus"),
        (quantity * number).alias("times"),
        (quantity / number).alias("divided"),
        (key % number).alias("modulo"),
        F.try_divide(quantity, number - 1).alias("guarded_divide"),
        F.try_mod(key, number - 1).alias("guarded_modulo"),
    )


@query(
    "mth_07_greatest_least",
    """select o_orderkey, greatest(o_totalprice, 250000.0::double, gap) as most, least(o_totalprice, gap) as fewest
       from (select *, case when o_orderstatus = 'F' then 300000.0::double end as gap from orders)""",
)
def _(t):
    gap = F.when(F.col("o_orderstatus") == "F", F.lit(300000.0))
    return t.orders.select(
        "o_orderkey",
        F.greatest("o_totalprice", F.lit(250000.0), gap).alias("most"),
        F.least(F.col("o_totalprice"), gap).alias("fewest"),
    )


@query("hsh_01_md5_sha", "select c_custkey, md5(c_name) as md5, sha1(c_name) as sha from customer")
def _(t):
    return t.customer.select("c_custkey", F.md5("c_name").alias("md5"), F.sha1("c_name").alias("sha"))


@query(
    "hsh_01_hash",
    "select c_mktsegment, true as known, count(*) as n, count(distinct c_name) as names, true as spread"
    " from customer group by c_mktsegment",
)
def _(t):
    """Murmur3 has no counterpart in the SQL used for checking: a known value, equal hashes of equal
    inputs (as many hashes as names, but for chance) and another hash for another input."""
    named = F.hash("c_name")
    return t.customer.groupBy("c_mktsegment").agg(
        F.bool_and(F.hash(F.lit("Spark"), F.array(F.lit(123)), F.lit(2)) == -1321691492).alias("known"),
        F.count(named).alias("n"),
        F.count_distinct("c_name").alias("names"),
        (
            (F.count_distinct(named) <= F.count_distinct("c_name"))
            & (F.count_distinct(named) >= 0.999 * F.count_distinct("c_name"))
        ).alias("spread"),
    )


@query(
    "gen_01_random_and_ids",
    "select count(*) as n, count(distinct o_orderkey) as different_ids, true as in_unit_interval from orders",
)
def _(t):
    """Facts that hold for any random draw and any generated ids."""
    numbered = t.orders.select(
        F.monotonically_increasing_id().alias("row_id"), F.rand(11).alias("draw")
    )
    return numbered.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("row_id").alias("different_ids"),
        ((F.min("draw") >= 0) & (F.max("draw") < 1)).alias("in_unit_interval"),
    )


@query(
    "gen_02_origin",
    "select 'orders.parquet' as file, count(*) as n, true as has_partition from orders",
)
def _(t):
    """Which file and partition each row came from, counted."""
    traced = t.orders.select(
        F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"),
        F.spark_partition_id().alias("partition"),
    )
    return traced.groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), (F.min("partition") >= 0).alias("has_partition")
    )


@query(
    "cpx_01_constructors",
    """select c_custkey, c_name as first_item, c_acctbal as balance_entry, c_mktsegment as segment_field, 2 as items
       from customer""",
)
def _(t):
    built = t.customer.select(
        "c_custkey",
        F.array("c_name", "c_mktsegment").alias("items"),
        F.create_map(F.lit("balance"), "c_acctbal").alias("entries"),
        F.struct(F.col("c_mktsegment").alias("segment"), "c_nationkey").alias("record"),
    )
    return built.select(
        "c_custkey",
        F.get("items", F.lit(0)).alias("first_item"),
        F.col("entries")["balance"].alias("balance_entry"),
        F.col("record.segment").alias("segment_field"),
        F.size("items").alias("items"),
    )


@query(
    "cpx_02_json_paths",
    """select event_id, json_extract_string(props, '$.k') as via_path, json_extract_string(props, '$.k') as via_tuple,
              null::varchar as missing
       from events""",
)
def _(t):
    return t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("via_path"),
        F.json_tuple("props", "k", "missing").alias("via_tuple", "missing"),
    )


@query(
    "cpx_03_json_structs",
    """select event_id, json_extract(props, '$.k')::bigint as k,
              '{"event_type":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' as packed,
              null::bigint as of_bad_text
       from events""",
)
def _(t):
    parsed = F.from_json("props", "k bigint")
    return t.events.select(
        "event_id",
        parsed["k"].alias("k"),
        F.to_json(F.struct("event_type", parsed["k"].alias("k"))).alias("packed"),
        F.from_json(F.concat(F.lit("no json "), "props"), "k bigint")["k"].alias("of_bad_text"),
    )
