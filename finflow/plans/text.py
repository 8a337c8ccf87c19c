"""Text functions (STR) and user functions (UDF)."""

from __future__ import annotations

from pyspark.sql import functions as F

from finflow.functions.words import (
    UDF_NAME, capitalize_words, capitalize_words_udf, register_capitalize_words,
)
from finflow.plans.registry import query

_WORDS = """list_aggregate(list_transform(string_split({x}, ' '), lambda w: {f}), 'string_agg', ' ')"""
_INITCAP = _WORDS.format(x="{x}", f="upper(left(w, 1)) || lower(substr(w, 2))")
_CAPITALIZED = _WORDS.format(x="rtrim({x}, ' ')", f="upper(left(w, 1)) || substr(w, 2)")


@query(
    "str_01_initcap",
    "select p_partkey, " + _INITCAP.format(x="p_name || ' of ' || p_type") + " as title from part",
)
def _(t):
    return t.part.select(
        "p_partkey", F.initcap(F.concat("p_name", F.lit(" of "), "p_type")).alias("title")
    )


@query("str_02_case", "select c_custkey, lower(c_name) as low, upper(c_name) as up from customer")
def _(t):
    return t.customer.select("c_custkey", F.lower("c_name").alias("low"), F.upper("c_name").alias("up"))


@query(
    "str_03_trim",
    "select p_partkey, ltrim('  ' || p_name || ' ') || '|' as l, rtrim('  ' || p_name || ' ') || '|' as r,"
    " trim('  ' || p_name || ' ') || '|' as b from part",
)
def _(t):
    padded = F.concat(F.lit("  "), "p_name", F.lit(" "))
    bar = F.lit("|")
    return t.part.select(
        "p_partkey",
        F.concat(F.ltrim(padded), bar).alias("l"),
        F.concat(F.rtrim(padded), bar).alias("r"),
        F.concat(F.trim(padded), bar).alias("b"),
    )


@query(
    "str_04_pad",
    "select p_partkey, lpad(p_brand, 9, '*') as l, rpad(p_name, 8, '-') as r from part",
)
def _(t):
    return t.part.select(
        "p_partkey", F.lpad("p_brand", 9, "*").alias("l"), F.rpad("p_name", 8, "-").alias("r")
    )


@query(
    "str_05_format_string",
    "select c_custkey, printf('%s of %s: %05d', c_name, c_mktsegment, c_custkey) as label from customer",
)
def _(t):
    return t.customer.select(
        "c_custkey",
        F.format_string("%s of %s: %05d", "c_name", "c_mktsegment", "c_custkey").alias("label"),
    )


@query(
    "str_06_length_split_reverse",
    """select doc_id, length(text)::integer as chars, len(string_split_regex(text, '[ \n]+'))::integer as words,
              string_split_regex(text, '[ \n]+')[1] as first_word, reverse(lang || source) as backwards
       from documents""",
)
def _(t):
    words = F.split("text", "[ \n]+")
    return t.documents.select(
        "doc_id",
        F.length("text").alias("chars"),
        F.size(words).alias("words"),
        F.get(words, F.lit(0)).alias("first_word"),
        F.reverse(F.concat("lang", "source")).alias("backwards"),
    )


@query(
    "str_07_substring",
    """select c_custkey, substring(c_name, 3, 5) as middle, c_name[-4:] as tail,
              substring(c_name, 2, 3) as via_method, split_part(c_name, '#', 1) as before_mark,
              split_part(c_name, '#', -1) as after_mark
       from customer""",
)
def _(t):
    name = F.col("c_name")
    return t.customer.select(
        "c_custkey",
        F.substring("c_name", 3, 5).alias("middle"),
        F.substring("c_name", -4, 4).alias("tail"),
        name.substr(2, 3).alias("via_method"),
        F.substring_index("c_name", "#", 1).alias("before_mark"),
        F.substring_index("c_name", "#", -1).alias("after_mark"),
    )


@query("str_08_repeat", "select n_nationkey, repeat(n_name, 10) as tenfold from nation")
def _(t):
    return t.nation.select("n_nationkey", F.repeat("n_name", 10).alias("tenfold"))


@query(
    "str_09_codes",
    """select p_partkey, ascii(p_name) as code, base64(encode(p_name)) as b64, p_name as round_trip,
              p_brand as decoded, hex(encode(p_type)) as bytes
       from part""",
)
def _(t):
    return t.part.select(
        "p_partkey",
        F.ascii("p_name").alias("code"),
        F.base64(F.encode("p_name", "UTF-8")).alias("b64"),
        F.unbase64(F.base64(F.encode("p_name", "UTF-8"))).cast("string").alias("round_trip"),
        F.decode(F.encode("p_brand", "UTF-16"), "UTF-16").alias("decoded"),
        F.hex(F.encode("p_type", "UTF-8")).alias("bytes"),
    )


@query(
    "str_10_locate",
    """select p_partkey, instr(lower(p_name), 'bolt')::integer as anywhere,
              (case when instr(substr(p_name, 4), 'e') > 0 then instr(substr(p_name, 4), 'e') + 3 else 0 end)::integer
                  as from_fourth,
              0 as from_zero
       from part""",
)
def _(t):
    return t.part.select(
        "p_partkey",
        F.locate("bolt", F.lower("p_name")).alias("anywhere"),
        F.locate("e", F.col("p_name"), 4).alias("from_fourth"),
        F.locate("e", F.col("p_name"), 0).alias("from_zero"),
    )


@query("str_11_instr", "select p_partkey, instr(p_name, 'ri')::integer as at from part")
def _(t):
    return t.part.select("p_partkey", F.instr("p_name", "ri").alias("at"))


@query(
    "str_12_regex_translate",
    """select c_custkey, regexp_extract(c_name, '#0*([0-9]+)', 1) as digits,
              regexp_replace(c_name, '[0-9]{3}', '<n>', 'g') as masked, translate(c_mktsegment, 'AEIO', '43') as odd
       from customer""",
)
def _(t):
    return t.customer.select(
        "c_custkey",
        F.regexp_extract("c_name", "#0*([0-9]+)", 1).alias("digits"),
        F.regexp_replace("c_name", "[0-9]{3}", "<n>").alias("masked"),
        F.translate("c_mktsegment", "AEIO", "43").alias("odd"),
    )


_CAPITALS = (
    "select p_partkey, "
    + _CAPITALIZED.format(x="p_name || '  mIxed ' || p_type || ' '")
    + " as title from part"
)


def _titles(t):
    return t.part.select(
        "p_partkey", F.concat("p_name", F.lit("  mIxed "), "p_type", F.lit(" ")).alias("name")
    )


@query("udf_01_registered_for_sql", _CAPITALS)
def _(t):
    register_capitalize_words(t.spark)
    return _titles(t).selectExpr("p_partkey", f"{UDF_NAME}(name) as title")


@query("udf_02_column_udf", _CAPITALS)
def _(t):
    return _titles(t).select("p_partkey", capitalize_words_udf("name").alias("title"))


@query("udf_03_built_in_equivalent", _CAPITALS)
def _(t):
    return _titles(t).select("p_partkey", capitalize_words(F.col("name")).alias("title"))
