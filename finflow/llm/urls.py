"""URL rules and lists by a cascade of Bloom filters, in built-in functions only.

The first level holds the listed keys. The keys of the corpus that pass it
without being listed are its false positives; the second level holds those, the
third the listed keys that pass the second, and so on until nothing passes
wrongly. Over the key universe it was built from, a cascade answers exactly,
and it answers in an expression: no join, no shuffle of the rows.

Levels are built from distinct keys (two shuffles of short keys). A filter
takes ``bits_per_key`` bits for each key of its level; what one job carries is
limited to ``most_bytes`` by cutting the list by hash into blocks with a cascade
each, of which as many as fit are asked in one pass.

Edge cases. A null url and one without ``://`` have an empty host and path and
fit no rule. A rule's path must start the url's path, so the rule ``net/`` does
not fit ``http://a.net``. Of the rules that fit, the longest (host and path
together, then the longer host) decides; if both lists hold it, it blocks.
Repeated rows are judged each; further columns are ignored. Empty tables and
empty lists give no rows and no match.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finflow.llm.store import dropped, stored

BITS_PER_KEY = 12
PROBES = 5
MOST_BYTES = 64 << 20
# Size of the pieces in which Spark's bitmap aggregate returns a bit set.
_PIECE_BITS = 32768

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Level:
    bits: bytes
    size: int
    salt: int

    def passes(self, key: Column) -> Column:
        return reduce(lambda a, b: a & b, [self._bit(p) for p in _probes(key, self.size, self.salt)])

    def _bit(self, place: Column) -> Column:
        at = place - 1
        byte = F.substring(F.lit(bytearray(self.bits)), F.floor(at / 8).cast("int") + 1, F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        return F.get(F.array(*[F.lit(1 << i) for i in range(8)]), (at % 8).cast("int")).bitwiseAND(value) != 0


def _probes(key: Column, size: int, salt: int) -> list[Column]:
    """Places of ``key`` in a filter, from 1 on."""
    return [F.pmod(F.xxhash64(key, F.lit(salt * PROBES + i)), F.lit(size)) + 1 for i in range(PROBES)]


@dataclass(frozen=True)
class Cascade:
    """Filters of alternating sides; the blocks cut the keys by hash."""

    blocks: tuple[tuple[Level, ...], ...]

    def holds(self, key: Column) -> Column:
        """Is ``key``, one of the universe, listed?"""
        answer = F.lit(False)
        for number, levels in enumerate(self.blocks):
            if not levels:
                continue
            inside = F.lit(len(levels) % 2 == 1)
            for depth in range(len(levels), 0, -1):
                inside = F.when(levels[depth - 1].passes(key), inside).otherwise(F.lit(depth % 2 == 0))
            answer = answer | ((_block(key, len(self.blocks)) == number) & inside)
        return answer

    @property
    def bytes(self) -> int:
        return sum(len(level.bits) for levels in self.blocks for level in levels)


def _block(key: Column, blocks: int) -> Column:
    return F.lit(0) if blocks == 1 else F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks))


def _level(keys: DataFrame, count: int, bits_per_key: int, salt: int) -> Level:
    pieces = max(1, -(-count * bits_per_key // _PIECE_BITS))
    size = pieces * _PIECE_BITS
    bits = (
        keys.select(F.explode(F.array(*_probes(F.col("key"), size, salt))).alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("piece"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        .collect()  # the filter itself: bounded by most_bytes
    )
    whole = bytearray(size // 8)
    for row in bits:
        begin = (row["piece"] - 1) * _PIECE_BITS // 8
        whole[begin : begin + _PIECE_BITS // 8] = row["bits"]
    return Level(bytes(whole), size, salt)


def build_cascades(
    universe: DataFrame, listed: DataFrame, bits_per_key: int = BITS_PER_KEY, most_bytes: int = MOST_BYTES
) -> list[Cascade]:
    """Cascades over the keys of ``universe`` and ``listed`` (column ``key``); a key is listed if one holds it.

    Null keys are left out.
    """
    keys = (
        universe.select("key", F.lit(False).alias("listed"))
        .unionByName(listed.select("key", F.lit(True).alias("listed")))
        .where("key is not null")
        .groupBy("key")
        .agg(F.max("listed").alias("listed"))
    )
    keys = stored(keys, "keys")
    total = keys.where("listed").count()
    # A level and the shorter ones after it take less than twice the first.
    blocks = max(1, -(-2 * total * bits_per_key // (8 * most_bytes)))
    cascades = []
    for number in range(blocks):
        active = keys.where(_block(F.col("key"), blocks) == number)
        levels: list[Level] = []
        while True:
            side = len(levels) % 2 == 0
            count = active.where(F.col("listed") == side).count()
            if not count:
                break
            level = _level(active.where(F.col("listed") == side), count, bits_per_key, len(levels))
            levels.append(level)
            active = active.where((F.col("listed") == side) | level.passes(F.col("key")))
        cascades.append(Cascade(tuple(() if n != number else tuple(levels) for n in range(blocks))))
    dropped(keys)
    return cascades


def split_url(url: Column) -> tuple[Column, Column]:
    """``(host, path)``: host lower-cased, up to ``/ ? #``; path up to ``? #``."""
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substring(url, begin + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), CAPITALS, CAPITALS.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_keys(host: Column, path: Column, path_lengths: Sequence[int]) -> Column:
    """Every rule that could fit, longest first: each ending of the host with each start of the path."""
    labels = F.split(host, r"\.")
    endings = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    starts = F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in path_lengths])
    pairs = F.flatten(
        F.transform(
            endings,
            lambda e: F.transform(
                F.filter(starts, lambda s: s.isNotNull()),
                lambda s: F.struct(
                    (-F.length(e) - F.length(s)).alias("a"), (-F.length(e)).alias("b"), F.concat(e, s).alias("key")
                ),
            ),
        )
    )
    return F.when(host != "", F.transform(F.sort_array(pairs), lambda p: p["key"])).otherwise(
        F.array().cast("array<string>")
    )


def thin_hosts(pages: DataFrame, percent: int = 80) -> DataFrame:
    """``key``: the hosts whose pages have on average less than ``percent`` of the bytes that pages have on the whole.

    Two short rows go on from all pages: a sum by host, and one over the hosts.
    """
    bytes_ = F.octet_length(F.coalesce("html", F.lit(""))).cast("decimal(20,0)")
    hosts = pages.select(split_url(F.col("url"))[0].alias("key"), bytes_.alias("b"))
    hosts = hosts.groupBy("key").agg(F.sum("b").alias("b"), F.count(F.lit(1)).cast("decimal(18,0)").alias("n"))
    whole = hosts.agg(F.sum("b").alias("all_b"), F.sum("n").alias("all_n")).first()
    if whole["all_n"] is None:
        return hosts.select("key")
    # In whole numbers, so that no rounding decides.
    share = lambda value, factor: value.cast("decimal(38,0)") * F.lit(int(factor)).cast("decimal(38,0)")
    thin = share(F.col("b"), 100 * whole["all_n"]) < share(F.col("n"), percent * whole["all_b"])
    return hosts.where((F.col("key") != "") & thin).select("key")


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    listed_hosts: DataFrame,
    bits_per_key: int = BITS_PER_KEY,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of each url.

    ``rules`` has ``action`` (allow or block), ``host`` and ``path``; a url that
    fits none is blocked if ``listed_hosts`` (``key``) holds its host.
    """
    host, path = split_url(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect() if r[0] is not None)
    urls = urls.withColumn("_keys", rule_keys(F.col("host"), F.col("path"), lengths or [1]))
    universe = urls.select(F.explode("_keys").alias("key"))
    named = rules.select("action", F.concat("host", "path").alias("key"))

    def fits(cascades: list[Cascade]):
        return lambda key: reduce(lambda a, b: a | b, [c.holds(key) for c in cascades])

    blocked = build_cascades(universe, named.where("action = 'block'"), bits_per_key, most_bytes)
    allowed = build_cascades(universe, named.where("action = 'allow'"), bits_per_key, most_bytes)
    on_list = build_cascades(urls.select(F.col("host").alias("key")), listed_hosts, bits_per_key, most_bytes)

    def first_fit(df: DataFrame, cascades: list[Cascade], name: str) -> DataFrame:
        """Longest key that a cascade holds, asking as many cascades in a pass as the limit on bytes allows."""
        for group in _grouped(cascades, most_bytes):
            hit = F.get(F.filter("_keys", fits(group)), 0)
            # The keys are in order of rank, so the place in the list compares two hits.
            rank = lambda key: F.coalesce(F.array_position("_keys", key), F.lit(1 << 30))
            if name in df.columns:
                df = stored(df, "urls")
                hit = F.when(rank(hit) < rank(F.col(name)), hit).otherwise(F.col(name))
            df = df.withColumn(name, hit)
        return df

    urls = first_fit(first_fit(urls, blocked, "_blocks"), allowed, "_allows")
    for i, group in enumerate(_grouped(on_list, most_bytes)):
        urls = stored(urls, "urls") if i else urls
        urls = urls.withColumn("_listed", (F.col("_listed") if i else F.lit(False)) | fits(group)(F.col("host")))
    place = lambda name: F.coalesce(F.nullif(F.array_position("_keys", F.col(name)), F.lit(0)), F.lit(1 << 30))
    block_wins = place("_blocks") <= place("_allows")
    rule = F.when(block_wins, F.col("_blocks")).otherwise(F.col("_allows"))
    return urls.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.when(rule.isNull(), F.when(F.col("_listed"), "block").otherwise("allow"))
        .when(block_wins, "block")
        .otherwise("allow")
        .alias("verdict"),
    )


def _grouped(cascades: list[Cascade], most_bytes: int) -> list[list[Cascade]]:
    groups: list[list[Cascade]] = [[]]
    for cascade in cascades:
        if groups[-1] and sum(c.bytes for c in groups[-1]) + cascade.bytes > 2 * most_bytes:
            groups.append([])
        groups[-1].append(cascade)
    return groups
