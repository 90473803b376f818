"""URL filter: rules by host and path, then a listing behind a blocked Bloom filter.

The filter's blocks are built by an aggregation and sent to the tasks; its size has a fixed bound.
It only passes possible hits on to the exact join, so a full filter costs time, never results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnweave.llm.frames import by_place
from turnweave.session import broadcast_if_small, materialize

#: Blocks of 64 bits: at most 8 MB of them, and about 16 bits for each listed URL below that.
MAX_BLOCKS = 1 << 20
KEYS_PER_BLOCK = 4
BITS_PER_KEY = 4
#: Keys that rows which cannot be listed are dealt to.
SPREAD = 4096

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the path, in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without slashes at its end, query without tracking fields.

    Null where the URL is null or has no host.
    """
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    fields = F.regexp_replace(F.regexp_extract(url, PARTS, 3), r"(^|&)(utm_[a-z]+|ref)=[^&]*", "")
    fields = F.regexp_replace(fields, "^&", "")
    query = F.when(fields != "", F.concat(F.lit("?"), fields)).otherwise(F.lit(""))
    return F.when(host != "", F.concat(host, path, query))


def section(url: Column) -> Column:
    """The part of a site that a URL belongs to: its host without ``www.`` or ``m.`` and the first piece of its
    path. Null where the URL is null or has no host."""
    host = F.regexp_replace(host_of(url), r"^(?:www|m)\.", "")
    return F.when(host != "", F.concat(host, F.lit("/"), F.regexp_extract(path_of(url), "^/([^/]*)", 1)))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct of its text and verdict; null if none does."""
    fitting = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        inside = (host == rule.host) | host.endswith(f".{rule.host}")
        value = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        fitting = F.when(inside & path.startswith(rule.path), value).otherwise(fitting)
    return fitting


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column) -> Column:
    """Some bits of a block, from a hash that does not share the block's."""
    bits = F.xxhash64(key, F.lit(1))
    mask = F.lit(0).cast("bigint")
    for i in range(BITS_PER_KEY):
        place = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return mask


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """Rows ``(block, bits)`` of the filter, one per block that has bits."""
    return (
        keys.select(_block(F.col(key), blocks).alias("block"), _mask(F.col(key)).alias("mask"))
        .groupBy("block")
        .agg(F.bit_or("mask").alias("bits"))
    )


def blocks_for(count: int) -> int:
    wanted = max(1, count // KEYS_PER_BLOCK)
    return min(MAX_BLOCKS, 1 << (wanted - 1).bit_length())


def with_listed(urls: DataFrame, listing: DataFrame, key: str, name: str = "listed") -> DataFrame:
    """Add whether ``key`` is one of the listing's values (its only column).

    Null keys are not listed; repeated listed values count once; an empty listing lists nothing.
    Rows keep their other columns, and ``name`` takes the place of a column of that name.
    """
    listing = materialize(listing.toDF("listed").where("listed IS NOT NULL").distinct(), "listed-urls")
    count = listing.count()
    urls = urls.drop(name) if name != key else urls
    if not count:
        return urls.withColumn(name, F.lit(False))
    blocks = blocks_for(count)
    bits = F.broadcast(bloom_blocks(listing, "listed", blocks))  # at most MAX_BLOCKS rows
    rows = by_place(urls)
    value = F.col(rows.columns[urls.columns.index(key)])
    tested = rows.withColumns({"at": _block(value, blocks), "mask": _mask(value)}).join(bits, (F.col("at") == F.col("block")) & value.isNotNull(), "left")
    possible = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))
    # Possible hits alone look for their value; the other rows are spread, so that none of them is a hot key.
    spread = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD)).cast("string"))
    tested = tested.select(*rows.columns, possible.alias("possible"), F.when(possible, value).otherwise(spread).alias("sought"))
    found = tested.join(broadcast_if_small(listing), F.col("sought") == F.col("listed"), "left")
    hit = F.col("possible") & F.col("listed").isNotNull()
    return found.select(*rows.columns, hit.alias("hit")).toDF(*urls.columns, name)


def filter_urls(pages: DataFrame, listing: DataFrame, rules: list[Rule], url: str = "url", key: Callable[[Column], Column] = canonical) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` (allow or block).

    The longest fitting rule decides. Without one, URLs whose ``key``, by default the canonical form, is
    listed are blocked; ``listing`` has one column of such keys. A null URL, or one without ``://``, has an
    empty host and path, fits no rule, is not listed and is allowed. Columns of the same names are replaced.
    """
    added = ("host", "path", "rule", "verdict")
    keep = [c for c in pages.columns if c.lower() not in added]
    address = F.col(f"`{url}`")
    judged = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"),
        key(address).alias("key"),
        host_of(address).alias("host"),
        path_of(address).alias("path"),
    )
    judged = judged.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    return with_listed(judged, listing, "key", "hit").select(
        *[F.col("row").getField(c).alias(c) for c in keep],
        "host",
        "path",
        F.col("rule.text").alias("rule"),
        F.coalesce("rule.verdict", F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"),
    )
