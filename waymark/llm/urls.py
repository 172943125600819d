"""URL filter: rules by host and path, then a list of canonical URLs behind a blocked Bloom filter and an exact hash join.

The Bloom filter is cut into blocks of ``BLOCK_WORDS`` 64-bit words. A URL's hash picks one block and one bit in each of its words, so
a probe touches one block. It is built by an OR of bits per block; its number of blocks follows the list's length up to
``MAX_BLOCKS`` (then it lets more through, never less), so its size is bounded and it is sent to the tasks. Only URLs that it
lets through are joined with the list, on the canonical URL itself, which removes its errors. The list is distinct, so the join
neither multiplies nor loses rows, and a URL that many pages share is a skewed key of a plain join, which Spark splits.

A rule (host, path) fits its host and all subdomains if the URL's path begins with its own; of those that fit the longest
decides. Without a rule, a listed URL is blocked and any other is allowed.

A null URL, and one without ``://``, has empty host and path and no canonical URL: no rule fits, it is not listed, it is allowed.
Rows are judged one by one; an empty list or table is fine; other columns are kept, but for those named like the results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


BLOCK_WORDS = 4
BITS_PER_URL = 16
MAX_BLOCKS = 1 << 19  # 16 MB
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Query parameters that do not change the page.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"
RESULTS = ("host", "path", "rule", "canonical", "listed", "verdict")


def after_scheme(url: str = "url") -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)"))


def host(url: str = "url") -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: str = "url") -> Column:
    """Host without ``www.``, path without its last slash, and the sorted parameters that are not tracking; no fragment. Null without a host."""
    query = F.regexp_extract(after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    base = F.concat(F.regexp_replace(host(url), r"^www\.", ""), F.regexp_replace(path(url), "/$", ""))
    whole = F.when(F.size(kept) > 0, F.concat(base, F.lit("?"), F.array_join(kept, "&"))).otherwise(base)
    return F.when(host(url) != "", whole)


def rule_of(rules: list[tuple[str, str, str]], host_column: str = "host", path_column: str = "path") -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null. ``rules``: (verdict, host, path)."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    h, p = F.col(host_column), F.col(path_column)
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((h == rule_host) | h.endswith("." + rule_host)) & p.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


class BlockedBloom:
    """Blocks of 64-bit words; a key sets one bit in each word of one block."""

    def __init__(self, keys: DataFrame):
        """``keys``: distinct column canonical."""
        count = keys.count()
        blocks = min(MAX_BLOCKS, 1 << max(4, (BITS_PER_URL * count // (64 * BLOCK_WORDS)).bit_length()))
        h = F.xxhash64("canonical")
        bits = [F.expr(f"shiftleft(1L, int(shiftrightunsigned(xxhash64(canonical, 1), {6 * k}) & 63))") for k in range(BLOCK_WORDS)]
        rows = keys.groupBy(h.bitwiseAND(blocks - 1).alias("block")).agg(*(F.bit_or(b).alias(f"w{k}") for k, b in enumerate(bits))).collect()
        self.words = np.zeros((blocks, BLOCK_WORDS), np.uint64)
        for row in rows:
            self.words[row.block] = np.array(row[1:], np.int64).view(np.uint64)

    def may_hold(self, block_hash: np.ndarray, bit_hash: np.ndarray) -> np.ndarray:
        own = self.words[(block_hash & np.uint64(len(self.words) - 1)).astype(np.int64)]
        ok = np.ones(len(own), bool)
        for k in range(BLOCK_WORDS):
            ok &= (own[:, k] >> ((bit_hash >> np.uint64(6 * k)) & np.uint64(63))) & np.uint64(1) == 1
        return ok


def judged(pages: DataFrame, rules: list[tuple[str, str, str]], listed: DataFrame) -> DataFrame:
    """``pages`` (url, ...) with host, path, rule, canonical, listed and verdict. ``listed``: canonical URLs (column canonical)."""
    keys = listed.select("canonical").filter("canonical is not null").distinct()
    shared = pages.sparkSession.sparkContext.broadcast(BlockedBloom(keys))
    rows = pages.select(*(f"`{c}`" for c in pages.columns if c not in RESULTS))
    rows = rows.withColumns({"host": host(), "path": path(), "canonical": canonical()})
    rows = rows.withColumns({"_a": F.xxhash64("canonical"), "_b": F.xxhash64("canonical", F.lit(1))})

    def probe(batches):
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("_a", "_b"))
            hit = pa.array(shared.value.may_hold(a, b))
            yield pa.RecordBatch.from_arrays([*batch.columns, hit], [*batch.schema.names, "_hit"])

    rows = rows.mapInArrow(probe, StructType([*rows.schema.fields]).add("_hit", "boolean"))
    hit = F.col("_hit") & F.col("canonical").isNotNull()
    sure = rows.filter(hit).join(keys.withColumn("listed", F.lit(True)), "canonical", "left")
    rows = rows.filter(~hit).withColumn("listed", F.lit(False)).unionByName(sure).withColumn("listed", F.coalesce("listed", F.lit(False)))
    rule = rows.withColumn("_rule", rule_of(rules))
    verdict = F.coalesce("_rule.verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return rule.withColumns({"rule": F.col("_rule.rule"), "verdict": verdict}).drop("_a", "_b", "_hit", "_rule")
