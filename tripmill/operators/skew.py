"""Semi and anti joins that stay balanced when a few keys hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tripmill.operators.joins import lookup_join

# A key is hot when it has this many rows and this share of all rows.
HOT_ROWS = 1_000_000
HOT_SHARE = 0.01

# Frequent keys asked for, and counters kept per task to find them. With a hundred counters per
# wanted key the count of a key above the share is off by a few percent at most.
MOST_KEYS = 100
COUNTERS = 10_000


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def hot_hashes(df: DataFrame, keys: Sequence[str], min_rows: int | None = None,
               share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold a large share of the rows, at most a hundred.

    One pass over the key columns with a frequent-items summary per task; no key is shuffled.
    """
    min_rows = HOT_ROWS if min_rows is None else min_rows
    top = F.call_function("approx_top_k", _key_hash(keys), F.lit(MOST_KEYS), F.lit(COUNTERS))
    found = df.agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    bound = max(min_rows, share * found["n"])
    return [item["item"] for item in found["top"] or [] if item["count"] >= bound]


def filter_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str,
                min_rows: int | None = None) -> DataFrame:
    """``left_semi`` or ``left_anti`` join on equally named keys; null keys never match.

    The right side is reduced to distinct keys, within each task first. Rows of the left side
    whose key is hot are not shuffled: their few distinct partners are broadcast instead. The
    hash only decides which way a row takes; both ways compare whole keys, so the result is
    exact whatever the summary finds.
    """
    keys = list(keys)
    wanted = right.select(*keys)
    hot = hot_hashes(left, keys, min_rows)
    if not hot:
        return left.join(wanted.distinct(), keys, how)
    is_hot = _key_hash(keys).isin(hot)
    cold = left.where(~is_hot).join(wanted.where(~is_hot).distinct(), keys, how)
    return cold.unionByName(
        lookup_join(left.where(is_hot), wanted.where(is_hot).distinct(), keys, how))


def anti_insert(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target does not have."""
    return filter_join(source, target, keys, "left_anti")
