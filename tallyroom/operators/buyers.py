"""Exact distinct buyers of any period from stored days.

Distinct counts of days don't add up to those of a month, bitmaps of days do:
a day keeps one bit per buyer, in buckets of 32,768 neighbouring user ids, and
the bitmaps of days, or of several loads of one day, are combined by or.  A
user with very many orders is one bit per map task.  A bitmap takes 4 KB
however few of its ids bought, so ids should be dense, as serial numbers are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import COMPLETED


def buyer_bitmaps(orders: DataFrame) -> DataFrame:
    """``order_date``, ``bucket``, ``buyers``: who has a completed order on each day; orders without a user or a date count for nobody."""
    bought = orders.filter((F.col("order_status") == COMPLETED) & F.col("user_id").isNotNull() & F.col("order_date").isNotNull())
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("user_id"))
    return bought.groupBy("order_date", F.bitmap_bucket_number("user_id").alias("bucket")).agg(bits.alias("buyers"))


def merge_buyers(bitmaps: DataFrame) -> DataFrame:
    """One bitmap per day and bucket from any number of loads."""
    return bitmaps.groupBy("order_date", "bucket").agg(F.bitmap_or_agg("buyers").alias("buyers"))


def count_buyers(bitmaps: DataFrame, period: Column) -> DataFrame:
    """``period`` and its exact number of different ``buyers``, each bucket counted by itself."""
    per_bucket = bitmaps.groupBy(period.alias("period"), "bucket").agg(F.bitmap_count(F.bitmap_or_agg("buyers")).alias("buyers"))
    return per_bucket.groupBy("period").agg(F.sum("buyers").alias("buyers"))
