"""Samples and splits that depend on nothing but keys and a seed: md5 of both orders the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Digits that one pass of cut_after() looks at.
DIGITS = 3


def draw(seed: int, *keys: Column) -> Column:
    """A text in random order for each seed."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]))


def bucket(n: int, seed: int, *keys: Column) -> Column:
    """A number from 0 to n - 1."""
    return F.conv(F.substring(draw(seed, *keys), 1, 8), 16, 10).cast("long") % n


def negatives(annotations: DataFrame, paragraphs: DataFrame, ratio: int, seed: int, min_letters: int = 30, skip_pages: int = 3) -> DataFrame:
    """ratio paragraphs for each annotation (ann_id, pdf_name, pages array<int>), on pages it does not name, with label 0.

    The first skip_pages pages of a report are left out.
    """
    from ..functions.text import letters

    able = paragraphs.where((F.col("page0") >= skip_pages) & (letters(F.col("text")) >= min_letters))
    met = annotations.join(able, "pdf_name").where(~F.array_contains("pages", F.col("page0")))
    order = draw(seed, F.col("ann_id"), F.col("page0"), F.col("para_idx"))
    rank = F.row_number().over(Window.partitionBy("ann_id").orderBy(order, "page0", "para_idx"))
    return met.withColumn("_k", rank).where(F.col("_k") <= ratio).select("ann_id", "pdf_name", "page0", "para_idx", F.col("text").alias("context"), F.lit(0).alias("label"))


def split(df: DataFrame, dev_share: float, seed: int, *keys: str) -> DataFrame:
    """df with split 'train' or 'dev': rows with equal keys stay together."""
    part = bucket(1_000_000, seed, *map(F.col, keys))
    return df.withColumn("split", F.when(part < round(dev_share * 1_000_000), "dev").otherwise("train"))


def split_exactly(df: DataFrame, dev_share: float, seed: int, *keys: str) -> DataFrame:
    """df with split: of its distinct keys, in random order, the first whole number below the train share's are 'train'.

    A share of 0 makes all of them 'train'. A key's draw alone decides, so the rows are neither sorted nor joined: see cut_after().
    """
    own = draw(seed, *map(F.col, keys))
    draws = df.select(own.alias("_draw")).distinct()
    cut = cut_after(draws, int((1 - dev_share) * draws.count()))
    return df.withColumn("split", F.when(F.lit(True) if cut is None else own < cut, "train").otherwise("dev"))


def cut_after(draws: DataFrame, n: int) -> str | None:
    """A text that exactly the n smallest of distinct draws (_draw, hexadecimal digits) are below; None if there are no more than n.

    Draws are counted by their first DIGITS digits, then those of the one prefix that holds the cut by the next ones, until the
    cut falls between prefixes. Each pass brings 16**DIGITS counts to the driver at most, whatever the number of draws.
    """
    prefix, left = "", n
    while True:
        size = len(prefix) + DIGITS
        counts = draws.where(F.col("_draw").startswith(prefix)).groupBy(F.substring("_draw", 1, size).alias("p")).count().collect()
        for p, c in sorted(counts):
            if left == 0:
                return p
            if c > left:
                prefix = p
                break
            left -= c
        else:  # all of the prefix's draws are below the cut, so it is the whole table
            return None


def fold(df: DataFrame, k: int, seed: int, *keys: str) -> DataFrame:
    """df with fold 0 to k - 1."""
    return df.withColumn("fold", bucket(k, seed, *map(F.col, keys)).cast("int"))
