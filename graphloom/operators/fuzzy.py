"""Splitting large clusters of spellings: a similarity join on q-grams proposes pairs, and the greedy split is replayed on their graph."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from graphloom.plans.lineage import cut

Q = 2


def grams(text: Column) -> Column:
    """(len, grams) of texts with their words sorted, one blank between: each Q neighbouring characters with a number that tells repeated ones
    apart, and the whole text as one more."""

    def one(text: str) -> dict:
        s = " ".join(sorted(text.split()))
        seen: Counter[str] = Counter()
        out = []
        for k in range(len(s) - Q + 1):
            seen[s[k : k + Q]] += 1
            out.append(f"{s[k : k + Q]}{seen[s[k : k + Q]]}")
        return {"len": len(s), "grams": [*out, f"={s}"]}

    @F.pandas_udf("struct<len:int,grams:array<string>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(t or "") for t in texts], columns=["len", "grams"])

    return run(text)


def lost(length: Column, threshold: Column) -> Column:
    """How many grams of a text of some length a text as alike as threshold may lack at most.

    Of lengths l and m with a common subsequence of L, 2 L >= t (l + m). A character left out takes two grams along, one put in between takes
    one; for a given t the most are lost when only characters are left out, 2 l (1 - t) / (2 - t) of them.
    """
    return F.floor(4 * length * (1 - threshold) / (2 - threshold) + 1e-9).cast("int")


def similar_pairs(rows: DataFrame, score: Callable[[Column, Column], Column]) -> DataFrame:
    """(cluster, a, b, score) of rows(cluster, i, text, threshold): pairs a < b of i in a cluster that score 100 * threshold or more.

    score: a column of the two texts, the indel similarity of their sorted words in per cent. A pair so much alike shares one of the rarest
    grams of both (prefix filter), has lengths not too different and enough grams in common (count filter); only such pairs are scored. Where a threshold is so low that no gram need be
    shared, all pairs of that length are.
    """
    own = cut(rows.select("cluster", "i", "text", "threshold", grams(F.col("text")).alias("g")).select("cluster", "i", "text", "threshold", "g.*"))
    own = own.withColumn("most", lost(F.col("len"), F.col("threshold")))
    none = F.col("most") >= F.greatest(F.col("len") - Q + 1, F.lit(1))  # a text may be alike without a gram in common
    every = F.when(none, F.concat("grams", F.array(F.lit("")))).otherwise(F.col("grams"))
    each = own.select("cluster", "i", "len", "threshold", "most", F.explode(every).alias("gram"))
    counts = each.groupBy("cluster", "gram").agg(F.count("*").alias("n"))
    free = F.col("gram").startswith("=") & (F.col("gram") != "=") | (F.col("gram") == "")
    order = W.partitionBy("cluster", "i", free).orderBy("n", "gram")
    prefix = each.join(counts, ["cluster", "gram"]).withColumn("k", F.row_number().over(order)).where(free | (F.col("k") <= F.col("most") + 1))
    left, right = prefix.select("cluster", "gram", F.col("i").alias("a"), F.col("len").alias("la"), "threshold"), prefix.select("cluster", "gram", F.col("i").alias("b"), F.col("len").alias("lb"))
    near = 2 * F.least("la", "lb") >= F.col("threshold") * (F.col("la") + F.col("lb")) - 1e-9
    pairs = left.join(right, ["cluster", "gram"]).where((F.col("a") < F.col("b")) & near).select("cluster", "a", "b", "threshold").distinct()
    side = lambda i, *names: own.select("cluster", F.col("i").alias(i), *[F.col(c).alias(n) for c, n in zip(("text", "len", "grams"), names, strict=True)])
    met = pairs.join(side("a", "x", "n", "gx"), ["cluster", "a"]).join(side("b", "y", "m", "gy"), ["cluster", "b"])
    longer, shorter, least = F.greatest("n", "m"), F.least("n", "m"), F.ceil(F.col("threshold") * (F.col("n") + F.col("m")) / 2 - 1e-9)
    met = met.where(F.size(F.array_intersect("gx", "gy")) >= longer - Q + 1 - 2 * (longer - least) - (shorter - least))
    scored = met.select("cluster", "a", "b", "threshold", score(F.col("x"), F.col("y")).alias("score"))
    return scored.where(F.col("score") >= F.col("threshold") * 100).select("cluster", "a", "b", "score")


def greedy(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(cluster, i, seed, score) of nodes(cluster, i): in the order of i, each that is not taken yet is a seed and takes all later ones paired with it.

    A node is a seed once all earlier ones that are paired with it are known to be none; so rounds follow chains of pairs, few of which are long.
    Each round is cut from its lineage. A taken node belongs to its earliest seed; a seed to itself, with the score 100.
    """
    pairs, open_, seeds = cut(pairs), cut(nodes.select("cluster", "i")), None
    while not open_.isEmpty():
        ends = {c: open_.withColumnRenamed("i", c) for c in ("a", "b")}
        edges = pairs.select("cluster", "a", "b").join(ends["a"], ["cluster", "a"], "left_semi").join(ends["b"], ["cluster", "b"], "left_semi")
        new = cut(open_.join(edges.select("cluster", F.col("b").alias("i")).distinct(), ["cluster", "i"], "left_anti"))
        taken = pairs.join(new.withColumnRenamed("i", "a"), ["cluster", "a"]).select("cluster", F.col("b").alias("i"))
        open_ = cut(open_.join(new.unionByName(taken).distinct(), ["cluster", "i"], "left_anti"))
        seeds = new if seeds is None else seeds.unionByName(new)
    if seeds is None:
        return nodes.select("cluster", "i", F.col("i").alias("seed"), F.lit(100.0).alias("score"))
    owned = pairs.join(seeds.withColumnRenamed("i", "a"), ["cluster", "a"]).groupBy("cluster", F.col("b").alias("i")).agg(F.min(F.struct(F.col("a").alias("seed"), "score")).alias("o"))
    mine = seeds.select("cluster", "i", F.col("i").alias("seed"), F.lit(100.0).alias("score"))
    return mine.unionByName(owned.select("cluster", "i", "o.seed", "o.score"))
