"""Mixing sources to target weights: temperature on token shares, realised as budgeted block permutations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from graphloom.llm.common import WORD, cut, id_of, pack, text_of, unpack

#: Above so many sources the per-source table is joined by shuffle, not broadcast.
BROADCAST_SOURCES = 10_000
#: Above so many chosen blocks they meet the rows in a shuffle join; a block takes some 60 bytes.
BROADCAST_BLOCKS = 200_000
STEPS = 60


def exponent(shares: Column, max_repeats: float | None, target_entropy: float | None) -> Column:
    """The exponent in [0, 1] found by bisection over an array of shares (each above 0, sum 1).

    With max_repeats: the smallest at which no source is passed more than that many times while every source is passed
    once at least. Else with target_entropy (nats): the largest whose weights have that entropy.
    Both measures fall as the exponent rises. A target out of reach gives the nearer end.
    """

    def fits(a: Column) -> Column:
        powered = F.transform(shares, lambda p: F.pow(p, a))
        if max_repeats is not None:
            epochs = F.transform(shares, lambda p: F.pow(p, a - 1))
            return F.array_max(epochs) <= F.lit(float(max_repeats)) * F.array_min(epochs)
        total = F.aggregate(powered, F.lit(0.0), lambda s, x: s + x)
        entropy = F.aggregate(powered, F.lit(0.0), lambda s, x: s - x / total * F.log(x / total))
        return entropy < F.lit(float(target_entropy))

    def step(interval: Column, _: Column) -> Column:
        middle = (interval["lo"] + interval["hi"]) / 2
        ok = fits(middle)
        return F.struct(F.when(ok, interval["lo"]).otherwise(middle).alias("lo"), F.when(ok, middle).otherwise(interval["hi"]).alias("hi"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi")), step)
    return F.when(fits(F.lit(0.0)), 0.0).otherwise(F.round(found["hi"], 9))


def number(digest: str) -> Column:
    """The first 32 bits of a hex digest as a long."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def running(blocks: DataFrame) -> DataFrame:
    """blocks with after: the tokens of a source and epoch up to and with a block, in the order of _o.

    Blocks are summed in about sqrt(n_blocks) ranges of _o first, so no window sees more than that many rows, however large the source.
    """
    ranges = F.ceil(F.sqrt("n_blocks"))
    blocks = blocks.withColumn("_range", F.shiftright(number("_o") * ranges, 32))
    every = W.partitionBy("source", "epoch").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    earlier = blocks.groupBy("source", "epoch", "_range").agg(F.sum("tokens").alias("_sum")).withColumn("_earlier", F.coalesce(F.sum("_sum").over(every), F.lit(0))).drop("_sum")
    own = W.partitionBy("source", "epoch", "_range").orderBy("_o", "block").rowsBetween(W.unboundedPreceding, 0)
    return blocks.withColumn("_within", F.sum("tokens").over(own)).join(earlier, ["source", "epoch", "_range"]).withColumn("after", F.col("_earlier") + F.col("_within"))


def source_weights(tokens: DataFrame, max_repeats: float | None = 2.0, target_entropy: float | None = None, budget_tokens: int | None = None) -> DataFrame:
    """Per source of tokens(source, n_tokens): tokens, n_docs, weight and budget (tokens to draw).

    Weights are the shares to the exponent, normalised. Without budget_tokens the budget is the least at which
    every source is passed once, so that nothing is lost. Sources without any token get weight and budget 0.
    """
    per = tokens.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs"))
    every = per.where(F.col("tokens") > 0).agg(F.sum("tokens").alias("total"), F.collect_list("tokens").alias("all"))
    shares = F.transform(F.array_sort("all"), lambda t: t / F.col("total"))
    every = every.select("total", exponent(shares, max_repeats, target_entropy).alias("a"), shares.alias("shares"))
    every = every.withColumn("norm", F.aggregate("shares", F.lit(0.0), lambda s, p: s + F.pow(p, F.col("a"))))
    per = per.crossJoin(F.broadcast(every))  # one row, one number a source
    share = F.col("tokens") / F.col("total")
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.col("a")) / F.col("norm")).otherwise(0.0)
    if budget_tokens is None:
        least = F.array_min(F.transform("shares", lambda p: F.pow(p, F.col("a") - 1)))
        budget = F.round(F.col("tokens") * F.pow(share, F.col("a") - 1) / least, 0)
    else:
        budget = F.round(F.lit(float(budget_tokens)) * weight, 0)
    return per.select("source", "tokens", "n_docs", weight.alias("weight"), F.when(F.col("tokens") > 0, budget).otherwise(0.0).cast("long").alias("budget"))


def temperature_mix(
    docs: DataFrame, max_repeats: float | None = 2.0, target_entropy: float | None = None, budget_tokens: int | None = None, block_docs: int = 256, seed: int = 17
) -> DataFrame:
    """Draw docs by temperature weights over their source; JVM expressions only.

    Returns a row for each drawn copy: the columns of docs and epoch (long, 0 first), block (long), n_tokens (long),
    mix_key (double in [0, 1)): sorted by mix_key, the copies of all sources interleave in proportion to their weights.
    Tokens are the words of the text. max_repeats or target_entropy chooses the exponent (see exponent()).

    Each source's rows are dealt by hash into blocks of about block_docs rows, however many that makes. Each pass over a source permutes its
    blocks. Full passes take all; the last takes blocks while the budget lasts, and of the block in which it ends the rows, in hash order,
    that fit. Rows without words are drawn once with every full pass, or once if their source has no tokens at all.

    Tokens are counted once for the weights and once for the rows drawn; texts stay where they are read unless the blocks are too many to
    broadcast. A null source is a source of its own, named ''. Repeated rows are dealt apart. An empty table gives an empty one.
    """
    tokens = F.regexp_count("_text", F.lit(WORD)).cast("long")
    base = pack(docs, source=F.coalesce(F.col("source").cast("string"), F.lit("")), _text=text_of(), _d=id_of())
    base = base.withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_d").cast("string")))).withColumn("_place", number("_h"))
    narrow = cut(base.select("source", "_place", tokens.alias("n_tokens")))
    weights = source_weights(narrow, max_repeats, target_entropy, budget_tokens)
    weights = weights.withColumns({"n_blocks": F.ceil(F.col("n_docs") / block_docs), "full": F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.greatest("tokens", F.lit(1)))).otherwise(1)})
    weights = cut(weights.withColumn("left", F.col("budget") - F.col("full") * F.col("tokens")))
    few = weights.count() <= BROADCAST_SOURCES
    places = F.broadcast(weights.select("source", "n_blocks")) if few else weights.select("source", "n_blocks")
    dealt = lambda df: df.join(places, "source").withColumn("block", F.col("_place") % F.col("n_blocks")).drop("n_blocks", "_place")

    blocks = dealt(narrow).groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens")).join(weights.select("source", "n_blocks", "full", "left", "budget"), "source")
    blocks = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("left") > 0, F.col("full")).otherwise(F.col("full") - 1))))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), "source", F.col("block").cast("string"), F.col("epoch").cast("string")))
    blocks = running(blocks.withColumn("_o", order))
    before, room = F.col("after") - F.col("tokens"), F.col("left") - (F.col("after") - F.col("tokens"))
    whole = (F.col("epoch") < F.col("full")) | (F.col("after") <= F.col("left"))
    per_pass = F.greatest(F.col("budget") - F.col("left"), F.lit(0)) / F.greatest("full", F.lit(1))  # tokens of one full pass
    key = F.when(F.col("budget") > 0, (F.col("epoch") * per_pass + before) / F.col("budget")).otherwise(0.0)
    blocks = cut(blocks.where(whole | (room > 0)).select("source", "block", "epoch", F.when(whole, F.lit(None)).otherwise(room).alias("room"), F.round(key, 9).alias("mix_key")))

    full, ends = blocks.where("room is null").drop("room"), blocks.where("room is not null")
    if blocks.count() <= BROADCAST_BLOCKS:
        full, ends = F.broadcast(full), F.broadcast(ends)
    rows = dealt(base)
    drawn = rows.join(full, ["source", "block"]).withColumn("n_tokens", tokens)
    edge = rows.join(ends, ["source", "block"]).withColumn("n_tokens", tokens).withColumn("_x", F.xxhash64("_text"))
    edge = edge.withColumn("_n", F.sum("n_tokens").over(W.partitionBy("source", "block", "epoch").orderBy("_h", "_x").rowsBetween(W.unboundedPreceding, 0)))
    edge = edge.where((F.col("_n") <= F.col("room")) & (F.col("n_tokens") > 0))
    out = drawn.select("_row", "epoch", "block", "n_tokens", "mix_key").union(edge.select("_row", "epoch", "block", "n_tokens", "mix_key"))
    return unpack(out, docs.columns, epoch=F.col("epoch"), block=F.col("block"), n_tokens=F.col("n_tokens"), mix_key=F.col("mix_key"))
