"""Mixing sources to target weights, in blocks of fixed length.

The words of a source are laid end to end, its documents in a hashed order, and packed into blocks of ``block_words``.
Weights and sizes give each source a quota of blocks. Every output shard draws the source of each of its slots from the
quota shares, so the counts of a shard are multinomial; draws past a source's quota go to sources that fell short. The
j-th slot of a source reads block permutation(j mod blocks) of its epoch j div blocks, a keyed bijection on the block
numbers, and slots meet blocks in one join by (source, block). No source is read by one task: its running sums are
taken inside hashed slices with a prefix sum over slices.

A quota never passes three times the source's blocks, so no document is taken more than three times. Source totals are
collected, one row for each source (a dimension: names of sources, never documents).

Nulls: a null source is a source of its own, last in order; a null text has no words. Repeated rows are documents of
their own. Documents without words take no part and have taken = 0. No rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortviews.llm.common import WORD, slots_of, stage, word_count

BLOCK_WORDS = 128
SHARD_SLOTS = 2048
SLICE_ROWS, LEAST_SLICES = 20_000, 256
WEIGHTS = (5, 2, 1)
MOST = 3
BITS = 1 << 52


@dataclass
class Source:
    name: str | None
    size: int
    target: float = 0.0
    blocks: int = 0
    quota: int = 0


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> list[Source]:
    """Sources by code point, null last, with their targets: shares by weight, at most ``most`` times the size."""
    out = [Source(n, s) for n, s in sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode()))]
    weight = {i: weights[i % len(weights)] for i in range(len(out))}
    total, held = sum(s.size for s in out), set()
    while True:
        free = [i for i in range(len(out)) if i not in held]
        rest = total - sum(most * out[i].size for i in held)
        over = []
        for i in free:
            out[i].target = rest * weight[i] / sum(weight[j] for j in free)
            if out[i].target > most * out[i].size:
                over.append(i)
        for i in over:
            out[i].target = float(most * out[i].size)
        held |= set(over)
        if not over:
            return out


def plan(sizes: list[tuple[str | None, int]], block_words: int) -> list[Source]:
    out = targets(sizes)
    for s in out:
        s.blocks = -(-s.size // block_words)
        s.quota = min(MOST * s.blocks, round(s.target * s.blocks / s.size)) if s.size else 0
    return out


def permuted(i: Column, n: Column, *key: Column, rounds: int = 4) -> Column:
    """Keyed bijection on 0 .. n - 1: a Feistel network on a grid of a x b >= n cells, walked until inside.

    a = floor(sqrt(n)), b = ceil(n / a), so fewer than a cells lie outside and a walk leaves them at once or nearly so;
    no walk can be longer than the number of cells outside, and for any n beyond 64 x 64 a walk of 64 steps has a chance below 1e-115.
    """
    a = F.floor(F.sqrt(n.cast("double"))).cast("long")
    b = F.ceil(n / a).cast("long")

    def once(x: Column) -> Column:
        halves = F.struct((x % a).alias("l"), F.floor(x / a).cast("long").alias("r"))
        mixed = F.aggregate(
            F.lit(list(range(rounds))),
            halves,
            lambda h, k: F.when(
                k % 2 == 0, F.struct(F.pmod(h["l"] + F.pmod(F.xxhash64(h["r"], k, *key), a), a).alias("l"), h["r"].alias("r"))
            ).otherwise(F.struct(h["l"].alias("l"), F.pmod(h["r"] + F.pmod(F.xxhash64(h["l"], k, *key), b), b).alias("r"))),
        )
        return mixed["r"] * a + mixed["l"]

    walk = F.aggregate(F.lit(list(range(64))), once(i), lambda x, _: F.when(x < n, x).otherwise(once(x)))
    return F.when(n > 0, walk)


def _laid(docs: DataFrame, names: list[str], rows: int) -> DataFrame:
    """``docs`` (doc_id, source, size, order, ...) with s, the number of its source, and from, its first word in it."""
    slices = slots_of(rows, SLICE_ROWS, LEAST_SLICES)
    s = F.when(F.col("source").isNull(), len(names)).otherwise(F.array_position(F.lit(names or [""]), F.col("source")) - 1)
    docs = docs.withColumns({"s": s.cast("int"), "slice": F.pmod(F.xxhash64("order"), F.lit(slices))})
    sums = docs.groupBy("s", "slice").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("s").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("s", "slice", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("slice_from"))
    inside = Window.partitionBy("s", "slice").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    return (
        docs.withColumn("until", F.sum("size").over(inside))
        .join(sums, ["s", "slice"])
        .withColumn("from", F.col("slice_from") + F.col("until") - F.col("size"))
        .drop("slice", "slice_from", "until")
    )


def _order() -> Column:
    return F.xxhash64("doc_id", "text")


def _pieces(laid: DataFrame, block_words: int) -> DataFrame:
    """(s, from, block, at, n): the words at .. at + n of a document that lie in a block of its source."""
    start, end = F.col("from"), F.col("from") + F.col("size")
    cut = laid.filter("size > 0").select(
        "s",
        "from",
        end.alias("end"),
        F.explode(F.sequence(F.expr(f"`from` div {block_words}"), F.expr(f"(`from` + size - 1) div {block_words}"))).alias("block"),
    )
    at = F.greatest(start, F.col("block") * block_words)
    until = F.least(F.col("end"), (F.col("block") + 1) * block_words)
    return cut.select("s", "from", "block", (at - start).alias("at"), (until - at).alias("n"))


def count_until(values: list[int], x: Column) -> Column:
    """How many of the ascending ``values`` are at most ``x``."""
    return F.size(F.filter(F.lit(values), lambda v: v <= x)) if values else F.lit(0)


def _drawn(spark, sources: list[Source], seed: int) -> DataFrame:
    """(s, block, epoch, shard): every slot of the mix with the block that it reads."""
    quota = [s.quota for s in sources]
    total = sum(quota)
    until = [sum(quota[: i + 1]) for i in range(len(quota))]
    u = F.pmod(F.xxhash64("id", F.lit(seed), F.lit("draw")), F.lit(BITS)) / F.lit(float(BITS))
    slots = spark.range(total).select(
        "id", F.expr(f"id div {SHARD_SLOTS}").alias("shard"), count_until(until, F.floor(u * total)).alias("s")
    )
    counts = slots.groupBy("shard", "s").agg(F.count("*").alias("n"))  # multinomial, a row for each shard and source
    got_rows = {r.s: r.n for r in counts.groupBy("s").agg(F.sum("n").alias("n")).collect()}  # one row for each source
    got = [got_rows.get(i, 0) for i in range(len(quota))]
    over = [max(0, g - q) for g, q in zip(got, quota)]
    short = [max(0, q - g) for g, q in zip(got, quota)]
    over_from = [sum(over[:i]) for i in range(len(over))]
    short_from = [sum(short[:i]) for i in range(len(short))]
    short_until = [sum(short[: i + 1]) for i in range(len(short))]

    before = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "s", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_from"))
    inside = Window.partitionBy("shard", "s").orderBy("id")

    def of(values: list[int], s: Column) -> Column:
        return F.get(F.lit([int(v) for v in values] or [0]), s)

    j, s = F.col("j"), F.col("s")
    placed = (
        slots.withColumn("nth", F.row_number().over(inside))
        .join(counts, ["shard", "s"])
        .withColumn("j", F.col("shard_from") + F.col("nth") - 1)
        .withColumn("spare", F.when(j >= of(quota, s), of(over_from, s) + j - of(quota, s)))
        .withColumn("to", F.when(F.col("spare").isNull(), s).otherwise(count_until(short_until, F.col("spare"))))
        .withColumn(
            "j",
            F.when(F.col("spare").isNull(), j).otherwise(
                of(got, F.col("to")) + F.col("spare") - of(short_from, F.col("to"))
            ),
        )
    )
    n = of([x.blocks for x in sources], F.col("to")).cast("long")
    epoch = F.floor(j / n).cast("int")
    block = permuted(j % n, n, F.lit(seed), F.col("to"), F.col("epoch"))
    return placed.withColumn("epoch", epoch).select(F.col("to").alias("s"), block.alias("block"), "epoch", "shard")


def _measured(docs: DataFrame) -> tuple[list[Source], int]:
    per_source = docs.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    return [(r.source, r.size) for r in per_source], sum(r.n for r in per_source)


def mix_counts(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 17) -> DataFrame:
    """How much of each document the mix takes: doc_id, size, source_size, target, taken."""
    spark = docs.sparkSession
    worded = stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _order().alias("order")), "worded")
    sizes, rows = _measured(worded)
    sources = plan(sizes, block_words)
    laid = stage(_laid(worded, [s.name for s in sources if s.name is not None], rows), "laid")
    times = _drawn(spark, sources, seed).groupBy("s", "block").agg(F.count("*").alias("times"))
    taken = (
        _pieces(laid, block_words)
        .join(times, ["s", "block"])
        .groupBy("s", "from")
        .agg(F.sum(F.col("n") * F.col("times")).alias("taken"))
    )
    s = F.col("s")
    return (
        laid.withColumn("from", F.when(F.col("size") > 0, F.col("from")))
        .join(taken, ["s", "from"], "left")
        .select(
            "doc_id",
            "size",
            F.get(F.lit([x.size for x in sources] or [0]), s).cast("long").alias("source_size"),
            F.get(F.lit([x.target for x in sources] or [0.0]), s).alias("target"),
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 17) -> DataFrame:
    """The mix as documents: for each epoch that draws from a document, a row with the words taken.

    The text of a wholly taken document is unchanged; else its taken pieces in their order, each word with the white
    space after it. Same columns as ``docs``; n_chars, if there, is the length of the new text.
    """
    spark = docs.sparkSession
    columns = docs.columns
    row = F.struct(*[F.col(c) for c in columns]).alias("row")
    worded = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _order().alias("order"), row)
    narrow = stage(worded.drop("row"), "worded")
    sizes, rows = _measured(narrow)
    sources = plan(sizes, block_words)
    names = [s.name for s in sources if s.name is not None]
    takes = (
        _pieces(_laid(narrow, names, rows), block_words)
        .join(_drawn(spark, sources, seed), ["s", "block"])
        .groupBy("s", "from", "epoch")
        .agg(F.sum("n").alias("words"), F.sort_array(F.collect_list(F.struct("at", "n"))).alias("parts"))
    )
    tokens = F.regexp_extract_all(F.col("row.text"), F.lit(f"({WORD}[\\x20\\x09-\\x0D]*)"), F.lit(1))
    cut = F.array_join(
        F.flatten(
            F.transform("parts", lambda p: F.slice(F.col("tokens"), (p["at"] + 1).cast("int"), p["n"].cast("int")))
        ),
        "",
    )
    whole = F.col("words") == F.col("size")
    out = (
        _laid(worded, names, rows)
        .filter("size > 0")
        .join(takes, ["s", "from"])
        .withColumn("tokens", F.when(~whole, tokens))
        .withColumn("mixed", F.when(whole, F.col("row.text")).otherwise(cut))
    )
    made = {"text": F.col("mixed"), "n_chars": F.length("mixed").cast("long")}
    return out.select(*[made.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns])
