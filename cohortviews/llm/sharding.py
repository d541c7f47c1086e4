"""Sampled splitters: near-equal shards by bytes, cut from one global key order.

Records are ordered by (digest of the text, id), so equal texts lie together. Size-weighted samples of that order give
quantile boundaries; every range between two boundaries is measured, and ranges that came out overfull are sampled
again and subdivided, by id inside one hot key if need be. Ranges are the work units: each is sorted on its own, its
start in bytes and rows is a prefix sum over ranges, and the shard follows from the exact position in the order. The
result therefore does not depend on which samples were drawn.

A group of equal texts that is no larger than one range goes whole to the shard of its middle byte; a larger one is cut
where the shard boundary falls. Nothing is ever gathered for one shard: a slot is a position in the global order minus
the first position of the shard.

Nulls: a null text has size 16, checksum 0 and the digest of the empty text. A null id sorts first. Repeated rows are
kept, each with a slot of its own. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortviews.llm.common import slots_of, stage

#: Samples drawn for each boundary.
PER_RANGE = 16
#: Passes over overfull ranges at most; what is then still overfull is a single key and id, or a matter of balance only.
ROUNDS = 4
#: Lowest id: a boundary with it lies before all rows of its key.
FIRST = -(1 << 63)
#: Rows in a range, and the least number of ranges; groups of equal texts up to total / ranges bytes stay together.
RANGE_ROWS, LEAST_RANGES = 200_000, 2048


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, key, tie) of every row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.substring(F.md5(F.encode(text, "UTF-8")), 1, 16).alias("key"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST)).alias("tie"),
    )


def _range_of(bounds: list[tuple[str, int]]) -> Column:
    """Number of boundaries at or below (key, tie): a binary search in a literal array."""
    if not bounds:
        return F.lit(0)
    keys, ties = F.lit([b[0] for b in bounds]), F.lit([b[1] for b in bounds])
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def below(at: Column) -> Column:
        k = F.get(keys, at)
        return (k < F.col("key")) | ((k == F.col("key")) & (F.get(ties, at) <= F.col("tie")))

    return F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda at, step: F.when((at + step <= len(bounds)) & below(at + step - 1), at + step).otherwise(at),
    )


def _sample(rows: DataFrame, rate: Column, salt: int) -> list[tuple[str, int]]:
    """Keys drawn with a chance in proportion to size, in order. The draw depends on the record alone."""
    u = F.pmod(F.xxhash64("key", "tie", F.lit(salt)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    drawn = rows.filter(u < F.col("size") * rate).select("key", "tie")
    return sorted((r.key, r.tie) for r in drawn.toLocalIterator())


def splitters(rows: DataFrame, total: int, ranges: int) -> list[tuple[str, int]]:
    """Boundaries that leave few ranges above twice their share, not counting a range's largest record."""
    share = total / ranges
    drawn = _sample(rows, F.lit(PER_RANGE * ranges / total), 0)
    bounds = _boundaries(drawn[PER_RANGE - 1 :: PER_RANGE])
    for again in range(1, ROUNDS + 1):
        measured = rows.groupBy(_range_of(bounds).alias("range")).agg(
            (F.sum("size") - F.max("size")).alias("others")
        )
        full = measured.filter(F.col("others") > 2 * share).collect()  # few of the ranges
        if not full:
            break
        inside = rows.filter(_range_of(bounds).isin([r.range for r in full]))
        drawn = _sample(inside, F.lit(PER_RANGE * (1 << again) / share), again)
        more = set(_boundaries(drawn[PER_RANGE - 1 :: PER_RANGE])) - set(bounds)
        bounds = sorted(set(bounds) | more)
        if not more:
            break
    inside = {k for k, t in bounds if t > FIRST}
    if inside:  # a key within one share lies in one range
        of_key = rows.filter(F.col("key").isin(sorted(inside))).groupBy("key").agg(F.sum("size").alias("bytes"))
        light = {r.key for r in of_key.collect() if r.bytes * ranges <= total}
        bounds = [b for b in bounds if b[1] == FIRST or b[0] not in light]
    return bounds


def _boundaries(picked: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """A key picked once is cut before its first row, one picked several times also inside."""
    out: list[tuple[str, int]] = []
    for i, (key, tie) in enumerate(picked):
        again = i > 0 and picked[i - 1][0] == key
        out.append((key, tie) if again else (key, FIRST))
    return sorted(set(out))


def shard_by_bytes(docs: DataFrame, shards: int = 40, range_rows: int = RANGE_ROWS, least: int = LEAST_RANGES) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its shard and its gapless slot.

    Returns doc_id, size, text_crc32, shard, slot. Shard sizes differ from total / shards by no more than the two
    records or small groups that lie across the shard's ends.
    """
    rows = stage(sized(docs), "sized")
    seen = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    total, ranges = max(1, seen.bytes), slots_of(seen.n, range_rows, least)
    bounds = splitters(rows, total, ranges) if seen.n else []

    ranged = rows.withColumn("range", _range_of(bounds))
    starts = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    starts = starts.select(
        "range",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("range_byte"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("range_row"),
    )
    in_range = Window.partitionBy("range").orderBy("key", "tie", "size")
    group = Window.partitionBy("range", "key")
    inner = [b if b[1] > FIRST else ("", FIRST) for b in bounds]
    inner_keys = F.lit([k for k, _ in inner] or [""])
    cut = (F.get(inner_keys, F.col("range")) == F.col("key")) | (F.get(inner_keys, F.col("range") - 1) == F.col("key"))
    placed = (
        ranged.withColumn("until", F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(in_range).cast("long"))
        .withColumn("group_bytes", F.sum("size").over(group))
        .withColumn("group_until", F.max("until").over(group))
        .join(starts, "range")
        .withColumn("whole", ~F.coalesce(cut, F.lit(False)) & (F.col("group_bytes") * ranges <= total))
        .withColumn(
            "twice_middle",
            2 * F.col("range_byte")
            + F.when(F.col("whole"), 2 * F.col("group_until") - F.col("group_bytes")).otherwise(
                2 * F.col("until") - F.col("size")
            ),
        )
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.least(F.expr(f"twice_middle * {shards} div {2 * total}"), F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("range_row") + F.col("nth") - 1).alias("position"),
        )
    )
    placed = stage(placed, "placed")
    first = placed.groupBy("shard").agg(F.min("position").alias("first"))  # at most ``shards`` rows
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("position") - F.col("first")).alias("slot")
    )
