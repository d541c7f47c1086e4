"""Spelling variants: words one edit apart, grouped by following each to its much more frequent neighbour.

Words are counted in Spark over all texts. Two words one edit apart have letter counts at a squared distance of at most
two, and lengths at most one apart. Letters are dealt into ``GROUPS`` groups of about equal weight; the counts of the
groups name the block of a word, and their sum is its length. One edit moves a word to its own block, to one with a
letter less, or to one with a letter of one group exchanged for one of another, so each word visits only those blocks,
and each pair meets once. In a block the letter counts of residents and visitors are multiplied as NumPy matrices: the
Gram matrix gives all squared distances, pairs at most two apart are kept, and their letters decide.

A block with more than ``BLOCK_WORDS`` residents, or with very many visitors, becomes tiles of a bounded number of both;
a task keeps the residents of one tile and streams its visitors, so its memory does not depend on the block.

Nulls: a null text has no words. A null id hashes as the empty string. Repeated rows count as often as they occur. Equal
counts go to the word first in code-point order. No rows give no rows. Words of any length take part; counts of letters
beyond 4,000 are multiplied in double precision, which holds them exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortviews.llm.common import stage
from cohortviews.session import small_side

#: Words are runs of these, all of one byte in Latin-1.
LETTERS = r"A-Za-zÀ-ÿ"
ALPHABET = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GROUPS = 6
BLOCK_WORDS, TILE_VISITORS = 2048, 1 << 17
#: One in so many occurrences loses a letter.
SLIPS = 31


def occurrences(docs: DataFrame, least: int) -> DataFrame:
    """word: every run of at least ``least`` letters of every text, with its slip, if any."""
    runs = F.explode(F.regexp_extract_all(F.col("text"), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0)))
    id_ = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    low = docs.select(id_.alias("id"), runs.alias("run")).select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.encode(F.concat("id", "run"), "UTF-8"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    hashed = low.select("run", h.alias("h"))
    return hashed.select(F.when(F.col("h") % SLIPS == 0, cut).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= least)


def vocabulary(docs: DataFrame, least: int = 7, least_n: int = 2) -> DataFrame:
    """(word, n) of the words of at least ``least`` letters that occur ``least_n`` times or more."""
    return occurrences(docs, least).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_n)


def letter_groups(words: DataFrame) -> np.ndarray:
    """The group of each Latin-1 code, balanced by how many letters of all words it holds (a count for each code)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(256, np.int64)
        for batch in batches:
            for word in batch.column(0).to_pylist():
                held += np.bincount(np.frombuffer(word.encode("latin-1"), np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(held)], ["code", "n"])

    rows = words.select("word").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    n = {r.code: r.n for r in rows}
    groups, weight = np.zeros(256, np.int64), np.zeros(GROUPS)
    for code in sorted(ALPHABET, key=lambda c: (-n.get(c, 0), c)):
        groups[code] = weight.argmin()
        weight[groups[code]] += max(n.get(code, 0), 1)
    return groups


def block_keys(counts: np.ndarray) -> np.ndarray:
    """A long for each row of group counts: the counts side by side, or a hash where one has over ten bits."""
    key = np.zeros(len(counts), np.uint64)
    for g in range(GROUPS):
        key = (key << np.uint64(10)) | counts[:, g].astype(np.uint64)
    for i in np.flatnonzero((counts >> 10).any(1)):
        key[i] = xxhash.xxh64_intdigest(counts[i].tobytes()) | (1 << 63)
    return key.view(np.int64)


RESIDENT, FROM_HERE, FROM_ELSEWHERE = 0, 1, 2


def visits(words: DataFrame, groups: np.ndarray) -> DataFrame:
    """(block, role, word, n): each word as resident of its block, and as visitor of all blocks that it may be near to."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                raw = [w.encode("latin-1") for w in part.column(0).to_pylist()]
                of = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
                letters = groups[np.frombuffer(b"".join(raw), np.uint8)]
                own = np.bincount(of * GROUPS + letters, minlength=len(raw) * GROUPS).reshape(-1, GROUPS)
                everyone, here = np.arange(len(raw)), block_keys(own)
                sent = [(here, RESIDENT, everyone), (here, FROM_HERE, everyone)]
                for g in range(GROUPS):
                    who = np.flatnonzero(own[:, g])
                    less = own[who]
                    less[:, g] -= 1
                    sent.append((block_keys(less), FROM_ELSEWHERE, who))  # a letter less
                    for other in range(g + 1, GROUPS):  # a letter of a later group instead; the other way round, the other visits
                        moved = less.copy()
                        moved[:, other] += 1
                        sent.append((block_keys(moved), FROM_ELSEWHERE, who))
                take = pa.array(np.concatenate([who for _, _, who in sent]))
                role = np.concatenate([np.full(len(who), role, np.int32) for _, role, who in sent])
                block = np.concatenate([keys for keys, _, _ in sent])
                columns = [pa.array(block), pa.array(role), part.column(0).take(take), part.column(1).take(take)]
                yield pa.RecordBatch.from_arrays(columns, ["block", "role", "word", "n"])

    return words.select("word", "n").mapInArrow(send, "block long, role int, word string, n long")


def _tiled(sent: DataFrame) -> DataFrame:
    """``sent`` with tile: residents of a crowded block are dealt into rows of tiles, its visitors into columns of tiles."""
    sizes = sent.groupBy("block").agg(F.count_if(F.col("role") == RESIDENT).alias("residents"), F.count_if(F.col("role") != RESIDENT).alias("visitors"))
    sizes = sizes.filter("residents > 0").select(
        "block",
        F.ceil(F.col("residents") / BLOCK_WORDS).cast("int").alias("down"),
        F.ceil(F.col("visitors") / TILE_VISITORS).cast("int").alias("across"),
    )
    crowded = small_side(stage(sizes.filter("down > 1 or across > 1"), "crowded"))
    placed = sent.join(crowded, "block", "left").withColumns(
        {"down": F.coalesce("down", F.lit(1)), "across": F.coalesce("across", F.lit(1))}
    )
    mine = F.xxhash64("word")
    row, column = F.pmod(mine, F.col("down")).cast("int"), F.pmod(mine, F.col("across")).cast("int")
    to_row = F.when(F.col("role") == RESIDENT, F.array(row)).otherwise(F.sequence(F.lit(0), F.col("down") - 1))
    to_column = F.when(F.col("role") != RESIDENT, F.array(column)).otherwise(F.sequence(F.lit(0), F.col("across") - 1))
    tiles = placed.select("block", "role", "word", "n", F.explode(to_row).alias("down"), to_column.alias("columns"))
    return tiles.select("block", "down", F.explode("columns").alias("across"), "role", "word", "n")


class Words:
    """Words as padded letters, from the left and from the right, and as counts of letters."""

    def __init__(self, words: list[str]):
        raw = [w.encode("latin-1") for w in words]
        self.words = words
        self.size = np.fromiter(map(len, raw), np.int64, len(raw))
        wide = int(self.size.max(initial=0))
        left = np.array(raw, f"S{max(wide, 1)}").view(np.uint8).reshape(len(raw), -1)
        self.left = left
        self.right = np.array([r[::-1] for r in raw], f"S{max(wide, 1)}").view(np.uint8).reshape(len(raw), -1)
        row, col = np.nonzero(left)
        codes, of = np.unique(left[row, col], return_inverse=True)
        kind = np.float32 if wide <= 4000 else np.float64
        self.codes = codes
        self.counts = np.bincount(row * len(codes) + of, minlength=len(raw) * len(codes)).reshape(len(raw), -1).astype(kind)


def _aligned(a: Words, b: Words) -> tuple[np.ndarray, np.ndarray]:
    """Counts of both over the letters that either has."""
    codes = np.union1d(a.codes, b.codes)
    out = []
    for x in (a, b):
        wide = np.zeros((len(x.words), len(codes)), np.result_type(a.counts, b.counts))
        wide[:, np.searchsorted(codes, x.codes)] = x.counts
        out.append(wide)
    return out[0], out[1]


def one_edit(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Which pairs (a[i], b[j]) differ by exactly one inserted, deleted or replaced letter."""
    wide = max(a.left.shape[1], b.left.shape[1])

    def same(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Letters that agree from the start."""
        shared = min(x.shape[1], y.shape[1])
        differ = np.ones((len(i), wide + 1), bool)
        differ[:, :shared] = x[i, :shared] != y[j, :shared]
        return differ.argmax(1)

    shorter = np.minimum(a.size[i], b.size[j])
    front = np.minimum(same(a.left, b.left), shorter)
    back = np.minimum(same(a.right, b.right), shorter)
    apart = np.abs(a.size[i] - b.size[j])
    replaced = (apart == 0) & (front + back == shorter - 1)
    return replaced | ((apart == 1) & (front + back >= shorter))


def near(residents: Words, visitors: Words) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (resident, visitor) one edit apart, by the Gram matrix of their letter counts and then by their letters."""
    x, y = _aligned(residents, visitors)
    square = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    i, j = np.nonzero((square <= 2) & (square > 0))
    out = []
    step = max(1, (1 << 24) // (residents.left.shape[1] + visitors.left.shape[1]))
    for at in range(0, len(i), step):
        out.append(one_edit(residents, i[at : at + step], visitors, j[at : at + step]))
    keep = np.concatenate(out) if out else np.zeros(0, bool)
    return i[keep], j[keep]


PAIRS = "a string, a_n long, b string, b_n long"


def _slices(words: list[str], most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of at most 1,024 words whose padded letters stay below ``most`` bytes (one word at least)."""
    at = 0
    while at < len(words):
        end, wide = at, 0
        while end < len(words) and end - at < 1024:
            wider = max(wide, len(words[end]))
            if end > at and wider * (end - at + 1) > most:
                break
            end, wide = end + 1, wider
        yield at, end
        at = end


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each tile: rows sorted by block, tile and role; residents are kept, visitors stream past them."""
    tile, own, own_n, parts = None, [], [], []
    for batch in batches:
        block, down, across, role, n = (batch.column(c).to_numpy() for c in (0, 1, 2, 3, 5))
        word = batch.column(4).to_pylist()
        new = np.ones(len(word), bool)
        new[1:] = False
        for x in (block, down, across, role):
            new[1:] |= x[1:] != x[:-1]
        edges = [*np.flatnonzero(new).tolist(), len(word)]
        out = []
        for at, end in zip(edges, edges[1:]):
            key = (block[at], down[at], across[at])
            if key != tile:
                tile, own, own_n, parts = key, [], [], []
            if role[at] == RESIDENT:
                own += word[at:end]
                own_n += n[at:end].tolist()
                parts = []
                continue
            if own and not parts:
                parts = [(first, Words(own[first:last])) for first, last in _slices(own)]
            for start, stop in _slices(word[at:end]) if own else ():
                visitors = Words(word[at + start : at + stop])
                for first, residents in parts:
                    for i, j in zip(*(x.tolist() for x in near(residents, visitors))):
                        i, j = first + i, at + start + j
                        if role[at] == FROM_ELSEWHERE or own[i] < word[j]:  # two of one block meet twice
                            out.append((own[i], own_n[i], word[j], int(n[j])))
        if out:
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in PAIRS.split(", ")])


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): every two of ``words`` (word, n; unique) one edit apart, once."""
    tiles = _tiled(visits(words, letter_groups(words)))
    order = ["block", "down", "across"]
    return tiles.repartition(*order).sortWithinPartitions(*order, "role").mapInArrow(meet, PAIRS)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word of ``forms`` (word, form): the last one that its forms lead to.

    Each round doubles the way that is known; forms occur ten times as often as their words, so ways are short.
    """
    way = stage(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        further = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = way.join(further, "root", "left")
        way = stage(longer.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "ways")
        if way.filter("moved").isEmpty():
            return way.select("word", "root")
        way = way.select("word", "root")


def variants(docs: DataFrame, least: int = 7, least_n: int = 2, factor: int = 10) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs`` (doc_id, text).

    A word is a run of at least ``least`` letters, A-Z lower-cased, that occurs ``least_n`` times. Its form is its most
    frequent near word if that one occurs at least ``factor`` times as often.
    """
    words = stage(vocabulary(docs, least, least_n), "words")
    pairs = stage(near_pairs(words), "pairs")
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n"))
    )
    best = sides.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best")
    )
    found = words.join(best, "word", "left").withColumn("strong", -F.col("best.minus") >= factor * F.col("n"))
    found = found.select(
        "word",
        F.when(F.col("strong"), F.col("best.other")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("strong"), -F.col("best.minus")).alias("form_n"),
    )
    found = stage(found, "forms")
    ends = roots(found.filter("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
