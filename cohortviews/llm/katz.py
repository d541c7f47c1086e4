"""Language-model scoring with a Katz backoff model of word pairs.

P(w | v) is d c(v, w) / c(v) for a pair seen in training, with Good-Turing discounts d of counts up to ``LARGEST``, and
backs off to alpha(v) P(w) otherwise; alpha(v) makes the probabilities after v sum to exactly one. P(w) is a discounted
count too, and what the discounts free is the probability of one class of all unknown words. Where Good-Turing gives no
factor between 0 and 1, half an occurrence is taken off. Where nothing is discounted (no pair after v, or no word, occurs
``LARGEST`` times or less), one more occurrence is assumed, so that nothing has probability zero. Tokens
are the words of a text, A-Z lower-cased, and one end; the first one follows a start that is no token.

Words are 64-bit digests in all tables. Documents are dealt into chunks by digest. A chunk sends each different pair once
and gets its count over all training texts back: no token becomes a row, and a copied text costs nothing more in its
chunk. Pairs are partitioned by their second word; all words of a bucket go in one row, and the answer has their counts in
the same order. A partition so sees each second word whole, which yields its count and those of all pairs that end in it;
sums over pairs that begin with a word (how many occur r times, and the probability mass of their second words) are a
small two-phase aggregate beside, and the backoff weights from it go to the chunks that need them. There each token is
evaluated from the pair down. Buckets hold some ``BUCKET_TOKENS`` tokens; a second word of more than ``GROUP_TOKENS`` is
dealt over several groups of its own by first word, and there are at most N / GROUP_TOKENS of such.

Nulls: a null text is empty and has one token, its end. A null id is not held out. Repeated rows count as often as they
occur. If nothing is learned, every word is unknown. No rows give no rows. Sums of floating-point numbers may differ in
their last digits between runs; counts do not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cohortviews.llm.common import stage
from cohortviews.session import staging_path

#: Counts above this are not discounted.
LARGEST = 5
#: Bytes of text in a chunk, on average.
CHUNK_BYTES = 1 << 24
#: Tokens that a task counts at a time, and tokens of one second word from which it is dealt over groups.
BATCH_TOKENS, GROUP_TOKENS, MOST_CROWDED = 1 << 21, 1 << 20, 1 << 20
BUCKET_TOKENS = 1 << 18
#: Bytes of requests that a task counts at a time; a pair takes six to fourteen.
COUNT_BYTES = 1 << 22
#: The commonest words go by two bytes; at most so many are broadcast.
SHORT_CODES = (1 << 16) - 2
RARE = np.uint16(0xFFFF)
SALT_BITS = 24


def _digest(word: bytes) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(word)).view(np.int64))


#: No word holds a blank.
END, START = _digest(b" end"), _digest(b" start")


def word_digests(text: bytes) -> np.ndarray:
    """Digests of the words of a text and its end."""
    digest = xxhash.xxh64_intdigest
    words = text.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter((digest(w) for w in words), np.uint64, len(words))
    out = out.view(np.int64)
    out[-1] = END
    return out


def discounts(kinds: list[int]) -> np.ndarray:
    """Katz's factor for counts 0 .. LARGEST + 1 (the last for all larger ones); ``kinds[r - 1]`` occur r times."""
    out = np.ones(LARGEST + 2)
    rest = (LARGEST + 1) * kinds[LARGEST] / kinds[0] if kinds[0] else 1.0
    for r in range(1, LARGEST + 1):
        usable = rest < 1 and kinds[r - 1]
        d = ((r + 1) * kinds[r] / (r * kinds[r - 1]) - rest) / (1 - rest) if usable else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


class Words:
    """The word level: what every count is worth."""

    def __init__(self, tokens: int, distinct: int, kinds: list[int]):
        self.tokens, self.distinct = tokens, distinct
        self.factor = discounts(kinds)
        freed = sum((1 - self.factor[r]) * r * kinds[r - 1] for r in range(1, LARGEST + 1))
        self.total = tokens if freed > 0 else tokens + 1
        self.unknown = (freed if freed > 0 else 1.0) / self.total

    def probability(self, counts: np.ndarray) -> np.ndarray:
        """P(w) by the count of w; of the class of unknown words for 0."""
        return np.where(counts > 0, self.factor[np.minimum(counts, LARGEST + 1)] * counts / self.total, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the add-one estimate."""
        return np.log10((counts + 1) / (self.tokens + self.distinct + 1))


def vocabulary(texts: DataFrame) -> DataFrame:
    """(word, c): how often each word digest occurs in ``texts`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            words, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(words), pa.array(n.astype(np.int64))], ["word", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text in batch.column(0).slice(at, 256).cast(pa.binary()).to_pylist():
                    held.append(word_digests(text))
                    size += len(held[-1])
                    if size >= BATCH_TOKENS:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    return texts.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Plan:
    """How second words are dealt: into buckets; the crowded ones (sorted) into groups of their own."""

    buckets: int
    names: np.ndarray
    counts: np.ndarray
    groups: np.ndarray

    def crowded(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place among the crowded words, and which words are."""
        if not len(self.names):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.names, words), len(self.names) - 1)
        return at, self.names[at] == words


class Chunk:
    """Different texts of a chunk, its words, and its different pairs in the order (bucket, salt, second, first word).

    Places in arrays take four bytes, and what a step leaves behind goes at once: a chunk has some three million tokens.
    """

    def __init__(self, texts: list[bytes], weights: np.ndarray, plan: Plan):
        place: dict[bytes, int] = {}
        self.text_of = np.array([place.setdefault(t, len(place)) for t in texts], np.int64)
        weight = np.bincount(self.text_of, weights, len(place))
        parts = [word_digests(t) for t in place]
        place.clear()
        self.sizes = np.array([len(p) for p in parts])
        tokens = np.concatenate(parts)
        del parts
        self.words, second = np.unique(tokens, return_inverse=True)
        del tokens
        self.second_of_token = second.astype(np.int32)
        del second
        self.text = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        keys = self.second_of_token.astype(np.int64)
        keys *= len(self.words) + 1
        keys[1:] += self.second_of_token[:-1]
        begins = np.cumsum(self.sizes) - self.sizes
        keys[begins] = self.second_of_token[begins].astype(np.int64) * (len(self.words) + 1) + len(self.words)  # the start
        keys, pair = np.unique(keys, return_inverse=True)
        pair = pair.astype(np.int32)
        self.n = np.bincount(pair, weight[self.text], len(keys)).astype(np.int64)
        self.second, self.first = (x.astype(np.int32) for x in np.divmod(keys, len(self.words) + 1))
        at, is_crowded = plan.crowded(self.words)
        bucket = np.where(is_crowded, plan.buckets + at, self.words % plan.buckets)[self.second]
        groups = np.where(is_crowded, plan.groups[at] if len(plan.groups) else 1, 1)[self.second]
        salt = self.first_digest() % groups  # not negative: the divisor is positive
        by = np.lexsort((self.first, self.second, salt, bucket))
        back = np.empty(len(by), np.int32)
        back[by] = np.arange(len(by), dtype=np.int32)
        self.second, self.first, self.n, self.pair = self.second[by], self.first[by], self.n[by], back[pair]
        bucket, salt = bucket[by], salt[by]
        new = np.ones(len(keys), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (salt[1:] != salt[:-1])
        self.rows = np.flatnonzero(new)  # a row begins at each of these pairs
        self.bucket, self.salt = bucket[self.rows], salt[self.rows]
        new[1:] |= self.second[1:] != self.second[:-1]
        self.parts = np.flatnonzero(new)  # and one word of a row at each of these

    def first_digest(self) -> np.ndarray:
        return np.append(self.words, START)[self.first]


def _blobs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary for each row: ``values`` up to the position in ``ends`` from the one before."""
    offsets = np.concatenate([[0], ends]).astype(np.int64) * values.itemsize
    return pa.Array.from_buffers(
        pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values).view(np.uint8))]
    )


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column end to end, and how many bytes each row has."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(flat.tobytes(), kind), np.diff(offsets)


def _column(table: pa.Table, name: str) -> pa.Array:
    out = table.column(name).combine_chunks()
    return out.chunk(0) if isinstance(out, pa.ChunkedArray) else out


def _chunk(table: pa.Table, plan: Plan) -> Chunk:
    texts = _column(table, "text").cast(pa.binary()).to_pylist()
    return Chunk(texts, 1.0 - _column(table, "held_out").to_numpy(zero_copy_only=False), plan)


SENT = "bucket long, slot long, words binary, sizes binary, codes binary, rare binary, n binary"


def requests(texts: DataFrame, plan: Plan, short: np.ndarray) -> DataFrame:
    """A row for each bucket (and salt) of each chunk: second words, how many first words each has, these, and how often
    training has the pairs here."""

    def send(table: pa.Table) -> pa.Table:
        chunk, number = _chunk(table, plan), table.column("chunk")[0].as_py()
        first = chunk.first_digest()
        at = np.minimum(np.searchsorted(short, first), len(short) - 1)
        is_short = short[at] == first
        ends = np.append(chunk.rows[1:], len(first))
        part_ends = np.searchsorted(chunk.parts, ends)
        columns = [
            pa.array(chunk.bucket),
            pa.array((number << SALT_BITS) | chunk.salt),
            _blobs(chunk.words[chunk.second[chunk.parts]], part_ends),
            _blobs(np.diff(np.append(chunk.parts, len(first))).astype(np.uint32), part_ends),
            _blobs(np.where(is_short, at, RARE).astype(np.uint16), ends),
            _blobs(first[~is_short], np.cumsum(~is_short)[ends - 1]),
            _blobs(chunk.n.astype(np.uint32), ends),
        ]
        return pa.table(columns, [f.split()[0] for f in SENT.split(", ")])

    return texts.groupBy("chunk").applyInArrow(send, SENT)


#: In place of a salt: a row about the backoff weight of a word.
WEIGHT = -1
SUMS = [f"n{r}" for r in range(1, LARGEST + 2)]
COUNTED = "chunk long, salt long, word long, c binary, counts binary, " + ", ".join(f"{n} long" for n in SUMS) + ", mass double"


def _needs(chunk: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    """Which chunks ask about which first words."""
    by = np.lexsort((first, chunk))
    chunk, first = chunk[by], first[by]
    new = np.ones(len(by), bool)
    new[1:] = (chunk[1:] != chunk[:-1]) | (first[1:] != first[:-1])
    n = int(new.sum())
    columns = [pa.array(chunk[new]), pa.array(np.full(n, WEIGHT)), pa.array(first[new]), *[pa.nulls(n, pa.binary())] * 2]
    columns += [pa.nulls(n, pa.int64())] * len(SUMS) + [pa.nulls(n, pa.float64())]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in COUNTED.split(", ")])


class Histories:
    """Sums over pairs by their first word, compacted as they come."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, first: np.ndarray, count: np.ndarray, probability: np.ndarray) -> None:
        kinds = np.zeros((len(first), LARGEST + 1))
        low = np.flatnonzero(count <= LARGEST + 1)
        kinds[low, count[low] - 1] = 1
        self.parts.append((first, np.column_stack([kinds, probability])))
        self.size += len(first)
        if self.size > 1 << 20:
            self.compact()

    def compact(self) -> None:
        if self.parts:
            first, of = np.unique(np.concatenate([p[0] for p in self.parts]), return_inverse=True)
            rows = np.concatenate([p[1] for p in self.parts])
            sums = np.column_stack([np.bincount(of, rows[:, k], len(first)) for k in range(rows.shape[1])])
            self.parts, self.size = [(first, sums)], 0  # what remains is bounded by the words of the task

    def batch(self) -> pa.RecordBatch:
        self.compact()
        first, sums = self.parts[0] if self.parts else (np.zeros(0, np.int64), np.zeros((0, LARGEST + 2)))
        none = pa.nulls(len(first), pa.int64())
        columns = [none, none, pa.array(first), *[pa.nulls(len(first), pa.binary())] * 2]
        columns += [pa.array(sums[:, k].astype(np.int64)) for k in range(LARGEST + 1)] + [pa.array(sums[:, -1].astype(np.float64))]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in COUNTED.split(", ")])


def _whole(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Counts as binaries of four bytes each, of eight if one needs it."""
    return _blobs(values.astype(np.uint32 if values.max(initial=0) < 1 << 32 else np.uint64), ends)


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about half of ``COUNT_BYTES``; rows can be large, and a batch holds many."""
    step = max(1, batch.num_rows * (COUNT_BYTES // 2) // max(batch.nbytes, 1))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def _counts(column: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """All counts of such binaries; row i has ``sizes[i]``."""
    flat, length = _flat(column, "u1")
    if (length == 4 * sizes).all():
        return np.frombuffer(flat.tobytes(), "<u4").astype(np.int64)
    ends = np.cumsum(length)
    each = zip(ends.tolist(), length.tolist(), sizes.tolist())
    return np.concatenate([np.frombuffer(flat[e - l : e].tobytes(), "<u4" if l == 4 * n else "<u8").astype(np.int64) for e, l, n in each])


def counted(sent: DataFrame, words: Words, plan: Plan, short: np.ndarray) -> DataFrame:
    """``COUNTED``: for each request the counts of its words and pairs; beside them which chunks ask about which first
    words (salt ``WEIGHT``), for pairs that training lacks or has often, and sums by first word (chunk null)."""

    def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Tables of whole (bucket, salt) groups, of a bounded size unless one group is larger."""
        held: list[pa.RecordBatch] = []
        size = 0
        for part in (p for batch in batches for p in _pieces(batch)):
            held.append(part)
            size += part.nbytes
            if size < COUNT_BYTES:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            bucket, salt = _column(table, "bucket").to_numpy(), _column(table, "slot").to_numpy() & ((1 << SALT_BITS) - 1)
            edges = np.flatnonzero((bucket[1:] != bucket[:-1]) | (salt[1:] != salt[:-1]))
            if len(edges):
                end = int(edges[-1]) + 1
                yield table.slice(0, end)
                held = table.slice(end).to_batches()
                size = sum(b.nbytes for b in held)
            else:
                held = table.to_batches()
        if held:
            yield pa.Table.from_batches(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        histories = Histories()
        for table in whole_groups(batches):
            if not table.num_rows:
                continue
            bucket, slot = _column(table, "bucket").to_numpy(), _column(table, "slot").to_numpy()
            part_word, parts = _flat(_column(table, "words"), "<i8")
            part_size, _ = _flat(_column(table, "sizes"), "<u4")
            codes, size = _flat(_column(table, "codes"), "<u2")
            rare, _ = _flat(_column(table, "rare"), "<i8")
            n, _ = _flat(_column(table, "n"), "<u4")
            parts, size = parts // 8, size // 2  # of each row
            first = short[np.minimum(codes, len(short) - 1)]
            first[codes == RARE] = rare
            word = np.repeat(part_word, part_size)
            by = np.lexsort((first, word))
            f, w = first[by], word[by]
            fresh = np.ones(len(by), bool)
            fresh[1:] = (f[1:] != f[:-1]) | (w[1:] != w[:-1])
            starts = np.flatnonzero(fresh)
            total = np.add.reduceat(n[by].astype(np.int64), starts)
            f, w = f[starts], w[starts]
            of_pair = np.empty(len(by), np.int64)
            of_pair[by] = np.cumsum(fresh) - 1
            heads = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            names, c = w[heads], np.add.reduceat(total, heads)
            at, is_crowded = plan.crowded(names)
            if is_crowded.any():  # other groups have the rest of them
                c = np.where(is_crowded, plan.counts[at], c)
            seen = total > 0
            histories.add(f[seen], total[seen], words.probability(c)[np.cumsum(np.append(True, w[1:] != w[:-1])) - 1][seen])
            back = total[of_pair]
            asks = (back == 0) | (back > LARGEST)
            yield _needs(np.repeat(slot >> SALT_BITS, size)[asks], first[asks])
            part_c = c[np.searchsorted(names, part_word)]
            columns = [pa.array(slot >> SALT_BITS), pa.array(slot & ((1 << SALT_BITS) - 1)), pa.array(bucket)]
            columns += [_whole(part_c, np.cumsum(parts)), _whole(back, np.cumsum(size))]
            columns += [pa.nulls(len(bucket), pa.int64())] * len(SUMS) + [pa.nulls(len(bucket), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in COUNTED.split(", ")])
        yield histories.batch()

    salt = F.col("slot").bitwiseAND(F.lit((1 << SALT_BITS) - 1))
    dealt = sent.repartition(F.col("bucket"), salt).sortWithinPartitions(F.col("bucket"), salt)
    # counts are small numbers, which a denser codec than the default halves
    path = staging_path(sent.sparkSession, "counts")
    dealt.mapInArrow(count, COUNTED).write.option("compression", "zstd").parquet(path)
    return sent.sparkSession.read.schema(COUNTED).parquet(path)


def freed_by(factor: np.ndarray, n: list):
    """What the discounts of a history's pairs free, by how many pairs occur r times."""
    return sum(((1.0 - float(factor[r])) * r * n[r - 1] for r in range(1, LARGEST + 1)), start=0.0)


def score_documents(docs: DataFrame, held_out: Column, chunk_bytes: int = CHUNK_BYTES, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 of the text's probability).

    Every row of ``docs`` (doc_id, text) is scored by a model of those that are not ``held_out``.
    """
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    out = F.coalesce(held_out, F.lit(False)).alias("held_out")
    texts = docs.select(F.col("doc_id"), text, out)
    known = stage(vocabulary(texts.filter("not held_out")), "vocabulary")
    seen = known.agg(
        F.sum("c").alias("n"), F.count("*").alias("v"), *[F.count_if(F.col("c") == r).alias(k) for r, k in enumerate(SUMS, 1)]
    ).first()
    words = Words(seen.n or 0, seen.v, [seen[k] for k in SUMS])
    limit = max(group_tokens, words.tokens // MOST_CROWDED)
    large = known.filter(F.col("c") > limit).orderBy("word").toArrow()  # at most N / limit rows, so at most MOST_CROWDED
    names, counts = large.column("word").to_numpy(), large.column("c").to_numpy()
    plan = Plan(max(1, words.tokens // BUCKET_TOKENS), names, counts, -(-counts // limit))
    frequent = known.orderBy(F.desc("c"), "word").limit(SHORT_CODES).select("word").toArrow().column(0).to_numpy()  # bounded
    short = np.unique(np.append(frequent, START))
    size = texts.agg(F.sum(F.octet_length("text") + 1).alias("s")).first().s or 0

    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(max(1, -(-size // chunk_bytes)))).alias("chunk")
    dealt = texts.select("doc_id", "text", "held_out", chunk)
    table = counted(requests(dealt, plan, short), words, plan, short)

    sums = table.filter("chunk is null").groupBy("word").agg(*[F.sum(k).alias(k) for k in SUMS], F.sum("mass").alias("mass"))
    histories = stage(sums, "histories")
    kinds = histories.agg(*[F.sum(k).alias(k) for k in SUMS]).first()
    factor = discounts([kinds[k] or 0 for k in SUMS])
    begin = histories.filter(F.col("word") == START).first()
    begins = known.filter(F.col("word") == END).first()
    start = (1.0, 1.0)  # what counts are divided by, and the backoff weight
    if begin:
        freed = freed_by(factor, [begin[k] for k in SUMS])
        total = begins.c if freed > 0 else begins.c + 1
        start = (float(total), (freed if freed > 0 else 1.0) / total / (1 - begin.mass))
    freed = freed_by(factor, [F.col(k) for k in SUMS])
    total = F.col("c") + F.when(freed > 0, 0).otherwise(1)
    weight = F.when(freed > 0, freed).otherwise(1.0) / total / (1 - F.col("mass"))
    weighed = stage(histories.join(known, "word").select("word", weight.alias("weight"), (freed <= 0).alias("one_more")), "weights")
    rows = table.filter("chunk is not null")
    needed = rows.filter(F.col("salt") == WEIGHT).select("chunk", "salt", "word").distinct().join(weighed, "word")
    answers = rows.filter("salt >= 0").select("chunk", "salt", "word", "c", "counts").unionByName(needed, allowMissingColumns=True)

    def evaluate(left: pa.Table, right: pa.Table) -> pa.Table:
        mine = _chunk(left, plan)
        salt = right.column("salt").to_numpy()
        beside = right.filter(pa.array(salt == WEIGHT))
        right = right.filter(pa.array(salt >= 0)).sort_by([("word", "ascending"), ("salt", "ascending")])
        if right.num_rows != len(mine.rows):
            raise RuntimeError("answers do not match the requests of a chunk")
        n = _counts(_column(right, "counts"), np.diff(np.append(mine.rows, len(mine.n))))
        of_row = np.diff(np.append(np.searchsorted(mine.parts, mine.rows), len(mine.parts)))
        c = np.zeros(len(mine.words), np.int64)
        c[mine.second[mine.parts]] = _counts(_column(right, "c"), of_row)
        totals, weights = np.append(c, start[0]).astype(np.float64), np.append(np.ones(len(c)), start[1])
        # nothing follows an unknown word in training: its weight stays 1, so P(w) is left
        at = np.searchsorted(mine.words, _column(beside, "word").to_numpy())
        weights[at] = _column(beside, "weight").to_numpy(zero_copy_only=False)
        totals[at] += _column(beside, "one_more").to_numpy(zero_copy_only=False).astype(np.float64)
        p = words.probability(c)
        direct = factor[np.minimum(n, LARGEST + 1)] * n / np.maximum(totals, 1)[mine.first]
        logs = np.log10(np.where(n > 0, direct, weights[mine.first] * p[mine.second]))
        number = len(mine.sizes)
        score = np.bincount(mine.text, logs[mine.pair], number)
        base = np.bincount(mine.text, words.base(c)[mine.second_of_token], number)
        is_known = np.bincount(mine.text, (c > 0)[mine.second_of_token], number).astype(np.int64)
        of = mine.text_of
        return pa.table({
            "doc_id": left.column("doc_id"),
            "held_out": left.column("held_out"),
            "n_tokens": mine.sizes[of].astype(np.int64),
            "n_known": is_known[of],
            "train_tokens": np.full(len(of), words.tokens, np.int64),
            "base_score": base[of],
            "score": score[of],
        })

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(evaluate, schema)


def held_out(part: int = 2, of: int = 7) -> Column:
    """Whether the digest of the id leaves the remainder ``part``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == part, F.lit(False))
