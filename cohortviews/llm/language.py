"""Language identification by interpolated Kneser-Ney character models.

One 4-gram model for each language; counts are taken in Spark over a sample of labelled rows of about
``SAMPLE_ROWS`` whole texts for each language (drawn by a hash of the id, so the same at every run). Higher orders use
absolute discounting, lower ones continuation counts, and everything is interpolated down to the uniform distribution.
The models of all languages share sorted arrays of hashed n-grams with one column of log probabilities for each
language; a text is scored by binary searches from the longest n-gram down, all of it. The language with the lowest
cross-entropy for each character wins.

Rejection is calibrated on sampled rows that were not counted: a text is accepted if its cross-entropy does not pass
the highest one seen there by more than a share ``SLACK`` of the way to the uniform distribution.

A text is lower-cased; whatever is no letter becomes one blank, and letters above the basic plane share one code. Nulls: a null text, or one without a letter, is ``und``
with score 0 and not accepted; rows without a label teach nothing. If no row teaches, every text is ``und``. Repeated
rows are rows of their own. No rows give no rows. The sample is the only bound; its size does not depend on the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortviews.llm.common import map_texts

ORDER = 4
#: Labelled rows that teach each language, on average; a fifth of them calibrate.
SAMPLE_ROWS = 1500
SLACK = 0.5
UNKNOWN = "und"
#: Characters whose preference counts in a score: beyond it more text adds no confidence.
SCORE_CHARS = 40
BLOCK = 1 << 18
BLANK, EDGE = 32, 0
#: For every letter above the basic plane: a code that is never a character, so it shares no n-gram with any script.
STAND_IN = 0xFFFF
MIX = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    """What each code point of the basic plane becomes: itself if a letter, else a blank."""
    return np.array([c if chr(c).isalpha() else BLANK for c in range(1 << 16)], np.uint16)


def characters(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts end to end, blanks collapsed, an EDGE after each; and the text number of each code."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("\0".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    edges = np.cumsum([len(t) + 1 for t in lowered]) - 1
    out = letters[np.minimum(codes, 0xFFFF)]  # U+FFFF is no letter, so a blank
    above = np.flatnonzero(codes > 0xFFFF)
    if len(above):
        distinct, of = np.unique(codes[above], return_inverse=True)
        out[above] = np.array([STAND_IN if chr(c).isalpha() else BLANK for c in distinct.tolist()], np.uint16)[of]
    out[edges] = EDGE
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != BLANK) | (out[:-1] != BLANK)
    out = out[keep]
    return out, np.cumsum(out == EDGE) - (out == EDGE)


def grams(codes: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed 4-grams that end at start .. end, and which of them are no edges. Blanks stand before a text."""
    at = np.arange(start, end)
    out = np.zeros(end - start, np.uint64)
    inside = np.ones(end - start, bool)
    for back in range(ORDER):
        c = codes[np.maximum(at - back, 0)]
        if back:
            inside &= (at >= back) & (c != EDGE)
            c = np.where(inside, c, BLANK)
        out |= c.astype(np.uint64) << np.uint64(16 * back)
    return out, codes[start:end] != EDGE


class Table:
    """Sorted hashes with a row of values each."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        hashed = keys * MIX
        order = np.argsort(hashed)
        self.hashes, self.values = hashed[order], values[order]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers, and which keys are there."""
        if not len(self.hashes):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        hashed = keys * MIX
        row = np.minimum(np.searchsorted(self.hashes, hashed), len(self.hashes) - 1)
        return row, self.hashes[row] == hashed

    def rows(self, keys: np.ndarray, missing: float) -> np.ndarray:
        row, there = self.find(keys)
        if not len(self.hashes):
            return np.full((len(keys), self.values.shape[1]), missing, self.values.dtype)
        return np.where(there[:, None], self.values[row], self.values.dtype.type(missing))


def _suffix(keys: np.ndarray, chars: int) -> np.ndarray:
    return keys & np.uint64((1 << (16 * chars)) - 1)


def _context(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(16)


def train(counts: dict[int, tuple[np.ndarray, np.ndarray]], languages: int) -> list[tuple[Table, Table]]:
    """For n = 1 .. ORDER the log probabilities of seen n-grams and the log weights that contexts leave to n - 1."""
    seen = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):  # continuation counts: how many characters stand before
        seen[n] = {}
        for k, (keys, _) in seen[n + 1].items():
            seen[n][k] = np.unique(_suffix(keys, n), return_counts=True)
    alphabet = len(np.unique(np.concatenate([k for k, _ in seen[1].values()]))) + 1
    lower, out = None, []
    for n in range(1, ORDER + 1):
        every = np.unique(np.concatenate([keys for keys, _ in seen[n].values()]))
        contexts = np.unique(_context(every))
        share = np.zeros((len(every), languages))
        left = np.ones((len(contexts), languages))
        for k, (keys, c) in seen[n].items():
            ones, twos = (c == 1).sum(), (c == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            of = np.searchsorted(contexts, _context(keys))
            total = np.bincount(of, c, len(contexts))
            kinds = np.bincount(of, minlength=len(contexts))
            has = total > 0
            left[has, k] = discount * kinds[has] / total[has]
            share[np.searchsorted(every, keys), k] = (c - discount) / total[of]
        rest = left[np.searchsorted(contexts, _context(every))]
        below = 1.0 / alphabet if lower is None else np.exp(lower.rows(_suffix(every, n - 1), 0.0))
        lower = Table(every, np.log(share + rest * below))
        out.append((lower, Table(contexts, np.log(left))))
    return [(_single(a), _single(b)) for a, b in out] + [np.log(1.0 / alphabet)]


def _single(t: Table) -> Table:
    """For scoring, half the memory is enough."""
    out = Table(np.zeros(0, np.uint64), t.values[:0])
    out.hashes, out.values = t.hashes, t.values.astype(np.float32)
    return out


def log_probabilities(model: list, keys: np.ndarray) -> np.ndarray:
    """(keys, languages): log probability of the last character after the others."""
    uniform = model[-1]
    languages = model[0][0].values.shape[1]
    out = np.zeros((len(keys), languages), np.float32)
    open_ = np.arange(len(keys))
    for n in range(ORDER, 0, -1):
        seen, left = model[n - 1]
        part = _suffix(keys[open_], n)
        row, there = seen.find(part)
        out[open_[there]] += seen.values[row[there]]
        open_, part = open_[~there], part[~there]
        if not len(open_):
            return out
        out[open_] += left.rows(_context(part), 0.0)
    out[open_] += np.float32(uniform)
    return out


def entropies(model: list, texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cross-entropy for each text and language in nats a character, characters and letters of each text."""
    codes, of = characters(texts, letters)
    total = np.zeros((len(texts), model[0][0].values.shape[1]))
    for start in range(0, len(codes), BLOCK):
        end = min(start + BLOCK, len(codes))
        keys, real = grams(codes, start, end)
        logs, who = log_probabilities(model, keys[real]), of[start:end][real]
        for k in range(total.shape[1]):
            total[:, k] += np.bincount(who, logs[:, k], len(texts))
    chars = np.bincount(of[codes != EDGE], minlength=len(texts))
    found = np.bincount(of[(codes != EDGE) & (codes != BLANK)], minlength=len(texts))
    return -total / np.maximum(chars, 1)[:, None], chars, found


def _teaching(docs: DataFrame) -> DataFrame:
    """Rows that may teach, with part: below 4 counts, 4 calibrates."""
    labelled = docs.filter("lang is not null and text is not null").filter(~held_out())
    per_language = labelled.groupBy("lang").agg(F.count("*").alias("n"))  # a row for each language
    u = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return (
        labelled.join(F.broadcast(per_language), "lang")
        .filter(u * F.col("n") < SAMPLE_ROWS)
        .select("lang", "text", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(5)).cast("int").alias("part"))
    )


def held_out():
    """True for the fold that never teaches; a null id belongs to no fold."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame) -> dict | None:
    """A model of every language with labelled rows: names, tables, and the limit of acceptance."""
    sample = _teaching(docs)
    letters = _letters()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(0).to_pylist()
            for i, text in enumerate(batch.column(1).to_pylist()):
                codes, _ = characters([text], letters)
                for start in range(0, len(codes), BLOCK):
                    keys, real = grams(codes, start, min(start + BLOCK, len(codes)))
                    keys, n = np.unique(keys[real], return_counts=True)
                    out = [pa.array([lang[i]] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(out, ["lang", "gram", "n"])

    grams_of = sample.filter("part < 4").select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    table = grams_of.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()  # bounded by the sample
    names = sorted(set(table.column("lang").to_pylist()))
    if not names:
        return None
    lang = np.array(table.column("lang").to_pylist())
    gram = table.column("gram").to_numpy().view(np.uint64)
    n = table.column("n").to_numpy()
    counts = {}
    for k, name in enumerate(names):
        mine = np.flatnonzero(lang == name)
        mine = mine[np.argsort(gram[mine])]
        counts[k] = (gram[mine], n[mine].astype(np.float64))
    model = {"names": names, "tables": _plain(train(counts, len(names))), "letters": letters}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def lowest(texts: list[bytes | None]) -> list[pa.Array]:
        nats, chars, _ = entropies(_tables(shared.value), [(t or b"").decode() for t in texts], shared.value["letters"])
        return [pa.array(np.where(chars >= SCORE_CHARS, nats.min(1), 0.0))]

    top = map_texts(sample.filter("part = 4"), [], "nats double", lowest).agg(F.max("nats")).first()[0] or 0.0
    uniform = -float(model["tables"][-1])
    model["limit"] = top + SLACK * max(0.0, uniform - top)
    return model


def _plain(tables: list) -> list:
    return [(a.hashes, a.values, b.hashes, b.values) for a, b in tables[:-1]] + [tables[-1]]


def _tables(model: dict) -> list:
    """The tables of a broadcast model, made once for each worker process."""
    if "made" not in model:
        made = []
        for x in model["tables"][:-1]:
            pair = []
            for hashes, values in (x[:2], x[2:]):
                t = Table.__new__(Table)
                t.hashes, t.values = hashes, values
                pair.append(t)
            made.append(tuple(pair))
        model["made"] = [*made, model["tables"][-1]]
    return model["made"]


PREDICTED = ("lang_pred", "score", "accepted")


def predict(docs: DataFrame, model: dict | None, keep: list[str], names: tuple[str, ...] = PREDICTED) -> DataFrame:
    """The kept columns with lang_pred, score (0 to 1) and accepted, under the given names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(texts: list[bytes | None]) -> list[pa.Array]:
        held = shared.value
        if held is None:
            return [pa.array([UNKNOWN] * len(texts)), pa.array([0.0] * len(texts)), pa.array([False] * len(texts))]
        nats, chars, letters = entropies(_tables(held), [(t or b"").decode() for t in texts], held["letters"])
        best = nats.argmin(1)
        low = nats[np.arange(len(texts)), best]
        ahead = np.minimum(chars, SCORE_CHARS)[:, None] * (nats - low[:, None])
        none = letters == 0
        score = np.where(none, 0.0, 1.0 / np.exp(-ahead).sum(1))
        names = [UNKNOWN if x else held["names"][b] for x, b in zip(none, best)]
        return [pa.array(names, pa.string()), pa.array(score), pa.array((low <= held["limit"]) & ~none)]

    return map_texts(docs, keep, ", ".join(f"{n} {t}" for n, t in zip(names, ("string", "double", "boolean"))), each)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted of every row; the other fold's labels teach the models."""
    model = learn(docs)
    return predict(docs.withColumn("held_out", held_out()), model, ["doc_id", "held_out"])


def accepted(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that no language model accepts."""
    columns = docs.columns
    names = tuple(f"__{n}" for n in PREDICTED)  # ``docs`` may have columns of the usual names
    return predict(docs, learn(docs), columns, names).filter(names[2]).select(*columns)
