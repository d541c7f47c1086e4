"""SentencePiece BPE encoding and decoding by a prefix table.

A merge vocabulary gives every prefix of a text one last token: the one token ending there that an automaton over the
vocabulary reports and that is compatible with the last token of the prefix before it. Two tokens are compatible if
merging their joined characters by score gives just these two back. The table keeps the last token of each prefix, and
the ids are read off backwards.

Texts are first cut where no token of the vocabulary can lie across: before white space, and between word characters
and marks that no token joins. Parts repeat a lot, so each worker keeps the ids of parts that it has seen, up to a fixed
number of bytes. The vocabulary is broadcast: its size is that of the model, whatever the input.

Nulls: a null text is encoded as the empty text, which has no ids. Rows are independent, so repeated rows give repeated
results; no rows give no rows. A text of any length is encoded whole.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortviews.llm.common import map_texts

SPACE = "▁"
#: Megabytes of parts that a worker remembers, all in all.
REMEMBERED_MB = 256
#: Bytes of an entry beside its strings: headers of two strings and a tuple, and its place in a dictionary.
ENTRY_BYTES = 300
NONE, START = -2, -1


def vocabulary(model_file: str) -> dict:
    """Pieces that merge (with ids and scores) and the ids of byte pieces, read from a SentencePiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
    return {
        "pieces": {
            model.id_to_piece(i): (i, model.get_score(i)) for i in range(size) if not special[i] and not model.is_byte(i)
        },
        "bytes": [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
    }


class Memory:
    """A dictionary of short keys in two generations of ``most`` / 2 bytes: when the new one is full, it becomes the old one."""

    def __init__(self, most: int):
        self.most, self.size, self.new, self.old = most // 2, 0, {}, {}

    def get(self, key: str):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key: str, value):
        if len(key) <= 64:
            if self.size >= self.most:
                self.old = self.new.copy()
                self.new.clear()
                self.size = 0
            self.new[key] = value
            self.size += ENTRY_BYTES + len(key) + len(value[0]) + len(value[1])
        return value


class Encoder:
    """Encodes and decodes with one vocabulary; remembers parts and pair tests."""

    def __init__(self, vocab: dict, memory_mb: int = REMEMBERED_MB):
        import ahocorasick

        self.scores = {p: s for p, (_, s) in vocab["pieces"].items()}
        self.ids = {p: i for p, (i, _) in vocab["pieces"].items()}
        self.names = {i: p for p, i in self.ids.items()}
        self.bytes = vocab["bytes"]
        self.byte_of = {i: b for b, i in enumerate(self.bytes)}
        self.width = max(self.names, default=0) + 1
        self.reached = {p: i for p, i in self.ids.items() if self.merged(p) == [p]}
        self.tokens = ahocorasick.Automaton()
        for p, i in self.reached.items():
            self.tokens.add_word(p, (len(p), i, {}))  # with the pair tests of the token as the right one
        self.tokens.make_automaton()
        self.known = frozenset(p for p in self.reached if len(p) == 1)
        self.parts = Memory(memory_mb << 17)  # parts without white space before them: an eighth
        self.words = Memory(7 * memory_mb << 17)  # texts between two white spaces
        self.cut = self._cut()

    def _cut(self) -> re.Pattern:
        """Parts of a text between places that no token lies across."""
        joined = {(a, b) for p in self.reached for a, b in zip(p, p[1:])}
        chars = {c for p in self.reached for c in p}
        marks = {c for c in chars if not c.isalnum() and c != SPACE}
        while True:
            linked = {c for a, b in joined for c, o in ((a, b), (b, a)) if c in marks and o not in marks and o != SPACE}
            if not linked:
                break
            marks -= linked
        if any(b == SPACE and a != SPACE for a, b in joined):  # a token ends in white space: one part
            self.cuts_words = False
            return re.compile(r"(?s).+")
        self.cuts_words = True
        mark = "".join(map(re.escape, sorted(marks)))
        return re.compile(f"{SPACE}*[^{SPACE}{mark}]+|{SPACE}*[{mark}]+|{SPACE}+" if mark else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def merged(self, text: str) -> list[str]:
        """The pieces left when the best-scored neighbours are merged, leftmost first, until none merge."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        left, right = self.names[a], self.names[b]
        return self.merged(left + right) == [left, right]

    def table(self, text: str) -> list[int]:
        """Ids of a text of known characters: last tokens of all prefixes, then the way back."""
        n = len(text)
        last, before = [NONE] * (n + 1), [0] * (n + 1)
        last[0] = START
        for at, (length, token, fits_after) in self.tokens.iter(text):
            end = at + 1
            if last[end] != NONE:
                continue
            start = end - length
            prev = last[start]
            if prev >= 0:
                fits = fits_after.get(prev)
                if fits is None:
                    fits = fits_after[prev] = self.compatible(prev, token)
                if not fits:
                    continue
            elif prev == NONE:
                continue
            last[end], before[end] = token, start
        out = []
        while n:
            out.append(last[n])
            n = before[n]
        out.reverse()
        return out

    def encode_part(self, text: str) -> list[int]:
        """Ids of a part; characters without a piece become bytes."""
        if self.known.issuperset(text):
            return self.table(text)
        out, at = [], 0
        for i, c in enumerate(text):
            if c not in self.known:
                out += self.table(text[at:i]) + [self.bytes[b] for b in c.encode("utf-8")]
                at = i + 1
        return out + self.table(text[at:])

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids`` with white space restored; bytes that are no UTF-8 become U+FFFD each."""
        out, run, names = [], bytearray(), self.names
        try:  # no bytes, as mostly
            return "".join([names[i] for i in ids]).replace(SPACE, " ")
        except KeyError:
            pass
        for i in [*ids, None]:
            if i is not None and i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
            if i is not None:
                out.append(self.names.get(i, ""))
        return "".join(out).replace(SPACE, " ")

    def _fresh(self, text: str) -> tuple[str, str]:
        ids = self.encode_part(text)
        return ",".join(map(str, ids)), self.decode(ids)

    def word(self, word: str) -> tuple[str, str]:
        """A text between two white spaces, with the white space before it."""
        seen = self.words.get(word)
        if seen:
            return seen
        parts = (SPACE + word,) if word.isalnum() and self.cuts_words else self.cut.findall(SPACE + word)
        if len(parts) == 1:
            found = self._fresh(parts[0])
        else:
            head = self.word(parts[0][1:]) if parts[0][1:2] and SPACE not in parts[0][1:] else self._fresh(parts[0])
            rest = [self.parts.get(p) or self.parts.put(p, self._fresh(p)) for p in parts[1:]]
            found = ",".join([head[0], *[r[0] for r in rest]]), head[1] + "".join([r[1] for r in rest])
        return self.words.put(word, found)

    def _joined(self, escaped: str) -> tuple[str, str]:
        parts = [self.parts.get(p) or self.parts.put(p, self._fresh(p)) for p in self.cut.findall(escaped)]
        return ",".join([p[0] for p in parts]), "".join([p[1] for p in parts])

    def encode(self, text: str) -> tuple[str, str]:
        """Ids joined by commas, and the text that they decode to."""
        if not text:
            return "", ""
        text = text.replace(SPACE, " ")
        if not self.cuts_words or "  " in text or text[0] == " " or text[-1] == " ":
            ids, back = self._joined(SPACE + text.replace(" ", SPACE))
            return ids, back[1:]
        words = text.split(" ")
        found = list(map(self.words.new.get, words))
        if None in found:
            for i, f in enumerate(found):
                if f is None:
                    found[i] = self.word(words[i])
        return ",".join([f[0] for f in found]), "".join([f[1] for f in found])[1:]


def _utf8(run: bytes) -> str:
    """UTF-8 with one U+FFFD for every byte that belongs to no character."""
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(run[at : at + n].decode("utf-8"))
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def encode_documents(
    docs: DataFrame, model_file: str, keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False, memory_mb: int = REMEMBERED_MB
) -> DataFrame:
    """The kept columns of ``docs`` with n_tokens, ids_sha256 and decoded_sha256; and ids, if asked for.

    Each worker remembers up to ``memory_mb`` of parts; a smaller bound costs time, never a result.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": vocabulary(model_file)})

    def each(texts: list[bytes | None]) -> list[pa.Array]:
        held = shared.value
        if "encoder" not in held:  # once for each worker process
            held["encoder"] = Encoder(held.pop("vocabulary"), memory_mb)
        encoder = held["encoder"]
        both = [encoder.encode((t or b"").decode("utf-8", "replace")) for t in texts]
        out = [
            pa.array([ids.count(",") + 1 if ids else 0 for ids, _ in both], pa.int64()),
            pa.array([_sha(ids) for ids, _ in both], pa.string()),
            pa.array([_sha(back) for _, back in both], pa.string()),
        ]
        if with_ids:
            rows = [np.fromstring(ids, np.int32, sep=",") if ids else np.zeros(0, np.int32) for ids, _ in both]
            offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            out.append(pa.ListArray.from_arrays(offsets, np.concatenate(rows)))
        return out

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return map_texts(docs, list(keep), schema, each)
