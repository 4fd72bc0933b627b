"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

A text is cut before each run of word marks; no piece reaches over such a cut,
so the best segmentation of a text is that of its units. Distinct units of one
length advance together (long ones with others of about their length, each up
to its own end): at each end position the hashes of all substrings that end
there probe the keys of the pieces (a table of their first bits, and of what is
left the sorted keys), and the maximum over their starts is
stored as a back pointer. Of equal scores the longer last piece wins.
Characters without a piece cost ten less than the lowest score and become byte
pieces (or the unknown id).

The result is the segmentation of the highest total piece score, as the
library gives for unigram models. A model of the BPE kind is segmented by its
scores in the same way, which is not the order in which the library merges.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
_UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Units of a batch times their length; units up to this length only advance with equally long ones; end positions hashed at a time; units kept in memory.
_CELLS, _EQUAL, _SPAN, _KEPT = 1 << 18, 64, 1 << 12, 1 << 18
#: All but so many bits of a hash are looked up first.
_FIRST = np.uint64(44)


class Pieces:
    """The vocabulary of a model file, with its pieces keyed by hash."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        number = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(number)]
        self.unknown = model.unk_id()
        self.bytes = {int(self.text[i][3:5], 16): i for i in range(number) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.silent = {i for i in range(number) if model.is_control(i)}
        plain = [i for i in range(number) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.id_of = {self.text[i]: i for i in plain}
        self.score_of = {self.text[i]: float(model.get_score(i)) for i in plain}
        self.widest = max(map(len, self.id_of), default=1)
        self.missing = min(self.score_of.values(), default=0.0) - 10
        hashes = np.array([self._hash(np.array([list(map(ord, p))], np.uint64))[0] for p in self.id_of], np.uint64)
        order = np.argsort(hashes)
        self.keys = hashes[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.ids = np.array(list(self.id_of.values()), np.int64)[order]
        self.scores = np.array(list(self.score_of.values()))[order]
        self.first = np.zeros(1 << 64 - int(_FIRST), bool)
        self.first[self.keys >> _FIRST] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        """Hash of each row of code points."""
        h = np.zeros(len(codes), np.uint64)
        for column in codes.T:
            h = (h ^ column) * _BASE
            h ^= h >> np.uint64(29)
        return h

    def _spell(self, char: str) -> list[int]:
        if not self.bytes:
            return [self.unknown]
        return [self.bytes[b] for b in char.encode("utf-8", "surrogatepass")]

    def _batch(self, units: list[str]) -> None:
        """Search units together, from the first character on; the shorter ones are padded and end before."""
        n, sizes = len(units), [len(u) for u in units]
        length = max(sizes)
        equal = min(sizes) == length <= _EQUAL
        if equal:
            codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").reshape(n, length).T.astype(np.uint64, order="C")
        else:
            codes = np.zeros((length, n), np.uint64)
            for r, unit in enumerate(units):
                codes[: sizes[r], r] = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), "<u4")
        widest = min(self.widest, length)
        best, from_, piece = np.full((length + 1, n), -np.inf), np.zeros((length + 1, n), np.int32), np.full((length + 1, n), -1, np.int32)
        best[0] = 0
        row = np.arange(n)
        for low in range(0, length, _SPAN):
            # rolling[w, i]: the hashes of the w + 1 characters from first + i on
            first, high = max(0, low - widest + 1), min(length, low + _SPAN)
            part = codes[first:high]
            rolling = np.zeros((widest, *part.shape), np.uint64)
            for w in range(min(widest, len(part))):
                before = rolling[w - 1, : len(part) - w] if w else np.uint64(0)
                h = (before ^ part[w:]) * _BASE
                rolling[w, : len(part) - w] = h ^ (h >> np.uint64(29))
            for end in range(low + 1, high + 1):
                widths = np.arange(min(widest, end), 0, -1)
                probe = rolling[widths - 1, end - widths - first]
                value, found = self._scores(probe)
                value[-1][found[-1] < 0] = self.missing
                value += best[end - len(widths) : end]
                pick = np.argmax(value, axis=0)
                best[end], from_[end], piece[end] = value[pick, row], end - widths[pick], found[pick, row]
        if equal:
            self._walk_all(units, from_, piece)
            return
        for r, unit in enumerate(units):
            self.known[unit] = self._walk(unit, from_[:, r], piece[:, r])

    def _scores(self, probe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of the piece with each hash; without one -inf and -1."""
        value, found = np.full(probe.size, -np.inf), np.full(probe.size, -1, np.int32)
        flat = probe.ravel()
        spot = np.flatnonzero(self.first[flat >> _FIRST])
        at = np.minimum(np.searchsorted(self.keys, flat[spot]), len(self.keys) - 1)
        hit = self.keys[at] == flat[spot]
        value[spot[hit]], found[spot[hit]] = self.scores[at[hit]], self.ids[at[hit]]
        return value.reshape(probe.shape), found.reshape(probe.shape)

    def _walk_all(self, units: list[str], back: np.ndarray, found: np.ndarray) -> None:
        """Ids of units of one length, all walked back together; those with a character without a piece one by one."""
        rows, end, steps = np.arange(len(units)), np.full(len(units), len(back) - 1), []
        spelt = np.zeros(len(units), bool)
        while len(rows):
            ids = found[end, rows]
            spelt[rows[ids < 0]] = True
            steps.append((rows, ids))
            end = back[end, rows]
            rows, end = rows[end > 0], end[end > 0]
        count = np.bincount(np.concatenate([r for r, _ in steps]), minlength=len(units))
        stop = np.cumsum(count)
        flat = np.zeros(stop[-1], "<u4")
        for step, (r, ids) in enumerate(steps):
            flat[stop[r] - 1 - step] = ids.astype("<u4")
        joined, ends = flat.tobytes(), (4 * stop).tolist()
        self.known.update(zip(units, map(joined.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
        for r in np.flatnonzero(spelt).tolist():
            self.known[units[r]] = self._walk(units[r], back[:, r], found[:, r])

    def _walk(self, unit: str, back: np.ndarray, found: np.ndarray) -> bytes:
        from_, piece = back[: len(unit) + 1].tolist(), found[: len(unit) + 1].tolist()
        ids: list[int] = []
        end = len(unit)
        while end:
            start = from_[end]
            ids.extend([piece[end]] if piece[end] >= 0 else reversed(self._spell(unit[start:end])))
            end = start
        return np.array(ids[::-1], "<u4").tobytes()

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        units = [_UNIT.findall((MARK + t).replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > _KEPT // 2:
            # Units that come again move over from the older half; the others go with it.
            self.known, self.older = {}, self.known
        by_length: dict[int, list[str]] = {}
        fresh = {u for us in units for u in us} - self.known.keys()
        again = fresh & self.older.keys()
        self.known.update(zip(again, map(self.older.__getitem__, again), strict=True))
        for unit in fresh - again:
            length = len(unit)
            by_length.setdefault(length if length <= _EQUAL else -(-length // (1 << length.bit_length() - 3)) << length.bit_length() - 3, []).append(unit)
        for length, group in by_length.items():
            step = max(1, _CELLS // length)
            for at in range(0, len(group), step):
                self._batch(group[at : at + step])
        return [b"".join(map(self.known.__getitem__, us)) for us in units]

    def decode(self, encoded: bytes | None) -> str:
        """Text of ids: byte pieces as UTF-8 (replaced where invalid), marks as spaces, without the leading one."""
        out, held = [], bytearray()
        for i in np.frombuffer(encoded or b"", "<u4").tolist():
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            if i not in self.silent:
                out.append(self.text[i])
        out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ").removeprefix(" ")


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def _slices(texts: list[str | None], most: int = 1 << 20) -> Iterator[slice]:
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most or i == len(texts) - 1:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every whole text, ids as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids. Equal texts have equal ids, and rows that
    repeat an id stay apart. Rows are neither dropped nor merged, an empty table
    gives none, and other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in _slices(texts):
                yield pa.RecordBatch.from_arrays([batch.column(0)[part.start : part.stop], pa.array(pieces.encode(texts[part]), pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, "doc_id long, ids binary")


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, text) of (doc_id, ids).

    A text that holds the word mark itself comes back with a space there. Null
    and empty ids give the empty text. Rows are neither dropped nor merged,
    repeated ones included, an empty table gives none, and other columns are
    not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_path)
        for batch in batches:
            texts = [pieces.decode(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")
