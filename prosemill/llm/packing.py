"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

A document gives whole sequences and one remainder. Class k holds remainders
longer than capacity/(k+1) and at most capacity/k; a bin of class k takes
exactly k of them. Each task fills its own bins, so nothing is shuffled and a
lost task is simply run again.

What a full bin would pad is filled from the front of the documents that come
next, and only there is a document cut short of a whole sequence: no piece is
left smaller than ``least``, and gaps smaller than that stay padding. Bins that
are open when a task ends are put together in the same way, in the order of
their classes, and the task's last sequence is padded.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosemill.llm.runtime import release

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
#: Pieces of a batch that is passed on, and texts that are Python objects at a time.
_ROWS, _TEXTS = 512, 128


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> Callable[[str], np.ndarray]:
    """Encoder of a byte-level BPE file of the tokenizers library, without added special tokens.

    Where ids follow the merge order, the faster encoder over the same ranks
    is used; the library itself encodes texts with special strings in them and
    what the faster one refuses.
    """
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    spec = json.loads(whole.to_str())
    special = [t["content"] for t in spec["added_tokens"]]

    def slow(text: str) -> np.ndarray:
        return np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4")

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*shown}))}
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    vocab = {w: i for w, i in model["vocab"].items() if w not in special}
    merged = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model.get("merges", [])]
    plain = model.get("type", "BPE") == "BPE" and not (spec.get("normalizer") or model.get("dropout") or model.get("ignore_merges"))
    if not plain or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True) or merged != sorted(merged) or len({*merged}) != len(merged):
        return slow
    # The split pattern that the ByteLevel pre-tokeniser is documented to use (fixed value).
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    ranks = {bytes(letters[c] for c in w): i for w, i in vocab.items()}
    quick = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return slow(text)
        try:
            return np.array(quick.encode_ordinary(text), dtype="<u4")
        except (KeyboardInterrupt, SystemExit):
            raise
        except BaseException:  # its pattern matcher panics on some very long runs
            return slow(text)

    return encode


class _Bins:
    """The open bins of one task. A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, capacity: int, task: int, least: int | None) -> None:
        self.capacity, self.base, self.made, self.least = capacity, task << 40, 0, least
        self.open: dict[int, list[tuple]] = {}
        self.short: list[tuple] = []
        self.rows: list[tuple] = []

    def _room(self) -> int:
        """What the bin that waits to be filled up can still take; 0 where none waits."""
        return self.capacity - sum(len(p[2]) for p in self.short) if self.short else 0

    def _close(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), total, self.base + self.made, at, ids.tobytes()))
            at += len(ids)
        self.made += 1

    def _fill(self, piece: tuple) -> tuple | None:
        """Puts the piece, or its front, into the waiting bin; returns what is left of it."""
        doc, start, ids, total = piece
        room, size = self._room(), len(ids)
        if not room:
            return piece
        take = size if size <= room else min(room, size - self.least)
        if take < min(self.least, size):
            return piece
        self.short.append((doc, start, ids[:take].copy(), total))
        if self._room() < self.least:
            self._close(self.short)
            self.short = []
        return (doc, start + take, ids[take:], total) if take < size else None

    def add(self, piece: tuple) -> None:
        """A whole document."""
        rest = self._fill(piece)
        if rest is None:
            return
        doc, start, ids, total = rest
        while len(ids) >= self.capacity:
            self._close([(doc, start, ids[: self.capacity], total)])
            start, ids = start + self.capacity, ids[self.capacity :]
        if not len(ids):
            return
        k = self.capacity // len(ids)
        pieces = self.open.setdefault(k, [])
        pieces.append((doc, start, ids.copy(), total))  # a view would hold the ids of the whole document while the bin is open
        if len(pieces) == k:
            self._full(self.open.pop(k))

    def _full(self, pieces: list[tuple]) -> None:
        waiting, self.short = self.short, pieces
        if self.least is None or self._room() < self.least:
            self._close(pieces)
            self.short = waiting
        elif waiting:
            self._close(waiting)

    def finish(self) -> None:
        """The bins that are still open, by class: the first that waits is filled from the others."""
        for k in sorted(self.open):
            pieces = self.open.pop(k)
            if self.least is None:
                self._close(pieces)
                continue
            for piece in pieces:
                while (left := self._fill(piece)) is not None and self.short and len(left[2]) < len(piece[2]):
                    piece = left
                if left is not None:
                    waiting, self.short = self.short, [left]
                    if waiting:
                        self._close(waiting)
        if self.short:
            self._close(self.short)
            self.short = []

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows, strict=True)) or [[]] * len(NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(NAMES, columns, strict=True)], NAMES)


def _packed(batches: Iterator[pa.RecordBatch], encode: Callable[[str], np.ndarray], end_id: int, bins: _Bins) -> Iterator[pa.RecordBatch]:
    """The pieces of one task's batches (id, text), in batches. Besides the batch it holds few texts, few pieces and the open bins."""
    end = np.array([end_id], dtype="<u4")
    for batch in batches:
        for at in range(0, batch.num_rows, _TEXTS):
            part = batch.slice(at, _TEXTS)
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text or ""), end)
                bins.add((doc, 0, ids, len(ids)))
                if len(bins.rows) >= _ROWS:
                    yield bins.take()
        release()
    bins.finish()
    yield bins.take()


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, least: int | None = 16, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents and the place of each in its sequence.

    Returns doc_id, start (ids of the document before the piece), length,
    doc_tokens, sequence_id, offset in the sequence, and ids (little-endian
    unsigned 32-bit, as binary). A document's ids are those of its whole text
    and then end_id, so null and empty texts give the one id end_id. With
    least=None documents are cut at whole sequences only, and bins keep their
    padding. Repeated ids and null ids are packed like any other row, other
    columns are not read, and an empty table gives no rows.
    """
    if capacity < 1 or least is not None and not 1 <= least <= max(1, capacity // 2):
        raise ValueError("the capacity is at least 1, and the least piece at most half of it")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packed(batches, byte_bpe(tokenizer_path), end_id, _Bins(capacity, TaskContext.get().partitionId(), least))

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, SCHEMA)
