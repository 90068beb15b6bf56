"""Order-preserving sequence packing by dynamic programming.

Documents are tokenised and laid end to end in the order of their rows. Windows of at most ``width``
tokens cut that run; the cuts minimise padding plus a penalty for each cut that is not the end of a
document. With f(j) the least cost of packing up to cut j,

    f(j) = penalty(j) + min over i in window of  f(i) + width - (pos(j) - pos(i))

is a sliding-window minimum of f(i) + pos(i): a monotone queue keeps it in constant time per cut. A
window whose length is a power of two needs no padding, which adds at most log2(width)+1 further
transitions per cut. Cuts are ends of documents and of sentences; where two of them are further apart
than ``hard_gap`` tokens, every HARD_STEP-th token position between them joins them at a higher penalty.

Work goes in blocks of ``block`` windows, and the last open window of a block starts the next one, so a
task holds one block however long a document is. No shuffle: sequence ids carry the partition number, and
a repeated task gives the same rows. Null and empty texts hold only the end id. Repeated rows are packed
as often as they occur, rows with null ids like others, and of equally cheap cuts the last found one is taken. Columns
other than id and text are ignored.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections import deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, small_batches, texts_of

WIDTH, BLOCK = 2048, 64
#: In tokens of padding: what a cut within a document costs, after a sentence and elsewhere.
SENTENCE_PENALTY, HARD_PENALTY, HARD_STEP = 1.0, 12.0, 16
PARTITION_BITS = 40


class Encoder:
    """Token ids by white-space-separated word, remembered. The tokenizer never joins words over ASCII white space,
    so a text's ids are its words' ids in a row; it lowers case itself, so words may be looked up in lower case."""

    def __init__(self, path: str, end_id: int = 1, keep: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.end, self.keep = Tokenizer.from_file(path), np.asarray([end_id], "<u4"), keep
        self.seen: dict[bytes, bytes] = {}
        self.long: list[bytes] = []
        self.marks = [x.content.encode()[:2] for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends_sentence = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for piece, k in self.tokenizer.get_vocab().items():
            self.ends_sentence[k] = piece.endswith((".</w>", "!</w>", "?</w>"))
        # Byte-level models write a byte as a printable character: itself, or the next one from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [k for k in range(256) if k not in set(shown)]
        self.as_shown = {k: 256 + n for n, k in enumerate(hidden)}

    def word(self, w: bytes) -> bytes:
        """Ids of a word in lower case: a run of letters goes to the model, punctuation behind one is a word of its own."""
        if w.isalpha():  # ASCII letters show as themselves
            shown = w.decode()
        else:
            core = w.rstrip(b".,!?%*$#&|:;)")
            if core and core != w and (core.isalnum() or core.decode()[-1].isalpha()):
                return self.known(core) + self.known(w[len(core) :])
            text = w.decode()
            if not (text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text)):
                return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
            shown = w.decode("latin-1").translate(self.as_shown)
        return self.packed([t.id for t in self.tokenizer.model.tokenize(shown)])

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def known(self, w: bytes) -> bytes:
        if (ids := self.seen.get(w)) is None:
            ids = self.seen[w] = self.word(w)
            if len(w) > 64:
                self.long.append(w)
        return ids

    def __call__(self, raw: bytes) -> np.ndarray:
        if any(m in raw for m in self.marks):  # special tokens keep their case and may split words
            words = raw.split()
            ids = b"".join(self.packed(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids) for w in words)
        else:
            words, seen = raw.lower().split(), self.seen
            if len(seen) >= self.keep:
                seen.clear()
            try:
                ids = b"".join(map(seen.__getitem__, words))
            except KeyError:
                for w in words:
                    if w not in seen:
                        self.known(w)
                ids = b"".join(map(seen.__getitem__, words))
            for w in self.long:  # long words are not worth their room
                seen.pop(w, None)
            self.long.clear()
        return np.concatenate([np.frombuffer(ids, "<u4"), self.end])


@cache
def encoder(path: str) -> Encoder:
    """One per Python worker: the next task finds the words remembered."""
    return Encoder(path)


def plan_cuts(pos: np.ndarray, penalty: np.ndarray, width: int) -> list[int]:
    """Indices of the cheapest cuts from pos[0] to pos[-1]; pos increases and no gap is above width."""
    n, at, cost = len(pos), pos.tolist(), penalty.tolist()
    # For each cut, the earlier cuts at a distance that is a power of two.
    exact: list[list[int] | None] = [None] * n
    size = 1
    while size <= width:
        found = np.searchsorted(pos, pos - size)
        hit = np.flatnonzero(pos[np.minimum(found, n - 1)] == pos - size)
        for j, k in zip(hit.tolist(), found[hit].tolist(), strict=True):
            if exact[j] is None:
                exact[j] = [k]
            else:
                exact[j].append(k)
        size *= 2
    # key = f + pos of the queued cuts, which rises along the queue.
    f, back, key = [0.0] * n, [0] * n, [0.0] * n
    key[0] = float(at[0])
    queue, head = [0], 0
    for j in range(1, n):
        p = at[j]
        while at[queue[head]] < p - width:
            head += 1
        i = queue[head]
        best = key[i] + width - p
        if (steps := exact[j]) is not None:
            for k in steps:
                if f[k] <= best:
                    best, i = f[k], k
        best += cost[j]
        f[j], back[j], key[j] = best, i, best + p
        while len(queue) > head and key[queue[-1]] >= best + p:
            queue.pop()
        queue.append(j)
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


class Packer:
    """Feeds on documents in order and gives the pieces of each finished block of windows."""

    def __init__(self, encoder: Encoder, width: int, block: int, first_sequence: int, hard_gap: int = 64):
        self.encoder, self.width, self.block, self.gap = encoder, width, block, hard_gap
        self.docs: deque = deque()  # [doc id, ids, start within the document]
        self.held, self.sequence = 0, first_sequence

    def feed(self, doc_id: int | None, raw: bytes) -> Iterator[tuple]:
        ids = self.encoder(raw)
        self.docs.append((doc_id, ids, 0, len(ids)))
        self.held += len(ids)
        while self.held >= self.width * (self.block + 1):
            yield from self.cut(last=False)

    def finish(self) -> Iterator[tuple]:
        while self.held:
            yield from self.cut(last=self.held < self.width * (self.block + 1))

    def candidates(self, total: int, last: bool) -> tuple[np.ndarray, np.ndarray]:
        penalty = np.full(total + 1, np.inf)
        done = 0
        for _, ids, start, _ in self.docs:
            part = ids[start : start + total - done]
            penalty[done + 1 : done + 1 + len(part)][self.encoder.ends_sentence[part]] = SENTENCE_PENALTY
            done += len(part)
            if start + len(part) == len(ids):
                penalty[done] = 0.0
            if done >= total:
                break
        penalty[0] = penalty[total] = 0.0
        kept = np.nonzero(np.isfinite(penalty))[0]
        for a, b in zip(kept[:-1].tolist(), kept[1:].tolist(), strict=True):
            if b - a > self.gap:
                penalty[a + HARD_STEP : b : HARD_STEP] = HARD_PENALTY
        if last:  # the remainder may be cut anywhere, into powers of two
            rest = penalty[max(1, total - self.width) : total]
            np.minimum(rest, HARD_PENALTY, out=rest)
        pos = np.nonzero(np.isfinite(penalty))[0]
        return pos, penalty[pos]

    def cut(self, last: bool) -> Iterator[tuple]:
        total = self.held if last else self.width * (self.block + 1)
        pos, penalty = self.candidates(total, last)
        cuts = pos[plan_cuts(pos, penalty, self.width)].tolist()
        if not last and len(cuts) > 2:
            cuts.pop()  # the window at the block's edge is planned again with what follows
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield from self.take(b - a)
            self.sequence += 1

    def take(self, count: int) -> Iterator[tuple]:
        offset = 0
        while offset < count:
            doc_id, ids, start, total = self.docs[0]
            part = ids[start : start + count - offset]
            yield doc_id, start, len(part), zlib.crc32(part), total, self.sequence, offset, part
            offset += len(part)
            if start + len(part) == len(ids):
                self.docs.popleft()
            else:
                self.docs[0] = (doc_id, ids, start + len(part), total)
        self.held -= count


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, width: int = WIDTH, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece of a document; ``with_ids`` adds the piece's token ids."""
    small_batches(docs.sparkSession)
    kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
    names = [x.split()[0] for x in SCHEMA.split(", ")] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        packer = Packer(encoder(tokenizer), width, block, (context.partitionId() if context else 0) << PARTITION_BITS)

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True))[: len(names)]
            return batch_of({n: (list(c), k) for n, c, k in zip(names, columns, kinds, strict=True)})

        for b in batches:
            found = []
            for doc_id, raw in zip(b.column(0).to_pylist(), texts_of(b), strict=True):
                found += packer.feed(doc_id, raw)
            if found:
                yield rows(found)
        if found := list(packer.finish()):
            yield rows(found)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, SCHEMA + ", ids array<int>" * with_ids)
