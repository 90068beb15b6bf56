"""Benchmark decontamination by pigeonhole edit matching.

Texts and test items are normalised (case folded for all of Unicode, composed characters, runs of ASCII punctuation
and white space as one space, a space at either end). An item of m characters may differ by k = floor(rate * m) edits. It is cut into
k + 1 pieces; a passage within k edits holds at least one piece unchanged, so exact hits of the pieces, found
for all items at once by an Aho-Corasick automaton, miss nothing. Around each hit the item is verified with
Myers' bit-parallel distance against the text's best substring.

The items are taken in blocks of at most ``block_bytes``, each block's automaton going to the tasks of one
pass over the documents, so a benchmark of any size is handled; a usual one is a single block. A Python worker
builds a block's automaton once. Items that are null or without words match nothing, and neither do null or empty
texts. Repeated rows match each, and so do rows whose id is null; a null item_id is reported as null. Of equally near
places of an item in a text the first is given. Columns other than ids and texts are ignored; ``clean`` keeps them.
"""

from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, small_batches, spread, texts_of

RATE, BLOCK_BYTES = 0.05, 16 << 20
SPACED = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def normal(raw: bytes) -> str:
    if not raw.isascii():
        # Canonical caseless form: texts that differ in case or composition only are equal.
        raw = unicodedata.normalize("NFC", unicodedata.normalize("NFD", raw.decode()).casefold()).encode()
    words = raw.translate(SPACED).split()
    return f" {b' '.join(words).decode()} " if words else ""


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): budget + 1 pieces of nearly the same length."""
    cuts = [len(item) * k // (budget + 1) for k in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def myers(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(distance, end) of the substring of text nearest to a pattern of m characters, the first such end."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, at = m, 0
    for k, c in enumerate(text):
        eq = masks.get(c, 0)
        x = eq | down
        d = ((((eq & up) + up) ^ up) | eq) & full
        hp = down | (full & ~(d | up))
        hn = up & d
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp, hn = (hp << 1) & full, (hn << 1) & full
        up, down = hn | (full & ~(x | hp)), hp & x
        if score < best:
            best, at = score, k + 1
    return best, at


def masks_of(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for k, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << k
    return out


class Matcher:
    """Finds the items of one block in normalised texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.items = [(i, t, int(rate * len(t))) for i, t in items]
        self.masks: dict[int, dict[str, int]] = {}
        where: dict[str, list[tuple[int, int]]] = {}
        for k, (_, t, budget) in enumerate(self.items):
            for offset, piece in pieces(t, budget):
                where.setdefault(piece, []).append((k, offset))
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item id, start, end, distance, budget): the best place of each item that occurs."""
        if not text or not len(self.automaton):
            return []
        windows: dict[int, list[list[int]]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for k, offset in places:
                _, t, budget = self.items[k]
                start = end + 1 - size - offset
                a, b = max(0, start - budget), min(len(text), start + len(t) + budget)
                spans = windows.setdefault(k, [])
                if spans and a <= spans[-1][1] and spans[-1][0] <= b:
                    spans[-1] = [min(a, spans[-1][0]), max(b, spans[-1][1])]
                else:
                    spans.append([a, b])
        out = []
        for k, spans in windows.items():
            i, t, budget = self.items[k]
            masks = self.masks.setdefault(k, masks_of(t))
            best = min((*myers(masks, len(t), text[a:b]), a) for a, b in spans)
            if best[0] <= budget:
                distance, end, a = best
                # The start: the reversed item against the reversed text before the end.
                back = text[max(0, a + end - len(t) - budget) : a + end][::-1]
                _, length = myers(masks_of(t[::-1]), len(t), back)
                out.append((i, a + end - length, a + end, distance, budget))
        return out


MATCHERS: dict[tuple, Matcher] = {}


def matcher(name: str, items: list[tuple[int, str]], rate: float) -> Matcher:
    """The matcher of a block, built once in a Python worker; it holds one at a time."""
    if (name, rate) not in MATCHERS:
        MATCHERS.clear()
        MATCHERS[name, rate] = Matcher(items, rate)
    return MATCHERS[name, rate]


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """Normalised items, a bounded block at a time."""
    block, held = [], 0
    for row in benchmark.select(F.col(item_col), F.col(text_col)).where(F.col(text_col).isNotNull()).toLocalIterator():
        if text := normal(row[1].encode()):
            block.append((row[0], text))
            held += len(text)
        if held >= block_bytes:
            yield block
            block, held = [], 0
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, start, end, distance, budget) for each document and item it holds; places are in the normalised text."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, start long, end long, distance long, budget long"
    names = [x.split()[0] for x in schema.split(", ")]

    def search(items: list[tuple[int, str]]) -> DataFrame:
        name = uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = matcher(name, items, rate).find
            for b in batches:
                found = [(d, *hit) for d, raw in zip(b.column(0).to_pylist(), texts_of(b), strict=True) for hit in find(normal(raw))]
                columns = list(zip(*found, strict=True)) or [()] * len(names)
                yield batch_of({n: (list(c), pa.int64()) for n, c in zip(names, columns, strict=True)})

        return spread(rows).mapInArrow(run, schema)

    parts = [search(block) for block in blocks_of(benchmark, item_col, text_col, block_bytes)]
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text", item_col: str = "item_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows, with all columns, whose texts hold no item: one pass for each block of items, without a shuffle."""
    small_batches(docs.sparkSession)

    def without(rows: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
        name = uuid.uuid4().hex

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = matcher(name, items, rate).find
            for b in batches:
                yield b.filter(pa.array([not find(normal(raw)) for raw in texts_of(b, text_col)], pa.bool_()))

        return rows.mapInArrow(run, rows.schema)

    return reduce(without, blocks_of(benchmark, item_col, text_col, block_bytes), spread(docs))
