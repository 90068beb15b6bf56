"""Approximate nearest neighbours by additive quantisation.

A vector is coded as the sum of one codeword from each of LEVELS codebooks of full dimension. The codebooks
are fitted level by level on the residuals of a bounded sample (about FIT_ROWS vectors chosen by hash); codes
are found by beam search of width BEAM. With its code a vector stores its norm and the length of what the code
leaves over. Lookup tables of query-by-codeword products score inner products directly, and Euclidean distances
with the norm; the rest's length bounds how far such a score can be off.

Codes stay where they are, in partitions of at most TASK_CODES (about) sorted by their first word, which is a coarse
quantiser. Queries come to them: a bounded block of queries, as one broadcast, and every task keeps a running list of
the best for each. A query's bar is the exact score of the ``keep``-th best it has; it starts at that of the fitting
sample, which is part of the table. Cells whose vectors cannot reach the bar (product with the first word, plus the
radius of the cell; or the largest stored norm) are passed over; of the others every vector whose score by tables
plus its bound reaches the bar is scored exactly, however many they are (a large group of nearly equal vectors, which
no code tells apart, is scored whole, by matrix products). So no fixed number of candidates decides what is found,
and a task gives back only what reaches the bar; these are merged and ranked.

Equal vectors are one candidate; after ranking it stands for its k + 1 smallest ids, which is exact. Vectors that
are null, zero, or hold a null or non-finite component take no part. Vectors of different lengths have no inner
product: each length, of at most MOST_LENGTHS, is a search of its own. Of rows that repeat an id one counts. Ties
go to the smaller id. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batch_of, saved, settled, small_batches

LEVELS, WORDS, BEAM, FIT_ROWS = 24, 256, 4, 16384
#: Queries whose tables are held at once, codes that a task holds and scores at once, and bytes of queries broadcast at once.
QUERY_BLOCK, TASK_CODES, CODE_BLOCK, QUERY_BYTES = 256, 1 << 17, 4096, 8 << 20
MOST_LENGTHS = 64
CODED = [("rep", pa.int64()), ("cell", pa.int32()), ("code", pa.binary()), ("norm", pa.float64()), ("error", pa.float64()), ("x", pa.binary())]


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = (x @ c.T - 0.5 * (c * c).sum(1)).argmax(1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
        if (empty := np.flatnonzero(n == 0)).size:
            c[empty] = x[rng.choice(len(x), empty.size)]
    return c


def fit(sample: np.ndarray, levels: int = LEVELS, words: int = WORDS, seed: int = 3) -> np.ndarray:
    """Codebooks [levels, words, dimension]."""
    rng = np.random.default_rng(seed)
    words = min(words, len(sample))
    books = np.zeros((levels, words, sample.shape[1]), np.float32)
    rest = sample.copy()
    for m in range(levels):
        books[m, : min(words, len(rest))] = kmeans(rest, words, rng)
        rest = rest - books[m][(rest @ books[m].T - 0.5 * (books[m] ** 2).sum(1)).argmax(1)]
    return books


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Codes [n, levels] by beam search: the sums kept are those nearest to the vector so far."""
    levels, words, _ = books.shape
    out = np.empty((len(x), levels), np.int64)
    for lo in range(0, len(x), 2048):
        v = x[lo : lo + 2048]
        n = len(v)
        rest, codes = v[:, None, :], np.zeros((n, 1, 0), np.int64)
        for m in range(levels):
            norm = (books[m] ** 2).sum(1)
            # Squared distance after adding a word, without each vector's own constant at the first level.
            loss = (rest**2).sum(2)[:, :, None] - 2 * rest @ books[m].T + norm
            width = min(beam, loss.shape[1] * words)
            flat = loss.reshape(n, -1)
            pick = np.argpartition(flat, width - 1, axis=1)[:, :width]
            of, word = pick // words, pick % words
            rest = np.take_along_axis(rest, of[:, :, None], 1) - books[m][word]
            codes = np.concatenate([np.take_along_axis(codes, of[:, :, None], 1), word[:, :, None]], axis=2)
        best = (rest**2).sum(2).argmin(1)
        out[lo : lo + n] = codes[np.arange(n), best]
    return out


def errors_of(x: np.ndarray, codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """For each vector the most by which its inner product with a query of length 1 can differ from the tables' score: the
    length of its residual, and what single precision may lose."""
    rest = x.astype(np.float64)
    for m in range(len(books)):
        rest -= books[m][codes[:, m]]
    rounding = (len(books) + x.shape[1]) * 2.0**-22 * np.sqrt((books.astype(np.float64) ** 2).sum(2).max(1)).sum()
    return np.sqrt((rest**2).sum(1)) * (1 + 1e-9) + rounding


def tables_of(queries: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Products of codewords and queries [level, word, query]."""
    return np.einsum("qd,mwd->mwq", queries, books, optimize=True).astype(np.float32)


def score_block(tables: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Approximate inner products [codes, queries] by lookup tables."""
    out = np.zeros((len(codes), tables.shape[2]), np.float32)
    for m in range(len(tables)):
        out += tables[m][codes[:, m]]
    return out


def spared(bars: np.ndarray) -> np.ndarray:
    """Bars lowered by what rounding may lose in exact scores and in a sum with halves of norms."""
    return np.where(np.isfinite(bars), bars - 1e-9 * (np.abs(bars) + 1), bars)


class Cells:
    """The coded vectors of a task, by cell: (rep, cell, code, norm, error, x) sorted by cell."""

    def __init__(self, held: pa.Table, books: np.ndarray, euclidean: bool):
        kind = np.uint8 if books.shape[1] <= 256 else np.uint16
        self.ids, self.books, self.euclidean = held["rep"].to_numpy(), books, euclidean
        self.codes = np.frombuffer(b"".join(held["code"].to_pylist()), kind).reshape(len(self.ids), -1)
        self.x = np.frombuffer(b"".join(held["x"].to_pylist()), np.float32).reshape(len(self.ids), -1)
        self.norms, self.errors = held["norm"].to_numpy(), held["error"].to_numpy()
        # What a score takes off the product: half the squared norm ranks by distance.
        self.halves = 0.5 * self.norms if euclidean else np.zeros(len(self.ids))
        cells = held["cell"].to_numpy()
        self.edges = np.concatenate([[0], np.flatnonzero(np.diff(cells)) + 1, [len(cells)]])
        self.words = books[0][cells[self.edges[:-1]]].astype(np.float64)
        rest = np.sqrt(((self.x.astype(np.float64) - books[0][cells]) ** 2).sum(1))
        self.radius = np.maximum.reduceat(rest, self.edges[:-1]) * (1 + 1e-9)
        self.longest = np.sqrt(np.maximum.reduceat(self.norms, self.edges[:-1])) * (1 + 1e-9)
        self.least = np.minimum.reduceat(self.halves, self.edges[:-1])

    def bounds(self, queries: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The most that a vector of a cell can score [queries, cells]."""
        return np.minimum(queries @ self.words.T + lengths[:, None] * self.radius, lengths[:, None] * self.longest) - self.least


class Running:
    """The best of what a block of queries has met so far, and each query's bar."""

    def __init__(self, queries: np.ndarray, bars: np.ndarray, keep: int):
        self.queries, self.keep, self.bars = queries.astype(np.float64), keep, bars.copy()
        self.lengths = np.sqrt((self.queries**2).sum(1))
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Take in (query row, score, id); merged once they are many."""
        self.found.append((rows, scores, ids))
        self.waiting += len(rows)
        if self.waiting > self.keep * len(self.queries):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best ``keep`` of each query, equal scores by smaller id; bars rise to the last of them."""
        rows, scores, ids = (np.concatenate(c) for c in zip((np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)), *self.found, strict=True))
        order = np.lexsort((ids, -scores, rows))
        rows, scores, ids = rows[order], scores[order], ids[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        full = rank == self.keep - 1
        self.bars[rows[full]] = np.maximum(self.bars[rows[full]], scores[full])
        stay = rank < self.keep
        best = rows[stay], scores[stay], ids[stay]
        self.found, self.waiting = [best], 0
        return best

    def search(self, cells: Cells) -> None:
        """Meet all cells, the most promising first."""
        bounds = cells.bounds(self.queries, self.lengths)
        tables = tables_of(self.queries.astype(np.float32), cells.books)
        for c in np.argsort(-(bounds - np.where(np.isfinite(self.bars), self.bars, 0.0)[:, None]).max(0), kind="stable"):
            for low in range(cells.edges[c], cells.edges[c + 1], CODE_BLOCK):
                asked = np.flatnonzero(bounds[:, c] >= spared(self.bars))
                if len(asked):
                    self.meet(cells, slice(low, min(low + CODE_BLOCK, cells.edges[c + 1])), asked, tables[:, :, asked] if 2 * len(asked) < len(self.queries) else tables)

    def meet(self, cells: Cells, part: slice, asked: np.ndarray, tables: np.ndarray) -> None:
        near = score_block(tables, cells.codes[part]).T
        near = near if len(near) == len(asked) else near[asked]
        near = near - cells.halves[part]
        lengths, bars = self.lengths[asked, None], spared(self.bars[asked])[:, None]
        reach = (near + lengths * cells.errors[part] >= bars) & (lengths * np.sqrt(cells.norms[part]) * (1 + 1e-9) - cells.halves[part] >= bars)
        some = np.flatnonzero(reach.any(0))
        if len(some):
            exact = self.queries[asked] @ cells.x[part][some].astype(np.float64).T - cells.halves[part][some]
            hit, at = np.nonzero(reach[:, some] & (exact >= bars))
            self.add(asked[hit], exact[hit, at], cells.ids[part][some[at]])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): the rows that take part, one for each id."""
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(~bad & F.exists(vector_col, lambda x: x != 0))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>").alias("v"))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float32).reshape(len(column), -1)


def coded_vectors(reps: DataFrame, books: np.ndarray) -> DataFrame:
    """(rep, cell, code, norm, error, x), sorted by cell within each partition: written once, and read in place."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.uint8 if books.shape[1] <= 256 else np.uint16
        for b in batches:
            x = matrix(b.column(1))
            codes = encode(x, books)
            norms = (x.astype(np.float64) ** 2).sum(1)
            columns = b.column(0).to_pylist(), codes[:, 0].tolist(), [c.tobytes() for c in codes.astype(kind)], norms.tolist(), errors_of(x, codes, books).tolist(), [v.tobytes() for v in x]
            yield batch_of({name: (values, of) for (name, of), values in zip(CODED, columns, strict=True)})

    # Coding and scoring are the work here, so they are dealt to all cores however few files the vectors are in.
    tasks = max(reps.sparkSession.sparkContext.defaultParallelism, -(-reps.count() // TASK_CODES))
    coded = reps.repartition(tasks, "rep").mapInArrow(pack, "rep long, cell int, code binary, norm double, error double, x binary")
    return saved(coded.sortWithinPartitions("cell", "rep"), "coded")


def nearest(coded: DataFrame, asked: pa.Table, sample: np.ndarray, books: np.ndarray, keep: int, measure: str) -> DataFrame:
    """(query, rep, score): for each of the queries (query, v) at least the ``keep`` best of all vectors, by exact scores."""
    names, queries = asked["query"].to_numpy(), matrix(asked["v"].combine_chunks())
    euclidean = measure == "euclidean"
    bars = np.full(len(names), -np.inf)
    known = sample.astype(np.float64)
    halves = 0.5 * (known**2).sum(1) if euclidean else 0.0
    for k in range(0, len(names), QUERY_BLOCK):
        if len(known) >= keep:
            scores = queries[k : k + QUERY_BLOCK].astype(np.float64) @ known.T - halves
            bars[k : k + QUERY_BLOCK] = np.partition(scores, len(known) - keep, axis=1)[:, len(known) - keep]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches, pa.schema(CODED))
        if not held.num_rows:
            return
        cells = Cells(held, books, euclidean)
        for k in range(0, len(names), QUERY_BLOCK):
            block = Running(queries[k : k + QUERY_BLOCK], bars[k : k + QUERY_BLOCK], keep)
            block.search(cells)
            rows, scores, ids = block.merge()
            yield batch_of({"query": (names[k + rows].tolist(), pa.int64()), "rep": (ids.tolist(), pa.int64()), "score": (scores.tolist(), pa.float64())})

    return coded.mapInArrow(search, "query long, rep long, score double")


def search(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", measure: str = "inner", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest other rows. Queries are ids divisible by ``every``; the score
    is the inner product, or minus the Euclidean distance."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = settled(usable(vectors, id_col, vector_col).withColumn("d", F.size("v")), "vectors")
    lengths = [r["d"] for r in rows.select("d").distinct().orderBy("d").limit(MOST_LENGTHS + 1).collect()]
    if len(lengths) > MOST_LENGTHS:
        raise ValueError(f"vectors of more than {MOST_LENGTHS} lengths")
    found = [search_one(rows.where(F.col("d") == d).select("vec_id", "v"), every, k, measure, max(1, query_bytes // (4 * d))) for d in lengths]
    return reduce(DataFrame.union, found) if found else spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def search_one(rows: DataFrame, every: int, k: int, measure: str, at_once: int) -> DataFrame:
    """The search among vectors of one length, ``at_once`` queries (about) at a time."""
    reps = settled(rows.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("held")).select("rep", "v", "held"), "distinct")
    copies = reps.where("held > 1").select(F.col("v").alias("_v"), F.col("rep").alias("_rep"))
    first = Window.partitionBy("rep").orderBy("vec_id")
    members = rows.join(copies, F.col("v") == F.col("_v"), "left").select(F.coalesce("_rep", "vec_id").alias("rep"), "vec_id")
    members = settled(members.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).select("rep", "vec_id"), "members")
    share = min(1.0, FIT_ROWS / max(1, reps.count()))
    sample = reps.where(F.pmod(F.xxhash64(F.lit(9), "rep"), F.lit(1 << 20)) < int(share * (1 << 20))).select("rep", "v").orderBy("rep").toArrow()  # about FIT_ROWS rows
    if not sample.num_rows:  # a chance of a tiny table
        sample = reps.select("rep", "v").orderBy("rep").limit(1).toArrow()
    known = matrix(sample["v"].combine_chunks())
    books = fit(known)
    coded = coded_vectors(reps.select("rep", "v"), books)
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query"), "v")
    turns = max(1, -(-asked.count() // at_once))
    lists = []
    for turn in range(turns):
        block = asked.where(F.pmod(F.xxhash64(F.lit(13), "query"), F.lit(turns)) == turn).orderBy("query").toArrow()  # about at_once rows
        if block.num_rows:
            # Twice as many as are asked for: the rest are for scores that differ by rounding only.
            lists.append(settled(nearest(coded, block, known, books, 2 * (k + 1), measure), "nearest"))
    if not lists:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    near = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    pairs = reduce(DataFrame.union, lists).withColumn("n", F.row_number().over(near)).where(F.col("n") <= 2 * (k + 1)).select("query", "rep")
    joined = pairs.join(reps.select("rep", F.col("v").alias("c")), "rep").join(asked.withColumnRenamed("v", "q"), "query")
    term = (lambda a, b: a.cast("double") * b.cast("double")) if measure == "inner" else (lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double")))
    exact = F.aggregate(F.zip_with("q", "c", term), F.lit(0.0), lambda a, x: a + x)
    scored = joined.select("query", "rep", (exact if measure == "inner" else -F.sqrt(exact)).alias("score"))
    top = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    best = scored.withColumn("n", F.row_number().over(top)).where(F.col("n") <= k + 1).select("query", "rep", "score")
    rank = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    out = best.join(members, "rep").where("vec_id <> query").withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
    return out.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
