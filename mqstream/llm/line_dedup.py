"""Line deduplication over levelled sorted runs of line hashes, with DataFrame operations only.

A line's key is the line without ASCII white space at its ends and with A-Z in lower case; keys of at least
``min_chars`` code points count. ``LineRuns`` holds the keys that batches have shown, as sorted runs of
(128-bit hash, number of documents, largest document id): no key is in two runs. A batch merge-anti-joins the
runs; what no run holds becomes a run of its own at level 0, and the rest is noted as seen again. When a level
holds ``fanout`` runs they are compacted into one sorted run of the next level.

``dedup`` handles a whole table: its lines are hashed once and written, dealt to batches by document, and each
batch goes through the runs. A key's documents are those of the run that first showed it and of the batches
that showed it again; if they are ``min_docs`` or more, the key is hot, and its lines go from all of them but
the one with the largest id. Hot keys are joined to the hashed lines, and a row learns which keys it loses.

Null and empty texts are one empty line. A null id counts as one document below all others. Rows that
repeat an id count as one document and each gets its own result row. What a row loses is gathered by id and
hash of the text, so it is bounded by the row's own lines even if one id, or none, is on a third of all rows.
Other columns are kept, but for those named n_lines and n_dropped, which the result replaces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import files_for, fresh, kept, scratch, settled, small, spread

WHITE = "\x20\t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_ID = -(2**63)
HASHES = ["h1", "h2"]
RUN = "h1 long, h2 long, n long, last long"


def key_of(line: Column) -> Column:
    k = F.btrim(line, F.lit(WHITE))
    return F.when(F.octet_length(k) == F.char_length(k), F.lower(k)).otherwise(F.translate(k, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit(1), key)


def identity(id_col: str, text_col: str) -> tuple[Column, Column]:
    """What tells a row: its id and the hash of its text. Rows alike in both lose the same lines."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), F.xxhash64(F.col(text_col))


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int, batches: int) -> DataFrame:
    """(doc, row, h1, h2, batch), once for each row and key that counts. A document is in one batch only."""
    doc, row = identity(id_col, text_col)
    rows = spread(docs.select(id_col, text_col)).select(doc.alias("doc"), row.alias("row"), F.explode(lines_of(F.col(text_col))).alias("line"))
    keyed = rows.where(F.char_length("line") >= min_chars).select("doc", "row", key_of(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    h1, h2 = hashes(F.col("key"))
    return keyed.select("doc", "row", h1.alias("h1"), h2.alias("h2")).distinct().withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int"))


class LineRuns:
    """Levels of sorted runs in the shared folder; level k + 1 holds runs compacted from ``fanout`` runs of level k."""

    def __init__(self, spark: SparkSession, fanout: int = 2):
        self.spark, self.fanout = spark, fanout
        self.folder = f"{scratch(spark)}/line-runs-{uuid.uuid4().hex}"
        self.levels: list[list[str]] = [[]]
        self.again: list[str] = []
        self.made = 0

    def _write(self, rows: DataFrame, name: str) -> str:
        """Sorted files, as many as the rows' bytes are worth."""
        path, self.made = f"{self.folder}/{name}-{self.made}", self.made + 1
        held = kept(rows)
        held.count()
        held.coalesce(files_for(held)).sortWithinPartitions(*HASHES).write.parquet(path)
        held.unpersist()
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(RUN).parquet(*paths) if paths else self.spark.createDataFrame([], RUN)

    def _settle(self, path: str, level: int) -> None:
        """Put a run in its level; a full level is compacted. Runs share no key, so compaction only sorts."""
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._settle(self._write(self._read(full), f"level{level + 1}"), level + 1)

    def all(self) -> DataFrame:
        """What the runs of all levels hold: (h1, h2, n, last)."""
        return self._read([p for level in self.levels for p in level])

    def unseen(self, rows: DataFrame) -> DataFrame:
        """The rows (h1, h2, ...) whose keys no run holds: a merge anti-join."""
        return rows.join(self.all().select(*HASHES).hint("merge"), HASHES, "left_anti") if any(self.levels) else rows

    def add(self, lines: DataFrame) -> None:
        """Take in a batch's lines (doc, h1, h2), once for each document and key; a document is in one batch only."""
        batch = kept(lines.groupBy(*HASHES).agg(F.count("*").alias("n"), F.max("doc").alias("last")))
        first = self._write(self.unseen(batch).select(*HASHES, "n", "last"), "level0")
        if any(self.levels):
            again = batch.join(self.all().select(*HASHES).hint("merge"), HASHES, "left_semi")
            self.again.append(self._write(again.select(*HASHES, "n", "last"), "again"))
        batch.unpersist()
        self._settle(first, 0)

    def hot(self, min_docs: int) -> DataFrame:
        """(h1, h2, last): the keys of at least ``min_docs`` documents, with the largest of their ids."""
        more = self._read(self.again).groupBy(*HASHES).agg(F.sum("n").alias("more"), F.max("last").alias("later"))
        every = self.all().join(more, HASHES, "left").where(F.col("n") + F.coalesce("more", F.lit(0)) >= min_docs)
        return every.select(*HASHES, F.greatest("last", "later").alias("last"))


def lost_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int, batches: int) -> DataFrame:
    """(doc, row, lost): for each row that loses lines, the first hashes of their keys."""
    lines = settled(hashed_lines(docs, id_col, text_col, min_chars, batches), "lines", by="batch")
    runs = LineRuns(docs.sparkSession)
    for k in range(batches):
        runs.add(lines.where(F.col("batch") == k).select("doc", *HASHES).distinct())
    hot = settled(runs.hot(min_docs), "hot-lines")
    lost = lines.join(small(hot, 40), HASHES).where(F.col("doc") != F.col("last"))
    return settled(lost.groupBy("doc", "row").agg(F.collect_set("h1").alias("lost")), "lost")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3, batches: int = 4) -> DataFrame:
    """All rows and columns with the text's lines thinned, and with n_lines and n_dropped."""
    of, at, doc, row, gone, stay = fresh(docs.columns, "of", "at", "doc", "row", "lost", "stay")
    lost = lost_keys(docs, id_col, text_col, min_chars, min_docs, batches).select(F.col("doc").alias(doc), F.col("row").alias(row), F.col("lost").alias(gone))
    same = identity(id_col, text_col)
    rows = docs.withColumns({of: same[0], at: same[1]})
    text, lines = F.coalesce(F.col(text_col), F.lit("")), lines_of(F.col(text_col))
    stays = F.filter(lines, lambda x: ~((F.char_length(key_of(x)) >= min_chars) & F.array_contains(gone, hashes(key_of(x))[0])))
    lost = small(lost, 64 + 8 * F.size(gone))
    joined = rows.join(lost, (F.col(of) == F.col(doc)) & (F.col(at) == F.col(row)), "left").withColumn(stay, F.when(F.col(gone).isNotNull(), stays))
    n_lines = (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long")
    others = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    return joined.select(
        *others, F.when(F.col(gone).isNull(), text).otherwise(F.array_join(stay, "\n")).alias(text_col),
        n_lines.alias("n_lines"), F.when(F.col(gone).isNull(), F.lit(0)).otherwise(n_lines - F.size(stay)).cast("long").alias("n_dropped"),
    )


def digest(thinned: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return thinned.select(id_col, "n_lines", "n_dropped", F.sha2(F.col(text_col), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
h AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, h.key IS NOT NULL AND k.doc_id <> h.last AS gone FROM k LEFT JOIN h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
