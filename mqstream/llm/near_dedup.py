"""Near-duplicate detection by MinHash with tensored banding.

Each document has two collections of ``bands`` short sub-keys, each made of ``rows`` MinHash values. A table
key is a pair of one sub-key of either collection, so bands * bands tables of 2 * rows values each cost only
2 * bands * rows MinHash values, about the square root of what separate tables would need. Two documents
meet in a table exactly if they share a sub-key of each collection; at similarity s with p = s ** rows that
has probability (1 - (1 - p) ** bands) ** 2, which is 0.996 at 0.8 with the defaults. Sub-keys that only one
document has can meet nothing and are left out before pairs are formed.

Candidates are confirmed on the full shingle sets (64-bit hashes of all shingles):

1. Documents with equal sets are one class, represented by its smallest id; only these go on.
2. In each table the smallest id is the centre; each document is compared with the centre it shares most
   tables with. Confirmed links give first components.
3. Where a table still holds several components, their documents are compared until a link is found. Documents
   have a home block each, of at most about BLOCK documents and BLOCK_SHINGLES shingles: their component's if
   that is large, otherwise their family's, which is what the unconfirmed best centres connect. Blocks that meet
   in such a table are paired once and all their documents compared, but for those connected already, so a row
   is a pair of blocks: neither pairs of documents nor whole groups are ever rows, and no candidate is left out.

Shingles are ``words`` consecutive words, lower-cased A-Z; a shorter text is one shingle; a null or empty
one has none and is linked with nothing. A row without an id is linked with nothing and is kept. Rows with
one id are one document, linked through any of its texts. Extra columns are ignored. ``one_of_each`` decides by
rows instead: of the rows of a group one stays, whatever their ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, forget, fresh, kept, settled, small, small_batches, spread, texts_of
from .components import components

WORDS, PERCENT, BANDS, ROWS = 2, 80, 12, 4
TABLE = ["l", "r"]
BLOCK, BLOCK_SHINGLES = 128, 1 << 16
CHUNK = 8192
ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHash(dict):
    """64-bit hashes of words, remembered up to a bound."""

    keep = 300_000

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(raw: bytes, n: int, hashes: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(hashes) > hashes.keep:
        hashes.clear()
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(n, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64) * ODD
    for j in range(k):
        out = (out ^ h[j : len(words) - k + 1 + j]) * ODD
        out ^= out >> np.uint64(29)
    return np.unique(out)


class Signer:
    """The two collections of sub-keys of a shingle set."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        count = 2 * bands * rows
        self.shape = (2 * bands, rows)
        self.mask = rng.integers(0, 2**63, (count, 1), dtype=np.uint64)
        self.mul = rng.integers(0, 2**63, (count, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.tag = rng.integers(0, 2**63, 2 * bands, dtype=np.uint64)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        least = np.full(len(self.mul), 2**64 - 1, np.uint64)
        for k in range(0, len(shingles), CHUNK):
            values = (shingles[None, k : k + CHUNK] ^ self.mask) * self.mul
            np.minimum(least, values.min(axis=1), out=least)
        groups, key = (least >> np.uint64(16)).reshape(self.shape), self.tag.copy()
        for j in range(self.shape[1]):
            key = (key ^ groups[:, j]) * ODD
            key ^= key >> np.uint64(31)
        return key.view(np.int64)


def signatures(docs: DataFrame, words: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(doc, n, digest, left, right) per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sign = WordHash(), Signer(bands, rows)
        longs = pa.list_(pa.int64())
        for b in batches:
            sets = [shingle_set(raw, words, hashes) for raw in texts_of(b)]
            keys = [sign(s).tolist() if len(s) else [] for s in sets]
            yield batch_of({
                "doc": (b.column(0).to_pylist(), pa.int64()), "n": ([len(s) for s in sets], pa.int64()), "digest": ([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()),
                "left": ([k[:bands] for k in keys], longs), "right": ([k[bands:] for k in keys], longs),
            })

    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return spread(source).mapInArrow(run, "doc long, n long, digest binary, left array<long>, right array<long>")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if not small or 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (small + large - both)


def confirm_pairs(pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (u, v) among rows (u, v, u_text, v_text); rows of one v in a row build its set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, kept = WordHash(), None, None
        for b in batches:
            us, vs = b.column(0).to_pylist(), b.column(1).to_pylist()
            hits = []
            for u, v, x, y in zip(us, vs, texts_of(b, "u_text"), texts_of(b, "v_text"), strict=True):
                if last != (v, y):
                    last, kept = (v, y), shingle_set(y, words, hashes)
                if linked(shingle_set(x, words, hashes), kept, percent):
                    hits.append((u, v))
            yield batch_of({"u": ([u for u, _ in hits], pa.int64()), "v": ([v for _, v in hits], pa.int64())})

    return pairs.select("u", "v", "u_text", "v_text").mapInArrow(run, "u long, v long")


def confirm_blocks(blocks: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (u, v) among rows (xs, ys), lists of (doc, comp, text): enough of them to connect, with the components there
    are, all documents of the two lists that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()

        def sets(items: pa.Scalar) -> list[tuple[int, int, set]]:
            return [(i["doc"], i["comp"], set(shingle_set((i["text"] or "").encode(), words, hashes).tolist())) for i in items.as_py()]

        for b in batches:
            hits = []
            for xs, ys in zip(b.column(0), b.column(1), strict=True):
                root: dict[int, int] = {}

                def find(c: int, root: dict[int, int] = root) -> int:
                    while (up := root.get(c, c)) != c:
                        c = up
                    return c

                ys = sets(ys)
                for u, c, x in sets(xs):
                    low, high = -(-percent * len(x) // 100), 100 * len(x) // percent
                    for v, d, y in ys:
                        if c != d and low <= len(y) <= high and find(c) != find(d):
                            both = len(x & y)
                            if 100 * both >= percent * (len(x) + len(y) - both):
                                hits.append((u, v))
                                root[find(c)] = find(d)
            yield batch_of({"u": ([u for u, _ in hits], pa.int64()), "v": ([v for _, v in hits], pa.int64())})

    return blocks.select("xs", "ys").mapInArrow(run, "u long, v long")


def shared(rows: DataFrame, label: str, *key: str) -> DataFrame:
    """The rows whose key occurs more than once. Counts combine before the shuffle, and a hot key's rows are split."""
    hot = settled(rows.groupBy(*key).count().where("count > 1").select(*key), "hot")
    out = settled(rows.join(hot, list(key)), label)
    forget(hot)
    return out


def table_keys(reps: DataFrame) -> DataFrame:
    """(l, r, doc) for each table in which a document meets another; the table's key is the pair (l, r)."""
    sides = reps.select("doc", F.explode(F.concat(F.transform("left", lambda k: F.struct(F.lit(0).alias("side"), k.alias("sub"))), F.transform("right", lambda k: F.struct(F.lit(1).alias("side"), k.alias("sub"))))).alias("x"))
    met = shared(sides.select("doc", "x.side", "x.sub"), "met", "sub")
    left = met.where("side = 0").select("doc", F.col("sub").alias("l"))
    right = met.where("side = 1").select("doc", F.col("sub").alias("r"))
    tables = shared(left.join(right, "doc").select("l", "r", "doc"), "tables", *TABLE)
    forget(met)
    return tables


def homes(members: DataFrame, mixed: DataFrame) -> DataFrame:
    """(doc, comp, block, only) of the documents in mixed tables; ``only`` is the component of a block that holds no other."""
    held = members.groupBy("comp").agg(F.count("*").alias("held"))
    active = mixed.select("doc").distinct().join(members, "doc").join(settled(held, "held"), "comp")
    home = active.withColumn("only", F.when(F.col("held") > BLOCK, F.col("comp"))).withColumn("home", F.coalesce("only", "family"))
    home = settled(home.select("doc", "comp", "n", "only", "home"), "home")
    by = [F.col("only").isNull().alias("mixed"), "home"]
    lists = home.groupBy(*by).agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).alias("lists"))
    dealt = home.withColumn("mixed", F.col("only").isNull()).join(settled(lists, "lists"), ["mixed", "home"])
    block = F.xxhash64("mixed", "home", F.pmod(F.xxhash64("doc"), F.col("lists")))
    return settled(dealt.select("doc", "comp", block.alias("block"), "only"), "homes")


def links(docs: DataFrame, sigs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Confirmed links (u, v) between representatives that connect what is connected."""
    reps = sigs.where("doc = rep AND n > 0").select("doc", "n", "left", "right")
    tables = table_keys(reps)
    # Each document's best centre.
    centres = settled(tables.groupBy(*TABLE).agg(F.min("doc").alias("centre")), "centres")
    votes = tables.join(centres, TABLE).where("doc <> centre").groupBy("doc", "centre").agg(F.count("*").alias("votes"))
    best = settled(votes.groupBy("doc").agg(F.max_by("centre", F.struct("votes", -F.col("centre"))).alias("centre")), "best")
    forget(centres)
    candidates = settled(tables.select("doc").distinct(), "candidates")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).join(small(candidates), "doc", "left_semi")
    held = [texts := kept(texts)]
    stars = best.join(texts, "doc").select(F.col("doc").alias("u"), F.col("centre").alias("v"), F.col("text").alias("u_text"))
    stars = stars.join(texts.select(F.col("doc").alias("v"), F.col("text").alias("v_text")), "v")
    held.append(first := kept(confirm_pairs(stars, words, percent)))
    # What still meets across components.
    comps = components(first).withColumnRenamed("node", "doc")
    families = components(best.select(F.col("doc").alias("u"), F.col("centre").alias("v"))).select(F.col("node").alias("doc"), F.col("comp").alias("family"))
    members = candidates.join(reps.groupBy("doc").agg(F.max("n").alias("n")), "doc").join(comps, "doc", "left").join(families, "doc", "left")
    members = settled(members.select("doc", "n", F.coalesce("comp", "doc").alias("comp"), F.coalesce("family", "doc").alias("family")), "members")
    placed = settled(tables.join(members.select("doc", "comp"), "doc"), "placed")
    forget(tables)
    open_tables = settled(placed.groupBy(*TABLE).agg(F.min("comp").alias("least"), F.max("comp").alias("most")).where("least < most").select(*TABLE), "open")
    mixed = settled(placed.join(open_tables, TABLE).select(*TABLE, "doc"), "mixed")
    forget(placed, open_tables)
    home = homes(members, mixed)
    met = settled(mixed.join(home, "doc").select(*TABLE, "block", "only").distinct(), "met")
    forget(mixed)
    other = met.select(*TABLE, F.col("block").alias("to"), F.col("only").alias("to_only"))
    pairs = met.join(other, TABLE).where((F.col("block") <= F.col("to")) & ~F.coalesce(F.col("only") == F.col("to_only"), F.lit(False)))
    pairs = settled(pairs.select("block", "to").distinct(), "pairs")
    forget(met)
    held.append(contents := kept(home.join(texts, "doc").groupBy("block").agg(F.collect_list(F.struct("doc", "comp", "text")).alias("xs"))))
    rows = pairs.join(contents, "block").join(contents.select(F.col("block").alias("to"), F.col("xs").alias("ys")), "to")
    found = settled(first.union(confirm_blocks(rows, words, percent)), "links")
    for table in held:
        table.unpersist()
    return found


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id, kept, class_id (the smallest id with an equal set)."""
    small_batches(docs.sparkSession)
    signed = sigs = settled(signatures(docs, words, bands, rows, id_col, text_col), "signed")
    copies = sigs.where("n > 0 AND doc IS NOT NULL").groupBy("digest").agg(F.min("doc").alias("rep"), F.count("*").alias("held"))
    copies = settled(copies.where("held > 1").select("digest", "rep"), "copies")
    sigs = sigs.join(copies, "digest", "left").select("doc", "n", "left", "right", F.coalesce("rep", "doc").alias("rep"))
    sigs = settled(sigs, "sigs")
    forget(signed, copies)
    found = links(docs, sigs.where("doc IS NOT NULL"), words, percent, id_col, text_col)
    # An id with several texts ties their classes together.
    ties = sigs.where("doc IS NOT NULL").groupBy("doc").agg(F.min("rep").alias("u"), F.max("rep").alias("v"), F.collect_set("rep").alias("reps"))
    ties = ties.where("u <> v").select("u", F.explode("reps").alias("v"))
    comps = components(found.union(ties))
    out = sigs.join(comps.select(F.col("node").alias("rep"), "comp"), "rep", "left")
    component = F.coalesce("comp", "rep")
    return out.select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"), F.col("rep").alias("class_id"),
    )


def one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of near duplicates: that with the smallest id (a null one is the largest), and of
    equal rows one. Texts without words all stay.

    Texts are told apart by a 64-bit hash. What goes is a narrow table of ids and hashes that is joined to the rows; only
    rows that stay and are repeated in id and text are gathered by key, and they combine before the shuffle."""
    doc, key, of, at, goes = fresh(docs.columns, "_doc", "_key", "_of", "_at", "_goes")
    keyed = docs.withColumns({doc: F.col(id_col).cast("long"), key: F.xxhash64(text_col)})
    found = near_duplicates(keyed, words, percent, bands, rows, key, text_col)
    comps = found.where("n_shingles > 0").groupBy(F.col(key).alias("key")).agg(F.min("component_id").alias("comp"))
    held = keyed.groupBy(F.col(doc).alias("doc"), F.col(key).alias("key")).agg(F.count("*").alias("held"))
    members = settled(held.join(settled(comps, "comps"), "key"), "members")
    order = F.struct(F.col("doc").isNull(), F.col("doc"), F.col("key"))
    groups = members.groupBy("comp").agg(F.min(order).alias("first"), F.sum("held").alias("held")).where("held > 1").select("comp", "first")
    marks = members.join(small(settled(groups, "groups"), 48), "comp").select(F.col("doc").alias(of), F.col("key").alias(at), (order != F.col("first")).alias(goes), "held")
    marks = settled(marks.where(F.col(goes) | (F.col("held") > 1)).drop("held"), "marks")
    marked = keyed.join(small(marks, 32), F.col(doc).eqNullSafe(F.col(of)) & (F.col(key) == F.col(at)), "left")
    out = marked.where(F.col(goes).isNull()).select(docs.columns)
    if marks.where(~F.col(goes)).isEmpty():
        return out
    return out.union(marked.where(~F.col(goes)).dropDuplicates([doc, key]).select(docs.columns))


#: For DuckDB: all links, found through the rarest shingles of a set (a pair of similarity 0.8 shares one of them), and
#: what they reach.
SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0b\x0c\r]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) < 2 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END)) AS s FROM w),
c AS (SELECT s, min(doc_id) AS rep, len(s) AS n FROM g WHERE len(s) > 0 GROUP BY s),
u AS (SELECT rep, n, unnest(s) AS x FROM c),
f AS (SELECT x, count(*) AS held FROM u GROUP BY x),
o AS (SELECT rep, n, x, row_number() OVER (PARTITION BY rep ORDER BY held, x) AS pos FROM u JOIN f USING (x)),
p AS (SELECT * FROM o WHERE pos <= n - (80 * n + 99) // 100 + 1),
k AS (SELECT DISTINCT a.rep AS a, b.rep AS b FROM p a JOIN p b ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
l AS (SELECT a, b FROM (SELECT k.a, k.b, x.n + y.n AS total, len(list_intersect(x.s, y.s)) AS shared FROM k JOIN c x ON x.rep = k.a JOIN c y ON y.rep = k.b) WHERE 100 * shared >= 80 * (total - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT rep AS a, rep AS b FROM c UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS rep, min(b) AS comp FROM r GROUP BY a)
SELECT g.doc_id, len(g.s) AS n_shingles, coalesce(m.comp, g.doc_id) AS component_id, coalesce(m.comp, g.doc_id) = g.doc_id AS kept, coalesce(c.rep, g.doc_id) AS class_id
FROM g LEFT JOIN c ON g.s = c.s LEFT JOIN m ON m.rep = c.rep
"""
