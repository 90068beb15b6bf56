"""License scan by canonical digests, with DataFrame operations only.

A text is brought to a canonical form: lower case, every run of characters other than letters and digits
is one space, copyright lines go, and equivalent spellings are made one. A copyright line has the form of one:
the word or sign before a sign, a year, a blank to be filled in or a capitalised holder. A line of a wrapped text
that begins with such a word ('copyright notice', 'copyright holders', item '(c)') stays. The MD5 digest of the whole
form is hash-joined to the digests of known licences, which pass through the same expressions; and so that one-line
notices inside a document are found, the digest of each line's form, however long the line, is looked up among them.

Each text is canonicalised once, in one pass without a shuffle. The known digests are a bounded list: the built-in
ones, and those of a table of texts the caller adds, refused beyond MOST. Null and empty texts have the digest of the
empty form and match nothing. Each row has a result of its own, whatever its id; of several names for one digest the
first in order is given. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spread
from .license_texts import ARTICLES, DIGESTS, HEADERS, KNOWN, NAMES, PHRASES, SPELLINGS

#: The most known digests that are sent to the tasks.
MOST = 100_000
HELD = r"^(?i:portions\s+)?(?i:copyright)\b[\s:,]*"
#: A copyright line, unless what follows "copyright" makes it none, also in capitals.
COPYRIGHT_LINE = (
    HELD + r"(?:(?i:\(c\))|©|\d{4}|[<\[{]|(?:(?i:by)\s+)?\p{Lu})"
    r"|^©|^(?i:\(c\))\s*(?:(?i:copyright)\b|.*\b(?:19|20)\d\d\b|(?:\p{Lu}[\p{L}\p{N}.,&'-]*\s*|(?:and|of|the|by|&)\s+)+$)"
    r"|^(?i:all rights reserved)(?:[^\p{L}]*$|\s+(?i:by)\b)"
)
NOT_HELD = HELD + r"(?i:by\s+)?(?i:notices?|holders?|owners?|laws?|licen[sc]e\w*|statements?|and|or|in|on|to|is|of|for|protection|interests?|rights?)\b"
NO_WORD = r"[^\p{L}\p{N}]+"


def canonical_line(line: Column) -> Column:
    """Words in lower case; copyright lines are empty."""
    low = F.lower(line)
    bare = F.btrim(line, F.lit(" \t\r*#/;-"))
    words = F.concat(F.lit(" "), F.btrim(F.regexp_replace(low, NO_WORD, " ")), F.lit(" "))
    for a, b in SPELLINGS:
        words = F.replace(words, F.lit(f" {a} "), F.lit(f" {b} "))
    held = bare.rlike(COPYRIGHT_LINE) & ~bare.rlike(NOT_HELD) & ~low.contains("license")
    return F.when(held, F.lit("")).otherwise(F.btrim(words))


def canonical_lines(text: Column) -> Column:
    """The canonical forms of the lines that are not empty."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), canonical_line), lambda x: x != "")


def digests(texts: DataFrame, id_col: str = "license_id", text_col: str = "body") -> DataFrame:
    """(license_id, license_digest) of texts."""
    return texts.select(F.col(id_col).alias("license_id"), F.md5(F.array_join(canonical_lines(F.col(text_col)), " ")).alias("license_digest"))


def notices() -> list[tuple[str, str]]:
    """(id, line) of the one-line notices."""
    return sorted({(f"notice: {i}", f"{phrase} {article}{name}") for i, names in NAMES.items() for name in names for phrase in PHRASES for article in ARTICLES})


def known(spark: SparkSession, more: DataFrame | None = None) -> dict[str, str]:
    """Digest -> licence of the built-in texts and of ``more`` (license_id, body)."""
    rows = spark.createDataFrame([*KNOWN.items(), *HEADERS.items(), *notices()], "license_id string, body string")
    every = digests(rows).union(spark.createDataFrame(list(DIGESTS.items()), "license_id string, license_digest string"))
    if more is not None:
        every = every.union(digests(more))
    one = every.where(F.col("license_digest") != F.md5(F.lit(""))).groupBy("license_digest").agg(F.min("license_id").alias("license_id"))
    found = dict(tuple(r) for r in one.select("license_digest", "license_id").limit(MOST + 1).collect())
    if len(found) > MOST:
        raise ValueError(f"more than {MOST} known licences")
    return found


def named_by(names: dict[str, str]) -> Callable[[Column], Column]:
    """The licence of a known digest. Looking up a key reads a map from its start, so the digests are dealt to 256 short
    maps by their first two digits."""
    dealt: dict[str, dict[str, str]] = {f"{k:02x}": {} for k in range(256)}
    for d, i in names.items():
        dealt[d[:2]][d] = i
    quoted = lambda items: ", ".join("'" + x.replace("'", "\\'") + "'" for x in items)
    maps = F.expr("array(" + ", ".join(f"map_from_arrays(cast(array({quoted(m)}) AS array<string>), cast(array({quoted(m.values())}) AS array<string>))" for m in dealt.values()) + ")")
    return lambda d: F.try_element_at(F.element_at(maps, F.conv(F.substring(d, 1, 2), 16, 10).cast("int") + 1), d)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: DataFrame | None = None) -> DataFrame:
    """One row per row: id, text_digest, license_id of the whole text or null, n_notices, notices."""
    spark = docs.sparkSession
    names = known(spark, more)
    listed = ", ".join(f"'{d}'" for d in names)
    rows = spread(docs.select(id_col, text_col)).select(F.col(id_col).alias("_id"), canonical_lines(F.col(text_col)).alias("_lines"))
    found = rows.select("_id", F.md5(F.array_join("_lines", " ")).alias("_digest"), F.expr(f"filter(transform(_lines, x -> md5(x)), d -> d IN ({listed}))").alias("_hits"))
    table = spark.createDataFrame(list(names.items()), "license_digest string, license_id string")
    joined = found.join(F.broadcast(table), F.col("_digest") == F.col("license_digest"), "left")  # at most MOST rows
    named = F.transform("_hits", named_by(names))
    return joined.select(
        F.col("_id").alias(id_col), F.col("_digest").alias("text_digest"), "license_id",
        F.size("_hits").cast("long").alias("n_notices"), F.array_join(F.sort_array(F.array_distinct(named)), ",").alias("notices"),
    )


def sql() -> str:
    """The same for DuckDB, for a table without repeated ids."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = lambda pairs: ", ".join(f"({quote(a)}, {quote(b)})" for a, b in pairs)
    ones = lambda items: ", ".join(f"({quote(x)})" for x in items)
    words = "' ' || trim(regexp_replace(lower(line), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' '"
    for a, b in SPELLINGS:
        words = f"replace({words}, ' {a} ', ' {b} ')"
    bare = "trim(line, ' ' || chr(9) || chr(13) || '*#/;-')"
    held = f"regexp_matches({bare}, {quote(COPYRIGHT_LINE)}) AND NOT regexp_matches({bare}, {quote(NOT_HELD)}) AND NOT contains(lower(line), 'license')"
    return f"""
WITH known_text(license_id, body) AS (VALUES {rows([*KNOWN.items(), *HEADERS.items()])}),
phrase(phrase) AS (VALUES {ones(PHRASES)}), article(article) AS (VALUES {ones(ARTICLES)}),
name(id, name) AS (VALUES {rows((i, n) for i, names in NAMES.items() for n in names)}),
src AS (SELECT 'd' AS kind, doc_id, NULL AS license_id, coalesce(text, '') AS body FROM documents
  UNION ALL SELECT 'k', NULL, license_id, body FROM known_text
  UNION ALL SELECT 'k', row_number() OVER (), 'notice: ' || id, phrase || ' ' || article || name FROM phrase, article, name),
cut AS (SELECT kind, doc_id, license_id, string_split(body, chr(10)) AS ls FROM src),
l AS (SELECT kind, doc_id, license_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM cut),
f AS (SELECT *, CASE WHEN {held} THEN '' ELSE trim({words}) END AS form FROM l),
w AS (SELECT kind, doc_id, license_id, md5(coalesce(string_agg(form, ' ' ORDER BY pos) FILTER (form <> ''), '')) AS digest FROM f GROUP BY ALL),
k AS (SELECT digest, min(license_id) AS license_id FROM (SELECT license_id, digest FROM w WHERE kind = 'k'
  UNION ALL SELECT * FROM (VALUES {rows(DIGESTS.items())}) t(license_id, digest)) GROUP BY digest),
n AS (SELECT f.doc_id, count(*) AS n, string_agg(DISTINCT k.license_id, ',' ORDER BY k.license_id) AS names
  FROM f JOIN k ON md5(f.form) = k.digest WHERE f.kind = 'd' AND f.form <> '' GROUP BY f.doc_id)
SELECT w.doc_id, w.digest AS text_digest, k.license_id, coalesce(n.n, 0) AS n_notices, coalesce(n.names, '') AS notices
FROM w LEFT JOIN k ON w.digest = k.digest LEFT JOIN n ON n.doc_id = w.doc_id WHERE w.kind = 'd'
"""
