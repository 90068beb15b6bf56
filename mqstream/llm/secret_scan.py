"""Secret scan with multipart credential linking.

Base kinds (assignments, access identifiers, long hexadecimal runs) are reported wherever they occur.
Weaker parts are common in clean text and are reported only where complementary parts meet inside one
scope: the parts are half-open intervals of a document, of any length; the scope is a run of lines without an
empty line, in which at most ``reach`` code points lie between the end of one part and the start of the other;
and the join of the intervals is one ordered sweep per document. A weak secret needs an identifier near it, a weak identifier needs a secret,
and an endpoint is reported only when both are there.

Null and empty texts give no spans. Repeated rows and rows with null ids give results each. Spans that start at one
place are ordered by kind. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, small_batches, texts_of

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: Weak parts. An identifier or a secret alone is too common to report.
WEAK_ID = re.compile(r"""(?:user(?:name)?|login|client_?id|account(?:_?id)?|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]{3,})""", re.I | re.A)
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/=_-])")
ENDPOINT = re.compile(r"""(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|jdbc:[a-z]+)://[^\s"'<>]{4,}""")
BLANK = re.compile(r"\n[\x20\t\r]*\n")
KINDS = ("assign", "access", "hex", "linked_id", "linked_secret", "linked_endpoint")
HEX_ONLY = bytes.maketrans(bytes(range(256)), bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256)))


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int

    def __str__(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


def base_spans(raw: bytes, text: str | None = None) -> list[Span]:
    """The base kinds, leftmost and non-overlapping within a kind, ordered by start and kind."""
    low = raw.lower()
    assign = any(k in low for k in (b"passw", b"secret", b"token", b"api"))
    access, hexes = b"AKIA" in raw, b"x" * 32 in raw.translate(HEX_ONLY)
    if not (assign or access or hexes):
        return []
    text = raw.decode() if text is None else text
    found = [Span("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if assign else []
    found += [Span("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16] if access else []
    found += [Span("hex", *m.span()) for m in HEX.finditer(text)] if hexes else []
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def scopes(text: str) -> list[int]:
    """Starts of the scopes: a blank line ends one."""
    return [0, *(m.end() for m in BLANK.finditer(text))]


def mixed(token: str) -> bool:
    """Whether a run looks drawn at random: three character classes and enough different characters."""
    classes = sum(bool(re.search(c, token)) for c in ("[a-z]", "[A-Z]", "[0-9]"))
    return classes == 3 and len(set(token)) >= min(14, len(token) // 2)


def linked_spans(raw: bytes, base: list[Span], reach: int, text: str | None = None) -> list[Span]:
    """Weak parts whose complement lies in the same scope within ``reach`` code points."""
    low = raw.lower()
    named = any(k in low for k in (b"user", b"login", b"client", b"account", b"access"))
    if not (named or base):
        return []
    text = raw.decode() if text is None else text
    weak_ids = [Span("linked_id", *m.span()) for m in WEAK_ID.finditer(text)] if named else []
    strong_ids, strong_secrets = [s for s in base if s.kind == "access"], [s for s in base if s.kind != "access"]
    ids = sorted(weak_ids + strong_ids, key=lambda s: s.start)
    if not ids:
        return []
    taken = sorted((s.start, s.end) for s in [*ids, *strong_secrets])
    tops = list(itertools.accumulate((end for _, end in taken), max))

    def free(a: int, b: int) -> bool:
        k = bisect.bisect_left(taken, (b,))
        return not k or tops[k - 1] <= a

    weak_secrets = [Span("linked_secret", *m.span()) for m in WEAK_SECRET.finditer(text) if free(*m.span()) and mixed(m[0])]
    endpoints = [Span("linked_endpoint", *m.span()) for m in ENDPOINT.finditer(text)] if "://" in text else []
    starts = scopes(text)
    secrets = sorted(strong_secrets + weak_secrets, key=lambda s: s.start)

    def near(of: list[Span], to: list[Span]) -> list[bool]:
        """For each interval of ``of``, whether one of ``to`` is in its scope and within reach, from the end of one to the
        start of the other; ``to`` is ordered by start. No part goes beyond its scope, so the furthest end so far is in the same one."""
        at, ends, out = [s.start for s in to], list(itertools.accumulate((s.end for s in to), max)), []
        for s in of:
            n = bisect.bisect_right(starts, s.start)
            first = bisect.bisect_left(at, starts[n - 1])
            last = min(bisect.bisect_right(at, s.end + reach), bisect.bisect_left(at, starts[n]) if n < len(starts) else len(at))
            out.append(last > first and ends[last - 1] >= s.start - reach)
        return out

    id_hit, secret_hit = near(ids, secrets), near(secrets, ids)
    out = [s for s, hit in zip(ids, id_hit, strict=True) if hit and s.kind == "linked_id"]
    out += [s for s, hit in zip(secrets, secret_hit, strict=True) if hit and s.kind == "linked_secret"]
    pairs = [s for s, hit in zip(ids, id_hit, strict=True) if hit]
    out += [s for s, hit in zip(endpoints, near(endpoints, pairs), strict=True) if hit]
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 400) -> DataFrame:
    """One row per document: id and ``spans`` array<struct<kind,start,end>>, ordered by start then kind."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            out = []
            for raw in texts_of(b):
                base = base_spans(raw)
                every = sorted([*base, *linked_spans(raw, base, reach)], key=lambda s: (s.start, KINDS.index(s.kind)))
                out.append([{"kind": s.kind, "start": s.start, "end": s.end} for s in every])
            yield batch_of({"id": (b.column(0).to_pylist(), pa.int64()), "spans": (out, kind)})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, spans array<struct<kind:string,start:long,end:long>>").withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of ``scan``'s rows: counts, the hash of the base spans and all spans as text."""
    as_text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        id_col, *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(F.concat_ws(",", F.transform(base, as_text)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", as_text)).alias("spans"),
    )


def sql() -> str:
    """The digest for DuckDB: parts by regular expressions, links by joins of intervals. Places are sums of the lengths of
    what lies between the matches. Case folds for ASCII alone, as in the patterns."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    low = "translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def found(rank: int, pattern: str, text: str = "t", group: int = 0) -> str:
        p = quoted(pattern)
        return f"SELECT doc_id, {rank} AS rank, regexp_extract_all({text}, {p}) AS ms, regexp_extract_all({text}, {p}, {group}) AS own, string_split_regex({text}, {p}) AS gaps FROM d WHERE regexp_matches({text}, {p})"

    assign, weak_id = ASSIGN.pattern.lower(), WEAK_ID.pattern.lower()
    end = r"""[^\s\x0b\x1c-\x1f\x{85}\p{Z}"'<>]"""
    parts = [
        found(0, assign.replace("[a-za-z0-9", "[a-z0-9"), low, 2), found(1, ACCESS.pattern), found(2, HEX.pattern), found(3, weak_id.replace("[a-za-z0-9", "[a-z0-9"), low),
        found(4, r"[A-Za-z0-9+/=_-]{20,}"), found(5, ENDPOINT.pattern.replace("""[^\\s"'<>]""", end)), found(6, BLANK.pattern),
    ]
    kinds = ", ".join(f"({k}, '{name}')" for k, name in enumerate(KINDS))
    near = "{a}.doc_id = {b}.doc_id AND {a}.scope = {b}.scope AND {a}.s - {b}.e <= 400 AND {b}.s - {a}.e <= 400"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), kind(rank, kind) AS (VALUES {kinds}),
m AS ({" UNION ALL ".join(parts)}),
x AS (SELECT doc_id, rank, unnest(ms) AS x, unnest(own) AS own, unnest(list_transform(range(1, len(ms) + 1), lambda i: list_sum(list_transform(gaps[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda y: length(y))), 0)))::BIGINT AS s FROM m),
b AS (SELECT doc_id, rank, x, s, s + length(x) AS e FROM x WHERE CASE rank WHEN 0 THEN length(own) >= 8 WHEN 1 THEN length(x) >= 16 WHEN 4 THEN regexp_full_match(x, '[A-Za-z0-9+/_-]{{20,}}={{0,2}}')
  AND regexp_matches(x, '[a-z]') AND regexp_matches(x, '[A-Z]') AND regexp_matches(x, '[0-9]') AND len(list_distinct(string_split(x, ''))) >= least(14, length(x) // 2) ELSE true END),
p AS (SELECT *, (SELECT count(*) FROM b z WHERE z.doc_id = b.doc_id AND z.rank = 6 AND z.e <= b.s) AS scope FROM b WHERE rank < 6),
ids AS (SELECT * FROM p WHERE rank IN (1, 3)), strong AS (SELECT * FROM p WHERE rank IN (0, 2)),
secrets AS (SELECT * FROM strong UNION ALL SELECT * FROM p WHERE rank = 4 AND NOT EXISTS (SELECT 1 FROM p o WHERE o.doc_id = p.doc_id AND o.rank < 4 AND p.s < o.e AND o.s < p.e)),
linked AS (SELECT * FROM ids i WHERE EXISTS (SELECT 1 FROM secrets k WHERE {near.format(a="i", b="k")})),
spans AS (SELECT doc_id, rank, s, e FROM p WHERE rank < 3 UNION ALL SELECT doc_id, rank, s, e FROM linked WHERE rank = 3
  UNION ALL SELECT doc_id, rank, s, e FROM secrets k WHERE rank = 4 AND EXISTS (SELECT 1 FROM ids i WHERE {near.format(a="i", b="k")})
  UNION ALL SELECT doc_id, rank, s, e FROM p u WHERE rank = 5 AND EXISTS (SELECT 1 FROM linked i WHERE {near.format(a="i", b="u")})),
named AS (SELECT *, kind || ':' || s || ':' || e AS told FROM spans JOIN kind USING (rank))
SELECT d.doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
  sha256(coalesce(string_agg(told, ',' ORDER BY s, rank) FILTER (rank < 3), '')) AS base_sha256, coalesce(string_agg(told, ',' ORDER BY s, rank), '') AS spans
FROM d LEFT JOIN named USING (doc_id) GROUP BY d.doc_id
"""
