"""Language identification by Bayesian evidence fusion.

Three kinds of evidence meet in one posterior over the stated languages and "und" (no language):

- the whole text, by a naive Bayes model of hashed byte trigrams of its words without digits, whose counts
  come from all documents by grouped aggregation over their declared language; neighbouring trigrams are not
  independent, so the mean log-likelihood counts for at most EVIDENCE trigrams; "und" is the uniform model;
- the declared markup language, by P(declared | language) counted over all documents against what their
  text says;
- the host and its address suffix: a host's languages, counted softly over its documents without the
  document itself, are smoothed towards its suffix's, and those towards the whole table's.

A document is accepted if its most probable language is a stated one with at least ``least`` posterior.
A null or empty text has no trigrams: its other evidence decides. A text of numbers and signs alone counts
against the stated languages.
Null declared languages and hosts count as values of their own. Rows that repeat an id, and null ids, count each;
of equally probable languages the first stated one is named. Columns other than text, declared and host are carried,
whatever their names, but for language, confidence and accepted, which the result replaces.

Memory: models have a fixed size (languages by hash values). Host counts are aggregated before the shuffle
and joined back as a table, split where a host is hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StringType

from .common import batch_of, fresh, settled, small, small_batches, spread, texts_of
from .ngrams import SIZE, STEP, trigrams

LANGUAGES = ("en", "fr", "de", "es")
EVIDENCE, SMOOTH, HOST_WEIGHT, SUFFIX_WEIGHT, LEAST = 40.0, 0.5, 4.0, 20.0, 0.5
#: Log-odds for "und" of a text that is not empty but has no words.
WORDLESS = 4.0
UND = "und"
DIGITS = bytes(48 if 48 <= c < 58 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
NONE = "none"


def declared_language(column: Column) -> Column:
    """The primary subtag of a language tag, or NONE."""
    tag = F.lower(F.regexp_extract(F.coalesce(column, F.lit("")), r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$", 1))
    return F.when(tag == "", NONE).otherwise(tag)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def suffix_of(host: Column) -> Column:
    return F.regexp_extract(host, r"([^.]*)$", 1)


def markup_language(html: Column) -> Column:
    """What a page declares: the lang attribute of its root, else its content-language."""
    html = F.coalesce(html, F.lit(""))
    root = F.regexp_extract(html, r"""(?i)<html\b[^>]*?\b(?:xml:)?lang\s*=\s*["']?([A-Za-z0-9_-]+)""", 1)
    meta = F.regexp_extract(html, r"""(?i)<meta\b[^>]*?content-language["']?[^>]*?content\s*=\s*["']?([A-Za-z0-9_-]+)""", 1)
    return F.when(root != "", root).otherwise(meta)


def visible_text(html: Column) -> Column:
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<!--.*?-->|<(script|style|nav)\b[^>]*>.*?</\1\s*>", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"&[a-zA-Z#0-9]{1,8};", " ")


def words_of(raw: bytes) -> bytes:
    """The words that hold no digit, lower-cased A-Z, with a space around each; empty without any."""
    words = [w for w in raw.lower().translate(DIGITS).split() if b"0" not in w]
    return b" %b " % b" ".join(words) if words else b""


def steps(raw: bytes) -> Iterator[np.ndarray]:
    """The text's trigrams, a bounded run at a time."""
    for k in range(0, max(0, len(raw) - 2), STEP):
        yield trigrams(raw[k : k + STEP + 2])


def train(rows: DataFrame, languages: tuple[str, ...]) -> np.ndarray:
    """Log-probabilities [language, hash]; the last row is the uniform model."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), SIZE), np.int64)
        for b in batches:
            for lang, raw in zip(b.column(0).to_pylist(), texts_of(b), strict=True):
                for grams in steps(words_of(raw)):
                    if len(grams) > SIZE // 8:
                        total[languages.index(lang)] += np.bincount(grams, minlength=SIZE)
                    else:
                        at, n = np.unique(grams, return_counts=True)
                        total[languages.index(lang), at] += n
        for k in range(len(languages)):
            at = np.flatnonzero(total[k])
            yield batch_of({"lang": ([k] * len(at), pa.int32()), "gram": (at.tolist(), pa.int32()), "n": (total[k, at].tolist(), pa.int64())})

    known = rows.where(F.col("declared").isin(*languages)).select("declared", "text")
    sums = known.mapInArrow(count, "lang int, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()  # at most languages x SIZE rows
    table = np.full((len(languages) + 1, SIZE), SMOOTH)
    table[sums["lang"].to_numpy(), sums["gram"].to_numpy()] += sums["n"].to_numpy()
    table[-1] = 1.0
    return np.log(table / table.sum(axis=1, keepdims=True))


def text_support(raw: bytes, model: np.ndarray) -> np.ndarray:
    """For each class the tempered log-likelihood of the text, 0 for the best."""
    log, total = np.zeros(len(model)), 0
    for grams in steps(words_of(raw)):
        log += model[:, grams].sum(axis=1)
        total += len(grams)
    if total:
        log *= min(total, EVIDENCE) / total
    elif raw.strip():
        log[-1] = WORDLESS
    return log - log.max()


def shares(logs: np.ndarray) -> np.ndarray:
    """Probabilities along the last axis."""
    powers = np.exp(logs - logs.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


def carried(batch: pa.RecordBatch, names: list[str], more: dict[str, pa.Array]) -> pa.RecordBatch:
    """A batch of some of the columns and new ones."""
    return pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), *more.values()], names=[*names, *more])


def evidence(rows: DataFrame, model: np.ndarray, support: str, says: str) -> DataFrame:
    """rows without their text, with ``support`` and, as if all classes were as likely before, ``says``."""
    others = [c for c in rows.columns if c != "text"]
    schema = rows.select(*others).schema.add(support, ArrayType(DoubleType())).add(says, ArrayType(DoubleType()))
    kept = pa.list_(pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.asarray([text_support(raw, model) for raw in texts_of(b)]).reshape(b.num_rows, len(model))
            yield carried(b, others, {support: pa.array(out.tolist(), kept), says: pa.array(shares(out).tolist(), kept)})

    return rows.select(*others, "text").mapInArrow(run, schema)


def declared_given(counts: dict[str, np.ndarray], languages: tuple[str, ...]) -> tuple[dict[str, list[float]], list[float]]:
    """log P(declared | class) for each stated language, NONE and any "other", and each class's share of all texts, from
    the soft counts of the classes by what is declared."""
    size, slots = len(languages) + 1, [*languages, NONE, "other"]
    table = np.asarray([counts.get(s, np.zeros(size)) for s in slots])
    given = np.log((table + SMOOTH) / (table.sum(axis=0) + SMOOTH * len(slots)))
    whole = (table.sum(axis=0) + SMOOTH) / (table.sum() + SMOOTH * size)
    return dict(zip(slots, given.tolist(), strict=True)), whole.tolist()


def declarations(seen: DataFrame, languages: tuple[str, ...], says: str) -> tuple[dict[str, list[float]], list[float]]:
    size = len(languages) + 1
    slot = F.when(F.col("declared").isin(*languages, NONE), F.col("declared")).otherwise("other")
    sums = seen.groupBy(slot.alias("slot")).agg(F.array(*(F.sum(F.col(says)[k]) for k in range(size))).alias("n")).collect()  # at most one row for each slot
    return declared_given({r["slot"]: np.asarray(r["n"]) for r in sums}, languages)


def host_priors(seen: DataFrame, whole: list[float], says: str) -> DataFrame:
    """(of_host, held, prior): a host's soft counts, and what its suffix, smoothed towards the whole, leads to expect."""
    size = len(whole)
    hosts = settled(seen.groupBy("host").agg(*(F.sum(F.col(says)[k]).alias(f"n{k}") for k in range(size))).withColumn("suffix", suffix_of(F.col("host"))), "hosts")
    by_suffix = hosts.groupBy("suffix").agg(*(F.sum(f"n{k}").alias(f"s{k}") for k in range(size)))
    total = sum((F.col(f"s{k}") for k in range(1, size)), F.col("s0")) + SUFFIX_WEIGHT
    prior = F.array(*((F.col(f"s{k}") + SUFFIX_WEIGHT * whole[k]) / total for k in range(size)))
    smoothed = settled(by_suffix.select("suffix", prior.alias("prior")), "suffixes")
    return settled(hosts.join(smoothed, "suffix").select(F.col("host").alias("of_host"), F.array(*(F.col(f"n{k}") for k in range(size))).alias("held"), "prior"), "host-priors")


def posteriors(support: np.ndarray, says: np.ndarray, held: np.ndarray, prior: np.ndarray, declared: np.ndarray) -> np.ndarray:
    """P(class | all evidence) of rows: their texts' support, what they declare, and their hosts' other documents."""
    rest = np.maximum(held - says, 0.0)
    host = (rest + HOST_WEIGHT * prior) / (rest.sum(axis=1, keepdims=True) + HOST_WEIGHT)
    return shares(support + declared + np.log(host))


def identify(rows: DataFrame, languages: tuple[str, ...] = LANGUAGES, least: float = LEAST) -> DataFrame:
    """rows(text, declared, host, ...) without text and host, with language, confidence and accepted."""
    small_batches(rows.sparkSession)
    classes = [*languages, UND]
    rows = spread(rows).withColumn("host", F.coalesce("host", F.lit(""))).drop("language", "confidence", "accepted")
    others = [c for c in rows.columns if c not in ("text", "host")]
    support, says, of_host, held, prior = fresh(rows.columns, "support", "says", "of_host", "held", "prior")
    seen = settled(evidence(rows, train(rows, languages), support, says), "evidence")
    given, whole = declarations(seen, languages, says)
    hosts = host_priors(seen, whole, says).select(F.col("of_host").alias(of_host), F.col("held").alias(held), F.col("prior").alias(prior))
    hosts = small(hosts, 64 + 16 * len(classes) + F.octet_length(of_host))
    joined = seen.join(hosts, F.col("host") == F.col(of_host)).select(*others, support, says, held, prior)

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = lambda c: b.column(b.schema.get_field_index(c)).to_pylist()  # noqa: B023, E731
            of_text, of_row, of_held, of_prior = (np.asarray(column(c)).reshape(b.num_rows, len(classes)) for c in (support, says, held, prior))
            declared = np.asarray([given.get(d, given["other"]) for d in column("declared")]).reshape(of_text.shape)
            posterior = posteriors(of_text, of_row, of_held, of_prior, declared)
            best = posterior.argmax(axis=1)
            sure = posterior[np.arange(len(best)), best]
            named = [classes[k] for k in best]
            yield carried(b, others, {"language": pa.array(named, pa.string()), "confidence": pa.array(sure.tolist(), pa.float64()), "accepted": pa.array([k != UND and p >= least for k, p in zip(named, sure, strict=True)], pa.bool_())})

    schema = joined.select(*others).schema.add("language", StringType()).add("confidence", DoubleType()).add("accepted", BooleanType())
    return joined.mapInArrow(fuse, schema)


def of_documents(docs: DataFrame, *more: Column) -> DataFrame:
    """Documents declare their lang; their source stands for the host. ``more`` columns are carried."""
    host = F.concat(F.lit("source:"), F.coalesce("source", F.lit("")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", declared_language(F.col("lang")).alias("declared"), host.alias("host"), *more)


def of_pages(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), visible_text(F.col("html")).alias("text"), declared_language(markup_language(F.col("html"))).alias("declared"), host_of(F.col("url")).alias("host"))
