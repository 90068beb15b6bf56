"""Quality classifier: naive Bayes features for a linear support vector machine.

Features are indicators of n-grams of the whole text: hashed byte trigrams, and n-grams of up to CLASS_GRAMS
runs of character classes (letters, capitals, digits, blanks, line ends and three kinds of signs; a run of one
class is one symbol). Each indicator is scaled by its class log-count ratio, log((p/|p|) / (q/|q|)) over all
learning rows, counted by grouped aggregation; the ratios of all hashed features are a vector of fixed size. A
linear hinge-loss model is then fitted by dual coordinate descent, with errors weighted so that both classes
weigh the same, in one task on a sample of about ``fit_rows`` learning rows chosen by hash. Scoring is one
pass over the texts.

score = sigmoid(SLOPE * margin + logit(CUT)): the hyperplane lies at CUT, and score >= CUT is class 1.

Learning rows are labelled 0 or 1 and are not held out (crc32 of the id as text modulo 5 is 0). Labels,
ids and columns other than the text never enter a score, whatever their names. Without learning rows of both
classes every score is CUT. Null and empty texts have the constant feature alone. A null id is not held out and has
no label. Rows that repeat an id, and repeated labels, count each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, kept, small_batches, spread, texts_of
from .ngrams import SIZE, STEP, trigrams

FIT_ROWS, EPOCHS, COST = 8000, 12, 0.1
SLOPE, CUT = 1.5, 0.3
CLASS_GRAMS, CLASSES = 5, 8
BIAS = SIZE + sum(CLASSES**n for n in range(1, CLASS_GRAMS + 1))
WIDTH = BIAS + 1


def class_of(c: int) -> int:
    """The class of a byte: letters (and all beyond ASCII), capitals, digits, blanks, line ends, stops, quotes and
    brackets, other signs."""
    ch = chr(c)
    tests = (c > 127 or ch.islower(), ch.isupper(), ch.isdigit(), ch == "\n", ch.isspace(), ch in ".,;:!?", ch in "'\"()-")
    return tests.index(True) if True in tests else len(tests)


CLASS = np.asarray([class_of(c) for c in range(256)], np.uint8)


class Features:
    """Sorted distinct feature numbers of a text."""

    def __init__(self) -> None:
        self.flags = np.zeros(WIDTH, bool)

    def __call__(self, raw: bytes) -> np.ndarray:
        flags = self.flags
        for k in range(0, max(1, len(raw) - 2), STEP):
            flags[trigrams(raw[k : k + STEP + 2])] = True
        s = CLASS[np.frombuffer(raw, np.uint8)]
        s = s[np.flatnonzero(np.diff(s, prepend=CLASSES))].astype(np.int64)
        base, v = SIZE, np.zeros(len(s) + 1, np.int64)
        for n in range(1, CLASS_GRAMS + 1):
            v = v[:-1][: len(s) - n + 1] * CLASSES + s[n - 1 :]
            flags[base + v] = True
            base += CLASSES**n
            if len(v) < 2:
                break
        flags[BIAS] = True
        found = np.flatnonzero(flags)
        flags[found] = False
        return found.astype(np.uint32)


def ratios(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    p, q = positive + 1.0, negative + 1.0
    r = np.log((p / p.sum()) / (q / q.sum()))
    r[BIAS] = 1.0
    return r


def coordinate_descent(rows: list[tuple[int, np.ndarray]], r: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> np.ndarray:
    """Weights of the scaled indicators, from (label, features), by dual coordinate descent on the hinge loss."""
    ones = sum(label for label, _ in rows)
    share = {1: len(rows) / 2 / max(1, ones), 0: len(rows) / 2 / max(1, len(rows) - ones)}
    w, dual, order = np.zeros(WIDTH), np.zeros(len(rows)), np.random.default_rng(7)
    values = [r[x] for _, x in rows]
    norms = [float(v @ v) + 1e-12 for v in values]
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            label, x = rows[i]
            y = 2 * label - 1
            slope = y * float(w[x] @ values[i]) - 1
            new = min(max(dual[i] - slope / norms[i], 0.0), cost * share[label])
            if new != dual[i]:
                w[x] += (new - dual[i]) * y * values[i]
                dual[i] = new
    return w


def held_out(id_col: str):  # noqa: ANN201
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label_col: str, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """One weight per feature: the model's weight times the feature's ratio; zeros if a class is missing."""
    marks = labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col)).select(F.col(id_col).alias("doc"), F.col(label_col).cast("int").alias("label"))
    share = min(1.0, fit_rows / max(1, marks.count()))
    marks = marks.withColumn("fits", F.pmod(F.xxhash64(F.lit(5), "doc"), F.lit(1 << 20)) < int(share * (1 << 20)))
    texts = docs.where(~held_out(id_col)).select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, found = Features(), np.zeros((2, WIDTH), np.int64)
        for b in batches:
            kept: list[tuple] = []
            for doc, label, fits, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), texts_of(b), strict=True):
                x = features(raw)
                found[label, x] += 1
                if fits:
                    kept.append((doc, label, x.tobytes()))
            yield batch_of({"doc": ([k[0] for k in kept], pa.int64()), "label": ([k[1] for k in kept], pa.int32()), "x": ([k[2] for k in kept], pa.binary()), "ones": ([None] * len(kept), pa.int64()), "zeros": ([None] * len(kept), pa.int64())})
        at = np.flatnonzero(found.any(axis=0))
        for k in range(0, len(at), 20_000):
            part = at[k : k + 20_000]
            none = [None] * len(part)
            yield batch_of({"doc": (part.tolist(), pa.int64()), "label": (none, pa.int32()), "x": (none, pa.binary()), "ones": (found[1, part].tolist(), pa.int64()), "zeros": (found[0, part].tolist(), pa.int64())})

    # The same join at every size: which side is small would otherwise decide what is shuffled.
    rows = texts.join(marks.hint("shuffle_hash"), "doc").select("doc", "label", "fits", "text")
    seen = kept(rows.mapInArrow(count, "doc long, label int, x binary, ones long, zeros long"))
    # At most WIDTH rows.
    totals = seen.where("label IS NULL").groupBy("doc").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).toArrow()
    ones, zeros = np.zeros(WIDTH), np.zeros(WIDTH)
    at = totals["doc"].to_numpy()
    ones[at], zeros[at] = totals["ones"].to_numpy(), totals["zeros"].to_numpy()
    if not ones[BIAS] or not zeros[BIAS]:
        seen.unpersist()
        return np.zeros(WIDTH)
    r = ratios(ones, zeros)

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((d, l, x) for b in batches for d, l, x in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True))  # noqa: E741
        w = coordinate_descent([(label, np.frombuffer(x, np.uint32)) for _, label, x in rows], r)
        yield batch_of({"w": ([(w * r).tobytes()], pa.binary())})

    sample = seen.where("label IS NOT NULL").select("doc", "label", "x").coalesce(1)  # about fit_rows rows
    weights = np.frombuffer(sample.mapInArrow(descend, "w binary").first()["w"])
    seen.unpersist()
    return weights


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        shift = np.log(CUT / (1 - CUT))
        for b in batches:
            margins = np.asarray([weights[features(raw)].sum() for raw in texts_of(b)])
            z = np.clip(SLOPE * margins + shift, -700, 700)
            ones = (margins >= 0).astype(np.int32)
            # The cut is taken on the margin, as rounding may put a score of CUT on either side.
            scores = np.where(ones == 1, np.maximum(1 / (1 + np.exp(-z)), CUT), np.minimum(1 / (1 + np.exp(-z)), np.nextafter(CUT, 0)))
            yield batch_of({"id": (b.column(0).to_pylist(), pa.int64()), "held_out": (b.column(1).to_pylist(), pa.bool_()), "score": (scores.tolist(), pa.float64()), "predicted": (ones.tolist(), pa.int32())})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return spread(rows).mapInArrow(run, "id long, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    small_batches(docs.sparkSession)
    return score(docs, fit(docs, labels, label_col, fit_rows))
