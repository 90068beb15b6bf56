"""The pipeline against its operators' brute-force statements."""

import collections

import corpus_pipeline
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.test_operators import TEXTS, brute_components, brute_lines, docs_of, line_rows, near_texts, prose, rng, shingles

ITEMS = [(k, prose(25)) for k in range(5)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows = near_texts() + [(i + 3000 if i is not None else None, t) for i, t in line_rows()[14:]] + [(7000 + k, f"{prose(30)} {ITEMS[k][1]} {prose(30)}") for k in range(5)]
    docs = docs_of(spark, rows).select(corpus_pipeline.COLUMNS)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").cache()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]
    for name in list(stages)[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = stages[name](spark, docs, folder).cache()
        assert docs.columns == corpus_pipeline.COLUMNS
        after = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "line_dedup":
            import hashlib

            want = {(i, h) for i, _, _, h in brute_lines(before)}
            assert {(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in after} == want
            assert docs.where(F.char_length("text") != F.col("n_chars")).count() == 0
        elif name == "near_dedup":
            assert collections.Counter(after) == one_of_each(before)
        elif name == "decontamination":
            gone = {i for i, _ in before} - {i for i, _ in after}
            assert gone == {7000 + k for k in range(5)}
        else:
            assert set(after) <= set(before) and len(after) >= 0.9 * len(before)
    packed = stages["packing"](spark, docs, folder)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def one_of_each(rows):
    """Rows that stay, by brute force: of each group that with the smallest id, and texts without words."""
    groups = collections.defaultdict(list)
    roots = brute_components([(k, t) for k, (_, t) in enumerate(rows)], 5, 80)
    for k, (_, t) in enumerate(rows):
        groups[roots[k]].append(k)
    out = collections.Counter()
    for group in groups.values():
        if not shingles(rows[group[0]][1], 5):
            out.update(rows[k] for k in group)
        else:
            out[min((rows[k] for k in group), key=lambda r: (r[0] is None, r[0] or 0, signed(r[1])))] += 1
    return out


def signed(text):
    """The engine's hash of a text, which settles ties of ids."""
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >= 1 << 63 else h


def test_decisions_are_by_row(spark, folder):
    """Rows with one id, or none, go or stay for what they hold themselves."""
    item, text = ITEMS[0][1], prose(40)
    rows = [(1, text), (1, f"{prose(9)} {item}"), (None, f"{item} {prose(9)}"), (None, prose(20)), (2, text), (2, text), (2, None), (2, None), (None, text)]
    docs = docs_of(spark, rows).select(corpus_pipeline.COLUMNS)
    seen = lambda df: collections.Counter((r.doc_id, r.text) for r in df.collect())
    assert seen(corpus_pipeline.benchmark_stage(spark, docs, folder)) == collections.Counter(r for r in rows if item not in (r[1] or ""))
    assert seen(corpus_pipeline.near_stage(spark, docs, folder)) == one_of_each(rows)
    wordless = [(1, "1 2 3 %% $$"), (1, TEXTS["en"]), (None, "## 12 33"), (None, TEXTS["fr"]), *[(k, TEXTS[lang]) for k, lang in enumerate(TEXTS)]]
    docs = docs_of(spark, wordless).select(corpus_pipeline.COLUMNS).withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string")})
    assert seen(corpus_pipeline.language_stage(spark, docs, folder)) <= collections.Counter(r for r in wordless if r[1] in TEXTS.values())


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset", "ids"} <= set(out.columns)


def test_empty(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 0").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert rng is not None
