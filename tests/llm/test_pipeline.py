"""The pipeline's stages, one after the other, against brute force on what each was given."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from .test_near_copies import brute

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def squeezed(text):
    return re.sub(r"[ \t\n\x0b\x0c\r]+", " ", text or "")


def without_repeats(texts, length=50):
    """Passages of `length` words that stand twice or more are cut out, with the white space after them."""
    places = [[m.span() for m in re.finditer(r"[^ \t\n\x0b\x0c\r]+", t or "")] for t in texts]
    words = [[t[a:b] for a, b in p] for t, p in zip(texts, places)]
    seen = Counter(tuple(w[p : p + length]) for w in words for p in range(len(w) - length + 1))
    out = []
    for t, p, w in zip(texts, places, words):
        gone = {i + k for i in range(len(w) - length + 1) if seen[tuple(w[i : i + length])] > 1 for k in range(length)}
        starts = [a for a, _ in p] + [len(t or "")]
        out.append((t or "")[: starts[0]] + "".join(t[starts[i] : starts[i + 1]] for i in range(len(w)) if i not in gone))
    return out


def check_stages(spark, docs, sf_dir, place):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "suffix_dedup", "packing"]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        given = docs.collect()
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{name}")
        docs = spark.read.parquet(f"{place}/{name}")
        got = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        texts = Counter(r.text for r in got) if name != "packing" else None
        if name == "quality":
            assert set(got) <= set(given)
            kept = len(got)
        elif name == "exact_dedup":
            assert len(got) == len({squeezed(r.text) for r in given}) == len({squeezed(r.text) for r in got})
        elif name == "near_dedup":
            groups = brute([(r.doc_id, r.text) for r in given])
            assert len(got) == len(set(groups))
            least = Counter(min((r.doc_id for r, h in zip(given, groups) if h == g and r.doc_id is not None), default=None) for g in set(groups))
            assert Counter(r.doc_id for r in got) == least
        elif name == "suffix_dedup":
            assert Counter(x or "" for x in texts.elements()) == Counter(without_repeats([r.text for r in given]))
            assert all(r.n_chars == len(r.text) for r in got if r.text is not None)
        else:
            want = Counter()
            for r in given:
                want[r.doc_id] += len((r.text or "").split())
            found = Counter()
            for r in got:
                found[r.doc_id] += r.length
            assert found == want and {r.doc_id for r in got} == {r.doc_id for r in given}
    return kept, docs


def test_stages_on_awkward_rows(spark, docs, rows, tmp_path):
    """Nothing can be learned from labels of other documents, so all rows go on to the other stages."""
    labels = spark.createDataFrame([(100_000, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept, _ = check_stages(spark, docs, str(tmp_path), f"{tmp_path}/out")
    assert kept == len(rows)


def test_stages_on_no_rows(spark, no_docs, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert check_stages(spark, no_docs, str(tmp_path), f"{tmp_path}/out")[0] == 0


def test_run(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    try:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    except Exception:
        pytest.skip("no test tables")
    kept, last = check_stages(spark, docs, sf_dir, f"{tmp_path}/out")
    assert kept > 0
    show = lambda df: sorted(map(tuple, df.collect()))
    assert show(corpus_pipeline.run(spark, sf_dir)) == show(last)


def test_planted_passages_go_and_clean_documents_stay(spark):
    """Passages of 51 to 80 words, each in three documents; copies of 49 words or fewer are no passage."""
    rng = random.Random(13)
    words = lambda n: [f"{rng.choice('abcdefgh')}{rng.randrange(10**5)}" for _ in range(n)]
    rows, planted = [], []
    for n in range(51, 81):
        passage = words(n)
        planted.append(" ".join(passage))
        for k in range(3):
            rows.append((len(rows), " ".join(words(rng.randrange(5, 90))) + "\n" + planted[-1] + (" " + " ".join(words(rng.randrange(1, 90))) if k else "")))
    short = " ".join(words(49))
    clean = {i: t for i, t in ((1000 + k, f"{' '.join(words(60))} {short} {' '.join(words(20))}") for k in range(40))}
    docs = spark.createDataFrame(rows + list(clean.items()), "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long")).repartition(3)
    got = {r.doc_id: r.text for r in corpus_pipeline.suffix_stage(spark, docs, "").collect()}
    assert all(got[i] == t for i, t in clean.items())
    assert not [i for i, t in rows if any(p in got[i] for p in planted)]
    assert [got[i] for i, _ in rows] == without_repeats([t for _, t in rows])


def test_suffix_stage_moves_texts_once(docs):
    """Rows are joined to their runs and cut there, not joined again to what was cut elsewhere."""
    out = corpus_pipeline.suffix_stage(docs.sparkSession, docs, "")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join", plan)) == 1
    assert Counter(r.text or "" for r in out.collect()) == Counter(without_repeats([r.text for r in docs.collect()]))


def test_suffix_stage_leaves_texts_without_runs_in_place(docs):
    """Rows that can't have runs bypass the join; the others go through it."""
    plan = corpus_pipeline.suffix_stage(docs.sparkSession, docs, "")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "scalar-subquery" in plan
