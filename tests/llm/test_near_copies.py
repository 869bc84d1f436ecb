"""Near copies by five-word shingles against brute force."""

import random

import corpus_pipeline
from tideline.llm import common, near_copies


def shingle_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if 5 * len(a & b) >= 4 * len(a | b) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    return group


def edited(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"new{rng.random()}"
    return out


def test_near_stage_against_brute_force(spark, tmp_path):
    """Copies with one to eight words of 120 changed lie on both sides of 0.8; most are over 3 bits apart for op10."""
    rng = random.Random(3)
    texts = ["", None, " \n", "a", "A ", "one two three four", "same " * 40, "same " * 41]
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        texts += [" ".join(base), *(" ".join(edited(rng, base, n)) for n in (1, 1, 2, 3, 4, 5, 6, 8))]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    group = brute(rows)
    want = {g: min(r[0] for r, h in zip(rows, group) if h == g) for g in group}
    got = {r.doc_id: r.component_id for r in near_copies.near_components(docs).collect()}
    assert got == {r[0]: want[g] for r, g in zip(rows, group)}
    kept = corpus_pipeline.near_stage(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_awkward_rows(docs, rows, no_docs):
    group = brute([r[:2] for r in rows])
    kept = near_copies.keep_smallest(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(group))
    assert near_copies.near_components(no_docs).count() == 0


def test_fingerprints_are_looked_up_once(docs):
    """The table of all fingerprints is joined in one pass, whose few rows the rest goes on from."""
    described = docs.select("doc_id", near_copies.row_key().alias("key"), near_copies.body().alias("text")).mapInArrow(near_copies._describe, "doc_id long, key long, code long, prints array<long>")
    nodes = near_copies.cut(described.groupBy("code").agg(near_copies.F.first("prints").alias("prints")))
    found = near_copies.candidates(nodes)
    assert found.count() and "Generate" not in found._jdf.queryExecution().executedPlan().toString()


def test_marks_let_every_marked_row_through_and_few_others(spark):
    rows = spark.range(-20_000, 20_000).selectExpr("if(id = 7, null, id) AS id")
    table = common.marks(rows.filter("id % 20 = 0 OR id IS NULL"), "id")
    got = [r.id for r in rows.filter(common.marked(table, "id")).collect()]
    assert None in got and set(range(-20_000, 20_000, 20)) <= set(got) and len(got) < 2100
    assert table.count() == 1 and len(table.first().words) == common.SLOTS
    assert rows.filter(common.marked(common.marks(rows.limit(0), "id"), "id")).isEmpty()
