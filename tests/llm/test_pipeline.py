"""The stages one after another, each against a plain Python version of what its input asks for."""

import re
from collections import defaultdict

import corpus_pipeline
from pyspark.sql import functions as F
from tallyloom.llm.fuzzy_lines import normal
from tallyloom.llm.toxicity import _Scorer, sentences_of, train
from tallyloom.plans.durable import written

SMALL = "/root/testdata/sf0.001"


def classes(sets, percent=80):
    """Smallest key reachable over sets that are similar enough."""
    found = {k: k for k in sets}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(found[a], found[b])
            changed |= found[a] != low or found[b] != low
            found[a] = found[b] = low
    return found


def plain_toxicity(spark, docs, texts):
    scorer = _Scorer(train(docs, spark.read.parquet(f"{SMALL}/labels.parquet")))
    return {d: t for d, t in texts.items() if scorer.document(sentences_of(t), t)[0] < 0.5}


def plain_lines(spark, docs, texts):
    places = defaultdict(list)
    for d, t in texts.items():
        for i, line in enumerate(t.split("\n")):
            if normal(line):
                places[normal(line)].append((d, i))
    named = classes({x: {x[i : i + 8] for i in range(max(1, len(x) - 7))} for x in places})
    members = defaultdict(list)
    for line, name in named.items():
        members[name] += places[line]
    cut = {p for ps in members.values() for p in sorted(ps)[1:]}
    left = {}
    for d, t in texts.items():
        kept = "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in cut)
        if kept.strip() or kept == t:
            left[d] = kept
    return left


def plain_near(spark, docs, texts):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d, t in texts.items():
        w = re.findall("[^\x20\x09-\x0d]+", t.translate(low))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    return {d: texts[d] for d, name in classes(sets).items() if name == d}


def plain_decontaminate(spark, docs, texts):
    def grams(text):
        w = re.findall(r"[^\W_]+", text.lower())
        return {tuple(w[i : i + 13]) for i in range(len(w) - 12)}

    bench = set().union(*(grams(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()))
    return {d: t for d, t in texts.items() if not grams(t) & bench}


PLAIN = [plain_toxicity, plain_lines, plain_near, plain_decontaminate]


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, removed = docs.columns, 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:-1], PLAIN, strict=True):
        kept = written(stage(spark, docs, SMALL), name)
        assert kept.columns == columns
        expected = plain(spark, docs, texts)
        got = {r.doc_id: r for r in kept.collect()}
        assert {d: r.text for d, r in got.items()} == expected and kept.count() == len(got)
        assert all(r.n_chars == len(r.text) for r in got.values())
        removed += len(texts) - len(expected)
        docs, texts = kept, expected
    assert removed
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in rows} == set(texts)
    assert sorted(corpus_pipeline.run(spark, SMALL).collect()) == sorted(rows)


def test_empty_table_and_nulls(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame(
        [(900001, None, "en", "s", 0), (900002, "", None, None, None), (None, "a b c d e f g", "en", "s", 13)], docs.schema
    )
    for table in (docs.where("false"), odd):
        n = table.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            table = written(stage(spark, table, SMALL), name)
            assert table.count() == n
        assert corpus_pipeline.STAGES[-1][1](spark, table, SMALL).count() == n


def test_repeated_ids_and_any_column_name(spark):
    """Another text under a doc_id is another document; of repeated rows one stays; no column name is reserved."""
    passage = " ".join(f"word{i}" for i in range(60))
    other = " ".join(f"else{i}" for i in range(60))
    rows = [(1, passage), (2, passage + " more"), (2, other), (3, "unlike " + other[::-1]), (3, "unlike " + other[::-1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("_doc", "_lost", "_cut", "_lines", "_other", "_held", "doc", "lost", "cut", "lines", "other", "held", "key", "row", "rows", "group"):
        docs = docs.withColumn(name, F.lit("kept"))
    stages = dict(corpus_pipeline.STAGES)

    def left(name, table):
        out = stages[name](spark, table, SMALL)
        assert out.columns == table.columns
        got = out.collect()
        assert all(v == "kept" for r in got for v in r[2:])
        return sorted((r.doc_id, r.text) for r in got)

    assert left("near_dedup", docs) == sorted([rows[0], rows[2], rows[3]])
    # Line 0 of one text under doc_id 2 is a copy, that of the other is not.
    assert left("line_dedup", docs) == sorted([rows[0], rows[2], rows[3], rows[4]])
    assert len(left("decontaminate", docs)) == 5
    assert len(left("toxicity", docs)) == 5
