"""What the line dedup holds and moves: sets in a verifying task, shuffles of band keys, places of a class."""

import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tallyloom.llm import fuzzy_lines, similar
from tallyloom.llm.fuzzy_lines import ALL_LINES, char_shingles, normal, without_duplicate_lines


def pairs(texts, size):
    for at in range(0, len(texts), size):
        some = texts[at : at + size]
        ids = range(at, at + len(some))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(ids, pa.int64()), pa.array([x for x, _ in some]), pa.array([y for _, y in some])],
            names=["a", "b", "ta", "tb"],
        )


def test_verifying_task_forgets_sets():
    r = random.Random(3)
    texts = []
    for n in range(1_500):
        x = "".join(r.choices("abcdefghij ", k=r.randrange(900, 1_500)))
        texts.append((x, x[:-100] if n % 2 else x[: len(x) // 2] + x[::-1][len(x) // 2 :]))
    task = similar._verify(ALL_LINES.measure())
    tracemalloc.start()
    found = [i for batch in task(pairs(texts, 100)) for i in batch.column("a").to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == list(range(1, 1_500, 2))
    assert peak < 60_000_000


def test_small_and_large_sets_are_compared_exactly():
    measure = ALL_LINES.measure()
    r = random.Random(4)
    texts = []
    for _ in range(300):
        x = "".join(r.choices("aé\U0001d11e ", k=r.choice([1, 7, 8, 9, 60, 3_000])))
        y = list(x)
        for at in r.sample(range(len(y)), min(len(y), r.randrange(5))):
            y[at] = r.choice("xyz")
        texts.append((x, "".join(y)))

    def shingles(x):
        x = x.ljust(8, "\0")
        return {x[i : i + 8] for i in range(len(x) - 7)}

    expected = [i for i, (x, y) in enumerate(texts) if 100 * len(shingles(x) & shingles(y)) >= 80 * len(shingles(x) | shingles(y))]
    got = [i for batch in similar._verify(measure)(pairs(texts, 70)) for i in batch.column("a").to_pylist()]
    assert 0 < len(expected) < 300 and got == expected
    for x, _ in texts:
        one = char_shingles(x.encode(), 8)
        assert one.size == len(shingles(x)) and np.array_equal(one, np.unique(one))


def test_normal_forms():
    r = random.Random(6)
    for _ in range(3_000):
        text = "".join(r.choices("aB \t\r\x0b\x1c\x85\xa0\u3000\u200b\n", k=r.randrange(30)))
        expected = [(i, x) for i, line in enumerate(text.split("\n")) if len(x := normal(line)) >= 1]
        assert fuzzy_lines._long_lines(text, 1) == expected


def test_band_keys_are_shuffled_once(spark, monkeypatch):
    plans, written = {}, similar.written

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name)

    monkeypatch.setattr(similar, "written", noted)
    docs = [(i, "\n".join(f"line {(i + j) % 40} has some words that differ {(i * j) % 7} in places" for j in range(5))) for i in range(60)]
    assert without_duplicate_lines(spark.createDataFrame(docs, "doc_id long, text string"), ALL_LINES).where("_cut > 0").count()
    assert plans["line-members"].count("Exchange") == 1


@pytest.mark.parametrize("parts", [1, 7])
def test_shared_keys(parts):
    r = random.Random(parts)
    rows = [(i, [r.choice([r.getrandbits(63), -r.randrange(1, 9)]) for _ in range(3)]) for i in range(-50, 50)]
    rows += rows[:20]
    batches = [
        pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in rows[at : at + 30]], pa.int64()), pa.array([np.array(k, np.int64).tobytes() for _, k in rows[at : at + 30]], pa.binary())],
            names=["id", "bands"],
        )
        for at in range(0, len(rows), 30)
    ]
    members = {}
    for i, keys in rows:
        for k in keys:
            members.setdefault(k, set()).add(i)
    expected = sorted((k, i, min(ids)) for k, ids in members.items() if len(ids) > 1 for i in ids)
    dealt, got = pa.Table.from_batches(similar._dealt(parts)(iter(batches))), []
    for part in range(parts):
        mine = dealt.filter(pa.compute.equal(dealt["part"], part)).to_batches()
        got += [tuple(x.values()) for batch in similar._shared_keys(iter(mine)) for x in batch.to_pylist()]
    assert expected and sorted(got) == expected
    assert not list(similar._shared_keys(iter([])))


@pytest.mark.parametrize("at_once", [1, 40, None])
def test_places_of_a_class(at_once):
    r = random.Random(8)
    places = [(r.choice([0, r.randrange(60)]), r.randrange(-20, 20), r.randrange(3), r.randrange(2)) for _ in range(500)]
    expected = {p for p in places if p != min(q for q in places if q[0] == p[0])}

    def batch(rows):
        columns = list(zip(*rows, strict=True))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["class", "doc_id", "line", "row", "cut"])

    batches = [batch([(*p, False) for p in places[at : at + 25]]) for at in range(0, 500, 25)]
    own = list(fuzzy_lines._marked(at_once)(iter(batches)))
    last = [tuple(x.values()) for b in fuzzy_lines._marked()(iter(own)) for x in b.to_pylist()]
    assert {p[:4] for p in last if p[4]} == expected
    assert {p[:4] for p in last if not p[4]} == set(places) - expected
    # Of a class that fills whole tasks each sends one place that is not cut yet.
    assert all(sum(x["class"] == 0 and not x["cut"] for x in b.to_pylist()) == 1 for b in own)


def test_block_compares_few_sets(monkeypatch):
    """One class of near copies and lines that almost belong to it: only pairs that can be linked are compared as sets."""
    r = random.Random(9)
    base = [f"{r.getrandbits(24):06x}" for _ in range(80)]

    def changed(n, words=base):
        return " ".join("".join(r.choices("ghijkl", k=6)) if i in at else x for at in [r.sample(range(80), n)] for i, x in enumerate(words))

    close = [f"{' '.join(base)} {i:02d}" for i in range(60)]
    texts = close + [changed(r.choice([7, 8, 9])) for _ in range(60)] + [changed(0, changed(60).split()) for _ in range(5)]
    texts += [x + " more" for x in texts[60:70]]
    measure, calls = ALL_LINES.measure(), []
    sets = [set(char_shingles(x.encode(), 8).tolist()) for x in texts]
    expected = similar_components(range(len(texts)), lambda i, j: 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]), [0] * 60)
    compare = similar.Measure.linked
    monkeypatch.setattr(similar.Measure, "linked", lambda self, a, b: calls.append(1) or compare(self, a, b))
    rows = pd.DataFrame({"key": 1, "i": 0, "id": range(len(texts)), "label": [0] * 60 + [*range(60, len(texts))], "text": texts})
    found = []
    for j, side in ((0, 2), (1, rows["id"] % 2)):
        calls.clear()
        links = similar._block_links(measure)(rows.assign(j=j, side=side))
        # Every link joins two components, few other pairs are compared.
        assert len(links) <= len(calls) < len(links) + 60
        found.append(similar_components(range(len(texts)), lambda i, j: (i, j) in pairs, [0] * 60) if (pairs := set(links.itertuples(index=False, name=None))) else [])
    assert found[0] == expected and 60 < len(set(expected)) + 60 < len(texts)


def similar_components(ids, linked, labels):
    """The smallest id of each id's component; ids with a label hang together."""
    component = [*labels, *[*ids][len(labels) :]]
    for i in ids:
        for j in range(i + 1, len(ids)):
            if component[i] != component[j] and linked(i, j):
                low, high = sorted((component[i], component[j]))
                component = [low if x == high else x for x in component]
    return component


def test_signatures_of_several_sets():
    r = random.Random(10)
    texts = ["".join(r.choices("abc ", k=r.choice([1, 9, 200, 70_000]))).encode() for _ in range(40)]
    measure = ALL_LINES.measure()
    sets = measure.sets_of(texts)
    assert np.array_equal(measure.signatures_of(sets), np.stack([measure.signature(x) for x in sets]))


@pytest.mark.parametrize("parts", [1, 7])
def test_places_are_dealt_as_arrays(parts):
    r = random.Random(11)
    places = [(r.choice([0, r.randrange(60)]), r.randrange(-20, 20), r.randrange(3), r.randrange(2)) for _ in range(500)]
    places = list({p[1:]: p for p in places}.values())
    first = {min(q for q in places if q[0] == p[0]) for p in places}
    expected = {}
    for _, doc, line, row in sorted(set(places) - first):
        expected.setdefault((doc, row), set()).add(line)
    places += places[:50]

    def batch(rows):
        columns = list(zip(*rows, strict=True))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), pa.array([False] * len(rows))],
            names=["class", "doc_id", "line", "row", "cut"],
        )

    def parted(batches):
        table = pa.Table.from_batches(batches)
        return [table.filter(pa.compute.equal(table["part"], p)).to_batches() for p in range(parts)]

    tasks = [b for at in range(0, len(places), 90) for b in fuzzy_lines._places(parts)(iter([batch(places[at : at + 90])]))]
    cuts = [b for mine in parted(tasks) for b in fuzzy_lines._cut_places(parts)(iter(mine))]
    got = [x for mine in parted(cuts) for b in fuzzy_lines._cut_lines(iter(mine)) for x in b.to_pylist()]
    assert len(got) == len(expected) and {(x["doc_id"], x["row"]): x["lines"] for x in got} == {k: sorted(v) for k, v in expected.items()}
    assert not list(fuzzy_lines._cut_lines(iter([])))


def test_cuts_are_not_aggregated_as_objects(spark, monkeypatch):
    plans, written = {}, fuzzy_lines.written

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name)

    monkeypatch.setattr(fuzzy_lines, "written", noted)
    docs = [(i, f"the same line in all documents\n\n{str(i) * 30}") for i in range(9)] + [(3, "one more\n"), (9, None), (10, "")]
    got = without_duplicate_lines(spark.createDataFrame(docs, "doc_id long, text string"), ALL_LINES).collect()
    assert sorted((x.doc_id, x._lines) for x in got) == sorted((i, t.count("\n") + 1 if t is not None else 0) for i, t in docs)
    assert sum(x._cut for x in got) == 8
    assert "collect_set" not in plans["line-cuts"]
