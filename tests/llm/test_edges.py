"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import similar
from tallyloom.llm.common import components, ranked
from tallyloom.llm.decontaminate import matches
from tallyloom.llm.embeddings import PigeonholeJoin, near_vectors
from tallyloom.llm.fuzzy_lines import LineDuplicates, without_duplicate_lines
from tallyloom.llm.minhash import NearDuplicates, near_duplicates
from tallyloom.llm.packing import Packing, column_generation, pack, whole_patterns
from tallyloom.llm.queries import vocabulary
from tallyloom.llm.quotations import reply_threads
from tallyloom.llm.secret_scan import find_secrets, secrets_of
from tallyloom.llm.token_files import TokenFiles, read_token_files, write_token_files
from tallyloom.llm.tokens import WordPieces
from tallyloom.llm.toxicity import Model, harmless, score, sentences_of, train
from tallyloom.llm.url_lists import intervals, judged
from tallyloom.plans.durable import scratch_path
from tallyloom.plans.ranks import ordered_rank

CLASH = "id long, key long, rep long, class int, lines array<int>, label long, u long, node long, part long, start long"


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n))


LONG = words(1, 60_000)
ODD = [
    (1, words(2, 60)), (2, words(2, 60)), (3, words(2, 60) + " more"), (4, None), (5, ""), (6, " \t\n "), (7, "one two"),
    (8, "ONE two"), (9, LONG), (10, "x" * 300_000), (None, words(2, 60)), (None, None), (1, words(2, 60)),
    (11, "é" * 40 + "\n" + "ß　 z"),
]


@pytest.fixture
def odd(spark):
    """Odd rows with columns whose names the operators use inside."""
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    for column in CLASH.split(", "):
        name, kind = column.split()
        df = df.withColumn(name, F.lit(None).cast(kind))
    return df


@pytest.fixture
def none(odd):
    return odd.where("false")


def test_near_duplicates(odd, none):
    got = near_duplicates(odd, NearDuplicates(4, 80)).collect()
    named = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None}
    assert len(got) == len(ODD)
    assert named[1] == (57, 1, True) and named[2] == (57, 1, False) and named[3] == (58, 1, False)
    assert named[4] == (0, 4, True) and named[5] == (0, 5, True) and named[6] == (0, 6, True)
    assert named[7] == (1, 7, True) and named[8] == (1, 7, False) and named[10] == (1, 10, True)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert near_duplicates(none).count() == 0


def test_near_duplicates_in_large_buckets(spark, monkeypatch):
    """Chains inside buckets: every link counts although no bucket is paired; all ways through a bucket agree."""
    base = words(3, 80).split()
    texts = []
    for i in range(120):
        r = random.Random(i)
        w = list(base)
        for at in r.sample(range(80), 1 + i % 5):
            w[at] = f"w{r.randrange(8)}"
        texts.append((i, " ".join(w)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(76)} for _, t in texts]
    links = [(i, j) for i in range(120) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    parent = list(range(120))
    for _ in range(120):
        for i, j in links:
            parent[i] = parent[j] = min(parent[i], parent[j])
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    for listed, block in ((32, 1024), (4, 16), (1_000, 16)):
        monkeypatch.setattr(similar, "LISTED", listed)
        monkeypatch.setattr(similar, "BLOCK", block)
        got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
        assert [got[i] for i in range(120)] == parent


def test_components(spark):
    r = random.Random(5)
    links = [(r.randrange(400), r.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {n: n for e in links for n in e}
    for _ in range(len(parent)):
        if not any(parent[a] != parent[b] for a, b in links):
            break
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = dict(components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect())
    assert got == {n: p for n, p in parent.items() if any(n in e and e[0] != e[1] for e in links)}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_ranks(spark):
    df = spark.createDataFrame([(k, i) for k, n in ((1, 500), (2, 3)) for i in range(n)], "k int, i long")
    for got in (ranked(df, "k", "i", "r", 7), ordered_rank(df, ["k"], ["i"], "r")):
        ranks = got.collect()
        for k, n in ((1, 500), (2, 3)):
            assert sorted(x.r for x in ranks if x.k == k) == list(range(n))
    assert all(x.r == x.i for x in ordered_rank(df, ["k"], ["i"], "r").collect())


def test_vectors(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    rows = [
        (1, v), (2, v), (3, [10.0, 20.0, 30.0, 40.0]), (4, None), (5, []), (6, [0.0] * 4), (7, [1.0, None, 3.0, 4.0]),
        (8, [float("nan"), 2.0, 3.0, 4.0]), (9, [float("inf")] * 4), (None, v), (10, [1.0, 2.0]), (11, [-1.0, -2.0, -3.0, -4.0]),
        (12, [1e300, 2e300, 3e300, 4e300]), (13, [1.0, 0.0, 0.0, 0.0]), (14, [0.9001, 0.4357, 0.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("block", F.lit(1)).withColumn("copies", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(df).collect()}
    assert len(got) == len(rows)
    assert got[1] == (3, 1, True) and got[2] == (3, 1, False) and got[3] == (3, 1, False) and got[12] == (3, 1, False)
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11)) and got[None] == (0, None, True)
    assert got[13] == (1, 13, True) and got[14] == (1, 13, False)
    assert near_vectors(df.where("false")).count() == 0


def test_vectors_in_many_cells_and_parts(spark):
    r = np.random.RandomState(2)
    centres = r.standard_normal((30, 16))
    x = np.concatenate([centres[r.randint(0, 30, 400)] + 0.25 * r.standard_normal((400, 16)), np.repeat(centres[:1], 150, 0) + 0.1 * r.standard_normal((150, 16))])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    degree = (u @ u.T >= 0.9).sum(1) - 1
    df = spark.createDataFrame([(i, a.tolist()) for i, a in enumerate(x)], "vec_id long, embedding array<double>")
    for spec in (PigeonholeJoin(per_pivot=20, part=16), PigeonholeJoin(blocks=3, per_pivot=100, part=50), PigeonholeJoin(blocks=16)):
        got = {r.vec_id: r.n_links for r in near_vectors(df, spec).collect()}
        assert [got[i] for i in range(len(x))] == degree.tolist()


def test_secrets(odd, none):
    got = {r.doc_id: r.spans for r in find_secrets(odd).collect()}
    assert len(got) == 12 and got[4] == [] and got[5] == [] and find_secrets(none).count() == 0

    def named(text):
        return [text[a:b] for k, a, b in secrets_of(text) if k == "named"]

    assert named('DB_PASSWORD = "hx7!kQ92_zz"') == ["hx7!kQ92_zz"]
    assert named('{"clientSecret": "a8F-kk2L0_q9"}') == ["a8F-kk2L0_q9"]
    assert named('base = "kd83Jq"\nauth_token = base + "Zp02_x"') == ["kd83Jq", "Zp02_x"]
    assert named("fallback = 'Wq8_zz19Lm'\nlogin = fallback\napi_key: str = login") == ["Wq8_zz19Lm"]
    assert named('password = "changeme"') == [] and named('title = "hx7!kQ92_zz"') == [] and named("token: ${TOKEN}") == []
    assert [s[:1] + s[1:] for s in secrets_of("é token: abcdef1")][0] == ("assign", 2, 16)
    assert secrets_of("AKIA" + "A" * 15) == [] and secrets_of("AKIA" + "A" * 16)[0][0] == "access"
    assert [k for k, _, _ in secrets_of("f" * 24)] == ["hex"] and secrets_of("f" * 23) == []


def test_tokens_equal_the_library():
    from tokenizers import Tokenizer

    whole, pieces = Tokenizer.from_file(vocabulary()), WordPieces(vocabulary())
    texts = [
        "", " ", "Hello, World's end!! it's 42 kg", "naïve Éclair ŒUVRE ß STRASSE ΣΊΣΥΦΟΣ İstanbul", "á é x y\x85z\x1cq",
        "<|endoftext|> and <|ENDOFTEXT|> x<|startoftext|>y", "x" * 5_000, "日本語 テスト 👍🏽", "can't they're we'll I'd 's", "\u0000 ​ a.b,c;d:e",
        "K ﬁ ǅ",
    ]
    for text in texts:
        assert np.frombuffer(pieces.ids(text.encode()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert pieces.ids(None) == b""


def test_token_files(spark, odd, none):
    path = scratch_path(spark, "tokens")
    write_token_files(odd, path, TokenFiles(vocabulary(), shard_bytes=4_000))
    got = read_token_files(spark, path).collect()
    assert sorted((r.doc_id or -1) for r in got) == sorted((d or -1) for d, _ in ODD)
    by_start = sorted(got, key=lambda r: r.start)
    assert [r.start for r in by_start] == list(np.cumsum([0] + [r.n_tokens for r in by_start[:-1]]))
    assert [r.doc_id for r in by_start][2:] == sorted(d for d, _ in ODD if d is not None)
    one = read_token_files(spark, path, [9]).collect()
    assert len(one) == 1 and one[0] == next(r for r in got if r.doc_id == 9)
    assert {r.n_tokens for r in got if r.doc_id in (4, 5, 6)} == {1}
    path = scratch_path(spark, "tokens")
    write_token_files(none, path, TokenFiles(vocabulary()))
    assert read_token_files(spark, path).count() == 0


def test_packing(odd, none):
    got = pack(odd, Packing(vocabulary(), capacity=64, grain=4)).collect()
    assert sum(r.length for r in got if r.doc_id == 9) == next(r.doc_tokens for r in got if r.doc_id == 9)
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in used.values():
        v.sort()
        assert v[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(v, v[1:], strict=False)) and sum(n for _, n in v) <= 64
    assert pack(none, Packing(vocabulary())).count() == 0


def test_column_generation_is_near_its_bound():
    r = np.random.RandomState(0)
    sizes = np.unique(r.randint(1, 101, 40))
    demand = r.randint(1, 400, sizes.size)
    patterns, counts = column_generation(sizes, demand, 100, 1e-6)
    assert (sizes @ patterns <= 100).all() and np.allclose(patterns @ counts, demand)
    # Pieces over half a sequence need one each; the volume is a bound too.
    assert counts.sum() >= max((sizes @ demand) / 100, demand[sizes > 50].sum()) - 1e-6
    placed = whole_patterns(sizes, demand, 100, 1e-6)
    got = np.zeros(sizes.size, int)
    for pattern, times in placed:
        assert sum(sizes[i] * n for i, n in pattern.items()) <= 100
        for i, n in pattern.items():
            got[i] += n * times
    assert (got == demand).all() and sum(t for _, t in placed) <= counts.sum() + sizes.size


def test_lines(odd, none, spark):
    got = without_duplicate_lines(odd).collect()
    assert len(got) == len(ODD) and set(odd.columns) <= set(got[0].asDict())
    assert [r for r in got if r.doc_id == 2][0].text == "" and [r for r in got if r.doc_id == 4][0].text is None
    assert all(r._cut == 0 for r in got if r.doc_id is None or r.doc_id in (1, 5, 6, 7, 8, 9, 10, 11))
    assert without_duplicate_lines(none).count() == 0
    docs = [(1, "short\nThe quick brown fox jumps over the lazy dog again\nend"), (2, "the  QUICK brown fox jumps over the lazy dog again\nshort"),
            (3, "The quick brown fox jumps over the lazy dog again!\nThe quick brown fox jumps over the lazy dog again")]
    got = {r.doc_id: r.text for r in without_duplicate_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: docs[0][1], 2: "short", 3: ""}


def test_short_lines_collapse_if_asked(spark):
    docs = [(1, "les.\n\nThe quick brown fox jumps over the lazy dog again"), (2, "LES.\nlet.\n\nthe quick brown fox jumps over the lazy dog again!"), (3, "les.")]
    got = without_duplicate_lines(spark.createDataFrame(docs, "doc_id long, text string"), LineDuplicates(equal=1)).collect()
    assert {r.doc_id: r.text for r in got} == {1: docs[0][1], 2: "let.\n", 3: ""}


def test_url_lists(spark):
    events = [("bad.example", "add", "2024-01-10"), ("bad.example", "remove", "2024-02-01"), ("ok.example/Ads/x", "add", "2024-01-01"),
              ("ok.example/Ads/x", "remove", "2024-01-01"), ("sub.ok.example", "add", "2024-03-01"), ("sub.ok.example", "add", "2024-04-01"),
              (None, "add", "2024-01-01"), ("z.example", None, "2024-01-01"), ("bad.example/deep", "add", "2024-01-15")]
    log = spark.createDataFrame(events, "entry string, action string, day string")
    assert intervals(log).count() == 4
    captures = [
        (1, "http://www.BAD.example:80/x?q=1", "2024-01-09"), (2, "https://u@bad.example./x", "2024-01-10"), (3, "//bad.example", "2024-01-31"),
        (4, "http://bad.example/", "2024-02-01"), (5, "http://notbad.example/", "2024-01-15"), (6, "http://ok.example/Ads/x/y", "2024-01-02"),
        (7, "http://a.sub.ok.example/", "2024-05-01"), (8, None, "2024-01-15"), (9, "no url", "2024-01-15"), (10, "http://bad.example/", None),
        (11, "http://bad.example/deep/er", "2024-01-20"), (None, "http://bad.example/deep", "2024-01-20"), (2, "https://u@bad.example./x", "2024-01-10"),
    ]
    frame = spark.createDataFrame(captures, "page_id long, url string, fetched string").withColumn("key", F.lit(1)).withColumn("entry", F.lit("bad.example"))
    rows = judged(frame, log).collect()
    got = {r.page_id: (r.blocked, r.n_entries, r.entry) for r in rows}
    assert len(rows) == 12
    assert {i for i, r in got.items() if r[0]} == {2, 3, 7, 11, None}
    assert got[11] == (True, 2, "bad.example/deep") and got[7] == (True, 1, "sub.ok.example") and got[1] == (False, 0, None)
    assert judged(frame, log.where("false")).where("blocked").count() == 0 and judged(frame.where("false"), log).count() == 0


def test_url_lists_keep_the_case_of_paths(spark):
    log = spark.createDataFrame([("OK.example/Ads", "add", "2024-01-01")], "entry string, action string, day string")
    captures = [(1, "http://ok.example/Ads/x", "2024-01-02"), (2, "http://ok.EXAMPLE/ads/x", "2024-01-02")]
    rows = judged(spark.createDataFrame(captures, "page_id long, url string, fetched string"), log).collect()
    assert {r.page_id: r.entry for r in rows} == {1: "ok.example/Ads", 2: None}


def test_decontamination(spark, odd, none):
    plain = "Every morning a farmer walks 3 km to the old market with Martha and sells 12 baskets of ripe apples for 4 dollars before noon"
    other = plain.replace("3 km", "17 miles").replace("Martha", "Peter").replace("12", "90").replace("4 dollars", "1.5 euros")
    twice = "A train covers 7 miles in the first hour and then again 7 miles in the second hour before it stops near Leeds for good"
    bench = spark.createDataFrame([(1, plain), (2, twice), (3, None), (4, ""), (5, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"), (None, plain)], "item_id long, text string")
    bench = bench.withColumn("place", F.lit(1)).withColumn("key", F.lit(1))
    texts = [
        (1, "Before. " + plain + " and after."), (2, other.upper().replace("PETER", "Peter")), (3, other), (4, twice.replace("7 miles", "9 miles")),
        (5, twice.replace("again 7 miles", "again 8 miles")), (6, " ".join(plain.split()[:10])), (7, "5 6 7 8 9 10 11 12 13 14 15 16 17 18 19"),
        (8, plain.replace("market", "shop").replace("ripe", "green")), (9, None), (10, ""),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("item_id", F.lit(0)).withColumn("low", F.lit(0))
    got = {(r.doc_id, r.item_id): r.exact for r in matches(docs, bench).collect()}
    assert got[(1, 1)] and got[(3, 1)] is False and got[(4, 2)] is False
    assert {d for d, _ in got} <= {1, 2, 3, 4} and (5, 2) not in got
    assert matches(odd, bench).count() == 0 and matches(none, bench).count() == 0 and matches(docs, bench.where("false")).count() == 0


def test_toxicity(spark, odd, none):
    nice = [(i, f"{words(i, 30)}. {words(900 + i, 20)}") for i in range(200)]
    bad = [(i, f"{words(i, 30)}. you {('moron', 'idiot')[i % 2]} there. {words(i + 300, 20)}") for i in range(200, 300)]
    docs = spark.createDataFrame(nice + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 200)) for i in range(300)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    model = train(docs, labels)
    got = {r.doc_id: r for r in score(docs, model).collect()}
    assert np.mean([got[i].predicted == (i >= 200) for i in range(300)]) > 0.97
    spans = got[250].offending
    assert len(spans) == 1 and "moron" in bad[50][1][spans[0].start : spans[0].end]
    odd_scores = score(odd, model).collect()
    assert len(odd_scores) == len(ODD) and all(0 <= r.score <= 1 for r in odd_scores)
    assert {r.score for r in odd_scores if r.doc_id in (4, 5)} == {0.0}
    assert harmless(odd, model).count() == len(ODD) and score(none, model).count() == 0 and harmless(none, model).count() == 0
    empty = train(docs, labels.where("false"))
    assert isinstance(empty, Model) and score(docs, empty).where("predicted = 1").count() == 0
    assert sentences_of("A b. C d!\n\nE") == [(0, 4), (4, 9), (9, 10), (10, 11), (11, 12)] or sentences_of(None) == []


def test_quotations(spark):
    def mail(i, text, scope="l"):
        return (i, scope, text)

    data = [
        mail(1, "First question about the weather in spring\nand more"), mail(2, "> First question about the weather in spring\n> and more\nIt rains."),
        mail(3, "On Monday X wrote:\n> On Sunday Y wrote:\n>> First question about the weather in spring\n>> and more\n> It rains.\n\nGood."),
        mail(4, "> unknown words that nobody ever wrote here\n>> First question about the weather in spring\nHm."), mail(5, None), mail(6, ""),
        mail(7, "> and a quote of nothing"), mail(8, "> First question about the weather in spring\n> and more\nOther list", "m"),
        mail(9, "> Good.\nThanks"), (None, "l", "x"), mail(9, "> Good.\nThanks"), mail(10, ">" * 50 + " deep\n" + "y" * 50_000),
    ]
    frame = spark.createDataFrame(data, "msg_id long, scope string, text string").withColumn("level", F.lit(1)).withColumn("key", F.lit(1))
    got = {r.msg_id: r for r in reply_threads(frame).collect()}
    assert len(got) == 10
    assert [(got[i].thread_id, got[i].parent_id, got[i].depth, got[i].position) for i in (1, 2, 3, 4, 9)] == [
        (1, None, 0, 0), (1, 1, 1, 1), (1, 2, 2, 2), (1, 1, 1, 3), (1, 3, 3, 4)
    ]
    assert got[3].text == "Good." and got[3].n_quoted == 2 and got[5].text is None and got[6].text == "" and got[7].parent_id is None
    assert got[8].parent_id is None and got[8].thread_id == 8
    assert reply_threads(frame.where("false")).count() == 0


def found(spark, items, texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id): r for r in matches(docs, bench).collect()}


def test_decontamination_of_dense_items(spark):
    mix = "Mix 3 kg sand, 4 kg lime, 5 kg clay and 6 l water in 7 l. How many kg is it"
    sums = "What is 17 23 45 68 9 10?"
    row = "1 2 3 4 5 6 7 8 9 10 11 12 13 14"
    other = mix.replace("3", "13").replace("4", "8").replace("7", "70")
    texts = [f"Some text before. {mix} and after", f"Some text before. {other} and after", f"{sums}", "what is 18 23 45 68 9 10", row, row.replace("7", "70"),
             "Water is 6 l and in 7 l. How many kg is it"]
    got = found(spark, [mix, sums, row], texts)
    assert set(got) == {(0, 0), (1, 0), (2, 1), (4, 2)}
    assert got[(0, 0)].exact and got[(0, 0)].tokens == 22 and got[(0, 0)].first_token == 3 and not got[(1, 0)].exact


def test_decontamination_with_one_other_value(spark):
    far = "A shop sells 2 pens to a tall girl who then walks along the old river and over the wooden bridge to the market with Martha and buys 2 books"
    near = "In May 2 girls and 2 boys found many old coins on the sandy beach while 2 dogs slept nearby"
    texts = [far.replace("2 books", "3 books"), far.replace("2 pens", "5 pens").replace("Martha", "Peter").replace("2 books", "3 books"),
             near.replace("2 dogs", "4 dogs")]
    got = found(spark, [far, near], texts)
    assert set(got) == {(0, 0), (1, 0), (2, 1)}
    # In the first and the last text the values stay up to the one that was changed.
    assert got[(0, 0)].exact and not got[(1, 0)].exact and got[(2, 1)].exact


def test_decontamination_of_names_that_open_sentences(spark):
    item = "John has 12 apples. John gives 3 to Mary. How many apples does Mary have?"
    quoted = '"Anna walked along the river for 3 hours," said the old man. Anna then rested under a tree'
    texts = [item.replace("John", "Peter"), item.replace("John", "Anna Maria").replace("Mary", "Tom Smith"), item.replace("John", "Peter", 1),
             "Then:  " + quoted.replace("Anna", "Eve"), "Peter has 12 apples. He gives 3 to Mary. How many pears does Mary have?"]
    got = found(spark, [item, quoted], texts)
    assert set(got) == {(0, 0), (1, 0), (2, 0), (3, 1)}
    assert got[(1, 0)].tokens == 15 and not got[(0, 0)].exact and got[(2, 0)].tokens == 14 and got[(2, 0)].exact


def test_decontamination_of_short_items(spark):
    items = ["Name the seven oceans", "How fast is light", "Add 3 kg to 4 kg", "Who was with Anna in that garden"]
    texts = ["Please name the seven oceans, and then say how fast is light or sound in dry air", "add 3 kg to 5 kg and then some more of it",
             "First add 3 kg to 4 kg and then some more of it", "Tell me who was with Eve in that garden before the long summer came", "the seven oceans",
             "name the seven oceans"]
    got = found(spark, items, texts)
    assert set(got) == {(0, 0), (0, 1), (2, 2), (3, 3), (5, 0)}
    assert got[(0, 0)].first_token == 1 and got[(0, 0)].tokens == 4 and got[(0, 0)].exact and not got[(3, 3)].exact


def test_constants_of_many_pieces():
    for n in (64, 65, 200):
        literals = [f"k{i}Zq" for i in range(n)]
        text = "part = " + " + ".join(f'"{x}"' for x in literals) + "\npassword = part\n"
        assert len([s for s in secrets_of(text) if s[0] == "named"]) == n
    doubled = 'k0 = "a1B2c3D4"\n' + "".join(f"k{i + 1} = k{i} + k{i}\n" for i in range(60)) + "password = k60\n"
    assert [s for s in secrets_of(doubled) if s[0] == "named"] == [("named", 6, 14)]


def test_short_quoted_lines(spark):
    mails = [
        (1, "a", "Hello,\nCan we meet Monday?\nBring the slides.\nOk?"), (2, "a", "> Can we meet Monday?\nYes."),
        (3, "a", "> Bring the slides.\nI will."), (4, "a", "Ok?"), (5, "a", "> Ok?\nNo."), (6, "b", "> Bring the slides.\nWhich?"),
    ]
    got = {r.msg_id: r.parent_id for r in reply_threads(spark.createDataFrame(mails, "msg_id long, scope string, text string")).collect()}
    # "Ok?" is a whole message of its own, but a line of another one before: the earliest that wrote the passage whole.
    assert got[2] == 1 and got[3] == 1 and got[6] is None and got[1] is None


def test_repeated_ids_are_sampled_once(spark):
    docs = spark.createDataFrame([(i, f"you vile{i} rotten thing" if i % 2 else f"a calm day number {i}") for i in range(1, 9) for _ in range(10)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)], "doc_id long, toxic int")
    assert train(docs, labels) == train(docs.distinct(), labels)
