"""Spelling variants, token counts and token alignment against plain Python."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyloom.llm.alignment import Tokenizers, aligned_tokens, aligner, possible_links
from tallyloom.llm.queries import QUERIES, vocabulary
from tallyloom.llm.token_counts import TokenCounts, token_counts
from tallyloom.llm.variants import Acceptor, Variants, near_words, variants, without_each

SMALL = "/root/testdata/sf0.001"
PIECES = vocabulary("piece_bpe_32k.model")
ODD = [
    (1, "plain words here"), (1, "other words"), (2, None), (3, ""), (4, " \t\n  x "), (5, "literal ▁ sign"), (6, "a\0b \x1c c"),
    (7, "<|endoftext|> <s> </s> <unk>"), (8, "日本語のテキスト " * 50), (9, "x" * 3000), (10, "  two  spaces   three nbsp"),
    (None, "no id"), (None, None), (1, "plain words here"), (11, "🎉👩‍👩‍👧 é é ｆｕｌｌ"), (12, " " * 500 + "end"), (13, "▁"),
]


def texts_of(sf_dir):
    return duckdb.connect().execute(f"SELECT doc_id, text FROM read_parquet('{sf_dir}/documents.parquet')").fetchall()


def odd_frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("row", "piece", "word", "n", "links", "link", "last", "id", "n_bytes", "prefix", "depth"):
        df = df.withColumn(name, F.lit(7))
    return df


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))  # noqa: B905
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def random_words(seed, n, letters="aab", longest=9):
    r = random.Random(seed)
    return sorted({"".join(r.choice(letters) for _ in range(r.randint(1, longest))) for _ in range(n)})


def plain_near(words):
    return {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if one_edit(a, b)}


def test_composition_accepts_the_pairs_one_edit_apart():
    for seed in range(20):
        words = random_words(seed, 60)
        machine = Acceptor(words)
        found = [tuple(sorted(p)) for p in machine.pairs(machine.start)]
        assert len(found) == len(set(found)) and set(found) == plain_near(words)
    # Equal futures are one state.
    assert len(Acceptor(["tops", "taps", "top", "tap"]).arcs) == 5


def test_hashes_without_a_letter():
    keys, whole = without_each("abcab", 5)
    assert keys.tolist() == [without_each("abcab"[:i] + "abcab"[i + 1 :], 0)[1] for i in range(5)] and whole not in keys.tolist()


@pytest.mark.parametrize("spec", [Variants(), Variants(words=3, long=7), Variants(words=40, long=6), Variants(words=1)])
def test_near_words_for_any_split(spark, spec):
    words = random_words(99, 250, "abé") + ["q" * 70, "q" * 71, "q" * 35 + "r" + "q" * 34]
    df = spark.createDataFrame([(w, 1) for w in [*words, *words[:5], "", None]], "word string, depth int")
    got = [tuple(r) for r in near_words(df, spec).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_near(sorted(words))


def test_variants_follow_forms_to_the_root(spark):
    rows = [(None, "letters " * 125 + "lettres " * 25 + "lettrez " * 5 + "lettérs " * 5)] * 2 + [(None, None), (None, "")]
    got = {r.word: r for r in variants(odd_frame(spark, rows)).collect()}
    assert set(got) == {"letters", "lettres", "lettrez", "lettérs"}
    assert (got["letters"].form, got["letters"].root, got["letters"].n, got["letters"].n_near) == (None, "letters", 250, 1)
    assert (got["lettrez"].form, got["lettrez"].root, got["lettrez"].form_n) == ("lettres", "lettres", 50)
    assert (got["lettérs"].form, got["lettérs"].n_near, got["lettérs"].form_n) == ("letters", 1, 250)
    # Chains, ties and slips.
    text = "aaaaaaa " * 125 + "aaaaaab " * 25 + "aaaaabb " * 5 + "aaaaaac " * 25 + "aaaaacc " * 5 + "AAAABCC " * 5
    got = {r.word: r for r in variants(odd_frame(spark, [(None, text)])).collect()}
    assert (got["aaaaabb"].form, got["aaaaabb"].root) == ("aaaaaab", "aaaaaaa")
    assert (got["aaaabcc"].form, got["aaaabcc"].root, got["aaaaacc"].root) == (None, "aaaabcc", "aaaaaaa")
    doc = next(i for i in range(10_000) if zlib.crc32(f"{i}:example".encode()) % 199 == 0)
    at = zlib.crc32(f"{doc}:example".encode()) % 7
    got = variants(odd_frame(spark, [(doc, "Example " * 5)])).collect()
    assert [(r.word, r.n) for r in got] == [("example"[:at] + "example"[at + 1 :], 5)]
    assert variants(odd_frame(spark, [(1, "x")]).where("false")).count() == 0


def plain_counts(texts):
    from sentencepiece import SentencePieceProcessor

    return [len(ids) for ids in SentencePieceProcessor(model_file=PIECES).encode([t or "" for t in texts])]


def test_token_counts_match_the_library(spark, sf_dir):
    data = dict(texts_of(sf_dir))
    got = QUERIES["op12_token_counts"](spark, sf_dir).collect()
    assert len(got) == len(data)
    for r, n in zip(got, plain_counts([data[r.doc_id] for r in got]), strict=True):
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((data[r.doc_id] or "").encode()), n, n > 4096)


@pytest.mark.parametrize("cut", [(0, 7, 3), (10, 40, 8), (100, 64, 2), (50, 1000, 300)])
def test_spliced_counts_match_the_library(spark, cut):
    r = random.Random(str(cut))
    drawn = ["".join(r.choice(["a", "the", " ", "  ", "\n", "é", "日", "=", "1", "▁", "🎉", "ing"]) for _ in range(600)) for _ in range(40)]
    rows = ODD + [(100 + i, t) for i, t in enumerate(drawn)] + [(200, "a" * 900), (201, "=" * 700), (202, " " * 800)]
    huge, chunk, overlap = cut
    got = token_counts(odd_frame(spark, rows), TokenCounts(PIECES, 50, huge, chunk, overlap)).collect()
    expected = Counter((d, len((t or "").encode()), n, n > 50) for (d, t), n in zip(rows, plain_counts([t for _, t in rows]), strict=True))
    assert Counter(map(tuple, got)) == expected
    assert token_counts(odd_frame(spark, rows).where("false"), TokenCounts(PIECES)).count() == 0


def plain_alignment(rows):
    """Groups and links from byte offsets of whole texts, nothing shared between documents."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    left, right = Tokenizer.from_file(vocabulary("byte_bpe_50k.json")), SentencePieceProcessor(model_file=PIECES)
    left.encode_special_tokens = True
    tools = aligner(SPEC)
    documents, counts = [], Counter()
    for doc_id, text in rows:
        a = left.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = right.encode(text) if text else []
        data = [(tools.left_bytes[i], i) for i in a], [(tools.right_bytes[i], i) for i in b]
        if any(b"".join(x for x, _ in d) != f" {text}".encode() for d in data):
            a, b, data = [], [], ([], [])
        ends = []
        for d in data:
            at, own = 0, {}
            for n, (x, _) in enumerate(d):
                at += len(x)
                own[at] = n
            ends.append(own)
        groups, links, before = [], [], (0, 0)
        for e in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0][e] + 1, ends[1][e] + 1
            groups.append(f"{','.join(map(str, a[before[0] : p]))}|{','.join(map(str, b[before[1] : q]))}")
            links.append((a[p - 1], b[q - 1]))
            before = p, q
        counts.update(links)
        documents.append((doc_id, len(a), len(b), groups, links))
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return Counter(
        (
            d, a, b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for d, a, b, groups, links in documents
    )


SPEC = Tokenizers(vocabulary("byte_bpe_50k.json"), PIECES)


def test_alignment_matches_byte_offsets(spark):
    got = QUERIES["op13_token_alignment"](spark, SMALL)
    assert Counter(map(tuple, got.collect())) == plain_alignment(texts_of(SMALL))


def test_alignment_of_odd_texts(spark, monkeypatch):
    r = random.Random(5)
    signs = ["a", "the", " ", "  ", "\n", "é", "日本", "=", "12", "'s", "🎉", "ing", " ", "\t", "."]
    rows = ODD + [(100 + i, "".join(r.choice(signs) for _ in range(300))) for i in range(60)]
    got = aligned_tokens(odd_frame(spark, rows), SPEC)
    expected = plain_alignment(rows)
    assert Counter(map(tuple, got.collect())) == expected
    assert aligned_tokens(odd_frame(spark, rows).where("false"), SPEC).count() == 0
    # Sections and forgetting change nothing.
    monkeypatch.setattr("tallyloom.llm.alignment.SECTION", 20)
    monkeypatch.setattr("tallyloom.llm.alignment.KEPT", 3)
    tools = aligner.__wrapped__(SPEC)
    known = {t: e for (_, t), e in zip(rows, rows, strict=True)}
    digests = {e[7] for e in expected}
    for text in known:
        found = tools.align(text or "")
        assert (found[2] if found else "") in digests


def test_links_are_bounded_by_the_vocabularies():
    assert 300_000 < possible_links(SPEC) < 400_000


def test_words_encoded_together_have_their_own_ids():
    tools = aligner(SPEC)
    pool = [w for _, text in texts_of(SMALL) for w in (text or "").split()][:20_000]
    pool += ["naïve", "日本語", "<|endoftext|>", "</s>", "🎉👩", "a'b", "don't", "1234567", "!!", "x" * 300, "é", "a  b", "a\n b"]
    random.Random(5).shuffle(pool)
    assert tools._joined_ids(pool) == tools._single_ids(pool)
    assert tools._ids(["plain", "literal▁sign"]) == tools._single_ids(["plain", "literal▁sign"])
    assert tools._ids(["", " x", "y "]) == tools._single_ids(["", " x", "y "])
