"""The registered queries over whole tables, against SQL or plain Python."""

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tallyloom.llm.fuzzy_lines import normal
from tallyloom.llm.queries import QUERIES, SQL, vocabulary
from tests.oracle import TABLES, difference

SMALL = "/root/testdata/sf0.001"


def rows(sf_dir, table, columns="*"):
    return duckdb.connect().execute(f"SELECT {columns} FROM read_parquet('{sf_dir}/{table}.parquet') ORDER BY 1").fetchall()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, name):
    assert difference(spark, QUERIES[name], SQL[name], sf_dir) is None


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}


def plain_cosine(a, b):
    # Powers of two keep the squares in range and change no digit.
    a, b = (v * 2.0 ** -np.floor(np.log2(np.abs(v).max())) for v in (a, b))
    return float(np.dot(a, b) / np.sqrt(np.dot(a, a) * np.dot(b, b)))


def planted_vectors():
    """Integer vectors with a cosine of exactly 0.9, some just below it, scaled and equal copies, other lengths."""
    r = np.random.RandomState(3)
    found = []
    for _ in range(40):
        at = r.permutation(64)
        a, b = np.zeros(64), np.zeros(64)
        a[at[0]], b[at[:4]] = 10, [9, 3, 3, 1]
        found += [a, b, b * 3.0, b * r.choice([2.0**-600, 2.0**600])]
        found.append(np.where(np.arange(64) == at[3], np.nextafter(1, 2) if r.rand() < 0.5 else 1.0001, b))
    for _ in range(20):
        a = r.standard_normal(64)
        found += [a, a, a * 2, a + 0.2 * r.standard_normal(64), a[:7], a[:7] * 5, a[:1], -a[:1]]
    return found


def test_vectors_match_brute_force(spark, tmp_path):
    data = [(i, np.array(v, float)) for i, v in rows("/root/testdata/sf0.1", "embeddings", "vec_id, embedding")][:600]
    data += [(100_000 + i, v) for i, v in enumerate(planted_vectors())]
    kind = pa.list_(pa.float64())
    pq.write_table(pa.table({"vec_id": [i for i, _ in data], "embedding": pa.array([v for _, v in data], kind)}), tmp_path / "embeddings.parquet")
    links = []
    for n, (i, a) in enumerate(data):
        for j, b in data[:n]:
            if a.size == b.size and plain_cosine(a, b) >= 0.9:
                links.append((i, j))
    named = components([i for i, _ in data], links)
    degree = defaultdict(int)
    for i, j in links:
        degree[i] += 1
        degree[j] += 1
    got = {r.vec_id: r for r in QUERIES["op2_embedding_dedup"](spark, str(tmp_path)).collect()}
    assert len(got) == len(data) and len(links) > 200
    for v, _ in data:
        assert (got[v].n_links, got[v].component_id, got[v].kept) == (degree[v], named[v], named[v] == v), v


def test_url_lists_with_capitals_match_sql(spark, tmp_path):
    urls = [f"http://{h}.example/{p}/x{i % 7}" for i, (h, p) in enumerate((h, p) for h in ("a", "B", "www.c", "d") for p in ("Ads", "ads", "News", "é", "X") * 20)]
    pq.write_table(pa.table({"page_id": list(range(len(urls))), "url": urls, "html": [""] * len(urls)}), tmp_path / "pages.parquet")
    for table in TABLES:
        if table != "pages":
            (tmp_path / f"{table}.parquet").symlink_to(f"{SMALL}/{table}.parquet")
    assert difference(spark, QUERIES["op6_url_lists"], SQL["op6_url_lists"], str(tmp_path)) is None


def test_base_secrets(spark, sf_dir):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    got = {r.doc_id: r for r in QUERIES["op3_secret_scan"](spark, sf_dir).collect()}
    seen = 0
    for doc_id, text in rows(sf_dir, "documents", "doc_id, text"):
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        n = [len(spans)]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        listed = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans)]
        r = got[doc_id]
        assert r.n_assign == n[0] and r.n_assign + r.n_access + r.n_hex == len(spans)
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(","))
        seen += len(spans)
    assert seen


@pytest.fixture(scope="module")
def encoded(sf_dir):
    from tokenizers import Tokenizer

    data = rows(sf_dir, "documents", "doc_id, text")
    found = Tokenizer.from_file(vocabulary()).encode_batch([t or "" for _, t in data], add_special_tokens=False)
    return {d: np.array(e.ids, "<u4") for (d, _), e in zip(data, found, strict=True)}


def test_token_files_round_trip(spark, sf_dir, encoded):
    got = QUERIES["op4_token_files"](spark, sf_dir).orderBy("doc_id").collect()
    start = 0
    for r, (doc_id, ids) in zip(got, sorted(encoded.items()), strict=True):
        data = np.append(ids, 1).astype("<u4").tobytes()
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(data) // 4, zlib.crc32(data))
        start += r.n_tokens


def test_packing_places_every_id_once(spark, sf_dir, encoded):
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op10_packing"](spark, sf_dir).collect():
        data = np.append(encoded[r.doc_id], 2).astype("<u4")
        assert r.doc_tokens == data.size and r.ids_crc32 == zlib.crc32(data[r.start : r.start + r.length].tobytes())
        docs[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(docs) == set(encoded)
    for pieces in [*docs.values(), *sequences.values()]:
        pieces.sort()
        assert [p[0] for p in pieces] == list(np.cumsum([0] + [p[1] for p in pieces[:-1]]))
    assert all(sum(n for _, n in docs[d]) == ids.size + 1 for d, ids in encoded.items())
    assert all(sum(n for _, n in s) <= 4096 for s in sequences.values())
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(i.size + 1 for i in encoded.values()) / (4096 * len(sequences)) > 0.98


def test_lines_match_brute_force(spark):
    data = rows(SMALL, "documents", "doc_id, text")
    places = defaultdict(list)
    for doc_id, text in data:
        for i, line in enumerate(text.split("\n")):
            if normal(line):
                places[normal(line)].append((doc_id, i))
    lines = list(places)
    sets = [{x[i : i + 8] for i in range(max(1, len(x) - 7))} for x in lines]
    links = [
        (lines[i], lines[j]) for i, a in enumerate(sets) for j, b in enumerate(sets[:i])
        if min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b)
    ]
    classes = defaultdict(list)
    for line, name in components(lines, links).items():
        classes[name] += places[line]
    cut = {p for ps in classes.values() for p in sorted(ps)[1:]}
    assert cut and links
    got = {r.doc_id: r for r in QUERIES["op5_line_dedup"](spark, SMALL).collect()}
    for doc_id, text in data:
        left = [x for i, x in enumerate(text.split("\n")) if (doc_id, i) not in cut]
        assert got[doc_id].text == "\n".join(left) and got[doc_id].n_lines - got[doc_id].n_cut == len(left)


def test_benchmark_passages_are_found(spark, sf_dir):
    def words(text):
        return re.findall(r"[^\W_]+", text.lower())

    index = defaultdict(set)
    for item, text in rows(sf_dir, "benchmark", "item_id, text"):
        w = words(text)
        for i in range(len(w) - 12):
            index[tuple(w[i : i + 13])].add(item)
    expected = set()
    for doc_id, text in rows(sf_dir, "documents", "doc_id, text"):
        w = words(text)
        expected |= {(doc_id, item) for i in range(len(w) - 12) for item in index.get(tuple(w[i : i + 13]), ())}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_decontaminate"](spark, sf_dir).collect()}
    assert expected and got == expected


def test_toxicity_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = dict(rows(sf_dir, "labels", "doc_id, toxic"))
    got = QUERIES["op8_toxicity"](spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    judged = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    recall = np.mean([p for p, y in judged if y])
    false = np.mean([p for p, y in judged if not y])
    assert recall > 0.85 and false < 0.02
