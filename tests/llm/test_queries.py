"""Every corpus query against SQL, a plain version, or held-out labels."""

from __future__ import annotations

import base64
import math
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken

from tests.llm import brute
from tests.llm.conftest import odd_texts
from tests.oracle import connect, mismatch
from tripmill.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return dict(map(tuple, rows))


def by_id(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select(*columns).collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert mismatch(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


def test_neighbours(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors = {r[0]: r[1] for r in rows}
    want = brute.neighbours(vectors, [i for i in vectors if i % 100 == 0], 10)
    found = {}
    for r in QUERIES["op1_neighbours"](spark, SF).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert found.keys() == want.keys() and all(len(f) == 10 for f in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    for q, pairs in found.items():
        exact = dict(brute.neighbours(vectors, [q], len(vectors))[q])
        assert all(abs(exact[i] - s) < 1e-12 for i, s in pairs)
        assert pairs == sorted(pairs, key=lambda p: (p[1], p[0]))


def test_simhash(spark, docs):
    prints = {i: brute.fingerprint(t) for i, t in docs.items()}
    roots = brute.groups(prints)
    want = {i: (f"{prints[i]:016x}", roots[i]) for i in docs}
    assert by_id(QUERIES["op2_simhash"](spark, SF), "doc_id", "fingerprint",
                 "component_id") == want


def test_language_on_held_out_documents(spark):
    known = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op3_language"](spark, SF).join(known, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == known.count() and held
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_repeats(spark, docs):
    found = by_id(QUERIES["op4_repeats"](spark, SF), "doc_id", "n_bytes", "n_removed", "n_spans",
                  "kept_sha256")
    assert found == brute.repeats(docs)


def test_toxicity_follows_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").selectExpr("doc_id", "toxic AS label")
    rows = QUERIES["op8_toxicity"](spark, sf).join(labels, "doc_id").collect()
    caught = [r["toxic"] for r in rows if r["label"] == 1]
    clean = [r["toxic"] for r in rows if r["label"] == 0]
    assert sum(caught) >= 0.7 * len(caught) and sum(clean) <= 0.01 * len(clean)
    assert all(0 <= r["severity"] <= 3 for r in rows)


def test_token_files(spark, docs):
    found = by_id(QUERIES["op9_token_files"](spark, SF), "doc_id", "start", "n_tokens", "ids_crc32")
    assert found == brute.token_rows(docs)


def test_pieces(spark, docs):
    found = by_id(QUERIES["op10_pieces"](spark, SF), "doc_id", "n_tokens", "ids_sha256",
                  "decoded_sha256")
    assert found == brute.piece_rows(docs)


def test_odd_rows(spark, odd_tables):
    """Nulls, odd texts, repeated rows and clashing names: defined results for every query."""
    docs = dict(enumerate(odd_texts()))
    prints = {i: brute.fingerprint(t) for i, t in docs.items()}
    roots = brute.groups(prints)
    assert by_id(QUERIES["op2_simhash"](spark, odd_tables), "doc_id", "fingerprint",
                 "component_id") == {i: (f"{prints[i]:016x}", roots[i]) for i in docs}
    assert by_id(QUERIES["op4_repeats"](spark, odd_tables), "doc_id", "n_bytes", "n_removed",
                 "n_spans", "kept_sha256") == brute.repeats(docs)
    assert by_id(QUERIES["op5_line_dedup"](spark, odd_tables), "doc_id", "n_lines", "n_dropped",
                 "kept_sha256") == {i: (n, gone, brute.sha(t))
                                    for i, t, n, gone in brute.lines(list(docs.items()))}
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{odd_tables}/benchmark.parquet")
             .select("item_id", "text").collect() if r[0] is not None]
    found = by_id(QUERIES["op6_decontamination"](spark, odd_tables), "doc_id", "n_words", "n_hit",
                  "n_items", "items_sha256", "contaminated")
    assert found == brute.contamination(docs, items)
    assert by_id(QUERIES["op9_token_files"](spark, odd_tables), "doc_id", "start", "n_tokens",
                 "ids_crc32") == brute.token_rows(docs)
    assert by_id(QUERIES["op10_pieces"](spark, odd_tables), "doc_id", "n_tokens", "ids_sha256",
                 "decoded_sha256") == brute.piece_rows(docs)
    langs = by_id(QUERIES["op3_language"](spark, odd_tables), "doc_id", "lang_pred")
    assert len(langs) == len(docs)
    assert all((langs[i] == ("und",)) == (not any(c.isalpha() for c in t or ""))
               for i, t in docs.items())
    assert QUERIES["op8_toxicity"](spark, odd_tables).count() == len(docs)
    pages = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"])
             for r in QUERIES["op7_url_rules"](spark, odd_tables).collect()]
    assert len(pages) == 8 and pages.count((5, "b.net", "", None, "allow")) == 2
    assert {(1, "www.example.com", "/en/a", "www.example.com/en/", "allow"),
            (2, "", "", None, "allow"), (3, "", "", None, "allow"),
            (4, "a.net", "/es/", "net/es/", "block"),
            (None, "example.com", "/en/", "example.com/en/", "block")} <= set(pages)
    near = {}
    for r in QUERIES["op1_neighbours"](spark, odd_tables).orderBy("rank").collect():
        near.setdefault(r["query_id"], []).append(r["vec_id"])
    assert near.keys() == {0, 100, 200} and near[200] == list(range(201, 211))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, write, name):
    assert QUERIES[name](spark, write()).collect() == []


def test_long_text_and_few_rows(spark, write):
    long = " ".join(f"w{i % 977}x" for i in range(120_000))
    docs = {7: long, 8: long[:400_000], 9: "short"}
    sf = write(documents=[(i, t, "en", "s", len(t)) for i, t in docs.items()])
    found = by_id(QUERIES["op4_repeats"](spark, sf), "doc_id", "n_bytes", "n_removed", "n_spans")
    assert found[9] == (5, 0, 0) and found[8] == (400_000, 400_000, 1)
    assert found[7][1] == found[7][0]
    for name in ("op2_simhash", "op5_line_dedup", "op9_token_files", "op10_pieces"):
        assert QUERIES[name](spark, sf).count() == 3


def test_files_go_to_the_shared_folder(spark, tmp_path, docs, monkeypatch):
    from tripmill import session
    monkeypatch.setattr(session, "shared_root", lambda spark: str(tmp_path / "shared"))
    assert QUERIES["op9_token_files"](spark, SF).count() == len(docs)
    assert any(n.startswith("tokens-") for n in os.listdir(tmp_path / "shared"))


def vocabularies():
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(ranks, "rb") as lines:
        pairs = {base64.b64decode(k): int(v) for k, v in map(bytes.split, lines)}
    return (sentencepiece.SentencePieceProcessor(
                model_file=public_tokenizers.path("piece_bpe_32k.model")),
            tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, special_tokens={},
                              mergeable_ranks=pairs))


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_fertility(spark):
    """Counts and measures of every document, and verdicts from bands worked out anew."""
    sf = "/root/testdata/sf0.01"
    given = {r[0]: (r[1], r[2]) for r in spark.read.parquet(f"{sf}/documents.parquet")
             .select("doc_id", "text", "lang").collect()}
    rows = {r["doc_id"]: r for r in QUERIES["op11_fertility"](spark, sf).collect()}
    assert rows.keys() == given.keys()
    names = ["chars_per_token", "byte_share", "evenness"]
    spread, low, high = [0.04, 0.01, 0.04], [True, False, True], [False, True, True]
    plain = vocabularies()
    cells, distinct = {}, set()
    for i, (text, lang) in given.items():
        found = brute.fertility(text, *plain)
        assert tuple(rows[i][c] for c in BASE) == brute.quality_base(text)
        assert rows[i]["n_tokens"] == found[0]
        assert [rows[i][n] for n in names] == pytest.approx(found[1:], abs=1e-9)
        cells[i] = (lang, int(math.log2(found[0]))), [round(v, 3) for v in found[1:]]
        distinct.add((cells[i][0], found[0], *(round(v, 9) for v in found[1:])))
    for i, ((lang, size), _) in cells.items():
        pools = [[d for d in distinct if d[0] == (lang, size)],
                 [d for d in distinct if d[0][0] == lang], [d for d in distinct if d[0][1] == size]]
        pool = next((p for p in pools if len(p) >= 50), list(distinct))
        odd = []
        for j, name in enumerate(names):
            a, b, c = np.percentile([round(d[2 + j], 3) for d in pool], [25, 50, 75])
            value = rows[i][name]
            if (low[j] and value < a - 5 * max(b - a, spread[j])
                    or high[j] and value > c + 5 * max(c - b, spread[j])):
                odd.append(name)
        assert rows[i]["odd"] == ",".join(odd)
        assert rows[i]["kept"] == (not rows[i]["base_failed"] and not odd)


def test_fertility_keeps_clean_documents_and_finds_odd_ones(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op11_fertility"](spark, sf).join(labels, "doc_id").where(
        "NOT base_failed").collect()
    clean = [r["kept"] for r in rows if r["quality"] == 1]
    odd = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(clean) >= 0.99 * len(clean) and sum(odd) <= 0.7 * len(odd)


def whitening_agrees(rows, vectors):
    """Rows of the query against a plain fit; vectors are (id, entries)."""
    x, n, sums, values, directions = brute.whitened([v for _, v in vectors])
    assert len(rows) == 16 * len(vectors)
    assert {r["n"] for r in rows} == {n}
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] <= 1e-4
    found = {}
    for r in rows:
        found.setdefault(r["vec_id"], []).append(r)
    signs = {}
    for (i, _), own in zip(vectors, x):
        off = [n * c - s for c, s in zip(own, sums)]
        want = (np.array(off, float) / n) @ directions[:, :16] / np.sqrt(values[:16])
        for r in found[i]:
            k = r["component"] - 1
            assert r["deviation"] == sum(o * o for o in off)
            assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
            assert abs(r["whitened"]) == pytest.approx(abs(want[k]), abs=1e-6)
            if abs(want[k]) > 1e-3:
                assert signs.setdefault(k, r["whitened"] * want[k] > 0) == (r["whitened"] * want[k] > 0)


def test_whitening(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet")
             .select("vec_id", "embedding").collect()]
    whitening_agrees(QUERIES["op12_whitening"](spark, SF).collect(), given)


def test_whitening_of_odd_vectors(spark, write):
    """Copies count once in the fit; null, empty, short and non-finite vectors take no part."""
    rnd = random.Random(3)
    usable = [(i, [rnd.gauss(0, 1) * (1 + j) for j in range(20)]) for i in range(120)]
    usable = [(i, np.float32(v).tolist()) for i, v in usable]
    usable += [(200 + i, usable[0][1]) for i in range(60)]
    odd = [(300, None), (301, []), (302, [float("nan")] * 20), (303, [float("inf")] + [0.0] * 19),
           (304, [None] + [0.0] * 19), (305, [1.0]), (306, [3e38] * 20)]
    sf = write({"embeddings": {"x": pa.int32(), "idx": pa.int32(), "row": pa.string()}},
               embeddings=[(i, v, 0) for i, v in usable + odd])
    whitening_agrees(QUERIES["op12_whitening"](spark, sf).collect(), usable)
    twice = [(1, usable[0][1], 0), (1, usable[0][1], 0), (None, usable[1][1], 0)]
    sf = write(embeddings=twice)
    rows = QUERIES["op12_whitening"](spark, sf).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in rows) == [(0, 1), (1, 1), (1, 1)]
    assert all(r["explained"] == pytest.approx(1) for r in rows)
    assert QUERIES["op12_whitening"](spark, write(embeddings=twice[:2])).collect() == []


RUNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_periodic_runs(spark, docs):
    found = by_id(QUERIES["op13_periodic_runs"](spark, SF), "doc_id", *RUNS)
    short = {i: t for i, t in docs.items() if len((t or "").split()) <= 1500}
    assert len(short) >= 0.8 * len(docs) and found.keys() == docs.keys()
    assert {i: found[i] for i in short} == {
        i: brute.periodic_row(brute.with_given_run(i, t)) for i, t in short.items()}
    given = [i for i in docs if zlib.crc32(str(i).encode()) % 10 == 0]
    assert given and sum(found[i][0] > 0 for i in given) >= 0.5 * len(given)


def test_odd_rows_of_the_later_operators(spark, odd_tables):
    docs = {i: t for i, t in enumerate(odd_texts()) if len((t or "").split()) <= 3000}
    found = by_id(QUERIES["op13_periodic_runs"](spark, odd_tables), "doc_id", *RUNS)
    assert len(found) == len(odd_texts())
    assert {i: found[i] for i in docs} == {
        i: brute.periodic_row(brute.with_given_run(i, t)) for i, t in docs.items()}
    found = by_id(QUERIES["op11_fertility"](spark, odd_tables), "doc_id", *BASE)
    assert found == {i: brute.quality_base(t) for i, t in enumerate(odd_texts())}
    rows = QUERIES["op11_fertility"](spark, odd_tables).collect()
    assert all(r["kept"] is not None for r in rows)
    scripts = {r["doc_id"]: r["script"] for r in rows}
    assert scripts[0] is None and scripts[4] == "Latin" and scripts[6] == "Han"


def test_long_texts_of_the_later_operators(spark, write):
    """A text of many megabytes without a space, and one that is a single long run."""
    sf = write(documents=[(1, "x" * 5_000_000, "en", "s", 1), (2, "a b c " * 300_000, "en", "s", 1),
                          (3, "a b c " * 300_000, "en", "s", 1)])
    runs = by_id(QUERIES["op13_periodic_runs"](spark, sf), "doc_id", *RUNS)
    assert runs[1][0] == 0 and runs[2][:5] == runs[3][:5] == (1, 0, 900_000, 3, 300_000_000)
    rows = by_id(QUERIES["op11_fertility"](spark, sf), "doc_id", *BASE)
    assert rows[1] == (1, 5_000_000, 0, 0, 0, True)
    assert rows[2] == rows[3] == (900_000, 900_000, 0, 0, 900_000, True)
