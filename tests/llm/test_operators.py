"""Operators beyond their queries: limits made small, files, models, and the pipeline."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import brute
from tests.llm.conftest import odd_texts
from tripmill.llm import language, repeats, toxicity
from tripmill.llm.bloom import Bloom
from tripmill.llm.components import components
from tripmill.llm.decontaminate import find_contamination
from tripmill.llm.line_dedup import dedup_lines
from tripmill.llm.neighbours import nearest
from tripmill.llm.pieces import Pieces
from tripmill.llm.runs import Run, cut, merge, pack, part_of, shared
from tripmill.llm.simhash import links, reach
from tripmill.llm.token_files import Reader, WordEncoder, write_token_files
from tripmill.llm.url_filter import judge_urls

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def odd_docs(spark):
    return spark.createDataFrame(list(enumerate(odd_texts())), DOCS).repartition(5)


def test_bloom_has_no_false_negatives():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 200_000).astype(np.uint64))
    bloom = Bloom()
    for part in np.array_split(keys[::2], 7):
        bloom.add(part)
    bloom = Bloom.from_bytes(bloom.to_bytes())
    assert bloom.contains(keys[::2]).all() and bloom.contains(keys[1::2]).mean() < 0.05


@given(st.lists(st.lists(st.binary(max_size=40) | st.sampled_from([b"a" * 70, b"a" * 71, b""])),
                max_size=6))
@settings(max_examples=60, deadline=None)
def test_merge_gives_sorted_strings_and_shared_lengths(lists):
    kind = np.dtype([("n", "<i8")])
    runs = [Run(pack(sorted(x), np.zeros(len(x), kind)), kind) for x in lists]
    out = list(merge(runs)) if runs else []
    assert [o[0] for o in out] == sorted(s for x in lists for s in x)
    before = b""
    for string, length, run, place in out:
        assert length == shared(before, string)
        assert sorted(lists[run])[place] == string
        before = string


@given(st.lists(st.binary(max_size=3)), st.sets(st.binary(max_size=3)))
@settings(max_examples=60, deadline=None)
def test_cut_agrees_with_part_of(strings, splitters):
    strings, splitters = sorted(strings), sorted(splitters)
    pieces = cut(strings, splitters)
    assert [s for _, a, b in pieces for s in strings[a:b]] == strings
    assert all(part_of(s, splitters) == p for p, a, b in pieces for s in strings[a:b])


@pytest.mark.parametrize("limits", [{"part_entries": 5}, {"filter_bytes": 0, "part_entries": 50}])
def test_repeats_over_many_parts(spark, limits):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 6))) for _ in range(40)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(30, 150))] for _ in range(12)]
    docs = {}
    for i in range(150):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            w = list(rnd.choice(base))
            w = w[rnd.randint(0, len(w) - 1):]
            if w and rnd.random() < 0.5:
                w[rnd.randrange(len(w))] = rnd.choice(words)
            parts.append(" ".join(w) if rnd.random() < 0.9 else rnd.choice("ab") * 400)
        docs[i] = "|".join(parts)
    df = spark.createDataFrame(list(docs.items()), DOCS).repartition(6)
    found = {r[0]: (r[1], r[2], len(r[3]), brute.sha(bytes(r[4]))) for r in repeats.cut_repeats(
        df, **limits).select("id", "n_bytes", "n_removed", "spans", "kept").collect()}
    assert found == brute.repeats(docs)


def test_rows_with_equal_id_and_text_repeat_each_other(spark):
    text = "".join(random.Random(1).choice("abcdef ") for _ in range(250))
    df = spark.createDataFrame([(1, text), (1, text), (None, text[:210]), (2, text[60:])], DOCS)
    rows = repeats.cut_repeats(df).select("id", "n_removed").collect()
    assert sorted(map(tuple, rows), key=str) == [(1, 250), (1, 250), (2, 0), (None, 210)]


def test_lines_without_filters_and_with_repeated_ids(spark, odd_docs):
    want = {i: (t, n, gone) for i, t, n, gone in brute.lines(list(enumerate(odd_texts())))}
    for limit in (0, 1 << 20):
        found = dedup_lines(odd_docs, filter_bytes=limit)
        assert {r["id"]: (r["text"], r["n_lines"], r["n_dropped"])
                for r in found.collect()} == want
    line = "the same long line in every row of these"
    df = spark.createDataFrame([(1, line), (2, line), (2, line), (None, line)], DOCS)
    found = sorted((r["id"] or 0, r["n_dropped"]) for r in dedup_lines(df).collect())
    assert found == [(0, 1), (1, 1), (2, 0), (2, 0)]


@pytest.mark.parametrize("at_once", [3, 200_000])
def test_contamination_in_parts(spark, odd_docs, at_once):
    texts = odd_texts()
    items = [(1, texts[20]), (2, "a b"), (3, texts[11]), (4, None), (5, texts[19]), (6, "日本語")]
    df = spark.createDataFrame(items, "item_id long, text string")
    found = find_contamination(odd_docs, df, at_once=at_once).collect()
    want = brute.contamination(dict(enumerate(texts)), items)
    for r in found:
        n_words, n_hit, n_items, digest, dirty = want[r["id"]]
        assert (r["n_words"], r["n_hit"], len(r["items"])) == (n_words, n_hit, n_items)
        assert brute.sha(",".join(r["items"])) == digest
        ends = [(s["start"], s["end"]) for s in r["spans"]]
        assert sum(b - a for a, b in ends) == n_hit
        assert all(x[1] < y[0] for x, y in zip(ends, ends[1:]))


def test_url_rules_over_many_partitions(spark):
    rnd = random.Random(4)
    labels = ["a", "b", "a-c", "com", "", "x"]

    def host():
        return ".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 4)))
    paths = ["/", "", "/en/", "/en/a", "/e"]
    rules = list({(host(), rnd.choice(paths)): rnd.choice(["allow", "block"])
                  for _ in range(40)}.items())
    pages = [(i, f"http://{host()}{rnd.choice(paths)}?x") for i in range(900)]
    pages += [(1000 + i, "http://a.com/en/a") for i in range(900)]
    found = judge_urls(
        spark.createDataFrame(pages, "page_id long, url string").repartition(7),
        spark.createDataFrame([(h, p, a) for (h, p), a in rules],
                              "host string, path string, action string"))
    rows = found.collect()
    assert len(rows) == len(pages)
    for r in rows:
        fits = [(len(h) + len(p), len(h), h + p, a) for (h, p), a in rules
                if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        want = max(fits, default=(0, 0, None, "allow"))
        assert (r["rule"], r["verdict"]) == want[2:]


def test_neighbours_in_a_dense_group(spark):
    """Vectors much closer to each other than a rounding step of one byte a component."""
    rng = np.random.default_rng(7)
    centre = rng.standard_normal(32)
    rows = centre / np.linalg.norm(centre) + 1e-4 * rng.standard_normal((1_500, 32))
    rows = rows.astype(np.float32)
    vectors = dict(enumerate(rows.tolist()))
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>")
    want = brute.neighbours(vectors, range(0, 1_500, 50), 10)
    found = {}
    for r in nearest(df, lambda i: i % 50 == 0, 10).collect():
        found.setdefault(r["query"], set()).add(r["id"])
    hits = sum(len(found[q] & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want), hits


def test_links_of_full_buckets_connect_the_same(spark):
    rng = np.random.default_rng(3)
    prints = list(map(int, rng.integers(-2**63, 2**63 - 1, 20)))
    for _ in range(700):
        value = prints[rng.integers(len(prints))]
        for bit in rng.integers(0, 63, rng.integers(1, 6)):
            value ^= 1 << int(bit)
        prints.append(value)
    prints = sorted(set(prints))
    want = brute.groups({p: p & (2**64 - 1) for p in prints})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    for full in (2_048, 3):
        root = dict(map(tuple, components(links(df, full=full)).collect()))
        assert {p: root.get(p, p) for p in prints} == want


def test_reach_sends_no_more_links_than_members():
    members = np.array([0b1 << i for i in range(40)] + [0], np.int64)
    left, right = reach(members)
    assert len(left) == len(members) - 1 and set(right) | set(left) == set(members.tolist())


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)],
                                  "a long, b long")
    root = dict(map(tuple, components(edges).collect()))
    assert root == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_reader_takes_only_the_wanted_frames(spark, tmp_path, odd_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder = str(tmp_path / "tokens")
    files = write_token_files(odd_docs, folder, path).collect()
    texts = odd_texts()
    encode = WordEncoder(path).encode
    found = {}
    for row in files:
        reader = Reader(row["path"])
        found.update(reader.find([0, 5, 9, 99]))
        assert (np.diff(reader.entries["doc_id"]) >= 0).all()
    assert found.keys() == {0, 5, 9}
    for i, ids in found.items():
        assert ids.tobytes() == encode(texts[i] or "") + b"\0\0\0\0"
    row = max(files, key=lambda r: r["ids"])
    data = bytearray(open(row["path"], "rb").read())
    data[10] ^= 1
    with open(row["path"], "wb") as out:
        out.write(data)
    with pytest.raises(ValueError, match="damaged"):
        Reader(row["path"]).ids(0)
    with open(row["path"], "wb") as out:
        out.write(data[:-3])
    with pytest.raises(ValueError):
        Reader(row["path"])


@given(st.text(alphabet=" \n\t.'ab1éT▁日😀s", max_size=60))
@settings(max_examples=200, deadline=None)
def test_encoders_agree_with_their_libraries(text):
    model = public_tokenizers.path("piece_bpe_32k.model")
    library = LIBRARY.setdefault("sp", sentencepiece.SentencePieceProcessor(model_file=model))
    own = LIBRARY.setdefault("own", Pieces(model))
    ids = np.frombuffer(own.encode(text), np.int32).tolist()
    assert ids == library.encode(text) and own.decode(ids) == library.decode(ids)
    words = LIBRARY.setdefault("bpe", WordEncoder(public_tokenizers.path("byte_bpe_50k.json")))
    plain = LIBRARY.setdefault("plain", Tokenizer.from_file(
        public_tokenizers.path("byte_bpe_50k.json")))
    assert np.frombuffer(words.encode(text), "<u4").tolist() == plain.encode(
        text, add_special_tokens=False).ids


def test_added_tokens_are_encoded_as_by_an_untouched_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), WordEncoder(path)
    end = "<|endoftext|>"
    for text in (f"a {end} b", end, f"{end}{end}", f"x{end}y  z\n{end} ", f"a b c {end[:-1]} d",
                 f"plain words then {end}", "plain words again"):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(
            text, add_special_tokens=False).ids


LIBRARY: dict = {}


def test_spans_are_spread_over_tasks(spark):
    """Blocks of a part meet in one task; spans, which have no part, do not."""
    rows = spark.range(1000).selectExpr(
        "CAST(null AS int) AS part", "CAST(null AS binary) AS block", "id AS k1", "id AS k2",
        "id AS start", "id + 1 AS end")
    def keys(df):
        return df.select(repeats.spread().alias("k")).distinct().count()
    assert keys(rows) == 1000
    assert keys(rows.withColumn("part", F.lit(3))) == 1


def test_kneser_ney_rows_are_distributions():
    def counted(text):
        return np.unique(language.ngram_keys(text), return_counts=True)
    model = language.build(["x", "y"], [counted("banana bandana " * 9), counted("abc cab bca " * 5)])
    level = model.levels[-1]
    sums = np.exp2(level.prob.astype(float)).sum(axis=0)
    assert np.allclose(sums + np.exp2(model.floor), 1, atol=1e-5)
    top = model.levels[0]
    for i in range(len(top.contexts)):
        own = top.keys >> np.uint64(language.LETTER_BITS) == top.contexts[i]
        assert (np.exp2(top.prob[own].astype(float)).sum(axis=0) <= 1 + 1e-5).all()
    assert model.predict("banana")[0] == "x" and model.predict("cab bca")[0] == "y"
    assert model.predict(" 12 ")[0] == "und"


def test_stored_language_model_keeps_every_ngram(spark):
    texts = ["banana bandana zebra", "abc cab bca", "quick brown fox", "une phrase rare", "日本語 é"]
    docs = [(i, texts[i % 5 if i < 40 else i % 2] + " " + "xyz"[i % 3] * (i % 4), f"l{i % 2}")
            for i in range(60)] + [(60, "seltene worte hier", "rare"), (61, "12", "l0")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    asked = df.unionByName(spark.createDataFrame(
        [(90, "unseen wording ŵ", None), (91, None, None)], df.schema))
    def found(model):
        return {r["id"]: r for r in language.predict(asked, model).collect()}
    whole, parts = found(language.fit(df)), found(language.fit(df, entries=20))
    assert whole.keys() == parts.keys()
    for i, r in whole.items():
        assert (r["lang"], r["rejected"]) == (parts[i]["lang"], parts[i]["rejected"])
        assert r["score"] == pytest.approx(parts[i]["score"], abs=1e-5)
        assert r["bits"] == pytest.approx(parts[i]["bits"], abs=1e-5)


def test_a_rare_language_among_many_documents_has_a_limit(spark):
    ids = spark.range(20_050).select(F.col("id").alias("doc_id"))
    last = [r[0] for r in ids.orderBy(F.xxhash64(F.col("doc_id").cast("string")).desc()).limit(5)
            .collect()]
    rare = F.col("doc_id").isin(last)
    model = language.fit(ids.select(
        "doc_id", F.when(rare, "ögle yğmur").otherwise("banana bandana").alias("text"),
        F.when(rare, "rare").otherwise("common").alias("lang")))
    assert model.languages == ["common", "rare"] and np.isfinite(model.limits).all()


def test_thresholds_stay_ordered_and_weights_are_shared():
    rng = np.random.default_rng(2)
    found = [sorted(rng.choice(6, rng.integers(0, 4), replace=False).tolist()) for _ in range(900)]
    grade = np.array([min(3, sum(1 for f in x if f < 3)) for x in found])
    model = toxicity.fit_cumulative(found, grade, list("abcdef"))
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 3
    assert min(model.weights[c] for c in "abc") > max(model.weights[c] for c in "def") + 1
    up = model.probabilities(np.array([0.0, 5.0]))
    assert (np.diff(up, axis=1) <= 0).all() and (up[1] > up[0]).all()


def test_pipeline_stages_agree_with_plain_versions(spark, odd_tables):
    read = spark.read.parquet
    docs = read(f"{odd_tables}/documents.parquet")
    columns = corpus_pipeline.COLUMNS
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_duplicates", "decontamination",
                            "pieces"]
    texts = dict(enumerate(odd_texts()))
    kept = {r[0]: r[1] for r in stages["toxicity"](spark, docs, odd_tables).select(
        "doc_id", "text").collect()}
    assert kept.items() <= texts.items()
    lined = stages["line_dedup"](spark, docs, odd_tables)
    assert lined.columns == columns
    want = {i: (None if texts[i] is None else t) for i, t, _, _ in brute.lines(list(texts.items()))}
    assert {r["doc_id"]: r["text"] for r in lined.collect()} == want
    single = stages["near_duplicates"](spark, docs.unionByName(docs.limit(3)), odd_tables)
    roots = brute.groups({i: brute.fingerprint(t) for i, t in texts.items()})
    assert single.columns == columns
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(roots.values()))
    items = [(r[0], r[1]) for r in read(f"{odd_tables}/benchmark.parquet").select(
        "item_id", "text").collect()]
    clean = stages["decontamination"](spark, docs, odd_tables)
    dirty = brute.contamination(texts, [(str(i), t) for i, t in items])
    assert clean.columns == columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i in texts if not dirty[i][1]}
    rows = corpus_pipeline.run(spark, odd_tables)
    assert rows.count() and {"doc_id", "ids"} <= set(rows.columns)


def test_pipeline_of_nothing(spark, write):
    assert corpus_pipeline.run(spark, write()).collect() == []


def test_a_partition_gives_arrow_memory_back(monkeypatch):
    """Reused Python workers kept the pool's freed buffers between tasks and stages."""
    import pyarrow as pa

    from tripmill.llm import common

    pool = pa.default_memory_pool()
    calls = []

    class Spy:
        def release_unused(self):
            calls.append(True)
            pool.release_unused()

    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: Spy())
    batch = pa.RecordBatch.from_pydict({"x": list(range(1000))})
    run = common.released(lambda batches: (b.slice(0, 10) for b in batches))
    out = list(run(iter([batch, batch])))
    assert [b.num_rows for b in out] == [10, 10] and calls == [True]
