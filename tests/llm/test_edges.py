"""Every operator and pipeline stage on awkward tables: nulls, empty and long texts, ties, repeats, clashing names."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from verigrid.llm import ann, jaccard, licenses, mixing, packing, quality, secrets, suffix_dedup, token_files, url_filter
from verigrid.session import work_dir

real_stage, merged = suffix_dedup.stage, suffix_dedup.merged_intervals

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, spans string, kept string, n_bytes int"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
ROWS = [
    (1, "one two three four five six seven", "en", "a"), (2, "one two three four five six seven", "en", "b"),
    (2, "one two three four five six seven", "en", "b"), (3, None, None, None), (4, "", "en", "a"), (5, " \n\t ", "en", "a"),
    (6, LONG, "en", "a"), (7, "few words", "de", None), (8, "Ünïcode 😀 text password = abcdef123", "en", "c"), (None, "no id here at all", "en", "a"),
]
STAGED = [f for _, f in corpus_pipeline.STAGES]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, 9, "x", "y", 3) for r in ROWS], SCHEMA)


def pages(spark, n):
    return spark.createDataFrame([(1, None, "h"), (2, "", "p"), (2, "", "p"), (3, "x", None)][:n], "page_id bigint, url string, host string")


def vectors(spark, n):
    rows = [(i, [float(i), 1.0, 0.0], 1.0) for i in range(30)] + [(100, None, 1.0), (101, [0.0, 0.0, 0.0], 1.0), (102, [1.0, None, 2.0], 1.0)]
    rows += [(103, [float("nan"), 1.0, 1.0], 0.0), (104, [1.0], 0.0), (None, [1.0, 1.0, 1.0], 0.0), (5, [5.0, 1.0, 0.0], 2.0)]
    return spark.createDataFrame(rows[:n], "vec_id bigint, embedding array<float>, score double")


def tokens(docs, folder):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.read_documents(token_files.write_tokens(docs, folder, path, 50_257, 2))


@pytest.mark.parametrize("empty", [False, True])
def test_operators_keep_a_row_per_row(spark, docs, empty):
    docs = docs.limit(0) if empty else docs
    n = 0 if empty else len(ROWS)
    folder = token_files.new_folder(work_dir(spark))
    found = [tokens(docs, folder), suffix_dedup.remove(docs), licenses.scan(docs), jaccard.join(docs), secrets.scan(docs), quality.judge(docs, None)]
    found.append(mixing.mix(docs.drop("size")))
    for df in found:
        assert df.count() == n, df.columns
    assert url_filter.judge_urls(pages(spark, n)).count() == min(n, 4)
    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.pack(docs, path, 1).agg(F.sum(F.when(F.col("start") == 0, 1))).first()[0] == (n or None)


@pytest.mark.parametrize("empty", [False, True])
def test_stages(spark, docs, empty, tmp_path):
    spark.createDataFrame([(1, 1, 0), (6, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = docs.limit(0) if empty else docs
    for stage in STAGED:
        out = stage(spark, docs, str(tmp_path))
        assert stage is STAGED[-1] or out.columns == docs.columns
        assert (out.count() == 0) == empty
    assert corpus_pipeline.near_duplicates(spark, docs, "").filter("doc_id = 2").count() == 0


@pytest.mark.parametrize("parts", [1, 3, 5])
def test_an_id_with_two_texts_loses_no_link(spark, parts):
    words = [f"w{i}" for i in range(60)]
    one, other = " ".join(words), " ".join(reversed(words))
    rows = [(1, one + " x"), (2, one), (2, other), (3, other + " y"), (4, "alone"), (5, ""), (5, other + " z"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    found = sorted(tuple(r) for r in jaccard.join(docs).select("doc_id", "component_id").collect())
    assert found == [(1, 1), (2, 1), (2, 1), (3, 1), (4, 4), (5, 1), (5, 1), (6, 6)]
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == [1, 4, 6]


def components_of(texts):
    """Smallest reachable index per text, by comparing every pair of five-word shingle sets."""
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in texts]
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((label[a], label[b]))
                label = [low if v == high else v for v in label]
    return dict(enumerate(label))


def jaccard_components(spark, texts):
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id bigint, text string")
    return {r.doc_id: r.component_id for r in jaccard.join(docs).collect()}


def test_a_crowd_of_near_copies_is_one_component(spark):
    rng = np.random.default_rng(13)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(160):
        words = list(base)
        for at in rng.choice(120, 3, replace=False):
            words[at] = f"v{i}x{at}"
        texts.append(words)
    assert jaccard_components(spark, texts) == components_of(texts)


def test_groups_whose_leaders_are_far_are_linked_by_their_members(spark):
    """Each text drops words at one end of a window that drifts, and groups share a passage without being similar."""
    rng = np.random.default_rng(4)
    texts = []
    for _ in range(12):
        words = [f"w{i}" for i in rng.permutation(400)]
        first = int(rng.integers(100))
        for _ in range(int(rng.integers(2, 9))):
            first = max(0, min(260, first + int(rng.integers(-16, 17))))
            texts.append(words[first : first + int(rng.integers(100, 130))])
    passage = [f"p{i}" for i in range(60)]
    crowd = [f"c{i}" for i in range(60)]
    for i in range(30):  # near copies that hold the passage
        texts.append(passage + crowd[: 50 + i % 10] + [f"end{i}"])
    for i in range(30):  # others that hold it too
        texts.append(passage + [f"other{i}x{k}" for k in range(int(rng.integers(8, 60)))])
    texts = [texts[i] for i in rng.permutation(len(texts))]
    want = components_of(texts)
    assert len(set(want.values())) > 20
    assert jaccard_components(spark, texts) == want


def test_neighbours(spark):
    found = ann.search(vectors(spark, 40), F.col("vec_id") % 5 == 0, k=3)
    rows = {(r.query_id, r.rank): (r.vec_id, r.score) for r in found.collect()}
    assert rows[(5, 1)][0] in (4, 6) and {q for q, _ in rows} == {0, 5, 10, 15, 20, 25}
    assert rows[(10, 1)] == (9, 1.0) and rows[(10, 2)] == (11, 1.0)
    assert ann.search(vectors(spark, 2), F.lit(True)).count() == 2
    assert ann.search(vectors(spark, 0) if False else vectors(spark, 40).limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("copies", [9, 10, 11, 50, 1000])
@pytest.mark.parametrize("size", [32, 64, 128])
def test_all_copies_of_a_query_are_found(copies, size):
    rows = np.random.default_rng(copies).standard_normal((4000, size))
    query = rows[0].copy()
    rows[:: 4000 // copies][:copies] = query
    same = np.flatnonzero((rows == query).all(axis=1))
    found = ann.Chunk(np.arange(4000), rows).search(query, -1, 10)
    assert len(found) == 10
    near = [int(i) for i in same[:10]]
    assert [v for v, _ in found][: len(near)] == near and all(s == 0 for _, s in found[: len(near)])


def test_removed_intervals_travel_by_slot_and_meet_once_per_document(spark, monkeypatch):
    rng = np.random.default_rng(5)
    words = [f"v{i:x}" for i in rng.integers(0, 1 << 30, 4_000)]
    texts = {}
    for i in range(40):
        at = int(rng.integers(0, 3_000))
        own = " ".join(f"u{j:x}" for j in rng.integers(0, 1 << 30, 5))
        texts[(i * 7919) % 1009 - 200] = f"{own} {' '.join(words[at : at + 600])} {own} {' '.join(words[at // 2 : at // 2 + 90])}é"
    texts[2000] = texts[2001] = f"copied {' '.join(words[:50])}"
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    labels, made = [], []
    monkeypatch.setattr(suffix_dedup, "stage", lambda df, label: labels.append(label) or real_stage(df, label))
    monkeypatch.setattr(suffix_dedup, "merged_intervals", lambda *a: made.append(a) or merged(*a))
    found = {r["doc_id"]: r for r in suffix_dedup.remove(df, size=100_000).collect()}
    seen = set()
    for doc_id in sorted(texts):
        data = texts[doc_id].encode()
        strings = [data[p : p + 50] for p in range(len(data) - 49)]
        covered = np.zeros(len(data) + 1, bool)
        for p, s in enumerate(strings):
            covered[p : p + 50] |= s in seen
        seen.update(strings)
        spans = int((covered[:-1] & ~np.concatenate([[False], covered[:-2]])).sum())
        kept = bytes(b for b, c in zip(data, covered, strict=False) if not c)
        r = found[doc_id]
        assert (r["n_removed"], r["n_spans"], r["kept_sha256"]) == (int(covered.sum()), spans, hashlib.sha256(kept).hexdigest())
    assert labels == ["bytes", "intervals"]  # the runs are not written as a table of their own
    (runs, length, seed, parts), = made
    sent = suffix_dedup.packed_intervals(runs, length, seed, parts)
    assert 0 < sent.count() <= parts * parts
    per_document = merged(runs, length, seed, parts).groupBy("doc_id").count()
    assert per_document.count() > 20 and per_document.filter("count > 1").count() == 0
    # the same intervals if a task gives them on many times
    often = suffix_dedup.packed_intervals(runs, length, seed, parts, most=1).collect()
    once = sent.collect()
    assert len(often) > len(once) and intervals_of(often) == intervals_of(once)


def intervals_of(packed):
    parts = [suffix_dedup.unpack_intervals(bytes(r["cuts"])) for r in packed]
    return [x.tolist() for x in suffix_dedup.united(*map(np.concatenate, zip(*parts, strict=True)))]


def test_united_intervals():
    docs, starts, ends = np.array([7, -3, 7, 7, -3, 8]), np.array([10, 0, 0, 15, 90, 1]), np.array([20, 50, 10, 17, 95, 2])
    want = [[-3, -3, 7, 8], [0, 90, 0, 1], [50, 95, 20, 2]]
    found = suffix_dedup.united(docs, starts, ends)
    assert [x.tolist() for x in found] == want
    assert [x.tolist() for x in suffix_dedup.unpack_intervals(suffix_dedup.pack_intervals(*found))] == want
    assert [r for b in suffix_dedup.by_document(docs, starts, ends, rows=2) for r in b.to_pylist()] == [
        {"doc_id": -3, "starts": [0, 90], "ends": [50, 95]}, {"doc_id": 7, "starts": [0], "ends": [20]}, {"doc_id": 8, "starts": [1], "ends": [2]},
    ]
