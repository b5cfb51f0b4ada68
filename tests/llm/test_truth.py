"""The registered queries against brute force, round trips and held-out accuracy."""

import hashlib
import itertools
import re
import zlib

import duckdb
import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
import verify
from verigrid.llm import licenses, packing, quality, secrets, token_files
from verigrid.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def rows(spark, name):
    return QUERIES[name](spark, FOLDER).collect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    duck = duckdb.connect()
    for table in verify.TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    note, _, good = verify.compare(spark, duck, name, FOLDER)
    assert good, note


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, docs):
    library, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    found = {r["doc_id"]: r for r in rows(spark, "op1_token_files")}
    for doc_id in sorted(docs):
        ids = library.encode(docs[doc_id], add_special_tokens=False).ids + [2]
        assert (found[doc_id]["start"], found[doc_id]["n_tokens"], found[doc_id]["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)


def test_shard_sequences_and_masks(tmp_path):
    import pyarrow as pa

    writer = token_files.ShardWriter(f"{tmp_path}/s.arrow", pa.uint16(), 4, 2)
    writer.write(pa.array([1, 2]), np.arange(10), np.array([3, 7]))
    writer.close()
    reader = token_files.ShardReader(f"{tmp_path}/s.arrow")
    assert reader.row(1)[0].tolist() == [4, 5, 6, 7] and reader.row(2)[1].tolist() == [True, True, False, False]
    assert reader.run(3, 7).tolist() == list(range(3, 10)) and not reader.row(0)[0].flags.owndata


def test_packing(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: library.encode(t, add_special_tokens=False).ids + [1] for i, t in docs.items()}
    found, fill = rows(spark, "op8_packing"), {}
    for r in found:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and r["ids_crc32"] == crc(part) and r["doc_tokens"] == len(ids[r["doc_id"]])
        fill.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["length"] for r in found) == sum(map(len, ids.values()))
    for pieces in fill.values():
        ends = list(itertools.accumulate(n for _, n in sorted(pieces)))
        assert [o for o, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 2048 and ends[-1].bit_count() == 1


def test_best_fit_takes_the_tightest_window():
    assert packing.best_fit_decreasing([6, 5, 4, 3, 2], 10) == [[0, 2], [1, 3, 4]]


def test_suffix_dedup(spark, docs):
    found, seen = {r["doc_id"]: r for r in rows(spark, "op2_suffix_dedup")}, set()
    for doc_id in sorted(docs):
        data = docs[doc_id].encode()
        strings = [data[p : p + 50] for p in range(len(data) - 49)]
        covered = np.zeros(len(data) + 1, bool)
        for p, s in enumerate(strings):
            covered[p : p + 50] |= s in seen
        seen.update(strings)
        spans = int((covered[:-1] & ~np.concatenate([[False], covered[:-2]])).sum()) if data else 0
        kept = bytes(b for b, c in zip(data, covered, strict=False) if not c)
        want = (len(data), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest())
        r = found[doc_id]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want


def shingle_sets(docs):
    words = {i: t.encode().lower().split() for i, t in docs.items()}
    return {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}


def test_jaccard_join(spark, docs):
    sets = shingle_sets(docs)
    label = {i: i for i in docs}
    for a, b in itertools.combinations(sorted(docs), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((label[a], label[b]))
            label = {i: low if v == high else v for i, v in label.items()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows(spark, "op4_jaccard_join")}
    assert got == {i: (len(sets[i]), label[i]) for i in docs}


def test_secret_base_spans(spark, docs):
    assign = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for r in rows(spark, "op6_secret_scan"):
        text = docs[r["doc_id"]]
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m.group(1)) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
        told = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert hashlib.sha256(told.encode()).hexdigest() == r["base_sha256"]


def test_random_runs_and_words(spark):
    rng = np.random.default_rng(3)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    keys = ["".join(rng.choice(letters, 48)) for _ in range(40)]
    plain = ["thequickbrownfoxjumpsoverthelazydog and more", "Internationalisierungsmassnahmen", "zzzzzzzzzzzzzzzzzzzzzzzz1Z"]
    df = spark.createDataFrame(list(enumerate([f"see {k} here" for k in keys] + plain)), "doc_id bigint, text string")
    found = {r["doc_id"]: r["n"] for r in secrets.scan(df).selectExpr("doc_id", "size(spans) AS n").collect()}
    assert sum(found[i] for i in range(40)) >= 36 and not any(found[i] for i in range(40, 43))
    redacted = secrets.redact(spark.createDataFrame([(1, "é password=abcdef1 z")], "doc_id bigint, text string"))
    assert redacted.first()["text"] == "é [secret] z"


LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def test_keys_of_every_encoding_are_found(spark):
    rng = np.random.default_rng(11)
    draw = lambda letters, n: "".join(rng.choice(list(letters), n))
    alphabets = [DIGITS + LOWER, DIGITS + UPPER, LOWER + "234567", UPPER + "234567", LOWER, UPPER, LOWER + UPPER, LOWER + UPPER + DIGITS]
    keys = [draw(a, 64) for a in alphabets for _ in range(5)]
    keys += ["-".join(draw("0123456789abcdef", n) for n in (8, 4, 4, 4, 12)) for _ in range(5)]
    df = spark.createDataFrame([(i, f"see {k} here") for i, k in enumerate(keys)], "doc_id bigint, text string")
    found = {r["doc_id"]: r["n"] for r in secrets.scan(df).selectExpr("doc_id", "size(spans) AS n").collect()}
    assert all(sum(found[i] for i in range(a, a + 5)) >= 4 for a in range(0, len(keys), 5))
    assert "[secret]" in secrets.redact(df).filter("doc_id = 0").first()["text"]


def test_rare_short_keys_are_found(spark):
    rng = np.random.default_rng(5)
    letters, words = list(LOWER + UPPER + DIGITS), ["user", "account", "handler", "default", "session", "message", "index", "value", "order", "parse"]
    names = ["".join(w.title() for w in rng.choice(words, 3)) + str(rng.integers(10, 99)) for _ in range(2500)]
    names += ["-".join(rng.choice(words, 4)) + "-" + str(rng.integers(2000, 2030)) for _ in range(2500)]
    keys = ["".join(rng.choice(letters, 20)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate([*keys, *names])), "doc_id bigint, text string")
    found = {r["doc_id"]: r["n"] for r in secrets.scan(df).selectExpr("doc_id", "size(spans) AS n").collect()}
    assert sum(found[i] for i in range(20)) >= 15
    assert sum(found[i] for i in range(20, len(found))) <= 2


def test_licenses(spark):
    mit = licenses.TEMPLATES["mit"].split()
    texts = ["x y z " * 40 + " ".join(mit) + " q" * 50, " ".join(mit[: len(mit) // 2]), "word " * 9 + "Released under the MIT License.", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r["doc_id"]: r["licenses"] for r in licenses.scan(df).collect()} == {0: "mit", 1: "", 2: "mit-line", 3: ""}


def test_base_quality_counts(spark, docs):
    for r in rows(spark, "op7_quality_rules"):
        text = docs[r["doc_id"]]
        words = text.encode().split()
        windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        repeated = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(5)} if len(words) < 3000 else None
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert r["n_words"] == len(words) and r["word_chars"] == sum(len(w.decode()) for w in words)
        assert r["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text)) and r["n_dup_lines"] == len(lines) - len(set(lines))
        if repeated is not None:
            assert r["n_repeat_words"] == len(repeated)
            assert r["base_failed"] == (len(words) < 10 or 100 * len(repeated) > 20 * len(words))
        assert not (r["kept"] and r["base_failed"])


def test_trees_hold_out_and_monotonic(spark):
    folder = "/root/testdata/sf0.1"
    table = {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels")}
    trees = quality.fit(table["documents"], table["labels"].filter("doc_id % 2 = 0"))
    held = quality.judge(table["documents"], trees).join(table["labels"].filter("doc_id % 2 = 1"), "doc_id").filter("NOT base_failed")
    right = held.selectExpr("avg(CAST((score >= 0.5) = (quality = 1) AS INT)) AS r").first()["r"]
    assert right > 0.95
    x = np.random.default_rng(1).random((200, len(quality.FEATURES))) * 3
    for f, way in enumerate(quality.FEATURES.values()):
        if way:
            more = x.copy()
            more[:, f] += 0.3
            assert (way * (trees.score(more) - trees.score(x)) >= -1e-12).all()


def test_neighbours(spark):
    folder = "/root/testdata/sf0.1"
    data = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas().dropna(subset=["embedding"])
    x, ids = np.stack(data["embedding"]).astype(float), data["vec_id"].to_numpy()
    got, hits = {}, 0
    for r in QUERIES["op9_nearest_neighbours"](spark, folder).collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    asked = np.flatnonzero(ids % 100 == 0)
    for i in asked:
        away = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        away[i] = np.inf
        best = set(ids[np.lexsort((ids, away))[:10]].tolist())
        hits += len(best & set(got[ids[i]]))
        assert all(abs(away[np.flatnonzero(ids == v)[0]] - s) < 1e-9 for v, s in got[ids[i]].items())
    assert hits >= 9 * len(asked)


def test_mix_is_near_its_targets(spark):
    folder = "/root/testdata/sf0.1"
    mixed = QUERIES["op10_mixing"](spark, folder).groupBy("source_size", "target").sum("taken").collect()
    assert all(abs(r["sum(taken)"] - r["target"]) <= 0.02 * r["target"] for r in mixed)


def test_pipeline_matches_plain_steps(spark, docs):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, table, FOLDER).collect()}
    assert kept == {r["doc_id"] for r in rows(spark, "op7_quality_rules") if r["kept"]}
    one = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, table, FOLDER).collect()}
    assert one == {r["doc_id"] for r in rows(spark, "op4_jaccard_join") if r["component_id"] == r["doc_id"]}
    mixed = {r["doc_id"]: r["count"] for r in corpus_pipeline.source_mix(spark, table, FOLDER).groupBy("doc_id").count().collect()}
    assert all(mixed.get(r["doc_id"], 0) * r["size"] == r["taken"] for r in rows(spark, "op10_mixing"))
    out = corpus_pipeline.run(spark, FOLDER).collect()
    assert out and {r["doc_id"] for r in out} <= kept & set(docs)


@pytest.mark.parametrize(("name", "spaced"), [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_word_encoder_gives_the_ids_of_whole_texts(name, spaced):
    from tokenizers import Tokenizer

    from verigrid.llm.tokens import WordEncoder

    texts = [
        "HELLO, World! ok", "K ABC, é, É. é", "a.. x!? y&&& ###z", "don't, it's. Don't;", "  two  blanks, here. ",
        "", "s, 's 'll ,'s", "straße, À×÷ÿ.", "<|endoftext|> a.", "(252) 555-5573 ab1c", "a­ b ª µ,", "tab\tand\nline\r\n x",
    ]
    library = Tokenizer.from_file(public_tokenizers.path(name))
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    words = WordEncoder(public_tokenizers.path(name), spaced)
    for _ in range(2):
        ids, counts = words.encode(texts)
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_words_around_line_ends_are_learnt_once():
    from tokenizers import Tokenizer

    from verigrid.llm.tokens import WordEncoder

    path = public_tokenizers.path("byte_bpe_50k.json")
    heads, tails = [f"so{c}ne." for c in "bcdfgh"], [f"Wé{c}lt" for c in "bcdfgh"]
    texts = [f"x {a}\n{b} y" for a in heads for b in tails]
    words = WordEncoder(path, True)
    texts += ["", "\n", "\n\n", "\n\n\n", "\na", "a\n", "a\n\n\nb c", "a\n\nb 1\n2", "don\n't 'll\n'll", "é\n.\n\u65e5\u672c 12\nx!", " a\nb", "a \nb", "a\n b"]
    library = Tokenizer.from_file(path)
    want = [library.encode(text, add_special_tokens=False).ids for text in texts]
    words.encode(texts[:36])
    assert len(words.known) == 2 + len(heads) + len(tails)
    for _ in range(2):
        ids, counts = words.encode(texts)
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_words_of_an_aged_table_keep_their_ids():
    from tokenizers import Tokenizer

    from verigrid.llm.tokens import WordEncoder

    for name, spaced in (("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)):
        library, words = Tokenizer.from_file(public_tokenizers.path(name)), WordEncoder(public_tokenizers.path(name), spaced, most=5)
        for k in range(12):
            text = " ".join(f"word{i}ed, it's\nNew{i % 3}" for i in range(k, k + 4))
            assert words.encode([text, ""])[0].tolist() == library.encode(text, add_special_tokens=False).ids
