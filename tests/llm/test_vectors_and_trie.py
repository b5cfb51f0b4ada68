"""Hard negatives, near-duplicate vectors and the conversation trie against brute force and on awkward tables."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from verigrid.llm import hard_negatives, prefix_trie, vector_dedup

FOLDER = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, label int, row string, score string, class string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if x is None else [None if c is None else float(c) for c in x], label, "r", "s", "c") for i, x, label in rows], VECTORS)


def test_bit_planes_and_lookups_give_inner_products():
    rng = np.random.default_rng(2)
    for size, top in ((1, 3), (8, 200), (13, 1 << 20)):
        x, y = rng.integers(-top, top, (300, size)), rng.integers(-top, top, (7, size))
        bits = int(top).bit_length() + 1
        planes = hard_negatives.pack_planes(x, bits)
        assert (hard_negatives.unpack_planes(planes)[:, :size] == x).all()
        other = hard_negatives.unpack_planes(hard_negatives.pack_planes(y, bits))
        assert (hard_negatives.scores(planes, hard_negatives.subset_sums(other, np.int64)) == x @ y.T).all()


def mined(rows, every):
    rows = [(i, np.floor(256 * np.array(x, np.float32).astype(float)).astype(int), label) for i, x, label in rows]
    out = []
    for a, x, label in {r[0]: r for r in rows if r[0] % every == 0}.values():
        ranked = sorted(((-int(x @ y), i, m == label) for i, y, m in rows if i != a))
        for p, positive, _ in [r for r in ranked if r[2]][:5]:
            fits = [r for r in ranked if not r[2] and 50 * -p <= 100 * -r[0] <= 95 * -p][:3]
            out += [(a, positive, k + 1, n, -p, -s) for k, (s, n, _) in enumerate(fits)]
    return sorted(out)


def test_hard_negatives_equal_brute_force_in_any_blocks(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-4, 5, 12) / 8, int(rng.integers(3)) if i % 3 else 0) for i in range(240)]
    rows += [(7, rows[7][1], rows[7][2]), (10, rows[10][1], rows[10][2])]  # repeated rows are candidates each
    want = mined(rows, 10)
    for size, block in ((2048, 512), (50, 4)):
        got = hard_negatives.mine(frame(spark, rows), F.col("vec_id") % 10 == 0, rows=size, block=block)
        assert sorted(map(tuple, got.collect())) == want and want


def test_hard_negatives_of_awkward_tables(spark):
    rows = [(0, [1, 2], 1), (1, [1, 2], 1), (2, [1, 1], 2), (3, None, 1), (4, [None, 1], 1), (5, [float("nan"), 1], 2), (6, [1, 2], None), (8, [1], 2), (None, [1, 2], 2), (9, [0, 0], 2)]
    got = hard_negatives.mine(frame(spark, rows), F.col("vec_id") == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 2, 5 * 65536, 3 * 65536)]
    assert hard_negatives.mine(frame(spark, rows[:2]), F.lit(True)).count() == 0
    assert hard_negatives.mine(frame(spark, rows).limit(0), F.lit(True)).count() == 0
    with pytest.raises(ValueError):
        hard_negatives.mine(frame(spark, [(0, [1e30, 1], 1)]), F.lit(True))


def grouped(ids, x, least=0.9):
    good = np.array([v is not None for v in x])
    links, label = dict.fromkeys(ids, 0), {i: i for i in ids}
    y = np.array([v for v in x if v is not None], float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    at = np.array(ids)[good]
    linked = y @ y.T >= least
    np.fill_diagonal(linked, False)
    links |= dict(zip(at.tolist(), linked.sum(axis=1).tolist(), strict=True))
    for a, b in np.argwhere(linked).tolist():
        low, high = sorted((label[at[a]], label[at[b]]))
        label = {i: low if v == high else v for i, v in label.items()} if low != high else label
    return {i: (links[i], label[i], label[i] == i) for i in ids}


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicate_vectors_equal_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((300, 24))
    noise = lambda n, size: size * rng.standard_normal((n, 24))
    tight, loose = base[0] + noise(150, 0.05), base[1] + noise(80, 0.24)
    chain = [base[2]]
    for _ in range(30):
        chain.append(chain[-1] + 0.4 * rng.standard_normal(24))
    x = np.concatenate([base, tight, loose, chain, base[:40], 3 * base[5:9]])
    ids = rng.permutation(len(x)).tolist()
    df = frame(spark, [(i, v, None) for i, v in zip(ids, x.astype(np.float32), strict=True)])
    want = grouped(ids, list(x.astype(np.float32)))
    for chunk in (2048, 40):
        got = {r[0]: tuple(r)[1:] for r in vector_dedup.groups(df, chunk=chunk).collect()}
        wrong = [i for i in ids if got[i] != want[i]]
        assert len(wrong) <= 0.002 * len(ids), [(got[i], want[i]) for i in wrong[:5]]


def test_near_duplicates_of_awkward_tables(spark):
    rows = [(5, [1, 0], 1), (3, [2, 0], 1), (3, [0, 1], 1), (4, [0, 1], 1), (6, None, 1), (7, [0, 0], 1), (8, [None, 1], 1), (9, [float("inf"), 1], 1), (2, [1], 1), (None, [1, 0], 1), (1, [-1, 0], 1), (1, [-1, 0], 1)]
    got = sorted(map(tuple, vector_dedup.groups(frame(spark, rows)).collect()), key=str)
    alone = [(i, 0, i, True) for i in (2, 6, 7, 8, 9)] + [(None, 0, None, True)]
    # the two vectors of id 3 tie both groups together
    want = [(3, 1, 3, True), (3, 1, 3, True), (4, 1, 3, False), (5, 1, 3, False), (1, 1, 1, True), (1, 1, 1, True)]
    assert got == sorted(want + alone, key=str)
    assert vector_dedup.groups(frame(spark, rows).limit(0)).count() == 0
    assert vector_dedup.groups(frame(spark, rows[4:6])).count() == 2


def trie(rows):
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            conv[c].append((turn is not None, turn or 0, role or "", text or ""))
    conv = {c: [t[2:] for t in sorted(v, key=lambda t: t[:3])] for c, v in conv.items()}
    whole, members, children = {}, defaultdict(list), defaultdict(int)
    for c, turns in conv.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = (*conv.get(c - c % 20, [])[:h], *turns[h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = leaves[p] or 1
        saved[p] += (len(members[p]) - 1) * len(p[-1][1].encode().split()) if p else 0
        if p:
            children[p[:-1]] += 1
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    ends = lambda p: ",".join(str(c) for c in sorted(members[p]) if len(whole[c]) == len(p))
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends(p).encode()).hexdigest()) for p, m in members.items()), key=str)


TURNS = "conv_id bigint, turn int, role string, text string, depth string, rank string, words string, a string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "a") for r in rows], TURNS)


@pytest.mark.parametrize(("least", "most"), [(1000, 200_000), (3, 2)])
def test_trie_equals_brute_force_in_any_shards(spark, least, most):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rng = np.random.default_rng(6)
    rows += [(100 + c, t, "u", f"word {rng.integers(2)} é") for c in range(90) for t in range(int(rng.integers(1, 7)))]
    rows += [(300, t, "u", f"long talk {t % 7}") for t in range(400)] + [(1000 + c, t, None, None) for c in range(50) for t in range(3)]
    got = prefix_trie.conversation_trie(turns(spark, rows), least, most)
    assert sorted(map(tuple, got.collect()), key=str) == trie(rows)


def test_trie_of_awkward_tables(spark):
    rows = [(5, None, "b", "last of null turns"), (5, None, None, None), (5, 1, "a", "x"), (5, 1, "a", "x"), (None, 1, "a", "x"), (20, 0, "u", ""), (21, 3, "u", "only one"), (25, 0, "u", "A"), (25, 0, "s", "B"), (7, 1, "u", "w " * 9000)]
    assert sorted(map(tuple, prefix_trie.conversation_trie(turns(spark, rows)).collect()), key=str) == trie(rows)
    assert prefix_trie.conversation_trie(turns(spark, rows).limit(0)).count() == 0
    assert prefix_trie.conversation_trie(turns(spark, rows[:1])).count() == len(trie(rows[:1]))


def test_queue_gives_everything_in_order_whatever_it_spills():
    rng, queue = np.random.default_rng(9), prefix_trie.SpillingQueue(2, 5)
    held, out, want = [], [], []
    for k in range(400):
        item = (int(rng.integers(1000)), k)
        queue.push(item)
        held.append(item)
        if k % 3 == 2:
            out.append(queue.pop())
            want.append(held.pop(held.index(min(held))))
    assert out == want and queue.spilled and queue.first() == min(held)
    assert [queue.pop() for _ in range(len(held))] == sorted(held) and queue.first() is None
