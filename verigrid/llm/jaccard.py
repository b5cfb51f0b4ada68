"""N-gram Jaccard join: documents linked by similar shingle sets, with set relations used to skip work.

* Equal sets are one class; only a class's smallest document goes on.
* Index lists are built over set prefixes (a quarter of a set) in one global order of shingles,
  frequent ones last. A posting holds the position in its set and the set's size.
* A list's first set is its leader. Sets are verified against leaders first; what is similar to a
  leader joins its component. The other lists' answers then follow from that: members of one
  component are skipped as a block, so a large group of near copies costs a star, not all pairs.
* In what is left a component is one block of a list, with the range of its sizes and positions; blocks
  that cannot reach the overlap are skipped. Of blocks that meet only the leaders are compared, and their
  members' answers follow from the leaders' overlap and what each member has beside its leader; members
  are paired, by size and position, only where that bound leaves them.

Components are exact up to collisions of 64-bit shingle hashes inside a pair of sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verigrid.llm.common import begin_without_tables, give_back, parts, stage, texts_of
from verigrid.llm.graph import components

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
POSTING = "token bigint, c1 bigint, c2 bigint, n int, pos int"


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str, width: int, hashes: WordHashes) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending; A-Z are lower-cased, nothing else."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, h.size)
    n = h.size - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total += _mixed(h[k : k + n] * _FACTORS[k % 5] + np.uint64(k))
    return np.unique(_mixed(total))


def class_of(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), np.int64).tolist())


def least_overlap(a: Column, b: Column, percent: int) -> Column:
    """Shared shingles that two sizes need: 100 * o >= percent * (a + b - o)."""
    return F.ceil(F.lit(percent) * (a + b) / F.lit(100.0 + percent)).cast("int")


def prefix_length(n: int, percent: int) -> int:
    """Positions of which any similar pair shares at least one shingle."""
    return n - -(-percent * n // 100) + 1


def repeated(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Values found twice or more, ascending, and how often; the list is emptied, so it is not held beside its copy."""
    tokens = np.concatenate(held)
    held.clear()
    tokens.sort()
    same = np.concatenate([[False], tokens[1:] == tokens[:-1], [False]])
    first = np.flatnonzero(same[1:] & ~same[:-1])
    return tokens[first], (np.flatnonzero(same[:-1] & ~same[1:]) - first + 1).astype(np.int32)


def sets_and_counts(docs: DataFrame, width: int, block: int) -> DataFrame:
    """Per document its set's size and class; per block of documents the shingles of two sets or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_without_tables()
        hashes, held, seen, size = WordHashes(), [], set(), 0
        names = ["doc_id", "n", "c1", "c2", "token", "found"]
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32()]

        def rows(columns: list) -> pa.RecordBatch:
            n = max(len(c) for c in columns if c is not None)
            arrays = [pa.nulls(n, k) if c is None else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        def counted() -> pa.RecordBatch:
            tokens, found = repeated(held)
            return rows([None, None, None, None, tokens.view(np.int64), found])

        for batch in parts(batches):
            out = []
            for text in texts_of(batch):
                tokens = shingle_set(text, width, hashes)
                key = class_of(tokens)
                out.append((tokens.size, *key))
                if key not in seen:
                    seen.add(key)
                    held.append(tokens)
                    size += tokens.size
                if size > block:
                    yield counted()
                    seen, size = set(), 0
            yield rows([batch.column(0), *zip(*out, strict=True), None, None])
        if held:
            yield counted()
        hashes, held, seen = WordHashes(), [], set()
        give_back()

    return docs.mapInArrow(run, "doc_id bigint, n int, c1 bigint, c2 bigint, token bigint, found int")


def prefixes(docs: DataFrame, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Postings of every document's prefix; equal sets of a batch post once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_without_tables()
        hashes = WordHashes()
        for batch in batches:
            seen = set()
            for part in parts([batch]):
                sets = []
                for text in texts_of(part):
                    tokens = shingle_set(text, width, hashes)
                    key = class_of(tokens)
                    if not tokens.size or key in seen:
                        continue
                    seen.add(key)
                    length = prefix_length(tokens.size, percent)
                    if frequent.size:
                        at = np.minimum(np.searchsorted(frequent, tokens), frequent.size - 1)
                        often = frequent[at] == tokens
                        tokens = np.concatenate([tokens[~often], tokens[often]])
                    sets.append((tokens[:length].copy(), *key, tokens.size))
                if sets:
                    lengths = [len(p[0]) for p in sets]
                    tokens = np.concatenate([p[0] for p in sets]).view(np.int64)
                    columns = [tokens, *[np.repeat(np.array([p[k] for p in sets], np.int64), lengths) for k in (1, 2)]]
                    columns.append(np.repeat(np.array([p[3] for p in sets], np.int32), lengths))
                    columns.append(np.concatenate([np.arange(n, dtype=np.int32) for n in lengths]))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "c1", "c2", "n", "pos"])
        hashes, sets, seen = WordHashes(), [], set()
        give_back()

    return docs.select("text").mapInArrow(run, POSTING)


def shared_postings(postings: DataFrame) -> DataFrame:
    """Postings whose list holds two different classes or more, once per class.

    Lists are dealt by shingle and sorted, and stream past with one row held back.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.RecordBatch | None = None  # the first row of a list that may still end
        confirmed, last = None, None
        for batch in batches:
            table = pa.Table.from_batches([b for b in (waiting, batch) if b is not None]).combine_chunks()
            token, c1, c2 = (table.column(k).to_numpy() for k in range(3))
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])
            if waiting is None and last is not None and len(token):
                new[0] = (token[0], c1[0], c2[0]) != last
            rows = np.flatnonzero(new)
            waiting = None
            if not rows.size:
                continue
            token = token[rows]
            starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            sizes = np.diff(np.append(starts, token.size))
            keep = np.repeat(sizes > 1, sizes) | (token == confirmed if confirmed is not None else False)
            end = rows[-1]
            last = (token[-1], c1[end], c2[end])
            if keep[-1]:
                confirmed = token[-1]
            else:
                waiting = table.slice(int(end), 1).to_batches()[0]
            out = table.take(pa.array(rows[keep]))
            yield from out.to_batches()

    return postings.repartition("token").sortWithinPartitions("token", "c1", "c2").mapInArrow(run, POSTING)


def id_filter(ids: DataFrame, name: str, bits: int = 24) -> np.ndarray:
    """A bitmap over hashed ids, at most 2**bits bits whatever the number of ids."""
    slot = F.pmod(F.xxhash64(name), F.lit(1 << bits))
    words = ids.select(slot.alias("s")).groupBy(F.shiftright("s", 5).alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(s & 31 AS INT)))").alias("b")
    )
    table = words.toArrow()  # at most 2**(bits - 5) rows
    bitmap = np.zeros(1 << (bits - 5), np.uint32)
    bitmap[table.column("w").to_numpy()] = table.column("b").to_numpy().astype(np.uint32)
    return bitmap


def sets_of(docs: DataFrame, ids: DataFrame, width: int, bits: int = 24) -> DataFrame:
    """``doc_id`` and ``tokens`` (sorted, 8 bytes each) of the documents whose ids are wanted.

    A bitmap lets nearly all other documents stay where they are; a few more than wanted may come.
    """
    bitmap = id_filter(ids, "doc_id", bits)
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << bits)).alias("slot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_without_tables()
        hashes = WordHashes()
        for batch in parts(batches):
            slots = batch.column(2).to_numpy()
            rows = pa.array(np.flatnonzero(bitmap[slots >> 5] >> (slots & 31).astype(np.uint32) & 1))
            tokens = [shingle_set(t or "", width, hashes).tobytes() for t in batch.column(1).take(rows).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array(tokens, pa.binary())], ["doc_id", "tokens"])
        hashes, tokens = WordHashes(), []
        give_back()

    found = docs.select("doc_id", "text", slot).mapInArrow(run, "doc_id bigint, tokens binary")
    sets = stage(found, "pair-sets")
    repeated = sets.groupBy("doc_id").count().filter("count > 1").limit(1).count()
    return sets.dropDuplicates(["doc_id"]) if repeated else sets


def overlaps(pairs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``pairs`` (a, b, own) with ``both``, the shingles their whole sets share, the sizes na and nb, and what
    a holds beside b and b beside a (``xa``, ``xb``) where ``own`` is not null; ``xa`` only where it is false."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_without_tables()
        for batch in parts(batches):
            found, beside = [], ([], [])
            for x, y, own in zip(batch.column(3), batch.column(4), batch.column(2).to_pylist(), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                found.append((np.intersect1d(x, y, assume_unique=True).size, x.size, y.size))
                beside[0].append(np.setdiff1d(x, y, True).view(np.int64) if own is False else None)
                beside[1].append(None if own is None else np.setdiff1d(y, x, True).view(np.int64))
            counts = np.array(found, np.int64).reshape(-1, 3)
            columns = [*batch.columns[:3], *[pa.array(counts[:, k]) for k in range(3)]]
            columns += [pa.array(x, pa.list_(pa.int64())) for x in beside]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "own", "both", "na", "nb", "xa", "xb"])
        give_back()

    pairs = stage(pairs.select("a", "b", "own"), "pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    sets = sets_of(docs, ids, width)
    one, two = (sets.select(F.col("doc_id").alias(k), F.col("tokens").alias(f"t{k}")) for k in "ab")
    held = pairs.join(one, "a").join(two, "b").select("a", "b", "own", "ta", "tb")
    return stage(held.mapInArrow(run, "a bigint, b bigint, own boolean, both bigint, na bigint, nb bigint, xa array<bigint>, xb array<bigint>"), "overlaps")


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    return overlaps(pairs.withColumn("own", F.lit(None).cast("boolean")), docs, width).filter(_linked(percent)).select("a", "b")


def _linked(percent: int) -> Column:
    return 100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))


def enough(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b) that can still reach the overlap.

    Shingles that both sets share lie in both prefixes, where they are counted, or behind the prefix
    that ends first, or behind the last shared position.
    """
    per = pairs.groupBy("a", "b", "na", "nb").agg(
        F.count("*").alias("both"), F.max("pa").alias("pa"), F.max("pb").alias("pb")
    )
    behind = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - 1
    beyond = F.ceil(F.lit(percent) * F.greatest("na", "nb") / F.lit(100.0)).cast("int") - 1
    reach = F.col("both") + F.least(behind, beyond)
    return per.filter(reach >= least_overlap(F.col("na"), F.col("nb"), percent)).select("a", "b")


def leader_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Each list's members beside its smallest id, where sizes allow similarity."""
    first = lists.groupBy("token").agg(F.min_by(F.struct("doc_id", "n", "pos"), "doc_id").alias("l"))
    met = lists.join(first, "token").filter("doc_id <> l.doc_id")
    met = met.filter(100 * F.least("n", "l.n") >= percent * F.greatest("n", "l.n"))
    return met.selectExpr("l.doc_id as a", "doc_id as b", "l.n as na", "n as nb", "l.pos as pa", "pos as pb")


def met_blocks(lists: DataFrame, percent: int) -> DataFrame:
    """Components (a < b, by leaders) that meet in lists such that some members may be similar.

    A component's postings of a list are one block that tells the range of its sizes, its last position
    and the most that lies behind a position; blocks that cannot reach the overlap are skipped whole.
    ``sa`` and ``sb`` tell components of one set.
    """
    blocks = lists.groupBy("token", "comp").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("pos").alias("p"),
        F.max(F.col("n") - F.col("pos")).alias("r"), F.min("alone").alias("s"),
    )
    blocks = stage(blocks, "blocks")
    mixed = blocks.groupBy("token").count().filter("count > 1").select("token")
    blocks = stage(blocks.join(mixed, "token"), "mixed-blocks")
    a, b = (
        blocks.selectExpr("token", f"comp as {k}", f"lo as l{k}", f"hi as h{k}", f"p as p{k}", f"r as r{k}", f"s as s{k}")
        for k in "ab"
    )
    sizes = F.expr(f"a < b AND 100 * ha >= {percent} * lb AND 100 * hb >= {percent} * la")
    reach = F.least("pa", "pb") + F.least("ra", "rb")
    met = a.join(b, "token").filter(sizes & (reach >= least_overlap(F.col("la"), F.col("lb"), percent)))
    # a set alone shares every list it met in; a member of a group at least one of them
    per = met.groupBy("a", "b", "sa", "sb").agg(
        F.count("*").alias("both"), *[F.min(f"l{k}").alias(f"l{k}") for k in "ab"], *[F.max(f"h{k}").alias(f"h{k}") for k in "ab"],
        *[F.when(F.col(f"s{k}"), F.min(f"r{k}")).otherwise(F.max(f"r{k}")).alias(f"r{k}") for k in "ab"],
    )
    beyond = F.ceil(F.lit(percent) * F.greatest("ha", "hb") / F.lit(100.0)).cast("int") - 1
    most = F.col("both") + F.least(F.least("ra", "rb") - 1, beyond)
    return stage(per.filter(most >= least_overlap(F.col("la"), F.col("lb"), percent)).select("a", "b", "sa", "sb"), "met-components")


def member_pairs(lists: DataFrame, near: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of near components by their lists, as far as size and position leave them.

    Between two groups a member counts with its gain. A set alone meets only members that could do with
    what the set shares with their leader; the others are found by ``shared_differences``.
    """
    wanted = near.select(F.col("ca").alias("comp")).union(near.select("cb")).distinct()
    lists = lists.join(wanted, "comp").join(members.select("doc_id", "gain"), "doc_id", "left")
    lists = stage(lists.withColumn("gain", F.coalesce("gain", F.lit(-percent) * F.col("n").cast("bigint"))), "near-lists")
    a, b = (
        lists.selectExpr("token", f"doc_id as {k}", f"n as n{k}", f"pos as p{k}", f"comp as c{k}", f"gain as g{k}") for k in "ab"
    )
    fits = F.expr(
        f"{100 + percent} * both + IF(alone, -{percent} * (na + nb), ga + gb) >= 0"
        f" AND 100 * least(na, nb) >= {percent} * greatest(na, nb)"
    )
    reach = F.least("pa", "pb") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    met = near.join(a, "ca").join(b, ["token", "cb"])
    met = met.filter(fits & (reach >= least_overlap(F.col("na"), F.col("nb"), percent)))
    return enough(met.select("a", "b", "na", "nb", "pa", "pb"), percent)


def shared_differences(near: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a set alone and a group's member that share shingles their leader does not have.

    a shares with b at most what it shares with the leader and what of its rest lies in b's rest, so the
    rests are joined by shingle instead of the sets.
    """
    one = near.filter("alone").select(F.col("ca").alias("a"), "na", F.col("cb").alias("comp"), "both", F.explode("rest").alias("token"))
    two = members.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), "comp", "gain", F.explode("rest").alias("token"))
    met = one.join(two, ["comp", "token"]).filter(F.expr(f"{100 + percent} * both - {percent} * na + gain >= 0"))
    met = met.groupBy("a", "b", "na", "nb", "both").agg(F.count("*").alias("more"))
    return met.filter(f"{100 + percent} * (both + more) >= {percent} * (na + nb)").select("a", "b")


def cross_links(lists: DataFrame, labels: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between different components, at least one wherever any of their members are similar.

    Only leaders are compared at first. A member c of leader C shares with any set no more than C does,
    plus what c has beside C. With o shingles shared by two leaders, members c and d can therefore only
    be similar if (100 + percent) * o + gain(c) + gain(d) >= 0, where gain(c) is
    (100 + percent) * |c without C| - percent * |c|. Most pairs of a group and its surroundings end
    there with one comparison. Where the bound leaves a set beside a group, the set can only be similar to
    members small enough for o or to members with which it shares shingles that the leader does not have.
    """
    groups = labels.select("node", "label").unionByName(labels.select(F.col("label").alias("node"), "label").distinct())
    named = lists.join(groups, lists["doc_id"] == groups["node"], "left").select(
        "token", "doc_id", "n", "pos", F.coalesce("label", "doc_id").alias("comp"), F.col("label").isNull().alias("alone")
    )
    met = met_blocks(named, percent)
    in_groups = met.filter("NOT sa").select(F.col("a").alias("label")).union(met.filter("NOT sb").select("b")).distinct()
    own = labels.join(in_groups, "label").select(F.col("label").alias("a"), F.col("node").alias("b"), F.lit(True).alias("own"))
    found = overlaps(met.select("a", "b", F.lit(False).alias("own")).unionByName(own), docs, width)
    gain = (100 + percent) * (F.col("nb") - F.col("both")) - percent * F.col("nb")
    members = found.filter("own").select(
        F.col("b").alias("doc_id"), F.col("a").alias("comp"), F.col("nb").alias("n"), gain.alias("gain"), F.col("xb").alias("rest")
    )
    best = members.groupBy("comp").agg(F.max("gain").alias("best"), F.min("n").alias("least"))
    leaders = found.filter("NOT own")
    links = leaders.filter(_linked(percent)).select("a", "b")
    near = leaders.filter(~_linked(percent)).join(met.filter("NOT (sa AND sb)"), ["a", "b"])
    for k in "ab":
        side = best.select(F.col("comp").alias(k), F.col("best").alias(f"best_{k}"), F.col("least").alias(f"least_{k}"))
        near = near.join(side, k, "left").withColumn(f"best_{k}", F.greatest(f"best_{k}", F.lit(-percent) * F.col(f"n{k}")))
        near = near.withColumn(f"least_{k}", F.least(f"least_{k}", f"n{k}"))
    near = near.filter((100 + percent) * F.col("both") + F.col("best_a") + F.col("best_b") >= 0)
    first = {name: F.when(F.col("sb"), F.col(b)).otherwise(F.col(a)).alias(name) for name, a, b in [("ca", "a", "b"), ("na", "na", "nb"), ("rest", "xa", "xb")]}
    by_lists = F.expr(f"NOT (sa OR sb) OR {100 + percent} * both >= {percent} * (least_a + least_b)").alias("by_lists")
    near = near.select(*first.values(), F.when(F.col("sb"), F.col("a")).otherwise(F.col("b")).alias("cb"), "both", F.expr("sa OR sb").alias("alone"), by_lists)
    near = stage(near, "near-components")
    if near.limit(1).count() == 0:
        return links
    pairs = member_pairs(named, near.filter("by_lists").select("ca", "cb", "both", "alone"), members, percent)
    pairs = pairs.union(shared_differences(near, members, percent)).distinct()
    return links.unionByName(verified(pairs, docs, width, percent))


def joined_by_id(docs: DataFrame, *how) -> DataFrame:
    """The join where one id has several texts: rows are joined, then the id ties its rows together."""
    rows = stage(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "rows")
    found = join(rows.select(F.col("row").alias("doc_id"), "text"), *how).selectExpr("doc_id AS row", "n_shingles", "component_id AS part")
    found = stage(found.join(rows.select("row", "doc_id"), "row"), "rows-joined")
    linked = found.filter("doc_id IS NOT NULL AND n_shingles > 0")
    ties = linked.groupBy("doc_id").agg(F.min("part").alias("one"), F.collect_set("part").alias("parts"))
    ties = ties.filter(F.size("parts") > 1).select("one", F.explode("parts").alias("other"))
    labels = components(ties, "one", "other")
    found = found.join(labels, found["part"] == labels["node"], "left").withColumn("part", F.coalesce("label", "part"))
    least = found.filter("n_shingles > 0").groupBy("part").agg(F.min("doc_id").alias("least"))
    out = found.join(least, "part", "left")
    # an empty set is linked with nothing, but its id may have another text
    same = linked.select("doc_id", "part").join(labels, F.col("part") == labels["node"], "left").select("doc_id", F.coalesce("label", "part").alias("part"))
    same = same.join(least, "part").groupBy("doc_id").agg(F.min("least").alias("by_id"))
    out = out.join(same, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce(F.when(F.col("n_shingles") > 0, F.col("least")), "by_id", "doc_id").alias("component_id"))


def join(docs: DataFrame, width: int = 5, percent: int = 75, often: int = 64, block: int = 3_000_000) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Null, empty and blank texts
    have no shingle and stand alone; a text of fewer words than ``width`` is one shingle. Repeated
    rows come back each, and rows of one id with different texts are in one component. A null ``doc_id`` is never a component's name unless all of it are null.
    An empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    first = stage(sets_and_counts(docs, width, block), "sets")
    found = first.filter("n IS NOT NULL").drop("token", "found")
    kinds = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct("c1", "c2")).alias("lo"), F.max(F.struct("c1", "c2")).alias("hi"))
    if kinds.filter("lo <> hi").limit(1).count():
        return joined_by_id(docs, width, percent, often, block)
    classes = found.filter("n > 0").groupBy("c1", "c2").agg(F.min("doc_id").alias("doc_id"))
    classes = stage(classes.filter("doc_id IS NOT NULL"), "classes")
    total = found.agg(F.sum("n")).first()[0] or 0
    # at most 2**20 shingles can be this frequent, so the list of them is bounded
    counts = first.filter("token IS NOT NULL").groupBy("token").agg(F.sum("found").alias("f"))
    hot = counts.filter(F.col("f") >= max(often, total >> 20)).select("token").toArrow()
    frequent = np.sort(hot.column("token").to_numpy().astype(np.int64).view(np.uint64))
    lists = stage(shared_postings(prefixes(docs, width, percent, frequent)), "lists")
    lists = stage(lists.join(classes, ["c1", "c2"]).select("token", "doc_id", "n", "pos"), "lists-by-id")
    stars = verified(enough(leader_pairs(lists, percent), percent), docs, width, percent)
    labels = components(stars, "a", "b")
    rest = cross_links(lists, labels, docs, width, percent)
    labels = components(stars.unionByName(rest), "a", "b")
    named = classes.join(labels, classes["doc_id"] == labels["node"], "left")
    named = named.select("c1", "c2", F.coalesce("label", "doc_id").alias("component_id"))
    out = found.join(named, ["c1", "c2"], "left")
    component = F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), component.alias("component_id"))
