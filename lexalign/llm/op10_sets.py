"""op10's wide setting: texts linked by word-shingle similarity of 4/5 or more, exactly.

The signs that a SimHash keeps of its sums lose links at this width, so the fingerprint is the set of shingle hashes, and
its distance to a reference, a set of hashes too, is the size of the symmetric difference. Pivot distance tables are the
search key and discard pairs, as in the narrow setting:

* Hash space is cut into parts, and each part has a family of references: nothing, and for each of the low bits the
  part's hashes that have it set. The differences of a set's distances to them are, but for sign and constants, the sums
  that SimHash takes over the set's hashes in the part. Sets meet in buckets of equal differences within a family.
* The references of the second table are all unions of REGIONS equal regions; the distances follow from a set's counts in
  the regions, which are its table. The greatest difference of two sets' distances to any of the 2^REGIONS references is
  the sum over the regions of their counts' differences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_BYTES, let_go, small_batches, written
from .op10_simhash import components, named_groups

#: Words in a shingle; links are pairs of 4/5 similarity or more.
SHINGLE, SEED = 5, 42
#: Sets of fewer shingles have parts of a single hash, of 2^FINEST parts; larger ones have 1.25 to 2.5 shingles a part.
FEW, FINEST = 128, 64
#: A byte's bits in a byte each, so that sums over up to 255 hashes stay apart.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8).reshape(-1, 1), axis=1, bitorder="little").copy().view("<u8").ravel()
#: Buckets of up to so many shingle sets give all their pairs at once; larger ones first a few pairs a member.
SMALL = 8
#: Members of a large bucket that all others meet in the second round.
HUBS = 3
#: Documents that tell which shingles are common, and shingles named so. They only order shingles: any order is exact.
SAMPLE, COMMON = 4000, 100_000
_BLOCK = 512
#: Regions of hash space that the pivot tables count in, larger ones that pairs of large buckets are held against first,
#: and those that they are held against before that.
REGIONS, _ROUGH, _COARSE = 1024, 512, 64
_SHIFT = np.uint64(64 - 10)
_NAMES = ["u", "v", "token", "n", "pos"]
_FOUND = "u long, v long, token long, n long, pos long"


def shingles(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of the word shingles, each once; a shorter text is one shingle, one without words none."""
    import xxhash

    words = text.translate(LOWER_BYTES).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    h = xxhash.xxh64_intdigest
    stops = (ends - 1).tolist()[min(shingle, len(words)) - 1 :]
    return np.unique(np.array([h(flat[i:j], SEED) for i, j in zip(starts, stops)], np.uint64))  # noqa: B905


def alike(common, n, m):
    """If sets of n and m with so many in common are 4/5 similar: common / (n + m - common) >= 4 / 5."""
    return 9 * common >= 4 * (n + m)


def _node(own: np.ndarray) -> int:
    import xxhash

    x = xxhash.xxh64_intdigest(own.tobytes(), SEED)
    return x - 2**64 if x >= 2**63 else x


def _common(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles that several of a sample of documents hold, and how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [shingles(t) for t in b.column(0).to_pylist()]
            if own:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own).view(np.int64))], ["token"])

    texts = docs.select(F.col("text").cast("binary").alias("text"))
    some = texts.sample(min(1.0, SAMPLE / max(1, docs.count())), SEED)
    often = some.mapInArrow(run, "token long").groupBy("token").agg(F.count("*").alias("n")).where("n > 2")
    got = often.orderBy(F.desc("n"), "token").limit(COMMON).toArrow()
    token, n = (got.column(i).to_numpy() for i in range(2))
    order = np.argsort(token.view(np.uint64))
    return token.view(np.uint64)[order], n[order]


def most_unlike(n: int, parts: int) -> int:
    """The most family keys of a set of n that one alike can lack: a key for each hash that one of the two lacks, or, where
    parts are single hashes, for each that the other lacks; see alike()."""
    return n // 5 if parts == FINEST else (n + 5 * n // 4) // 9


def level(n: int) -> int:
    """The logarithm of the number of parts in which a set of n looks for others of its size or more."""
    return FINEST if n < FEW else (4 * n // 5).bit_length() - 1


def family_keys(own: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of the 2^parts parts that hold some of a set's sorted hashes, where these start and a hash of the
    differences of the set's distances to the part's references."""
    part = own >> np.uint64(64 - parts)
    start = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    sums = np.add.reduceat(_SPREAD[own.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :4]], start, axis=0)
    key = part[start] * np.uint64(64) + np.uint64(parts)
    for c in range(sums.shape[1]):
        key = (key ^ sums[:, c]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return start, key


def search_keys(own: np.ndarray, rank: np.ndarray) -> list[np.ndarray]:
    """The family keys that a set is found by, at its level and at that of sets 4/5 as large; rank: how common its hashes are.

    Two sets that differ in t hashes have unlike keys in t families at most, so of two that are alike either lacks no more
    than most_unlike() of the other's keys, and they share one of the first most_unlike() + 1 of both in any common order,
    if one of them has more than that.
    """
    n, out = len(own), []
    for parts in dict.fromkeys((level(n), level((4 * n + 4) // 5))):
        start, key = family_keys(own, parts)
        most = most_unlike(n, parts)
        if len(key) <= most and parts == level(n):
            raise ValueError(f"{n} shingles lie in {len(key)} of 2^{parts} parts, too few to find all links")
        out.append(key[np.lexsort((key, np.minimum.reduceat(rank, start)))][: most + 1])
    return out


def regions(own: np.ndarray) -> bytes:
    """How many of a set's hashes lie in each region, as two-byte numbers; counts that don't fit are cut, which lessens
    differences only."""
    return np.minimum(np.bincount((own >> _SHIFT).astype(np.int64), minlength=REGIONS), 65_535).astype("<u2").tobytes()


def rough_of(coord: bytes) -> bytes:
    """Counts of _ROUGH larger regions, a byte each; counts beyond 255 are cut."""
    return np.minimum(np.frombuffer(coord, "<u2").reshape(_ROUGH, -1).sum(1, dtype=np.int64), 255).astype(np.uint8).tobytes()


def gaps(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """Greatest difference of distances to any reference, for each two sets' counts."""
    a, b = (np.frombuffer(b"".join(t), "<u2").reshape(-1, REGIONS).astype(np.int32) for t in (x, y))
    return np.abs(a - b).sum(1)


def _prefixes(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, node (hash of the shingle set), n (its size), coord (regions()), rough (rough_of()), prefix (all of
    search_keys()) and own (how many of these are of the set's level)."""
    small_batches(spark)
    told = spark.sparkContext.broadcast(_common(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, often = told.value
        for b in batches:
            node, n, prefix, coord, rough, first = [], [], [], [], [], []
            for text in b.column(2).to_pylist():
                own = shingles(text)
                rank = np.zeros(len(own), np.int64)
                if len(token):
                    at = np.minimum(np.searchsorted(token, own), len(token) - 1)
                    rank = np.where(token[at] == own, often[at], 0)
                node.append(_node(own))
                n.append(len(own))
                coord.append(regions(own))
                rough.append(rough_of(coord[-1]))
                keys = search_keys(own, rank) if len(own) else [np.empty(0, np.uint64)]
                first.append(len(keys[0]))
                prefix.append(np.concatenate(keys).view(np.int64))
            cols = [pa.array(node, pa.int64()), pa.array(n, pa.int32()), pa.array(coord, pa.binary()), pa.array(rough, pa.binary()), pa.array(prefix, pa.list_(pa.int64())), pa.array(first, pa.int32())]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *cols], ["doc_id", "text_hash", "node", "n", "coord", "rough", "prefix", "own"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(run, "doc_id long, text_hash long, node long, n int, coord binary, rough binary, prefix array<long>, own int")


def _pairs(rest: bool, hubs: int = 0):
    """Pairs to verify, for partitions that hold whole buckets (sets with equal distance differences in a family).

    The first key two sets share, at places i and j of theirs, has i keys before it in one set and j in the other that
    tell them apart. Where the smaller set has parts of single hashes, that leaves min(n - i, m - j) in common at most;
    else they differ in max(i, j) hashes at least. A pair that is not alike by that goes. Not rest: all pairs of small buckets, and for each member of larger ones those with
    the least and the greatest node there, which are the same in most buckets of a group of copies; the members
    themselves come behind, with their shingle and no partner. rest: all pairs of larger buckets whose roots differ and
    that the rough pivot tables leave, without a look at those within a large group of one root; with hubs, of these only those with the hubs members nearest to the bucket's mean
    counts, which what changed in a copy changes least.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [[*(c.to_numpy() for c in b.columns[:5]), *(c.to_pylist() for c in b.columns[5:])] for b in batches]
        if not got:
            return
        token, node, n, pos, root = (np.concatenate(x) for x in zip(*(g[:5] for g in got), strict=True))
        order = np.lexsort((node, n, token))
        token, node, n, pos, root = (c[order] for c in (token, node, n.astype(np.int64), pos.astype(np.int64), root))
        rough = np.frombuffer(b"".join(x for g in got for x in g[5]), np.uint8).reshape(-1, _ROUGH)[order] if rest else None
        coarse = rough.reshape(len(rough), _COARSE, -1).sum(2, dtype=np.int32) if rest else None
        cut = np.concatenate(([0], np.flatnonzero(np.diff(token)) + 1, [len(token)]))
        size = np.diff(cut)
        found: list[np.ndarray] = []
        held = 0

        def take(i: np.ndarray, j: np.ndarray) -> None:
            nonlocal held, found
            low, both = np.minimum(n[i], n[j]), n[i] + n[j]
            most = np.where(low < FEW, np.minimum(n[i] - pos[i], n[j] - pos[j]), np.minimum(low, (both - np.maximum(pos[i], pos[j])) // 2))
            keep = (node[i] != node[j]) & alike(most, n[i], n[j])
            if rest:
                keep &= root[i] != root[j]
            i, j = i[keep], j[keep]
            if rest and len(i):
                for counts in (coarse, rough):
                    parts = [slice(at, at + 8192) for at in range(0, len(i), 8192)]
                    keep = [9 * np.abs(counts[i[p]].astype(np.int32) - counts[j[p]]).sum(1, dtype=np.int64) <= n[i[p]] + n[j[p]] for p in parts]
                    keep = np.concatenate(keep) if keep else np.empty(0, bool)
                    i, j = i[keep], j[keep]
            if len(i):
                found.append(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j])], 1))
                held += len(i)
            if held > 4_000_000:
                found = [np.unique(np.concatenate(found), axis=0)]
                held = len(found[0]) // 2

        def meet(a: np.ndarray, b: np.ndarray) -> None:
            """Pairs of a and b, members by rising size, or of a with itself; blocks of sizes too unlike are passed by."""
            small, large = 5 * n[b], 4 * n[b]
            for at in range(0, len(a), _BLOCK):
                part = a[at : at + _BLOCK]
                low = at if b is a else int(np.searchsorted(small, 4 * n[part[0]]))
                for to in range(low, int(np.searchsorted(large, 5 * n[part[-1]], "right")), _BLOCK):
                    i, j = (x.ravel() for x in np.meshgrid(part, b[to : to + _BLOCK], indexing="ij"))
                    if b is a:
                        i, j = i[i < j], j[i < j]
                    take(i, j)

        bucket = np.repeat(np.arange(len(size)), size)
        if not rest:
            for step in range(1, SMALL):
                i = np.arange(len(token) - step)
                i = i[(bucket[i] == bucket[i + step]) & (size[bucket[i]] <= SMALL)]
                take(i, i + step)
            i = np.flatnonzero(size[bucket] > SMALL)
            by_node = np.lexsort((node, bucket))  # each bucket keeps its places
            take(i, by_node[cut[:-1]][bucket[i]])
            take(i, by_node[cut[1:] - 1][bucket[i]])
        else:
            for s, e in zip(cut[:-1][size > SMALL], cut[1:][size > SMALL], strict=True):
                if (root[s:e] == root[s]).all():
                    continue
                if hubs:
                    mean = rough[s:e].mean(0, dtype=np.float64)
                    far = np.concatenate([np.abs(rough[at : min(at + 16_384, e)] - mean).sum(1) for at in range(s, e, 16_384)])
                    for c in (np.lexsort((node[s:e], far))[:hubs] + s).tolist():
                        take(np.arange(s, e), np.full(e - s, c))
                    continue
                left = np.arange(s, e)
                while True:  # a root's members meet the others only; once no root has a quarter of them, little is spared
                    own, count = np.unique(root[left], return_counts=True)
                    if 4 * count.max() < len(left) or len(own) == 1:
                        break
                    big = root[left] == own[count.argmax()]
                    meet(left[~big], left[big])
                    left = left[~big]
                if len(own) > 1:
                    meet(left, left)
        if found:
            out = np.unique(np.concatenate(found), axis=0)
            for at in range(0, len(out), 100_000):
                part = out[at : at + 100_000]
                none = pa.nulls(len(part), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(part[:, 0])), pa.array(np.ascontiguousarray(part[:, 1])), none, none, none], _NAMES)
        if not rest:
            i = np.flatnonzero(size[bucket] > SMALL)
            for at in range(0, len(i), 100_000):
                j = i[at : at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(node[j]), pa.nulls(len(j), pa.int64()), pa.array(token[j]), pa.array(n[j]), pa.array(pos[j])], _NAMES)

    return run


def _near(spark: SparkSession, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose distances to each reference differ by no more than two sets that are alike can differ.

    Sets of n and m that are 4/5 similar differ in (n + m) / 9 hashes at most, and no distance to a reference differs by
    more than the sets do; so no pair that is alike goes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                most = b.column("n").to_numpy().astype(np.int64) + b.column("m").to_numpy()
                keep = 9 * gaps(b.column("x").to_pylist(), b.column("y").to_pylist()) <= most
                yield b.select(["u", "v"]).filter(pa.array(keep))

    x, y = (nodes.select(F.col("node").alias(a), F.col("n").alias(b), F.col("coord").alias(c)) for a, b, c in (("u", "n", "x"), ("v", "m", "y")))
    return written(spark, pairs.join(x, "u").join(y, "v").select("u", "v", "n", "m", "x", "y").mapInArrow(run, "u long, v long"), "near", settle=True)


def _sets(docs: DataFrame, need: DataFrame, groups: DataFrame) -> DataFrame:
    """node and own (its shingles) of the nodes in need, read from a text of each."""
    texts = need.join(groups, "node").select("text_hash").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [shingles(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([_node(x) for x in own], pa.int64()), pa.array([x.tobytes() for x in own], pa.binary())], ["node", "own"])

    own = docs.select(F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text")).join(texts, "text_hash", "left_semi")
    return own.dropDuplicates(["text_hash"]).select("text").mapInArrow(run, "node long, own binary")  # where the texts are by now


def _verified(spark: SparkSession, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of pairs that are alike on their whole shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(alike(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.toDF("u", "x"), "u").join(sets.toDF("v", "y"), "v").select("u", "v", "x", "y")
    return written(spark, both.mapInArrow(run, "u long, v long"), "alike", settle=True)


def _nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()


def similar_texts(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_hash, fp (hash of the shingle set), root (one for each group) and component_id (the group's
    smallest doc_id) of each row of docs (doc_id, text).

    Two texts are linked if the Jaccard similarity of their sets of 5-word shingles is 4/5 or more; words are those of
    op10. Texts without words, null ones among them, are alike. A null doc_id takes part, but names no component that
    has another id; rows that repeat a doc_id are rows of their own, and unlike texts of one id are in groups of their
    own. An empty table gives no rows; other columns play no part.

    All links count: pivot distances are the search key, so the sets meet in buckets of search_keys(), those with rarer
    shingles first; pairs that the table of regions leaves are verified on their whole sets. Large buckets link a few pairs a member first, in two rounds, and compare all pairs after
    that whose members are not yet in one component.
    """
    if shingle != SHINGLE:
        raise ValueError(f"shingles have {SHINGLE} words here")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = written(spark, _prefixes(spark, docs), "prefixes")
    rows = written(spark, own.select("doc_id", "text_hash", "node"), "rows")
    groups = rows.groupBy("node").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"), F.min("text_hash").alias("text_hash"))
    nodes = written(spark, own.where("n > 0").dropDuplicates(["node"]).select("node", "n", "coord", "rough", "prefix", "own"), "nodes", settle=True)
    let_go(own)

    tokens = nodes.select(F.posexplode("prefix").alias("pos", "token"), "node", "n", "own")
    tokens = tokens.select("token", "node", "n", F.when(F.col("pos") < F.col("own"), F.col("pos")).otherwise(F.col("pos") - F.col("own")).alias("pos"), F.col("node").alias("root"))
    found = written(spark, tokens.repartition(parts, "token").mapInArrow(_pairs(False), _FOUND), "candidates", settle=True)
    pairs = _near(spark, found.where("token is null").select("u", "v").distinct(), nodes)
    sets = written(spark, _sets(docs, _nodes_of(pairs), groups), "shingle-sets", settle=True)
    links = _verified(spark, pairs, sets)

    members = found.where("token is not null").select("token", F.col("u").alias("node"), "n", "pos")
    for hubs in (HUBS, 0):  # the hubs join most of a group, so that few pairs are left for the last round
        known = nodes.select("node", "rough").join(components(spark, links), "node", "left").select("node", "rough", F.coalesce("root", "node").alias("root"))
        rooted = members.join(known, "node").select("token", "node", "n", "pos", "root", "rough")
        rest = written(spark, rooted.repartition(parts, "token").mapInArrow(_pairs(True, hubs), _FOUND).select("u", "v"), "rest", settle=True)
        pairs = _near(spark, rest.distinct(), nodes)
        missing = _nodes_of(pairs).join(sets, "node", "left_anti")
        if missing.limit(1).count():
            sets = sets.unionByName(written(spark, _sets(docs, missing, groups), "shingle-sets", settle=True))
        links = links.union(_verified(spark, pairs, sets))
    out = named_groups(spark, rows, groups, links, "node")
    return out.select("doc_id", "text_hash", F.col("node").alias("fp"), "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Of each group of similar_texts() the row of smallest doc_id, of that id's texts the one of least hash; all columns.

    Rows without a doc_id come behind all others. Of rows alike in doc_id and text the one with the least other columns
    stays, so reruns agree. Unlike texts that share a doc_id are in groups of their own and stay.
    """
    found = similar_texts(docs.select("doc_id", "text"), shingle)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("_f"))
    stay = first.select(F.col("_f.doc_id").alias("_id"), F.col("_f.text_hash").alias("_h")).distinct()
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    own = docs.withColumn("_t", F.xxhash64("text"))
    own = own.join(stay, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_h")), "left_semi")
    one = own.groupBy("doc_id", "_t").agg(F.first("text").alias("text"), F.min(F.struct(*rest) if rest else F.lit(0)).alias("_r"))
    return one.select(*[F.col(f"_r.{c}") if c in rest else F.col(c) for c in docs.columns])
