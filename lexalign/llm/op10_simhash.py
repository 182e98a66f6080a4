"""Near duplicates by SimHash fingerprints, searched with pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_BYTES, checkpointed, small_batches, table, written

SHINGLE, SEED, MAX_BITS = 3, 42, 2
#: Parts of the bits that a family of reference fingerprints resolves each, and the seed that the references come from.
PARTS, PIVOT_SEED = 4, 7
#: A key is heavy if it has more than this share of all rows; so there are at most 1 / HEAVY heavy keys.
HEAVY = 1e-4
#: Fingerprints in a bucket whose pairs one task compares; larger buckets go the way of single-bit variants.
MAX_BUCKET = 512
_BLOCK = 4096


@cache
def families(parts: int = PARTS, seed: int = PIVOT_SEED) -> tuple[tuple[int, ...], ...]:
    """Reference fingerprints, a family for each part of the bits; the same in every process.

    The references of a family are equal outside their part. So the differences of a fingerprint's distances to them
    depend on its bits in that part alone, and references are added until they tell all values of these bits apart: the
    family resolves the part.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    width = 64 // parts
    values = np.arange(1 << width, dtype=np.uint32)
    out = []
    for k in range(parts):
        base = int(rng.integers(0, 2**64, dtype=np.uint64))
        own, label = [base], np.zeros(len(values), np.int64)
        while True:
            flip = int(rng.integers(1, 1 << width))
            inner = (base >> (width * k)) & ((1 << width) - 1)
            gap = np.bitwise_count(values ^ np.uint32(inner ^ flip)).astype(np.int64) - np.bitwise_count(values ^ np.uint32(inner))
            told, label = np.unique(label * 64 + gap, return_inverse=True)
            own.append(base ^ (flip << (width * k)))
            if len(told) == len(values):
                break
        out.append(tuple(own))
    return tuple(out)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half of the hashes of the word shingles, repeats counted; 0 without words."""
    import xxhash

    words = text.translate(LOWER_BYTES).split() if text else []
    if not words:
        return 0
    flat = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    stops = (ends - 1).tolist()
    h = xxhash.xxh64_intdigest
    last = min(shingle, len(words)) - 1
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        hashes = [h(flat[i:j], SEED) for i, j in zip(starts[at : min(at + _BLOCK, n)], stops[at + last :])]  # noqa: B905
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of each row of docs; other columns play no part."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["doc_id", "fp"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(run, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def close_pairs(fps: np.ndarray, tables: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j within max_bits. tables: distance of each fingerprint to each pivot.

    |d(x, p) - d(y, p)| <= d(x, y) for any pivot p, so a pair whose coordinates differ by more than max_bits anywhere
    is discarded; survivors are verified on the fingerprints.
    """
    order = np.argsort(tables[:, 0], kind="stable")
    i, j = [], []
    first = tables[order, 0]
    stop = np.searchsorted(first, first + max_bits, "right")
    for k in range(len(order) - 1):  # those that the first coordinate leaves
        other = order[k + 1 : stop[k]]
        if len(other):
            i.append(np.full(len(other), order[k]))
            j.append(other)
    if not i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    i, j = np.concatenate(i), np.concatenate(j)
    for c in range(1, tables.shape[1]):
        keep = np.abs(tables[i, c] - tables[j, c]) <= max_bits
        i, j = i[keep], j[keep]
    keep = np.bitwise_count(fps[i] ^ fps[j]) <= max_bits
    return i[keep], j[keep]


def _bucket_edges(max_bits: int):
    """For partitions that hold whole buckets: a star to the smallest fingerprint of each group linked in a bucket."""
    refs = np.array([p for own in families() for p in own], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()) for b in batches]
        if not got:
            return
        mask, key, fp = (np.concatenate(x) for x in zip(*got, strict=True))
        order = np.lexsort((fp, key, mask))
        mask, key, fp = mask[order], key[order], fp[order].view(np.uint64)
        cut = np.flatnonzero((np.diff(mask) != 0) | (np.diff(key) != 0)) + 1
        src, dst = [], []
        for s, e in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(fp)])), strict=True):
            if e - s < 2:
                continue
            own = fp[s:e]
            coords = np.bitwise_count(own[:, None] ^ refs[None, :]).astype(np.int16)
            i, j = close_pairs(own, coords, max_bits)
            if not len(i):
                continue
            root = np.arange(len(own))
            while True:  # smallest index reachable
                low = np.minimum(root[i], root[j])
                new = root.copy()
                np.minimum.at(new, i, low)
                np.minimum.at(new, j, low)
                new = new[new]
                if (new == root).all():
                    break
                root = new
            far = np.flatnonzero(root != np.arange(len(own)))
            src.append(own[far])
            dst.append(own[root[far]])
        if src:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(src).view(np.int64)), pa.array(np.concatenate(dst).view(np.int64))], ["u", "v"])

    return run


def _coordinates(fp: Column) -> list[Column]:
    """For each family a hash of the differences of fp's distances to the family's references."""

    def far(p: int) -> Column:
        return F.bit_count(fp.bitwiseXOR(F.lit(_signed(p))))

    return [F.xxhash64(*[far(p) - far(own[0]) for p in own[1:]]) for own in families()]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links (u, v) that connect the fingerprints (fp) as their pairs within 2 bits do.

    Pivot distances are the search key: fingerprints meet in buckets of equal distance differences within two
    families. Two fingerprints that differ in 2 bits or fewer have like bits in two of the four parts at least, so like
    differences in two families: they share one of the six tables. Within a bucket of up to max_bucket fingerprints
    pairs pass the tables of distances to all references and survivors are verified; a bucket gives a forest, not its
    pairs. The fingerprints of larger buckets, which are near copies by the hundred that no reference tells apart, each
    give their 65 variants of at most one changed bit; two lie within 2 bits just if they share a variant, and no
    variant has more than 65 owners. That way is exact and linear, so no bucket has a cap beyond which links get lost.
    """
    if max_bits != 2:
        raise ValueError("the tables serve links of 2 bits; near_duplicates(similarity=...) serves wider ones")
    told = distinct.select("fp", *[c.alias(f"_{i}") for i, c in enumerate(_coordinates(F.col("fp")))])
    tables = [F.struct(F.lit(PARTS * i + j).alias("mask"), F.xxhash64(f"_{i}", f"_{j}").alias("key")) for i in range(PARTS) for j in range(i)]
    one = told.select("fp", F.explode(F.array(*tables)).alias("x")).select("x.mask", "x.key", "fp")
    sizes = one.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    sized = one.join(sizes, ["mask", "key"])
    cold = sized.where(F.col("n") <= max_bucket).select("mask", "key", "fp").repartition("mask", "key").mapInArrow(_bucket_edges(max_bits), "u long, v long")
    hot = sized.where(F.col("n") > max_bucket).select("fp").distinct()
    flips = [0, *(_signed(1 << i) for i in range(64))]
    variants = hot.select("fp", F.explode(F.array(*[F.lit(x) for x in flips])).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    shared = variants.groupBy("variant").agg(F.collect_list("fp").alias("own")).where(F.size("own") > 1)
    warm = shared.select(F.explode("own").alias("u"), F.array_min("own").alias("v")).where("u <> v").distinct()
    return cold.union(warm).distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """node and root, the smallest node that edges (u, v) reach, for every node that has an edge.

    Large-star and small-star rounds until nothing changes; each round's links are checkpointed, so lineage stays
    short, and nothing is collected but the number of links and a checksum.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e, was = checkpointed(spark, e), None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        e = checkpointed(spark, small)
        now = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(now) == was:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        was = tuple(now)


def named_groups(spark: SparkSession, rows: DataFrame, groups: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """rows with component_id, the smallest doc_id that edges reach from each row's key; groups: key, low, n.

    Keys of more than HEAVY of all rows are at most 1 / HEAVY, so their components are broadcast, and their rows do not
    meet in one task; the others join by key.
    """
    roots = components(spark, edges).withColumnRenamed("node", "_node")
    named = groups.join(roots, F.col(key) == F.col("_node"), "left").select(key, "low", "n", F.coalesce("root", key).alias("root"))
    ids = named.groupBy("root").agg(F.min("low").alias("component_id"))
    of = written(spark, named.select(key, "n", "root").join(ids, "root").select(key, "n", "root", "component_id"), "components")
    total = of.agg(F.sum("n")).first()[0] or 0
    heavy = F.col("n") > HEAVY * total
    few = F.broadcast(of.where(heavy).drop("n"))
    return rows.join(few, key).unionByName(rows.join(few, key, "left_anti").join(of.where(~heavy).drop("n"), key))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET, similarity: bool = False) -> DataFrame:
    """doc_id, fp (signed long) and component_id (smallest doc_id linked) of each row of docs (doc_id, text).

    Fingerprints link at max_bits or fewer differing bits. With similarity, texts link instead if their sets of word
    shingles are 4/5 similar or more, by op10_sets.similar_texts(); that is beyond any radius that tables of 64 bits
    could search, so there fp is the hash of a set. Null, empty and blank texts have fingerprint 0 (one set without
    shingles) and link like any other. Rows that repeat a doc_id are rows of their own with that id; a null doc_id takes
    part but names no component unless a component has no other id. An empty table gives no rows; other columns play
    no part. Copies meet in one distinct fingerprint before any search, by an aggregation that combines before the
    shuffle.
    """
    spark = docs.sparkSession
    if similarity:
        from .op10_sets import similar_texts

        return similar_texts(docs, shingle).select("doc_id", "fp", "component_id")
    fps = written(spark, fingerprints(docs, shingle), "fingerprints")
    groups = fps.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    return named_groups(spark, fps, groups, links(groups.select("fp"), max_bits, max_bucket), "fp").select("doc_id", "fp", "component_id")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of near_duplicates() over documents, with its defaults; rows, nulls and ties as there."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
