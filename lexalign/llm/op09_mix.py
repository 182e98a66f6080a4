"""Mixing sources to target weights over blocks of fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import small_batches, table, written

WEIGHTS, BUDGET, MOST = (3, 1, 2), 1.5, 2
BLOCK_WORDS, SHARDS, SEED = 128, 16, 20
#: Parts a source's documents are laid out in, so that no task orders a whole source.
CHUNKS = 1024
#: Slots that are permuted at a time, and the most tasks that do so.
_PIECE, _TASKS = 16_384, 20_000
_WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[float], budget: float = BUDGET, most: float = MOST) -> list[float]:
    """Shares of budget times all sizes by weight; none above most times its size, the excess reshared by weight."""
    out, left, free = [0.0] * len(sizes), budget * sum(sizes), list(range(len(sizes)))
    while free:
        unit = left / sum(weights[i] for i in free)
        over = {i for i in free if unit * weights[i] > most * sizes[i]}
        for i in over or free:
            out[i] = float(most * sizes[i]) if over else unit * weights[i]
        if not over:
            break
        left -= sum(most * sizes[i] for i in over)
        free = [i for i in free if i not in over]
    return out


def shard_counts(slots: list[int], shards: int, seed: int) -> list[list[int]]:
    """counts[shard][source]: multinomial draws by what is left of each source, so that the sums are slots exactly."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left = np.array(slots, np.int64)
    out = []
    for k in range(shards):
        n = int(left.sum()) // (shards - k) if k < shards - 1 else int(left.sum())
        draw = np.minimum(rng.multinomial(n, left / left.sum()), left) if n else np.zeros_like(left)
        for i in np.argsort(-(left - draw), kind="stable"):  # what the draw took beyond a source's rest
            more = min(n - int(draw.sum()), int(left[i] - draw[i]))
            if more <= 0:
                break
            draw[i] += more
        left = left - draw
        out.append(draw.tolist())
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 to n - 1: a Feistel network, walked until it lands below n."""
    half = max(1, ((max(1, n - 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    x = index.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> np.uint64(half), x[todo] & mask
        for r in range(4):
            salt = np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % 2**64)
            left, right = right, left ^ (_mixed(right + salt) & mask)
        x[todo] = left << np.uint64(half) | right
        todo = todo[x[todo] >= n]
    return x.astype(np.int64)


def _slots_to_blocks(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for sid, shard, first, count, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                block = permuted(np.arange(first, first + count, dtype=np.int64) % n, n, seed * 1_000_003 + sid)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(count, sid, np.int32)), pa.array(block), pa.array(np.full(count, shard, np.int32))], ["sid", "block", "out_shard"])

    return run


def plan(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED, weights: tuple = WEIGHTS, keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The mix: (placed, pieces).

    placed: the columns keep (by default all) of docs with size (words), sid, start (place of the first word in its source's stream),
    source_size and target. pieces: sid, start, from_word, to_word (within the document), block, out_shard, one row
    for each time that the mix takes those words.

    Sources count by code point, null last, and take weights in turn. A source's documents are laid out one behind
    the other in hash order and cut into blocks of block_words words. Its target gives a number of slots, dealt to
    the output shards by multinomial draws; slot k takes the block at place k mod n of a pseudorandom permutation of
    the n blocks, so after all blocks the second round begins, and no block is taken more often than the target's
    limit. Null, empty and blank texts have no words and are never taken. Repeated rows and null ids are documents
    like others; an empty table gives an empty mix. Same input, same mix. The driver holds one row a source, the
    named parts of a mix. Offsets come from CHUNKS sums a source and a window within each chunk.
    """
    spark = docs.sparkSession
    added = ("size", "sid", "start", "source_size", "target", "_source", "_chunk", "_order")
    kept = [c for c in keep or docs.columns if c not in added]
    own = docs.select(*dict.fromkeys([*kept, "doc_id", "source"]), F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("size"))
    own = own.withColumn("_order", F.xxhash64(F.lit(seed), "doc_id")).withColumn("_chunk", F.pmod("_order", F.lit(CHUNKS)).cast("int"))
    if "text" not in kept:  # then the rows are small, and words are counted once for both uses
        own = written(spark, own, "mix-sizes")
    chunks = own.groupBy("source", "_chunk").agg(F.sum("size").alias("n"))
    chunks = written(spark, chunks, "mix-chunks")
    found = [(r["source"], r["n"]) for r in chunks.groupBy("source").agg(F.sum("n").alias("n")).collect()]
    found.sort(key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [n for _, n in found]
    target = targets(sizes, [float(weights[i % len(weights)]) for i in range(len(found))])
    n_blocks = [-(-n // block_words) for n in sizes]
    slots = [min(MOST * b, round(t / n * b)) if n else 0 for n, t, b in zip(sizes, target, n_blocks, strict=True)]
    schema = T.StructType([T.StructField("_source", T.StringType()), T.StructField("sid", T.IntegerType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())])
    sources = spark.createDataFrame([(s, i, n, t) for i, ((s, n), t) in enumerate(zip(found, target, strict=True))], schema)
    before = Window.partitionBy("source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select(F.col("source").alias("_source"), F.col("_chunk").alias("_c"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    offsets = offsets.join(sources.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    placed = own.join(offsets, own["source"].eqNullSafe(offsets["_source"]) & (own["_chunk"] == offsets["_c"]))
    inside = Window.partitionBy("sid", "_chunk").orderBy("_order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select(*kept, "size", "sid", (F.col("_base") + F.coalesce(F.sum("size").over(inside), F.lit(0))).alias("start"), "source_size", "target")

    counts = shard_counts(slots, shards, seed)
    ranges, first = [], [0] * len(slots)
    for k, row in enumerate(counts):
        for i, n in enumerate(row):
            if n:
                ranges.append((i, k, first[i], n, n_blocks[i]))
                first[i] += n
    asked = spark.createDataFrame(ranges, "sid int, out_shard int, first long, n long, blocks long")
    asked = asked.select("sid", "out_shard", "first", "n", "blocks", F.explode(F.expr(f"sequence(0L, (n - 1) div {_PIECE})")).alias("p"))
    asked = asked.select("sid", "out_shard", (F.col("first") + F.col("p") * _PIECE).alias("first"), F.least(F.lit(_PIECE), F.col("n") - F.col("p") * _PIECE).alias("n"), "blocks")
    pieces = sum(-(-n // _PIECE) for *_, n, _ in ranges)  # the planner can't see how much work a piece is
    picks = asked.repartition(max(1, min(pieces, _TASKS)), "sid", "first").mapInArrow(_slots_to_blocks(seed), "sid int, block long, out_shard int")
    of = placed.where("size > 0").select("sid", "start", "size", F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")).alias("block"))
    of = of.select("sid", "start", "block", F.greatest(F.lit(0), F.col("block") * block_words - F.col("start")).alias("from_word"), F.least(F.col("size"), (F.col("block") + 1) * block_words - F.col("start")).alias("to_word"))
    # the planner can't see how many slots the ranges unfold to, and would broadcast them
    return placed, of.join(picks.hint("merge"), ["sid", "block"])


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """plan()'s placed rows with taken, the words of each document that the mix takes, repeats counted."""
    placed, pieces = plan(docs, block_words, shards, seed, keep=keep)
    taken = pieces.groupBy("sid", "start").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    # a document without words shares its start with the next one
    got = placed.join(taken, ["sid", "start"], "left")
    return got.withColumn("taken", F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long"))


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The words of the spans [from, to) with the text between them as it was; spans that don't touch are set in lines."""
    joined: list[list[int]] = []
    for a, b in sorted(spans):
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(b, joined[-1][1])
        else:
            joined.append([a, b])
    raw = np.frombuffer(text, np.uint8)
    word = (raw != 32) & ((raw < 9) | (raw > 13))
    step = np.diff(np.concatenate(([False], word, [False])).astype(np.int8))
    first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if joined == [[0, len(first)]]:
        return text
    return b"\n".join(text[first[a] : last[b - 1]] for a, b in joined)


def mixed_texts(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Columns of docs (doc_id, text, source, others), a row for each round in which the mix takes words of a document.

    The first round has all words taken once or more, the second those taken twice; text holds just these words, and
    n_chars, where docs have it, their characters. Rows that repeat a doc_id and its text are taken as often as the
    mix takes all of them.
    """
    own = docs.withColumn("_text", F.xxhash64("text"))
    placed, pieces = plan(own, block_words, shards, seed, keep=["doc_id", "_text"])
    times = pieces.groupBy("sid", "start", "from_word", "to_word").agg(F.count("*").cast("int").alias("times"))
    rounds = times.select("sid", "start", F.struct("from_word", "to_word").alias("span"), F.explode(F.sequence(F.lit(1), F.col("times"))).alias("round"))
    rounds = rounds.groupBy("sid", "start", "round").agg(F.collect_list("span").alias("spans"))
    of = placed.where("size > 0").select("sid", "start", F.col("doc_id").alias("_id"), F.col("_text").alias("_t"))
    lists = of.join(rounds, ["sid", "start"]).groupBy("_id", "_t").agg(F.collect_list("spans").alias("rounds"))
    got = own.dropDuplicates(["doc_id", "_text"]).join(lists, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_t")))
    got = got.select(*docs.columns, F.explode("rounds").alias("_spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = dict(zip(b.schema.names, b.columns, strict=True))
            spans = [[(s["from_word"], s["to_word"]) for s in x] for x in cols.pop("_spans").to_pylist()]
            texts = [cut(t, s).decode() for t, s in zip(cols["text"].cast(pa.binary()).to_pylist(), spans, strict=True)]
            cols["text"] = pa.array(texts, pa.string())
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([len(t) for t in texts], pa.int64()).cast(cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    small_batches(docs.sparkSession)
    return got.mapInArrow(run, docs.schema)


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of mix() over documents, with its defaults; rows, nulls and ties as there."""
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), keep=["doc_id", "source"])
    return out.select("doc_id", "size", "source_size", "target", "taken")
