"""Passages of a benchmark in documents, found by one Aho-Corasick automaton."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD_BYTES, small_batches, table, word_bytes

WINDOW = 10
#: Bytes of benchmark text in one automaton; longer benchmarks get several, one pass over the documents for each.
MAX_ITEM_BYTES = 16_000_000
_ADDED = ("n_words", "n_hit", "items", "spans")
_SPANS = "array<struct<start_byte:int,end_byte:int>>"
_SCHEMA = f"n_words long, n_hit long, items array<string>, spans {_SPANS}"


def windows(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    """All runs of size words; the whole of fewer words, if there are any."""
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def automaton(items: list[tuple[str, bytes]], size: int):
    """Of all windows of (item_id, text); a window's value is its number of words and its items."""
    import ahocorasick

    found: dict[bytes, tuple[int, set[str]]] = {}
    for item, text in items:
        for w in windows(word_bytes(text), size):
            found.setdefault(b" " + b" ".join(w) + b" ", (len(w), set()))[1].add(item)
    a = ahocorasick.Automaton()
    for w, (n, ids) in found.items():
        a.add_word(w.decode("latin-1"), (n, tuple(ids)))
    if found:
        a.make_automaton()
    return a if found else None


def scan(text: bytes | None, a) -> tuple[int, int, list[str], list[tuple[int, int]]]:
    """Number of words and of hit words, the items, and the hit passages as byte offsets in the text as it was."""
    import numpy as np

    flat = text.translate(WORD_BYTES) if text else b""
    words = flat.split()
    if not words or a is None:
        return len(words), 0, [], []
    hits = list(a.iter((b" " + b" ".join(words) + b" ").decode("latin-1")))
    if not hits:
        return len(words), 0, [], []
    # each word begins behind a space; a hit ends on the space behind its last word
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    last = np.searchsorted(ends, [e for e, _ in hits])
    hit = np.zeros(len(words) + 1, np.int64)
    items: set[str] = set()
    for j, (_, (n, ids)) in zip(last.tolist(), hits, strict=True):
        hit[j - n + 1] += 1
        hit[j + 1] -= 1
        items.update(ids)
    covered = np.cumsum(hit[:-1]) > 0
    edge = np.diff(np.concatenate(([False], covered, [False])).astype(np.int8))
    raw = np.frombuffer(flat, np.uint8) != 32
    step = np.diff(np.concatenate(([False], raw, [False])).astype(np.int8))
    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    spans = [(int(begin[s]), int(end[e - 1])) for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
    return len(words), int(covered.sum()), sorted(items), spans


def _parts(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in parts of bounded size; they stream through the driver, one partition at a time."""
    part, held = [], 0
    rows = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string"), F.col("text").cast("binary"))
    for item, text in rows.toLocalIterator():
        if part and held + len(text) > limit:
            yield part
            part, held = [], 0
        part.append((item, bytes(text)))
        held += len(text)
    yield part


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, max_item_bytes: int = MAX_ITEM_BYTES) -> DataFrame:
    """All columns of docs with n_words, n_hit, items and spans (byte offsets of hit passages in the text as it was).

    A window is size consecutive words of an item, or all words of a shorter one; a document word inside any
    occurrence of a window is hit. Null and empty texts have no words; null items, and items without a word, have no
    window. Rows that repeat an item_id add their windows to that item; repeated documents are each scanned. An empty
    benchmark hits nothing. The four result columns replace columns of docs with the same names.

    One narrow pass without a shuffle: each worker process builds the automaton once and streams its texts through it. A
    benchmark of more than max_item_bytes is cut into several automata, each scanning all documents in turn, and the
    passages found are united; no item is left out.
    """
    spark = docs.sparkSession
    small_batches(spark)
    out = docs.drop(*_ADDED)
    names = out.columns
    schema = T.StructType([*out.schema.fields, *T._parse_datatype_string(_SCHEMA).fields])
    for k, part in enumerate(_parts(benchmark, max_item_bytes)):
        out = out.mapInArrow(_pass(spark.sparkContext.broadcast((uuid.uuid4().hex, part)), size, names, again=k > 0), schema)
    return out


_built: dict[str, object] = {}


def _once(told, size: int):
    """The automaton of a broadcast part, built once in a worker process, which serves many tasks."""
    key, items = told.value
    if key not in _built:
        while len(_built) > 3:
            _built.pop(next(iter(_built)))
        _built[key] = automaton(items, size)
    return _built[key]


def _pass(told, size: int, names: list[str], again: bool):
    """One scan for one automaton; again: the rows already carry what earlier automata found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = _once(told, size)
        for b in batches:
            texts = b.column(names.index("text")).cast(pa.binary()).to_pylist()
            found = [scan(t, a) for t in texts]
            if again:
                was = zip(*(b.column(len(names) + i).to_pylist() for i in range(4)), strict=True)
                found = [_united(t, (w[0], w[1], w[2], [(s["start_byte"], s["end_byte"]) for s in w[3]]), f) for t, w, f in zip(texts, was, found, strict=True)]
            spans = pa.array([[{"start_byte": s, "end_byte": e} for s, e in f[3]] for f in found], pa.list_(pa.struct([("start_byte", pa.int32()), ("end_byte", pa.int32())])))
            new = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.list_(pa.string())), spans]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], *new], [*names, *_ADDED])

    return run


def _united(text: bytes | None, x: tuple, y: tuple) -> tuple:
    spans: list[tuple[int, int]] = []
    for s, e in sorted(x[3] + y[3]):
        if spans and s <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], e))
        else:
            spans.append((s, e))
    hit = sum(len(word_bytes(text[s:e])) for s, e in spans)
    return x[0], hit, sorted({*x[2], *y[2]}), spans


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of decontaminate() over documents and benchmark; rows, nulls and ties as there."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH dw AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), bw AS MATERIALIZED (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + 10], ' ') AS g
  FROM (SELECT item, w, unnest(range(greatest(1, len(w) - 9))) AS i FROM bw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win
), pos AS (
  SELECT doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM dw, sizes WHERE len(w) >= n)
), hits AS MATERIALIZED (
  SELECT p.doc_id, p.i, p.n, w.item FROM pos p JOIN win w ON w.n = p.n AND w.g = p.g
), hw AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id
), hi AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
