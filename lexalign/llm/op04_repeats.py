"""Long repeated strings, found in corpus order by prefix-free parsing, and cut from all places but the first."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, table, written

#: Bytes of a repeated string, and of a trigger.
LENGTH, TRIGGER = 100, 32
#: Phrases with one trigger that are sorted together; triggers with more go the way of single strings.
HOT_HERE, HOT = 64, 1024
_FLUSH, _SEGMENT, _PLACE = 2_000_000, 1 << 22, np.uint64(0xFFFFFF)
#: Bytes of dictionary phrases that one suffix array is built over; those of a trigger stay together.
_SLAB = 1 << 22
_NO_ID = -(2**63)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]

# Kinds of rows between the steps; a text row sorts behind the others.
PHRASE, REPEAT, ASK, UNIT, STRING, TEXT = range(6)
_TYPES = {
    PHRASE: ("<u8", "<u8", "<i8", "<u4", "<u4", "u1", "u1"),  # trigger, content, doc, tag, start, strings, hot
    REPEAT: ("<i8", "<u4", "<u4", "<u4"),  # doc, tag, start, bytes
    ASK: ("<i8", "<u4", "<u4", "u1", "u1", "<u8"),  # doc, tag, start, strings, hot, trigger
    UNIT: ("<i8", "<u4", "<u4", "u1", "<u8"),  # doc, tag, start, strings, trigger; their bytes follow
    STRING: ("<u8", "<u8", "<i8", "<u4", "<u4"),  # hash, trigger, doc, tag, start
}
_SCHEMA = "bucket int, kind int, data binary"


def pack(kind: int, *cols: np.ndarray, more: bytes = b"") -> bytes:
    """Columns as compressed bytes, each column's bytes by significance."""
    n = len(cols[0])
    raw = b"".join(np.ascontiguousarray(c.astype(t).view(np.uint8).reshape(n, -1).T).tobytes() for c, t in zip(cols, _TYPES[kind], strict=True)) + more
    return n.to_bytes(8, "little") + len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(kind: int, data: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    raw = np.frombuffer(pa.decompress(data[16:], int.from_bytes(data[8:16], "little"), codec="zstd", asbytes=True), np.uint8)
    cols, at = [], 0
    for t in _TYPES[kind]:
        w = np.dtype(t).itemsize
        cols.append(np.ascontiguousarray(raw[at : at + n * w].reshape(w, n).T).reshape(-1).view(t))
        at += n * w
    return cols, raw[at:]


def _joined(kind: int, blobs: list[bytes]) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*(unpack(kind, b)[0] for b in blobs), strict=True)]


def hashes(raw: np.ndarray, length: int, trigger: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all runs of trigger and of length bytes, by doubling."""
    with np.errstate(over="ignore"):
        level = (raw.astype(np.uint64) + np.uint64(1)) * _ODD[5]
        short = full = None
        width, taken, k = 1, 0, 0
        need = {w for w in (1 << i for i in range(40)) if w & length}
        low = {w for w in (1 << i for i in range(40)) if w & trigger}
        n_full, n_short = len(raw) - length + 1, len(raw) - trigger + 1
        taken_short = 0
        while True:
            if width in need:
                part = level[taken : taken + n_full]
                full = part.copy() if full is None else full * _ODD[(k + 1) % 7] + part
                taken += width
            if width in low:
                part = level[taken_short : taken_short + n_short]
                short = part.copy() if short is None else short * _ODD[(k + 2) % 7] + part
                taken_short += width
            if width * 2 > max(length, trigger):
                break
            level = level[:-width] * _ODD[k % 7] + level[width:]
            level ^= level >> np.uint64(29)
            width, k = width * 2, k + 1
        for h in (short, full):
            h ^= h >> np.uint64(32)
            h *= _ODD[1]
            h ^= h >> np.uint64(29)
    return short, full


def _least(a: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        a = np.minimum(a[:-done], a[done:])
        done *= 2
    rest = width - done
    return np.minimum(a[: len(a) - rest], a[rest:]) if rest else a


def phrases(raw: np.ndarray, length: int = LENGTH, trigger: int = TRIGGER) -> tuple[np.ndarray, ...]:
    """The phrases of a text: (trigger hash, content hash, first start, number of strings).

    A string of length bytes has as its trigger the run of trigger bytes with the least rolling hash in it, the
    leftmost of equals; so every string has one, and like strings have like triggers at like places. A phrase is the
    strings in a row with the same trigger; its content is theirs, from the first byte of the first string to the
    last of the last.
    """
    n = len(raw) - length + 1
    out: list[tuple[np.ndarray, ...]] = []
    for at in range(0, n, _SEGMENT):  # places in a segment fit the low bits
        part = raw[at : min(len(raw), at + _SEGMENT + length - 1)]
        short, full = hashes(part, length, trigger)
        place = (_least((short & ~_PLACE) | np.arange(len(short), dtype=np.uint64), length - trigger + 1) & _PLACE).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1))
        stop = np.concatenate((first[1:], [len(place)]))
        with np.errstate(over="ignore"):
            content = full[first] * _ODD[2] + full[stop - 1] * _ODD[3] + (stop - first).astype(np.uint64)
        content ^= content >> np.uint64(32)
        out.append((short[place[first]], content, first + at, stop - first))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _doc_bucket(doc: np.ndarray, tag: np.ndarray, buckets: int) -> np.ndarray:
    return (doc ^ (tag.astype(np.int64) * 40503)) % buckets


def _dealt(kind: int, bucket: np.ndarray, cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A packed row for each bucket."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bucket, cols = bucket[order], [c[order] for c in cols]
    cut = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]))
    data = [pack(kind, *(c[s:e] for c in cols)) for s, e in zip(cut[:-1], cut[1:], strict=True)]
    yield _rows(bucket[cut[:-1]], kind, data)


def _rows(bucket, kind: int, data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(bucket), pa.int32()), pa.array(np.full(len(data), kind), pa.int32()), pa.array(data, pa.binary())], ["bucket", "kind", "data"])


def _resolve(cols: list[np.ndarray], here: bool, hot_from: int, length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Of the phrases at hand: those that an earlier phrase repeats whole are repeats.

    here: more phrases come from elsewhere, so what is left is dealt on by trigger, but for triggers with many phrases,
    of which one goes, marked hot; else, phrases that share their trigger with others are asked about.
    """
    trigger, content, doc, tag, start, n, hot = cols
    order = np.lexsort((tag, start, doc, content, trigger))
    trigger, content, doc, tag, start, n, hot = (c[order] for c in (trigger, content, doc, tag, start, n, hot))
    new_trigger = np.concatenate(([True], trigger[1:] != trigger[:-1]))
    new = new_trigger | np.concatenate(([True], content[1:] != content[:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    same_place = (doc == doc[first]) & (start == start[first])
    repeat = ~same_place
    kept = new | (same_place & (tag != tag[first]))
    yield from _dealt(REPEAT, _doc_bucket(doc[repeat], tag[repeat], buckets), [doc[repeat], tag[repeat], start[repeat], n[repeat].astype(np.uint32) + (length - 1)])
    group = np.cumsum(new_trigger) - 1
    several = np.bincount(group, new)
    heat = np.bincount(group, hot) > 0
    many = ((several > hot_from) | heat)[group]
    asked = kept & (hot == 0) & (many if here else ((several > 1)[group] | many))
    yield from _dealt(ASK, _doc_bucket(doc[asked], tag[asked], buckets), [doc[asked], tag[asked], start[asked], n[asked], many[asked].astype(np.uint8), trigger[asked]])
    if here:
        sent = (kept & ~many) | (new_trigger & many)
        yield from _dealt(PHRASE, (trigger[sent] % np.uint64(buckets)).astype(np.int64), [trigger[sent], content[sent], doc[sent], tag[sent], start[sent], n[sent], many[sent].astype(np.uint8)])


def _parse(length: int, trigger: int, buckets: int, hot: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            yield from _resolve([np.concatenate(x) for x in zip(*held, strict=True)], True, hot, length, buckets)

        for b in batches:
            for doc, tag, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if len(text) < length:
                    continue
                t, c, s, n = phrases(np.frombuffer(text, np.uint8), length, trigger)
                held.append((t, c, np.full(len(t), doc, np.int64), np.full(len(t), tag, np.uint32), s.astype(np.uint32), n.astype(np.uint8), np.zeros(len(t), np.uint8)))
                size += len(t)
                if size > _FLUSH:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


def _dictionary(length: int, buckets: int, hot: int):
    """For partitions that hold all phrases of a trigger: the dictionary's part of the corpus order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in batches:
            for bucket, kind, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if kind == PHRASE:
                    held.append(data)
                else:
                    yield _rows([bucket], kind, [data])
        if held:
            yield from _resolve(_joined(PHRASE, held), False, hot, length, buckets)

    return run


def _by_doc(cols: list[np.ndarray]) -> tuple[list[np.ndarray], dict[tuple[int, int], tuple[int, int]]]:
    """The rows by (doc, tag), and where each such pair's rows are."""
    order = np.lexsort((cols[1], cols[0]))
    cols = [c[order] for c in cols]
    cut = np.concatenate(([0], np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1].astype(np.int64)) != 0)) + 1, [len(order)]))
    return cols, {(int(cols[0][s]), int(cols[1][s])): (s, e) for s, e in zip(cut[:-1], cut[1:], strict=True)}


def _meet(batches: Iterator[pa.RecordBatch], kind: int, other) -> Iterator[tuple]:
    """(doc, tag, text, the doc's columns of kind or None); rows of other kinds go to other(bucket, kind, data)."""
    bucket, blobs, cols, where = None, [], None, {}
    for b in batches:
        for now, k, data, doc, tag, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if now != bucket:
                bucket, blobs, cols, where = now, [], None, {}
            if k == kind:
                blobs.append(data)
            elif k != TEXT:
                other(now, k, data)
            else:
                if blobs:
                    cols, where = _by_doc(_joined(kind, blobs))
                    blobs = []
                at = where.get((doc, tag))
                yield doc, tag, text, [c[at[0] : at[1]] for c in cols] if at else None


def _read_asked(length: int, trigger: int, buckets: int):
    """Texts meet what is asked about them: phrases go on with their bytes, dealt by trigger; strings of hot triggers
    go on one by one, dealt by their hashes, of equal ones only the first here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units: list[tuple[list[np.ndarray], bytes]] = []
        strings: list[list[np.ndarray]] = []
        passed: list[pa.RecordBatch] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if units:
                cols = [np.concatenate(x) for x in zip(*(u for u, _ in units), strict=True)]
                raw = np.frombuffer(b"".join(r for _, r in units), np.uint8)
                ends = np.cumsum(cols[3].astype(np.int64) + length - 1)
                bucket = (cols[4] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                    more = b"".join(raw[ends[i] - int(cols[3][i]) - length + 1 : ends[i]].tobytes() for i in part)
                    yield _rows([bucket[part[0]]], UNIT, [pack(UNIT, *(c[part] for c in cols), more=more)])
            if strings:
                h, t, doc, tag, start = (np.concatenate(x) for x in zip(*strings, strict=True))
                order = np.lexsort((tag, start, doc, t, h))
                h, t, doc, tag, start = (c[order] for c in (h, t, doc, tag, start))
                repeat, kept = _later(h, t, doc, tag, start)
                yield from _string_repeats(doc[repeat], tag[repeat], start[repeat], length, buckets)
                yield from _dealt(STRING, (h[kept] % np.uint64(buckets)).astype(np.int64), [c[kept] for c in (h, t, doc, tag, start)])

        for _, _, text, asked in _meet(batches, ASK, lambda bucket, kind, data: passed.append(_rows([bucket], kind, [data]))):
            yield from passed
            passed.clear()
            if asked is None:
                continue
            order = np.lexsort((asked[3], asked[2]))
            doc, tag, start, n, hot, trig = (c[order] for c in asked)
            keep = np.concatenate(([True], (np.diff(start.astype(np.int64)) != 0) | (np.diff(n.astype(np.int64)) != 0)))
            doc, tag, start, n, hot, trig = (c[keep] for c in (doc, tag, start, n, hot, trig))
            cold = hot == 0
            if cold.any():
                units.append(([doc[cold], tag[cold], start[cold], n[cold], trig[cold]], b"".join(text[s : s + k + length - 1] for s, k in zip(start[cold].tolist(), n[cold].tolist(), strict=True))))
                size += len(units[-1][1])
            for s, k, d, g, t in zip(start[~cold].tolist(), n[~cold].tolist(), doc[~cold], tag[~cold], trig[~cold], strict=True):
                h = hashes(np.frombuffer(text[s : s + k + length - 1], np.uint8), length, trigger)[1]
                strings.append([h, np.full(k, t, np.uint64), np.full(k, d, np.int64), np.full(k, g, np.uint32), np.arange(s, s + k, dtype=np.uint32)])
                size += 32 * k
            if size > 1 << 25:
                yield from flush()
                units, strings, size = [], [], 0
        yield from passed
        yield from flush()

    return run


def _later(h, t, doc, tag, start) -> tuple[np.ndarray, np.ndarray]:
    """Of strings sorted by (h, t, doc, start, tag): those that start later than the first of their equals; the firsts."""
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])))
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    same = (doc == doc[first]) & (start == start[first])
    return ~same, new | (same & (tag != tag[first]))


def _string_repeats(doc, tag, start, length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Repeated strings as runs of bytes."""
    if not len(doc):
        return
    order = np.lexsort((start, tag, doc))
    doc, tag, start = doc[order], tag[order], start[order].astype(np.int64)
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (start[1:] > start[:-1] + 1)))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(doc)])) - 1
    yield from _dealt(REPEAT, _doc_bucket(doc[first], tag[first], buckets), [doc[first], tag[first], start[first], start[last] - start[first] + length])


def suffix_ranks(raw: np.ndarray, length: int) -> np.ndarray:
    """Rank of the length bytes from each place on, in byte order; equal strings have equal ranks.

    A suffix array bounded to length bytes, by prefix doubling: ranks of w bytes give those of 2w, the last step overlaps.
    Bytes are compared, no hashes.
    """
    n = len(raw) - length + 1
    if n <= 0:
        return np.empty(0, np.int64)
    width = min(8, length)
    word = np.zeros(len(raw) - width + 1, np.uint64)
    for k in range(width):
        word = (word << np.uint64(8)) | raw[k : k + len(word)]
    rank = np.unique(word, return_inverse=True)[1]
    while width < length:
        step = min(width, length - width)
        first = rank[: len(rank) - step].astype(np.uint64)
        rank = np.unique((first << np.uint64(32)) | rank[step:].astype(np.uint64), return_inverse=True)[1]
        width += step
    return rank


def _slab_repeats(units: list[np.ndarray], begin: np.ndarray, raw: np.ndarray, length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Repeats within phrases (doc, tag, start, strings; their bytes from begin on in raw) that hold whole triggers."""
    doc, tag, start, n = units
    size = n + length - 1
    own = raw[np.repeat(begin, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
    each = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
    rank = suffix_ranks(own, length)[np.repeat(np.cumsum(size) - size, n) + inner]
    doc, tag, start = doc[each], tag[each], (start[each] + inner).astype(np.uint32)
    order = np.lexsort((tag, start, doc, rank))
    rank, doc, tag, start = (c[order] for c in (rank, doc, tag, start))
    repeat, _ = _later(rank, rank, doc, tag, start)
    yield from _string_repeats(doc[repeat], tag[repeat], start[repeat], length, buckets)


def _order(length: int, buckets: int, slab: int = _SLAB):
    """For partitions that hold all phrases of a trigger, or all equal strings of hot triggers: all but the first of equal
    strings are repeats. Phrases are put in corpus order by suffix arrays of bounded size, whole triggers in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings: list[list[np.ndarray]] = []
        units: list[list[np.ndarray]] = []
        raws: list[np.ndarray] = []
        for b in batches:
            for bucket, kind, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if kind == STRING:
                    strings.append(unpack(STRING, data)[0])
                elif kind == UNIT:
                    cols, raw = unpack(UNIT, data)
                    units.append(cols)
                    raws.append(raw)
                else:
                    yield _rows([bucket], kind, [data])
        if units:
            doc, tag, start, n, trig = (np.concatenate(x) for x in zip(*units, strict=True))
            n, raw = n.astype(np.int64), np.concatenate(raws)
            units, raws = [], []
            size = n + length - 1
            begin = np.cumsum(size) - size
            order = np.argsort(trig, kind="stable")
            trig, done = trig[order], np.cumsum(size[order])
            cut = np.concatenate((np.flatnonzero(trig[1:] != trig[:-1]) + 1, [len(trig)]))  # ends of triggers
            at = 0
            while at < len(order):
                base = done[at - 1] if at else 0
                last = int(np.searchsorted(done[cut - 1], base + slab, "right"))
                stop = int(cut[max(last - 1, int(np.searchsorted(cut, at, "right")))])
                part = order[at:stop]
                yield from _slab_repeats([c[part] for c in (doc, tag, start, n)], begin[part], raw, length, buckets)
                at = stop
        if strings:
            h, t, doc, tag, start = (np.concatenate(x) for x in zip(*strings, strict=True))
            order = np.lexsort((tag, start, doc, t, h))
            h, t, doc, tag, start = (c[order] for c in (h, t, doc, tag, start))
            repeat, _ = _later(h, t, doc, tag, start)
            yield from _string_repeats(doc[repeat], tag[repeat], start[repeat], length, buckets)

    return run


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0

        def rows() -> pa.RecordBatch:
            doc, n, gone, spans, sha, kept = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array([None if d == _NO_ID else d for d in doc], pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

        for doc, _, text, found in _meet(batches, REPEAT, lambda *_: None):
            kept, spans = text, 0
            if found is not None:
                edge = np.zeros(len(text) + 1, np.int64)
                np.add.at(edge, found[2].astype(np.int64), 1)
                np.add.at(edge, found[2].astype(np.int64) + found[3].astype(np.int64), -1)
                stay = np.cumsum(edge[:-1]) == 0
                spans = int(np.count_nonzero(np.diff(np.concatenate(([False], ~stay)).astype(np.int8)) == 1))
                kept = np.frombuffer(text, np.uint8)[stay].tobytes()
            out.append((doc, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
            size += len(kept)
            if len(out) >= 2000 or size > 1 << 24:
                yield rows()
                out, size = [], 0
        if out:
            yield rows()

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, trigger: int = TRIGGER, with_text: bool = True, hot_here: int = HOT_HERE, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (binary; null if not with_text) of each row of docs.

    Removed is each byte within a string of length bytes that also starts earlier: in a smaller doc_id, or before in
    the same one. Strings are judged on the texts as given, may overlap, and do not cross texts. Null and empty texts
    have no bytes. A null doc_id comes before all others; rows with the same doc_id count as one document's, where a
    start at the same offset is not earlier, so repeated rows are treated alike. An empty table gives no rows; other
    columns play no part.

    Prefix-free parsing, bounded to length bytes and dealt to many tasks: rolling-hash triggers cut the texts into
    phrases that overlap, so that each string lies in one phrase (phrases()). The parse is one small record a phrase;
    as no string reaches beyond its phrase, the order of equal strings is that of their phrases' places, and nothing
    behind a phrase has to be ranked. Equal phrases are found first, in each task and then by trigger: all but the first
    are repeats whole, so copies cost a record, however long they are. Of the dictionary of distinct phrases only those
    whose trigger occurs in others hold strings that may repeat; suffix arrays over their bytes, whole triggers in each,
    put these strings in corpus order, equal ones side by side (suffix_ranks()). Triggers with more than hot phrases are
    dealt out string by string instead, first occurrences of each task only; in the first step a task sends one phrase
    of a trigger of which it has many. So no trigger gathers in one task. Whole phrases of one trigger are told apart by
    64 bits of their contents' hash, the single strings of hot triggers by 64 bits beside the trigger's 64, all else by
    its bytes. Each of the three steps ends in a table in the shared folder.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = parts  # a bucket is a partition, so a task writes a row of each kind for each partition at most
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)).alias("tag"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    texts = own.select(F.pmod(F.col("doc").bitwiseXOR(F.col("tag") * F.lit(40503)), F.lit(buckets)).cast("int").alias("bucket"), F.lit(TEXT).alias("kind"), F.lit(None).cast("binary").alias("data"), "doc", "tag", "text")

    def meeting(found: DataFrame) -> DataFrame:
        both = texts.unionByName(found.select("bucket", "kind", "data", F.lit(None).cast("long").alias("doc"), F.lit(None).cast("long").alias("tag"), F.lit(None).cast("binary").alias("text")))
        return both.repartitionById(parts, "bucket").sortWithinPartitions("bucket", "kind")

    def step(df: DataFrame) -> DataFrame:
        return written(spark, df, "repeats", settle=True)

    parsed = own.mapInArrow(_parse(length, trigger, buckets, hot_here), _SCHEMA)
    first = step(parsed.repartitionById(parts, "bucket").mapInArrow(_dictionary(length, buckets, hot), _SCHEMA))
    asked = meeting(first).mapInArrow(_read_asked(length, trigger, buckets), _SCHEMA)
    second = step(asked.repartitionById(parts, "bucket").mapInArrow(_order(length, buckets), _SCHEMA))
    return meeting(second).mapInArrow(_cut(with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of remove_repeats() over documents, with its defaults; rows, nulls and ties as there."""
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


ORACLE = """
WITH d AS MATERIALIZED (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
), p AS MATERIALIZED (
  SELECT doc_id, i, CASE WHEN i + 100 <= length(h) // 2 THEN substr(h, 2 * i + 1, 200) END AS s, substr(h, 2 * i + 1, 2) AS b
  FROM (SELECT doc_id, h, unnest(range(length(h) // 2)) AS i FROM d)
), r AS (
  SELECT doc_id, i, b, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1 AS later FROM p
), c AS (
  SELECT doc_id, i, b, coalesce(i - max(CASE WHEN later THEN i END) OVER (PARTITION BY doc_id ORDER BY i) < 100, false) AS gone FROM r
), e AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM c
), a AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans, string_agg(b, '' ORDER BY i) FILTER (NOT gone) AS kept FROM e GROUP BY doc_id
)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN a USING (doc_id)
"""
