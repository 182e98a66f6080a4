"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, table, word_bytes
from .learn import calibrated, fold, label_sample, platt, sampled_texts

#: Labelled documents of each class in the index, neighbours that vote, documents whose own votes calibrate the scores.
SAMPLE, NEIGHBOURS, CALIBRATE = 3000, 15, 600
#: Documents in a block of a long posting list, and documents that a search completes first.
BLOCK, FIRST = 8, 64
#: A list is long if it holds more than this share of the documents.
LONG = 1 / 8
#: Characters of the word beginnings and ends that are terms beside whole words.
AFFIXES = (4, 5, 6)
#: Weight of the prior against the neighbours' votes, which weigh 1 / (DISTANCE + 1 - cosine).
PRIOR, DISTANCE = 0.5, 0.1
#: Weight of a plain word against that of a term that tells the label.
PLAIN = 0.15
#: Words whose terms a task remembers.
_KNOWN = 200_000
_EVIDENCE = "array<struct<doc_id:long,cosine:double,toxic:int>>"


def terms_of(words: set[str]) -> set[str]:
    """Whole words, and beginnings and ends of longer ones; a blank marks a word's edge."""
    out = set()
    for w in words:
        if w:
            out.add(f" {w} ")
            for n in AFFIXES:
                if len(w) > n:
                    out.add(f" {w[:n]}")
                    out.add(f"{w[-n:]} ")
    return out


class Index:
    """Unit TF-IDF vectors of labelled documents as posting lists, long ones in blocks, each with its greatest weight.

    A long list has a place for every document, so a block of it is looked up, not searched; all long lists together have
    at most 1 / LONG places a posting.

    terms: those that tell the label, found by an automaton; words: the place of each word behind them. vectors: a
    document's term numbers and weights.
    """

    def __init__(self, terms: list[str], words: dict[str, int], idf: np.ndarray, ids: np.ndarray, toxic: np.ndarray, weight: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], empty_rate: float):
        # like documents side by side, so that a block's greatest weights are near those of its documents
        order = sorted(range(len(vectors)), key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1])]) if len(vectors[i][0]) else -1, int(ids[i])))
        self.terms, self.words, self.idf, self.empty_rate = terms, words, idf, empty_rate
        self.ids, self.toxic, self.weight = ids[order], toxic[order], weight[order]
        self.slope, self.shift = 1.0, 0.0
        held = [vectors[i] for i in order]
        t = np.concatenate([v[0] for v in held]) if held else np.empty(0, np.int64)
        w = np.concatenate([v[1] for v in held]) if held else np.empty(0)
        place = np.repeat(np.arange(len(held)), [len(v[0]) for v in held])
        size = np.bincount(t, minlength=len(idf))
        long = np.flatnonzero(size > LONG * len(held))
        self.column = np.full(len(idf), -1)  # of a term's long list
        self.column[long] = np.arange(len(long))
        in_long = self.column[t] >= 0
        self.dense = np.zeros((len(held), len(long)))
        self.dense[place[in_long], self.column[t[in_long]]] = w[in_long]
        self.most = np.maximum.reduceat(self.dense, np.arange(0, len(held), BLOCK), axis=0) if held else self.dense
        t, w, place = t[~in_long], w[~in_long], place[~in_long]
        by = np.lexsort((place, t))
        self.w, self.place = w[by], place[by].astype(np.int32)
        self.start = np.searchsorted(t[by], np.arange(len(idf) + 1))  # of a term's short list

    def nearest(self, query: tuple[np.ndarray, np.ndarray], k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest, exactly: nearest first, ties to the smaller doc_id.

        The short lists are added up. A document can reach that sum and its block's bound, the sum of the query's weights
        times the block's greatest weights in the long lists. Documents that can reach most are completed from the long
        lists first; of the others those that can reach the k-th best cosine found.
        """
        at, weight = query
        column = self.column[at]
        short = column < 0
        begin, end = self.start[at[short]], self.start[at[short] + 1]
        post = _ranges(begin, end)
        s = np.bincount(self.place[post], np.repeat(weight[short], end - begin) * self.w[post], minlength=len(self.ids))
        own = np.zeros(self.dense.shape[1])
        own[column[~short]] = weight[~short]
        reach = s + np.repeat(self.most @ own, BLOCK)[: len(s)]
        if without is not None:
            reach[self.ids == without] = 0
        place = np.argpartition(reach, -FIRST)[-FIRST:] if len(s) > FIRST else np.arange(len(s))
        place = place[reach[place] > 0]
        cosine = s[place] + self.dense[place] @ own
        reach[place] = 0
        hit = cosine > 0
        place, cosine = self._best(place[hit], cosine[hit], k)
        rest = np.flatnonzero((reach > 0) & (reach >= (cosine[k - 1] - 1e-9 if len(cosine) >= k else 0.0)))
        if len(rest):
            more = s[rest] + self.dense[rest] @ own
            hit = more > 0
            place, cosine = self._best(np.concatenate((place, rest[hit])), np.concatenate((cosine, more[hit])), k)
        return place, cosine

    def _best(self, place: np.ndarray, cosine: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(place) > 4 * k:
            keep = cosine >= np.partition(cosine, len(cosine) - k)[len(cosine) - k] - 1e-9
            place, cosine = place[keep], cosine[keep]
        order = np.lexsort((self.ids[place], -np.round(cosine, 12)))[:k]
        return place[order], cosine[order]

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        return vector(counts, self.idf, len(self.terms))

    def vote(self, counts: dict[int, int], without: int | None = None) -> tuple[float, list[tuple[int, float, int]]]:
        """Share of toxic in the neighbours' votes, the prior among them; and the neighbours."""
        if not counts or not len(self.ids):
            return self.empty_rate, []
        at, cosine = self.nearest(self.vector(counts), NEIGHBOURS, without)
        vote = self.weight[at] / (DISTANCE + 1 - np.minimum(cosine, 1))
        own = PRIOR * float(vote.mean()) if len(vote) else 1.0
        p = (float(vote @ self.toxic[at]) + own * self.empty_rate) / (float(vote.sum()) + own)
        return min(1.0, max(0.0, p)), [(int(self.ids[i]), float(c), int(self.toxic[i])) for i, c in zip(at, cosine, strict=True)]

    def score(self, counts: dict[int, int]) -> tuple[float, list[tuple[int, float, int]]]:
        """The vote as a calibrated probability; and the neighbours."""
        p, near = self.vote(counts)
        return float(calibrated(np.array([p]), self.slope, self.shift)[0]), near


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """begin[0] to end[0] - 1, begin[1] to end[1] - 1 and so on."""
    size = end - begin
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())


def vector(counts: dict[int, int], idf: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and unit weights: count times inverse document frequency, plain words scaled by PLAIN."""
    at = np.fromiter(counts, np.int64, len(counts))
    w = np.fromiter(counts.values(), np.float64, len(counts)) * idf[at] * np.where(at < n_terms, 1.0, PLAIN)
    order = np.argsort(at)
    return at[order], w[order] / np.sqrt(w @ w)


def distinct_terms(ranked: list[str]) -> list[str]:
    """The ranked terms, each without those behind it that it holds or that hold it (by beginning or end)."""
    kept: list[str] = []
    within: set[str] = set()
    have: set[str] = set()
    for t in ranked:
        parts = {t[:i] for i in range(1, len(t) + 1)} | {t[i:] for i in range(len(t))}
        if t in within or parts & have:
            continue
        kept.append(t)
        have.add(t)
        within |= parts
    return sorted(kept)


def machine(terms: list[str]):
    """An automaton that finds all terms in a word between blanks."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for i, t in enumerate(terms):
        a.add_word(t, i)
    if terms:
        a.make_automaton()
    return a if terms else None


class Counted(dict):
    """The numbers of the terms in each word met so far: a word is looked up once, and forgotten as _KNOWN are held."""

    def __init__(self, a, places: dict[str, int]):
        super().__init__()
        self.a, self.places = a, places

    def __missing__(self, word: bytes) -> list[int]:
        w = word.decode("latin-1")
        found = [self.places[w]] if w in self.places else []
        if self.a is not None:
            found += [i for _, i in self.a.iter(f" {w} ")]
        if len(self) >= _KNOWN:
            self.clear()
        self[word] = found
        return found


def count_terms(text: bytes | None, known: Counted) -> dict[int, int]:
    """How often each term and each word of the vocabulary occurs."""
    found: dict[int, int] = {}
    for w, n in Counter(word_bytes(text)).items():
        for i in known[w]:
            found[i] = found.get(i, 0) + n
    return found


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, calibrate: int = CALIBRATE) -> Index:
    """The index of up to sample labelled documents a class outside fold 0.

    Every word of these documents is a term. Words, word beginnings and word ends that tell labels.toxic = 1 (by
    chi-square, at least four times as frequent there) are terms of full weight beside them, of those that hold one
    another only the best; so the size of the index is bounded by the sample's. Terms are counted in the cluster; the
    driver sees the sample's words and vectors. Weights of the classes restore their shares among all labelled rows.
    The votes of calibrate sampled documents, each without its own, fit the scores' calibration.

    Null and unlike labels, and labels without a document, play no part; a null text has no words. Rows that repeat a
    sampled doc_id are examples of their own. Without labels all scores are 0.5.
    """
    small_batches(docs.sparkSession)
    chosen, counts = label_sample(labels, "toxic", sample)
    texts = sampled_texts(docs, chosen).select(F.col("doc_id").cast("long").alias("doc_id"), "y", "text")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for y, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                found = list(terms_of({w.decode("latin-1") for w in word_bytes(text)}))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(np.full(len(found), y, np.int32))], ["term", "y"])

    n = {r["y"]: r["count"] for r in texts.groupBy("y").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    a, b = F.col("a"), F.col("b")
    per = texts.mapInArrow(emit, "term string, y int").groupBy("term").agg(F.sum("y").cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("b"))
    gap = a * (n0 - b) - b * (n1 - a)
    chi = gap * gap * (n0 + n1) / ((a + b) * (n0 + n1 - a - b) * max(n0, 1) * max(n1, 1))
    tells = (a >= max(3, n1 // 500)) & (a * max(n0, 1) > 4.0 * b * max(n1, 1)) & (a + b < n0 + n1) & (chi > 20)
    whole = F.col("term").startswith(" ") & F.col("term").endswith(" ")
    per = per.select("term", F.when(tells, chi).alias("chi"), whole.alias("whole")).where("whole or chi is not null")
    seen = per.toArrow().to_pylist()
    kept = distinct_terms([r["term"] for r in sorted((r for r in seen if r["chi"] is not None), key=lambda r: (-r["chi"], len(r["term"]), r["term"]))])
    places = {w: len(kept) + i for i, w in enumerate(sorted(r["term"][1:-1] for r in seen if r["whole"]))}
    told = docs.sparkSession.sparkContext.broadcast((kept, places))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, words = told.value
        known = Counted(machine(terms), words)
        for b in batches:
            got = [count_terms(t, known) for t in b.column(2).to_pylist()]
            kinds = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([list(g) for g in got], kinds), pa.array([list(g.values()) for g in got], kinds)], ["doc_id", "y", "t", "n"])

    found = texts.mapInArrow(vectors, "doc_id long, y int, t array<int>, n array<int>").toArrow().combine_chunks()
    ids, ys = found.column("doc_id").to_numpy(), found.column("y").to_numpy().astype(np.int64)
    rows = [dict(zip(t.values.to_numpy().tolist() if len(t) else [], k.values.to_numpy().tolist() if len(k) else [], strict=True)) for t, k in zip(found.column("t"), found.column("n"), strict=True)]
    order = sorted(range(len(ids)), key=lambda i: (ids[i], sorted(rows[i].items())))
    ids, ys, rows = ids[order], ys[order], [rows[i] for i in order]
    df = np.zeros(len(kept) + len(places))
    for r in rows:
        df[list(r)] += 1
    idf = np.log((1 + len(rows)) / (1 + df)) + 1
    of = {y: counts.get(y, 0) / max(1, n.get(y, 0)) for y in (0, 1)}
    plain = [not any(t < len(kept) for t in r) for r in rows]
    none = {y: of[y] * sum(1 for k, p in zip(ys, plain, strict=True) if k == y and p) for y in (0, 1)}
    rate = (none[1] + 0.5 * (sum(of.values()) > 0 and not rows or not sum(none.values()))) / max(1.0, sum(none.values()))
    weight = np.array([of[int(y)] for y in ys])
    index = Index(kept, places, idf, ids, ys, weight, [vector(r, idf, len(kept)) if r else (np.empty(0, np.int64), np.empty(0)) for r in rows], float(rate))
    some = np.unique(np.linspace(0, len(rows) - 1, min(len(rows), calibrate)).astype(int)) if len(rows) else []
    if n0 and n1:
        index.slope, index.shift = platt(np.array([index.vote(rows[i], int(ids[i]))[0] for i in some]), ys[some], weight[some])
    return index


def score(docs: DataFrame, index: Index) -> DataFrame:
    """All columns of docs with score (0 to 1, higher: toxic likelier) and evidence (the neighbours, nearest first).

    Only the text is looked at, all of it. A text without any word of the vocabulary (null and empty ones among them)
    has no neighbours and scores the share of toxic ones among examples without telling terms. Rows are scored one by
    one: repeated rows get the same score, an empty table gives no rows; without labels all scores are 0.5. Columns of
    docs named as the result's are replaced. One narrow pass; the broadcast index holds at most 2 * SAMPLE documents.
    """
    spark = docs.sparkSession
    small_batches(spark)
    out = docs.drop("score", "evidence")
    names = out.columns
    told = spark.sparkContext.broadcast(index)
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = told.value
        known = Counted(machine(own.terms), own.words)
        for b in batches:
            got = [own.score(count_terms(t, known)) for t in b.column(names.index("text")).cast(pa.binary()).to_pylist()]
            near = list(zip(*(x for _, e in got for x in e), strict=True)) or [(), (), ()]
            each = pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip(near, kind.value_type, strict=True)], fields=list(kind.value_type))
            evidence = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(e) for _, e in got)]), pa.int32()), each, kind)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([s for s, _ in got], pa.float64()), evidence], [*names, "score", "evidence"])

    schema = T.StructType([*out.schema.fields, T.StructField("score", T.DoubleType()), *T._parse_datatype_string(f"evidence {_EVIDENCE}").fields])
    return out.mapInArrow(run, schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of score() over documents, and the evidence; rows, nulls and ties as there."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
