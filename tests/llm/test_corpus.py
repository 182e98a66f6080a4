"""Each corpus operator against a brute-force version or its SQL, and on rows that are out of the ordinary."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from lexalign.llm import (
    op01_licenses,
    op02_ann,
    op03_toxicity,
    op04_repeats,
    op05_lines,
    op06_decontaminate,
    op07_quality,
    op08_reshard,
    op09_mix,
    op10_simhash,
)

SF = "/root/testdata/sf0.001"
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def odd_rows() -> list[tuple]:
    """Null cells, empty and blank texts, a null id, repeated rows, a repeated id, a very long text, clashing columns."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    return [
        (1, "", "s", 9), (2, None, None, 9), (3, " \n\t ", "s", 9), (None, "a text without an id", "t", 9), (4, long, "s", 9), (5, "one", None, 9), (5, "one", None, 9), (6, "Ünïcode ÉÀ words 😀 here", "t", 9), (6, "another text of six", "t", 9),
    ]


def odd(spark):
    rows = [(i, t, s, n, n, n) for i, t, s, n in odd_rows()]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, score int, size int, items int")


def empty(spark):
    return odd(spark).limit(0)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(t):
    return WORD.findall((t or "").translate(ASCII))


def test_licenses(spark):
    docs = spark.createDataFrame(
        [(1, "Under the MIT License, or the MIT\nlicense; not the mit licensed."), (2, "GNU general public license GNU General Public License"), (3, "permission is hereby granted free of charge to anyone obtaining a copy of this software and associated documentation files the software to deal in the software without any restriction including without limitation the rights to use copy modify merge"), (4, "gnu general public")], "doc_id long, text string"
    )
    got = {r["doc_id"]: r for r in op01_licenses.scan(docs).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"], got[1]["labels"]) == (2, 2, 6, "mit", "mit")
    assert (got[2]["n_base"], got[2]["first_word"], got[2]["last_word"], got[2]["score"]) == (2, 0, 4, 1.0)
    assert got[3]["n_base"] == 0 and got[3]["base_labels"] == "" and got[3]["labels"] == "mit" and 0.5 <= got[3]["score"] < 1
    assert (got[4]["n_base"], got[4]["first_word"], got[4]["labels"]) == (0, None, "")


def test_each_notice_has_its_own_label_only(spark):
    kin = {
        "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "cc-by-nc": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    }
    rows = [*kin.items(), ("", "this work is licensed under a creative commons deed"), ("", "is licensed under a creative is licensed under a creative " * 9)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in op01_licenses.scan(docs).collect()}
    assert [got[i] for i in range(len(rows))] == [label for label, _ in rows]


def test_licenses_odd(spark):
    got = op01_licenses.scan(odd(spark)).collect()
    assert sorted((r["doc_id"] or 0, r["n_words"]) for r in got) == sorted((i or 0, len(words(t))) for i, t, *_ in odd_rows())
    assert op01_licenses.scan(empty(spark)).count() == 0


def brute_nearest(rows, k=20, every=20):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    out = set()
    for q, v in ok.items():
        if q % every == 0:
            best = sorted((-(w * v).cumsum()[-1], i) for i, w in ok.items() if i != q)[:k]
            out |= {(q, r + 1, i) for r, (_, i) in enumerate(best)}
    return out


def test_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(70)]) for i in range(300)]
    rows += [(i, rows[20][1]) for i in range(300, 330)]  # ties
    rows += [(400, None), (401, [0.0] * 70), (402, [float("nan")] * 70), (403, [float("inf")] * 70), (404, [None] * 70), (None, rows[0][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    kept = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = {(r["query_id"], r["rank"], r["vec_id"]) for r in op02_ann.nearest(df, block_rows=100, block_queries=5).collect()}
    want = brute_nearest(kept)
    assert len(got & want) >= 0.99 * len(want) and len(got) == len(want)
    assert op02_ann.nearest(df.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in op02_ann.nearest(few).collect()] == [(0, 1, 1, 0.0)]


def test_codes_sum_from_packed_bytes():
    rng = np.random.default_rng(3)
    for d in (5, 64, 70):
        v, q = rng.standard_normal((40, d)), rng.standard_normal((7, d)).astype(np.float32)
        codes = op02_ann.Codes(v)
        signs = np.unpackbits(codes.bits, axis=1, count=d, bitorder="little").astype(float) * 2 - 1
        assert np.allclose(codes.signed_sums(q), q @ signs.T, atol=1e-4)


def test_block_max_is_exact():
    rng = random.Random(1)
    idf = np.array([rng.uniform(1, 3) for _ in range(40)])
    draw = lambda n: op03_toxicity.vector({rng.randrange(40): rng.randint(1, 4) for _ in range(n)}, idf, 12)
    vectors = [draw(rng.randint(1, 9)) for _ in range(1500)]
    dense = np.zeros((1500, 40))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    assert np.allclose(np.linalg.norm(dense, axis=1), 1)
    n = len(vectors)
    index = op03_toxicity.Index([str(i) for i in range(12)], {f"w{i}": 12 + i for i in range(28)}, idf, np.arange(n), np.zeros(n, int), np.ones(n), vectors, 0.1)
    for k in range(60):
        q = draw(5)
        leave = k if k % 2 else None
        at, cos = index.nearest(q, 15, leave)
        want = sorted((-round(float(v[q[0]] @ q[1]), 12), i) for i, v in enumerate(dense) if i != leave)[:15]
        assert [i for s, i in want if s] == index.ids[at].tolist() and np.allclose([-s for s, _ in want if s], cos)


def test_a_copy_of_an_example_is_its_nearest(spark):
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 90}" for j in range(40))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = op03_toxicity.train(docs, spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int"))
    texts = dict(rows)
    for i in index.ids[:20].tolist():  # no word tells the label here, so only plain words find the example
        near = index.vote(op03_toxicity.count_terms(texts[i].encode(), op03_toxicity.Counted(None, index.words)))[1]
        assert abs(near[0][1] - 1) < 1e-9 and i in [e[0] for e in near if abs(e[1] - 1) < 1e-9]


def held_out(spark, out, label):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    return out.join(labels, "doc_id").where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0).select("score", label).collect()


def test_toxicity_of_held_out_documents(spark):
    big, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = held_out(spark, op03_toxicity.score(big, op03_toxicity.train(big, labels)), "toxic")
    assert len(rows) > 50 and np.mean([(r["score"] >= 0.5) == r["toxic"] for r in rows]) > 0.9
    assert np.mean([(r["score"] - r["toxic"]) ** 2 for r in rows]) < 0.08


def test_calibration_keeps_order():
    from lexalign.llm.learn import calibrated, platt

    rng = np.random.default_rng(2)
    truth = rng.uniform(0.02, 0.98, 4000)
    y = (rng.random(4000) < truth).astype(float)
    off = calibrated(truth, 2.5, -1.0)  # scores that are too sure
    slope, shift = platt(off, y)
    back = calibrated(off, slope, shift)
    assert ((back - y) ** 2).mean() < ((off - y) ** 2).mean() and np.abs(back - truth).mean() < 0.03
    assert (np.diff(back[np.argsort(off)]) >= 0).all() and platt(np.empty(0), np.empty(0)) == (1.0, 0.0)


def test_toxicity(spark):
    rng = random.Random(2)
    plain = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(800):
        w = rng.choices(plain, k=60)
        y = int(rng.random() < 0.2)
        if y:
            w[5], w[30] = rng.choice(["vilexa", "vilexon"]), "foulish"
        rows.append((i, " ".join(w)))
        labels.append((i, y))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    index = op03_toxicity.train(docs, lab)
    got = {r["doc_id"]: r for r in op03_toxicity.score(docs, index).collect()}
    assert all((got[i]["score"] >= 0.5) == y for i, y in labels)
    assert all(e["toxic"] in (0, 1) for e in next(got[i]["evidence"] for i, y in labels if y))
    out = op03_toxicity.score(odd(spark), index).collect()
    assert len(out) == len(odd_rows()) and all(0 <= r["score"] < 0.5 for r in out)
    none = op03_toxicity.train(docs, lab.limit(0))
    assert {r["score"] for r in op03_toxicity.score(odd(spark), none).collect()} == {0.5}
    assert op03_toxicity.score(empty(spark), index).count() == 0


def brute_repeats(rows, length):
    seen, out = {}, []
    data = sorted((-(2**63) if i is None else i, (t or "").encode()) for i, t in rows)
    for i, b in data:
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            seen[s] = min(seen.get(s, (i, p)), (i, p))
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] < (i, p):
                gone[p : p + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((None if i == -(2**63) else i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("hot_here", "hot"), [(64, 1024), (1, 1), (2, 1024)])
def test_repeats(spark, hot_here, hot):
    rng = random.Random(3)
    def prose(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    passages = [prose(rng.randint(90, 400)) for _ in range(6)]
    rows = [(i, prose(rng.randint(0, 200)) + "".join(rng.choice(passages) + prose(rng.randint(0, 60)) for _ in range(rng.randint(0, 4)))) for i in range(60)]
    rows += [(100 + i, rows[7][1]) for i in range(5)] + [(200, "ab" * 400), (201, "x" * 100), (202, "x" * 101), (None, passages[0]), (300, None), (301, ""), (302, rows[9][1]), (302, rows[9][1])]
    rows += [(303, passages[1] + "p"), (303, passages[1] + "q" + passages[2])]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_spans int").repartition(5)
    got = sorted((tuple(r)[:5] for r in op04_repeats.remove_repeats(df, hot_here=hot_here, hot=hot).collect()), key=str)
    assert got == brute_repeats(rows, 100)


def test_repeats_keep_the_rest(spark):
    r = op04_repeats.remove_repeats(spark.createDataFrame([(1, "a" * 250), (2, "zz" + "a" * 120 + "yy")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [bytes(x["kept"]) for x in r] == [b"a", b"zzyy"]
    assert op04_repeats.remove_repeats(empty(spark)).count() == 0


def test_repeats_with_like_low_hash_bits(spark):
    # one trigger, and contents whose hashes agree in their low 32 bits
    rows = [(i, f"{i:016d}the constant part of a templated line, sixty-eight bytes in all, it {i * 7919:016d}") for i in (7645, 9047)]
    (t, c), (u, d) = (x[:2] for x in (op04_repeats.phrases(np.frombuffer(r[1].encode(), np.uint8)) for r in rows))
    assert t[0] == u[0] and int(c[0]) % 2**32 == int(d[0]) % 2**32
    got = sorted((tuple(r)[:5] for r in op04_repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute_repeats(rows, 100)


def test_repeats_spare_unlike_texts_of_one_trigger(spark):
    one = "ltfzjdqzzixgjztliwqvxedznpzzksdgqevkonxxrdjgerunekzttohsamliqbktzlujysgcasunjjidvgwopbkldicqietbueximotsbpslvvfzdfzhfjxzlocvnxkwmmbsiqbhfxfhfmylxfdvrirtdmrstsfugievnpgb"
    two = "ttkqutttqeezmggufzfajuqspvecxqgvrnnqrdoybqjrkrnpvvlubtxgjblxflqntymnysgcasunjjidvgwopbkldicqietbuexihepseiywdoqthxglakbcpyltnvekgotuqhylhbzapiekznbcdwkukhxbuqhnyuwqxfxz"
    out = op04_repeats.remove_repeats(spark.createDataFrame([(1, one), (2, two), (3, "x" + two)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in out] == [0, 0, len(two)]


def test_suffix_ranks_are_in_byte_order():
    rng = np.random.default_rng(9)
    for length in (3, 8, 20, 100):
        raw = rng.integers(0, 3, 700).astype(np.uint8)
        raw[300:500] = raw[100:300]
        strings = [raw[i : i + length].tobytes() for i in range(len(raw) - length + 1)]
        place = {s: i for i, s in enumerate(sorted(set(strings)))}
        assert op04_repeats.suffix_ranks(raw, length).tolist() == [place[s] for s in strings]


def test_slabs_hold_whole_triggers():
    rng = np.random.default_rng(10)
    pool = [rng.integers(97, 100, 130).astype(np.uint8) for _ in range(4)]
    found = []
    for slab in (1, 500, 1 << 22):
        units = [(i, 0, 0, 31, i % 7) for i in range(40)]
        cols = [np.array(c) for c in zip(*units, strict=True)]
        data = op04_repeats.pack(op04_repeats.UNIT, *cols, more=b"".join(pool[i % 7 % 4].tobytes() for i in range(40)))
        out = op04_repeats._order(100, 3, slab)(iter([op04_repeats._rows([0], op04_repeats.UNIT, [data])]))
        got = [tuple(x) for b in out for d in b.column(2).to_pylist() for x in zip(*(c.tolist() for c in op04_repeats.unpack(op04_repeats.REPEAT, d)[0]), strict=True)]
        found.append(sorted(got))
    assert all((i, 0, 0, 130) in found[0] for i in range(7, 40)) and found[0] == found[1] and set(found[0]) <= set(found[2])


def test_long_text_in_segments(monkeypatch):
    rng = np.random.default_rng(4)
    raw = rng.integers(97, 110, 3000).astype(np.uint8)
    whole = op04_repeats.phrases(raw)
    monkeypatch.setattr(op04_repeats, "_SEGMENT", 700)
    parts = op04_repeats.phrases(raw)
    assert parts[3].sum() == whole[3].sum() == len(raw) - 99
    assert set(whole[0].tolist()) == set(parts[0].tolist())


def brute_lines(rows):
    keys = {}
    lines = [(i, t, (t or "").split("\n")) for i, t in rows]
    def key(x):
        return x.strip(" \t\n\x0b\x0c\r").translate(ASCII)

    low = -(2**63)
    for i, _, ls in lines:
        for k in {key(x) for x in ls}:
            if len(k) >= 40:
                keys.setdefault(k, set()).add(low if i is None else i)
    out = []
    for i, _, ls in lines:
        kept = [x for x in ls if not (len(key(x)) >= 40 and len(keys[key(x)]) >= 5 and (low if i is None else i) < max(keys[key(x)]))]
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_lines(spark):
    a, b = "A line that is shared by many of the documents here", "é" * 40
    rows = [(i, f"x\n  {a.upper()} \n{i}\n{a}") for i in range(6)] + [(i, b) for i in range(10, 14)] + [(20, b + "\n" + b), (None, a), (21, a[:39]), (30, None), (31, "\n\n"), (5, f"x\n  {a.upper()} \n5\n{a}")]
    rows += [(i, t) for i, t, *_ in odd_rows()]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, keys int")
    got = sorted((tuple(r) for r in op05_lines.dedup_lines(df).collect()), key=str)
    assert got == brute_lines(rows)
    assert op05_lines.dedup_lines(empty(spark)).count() == 0


@pytest.mark.parametrize("limit", [10**6, 1])
def test_decontaminate(spark, limit):
    items = [(1, " ".join(f"q{i}" for i in range(14))), (2, "Short item, three"), (3, ""), (4, None), (None, "null id words"), (5, " ".join(f"q{i}" for i in range(3, 13)))]
    text = "Intro: Q0 q1, q2 q3 q4 q5 q6 q7 q8 q9 q10-q11 q12 end. SHORT ITEM... three! short items three"
    docs = spark.createDataFrame([(1, text, 0), (2, None, 0), (3, "q0 q1 q2", 0)], "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in op06_decontaminate.decontaminate(docs, bench, max_item_bytes=limit).collect()}
    assert (got[1]["n_words"], got[1]["n_hit"], got[1]["items"]) == (len(words(text)), 13 + 3, ["1", "2", "5"])
    spans = [text.encode()[s["start_byte"] : s["end_byte"]].decode() for s in got[1]["spans"]]
    assert spans == ["Q0 q1, q2 q3 q4 q5 q6 q7 q8 q9 q10-q11 q12", "SHORT ITEM... three"]
    assert (got[2]["n_words"], got[2]["n_hit"]) == (0, 0) and got[3]["n_hit"] == 0
    assert op06_decontaminate.decontaminate(odd(spark), bench).count() == len(odd_rows())
    assert op06_decontaminate.decontaminate(odd(spark), bench.limit(0)).where("n_hit > 0").count() == 0
    assert op06_decontaminate.decontaminate(empty(spark), bench).count() == 0


def test_chain_marginals():
    rng = np.random.default_rng(6)
    chain = op07_quality.Chain(np.zeros(3), rng.standard_normal((2, 2)), np.zeros(2), np.ones(2))
    lengths = np.array([1, 5, 3])
    push = np.exp(rng.standard_normal(9))
    got = chain.marginals(push, lengths)
    m, at = np.exp(chain.moves), 0
    for n in lengths:
        total, good = 0.0, np.zeros(n)
        for code in range(2**n):
            y = [code >> i & 1 for i in range(n)]
            w = np.prod([push[at + i] if y[i] else 1.0 for i in range(n)]) * np.prod([m[y[i], y[i + 1]] for i in range(n - 1)])
            total += w
            good += w * np.array(y)
        assert np.allclose(got[at : at + n], good / total)
        at += n


def test_chain_gradient():
    rng = np.random.default_rng(7)
    x, lengths, y = rng.standard_normal((9, 2)), np.array([1, 5, 3]), np.array([1.0, 0.0, 1.0])
    theta = rng.standard_normal(3 + 4 + 1)

    def value(t):
        chain = op07_quality.Chain(t[:3], t[3:7].reshape(2, 2), np.zeros(2), np.ones(2))
        return chain.likelihood(chain.push(x), lengths, t[7], y)

    _, line, moves, bias = value(theta)
    got = np.concatenate((np.c_[x, np.ones(9)].T @ line, moves, [bias]))
    want = [(value(theta + 1e-5 * e)[0] - value(theta - 1e-5 * e)[0]) / 2e-5 for e in np.eye(8)]
    assert np.allclose(got, want, atol=1e-6)


def test_bad_lines_in_good_documents_are_found():
    rng = random.Random(11)
    good = lambda: " ".join(rng.choice(["the", "weather", "turned", "and", "people", "went", "home", "early"]) for _ in range(9)).capitalize() + "."
    bad = lambda: "".join(rng.choice("#$%|=<>{}") for _ in range(30)) + " BUY NOW!!! NOW!!!"
    sequences, sizes, labels, marks = [], [], [], []
    for i in range(300):
        y = i % 2
        mark = [int(rng.random() < (0.85 if y else 0.2)) for _ in range(rng.randint(3, 12))]
        x, size = op07_quality.line_features("\n".join(good() if m else bad() for m in mark).encode())
        sequences.append(x), sizes.append(size), labels.append(y), marks.append(mark)
    model = op07_quality.fit(sequences, sizes, labels)
    inside = [(p > 0.5, m) for x, y, mark in zip(sequences, labels, marks, strict=True) if y for p, m in zip(model.marginals(model.push(x), np.array([len(x)])), mark, strict=True)]
    assert np.mean([p == m for p, m in inside]) > 0.95 and 100 < sum(1 - m for _, m in inside)


def test_spread():
    assert op07_quality.spread(7, 10, 5).tolist() == list(range(7))
    at = op07_quality.spread(1000, 100, 20)
    assert len(at) == 100 and at[0] == 0 and at[-1] == 999 and at.max() < 1000


def test_line_features_of_a_long_line():
    x, size = op07_quality.line_features(b"again Again other " * 300_000 + b"\n\nend")
    assert size.tolist() == [5_400_000, 0, 3] and abs(x[0, 8] - 1 / 3) < 1e-3 and x[1, 1] == 1


def test_quality(spark):
    docs = documents(spark)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = op07_quality.train(big, labels)
    held = held_out(spark, op07_quality.score(big, model), "quality")
    assert np.mean([(r["score"] >= 0.3) == r["quality"] for r in held]) > 0.95
    rows = op07_quality.score(odd(spark), model).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(len(r["line_scores"]) == (r["text"] or "").count("\n") + 1 for r in rows)
    assert op07_quality.score(empty(spark), model).count() == 0
    assert {r["score"] for r in op07_quality.score(docs, op07_quality.train(docs, labels.limit(0))).collect()} == {0.5}


def test_flow_is_least():
    rng = random.Random(7)
    for _ in range(20):
        n, m = rng.randint(1, 4), rng.randint(1, 4)
        supply = [rng.randint(0, 3) for _ in range(n)]
        cap = [rng.randint(0, 4) for _ in range(m)]
        cap[0] += max(0, sum(supply) - sum(cap))
        cost = [[rng.randint(0, 5) for _ in range(m)] for _ in range(n)]
        flow = op08_reshard.min_cost_flow(supply, cap, cost)
        assert [sum(r) for r in flow] == supply and all(sum(flow[i][j] for i in range(n)) <= cap[j] for j in range(m))
        units = [i for i in range(n) for _ in range(supply[i])]

        def best(k, left):
            if k == len(units):
                return 0
            return min((cost[units[k]][j] + best(k + 1, (*left[:j], left[j] - 1, *left[j + 1 :])) for j in range(m) if left[j]), default=10**9)

        if len(units) <= 6:
            assert sum(flow[i][j] * cost[i][j] for i in range(n) for j in range(m)) == best(0, tuple(cap))


def test_reshard(spark, tmp_path):
    out = op08_reshard.reshard(documents(spark).union(documents(spark).limit(3))).cache()
    rows = out.collect()
    loads = {}
    for r in rows:
        loads.setdefault(r["shard"], []).append(r)
    total = sum(r["size"] for r in rows)
    assert len(rows) == documents(spark).count() + 3 and set(loads) <= set(range(16))
    assert all(sorted(r["slot"] for r in v) == list(range(len(v))) for v in loads.values())
    biggest = max(r["size"] for r in rows)
    assert all(abs(sum(r["size"] for r in v) - total / 16) <= biggest for v in loads.values())
    excess = sum(max(0, sum(r["size"] for r in rows if r["old_shard"] == i) - total // 16) for i in range(12))
    assert sum(r["size"] for r in rows if r["shard"] != r["old_shard"]) <= excess + 16 * biggest
    touched = op08_reshard.rewrite(out, str(tmp_path / "s"))
    assert touched == op08_reshard.rewrite(out, str(tmp_path / "s"))  # a second run replaces, not adds
    assert spark.read.parquet(str(tmp_path / "s")).count() == sum(len(loads.get(s, [])) for s in touched)
    got = op08_reshard.reshard(odd(spark)).collect()
    assert sorted(r["size"] for r in got) == sorted(len((t or "").encode()) + 1 for _, t, *_ in odd_rows())
    assert op08_reshard.reshard(empty(spark)).count() == 0


def test_targets():
    assert op09_mix.targets([100, 100, 100], [3.0, 1.0, 2.0]) == pytest.approx([200, 250 / 3, 500 / 3])
    assert op09_mix.targets([], []) == [] and op09_mix.targets([0, 0], [3.0, 1.0]) == [0, 0]


def test_permutation():
    for n in (1, 2, 3, 17, 1000):
        assert sorted(op09_mix.permuted(np.arange(n), n, 5).tolist()) == list(range(n))


def test_mix(spark):
    docs = documents(spark)
    rows = op09_mix.mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    assert len(rows) == docs.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault((r["source"], r["target"]), []).append(r["taken"])
    assert all(abs(sum(v) - target) <= 2 * op09_mix.BLOCK_WORDS for (_, target), v in by.items())
    assert sorted((r["doc_id"], r["taken"]) for r in rows) == sorted((r["doc_id"], r["taken"]) for r in op09_mix.mix(docs.repartition(7)).collect())
    texts = op09_mix.mixed_texts(docs).collect()
    assert sum(len(r["text"].split()) for r in texts) == sum(r["taken"] for r in rows)
    got = op09_mix.mix(odd(spark)).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in got) == sorted((i or 0, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, *_ in odd_rows())
    assert op09_mix.mix(empty(spark)).count() == 0
    assert op09_mix.mixed_texts(odd(spark)).columns == odd(spark).columns


def test_cut():
    assert op09_mix.cut(b" a  b\nc d ", [(0, 4)]) == b" a  b\nc d "
    assert op09_mix.cut(b" a  b\nc d ", [(0, 2)]) == b"a  b"
    assert op09_mix.cut(b"a b c d", [(3, 4), (0, 1)]) == b"a\nd"


def brute_fp(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ASCII))
    if not w:
        return 0
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    out = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = out[i], out[j]
                out = [min(a, b) if x in (a, b) else x for x in out]
    return out


def test_families_resolve_their_parts():
    rng = np.random.default_rng(3)
    for k, own in enumerate(op10_simhash.families()):
        base, rest = np.uint64(own[0]), np.array(own[1:], np.uint64)
        assert all((int(base) ^ p) >> 16 * k < 1 << 16 and (int(base) ^ p) % (1 << 16 * k) == 0 for p in own[1:])
        other = rng.integers(0, 2**64, 4, dtype=np.uint64)
        x = ((np.arange(1 << 16, dtype=np.uint64) << np.uint64(16 * k))[:, None] | (other & ~(np.uint64(0xFFFF) << np.uint64(16 * k)))[None, :]).T
        gaps = np.bitwise_count(x[..., None] ^ rest).astype(int) - np.bitwise_count(x ^ base).astype(int)[..., None]
        assert (gaps == gaps[:1]).all() and len(np.unique(gaps[0], axis=0)) == 1 << 16


def test_set_distances_bound_the_difference():
    rng = np.random.default_rng(4)
    from lexalign.llm import op10_sets

    for _ in range(50):
        both = rng.integers(0, 2**64, rng.integers(0, 300), dtype=np.uint64)
        x, y = (np.unique(np.concatenate((both, rng.integers(0, 2**64, rng.integers(0, 40), dtype=np.uint64)))) for _ in range(2))
        assert op10_sets.gaps([op10_sets.regions(x)], [op10_sets.regions(y)])[0] <= len(np.setxor1d(x, y))


@pytest.mark.parametrize("most", [512, 2])
def test_near_duplicates_links(spark, most):
    rng = random.Random(8)
    centres = [rng.getrandbits(64) for _ in range(12)]
    fps = list({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for c in centres for _ in range(15)})
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    edges = op10_simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), max_bucket=most)
    roots = {r["node"]: r["root"] for r in op10_simhash.components(spark, edges).collect()}
    groups, want = {}, {}
    for s, c in zip(signed, brute_components(fps), strict=True):
        groups.setdefault(roots.get(s, s), set()).add(s)
        want.setdefault(c, set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_near_duplicates(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).collect()][:120] + [(i, t) for i, t, *_ in odd_rows() if i is not None and i > 3] + [(900, ""), (901, None), (902, "  ")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, fp int")
    got = op10_simhash.near_duplicates(df).collect()
    fps = [brute_fp(t) for _, t in rows]
    comp = brute_components(fps)
    low = {}
    for (i, _), c in zip(rows, comp, strict=True):
        low[c] = min(low.get(c, i), i)
    assert sorted((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == sorted((i, f, low[c]) for (i, _), f, c in zip(rows, fps, comp, strict=True))
    assert op10_simhash.near_duplicates(empty(spark)).count() == 0
    assert op10_simhash.near_duplicates(odd(spark)).count() == len(odd_rows())


@pytest.mark.parametrize(("roots", "common"), [(1, 0.0), (3, 0.0), (40, 0.6), (2000, 0.5), (2000, 0.0)])
def test_last_round_meets_all_unlike_roots(roots, common):
    """Pairs of large buckets against brute force, with root groups of any size."""
    from lexalign.llm import op10_sets as sets

    rng = np.random.default_rng(roots)
    size = 700
    token = rng.integers(0, 2, size)
    node = np.arange(size) + 1000
    n = rng.integers(20, 60, size)
    pos = rng.integers(0, 4, size)
    root = np.where(rng.random(size) < common, 0, rng.integers(0, roots, size))
    rough = [x.tobytes() for x in rng.integers(0, 2, (size, sets._ROUGH)).astype(np.uint8) // 2]
    batch = pa.RecordBatch.from_arrays([*map(pa.array, (token, node, n, pos, root)), pa.array(rough, pa.binary())], ["token", "node", "n", "pos", "root", "rough"])
    got = {p for b in sets._pairs(True)(iter([batch])) for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
    want = set()
    for i in range(size):
        for j in range(i + 1, size):
            if token[i] == token[j] and root[i] != root[j] and sets.alike(min(n[i] - pos[i], n[j] - pos[j]), n[i], n[j]):
                want.add((int(node[i]), int(node[j])))
    assert got == want
    assert bool(want) == (roots > 1)


def test_op10_family_keys_are_differences_of_distances():
    from lexalign.llm import op10_sets as sets

    rng = np.random.default_rng(4)
    own = np.unique(rng.integers(0, 2**64, 40, dtype=np.uint64))
    told: dict[tuple, set[int]] = {}
    for x in (own, own[5:], own[:-3], np.unique(np.concatenate([own[::2], rng.integers(0, 2**64, 20, dtype=np.uint64)]))):
        start, key = sets.family_keys(x, 3)
        assert len(start) == len(key) == len(np.unique(x >> np.uint64(61)))
        for s, k in zip(start, key, strict=True):
            there = x[(x >> np.uint64(61)) == x[s] >> np.uint64(61)]
            # distance to a reference: |x| + |reference| - 2 |both|; less that to the empty one and the reference's size
            told.setdefault((int(x[s]) >> 61, *(-2 * int((there >> np.uint64(b) & np.uint64(1)).sum()) for b in range(32))), set()).add(int(k))
    assert all(len(k) == 1 for k in told.values()) and len({*(k for ks in told.values() for k in ks)}) == len(told)


def test_op10_alike_sets_share_a_key():
    from lexalign.llm import op10_sets as sets

    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 9, 20, 127, 128, 140, 159, 160, 200, 319, 320, 480, 640, 1000):
        for _ in range(20):
            own = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            m = int(rng.integers(-(-4 * n // 5), 5 * n // 4 + 1))
            both = -(-4 * (n + m) // 9)  # as few as alike() lets pass
            if both > min(n, m):
                continue
            other = np.unique(np.concatenate([rng.permutation(own)[:both], rng.integers(0, 2**64, m - both, dtype=np.uint64)]))
            assert sets.alike(both, n, m)
            x, y = ({*np.concatenate(sets.search_keys(s, (s % np.uint64(7)).astype(np.int64))).tolist()} for s in (own, other))
            assert x & y


def test_op10_similarity_of_long_texts(spark):
    from lexalign.llm import op10_sets as sets

    rng = np.random.default_rng(6)
    rows = []
    for size in (100, 126, 135, 158, 163, 185, 318, 325, 390, 640):  # about the sizes where the parts change
        base = [f"w{i}" for i in rng.integers(0, 3000, size)]
        for _ in range(5):
            w = list(base)
            for at in rng.integers(0, len(w), rng.integers(0, size // 40 + 2)):
                w[at] = f"n{rng.integers(0, 3000)}"
            rows.append((len(rows), " ".join(w[: len(w) - int(rng.integers(0, size // 6))])))
    got = {r["doc_id"]: r["component_id"] for r in sets.similar_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hashes = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for _, t in rows]
    want = [*range(len(rows))]
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(hashes[i] & hashes[j]) >= 4 * len(hashes[i] | hashes[j]):
                low, high = sorted((want[i], want[j]))
                want = [low if x == high else x for x in want]
    assert [got[i] for i in range(len(rows))] == want and len(set(want)) < len(rows)
