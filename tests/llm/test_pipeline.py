import random

import corpus_pipeline
from lexalign.llm import op10_simhash

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.quality(spark, docs, SF)
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
    one = corpus_pipeline.near_dedup(spark, docs, SF)
    ids = sorted(r["doc_id"] for r in one.select("doc_id").collect())
    want = sorted(set(brute_groups([(r["doc_id"], r["text"]) for r in docs.collect()])))
    assert ids == want and one.columns == docs.columns
    clean = corpus_pipeline.decontaminate(spark, docs, SF)
    assert clean.columns == docs.columns and 0 < clean.count() <= docs.count()
    mixed = corpus_pipeline.mix(spark, docs, SF)
    assert mixed.columns == docs.columns
    assert "shard" in corpus_pipeline.shard(spark, docs, SF).columns


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "text", "shard", "slot"} <= set(out.columns)


def test_odd_rows(spark):
    rows = [(1, "", "en", "s", 0), (2, None, None, None, None), (None, "a text without an id", "en", "t", 9), (None, "a text without an id", "en", "t", 9), (3, "x " * 3000, "en", "s", 6000), (3, "x " * 3000, "en", "s", 6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() <= 2 * len(rows)
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.near_dedup(spark, docs, SF).count() == 3


def test_near_dedup_keeps_unlike_texts_of_one_id(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(3, one, "en", "s", 1), (3, two, "en", "s", 1), (3, two, "en", "r", 1), (4, one, "en", "s", 1), (None, two, "en", "s", 1), (None, one + " more", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r["doc_id"], r["text"], r["source"]) for r in corpus_pipeline.near_dedup(spark, docs, SF).collect())
    assert got == sorted([(3, one, "s"), (3, two, "r")])


def brute_groups(rows):
    """Smallest id of each group linked by 5-word shingles, for every row."""
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    out = [i for i, _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and out[i] != out[j]:
                low, high = sorted((out[i], out[j]))
                out = [low if x == high else x for x in out]
    return out


def test_near_dedup_links_by_similarity(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(500)]
    bases = [rng.choices(vocabulary, k=rng.randint(30, 150)) for _ in range(30)] + [rng.choices(vocabulary, k=120)]
    rows = [(0, ""), (1, None), (2, "a b"), (3, "a c"), (4, "A  b")]
    for b, base in enumerate(bases):
        for _ in range(60 if b == 30 else 6):  # one group is larger than a small bucket
            w = list(base)
            for at in rng.sample(range(len(w)), rng.randint(0, 4)):
                w[at] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(w)))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, SF).select("doc_id").collect())
    assert got == sorted(set(brute_groups(rows)))
    all_rows = op10_simhash.near_duplicates(docs, shingle=5, similarity=True).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in all_rows) == sorted(zip((i for i, _ in rows), brute_groups(rows), strict=True))
