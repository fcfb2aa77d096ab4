"""Near-duplicates, search, classifiers and the pipeline against plain versions."""

from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from compare import connect, differences
from courierlens.llm import cover, minhash, quality, toxicity, wand
from courierlens.llm.common import connected, maybe_among


def groups(ids, linked) -> dict:
    """Smallest id reachable, by plain search."""
    near = collections.defaultdict(set)
    for a, b in linked:
        near[a].add(b)
        near[b].add(a)
    found = {}
    for start in sorted(ids):
        stack = [start]
        while stack:
            at = stack.pop()
            if at not in found:
                found[at] = start
                stack += near[at]
    return found


def test_components(spark):
    draw = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(draw.randint(100, 300), draw.randint(100, 300)) for _ in range(120)]
    links = [(a, b) for a, b in links if a != b]
    want = groups({x for pair in links for x in pair}, links)
    got = {r["id"]: r["component"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_maybe_among_never_misses(spark):
    rows = spark.range(5000).withColumnRenamed("id", "doc_id")
    wanted = rows.filter("doc_id % 7 = 0")
    marked = maybe_among(rows, wanted, "doc_id", "_maybe", slots=1 << 16)
    assert marked.filter("doc_id % 7 = 0 and not _maybe").count() == 0
    assert marked.filter("doc_id % 7 <> 0 and _maybe").count() < 400
    assert maybe_among(rows, wanted.limit(0), "doc_id", "_maybe").filter("_maybe").count() == 0
    assert marked.count() == 5000


def shingles(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


def near_texts() -> list[str | None]:
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    texts: list[str | None] = [None, "", " \n ", "one", "One", "two words", "two words", "x " * 50_000]
    for _ in range(12):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(20, 120))]
        for _ in range(12):
            copy = list(base)
            for _ in range(draw.randint(0, 12)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(" ".join(copy))
        texts += [" ".join(base), " ".join(base).upper()]
    return texts


@pytest.mark.parametrize(("words", "block"), [(2, 512), (5, 4)])
def test_near_duplicates_equal_brute_force(spark, words, block):
    texts = near_texts()
    rows = [(i, t, 0) for i, t in enumerate(texts)]
    frame = spark.createDataFrame([*rows, (None, texts[-1], 0), (9, texts[9], 0)], "doc_id long, text string, rep int")
    sets = {i: shingles(t, words) for i, t, _ in rows}
    linked = [
        (i, j)
        for i in sets
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    want = groups(sets, linked)
    params = minhash.NearParams(words=words, block=block)
    got = minhash.near_duplicates(frame.repartition(4), params).collect()
    assert len(got) == len(rows) + 2
    for row in got:
        if row["doc_id"] is None:
            assert (row["component_id"], row["kept"]) == (None, True)
            continue
        i = row["doc_id"]
        assert (row["n_shingles"], row["component_id"], row["kept"]) == (len(sets[i]), want[i], want[i] == i)
    kept = minhash.keep_one(frame, params)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(set(want.values()))
    assert minhash.near_duplicates(frame.limit(0), params).collect() == []


def test_pairs_within_the_signature_distance_share_a_key():
    params = minhash.NearParams()
    draw = np.random.default_rng(4)
    least = params.chunks * (params.errors + 1) - 1
    one = draw.integers(0, 2**16, (200, params.slots)).astype("<u2")
    two = one.copy()
    for row in range(200):
        two[row, draw.choice(params.slots, least, replace=False)] += 1
    a, b = minhash.chunk_keys(one, params), minhash.chunk_keys(two, params)
    assert all(set(x) & set(y) for x, y in zip(a.tolist(), b.tolist(), strict=True))


def test_shared_counts_over_several_columns():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 90, n)).astype(np.uint64) for n in (1, 5, 40, 60, 60)]
    got = minhash.shared_counts(sets, columns=7)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(np.intersect1d(a, b))


def vectors() -> list:
    draw = np.random.default_rng(9)
    rows: list = [None, [0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] * 8, [1.0] * 7 + [None], [], [1.0, 2.0], [2.0, 4.0]]
    for _ in range(10):
        base = draw.normal(size=8)
        rows += [(base + draw.normal(size=8) * s).tolist() for s in (0, 0, 0.05, 0.1, 0.2, 0.3, 0.5)]
        rows.append((base * 1e-200).tolist())
    return rows


@pytest.mark.parametrize("block", [3072, 9])
def test_cover_trees_equal_brute_force(spark, block):
    rows = [(i, v, "a") for i, v in enumerate(vectors())]
    frame = spark.createDataFrame([*rows, (None, rows[-1][1], "b")], "vec_id long, embedding array<double>, rep string")
    good = {
        i: np.array(v, float)
        for i, v, _ in rows
        if v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))
    }
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in good.items()}
    linked = [(i, j) for i in unit for j in unit if i != j and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9]
    want, count = groups([i for i, _, _ in rows], linked), collections.Counter(i for i, _ in linked)
    assert len(linked) > 100
    got = cover.near_vectors(frame, cover.CoverParams(block=block)).collect()
    assert len(got) == len(rows) + 1
    for row in got:
        if row["vec_id"] is None:
            assert (row["n_links"], row["component_id"], row["kept"]) == (0, None, True)
        else:
            i = row["vec_id"]
            assert (row["n_links"], row["component_id"], row["kept"]) == (count[i], want[i], want[i] == i), i
    assert cover.near_vectors(frame.limit(0)).collect() == []


def test_tree_traversal_finds_all_pairs_of_clustered_points():
    draw = np.random.default_rng(5)
    centres = cover.unit(draw.normal(size=(6, 16)))
    x = cover.unit(np.repeat(centres, 60, axis=0) + draw.normal(size=(360, 16)) * 0.1)
    y = cover.unit(np.repeat(centres[:4], 50, axis=0) + draw.normal(size=(200, 16)) * 0.12)
    assert (cover.linked_pairs(x, y, cover.CoverParams()) == (x @ y.T >= 0.9)).all()


def test_vectors_of_any_number_of_dimensions_are_linked(spark):
    """Twin vectors of 1,010 different lengths: each finds its twin, and nothing of another length."""
    frame = spark.range(2020).selectExpr(
        "id as vec_id",
        "transform(sequence(1, id % 1010 + 1), i -> cast(1 + i % 5 + if(id >= 1010, 0.01, 0) as double)) as embedding",
    )
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in cover.near_vectors(frame).collect()}
    assert got == {i: (1, i % 1010) for i in range(2020)}


def test_cells_do_not_carry_vectors(spark):
    """What is dealt to the tasks that compare blocks has no binary column, so it doesn't grow with cells times vectors."""
    draw = np.random.default_rng(6)
    x = cover.unit(np.repeat(draw.normal(size=(200, 12)), 3, axis=0) + draw.normal(size=(600, 12)) * 0.12)
    rows = [(12, i, v.tobytes(), i % 2 + 1) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "size int, rep long, vector binary, times long")
    found = cover.class_links(frame, cover.CoverParams(block=100))
    leaves = found._jdf.queryExecution().optimizedPlan().collectLeaves()
    columns = [leaves.apply(n).output().apply(c) for n in range(leaves.size()) for c in range(leaves.apply(n).output().size())]
    assert columns and "binary" not in [c.dataType().simpleString() for c in columns]
    links = x @ x.T >= 0.9
    np.fill_diagonal(links, False)
    rows, counts = found.collect(), collections.Counter()
    for r in rows:
        counts[r["a"]] += r["links"]
    assert +counts == +collections.Counter({i: int((links[i] * (np.arange(600) % 2 + 1)).sum()) for i in range(600)})
    pairs = [(i, j) for i, j in zip(*np.nonzero(links), strict=True)]
    assert groups(range(600), [(r["a"], r["b"]) for r in rows if r["b"] is not None]) == groups(range(600), pairs)


def test_trees_with_small_wide_leaves_find_all_pairs():
    """Leaves that hold several far points are compared row by row, from either side."""
    draw = np.random.default_rng(8)
    x, y = draw.normal(size=(400, 24)), draw.normal(size=(300, 24))
    y[:100] = x[:100] + draw.normal(size=(100, 24)) * 0.06
    x, y = cover.unit(x), cover.unit(y)
    for leaf_size in (1, 3, 8, 1000):
        assert (cover.linked_pairs(x, y, cover.CoverParams(leaf_size=leaf_size)) == (x @ y.T >= 0.9)).all()


def test_search_equals_sql(spark, tmp_path):
    draw = random.Random(6)
    vocabulary = [f"w{i}" for i in range(60)] + ["The", "the", "ÉA"]
    texts = [" ".join(draw.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=draw.randint(1, 40))) for _ in range(300)]
    texts[20:24] = [None, "", texts[40], "word " * 20_000]
    frame = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    path = tmp_path / "written"
    frame.write.parquet(str(path))
    con = connect(str(tmp_path))
    con.execute(f"create view documents as select * from '{path}/*.parquet'")
    for shard, block in ((4096, 64), (50, 4)):
        got = wand.search_own(frame.repartition(3), wand.SearchParams(shard=shard, block=block))
        assert differences(got, con, wand.SQL) == []
    assert wand.search_own(frame.limit(0)).collect() == []


def test_words_are_counted_in_any_slice():
    texts = [None, "", " \t", "A\x0b\x0cB\x1cc  É\x85x a ", "a", " x\nY\r\nx "] * 70
    for first in (0, 1, 200, 333):
        part = pa.array(texts, pa.string()).slice(first, 60)
        terms, text, term, times, lengths = wand.counted(part)
        got = [{} for _ in part]
        for i, t, n in zip(text, term, times, strict=True):
            got[i][terms[int(t)].as_py()] = int(n)
        want = [collections.Counter(x.encode().lower().split() if x else []) for x in part.to_pylist()]
        assert got == want and list(lengths) == [sum(w.values()) for w in want]


def test_search_opens_few_blocks_and_is_exact():
    """Long queries in two languages: blocks of the other language stay shut, and every score equals a plain one."""
    draw = random.Random(9)
    words = [[f"{language}{i}" for i in range(400)] for language in "ab"]
    texts = [" ".join(draw.choices(words[i % 2], weights=[1 / (j + 1) for j in range(400)], k=draw.randint(40, 120))) for i in range(1024)]
    texts[600:620] = texts[:20]
    ids = np.array(draw.sample(range(-500, 5000), len(texts)))
    held = terms, text, term, times, lengths = wand.counted(pa.array(texts))
    df = np.bincount(term)
    idf = np.log1p((len(ids) - df + 0.5) / (df + 0.5))
    tf = np.zeros((len(ids), len(terms)))
    tf[text, term] = times
    plain = np.round((tf * idf) @ (tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * lengths[:, None] / lengths.mean()))).T, 6)
    frequent = terms.take(pa.array(np.flatnonzero(df > 100)))
    shard = wand.Shard([(ids, held)], lengths.mean(), frequent, wand.SearchParams(block=32, groups=2))
    got = {}
    for query, doc, scores in shard.best(text, terms.take(pa.array(term)), times * idf[term], len(ids)):
        for q, d, s in zip(query, doc, scores, strict=True):
            got.setdefault(int(q), []).append((int(d), float(s)))
    for q in range(len(ids)):
        best = np.lexsort((ids, -plain[q]))[:10]
        assert [d for d, _ in got[q]] == ids[best].tolist()
        assert np.allclose([s for _, s in got[q]], plain[q][best], rtol=0, atol=2e-6)
    assert 0 < shard.opened <= 0.55 * shard.blocks * len(ids)


def labelled(spark):
    draw = random.Random(4)
    plain = [f"word{i}" for i in range(300)]
    documents, labels = [], []
    for i in range(900):
        words = [draw.choice(plain) for _ in range(draw.randint(5, 60))]
        toxic, good = i % 7 == 0, i % 3 != 0
        if toxic:
            words[draw.randrange(len(words))] = draw.choice(["vileman", "vileish", "nastily"])
        if not good:
            words = [w.upper() + "!!" for w in words]
        documents.append((i, " ".join(words), 7.5))
        if i % 2 == 0:
            labels.append((i, int(good), int(toxic)))
    documents += [(9000, None, 7.5), (9001, "", 7.5), (None, "vileman", 7.5), (9002, "word1 " * 50_000, 7.5), (3, documents[3][1], 7.5)]
    labels += [(None, 1, 1), (5, None, None), (0, 0, 1), (77_777, 1, 1)]
    return (
        spark.createDataFrame(documents, "doc_id long, text string, score double"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_toxicity_on_held_out_rows(spark):
    documents, labels = labelled(spark)
    params = toxicity.PuParams(errors=4)  # the few rows here show less than chance needs by default
    rows = toxicity.toxicity(documents, labels, params).collect()
    assert len(rows) == documents.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    named = [r for r in rows if r["doc_id"] is not None]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in named)
    held = [r for r in named if r["held_out"] and r["doc_id"] < 900]
    assert sum(r["predicted"] != (r["doc_id"] % 7 == 0) for r in held) <= 0.05 * len(held)
    none = toxicity.toxicity(documents, labels.filter("toxic = 0")).collect()
    assert max(r["score"] for r in none) < 0.01
    assert toxicity.toxicity(documents.limit(0), labels.limit(0)).collect() == []


def test_quality_on_held_out_rows(spark):
    documents, labels = labelled(spark)
    rows = quality.quality(documents, labels).collect()
    assert len(rows) == documents.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 900]
    assert sum(r["predicted"] != (r["doc_id"] % 3 != 0) for r in held) <= 0.05 * len(held)
    assert {r["score"] for r in quality.quality(documents, labels.limit(0)).collect()} == {0.5}
    assert min(r["score"] for r in quality.quality(documents, labels.filter("quality = 1")).collect()) > 0.9
    assert quality.quality(documents.limit(0), labels.limit(0)).collect() == []


def test_risk_correction_keeps_the_fit_from_overfitting():
    draw = np.random.default_rng(3)
    params = toxicity.PuParams(dimensions=64, epochs=20)
    positive = [np.unique(np.append(draw.integers(0, 50, 6), 60)) for _ in range(80)]
    unlabelled = [draw.integers(0, 50, 6) for _ in range(360)] + [np.append(draw.integers(0, 50, 6), 60) for _ in range(40)]
    model = toxicity.fit_risk(positive, unlabelled, 0.1, params)
    assert model.weights[60] + model.bias > 0
    assert (model.weights >= 0).all() and model.bias < 0
    assert np.mean([model.weights[r].sum() + model.bias > 0 for r in unlabelled]) <= 0.12


def test_pipeline_stages(spark, tmp_path):
    documents, labels = labelled(spark)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == documents.columns
        kept.append(docs.count())
        assert kept[-1] <= before
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "packing"]
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    assert collections.Counter(r["doc_id"] for r in rows if r["piece"] == 0) == collections.Counter(ids)
    toxic = {i for i in range(0, 900, 7)}
    assert len(toxic & set(ids)) < 0.6 * len(toxic)


def test_broadcasts_hold_no_classes_of_the_package(spark, monkeypatch):
    """Executors without the package can read them: pickles of own classes name the module they come from."""
    documents, labels = labelled(spark)
    shared, real = [], spark.sparkContext.broadcast

    def recorded(value):
        shared.append(value)
        return real(value)

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: recorded(value))
    toxicity.toxicity(documents, labels)
    quality.quality(documents, labels)
    assert len(shared) == 2 and all(type(v) is np.ndarray for v in shared)


def test_near_duplicate_stage_takes_any_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    names = ["_id", "_bits", "_bucket", "_stays", "_repeats", "_maybe", "key", "row", "id", "said", "maybe", "stays", "repeats", "odd.name"]
    rows = [(5, text), (3, text + " more"), (7, "quite another text"), (None, text), (None, None), (8, "b"), (8, "a"), (8, None), (9, "")]
    schema = "doc_id int, text string, " + ", ".join(f"`{n}` int" for n in names)
    frame = spark.createDataFrame([(*r, *range(i, i + len(names))) for i, r in enumerate(rows)], schema)
    kept = minhash.keep_one(frame.repartition(3))
    assert kept.columns == frame.columns and kept.schema["doc_id"].dataType == frame.schema["doc_id"].dataType
    assert sorted(map(str, kept.select("doc_id", "text", "_bits", "`odd.name`").collect())) == sorted(
        map(str, frame.filter("_id in (1, 2, 3, 4, 7, 8)").select("doc_id", "text", "_bits", "`odd.name`").collect())
    )
    assert minhash.keep_one(frame.limit(0)).collect() == []
