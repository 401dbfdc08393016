"""Vectors, shards, toxicity, the pipeline, and empty tables."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rowsmith.llm import (
    binary_output, common, decontamination, embeddings, packing, pii, secret_scan, sharding, simhash,
    substrings, toxicity,
)
from rowsmith.llm.queries import QUERIES
from tests.llm.cases import documents, groups, prose, texts


def test_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(12, 16))
    rows = [(i, (base[i % 12] + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.3, 0.5])).tolist()) for i in range(240)]
    odd = [
        (900, None), (901, []), (902, [0.0] * 16), (903, [None] + [1.0] * 15), (904, [float("nan")] * 16),
        (905, [float("inf")] * 16), (906, [1.0, 2.0]), (907, [2.0, 4.0]), (908, [-1.0, 2.0]), (None, [1.0, 2.0]),
        (910, [1.0, 2.0]), (911, [1e300, 1e300]), (911, [1e300, 1e300]), (912, [1e-300, 1e-300]),
    ]
    frame = spark.createDataFrame(
        [(*r, 0, 1) for r in rows + odd], "vec_id long, embedding array<double>, label int, n_links int"
    )
    found = defaultdict(list)
    for r in embeddings.near_duplicates(frame, home=16, ask=32).collect():
        found[r.vec_id].append((r.n_links, r.component_id, r.kept))
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    got = np.array([found[i][0][0] for i in range(240)])
    assert near.sum() > 1000 and got.sum() >= 0.9 * near.sum() and (got <= near.sum(axis=1)).all()
    if (got == near.sum(axis=1)).all():
        root = groups(list(zip(*np.nonzero(near))), range(240))
        assert {i: found[i][0][1] for i in range(240)} == root
    for i in range(900, 906):
        assert found[i] == [(0, i, True)]
    assert found[908] == [(0, 908, True)]
    assert found[906] == [(3, 906, True)] and found[907] == [(3, 906, False)] == found[910]
    assert found[None] == [(3, 906, False)]
    assert found[911] == [(2, 911, True)] * 2 and found[912] == [(2, 911, False)]


def test_recall_against_brute_force_on_the_table(spark):
    frame = common.table(spark, "/root/testdata/sf0.01", "embeddings")
    some = [(r.vec_id, r.embedding) for r in frame.collect()]
    rng = np.random.default_rng(1)
    copies = [
        (10_000 + 10 * i + k, (np.array(v) + rng.normal(size=len(v)) * s).tolist())
        for i, (_, v) in enumerate(some[:100]) for k, s in enumerate((0.01, 0.02, 0.03, 0.04))
    ]
    rows = some + copies
    found = {
        r.vec_id: r.n_links
        for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    }
    x = np.array([v for _, v in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = (x @ x.T >= 0.95).sum(axis=1) - 1
    got = np.array([found[i] for i, _ in rows])
    assert (got <= near).all() and got.sum() >= 0.9 * near.sum() > 0


@pytest.mark.parametrize("size, rank, spaces", [(128, 2, 1), (64, 3, 1), (128, 8, 1), (64, 64, 1), (64, 2, 200)])
def test_probes_reach_links_across_many_lists_at_any_rank(size, rank, spaces):
    # Links just above the threshold, inside the few directions the vectors have.
    rng = np.random.default_rng(3)
    rows, links = [], []
    for _ in range(spaces):
        base = np.linalg.qr(rng.normal(size=(size, rank)))[0].T
        x = embeddings.unit(rng.normal(size=(12_000 // spaces, rank)))
        near = x[: 1000 // spaces]
        aside = rng.normal(size=near.shape)
        aside = embeddings.unit(aside - (aside * near).sum(axis=1)[:, None] * near)
        rows.append(x @ base)
        links.append((near @ base, (0.955 * near + np.sqrt(1 - 0.955**2) * aside) @ base))
    index = embeddings.Index(np.concatenate(rows), 220_000)
    a, b = (np.concatenate(v) for v in zip(*links))
    at_a, at_b = embeddings.nearest(a, index.centres), embeddings.nearest(b, index.centres)
    radius, i = np.sqrt(2 - 2 * 0.95), np.arange(len(a))
    met = index.probes(a, at_a, radius, 3.0)[i, at_b] | index.probes(b, at_b, radius, 3.0)[i, at_a]
    assert index.lists > 200 and (at_a != at_b).mean() > 0.1 and met.mean() >= 0.99


def test_links_of_vectors_on_a_surface(spark):
    rng = np.random.default_rng(4)
    base = np.linalg.qr(rng.normal(size=(32, 3)))[0].T
    x = embeddings.unit(rng.normal(size=(3000, 3))) @ base
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in embeddings.near_duplicates(frame).collect()}
    near = (x @ x.T >= 0.95).sum(axis=1) - 1
    got = np.array([found[i] for i in range(len(x))])
    assert (got <= near).all() and got.sum() >= 0.99 * near.sum() > 0


def test_recall_on_the_largest_table(spark):
    # The table holds no links of these queries of its own, so each gets four noisy copies.
    frame = common.table(spark, "/root/testdata/sf0.1", "embeddings").select("vec_id", "embedding")
    rows = frame.collect()
    rng = np.random.default_rng(2)
    asked = [i for i, r in enumerate(rows) if r.vec_id % 20 == 0]
    copies = [
        (10**6 + 4 * i + k, (np.array(v) / np.linalg.norm(v) + rng.normal(size=len(v)) * s).tolist())
        for i in asked for v in [rows[i].embedding] for k, s in enumerate((0.005, 0.02, 0.035, 0.04))
    ]
    x = embeddings.unit(np.array([r.embedding for r in rows] + [v for _, v in copies], dtype=float))
    near = (x[asked] @ x.T >= 0.95).sum(axis=1) - 1
    table = frame.union(spark.createDataFrame(copies, "vec_id long, embedding array<double>"))
    found = {r.vec_id: r.n_links for r in embeddings.near_duplicates(table).collect()}
    got = np.array([found[rows[i].vec_id] for i in asked])
    assert (got <= near).all() and got.sum() >= 0.9 * near.sum() > len(asked)


def test_shards(spark):
    rng = random.Random(2)
    hot = prose(rng, 400)
    rows = [*texts(), *[(200 + i, hot) for i in range(40)], *[(300 + i, prose(rng, rng.randint(1, 60))) for i in range(200)]]
    found = sharding.shard(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows
    )
    slots, sizes = defaultdict(list), Counter()
    for r in found:
        assert 0 <= r.shard < 16 and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    place = {}
    body = {d: t for d, t in rows if d is not None and d != 18}
    for r in found:
        if r.doc_id in body:
            assert place.setdefault(body[r.doc_id], r.shard) == r.shard
    held = sizes.most_common(1)[0][0]
    assert held == place[hot]
    long, big = place[texts()[8][1]], place["x" * 20000]
    rest = [n for s, n in sizes.items() if s not in (held, long, big)]
    assert len(sizes) == 16 and max(rest) - min(rest) <= 0.02 * max(rest) + 2


def test_packing_of_groups_is_best_fit():
    rng = random.Random(4)
    for _ in range(200):
        sizes = {rng.randint(1, 500): rng.randint(1, 4) for _ in range(rng.randint(1, 20))}
        runs = sharding.best_fit_decreasing([(s, n, s) for s, n in sizes.items()], 4)
        seen = defaultdict(list)
        for name, low, high, _ in runs:
            seen[name] += range(low, high + 1)
        assert {s: len(v) for s, v in seen.items()} == sizes
        assert all(sorted(v) == list(range(len(v))) for v in seen.values())


def labelled(spark, n=600, seed=0):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.15
        words = prose(rng, rng.randint(5, 60)).split()
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["zzidiot", "zzmoron", "qqstem" + rng.choice("abcdefgh") * 2]))
        rows.append((i, " ".join(words)))
        if rng.random() < 0.7:
            labels.append((i, rng.randint(0, 1), int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = labelled(spark)
    docs = documents(spark, [*rows, (9000, None), (9001, ""), (None, "zzidiot"), (9002, "zzmoron " * 5000)])
    known = spark.createDataFrame([*labels, (None, 1, 1), (3, 0, None), (5000, 0, 1)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.judged(docs, known).collect()}
    assert len(found) == len(rows) + 4
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items() if i is not None)
    truth = dict((i, t) for i, _, t in labels)
    held = [(truth[i], r.score) for i, r in found.items() if i in truth and r.held_out]
    pos, neg = [s for t, s in held if t], [s for t, s in held if not t]
    assert np.mean([[p > n for n in neg] for p in pos]) > 0.95
    assert np.mean([s >= 0.5 for s in pos]) > 0.8 and np.mean([s >= 0.5 for s in neg]) < 0.02
    assert found[9000].score == found[9001].score < 0.5 and found[9002].predicted == 1
    kept = toxicity.reject(docs, known)
    assert kept.columns == docs.columns
    assert sorted(r[0] or -1 for r in kept.collect()) == sorted(i or -1 for i, r in found.items() if r.predicted == 0)


def test_held_out_labels_change_nothing(spark):
    rows, labels = labelled(spark, 300, 1)
    docs = documents(spark, rows)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    models = [toxicity.train(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, flipped)]
    assert models[0].bias == models[1].bias and (models[0].weights == models[1].weights).all()


def test_repeated_ids_do_not_thin_the_sample(spark):
    rows, labels = labelled(spark, 300, 2)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    train = lambda some: toxicity.train(documents(spark, some), known, most=60)
    once = train(rows)
    hot = next(r for r in rows if r[0] not in {i for i, _, _ in labels} and zlib.crc32(str(r[0]).encode()) % 5)
    assert len(once.names)
    for some in ([r for r in rows for _ in range(2)], [hot] * 500 + rows, rows[::-1] + [hot] * 500):
        again = train(some)
        assert (again.names == once.names).all() and (again.weights == once.weights).all()
        assert again.bias == once.bias


def test_an_id_of_several_texts_gives_one(spark):
    rows, labels = labelled(spark, 300, 2)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    more = [*rows, *[(i, f"other {t}") for i, t in rows[:100]], *[(i, None) for i, _ in rows[100:]]]
    models = [toxicity.train(documents(spark, some), known, most=60) for some in (more, more[::-1])]
    assert (models[0].names == models[1].names).all() and (models[0].weights == models[1].weights).all()


def test_without_positives_scores_are_low():
    model = toxicity.fit([], [np.array([1, 2], np.uint32)], 0.0)
    assert model.scores(np.zeros(0, np.uint8), np.array([0, 0]))[0] < 0.5


@pytest.fixture
def folder(spark, tmp_path):
    rows, labels = labelled(spark, 200, 3)
    rows, labels = [(1000 + i, t) for i, t in rows], [(1000 + i, q, t) for i, q, t in labels]
    rng = random.Random(9)
    item = prose(rng, 30)
    rows = [*rows, *texts(), (700, f"{prose(rng, 20)} {item} {prose(rng, 9)}"), (701, rows[0][1]), (702, f"{prose(rng, 40)} password: abc123456")]
    documents(spark, rows, clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_pipeline_against_its_parts(spark, folder):
    docs = common.table(spark, folder, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model = toxicity.train(docs, common.table(spark, folder, "labels"))

    def toxic(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        return model.scores(data, np.array([0, len(data)]))[0] >= 0.5

    left = [(d, t) for d, t in rows if not toxic(t)]
    prints = [simhash.fingerprint((t or "").encode()) for _, t in left]
    n = range(len(left))
    root = groups([(i, j) for i in n for j in n if i < j and (prints[i] ^ prints[j]).bit_count() <= 4], n)
    order = lambda i: (left[i][0] is None, left[i][0] or 0)
    unique = {}
    for r in set(root.values()):
        best = min((i for i in n if root[i] == r), key=order)
        unique.setdefault(left[best][0], []).append(left[best][1])
    item = [r.text for r in common.table(spark, folder, "benchmark").collect() if r.text][0].split()
    windows = {tuple(item[i : i + 10]) for i in range(len(item) - 9)}
    held = lambda t: any(tuple(t.split()[i : i + 10]) in windows for i in range(len(t.split())))
    clean = {d: ts for d, ts in unique.items() if not any(held(t or "") for t in ts)}
    assert 700 in unique and 700 not in clean
    tokens = defaultdict(Counter)
    for r in corpus_pipeline.run(spark, folder).collect():
        tokens[r.doc_id][r.doc_tokens] += r.length
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.vocabulary())
    path = secret_scan.vocabulary()
    assert set(tokens) == set(clean)
    for d, some in clean.items():
        sizes = [len(library.encode(secret_scan.masked(t or "", path), add_special_tokens=False).ids) + 1 for t in some]
        if d is not None and d != 18:
            assert tokens[d] == Counter({sizes[0]: sizes[0]})
        else:
            assert sum(tokens[d].values()) == sum(sizes)


def test_stages_keep_the_columns(spark, folder):
    docs = common.table(spark, folder, "documents")
    wide = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
        assert stage(spark, wide, folder).columns == wide.columns


def test_empty_tables(spark):
    docs = documents(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path, ranks = packing.vocabulary(), secret_scan.vocabulary()
    for frame in (
        pii.digests(pii.find(docs)), simhash.near_duplicates(docs), simhash.keep_one(docs),
        packing.concatenate_and_cut(docs, path), decontamination.overlaps(docs, bench),
        decontamination.decontaminate(docs, bench), substrings.remove_repeats(docs),
        binary_output.matrices(docs, path), secret_scan.find(docs, ranks), secret_scan.redact(docs, ranks),
        toxicity.judged(docs, labels), toxicity.reject(docs, labels), sharding.shard(docs),
        embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")),
    ):
        assert frame.collect() == []
    full = documents(spark, [(1, "a b"), (2, None)])
    assert decontamination.overlaps(full, bench).where("n_hit = 0").count() == 2
    assert toxicity.reject(full, labels).count() == 2


def test_all_thirteen_are_registered():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_components_of_a_long_chain(spark):
    n = 400
    order = list(range(n))
    random.Random(6).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])) + [(1000, 1001), (5, 5)], "u long, v long")
    found = {r.node: r.root for r in common.components(edges).collect()}
    assert found == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}


def test_numbers_are_gapless_in_every_key(spark):
    frame = spark.range(300).select(F.col("id"), F.when(F.col("id") % 3 > 0, F.lit(7)).alias("k"))
    found = defaultdict(list)
    for r in common.numbered(frame, ["k"], ["id"], "n").collect():
        found[r.k].append(r.n)
    assert {k: sorted(v) for k, v in found.items()} == {7: list(range(200)), None: list(range(100))}
