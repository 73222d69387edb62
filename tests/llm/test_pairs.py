"""SimHash and embedding near-duplicates, components: against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import buckets, embedding_dedup, simhash
from quarry.llm.components import components
from tests.llm.helpers import ODD_TEXTS, documents, empty, prose


def classes(n: int, edges) -> list[int]:
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def plain_fingerprint(text: str | None) -> int:
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    sh = [b" ".join(ws[k:k + 4]) for k in range(len(ws) - 3)] or [b" ".join(ws)]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_components_against_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 480)]
    df = spark.createDataFrame(edges, "a long, b long")
    label = {r.node: r.label for r in components(df).collect()}
    root = classes(500, edges)
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert set(label) == nodes
    for x in nodes:
        for y in nodes:
            if x < y:
                assert (label[x] == label[y]) == (root[x] == root[y])
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_fingerprint_bits():
    rng = random.Random(3)
    texts = [*ODD_TEXTS, "A B c\x0bD", "one two three", "a b c d", *[prose(rng, n) for n in (1, 3, 4, 5, 200)]]
    assert simhash.fingerprint(texts).tolist() == [plain_fingerprint(t) for t in texts]


def test_pivot_keys_share_a_bucket_within_four_bits():
    rng = np.random.default_rng(5)
    table = simhash.PivotTable(4, 7)
    x = rng.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 200, dtype=np.uint64)
    y = x.copy()
    for k in range(200):
        for bit in rng.choice(64, 4, replace=False):
            y[k] ^= np.uint64(1) << np.uint64(bit)
    assert (table.keys(x) == table.keys(y)).any(axis=1).all()
    assert (np.abs(table.distances(x).astype(int) - table.distances(y).astype(int)).max(axis=1) <= 4).all()


@pytest.mark.parametrize("bucket_rows", [2048, 8])
def test_simhash_against_brute_force(spark, bucket_rows):
    """Planted copies and edits; small buckets force the split of large ones."""
    rng = random.Random(6)
    base = [prose(rng, 120) for _ in range(25)]
    texts = list(ODD_TEXTS) + base
    for t in base:
        for _ in range(8):
            ws = t.split()
            ws[rng.randrange(len(ws))] = prose(rng, 1)
            texts.append(" ".join(ws))
    df = documents(spark, texts)
    got = simhash.near_duplicates(df, bucket_rows=bucket_rows).collect()
    assert len(got) == len(texts) + 2
    rows = [*enumerate(texts), (None, "text without id"), (3, texts[3])]
    fps = [plain_fingerprint(t) for _, t in rows]
    root = classes(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(least.get(root[k], i), i)
    want = sorted((str(i), fps[k], str(least.get(root[k]))) for k, (i, _) in enumerate(rows))
    assert sorted((str(r.doc_id), r.fp & (1 << 64) - 1, str(r.component_id)) for r in got) == want
    assert len({r.component_id for r in got}) < len(texts)


def test_simhash_empty(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []


def _vectors(seed: int, dim: int, clusters: int, each: int):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(clusters):
        centre = rng.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        for _ in range(each):
            v = centre + rng.uniform(0.0, 0.5) * rng.standard_normal(dim) / math.sqrt(dim)
            out.append([float(np.float32(x)) for x in v])
    return out


@pytest.mark.parametrize("bucket_rows", [2048, 16])
def test_embeddings_against_brute_force(spark, bucket_rows):
    vecs = _vectors(1, 24, 12, 30)
    vecs += [vecs[0], vecs[0], [2 * x for x in vecs[5]], [0.0] * 24, None, [float("nan")] + [1.0] * 23,
             [None] + [1.0] * 23, [float("inf")] * 24, [1.0], [2.0], [-1.0], []]
    rows = [(k, v, "x") for k, v in enumerate(vecs)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, `key` string").repartition(4)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, bucket_rows=bucket_rows).collect()}
    ok = [v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vecs]
    edges = set()
    for i in range(len(vecs)):
        for j in range(i):
            if ok[i] and ok[j] and len(vecs[i]) == len(vecs[j]):
                a, b = np.float32(vecs[i]).astype(float), np.float32(vecs[j]).astype(float)
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.95:
                    edges.add((i, j))
    links = [0] * len(vecs)
    for i, j in edges:
        links[i] += 1
        links[j] += 1
    root = classes(len(vecs), edges)
    found = sum(r.n_links for r in got.values())
    assert found >= 0.995 * sum(links)                         # recall; never more than the truth
    assert all(got[k].n_links <= links[k] for k in range(len(vecs)))
    assert sum(got[k].component_id == root[k] for k in range(len(vecs))) >= 0.99 * len(vecs)
    assert all(got[k].kept == (got[k].component_id == k) for k in range(len(vecs)))
    assert all(got[k].n_links == 0 and got[k].kept for k in range(len(vecs)) if not ok[k])


def test_unbiased_estimate_and_bound():
    rng = np.random.default_rng(9)
    dim, errors, inside = 64, [], []
    for turn in range(40):
        codes = embedding_dedup.Codes(dim, 8, 8)
        codes.turns[0] = embedding_dedup.rotation(dim, 100 + turn)
        x = embedding_dedup.unit_rows(rng.standard_normal((60, dim)))
        turned, signs, f = codes.factors(x)
        guess = (signs[:30] * turned[30:]).sum(axis=1) / f[:30]
        true = (x[:30] * x[30:]).sum(axis=1)
        errors.append(guess - true)
        spread = embedding_dedup.CONFIDENCE * np.sqrt(1 / f[:30] ** 2 - 1) / math.sqrt(dim - 1)
        inside.append(np.abs(guess - true) <= spread)
    errors = np.concatenate(errors)
    assert abs(errors.mean()) < 3 * errors.std() / math.sqrt(len(errors)) + 1e-3
    assert np.concatenate(inside).mean() > 0.999


def test_stored_codes_and_factors(spark):
    """What is stored with a vector is what its rotation gives."""
    vecs = _vectors(4, 20, 3, 10) + [[1.0, -2.0, 0.5]]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vecs)], "vec_id long, embedding array<float>")
    clean, kind = embedding_dedup.clean_vectors(df, "vec_id", "embedding")
    got = embedding_dedup.coded(clean, kind).collect()
    assert len(got) == len(vecs)
    for r in got:
        dim = len(vecs[r.vec_id])
        codes = embedding_dedup.Codes(dim, 8, 8)
        x = embedding_dedup.unit_rows(np.asarray([vecs[r.vec_id]], dtype=np.float32).astype(float))
        _, signs, f = codes.factors(x)
        assert r.factor == pytest.approx(f[0])
        assert (codes.signs(pa.chunked_array([pa.array([bytes(r.code)])])) == signs).all()


def test_null_and_repeated_vector_ids(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    df = spark.createDataFrame([(5, a), (5, a), (None, a), (7, b), (None, None)], "vec_id long, embedding array<float>")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in embedding_dedup.near_duplicates(df).collect())
    assert got == [("5", 2, "5", True), ("5", 2, "5", True), ("7", 0, "7", True), ("None", 0, "None", False), ("None", 2, "5", False)]


def test_hot_bucket_is_split_before_it_reaches_a_task(spark):
    """One key with two thirds of the rows, joins never broadcast."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        rows = spark.range(n, numPartitions=8).select(
            F.expr(f"if(id < {2 * n // 3}, -1, id % 5000)").cast("long").alias("key"), F.xxhash64("id").alias("fp"))
        out = buckets.split_buckets(rows, "fp", 2_000)
        got = out.groupBy("key", "lo", "hi").count().collect()
        plan = out._jdf.queryExecution().executedPlan()
        out.collect()
        assert "skew=true" in plan.toString()
        assert max(r["count"] for r in got) < 5_000
        assert sum(r["count"] for r in got if r.key == -1 and r.lo == r.hi) == 2 * n // 3
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_embeddings_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.near_duplicates(df).collect() == []


def test_forest_and_pairs():
    group = np.asarray([0, 0, 0, 1, 1, 2])
    zero = np.zeros(6, dtype=int)
    seen = []
    buckets.pairs(group, zero, zero, zero, lambda i, j: seen.extend(zip(i.tolist(), j.tolist())))
    assert sorted(seen) == [(0, 1), (0, 2), (1, 2), (3, 4)]
    forest = buckets.Forest(6)
    forest.add(np.asarray([5, 4, 1]), np.asarray([4, 1, 0]))
    assert forest.root.tolist() == [0, 0, 2, 3, 0, 0]
