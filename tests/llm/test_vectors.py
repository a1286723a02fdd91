"""Whitening and hard negatives against brute force, and the language model's
probabilities against a plain one."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeforge.llm import bidiagonal, interpolate, negatives, queries, whiten

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def vectors(spark):
    """Clustered vectors with nulls, other lengths, copies, a null id and a repeated one."""
    queries.ship(spark)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 10))
    rows = []
    for i in range(700):
        v = (centres[i % 6] + 0.4 * rng.normal(size=10)).astype(np.float32).astype(float).tolist()
        rows.append((i, v, int(rng.integers(0, 4))))
    same = rows[50][1]
    rows += [(1000 + i, same, i % 3) for i in range(200)]  # copies: a hot cell
    rows += [(100, rows[3][1], 1), (100, rows[3][1], 1), (None, rows[4][1], 2), (2001, None, 1), (2002, [None] + same[1:], 1), (2003, [float("nan")] + same[1:], 1),
             (2004, [float("inf")] + same[1:], 1), (2005, [], 0), (2050, same[:4], 0), (2100, same, None), (2150, [0.0] * 10, 1)]
    shape = "vec_id bigint, embedding array<float>, label int, score double, n string, whitened string, v int"
    return spark.createDataFrame([(*r, 0.5, "x", "y", 1) for r in rows], shape).repartition(7)


def usable(rows, label=False):
    return [r for r in rows if r["embedding"] is not None and len(r["embedding"]) == 10 and all(x is not None and math.isfinite(x) for x in r["embedding"]) and (not label or r["label"] is not None)]


def test_right_vectors_against_numpy():
    rng = np.random.default_rng(0)
    cases = [rng.normal(size=(90, 24)), rng.normal(size=(90, 24)) * np.logspace(0, -6, 24), rng.normal(size=(4, 9)), np.eye(12), np.zeros((3, 4)), rng.normal(size=(5, 1)),
             np.diag([3.0, 3, 3, 2, 1, 0, 0, 0]), np.diag(np.abs(np.arange(-10.0, 11))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)]
    cases += [rng.integers(-2, 3, size=(int(rng.integers(1, 40)), int(rng.integers(2, 20)))).astype(float) for _ in range(40)]
    for a in cases:
        d = a.shape[1]
        squares, v = bidiagonal.right_vectors(np.linalg.qr(a, mode="r"), d)
        top = max(np.linalg.norm(a, 2) ** 2, 1e-300)
        want = np.linalg.svd(a, compute_uv=False) ** 2
        assert np.abs(squares - np.pad(want, (0, d - len(want)))).max() <= 1e-12 * top
        assert np.abs(v.T @ v - np.eye(d)).max() < 1e-10
        assert np.abs(a.T @ (a @ v) - v * squares).max() <= 1e-12 * top


def test_dqds_is_accurate_for_each_value():
    a, b = np.logspace(0, -8, 20), 0.3 * np.logspace(0, -8, 19)
    want = np.linalg.svd(np.diag(a) + np.diag(b, 1), compute_uv=False) ** 2
    # numpy itself is accurate to the largest value only; the product of all is exact
    got = bidiagonal.dqds(a, b)
    assert np.abs(got[:8] / want[:8] - 1).max() < 1e-10
    assert abs(np.log(got).sum() - 2 * np.log(a).sum()) < 1e-11


def test_whitening(vectors):
    rows = usable(vectors.collect())
    x = np.floor(64 * np.asarray([r["embedding"] for r in rows], dtype=float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (x - 1_000_000) - (sums - n * 1_000_000) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    got = whiten.components(vectors, most=6).collect()
    assert len(got) == 6 * n and {r["n"] for r in got} == {n}
    key = lambda r: (r["vec_id"] is None, r["vec_id"] or 0)
    deviation = sorted((-1 if i is None else i, int(d)) for i, d in zip([r["vec_id"] for r in rows], ((n * x - sums) ** 2).sum(axis=1), strict=True))
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["deviation"]) for r in got if r["component"] == 1) == deviation
    for c in range(6):
        want = np.sort(np.abs(centred @ directions[:, -1 - c] / np.sqrt(values[-1 - c])))
        mine = sorted((r for r in got if r["component"] == c + 1), key=key)
        assert np.abs(np.sort(np.abs([r["whitened"] for r in mine])) - want).max() < 1e-9
        assert all(abs(r["explained"] / (values[-1 - c] / values.sum()) - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in mine)
    assert whiten.components(vectors.where("false")).count() == 0
    assert whiten.components(vectors.where("embedding is null")).count() == 0


def test_whitening_of_few_directions(spark, vectors):
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(5)], "vec_id bigint, embedding array<double>")
    got = whiten.components(flat).collect()
    assert [r["whitened"] is None for r in sorted(got, key=lambda r: (r["component"], r["vec_id"]))] == [False] * 5 + [True] * 10
    assert {(r["component"], round(r["explained"], 12)) for r in got} == {(1, 1.0), (2, 0.0), (3, 0.0)}
    one = whiten.components(flat.limit(1)).collect()
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(0, None, 0.0, 0.0)] * 3


def test_partial_results_are_combined_in_groups(vectors, monkeypatch):
    whole = whiten.fit(vectors)
    monkeypatch.setattr(whiten, "FAN", 4)
    parts = whiten.fit(vectors)
    assert np.abs(whole.values - parts.values).max() < 1e-9 * whole.values[0] and parts.identity_error < 1e-9


def test_exact_deviations_of_large_numbers():
    x = np.asarray([[1 << 40, 3], [5, -(1 << 30)]])
    assert whiten._deviations(x, 3, np.asarray([7, 9])) == [None if v >= 1 << 63 else v for v in ((3 * (1 << 40) - 7) ** 2, 16 + (3 * (1 << 30) + 9) ** 2)]


def mined(rows, rule):
    rows = usable(rows, label=True)
    x = np.floor(256 * np.asarray([r["embedding"] for r in rows], dtype=float)).astype(np.int64)
    out = []
    for a, anchor in enumerate(rows):
        if anchor["vec_id"] is None or anchor["vec_id"] % 50:
            continue
        score = x @ x[a]
        order = sorted(range(len(rows)), key=lambda k: (-score[k], -1 if rows[k]["vec_id"] is None else rows[k]["vec_id"]))
        for p in [k for k in order if k != a and rows[k]["label"] == anchor["label"]][:rule.positives]:
            allowed = [k for k in order if rows[k]["label"] != anchor["label"] and rule.low * score[p] <= 100 * score[k] <= rule.high * score[p]]
            out += [(anchor["vec_id"], rows[p]["vec_id"], rank, rows[k]["vec_id"], int(score[p]), int(score[k])) for rank, k in enumerate(allowed[:rule.negatives], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [16, 100_000])
def test_hard_negatives(vectors, block):
    rule = negatives.Rule()
    got = negatives.mine(vectors, F.col("id") % 50 == 0, block=block).collect()
    assert sorted(map(tuple, got), key=str) == mined(vectors.collect(), rule)


def test_hard_negatives_of_few_rows(spark, vectors):
    assert negatives.mine(vectors.where("false"), F.col("id") % 50 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0], 1), (1, [1.0], 1), (2, [0.7], 2)], "vec_id bigint, embedding array<double>, label int")
    assert [tuple(r) for r in negatives.mine(few, F.col("id") % 50 == 0).collect()] == [(0, 1, 1, 2, 65536, 45824)]
    assert negatives.mine(few, F.col("id") == 2).count() == 0  # no positives
    assert negatives.mine(few, F.col("id") == 7).count() == 0  # no anchors


def test_cells_are_visited_by_falling_bounds():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = rng.integers(-4, 5, rng.integers(1, 7)).astype(float), rng.integers(-4, 5, rng.integers(1, 7)).astype(float)
        seen = list(negatives.visit(a, b))
        assert [s for s, _, _ in seen] == sorted((x + y for x in a for y in b), reverse=True)
        assert len({(i, j) for _, i, j in seen}) == len(a) * len(b)


def test_index_leaves_cells_out(spark):
    """Searches end before they have seen all cells."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(2000, 8)) * 200
    x = (x + 3000 * rng.integers(0, 2, size=(2000, 8))).astype(np.int64)
    books = tuple(negatives.codebook(p.astype(float), 16) for p in negatives._halves(x))
    near = [negatives.nearest(p, b)[0] for p, b in zip(negatives._halves(x.astype(float)), books, strict=True)]
    shard = negatives.Shard(np.arange(2000), np.arange(2000), np.zeros(2000), x, *near, books)
    q = x[:1]
    bounds = [tuple(part[0] for part in half) for half in shard.bounds(q)]
    looked = []
    score = shard.scores
    shard.scores = lambda *args: looked.append(args[2] - args[1]) or score(*args)
    wanted = negatives.First(5, -math.inf)
    negatives.search(shard, q[0], bounds, np.ones(2000, dtype=bool), [wanted])
    assert wanted.found == sorted(zip((-(x @ q[0])).tolist(), range(2000), strict=True))[:5]
    assert sum(looked) < 1000


DOCS = [(i, t) for i, t in enumerate(["the cat sat on the mat", "The cat ran", "a dog sat", None, "", "the cat sat on the mat again", "x y z", "the dog ran on the mat"] * 9)] + [(None, "the cat sat"), (500, "word " * 5000)]


def tokens(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")] + [None]


def crc(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 7


@pytest.mark.parametrize(("order", "chunk"), [(1, 1 << 21), (2, 40), (3, 40)])
def test_language_model(spark, monkeypatch, order, chunk):
    monkeypatch.setattr(interpolate, "BUCKET", 100)
    make = interpolate.chunks
    monkeypatch.setattr(interpolate, "chunks", lambda docs, role: make(docs, role, chunk))
    learned = {}
    table = interpolate._table
    monkeypatch.setattr(interpolate, "_table", lambda weights, n: learned.setdefault("table", table(weights, n)))
    queries.ship(spark)
    docs = spark.createDataFrame([(*d, "en", 1.0, True) for d in DOCS], "doc_id bigint, text string, lang string, score double, held_out boolean").repartition(3)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    got = sorted(interpolate.score(docs, held, order=order).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    assert len(got) == len(DOCS)
    count = [collections.Counter() for _ in range(order + 1)]
    texts = 0
    for doc_id, text in DOCS:
        if crc(doc_id) != 2:
            texts += 1
            line = ["<s>"] * (order - 1) + tokens(text)
            for at in range(order - 1, len(line)):
                for m in range(1, order + 1):
                    count[m][tuple(line[at - m + 1:at + 1])] += 1
    total, types = sum(count[1].values()), len(count[1])
    for r, (doc_id, text) in zip(got, sorted(DOCS, key=lambda d: (d[0] is None, d[0] or 0)), strict=True):
        line = ["<s>"] * (order - 1) + tokens(text)
        score = base = 0.0
        for at in range(order - 1, len(line)):
            bucket, estimates = 0, [1 / (types + 1), count[1][(line[at],)] / total]
            for m in range(2, order + 1):
                context = tuple(line[at - m + 1:at])
                seen = texts if at == order - 1 else count[m - 1][context]
                if seen:
                    bucket = 64 * (m - 1) + int(math.log2(seen))
                estimates.append(count[m][tuple(line[at - m + 1:at + 1])] / seen if seen else 0.0)
            score += math.log10(sum(w * e for w, e in zip(learned["table"][bucket], estimates, strict=True)))
            base += math.log10((count[1][(line[at],)] + 1) / (total + types + 1))
        known = sum(count[1][(t,)] > 0 for t in tokens(text))
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (doc_id, crc(doc_id) == 2, len(tokens(text)), known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)
    if order > 1:  # copies of texts are held out: longer contexts must help
        assert sum(r["score"] for r in got if r["held_out"]) > sum(r["base_score"] for r in got if r["held_out"])


def test_language_model_of_nothing(spark):
    queries.ship(spark)
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert interpolate.score(none, F.lit(False)).count() == 0
    untrained = interpolate.score(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string"), F.lit(True)).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in untrained) == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]


def test_expectation_maximisation():
    """Weights near those that made the data, and likelier than any small change."""
    rng = np.random.default_rng(4)
    estimates = np.concatenate((np.full((400, 1), 0.01), rng.random((400, 2))), axis=1)
    n = rng.integers(1, 50, 400).astype(float)
    w = interpolate.expectation_maximisation(estimates, n, 2, rounds=5000, tolerance=1e-12)
    likely = lambda w: (n * np.log(estimates @ w)).sum() + np.log(w).sum()
    for _ in range(200):
        other = np.abs(w + rng.normal(size=3) * 0.01)
        assert likely(w) >= likely(other / other.sum()) - 1e-6
    assert interpolate.expectation_maximisation(estimates, n, 1)[2] == 0


def test_packed_numbers():
    for x in (np.zeros(0, dtype=np.uint64), np.asarray([0, 1, 255, 256, (1 << 64) - 1], dtype=np.uint64), np.arange(5000)):
        assert (interpolate.unpack(interpolate.pack(x)) == x.astype(np.uint64)).all()
