import numpy as np
import pytest

from riskweave.llm import ann, topk
from riskweave.llm.ann import ann_search, hadamard, layout, nearest_buckets, signed_axes
from riskweave.llm.topk import exact_topk

SCHEMA = "vec_id long, embedding array<float>, label int, v string, b int, low string, bucket int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, "y", 2) for i, v in rows], SCHEMA)


def vectors(n=400, dims=16, seed=0, copies=30):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dims)).astype(np.float32)
    m[100:100 + copies] = m[min(7, n - 1)]
    return [(int(i), [float(x) for x in m[i]]) for i in range(n)]


BAD = [(10_000, None), (10_020, [None] * 16), (10_040, [float("nan")] * 16), (10_060, [float("inf")] * 16),
       (None, [1.0] * 16), (10_100, []), (10_200, [1.0, 2.0])]


def brute_topk(rows, every, k):
    ids = np.array([i for i, _ in rows])
    m = np.floor(64 * np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)).astype(np.int64)
    out = []
    for i in np.unique(ids[ids % every == 0]):
        s = m @ m[np.flatnonzero(ids == i)[0]]
        best = sorted((-int(s[j]), int(ids[j])) for j in range(len(ids)) if ids[j] != i)[:k]
        out += [(int(i), r + 1, j, -x) for r, (x, j) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("rows,scale", [(vectors(), 1), (vectors(15), 1), (vectors(300, seed=3, copies=200), 1000)])
def test_topk_against_brute_force(spark, monkeypatch, rows, scale):
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 64)
    rows = [(i, [x * scale for x in v]) for i, v in rows]
    got = sorted(tuple(r) for r in exact_topk(table(spark, rows + BAD), every=20, k=20).collect())
    assert got == brute_topk(rows, 20, 20)


def test_topk_repeated_rows_and_empty_table(spark):
    rows = vectors(60)
    got = sorted(tuple(r) for r in exact_topk(table(spark, rows + rows[1:2]), every=20, k=5).collect())
    assert got == brute_topk(rows + rows[1:2], 20, 5)
    assert exact_topk(table(spark, [])).count() == 0 and exact_topk(table(spark, BAD[:4])).count() == 0


def brute_near(rows, every, k):
    ids = np.array([i for i, _ in rows])
    m = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    out = {}
    for i in ids[ids % every == 0]:
        d = np.sqrt(((m - m[np.flatnonzero(ids == i)[0]]) ** 2).sum(axis=1))
        out[int(i)] = sorted((d[j], int(ids[j])) for j in range(len(ids)) if ids[j] != i)[:k]
    return out


def test_ann_recall_scores_and_order(spark, monkeypatch):
    monkeypatch.setattr(ann, "BUCKET_ROWS", 20)
    rows = vectors(800, 32, 5)
    got = ann_search(table(spark, rows + BAD + [(10_300, [0.0] * 32)]), every=10, k=10).collect()
    want = brute_near(rows, 10, 10)
    m = {i: np.array(v) for i, v in rows}
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
        assert abs(r.score - np.linalg.norm(m[r.query_id] - m[r.vec_id])) < 1e-9
    assert set(found) == set(want)
    hits = 0
    for q, best in found.items():
        best.sort()
        assert [x[0] for x in best] == list(range(1, 11)) and [x[1:] for x in best] == sorted(x[1:] for x in best)
        hits += len({x[2] for x in best} & {j for _, j in want[q]})
    assert hits / (10 * len(want)) >= 0.9


def test_ann_few_candidates_and_empty_table(spark):
    rows = vectors(6)
    got = sorted((r.query_id, r.rank, r.vec_id) for r in ann_search(table(spark, rows), every=3, k=10).collect())
    want = brute_near(rows, 3, 10)
    assert got == sorted((q, r + 1, j) for q, best in want.items() for r, (_, j) in enumerate(best))
    assert ann_search(table(spark, [])).count() == 0


def test_hadamard_is_a_rotation_and_axes_are_nearest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(hadamard(hadamard(x)), x)
    near = signed_axes(x, (1, 0), 64)
    assert np.allclose(near[:, :64], -near[:, 64:]) and np.allclose((near[:, :64] ** 2).sum(axis=1), 1)


def test_probed_buckets_are_those_of_least_loss():
    x = np.random.default_rng(2).normal(size=(7, 12))
    axes = [16, 4]
    a, b = (signed_axes(x, (1, 3, i), n) for i, n in enumerate(axes))
    loss = ((a.max(axis=1, keepdims=True) - a) ** 2)[:, :, None] + ((b.max(axis=1, keepdims=True) - b) ** 2)[:, None, :]
    order = np.argsort(loss.reshape(7, -1), axis=1)
    assert (np.sort(nearest_buckets(x, axes, 3, 9, 1), axis=1) == np.sort(order[:, :9], axis=1)).all()
    assert (nearest_buckets(x, axes, 3, 1, 1) == order[:, :1]).all()


def test_probed_share_falls_as_the_table_grows():
    shares = []
    for rows in (10 ** 3, 10 ** 5, 10 ** 7, 10 ** 9, 10 ** 12):
        axes, probes = layout(rows, 64, 6, 64, ann.EFFORT)
        buckets = int(np.prod([2 * n for n in axes]))
        assert probes <= 128 and buckets <= 1 << 14 and len(axes) >= 2
        shares.append(6 * probes / buckets)
    assert shares == sorted(shares, reverse=True) and shares[-1] < shares[0] / 10
    assert layout(10, 1, 6, 64, ann.EFFORT)[1] >= 1


@pytest.mark.parametrize("rows", [2_000, 20_000])
def test_recall_holds_at_two_sizes_for_random_directions(rows):
    m = np.random.default_rng(rows).normal(size=(rows, 64))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    q = np.arange(0, rows, rows // 50)
    axes, probes = layout(rows, 64, 6, 64, ann.EFFORT)
    seen = np.zeros((len(q), rows), bool)
    for t in range(6):
        place = nearest_buckets(m, axes, t, 1, 11)[:, 0]
        for i, probed in enumerate(nearest_buckets(m[q], axes, t, probes, 11)):
            seen[i] |= np.isin(place, probed)
    score = m[q] @ m.T
    score[np.arange(len(q)), q] = -2
    best = np.argsort(-score, axis=1)[:, :10]
    assert np.take_along_axis(seen, best, 1).mean() >= 0.93
    assert seen.mean() < 6 * probes / np.prod([2 * n for n in axes])


def test_each_length_is_searched_by_itself(spark):
    rows, longer = vectors(60), [(10_000 + i, v) for i, v in vectors(50, 17, 4)]
    got = sorted(tuple(r) for r in exact_topk(table(spark, rows + longer), every=20, k=5).collect())
    assert got == sorted(brute_topk(rows, 20, 5) + brute_topk(longer, 20, 5))
    one = [(10_001, [1.0] * 17)]  # one odd row takes nothing away
    assert sorted(tuple(r) for r in exact_topk(table(spark, rows + one), every=20, k=5).collect()
                  ) == brute_topk(rows, 20, 5)
    near = ann_search(table(spark, vectors(6) + one), every=3, k=10).collect()
    assert {(r.query_id, r.vec_id) for r in near} == {(q, j) for q in (0, 3) for j in range(6) if j != q}
