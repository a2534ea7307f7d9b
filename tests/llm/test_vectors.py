import numpy as np
import pytest
from pyspark.sql import functions as F

from optionflow.llm import hilbert, vafile, vectors

SF = "/root/testdata/sf0.01"


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score string")


def brute(rows, k, score, ok):
    """Best k per query id divisible by 50, over (id, vector) rows."""
    good = [(i, v) for i, v, *_ in rows if i is not None and v is not None and ok(v)]
    out = set()
    for q in {i for i, _ in good if i % 50 == 0}:
        best = {}
        for j, w in good:
            for i, v in good:
                if i == q and j != q:
                    best[j] = max(best.get(j, -np.inf), score(v, w))
        top = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out |= {(q, r + 1, j, s) for r, (j, s) in enumerate(top)}
    return out


def finite(v):
    return all(x is not None and np.isfinite(x) for x in v)


def whole(v):
    return [int(np.floor(256 * float(np.float32(x)))) for x in v]


def inner(a, b):
    return sum(x * y for x, y in zip(whole(a), whole(b)))


def odd_rows():
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6)], "x") for i in range(120)]
    rows += [(200, rows[3][1], "tie"), (201, rows[3][1], "tie"), (50, rows[50][1], "again"), (7, rows[8][1], "again")]
    rows += [(None, rows[0][1], "x"), (300, None, "x"), (301, [1.0, None], "x"), (302, [float("nan")] * 6, "x")]
    rows += [(303, [float("inf")] * 6, None), (304, [0.0] * 6, "zero"), (350, [0.5, 0.5], "short"), (351, [], "empty")]
    return rows


def test_va_file_equals_brute_force(spark):
    rows = odd_rows()
    df = table(spark, rows)
    got = vafile.topk(df, df.filter("vec_id % 50 = 0"), k=5)
    assert {tuple(r) for r in got.collect()} == brute(rows, 5, inner, finite)


def test_va_file_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(vafile, "BLOCK_ROWS", 7)
    monkeypatch.setattr(vafile, "MOST_ROWS", 7)
    rows = odd_rows()
    df = table(spark, rows)
    got = vafile.topk(df, df.filter("vec_id % 50 = 0"), k=3)
    assert {tuple(r) for r in got.collect()} == brute(rows, 3, inner, finite)


@pytest.mark.parametrize("scale", [1, 2**20, 2**50, 2**62])
def test_bounds_hold(scale):
    rng = np.random.default_rng(2)
    v, q = rng.integers(-200, 200, (500, 16)) * (scale // 200 or 1), rng.integers(-200, 200, (9, 16))
    grid = vafile.Grid(v.min(0).tolist(), v.max(0).tolist())
    cells = grid.cells(v)
    low, high = grid.bounds(q, cells)
    want = q.astype(object) @ v.T.astype(object)
    assert all(a <= x <= b for a, x, b in zip(low.ravel(), want.ravel(), high.ravel()))
    # the bounds leave few vectors
    certain = vafile.certain(low, np.arange(500), np.arange(500), 6)
    assert ((high >= certain[:, None]).sum(1) < 60).all()


def test_certain_bound_counts_ids_once():
    lower = np.array([[5.0, 4, 3, 2, 1]])
    assert vafile.certain(lower, np.array([1, 1, 1, 2, 3]), np.arange(5), 2).tolist() == [2]
    assert vafile.certain(lower, np.array([7, 8, 9]), np.array([0, 0, 4]), 2).tolist() == [5]
    assert vafile.certain(lower, np.array([1, 1]), np.array([0, 1]), 2).tolist() == [-np.inf]


def test_large_components_are_exact(spark):
    rows = [(0, [1.0, 0.0], "q"), (1, [2e6, 1.0], "x"), (2, [3e6, 0.0], "x"), (3, [1.1e6, 5.0], "x"), (4, [-3e7, 2.0], "x"), (50, [2.0**20, -(2.0**21)], "q")]
    df = table(spark, rows)
    got = vafile.topk(df, df.filter("vec_id % 50 = 0"), k=5)
    assert {tuple(r) for r in got.collect()} == brute(rows, 5, inner, finite)
    assert {(r.vec_id, r.score) for r in got.collect() if r.query_id == 0} >= {(1, 131072000000), (2, 196608000000)}
    far = table(spark, [(0, [2.0**45], "q"), (7, [2.0**30], "x")]).filter("vec_id = 7")
    asked = table(spark, [(0, [2.0**45], "q")])
    with pytest.raises(Exception, match="vec_id 7"):
        vafile.topk(far, asked, k=5).collect()
    with pytest.raises(Exception, match="does not fit a long"):
        vafile.topk(table(spark, [(0, [2.0**60], "q")]), asked, k=5).collect()


def test_one_id_many_times(spark):
    rng = np.random.default_rng(9)
    rows = [(7, [float(x) for x in rng.normal(size=3) + 5], "again") for _ in range(3000)]
    rows += [(7, [9.0, 9.0, 9.0], "same")] * 2000 + [(i, [float(x) for x in rng.normal(size=3)], "x") for i in range(50, 120)]
    df = table(spark, rows)
    got = {tuple(r) for r in vafile.topk(df, df.filter("vec_id % 50 = 0"), k=5).collect()}
    assert got == brute(list({(i, tuple(v)) for i, v, _ in rows}), 5, inner, finite)


def test_blocks_take_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(1)
    v, q = rng.integers(-300, 300, (16384, 64)), rng.integers(-300, 300, (16384, 64))
    grid = vafile.Grid(v.min(0).tolist(), v.max(0).tolist())
    cells = grid.cells(v)
    tracemalloc.start()
    for part in vectors.slices(len(q), len(v))[:3]:
        low, high = grid.bounds(q[part], cells)
        vafile.certain(low, np.arange(len(v)), np.arange(len(v)), 6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6


def test_searches_of_empty_tables(spark):
    none = table(spark, [])
    assert vafile.topk(none, none, 5).count() == 0
    assert hilbert.nearest(none, F.col("vec_id") % 50 == 0, 5).count() == 0


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3)])
def test_curve_visits_neighbouring_cells(dimensions, bits):
    axes = np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij")
    cells = np.stack([a.ravel() for a in axes], 1)
    place = hilbert.curve_place(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1) == 1).all()


def cosine(a, b):
    n = max(len(a), len(b))
    a, b = (np.pad(np.array(v, np.float32).astype(float), (0, n - len(v))) for v in (a, b))
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


def test_hilbert_with_whole_windows_is_exact(spark):
    rows = odd_rows()
    got = hilbert.nearest(table(spark, rows), F.col("vec_id") % 50 == 0, k=5, share=1.0)
    want = brute(rows, 5, cosine, lambda v: finite(v) and any(v))
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in got.collect()}
    assert {(q, r): i for q, r, i, _ in want} == {k: i for k, (i, _) in found.items()}
    assert all(abs(found[q, r][1] - s) < 1e-12 for q, r, _, s in want)


def test_hilbert_recall(spark):
    data = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding)) for r in data.collect()]
    want = {(q, i) for q, _, i, _ in brute(rows, 5, lambda a, b: float(a @ b), finite)}
    got = hilbert.nearest(data, F.col("vec_id") % 50 == 0, k=5).collect()
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want)
    assert len(got) == len(want)


def test_hilbert_recall_with_a_large_group_of_copies(spark):
    """A third of the rows are copies of one vector, some of them asked for."""
    data = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = data + [(1000 + 7 * i, data[17][1]) for i in range(len(data) // 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    arrays = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    unit = np.stack([v / np.sqrt((v * v).sum()) for _, v in arrays])
    ids = np.array([i for i, _ in arrays])
    want = set()
    for row in np.flatnonzero(ids % 50 == 0):
        scores = np.round(unit @ unit[row], 9)
        others = np.flatnonzero(ids != ids[row])
        top = others[np.lexsort((ids[others], -scores[others]))[:5]]
        want |= {(int(ids[row]), int(ids[t])) for t in top}
    got = {(r.query_id, r.vec_id) for r in hilbert.nearest(df, F.col("vec_id") % 50 == 0, k=5).collect()}
    assert len(got & want) >= 0.9 * len(want)


def test_no_pair_is_scored_twice():
    rng = np.random.default_rng(3)
    places = np.stack([rng.permutation(400) for _ in range(8)], 1)
    firsts = np.minimum(np.maximum(places[:50] - 36, 0), 400 - 72)
    times = sum(hilbert.in_windows(firsts, places, 72, c).astype(int) for c in range(8))
    covered = np.zeros((50, 400), bool)
    for c in range(8):
        at = places[:, c] - firsts[:, c : c + 1]
        covered |= (at >= 0) & (at < 72)
    assert times.max() == 1 and (times == covered).all() and times.sum(1).max() < 400
