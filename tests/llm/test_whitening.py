from fractions import Fraction

import numpy as np
import pytest

from optionflow.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def whole(v):
    return tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)


def brute(rows):
    """Exact sums of the distinct vectors, and the covariance from whole numbers by its definition."""
    good = [(i, whole(v)) for i, v, *_ in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(len(x) for _, x in good)
    good = [(i, x + (0,) * (width - len(x))) for i, x in good]
    distinct = sorted({x for _, x in good})
    n, total = len(distinct), [sum(c) for c in zip(*distinct)]
    y = [[n * a - s for a, s in zip(x, total)] for x in distinct]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(width)] for i in range(width)])
    return good, n, total, v


def odd_rows():
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6) * [3, 2, 1, 0.5, 0.2, 0.1]], "x") for i in range(90)]
    rows += [(100 + i, rows[5][1], "copy") for i in range(45)] + [(7, rows[8][1], "again"), (None, rows[9][1], "no id")]
    rows += [(200, None, "x"), (201, [1.0, None] * 3, "x"), (202, [float("nan")] * 6, "x"), (203, [float("inf")] * 6, "x")]
    return rows + [(204, [0.5, -0.25], "short"), (205, [], "empty"), (206, [0.0, -0.0] * 3, "zero")]


def held_against_brute_force(got, rows):
    good, n, total, v = brute(rows)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    assert sorted((-1 if i is None else i for i, _ in good for _ in range(4))) == sorted(-1 if r.vec_id is None else r.vec_id for r in got)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    want = {}
    for i, x in good:
        far = sum((n * a - s) ** 2 for a, s in zip(x, total))
        w = (np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, total)]) @ vectors) / np.sqrt(values)
        want.setdefault(i, []).append((far, w))
    signs = np.sign([next(r.whitened for r in got if r.vec_id == good[0][0] and r.component == c + 1) for c in range(4)])
    signs *= np.sign(want[good[0][0]][0][1])
    for r in got:
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-9)
        close = [abs(r.whitened - signs[r.component - 1] * w[r.component - 1]) < 1e-8 for far, w in want[r.vec_id] if far == r.deviation]
        assert any(close)


def test_whitening_equals_exact_brute_force(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, n string")
    held_against_brute_force(whitening.whiten(df).collect(), rows)


def test_query_equals_exact_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    held_against_brute_force(queries.op12_polarised_whitening(spark, SF).collect(), rows)


def test_large_components_lose_nothing(spark):
    rng = np.random.default_rng(5)
    far = np.float32(2.0**40)
    rows = [(i, [float(far), *(float(np.float32(x)) for x in rng.normal(size=4) * 2.0**33)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    model, _ = whitening.fit(df)
    _, n, total, v = brute(rows)
    assert model.n == n and list(model.sums) == total
    assert np.allclose(model.values, np.linalg.eigvalsh(v)[::-1][:4], rtol=1e-12)
    # sums of squares beyond a long are null
    assert {r.deviation for r in whitening.whiten(df).collect()} == {None}


def test_squares_are_exact_at_every_size():
    for scale in (1, 2**20, 2**40, 2**61):
        x = np.array([[scale, -scale, 3], [7, scale - 1, -scale], [0, 5, scale]], np.int64)
        centre = [sum(c) // 3 for c in x.tolist() and zip(*x.tolist())]
        z = [[int(a) - c for a, c in zip(row, centre)] for row in x.tolist()]
        want = [sum(r[i] ** 2 for r in z) for i in range(3)]
        want += [sum((r[i] + r[j]) ** 2 for r in z) for i in range(3) for j in range(i + 1, 3)]
        assert whitening.squares(x, centre) == want
        total = [sum(c) for c in zip(*x.tolist())]
        v = whitening.covariance(3, total, want)
        y = [[3 * a - s for a, s in zip(row, total)] for row in x.tolist()]
        assert v[0][1] == float(Fraction(sum(r[0] * r[1] for r in y), 27))


def test_degenerate_tables(spark):
    schema = "vec_id bigint, embedding array<float>, deviation string"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0], "x") for i in range(5)], schema)
    assert whitening.whiten(same).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [], "x"), (2, None, "x")], schema)).count() == 0
    # one direction has a variance
    line = spark.createDataFrame([(i, [float(i), float(2 * i)], "x") for i in range(5)], schema)
    assert {r.component for r in whitening.whiten(line).collect()} == {1}
    with pytest.raises(ValueError, match="deviation"):
        whitening.project(same, None)


def test_extra_columns_travel(spark):
    df = spark.createDataFrame([(i, [float(i), float(i * i)], "x", i) for i in range(6)], "vec_id bigint, embedding array<float>, x string, place int")
    model, distinct = whitening.fit(df)
    got = whitening.project(df, model)
    assert got.columns == ["vec_id", "embedding", "x", "place", "deviation", "whitened"]
    w = np.array([r.whitened for r in got.collect()])
    assert np.allclose(w.T @ w / 6, np.eye(2)) and whitening.identity_error(distinct, model, 2) < 1e-9
