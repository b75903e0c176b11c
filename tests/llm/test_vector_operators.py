"""Near-duplicate and whitened embeddings against brute force on small tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import embedding_dedup, moments, whitening
from tidemark.llm.eigen import eigenpairs

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id bigint, embedding array<float>, label int, n string, cell int, whitened int"


def brute_links(rows, threshold=0.98):
    """Number of links, smallest key and whether it is the row's, for each row by its index."""
    def comparable(vec, label):
        return label is not None and vec and all(x is not None and math.isfinite(x) for x in vec) and any(vec)

    n = len(rows)
    links = [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            (a, p), (b, q) = rows[i][1:3], rows[j][1:3]
            if comparable(a, p) and comparable(b, q) and p == q and len(a) == len(b):
                x, y = np.float32(a).astype(float), np.float32(b).astype(float)
                if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(ids, default=None)
        out.append((rows[i][0], len(links[i]), low, rows[i][0] == low))
    return sorted(out, key=repr)


def vector_rows(rng, n, dim, spread):
    """Vectors around some centres, chains of small steps, copies, and two labels, one of them with most rows."""
    rows, centres = [], rng.normal(size=(5, dim)) * np.linspace(3, 0.1, dim)
    for i in range(n):
        vec = centres[rng.integers(5)] + rng.normal(size=dim) * spread
        rows.append((i, vec.tolist(), 0 if i % 4 else 1))
    step = rng.normal(size=dim) * 0.1
    for i in range(30):
        rows.append((n + i, (centres[0] + step * i).tolist(), 0))
    rows += [(2 * n + i, rows[7][1], rows[7][2]) for i in range(20)]
    return rows


@pytest.mark.parametrize(("spread", "tile"), [(0.02, 7), (0.3, 20), (2.0, 2048)])
def test_embedding_links_equal_brute_force(spark, rows, spread, tile):
    table = vector_rows(np.random.default_rng(int(spread * 100)), 180, 12, spread)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in table], SCHEMA)
    got = embedding_dedup.near_duplicates(df, tile=tile)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert rows(got) == brute_links(table)


def test_embedding_links_of_hard_rows(spark, rows):
    table = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, NAN], 0), (5, [1.0, INF], 0), (6, [1.0, None], 0),
        (7, [1.0, 2.0], None), (8, [1.0, 2.0], None), (9, [1.0, 2.0], 3), (10, [2.0, 4.0], 3), (11, [1.0, 2.0, 0.0], 3),
        (12, [1.0, 2.0], 4), (None, [1.0, 2.0], 3), (None, [1.0, 2.0], 3), (None, [0.0, -5.0], 3), (14, [0.0, -0.0], 3),
        (15, [-1.0, -2.0], 3), (9, [1.0, 2.0], 3), (9, [-1.0, -2.0], 3), (16, [3e38, 1e38], 3), (17, [3e-39, 1e-39], 3),
        (18, [0.0, -1.0], 3), (19, [-0.0, -1.0], 3), (None, None, None),
    ]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in table], SCHEMA)
    for tile in (1, 100):
        assert rows(embedding_dedup.near_duplicates(df, tile=tile)) == brute_links(table)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embedding_links_of_text_keys_and_labels(spark, rows):
    df = spark.createDataFrame(
        [("b", [1.0, 1.0], "l"), ("a", [1.0, 1.01], "l"), ("c", [1.0, 1.01], "m")], "vec_id string, embedding array<double>, label string"
    )
    assert rows(embedding_dedup.near_duplicates(df)) == [("a", 1, "a", True), ("b", 1, "a", False), ("c", 0, "c", True)]


def test_cells_hold_every_vector_within_reach():
    rng = np.random.default_rng(3)
    turned = rng.normal(size=(400, 6)) * np.array([1, 0.5, 0.3, 0.2, 0.1, 0.1])
    turn = embedding_dedup.Turn(np.zeros(6), np.eye(6), turned.std(0))
    home, row, met = embedding_dedup.cells(turned, turn.cuts(6, 7), 0.4)
    visits = set(zip(row.tolist(), met.tolist(), strict=True))
    apart = np.sqrt(((turned[:, None] - turned[None]) ** 2).sum(2))
    for i, j in zip(*np.nonzero(apart <= 0.4), strict=True):
        assert home[i] == home[j] or (i, home[j]) in visits or (j, home[i]) in visits
    assert len(set(home.tolist())) > 40
    assert all(met > home[row])


@pytest.mark.parametrize("values", [
    np.linspace(1, 90, 40), np.concatenate([np.full(6, 3.0), np.full(6, 3 + 1e-9), np.arange(4.0, 30)]),
    np.concatenate([np.full(20, 1.0), np.full(20, 1e-3)]), np.concatenate([np.zeros(30), [1, 1 + 1e-13, 2, 1e6]]),
])
def test_eigenpairs_to_double_precision(values):
    rng = np.random.default_rng(9)
    basis = np.linalg.qr(rng.normal(size=(len(values),) * 2))[0].astype(np.longdouble)
    matrix = ((basis * values) @ basis.T).astype(float)
    matrix = (matrix + matrix.T) / 2
    found, vectors = eigenpairs(matrix)
    exact, x = matrix.astype(np.longdouble), vectors.astype(np.longdouble)
    assert (np.diff(found) <= 0).all()
    assert abs(exact @ x - x * found).max() <= 1e-15 * abs(values).max()
    assert abs(x.T @ x - np.eye(len(values))).max() <= 2e-14
    assert np.allclose(found, np.sort(values)[::-1], rtol=1e-13, atol=1e-14 * abs(values).max())


def test_eigenpairs_of_small_matrices():
    assert eigenpairs(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]
    assert eigenpairs(np.zeros((0, 0)))[0].size == 0
    assert eigenpairs(np.array([[4.0]]))[0].tolist() == [4.0]


def brute_whitening(table, most=8):
    good = [(k, v) for k, v in table if v and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in good], dtype=object)
    n, total = len(x), x.sum(0)
    centred = (n * x - total).astype(float) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    return [k for k, _ in good], n, ((n * x - total) ** 2).sum(1), centred @ vectors / np.sqrt(values), values / np.trace(covariance)


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    table = [(i, (rng.normal(size=16) * np.linspace(2, 0.05, 16)).tolist()) for i in range(300)]
    table += [(7, table[3][1]), (None, table[4][1]), (900, None), (901, []), (902, [NAN] * 16), (903, [0.1] * 15 + [INF]),
              (904, [None] * 16)]
    df = spark.createDataFrame([(k, v, "x", "y") for k, v in table], "vec_id bigint, embedding array<float>, _far string, n string")
    got = whitening.whitened_components(df, "vec_id", "embedding")
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    keys, n, deviation, white, explained = brute_whitening(table)
    wide = got.groupBy("vec_id", "deviation", "n").pivot("component", list(range(1, 9))).agg(F.collect_list("whitened")).collect()
    have = sorted(((repr(r[0]), int(r[1]), r[2]), [r[3 + c][k] for c in range(8)]) for r in wide for k in range(len(r[3])))
    want = sorted(((repr(k), int(d), n), w.tolist()) for k, d, w in zip(keys, deviation, white, strict=True))
    assert [h[0] for h in have] == [w[0] for w in want]
    a, b = np.array([h[1] for h in have]), np.array([w[1] for w in want])
    signs = np.sign((a * b).sum(0))
    assert abs(a - b * signs).max() < 1e-11
    shares = {r["component"]: (r["explained"], r["identity_error"]) for r in got.distinct().collect()}
    assert np.allclose([shares[c][0] for c in range(1, 9)], explained, rtol=1e-12)
    assert all(e < 1e-10 for _, e in shares.values())


def test_whitening_of_hard_tables(spark, rows):
    schema = "vec_id bigint, embedding array<double>"
    empty = whitening.whitened_components(spark.createDataFrame([(1, None), (2, [])], schema), "vec_id", "embedding")
    assert empty.count() == 0
    same = whitening.whitened_components(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], schema), "vec_id", "embedding")
    assert rows(same.select("vec_id", "component", "deviation", "whitened", "explained", "identity_error")) == [
        (i, c, 0, None, None, None) for i in (1, 2) for c in (1, 2)
    ]
    mixed = spark.createDataFrame([(1, [0.5]), (2, [0.5, 1.0]), (3, [1.5, -1.0]), (4, [2.0**52, 0.0]), (5, [1e300, 0.0])], schema)
    assert {r["vec_id"] for r in whitening.whitened_components(mixed, "vec_id", "embedding").collect()} == {2, 3}
    big = whitening.fit(spark.createDataFrame([(1, [2.0**51]), (2, [-(2.0**51)]), (3, [1.0])], schema), "embedding")
    assert big.sums == [3 * whitening.SHIFT + 1024] and big.n == 3


def test_exact_deviations():
    rng = np.random.default_rng(5)
    for scale in (50, 1 << 26):
        low, rest = rng.integers(-scale, scale, (20, 9)), rng.integers(0, 1 << 37, 9)
        n = 1 << 37
        want = [sum((n * int(x) - int(r)) ** 2 for x, r in zip(row, rest, strict=True)) for row in low]
        assert whitening.deviations(low, rest, n) == want


def test_usable_vectors(spark):
    df = spark.createDataFrame([([1.0],), ([NAN],), (None,), ([],), ([None],), ([-INF],), ([-3.0],)], "v array<double>")
    assert [r[0] for r in df.select(moments.usable("v")).collect()] == [True, False, False, False, False, False, True]
    assert [r[0] for r in df.select(moments.usable("v", 2.0)).collect()] == [True] + [False] * 6
