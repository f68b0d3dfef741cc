import numpy as np
import pytest

from reviewsent.llm import projections
from reviewsent.llm.projections import group_vectors
from reviewsent.llm.queries import op8_collision_projections
from test_minhash import closure

SCHEMA = "vec_id long, embedding array<double>, label int, size string, cell string"


def brute(rows):
    good = []
    for vec_id, values in rows:
        ok = vec_id is not None and values and None not in values and np.isfinite(values).all() and np.any(values)
        x = np.array(values, float) / np.abs(values).max() if ok else None
        good.append(x / np.linalg.norm(x) if ok else None)
    n = [0] * len(rows)
    edges = []
    for i, x in enumerate(good):
        for j in range(i):
            y = good[j]
            if x is not None and y is not None and len(x) == len(y) and x @ y >= 0.9:
                n[i] += 1
                n[j] += 1
                edges.append((rows[i][0], rows[j][0]))
    label = closure([r[0] for r in rows if r[0] is not None], edges)
    return sorted(((r[0], k, label.get(r[0]), r[0] is None or label[r[0]] == r[0]) for r, k in zip(rows, n)), key=str)


def cases():
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(64).tolist()) for i in range(150)]
    center = rng.standard_normal(64)
    rows += [(i, (center + 0.22 * rng.standard_normal(64)).tolist()) for i in range(150, 220)]
    chain = rng.standard_normal(64)
    for i in range(220, 250):
        chain = chain + 0.3 * rng.standard_normal(64)
        rows.append((i, chain.tolist()))
    rows += [(i, center.tolist()) for i in range(250, 280)] + [(280, (3 * center).tolist()), (281, (-center).tolist())]
    rows += [(300, None), (301, []), (302, [0.0] * 64), (303, [None] + [1.0] * 63), (304, [float("nan")] + [1.0] * 63),
             (305, [float("inf")] + [1.0] * 63), (306, [1.0, 0.0]), (307, [1.0, 0.1]), (308, [1e300] * 64), (309, [1e300] * 64),
             (310, [1.0] * 64), (None, center.tolist()), (-5, center.tolist()), (311, [5e-300] * 64)]
    return rows


def test_same_as_brute_force(spark, monkeypatch):
    monkeypatch.setattr(projections, "BLOCK", 32)
    rows = cases()
    table = spark.createDataFrame([(i, v, 0, "s", "c") for i, v in rows], SCHEMA)
    assert sorted(map(tuple, group_vectors(table).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert group_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_whole_table(spark, folder):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op8_collision_projections(spark, folder).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("similarity", [0.9, 0.93])
def test_recall_at_the_threshold(similarity):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((4000, 64))
    z -= (z * x).sum(1, keepdims=True) * x
    y = similarity * x + (1 - similarity ** 2) ** 0.5 * z / np.linalg.norm(z, axis=1, keepdims=True)
    planes = projections.directions(64)
    px, py = x @ planes, y @ planes
    found = sum(len(next(projections.count_collisions(*map(projections.on_grid, (px[i:i + 1], py[i:i + 1]))))) for i in range(4000))
    assert found >= 3990
    assert (np.abs(px[:, 0] - py[:, 0]) <= projections.CELL).mean() > 0.999


def test_cells_same_as_brute_force(spark, monkeypatch):
    rounds = []
    for name, value in (("BLOCK", 16), ("LARGE", 1), ("GATHERED", 1), ("SHARE", 0.7), ("LEAST_BYTES", 1)):
        monkeypatch.setattr(projections, name, value)
    monkeypatch.setattr(projections, "choose_depth", lambda n, share: 9 if share else 0)
    monkeypatch.setattr(projections, "_rounds", lambda *a, f=projections._rounds: rounds.extend(f(*a)) or rounds)
    rows = cases()
    table = spark.createDataFrame([(i, v, 0, "s", "c") for i, v in rows], SCHEMA)
    assert sorted(map(tuple, group_vectors(table).collect()), key=str) == brute(rows)
    deals = [d for r in rounds for d in r.get(64, [])]
    assert max(d.blocks.max(initial=1) for d in deals) > 2 and max(d.stripes for d in deals) > 1


def test_copies_in_proportion_to_vectors():
    for n in (100_000, 15_400_000):
        depth = projections.choose_depth(n, {d: 2.0 ** -d for d in projections.DEPTHS})
        plan = projections.Plan(n, depth, 100, {})
        rounds = list(projections._rounds({64: plan}, "<f4"))
        assert sum(len(r[64]) for r in rounds) == projections.tables_of(depth) <= 60
        assert max(len(r[64]) for r in rounds) <= 2
        assert projections.tables_of(depth) * n * 2.0 ** -depth < 10_000  # vectors that one is compared with


def test_blocks_of_a_large_cell_grow():
    plan = projections.Plan(1_000_000, 16, 100, {0: [(5, 200_000), (7, 9_000)], 1: [(5, 9_000)]})
    few, size = projections._deal(plan, 0, 280, 2 * 280_000_000)
    assert size <= 2 * 280_000_000 and few.codes.tolist() == [5, 7] and few.blocks.max() > 1
    assert few.first.tolist() == [100, 100 + few.blocks[0] ** 2]
    assert projections._deal(plan, 1, 280, 2 * 280_000_000)[0].blocks.tolist() == [5]


@pytest.mark.parametrize("depth", [9, 15, 18])
def test_pairs_at_the_threshold_meet(depth):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((4000, 64))
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.9 * x + 0.19 ** 0.5 * z / np.linalg.norm(z, axis=1, keepdims=True)
    met = np.zeros(4000, bool)
    for level in range(projections.tables_of(depth)):
        codes = projections.cell_codes(x, level, depth)
        assert projections.cell_codes(x[7:8], level, depth)[0] == codes[7]
        met |= codes == projections.cell_codes(y, level, depth)
    assert met.sum() >= 3990


def test_all_collisions_of_runs():
    rng = np.random.default_rng(3)
    grid = projections.on_grid(1.2 * rng.standard_normal((3000, 64)) * (rng.random((3000, 1)) < 0.7))
    codes = rng.permutation(np.repeat(np.arange(200), rng.multinomial(3000, np.r_[0.4, np.full(199, 0.6 / 199)])))
    order, starts, lengths = projections._runs(codes)
    lines, found = projections._lines(grid[order]), set()
    for i, j in projections._meetings(starts, lengths, len(grid)):
        one, other = projections._collide(*lines, i, j, ordered=True)
        pairs = set(zip(one.tolist(), other.tolist()))
        assert len(pairs) == len(one) and not pairs & found
        found |= pairs
    near = np.abs(grid[order][:, None, :].astype(np.int16) - grid[order][None]) <= projections.HALF
    good = (near[..., :16].sum(2) >= projections.LEAST_FIRST) & (near.sum(2) >= projections.LEAST_ALL)
    good &= (codes[order][:, None] == codes[order][None]) & np.triu(np.ones(good.shape, bool), 1)
    assert found == set(zip(*map(np.ndarray.tolist, np.nonzero(good)))) and len(found) > 1000
