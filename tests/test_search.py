import numpy as np
import pytest

from lectern.operators import search
from lectern.operators.search import nearest_neighbors


def brute(base, queries, k, metric):
    out = {}
    for qid, q in queries:
        if q is None:
            continue
        scored = []
        for key, b in base:
            if b is None:
                continue
            x, y = np.array(q), np.array(b)
            if metric == "cosine":
                n = np.linalg.norm(x) * np.linalg.norm(y)
                d = 1 - (x @ y / n if n else 0.0)
            else:
                d = np.sqrt(((x - y) ** 2).sum())
            scored.append((round(float(d), 9) + 0.0, key))
        for rank, (d, key) in enumerate(sorted(scored)[:k], 1):
            out[qid, rank] = (key, d)
    return out


def run(spark, base, queries, k, metric, parts=3, **options):
    b = spark.createDataFrame([(*key, v) for key, v in base], "chunk_id string, url string, embedding array<double>")
    q = spark.createDataFrame(queries, "question_id long, embedding array<double>")
    found = nearest_neighbors(b.repartition(parts), q, k, base_ids=("chunk_id", "url"), metric=metric, **options)
    return {(r["question_id"], r["rank"]): ((r["chunk_id"], r["url"]), round(r["distance"], 9) + 0.0)
            for r in found.collect()}


def data(rows, queries, dim, seed):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-2, 3, (rows, dim)).astype(float)  # few values: many ties
    base = [((f"c{rng.integers(0, 10**6)}", f"u{i}"), v.tolist()) for i, v in enumerate(vectors)]
    base += [((f"copy{i}", "u"), [1.0] * dim) for i in range(rows // 2)]  # a third are copies of one vector
    base.append((("null", "u"), None))
    asked = [(i, rng.normal(size=dim).tolist()) for i in range(queries - 2)]
    asked += [(queries - 2, [1.0] * dim), (queries - 1, None)]
    return base, asked


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("layout", ["one block", "blocks"])
def test_equals_brute_force(spark, metric, layout):
    base, asked = data(300, 12, 5, 1)
    size = None if layout == "one block" else 4 * (5 * 8 + 64)  # about 4 queries to a block
    assert run(spark, base, asked, 4, metric, query_bytes=size) == brute(base, asked, 4, metric)


def grouped(rows, queries, dim, seed):
    """Vectors around a few centres, some equal, some zero; queries near them and elsewhere."""
    rng = np.random.default_rng(seed)
    centres = 10 * rng.normal(size=(9, dim))
    base = [((f"c{i:05d}", "u"), (centres[i % 9] + 0.3 * rng.normal(size=dim)).tolist()) for i in range(rows)]
    base += [((f"same{i}", "u"), centres[2].tolist()) for i in range(rows // 4)] + [((f"zero{i}", "u"), [0.0] * dim) for i in range(20)]
    rng.shuffle(base)
    asked = [(i, (centres[rng.integers(9)] + 0.3 * rng.normal(size=dim)).tolist()) for i in range(queries)]
    return base, [*asked, (queries, [0.0] * dim), (queries + 1, (centres[0] + centres[1]).tolist()), (queries + 2, centres[2].tolist())]


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("small", [False, True])
def test_groups_that_are_left_out_hold_no_neighbour(metric, small, monkeypatch):
    base, asked = grouped(4000, 40, 6, 7)
    if small:
        monkeypatch.setattr(search, "PIVOTS", 4)
    monkeypatch.setattr(search, "WORTH", 0.0)
    vectors = np.array([v for _, v in base])
    work = search.Search(np.array([q for _, q in asked]), vectors[:: 30], 4, metric, 9)
    for at in range(0, len(base), 900):
        work.add(vectors[at : at + 900], search.pd.DataFrame([key for key, _ in base[at : at + 900]], columns=["chunk_id", "url"]))
    got = {}
    for q, rows in work.best.groupby("__q"):
        for rank, (_, r) in enumerate(rows.iterrows(), 1):
            got[q, rank] = ((r["chunk_id"], r["url"]), round(r["distance"], 9) + 0.0)
    assert got == brute(base, asked, 4, metric)
    assert work.all_pairs == len(base) * len(asked) and (small or work.pairs < 0.4 * work.all_pairs)


def test_share_of_pairs_is_reported(spark):
    base, asked = grouped(6000, 30, 6, 3)
    work = []
    got = run(spark, base, asked[:30], 3, "euclidean", parts=2, work=work)
    assert got == brute(base, asked[:30], 3, "euclidean")
    done = work[0].groupBy().sum().first()
    assert done["sum(all_pairs)"] == len(base) * 30 and 0 < done["sum(pairs)"] < 0.5 * done["sum(all_pairs)"]


def test_many_copies_in_one_block(spark):
    base = [((f"c{i:05d}", "u"), [1.0, 2.0, 3.0]) for i in range(3000)] + [(("z", "u"), [0.0, 0.0, 0.0])]
    asked = [(i, [1.0 + i, 2.0, 3.0]) for i in range(50)]
    assert run(spark, base, asked, 3, "euclidean", parts=1) == brute(base, asked, 3, "euclidean")


def test_base_smaller_than_k_and_empty_inputs(spark):
    base = [(("a", "u"), [0.0, 1.0]), (("b", "u"), [1.0, 1.0])]
    assert len(run(spark, base, [(1, [0.0, 0.0])], 5, "euclidean")) == 2
    assert run(spark, base, [(1, None)], 5, "euclidean") == {}
    assert run(spark, [(("a", "u"), None)], [(1, [0.0, 0.0])], 5, "euclidean") == {}


def test_result_grows_with_k_by_prefix(spark):
    base, asked = data(200, 6, 4, 2)
    small, large = (run(spark, base, asked, k, "euclidean") for k in (3, 4))
    assert {key: v for key, v in large.items() if key[1] <= 3} == small


def test_no_base_row_is_shuffled_for_few_queries(spark, folder):
    spark.createDataFrame([("a", [0.0])], "chunk_id string, embedding array<double>").write.parquet(folder + "/g")
    q = spark.createDataFrame([(1, [0.0])], "question_id long, embedding array<double>")
    plan = nearest_neighbors(spark.read.parquet(folder + "/g"), q)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("MapInArrow"):]
    assert "Exchange" not in below and "WindowGroupLimit" in plan and "Cartesian" not in plan


def test_ragged_vectors_are_an_error(spark):
    with pytest.raises(Exception, match="same length"):
        run(spark, [(("a", "u"), [0.0]), (("b", "u"), [0.0, 1.0])], [(1, [0.0])], 1, "euclidean", parts=1)
