"""Latest-per-key equals sort-then-take-first, whatever the partitioning."""
import random

import pytest

from clipstar.functions.latest import latest_per_key


def model(rows, greatest):
    # (key, a, b, p): order by a, then b, then p; NULL lowest (desc nulls last / asc nulls first).
    def rank(r):
        return tuple((v is not None, v if v is not None else 0) for v in r[1:])
    best = {}
    for r in rows:
        cur = best.get(r[0])
        if cur is None or (rank(r) > rank(cur) if greatest else rank(r) < rank(cur)):
            best[r[0]] = r
    return sorted(best.values(), key=lambda r: (r[0] is None, r[0] or ""))


@pytest.mark.parametrize("greatest", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_latest_matches_model(spark, greatest, seed):
    rng = random.Random(seed)
    pick = lambda xs: rng.choice(xs)
    rows = [(pick(["k1", "k2", "hot", "hot", "hot", None]), pick([1, 2, 3, None]),
             pick(["a", "b", None]), pick([0.5, 1.5, None])) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, a int, b string, p double")
    want = model(rows, greatest)
    for parts in (1, 3, 7):
        res = latest_per_key(df.repartition(parts), ["k"], ["a", "b"], ["a", "b", "p"], greatest)
        got = sorted((tuple(r) for r in res.collect()), key=lambda r: (r[0] is None, r[0] or ""))
        assert got == want
