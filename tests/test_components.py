import random

from pyspark.sql import functions as F

from skein.operators import events
from skein.operators.components import connected_components


def _components(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def test_components_equal_union_find(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(130)]
    df = spark.createDataFrame([*edges, (7, None), (None, 9), (500, 500)], "src long, dst long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    want = _components([e for e in edges if e[0] != e[1]])
    assert got == want


def test_long_path_and_star_meet_no_limit(spark):
    ids = list(range(3000))
    random.Random(2).shuffle(ids)
    path = list(zip(ids, ids[1:]))
    star = [(10_000, 10_000 + i) for i in range(1, 400)]
    df = spark.createDataFrame(path + star, "src long, dst long")
    sizes = sorted(r["count"] for r in connected_components(df).groupBy("component").count().collect())
    assert sizes == [400, 3000]


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_planted_clusters_are_found_whole(spark):
    rnd = random.Random(3)
    rows, k = [], 0
    for c in range(40):
        centre = [rnd.uniform(-20, 20) for _ in range(8)]
        for _ in range(12):
            rows.append((k, c % 2, [x + rnd.uniform(-0.05, 0.05) for x in centre]))
            k += 1
    rows += [(k, 0, rows[0][2]), (k + 1, 1, rows[0][2]), (k + 2, 0, None)]
    df = spark.createDataFrame(rows, "id long, grp int, embedding array<double>")
    members, centres = events.event_clusters(df, eps=0.5, dim=8)
    assert members.count() == k + 2
    assert sorted(r["size"] for r in centres.collect()) == [12] * 39 + [14]
    by_group, _ = events.event_clusters(df, eps=0.5, dim=8, group_cols=["grp"])
    assert by_group.select("cluster").distinct().count() == 41


def test_crowded_cell_is_cut_into_units(spark):
    # a chain of near points that all lie in one cell: one cluster, found across chunks
    rows = [(i, [i * 0.01, 0.0]) for i in range(300)]
    points = spark.createDataFrame(rows, "id long, vec array<double>")
    links = events.eps_links(points, 0.015, 2, chunk=16, projections=1)
    parts = connected_components(links)
    assert parts.select("component").distinct().count() == 1 and parts.count() == 300
    assert events.eps_links(points, 0.005, 2, chunk=16).count() == 0


def test_empty_vectors(spark):
    df = spark.createDataFrame([(1, None)], "id long, embedding array<double>")
    members, centres = events.event_clusters(df)
    assert members.count() == 0 and centres.count() == 0


def test_decay_is_the_sum_over_messages(spark):
    import datetime as dt
    import math
    t0 = dt.datetime(2024, 1, 1, 5, 20)
    rows = [(1, t0, 2.0), (1, t0 + dt.timedelta(minutes=70), 3.0), (2, t0, 1.0)]
    df = spark.createDataFrame(rows, "chat_id long, date timestamp_ntz, hype double")
    got = {(r.chat_id, r.hour): r.mass for r in events.time_decay_mass(df, 6.0, 3).collect()}
    end = dt.datetime(2024, 1, 1, 8)
    want = sum(h * math.exp(-(end - d).total_seconds() / 3600 / 6.0) for c, d, h in rows if c == 1)
    assert abs(got[(1, end - dt.timedelta(hours=1))] - want) < 1e-12
    assert len([k for k in got if k[0] == 2]) == 4
    assert df.filter(F.col("hype") > 100).count() == 0
