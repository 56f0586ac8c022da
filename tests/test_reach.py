import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from searchloom.operators.ordered import first_rows
from searchloom.operators.reach import Links, new_pages, reach, redirect_closure
from searchloom.storage import Placed


def brute_force(edges, seeds, max_depth, max_pages):
    """Shortest distances with edges of weight 0 and 1."""
    depth = {s: 0 for s in seeds}
    queue = deque(seeds)
    while queue:
        url = queue.popleft()
        for src, dst, weight in edges:
            if src == url and depth[url] + weight <= max_depth and depth[url] + weight < depth.get(dst, 1 << 30):
                depth[dst] = depth[url] + weight
                (queue.append if weight else queue.appendleft)(dst)
    return sorted(depth.items(), key=lambda x: (x[1], x[0]))[:max_pages]


def found(df):
    return sorted(((r.url, r.depth) for r in df.collect()), key=lambda x: (x[1], x[0]))


@pytest.mark.parametrize("seed, redirects, cap, per_part", [
    (1, False, 1000, 1000), (2, True, 1000, 1000), (3, True, 17, 1000), (4, False, 9, 3), (5, True, 1000, 3),
])
def test_against_brute_force(spark, seed, redirects, cap, per_part):
    rng = random.Random(seed)
    nodes = [f"n{i:02d}" for i in range(40)]
    edges = {(rng.choice(nodes), rng.choice(nodes), int(rng.random() > 0.3) if redirects else 1) for _ in range(60)}
    edges |= {("n00", n, 1) for n in nodes[10:30]}  # a page that holds many of the links
    df = spark.createDataFrame(sorted(edges), "src string, dst string, weight int")
    if not redirects:
        df = df.drop("weight")
    seeds = spark.createDataFrame([("n00",), ("n01",), ("n01",)], "url string")
    got = found(reach(df, seeds, max_depth=3, max_pages=cap, links_per_part=per_part))
    assert got == brute_force(edges, ["n00", "n01"], 3, cap)


def test_without_links_and_at_depth_zero(spark):
    edges = spark.createDataFrame([("a", "b")], "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("z",)], "url string")
    assert found(reach(edges.where("false"), seeds)) == [("a", 0), ("z", 0)]
    assert found(reach(edges, seeds, max_depth=0)) == [("a", 0), ("z", 0)]
    assert found(reach(edges, seeds, max_pages=1)) == [("a", 0)]


@pytest.mark.parametrize("limit", [0, 1, 37, 100, 500])
def test_first_rows_without_a_single_task(spark, limit):
    values = random.Random(5).sample(range(1000), 100)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(4)
    got = sorted(r.v for r in first_rows(df, ["v"], limit, small=0 if limit else 10).collect())
    assert got == sorted(values)[:limit]


def closed(pairs):
    pairs = set(pairs)
    while True:
        more = pairs | {(a, d) for a, b in pairs for c, d in pairs if b == c}
        if more == pairs:
            return {(a, b) for a, b in pairs if a != b}
        pairs = more


@pytest.mark.parametrize("pairs", [
    [("a", "a")], [("a", "b"), ("b", "a")], [(f"n{k:03d}", f"n{k + 1:03d}") for k in range(70)],
    [("a", "b"), ("b", "c"), ("c", "d"), ("d", "b"), ("x", "c"), ("x", "y")], [(f"p{k}", "login") for k in range(50)] + [("login", "home"), ("login", None)],
])
def test_redirects_are_closed(spark, pairs):
    df = spark.createDataFrame(pairs, "src string, dst string")
    found = [(r.src, r.dst) for r in redirect_closure(df).collect()]
    assert len(found) == len(set(found)) and set(found) == closed(p for p in pairs if None not in p)
    assert redirect_closure(df.where("false")).isEmpty()


def test_a_circle_of_redirects(spark):
    edges = [(f"r{k}", f"r{(k + 1) % 40}", 0) for k in range(40)] + [("start", "r7", 1), ("r20", "deep", 1), ("deep", "r1", 0), ("deep", "end", 1)]
    df = spark.createDataFrame(edges, "src string, dst string, weight int")
    got = found(reach(df, spark.createDataFrame([("start",)], "url string")))
    assert got == brute_force(edges, ["start"], 100, 1000)


@pytest.mark.parametrize("per_part", [5, 1000])
def test_a_step_shuffles_only_the_targets(spark, per_part):
    """No exchange below or beside the links and the visited pages; for large pages' links, only the few pages are sent."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = spark.createDataFrame([("a", f"n{k}") for k in range(20)] + [("n1", "a"), ("n2", "z")], "src string, dst string")
        links = Links(edges, per_part)
        visited = Placed(spark.createDataFrame([("a", 0)], "url string, depth int"), "url", "visited", by="depth")
        visited.append(spark.createDataFrame([(f"n{k}", 1) for k in range(20)], "url string, depth int"))
        step = new_pages(links.targets(visited.read().where(F.col("depth") == 1)), visited.read())
        plan = step._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Bucketed: true") >= 3
        assert plan.count("BroadcastExchange") == (2 if per_part == 5 else 0)
        assert {r.url for r in step.collect()} == {"z"}
        assert visited.files().count() == 21
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
