import collections
import itertools
import random
from collections import deque
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from quillgraph.plans import communities, resolution
from quillgraph.plans.centrality import pagerank
from quillgraph.plans.components import connected_components
from quillgraph.plans.cooccurrence import both_directions, cooccurrence
from quillgraph.plans.graph import orders_graph
from quillgraph.plans.patterns import shortest_path
from quillgraph.registry import _item_features


def edges_of(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def test_shortest_path_on_a_chain(spark):
    chain = [("N", "N", lambda: edges_of(spark, [(str(i), str(i + 1)) for i in range(8)]))]
    row = shortest_path(chain, ("N", "6"), ("N", "0")).first()
    assert (row["path_length"], [tuple(p) for p in row["path"]]) == (6, [("N", str(i)) for i in range(6, -1, -1)])
    assert shortest_path(chain, ("N", "0"), ("N", "7")).count() == 0
    assert shortest_path(chain, ("N", "0"), ("N", "7"), 7).first()["path_length"] == 7
    assert shortest_path(chain, ("N", "0"), ("N", "lonely")).count() == 0
    assert shortest_path(chain, ("N", "3"), ("N", "3")).first()["path_length"] == 0


def test_shortest_path_equals_breadth_first_search(spark, sf):
    graph = orders_graph(spark, sf)
    links = graph.typed_links(["HAS_ADMISSION", "UNDERWENT", "HAD_LAB_RESULT"])
    around = {}
    for s, d, rows in links:
        for r in rows().collect():
            around.setdefault((s, r["src"]), set()).add((d, r["dst"]))
            around.setdefault((d, r["dst"]), set()).add((s, r["src"]))

    def bfs(start, goal):
        seen, queue = {start: 0}, deque([start])
        while queue:
            node = queue.popleft()
            if node == goal:
                return seen[node]
            for other in around.get(node, ()):
                if other not in seen:
                    seen[other] = seen[node] + 1
                    queue.append(other)

    for goal in (("Patient", "1"), ("LabTest", "click"), ("Admission", "77")):
        row = shortest_path(links, ("Patient", "0"), goal).first()
        assert row["path_length"] == bfs(("Patient", "0"), goal)
        steps = [tuple(p) for p in row["path"]]
        assert steps[0] == ("Patient", "0") and steps[-1] == goal and len(steps) == row["path_length"] + 1
        assert all(after in around[before] for before, after in zip(steps, steps[1:]))


@pytest.mark.parametrize("limit", [1000, 4])
@pytest.mark.parametrize("support", [1, 2, 3])
def test_cooccurrence_with_large_baskets(spark, limit, support):
    rng = random.Random(support)
    baskets = {b: {rng.randint(0, 11) for _ in range(rng.randint(1, 4))} for b in range(30)}
    baskets |= {100: set(range(12)), 101: set(range(3, 12)), 102: set(range(0, 12, 2))}
    rows = [(b, c) for b, codes in baskets.items() for c in codes]
    counts = {}
    for codes in baskets.values():
        for pair in combinations(sorted(codes), 2):
            counts[pair] = counts.get(pair, 0) + 1
    expected = {(a, b, n) for (a, b), n in counts.items() if n >= support}
    found = cooccurrence(spark.createDataFrame(rows, "src int, dst int"), support, limit)
    assert {(r["code_a"], r["code_b"], r["co_count"]) for r in found.collect()} == expected


def test_cooccurrence_with_one_basket_of_5000_codes(spark):
    """Every pair stands in one cell of the triangle, and no cell has more members than two blocks."""
    from quillgraph.plans.cooccurrence import _count_across_blocks

    large = spark.range(5000).selectExpr("1 AS src", "CAST(id AS INT) AS dst")
    often = [(b, c * 7) for b in (2, 3) for c in range(60)]
    pairs = large.unionByName(spark.createDataFrame(often, "src int, dst int"))
    found = {(r["code_a"], r["code_b"], r["co_count"]) for r in cooccurrence(pairs, 3, 256).collect()}
    assert found == {(7 * a, 7 * b, 3) for a, b in combinations(range(60), 2)}
    counts = _count_across_blocks(large.withColumn("blocks", F.lit(20)))
    seen = counts.agg(F.count(F.lit(1)).alias("n"), F.max("co_count").alias("most")).first()
    assert tuple(seen) == (5000 * 4999 // 2, 1)


def test_pagerank_closed_form(spark):
    edges = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("c", "y")], "src string, dst string")
    nodes = spark.createDataFrame([(n,) for n in "abcxyz"], "id string")
    ranks = {r["id"]: r["rank"] for r in pagerank(nodes, edges).collect()}
    expected = dict(a=0.15, b=0.15, c=0.15, x=0.15 + 0.85 * 0.15 * 1.5, y=0.15 + 0.85 * 0.15 * 1.5, z=0.15)
    assert ranks == pytest.approx(expected)


def test_pagerank_iterates_on_a_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (1, 3)], "src int, dst int")
    ranks = {r["id"]: r["rank"] for r in pagerank(spark.createDataFrame([(1,), (2,), (3,)], "id int"), edges, max_iterations=8).collect()}
    state = {1: 0.15, 2: 0.15, 3: 0.15}
    for _ in range(8):
        state = {1: 0.15 + 0.85 * state[3], 2: 0.15 + 0.85 * state[1] / 2, 3: 0.15 + 0.85 * (state[2] + state[1] / 2)}
    assert ranks == pytest.approx(state)


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(60)]
    shuffled = list(range(100, 140))
    rng.shuffle(shuffled)
    pairs = chain + list(zip(shuffled, shuffled[1:])) + [(200, 200 + i) for i in range(1, 20)] + [(300, 300)]
    nodes = spark.createDataFrame([(i,) for i in [*range(61), *range(100, 140), *range(200, 220), 300, 400]], "id int")
    found = {r["id"]: r["component"] for r in connected_components(nodes, spark.createDataFrame(pairs, "src int, dst int")).collect()}
    expected = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {i: 200 for i in range(200, 220)} | {300: 300, 400: 400}
    assert found == expected


def two_cliques(spark):
    rows = [(a, b, 5) for group in (range(4), range(4, 8)) for a, b in combinations(group, 2)] + [(3, 4, 1)]
    return both_directions(spark.createDataFrame(rows, "code_a int, code_b int, n int"), "n")


def test_louvain_finds_two_cliques(spark):
    edges = two_cliques(spark)
    found = communities.louvain(edges)
    assert {r["id"]: r["community"] for r in found.collect()} == {i: 0 if i < 4 else 4 for i in range(8)}
    total, inside, degree = 122.0, 120.0, 61.0
    assert communities.modularity(edges, found).first()["modularity"] == pytest.approx(inside / total - 2 * (degree / total) ** 2)
    nodes = spark.createDataFrame([(i, f"t{i}") for i in range(8)], "id int, title string")
    top = communities.top_communities(found, nodes, "title", 10, 2).collect()
    assert [(r["community"], r["size"], r["titles"]) for r in top] == [(0, 4, "t0, t1"), (4, 4, "t4, t5")]
    assert communities.louvain(edges.limit(0)).count() == 0


def test_gold_labels_cap_and_manual_table(spark, sf, tmp_path):
    features = _item_features(spark, sf)
    rule = resolution.LabelRule(positive_jw=0.8, negative_jw=0.6, negative_overlap=0.2)
    labels = resolution.gold_labels(features, rule)
    counts = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    assert counts[1.0] > 0 and counts[0.0] <= 3 * counts[1.0]
    path = str(tmp_path / "gold")
    found, source = resolution.labels_or_heuristic(spark, path, features, rule)
    assert source == "heuristic" and found.count() == labels.count()
    labels.limit(5).write.parquet(path)
    assert resolution.labels_or_heuristic(spark, path, features, rule)[1] == "manual"


def test_matcher_learns_and_scores_all_pairs(spark, sf):
    features = _item_features(spark, sf).withColumn("label", (F.col("jw") > 0.75).cast("double"))
    model, metrics = resolution.train_matcher(resolution.sampled_labels(features), "MEDICATION", "rule", trees=10, depth=4)
    row = metrics.first()
    assert row["auc"] > 0.9 and row["positives"] > 0 and row["label_source"] == "rule"
    edges = resolution.same_as(model, features, "MEDICATION").collect()
    assert edges and all(0.5 <= e["confidence"] <= 1.0 and e["id_a"] < e["id_b"] for e in edges)


def test_blocking_defaults_give_the_exact_pairs(spark, sf):
    from quillgraph.registry import _items

    items = _items(spark, sf)
    exact = {tuple(r) for r in resolution.block_pairs(items, 0.6, lsh=False).select("id_a", "id_b").collect()}
    lsh = {tuple(r) for r in resolution.block_pairs(items, 0.6, num_tables=15).select("id_a", "id_b").collect()}
    assert exact and lsh <= exact and len(lsh) >= 0.95 * len(exact)


def serial_louvain(edges):
    """Communities of {(a, b): w}, a < b, by moving one node at a time and contracting, until nothing gains."""
    total = 2 * sum(edges.values())
    member = {n: n for e in edges for n in e}
    level = dict(edges)
    while True:
        around, degree = {}, {}
        for (a, b), w in level.items():
            around.setdefault(a, {})
            around.setdefault(b, {})
            degree[a] = degree.get(a, 0) + w
            degree[b] = degree.get(b, 0) + w
            if a != b:
                around[a][b] = around[a].get(b, 0) + w
                around[b][a] = around[b].get(a, 0) + w
        of, weight, moved_once = {n: n for n in around}, dict(degree), False
        moved = True
        while moved:
            moved = False
            for n in sorted(around):
                weight[of[n]] -= degree[n]
                into = {of[n]: 0.0}
                for m, w in around[n].items():
                    into[of[m]] = into.get(of[m], 0.0) + w
                best = max(sorted(into), key=lambda c: into[c] - degree[n] * weight[c] / total)
                if into[best] - degree[n] * weight[best] / total > into[of[n]] - degree[n] * weight[of[n]] / total + 1e-12:
                    of[n], moved, moved_once = best, True, True
                weight[of[n]] += degree[n]
        if not moved_once:
            return member
        member = {n: of[c] for n, c in member.items()}
        after = {}
        for (a, b), w in level.items():
            key = tuple(sorted((of[a], of[b])))
            after[key] = after.get(key, 0) + w
        level = after


def exact_modularity(edges, community):
    total, degree, inside = 2 * sum(edges.values()), {}, 0.0
    for (a, b), w in edges.items():
        inside += 2 * w * (community[a] == community[b])
        for n in (a, b):
            degree[community[n]] = degree.get(community[n], 0) + w
    return inside / total - sum(d * d for d in degree.values()) / total**2


@pytest.mark.parametrize("seed", [1, 2])
def test_louvain_is_as_good_as_a_serial_run(spark, seed):
    """A planted partition of 6 groups of 20 with noise: moving half of the communities at a time costs up to 0.033 of modularity against a serial run on such graphs."""
    rng = random.Random(seed)
    edges = {}
    for a, b in combinations(range(120), 2):
        if rng.random() < (0.4 if a % 6 == b % 6 else 0.03):
            edges[a, b] = rng.randint(1, 4)
    rows = [(a, b, float(w)) for (a, b), w in edges.items()] + [(b, a, float(w)) for (a, b), w in edges.items()]
    table = spark.createDataFrame(rows, "src long, dst long, w double")
    found = {r["id"]: r["community"] for r in communities.louvain(table).collect()}
    ours, serial = exact_modularity(edges, found), exact_modularity(edges, serial_louvain(edges))
    assert communities.modularity(table, spark.createDataFrame(list(found.items()), "id long, community long")).first()[0] == pytest.approx(ours)
    assert serial > 0.3 and ours >= serial - 0.04


def test_cooccurrence_takes_more_tasks_for_more_pairs(spark, monkeypatch):
    """A task holds the counts of the pairs that it forms, so there are tasks in proportion to them, of many codes or of few."""
    from quillgraph.plans import cooccurrence as module

    monkeypatch.setattr(module, "_TASK_PAIRS", 1_000, raising=False)
    for codes in (6, 3_000):
        rows = {(i // 5, (i * 7919 + i // 5) % codes) for i in range(4_000)}
        baskets = {}
        for src, dst in rows:
            baskets.setdefault(src, []).append(dst)
        expected = collections.Counter(p for b in baskets.values() for p in itertools.combinations(sorted(b), 2))
        formed = sum(expected.values())
        found = module.cooccurrence(spark.createDataFrame(sorted(rows), "src int, dst int"), 1)
        assert {(r["code_a"], r["code_b"]): r["co_count"] for r in found.collect()} == dict(expected)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f", {-(-formed // 1_000)}), REPARTITION_BY_NUM") >= 1 and formed > 4_000


def test_tasks_grow_in_number_with_the_rows(spark, sf, monkeypatch):
    """Not in size: what a task joins, counts or makes distinct is held by it."""
    from quillgraph import registry
    from quillgraph.plans import checks, patterns

    monkeypatch.setattr(checks, "_TASK_ROWS", 500, raising=False)
    monkeypatch.setattr(patterns, "_TASK_ROWS", 500, raising=False)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    pairs, orders = lines.select("l_orderkey", "l_suppkey").distinct().count(), spark.read.parquet(f"{sf}/orders.parquet").count()
    for query, rows in ((registry.top_k_per_key, pairs), (registry.patient_subgraph_counts, orders + 2 * lines.count())):
        plan = query(spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert f", {-(-rows // 500)}), REPARTITION_BY_NUM" in plan


def test_dealt_pairs_are_the_same_in_more_tasks(spark, sf, monkeypatch):
    """What proves and merges edges holds them, so there are tasks in proportion to the rows of the table."""
    from quillgraph import registry
    from quillgraph.plans import graph as module

    monkeypatch.setattr(module, "_TASK_ROWS", 500, raising=False)
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    found = registry._code_pairs(spark, sf)
    assert f", {-(-rows // 500)}), REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    graph = module.orders_graph(spark, sf, only={"orders": "o_orderstatus <> 'P'", "part": "p_size > 10"})
    for type in ("HAS_DIAGNOSIS", "PRESCRIBED"):
        plain, dealt = graph.pairs(type), graph.pairs(type, dealt=True)
        assert dealt.columns == plain.columns and sorted(dealt.collect()) == sorted(plain.collect()) != []


def test_similar_cohort_sorts_no_edges(spark, sf):
    from quillgraph import registry

    found = registry.q3_similar_cohort(spark, sf)
    found.collect()
    written = [node for node in found.inputFiles() if "/near-" in node or "/wanted-" in node]
    assert written and "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_dealt_edges_are_proven_where_they_are_dealt(spark, sf, monkeypatch):
    """A semi-join with the ids of ``src`` would be moved before the dealing, into tasks that grow with the table."""
    from quillgraph.plans import graph as module

    monkeypatch.setattr(module, "_TASK_ROWS", 5)
    rows = {
        "orders": spark.createDataFrame([(k,) for k in (1, 2, 2, 3, None)], "o_orderkey long"),
        "part": spark.createDataFrame([(k,) for k in (10, 10, 11, None)], "p_partkey long"),
        "lineitem": spark.createDataFrame(
            [(s, d, n) for n, s in enumerate((1, 2, 2, 3, 4, None)) for d in (10, 11, 11, 12, None)],
            "l_orderkey long, l_partkey long, l_linenumber int",
        ),
    }
    whole = {name: spark.read.parquet(f"{sf}/{name}.parquet").limit(0).unionByName(some, allowMissingColumns=True) for name, some in rows.items()}
    graph = module.Graph(module.ORDERS, whole.__getitem__)
    dealt = graph.pairs("HAS_DIAGNOSIS", dealt=True)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, graph.pairs("HAS_DIAGNOSIS").collect())) == [(s, d) for s in (1, 2, 3) for d in (10, 11)]
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi, (src" not in plan and plan.count("Join LeftSemi") == 1
