import random

from pyspark.sql import functions as F

from lodestrata.functions import text as T
from lodestrata.operators import classify, graph, windows


def tarjan(edges):
    """Strong components by mutual reachability."""
    reach = {}
    nodes = {x for e in edges for x in e}
    for n in nodes:
        seen, stack = set(), [n]
        while stack:
            x = stack.pop()
            for a, b in edges:
                if a == x and b not in seen:
                    seen.add(b)
                    stack.append(b)
        reach[n] = seen
    return {(n, min([n, *(m for m in nodes if m in reach[n] and n in reach[m])])) for n in nodes if any(m != n and m in reach[n] and n in reach[m] for m in nodes)}


def test_strong_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (6, 6), (5, 7), (7, 8), (0, 1)]
    rng = random.Random(4)
    edges += [(100 + rng.randrange(12), 100 + rng.randrange(12)) for _ in range(16)]
    got = {tuple(r) for r in graph.strong_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == tarjan([e for e in edges if e[0] != e[1]])
    assert graph.strong_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_call_flow_limits(spark):
    star = [("s", f"n{k:02d}", 5, "f", k) for k in range(12)]
    chain = [(f"n{k:02d}" if k == 0 else f"c{k}", f"c{k + 1}", 1, "f", 1) for k in range(6)]
    edges = spark.createDataFrame(star + chain, "src string, dst string, score int, file string, line int")
    got = graph.call_flows(edges, spark.createDataFrame([("e", "s")], "entry string, owner string")).orderBy("step").collect()
    assert [r["node"] for r in got] == ["n00", "n01", "n02", "n03", "n04", "n05", "c1", "c2", "c3"] and max(r["level"] for r in got) == 4


def test_chunk_windows(spark):
    for n in (0, 1, 4, 80, 81, 90, 150, 151):
        text = "\n".join(f"l{k}" for k in range(n))
        got = [(r["start_line"], r["end_line"]) for r in windows.chunks(spark.createDataFrame([(text,)], "text string")).collect()]
        want, start, size = [], 0, max(n, 1)
        while True:
            want.append((start + 1, min(start + 80, size)))
            if start + 80 >= size:
                break
            start += 70
        assert got == want, n


def test_numbers_are_dense(spark):
    rows = windows.numbered(spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k")), "k").collect()
    assert all(r["number"] == r["k"] + 1 for r in rows)


def test_second_ladder_overrides_the_first(spark):
    kind = "name string, kind string, file string, bases string, annotations string, dep_types string, category string"
    rows = [("AppSettings", "class", "src/X/services/AppSettings.cs", "", "", "", "backend"), ("Plain", "class", "src/X/Plain.cs", "", "", "", "backend"), ("IOrderRepository", "interface", "src/X/I.cs", "", "", "", "backend"), ("XSeed", "class", "tests/XSeed.cs", "", "", "", "backend")]
    got = {r["name"]: (r["component_type"], r["layer"], r["evidence"]) for r in classify.classify_components(spark.createDataFrame(rows, kind)).collect()}
    assert got["AppSettings"] == ("Service", "Application", "settings/constants/options naming or folder pattern; service name/path") and got["Plain"] == ("Unknown", "Unknown", "")
    assert got["IOrderRepository"][0] == "Repository" and got["XSeed"] == ("Unknown", "CrossCutting", "test project source artifact")


def test_text_functions(spark):
    df = spark.createDataFrame([("Server=db,1500;Initial Catalog=shop", b"\x00a", "HTTPServer2Go")], "c string, b binary, n string")
    r = df.select(T.connection_string(F.col("c")).alias("c"), T.looks_binary(F.col("b")).alias("b"), T.capability_tokens(F.col("n")).alias("n")).first()
    assert tuple(r["c"]) == ("sqlserver", "db,1500", "1433", "shop") and r["b"] and r["n"] == ["HTTP", "Server"]


def test_stream_equals_batch(spark, tmp_path):
    from lodestrata.streaming.transitions import windowed_actions

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    stream = windowed_actions(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.outputMode("complete").format("memory").queryName("actions").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    assert {tuple(r) for r in spark.table("actions").collect()} == {tuple(r) for r in windowed_actions(events).collect()}


def test_step_summary_and_run_tag(spark):
    from lodestrata.operators import aggregates

    rows = spark.createDataFrame([("a", 0, 1.5), ("a", 1, 0.5), ("b", None, 2.0)], "label string, returncode int, duration double")
    got = {r["label"]: tuple(r)[1:] for r in aggregates.step_summary(rows).collect()}
    assert got == {"a": (2, 1, 1, 2.0), "b": (1, 0, 1, 2.0)}
    assert aggregates.tag_run(rows, "2026-01-01T00:00:00+00:00").select("extraction_timestamp").distinct().count() == 1


def test_entry_and_registry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def brute_communities(edges, rounds=5):
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    label = {k: k for k in near}
    for _ in range(rounds):
        new = {}
        for k, others in near.items():
            votes = {}
            for o in others:
                votes[label[o]] = votes.get(label[o], 0) + 1
            new[k] = min(votes, key=lambda c: (-votes[c], c))
        label = new
    return label, near


def test_communities_match_brute_force(spark):
    from lodestrata.plans import bridge, graphs

    sf = "/root/testdata/sf0.001"
    edges = [tuple(r) for r in bridge.source(spark, sf, bridge.DIGRAPH).collect()]
    label, near = brute_communities(edges)
    want = {}
    for c in set(label.values()):
        members = {k for k in label if label[k] == c}
        inner = sum(len(near[k] & members) for k in members) / 2
        possible = len(members) * (len(members) - 1) / 2
        want[c] = (len(members), round(inner / possible, 4) if possible else 0.0, len(members) < 3)
    got = {r["community"]: (r["members"], r["cohesion"], r["thin"]) for r in graphs.communities(spark, sf).collect()}
    assert got == want


def shortest_paths(edges, start):
    """(distance, number of shortest paths) of every node that ``start`` reaches, by a plain queue."""
    far, paths, queue = {start: 0}, {start: 1}, [start]
    for node in queue:
        for a, b in edges:
            if a == node and b not in far:
                far[b], paths[b] = far[node] + 1, 0
                queue.append(b)
            if a == node and far[b] == far[node] + 1:
                paths[b] += paths[node]
    return far, paths


def brute_betweenness(edges):
    edges = {(a, b) for a, b in edges if a != b}
    nodes = {n for e in edges for n in e}
    known = {n: shortest_paths(edges, n) for n in nodes}
    out = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        for t in nodes - {s}:
            for v in nodes - {s, t}:
                if t in known[s][0] and v in known[s][0] and t in known[v][0] and known[s][0][v] + known[v][0][t] == known[s][0][t]:
                    out[v] += known[s][1][v] * known[v][1][t] / known[s][1][t]
    return out


def test_betweenness_matches_brute_force(spark):
    for seed in range(1):
        rng = random.Random(seed)
        edges = [(rng.randrange(14), rng.randrange(14)) for _ in range(30)] + [(20, 21), (21, 22), (20, 23), (23, 22), (22, 24), (21, 21)]
        frame = spark.createDataFrame(edges + edges[:5], "src long, dst long")
        want = brute_betweenness(edges)
        got = {r["node"]: r for r in graph.betweenness(frame).collect()}
        assert {n: round(r["betweenness"], 6) for n, r in got.items()} == {n: round(x, 6) for n, x in want.items()} and {r["error_bound"] for r in got.values()} == {0.0}
        some = {r["node"]: r for r in graph.betweenness(frame, pivots=8).collect()}
        assert set(some) == set(want) and all(abs(r["betweenness"] - want[n]) <= r["error_bound"] for n, r in some.items())
    assert graph.betweenness(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_components_of_long_chains_need_few_rounds(spark):
    n, rounds = 4096, []
    chain = spark.range(n - 1).selectExpr("id AS src", "id + 1 AS dst")
    assert graph.strong_components(chain, rounds).count() == 0 and len(rounds) <= 20
    ring, rounds = spark.range(64).selectExpr("id AS src", "(id + 1) % 64 AS dst"), []
    assert graph.strong_components(ring, rounds).selectExpr("count(*) n", "max(scc) m").first() == (64, 0) and len(rounds) <= 16


def test_components_match_brute_force(spark):
    for seed in range(1):
        rng = random.Random(seed)
        edges = [(rng.randrange(16), rng.randrange(16)) for _ in range(20)]
        reach = {n: set(shortest_paths(edges, n)[0]) for n in range(16)}
        want = {(a, min(b for b in reach[a] if a in reach[b])) for a in range(16) if sum(a in reach[b] for b in reach[a]) > 1}
        assert {tuple(r) for r in graph.strong_components(spark.createDataFrame(edges, "src long, dst long")).collect()} == want


def test_pairs_and_sums_cross_the_ranges(spark):
    rng = random.Random(2)
    rows = [(k * 3, rng.choice("ABC")) for k in range(500)]
    frame = spark.createDataFrame(rows, "seq long, action string").repartition(7)
    pairs = windows.bigrams(frame, [])
    assert sorted(tuple(r) for r in pairs.collect()) == [(b[0], f"{a[1]} → {b[1]}") for a, b in zip(rows, rows[1:])]
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert all("[part#" in line for line in plan.split("\n") if "Window" in line) and "Window" in plan
    sizes = [(k, rng.choice([0, 1, 5, 40])) for k in range(300)]
    got = {r["k"]: r["before"] for r in windows.running_sum(spark.createDataFrame(sizes, "k long, v long"), "v", "k").collect()}
    assert got == {k: sum(v for j, v in sizes if j < k) for k, _ in sizes}
    for frame in (pairs.limit(0).selectExpr("seq", "sequence AS action"), spark.createDataFrame([(1, "A")], "seq long, action string")):
        assert windows.bigrams(frame, []).count() == 0


def test_budget_cuts_in_the_midst(spark):
    texts = [(1, "abcd"), (2, ""), (3, None), (4, "efghij"), (5, "k"), (6, "lmn")]
    frame = spark.createDataFrame(texts, "k long, t string").repartition(3)
    for budget in (0, 7, 10, 100):
        got = sorted(windows.within_budget(frame, "t", budget, "k").collect())
        assert "".join(r["t"] for r in got) == "abcdefghijklmn"[:budget] and [r["cut"] for r in got] == [False] * (len(got) - 1) + [budget not in (4, 10, 11, 100)] * bool(got)


def test_bridge_nodes_are_exact_above_the_pivots(spark, monkeypatch):
    """The statement counts all shortest paths, so the query must not sample, however many nodes there are."""
    from lodestrata.plans import graphs

    sf = "/root/testdata/sf0.001"
    want = {tuple(r) for r in graphs.bridge_nodes(spark, sf).collect()}
    monkeypatch.setattr(graph.betweenness, "__defaults__", (8, 0.95))
    assert len(want) > 8 and {tuple(r) for r in graphs.bridge_nodes(spark, sf).collect()} == want


def test_small_components_write_no_row_a_pair(spark, monkeypatch):
    """The rows that betweenness writes down follow the nodes, not the pairs of nodes in a component."""
    edges = [(100 * c + a, 100 * c + b) for c in range(3) for a in range(40) for b in range(a + 1, min(a + 4, 40))]
    counts = []
    for name in {"cut", "written"} & {*vars(graph)}:
        monkeypatch.setattr(graph, name, lambda df, *label, keep=getattr(graph, name): counts.append((out := keep(df, *label)).count()) or out)
    got = {r["node"]: r["betweenness"] for r in graph.betweenness(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert len(got) == 120 and sum(counts) <= 120 * 12
    want = brute_betweenness([e for e in edges if e[0] < 40])
    assert all(abs(got[n] - want[n % 100]) < 1e-9 for n in got)


def test_betweenness_of_small_and_large_components(spark, monkeypatch):
    rng = random.Random(3)
    edges = [(f"a{rng.randrange(9)}", f"a{rng.randrange(9)}") for _ in range(20)] + [("b", "c"), ("c", "d"), ("e", "c")]
    want = {n: round(x, 6) for n, x in brute_betweenness(edges).items()}
    monkeypatch.setattr(graph, "PART_NODES", 4)
    got = graph.betweenness(spark.createDataFrame(edges, "src string, dst string")).collect()
    assert {r["node"]: round(r["betweenness"], 6) for r in got} == want
    import pyarrow as pa

    for steps in (1, 30, 1 << 21):
        monkeypatch.setattr(graph, "STEPS_AT_ONCE", steps)
        kinds = [e for e in {*edges} if e[0] != e[1]]
        found = graph._between(pa.table({"src": [a for a, _ in kinds], "dst": [b for _, b in kinds]})).to_pylist()
        assert {r["node"]: round(r["share"], 6) for r in found} == want


def test_weak_components_match_brute_force(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + k, 101 + k) for k in range(50)] + [(200 + k, 299) for k in range(20)] + [(320 - k, 319 - k) for k in range(15)]
    edges = [(a, b) for a, b in edges if a != b]
    part = {n: n for e in edges for n in e}
    for _ in part:
        for a, b in edges:
            part[a] = part[b] = min(part[a], part[b])
    assert {tuple(r) for r in graph.weak_components(spark.createDataFrame(edges, "src long, dst long")).collect()} == {*part.items()}


def test_estimates_do_not_grow_with_the_rounds(spark):
    """Labels are joined with themselves in every round: what the driver thinks of their size stays that of their rows."""
    ways = spark.range(300).selectExpr("id AS src", "id + 1 AS dst")
    assert len(str(graph.weak_components(ways)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 12


def test_communities_in_many_shares(spark, monkeypatch):
    monkeypatch.setattr(graph, "EDGES_A_PART", 10)
    edges = [(n, (n * 7 + 1) % 60) for n in range(60)] + [(n, (n + 1) % 60) for n in range(60)]
    frame = spark.createDataFrame(edges, "src long, dst long")
    want, _ = brute_communities(edges)
    assert {r["node"]: r["community"] for r in graph.label_communities(frame).collect()} == want
