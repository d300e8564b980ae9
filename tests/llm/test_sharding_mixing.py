"""Sharding by longest processing time, and the min-cost flow mix."""

import itertools
import random
import re
import zlib
from collections import defaultdict

from paneltide.llm import flow_mixing, lpt_sharding
from tests.llm.conftest import edge_rows


def test_longest_first_is_lpt():
    r = random.Random(2)
    items = [(f"i{k}", r.randint(1, 50)) for k in range(40)]
    load = defaultdict(int)
    for item, size in sorted(items, key=lambda x: (-x[1], x[0])):
        s = min(range(5), key=lambda s: (load[s], s))
        assert lpt_sharding.longest_first(items, 5)[item] == s
        load[s] += size


def test_shards(spark, edge):
    rows = lpt_sharding.shard_documents(edge, shards=3).collect()
    want = sorted((str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in edge_rows())
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    assert all(sorted(r["slot"] for r in g) == list(range(len(g))) for g in by.values())
    text = {(d, zlib.crc32((t or "").encode())): t or "" for d, t, *_ in edge_rows()}
    place = defaultdict(set)
    for r in rows:
        place[text[r["doc_id"], r["text_crc32"]]].add(r["shard"])
    assert all(len(s) == 1 for s in place.values())  # equal texts stay together


def test_slots_in_parts(spark, monkeypatch):
    monkeypatch.setattr(lpt_sharding, "NUMBERED", 10)
    rows = spark.range(500).selectExpr("id AS doc_id", "cast(id % 4 AS int) AS shard")
    out = lpt_sharding.number(rows, ["doc_id"], 500).collect()
    for s in range(4):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(125))


def test_shard_sizes_near_equal(spark):
    rows = spark.range(4000).selectExpr("id AS doc_id", "repeat('x', cast(1 + id * id % 997 AS int)) || id AS text")
    load = defaultdict(int)
    for r in lpt_sharding.shard_documents(rows, shards=24).collect():
        load[r["shard"]] += r["size"]
    assert len(load) == 24 and max(load.values()) < 1.02 * min(load.values())


def test_no_documents(spark, empty):
    assert lpt_sharding.shard_documents(empty, shards=24).count() == 0
    assert flow_mixing.mix(flow_mixing.sized(empty), weigh=flow_mixing.one_two_three).count() == 0
    assert flow_mixing.mixed(empty, flow_mixing.one_two_three).count() == 0


def test_targets():
    sizes, weights = {"a": 100, "b": 10, "c": 90}, {"a": 1, "b": 2, "c": 3}
    got = flow_mixing.targets(sizes, weights)
    assert got["b"] == 30 and abs(sum(got.values()) - 200) < 1e-9
    assert abs(got["a"] - 170 / 4) < 1e-9 and abs(got["c"] - 170 * 3 / 4) < 1e-9
    assert flow_mixing.targets({}, {}) == {}
    assert flow_mixing.targets({"a": 0}, {"a": 1}) == {"a": 0.0}


def test_route_is_a_cheapest_flow():
    """Against all integral flows of small cases."""
    r = random.Random(4)
    for _ in range(12):
        patterns = {("a",): r.randint(0, 2), ("a", "b"): r.randint(0, 2), ("b",): r.randint(0, 2)}
        quotas = {"a": r.randint(0, 4), "b": r.randint(0, 4)}
        got = flow_mixing.route(patterns, quotas)
        cost = lambda n, size: sum(c * max(0, min(size, n - k * size)) for k, c in enumerate(flow_mixing.REPEAT_COSTS))
        best = None
        links = [(p, s) for p in patterns for s in p]
        for flow in itertools.product(range(5), repeat=len(links)):
            use = dict(zip(links, flow))
            if any(sum(f for (p, s), f in use.items() if s == q) > n for q, n in quotas.items()):
                continue
            if any(sum(f for (p, s), f in use.items() if p == q) > 3 * n for q, n in patterns.items()):
                continue
            value = (-sum(flow), sum(cost(sum(f for (p, s), f in use.items() if p == q), n) for q, n in patterns.items()))
            best = value if best is None else min(best, value)
        total = -sum(f for to in got.values() for f in to.values())
        assert (total, sum(cost(sum(got[p].values()), n) for p, n in patterns.items())) == best


def test_mix_meets_targets(spark):
    r = random.Random(5)
    rows = [(k, " ".join(["w"] * r.randint(0, 60)), r.choice(["x", "y", None])) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = flow_mixing.mix(flow_mixing.sized(docs), weigh=flow_mixing.one_two_three).collect()
    source = {k: s for k, _, s in rows}
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for k, t, _ in rows}
    sizes = {s: sum(size[k] for k in size if source[k] == s) for s in ("x", "y", None)}
    want = flow_mixing.targets(sizes, {"x": 1, "y": 2, None: 3})
    taken = defaultdict(int)
    for g in got:
        assert g["size"] == size[g["id"]] and 0 <= g["taken"] <= 3 * g["size"]
        assert g["source_size"] == sizes[source[g["id"]]] and abs(g["target"] - want[source[g["id"]]]) < 1e-6
        taken[source[g["id"]]] += g["taken"]
    assert all(abs(taken[s] - want[s]) <= 60 for s in want)
    again = flow_mixing.mix(flow_mixing.sized(docs.repartition(7)), weigh=flow_mixing.one_two_three).collect()
    assert {(g["id"], g["taken"]) for g in got} == {(g["id"], g["taken"]) for g in again}


def test_overlapping_sources(spark):
    """What two sources share goes to the one that lacks tokens."""
    rows = spark.createDataFrame([(k, 0, 10, ["a"] if k < 10 else ["a", "b"]) for k in range(20)], "id long, tie long, size long, sources array<string>")
    got = flow_mixing.mix(rows, quotas={"a": 100, "b": 100}).collect()
    assert all(g["taken"] == 10 for g in got)  # nothing needs repeating


def test_mixed_rows(spark, edge):
    got = flow_mixing.mixed(edge, flow_mixing.one_two_three)
    assert got.columns == edge.columns
    sizes = flow_mixing.mix(flow_mixing.sized(edge), weigh=flow_mixing.one_two_three).agg({"copies": "sum"}).first()[0]
    assert got.count() == sizes
