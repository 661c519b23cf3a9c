import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sondar.llm import hnsw

hnsw_init = hnsw.Graph.__init__


def brute(rows, least=0.98):
    good = [(i, l, np.array(v, dtype=float)) for i, l, v in rows
            if l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i, _, _ in rows}
    for a, (i, l, v) in enumerate(good):
        for j, m, w in good[:a]:
            if l == m and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= least:
                links[i].add(j)
                links[j].add(i)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(links[i]), min(seen))
    return out


def made():
    rng = np.random.default_rng(5)
    rows, base = [], rng.normal(size=(60, 16))
    for n, b in enumerate(base):
        rows.append((len(rows), n % 3, b.tolist()))
        for _ in range(n % 6):
            rows.append((len(rows), n % 3 if n % 7 else (n + 1) % 3, (b + rng.normal(size=16) * 0.04).tolist()))
    hub = rng.normal(size=16)
    rows += [(len(rows) + k, 0, (hub + rng.normal(size=16) * 0.03).tolist()) for k in range(80)]
    rows += [(len(rows) + k, 1, hub.tolist()) for k in range(30)]
    rows += [(1000, 0, None), (1001, 0, [0.0] * 16), (1002, 0, [float("nan")] * 16), (1003, 0, [None, 1.0]), (1004, None, hub.tolist()),
             (1005, 1, [float("inf")] + [1.0] * 15), (1006, 1, (3 * hub).tolist()), (1007, 1, []), (1008, 1, hub[:8].tolist())]
    return rows


def test_matches_brute_force_in_one_and_many_shards(spark):
    rows = made()
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("node", F.lit("x"))
    want = brute(rows)
    for shard_rows in (50_000, 25):
        got = {r.vec_id: r for r in hnsw.near_duplicates(frame, shard_rows=shard_rows).collect()}
        assert len(got) == len(rows)
        found, true = sum(got[i].n_links for i in got), sum(n for n, _ in want.values())
        assert 0.97 * true <= found <= true
        assert sum(got[i].component_id == want[i][1] for i in got) >= 0.98 * len(rows)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
        assert all(got[i].n_links == 0 for i in range(1000, 1009) if i != 1006)


class Missing(hnsw.Graph):
    """A graph whose searches miss some vectors until the beam is wide."""

    lost: set = frozenset()

    def within(self, q, least, beam):
        found = super().within(q, least, beam)
        return found if beam >= 96 else found[~np.isin(found, list(self.lost))]


def test_widening_reaches_the_recall(monkeypatch):
    monkeypatch.setattr(hnsw, "Graph", Missing)
    monkeypatch.setattr(Missing, "lost", set(range(0, 600, 2)))
    raw = np.random.default_rng(2).normal(size=(600, 8))
    shard = hnsw.Shard(raw, 0.98)
    assert shard.beam == 96 and shard.recall >= 0.99 and not shard.complete
    monkeypatch.setattr(Missing, "lost", set())
    assert hnsw.Shard(raw, 0.98).beam == hnsw.BEAM


def test_audit_needs_no_pairs_among_the_vectors(monkeypatch):
    monkeypatch.setattr(hnsw, "Graph", Missing)
    monkeypatch.setattr(Missing, "lost", set(range(1500)))
    shard = hnsw.Shard(np.random.default_rng(3).normal(size=(1500, 32)), 0.98)
    assert shard.beam == 96 and shard.recall == 1


def test_audit_is_not_drowned_by_a_large_group(monkeypatch):
    rng = np.random.default_rng(6)
    raw = rng.normal(size=(2000, 32))
    raw[:1600] = raw[0] + rng.normal(size=(1600, 32)) * 0.02
    monkeypatch.setattr(hnsw, "Graph", Missing)
    monkeypatch.setattr(Missing, "lost", set(range(1700, 2000)))
    assert hnsw.Shard(raw, 0.98).beam == 96


def test_where_searches_fail_every_vector_is_compared(monkeypatch):
    class Blind(hnsw.Graph):
        def within(self, q, least, beam):
            return np.empty(0, np.int64)

    monkeypatch.setattr(hnsw, "Graph", Blind)
    raw = np.random.default_rng(8).normal(size=(300, 16))
    raw[7] = raw[200] * 2
    shard = hnsw.Shard(raw, 0.98)
    assert shard.complete and shard.links(raw[7]).tolist() == [7, 200]


def rows_of(groups):
    """Batches of (label, dim, shard, role, vec, copies, v) as a task gets them."""
    names = ["label", "dim", "shard", "role", "vec", "copies", "v"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.float64())]
    for i in range(0, len(groups), 37):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*groups[i : i + 37]), kinds)], names=names)


def test_every_query_searches_each_graph_once(monkeypatch):
    made = []
    monkeypatch.setattr(hnsw, "Graph", type("Kept", (hnsw.Graph,), {"__init__": lambda g, *a: (made.append(g), hnsw_init(g, *a))[1]}))
    raw = np.random.default_rng(1).normal(size=(400, 32)).tolist()
    rows = [(0, 32, k // 200, 0, k, 1, v) for k, v in enumerate(raw)]
    rows[200:200] = [(0, 32, 0, 1, 1000 + k, 1, v) for k, v in enumerate(raw[200:])]
    found = [r for b in hnsw._answers(0.98, 0.99)(rows_of(rows)) for r in b.to_pylist()]
    # No pair exists: an answer a vector, from searches alone, besides those of the audits.
    assert sorted(r["vec"] for r in found) == list(range(400)) and not any(r["links"] for r in found)
    assert len(made) == 2 and sum(g.searches for g in made) == 600 + 2 * hnsw.PLANTED


def test_links_between_shards_count_at_both_ends(spark):
    rng = np.random.default_rng(12)
    base = rng.normal(size=(150, 24))
    raw = np.concatenate([base, base + rng.normal(size=base.shape) * 0.02])
    rows = [(i, 0, v.tolist()) for i, v in enumerate(raw)]
    got = {r.vec_id: r.n_links for r in hnsw.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), shard_rows=60).collect()}
    want = brute(rows)
    assert sum(got.values()) >= 0.99 * sum(n for n, _ in want.values())
    assert all(got[i] == got[i + 150] for i in range(150))


def test_no_links_without_partners(spark):
    rows = [(i, 0, [float(i == j) for j in range(8)]) for i in range(8)]
    got = hnsw.near_duplicates(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()
    assert len(got) == 8 and all(r.n_links == 0 for r in got)


def test_empty_and_repeated(spark):
    schema = "vec_id long, label int, embedding array<float>"
    assert hnsw.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, 0, [1.0, 0.0]), (1, 0, [1.0, 0.0]), (None, 0, [1.0, 0.0])]
    got = hnsw.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert [r.n_links for r in got] == [2, 2, 2] and sorted(str(r.component_id) for r in got) == ["1", "1", "None"]
