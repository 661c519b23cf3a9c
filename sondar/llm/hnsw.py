"""Near-duplicate embeddings by navigable small-world graphs.

Different vectors of a label are dealt to shards of bounded size.  Each shard gets
a hierarchical graph, built once; its own vectors query it, and then those of other shards
of the label stream past.  Of two shards one queries the other, so that a link is found once and
counts at both ends.  A search keeps a beam of candidates and then walks on from
whatever is close enough, so results do not end with the beam.  Each graph is audited with planted queries,
vectors of the shard moved a little, and with some of its own, against brute
force for these alone; until enough of their links are found, the beam is
doubled.  The cosine of every link is verified in double precision.

A shard answers with the number of links of each vector and one edge for
each component it touches, never with all pairs.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondar.llm.common import components, quoted, staged

COSINE = 0.98
SHARD_ROWS = 2048
NEIGHBOURS = 10
BUILD_BEAM = 48
BEAM = 24
PLANTED = AUDITED = 64
CLOSEST = 0.999
RECALL = 0.99


class Graph:
    """A hierarchical navigable small-world graph over unit vectors."""

    def __init__(self, vectors: np.ndarray, neighbours: int = NEIGHBOURS, beam: int = BUILD_BEAM, seed: int = 11):
        self.x = vectors
        self.most = neighbours
        draws = [xxhash.xxh64_intdigest(i.to_bytes(8, "little"), seed) / 2**64 for i in range(len(vectors))]
        self.level = [int(-math.log(max(d, 1e-18)) / math.log(neighbours)) for d in draws]
        self.links: list[dict[int, np.ndarray]] = [{} for _ in range(max(self.level, default=0) + 1)]
        self.entry, self.top = 0, self.level[0] if len(vectors) else 0
        for layer in range(self.top + 1) if len(vectors) else ():
            self.links[layer][0] = np.empty(0, np.int64)
        self.mark = np.zeros(len(vectors), dtype=np.int64)
        self.stamp = self.searches = 0
        self.base: np.ndarray | None = None
        for i in range(1, len(vectors)):
            self._insert(i, beam)

    def _search(self, q: np.ndarray, entries: list[tuple[float, int]], beam: int, layer: int) -> list[tuple[float, int]]:
        """The best ``beam`` (similarity, vector) found from the entries, best first."""
        self.stamp += 1
        stamp, mark, x, links = self.stamp, self.mark, self.x, self.links[layer]
        best = list(entries)
        heapq.heapify(best)
        ahead = [(-s, i) for s, i in entries]
        heapq.heapify(ahead)
        for _, i in entries:
            mark[i] = stamp
        while ahead:
            s, i = heapq.heappop(ahead)
            if -s < best[0][0] and len(best) >= beam:
                break
            near = links[i]
            near = near[mark[near] != stamp]
            if not len(near):
                continue
            mark[near] = stamp
            for t, j in zip((x[near] @ q).tolist(), near.tolist()):
                if len(best) < beam:
                    heapq.heappush(best, (t, j))
                elif t > best[0][0]:
                    heapq.heapreplace(best, (t, j))
                else:
                    continue
                heapq.heappush(ahead, (-t, j))
        return sorted(best, reverse=True)

    def _descend(self, q: np.ndarray, layer: int) -> list[tuple[float, int]]:
        """The entry for a layer, found by steps uphill through those above."""
        i = self.entry
        s = float(self.x[i] @ q)
        for above in range(self.top, layer, -1):
            while True:
                near = self.links[above][i]
                if not len(near):
                    break
                all_s = self.x[near] @ q
                k = int(all_s.argmax())
                if all_s[k] <= s:
                    break
                s, i = float(all_s[k]), int(near[k])
        return [(s, i)]

    def _chosen(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Neighbours in different directions: those closer to the vector than to
        any neighbour already chosen, then the closest others."""
        if len(found) <= most:
            return [i for _, i in found]
        ids = np.array([i for _, i in found])
        between = self.x[ids] @ self.x[ids].T
        taken: list[int] = []
        spare: list[int] = []
        for k, (s, _) in enumerate(found):
            if len(taken) >= most:
                break
            (taken if not taken or between[k, taken].max() < s else spare).append(k)
        taken += spare[: most - len(taken)]
        return ids[taken].tolist()

    def _insert(self, i: int, beam: int) -> None:
        q, level = self.x[i], self.level[i]
        at = self._descend(q, min(level, self.top))
        for layer in range(min(level, self.top), -1, -1):
            at = self._search(q, at, beam, layer)
            most = 2 * self.most if layer == 0 else self.most
            chosen = self._chosen(at, self.most)
            links = self.links[layer]
            links[i] = np.array(chosen, dtype=np.int64)
            for j in chosen:
                near = np.append(links[j], i)
                if len(near) > most:
                    s = self.x[near] @ self.x[j]
                    order = np.argsort(-s, kind="stable")
                    near = np.array(self._chosen([(float(s[k]), int(near[k])) for k in order], most), dtype=np.int64)
                links[j] = near
        for layer in range(self.top + 1, level + 1):
            self.links[layer][i] = np.empty(0, np.int64)
        if level > self.top:
            self.top, self.entry = level, i

    def within(self, q: np.ndarray, least: float, beam: int) -> np.ndarray:
        """Vectors at least so similar, as far as found: those in the beam, and all
        that can be reached from them through vectors at most twice as far away."""
        self.searches += 1
        if not len(self.x):
            return np.empty(0, np.int64)
        if self.base is None:
            # The lowest layer in one array, short lists filled up with the vector itself.
            self.base = np.tile(np.arange(len(self.x))[:, None], 2 * self.most)
            for i, near in self.links[0].items():
                self.base[i, : len(near)] = near
        best = self._search(q, self._descend(q, 0), beam, 0)
        bridge = 2 * least - 1
        close = [(s, i) for s, i in best if s >= bridge]
        ahead = np.array([i for _, i in close], dtype=np.int64)
        found, seen = [np.array([i for s, i in close if s >= least], dtype=np.int64)], np.zeros(len(self.x), dtype=bool)
        if not len(found[0]):
            return found[0]
        seen[ahead] = True
        while len(ahead):
            near = np.unique(self.base[ahead])
            near = near[~seen[near]]
            seen[near] = True
            similar = self.x[near] @ q
            found.append(near[similar >= least])
            ahead = near[similar >= bridge]
        return np.concatenate(found)


def _unit(raw: np.ndarray) -> np.ndarray:
    return raw / np.sqrt((raw * raw).sum(axis=1))[:, None]


class Shard:
    """The graph of a shard's vectors, and how wide its searches have to be."""

    def __init__(self, raw: np.ndarray, least: float, recall: float = RECALL, beam: int = BEAM,
                 planted: int = PLANTED, own: int = AUDITED):
        self.raw, self.least, self.beam = raw, least, beam
        self.norms = np.sqrt((raw * raw).sum(axis=1))
        self.graph = Graph(_unit(raw))
        self.complete = False
        self.recall = self._audit(recall, planted, own)

    def exact(self, query: np.ndarray, found: np.ndarray) -> np.ndarray:
        """Of the vectors found those whose cosine, in double precision, is enough."""
        cosine = self.raw[found] @ query / (self.norms[found] * np.sqrt(query @ query))
        return found[cosine >= self.least]

    def all_of(self, query: np.ndarray) -> np.ndarray:
        near = self.graph.x @ (query / np.sqrt(query @ query))
        return self.exact(query, np.flatnonzero(near >= self.least - 1e-9))

    def links(self, query: np.ndarray) -> np.ndarray:
        """The vectors linked to a query."""
        if self.complete:
            return self.all_of(query)
        unit = query / np.sqrt(query @ query)
        return self.exact(query, self.graph.within(unit, self.least - 1e-9, self.beam))

    def _audit(self, recall: float, planted: int, own: int) -> float | None:
        """The recall of the searches, None where no audited query has a partner.

        Planted queries are vectors of the shard turned by a cosine between the least and
        ``CLOSEST``; of the shard's own vectors, a sample is asked and none is its own partner.  The mean
        is taken among queries with about as many partners (by powers of two), and the
        least of these means counts, so that a large group does not hide the pairs.  The beam is doubled
        until the recall is reached; should one as wide as the shard not do, all
        its queries are answered by comparing them with every vector.
        """
        draw = np.random.default_rng(len(self.raw))
        asked = []
        for i in draw.integers(0, len(self.raw), planted if len(self.raw) else 0).tolist():
            x = self.graph.x[i]
            aside = draw.normal(size=len(x))
            aside -= (aside @ x) * x
            length = np.sqrt(aside @ aside)
            if length > 0 and self.least < CLOSEST:
                c = draw.uniform(self.least + (CLOSEST - self.least) / 100, CLOSEST)
                asked.append((None, c * x + math.sqrt(1 - c * c) * aside / length))
        asked += [(i, self.raw[i]) for i in draw.permutation(len(self.raw))[:own].tolist()]
        classes: dict[int, list[tuple[np.ndarray, int, int]]] = {}
        for i, query in asked:
            n = len(true := self.all_of(query)) - (i is not None and i in true)
            if n:
                classes.setdefault(n.bit_length(), []).append((query, n, i is not None))
        while classes:
            reached = min(
                np.mean([(len(self.links(query)) - mine) / n for query, n, mine in queries]) for queries in classes.values())
            if reached >= recall:
                return float(reached)
            if self.beam >= len(self.raw):
                self.complete = True
                return 1.0
            self.beam *= 2
        return None


_FOUND = "vec long, links long, root long, beam int, recall double"


def _answers(least: float, recall: float):
    def answered(rows: tuple[list, list, list]) -> tuple[Shard, list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A shard's graph and its vectors' links among each other."""
        ids, copies = np.array(rows[0], dtype=np.int64), np.array(rows[1], dtype=np.int64)
        shard = Shard(np.array(rows[2], dtype=np.float64), least, recall)
        linked = np.zeros((len(ids), len(ids)), dtype=bool)
        for i, query in enumerate(shard.raw):
            linked[i, shard.links(query)] = True
        # A link found from one end counts at both.
        linked |= linked.T
        np.fill_diagonal(linked, False)
        label = np.arange(len(ids))
        for i, row in enumerate(linked):
            meet = np.unique(label[np.flatnonzero(row)])
            if len(meet) and (meet[0] != label[i] or len(meet) > 1):
                meet = np.append(meet, label[i])
                label[np.isin(label, meet)] = meet.min()
        return shard, ids, copies, linked @ copies + copies - 1, ids[label]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, state = None, ([], [], []), None

        def ended() -> Iterator[pa.RecordBatch]:
            if now is not None:
                shard, ids, _, links, roots = state or answered(rows)
                yield _batch(ids, links, roots, shard)

        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in ("label", "dim", "shard")])
            columns = [batch.column(c).to_pylist() for c in ("role", "vec", "copies", "v")]
            out: tuple[list, list, list] = ([], [], [])
            for key, role, vec, copies, v in zip(keys, *columns):
                if key != now:
                    if out[0]:
                        yield _batch(*out, state[0])
                        out = ([], [], [])
                    yield from ended()
                    now, rows, state = key, ([], [], []), None
                if not role:
                    for held, value in zip(rows, (vec, copies, v)):
                        held.append(value)
                    continue
                if state is None:
                    state = answered(rows)
                shard, _, weights, links, roots = state
                hits = shard.links(np.array(v, dtype=np.float64))
                if len(hits):
                    links[hits] += copies
                    n = int(weights[hits].sum())
                    for k, root in enumerate(np.unique(roots[hits]).tolist()):
                        for held, value in zip(out, (vec, 0 if k else n, root)):
                            held.append(value)
            if out[0]:
                yield _batch(*out, state[0])
        yield from ended()

    return run


def _batch(ids, links, roots, shard: Shard) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(links, pa.int64()), pa.array(roots, pa.int64()),
         pa.array([shard.beam] * len(ids), pa.int32()), pa.array([shard.recall] * len(ids), pa.float64())],
        names=["vec", "links", "root", "beam", "recall"])


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
                    cosine: float = COSINE, shard_rows: int = SHARD_ROWS, recall: float = RECALL) -> DataFrame:
    """(id_col, n_links, component_id, kept, beam, recall) for every row.

    Rows are compared only when their labels are equal and not null and their
    vectors have as many components.  Vectors that are null, empty or zero or hold
    null or non-finite components link with nothing.  ``n_links`` counts the other rows
    linked directly, ``component_id`` is the smallest id reachable, and ``kept`` says that it
    is the row's own.  ``recall`` is what the audit of the row's shard measured (null
    where nothing was searched or no vector had a partner).  Rows with equal vectors link and count one by one; rows
    without an id have themselves alone in the result (null component) but count as links.

    A vector meets the shards of its label only; their number grows with the label, so a label
    of a thousand shards costs five hundred searches a vector.
    """
    e = quoted(vector)
    sound = (
        quoted(label).isNotNull() & e.isNotNull() & (F.size(e) > 0)
        & F.forall(e, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
        & F.exists(e, lambda c: c != 0)
    )
    rows = vectors.select(quoted(id_col).cast("long").alias("id"), quoted(label).alias("label"), e.cast("array<double>").alias("v"),
                          F.coalesce(sound, F.lit(False)).alias("sound"))
    digest = F.xxhash64("label", "v")
    # Equal vectors are one; their smallest id stands for them, a hash of a vector whose ids are all null.
    different = staged(
        rows.where("sound").groupBy("label", "v").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("copies"))
        .select("label", "v", F.size("v").alias("dim"), "low", "copies", digest.alias("vec")), "vectors")
    sizes = staged(
        different.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
        .select("label", "dim", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards")), "sizes")
    dealt = different.join(sizes, ["label", "dim"]).select(
        "label", "dim", "shards", F.pmod(F.xxhash64("vec", F.lit("shard")), F.col("shards")).cast("int").alias("own"),
        "vec", "copies", "v")
    # Round a circle of shards each asks the half that follows; opposite ones, the lower the higher.
    ahead, half = F.pmod(F.col("shard") - F.col("own"), F.col("shards")), F.col("shards") / 2
    every = dealt.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).where(
        (ahead < half) | ((ahead == half) & (F.col("own") < F.col("shard"))))
    asked = every.select("label", "dim", "shard", (ahead != 0).cast("int").alias("role"), "vec", "copies", "v")
    key = ["label", "dim", "shard"]
    found = staged(
        asked.repartition(*key).sortWithinPartitions(*key, "role", "vec").mapInArrow(_answers(cosine, recall), _FOUND), "found")
    edges = found.select(F.col("vec").alias("u"), F.col("root").alias("v"))
    comps = staged(components(edges), "components")
    counted = found.groupBy("vec").agg(F.sum("links").alias("n"), F.max("beam").alias("beam"), F.min("recall").alias("recall"))
    joined = different.select("vec", "low").join(counted, "vec").join(
        comps, F.col("vec") == F.col("node"), "left").select("vec", "low", "n", "beam", "recall", F.coalesce("root", "vec").alias("root"))
    least = joined.groupBy("root").agg(F.min("low").alias("component_id"))
    done = staged(joined.join(least, "root").select("vec", "n", "beam", "recall", "component_id"), "linked")
    keyed = rows.select("id", F.when(F.col("sound"), digest).alias("vec"))
    return keyed.join(done, "vec", "left").select(
        F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).alias("n_links"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"), "beam", "recall")
