import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sondar.llm import prefix_trie, radix


def test_tree_holds_what_was_added_in_every_layout():
    rng = random.Random(3)
    tree, want, layouts = radix.Tree(), {}, set()
    for i in range(6000):
        key = bytes(rng.choice([rng.randrange(256), rng.randrange(4)]) for _ in range(rng.randrange(5)))
        tree.add(key, i)
        want.setdefault(key, []).append(i)
    got, stack = {}, [(tree.root, b"")]
    while stack:
        node, above = stack.pop()
        path = above + node.prefix
        if node.values:
            assert node.key == path
            got[path] = node.values
        items = list(node.items())
        assert [b for b, _ in items] == sorted(b for b, _ in items) and all(node.child(b) is c for b, c in items)
        if items:
            layouts.add(type(node.layout))
            assert len(items) <= node.layout.limit
        stack += [(c, path + bytes([b])) for b, c in items]
    assert got == want and layouts == set(radix.LAYOUTS)
    assert radix.shared(b"abc", b"abd") == 2 and radix.shared(b"", b"a") == 0 and radix.shared(b"ab", b"abc") == 2


def brute(turns):
    """The nodes by definition, over {conversation: [(role, text), ...]}."""
    nodes = {}
    for c, t in turns.items():
        for d in range(len(t) + 1):
            nodes.setdefault(tuple(t[:d]), []).append(c)
    out = []
    for prefix, members in nodes.items():
        below = [p for p in nodes if p[: len(prefix)] == prefix]
        ends = sorted(c for c in members if len(turns[c]) == len(prefix))
        out.append((
            min(members), len(prefix), min(nodes[prefix[:-1]]) if prefix else None, len(members),
            sum(len(p) == len(prefix) + 1 for p in below), sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below),
            sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    return out


def made():
    rng = random.Random(1)
    rows = []
    for c in range(120):
        # Many equal conversations, and a first turn that most share.
        seed = rng.choice([0, 0, 0, rng.randrange(40)])
        for k in range(rng.choice([0, 1, 3, 9]) if seed else 6):
            rows.append((c, k, "user" if k % 2 == 0 else None, f"Zwölf {seed if k else 0} {k}" if k != 4 else None))
    rows += [(7, None, "user", "before"), (None, 0, "user", "nobody's"), (300, 0, "", ""), (301, 5, None, None)]
    rows += [(400, k, "user", f"long {k}") for k in range(300)] + [(401, k, "user", f"long {k}") for k in range(200)]
    return rows


@pytest.mark.parametrize("shard_bytes, fan", [(8 << 20, 64), (600, 64), (600, 2)])
def test_nodes_match_brute_force(spark, shard_bytes, fan):
    rows = made()
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(3)
    found = prefix_trie.with_openings(prefix_trie.keys(frame.withColumns({"key": F.lit(1), "lead": F.lit(1)})))
    got = prefix_trie.nodes(found, shard_bytes=shard_bytes, fan=fan)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=str) == brute(rebuilt(rows))


def test_own_turns_without_openings(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (-6, 0, "user", "a"), (-6, 0, "user", "a")]
    got = prefix_trie.nodes(prefix_trie.keys(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))).collect()
    assert sorted((r.depth, r.conv_id, r.n_convs, r.saved_tokens) for r in got) == [(0, -6, 2, 1), (1, -6, 2, 1), (2, -6, 1, 0), (2, 1, 1, 0)]


def test_empty_and_root_only(spark):
    schema = "conv_id long, key binary"
    assert prefix_trie.nodes(spark.createDataFrame([], schema)).count() == 0
    (root,) = prefix_trie.nodes(spark.createDataFrame([(2, b""), (1, b"")], schema)).collect()
    assert (root.conv_id, root.depth, root.parent_conv_id, root.n_convs, root.n_children, root.n_leaves) == (1, 0, None, 2, 0, 1)
    assert root.ends_sha256 == hashlib.sha256(b"1,2").hexdigest()
