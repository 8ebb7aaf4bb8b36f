"""The prefix trie against a plain version that walks every conversation."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from mendflow.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, d1 string, len int, block string"


def awkward():
    """Heads shared in a family, copies, nulls, ties, repeated rows, families without a first, turnless results."""
    rows = []

    def add(conv, turn, role, text):
        rows.append((conv, turn, role, text, "clash", 7, "clash"))

    for conv in [*range(0, 40), *range(100, 110), *range(205, 215)]:
        for turn in range(conv % 9 + 1):
            add(conv, turn, "user" if turn % 2 == 0 else "assistant", f"t{turn} of {conv % 4}é" if turn < 4 else f"own {conv}")
    for conv in range(300, 420):  # copies
        for turn in range(7):
            add(conv, turn, "user", "the same turn" * turn)
    add(500, None, None, None)
    add(500, 1, "user", "")
    add(501, 1, "", "")
    add(501, 1, "user", "tie")
    add(501, 1, "user", "tie")
    add(501, 1, "assistant", "tie")
    add(None, 0, "user", "no conversation")
    add(-7, 0, "user", "below zero")
    add(-105, 3, "user", "below zero")
    for turn in range(300):
        add(600, turn, "user", f"long {turn}")
        add(601, turn, "user", f"long {turn}")
    add(700, 0, "user", "x" * 200_000)
    return rows


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    nodes = defaultdict(lambda: [set(), set(), set()])  # members, children, those that end
    for c, mine in turns.items():
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(turns.get(base, [])[:h] + mine[h:])
        for d in range(len(path) + 1):
            members, children, ends = nodes[path[:d]]
            members.add(c)
            if d < len(path):
                children.add(path[: d + 1])
            else:
                ends.add(c)
    numbers = {}
    for path in sorted(nodes, key=len, reverse=True):
        members, children, _ = nodes[path]
        saved = (len(members) - 1) * (len(path[-1][1]) if path else 0) + sum(numbers[x][1] for x in children)
        numbers[path] = (sum(numbers[x][0] for x in children) or 1, saved)
    out = []
    for path, (members, children, ends) in nodes.items():
        parent = min(nodes[path[:-1]][0]) if path else None
        digest = hashlib.sha256(",".join(map(str, sorted(ends))).encode()).hexdigest()
        out.append((min(members), len(path), parent, len(members), len(children), *numbers[path], digest))
    return sorted(out, key=str)


def found(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("most_cells", [64, 1024, prefix_trie.MOST_CELLS])
def test_awkward_conversations(spark, most_cells):
    """A sketch that is too small proves less and changes nothing."""
    rows = awkward()
    conversations = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(prefix_trie.trie(conversations, most_cells)) == plain(rows)


def test_long_conversations_are_summed_by_blocks_and_lists_by_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", 16)
    monkeypatch.setattr(prefix_trie, "IDS_TOGETHER", 7)
    monkeypatch.setattr(prefix_trie, "SKETCH_BLOCK", 256)
    rows = awkward()
    assert found(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(3))) == plain(rows)


def test_sketch_proves_most_lone_prefixes(spark):
    rows = spark.range(4000).selectExpr("xxhash64(id % 3000) d1", "xxhash64('s', id % 3000) d2", "0L p1", "0L p2", "1L depth")
    screened = prefix_trie.screen(rows)
    counts = screened.groupBy("d1").agg({"*": "count", "alone": "max"}).collect()
    alone = [r["max(alone)"] for r in counts if r["count(1)"] == 1]
    assert not any(r["max(alone)"] for r in counts if r["count(1)"] > 1)
    assert sum(alone) > 0.95 * len(alone) == 0.95 * 2000


def test_empty_table(spark):
    assert found(prefix_trie.trie(spark.createDataFrame([], SCHEMA))) == []
    assert found(prefix_trie.trie(spark.createDataFrame([(None, 1, "a", "b", "", 1, "")], SCHEMA))) == []
