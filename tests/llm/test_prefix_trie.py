"""The trie of conversation prefixes against brute force over Python tuples, with awkward rows and tiny blocks."""
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaarlens.llm import prefix_trie
from bazaarlens.llm.rows import id_crc32

NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _rows():
    draw = random.Random(4)
    rows = []
    for c in range(130):
        start = draw.choice([(("system", "a b  c"),), (("user", None), ("assistant", "x\ty")), (("user", "hot start"),), ()])
        turns = [*start, *((draw.choice(["user", "assistant", None]), draw.choice(["ok", "", "ok ok", "ü z"])) for _ in range(draw.randint(0, 3)))]
        rows += [(c, t if c % 7 or t else None, role, text) for t, (role, text) in enumerate(turns)]
    for c in range(200, 240):  # one large group of equal conversations
        rows += [(c, t, "user", f"same {t}") for t in range(5)]
    rows += [(c, 10 * t, "user", f"long {t}") for c in (301, 302) for t in range(40 + c % 2)]  # many segments and blocks
    rows += [(303, 1, "user", "tie"), (303, 1, "user", "tie"), (303, 1, "assistant", "tie"), (None, 0, "user", "no conversation")]
    rows += [(-5, 0, "user", "below zero"), (321, 3, "user", "alone"), (322, 0, "user", "w " * 50_000)]
    return rows


def _digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def _want(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, _digest(role or "", text or ""), role or "", text or ""))
    own = {c: [x[3:] for x in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(own.get(donor, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
        ends[built[c]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        words = len(node[-1][1].split()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(members[node]) - 1) * words
    sha = lambda cs: hashlib.sha256(",".join(map(str, cs)).encode()).hexdigest()
    return sorted((m[0], len(n), members[n[:-1]][0] if n else -10**9, len(m), len(kids[n]) if n in kids else 0, leaves[n], saved[n], sha(ends.get(n, [])))
                  for n, m in list(members.items()))


def _trie(conversations, block=prefix_trie.TURN_BLOCK, **small):
    turns = prefix_trie.ordered_turns(conversations, block)
    convs, rebuilt = prefix_trie.with_shared_heads(turns, F.col("conv_id") - F.col("conv_id") % 20, id_crc32(F.col("conv_id"), 4), most=3)
    return prefix_trie.prefix_trie(convs, rebuilt, **small)


@pytest.fixture(scope="module")
def conversations(spark):
    wide = spark.createDataFrame(_rows(), "conv_id long, turn long, role string, text string")
    return wide.withColumns({"t": F.lit("x"), "pos": F.lit(1), "n": F.lit(0), "words": F.lit(7), "shard": F.lit(1)}).repartition(6)


@pytest.mark.parametrize("small", [{}, {"block": 7, "segment": 3, "shard_rows": 20, "id_block": 4}])
def test_trie(conversations, small):
    got = [tuple(-10**9 if r[c] is None else r[c] for c in NAMES) for r in _trie(conversations, **small).collect()]
    assert sorted(got) == _want(_rows())


def test_empty_table(conversations):
    empty = _trie(conversations.limit(0))
    assert empty.count() == 0 and tuple(empty.columns) == NAMES


def test_only_conversations_left_without_turns(spark):
    ids = [c for c in range(21, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 > 1][:5]
    rows = spark.createDataFrame([(c, 0, "user", "gone") for c in ids], "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in _trie(rows).collect()] == [
        (ids[0], 0, None, 5, 0, 1, 0, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())]


def test_slots_are_minimal_and_verified():
    draw = np.random.default_rng(6)
    for n in (0, 1, 2, 17, 5000):
        a, b = draw.integers(-2**63, 2**63 - 1, (2, n))
        slots = prefix_trie.NodeSlots(a, b)
        found = slots.find(a, b)
        assert sorted(found.tolist()) == list(range(n)) and (slots.a[found] == a).all() and (slots.b[found] == b).all()
        assert (slots.find(a, b + 1) == -1).all() and (slots.find(a + 1, b) == -1).all()


def test_one_digest_for_two_prefixes_is_an_error():
    import pyarrow as pa
    one = {"conv_id": [1, 2], "depth": [1, 1], "p1": [5, 5], "p2": [6, 6], "q1": [0, 0], "q2": [0, 0], "words": [1, 1]}
    with pytest.raises(ValueError):
        prefix_trie._count_nodes(pa.table(one | {"t": ["x", "y"]}))
    assert prefix_trie._count_nodes(pa.table(one | {"t": ["x", "x"]})).num_rows == 1
