import hashlib
import random
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from wardlake.llm import prefix_trie
from wardlake.llm.radix_tree import Node, insert

SCHEMA = "conv_id long, turn long, role string, text string, at string, n string, bytes string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def number(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, number(role, text), role, text))
    own = {conv: [t[3:] for t in sorted(turns)] for conv, turns in own.items()}
    whole = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        whole[conv] = (*own.get(conv - conv % 5, [])[:h], *turns[h:])
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in whole.items():
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
            if depth:
                children[turns[: depth - 1]].add(turns[:depth])
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        own_tokens = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own_tokens + sum(saved[c] for c in children[node])
        ends = ",".join(str(c) for c in sorted(members[node]) if len(whole[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append(
            (min(members[node]), len(node), parent, len(members[node]), len(children[node]), leaves[node], saved[node],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(frame.repartition(3)).select(*COLUMNS).collect()), key=str)


def test_equals_brute_force(spark):
    r = random.Random(5)
    words = ["a", "b", "é", "", None, "long " * 40]
    rows = [
        (conv, turn if turn or r.random() < 0.5 else None, r.choice(["user", "assistant", None]) if r.random() < 0.3 else "user", r.choice(words[:3]))
        for conv in range(60)
        for turn in range(r.choice([1, 2, 3, 5, 9, 15, 16, 17]))
    ]
    rows += [(conv, t, "u", w) for conv in (100, 105, 110, 1001) for t, w in enumerate(words)]
    rows += [(203, 0, "u", "x"), (None, 0, "u", "x"), (204, None, "u", "b"), (204, None, "u", "a"), (204, 1, "u", "c"), (204, 1, "u", "c")]
    assert found(spark, rows) == brute(rows)


def test_long_conversations_share_segments(spark):
    def long(conv, length, differs=()):
        return [(conv, t, "user", "other" if t in differs else f"t{t % 7}") for t in range(length)]

    rows = long(0, 16) + long(5, 17) + long(10, 160) + long(15, 160) + long(20, 161) + long(25, 100, {40})
    rows += long(30, 100, {16}) + long(35, 100, {15}) + long(40, 32) + long(45, 90, {40, 41}) + long(50, 0) + long(55, 700)
    assert found(spark, rows) == brute(rows)


def test_copies_and_turnless_conversations(spark):
    rows = [(5 * c, t, "u", "same") for c in range(300) for t in range(3)]
    rows += [(5 * c + 1, 0, "u", "alone") for c in range(400, 430)]
    expected = brute(rows)
    assert found(spark, rows) == expected and expected[0][1] == 0
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "u", "x")]) == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=6), unique=True, max_size=400), st.sets(st.integers(0, 255)))
def test_radix_tree_holds_its_strings_in_order(keys, firsts):
    keys = sorted({*keys, *(bytes([b]) + b"tail" for b in firsts), *(bytes([7, b]) for b in firsts)})
    tree, order = Node(), keys[:]
    random.Random(len(keys)).shuffle(order)
    for key in order:
        insert(tree, key, key)
    seen, layouts = [], set()

    def walk(node, before):
        string = before + node.path
        if node.value is not None:
            assert node.value == string
            seen.append(string)
        children = list(node.by_byte())
        # Layouts are as small as their children allow, and no path could be joined with its only child's.
        assert len(children) <= node.layout and (len(children) != 1 or node.value is not None or node is tree)
        layouts.add(node.layout)
        for byte, below in children:
            assert node.child(byte) is below
            walk(below, string + bytes([byte]))

    walk(tree, b"")
    assert seen == keys
    if len(firsts) > 48:
        assert 256 in layouts
