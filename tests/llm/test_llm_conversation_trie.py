import hashlib
import math
import random
import re
import zlib

import pytest
from llm_cases import clashing, frame

from stallwise.llm import conversation_trie as T
from stallwise.llm.radix_tree import Tree

TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("letters, most", [(2, 12), (5, 4), (40, 3), (256, 2)])
def test_tree_holds_all_keys_and_grows(letters, most):
    pick = random.Random(letters)
    keys = {bytes(pick.randrange(letters) for _ in range(pick.randrange(most + 1))) for _ in range(2000)} | {b""}
    tree = Tree()
    for number, key in enumerate(keys):
        tree.place(key).value = number
    got, rooms = {}, set()

    def down(node, so_far):
        so_far += node.path
        rooms.add(node.room)
        assert node.size == len(list(node.items())) <= node.room
        assert node.key.startswith(so_far) and (node.size != 1 or node.value is not None or node is tree.root)
        if node.value is not None:
            got[so_far] = node.value
        for byte, child in node.items():
            assert node.child(byte) is child
            down(child, so_far + bytes([byte]))

    down(tree.root, b"")
    assert got == {key: number for number, key in enumerate(keys)}
    assert max(rooms) == {2: 4, 5: 16, 40: 48, 256: 256}[letters]
    assert len(list(tree.upward())) == len({id(n) for n, _, _ in tree.upward()})


def brute(turns, step=20, most=3):
    own = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, identity(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    full = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        # The remainder of a negative id has its sign.
        full[c] = tuple(own.get(c - int(math.fmod(c, step)), [])[:h] + ts[h:])
    members = {}
    for c, ts in full.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p, own_members in members.items():
        words = len(re.findall("[^\x20\x09-\x0d]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] = saved.get(p[:d], 0) + (len(own_members) - 1) * words
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in kids)
    ends = {p: ",".join(map(str, sorted(c for c in m if len(full[c]) == len(p)))) for p, m in members.items()}
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends[p].encode()).hexdigest())
        for p, m in members.items()
    )


def identity(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def got(turns, part_bytes=T.PART_BYTES):
    rows = T.trie(T.rebuilt(T.sequences(turns)), part_bytes).collect()
    return sorted(tuple(-1 if r[c] is None else r[c] for c in T.COLUMNS) for r in rows)


def some(seed, convs=120, kinds=3):
    pick = random.Random(seed)
    rows = []
    for c in range(convs):
        if c % 20 == 0 and c % 60:
            continue
        for t in range(pick.choice([1, 1, 2, 3, 6, 30 if c % 40 == 3 else 4])):
            rows.append((c, t, pick.choice(["user", "assistant"]), f"text {pick.randrange(kinds)} with words" if t < 5 else "again"))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("part_bytes", [T.PART_BYTES, 100])
def test_against_brute_force(spark, part_bytes):
    rows = some(1)
    assert got(frame(spark, rows, TURNS), part_bytes) == brute(rows)


def test_few_sequences_in_many_parts(spark):
    rows = [(c, t, "u", "same") for c in range(200) for t in range(12)] + [(c, 0, "u", "other") for c in range(200, 400)]
    assert got(frame(spark, rows, TURNS), 50) == brute(rows)


def test_defined_cases(spark):
    rows = some(2, 30) + [(None, 1, "u", "x"), (31, None, None, None), (31, 2, "u", ""), (31, 2, "u", ""), (31, 2, "", "u"), (-5, 0, "u", "x y " * 50_000)]
    rows += [(10**12, 1, "u", "a"), (10**12, 1, "u", "a")]
    frame_ = frame(spark, rows, TURNS)
    assert got(clashing(frame_).withColumnRenamed("digest", "ids")) == got(frame_) == brute(rows)
    assert got(frame(spark, [], TURNS)) == []
