"""The conversation trie against a dictionary of prefixes."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import conversation_trie
from tidemark.llm.conversation_trie import Parentheses

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, part int"


def rebuilt(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn, role or "", text or ""))

    def order(t):
        content = f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()
        return (t[0] is not None, t[0] or 0, hashlib.sha256(content).hexdigest())

    turns = {c: [t[1:] for t in sorted(ts, key=order)] for c, ts in own.items()}
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        out[c] = turns.get(base, [])[:h] + turns[c][h:]
    return out


def brute(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
        saved[path] = own + sum(saved[c] for c in children[path])
        ends = ",".join(str(c) for c in sorted(members[path]) if len(conversations[c]) == len(path))
        above = min(members[path[:-1]]) if path else None
        out.append(
            (min(members[path]), len(path), above, len(members[path]), len(children[path]), leaves[path], saved[path],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def found(frame, shard_turns=conversation_trie.SHARD_TURNS):
    return sorted(map(tuple, conversation_trie.trie(conversation_trie.forked(frame), shard_turns).collect()), key=repr)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "mine", 3) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("shard_turns", [conversation_trie.SHARD_TURNS, 20, 1])
def test_test_table(tables, shard_turns):
    frame = tables("conversations")
    rows = [tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()]
    assert found(frame, shard_turns) == brute(rebuilt(rows))


AWKWARD = [
    (0, 0, "user", "hello"), (0, 1, "assistant", "é" * 50), (0, None, "system", None),
    (1, 0, "user", "hello"), (1, 1, "assistant", "é" * 50), (1, 2, None, None),
    (2, 0, None, ""), (2, 0, "", None), (2, 0, "user", "tie b"), (2, 0, "user", "tie a"),  # equal numbers
    (3, 5, "user", "x" * 300_000), (3, 5, "user", "x" * 300_000),  # long, repeated
    (None, 0, "user", "nobody"), (None, None, None, None),
    (7, 0, "user", "base absent"), (8, None, None, None), (-3, 0, "user", "negative"), (-5, 0, "user", "base"),
    (4, 0, "use", "rhello"), (9223372036854775807, 1, "user", "largest"),
]


@pytest.mark.parametrize("shard_turns", [conversation_trie.SHARD_TURNS, 3])
def test_awkward_rows(spark, shard_turns):
    assert found(conversations(spark, AWKWARD), shard_turns) == brute(rebuilt(AWKWARD))


def test_no_conversation_makes_no_node(spark):
    assert found(conversations(spark, [])) == []
    assert found(conversations(spark, [(None, 1, "user", "a")])) == []


def test_many_equal_conversations_and_a_deep_one(spark):
    """Copies hold half of the rows and spread over shards; their ids are hashed in order across them."""
    rows = [(i, t, "user", f"turn {t}") for i in range(0, 2000) for t in range(3)]
    rows += [(100_000 + 5 * i, t, "user", f"own {i % 7} {t}") for i in range(50) for t in range(4)]
    rows += [(200_000, t, "user", f"deep {t}") for t in range(3000)]
    frame = conversations(spark, rows)
    want = brute(rebuilt(rows))
    assert found(frame) == want
    assert found(frame, 100) == want


def test_turnless_conversations_are_members_of_the_root(spark):
    # ids whose own turns all fall to a base that is absent
    ids = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0][:20]
    rows = [(c, 0, "user", str(c)) for c in ids]
    out = found(conversations(spark, rows))
    assert out == brute(rebuilt(rows)) and out[0][3] == 20 and len(out) == 1


def test_other_sequences_than_forked_ones(spark):
    """The trie takes any table of sequences; without forking the conversations are what they are."""
    rows = [(i, t, "user", f"{(i * t) % 3}") for i in range(40) for t in range(5)]
    plain = conversation_trie.sequences(conversations(spark, rows)).select("conv_id", "turns")
    turns = {i: [("user", f"{(i * t) % 3}") for t in range(5)] for i in range(40)}
    assert sorted(map(tuple, conversation_trie.trie(plain, 17).collect()), key=repr) == brute(turns)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=900))
def test_findclose(steps):
    bits, depth = [1], 1
    for step in steps:  # any balanced string: mostly opening, so that subtrees span blocks
        if step and depth < 10_000:
            bits.append(1)
            depth += 1
        elif depth > 1:
            bits.append(0)
            depth -= 1
    bits += [0] * depth
    stack, want = [], {}
    for i, bit in enumerate(bits):
        if bit:
            stack.append(i)
        else:
            want[stack.pop()] = i
    tree = Parentheses(np.array(bits))
    at = np.flatnonzero(tree.opening)
    assert tree.findclose(at).tolist() == [want[i] for i in at]
    pairs = [i for i in range(len(bits) - 1) if bits[i] and not bits[i + 1]]
    assert tree.leaves[-1] == len(pairs)
