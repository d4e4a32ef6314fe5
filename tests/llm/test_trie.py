import hashlib
import math
import random
import zlib
from collections import defaultdict

from fairlead.llm import trie
from fairlead.llm.common import table
from fairlead.llm.queries import QUERIES
from pyspark.sql import functions as F

TURNS = "conv_id long, turn long, role string, text string"


def nodes_of(turns):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    turns: (conv_id, rank, role, text), rank ordering the turns of a conversation.
    """
    talks = defaultdict(list)
    for conv, rank, role, text in turns:
        if conv is not None:
            talks[conv].append((rank, role or "", text or ""))
    talks = {c: [t[1:] for t in sorted(v)] for c, v in talks.items()}
    made = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = tuple(talks.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:])
    members = defaultdict(list)
    for c, talk in made.items():
        for d in range(len(talk) + 1):
            members[talk[:d]].append(c)
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        leaves[prefix] = sum(leaves[k] for k in children[prefix]) or 1
        own = (len(members[prefix]) - 1) * len(prefix[-1][1].encode()) if prefix else 0
        saved[prefix] = own + sum(saved[k] for k in children[prefix])
    out = []
    for prefix, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if made[c] == prefix)))
        parent = min(members[prefix[:-1]]) if prefix else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(who), len(prefix), parent, len(who), len(children[prefix]), leaves[prefix], saved[prefix], sha))
    return sorted(out, key=lambda r: r[:2])


def found(frame):
    return sorted(map(tuple, frame.collect()), key=lambda r: r[:2])


def test_whole_table(llm_spark, sf_dir):
    rows = [tuple(r) for r in table(llm_spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op11_conversation_trie"](llm_spark, sf_dir)) == nodes_of(rows)


def talks(seed):
    """Snapshots of growing talks, copies, talks that part late, long ones, ids without their base."""
    draw, rows = random.Random(seed), []

    def say(conv, words):
        rows.extend((conv, n, ("user", "assistant", None)[n % 3], w) for n, w in enumerate(words))

    long = [f"é{n}" for n in range(40)]
    for conv in range(0, 40):
        say(conv * 5, long[: conv + 1])
    for conv in range(200, 260):
        say(conv, ["same", "start"] + [draw.choice("xyz") for _ in range(draw.choice([0, 3, 9]))])
    for conv in range(300, 330):
        say(conv, ["copy", "of", "copies", "that", "all", "are", "alike", "and", "go", "on"])
    for conv in (401, 402, 407, -3, -5, 2**61 + 4):
        say(conv, [f"{conv}" if n > 5 else "shared" for n in range(draw.choice([1, 4, 12]))])
    return rows


def test_bursts(llm_spark):
    """Whatever the size at which containers burst, the nodes are the same."""
    rows = talks(1)
    turns = llm_spark.createDataFrame(rows, TURNS).withColumns({"size": F.lit(1), "place": F.lit("x"), "n": F.lit(None)})
    want = nodes_of(rows)
    for limit in (40, trie.BURST):
        assert found(trie.conversation_trie(turns, limit)) == want


def test_odd_turns(llm_spark):
    """Null numbers first, repeated rows kept, turns of one number by their hash, no id no conversation."""
    rows = [(0, None, "u", "first"), (0, 3, None, None), (0, 3, "", ""), (0, 1, "u", "日本"), (None, 1, "u", "lost")]
    rows += [(1, 1, "a", "x"), (1, 1, "a", "x"), (1, 2, "b", "y"), (6, 0, "c", "alone")]
    rows += [(1000, 7, r, t) for r in "ab" for t in ("one", "two", "")] + [(1001, n, "u", "w") for n in range(3)]
    frame = llm_spark.createDataFrame(rows, TURNS)
    texts = [F.coalesce(c, F.lit("")) for c in ("role", "text")]
    ranks = frame.select("conv_id", "turn", F.xxhash64(F.lit(1), *texts), F.xxhash64(F.lit(2), *texts), "role", "text").collect()
    want = nodes_of([(r[0], (r[1] is not None, r[1] or 0, r[2], r[3]), r[4], r[5]) for r in ranks])
    for limit in (4, 100):
        assert found(trie.conversation_trie(frame.repartition(7), limit)) == want
    assert trie.conversation_trie(frame.filter("conv_id is null")).count() == 0
    # A conversation that gives up all its turns to a base that is not there is in the root alone.
    lonely = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    assert found(trie.conversation_trie(llm_spark.createDataFrame([(lonely, 0, "u", "x")], TURNS))) == nodes_of([(lonely, 0, "u", "x")])


def test_long_conversation(llm_spark):
    """One conversation with most of the rows is spread by its places and sums along stretches."""
    rows = [(0, n, "u", f"t{n % 7}") for n in range(3 * trie.STRETCH)] + [(5, n, "u", f"t{n % 7}") for n in range(5000)]
    rows += [(10, n, "u", f"t{n % 7}" if n < 4500 else "off") for n in range(4600)]
    got = found(trie.conversation_trie(llm_spark.createDataFrame(rows, TURNS).repartition(8)))
    assert got == nodes_of(rows)
