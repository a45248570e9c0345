"""The prefix trie against a trie of plain Python tuples."""

import hashlib
import random
import zlib

import pytest

from tallyspan.llm import prefix_trie, skewed


def ordered(rows):
    """conv -> its (role, text) turns, tied turns by digest."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn, role or "", text or ""))
    key = lambda t: (t[0] is not None, t[0] or 0, hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest())
    return {c: [t[1:] for t in sorted(ts, key=key)] for c, ts in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + turns[h:]
    return out


def trie(convs):
    members = {}
    for c, turns in convs.items():
        prefix = hashlib.sha256()
        path = [prefix.digest()]
        for role, text in turns:
            prefix.update(f"{len(role)}:{len(text)}:{role}{text}".encode())
            path.append(prefix.digest())
        for d, key in enumerate(path):
            members.setdefault((d, key), []).append((c, path[d - 1] if d else None))
    nodes = {k: {"all": sorted(c for c, _ in m), "up": (k[0] - 1, m[0][1]) if k[0] else None} for k, m in members.items()}
    for (d, _), node in nodes.items():
        face = node["all"][0]
        text = convs[face][d - 1][1] if d else ""
        node |= {"kids": 0, "leaves": 0, "saved": (len(node["all"]) - 1) * len(text.encode())}
    for k in sorted(nodes, key=lambda k: -k[0]):
        node = nodes[k]
        node["leaves"] = node["leaves"] or 1
        if node["up"]:
            up = nodes[node["up"]]
            up["kids"] += 1
            up["leaves"] += node["leaves"]
            up["saved"] += node["saved"]
    out = []
    for (d, _), node in nodes.items():
        ends = ",".join(str(c) for c in node["all"] if len(convs[c]) == d)
        parent = nodes[node["up"]]["all"][0] if node["up"] else None
        out.append((node["all"][0], d, parent, len(node["all"]), node["kids"], node["leaves"], node["saved"], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows, parts=3):
    schema = "conv_id long, turn long, role string, text string, face int, depth string"
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], schema).repartition(parts)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


ODD = [
    (0, 0, "user", "hello"), (0, 1, "assistant", "yes"), (0, None, None, None), (1, 0, "user", "hello"), (1, 0, "user", "hello"),
    (2, 3, "user", "x"), (2, 1, "user", None), (2, 1, None, "user"), (3, None, "a", "b"), (3, None, "ab", ""), (7, 0, "user", "hello"),
    (7, 1, "assistant", "yes é😀"), (8, 0, "user", "hello"), (8, 1, "assistant", "yes é😀"), (11, 5, "user", "only one"), (12, 0, "", ""),
    (None, 0, "user", "nobody's"), (4999, 0, "user", "long " * 40_000), (5001, 0, "user", "long " * 40_000), (10, 0, "user", "hello"),
]


@pytest.mark.parametrize("rebuild", [False, True])
def test_odd_rows(spark, rebuild):
    df = frame(spark, ODD)
    got = prefix_trie.rebuilt_trie(df) if rebuild else prefix_trie.prefix_trie(df)
    convs = ordered(ODD)
    assert rows_of(got) == trie(rebuilt(convs) if rebuild else convs)


def test_turnless_conversations(spark):
    """Conversations that give up their only turns and get none end at the root."""
    none_left = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2][:6]
    rows = [(c, k, "user", f"{c} {k}") for c in none_left for k in range(2)]
    got = rows_of(prefix_trie.rebuilt_trie(frame(spark, rows)))
    assert got == trie(rebuilt(ordered(rows))) and len(got) == 1 and got[0][3] == 6


def test_empty_table(spark):
    assert rows_of(prefix_trie.rebuilt_trie(frame(spark, []))) == []
    assert rows_of(prefix_trie.rebuilt_trie(frame(spark, [(None, 1, "user", "x")]))) == []


@pytest.mark.parametrize("block, bits, share", [(4, 1, 2), (7, 2, 1), (1 << 12, 12, 1024)])
def test_one_conversation_of_a_third_of_all_rows(spark, monkeypatch, block, bits, share):
    """A very long conversation, its truncated and branching copies, a hot first turn; blocks, pieces and the share
    of broadcast keys are made small enough to matter."""
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "PIECE_BITS", bits)
    monkeypatch.setattr(skewed, "SHARE", share)
    random.seed(block)
    long = [("user", f"t{k % 7}") for k in range(90)]
    convs = {50: long, 51: long[:60], 53: long[:30] + [("user", "else")] * 25, 57: long[:4]}
    for c in range(100, 160):
        convs[c] = [("user", "hi")] + [(random.choice(("user", "assistant")), random.choice("ab")) for _ in range(random.randrange(4))]
    rows = [(c, k, *t) for c, turns in convs.items() for k, t in enumerate(turns)]
    random.shuffle(rows)
    assert rows_of(prefix_trie.prefix_trie(frame(spark, rows, 5))) == trie(convs)
    assert rows_of(prefix_trie.rebuilt_trie(frame(spark, rows, 5))) == trie(rebuilt(convs))


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    """A path of 300 nodes is settled in at most log2 of its weight rounds."""
    rounds = []
    split = prefix_trie._split
    monkeypatch.setattr(prefix_trie, "_split", lambda *a: rounds.append(1) or split(*a))
    rows = [(1, k, "user", str(k)) for k in range(300)]
    assert rows_of(prefix_trie.prefix_trie(frame(spark, rows))) == trie(ordered(rows))
    assert len(rounds) <= (301).bit_length()


def test_sums_of_any_measure(spark):
    rows = [(c, k, "user", str(c // (8 >> k))) for c in range(40) for k in range(4)]
    nodes, walks = prefix_trie.build_trie(*prefix_trie.ordered_turns(frame(spark, rows)))
    sums = prefix_trie.subtree_sums(nodes, walks, ["n_convs", "n_bytes"])
    # the number of walk rows in a subtree is the weight that the walks gave without a rollup
    assert sorted(sums.select("face", "depth", "n_convs").collect()) == sorted(nodes.select("face", "depth", "weight").collect())
