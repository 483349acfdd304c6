import hashlib
import random
import re
import zlib

import pytest

from chainsift.llm import trie as M


def brute(rows):
    """{node row} of ``(conv_id, turn, role, text)`` rows, by every prefix of every conversation."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role, hashlib.md5(text.encode()).hexdigest(), text))
    convs = {c: [(role, text) for _, role, _, text in sorted(x)] for c, x in convs.items()}
    whole = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(convs.get(c - int(abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + turns[h:])
    nodes = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    kids = {k: 0 for k in nodes}
    for k in nodes:
        if k:
            kids[k[:-1]] += 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for k, members in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += (len(members) - 1) * words
    out = set()
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(whole[c]) == len(k))
        out.add((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), kids[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def made(seed, n=90):
    rng = random.Random(seed)
    texts = ["", "hello there", "a\tb\nc", "Ünï code", None, "one"]
    rows = []
    for c in rng.sample(range(0, 140), n):
        for turn in range(rng.choice([1, 2, 3, 5, 9, 17, 30])):
            rows.append((c, turn, rng.choice(["user", "user", None]), texts[rng.randrange(2 if turn < 20 else len(texts))]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = made(seed)
    rows += [(7, None, "user", "first"), (7, None, "user", "first"), (7, 0, "a", "tie"), (7, 0, "b", "tie"), (None, 1, "user", "no id"), (-3, 0, "user", "below"), (-20, 1, None, None), (500, 0, "user", "alone")]
    got = M.prefix_trie(spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, p1 string, depth int"))
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_a_long_conversation_and_its_copies(spark):
    long = [(i, "user", f"turn {i} of it") for i in range(300)]
    rows = [(c, *t) for c in (20, 40, 60) for t in long] + [(60, 300, "user", "more")]
    got = {tuple(r) for r in M.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == brute(rows)


def test_very_long_text_and_empty_table(spark):
    rows = [(20, 0, "user", "word " * 400_000), (40, 0, "user", "word " * 400_000)]
    got = {tuple(r) for r in M.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == brute(rows)
    assert M.prefix_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_ends_are_streamed_in_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(M, "PIECE_IDS", 3)
    ids = [1, 2, 5, 8, 9, 20, 21, 4]
    batch = pa.RecordBatch.from_pydict({"depth": [1] * 7 + [2], "x1": [5] * 8, "x2": [6] * 8, "conv_id": ids})
    out = [r for b in M._digests(M._joined(iter([batch]))) for r in b.to_pylist()]
    assert [r["ends_sha256"] for r in out] == [hashlib.sha256(b"1,2,5,8,9,20,21").hexdigest(), hashlib.sha256(b"4").hexdigest()]
