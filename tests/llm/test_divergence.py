import random
import re

import numpy as np
import pyarrow as pa
import pytest

from chainsift.llm import divergence as M

from .brute import fold


def brute(rows, min_docs=10, top=10):
    """{(lang, source, part, item, value, rank)} of ``(text, lang, source)`` rows, in whole numbers of any size."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", fold(text or ""))) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = {}
        for _, _, words in own:
            for w in set(words):
                seen[w] = seen.get(w, 0) + 1
        kept = sorted(w for w in seen if seen[w] >= min_docs)

        def prices(part):
            words = [w for d in part for w in d[2]]
            counts = {w: words.count(w) for w in kept}
            n = sum(counts.values())
            return counts, {w: 1 + 1_000_000_000 * (counts[w] + 2) // (n + 2 * len(kept)) for w in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        groups = {s: prices([d for d in own if d[1] == s]) for s in {d[1] for d in own}}
        _, whole = prices(own)
        for s, (counts, p) in groups.items():
            pairs = [(sum(f(p[w], q[w]) for w in kept), t) for t, (_, q) in groups.items() if t != s]
            terms = [(f(p[w], whole[w]), w) for w in kept if counts[w] and p[w] > whole[w]]
            for part, found in (("pair", pairs), ("term", terms)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ordered) if part == "pair" or i < top}
    return out


def made(seed, n=160):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdeéß" for b in ("", "x", "Y", "ΩΩ", "n")]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words[: 4 + i % len(words)]) + rng.choice(["", ",", "9", "\n"]) for _ in range(rng.randrange(0, 30)))
        rows.append((text, rng.choice(["en", "de", "zz", None]), rng.choice(["s0", "s0", "s1", "s2", "é", "Z", None])))
    return rows + [(None, "en", "empty"), ("", "xx", "one"), ("rare words only", "xx", "two"), (rows[0][0], "en", "s0")] * 2


@pytest.mark.parametrize("tile, block", [(32, 16_384), (2, 3)])
def test_equals_brute_force(spark, monkeypatch, tile, block):
    monkeypatch.setattr(M, "TILE_GROUPS", tile)
    monkeypatch.setattr(M, "BLOCK_TERMS", block)
    rows = made(tile)
    docs = spark.createDataFrame([(*r, i, "x") for i, r in enumerate(rows)], "text string, lang string, source string, term int, n string")
    assert {tuple(r) for r in M.divergence(docs, min_docs=5, top=3).collect()} == brute(rows, 5, 3)


def test_languages_that_differ_in_a_trailing_nul(spark):
    rows = made(3, 240)
    rows = [(text, (lang or "") + "\x00" * (i % 3), source) for i, (text, lang, source) in enumerate(rows)]
    got = M.divergence(spark.createDataFrame(rows, "text string, lang string, source string"), min_docs=5, top=3).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(rows, 5, 3))


def test_tiles_without_a_group(spark, monkeypatch):
    monkeypatch.setattr(M, "TILE_GROUPS", 1)  # as many tiles as sources: some get none
    rows = [(text, "en", f"s{i % 9}") for i, (text, _, _) in enumerate(made(4, 120))]
    got = M.divergence(spark.createDataFrame(rows, "text string, lang string, source string"), min_docs=5, top=3).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(rows, 5, 3))


def test_empty_table(spark):
    assert M.divergence(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


def test_a_very_long_text_counts_as_one_document(monkeypatch):
    monkeypatch.setattr(M, "PIECE_BYTES", 64)
    text = "Ab cd, " * 50 + "e" * 300 + " ab " + "Ü" * 40
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "source": ["s"], "text": [text]})
    (out,) = M._count(iter([batch]))
    got = {(r["term"], r["docs"], r["counts"][0]) for r in out.to_pylist()}
    assert got == {("ab", 1, 51), ("cd", 1, 50), ("e" * 300, 1, 1), ("Ü" * 40, 1, 1)}


def test_galloping_finds_the_places(rng):
    for few, many in ((0, 5), (7, 3000), (2000, 2500), (600, 40_000)):
        a = np.array(sorted(rng.sample(range(50_000), few)), np.int64)
        b = np.array(sorted(rng.sample(range(50_000), many)), np.int64)
        assert np.array_equal(M.gallop(a, b), np.searchsorted(b, a))


def test_counts_beyond_a_product_of_64_bits_stay_exact():
    part, whole = np.array([2, 10**13, 8 * 10**15]), 9 * 10**15
    assert M._scaled(part, whole).tolist() == [1 + 1_000_000_000 * int(x) // whole for x in part]
