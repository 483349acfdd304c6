"""Token counts, decontamination, fingerprints and sharding against plain versions."""

import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chainsift.llm import decontaminate, fingerprint, sharding, tokencount

from .brute import fold, sha

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "be", "t", "s", "'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", "1", "23", ".", "!!", "é", "中", "日本", "😀", "<|endoftext|>",
          "<|endof", "<|", "|>", "\xa0", "　", " the", "ing", "r", "l", "v"]


def library_counts(texts):
    return [len(e.ids) for e in Tokenizer.from_file(BYTE_BPE).encode_batch(texts, add_special_tokens=False)]


def test_transducer_and_state_maps(rng):
    m = tokencount.machine(BYTE_BPE, tokencount.character_kinds())
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    texts += ["a" * 3000 + "1" * 999 + "!" * 77 + " " * 50 + "ab" * 500, ""]
    expected = library_counts(texts)
    assert m.counts(texts).tolist() == expected
    for text, n in list(zip(texts, expected, strict=True))[:200]:
        cut = sorted(rng.randint(0, len(text)) for _ in range(3))
        a, b, c, d = m.state_maps([text[i:j] for i, j in zip([0, *cut], [*cut, len(text)], strict=True)])
        assert m.total(m.compose(m.compose(a, b), m.compose(c, d))) == n == m.total(m.compose(a, m.compose(m.compose(b, c), d)))
    m.clear()
    assert m.counts(texts[:50]).tolist() == expected[:50]


def test_token_counts(spark, documents):
    texts = documents.select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in texts.collect()]
    expected = Counter(zip((i for i, _ in rows), (len(t.encode()) for _, t in rows), library_counts([t for _, t in rows]), strict=True))
    for chunk in (1 << 16, 500):
        got = tokencount.token_counts(texts, BYTE_BPE, chunk=chunk).select("row.doc_id", "n_bytes", "n_tokens")
        assert Counter(map(tuple, got.collect())) == expected


@pytest.mark.parametrize("unit", ["1234567890 ", " ", "a", "中文字", "x9", "\n ", "-", "é!", "<|endof", "aé1"])
def test_state_maps_of_texts_without_landmarks(rng, unit):
    m = tokencount.machine(BYTE_BPE, tokencount.character_kinds())
    for lead in ("", "y", "yyy ", "12"):
        text = lead + unit * (20_011 // len(unit))
        whole, *others = m.state_maps([text[i : i + 1000] for i in range(0, len(text), 1000)])
        for other in others:
            whole = m.compose(whole, other)
        assert m.total(whole) == library_counts([text])[0]


@pytest.mark.parametrize("unit", ["1234567890 ", " ", "中文字漢語", "a"])
def test_long_texts_without_landmarks_are_linear(unit):
    m = tokencount.machine(BYTE_BPE, tokencount.character_kinds())
    took = []
    for size in (1 << 22, 1 << 24):
        text = unit * (size // len(unit))
        begin = time.perf_counter()
        maps = m.state_maps([text[i : i + tokencount.CHUNK] for i in range(0, len(text), tokencount.CHUNK)])
        took.append(time.perf_counter() - begin)
        assert max(map(len, maps)) <= 2 * tokencount.STARTS
    assert took[1] < 8 * took[0] + 2 and took[1] < 90


def test_token_counts_without_landmarks(spark):
    rng = random.Random(5)
    texts = ["12 345 6 " * 900, "a" * 7_003, " " * 5_001 + "x", "漢字仮名" * 1_500, "".join(rng.choice("abcdefgh") for _ in range(9_000)), "", "9" * 3_333 + " the end " * 200]
    rows = spark.createDataFrame([(k % 5, t) for k, t in enumerate(texts + texts[:2])], "doc_id long, text string")
    expected = Counter(zip((k % 5 for k in range(len(texts) + 2)), library_counts(texts + texts[:2]), strict=True))
    for chunk in (700, 64):  # 64: more rounds than allowed for some, which are run in one go
        got = tokencount.token_counts(rows, BYTE_BPE, chunk=chunk).collect()
        assert Counter((r.row.doc_id, r.n_tokens) for r in got) == expected


def test_token_counts_of_odd_rows(spark):
    odd = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "it's  <|endoftext|> it", 3), (1, "it's  <|endoftext|> it", 3)], "id long, text string, n_tokens int")
    got = sorted((r.row.n_tokens, r.n_bytes, r.n_tokens) for r in tokencount.token_counts(odd, BYTE_BPE, chunk=4).collect())
    n = library_counts(["it's  <|endoftext|> it"])[0]
    assert got == [(1, 0, 0), (2, 0, 0), (3, 22, n), (3, 22, n)]
    assert tokencount.token_counts(odd.limit(0), BYTE_BPE).count() == 0


def contamination(docs, items, size=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t or ""))
    known = [(i, tuple(w[k : k + n])) for i, t in items for w in [words(t)] for n in [min(size, len(w))] if n for k in range(len(w) - n + 1)]
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for i, x in known:
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit.update(range(k, k + len(x)))
                    found |= {str(i)} - {"None"}
        yield doc_id, len(w), len(hit), sorted(found)


ITEMS = [(1, "One two, three four five six seven eight nine ten eleven twelve"), (2, "Ölfass 7"), (10, "x y z"), (10, "p q"), (None, "lost words"), (5, None), (6, ""), (7, "x Y z")]
DOCS = [(1, "a ONE two three four; five six seven eight nine ten b"), (2, "three four five six seven eight nine ten eleven twelve"), (2, "ölfass 7 x y z y z"),
        (3, "ölfass"), (None, None), (4, ""), (5, "lost words, x\ny z"), (5, "lost words, x\ny z"), (6, "two three four five six seven eight nine ten")]


@pytest.mark.parametrize("limit", [1000, 0])
def test_decontamination(spark, limit):
    docs = spark.createDataFrame([(*d, 1) for d in DOCS], "doc_id long, text string, n_hit int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = Counter((r.row.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.scan(docs, items, broadcast_limit=limit).collect())
    assert got == Counter((*a, tuple(b)) for *a, b in contamination(DOCS, ITEMS))
    clean = decontaminate.decontaminate(docs, items, broadcast_limit=limit)
    assert clean.columns == docs.columns
    assert {r.text for r in clean.where("doc_id = 1 or doc_id = 6").collect()} == {"a  b", DOCS[-1][1]}
    assert decontaminate.decontaminate(docs, items, remove="documents").count() == 4
    assert decontaminate.scan(docs, items.limit(0)).where("n_hit > 0").count() == 0 == decontaminate.scan(docs.limit(0), items).count()


def test_fingerprints(spark, documents):
    rows = sorted(((r.doc_id, r.text) for r in documents.collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprint.compare_with_next(documents).collect()}
    assert len(got) == len(rows)
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half, r = len(text) // 2, got[i]
        edited = text[: len(text) - half] + after[:half]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (
            len(text), sha(edited), fingerprint.digest(text.encode()), fingerprint.digest(edited.encode()))
        assert r.near_next == fingerprint.likeness(r.fingerprint, fingerprint.digest(after.encode()))
    assert np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.8


def test_fingerprints_of_odd_rows(spark):
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "é" * 3), (2, "é" * 3)], "doc_id long, text string")
    got = fingerprint.compare_with_next(odd).collect()
    assert len(got) == 5 and len({r.fingerprint for r in got}) == 2
    assert fingerprint.compare_with_next(odd.limit(0)).count() == 0
    assert fingerprint.compare_with_next(odd.limit(1)).first().near_next == 1.0
    text = bytes(random.Random(1).randbytes(3 * fingerprint.BLOCK // 2))
    whole = fingerprint._triplets(np.frombuffer(text, np.uint8)).sum()
    assert whole == 3 * len(text) - 2 - 3 - 3


def test_sharding(spark, documents):
    keys = documents.select("doc_id", "text").repartition(5)
    for shards, bucket in ((8, 200_000), (7, 4)):
        got = sharding.shuffle_into_shards(keys, shards, bucket_rows=bucket).collect()
        sizes = Counter(r.shard for r in got)
        assert sorted(r.row.doc_id for r in got) == sorted(r.doc_id for r in documents.select("doc_id").collect())
        assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == shards
        for s, n in sizes.items():
            assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    assert sharding.shuffle_into_shards(keys.limit(0), 3).count() == 0
    assert {(r.shard is not None, r.slot) for r in sharding.shuffle_into_shards(spark.createDataFrame([(None, 1), (None, 1)], "shard int, slot int"), 8).collect()} == {(True, 0)}


def test_hypergeometric_law():
    rng = np.random.default_rng(0)
    draws = [sharding.split(rng, [30, 50, 20], 10) for _ in range(4000)]
    mean, var = np.mean(draws, axis=0), np.var(draws, axis=0)
    p = np.array([0.3, 0.5, 0.2])
    assert np.allclose(mean, 10 * p, atol=0.12) and np.allclose(var, 10 * p * (1 - p) * 90 / 99, atol=0.2)
    big = [sharding.hypergeometric(rng, 10**12, 7 * 10**12, 10**6) for _ in range(200)]
    assert abs(np.mean(big) - 125_000) < 120


def test_checksums(spark, sf_small):
    got = sharding.op5_sharding(spark, sf_small).collect()
    text = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    assert all((r.size, r.text_crc32) == (len(text[r.doc_id]) + 1, zlib.crc32(text[r.doc_id])) for r in got)
