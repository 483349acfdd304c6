from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from chainsift.llm import bpe

from .brute import sha

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = ["Hello  World's it'S 123 <|endoftext|> ÉTÉ é İx", "a<|startoftext|>b  ", "  ", "!!'s don't ''ll", "\x00 x", "ﬁ ½ 中 😀 é", "a\xa0b　c",
       "࢏՘ x", None, "", "z" * 5000]


def library(texts):
    t = Tokenizer.from_file(WORD_BPE)
    ids = [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    return [(i, t.decode(i, skip_special_tokens=False)) for i in ids]


def test_numbers_round_trip():
    n = np.array([0, 1, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 5])
    data, at = bpe.pack(n)
    assert bpe.unpack(data).tolist() == n.tolist() and at[-1] == len(data)
    assert bpe.unpack(bpe.pack(n[:0])[0]).tolist() == []


def test_ids_and_decoded_texts(spark):
    rows = [(k if k else None, t, 1) for k, t in enumerate(ODD)] + [(3, ODD[3], 1)]
    docs = spark.createDataFrame(rows, "word long, text string, place int").repartition(3)
    got = Counter((r.row.word, tuple(r.ids), r.decoded) for r in bpe.encode(docs, WORD_BPE).collect())
    assert got == Counter((i, tuple(a), b) for (i, _, _), (a, b) in zip(rows, library([t for _, t, _ in rows]), strict=True))
    assert bpe.encode(docs.limit(0), WORD_BPE).count() == 0
    ids = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(library(ODD))], "k int, ids array<int>")
    again = bpe.decode(ids, bpe.vocabulary(spark, WORD_BPE), "k").collect()
    assert {r.k: r.decoded for r in again} == {k: b for k, (_, b) in enumerate(library(ODD))}


def test_whole_table(spark, documents):
    docs = documents.select("doc_id", "text")
    rows = docs.collect()
    expected = {(r.doc_id, len(i), sha(np.array(i, "<u4").tobytes()), sha(t)) for r, (i, t) in zip(rows, library([r.text for r in rows]), strict=True)}
    got = bpe.encode_digests(docs, WORD_BPE).select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert set(map(tuple, got.collect())) == expected
