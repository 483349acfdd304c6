import random

from chainsift.llm.jaccard import links_and_components, near_duplicates

from .brute import jaccard_rows

SCHEMA = "doc_id long, text string"


def result(df):
    return {(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()}


def test_whole_table_matches_all_pairs(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(near_duplicates(documents)) == jaccard_rows(rows)


def test_crowd_of_near_copies_and_chains(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows, text = [], words[:]
    for i in range(120):  # each copy edits the base or the copy before it
        text = (words if i % 3 else text)[:]
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    rows += [(200 + i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 14)))) for i in range(150)]
    assert result(near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4))) == jaccard_rows(rows)


def test_edges_of_the_input(spark):
    text = "one two three four five six seven"
    rows = [(5, text), (5, text), (None, text.upper()), (3, ""), (3, None), (None, None), (8, "one two"), (7, "ONE\ttwo"), (9, "two one")]
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == sorted([(5, 3, 5), (5, 3, 5), (0, 3, 5), (3, 0, 3), (3, 0, 3), (0, 0, 0), (8, 1, 7), (7, 1, 7), (9, 1, 9)])
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    wide = spark.createDataFrame([(1, text, 1, 2, 3), (2, text, 1, 2, 3)], "doc_id long, text string, cid int, token int, n int")
    assert result(near_duplicates(wide)) == {(1, 3, 1), (2, 3, 1)}
    long = " ".join(str(i) for i in range(300_000))
    assert result(near_duplicates(spark.createDataFrame([(1, long), (2, long + " x"), (3, "z" * 700_000)], SCHEMA))) == {
        (1, 299_996, 1), (2, 299_997, 1), (3, 1, 3)}


def test_links_are_verified(spark):
    a = " ".join(f"w{i}" for i in range(40))
    b, c = a.replace("w39", "x"), a.replace("w20", "y").replace("w5 ", "z ")
    rows, links = links_and_components(spark.createDataFrame([(1, a), (2, b), (3, c), (4, c)], SCHEMA))
    assert links.count() == 1 and result(rows) == {(1, 36, 1), (2, 36, 1), (3, 36, 3), (4, 36, 3)}
