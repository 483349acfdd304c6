import re
from collections import Counter

import pytest

from chainsift.llm import pii
from chainsift.llm.pii import find, luhn, normalise, spans

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = []
    for kind, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            s, digits = m.group(), re.sub("[^0-9]", "", m.group())
            good = (True, all(int(x) <= 255 for x in s.split(".")) if kind == 1 else False, 13 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15)[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def test_base_spans(rng):
    pieces = ["a", "b.c", "@", "@@", ".", "x@y.zz", "x@y", "1", "22", "4111 1111 1111 1111", "+1 (017) 555-7713", "+", " ", "-", "10.0.0.1", "999.1.2.3", "007", "é", "4111111111111111"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert find(text) == brute(text), text


@pytest.mark.parametrize(("text", "kind", "part"), [
    ("mail jane.doe [at] example [dot] com now", "email", "jane.doe [at] example [dot] com"),
    ("write jane at example dot co dot uk.", "email", "jane at example dot co dot uk"),
    ("x jаne@example.com", "email", "jаne@example.com"),
    ("ｊane＠example．com!", "email", "ｊane＠example．com"),
    ("card four one 1 1 one one one one one one one one one one one one.", "card", "four one 1 1 one one one one one one one one one one one one"),
    ("call plus one two three four five six seven eight nine nine ok", "phone", "plus one two three four five six seven eight nine nine"),
    ("host 10 dot 0 dot 0 dot 1 up", "ip", "10 dot 0 dot 0 dot 1"),
    ("pin 4111​1111​1111​1111 x", "card", "4111​1111​1111​1111"),
    ("tel +٤٤ ٢٠ ٧٩٤٦ ٠٩٥٨", "phone", "+٤٤ ٢٠ ٧٩٤٦ ٠٩٥٨"),
])
def test_disguises(text, kind, part):
    base, added = spans(text)
    at = text.index(part)
    assert (pii.KINDS.index(kind), at, at + len(part)) in added
    assert all(x in find(text) for x in base)


def test_clean_texts_gain_nothing():
    for text in ("Look at this. A dot on the map, one two three steps.", "Nous sommes à l’école – très bien.", "one at home", "a (at) b", "Zürich 12 345", "ſix ſeven fİve two"):
        assert spans(text) == ([], [])


def test_offsets_compose():
    m = normalise("ａｂ​c one two [at] x")
    assert m.text == "abc 12@x" and [m.source(k) for k in range(len(m.text))] == [0, 1, 3, 4, 5, 9, 12, 18]


def test_long_texts_are_linear():
    for unit in ("1", "a", "@", "1.", "+1", "+1(", "one ", " dot", "(at"):
        spans(unit * (400_000 // len(unit)))


def test_rows(spark, documents):
    got = {r.row.doc_id: r for r in pii.find_personal_data(documents.select("doc_id", "text")).collect()}
    for r in documents.collect():
        base = brute(r.text)
        assert got[r.doc_id].base == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert [got[r.doc_id][f"n_{k}"] for k in pii.KINDS] == [sum(x == i for x, _, _ in base) for i in range(4)]
    odd = spark.createDataFrame([(None, None), (1, ""), (1, "x@y.zz"), (1, "x@y.zz")], "n_email long, text string")
    assert Counter((r.row.n_email, r.spans) for r in pii.find_personal_data(odd).collect()) == Counter([(None, ""), (1, ""), (1, "email:0:6"), (1, "email:0:6")])
    assert pii.find_personal_data(odd.limit(0)).count() == 0


@pytest.mark.parametrize("at", ["@", " @ ", "[at]", " [at] ", "(at)", " at ", " AT "])
@pytest.mark.parametrize("first", [".", "[dot]", " (dot) ", " dot ", " Dot "])
@pytest.mark.parametrize("second", ["", ".", " [dot] ", " dot "])
def test_mixed_disguises(at, first, second):
    address = f"jane{at}example{first}" + (f"co{second}uk" if second else "com")
    base, added = spans(f"Mail {address}, now")
    plain = at.strip().lower() == "at" and first == "." and second in ("", ".")  # "look at example.com" is no address
    assert ((0, 5, 5 + len(address)) in base + added) != plain


@pytest.mark.parametrize("word", ["𝐣𝐚𝐧𝐞@𝐞𝐱𝐚𝐦𝐩𝐥𝐞.𝐜𝐨𝐦", "ⓙⓐⓝⓔ@example.com", "𝓳𝓪𝓷𝓮 [𝓪𝓽] ⒺⓍⒶⓂⓅⓁⒺ dot 𝕔𝕠𝕞"])
def test_letters_in_other_forms(word):
    assert (0, 2, 2 + len(word)) in spans(f"x {word}")[1]


def test_signs_of_clean_texts():
    for text in ("5 apples @ 2.50 each", "look at example.com", "meet at noon. The dot is red", "a dot at b", "we are at school (room 4)", "x @ y"):
        assert spans(text) == ([], []), text
    for unit in ("@a dot ", " at a.", "a @ a.", "a at a (dot", "@a.a"):
        spans(unit * (400_000 // len(unit)))


LABELS = " dot ".join("abcdefghijklmnop")


@pytest.mark.parametrize(("address", "kind"), [
    (f"jane at {LABELS}", "email"), (f"jane@{LABELS}", "email"), ("jane    at    example   dot   com", "email"), ("jane\nat\nexample\ndot\ncom", "email"),
    ("jane [\n at\n ] example\n[dot]\ncom", "email"), ("jane dot doe at example dot com", "email"), ("jane dot a dot doe [at] example [dot] com", "email"),
    ("jane @ " + "a." * 20 + "com", "email"), (f"jane at {'x' * 80} dot com", "email"), ("one dot two dot three dot four", "ip"), ("10 dot one dot 0 point nine", "ip"),
    ("four   one,\n1 1 - one one one one one one one one one one one one", "card"), ("plus    one two three four five six seven eight nine nine", "phone"),
    ("ᴊᴀɴᴇ@example.com", "email"), ("jane@exаmple.сom", "email"), ("օscar@example.com", "email")])
def test_disguises_of_any_length_are_covered_whole(address, kind):
    assert (pii.KINDS.index(kind), 3, 3 + len(address)) in spans(f"X: {address}; y")[1]


def test_places_are_no_addresses():
    for text in ("look at google dot com", "We met at google dot com.", "Here it is at example [dot] com", "One. Two. Three. Four.", "write to me at noon dot"):
        assert spans(text) == ([], []), text
    text = "write to me at jane dot doe at example dot com"
    assert spans(text)[1] == [(0, text.index("jane"), len(text))]


def test_many_spans_and_long_runs_are_linear():
    import time

    def took(text):
        begin = time.perf_counter()
        spans(text)
        return time.perf_counter() - begin

    assert took("jane [at] example dot com, " * 40_000) < 5 * took("jane [at] example dot com, " * 10_000) + 2
    for unit in ("a dot ", " ", "a ", "[ ", "a at ", "a at a", "a @ ", "one dot ", "one ", "plus ", "\n", "a@a dot "):
        assert took(unit * (400_000 // len(unit))) < 10, unit
