import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillmark.llm import pii

SCHEMA = "doc_id long, text string, spans string, row int, n_email string"


def naive(text):
    """The base spans by plain regular expressions."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m.group())
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def base(text):
    return [(s["kind"], s["start"], s["stop"]) for s in pii.find(text) if s["base"]]


def added(text):
    return [(s["kind"], text[s["start"]:s["stop"]]) for s in pii.find(text) if not s["base"]]


@given(st.text(alphabet="0123456789.+-@ ()aZ_é\n", max_size=80))
@settings(max_examples=400, deadline=None)
def test_base_spans_equal_the_plain_search(text):
    assert base(text) == naive(text)


@given(st.lists(st.sampled_from([
    "4111 1111 1111 1111", "378282246310005", "+49 (30) 123-4567", "10.0.0.255", "1.2.3.4.5.6.7.8",
    "a@b.c", "x.y+z@d-e.f.g", " ", ".", "@", "+", "-", "é", "999.1.1.1", "4222222222222", "+1",
]), max_size=12))
@settings(max_examples=300, deadline=None)
def test_base_spans_of_joined_parts(parts):
    text = "".join(parts)
    assert base(text) == naive(text)


@pytest.mark.parametrize("text,expected", [
    ("write to jane [at] example [dot] org now", [("email", "jane [at] example [dot] org")]),
    ("jane(at)example.org", [("email", "jane(at)example.org")]),
    ("mail jane.doe at mail dot example dot com, please", [("email", "jane.doe at mail dot example dot com")]),
    ("jane＠example．org", [("email", "jane＠example．org")]),
    ("jаne@exаmple.org", [("email", "jаne@exаmple.org")]),  # Cyrillic a
    ("ja​ne@exa​mple.org", [("email", "ja​ne@exa​mple.org")]),
    ("call plus four nine three zero one two three four five six", [
        ("phone", "plus four nine three zero one two three four five six")]),
    ("call +49 one five one two three four five six", [("phone", "+49 one five one two three four five six")]),
    ("host 10 dot 0 dot 0 dot 1 is up", [("ip", "10 dot 0 dot 0 dot 1")]),
    ("１０．０．０．１", [("ip", "１０．０．０．１")]),
    ("four one one one one one one one one one one one one one one one", [
        ("card", "four one one one one one one one one one one one one one one one")]),
    ("٤١١١١١١١١١١١١١١١", [("card", "٤١١١١١١١١١١١١١١١")]),
])
def test_disguises_are_found_in_place(text, expected):
    assert added(text) == expected


@pytest.mark.parametrize("text", [
    "", "Look at this dot on the map.", "We met at noon. Dot was late.", "one two three",
    "the one at the top", "Été à la plage – 12 €", "see [at] the end", "three or four, five, six",
    "Он сказал: привет", "1 2 3 4 5", "version 1.2.3", "a (dot) b", "visit us at example.com today", "room 101 at 5 dot 30",
])
def test_clean_prose_is_left_alone(text):
    assert pii.find(text) == []


def test_base_spans_stay_beside_added_ones():
    text = "a@b.example and c [at] d [dot] org"
    assert base(text) == naive(text) == [("email", 0, 11)]
    assert added(text) == [("email", "c [at] d [dot] org")]


@pytest.mark.parametrize("text,expected", [
    ("ask john dot doe at example dot com now", [("email", "john dot doe at example dot com")]),
    ("a dot b dot c at d dot e dot org", [("email", "a dot b dot c at d dot e dot org")]),
    ("john dot doe [at] example [dot] com", [("email", "john dot doe [at] example [dot] com")]),
    ("x at y dot org z dot w at v dot net", [("email", "x at y dot org"), ("email", "z dot w at v dot net")]),
    ("jane@mail.example [dot] com", [("email", "jane@mail.example [dot] com")]),
    ("plus quatre neuf trois zéro un deux trois quatre cinq six", [
        ("phone", "plus quatre neuf trois zéro un deux trois quatre cinq six")]),
    ("plus vier neun drei null eins zwei drei vier FÜNF sechs", [
        ("phone", "plus vier neun drei null eins zwei drei vier FÜNF sechs")]),
    ("más cuatro nueve tres cero uno dos tres cuatro cinco seis", [
        ("phone", "más cuatro nueve tres cero uno dos tres cuatro cinco seis")]),
    ("jane at mail dot example", [("email", "jane at mail dot example")]),
])
def test_disguises_are_found_whole(text, expected):
    assert added(text) == expected
    assert base(text) == naive(text)
    assert pii.redacted(expected[0][1], pii.find(expected[0][1])) == f"[{expected[0][0].upper()}]"


@given(st.text(max_size=60), st.data())
@settings(max_examples=200, deadline=None)
def test_rewritten_places_map_back(text, data):
    cuts = sorted(data.draw(st.lists(st.integers(0, len(text)), max_size=8, unique=True)))
    edits = [(a, b, data.draw(st.text(max_size=3))) for a, b in zip(cuts[::2], cuts[1::2])]
    new = pii.Rewritten(text, edits)
    expected, at, source = "", 0, []
    for a, b, content in edits:
        source += [(i, i + 1) for i in range(at, a)] + [(a, b)] * len(content)
        expected, at = expected + text[at:a] + content, b
    source += [(i, i + 1) for i in range(at, len(text))]
    assert new.text == expected + text[at:]
    for i, place in enumerate(source):
        assert new.back(i, i + 1) == place
    if source:
        assert new.back(0, len(source)) == (source[0][0], source[-1][1])


@pytest.mark.parametrize("text", [
    "a" * 300000, "1" * 300000, "1.1" * 100000, "+1" + " " * 300000, "a@" * 100000, "one " * 60000,
    "@a." * 100000, "1 " * 150000, "[at]" * 60000, "＠" * 100000, " dot a" * 50000, "+1 " * 90000,
    "a at b" * 40000,
])
def test_time_is_linear(text):
    start = time.process_time()
    pii.find(text)
    assert time.process_time() - start < 6


def test_redaction():
    text = "a@b.c, +1 234 567 8901 and 10.0.0.1"
    assert pii.redacted(text, pii.find(text)) == "[EMAIL], [PHONE] and [IP]"
    assert pii.redacted("nothing", []) == "nothing"


ROWS = [
    (1, "x a@b.c é 10.0.0.1"), (2, None), (3, ""), (None, "+1 234 567 8901"), (4, "no data"),
    (5, "j [at] e [dot] org, a@b.c"), (5, "j [at] e [dot] org, a@b.c"), (6, "w " * 100000 + "a@b.c"),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1, "n") for i, t in rows], SCHEMA).repartition(2)


def test_report(spark):
    found = pii.report(frame(spark, ROWS))
    got = sorted(map(tuple, found.collect()), key=repr)
    expected = []
    for i, t in ROWS:
        spans = naive(t or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        every = pii.find(t or "")
        expected.append((
            i, *(sum(s[0] == k for s in spans) for k in pii.KINDS),
            hashlib.sha256(joined.encode()).hexdigest(),
            ",".join(f"{s['kind']}:{s['start']}:{s['stop']}" for s in every), len(every) - len(spans),
        ))
    assert got == sorted(expected, key=repr)
    assert found.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
                             "spans", "n_added"]


def test_redact_keeps_columns(spark):
    df = frame(spark, ROWS)
    found = pii.redact(df)
    assert found.columns == df.columns
    texts = {r.doc_id: r.text for r in found.collect()}
    assert texts[1] == "x [EMAIL] é [IP]" and texts[2] is None and texts[3] == ""
    assert texts[5] == "[EMAIL], [EMAIL]" and texts[4] == "no data"


def test_empty_table(spark):
    assert pii.report(frame(spark, [])).collect() == []


def test_the_cheap_look_at_spelled_digits_loses_no_run():
    import random

    draw = random.Random(1)
    words = [*pii.DIGIT_WORDS, *pii.PLUS_WORDS, "ſix", "prose", "5", "77", "+", "(one", "two.", "three)", "Six",
             "FÜNF"]
    for _ in range(20000):
        text = "".join(
            draw.choice(words) + draw.choice([" ", " ", ", ", "-", " - ", "\n", ".", "  ", ""])
            for _ in range(draw.randint(1, 9))
        )
        if any(
            sum(t.group().lower().replace("ſ", "s") in pii.DIGIT_WORDS for t in pii._TOKEN.finditer(run.group()))
            >= pii.LEAST_SPELLED for run in pii._SPELLED.finditer(text)
        ):
            assert pii._may_be_spelled(text), text
