import random
import re
import time

import pytest
from hypothesis import given
from hypothesis import strategies as st

from lexmill.llm import pii

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    found += [("ip", *m.span()) for m in re.finditer(IP, text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", *m.span()) for m in re.finditer(CARD, text) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return found + [("phone", *m.span()) for m in re.finditer(PHONE, text) if 9 <= len(digits(m)) <= 15]


@given(st.text(st.sampled_from("ab@.-+0123456789 ()é_"), max_size=60))
def test_base_equals_the_plain_patterns(text):
    assert pii.detect(text) == plain(text)


def test_base_on_chosen_texts():
    text = "x a.b+c@d-e.f.g, 4111 1111 1111 1111; 1.2.3.4.5 and 001.0.0.255 +1 (555) 555-0199 a@b.c@d.e 4111-1111-1111-1112"
    assert pii.detect(text) == plain(text)


@pytest.mark.parametrize(
    ("text", "kind", "part"),
    [
        ("write to jane.doe (at) example (dot) org today", "email", "jane.doe (at) example (dot) org"),
        ("write to jane [at] mail.example.org", "email", "jane [at] mail.example.org"),
        ("mail jane dot doe at example dot co dot uk please", "email", "jane dot doe at example dot co dot uk"),
        ("mail jane@example dot com.", "email", "jane@example dot com"),
        ("mail jane @ example . com now", "email", "jane @ example . com"),
        ("mail jаne@exаmple.cоm now", "email", "jаne@exаmple.cоm"),
        ("mail jane＠example．com now", "email", "jane＠example．com"),
        ("call plus one five five five two three four five six seven eight", "phone", "plus one five five five two three four five six seven eight"),
        ("call ＋１ ５５５ ２３４ ５６７８ ok", "phone", "＋１ ５５５ ２３４ ５６７８"),
        ("card four one one one one one one one one one one one one one one one end", "card", "four one one one one one one one one one one one one one one one"),
        ("card 4l11 1111 1111 1ll1 end", "card", "4l11 1111 1111 1ll1"),
        ("card 4111​1111​1111​1111 end", "card", "4111​1111​1111​1111"),
        ("host one nine two dot one six eight dot zero dot one up", "ip", "one nine two dot one six eight dot zero dot one"),
        ("host 192 dot 168 dot 0 dot 1 up", "ip", "192 dot 168 dot 0 dot 1"),
        ("mail jоhn@example.com now", "email", "jоhn@example.com"),
        ("mail john@example.cоm now", "email", "john@example.cоm"),
        ("mail john AT example DOT com now", "email", "john AT example DOT com"),
        ("call +1 five five five 0199 two two ok", "phone", "+1 five five five 0199 two two"),
        ("host 192[.]168[.]0[.]1 up", "ip", "192[.]168[.]0[.]1"),
        ("ask jane.doe at example.com about it", "email", "jane.doe at example.com"),
        ("call +1 five 552 340 199 ok", "phone", "+1 five 552 340 199"),
        ("card 4111 1111 1111 111 one end", "card", "4111 1111 1111 111 one"),
    ],
)
def test_disguised(text, kind, part):
    base, spans = pii.find(text)
    assert (kind, text.index(part), text.index(part) + len(part)) in spans


@pytest.mark.parametrize("text", ["", "meet me at example.com", "one, two and three", "at the point of no return", "look at the dot com boom", "I own one car and two dogs", "été – voilà… ½", "two 12 and 7 one 3", "look at example.com", "no.5 at 3.30 pm"])
def test_clean(text):
    assert pii.find(text) == ([], [])


def test_base_stays_and_redaction():
    text = "a@b.c and x (at) y (dot) z"
    base, spans = pii.find(text)
    assert base == [("email", 0, 5)] and set(base) < set(spans)
    assert pii.redact(text) == "[email] and [email]"
    assert pii.redact(None) is None


def test_query_columns(spark):
    rows = spark.createDataFrame([(1, "a@b.c", "x"), (1, "a@b.c", "x"), (None, None, None), (3, "", "y")], "doc_id long, text string, n_email string")
    out = pii.identifiers(rows).orderBy("doc_id").collect()
    assert [r["n_email"] for r in out] == [0, 1, 1, 0]
    assert out[1]["spans"] == "email:0:5"
    assert pii.identifiers(rows.limit(0)).count() == 0


def test_planted_disguises_map_back_exactly():
    """Known identifiers, disguised at random, are found at their very place."""
    draw = random.Random(1)
    names = ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"]
    for _ in range(400):
        kind = draw.choice(pii.KINDS)
        if kind == "email":
            hidden = draw.choice(["jane{0}roe{1}mail{0}example{0}org", "k_smith{1}example{0}net"]).format(draw.choice([" dot ", "[dot]", " (.) ", "{punto}"]), draw.choice([" (at) ", "[at]", " <AT> ", "{arroba}"]))
            if draw.random() < 0.5:
                hidden = hidden.replace("mail", "m\u0430il").replace("example", "ex\u0430mpl\u0435")
        else:
            plain = {"ip": ".".join(str(draw.randrange(256)) for _ in range(4)), "phone": "+1" + "".join(draw.choices("0123456789", k=10)), "card": draw.choice(["4111111111111111", "5500005555555559", "340000000000009"])}[kind]
            spelled = [" ".join(names[int(d)] for d in part) for part in plain.replace("+", "").split(".")]
            hidden = ("plus " if kind == "phone" else "") + " dot ".join(spelled)
        before, after = (" ".join(draw.choices(["Foo", "bar,", "été", "–", "baz;"], k=draw.randint(0, 5))) for _ in range(2))
        text = f"{before} :{hidden}; {after}"
        at = text.index(hidden)
        base, spans = pii.find(text)
        assert spans == [(kind, at, at + len(hidden))], text


@pytest.mark.parametrize("unit", [" ", "\t ", "a dot ", "x (at) ", " ( ", "one ", "@ ", "a@", "+1 ", "1.", "é ", "0O", "a.b at ", "\n"])
def test_long_texts_take_linear_time(unit):
    text = "jane (at) example (dot) org " + unit * (1_000_000 // len(unit)) + " dot x"
    began = time.perf_counter()
    _, spans = pii.find(text)
    assert time.perf_counter() - began < 20
    assert spans[0][:2] == ("email", 0)
