"""Recall of personal data written in forms that the training does not invent, and quiet on what only looks alike."""

import numpy as np
import pytest

from curbcount.llm import personal_data as P

WORDS = "lorem ipsum dolor sit amet niño über straße été garçon haus wasser river stone cloud paper window morning señal calle rue ville".split()


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(3)
    return P.train([" ".join(rng.choice(WORDS, 60)) for _ in range(40)])


def digits(rng, n, first="123456789"):
    return first[int(rng.integers(len(first)))] + "".join(map(str, rng.integers(0, 10, n - 1)))


def card(rng, n, first):
    own = first + digits(rng, n - 1 - len(first))
    return own + str(next(d for d in range(10) if P.luhn(own + str(d))))


def split(text, *sizes):
    at = np.cumsum([0, *sizes])
    return [text[a:b] for a, b in zip(at[:-1], at[1:])]


# (kind, cue words, form): brackets, marks and groupings that no template has
FORMS = {
    "braces": ("email", ["mail", "contact", ""], lambda r, w: f"{w()}{{at}}{w()}{{dot}}{r.choice(['com', 'fr'])}"),
    "spaced braces": ("email", ["write", ""], lambda r, w: f"{w()}.{w()} {{ at }} {w()} {{ dot }} {r.choice(['io', 'eu'])}"),
    "mixed case": ("email", ["mail", ""], lambda r, w: f"{w()}{digits(r, 3)} At {w()} Dot {r.choice(['org', 'info'])}"),
    "british": ("phone", ["call", "tel", "phone"], lambda r, w: f"0{digits(r, 4)} {digits(r, 6)}"),
    "trunk": ("phone", ["call", "tel", "fax"], lambda r, w: f"1-{digits(r, 3)}-{digits(r, 3)}-{digits(r, 4)}"),
    "middle dots": ("phone", ["tel", "mobile"], lambda r, w: f"{digits(r, 3)}·{digits(r, 3)}·{digits(r, 4)}"),
    "low lines": ("card", ["card", "visa", "paid with"], lambda r, w: "_".join(split(card(r, 16, "4"), 4, 4, 4, 4))),
    "no-break spaces": ("card", ["card", ""], lambda r, w: " ".join(split(card(r, 16, "51"), 4, 4, 4, 4))),
    "slashed": ("card", ["credit card", "amex"], lambda r, w: "/".join(split(card(r, 15, "37"), 4, 6, 5))),
    "mapped": ("ip", ["host", "from", ""], lambda r, w: f"::ffff:{int(r.integers(4096, 65535)):x}:{int(r.integers(4096, 65535)):x}"),
    "braced dots": ("ip", ["server", "ip", ""], lambda r, w: "{.}".join(str(int(x)) for x in r.integers(1, 255, 4))),
    "words for dots": ("ip", ["ip", "host"], lambda r, w: " [dot] ".join(str(int(x)) for x in r.integers(1, 255, 4))),
}


def planted(rng, form):
    kind, cues, make = FORMS[form]
    word = lambda: str(rng.choice(WORDS))
    before = " ".join([*rng.choice(WORDS, 5), str(rng.choice(cues))]).strip() + " "
    own = make(rng, word)
    return kind, before + own + " " + " ".join(rng.choice(WORDS, 5)), len(before), len(before) + len(own)


@pytest.mark.parametrize("form", list(FORMS))
def test_recall_of_forms_outside_the_templates(model, form):
    rng = np.random.default_rng(17)
    found = 0
    for _ in range(150):
        kind, text, a, b = planted(rng, form)
        exact = P.base_spans(text)
        spans = [(k, x, y) for k, own in exact.items() for x, y in own] + model.choose(text, exact)
        found += any(k == kind and min(y, b) - max(x, a) >= 0.9 * (b - a) for k, x, y in spans)
    assert found >= 0.9 * 150


def test_what_only_looks_alike_is_left_alone(model):
    rng = np.random.default_rng(23)
    word = lambda: str(rng.choice(WORDS))
    makes = [
        lambda: f"total {digits(rng, 3)} {digits(rng, 3)} {digits(rng, 3)}", lambda: f"order {digits(rng, 10)}", lambda: f"since {rng.integers(1990, 2024)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}",
        lambda: f"isbn 978-{digits(rng, 1)}-{digits(rng, 4)}-{digits(rng, 4)}-{digits(rng, 1)}", lambda: f"{word()} at {word()} . then", lambda: f"at {rng.integers(10, 24)}:{rng.integers(10, 60)}:{rng.integers(10, 60)}",
        lambda: f"version {rng.integers(1, 9)}.{rng.integers(1, 9)}.{rng.integers(1, 9)}", lambda: f"token {'%040x' % int.from_bytes(rng.bytes(20))}",
    ]
    wrong = 0
    for _ in range(100):
        for make in makes:
            text = f"{word()} {word()} {make()} {word()}"
            wrong += len(model.choose(text, P.base_spans(text)))
    assert wrong <= 8


def test_base_spans_stay_and_proposals_do_not_cover_them(model):
    text = "mail a.b@c.org or a (at) b.org, +1 415 555 2671, 10.0.0.1 and 4111 1111 1111 1111"
    exact = P.base_spans(text)
    assert [len(exact[k]) for k in P.KINDS] == [1, 1, 1, 1]
    assert all(not any(a < y and x < b for spans in exact.values() for x, y in spans) for _, a, b in model.choose(text, exact))
