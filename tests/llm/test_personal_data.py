import hashlib
import random
import re
import time

import numpy as np
import pytest

from tidemark.llm import personal_data
from tidemark.llm.bilstm_crf import Tagger

# The patterns as they are specified, without anything against long texts.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def prose(rng, n):
    return " ".join("".join(rng.choice("etaonris") for _ in range(rng.randrange(1, 9))) for _ in range(n))


def digits(text):
    return [int(c) for c in text if c in "0123456789"]


def passes(kind, found):
    d = digits(found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [sum(divmod(2 * x, 10)) if k % 2 else x for k, x in enumerate(d[::-1])]
        return 13 <= len(d) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def expected(text):
    return [(kind, *m.span()) for kind, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(kind, m.group())]


def base(text):
    return sorted(((personal_data.KINDS[k], s, e) for k, s, e in personal_data.base_spans(text)[0]), key=lambda r: (list(PATTERNS).index(r[0]), r[1]))


def card(rng):
    while True:
        number = "".join(rng.choice("0123456789") for _ in range(16))
        if passes("card", number):
            return number


def person(rng):
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    return rng.choice([
        f"a.{number(2)}@mail{number(1)}.example.com", ".".join(str(rng.randrange(256)) for _ in range(4)), card(rng), "-".join(re.findall("....", card(rng))),
        f"+1 ({number(3)}) 555-{number(4)}",
    ])


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB1209.@+-% ()_ä😀\n") for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(rng.choice("0123456789 -.+()") for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += [" x ".join(person(rng) for _ in range(3)) for _ in range(200)]
    texts += ["a@b.c@d.e", "@a.b", "x@y", "1.2.3.4.5.6.7.8", "256.1.1.1", "0255.01.1.1", "😀 a@b.cd", "4111 1111 1111 1111 4111 1111 1111 1111", "+1 (234) 567-8901)"]
    for text in texts:
        assert base(text) == expected(text), text


def test_long_texts_take_linear_time():
    began = time.time()
    for text in ("a" * 10**6, "1" * 10**6, "a@" * 300_000, "1." * 300_000, "1 " * 300_000, "+1" * 300_000, "a.b@c" * 100_000):
        personal_data.base_spans(text)
    assert time.time() - began < 60


def test_gradient_and_training():
    random_ = np.random.default_rng(2)
    barred = np.zeros((3, 3), bool)
    barred[0, 2] = True
    tagger = Tagger.fresh(5, 3, barred, hidden=4)
    tagger.weights = {k: v.astype(float) for k, v in tagger.weights.items()}
    x = random_.integers(0, 5, (6, 7))
    tags = np.where(x < 3, 0, 1)
    grad = tagger.loss(x, tags)[1]
    for name, w in tagger.weights.items():
        at = tuple(random_.integers(0, n) for n in w.shape)
        before = w[at]
        w[at] = before + 1e-2
        above = tagger.loss(x, tags)[0]
        w[at] = before - 1e-2
        below = tagger.loss(x, tags)[0]
        w[at] = before
        assert abs((above - below) / 2e-2 - grad[name][at]) < 1e-3
    x = random_.integers(0, 5, (300, 12)).astype(np.uint8)
    tags = np.where(x == 3, 1, 0)
    tags[:, 1:][(x[:, :-1] == 3) & (x[:, 1:] == 4)] = 2
    tagger = Tagger.fresh(5, 3, barred, hidden=6)
    losses = tagger.train(x, tags, epochs=60)
    assert losses[-1] < 0.2 < losses[0]
    assert (tagger.decode(x)[0] == tags).mean() > 0.99


def test_decoding_is_the_best_path():
    tagger = Tagger.fresh(4, 3, np.zeros((3, 3), bool), hidden=3, seed=7)
    tagger.weights["A"] += np.random.default_rng(1).normal(0, 1, (3, 3)).astype(np.float32)
    x = np.random.default_rng(2).integers(0, 4, (5, 4))
    scores = tagger._scores(tagger._states(x))
    paths = np.stack(np.meshgrid(*[range(3)] * 4, indexing="ij"), -1).reshape(-1, 4)
    for k, tags in enumerate(tagger.decode(x)[0]):
        value = [sum(scores[t, k, p[t]] for t in range(4)) + sum(tagger.weights["A"][p[t], p[t + 1]] for t in range(3)) for p in paths]
        assert tuple(tags) == tuple(paths[int(np.argmax(value))])


def test_pieces_of_windows_become_spans():
    phone, email = "555 (743) 123-4567", "someone.with.a.very.long.name.indeed@mail.of.a.long.example.com"
    text = "x" * 50 + " " + phone + " " + "y" * 40 + " " + email + " ende"
    at, to = text.index(phone), text.index(phone) + len(phone)
    e_at, e_to = text.index(email), text.index(email) + len(email)
    pieces = [(0, (3, at, 64, 20.0)), (32, (3, at - 32, to - 32, 30.0)), (64, (3, 0, to - 64, 5.0))]
    pieces += [(s, (0, max(e_at - s, 0), min(e_to - s, 64), 9.0)) for s in range(64, len(text), 32) if e_at < s + 64 and e_to > s]
    assert personal_data.reconciled(text, [], pieces) == [(3, at, to), (0, e_at, e_to)]
    assert personal_data.reconciled(text, [(3, at + 3, at + 5)], pieces) == [(0, e_at, e_to)]
    assert personal_data.reconciled(text, [], [*pieces, (32, (0, at - 32, to - 32, 50.0))])[0] == (3, at, to)  # what has no @ is no address
    assert personal_data.reconciled("ab4111111111111111", [], [(0, (2, 2, 18, 9.0))]) == []  # part of a word


@pytest.fixture(scope="module")
def tagger(spark):
    rng = random.Random(5)
    rows = [(f"{prose(rng, 12)} {person(rng)} {prose(rng, 12)}",) for _ in range(500)] + [(f"{prose(rng, 30)} 20{rng.randrange(10, 99)} a{rng.randrange(10**6)}",) for _ in range(100)]
    return personal_data.fit(spark.createDataFrame(rows, "text string"), per_kind=100)


def test_the_tagger_adds_and_base_spans_stay(documents, tagger):
    rng = random.Random(6)
    pairs = [f"{card(rng)} {card(rng)}" for _ in range(30)]
    rows = [f"{prose(rng, rng.randrange(20))} {person(rng)} {prose(rng, rng.randrange(20))}" for _ in range(60)] + [f"zu {p} le" for p in pairs]
    rows += [f"call 1 ({k}43) 555-38{k}9 now" for k in range(10, 30)] + ["", None, "plain prose of no one", "2024 and 17 or 3 times 12", person(rng) * 40, "ä" * 200 + "a@b.de"]
    found = {r["doc_id"]: r for r in personal_data.summarised(personal_data.find_spans(documents(rows, extra=True), tagger)).collect()}
    for k, text in enumerate(rows):
        r, want = found[k], expected(text)
        listed = [f"{kind}:{s}:{e}" for kind, s, e in want]
        assert [r[f"n_{kind}"] for kind in PATTERNS] == [sum(w[0] == kind for w in want) for kind in PATTERNS]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        everything = [s for s in r["spans"].split(",") if s]
        assert set(listed) <= set(everything) and len(everything) == len(listed) + r["n_added"]
        places = [(list(PATTERNS).index(s.split(":")[0]), int(s.split(":")[1])) for s in everything]
        assert places == sorted(places)
    cards = [found[60 + k]["spans"] == "card:3:19,card:20:36" for k in range(30)]
    assert sum(cards) >= 20  # the pattern takes both for one number and drops it
    assert sum(found[90 + k]["n_added"] == 1 for k in range(20)) >= 10  # a phone number without its plus
    assert found[112]["spans"] == found[113]["spans"] == ""


def test_what_it_learnt_from_patterns_holds_without_them(tagger):
    rng, hits = random.Random(8), 0
    for _ in range(100):
        before, data = prose(rng, rng.randrange(3, 12)), person(rng)
        text = f"{before} {data} {prose(rng, 6)}"
        own = personal_data.symbols(text)
        starts = personal_data.windows(own).tolist()
        pieces = [(starts[k], p) for k, p in personal_data._pieces(tagger, np.stack([personal_data._filled(own, s) for s in starts]))]
        hits += [(s, e) for _, s, e in personal_data.reconciled(text, [], pieces)] == [(len(before) + 1, len(before) + 1 + len(data))]
    assert hits >= 90


def test_empty_tables_and_ids(documents, tagger):
    assert personal_data.fit(documents([None, "no data"])) is None
    assert personal_data.find_spans(documents([]), tagger).collect() == []
    rows = [(None, "a@b.de"), (None, "a@b.de"), (4, "a@b.de"), (4, "")]
    got = sorted((tuple(r) for r in personal_data.summarised(personal_data.find_spans(documents(rows), None)).select("doc_id", "n_email", "spans").collect()), key=repr)
    assert got == sorted([(None, 1, "email:0:6"), (None, 1, "email:0:6"), (4, 1, "email:0:6"), (4, 0, "")], key=repr)
