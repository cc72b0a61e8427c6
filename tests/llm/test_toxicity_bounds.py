"""The automaton's bounds change no result, and words are found where a plain scan finds them."""

import random
import re

from strata.llm import toxicity

TERMS = {"scum": 3.0, "idiot": 4.0, "worthless": 5.0, "mor*": 2.0, "moron": 4.5, "éan": 1.0}


def _words(n):
    rnd = random.Random(4)
    for _ in range(n):
        word = list(rnd.choice([t.rstrip("*") for t in TERMS]))
        for _ in range(rnd.randint(0, 3)):
            i = rnd.randrange(len(word) + 1)
            word[i:i + rnd.randint(0, 1)] = rnd.choice(["", "x", "o", "😀", "é"])
        yield "".join(word)


def test_small_bounds_give_the_same_words(monkeypatch):
    some = list(_words(2000))
    whole = toxicity.Lexicon(TERMS)
    expected = [whole.look_up(w) for w in some]
    monkeypatch.setattr(toxicity, "MAX_STATES", 5)
    monkeypatch.setattr(toxicity, "MAX_WORDS", 7)
    small = toxicity.Lexicon(TERMS)
    assert [small.look_up(w) for w in some] == expected
    assert len(small.sets) < len(whole.sets) and len(small.hits) + len(small.clean) <= 7


def test_places_equal_a_plain_scan(monkeypatch):
    rnd = random.Random(9)
    some = {"ab", "a", "aba", "é1"}
    for _ in range(500):
        text = "".join(rnd.choice("ab é1_.\n") for _ in range(rnd.randint(0, 40)))
        plain = [m.span() for m in re.finditer(r"[^\W_]+", text) if m.group() in some]
        assert toxicity._places(text, some) == plain
        with monkeypatch.context() as m:
            m.setattr(toxicity, "FEW", 0)
            assert toxicity._places(text, some) == plain
    assert toxicity._places("", some) == [] and toxicity._places("ab", set()) == []
