"""Features of the toxicity classifier: against their plain definition, and in time on any text."""

from __future__ import annotations

import random
import re
import time

import pytest

from laborloom.llm import toxicity as tx

#: The definition in one expression, whose work grows with the square of a run's length.
PLAIN = re.compile(r"(?<!\w)(?=[^\s]*[^\W\d_])(?=[^\s]{0,20}[\d@$!|+€*._-][^\W_])[\w@$!|+€*.-]{3,24}(?!\w)")
MANY = 1_000_000


def test_disguises_by_their_definition():
    rng = random.Random(4)
    alphabet = "ab1@$!|+€*._- \n,é日Ǆ_0"
    for _ in range(20_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 70)))
        assert list(tx.disguises(text)) == PLAIN.findall(text), text
    assert list(tx.disguises("an 1d10t and l.o.s.e.r, 12-34 x")) == ["1d10t", "l.o.s.e.r"]


def test_near_by_its_definition():
    rng = random.Random(5)
    for _ in range(500):
        places, others = (sorted(rng.sample(range(60), rng.randint(0, 20))) for _ in range(2))
        assert tx.near_any(places, others, 5) == sum(any(abs(i - j) <= 5 for j in others) for i in places)


RUNS = {c: c * MANY for c in "0134579@$!|+€*.-_,a"} | {
    p: p * (MANY // len(p)) for p in ("1,", "1-", "a-", "-a", "._", "@@a ", "-" * 25 + "a", "!1", "a1")}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_a_long_run_takes_seconds(name):
    start = time.perf_counter()
    tx.features(RUNS[name], tx.Lexicon())
    assert time.perf_counter() - start < 5


def test_many_pronouns_and_insults_take_seconds():
    start = time.perf_counter()
    found = tx.features("you " * 50_000 + "idiot " * 50_000, tx.Lexicon())
    assert time.perf_counter() - start < 5
    assert found[5] == 5 / 100_000  # the five insults behind the last pronoun
