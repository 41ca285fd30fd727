"""Base phrases against brute force, and the automata."""

import re

import pytest
from llm_data import ODD, documents, none, odd

from tidegauge.llm import licenses
from tidegauge.llm.licenses import PHRASES, TEMPLATES, Automaton

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(i, text):
    w, places, labels = words(text), [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for s in range(len(w) - len(p) + 1):
            if w[s : s + len(p)] == p:
                places.append(s)
                labels.add(label)
    return (i, len(w), len(places), min(places, default=None), max(places, default=None), sorted(labels))


TEXTS = [
    (1, "Licensed under the Apache License, Version 2.0."),
    (2, "CC BY CC-BY; cc\nby éMIT License MIT License MIT Licenses GNU  general--public license!"),
    (3, "a gnu general public gnu general public license mit  LICENSE"),
    (4, "x mit licenseé İMIT license apache license"),
]


def found(df):
    return sorted(((r.id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan_licenses(df).collect()), key=str)


def test_base_equals_brute_force(spark):
    assert found(documents(spark, TEXTS)) == sorted((brute(i, t) for i, t in TEXTS), key=str)


def test_odd_rows(spark):
    assert found(odd(spark)) == sorted((brute(i, t) for i, t in ODD), key=str)
    assert found(none(spark)) == []


@pytest.mark.parametrize(
    "text, accepted",
    [
        ("a b c d", True),
        ("x a b c d y", True),
        ("a b d", True),
        ("a c d", False),
        ("a a b c d", True),
        ("a b c e d", False),
        ("a b", False),
        ("", False),
    ],
)
def test_optional_region(text, accepted):
    assert Automaton("a b [[c]] d").accepts(text.encode().split()) is accepted


@pytest.mark.parametrize("gap, accepted", [(0, True), (1, True), (3, True), (4, False)])
def test_replaceable_region(gap, accepted):
    assert Automaton("the name of {{3}} may not").accepts(("the name of " + "x " * gap + "may not").encode().split()) is accepted


def test_nested_and_leading_regions():
    a = Automaton("[[p [[q]] r]] s {{2}} t")
    for text, accepted in (("s t", True), ("p r s t", True), ("p q r s x y t", True), ("s x y z t", False), ("p q s x t", True)):
        assert a.accepts(text.encode().split()) is accepted
    with pytest.raises(ValueError):
        Automaton("[[only optional]]")
    with pytest.raises(ValueError):
        Automaton("a [[b")


def test_every_template_accepts_itself():
    for template in TEMPLATES.values():
        plain = re.sub(r"\[\[.*?\]\]|\{\{\d+\}\}", "", template)
        full = re.sub(r"\[\[|\]\]", "", template).replace("{{12}}", "this program").replace("{{16}}", "its holder")
        for text in (plain, full):
            assert Automaton(template).accepts(text.lower().encode().split())


def test_labels_add_to_base(spark):
    got = {r.id: (r.base_labels, r.template_labels) for r in licenses.scan_licenses(documents(spark, TEXTS)).collect()}
    assert got[1] == (["apache"], ["apache-2.0"])
    assert got[2] == (["cc-by", "gpl", "mit"], [])
