"""Names and addresses that word lists and fixed forms used to keep out of the lattice."""

import random

import pytest

from distriq.llm.pii import _default_weights, _floor, best_path, mentions
from distriq.llm.pii_lattice import Candidate, candidates, clusters


def found(text):
    return [(c.kind, text[c.start : c.end]) for c in mentions(text)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Please contact Adam West about it.", [("NAME", "Adam West")]),
        ("Signed by June Carter, treasurer.", [("NAME", "June Carter")]),
        ("Dear Emma Small and Grace Court,", [("NAME", "Emma Small"), ("NAME", "Grace Court")]),
        ("Our analyst Jack Lane will call.", [("NAME", "Jack Lane")]),
        ("Dear Mr. Robert Wall, hello", [("NAME", "Robert Wall")]),
        ("Please contact Łukasz Żak today.", [("NAME", "Łukasz Żak")]),
        ("Dear Владимир Петров, hello", [("NAME", "Владимир Петров")]),
        ("Signed by Maria de la Cruz, treasurer.", [("NAME", "Maria de la Cruz")]),
        ("Dear Ludwig van der Berg, your cheque", [("NAME", "Ludwig van der Berg")]),
        ("Signed by Mrs van der Berg, officer.", [("NAME", "van der Berg")]),
        ("Contact Jean d'Ormesson, please", [("NAME", "Jean d'Ormesson")]),
        ("please contact jane smith about it", [("NAME", "jane smith")]),
        ("Signed by Anna Maria Sofia Elena Kowalska, treasurer.", [("NAME", "Anna Maria Sofia Elena Kowalska")]),
        ("WRITE TO JOHN.DOE (AT) EXAMPLE (DOT) COM", [("EMAIL", "JOHN.DOE (AT) EXAMPLE (DOT) COM")]),
        ("john.doe [chez] exemple [point] fr", [("EMAIL", "john.doe [chez] exemple [point] fr")]),
        ("Write to john (dot) doe (at) example (dot) com now", [("EMAIL", "john (dot) doe (at) example (dot) com")]),
        ("Return it to 350 5th Avenue, Suite 3.", [("ADDRESS", "350 5th Avenue, Suite 3")]),
        ("The record shows 967-47-6287 against this account.", [("ID_NUMBER", "967-47-6287")]),
        ("Le dossier de Luc Yarlonde (942-12-8769) est incomplet.", [("NAME", "Luc Yarlonde"), ("ID_NUMBER", "942-12-8769")]),
        ("marked to market within the grace period of the unit", []),
        ("The Board of Directors of Halden Rowe Global Income Fund met in June on Wall Street.", []),
        ("the closing custod-\nian retracted it", []),
    ],
)
def test_mentions(text, expected):
    assert found(text) == expected


def test_long_addresses_are_whole():
    local, domain = "a" * 300, ".".join(["b" * 60] * 5)
    assert found(f"Reply to {local}@{domain}.example now") == [("EMAIL", f"{local}@{domain}.example")]


def test_what_the_floor_leaves_out_changes_nothing():
    weights = _default_weights()
    texts = ["THE BOARD OF Halden Rowe Fund thanked Mr. Robert Wall, Novak, Irene and Anna Maria Small of New York.", "Dear Paul Bernardin, Main Street Bank of June, Global Income Fund"]
    for text in texts:
        slow = [c for cluster in clusters(candidates(text)) for c in best_path(cluster, weights)]
        fast = [c for cluster in clusters(candidates(text, _floor(weights))) for c in best_path(cluster, weights)]
        assert slow == fast


def test_a_page_of_ten_thousand_candidates():
    rng = random.Random(1)
    cluster = sorted((Candidate(s, s + rng.randint(5, 30), "NAME", (rng.choice("ab"),)) for s in range(0, 100_000, 10)), key=lambda c: (c.start, c.end))
    path = best_path(cluster, {"a": 1.0, "b": -1.0, "NAME>NAME": 0.2})
    assert all(x.end <= y.start for x, y in zip(path, path[1:])) and len(path) > 2000
