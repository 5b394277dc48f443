import random

import pytest

from distriq.llm.pii import best_path, find_mentions, marginals, masked, mentions, redact, score
from distriq.llm.pii_lattice import Candidate, candidates, clusters, link


def found(text):
    return [(c.kind, text[c.start : c.end]) for c in mentions(text)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Dear Paul Bernardin, your cheque was reissued.", [("NAME", "Paul Bernardin")]),
        ("Signed by Mrs Kowalski, assistant treasurer.", [("NAME", "Kowalski")]),
        ("Moderator J.L. Thornton thanked Novak, Irene for the update.", [("NAME", "J.L. Thornton"), ("NAME", "Novak, Irene")]),
        ("Reply to grace.hopper+x@mail.fund.example with a copy.", [("EMAIL", "grace.hopper+x@mail.fund.example")]),
        ("Write to hopper [at] fund [dot] example before noon.", [("EMAIL", "hopper [at] fund [dot] example")]),
        ("Call (617) 555-0129 ext. 12 between nine and five.", [("PHONE", "(617) 555-0129 ext. 12")]),
        ("Call +33 1 99 00 35 77 between nine and five.", [("PHONE", "+33 1 99 00 35 77")]),
        ("The record shows SSN 970-45-8067 against this account.", [("ID_NUMBER", "970-45-8067")]),
        ("The record shows passport no. QZ5230575 against this account.", [("ID_NUMBER", "QZ5230575")]),
        ("Return the slip to 122B North Larkmoor Avenue, Suite 658.", [("ADDRESS", "122B North Larkmoor Avenue, Suite 658")]),
        ("Retourner le feuillet au 2005, rue du Quai-Perdu, bureau 129, Marlough (Québec) H8Z 8Z1.", [("ADDRESS", "2005, rue du Quai-Perdu, bureau 129, Marlough (Québec) H8Z 8Z1")]),
        ("Contact details were already removed: [EMAIL] appears here.", []),
        ("Halden Rowe Global Income Fund declared a distribution of $0.11 per unit.", []),
        ("Analysts on Main Street and Wall Street read it.", []),
        ("Control number 3310406342 and CUSIP 9421128Q5 identify the register.", []),
        ("Reinvestment price 38.05, factor 0.689999, batch 443-9887-91.", []),
        ("See accession 6613565067-23-387870 and CIK 2000010003.", []),
        ("https://www.fund.example/@ujqeb/notices has it at $5 @ close.", []),
        ("", []),
    ],
)
def test_mentions(text, expected):
    assert found(text) == expected


def test_masked_text_is_otherwise_unchanged():
    text = "Dear Paul Bernardin,\ncall 617-555-0129  or write\tto a.b@c.example."
    assert masked(text, mentions(text)) == "Dear [NAME],\ncall [PHONE]  or write\tto [EMAIL]."
    assert masked("plain", []) == "plain"


def lattice(rng):
    out = []
    for _ in range(rng.randint(1, 7)):
        start = rng.randint(0, 30)
        out.append(Candidate(start, start + rng.randint(1, 12), rng.choice(["NAME", "PHONE"]), (rng.choice("abcdef"), rng.choice("ghij"))))
    return sorted(out, key=lambda c: (c.start, c.end))


def labellings(cluster):
    def extend(chosen, rest):
        yield chosen
        for n, i in enumerate(rest):
            if not chosen or cluster[chosen[-1]].end <= cluster[i].start:
                yield from extend([*chosen, i], rest[n + 1 :])

    return list(extend([], list(range(len(cluster)))))


def test_dynamic_programming_against_all_labellings():
    import math

    rng = random.Random(5)
    weights = {f: rng.uniform(-2, 2) for f in [*"abcdefghij", "NAME>PHONE", "PHONE>NAME", "NAME>NAME", "PHONE>PHONE"]}
    for _ in range(200):
        cluster = lattice(rng)

        def value(chosen):
            return sum(score(cluster[i].features, weights) for i in chosen) + sum(score(link(cluster[a], cluster[b]), weights) for a, b in zip(chosen, chosen[1:]))

        every = labellings(cluster)
        best = max(map(value, every))
        path = best_path(cluster, weights)
        assert abs(value([cluster.index(c) for c in path]) - best) < 1e-9
        total, single, _ = marginals(cluster, weights)
        assert abs(total - math.log(sum(math.exp(value(c)) for c in every))) < 1e-9
        for i in range(len(cluster)):
            assert abs(single[i] - sum(math.exp(value(c) - total) for c in every if i in c)) < 1e-9


def test_clusters_split_at_reach():
    cs = [Candidate(0, 5, "NAME", ()), Candidate(30, 40, "NAME", ()), Candidate(90, 95, "NAME", ())]
    assert [len(c) for c in clusters(cs)] == [2, 1]


def test_frames(spark):
    rows = [(1, "Call (617) 555-0129 now. é Dear Paul Bernardin, hello", "k"), (2, None, "k"), (3, "", "k"), (4, "nothing", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, redacted string")
    got = sorted(tuple(r) for r in find_mentions(df).collect())
    assert got == [(1, "NAME", 33, 46, "Paul Bernardin"), (1, "PHONE", 6, 19, "(617) 555-0129")]
    out = {r["doc_id"]: r["redacted"] for r in redact(df).collect()}
    assert out == {1: "Call [PHONE] now. é Dear [NAME], hello", 2: None, 3: "", 4: "nothing"}
    assert find_mentions(df.limit(0)).count() == 0
    assert redact(df).columns == ["doc_id", "text", "redacted"]


def test_long_text():
    text = "The unit was paid on time and in full. " * 20_000 + "Dear Paul Bernardin, hello"
    assert found(text) == [("NAME", "Paul Bernardin")]
    assert len(candidates("A" * 100_000)) == 0
