import random

import numpy as np

from distriq.llm.leakage import MATCHES, Suffixes, leaks, shard_matches, suffix_array, without_leaks
from distriq.llm.words import cleaned, stream, words

VOCABULARY = "the unit fund paid cash late rate note ex date one two three four five six seven eight nine ten series a an b income gain".split()


def passage(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def brute(docs, items, least):
    out = set()
    for d, t in docs:
        text = " " + " ".join(w.decode() for w in words(t or "")) + " "
        for i, item in items:
            ws = [w.decode() for w in words(item or "")]
            n = min(least, len(ws))
            if n and any(" " + " ".join(ws[k : k + n]) + " " in text for k in range(len(ws) - n + 1)):
                out.add((d, i))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(3)
    items = [(i, passage(rng, rng.choice([1, 3, 6, 20, 40]))) for i in range(30)] + [(90, ""), (91, None), (92, "..."), (93, passage(rng, 8))]
    docs = []
    for d in range(150):
        text = passage(rng, 30)
        if d % 3 == 0:
            ws = rng.choice(items[:30])[1].split()
            k = rng.randint(0, max(0, len(ws) - 6))
            text += " " + " ".join(ws[k : k + rng.choice([5, 6, 7, 30])]) + " " + passage(rng, 5)
        docs.append((d, text))
    docs += [(500, None), (501, ""), (502, docs[0][1]), (503, items[0][1])]
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, item_text string")
    found = leaks(df, it, least=6)
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    # a stream has no gaps, so a match across other word breaks may come on top
    extra = got - brute(docs, items, 6)
    assert brute(docs, items, 6) <= got
    assert len(extra) <= 2
    assert {r[0] for r in without_leaks(df, found).select("doc_id").collect()} == {d for d, _ in docs} - {d for d, _ in got}


ITEM = "When mandate GR13637 lapsed, one omnibus holder matched 66019 notional gains against code RD73014 while a deputy trustee set aside 53680 capital slips"


def hits(text, item=ITEM):
    return list(shard_matches([7], [text], Suffixes.of([(1, item)], 13)))


def test_disguises():
    for text in (
        ITEM.upper(),
        "> " + ITEM.replace(" ", "\n> "),
        ITEM.replace("omnibus", "omni-\nbus").replace("notional", "no­tional").replace("code", "c​ode"),
        "<p>" + ITEM.replace("holder", "<b>hol</b>der").replace(" ", "&nbsp;") + "</p>",
        ITEM.replace("66019", "66,019").replace("a ", "à "),
    ):
        assert [(m[0], m[1], m[3]) for m in hits(text)] == [(7, 1, 23)], text


def test_edges_are_word_edges():
    w = ITEM.replace(",", "").split()
    assert hits(" ".join(w[:13]))[0][2:4] == (0, 13)
    assert hits("x " + " ".join(w[5:18]) + " y")[0][2:4] == (5, 13)
    assert hits(" ".join(w[:12])) == []
    assert hits("pre" + " ".join(w[:13])) == []
    assert hits(" ".join(w[:13]) + "s") == []
    assert hits(" ".join(w[:8] + ["not"] + w[8:16] + ["not"] + w[16:])) == []


def test_place_of_the_longest_match():
    w = ITEM.replace(",", "").split()
    text = "ab cd " + " ".join(w[2:15]) + ". Then, " + " ".join(w[1:20])
    (document, item, word, size, before), = hits(text)
    assert (document, item, word, size) == (7, 1, 1, 19)
    assert before == len("abcd" + "".join(w[2:15]) + "then")


def test_suffix_array_sorts():
    data, starts, _ = stream([cleaned(t) for t in ("abab abab abab", "abab b", "", "é ö")])
    at = np.flatnonzero(starts)
    text = data.tobytes()
    assert [text[i:] for i in suffix_array(data, at, 40)] == sorted(text[i:] for i in at)


def test_nothing_to_look_for(spark):
    docs, none = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, item_text string")
    assert leaks(docs, none).schema.simpleString() == spark.createDataFrame([], MATCHES).schema.simpleString()
    assert leaks(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, item_text string")).count() == 0


def test_long_text_and_nul():
    assert [(m[0], m[3]) for m in hits("z\0 " * 200_000 + ITEM + " z" * 200_000)] == [(7, 23)]
