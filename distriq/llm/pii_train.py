"""Fits the weights of :mod:`distriq.llm.pii` on a bounded sample of documents, labelled by rules.

Nobody labelled the sample by hand. Labelling functions do it from what is certain: a family name is a word that follows
a given name or a form of address somewhere; numbers and addresses are told by the words before them or by their shape. They are strict about
evidence and know only the names the sample has, so most labelled names are then replaced by other given names and by
family names made of random syllables: what the field learns is the shape of names and what stands around them.

    python -m distriq.llm.pii_train /root/testdata/sf0.1/documents.parquet

writes the weights beside this module. SAMPLE bounds the documents read; the same input gives the same weights.
"""

from __future__ import annotations

import json
import random
import re
import sys
from collections import Counter, defaultdict

from distriq.llm.pii import WEIGHTS, best_path, marginals
from distriq.llm.pii_lattice import BREAKING, GIVEN, MONTHS, OTHER, PARTICLES, TITLES, WORDS_TOO, Candidate, candidates, clusters, folded, link

#: Documents looked at, at most; and how often each that has a label is used, with other names each time.
SAMPLE = 8000
VARIANTS, EPOCHS, RATE, RIDGE, LEAST = 3, 8, 0.3, 1e-4, 3

_SYLLABLES = ("ba be bo bri ca cha cor da de dra el fa fer gan gre ha hol in ja ka kel la lam lo ma mer mi na ner no or pa per pri ra ren ri ro sa sel sta ta ter tho va ver vi wa wil yo za".split(), "n r l s t rd nd st ck ff ng m x".split())
_ENDINGS = "son man ton ley ez ier eau ard ini ello ova ski berg feld stein er el in an ey iano oux et ard ault ham ford well by worth ois ic eur".split()


def random_family(rng: random.Random) -> str:
    heads, tails = _SYLLABLES
    word = "".join(rng.choice(heads) for _ in range(rng.randint(1, 2))) + (rng.choice(tails) if rng.random() < 0.5 else "") + rng.choice(_ENDINGS)
    return word.capitalize()


def random_given(rng: random.Random) -> str:
    if rng.random() < 0.2:  # some names are on no list
        return random_family(rng)
    return "-".join(p.capitalize() for p in rng.choice(sorted(GIVEN)).split("-"))


def _words(span: str) -> list[str]:
    return re.findall(r"[^\W\d_]+\.|[^\W\d_][\w'’]*(?:-[^\W\d_][\w'’]*)*", span)


def family_names(texts: list[str], least: int = 1) -> set[str]:
    """Words that follow at least ``least`` different given names or forms of address."""
    seen: dict[str, set[str]] = defaultdict(set)
    for text in texts:
        # a lookahead, as one pair's second word may be the next one's first
        for m in re.finditer(r"\b(?=([A-ZÀ-Ý][\w-]*)\.?\s(?:[A-ZÀ-Ý]\. ?)?([A-ZÀ-Ý][\w'’]+(?:-[A-ZÀ-Ý][\w'’]+)*))", text):
            given, family = folded(m.group(1)), folded(m.group(2))
            if (given in GIVEN or given in TITLES) and family not in OTHER:
                for part in {family, *family.split("-")}:
                    seen[part].add(given)
    return {w for w, given in seen.items() if len(given) >= least and w not in GIVEN and w not in BREAKING and w not in MONTHS}


_SAID = {
    "ID_NUMBER": re.compile(r"(?:\bSSN\)?:?|\bSIN:?|\bNAS:?|social security number|insurance number|assurance sociale|identified by|passport no\.?|passport|passeport(?: no\.?| n[o°])?|Tax ID \(SSN\))\s*$", re.IGNORECASE),
    "PHONE": re.compile(r"(?:\bcall|\btext|\bphone:?|\btel\.?:?|\bfax from|\bon|\bleft|\bor|\bau|\ble|\bt[ée]l\.?:?|\bfax:?)\s*$", re.IGNORECASE),
    "NOT": re.compile(r"(?:batch|lot|accession|CIK|CUSIP|control number|contr[ôo]le|number|code|line|form|factor|file)\s*$", re.IGNORECASE),
}

#: The grouping of social security numbers, which nothing else has: evidence by itself, whatever the words before it.
_SHAPED = re.compile(r"\d{3}-\d{2}-\d{4}")


def label(text: str, found: list[Candidate], families: set[str]) -> list[Candidate]:
    """The candidates that the labelling functions take for personal data, none overlapping."""
    sure: list[tuple[int, Candidate]] = []
    for c in found:
        span, before = text[c.start : c.end], text[max(0, c.start - 40) : c.start]
        if c.kind == "EMAIL":
            sure.append((3 if "EMAIL|at=@" in c.features else 2 if "EMAIL|at=()" in c.features else 1, c))
        elif c.kind == "ADDRESS":
            sure.append((1, c))
        elif c.kind == "ID_NUMBER" and (_SAID["ID_NUMBER"].search(before) or _SHAPED.fullmatch(span) and not _SAID["NOT"].search(before)):
            sure.append((3, c))
        elif c.kind == "PHONE" and not _SAID["ID_NUMBER"].search(before) and not _SAID["NOT"].search(before) and (not span.isdigit() or _SAID["PHONE"].search(before)):
            sure.append((2, c))
        elif c.kind == "NAME":
            words = [folded(w) for w in _words(span)]
            kinds = "".join("I" if w.endswith(".") else "p" if w in PARTICLES and w.islower() and w not in families else "F" if w in families or all(p in families for p in w.split("-")) else "G" if w in GIVEN else "x" for w in words)
            titled = "N|title=True" in c.features
            monsieur = re.match(r"[Mm]\.\s", span) is not None
            if not monsieur and re.fullmatch(r"G?G?I*p*F|p*F,?GI*|p*F", kinds) and (len(kinds) > 1 or titled) or titled and kinds in ("GF", "GpF"):
                sure.append((2, c))
    out: list[Candidate] = []
    for _, c in sorted(sure, key=lambda s: (-s[0], s[1].start - s[1].end, s[1].start)):
        if all(c.end <= o.start or c.start >= o.end for o in out):
            out.append(c)
    return sorted(out)


#: Words of firms, places and calendars that are names of people, too.
_PLAIN_WORDS = sorted(w for w in OTHER if w.isalpha() and w.isascii() and len(w) > 2)
_MONTH_NAMES = ["April", "May", "June", "August", "Avril", "Juin"]
_CYRILLIC = str.maketrans("abcdefghijklmnoprstuvwyzABCDEFGHIJKLMNOPRSTUVWYZ", "абцдефгхийклмнопрстувуызАБЦДЕФГХИЙКЛМНОПРСТУВУЫЗ")


def _odd_form(span: str, odd: float, rng: random.Random) -> str:
    """A name as few are written: with particles or more given names, in another script or in small letters."""
    head, blank, family = span.rpartition(" ")
    if 0.08 <= odd < 0.15 and "," not in span:
        particles = rng.choice(["de la", "de", "van der", "von", "van", "du", "al", "bin", "di", "dos", "ter", "le"])
        return f"{head}{blank}{particles} {family}"
    if 0.15 <= odd < 0.18 and blank and "," not in span:
        return " ".join([*(random_given(rng) for _ in range(rng.randint(1, 3))), span])
    if 0.18 <= odd < 0.21:
        return span.translate(_CYRILLIC)
    if 0.21 <= odd < 0.24 and blank:
        return span.lower()
    return span


def renamed(text: str, gold: list[Candidate], rng: random.Random, share: float = 0.75) -> tuple[str, list[tuple[int, int, str]]]:
    """``text`` with most of its labelled names replaced, and where the labelled spans are now."""
    out, at, spans = [], 0, []
    size = 0
    for c in gold:
        span = text[c.start : c.end]
        if c.kind == "NAME" and rng.random() < share:
            odd = rng.random()

            def other(m: re.Match[str]) -> str:
                word = m.group()
                if word.endswith("."):
                    return rng.choice("ABCDEFGHJKLNPRSTVW") + "."
                if folded(word) in GIVEN:
                    new = rng.choice(_MONTH_NAMES) if odd < 0.03 else random_given(rng)
                else:
                    new = rng.choice(_PLAIN_WORDS).capitalize() if odd < 0.08 else "-".join(random_family(rng) for _ in word.split("-"))
                return new.upper() if word.isupper() else new

            span = _odd_form(re.sub(r"[^\W\d_]\.|[^\W\d_][\w'’]*(?:-[^\W\d_][\w'’]*)*", other, span), odd, rng)
        gap = text[at : c.start]
        spans.append((size + len(gap), size + len(gap) + len(span), c.kind))
        out += [gap, span]
        size += len(gap) + len(span)
        at = c.end
    return "".join([*out, text[at:]]), spans


def examples(texts: list[str], families: set[str], seed: int = 3) -> list[tuple[list[Candidate], list[int]]]:
    """Clusters with the places of their labelled candidates."""
    rng = random.Random(seed)
    out = []
    for text in texts:
        gold = label(text, candidates(text), families)
        for _ in range(VARIANTS if gold else 1):
            new, spans = renamed(text, gold, rng) if gold else (text, [])
            wanted = set(spans)
            for cluster in clusters(candidates(new)):
                out.append((cluster, [i for i, c in enumerate(cluster) if (c.start, c.end, c.kind) in wanted]))
    # given names written small that are words: no rule finds them in the sample, so some are made
    small = sorted({w for text in texts[:500] for w in re.findall(r"\b[a-z]{3,10}\b", text)} - GIVEN)
    for _ in range(40 * len(WORDS_TOO) if small else 0):
        text = f"{rng.choice(small)} {rng.choice(small)} {rng.choice(sorted(WORDS_TOO))} {rng.choice(small)} {rng.choice(small)}"
        out += [(cluster, []) for cluster in clusters(candidates(text))]
    return out


def fit(data: list[tuple[list[Candidate], list[int]]], seed: int = 5) -> dict[str, float]:
    """Weights of greatest conditional likelihood, by AdaGrad with a ridge; features seen less than LEAST times have none."""
    seen = Counter(f for cluster, _ in data for c in cluster for f in c.features)
    known = {f for f, n in seen.items() if n >= LEAST}
    data = [([c._replace(features=tuple(f for f in c.features if f in known)) for c in cluster], gold) for cluster, gold in data]
    weights: dict[str, float] = {}
    grown: dict[str, float] = defaultdict(float)
    rng = random.Random(seed)
    for epoch in range(EPOCHS):
        rng.shuffle(data)
        lost = 0.0
        for cluster, gold in data:
            total, single, pairs = marginals(cluster, weights)
            slope: dict[str, float] = defaultdict(float)
            for i, c in enumerate(cluster):
                delta = (i in gold) - single[i]
                if abs(delta) > 1e-4:
                    for f in c.features:
                        slope[f] += delta
            for (j, i), p in pairs.items():
                for f in link(cluster[j], cluster[i]):
                    slope[f] -= p
            for j, i in zip(gold, gold[1:]):
                for f in link(cluster[j], cluster[i]):
                    slope[f] += 1
            for f, g in slope.items():
                g -= RIDGE * weights.get(f, 0.0)
                grown[f] += g * g
                weights[f] = weights.get(f, 0.0) + RATE * g / (grown[f] ** 0.5 + 1e-8)
            lost += total
        print(f"epoch {epoch + 1}: {len(weights)} weights", flush=True)
    return {f: round(w, 3) for f, w in sorted(weights.items()) if abs(w) >= 0.005}


def accuracy(data: list[tuple[list[Candidate], list[int]]], weights: dict[str, float]) -> dict[str, tuple[int, int, int]]:
    """Of each kind: found and labelled, found only, labelled only."""
    hits: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])
    for cluster, gold in data:
        said, truth = {(c.kind, c.start) for c in best_path(cluster, weights)}, {(cluster[i].kind, cluster[i].start) for i in gold}
        for kind, _ in said & truth:
            hits[kind][0] += 1
        for kind, _ in said - truth:
            hits[kind][1] += 1
        for kind, _ in truth - said:
            hits[kind][2] += 1
    return {k: tuple(v) for k, v in hits.items()}


def main(path: str) -> None:
    import pyarrow.parquet as pq

    texts = sorted({t for t in pq.read_table(path, columns=["text"]).column("text").to_pylist() if t})
    random.Random(1).shuffle(texts)
    texts = texts[:SAMPLE]
    cut = len(texts) * 4 // 5
    families = family_names(texts)
    data, held = examples(texts[:cut], families), examples(texts[cut:], families, seed=4)
    weights = fit(data)
    print("held out (both, found only, labelled only):", accuracy(held, weights))
    WEIGHTS.write_text(json.dumps(weights, ensure_ascii=False, indent=0), encoding="utf-8")


if __name__ == "__main__":
    main(sys.argv[1])
