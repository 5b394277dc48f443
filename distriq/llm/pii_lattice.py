"""Candidate segments of personal data in a text, and the features by which they are scored.

A candidate is a stretch of text with a kind that its shape permits: far more than are personal data. All candidates of
a stretch, overlapping as they may, make a lattice; the model in :mod:`distriq.llm.pii` finds the best path through it.
Features describe a candidate as a whole, and the words around it.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache
from typing import NamedTuple

KINDS = ("EMAIL", "PHONE", "ID_NUMBER", "ADDRESS", "NAME")


class Candidate(NamedTuple):
    start: int
    end: int
    kind: str
    features: tuple[str, ...]


# Given names common in English and French, as a hint, not as a condition.
GIVEN = frozenset(
    """adam adele adrien aisha alain alan albert alex alexander alexandre alice alison amanda amelie amina amy ana anais andre andrea andrew angela anita
    ann anna anne anthony antoine arthur audrey barbara benjamin benoit bernard brian bruno camille carl carla carlos carol caroline catherine cecile charles
    charlotte chloe chris christine claire clara claude daniel david deborah denis diana diane dominic donald dorothy edward elena elise elizabeth eloise emily emma
    eric ethan etienne eva felix florence frances francis francois frank gabriel genevieve george gerard grace guillaume hannah harry helen helene henri henry hugo
    ian ines ingrid irene isabelle jack jacques james jane jason jean jean-paul jennifer jessica joan john jonathan jose joseph juan julia julie julien karen
    karim kate kevin laura laurent leila leo lewis linda lisa louis louise luc lucas lucy luis lynn madeleine marc margaret maria marie mark martin mary mathieu
    maya michael michel mireille mohamed monique nadia nancy naomi nathalie nicole nina noah nora olivia omar oscar pascal patricia patrick paul peter philip
    pierre priya rachel rebecca rene richard robert rosa ruth samuel sandra sarah sebastien simon sofia sophie stephanie steven susan sylvie theo theresa thomas
    valerie victor victoria vincent wei william xavier yasmin yves zoe""".split()
)
# Words that stand in names of firms, funds, documents and places more than in those of people: a hint.
OTHER = frozenset(
    """fund funds etf trust company index indices group benchmark exchange services service board commission securities bond equity income dividend bank capital corp
    corporation inc ltd llc limited partners holdings association agency authority department office desk plan series class portfolio total select global growth value
    core cap small real asset balanced floating rate short duration preferred share covered call monthly infrastructure quarterly
    street st avenue ave road rd lane drive dr court way crescent boulevard blvd place main wall
    city falls lake port mount river valley island beach saint sainte north south east west new
    press release notice filing form review queue item transcript letter distribution history record payable date amount ex-date record market data note gold tax return notice
    united states canada québec quebec ontario""".split()
)
# Words that begin sentences or head texts: a hint.
BREAKING = frozenset(
    """the a an of this that these those and or if when while after before under over for from to in on at by with as is it its was were be not no
    le la les un une des du de et ou si à au aux par pour sur dans sous hors tandis que pendant comme lorsque selon vu après avant chez date
    management expects ticker ex-date because rule section sources source figures units past read rounding see control analysts contact reinvestment
    us ca usd cad nav cusip cik sin ssn nas id url html pdf form etf fund trust
    dear reviewer moderator operator beneficiary requester phone mail fax text call cheques deliveries return reply questions please signed signé copie écrire retourner composer joint per
    we our your you he she they
    monday tuesday wednesday thursday friday saturday sunday""".split()
)
# Months, of which some are given names.
MONTHS = frozenset(
    """january february march april may june july august september october november december
    janvier fevrier mars avril mai juin juillet aout septembre octobre novembre decembre""".split()
)
# Forms of address.
TITLES = frozenset("mr mrs ms miss mx dr prof sir me m mm mme mmes mlle monsieur madame mademoiselle docteur maître maitre professor".split())



def _class_of(*categories: str) -> str:
    """The members of Unicode categories in the basic plane, as ranges of a pattern's character class."""
    members = [c for c in range(0x10000) if unicodedata.category(chr(c)) in categories]
    begins = [c for i, c in enumerate(members) if not i or members[i - 1] != c - 1]
    ends = [c for i, c in enumerate(members) if i == len(members) - 1 or members[i + 1] != c + 1]
    return "".join(f"\\u{x:04x}-\\u{y:04x}" for x, y in zip(begins, ends))


# of all scripts that have capitals; marks, as names may be written with combining accents
_UPPER = _class_of("Lu", "Lt")
_LETTER = _class_of("Lu", "Lt", "Ll", "Lm", "Lo", "Mn")
# Words in small letters between the parts of a family name.
PARTICLES = "de la le les du des da das do dos di del della den der van von vom zu zum zur ter ten te af av al el bin ibn ben abu y e".split()
_B = "[ \\t\xa0\u2009\u202f]"
_HYPHENED = rf"(?:-[{_LETTER}][{_LETTER}'’]*[{_LETTER}])*"
_DOTTED = rf"\.(?:-[{_UPPER}]\.)?[ \xa0]?"
# patterns begin with the letters or digits that can be first, and look back from there: so they are searched for fastest
_FREE = rf"(?:(?<![\w@/.’'-][{_UPPER}])|(?<=\b[dlDL]['’][{_UPPER}]))"
_INITIALS = rf"{_DOTTED}(?:[{_UPPER}]{_DOTTED}){{0,2}}(?=[ \xa0]?(?:[{_UPPER}]|(?:{'|'.join(PARTICLES)})[ \xa0]))"
_TOKEN = re.compile(rf"[{_UPPER}]{_FREE}(?:(?P<i>{_INITIALS})|(?:[{_LETTER}'’]*[{_LETTER}])?{_HYPHENED}(?![\w@/]|[’'-]\w))")
_WHITE = " \t\xa0\u2009\u202f\r\n"
_PARTICLE_HEADS = frozenset(p[0] for p in PARTICLES)
_PARTICLE_GAP = re.compile(rf"(?:{_B}|\r?\n)*(?P<p>(?:(?:{'|'.join(PARTICLES)})(?:{_B}|\r?\n)+){{1,3}}(?:[dl]['’])?|[dl]['’])")

_SEP = r"[  .\-‐-–]"
_PHONE = (
    rf"\+\d{{1,3}}(?:{_SEP}?\(?\d{{1,4}}\)?){{2,5}}"
    rf"|(?:1{_SEP}?)?\(?\d{{3}}\)?{_SEP}{{0,2}}\d{{3}}{_SEP}?\d{{4}}"
)
_ID = rf"\d{{3}}{_SEP}?\d{{2}}{_SEP}?\d{{4}}|\d{{3}}{_SEP}?\d{{3}}{_SEP}?\d{{3}}|[A-Z]{{1,2}}[ -]?\d{{6,9}}"
_NUMBERS = {
    "PHONE": re.compile(rf"(?=[\d+(])(?<![\w+/(])(?<!\d[.,\-])(?<!\d\()(?:{_PHONE})(?!\w|[-/]\d|\.\d)"),
    "ID_NUMBER": re.compile(rf"(?=[\dA-Z])(?<![\w+/])(?<!\d[.,\-])(?:{_ID})(?!\w|[-/]\d|\.\d)"),
}
_EXTENSION = re.compile(r"[  ]*,?[  ]*(?:ext\.?|x|poste|extension)[  ]*\d{1,6}\b", re.IGNORECASE)

_AT = re.compile(r"@|[(\[{][ ]?(?:at|arobase|chez|à)[ ]?[)\]}]|(?<=[ \n])(?:at|arobase)(?=[ \n]+[\w-]+(?:[ \n]+(?:dot|point)[ \n]+[\w-]+)+)", re.IGNORECASE)
_DOT = r"(?:\.|[ ]?[(\[{][ ]?(?:dot|point)[ ]?[)\]}][ ]?|[ \n]+(?:dot|point)[ \n]+)"
_DOMAIN = re.compile(rf"[ \n]*[^\W_][\w-]*(?:{_DOT}[^\W_][\w-]*)+", re.IGNORECASE)

_TYPES = r"Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Court|Ct|Way|Crescent|Cres|Boulevard|Blvd|Place|Pl|Terrace|Terr|Square|Sq|Trail|Parkway|Pkwy|Highway|Hwy|Circle|Close|Row|Alley|Quay"
_VOIES = r"rue|avenue|boulevard|chemin|place|all[ée]e|route|impasse|quai|cours|square|mont[ée]e|rang|c[ôo]te|sentier|ruelle"
_S = r"[  \n]+"
_HOUSE = rf"\d(?<![\w.,/$-]\d)\d{{0,5}}[A-Za-z]?(?:[ ]?[-–/][ ]?\d{{1,6}}[A-Za-z]?)?(?:{_S}(?:bis|ter))?"
_WAY = rf"(?P<type>(?:{_TYPES}|{_TYPES.upper()})(?![{_LETTER}])\.?)"
_DIRECTION = rf"(?:(?:[NSEWO]\.?|[NS][EW]\.?|North|South|East|West|NORTH|SOUTH|EAST|WEST){_S})?"
_NAMED = rf"(?:(?:\d{{1,4}}(?:st|nd|rd|th|ST|ND|RD|TH)|[{_UPPER}][\w'’.-]*){_S}){{1,4}}?{_WAY}"
_VOIE = rf"(?:{_VOIES}|{_VOIES.upper()}|{_VOIES.title().replace('[É', '[é')})(?![{_LETTER}]){_S}(?:(?:de{_S}la|de|du|des|la|le|les|DE{_S}LA|DE|DU|DES|LA|LE|LES){_S}|(?:de{_S})?[lLdD]['’])?[{_UPPER}][\w'’-]*(?:{_S}[{_UPPER}][\w'’-]*)?"
_STREET = re.compile(rf"(?P<house>{_HOUSE})[ ]?,?{_S}(?:{_DIRECTION}{_NAMED}|{_VOIE})")
_UNIT = rf"(?:[ ]?,?{_S}(?:Apt|Apartment|Suite|Ste|Unit|app|appt|bureau|bur|unit[ée])\.?{_S}\#?\w+|[ ]?,?{_S}\#[ ]?\w+)"
_POSTAL = r"\d{5}(?:-\d{4})?|[A-Z]\d[A-Z][ ]?\d[A-Z]\d"
_CITY = rf"(?:[ ]?,{_S}|\n)[{_UPPER}][{_LETTER}'’-]*(?:[  ][{_UPPER}][{_LETTER}'’-]*)?"
_TAIL = re.compile(rf"(?P<unit>{_UNIT})?(?P<city>{_CITY}(?:(?:,{_S}[A-Z]{{2}}|{_S}\([^()\n]{{2,30}}\))(?:{_S}(?:{_POSTAL}))?)?)?")


@lru_cache(maxsize=200_000)
def folded(word: str) -> str:
    """Lower case, without accents."""
    low = word.lower()
    return low if low.isascii() else "".join(c for c in unicodedata.normalize("NFKD", low) if not unicodedata.combining(c))


@lru_cache(maxsize=200_000)
def _tidy(word: str) -> str:
    low = folded(word.strip("\"'«»()[]{}<>*_;,"))
    return "9" if any(c.isdigit() for c in low) else low[:16]


def _words_before(text: str, start: int) -> tuple[str, str]:
    """The two words before a place, '' for none."""
    words = text[max(0, start - 48) : start].split()
    return words[-2] if len(words) > 1 else "", words[-1] if words else ""


def _word_at(text: str, end: int) -> str:
    """The word from a place on, '' for none."""
    words = text[end : end + 32].split(None, 1)
    return words[0] if words else ""


@lru_cache(maxsize=200_000)
def _before(two: str, one: str) -> tuple[str, str]:
    """The two words before a segment as features have them; of a sentence that ends there only that it does."""
    if one and one[-1] in ".!?" and len(one) > 3 and folded(one[:-1]) not in TITLES:
        two, one = "", "."  # whatever ended the sentence before
    return _tidy(two), _tidy(one) if one else "^"


def around(text: str, start: int, end: int) -> tuple[str, str, str, str, str]:
    """The two words before, the one after, and the characters that touch the segment."""
    after = _word_at(text, end)
    return *_before(*_words_before(text, start)), _tidy(after) if after else "$", text[start - 1 : start], text[end : end + 1]


def _context(text: str, start: int, end: int, kind: str) -> list[str]:
    two, one, after, left, right = around(text, start, end)
    return [f"{kind}", f"{kind}|p={one}", f"{kind}|pp={two} {one}", f"{kind}|n={after}", f"{kind}|l={'' if left.isspace() else left}", f"{kind}|r={'' if right.isspace() else right}"]


def _digits(span: str) -> str:
    return re.sub(r"[A-Za-z]", "A", re.sub(r"\d", "9", span))


#: Where a number may be: stretches of digits and what stands between them, which a pattern finds fast; and room for what
#: the patterns look at around it.
_ZONE = re.compile(rf"[+(\d](?:[\d()+]|{_SEP}){{5,}}")
_ROOM = 4


def numbers(text: str) -> list[Candidate]:
    out = []
    zones: list[list[int]] = []
    for m in _ZONE.finditer(text):
        start, end = max(0, m.start() - _ROOM), m.end() + _ROOM
        if zones and start <= zones[-1][1]:
            zones[-1][1] = end
        else:
            zones.append([start, end])
    for kind, pattern in _NUMBERS.items():
        for m in (m for start, end in zones for m in pattern.finditer(text, start, end)):
            start, end = m.span()
            if kind == "PHONE":
                if (more := _EXTENSION.match(text, end)) is not None:
                    end = more.end()
                if text.count("(", start, end) != text.count(")", start, end):
                    continue
            out.append(Candidate(start, end, kind, (*_context(text, start, end, kind), f"{kind}|s={_digits(m.group())}", f"{kind}|b={m.group()[0] in '+('}", f"{kind}|bare={m.group().isdigit()}")))
    return out


_LOCAL_LETTERS = frozenset(".+%'-_")
_WRITTEN_DOT = re.compile(r"([^\W_][\w+%'-]*)(?:[ ]?[(\[{][ ]?(?:dot|point)[ ]?[)\]}][ ]?|[ \n]+(?:dot|point)[ \n]+)$", re.IGNORECASE)


_SIGN = re.compile("@")
_DOT_WORD = re.compile(r"[ \n](?:dot|point)[ \n]")
_BRACKETED = re.compile(r"[(\[{][ ]?(?:at|arobase|chez|à)[ ]?[)\]}]")


def _local_start(text: str, end: int) -> int:
    """Where the part of an address before its at begins, with the written dots in it; ``end`` if there is none."""
    begin = end
    while True:
        start = end
        while start and (text[start - 1].isalnum() or text[start - 1] in _LOCAL_LETTERS):
            start -= 1
        # a mark at the beginning belongs to what is before
        while start < end and text[start] in _LOCAL_LETTERS and text[start] != "_":
            start += 1
        if start == end:
            return begin
        begin = start
        dot = _WRITTEN_DOT.search(text, max(0, start - 64), start)
        if dot is None:
            return begin
        end = dot.end(1)


def emails(text: str) -> list[Candidate]:
    low = text.lower()
    # an address has the sign, brackets around its word, or the words for its dots
    written = ("dot" in low or "point" in low) and _DOT_WORD.search(low) is not None or _BRACKETED.search(low) is not None
    if not written and "@" not in text:
        return []
    out = []
    for m in (_AT if written else _SIGN).finditer(text):
        domain = _DOMAIN.match(text, m.end())
        if domain is None:
            continue
        gap = m.start() > 0 and text[m.start() - 1] in " \n"
        if m.group() == "@" and not gap and text[m.end() : m.end() + 1].isspace() and "." not in domain.group():
            continue
        end = m.start() - gap
        start = _local_start(text, end)
        if start < end:
            kind = "EMAIL"
            how = "@" if m.group() == "@" else "()" if not m.group().isalpha() else "word"
            out.append(Candidate(start, domain.end(), kind, (*_context(text, start, domain.end(), kind), f"{kind}|at={how}", f"{kind}|gap={gap}")))
    return out


def addresses(text: str) -> list[Candidate]:
    out = []
    cores = [(m.start(), m.end(), len(m.group("house")), folded((m.group("type") or "fr").rstrip("."))) for m in _STREET.finditer(text)]
    for start, core, house, street in cores:
        tail = _TAIL.match(text, core)
        ends = {core: "core"}
        if tail is not None and tail.group("unit"):
            ends[tail.end("unit")] = "unit"
        if tail is not None and tail.group("city"):
            ends[tail.end("city")] = "city"
        for end, part in ends.items():
            kind = "ADDRESS"
            out.append(Candidate(start, end, kind, (*_context(text, start, end, kind), f"{kind}|part={part}", f"{kind}|street={street}", f"{kind}|h={_digits(text[start : start + house])}")))
    return out


class Token(NamedTuple):
    """A capitalised word or initials in a run. ``after``: what stands before it there, "" for blanks, "," or "p" for particles."""

    start: int
    end: int
    word: str
    kind: str
    after: str
    particles: int  # where the particles before it begin


@lru_cache(maxsize=100_000)
def _kind(word: str) -> str:
    """G, a common given name; M, a month; B, a word that begins sentences; O, one of firms and places; T, a form of address; else W."""
    low = folded(word)
    if low in GIVEN or low.split("-")[0] in GIVEN:
        return "G"
    if low.rstrip(".") in TITLES:
        return "T"
    plain = word.lower()
    return "M" if low in MONTHS else "B" if low in BREAKING or plain in BREAKING else "O" if low in OTHER or plain in OTHER else "W"


def _runs(text: str) -> list[list[Token]]:
    """Maximal runs of capitalised words and initials, with particles, or once a comma, between them."""
    runs: list[list[Token]] = []
    current: list[Token] = []
    for m in _TOKEN.finditer(text):
        start, initials = m.start(), m.group("i") is not None
        word = m.group().rstrip()
        after, particles = "", start
        if current:
            end = current[-1].end
            between = text[end:start]
            if between != " ":
                core = between.strip(_WHITE)
                if core == ",":
                    after = "|" if current[-1].after == "," or between[-1:] == "," else ","
                elif core:
                    found = _PARTICLE_GAP.fullmatch(between) if core[0] in _PARTICLE_HEADS and len(core) < 24 else None
                    after, particles = ("p", end + found.start("p")) if found else ("|", start)
                elif between.count("\n") > 1:
                    after = "|"
            if after == "|":
                runs.append(current)
                current, after = [], ""
        current.append(Token(start, start + len(word), word, "I" if initials else _kind(word), after, particles))
    if current:
        runs.append(current)
    return runs


@lru_cache(maxsize=100_000)
def _case(word: str) -> str:
    """Whether a word is in capitals: C, c, or - for none or a number."""
    return "C" if word.isupper() and len(word) > 1 and word.isalpha() else "c" if any(ch.islower() for ch in word) else "-"


class Floor:
    """The least that a name's score can be and still count in a best labelling, and what features not yet known could add.

    Leaving out a candidate costs its own score and its links' and may add a link of those beside it, so one below the
    least is on no best path, and leaving it out of the lattice changes no result.
    """

    def __init__(self, weights: dict[str, float]) -> None:
        links = [w for f, w in weights.items() if ">" in f and "|" not in f]
        self.weights = weights
        self.least = min([0.0, *links]) - 2 * max([0.0, *links])
        best: dict[str, float] = {}
        for f, w in weights.items():
            family = f.split("=")[0]
            best[family] = max(best.get(family, 0.0), w)
        self.rest = sum(best.get(f"N|{family}", 0.0) for family in ("pn", "around", "lr", "lc"))

    @lru_cache(maxsize=100_000)
    def score(self, *features: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features)

    def excludes(self, *parts: tuple[str, ...]) -> bool:
        return sum(self.score(*p) for p in parts) + self.rest < self.least


#: Capitalised words and initials of a name, at most.
LONGEST = 7


@lru_cache(maxsize=100_000)
def _form(shape: str, title: bool, monsieur: bool, caps: str, left: str, right: str, size: int, broken: bool) -> tuple[str, ...]:
    """The features of a name that need no look around it."""
    return (
        "NAME", f"N|shape={shape}", f"N|title={title}", f"N|shape={shape}|title={title}", f"N|M={monsieur}", f"N|caps={caps}", f"N|more={left}{right}", f"N|more={left}{right}|{shape}",
        f"N|size={size}", f"N|first={shape[0]}", f"N|last={shape[-1]}", *(f"N|has={k}" for k in sorted(set(shape))), f"N|nl={broken}",
    )


@lru_cache(maxsize=100_000)
def _word_before(two: str, one: str) -> tuple[str, ...]:
    return f"N|p={one}", f"N|pp={two} {one}"


@lru_cache(maxsize=100_000)
def _word_after(word: str) -> tuple[str, ...]:
    return (f"N|n={word}",)


def names(text: str, floor: Floor | None = None) -> list[Candidate]:
    """Stretches of runs, and given names in small letters with the word after them. ``floor``: leaves out what can't be chosen."""
    out = _lower_names(text)
    for run in _runs(text):
        n = len(run)
        rights: dict[int, tuple[str, str, str]] = {}
        for i, first in enumerate(run):
            start = first.start
            title = i > 0 and run[i - 1].kind == "T" and first.after != ","
            if title and first.after == "p":
                start = first.particles
            mark = ""
            if not title and text[start - 1 : start] in _BLANKS and text[start - 2 : start - 1] == ".":
                words = text[max(0, start - 16) : start - 2].split()
                mark = words[-1] if words else ""
                title = folded(mark.strip(_OPENING)) in TITLES
            if n == 1 and not title:
                continue
            monsieur = first.word == "M." or title and mark[-1:] in ("M", "m")
            left_kind = run[i - 1].kind if i and first.after != "," else "-"
            left: tuple | None = None
            shape, caps, commas = "", "", 0
            for j in range(i + 1, min(n, i + LONGEST) + 1):
                last = run[j - 1]
                if j > i + 1:
                    if last.after == ",":
                        commas += 1
                        # a comma may stand once, after the first word
                        if j > i + 2 or commas > 1:
                            break
                    shape += last.after
                shape += last.kind
                if last.kind != "I":
                    caps += "C" if last.word.isupper() and len(last.word) > 1 else "c"
                if last.kind == "I" or (j == i + 1 and not title):
                    continue
                right = run[j] if j < n else None
                right_kind = right.kind if right and right.after != "," else "-"
                end = last.end
                form = _form(shape, title, monsieur, caps, left_kind, right_kind, j - i, "\n" in text[start:end])
                if left is None:
                    words = _words_before(text, start)
                    left = (*_before(*words), text[start - 1 : start].strip(), _case(words[1]))
                if j not in rights:
                    word = _word_at(text, end)
                    rights[j] = (_tidy(word) if word else "$", text[end : end + 1].strip(), _case(word))
                two, one, beside, left_case = left
                after, beyond, right_case = rights[j]
                before_it, after_it = _word_before(two, one), _word_after(after)
                if floor is not None and floor.excludes(form, before_it, after_it):
                    continue
                more = (
                    f"N|pn={one}|{after}", f"N|around={left_case}{right_case}|{caps}", f"N|lr={beside}|{beyond}",
                    f"N|lc={run[i - 1].word.isupper() if left_kind != '-' else '-'}{right.word.isupper() if right_kind != '-' else '-'}|{caps}",
                )
                out.append(Candidate(start, end, "NAME", (*form, *before_it, *after_it, *more)))
    return out


_BLANKS = (" ", "\xa0", "\n")
_OPENING = "\"'([{<«“‘*_-–—:;,/>"
# Given names that are also words written small.
WORDS_TOO = frozenset("mark grace frank jack carol rosa florence victor page chase drew dean".split()) & GIVEN
_SMALL = re.compile(r"(?<![\w@/.’-])(?<!-\n)[a-z]{3,}(?:-[a-z]+)?(?![\w@/’'-])")
_SMALL_REST = re.compile(rf"(?:[ \xa0][a-z]\.)?[ \xa0]((?:(?:{'|'.join(PARTICLES)})[ \xa0])*[^\W\d_A-Z][^\W\d_A-Z'’]+(?:-[^\W\d_A-Z]+)*)(?![\w@/])")


def _lower_names(text: str) -> list[Candidate]:
    """Given names written small, with the word after them."""
    out: list[Candidate] = []
    words = text.split()
    if GIVEN.isdisjoint(words) and GIVEN.isdisjoint([w.lstrip(_OPENING) for w in words if w[0] in _OPENING]):
        return out  # most texts, and without a pattern
    for m in _SMALL.finditer(text):
        if m.group() in GIVEN and (rest := _SMALL_REST.match(text, m.end())) is not None:
            two, one, after, _, _ = around(text, m.start(), rest.end())
            kind = _kind(rest.group(1).split()[-1])
            features = ("NAME", "S", f"S|given={m.group()}", f"S|word={m.group() in WORDS_TOO}|{kind}", f"S|family={folded(rest.group(1))[:16]}", f"S|kind={kind}", f"S|p={one}", f"S|pp={two} {one}", f"S|n={after}")
            out.append(Candidate(m.start(), rest.end(), "NAME", features))
    return out


def candidates(text: str, floor: Floor | None = None) -> list[Candidate]:
    """All candidates of a text, sorted by start and end. ``floor``: without names that can't be chosen, see :class:`Floor`."""
    out = names(text, floor) + numbers(text) + addresses(text) + emails(text)
    out.sort(key=lambda c: (c.start, c.end))
    return out


#: Two candidates further apart than this say nothing about each other.
REACH = 40


def clusters(found: list[Candidate]) -> list[list[Candidate]]:
    """Candidates that overlap or are within reach of each other, through others between them."""
    out: list[list[Candidate]] = []
    end = -REACH - 1
    for c in found:
        if c.start > end + REACH:
            out.append([])
        out[-1].append(c)
        end = max(end, c.end)
    return out


def link(before: Candidate, after: Candidate) -> tuple[str, ...]:
    """Features of two entities that follow each other within reach."""
    return (f"{before.kind}>{after.kind}",) if after.start - before.end <= REACH else ()
