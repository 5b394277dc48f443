"""Texts as streams of letters and digits, for matching that no markup, spacing or typography disturbs."""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np

TAG = re.compile(r"<!--.*?-->|</?[A-Za-z][^<>]*>", re.DOTALL)
_ODD = re.compile(r"[^\x00-\x7f]+")

#: Ends a text in a stream; no text holds it.
END = 0


def _plain(run: re.Match[str]) -> str:
    """Letters and digits of other scripts without accents, in one case; what is invisible is gone; all else is a blank."""
    out = []
    for ch in unicodedata.normalize("NFKD", run.group().casefold()):
        kind = unicodedata.category(ch)
        if kind[0] in "LN":
            out.append(ch)
        elif kind not in ("Mn", "Me", "Cf"):
            out.append(" ")
    return "".join(out)


def cleaned(text: str) -> str:
    """Without markup and character entities, in lower case and without accents; blanks and punctuation still there."""
    if "\0" in text:
        text = text.replace("\0", " ")
    if "<" in text:
        text = TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
        if "<" in text:
            text = TAG.sub(" ", text)
        text = text.replace("\0", " ")
    return text.lower() if text.isascii() else _ODD.sub(_plain, text).lower()


_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def stream(cleaned_texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends): letters and digits of all texts without a gap, each text closed by END.

    starts, ends: whether a byte is the first, the last of a run of them in its text. Other scripts are UTF-8 bytes,
    of which no two texts' boundaries fall inside a letter.
    """
    raw = np.frombuffer("\0".join([*cleaned_texts, ""]).encode("utf-8", "surrogatepass"), np.uint8)
    word, stop = _ALNUM[raw], raw == END
    before, after = np.empty_like(word), np.empty_like(word)
    before[:1], after[-1:] = False, False
    before[1:], after[:-1] = word[:-1], word[1:]
    keep = word | stop
    return raw[keep], (word & ~before)[keep], (word & ~after)[keep]


def words(text: str) -> list[bytes]:
    """The words of a text as they stand in a stream."""
    return [w.encode("utf-8", "surrogatepass") for w in re.findall(r"[^\W_]+", cleaned(text))]
