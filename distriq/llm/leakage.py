"""Evaluation texts leaking into training text, found with suffix arrays over the training text.

Each task turns its documents into one stream of letters and digits and sorts the stream's suffixes: its shard of the
suffix array. Every suffix of every test text is then looked up in every shard by binary search; the neighbours of its
place tell the longest verbatim match, and the range of suffixes that begin with its first words, their locations.

Of a shard only suffixes at a word's start are sorted, and of these only such as share their first eight bytes with a
test suffix: no others can match as many words as are asked for. Streams have no gaps, so a break inside a word, a
thousands separator or a missing blank hides nothing; a match must begin and end where words do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from distriq.llm.words import END, cleaned, stream, words

#: Bytes of text that one shard holds at most, unless a single document is longer.
SHARD_BYTES = 16 << 20
#: Test text beyond this many bytes is looked up in several passes over the corpus; a pass takes about ten times as much
#: memory in a worker, as each word of it is a suffix with a place and a head.
TEST_BYTES = 16 << 20
HEAD = 8


@dataclass
class Suffixes:
    """What is looked up: of each test text and word the first ``least`` words from there on, or the whole text if it has fewer.

    All words' letters lie one after the other in ``data``; a suffix is the number of its first word, and arrays tell the
    rest: where words begin (the next one where they end), their items, the first word of the item and the one after it.
    """

    data: bytes
    begin: np.ndarray
    item: np.ndarray
    first: np.ndarray
    last: np.ndarray
    suffix: np.ndarray
    size: np.ndarray
    heads: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[int, str]], least: int) -> Suffixes:
        parts, sizes, item, first, last, suffix, count = [], [0], [], [], [], [], []
        for number, text in items:
            found, at = words(text or ""), len(item)
            n = min(least, len(found))
            parts += found
            sizes += map(len, found)
            item += [number] * len(found)
            first += [at] * len(found)
            last += [at + len(found)] * len(found)
            if n:
                suffix += range(at, at + len(found) - n + 1)
                count += [n] * (len(found) - n + 1)
        data, begin = b"".join(parts), np.cumsum(sizes)
        start = np.array(suffix, np.int64)
        size = begin[start + np.array(count, np.int64)] - begin[start]
        # of suffixes shorter than a head only their own bytes count
        cut = (8 * np.maximum(HEAD - size, 0)).astype(np.uint64)
        heads = (_heads_at(np.frombuffer(data, np.uint8), begin[start]) >> cut) << cut
        order = np.argsort(heads, kind="stable")
        return cls(data, begin, np.array(item, np.int64), np.array(first, np.int64), np.array(last, np.int64), start[order], size[order], heads[order])

    def letters(self, i: int) -> bytes:
        """The letters of the i-th suffix."""
        at = int(self.begin[self.suffix[i]])
        return self.data[at : at + int(self.size[i])]


def _heads_at(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as a number that sorts as they do; 0 after the end."""
    out = np.zeros(len(at), np.uint64)
    padded = np.concatenate([text, np.zeros(HEAD, np.uint8)])
    for i in range(HEAD):
        out = (out << np.uint64(8)) | padded[at + i].astype(np.uint64)
    return out


def suffix_array(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """``at`` sorted by the suffixes that begin there, as far as ``depth`` bytes tell them apart.

    Eight bytes are sorted at a time; only suffixes that tie so far take part in the next step.
    """
    order = at[np.argsort(_heads_at(text, at), kind="stable")]
    key = _heads_at(text, order)
    same = np.concatenate([[False], key[1:] == key[:-1]]) if len(order) else np.empty(0, bool)
    group = np.cumsum(~same)
    for step in range(HEAD, depth, HEAD):
        tied = same.copy()
        tied[:-1] |= same[1:]
        where = np.flatnonzero(tied)
        if not len(where):
            break
        part = order[where]
        # past a text's end nothing follows: the stream's last bytes are END
        deeper = _heads_at(text, np.minimum(part + step, len(text)))
        inner = np.lexsort((deeper, group[where]))
        order[where] = part[inner]
        deeper, g = deeper[inner], group[where]
        still = np.zeros(len(order), bool)
        still[where[1:]] = (deeper[1:] == deeper[:-1]) & (g[1:] == g[:-1]) & (where[1:] == where[:-1] + 1)
        same = still
        group = np.cumsum(~same)
    return order


def _search(text: bytes, order: np.ndarray, needle: bytes, low: int, high: int, above: bool) -> int:
    """The first place in ``order``, from ``low`` to ``high``, whose suffix isn't smaller than ``needle``, or with ``above`` doesn't begin with it or a smaller text."""
    size = len(needle)
    while low < high:
        middle = (low + high) // 2
        here = text[order[middle] : order[middle] + size]
        if here < needle or (above and here == needle):
            low = middle + 1
        else:
            high = middle
    return low


def _longest(text: bytes, at: int, tests: Suffixes, word: int) -> int:
    """Words of the test text from ``word`` on that stand at ``at``, one after the other."""
    n = 0
    for w in range(word, int(tests.last[word])):
        begin, end = int(tests.begin[w]), int(tests.begin[w + 1])
        if text[at : at + end - begin] != tests.data[begin:end]:
            break
        at += end - begin
        n += 1
    return n


def shard_matches(ids: list[int], texts: list[str], tests: Suffixes) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, item, item word, words, letters before it in the document) of each match in one shard, the longest per document and item."""
    data, starts, ends = stream([cleaned(t) for t in texts])
    at = np.flatnonzero(starts)
    if not len(tests.suffix) or not len(at):
        return
    heads = _heads_at(data, at)
    place = np.searchsorted(tests.heads, heads)
    known = tests.heads[np.minimum(place, len(tests.heads) - 1)] == heads
    # a suffix shorter than a head is a prefix of what it matches: all heads from its own on to the last that begins so
    upper = tests.heads.copy()
    short = np.flatnonzero(tests.size < HEAD)
    upper[short] |= (np.uint64(1) << (8 * (HEAD - tests.size[short])).astype(np.uint64)) - np.uint64(1)
    for low, high in set(zip(tests.heads[short].tolist(), upper[short].tolist())):
        known |= (heads >= np.uint64(low)) & (heads <= np.uint64(high))
    order = suffix_array(data, at[known], int(tests.size.max()))
    sorted_heads = _heads_at(data, order)
    text = data.tobytes()
    stops = np.flatnonzero(data == END)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    # all suffixes' heads are searched at once; only those that stand in the shard are looked at one by one
    lows, highs = np.searchsorted(sorted_heads, tests.heads, "left"), np.searchsorted(sorted_heads, upper, "right")
    for i in np.flatnonzero(lows < highs).tolist():
        needle = tests.letters(i)
        low = _search(text, order, needle, int(lows[i]), int(highs[i]), False)
        high = _search(text, order, needle, low, int(highs[i]), True)
        word = int(tests.suffix[i])
        for position in order[low:high].tolist():
            if not ends[position + len(needle) - 1]:
                continue
            document = int(np.searchsorted(stops, position))
            item, place_in_item = int(tests.item[word]), word - int(tests.first[word])
            size = _longest(text, position, tests, word)
            begin = position - (int(stops[document - 1]) + 1 if document else 0)
            have = best.get((document, item))
            if have is None or (size, -place_in_item) > (have[0], -have[1]):
                best[(document, item)] = (size, place_in_item, begin)
    for (document, item), (size, word, begin) in best.items():
        yield ids[document], item, word, size, begin


MATCHES = "doc_id long, item_id long, item_word int, words int, letters_before int"


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "item_text", least: int = 13) -> DataFrame:
    """One row per document and test item of which ``least`` consecutive words, or the whole item if it has fewer, stand in the document.

    Columns: doc_id, item_id; of the longest match item_word (from 0), words, and letters_before, the letters and digits
    before it in the document. NULL or empty texts, and items without a word, match nothing. Of items with the same text
    each is reported. A document that comes twice with one id may be reported twice.

    The test texts are read on the driver and sent to every task; beyond TEST_BYTES they are looked up in several
    passes, so what is sent has a bound, whatever their number. The corpus isn't shuffled.
    """
    spark = documents.sparkSession
    corpus = documents.select(F.col(f"`{doc_id}`").cast("long").alias("d"), F.col(f"`{text}`").alias("t")).filter(F.length("t") > 0)
    passes: list[DataFrame] = []
    part: list[tuple[int, str]] = []
    size = 0
    rows = items.select(F.col(f"`{item_id}`").cast("long"), F.col(f"`{item_text}`")).filter(F.length(item_text) > 0).toLocalIterator()
    for item, words_of in rows:
        part.append((item, words_of))
        size += len(words_of)
        if size > TEST_BYTES:
            passes.append(_pass(corpus, part, least))
            part, size = [], 0
    if part:
        passes.append(_pass(corpus, part, least))
    if not passes:
        return spark.createDataFrame([], MATCHES)
    out = passes[0]
    for more in passes[1:]:
        out = out.unionByName(more)
    return out


def _pass(corpus: DataFrame, part: list[tuple[int, str]], least: int) -> DataFrame:
    # worked out once, not in every task
    shared = corpus.sparkSession.sparkContext.broadcast(Suffixes.of(part, least))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tests = shared.value
        ids: list[int] = []
        texts: list[str] = []
        size = 0

        def shard() -> pd.DataFrame:
            return pd.DataFrame(list(shard_matches(ids, texts, tests)), columns=[c.split()[0] for c in MATCHES.split(", ")])

        for batch in batches:
            for d, t in zip(batch["d"].tolist(), batch["t"].tolist()):
                ids.append(d)
                texts.append(t)
                size += len(t)
                if size >= SHARD_BYTES:
                    yield shard()
                    ids, texts, size = [], [], 0
        if ids:
            yield shard()

    return corpus.mapInPandas(scan, MATCHES)


def without_leaks(documents: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents of which :func:`leaks` reported nothing; documents with a NULL id stay."""
    return documents.join(found.select(F.col("doc_id").alias(doc_id)).distinct(), doc_id, "left_anti")
