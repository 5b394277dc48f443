"""Prefix-tree hash forest on shared storage: signatures, sorted runs, and the range search in them.

An entry has a key that must agree and two coordinates that may differ a little: a day, by at most ``days``, and an
amount, by at most ``rate`` of the larger one. Its signature is the bits of both coordinates, each counted in units of
its tolerance, interleaved from coarse to fine. A prefix of a signature stands for a square of cells, and all signatures
that begin with it are one range in sorted order; cutting two bits off the end doubles the square's sides.

The forest has four trees: permutations of the entries sorted by signatures shifted by none or half a square of
:data:`CERTAIN` in either coordinate. An entry's matches are at most one unit away; in one of the trees, the square of
that level holds all of them, so one range of one tree is enough. Shorter squares hold some of them only. Entries that
are denser than the row groups of a run would have it read four times over; they look at up to four squares of the first
tree instead.

This module is run by Python workers: it reads runs where they lie, and of them only the row groups that a range meets.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSelector, FileSystem

#: Bit pairs cut off so that a prefix certainly holds all matches in one of the trees: a square of four units, shifted by two.
CERTAIN = 2
TREES = 4
#: Where coordinates count from, so that none is negative, and the bits of each.
ORIGIN, BITS = 1 << 21, 22
#: Entries of a task, at most, on which the recall of longer prefixes is measured.
SAMPLE = 1000


def unit_of(rate: float) -> float:
    """The logarithm of the largest ratio within tolerance, a little widened, so that rounding can't part two entries."""
    if not 1e-3 <= rate < 1:
        raise ValueError("rate is from 0.001 on and below 1")
    return -math.log1p(-rate) * (1 + 1e-9)


def cells(day: np.ndarray, amount: np.ndarray, days: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Both coordinates in units of their tolerances, from :data:`ORIGIN` on. An amount of 0 is at the origin."""
    size = np.abs(amount)
    logs = np.log(np.where(size == 0, 1.0, size))
    return np.floor_divide(day.astype(np.int64), days) + ORIGIN, np.floor(logs / unit_of(rate)).astype(np.int64) + ORIGIN


def interleaved(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The bits of both, those of ``x`` first."""
    out = np.zeros(len(x), np.int64)
    for bit in range(BITS):
        out |= (((x >> bit) & 1) << (2 * bit + 1)) | (((y >> bit) & 1) << (2 * bit))
    return out


def shifts(tree: int) -> tuple[int, int]:
    half = 1 << (CERTAIN - 1)
    return half * (tree & 1), half * (tree >> 1)


def holding_tree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The tree whose square of level CERTAIN around the cell holds all cells next to it, too."""
    side = 1 << CERTAIN

    def shifted(c: np.ndarray) -> np.ndarray:
        place = c % side
        return ((place == 0) | (place == side - 1)).astype(np.int64)

    return shifted(x) + 2 * shifted(y)


def searches(x: np.ndarray, y: np.ndarray, level: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(tree, entries, low, high): the ranges of signatures to look at, at ``level`` bit pairs cut off.

    At CERTAIN each entry has one, in the tree that holds all its matches; below it has one in every tree.
    """
    out = []
    own = holding_tree(x, y) if level >= CERTAIN else None
    for tree in range(TREES):
        at = np.arange(len(x)) if own is None else np.flatnonzero(own == tree)
        if len(at):
            dx, dy = shifts(tree)
            low = (interleaved(x[at] + dx, y[at] + dy) >> (2 * level)) << (2 * level)
            out.append((tree, at, low, low | ((1 << (2 * level)) - 1)))
    return out


def searches_in_one(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries, low, high): the ranges of one tree that hold all cells next to each entry: one to four squares of level CERTAIN."""
    more = [((c - 1) >> CERTAIN) != ((c + 1) >> CERTAIN) for c in (x, y)]
    everywhere = np.ones(len(x), bool)
    parts = []
    for dx, dy, there in ((-1, -1, everywhere), (1, -1, more[0]), (-1, 1, more[1]), (1, 1, more[0] & more[1])):
        at = np.flatnonzero(there)
        parts.append((at, interleaved(x[at] + dx, y[at] + dy) >> (2 * CERTAIN) << (2 * CERTAIN)))
    at, low = (np.concatenate(c) for c in zip(*parts))
    return at, low, low | ((1 << (2 * CERTAIN)) - 1)


Place = tuple[str, int]


@dataclass
class SortedFile:
    """One file of a tree: its row groups' bounds by key and signature, as its footer tells them."""

    data: pq.ParquetFile
    low: list[Place] = field(default_factory=list)
    high: list[Place] = field(default_factory=list)
    groups: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        names = [self.data.schema_arrow.names.index(c) for c in ("key", "code")]
        for g in range(self.data.metadata.num_row_groups):
            group = self.data.metadata.row_group(g)
            if not group.num_rows:
                continue
            key, code = (group.column(i).statistics for i in names)
            if key is None or not key.has_min_max:  # keys so long that the writer left their bounds out
                low, high = ("", -1), (chr(0x10FFFF), 1 << 62)
            else:
                one = key.min == key.max and code is not None and code.has_min_max
                low, high = (key.min, code.min if one else -1), (key.max, code.max if one else 1 << 62)
            # sorted, so no group begins before the one before it does
            self.low.append(max(low, self.low[-1]) if self.low else low)
            self.high.append(high)
            self.groups.append(g)
        for i in range(len(self.high) - 2, -1, -1):
            self.high[i] = min(self.high[i], self.high[i + 1])

    def meeting(self, lows: list[Place], highs: list[Place]) -> list[int]:
        """The row groups that may hold something of any of the ranges, which are sorted."""
        met = []
        for low, high, group in zip(self.low, self.high, self.groups):
            at = bisect_left(highs, low)
            if at < len(lows) and lows[at] <= high:
                met.append(group)
        return met


class SortedRun:
    """One tree of a run: files in the order of their names, which is that of their rows. Footers are read when they are needed."""

    def __init__(self, path: str) -> None:
        self.system, root = FileSystem.from_uri(path)
        found = self.system.get_file_info(FileSelector(root, allow_not_found=True))
        self.names = sorted(f.path for f in found if f.path.endswith(".parquet"))
        self.files: dict[int, SortedFile] = {}
        self.rows_read = 0

    def file(self, i: int) -> SortedFile:
        if i not in self.files:
            self.files[i] = SortedFile(pq.ParquetFile(self.system.open_input_file(self.names[i]), read_dictionary=["key"]))
        return self.files[i]

    def _first(self, low: Place) -> int:
        """The first file that may hold something from ``low`` on, by binary search; files without rows come nowhere."""
        begin, end = 0, len(self.names)
        while begin < end:
            middle = (begin + end) // 2
            at = middle
            while at < end and not self.file(at).high:
                at += 1
            if at < end and self.file(at).high[-1] < low:
                begin = at + 1
            else:
                end = middle
        return begin

    def has_fewer_groups(self, than: int, low: Place, high: Place) -> bool:
        """Whether the files that may hold something from ``low`` to ``high`` have fewer row groups; reads so many footers at most."""
        groups = 0
        for i in range(self._first(low), len(self.names)):
            file = self.file(i)
            if file.low and file.low[0] > high:
                break
            groups += len(file.groups)
            if groups >= than:
                return False
        return True

    def tables(self, lows: list[Place], highs: list[Place]) -> Iterator[pa.Table]:
        """All rows of the row groups that any of the ranges meets, in order, a table for each file. Ranges are sorted."""
        at, i = 0, self._first(lows[0]) if lows else len(self.names)
        while i < len(self.names):
            file = self.file(i)
            if not file.low:
                i += 1
                continue
            if file.low[0] > highs[-1]:
                break
            met = file.meeting(lows[at:], highs[at:])
            if met:
                table = file.data.read_row_groups(met, columns=["key", "code", "id", "day", "amount"])
                self.rows_read += len(table)
                yield table
            # the first range that may go on behind this file
            last = file.high[-1]
            at = bisect_left(highs, last, at)
            if at == len(highs):
                break
            i = i + 1 if lows[at] <= last else max(i + 1, self._first(lows[at]))

    def read(self, lows: list[Place], highs: list[Place]) -> pd.DataFrame:
        """The same rows as one frame."""
        parts = [table.to_pandas().astype({"key": object}) for table in self.tables(lows, highs)]
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"key": [], "code": [], "id": [], "day": [], "amount": []})

    def ranked(self, lows: list[Place], highs: list[Place], ranks: dict[str, int]) -> tuple[np.ndarray, ...] | None:
        """(place, id, day, amount) of the same rows whose keys have ``ranks``, in order; place: rank and signature as one number."""
        parts: list[list[np.ndarray]] = []
        for table in self.tables(lows, highs):
            rank = np.empty(len(table), np.int64)
            begin = 0
            for chunk in table.column("key").chunks:  # one for each row group, with the keys it has
                own = np.fromiter((ranks.get(k, -1) for k in chunk.dictionary.to_pylist()), np.int64, len(chunk.dictionary))
                rank[begin : begin + len(chunk)] = own[chunk.indices.to_numpy(zero_copy_only=False)] if len(own) else -1
                begin += len(chunk)
            kept = rank >= 0
            if kept.any():
                code, *rest = (table.column(c).to_numpy()[kept] for c in ("code", "id", "day", "amount"))
                parts.append([(rank[kept] << (2 * BITS)) | code, *rest])
        return tuple(np.concatenate(c) for c in zip(*parts)) if parts else None


def near(day: np.ndarray, amount: np.ndarray, other_day: np.ndarray, other_amount: np.ndarray, days: int, rate: float) -> np.ndarray:
    """Whether two entries are within tolerance, exactly."""
    return (np.abs(day - other_day) <= days) & (np.abs(amount - other_amount) <= rate * np.maximum(np.abs(amount), np.abs(other_amount)))


class Forest:
    """The runs of an index, to be searched by one task."""

    def __init__(self, paths: list[str], days: int, rate: float, recall: float) -> None:
        self.days, self.rate, self.recall = days, rate, recall
        self.runs = [[SortedRun(f"{path}/tree={t}") for t in range(TREES)] for path in paths]
        self.level = CERTAIN if recall >= 1 else None

    @property
    def rows_read(self) -> int:
        return sum(tree.rows_read for run in self.runs for tree in run)

    def matches(self, entries: pd.DataFrame, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``entries``, stored id) of all pairs within tolerance that share a prefix. ``entries``: key, day, amount, sorted by key."""
        key, day, amount = entries["key"].to_numpy(object), entries["day"].to_numpy(np.int64), entries["amount"].to_numpy(float)
        x, y = cells(day, amount, self.days, self.rate)
        known = {k: i for i, k in enumerate(sorted(set(key.tolist())))}
        rank = np.fromiter((known[k] for k in key.tolist()), np.int64, len(key))
        places, ids = [], []

        def ranges(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple:
            order = np.lexsort((low, rank[at]))
            at, low, high = at[order], low[order], high[order]
            return at, low, high, list(zip(key[at].tolist(), low.tolist())), list(zip(key[at].tolist(), high.tolist()))

        spread = one = None
        for run in self.runs:
            # where entries are denser than row groups each tree would be read as a whole: one of them is enough then
            if level >= CERTAIN and len(entries) and run[0].has_fewer_groups(len(entries), (key[0], -1), (key[-1], 1 << 62)):
                if one is None:
                    one = [(0, *ranges(*searches_in_one(x, y)))]
                wanted = one
            else:
                if spread is None:
                    spread = [(tree, *ranges(*found)) for tree, *found in searches(x, y, level)]
                wanted = spread
            for tree, at, low, high, lows, highs in wanted:
                stored = run[tree].ranked(lows, highs, known)
                if stored is None:
                    continue
                code, stored_id, stored_day, stored_amount = stored
                begin = np.searchsorted(code, (rank[at] << (2 * BITS)) | low, "left")
                count = np.searchsorted(code, (rank[at] << (2 * BITS)) | high, "right") - begin
                probe = np.repeat(at, count)
                hit = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
                good = near(day[probe], amount[probe], stored_day[hit].astype(np.int64), stored_amount[hit], self.days, self.rate)
                places.append(probe[good])
                ids.append(stored_id[hit[good]])
        if not places:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        pairs = np.unique(np.stack([np.concatenate(places), np.concatenate(ids)]), axis=1)
        return pairs[0], pairs[1]

    def widened(self, entries: pd.DataFrame) -> int:
        """How many bit pairs to cut off: one more at a time, until the recall measured on some entries reaches the target.

        The recall of a level is the share of what level CERTAIN finds; where that finds nothing, nothing is measured and
        CERTAIN is taken. A target of 1 is met by CERTAIN only, as no sample can vouch for it.
        """
        sample = entries.head(SAMPLE)
        whole = len(self.matches(sample, CERTAIN)[0])
        for level in range(CERTAIN):
            if whole and len(self.matches(sample, level)[0]) >= self.recall * whole:
                return level
        return CERTAIN

    def first(self, entries: pd.DataFrame) -> np.ndarray:
        """The smallest stored id that each entry matches, or -1."""
        out = np.full(len(entries), np.iinfo(np.int64).max)
        for part in range(0, len(entries), 1 << 16):  # so many keys have ranks that fit beside a signature
            chunk = entries.iloc[part : part + (1 << 16)]
            if self.level is None:
                self.level = self.widened(chunk)
            place, ids = self.matches(chunk, self.level)
            np.minimum.at(out, place + part, ids)
        out[out == np.iinfo(np.int64).max] = -1
        return out


def settled(entries: pd.DataFrame, first: np.ndarray, days: int, rate: float) -> np.ndarray:
    """``first`` with the matches among the entries themselves: one by one in the order of their ids, within whole keys.

    An entry that matches nothing accepted before it is accepted; the entries accepted lie in a dictionary of cells, of
    which nine can hold a match.
    """
    out = first.copy()
    x, y = cells(entries["day"].to_numpy(np.int64), entries["amount"].to_numpy(float), days, rate)
    keys, ids = entries["key"].tolist(), entries["id"].tolist()
    day, amount = entries["day"].tolist(), entries["amount"].tolist()
    x, y = x.tolist(), y.tolist()
    accepted: dict[tuple[str, int, int], list[int]] = {}
    around = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    for i in np.argsort(entries["id"].to_numpy(np.int64), kind="stable").tolist():
        if out[i] >= 0:
            continue
        key, best = keys[i], -1
        for dx, dy in around:
            for j in accepted.get((key, x[i] + dx, y[i] + dy), ()):
                if (best < 0 or ids[j] < best) and abs(day[i] - day[j]) <= days and abs(amount[i] - amount[j]) <= rate * max(abs(amount[i]), abs(amount[j])):
                    best = ids[j]
        if best >= 0:
            out[i] = best
        else:
            accepted.setdefault((key, x[i], y[i]), []).append(i)
    return out


def valued(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """(values, place): rows equal in key, day and amount as one value with their smallest id, and where each row's is.

    ``rows``: id, key, day, amount, sorted by key.
    """
    key, day, amount, ids = rows["key"].to_numpy(object), rows["day"].to_numpy(np.int64), rows["amount"].to_numpy(float), rows["id"].to_numpy(np.int64)
    number = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])]).astype(np.int64)
    order = np.lexsort((ids, amount, day, number))
    same = [c[order] for c in (number, day, amount)]
    new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in same], axis=0)])
    place = np.empty(len(rows), np.int64)
    place[order] = np.cumsum(new) - 1
    return rows.iloc[order[new]].reset_index(drop=True), place


def whole_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same rows, sorted by key, in frames that hold all rows of each of their keys."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        key = batch["key"].to_numpy(object)
        cut = int((key == key[-1]).argmax())
        if cut or held and held[-1]["key"].iloc[-1] != key[-1]:
            held.append(batch.iloc[:cut])
            yield pd.concat(held, ignore_index=True)
            held = []
        held.append(batch.iloc[cut:])
    if held:
        yield pd.concat(held, ignore_index=True)
