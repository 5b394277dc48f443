"""Mixing sources to target weights.

Each source's documents, in a fixed order, make one long run of tokens, cut into blocks of a fixed length. The mixture
is a number of output shards of equally many slots. How many slots of a shard go to each source is a multinomial draw;
its probabilities are what each source still lacks of its share when the shard is drawn, so shards differ by chance and
the shares of the whole stay within one shard's chance of the weights. Slot k of a source is block p(k mod n) where p is
a pseudorandom permutation of the source's n blocks, another one for each time around; so no block is used more often
than times around. Slots and documents meet in a join on the block.

The total is the largest for which no source has to be repeated beyond its cap: the source that is scarcest for its
weight is used up but for chance.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from distriq.durable import durable

#: Documents are put in order in parts of about so many, so that no task orders a whole source.
PART_ROWS = 50_000


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Where the public tokenizer's file is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counter(path: str, pattern: str | None = None):
    """A pandas UDF that counts the tokens of texts; NULL and empty texts have none. Special tokens' strings are text."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for texts in batches:
            yield pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return count


def source_name(source: Column) -> Column:
    """Sources are the same whatever the case, surrounding blanks, and whether words are joined by blanks, dashes or underscores."""
    return F.regexp_replace(F.lower(F.regexp_replace(source, r"(?U)^\s+|\s+$", "")), r"(?U)[\s\-]+", "_")


def permuted(i: np.ndarray, n: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Element-wise p(i) for a pseudorandom permutation p of 0..n-1 that depends on ``seed``.

    A Feistel network of four rounds permutes the smallest square of a power of two that n fits in; results beyond n are
    permuted again until they are below, which ends, as i itself is on the cycle.
    """
    i, n, seed = i.astype(np.uint64), n.astype(np.uint64), seed.astype(np.uint64)
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2).astype(float)) / 2)).astype(np.uint64)
    # the logarithm of a large n may be rounded down
    half += ((np.uint64(1) << (half * np.uint64(2))) < n).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)

    def mixed(x: np.ndarray, s: np.ndarray, round_: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = (x + np.uint64(0x9E3779B97F4A7C15) * np.uint64(round_ + 1)) ^ s
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            return x ^ (x >> np.uint64(31))

    out = i.copy()
    todo = np.arange(len(i))
    while len(todo):
        h, m, s = half[todo], mask[todo], seed[todo]
        left, right = out[todo] >> h, out[todo] & m
        for round_ in range(4):
            left, right = right, left ^ (mixed(right, s, round_) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


#: Slots of a shard, at most, unless there are more than MOST_SHARDS; and shards, if there is enough to draw for each.
SHARD_SLOTS, FEWEST_SHARDS, MOST_SHARDS = 65_536, 64, 4096


@dataclass(frozen=True)
class Plan:
    """What was drawn: ``counts[shard, source]`` slots, the first of each shard's in the order of ``names``."""

    names: list[str]
    counts: np.ndarray

    @property
    def slots(self) -> dict[str, int]:
        return dict(zip(self.names, self.counts.sum(0).tolist()))


def draw_slots(supply: dict[str, int], block_tokens: int, weights: dict[str, float], caps: dict[str, int], shards: int | None, seed: int) -> Plan:
    """The sources' slots in each shard, drawn multinomially.

    ``supply``: tokens of each source. A slot counts as the mean size of its source's blocks, of which the last may be
    short. Sources without tokens, weight or permitted use get no slots; the other weights then count as if they summed
    to 1. A draw beyond a source's cap is cut there, and the slots go to the sources that lack most. ``shards``: as many
    as the total asks for if None. The table has as many entries as there are shards and sources, whatever the data.
    """
    names = sorted(s for s, w in weights.items() if supply.get(s, 0) > 0 and w > 0 and caps.get(s, 0) > 0)
    if not names:
        return Plan([], np.zeros((0, 0), np.int64))
    whole = sum(weights[s] for s in names)
    blocks = {s: -(-supply[s] // block_tokens) for s in names}
    total = min(supply[s] * caps[s] * whole / weights[s] for s in names)
    most = np.array([blocks[s] * caps[s] for s in names], np.int64)
    wanted = np.minimum(most, np.rint([total * weights[s] / whole * blocks[s] / supply[s] for s in names]).astype(np.int64))
    every = int(wanted.sum())
    if shards is None:
        shards = min(MOST_SHARDS, max(FEWEST_SHARDS, -(-every // SHARD_SLOTS)))
    shards = max(1, min(shards, every))
    rng, drawn = np.random.default_rng(seed), np.zeros(len(names), np.int64)
    counts = np.zeros((shards, len(names)), np.int64)
    for shard in range(shards):
        size = every * (shard + 1) // shards - every * shard // shards
        lacking = np.maximum(wanted - drawn, 0)
        if not lacking.sum():
            break
        here = np.minimum(rng.multinomial(size, lacking / lacking.sum()), most - drawn)
        while (left := size - int(here.sum())) > 0 and (room := most - drawn - here).any():
            at = int(np.argmax(np.where(room > 0, wanted - drawn - here, np.iinfo(np.int64).min)))
            here[at] += min(left, int(room[at]), max(1, int((wanted - drawn - here)[at])))
        counts[shard] = here
        drawn += here
    return Plan(names, counts)


_SLOT = "shard int, source_no int, block long"


def _slot_places(plan: Plan, blocks: list[int], seed: int):
    """A pandas UDF from the number of a slot to its shard, source and block; what was drawn goes with the function."""
    flat = plan.counts.ravel()
    begins = np.concatenate([[0], np.cumsum(flat)])  # of each shard and source among all slots
    own = np.concatenate([np.zeros((1, len(plan.names)), np.int64), np.cumsum(plan.counts, axis=0)])[:-1].ravel()  # among the source's
    sizes, n = np.array(blocks, np.int64), len(plan.names)

    @F.pandas_udf(_SLOT)
    def place(slots: pd.Series) -> pd.DataFrame:
        slot = slots.to_numpy()
        # of places with equal beginnings all but the last are empty
        at = np.searchsorted(begins, slot, "right") - 1
        shard, source = at // n, at % n
        k = own[at] + slot - begins[at]
        around = k // sizes[source]
        salt = (np.uint64(seed) * np.uint64(1_000_003) + source.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) ^ (around.astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        return pd.DataFrame({"shard": shard.astype(np.int32), "source_no": source.astype(np.int32), "block": permuted(k % sizes[source], sizes[source], salt)})

    return place


@dataclass(frozen=True)
class Mixture:
    documents: DataFrame
    shares: DataFrame
    blocks: DataFrame


def mix(documents: DataFrame, targets: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", source: str = "source", block_tokens: int = 256, shards: int | None = None, seed: int = 7) -> Mixture:
    """The mixture of ``documents`` that meets ``targets`` (source, target_weight, max_repeats; few rows).

    ``blocks`` of the result is the mixture itself: shard, slot (from 0 in the whole mixture, in the order of shards),
    source, block, doc_id, begin (the piece's first token in its document, from 0) and tokens; one row per piece of a
    document in a slot's block. ``documents``: doc_id, source, n_tokens, repeats (the most that any of its blocks is
    used, so at most max_repeats), used_tokens (over all uses; a document lies in several blocks, and of its first and
    last its own part counts), blocks, first_shard. One row per document used. ``shares``: source, target_weight,
    max_repeats, supply_tokens, used_tokens, actual_share, most_repeats, documents; one row per source of ``targets``
    and of ``documents``, with weight 0 if it isn't in ``targets``.

    Texts that are NULL or empty have no tokens and aren't chosen. A NULL source is the source ''. Repeated doc_ids are
    told apart by nothing and count as one document of all their tokens. A source's last block may be shorter. ``path``:
    the tokenizer's file. ``block_tokens``, ``shards`` and ``seed`` are the only choices; the same ones give the same result.
    """
    spark = documents.sparkSession
    ids = F.col(f"`{doc_id}`")
    counted = documents.select(ids.alias("doc_id"), F.coalesce(source_name(F.col(f"`{source}`")), F.lit("")).alias("source"), token_counter(path)(F.col(f"`{text}`")).alias("n_tokens"))
    counted = counted.groupBy("doc_id", "source").agg(F.sum("n_tokens").alias("n_tokens"))
    # tokens are counted once: totals, offsets and the join all start from here
    counted = durable(counted, "tokens")
    sums = counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")).collect()
    supply = {r["source"]: r["tokens"] for r in sums}
    counted = counted.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(1 + sum(r["rows"] for r in sums) // PART_ROWS)))
    parts = counted.groupBy("source", "part").agg(F.sum("n_tokens").alias("tokens"))
    wanted = [(r["name"], float(r["target_weight"] or 0), int(r["max_repeats"] or 0)) for r in targets.withColumn("name", F.coalesce(source_name(F.col("source")), F.lit(""))).collect()]
    plan = draw_slots(supply, block_tokens, {s: w for s, w, _ in wanted}, {s: c for s, _, c in wanted}, shards, seed)

    sizes = [-(-supply[s] // block_tokens) for s in plan.names]
    every = spark.range(int(plan.counts.sum())).withColumn("at", _slot_places(plan, sizes, seed)(F.col("id")) if plan.names else F.lit(None).cast("struct<shard:int,source_no:int,block:bigint>"))
    name = F.get(F.array(*(F.lit(s) for s in plan.names or [""])), F.col("at.source_no"))
    # never NULL, or the filters on NULL keys that joins add would work the places out once more
    slots = every.select(F.col("at.shard").alias("shard"), F.col("id").alias("slot"), F.coalesce(name, F.lit("")).alias("source"), F.coalesce("at.block", F.lit(-1)).alias("block"))
    uses = slots.groupBy("source", "block").agg(F.count(F.lit(1)).alias("uses"), F.min("shard").alias("first_shard"))

    # a document's place in its source: the tokens of the parts before its own, and of those before it there
    before = parts.selectExpr("source", "part", "sum(tokens) OVER (PARTITION BY source ORDER BY part) - tokens AS part_start")
    placed = counted.filter("n_tokens > 0").selectExpr("*", "sum(n_tokens) OVER (PARTITION BY source, part ORDER BY doc_id) - n_tokens AS inner_start").join(before, ["source", "part"])
    placed = placed.withColumn("start", F.col("part_start") + F.col("inner_start"))
    b = F.lit(block_tokens)
    pieces = placed.select("doc_id", "source", "n_tokens", "start", F.explode(F.sequence(F.expr(f"start DIV {block_tokens}"), F.expr(f"(start + n_tokens - 1) DIV {block_tokens}"))).alias("block"))
    begin = F.greatest(F.col("block") * b, F.col("start"))
    inside = F.least((F.col("block") + 1) * b, F.col("start") + F.col("n_tokens")) - begin
    pieces = pieces.withColumns({"begin": begin - F.col("start"), "tokens": inside})
    # neither side has a bound, so neither is to be broadcast
    chosen = pieces.join(uses.hint("merge"), ["source", "block"]).groupBy("doc_id", "source", "n_tokens").agg(
        F.max("uses").alias("repeats"), F.sum(F.col("tokens") * F.col("uses")).alias("used_tokens"), F.count(F.lit(1)).alias("blocks"), F.min("first_shard").alias("first_shard")
    )
    mixture = slots.hint("merge").join(pieces, ["source", "block"]).select("shard", "slot", "source", "block", "doc_id", "begin", "tokens")
    return Mixture(chosen, _shares(chosen, supply, wanted), mixture)


def _shares(chosen: DataFrame, supply: dict[str, int], wanted: list[tuple[str, float, int]]) -> DataFrame:
    known = {s for s, _, _ in wanted}
    rows = [(s, w, c, supply.get(s, 0)) for s, w, c in wanted] + [(s, 0.0, 0, n) for s, n in supply.items() if s not in known]
    sources = chosen.sparkSession.createDataFrame(rows, "source string, target_weight double, max_repeats int, supply_tokens long")
    used = chosen.groupBy("source").agg(F.sum("used_tokens").alias("used_tokens"), F.max("repeats").alias("most_repeats"), F.count(F.lit(1)).alias("documents"))
    total = used.agg(F.sum("used_tokens").alias("all_tokens"))
    return (
        sources.join(used, "source", "left")
        .join(F.broadcast(total), how="left")
        .select(
            "source", "target_weight", "max_repeats", "supply_tokens", F.coalesce("used_tokens", F.lit(0)).alias("used_tokens"),
            F.coalesce(F.col("used_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), F.coalesce("documents", F.lit(0)).alias("documents"),
        )
    )
