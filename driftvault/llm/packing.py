"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents become pieces of at most CAPACITY tokens. Full pieces fill a sequence alone; the others are dealt at
random into blocks of about BLOCK_BINS bins' tokens, and each block is packed on several islands. An island's population
are packings, which begin as best fits of the pieces in random and in loosely decreasing orders. A child takes whole well-filled bins of one parent, loses the other parent's bins that
hold any of the same pieces, and the pieces so displaced go to the fullest bin that has room. After each epoch an
island's best packing moves on to the next island. In the end the blocks' poorly filled bins are opened and their
pieces packed anew, together with those of other blocks.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from driftvault.llm.common import n_parts, stage

CAPACITY = 2048
#: A block's tokens fill about so many bins; it holds about BLOCK_ITEMS pieces at most.
BLOCK_BINS, BLOCK_ITEMS = 1000, 20_000
ISLANDS, EPOCHS, CHILDREN, POPULATION = 2, 3, 60, 8
#: Bins filled less than this are opened again for the second round, and one in so many of the others with them.
OPEN_BELOW, OPEN_ONE_IN = 0.98, 16
_PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long"


class FileTokenizer:
    """A byte-level BPE tokenizer file's ids for texts, as the library gives them with add_special_tokens=False: no
    special token is put around a text, but an added token's string within it has that token's id.

    Where ids follow the order of the merges, the file's own vocabulary gives the same ids through tiktoken at a
    fraction of the time. That is used for texts of Latin letters, where both libraries' character classes are
    known to agree and no added token's string occurs; all other texts go to the tokenizers library itself."""

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, self._added = file["model"], [t["content"] for t in file.get("added_tokens") or ()]
        plain = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
        others = (b for b in range(256) if b not in plain)
        byte_of = {c: b for b, c in {**plain, **{b: chr(256 + i) for i, b in enumerate(others)}}.items()}
        ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in model["vocab"].items() if all(c in byte_of for c in t) and not t.startswith("<|")}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        self._fast = None
        if merged == sorted(merged) and sorted(ranks.values()) == list(range(len(ranks))):
            self._fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self._fast is not None and _LATIN(text) and not any(t in text for t in self._added):
            return self._fast.encode_ordinary(text)
        return self._tokenizer.encode(text, add_special_tokens=False).ids


#: Only characters of the Latin blocks.
_LATIN = re.compile("[\x00-\u024f]*+").fullmatch
_TOKENIZERS: dict[str, FileTokenizer] = {}


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document of n tokens: full pieces, the first one shorter where n asks for it."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def _tokenise(path: str, capacity: int):
    """Identifiers stay as Arrow has them: beside nulls pandas would make doubles of them."""

    def task(batches):
        if path not in _TOKENIZERS:
            _TOKENIZERS[path] = FileTokenizer(path)
        tokenizer = _TOKENIZERS[path]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, of, rows = batch.slice(at, 256), [], []
                for k, text in enumerate(part.column(1).to_pylist()):
                    ids = np.array([*tokenizer.encode(text or ""), 0], "<u4")
                    cuts = cut(len(ids), capacity)
                    of += [k] * len(cuts)
                    rows += [(j, s, n, zlib.crc32(ids[s : s + n].tobytes())) for j, (s, n) in enumerate(cuts)]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(of)), *columns], names=[c.split()[0] for c in _PIECES.split(", ")])

    return task


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of each row of docs, with a row number `item`."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_tokenise(tokenizer, capacity), _PIECES)
    return stage(rows.withColumn("item", F.monotonically_increasing_id()), "pieces")


class Packing:
    """The bin of each item, and the room left in each bin."""

    def __init__(self, of, room, capacity: int, migrant: bool = False):
        self.of, self.room, self.migrant = np.asarray(of, np.int64), np.asarray(room, np.int64), migrant
        #: Fewer bins first; of as many, those that leave their room in few bins.
        self.fitness = -len(self.room), int(((capacity - self.room) ** 2).sum())

    @staticmethod
    def read(of, sizes: np.ndarray, capacity: int, migrant: bool = False) -> Packing:
        return Packing(of, capacity - np.bincount(of, sizes).astype(np.int64), capacity, migrant)


def best_fit(of: list[int], room: list[int], items: list[int], sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Puts items, in the order given, each into the fullest bin that has room, or into a new one."""
    free = sorted((r, k) for k, r in enumerate(room) if r)
    for item in items:
        size = sizes[item]
        at = bisect_left(free, (size, -1))
        if at < len(free):
            r, k = free.pop(at)
        else:
            r, k = capacity, len(room)
            room.append(capacity)
        of[item], room[k] = k, r - size
        if r > size:
            insort(free, (r - size, k))
    return of, room


def cross(one: Packing, other: Packing, sizes: np.ndarray, capacity: int, dice: np.random.Generator) -> Packing:
    """A child: well-filled bins of `other` are injected whole; bins of `one` that share a piece with them go, and so do
    its emptiest ones; what those held besides is placed by best fit, about the largest first."""
    n_other = len(other.room)
    order = np.argsort(other.room + dice.random(n_other) * 0.02 * capacity, kind="stable")
    order = order[: max(1, int(n_other * dice.uniform(0.1, 0.6)))]
    number = np.full(n_other, -1)
    number[order] = np.arange(len(order))
    injected = number[other.of]
    gone = np.zeros(len(one.room), bool)
    gone[one.of[injected >= 0]] = True
    gone[np.argsort(-one.room, kind="stable")[: max(1, len(one.room) // 50)]] = True
    renumbered = np.cumsum(~gone) - 1 + len(order)
    stays = ~gone[one.of]
    of = np.where(stays, renumbered[one.of], injected)
    displaced = np.flatnonzero(of < 0)
    displaced = displaced[np.argsort(-sizes[displaced] * dice.uniform(0.97, 1.0, len(displaced)), kind="stable")]
    room = np.concatenate([other.room[order], one.room[~gone]])
    return Packing(*best_fit(of.tolist(), room.tolist(), displaced.tolist(), sizes.tolist(), capacity), capacity, one.migrant or other.migrant)


class Epoch(NamedTuple):
    """What an island has after an epoch, best first; how many children there were, and how many came of migrants."""

    population: list[Packing]
    children: int
    of_migrants: int


def evolve(sizes: np.ndarray, population: list[Packing], seed, children: int, capacity: int = CAPACITY) -> Epoch:
    """One epoch of an island: each child takes the place of the worst packing that it betters. Begins with best-fit
    packings of pieces in random and in loosely decreasing orders; stops where no packing can have fewer bins."""
    dice, least = np.random.default_rng(seed), -(-int(sizes.sum()) // capacity)
    population = list(population)
    while len(population) < POPULATION:
        loose = sizes * dice.uniform(0.5 if len(population) % 2 else 0.0, 1.0, len(sizes))
        start = best_fit([-1] * len(sizes), [], np.argsort(-loose, kind="stable").tolist(), sizes.tolist(), capacity)
        population.append(Packing(*start, capacity))
    rank = lambda p: p.fitness
    population.sort(key=rank, reverse=True)
    born = of_migrants = 0
    while born < children and len(population[0].room) > least:
        a, b = sorted(dice.choice(len(population), 2, replace=False).tolist())
        child = cross(population[a], population[b], sizes, capacity, dice)
        born, of_migrants = born + 1, of_migrants + child.migrant
        if rank(child) > rank(population[-1]) and rank(child) not in map(rank, population):
            population[-1] = child
            population.sort(key=rank, reverse=True)
    return Epoch(population, born, of_migrants)


_STATE = "block long, island int, items array<long>, sizes array<int>, population array<array<int>>, children long, of_migrants long"


def _epoch(epoch: int, capacity: int, children: int):
    """From the second epoch on the first packing of a population is the migrant."""

    def task(frames):
        for frame in frames:
            out, born, of_migrants = [], [], []
            for row in frame.itertuples(index=False):
                sizes = np.asarray(row.sizes, np.int64)
                start = [Packing.read(p, sizes, capacity, migrant=epoch > 0 and k == 0) for k, p in enumerate(row.population)]
                done = evolve(sizes, start, [row.block, row.island, epoch], children, capacity)
                out.append([p.of.tolist() for p in done.population])
                born.append(row.children + done.children)
                of_migrants.append(row.of_migrants + done.of_migrants)
            yield frame.assign(population=out, children=born, of_migrants=of_migrants)

    return task


def evolved_blocks(items: DataFrame, seed: int, capacity: int = CAPACITY, islands: int = ISLANDS, epochs: int = EPOCHS, children: int = CHILDREN) -> DataFrame:
    """The islands of pieces (item, length), each shorter than capacity, after all epochs: the columns of _STATE. A
    block is a random set of pieces of bounded size, so no task holds more, and a state row is some kilobytes."""
    n_items, tokens = items.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    blocks = max(1, round(max(tokens / (capacity * BLOCK_BINS), n_items / BLOCK_ITEMS)))
    dealt = items.select(F.pmod(F.xxhash64(F.lit(seed), "item"), F.lit(blocks)).alias("block"), F.struct("item", "length").alias("x"))
    state = dealt.groupBy("block").agg(F.sort_array(F.collect_list("x")).alias("x"))
    state = state.select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.col("x.item").alias("items"), F.col("x.length").alias("sizes"),
        F.array().cast("array<array<int>>").alias("population"), F.lit(0).cast("long").alias("children"), F.lit(0).cast("long").alias("of_migrants"),
    )
    parts = max(n_parts(items.sparkSession), blocks * islands // 64)
    for epoch in range(epochs):
        if epoch:  # each island's best goes to the next one, in the place of that one's last
            best = state.select("block", ((F.col("island") + 1) % islands).cast("int").alias("island"), F.col("population")[0].alias("elite"))
            moved = F.array_distinct(F.concat(F.array("elite"), F.slice("population", 1, POPULATION - 1)))
            state = state.join(best, ["block", "island"]).withColumn("population", moved).drop("elite")
        state = state.repartition(parts, "block", "island").select(*[c.split()[0] for c in _STATE.split(", ")]).mapInPandas(_epoch(epoch, capacity, children), _STATE)
        state = stage(state, f"islands-{epoch}")
    return state


def pack_blocks(items: DataFrame, seed: int, capacity: int = CAPACITY, **islands: int) -> DataFrame:
    """(block, bin, item, length, offset, fill) of pieces (item, length): each block's best packing."""
    state = evolved_blocks(items, seed, capacity, **islands)
    n_bins = F.array_max(F.col("population")[0]) + 1
    best = state.groupBy("block").agg(F.min_by(F.struct("items", "sizes", F.col("population")[0].alias("of")), F.struct(n_bins, "island")).alias("p"))
    rows = best.select("block", F.explode(F.arrays_zip("p.items", "p.sizes", "p.of")).alias("x"))
    rows = rows.select("block", F.col("x.of").alias("bin"), F.col("x.items").alias("item"), F.col("x.sizes").alias("length"))
    bin_of = Window.partitionBy("block", "bin")
    before = F.sum("length").over(bin_of.orderBy("item").rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    return rows.withColumn("offset", before).withColumn("fill", F.sum("length").over(bin_of))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is empty: one piece, the final id 0 alone. Rows that repeat a doc_id are packed each for itself, a
    null doc_id stays null. Very long documents become many full pieces. An empty table gives an empty result;
    other columns are not looked at.
    """
    rows = pieces(docs, tokenizer, capacity)
    part = rows.filter(F.col("length") < capacity).select("item", "length")
    first = stage(pack_blocks(part, 1, capacity), "bins")
    well = (F.col("fill") >= OPEN_BELOW * capacity) & (F.pmod(F.xxhash64("block", "bin"), F.lit(OPEN_ONE_IN)) > 0)
    opened = stage(first.filter(~well).select("item", "length"), "opened")
    number = F.col("block") * (2 * BLOCK_ITEMS) + F.col("bin")
    first = first.filter(well).select("item", number.alias("sequence_id"), "offset")
    second = pack_blocks(opened, 2, capacity).select("item", (F.lit(1 << 60) + number).alias("sequence_id"), "offset")
    placed = first.unionByName(second)
    base = ["doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32"]
    full = rows.filter(F.col("length") == capacity).select(*base, (F.lit(1 << 61) + F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(rows.filter(F.col("length") < capacity).join(placed, "item").select(*base, "sequence_id", "offset"))
