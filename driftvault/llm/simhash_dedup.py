"""SimHash near-deduplication by covering locality-sensitive hashing.

Every bit position of a fingerprint has a vector of RADIUS + 1 bits, and every non-zero vector v makes one table
whose mask holds the positions with odd inner product with v. Whichever RADIUS or fewer positions two fingerprints
differ in, some v is orthogonal to all of them, so the two agree under that table's mask: no link can be missed. A
bucket with very many fingerprints is covered anew on the bits that its mask leaves out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftvault.llm.common import column, fresh, join_weighted, n_parts, stage

BITS, RADIUS, SHINGLE, SEED = 64, 4, 4, 42
#: Buckets with more different fingerprints than this are covered once more, on the bits that their mask leaves out.
HEAVY = 20_000
#: Buckets that leave no more bits than this have at most 2**12 fingerprints and are always searched as they are.
FEW_BITS = 12


def covering_masks(radius: int = RADIUS, positions=range(BITS)) -> list[int]:
    """The masks of the 2**(radius + 1) - 1 tables over some bit positions. The vectors of neighbouring positions run
    through all non-zero vectors in turn, so each mask holds about half of the positions."""
    n, positions = 2 ** (radius + 1) - 1, list(positions)
    vector = {bit: 1 + (i % n) for i, bit in enumerate(positions)}
    return [sum(1 << bit for bit in positions if (vector[bit] & v).bit_count() % 2) for v in range(1, n + 1)]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A text's SimHash: each bit is 1 if over half of the shingles' hashes have it; without words 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # on bytes both know ASCII only
    if not words:
        return 0
    body, size = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, view = xxhash.xxh64_intdigest, memoryview(body)
    hashes = np.fromiter((digest(view[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each of n nodes' components, with links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _spread(fp: np.ndarray, radius: int) -> np.ndarray:
    """The components of one bucket by spreading from fingerprint to fingerprint: each is looked at once and
    compared with those not reached yet, so a dense bucket costs far less than its pairs."""
    label, left = np.full(len(fp), -1), np.arange(len(fp))
    while len(left):
        root, front, left = left[0], left[:1], left[1:]
        label[root] = root
        while len(front) and len(left):
            now, front = front[:64], front[64:]
            near = (np.bitwise_count(fp[left][:, None] ^ fp[now][None, :]) <= radius).any(axis=1)
            hit, left = left[near], left[~near]
            label[hit] = root
            front = np.concatenate([front, hit])
        label[front] = root
    return label


def bucket_links(fp: np.ndarray, bucket: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected within each bucket; fp and bucket are sorted by bucket."""
    new = np.ones(len(bucket), bool)
    new[1:] = bucket[1:] != bucket[:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(bucket)))
    label = np.arange(len(fp))
    for s, n in zip(start[size > 64].tolist(), size[size > 64].tolist()):
        label[s : s + n] = s + _spread(fp[s : s + n], radius)
    at = np.flatnonzero(np.repeat((size > 1) & (size <= 64), size))  # all small buckets at once, neighbours at each distance
    links: list[tuple[np.ndarray, np.ndarray]] = []
    group, step = np.repeat(np.arange(len(size)), size), 1
    while len(at):
        at = at[at + step < len(fp)]
        at = at[group[at] == group[at + step]]
        hit = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= radius]
        links.append((hit, hit + step))
        step += 1
    if links:
        a, b = (np.concatenate(x) for x in zip(*links))
        if len(a):
            used, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
            label[used] = used[_components(len(used), ends[: len(a)], ends[len(a) :])]
    moved = np.flatnonzero(label != np.arange(len(label)))
    return fp[moved], fp[label[moved]]


def _is_heavy(rows: pd.DataFrame, heavy: int) -> bool:
    """Whether rows, all of one bucket, are to be covered once more."""
    return len(rows) > heavy and BITS - (int(rows["fixed"].iloc[0]) % 2**64).bit_count() > FEW_BITS


def _bucket_task(radius: int, heavy: int):
    def task(frames):
        """frames: (bucket, fp, fixed), sorted by the first two; a bucket may go on from one frame to the next. Rows
        out: links (a, b), and (a, null, bucket, fixed) for each member of a heavy bucket, which is never held."""
        held, over = pd.DataFrame({"bucket": [], "fp": [], "fixed": []}, dtype="int64"), None
        for frame in frames:
            rows = pd.concat([held, frame], ignore_index=True)
            bucket = rows["bucket"].to_numpy()
            if over is not None:
                n = int(np.searchsorted(bucket, over, side="right"))
                yield _left_over(rows.iloc[:n])
                rows, bucket = rows.iloc[n:], bucket[n:]
            if not len(rows):
                held = rows
                continue
            over = None
            cut = int(np.searchsorted(bucket, bucket[-1]))
            yield from _linked(rows.iloc[:cut], radius, heavy)
            held = rows.iloc[cut:]
            if _is_heavy(held, heavy):
                yield _left_over(held)
                held, over = held.iloc[:0], bucket[-1]
        yield from _linked(held, radius, heavy)

    return task


def _left_over(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"a": rows["fp"], "b": pd.array([None] * len(rows), "Int64"), "bucket": rows["bucket"], "fixed": rows["fixed"]})


def _linked(rows: pd.DataFrame, radius: int, heavy: int):
    if len(rows) > heavy:
        size = rows.groupby("bucket")["fp"].transform("size").to_numpy()
        free = BITS - np.bitwise_count(rows["fixed"].to_numpy("int64").view(np.uint64))
        large = (size > heavy) & (free > FEW_BITS)
        if large.any():
            yield _left_over(rows[large])
            rows = rows[~large]
    if len(rows):
        a, b = bucket_links(rows["fp"].to_numpy("int64").view(np.uint64), rows["bucket"].to_numpy("int64"), radius)
        nothing = pd.array([None] * len(a), "Int64")
        yield pd.DataFrame({"a": a.view(np.int64), "b": pd.array(b.view(np.int64), "Int64"), "bucket": nothing, "fixed": nothing})


def _cover_again(radius: int):
    """Members (a, bucket, fixed) of heavy buckets as rows (bucket, fp, fixed) of the tables that cover the bits which
    `fixed`, the mask of bits in which a bucket's members agree, leaves out."""

    def task(frames):
        for frame in frames:
            for fixed, rows in frame.groupby("fixed"):
                free = [i for i in range(BITS) if not int(fixed) >> i & 1]
                fp, bucket = (rows[c].to_numpy("int64").view(np.uint64) for c in ("a", "bucket"))
                for j, mask in enumerate(covering_masks(radius, free), 1):
                    with np.errstate(over="ignore"):
                        mixed = (bucket ^ np.uint64(j)) * np.uint64(0x9E3779B97F4A7C15) + (fp & np.uint64(mask)) * np.uint64(0xC2B2AE3D27D4EB4F)
                        mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                    both = np.uint64((int(fixed) % 2**64) | mask).view(np.int64)
                    yield pd.DataFrame({"bucket": mixed.view(np.int64), "fp": fp.view(np.int64), "fixed": np.full(len(fp), both)})

    return task


#: Rows of bucket and fingerprint that a task sorts on average.
TASK_ROWS = 2_000_000


def links(fps: DataFrame, radius: int = RADIUS, heavy: int = HEAVY) -> DataFrame:
    """(a, b) pairs of different fingerprints that connect exactly what links of `radius` bits or fewer connect.
    fps: column fp, each value once.

    The members of a bucket agree in its mask, so what they differ in lies in the other bits. Where a bucket is heavy,
    those are covered by tables of their own, and so on: each time about half of the bits is left, so after three
    times no bucket can be heavy.
    """
    spark = fps.sparkSession
    masks = np.array(covering_masks(radius), np.uint64).view(np.int64).tolist()
    tables = F.explode(F.array(*[F.struct(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))).alias("bucket"), F.lit(m).alias("fixed")) for i, m in enumerate(masks)]))
    level, pairs = fps.select("fp", tables.alias("t")).select("t.bucket", "fp", "t.fixed"), None
    parts = max(n_parts(spark), fps.count() * len(masks) // TASK_ROWS)
    while True:
        dealt = level.repartition(parts, "bucket").sortWithinPartitions("bucket", "fp").select("bucket", "fp", "fixed")
        found = stage(dealt.mapInPandas(_bucket_task(radius, heavy), "a long, b long, bucket long, fixed long").distinct(), "simhash-links")
        linked = found.filter("b IS NOT NULL").select("a", "b")
        pairs = linked if pairs is None else pairs.unionByName(linked)
        large = found.filter("b IS NULL")
        if large.isEmpty():
            return pairs.distinct()
        level = large.select("a", "bucket", "fixed").mapInPandas(_cover_again(radius), "bucket long, fp long, fixed long")


def connected(pairs: DataFrame) -> DataFrame:
    """(node, root) for every node of the links `pairs` (a, b); root is one node of its component, the same for all.

    Each round orders the nodes anew by a hash, points every node at the least among itself and its neighbours,
    and carries the links over to those; links whose ends meet vanish. A constant share of the nodes goes in a
    round on average, also from long chains, and the pointers of all rounds are followed back at the end.
    Neighbourhoods are combined before the shuffle, and the rows of hot nodes are joined without one.
    """
    edges, rounds = stage(pairs.select("a", "b"), "links"), []
    while total := edges.count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(rounds)), c), F.col(c).alias("node"))
        point = both.groupBy("a").agg(F.min(rank("b")).alias("near"), F.count("*").alias("n"))
        point = stage(point.select("a", F.least(rank("a"), "near")["node"].alias("to"), "n"), "pointers")
        rounds.append(point)
        at_a = join_weighted(edges, point.select("a", F.col("to").alias("new_a"), "n"), ["a"], "n", total).drop("n")
        at_b = join_weighted(at_a, point.select(F.col("a").alias("b"), F.col("to").alias("new_b"), "n"), ["b"], "n", total)
        moved = at_b.filter("new_a <> new_b").select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
        edges = stage(moved.distinct(), "links")
    out = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for point in reversed(rounds):  # what this round pointed at was itself pointed on in the later rounds, or stayed
        step = point.select(F.col("a").alias("node"), F.col("to").alias("mid"))
        weights = step.groupBy("mid").agg(F.count("*").alias("n"))
        later = stage(weights.join(out.withColumnRenamed("node", "mid"), "mid"), "roots")
        step = join_weighted(step, later, ["mid"], "n", step.count(), "left")
        out = step.select("node", F.coalesce("root", "mid").alias("root"))
    return out


def _components_of(docs: DataFrame, radius: int, heavy: int) -> DataFrame:
    """(doc_id, text_hash, fp, root, component) of every row of docs: root is one fingerprint of the row's component,
    component its smallest doc_id, as a struct in which null is the largest.

    Equal fingerprints are one node from the start, so a group of copies of any size is one row of the search.
    """
    identity = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"))
    rows = stage(docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), fingerprints("text").alias("fp")), "fingerprints")
    total = rows.count()
    nodes = stage(rows.groupBy("fp").agg(F.min(identity).alias("first_doc"), F.count("*").alias("n")), "fingerprint-nodes")
    roots = connected(links(nodes.select("fp"), radius, heavy))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    placed = stage(placed, "fingerprint-roots")
    least = placed.groupBy("root").agg(F.min("first_doc").alias("component"), F.count("*").alias("members"))
    of_fp = join_weighted(placed, least, ["root"], "members", nodes.count()).select("fp", "root", "component", "n")
    return join_weighted(rows, stage(of_fp, "fingerprint-components"), ["fp"], "n", total)


def dedup_near(docs: DataFrame, radius: int = RADIUS, heavy: int = HEAVY) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint, component_id.

    Texts without words (null, empty, white space) have fingerprint zero and link like any other. A null doc_id
    counts as larger than any other. Repeated rows share a fingerprint and so a component. An empty table gives
    an empty result; other columns are not looked at.
    """
    found = _components_of(docs, radius, heavy)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component.id").alias("component_id"))


def keep_near(docs: DataFrame) -> DataFrame:
    """One row of docs for each component, that with its smallest doc_id, with docs' own columns, whatever their
    names; the cases are dedup_near's. Of several rows with that doc_id one stays. docs is read a second time and
    joined with the kept (identifier, hash of text) pairs, of which there is one for each component."""
    no_id, key, text = fresh(docs, "_no_id", "_id", "_text")
    identity = [F.col("doc_id").isNull().alias(no_id), F.coalesce("doc_id", F.lit(0)).cast("long").alias(key)]
    found = _components_of(docs, RADIUS, HEAVY)
    first = found.groupBy("root").agg(F.min(F.struct(*identity, F.col("text_hash").alias(text))).alias("first")).select("first.*")
    own = [column(c) for c in docs.columns]
    keyed = docs.select(*own, *identity, F.xxhash64(F.coalesce("text", F.lit(""))).alias(text))
    return keyed.join(first, [no_id, key, text], "left_semi").dropDuplicates([no_id, key, text]).select(*own)
