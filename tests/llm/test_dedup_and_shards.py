import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

from driftvault.llm import exact_dedup, line_dedup, sharding, simhash_dedup

SCHEMA = "doc_id long, text string, fp long, row string, kept string, key string"
ODD = [
    (1, "a  b\tc"), (2, "a b c"), (3, None), (4, ""), (5, " \n "), (6, "long " * 30_000), (7, "a b\nc"), (7, "a b\nc"), (None, "a b c"), (None, None),
    (8, "Same line of text\nother one here\nSame line of text"), (9, "same LINE of text  \nshort\n"), (10, "unique words stand here\n\n"), (2, "another text of two"),
]


def docs(spark, rows):
    """Documents with columns that clash with names that the operators use inside."""
    return spark.createDataFrame([(i, t, 1, "x", "y", "z") for i, t in rows], SCHEMA)


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def random_docs(seed=1, n=300):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice("ab cd ef gh".split()) for _ in range(rng.randrange(0, 4))) for _ in range(n)]
    return list(enumerate(texts)) + [(n + i, "hot  copy") for i in range(n // 2)]


def test_exact_dedup_against_brute_force(spark):
    for rows in (ODD, random_docs()):
        groups = defaultdict(list)
        for i, t in rows:
            groups[norm(t)].append(i)
        got = exact_dedup.dedup_exact(docs(spark, rows).repartition(13)).collect()
        assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
        sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
        kept = defaultdict(int)
        for r in got:
            ids = sha[r.text_sha256]
            known = [i for i in ids if i is not None]
            assert r.group_size == len(ids) and r.keep_id == (min(known) if known else None)
            kept[r.text_sha256] += r.kept
            assert not r.kept or r.doc_id == r.keep_id
        assert set(kept.values()) == {1}
        stays = exact_dedup.keep_exact(docs(spark, rows)).collect()
        assert len(stays) == len(groups) and stays[0].__fields__ == [c.split()[0] for c in SCHEMA.split(", ")]
    assert exact_dedup.dedup_exact(docs(spark, []).limit(0)).count() == 0
    assert exact_dedup.keep_exact(docs(spark, [])).count() == 0


def entries(rows):
    """(digest byte, length, identifier or None, row, n) as sorted run entries, not folded."""
    out = np.zeros(len(rows), exact_dedup._ENTRY)
    for e, (d, size, i, row, n) in zip(out, rows):
        e["key"] = bytes([d]) * 32 + size.to_bytes(4, "big") + bytes(7) + b"\x01"
        e["no_id"], e["id"], e["row"], e["n"] = i is None, i or 0, row, n
    return np.sort(out, order=["key", "no_id", "id", "row"])


def test_runs_are_merged_exactly():
    rng = random.Random(8)
    for k in (1, 2, 3, 8):
        rows = [[(rng.randrange(40), rng.randrange(3), rng.choice([None, *range(5), 2**63 - 1]), rng.randrange(1000), 1 + rng.randrange(3)) for _ in range(rng.randrange(1, 90))] for _ in range(k)]
        merged = exact_dedup.merge_runs([exact_dedup.fold(entries(r)) for r in rows])
        want = {}
        for d, size, i, row, n in (x for r in rows for x in r):
            best, total = want.get((d, size), ((2, 0, 0), 0))
            want[d, size] = min(best, (i is None, i or 0, row)), total + n
        got = {(e["key"][0], int.from_bytes(e["key"].ljust(44, b"\0")[32:36], "big")): ((bool(e["no_id"]), int(e["id"]), int(e["row"])), int(e["n"])) for e in merged}
        assert got == want and (merged["key"][1:] > merged["key"][:-1]).all()


def test_an_entry_joins_only_entries_of_its_length():
    a, b = exact_dedup.fold(entries([(1, 5, 7, 7, 1)])), exact_dedup.fold(entries([(1, 6, 3, 3, 1), (1, 6, 2, 9, 4)]))
    assert [(e["id"], e["row"], e["n"]) for e in exact_dedup.merge_two(a, b)] == [(7, 7, 1), (2, 9, 5)]


def test_the_largest_identifier_is_an_identifier(spark):
    rows = [(2**63 - 1, "x"), (None, "x"), (None, "y")]
    got = Counter((r.doc_id, r.keep_id, r.kept) for r in exact_dedup.dedup_exact(docs(spark, rows)).collect())
    assert got == {(2**63 - 1, 2**63 - 1, True): 1, (None, 2**63 - 1, False): 1, (None, None, True): 1}
    assert [r.component_id for r in simhash_dedup.dedup_near(docs(spark, [(2**63 - 1, "a b c d e"), (None, "a b c d e")])).collect()] == [2**63 - 1] * 2


def plain_jump(key, n):
    """The published algorithm, one key at a time."""
    b, j = -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = np.random.default_rng(1).integers(0, 2**63, 2000).astype(np.uint64)
    for n in (1, 2, 8, 9, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [plain_jump(int(k), n) for k in keys]


def test_sharding(spark):
    got = sharding.shard_documents(docs(spark, ODD + random_docs())).collect()
    assert len(got) == len(ODD) + len(random_docs())
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8) and r.law == "key"
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(8))
    assert {(r.size, r.text_crc32) for r in got if r.doc_id == 3} == {(1, 0)}
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    assert sharding.shard_documents(docs(spark, [])).count() == 0


def plain_line_dedup(rows):
    rows = [(i, t or "") for i, t in rows]
    key = lambda x: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", x).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    low = lambda i: -(2**63) if i is None else i
    holders = defaultdict(set)
    for i, t in rows:
        for x in t.split("\n"):
            if len(key(x)) >= 10:
                holders[key(x)].add(low(i))
    out = []
    for i, t in rows:
        lines = t.split("\n")
        keep = [x for x in lines if not (len(holders[key(x)]) > 1 and min(holders[key(x)]) != low(i))]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(2)
    pool = ["Hot line of the corpus", "  hot LINE of the corpus\t", "ÄÖ upper stays up", "short", "", "another repeated line", "tiny\r"] + [f"line number {k} " for k in range(60)]
    many = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 12)))) for i in range(200)]
    for rows in (ODD, many, [(1, None)]):
        got = line_dedup.dedup_lines(docs(spark, rows)).collect()
        assert Counter(map(tuple, got)) == Counter(plain_line_dedup(rows))
    assert line_dedup.dedup_lines(docs(spark, [])).count() == 0


def test_line_dedup_runs_no_python(spark):
    plan = line_dedup.dedup_lines(docs(spark, ODD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if w]
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def near_rows():
    rng = random.Random(4)
    base = [" ".join(rng.choice("alpha beta gamma delta eps zeta eta theta iota".split()) for _ in range(120)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(100):
        words = base[i % 5].split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((1000 + i, " ".join(words)))
    return rows + [(2000, None), (2001, ""), (2002, "one two"), (2003, "ONE  two"), (2004, "Ärger über ALLES"), (2005, "ärger über alles"), (2000, None), (2006, "w " * 50_000)]


def test_simhash_against_brute_force(spark):
    rows = near_rows()
    fps = [plain_fingerprint(t) for _, t in rows]
    least = {}
    for (i, _), c in zip(rows, plain_components(fps)):
        least[c] = min(least.get(c, i), i)
    want = Counter((i, f"{f:016x}", least[c]) for (i, _), f, c in zip(rows, fps, plain_components(fps)))
    for heavy in (20_000, 30):
        got = simhash_dedup.dedup_near(docs(spark, rows), heavy=heavy).collect()
        assert Counter(map(tuple, got)) == want
    kept = simhash_dedup.keep_near(docs(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(least.values()))
    assert simhash_dedup.dedup_near(docs(spark, [])).count() == 0
    assert [r.component_id for r in simhash_dedup.dedup_near(docs(spark, [(None, "a b c d")])).collect()] == [None]


def test_masks_cover_every_pair_within_the_radius():
    masks, rng = simhash_dedup.covering_masks(), random.Random(1)
    assert len(masks) == 31 and all(20 <= m.bit_count() <= 44 for m in masks)
    for _ in range(5000):
        flips = sum(1 << i for i in rng.sample(range(64), rng.randrange(1, 5)))
        assert any(not flips & m for m in masks)


def same_components(spark, fps, radius, heavy):
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    root = {r.node % 2**64: r.root for r in simhash_dedup.connected(simhash_dedup.links(df, radius, heavy)).collect()}
    groups = defaultdict(set)
    for f, c in zip(fps, plain_components(fps, radius)):
        groups[c].add(root.get(f, f))
    return all(len(v) == 1 for v in groups.values()) and len({next(iter(v)) for v in groups.values()}) == len(groups)


def test_chains_and_dense_buckets(spark):
    rng = np.random.default_rng(3)
    chain, x = [], 0
    for k in range(20):  # each link three bits from the last: the ends are far apart
        chain.append(x)
        x ^= 0b111 << (3 * k % 60)
    dense = [int(rng.integers(0, 2**63)) for _ in range(3)]
    fps = list({*chain, *[d ^ sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for d in dense for _ in range(60)]})
    for radius, heavy in ((4, 20_000), (4, 40), (2, 15)):
        assert same_components(spark, fps, radius, heavy), (radius, heavy)


def test_covering_again_keeps_every_close_pair():
    """Whatever bits a bucket's members agree in, two that differ in four of the others meet again in some table."""
    import pandas as pd

    rng = random.Random(2)
    for n_fixed in (20, 32, 45):
        fixed = sum(1 << i for i in rng.sample(range(64), n_fixed))
        base = rng.getrandbits(64)
        free = [i for i in range(64) if not fixed >> i & 1]
        fps = [base] + [base ^ sum(1 << i for i in rng.sample(free, rng.randrange(1, 5))) for _ in range(50)]
        signed = lambda v: v - 2**64 if v >= 2**63 else v
        frame = pd.DataFrame({"a": [signed(f) for f in fps], "bucket": 7, "fixed": signed(fixed)}).astype("int64")
        rows = pd.concat(simhash_dedup._cover_again(4)([frame]))
        met = rows.merge(rows[rows["fp"] == signed(base)], on="bucket")["fp_x"].unique()
        assert set(met) == {signed(f) for f in fps} and all(f % 2**64 & fixed == fixed for f in rows["fixed"].tolist())


def test_connected_follows_long_paths(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, k) for k in range(1001, 1400)], "a long, b long")
    roots = defaultdict(set)
    for r in simhash_dedup.connected(pairs).collect():
        roots[r.node >= 1000].add(r.root)
    assert len(roots[False]) == len(roots[True]) == 1
    assert simhash_dedup.connected(pairs.limit(0)).count() == 0
