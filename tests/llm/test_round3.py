"""Fill-in-middle, conversation prefixes and SimHash against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from gatewright.llm import fill_in_middle as fim
from gatewright.llm import prefix_trie as trie
from gatewright.llm import queries, simhash
from gatewright.llm.common import byte_slices
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
ODD = ["", " ", "a", " a", "a ", " \n a  b\t", "<P>", "<", "<S x", "\x00a \x85b c é𐀀 d", "x" * 300_000, "word " * 60_000, "　a　b"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# fill-in-middle


def plain_fim(doc_id, text: str | None) -> tuple:
    t, h = text or "", hashlib.sha256(b"42:" + str("" if doc_id is None else doc_id).encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = UNIT.findall(t)
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, t
    if h4 % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_plain_python(spark):
    r = random.Random(3)
    texts = [None, *ODD, *("".join(r.choice("ab \n\t<PSM>　é") for _ in range(r.randrange(60))) for _ in range(400))]
    rows = [(k, t, "x", "y", "z") for k, t in enumerate(texts)] + [(None, "a b c", "", "", ""), (None, "a b c", "", "", ""), (3, "other text", "", "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string, form string, h1 string")
    made = fim.fill_in_middle(docs)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = [tuple(x) for x in made.withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()]
    want = [(d, *plain_fim(d, t), t or "") for d, t, *_ in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {x[2] for x in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(docs.limit(0)).count() == 0


def test_fill_in_middle_slices_batches_by_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, "b" * 10, "c" * 100, "", "d"])], names=["t"])
    parts = list(byte_slices(batch, "t", 25))
    assert [p.num_rows for p in parts] == [2, 1, 2]
    assert pa.Table.from_batches(parts).column("t").to_pylist() == batch.column("t").to_pylist()
    assert list(byte_slices(batch.slice(0, 0), "t")) == []


def test_fill_in_middle_on_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {(d.doc_id, *(x := plain_fim(d.doc_id, d.text))[:4], sha(x[4]), sha(d.text or "")) for d in docs.collect()}
    assert {tuple(x) for x in queries.op11_fill_in_middle(spark, SF).collect()} == want


# conversations


def plain_trie(rows: list[tuple]) -> set[tuple]:
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt = own.get(c - c % 5, [])[:h] + turns[h:]
        for d in range(len(rebuilt) + 1):
            members[tuple(rebuilt[:d])].append((c, d == len(rebuilt)))
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        below = [totals[x] for x in children[node]]
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        totals[node] = (sum(x[0] for x in below) or 1, saved + sum(x[1] for x in below))
    out = set()
    for node, who in members.items():
        ends = ",".join(map(str, sorted(c for c, end in who if end)))
        parent = min(c for c, _ in members[node[:-1]]) if node else None
        out.add((min(c for c, _ in who), len(node), parent, len(who), len(children[node]), *totals[node], sha(ends)))
    return out


def conversations(spark, rows):
    wide = [(*r, 7, "b") for r in rows]
    return spark.createDataFrame(wide, "conv_id long, turn long, role string, text string, length long, p1 string")


def made_conversations(n: int, seed: int, long: int = 0) -> list[tuple]:
    r = random.Random(seed)
    rows = []
    for c in range(n):
        if r.random() < 0.1:
            continue  # absent, maybe the first of its group
        for t in range(r.randrange(1, 14)):
            rows.append((c, t if r.random() < 0.95 else None, r.choice(["user", "assistant", None]) if t > 2 else "user", r.choice(["hi", "é", None, "what is it"]) if t > 1 or r.random() < 0.4 else "hello"))
    rows += rows[:20]  # turns that repeat
    rows += [(None, 1, "user", "lost"), (None, 2, None, None)]
    rows += [(7, t, "user", f"t{t % 3}") for t in range(100, 100 + long)]
    return rows


@pytest.mark.parametrize("sizes", [{}, {"shard": 5, "held": 3}, {"shard": 3, "band": 2, "block": 4, "held": 2}, {"shard": 1, "band": 1, "block": 1}])
def test_trie_equals_plain_python(spark, sizes):
    rows = made_conversations(120, 5, 30)
    made = trie.conversation_trie(conversations(spark, rows), **sizes)
    got = [tuple(x) for x in made.collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain_trie(rows)


def test_trie_of_one_conversation_copied_and_of_none(spark):
    rows = [(c, t, "user", f"same {t}") for c in range(300) for t in range(3)]
    got = {tuple(x) for x in trie.conversation_trie(conversations(spark, rows), shard=4).collect()}
    assert got == plain_trie(rows)
    assert trie.conversation_trie(conversations(spark, rows).limit(0)).count() == 0
    assert {tuple(x) for x in trie.conversation_trie(conversations(spark, [(1, 0, "user", "a")])).collect()} == plain_trie([(1, 0, "user", "a")])


def test_digest_blocks_are_joined_in_order(spark):
    ends = spark.createDataFrame([(k % 2, 5, c) for k, c in enumerate(range(2000, 0, -1))], "p1 long, p2 long, conv_id long")
    got = {x.p1: x.ends_sha256 for x in trie.digests(ends, ids=7).collect()}
    assert got == {p: sha(",".join(str(c) for c in range(1, 2001) if (2000 - c) % 2 == p)) for p in (0, 1)}


def test_messages_come_in_order_of_time_and_spill():
    r, queue = random.Random(1), trie.Messages(held=4)
    sent = [(-r.randrange(5), r.randrange(3), 0, k, 0, 0) for k in range(200)]
    for m in sent:
        queue.push(m)
    assert queue.runs
    for key in sorted({m[:3] for m in sent})[1::2]:  # the others are not asked for
        assert sorted(queue.take(key)) == sorted(m for m in sent if m[:3] == key)


def test_trie_on_given_conversations(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(x) for x in queries.op12_prefix_trie(spark, SF).collect()} == plain_trie(rows)


# SimHash


def plain_print(text: str | None) -> int:
    from xxhash import xxh64_intdigest

    t = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    w = re.findall("[^\x20\x09-\x0d]+", t)
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(prints: list[int], ids: list) -> list:
    seen = sorted(set(prints))
    top = {x: x for x in seen}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, x in enumerate(seen):
        for y in seen[:i]:
            if (x ^ y).bit_count() <= 2:
                top[find(x)] = find(y)
    least = {}
    for x, d in zip(prints, ids, strict=True):
        if d is not None:
            least[find(x)] = min(d, least.get(find(x), d))
    return [least.get(find(x)) for x in prints]


def test_simhash_equals_brute_force(spark):
    r = random.Random(2)
    base = [" ".join(r.choice("abcdefghij") * r.randrange(1, 4) for _ in range(r.randrange(1, 200))) for _ in range(40)]
    near = [t.replace("a", "A").replace(" ", "  ", 1) if k % 3 else t + " zz" for k, t in enumerate(base * 4)]
    texts = [None, *ODD, *base, *near, *(" ".join(["x y z"] * k) for k in range(1, 30))]
    rows = [(k, t, 1, "") for k, t in enumerate(reversed(texts))] + [(None, "q r s", 1, ""), (None, base[0], 1, ""), (5, base[1], 1, ""), (5, base[1], 1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int, component_id string")
    prints = [plain_print(t) for _, t, *_ in rows]
    want = sorted(zip([x[0] for x in rows], prints, plain_components(prints, [x[0] for x in rows]), strict=True), key=repr)
    for sizes in ({}, {"tile": 3}, {"parts": 8}, {"parts": 1, "tile": 7}):
        got = sorted(((x.doc_id, x.fp % 2**64, x.component_id) for x in simhash.simhash_duplicates(docs, **sizes).collect()), key=repr)
        assert got == want, sizes
    assert simhash.simhash_duplicates(docs.limit(0)).count() == 0


def test_links_connect_all_that_lie_within_the_radius(spark):
    r = random.Random(4)
    seeds = [r.getrandbits(64) for _ in range(60)] + [0, 2**64 - 1, 1, 1 << 63]
    prints = set(seeds)
    for x in seeds[:30]:
        for _ in range(30):  # chains and clouds
            x ^= 1 << r.randrange(64)
            prints.add(x ^ (1 << r.randrange(64)))
    prints = sorted(prints)
    df = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in prints], "fp long")
    want = plain_components(prints, prints)
    for tile, parts in ((1024, 4), (5, 4), (50, 2), (4, 8)):
        top = {x: x for x in prints}

        def find(x, top=top):
            while top[x] != x:
                x = top[x]
            return x

        for a, b in simhash.links_within(df, tile=tile, parts=parts).collect():
            a, b = a % 2**64, b % 2**64
            assert (a ^ b).bit_count() <= 2
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
        assert [find(x) for x in prints] == want, (tile, parts)


def test_forest_of_a_cloud_is_no_larger_than_its_points():
    cloud = np.array([1 << k for k in range(64)], np.uint64)
    assert len(simhash.forest(cloud, cloud, 2, True)) == 63
    assert len(simhash.forest(cloud[:30], cloud[30:], 2, False)) == 63
    assert simhash.forest(cloud[:1], cloud[:1], 2, True) == []


def test_simhash_on_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_print(d.text) for d in docs]
    ids = [d.doc_id for d in docs]
    want = {(d, f"{p:016x}", c) for d, p, c in zip(ids, prints, plain_components(prints, ids), strict=True)}
    assert {tuple(x) for x in queries.op13_simhash(spark, SF).collect()} == want


# crowded buckets of near-duplicates


def template_texts(n: int, words: int, own: int, seed: int, vocabulary: int = 0) -> list[str]:
    """Texts of one template with `own` words of each replaced, by words of its own or out of a vocabulary."""
    r = random.Random(seed)
    base = [f"w{k}" for k in range(words)]
    texts = []
    for d in range(n):
        t = list(base)
        for k in r.sample(range(words), own):
            t[k] = f"x{r.randrange(vocabulary)}" if vocabulary else f"d{d}x{k}"
        texts.append(" ".join(t))
    return texts


@pytest.mark.parametrize(("own", "vocabulary"), [(2, 0), (4, 3)])
def test_crowded_buckets_equal_brute_force(spark, own, vocabulary):
    from gatewright.llm.minhash import near_duplicates, shingle_set

    texts = template_texts(100, 90, own, own, vocabulary)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    with np.errstate(over="ignore"):
        sets = [set(shingle_set(t, 3).tolist()) for t in texts]
    top = list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                top[max(p, q)] = min(p, q)
    for crowd in (0, 64):
        got = {r.doc_id: r.component_id for r in near_duplicates(docs, words=3, percent=85, crowd=crowd).collect()}
        assert got == {d: find(d) for d in range(len(texts))}, crowd
