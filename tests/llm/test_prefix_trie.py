import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from scriptorium.llm import prefix_trie as op

SCHEMA = "conv_id long, turn long, role string, text string, path string, first int"


def brute(rows):
    """All prefixes of all rebuilt conversations, one by one."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0, role or ""), hashlib.sha256(
                f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest(), role or "", text or ""))
    seqs = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    new = {}
    for c, s in seqs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c - 100 * int(c / 100))
        new[c] = tuple(seqs.get(base, [])[:h] + s[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in new.items():
        ends[s].append(c)
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
                   for p, m in members.items()), key=str)


def got(df, **options):
    return sorted((tuple(r) for r in op.trie(df, **options).collect()), key=str)


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(5)


def rows(n, seed, turns=7, words=3):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant"]), r.choice(["a", "bé", "😀 ccc"][:words])) for c in range(n)
            for t in range(r.randrange(turns))]


@pytest.mark.parametrize("group_items", [3, 512])
def test_against_brute_force(spark, group_items):
    some = rows(230, 1)
    assert got(make(spark, some), group_items=group_items) == brute(some)


def test_a_hot_first_turn_and_hot_equal_conversations(spark):
    some = [(c, t, "system" if t == 0 else "user", "hello" if t == 0 or c % 3 == 0 else f"{c % 7} {t}")
            for c in range(300) for t in range(4)]
    assert got(make(spark, some), group_items=20) == brute(some)


def test_long_conversations_take_few_rounds(spark):
    some = [(c, t, "user", f"t{t}" if t < 60 * c else f"{c}-{t}") for c in (1, 2, 3, 205) for t in range(130 + c)]
    assert got(make(spark, some)) == brute(some)


def test_nulls_ties_repeats_and_missing_conversations(spark):
    some = [(None, 0, "user", "lost"), (7, None, "user", "first"), (7, 3, None, None), (7, 3, "user", "x"),
            (7, 3, "user", "x"), (0, 1, "user", "b"), (0, None, None, ""), (100, 1, "user", ""), (-5, 2, "user", "neg"),
            (101, 0, "u", "one"), (250, 0, "user", "base is absent"), (1 << 60, 0, "user", "far"), (9, 0, "a", "x" * 70_000)]
    assert got(make(spark, some)) == brute(some)
    assert op.trie(make(spark, []).where("false")).count() == 0
    assert op.trie(spark.createDataFrame([(None, 1, "a", "b", "c", 1)], SCHEMA)).count() == 0


def test_turnless_conversations_end_at_the_root(spark):
    short = [c for c in range(201, 230) if zlib.crc32(str(c).encode()) % 6 >= 2][:5]
    some = [(c, 0, "user", "hi") for c in short]  # base 200 is absent, and h takes all turns
    assert got(make(spark, some)) == brute(some)
    assert len(brute(some)) == 1


def test_ids_are_digested_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK_IDS", 3)
    some = [(c * 100, 0, "user", "same") for c in range(40)]
    assert got(make(spark, some)) == brute(some)
