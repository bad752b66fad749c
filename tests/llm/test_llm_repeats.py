"""Removal of repeats, near duplicates and suffix arrays against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from quern.llm import near_duplicates
from quern.llm.near_duplicates import bitmap, near_duplicate_classes, without_near_duplicates
from quern.llm.substring_dedup import remove_repeated_passages
from quern.llm.suffix_dedup import remove_repeated_bytes
from quern.llm.suffixes import common_prefixes, suffix_arrays

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, row string, out int"  # with clashing names


def table(spark, docs):
    return spark.createDataFrame([(i, t, "r", 1) for i, t in docs], SCHEMA).repartition(3)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_suffix_arrays_and_prefixes():
    rng = random.Random(1)
    for _ in range(200):
        letters = rng.randint(1, 4)
        shards = [bytes(rng.randint(1, letters) for _ in range(rng.randint(0, 30))) + b"\0" for _ in range(rng.randint(1, 6))]
        size = np.array([len(s) for s in shards])
        base = np.cumsum(size) - size
        data = np.frombuffer(b"".join(shards), np.uint8)
        order = suffix_arrays(data, base, size)
        before, common = common_prefixes(data, order, base, 6)
        for s, b in zip(shards, base):
            wanted = sorted(range(len(s)), key=lambda i: s[i:])
            assert (order[b : b + len(s)] - b).tolist() == wanted
            for x, y in zip(wanted, wanted[1:]):
                k = 0
                while k < 6 and x + k < len(s) and y + k < len(s) and s[x + k] == s[y + k]:
                    k += 1
                assert (before[b + y], common[b + y]) == (b + x, k)


def byte_docs():
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 60))) for _ in range(12)]
    docs = [
        (i, "".join(rng.choice(base)[rng.randint(0, 9) : rng.randint(10, 60)] for _ in range(rng.randint(0, 5))))
        for i in range(100)
    ]
    return docs + [(200, None), (201, ""), (202, "a" * 90), docs[3], (203, "ab" * 40), (None, "ab" * 30), (204, "xyz " * 3000)]


@pytest.mark.parametrize("length, limit", [(12, 64), (12, 0), (20, 3)])
def test_repeated_bytes(spark, length, limit):
    docs = byte_docs()
    data = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    wanted = []
    for i, b in data:
        hit = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                hit[k : k + length] = True
        kept = bytes(x for x, h in zip(b, hit) if not h)
        spans = int((hit[:-1] & ~np.concatenate(([False], hit[:-2]))).sum()) if len(b) else 0
        wanted.append((i, len(b), len(b) - len(kept), spans, sha(kept)))
    found = remove_repeated_bytes(table(spark, docs), length=length, group_limit=limit, batch_bytes=500)
    got = found.select("row.doc_id", "out.n_bytes", "out.n_removed", "out.n_spans", "out.kept_sha256").collect()
    assert Counter(map(tuple, got)) == Counter(wanted)
    assert found.select("row.row").distinct().count() == 1


@pytest.mark.parametrize("length, gram", [(6, 3), (10, 4)])
def test_repeated_passages(spark, length, gram):
    rng = random.Random(6)
    base = [[rng.choice("abcdé") for _ in range(rng.randint(0, 30))] for _ in range(12)]
    docs = []
    for i in range(100):
        parts = [" ".join(rng.choice(base)[rng.randint(0, 9) : rng.randint(10, 30)]) for _ in range(rng.randint(0, 5))]
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(parts)))
    docs += [(200, None), (201, ""), (202, "a " * 90), docs[7], (203, "A b" * 2000)]
    words = [(i, re.findall(WORD, t or "")) for i, t in docs]
    first = {}
    for i, w in words:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            first[key] = min(first.get(key, (i, k)), (i, k))
    wanted = []
    for i, w in words:
        hit = [False] * len(w)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < (i, k):
                hit[k : k + length] = [True] * length
        kept = " ".join(x for x, h in zip(w, hit) if not h)
        wanted.append((i, len(w), sum(hit), sha(kept.encode())))
    found = remove_repeated_passages(table(spark, docs), length=length, gram=gram)
    got = found.select("row.doc_id", "out.n_words", "out.n_removed", "out.kept_sha256").collect()
    assert Counter(map(tuple, got)) == Counter(wanted)


def brute_classes(docs, size, percent):
    sets = []
    for _, t in docs:
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs))


def test_bitmaps_never_differ_more_than_sets():
    rng = np.random.default_rng(3)
    for n in (1, 5, 100, 2000):
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[: n // 2], rng.integers(0, 1 << 62, n // 3, dtype=np.uint64))))
        bits = int(np.bitwise_count((bitmap(a) ^ bitmap(b)).view(np.uint64)).sum())
        assert bits <= len(np.setxor1d(a, b)) and (bits - len(np.setxor1d(a, b))) % 2 == 0
        assert len(bitmap(a)) == len(near_duplicates.MAPS) and bitmap(a).tolist() == bitmap(a[::-1]).tolist()


@pytest.mark.parametrize(("least", "most"), [(8, 1 << 20), (3, 1 << 20), (3, 40), (1, 0)])
def test_near_duplicates(spark, monkeypatch, least, most):
    """Whatever shingles are called frequent, and however many."""
    monkeypatch.setattr(near_duplicates, "IN_ALL", least)
    monkeypatch.setattr(near_duplicates, "MOST_FREQUENT", most)
    rng = random.Random(1)
    docs = []
    for _ in range(20):
        w = [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.choice([3, 4, 5, 8, 30, 60, 120]))]
        for _ in range(rng.choice([1, 2, 8, 20])):
            x = list(w)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                x[rng.randrange(len(x))] = rng.choice("XYZé")
            docs.append((len(docs), rng.choice([" ", "\n"]).join(x)))
    docs += [(900, None), (901, ""), (902, "  "), (903, None)]
    rows = table(spark, docs)
    got = near_duplicate_classes(rows).select("id", "n_shingles", "component_id").collect()
    wanted = brute_classes(docs, 5, 80)
    assert sorted(map(tuple, got)) == wanted
    kept = without_near_duplicates(rows.unionByName(rows.limit(5)))
    assert kept.columns == rows.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _, c in wanted if d == c)


def test_empty_tables(spark):
    none = table(spark, [(1, "a")]).where("false")
    assert near_duplicate_classes(none).count() == 0
    assert remove_repeated_bytes(none).count() == 0
    assert remove_repeated_passages(none).count() == 0
