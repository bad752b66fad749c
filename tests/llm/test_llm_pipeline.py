"""The pipeline on small tables: every stage against brute force, and odd rows through all of it."""

import random
import re

import pytest

import corpus_pipeline
from quern.sources.tables import scan_parquet

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)


def _words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 7))) for _ in range(n)]


def _documents(rng):
    passage, item = _words(rng, 60), _words(rng, 30)
    docs, labels = [], []
    for i in range(160):
        w = _words(rng, rng.randint(40, 120))
        toxic = i % 8 == 0
        if toxic:
            for _ in range(8):
                w.insert(rng.randrange(len(w)), rng.choice(["vileword", "hatefulterm", "slurlike"]))
        if i % 9 == 1:
            w[10:10] = passage
        if i % 20 == 3:
            w[5:5] = item
        docs.append([i, " ".join(w)])
        if i % 2 == 0:
            labels.append((i, rng.randint(0, 1), int(toxic)))
    for k in range(20):  # copies and near copies
        copy = docs[21 + 4 * k][1].split()
        if k % 2:
            copy[len(copy) // 2] = "changed"
        docs.append([300 + k, " ".join(copy)])
    docs += [[500, None], [501, ""], [502, "short text"], [503, docs[5][1]], [503, docs[5][1]]]
    rows = [(i, t, "en", f"s{i % 3}" if i % 11 else None, len(t or "")) for i, t in docs]
    return rows, labels, [(1, " ".join(item)), (2, None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows, labels, items = _documents(random.Random(9))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def _collected(rows):
    return sorted(map(tuple, rows.collect()), key=repr)


def _lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def _one_of_each(docs):
    sets = []
    for d in docs:
        w = re.findall(WORD, _lower(d[1]))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(docs):
        least[find(i)] = min(least.get(find(i), d[0]), d[0])
    kept = {d for i, d in enumerate(docs) if not sets[i] or least[find(i)] == d[0]}
    return sorted(kept, key=repr)


def _without_repeats(docs, length=20):
    words, first, out = [(d, re.findall(WORD, d[1] or "")) for d in docs], {}, []
    for d, w in words:
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            first[key] = min(first.get(key, (d[0], k)), (d[0], k))
    for d, w in words:
        hit = [False] * len(w)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < (d[0], k):
                hit[k : k + length] = [True] * length
        if any(hit):
            kept = " ".join(x for x, h in zip(w, hit) if not h)
            if kept:
                out.append((d[0], kept, *d[2:4], len(kept)))
        else:
            out.append(d)
    return sorted(out, key=repr)


def _uncontaminated(docs, items, n=13):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for _, t in items:
        w = re.findall(pattern, _lower(t))
        windows |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    out = []
    for d in docs:
        w = re.findall(pattern, _lower(d[1]))
        hit = [False] * len(w)
        for k in range(len(w)):
            for x in windows:
                if tuple(w[k : k + len(x)]) == x:
                    hit[k : k + len(x)] = [True] * len(x)
        if not (any(hit) and 20 * sum(hit) >= len(w)):
            out.append(d)
    return sorted(out, key=repr)


def test_every_stage(spark, folder):
    docs = scan_parquet(spark, folder, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "n-gram Jaccard join", "substring dedup", "benchmark decontamination", "mixing sources to target weights",
    ]
    clean = STAGES["toxicity"](spark, docs, folder)
    left = {r.doc_id for r in clean.collect()}
    toxic = set(range(0, 160, 8))
    assert not left & toxic and len(left) >= 0.97 * len({r.doc_id for r in docs.collect()} - toxic)
    assert clean.columns == docs.columns

    items = [tuple(r) for r in scan_parquet(spark, folder, "benchmark").collect()]
    brute = {
        "n-gram Jaccard join": _one_of_each,
        "substring dedup": _without_repeats,
        "benchmark decontamination": lambda rows: _uncontaminated(rows, items),
    }
    rows = clean
    for name, wanted in brute.items():
        before = _collected(rows)
        rows = STAGES[name](spark, spark.createDataFrame(before, SCHEMA).repartition(4), folder)
        assert rows.columns == docs.columns
        after = _collected(rows)
        assert after == wanted(before) and after != before

    mixed = STAGES["mixing sources to target weights"](spark, rows, folder).collect()
    sizes = {r.doc_id: len(re.findall(WORD, r.text or "")) for r in rows.collect()}
    assert {r.doc_id: r["size"] for r in mixed} == sizes
    assert all(0 <= r.taken <= 3 * r["size"] for r in mixed)
    assert abs(sum(r.taken for r in mixed) - sum(sizes.values())) <= 4 * max(sizes.values())


def test_whole_run_and_empty_tables(spark, folder, tmp_path):
    first, again = (_collected(corpus_pipeline.run(spark, folder)) for _ in range(2))
    assert first == again and len(first) > 50
    empty = str(tmp_path / "empty")
    for name in ("documents", "labels", "benchmark"):
        scan_parquet(spark, folder, name).where("false").write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
