"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

from quern.llm.spelling import neighbours, spelling_variants, words_with_slips


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def _brute(counts, least=2, factor=10):
    counts = {w: n for w, n in counts.items() if n >= least}
    forms, out = {}, []
    near = {w: [v for v in counts if _near(w, v)] for w in counts}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= factor * n else None
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), counts.get(forms[w])))
    return sorted(out)


def _found(rows):
    return sorted(map(tuple, rows.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_neighbours_meet_once(spark):
    rng = random.Random(2)
    words = {"".join(rng.choice("aabé") for _ in range(rng.randint(0, 7))) for _ in range(700)} | {"", "\U0001f600a", "a"}
    words |= {"z" * 3000, "z" * 3001, "z" * 1500 + "y" + "z" * 1500}
    rows = spark.createDataFrame([(w, i) for i, w in enumerate(sorted(words))], "word string, word_id long")
    names = sorted(words)
    for slice_rows in (500_000, 50):
        found = [(r.word_id, r.near_id) for r in neighbours(rows, slice_rows).collect()]
        assert len(found) == len(set(found))
        assert set(found) == {(i, j) for i, a in enumerate(names) for j, b in enumerate(names) if _near(a, b)}


def test_variants(spark):
    rng = random.Random(3)
    counts = Counter()
    for stem in ("condition", "additional", "übermäßig"):
        word, n = stem, rng.randint(500, 1000)
        for _ in range(4):  # chains of forms
            counts[word] += n
            for _ in range(6):
                at = rng.randrange(len(word))
                counts[rng.choice([word[:at] + word[at + 1 :], word[:at] + "x" + word[at:], word[:at] + "ä" + word[at + 1 :]])] += rng.choice([1, 2, n // 10, n // 9])
            at, n = rng.randrange(len(word)), max(2, n // 10)
            word = word[:at] + word[at + 1 :]
    rows = [(w, n) for w, n in counts.items() for _ in range(n)] + [(None, 1)] * 5
    df = spark.createDataFrame([(w, n, "x") for w, n in rows], "word string, n int, near string")
    assert _found(spelling_variants(df)) == _brute(counts)
    assert _found(spelling_variants(df, least=1, factor=2)) == _brute(counts, 1, 2)
    assert any(r[1] and r[2] != r[1] for r in _brute(counts))
    assert _found(spelling_variants(df.where("false"))) == []


def test_slips(spark):
    rng = random.Random(4)
    stems = ["Straßenbahn", "conditions", "señalados", "abcdefg", "short", "ÀÉÎõü×÷", "x" * 4000]
    texts = [" ".join(rng.choice(stems) + rng.choice(["", ".", "-x", "1", "Ω"]) for _ in range(60)) for _ in range(200)]
    docs = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "Straßenbahn", 1), (7, None, 1), (8, "", 1), (3, texts[3], 1)]
    wanted = Counter()
    for i, t, _ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                wanted[run] += 1
    got = words_with_slips(spark.createDataFrame(docs, "doc_id long, text string, word int"))
    assert Counter(r.word for r in got.collect()) == wanted
    assert _found(spelling_variants(got)) == _brute(wanted)
