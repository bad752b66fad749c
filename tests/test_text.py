"""Tokens, counts, bigrams, windows and PMI on tiny corpora, by hand or brute force."""

import math
import random
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from quern.functions.tokens import first_distinct, raw_words, tokens
from quern.operators import bigrams, cooccur, counts
from quern.sources.lines import read_text_lines, scan_lines

TINY = ["a b a c", "solo", ""]


def as_lines(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "line_id bigint, line string")


def rows(frame, *columns):
    return {tuple(r[c] for c in columns) for r in frame.collect()}


def random_corpus(seed=7, lines=60):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i)}" for i in range(12)]
    weights = [1 / (i + 1) for i in range(12)]
    return [" ".join(rng.choices(words, weights, k=rng.randint(0, 9))) for _ in range(lines)]


def plain_tokens(line):
    words = (re.sub(r"^[^a-z]+|[^a-z]+$", "", w) for w in re.split(r"[ \t\n\r\f]+", line.lower()))
    return [w for w in words if w]


def test_tokens(spark):
    line = "  The (quick) fox-trot,\tDON'T 42 -- été 世界 x! "
    got = as_lines(spark, [line]).select(tokens("line")).first()[0]
    assert got == ["the", "quick", "fox-trot", "don't", "t", "x"] == plain_tokens(line)
    assert as_lines(spark, [line]).select(raw_words("line")).first()[0] == line.split()
    assert as_lines(spark, [""]).select(tokens("line"), raw_words("line")).first()[:] == ([], [])


def test_tokens_are_linear_on_long_runs(spark):
    line = "a " + "9" * 200_000 + "b"
    assert as_lines(spark, [line]).select(tokens("line")).first()[0] == ["a", "b"]


def test_lines(spark):
    documents = spark.createDataFrame([(3, "x\n\ny")], "doc_id bigint, text string")
    assert rows(scan_lines(documents), "line_no", "line_id", "line") == {
        (0, 3 << 31, "x"), (1, (3 << 31) + 1, ""), (2, (3 << 31) + 2, "y"),
    }


def test_text_file_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one two\nthree\n")
    lines = read_text_lines(spark, str(tmp_path))
    assert [r.line for r in lines.orderBy("line_id").collect()] == ["one two", "three"]
    assert rows(counts.word_count(lines), "token", "n") == {("one", 1), ("two", 1), ("three", 1)}


def test_counts(spark):
    lines = as_lines(spark, TINY)
    assert rows(counts.word_count(lines), "token", "n") == {
        ("a", 2), ("b", 1), ("c", 1), ("solo", 1),
    }
    assert rows(counts.word_count(lines, 2), "token", "n") == {("a", 2)}
    assert rows(counts.line_doc_frequency(lines), "token", "n") == {
        ("a", 1), ("b", 1), ("c", 1), ("solo", 1),
    }
    assert counts.line_count(lines).first().n == 3
    assert [r.token for r in counts.top_terms(lines, 2).collect()] == ["a", "b"]


def test_cut_is_before_distinct(spark):
    line = " ".join(["x"] * 39 + ["y", "z", "u", "v", "w"])
    lines = as_lines(spark, [line])
    assert rows(counts.first_k_distinct_tokens(lines), "token") == {("x",), ("y",)}
    assert lines.select(F.size(first_distinct(tokens("line")))).first()[0] == 6


def test_bigrams(spark):
    lines = as_lines(spark, TINY)
    assert rows(bigrams.bigram_count(lines), "left_word", "right_word", "n") == {
        ("a", "b", 1), ("b", "a", 1), ("a", "c", 1),
    }
    pairs = rows(bigrams.bigram_relfreq_pairs(lines), "left_word", "right_word", "frequency")
    assert pairs == {
        ("a", "*", 2.0), ("a", "b", 0.5), ("a", "c", 0.5), ("b", "*", 1.0), ("b", "a", 1.0),
    }
    stripes = bigrams.bigram_relfreq_stripes(lines, entries_per_map=2)
    assert rows(
        stripes.select("left_word", F.explode("stripe").alias("r", "f")), "left_word", "r", "f"
    ) == {p for p in pairs if p[1] != "*"}


def test_relative_frequencies_sum_to_one(spark):
    pairs = bigrams.bigram_relfreq_pairs(as_lines(spark, random_corpus()))
    sums = pairs.where("right_word <> '*'").groupBy("left_word").agg(F.sum("frequency").alias("s"))
    assert all(abs(r.s - 1) < 1e-12 for r in sums.collect())


@pytest.mark.parametrize("window", [1, 2, 3])
def test_window(spark, window):
    corpus = random_corpus()
    expected = Counter()
    for line in corpus:
        t = plain_tokens(line)
        for i in range(len(t)):
            for j in range(max(0, i - window), min(len(t), i + window + 1)):
                if i != j:
                    expected[t[i], t[j]] += 1
    got = cooccur.cooccurrence_window(as_lines(spark, corpus), window)
    assert rows(got, "left_word", "right_word", "n") == {(*k, n) for k, n in expected.items()}


def close(got, expected):
    found = {(r.left_word, r.right_word): (r.pmi, r.n) for r in got.collect()}
    assert found.keys() == expected.keys()
    for key, (pmi, n) in expected.items():
        assert found[key][1] == n and abs(found[key][0] - pmi) < 1e-9


def shared_lines(bags):
    pairs = Counter()
    for bag in bags:
        for x, y in combinations(sorted(bag), 2):
            pairs[x, y] += 1
            pairs[y, x] += 1
    return pairs


@pytest.mark.parametrize("broadcast_words", [0, 1000])
@pytest.mark.parametrize("cut", [3, 40])
def test_pmi_pairs(spark, cut, broadcast_words):
    corpus = random_corpus()
    bags = [set(plain_tokens(line)[:cut]) for line in corpus]
    words = Counter(w for bag in bags for w in bag)
    expected = {
        (x, y): (math.log10(len(corpus) * n / (words[x] * words[y])), n)
        for (x, y), n in shared_lines(bags).items() if n >= 4
    }
    got = cooccur.pmi_pairs(as_lines(spark, corpus), 4, cut, broadcast_words)
    close(got, expected)


@pytest.mark.parametrize("most", [0, 3, 5, 1000])
def test_pairs_are_shuffled_as_numbers_of_the_most_frequent_words(spark, most):
    corpus = [*random_corpus(lines=200), "é ü wa", "wa wb"]
    bags = as_lines(spark, [*corpus, None]).select(first_distinct(tokens("line"), 40).alias("words"))
    frequency = cooccur.word_frequency(bags).where("word is not null")
    known, every = cooccur.most_frequent(frequency, most)
    counts = {r.word: r.n for r in frequency.collect()}
    chosen = {r.word for r in known.collect()}
    assert len(chosen) <= most and every == (len(chosen) == len(counts))
    assert all(counts[x] > counts[y] for x in chosen for y in counts.keys() - chosen)
    expected = shared_lines(set(plain_tokens(line)) for line in corpus)
    got = cooccur.unordered_pairs(bags, frequency, 2, most, held=50)
    assert rows(got, "word", "other", "n") == {(x, y, n) for (x, y), n in expected.items() if x < y and n >= 2}
    assert got.count() == sum(x < y and n >= 2 for (x, y), n in expected.items())


def test_pmi_stripes_hold_the_pairs(spark):
    lines = as_lines(spark, random_corpus())
    pairs = rows(cooccur.pmi_pairs(lines, 2), "left_word", "right_word", "pmi", "n")
    stripes = cooccur.pmi_stripes(lines, 2, entries_per_map=3)
    flat = stripes.select("left_word", F.explode("stripe").alias("right_word", "e")).select(
        "left_word", "right_word", "e.pmi", "e.n"
    )
    assert rows(flat, "left_word", "right_word", "pmi", "n") == pairs
    assert {(y, x) for x, y, *_ in pairs} == {(x, y) for x, y, *_ in pairs}
    maps = {r.left_word: r["count"] for r in stripes.groupBy("left_word").count().collect()}
    partners = Counter(x for x, *_ in pairs)
    assert all(maps[w] == 1 for w, n in partners.items() if n <= 3)
    assert any(maps[w] > 1 for w, n in partners.items() if n > 3)


def test_pmi_occurrence_without_threshold(spark):
    corpus = random_corpus()
    all_tokens = [plain_tokens(line) for line in corpus]
    words = Counter(w for t in all_tokens for w in t)
    total = sum(words.values())
    expected = {
        (x, y): (math.log10(total * n / (words[x] * words[y])), n)
        for (x, y), n in shared_lines(set(t) for t in all_tokens).items()
    }
    close(cooccur.pmi_occurrence(as_lines(spark, corpus)), expected)
    close(cooccur.pmi_occurrence(as_lines(spark, corpus), places_per_block=2), expected)


@pytest.mark.parametrize("total", [None, 156215])
def test_pmi_forward_without_threshold(spark, total):
    corpus = [line.upper() + "," for line in random_corpus()]
    pairs = Counter()
    words = Counter()
    for line in corpus:
        t = line.split()
        words.update(set(t))
        for i, left in enumerate(t):
            pairs.update((left, right) for right in set(t[i + 1:]))
    n_lines = total or len(corpus)
    expected = {
        (x, y): (math.log(n_lines * n / (words[x] * words[y])), n) for (x, y), n in pairs.items()
    }
    close(cooccur.pmi_forward(as_lines(spark, corpus), total), expected)
    close(cooccur.pmi_forward(as_lines(spark, corpus), total, places_per_block=3), expected)


def test_a_very_long_line_is_paired_in_blocks(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(40)}" for _ in range(100_000)]
    lasts, n = {w: i for i, w in enumerate(words)}, Counter()
    before = Counter()
    for i, w in enumerate(words):
        n.update({(x, w): c for x, c in before.items()} if lasts[w] == i else {})
        before[w] += 1
    lines = as_lines(spark, [" ".join(words), "w1 w2"])
    n["w1", "w2"] += 1
    got = cooccur.pmi_forward(lines).collect()
    assert {(r.left_word, r.right_word): r.n for r in got} == {k: v for k, v in n.items() if v}
    placed = lines.select(F.split("line", " ").alias("words")).select(
        cooccur._placed(F.col("words")).alias("left"), cooccur._placed(F.col("words")).alias("right")
    )
    blocks = cooccur.line_blocks(placed, 1024)
    sizes = blocks.agg(F.max(F.size("left")), F.max(F.size("right")), F.count("*")).first()
    assert tuple(sizes) == (1024, 1024, 98 * 99 // 2 + 1)


def test_a_last_newline_opens_no_line(spark):

    docs = spark.createDataFrame([(1, "a\nb\n"), (2, "a\n\n"), (3, "a")], "doc_id long, text string")
    lines = sorted((r.doc_id, r.line_no, r.line) for r in scan_lines(docs).collect())
    assert lines == [(1, 0, "a"), (1, 1, "b"), (2, 0, "a"), (2, 1, ""), (3, 0, "a")]


def test_pmi_of_very_frequent_words_does_not_overflow(spark):

    pairs = spark.createDataFrame([("a", "b", 5_000_000_000)], "word string, other string, n long")
    counts = spark.createDataFrame([("a", 5_000_000_000), ("b", 5_000_000_000)], "word string, n long")
    row = cooccur._pmi(pairs, counts, F.lit(1e10), "log10").first()
    assert abs(row.pmi - 0.30103) < 1e-4


def test_ids_of_very_long_documents_do_not_collide_and_ascend(spark):
    documents = spark.sql(
        "SELECT 0L AS doc_id, repeat('a\\n', 1000003) AS text UNION ALL SELECT 1L, 'b\\nc\\nd'"
        " UNION ALL SELECT -1L, 'e\\nf' UNION ALL SELECT 4294967295L, 'g'"
    )
    lines = scan_lines(documents)
    n, ids = lines.selectExpr("count(*)", "count(DISTINCT line_id)").first()
    assert n == ids == 1_000_009
    ordered = lines.selectExpr("line_id - lag(line_id) OVER (ORDER BY doc_id, line_no) AS step")
    assert ordered.where("step <= 0").count() == 0
    with pytest.raises(Exception, match="out of range"):
        scan_lines(spark.sql("SELECT 4294967296L AS doc_id, 'x' AS text")).collect()


def test_tokens_take_one_search_per_line(spark):
    """No function is called back for every word of a line: that halves the rate of all text queries."""
    found = as_lines(spark, TINY).select(tokens("line").alias("t"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("regexp") == 1


def test_tokens_of_odd_lines(spark):
    rng = random.Random(5)
    lines = ["".join(rng.choices("ab Z9'\t\r\f.-\u0085 éİ世", k=rng.randint(0, 30))) for _ in range(500)]
    found = as_lines(spark, lines).select("line_id", tokens("line").alias("t")).collect()
    assert {r.line_id: r.t for r in found} == {i: plain_tokens(line) for i, line in enumerate(lines)}


def test_bigram_stripes_are_made_from_the_bigrams_at_once(spark, monkeypatch):
    """Bigrams move once after they are counted, and no table of pairs with frequencies is written."""
    written, real = [], bigrams.stored
    monkeypatch.setattr(bigrams, "stored", lambda rows, label="stored": written.append(label) or real(rows, label))
    lines = as_lines(spark, random_corpus())
    stripes = bigrams.bigram_relfreq_stripes(lines, entries_per_map=3)
    assert written == ["bigrams", "marginals"]
    flat = stripes.select("left_word", "slice", F.explode("stripe").alias("r", "f")).collect()
    pairs = rows(bigrams.bigram_relfreq_pairs(lines), "left_word", "right_word", "frequency")
    assert len(flat) == len({(r.left_word, r.r) for r in flat})
    assert {(r.left_word, r.r, r.f) for r in flat} == {p for p in pairs if p[1] != "*"}
    partners = Counter(r.left_word for r in flat)
    cut = {r.left_word for r in flat if r.slice > 0}
    assert cut and all(partners[w] > 3 for w in cut)


@pytest.mark.parametrize("most", [0, 4, 1000])
def test_pairs_of_whole_lines_move_once_as_numbers(spark, most):
    """Any number of shipped words gives the pairs of all; shipped ones are looked up without a shuffle."""
    lines = as_lines(spark, [*random_corpus(), "é wa ü wb wa", "", None])
    for operator, columns in (
        (cooccur.pmi_occurrence, ("left_word", "right_word", "n")),
        (cooccur.pmi_forward, ("left_word", "right_word", "n")),
    ):
        every = operator(lines)
        assert "SortMergeJoin" not in every._jdf.queryExecution().executedPlan().toString()
        want = {(r.left_word, r.right_word): (r.pmi, r.n) for r in every.collect()}
        got = operator(lines, places_per_block=2, broadcast_words=most)
        close(got, want)
        assert got.count() == len(want)


def test_later_places_of_blocks_come_in_portions():
    import pyarrow as pa

    rng = random.Random(2)
    blocks = [
        {side: [{"at": i, "word": "w"} for i in sorted(rng.sample(range(30), rng.randint(0, 20)))] for side in ("left", "right")}
        for _ in range(40)
    ]
    kind = pa.list_(pa.struct([("at", pa.int32()), ("word", pa.string())]))
    batch = pa.RecordBatch.from_pylist(blocks, pa.schema([("left", kind), ("right", kind)]))
    left, right = (batch.column(c).flatten().field("at").to_numpy() for c in ("left", "right"))
    want = Counter((x["at"], y["at"]) for b in blocks for x in b["left"] for y in b["right"] if y["at"] > x["at"])
    portions = list(cooccur._later_places(batch, 50))
    assert Counter((int(left[i]), int(right[j])) for x, y in portions for i, j in zip(x, y)) == want
    assert len(portions) > 5 and max(len(x) for x, _ in portions) <= 50 + 20 * 2
