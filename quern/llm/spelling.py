"""Spelling variants through a dictionary of trie-node pairs.

Every prefix of a word is a node of the forward trie, every suffix one of the reversed trie.
Nodes that two words share get a number; no other node can join words. A word then stands in
the pair dictionary with one entry for every gap between its letters, (prefix node before it,
suffix node after it), and one for every letter skipped, (node before, node after). Two words
of which one has one more letter meet where the skipped letter of one is a gap of the other;
two that differ in one letter meet where both skip it. Of a run of equal letters only the
first is skipped for the former, so every pair of neighbours meets exactly once, and a pair of
nodes holds at most one gap word and one word per letter of the alphabet.

Nodes are found by hashes of prefixes and suffixes (linear in the length of a word); equal
strings always meet, and each pair that met is checked letter by letter at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.hashing import mixed, of_ranges, prefix_sums
from quern.llm.tables import stored
from quern.plans.skew import hot_keys, sliced_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NODES = "word_id long, before array<long>, after array<long>, opens array<boolean>"


def _within(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of consecutive runs of these lengths."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every word the hashes of its prefixes and suffixes (one more than letters), and which
    letters differ from the one before."""
    for batch in batches:
        words = batch.column("word")
        n = pc.utf8_length(words).to_numpy().astype(np.int64)
        letters = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        sums = prefix_sums(mixed(letters + np.uint64(1)))
        start = np.cumsum(n) - n
        first, last = np.repeat(start, n + 1), np.repeat(start + n, n + 1)
        cut = first + _within(n + 1)
        opens = np.ones(len(letters), bool)
        opens[1:] = letters[1:] != letters[:-1]
        opens[start[n > 0]] = True
        offsets = pa.array(np.concatenate(([0], np.cumsum(n + 1))).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(of_ranges(sums, a, b).view(np.int64))) for a, b in ((first, cut), (cut, last))]
        opens = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(opens))
        yield pa.RecordBatch.from_arrays([batch.column("word_id"), *lists, opens], ["word_id", "before", "after", "opens"])


def _numbered(nodes: DataFrame, side: str, slice_rows: int) -> tuple[DataFrame, DataFrame]:
    """``(hash, node)`` of the nodes that several words share, and those too hot for one task."""
    shared = stored(
        nodes.select(F.explode(side).alias("hash"))
        .groupBy("hash")
        .agg(F.count("*").alias("words"))
        .where("words > 1")
        .withColumn("node", F.monotonically_increasing_id()),
        "trie",
    )
    return shared.select("hash", "node"), hot_keys(shared, "hash", "words", slice_rows)


def _entries(nodes: DataFrame, slice_rows: int) -> DataFrame:
    """The pair dictionary ``(word_id, skips, opens, p, s)``: gaps and skipped letters."""
    forward, hot_forward = _numbered(nodes, "before", slice_rows)
    reversed_, hot_reversed = _numbered(nodes, "after", slice_rows)
    next_after = F.slice("after", F.lit(2), F.size("after"))
    places = nodes.select("word_id", F.inline(F.arrays_zip("before", "after", next_after.alias("next"), "opens")))
    started = sliced_join(
        places.withColumnRenamed("before", "hash"), forward, "hash", hot_forward, ["word_id"]
    ).withColumnRenamed("node", "p")
    gap = F.struct(F.lit(False).alias("skips"), F.lit(False).alias("opens"), F.col("after").alias("hash"))
    skip = F.struct(F.lit(True).alias("skips"), F.col("opens").alias("opens"), F.col("next").alias("hash"))
    both = F.when(F.col("next").isNull(), F.array(gap)).otherwise(F.array(gap, skip))
    ended = sliced_join(
        started.select("word_id", "p", F.inline(both)), reversed_, "hash", hot_reversed, ["word_id", "p"]
    )
    return ended.select("word_id", "skips", "opens", "p", F.col("node").alias("s"))


def neighbours(words: DataFrame, slice_rows: int = 500_000) -> DataFrame:
    """``(word_id, near_id)``, both ways: words that differ by one inserted, deleted or replaced
    code point. ``words`` has different ``word`` and ``word_id`` in each row. Writes tables."""
    nodes = stored(words.select("word_id", "word").mapInArrow(_nodes, NODES), "nodes")
    entries = stored(_entries(nodes, slice_rows), "entries")
    skips, gaps = entries.where("skips"), entries.where("not skips")
    other = skips.select("p", "s", F.col("word_id").alias("near_id"))
    replaced = skips.join(other, ["p", "s"]).where("word_id <> near_id").select("word_id", "near_id")
    longer = skips.where("opens").select("p", "s", F.col("word_id").alias("long"))
    inserted = longer.join(gaps.select("p", "s", F.col("word_id").alias("short")), ["p", "s"])
    turned = F.array(
        F.struct(F.col("long").alias("word_id"), F.col("short").alias("near_id")),
        F.struct(F.col("short").alias("word_id"), F.col("long").alias("near_id")),
    )
    return replaced.unionByName(inserted.select(F.inline(turned)))


def _with_roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of words with a form, by doubling: each round looks up the root's root.

    Counts grow along the forms, so there is no cycle, and the number of rounds is the
    logarithm of the longest chain.
    """
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(roots.join(ahead, "root", "left"), "roots")
        if not moved.where("further is not null").limit(1).count():
            return roots
        roots = moved.select("word", F.coalesce("further", "root").alias("root"))


def spelling_variants(
    words: DataFrame, word_col: str = "word", least: int = 2, factor: int = 10, slice_rows: int = 500_000
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word in at least ``least`` rows.

    ``words`` has a row per occurrence; null words count for nothing, the empty word is a word.
    ``n_near`` counts the words exactly one inserted, deleted or replaced code point away. The
    form is the near word of largest n (of equals the first in code-point order) if its n is at
    least ``factor`` (over 1) times the word's, else null; ``root`` follows forms to the last.
    Other columns are ignored. Writes intermediate tables.
    """
    counted = words.select(F.col(word_col).alias("word")).where("word is not null").groupBy("word").agg(F.count("*").alias("n"))
    known = stored(counted.where(F.col("n") >= least).withColumn("word_id", F.monotonically_increasing_id()), "words")
    near = known.select(F.col("word_id").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = neighbours(known, slice_rows).join(known, "word_id").join(near, "near_id")
    # A threshold of 1 keeps the check linear in the length of the words.
    pairs = pairs.where(F.levenshtein("word", "near", 1) == 1)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    found = pairs.groupBy("word_id").agg(F.count("*").alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    taken = form_n >= factor * F.col("n")
    formed = stored(
        known.join(found, "word_id", "left").select(
            "word",
            F.when(taken, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(taken, form_n).alias("form_n"),
        ),
        "formed",
    )
    roots = _with_roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def words_with_slips(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 7, one_in: int = 31) -> DataFrame:
    """``word``: a row for every maximal run of letters (A-Z, a-z, U+00C0 to U+00FF), with A-Z in
    lower case, that has at least ``shortest`` code points after slips.

    A slip drops one letter: where ``one_in`` divides h, the unsigned crc32 of ``<id>:<run>``, the
    letter at h modulo the run's length goes. A null id counts as empty, a null text has no words.
    """
    runs = F.regexp_extract_all(F.translate(text_col, UPPER, LOWER), F.lit(f"[a-zÀ-ÿ]{{{shortest},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h: Column = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    rows = rows.select("run", h.alias("h"), F.length("run").alias("length"))
    at = F.pmod("h", F.col("length")).cast("int")
    slipped = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("h") % one_in == 0, slipped).otherwise(F.col("run"))
    return rows.select(word.alias("word")).where(F.length("word") >= shortest)
