"""Benchmark decontamination: texts are streamed through a suffix automaton of the test items.

The items are a stated query set, collected and shipped to every task after their size is
checked against ``max_item_bytes``. Tasks build the automaton in blocks of ``block_words``
words; with more than one block they go over each batch of texts block by block.

A hit needs consecutive words that all occur in some item, so only runs of known words at
least as long as the shortest window are walked.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quern.llm.automaton import SuffixAutomaton
from quern.llm.tables import columns, field, merged, table_schema

OUT = columns(
    n_words="long", n_hit="long", n_items="long", items_sha256="string", contaminated="boolean",
    longest="long", items="strings", spans="ranges", clean="string",
)
OUT_ARROW = to_arrow_type(OUT)
_WORD = re.compile(rb"[^ ]+")
# Upper-case ASCII letters fold; every other ASCII character but letters and digits parts words.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def _without(text: str, spans: np.ndarray) -> str:
    """The text without the words of the spans and the blanks between them."""
    data = text.encode()
    at = [m.span() for m in _WORD.finditer(data.translate(FOLD))]
    kept, done = [], 0
    for low, high in spans.tolist():
        kept.append(data[done : at[low][0]])
        done = at[high - 1][1]
    return b"".join((*kept, data[done:])).decode()


class _Matcher:
    def __init__(self, items: list[tuple[str, str]], n: int, block_words: int):
        self.n, self.blocks, self.kept = n, [[]], None
        total = 0
        for item, text in items:
            w = words(text)
            if total and total + len(w) > block_words:
                self.blocks.append([])
                total = 0
            self.blocks[-1].append((item, w))
            total += len(w)

    def automata(self) -> Iterator[SuffixAutomaton]:
        for block in self.blocks:
            if len(self.blocks) > 1:
                yield SuffixAutomaton(block, self.n)
            else:
                self.kept = self.kept or SuffixAutomaton(block, self.n)
                yield self.kept

    def hits(self, texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str], int]]:
        results: list = [([], set(), 0) for _ in texts]
        for a in self.automata():
            known = a.ids.get
            for k, text in enumerate(texts):
                if len(text) < a.least:
                    continue
                code = np.array([known(w, -1) for w in text])
                edges = np.flatnonzero(np.diff(np.concatenate(([False], code >= 0, [False]))))
                spans, found, longest = results[k]
                for low, high in edges.reshape(-1, 2):
                    if high - low >= a.least:
                        new, most = a.matches(code[low:high].tolist(), int(low), found)
                        spans += new
                        longest = max(longest, most)
                results[k] = (spans, found, longest)
        return results


def _decontaminate(shipped, text_col: str, n: int, share: float, block_words: int, clean: bool):
    every = round(1 / share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _Matcher(shipped.value, n, block_words)
        for batch in batches:
            out = []
            texts = field(batch, text_col)
            for at in range(0, len(texts), 256):
                some = texts.slice(at, 256).to_pylist()
                split = [words(t) for t in some]
                for text, w, (spans, found, longest) in zip(some, split, matcher.hits(split)):
                    cut = merged([{"low": a, "high": b} for a, b in spans])
                    n_hit = int((cut[:, 1] - cut[:, 0]).sum())
                    bad = n_hit > 0 and every * n_hit >= len(w)
                    ids = sorted(found)
                    out.append(
                        {
                            "n_words": len(w), "n_hit": n_hit, "n_items": len(ids),
                            "items_sha256": hashlib.sha256(",".join(ids).encode()).hexdigest(),
                            "contaminated": bad, "longest": longest, "items": ids,
                            "spans": [{"low": a, "high": b} for a, b in cut.tolist()],
                            "clean": (_without(text, cut) if bad else text) if clean else None,
                        }
                    )
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, OUT_ARROW)], ["row", "out"])

    return run


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    n: int = 13,
    share: float = 0.05,
    block_words: int = 500_000,
    max_item_bytes: int = 256 << 20,
    clean: bool = True,
) -> DataFrame:
    """``row`` and ``out``: the words of each text hit by windows of ``n`` words of the items.

    A text is contaminated if at least ``share`` (one part in a whole number) of its words are
    hit; ``clean`` is the text without its hit spans then, and the text itself otherwise. An
    item of fewer than ``n`` words is one window. Null and empty texts have no words and are
    never hit; items without words hit nothing; a null item id is written as the empty string;
    items of equal id count once. Raises ValueError if the items hold more than ``max_item_bytes``.
    """
    some = items.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(item_text).alias("text")
    ).where("text is not null")
    size = some.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > max_item_bytes:
        raise ValueError(f"{size} bytes of items are more than max_item_bytes, {max_item_bytes}")
    collected = [(r["id"], r["text"]) for r in some.collect()]
    shipped = docs.sparkSession.sparkContext.broadcast(collected)
    return docs.select(F.struct("*").alias("row")).mapInArrow(
        _decontaminate(shipped, text_col, n, share, block_words, clean), table_schema(docs, OUT)
    )
