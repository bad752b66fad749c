"""Token files: exact round trip against the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from quern.llm import token_files
from quern.llm.token_files import Encoder, TokenFile, read_token_files, split_pattern, write_token_files

WORDS, BYTES = (public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k"))
ODD = [
    "á b́", " ́x̧ ̸=", "İstanbul ΣΑΣ", "it's don't 'll 12 3 DON'T", "<|endoftext|>x <|END",
    " a b　c\x1c d\x85e", "#\x02 2", "日本語 テキスト😀", "ſ K Å", "", None, " \t", "Ünï ×÷ª ßÿ¿\x7f a\x0bb",
]


def _texts(n):
    rng = random.Random(5)
    letters = list("ab'st1 \nń̸é😀<|>İς 각ÀÞ×'RE")
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_encoder_equals_the_tokenizer(monkeypatch):
    texts = _texts(3000)
    assert split_pattern(open(WORDS).read()) and not split_pattern(open(BYTES).read())
    for path in (WORDS, BYTES):
        whole = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
        for block, known in ((1 << 23, 1 << 20), (64, 40)):
            monkeypatch.setattr(token_files, "BLOCK", block)
            monkeypatch.setattr(token_files, "KNOWN", known)
            got, rest = [], []
            for _, ids, ends in Encoder(open(path).read()).batches(pa.array(texts)):
                if ends[0] < 0:
                    rest.extend(ids)
                    continue
                for low, high in zip([0, *ends], ends, strict=False):
                    got.append(rest + ids[low:high].tolist())
                    rest = []
            assert got == [e.ids for e in whole]


def _wanted(rows, path, end_id):
    tokenizer, at, out = Tokenizer.from_file(path), 0, []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_round_trip(spark, monkeypatch):
    rows = [(i * 3 % 1009, t) for i, t in enumerate(_texts(900))]
    rows += [(2000, "word " * 30_000 + "ÀB"), (2001, "x" * 3_000)]
    docs = spark.createDataFrame([(i, "x", t, 1) for i, t in rows], "doc_id long, ids string, text string, start int")
    rows.sort(key=lambda r: r[0])
    for path, length in ((WORDS, 64), (WORDS, 2048), (BYTES, 64)):
        manifest = write_token_files(docs.repartition(4), path, length=length, batch_rows=8).cache()
        assert sorted(map(tuple, read_token_files(manifest).collect())) == _wanted(rows, path, 2)
        shards = manifest.orderBy("shard").collect()
        assert [s.first_sequence for s in shards] == list(np.cumsum([0, *(s.n_sequences for s in shards[:-1])]))
        everything = []
        for s in shards:
            file = TokenFile(s.path)
            assert len(file) == s.n_sequences and file.length == length
            for i in range(len(file)):
                ids, mask = file.sequence(i)
                assert len(ids) == len(mask) == length and ids.base is not None
                filled = mask.true_count
                assert filled == length or i == len(file) - 1
                assert mask[:filled].true_count == filled and not ids[filled:].any()
                everything.extend(ids[:filled])
        whole = Tokenizer.from_file(path)
        assert everything == [x for _, t in rows for x in [*whole.encode(t or "", add_special_tokens=False).ids, 2]]
        manifest.unpersist()


def test_nulls_repeats_and_nothing(spark):
    rows = [(None, "a"), (None, None), (5, "same"), (5, "same"), (5, None), (-1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = read_token_files(write_token_files(docs, WORDS)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, -1, 5, 5, 5]
    assert sorted(r.n_tokens for r in got) == [1, 1, 1, 2, 2, 2]
    assert [r.start for r in got] == list(np.cumsum([0, *(r.n_tokens for r in got[:-1])]))
    none = write_token_files(docs.where("false"), WORDS)
    assert none.count() == 0 and read_token_files(none).count() == 0
