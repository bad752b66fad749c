"""Token ids of documents as Arrow files of equal-length sequences.

Documents are sorted by id over range partitions. Every task encodes its documents and lays
their ids end to end in sequences of ``length`` ids; it writes one shard, an Arrow file whose
record batches hold two fixed-size lists, ``ids`` (unsigned, 16 bits if the vocabulary fits, else
32) and ``mask`` (true for a token, false for the filling of the last sequence), and a smaller
file with the documents of the shard.
All batches but the last hold the same number of sequences and nothing is null or compressed:
sequence ``i`` of a memory-mapped shard is a view at a computed place, nothing is copied.

A task names its files anew at every attempt and reports them in its output row; only rows of
attempts that Spark committed reach the manifest, files of lost attempts are never read. The
places of shards in the whole are running sums over the manifest, one row per shard.

Where white space only separates tokens (``split_pattern``), a block of texts is cut there and
each of its different words is looked up once. Words of printable ASCII and Latin-1 letters are
split by the tokenizer's own pattern over whole columns, and its model encodes each different
piece once for all tasks of a worker; all other words go through the whole tokenizer.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quern.llm.hashing import SPACE, texts
from quern.llm.tables import stored
from quern.plans.scratch import fresh_path

BLOCK = 1 << 23  # bytes of text whose words are looked up at once
KNOWN = 300_000  # pieces whose ids a worker remembers before it starts anew
RUNS = 1 << 16  # words whose ids are put in place at once
PLAIN = "^[!-~\u00C0-\u00FF]+$"  # nothing to compose, white space nowhere, lower case letter by letter
MANIFEST = "shard int, path string, documents_path string, n_documents long, n_ids long, n_sequences long"


def split_pattern(tokenizer_json: str) -> str | None:
    """The pattern whose matches are the tokenizer's pieces, if white space only separates them.

    None unless texts are normalised by NFC, single blanks and lower case, everything but the
    matches of one pattern is dropped, and bytes stand for themselves within a match.
    """
    kinds = json.loads(tokenizer_json)
    steps = (kinds["normalizer"] or {}).get("normalizers", [])
    split, *rest = (kinds["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    if (
        [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"]
        or steps[1]["pattern"] != {"Regex": "\\s+"}
        or steps[1]["content"] != " "
        or split.get("type") != "Split"
        or not (split["behavior"] == "Removed" and split["invert"])
        or not {"[\\p{L}]+", "[^\\s\\p{L}\\p{N}]+"} <= set(split["pattern"].get("Regex", "").split("|"))
        or [s["type"] for s in rest] != ["ByteLevel"]
        or rest[0]["add_prefix_space"]
        or rest[0]["use_regex"]
        or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in kinds["added_tokens"])
        or not all(t["content"].startswith("<|") for t in kinds["added_tokens"])
    ):
        return None
    return split["pattern"]["Regex"]


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if visible in Latin-1, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


LETTERS = _byte_letters()


class Encoder:
    """Ids of texts, equal to those of ``tokenizer.encode(text, add_special_tokens=False)``."""

    def __init__(self, tokenizer_json: str) -> None:
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.pattern = split_pattern(tokenizer_json)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.start = np.zeros(1, np.int64)

    def _whole(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        return _flat(found), np.array([len(ids) for ids in found], np.int64)

    def _pieces(self, pieces: list[str]) -> np.ndarray:
        """Places of the pieces among those known."""
        if len(self.known) + len(pieces) > KNOWN:
            self._forget()
        fresh = [p for p in pieces if p not in self.known]
        if fresh:
            model = self.tokenizer.model
            found = [
                [t.id for t in model.tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(LETTERS))]
                for p in fresh
            ]
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
            self.flat = np.concatenate((self.flat, _flat(found)))
            ends = self.start[-1] + np.cumsum([len(ids) for ids in found])
            self.start = np.concatenate((self.start, ends))
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words, and how many each has."""
        plain = pc.and_(pc.match_substring_regex(words, PLAIN), pc.invert(pc.match_substring(words, "<|")))
        flat, counts = self._plain(words.filter(plain))
        if not pc.all(plain, min_count=0).as_py():
            odd, odd_counts = self._whole(words.filter(pc.invert(plain)).to_pylist())
            here = plain.to_numpy(zero_copy_only=False)
            both = np.empty(len(words), np.int64)
            both[here], both[~here] = counts, odd_counts
            ids = np.empty(both.sum(), np.uint32)
            of_plain = np.repeat(here, both)
            ids[of_plain], ids[~of_plain] = flat, odd
            flat, counts = ids, both
        return flat, counts

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        low = pc.utf8_lower(words)
        # Words of letters alone are one piece; the others come apart at the matches.
        mixed = pc.invert(pc.match_substring_regex(low, r"^\p{L}+$"))
        apart = pc.replace_substring_regex(low.filter(mixed), f"({self.pattern})", "\\1 ")
        low = pc.replace_with_mask(low, mixed, pc.ascii_rtrim_whitespace(apart))
        lists = pc.ascii_split_whitespace(low)
        coded = lists.flatten().dictionary_encode()
        place = self._pieces(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        counts = self.start[place + 1] - self.start[place]
        till = np.concatenate(([0], np.cumsum(counts)))
        offsets = lists.offsets.to_numpy()
        return _gather(self.flat, self.start[place], counts), np.diff(till[offsets - offsets[0]])

    def _of_words(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, and where each part's ids end."""
        words = pc.ascii_split_whitespace(parts)
        ends = words.offsets.to_numpy()[1:] - words.offsets[0].as_py()
        coded = words.flatten().dictionary_encode()
        if not len(coded):
            return np.zeros(0, np.uint32), np.zeros(len(ends), np.int64)
        flat, counts = self._words(coded.dictionary)
        start = np.cumsum(counts) - counts
        word = coded.indices.to_numpy()
        till = np.concatenate(([0], np.cumsum(counts[word])))
        return _gather(flat, start[word], counts[word]), till[ends]

    def batches(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For blocks of texts: number of the first, their ids, where each text's ids end.

        A text longer than a block comes as several blocks with the same first number; its end
        is -1 in all but the last.
        """
        if self.pattern is None:
            for at, text in enumerate(column.to_pylist()):
                ids, counts = self._whole([text or ""])
                yield at, ids, counts
            return
        for block in texts(column, BLOCK):
            offsets = np.concatenate((block.start[:1], block.end)).astype(np.int64)
            if len(block.end) == 1 and offsets[-1] > BLOCK:
                offsets = _cuts(block.data)
                for i in range(len(offsets) - 1):
                    ids, ends = self._of_words(_strings(block.data, offsets[i : i + 2]))
                    yield block.first, ids, ends if i == len(offsets) - 2 else np.array([-1])
            else:
                yield block.first, *self._of_words(_strings(block.data, offsets))


def _flat(found: list[list[int]]) -> np.ndarray:
    return np.fromiter((i for ids in found for i in ids), np.uint32)


def _gather(flat: np.ndarray, start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that begin at ``start``, end to end; indices are made a part at a time."""
    out = np.empty(counts.sum(), flat.dtype)
    done = 0
    for at in range(0, len(start), RUNS):
        n = counts[at : at + RUNS]
        before = np.cumsum(n) - n
        where = np.repeat(start[at : at + RUNS] - before, n)
        where += np.arange(len(where))
        np.take(flat, where, out=out[done : done + len(where)])
        done += len(where)
    return out


_encoders: dict[int, Encoder] = {}


def _encoder(tokenizer_json: str) -> Encoder:
    """One per worker and tokenizer: workers serve many tasks."""
    key = hash(tokenizer_json)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokenizer_json)
    return _encoders[key]


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(data[offsets[0] : offsets[-1]])
    buffers = [None, pa.py_buffer((offsets - offsets[0]).astype(np.int64)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, buffers)


def _cuts(data: np.ndarray) -> np.ndarray:
    """Ends of parts of about a block, each before a white space character."""
    cuts, at = [0], BLOCK
    while at < len(data):
        step = np.flatnonzero(SPACE[data[at : at + BLOCK]])
        if len(step):
            cuts.append(at + int(step[0]))
            at = cuts[-1]
        at += BLOCK
    return np.array([*cuts, len(data)], np.int64)


def _schema(length: int, kind: pa.DataType) -> pa.Schema:
    lists = [pa.list_(pa.field("item", k, nullable=False), length) for k in (kind, pa.bool_())]
    return pa.schema([pa.field("ids", lists[0], False), pa.field("mask", lists[1], False)])


DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class _Shard:
    """Collects ids and writes them in batches of ``rows`` sequences."""

    def __init__(self, path: str, length: int, rows: int, kind: pa.DataType) -> None:
        store, place = _opened(path)
        self.length, self.rows, self.schema = length, rows, _schema(length, kind)
        self.kind = kind.to_pandas_dtype()
        self.out = store.open_output_stream(place)
        self.file = pa.ipc.new_file(self.out, self.schema)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = self.n_sequences = 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        size = self.length * self.rows
        if self.n_waiting >= size:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // size * size
            for at in range(0, whole, size):
                self._write(ids[at : at + size], size)
            self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def _write(self, ids: np.ndarray, size: int) -> None:
        values, mask = np.zeros(size, self.kind), np.zeros(size, bool)
        values[: len(ids)], mask[: len(ids)] = ids, True
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((values, mask), self.schema, strict=True)
        ]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.n_sequences += size // self.length

    def close(self) -> None:
        if self.n_waiting:
            self._write(np.concatenate(self.waiting), -(-self.n_waiting // self.length) * self.length)
        self.file.close()
        self.out.close()


def _write(shipped, folder: str, length: int, rows: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, shard, docs = None, None, None
        open_length = n_documents = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if shard is None:
                name = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
                store, place = _opened(folder)
                store.create_dir(place)
                encoder = _encoder(shipped.value)
                most = max(end_id, encoder.tokenizer.get_vocab_size() - 1)
                kind = pa.uint16() if most < 1 << 16 else pa.uint32()
                shard = _Shard(f"{name}.arrow", length, rows, kind)
                store, place = _opened(f"{name}.documents.arrow")
                docs_out = store.open_output_stream(place)
                docs = pa.ipc.new_file(docs_out, DOCUMENTS)
            lengths = []
            begin = shard.n_ids - open_length
            for _, ids, ends in encoder.batches(batch.column("text")):
                if ends[0] < 0:
                    shard.add(ids)
                    open_length += len(ids)
                    continue
                here = np.diff(ends, prepend=0)
                shard.add(np.insert(ids, ends, end_id))
                here[0] += open_length
                lengths.append(here + 1)
                open_length = 0
            n = np.concatenate(lengths)
            start = begin + np.cumsum(n) - n
            docs.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(start), pa.array(n)], schema=DOCUMENTS))
            n_documents += len(n)
        if shard is not None:
            shard.close()
            docs.close()
            docs_out.close()
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "shard": TaskContext.get().partitionId(),
                        "path": f"{name}.arrow",
                        "documents_path": f"{name}.documents.arrow",
                        "n_documents": n_documents,
                        "n_ids": shard.n_ids,
                        "n_sequences": shard.n_sequences,
                    }
                ],
                pa.schema([("shard", pa.int32()), ("path", pa.string()), ("documents_path", pa.string()),
                           ("n_documents", pa.int64()), ("n_ids", pa.int64()), ("n_sequences", pa.int64())]),
            )

    return run


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str | None = None,
    length: int = 2048,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_rows: int = 512,
) -> DataFrame:
    """Encode every text, write the shards into ``folder`` (one in the shared folder if None) and
    return the manifest: a row per shard with its files, counts, and ``first_id`` and
    ``first_sequence``, its place in the whole.

    Documents stand in ascending id, null ids first, repeated ids in the order of their texts;
    after each comes ``end_id``. A null text counts as empty: its ids are the end alone. A
    sequence goes on into the next document; the last one of a shard is filled up with zeros,
    mask 0. No documents, no shard. Any further columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "tokens")
    with open(tokenizer_path, encoding="utf-8") as file:
        shipped = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = (F.col("doc_id"), F.xxhash64("text"), F.col("text"))
    manifest = stored(
        rows.repartitionByRange(*order[:2])
        .sortWithinPartitions(*order)
        .mapInArrow(_write(shipped, folder, length, batch_rows, end_id), MANIFEST),
        "manifest",
    )
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return manifest.select(
        "*",
        F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first_id"),
        F.coalesce(F.sum("n_sequences").over(before), F.lit(0)).alias("first_sequence"),
    )


class TokenFile:
    """One shard, mapped into memory where its store allows: views of ids and masks by number."""

    def __init__(self, path: str) -> None:
        store, place = _opened(path)
        local = isinstance(store, fs.LocalFileSystem)
        self.file = pa.ipc.open_file(pa.memory_map(place) if local else store.open_input_file(place))
        self.length = self.file.schema.field("ids").type.list_size
        self.rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 1

    def __len__(self) -> int:
        n = self.file.num_record_batches
        return (n - 1) * self.rows + self.file.get_batch(n - 1).num_rows if n else 0

    def _values(self, batch: int, name: str) -> pa.Array:
        return self.file.get_batch(batch).column(name).flatten()

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence ``i``."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        batch, row = divmod(i, self.rows)
        ids, mask = (self._values(batch, n).slice(row * self.length, self.length) for n in ("ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ``n`` ids from ``start`` on, as views of the batches they lie in."""
        size = self.rows * self.length
        while n > 0:
            batch, at = divmod(start, size)
            part = self._values(batch, "ids").slice(at, n).to_numpy(zero_copy_only=True)
            yield part
            start, n = start + len(part), n - len(part)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard = TokenFile(row["path"])
            store, place = _opened(row["documents_path"])
            with store.open_input_file(place) as opened:
                documents = pa.ipc.open_file(opened)
                for i in range(documents.num_record_batches):
                    part = documents.get_batch(i)
                    sums = []
                    for start, n in zip(part.column("start").to_numpy(), part.column("n_tokens").to_numpy(), strict=True):
                        crc = 0
                        for ids in shard.ids(int(start), int(n)):
                            crc = zlib.crc32(ids.astype("<u4", copy=False), crc)
                        sums.append(crc)
                    place_in_all = pc.add(part.column("start"), pa.scalar(row["first_id"], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), place_in_all, part.column("n_tokens"), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is the unsigned crc32 of
    its ids as little-endian unsigned 32-bit integers. One task reads one shard.
    """
    shards = max(1, manifest.count())
    dealt = manifest.select("path", "documents_path", "first_id").coalesce(1).repartition(shards)
    return dealt.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
