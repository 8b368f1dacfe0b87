"""Token ids as Arrow stream files of equal-length sequences with masks.

A file is an Arrow IPC stream. Its batches have two fixed-size-list columns, ``ids`` and
``mask``, of ``length`` values a row, and all batches but the last have ``rows`` rows, so any
sequence of a mapped file is an array view without a copy. Masks are coded by a dictionary, since only
the last sequence of a file has filling: a whole mask is stored once and each row has an index of one byte. Beside it, ``<name>.docs`` is an
Arrow stream (doc_id, start, n_tokens) that says where in the file's ids each document lies.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierline.llm.common import arrow_map, by_ranges, kept_by, shuffle_width, slices, stored, texts_of
from tierline.llm.pool import PiecePool, runs, starts_of
from tierline.sources.scratch import scratch_dir

LENGTH = 2048
ROWS = 64
END_ID = 0
#: A space that no text follows at once.
_LOOSE = re.compile(r" (?:\s|\Z)")
#: Pieces the library is given at once.
CALL = 512


class PieceEncoder(PiecePool):
    """Encodes texts with a byte-level BPE of the tokenizers library.

    A space that a non-space follows always begins a pre-token, so a text may be cut there and
    its pieces encoded apart, or put together and encoded as one. The library takes hundreds of new pieces as one text,
    whose ids are dealt to the pieces by the bytes they stand for, and in this thread: Spark runs as many tasks as
    there are cores. Pieces that begin otherwise (the first of a text) go as words that are cut already; they are named by
    themselves after a space, the others by what follows their space.
    """

    # A piece that is not kept is merged anew when it is met again; a kept one takes about 150 bytes.
    kept = 1_000_000

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # A piece is asked for once, so what the library would keep of it is not met again.
        self.tokenizer.model._resize_cache(0)
        super().__init__(np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4"))
        #: Bytes of each id: a letter of a byte-level piece is one byte, an added token is text.
        self.bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for piece, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = len(piece)
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            self.bytes[i] = len(token.content.encode())

    def split(self, text: str) -> list[str]:
        first, *rest = text.split(" ")
        if not _LOOSE.search(text):
            return [" " + first, *rest] if first else rest
        pieces = [first] if first else []
        for r in rest:
            if pieces and (not r or r[0].isspace()):
                pieces[-1] += " " + r
            else:
                pieces.append(" " + r)
        return [p[1:] if p[0] == " " and len(p) > 1 and not p[1].isspace() else " " + p for p in pieces]

    def ids_of_new(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        bare = np.fromiter((p[0] == " " for p in pieces), bool, len(pieces))
        ids, lengths = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for encode, some in ((self.as_text, [p for p in pieces if p[0] != " "]), (self.as_words, [p[1:] for p in pieces if p[0] == " "])):
            for i in range(0, len(some), CALL):
                got, counts = encode(some[i : i + CALL])
                ids.append(got)
                lengths.append(counts)
        counts, place = np.concatenate(lengths), np.argsort(bare, kind="stable")
        starts, back = starts_of(counts), np.empty_like(place)
        back[place] = np.arange(len(place))
        return np.concatenate(ids)[runs(starts[back], counts[back])], counts[back]

    def as_text(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of a space and a word each, encoded as the text they make up."""
        text = " " + " ".join(words)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
        sizes = np.fromiter(map(len, words if text.isascii() else map(str.encode, words)), np.int64, len(words))
        after, ends = np.cumsum(self.bytes[ids]), np.cumsum(sizes + 1)
        # An id that reaches over the end of a piece cannot be dealt out.
        last = np.searchsorted(after, ends)
        if last[-1] != len(ids) - 1 or (after[last] != ends).any():
            return self.as_words([" " + w for w in words])
        return ids, np.diff(last, prepend=-1)

    def as_words(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        return np.array(got.ids, self.dtype), np.bincount(np.array(got.word_ids, np.int64), minlength=len(pieces))


@cache
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


kept_by(__name__, encoder.cache_clear)


class Shard:
    """Writes one file and its list of documents."""

    def __init__(self, folder: str, name: str, dtype: np.dtype, length: int, rows: int):
        self.fs, path = open_folder(folder)
        self.fs.create_dir(path, recursive=True)
        self.path, self.name, self.length, self.rows, self.dtype = f"{path}/{name}", name, length, rows, dtype
        self.schema = pa.schema(
            {"ids": pa.list_(pa.from_numpy_dtype(dtype), length), "mask": pa.dictionary(pa.int8(), pa.list_(pa.uint8(), length))}
        )
        self.whole = np.ones((1, length), np.uint8)
        self.sink = self.fs.open_output_stream(self.path)
        self.out = pa.ipc.new_stream(self.sink, self.schema)
        self.docs_schema = pa.schema({"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64()})
        self.docs_sink = self.fs.open_output_stream(f"{self.path}.docs")
        self.docs = pa.ipc.new_stream(self.docs_sink, self.docs_schema)
        self.rest = np.zeros(0, dtype)
        self.tokens = self.n_docs = 0

    def _batch(self, ids: np.ndarray, real: int) -> None:
        masks, kind = self.whole, np.zeros(len(ids) // self.length, np.int8)
        if real < len(ids):  # only the last sequence of a file has filling
            masks = np.vstack((masks, np.arange(self.length) < real - len(ids) + self.length)).astype(np.uint8)
            kind[-1] = 1
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, masks.ravel())]
        columns[1] = pa.DictionaryArray.from_arrays(pa.array(kind), columns[1])
        self.out.write_batch(pa.record_batch(columns, schema=self.schema))

    def add(self, doc_ids: list, ids: np.ndarray, counts: np.ndarray) -> None:
        starts = self.tokens + starts_of(counts)
        self.docs.write_batch(
            pa.record_batch([pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts)], schema=self.docs_schema)
        )
        self.tokens += len(ids)
        self.n_docs += len(doc_ids)
        held, step = np.concatenate((self.rest, ids.astype(self.dtype))), self.length * self.rows
        whole = len(held) // step * step
        for i in range(0, whole, step):
            self._batch(held[i : i + step], step)
        self.rest = held[whole:]

    def close(self) -> None:
        if real := len(self.rest):
            padded = -(-real // self.length) * self.length
            self._batch(np.concatenate((self.rest, np.zeros(padded - real, self.dtype))), real)
        for x in (self.out, self.docs, self.sink, self.docs_sink):
            x.close()


def open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    """The store of a folder (a path, or file:, s3:, gs:, hdfs: and others) and the folder's path in it."""
    return pafs.FileSystem.from_uri(folder)


def open_stream(folder: str, name: str) -> tuple[pa.ipc.RecordBatchStreamReader, object]:
    store, path = open_folder(folder)
    local = isinstance(store, pafs.LocalFileSystem)
    source = pa.memory_map(f"{path}/{name}") if local else store.open_input_file(f"{path}/{name}")
    return pa.ipc.open_stream(source), source


class Sequences:
    """Random access to the sequences of a file: ``s[i]`` is (ids, mask) of sequence i, without a copy.

    A mask has a byte for each id: 1 for an id of a document, 0 for filling.
    """

    def __init__(self, folder: str, name: str):
        reader, self._source = open_stream(folder, name)
        self.batches = list(reader)
        self.rows = self.batches[0].num_rows if self.batches else 1
        self.length = reader.schema.field("ids").type.list_size

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if not 0 <= i < len(self):
            raise IndexError(i)
        batch, at = self.batches[i // self.rows], i % self.rows
        masks = batch.column("mask")
        return (
            batch.column("ids")[at].values.to_numpy(zero_copy_only=True),
            masks.dictionary[masks.indices[at].as_py()].values.to_numpy(zero_copy_only=True),
        )


def real_ids(batch: pa.RecordBatch) -> np.ndarray:
    """The ids of a batch without its filling, which can only be at the end of a file."""
    masks = batch.column("mask")
    per_mask = masks.dictionary.flatten().to_numpy().reshape(len(masks.dictionary), -1).sum(axis=1, dtype=np.int64)
    real = int(per_mask[masks.indices.to_numpy()].sum())
    return batch.column("ids").values.to_numpy(zero_copy_only=True)[:real]


MANIFEST = "shard int, folder string, file string, n_docs long, n_tokens long"


def write_tokens(
    df: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text", end_id: int = END_ID,
    length: int = LENGTH, rows: int = ROWS, folder: str | None = None,
) -> DataFrame:
    """Writes the ids of every whole text in ascending id order; returns the table of files.

    Each range of ids is a shard with a file of its own; ``shard_start`` is the number of ids in all
    shards before. ``end_id`` ends each document. Null ids come first, a null text is empty (its end
    id alone); rows that share an id follow one another by text; an empty table writes no file. A
    file's name is new for each attempt at a task and only a finished attempt lists its own, so
    lost executors and repeated attempts leave no trace in the table.
    """
    spark = df.sparkSession
    folder = folder or scratch_dir(spark, "tokens")
    parts = shuffle_width(spark)
    rows_in = by_ranges(df.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text")), "id", parts)
    dealt = rows_in.repartitionById(parts, F.col("_range")).sortWithinPartitions("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = None, 0
        enc = encoder(tokenizer)
        for batch in batches:
            if not batch.num_rows:
                continue
            if shard is None:
                number = batch.column("_range")[0].as_py()
                shard = Shard(folder, f"{number:06d}-{uuid.uuid4().hex[:12]}.arrow", enc.dtype, length, rows)
            texts, ids = texts_of(batch, "text"), batch.column("id").to_pylist()
            for s in slices(texts):
                got, counts = enc.ids(texts[s])
                ends = np.insert(got, np.cumsum(counts), end_id)
                shard.add(ids[s], ends, counts + 1)
        if shard:
            shard.close()
            columns = [[number], [folder], [shard.name], [shard.n_docs], [shard.tokens]]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["shard", "folder", "file", "n_docs", "n_tokens"],
            )

    files = stored(arrow_map(dealt, write, MANIFEST), "token-files")
    # One row for each shard, so a single window is small.
    before = F.sum("n_tokens").over(W.orderBy("shard")) - F.col("n_tokens")
    return files.withColumn("shard_start", before)


def read_documents(files: DataFrame) -> DataFrame:
    """From the files of ``write_tokens``: doc_id, start, n_tokens, ids_crc32 of every document.

    A task maps one file at a time and keeps the ids of one batch and of the document in hand.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            ids, source = open_stream(row["folder"], row["file"])
            docs, docs_source = open_stream(row["folder"], row["file"] + ".docs")
            pending, have = [], 0

            def take(n: int, ids=ids) -> int:
                nonlocal pending, have
                while have < n:
                    pending.append(real_ids(ids.read_next_batch()))
                    have += len(pending[-1])
                crc = 0
                while n:
                    head = pending[0]
                    crc = zlib.crc32(head[:n].astype("<u4").tobytes(), crc)
                    used = min(n, len(head))
                    pending[0] = head[used:]
                    if not len(pending[0]):
                        pending.pop(0)
                    n, have = n - used, have - used
                return crc

            for d in docs:
                counts = d.column("n_tokens").to_numpy()
                yield pa.record_batch(
                    [
                        d.column("doc_id"),
                        pa.array(d.column("start").to_numpy() + row["shard_start"]),
                        d.column("n_tokens"),
                        pa.array([take(int(n)) for n in counts], pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )
            source.close()
            docs_source.close()

    parts = shuffle_width(files.sparkSession)
    dealt = files.repartitionById(parts, F.col("shard"))
    return arrow_map(dealt, read, "doc_id long, start long, n_tokens long, ids_crc32 long")
