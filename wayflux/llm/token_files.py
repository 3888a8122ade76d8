"""Token ids as flat binary files with 64-bit document offsets.

A set of files ``part-*`` below one folder holds documents in ascending doc_id order:

* ``.bin``  token ids, little-endian unsigned 16 or 32 bits by the size of the vocabulary
* ``.off``  unsigned 64-bit offsets into it, one more than documents
* ``.ids``  signed 64-bit doc_ids, the least value standing for null

The manifest has a row for each part: its path, documents, tokens and, as a prefix sum over the
parts before it, its base.  A document's start in the whole corpus is base + offset.  Files are named
by attempt and only those in the manifest count, so retried tasks do no harm.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayflux.llm.common import NO_ID, only, stored
from wayflux.session import work_path

END_ID = 2
#: Pieces a worker remembers the ids of; beyond it starts anew, so memory is bounded.
_REMEMBERED = 500_000
_BATCH_CHARS = 4_000_000
#: The splitting rule of byte-level BPE, narrowed to Latin-1, where all engines agree on classes.
_LETTERS, _DIGITS, _SPACES = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_PIECES = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^{_SPACES}{_LETTERS}{_DIGITS}]+"
    f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+")


class Encoder:
    """Ids of texts by a tokenizer file of the tokenizers library.

    Byte-level BPE works on each piece by itself, so in Latin-1 texts a piece goes to the library
    once and its ids are remembered.  All other texts, those with special tokens in them, and all
    texts of other kinds of tokenizers go to the library whole.
    """

    def __init__(self, path: str) -> None:
        import json

        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self._library.get_vocab_size(True) <= 65536 else "<u4")
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        splitter = parts.get("pre_tokenizer") or {}
        self._by_piece = (
            splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space") and not parts.get("normalizer")
            and not (parts["model"].get("dropout") or parts.get("truncation") or parts.get("padding")))
        self._special = [t["content"] for t in parts.get("added_tokens", [])]
        self._known: dict[str, bytes] = {}

    def _simple(self, text: str) -> bool:
        if not text.isascii():
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return False
        return not any(s in text for s in self._special)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype=self.kind).tobytes()
                for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes of ``kind``; texts that repeat are encoded once."""
        distinct = list(dict.fromkeys(texts))
        of = dict(zip(distinct, self._encode(distinct)))
        return [of[t] for t in texts]

    def _encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        plain = [k for k, t in enumerate(texts) if self._by_piece and self._simple(t)]
        pieces = [_PIECES.findall(texts[k]) for k in plain]
        if len(self._known) > _REMEMBERED:
            self._known.clear()
        new = list(set(chain.from_iterable(pieces)).difference(self._known))
        self._known.update(zip(new, self._whole(new)))
        ids = self._known.__getitem__
        for k, found in zip(plain, pieces):
            out[k] = b"".join(map(ids, found))
        rest = [k for k, x in enumerate(out) if x is None]
        for k, x in zip(rest, self._whole([texts[k] for k in rest])):
            out[k] = x
        return out


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return (pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:")
            else (pafs.LocalFileSystem(), folder))


def _opened(path: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped where it is mounted, read where it is in a store."""
    fs, path = _place(path)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r") if os.path.getsize(path) else np.zeros(0, kind)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=kind)


def _writer(folder: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        end = np.array([end_id], dtype=encoder.kind).tobytes()
        fs, where = _place(folder)
        name, files = f"part-{uuid.uuid4().hex}", {}
        n_docs, at, part_no = 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            k = 0
            while k < len(ids):
                part, size = [], 0
                while k + len(part) < len(ids) and size < _BATCH_CHARS:
                    part.append(texts[k + len(part)].as_py() or "")
                    size += len(part[-1])
                if not files:
                    fs.create_dir(where, recursive=True)
                    files = {x: fs.open_output_stream(f"{where}/{name}.{x}") for x in ("bin", "off", "ids")}
                    files["off"].write(np.zeros(1, "<u8").tobytes())
                coded = [x + end for x in encoder.encode(part)]
                ends = at + np.cumsum([len(x) // encoder.kind.itemsize for x in coded])
                files["bin"].write(b"".join(coded))
                files["off"].write(ends.astype("<u8").tobytes())
                files["ids"].write(np.asarray(ids[k:k + len(part)], dtype="<i8").tobytes())
                at, k, n_docs = int(ends[-1]), k + len(part), n_docs + len(part)
        for f in files.values():
            f.close()
        if files:
            yield pa.RecordBatch.from_pydict({
                "path": [f"{folder}/{name}"], "kind": [encoder.kind.str], "part": [part_no],
                "n_docs": [n_docs], "n_tokens": [at]})
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` (doc_id, text) as token files below ``folder``; the manifest.

    ``path, kind, n_docs, n_tokens, base`` for each part.  Each text is encoded whole without special
    tokens and closed by ``end_id``; null and empty texts are just that id.  Null ids come first, rows
    that repeat an id follow each other.  An empty table makes no files.  ``tokenizer`` and ``folder``
    must be reachable from every executor.
    """
    ranked = only(docs, doc_id="bigint", text="string").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text", F.xxhash64("text").alias("tie"))
    ordered = ranked.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    parts = stored(ordered.mapInArrow(
        _writer(folder, tokenizer, end_id),
        "path string, kind string, part bigint, n_docs bigint, n_tokens bigint"), "token-parts")
    # Parts are numbered in range order.  One row for each file: one task is enough for the sum.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        "path", "kind", "n_docs", "n_tokens",
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in batch.to_pylist():
            tokens = _opened(part["path"] + ".bin", part["kind"])
            offsets = _opened(part["path"] + ".off", "<u8").astype(np.int64)
            ids = _opened(part["path"] + ".ids", "<i8")
            for a in range(0, len(ids), 8192):
                b = min(a + 8192, len(ids))
                sums = [zlib.crc32(tokens[offsets[k]:offsets[k + 1]].astype("<u4").tobytes())
                        for k in range(a, b)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.asarray(ids[a:b]), pa.int64(), mask=np.asarray(ids[a:b] == NO_ID)),
                     pa.array(part["base"] + offsets[a:b], pa.int64()),
                     pa.array(np.diff(offsets[a:b + 1]), pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files."""
    parts = manifest.select("path", "kind", "base")
    return parts.repartition(manifest.sparkSession.sparkContext.defaultParallelism * 4, "path").mapInArrow(
        _reader, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the token files of ``docs`` below the shared folder and read them back."""
    return read_token_files(write_token_files(docs, work_path(docs.sparkSession, "tokens"), tokenizer, end_id))
