"""Token ids in ORC (operator 2).

``write_token_orc`` tokenizes every whole text and writes one row per document
(part, doc_id, first, n_tokens, ids) in ascending doc_id order: documents are
range-partitioned by doc_id, each partition is one file, and ``first`` is the
number of ids before the document in its file. ORC stores the ids with integer
run-length encoding; stripes carry row indexes (min/max per stride) and Bloom
filters on doc_id, so Spark reads stripes in parallel and a filter on doc_id
skips files, stripes and strides by metadata alone.

A text of plain characters whose spaces are single falls apart at its spaces
into pieces that the byte-level pre-tokenizer can never join; the library's
model encodes each distinct piece once per Python worker (bounded memory). Any other
text is encoded whole by the library.

Defined cases: a null text is empty and holds only the end id; null doc_ids
sort first; rows equal in doc_id and text are interchangeable; an empty table
writes no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kestrel.storage import broadcast_if_small, materialize, scratch_path

END_ID = 0
STRIPE_BYTES = 64 << 20
ROW_STRIDE = 10_000
SCHEMA = "part int, doc_id long, first long, n_tokens long, ids array<int>"

# line feeds, printable ASCII and Latin letters; with single spaces such a text falls apart at its spaces
_ODD_ASCII, _ODD = re.compile(r"[^\n -~]"), re.compile(r"[^\n -~À-ÖØ-öø-ɏ]")


def _is_plain(text: str) -> bool:
    return "  " not in text and " \n" not in text and "<|" not in text and not (_ODD_ASCII if text.isascii() else _ODD).search(text)


class PieceIds(dict):
    """piece (as it stands after a space) -> its ids, little-endian uint32.
    The pre-tokenizer's pattern cuts a piece, the library's model encodes each
    pre-token; a word with a run of marks behind it is cut without the
    pattern, and single line feeds, which stand alone, cut a piece first. At
    ``limit`` pieces the older half is forgotten."""

    def __init__(self, tok, limit: int):
        super().__init__()
        self.tokenize, self.limit = tok.model.tokenize, limit
        self.bytes_of = [struct.pack("<I", i) for i in range(tok.get_vocab_size())]
        # byte-level spelling: printable Latin-1 bytes stand for themselves, the others follow from U+0100
        printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        self.spelling = {b: 0x100 + i for i, b in enumerate(x for x in range(256) if x not in printable)}
        self.space = chr(self.spelling[0x20])
        self.cut = regex.compile(public_tokenizers.PATTERN).findall
        self.marked = re.compile(r"([^\W\d_]+)([^\w\s']+)").fullmatch
        self.line_feed = self.ids("\n")
        self.inner: dict[str, bytes] = {}  # pre-tokens and line starts that no space precedes

    def ids(self, token: str) -> bytes:
        if token.isascii() and token.isprintable():
            spelled = token.replace(" ", self.space)
        else:
            spelled = token.encode().decode("latin-1").translate(self.spelling)
        return b"".join([self.bytes_of[x.id] for x in self.tokenize(spelled)])

    def inside(self, token: str) -> bytes:
        ids = self.inner.get(token)
        if ids is None:
            ids = self.inner[token] = self.ids(token)
        return ids

    def line_start(self, part: str) -> bytes:
        ids = self.inner.get(part)
        if ids is None:
            if len(self.inner) >= self.limit:
                self.inner.clear()
            ids = self.inner[part] = self.ids(part) if part.isalpha() else b"".join([self.inside(t) for t in self.cut(part)])
        return ids

    def __missing__(self, piece: str) -> bytes:
        if "\n" in piece:
            head, *rest = piece.split("\n")
            if all(rest):
                return self.line_feed.join((self[head], *map(self.line_start, rest)))
        if len(self) >= self.limit:
            for old in list(itertools.islice(self, self.limit // 2)):
                del self[old]
            self.inner.clear()
        if piece.isalpha():
            out = self.ids(" " + piece)
        elif (m := self.marked(piece)) is not None:
            word, marks = m.groups()
            out = self.get(word)
            if out is None:
                out = self[word] = self.ids(" " + word)
            out += self.inside(marks)
        else:
            first, *rest = self.cut(" " + piece)
            opened = first[1:]
            out = self.get(opened) if opened != piece else None
            if out is None:
                out = self.ids(first)
                if opened.isalpha():
                    self[opened] = out
            for token in rest:
                out += self.inside(token)
        self[piece] = out
        return out


class PieceEncoder:
    """text -> little-endian uint32 ids (bytes), by the tokenizers library."""

    def __init__(self, tokenizer_file: str, limit: int = 400_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer_file)
        self.known = PieceIds(self.tok, limit)
        self.space = self.whole([" "])[0]

    def whole(self, texts: list[str]) -> list[bytes]:
        enc = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in enc]

    def encode(self, texts: list[str]) -> list[bytes]:
        out, ids = [], self.known.__getitem__
        for t in texts:
            if not t:
                out.append(b"")
            elif not _is_plain(t):
                out.append(self.whole([t])[0])
            else:
                head, *tail = t.split(" ")
                first = self.whole([head])[0] if head else b""
                end = b""
                if tail and not tail[-1]:  # the text ends in a space
                    tail.pop()
                    end = self.space
                out.append(b"".join((first, *map(ids, tail), end)))
        return out


_encoders: dict[str, PieceEncoder] = {}


def worker_encoder(tokenizer_file: str) -> PieceEncoder:
    """One encoder for each Python worker: the tasks after its first start
    with the pieces it knows."""
    if tokenizer_file not in _encoders:
        _encoders[tokenizer_file] = PieceEncoder(tokenizer_file)
    return _encoders[tokenizer_file]


def tokenized(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Rows of the file format, range-partitioned and sorted by doc_id."""
    s = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
         .withColumn("tie", F.xxhash64("text")).withColumn("scan", F.monotonically_increasing_id())
         .repartitionByRange("doc_id", "tie", "scan").sortWithinPartitions("doc_id", "tie", "scan")
         .select(F.spark_partition_id().alias("part"), "doc_id", "text"))
    names = ["part", "doc_id", "first", "n_tokens", "ids"]
    end = np.array([END_ID], dtype="<u4").tobytes()

    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, first = worker_encoder(tokenizer_file), 0
        for whole in it:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                data = enc.encode(b.column("text").to_pylist())
                n = np.array([len(x) // 4 + 1 for x in data], dtype=np.int64)
                ids = np.frombuffer(end.join([*data, b""]), dtype="<i4")
                offsets = np.concatenate([[0], np.cumsum(n)])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [b.column("part"), b.column("doc_id").cast(pa.int64()), pa.array(first + offsets[:-1]), pa.array(n), lists], names=names)
                first += int(offsets[-1])

    return s.mapInArrow(encode, SCHEMA)


def write_token_orc(docs: DataFrame, path: str, tokenizer_file: str) -> None:
    (tokenized(docs, tokenizer_file).write
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(ROW_STRIDE))
     .option("orc.stripe.size", str(STRIPE_BYTES)).option("compression", "zstd").orc(path))


def read_token_orc(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows of the files; with ``doc_ids`` the filter reaches the reader, which
    skips by file, stripe and stride statistics and the Bloom filters."""
    df = spark.read.schema(SCHEMA).orc(path)
    return df.where(F.col("doc_id").isin(doc_ids)) if doc_ids is not None else df


def document_spans(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document: offsets
    of the files come from their totals, checksums from the stored ids."""
    rows = read_token_orc(spark, path)

    def check(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            ids = b.column("ids")
            flat, off = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:z]) for a, z in zip(off[:-1], off[1:], strict=True)]
            n = pa.array(np.diff(off).astype(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("part"), b.column("doc_id"), b.column("first"), n, pa.array(crc, pa.int64())],
                                             names=["part", "doc_id", "first", "n_tokens", "ids_crc32"])

    spans = materialize(rows.mapInArrow(check, "part int, doc_id long, first long, n_tokens long, ids_crc32 long"), "spans")
    files = spans.groupBy("part").agg(F.max(F.col("first") + F.col("n_tokens")).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    offsets = files.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return spans.join(broadcast_if_small(offsets, 1_000_000), "part").select(
        "doc_id", (F.col("offset") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    spark = docs.sparkSession
    path = scratch_path(spark, "token-orc")
    write_token_orc(docs, path, tokenizer_file)
    return document_spans(spark, path)
