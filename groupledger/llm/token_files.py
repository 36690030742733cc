"""Token-ID files: flat unsigned integers, with 64-bit document offsets beside them.

A partition writes NUMBER.ids (all ids of its documents, in order), NUMBER.offsets (where
each document starts, and the end) and NUMBER.docs (the doc_ids). The place of a
partition's first id among all ids is the sum of the partitions before it.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe
from .common import new_folder, table, whole
from .files import mapped, published

#: The id that ends a document.
END = 2
#: Chunks whose ids a worker remembers.
KNOWN = 700_000
#: Bytes of texts whose pieces are looked at together; a text is never cut off.
CHUNK = 24_000_000
#: Bytes of pieces that go through the tokenizer at once, and of texts whose ids are put together.
RUN, GATHERED = 100_000, 2_000_000
#: Stands for a null doc_id in the files.
NO_ID = -(1 << 63)
#: A space between white space: there a text can't be cut without changing its tokens.
_UNCUT = re.compile(r" (?<=\s.)(?=\s|\Z)")
#: White space that pieces start with, and the kinds of bytes.
BLANK = b"\t\n\v\f\r "
WHITE, MARK = 1, 2
KINDS = bytes(
    WHITE if c in BLANK else MARK if c in string.punctuation.encode() else 0 for c in range(256)
)
#: Bytes that may end a character other than white space, and ASCII letters and digits.
SOLID = np.array([c >= 128 or not chr(c).isspace() for c in range(256)])
LETTER = np.array([c < 128 and chr(c).isalnum() for c in range(256)])


class Encoder:
    """Ids of texts as bytes. A byte-level tokenizer starts a new token at every space
    that text follows or precedes, and where letters meet a full stop or comma, so a
    text's ids are those of its pieces; each piece goes through the tokenizer once."""

    def __init__(self, path: str, end: int = END):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        size = max(self.tokenizer.get_vocab_size(with_added_tokens=True), end + 1)
        self.kind, self.code = ("<u2", "H") if size <= 1 << 16 else ("<u4", "I")
        self.end = self._bytes([end])
        self.model = self.tokenizer.model
        self.spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.special = any(
            x.content.lstrip().isalpha()
            for x in self.tokenizer.get_added_tokens_decoder().values()
        )
        self.known: dict[str, bytes] = {}  # by piece, with the space before it
        self.stems: dict[str, bytes] = {}  # by piece without its last marks

    def _bytes(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _tokenized(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [self._bytes(x.ids) for x in found]

    def _letters(self, texts: list[str]) -> list[bytes]:
        """The same for texts of letters with or without a space before them: each is one
        token of the pre-tokenizer, so the model can have it at once."""
        if not texts:
            return []
        spelled = self.spelled.pre_tokenize_str("".join(texts))[0][0]
        ends = list(accumulate(len(x.encode()) for x in texts))
        tokenize = self.model.tokenize
        return [
            self._bytes([x.id for x in tokenize(spelled[a:b])])
            for a, b in zip([0, *ends], ends, strict=False)
        ]

    def _learn(self, pieces: set[str]) -> None:
        cut = {}
        for piece in pieces:
            stem = piece.rstrip(".,")
            cut[piece] = stem if stem[-1:].isalpha() else piece
        wanted = {*cut.values(), *(p[len(s):] for p, s in cut.items() if len(s) < len(p))}
        letters, others = [], []
        for text in wanted.difference(self.stems):
            plain = not self.special and (text[1:] if text[:1] == " " else text).isalpha()
            (letters if plain else others).append(text)
        self.stems.update(zip(letters, self._letters(letters), strict=True))
        self.stems.update(zip(others, self._tokenized(others), strict=True))
        for piece, stem in cut.items():
            rest = piece[len(stem):]
            self.known[piece] = self.stems[stem] + (self.stems[rest] if rest else b"")

    def encoded(self, texts: list[str]) -> list[bytes]:
        """The ids of each text with the end id."""
        if len(self.known) > KNOWN:
            self.known.clear()
            self.stems.clear()
        cut, new = [], set()
        for text in texts:
            first, *later = text.split(" ")
            pieces = None if _UNCUT.search(text) else [first, *[f" {x}" for x in later]]
            cut.append(pieces)
            new.update(pieces or ())
        self._learn(new.difference(self.known))
        return [
            (self._tokenized([text])[0] if pieces is None
             else b"".join(map(self.known.__getitem__, pieces))) + self.end
            for text, pieces in zip(texts, cut, strict=True)
        ]


def _parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the texts of a large string array start, with the end, and their bytes."""
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    edges = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    return edges - edges[0], np.frombuffer(data or b"", np.uint8)[edges[0]:edges[-1]]


def _runs(edges: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Neighbouring parts, given by their edges, in runs of up to most, one part at least."""
    low = 0
    while low < len(edges) - 1:
        high = max(int(np.searchsorted(edges, edges[low] + most, "right")) - 1, low + 1)
        yield low, high
        low = high


def _kinds(data: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().translate(KINDS), np.uint8)


def _solid(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place in UTF-8 bytes is surely no white space."""
    x, y, z = (data[np.maximum(at - back, 0)] for back in (3, 2, 1))
    blank = (y == 0xC2) & ((z == 0x85) | (z == 0xA0)) | (
        (x >= 0xE1) & (x <= 0xE3) & ((y == 0x80) | (y == 0x81) | (y == 0x9A))
        & ((z <= 0x8A) | np.isin(z, (0x9F, 0xA8, 0xA9, 0xAF)))
    )
    return SOLID[z] & ~((z >= 128) & blank)


def _lettered(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before is surely a letter or a digit: of ASCII or Latin-1."""
    y, z = data[np.maximum(at - 2, 0)], data[at - 1]
    return LETTER[z] | (z >= 128) & (y == 0xC3) & (z != 0x97) & (z != 0xB7)


def cuts(data: np.ndarray) -> np.ndarray:
    """Places in UTF-8 bytes at which a byte-level tokenizer starts a new token whatever
    stands around them: white space that follows another character, and punctuation that
    follows a letter or a digit. Texts can be encoded in parts there."""
    kinds = _kinds(data)
    white, marks = (np.flatnonzero(kinds[1:] == kind) + 1 for kind in (WHITE, MARK))
    return np.concatenate([white[_solid(data, white)], marks[_lettered(data, marks)]])


def chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in runs of about CHUNK bytes each, one text at least."""
    edges = np.append(0, np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64))
    for low, high in _runs(edges, CHUNK):
        yield texts.slice(low, high - low)


@lru_cache(1)
def _tokenizer(data: bytes):
    """The tokenizer of a file's bytes, which a worker keeps for its next task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(data)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class CutEncoder:
    """Ids of texts by a byte-level BPE tokenizer. Texts are cut (``cuts``), and the distinct
    pieces go through the tokenizer once, many joined to one text: the bytes of its tokens
    tell where a piece ends. A text with an added token is one piece."""

    def __init__(self, data: bytes, lengths: np.ndarray, special: Sequence[str], end: int = END):
        self.tokenizer, self.bytes, self.special = _tokenizer(data), lengths, special
        self.kind = "<u2" if max(len(lengths), end + 1) <= 1 << 16 else "<u4"
        self.joins = not any(c.isspace() for token in special for c in token)

    def _tokenized(self, texts: list[str]) -> Iterator[np.ndarray]:
        for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(x.ids, self.kind)

    def _learned(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of distinct pieces, and where those of each start and end."""
        edges, data = _parts(pieces)
        # pieces from white space to another character can stand one after the other
        plain = (_kinds(data)[edges[:-1]] == WHITE) & _solid(data, edges[1:]) & self.joins
        order, count = np.argsort(~plain, kind="stable"), int(plain.sum())
        ordered = pieces.take(pa.array(order))
        edges, data = _parts(ordered)
        found = [np.empty(0, self.kind)]
        for low, high in _runs(edges[:count + 1], RUN):
            found += self._tokenized([str(data[edges[low]:edges[high]], "utf-8")])
        for low, high in _runs(edges[count:], RUN):
            found += self._tokenized(ordered[count + low:count + high].to_pylist())
        ids = np.concatenate(found)
        token_edges = np.append(0, np.cumsum(self.bytes[ids]))
        places = np.searchsorted(token_edges, edges)
        if not np.array_equal(token_edges[np.minimum(places, len(ids))], edges):
            raise ValueError("the tokens of a text do not spell it")
        starts, ends = np.empty((2, len(pieces)), np.int64)
        starts[order], ends[order] = places[:-1], places[1:]
        return ids, starts, ends

    def encoded(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Run by run of texts all ids, one text after the other, and the number of each's."""
        texts = texts.cast(pa.large_string())
        edges, data = _parts(texts)
        marks = np.zeros(len(data) + 1, bool)
        marks[cuts(data)] = True
        for token in self.special:
            for i in np.flatnonzero(pc.match_substring(texts, token).to_numpy(zero_copy_only=False)):
                marks[edges[i] + 1:edges[i + 1]] = False
        marks[edges] = True
        places = np.flatnonzero(marks)
        firsts = np.searchsorted(places, edges)
        pieces = pa.LargeStringArray.from_buffers(
            len(places) - 1, pa.py_buffer(places), pa.py_buffer(data)
        ).dictionary_encode()
        del marks, places
        ids, starts, ends = self._learned(pieces.dictionary)
        number = pieces.indices.to_numpy()
        for low, high in _runs(edges, GATHERED):
            some = number[firsts[low]:firsts[high]]
            lengths = ends[some] - starts[some]
            sums = np.append(0, np.cumsum(lengths))[firsts[low:high + 1] - firsts[low]]
            yield ids[bpe._ragged(starts[some], lengths)], np.diff(sums)


def _writer(path: str, folder: str, end: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder(path, end), TaskContext.get().partitionId()
        offsets, ids, width = array("Q", [0]), array("q"), np.dtype(encoder.kind).itemsize
        with published(f"{folder}/{part:06d}.ids") as out:
            for batch in batches:
                ids.extend(NO_ID if x is None else x for x in batch.column("doc_id").to_pylist())
                for low in range(0, len(batch), 64):
                    texts = batch.column("text")[low:low + 64].to_pylist()
                    for data in encoder.encoded([x or "" for x in texts]):
                        out.write(data)
                        offsets.append(offsets[-1] + len(data) // width)
        for kind, values in (("offsets", offsets), ("docs", ids)):
            with published(f"{folder}/{part:06d}.{kind}") as out:
                out.write(np.array(values, "<u8" if kind == "offsets" else "<i8").tobytes())
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "n_tokens": pa.array([offsets[-1]], pa.int64()),
            "kind": pa.array([encoder.kind]),
        })

    return write


def _cut_writer(data: bytes, model: bpe.Model, folder: str, end: int):
    """The same for byte-level BPE models, whose texts are cut into pieces."""
    lengths, special = model.lengths, tuple(model.special)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = CutEncoder(data, lengths, special, end), TaskContext.get().partitionId()
        starts, docs, total = [np.zeros(1, np.int64)], [], 0
        with published(f"{folder}/{part:06d}.ids") as out:
            for batch in batches:
                docs.append(batch.column("doc_id").fill_null(NO_ID).to_numpy())
                for some in chunks(batch.column("text")):
                    for ids, sizes in encoder.encoded(some):
                        out.write(np.insert(ids, np.cumsum(sizes), end).tobytes())
                        starts.append(total + np.cumsum(sizes + 1))
                        total = int(starts[-1][-1])
        for name, values in (("offsets", np.concatenate(starts).astype("<u8")),
                             ("docs", np.concatenate([np.empty(0, np.int64), *docs]).astype("<i8"))):
            with published(f"{folder}/{part:06d}.{name}") as out:
                out.write(values.tobytes())
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "n_tokens": pa.array([total], pa.int64()),
            "kind": pa.array([encoder.kind]),
        })

    return write


def write(docs: DataFrame, tokenizer: str, folder: str, end: int = END) -> DataFrame:
    """Writes doc_id (long) and text of docs in ascending doc_id order; repeated doc_ids
    are ordered by the text's hash, null ones stand first, null texts are empty. Returns the
    partitions: part, kind (of number), base (ids in all partitions before).

    Only one row per partition reaches the driver, for the prefix sums."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    ordered = keyed.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key", "text")
    schema = "part int, n_tokens long, kind string"
    try:
        model = bpe.read_model(tokenizer)
    except ValueError:  # not a byte-level BPE model: the tokenizer itself has the whole texts
        written = ordered.drop("key").mapInArrow(_writer(tokenizer, folder, end), schema)
    else:
        with open(tokenizer, "rb") as file:
            writer = _cut_writer(file.read(), model, folder, end)
        written = ordered.select("doc_id", whole(F.col("text")).alias("text")).mapInArrow(writer, schema)
    rows = sorted(written.collect())
    bases = accumulate((r.n_tokens for r in rows), initial=0)
    parts = [(r.part, r.kind, base) for r, base in zip(rows, bases, strict=False)]
    return docs.sparkSession.createDataFrame(parts, "part int, kind string, base long")


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{folder}/{row['part']:06d}"
                ids = mapped(f"{name}.ids", row["kind"])
                offsets, docs = mapped(f"{name}.offsets", "<u8"), mapped(f"{name}.docs", "<i8")
                for low in range(0, len(docs), 4096):
                    some = docs[low:low + 4096].tolist()
                    edges = offsets[low:low + 4097].tolist()
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes())
                           for a, b in zip(edges, edges[1:], strict=False)]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array([None if x == NO_ID else x for x in some], pa.int64()),
                        "start": pa.array([row["base"] + x for x in edges[:-1]], pa.int64()),
                        "n_tokens": pa.array(np.diff(edges), pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64()),
                    })

    return read


def read(parts: DataFrame, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32."""
    return parts.repartition(max(1, parts.count()), "part").mapInArrow(
        _reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = new_folder(spark, "tokens")
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return read(write(docs, public_tokenizers.path("byte_bpe_50k.json"), folder), folder)
