"""Byte-pair encoding by tree concatenation, and decoding.

Spark splits the texts into words as a byte-level tokenizer does. The new words of a batch
are merged in lockstep: each round applies every word's own best merge at once. A word of
more than LEAF bytes is cut into halves, their halves and so on down to leaves; the leaves
are encoded together like words, and then joined level by level. A join encodes a window of
tokens on both sides of the joint anew and doubles it until its first and last token are the
ones that stood there, so that nothing outside the window can change. All joins of a level
run together.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import table, whole

#: Bytes of a leaf; longer words are encoded by halves.
LEAF = 64
#: Tokens on each side of a joint that are encoded anew at first.
WINDOW = 4
#: Words, and ids of words, that a worker remembers.
KNOWN, KNOWN_IDS = 300_000, 3_000_000
#: Words of texts that are worked on together; a text is never cut.
CHUNK = 400_000
NONE = np.iinfo(np.int64).max

# How byte-level tokenizers split a text, and their white space.
WHITE = r"\x09-\x0D\x20\x85\xA0  -     　"
WORDS = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+"
    rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)


def _spelling() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: visible Latin-1
    characters stand for themselves, the others follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Model:
    """The merges and tokens of a byte-level BPE tokenizer file, as arrays."""

    def __init__(self, data: bytes):
        file = json.loads(data)
        model, step = file["model"], file["pre_tokenizer"] or {}
        if (model["type"], step.get("type")) != ("BPE", "ByteLevel") or file["normalizer"]:
            raise ValueError("not a plain byte-level BPE tokenizer")
        if step.get("add_prefix_space") or not step.get("use_regex", True) or model.get("ignore_merges"):
            raise ValueError("tokenizers that add spaces, keep texts whole or skip merges are not handled")
        self.special: dict[str, int] = {}
        for token in file["added_tokens"]:
            if token["lstrip"] or token["rstrip"] or token["single_word"]:
                raise ValueError(f"added token {token['content']} takes more than its own text")
            self.special[token["content"]] = token["id"]
        ids, byte = model["vocab"], _spelling()
        size = max([*ids.values(), *self.special.values()]) + 1
        texts = [b""] * size
        for text, i in ids.items():
            texts[i] = bytes(byte[c] for c in text)
        for text, i in self.special.items():
            texts[i] = text.encode()
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.first = np.zeros(256, np.int64)
        for char, b in byte.items():
            self.first[b] = ids[char]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        codes = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        self.by_code = np.argsort(codes, kind="stable")
        self.codes = codes[self.by_code]
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)

    def ranks(self, ids: np.ndarray) -> np.ndarray:
        """Of each neighbouring pair the number of its merge, NONE without one."""
        return self.rank_of(ids[:-1] << 32 | ids[1:])

    def rank_of(self, codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.by_code[at], NONE)


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 1 << 30 and (not len(starts) or starts.max() < 1 << 30) else np.int64
    shift = (starts - ends + lengths).astype(kind)
    return np.repeat(shift, lengths) + np.arange(total, dtype=kind)


def merge_flat(model: Model, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merges each of the sequences that lie one after the other in ids, all at once; the
    tokens of all, likewise, and their numbers."""
    done_ids, done_lengths, done_numbers = [ids[:0]], [lengths[:0]], [lengths[:0]]
    out, ids = np.zeros(len(lengths), np.int64), ids.copy()
    number = np.flatnonzero(lengths)
    lengths = lengths[number]
    rank = np.append(model.ranks(ids), NONE) if len(ids) else ids
    while len(number):
        ends = np.cumsum(lengths)
        starts = ends - lengths
        rank[ends - 1] = NONE
        best = np.minimum.reduceat(rank, starts)
        done = best == NONE
        if done.any():
            of_done = np.repeat(done, lengths)
            done_ids.append(ids[of_done])
            done_lengths.append(lengths[done])
            done_numbers.append(number[done])
            left = ~of_done
            ids, rank, best = ids[left], rank[left], best[~done]
            number, lengths = number[~done], lengths[~done]
            starts = np.cumsum(lengths) - lengths
        if not len(number):
            break
        hit = (rank == np.repeat(best, lengths)) & (rank != NONE)
        # in a row of equal pairs every second one merges, from the left
        place = np.arange(len(hit))
        opens = hit & ~np.append(False, hit[:-1])
        hit &= (place - np.maximum.accumulate(np.where(opens, place, 0))) % 2 == 0
        ids[hit] = model.merged[rank[hit]]
        stays = ~np.append(False, hit[:-1])
        lengths = lengths - np.add.reduceat(hit, starts)
        ids, rank, fresh = ids[stays], rank[stays], hit[stays]
        pairs = np.flatnonzero(fresh | np.append(fresh[1:], False))
        pairs = pairs[pairs < len(ids) - 1]
        rank[pairs] = model.rank_of(ids[pairs] << 32 | ids[pairs + 1])
    flat, sizes, numbers = map(np.concatenate, (done_ids, done_lengths, done_numbers))
    order = np.argsort(numbers)
    out[numbers] = sizes
    return flat[_ragged((np.cumsum(sizes) - sizes)[order], sizes[order])], out


def merge_all(model: Model, ids: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """The same as one array per sequence."""
    flat, sizes = merge_flat(model, ids, lengths)
    return np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []


def _halves(data: bytes) -> list[bytes]:
    """The leaves of a word, cut by halves."""
    if len(data) <= LEAF:
        return [data]
    middle = len(data) // 2
    return _halves(data[:middle]) + _halves(data[middle:])


def _spelled(model: Model, tokens: np.ndarray) -> np.ndarray:
    """The byte tokens that spell tokens."""
    return model.first[model.bytes[_ragged(model.starts[tokens], model.lengths[tokens])]]


def join_all(model: Model, pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """The encoding of each left and right text as one, from the encodings of both."""
    out: list[np.ndarray] = [a if len(a) else b for a, b in pairs]
    open_, size = [i for i, (a, b) in enumerate(pairs) if len(a) and len(b)], WINDOW
    while open_:
        windows = [_spelled(model, np.append(pairs[i][0][-size:], pairs[i][1][:size])) for i in open_]
        encoded = merge_all(model, np.concatenate(windows), np.array([len(w) for w in windows]))
        left_open = []
        for i, new in zip(open_, encoded, strict=True):
            a, b = pairs[i]
            left = size >= len(a) or new[0] == a[-size]
            right = size >= len(b) or new[-1] == b[size - 1]
            if left and right:
                out[i] = np.concatenate([a[:-size], new, b[size:]])
            else:
                left_open.append(i)
        open_, size = left_open, size * 2
    return out


def encode_words(model: Model, words: Sequence[bytes]) -> list[np.ndarray]:
    """The ids of each word; long ones by the tree of their halves."""
    leaves = [_halves(w) for w in words]
    flat = [leaf for tree in leaves for leaf in tree]
    ids = model.first[np.frombuffer(b"".join(flat), np.uint8)]
    encoded = iter(merge_all(model, ids, np.array([len(x) for x in flat], np.int64)))
    levels = [[next(encoded) for _ in tree] for tree in leaves]
    while long := [i for i, parts in enumerate(levels) if len(parts) > 1]:
        joined = iter(join_all(model, [
            pair for i in long for pair in zip(levels[i][::2], levels[i][1::2], strict=False)
        ]))
        for i in long:
            odd = levels[i][-1:] if len(levels[i]) % 2 else []
            levels[i] = [next(joined) for _ in range(len(levels[i]) // 2)] + odd
    return [parts[0] for parts in levels]


class Encoder:
    """Ids of words, remembered up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids = np.empty(0, np.int64)
        self.starts = self.lengths = np.empty(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        if len(self.slots) + len(words) > KNOWN or len(self.ids) > KNOWN_IDS:
            self._forget()
        special = self.model.special
        new = [w for w in words if w not in self.slots]
        texts = [b"" if w in special else w.encode() for w in new]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        short = [t if len(t) <= LEAF else b"" for t in texts]
        spelled = self.model.first[np.frombuffer(b"".join(short), np.uint8)]
        ids, lengths = merge_flat(self.model, spelled, np.where(sizes <= LEAF, sizes, 0))
        apart = [i for i, w in enumerate(new) if sizes[i] > LEAF or w in special]
        if apart:  # long words by the tree of their halves, and added tokens
            long = iter(encode_words(self.model, [texts[i] for i in apart if texts[i]]))
            parts = np.split(ids, np.cumsum(lengths)[:-1])
            for i in apart:
                parts[i] = next(long) if texts[i] else np.array([special[new[i]]])
                lengths[i] = len(parts[i])
            ids = np.concatenate(parts)
        self.slots.update(zip(new, range(len(self.slots), len(self.slots) + len(new)), strict=True))
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(lengths) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        self.ids = np.concatenate([self.ids, ids])

    def encoded(self, words: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Of each list of words all ids, one list after the other, and where each starts."""
        coded = words.flatten().dictionary_encode()
        unique = coded.dictionary.to_pylist()
        if any(w not in self.slots for w in unique):
            self._learn(unique)
        slot = np.fromiter((self.slots[w] for w in unique), np.int64, len(unique))
        slot = slot[coded.indices.to_numpy(zero_copy_only=False)]
        lengths = self.lengths[slot]
        ids = self.ids[_ragged(self.starts[slot], lengths)]
        ends = np.append(0, np.cumsum(lengths))
        edges = words.offsets.to_numpy()
        return ids, ends[edges - edges[0]]


def decoded(model: Model, ids: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The text of each run of ids between two edges; bytes that are no UTF-8 become U+FFFD."""
    lengths = model.lengths[ids]
    data = model.bytes[_ragged(model.starts[ids], lengths)]
    ends = np.append(0, np.cumsum(lengths))[edges]
    texts = pa.LargeStringArray.from_buffers(
        len(edges) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)
    )
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:
        raw = data.tobytes()
        parts = [raw[a:b].decode(errors="replace") for a, b in zip(ends, ends[1:], strict=False)]
        texts = pa.array(parts, pa.large_string())
    return texts.cast(pa.string())


def _odd_words(model: Model, texts: list[str]) -> pa.ListArray:
    """The words of texts that hold added tokens or characters newer than the JVM's tables."""
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    by = sorted(map(re.escape, model.special), key=len, reverse=True)
    cut = re.compile(f"({'|'.join(by)})" if by else r"(?!)").split
    return pa.array([
        [
            word for part in cut(text) if part
            for word in ([part] if part in model.special else [part[a:b] for _, (a, b) in split(part)])
        ] for text in texts
    ], pa.list_(pa.string()))


def all_words(model: Model, part: pa.RecordBatch) -> pa.ListArray:
    """The words of each row of split_words()."""
    words, odd = part.column("words"), part.column("odd")
    if odd.null_count == len(part):
        return words
    rows = np.flatnonzero(odd.is_valid().to_numpy(zero_copy_only=False))
    place = np.arange(len(part))
    place[rows] = len(part) + np.arange(len(rows))
    found = _odd_words(model, odd.take(pa.array(rows)).to_pylist())
    return pa.concat_arrays([words.cast(found.type), found]).take(pa.array(place))


def chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about CHUNK words each, one row at least."""
    edges, low = batch.column("words").offsets.to_numpy(), 0
    while low < len(batch):
        high = int(np.searchsorted(edges, edges[low] + CHUNK, "right")) - 1
        high = min(max(high, low + 1), len(batch))
        yield batch.slice(low, high - low)
        low = high


def _encoder(model: Model, keep: Sequence[str], back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        for batch in batches:
            for part in chunks(batch):
                ids, edges = encoder.encoded(all_words(model, part))
                lists = pa.ListArray.from_arrays(
                    pa.array(edges, pa.int32()), pa.array(ids.astype(np.int32))
                )
                columns = [part.column(c) for c in keep] + [lists]
                names = [*keep, "ids"]
                if back:
                    columns.append(decoded(model, ids, edges))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def read_model(tokenizer: str) -> Model:
    """The model of a tokenizer file. It is read where the plan is made and goes to the tasks."""
    with open(tokenizer, "rb") as file:
        return Model(file.read())


def split_words(model: Model, text: Column) -> list[Column]:
    """words of a text, and odd, the text itself if it must be split in the task."""
    special = "".join(f"|{re.escape(t)}" for t in model.special)
    value = whole(text)
    odd = value.rlike(r"\p{Cn}" + special)
    words = F.when(~odd, F.regexp_extract_all(value, F.lit(WORDS), F.lit(0)))
    empty = F.array().cast("array<string>")
    return [F.coalesce(words, empty).alias("words"), F.when(odd, value).alias("odd")]


def encode(
    docs: DataFrame, tokenizer: str, text: str = "text", keep: Sequence[str] = ("doc_id",),
    back: bool = False,
) -> DataFrame:
    """The columns ``keep`` of docs, ids (array<int>) of the whole text and, with ``back``, the
    text that they decode to (``decoded``). No column of ``keep`` may have those names, nor
    ``words`` or ``odd``.

    Added tokens in a text become their own ids. A null text is empty and an empty text has no
    ids; long texts and words are never cut off; a repeated row is encoded like any other, and
    an empty table gives no rows. Columns not in ``keep`` take no part."""
    model = read_model(tokenizer)
    rows = docs.select(*keep, *split_words(model, F.col(text)))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    schema = f"{kept}, ids array<int>" + (", decoded string" if back else "")
    return rows.mapInArrow(_encoder(model, keep, back), schema)


def _decoder(model: Model, ids: str, other: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids)
            texts = decoded(
                model, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                lists.offsets.to_numpy() - lists.offsets[0].as_py(),
            )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in other), texts], [*other, "decoded"]
            )

    return run


def decode(rows: DataFrame, tokenizer: str, ids: str = "ids") -> DataFrame:
    """The other columns of rows and the text (``decoded``) of its array of ids; null ids give
    an empty text. An id that the model lacks fails the job."""
    model = read_model(tokenizer)
    other = [c for c in rows.columns if c != ids]
    some = F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")).alias(ids)
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in other)
    return rows.select(*other, some).mapInArrow(
        _decoder(model, ids, other), f"{schema}, decoded string"
    )


def _sha256(value: Column) -> Column:
    return F.sha2(value, 256)


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rows = encode(docs, public_tokenizers.path("byte_bpe_50k.json"), back=True)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        _sha256(F.col("decoded")).alias("decoded_sha256"),
    )
