"""SentencePiece encoding by suffix-array matching, and decoding.

The words of a batch that are new to a worker are put in one text; a suffix array of it
gives the places of every piece by binary search. The places are edges from a start to an
end; sorted by end they are relaxed in order. The models here are byte-pair models, so an
edge extends a path if the model would not merge across the joint: of the edges that end
at a place exactly one does, and its piece is the last of the encoding up to there.
"""

from __future__ import annotations

import re
from heapq import heappop, heappush
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .arrow import give_back, text_of
from .common import table

SPACE = "▁"
#: Bytes of words and their ids that a worker remembers, about, in each of three tables, and
#: what an entry takes beside them; and places for joints.
REMEMBERED, ENTRY = 64 << 20, 180
JOINTS = 1 << 21
#: Letters up to which words are relaxed together, by their letters' places.
SHORT = 48
#: Characters of new words that are matched together; a word is never cut.
BLOCK = 160_000
NEVER = float("inf")
#: More than any code.
MOST = (1 << 31) - 1
#: Marks in place of a piece's id: the start of a word, a character without a piece.
START, OTHER = -2, -1
_RUNS = re.compile("▁+[^▁\n]*|[^▁\n]+|\n")


class Vocabulary:
    """The pieces of a model: id, text and rank (by score; the best is merged first)."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.plain = [
            not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
            for i in range(size)
        ]
        self.texts = [model.id_to_piece(i) for i in range(size)]
        self.byte_ids = {
            int(self.texts[i][3:5], 16): i for i in range(size) if model.is_byte(i)
        }
        self.ids = {t: i for i, t in enumerate(self.texts) if self.plain[i]}
        scores = [model.get_score(i) for i in range(size)]
        ranks = {s: r for r, s in enumerate(sorted(set(scores), reverse=True))}
        self.rank = [ranks[s] for s in scores]
        # how a piece comes about: its last symbol over time, and its first symbol
        self.ends: dict[int, list[int]] = {}
        self.starts: dict[int, list[int]] = {}
        for text, i in sorted(self.ids.items(), key=lambda x: len(x[0])):
            steps: list[tuple[str, str]] = []
            if self.merge(list(text), steps) != [text]:
                continue  # the model never makes it
            if not steps:
                self.ends[i] = self.starts[i] = [i]
            else:
                left, right = (self.ids[x] for x in steps[-1])
                self.ends[i] = [*self.ends[right], i]
                self.starts[i] = [*self.starts[left], i]
        #: characters that stand side by side in a piece
        self.pairs = {t[i:i + 2] for t in self.ids for i in range(len(t) - 1)}
        self.decoded = [
            text.replace(SPACE, " ").encode() if plain else b""
            for text, plain in zip(self.texts, self.plain, strict=True)
        ]
        for byte, i in self.byte_ids.items():
            self.decoded[i] = bytes([byte])

    def text(self, ids: np.ndarray) -> str:
        """The text that ids stand for, without the space that was put before it."""
        data = b"".join([self.decoded[i] for i in ids.tolist()])
        return data.removeprefix(b" ").decode(errors="replace")

    def merge(self, symbols: list[str], steps: list | None = None) -> list[str]:
        """The symbols after all merges: the best rank first, of equal ones the leftmost.
        Joints wait in a heap, so the time is near the symbols' number."""
        symbols = list(symbols)
        count = len(symbols)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        waiting: list[tuple] = []

        def offer(at: int) -> None:
            follows = after[at]
            if follows < count:
                joined = self.ids.get(symbols[at] + symbols[follows])
                if joined is not None:
                    heappush(waiting, (self.rank[joined], at, symbols[at], symbols[follows]))

        for at in range(count - 1):
            offer(at)
        while waiting:
            _, at, left, right = heappop(waiting)
            follows = after[at]
            if symbols[at] != left or follows >= count or symbols[follows] != right:
                continue  # one of them has gone on since
            if steps is not None:
                steps.append((left, right))
            symbols[at], symbols[follows] = left + right, ""
            after[at] = after[follows]
            if after[at] < count:
                before[after[at]] = at
            if before[at] >= 0:
                offer(before[at])
            offer(at)
        return [s for s in symbols if s]

    def joint_holds(self, left: int, right: int) -> bool:
        """Whether left and right stay two pieces. Over time the left piece's last symbol
        and the right piece's first grow; a merge across comes if it is better than what
        is next on both sides (of equal ranks the leftmost comes first)."""
        ends, starts, texts, rank = self.ends[left], self.starts[right], self.texts, self.rank
        i = j = 0
        while True:
            across = self.ids.get(texts[ends[i]] + texts[starts[j]])
            c = NEVER if across is None else rank[across]
            a = rank[ends[i + 1]] if i + 1 < len(ends) else NEVER
            b = rank[starts[j + 1]] if j + 1 < len(starts) else NEVER
            if a == b == c == NEVER:
                return True
            if a <= b and a <= c:
                i += 1
            elif c <= b:
                return False
            else:
                j += 1


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """The starts of all suffixes in the order of their first depth codes or more."""
    letters, rank = np.unique(codes, return_inverse=True)
    bits = max(1, int(len(letters)).bit_length())
    width = max(1, 62 // bits)  # so many codes fit a key; then widths double
    key = np.zeros(len(rank), np.int64)
    size = len(rank)
    for step in range(width):
        key <<= bits
        key[:max(0, size - step)] |= rank[step:] + 1
    while True:
        order = np.argsort(key)
        if width >= depth:
            return order
        ordered = key[order]
        rank[order] = np.concatenate([[0], (ordered[1:] != ordered[:-1]).cumsum()])
        key = rank * (len(rank) + 1)
        key[:max(0, size - width)] += rank[width:] + 1
        width *= 2


def occurrences(codes: np.ndarray, order: np.ndarray, queries: np.ndarray,
                lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each query (a row of codes, padded) the range of order whose suffixes begin
    with it, by binary search."""
    reach = np.arange(queries.shape[1])
    inside = reach < lengths[:, None]
    padded = np.concatenate([codes, np.zeros(queries.shape[1], codes.dtype)])

    width = 4 * queries.shape[1]

    def spelled(rows: np.ndarray) -> np.ndarray:
        """Rows of codes as texts that sort like them."""
        return np.ascontiguousarray(rows, ">u4").view(f"S{width}").ravel()

    sorted_ = spelled(sliding_window_view(padded, queries.shape[1])[order])
    low = np.searchsorted(sorted_, spelled(np.where(inside, queries, 0)), "left")
    high = np.searchsorted(sorted_, spelled(np.where(inside, queries, MOST)), "right")
    return low, high


class Table(dict):
    """What a worker remembers of words; emptied down to the words of the last batch."""

    size = 0

    def learn(self, words: list[str], ids: list[bytes]) -> None:
        self.update(zip(words, ids, strict=True))
        self.size += sum(map(len, words)) + sum(map(len, ids)) + ENTRY * len(words)

    def bounded(self, last: set[str]) -> Table:
        if self.size <= REMEMBERED:
            return self
        kept = Table()
        words = [w for w in last if w in self]
        kept.learn(words, [self[w] for w in words])
        return kept if kept.size <= REMEMBERED else Table()


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.words = vocabulary
        own = list(vocabulary.ends)
        self.ids = np.array(own)
        self.lengths = np.array([len(vocabulary.texts[i]) for i in own])
        self.depth = int(self.lengths.max())
        self.queries = np.zeros((len(own), self.depth), np.int32)
        for row, i in enumerate(own):
            self.queries[row, :self.lengths[row]] = _codes(vocabulary.texts[i])
        in_order = np.lexsort(self.queries.T[::-1])  # needles in order are found faster
        self.ids, self.lengths = self.ids[in_order], self.lengths[in_order]
        self.queries = self.queries[in_order]
        self.after = Table()  # by word that a space stands before
        self.first = Table()  # by word at the start of a line
        self.stems = Table()  # by part of a word that no piece reaches beyond
        self.last: tuple[set[str], set[str]] = (set(), set())
        self.joints = np.full(JOINTS, -1)  # by a hash of two pieces: the pieces, and
        self.holds = np.zeros(JOINTS, bool)  # whether they stay two

    def _stem(self, word: str) -> str:
        stem = word.rstrip(".,")
        if 0 < len(stem) < len(word) and (stem[-1] + word[len(stem)]) not in self.words.pairs:
            return stem
        return word

    def learn(self, words: list[str]) -> list[bytes]:
        """The ids of words."""
        stems = [self._stem(w) for w in words]
        rests = [w[len(s):] for w, s in zip(words, stems, strict=True)]
        new = list({x for x in (*stems, *rests) if x and x not in self.stems})
        for word in new:  # pieces of spaces only share one rank, so their joints depend on place
            if SPACE * 2 in word:
                self.stems.learn([word], [self._bytes(word)])
        block, size = [], 0
        for word in new:
            if SPACE * 2 not in word:
                block.append(word)
                size += len(word)
            if size >= BLOCK:
                self._matched(block)
                block, size = [], 0
        self._matched(block)
        known = self.stems
        return [known[s] + (known[r] if r else b"") if s else b""
                for s, r in zip(stems, rests, strict=True)]

    def _matched(self, new: list[str]) -> None:
        if not new:
            return
        codes = _codes("\0".join(new))
        sizes = np.array([len(w) for w in new])
        stops = np.cumsum(sizes + 1) - 1
        codes[stops[:-1]] = 0  # below all codes of text, so no piece reaches across
        order = suffix_array(codes, self.depth)
        low, high = occurrences(codes, order, self.queries, self.lengths)
        count = high - low
        first = np.repeat(low - np.concatenate([[0], count.cumsum()[:-1]]), count)
        start = order[first + np.arange(int(count.sum()))]
        piece, length = np.repeat(self.ids, count), np.repeat(self.lengths, count)
        single = np.zeros(len(codes), bool)
        single[start[length == 1]] = True
        single[stops[:-1]] = True
        other = np.flatnonzero(~single)  # characters without a piece
        start = np.concatenate([start, other])
        piece = np.concatenate([piece, np.full(len(other), OTHER)])
        end = start + np.concatenate([length, np.ones(len(other), np.int64)])
        begin = stops - sizes
        letter = np.minimum(end - begin[np.searchsorted(begin, start, "right") - 1], SHORT + 1)
        by_end = np.argsort((letter * (len(codes) + 2) + end) * (self.depth + 1) - (end - start))
        last = self._relaxed(
            start[by_end], end[by_end], piece[by_end], letter[by_end], begin, len(codes) + 1
        )
        # all paths back at once: a place on a path is the end of one of its pieces
        sized = np.ones(len(self.words.texts) + 1, np.int64)
        sized[self.ids] = self.lengths
        on_path, at, begin = np.zeros(len(last), bool), stops.copy(), stops - sizes
        while len(at):
            on_path[at] = True
            at = at - sized[last[at]]
            left = at > begin
            at, begin = at[left], begin[left]
        places = np.flatnonzero(on_path)
        ids = last[places]
        unknown = np.flatnonzero(ids == OTHER)
        if len(unknown):
            spelled = [chr(c - 1).encode() for c in codes[places[unknown] - 1].tolist()]
            repeat = np.ones(len(ids), np.int64)
            repeat[unknown] = [len(x) for x in spelled]
            places, ids = np.repeat(places, repeat), np.repeat(ids, repeat)
            ids[ids == OTHER] = [self.words.byte_ids[b] for x in spelled for b in x]
        data = ids.astype(np.int32).tobytes()
        cuts = [0, *(4 * np.searchsorted(places, stops, "right")).tolist()]
        self.stems.learn(new, [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])

    def _relaxed(self, starts, ends, pieces, letter, begins, size) -> np.ndarray:
        """The last piece of the encoding up to each place. Edges are sorted by the letter of
        their words at which they end, then by end, long ones first; those of one letter are
        relaxed together, and of the edges to one place the first that holds counts."""
        nothing = START - 1
        last = np.full(size, nothing)
        last[begins] = START
        cuts = np.searchsorted(letter, np.arange(1, SHORT + 3))
        for low, high in zip(cuts[:-2], cuts[1:-1], strict=True):
            group = np.arange(low, high)
            before = last[starts[group]]
            group, before = group[before != nothing], before[before != nothing]
            piece = pieces[group]
            held = np.ones(len(group), bool)
            joint = (before >= 0) & (piece >= 0)
            held[joint] = self._hold(before[joint], piece[joint])
            group = group[held]
            first = np.append(True, np.diff(ends[group]) != 0)[:len(group)]
            last[ends[group[first]]] = pieces[group[first]]
        for row in range(cuts[-2], cuts[-1]):
            before, end, piece = last[starts[row]], ends[row], pieces[row]
            if before != nothing and last[end] == nothing and (
                before < 0 or piece < 0 or self.words.joint_holds(int(before), int(piece))
            ):
                last[end] = piece
        return last

    def _hold(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each two pieces stay two, remembered in a table of one place per hash."""
        base = len(self.words.texts)
        keys = left.astype(np.int64) * base + right
        at = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64)
        at &= JOINTS - 1
        out, missing = self.holds[at], np.flatnonzero(self.joints[at] != keys)
        if len(missing):
            unique, back = np.unique(keys[missing], return_inverse=True)
            holds = self.words.joint_holds
            found = np.array([holds(*divmod(k, base)) for k in unique.tolist()], bool)
            out[missing] = found[back]
            self.joints[at[missing]], self.holds[at[missing]] = keys[missing], out[missing]
        return out

    def _bytes(self, word: str) -> bytes:
        """The ids of a word by merging its symbols one by one."""
        ids = []
        for symbol in self.words.merge(list(word)):
            known = self.words.ids.get(symbol)
            ids += [self.words.byte_ids[b] for b in symbol.encode()] if known is None else [known]
        return np.array(ids, np.int32).tobytes()

    def encoded(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of 32-bit numbers."""
        self.after, self.first = self.after.bounded(self.last[0]), self.first.bounded(self.last[1])
        self.stems = self.stems.bounded(set())
        cut, later, begin, odd = [], set(), set(), []
        for at, text in enumerate(texts):
            if "  " in text or SPACE in text or text[:1] == " ":
                odd.append(at)
                cut.append(_RUNS.findall(SPACE + text.replace(" ", SPACE)))
                continue
            lines = [line.split(" ") for line in text.split("\n")] if text else []
            for number, line in enumerate(lines):
                later.update(line[1:] if number else line)
                if number:
                    begin.add(line[0])
            cut.append(lines)
        new = list(later.difference(self.after))
        self.after.learn(new, self.learn([SPACE + w for w in new]))
        new = list(begin.difference(self.first))
        self.first.learn(new, self.learn(new))
        self.last = (later, begin)
        odd_words = list({w for at in odd for w in cut[at]})
        odd_ids = dict(zip(odd_words, self.learn(odd_words), strict=True))
        line_break = self._bytes("\n")
        out, unusual = [], set(odd)
        for at, lines in enumerate(cut):
            if at in unusual:
                ids = map(odd_ids.__getitem__, lines)
            else:
                ids = list(map(self.after.__getitem__, lines[0])) if lines else []
                for line in lines[1:]:
                    ids += (line_break, self.first[line[0]])
                    ids += map(self.after.__getitem__, line[1:])
            out.append(b"".join(ids))
        return out


def _codes(text: str) -> np.ndarray:
    """Code points, one up, so that 0 is free."""
    return np.frombuffer(text.encode("utf-32-le"), np.int32) + 1


def _encode(shared, back: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for whole in batches:
            for low in range(0, len(whole), 1024):
                batch = whole.slice(low, 1024)
                ids = encoder.encoded([x or "" for x in text_of(batch).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])])
                values = np.frombuffer(b"".join(ids), np.int32)
                columns = {"doc": batch.column("doc"), "ids": pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(values, pa.int32())
                )}
                if back:
                    columns["decoded"] = pa.array(
                        [shared.value.text(np.frombuffer(x, np.int32)) for x in ids], pa.string()
                    )
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
        del encoder  # idle workers stay beside the next stage's
        give_back()

    return run


def encode(docs: DataFrame, vocabulary: Vocabulary, *keep: str, back: bool = False) -> DataFrame:
    """Per row of docs: doc (a struct of the columns to keep) and ids, as the model's own
    library gives them; with back also decoded, the text that the ids stand for. A null
    text is empty and has no ids, an empty table gives no rows, repeated rows are encoded
    alike. Time and memory are near a text's length. Only text and the columns to keep are
    read, whatever the names of others; a text to keep goes to the tasks once."""
    doc = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc")
    packed = docs.select(doc, *([] if "text" in keep else ["text"]))
    fields = [packed.schema["doc"], T.StructField("ids", T.ArrayType(T.IntegerType()))]
    if back:
        fields.append(T.StructField("decoded", T.StringType()))
    # the vocabulary has a fixed size
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return packed.mapInArrow(_encode(shared, back), T.StructType(fields))


def _decode(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [shared.value.text(x.values.to_numpy()) if x.is_valid else ""
                     for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"]
            )

    return run


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Adds decoded, the text of ids; null ids are empty. A text comes back as it was, but
    for the model's own space mark, which becomes a space."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    return encoded.mapInArrow(_decode(shared), schema)


def default_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    words = default_vocabulary()
    return encode(docs, words, "doc_id", "text", back=True).select(
        "doc.doc_id", "ids", F.size("ids").cast("long").alias("n_ids"),
        (F.col("decoded") == F.coalesce("doc.text", F.lit(""))).alias("round_trip"),
    )
