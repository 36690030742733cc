"""Benchmark decontamination with a generalised suffix automaton.

Automata of the items' words are built by tasks from groups of bounded size and sent to
the tasks that stream every text through them and track the longest match ending at each
word. A word is hit if it lies in a match of LENGTH words, or in a whole shorter item.
"""

from __future__ import annotations

import pickle
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .arrow import PLAIN, raw, tokens
from .common import stored, table

#: Words of a match that counts.
LENGTH = 10
#: A text of which this share of the words is hit is removed as a whole.
COVERAGE = 0.5
#: Item bytes in one automaton; more items make more passes over the texts.
BLOCK_BYTES = 2_000_000


class Automaton:
    """All word sequences of some items.

    State 0 is the root. A state stands for sequences that end at the same places of
    the items; size is its longest one's length, link the state of its longest suffix
    that ends at more places. All transitions are in one dict, by state * width + the
    word's number."""

    def __init__(self, items: list[tuple[str, list[bytes]]], length: int = LENGTH):
        self.length = length
        self.names = [name for name, _ in items]
        self.numbers: dict[bytes, int] = {}
        for _, item in items:
            for word in item:
                self.numbers.setdefault(word, len(self.numbers))
        self.width = len(self.numbers)
        self.next: dict[int, int] = {}
        self.link, self.size = array("i", [-1]), array("i", [0])
        leaving: list[list[int]] = [[]]  # the words that leave a state
        for _, item in items:
            last = 0
            for word in item:
                last = self._extend(last, self.numbers[word], leaving)
        del leaving
        self.window = self._windows()
        self.owner = array("i", [-1]) * len(self.size)  # of a window's state: one of its items
        self.others: dict[int, set[int]] = {}  # and the items beside it
        self.short: dict[int, list[tuple[int, int]]] = {}  # whole items that are shorter
        for number, (_, item) in enumerate(items):
            state = 0
            for at, word in enumerate(item, 1):
                state = self.window[self.next[state * self.width + self.numbers[word]]]
                if at >= length:
                    if self.owner[state] < 0:
                        self.owner[state] = number
                    elif self.owner[state] != number:
                        self.others.setdefault(state, set()).add(number)
            if 0 < len(item) < length:
                self.short.setdefault(state, []).append((len(item), number))
        self.ending = self._endings()

    def _by_size(self):
        return sorted(range(1, len(self.size)), key=self.size.__getitem__)

    def _windows(self) -> array:
        """Per state the state of the last length words of its sequences."""
        window = array("i", range(len(self.size)))
        for state in self._by_size():
            if self.size[self.link[state]] >= self.length:
                window[state] = window[self.link[state]]
        return window

    def _endings(self) -> array:
        """Per state the longest of its suffixes' states, itself included, that has a whole
        shorter item; 0 if none has."""
        ending = array("i", [0]) * len(self.size)
        if self.short:
            for state in self._by_size():
                ending[state] = state if state in self.short else ending[self.link[state]]
        return ending

    def _new(self, size: int, link: int, leaving: list[list[int]]) -> int:
        leaving.append([])
        self.size.append(size)
        self.link.append(link)
        return len(self.size) - 1

    def _split(self, state: int, word: int, target: int, leaving: list[list[int]]) -> int:
        """A copy of target for sequences as long as one word more than state's."""
        follow, width = self.next, self.width
        copy = self._new(self.size[state] + 1, self.link[target], leaving)
        leaving[copy] = list(leaving[target])
        for x in leaving[copy]:
            follow[copy * width + x] = follow[target * width + x]
        self.link[target] = copy
        while state >= 0 and follow.get(state * width + word) == target:
            follow[state * width + word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int, leaving: list[list[int]]) -> int:
        follow, width = self.next, self.width
        known = follow.get(last * width + word)
        if known is not None:  # of another item
            tight = self.size[known] == self.size[last] + 1
            return known if tight else self._split(last, word, known, leaving)
        added = self._new(self.size[last] + 1, 0, leaving)
        state = last
        while state >= 0 and state * width + word not in follow:
            follow[state * width + word] = added
            leaving[state].append(word)
            state = self.link[state]
        if state >= 0:
            target = follow[state * width + word]
            tight = self.size[target] == self.size[state] + 1
            self.link[added] = target if tight else self._split(state, word, target, leaving)
        return added

    def hits(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """The spans (start, end) of hit words, merged, and the items they belong to."""
        follow, width, link, size, length = self.next, self.width, self.link, self.size, self.length
        window, ending, short = self.window, self.ending, self.short
        number_of = self.numbers.get
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        windows: set[int] = set()
        state = matched = 0

        def hit(start: int, end: int) -> None:
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append((start, end))

        for at, word in enumerate(text, 1):
            number = number_of(word)
            if number is None:
                state = matched = 0
                continue
            to = follow.get(state * width + number)
            while to is None:  # every known word leaves the root
                state = link[state]
                matched = size[state]
                to = follow.get(state * width + number)
            state = to
            matched += 1
            if matched >= length:
                windows.add(window[state])
                hit(at - length, at)
            if short:
                end = ending[state]
                while end > 0:
                    for words, item in short[end]:
                        if words <= matched:
                            items.add(item)
                            hit(at - words, at)
                    end = ending[link[end]]
        for found in windows:
            items.add(self.owner[found])
            items |= self.others.get(found, set())
        return spans, {self.names[i] for i in items}


def _without(body: bytes, spans: list[list[int]]) -> str:
    """The text without the spans' words and what separates them inside."""
    if spans:
        plain, at, edges = body.translate(PLAIN), 0, []
        for word in plain.split():
            at = plain.index(word, at)
            edges.append((at, at + len(word)))
            at += len(word)
        kept, at = [], 0
        for start, end in spans:
            kept.append(body[at:edges[start][0]])
            at = edges[end - 1][1]
        body = b"".join([*kept, body[at:]])
    return body.decode()


def _matcher(automaton, last: bool, cut: bool = False):
    """Adds the hits of one automaton to those of earlier ones. After the last one the
    words are counted and the text may be cut, in the same pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = automaton.value
        for batch in batches:
            spans, items, words, rest = [], [], [], []
            bodies = batch.column("body")
            before_s, before_i = (batch.column(c).to_pylist() for c in ("spans", "items"))
            for body, old_s, old_i in zip(raw(bodies), before_s, before_i, strict=True):
                text = tokens(body)
                found, names = own.hits(text)
                pairs = sorted([*((s["start"], s["end"]) for s in old_s), *found])
                merged: list[list[int]] = []
                for start, end in pairs:
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(end, merged[-1][1])
                    else:
                        merged.append([start, end])
                spans.append([{"start": s, "end": e} for s, e in merged])
                items.append(sorted({*old_i, *names}))
                if last:
                    words.append(len(text))
                if cut:
                    rest.append(_without(body, merged))
            out = {n: batch.column(n) for n in batch.schema.names}
            out |= {
                "spans": pa.array(spans, batch.schema.field("spans").type),
                "items": pa.array(items, batch.schema.field("items").type),
            }
            if last:
                del out["body"]
                out["n_words"] = pa.array(words, pa.int64())
            if cut:
                empty = bodies.is_null().to_numpy(zero_copy_only=False)
                out["rest"] = pa.array(rest, pa.string(), mask=empty)
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))

    return run


def _built(limit: int):
    """Automata of the items of one group, each of limit bytes at most, or of one item."""

    def build(group: pa.Table) -> pa.Table:
        automata: list[bytes] = []
        held, size = [], 0
        for name, body in zip(group.column("item").to_pylist(), raw(group.column("body")), strict=True):
            if held and size + len(body) > limit:
                automata.append(pickle.dumps(Automaton(held)))
                held, size = [], 0
            held.append((name, tokens(body)))
            size += len(body)
        automata.append(pickle.dumps(Automaton(held)))
        return pa.table({
            "part": pa.array([group.column("part")[0].as_py()] * len(automata), pa.int64()),
            "number": pa.array(range(len(automata)), pa.int32()),
            "automaton": pa.array(automata, pa.binary()),
        })

    return build


def automata(benchmark: DataFrame, limit: int) -> Iterator[Automaton]:
    """The automata of the items, one at a time. Rows that repeat an item are left out, as
    are items without text.

    Items of limit bytes in all come to the driver and make one automaton. More are dealt by
    hash to groups of half of that, whose automata are built and stored by tasks; the driver
    only hands them on."""
    texts = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        F.col("text").cast("binary").alias("body"),
    ).filter(F.octet_length("body") > 0)
    total = texts.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    if total <= limit:
        yield Automaton([(r.item, tokens(bytes(r.body))) for r in texts.collect()])
        return
    parts = 2 * -(-total // limit)
    built = stored(
        texts.distinct().withColumn("part", F.pmod(F.xxhash64("item", "body"), F.lit(parts)))
        .groupBy("part").applyInArrow(_built(limit), "part long, number int, automaton binary"),
        "automata",
    )
    for part, number in sorted(built.select("part", "number").collect()):
        row = built.filter((F.col("part") == part) & (F.col("number") == number)).first()
        yield pickle.loads(bytes(row.automaton))


def match(docs: DataFrame, benchmark: DataFrame, *keep: str,
          block_bytes: int = BLOCK_BYTES, cut: bool = False) -> DataFrame:
    """Per row of docs: doc (a struct of the columns to keep), n_words, spans (start and
    end word of hits, merged), items (ids as text, sorted) and, with cut, rest, the text
    without the spans.

    A null text has no words, and a null rest. An empty benchmark, or one without words, hits
    nothing. Repeated rows are matched alike. Items are told apart by id; null ids count as
    'null', and repeated items as one. No other column is read, so those to keep may have
    any name."""
    context = docs.sparkSession.sparkContext
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    state = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc"),
        F.col("text").cast("binary").alias("body"),
        F.array().cast(T.ArrayType(span)).alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    full = state.schema
    short = T.StructType([
        *(f for f in full if f.name != "body"), T.StructField("n_words", T.LongType()),
        *([T.StructField("rest", T.StringType())] if cut else []),
    ])
    waiting = None
    for own in automata(benchmark, block_bytes):
        if waiting is not None:  # not the last: written, so that workers hold one automaton
            state = stored(state.mapInArrow(_matcher(waiting, False), full), "hits")
        waiting = context.broadcast(own)
    return state.mapInArrow(_matcher(waiting, True, cut), short)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the hit spans; texts of which COVERAGE of the words is hit go as a
    whole. n_chars, where docs has it, is that of the new text. Null texts stay null,
    other texts and columns are as they were; repeated rows are treated alike."""
    seen = match(docs, benchmark, *[c for c in docs.columns if c != "text"], cut=True)
    left = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    seen = seen.filter((F.size("spans") == 0) | (left < COVERAGE * F.col("n_words")))
    changed = {"text": F.col("rest"), "n_chars": F.char_length("rest").cast("long")}
    return seen.select(*[
        changed[c].alias(c) if c in changed else F.col("doc")[c].alias(c) for c in docs.columns
    ])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    hit = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return match(docs, items, "doc_id").select(
        "doc.doc_id", "n_words", hit.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT item, least(len(ws), {LENGTH}) AS n, unnest(list_transform(
          range(1, greatest(len(ws) - {LENGTH}, 0) + 2),
          lambda i: array_to_string(ws[i:i + {LENGTH} - 1], ' '))) AS w
        FROM b WHERE len(ws) > 0),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
       FROM (SELECT rid, n, ws, unnest(range(1, len(ws) - n + 2)) AS i
             FROM d CROSS JOIN lens WHERE len(ws) >= n)),
h AS (SELECT DISTINCT rid, dw.n, i, item FROM dw JOIN win ON dw.w = win.w AND dw.n = win.n),
hw AS (SELECT rid, count(DISTINCT pos) AS n_hit
       FROM (SELECT rid, unnest(range(i, i + n)) AS pos FROM h) GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)
"""
