"""SimHash near-duplicates by an inverted index over positional bytes.

Fingerprints that differ in 3 bits at most agree in 5 of their 8 bytes at least, so in 4
of the first 7. A posting is keyed by four such positional bytes, which keeps posting
lists short; the tally of shared bytes must reach 5, then the bits are compared. Keys
that many fingerprints share are posted again with parts of the remaining bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .arrow import extended, raw, text_of
from .common import checkpointed, stored, table
from .graph import components

BITS = 3
SHINGLE = 3
#: A posting list that is longer is split by the bytes left.
LONG_LIST = 500
#: Keys of several postings are broadcast up to this many; beyond, they are shuffled.
BROADCAST_KEYS = 500_000

_BYTES = list(combinations(range(7), 4))


def fingerprint(text: bytes) -> int:
    """The 64-bit fingerprint of a UTF-8 text, as a signed number."""
    parts = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    if len(parts) < SHINGLE:
        shingles = [b" ".join(parts)]
    else:
        shingles = map(b" ".join, zip(*(parts[i:] for i in range(SHINGLE)), strict=False))
    counts, seen = np.zeros(64, np.int64), 0
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles), np.uint64)
    for start in range(0, len(hashes), 65536):
        part = hashes[start:start + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
        seen += len(part)
    return int(np.packbits(counts * 2 > seen).view(">i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(x) for x in raw(text_of(batch).cast(pa.binary()))]
        yield extended(batch, "text", print=pa.array(prints, pa.int64()))


def fingerprints(docs: DataFrame, *keep: str) -> DataFrame:
    """row, doc (a struct of the columns to keep) and print (long) of every row of docs,
    stored. A text to keep goes to the tasks once."""
    doc = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("doc")
    packed = docs.select(doc, *([] if "text" in keep else ["text"]))
    packed = packed.select(F.monotonically_increasing_id().alias("row"), *packed.columns)
    schema = T.StructType([
        T.StructField("row", T.LongType()), packed.schema["doc"], T.StructField("print", T.LongType()),
    ])
    return stored(packed.mapInArrow(_fingerprints, schema), "simhash")


def _part(value: str, position: int, bits: int) -> str:
    return f"(shiftrightunsigned({value}, {bits * position}) & {(1 << bits) - 1})"


def _key(number: int, parts: list[str], bits: int) -> str:
    """SQL of a long of the number, then the parts."""
    terms = [f"shiftleft({part}, {bits * i})" for i, part in enumerate(reversed(parts))]
    return " | ".join([f"shiftleft({number}L, {bits * len(parts)})", *terms])


def _first(mask: int) -> int:
    """The number of the first four of seven positions that a mask has, or -1."""
    own = [i for i in range(7) if mask >> i & 1]
    return _BYTES.index(tuple(own[:4])) if len(own) >= 4 else -1


_FIRST = [_first(mask) for mask in range(128)]


def links(prints: DataFrame) -> DataFrame:
    """(a, b), a < b, for all distinct fingerprints of column print that differ in 3 bits
    or fewer; each pair once."""
    keys = ", ".join(
        _key(n, [_part("print", i, 8) for i in at], 8) for n, at in enumerate(_BYTES)
    )
    postings = prints.select("print", F.expr(f"posexplode(array({keys}))").alias("n", "key"))
    # most keys have one posting; only the others go on
    sizes = checkpointed(
        postings.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > 1)
    )
    if sizes.count() <= BROADCAST_KEYS:
        sizes = F.broadcast(sizes)
    postings = postings.join(sizes, "key")
    a, b = F.col("x.print"), F.col("y.print")
    mask = " | ".join(
        f"if({_part('x.print', i, 8)} = {_part('y.print', i, 8)}, {1 << i}, 0)" for i in range(8)
    )
    near = F.expr(f"""
        x.print < y.print AND bit_count(x.print ^ y.print) <= {BITS}
        AND bit_count({mask}) >= {8 - BITS}
        AND get(array({", ".join(map(str, _FIRST))}), ({mask}) & 127) = x.n
    """)  # the last: each pair under one key only
    short = postings.filter(F.col("size") <= LONG_LIST)
    pairs = short.alias("x").join(short.alias("y"), (F.col("x.key") == F.col("y.key")) & near)
    pairs = pairs.select(a.alias("a"), b.alias("b"))
    if sizes.filter(F.col("size") > LONG_LIST).isEmpty():
        return pairs
    # the four bytes left are eight nibbles, of which five agree, so four of the first seven
    many = postings.filter(F.col("size") > LONG_LIST)

    def again(at: tuple) -> str:
        left = [2 * i + half for i in range(8) if i not in at for half in (0, 1)]
        return ", ".join(
            _key(m, [_part("print", left[i], 4) for i in some], 4)
            for m, some in enumerate(_BYTES)
        )

    cases = " ".join(f"WHEN {n} THEN array({again(at)})" for n, at in enumerate(_BYTES))
    fine = many.select(
        "print", "n", "key", F.expr(f"posexplode(CASE n {cases} END)").alias("m", "part")
    )
    same = (F.col("x.key") == F.col("y.key")) & (F.col("x.part") == F.col("y.part"))
    # a pair may meet under several parts: once is enough
    dense = fine.alias("x").join(fine.alias("y"), same & near).select(
        a.alias("a"), b.alias("b")
    ).distinct()
    return pairs.union(dense)


def grouped(seen: DataFrame) -> DataFrame:
    """(print, root, component_id) for the prints of seen (doc, print); root tells the
    components apart, component_id is the smallest doc_id that links reach."""
    nodes = checkpointed(seen.groupBy("print").agg(F.min("doc.doc_id").alias("least")))
    roots = components(links(nodes.select("print")))
    known = nodes.join(roots, nodes["print"] == roots["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    return known.join(least, "root").select("print", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of docs.

    A text that is null or without words has fingerprint zero and is linked like any
    other. Repeated rows are in one component. A null doc_id takes part, but is a
    component's id only if the component has no other."""
    seen = fingerprints(docs, "doc_id")
    return seen.join(grouped(seen), "print").select(
        "doc.doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of docs of each component, that of the smallest doc_id (null last); of
    repeated rows one. All columns are kept as they are."""
    seen = fingerprints(docs, *docs.columns)
    narrow = seen.select("row", F.col("doc.doc_id").alias("doc_id"), "print")
    # by the root: components may share a doc_id, or have none
    best = narrow.join(grouped(seen), "print").groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row")
    )).alias("best"))
    return seen.join(best.select(F.col("best.row").alias("row")), "row", "left_semi").select(
        *[F.col("doc")[c].alias(c) for c in docs.columns]
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
