"""Small helpers for functions over Arrow batches."""

from __future__ import annotations

import ctypes
import string

import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of a lowered word as they are, A-Z lowered, all others a space.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c) in string.ascii_lowercase + string.digits
    else 32 for c in range(256)
)


def tokens(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: letters, digits and all that is not ASCII; A-Z lowered."""
    return text.translate(PLAIN).split()


def raw(column: pa.Array) -> list[bytes]:
    """The bytes of a binary column, null as empty."""
    return [x or b"" for x in column.to_pylist()]


def extended(batch: pa.RecordBatch, drop: str, **more: pa.Array) -> pa.RecordBatch:
    """The batch without a column and with others at its end."""
    names = [name for name in batch.schema.names if name != drop]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(name) for name in names), *more.values()], [*names, *more]
    )


def text_of(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch: a column of their own or, where kept, a field of doc."""
    if "text" in batch.schema.names:
        return batch.column("text")
    return pc.struct_field(batch.column("doc"), "text")


def give_back() -> None:
    """Returns freed memory of this process to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
