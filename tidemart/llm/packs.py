"""Documents in packs: several MB of rows as one compressed value, so that work on them can be addressed by number.

A pack is written once to shared scratch; afterwards a document has a fixed address (pack, place in the pack), whatever
happens to executors, and sending packs to the rows that answer them moves compressed bytes only.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemart.llm.text import in_small_batches
from tidemart.sources.scratch import materialise

#: Bytes of text in a pack.
PACK = 8 << 20


def _body(rows: pa.Table) -> bytes:
    batch = rows.combine_chunks().to_batches()[0]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return zstandard.ZstdCompressor(level=3).compress(sink.getvalue())


def _packer(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        waiting: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            lengths = pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64)
            cuts = np.flatnonzero(np.diff((held + np.cumsum(lengths)) // size, prepend=held // size)).tolist()
            for low, high in zip([0, *cuts], [*cuts, len(batch)]):
                if low > 0 or (cuts and cuts[0] == 0):  # a multiple of the size lies before `low`
                    if waiting:
                        yield pa.RecordBatch.from_pydict({"pack": [number], "body": [_body(pa.Table.from_batches(waiting))]})
                        number += 1
                    waiting = []
                if low < high:
                    part = [c.take(pa.array(range(low, high))) for c in batch.columns]
                    waiting.append(pa.RecordBatch.from_arrays(part, batch.schema.names))
            held += int(lengths.sum())
        if waiting:
            yield pa.RecordBatch.from_pydict({"pack": [number], "body": [_body(pa.Table.from_batches(waiting))]})

    return run


def packed(rows: DataFrame, size: int = PACK) -> DataFrame:
    """`rows`, whose column `text` has no NULL, as packs of about `size` bytes of text: `pack`, `body`."""
    return materialise(in_small_batches(rows).mapInArrow(_packer(size), "pack long, body binary"), "packs")


def unpacked(body: bytes) -> pa.RecordBatch:
    """The rows of one pack."""
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(body)).read_next_batch()


def texts(rows: pa.RecordBatch) -> list[bytes]:
    """The texts of a pack in UTF-8."""
    return [v if isinstance(v, bytes) else v.encode("utf-8", "surrogatepass") for v in rows["text"].to_pylist()]
