"""Fixed-length training sequences.

Method: first-fit decreasing with a tournament tree of bin capacities, run independently in randomised
groups of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.arrow_text import chunks, release, releasing
from sparkmart.llm.token_ids import token_ids

GROUP_BYTES = 8 << 20
_BINS = 32  # bits of a sequence id that number the bins of a group


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item. Items go by falling length (ties: as given) to the first bin with room.

    The leaves of the tree hold the room left in each bin, an inner node the larger of its two
    children, so the first bin with enough room is found by one descent.
    """
    n = len(lengths)
    leaves = 1
    while leaves < n:
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    place = np.zeros(n, np.int64)
    for item in np.argsort(-lengths, kind="stable").tolist():
        size, node = int(lengths[item]), 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        place[item] = node - leaves
        tree[node] -= size
        while node > 1:
            node //= 2
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
    return place


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    spaces_matter: bool = False,
) -> DataFrame:
    """Ids of whole texts cut into pieces of at most ``capacity``: doc_id, start, length, doc_tokens, ids.

    Only texts longer than ``capacity`` are cut: into full pieces and a rest.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_ids(tokenizer, spaces_matter)
        for batch in batches:
            for rows, texts in chunks(batch, "text", 2 << 20):
                flat, offsets = encoder.encode(texts, end_id)
                tokens = np.diff(offsets)
                count = -(-tokens // capacity)
                of = np.repeat(np.arange(len(tokens)), count)
                start = (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)) * capacity
                length = np.minimum(capacity, tokens[of] - start)
                ends = np.concatenate(([0], np.cumsum(length)))  # pieces follow each other as the ids do
                ids = pa.Array.from_buffers(
                    pa.binary(), len(of), [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(flat.astype("<u4"))]
                )
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(of)), pa.array(start), pa.array(length), pa.array(tokens[of]), ids],
                    names=["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(releasing(cut), "doc_id long, start long, length long, doc_tokens long, ids binary")


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 2,
    group_bytes: int = GROUP_BYTES,
    seed: int = 7,
    doc_id: str = "doc_id",
    text: str = "text",
    spaces_matter: bool = False,
) -> DataFrame:
    """Pack whole texts, each followed by ``end_id``, into sequences of at most ``capacity`` ids.

    Returns one row per piece: doc_id, start, length, doc_tokens, ids (little-endian 32 bit),
    sequence_id, offset. Pieces are dealt by a hash of id, start and content to groups of about ``group_bytes`` of
    text; a hot document is many pieces and so many groups. A group is packed by one task.
    NULL text counts as empty (the end id alone); NULL ids are kept; repeated rows are packed as often as
    they occur; other columns are ignored; an empty table gives no rows. Ties between equal lengths are
    broken by id, start and content, so a repeated run gives the same sequences.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(text)) + F.lit(1)).alias("n")).first()["n"] or 0
    groups = max(1, -(-size // group_bytes))

    def packed(table: pa.Table) -> pa.Table:
        release()
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids")])
        lengths = table["length"].to_numpy()
        bins = first_fit_decreasing(lengths, capacity)
        order = np.lexsort((np.arange(len(bins)), bins))
        table, bins, lengths = table.take(pa.array(order)), bins[order], lengths[order]
        ends = np.cumsum(lengths) - lengths
        first = np.searchsorted(bins, bins, side="left")
        group = table["group"][0].as_py()
        table = table.drop_columns(["group"]).append_column("sequence_id", pa.array((group << _BINS) + bins))
        release()  # once more, as the last group's worker stays
        return table.append_column("offset", pa.array(ends - ends[first]))

    cut = pieces(docs, tokenizer, capacity, end_id, doc_id, text, spaces_matter)
    key = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", F.crc32("ids")), F.lit(groups))
    return (
        cut.withColumn("group", key)
        .groupBy("group")
        .applyInArrow(
            packed,
            "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long",
        )
    )
