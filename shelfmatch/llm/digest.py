"""Quartile bucket digests: fingerprints of texts that stay close when a text is edited.

Every byte triplet is hashed into one of 128 buckets. A bucket's code says between which quartiles of all counts its own
lies. The digest is a length code, the ratios of the quartiles and the 128 codes; two digests differ by a bounded score.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import doc_texts

BUCKETS = 128
#: What unrelated texts differ by; a likeness of 0 is this far or farther.
FAR = 208
_CHUNK = 1 << 20
#: What one bucket adds to the difference, by the distance of its two codes.
_APART = np.array([0, 1, 2, 6])


def bucket_counts(data: bytes) -> np.ndarray:
    """Counts of the hashed triplets of consecutive bytes; none in fewer than three bytes."""
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(0, len(data) - 2), _CHUNK):
        b = np.frombuffer(data, np.uint8, min(_CHUNK + 2, len(data) - at), at).astype(np.uint32)
        triplet = b[:-2] | b[1:-1] << 8 | b[2:] << 16
        triplet *= np.uint32(2654435761)
        triplet ^= triplet >> 15
        triplet *= np.uint32(2246822519)
        counts += np.bincount(triplet >> 25, minlength=BUCKETS)
    return counts


def digest(data: bytes) -> bytes:
    """Length code, two quartile ratios, 32 bytes of bucket codes."""
    counts = bucket_counts(data)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]].tolist()
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = (codes[0::4] << 6 | codes[1::4] << 4 | codes[2::4] << 2 | codes[3::4]).astype(np.uint8)
    length = min(255, 1 + int(math.log(len(data), 1.1))) if data else 0
    ratios = (16 * q1 // (q3 + 1) << 4 | 16 * q2 // (q3 + 1)) & 255
    return bytes((length, ratios)) + packed.tobytes()


def difference(a: bytes, b: bytes) -> int:
    """Length codes, ratios and bucket codes apart; 0 for equal digests."""
    x, y = np.frombuffer(a[2:], np.uint8), np.frombuffer(b[2:], np.uint8)
    body = sum(int(_APART[np.abs((x >> s & 3).astype(np.int8) - (y >> s & 3).astype(np.int8))].sum()) for s in (0, 2, 4, 6))
    return body + abs(a[0] - b[0]) + abs((a[1] >> 4) - (b[1] >> 4)) + abs((a[1] & 15) - (b[1] & 15))


def likeness(a: bytes, b: bytes) -> float:
    """1 for equal digests, 0 for those as far apart as unrelated texts are."""
    return max(0.0, 1.0 - difference(a, b) / FAR)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the hexadecimal ``fingerprint`` of every whole text; a null text counts as empty."""
    from shelfmatch.llm.common import by_text

    return by_text(doc_texts(docs), lambda: lambda texts: [pa.array([digest(t.encode("utf-8", "surrogatepass")).hex() for t in texts])], "fingerprint string")


def ordered_blocks(rows: DataFrame, per_block: int = 64) -> tuple[Column, list[tuple[int, int, int]]]:
    """Cut rows with order keys ``d, h`` into consecutive blocks: the block of a row, and each block's first key.

    Bounds come from a sample of about ``per_block`` distinct keys a block, taken by hash; only bounds and first keys, a
    fixed number for each block, come to the driver. Every row of a key is in one block.
    """
    wanted = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    step = max(1, rows.count() // (wanted * per_block))
    sample = rows.filter(F.pmod(F.xxhash64("d", "h"), F.lit(step)) == 0).select("d", "h").distinct().collect()
    keys = sorted((r["d"], r["h"]) for r in sample)
    bounds = keys[::max(1, math.ceil(len(keys) / wanted))]
    # Two levels, so that a row looks at about twice the root of their number.
    width = max(1, math.isqrt(len(bounds)))
    groups = [[{"d": d, "h": h} for d, h in bounds[i:i + width]] for i in range(0, len(bounds), width)]
    literal = F.from_json(F.lit(json.dumps(groups)), "array<array<struct<d:bigint,h:bigint>>>")
    key = F.struct("d", "h")
    group = F.size(F.filter(literal, lambda g: F.element_at(g, 1) <= key))
    inside = F.size(F.filter(F.get(literal, group - 1), lambda b: b <= key))
    block = F.when(group == 0, 0).otherwise((group - 1) * width + inside).cast("int")
    firsts = rows.groupBy(block.alias("block")).agg(F.min(key).alias("key")).collect()
    return block, sorted((r["block"], r["key"]["d"], r["key"]["h"]) for r in firsts)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows of ``doc_id, text`` dealt into ordered blocks, each followed by a copy (``after``) of what comes next.

    The order is the id (null first), then text; after the last document comes the first. A block is a run of whole keys,
    sorted, so no task holds more than it streams through.
    """
    rows = doc_texts(docs).withColumns({"d": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))), "h": F.xxhash64("text")})
    block, firsts = ordered_blocks(rows)
    if not firsts:
        return rows.select("doc_id", "text", F.lit(0).alias("block"), F.lit(False).alias("after"))
    size = firsts[-1][0] + 1
    first: list[dict | None] = [None] * size
    for i, (b, d, h) in enumerate(firsts):
        first[b] = {"d": d, "h": h, "to": firsts[i - 1][0]}
    literal = F.from_json(F.lit(json.dumps(first)), "array<struct<d:bigint,h:bigint,to:int>>")
    own = F.get(literal, F.col("block"))
    copies = F.when((own["d"] == F.col("d")) & (own["h"] == F.col("h")), F.array(
        F.struct(F.col("block"), F.lit(False).alias("after")), F.struct(own["to"].alias("block"), F.lit(True).alias("after")),
    )).otherwise(F.array(F.struct(F.col("block"), F.lit(False).alias("after"))))
    dealt = rows.withColumn("block", block).select("doc_id", "text", "d", "h", F.explode(copies).alias("c")).select(
        "doc_id", "text", "d", "h", "c.block", "c.after")
    return dealt.repartition("block").sortWithinPartitions("block", "after", "d", "h", "text").select("doc_id", "text", "block", "after")


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by as much of the following text's start, or all of it."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprint every document, its edited text (see ``edited``) and its likeness to both that and the next document.

    Null texts count as empty: fingerprint of nothing, likeness 1 to another empty text. Repeated rows follow each other
    and each gets a row. A single document is followed by itself. An empty table gives an empty result; other columns are
    not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row that still waits for the next one: id, text, bytes, digest, block

        def row(held: tuple, text: str, sign: bytes) -> tuple:
            doc_id, own, mine, _ = held
            changed = edited(own, text).encode("utf-8", "surrogatepass")
            after = digest(changed)
            return doc_id, len(own), hashlib.sha256(changed).hexdigest(), mine.hex(), after.hex(), likeness(mine, after), likeness(mine, sign)

        for batch in batches:
            rows = []
            for doc_id, text, block, after in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if held is None and after:
                    continue  # another copy of what follows
                sign = digest(text.encode("utf-8", "surrogatepass"))
                if held is not None and (held[3] == block):
                    rows.append(row(held, text, sign))
                held = None if after else (doc_id, text, sign, block)
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, out, strict=True)], schema=out)

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    out = pa.schema(list(zip(names, kinds, strict=True)))
    rows = with_next(docs)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
