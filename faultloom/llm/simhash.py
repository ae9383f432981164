"""Near-duplicates by SimHash fingerprints, joined on pigeonhole blocks.

1. A text's three-word shingles, repeats included, are hashed to 64 bits; a bit of
   its fingerprint is set if it is set in over half of the hashes.
2. A fingerprint is cut into four blocks. Two that differ in at most two bits agree
   in two blocks at least, so each different fingerprint goes to six tables, one
   for each pair of blocks, under the value of that pair.
3. Fingerprints with an equal value are joined and their distance is verified in
   the join, in buckets of at most ``CROWD`` members. The members of fuller
   buckets emit themselves with each bit flipped, or none: two that differ in at
   most two bits share such a neighbour, and a neighbour is shared by 65 at most.
   So work grows with the members, never with a bucket's square, and no link of
   the classes is left out.
4. Links become connected components of fingerprints.

Only words are looked at: texts without words, null texts among them, have
fingerprint zero and are linked like any other. Rows without an id have a
fingerprint but no component and link nothing. Rows that repeat an id have a
fingerprint each; each has the smallest id reachable from its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultloom.llm.common import batch, join_facts, sliced, texts_as_bytes
from faultloom.llm.components import connected_components
from faultloom.session import materialize

WORDS, SEED, BITS, DISTANCE, BLOCKS = 3, 42, 64, 2, 4
#: Members of a bucket that are compared with each other; hashes whose bits are counted at once.
CROWD, STEP = 16, 1 << 15


def shingle_hashes(text: bytes) -> np.ndarray:
    """The hash of each shingle, in order, repeats included; of a shorter text, of all its words."""
    found = text.lower().split()
    if len(found) <= WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), SEED)] if found else [], np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[: -WORDS] + 1])
    spans = zip(starts.tolist(), ends[WORDS - 1 :].tolist(), strict=True)
    return np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes; zero for none."""
    set_in = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), STEP):
        part = hashes[lo : lo + STEP].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(hashes), bitorder="little").view("<u8")[0])


_PRINTS = pa.schema([("doc_id", pa.int64()), ("print", pa.int64())])


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in sliced(batches):
        found = [fingerprint(shingle_hashes(t)) for t in texts_as_bytes(part.column(1))]
        yield batch(_PRINTS, {"doc_id": part.column(0), "print": np.array(found, np.uint64).view(np.int64)})


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, print) for every row; the fingerprint as a signed number."""
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_prints, "doc_id long, print long")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def block_masks() -> list[int]:
    """The bits of each table's key: all ways to keep the blocks that ``DISTANCE`` differing bits leave whole."""
    width = BITS // BLOCKS
    kept = combinations(range(BLOCKS), BLOCKS - DISTANCE)
    return [_signed(sum(((1 << width) - 1) << (width * b) for b in blocks)) for blocks in kept]


def _near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= DISTANCE


def _members(prints: DataFrame) -> DataFrame:
    """(block, value, print, n) of buckets with several members, ``n`` of them."""
    keys = [F.struct(F.lit(k).alias("block"), F.col("print").bitwiseAND(m).alias("value")) for k, m in enumerate(block_masks())]
    spread = prints.select("print", F.explode(F.array(*keys)).alias("key")).select("key.*", "print")
    sizes = spread.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = materialize(sizes.withColumn("size", F.col("n")), "bucket-sizes")
    total = prints.count() * len(keys)
    return join_facts(spread, sizes, ["block", "value"], total)


def _crowded_links(prints: DataFrame) -> DataFrame:
    """(a, b): each fingerprint with the smallest of those that share a neighbour with it."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << k)) for k in range(BITS)])
    spread = prints.select("print", F.explode(flips).alias("flip"))
    around = spread.select("print", F.col("print").bitwiseXOR(F.col("flip")).alias("neighbour"))
    # At most one member for each bit, and the neighbour itself.
    groups = around.groupBy("neighbour").agg(F.sort_array(F.collect_list("print")).alias("all")).filter(F.size("all") > 1)
    pairs = groups.select(F.col("all")[0].alias("a"), F.explode(F.slice("all", 2, BITS)).alias("b"))
    return pairs.filter(_near(F.col("a"), F.col("b"))).distinct()


def links(prints: DataFrame) -> DataFrame:
    """(a, b) of different fingerprints, whose components are those of all close pairs. ``prints`` are distinct."""
    members = materialize(_members(prints), "block-members")
    few = members.filter(F.col("size") <= CROWD)
    one = few.select("block", "value", F.col("print").alias("a"))
    two = few.select("block", "value", F.col("print").alias("b"))
    same = (one["block"] == two["block"]) & (one["value"] == two["value"])
    close = one.join(two, same & (F.col("a") < F.col("b")) & _near(F.col("a"), F.col("b"))).select("a", "b")
    crowd = materialize(members.filter(F.col("size") > CROWD).select("print").distinct(), "crowded")
    return close.union(_crowded_links(crowd)).distinct()


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row; the fingerprint as 16 hexadecimal digits."""
    rows = materialize(fingerprints(docs, id, text), "fingerprints")
    named = rows.groupBy("print").agg(F.min("doc_id").alias("least"), F.count("doc_id").alias("n"))
    named = materialize(named, "different-prints")
    found = materialize(links(named.filter("n > 0").select("print")), "print-links")
    roots = connected_components(found).withColumnRenamed("node", "print")
    rooted = materialize(named.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print")), "print-roots")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    ids = materialize(ids, "component-ids")
    total = rows.count()
    facts = materialize(join_facts(rooted.select("print", "root", F.col("n").alias("rows")), ids, "root", total), "print-components")
    facts = facts.select("print", "component_id", F.col("rows").alias("n"))
    out = join_facts(rows, facts, "print", total)
    return out.select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), BITS // 4, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
