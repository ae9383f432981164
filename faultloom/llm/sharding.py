"""Shards of near equal size by best-fit-decreasing bin packing.

Groups (rows of equal text) stay together. Groups are summed where they lie;
small ones are bundled into parcels of a fixed fraction of a shard, so what is
packed has a bounded number of items whatever the corpus holds: at most
``shards * PARCELS * 2`` and one open parcel for each bucket of a million groups.
Those items, not the rows, are sorted by size, and each enters the bin with the
tightest room that still takes it, found in a balanced tree. The smallest
capacity at which the items need no more than ``shards`` bins is used.

A group larger than a shard cannot be whole; it is cut by a hash of a row number
into parts of about an eighth of a shard, and each part stays whole. The number is
given where a row lies and written with it, so rows without an id, or with one
and the same, are cut and numbered like others; which rows of a cut group go where
may change with the layout of the input.

A null text counts as no bytes and equals the empty text. Null ids are rows like
others; repeated rows are rows of one group. No rows, no shards. Other columns
are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultloom.session import materialize

#: Extra bytes of a row, items that a shard is made of at least, groups of a bucket, rows numbered at once.
ROW_BYTES, PARCELS, BUCKET_GROUPS, NUMBERED = 16, 512, 1_000_000, 250_000


class Node:
    """A node of the tree: an entry, the subtrees of smaller and larger entries, and its height."""

    __slots__ = ("entry", "small", "large", "height")

    def __init__(self, entry: tuple[int, int]):
        self.entry, self.small, self.large, self.height = entry, None, None, 1


def _height(node: Node | None) -> int:
    return node.height if node else 0


def _lean(node: Node) -> int:
    return _height(node.small) - _height(node.large)


def _measure(node: Node) -> Node:
    node.height = 1 + max(_height(node.small), _height(node.large))
    return node


def _small_up(node: Node) -> Node:
    top = node.small
    node.small, top.large = top.large, node
    _measure(node)
    return _measure(top)


def _large_up(node: Node) -> Node:
    top = node.large
    node.large, top.small = top.small, node
    _measure(node)
    return _measure(top)


def _balanced(node: Node) -> Node:
    """The subtree with its heights at most one apart again, after one entry came or went."""
    lean = _lean(node)
    if lean > 1:
        if _lean(node.small) < 0:
            node.small = _large_up(node.small)
        return _small_up(node)
    if lean < -1:
        if _lean(node.large) > 0:
            node.large = _small_up(node.large)
        return _large_up(node)
    return _measure(node)


def _with(node: Node | None, entry: tuple[int, int]) -> Node:
    if node is None:
        return Node(entry)
    if entry < node.entry:
        node.small = _with(node.small, entry)
    else:
        node.large = _with(node.large, entry)
    return _balanced(node)


def _without_least(node: Node) -> tuple[tuple[int, int], Node | None]:
    if node.small is None:
        return node.entry, node.large
    least, node.small = _without_least(node.small)
    return least, _balanced(node)


def _without(node: Node, entry: tuple[int, int]) -> Node | None:
    if entry < node.entry:
        node.small = _without(node.small, entry)
    elif entry > node.entry:
        node.large = _without(node.large, entry)
    elif node.small is None or node.large is None:
        return node.small or node.large
    else:
        node.entry, node.large = _without_least(node.large)
    return _balanced(node)


class RoomTree:
    """Bins by room in a balanced search tree, whose height grows with the logarithm of the bins.

    Entries are (room, bin). ``take`` removes the entry with the least room that
    is enough: one walk down to find it, one to take it out.
    """

    def __init__(self):
        self.root: Node | None = None

    @property
    def height(self) -> int:
        return _height(self.root)

    def put(self, room: int, bin: int) -> None:
        self.root = _with(self.root, (room, bin))

    def take(self, size: int) -> tuple[int, int] | None:
        node, found = self.root, None
        while node is not None:
            if node.entry[0] >= size:
                node, found = node.small, node.entry
            else:
                node = node.large
        if found is not None:
            self.root = _without(self.root, found)
        return found


def best_fit_decreasing(items: list[tuple[int, int]], capacity: int) -> list[list[int]]:
    """Bins of item keys. ``items`` are (size, key); sizes are at most ``capacity``."""
    tree, bins = RoomTree(), []
    for size, key in sorted(items, key=lambda x: (-x[0], x[1])):
        found = tree.take(size)
        if found is None:
            bins.append([])
            found = capacity, len(bins) - 1
        room, at = found
        bins[at].append(key)
        tree.put(room - size, at)
    return bins


def smallest_capacity(items: list[tuple[int, int]], shards: int) -> list[list[int]]:
    """The packing of the smallest capacity that needs at most ``shards`` bins."""
    if not items:
        return []
    total = sum(size for size, _ in items)
    low = max(-(-total // shards), max(size for size, _ in items))
    step, best = max(1, low // 4096), None
    while best is None:
        bins = best_fit_decreasing(items, low + step)
        if len(bins) <= shards:
            best = bins
        else:
            low, step = low + step, step * 2
    high = low + step
    while high - low > max(1, total // shards // 100_000):
        middle = (low + high) // 2
        bins = best_fit_decreasing(items, middle)
        if len(bins) <= shards:
            high, best = middle, bins
        else:
            low = middle
    return best


def _size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def _items(keyed: DataFrame, shards: int, parcels: int) -> DataFrame:
    """(key, part, item, bytes): the item that each group, or part of a group, belongs to."""
    total = keyed.agg(F.sum("size")).first()[0] or 0
    capacity = max(1, total // shards)
    quantum = max(1, capacity // parcels)
    groups = keyed.groupBy("key", "part").agg(F.sum("size").alias("bytes"))
    buckets = max(1, -(-groups.count() // BUCKET_GROUPS))
    # Groups of a bucket from large to small; every quantum of bytes closes a parcel.
    bucket = F.pmod(F.hash("key", "part"), F.lit(buckets))
    running = F.sum("bytes").over(
        Window.partitionBy("bucket")
        .orderBy(F.desc("bytes"), "key", "part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    small = F.col("bytes") <= quantum
    placed = groups.withColumn("bucket", bucket).withColumn(
        "parcel", F.floor(F.coalesce(running, F.lit(0)) / F.lit(quantum))
    )
    # Two large groups never start in one quantum, so their item is their own.
    return placed.select(
        "key", "part", "bytes", F.xxhash64("bucket", "parcel", small).alias("item")
    )


def _parts(rows: DataFrame, shards: int) -> DataFrame:
    """Rows with ``part``: 0, but for rows of groups that no shard could take whole."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    capacity = max(1, total // shards)
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"))
    # Groups above a shard's share are fewer than the shards, so their table is small.
    large = groups.filter(F.col("bytes") > capacity).select(
        "key", F.ceil(F.col("bytes") * 8 / F.lit(capacity)).alias("cuts")
    )
    cut = F.pmod(F.xxhash64("row"), F.coalesce("cuts", F.lit(1)))
    return rows.join(F.broadcast(large), "key", "left").withColumn("part", cut).drop("cuts")


def _slots(placed: DataFrame) -> DataFrame:
    """Gapless numbers in each shard, numbered in blocks that are dealt by a hash of the row number."""
    n = placed.count()
    placed = placed.withColumn(
        "block", F.pmod(F.xxhash64("row"), F.lit(max(1, -(-n // NUMBERED))))
    )
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    first = blocks.select(
        "shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    inside = F.row_number().over(
        Window.partitionBy("shard", "block").orderBy("doc_id", "key", "row")
    )
    return (
        placed.withColumn("slot", inside)
        .join(first, ["shard", "block"])
        .withColumn("slot", (F.col("slot") - 1 + F.col("first")).cast("long"))
    )


def shard(
    docs: DataFrame, shards: int = 40, parcels: int = PARCELS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id).alias("doc_id"),
        _size(F.col(text)).alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.unhex(F.md5(body)).alias("key"),
        F.monotonically_increasing_id().alias("row"),
    )
    keyed = materialize(_parts(materialize(rows, "shard-rows"), shards), "shard-keyed")
    items = materialize(_items(keyed, shards, parcels), "shard-items")
    sizes = items.groupBy("item").agg(F.sum("bytes").alias("bytes")).collect()
    bins = smallest_capacity([(r["bytes"], r["item"]) for r in sizes], shards)
    spark = docs.sparkSession
    plan = spark.createDataFrame(
        [(key, at) for at, keys in enumerate(bins) for key in keys], "item long, shard int"
    )
    # One row for each item: bounded as said above.
    homes = items.join(F.broadcast(plan), "item").select("key", "part", "shard")
    placed = materialize(keyed.join(homes, ["key", "part"]), "shard-placed")
    return _slots(placed).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
