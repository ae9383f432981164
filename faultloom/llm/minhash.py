"""Near-duplicates by MinHash bands and sequential Bayesian verification.

1. A text's set of word shingles becomes 128 minima, cut into bands; as many rows
   to a band as leave a pair at the threshold unmet with at most ``BAND_MISS``.
   Equal sets are one node from here on, so copies cost nothing more.
2. Each bucket takes a hub at random. Its members are paired with the hub alone:
   pairs grow with the members, not with their square.
3. A pair's signatures are compared in batches of 32. After each batch the
   posterior of the similarity (flat prior) is looked at; a pair whose
   probability of reaching the threshold is under ``POSTERIOR_MISS`` is dropped.
4. Survivors are verified exactly on their whole sets: first each node's likeliest
   pair, then those pairs that would still join two components.
5. Buckets that still hold several components are compared all through, in blocks
   of a bounded size, inside tasks: the pairs of different components, each in one
   of its buckets, go through the posterior bound and the exact test, and only
   links leave the task. So no link is left out for the hubs' sake, and no pairs
   are emitted.

Sizes prune before signatures: sets of which one is too small cannot be linked.

Texts without words have an empty set and no links. Rows without an id have no
component and are kept. Rows that repeat an id and its text share a component and
are kept or dropped together. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultloom.llm.common import WordHashes, batch, free_name, has_rows, kept, mixed, pieces, sliced, small_batches, texts_as_bytes
from faultloom.llm.components import connected_components
from faultloom.session import materialize

HASHES, STEP = 128, 32
BAND_MISS, POSTERIOR_MISS = 1e-6, 1e-8
#: Texts hashed at once (bytes), nodes and shingles of a block, node keys that are broadcast at most.
TEXT_BYTES, BLOCK, BLOCK_SHINGLES, BROADCAST_ROWS = 1 << 20, 1024, 1_000_000, 1_000_000
#: Pairs of signatures compared at once, pairs intersected one by one at most, columns of a matrix product.
STEP_PAIRS, FEW_PAIRS, COLUMNS = 50_000, 2_000, 4_096

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def band_rows(percent: int) -> int:
    """The most rows of a band at which a pair at the threshold is missed by all bands with BAND_MISS or less."""
    fits = [r for r in range(1, 17) if (1 - (percent / 100) ** r) ** (HASHES // r) <= BAND_MISS]
    return max(fits, default=1)


@cache
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    a, b = rng.integers(0, 1 << 63, (2, HASHES), dtype=np.uint64)
    return a * np.uint64(2) + np.uint64(1), b


def shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """Sorted different hashes of a text's windows of words; of a shorter text, one hash of all its words."""
    n = min(words, len(hashes))
    if not n:
        return hashes
    out = mixed(hashes[: len(hashes) - n + 1] + np.uint64(n))
    for j in range(1, n):
        out = mixed(out * _K1 + hashes[j : len(hashes) - n + 1 + j] * _K2)
    return np.unique(out)


def _bands(minima: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros((len(minima), HASHES // rows), np.uint64)
    for k in range(out.shape[1]):
        key = np.full(len(minima), np.uint64(k))
        for j in range(k * rows, (k + 1) * rows):
            key = mixed(key * _K1 + minima[:, j])
        out[:, k] = key
    return out.view(np.int64)


_FEATURES = pa.schema([
    ("doc_id", pa.int64()), ("version", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()),
    ("signature", pa.binary()), ("bands", pa.list_(pa.int64())),
])


def _features(words: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (a, b) = kept("minhash", WordHashes), _multipliers()
        for part in sliced(batches):
            ids, versions = part.column(0).to_pylist(), part.column(1).to_pylist()
            texts = texts_as_bytes(part.column(2))
            for lo, hi in pieces(texts, TEXT_BYTES):
                sets = [shingles(known.of(t.lower().split()), words) for t in texts[lo:hi]]
                full = [k for k, s in enumerate(sets) if len(s)]
                out = {
                    "doc_id": ids[lo:hi],
                    "version": versions[lo:hi],
                    "n_shingles": [len(s) for s in sets],
                    **{c: [None] * len(sets) for c in ("node", "signature", "bands")},
                }
                if full:
                    row = np.concatenate([sets[k] for k in full])
                    starts = np.concatenate([[0], np.cumsum([len(sets[k]) for k in full])[:-1]])
                    minima = np.stack([np.minimum.reduceat(row * a[i] + b[i], starts) for i in range(HASHES)], axis=1)
                    small, bands = mixed(minima).astype(np.uint8), _bands(minima, rows).tolist()
                    for j, k in enumerate(full):
                        out["node"][k] = xxhash.xxh3_128_digest(sets[k].tobytes())
                        out["signature"][k] = small[j].tobytes()
                        out["bands"][k] = bands[j]
                yield batch(_FEATURES, out)

    return run


@cache
def least_matches(percent: int) -> tuple[int, ...]:
    """Equal bytes below which a pair is dropped, after each batch.

    Minima are compared by one byte, so unequal ones agree once in 256; the
    threshold is raised by that share.
    """
    t = percent / 100
    t += (1 - t) / 256
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        # The posterior after m matches is Beta(m + 1, n - m + 1); its upper tail is a binomial sum.
        tail = np.cumsum([comb(n + 1, i) * t**i * (1 - t) ** (n + 1 - i) for i in range(n + 1)])
        out.append(int(np.searchsorted(tail, POSTERIOR_MISS)))
    return tuple(out)


def sequential(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Equal bytes of pairs of signatures (rows), -1 for those dropped on the way."""
    out, live = np.full(len(a), -1), np.arange(len(a))
    equal = np.zeros(len(a), np.int64)
    for k, least in enumerate(least_matches(percent)):
        part = slice(k * STEP, (k + 1) * STEP)
        equal[live] += (a[live, part] == b[live, part]).sum(axis=1)
        live = live[equal[live] >= least]
    out[live] = equal[live]
    return out


def _matrix(signatures) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), np.uint8).reshape(-1, HASHES)


def _agreement(percent: int):
    @F.pandas_udf("int")
    def agreement(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(sequential(_matrix(a), _matrix(b), percent), dtype="int32")

    return agreement.asNondeterministic()


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _members(nodes: DataFrame) -> DataFrame:
    return nodes.select("node", "n_shingles", F.explode("bands").alias("bucket"))


def _hubs(nodes: DataFrame) -> DataFrame:
    """(bucket, hub, hub_n, n_members, sum_n) of buckets of two nodes or more."""
    pick = F.min(F.struct(F.xxhash64("node", "bucket"), "node", "n_shingles")).alias("pick")
    sums = F.count(F.lit(1)).alias("n_members"), F.sum("n_shingles").alias("sum_n")
    found = _members(nodes).groupBy("bucket").agg(pick, *sums)
    return found.filter("n_members > 1").select(
        "bucket", F.col("pick.node").alias("hub"), F.col("pick.n_shingles").alias("hub_n"), "n_members", "sum_n"
    )


def _star_pairs(nodes: DataFrame, hubs: DataFrame, percent: int) -> DataFrame:
    met = _members(nodes).join(hubs, "bucket").filter(F.col("node") != F.col("hub"))
    met = met.filter(_sizes_fit("n_shingles", "hub_n", percent))
    return met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _surviving(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, agree) of pairs that the posterior bound leaves."""
    sides = [
        nodes.select(F.col("node").alias(x), F.col("signature").alias(f"s_{x}")) for x in ("a", "b")
    ]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    return both.select("a", "b", _agreement(percent)("s_a", "s_b").alias("agree")).filter("agree >= 0")


_LINK = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("common", pa.int64()), ("either", pa.int64())])


def _compare(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last, held = kept("minhash", WordHashes), None, None
        for part in sliced(batches):
            a, b = part.column(0).to_pylist(), part.column(1).to_pylist()
            out = {"a": a, "b": b, "common": [], "either": []}
            for key, one, two in zip(a, texts_as_bytes(part.column(2)), texts_as_bytes(part.column(3)), strict=True):
                if key != last:
                    last, held = key, shingles(known.of(one.lower().split()), words)
                other = shingles(known.of(two.lower().split()), words)
                common = len(np.intersect1d(held, other, assume_unique=True))
                out["common"].append(common)
                out["either"].append(len(held) + len(other) - common)
            yield batch(_LINK, out)

    return run


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, text) of wanted nodes. Their keys are broadcast while they are few, else joined by shuffle."""
    keys = materialize(nodes.join(wanted, "node", "left_semi").select("node", "rep.*"), "wanted")
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    found = docs.join(keys, ["doc_id", "version"]).select("node", "text")
    return found.dropDuplicates(["node"])


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links among pairs, by the similarity of whole sets."""
    both = pairs.select("a", "b").join(texts.select(F.col("node").alias("b"), F.col("text").alias("two")), "b")
    both = both.join(texts.select(F.col("node").alias("a"), F.col("text").alias("one")), "a")
    sizes = both.select("a", "b", "one", "two").mapInArrow(_compare(words), "a binary, b binary, common long, either long")
    return sizes.filter(F.col("common") * 100 >= F.col("either") * percent).select("a", "b")


def _rooted(df: DataFrame, roots: DataFrame, column: str) -> DataFrame:
    """The root of a node column beside it; a node without links is its own."""
    known = roots.select(F.col("node").alias(column), F.col("root").alias("_root"))
    out = df.join(known, column, "left")
    return out.withColumn(f"root_{column}", F.coalesce("_root", column)).drop("_root")


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common elements of pairs of sets; many pairs by a matrix product over elements that two sets have."""
    if len(left) <= FEW_PAIRS:
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(left, right, strict=True)], np.int64)
    rows, cols = np.unique(left), np.unique(right)
    used = np.union1d(rows, cols)
    sizes = [len(sets[k]) for k in used]
    element, owner = np.concatenate([sets[k] for k in used]), np.repeat(np.arange(len(used)), sizes)
    _, number, times = np.unique(element, return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    keep = shared[number]
    owner, number = owner[keep], column[number[keep]]
    at_row, at_col = np.searchsorted(used, rows), np.searchsorted(used, cols)
    product = np.zeros((len(rows), len(cols)), np.float32)
    by_number = np.argsort(number, kind="stable")
    owner, number = owner[by_number], number[by_number]
    for lo in range(0, int(shared.sum()), COLUMNS):
        part = slice(*np.searchsorted(number, [lo, lo + COLUMNS]))
        has = np.zeros((len(used), COLUMNS), np.float32)
        has[owner[part], number[part] - lo] = 1
        product += has[at_row] @ has[at_col].T
    return product[np.searchsorted(rows, left), np.searchsorted(cols, right)].astype(np.int64)


def _pairs_to_see(block: dict[str, np.ndarray], bucket: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one block, or of two, that this bucket is to look at and whose components and sizes allow a link."""
    left = np.flatnonzero(block["side"] == 0)
    right = np.flatnonzero(block["side"] == 1)
    alone = not len(right)
    right = left if alone else right
    _, root = np.unique(block["root"], return_inverse=True)
    n, bands = block["n"], block["bands"]
    see = root[left][:, None] != root[right]
    low, high = np.minimum(n[left][:, None], n[right]), np.maximum(n[left][:, None], n[right])
    see &= low * 100 >= high * percent
    # Of the buckets that a pair shares, the first band's sees it.
    for k in range(int(np.flatnonzero(bands[0] == bucket)[0])):
        see &= bands[left, k][:, None] != bands[right, k]
    if alone:
        see &= np.arange(len(left))[:, None] < np.arange(len(left))
    i, j = np.nonzero(see)
    return left[i], right[j]


def _blocks(words: int, percent: int):
    """Links between components among the pairs of two blocks of a bucket, found inside the task."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        node = np.array(table.column("node").to_pylist(), object)
        block = {
            "side": table.column("side").to_numpy(),
            "n": table.column("n_shingles").to_numpy(),
            "root": np.array(table.column("root_node").to_pylist(), object),
            "bands": np.array(table.column("bands").to_pylist(), np.int64),
        }
        i, j = _pairs_to_see(block, key[0].as_py(), percent)
        signature = _matrix(table.column("signature").to_pylist())
        alive = [
            np.flatnonzero(sequential(signature[i[k : k + STEP_PAIRS]], signature[j[k : k + STEP_PAIRS]], percent) >= 0) + k
            for k in range(0, len(i), STEP_PAIRS)
        ]
        alive = np.concatenate(alive) if alive else np.empty(0, np.int64)
        i, j = i[alive], j[alive]
        if len(i):
            known, sets = WordHashes(limit=100_000), [None] * len(node)
            texts = table.column("text").cast(pa.large_binary())
            for k in np.union1d(i, j).tolist():
                sets[k] = shingles(known.of((texts[k].as_py() or b"").lower().split()), words)
            common = _common(sets, i, j)
            linked = common * 100 >= (block["n"][i] + block["n"][j] - common) * percent
            i, j = i[linked], j[linked]
        # One link of a node to a component is as good as all.
        links = {(node[x], block["root"][y]): node[y] for x, y in zip(i.tolist(), j.tolist(), strict=True)}
        a, b = [x for x, _ in links], list(links.values())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _rest_links(docs: DataFrame, nodes: DataFrame, hubs: DataFrame, roots: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links that still join components, from buckets of three nodes or more that hold several."""
    large = hubs.filter("n_members > 2").select("bucket", "n_members", "sum_n")
    members = materialize(_rooted(_members(nodes).join(large, "bucket"), roots, "node"), "bucket-members")
    several = (
        members.groupBy("bucket")
        .agg(F.min("root_node").alias("x"), F.max("root_node").alias("y"))
        .filter("x <> y")
        .select("bucket")
    )
    open_ = materialize(members.join(several, "bucket", "left_semi"), "open-members")
    used = open_.select("node").distinct()
    texts = _texts(docs, nodes, used)
    whole = materialize(nodes.select("node", "signature", "bands").join(texts, "node"), "open-nodes")
    n_blocks = F.ceil(F.greatest(F.col("n_members") / BLOCK, F.col("sum_n") / BLOCK_SHINGLES)).cast("int")
    dealt = (
        open_.withColumn("n_blocks", n_blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select(
            "bucket", "node", "n_shingles", "root_node",
            F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
            F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"),
        )
        .join(whole, "node")
    )
    return dealt.groupBy("bucket", "i", "j").applyInArrow(_blocks(words, percent), "a binary, b binary")


def _versioned(docs: DataFrame, id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.xxhash64(body).alias("version"), body.alias("text"))


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, version, n_shingles, component_id, kept) for every row; ``version`` is a hash of the text."""
    small_batches(docs.sparkSession)
    rows = _versioned(docs, id, text)
    schema = "doc_id long, version long, n_shingles long, node binary, signature binary, bands array<long>"
    features = materialize(rows.mapInArrow(_features(words, band_rows(percent)), schema), "features")
    named = features.filter("doc_id IS NOT NULL AND node IS NOT NULL")
    nodes = materialize(
        named.groupBy("node").agg(
            F.min(F.struct("doc_id", "version")).alias("rep"), F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"), F.first("bands").alias("bands"),
        ),
        "nodes",
    )
    hubs = materialize(_hubs(nodes), "hubs")
    stars = materialize(_surviving(_star_pairs(nodes, hubs, percent), nodes, percent), "star-pairs")
    ends = stars.select(F.col("a").alias("node")).union(stars.select(F.col("b").alias("node"))).distinct()
    texts = materialize(_texts(rows, nodes, ends), "pair-texts")

    # Each node's likeliest pair first: most components come from these.
    each = stars.select("a", "b", "agree", F.explode(F.array("a", "b")).alias("node"))
    first = each.groupBy("node").agg(F.max(F.struct("agree", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
    links = materialize(_verified(materialize(first, "first-pairs"), texts, words, percent), "links")
    roots = materialize(connected_components(links), "roots")

    apart = F.col("root_a") != F.col("root_b")
    second = _rooted(_rooted(stars, roots, "a"), roots, "b").filter(apart).select("a", "b")
    second = materialize(second.join(first, ["a", "b"], "left_anti"), "second-pairs")
    if has_rows(second):
        links = materialize(links.union(_verified(second, texts, words, percent)), "links")
        roots = materialize(connected_components(links), "roots")

    rest = materialize(_rest_links(rows, nodes, hubs, roots, words, percent), "rest-links")
    if has_rows(rest):
        links = materialize(links.union(rest), "links")
        roots = materialize(connected_components(links), "roots")

    in_root = _rooted(nodes.select("node", F.col("rep.doc_id").alias("least")), roots, "node")
    names = in_root.groupBy("root_node").agg(F.min("least").alias("component_id"))
    component = in_root.join(names, "root_node").select("node", "component_id")
    out = features.select("doc_id", "version", "n_shingles", "node").join(component, "node", "left")
    # An empty set is a component of its own; a row without an id has none.
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "version", "n_shingles", own.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def dedup_documents(docs: DataFrame, words: int, percent: int) -> DataFrame:
    return near_duplicates(docs, words, percent).drop("version")


def filtered(docs: DataFrame, words: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with their columns: of each component those of the smallest id."""
    gone = near_duplicates(docs, words, percent, id, text).filter("NOT kept")
    row, version = free_name(docs, "copy_id"), free_name(docs, "copy_version")
    gone = materialize(gone.select(F.col("doc_id").alias(row), F.col("version").alias(version)).distinct(), "gone")
    body = F.coalesce(F.col(text), F.lit(""))
    same = (docs[id] == F.col(row)) & (F.xxhash64(body) == F.col(version))
    return docs.join(gone, same, "left_anti")
