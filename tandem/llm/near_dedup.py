"""MinHash near-deduplication by a multi-index Hamming join.

Every document becomes its set of word shingles and a signature of ``CHUNKS * CHUNK`` MinHash
components of ``BITS`` bits. Two signatures at component distance up to ``CHUNKS * (ERRORS + 1) - 1``
have, by the pigeonhole principle, a chunk with at most ``ERRORS`` differing components. Enumerating
the components that may be wrong gives each document ``CHUNKS * C(CHUNK, ERRORS)`` keys, each the
other components of one chunk; every pair within the distance shares a key. With 8 chunks of 5 and
one error that distance is 15 of 40. Most pairs beyond it share a key too, and every pair that shares
one is a candidate, whatever its distance: only sizes of sets that rule a link out and the full sets
decide. So a link is missed only if its documents share no key, which at Jaccard similarity 0.8 has
probability 2.3e-5 (5e-7 at 0.85).

Links are found in two steps, so that a group of n copies costs about n and not n * n:

* *Stars.* Every document of a key is compared with the key's smallest document. Pairs whose sizes
  allow it are confirmed on the full sets, and links are joined to components.
* *Rest.* Only keys that still hold several components are gone through in full. Size is all that
  makes a pair of a key a candidate, so the rows of a key in the order of their sizes, linked to their
  neighbours where the sizes fit, connect what all its candidates would: a few edges per document,
  which tasks reduce to forests, and which gather what belongs together in *clusters*. A cluster's pairs that share a key are confirmed on
  the full sets, again in blocks, so a set goes to as many tasks as its cluster has blocks and not
  to as many as it has pairs. Pairs inside a component need no comparison, as they cannot change the
  components.

Documents with equal sets are one node from the start. Sets hold 64-bit hashes of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tandem.llm.common import release, small, worker_store
from tandem.session import stage, stage_result

SHINGLE = 5
SIMILARITY = 0.8
CHUNKS = 8
CHUNK = 5
ERRORS = 1
BITS = 14
CONTRACT_EDGES = 200_000
SET_BLOCK_ROWS = 128
CACHE_WORDS = 100_000

COMPONENTS = CHUNKS * CHUNK
DISTANCE = CHUNKS * (ERRORS + 1) - 1
_KEPT = [list(c) for c in combinations(range(CHUNK), CHUNK - ERRORS)]

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


# ------------------------------------------------------------------ sets and signatures


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _MIX
    return values ^ (values >> np.uint64(27))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, size: int = SHINGLE, hashes: dict[bytes, int] | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; ASCII letters in lower case.

    A text of fewer words than ``size``, but not none, is one shingle. ``hashes`` keeps those of words
    from text to text.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = _WordHashes() if hashes is None else hashes
    if len(hashes) > CACHE_WORDS:
        hashes.clear()
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    count = len(words) - size + 1
    shingles = np.full(count, size, np.uint64)
    for i in range(size):
        shingles = _mixed(shingles * _ODD + values[i : i + count])
    return np.unique(shingles)


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash components of a set that is not empty, ``BITS`` bits each."""
    factors = _mixed(np.arange(1, COMPONENTS + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
    least = np.full(COMPONENTS, np.uint64(2**64 - 1))
    for start in range(0, len(shingles), 4_096):
        part = shingles[start : start + 4_096]
        hashed = part * factors[:, None]
        hashed ^= hashed >> np.uint64(32)
        hashed *= _MIX
        np.minimum(least, hashed.min(axis=1), out=least)
    return ((least * _ODD) >> np.uint64(64 - BITS)).astype(np.uint16)


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of every signature: chunk, components kept and their values, as one integer."""
    chunks = signatures.reshape(len(signatures), CHUNKS, CHUNK).astype(np.int64)
    keys = np.empty((len(signatures), CHUNKS, len(_KEPT)), np.int64)
    for j, kept in enumerate(_KEPT):
        value = np.zeros((len(signatures), CHUNKS), np.int64)
        for component in kept:
            value = (value << BITS) | chunks[:, :, component]
        keys[:, :, j] = value
    slots = np.arange(CHUNKS * len(_KEPT), dtype=np.int64).reshape(CHUNKS, len(_KEPT))
    return ((slots << (BITS * (CHUNK - ERRORS))) | keys).reshape(len(signatures), -1)


def _digest(size: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import xxhash

        worker_store("near_dedup")
        hashes = _WordHashes()
        for texts in batches:
            sizes, prints, signatures = [], [], []
            for value in texts:
                shingles = shingle_set(value.as_py(), size, hashes)
                sizes.append(len(shingles))
                prints.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                signatures.append(signature(shingles).astype("<u2").tobytes() if len(shingles) else None)
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(signatures, pa.binary())], ["n", "print", "sig"]
            )
        hashes.clear()
        release()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def _as_signatures(column: pa.Array) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<u2").reshape(len(column), COMPONENTS)


def _keys_of(signatures: pa.Array) -> pa.Array:
    keys = index_keys(_as_signatures(signatures))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * keys.shape[1], pa.int32()), pa.array(keys.reshape(-1)))


_keys_of.__annotations__ = {"signatures": pa.Array, "return": pa.Array}


def _share_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether signatures have a key in common: a chunk with at most ``ERRORS`` differing components."""
    return ((a != b).reshape(-1, CHUNKS, CHUNK).sum(axis=2) <= ERRORS).any(axis=1)


def _fit(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can be links at all."""
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _set_bytes(size: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes = _WordHashes()
        for texts in batches:
            yield pa.array([shingle_set(t.as_py(), size, hashes).tobytes() for t in texts], pa.binary())
        hashes.clear()
        release()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def _confirmed(percent: int):
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for left, right in zip(a, b):
            x, y = (np.frombuffer(s.as_py(), np.uint64) for s in (left, right))
            common = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * common >= percent * (len(x) + len(y) - common))
        return pa.array(out, pa.bool_())

    run.__annotations__ = {"a": pa.Array, "b": pa.Array, "return": pa.Array}
    return run


# ------------------------------------------------------------------ pairs and components


def _sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node and full set of the texts whose id is a ``wanted`` node. Staged."""
    wanted = stage(wanted, "wanted")
    held = docs.join(small(wanted, wanted.count()), docs["__id"] == wanted["node"], "left_semi")
    return stage(held.select(F.col("__id").alias("node"), F.arrow_udf(_set_bytes(size), "binary")("__text").alias("set")), "sets")


def _confirm(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the distinct ``pairs`` (a, b) that are links by their full sets. Staged."""
    near = stage(pairs, "candidates")
    sets = _sets(docs, near.select(F.explode(F.array("a", "b")).alias("node")).distinct(), size)
    full = near.join(sets.withColumnsRenamed({"node": "a", "set": "set_a"}), "a").join(sets.withColumnsRenamed({"node": "b", "set": "set_b"}), "b")
    return stage(full.filter(F.arrow_udf(_confirmed(percent), "boolean")("set_a", "set_b")).select("a", "b"), "links")


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of a task's edges (a, b): every node that is not the smallest of its tree, with that one."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        top = node
        while (up := parent.get(top, top)) != top:
            top = up
        while node != top:
            parent[node], node = top, parent[node]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array([root(n) for n in nodes], pa.int64()), pa.array(nodes, pa.int64())], ["a", "b"])
    parent.clear()
    release()


def components(links: DataFrame) -> DataFrame:
    """node, component of the nodes of ``links`` (a, b): the smallest node each is connected with. Staged.

    Every task first reduces ``CONTRACT_EDGES`` edges to a forest, at most an edge per node it knows.
    Where several tasks are needed, labels then run along the forests' edges and, by looking up the
    label's own label, along chains of labels, so the number of rounds grows with the logarithm of
    a component's diameter.
    """
    links = stage(links.select("a", "b").filter("a <> b"), "edges")
    tasks = max(1, -(-links.count() // CONTRACT_EDGES))
    forest = stage(links.coalesce(tasks).mapInArrow(_contract, "a long, b long"), "forest")
    if tasks == 1:
        roots = forest.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
        return forest.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)
    both = stage(forest.union(forest.select("b", "a")).distinct(), "edges")
    labels = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        label = labels.select(F.col("node").alias("b"), "label")
        around = both.join(label, "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        nearer = labels.join(around, "node").select("node", "label", F.least("label", "near").alias("best"))
        # The label's own label: a component's smallest node labels itself.
        own = labels.select(F.col("node").alias("best"), F.col("label").alias("own"))
        jumped = nearer.join(own, "best", "left").select("node", "label", F.least("best", F.coalesce("own", "best")).alias("new"))
        jumped = stage(jumped, "labels")
        changed = not jumped.filter("new <> label").isEmpty()
        labels = jumped.select("node", F.col("new").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "component")


def _stars(keyed: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) among the pairs of a key's smallest node and another one whose sizes fit. Staged.

    Most copies are found with the smallest of all those nodes, so that pair is confirmed first; the
    others of a node only where they still lie in different components.
    """
    fit = 100 * F.least("n", "n_first") >= percent * F.greatest("n", "n_first")
    pairs = stage(keyed.filter(F.col("node") > F.col("first")).filter(fit).select(F.col("first").alias("a"), F.col("node").alias("b")).distinct(), "star-pairs")
    links = _confirm(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), docs, size, percent)
    labels = components(links)
    for end in ("a", "b"):
        pairs = pairs.join(labels.withColumnsRenamed({"node": end, "component": f"at_{end}"}), end, "left").withColumn(f"at_{end}", F.coalesce(f"at_{end}", end))
    return links.union(_confirm(pairs.filter("at_a <> at_b").select("a", "b"), docs, size, percent))


def _block_pairs(df: DataFrame, group: str, rows: int) -> DataFrame:
    """Deal every row to all pairs of blocks of its ``group`` that its own block is part of.

    ``df`` has the size of the group in ``size``. Adds own, one and two, and brings together what has
    the same group, one and two, next to each other.
    """
    dealt = df.withColumn("blocks", F.ceil(F.col("size") / F.lit(rows))).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumn("one", F.least("own", "other")).withColumn("two", F.greatest("own", "other"))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(partitions, group, "one", "two").sortWithinPartitions(group, "one", "two")


def _chains(open_: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect the rows (key, node, n) of every key whose sizes fit, directly or over others.

    In the order of their sizes, rows are connected if and only if neighbours are: rows of one size with the
    smallest of them, and those smallest ones with the next size, if it fits.
    """
    reps = stage(open_.groupBy("key", "n").agg(F.min("node").alias("rep")), "sizes-of-keys")
    level = open_.join(small(reps, reps.count()), ["key", "n"]).filter("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b"))
    by_size = W.partitionBy("key").orderBy("n")
    steps = reps.select(F.lag("rep").over(by_size).alias("a"), F.col("rep").alias("b"), F.lag("n").over(by_size).alias("n_a"), F.col("n").alias("n_b"))
    steps = steps.filter((F.col("a") != F.col("b")) & (100 * F.col("n_a") >= percent * F.col("n_b"))).select("a", "b")
    # Many keys say the same; every task reports only a forest.
    return level.union(steps).mapInArrow(_contract, "a long, b long")


def _rest(keyed: DataFrame, nodes: DataFrame, labels: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between different components that share a key. Staged.

    ``keyed`` holds (key, node, n) of keys with several nodes.
    """
    placed = keyed.join(labels, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
    placed = stage(placed, "placed")
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
    mixed = stage(mixed, "mixed")
    open_ = placed.join(small(mixed, mixed.count()), "key", "left_semi")
    members = components(_chains(open_, percent)).withColumnRenamed("component", "group").join(labels, "node", "left")
    members = stage(members.withColumn("component", F.coalesce("component", "node")), "clusters")
    sizes = members.groupBy("group").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
    sizes = stage(sizes.filter("low < high").select("group", "size"), "sizes")
    members = stage(members.join(small(sizes, sizes.count()), "group"), "members")
    sets = _sets(docs, members.select("node"), size)
    members = members.join(nodes.select("node", "sig"), "node").join(sets, "node").withColumn("n", (F.octet_length("set") / 8).cast("long"))
    return stage(_block_pairs(members, "group", SET_BLOCK_ROWS).select(*_COLUMNS, "sig", "set").mapInArrow(_linked(percent), "a long, b long").distinct(), "links")


_COLUMNS = ["group", "one", "two", "own", "node", "component", "n"]


def _groups(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of whole (group, one, two), of about ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        count = sum(b.num_rows for b in held)
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        last = table.slice(count - 1, 1).select(["group", "one", "two"]).to_pylist()[0]
        same = np.logical_and.reduce([table.column(c).to_numpy() == last[c] for c in ("group", "one", "two")])
        cut = int(np.argmax(same))
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _candidates(table: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of rows of one (group, one, two) and different components whose sizes allow a link."""
    group, one, two, own, component, n = (table.column(c).to_numpy() for c in ("group", "one", "two", "own", "component", "n"))
    start = np.append(True, (group[1:] != group[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1]))
    run = np.cumsum(start)
    step = 1
    active = np.flatnonzero(run[step:] == run[:-step])
    while len(active):
        for at in range(0, len(active), 1 << 16):
            left = active[at : at + (1 << 16)]
            right = left + step
            # A pair of rows of one block belongs to the task of that block alone.
            fit = (component[left] != component[right]) & ((one[left] == two[left]) | (own[left] != own[right]))
            fit &= _fit(n[left], n[right], percent)
            if fit.any():
                yield left[fit], right[fit]
        step += 1
        active = active[active + step < len(run)]
        active = active[run[active + step] == run[active]]


def _pair_batch(table: pa.Table, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    node = table.column("node").to_numpy()
    ends = node[np.array(pairs, np.int64).reshape(-1, 2)]
    return pa.RecordBatch.from_arrays([pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))], ["a", "b"])


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The candidates that share a key and are links by their full sets."""
        for table in _groups(batches, 2_000):
            sets = [np.frombuffer(s.as_py(), np.uint64) for s in table.column("set")]
            sig = _as_signatures(table.column("sig").combine_chunks())
            kept: list[tuple[int, int]] = []
            for left, right in _candidates(table, percent):
                shared = _share_key(sig[left], sig[right])
                for i, j in zip(left[shared].tolist(), right[shared].tolist()):
                    common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                        kept.append((i, j))
            yield _pair_batch(table, kept)
        release()

    return run


# ------------------------------------------------------------------ documents


def _same_id(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) that make one document of the rows of an id that have different sets."""
    texts = rows.filter("n > 0 AND doc_id IS NOT NULL")
    several = texts.groupBy("doc_id").agg(F.min("print").alias("low"), F.max("print").alias("high")).filter("low < high")
    several = stage(several.select("doc_id"), "same-id")
    prints = texts.join(small(several, several.count()), "doc_id", "left_semi").select("doc_id", "print").distinct()
    return prints.join(nodes.select("print", "node"), "print").select(F.col("node").alias("a"), F.col("doc_id").alias("b")).filter("a <> b")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    Documents are linked from a Jaccard ``similarity``, in whole percent, of their sets of shingles of
    ``size`` words on; a component's id is its smallest doc_id, and that document is kept. NULL, empty
    and blank texts have no shingles and are linked with nothing. Rows that share an id are one
    document, with the links of all of them. Rows without an id are linked with nothing, have no
    component, and are kept. Other columns are ignored.
    """
    spark, percent = docs.sparkSession, round(100 * similarity)
    read = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").alias("__text"))

    def build() -> DataFrame:
        d = F.arrow_udf(_digest(size), "n long, print binary, sig binary")("__text")
        rows = stage(read.select(F.col("__id").alias("doc_id"), d.alias("d")).select("doc_id", "d.*"), "digests")
        # Equal sets are one node, named by its smallest id.
        nodes = rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("node"), F.first("sig").alias("sig"), F.first("n").alias("n"), F.count("*").alias("rows"))
        nodes = stage(nodes, "nodes")
        keys = nodes.select("node", "n", F.explode(F.arrow_udf(_keys_of, "array<long>")("sig")).alias("key"))
        stars = keys.groupBy("key").agg(F.min(F.struct("node", "n")).alias("first"), F.max("node").alias("last")).filter("first.node < last")
        stars = stage(stars.select("key", F.col("first.node").alias("first"), F.col("first.n").alias("n_first")), "stars")
        keyed = stage(keys.join(small(stars, stars.count()), "key"), "keyed")
        links = stage(_stars(keyed, read, size, percent).union(_same_id(rows, nodes)), "links")
        labels = stage(components(links), "components")
        more = _rest(keyed.select("key", "node", "n"), nodes, labels, read, size, percent)
        if not more.isEmpty():
            labels = stage(components(links.union(more)), "components")
        # Copies by set follow their node; only sets that several rows have need looking up.
        shared = stage(nodes.filter("rows > 1").select("print", "node"), "shared")
        out = rows.join(small(shared, shared.count()), "print", "left").select("doc_id", "n", F.coalesce("node", "doc_id").alias("node"))
        out = out.join(small(labels, labels.count()), "node", "left").select("doc_id", "n", F.coalesce("component", "node").alias("component"))
        # Rows that share an id are one document.
        return out.select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
            (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component"))).alias("kept"),
        )

    return stage_result(spark, "near-duplicates", build)


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each component; rows without an id stay. Columns stay as they are."""
    found = near_duplicates(docs, size, similarity)
    gone = stage(found.filter("NOT kept").select(F.col("doc_id").alias("__gone")).distinct(), "near-copies")
    left = docs.join(small(gone, gone.count()), F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
    again = stage(found.filter("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__again")).count().filter("count > 1").select("__again"), "repeated-ids")
    if again.isEmpty():
        return left
    same = F.col("doc_id").cast("long") == F.col("__again")
    return left.join(again, same, "left_anti").union(left.join(again, same, "left_semi").dropDuplicates(["doc_id"]))
