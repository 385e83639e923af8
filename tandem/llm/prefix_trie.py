"""The trie of all prefixes of conversations, built by van Emde Boas recursion.

Sequences of turns are cut at half their depth. Every distinct prefix up to the cut gets a name; the
prefixes form the upper trie, and what is below the cut one forest with a tree per name. Both halves
are cut again in the same way. All pieces of one height are cut in the same Spark job, so a trie of
depth D takes about log2(D) rounds, whatever the number of its pieces:

* A piece covers the depths between two multiples of its height ``2 * b``; its cut is the odd
  multiple of ``b`` between them. A sequence in it stands for all conversations that agree so far.
* The name of a prefix is a 128-bit value of its turns and their positions, put together from the name
  at the piece's top and that of the block of ``b`` turns below it. Blocks of ``2 * b`` turns are named
  from those of ``b``. Naming needs no lookup, so a prefix that many share is no hot key; they meet
  only in sums that are combined before they are shuffled.
* Above a cut, one sequence stands for all that share the prefix. Below it each goes on by itself.

Totals are grafted upward along the same cuts. First each node gets the sum of its own lower piece:
a node counts for itself and for the tops of the pieces it is in, of which there are at most log2(D).
Then pieces are put on top of each other, highest ones first: the total of a node is that sum plus the
totals of the cut nodes below its lower piece.

Turns are never gathered by conversation: their places in it come from one range-partitioned sort.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tandem.llm.common import small
from tandem.session import stage, stage_result

FORK = 20
CHUNK_BITS = 14

_WORD = r"[^\x20\x09-\x0D]+"
_NODE = ["depth", "n1", "n2"]


# ------------------------------------------------------------------ turns in order


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, h1, h2, words of every turn, ``pos`` from 1 in the order of conv_id and turn.

    NULL turns come first; turns of one number are ordered by role and text. NULL role or text is
    empty. Rows without a conv_id are left out. Staged.

    The rows are sorted over all tasks; a conversation may run through several of them. Its rows are
    counted per task, and its place in a task begins after what earlier tasks hold.
    """
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    spread = rows.repartitionByRange(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    placed = spread.select(
        "conv_id",
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64(F.lit(11), "role", "text").alias("h1"),
        F.xxhash64(F.lit(12), "role", "text").alias("h2"),
        F.regexp_count("text", F.lit(_WORD)).cast("long").alias("words"),
    )
    placed = stage(placed, "placed-turns").withColumn("task", F.shiftright("row", 33))
    parts = placed.groupBy("conv_id", "task").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = F.sum("n").over(W.partitionBy("conv_id").orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select("conv_id", "task", (F.coalesce(earlier, F.lit(0)) - F.col("first") + 1).alias("shift"))
    turns = placed.join(parts, ["conv_id", "task"]).select("conv_id", (F.col("row") + F.col("shift")).alias("pos"), "h1", "h2", "words")
    return stage(turns, "turns")


def forked(turns: DataFrame, group: int = FORK) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt as forks: (conv_id) and the turns (conv_id, pos, h1, h2, words). Both staged.

    Conversation c becomes the first h turns of conversation ``c - c % group`` (all if there are fewer, none if there
    is no such conversation), then its own turns after its first h; h is the CRC-32 of its decimal id modulo 4.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % 4).alias("h"))
    convs = convs.join(sizes.withColumnRenamed("conv_id", "base"), "base", "left").withColumn("taken", F.least("h", F.coalesce("n", F.lit(0))))
    convs = stage(convs.select("conv_id", "base", "h", "taken"), "forks")
    heads = turns.filter("pos < 4").withColumnRenamed("conv_id", "base").join(convs, "base").filter("pos <= h")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").filter("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    columns = ["conv_id", "pos", "h1", "h2", "words"]
    return convs.select("conv_id"), stage(heads.select(*columns).unionByName(own.select(*columns)), "forked-turns")


# ------------------------------------------------------------------ the recursion


def _xor(a: str, b: str) -> Column:
    return F.col(a).bitwiseXOR(F.col(b))


def _block_names(elements: DataFrame, rounds: int) -> list[DataFrame]:
    """(seq, block, b1, b2, words) for blocks of 1, 2, 4 … elements; ``words`` are those of the last one."""
    tables = [stage(elements, "blocks")]
    for _ in range(rounds - 1):
        halves = tables[-1]
        # A block's name does not depend on how it is put together, as elements are hashed with their place.
        whole = halves.groupBy("seq", F.shiftright("block", 1).alias("block")).agg(
            F.bit_xor("b1").alias("b1"), F.bit_xor("b2").alias("b2"), F.max_by("words", "block").alias("words")
        )
        tables.append(stage(whole, "blocks"))
    return tables


def _cut(pieces: DataFrame, blocks: DataFrame, b: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cut all pieces of height ``2 * b``: (the nodes at the cuts, the pieces of height ``b``, steps to higher cuts).

    ``pieces`` has a row per sequence and piece: seq, top (its depth), t1, t2 (the name there), tops (those
    of all pieces it is in), end (the last depth of the sequence), weight (conversations), and c1, c2, the
    name of the node right below the piece if the sequence stands for such a node.
    """
    cut = F.col("top") + b
    keyed = pieces.withColumn("block", F.shiftright("top", b.bit_length() - 1))
    named = keyed.join(blocks, ["seq", "block"]).select(
        "seq", "top", "t1", "t2", "tops", "end", "weight", "c1", "c2", "words",
        cut.alias("depth"), _xor("t1", "b1").alias("n1"), _xor("t2", "b2").alias("n2"),
    )
    named = stage(named, "named")
    reach = named.filter("end >= depth")
    nodes = reach.groupBy(*_NODE, "top", "t1", "t2", "tops").agg(
        F.min("seq").alias("conv_id"), F.sum("weight").alias("n_convs"), (F.max("end") == F.col("depth")).alias("leaf"), F.max("words").alias("words")
    )
    nodes = stage(nodes, "nodes")
    steps = reach.filter("c1 IS NOT NULL").select(
        F.col("end").alias("from_depth"), F.col("c1").alias("from_1"), F.col("c2").alias("from_2"), *_NODE
    )
    columns = ["seq", "top", "t1", "t2", "tops", "end", "weight", "c1", "c2"]
    upper = nodes.select(
        F.col("conv_id").alias("seq"), "top", "t1", "t2", "tops", F.col("depth").alias("end"), F.col("n_convs").alias("weight"),
        F.col("n1").alias("c1"), F.col("n2").alias("c2"),
    )
    short = named.filter("end < depth").select(*columns)
    lower = named.filter("end > depth").select(
        "seq", F.col("depth").alias("top"), F.col("n1").alias("t1"), F.col("n2").alias("t2"),
        F.array_append("tops", F.struct(*_NODE)).alias("tops"), "end", "weight", "c1", "c2",
    )
    return nodes, upper.unionByName(short).unionByName(lower), steps


def _totals(nodes: DataFrame, rounds: int, steps: dict[int, DataFrame]) -> DataFrame:
    """depth, n1, n2, n_leaves, saved_tokens of every node: sums over its subtree. Staged per round."""
    own = F.struct(*_NODE)
    counted = nodes.select(
        F.explode(F.array_append("tops", own)).alias("at"),
        F.col("leaf").cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    lower = counted.groupBy("at.depth", "at.n1", "at.n2").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    lower = stage(lower, "lower-sums")
    done = lower.filter("depth = 0")
    for j in range(rounds - 1, -1, -1):
        here = lower.filter((F.col("depth") > 0) & (F.col("depth").bitwiseAND(-F.col("depth")) == 1 << j))
        above = steps[j].join(done.withColumnsRenamed(dict(zip(_NODE, ["from_depth", "from_1", "from_2"]))), ["from_depth", "from_1", "from_2"])
        more = above.groupBy(*_NODE).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"))
        totals = here.join(more, _NODE, "left").select(
            *_NODE,
            (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        )
        done = done.unionByName(stage(totals, "totals"))
    return done


# ------------------------------------------------------------------ who ends where


def _digest_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined parts of every node; rows come sorted by node and part."""
    node, digest = None, None
    for batch in batches:
        out = []
        *keys, parts = (batch.column(c).to_pylist() for c in ("depth", "n1", "n2", "part"))
        for key, part in zip(zip(*keys), parts):
            if key != node:
                if digest is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
                digest.update(part.encode())
            else:
                digest.update(b"," + part.encode())
        yield _digest_rows(out)
    if digest is not None:
        yield _digest_rows([(*node, digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [(), (), (), ()]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*_NODE, "ends_sha256"])


def _ends(whole: DataFrame) -> DataFrame:
    """Node and SHA-256 of the decimal ids, ascending, of the conversations that end there.

    Ids are joined in ranges of ``2 ** CHUNK_BITS`` where they are; one task streams over a node's ranges.
    """
    chunk = F.shiftright("conv_id", CHUNK_BITS)  # rounds down, also below zero
    parts = whole.groupBy(*_NODE, chunk.alias("chunk")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    parts = parts.select(*_NODE, "chunk", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("part"))
    partitions = int(whole.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts.repartition(partitions, *_NODE).sortWithinPartitions(*_NODE, "chunk")
    return dealt.mapInArrow(_digest_lists, "depth long, n1 long, n2 long, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """A row per distinct prefix of the sequences of ``turns`` (conv_id, pos, h1, h2, words; ``pos`` from 1 without gaps).

    ``convs`` (conv_id) holds all conversations once, also those without turns. Columns: conv_id, the smallest
    member of the prefix; depth; parent_conv_id, NULL for the root; n_convs; n_children; n_leaves, childless nodes
    in its subtree; saved_tokens, the sum over its subtree of ``(n_convs - 1) * words`` of the last turn;
    ends_sha256, of the comma-joined ids of the members that end there. Without conversations there is no node.
    """

    def build() -> DataFrame:
        elements = turns.select(
            "conv_id", (F.col("pos") - 1).alias("block"), F.xxhash64("pos", "h1").alias("b1"), F.xxhash64("pos", "h2").alias("b2"), "words"
        )
        sums = elements.groupBy("conv_id").agg(F.count("*").alias("depth"), F.bit_xor("b1").alias("n1"), F.bit_xor("b2").alias("n2"))
        zero = F.lit(0).cast("long")
        whole = convs.join(sums, "conv_id", "left").select("conv_id", *[F.coalesce(c, zero).alias(c) for c in _NODE])
        whole = stage(whole, "whole")
        # Copies of a conversation are one sequence.
        distinct = stage(whole.groupBy(*_NODE).agg(F.min("conv_id").alias("seq"), F.count("*").alias("weight")), "distinct")
        rounds = int(distinct.agg(F.max("depth")).first()[0] or 0).bit_length()
        blocks = _block_names(elements.join(distinct.select(F.col("seq").alias("conv_id")), "conv_id", "left_semi").withColumnRenamed("conv_id", "seq"), rounds)
        root = F.struct(zero.alias("depth"), zero.alias("n1"), zero.alias("n2"))
        pieces = distinct.filter("depth > 0").select(
            "seq", zero.alias("top"), zero.alias("t1"), zero.alias("t2"), F.array(root).alias("tops"), F.col("depth").alias("end"), "weight",
            F.lit(None).cast("long").alias("c1"), F.lit(None).cast("long").alias("c2"),
        )
        top = distinct.groupBy().agg(F.min("seq").alias("conv_id"), F.sum("weight").alias("n_convs"), (F.max("depth") == 0).alias("leaf")).filter("conv_id IS NOT NULL")
        nothing = F.lit(None).cast("long")
        nodes = top.select(
            *[zero.alias(c) for c in _NODE], nothing.alias("top"), nothing.alias("t1"), nothing.alias("t2"), F.array().cast("array<struct<depth:bigint,n1:bigint,n2:bigint>>").alias("tops"),
            "conv_id", "n_convs", "leaf", zero.alias("words"),
        )
        steps: dict[int, DataFrame] = {}
        for j in range(rounds - 1, -1, -1):
            found, pieces, steps[j] = _cut(pieces, blocks[j], 1 << j)
            nodes = nodes.unionByName(found)
        nodes = stage(nodes, "all-nodes")
        totals = _totals(nodes, rounds, steps)
        # The parent of an odd depth is the top of its piece of height 2, that of an even depth the cut of such a piece.
        above = ["up_depth", "up_1", "up_2"]
        odd = nodes.filter("depth % 2 = 1").select(*_NODE, F.col("top").alias("up_depth"), F.col("t1").alias("up_1"), F.col("t2").alias("up_2"))
        parents = odd
        if rounds:
            renamed = {**dict(zip(_NODE, above)), **dict(zip(["from_depth", "from_1", "from_2"], _NODE))}
            parents = odd.unionByName(steps[0].withColumnsRenamed(renamed))
        parents = stage(parents, "parents")
        children = parents.groupBy(*[F.col(a).alias(c) for a, c in zip(above, _NODE)]).agg(F.count("*").alias("n_children"))
        inner = stage(children.join(nodes.select(*_NODE, "conv_id"), _NODE).select(*_NODE, "n_children", "conv_id"), "inner-nodes")
        by_parent = inner.select(*[F.col(c).alias(a) for a, c in zip(above, _NODE)], F.col("conv_id").alias("parent_conv_id"))
        parents = parents.join(small(by_parent, by_parent.count()), above).select(*_NODE, "parent_conv_id")
        out = nodes.select(*_NODE, "conv_id", "n_convs").join(totals, _NODE).join(parents, _NODE, "left")
        out = out.join(inner.select(*_NODE, "n_children"), _NODE, "left").join(_ends(whole), _NODE, "left")
        return out.select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )

    return stage_result(turns.sparkSession, "prefix-trie", build)


def conversation_trie(conversations: DataFrame, group: int = FORK) -> DataFrame:
    """:func:`prefix_trie` of ``conversations`` (conv_id, turn, role, text) rebuilt as forks. Other columns are ignored."""

    def build() -> DataFrame:
        return prefix_trie(*forked(ordered_turns(conversations), group))

    return stage_result(conversations.sparkSession, "conversation-trie", build)
