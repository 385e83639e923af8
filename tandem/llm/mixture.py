"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Targets are found on one row per source. A source whose share exceeds ``max_epochs`` times its size
is clamped there, and the excess is dealt to the others by weight until none is above.

A source's factor is target over size: its documents are repeated the whole part of it, and some
once more. Which ones is decided in *lanes*, random sets of about ``lane_docs`` documents of one
source, so that a hot source is many lanes. Rows of one id and text are one document with a
multiplicity. A lane goes through its documents from the largest to the smallest and carries what is
still due: a document is taken once more when that passes a seeded random part of its size. What is
still due at the end is settled exactly: of all ways of taking the lane's smallest documents, each
up to ``max_epochs`` times, the one that leaves least due is found through the sums they can reach.
Every document of a source can be drawn, and the result depends on the rows alone, not on where they lie.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tandem.llm.common import numbered, small
from tandem.session import stage, stage_result

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_EPOCHS = 2.0
LANE_DOCS = 1_000
SEED = 20
POOL = 40
SUM_BITS = 1 << 22

_WORD = r"[^\x20\x09-\x0D]+"


def text_size(text: str | Column) -> Column:
    """Number of words between blanks; 0 for NULL."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """source, source_size, docs, target of every source of ``sized`` (source, size).

    Weights go round over the sources by code point, NULL last. Only a row per source is brought
    together. In the order of cap over weight, the sources that stop at their cap come first: the ones
    whose cap is below their share of what earlier ones leave.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ranked = stage(sums.select("*", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).alias("weight")), "sources")
    cap = F.col("source_size") * F.lit(max_epochs)
    order = W.orderBy(cap / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(0, W.unboundedFollowing)
    left = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    # What a unit of weight gets if a source and all later ones stop at no cap: it rises as long as the sources before it should.
    unit = ranked.filter("weight > 0").select(((F.lit(left) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(rest)).alias("unit")).agg(F.max("unit")).first()[0]
    even = cap if unit is None else F.least(F.col("weight") * F.lit(float(unit)), cap)
    return ranked.select("source", "source_size", "docs", F.when(F.col("weight") > 0, even).otherwise(0.0).alias("target"))


def _identity() -> Column:
    """One value per document: its id, source and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))


def _decided(sized: DataFrame, weights, share, max_epochs, seed: int, lane_docs: int) -> DataFrame:
    """what, doc_id, source, size, source_size, target, rows, repeats of every document. Staged.

    ``repeats`` is what all of the ``rows`` rows of a document are taken together.
    """
    sources = stage(source_targets(sized, weights, share, max_epochs), "targets")
    items = sized.groupBy("what", "doc_id", "source", "size").agg(F.count("*").alias("rows"))
    with_target = items.alias("d").join(small(sources, sources.count()).alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")), "left")
    lanes = F.ceil(F.col("docs") / F.lit(lane_docs))
    mark = F.pmod(F.xxhash64(F.lit(seed + 1), "what"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    laned = with_target.select(
        "what", "d.doc_id", "d.source", "size", "source_size", "target", "rows", F.pmod(F.xxhash64(F.lit(seed), "what"), lanes).alias("lane"), mark.alias("u")
    )
    most = int(np.ceil(max_epochs))

    def take(group: pa.Table) -> pa.Table:
        return group.append_column("repeats", pa.array(lane_repeats(group, most), pa.int64()))

    schema = "what long, doc_id long, source string, size long, source_size long, target double, rows long, lane long, u double, repeats long"
    return stage(laned.groupBy("source", "lane").applyInArrow(take, schema).drop("lane", "u"), "documents-of-the-mix")


def _share(number: str | Column) -> Column:
    """What the row of this number takes of its document's repeats: the first ones may take one more."""
    number = F.col(number) if isinstance(number, str) else number
    return (F.floor(F.col("repeats") / F.col("rows")) + F.when(number < F.col("repeats") % F.col("rows"), 1).otherwise(0)).cast("long")


def _per_row(rows: DataFrame, items: DataFrame, columns: list[str]) -> DataFrame:
    """``rows``, which have ``what``, with ``columns`` of their document and ``times``, the row's own repeats.

    Only rows of documents whose rows are not all taken alike are numbered.
    """
    even = items.filter("repeats % rows = 0").select("what", "repeats", "rows", *columns)
    uneven = stage(items.filter("repeats % rows <> 0").select("what", "repeats", "rows", *columns), "uneven")
    out = rows.join(even, "what").withColumn("times", _share(F.lit(0)))
    count = uneven.count()
    if not count:
        return out
    held = numbered(rows.join(small(uneven.select("what"), count), "what", "left_semi"), ["what"], "__number")
    return out.unionByName(held.join(small(uneven, count), "what").withColumn("times", _share("__number")).drop("__number"))


def _sized(docs: DataFrame) -> DataFrame:
    columns = [_identity().alias("what"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text_size("text").alias("size")]
    return stage(docs.select(*columns), "sized")


def sample_repetitions(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS, seed: int = SEED, lane_docs: int = LANE_DOCS) -> DataFrame:
    """doc_id, source, size, source_size, target, repeats and taken of every row.

    NULL text has size 0 and is repeated like the rest of its source. Rows of one id, source and text
    count as often as they stand there; if only some are repeated, which of them does not matter.
    Rows without an id are drawn like others. Other columns are ignored.
    """

    def build() -> DataFrame:
        sized = _sized(docs)
        items = _decided(sized, weights, share, max_epochs, seed, lane_docs)
        # A document of one row is its own row; the others are dealt to their rows.
        single = items.filter("rows = 1").withColumnRenamed("repeats", "times")
        several = _per_row(sized, items.filter("rows > 1"), ["source_size", "target"])
        columns = ["doc_id", "source", "size", "source_size", "target", F.col("times").alias("repeats"), (F.col("size") * F.col("times")).alias("taken")]
        return single.select(*columns).unionByName(several.select(*columns))

    return stage_result(docs.sparkSession, "mixture", build)


def lane_repeats(group: pa.Table, most: int = 2) -> list[int]:
    """How often every document of a lane is taken, over all its rows, in the order of the rows of ``group``."""
    sizes, counts, marks, names = (group.column(c).to_pylist() for c in ("size", "rows", "u", "what"))
    total, target = group.column("source_size")[0].as_py(), group.column("target")[0].as_py()
    factor = target / total if total else 0.0
    whole, part = int(factor), factor - int(factor)
    repeats, due = [whole * n for n in counts], 0.0
    # In an order of their own, so that it does not matter how the rows arrive.
    order = sorted(range(len(sizes)), key=lambda r: (-sizes[r], marks[r], names[r]))
    for row in order:
        size, count = sizes[row], counts[row]
        due += part * size * count
        if part and size and due >= marks[row] * size:
            once_more = min(count, 1 + int((due - marks[row] * size) // size))
            repeats[row] += once_more
            due -= size * once_more
    pool = [row for row in reversed(order) if sizes[row]][:POOL]
    if abs(due) >= 0.5 and pool:
        settle(sizes, counts, repeats, pool, due, most)
    return repeats


def settle(sizes: list[int], counts: list[int], repeats: list[int], pool: list[int], due: float, most: int) -> None:
    """Take the documents of ``pool`` so that least is due, each row up to ``most`` times.

    The sums that the first documents can reach are the set bits of an integer. Multiples of a document are
    shifts by its size times 1, 2, 4 …, and the way to the best sum is read off backwards. Sums beyond
    ``SUM_BITS`` are counted in units of more than a word.
    """
    reach = sum(sizes[row] * counts[row] * most for row in pool)
    unit = max(1, -(-reach // SUM_BITS))
    wanted = (sum(sizes[row] * repeats[row] for row in pool) + due) / unit
    steps: list[tuple[int, int]] = []
    for row in pool:
        left, times = counts[row] * most, 1
        while left:
            times = min(times, left)
            steps.append((row, times))
            left, times = left - times, times * 2
    sums = [1]
    for row, times in steps:
        sums.append(sums[-1] | sums[-1] << round(sizes[row] * times / unit))
    below = (sums[-1] & (1 << int(wanted) + 1) - 1).bit_length() - 1 if wanted >= 0 else 0
    above = sums[-1] >> int(wanted) + 1 if wanted >= 0 else 0
    best = below
    if above:
        upper = int(wanted) + 1 + (above & -above).bit_length() - 1
        best = upper if upper - wanted < wanted - below else below
    if unit == 1 and abs(best - wanted) >= abs(due):
        return
    for row in pool:
        repeats[row] = 0
    for (row, times), earlier in zip(reversed(steps), reversed(sums[:-1])):
        shift = round(sizes[row] * times / unit)
        if not earlier >> best & 1:
            repeats[row] += times
            best -= shift


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; columns stay as they are.

    Rows of one id, source and text are dealt its repetitions as evenly as they go.
    """

    def build() -> DataFrame:
        decided = _decided(_sized(docs), weights, share, max_epochs, seed, LANE_DOCS)
        return decided.filter("repeats > 0").select(F.col("what").alias("__what"), "rows", "repeats")

    items = stage_result(docs.sparkSession, "repetitions", build).withColumnRenamed("__what", "what")
    renamed = {c: f"__c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(_identity().alias("what"), *[F.col(f"`{c}`").alias(alias) for c, alias in renamed.items()])
    # A row of an uneven document may take nothing.
    dealt = _per_row(rows, items, []).withColumn("__n", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))))
    return dealt.select(*[F.col(alias).alias(c) for c, alias in renamed.items()])
