import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from tandem.llm.prefix_trie import conversation_trie, ordered_turns, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, h1 string"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def rebuild(rows, group=20):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(sequences):
    members, ends = {}, {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    totals = {}
    for prefix in sorted(members, key=len, reverse=True):
        below = [totals[p] for p in children.get(prefix, [])]
        saved = (len(members[prefix]) - 1) * words(prefix[-1][1]) if prefix else 0
        totals[prefix] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), *totals[p],
            hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def check(spark, rows):
    table = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA).repartition(3)
    got = conversation_trie(table)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[1])) == brute(rebuild(rows))


def test_shared_prefixes_of_all_depths(spark):
    rng, rows = random.Random(5), []
    for c in range(70):
        for turn in range(rng.choice([1, 2, 3, 5, 8, 9, 16, 17])):
            rows.append((c, turn, "user" if turn % 2 else "assistant", f"say {rng.choice('ab')} {'x ' * (turn % 3)}"))
    check(spark, rows)


def test_a_chain_and_copies(spark):
    """One long conversation, its prefixes as conversations, and many copies of one."""
    rows = [(0, t, "user", f"turn {t}") for t in range(45)]
    rows += [(20 * c, t, "user", f"turn {t}") for c in range(1, 40) for t in range(c)]
    rows += [(1_000 + c, t, "user", f"copy {t}") for c in range(90) for t in range(6)]
    check(spark, rows)


def test_odd_rows(spark):
    check(spark, [])
    rows = [
        (-7, None, None, None), (-7, 3, "user", "a b"), (-7, 3, "user", "a a"), (-7, 3, "user", "a b"), (-40, 0, "", ""), (-47, 1, "user", "x" * 100_000),
        (None, 0, "user", "no conversation"), (2**62, None, "user", None), (2**62, -5, "user", "b"), (5, 0, "user", "only turn"), (6, 0, "user", "only turn"),
        (25, 0, "userx", "y"), (26, 0, "user", "xy"), (16_384, 0, "user", "z"), (16_383, 0, "user", "z"), (-1, 0, "user", "z"), (-16_385, 0, "user", "z"),
    ]
    check(spark, rows)
    check(spark, [(c, 0, "user", "one") for c in range(100, 121)])


def test_a_conversation_that_runs_through_many_tasks(spark):
    """Two thirds of all rows are one conversation: its places are counted over all tasks."""
    rows = [(3, t, "user", f"t{t % 5}") for t in range(3_000)] + [(c, 0, "user", "x") for c in range(100, 1_600)]
    random.Random(1).shuffle(rows)
    turns = ordered_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert turns.groupBy("conv_id").agg(F.max("pos").alias("m"), F.count_distinct("pos").alias("d"), F.count("*").alias("n")).filter("m <> n OR d <> n").isEmpty()
    order = [r.h1 for r in turns.filter("conv_id = 3").orderBy("pos").collect()]
    assert len(set(order)) == 5 and order == order[:5] * 600


def test_turnless_conversations_are_members_of_the_root(spark):
    convs = spark.range(4).withColumnRenamed("id", "conv_id")
    turns = spark.createDataFrame([], "conv_id long, pos long, h1 long, h2 long, words long")
    row = prefix_trie(convs, turns).collect()
    assert [tuple(r) for r in row] == [(0, 0, None, 4, 0, 1, 0, hashlib.sha256(b"0,1,2,3").hexdigest())]


def test_query_against_plain_python(spark, sf_dir):
    from tandem.llm.queries import op12_prefix_trie

    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, op12_prefix_trie(spark, sf_dir).collect()), key=lambda r: (r[0], r[1])) == brute(rebuild(rows))
