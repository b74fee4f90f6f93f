"""Prefix trie of conversations by truncation peeling.

Every distinct sequence of first d turns is a node.  Nodes are found from the deepest level up:
the conversations that end at a depth join the nodes that survive from the depth below, their
last turn is stripped and what is equal is grouped again.  A group's counts, children, leaves and
saved tokens are added up in the same step that finds it, so each level is touched once.

A turn prefix is known by two 64-bit keys, the running XOR of hashes of (place, role, text), so
texts are hashed where they are read and only numbers move.  Equal conversations are counted
before anything else, so thousands of copies are one row.

Levels are peeled in two ways.  Let `top` be the least depth at which no node has more than
`GROUP` distinct conversations below it.  Below `top` whole subtrees are dealt to buckets and
each bucket peels its levels in numpy.  From `top` up every level is one aggregation by key in
Spark, which combines in the map tasks, so a first turn that a third of all conversations share
is no problem; `top` is as deep as such large groups reach, usually the length of a shared start.

`ends_sha256` is a digest over ids in ascending order, which must be taken one after another.
Ids are sorted over all tasks, joined to strings of many ids there, and only those strings meet
in the task that feeds them to the digest, in bounded memory.

Defined results: a null role or text is empty; turns are ordered by (turn, role, hash of the
text), null turns first, so equal rows are turns of their own; rows without a conv_id belong to
no conversation and are left out; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventgauge.llm.shared import CELLS, stored, told

#: Distinct conversations below a node that is still peeled inside one task.
GROUP = 20_000
#: Distinct conversations a bucket holds on average.
BUCKET = 4_000
#: Turns a rebuilt conversation may take from the head of another one.
HEAD = 6
#: Conversations of one head.
FAMILY = 100
#: Ids joined to one string before they are digested.
IDS = 20_000

NODE = (
    "depth int, k1 long, k2 long, p1 long, p2 long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long"
)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, n (from 1), role hash, text hash and code points of every turn."""
    empty = F.lit("")
    role, text = (F.coalesce(F.col(c).cast("string"), empty) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.xxhash64(text, F.lit(2), role).alias("h2"),
        F.length(text).cast("long").alias("size"),
    ).filter("conv_id is not null")
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "h1", "h2")
    return rows.select("conv_id", F.row_number().over(order).alias("n"), "h1", "h2", "size")


def head_size(conv_id: Column) -> Column:
    """Turns that a conversation takes from the head of its family."""
    return (F.crc32(conv_id.cast("string")) % HEAD).cast("int")


def family(conv_id: Column) -> Column:
    return conv_id - F.pmod(conv_id, F.lit(FAMILY))


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), h1, h2, size: the family's first turns, then the own ones after as many.

    A conversation without any turn has one row of place 0.  Input: `numbered_turns`.
    """
    own = turns.withColumn("head", head_size(F.col("conv_id")))
    heads = turns.filter((F.pmod("conv_id", F.lit(FAMILY)) == 0) & (F.col("n") < HEAD))
    heads = heads.groupBy(F.col("conv_id").alias("family")).agg(
        F.array_sort(F.collect_list(F.struct("n", "h1", "h2", "size"))).alias("turns")
    )
    every = turns.filter("n = 1").select("conv_id").withColumn("family", family(F.col("conv_id")))
    every = every.join(heads, "family", "left").select(
        "conv_id", F.slice(F.coalesce("turns", F.expr("cast(array() as array<struct<n:int,h1:long,h2:long,size:long>>)")), 1, head_size(F.col("conv_id"))).alias("turns")
    )
    taken = every.select("conv_id", F.size("turns").alias("taken"), "turns")
    first = taken.select("conv_id", F.explode("turns").alias("t")).select("conv_id", F.col("t.n").alias("place"), "t.h1", "t.h2", "t.size")
    rest = own.filter(F.col("n") > F.col("head")).join(taken.select("conv_id", "taken"), "conv_id")
    rest = rest.select("conv_id", (F.col("n") - F.col("head") + F.col("taken")).alias("place"), "h1", "h2", "size")
    # The root's row of every conversation, so that one without turns is not lost.
    zero = F.lit(0).cast("long")
    root = every.select("conv_id", F.lit(0).alias("place"), zero.alias("h1"), zero.alias("h2"), zero.alias("size"))
    return first.unionByName(rest).unionByName(root)


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, depth, k1, k2 (keys of the whole sequence), path: (place, k1, k2, size) of every prefix from place 1 on."""
    hashed = turns.select(
        "conv_id", "place", "size",
        F.when(F.col("place") == 0, 0).otherwise(F.xxhash64("place", "h1", "h2")).alias("h1"),
        F.when(F.col("place") == 0, 0).otherwise(F.xxhash64("h2", "place", "h1")).alias("h2"),
    )
    order = Window.partitionBy("conv_id").orderBy("place")
    keyed = hashed.select(
        "conv_id", F.struct("place", F.bit_xor("h1").over(order).alias("k1"), F.bit_xor("h2").over(order).alias("k2"), "size").alias("step")
    )
    whole = keyed.groupBy("conv_id").agg(F.array_sort(F.collect_list("step")).alias("path"))
    last = F.element_at("path", -1)
    return whole.select(
        "conv_id", (F.size("path") - 1).alias("depth"), last["k1"].alias("k1"), last["k2"].alias("k2"),
        F.slice("path", 2, F.size("path")).alias("path"),
    )


def sequences(rows: DataFrame) -> DataFrame:
    """Distinct conversations: depth, k1, k2, path, n (how many), conv_id (the smallest)."""
    grouped = rows.groupBy("depth", "k1", "k2").agg(
        F.first("path").alias("path"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id")
    )
    return grouped.select("depth", "k1", "k2", "path", "n", "conv_id")


def top_depth(distinct: DataFrame, group: int) -> int:
    """The least depth at which no node has more than `group` distinct conversations below it."""
    root = F.array(F.struct(F.lit(0).alias("place"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(0).cast("long").alias("size")))
    nodes = distinct.select(F.explode(F.concat(root, "path")).alias("x")).select("x.place", "x.k1", "x.k2")
    large = nodes.groupBy("place", "k1", "k2").count().filter(F.col("count") > group)
    deepest = large.agg(F.max("place")).first()[0]
    return 0 if deepest is None else deepest + 1


def peeled_below(distinct: DataFrame, top: int, buckets: int) -> DataFrame:
    """All nodes from depth `top` on, level by level from the deepest inside each bucket.

    The parent of a node at `top` is not known yet: its parent_conv_id is null.  `path` is
    that of the nodes at `top`, without their last step, and null for the others.
    """
    at = F.element_at("path", top) if top else F.struct(F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"))
    deep = distinct.filter(F.col("depth") >= top).select(
        F.pmod(F.xxhash64(at["k1"], at["k2"]), F.lit(buckets)).alias("bucket"), "path", "n", "conv_id"
    )

    def work(table: pa.Table) -> pa.Table:
        lists = table.column("path").combine_chunks()
        offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(False))])
        steps = lists.flatten()
        k1, k2, size = (steps.field(c).to_numpy(False) for c in ("k1", "k2", "size"))
        depth = np.diff(offsets)
        n, conv = (table.column(c).to_numpy() for c in ("n", "conv_id"))
        levels, below = [], None
        for d in range(int(depth.max()), top - 1, -1):
            ended = np.flatnonzero(depth == d)
            # The survivors of the level below stand in front; each is named by one of its sequences.
            kids = below["row"] if below is not None else ended[:0]
            row = np.concatenate([kids, ended])
            place = offsets[row] + d - 1
            if d:
                _, head, group = np.unique(np.rec.fromarrays([k1[place], k2[place]]), return_index=True, return_inverse=True)
            else:
                head, group = np.zeros(1, np.int64), np.zeros(len(row), np.int64)
            count = len(head)
            members = np.concatenate([below["n"], n[ended]]) if below is not None else n[ended]
            least = np.full(count, np.iinfo(np.int64).max)
            np.minimum.at(least, group, np.concatenate([below["conv"], conv[ended]]) if below is not None else conv[ended])
            level = {"row": row[head], "n": np.zeros(count, np.int64), "conv": least}
            np.add.at(level["n"], group, members)
            above = group[: len(kids)]
            level["children"] = np.bincount(above, minlength=count)
            leaves, saved = np.zeros(count, np.int64), np.zeros(count, np.int64)
            if below is not None:
                np.add.at(leaves, above, below["leaves"])
                np.add.at(saved, above, below["saved"])
                below["parent"] = least[above]
            level["leaves"] = np.where(level["children"] == 0, 1, leaves)
            own = size[offsets[level["row"]] + d - 1] if d else 0
            level["saved"] = saved + (level["n"] - 1) * own
            level["depth"] = d
            levels.append(level)
            below = level
        out = []
        for level in levels:
            d, row = level["depth"], level["row"]
            mine, parent = offsets[row] + d - 1, offsets[row] + d - 2
            zero = np.zeros(len(row), np.int64)
            keys = [k1[mine], k2[mine]] if d else [zero, zero]
            keys += [k1[parent], k2[parent]] if d > 1 else [zero, zero]
            columns = [pa.array(np.full(len(row), d, np.int32)), *map(pa.array, keys), pa.array(level["conv"])]
            columns.append(pa.array(level["parent"]) if "parent" in level else pa.nulls(len(row), pa.int64()))
            columns += [pa.array(level[c]) for c in ("n", "children", "leaves", "saved")]
            if d == top and d > 1:
                kept = np.arange(offsets[-1])
                ranges = [kept[offsets[r] : offsets[r] + d - 1] for r in row.tolist()]
                flat = np.concatenate(ranges)
                ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ranges])]), pa.int32())
                columns.append(pa.ListArray.from_arrays(ends, steps.take(pa.array(flat))))
            else:
                columns.append(pa.nulls(len(row), lists.type))
            out.append(pa.Table.from_arrays(columns, [*[c.split()[0] for c in NODE.split(", ")], "path"]))
        return pa.concat_tables(out)

    kind = distinct.schema["path"].dataType.simpleString()
    return deep.groupBy("bucket").applyInArrow(work, f"{NODE}, path {kind}")


def level_above(below: DataFrame, ended: DataFrame, depth: int) -> DataFrame:
    """The nodes of one depth from those one deeper and the sequences that end here.

    Both have k1, k2 of this depth; `path` ends with the step of this depth.
    """
    zero = F.lit(0).cast("long")
    kids = below.select(
        F.col("p1").alias("k1"), F.col("p2").alias("k2"), "path", "conv_id", F.col("n_convs").alias("n"),
        F.lit(1).cast("long").alias("child"), "n_leaves", "saved_tokens",
    )
    new = ended.select("k1", "k2", "path", "conv_id", "n", zero.alias("child"), zero.alias("n_leaves"), zero.alias("saved_tokens"))
    grouped = kids.unionByName(new).groupBy("k1", "k2").agg(
        F.first("path").alias("path"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"),
        F.sum("child").alias("n_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"),
    )
    own = F.element_at("path", depth)["size"] if depth else F.lit(0)
    parent = [F.element_at("path", depth - 1)[c] if depth > 1 else zero for c in ("k1", "k2")]
    return grouped.select(
        F.lit(depth).alias("depth"), "k1", "k2", parent[0].alias("p1"), parent[1].alias("p2"), "conv_id",
        F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * own).cast("long").alias("saved_tokens"),
        (F.slice("path", 1, depth - 1) if depth > 1 else F.slice("path", 1, 0)).alias("path"),
    )


def parents_told(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Nodes of one depth with the smallest member of their parents, which are `above`.

    A parent of very many children is dealt by cells of the children's keys.
    """
    rows = nodes.drop("parent_conv_id").withColumn("cell", F.pmod("k1", F.lit(CELLS)).cast("int"))
    rows = rows.withColumn("parent", F.struct("p1", "p2"))
    facts = above.select(F.struct(F.col("k1").alias("p1"), F.col("k2").alias("p2")).alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return told(rows, facts, "parent")


def nodes(distinct: DataFrame, group: int = GROUP, bucket: int = BUCKET) -> DataFrame:
    """depth, k1, k2, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens of every node.

    `distinct` is read several times and should be stored.
    """
    top = top_depth(distinct, group)
    buckets = distinct.count() // bucket + 1
    below = stored(peeled_below(distinct, top, buckets), "trie")
    columns = [c.split()[0] for c in NODE.split(", ")]
    found = [below.filter(F.col("depth") > top)]
    lowest = below.filter(F.col("depth") == top)
    for depth in range(top - 1, -1, -1):
        ended = distinct.filter(F.col("depth") == depth)
        above = stored(level_above(lowest, ended, depth), f"trie-{depth}")
        found.append(parents_told(lowest, above))
        lowest = above
    found.append(lowest)
    return reduce(DataFrame.unionByName, [f.select(columns) for f in found])


def end_digests(ends: DataFrame) -> DataFrame:
    """k1, k2, depth, ends_sha256 of the conversations that end at a node; input: depth, k1, k2, conv_id."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth, k1, k2, conv = (batch.column(c).to_numpy() for c in ("depth", "k1", "k2", "conv_id"))
            if not len(conv):
                continue
            new = np.ones(len(conv), bool)
            new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (depth[1:] != depth[:-1])
            starts = np.flatnonzero(new)
            inside = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv))))
            starts = np.flatnonzero(inside % IDS == 0)
            said = [",".join(map(str, x.tolist())) for x in np.split(conv, starts[1:])]
            columns = [pa.array(x[starts]) for x in (depth, k1, k2, conv)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(said)], ["depth", "k1", "k2", "first", "ids"])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, current, digest = ["depth", "k1", "k2", "ends_sha256"], None, None

        def made(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

        for batch in batches:
            done = []
            for depth, k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "k1", "k2", "ids")), strict=True):
                if (depth, k1, k2) == current:
                    digest.update(b"," + ids.encode())
                    continue
                if current is not None:
                    done.append((*current, digest.hexdigest()))
                current, digest = (depth, k1, k2), hashlib.sha256(ids.encode())
            yield made(done)
        if current is not None:
            yield made([(*current, digest.hexdigest())])

    ordered = ends.repartitionByRange("depth", "k1", "k2", "conv_id").sortWithinPartitions("depth", "k1", "k2", "conv_id")
    strings = ordered.mapInArrow(joined, "depth int, k1 long, k2 long, first long, ids string")
    strings = strings.repartition("depth", "k1", "k2").sortWithinPartitions("depth", "k1", "k2", "first")
    return strings.drop("first").mapInArrow(digested, "depth int, k1 long, k2 long, ends_sha256 string")


def trie(conversations: DataFrame, group: int = GROUP, bucket: int = BUCKET) -> DataFrame:
    """One row for every node of the trie of rebuilt conversations."""
    turns = stored(numbered_turns(conversations), "turns")
    rows = stored(paths(rebuilt(turns)), "paths")
    found = nodes(stored(sequences(rows), "sequences"), group, bucket)
    ends = end_digests(rows.select("depth", "k1", "k2", "conv_id"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    joined = found.join(ends, ["depth", "k1", "k2"], "left")
    return joined.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )


#: The same by plain counting: every number below is a sum over the turns of the members.
SQL = """
with turns as (
    select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as n,
           sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as h, length(coalesce(text, '')) as size
    from conversations where conv_id is not null
), ids as (
    select c, c - ((c % 100) + 100) % 100 as f,
           list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(c::varchar, ''), lambda x: ascii(x)::ubigint)),
             lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)::ubigint[]),
               lambda r, i: xor(r >> 1, (r & 1) * 3988292384::ubigint))) as crc
    from (select distinct c from turns)
), heads as (
    select c, f, xor(crc, 4294967295::ubigint) % 6 as h from ids
), rebuilt as (
    select i.c, t.n as place, t.h, t.size from heads i join turns t on t.c = i.f and t.n <= i.h
    union all
    select i.c, t.n - i.h + (select count(*) from turns b where b.c = i.f and b.n <= i.h) as place, t.h, t.size
    from heads i join turns t on t.c = i.c and t.n > i.h
    union all
    select c, 0, '', 0 from ids
), keyed as (
    select c, place as d, size, sha256(string_agg(h, '/') over (partition by c order by place)) as k,
           max(place) over (partition by c) as last
    from rebuilt
), grouped as (
    select d, k, min(c) as conv_id, count(*) as n_convs, max(last) as far,
           coalesce(string_agg(case when last = d then c::varchar end, ',' order by c), '') as ends
    from keyed group by d, k
), marked as (
    select x.c, x.d, x.k, g.conv_id,
           case when g.conv_id = x.c then (g.n_convs - 1) * x.size else 0 end as saved,
           case when g.conv_id = x.c and g.far = x.d then 1 else 0 end as leaf,
           lag(x.k) over (partition by x.c order by x.d) as up
    from keyed x join grouped g on g.d = x.d and g.k = x.k
), summed as (
    select d, k, up, sum(saved) over w as saved, sum(leaf) over w as leaves from marked window w as (partition by c order by d desc)
), totals as (
    select d, k, any_value(up) as up, sum(saved)::bigint as saved_tokens, sum(leaves)::bigint as n_leaves from summed group by d, k
)
select g.conv_id, g.d::bigint as depth, p.conv_id as parent_conv_id, g.n_convs,
       (select count(*) from totals c where c.d = g.d + 1 and c.up = g.k) as n_children,
       t.n_leaves, t.saved_tokens, sha256(g.ends) as ends_sha256
from grouped g join totals t on t.d = g.d and t.k = g.k left join grouped p on p.d = g.d - 1 and p.k = t.up
"""
