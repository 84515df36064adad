"""Prefix trie of conversations by the Euler-tour technique.

Every distinct sequence of first turns is a node. A conversation's prefixes are
named by the exclusive-or of 128 hash bits of each (place, turn), a running
aggregate, so nodes are found by grouping rows, whatever a conversation's length.
Each node has an enter and an exit arc; an arc's successor is a column of its
node's row (first child, next sibling, parent). The tour, a linked list over all
arcs, is ranked in rounds of list contraction:

* arcs are dealt to blocks of bounded size by conversation and depth; a block
  follows the links inside it, and only its last arcs remain in the list;
* of a long list a hashed share of arcs is chosen, links are doubled until each
  points to a chosen one, and the chosen ones make the next, shorter list;
* a list of at most ``BASE`` arcs is ranked in one block, and ranks are carried
  back through the rounds.

With arcs at their positions, leaves and savings are summed up once along the
tour, and a node's subtree is the difference between its exit and its enter arc.
Rows are numbered by ranges (:func:`common.number`), not gathered by
conversation or parent, so a conversation, a parent or a group of copies that
holds a third of all rows is split like any others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Shared, number

#: Arcs that one block of a list contraction holds on average; consecutive depths of a conversation that stay together.
BLOCK, RUN = 65_536, 512
#: One arc in so many is chosen in a round of contraction; a list of at most BASE arcs is ranked in one block.
CHOSEN, BASE = 64, 65_536
#: A running sum covers 2 ** SPAN_BITS rows before sums are carried on.
SPAN_BITS = 16
#: At most 2 ** PIECE_BITS ids are joined into one piece of a digest's input.
PIECE_BITS = 8


# ---------------------------------------------------------------- running aggregates over numbered rows


def running(df: DataFrame, at: str, group: list[str], values: dict[str, Column], total, shared: Shared, name: str) -> DataFrame:
    """``df`` with the running ``total`` (sum or bit_xor) of ``values`` up to each row, in the order of ``at`` within ``group``.

    ``at`` numbers all rows without gaps and keeps a group's rows together. Each
    span of rows is summed up by itself, and of a group that goes on over spans
    one row a span carries the total on.
    """
    inside = Window.partitionBy("__span", *group).orderBy(at)
    spanned = df.withColumn("__span", F.shiftright(F.col(at), SPAN_BITS))
    part = shared.save(spanned.withColumns({c: total(v).over(inside) for c, v in values.items()}), name)
    # only the group of a span's last row can go on, and its total is that row's
    ends = part.where(F.shiftright(F.col(at) + 1, SPAN_BITS) > F.col("__span"))
    along = Window.partitionBy(*group).orderBy("__span")
    carry = shared.save(ends.select((F.col("__span") + 1).alias("__span"), *group, *[total(c).over(along).alias(f"__{c}") for c in values]), f"{name}-carry")
    join = F.lit(True)
    right = carry.withColumnsRenamed({c: f"__{c}" for c in ("__span", *group)})
    for c in ("__span", *group):
        join = join & (part[c] == right[f"__{c}"])
    add = (lambda a, b: a.bitwiseXOR(b)) if total is F.bit_xor else (lambda a, b: a + b)
    return part.join(right, join, "left").select(*[part[c] for c in df.columns], *[add(part[c], F.coalesce(right[f"__{c}"], F.lit(0))).alias(c) for c in values])


# ---------------------------------------------------------------- list ranking


def _follow(c: np.ndarray, k: np.ndarray, nc: np.ndarray, nk: np.ndarray, hops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each arc (c, k) of a block: the last arc that links inside the block lead to, and the way there in hops.

    ``hops`` is the length of an arc's own link, at the end of the list (nk = -1)
    what is left to its true end. Pointer doubling over positions.
    """
    n = len(c)
    # arcs and targets are coded together, so that equal names get equal codes
    both = np.concatenate([c, nc]), np.concatenate([k, nk])
    rank = np.lexsort((both[1], both[0]))
    new = np.ones(2 * n, bool)
    new[1:] = (both[0][rank][1:] != both[0][rank][:-1]) | (both[1][rank][1:] != both[1][rank][:-1])
    code = np.empty(2 * n, np.int64)
    code[rank] = np.cumsum(new) - 1
    holder = np.full(2 * n + 1, -1, np.int64)
    holder[code[:n]] = np.arange(n)
    to = holder[code[n:]]
    to[nk < 0] = -1
    end = to < 0
    at, way = np.where(end, np.arange(n), to), np.where(end, 0, hops)
    while True:
        step = at[at]
        if (step == at).all():
            return at, way + np.where(nk[at] < 0, hops[at], 0)
        way = way + np.where(step != at, way[at], 0)
        at = step


_ARC = "c long, k long, nc long, nk long, hops long"


def _contract(arcs: DataFrame, block: Column, shared: Shared, name: str) -> DataFrame:
    """``arcs`` with (rc, rk, way): the last arc that links within its block lead to."""

    def of(table: pa.Table) -> pa.Table:
        c, k, nc, nk, hops = (table.column(x).to_numpy() for x in ("c", "k", "nc", "nk", "hops"))
        at, way = _follow(c, k, nc, nk, hops)
        cols = {"c": c, "k": k, "nc": nc, "nk": nk, "hops": hops, "rc": c[at], "rk": k[at], "way": way}
        return pa.table({x: pa.array(np.asarray(v, np.int64)) for x, v in cols.items()})

    return shared.save(arcs.withColumn("block", block).groupBy("block").applyInArrow(of, f"{_ARC}, rc long, rk long, way long"), name)


def _double(arcs: DataFrame, level: int, shared: Shared) -> DataFrame:
    """``arcs`` with (rc, rk, way): the next chosen arc after each, and the way there. The last arc has none: nk = -1."""
    chosen = lambda c, k: F.pmod(F.xxhash64(F.lit(level), c, k), F.lit(CHOSEN)) == 0
    links = arcs.select("c", "k", F.col("nc").alias("rc"), F.col("nk").alias("rk"), F.col("hops").alias("way"), ((F.col("nk") < 0) | chosen("nc", "nk")).alias("done"))
    while True:
        links = shared.save(links, "doubled")
        if links.where("not done").isEmpty():
            return links.drop("done")
        to = links.select(F.col("c").alias("rc"), F.col("k").alias("rk"), F.col("rc").alias("tc"), F.col("rk").alias("tk"), F.col("way").alias("more"), F.col("done").alias("there"))
        went = links.where("not done").join(to, ["rc", "rk"]).select("c", "k", F.col("tc").alias("rc"), F.col("tk").alias("rk"), (F.col("way") + F.col("more")).alias("way"), F.col("there").alias("done"))
        links = links.where("done").unionByName(went)


def rank(arcs: DataFrame, shared: Shared, level: int = 0) -> DataFrame:
    """(c, k, after): for each arc of the list ``arcs(c, k, nc, nk, hops)`` the hops from it to the last one.

    An arc is named by (c, k), its successor by (nc, nk), ``hops`` away; nk = -1
    ends the list, and ``hops`` is then 0.
    """
    n = arcs.count()
    if n <= BASE:
        whole = _contract(arcs, F.lit(0), shared, f"base-{level}")
        return whole.select("c", "k", F.col("way").alias("after"))
    if level == 0:  # blocks by conversation and depth
        blocks = max(1, -(-n // BLOCK))
        parts = _contract(arcs, F.pmod(F.xxhash64("c", (F.col("k") / (2 * RUN)).cast("long")), F.lit(blocks)), shared, "blocks")
        last = parts.where("c = rc and k = rk")
        onto = parts.select(F.col("c").alias("nc"), F.col("k").alias("nk"), F.col("rc").alias("tc"), F.col("rk").alias("tk"), F.col("way").alias("more"))
        short = last.select("c", "k", "nc", "nk", "hops").join(onto, ["nc", "nk"], "left")
        short = short.select("c", "k", F.coalesce("tc", F.lit(-1)).alias("nc"), F.coalesce("tk", F.lit(-1)).alias("nk"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"))
    else:
        parts = _double(arcs, level, shared)
        # a chosen arc, and the head of the list, are the next list; a head that is not chosen is ranked through its link
        short = parts.where(F.pmod(F.xxhash64(F.lit(level), "c", "k"), F.lit(CHOSEN)) == 0).select("c", "k", F.col("rc").alias("nc"), F.col("rk").alias("nk"), F.col("way").alias("hops"))
    short = shared.save(short, f"short-{level}")
    ranked = rank(short, shared, level + 1).select(F.col("c").alias("rc"), F.col("k").alias("rk"), "after")
    joined = parts.join(ranked, ["rc", "rk"], "left")
    return shared.save(joined.select("c", "k", (F.col("way") + F.coalesce("after", F.lit(0))).alias("after")), f"ranked-{level}")


# ---------------------------------------------------------------- conversations


def turns(df: DataFrame, conv: str, turn: str, role: str, text: str, shared: Shared) -> DataFrame:
    """(conv_id, pos, x, y, chars): every turn with its place from 1 in its conversation; x and y are 128 bits of role and text."""
    role_, text_ = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    said = F.md5(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_).cast("binary"))
    half = lambda at: F.conv(F.substring(said, at, 15), 16, 10).cast("long")
    rows = df.select(F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), half(1).alias("x"), half(17).alias("y"), F.length(text_).cast("long").alias("chars"), role_.alias("r"))
    tie = [F.col("r"), F.col("x"), F.col("y")]
    return number(rows.where("conv_id is not null"), [F.col("conv_id"), F.col("turn").asc_nulls_first(), *tie], shared, "turns").drop("r", "turn")


def rebuilt(said: DataFrame, shared: Shared, group: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """(conversations, prefixes) after every conversation has taken the first turns of the first one of its group.

    ``conversations(conv_id, length)``; ``prefixes(conv_id, depth, x, y, px, py, chars)``, where (x, y) names the
    first ``depth`` turns, (px, py) those without the last, and ``chars`` is the last one's.
    """
    c = F.col("conv_id")
    sizes = said.groupBy("conv_id").agg(F.count("*").alias("own"), F.min("n").alias("first"))
    convs = shared.save(sizes.withColumn("h", F.crc32(c.cast("string").cast("binary")) % heads).withColumn("base", c - c % group), "conversations")
    of_base = convs.select(F.col("conv_id").alias("base"), F.least(F.col("own"), F.lit(heads - 1)).alias("has"))
    convs = shared.save(
        convs.join(of_base, "base", "left").withColumn("taken", F.least("h", F.coalesce("has", F.lit(0)))).select("conv_id", "own", "first", "h", "base", "taken", (F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("length")),
        "rebuilt",
    )
    # the first turns of the groups' first conversations: fewer than ``heads`` rows each, for at most 2 * ``group`` ids
    lead = said.join(convs.where(c == F.col("base")).select("conv_id", "first"), "conv_id").withColumn("depth", F.col("n") - F.col("first") + 1).where(F.col("depth") < heads)
    lead = lead.select(c.alias("base"), "depth", "x", "y", "chars")
    name = lambda depth, seed: F.xxhash64(F.lit(seed), depth, F.col("x"), F.col("y"))
    head = convs.where("taken > 0").select("conv_id", "base", "taken").join(lead, "base").where("depth <= taken")
    along = Window.partitionBy("conv_id").orderBy("depth")
    head = head.withColumns({"tx": name(F.col("depth"), 1), "ty": name(F.col("depth"), 2)})
    head = shared.save(head.select("conv_id", "depth", "taken", F.bit_xor("tx").over(along).alias("x"), F.bit_xor("ty").over(along).alias("y"), "tx", "ty", "chars"), "heads")
    start = head.where("depth = taken").select("conv_id", F.col("x").alias("sx"), F.col("y").alias("sy"))
    moved = convs.join(start, "conv_id", "left").select("conv_id", "first", "h", "taken", F.coalesce("sx", F.lit(0)).alias("sx"), F.coalesce("sy", F.lit(0)).alias("sy"))
    own = said.join(moved, "conv_id").withColumn("depth", F.col("n") - F.col("first") + 1 - F.col("h") + F.col("taken"))
    mine = F.col("n") - F.col("first") >= F.col("h")
    own = own.withColumns({"tx": F.when(mine, name(F.col("depth"), 1)).otherwise(0), "ty": F.when(mine, name(F.col("depth"), 2)).otherwise(0), "mine": mine})
    own = running(own.select("n", "conv_id", "depth", "chars", "sx", "sy", "tx", "ty", "mine"), "n", ["conv_id"], {"rx": F.col("tx"), "ry": F.col("ty")}, F.bit_xor, shared, "names")
    own = own.where("mine").select("conv_id", "depth", F.col("sx").bitwiseXOR(F.col("rx")).alias("x"), F.col("sy").bitwiseXOR(F.col("ry")).alias("y"), "tx", "ty", "chars")
    every = head.drop("taken").unionByName(own)
    return convs.select("conv_id", "length"), every.select("conv_id", "depth", "x", "y", F.col("x").bitwiseXOR(F.col("tx")).alias("px"), F.col("y").bitwiseXOR(F.col("ty")).alias("py"), "chars")


def nodes_of(convs: DataFrame, prefixes: DataFrame, shared: Shared) -> DataFrame:
    """(conv_id, depth, x, y, px, py, n_convs, gain): a row a node; the root has depth 0. (conv_id, depth) names a node as well."""
    deep = prefixes.groupBy("depth", "x", "y").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("px").alias("px"), F.max("py").alias("py"), F.max("chars").alias("chars"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("x"), zero.alias("y"), "conv_id", "n_convs", F.lit(None).cast("long").alias("px"), F.lit(None).cast("long").alias("py"), zero.alias("chars"))
    return shared.save(deep.unionByName(root).select("conv_id", F.col("depth").cast("long").alias("depth"), "x", "y", "px", "py", "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("gain")), "nodes")


def tour(nodes: DataFrame, shared: Shared) -> tuple[DataFrame, DataFrame]:
    """(``nodes`` with parent and number of children, arcs of their Euler tour as :func:`rank` takes them).

    Enter arcs have k = 2 * depth, exit arcs k = 2 * depth + 1. Children follow in
    the order of their ``conv_id``, which is their smallest member.
    """
    named = nodes.select(F.col("conv_id").alias("parent"), (F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"))
    below = nodes.where("depth > 0").join(named, ["depth", "px", "py"])
    placed = shared.save(number(below.select("conv_id", "depth", "parent"), [F.col("depth"), F.col("parent"), F.col("conv_id")], shared, "siblings"), "siblings")
    after = placed.select((F.col("n") - 1).alias("n"), F.col("depth").alias("d"), F.col("parent").alias("p"), F.col("conv_id").alias("next"))
    beside = placed.join(after, "n", "left").select("conv_id", "depth", "parent", F.when((F.col("d") == F.col("depth")) & (F.col("p") == F.col("parent")), F.col("next")).alias("next"))
    children = placed.groupBy("parent", (F.col("depth") - 1).alias("depth")).agg(F.min("conv_id").alias("child"), F.count("*").alias("n_children")).withColumnRenamed("parent", "conv_id")
    tree = shared.save(nodes.select("conv_id", "depth", "n_convs", "gain").join(beside, ["conv_id", "depth"], "left").join(children, ["conv_id", "depth"], "left").fillna(0, ["n_children"]), "tree")
    k = 2 * F.col("depth")
    none, leaf = F.lit(-1).cast("long"), F.col("child").isNull()
    enter = F.struct(k.alias("k"), F.when(leaf, F.col("conv_id")).otherwise(F.col("child")).alias("nc"), F.when(leaf, k + 1).otherwise(k + 2).alias("nk"))
    has = F.col("next").isNotNull()
    leave = F.struct((k + 1).alias("k"), F.when(has, F.col("next")).otherwise(F.coalesce("parent", none)).alias("nc"), F.when(has, k).when(F.col("depth") == 0, none).otherwise(k - 1).alias("nk"))
    arcs = tree.select(F.col("conv_id").alias("c"), F.explode(F.array(enter, leave)).alias("a")).select("c", "a.*", (F.col("a.nk") >= 0).cast("long").alias("hops"))
    return tree, shared.save(arcs, "arcs")


def subtrees(tree: DataFrame, ranked: DataFrame, shared: Shared) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens) from running sums along the tour."""
    own = tree.select(F.col("conv_id").alias("c"), (2 * F.col("depth")).alias("k"), (F.col("n_children") == 0).cast("long").alias("leaf"), "gain")
    n = 2 * tree.count()
    at = ranked.join(own, ["c", "k"], "left").select("c", "k", (F.lit(n - 1) - F.col("after")).alias("at"), F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("gain", F.lit(0)).alias("gain"))
    sums = running(at, "at", [], {"leaves": F.col("leaf"), "gains": F.col("gain")}, F.sum, shared, "sums")
    enters = F.col("k") % 2 == 0
    part = lambda c, own: F.sum(F.when(enters, F.col(own) - F.col(c)).otherwise(F.col(c)))
    return sums.groupBy(F.col("c").alias("conv_id"), F.shiftright("k", 1).alias("depth")).agg(part("leaves", "leaf").alias("n_leaves"), part("gains", "gain").alias("saved_tokens"))


def ends(convs: DataFrame, prefixes: DataFrame, nodes: DataFrame, shared: Shared) -> DataFrame:
    """(conv_id, depth, ends_sha256) of the nodes where a conversation ends.

    A digest is sequential: ids go into sorted pieces of at most
    ``2 ** PIECE_BITS`` ids, a row each, and a task runs through a node's pieces in order without holding them.
    """
    zero = F.lit(0).cast("long")
    last = prefixes.join(convs.where("length > 0"), "conv_id").where("depth = length").select("conv_id", "depth", "x", "y")
    last = last.unionByName(convs.where("length = 0").select("conv_id", zero.alias("depth"), zero.alias("x"), zero.alias("y")))
    texts = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    pieces = shared.save(last.groupBy("depth", "x", "y", F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(texts.alias("ids")), "pieces")
    named = pieces.join(nodes.select("depth", "x", "y", F.col("conv_id").alias("node")), ["depth", "x", "y"]).select("node", "depth", "piece", "ids")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, done = None, None, []
        for b in batches:
            for node, depth, ids in zip(b.column("node").to_pylist(), b.column("depth").to_pylist(), b.column("ids").to_pylist()):
                if (node, depth) != now:
                    if now is not None:
                        done.append((*now, sha.hexdigest()))
                    now, sha = (node, depth), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if len(done) >= 10_000:
                yield _rows(done)
                done = []
        if now is not None:
            done.append((*now, sha.hexdigest()))
        yield _rows(done)

    dealt = named.repartition("node", "depth").sortWithinPartitions("node", "depth", "piece")
    return dealt.mapInArrow(digest, "conv_id long, depth long, ends_sha256 string")


def _rows(done: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*done)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], ["conv_id", "depth", "ends_sha256"])


NO_ENDS = hashlib.sha256(b"").hexdigest()


def trie(df: DataFrame, conv: str, turn: str, role: str, text: str, shared: Shared, group: int = 100, heads: int = 6) -> DataFrame:
    """A row per node of the prefix trie of the rebuilt conversations.

    Turns are ordered by ``turn``, null first (of equal ones by role and text,
    so repeated rows are turns of their own); null role or text is empty; rows
    without a conversation id belong to none. Conversation c takes the first h
    turns of conversation ``c - c % group`` as it was, all if that has fewer and
    none if there is none, and then its own turns after its first h, where h is
    the crc32 of c's decimal text modulo ``heads``.

    Columns, all long but the last: ``conv_id`` (the smallest member), ``depth``,
    ``parent_conv_id`` (the parent's ``conv_id``; null for the root), ``n_convs``
    (members), ``n_children``, ``n_leaves`` (childless nodes of the subtree, itself
    included), ``saved_tokens`` (over the subtree, each node's members but one times
    the code points of its last text), ``ends_sha256`` (of the decimal ids of the
    members that end here, ascending, joined by commas). Other columns of ``df`` are
    not looked at. An empty table has no nodes.
    """
    said = shared.save(turns(df, conv, turn, role, text, shared), "turns")
    convs, prefixes = rebuilt(said, shared, group, heads)
    prefixes = shared.save(prefixes, "prefixes")
    nodes = nodes_of(convs, prefixes, shared)
    tree, arcs = tour(nodes, shared)
    below = subtrees(tree, rank(arcs, shared), shared)
    found = ends(convs, prefixes, nodes, shared)
    out = tree.join(below, ["conv_id", "depth"]).join(found, ["conv_id", "depth"], "left")
    return out.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def oracle(group: int = 100, heads: int = 6) -> str:
    """DuckDB SQL for :func:`trie` over ``conversations``: every pair of a node and a node below it."""
    step = "list_reduce(list_prepend(s, range(8)), lambda a, b: xor(a >> 1, (a & 1) * 3988292384))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda q: CAST(ascii(q) AS BIGINT))), lambda r, q: {step.replace('list_prepend(s, ', 'list_prepend(xor(r, q), ')}), 4294967295)"
    return f"""
        WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos,
                    sha256(len(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said, len(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (SELECT c, {crc} % {heads} AS h, c - c % {group} AS base FROM (SELECT DISTINCT c FROM t)),
        r AS (SELECT convs.c, 1 AS part, t.pos, said, chars FROM convs JOIN t ON t.c = convs.base AND t.pos <= h
              UNION ALL SELECT convs.c, 2, t.pos, said, chars FROM convs JOIN t ON t.c = convs.c AND t.pos > h),
        d AS (SELECT c, row_number() OVER w AS depth, string_agg(said, ',') OVER w AS path, chars FROM r WINDOW w AS (PARTITION BY c ORDER BY part, pos)),
        p AS (SELECT c, depth, path, chars FROM d UNION ALL SELECT c, 0, '', 0 FROM convs),
        n AS (SELECT path, min(depth) AS depth, min(c) AS node, count(*) AS n_convs, (count(*) - 1) * max(chars) AS gain FROM p GROUP BY path),
        m AS (SELECT p.c, p.depth, n.node FROM p JOIN n ON p.path = n.path),
        up AS (SELECT n.node, n.depth, m.node AS parent FROM n LEFT JOIN m ON m.c = n.node AND m.depth = n.depth - 1),
        kids AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS k FROM up WHERE parent IS NOT NULL GROUP BY 1, 2),
        full_ AS (SELECT n.*, up.parent, coalesce(kids.k, 0) AS k FROM n JOIN up ON n.node = up.node AND n.depth = up.depth LEFT JOIN kids ON kids.node = n.node AND kids.depth = n.depth),
        sub AS (SELECT m.node, m.depth, sum(CAST(f.k = 0 AS BIGINT)) AS leaves, sum(f.gain) AS saved FROM full_ f JOIN m ON m.c = f.node AND m.depth <= f.depth GROUP BY 1, 2),
        len_ AS (SELECT c, max(depth) AS depth FROM p GROUP BY c),
        e AS (SELECT m.node, m.depth, string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c) AS ids FROM m JOIN len_ ON len_.c = m.c AND len_.depth = m.depth GROUP BY 1, 2)
        SELECT f.node AS conv_id, CAST(f.depth AS BIGINT) AS depth, f.parent AS parent_conv_id, n_convs, CAST(f.k AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
               CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
        FROM full_ f JOIN sub ON sub.node = f.node AND sub.depth = f.depth LEFT JOIN e ON e.node = f.node AND e.depth = f.depth
    """
