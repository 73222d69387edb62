"""Operator 13, conversation prefix trie: a Z-fast trie of turn sequences.

A conversation is the sequence of its turns; a turn is 128 hashed bits of role
and text, so no text moves.  Equal sequences are counted together first; a
class of copies keeps its members as sorted chunks of ids, and only the digest
of a class with several chunks is taken over them in one stream.

The distinct sequences are dealt to parts by ranges of their order.  A part
holds its sequences in a Z-fast trie (``ZFastTrie``): the nodes of the compacted
trie are hashed at their handle, the prefix of the two-fattest length on their
edge.  The exit node of a sequence is found by fat binary search over lengths
(a lookup per halving, not per turn); sequences are located and inserted in
batches, and edges are expanded to a row per depth in the end.

The prefixes that one part shares with others are prefixes of the last sequence
before it or of the first one after it.  The part counts what is its own (a
shared prefix belongs to the first part that has it) and the counts of the
shared prefixes, a path or two per part, are summed up by Spark.  So a turn
with which a third of all conversations begin is spread over parts like any
other, and a part is as large as ``PART_TURNS`` and one conversation allow.

Edge cases: null role or text is empty; turns with one number (or none) are
ordered by their hash; turns without conversation id belong to none and are
left out; repeated turns are turns each; an empty table has no node, not even
the root.  A conversation (24 bytes a turn) must fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import bounded_batches, pick, written
from quarry.sources.tables import load

#: turns of distinct sequences in one part, and sequences located at once
PART_TURNS = 100_000
PART_SEQUENCES = 1_000
BATCH = 1_024
#: bits of the id range of one chunk of a class's members
CHUNK_BITS = 12
#: conversations share their first turns in groups of five, at most eight turns
FAMILY, MOST_SHARED = 5, 8
NO_ENDS = hashlib.sha256(b"").hexdigest()
ROOT = hashlib.md5(b"").digest()
TURN = "array<struct<sig: binary, n: int>>"


def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] that the highest power of two divides."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


def prefixes(turns: list[bytes]) -> list[bytes]:
    """Signatures of all prefixes, the empty one first."""
    h, out = hashlib.md5(), [ROOT]
    for t in turns:
        h.update(t)
        out.append(h.copy().digest())
    return out


class ZFastTrie:
    """Compacted trie of sequences given by their prefix signatures.

    Node v has the extent ``of[v][:extent[v]]``; ``handles`` has every node but
    the root at the signature of its two-fattest prefix length above the extent
    of its parent."""

    def __init__(self):
        self.extent, self.of, self.parent = [0], [[ROOT]], [-1]
        self.children: list[dict[bytes, int]] = [{}]
        self.end: list[int | None] = [None]
        self.handles: dict[bytes, int] = {}

    def _node(self, extent: int, of: list[bytes], parent: int) -> int:
        v = len(self.extent)
        self.extent.append(extent)
        self.of.append(of)
        self.children.append({})
        self.end.append(None)
        self.parent.append(parent)
        self._hang(v, parent)
        return v

    def _hang(self, v: int, parent: int) -> None:
        """Make ``v`` a child of ``parent``, at its first turn and its handle."""
        low, of = self.extent[parent], self.of[v]
        self.parent[v] = parent
        self.children[parent][of[low + 1]] = v
        self.handles[of[two_fattest(low, self.extent[v])]] = v

    def _holds(self, v: int, s: list[bytes]) -> bool:
        e = self.extent[v]
        return e < len(s) and s[e] == self.of[v][e]

    def locate(self, s: list[bytes]) -> tuple[int, int | None]:
        """The deepest node whose extent is a prefix of ``s``, and the child of
        it on whose edge ``s`` leaves the trie, if there is one: fat binary
        search over the prefix lengths."""
        at, low, high = 0, 0, len(s) - 1
        while low < high:
            f = two_fattest(low, high)
            v = self.handles.get(s[f])
            if v is None:
                high = f - 1
            elif self._holds(v, s):
                at, low = v, self.extent[v]
            else:
                return self.parent[v], v
        e = self.extent[at]
        return at, self.children[at].get(s[e + 1]) if e + 1 < len(s) else None

    def insert(self, s: list[bytes], key: int, at: int, edge: int | None) -> None:
        """Add ``s``, located at node ``at`` and child ``edge``."""
        if edge is not None:
            of, low, high = self.of[edge], self.extent[at], min(self.extent[edge], len(s) - 1)
            while low < high:                                               # common prefix on the edge
                mid = (low + high + 1) // 2
                low, high = (mid, high) if s[mid] == of[mid] else (low, mid - 1)
            at = self._node(low, s, at)
            self._hang(edge, at)
        if self.extent[at] < len(s) - 1:
            at = self._node(len(s) - 1, s, at)
        self.end[at] = key

    def insert_all(self, sequences: list[list[bytes]], batch: int = BATCH) -> None:
        """Distinct sequences, in batches: all of a batch are located in the
        trie as it is, and again only where the batch has changed it."""
        for start in range(0, len(sequences), batch):
            part = sequences[start:start + batch]
            changed: set[int] = set()
            for k, (s, (at, edge)) in enumerate(zip(part, [self.locate(s) for s in part])):
                if at in changed or edge in changed:
                    at, edge = self.locate(s)
                changed |= {at} if edge is None else {at, edge}
                self.insert(s, start + k, at, edge)


COLUMNS = ("sig binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
           "n_leaves long, saved_tokens long, ends string, shared boolean, parent_shared boolean")


def expanded(sequences: list[list[bytes]], sizes: list[list[int]], least: list[int], count: list[int],
             ends: list[str], before: set[bytes], after: set[bytes]) -> pa.Table:
    """A row of COLUMNS for each prefix of a part's distinct sequences (prefix
    signatures, bytes per turn, smallest member, members, digest of members).
    ``before``, ``after``: prefixes of the neighbours of the part."""
    trie = ZFastTrie()
    trie.insert_all(sequences)
    nodes = len(trie.extent)
    n, low, leaves, inner, top = [0] * nodes, [None] * nodes, [0] * nodes, [0] * nodes, [0] * nodes
    children = [0] * nodes
    bytes_of = {id(s): b for s, b in zip(sequences, sizes)}
    cols: list[list] = [[] for _ in COLUMNS.split(", ")]
    order = sorted(range(nodes), key=lambda v: -trie.extent[v])
    for v in order:                                                         # children before parents
        own = trie.end[v]
        if own is not None:
            n[v] += count[own]
            low[v] = least[own] if low[v] is None else min(low[v], least[own])
            if not trie.children[v]:
                leaves[v] = int(sequences[own][-1] not in after)
        u = trie.parent[v]
        if u < 0:
            continue
        s, sums = trie.of[v], inner[v]
        size = bytes_of[id(s)]
        for d in range(trie.extent[v], trie.extent[u], -1):
            sums += (n[v] - (s[d] not in before)) * size[d - 1]
        top[v] = sums
        n[u] += n[v]
        low[u] = low[v] if low[u] is None else min(low[u], low[v])
        leaves[u] += leaves[v]
        inner[u] += sums
        children[u] += s[trie.extent[u] + 1] not in before
    for v in range(nodes):
        u, s, e = trie.parent[v], trie.of[v], trie.extent[v]
        first = trie.extent[u] + 1 if u >= 0 else 0
        sums = top[v] if u >= 0 else inner[v]
        size = bytes_of.get(id(s), [])
        for d in range(first, e + 1):
            own = trie.end[v] if d == e else None
            above = s[d - 1] if d else None
            row = (s[d], above, d, low[v], None if u < 0 else low[u] if d == first else low[v], n[v],
                   children[v] if d == e else int(s[d + 1] not in before), leaves[v], sums,
                   None if own is None else ends[own], s[d] in before or s[d] in after,
                   above is not None and (above in before or above in after))
            for c, x in zip(cols, row):
                c.append(x)
            if d:
                sums -= (n[v] - (s[d] not in before)) * size[d - 1]
    types = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.table({c.split()[0]: pa.array(x, types[c.split()[1]]) for c, x in zip(COLUMNS.split(", "), cols)})


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) of rows (conv_id, turn, role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sig = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    return (turns.where("conv_id is not null")
            .select("conv_id", F.struct("turn", sig.alias("sig"), F.octet_length(text).alias("n")).alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
            .select("conv_id", F.transform("t", lambda x: F.struct(x["sig"].alias("sig"), x["n"].alias("n"))).alias("turns")))


def rebuilt(own: DataFrame) -> DataFrame:
    """Conversations with the first turns of their family's first one in place
    of their own: as many as a checksum of the id says."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)
    base = own.select(F.col("conv_id").alias("base"), F.slice("turns", 1, MOST_SHARED).alias("lead"))
    return (own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("h", h.cast("int"))
            .join(base, "base", "left")
            .select("conv_id", F.expr(f"concat(slice(coalesce(lead, cast(array() as {TURN})), 1, h), "
                                      "slice(turns, h + 1, greatest(size(turns) - h, 0)))").alias("turns")))


def _streamed(chunks: DataFrame) -> DataFrame:
    """(cls, ends) of classes with several chunks: the digest of all chunks in
    order, in one stream of constant memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, h = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([h.hexdigest()])], names=["cls", "ends"])

        for b in batches:
            for cls, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if cls == at:
                    h.update(b",")
                else:
                    if at is not None:
                        yield out()
                    at, h = cls, hashlib.sha256()
                h.update(ids.encode())
        if at is not None:
            yield out()

    return (chunks.repartition("cls").sortWithinPartitions("cls", "chunk").select("cls", "ids")
            .mapInArrow(run, "cls binary, ends string"))


def classes(convs: DataFrame) -> DataFrame:
    """(turns, least, count, ends): the distinct sequences with their members'
    smallest id, number and digest.  ``convs``: a written table (conv_id, turns)."""
    whole = F.concat_ws("", F.transform("turns", lambda x: F.hex(x["sig"])))
    chunks = written(
        convs.select("conv_id", F.unhex(F.md5(whole.cast("binary"))).alias("cls"))
        .groupBy("cls", F.shiftright("conv_id", CHUNK_BITS).alias("chunk"))
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .select("cls", "chunk", F.concat_ws(",", F.transform("ids", lambda x: x.cast("string"))).alias("ids"),
                F.size("ids").cast("long").alias("n"), F.col("ids")[0].alias("least")), "chunks")
    found = chunks.groupBy("cls").agg(F.min("least").alias("least"), F.sum("n").alias("count"),
                                      F.count("*").alias("n_chunks"), F.any_value("ids").alias("ids"))
    found = written(found.select("cls", "least", "count", F.when(F.col("n_chunks") == 1, F.sha2(F.col("ids").cast("binary"), 256))
                                 .alias("one")), "classes")
    several = found.where("one is null").select("cls")
    return (found.join(_streamed(chunks.join(several, "cls")), "cls", "left")
            .select("least", "count", F.coalesce("one", "ends").alias("ends"))
            .join(convs.withColumnRenamed("conv_id", "least"), "least"))


def trie(convs: DataFrame) -> DataFrame:
    """A row for every distinct prefix of the conversations (conv_id, turns),
    a written table: the columns of the contract, and its signature ``sig``."""
    spark = convs.sparkSession
    distinct = written(classes(convs), "sequences")
    n, turns = distinct.agg(F.count("*"), F.coalesce(F.sum(F.size("turns")), F.lit(0))).first()
    parts = max(1, -(-turns // PART_TURNS), min(-(-n // PART_SEQUENCES), spark.sparkContext.defaultParallelism))
    dealt = written(distinct.repartitionByRange(parts, "turns").withColumn("part", F.spark_partition_id()), "parts")
    edges = Window.orderBy("part")                                          # a row per part
    sides = (dealt.groupBy("part").agg(F.min("turns").alias("lo"), F.max("turns").alias("hi"))
             .select("part", F.lag("hi").over(edges).alias("before"), F.lead("lo").over(edges).alias("after")))

    def sigs(turns: list | None) -> list[bytes]:
        return prefixes([t["sig"] for t in turns])

    def build(rows: pa.Table, side: pa.Table) -> pa.Table:
        turns = rows.column("turns").to_pylist()
        near = [set(sigs(x)) if (x := side.column(c)[0].as_py()) is not None else set() for c in ("before", "after")]
        return expanded([sigs(t) for t in turns], [[x["n"] for x in t] for t in turns],
                        *[rows.column(c).to_pylist() for c in ("least", "count", "ends")], *near)

    nodes = written(dealt.groupBy("part").cogroup(sides.groupBy("part")).applyInArrow(build, COLUMNS), "nodes")
    total = lambda *cols: [F.sum(c).alias(c) for c in cols]
    shared = written(nodes.where("shared").groupBy("sig", "parent", "depth")
                     .agg(F.min("conv_id").alias("conv_id"), *total("n_convs", "n_children", "n_leaves", "saved_tokens"),
                          F.max("ends").alias("ends")), "shared")
    above = shared.select(F.col("sig").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return _result(nodes.where("not shared and not parent_shared")).unionByName(
        _result(nodes.where("not shared and parent_shared").drop("parent_conv_id").join(above, "parent"))).unionByName(
        _result(shared.join(above, "parent", "left")))


def _result(nodes: DataFrame) -> DataFrame:
    ends: Column = F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")
    return nodes.select("sig", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    bounded_batches(spark)
    turns = pick(load(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    own = written(sequences(turns.withColumn("conv_id", F.col("conv_id").cast("long"))), "conversations")
    return trie(written(rebuilt(own), "rebuilt")).drop("sig")


#: every prefix of every conversation, and every pair of a node and a node above it
OP13_SQL = """
WITH t AS (
  SELECT conv_id, turn, strlen(COALESCE(text, '')) AS n,
         md5(strlen(COALESCE(role, ''))::VARCHAR || ':' || COALESCE(role, '') || COALESCE(text, '')) AS sig
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id AS c, list({'sig': sig, 'n': n} ORDER BY turn NULLS FIRST, sig) AS l,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
             lambda y, i: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 9 AS h
  FROM t GROUP BY conv_id),
r AS (
  SELECT own.c, list_concat(COALESCE(b.l, [])[1:own.h], own.l[own.h + 1:]) AS l
  FROM own LEFT JOIN own b ON b.c = own.c - own.c % 5),
p AS (
  SELECT c, d, len(l) = d AS ends, CASE WHEN d > 0 THEN l[d].n ELSE 0 END AS n,
         md5(array_to_string(list_transform(l[1:d], lambda x: x.sig), '')) AS node
  FROM (SELECT c, l, unnest(range(len(l) + 1)) AS d FROM r)),
nodes AS (
  SELECT node, d, MIN(c) AS conv_id, COUNT(*) AS n_convs, (COUNT(*) - 1) * MIN(n) AS saved,
         sha256(COALESCE(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY node, d),
up AS (
  SELECT x.node, x.conv_id, a.node AS above, a.d = x.d - 1 AS next, x.saved
  FROM nodes x JOIN p a ON a.c = x.conv_id AND a.d <= x.d),
kids AS (SELECT above AS node, COUNT(*) AS n_children FROM up WHERE next GROUP BY above),
sums AS (
  SELECT up.above AS node, SUM(saved) AS saved_tokens, COUNT(*) FILTER (kids.node IS NULL) AS n_leaves
  FROM up LEFT JOIN kids USING (node) GROUP BY up.above),
parents AS (SELECT up.node, x.conv_id AS parent_conv_id FROM up JOIN nodes x ON x.node = up.above WHERE next)
SELECT x.conv_id, x.d::BIGINT AS depth, parent_conv_id, n_convs, COALESCE(n_children, 0) AS n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM nodes x JOIN sums USING (node) LEFT JOIN kids USING (node) LEFT JOIN parents USING (node)
"""
