"""The trie of conversation prefixes, without a node's members ever being brought together.

Each conversation's turns give the digests of its prefixes; every distinct digest is a node. The
conversation of smallest id that goes through a node owns it. Below a node that a conversation
owns, it owns the rest of its own path, so the trie falls apart into one chain for each owner,
and a chain is no longer than one conversation. Whatever hangs on a chain is summed up before it
is brought there, so that a prefix which a third of all conversations share costs one row.

Chains are dealt over shards. A shard's digests get slots of a minimal perfect hash, counts are
scattered into flat arrays by slot, and sums run through the array of parent slots from the
deepest nodes upwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept

#: Nodes that a shard holds on average.
SHARD_NODES = 200_000
#: Conversations whose ids share the upper bits are listed in one row: 2 ** this at most.
ID_BITS = 16
#: First turns that may come from the conversation of the hundred, and one more.
HEADS = 6

_ROOT = (0, 0)
_PREFIX_ROW = "hi long, lo long, up_hi long, up_lo long, conv_id long, depth int, chars long, ends boolean"
_SUM_ROW = "hi long, lo long, n_leaves long, saved_tokens long"


# --- Minimal perfect hashing ------------------------------------------------------------


def _placed(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where a digest falls in a level's bitmap."""
    mixed = (hi ^ (lo * np.uint64(0x9E3779B97F4A7C15))) + np.uint64(0xD6E8FEB86659FD93 * (level + 1) % (1 << 64))
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


class SlotTable:
    """Slots 0 to n - 1 for n different digests of 128 bits.

    On each level a digest that falls alone into its place stays there, the others go on to the
    next level; a slot is the rank of its place among all taken ones. The digest of each slot is
    kept, so that a look-up tells members from others.
    """

    LEVELS = 96

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        self.hi, self.lo = (np.zeros(len(hi), dtype=np.uint64) for _ in range(2))
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # taken places, and the slot of each
        hi, lo = hi.astype(np.uint64), lo.astype(np.uint64)
        used = 0
        while len(hi):
            if len(self.levels) == self.LEVELS:
                raise ValueError("a digest is given twice")
            size = 2 * len(hi)
            place = _placed(hi, lo, len(self.levels), size)
            taken = np.bincount(place, minlength=size) == 1
            slots = used - 1 + np.cumsum(taken)
            alone = taken[place]
            self.hi[slots[place[alone]]], self.lo[slots[place[alone]]] = hi[alone], lo[alone]
            self.levels.append((taken, slots))
            used += int(alone.sum())
            hi, lo = hi[~alone], lo[~alone]

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for those that have none."""
        hi, lo = hi.astype(np.uint64), lo.astype(np.uint64)
        found = np.full(len(hi), -1, dtype=np.int64)
        left = np.arange(len(hi))
        for level, (taken, slots) in enumerate(self.levels):
            place = _placed(hi[left], lo[left], level, len(taken))
            here = taken[place]
            found[left[here]] = slots[place[here]]
            left = left[~here]
        same = found >= 0
        same[same] = (self.hi[found[same]] == hi[same]) & (self.lo[found[same]] == lo[same])
        return np.where(same, found, -1)


def subtree_sums(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one shard: hi, lo, n_leaves, saved_tokens of each node with all below it.

    Rows of depth zero bring the sums of what hangs on a node from other chains; the others are nodes.
    """
    own = rows["depth"].to_numpy() > 0
    nodes, brought = rows[own], rows[~own]
    hi, lo = (nodes[x].to_numpy(dtype=np.int64) for x in ("hi", "lo"))
    table = SlotTable(hi, lo)
    slots = table.slots(hi, lo)
    parent, depth, leaves, saved = (np.zeros(len(nodes), dtype=np.int64) for _ in range(4))
    parent[slots] = table.slots(nodes["up_hi"].to_numpy(dtype=np.int64), nodes["up_lo"].to_numpy(dtype=np.int64))
    # A chain may hang on one of the same shard. It is brought like any other.
    owner = np.zeros(len(nodes), dtype=np.int64)
    owner[slots] = nodes["owner"].to_numpy(dtype=np.int64)
    inside = parent >= 0
    inside[inside] = owner[parent[inside]] == owner[inside]
    depth[slots] = nodes["depth"].to_numpy(dtype=np.int64)
    for more in (nodes, brought):
        at = table.slots(more["hi"].to_numpy(dtype=np.int64), more["lo"].to_numpy(dtype=np.int64))
        np.add.at(leaves, at, more["leaves"].to_numpy(dtype=np.int64))
        np.add.at(saved, at, more["saved"].to_numpy(dtype=np.int64))
    order = np.argsort(-depth, kind="stable")
    order = order[inside[order]]
    levels = np.flatnonzero(np.diff(depth[order])) + 1
    for same in np.split(order, levels):
        np.add.at(leaves, parent[same], leaves[same])
        np.add.at(saved, parent[same], saved[same])
    return pd.DataFrame({"hi": table.hi.astype(np.int64), "lo": table.lo.astype(np.int64), "n_leaves": leaves, "saved_tokens": saved})


# --- Conversations ----------------------------------------------------------------------


def rebuilt_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns, chars): the digests of a conversation's turns in order, and their code points.

    The first turns, up to five as the id decides, come from the conversation of the hundred.
    """
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    turn = F.struct("turn", role.alias("role"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t")).filter("conv_id IS NOT NULL")
    own = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    own = kept(own.selectExpr("conv_id", "transform(t, x -> struct(x.digest, x.chars)) AS own"), "turn-digests")
    heads = own.filter("conv_id % 100 = 0").selectExpr("conv_id AS hundred", f"slice(own, 1, {HEADS}) AS head")
    whole = own.selectExpr("*", "conv_id - conv_id % 100 AS hundred", f"cast(crc32(encode(cast(conv_id AS string), 'UTF-8')) % {HEADS} AS int) AS h")
    whole = whole.join(heads, "hundred", "left")
    first = "coalesce(slice(head, 1, h), filter(own, x -> false))"
    rest = "if(size(own) > h, slice(own, h + 1, greatest(size(own) - h, 0)), filter(own, x -> false))"
    whole = whole.selectExpr("conv_id", f"concat({first}, {rest}) AS turns")
    return whole.selectExpr("conv_id", "turns.digest AS turns", "turns.chars AS chars")


def _prefix_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each prefix of at least one turn: its digest, its parent's, and its last turn's length."""
    for batch in batches:
        pairs, ids, depths, chars, ends = [], [], [], [], []
        for conv_id, turns, lengths in zip(batch["conv_id"], batch["turns"], batch["chars"], strict=True):
            digest = bytes(16)
            for depth, turn in enumerate(turns, 1):
                above, digest = digest, hashlib.blake2b(digest + turn, digest_size=16).digest()
                pairs.append(digest + above)
                depths.append(depth)
            ids.extend([conv_id] * len(turns))
            chars.extend(lengths)
            ends.extend([False] * (len(turns) - 1) + [True] * (len(turns) > 0))
        words = np.frombuffer(b"".join(pairs), dtype="<i8").reshape(-1, 4)
        yield pd.DataFrame(
            dict(zip(("hi", "lo", "up_hi", "up_lo"), words.T, strict=True))
            | {"conv_id": ids, "depth": depths, "chars": chars, "ends": ends}
        ).astype({"conv_id": "int64", "depth": "int32", "chars": "int64", "ends": bool})


def _hashed_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted pieces of lists to one SHA-256 for each list; one piece is held at a time."""
    key, state = None, None
    for batch in batches:
        done = []
        for hi, lo, ids in zip(batch["hi"], batch["lo"], batch["ids"], strict=True):
            if (hi, lo) == key:
                state.update(b",")
            else:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (hi, lo), hashlib.sha256()
            state.update(ids.encode())
        yield pd.DataFrame(done, columns=["hi", "lo", "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=["hi", "lo", "ends_sha256"])


def _end_digests(ends: DataFrame) -> DataFrame:
    """(hi, lo, conv_id) to (hi, lo, ends_sha256) of the ids in rising order, joined by commas.

    A node's ids are listed in rows of at most 2 ** `ID_BITS`; the rows are hashed one after another.
    """
    block = F.shiftright("conv_id", ID_BITS).alias("block")
    listed = ends.groupBy("hi", "lo", block).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    listed = listed.selectExpr("hi", "lo", "block", "array_join(transform(ids, x -> cast(x AS string)), ',') AS ids")
    dealt = listed.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "block")
    return dealt.mapInPandas(_hashed_lists, "hi long, lo long, ends_sha256 string")


def conversation_trie(conversations: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """One row for each distinct prefix of the rebuilt conversations, the textless root included.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves and
    saved_tokens of the subtree, ends_sha256 of the members that end there.

    Turns are ordered by number, null first, then by role and digest; repeated rows are turns of
    their own. Null roles and texts are empty. Rows without a conv_id take no part. Negative ids
    belong to the hundred nearer to zero. Other columns are ignored; an empty table gives no
    rows. The digests of one conversation's turns must fit one cell.
    """
    conversations = conversations.select("conv_id", "turn", "role", "text")
    whole = kept(rebuilt_conversations(conversations), "conversations")
    prefixes = kept(whole.mapInPandas(_prefix_rows, _PREFIX_ROW), "prefixes")
    same = [F.first(x).alias(x) for x in ("up_hi", "up_lo", "depth", "chars")]
    nodes = prefixes.groupBy("hi", "lo").agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), *same)
    nodes = kept(nodes, "nodes")
    children = nodes.groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(F.count("*").alias("n_children"))
    above = nodes.selectExpr("hi AS up_hi", "lo AS up_lo", "owner AS parent_conv_id")
    linked = nodes.join(children, ["hi", "lo"], "left").join(above, ["up_hi", "up_lo"], "left")
    linked = linked.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    own = [(F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")]
    linked = kept(linked.select("*", *own), "linked-nodes")

    sums = _subtrees(prefixes, linked, shard_nodes)
    turnless = whole.filter("size(turns) = 0").select(*(F.lit(x).cast("long").alias(y) for x, y in zip(_ROOT, ("hi", "lo"))), "conv_id")
    ends = _end_digests(prefixes.filter("ends").select("hi", "lo", "conv_id").unionByName(turnless))
    below = linked.agg(
        F.count_if(F.col("depth") == 1).alias("n_children"),
        F.greatest(F.coalesce(F.sum("leaves"), F.lit(0)), F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce(F.sum("saved"), F.lit(0)).cast("long").alias("saved_tokens"),
    ).first()
    total = whole.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    first = F.lit(total.first()["conv_id"]).cast("long")
    values = {"hi": _ROOT[0], "lo": _ROOT[1], **below.asDict()}
    root = total.filter("n_convs > 0").select("*", *(F.lit(v).cast("long").alias(k) for k, v in values.items()))
    root = root.select("*", F.lit(0).alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"))
    table = linked.join(sums, ["hi", "lo"]).withColumnRenamed("owner", "conv_id")
    table = table.withColumn("parent_conv_id", F.when(F.col("depth") == 1, first).otherwise(F.col("parent_conv_id")))
    table = table.select(*root.columns).unionByName(root).join(ends, ["hi", "lo"], "left")
    return table.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def _subtrees(prefixes: DataFrame, linked: DataFrame, shard_nodes: int) -> DataFrame:
    """(hi, lo, n_leaves, saved_tokens) of every node, all below it included.

    A chain's totals are brought to the node on which each chain above it is left: at most one
    row for each chain a conversation goes through.
    """
    totals = linked.groupBy(F.col("owner").alias("conv_id")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    paths = prefixes.select("hi", "lo", "conv_id", "depth").join(linked.select("hi", "lo", "owner"), ["hi", "lo"])
    left_at = paths.filter("conv_id <> owner").groupBy("conv_id", "owner").agg(F.max(F.struct("depth", "hi", "lo")).alias("at"))
    brought = left_at.join(totals, "conv_id").groupBy("owner", "at.hi", "at.lo")
    brought = brought.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    rows = linked.select("owner", "hi", "lo", "up_hi", "up_lo", "depth", "leaves", "saved")
    none = F.lit(0).cast("long")  # nulls would turn the numbers into floats
    rows = rows.unionByName(brought.select("*", none.alias("up_hi"), none.alias("up_lo"), F.lit(0).alias("depth")))
    shards = max(1, -(-linked.count() // shard_nodes))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("owner"), F.lit(shards)))
    return rows.groupBy("shard").applyInPandas(subtree_sums, _SUM_ROW)


def trie_sql() -> str:
    """The same rows in SQL, by joins of each conversation's prefixes."""
    crc = (
        "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), "
        "lambda s, b: list_reduce(list_prepend(xor(s, b), list_transform(range(8), lambda i: 0::BIGINT)), "
        "lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)), 4294967295::BIGINT)"
    )
    return f"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
           coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (SELECT conv_id, {crc} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT c.conv_id, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.place <= c.h
    UNION ALL
    SELECT c.conv_id, t.place, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h
), numbered AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, role, text FROM rebuilt
), prefixes AS (
    SELECT conv_id, depth, length(text) AS chars,
           string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS name,
           depth = max(depth) OVER (PARTITION BY conv_id) AS ends
    FROM numbered
    UNION ALL
    SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM numbered) FROM convs
), nodes AS (
    SELECT name, min(depth) AS depth, min(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM prefixes GROUP BY name
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.name[1:length(n.name)] = n.name) AS n_children
    FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.name = n.name[1:greatest(length(n.name) - 64, 0)]
), sums AS (
    SELECT a.name, count(*) FILTER (WHERE l.n_children = 0) AS n_leaves, sum((l.n_convs - 1) * l.chars) AS saved_tokens
    FROM linked l JOIN prefixes a ON a.conv_id = l.conv_id AND a.depth <= l.depth GROUP BY a.name
)
SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children::BIGINT AS n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM linked JOIN sums USING (name)
"""
