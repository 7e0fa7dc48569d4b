"""Exact Jaccard join over word shingles with a token-group matrix.

A document is its set of 5-word shingles (64-bit hashes).  Equal sets are one *node* from the start.  Two nodes link when
100 * intersection >= 80 * union.  Asked for are the classes that links connect, so a link between two nodes known to be connected need not be
found again; no link that would connect two classes is missed.

1. Groups.  Nodes that agree in two of eight minimum hashes are compared with the pivots of their keys (one per shared key and turn, so the
   work is linear in the key's nodes).  Links found so make first classes.  A node joins the group of a first pivot to which it is similar at all (``FAMILY``),
   linked or not; of several, that of the most frequent key.  So the near copies of one text are one group, whatever their classes.  Any other
   node is a group of its own.
2. Matrix.  Tokens have one global order: by hash, with tokens that tasks saw again and again put last.  A node's
   first ``n - ceil(0.8 n) + DEPTH`` tokens are its prefix; two linked nodes share at least ``DEPTH`` tokens of their prefixes (all, if they have
   fewer).  A group's row of the matrix is the union of its members' prefixes, kept by token; tokens of one group only are dropped at once.
3. Bound.  A node's overlap with another group's union is counted through the matrix.  Sizes say how much of a link's overlap must lie in the
   prefixes; below that no member can link with it.  For groups of several the whole set is then counted against the union of whole sets.
4. Open.  A qualifying group of one is compared exactly if enough prefix tokens are shared.  In a group of several, and in a node's own, sets are told by
   their differences from the group's pivot: the tokens that one of the two holds alone.  With differences X and Y of sets of n and m tokens, a
   link needs ``|X| + |Y| - 2 |X and Y| <= (n + m) / 9``.  Sets that both link with the pivot are in its class; otherwise that forces a shared
   token of the differences, and as it forces many where differences are large, only the rarest are met (the more are needed, the fewer).

Everything between the steps is a written table.  The order of tokens and the choice of pivots decide the work, not the result.
Broadcast are bit tables of 4 and at most 64 MB, and tables that were counted first (``BROADCAST_ROWS``; beyond it the join is a shuffle).

Defined results: null and empty texts, and texts without words, have no shingles, ``n_shingles`` 0, and are linked with nothing; fewer than five words
are one shingle, the whole sequence.  Rows given twice have one class.  The class id is the smallest id; null ids only count where a class has no
other.  Very long texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from treeflat.llm.common import free_name, keyed, released, ship, staged
from treeflat.llm.components import components
from treeflat.llm.exact_dedup import bit_at
from treeflat.llm.words import mix, slices, windows, word_hashes

ship(__name__)

SHINGLE = 5
SIMILAR = 80  # per cent
#: Prefix tokens that linked nodes share at least.
DEPTH = 3
#: A token is put last when tasks together saw it in so many sets, each task counting what it saw at least twice.
COMMON = 16
BITS = 1 << 25
BROADCAST_ROWS = 500_000
#: Pivots per key; the first decides most, the others are asked for what is still apart.
TURNS = 8
#: Similarity to its pivot, per cent, from which on a node is in a group.
FAMILY = 50
#: Tokens that a task counts together.
COUNTED = 1_000_000
_BINS, _KEYS = 8, 4
_BUCKET = 32768  # bits of a bitmap of Spark's bitmap functions
_SEED = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(column: pa.Array):
    """(row, sorted distinct shingle hashes) of every row."""
    for first, counts, words in word_hashes(column):
        grams, have = windows(words, counts, SHINGLE)
        at, word_at = slices(have), slices(counts)
        for k in range(len(counts)):
            if have[k]:
                yield first + k, np.unique(grams[at[k] : at[k + 1]])
            elif counts[k]:
                h = np.uint64(counts[k])
                for w in words[word_at[k] : word_at[k + 1]]:
                    h = mix(np.array([h * _SEED + w]))[0]
                yield first + k, np.array([h], np.uint64)
            else:
                yield first + k, np.zeros(0, np.uint64)


def node_of(tokens: np.ndarray) -> np.uint64:
    """One hash of the whole set."""
    return mix(np.array([mix(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))]))[0]


def _keys(tokens: np.ndarray) -> list[int | None]:
    """Hashes of pairs of minimum hashes, one minimum for each eighth of the hash space."""
    edges = np.searchsorted(tokens, np.arange(_BINS + 1, dtype=np.float64) * 2.0 ** (64 - 3))
    least = [tokens[edges[b]] if edges[b] < edges[b + 1] else None for b in range(_BINS)]
    out: list[int | None] = []
    for k in range(_KEYS):
        a, b = least[2 * k], least[2 * k + 1]
        out.append(None if a is None or b is None else int(mix(np.array([a * _SEED + b + np.uint64(k)]))[0].astype(np.int64)))
    return out


def _signed(docs: DataFrame) -> DataFrame:
    """Per document its node, size and keys; per task the tokens that it saw in at least two different sets (``token``, ``seen``)."""

    def signed(ids, rows, sizes, nodes, keys, sets):
        token, seen = np.unique(np.concatenate(list(sets.values())), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, int))
        token, seen = token[seen > 1].astype(np.int64), seen[seen > 1]
        n, none = len(rows), pa.nulls(len(token))
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays([ids.take(pa.array(rows, pa.int64())), none.cast(pa.int64())]),
                pa.concat_arrays([pa.array(nodes, pa.int64()), none.cast(pa.int64())]),
                pa.concat_arrays([pa.array(sizes, pa.int64()), none.cast(pa.int64())]),
                pa.concat_arrays([pa.array(keys, pa.list_(pa.int64())), none.cast(pa.list_(pa.int64()))]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(token)]),
                pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(seen, pa.int64())]),
            ],
            ["doc_id", "node", "n", "keys", "token", "seen"],
        )

    def run(batches):
        for b in batches:
            with np.errstate(over="ignore"):
                rows, sizes, nodes, keys, sets, held = [], [], [], [], {}, 0
                for row, tokens in shingle_sets(b.column(1)):
                    rows.append(row)
                    sizes.append(len(tokens))
                    node = int(node_of(tokens).astype(np.int64)) if len(tokens) else None
                    nodes.append(node)
                    keys.append(_keys(tokens) if len(tokens) else [])
                    if node is not None and node not in sets:
                        sets[node] = tokens
                        held += len(tokens)
                    if held >= COUNTED:
                        yield signed(b.column(0), rows, sizes, nodes, keys, sets)
                        rows, sizes, nodes, keys, sets, held = [], [], [], [], {}, 0
                if rows:
                    yield signed(b.column(0), rows, sizes, nodes, keys, sets)

    return docs.mapInArrow(released(run), "doc_id long, node long, n long, keys array<long>, token long, seen long")


def _bit_table(values: DataFrame, column: str) -> np.ndarray:
    """A table of ``BITS`` bits in which the slots of ``values`` are set: at most 4 MB come to the driver."""
    slot = F.col(column).bitwiseAND(F.lit(BITS - 1)) + 1
    packed = values.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in packed.collect():
        at = (r["bucket"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _in_table(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = (values & np.uint64(BITS - 1)).astype(np.int64)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 != 0


def _sets(docs: DataFrame, common: np.ndarray | None, wanted: np.ndarray) -> DataFrame:
    """Per document the prefix under the global order (if ``common`` is given), and the whole set where the node is ``wanted`` (once a task)."""
    sent = docs.sparkSession.sparkContext.broadcast((common, wanted))

    def run(batches):
        common, wanted = sent.value
        had: set[int] = set()
        for b in batches:
            with np.errstate(over="ignore"):
                nodes, sizes, prefixes, wholes = [], [], [], []
                for _, tokens in shingle_sets(b.column(1)):
                    n = len(tokens)
                    if not n:
                        continue
                    h = node_of(tokens)
                    node = int(h.astype(np.int64))
                    if node in had:
                        continue
                    whole = bool(_in_table(wanted, np.array([h]))[0])
                    if whole:
                        had.add(node)
                    prefix = None
                    if common is not None:
                        last = _in_table(common, tokens)
                        ordered = np.concatenate([tokens[~last], tokens[last]]) if last.any() else tokens
                        prefix = ordered[: n - -(-SIMILAR * n // 100) + DEPTH].astype(np.int64)
                    elif not whole:
                        continue
                    nodes.append(node)
                    sizes.append(n)
                    prefixes.append(prefix)
                    wholes.append(tokens.astype(np.int64) if whole else None)
                    if len(nodes) >= 500:
                        yield _set_batch(nodes, sizes, prefixes, wholes)
                        nodes, sizes, prefixes, wholes = [], [], [], []
                if nodes:
                    yield _set_batch(nodes, sizes, prefixes, wholes)

    return docs.mapInArrow(released(run), "node long, n long, prefix array<long>, whole array<long>")


def _lists(arrays: list[np.ndarray | None]) -> pa.Array:
    lengths = [0 if a is None else len(a) for a in arrays]
    values = np.concatenate([a for a in arrays if a is not None]) if any(a is not None for a in arrays) else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(values), mask=pa.array([a is None for a in arrays]))


def _set_batch(nodes, sizes, prefixes, wholes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), _lists(prefixes), _lists(wholes)], ["node", "n", "prefix", "whole"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that link, by their whole sets."""

    def run(batches):
        for b in batches:
            x, y = b.column(2), b.column(3)
            keep = np.zeros(len(x), bool)
            xo, yo = x.offsets.to_numpy(), y.offsets.to_numpy()
            xv, yv = x.values.to_numpy(), y.values.to_numpy()
            for k in range(len(x)):
                p, q = xv[xo[k] : xo[k + 1]], yv[yo[k] : yo[k + 1]]
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep[k] = 100 * common >= SIMILAR * (len(p) + len(q) - common)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep)), b.column(1).filter(pa.array(keep))], ["a", "b"])

    return _both_sets(pairs.select("a", "b"), sets).select("a", "b", "x", "y").mapInArrow(released(run), "a long, b long")


def _both_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` with the whole sets ``x`` of ``a`` and ``y`` of ``b``."""
    sets = sets.join(_small(staged(_ends(pairs), "join-ends")), "node", "left_semi")  # pushed below the removal of repeats
    first = sets.select(F.col("node").alias("a"), F.col("whole").alias("x"))
    second = sets.select(F.col("node").alias("b"), F.col("whole").alias("y"))
    return pairs.join(first, "a").join(second, "b")


def _differences(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(node, root, size, n, m, linked, diff) of the ``pairs`` (a, b, size) that are similar by ``least`` per cent: the sizes of both sets, whether
    they link, and the tokens that one of them holds alone."""

    def run(batches):
        for b in batches:
            x, y = b.column(3), b.column(4)
            xo, yo = x.offsets.to_numpy(), y.offsets.to_numpy()
            xv, yv = x.values.to_numpy(), y.values.to_numpy()
            keep, n, m, linked, diffs = [], [], [], [], []
            for k in range(len(x)):
                p, q = xv[xo[k] : xo[k + 1]], yv[yo[k] : yo[k + 1]]
                diff = np.setxor1d(p, q, assume_unique=True)
                union = (len(p) + len(q) + len(diff)) // 2
                if 100 * (union - len(diff)) < least * union:
                    continue
                keep.append(k)
                n.append(len(p))
                m.append(len(q))
                linked.append(100 * (union - len(diff)) >= SIMILAR * union)
                diffs.append(diff)
            at = pa.array(keep, pa.int64())
            columns = [*(b.column(k).take(at) for k in range(3)), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(linked, pa.bool_()), _lists(diffs)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "root", "size", "n", "m", "linked", "diff"])

    schema = "node long, root long, size long, n long, m long, linked boolean, diff array<long>"
    return _both_sets(pairs.select("a", "b", "size"), sets).select("a", "b", "size", "x", "y").mapInArrow(released(run), schema)


def _met(n: Column, m: Column, x: Column | int, y: Column | int) -> Column:
    """Tokens that differences of ``x`` and ``y`` tokens must share for sets of ``n`` and ``m`` tokens to link (1, if links need none)."""
    return F.greatest(F.ceil(((100 + SIMILAR) * (x + y) - (100 - SIMILAR) * (n + m)) / (2 * (100 + SIMILAR))), F.lit(1))


def _fit(n: Column, m: Column) -> Column:
    return (100 * F.least(n, m)) >= (SIMILAR * F.greatest(n, m))


def _needed(n: Column) -> Column:
    """Overlap that any link of a set of ``n`` has at least."""
    return F.ceil(n * SIMILAR / 100)


def _overlap(n: Column, m: Column) -> Column:
    """Overlap of two linked sets of these sizes at least."""
    return F.ceil((n + m) * SIMILAR / (100 + SIMILAR))


def _shared(n: Column, m: Column) -> Column:
    """Prefix tokens that two linked sets share at least: all of their overlap but what may lie behind the longer rest."""
    rest = lambda x: F.greatest(_needed(x) - DEPTH, F.lit(0))
    return F.greatest(_overlap(n, m) - F.greatest(rest(n), rest(m)), F.lit(1))


def _small(df: DataFrame) -> DataFrame:
    """A written table, broadcast if it was counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _only(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The ``rows`` whose token is one of ``wanted``: first by a bit table of bounded size, broadcast, then by a join of what that lets through."""
    bits = _BUCKET
    while bits < 16 * wanted.count() and bits < 1 << 29:
        bits *= 2
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1
    packed = wanted.select(slot("token").alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("_bits"))
    near = rows.join(F.broadcast(staged(packed, "join-bits")), F.bitmap_bucket_number(slot("token")) == F.col("_bucket"))
    return near.filter(bit_at(F.col("_bits"), F.bitmap_bit_position(slot("token")))).select(*rows.columns).join(_small(wanted), "token")


def _links(docs: DataFrame, signed: DataFrame) -> DataFrame:
    nodes = signed.filter("node IS NOT NULL")
    seen = signed.filter("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen")).filter(F.col("seen") >= COMMON)
    common = _bit_table(seen, "token")

    # groups: nodes that share a key are compared with the key's pivots
    keyed_nodes = staged(nodes.select("node", "n", F.explode("keys").alias("key")).filter("key IS NOT NULL").distinct(), "join-keys")
    turns = range(TURNS)
    pivots = keyed_nodes.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), *[F.min(F.struct(F.xxhash64("node", F.lit(t)).alias("h"), "node", "n")).alias(f"p{t}") for t in turns]
    )
    shared = staged(pivots.filter("size > 1"), "join-pivots")
    meeting = keyed_nodes.join(shared, "key")
    near = staged(
        meeting.select("node", "n", F.explode(F.array(*[F.struct(F.lit(t).alias("turn"), F.col(f"p{t}.node").alias("pivot"), F.col(f"p{t}.n").alias("m")) for t in turns])).alias("p"))
        .filter("p.turn > 0")
        .select(F.least("node", "p.pivot").alias("a"), F.greatest("node", "p.pivot").alias("b"), "n", "p.m")
        .filter((F.col("a") != F.col("b")) & _fit(F.col("n"), F.col("m")))
        .select("a", "b")
        .distinct(),
        "join-near",
    )
    first = staged(
        meeting.select(F.col("node").alias("a"), F.col("p0.node").alias("b"), "n", F.col("p0.n").alias("m"), "size")
        .filter(100 * F.least("n", "m") >= FAMILY * F.greatest("n", "m"))
        .groupBy("a", "b")
        .agg(F.max("size").alias("size")),
        "join-first",
    )
    wanted = _ends(near.unionByName(first.select("a", "b")))
    sets = staged(_sets(docs, common, _bit_table(wanted, "node")), "join-sets")
    whole = sets.filter("whole IS NOT NULL").select("node", "whole").dropDuplicates(["node"])
    alike = staged(_differences(first, whole, FAMILY), "join-alike")
    root = staged(components(_linked(alike)), "join-roots")
    later = staged(_apart(near, "a", "b", root), "join-later")
    links = _stars(root).unionByName(staged(_verified(later, whole), "join-links"))
    root = staged(components(links), "join-roots")
    links = _stars(root)

    # matrix: prefix tokens by group (with its members' number and sizes), those of one group only dropped
    family = staged(alike.groupBy("node").agg(F.max_by(F.struct("root", "n", "m", "diff"), F.struct("size", "root")).alias("f")).select("node", "f.*"), "join-families")
    sizes = family.groupBy("root").agg(F.count(F.lit(1)).alias("members"), F.min("n").alias("low"), F.max("n").alias("high"))
    grouped = staged(family.select("node", "root").join(sizes, "root"), "join-groups")
    parts = {"members": F.coalesce("members", F.lit(1).cast("long")), "root": F.coalesce("root", "node"), "low": F.coalesce("low", "n"), "high": F.coalesce("high", "n")}
    group = F.named_struct(*[x for name, c in parts.items() for x in (F.lit(name), c)])
    tokens = sets.select("node", "n", "prefix").join(_small(grouped), "node", "left").select("node", "n", group.alias("group"), F.explode("prefix").alias("token"))
    mixed = staged(tokens.groupBy("token").agg(F.min("group.root").alias("low"), F.max("group.root").alias("high")).filter("low != high").select("token"), "join-mixed")
    rows = staged(_only(tokens, mixed).distinct(), "join-matrix-rows")
    matrix = rows.select("token", F.col("group").alias("other")).distinct()

    # bound: overlap of a node's prefix with the unions of other groups (of two groups, the smaller one asks)
    n = F.col("n")
    least, most = F.greatest(F.col("other.low"), _needed(n)), F.least(F.col("other.high"), F.floor(n * 100 / SIMILAR))
    # ``_shared`` falls on both sides of n; rounding up can lift an end of the range by one over what lies inside
    fewest = F.greatest(F.least(_shared(n, least), _shared(n, most)) - 1, F.lit(1))
    overlap = rows.join(matrix, "token").filter((F.col("group") < F.col("other")) & (least <= most)).groupBy("node", "n", "other").agg(F.count(F.lit(1)).alias("overlap"))
    bounded = staged(overlap.filter(F.col("overlap") >= fewest).select("node", "n", "other"), "join-bounded")
    # groups of several: the whole set against the union of the members' whole sets
    several = bounded.filter("other.members > 1")
    whole = _with_sets(docs, several.select("node"), whole)
    asked_roots = _small(staged(several.select(F.col("other.root").alias("root")).distinct(), "join-asked"))
    members = grouped.filter("members > 1").join(asked_roots, "root", "left_semi").join(whole, "node").select("root", "node", F.size("whole").alias("m"), F.explode("whole").alias("token"))
    union = staged(members.groupBy("root", "token").agg(F.count(F.lit(1)).alias("often")), "join-union")
    inside = several.join(whole, "node").select("node", "n", "other", F.col("other.root").alias("root"), F.explode("whole").alias("token")).join(union, ["root", "token"])
    reached = staged(inside.groupBy("node", "n", "other", "root").agg(F.count(F.lit(1)).alias("overlap")).filter(F.col("overlap") >= _overlap(n, least)).drop("overlap"), "join-reached")

    # open: groups of one by the prefix, the others by differences from their pivots
    single = rows.filter("group.members = 1").select("token", F.col("group").alias("other"), F.col("node").alias("b"), F.col("n").alias("m"))
    alone = (
        rows.drop("group")
        .join(bounded.filter("other.members = 1").select("node", "other"), "node")
        .join(single, ["token", "other"])
        .filter(_fit(n, F.col("m")))
        .groupBy(F.col("node").alias("a"), "b", "n", "m")
        .agg(F.count(F.lit(1)).alias("common"))
        .filter(F.col("common") >= _shared(n, F.col("m")))
        .select("a", "b")
    )
    asked = staged(_differences(reached.select(F.col("node").alias("a"), F.col("root").alias("b"), F.lit(0).cast("long").alias("size")), whole, 0), "join-asked")
    pairs = staged(alone.unionByName(_inside(family, asked, root)).distinct(), "join-pairs")
    links = links.unionByName(_linked(asked))
    if pairs.isEmpty():
        return links
    return links.unionByName(staged(_verified(pairs, _with_sets(docs, _ends(pairs), whole)), "join-links"))


def _inside(family: DataFrame, asked: DataFrame, root: DataFrame) -> DataFrame:
    """Pairs (a, b) of a group's members, and of askers and members, that are in two classes so far and may link, by their differences from the pivot."""
    columns = ["node", "root", "n", "m", "diff"]
    both = family.select(*columns, F.lit(True).alias("member")).unionByName(asked.select(*columns, F.lit(False).alias("member")))
    classes = _small(root).select("node", F.col("root").alias("class"))
    both = both.join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))
    apart = staged(both.groupBy("root").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low != high").select("root"), "join-apart")
    d = F.size("diff").cast("long")
    held = both.join(_small(apart), "root", "left_semi").select("node", "root", "n", "m", "class", "member", d.alias("d"), F.explode("diff").alias("token"))
    often = staged(held.filter("member").groupBy("root", "token").agg(F.count(F.lit(1)).alias("often")), "join-often")
    # tokens that no member holds come first: they count as places, but nothing is met at them
    order = Window.partitionBy("node", "root").orderBy(F.coalesce("often", F.lit(0)), "token")
    placed = held.join(often, ["root", "token"], "left").withColumn("at", F.row_number().over(order))
    # a member's size exceeds the pivot's by its difference at most, which only adds to what must be shared
    rare = staged(placed.filter("often IS NOT NULL").filter(F.col("at") <= F.col("d") - _met(F.col("n"), F.col("m"), F.col("d"), 0) + 1).drop("m", "often"), "join-rare")
    other = rare.filter("member").select("root", "token", *(F.col(c).alias(f"_{c}") for c in ("node", "n", "class", "d", "at")))
    needed = _met(F.col("n"), F.col("_n"), F.col("d"), F.col("_d"))
    may = (F.col("class") != F.col("_class")) & (~F.col("member") | (F.col("node") < F.col("_node"))) & _fit(F.col("n"), F.col("_n"))
    met = (F.col("at") <= F.col("d") - needed + 1) & (F.col("_at") <= F.col("_d") - needed + 1)
    return rare.join(other, ["root", "token"]).filter(may & met).select(F.col("node").alias("a"), F.col("_node").alias("b")).distinct()


def _linked(pairs: DataFrame) -> DataFrame:
    return pairs.filter("linked AND node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def _stars(root: DataFrame) -> DataFrame:
    """Links that say the same as all found so far: every node with its root."""
    return root.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def _apart(pairs: DataFrame, a: str, b: str, root: DataFrame) -> DataFrame:
    """Those of ``pairs`` whose nodes ``a`` and ``b`` are in two classes so far."""
    found = pairs
    for end in (a, b):
        found = found.join(_small(root).select(F.col("node").alias(end), F.col("root").alias(f"_root_{end}")), end, "left")
    return found.filter(F.coalesce(f"_root_{a}", a) != F.coalesce(f"_root_{b}", b)).select(*pairs.columns)


def _with_sets(docs: DataFrame, wanted: DataFrame, whole: DataFrame) -> DataFrame:
    """``whole`` with the sets of all ``wanted`` nodes; documents are read again only for those that are missing."""
    missing = staged(wanted.distinct().join(whole, "node", "left_anti"), "join-missing")
    if missing.isEmpty():
        return whole
    more = _sets(docs, None, _bit_table(missing, "node")).select("node", "whole").dropDuplicates(["node"]).join(missing, "node", "left_semi")
    return whole.unionByName(staged(more, "join-more-sets"))


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(signed rows of the documents, (node, root) of the nodes that have links)."""
    signed = staged(_signed(docs), "join-signed")
    return signed, staged(components(_links(docs, signed)), "join-roots")


def similar_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    signed, root = _classes(keyed(docs, key, text))
    rows = signed.filter("token IS NULL").select("doc_id", "n", "node")
    linked = rows.filter("node IS NOT NULL").join(_small(root), "node", "left").select("doc_id", "n", F.coalesce("root", "node").alias("root"))
    least = staged(linked.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("size")).filter("size > 1"), "join-classes")
    placed = linked.join(least, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return placed.unionByName(rows.filter("node IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the smallest id of each class (all columns); rows without shingles and rows with a null id stay.

    The rows to drop are found by id, so ids should be unique; of rows with the same id in one class all are kept or none.
    """
    classes = similar_classes(docs, key, text)
    name = free_name(docs.columns, "_gone")
    gone = staged(classes.filter((F.col("doc_id") != F.col("component_id")) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias(name)).distinct(), "join-gone")
    return docs.join(_small(gone), F.col(f"`{key}`").cast("long") == F.col(name), "left_anti")
