"""N-gram Jaccard join with prefix filters under several global token orders.

Texts are lower-cased (A-Z) and cut at ASCII white space; a text's set holds its distinct shingles of five words (a shorter
text: all its words as one), as 64-bit numbers. Two texts are linked if 100 * intersection >= 80 * union.

Prefixes. Two linked sets share a token among the first n - ceil(0.8 n) + 1 of each, whatever the order of tokens, as
long as it is the same for all sets. Tokens of only one set cannot be shared: they use up places of the prefix. Four
orders are used, and a pair is a candidate only if it shares a prefix token under all of them:

1. Tokens of the first third (by remainder of their number), rare ones first, then the others. The numbers of sets that hold these
   tokens are counted over all texts; a set whose tokens of a single set fill its prefix has no candidates and is done.
   The following orders are made for the sets that are left; linked sets are left together.
2. All tokens, rare ones first: prefix tokens are the groups in which candidates meet.
3. and 4. Tokens of the second or last third first, rare ones first: the prefixes are kept as bitmaps, and a pair
   whose bitmaps have no bit in common is no candidate.

Counting. Tasks index their texts in batches: distinct tokens in order, the number of sets that hold each, and the places of
these sets. Batches send tokens and numbers by token range; what comes back is one number per token. A token of very
many sets costs one entry a batch. Texts with equal sets form a class (by a 128-bit digest); a class is counted once.

Verification. In every group all classes are first compared with one hub, then those of different components with
``HUBS`` others at a time until all are done; sizes and places in the prefixes (with what two sets can still share behind
them) and the bitmaps leave out what cannot be linked. Pairs that pass are verified on full sets. Pairs within one component are not compared
again, so a group of copies is not expanded; no link between components is lost.

Defined results: NULL, empty and blank texts have an empty set and are linked with nothing; repeated rows share their
component; ``component_id`` is the smallest id that is not NULL among the rows reachable (NULL if there is none); other columns are not read.
The first count compares 32 bits of a token within its range; equal ones only keep a set in the join.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pedalmill.session import fits_broadcast

from . import common
from .components import connected_components
from .near_dedup import WordNumbers, set_class, shingles

INTERSECTION, UNION = 100, 80
THIRDS = 3
#: Sets and tokens of a batch; places in a batch have 16 bits.
BATCH_SETS, BATCH_TOKENS = 50_000, 2_000_000
#: Bytes of text whose tokens form one range.
RANGE_BYTES = 32 << 20
HUBS = 256
MARK_WORDS = 4
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def prefix_size(n):
    """Places in which a set of ``n`` tokens shares one with any set it is linked with."""
    return n - (UNION * n + INTERSECTION - 1) // INTERSECTION + 1


def _ranges(tokens: np.ndarray, ranges: int) -> np.ndarray:
    return ((tokens >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def _keys(tokens: np.ndarray, ranges: int, short: bool) -> np.ndarray:
    """What tokens are compared by: themselves, or 32 bits within their range."""
    return (_ranges(tokens, ranges) << np.uint64(32)) | (tokens & np.uint64(0xFFFFFFFF)) if short else tokens


def _indexer(ranges: int, third: int | None):
    """Batches of texts: per row what identifies it, and the inverted index of the tokens."""
    short = third is not None

    def batch(rows: list, sets: list[np.ndarray], owners: list[int]) -> pa.RecordBatch:
        tokens = np.concatenate([np.array([], np.uint64), *sets])
        place = np.repeat(np.array(owners, np.int64), [len(s) for s in sets])
        order = np.argsort(tokens, kind="stable")
        tokens, place = tokens[order], place[order]
        distinct, counts = np.unique(tokens, return_counts=True)
        at = distinct >> np.uint64(32) if short else _ranges(distinct, ranges)
        ends = np.searchsorted(at, np.arange(ranges + 1))
        ids, keys, sizes, classes = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([uuid.uuid4().hex]), pa.array([list(ids)], pa.list_(kinds[0])), pa.array([list(keys)], pa.list_(pa.int64())),
             pa.array([list(sizes)], pa.list_(pa.int64())), pa.array([list(classes)], pa.list_(pa.binary())),
             pa.array([distinct.astype("<u4" if short else "<u8").tobytes()], pa.binary()), pa.array([ends.astype("<i8").tobytes()], pa.binary()),
             pa.array([counts.astype("<u4").tobytes()], pa.binary()), pa.array([place.astype("<u2").tobytes()], pa.binary())],
            ["batch", "ids", "keys", "sizes", "classes", "tokens", "ends", "counts", "places"])

    kinds: list[pa.DataType] = []

    def run(batches):
        numbers = WordNumbers()
        rows, sets, owners, seen, held = [], [], [], set(), 0
        for whole in batches:
            kinds[:] = [whole.schema.field("id").type]
            wanted = whole.column("wanted") if "wanted" in whole.schema.names else None
            for start in range(0, whole.num_rows, common.SLICE_ROWS):
                piece = whole.slice(start, common.SLICE_ROWS)
                texts, ids, keys = (piece.column(c).to_pylist() for c in ("text", "id", "key"))
                wants = wanted.slice(start, common.SLICE_ROWS).to_pylist() if wanted is not None else None
                for i, text in enumerate(texts):
                    found = shingles(text, numbers)
                    own = set_class(found)
                    if wants is not None and own != wants[i]:
                        continue
                    rows.append((ids[i], keys[i], len(found), own))
                    if own is not None and own not in seen:
                        seen.add(own)
                        part = found[found % np.uint64(THIRDS) == third] if short else found
                        sets.append(np.unique(_keys(part, ranges, short)) if short else part)
                        owners.append(len(rows) - 1)
                        held += len(sets[-1])
                    if len(rows) >= BATCH_SETS or held >= BATCH_TOKENS:
                        yield batch(rows, sets, owners)
                        rows, sets, owners, seen, held = [], [], [], set(), 0
        if rows:
            yield batch(rows, sets, owners)
    return run


def indexed(docs: DataFrame, ranges: int, third: int | None = None) -> DataFrame:
    """Batches of ``docs`` (id, key, text and, for chosen classes, wanted), written to the shared folder.

    With ``third`` only tokens of that third are indexed, by 32 bits.
    """
    kind = docs.schema["id"].dataType.simpleString()
    return common.stored(docs.mapInArrow(_indexer(ranges, third), f"batch string, ids array<{kind}>, keys array<long>, sizes array<long>, "
                                         "classes array<binary>, tokens binary, ends binary, counts binary, places binary"), "join-batches")


def batch_rows(batches: DataFrame) -> DataFrame:
    """One row per text: ``batch``, ``place``, ``id``, ``key``, ``n``, ``class``."""
    zipped = F.arrays_zip(F.col("ids").alias("id"), F.col("keys").alias("key"), F.col("sizes").alias("n"), F.col("classes").alias("class"))
    return batches.select("batch", F.posexplode(zipped).alias("place", "row")).select("batch", "place", "row.*")


def _with_chosen(batches: DataFrame, rows: DataFrame) -> DataFrame:
    """Batches with the places that stand for their classes: the first row of each class over all batches."""
    first = rows.filter("class IS NOT NULL").groupBy("class").agg(F.min(F.struct("batch", "place")).alias("first")).select("first.*")
    chosen = common.stored(first.groupBy("batch").agg(F.collect_list("place").alias("chosen")), "join-chosen")  # at most a batch's rows
    return batches.join(F.broadcast(chosen) if fits_broadcast(chosen) else chosen, "batch", "left")


def _opened(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of chosen classes of every token, and whether the class at each entry is chosen."""
    counts = np.frombuffer(batch.column("counts")[i].as_py(), "<u4").astype(np.int64)
    places = np.frombuffer(batch.column("places")[i].as_py(), "<u2")
    mask = np.zeros(1 << 16, bool)
    mask[batch.column("chosen")[i].as_py() or []] = True
    kept = mask[places]
    return np.add.reduceat(kept, np.cumsum(counts) - counts, dtype=np.int64) if len(counts) else counts, kept


def _sender(width: str):
    """One row per batch and token range: tokens of chosen classes and the number of these classes."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                counts, _ = _opened(batch, i)
                tokens = np.frombuffer(batch.column("tokens")[i].as_py(), width)
                ends = np.frombuffer(batch.column("ends")[i].as_py(), "<i8").tolist()
                name, rows = batch.column("batch")[i].as_py(), []
                for k, (a, b) in enumerate(zip(ends, ends[1:])):
                    held = counts[a:b] > 0
                    if held.any():
                        rows.append((name, k, tokens[a:b][held].tobytes(), counts[a:b][held].astype("<u4").tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.binary(), pa.binary()))],
                                                     ["batch", "part", "tokens", "counts"])
    return run


def _counter(width: str):
    """Over all batches, how many classes hold each token of a range."""
    def run(table: pa.Table) -> pa.Table:
        tokens = [np.frombuffer(t, width) for t in table.column("tokens").to_pylist()]
        counts = np.concatenate([np.frombuffer(c, "<u4") for c in table.column("counts").to_pylist()])
        _, at = np.unique(np.concatenate(tokens), return_inverse=True)
        totals = np.minimum(np.bincount(at, counts)[at], 2 ** 32 - 1).astype("<u4")
        cuts = np.cumsum([len(t) for t in tokens])[:-1]
        return pa.table({"batch": table.column("batch"), "part": table.column("part"),
                         "totals": pa.array([t.tobytes() for t in np.split(totals, cuts)], pa.binary())})
    return run


def _with_totals(batches: DataFrame, width: str, columns: list[str]) -> DataFrame:
    """``columns`` of the batches and, per range, how many classes hold each token."""
    sent = batches.mapInArrow(_sender(width), "batch string, part int, tokens binary, counts binary")
    totals = sent.groupBy("part").applyInArrow(_counter(width), "batch string, part int, totals binary")
    listed = totals.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("part", "totals"))).alias("totals"))
    return batches.select("batch", "chosen", "counts", "places", *columns).join(listed, "batch", "left")


def _entries(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per entry of a chosen class: its token's place, its number of classes, and the place of the class."""
    counts, kept = _opened(batch, i)
    totals = np.zeros(len(counts), np.int64)
    if found := batch.column("totals")[i].as_py():
        totals[counts > 0] = np.concatenate([np.frombuffer(t["totals"], "<u4") for t in found])
    token = np.repeat(np.arange(len(counts)), np.frombuffer(batch.column("counts")[i].as_py(), "<u4"))[kept]
    return token, totals[token], np.frombuffer(batch.column("places")[i].as_py(), "<u2")[kept]


def _open_sets(batches):
    """Classes whose tokens of a single class do not fill their prefix."""
    for batch in batches:
        for i in range(batch.num_rows):
            _, totals, places = _entries(batch, i)
            sizes = np.array(batch.column("sizes")[i].as_py(), np.int64)
            alone = np.bincount(places[totals == 1], minlength=len(sizes))
            chosen = np.array(sorted(batch.column("chosen")[i].as_py() or []), np.int64)
            left = pa.array(chosen[alone[chosen] < prefix_size(sizes[chosen])])
            row = batch.slice(i, 1)
            yield pa.RecordBatch.from_arrays([row.column(c).flatten().take(left) for c in ("classes", "keys")], ["class", "key"])


def _marks(tokens: np.ndarray, salt: int) -> list[int]:
    """Bitmap of tokens in ``MARK_WORDS`` words."""
    bits = np.zeros(64 * MARK_WORDS, np.uint8)
    bits[((tokens * _MIX[salt]) >> np.uint64(40)) % np.uint64(64 * MARK_WORDS)] = 1
    return np.packbits(bits).view(np.int64).tolist()


def prefixes(tokens: np.ndarray, totals: np.ndarray) -> tuple[list[int], list[int], list[list[int]]] | None:
    """Shared prefix tokens under order 2 with what can be shared from their place on, and bitmaps under orders 3 and 4.

    None if some order has no shared token in its prefix.
    """
    n, size, shared = len(tokens), prefix_size(len(tokens)), totals > 1
    order = np.lexsort((tokens, totals))[:size]
    at = np.flatnonzero(shared[order])
    marks = []
    for third, mix in ((1, _MIX[0]), (2, _MIX[1])):
        other = np.lexsort((tokens * mix, totals, tokens % np.uint64(THIRDS) != third))[:size]
        other = other[shared[other]]
        if not len(other):
            return None
        marks.append(_marks(tokens[other], third - 1))
    return (tokens[order[at]].view(np.int64).tolist(), (n - at).tolist(), marks) if len(at) else None


def _open_prefixes(batches):
    """Classes that may have candidates: shared tokens, prefix tokens and bitmaps."""
    for batch in batches:
        for i in range(batch.num_rows):
            token, totals, places = _entries(batch, i)
            tokens = np.frombuffer(batch.column("tokens")[i].as_py(), "<u8")[token].astype(np.uint64)
            order = np.argsort(places, kind="stable")
            tokens, totals, places = tokens[order], totals[order], places[order]
            cuts = np.flatnonzero(np.diff(places, prepend=-1))
            classes, rows = batch.column("classes")[i], []
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(places)]):
                found = prefixes(tokens[a:b], totals[a:b])
                if found:
                    rows.append((classes[int(places[a])].as_py(), b - a, np.sort(tokens[a:b][totals[a:b] > 1]).view(np.int64), *found[:2], *found[2]))
            if rows:
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.binary(), pa.int64(), longs, longs, longs, longs, longs))],
                                                 ["class", "n", "shared", "prefix", "most", "third", "fourth"])


class _Verifier:
    """Compares pairs of classes; those that were compared once are not compared again."""

    def __init__(self, sets: DataFrame):
        self.sets, self.done = sets, None

    def links(self, pairs: DataFrame, step: int) -> DataFrame:
        """The linked ones of ``pairs`` (a, b, a < b)."""
        def side(c: str, *columns: str) -> DataFrame:
            return self.sets.select(F.col("class").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in columns])

        def meet(x: str):
            return F.exists(F.zip_with(f"{x}_a", f"{x}_b", lambda p, q: p.bitwiseAND(q)), lambda w: w != 0)
        close = pairs.distinct()
        if self.done is not None:
            close = close.join(self.done, ["a", "b"], "left_anti")
        close = close.join(side("b", "n", "third", "fourth"), "b").join(side("a", "n", "third", "fourth"), "a")
        close = close.filter(F.expr(f"{INTERSECTION} * least(n_a, n_b) >= {UNION} * greatest(n_a, n_b)") & meet("third") & meet("fourth"))
        close = common.stored(close.select("a", "b"), f"join-close-{step}")
        self.done = close if self.done is None else self.done.unionByName(close)
        both = close.join(side("b", "n", "shared"), "b").join(side("a", "n", "shared"), "a")
        both = both.withColumn("common", F.size(F.array_intersect("shared_a", "shared_b")))
        return both.filter(f"{INTERSECTION} * common >= {UNION} * (n_a + n_b - common)").select("a", "b")


def _ordered(one: str, two: str) -> list:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def _groups(sets: DataFrame) -> DataFrame:
    """``token``, ``class``, ``n``, ``most`` of all groups with several classes some of which may be linked.

    ``most`` bounds what a class shares with others whose first common token is the group's; a link of n and m tokens
    shares at least 80 (n + m) / 180.
    """
    rows = sets.select("class", "n", F.explode(F.arrays_zip("prefix", "most")).alias("p")).select(
        F.col("p.prefix").alias("token"), "class", "n", F.col("p.most").alias("most"))
    return common.stored(_reachable(rows), "join-groups")


def _reachable(rows: DataFrame) -> DataFrame:
    """Rows that the sizes in their group allow a link."""
    for _ in range(2):  # dropping some may raise the smallest size
        least = rows.groupBy("token").agg(F.min("n").alias("smallest"), F.count(F.lit(1)).alias("rows")).filter("rows > 1").drop("rows")
        rows = rows.join(least, "token").filter(f"{UNION} * (n + smallest) <= {INTERSECTION + UNION} * most").drop("smallest")
    return rows


def _open_groups(rows: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Rows with the label of their component, of groups with several components."""
    if groups is None:
        return rows.withColumn("label", F.col("class"))
    rows = rows.join(groups, "class", "left").withColumn("label", F.coalesce("label", "class"))
    mixed = rows.groupBy("token").agg(F.min("label").alias("least"), F.max("label").alias("last")).filter("least != last").select("token")
    return rows.join(mixed, "token", "left_semi")


def components(sets: DataFrame) -> DataFrame:
    """``class`` and ``label`` (the least class of its component) of all linked classes."""
    rows, verifier = _groups(sets), _Verifier(sets)
    size = rows.groupBy("token").agg(F.count(F.lit(1)).alias("size"))
    # The original of a group of copies stands in most of the group's prefix groups: it makes the best hub.
    central = rows.join(size, "token").groupBy("class").agg(F.sum("size").alias("weight"))
    hubs = rows.join(central, "class").groupBy("token").agg(F.max_by("class", F.struct("weight", "class")).alias("hub"))
    pairs = rows.join(hubs, "token").filter("class != hub").select(*_ordered("class", "hub"))
    links = common.stored(verifier.links(pairs, 0), "join-links")
    groups = connected_components(links)
    left, step = rows, 0
    while True:
        step += 1
        left = common.stored(_open_groups(_reachable(left), groups), "join-left")
        if left.isEmpty():
            return groups
        rank = F.row_number().over(Window.partitionBy("token").orderBy("class"))
        some = common.stored(left.withColumn("rank", rank).filter(F.col("rank") <= HUBS)
                             .select("token", *[F.col(c).alias(f"next_{c}") for c in ("class", "label", "n", "most")]), "join-hubs")
        pairs = left.join(some, "token").filter(
            f"label != next_label AND {UNION} * (n + next_n) <= {INTERSECTION + UNION} * least(most, next_most)")
        new = common.stored(verifier.links(pairs.select(*_ordered("class", "next_class")), step), "join-links")
        left = left.drop("label").join(some.select("token", F.col("next_class").alias("class")), ["token", "class"], "left_anti")
        if not new.isEmpty():
            links = links.unionByName(new)
            groups = connected_components(links)


def join(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs``: id, ``n_shingles``, ``component_id``."""
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), common.utf8(text).alias("text"))
    plain = plain.withColumn("key", F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("id")))
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0]
    batches = indexed(plain, int(total or 0) // RANGE_BYTES + 1, third=0)
    rows = common.stored(batch_rows(batches), "join-rows")
    known = _with_totals(_with_chosen(batches, rows), "<u4", ["sizes", "classes", "keys"])
    left = common.stored(known.mapInArrow(_open_sets, "class binary, key long"), "join-open")
    wanted = left.select("key", F.col("class").alias("wanted"))
    texts = plain.join(F.broadcast(wanted) if fits_broadcast(wanted) else wanted, "key")
    part = F.broadcast(left.select("key")) if fits_broadcast(left) else left.select("key")
    total = plain.join(part, "key", "left_semi").agg(F.sum(F.octet_length("text"))).first()[0]
    batches = indexed(texts, int(total or 0) // RANGE_BYTES + 1)
    known = _with_totals(_with_chosen(batches, batch_rows(batches)), "<u8", ["tokens", "classes"])
    sets = common.stored(known.mapInArrow(_open_prefixes, "class binary, n long, shared array<long>, prefix array<long>, most array<long>, "
                                          "third array<long>, fourth array<long>"), "join-sets")
    groups = components(sets)
    classes = rows.filter("class IS NOT NULL").groupBy("class").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("rows"))
    labels = classes.join(groups, "class", "left").filter("rows > 1 OR label IS NOT NULL").withColumn("label", F.coalesce("label", "class"))
    labels = common.stored(labels, "join-labels")
    smallest = common.stored(labels.groupBy("label").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("size")), "join-smallest")
    found = common.join_by_hot_key(labels.select("class", "label", "rows"), smallest, "label", "size").select("class", "rows", "component_id")
    out = common.join_by_hot_key(rows.select("id", "n", F.coalesce("class", F.lit(b"")).alias("class")), common.stored(found, "join-found"), "class", "rows")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("rows").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
