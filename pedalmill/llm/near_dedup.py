"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

Texts are lower-cased (A-Z) and cut at ASCII white space; a text's set holds its distinct shingles of five
words (a shorter text: all its words as one). Two texts are linked if 100 * intersection >= 75 * union.

Signatures need two permutations of the 32-bit numbers: the first shuffles a shingle's number, the second,
shifted circularly by k, gives coordinate k as its smallest value. Bands of ``ROWS`` coordinates are bucket
keys. A link of similarity 0.75 misses all ``BANDS`` buckets with a chance of (1 - 0.75^4)^32 = 5e-6.

1. Texts with equal sets form a class (found by a 128-bit digest of the set); only classes go on.
2. In every bucket all classes are compared with one hub, so a bucket of n classes gives n pairs. Pairs
   whose sizes or 128 signature bytes cannot belong to a link are dropped (a link fails this with a chance
   of 1e-6); the others are verified on their full sets.
3. Components of the links are found. A bucket whose classes are in one component is finished. The classes
   of the others are grouped again, by the shingles of their prefixes, which with bounds on what two sets
   can share leaves out only what cannot be linked. In each group, ``HUBS`` classes at a time are compared with all classes of other components
   until all are done: no link found by a bucket is lost, no group is cut short, and one round makes at most
   ``HUBS`` pairs per group row.

Defined results: NULL, empty and blank texts have an empty set, are linked with nothing and are kept;
repeated rows share their group; ``component_id`` is the smallest id that is not NULL in the group, and a row is
kept if its id equals it (NULL ids are kept only where the whole group has no id); other columns are not
read and cannot clash.
"""

from __future__ import annotations

from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pedalmill.session import fits_broadcast

from . import common
from .components import connected_components

SHINGLE = 5
INTERSECTION, UNION = 100, 75
BANDS, ROWS = 32, 4
COORDINATES = BANDS * ROWS
#: Signature bytes that must agree before sets are compared; a link has 96 of 128 on average.
LEAST_EQUAL = 72
HUBS = 512
CACHE_WORDS = 200_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
_BAND_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], np.uint64)


class WordNumbers(dict):
    """64-bit numbers of words, kept for the words of one task."""

    def __missing__(self, word: bytes) -> int:
        number = xxhash.xxh64_intdigest(word)
        if len(self) < CACHE_WORDS:
            self[word] = number
        return number


def shingles(raw: bytes, numbers: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit numbers of a text's shingles."""
    words = raw.translate(_LOWER).split()
    if not words:
        return np.array([], np.uint64)
    values = np.fromiter(map(numbers.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for place in range(size):
        total += values[place:len(words) - size + 1 + place] * _PLACES[place]
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    total ^= total >> np.uint64(29)
    return np.unique(total)


def _permute(x: np.ndarray, first: int, second: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(first)
    x ^= x >> np.uint32(13)
    x *= np.uint32(second)
    x ^= x >> np.uint32(16)
    return x


_SHIFTS = np.arange(COORDINATES, dtype=np.uint32)


def signature(numbers: np.ndarray) -> np.ndarray:
    """Coordinates of a set: the second permutation, shifted by k, over the first permutation's numbers."""
    folded = _permute((numbers ^ (numbers >> np.uint64(32))).astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(folded), 1024):
        block = _permute(folded[start:start + 1024, None] - _SHIFTS[None, :], 0x7FEB352D, 0x846CA68B)
        np.minimum(least, block.min(axis=0), out=least)
    return least


def buckets(coordinates: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key per band; the band is part of the key."""
    rows = coordinates.reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D)
    for row in range(ROWS):
        keys = (keys ^ rows[:, row]) * _BAND_MIX[row]
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def set_class(numbers: np.ndarray) -> bytes | None:
    """Digest of a set; none for the empty set."""
    return blake2b(numbers.tobytes(), digest_size=16).digest() if len(numbers) else None


def _signer():
    numbers = WordNumbers()

    def work(texts: list[bytes]) -> list[pa.Array]:
        sets = [shingles(t, numbers) for t in texts]
        signs = [signature(s) if len(s) else None for s in sets]
        return [pa.array([len(s) for s in sets], pa.int64()), pa.array([set_class(s) for s in sets], pa.binary()),
                pa.array([None if s is None else buckets(s) for s in signs], pa.list_(pa.int64())),
                pa.array([None if s is None else (s & np.uint32(255)).astype(np.uint8).tobytes() for s in signs], pa.binary())]
    return work


def _setter():
    numbers = WordNumbers()

    def work(texts: list[bytes]) -> list[pa.Array]:
        sets = [shingles(t, numbers) for t in texts]
        return [pa.array([set_class(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))]
    return work


def _equal_bytes(batches):
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COORDINATES) for c in ("sign_a", "sign_b"))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(
            pa.array((a == b).sum(axis=1) >= LEAST_EQUAL))


class _Verifier:
    """Compares pairs of classes, and fetches the sets of classes when they are first needed."""

    def __init__(self, docs: DataFrame, text: str, classes: DataFrame):
        self.docs, self.text, self.classes = docs, text, classes
        self.sets: DataFrame | None = None
        self.failed: DataFrame | None = None

    def sets_of(self, wanted: DataFrame) -> DataFrame:
        """``class`` and ``numbers`` of the wanted classes, read from the texts where not at hand."""
        self._fetch(wanted)
        return self.sets.join(wanted, "class", "left_semi").dropDuplicates(["class"])

    def _fetch(self, needed: DataFrame) -> None:
        if self.sets is not None:
            needed = needed.join(self.sets.select("class"), "class", "left_anti")
        needed = common.stored(needed.join(self.classes.select("class", "row_key"), "class").select("row_key").distinct(), "near-needed")
        if needed.isEmpty():
            return
        wanted = F.broadcast(needed) if fits_broadcast(needed) else needed
        found = common.map_bytes(self.docs.join(wanted, "row_key", "left_semi"), [], self.text, _setter, "class binary, numbers array<long>")
        found = common.stored(found.filter("class IS NOT NULL"), "near-sets")
        self.sets = found if self.sets is None else self.sets.unionByName(found)

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links."""
        known = self.classes.select("class", "n", "sign")
        sized = (pairs.join(known.select(F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("sign").alias("sign_b")), "b")
                 .join(known.select(F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("sign").alias("sign_a")), "a")
                 .filter(f"{INTERSECTION} * least(n_a, n_b) >= {UNION} * greatest(n_a, n_b)"))
        close = sized.select("a", "b", "sign_a", "sign_b").mapInArrow(_equal_bytes, "a binary, b binary")
        if self.failed is not None:
            close = close.join(self.failed, ["a", "b"], "left_anti")
        close = common.stored(close, "near-close")
        self._fetch(close.select(F.explode(F.array("a", "b")).alias("class")).distinct())
        if self.sets is None:
            return close
        one, two = (self.sets.select(F.col("class").alias(c), F.col("numbers").alias(f"numbers_{c}")) for c in "ab")
        both = close.join(two, "b").join(one, "a")
        common_size = F.size(F.array_intersect("numbers_a", "numbers_b"))
        union_size = F.size("numbers_a") + F.size("numbers_b") - common_size
        checked = common.stored(both.select("a", "b", (INTERSECTION * common_size >= UNION * union_size).alias("link")), "near-checked")
        failed = checked.filter("NOT link").select("a", "b")
        self.failed = failed if self.failed is None else self.failed.unionByName(failed)
        return checked.filter("link").select("a", "b").distinct()


def _ordered(one: str, two: str) -> list:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def _labelled(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return rows.join(groups, "class", "left").withColumn("label", F.coalesce("label", "class"))


def _open_buckets(rows: DataFrame) -> DataFrame:
    """Buckets with classes of several components."""
    return rows.groupBy("bucket").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least != most").select("bucket")


def _prefix_groups(left: DataFrame, sets: DataFrame) -> DataFrame:
    """Groups (``bucket``, ``class``, ``label``) in which any two of ``left`` that are linked meet.

    With shingles ordered from rare to frequent, two sets of n and m shingles that are linked share one
    among the first n - ceil(0.75 n) + 1 of the one and the like of the other. Shingles of a single class
    need not be compared with anything: they only use up places. So a class whose own shingles fill its
    prefix, as edited copies of one original do, cannot be linked to any of the others.
    """
    tokens = sets.join(left, "class").select("class", "label", F.size("numbers").alias("n"), F.explode("numbers").alias("bucket"))
    counts = tokens.groupBy("bucket").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    common_ones = common.stored(tokens.join(counts, "bucket"), "near-tokens")
    found = common_ones.groupBy("class").agg(F.count(F.lit(1)).alias("found"))
    rank = F.row_number().over(Window.partitionBy("class").orderBy("df", "bucket"))
    place = F.col("n") - F.col("found") + F.col("rank")
    prefix = F.col("n") - F.ceil(F.col("n") * F.lit(UNION) / F.lit(INTERSECTION)) + 1
    return common_ones.withColumn("rank", rank).join(found, "class").filter(place <= prefix).select(
        "bucket", "class", "label", "n", (F.col("n") - place + 1).alias("most"))


def _reachable(rows: DataFrame) -> DataFrame:
    """Rows that some size in their group allows a link.

    ``most`` bounds how much two sets share whose first common shingle is the group's; a link of n and m
    shingles needs 75 (n + m) / 175 of it. A class whose bound is too low for the smallest set of its
    group has no link whose first common shingle is this one.
    """
    for _ in range(2):  # dropping some may raise the smallest size
        least = rows.groupBy("bucket").agg(F.min("n").alias("smallest"))
        rows = rows.join(least, "bucket").filter(f"{UNION} * (n + smallest) <= {INTERSECTION + UNION} * most").drop("smallest")
    return rows




def _compare_left(left: DataFrame, verifier: _Verifier, links: DataFrame, groups: DataFrame) -> DataFrame:
    """Components when all pairs that meet in a group and may be links have been compared."""
    while True:
        left = _reachable(left)
        left = common.stored(left.join(_open_buckets(left), "bucket", "left_semi"), "near-left")
        if left.isEmpty():
            return groups
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy("class"))
        hubs = common.stored(left.withColumn("rank", rank).filter(F.col("rank") <= HUBS)
                             .select("bucket", *[F.col(c).alias(f"next_{c}") for c in ("class", "label", "n", "most")]), "near-hubs")
        pairs = left.join(hubs, "bucket").filter(
            f"label != next_label AND {UNION} * (n + next_n) <= {INTERSECTION + UNION} * least(most, next_most)")
        new = common.stored(verifier.links(pairs.select(*_ordered("next_class", "class")).distinct()), "near-links")
        left = left.join(hubs.select("bucket", F.col("next_class").alias("class")), ["bucket", "class"], "left_anti")
        if not new.isEmpty():
            links = links.unionByName(new)
            groups = connected_components(links)
            left = _labelled(left.drop("label"), groups)


def text_digest(text: str = "text"):
    """Digest of a text, which with the id tells rows apart; NULL counts as empty."""
    return F.unhex(F.md5(common.utf8(text)))


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", row_keys: bool = False) -> DataFrame:
    """Every row of ``docs``: id, ``n_shingles``, ``component_id``, ``kept``.

    With ``row_keys`` also ``text_digest``, ``rows`` (of equal sets, NULL for empty ones) and ``chosen``: whether the id
    and digest are those of the group's one row to keep, the smallest with NULL ids last.
    """
    extra = ["digest"] if row_keys else []
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"),
                        F.coalesce(F.col(f"`{id_col}`"), F.lit(-2 ** 63)).alias("row_key"), *[text_digest(text).alias(c) for c in extra])
    signed = common.stored(common.map_bytes(plain, ["id", "row_key", *extra], "text", _signer,
                                            "n long, class binary, buckets array<long>, sign binary"), "near-signed")
    filled = signed.filter("class IS NOT NULL")
    best = [F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "digest")).alias("best")] if row_keys else []
    names = ["best"] if row_keys else []
    classes = common.stored(filled.groupBy("class").agg(
        F.first("n").alias("n"), F.min("row_key").alias("row_key"), F.min("id").alias("first_id"), F.count(F.lit(1)).alias("rows"),
        F.first("sign").alias("sign"), F.first("buckets").alias("buckets"), *best), "near-classes")
    spread = classes.select("class", F.explode("buckets").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = common.stored(spread.join(shared, "bucket"), "near-members")
    # The original of a group of copies stands in most of the group's large buckets: it makes the best hub.
    central = members.groupBy("class").agg(F.sum("size").alias("weight"))
    hubs = members.join(central, "class").groupBy("bucket").agg(F.max_by("class", F.struct("weight", "class")).alias("hub"))
    members = common.stored(members.select("bucket", "class").join(hubs, "bucket"), "near-members")
    verifier = _Verifier(plain, "text", classes)
    links = verifier.links(members.filter("class != hub").select(*_ordered("hub", "class")).distinct())
    groups = connected_components(links)
    # Classes of buckets that still hold several components.
    left = _labelled(members.select("bucket", "class"), groups)
    left = left.join(_open_buckets(left), "bucket", "left_semi").select("class", "label").distinct()
    left = common.stored(left, "near-left")
    if not left.isEmpty():
        groups = _compare_left(_prefix_groups(left, verifier.sets_of(left.select("class"))), verifier, links, groups)
    labels = classes.select("class", "first_id", "rows", *names).join(groups, "class", "left").withColumn("label", F.coalesce("label", "class"))
    labels = common.stored(labels.filter("rows > 1").unionByName(labels.filter("rows = 1").join(groups.select("class"), "class", "left_semi")), "near-labels")
    smallest = common.stored(labels.groupBy("label").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("size"),
                                                         *[F.min(c).alias(c) for c in names]), "near-groups")
    found = common.join_by_hot_key(labels.select("class", "label", "rows"), smallest, "label", "size").select("class", "rows", "component_id", *names)
    facts = signed.select("id", "n", *extra, F.coalesce("class", F.lit(b"")).alias("class"))
    out = common.join_by_hot_key(facts, common.stored(found, "near-found"), "class", "rows")
    component = F.when(F.col("rows").isNull(), F.col("id")).otherwise(F.col("component_id"))
    chosen = F.col("rows").isNull() | (F.col("best.id").eqNullSafe(F.col("id")) & (F.col("best.digest") == F.col("digest"))) if row_keys else None
    keys = [F.col("digest").alias("text_digest"), "rows", chosen.alias("chosen")] if row_keys else []
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      component.eqNullSafe(F.col("id")).alias("kept"), *keys)
