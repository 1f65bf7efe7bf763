"""MinHash near-duplicates with tensored banding (operator 5).

Two collections of ``m`` half keys, each of ``half`` minhashes, give ``m * m`` tables: a table's key
combines half key i of the first collection with half key j of the second. So 2 * m * half minhashes do
the work of m * m * 2 * half. ``m`` follows from the similarity and the admitted chance to miss a pair
at exactly that similarity (``miss``; pairs above it are missed far more rarely).

1. Texts with equal shingle sets are one class, with a number of its own and its smallest id.
2. Half keys that no other class has are dropped; the rest are combined to table keys.
3. The sets of the classes left are written in pieces by ranges of the hash, so that no row grows with its text.
   Classes with too few shingles in common with all other classes can't have a link and go.
4. In each table bucket every class is compared with the one that has the fewest shingles of its own, the
   bucket's center. Candidates are confirmed on the full sets, piece by piece, and give components.
5. Buckets that still hold several components: the classes outside the bucket's largest component are
   joined exactly with those of other components, by their rarest shingles. So a bucket of copies costs
   rows in proportion to its size, and no link between different texts is left out. There is no cap.
6. The components of all confirmed links are the result, named by their smallest id.

Defined results: a null or empty text, or one without words, has an empty set and is linked with nothing;
a text of fewer words than a shingle has its word sequence as its one shingle. Rows that share an id are separate
texts with links of their own, repeated rows one class. Rows with a null id are linked with nothing: their
component is null and they are not kept. Ties need no rule: components are named by their smallest id. An empty
table gives an empty one. Texts have any length; columns besides id and text aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import drop_scratch, flat_bytes, map_texts, ship, text_slices, written
from orrery.llm.components import connected_components
from orrery.llm.words import mix, shingle_sets, word_hashes


@dataclass(frozen=True)
class Settings:
    shingle: int = 5  # words
    percent: int = 80  # the similarity, in percent
    half: int = 3  # minhashes of a half key
    miss: float = 2e-4

    @property
    def m(self) -> int:
        """The fewest half keys a collection that keep the chance of a miss: 2 (1 - s^half)^m <= miss."""
        return math.ceil(math.log(self.miss / 2) / math.log(1 - (self.percent / 100) ** self.half))


_MINIMA_STEP = 1 << 12  # shingles that are hashed at once
_PIECE_BITS = 11  # a piece of a set has about 2 ** 11 shingles at most


def _signer(settings: Settings):
    k = 2 * settings.m * settings.half
    rng = np.random.Generator(np.random.PCG64(5))
    factors = rng.integers(0, 1 << 63, k, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
    offsets_ = rng.integers(0, 1 << 63, k, dtype=np.uint64)[:, None]

    def minima(s: np.ndarray) -> np.ndarray:
        out = np.full(k, np.iinfo(np.uint64).max, np.uint64)
        for a in range(0, len(s), _MINIMA_STEP):
            mixed = s[None, a : a + _MINIMA_STEP] * factors
            mixed += offsets_
            np.minimum(out, mixed.min(axis=1), out=out)
        return out

    def sign(texts):
        raw, offsets = flat_bytes(texts)
        sets = shingle_sets(*word_hashes(raw, offsets), settings.shingle)
        n = pa.array([len(s) for s in sets], pa.int64())
        digests = np.frombuffer(b"".join(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2)
        least = np.array([minima(s) for s in sets], np.uint64).reshape(len(sets), 2 * settings.m, settings.half)
        keys = np.zeros(least.shape[:2], np.uint64)
        for i in range(settings.half):
            keys = mix(keys + least[:, :, i] + np.uint64(i + 1))
        ends = pa.array(np.arange(len(sets) + 1) * 2 * settings.m, pa.int32())
        return [n, pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.ListArray.from_arrays(ends, pa.array(keys.reshape(-1).view(np.int64)))]

    return sign


def signatures(docs: DataFrame, settings: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, t`` (a hash of the text), ``n_shingles, s1, s2`` (a digest of the set) and ``halves``, the half keys of both collections."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    return map_texts(rows, "text", lambda: _signer(settings), "n_shingles bigint, s1 bigint, s2 bigint, halves array<bigint>", ["id", "t"])


def level(n: int) -> int:
    """A set of ``n`` shingles has 2 ** level pieces."""
    return ((n - 1) >> _PIECE_BITS).bit_length() if n else 0


def _level(n) -> Column:
    over = F.shiftright(n - 1, _PIECE_BITS)
    return F.when(over <= 0, 0).otherwise(F.length(F.bin(over)))


def set_pieces(texts: DataFrame, shingle: int) -> DataFrame:
    """``cid, n, piece, members`` of ``texts (cid, text)``: each set in pieces by the first bits of the shingles' hashes."""
    ship(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                raw, offsets = flat_bytes(batch.column(1)[a:b])
                for cid, s in zip(batch.column(0)[a:b].to_pylist(), shingle_sets(*word_hashes(raw, offsets), shingle), strict=True):
                    bits = level(len(s))
                    firsts = np.searchsorted(s, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(1, np.int64)
                    ends = pa.array(np.r_[firsts, len(s)], pa.int32())
                    size = len(firsts)
                    yield pa.RecordBatch.from_arrays([pa.array([cid] * size, pa.int64()), pa.array([len(s)] * size, pa.int64()), pa.array(range(size), pa.int32()), pa.ListArray.from_arrays(ends, pa.array(s.view(np.int64)))], ["cid", "n", "piece", "members"])

    return texts.select("cid", "text").mapInArrow(run, "cid bigint, n bigint, piece int, members array<bigint>")


def _table_keys(classes: DataFrame, settings: Settings) -> DataFrame:
    """``key, cid`` of all tables, for half keys that several classes have."""
    m = settings.m
    halves = classes.select("cid", F.posexplode("halves").alias("pos", "half"))
    shared = halves.groupBy("pos", "half").agg(F.count("*").alias("c")).where("c > 1").select("pos", "half")
    live = halves.join(shared, ["pos", "half"]).groupBy("cid").agg(F.collect_list(F.struct("pos", "half")).alias("live"))  # 2 * m at most
    first, second = F.filter("live", lambda x: x["pos"] < m), F.filter("live", lambda x: x["pos"] >= m)
    keys = F.flatten(F.transform(first, lambda x: F.transform(second, lambda y: F.xxhash64(x["pos"], x["half"], y["pos"], y["half"]))))
    return live.select("cid", F.explode(keys).alias("key"))


def _promising(sets: DataFrame, settings: Settings) -> DataFrame:
    """``cid, x (n, shared)`` of the classes that can have a link: ``shared`` shingles occur in other classes too.

    A link needs ``percent`` of either set in common, so classes with fewer shared shingles go.
    """
    shingles = sets.select("cid", F.explode("members").alias("s"))
    own = shingles.groupBy("s").agg(F.max("cid").alias("high"), F.min("cid").alias("cid")).where("cid = high").groupBy("cid").agg(F.count("*").alias("own"))
    shared = F.col("n") - F.coalesce("own", F.lit(0))
    kept = sets.where("piece = 0").select("cid", "n").join(own, "cid", "left").select("cid", F.struct("n", shared.alias("shared")).alias("x"))
    return written(kept.where(F.col("x.shared") * 100 >= F.col("x.n") * settings.percent), "promising")


def _may_link(a: str, b: str, settings: Settings):
    """Whether sizes and shared shingles of two classes (structs ``n, shared``) admit the similarity."""
    common = F.least(f"{a}.shared", f"{b}.shared")
    return common * 100 >= (F.col(f"{a}.n") + F.col(f"{b}.n") - common) * settings.percent


def _pair(x: str, xn, y: str, yn) -> list[Column]:
    """``u, v, un, vn`` with the larger class number first."""
    first = F.col(x) > F.col(y)
    return [F.greatest(x, y).alias("u"), F.least(x, y).alias("v"), F.when(first, xn).otherwise(yn).alias("un"), F.when(first, yn).otherwise(xn).alias("vn")]


def _cross_pairs(rows: DataFrame, settings: Settings) -> DataFrame:
    """Every pair ``u, v, un, vn`` of different components, one of them marked ``few``, that can be similar enough.

    An exact prefix join over ``rows (cid, n, members, few, component)``: with all sets ordered from rare to frequent
    shingles, a pair whose first common shingle has place i and j has at most n - i and n - j in common, and needs
    percent (n + n') / (100 + percent). So copies of one text that each differ a lot meet only in what is rare.
    """
    p = settings.percent
    shingles = rows.select("cid", "n", "few", "component", F.explode("members").alias("s"))
    frequency = shingles.groupBy("s").agg(F.count("*").alias("df"))
    place = F.row_number().over(Window.partitionBy("cid").orderBy("df", "s")) - 1
    ranked = shingles.join(frequency, "s").withColumn("i", place).where((F.col("n") - F.col("i")) * 100 >= F.col("n") * p).where("df > 1")
    ranked = written(ranked.select("s", "i", "cid", "n", "few", "component"), "prefixes")
    x = ranked.where("few").select("s", F.col("i").alias("xi"), F.col("cid").alias("x"), F.col("n").alias("xn"), F.col("component").alias("xc"))
    y = ranked.select("s", F.col("i").alias("yi"), F.col("cid").alias("y"), F.col("n").alias("yn"), F.col("component").alias("yc"))
    most = F.least(F.col("xn") - F.col("xi"), F.col("yn") - F.col("yi"))
    pairs = x.join(y, "s").where((F.col("xc") != F.col("yc")) & (most * (100 + p) >= (F.col("xn") + F.col("yn")) * p))
    out = written(pairs.select(*_pair("x", F.col("xn"), "y", F.col("yn"))).distinct(), "cross")
    drop_scratch(ranked)
    return out


def _confirmed(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The ``pairs (u, v, un, vn)`` whose full sets are similar enough, as ``u, v``.

    Pieces of one hash range meet; where one set has finer pieces than the other, each of them meets the coarser one.
    """
    finest = F.greatest(_level(F.col("un")), _level(F.col("vn")))
    at = pairs.withColumn("finest", finest).withColumn("part", F.explode(F.sequence(F.lit(0), F.call_function("shiftleft", F.lit(1), F.col("finest")) - 1)))
    part = lambda n: F.call_function("shiftright", F.col("part"), F.col("finest") - _level(F.col(n)))
    at = at.select("u", "v", (F.col("un") + F.col("vn")).alias("total"), part("un").alias("u_piece"), part("vn").alias("v_piece"))
    left = sets.select(F.col("cid").alias("u"), F.col("piece").alias("u_piece"), F.col("members").alias("u_set"))
    right = sets.select(F.col("cid").alias("v"), F.col("piece").alias("v_piece"), F.col("members").alias("v_set"))
    both = at.join(right, ["v", "v_piece"]).join(left, ["u", "u_piece"])
    common = both.select("u", "v", "total", F.size(F.array_intersect("u_set", "v_set")).alias("common")).groupBy("u", "v", "total").agg(F.sum("common").alias("common"))
    return common.where(F.col("common") * 100 >= (F.col("total") - F.col("common")) * settings.percent).select("u", "v")


def links(docs: DataFrame, signed: DataFrame, settings: Settings, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(classes ``s1, s2, id, cid``; components ``node, component`` of the linked classes)."""
    first = F.min(F.struct("id", "t", "n_shingles", "halves")).alias("x")
    classes = signed.where("n_shingles > 0 and id is not null").groupBy("s1", "s2").agg(first)
    classes = written(classes.select("s1", "s2", "x.*", F.monotonically_increasing_id().alias("cid")), "classes")
    keys = _table_keys(classes, settings)
    bucket = keys.groupBy("key").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).where("low < high")
    buckets = written(keys.join(bucket, "key").select("key", "cid"), "buckets")
    wanted = classes.select("id", "t", "cid").join(buckets.select("cid").distinct(), "cid", "left_semi")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    texts = texts.join(wanted, ["id", "t"]).groupBy("id", "t").agg(F.first("cid").alias("cid"), F.first("text").alias("text"))  # one row a class
    sets = written(set_pieces(texts, settings.shingle), "sets", wide=True)
    found = _promising(sets, settings)
    rows = written(buckets.join(found, "cid"), "rows")
    drop_scratch(buckets)
    center = rows.groupBy("key").agg(F.min(F.struct((F.col("x.n") - F.col("x.shared")).alias("own"), "cid", "x")).alias("c"), F.count("*").alias("k")).where("k > 1")
    stars = rows.join(center.select("key", "c"), "key").where((F.col("cid") != F.col("c.cid")) & _may_link("x", "c.x", settings))
    stars = stars.select("cid", F.col("c.cid").alias("to"), F.col("x.n").alias("n"), F.col("c.x.n").alias("m"))
    stars = written(stars.select(*_pair("cid", F.col("n"), "to", F.col("m"))).distinct(), "stars")
    linked = written(_confirmed(stars, sets, settings), "links")
    parts = connected_components(linked)
    placed = rows.join(parts.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    counts = placed.groupBy("key", "component").agg(F.count("*").alias("c"))
    mixed = counts.groupBy("key").agg(F.max_by("component", F.struct("c", "component")).alias("main"), F.count("*").alias("k")).where("k > 1").select("key", "main")
    placed = placed.join(mixed, "key")
    apart = placed.groupBy("cid").agg(F.max(F.col("component") != F.col("main")).alias("few"), F.first("component").alias("component"))
    cross = _cross_pairs(apart.join(sets, "cid"), settings)
    more = written(_confirmed(cross, sets, settings), "links")
    if not more.isEmpty():
        parts = connected_components(linked.unionByName(more))
    for done in (sets, rows, found, stars, cross):
        drop_scratch(done)
    return classes, parts


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``<id>, n_shingles, component_id`` (the smallest id reachable) and ``kept``."""
    signed = written(signatures(docs, settings, id_col, text_col), "signatures", wide=True)
    classes, parts = links(docs, signed, settings, id_col, text_col)
    placed = classes.select("s1", "s2", "id", "cid").join(parts.withColumnRenamed("node", "cid"), "cid")
    least = placed.groupBy("component").agg(F.min("id").alias("least"))
    moved = placed.join(least, "component").select("s1", "s2", "least")
    own = classes.select("s1", "s2", F.col("id").alias("first"))
    named = own.join(moved, ["s1", "s2"], "left").select("s1", "s2", F.coalesce("least", "first").alias("component"))
    part = F.when(F.col("n_shingles") > 0, F.col("component"))
    out = signed.select("id", "n_shingles", "s1", "s2").join(named, ["s1", "s2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce(part, "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
