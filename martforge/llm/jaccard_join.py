"""Exact near-duplicate join on word shingles by parity sketches.

Two documents link when the Jaccard similarity of their sets of distinct
5-word shingles is at least 0.8. With a and b shingles that allows a symmetric
difference of D <= (a + b) / 9.

1. *Sketch.* The shingles of a set are hashed into blocks, and each block holds
   the XOR of its shingles' hashes. A differing shingle touches one block, so at
   most D blocks differ: the number of differing blocks (and the Hamming
   distance of the one-bit-per-shingle parity sketch) is a lower bound of the
   symmetric difference.
2. *Pigeonhole join, per size band.* Bands are [2^k, 2^(k+1)); a set whose
   partner may be in the next band is entered there too. In any order of block
   values that is the same for all sets, a linked pair has r common blocks among
   the first D + r of both; the order is that of the values themselves, and only
   those blocks are joined. Sets with no more than D blocks meet under one more
   key of their band.
3. *Heavy keys.* A key with more than LIGHT members says little (a passage that
   many documents share). A linked pair without a common light key has r common
   heavy ones, so only sets with as many are *affected* (r is a share EXTRA of
   D; a partner's r may be less by the ratio of their sizes). They enter more
   of their blocks, as many as should hold D + 1 light ones by the share of heavy
   ones seen; a block that more than LIGHT of the affected enter is heavy from
   now on, and the order becomes light blocks first. A set that still lacks
   D + 1 light blocks enters all it has. Affected sets are joined by the first
   D + 1 blocks of the new order; those whose prefix keeps heavy blocks (sets
   made almost wholly of shared passages) form families by these.
4. *Verify.* In each group of at most LIGHT sets, one is compared with the
   others; components are formed, and in groups that still hold several, the
   sets of different components are compared. In a family the set with fewest
   light blocks is compared with the others, then one outside its component,
   then all pairs of different components whose sizes and parity sketches allow
   a link (the join's own condition). Sizes, sketches and at last the sets
   themselves decide. So every pair that shares a key is compared or already
   connected.

Sets are compared as 64-bit hashes of shingles. Documents with equal sets are one
class, known by a 64-bit digest; a second digest of another hash shows whether two
sets share the first, and then all is done again with other digests.

Defined results: null or empty texts and texts without words have no shingles
and link with nothing (their component is their own doc_id); 1 to 4 words form
one shingle; repeated rows and repeated doc_ids each give their own row; a null
doc_id stays null unless it is linked with others; doc_ids of any ordered type
keep it; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import graph, text as tx
from ..session import path_exists
from .graph import components, discard, few, materialize, release

#: Words of a shingle.
SHINGLE_WORDS = 5
#: Members of a key whose sets are compared with each other; more members make the key heavy.
LIGHT = 32
#: Blocks that are joined past the first D + 1, as a share of these.
EXTRA = 0.15
#: Keys of one run of a task, in which keys are counted before they are dealt out.
RUN_KEYS = 1 << 19
#: Sets of a family that one task of its last round pairs with the others.
FAMILY_PART = 512
_BLOCK_SEED = np.uint64(0xD1B54A32D192ED03)


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = tx.utf8(column)
    starts, ends, rows = tx.spans(data, offsets, tx.NOT_SPACE)
    words = tx.hash_spans(data, starts, ends, tx.VALUES_LOWER)
    hashes, at = tx.windows(words, rows, SHINGLE_WORDS)
    n = len(column)
    bound = np.searchsorted(rows[at], np.arange(n + 1))
    word_bound = np.searchsorted(rows, np.arange(n + 1))
    out = []
    for i in range(n):
        if bound[i] < bound[i + 1]:
            out.append(np.unique(hashes[bound[i]:bound[i + 1]]))
        else:
            few = words[word_bound[i]:word_bound[i + 1]]
            whole = np.full(min(1, len(few)), len(few), np.uint64)
            for w in few:
                whole = tx.mix(whole + w) + np.uint64(len(few))
            out.append(whole)
    return out


def digest(s: np.ndarray, seed: int = 0) -> int:
    """64-bit digest of a set, as a signed integer (0 for the empty set only)."""
    if not len(s):
        return 0
    with np.errstate(over="ignore"):
        parts = tx.mix(s + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        d = int(tx.mix(np.asarray([np.sum(parts, dtype=np.uint64) + np.uint64(len(s))]))[0].astype(np.int64))
    return d or 1


def parity(s: np.ndarray) -> np.ndarray:
    """Parity sketch of 4 times the band's bits (64 at least) as signed 64-bit words."""
    bits = max(64, 4 << len(s).bit_length() - 1)
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def allowed(a: int, largest: int) -> int:
    """Largest symmetric difference of a set of ``a`` with a linked set of at most ``largest``."""
    return (a + min(5 * a // 4, largest)) // 9


def block_keys(s: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """Per band that the set is entered in: the band, D, and the keys of its blocks in their order."""
    a = len(s)
    band = a.bit_length() - 1
    out = []
    for k in (band, band + 1) if 5 * a // 4 >= 2 << band else (band,):
        blocks = max(16, 1 << k)
        where = (((s >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)
        # the upper half of s is sorted as s is, so equal blocks are neighbours
        first = np.flatnonzero(np.diff(where, prepend=-1))
        label = (np.uint64(k) << np.uint64(48)) + where[first].astype(np.uint64)
        key = np.sort(tx.mix(np.bitwise_xor.reduceat(tx.mix(s ^ _BLOCK_SEED), first) ^ tx.mix(label)).view(np.int64))
        most = allowed(a, (2 << k) - 1 if k == band else 5 * a // 4)
        if len(first) <= most:
            key = np.append(key, tx.mix(np.asarray([np.uint64(k) + np.uint64(1 << 60)])).view(np.int64))
        out.append((k, most, key))
    return out


def entered(most: int) -> int:
    """How many blocks of a set with D = ``most`` are joined: D + r."""
    return most + 1 + int(EXTRA * (most + 1))


def heavy_needed(a: int, bands: list[tuple[int, int, np.ndarray]]) -> int:
    """The least number of common keys of a set of ``a`` with a linked set: if they are all heavy, it has so many.

    The pair has r common keys, r being that of the one whose last joined key comes first; its size is at least 4a/5 and
    its D at least 2/9 of its size. A set that enters all its blocks has no last key; two such have all but D in common.
    """
    r = 1 + int(EXTRA * (2 * (4 * a // 5) // 9))
    for _, most, key in bands:
        if len(key) < entered(most):
            r = min(r, max(1, len(key) - most))
    return r


def _lists(parts: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()),
                                    pa.array(np.concatenate([np.empty(0, np.int64), *parts])))


def _profile(seed: int):
    """Rows of documents, and of the task's classes: size, sketch and ``need``, the heavy keys that make them affected."""
    def schema(id_type):
        return pa.schema([("doc_id", id_type), ("text_hash", pa.int64()), ("digest", pa.int64()), ("n_shingles", pa.int64()),
                          ("other", pa.int64()), ("sketch", pa.list_(pa.int64())), ("need", pa.int64()), ("kind", pa.string())])

    def run(batches):
        seen = set()
        for step in tx.steps(batches, "text"):
            fields = schema(step.schema.field("doc_id").type)
            sets = shingle_sets(step.column("text"))
            digests = [digest(s, seed) for s in sets]
            classes = []
            for s, d in zip(sets, digests):
                if d and d not in seen:
                    seen.add(d)
                    classes.append((d, len(s), parity(s), heavy_needed(len(s), block_keys(s))))
            n = len(sets)
            yield pa.RecordBatch.from_arrays([
                step.column("doc_id"), step.column("text_hash"), pa.array(digests, pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s, seed + 1000) for s in sets], pa.int64()),
                *(pa.nulls(n, t) for t in fields.types[5:7]), pa.array(["document"] * n)], schema=fields)
            if classes:
                n = len(classes)
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(n, fields.types[0]), pa.nulls(n, pa.int64()), pa.array([c[0] for c in classes], pa.int64()),
                    pa.array([c[1] for c in classes], pa.int64()), pa.nulls(n, pa.int64()), _lists([c[2] for c in classes]),
                    pa.array([c[3] for c in classes], pa.int64()), pa.array(["class"] * n)], schema=fields)
    return run


def _joined_keys(seed: int):
    """The keys that every class of the task is joined under, in runs of RUN_KEYS.

    A key that more than LIGHT of a run have is heavy for sure: one row without a digest says so, and instead of its
    members' rows each of them gives one row (under a key of its own) with the number of such keys in ``hot``.
    """
    def rows(key, dig, hot):
        for i in range(0, len(key), 1 << 16):
            yield pa.RecordBatch.from_arrays([x[i:i + (1 << 16)] for x in (key, dig, hot)], names=["key", "digest", "hot"])

    def run(batches):
        seen, digests, keys, n = set(), [], [], 0
        for step in tx.steps(batches, "text"):
            for s in shingle_sets(step.column("text")):
                d = digest(s, seed)
                if d and d not in seen:
                    seen.add(d)
                    digests.append(d)
                    keys.append(np.concatenate([k[:entered(most)] for _, most, k in block_keys(s)]))
                    n += len(keys[-1])
            if n >= RUN_KEYS:
                yield from one_run(digests, keys)
                digests, keys, n = [], [], 0
        if digests:
            yield from one_run(digests, keys)

    def one_run(digests, keys):
        key = np.concatenate(keys)
        size = np.array([len(k) for k in keys])
        of = np.array(digests, np.int64)
        order = np.argsort(key, kind="stable")
        first = np.append(True, key[order][1:] != key[order][:-1])
        times = np.diff(np.append(np.flatnonzero(first), len(key)))
        heavy = np.empty(len(key), bool)
        heavy[order] = np.repeat(times > LIGHT, times)
        marks = key[order][first][times > LIGHT]
        hot = np.bincount(np.repeat(np.arange(len(of)), size)[heavy], minlength=len(of))
        dig = np.repeat(of, size)
        yield from rows(pa.array(key[~heavy]), pa.array(dig[~heavy]), pa.array(np.zeros(int((~heavy).sum()), np.int32)))
        yield from rows(pa.array(marks), pa.nulls(len(marks), pa.int64()), pa.array(np.zeros(len(marks), np.int32)))
        some = of[hot > 0]
        yield from rows(pa.array(tx.mix(some.view(np.uint64)).view(np.int64)), pa.array(some),
                        pa.array(hot[hot > 0].astype(np.int32)))
    return run


def _groups(batches):
    """Rows sorted by (key, digest), null digests (the key is heavy) first: the members of each light key with two
    sets or more, and the sets of heavy keys with n = 1; rows with ``hot`` give their sets with n = hot. Holds at most
    LIGHT rows of the last key."""
    held_key, held, held_heavy = None, np.empty(0, np.int64), False

    names = ["members", "heavy", "n"]

    def as_heavy(found, n=None):
        n = np.ones(len(found), np.int64) if n is None else n
        return pa.RecordBatch.from_arrays([pa.nulls(len(found), pa.list_(pa.int64())), pa.array(found), pa.array(n)], names=names)

    def out(key, dig):
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        size = np.diff(np.append(first, len(key)))
        heavy = size > LIGHT
        if held_heavy and len(key) and key[0] == held_key:
            heavy[0] = True
        light = (size > 1) & ~heavy
        members = dig[np.repeat(light, size)]
        found = dig[np.repeat(heavy, size)]
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size[light])), pa.int32()), pa.array(members))
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([lists, pa.nulls(len(found), lists.type)]),
            pa.concat_arrays([pa.nulls(len(lists), pa.int64()), pa.array(found)]),
            pa.concat_arrays([pa.nulls(len(lists), pa.int64()), pa.array(np.ones(len(found), np.int64))])], names=names)

    for batch in batches:
        hot = batch.column("hot").to_numpy(zero_copy_only=False)
        if hot.any():
            found = batch.filter(pa.array(hot > 0))
            yield as_heavy(found.column("digest").to_numpy(zero_copy_only=False), hot[hot > 0].astype(np.int64))
            batch = batch.filter(pa.array(hot == 0))
        key = batch.column("key").to_numpy(zero_copy_only=False)
        if not len(key):
            continue
        column = batch.column("digest")
        mark = column.is_null().to_numpy(zero_copy_only=False)
        dig = column.fill_null(0).to_numpy(zero_copy_only=False)
        if len(held):
            key, dig, mark = (np.concatenate(x) for x in (
                [np.full(len(held), held_key), key], [held, dig], [np.zeros(len(held), bool), mark]))
        marked = np.unique(key[mark])
        key, dig = key[~mark], dig[~mark]
        if len(key):
            new = np.append(True, (key[1:] != key[:-1]) | (dig[1:] != dig[:-1]))
            key, dig = key[new], dig[new]
        heavy_last = bool(len(marked)) and (not len(key) or marked[-1] >= key[-1])
        end = marked[-1] if heavy_last else key[-1]
        was_heavy = held_heavy and held_key == end
        sure = np.isin(key, marked)
        if sure.any():
            yield as_heavy(dig[sure])
        key, dig = key[~sure], dig[~sure]
        tail = key == end
        done = out(key[~tail], dig[~tail])
        if done.num_rows:
            yield done
        rest = dig[tail]
        heavy_now = was_heavy or heavy_last and marked[-1] == end or len(rest) > LIGHT
        if heavy_now and len(rest):
            yield as_heavy(rest)
            rest = rest[:0]
        held_key, held, held_heavy = end, rest, heavy_now
    if len(held) > 1:
        yield out(np.full(len(held), held_key), held)


def _more_keys(seed: int):
    """The first blocks of every set in each of its bands: as many as should hold D + 1 light ones, where ``heavy`` of
    its joined blocks (all bands) were heavy; all blocks where ``heavy`` is null. ``whole`` tells whether these are all."""
    def run(batches):
        seen = set()
        for step in tx.steps(batches, "text"):
            rows = []
            for s, heavy in zip(shingle_sets(step.column("text")), step.column("heavy").to_pylist()):
                d = digest(s, seed)
                if d and d not in seen:
                    seen.add(d)
                    bands = block_keys(s)
                    joined = sum(min(len(k), entered(most)) for _, most, k in bands)
                    for band, most, k in bands:
                        n = len(k)
                        if heavy is not None and heavy < joined:
                            n = min(n, int((most + 1) * 1.1 * joined / (joined - heavy)) + 4)
                        rows.append((d, band, most, n == len(k), k[:n]))
            if rows:
                yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in rows], pa.int64()) for i in range(3)),
                                                  pa.array([r[3] for r in rows]), _lists([r[4] for r in rows])],
                                                 names=["digest", "band", "most", "whole", "keys"])
    return run


def _part(known):
    """The keys of each row as light ones and heavy ones (those of the sorted array ``known``)."""
    def run(batches):
        for batch in batches:
            column = batch.column("keys")
            keys = column.flatten().to_numpy(zero_copy_only=False)
            size = np.diff(column.offsets.to_numpy())
            heavy = np.zeros(len(keys), bool)
            if len(known.value) and len(keys):
                at = np.minimum(np.searchsorted(known.value, keys), len(known.value) - 1)
                heavy = known.value[at] == keys
            row = np.repeat(np.arange(len(size)), size)
            lists = [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(row[x], minlength=len(size)))), pa.int32()),
                                              pa.array(keys[x])) for x in (~heavy, heavy)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *lists], names=[*batch.schema.names[:-1], "light", "heavy"])
    return run


def _emit_sets(seed: int):
    def run(batches):
        seen = set()
        for step in tx.steps(batches, "text"):
            out = []
            for s in shingle_sets(step.column("text")):
                d = digest(s, seed)
                if d and d not in seen:
                    seen.add(d)
                    out.append((d, s.view(np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in out], pa.int64()), _lists([s for _, s in out])],
                                                 names=["digest", "shingles"])
    return run


def _texts_of(texts: DataFrame, members: DataFrame, digests: DataFrame, *columns: str) -> DataFrame:
    """The texts of some classes (one text hash for each class; copies of that text come too), with columns of theirs."""
    wanted = materialize(texts.sparkSession, members.join(digests, "digest").groupBy("digest", *columns).agg(
        F.min("text_hash").alias("text_hash")).select("text_hash", *columns).dropDuplicates(["text_hash"]), "jaccard-wanted")
    return texts.withColumn("text_hash", F.xxhash64("text")).join(few(wanted), "text_hash").select("text", *columns)


def _sketch_distance(short: str, long: str) -> str:
    """SQL of the Hamming distance of two sketches; the longer one is folded to the shorter one's width."""
    folded = (f"zip_with(slice({long}, 1, size({long}) div 2), slice({long}, size({long}) div 2 + 1, "
              f"size({long}) div 2), (x, y) -> x ^ y)")
    same = f"if(size({long}) > size({short}), {folded}, {long})"
    return f"aggregate(zip_with({short}, {same}, (x, y) -> bit_count(x ^ y)), 0, (t, x) -> t + x)"


def _profiles(texts: DataFrame, id_type: str) -> tuple[DataFrame, DataFrame, int]:
    """The written profile, one row per class, and the seed under which digests tell all sets apart."""
    spark = texts.sparkSession
    rows = texts.withColumn("text_hash", F.xxhash64("text"))
    for seed in range(100):
        profile = materialize(spark, rows.mapInArrow(
            _profile(seed), f"doc_id {id_type}, text_hash long, digest long, n_shingles long, other long, "
            "sketch array<long>, need long, kind string"), "jaccard-profile", "kind")
        same = profile.filter("kind = 'document'").groupBy("digest").agg(
            F.min("other").alias("a"), F.max("other").alias("b")).filter("a <> b")
        if same.isEmpty():
            classes = materialize(spark, profile.filter("kind = 'class'").groupBy("digest").agg(
                F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("need").alias("need")),
                "jaccard-classes")
            return profile, classes, seed
        discard(profile)
    raise RuntimeError("no digest tells the sets apart")


def _of_kind(profile: DataFrame, kind: str, *columns: str) -> DataFrame:
    """One kind of the profile's rows, from its own folder (there is none without rows)."""
    path, wanted = f"{profile.scratch}/kind={kind}", profile.select(*columns)
    if not path_exists(profile.sparkSession, path):
        return wanted.limit(0)
    return profile.sparkSession.read.schema(wanted.schema).parquet(path)


def _affected(texts: DataFrame, members: DataFrame, heavy: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Of the sets with a heavy key, ``heavy(digest, heavy)``: their groups under light keys, and the families of sets
    that share others.

    Families: family, digest and light, the number of light blocks.
    """
    spark = texts.sparkSession

    def entered(which: DataFrame) -> DataFrame:
        # copies of a text give the same rows in several tasks
        return materialize(spark, _texts_of(texts, members, which, "heavy").mapInArrow(
            _more_keys(seed), "digest long, band long, most long, whole boolean, keys array<long>").dropDuplicates(
            ["digest", "band"]), "jaccard-blocks")

    def parted(blocks: DataFrame) -> DataFrame:
        # a set's own blocks, light ones and heavy ones, both in the order of their keys
        if known is not None:
            return blocks.mapInArrow(_part(known), "digest long, band long, most long, whole boolean, light array<long>, "
                                                   "heavy array<long>")
        rows = blocks.select("digest", "band", "most", "whole", F.explode("keys").alias("key")).join(few(frequent), "key", "left")
        return rows.groupBy("digest", "band", "most", "whole").agg(
            F.sort_array(F.collect_list(F.when(F.col("is_heavy").isNull(), F.col("key")))).alias("light"),
            F.sort_array(F.collect_list(F.when(F.col("is_heavy"), F.col("key")))).alias("heavy"))

    blocks = entered(heavy)
    frequent = materialize(spark, blocks.select(F.explode("keys").alias("key")).groupBy("key").count().filter(
        F.col("count") > LIGHT).select("key", F.lit(True).alias("is_heavy")), "jaccard-frequent")
    # heavy keys, if they are few, come to the sets; else both meet by a shuffle
    known = None
    if frequent.count() <= graph.FEW_ROWS:
        known = spark.sparkContext.broadcast(np.sort(np.array([r.key for r in frequent.collect()], np.int64)))
    first = materialize(spark, parted(blocks), "jaccard-parted")
    lacking = first.filter("not whole and size(light) <= most").select("digest", F.lit(None).cast("long").alias("heavy")).distinct()
    all_of = entered(lacking)
    done = first.join(all_of.select("digest").distinct(), "digest", "left_anti").unionByName(parted(all_of))
    done = materialize(spark, done.select(
        "digest", F.size("light").alias("n_light"), F.slice("light", 1, F.col("most").cast("int") + 1).alias("light"),
        F.when(F.size("light") <= F.col("most"), F.slice("heavy", 1, F.greatest(
            F.lit(1), F.col("most").cast("int") + 1 - F.size("light")))).alias("heavy")), "jaccard-prefixes")
    discard(blocks, first, all_of)
    light = done.select(F.explode("light").alias("key"), "digest", "n_light")
    groups = light.select("key", "digest", F.lit(0).alias("hot")).repartition("key").sortWithinPartitions("key", "digest").mapInArrow(
        _groups, "members array<long>, heavy long, n long").filter("members is not null").select("members")
    # light keys that the sets entered last have made large are shared as the heavy ones are
    large = light.groupBy("key").count().filter(F.col("count") > LIGHT).select("key")
    shared = done.filter("heavy is not null").select(F.explode("heavy").alias("key"), "digest", "n_light").unionByName(
        light.join(large, "key", "left_semi").select("key", "digest", "n_light"))
    least = shared.groupBy("key").agg(F.min("digest").alias("least"))
    edges = shared.join(least, "key").select(F.col("digest").alias("u"), F.col("least").alias("v")).distinct()
    fewest = shared.groupBy(F.col("digest").alias("node")).agg(F.min("n_light").alias("light"))
    families = components(spark, edges).join(fewest, "node").select(
        F.col("label").alias("family"), F.col("node").alias("digest"), "light")
    return materialize(spark, groups.distinct(), "jaccard-light"), materialize(spark, families, "jaccard-families")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels.withColumnRenamed("node", "digest"), "digest", "left").withColumn(
        "label", F.coalesce("label", "digest"))


def _hubs(families: DataFrame) -> DataFrame:
    """Pairs of each family's hub, its set with fewest light blocks, with the family's sets of other components."""
    hub = families.groupBy("family").agg(F.min(F.struct("light", "digest", "label")).alias("hub")).select(
        "family", F.col("hub.digest").alias("l"), F.col("hub.label").alias("hub_label"))
    return families.join(hub, "family").filter("label <> hub_label").select("l", F.col("digest").alias("r"))


def ngram_jaccard(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs(doc_id, text, ...)`` to its members and its links.

    * members: one row per document: doc_id, text_hash, n_shingles, digest (the
      class: documents with equal sets), label (the component's least digest)
      and component_id, the least doc_id reachable by links;
    * links: verified links between classes (left_digest, right_digest,
      n_common, n_union). They connect every component; pairs inside a
      component that its links already connect need not be among them.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    profile, classes, seed = _profiles(texts, id_type)
    texts = texts.select("text")
    members = _of_kind(profile, "document", "doc_id", "text_hash", "digest", "n_shingles")

    meeting = materialize(spark, texts.mapInArrow(_joined_keys(seed), "key long, digest long, hot int")
                          .repartition("key").sortWithinPartitions("key", "digest")
                          .mapInArrow(_groups, "members array<long>, heavy long, n long"), "jaccard-meeting")
    groups = materialize(spark, meeting.select("members").filter("members is not null").distinct(), "jaccard-groups")
    # a set that several tasks hold may count a key in each: more than its number does no harm
    heavy = meeting.filter("heavy is not null").groupBy(F.col("heavy").alias("digest")).agg(F.sum("n").alias("heavy")).join(
        classes.select("digest", "need"), "digest").filter("heavy >= need").select("digest", "heavy")
    heavy = materialize(spark, heavy, "jaccard-heavy")
    discard(meeting)
    families = heavy.select(F.col("digest").alias("family"), "digest", F.lit(0).alias("light")).limit(0)
    if not heavy.isEmpty():
        more, families = _affected(texts, members, heavy, seed)
        groups = groups.union(more)

    release(spark)

    def verify(pairs: DataFrame) -> DataFrame:
        return _verify(pairs, classes, texts, members, seed)

    # one set of each group and family with the others
    own = families.withColumn("label", F.col("digest"))
    tried = groups.select(F.col("members")[0].alias("l"), F.explode(F.expr("slice(members, 2, size(members))")).alias("r"))
    links = verify(tried.union(_hubs(own)).distinct())
    labels = _components(spark, links)

    # members of different components of the groups; in families, a second hub
    places = groups.select(F.monotonically_increasing_id().alias("g"), "members")
    named = _labelled(places.select("g", F.explode("members").alias("digest")), labels)
    open_groups = named.groupBy("g").agg(F.collect_list(F.struct("digest", "label")).alias("m"),
                                         F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    cross = open_groups.select(F.explode(F.expr(
        "flatten(transform(m, (x, i) -> transform(filter(slice(m, i + 2, size(m)), y -> y.label <> x.label), "
        "y -> struct(least(x.digest, y.digest) as l, greatest(x.digest, y.digest) as r))))")).alias("p")).select("p.l", "p.r")
    labelled = _labelled(families, labels)
    first = _hubs(own).select("l").distinct().withColumnRenamed("l", "digest")
    outside = labelled.join(_labelled(first, labels).select("label").distinct(), "label", "left_anti")
    second = outside.groupBy("family").agg(F.min(F.struct("light", "digest", "label")).alias("hub")).select(
        "family", F.col("hub.digest").alias("l"), F.col("hub.label").alias("hub_label"))
    second = labelled.join(second, "family").filter("label <> hub_label").select("l", F.col("digest").alias("r"))
    more = verify(cross.union(second).distinct())
    if not more.isEmpty():
        links = links.union(more)
        labels = _components(spark, links)

    # all pairs of different components of a family that sizes and sketches allow
    left = _labelled(families, labels)
    several = left.groupBy("family").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n")).filter(
        "lo <> hi").select("family", F.ceil(F.col("n") / FAMILY_PART).cast("int").alias("parts"))
    if not several.isEmpty():
        open_sets = materialize(spark, left.join(several, "family").join(classes, "digest"), "jaccard-open")
        x = open_sets.select("family", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), F.col("digest").alias("l"),
                             F.col("label").alias("l_label"), F.col("n").alias("l_n"), F.col("sketch").alias("l_s"))
        y = open_sets.select("family", F.pmod("digest", "parts").cast("int").alias("part"), F.col("digest").alias("r"),
                             F.col("label").alias("r_label"), F.col("n").alias("r_n"), F.col("sketch").alias("r_s"))
        pairs = x.join(y, (x.family == y.family) & (x.part == y.part) & (F.col("l") < F.col("r"))
                       & (F.col("l_label") != F.col("r_label")) & F.expr(_SIZES) & F.expr(_NEAR)).select("l", "r")
        last = verify(pairs)
        if not last.isEmpty():
            links = links.union(last)
            labels = _components(spark, links)

    labelled = members.join(labels.withColumnRenamed("node", "digest"), "digest", "left").select(
        "doc_id", "text_hash", "digest", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("label", "digest")).alias("label"))
    least = labelled.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    members = materialize(spark, labelled.join(least, "label", "left").select(
        "doc_id", "text_hash", "n_shingles", "digest", "label",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id")), "jaccard-members")
    discard(profile, classes)
    return members, links


def _components(spark, links: DataFrame) -> DataFrame:
    return components(spark, links.select(F.col("left_digest").alias("u"), F.col("right_digest").alias("v")))


#: Whether sizes and sketches of l and r allow a link.
_SIZES = "5 * least(l_n, r_n) >= 4 * greatest(l_n, r_n)"
_NEAR = f"9 * ({_sketch_distance('if(l_n <= r_n, l_s, r_s)', 'if(l_n <= r_n, r_s, l_s)')}) <= l_n + r_n"


def _verify(tried: DataFrame, classes: DataFrame, texts: DataFrame, members: DataFrame, seed: int) -> DataFrame:
    """The pairs of classes ``tried(l, r)`` that link, written: sizes, then sketches, then the sets themselves, which are
    made again from the texts of those classes that are left."""
    spark = tried.sparkSession
    c = lambda side: classes.select(F.col("digest").alias(side), F.col("n").alias(f"{side}_n"),
                                    F.col("sketch").alias(f"{side}_s"))
    possible = materialize(spark, tried.join(c("l"), "l").join(c("r"), "r").filter(_SIZES).filter(_NEAR).select(
        "l", "r", "l_n", "r_n"), "jaccard-possible")
    left = possible.select(F.col("l").alias("digest")).union(possible.select("r")).distinct()
    sets = materialize(spark, _texts_of(texts, members, left).mapInArrow(
        _emit_sets(seed), "digest long, shingles array<long>").dropDuplicates(["digest"]), "jaccard-sets")
    s = lambda side: sets.select(F.col("digest").alias(side), F.col("shingles").alias(f"{side}_set"))
    common = F.size(F.array_intersect("l_set", "r_set")).cast("long")
    links = materialize(spark, possible.join(s("r"), "r").join(s("l"), "l")
                        .select(F.col("l").alias("left_digest"), F.col("r").alias("right_digest"), common.alias("n_common"),
                                (F.col("l_n") + F.col("r_n")).alias("total"))
                        .select("left_digest", "right_digest", "n_common", (F.col("total") - F.col("n_common")).alias("n_union"))
                        .filter("100 * n_common >= 80 * n_union"), "jaccard-links")
    discard(possible, sets)
    release(spark)
    return links


def one_per_component(docs: DataFrame) -> DataFrame:
    """Keep one row of each component (the least doc_id, null last; of its texts the least hash); the columns stay.

    It is decided per row: rows that share a doc_id but are linked with nothing
    both stay, and of equal rows, null doc_ids included, one stays. Documents
    without shingles are copies of nothing and all stay. Rows that differ only in
    other columns are told apart by those columns as JSON. Texts do not travel:
    the keys of the rows that go, and of rows that repeat, come to them.
    """
    members, _ = ngram_jaccard(docs)
    spark, key = docs.sparkSession, ["_no_id", "_id", "_text_hash"]
    row_key = lambda text_hash: {"_no_id": F.col("doc_id").isNull(),
                                 "_id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "_text_hash": text_hash}
    best = members.filter("n_shingles > 0").groupBy("label").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("b")).select(
        F.col("b.no_id").alias("_no_id"), F.coalesce(F.col("b.doc_id").cast("string"), F.lit("")).alias("_id"),
        F.col("b.text_hash").alias("_text_hash"), F.lit(True).alias("_best"))
    counted = members.filter("n_shingles > 0").withColumns(row_key(F.col("text_hash"))).groupBy(*key).count().join(
        best, key, "left")
    counted = materialize(spark, counted.filter("_best is null or count > 1"), "jaccard-rows")
    gone = counted.filter("_best is null").select(*key)
    again = counted.filter("_best").select(*key, F.lit(True).alias("_again"))
    kept = (docs.withColumns(row_key(F.xxhash64(F.col("text").cast("string")))).join(few(gone), key, "left_anti")
            .join(few(again), key, "left"))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = F.to_json(F.struct(*others)) if others else F.lit(0)
    # equal rows become one within their task before they are dealt out
    once = kept.filter("_again").groupBy(*key).agg(F.min_by(F.struct(*docs.columns), order).alias("row")).select("row.*")
    return kept.filter("_again is null").select(*docs.columns).union(once)
