"""Near-duplicate documents by an LSH forest over MinHash signatures.

Steps: (1) the set of word shingles of each document gives a set hash and a
signature; documents with equal sets are one class. (2) Every class stands in
several trees, each a different order of the signature values. A region is
all classes with one prefix in a tree; the classes of a crowded region take
longer prefixes, in more trees, until regions are small. A crowded region is
also sorted by its own order of all signature values and cut into slices, so
that each class meets the neighbours with which it shares the longest prefix,
and the region's hub. Members of a small region or a slice whose signatures
agree enough are candidates, kept as groups and not as pairs. (3) Candidates are
confirmed on the full shingle sets, in tasks of bounded size. (4) Links make
components; each document gets the least doc_id of its component.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelab.llm.common import HashCache, chunks, grouped, lowered_words, pick, row_uid, starts_of, stored, texts_of
from tablelab.llm.components import connected

WIDTH = 5
#: Links have 100 * intersection >= SHARE * union.
SHARE = 85
#: Signature values.
VALUES = 64
#: Trees and values in their region keys, level by level. Classes of a region with more than CROWD of them take
#: the next level too: deeper keys part the crowd, more trees make up for what a deeper key misses. A pair at a share
#: of 0.85 shares no region of the first level in 1 of 100,000 cases, of the next three in 1 of 10,000 or fewer.
LEVELS = ((16, 4), (64, 6), (128, 8), (256, 12), (256, 20), (1, 64))
CROWD = 2048
#: Likewise a region whose classes have more shingles (8 bytes each) together.
CROWD_SHINGLES = 6_000_000
#: A crowded region is cut into slices of a quarter of these bounds. So many of its members make its consensus.
SLICES, SAMPLED = 4, 512
#: Agreeing values that make a candidate. At a true share of 0.85 fewer occur in 3 of 100,000 pairs.
AGREE = 43
#: The same for a share of 0.8: 21 disjoint trees of three values miss a pair in 3 of 10,000,000 cases, later levels in
#: 1 of 100,000 or fewer, and fewer values agree in 2 of 100,000 pairs.
SHARE_80, AGREE_80 = 80, 37
LEVELS_80 = ((21, 3), (64, 6), (128, 8), (256, 12), (512, 16), (1, 64))

_ODD = np.random.default_rng(20240229).integers(1, 1 << 63, 64 + WIDTH, dtype=np.uint64) | np.uint64(1)
_SHIFT = np.random.default_rng(7).integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32)

_hashes = HashCache()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; empty without words."""
    words = lowered_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(codes) - width + 1)
    sums = np.zeros(n, np.uint64)
    for i in range(min(width, len(codes))):
        sums += codes[i : i + n] * _ODD[VALUES + i]
    if len(codes) < width:
        sums += np.uint64(len(codes))
    return np.unique(_mixed(sums))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (sets x VALUES, 32 bits) of non-empty sets."""
    starts = starts_of(map(len, sets))[:-1]
    low = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), VALUES), np.uint32)
    for v in range(VALUES):
        out[:, v] = np.minimum.reduceat(low * np.uint32(_ODD[v] & np.uint64(0xFFFFFFFF)) ^ _SHIFT[v], starts)
    return out


def _sketch(batches):
    for batch in chunks(batches):
        sets = [shingle_set(t) for t in texts_of(batch)]
        full = [i for i, s in enumerate(sets) if len(s)]
        prints: list = [None] * len(sets)
        signed: list = [None] * len(sets)
        if full:
            for i, row in zip(full, signatures([sets[i] for i in full])):
                prints[i], signed[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest(), row.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("uid"), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), pa.array(signed, pa.binary())],
            names=["doc_id", "uid", "n", "fp", "sig"],
        )


def orders(level: int, levels: tuple = LEVELS) -> np.ndarray:
    """Signature positions (trees x depth) that make the region keys of a level.

    The first level's trees take disjoint positions. Later ones draw other
    orders of all positions.
    """
    trees, depth = levels[level]
    if not level:
        return np.arange(trees * depth).reshape(trees, depth) % VALUES
    draw = np.random.default_rng(1000 + depth)
    return np.stack([np.sort(draw.permutation(VALUES)[:depth]) for _ in range(trees)])


def _place(level: int, levels: tuple = LEVELS):
    """Rows of each class in each tree of a level, with the key of its region."""
    places = orders(level, levels)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, VALUES)
            short = pa.array([x.tobytes() for x in sig.astype(np.uint8)], pa.binary())
            for tree, own in enumerate(places):
                key = np.full(len(sig), (tree + 1) * 1_000_003 + len(own), np.uint64)
                for i in own:
                    key = _mixed(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, i].astype(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *[batch.column(c) for c in ("fp", "uid", "n")], short], names=["key", "fp", "uid", "n", "sig8"])

    return run


PLACED = "key long, fp binary, uid long, n long, sig8 binary"
#: A member of a group of candidates. Equal groups of several trees have the same task.
MEMBERS = "task long, fp binary, uid long, n long, sig8 binary"


def _near(sig: np.ndarray, n: np.ndarray, i: int, others: np.ndarray, share: int, agree: int) -> np.ndarray:
    """Those of ``others`` whose signature and size agree with row ``i`` enough to be a candidate."""
    sizes = 100 * np.minimum(n[others], n[i]) >= share * np.maximum(n[others], n[i])
    return others[sizes & ((sig[others] == sig[i]).sum(1) >= agree)]


def _candidate_groups(region: pa.Table, share: int, agree: int) -> pa.RecordBatch | None:
    """Members of each group of candidates (two or more) among the rows.

    The candidates are not listed as pairs: what leaves is one row per class
    that has a partner, whatever the number of its partners.
    """
    prints = region.column("fp").to_pylist()
    n = region.column("n").to_numpy()
    sig = _rows_of(region.column("sig8"))
    waiting = np.ones(len(n), bool)
    rows, tasks = [], []
    for first in range(len(n)):
        if not waiting[first]:
            continue
        waiting[first] = False
        group, at = [first], 0
        while at < len(group):
            more = _near(sig, n, group[at], np.flatnonzero(waiting), share, agree)
            waiting[more] = False
            group += more.tolist()
            at += 1
        if len(group) > 1:
            task = xxhash.xxh64_intdigest(b"".join(sorted(prints[i] for i in group))) - (1 << 63)
            rows += group
            tasks += [task] * len(group)
    if not rows:
        return None
    own = region.take(pa.array(rows)).combine_chunks()
    return pa.RecordBatch.from_arrays([pa.array(tasks, pa.int64()), *[own.column(c).combine_chunks() for c in ("fp", "uid", "n", "sig8")]], names=["task", "fp", "uid", "n", "sig8"])


def _region_groups(share: int, agree: int):
    """Groups of candidates of each region in a stream sorted by key."""

    def run(batches):
        for region in grouped(batches, "key"):
            if region.num_rows > 1 and (out := _candidate_groups(region, share, agree)):
                yield out

    return run


def _rows_of(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, VALUES)


def _consensus(batches):
    """Most frequent value of each signature position per region, in a stream sorted by key."""
    for region in grouped(batches, "key"):
        sig = _rows_of(region.column("sig8"))
        most = np.array([np.bincount(sig[:, v]).argmax() for v in range(VALUES)], np.uint8)
        yield pa.RecordBatch.from_arrays([region.column("key").combine_chunks()[:1], pa.array([most.tobytes()], pa.binary())], names=["key", "centre"])


def _agreement(other: str, ordered: bool = False):
    """Adds ``same``, the values that agree with signature ``other``, and ``place``, the signature in the region's own order."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = _rows_of(batch.column("sig8"))
            same = (sig == _rows_of(batch.column(other))).sum(1)
            columns = [*batch.columns, pa.array(same.astype(np.int32))]
            if ordered:
                keys = batch.column("key").to_numpy()
                place = np.empty_like(sig)
                for key in np.unique(keys):
                    own = keys == key
                    place[own] = sig[own][:, np.random.default_rng(int(key) & (1 << 63) - 1).permutation(VALUES)]
                columns.append(pa.array([x.tobytes() for x in place], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "same", *["place"] * ordered])

    return run


HUB = ("fp", "uid", "n", "sig8")


def _slice_groups(share: int, agree: int, most: int, load: int):
    """Groups of candidates of each slice, the region's hub among them, in a stream sorted by key and place.

    A slice ends at ``most`` members or ``load`` shingles; the next one begins with its last member.
    """

    def run(batches):
        for region in grouped(batches, "key"):
            members = region.select(HUB)
            hub = pa.table([region.column(f"hub_{c}")[:1] for c in HUB], schema=members.schema)
            sums = np.cumsum(region.column("n").to_numpy())
            low = 0
            while low < len(sums):
                high = max(low + 2, min(low + most, int(np.searchsorted(sums, load + (sums[low - 1] if low else 0), "right"))))
                part = members.slice(low, high - low)
                if hub.column("fp")[0].as_py() not in part.column("fp").to_pylist():
                    part = pa.concat_tables([hub, part])
                if part.num_rows > 1 and (out := _candidate_groups(part, share, agree)):
                    yield out
                low = high - 1 if high < len(sums) else len(sums)

    return run


def _crowd_ties(dense: DataFrame, share: int, agree: int) -> DataFrame:
    """The members of crowded regions (PLACED and m) with their region's hub, ``same`` and ``place``.

    The hub is the member nearest to the consensus of the region: among edits
    of one text it is the text itself or one that has its signature.
    """
    step = F.greatest(F.lit(1), F.ceil(F.col("m") / SAMPLED))
    drawn = dense.where(F.pmod(F.xxhash64("fp"), step) == 0).repartition("key").sortWithinPartitions("key")
    centres = stored(drawn.mapInArrow(_consensus, "key long, centre binary"), "centres")
    kinds = "key long, fp binary, uid long, n long, sig8 binary"
    near = dense.select("key", *HUB).join(centres, "key").mapInArrow(_agreement("centre"), f"{kinds}, centre binary, same int")
    # The least print among equals, so that all regions around one text choose the same hub.
    hubs = near.groupBy("key").agg(F.min(F.struct((-F.col("same")).alias("far"), *HUB)).alias("hub"))
    hubs = stored(hubs.select("key", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in HUB]), "hubs")
    tied = dense.select("key", *HUB).join(hubs, "key")
    return tied.mapInArrow(_agreement("hub_sig8", True), f"{kinds}, hub_fp binary, hub_uid long, hub_n long, hub_sig8 binary, same int, place binary")


def candidates(classes: DataFrame, share: int = SHARE, agree: int = AGREE, crowd: int = CROWD, levels: tuple = LEVELS) -> DataFrame:
    """Members of groups of classes (fp, uid, n, sig) among which links are sought.

    The number of rows per class is bounded; only classes of crowded regions take more than the first level's.
    """
    rows = classes.select("fp", "uid", "n", "sig").mapInArrow(_place(0, levels), PLACED)
    found: list[DataFrame] = []
    seen: list[DataFrame] = []
    for level in range(len(levels)):
        size = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("load"))
        crowded = stored(size.where((F.col("m") > crowd) | ((F.col("load") > CROWD_SHINGLES) & (F.col("m") > 2))).select("key", "m"), "crowded")
        none = crowded.isEmpty()
        settled = rows if none else rows.join(crowded, "key", "left_anti")
        found.append(settled.repartition("key").sortWithinPartitions("key").mapInArrow(_region_groups(share, agree), MEMBERS))
        if none:
            break
        dense = stored(rows.join(crowded, "key"), "dense")
        ties = stored(_crowd_ties(dense, share, agree), "ties")
        # Whoever agrees with a hub meets it once, in one slice; the others stand in the slices of all their regions.
        close = F.col("same") >= agree
        once = ties.where(close)
        for earlier in seen:
            once = once.join(earlier, ["hub_fp", "fp"], "left_anti")
        once = stored(once.groupBy("hub_fp", "fp").agg(F.min(F.struct(*[c for c in ties.columns if c not in ("hub_fp", "fp")])).alias("x")).select("hub_fp", "fp", "x.*"), "once")
        seen.append(once.select("hub_fp", "fp"))
        sliced = once.select(*ties.columns).unionByName(ties.where(~close))
        sliced = sliced.repartitionByRange("key", "place", "fp").sortWithinPartitions("key", "place", "fp")
        found.append(sliced.mapInArrow(_slice_groups(share, agree, max(2, crowd // SLICES), CROWD_SHINGLES // SLICES), MEMBERS))
        if level + 1 < len(levels):
            again = stored(classes.select("fp", "uid", "n", "sig").join(dense.select("fp").distinct(), "fp", "left_semi"), "again")
            rows = again.mapInArrow(_place(level + 1, levels), PLACED)
    groups = found[0]
    for more in found[1:]:
        groups = groups.unionByName(more)
    return groups.distinct()


def _linked(sets: list[np.ndarray], sig: np.ndarray, n: np.ndarray, share: int, agree: int) -> list[tuple[int, int]]:
    """Links that tie together what the exact overlaps tie together, among all candidates of a group.

    A candidate whose two sides already hang together is not counted again.
    The overlaps of one row with all its open partners are counted at once.
    """
    label = np.arange(len(sets))
    links = []
    starts = starts_of(map(len, sets))
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    mark = np.zeros(int(number.max()) + 1, np.int32)
    for i in range(len(sets) - 1):
        after = np.arange(i + 1, len(sets))
        if len(sets) > 2:
            after = _near(sig, n, i, after[label[after] != label[i]], share, agree)
        if not len(after):
            continue
        own = number[starts[i] : starts[i + 1]]
        mark[own] = 1
        seen = np.concatenate([number[starts[j] : starts[j + 1]] for j in after])
        both = np.add.reduceat(mark[seen], starts_of(n[after].tolist())[:-1])
        mark[own] = 0
        for j in after[100 * both >= share * (n[i] + n[after] - both)].tolist():
            if label[j] != label[i]:
                links.append((i, j))
                label[label == label[j]] = label[i]
    return links


def _confirm(share: int, agree: int):
    """Links of each group; the members with their texts come in one run of the stream."""

    def links_of(members: dict[bytes, tuple]) -> pa.RecordBatch | None:
        prints = list(members)
        sets = [shingle_set(members[p][1] or "") for p in prints]
        sig = np.frombuffer(b"".join(members[p][0] for p in prints), np.uint8).reshape(-1, VALUES)
        links = _linked(sets, sig, np.array(list(map(len, sets)), np.int64), share, agree)
        if not links:
            return None
        return pa.RecordBatch.from_arrays([pa.array([prints[x[k]] for x in links], pa.binary()) for k in (0, 1)], names=["a", "b"])

    def run(batches):
        last, members = None, {}
        for batch in batches:
            for task, own, sig, text in zip(*[batch.column(c).to_pylist() for c in ("task", "fp", "sig8", "text")]):
                if task != last:
                    if len(members) > 1 and (out := links_of(members)):
                        yield out
                    last, members = task, {}
                members.setdefault(own, (sig, text))
        if len(members) > 1 and (out := links_of(members)):
            yield out

    return run


def confirmed(groups: DataFrame, texts: DataFrame, share: int = SHARE, agree: int = AGREE) -> DataFrame:
    """Links (a, b) of classes whose full shingle sets overlap enough, as many as tie each group together.

    Every candidate of a group is held against the full sets unless earlier
    links already join its sides. A group's texts meet in one task; groups are
    bounded by the size of a region. ``texts`` has uid and text.
    """
    stream = texts.join(groups, "uid").select("task", "fp", "sig8", "text")
    return stream.repartition("task").sortWithinPartitions("task").mapInArrow(_confirm(share, agree), "a binary, b binary")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE, agree: int = AGREE, crowd: int = CROWD, levels: tuple = LEVELS) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least doc_id of its component), kept, uid (hash of id and text).

    Words are runs without ASCII white space, A-Z in lower case; the set of a
    row is its distinct shingles of five words, with fewer words the whole
    sequence. Rows with equal sets are linked, others by
    ``100 * intersection >= share * union``. Null and empty texts have no
    shingles, are linked with nothing and kept. Rows that repeat a doc_id are
    rows of their own; identical rows are all ``kept`` if their id is the
    least one. A null doc_id counts as larger than every other; a component of
    null ids alone has component_id null and is kept.
    """
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("uid", row_uid("doc_id", "text"))
    schema = T.StructType([rows.schema["doc_id"], rows.schema["uid"], T.StructField("n", T.LongType()), T.StructField("fp", T.BinaryType()), T.StructField("sig", T.BinaryType())])
    sketch = stored(rows.mapInArrow(_sketch, schema), "sketch")
    by_set = sketch.where("fp IS NOT NULL").groupBy("fp")
    classes = by_set.agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid")).alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    classes = stored(classes.select("fp", "n", "sig", F.col("rep.doc_id").alias("doc_id"), F.col("rep.uid").alias("uid")), "classes")
    links = confirmed(candidates(classes, share, agree, crowd, levels), rows.select("uid", "text"), share, agree)
    nodes = connected(links, "links")
    member = classes.select("fp", F.col("doc_id").alias("least")).join(nodes, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    roots = member.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = stored(member.join(roots, "root").select(F.col("fp").alias("own"), "component_id"), "members")
    out = sketch.select("doc_id", "uid", "n", "fp").join(ids, F.col("fp") == F.col("own"), "left")
    least = F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), least.alias("component_id"), F.col("doc_id").eqNullSafe(least).alias("kept"), "uid")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = SHARE, agree: int = AGREE, levels: tuple = LEVELS) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns; identical rows (id and text) count as one.

    For another ``share``, ``agree`` and ``levels`` must be sized for it.
    """
    names = docs.columns
    verdict = stored(near_duplicates(docs, doc_id, text, share, agree, levels=levels).select("uid", "kept"), "verdict")
    rows = docs.toDF(*[f"_{i}" for i in range(len(names))])
    rows = rows.withColumn("uid", row_uid(F.col(f"_{names.index(doc_id)}"), F.col(f"_{names.index(text)}")))
    kept = verdict.where("kept").select("uid").distinct()
    left = rows.join(kept, "uid", "left_semi")
    repeated = stored(verdict.groupBy("uid").count().where("count > 1").select("uid"), "repeated")
    if not repeated.isEmpty():
        # Identical rows combine within their tasks before they meet.
        once = rows.join(repeated, "uid", "left_semi").join(kept, "uid", "left_semi").dropDuplicates(["uid"])
        left = left.join(repeated, "uid", "left_anti").unionByName(once)
    return left.drop("uid").toDF(*names)
