"""Similarity self-join of documents as sets of word n-grams, by set-relation skipping.

Two sets of sizes n and m link when ``q * intersection >= p * union`` (p / q is the threshold). Linked sets
then differ in at most ``(n + m)(q - p) / (q + p)`` members, and their sizes in a factor of q / p.

Index lists. The members of a set, in hash order, are cut at fixed hash positions into more blocks than
linked sets can differ in, so linked sets agree in at least one whole block, at the same position. An index
list holds the sets with one block content at one position of one size band; lists whose block differs are
skipped without a look, and a list with one set is dropped. Shingles that a share of ``COMMON`` of a batch's
documents hold are left out of the blocks (of both sets, so linked sets still agree). Blocks of at most
``weak`` members say little: ``slack`` blocks are added, and a set may leave so many unindexed; a set with
more of them also enters lists of blocks with the common shingles left in, among others of its kind.

Answers. Equal sets are one class. The sets of a list are compared with its hub, the least; from a hub's
answers those of the sets near it follow by their few differences:
``|x & y| = |h| - |Rx| - |Ry| + |Rx & Ry| + |Ax & Ay|`` with R and A what a set lacks and adds against the
hub. After the links so found are joined to components, lists whose sets are all in one component need
nothing more; in the others the sets of different components are compared in blocks, and only links that join
components leave a task: no link between different sets is lost, and no group is expanded into its pairs. Before sets travel, four bits for each of
``1.5 * (differing members) + 4`` blocks tell pairs apart: all but as many blocks as the sets may differ in
must be equal.

Lists are made in two steps: each task keeps, of the sets that share a list within a slice, the least as
the list's entry, and sends on only that; a group of copies or near copies that holds a third of all rows
comes down to one entry for each slice.

Defined results: a null, empty or wordless text has the empty set: 0 shingles, linked with nothing, its own
component. Repeated rows are each returned. Rows without an id get no component. Columns besides doc_id and
text are not read. Shingles are 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import tokens as tk
from sluice.llm.components import components
from sluice.llm.tables import map_batches, split_by, staged, table

_U = np.uint64
_M1, _M2 = _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9)
BAND = 1.5
LIST_ENTRIES = 500_000
#: Sets, and bytes of them, of one block of a list or family.
BLOCK_SETS = 1024
BLOCK_BYTES = 16 << 20
#: A shingle is common if this share of all documents hold it. So at most (mean set size) / COMMON shingles
#: are: a bound for their broadcast that does not grow with the input.
COMMON = 1e-3
LEAST_COMMON = 8
#: Rows, and shingles of them (8 bytes each), over which a task counts frequent shingles.
STRETCH_ROWS = 10_000
STRETCH_SHINGLES = 1 << 22


class Bands:
    """Size bands and the blocks that the sets of each are cut into."""

    def __init__(self, p: int, q: int):
        self.p, self.q = p, q
        tops = [max(1, (q + p - 1) // (2 * (q - p)))]  # up to here linked sets are equal
        while tops[-1] < 1 << 40:
            tops.append(max(tops[-1] + 1, int(tops[-1] * BAND)))
        self.tops = np.array(tops, dtype=np.int64)
        differ = 2 * self.tops * (q - p) // (q + p)
        wide = (q + p) / (2 * (q - p) * BAND) >= 5  # members of a block of the smallest sets of a band
        self.weak = 1 if wide else 0
        self.slack = 1 + differ // (16 if wide else 10)
        self.blocks = differ + 1 + self.slack
        self.blocks[0] = 0
        self.marks = differ + differ // 2 + 4

    def own(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.tops, size)

    def may_differ(self, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        return (n + m) * (self.q - self.p) // (self.q + self.p)

    def of(self, size: np.ndarray) -> list[np.ndarray]:
        """The bands in which sets of these sizes have an entry: their own and those of larger partners
        (-1: none)."""
        own = self.own(size)
        highest = np.searchsorted(self.tops, size * self.q // self.p)
        return [np.where(own + up <= highest, own + up, -1)
                for up in range(int((highest - own).max(initial=0)) + 1)]


def digests(row: np.ndarray, hashed: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two 64-bit digests of each row's set (0 for the empty set)."""
    size = np.bincount(row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(size)])
    out = []
    for salt in (_M1, _M2):
        total = np.concatenate([np.zeros(1, _U), np.cumsum(tk.mix(hashed ^ salt))])
        out.append(np.where(size > 0, tk.mix(total[first[1:]] - total[first[:-1]] + size.astype(_U) * salt), _U(0)))
    return size, out[0], out[1]


def _blocks(row: np.ndarray, hashed: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members and their summed digest of every block, of sets cut into ``count`` blocks each."""
    start = np.cumsum(count) - count
    slot = start[row] + (((hashed >> _U(32)) * count[row].astype(_U)) >> _U(32)).astype(np.int64)
    held = np.bincount(slot, minlength=int(count.sum()))
    running = np.concatenate([np.zeros(1, _U), np.cumsum(tk.mix(hashed ^ _M2))])
    at = np.concatenate([[0], np.cumsum(held)])
    return held, running[at[1:]] - running[at[:-1]]


def entries(row: np.ndarray, hashed: np.ndarray, size: np.ndarray, bands: Bands,
            common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(list, set) of every indexed block of the sets of a slice."""
    lists, owners = [], []
    if len(common):
        at = np.minimum(np.searchsorted(common, hashed), len(common) - 1)
        rare = common[at] != hashed
    else:
        rare = np.ones(len(hashed), dtype=bool)
    for band in bands.of(size):
        count = np.where((band >= 0) & (size > 0), bands.blocks[band], 0)
        if not count.any():
            continue
        slack = bands.slack[band]
        set_of, place = tk.spread(count)
        stamp = band[set_of].astype(_U) * _M2 + place.astype(_U) * _U(0x9E3779B97F4A7C15)

        def add(keep, held, summed, kind, set_of=set_of, stamp=stamp):
            key = tk.mix(summed[keep] + held[keep].astype(_U) * _M1 + stamp[keep] + _U(kind))
            lists.append(key & ~_U(1) | band[set_of[keep]].astype(_U) & _U(1))  # the band's parity, for its marks
            owners.append(set_of[keep])

        use = rare & (count[row] > 0)
        held, summed = _blocks(row[use], hashed[use], count)
        weak = held <= bands.weak
        add(~weak, held, summed, 0)
        many = np.bincount(set_of[weak], minlength=len(size)) > slack
        if many.any():
            use = many[row] & (count[row] > 0)
            held, summed = _blocks(row[use], hashed[use], np.where(many, count, 0))
            some = many[set_of]
            full_held, full_sum = np.zeros(len(set_of), dtype=np.int64), np.zeros(len(set_of), dtype=_U)
            full_held[some], full_sum[some] = held, summed
            add(some, full_held, full_sum, 1)
    if not lists:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    return np.concatenate(lists), np.concatenate(owners)


def marks(hashed: np.ndarray, blocks: int) -> bytes:
    """Four bits for the content of each block of one set."""
    held, summed = _blocks(np.zeros(len(hashed), dtype=np.int64), hashed, np.array([blocks + blocks % 2]))
    four = tk.mix(summed + held.astype(_U)).astype(np.uint8) & 15
    return (four[::2] | four[1::2] << 4).tobytes()


def marks_differ(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Blocks whose marks differ, along the last axis."""
    z = x ^ y
    return np.count_nonzero(z & 15, axis=-1) + np.count_nonzero(z >> 4, axis=-1)


def _sorted(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (list, node), in order."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    keep = np.ones(len(key), dtype=bool)
    keep[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    return key[keep], node[keep]


def _heads(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For entries sorted by list and node: which are their list's first, and each one's first node."""
    head = np.ones(len(key), dtype=bool)
    head[1:] = key[1:] != key[:-1]
    hub = node[np.flatnonzero(head)][np.cumsum(head) - 1] if len(key) else node
    return head, hub


def _sets(column, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for first, last, raw, offs in tk.text_slices(column):
        yield first, last, *tk.shingles_of(tk.words_of(raw, offs, tk.IS_SPACED), size)


def _frequent(seen: list[np.ndarray], least: float) -> list[dict[str, int]]:
    """The shingles that are ``least`` times or more in ``seen``, a sixteenth of all hashes at a time."""
    out = []
    for part in range(16):
        some = np.sort(np.concatenate([x[x >> _U(60) == _U(part)] for x in seen]))
        cut = np.flatnonzero(np.concatenate([[True], some[1:] != some[:-1]])) if len(some) else np.zeros(0, np.int64)
        held = np.diff(np.concatenate([cut, [len(some)]])).astype(np.int64) if len(some) else cut
        many = held >= least
        out += [{"shingle": int(x), "held": int(k)} for x, k in
                zip(some[cut[many]].view(np.int64), held[many], strict=True)]
    return out


def describe(documents: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles and the set's digests c1, c2 of each row; ``often`` holds, on the first row of a
    stretch of at most about ``STRETCH_ROWS`` rows or ``STRETCH_SHINGLES``, the shingles that are frequent in the
    stretch, and in how many of its rows."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def described(ids, parts, seen):
        n, c1, c2 = (np.concatenate(x) for x in zip(*parts, strict=True))
        often = [None] * len(n)
        often[0] = _frequent(seen, max(LEAST_COMMON, COMMON / 2 * len(n)))
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(ids), pa.array(n.astype(np.int64)), pa.array(c1.view(np.int64)),
             pa.array(c2.view(np.int64)),
             pa.array(often, pa.list_(pa.struct([("shingle", pa.int64()), ("held", pa.int64())])))],
            names=["doc_id", "n_shingles", "c1", "c2", "often"])

    def run(batches):
        ids, parts, seen, rows, held = [], [], [], 0, 0
        for batch in batches:
            for first, last, row, hashed in _sets(batch.column("text"), size):
                ids.append(batch.column("doc_id").take(pa.array(np.arange(first, last))))  # a slice would keep the batch
                parts.append(digests(row, hashed, last - first))
                seen.append(hashed)
                rows, held = rows + last - first, held + len(hashed)
                if rows >= STRETCH_ROWS or held >= STRETCH_SHINGLES:
                    yield described(ids, parts, seen)
                    ids, parts, seen, rows, held = [], [], [], 0, 0
        if parts:
            yield described(ids, parts, seen)

    return map_batches(
        documents.select("doc_id", "text"), run,
        f"doc_id {kind}, n_shingles long, c1 long, c2 long, often array<struct<shingle: long, held: long>>")


def common_shingles(described: DataFrame) -> np.ndarray:
    """The shingles held by a share of ``COMMON`` of the documents, sorted."""
    least = max(LEAST_COMMON, COMMON * described.count())
    rows = (described.where("often is not null").select(F.explode("often").alias("o"))
            .groupBy("o.shingle").agg(F.sum("o.held").alias("held")).where(F.col("held") >= least)
            .select("shingle").toPandas())
    return np.sort(rows["shingle"].to_numpy(dtype=np.int64).view(_U))


def index_lists(documents: DataFrame, size: int, bands: Bands, total: int, common) -> DataFrame:
    """(list, hub, node): the sets, by first digest, of every index list of two sets or more. Within a list
    each node has a hub, and hubs have the list's least node as theirs. ``common``: a broadcast array."""
    parts = max(1, math.ceil(total * 4 * (bands.q - bands.p) / (bands.q + bands.p) / LIST_ENTRIES))

    def send(batches):
        for batch in batches:
            for first, last, row, hashed in _sets(batch.column("text"), size):
                n, c1, _ = digests(row, hashed, last - first)
                key, owner = entries(row, hashed, n, bands, common.value)
                # a list is known by its part and 32 bits more: a chance meeting costs a comparison
                key, node = _sorted((key >> _U(32)) % _U(parts) << _U(32) | key & _U(0xFFFFFFFF), c1[owner])
                head, hub = _heads(key, node)
                part = np.where(head, key >> _U(32), (node >> _U(32)) % _U(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                held, cuts = np.unique(part[order], return_index=True)  # the slice's parts, not all there are
                out = list(zip(held.tolist(), np.split(order, cuts[1:]), strict=True)) if len(order) else []
                low = key.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in out], pa.int32()),
                     *(pa.array([x[at][~head[at]].tobytes() for _, at in out], pa.binary()) for x in (key, hub, node)),
                     *(pa.array([x[at][head[at]].tobytes() for _, at in out], pa.binary()) for x in (low, node))],
                    names=["part", "list", "hub", "node", "head_list", "head_node"])

    def meet(group: pa.Table) -> pa.Table:
        """The sets that a slice has found together go on; the slices' heads meet."""
        kinds = {"head_list": np.uint32}
        cols = {c: np.frombuffer(b"".join(group.column(c).to_pylist()), dtype=kinds.get(c, _U))
                for c in group.schema.names[1:]}
        part = _U(group.column("part")[0].as_py())
        key, node = _sorted(cols["head_list"].astype(_U) | part << _U(32), cols["head_node"])
        head, hub = _heads(key, node)
        out = [np.concatenate([cols["list"], key[~head]]), np.concatenate([cols["hub"], hub[~head]]),
               np.concatenate([cols["node"], node[~head]])]
        return pa.table([pa.array(x.view(np.int64)) for x in out], names=["list", "hub", "node"])

    packed = map_batches(
        documents.select("text"), send,
        "part int, list binary, hub binary, node binary, head_list binary, head_node binary")
    return packed.groupBy("part").applyInArrow(meet, "list long, hub long, node long")


def _links(batches, bands: Bands):
    """Links among the hubs and nodes of each batch: every node against its hub, and the nodes that aren't
    linked with their hub against the others of that hub, by their differences."""
    p, q = bands.p, bands.q

    def linked(both, n, m):
        return q * both >= p * (n + m - both)

    for batch in batches:
        a, b = [], []
        hubs, nodes = (batch.column(c).to_pylist() for c in ("hub_doc", "doc"))
        of, own = batch.column("hub_set"), batch.column("set")
        start = 0
        while start < len(hubs):
            stop = start
            while stop < len(hubs) and hubs[stop] == hubs[start]:
                stop += 1
            hub = np.frombuffer(of[start].as_buffer(), dtype=_U)
            near = []
            for i in range(start, stop):
                x = np.frombuffer(own[i].as_buffer(), dtype=_U)
                at = np.minimum(np.searchsorted(hub, x), len(hub) - 1)
                have = hub[at] == x
                both = int(have.sum())
                ok = linked(both, len(hub), len(x))
                if ok:
                    a.append(hubs[start])
                    b.append(nodes[i])
                near.append((i, len(x), ok, x[~have], len(hub) - both, at[have]))
            apart = [e for e in near if not e[2]]
            if apart and stop - start > 2:
                sizes = np.array([e[1] for e in near])
                lacks = np.array([e[4] for e in near])
                adds = np.array([len(e[3]) for e in near])
                for i, n, _, added, lack, had in apart:
                    most = len(hub) - np.maximum(lack, lacks) + np.minimum(len(added), adds)
                    for k in np.flatnonzero(linked(most, n, sizes)):
                        j, m, done, added_j, lack_j, had_j = near[k]
                        if nodes[j] == nodes[i] or (not done and j < i):
                            continue
                        lacked = np.setdiff1d(np.arange(len(hub)), had, assume_unique=True)
                        lacked_j = np.setdiff1d(np.arange(len(hub)), had_j, assume_unique=True)
                        both = (len(hub) - lack - lack_j + len(np.intersect1d(lacked, lacked_j, assume_unique=True))
                                + len(np.intersect1d(added, added_j, assume_unique=True)))
                        if linked(both, n, m):
                            a.append(nodes[i])
                            b.append(nodes[j])
            start = stop
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _promising(batches, bands: Bands):
    """The pairs whose marks leave room for a link."""
    for batch in batches:
        limit = bands.may_differ(batch.column("n").to_numpy(), batch.column("hub_n").to_numpy())
        keep = []
        for x, y, most in zip(batch.column("marks"), batch.column("hub_marks"), limit, strict=True):
            x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint8) for v in (x, y))
            keep.append(len(x) == len(y) and bool(marks_differ(x, y) <= most))
        yield batch.select(["hub_doc", "doc"]).filter(pa.array(keep, pa.bool_()))


class _Joined:
    """Union-find over the labels of one group."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.find(x)] = self.find(y)


def _pairs_apart(group: pa.Table, bands: Bands, joined: _Joined) -> Iterator[tuple[int, int]]:
    """Rows of two blocks of sets, of labels not joined so far, whose marks leave room for a link."""
    col = {c: group.column(c).to_numpy() for c in ("label", "n", "own", "i", "j")}
    if "marks" in group.schema.names:  # of a list: all in its band's marks, but for lists that met by chance
        own = [np.frombuffer(x.as_buffer(), np.uint8) for x in group.column("marks")]
        length = np.array([len(x) for x in own])
        parts = [(np.flatnonzero(length == size), own, None) for size in np.unique(length)]
    else:  # of a family: pairs by the band of the larger set; linked sets are at most one band apart
        band = group.column("band").to_numpy()
        parts = []
        for top in np.unique(band):
            at = np.flatnonzero((band == top) | (band == top - 1))
            parts.append((at, {k: np.frombuffer(group.column(f"marks{top - int(band[k])}")[int(k)].as_buffer(),
                                                np.uint8) for k in at}, band == top))
    for at, own, is_top in parts:
        sigs = np.stack([own[k] for k in at])
        label, n, place = (col[c][at] for c in ("label", "n", "own"))
        top = np.ones(len(at), dtype=bool) if is_top is None else is_top[at]
        for k in range(len(at) - 1):
            fits = ((label != label[k]) & (top | top[k])
                    & (bands.q * np.minimum(n, n[k]) >= bands.p * np.maximum(n, n[k])))
            fits[:k + 1] = False
            if col["i"][0] != col["j"][0]:
                fits &= place != place[k]
            other = np.flatnonzero(fits)
            if len(other):
                differ = marks_differ(sigs[other], sigs[k])
                for o in other[differ <= bands.may_differ(n[other], n[k])]:
                    if joined.find(int(label[k])) != joined.find(int(label[o])):
                        yield int(at[k]), int(at[o])


def _families(group: pa.Table, bands: Bands) -> pa.Table:
    """Of the components in two blocks of a list: edges that connect those which may be linked."""
    group, joined, out = group.combine_chunks(), _Joined(), []
    label = group.column("label").to_numpy()
    for x, y in _pairs_apart(group, bands, joined):
        joined.join(int(label[x]), int(label[y]))
        out.append((int(label[x]), int(label[y])))
    return pa.table([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())],
                    names=["a", "b"])


def _settled(group: pa.Table, bands: Bands) -> pa.Table:
    """Of two blocks of sets of a family: links that join its components, each pair compared whole."""
    group, joined, out = group.combine_chunks(), _Joined(), []
    doc, label = group.column("doc").to_numpy(), group.column("label").to_numpy()
    sets = [np.frombuffer(x.as_buffer(), dtype=_U) for x in group.column("set")]
    for x, y in _pairs_apart(group, bands, joined):
        both = int(np.isin(sets[x], sets[y], assume_unique=True).sum())
        if bands.q * both >= bands.p * (len(sets[x]) + len(sets[y]) - both):
            joined.join(int(label[x]), int(label[y]))
            out.append((int(doc[x]), int(doc[y])))
    return pa.table([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())],
                    names=["a", "b"])


def _in_blocks(rows: DataFrame, by: str) -> DataFrame:
    """Rows of a group cut into blocks, each row once for every pair of blocks (i, j) it is part of."""
    sizes = rows.groupBy(by).agg(F.count("*").alias("rows_"), F.sum("bytes_").alias("size_"))
    cuts = sizes.select(by, F.ceil(F.greatest(F.col("rows_") / BLOCK_SETS, F.col("size_") / BLOCK_BYTES))
                        .cast("int").alias("cuts"))
    return (rows.join(cuts, by).withColumn("own", F.pmod(F.xxhash64("doc"), F.col("cuts")).cast("int"))
            .withColumn("with_", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
            .withColumn("i", F.least("own", "with_")).withColumn("j", F.greatest("own", "with_"))
            .drop("bytes_", "cuts", "with_"))


def similar(documents: DataFrame, size: int, p: int, q: int) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of ``documents`` (doc_id, text): sets of ``size``-word
    shingles link from p / q on. doc_id is an integer."""
    bands = Bands(p, q)
    described = staged(describe(documents, size), "sets")
    total = described.agg(F.sum("n_shingles")).first()[0] or 0
    classes = (described.where("n_shingles > 0 and doc_id is not null").groupBy("c1", "c2", "n_shingles")
               .agg(F.min("doc_id").alias("doc")))
    common = documents.sparkSession.sparkContext.broadcast(common_shingles(described))
    lists = staged(index_lists(documents, size, bands, total, common), "lists")

    # the sets of every listed class, from the text of its first document
    pairs = lists.select("hub", "node").distinct()
    wanted = staged(pairs.select(F.explode(F.array("hub", "node")).alias("c1")).distinct()
                    .join(classes, "c1").select(F.col("doc").alias("doc_id"), "c1", "c2"), "wanted")
    likely, _ = split_by(documents.select("doc_id", "text"), "doc_id", wanted.select("doc_id"))  # few others are shuffled

    def sets(batches):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        for batch in batches:
            for first, last, row, hashed in _sets(batch.column("text"), size):  # a slice at a time: sets are large
                cuts = np.searchsorted(row, np.arange(last - first + 1))
                n, c1, c2 = digests(row, hashed, last - first)
                out = []
                for m, x, y, i, j in zip(n, c1.view(np.int64), c2.view(np.int64), cuts[:-1], cuts[1:], strict=True):
                    band = int(bands.own(m))
                    out.append((int(x), int(y), int(m), band, *(marks(hashed[i:j], int(bands.marks[b]))
                                                                for b in (band, band + 1)), hashed[i:j].tobytes()))
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("c1"), part.column("c2"),
                     *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))],
                    names=["doc", "c1", "c2", "own1", "own2", "n", "band", "marks0", "marks1", "set"])

    members = staged(
        map_batches(
            likely.join(wanted, "doc_id"), sets,
            "doc long, c1 long, c2 long, own1 long, own2 long, n long, band int, marks0 binary, marks1 binary, "
            "set binary")
        .where("c1 = own1 and c2 = own2").drop("own1", "own2", "c2").dropDuplicates(["doc", "c1"]), "members")

    def compared(of: DataFrame) -> DataFrame:
        """Links among pairs of classes, by their documents (hub_doc, doc)."""
        of = staged(of, "pairs")
        both = of.select(F.explode(F.array("hub_doc", "doc")).alias("doc")).distinct()
        sets_near, _ = split_by(members.select("doc", "set"), "doc", both)  # few of all sets are shuffled
        rows = (of.join(sets_near, "doc")
                .join(sets_near.select(F.col("doc").alias("hub_doc"), F.col("set").alias("hub_set")), "hub_doc")
                .select("hub_doc", "hub_set", "doc", "set").sortWithinPartitions("hub_doc"))
        return map_batches(rows, lambda batches: _links(batches, bands), "a long, b long")

    side = members.select("doc", "c1", "n", "band", "marks0", "marks1")
    stars = (pairs.join(side.withColumnRenamed("c1", "node"), "node")
             .join(side.select(F.col("c1").alias("hub"), *(F.col(c).alias(f"hub_{c}") for c in
                                                           ("doc", "n", "band", "marks0", "marks1"))), "hub")
             .where((F.col("hub_doc") != F.col("doc"))
                    & (q * F.least("n", "hub_n") >= p * F.greatest("n", "hub_n")))
             .select("hub_doc", "doc", "n", "hub_n",
                     F.when(F.col("hub_band") > F.col("band"), F.col("marks1")).otherwise(F.col("marks0")).alias("marks"),
                     F.when(F.col("hub_band") < F.col("band"), F.col("hub_marks1")).otherwise(F.col("hub_marks0"))
                     .alias("hub_marks")))
    stars = map_batches(stars, lambda batches: _promising(batches, bands), "hub_doc long, doc long")
    links = staged(compared(stars), "first-links")
    labels = staged(components(links), "labels")

    # lists with sets of several components: families of components that may be linked, then their sets
    entry = staged(lists.select("list", F.explode(F.array("hub", "node")).alias("c1")).distinct()
                   .join(members.select("doc", "c1"), "c1").join(labels.withColumnRenamed("node", "doc"), "doc", "left")
                   .select("list", "doc", F.coalesce("label", "doc").alias("label")), "entries")
    # lists of the same sets (known by their number and two digests) and marks have the same answer: one stands for all
    mixed = (entry.groupBy("list").agg(F.min("label").alias("l"), F.max("label").alias("m"), F.count("*").alias("held"),
                                       F.bit_xor(F.xxhash64("doc")).alias("x"),
                                       F.bit_xor(F.xxhash64(F.lit(1), "doc")).alias("y")).where("l < m")
             .groupBy("held", "x", "y", F.pmod("list", F.lit(2)).alias("parity")).agg(F.min("list").alias("list"))
             .select("list"))
    own = F.when(F.pmod("list", F.lit(2)) == F.pmod("band", F.lit(2)), F.col("marks0")).otherwise(F.col("marks1"))
    apart = (entry.join(mixed, "list").join(side.drop("c1"), "doc").select("list", "doc", "label", "n", own.alias("marks"))
             .withColumn("bytes_", F.octet_length("marks")))
    edges = staged(_in_blocks(apart, "list").groupBy("list", "i", "j")
                   .applyInArrow(lambda t: _families(t, bands), "a long, b long").distinct(), "family-edges")
    family = components(edges).select(F.col("node").alias("label"), F.col("label").alias("family"))
    where = staged(members.select("doc").join(labels.withColumnRenamed("node", "doc"), "doc", "left")
                   .withColumn("label", F.coalesce("label", "doc")).join(family, "label"), "family-members")
    sets_of = (split_by(members.drop("c1"), "doc", where.select("doc"))[0].join(where, "doc")
               .withColumn("bytes_", F.octet_length("set")))
    more = (_in_blocks(sets_of, "family").groupBy("family", "i", "j")
            .applyInArrow(lambda t: _settled(t, bands), "a long, b long"))
    labels = components(links.unionByName(more))

    # written, so that the join below reads it as it is: a class that holds a third of all rows is split there
    named = staged(classes.join(labels.withColumnRenamed("node", "doc"), "doc", "left")
                   .select("c1", "c2", "n_shingles", F.coalesce("label", "doc").alias("component_id")), "named")
    kind = documents.schema["doc_id"].dataType
    return (described.join(named, ["c1", "c2", "n_shingles"], "left")
            .select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id"))
                    .when(F.col("doc_id").isNotNull(), F.col("component_id")).cast(kind).alias("component_id")))


def one_of_each(documents: DataFrame, size: int, p: int, q: int) -> DataFrame:
    """The rows of ``documents``, all columns, without near duplicates: of each component the document with
    the least id stays, once. Texts without words and rows without an id stay."""
    found = similar(documents, size, p, q)
    gone = found.where((F.col("n_shingles") > 0) & (F.col("doc_id") != F.col("component_id"))).select("doc_id")
    repeated = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    gone = staged(gone.distinct(), "gone")
    likely, stay = split_by(documents, "doc_id", gone)  # only the texts that may go are shuffled
    kept = stay.unionByName(likely.join(gone, "doc_id", "left_anti").select(documents.columns))
    repeated = staged(repeated, "repeated")
    if repeated.isEmpty():
        return kept
    return kept.join(repeated, "doc_id", "left_anti").unionByName(
        kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar(table(spark, sf_dir, "documents"), size=3, p=90, q=100)
