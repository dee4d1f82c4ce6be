"""N-gram Jaccard join: exact links between documents by their sets of word shingles.

Sets are sorted arrays of 64-bit shingle hashes with a signature of 1024 bits, or of half
as many bits as a large set has shingles, in powers of two. Two sets
with Jaccard similarity of at least t share one of the first n - ceil(t n) + 1
shingles in any common order, so only documents that meet there are compared, in
tiles of one shingle and neighbouring size bands. The bits in which two signatures
differ bound the overlap from above; what passes is intersected exactly.

Each document of a tile is first compared with one hub. Documents that seem to belong
together need no further comparison with one another, and of shingles that the same sets
share one is used; only where a tile still holds several groups are rows of different
groups compared. A pair leaves a tile only if it joins two groups, so a tile gives fewer
pairs than it has rows, however many are alike. What is possible by signature
is looked up and intersected. Groups that fall apart then are compared again, first by
longer signatures; what may still be linked, in tiles that hold the sets themselves, so
that only links leave them. That finds the components. All links lie within them, so where links are asked for, the
sets of a component are compared with one another in cells of two blocks. A cell counts
the links of each set; no pair leaves it."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm import textbytes as tb
from mercato.llm.components import connected_components
from mercato.llm.registry import register, table
from mercato.llm.scratch import Scratch
from mercato.llm.shipping import map_arrow, ship

SHINGLE_WORDS = 5
PERCENT = 80
SIGNATURE_BITS = 1024
# A shingle in at least this share of the documents is common, and comes last in the
# order. There are at most (mean set size / share) of them, which bounds the list.
COMMON_SHARE = 0.001
COUNTED_AT_ONCE = 2_000_000
TILE_ROWS = 2_000
# Shingles of a block of a component, of a stripe of a block, and sets in a stripe.
BLOCK_SHINGLES = 4_000_000
STRIPE_SHINGLES = 1 << 20
STRIPE_SETS = 256
# Prefix shingles that are brought together at once.
PART_SHINGLES = 4_000_000
SET_SCHEMA = "doc_id {id}, text_hash bigint, n int, sig_a bigint, sig_b bigint, bits binary, rare binary, often binary"
PAIRS_AT_ONCE = 500_000
# Bits that mark the hashes of texts to be looked up again; Spark's bitmaps hold so many.
MARKED_BITS = 1 << 24
BUCKET_BITS = 1 << 15


def document_sets(piece: tb.Slice, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes by row."""
    data = tb.LOWER[piece.data]
    starts, ends, first = tb.words(piece)
    hashes = tb.span_hash(tb.prefix_hash(data), starts, ends)
    joined = tb.shingles(hashes, width)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= width:
            out.append(tb.unique(joined[a : b - width + 1]))
        else:
            out.append(tb.shingles(hashes[a:b], b - a) if b > a else np.zeros(0, tb.U64))
    return out


def _parities(hashes: np.ndarray, size: int) -> np.ndarray:
    """Each bit is the parity of the members that fall on it, so each member in which
    two sets differ changes one bit. Folded in two, it is the signature of half the size."""
    parity = np.bincount((hashes & tb.U64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(parity.astype(np.uint8)).view(np.uint64)


def _signature(hashes: np.ndarray) -> np.ndarray:
    """At least half a bit for each member: sets that have nothing in common differ in
    half of the bits, which is more than similar ones may differ in."""
    return _parities(hashes, max(SIGNATURE_BITS, 1 << max(0, len(hashes) // 2 - 1).bit_length()))


def _folded(signatures: np.ndarray, width: int) -> np.ndarray:
    while signatures.shape[-1] > width:
        half = signatures.shape[-1] // 2
        signatures = signatures[..., :half] ^ signatures[..., half:]
    return signatures


def differences(signatures: list[bytes], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which the signatures of each pair of rows differ, the longer one folded
    to the shorter."""
    width = np.array([len(v) // 8 for v in signatures], np.int64)
    place = np.empty(len(width), np.int64)
    rows: dict[int, np.ndarray] = {}
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        place[own] = np.arange(len(own))
        rows[w] = np.frombuffer(b"".join(signatures[i] for i in own.tolist()), np.uint64).reshape(-1, w)
    out = np.zeros(len(x), np.int64)
    kind = width[x] * (int(width.max(initial=0)) + 1) + width[y]
    for k in np.unique(kind).tolist():
        pairs = np.flatnonzero(kind == k)
        wx, wy = int(width[x[pairs[0]]]), int(width[y[pairs[0]]])
        left, right = _folded(rows[wx], min(wx, wy)), _folded(rows[wy], min(wx, wy))
        step = max(1, (4 << 20) // min(wx, wy))
        for at in range(0, len(pairs), step):
            p = pairs[at : at + step]
            out[p] = np.bitwise_count(left[place[x[p]]] ^ right[place[y[p]]]).sum(axis=1, dtype=np.int64)
    return out


def _hashed(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))


def common_shingles(documents: DataFrame, width: int, share: float = COMMON_SHARE) -> np.ndarray:
    """Sorted hashes found in about `share` of the documents. They only set the order
    of comparison, so what is missing or added here changes no result."""
    rows_in_all = documents.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(parts: list[np.ndarray], rows: int) -> pa.RecordBatch:
            values = np.sort(np.concatenate(parts))
            first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
            counts = np.diff(np.concatenate([first, [len(values)]]))
            often = counts >= max(3, share * rows / 4)
            columns = [pa.array(values[first[often]].view(np.int64)), pa.array(counts[often])]
            return pa.RecordBatch.from_arrays(columns, ["h", "c"])

        parts, size, rows = [], 0, 0
        for batch in batches:
            for piece in tb.slices(batch.column(0)):
                parts += [s for s in document_sets(piece, width) if len(s)]
                size += len(piece.data) // 6
                rows += len(piece)
                if size >= COUNTED_AT_ONCE and parts:
                    yield counted(parts, rows)
                    parts, size, rows = [], 0, 0
        if parts:
            yield counted(parts, rows)

    counts = map_arrow(documents.select("text"), run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))
    found = counts.where(F.col("c") >= max(3, share * rows_in_all)).select("h").toArrow()["h"].to_numpy()
    return np.sort(found.view(tb.U64))


def _packed(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())


def described(documents: DataFrame, common: np.ndarray, width: int, percent: int) -> DataFrame:
    """Of each set its size, 128 bits that stand for it, its signature and its prefix:
    the shingles in which a similar set must meet it, common ones last. `rare` and
    `often` are the two parts of the prefix."""
    shared = documents.sparkSession.sparkContext.broadcast(common)
    id_type = documents.schema["doc_id"].dataType.simpleString()
    names = [f.split()[0] for f in SET_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = shared.value
        for batch in batches:
            for piece in tb.slices(batch.column(1)):
                sets = document_sets(piece, width)
                rare, often = [], []
                for s in sets:
                    keep = len(s) + percent * len(s) // -100 + 1 if len(s) else 0
                    late = np.zeros(len(s), bool)
                    if len(listed) and keep:
                        late = listed[np.minimum(np.searchsorted(listed, s), len(listed) - 1)] == s
                    rare.append(s[~late][:keep])
                    often.append(s[late][: keep - len(rare[-1])])
                here = slice(piece.first, piece.first + len(piece))
                a = [int(np.bitwise_xor.reduce(tb.mixed(s))) if len(s) else 0 for s in sets]
                b = [int(s.sum(dtype=np.uint64)) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[here],
                        batch.column(2)[here],
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array(np.array(a, np.uint64).astype(np.int64)),
                        pa.array(np.array(b, np.uint64).astype(np.int64)),
                        _packed([_signature(s) for s in sets]),
                        _packed(rare),
                        _packed(often),
                    ],
                    names,
                )

    return map_arrow(_hashed(documents), run, SET_SCHEMA.format(id=id_type))


def _wide_signature(hashes: np.ndarray) -> np.ndarray:
    """Parities as in `_signature`, at least four for each member, in a power of two."""
    return _parities(hashes, max(SIGNATURE_BITS, 1 << int(4 * len(hashes)).bit_length()))


def _wide_difference(x: np.ndarray, y: np.ndarray) -> int:
    """Bits in which two wide signatures differ, the longer one folded to the shorter."""
    width = min(len(x), len(y))
    return int(np.bitwise_count(_folded(x, width) ^ _folded(y, width)).sum())


def set_contents(documents: DataFrame, active: DataFrame, width: int) -> DataFrame:
    """`uid`, `n`, `wide`, `hashes` of the sets of `active` (`uid`, `doc_id`, `text_hash`).
    Sets are made where their texts are read, and only of texts whose hash falls on a
    marked bit, so that no others need move. The bits are as many for any input."""
    bit = F.pmod("text_hash", F.lit(MARKED_BITS)) + 1
    marks = active.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")
    )
    held = {r.bucket - 1: bytes(r.bits) for r in marks.collect()}
    empty = bytes(BUCKET_BITS // 8)
    marked = b"".join(held.get(b, empty) for b in range(MARKED_BITS // BUCKET_BITS))
    shared = documents.sparkSession.sparkContext.broadcast(np.frombuffer(marked, np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            at = batch.column(2).to_numpy() & (MARKED_BITS - 1)
            batch = batch.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            for piece in tb.slices(batch.column(1)):
                here = slice(piece.first, piece.first + len(piece))
                sets = document_sets(piece, width)
                columns = [batch.column(0)[here], batch.column(2)[here], pa.array([len(s) for s in sets], pa.int32())]
                columns += [_packed([_wide_signature(s) for s in sets]), _packed(sets)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n", "wide", "hashes"])

    id_type = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text_hash bigint, n int, wide binary, hashes binary"
    sets = map_arrow(_hashed(documents), run, schema)
    same = sets["doc_id"].eqNullSafe(active["doc_id"]) & (sets["text_hash"] == active["text_hash"])
    return sets.join(active, same).select("uid", "n", "wide", "hashes")


def shared_prefixes(sets: DataFrame) -> DataFrame:
    """`h`, `uid` for the shingles that the prefixes of several sets share.

    Rare shingles are dealt out by their leading bits, packed: each is in a small share
    of the sets, so the parts are even. Within a part 32 more bits stand for a shingle;
    two that agree in them meet for nothing, and the comparison of their sets tells.
    Common shingles are shared anyway and are not dealt out. A part has about
    PART_SHINGLES at most, and a task brings one part after the other together."""
    shuffled = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = sets.agg(F.sum(F.octet_length("rare"))).first()[0] or 0
    parts = max(1, shuffled, math.ceil(total / 8 / PART_SHINGLES))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            each = [np.frombuffer(v.as_buffer(), tb.U64) for v in batch.column(1)]
            h = np.concatenate(each)
            row = np.repeat(np.arange(len(each)), [len(x) for x in each])
            part = ((h >> tb.U64(33)) * tb.U64(parts) >> tb.U64(31)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            uid = batch.column(0).to_numpy()
            some = np.flatnonzero(np.diff(cuts))
            at = [order[cuts[p] : cuts[p + 1]] for p in some]
            short = h.astype(np.uint32)
            # Row numbers of a written table follow one another, so they are small steps.
            base = int(uid.min())
            ahead = (uid - base).astype(np.int32) if int(uid.max()) - base < 1 << 31 else uid - base
            columns = [pa.array(some, pa.int32()), pa.array([base] * len(some), pa.int64())]
            columns += [_packed([short[x] for x in at]), _packed([ahead[row[x]] for x in at])]
            yield pa.RecordBatch.from_arrays(columns, ["part", "base", "h", "uid"])

    def met(hashes: list[np.ndarray], uids: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h, uid = np.concatenate(hashes), np.concatenate(uids)
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        twice = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
        for k in range(0, len(twice), 100_000):
            x = twice[k : k + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(h[x]), pa.array(uid[x])], ["h", "uid"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, uids, here = [], [], None
        for batch in batches:
            for part, base, h, uid in zip(*(batch.column(k) for k in range(4))):
                if part.as_py() != here and hashes:
                    yield from met(hashes, uids)
                    hashes, uids = [], []
                here = part.as_py()
                short = np.frombuffer(h.as_buffer(), np.uint32)
                wide = len(uid.as_buffer()) // max(1, len(short))
                hashes.append(short.astype(np.int64) | here << 32)
                ahead = np.frombuffer(uid.as_buffer(), np.int32 if wide == 4 else np.int64)
                uids.append(ahead.astype(np.int64) + base.as_py())
        if hashes:
            yield from met(hashes, uids)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column(1)]
            row = pa.array(np.repeat(np.arange(len(each)), [len(x) for x in each]), pa.int64())
            h = np.concatenate(each) if each else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), batch.column(0).take(row)], ["h", "uid"])

    rows = "h bigint, uid bigint"
    dealt = map_arrow(sets.select("uid", "rare").where("length(rare) > 0"), deal, "part int, base bigint, h binary, uid binary")
    rare = map_arrow(dealt.repartition(parts, "part").sortWithinPartitions("part"), meet, rows)
    common = map_arrow(sets.select("uid", "often").where("length(often) > 0"), unpack, rows)
    return rare.unionAll(common)


def _required(n1, n2, percent: int):
    """Least overlap at which 100 * overlap >= percent * union."""
    return -(-percent * (n1 + n2) // (100 + percent))


def _paired(pairs: DataFrame, known: DataFrame, *columns: str) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(known.select(F.col("uid").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
    return pairs.select("a", "b", *[f"{c}_{side}" for side in ("a", "b") for c in columns])


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (`a`, `b`) whose sizes and signatures allow a link."""

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n1, n2 = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 4))
            rows = np.arange(batch.num_rows)
            differ = differences(batch.column(3).to_pylist() + batch.column(5).to_pylist(), rows, rows + len(rows))
            passes = (n1 + n2 - differ) // 2 >= _required(n1, n2, percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(passes))

    return map_arrow(_paired(pairs, sets, "n", "bits"), bounded, "a bigint, b bigint")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets, sorted arrays with members, are similar."""
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    overlap = int((y[at] == x).sum())
    return 100 * overlap >= percent * (len(x) + len(y) - overlap)


def _verified(pairs: DataFrame, contents: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs that are links: by signatures as long as the sets call for, and what
    passes by exact intersection of the sorted arrays."""

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n1, n2 = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 4))
            pairs = zip(batch.column(3), batch.column(5))
            differ = [_wide_difference(*(np.frombuffer(v.as_buffer(), np.uint64) for v in p)) for p in pairs]
            passes = (n1 + n2 - np.array(differ, np.int64)) // 2 >= _required(n1, n2, percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(passes))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                keep.append(_linked(*(np.frombuffer(v.as_buffer(), tb.U64) for v in (left, right)), percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    near = scratch.write(map_arrow(_paired(pairs, contents, "n", "wide"), bounded, "a bigint, b bigint"), "near")
    return map_arrow(_paired(near, contents, "hashes"), exact, "a bigint, b bigint")


def _stripes(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Cuts rows into runs of at most STRIPE_SETS sets and about STRIPE_SHINGLES."""
    out, begin, held = [], 0, 0
    for k, n in enumerate(sizes.tolist()):
        if k > begin and (held + n > STRIPE_SHINGLES or k - begin >= STRIPE_SETS):
            out.append((begin, k))
            begin, held = k, 0
        held += n
    return [*out, (begin, len(sizes))] if len(sizes) else out


def links_of_two(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many sets of `right` each of `left` is linked with, and the other way round;
    without `right`, how many others of `left`. The shingles that are found twice
    become bits, one row of them for each set, and common bits are counted."""
    both = left if right is None else left + right
    sizes = np.array([len(x) for x in both], np.int64)
    values = np.concatenate(both)
    order = np.argsort(values, kind="stable")
    new = np.concatenate(([True], values[order][1:] != values[order][:-1]))
    place = np.cumsum(new) - 1
    shared = np.bincount(place) > 1
    column = np.empty(len(values), np.int64)
    column[order] = np.where(shared[place], (np.cumsum(shared) - 1)[place], -1)
    row = np.repeat(np.arange(len(both)), sizes)
    used = column >= 0
    bits = np.zeros((len(both), -(-max(1, int(shared.sum())) // 64)), np.uint64)
    np.bitwise_or.at(bits, (row[used], column[used] >> 6), tb.U64(1) << (column[used] & 63).astype(tb.U64))
    first = 0 if right is None else len(left)
    counts = np.zeros(len(both), np.int64)
    for i in range(len(left)):
        others = np.arange(i + 1 if right is None else first, len(both))
        n = np.minimum(sizes[others], sizes[i])
        others = others[100 * n >= percent * np.maximum(sizes[others], sizes[i])]
        if not len(others):
            continue
        overlap = np.bitwise_count(bits[others] & bits[i]).sum(axis=1, dtype=np.int64)
        linked = others[100 * overlap >= percent * (sizes[others] + sizes[i] - overlap)]
        counts[i] += len(linked)
        counts[linked] += 1
    return counts[: len(left)], counts[len(left) :]


def link_counts(roots: DataFrame, contents: DataFrame, percent: int, block: int = BLOCK_SHINGLES) -> DataFrame:
    """`uid`, `n_links` of the sets of components (`v`, `root`) that are linked with
    others. A component of more than `block` shingles is dealt to blocks of about that
    many; a set is sent once to each pair of blocks that it is in."""
    ship(roots.sparkSession)
    sized = roots.withColumnRenamed("v", "uid").join(contents.select("uid", "n"), "uid")
    blocks = sized.groupBy("root").agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int").alias("own")
    placed = sized.join(blocks, "root").select("uid", "root", "blocks", own)
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "uid", "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own"
    )
    sent = cells.join(contents.select("uid", "hashes"), "uid")

    def run(group: pa.Table) -> pa.Table:
        own, i, j = (group[c].to_numpy() for c in ("own", "i", "j"))
        uid = group["uid"].to_numpy()
        sets = [np.frombuffer(v.as_buffer(), tb.U64) for v in group["hashes"]]
        counts = np.zeros(len(uid), np.int64)
        parts = [np.flatnonzero(own == i[0])] if i[0] == j[0] else [np.flatnonzero(own == i[0]), np.flatnonzero(own == j[0])]
        # By size, so that stripes that are too far apart in it have no pairs.
        sizes = np.array([len(x) for x in sets])
        parts = [p[np.argsort(sizes[p], kind="stable")] for p in parts]
        stripes = [[p[a:b] for a, b in _stripes(sizes[p])] for p in parts]
        for k, x in enumerate(stripes[0]):
            for y in stripes[-1][k if len(parts) == 1 else 0 :]:
                if x is y:
                    counts[x] += links_of_two([sets[r] for r in x], None, percent)[0]
                elif 100 * sizes[x].max() >= percent * sizes[y].min() and 100 * sizes[y].max() >= percent * sizes[x].min():
                    of_x, of_y = links_of_two([sets[r] for r in x], [sets[r] for r in y], percent)
                    counts[x] += of_x
                    counts[y] += of_y
        return pa.table({"uid": uid, "n_links": counts})

    counted = sent.groupBy("root", "i", "j").applyInArrow(run, "uid bigint, n_links bigint")
    return counted.groupBy("uid").agg(F.sum("n_links").alias("n_links"))


def _band(n: Column, percent: int) -> Column:
    """Sets that can be similar are in the same or neighbouring bands."""
    return F.floor(F.log(n.cast("double")) / F.lit(-math.log(percent / 100)) + 1e-9).cast("int")


class _Joined:
    """Labels of rows, some of which have been joined."""

    def __init__(self, labels: np.ndarray):
        named, self.first = np.unique(labels, return_inverse=True)
        self.to = list(range(len(named)))
        self.labels = self.first

    def _end(self, label: int) -> int:
        while self.to[label] != label:
            self.to[label] = label = self.to[self.to[label]]
        return label

    def joining(self, x: np.ndarray, y: np.ndarray, linked: Callable[[int, int], bool] | None) -> list[int]:
        """Those of the pairs of rows that join two labels, one after the other, and, where
        that is asked, are linked. Pairs of joined labels are not asked for."""
        out = []
        for k, (a, b) in enumerate(zip(x.tolist(), y.tolist())):
            r, s = self._end(self.first[a]), self._end(self.first[b])
            if r != s and (linked is None or linked(a, b)):
                self.to[s] = r
                out.append(k)
        if out:
            self.labels = np.array([self._end(k) for k in range(len(self.to))])[self.first]
        return out


def _tile_pairs(members: DataFrame, sets: DataFrame, percent: int, rows: int, only_rows: bool = False) -> DataFrame:
    """Pairs of one `within` but different roots, from members (`h`, `uid`, `n`, `root`,
    `within`), that pass the signature bound or, where `sets` have `hashes`, are links.
    Only pairs that join two roots are given: they connect what all pairs would. With
    `only_rows`, not these but each `uid` that is in any of all pairs.

    A tile is a shingle, a `within` and two neighbouring size bands; a large one is split
    into blocks, and each pair of blocks is a tile. Signatures and hashes join the rows
    last, when only tiles of several roots are left."""
    exact = "hashes" in sets.columns
    banded = members.withColumn("band", _band(F.col("n"), percent))
    placed = banded.withColumn("tile_band", F.explode(F.array(F.col("band"), F.col("band") + 1)))
    sizes = placed.groupBy("h", "within", "tile_band").agg(
        F.count(F.lit(1)).alias("m"),
        F.sum("n").alias("held"),
        F.min("root").alias("r0"),
        F.max("root").alias("r1"),
        F.max("band").alias("top"),
    )
    sizes = sizes.where("m > 1 and r0 <> r1 and top = tile_band")
    blocks = F.ceil(F.greatest(F.col("m") / rows, F.col("held") / BLOCK_SHINGLES) if exact else F.col("m") / rows)
    sized = placed.join(sizes, ["h", "within", "tile_band"]).withColumn("blocks", blocks.cast("int"))
    own = F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")
    tiles = (
        sized.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "h",
            "tile_band",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            "uid",
            "n",
            "root",
            "within",
            "own",
            (F.col("band") == F.col("tile_band")).alias("home"),
        )
    )
    keys = ["h", "within", "tile_band", "i", "j"]
    described = [c for c in ("bits", "hashes") if c in sets.columns]
    signed = tiles.join(sets.select("uid", *described), "uid").select(*keys, "uid", "n", "root", "own", "home", *described)
    ordered = signed.repartition(*keys).sortWithinPartitions(*keys, "n", "uid")

    def compare(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All pairs of whole tiles, some at a time, but for those of joined roots."""
        t = pa.Table.from_batches(held)
        uid, n, root, own, home, *key = (t.column(c).to_numpy() for c in ("uid", "n", "root", "own", "home", *keys))
        bits = t.column("bits").to_pylist()
        hashes = [np.frombuffer(v.as_buffer(), tb.U64) for v in t.column("hashes")] if exact else []
        linked = (lambda a, b: _linked(hashes[a], hashes[b], percent)) if exact else None
        joined, met = _Joined(root), np.zeros(len(uid), bool)
        n = n.astype(np.int64)
        new = np.concatenate(([True], np.any([x[1:] != x[:-1] for x in key], axis=0)))
        tile = np.cumsum(new) - 1
        split = key[3] != key[4]
        place = tile * (1 << 32) + n
        upto = np.searchsorted(place, tile * (1 << 32) + 100 * n // percent, "right")
        partners = np.maximum(upto - np.arange(len(n)) - 1, 0)
        ends = np.cumsum(partners)
        at = 0
        while at < len(n):
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] - partners[at] + PAIRS_AT_ONCE, "right")))
            count = partners[at:stop]
            x = np.repeat(np.arange(at, stop), count)
            y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count)
            at = stop
            labels = joined.labels
            wanted = (labels[x] != labels[y]) & (home[x] | home[y]) & (~split[x] | (own[x] != own[y]))
            x, y = x[wanted], y[wanted]
            pairs = np.sort(np.stack([uid[x], uid[y]], axis=1), axis=1)
            order = np.lexsort(pairs.T)
            pairs = pairs[order]
            once = np.concatenate(([True], (pairs[1:] != pairs[:-1]).any(axis=1)))[: len(pairs)]
            x, y, pairs = x[order][once], y[order][once], pairs[once]
            passes = (n[x] + n[y] - differences(bits, x, y)) // 2 >= _required(n[x], n[y], percent)
            x, y, pairs = x[passes], y[passes], pairs[passes]
            if only_rows:
                met[x] = met[y] = True
                continue
            pairs = pairs[joined.joining(x, y, linked)]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
        if only_rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(uid[met]))], ["uid"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows_held, shingles_held, key = 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = [batch.column(k).to_numpy() for k in range(len(keys))]
            shingles = np.concatenate(([0], np.cumsum(batch.column("n").to_numpy(), dtype=np.int64)))
            change = np.zeros(batch.num_rows, bool)
            for x in names:
                change[1:] |= x[1:] != x[:-1]
            change[0] = key is not None and tuple(x[0] for x in names) != key
            key = tuple(x[-1] for x in names)
            begin = 0
            for cut in np.flatnonzero(change).tolist():
                if rows_held + cut - begin >= 4 * rows or exact and shingles_held + shingles[cut] - shingles[begin] >= BLOCK_SHINGLES:
                    yield from compare([*held, batch.slice(begin, cut - begin)])
                    held, rows_held, shingles_held, begin = [], 0, 0, cut
            held.append(batch.slice(begin))
            rows_held += batch.num_rows - begin
            shingles_held += int(shingles[-1] - shingles[begin])
        if rows_held:
            yield from compare([x for x in held if x.num_rows])

    return map_arrow(ordered, run, "uid bigint" if only_rows else "a bigint, b bigint").distinct()


def similar_groups(
    documents: DataFrame,
    percent: int = PERCENT,
    width: int = SHINGLE_WORDS,
    tile_rows: int = TILE_ROWS,
    with_links: bool = False,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row for each row of `documents`: `doc_id`, `n_shingles`, `component_id` (the
    smallest doc_id that links reach), `n_copies` (rows with the same set), `kept`
    (one row of each component: the smallest doc_id), `text_hash`; `with_links` also
    `class_id` (the smallest doc_id with the same set) and `n_links` (the other sets,
    each counted once, that are linked with this one).

    Links are between sets with 100 * intersection >= percent * union. A text of fewer
    words than a shingle is one shingle; a null or empty text, or one of white space,
    has none and is linked with nothing. Equal sets are compared once. A row without
    doc_id takes part; its component_id is that of the others, or null. Repeated rows
    are copies of one another. An empty table gives an empty result; other columns are
    not read."""
    scratch = Scratch(documents.sparkSession, "ngram-join")
    common = common_shingles(documents, width)
    sets = scratch.write(described(documents, common, width, percent).withColumn("uid", F.monotonically_increasing_id()), "sets")
    classes = scratch.write(
        sets.where("n > 0")
        .groupBy("sig_a", "sig_b", "n")
        .agg(F.min("uid").alias("uid"), F.count(F.lit(1)).alias("n_copies"), F.min("doc_id").alias("class_id")),
        "classes",
    )
    found = scratch.write(shared_prefixes(sets), "found")
    known = scratch.write(sets.drop("rare", "often"), "known")
    scratch.drop(sets)
    scratch.release()
    sets = known
    # Of equal sets one is compared; shingles of one set only are dropped again.
    single = found.join(classes.select("uid", "n"), "uid")
    meets = scratch.write(single.join(_telling(single), "h"), "meets")
    scratch.drop(found)
    members = meets
    # First by signatures alone: each document with the hub of its shingle and band, and
    # what that leaves apart with one another.
    near_hub = scratch.write(_possible(_hub_pairs(members, percent), sets, percent), "near_hub")
    apart = scratch.write(_rooted(members, near_hub, scratch, "root"), "apart").withColumn("within", F.lit(0).cast("bigint"))
    scratch.release()
    across = scratch.write(_tile_pairs(apart, sets, percent, tile_rows), "across")
    scratch.release()
    possible = near_hub.unionAll(across)
    # Only documents of possible pairs are looked up again, and compared exactly.
    active = possible.select(F.col("a").alias("uid")).unionAll(possible.select("b")).distinct()
    active = scratch.write(sets.select("uid", "doc_id", "text_hash").join(active, "uid"), "active")
    contents = scratch.write(set_contents(documents, active, width), "contents")
    scratch.release()
    if contents.count() > active.count():
        # A repeated row brought its set twice.
        contents = scratch.write(contents.dropDuplicates(["uid"]), "contents")
    links = scratch.write(_verified(possible, contents, percent, scratch), "links")
    scratch.release()
    # What seemed near may not be: then those it held together are compared.
    seeming = scratch.write(_rooted(members, possible, scratch, "within"), "seeming")
    split = scratch.write(_rooted(seeming, links, scratch, "root"), "split")
    scratch.release()
    known = contents.select("uid", F.col("wide").alias("bits"), "hashes")
    split = split.join(_telling(split, "within"), ["h", "within"])
    # Sets are long: only those move that longer signatures allow a link to another group.
    doubtful = scratch.write(_tile_pairs(split, known.drop("hashes"), percent, tile_rows, only_rows=True), "doubtful")
    scratch.release()
    split = scratch.write(split.join(doubtful, "uid"), "split")
    split = split.join(_telling(split, "within"), ["h", "within"])
    inside = scratch.write(_tile_pairs(split, known, percent, tile_rows), "inside")
    scratch.release()
    links = scratch.write(links.unionAll(inside), "links")
    roots = scratch.write(connected_components(links, scratch), "roots")
    scratch.release()
    if with_links:
        counts = scratch.write(link_counts(roots, contents, percent, block_shingles), "counts")
    scratch.drop(contents)
    class_root = classes.join(roots.withColumnRenamed("v", "uid"), "uid", "left").select(
        "uid", "sig_a", "sig_b", "n", "n_copies", "class_id", F.coalesce("root", "uid").alias("root")
    )
    extra = []
    if with_links:
        class_root = class_root.join(counts, "uid", "left")
        extra = [F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links")]
    class_root = class_root.drop("uid")
    rows = sets.select("uid", "doc_id", "text_hash", "n", "sig_a", "sig_b")
    found = rows.join(class_root, ["sig_a", "sig_b", "n"], "left").withColumn("root", F.coalesce("root", "uid"))
    found = scratch.write(found, "found")
    scratch.drop(sets)
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "uid")).alias("first")
    groups = found.groupBy("root").agg(smallest)
    return found.join(groups, "root").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.col("first.doc_id").alias("component_id"),
        F.coalesce("n_copies", F.lit(1)).cast("bigint").alias("n_copies"),
        (F.col("first.uid") == F.col("uid")).alias("kept"),
        "text_hash",
        *extra,
    )


def _telling(members: DataFrame, *within: str) -> DataFrame:
    """`h` of one shingle for each set of several members (`h`, `uid`) that shingles have
    in common, told apart by the least and the largest member, their number and sums of
    two hashes; where groups (`within`) are apart, for each set of members of one. All
    that follows depends on who meets, not on how often, and near copies meet in most of
    their shingles."""
    met = members.groupBy("h", *within).agg(
        F.min("uid").alias("x"),
        F.max("uid").alias("y"),
        F.count(F.lit(1)).alias("m"),
        F.sum(F.shiftrightunsigned(F.xxhash64("uid"), 33)).alias("f"),
        F.sum(F.shiftrightunsigned(F.xxhash64(F.lit(1), "uid"), 33)).alias("g"),
    )
    return met.where("x <> y").groupBy("x", "y", "m", "f", "g", *within).agg(F.min("h").alias("h")).select("h", *within)


def _hub_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Each member with one member of its shingle and size band, the same for all: the
    one of the smallest number, so that in a large group nearly all shingles have one
    hub, to which all others move in one round of contraction."""
    banded = members.withColumn("band", _band(F.col("n"), percent))
    hubs = banded.groupBy("h", "band").agg(F.min("uid").alias("hub"))
    return banded.join(hubs, ["h", "band"]).where("uid <> hub").select(F.col("hub").alias("a"), F.col("uid").alias("b")).distinct()


def _rooted(members: DataFrame, links: DataFrame, scratch: Scratch, into: str) -> DataFrame:
    """`members` with the component of each under `links`."""
    roots = connected_components(links, scratch).select(F.col("v").alias("uid"), F.col("root").alias(into))
    return members.join(roots, "uid", "left").withColumn(into, F.coalesce(into, "uid"))


def drop_similar(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of `documents` that stay, one of each component (the smallest doc_id), with
    all columns, whatever their names. Texts without words stay, each once for a doc_id;
    of rows repeated with doc_id and text one stays. No documents give none."""
    kept = similar_groups(documents, percent).where("kept")
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    marked = documents.select("doc_id", F.xxhash64("text").alias("hash"), F.struct("*").alias("whole"))
    match = marked["doc_id"].eqNullSafe(kept["kept_id"]) & (marked["hash"] == kept["kept_hash"])
    return marked.join(kept, match, "left_semi").dropDuplicates(["doc_id", "hash"]).select("whole.*")


@register("op3_ngram_jaccard")
def op3_ngram_jaccard(spark, sf_dir):
    return similar_groups(table(spark, sf_dir, "documents"), with_links=True).drop("text_hash")
