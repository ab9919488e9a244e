"""N-gram Jaccard join: prefix-tree join of globally ordered shingle sets.

Shingles are ordered by the estimate of a frequency sketch of the whole corpus, of bounded size, and
then by hash, so rare ones come first. Two sets that are similar enough share a shingle of
their prefixes; documents that share one, of comparable size, meet in a block under the
smallest document of the group. Each block stores its ordered sets in a trie and walks it once
per document, counting overlap along shared paths and leaving a subtree when what remains of
either side cannot reach the required overlap. Pairs already connected are not compared.

Blocks are bounded. A group that needs several blocks is settled in a second step: only its
documents outside its largest component are still open, and they meet all blocks of the group.
"""

from __future__ import annotations

import zlib
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import kernel, resident, shared
from .components import connected_components, merge_components

SHINGLE, PERCENT = 5, 80
#: Counters of the frequency sketch (one for CELL_BYTES of text, 8 to 64 MB) and rows it is sent in.
SKETCH_BITS, SLOT_BITS, CELL_BYTES = (21, 24), 15, 6 << 10
#: Documents of a block.
LIMIT = 256
#: A shingle is hot when its sketch cell holds this many times the mean, and this many documents at least.
HOT_TIMES, HOT_LEAST = 8, 2000
BATCH_BYTES = 1 << 20
#: Bits of the bitmap of candidate texts (8 MB whatever the input) and rows it is sent in.
MARK_BITS, MARK_SLOTS = 26, 64
#: The prefix is longer than needed by one part in this many of the set.
SPARE = 10
#: Shingles of the corpus for each shard of prefixes.
SHARD_SHINGLES = 3_000_000
#: Copies of what is known of a component, over which its texts are spread.
SPREAD = 8


def _batches(ids: list, texts: list[bytes]):
    """Slices of bounded bytes."""
    at = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > BATCH_BYTES:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def shingle_sets(texts: list[bytes], size: int = SHINGLE, lanes: int = 1) -> tuple[np.ndarray, ...]:
    """Document number and hash of each distinct shingle, by document; short texts are one shingle.

    A hash has 64 bits for each of the ``lanes``, made of the words' cryptographic hashes.
    """
    w = kernel.Words([t.translate(kernel.FOLD) for t in texts])
    at = w.windows(size)
    doc, hashes = w.doc[at], [w.window_hashes(at, size, k) for k in range(lanes)]
    few = np.flatnonzero((w.count > 0) & (w.count < size))
    if len(few):
        doc = np.concatenate((doc, few))
        whole = [blake2b(w.lanes[:, w.first[d] : w.first[d] + w.count[d]].tobytes(), digest_size=16).digest() for d in few.tolist()]
        short = np.frombuffer(b"".join(whole), "<u8").reshape(-1, 2).T
        hashes = [np.concatenate((h, k)) for h, k in zip(hashes, short)]
    order = np.lexsort((*hashes[::-1], doc))
    doc, hashes = doc[order], [h[order] for h in hashes]
    keep = np.ones(len(doc), bool)
    keep[1:] = np.any([x[1:] != x[:-1] for x in (doc, *hashes)], axis=0)
    return doc[keep], *(h[keep] for h in hashes)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _cells(h: np.ndarray, cells: int) -> np.ndarray:
    """Cells of a sketch, of which there is a power of two."""
    return (h >> np.uint64(65 - int(cells).bit_length())).astype(np.int64)


def _measure(size: int, bits: int):
    schema = pa.schema([("slot", pa.int32()), ("data", pa.binary()), ("doc_id", pa.int64()), ("node", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])

    def run(batches):
        resident.drop()
        sketch = np.zeros(1 << bits, np.int64)
        for b in batches:
            texts, n = _texts(b), np.zeros(b.num_rows, np.int64)
            for x, y in _batches([], texts):
                doc, h = shingle_sets(texts[x:y], size)
                n[x:y] = np.bincount(doc, minlength=y - x)
                np.add.at(sketch, _cells(h, len(sketch)), 1)
            k = b.num_rows
            yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()), b.column("doc_id"), b.column("node"), b.column("other"), pa.array(n)], schema=schema)
        for s, part in enumerate(sketch.reshape(-1, 1 << SLOT_BITS)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([zlib.compress(np.minimum(part, 2**32 - 1).astype("<u4").tobytes(), 1)]), *[pa.nulls(1, pa.int64())] * 4], schema=schema)

    return run, "slot int, data binary, doc_id long, node long, other long, n long"


def _add_slots(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zlib.decompress(d), "<u4").astype(np.int64) for d in table.column("data").to_pylist())
    return pa.table({"slot": table.column("slot")[:1], "data": pa.array([zlib.compress(np.minimum(total, 2**32 - 1).astype("<u4").tobytes(), 1)])})


def _prefixes(size: int, percent: int, sketch, hot: int, shards: int):
    """Packed prefixes: rows (shard, data), one for each shard that a slice of documents has keys of.

    A prefix is longer than the join needs, by a tenth of the set: a document must then share that many
    shingles more with the rest of the corpus, or it has no partner. Keys are the upper 48 bits of the
    hash; those of hot shingles are spread over their documents. A false match only adds a candidate.
    """
    schema = pa.schema([("shard", pa.int32()), ("data", pa.binary())])

    def run(batches):
        resident.drop()
        counts = sketch.value
        for b in batches:
            texts, nodes, seen = _texts(b), b.column("node").to_numpy(), set()
            fresh = [i for i, k in enumerate(nodes.tolist()) if not (k in seen or seen.add(k))]
            texts, nodes = [texts[i] for i in fresh], nodes[fresh]
            for x, y in _batches([], texts):
                doc, h = shingle_sets(texts[x:y], size)
                if not len(doc):
                    continue
                often = counts[_cells(h, len(counts))]
                order = np.lexsort((h, often, doc))
                doc, h, often = doc[order], h[order], often[order]
                n = np.bincount(doc, minlength=y - x)
                place = np.arange(len(doc)) - (np.cumsum(n) - n)[doc]
                need = n - (percent * n + 99) // 100 + 1
                keep = place < (need + n // SPARE)[doc]
                core = (place < need[doc])[keep]
                doc, h, warm = doc[keep], h[keep], (often > hot)[keep]
                key = np.where(warm, kernel.mix(h + nodes[x:y][doc].view(np.uint64)), h) >> np.uint64(16)
                order = np.argsort(key, kind="stable")
                key, doc, core, warm, h = key[order], doc[order], core[order], warm[order], h[order]
                cut = np.searchsorted(key, np.array([-(-(k << 48) // shards) for k in range(shards)] + [1 << 48], np.uint64))
                some = np.flatnonzero(np.diff(cut))
                data = [_pack_keys(key[i:j], doc[i:j], core[i:j], warm[i:j], h[i:j], nodes[x:y], n) for i, j in zip(cut[some].tolist(), cut[some + 1].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(data, pa.binary())], schema=schema)

    return run, "shard int, data binary"


def _pack_keys(key, doc, core, warm, h, nodes, n) -> bytes:
    own, which = np.unique(doc, return_inverse=True)
    gaps = np.diff(key, prepend=np.uint64(0))
    wide, index = 8 if gaps.max() >> np.uint64(32) else 4, 2 if len(own) < 1 << 16 else 4
    head = np.array([len(key), len(own), wide, index], "<u4").tobytes()
    return head + nodes[own].astype("<i8").tobytes() + n[own].astype("<u4").tobytes() + gaps.astype(f"<u{wide}").tobytes() + which.astype(f"<u{index}").tobytes() + kernel.bits(core) + kernel.bits(warm) + h[warm].astype("<u8").tobytes()


def _unpack_keys(data: bytes) -> tuple[np.ndarray, ...]:
    k, docs, wide, index = np.frombuffer(data, "<u4", 4).tolist()
    at = 16
    nodes = np.frombuffer(data, "<i8", docs, at)
    n = np.frombuffer(data, "<u4", docs, at := at + 8 * docs)
    key = np.cumsum(np.frombuffer(data, f"<u{wide}", k, at := at + 4 * docs), dtype=np.uint64)
    which = np.frombuffer(data, f"<u{index}", k, at := at + wide * k)
    flags = (k + 7) // 8
    core = kernel.unbits(data[(at := at + index * k) : at + flags], k)
    warm = kernel.unbits(data[(at := at + flags) : at + flags], k)
    h = np.zeros(k, np.uint64)
    h[warm] = np.frombuffer(data, "<u8", int(warm.sum()), at + flags)
    return key, nodes[which], n[which], core, warm, h


def _shared_keys(table: pa.Table) -> pa.Table:
    """Rows (token, node, n, core, hot) of the shingles of a shard that several documents have, and of all hot ones."""
    key, node, n, core, warm, h = (np.concatenate(c) for c in zip(*map(_unpack_keys, table.column("data").to_pylist())))
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    order, key, node = order[fresh], key[fresh], node[fresh]
    same = key[1:] == key[:-1]
    keep = np.concatenate(([False], same)) | np.concatenate((same, [False])) | warm[order]
    order, key, node = order[keep], key[keep], node[keep]
    token = np.where(warm[order], h[order], key).view(np.int64)
    return pa.table({"token": token, "node": node, "n": n[order].astype(np.int32), "core": core[order], "hot": warm[order]})


def _mark_nodes(batches):
    resident.drop()
    marks = np.zeros(1 << MARK_BITS, bool)
    for b in batches:
        marks[(b.column("node").to_numpy().view(np.uint64) >> np.uint64(64 - MARK_BITS)).astype(np.int64)] = True
    for s, part in enumerate(marks.reshape(MARK_SLOTS, -1)):
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([zlib.compress(kernel.bits(part), 1)])], names=["slot", "data"])


def _join_marks(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(zlib.decompress(d), np.uint8) for d in table.column("data").to_pylist()]
    return pa.table({"slot": table.column("slot")[:1], "data": pa.array([zlib.compress(np.bitwise_or.reduce(parts).tobytes(), 1)])})


def _marked(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``docs`` without most rows whose node is not among ``nodes``, by a bitmap of fixed size.

    Only texts that pass go through a shuffle. Where the nodes are too many for the bitmap it lets more
    through, and the join that follows drops them.
    """
    spark = docs.sparkSession
    bitmap = np.zeros((MARK_SLOTS, (1 << MARK_BITS) // MARK_SLOTS // 8), np.uint8)
    for r in nodes.select("node").mapInArrow(_mark_nodes, "slot int, data binary").groupBy("slot").applyInArrow(_join_marks, "slot int, data binary").collect():
        bitmap[r.slot] = np.frombuffer(zlib.decompress(r.data), np.uint8)
    sent = spark.sparkContext.broadcast(bitmap.ravel())

    def run(batches):
        resident.drop()
        bits = sent.value
        for b in batches:
            at = (b.column("node").to_numpy().view(np.uint64) >> np.uint64(64 - MARK_BITS)).astype(np.int64)
            yield b.filter(pa.array((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1))

    return docs.mapInArrow(run, docs.schema)


class Trie:
    """Compressed prefix tree over lexicographically sorted sequences of ranks.

    A node is (first, last, run, children, minimum size, maximum size): the sequences
    [first, last) share the run that follows the parent's; those that end with it come first.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.size = sets, [len(s) for s in sets]
        self.root = self._node(0, len(sets), 0)
        stack = [(self.root, 0)]
        while stack:
            node, depth = stack.pop()
            depth += len(node[2])
            at, last = node[0], node[1]
            while at < last and self.size[at] == depth:
                at += 1
            node[6] = at
            while at < last:
                head, end = sets[at][depth], at + 1
                while end < last and sets[end][depth] == head:
                    end += 1
                child = self._node(at, end, depth)
                node[3].append(child)
                if end - at > 1 or self.size[at] > depth + len(child[2]):
                    stack.append((child, depth))
                else:
                    child[6] = end
                at = end

    def _node(self, first: int, last: int, depth: int) -> list:
        a, b = self.sets[first], self.sets[last - 1]
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[depth:n] != b[depth:n])
        run = a[depth : depth + int(differ[0]) if len(differ) else n]
        sizes = self.size[first:last]
        return [first, last, run, [], min(sizes), max(sizes), first]


def trie_join(sets: list[np.ndarray], percent: int, parent: list[int]) -> list[tuple[int, int]]:
    """Links between sorted sets of ranks that are similar enough, without those that connect nothing new.

    ``sets`` are in lexicographic order; ``parent`` is a union-find forest over them, changed in place.
    """

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    trie, found = Trie(sets), []
    member = np.zeros(max((int(s[-1]) for s in sets), default=-1) + 1, bool)
    for x, own in enumerate(sets):
        n, mine = len(own), root(x)
        member[own] = True
        least, most = -(-percent * n // 100), 100 * n // percent
        stack = [(trie.root, 0, 0)]
        while stack:
            node, depth, overlap = stack.pop()
            first, last, run, children, low, high, ended = node
            if last <= x + 1 or high < least or low > most:
                continue
            if last - first == 1 and root(first) == mine:
                continue
            if len(run):
                depth += len(run)
                overlap += int(np.count_nonzero(member[run]))
                rest = n - int(np.searchsorted(own, run[-1], "right"))
                size = max(low, least)
                if (100 + percent) * (overlap + min(high - depth, rest)) < percent * (n + size):
                    continue
            for y in range(max(first, x + 1), ended):
                other = root(y)
                if other != mine and (100 + percent) * overlap >= percent * (n + len(sets[y])):
                    found.append((x, y))
                    parent[other] = mine
            for child in children:
                stack.append((child, depth, overlap))
        member[own] = False
    return found


def _block(size: int, percent: int, sketch):
    def run(table: pa.Table) -> pa.Table:
        resident.drop()
        nodes, comps = table.column("node").to_pylist(), table.column("component").to_pylist()
        texts = table.column("text").cast(pa.binary()).to_pylist()
        pick = {k: i for i, k in reversed(list(enumerate(nodes)))}
        nodes, comps, texts = list(pick), [comps[i] for i in pick.values()], [texts[i] or b"" for i in pick.values()]
        doc, h, more = shingle_sets(texts, size, 2)
        often = sketch.value[_cells(h, len(sketch.value))]
        # Shingles are told apart by 128 bits; ranks are their global order within the block.
        order = np.lexsort((more, h, often))
        new = np.ones(len(h), bool)
        new[1:] = (h[order[1:]] != h[order[:-1]]) | (more[order[1:]] != more[order[:-1]])
        inverse = np.empty(len(h), np.int64)
        inverse[order] = np.cumsum(new) - 1
        order = np.lexsort((inverse, doc))
        ends = np.cumsum(np.bincount(doc, minlength=len(texts)))
        sets = [s for s in np.split(inverse[order].astype(np.int32), ends[:-1])] if len(texts) else []
        by = sorted((i for i in range(len(sets)) if len(sets[i])), key=lambda i: sets[i].astype(">i4").tobytes())
        head: dict = {}
        parent = [head.setdefault(comps[i], k) if comps[i] is not None else k for k, i in enumerate(by)]
        links = trie_join([sets[i] for i in by], percent, parent)
        # Linked documents are given as stars around the smallest node of their part of the block.
        around: dict[int, int] = {}
        for x, y in links:
            root = x
            while parent[root] != root:
                root = parent[root]
            around[root] = min(around.get(root, nodes[by[x]]), nodes[by[x]], nodes[by[y]])
        star = set()
        for link in links:
            for x in link:
                root = x
                while parent[root] != root:
                    root = parent[root]
                if nodes[by[x]] != around[root]:
                    star.add((nodes[by[x]], around[root]))
        return pa.table({"u": pa.array([u for u, _ in star], pa.int64()), "v": pa.array([v for _, v in star], pa.int64())})

    return run


def _names(text: Column) -> tuple[Column, Column]:
    """Two hashes of a text."""
    return F.xxhash64(text), F.xxhash64(text, F.lit("other"))


def _apart(seen: DataFrame) -> Column:
    """The number of a text: its first hash, or its second one where different texts share the first.

    Among n texts n² / 2**65 first hashes are shared, none or a few thousand whatever the corpus.
    """
    both = seen.where("slot is null").groupBy("node").agg(F.min("other").alias("a"), F.max("other").alias("b")).where("a <> b").select("node")
    shared_ones = [r.node for r in both.collect()]
    return F.when(F.col("node").isin(shared_ones), F.col("other")).otherwise(F.col("node")) if shared_ones else F.col("node")


def join(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, limit: int = LIMIT, hot_least: int = HOT_LEAST) -> DataFrame:
    """Components of documents whose sets of word shingles have a Jaccard similarity of ``percent`` or more.

    Takes ``doc_id`` and ``text`` of ``docs``; other columns are ignored. One row per input row: doc_id,
    n_shingles, component_id (smallest doc_id reachable by links). Words are split at ASCII white space,
    A-Z in lower case; a text of fewer words than ``size`` is one shingle. Null and wordless texts have an
    empty set and are their own component. Each row is a document: equal texts are linked, rows that repeat
    a doc_id with different texts are not linked by the id. A row without doc_id has a null component_id
    unless a linked document has an id. An empty table gives no rows. ``hash`` and ``other`` are two hashes of the text and
    ``first`` is true for the rows that stand for their component: those of its smallest (doc_id, node), and
    all rows without words.
    """
    spark = docs.sparkSession
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).select("doc_id", "text", *[h.alias(c) for h, c in zip(_names(F.col("text")), ("node", "other"))])
    text = int(docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)
    bits = min(max(SKETCH_BITS[0], (text // CELL_BYTES).bit_length()), SKETCH_BITS[1])
    run, schema = _measure(size, bits)
    seen = shared.table(docs.mapInArrow(run, schema), "shingles")
    apart = _apart(seen)
    docs = docs.select("doc_id", "text", apart.alias("node"))
    slots = seen.where("slot is not null").select("slot", "data").groupBy("slot").applyInArrow(_add_slots, "slot int, data binary").collect()
    counts = np.zeros((1 << (bits - SLOT_BITS), 1 << SLOT_BITS), np.uint32)
    for r in slots:
        counts[r.slot] = np.frombuffer(zlib.decompress(r.data), "<u4")
    hot = max(hot_least, int(HOT_TIMES * counts.mean()))
    sketch = spark.sparkContext.broadcast(counts.ravel())
    rows = seen.where("slot is null").select("doc_id", F.col("node").alias("hash"), "other", apart.alias("node"), "n")

    total = int(rows.agg(F.sum("n")).first()[0] or 0)
    run, schema = _prefixes(size, percent, sketch, hot, max(1, total // SHARD_SHINGLES))
    found = docs.mapInArrow(run, schema).groupBy("shard").applyInArrow(_shared_keys, "token long, node long, n int, core boolean, hot boolean")
    known = F.count("*").over(Window.partitionBy("node"))
    width = float(np.log(100 / percent))
    band = F.floor(F.log("n") / F.lit(width) + F.lit(1e-9)).cast("int")
    tokens = found.withColumn("known", known).where(F.col("known") > F.floor(F.col("n") / SPARE)).where("core")
    tokens = shared.table(tokens.select("token", "node", "hot", F.explode(F.array(band, band + 1)).alias("band")), "tokens")
    group = Window.partitionBy("token", "band")
    cold = tokens.where("not hot").withColumn("leader", F.min("node").over(group)).select("leader", "band", "node")
    warm = tokens.where("hot")
    warm = warm.join(warm.groupBy("token", "band").agg(F.min("node").alias("leader")), ["token", "band"]).select("leader", "band", "node")
    members = shared.table(cold.unionByName(warm).where("leader <> node").distinct(), "members")

    big = members.groupBy("leader", "band").count().where(F.col("count") > limit)
    big = shared.table(big.select("leader", "band", F.ceil(F.col("count") / limit).cast("int").alias("blocks")), "big")
    placed = members.join(big, ["leader", "band"], "left").select("leader", "band", "node", F.coalesce(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.lit(0)).alias("part"))
    heads = placed.groupBy("leader", "band", "part").agg(F.first("leader").alias("node")).select("leader", "band", "node", "part")
    blocks = placed.unionByName(heads).select("leader", "band", "part", F.lit(0).alias("side"), "node", F.lit(None).cast("long").alias("component"))
    one = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"))

    def links(blocks: DataFrame) -> DataFrame:
        b = blocks.join(one, "node").alias("b")
        d = _marked(docs, blocks).alias("d")
        full = b.hint("merge").join(d, (F.col("b.node") == F.col("d.node")) & F.col("b.doc_id").eqNullSafe(F.col("d.doc_id"))).select("leader", "band", "part", "side", "b.node", "component", "text")
        return full.groupBy("leader", "band", "part", "side").applyInArrow(_block(size, percent, sketch), "u long, v long")

    blocks = shared.table(blocks, "blocks")
    edges = shared.table(links(blocks), "links")
    component = connected_components(edges)
    if not big.isEmpty():
        wide = members.join(big, ["leader", "band"]).select("leader", "band", "node", "blocks")
        wide = wide.unionByName(big.select("leader", "band", F.col("leader").alias("node"), "blocks"))
        wide = wide.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
        most = wide.groupBy("leader", "band", "component").count().groupBy("leader", "band").agg(F.max_by("component", F.struct("count", "component")).alias("main"), F.sum("count").alias("all"), F.max("count").alias("top"))
        most = most.where(F.col("all") > F.col("top")).select("leader", "band", "main", F.ceil((F.col("all") - F.col("top")) / limit).cast("int").alias("sides"))
        wide = shared.table(wide.join(most, ["leader", "band"]), "open")
        here, side = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("node", F.lit(1)), F.col("sides")).cast("int")
        every = F.sequence(F.lit(0), F.col("sides") - 1)
        rest = wide.select("leader", "band", here.alias("part"), F.explode(every).alias("side"), "node", "component")
        left = wide.where("component <> main").select("leader", "band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), side.alias("side"), "node", "component")
        more = shared.table(links(shared.table(rest.unionByName(left), "blocks")), "links")
        component = merge_components(component, more)
    # By text first: copies of one text are many rows, and meet their component once.
    without = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "node")
    texts = rows.where("n > 0").groupBy("node").agg(F.min(without).alias("least")).join(component, "node", "left").select("node", "least", F.coalesce("component", "node").alias("root"))
    # Texts of one component are many as well: they are spread over SPREAD copies of what its smallest one is.
    every = texts.groupBy("root").agg(F.min("least").alias("least")).select("root", "least", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt"))
    found = texts.select("node", "root", F.pmod(F.xxhash64("node", F.lit(2)), F.lit(SPREAD)).cast("int").alias("salt")).join(every, ["root", "salt"]).select("node", "least")
    joined = rows.join(found, "node", "left")
    none = F.col("least").isNull()
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(none, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"), "hash", "other", (none | (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("node") == F.col("least.node")))).alias("first"))


@shared.any_names
def keep_first(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` of each component, with all of its columns, and the rows without words.

    The row with the smallest doc_id stays, then that with the smallest hash of its text; rows without
    doc_id stay only where no linked row has one. Of rows that repeat both id and text one stays. Columns of
    any name are carried; an empty table gives no rows.
    """
    marked = join(docs, size, percent).where("first").select("doc_id", "hash", "other").distinct().alias("m")
    whole = docs.select(docs["doc_id"].cast("long").alias("doc_id"), *[h.alias(c) for h, c in zip(_names(docs["text"].cast("string")), ("hash", "other"))], F.struct(*[docs[c].alias(f"_{i}") for i, c in enumerate(docs.columns)]).alias("row")).alias("w")
    same = F.col("w.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("w.hash") == F.col("m.hash")) & (F.col("w.other") == F.col("m.other"))
    rows = whole.join(marked.hint("merge"), same).select("w.doc_id", "w.hash", "w.other", "row")
    return rows.dropDuplicates(["doc_id", "hash", "other"]).select(*[F.col("row")[f"_{i}"].alias(c) for i, c in enumerate(docs.columns)])
