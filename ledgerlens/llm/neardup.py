"""Near-duplicate documents: MinHash signatures in an LSH forest.

A document's set holds the hashes of its distinct word shingles.  Documents with
equal sets form one node; everything below runs on nodes, so copies cost nothing
however many there are.

Forest: every tree sorts the nodes by its own order of signature columns (range
partitioned and sorted by Spark; the node id breaks ties, so even a crowd of
equal prefixes is split over tasks).  In a tree, nodes that share at least
LEAST columns of the order are in one region.  Candidates are sorted neighbours;
the depth adapts to the region: two nodes up to NEAR places apart are a
candidate if the region of their common prefix has at most NEAR + 1 nodes, i.e.
crowded regions are resolved at a greater depth, and where even the deepest
prefix is crowded every node is paired with the next one.  Every pair met in any
tree is tested: similar documents meet in about 0.8 ** LEAST of the trees (about
one pair in twenty million at 0.8 meets in none).

Candidates are confirmed on the full sets (the texts of candidate nodes only are
read again), and components come from alternating star contraction.  In a crowd a
document may be like few others and not be next to them in any tree.  So the nodes
that stayed outside their neighbourhood's largest component meet all of it on the
full sets (``stray_links``), and all nodes of crowded regions, whatever they are
like, meet across neighbourhoods by an exact prefix filter (``crowd_pairs``).

Defined results: a null text or one without words has an empty set, is linked
with nothing and is its own component.  With fewer words than a shingle has, the
whole sequence is one shingle.  Repeated rows have equal sets and so share a
component.  A component without any id has a null id; ids repeated on different
texts do not link those texts.  An empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import chars
from ledgerlens.llm.common import written

WIDTH, PERCENT = 5, 80
HASHES, TREES, DEPTH, LEAST, NEAR = 128, 32, 8, 4, 8
CLOSE, BLOCK = 15, 500_000
MOST_HELD = 50_000  # rows of a crowd kept waiting for its end
MEET, SALTS = 1_000, 256  # sets of one token that meet in a task, parts a token's sets are dealt to before
SIZE_STEPS = 4096  # a node's last 16 bits hold this times the natural logarithm of its set's size
SLOT_BITS, SLOT_PARTS = 20, 16  # counters of shingles that tell rare from common
NO_ID = -(1 << 63)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x5851F42D4C957F2D)  # odd, so its powers have inverses
_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(1 << 62, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ORDERS = [_RANDOM.permutation(HASHES)[:DEPTH] for _ in range(TREES)]
_POWERS: list[np.ndarray] = []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _POWERS[:] = [np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, b, dtype=np.uint64)])) for b in (_BASE, inverse)]
    return _POWERS[0][:n], _POWERS[1][:n]


def _space(raw: np.ndarray) -> np.ndarray:
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def word_sums(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, polynomial, length) of the words of UTF-8 bytes that end in white
    space; A-Z count as a-z."""
    space = _space(raw)
    low = np.where((raw >= 65) & (raw <= 90), raw | 32, raw).astype(np.uint64)
    edge = np.diff(~space, prepend=False, append=False).nonzero()[0]
    at, end = edge[::2], edge[1::2]
    up, down = _powers(len(raw))
    sums = np.concatenate([[np.uint64(0)], np.cumsum((low + np.uint64(1)) * up)])
    return at, (sums[end] - sums[at]) * down[at], (end - at).astype(np.uint64)


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text, in order."""
    row, held = 0, []  # words so far of the text at ``row``
    cut = None  # (polynomial, length) of the word its last part ends in

    def done() -> np.ndarray:
        rest = [] if cut is None else [_mixed(cut[0] + cut[1] * _MIX)]
        w = np.concatenate([*held, *rest]) if held or rest else np.zeros(0, dtype=np.uint64)
        if not len(w):
            return w
        size = min(width, len(w))
        h = np.full(len(w) - size + 1, np.uint64(size))
        for k in range(size):
            h = h * _MIX + w[k: len(w) - size + 1 + k]
        return np.unique(_mixed(h))

    for rows, raw, starts in chars.byte_chunks(texts, space=chars.ASCII_SPACE):
        at, sums, lengths = word_sums(raw)
        cuts = np.searchsorted(at, starts[1:])
        ends = [*(starts[1:] - 1), len(raw) - 1]
        for i, (r, x, n) in enumerate(zip(rows, np.split(sums, cuts), np.split(lengths, cuts))):
            if r != row:
                yield done()
                row, held, cut = r, [], None
            if cut is not None:
                if _space(raw[starts[i]: starts[i] + 1])[0]:
                    held.append(_mixed(cut[0] + cut[1] * _MIX))
                else:  # the word goes on
                    x[:1] = cut[0] + x[:1] * np.uint64(pow(int(_BASE), int(cut[1][0]), 1 << 64))
                    n[:1] += cut[1]
                cut = None
            more = i + 1 == len(rows) or rows[i + 1] == r  # the text may have another part
            if more and len(x) and not _space(raw[ends[i] - 1: ends[i]])[0]:
                cut = x[-1:], n[-1:]
                x, n = x[:-1], n[:-1]
            held.append(_mixed(x + n * _MIX))
    if texts:
        yield done()


def node_of(shingles: np.ndarray) -> bytes:
    """128 bits that equal sets share: 112 of a hash, then the size's logarithm
    (sizes from about 8.9 million shingles on share the highest)."""
    a = int(_mixed(shingles + _MIX).sum(dtype=np.uint64)), int(_mixed(shingles ^ _BASE).sum(dtype=np.uint64))
    size = min(0xFFFF, int(SIZE_STEPS * np.log(max(1, len(shingles)))))
    return b"".join(x.to_bytes(8, "big") for x in a)[:14] + size.to_bytes(2, "big")


def alike_in_size(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of the given size logarithms can be as similar as ``percent``:
    the smaller set has at least that share of the larger one's size."""
    return np.abs(a - b) <= 1 + SIZE_STEPS * np.log(100 / percent)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest of the set under each hash; 16 bits of each."""
    best = np.full(HASHES, np.uint64((1 << 64) - 1))
    for part in np.array_split(shingles, len(shingles) // 4096 + 1):
        if len(part):
            best = np.minimum(best, ((part[:, None] * _FACTORS) >> np.uint64(24)).min(axis=0))
    return (best & np.uint64(0xFFFF)).astype(">u2")


def features(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(doc_id, n_shingles, node, sig), one row per document; node and sig null for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chars.sliced(batches):
            n, node, sig = [], [], []
            for s in shingle_sets(batch.column(1).to_pylist(), width):
                n.append(len(s))
                node.append(node_of(s) if len(s) else None)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(sig, pa.binary())],
                                             names=["doc_id", "n_shingles", "node", "sig"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, node binary, sig binary")


def forest(nodes: DataFrame) -> DataFrame:
    """(tree, key, node): every node once per tree, in that tree's column order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<u2").reshape(n, HASHES)
            for tree, order in enumerate(_ORDERS):
                keys = np.ascontiguousarray(sig[:, order]).view(f"V{2 * DEPTH}").ravel()
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, tree, dtype=np.int32)), pa.array([k.tobytes() for k in keys], pa.binary()),
                                                  batch.column(0)], names=["tree", "key", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "tree int, key binary, node binary")


def _adjacent(tree: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Number of leading columns a row shares with the next one."""
    same = np.cumprod(keys[1:] == keys[:-1], axis=1).sum(axis=1)
    return np.where(tree[1:] == tree[:-1], same, 0)


def neighbours(tree: np.ndarray, keys: np.ndarray, begun: bool = False, goes_on: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first row, second row) of the candidates of a sorted run, and the rows whose
    region is crowded, or may be as it has ``begun`` before the run or ``goes_on``."""
    n = len(tree)
    step = _adjacent(tree, keys)
    region = np.empty((DEPTH + 1, n), dtype=np.int64)  # size of a row's region by depth
    crowd = np.zeros(n, dtype=bool)
    for depth in range(LEAST, DEPTH + 1):
        run = np.concatenate([[0], np.cumsum(step < depth)])
        region[depth] = np.bincount(run)[run]
        if depth == LEAST:
            crowd = (region[depth] > NEAR + 1) | (begun & (run == 0)) | (goes_on & (run == run[-1]))
    firsts, seconds = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    common = step.copy()
    for gap in range(1, NEAR + 1):
        if gap > 1:
            common = np.minimum(common[:-1], step[gap - 1:])
        i = np.flatnonzero(common >= LEAST)
        if not len(i):
            break
        if gap > 1:
            i = i[region[common[i], i] <= NEAR + 1]
        firsts.append(i)
        seconds.append(i + gap)
    return np.concatenate(firsts), np.concatenate(seconds), np.flatnonzero(crowd)


def candidates(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): pairs of nodes to confirm, a < b, and the nodes of crowded regions, a = b.

    Pairs whose sizes rule out even a close miss are left out.  A region cut by the
    end of a partition or of a held run counts as crowded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # from the last region on, which may go on in the next batch
        begun = True
        for batch in _ended(batches):
            table = held if batch is None else pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            if table is None or not len(table):
                continue
            tree = table.column("tree").to_numpy()
            keys = np.frombuffer(b"".join(table.column("key").to_pylist()), dtype=">u2").reshape(len(tree), DEPTH)
            end, goes_on = len(tree), batch is None
            if batch is not None:
                breaks = np.flatnonzero(_adjacent(tree, keys) < LEAST)
                end = int(breaks[-1]) + 1 if len(breaks) else 0
                if len(tree) - end > MOST_HELD:  # a crowd: go on without waiting for its end
                    end, goes_on = len(tree) - NEAR, True
                held = table.slice(end).combine_chunks()
            if not end:
                continue
            i, j, crowd = neighbours(tree[:end], keys[:end], begun, goes_on)
            begun = goes_on
            node = table.column("node").to_pylist()
            size = np.frombuffer(b"".join(n[-2:] for n in node), dtype=">u2").astype(np.int64)
            fits = alike_in_size(size[i], size[j], max(1, percent - CLOSE))
            i, j = i[fits], j[fits]
            pairs = [(node[x], node[y]) if node[x] < node[y] else (node[y], node[x]) for x, y in zip(i.tolist(), j.tolist())]
            pairs += [(node[x], node[x]) for x in crowd.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())],
                                             names=["a", "b"])

    rows = forest(nodes)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(n, "tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    return sorted_rows.mapInArrow(run, "a binary, b binary").distinct()


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after more links, of which only the roots' graph is contracted."""
    def named(df: DataFrame, c: str) -> DataFrame:
        r = roots.select(F.col("node").alias(c), F.col("root").alias("_r"))
        return df.join(r, c, "left").withColumn(c, F.coalesce("_r", c)).drop("_r")

    links = written(links, "more-links")
    ends = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    known = roots.unionByName(ends.join(roots, "node", "left_anti").select("node", F.col("node").alias("root")))
    up = components(named(named(links, "a"), "b").filter("a <> b")).select(F.col("node").alias("root"), F.col("root").alias("up"))
    return known.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, link): link if the full sets meet 100 * intersection >= percent *
    union; pairs that miss it by no more than CLOSE are given too."""
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    both = left.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, link = [], []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                small, large = sorted((x, y), key=len)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                common = int((large[at] == small).sum())
                union = len(x) + len(y) - common
                keep.append(100 * common >= (percent - CLOSE) * union)
                link.append(100 * common >= percent * union)
            chosen = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(link, pa.bool_())], names=["a", "b", "link"])
            yield chosen.filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary, link boolean")


def sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(node, shingles) of the wanted (node, doc_id): their texts are read again.

    Rows without an id are one key; they are dealt to SALTS parts by their text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chars.sliced(batches):
            found = [s for s in shingle_sets(batch.column(1).to_pylist(), width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([node_of(s) for s in found], pa.binary()),
                                              pa.array([s.tobytes() for s in found], pa.binary())], names=["id", "own", "shingles"])

    parts = F.when(F.col("id") == NO_ID, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    ids = wanted.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id")).distinct().select("id", F.explode(parts).alias("part"))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("part", F.when(F.col("id") == NO_ID, F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int")).otherwise(0))
    made = rows.join(ids, ["id", "part"], "left_semi").select("id", "text").mapInArrow(run, "id long, own binary, shingles binary")
    keys = wanted.select("node", F.coalesce("doc_id", F.lit(NO_ID)).alias("want"))
    # An id repeated on equal texts gives its set twice.
    return made.join(keys, (F.col("id") == F.col("want")) & (F.col("own") == F.col("node")), "left_semi").select(
        F.col("own").alias("node"), "shingles").dropDuplicates(["node"])


def _stars(e: DataFrame) -> bool:
    """Every u has one v, and no v is a u."""
    many = e.groupBy("u").count().filter("count > 1").select("u")
    return many.unionByName(e.join(e.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u")).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes with an edge (a, b): alternating large and small
    star contraction, each round a written table."""
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = written(large.filter("u <> v").distinct(), "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(least, "u")
        small = met.select("u", F.col("m").alias("v")).unionByName(met.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        e = written(small.distinct(), "stars")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def overlaps(one: np.ndarray, shingle: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many of ``one``'s shingles each of n sets holds; the sets come as all
    their (shingle, owner) sorted by shingle."""
    low, high = np.searchsorted(shingle, one, side="left"), np.searchsorted(shingle, one, side="right")
    count = high - low
    at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
    return np.bincount(owner[at], minlength=n)


def stray_links(sets: DataFrame, around: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(a, b): the links that join components inside a neighbourhood, one at least
    for each stray and component it is linked to.

    ``around`` has the neighbourhoods (node, near): what confirmed links and close
    misses connect.  All of one's nodes outside its largest component (the strays)
    meet all of its nodes on the full sets.  Both sides come in blocks of about
    BLOCK shingles, every pair of blocks is a group of its own, and only links
    leave it."""
    own = around.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    own = own.join(sets.withColumn("n", F.octet_length("shingles") / 8), "node")
    parts = own.groupBy("near", "root").agg(F.count("*").alias("size"), F.sum("n").alias("n"))
    whole = parts.groupBy("near").agg(F.sum("size").alias("size"), F.sum("n").alias("n"), F.max(F.struct("size", "root", "n")).alias("top"), F.count("*").alias("parts"))
    whole = whole.filter((F.col("parts") > 1) & (F.col("size") > NEAR + 1))
    whole = written(whole.select("near", F.col("top.root").alias("largest"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
                                 F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("lots")), "neighbourhoods")
    members = written(own.drop("n").join(whole, "near"), "members")
    block, lot = (F.pmod(F.xxhash64("node"), F.col(c)).cast("int") for c in ("blocks", "lots"))

    def each(c: str):
        return F.explode(F.sequence(F.lit(0), F.col(c) - 1))

    rows = members.select("near", block.alias("block"), each("lots").alias("lot"), "node", "root", "shingles")
    strays = members.filter("root <> largest").select("near", each("blocks").alias("block"), lot.alias("lot"), "node", "root", "shingles")

    def meet(s: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[bytes, bytes]] = []
        if len(s) and len(m):
            held = [np.frombuffer(x, dtype=np.uint64) for x in m["shingles"]]
            sizes = np.array([len(x) for x in held])
            shingle, owner = np.concatenate(held), np.repeat(np.arange(len(held)), sizes)
            order = np.argsort(shingle, kind="stable")
            shingle, owner = shingle[order], owner[order]
            root, node = m["root"].to_numpy(), m["node"].to_numpy()
            for n, r, x in zip(s["node"], s["root"], s["shingles"]):
                x = np.frombuffer(x, dtype=np.uint64)
                common = overlaps(x, shingle, owner, len(held))
                hits = np.flatnonzero((100 * common >= percent * (len(x) + sizes - common)) & (root != r))
                found += [(n, y) if n < y else (y, n) for y in {root[h]: node[h] for h in hits}.values()]
        return pd.DataFrame(found, columns=["a", "b"])

    keys = ["near", "block", "lot"]
    return strays.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(meet, "a binary, b binary").distinct()


def slot_counts(sets: DataFrame) -> np.ndarray:
    """How many sets hold a shingle, by its leading SLOT_BITS bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.uint64)
            counts += np.bincount((held >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(counts))
        if counts.any():
            parts = np.split(counts, SLOT_PARTS)
            yield pa.RecordBatch.from_arrays([pa.array(range(SLOT_PARTS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        whole = np.sum([np.frombuffer(x, dtype=np.int64) for x in rows["counts"]], axis=0)
        return pd.DataFrame({"part": rows["part"].iloc[:1], "counts": [whole.tobytes()]})

    made = sets.select("shingles").mapInArrow(run, "part int, counts binary").groupBy("part").applyInPandas(add, "part int, counts binary")
    parts = [np.frombuffer(r["counts"], dtype=np.int64) for r in sorted(made.collect(), key=lambda r: r["part"])]
    return np.concatenate(parts) if parts else np.zeros(1 << SLOT_BITS, dtype=np.int64)


def rarest(x: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, shingle) of the prefix of a set in the order from rare to common, of
    which sets as similar as ``percent`` share at least one; shingles of one set
    only are left out."""
    often = counts[(x >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
    order = np.lexsort((x, often))[: len(x) - -(-percent * len(x) // 100) + 1]
    at = np.flatnonzero(often[order] > 1)
    return at, x[order[at]]


def crowd_pairs(sets: DataFrame, around: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: the pairs of the sets (of nodes of crowds) in different
    components and not in one of the neighbourhoods ``around`` (all of those were
    compared) that can reach ``percent`` by an exact prefix filter.

    Each shingle's most common neighbourhood takes part on one side only, so a
    shingle that just one neighbourhood has gives no work.  Both sides of a shingle
    come in blocks of about MEET sets, and every pair of blocks is a group of its
    own, so a shingle that a crowd shares is spread over tasks."""
    counts = sets.sparkSession.sparkContext.broadcast(slot_counts(sets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                held = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in part.column("shingles")]
                found = [rarest(x, counts.value, percent) for x in held]
                times = [len(p) for p, _ in found]
                owner = pa.array(np.repeat(np.arange(len(part)), times))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([t for _, t in found]).view(np.int64)), pa.array(np.concatenate([p for p, _ in found]).astype(np.int32)),
                     pa.array(np.repeat([len(x) for x in held], times).astype(np.int32)), *(part.column(c).take(owner) for c in ("node", "root", "done"))],
                    names=["token", "place", "n", "node", "root", "done"])

    own = sets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(around, "node", "left")
    own = own.select("node", "root", F.coalesce("near", "root").alias("done"), "shingles")
    rows = written(own.mapInArrow(run, "token long, place int, n int, node binary, root binary, done binary"), "prefixes")
    parts = rows.groupBy("token", "done").agg(F.count("*").alias("size"))
    tops = parts.groupBy("token").agg(F.max(F.struct("size", "done")).alias("top"), F.sum("size").alias("size"), F.count("*").alias("parts"))
    tops = tops.filter("parts > 1").select("token", F.col("top.done").alias("top"), F.ceil(F.col("size") / MEET).cast("int").alias("blocks"),
                                           F.ceil((F.col("size") - F.col("top.size")) / MEET).cast("int").alias("lots"))
    # What is known of a token goes to each part of its sets, at most SALTS of them.
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    there = salted.select("token", "salt").distinct().join(tops, "token")
    known = written(salted.join(there, ["token", "salt"]).drop("salt"), "shared-prefixes")
    block, lot = (F.pmod(F.xxhash64("node", F.lit(1)), F.col(c)).cast("int") for c in ("blocks", "lots"))

    def each(c: str):
        return F.explode(F.sequence(F.lit(0), F.col(c) - 1))

    sides = ("token", "place", "n", "node", "root", "done")
    x = known.filter("done <> top").select(*sides, each("blocks").alias("block"), lot.alias("lot")).alias("x")
    y = known.select(*sides, block.alias("block"), each("lots").alias("lot")).alias("y")
    # What two sets share is at most what lies before and after a common place.
    most = F.least("x.place", "y.place") + 1 + F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) - 1
    fits = (100 + percent) * most.cast("long") >= percent * (F.col("x.n") + F.col("y.n")).cast("long")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("token", "block", "lot")]
    met = x.join(y, same[0] & same[1] & same[2] & (F.col("x.done") != F.col("y.done")) & (F.col("x.root") != F.col("y.root")) & fits)
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, node, root, component_id, kept), one row per document;
    node stands for its set, root for its component.

    ``docs`` must be read from files: the candidates' texts are read again."""
    rows = written(features(docs, id_col, text_col, width), "features")
    nodes = written(rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.max("sig").alias("sig")), "nodes")
    met = written(candidates(nodes, percent), "candidates")
    pairs = met.filter("a <> b")
    asked = met.select(F.col("a").alias("node")).unionByName(met.select(F.col("b").alias("node"))).distinct()
    wanted = written(nodes.select("node", "doc_id").join(asked, "node", "left_semi"), "asked")
    sets = written(sets_of(docs, wanted, id_col, text_col, width), "sets")
    close = written(confirm(pairs, sets, percent), "links")
    links = close.filter("link")
    roots = written(components(links), "roots")
    around = written(components(close).withColumnRenamed("root", "near"), "around")
    roots = written(merged(roots, stray_links(sets, around, roots, percent)), "roots")
    crowd = sets.join(met.filter("a = b").select(F.col("a").alias("node")), "node", "left_semi")
    compared = around.join(around.groupBy("near").count().filter(F.col("count") > NEAR + 1), "near", "left_semi")
    more = written(crowd_pairs(crowd, compared, roots, percent), "crowd-pairs")
    roots = written(merged(roots, confirm(more, sets, percent).filter("link").select("a", "b")), "roots")
    grouped = nodes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = written(grouped.join(ids, "root").select("node", "root", "component_id"), "components")
    out = rows.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.withColumn("component_id", component).select(
        "doc_id", "n_shingles", "node", "root", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
