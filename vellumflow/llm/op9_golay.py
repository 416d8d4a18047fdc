"""SimHash near-duplicates by Golay-code fuzzy hashing.

The 64 bits of a fingerprint are three segments of 23, 23 and 18 bits. Every 23-bit word lies within
three bits of exactly one codeword of the perfect (23, 12) Golay code, whose 12-bit index serves as
its hash. Four errors leave at most two in some pair of segments, and two words of at most two
errors have a common neighbour within one bit of each; so the codeword indices of a pair of segments
and of all its one-bit neighbours hold a shared key for every two fingerprints at distance four or
less. Fingerprints that share a key are compared bit by bit.
"""

from __future__ import annotations

import re
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.llm.common import document_bytes, table, written
from vellumflow.llm.components import components, spanning

GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, a generator of the (23, 12) Golay code
SEGMENTS = ((0, 23), (23, 23), (46, 18))
DISTANCE = 4
SLICE = 1 << 20
SMALL = 32
RUN, SAMPLED = 1 << 16, 64
BROADCAST_ROWS = 1_000_000


def shingle_hashes(text: bytes, width: int):
    """Arrays of XXH64 (seed 42) of the text's word shingles, repeats included, a slice of the text
    at a time; fewer words than the width are one shingle, no words none."""
    from xxhash import xxh64_intdigest

    text = text.lower()
    at, carry, found = 0, [], False
    while at < len(text):
        cut = re.compile(rb"[\x20\x09-\x0D]").search(text, at + SLICE) if at + SLICE < len(text) else None
        end = cut.start() if cut else len(text)
        words = carry + text[at:end].split()
        at = end
        if len(words) >= width:
            found = True
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1]
            yield np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[width - 1 :].tolist())], np.uint64)
            carry = words[-(width - 1) :] if width > 1 else []
        else:
            carry = words
    if carry and not found:
        yield np.array([xxh64_intdigest(b" ".join(carry), 42)], np.uint64)


def bit_sums(hashes: np.ndarray, many: int = 1) -> np.ndarray:
    """For each bit, in how many of the hashes it is set; in further rows that of the hashes scrambled in
    further ways."""
    sums = np.zeros((many, 64), np.int64)
    for k in range(many if len(hashes) else 0):
        if k:
            hashes = (hashes ^ hashes >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
            hashes = hashes ^ hashes >> np.uint64(29)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # Eight byte-wide counters to a word: sums of up to 255 rows do not overflow.
        words = np.add.reduceat(bits.view(np.uint64), np.arange(0, len(bits), 255), axis=0)
        sums[k] = words.view(np.uint8).sum(axis=0, dtype=np.int64)
    return sums


def as_print(margins: np.ndarray) -> np.ndarray:
    """The 64 bits of each row, set where the margin is above zero, as int64."""
    return np.packbits(margins > 0, axis=-1, bitorder="little").view(np.int64)[..., 0]


def simhash(text: bytes, width: int) -> int:
    """Bit i is set if it is set in over half of the shingle hashes; no words give 0."""
    sums, n = np.zeros((1, 64), np.int64), 0
    for hashes in shingle_hashes(text, width):
        sums, n = sums + bit_sums(hashes), n + len(hashes)
    return int(as_print(2 * sums - n)[0])


@cache
def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainder of each 12-bit message times x^11, and the index bits of the error of each syndrome."""
    remainder = np.arange(1 << 12, dtype=np.int64) << 11
    for bit in range(22, 10, -1):
        remainder = np.where(remainder >> bit & 1, remainder ^ (GENERATOR << (bit - 11)), remainder)
    error = np.zeros(1 << 11, np.int64)
    for weight in range(4):
        for bits in combinations(range(23), weight):
            word = sum(1 << b for b in bits)
            error[(word & 2047) ^ remainder[word >> 11]] = word
    return remainder, error >> 11


def codeword_index(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    remainder, error = golay_tables()
    return (words >> 11) ^ error[(words & 2047) ^ remainder[words >> 11]]


def keys_of(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all distinct keys of int64 fingerprints: three pairs of segments, each with the
    indices of the pair and of its one-bit neighbours."""
    near = []
    for low, width in SEGMENTS:
        word = (fingerprints.view(np.uint64) >> np.uint64(low)).astype(np.int64) & ((1 << width) - 1)
        near.append(codeword_index(word[:, None] ^ np.array([0, *(1 << i for i in range(width))])))
    rows, keys = [], []
    for pair, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        both = np.concatenate([near[i] << 12 | near[j][:, :1], near[i][:, :1] << 12 | near[j][:, 1:]], axis=1)
        both.sort(axis=1)
        first = np.ones(both.shape, bool)
        first[:, 1:] = both[:, 1:] != both[:, :-1]
        rows.append(np.nonzero(first)[0])
        keys.append(both[first] | pair << 24)
    return np.concatenate(rows), np.concatenate(keys).astype(np.int32)


def near(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], distance: int) -> np.ndarray:
    """Whether fingerprints of one or more 64-bit words differ in `distance` bits or fewer."""
    return sum(np.bitwise_count((x ^ y).view(np.uint64)).astype(np.uint16) for x, y in zip(a, b)) <= distance


def _run_links(keys: np.ndarray, prints: list[np.ndarray], distance: int = DISTANCE):
    """Links (a, b) of positions within runs of equal keys: in each run enough of its links to connect what they
    all do. Runs of up to SMALL prints are compared all at once, longer ones block by block."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(starts, len(keys)))
    small = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
    k, p = keys[small], [x[small] for x in prints]
    labels = np.arange(len(k))
    for step in range(1, SMALL):
        same = np.flatnonzero(k[step:] == k[:-step])
        if not len(same):
            break
        close = same[near([x[same] for x in p], [x[same + step] for x in p], distance)]
        close = close[spanning(labels, close, close + step)]
        yield small[close], small[close + step]
    for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        run, labels = [x[start : start + size] for x in prints], np.arange(size)
        for a in range(0, size, 256):
            own = np.unique(labels[a : a + 256])
            # What is connected already need not be compared.
            others = a + np.flatnonzero(labels[a:] != own[0]) if len(own) == 1 else np.arange(a, size)
            for b in range(0, len(others), 1024):
                at = others[b : b + 1024]
                left, right = np.nonzero(near([x[a : a + 256, None] for x in run], [x[None, at] for x in run], distance))
                left, right = left + a, at[right]
                apart = labels[left] != labels[right]
                left, right = left[apart], right[apart]
                joined = spanning(labels, left, right)
                yield start + left[joined], start + right[joined]


def links(prints: DataFrame, keyed, words: list[str], distance: int) -> DataFrame:
    """Links (a, b) between `fp` of prints that share a key and differ in `distance` or fewer bits of
    their `words`: of all such links enough to connect what they all do.

    keyed(prints) has the rows (key int, *words). Each key's fingerprints meet in one task, a run of
    equal keys after the other. Keys of more than about RUN fingerprints are found in a sample of one
    in SAMPLED, and their runs are dealt out as pairs of blocks of that size."""

    def join(batches):
        kept: list[np.ndarray] = []
        for batch in _with_end(batches):
            if batch is not None:
                new = [batch.column(c).to_numpy() for c in ("key", *words)]
                kept = [np.concatenate(x) for x in zip(kept, new)] if kept else new
                if len(kept[0]) < 100_000:
                    continue
            if not kept:
                return
            whole = len(kept[0]) if batch is None else int(np.searchsorted(kept[0], kept[0][-1]))
            keys, rows = kept[0][:whole], [x[:whole] for x in kept[1:]]
            for a, b in _run_links(keys, rows, distance) if whole else ():
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(rows[0][a]), pa.array(rows[0][b])], ["a", "b"])
            kept = [x[whole:] for x in kept]

    def met(rows: DataFrame) -> DataFrame:
        return rows.select("key", *words).repartition(F.col("key")).sortWithinPartitions("key").mapInArrow(join, "a long, b long")

    some = keyed(prints.where(F.pmod(F.xxhash64("fp"), F.lit(SAMPLED)) == 0)).groupBy("key").agg(F.count("*").alias("n"))
    hot = written(some.where(F.col("n") > RUN // SAMPLED).select("key", F.ceil(F.col("n") * SAMPLED / RUN).cast("long").alias("blocks")), "hot")
    if not hot.take(1):
        return met(keyed(prints))
    hot = F.broadcast(hot) if hot.count() <= BROADCAST_ROWS else hot
    rows, own = keyed(prints), F.pmod(F.xxhash64("fp"), F.col("blocks"))
    dealt = rows.join(hot, "key").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pair = F.xxhash64("key", F.least(own, F.col("other")), F.greatest(own, F.col("other"))).alias("key")
    return met(rows.join(hot, "key", "left_anti")).union(met(dealt.select(pair, *words)))


def _with_end(batches):
    yield from batches
    yield None


def fingerprints(docs: DataFrame, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) of whole texts; null and wordless texts have 0."""

    def fold(batches):
        for batch in batches:
            found = [simhash(x, width) for x in document_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(fold, "doc_id long, fp long")


def _keyed(prints: DataFrame) -> DataFrame:
    """(key, fp): the keys of each fp that find all others at DISTANCE."""

    def spread(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            for at in range(0, len(fp), 4096):
                rows, keys = keys_of(fp[at : at + 4096])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fp[at : at + 4096][rows])], ["key", "fp"])

    return prints.mapInArrow(spread, "key int, fp long")


def near_duplicates(docs: DataFrame, width: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row: component_id is the smallest doc_id whose fingerprint
    can be reached by links of DISTANCE or fewer differing bits.

    Texts are lower-cased (A-Z) and cut into words at ASCII white space; null and wordless texts have
    fingerprint 0 and link like any other; very long texts are hashed whole, a slice at a time. Equal
    fingerprints are one node, so copies never meet as pairs. Rows with a null doc_id take part; a
    component without any doc_id has a null component_id. Repeated rows stay; no rows give no rows.
    Other columns, whatever their names, are not looked at.
    """
    found = written(fingerprints(docs, width, key, text), "fingerprints")
    prints = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labels = components(links(prints.select("fp"), _keyed, ["fp"], DISTANCE))
    named = prints.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = written(named, "labels")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return found.join(named.join(least, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def margin_keys(margins: np.ndarray) -> np.ndarray:
    """PROBES keys for each of KEYED fingerprints of two segments, by rows of their bits' margins: the
    codeword indices of the two segments and of the words that come of flipping, of the UNSURE bits
    with the least margins in each segment, those that take the least squared margin in all."""
    segments = margins[:, : KEYED * 46].reshape(len(margins), KEYED, 2, 23).astype(np.float32)
    words, size = ((segments > 0) << np.arange(23)).sum(axis=-1), np.abs(segments)
    unsure = np.argpartition(size, UNSURE, axis=-1)[..., :UNSURE]
    subsets = (np.arange(1 << UNSURE)[:, None] >> np.arange(UNSURE) & 1).T
    cost = np.take_along_axis(size, unsure, -1) ** 2 @ subsets.astype(np.float32)
    index = codeword_index(words[..., None] ^ np.left_shift(1, unsure) @ subsets)
    order = np.argsort(cost, axis=-1, kind="stable")
    cost, index = np.take_along_axis(cost, order, -1), np.take_along_axis(index, order, -1)
    for k in range(1, 1 << UNSURE):  # a codeword counts once, with its least cost
        cost[..., k][(index[..., k : k + 1] == index[..., :k]).any(axis=-1)] = np.inf
    both = (cost[:, :, 0, :, None] + cost[:, :, 1, None, :]).reshape(len(margins), KEYED, -1)
    first, second = np.divmod(np.argpartition(both, PROBES, axis=-1)[..., :PROBES], 1 << UNSURE)
    pairs = np.take_along_axis(index[:, :, 0], first, -1) << 12 | np.take_along_axis(index[:, :, 1], second, -1)
    return (pairs | np.arange(KEYED)[:, None] << 24).reshape(len(margins), -1).astype(np.int32)


WIDTH = 5
SIMILARITY = 0.8
#: Bits of two texts at SIMILARITY differ with a chance of 0.15. The keys of one fingerprint then miss the
#: pair in 0.57 of all cases, those of all KEYED in about 6e-4, and CANDIDATE misses 1e-3.
KEYED, UNSURE, PROBES = 13, 4, 16
SCRAMBLES = 12  # words of 64 bits: KEYED times 46 bits, and the last two as CHECKED bits to compare
CANDIDATE = 32  # differing bits of 128 at which a pair is worth comparing
BLOCK = 8 << 20  # bytes of text whose pairs are compared in one go
LINKS = 1 << 16  # links thinned in one task
PIVOTS = 64  # texts of a group of several blocks that each of its blocks is compared with


def shingle_set(text: bytes) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(text, WIDTH)]))


def _described(docs: DataFrame) -> DataFrame:
    """(node, id, size, fp, fp2, keys) of documents (node, id, text): size in bytes, CHECKED bits and
    the keys of the set of shingles; a text without words has no keys."""
    id_type = docs.schema["id"]

    def fold(batches):
        for batch in batches:
            columns = batch.column("node"), batch.column("id"), batch.column("text")
            for at in range(0, batch.num_rows, 512):
                node, id_, text = (c.slice(at, 512) for c in columns)
                texts = document_bytes(text)
                sets = [shingle_set(x) for x in texts]
                margins = np.array([2 * bit_sums(x, SCRAMBLES) - len(x) for x in sets]).reshape(-1, SCRAMBLES * 64)
                prints = as_print(margins[:, -128:].reshape(-1, 2, 64))
                some = [len(x) > 0 for x in sets]
                keys = [k if s else [] for k, s in zip(margin_keys(margins), some)]
                found = pa.array([len(x) for x in texts], pa.int64()), *(pa.array(prints[:, k].copy()) for k in (0, 1)), pa.array(keys, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([node, id_, *found], ["node", "id", "size", "fp", "fp2", "keys"])

    from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

    kinds = [("node", LongType()), ("id", id_type.dataType), ("size", LongType()), ("fp", LongType()), ("fp2", LongType()), ("keys", ArrayType(IntegerType()))]
    return docs.select("node", "id", "text").mapInArrow(fold, StructType([StructField(n, k) for n, k in kinds]))


def _thinned(links: DataFrame) -> DataFrame:
    """Fewer links (a, b) that connect the same: a spanning forest of every LINKS of them."""

    def forest(batches):
        found = [np.stack([batch.column(c).to_numpy() for c in ("a", "b")]) for batch in batches if batch.num_rows]
        if found:
            a, b = np.concatenate(found, axis=1)
            nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
            used = spanning(np.arange(len(nodes)), at[: len(a)], at[len(a) :])
            yield pa.RecordBatch.from_arrays([pa.array(a[used]), pa.array(b[used])], ["a", "b"])

    links = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "close")
    return links.repartition(1 + links.count() // LINKS).mapInArrow(forest, "a long, b long")


def _similar(sets: list[np.ndarray], labels: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links between sets whose Jaccard similarity is SIMILARITY or more: enough to connect, with the
    equal labels, all that such pairs connect. Pairs are all there are, or, where `right` has any, those
    of a set that is not `right` and a later one that is."""
    sizes = np.array([len(x) for x in sets])
    words, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ids = np.split(flat, np.cumsum(sizes)[:-1])
    marked, labels, out = np.zeros(len(words), bool), labels.copy(), []
    targets = np.flatnonzero(right) if right.any() else np.arange(len(sets))
    for i in np.flatnonzero(~right & (sizes > 0)):
        j = targets[np.searchsorted(targets, i, "right") :]
        j = j[(labels[j] != labels[i]) & (np.minimum(sizes[j], sizes[i]) >= SIMILARITY * np.maximum(sizes[j], sizes[i]))]
        if not len(j):
            continue
        marked[ids[i]] = True
        both = np.add.reduceat(marked[np.concatenate([ids[x] for x in j])], np.cumsum(sizes[j]) - sizes[j], dtype=np.int64)
        marked[ids[i]] = False
        j = j[both >= SIMILARITY * (sizes[i] + sizes[j] - both)]
        joined, first = np.unique(labels[j], return_index=True)
        out += [(int(i), int(x)) for x in j[first]]
        labels[np.isin(labels, joined)] = labels[i]
    return out


def _one_each(whole: DataFrame, chosen: DataFrame, by: list[str]) -> DataFrame:
    """The documents of `whole` named by (node, least) of chosen, one for each of its rows; chosen has
    `times`, how many equal documents there are, and rows that `by` tells apart."""
    found = whole.join(chosen.withColumnRenamed("node", "of"), (F.col("node") == F.col("of")) & F.col("id").eqNullSafe(F.col("least"))).drop("of")
    if not chosen.where("times > 1").take(1):
        return found
    return found.where("times = 1").union(found.where("times > 1").dropDuplicates(["node", "least", *by]))


def _verified(whole: DataFrame, dealt: DataFrame) -> DataFrame:
    """Links (a, b) of SIMILARITY or more between the nodes of each task of dealt(task, right, node,
    least, times, label), whose texts are those of `whole`."""

    def compare(rows):
        nodes, sides, labels, texts = zip(*((n, *v) for n, v in sorted(rows.items(), key=lambda x: (x[1][0], x[0]))))
        found = _similar([shingle_set(x) for x in texts], np.array(labels), np.array(sides, bool))
        return pa.RecordBatch.from_arrays([pa.array([nodes[i[side]] for i in found], pa.int64()) for side in (0, 1)], ["a", "b"])

    def run(batches):
        task, rows = None, {}
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("task", "node", "right", "label")]
            for t, node, right, label, text in zip(*columns, document_bytes(batch.column("text"))):
                if t != task:
                    if len(rows) > 1:
                        yield compare(rows)
                    task, rows = t, {}
                rows.setdefault(node, (right, label, text))
        if len(rows) > 1:
            yield compare(rows)

    met = _one_each(whole.select("node", "id", "text"), dealt, ["task", "right"])
    return met.select("task", "node", "right", "label", "text").repartition(F.col("task")).sortWithinPartitions("task").mapInArrow(run, "a long, b long")


def _first_blocks(members: DataFrame) -> DataFrame:
    """Tasks of the first round: the blocks of each group, each with some nodes that all of them have."""
    block = F.pmod(F.xxhash64("node"), "blocks")
    shared = members.where((F.col("blocks") > 1) & (F.pmod(F.xxhash64("node", F.lit(1)), "n") < PIVOTS)).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    both = members.withColumn("block", block).unionByName(shared.where(F.col("block") != block))
    return both.select(F.xxhash64("group", "block").alias("task"), F.lit(False).alias("right"), "node", "least", "times", F.col("node").alias("label"))


def _further_blocks(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Tasks of the second round: within each group of several blocks, all pairs of blocks but those of
    one label. A label of BLOCK bytes or more has blocks to itself; the others share some."""
    labelled = members.where("blocks > 1").join(labels, "node", "left").withColumn("label", F.coalesce("component", "node"))
    sums = labelled.groupBy("group", "label").agg(F.sum("size").alias("bytes"))
    shared = sums.where(F.col("bytes") < BLOCK).groupBy("group").agg(F.ceil(F.sum("bytes") / BLOCK).alias("shared"))
    own = F.col("bytes") >= BLOCK
    part = F.when(own, F.pmod(F.xxhash64("node"), F.ceil(F.col("bytes") / BLOCK))).otherwise(-1 - F.pmod(F.xxhash64("label"), F.greatest("shared", F.lit(1))))
    dealt = labelled.join(sums, ["group", "label"]).join(shared, "group", "left").select("group", "node", "least", "times", "label", F.struct(F.when(own, F.col("label")).otherwise(0).alias("of"), part.alias("part")).alias("block"))
    dealt = written(dealt, "dealt")
    blocks = dealt.select("group", "block").distinct()
    pairs = blocks.withColumnRenamed("block", "x").join(blocks.withColumnRenamed("block", "y"), "group").where("x <= y and (x.part < 0 or x.of <> y.of)")
    pairs = written(pairs.withColumn("task", F.xxhash64("group", "x.of", "x.part", "y.of", "y.part")), "blocks")
    sides = [(F.col("block") == F.col("x")), (F.col("block") == F.col("y")) & (F.col("x") != F.col("y"))]
    tasks = [dealt.join(pairs, "group").where(w).select("task", F.lit(right).alias("right"), "node", "least", "times", "label") for right, w in zip((False, True), sides)]
    return tasks[0].union(tasks[1])


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near copies stays, that with the least doc_id.

    Near copies share SIMILARITY or more of their distinct five-word shingles. Equal texts are one node.
    Candidates share a Golay key of one of KEYED fingerprints and are near in two further words; what they
    connect is a group, and within each group all nodes that are not yet connected are compared shingle by
    shingle, in blocks. Null and wordless texts are copies of each other; a null doc_id is the last choice;
    of rows with equal doc_id and text one stays; very long texts are compared whole; no documents give
    none. Columns are renamed inside, so that no name can clash."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    key, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    worded = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    whole = docs.toDF(*names).withColumns({"node": F.xxhash64(F.when(worded, text).otherwise("")), "id": key, "text": text.cast("string")})
    described = written(_described(whole), "described")
    nodes = described.groupBy("node", "id").agg(F.count("*").alias("times"), F.max("size").alias("size"), F.max("fp").alias("fp"))
    nodes = nodes.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "times")).alias("m"), F.max("size").alias("size"), F.max("fp").alias("fp"))
    nodes = written(nodes.select("node", F.col("m.id").alias("least"), F.col("m.times").alias("times"), "size", "fp"), "nodes")
    # Nodes with equal fp are in one group, which the keys of all of them connect to others.
    prints = written(described.where(F.size("keys") > 0).select("fp", "fp2", "keys").distinct(), "prints")
    candidates = links(prints, lambda p: p.select(F.explode("keys").alias("key"), "fp", "fp2"), ["fp", "fp2"], CANDIDATE)
    groups = components(_thinned(candidates))
    grouped = written(nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("group", F.coalesce("component", "fp")).drop("fp", "component"), "groups")
    sums = grouped.groupBy("group").agg(F.count("*").alias("n"), F.greatest(F.ceil(F.sum("size") / BLOCK), F.lit(1)).alias("blocks")).where("n > 1")
    members = written(grouped.join(sums, "group"), "members")
    similar = written(_verified(whole, _first_blocks(members)), "similar")
    labels = components(similar)
    if members.where("blocks > 1").take(1):
        labels = components(similar.union(_verified(whole, _further_blocks(members, labels))))
    classes = nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = F.struct(F.col("least").isNull().alias("n"), "least", "node", "times")
    kept = written(classes.groupBy("component").agg(F.min(first).alias("k")).select("k.node", "k.least", "k.times"), "kept")
    return _one_each(whole, kept, []).select(*(F.col(n).alias(c) for n, c in zip(names, docs.columns)))


def op9_golay_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, by shingles of four words."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
