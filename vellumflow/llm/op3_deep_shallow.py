"""Removal of repeated byte strings with sampled suffixes and deep-shallow sorting.

A window is WINDOW bytes of a document. Of every window's GRAM-byte grams the one with the least hash
is its anchor, so equal windows have equal anchors at equal places, and only about one suffix in
forty, that at an anchor, is sorted. An anchor's context is what windows around it can reach: REACH
bytes before it and WINDOW bytes from it on.

1. Anchors are dealt by hash. Of anchors with equal contexts all but the first lie in repeats over
   the whole context. Tasks settle this for what they have read before anything is sent, so that a
   passage costs at most one record per task.
2. Where one gram has several contexts their bytes are fetched, one for each different context.
3. These are sorted, forwards from the anchor and backwards from it: multikey quicksort, a word of
   eight bytes as a letter, to a shallow depth, then blind tries for the groups that still agree. The
   common prefixes of neighbours give classes of equal windows; in each all but the first are repeats.
4. The spans of a document are merged and cut out.

Records travel as plain packed bytes, those that a task has for one bucket in one row, texts as
compressed Arrow batches likewise: a row costs the same few bytes however many tasks and buckets there are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellumflow.llm.common import table, utf8, written

WINDOW = 100
GRAM = 24
SPREAD = WINDOW - GRAM + 1  # grams in a window
REACH = WINDOW - GRAM  # bytes of a window before its anchor
SHALLOW = 4  # words of eight bytes
SLICE = 1 << 20
MARGIN = 2 * WINDOW + 56
HELD = 1 << 20  # anchors that a task settles at a time
BUCKET_BYTES = 8 << 20
ROWS_AT_ONCE = 4096
ODD = np.uint64(0x9E3779B97F4A7C15)
FIRST = -(2**63)
ROW = "bucket int, kind int, blob binary"
SPANS, ANCHORS, WANTED, TEXTS, CONTEXTS = range(5)
#: What a record of each kind holds, byte by byte.
RECORDS = {
    SPANS: np.dtype([("doc", "<i8"), ("version", "<i8"), ("low", "<i8"), ("size", "<i4")]),
    ANCHORS: np.dtype([("gram", "<u8"), ("context", "<u8"), ("doc", "<i8"), ("version", "<i8"), ("place", "<i8"), ("right", "u1")]),
    WANTED: np.dtype([("gram", "<u8"), ("doc", "<i8"), ("version", "<i8"), ("place", "<i8")]),
    CONTEXTS: np.dtype([("gram", "<u8"), ("doc", "<i8"), ("version", "<i8"), ("place", "<i8"), ("right", "u1"), ("around", "u1", (REACH + WINDOW,))]),
}


def from_blob(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all().combine_chunks()


def to_blob(**columns) -> bytes:
    batch = pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def rows_of(bucket: np.ndarray, kind: int, **columns):
    """Records dealt to their buckets, a row for each bucket."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    packed = np.empty(len(order), RECORDS[kind])
    for name, values in columns.items():
        packed[name] = values[order]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(order)]])
    size = packed.itemsize
    for first in range(0, len(starts) - 1, ROWS_AT_ONCE):
        cut = starts[first : first + ROWS_AT_ONCE + 1]
        ends = ((cut - cut[0]) * size).astype(np.int32)
        blobs = pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(ends), pa.py_buffer(packed[cut[0] : cut[-1]].tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(bucket[cut[:-1]], pa.int32()), pa.array(np.full(len(cut) - 1, kind), pa.int32()), blobs], ["bucket", "kind", "blob"])


def records(group: pa.Table, kind: int) -> np.ndarray:
    """All records of a kind in a group of rows."""
    rows = group.filter(pc.equal(group.column("kind"), kind)).column("blob")
    parts = []
    for chunk in rows.chunks:
        data, ends = utf8(chunk)
        parts.append(data[ends[0] : ends[-1]] if len(chunk) else data[:0])
    return np.concatenate([np.zeros(0, np.uint8), *parts]).view(RECORDS[kind])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * ODD
    return x ^ x >> np.uint64(29)


def document_bucket(doc: np.ndarray, version: np.ndarray, n: int) -> np.ndarray:
    return (mixed(doc.astype(np.int64).view(np.uint64) * ODD + version.astype(np.int64).view(np.uint64)) % np.uint64(n)).astype(np.int32)


def _letters() -> np.ndarray:
    """A random word for each byte, and one for what lies between documents."""
    return np.random.default_rng(3).integers(1, 2**63, 257).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over x[i:i + width], for each i with a whole stretch."""
    done = 1
    while done * 2 <= width:
        x, done = pick(x[:-done], x[done:]), done * 2
    return pick(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def anchors(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(piece, place, gram hash, context hash) of the anchors of some byte arrays."""
    letters = _letters()
    sizes = np.array([len(p) for p in pieces], np.int64)
    starts = np.concatenate([[0], (sizes + WINDOW).cumsum()[:-1]]) + WINDOW
    data = np.zeros(int((sizes + WINDOW).sum()) + 2 * WINDOW, np.uint8)
    outside = np.ones(len(data), bool)
    for a, p in zip(starts.tolist(), pieces):
        data[a : a + len(p)] = p
        outside[a : a + len(p)] = False
    h = letters[data]
    h[outside] = letters[256]
    width, known = 1, {}
    while width < GRAM:  # hashes of 1, 2, 4 ... bytes from those of half the length
        known[width] = h
        if width * 2 > GRAM:
            break
        h = h[:-width] * _power(width) + h[width:]
        width *= 2
    rest = GRAM - width
    if rest:  # GRAM is a sum of two powers of two
        h = h[: len(h) - rest] * _power(rest) + known[rest][width : width + len(h) - rest]
    order = (mixed(h) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = _sliding(order, SPREAD, np.minimum)
    whole = np.zeros(len(least), bool)
    for a, n in zip(starts.tolist(), sizes.tolist()):
        if n >= WINDOW:
            whole[a : a + n - WINDOW + 1] = True
    least[~whole] = 0
    reach = _sliding(np.concatenate([np.zeros(SPREAD - 1, np.uint32), least]), SPREAD, np.maximum)
    at = np.flatnonzero(reach == order[: len(reach)])
    context = np.zeros(len(at), np.uint64)
    for step in (-REACH, GRAM - REACH, 2 * GRAM - REACH, -GRAM, 0, GRAM, 2 * GRAM, 3 * GRAM, WINDOW - GRAM):
        context = mixed(context * ODD + h[at + step])
    piece = np.searchsorted(starts, at, "right") - 1
    return piece, at - starts[piece], mixed(h[at] * ODD), context


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(ODD), n, 1 << 64))


def settle(gram, context, doc, version, place, right):
    """Order of the records by gram, context and occurrence; which are the first of their context (of
    equal doc and place, all); and where a new context and a new gram begin."""
    order = np.lexsort((place, doc, context, gram))
    g, c, d, p = gram[order], context[order], doc[order], place[order]
    new_gram = np.concatenate([[True], g[1:] != g[:-1]])
    new = new_gram | np.concatenate([[True], c[1:] != c[:-1]])
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    first = (d == d[head]) & (p == p[head])
    return order, first, new, new_gram


def _spans(doc, version, place, right, n_buckets: int):
    """Whole contexts as spans to remove."""
    low = place - np.minimum(place, REACH)
    yield from rows_of(document_bucket(doc, version, n_buckets), SPANS, doc=doc, version=version, low=low, size=place - low + right)


def _pieces(text: np.ndarray):
    """A text in slices with what lies around them: (bytes, offset, from, to) with the part that counts."""
    if len(text) <= 2 * SLICE:
        yield text, 0, 0, len(text)
        return
    for at in range(0, len(text), SLICE):
        a, b = max(0, at - MARGIN), min(len(text), at + SLICE + MARGIN)
        yield text[a:b], a, at, min(at + SLICE, len(text))


def scan(batches, n_buckets: int):
    """Step 1, where the texts are read."""
    held: list[tuple] = []

    def flush():
        if not held:
            return
        columns = [np.concatenate(x) for x in zip(*held)]
        held.clear()
        gram, context, doc, version, place, right = columns
        order, first, _, _ = settle(*columns)
        again = order[~first]
        yield from _spans(doc[again], version[again], place[again], right[again], n_buckets)
        keep = np.sort(order[first])  # in reading order, which packs best
        yield from rows_of((gram[keep] % np.uint64(n_buckets)).astype(np.int32), ANCHORS, gram=gram[keep], context=context[keep], doc=doc[keep], version=version[keep], place=place[keep], right=right[keep])

    for batch in batches:
        data, ends = utf8(batch.column("text"))
        docs, versions = batch.column("doc").to_numpy(), batch.column("version").to_numpy()
        waiting: list[tuple] = []
        size = 0
        for i in range(batch.num_rows):
            text = data[ends[i] : ends[i + 1]]
            if len(text) < WINDOW:
                continue
            for part in _pieces(text):
                waiting.append((i, len(text), *part))
                size += len(part[0])
                if size >= SLICE:
                    held.append(_records(waiting, docs, versions))
                    waiting, size = [], 0
                    if sum(len(x[0]) for x in held) >= HELD:
                        yield from flush()
        if waiting:
            held.append(_records(waiting, docs, versions))
    yield from flush()


def _records(waiting: list[tuple], docs: np.ndarray, versions: np.ndarray) -> tuple:
    piece, place, gram, context = anchors([w[2] for w in waiting])
    row, length, offset, low, high = (np.array([w[k] for w in waiting], np.int64)[piece] for k in (0, 1, 3, 4, 5))
    place = place + offset
    own = (place >= low) & (place < high)
    row, place = row[own], place[own]
    return gram[own], context[own], docs[row], versions[row], place, np.minimum(WINDOW, length[own] - place)


def compare(group: pa.Table, n_buckets: int) -> list[pa.RecordBatch]:
    """Step 1, where a gram's anchors meet: spans and wanted contexts."""
    out = group.filter(pc.equal(group.column("kind"), SPANS)).select(["bucket", "kind", "blob"]).to_batches()
    found = records(group, ANCHORS)
    if not len(found):
        return out
    columns = [found[c] for c in ("gram", "context", "doc", "version", "place", "right")]
    gram, _, doc, version, place, right = columns
    order, first, new, new_gram = settle(*columns)
    again = order[~first]
    out += _spans(doc[again], version[again], place[again], right[again], n_buckets)
    which = new_gram.cumsum() - 1
    several = np.bincount(which, new)[which] > 1
    ask = order[several & first]
    out += rows_of(document_bucket(doc[ask], version[ask], n_buckets), WANTED, doc=doc[ask], version=version[ask], place=place[ask], gram=gram[ask])
    return out


def pack_texts(batches, n_buckets: int):
    """Texts by document bucket."""
    for batch in batches:
        doc, version = batch.column("doc").to_numpy(), batch.column("version").to_numpy()
        bucket = document_bucket(doc, version, n_buckets)
        text = batch.column("text").cast(pa.large_binary())
        order = np.argsort(bucket, kind="stable")
        for run in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if len(run):
                taken = pa.array(run)
                blob = to_blob(doc=doc[run], version=version[run], unnamed=batch.column("unnamed").take(taken), text=text.take(taken))
                yield pa.RecordBatch.from_arrays([pa.array([bucket[run[0]]], pa.int32()), pa.array([TEXTS], pa.int32()), pa.array([blob], pa.binary())], ["bucket", "kind", "blob"])


def _lookup(doc, version, docs, versions) -> tuple[np.ndarray, np.ndarray]:
    """For each document the run [from, to) of records that are its own; records sorted alike."""
    key = np.rec.fromarrays([docs, versions])
    wanted = np.rec.fromarrays([doc, version])
    return np.searchsorted(key, wanted, "left"), np.searchsorted(key, wanted, "right")


def contexts(texts: pa.Table, asked: pa.Table, n_buckets: int) -> list[pa.RecordBatch]:
    """Step 2: the bytes around wanted anchors, by bucket of the gram."""
    wanted, out = records(asked, WANTED), []
    if not len(wanted):
        return out
    doc, version, place, gram = (wanted[c] for c in ("doc", "version", "place", "gram"))
    order = np.lexsort((place, version, doc))
    doc, version, place, gram = doc[order], version[order], place[order], gram[order]
    seen = set()
    for blob in texts.column("blob").to_pylist():
        held = from_blob(blob)
        data, ends = utf8(held.column("text"))
        own, versions = held.column("doc").to_numpy(), held.column("version").to_numpy()
        # Documents side by side with room for contexts around them.
        low, high = _lookup(own, versions, doc, version)
        take, base, room = [], [], []
        size = 0
        for i, (a, b) in enumerate(zip(low.tolist(), high.tolist())):
            key = (int(own[i]), int(versions[i]))
            if a == b or key in seen:
                continue
            seen.add(key)
            room += [np.zeros(WINDOW, np.uint8), data[ends[i] : ends[i + 1]]]
            take.append(np.arange(a, b))
            base.append((np.full(b - a, size + WINDOW), np.full(b - a, ends[i + 1] - ends[i])))
            size += WINDOW + int(ends[i + 1] - ends[i])
        if not take:
            continue
        room = np.concatenate([*room, np.zeros(WINDOW, np.uint8)])
        take = np.concatenate(take)
        start, length = (np.concatenate(x) for x in zip(*base))
        for at in range(0, len(take), 1 << 16):
            t, s, n = take[at : at + (1 << 16)], start[at : at + (1 << 16)], length[at : at + (1 << 16)]
            around = np.lib.stride_tricks.sliding_window_view(room, REACH + WINDOW)[s + place[t] - REACH]
            out += rows_of((gram[t] % np.uint64(n_buckets)).astype(np.int32), CONTEXTS, gram=gram[t], doc=doc[t], version=version[t], place=place[t], right=np.minimum(WINDOW, n - place[t]), around=around)
    return out


def blind_trie(keys: list[int], bits: int) -> tuple[list[int], list[int]]:
    """Order of keys of `bits` bits, and the bits each has in common with the one before it in that
    order (`bits` for equal ones, 0 for the first). Inner nodes hold only the place of the bit that
    parts their keys; a key goes down blindly and is compared once, with the leaf it comes to."""
    if len(keys) == 2:
        x = keys[0] ^ keys[1]
        return ([0, 1] if keys[0] <= keys[1] else [1, 0]), [0, bits - x.bit_length()]
    root: list = [bits, [0]]  # leaf: [bits, members]; node: [place, low, high]
    for i in range(1, len(keys)):
        key, node = keys[i], root
        while len(node) == 3:
            node = node[1 + (key >> bits - 1 - node[0] & 1)]
        x = key ^ keys[node[1][0]]
        if not x:
            node[1].append(i)
            continue
        place = bits - x.bit_length()
        above, node = None, root
        while len(node) == 3 and node[0] < place:
            above, node = node, node[1 + (key >> bits - 1 - node[0] & 1)]
        leaf = [bits, [i]]
        fresh = [place, node, leaf] if key >> bits - 1 - place & 1 else [place, leaf, node]
        if above is None:
            root = fresh
        else:
            above[1 + (key >> bits - 1 - above[0] & 1)] = fresh
    order: list[int] = []
    common: list[int] = []
    todo: list[tuple] = [(root, 0)]
    while todo:
        node, parted = todo.pop()
        if len(node) == 3:
            todo += [(node[2], node[0]), (node[1], parted)]
        else:
            order += node[1]
            common += [parted, *[bits] * (len(node[1]) - 1)]
    return order, common


def multikey_quicksort(words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of words by the first `depth` of them, and a number for each place of that order
    that is the same for rows that agree so far. All groups are parted side by side: each by a pivot of
    its own into rows with a smaller, the same and a larger word; those with the same go on to the next."""
    n = len(words)
    order, group = np.arange(n), np.zeros(n, np.int64)
    at = np.zeros(n, np.int64)  # the word that a place's group is parted by
    left = np.arange(n) if n > 1 else np.zeros(0, np.int64)  # places in groups not yet done
    while len(left):
        key = words[order[left], at[left]]
        starts = np.flatnonzero(np.concatenate([[True], group[left][1:] != group[left][:-1]]))
        sizes = np.diff(np.append(starts, len(left)))
        three = np.sort(np.stack([key[starts], key[starts + sizes // 2], key[starts + sizes - 1]]), axis=0)
        pivot = np.repeat(three[1], sizes)
        side = np.where(key < pivot, 0, np.where(key == pivot, 1, 2))
        own = np.repeat(np.arange(len(starts)), sizes) * 3 + side
        by = np.argsort(own, kind="stable")
        order[left], own, side = order[left][by], own[by], side[by]
        at[left] = at[left][by] + (side == 1)
        # A group's number is that of its first place.
        heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        sizes = np.diff(np.append(heads, len(left)))
        group[left] = np.repeat(left[heads], sizes)
        left = left[(np.repeat(sizes, sizes) > 1) & (at[left] < depth)]
    return order, group


def deep_shallow(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a byte matrix, and the bytes that each has in common with the one before it
    in that order."""
    n, width = strings.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = strings
    words = padded.view(">u8").astype(np.uint64)
    order, group = multikey_quicksort(words, min(SHALLOW, words.shape[1]))
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, n))
    if padded.shape[1] > SHALLOW * 8 and (sizes > 1).any():
        tail = np.ascontiguousarray(padded[:, SHALLOW * 8 :])
        step = tail.shape[1]
        raw = tail.tobytes()
        for a, k in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            rows = order[a : a + k].copy()
            keys = [int.from_bytes(raw[i * step : i * step + step], "big") for i in rows.tolist()]
            order[a : a + k] = rows[blind_trie(keys, step * 8)[0]]
    common = np.zeros(n, np.int64)
    same = np.ones(max(0, n - 1), bool)  # neighbours that agree so far
    for k in range(words.shape[1]):
        x = words[order[1:], k] ^ words[order[:-1], k]
        common[1:] += np.where(same, _leading_bytes(x), 0)
        same &= x == 0
    return order, np.minimum(common, width)


def _leading_bytes(x: np.ndarray) -> np.ndarray:
    """Leading zero bytes of 64-bit words."""
    out = np.zeros(len(x), np.int64)
    for k in range(1, 9):
        out += x < np.uint64(1) << np.uint64(64 - 8 * k) if k < 8 else x == 0
    return out


def repeats(gram: np.ndarray, doc: np.ndarray, place: np.ndarray, right: np.ndarray, around: np.ndarray):
    """(record, low, size) of the spans that windows seen earlier cover, among contexts of equal grams."""
    first = np.lexsort((place, doc))
    gram, doc, place, right, around = gram[first], doc[first], place[first].astype(np.int64), right[first].astype(np.int64), around[first]
    n = len(gram)
    head = np.ascontiguousarray(gram.astype(">u8")).view(np.uint8).reshape(n, 8)
    sides = [deep_shallow(np.concatenate([head, side], axis=1)) for side in (around[:, REACH:], around[:, :REACH][:, ::-1])]

    def classes(side: int, length: int) -> np.ndarray:
        order, common = sides[side]
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(common < 8 + length)
        return out

    when = np.unique(np.rec.fromarrays([doc, place]), return_inverse=True)[1]
    left = np.minimum(place, REACH)
    most, least = np.full(n, -1), np.full(n, WINDOW)
    for offset in range(REACH + 1):
        ahead = classes(0, WINDOW - offset)
        able = np.flatnonzero((left >= offset) & (right >= WINDOW - offset))
        able = able[np.bincount(ahead[able], minlength=n + 1)[ahead[able]] > 1]
        if len(able) < 2:
            continue
        both = ahead[able] * (n + 1) + classes(1, offset)[able]
        order = np.argsort(both, kind="stable")  # within a class by occurrence, as the records are
        able, both = able[order], both[order]
        new = np.concatenate([[True], both[1:] != both[:-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(len(able)), 0))
        later = able[when[able] > when[able[start]]]
        most[later] = offset
        least[later] = np.minimum(least[later], offset)
    hit = np.flatnonzero(most >= 0)
    return first[hit], place[hit] - most[hit], WINDOW + most[hit] - least[hit]


def sort_contexts(group: pa.Table, n_buckets: int) -> list[pa.RecordBatch]:
    """Step 3 for the grams of a bucket."""
    found = records(group, CONTEXTS)
    gram, doc, version, place, right, around = (found[c] for c in ("gram", "doc", "version", "place", "right", "around"))
    record, low, size = repeats(gram, doc, place, right, around)
    return [*rows_of(document_bucket(doc[record], version[record], n_buckets), SPANS, doc=doc[record], version=version[record], low=low, size=size)]


def cut(texts: pa.Table, spans: pa.Table):
    """Step 4: (doc_id, n_bytes, kept bytes, spans) of each document of a bucket."""
    found = records(spans, SPANS)
    doc, version, low, size = (found[c] for c in ("doc", "version", "low", "size"))
    order = np.lexsort((low, version, doc))
    doc, version, low, high = doc[order], version[order], low[order], (low + size)[order]
    for blob in texts.column("blob").to_pylist():
        held = from_blob(blob)
        data, ends = utf8(held.column("text"))
        own, versions = held.column("doc").to_numpy(), held.column("version").to_numpy()
        unnamed = held.column("unnamed").to_pylist()
        for i, (a, b) in enumerate(zip(*(x.tolist() for x in _lookup(own, versions, doc, version)))):
            text = data[ends[i] : ends[i + 1]]
            runs: list[tuple[int, int]] = []
            if a < b:
                until = np.maximum.accumulate(high[a:b])
                heads = np.flatnonzero(np.concatenate([[True], low[a + 1 : b] > until[:-1]]))
                runs = list(zip(low[a:b][heads].tolist(), until[np.append(heads[1:], b - a) - 1].tolist()))
            kept, at = [], 0
            for x, y in runs:
                kept.append(text[at:x])
                at = y
            kept.append(text[at:])
            yield None if unnamed[i] else int(own[i]), len(text), b"".join(k.tobytes() for k in kept), runs


def _table(batches: list[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(batches, pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())]))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """(texts, spans, buckets): texts and their spans to remove as blobs by document bucket, ready to be
    cogrouped and cut()."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    named = docs.select(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(FIRST)).alias("doc"), F.xxhash64(body).alias("version"), F.col(f"`{key}`").isNull().alias("unnamed"), body.alias("text"))
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    n = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    anchors_ = named.select("doc", "version", "text").mapInArrow(lambda batches: scan(batches, n), ROW)
    # Spans found while reading only pass through: they go by the bucket they will be wanted in.
    met = written(anchors_.groupBy("bucket").applyInArrow(lambda group: _table(compare(group, n)), ROW), "met")
    texts = named.mapInArrow(lambda batches: pack_texts(batches, n), ROW)
    asked = met.where(F.col("kind") == WANTED)
    fetched = texts.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(lambda a, b: _table(contexts(a, b, n)), ROW)
    spans = fetched.groupBy("bucket").applyInArrow(lambda group: _table(sort_contexts(group, n)), ROW)
    return texts, met.where(F.col("kind") == SPANS).union(written(spans, "spans")), n


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept) for every row: each byte covered
    by a window that also starts earlier is removed. Earlier is a smaller doc_id, null before all, or in
    the same document a smaller start.

    Null texts are empty; texts under WINDOW bytes are kept; very long texts are read whole, a slice at a
    time; rows of equal doc_id count as one document, so that equal rows do not remove each other; no rows
    give no rows. Other columns, whatever their names, are not looked at. kept is null unless with_text."""
    texts, spans, _ = repeated_spans(docs, key, text)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary()]

    def finish(a: pa.Table, b: pa.Table) -> pa.Table:
        rows = [(doc, size, size - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), runs, kept if with_text else None) for doc, size, kept, runs in cut(a, b)]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names)

    return texts.groupBy("bucket").cogroup(spans.groupBy("bucket")).applyInArrow(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>, kept binary")


def op3_deep_shallow_dedup(spark, sf_dir: str) -> DataFrame:
    """What is removed from every document as repeats of 100 bytes or more."""
    out = without_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
