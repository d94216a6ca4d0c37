"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that also starts earlier.

The suffixes that matter are those whose first ``length`` bytes occur twice. Content-defined anchors
find them: the smallest hash among the ``GRAM``-byte strings of a window of ``length`` bytes depends
on the window alone, so equal windows have equal anchors at equal places. The windows of one anchor
are one stretch of text.

1. Anchors. Equal stretches are one class, whose first occurrence stands for it; the windows of the
   others all start earlier elsewhere. Classes are formed within each run of text first, then
   across runs by hash of the anchor, so a passage in a third of all documents is one record a run.
2. Suffix sort. A first occurrence whose anchor also has other stretches may share some windows with
   them, at the edge of a repeat. Suffixes of ``length`` bytes start every ``STRIDE`` bytes of such
   stretches. Each block of text sorts its suffixes and sends them front-coded (shared prefix
   length, rest), dealt by the prefix that all windows of the suffix have in common. The receiver
   merges the runs with a loser tree that keeps, for every run, the prefix its head shares with the
   last output: unequal prefixes decide without looking at bytes, equal ones compare from there on.
   The merged order and its prefix lengths are the suffix and LCP arrays; windows that start up to
   ``STRIDE`` - 1 bytes before a suffix are equal when the LCP reaches what they hold of it and the
   bytes before agree.
3. The windows found are united by document, and the rest of the bytes is hashed.

Defined cases: NULL text is the empty text; texts shorter than ``length`` lose nothing; rows without
an id are documents in order of a hash of their text, before all ids from -2^62 on, so they are dealt over all
blocks; rows of one id (or of none and one text) are one document at the same places: they never
remove each other's windows at equal starts, and what is found in one is removed from all; an empty
table gives no rows; other columns are not looked at and may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.common import blocks, mix, random_words, ready, slices, stored, utf8

LENGTH = 100
GRAM = 48
STRIDE = 8
BLOCK_BYTES = 8 << 20
RUN_BYTES = 32 << 20
BLOCKS = 16
_BYTE = random_words(41, 256)
_FACTOR = 0xD6E8FEB86659FD93
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_NO_ID = -(2**63)
#: kinds of packed rows: anchors to compare, stretches removed, stretches with other neighbours
ANCHOR, GONE, EDGE = 0, 1, 2
PACKED = "place int, kind int, data binary"
_STRETCH = np.dtype([("doc", "<i8"), ("low", "<i4"), ("high", "<i4"), ("at", "<i4")])
_ANCHOR = np.dtype([("gram", "<u8"), ("text", "<u8"), *_STRETCH.descr])


class Hashes:
    """Polynomial hashes of any stretch of a buffer, from prefix sums modulo 2^64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power = np.ones(n + 1, np.uint64)
        power[1:] = _FACTOR
        np.cumprod(power, out=power)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[:-1], out=self.sums[1:])
        self.back = np.ones(n + 1, np.uint64)
        self.back[1:] = _INVERSE
        np.cumprod(self.back, out=self.back)

    def of(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``(document, first window, last window, anchor, anchor hash, stretch hash)`` per anchor.

    Places are in ``data``; every window of ``length`` bytes inside a document has one anchor.
    """
    n, width = len(data), length - GRAM + 1
    sizes = np.diff(offsets)
    if not (sizes >= length).any():
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    hashes = Hashes(data)
    grams = np.full(n, np.iinfo(np.uint64).max)
    grams[: n - GRAM + 1] = hashes.of(np.arange(n - GRAM + 1), np.arange(GRAM, n + 1))
    least, size = grams, 1
    at = np.arange(n)
    while size < width:  # the first place of the least hash among ever more grams
        step = min(size, width - size)
        less = least[step:] < least[:-step]
        least, at = least.copy(), at.copy()
        least[:-step] = np.where(less, least[step:], least[:-step])
        at[:-step] = np.where(less, at[step:], at[:-step])
        size += step
    open_window = np.zeros(n + 1, np.int32)
    big = sizes >= length
    np.add.at(open_window, offsets[:-1][big], 1)
    np.add.at(open_window, offsets[1:][big] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(open_window[:-1]))
    place = at[starts]
    new = np.ones(len(starts), bool)
    new[1:] = place[1:] != place[:-1]
    heads = np.flatnonzero(new)
    low, high, place = starts[heads], starts[np.append(heads[1:], len(starts)) - 1], place[heads]
    owner = np.searchsorted(offsets, low, side="right") - 1
    text = hashes.of(low, high + length) ^ mix((place - low).astype(np.uint64))
    return owner, low, high, place, grams[place], text


def _unite(found: np.ndarray) -> np.ndarray:
    """Stretches of windows of a document, touching ones as one."""
    if not len(found):
        return found
    found = found[np.lexsort((found["low"], found["doc"]))]
    doc, low = found["doc"], found["low"]
    # Documents are apart, so running maxima only need to start anew at each of them.
    base = np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])]).astype(np.int64) << 32
    high = np.maximum.accumulate(base + found["high"]) - base
    new = np.ones(len(found), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (low[1:] > high[:-1] + 1)
    heads = np.flatnonzero(new)
    out = found[heads].copy()
    out["high"] = high[np.append(heads[1:], len(found)) - 1]
    return out


def _split(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first of each class, the later ones, whether the anchor of a first one has other classes)``."""
    found = found[np.lexsort((found["low"], found["doc"], found["text"], found["gram"]))]
    gram, text = found["gram"], found["text"]
    new_gram = np.ones(len(found), bool)
    new_gram[1:] = gram[1:] != gram[:-1]
    new = new_gram.copy()
    new[1:] |= text[1:] != text[:-1]
    first = found[new]
    lead = first[np.cumsum(new) - 1]
    later = found[(found["doc"] != lead["doc"]) | (found["low"] != lead["low"])]
    groups = np.cumsum(new_gram[new]) - 1
    return first, later, np.bincount(groups)[groups] > 1 if len(first) else np.zeros(0, bool)


def _packed(places: np.ndarray, kind: int, values: np.ndarray) -> list[tuple[int, int, bytes]]:
    order = np.argsort(places, kind="stable")
    places, values = places[order], values[order]
    heads = np.flatnonzero(np.append(True, places[1:] != places[:-1])) if len(places) else np.zeros(0, int)
    ends = np.append(heads[1:], len(places))
    return [(int(places[a]), kind, values[a:b].tobytes()) for a, b in zip(heads, ends)]


def _rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
        names=["place", "kind", "data"],
    )


def _stretches(found: np.ndarray) -> np.ndarray:
    out = np.empty(len(found), _STRETCH)
    for name in _STRETCH.names:
        out[name] = found[name]
    return out


def _find(batches, length: int, n: int, run_bytes: int):
    """Step 1 in a run of text: anchors to compare go by hash, stretches already known by themselves."""
    held, size = [], 0

    def flush():
        first, later, _ = _split(np.concatenate(held))
        later = _unite(_stretches(later))
        rows = _packed((first["gram"] % np.uint64(n)).astype(np.int64), ANCHOR, first)
        return _rows(rows + _packed(np.mod(later["doc"], n), GONE, later))

    for batch in batches:
        for part in slices(batch, "text", 1 << 20):  # some ten arrays of 8 bytes a byte of text
            data, offsets = utf8(part.column("text"))
            own, low, high, at, gram, text = anchors(data, offsets, length)
            found = np.empty(len(own), _ANCHOR)
            base = offsets[own]
            found["doc"] = np.asarray(part.column("doc_id"))[own]
            found["low"], found["high"], found["at"] = low - base, high - base, at - base
            found["gram"], found["text"] = gram, text
            held.append(found)
            size += len(data)
            if size >= run_bytes:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _resolve(table: pa.Table, n: int) -> pa.Table:
    """Step 1 across runs, for the anchors of one shard."""
    rows, anchored = [], []
    for place, kind, data in zip(*(table.column(c).to_pylist() for c in ("place", "kind", "data"))):
        if kind == ANCHOR:
            anchored.append(np.frombuffer(data, _ANCHOR))
        else:
            rows.append((place, kind, data))
    if anchored:
        first, later, mixed = _split(np.concatenate(anchored))
        later, edges = _unite(_stretches(later)), _stretches(first[mixed])
        rows += _packed(np.mod(later["doc"], n), GONE, later) + _packed(np.mod(edges["doc"], n), EDGE, edges)
    return pa.Table.from_batches([_rows(rows)])


def front_code(suffixes: list[bytes], payload: np.ndarray) -> bytes:
    """Sorted suffixes as counts, shared prefix lengths, rests, and payload rows."""
    shared, rests, before = bytearray(), [], b""
    for suffix in suffixes:
        k, most = 0, min(len(before), len(suffix), 255)
        if before[:most] == suffix[:most]:
            k = most
        else:
            low, high = 0, most
            while high - low > 1:
                middle = (low + high) // 2
                if before[:middle] == suffix[:middle]:
                    low = middle
                else:
                    high = middle
            k = low
        shared.append(k)
        rests.append(suffix[k:])
        before = suffix
    sizes = np.array([len(x) for x in rests], "<u2").tobytes()
    return b"".join([np.array([len(suffixes)], "<i8").tobytes(), bytes(shared), sizes, payload.tobytes(), *rests])


def front_decode(data: bytes, kind: np.dtype) -> tuple[list[int], list[bytes], np.ndarray]:
    """``(shared prefix lengths, whole suffixes, payload)`` of a front-coded run."""
    n = int(np.frombuffer(data, "<i8", 1)[0])
    at = 8
    shared = list(data[at : at + n])
    at += n
    sizes = np.frombuffer(data, "<u2", n, at)
    at += 2 * n
    payload = np.frombuffer(data, kind, n, at)
    at += n * kind.itemsize
    ends = (at + np.cumsum(sizes.astype(np.int64))).tolist()
    out, before = [], b""
    for k, end in zip(shared, ends):
        before = before[:k] + data[at:end]
        out.append(before)
        at = end
    return shared, out, payload


def common_prefix(a: bytes, b: bytes, start: int) -> int:
    """How many first bytes agree, given that ``start`` do."""
    most = min(len(a), len(b))
    step = 16
    while start < most:
        end = min(start + step, most)
        if a[start:end] != b[start:end]:
            while a[start] == b[start]:
                start += 1
            return start
        start = end
    return most


def merge(runs: list[tuple[list[int], list[bytes]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """``(run, place)`` of all suffixes in order, and the prefix each shares with the one before.

    A loser tree over the runs. Each contender carries the prefix length it shares with the last
    output; the longer one is the smaller suffix, and only a tie compares bytes, behind that length.
    The loser of a tie keeps the length it shares with the winner, which is the next output of that
    subtree, so no byte known to agree is looked at again. The next head of a run shares with the
    last output, its forerunner, what the front code says.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads = [0] * k
    ends = [len(r[1]) for r in runs] + [0] * (k - len(runs))
    shared = [0] * k
    current: list = [runs[i][1][0] if i < len(runs) and ends[i] else None for i in range(k)]
    losers = [0] * k

    def build(node: int) -> int:
        if node >= k:
            return node - k
        a, b = build(2 * node), build(2 * node + 1)
        if current[b] is None:
            losers[node] = b
            return a
        if current[a] is None:
            losers[node] = a
            return b
        both = common_prefix(current[a], current[b], 0)
        if current[a][both:] <= current[b][both:]:
            shared[b], losers[node] = both, b
            return a
        shared[a], losers[node] = both, a
        return b

    winner = build(1)
    shared[winner] = 0
    order, prefixes = [], []
    while current[winner] is not None:
        place = heads[winner]
        order.append((winner, place))
        prefixes.append(shared[winner])
        place += 1
        heads[winner] = place
        if place < ends[winner]:
            current[winner] = runs[winner][1][place]
            shared[winner] = runs[winner][0][place]
        else:
            current[winner] = None
            shared[winner] = -1
        node = (winner + k) // 2
        while node:
            other = losers[node]
            mine, his = shared[winner], shared[other]
            if current[other] is not None:
                if his > mine:
                    losers[node], winner = winner, other
                elif his == mine and current[winner] is not None:
                    a, b = current[winner], current[other]
                    both = common_prefix(a, b, mine)
                    if a[both:] <= b[both:]:
                        shared[other] = both
                    else:
                        shared[winner] = both
                        losers[node], winner = winner, other
            node //= 2
    return order, prefixes


_SUFFIX = np.dtype([("doc", "<i8"), ("start", "<i4"), ("before", "<u8"), ("first", "u1"), ("last", "u1")])


def _suffixes(documents: pa.Table, packed: pa.Table, length: int, n: int) -> pa.Table:
    """Step 2 in a block: the suffixes of its edges, sorted and front-coded by receiver."""
    edges = [np.frombuffer(x, _STRETCH) for x, k in zip(packed.column("data").to_pylist(), packed.column("kind").to_pylist()) if k == EDGE]
    if not edges or not documents.num_rows:
        return pa.Table.from_batches([_rows([])])
    edges = np.concatenate(edges)
    texts: dict[int, list[bytes]] = {}
    wanted = set(edges["doc"].tolist())
    for doc, text in zip(documents.column("doc_id").to_pylist(), documents.column("text").to_pylist()):
        if doc in wanted:
            texts.setdefault(doc, []).append(text.encode())
    piles: dict[int, list] = {}
    for doc, low, high, at in edges.tolist():
        for text in texts.get(doc, ()):
            for start in range(at - (at - high) // STRIDE * STRIDE, low - 1, -STRIDE):
                first, last = max(0, start - high), min(STRIDE - 1, start - low)
                if start + length - first > len(text):
                    continue
                left = int.from_bytes(text[max(0, start - STRIDE + 1) : start], "big")
                suffix = text[start : start + length]
                common = suffix[: length - STRIDE + 1]
                place = int.from_bytes(hashlib.blake2b(common, digest_size=8).digest(), "little") % n
                piles.setdefault(place, []).append((suffix, (doc, start, left, first, last)))
    rows = []
    for place, pile in piles.items():
        pile.sort()
        payload = np.array([p[1] for p in pile], _SUFFIX)
        rows.append((place, EDGE, front_code([p[0] for p in pile], payload)))
    return pa.Table.from_batches([_rows(rows)])


def _merge_runs(table: pa.Table, length: int, n: int) -> pa.Table:
    """Step 2 at a receiver: windows that also start earlier, as stretches."""
    runs = [front_decode(x, _SUFFIX) for x in table.column("data").to_pylist()]
    order, prefixes = merge([r[:2] for r in runs])
    order = np.array(order, np.int64)
    offsets = np.cumsum([0] + [len(r[2]) for r in runs])
    entries = np.concatenate([r[2] for r in runs])[offsets[order[:, 0]] + order[:, 1]]
    sizes = np.array([len(x) for r in runs for x in r[1]])[offsets[order[:, 0]] + order[:, 1]]
    prefixes = np.array(prefixes)
    found = []
    for back in range(STRIDE):
        rows = np.flatnonzero((entries["first"] <= back) & (entries["last"] >= back) & (sizes >= length - back))
        if len(rows) < 2:
            continue
        group = np.cumsum(prefixes < length - back)[rows]
        left = entries["before"][rows] & np.uint64((1 << (8 * back)) - 1)
        doc, start = entries["doc"][rows], entries["start"][rows] - back
        sort = np.lexsort((start, doc, left, group))
        group, left, doc, start = group[sort], left[sort], doc[sort], start[sort]
        new = np.ones(len(rows), bool)
        new[1:] = (group[1:] != group[:-1]) | (left[1:] != left[:-1])
        lead = np.flatnonzero(new)[np.cumsum(new) - 1]
        gone = (doc != doc[lead]) | (start != start[lead])
        out = np.zeros(int(gone.sum()), _STRETCH)
        out["doc"], out["low"], out["high"] = doc[gone], start[gone], start[gone]
        found.append(out)
    if not found:
        return pa.Table.from_batches([_rows([])])
    found = _unite(np.concatenate(found))
    return pa.Table.from_batches([_rows(_packed(np.mod(found["doc"], n), GONE, found))])


def _spans(packed: pa.Table, length: int) -> dict[int, list[tuple[int, int]]]:
    """Removed bytes ``[start, end)`` of each document, apart and in order."""
    found = [np.frombuffer(x, _STRETCH) for x, k in zip(packed.column("data").to_pylist(), packed.column("kind").to_pylist()) if k == GONE]
    if not found:
        return {}
    found = np.concatenate(found).copy()
    found["high"] += length - 1  # of bytes now, no longer of windows
    out: dict[int, list[tuple[int, int]]] = {}
    for doc, low, high, _ in _unite(found).tolist():
        out.setdefault(doc, []).append((low, high + 1))
    return out


def _prepared(documents: DataFrame, n: int, rest: list[str] = ()) -> DataFrame:
    """Texts by block; rows without an id get one of the smallest numbers. ``row`` holds what is given back."""
    text = F.coalesce("text", F.lit(""))
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID) + F.pmod(F.xxhash64(text), F.lit(1 << 62)))
    kept = F.struct("doc_id", *(F.col(f"`{c}`") for c in rest)).alias("row")
    return documents.select(F.pmod(own, F.lit(n)).cast("int").alias("block"), own.alias("doc_id"), text.alias("text"), kept)


def _dealt(rows: DataFrame, by: str, n: int) -> DataFrame:
    """Rows in partitions of whole blocks, ``BLOCKS`` in each where the session asks for fewer partitions: their
    number follows the input, so what a task reads does not."""
    asked = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(asked, n // BLOCKS), by)


def repeated_spans(documents: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES) -> tuple[int, DataFrame]:
    """``(n, found)``: the number of blocks of text, and the packed windows to remove by block."""
    ready(documents.sparkSession)
    n = blocks(documents, block_bytes)
    texts = _prepared(documents, n)
    compared = stored(
        _dealt(texts.select("doc_id", "text").mapInArrow(lambda x: _find(x, length, n, RUN_BYTES), PACKED), "place", n)
        .groupBy("place").applyInArrow(lambda t: _resolve(t, n), PACKED),
        "suffix-anchors",
    )
    edges = _dealt(compared.where(f"kind = {EDGE}"), "place", n).groupBy("place")
    runs = _dealt(texts, "block", n).groupBy("block").cogroup(edges).applyInArrow(lambda a, b: _suffixes(a, b, length, n), PACKED)
    merged = stored(
        _dealt(runs, "place", n).groupBy("place").applyInArrow(lambda t: _merge_runs(t, length, n), PACKED), "suffix-merged"
    )
    return n, compared.where(f"kind = {GONE}").union(merged)


def dedup_bytes(documents: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row."""
    n, found = repeated_spans(documents, length, **options)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        spans = _spans(right, length)
        out = []
        for doc, text in zip(left.column("doc_id").to_pylist(), left.column("text").to_pylist()):
            data, kept, at, removed, count = text.encode(), [], 0, 0, 0
            for low, high in spans.get(doc, ()):
                high = min(high, len(data))
                if low < high:
                    kept.append(data[at:low])
                    at, removed, count = high, removed + high - low, count + 1
            kept.append(data[at:])
            out.append((doc, len(data), removed, count, hashlib.sha256(b"".join(kept)).hexdigest()))
        columns = list(zip(*out)) or [[]] * 5
        return pa.table({
            "doc_id": pc.struct_field(left.column("row"), "doc_id").cast(pa.int64()),
            **{name: pa.array(columns[i], pa.int64()) for i, name in ((1, "n_bytes"), (2, "n_removed"), (3, "n_spans"))},
            "kept_sha256": pa.array(columns[4], pa.string()),
        })

    found = _dealt(found, "place", n).groupBy("place")
    return _dealt(_prepared(documents, n), "block", n).groupBy("block").cogroup(found).applyInArrow(
        finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def without_repeats(documents: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """The documents with repeats cut out of their texts; a character goes only if all its bytes do."""
    n, found = repeated_spans(documents, length, **options)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        spans = _spans(right, length)
        out = []
        for doc, text in zip(left.column("doc_id").to_pylist(), left.column("text").to_pylist()):
            data, kept, at = text.encode(), [], 0
            for low, high in spans.get(doc, ()):
                high = min(high, len(data))
                while low < high and data[low] & 0xC0 == 0x80:
                    low += 1
                while low < high < len(data) and data[high] & 0xC0 == 0x80:
                    high -= 1
                if low < high:
                    kept.append(data[at:low])
                    at = high
            kept.append(data[at:])
            out.append(b"".join(kept).decode())
        return pa.table({"text": pa.array(out, pa.string()), "row": left.column("row")})

    rows = _prepared(documents, n, [c for c in documents.columns if c not in ("doc_id", "text")])
    schema = T.StructType([T.StructField("text", T.StringType()), rows.schema["row"]])
    found = _dealt(found, "place", n).groupBy("place")
    cut_rows = _dealt(rows, "block", n).groupBy("block").cogroup(found).applyInArrow(cut, schema)
    return cut_rows.select(*("text" if c == "text" else F.col(f"row.`{c}`").alias(c) for c in documents.columns))
